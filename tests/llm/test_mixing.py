from collections import Counter, defaultdict

from brooklet.llm import mixing
from brooklet.llm.catalog import QUERIES


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(sizes), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**out, **share}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= most * sizes[s]
            open_.discard(s)
    return out


def check(rows, words, sources):
    sizes = Counter()
    for i, n in words.items():
        sizes[sources[i]] += n
    want = plain_targets(sizes)
    taken = Counter()
    for r in rows:
        i = r["doc_id"]
        assert (r["size"], r["source_size"]) == (words[i], sizes[sources[i]])
        assert abs(r["target"] - want[sources[i]]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[sources[i]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_query_on_its_whole_table(spark, sf, database):
    rows = QUERIES["op9_mixing"](spark, sf).collect()
    docs = database.execute("SELECT doc_id, text, source FROM documents").fetchall()
    assert len(rows) == len(docs)
    check(rows, {i: len(t.encode().split()) for i, t, _ in docs}, {i: s for i, _, s in docs})
    again = QUERIES["op9_mixing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def mixed(df, **parameters):
    documents, taken = mixing.mix(df, **parameters)
    return documents.collect(), taken.collect()


def test_sources_of_very_different_sizes(frame):
    rows = [(i, "w " * (i % 7 + 1), "big") for i in range(600)] + [(1000 + i, "one two three", f"tiny{i}") for i in range(9)]
    rows += [(2000, "a b c d", None), (2001, None, "none"), (2002, "", None), (2003, " \t", "tiny0")]
    documents, taken = mixed(frame(rows), block_words=16)
    sums = Counter()
    for t in taken:
        sums[t["doc_id"]] += t["words"]
    words = {i: len((t or "").encode().split()) for i, t, *_ in rows}
    found = [{**d.asDict(), "taken": sums[d["doc_id"]]} for d in documents]
    assert len(found) == len(rows)
    check(found, words, {i: s for i, _, s in rows})
    pieces = defaultdict(list)
    for t in taken:
        pieces[t["doc_id"], t["epoch"]].append((t["begin"], t["begin"] + t["words"]))
    for (i, _), spans in pieces.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= words[i] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_any_stretch_of_the_schedule_is_close_to_the_weights(frame):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(900)]
    _, taken = mixed(frame(rows), block_words=50)
    slots = sorted({(t["slot"], t["doc_id"] % 3) for t in taken})
    for begin in range(0, 800, 100):
        counts = Counter(s for _, s in slots[begin:begin + 100])
        assert [abs(counts[s] - 100 * w / 8) <= 5 for s, w in ((0, 5), (1, 2), (2, 1))] == [True] * 3


def test_blocks_and_buckets_do_not_matter(frame, hostile, monkeypatch):
    want = None
    for bucket, stretch in ((10**6, 1 << 16), (3, 2)):
        monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", bucket)
        monkeypatch.setattr(mixing, "STRETCH", stretch)
        _, taken = mixed(frame(hostile), block_words=8)
        got = sorted((t["slot"], t["shuffle"], t["epoch"], t["begin"], t["words"]) for t in taken)
        want = want or got
        assert len(got) == len(want) and Counter((g[0], g[4]) for g in got) == Counter((w[0], w[4]) for w in want)


def test_documents_of_the_mix(frame):
    rows = [(i, f" one  two\nthree {i} ", "a") for i in range(40)] + [(100 + i, "x y z", "b") for i in range(3)]
    documents, taken = mixed(frame(rows), block_words=8)
    out = mixing.mixed_documents(frame(rows), block_words=8).collect()
    assert sum(len(r["text"].split()) for r in out) == sum(t["words"] for t in taken)
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r["doc_id"]].startswith(r["text"]) and r["row"] == "x" for r in out)
    assert sum(r["text"] != texts[r["doc_id"]] for r in out) <= 2


def test_empty_tables(frame):
    for rows in ([], [(1, None), (2, "")]):
        documents, taken = mixed(frame(rows))
        assert (len(documents), len(taken)) == (len(rows), 0)
        assert mixing.mixed_documents(frame(rows)).count() == 0
