from collections import defaultdict

from brooklet.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(WHITE).translate(lower)
    lost = lambda i: (i is not None, i or 0)
    docs = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(i)
    gone = {k: max(d, key=lost) for k, d in docs.items() if len(d) >= min_docs}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=str)


def test_against_a_plain_version(frame, hostile):
    assert found(line_dedup.drop_shared_lines(frame(hostile))) == brute(hostile, 40, 5)
    assert found(line_dedup.drop_shared_lines(frame(hostile), min_chars=1, min_docs=2)) == brute(hostile, 1, 2)


def test_a_line_of_a_third_of_all_rows(frame):
    line = "A line that is found in every third document of this table"
    rows = [(i, f"own {i}\n{line}\nend" if i % 3 == 0 else f"own {i}") for i in range(900)]
    got = found(line_dedup.drop_shared_lines(frame(rows, 8)))
    assert got == brute(rows, 40, 5) and sum(r[3] for r in got) == 299


def test_columns_are_carried_and_tables_may_be_empty(frame, hostile):
    rows = line_dedup.drop_shared_lines(frame(hostile), carry=["source", "kept", "key"])
    assert rows.columns == ["doc_id", "text", "n_lines", "n_dropped", "source", "kept", "key"] and rows.count() == len(hostile)
    assert line_dedup.drop_shared_lines(frame([])).count() == 0
