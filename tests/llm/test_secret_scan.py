import base64
import hashlib
import random
import re

from pyspark.sql import functions as F

from brooklet.llm import secret_scan
from brooklet.llm.catalog import QUERIES

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def texts():
    draw = random.Random(3)
    words = ["threshold", "internationalization", "AbstractSingletonProxyFactoryBean", "get_user_name_from_database_row", "container"]
    prose = [" ".join(draw.choice(words) for _ in range(40)) for _ in range(300)]
    secret = base64.b64encode(draw.randbytes(30)).decode()
    special = [
        None, "", "é👍 token = 'abcdef' 👍 secret:abc password==xyz123", "token:token:abcdefgh", "API_KEY=\"A.b-c_d/e+f=\"", "apikey : x" + "y" * 50,
        "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 14 + " AKIAshort", "f" * 24 + "g" + "0123456789abcdef" * 3 + " deadbeef", "Passwd='" + "a1" * 20 + "'",
        f"the key is {secret} here", f"secret = {secret}", "token = " + "ab12" * 5000 + " " + "0" * 30,
    ]
    return [(i, t) for i, t in enumerate(special + prose)], secret


def test_spans_against_plain_patterns(frame):
    rows, secret = texts()
    docs = frame(rows + [(0, None), (None, "token=abcdefg")])
    found = secret_scan.scan(docs, secret_scan.train(docs)).collect()
    assert len(found) == len(rows) + 2
    by_id = {r["doc_id"]: [(s["start"], s["order"], s["kind"], s["end"]) for s in r["spans"]] for r in found}
    for i, text in rows:
        text = text or ""
        assert [s for s in by_id[i] if s[2] != "markov"] == base_spans(text), text[:80]
        extra = [text[a:b] for a, _, kind, b in by_id[i] if kind == "markov"]
        assert extra == ([secret] if text == f"the key is {secret} here" else []), text[:80]
    assert [s[2] for s in by_id[None]] == ["assign"]


def test_ratio_equals_a_plain_walk(spark, frame):
    rows, secret = texts()
    model = secret_scan.train(frame(rows))

    def plain(token):
        states = [secret_scan.ENDS, *[secret_scan.ALPHABET.find(c) + 1 for c in token], secret_scan.ENDS]
        return sum(model[a * secret_scan.STATES + b] for a, b in zip(states, states[1:]))

    tokens = [secret, "threshold", "+/=_-", "a", "0123456789abcdefABCDEF"]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secret_scan.ratio(F.col("t"), model).alias("r")).collect()
    assert {r["t"]: r["r"] for r in got} == {t: plain(t) for t in tokens}
    assert plain(secret) > 10_000 > 0 > plain("internationalization")


def test_models_count_whole_tokens(frame):
    model = secret_scan.train(frame([(i, "a" * 260 + "qz" * 200) for i in range(40)]))
    q, z = (secret_scan.ALPHABET.find(c) + 1 for c in "qz")
    assert model[q * secret_scan.STATES + z] < -1000


def test_query_on_its_whole_table(spark, sf, database):
    rows = {r["doc_id"]: r for r in QUERIES["op8_secret_scan"](spark, sf).collect()}
    given = database.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(rows) == len(given)
    for i, text in given:
        want = base_spans(text)
        r = rows[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[2] == k for s in want) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in want).encode()).hexdigest()


def test_empty_table(frame):
    docs = frame([])
    assert secret_scan.scan(docs, secret_scan.train(docs)).count() == 0
