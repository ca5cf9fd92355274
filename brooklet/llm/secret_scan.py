"""Scans for secrets: fixed patterns, and character Markov models, in DataFrame expressions.

Two first-order models of characters, one of random strings and one of ordinary identifiers, are
counted from labelled samples. A token whose log-likelihood ratio is at least a margin is taken
for a secret.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklet.llm.common import text_or_empty

# The patterns, by kind. Runs that a repetition without upper bound would find and
# a length test then drop are left out by the bound itself; ``assign`` needs the test.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
VALUE_CHARS = 6

TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
MIN_TOKEN = 20
WORD_TOKEN = r"[A-Za-z0-9+/_=-]{4,}"

#: Model states: 0 any other character, then these, and last the ends of a token.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENDS = len(ALPHABET) + 1
STATES = ENDS + 1

#: Log-likelihood ratios are whole thousandths, so sums do not depend on their order.
SCALE = 1000
MARGIN = 10.0
#: How many sightings the shares of all states weigh against those after one state.
BACK_OFF = 32
DIGESTS = 4


def _codes(token: Column) -> Column:
    """The states of a token's characters."""
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c))


def train(docs: DataFrame, text_column: str = "text") -> list[int]:
    """``STATES`` x ``STATES`` log-likelihood ratios, in thousandths, of one character after another.

    The labelled samples come from all documents. Random: the distinct values that the fixed patterns
    find there, and ``DIGESTS`` digests of each document written in hex and in base 64. Ordinary: the
    other tokens of four characters or more. The driver gets one row per label and pair of states, at most.
    """
    chosen = docs.select(text_or_empty(F.col(f"`{text_column}`")).alias("text"))
    digests = [F.sha2(F.concat(F.lit(str(i)), "text").cast("binary"), 512) for i in range(DIGESTS)]
    found = [F.regexp_extract_all("text", F.lit(p), F.lit(2 if k == "assign" else 0)) for k, p in PATTERNS.items()]
    rest = F.col("text")
    for pattern in PATTERNS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    labelled = chosen.select(F.explode(F.concat(
        F.transform(F.concat(*found, F.array(*digests, *[F.base64(F.unhex(d)) for d in digests])), lambda t: F.struct(F.lit(True).alias("random"), t.alias("token"))),
        F.transform(F.regexp_extract_all(rest, F.lit(WORD_TOKEN), F.lit(0)), lambda t: F.struct(F.lit(False).alias("random"), t.alias("token"))),
    )).alias("sample")).select("sample.random", "sample.token")
    # A value that many documents repeat is one sample of random strings; ordinary words count as often as they come.
    labelled = labelled.groupBy("random", "token").agg(F.count(F.lit(1)).alias("times")).withColumn(
        "times", F.when(F.col("random"), F.lit(1).cast("long")).otherwise(F.col("times")))
    ends = F.array(F.lit(ENDS))
    pairs = labelled.select("random", "times", _codes(F.col("token")).alias("codes")).select("random", "times", F.explode(
        F.zip_with(F.concat(ends, "codes"), F.concat("codes", ends), lambda a, b: a * STATES + b)).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.sum("times").alias("n")).collect()}

    def log_shares(label: bool) -> list[float]:
        """Shares of what follows each state; what has been seen little goes by the shares of all."""
        rows = [[counts.get((label, a * STATES + b), 0) for b in range(STATES)] for a in range(STATES)]
        every = [sum(column) + 0.5 for column in zip(*rows, strict=True)]
        return [math.log((n + BACK_OFF * e / sum(every)) / (sum(row) + BACK_OFF)) for row in rows for n, e in zip(row, every, strict=True)]

    return [round(SCALE * (r - o)) for r, o in zip(log_shares(True), log_shares(False), strict=True)]


def ratio(token: Column, model: list[int]) -> Column:
    """The token's log-likelihood ratio, random against ordinary, in thousandths."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<bigint>")
    start = F.struct(F.lit(ENDS).alias("last"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        _codes(token), start,
        lambda a, c: F.struct(c.alias("last"), (a["sum"] + F.get(table, a["last"] * STATES + c)).alias("sum")),
        lambda a: a["sum"] + F.get(table, a["last"] * STATES + F.lit(ENDS)),
    )


def _hits(text: Column, kind: str, order: int, pattern: str, passes) -> Column:
    """Matches as structs: ``order``, ``kind``, ``i``, ``gap`` (characters since the match before),
    ``size`` and ``ok``. A text without a match is not split."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else whole
    zipped = F.arrays_zip(whole.alias("whole"), value.alias("value"), F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap"))
    found = F.transform(zipped, lambda x, i: F.struct(
        F.lit(order).alias("order"), F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"),
        F.length(x["whole"]).alias("size"), passes(x["value"]).alias("ok")))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(
        F.array().cast("array<struct<order:int,kind:string,i:int,gap:int,size:int,ok:boolean>>"))


def scan(
    docs: DataFrame, model: list[int], margin: float = MARGIN, min_token: int = MIN_TOKEN,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of ``start``, ``order``, ``kind``,
    ``end`` in order of ``start`` and ``order``.

    Positions count code points, ``end`` is exclusive. The kinds ``assign``, ``access`` and ``hex``
    are the matches of the fixed patterns, leftmost and not overlapping within a kind; kind
    ``markov`` has tokens of at least ``min_token`` characters with a log-likelihood ratio of
    ``margin`` nats or more that overlap no match of a fixed pattern.

    Null texts count as empty. Rows that repeat are scanned each for itself. Other columns play
    no part. Texts stay in their scan; only matches are shuffled, by document.
    """
    least = F.lit(round(margin * SCALE))
    passes = {"assign": lambda v: F.length(v) >= VALUE_CHARS, "markov": lambda v: ratio(v, model) >= least}
    kinds = {**PATTERNS, "markov": TOKEN % min_token}
    text = F.col("text")
    hits = F.concat(*[
        _hits(text, kind, order, pattern, passes.get(kind, lambda v: F.lit(True))) for order, (kind, pattern) in enumerate(kinds.items())])
    # Every row keeps one hit at least, so that it comes out without any.
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_column}`").alias("doc_id"),
        text_or_empty(F.col(f"`{text_column}`")).alias("text"),
    ).select("row", "doc_id", F.explode_outer(hits).alias("hit")).select("row", "doc_id", "hit.*").repartition("row")
    end = F.sum(F.col("gap") + F.col("size")).over(W.partitionBy("row", "order").orderBy("i").rowsBetween(W.unboundedPreceding, 0))
    placed = found.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    markov = F.col("order") == len(kinds) - 1
    base = F.col("ok") & ~markov
    before = W.partitionBy("row").orderBy("start", "order").rowsBetween(W.unboundedPreceding, 0)
    after = W.partitionBy("row").orderBy(F.desc("start"), F.desc("order")).rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("left", F.max(F.when(base, F.col("end"))).over(before)).withColumn(
        "right", F.min(F.when(base, F.col("start"))).over(after))
    clear = (F.coalesce("left", F.lit(-1)) <= F.col("start")) & (F.coalesce("right", F.col("end")) >= F.col("end"))
    wanted = base | (F.col("ok") & markov & clear)
    return placed.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(
        F.when(wanted, F.struct("start", "order", "kind", "end")))).alias("spans")).select("doc_id", "spans")


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
