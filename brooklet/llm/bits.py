"""A bit table of bounded size that says which hashes to look at."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 20, 28


def bit_table(hashes: DataFrame) -> np.ndarray:
    """The table of the column ``hash`` (bigint): 2 to 64 bits a hash, 32 MB at most.

    It finds all of the hashes, and some others: more of those when the table is at its bound. What it
    lets through must be checked, or be harmless.
    """
    count = hashes.count()
    bits = 1 << min(max((16 * count).bit_length(), LEAST_BITS), MOST_BITS)
    slot = F.pmod(F.col("hash"), F.lit(bits)) + 1
    parts = hashes.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    table = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        begin = (r["part"] - 1) * len(part)
        table[begin:begin + len(part)] |= part
    return table


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the table lets the hashes (of 64 bits, signed or not) through."""
    slot = hashes.view(np.uint64) & np.uint64(8 * len(table) - 1)
    return (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
