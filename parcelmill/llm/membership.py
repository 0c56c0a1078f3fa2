"""Which rows can have one of a set of keys: a bitmap of fixed size, so that few others are shuffled to a join.

The bitmap has ``2^BITS`` bits, kept as rows of 64, one for each word that isn't zero: at most ``2^(BITS - 6)`` rows of
two longs, whatever the number of keys. So it may be broadcast. It never misses a key, and lets others through the more
the fuller it is; the exact join follows on what it lets through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks

BITS = 26


def row_id() -> Column:
    """128 bits that tell rows by ``doc_id`` and ``text``, nulls from blanks."""
    parts = [F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in ("doc_id", "text")]
    return F.md5(F.concat_ws(" ", *parts))


def _slot(key: str) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit((1 << BITS) - 1))


def _bit(slot: str) -> Column:
    return F.expr(f"shiftleft(1L, cast(`{slot}` & 63 as int))")


def parted(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that have none of the keys for certain, and the others, which may; ``key`` is a column of both."""
    slots = keys.select(_slot(key).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(_bit("slot")).alias("bits"))
    words = session.stage(words, "bitmap")
    slot, word, bits = (tasks.unused(name, rows.columns) for name in ("slot", "word", "bits"))
    known = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits)))  # bounded: see above
    marked = rows.withColumn(slot, _slot(key)).join(known, F.shiftright(slot, 6) == F.col(word), "left")
    likely = F.coalesce(F.col(bits).bitwiseAND(_bit(slot)) != 0, F.lit(False))
    return marked.filter(~likely).select(rows.columns), marked.filter(likely).select(rows.columns)
