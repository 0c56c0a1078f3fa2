"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A fingerprint sums up the word shingles of a whole text in 64 bits; near copies differ in few of them. Two
fingerprints that differ in at most ``distance`` bits differ in at most ``distance // segments`` bits in one
of their segments. So every fingerprint is put in a table under each of its segments, asks under all keys in
a small Hamming ball around each of its segments, and the pairs found are checked by their whole distance.

Defined cases: a null or blank text has fingerprint zero, which is linked like any other; a text of fewer
words than a shingle is one shingle; equal fingerprints are linked at distance zero; repeated rows each get
a row; a null ``doc_id`` takes part but is nobody's smallest id; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.components import components
from parcelmill.llm.words import PIECE_BYTES, pieces, text_bytes

BITS = 64
_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def text_fingerprints(data: np.ndarray, at: np.ndarray, shingle: int = 4, seed: int = 42) -> np.ndarray:
    """Fingerprint of each text of a piece, as unsigned 64-bit numbers."""
    joined = b"\n".join(b" ".join(data[i:j].tobytes().lower().split()) for i, j in zip(at[:-1], at[1:]))
    n = len(at) - 1
    flat = np.frombuffer(joined, np.uint8)
    breaks = np.flatnonzero((flat == 32) | (flat == 10))
    starts, ends = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(flat)]))
    of = np.zeros(len(starts), np.int64)
    of[1:] = np.cumsum(flat[breaks] == 10)
    real = ends > starts  # a blank text leaves an empty word
    starts, ends, of = starts[real], ends[real], of[real]
    count = np.bincount(of, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))
    width = np.minimum(count, shingle)  # words of a shingle of this document
    last = np.arange(len(starts)) + width[of] - 1
    whole = last < first[1:][of]
    begin, end, of = starts[whole], ends[last[whole]], of[whole]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], seed) for i, j in zip(begin.tolist(), end.tolist())], np.uint64)
    many = np.bincount(of, minlength=n)
    out = np.zeros(n, np.uint64)
    for byte in range(8):
        value = ((hashes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        ones = np.bincount(of * 256 + value, minlength=256 * n).reshape(n, 256) @ _BIT
        bits = np.packbits(ones * 2 > many[:, None], axis=1, bitorder="little")[:, 0]
        out |= bits.astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every row, as a signed long."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = text_bytes(batch["text"])
        got = [text_fingerprints(d, a, shingle) for _, _, d, a in pieces(data, at, PIECE_BYTES)]
        fp = np.concatenate([*got, np.zeros(0, np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(fp)], ["doc_id", "fp"])

    return tasks.per_batch(tasks.texts(docs), each, "doc_id long, fp long")


def _segments(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _value(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))


def _ball(value: Column, width: int, radius: int) -> Column:
    """Keys of the ball around a segment that the side with more of the differing bits set asks for.

    Of two segments that differ in one bit one has it set; clearing set bits finds the other. For larger
    radii all flips are made.
    """
    near = F.array(value)
    if radius == 1:
        set_bits = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: F.expr("1L") == F.getbit(value, b))
        return F.concat(near, F.transform(set_bits, lambda b: value - F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ (1 << b) for m in masks for b in range(width)} | set(masks))
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def links(prints: DataFrame, distance: int = 4, segments: int = 3) -> DataFrame:
    """Pairs ``(u, v)`` of different fingerprints at most ``distance`` bits apart; input: distinct ``fp``."""
    radius = distance // segments
    parts = _segments(segments)

    def keyed(part: int):
        return lambda value: F.struct(F.lit(part).alias("part"), value.alias("key"))

    values = [keyed(i)(_value(*p)) for i, p in enumerate(parts)]
    balls = [F.transform(_ball(_value(*p), p[1], radius), keyed(i)) for i, p in enumerate(parts)]
    table = prints.select("fp", F.explode(F.array(*values)).alias("at"))
    asked = prints.select(F.col("fp").alias("other"), F.explode(F.concat(*balls)).alias("at"))
    table, asked = (d.select(*[c for c in d.columns if c != "at"], "at.part", "at.key") for d in (table, asked))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance
    found = asked.join(table, (asked.part == table.part) & (asked.key == table.key) & near & (F.col("fp") != F.col("other")))
    return found.select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).distinct()


def near_duplicates(docs: DataFrame, distance: int = 4, segments: int = 3, shingle: int = 4) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest ``doc_id`` that a chain of near fingerprints reaches."""
    prints = session.stage(fingerprints(docs, shingle), "fingerprints")
    distinct = session.stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), distance, segments))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(known, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those whose component has a smaller ``doc_id``."""
    known = near_duplicates(docs, **options)
    drop = known.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti").select(docs.columns)
