"""Removal of multi-line runs that repeat anywhere in the corpus, by content-defined chunks of lines.

A run is ``least`` or more adjacent lines. A line goes where it lies in a run an equal of which stands earlier:
in an earlier document, or in the same one and ended before. Documents are ordered by ``doc_id``, null last, and by a
hash of id and text where ids are equal.

Chunks end after a line where a rolling hash over the last ``span`` line hashes is a multiple of ``every``. The same lines
give the same cuts wherever they stand, and a line put in above shifts no later cut. To each chunk belong the ``least - 1``
lines after it, so that each run of just ``least`` lines (a window) lies whole in the chunk where it starts. A chunk that an
earlier document has goes whole, after its bytes were compared. That leaves the heads and tails of repeated runs, which end
within a chunk: of each different chunk, where it first stands, the windows are compared as well, by digest and then by
bytes. A copied chunk sends no windows, since all of its are known from its first place; so a passage with a million copies
costs a million chunks, and its windows once.

Defined cases: lines end at ``\\n``; an empty line is a line; a null text has no lines and stays null; texts
without repeats stay as they are; a text may become empty, its row stays; repeated rows (same ``doc_id`` and
text) are treated alike; other columns are ignored or passed through. Rows and chunks are known by 128 bits.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.membership import parted, row_id

SPAN = 2
EVERY = 4
LEAST = 2

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9


def chunks(lines: list[bytes], span: int = SPAN, every: int = EVERY) -> list[tuple[int, int]]:
    """First line and end of each chunk."""
    digest, out, begin, rolled = xxhash.xxh64_intdigest, [], 0, 0
    hashes = [digest(line) for line in lines]
    drop = pow(_BASE, span, 1 << 64)
    for i, h in enumerate(hashes):
        rolled = rolled * _BASE + h
        if i >= span:
            rolled -= hashes[i - span] * drop
        rolled &= _MASK
        if i + 1 >= span and ((rolled * _MIX & _MASK) >> 33) % every == 0:
            out.append((begin, i + 1))
            begin = i + 1
    if begin < len(lines):
        out.append((begin, len(lines)))
    return out


def cut(text: str) -> list[bytes]:
    return text.encode().split(b"\n")


def joined(lines: list[bytes], a: int, b: int) -> bytes:
    return b"\n".join(lines[a:b])


def with_ends(lines: list[bytes], least: int, span: int, every: int) -> list[tuple[int, int]]:
    """Each chunk with the lines that its last windows need; chunks without a window are left out."""
    ends = [(a, min(b + least - 1, len(lines))) for a, b in chunks(lines, span, every)]
    return [(a, b) for a, b in ends if b - a >= least]


def windows(lines: list[bytes], a: int, b: int, least: int) -> list[int]:
    """Digests of the windows of a chunk."""
    return [xxhash.xxh3_64_intdigest(joined(lines, i, i + least)) - (1 << 63) for i in range(a, b - least + 1)]


CHUNKS = "doc_id long, uid string, line int, until int, digest binary, windows array<long>"
BODIES = "doc_id long, uid string, line int, until int, digest binary, body string"


def repeats(docs: DataFrame, least: int = LEAST, span: int = SPAN, every: int = EVERY) -> DataFrame:
    """``uid, line, until``: chunks and windows of a text that an earlier document has too."""

    def found(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [], [], [], [])
        for doc_id, uid, text in zip(*[batch[c].to_pylist() for c in ("doc_id", "uid", "text")]):
            lines, own = cut(text), set()
            for a, b in with_ends(lines, least, span, every):
                digest = xxhash.xxh3_128_digest(joined(lines, a, b))
                if digest not in own:
                    own.add(digest)
                    for column, value in zip(out, (doc_id, uid, a, b, digest, windows(lines, a, b, least))):
                        column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["doc_id", "uid", "line", "until", "digest", "windows"])

    def bodies(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = ([], [], [], [], [], [])
        for doc_id, uid, text, wants in zip(*[batch[c].to_pylist() for c in ("doc_id", "uid", "text", "wants")]):
            lines = cut(text)
            for w in wants:
                a, b = w["line"], w["until"]
                for column, value in zip(out, (doc_id, uid, a, b, w["digest"], joined(lines, a, b).decode())):
                    column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["doc_id", "uid", "line", "until", "digest", "body"])

    texts = tasks.texts(docs).filter("text IS NOT NULL").select("doc_id", row_id().alias("uid"), "text")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    every_chunk = session.stage(tasks.per_batch(texts, found, CHUNKS), "chunks")
    # the first place of each chunk; a hot one is reduced to a row a task before the shuffle
    at = every_chunk.groupBy("digest").agg(F.min(F.struct(order.alias("by"), "line")).alias("first"), F.count("*").alias("n"))
    firsts = session.stage(at.select("digest", "n", F.col("first.by.uid").alias("uid"), F.col("first.line").alias("line")), "first-places")
    again = firsts.filter("n > 1").select("digest")
    copied = every_chunk.join(again, "digest").select("uid", "line", "until", "digest")
    first_chunks = every_chunk.join(firsts.select("digest", "uid", "line"), ["digest", "uid", "line"]).dropDuplicates(["digest"])
    single = first_chunks.select("uid", "line", F.posexplode("windows").alias("at", "window")).select("uid", (F.col("line") + F.col("at")).alias("line"), "window")
    single = session.stage(single, "windows")
    shared = session.stage(single.groupBy("window").count().filter("count > 1").select("window"), "repeated-windows")
    # a window's digest is eight bytes long, so that it equals no chunk's
    open_ = single.join(shared, "window").select("uid", "line", (F.col("line") + least).alias("until"), F.unhex(F.lpad(F.hex("window"), 16, "0")).alias("digest"))
    wants = copied.unionByName(open_).distinct().groupBy("uid").agg(F.collect_list(F.struct("line", "until", "digest")).alias("wants"))
    wants = session.stage(wants, "wanted-lines")
    _, likely = parted(texts, wants, "uid")
    suspects = session.stage(tasks.per_batch(likely.join(wants, "uid").select("doc_id", "uid", "text", "wants"), bodies, BODIES), "suspects")
    session.drop(every_chunk, firsts, single, shared, wants)
    first = suspects.groupBy("digest", "body").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = session.stage(first.select("digest", "body", F.col("first.uid").alias("first")), "firsts")
    gone = suspects.join(first, ["digest", "body"]).filter("uid <> first").select("uid", "line", "until").distinct()
    gone = session.stage(gone, "repeats")
    session.drop(suspects, first)
    return gone


def lines_gone(lines: list[bytes], lost: list[tuple[int, int]], least: int) -> set[int]:
    """Lines of a text that go: ``lost`` are parts of it that earlier documents have."""
    first: dict[bytes, int] = {}
    earlier = {joined(lines, i, i + least) for a, b in lost for i in range(a, b - least + 1)}
    gone: set[int] = set()
    for i in range(len(lines) - least + 1):
        body = joined(lines, i, i + least)
        begin = 0 if body in earlier else first.setdefault(body, i) + least  # one that overlaps the first in its own text stays
        if i >= begin:
            gone.update(range(i, i + least))
    return gone


COUNTS = ("n_lines", "n_removed")


def clean_runs(docs: DataFrame, least: int = LEAST, span: int = SPAN, every: int = EVERY, counts: bool = True) -> DataFrame:
    """All columns of the documents, with shorter texts, and ``n_lines``, ``n_removed`` (lines) as counts.

    ``n_chars``, where there is one, follows the text. The counts take the place of columns of their names;
    without ``counts`` the columns are those of the input.
    """
    dropped = repeats(docs, least, span, every).groupBy("uid").agg(F.collect_list(F.struct("line", "until")).alias("gone"))
    columns = [c for c in docs.columns if not (counts and c.lower() in COUNTS)]
    uid, gone = (tasks.unused(name, docs.columns) for name in ("uid", "gone"))
    dropped = session.stage(dropped.select(F.col("uid").alias(uid), F.col("gone").alias(gone)), "dropped-lines")
    whole, likely = parted(docs.withColumn(uid, row_id()), dropped, uid)
    found = likely.join(dropped, uid, "left")
    source = whole.withColumn(gone, F.lit(None).cast(found.schema[gone].dataType)).unionByName(found.select(*whole.columns, gone))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, total, removed, chars = [], [], [], []
        for text, lost in zip(batch["text"].to_pylist(), batch[gone].to_pylist()):
            if text is None:
                texts.append(None), total.append(0), removed.append(0), chars.append(None)
                continue
            lines = cut(text)
            drop = lines_gone(lines, [(x["line"], x["until"]) for x in lost or ()], least)
            kept = b"\n".join([x for i, x in enumerate(lines) if i not in drop]).decode() if drop else text
            texts.append(kept), total.append(len(lines)), removed.append(len(drop)), chars.append(len(kept))
        arrays = [pa.array(texts, pa.string()) if c == "text" else pa.array(chars).cast(batch[c].type) if c == "n_chars" else batch[c] for c in columns]
        added = [pa.array(total, pa.int64()), pa.array(removed, pa.int64())] if counts else []
        return pa.RecordBatch.from_arrays([*arrays, *added], [*columns, *COUNTS[: len(added)]])

    kinds = source.select(*columns).schema
    for name in COUNTS if counts else ():
        kinds = kinds.add(name, "long")
    return tasks.per_batch(source.select(*columns, gone), each, kinds)
