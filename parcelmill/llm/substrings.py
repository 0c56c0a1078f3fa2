"""Removal of word passages that occur more than once, by sharded FM-indexes.

A window is ``length`` consecutive words of one document. Every word that lies in a window whose word
sequence also starts anywhere else, in the same document too, is removed.

Windows are dealt out by content: each belongs to its anchor, the least hash among its word grams. The
consecutive windows of one anchor make a segment, so that a segment holds exactly the windows it owns and
equal windows belong to equal anchors. Only anchors that occur twice can own a repeated window. Their
distinct segments go to shards by anchor; a shard builds a compressed FM-index of its segments, streams them
through backward search, and reports the windows whose matching statistics reach ``length`` words twice. An
anchor with more than ``hot_segments`` different segments doesn't go to one shard: its windows are counted
by a digest of their words, with partial counts before the shuffle.

Defined cases: words are runs without ASCII white space, compared as they stand; a null or blank text has no
words; texts shorter than a window lose nothing; repeated rows (same ``doc_id`` and text) count as separate
documents; a null ``doc_id`` is a document like any other; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.fm_index import FMIndex, repeated_windows
from parcelmill.llm.words import Words, as_texts, covered, pieces, ragged, sliding_min, span_hashes, text_bytes, window_hashes

WINDOW = 35
GRAM = 6
SHARD_WORDS = 1_000_000
HOT_SEGMENTS = 20_000


def _uid():
    return F.xxhash64("doc_id", "text").alias("uid")


def segments_of(words: Words, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Document, anchor, segment hash, first word in the document and windows of each segment of a piece."""
    n = len(words)
    room = words.room()
    if n < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    grams = window_hashes(words.hashes, gram)
    bits = np.uint64(max(21, n.bit_length()))
    tagged = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_min(tagged, length - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    whole = room[: len(place)] >= length
    change = np.ones(len(place), bool)
    change[1:] = (place[1:] != place[:-1]) | ~whole[:-1]
    start = np.flatnonzero(change & whole)
    stop = np.flatnonzero(whole & np.append(change[1:] | ~whole[1:], True)) + 1
    many = stop - start
    digest = span_hashes(words.hashes, start, stop + length - 1)
    document = words.document[start]
    return document, grams[place[start]].view(np.int64), digest.view(np.int64), start - words.first[document], many


def segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``uid, anchor, seg, start, many`` of every segment of every text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        uid = batch["uid"].to_numpy()
        data, at = text_bytes(batch["text"])
        got = []
        for i, _, d, a in pieces(data, at):
            document, *rest = segments_of(Words(d, a), length, gram)
            got.append((uid[document + i], *rest))
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*got)] if got else [np.zeros(0, np.int64)] * 5
        arrays = [pa.array(c) for c in columns[:3]] + [pa.array(c.astype(np.int32)) for c in columns[3:]]
        return pa.RecordBatch.from_arrays(arrays, ["uid", "anchor", "seg", "start", "many"])

    return tasks.per_batch(docs.select(_uid(), "text"), each, "uid long, anchor long, seg long, start int, many int")


def _with_text(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The words of each wanted segment: ``shard, anchor, seg, many, full, words``."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("shard", "anchor", "seg", "many", "full", "words")}
        for text, wants in zip(batch["text"], batch["wants"]):
            words = (text.as_py() or "").encode().split()
            for w in wants.as_py():
                for k in ("shard", "anchor", "seg", "many", "full"):
                    out[k].append(w[k])
                out["words"].append(b" ".join(words[w["start"] : w["start"] + w["many"] + length - 1]))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([x.decode() for x in v] if k == "words" else v, t) for (k, v), t in zip(out.items(), kinds)], list(out)
        )

    gathered = wanted.groupBy("uid").agg(F.collect_list(F.struct("shard", "anchor", "seg", "start", "many", "full")).alias("wants"))
    once = docs.select(_uid(), "text").dropDuplicates(["uid"])  # repeated rows would each give their segments
    joined = once.join(gathered, "uid").select("text", "wants")
    return tasks.per_batch(joined, each, "shard int, anchor long, seg long, many int, full boolean, words string")


def _search(shard: pa.Table, length: int, gram: int) -> pa.Table:
    """Masks of the repeated windows of a shard's segments."""
    lists = pc.split_pattern(as_texts(*text_bytes(shard["words"])), " ")
    ids = lists.values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    at = lists.offsets.to_numpy()
    ids, at = ids[at[0] : at[-1]], at - at[0]
    n = len(at) - 1
    symbols = np.zeros(len(ids) + n + 1, np.int64)  # 0 stands before each segment
    starts = at[:-1] + np.arange(n) + 1
    symbols[ragged(starts, np.diff(at))] = ids
    many, full = shard["many"].to_numpy(), shard["full"].to_numpy()
    masks = (np.int64(1) << many.astype(np.int64)) - 1
    asked = np.flatnonzero(~full)  # a segment that occurs twice as a whole needs no search
    if len(asked):
        index = FMIndex(symbols, 2 * length - gram)
        counts = many[asked].astype(np.int64)
        found = repeated_windows(index, symbols, starts[asked], counts, length)
        bit = np.int64(1) << ragged(np.zeros(len(asked), np.int64), counts)
        masks[asked] = np.add.reduceat(np.where(found, bit, 0), np.concatenate(([0], np.cumsum(counts)[:-1])))
    return pa.table({"anchor": shard["anchor"], "seg": shard["seg"], "mask": pa.array(masks)})


def _hot_windows(pieces_: DataFrame, length: int) -> DataFrame:
    """The same for segments of crowded anchors: windows counted by a 128-bit digest of their words."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for anchor, seg, many, full, text in zip(*[batch[c].to_pylist() for c in ("anchor", "seg", "many", "full", "words")]):
            words = text.encode().split(b" ")
            for i in range(many):
                d = hashlib.blake2b(b" ".join(words[i : i + length]), digest_size=16).digest()
                rows.append((anchor, seg, i, 2 if full else 1, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
        kinds = [("anchor", pa.int64()), ("seg", pa.int64()), ("bit", pa.int32()), ("times", pa.int64()), ("high", pa.int64()), ("low", pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds)], [k for k, _ in kinds])

    windows = tasks.per_batch(pieces_, each, "anchor long, seg long, bit int, times long, high long, low long")
    again = windows.groupBy("high", "low").agg(F.sum("times").alias("n")).filter("n > 1").select("high", "low")
    hit = windows.join(again, ["high", "low"])
    return hit.groupBy("anchor", "seg").agg(F.sum(F.expr("shiftleft(1L, bit)")).alias("mask"))


def repeated(docs: DataFrame, length: int = WINDOW, gram: int = GRAM, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``uid, start, mask``: a bit for each window from word ``start`` on whose words occur elsewhere."""
    every = session.stage(segments(docs, length, gram), "segments")
    anchors = every.groupBy("anchor").agg(F.count("*").alias("n"), F.min("seg").alias("a"), F.max("seg").alias("b"))
    anchors = anchors.filter("n > 1").select("anchor", (F.col("a") == F.col("b")).alias("same"))
    anchors = session.stage(anchors, "anchors")  # so that the join has shuffles of its own, whose hot anchors can be split
    suspects = session.stage(every.join(anchors, "anchor"), "suspects")
    whole = suspects.filter("same").select("uid", "start", (F.expr("shiftleft(1L, many)") - 1).alias("mask"))
    distinct = (
        suspects.filter("NOT same")
        .groupBy("anchor", "seg")
        .agg(F.count("*").alias("n"), F.min(F.struct("uid", "start", "many")).alias("one"))
        .select("anchor", "seg", "one.*", (F.col("n") > 1).alias("full"))
    )
    distinct = session.stage(distinct, "distinct-segments")
    amount = distinct.agg(F.sum(F.col("many") + length - 1)).first()[0] or 0
    crowded = distinct.groupBy("anchor").count().filter(F.col("count") > hot_segments).select("anchor", F.lit(True).alias("hot"))
    shards = tasks.shares(amount, SHARD_WORDS)
    wanted = distinct.join(crowded, "anchor", "left").withColumn(
        "shard", F.when(F.col("hot"), -1).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))).cast("int")
    )
    found = session.stage(_with_text(docs, wanted, length), "segment-words")

    def search(shard: pa.Table) -> pa.Table:
        return _search(shard, length, gram)

    masks = found.filter("shard >= 0").groupBy("shard").applyInArrow(search, "anchor long, seg long, mask long")
    masks = masks.unionByName(_hot_windows(found.filter("shard < 0"), length)).filter("mask <> 0")
    varied = suspects.filter("NOT same").join(masks, ["anchor", "seg"]).select("uid", "start", "mask")
    return whole.unionByName(varied)


def removed_mask(n: int, marks: list[tuple[int, int]], length: int) -> np.ndarray:
    """Of a text's ``n`` words, those in a marked window."""
    starts = [start + bit for start, mask in marks for bit in range(mask.bit_length()) if mask >> bit & 1]
    return covered(n, np.array(starts, np.int64), length) if starts else np.zeros(n, bool)


def without_repeats(docs: DataFrame, length: int = WINDOW, gram: int = GRAM, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each text's remaining words, joined by single spaces."""
    docs = tasks.texts(docs)
    marks = repeated(docs, length, gram, hot_segments).groupBy("uid").agg(F.collect_set(F.struct("start", "mask")).alias("marks"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, gone, kept = [], [], []
        for text, marks in zip(batch["text"], batch["marks"]):
            words = (text.as_py() or "").encode().split()
            total.append(len(words))
            if marks.is_valid:
                mask = removed_mask(len(words), [(m["start"], m["mask"]) for m in marks.as_py()], length)
                gone.append(int(mask.sum()))
                words = [w for w, m in zip(words, mask.tolist()) if not m]
            else:
                gone.append(0)
            kept.append(b" ".join(words).decode())
        arrays = [batch["doc_id"].cast(pa.int64()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])

    joined = docs.withColumn("uid", _uid()).join(marks, "uid", "left").select("doc_id", "text", "marks")
    return tasks.per_batch(joined, each, "doc_id long, n_words long, n_removed long, kept string")
