"""Contamination by benchmark items, found with winnowed fingerprints.

Words are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z in lower case. A window is
``window`` consecutive words of an item; an item of fewer words is one window of its own. From every sliding
run of ``window - gram + 1`` word grams the one with the least hash is kept, in items and documents alike, so
that every span of ``window`` common words has a kept gram in common. Where a document's fingerprint is also
an item's, the hit is extended: all windows that hold the gram are looked up and compared word by word. Items
shorter than a window have one fingerprint, of all their words.

The items are looked up from a broadcast while their windows are at most ``most_windows``; beyond it the
fingerprints of both sides are joined by a shuffle, and so are the windows around the common ones. Both give the
same rows.

Defined cases: a null or wordless text has no words, no hit and isn't contaminated; items without words, and
null ones, match nothing; repeated items each count, an equal ``item_id`` is listed once; repeated documents
each get a row; other columns are ignored; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.membership import parted, row_id
from parcelmill.llm.words import ALPHANUMERIC, Words, covered, pieces, ragged, sliding_min, text_bytes, window_hashes

WINDOW = 13
GRAM = 4
MOST_WINDOWS = 2_000_000

RESULT = "doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _result(docs: DataFrame) -> str:
    return RESULT.format(kind=docs.schema["doc_id"].dataType.simpleString())


def winnow(hashes: np.ndarray, room: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Places of the grams that winnowing keeps: the least of each window of one text."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    grams = window_hashes(hashes, gram)
    bits = np.uint64(max(21, len(grams).bit_length()))
    tagged = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(tagged, window - gram + 1)
    least = least[room[: len(least)] >= window]
    least = least[np.append(True, least[1:] != least[:-1])] if len(least) else least
    return np.unique((least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))


@dataclass
class Items:
    """Windows of benchmark items: sorted hashes, and for each the items and places that have it."""

    words: np.ndarray  # word hashes of all items
    grams: np.ndarray  # sorted fingerprints
    hashes: dict[int, np.ndarray]  # by length: sorted window hashes
    places: dict[int, np.ndarray]  # first word of each
    owners: dict[int, np.ndarray]  # number of its item
    ids: list  # item_id by number

    @classmethod
    def of(cls, ids: list, texts: pa.Array, window: int, gram: int) -> Items:
        data, at = text_bytes(texts)
        words = Words(data, at, ALPHANUMERIC, lower=True)
        count, room, document = np.diff(words.first), words.room(), words.document
        hashes, places, owners = {}, {}, {}
        for length in sorted({min(int(n), window) for n in count if n}):
            windows = window_hashes(words.hashes, length)
            mine = (room[: len(windows)] >= length) & ((count[document[: len(windows)]] == length) | (length == window))
            place = np.flatnonzero(mine)
            order = np.argsort(windows[place], kind="stable")
            hashes[length], places[length], owners[length] = windows[place][order], place[order], document[place][order]
        kept = winnow(words.hashes, room, window, gram)
        grams = np.unique(window_hashes(words.hashes, gram)[kept]) if len(kept) else np.zeros(0, np.uint64)
        return cls(words.hashes, grams, hashes, places, owners, ids)


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array, most being ruled out by a table of their top bits."""
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    seen = np.zeros(1 << 16, bool)
    seen[(known >> np.uint64(48)).astype(np.int64)] = True
    out = seen[(values >> np.uint64(48)).astype(np.int64)]
    some = np.flatnonzero(out)
    at = np.minimum(np.searchsorted(known, values[some]), len(known) - 1)
    out[some] = known[at] == values[some]
    return out


def _extend(words: Words, starts: np.ndarray, length: int, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows that start at these words, those that an item has: their places and item numbers."""
    known = items.hashes.get(length)
    windows = window_hashes(words.hashes, length)
    starts = starts[member(windows[starts], known)] if known is not None else starts[:0]
    if not len(starts):
        return starts, starts
    low, high = np.searchsorted(known, windows[starts]), np.searchsorted(known, windows[starts], "right")
    again, entry = np.repeat(starts, high - low), ragged(low, high - low)
    place = items.places[length][entry]
    same = np.ones(len(again), bool)
    for i in range(length):
        same &= words.hashes[again + i] == items.words[place + i]
    return again[same], items.owners[length][entry][same]


def hits(words: Words, items: Items, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mask of hit words of a piece, and pairs of document number and item number."""
    room, mask = words.room(), np.zeros(len(words), bool)
    pairs = []
    for length in items.hashes:
        if length == window:
            kept = winnow(words.hashes, room, window, gram)
            kept = kept[member(window_hashes(words.hashes, gram)[kept], items.grams)] if len(kept) else kept
            around = (kept[:, None] - np.arange(window - gram + 1)).ravel()
            starts = np.unique(around[around >= 0])
        else:
            windows = window_hashes(words.hashes, length)
            starts = np.flatnonzero(member(windows, items.hashes[length]))
        starts = starts[room[starts] >= length]
        if not len(starts):
            continue
        places, owners = _extend(words, starts, length, items)
        if len(places):
            mask |= covered(len(words), np.unique(places), length)
            pairs.append(np.stack((words.document[places], owners)))
    pairs = np.unique(np.concatenate(pairs, axis=1), axis=1) if pairs else np.zeros((2, 0), np.int64)
    return mask, pairs[0], pairs[1]


def judge(ids: pa.Array, texts: pa.Array, items: Items, window: int, gram: int) -> pa.RecordBatch:
    data, at = text_bytes(texts)
    n_words, n_hit, found = [], [], {}
    for i, _, d, a in pieces(data, at):
        words = Words(d, a, ALPHANUMERIC, lower=True)
        mask, document, item = hits(words, items, window, gram)
        n_words.append(np.diff(words.first))
        n_hit.append(np.diff(np.concatenate(([0], np.cumsum(mask)))[words.first]))
        for doc, k in zip(document.tolist(), item.tolist()):
            found.setdefault(doc + i, set()).add(str(items.ids[k]))
    n_words, n_hit = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (n_words, n_hit))
    none = hashlib.sha256(b"").hexdigest()
    digests = [hashlib.sha256(",".join(sorted(found[i])).encode()).hexdigest() if i in found else none for i in range(len(ids))]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words), pa.array(n_hit), pa.array([len(found.get(i, ())) for i in range(len(ids))], pa.int64()), pa.array(digests), pa.array((n_hit > 0) & (20 * n_hit >= n_words))],
        [x.split()[0] for x in RESULT.split(", ")],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    docs = tasks.texts(docs)
    items = benchmark.select("item_id", "text").filter("text <> ''")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # an item has at most a word for every two bytes, and no more windows than words
    return (_broadcast if size // 2 <= most_windows else _joined)(docs, items, window, gram)


def _broadcast(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    rows = items.collect()  # bounded: see most_windows
    known = docs.sparkSession.sparkContext.broadcast(
        Items.of([r.item_id for r in rows], pa.array([r.text for r in rows], pa.string()), window, gram)
    )
    return tasks.per_batch(docs, lambda b: judge(b["doc_id"], b["text"], known.value, window, gram), _result(docs))


def _prints(df: DataFrame, key: str, window: int, gram: int, short: list[int] | None) -> DataFrame:
    """``key, length, print, place``: winnowed grams (length ``window``) and whole runs of fewer words.

    Items give a run only if it is the whole of them; documents give those of the lengths asked for.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = text_bytes(batch["text"])
        keys, lengths, prints, places = [], [], [], []
        own = batch[key].to_numpy(zero_copy_only=False)
        for i, _, d, a in pieces(data, at):
            words = Words(d, a, ALPHANUMERIC, lower=True)
            room, document, count = words.room(), words.document, np.diff(words.first)
            kept = winnow(words.hashes, room, window, gram)
            got = [(window, kept, window_hashes(words.hashes, gram)[kept] if len(kept) else np.zeros(0, np.uint64))]
            for length in range(1, window) if short is None else short:
                windows = window_hashes(words.hashes, length)
                mine = room[: len(windows)] >= length
                if short is None:
                    mine &= count[document[: len(windows)]] == length
                place = np.flatnonzero(mine)
                got.append((length, place, windows[place]))
            for length, place, values in got:
                keys.append(own[document[place] + i])
                lengths.append(np.full(len(place), length, np.int32))
                prints.append(values.view(np.int64))
                places.append((place - words.first[document[place]]).astype(np.int32))
        empty = (np.zeros(0, object), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32))
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int32())
        arrays = [pa.array(np.concatenate([e, *x]), t) for e, x, t in zip(empty, (keys, lengths, prints, places), kinds)]
        return pa.RecordBatch.from_arrays(arrays, [key, "length", "print", "place"])

    return tasks.per_batch(df, each, f"{key} string, length int, print long, place int")


def _digests(words: Words, spans: list[tuple[int, int]]) -> list[bytes]:
    """Digest of the words of each span of first word and length."""
    data, starts, ends = words.data, words.starts.tolist(), words.ends.tolist()
    digest = xxhash.xxh3_128_digest
    return [digest(b" ".join(data[starts[k] : ends[k]].tobytes() for k in range(i, i + n))) for i, n in spans]


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item_id, digest`` of every window of every item, each once."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, digests = [], []
        for item_id, text in zip(batch["item_id"].to_pylist(), batch["text"]):
            words = Words(*text_bytes(pa.array([text])), ALPHANUMERIC, lower=True)
            length = min(len(words), window)
            found = set(_digests(words, [(i, length) for i in range(len(words) - length + 1)] if length else []))
            ids += [item_id] * len(found)
            digests += found
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(digests, pa.binary())], ["item_id", "digest"])

    return tasks.per_batch(items, each, "item_id string, digest binary").distinct()


def _around(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``row, start, length, digest`` of the windows around the fingerprints (``prints``) of each document."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [])
        for row, text, prints in zip(batch["row"].to_pylist(), batch["text"], batch["prints"].to_pylist()):
            words = Words(*text_bytes(pa.array([text])), ALPHANUMERIC, lower=True)
            spans = set()
            for p in prints:
                back = window - gram if p["length"] == window else 0
                spans.update((i, p["length"]) for i in range(p["place"] - back, p["place"] + 1) if 0 <= i <= len(words) - p["length"])
            spans = sorted(spans)
            for column, values in zip(out, ([row] * len(spans), [i for i, _ in spans], [n for _, n in spans], _digests(words, spans))):
                column += values
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["row", "start", "length", "digest"])

    return tasks.per_batch(docs, each, "row string, start int, length int, digest binary")


def _joined(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """The same for a benchmark of any size.

    Documents' fingerprints that an item has are found by a semi join, so that a gram in many documents and many
    items makes no pairs; the windows around them then meet the items' windows by a 128-bit digest of the words.
    What a document gathers is bounded by its own words and by the items that it holds.
    """
    docs = docs.withColumn("row", row_id())
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("None")).alias("item_id"), "text")
    theirs = _prints(items.select(F.col("item_id").alias("item"), "text"), "item", window, gram, None)
    theirs = session.stage(theirs.select("length", "print").distinct(), "item-prints")
    short = [r.length for r in theirs.filter(F.col("length") < window).select("length").distinct().collect()]
    ours = _prints(docs.select("row", "text"), "row", window, gram, sorted(short))
    common = ours.join(theirs, ["length", "print"], "left_semi").groupBy("row").agg(F.collect_set(F.struct("length", "place")).alias("prints"))
    met = docs.join(common, "row").dropDuplicates(["row"]).select("row", "text", "prints")
    hits = session.stage(_around(met, window, gram).join(_item_windows(items, window), "digest").drop("digest"), "benchmark-hits")
    spans = hits.groupBy("row").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("item_id").alias("items"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [])
        for text, spans, items in zip(batch["text"], batch["spans"].to_pylist(), batch["items"].to_pylist()):
            n = len(Words(*text_bytes(pa.array([text], batch["text"].type)), ALPHANUMERIC, lower=True))
            starts, lengths = (np.array([s[k] for s in spans or ()], np.int64) for k in ("start", "length"))
            hit = int(covered(n, starts, lengths).sum())
            digest = hashlib.sha256(",".join(sorted(items or ())).encode()).hexdigest()
            for column, value in zip(out, (n, hit, len(items or ()), digest, hit > 0 and 20 * hit >= n)):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        arrays = [batch["doc_id"], *[pa.array(c, t) for c, t in zip(out, kinds)]]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in RESULT.split(", ")])

    return tasks.per_batch(docs.join(spans, "row", "left").select("doc_id", "text", "spans", "items"), each, _result(docs))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without the contaminated ones.

    Each row is judged by its own text, whatever other rows have its ``doc_id``, and a null one is judged too.
    """
    uid = tasks.unused("uid", docs.columns)
    source = docs.withColumn(uid, row_id())
    judged = contamination(source.select(F.col(uid).alias("doc_id"), "text"), benchmark, **options)
    found = session.stage(judged.filter("contaminated").select(F.col("doc_id").alias(uid)).distinct(), "contaminated")
    clean, likely = parted(source, found, uid)
    return clean.unionByName(likely.join(found, uid, "left_anti").select(clean.columns)).select(docs.columns)
