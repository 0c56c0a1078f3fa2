"""Packing of tokenised documents into sequences of a fixed length, by exact complements.

Every document is tokenised, ended with one id and, where it is longer than a sequence, cut into pieces. What
is planned is the histogram of piece lengths, which has at most ``capacity`` entries however many pieces there
are. A plan is a list of patterns, multisets of lengths, each used as often as the counts allow: a new sequence
starts with the longest piece left, and its gap is filled exactly by one length, a pair or a triple whose sum is
looked up among the available ones; where there is none, the largest length that fits goes in first (best
fit) and the smaller gap is tried again. Pieces of a length are numbered in parallel, and each number has its
place in the plan.

Defined cases: a null or empty text is one piece that holds the end id; repeated rows are packed each; a null
``doc_id`` is packed like any other; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.words import LOWER, PIECE_BYTES, as_texts, pieces, ragged, text_bytes

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 800_000  # of one Python worker
RANK_ROWS = 500_000  # pieces of one length that one task numbers

# Between a letter and closing marks a token of the pre-tokenizer always ends, so the two may be looked up apart.
_MARKS = ".,!%$&*#"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of texts from a tokenizer that never joins over white space, with the ids of words kept.

    A word is looked up as a stem and the marks that close it. Stems of letters alone are one token of the
    pre-tokenizer each, whose last id ends a word, so many of them are encoded as one text.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.stem = self.marks = np.zeros(0, np.int32)  # of each word, its two parts
        self.parts: dict[str, int] = {"": 0}
        self.offset, self.length, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each part, and all ids."""
        if all(map(str.isalpha, parts)):
            ids = np.array(self.tokenizer.encode(" ".join(parts), add_special_tokens=False).ids, np.int32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(parts) and ends[-1] == len(ids):
                return np.diff(ends, prepend=0), ids
        got = [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        return np.array([len(x) for x in got], np.int64), np.array([i for x in got for i in x], np.int32)

    def _learn(self, words: list[str]) -> None:
        stems = [w.rstrip(_MARKS) for w in words]
        marks = [""] * len(words)
        for i, (w, stem) in enumerate(zip(words, stems)):
            if len(w) > len(stem):
                if stem and "a" <= stem[-1] <= "z":
                    marks[i] = w[len(stem) :]
                else:
                    stems[i] = w
        new = list(set(stems).union(marks).difference(self.parts))
        plain = [p.isalpha() for p in new]
        order = [i for i, p in enumerate(plain) if p] + [i for i, p in enumerate(plain) if not p]
        cut, lengths, ids = sum(plain), [np.zeros(0, np.int64)], [self.ids]
        for a, b in ((0, cut), (cut, len(new))):
            for i in range(a, b, 2000):
                n, got = self._encode_parts([new[j] for j in order[i : min(i + 2000, b)]])
                lengths.append(n), ids.append(got)
        self.parts.update(zip([new[i] for i in order], range(len(self.parts), len(self.parts) + len(new))))
        lengths = np.concatenate(lengths)
        self.offset = np.concatenate((self.offset, len(self.ids) + np.cumsum(lengths) - lengths))
        self.length = np.concatenate((self.length, lengths))
        self.ids = np.concatenate(ids)
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        look = self.parts.__getitem__
        self.stem = np.concatenate((self.stem, np.fromiter(map(look, stems), np.int32, len(words))))
        self.marks = np.concatenate((self.marks, np.fromiter(map(look, marks), np.int32, len(words))))

    def encode(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a piece, without special tokens around it."""
        texts = as_texts(data, at)
        # may hold a special token, which is found before case is lowered
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)).tolist()
        whole = {i: np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.int32) for i in special}
        lists = pc.ascii_split_whitespace(as_texts(LOWER[data], at))
        words = lists.offsets.to_numpy()
        coded = lists.values[words[0] : words[-1]].dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.words.get, distinct))
        if missing := [w for w, k in zip(distinct, known) if k is None]:
            if len(self.words) + len(missing) > self.most:
                self.forget()
                missing = distinct
            self._learn(missing)
            known = map(self.words.__getitem__, distinct)
        known = np.fromiter(known, np.int64, len(distinct))
        word = known[coded.indices.to_numpy()]
        parts = np.stack((self.stem[word], self.marks[word]), axis=1).ravel()
        lengths = self.length[parts]
        ids = self.ids[ragged(self.offset[parts], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[2 * (words - words[0])]
        return [whole[i] if i in whole else ids[ends[i] : ends[i + 1]] for i in range(len(at) - 1)]


@lru_cache(2)
def encoder(path: str, most: int) -> WordEncoder:
    return WordEncoder(path, most)


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, kept_words: int = CACHED_WORDS
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document.

    A worker keeps the ids of ``kept_words`` words at most; fewer take less memory and more time.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = ([], [], [], [], [])
        doc_ids = batch["doc_id"].to_pylist()
        for i, j, d, a in pieces(*text_bytes(batch["text"])):
            for doc_id, ids in zip(doc_ids[i:j], encoder(tokenizer, kept_words).encode(d, a)):
                ids = np.append(ids, end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for column, value in zip(out, (doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))):
                        column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [c.split()[0] for c in PIECE.split(", ")])

    return tasks.per_batch(tasks.texts(docs), each, PIECE)


def _exact(left: np.ndarray, gap: int) -> list[int]:
    """Lengths, three at most, that are available together and sum up to the gap; none if there are no such."""
    if left[gap]:
        return [gap]
    there = left > 0

    def pair(total: int, left: np.ndarray) -> list[int]:
        high = np.arange(total - 1, (total - 1) // 2, -1)
        good = there[high] & there[total - high] & ((high * 2 != total) | (left[high] > 1))
        at = int(good.argmax()) if len(good) else 0
        return [int(high[at]), total - int(high[at])] if len(good) and good[at] else []

    if found := pair(gap, left):
        return found
    size = 1 << (2 * gap + 1).bit_length()
    spectrum = np.fft.rfft(there[: gap + 1].astype(float), size)
    sums = np.fft.irfft(spectrum * spectrum, size)[: gap + 1] > 0.5  # what two available lengths sum up to
    for first in np.flatnonzero(there[1:gap] & sums[gap - 1 : 0 : -1])[::-1] + 1:
        rest = left.copy()
        rest[first] -= 1
        found = pair(gap - int(first), rest)
        if found and Counter([int(first), *found])[found[0]] <= left[found[0]] and Counter([int(first), *found])[found[1]] <= left[found[1]]:
            return [int(first), *found]
    return []


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns of lengths, longest first, and how many sequences have each."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    patterns = []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            spare, pattern, gap = left.copy(), [longest], capacity - longest
            spare[longest] -= 1
            while gap:
                if not (more := _exact(spare, gap)):
                    fits = np.flatnonzero(spare[: gap + 1])
                    more = [int(fits[-1])] if len(fits) else []
                if not more:
                    break
                for length in more:
                    spare[length] -= 1
                pattern += more
                gap -= sum(more)
            need = Counter(pattern)
            times = int(min(left[length] // n for length, n in need.items()))
            for length, n in need.items():
                left[length] -= times * n
            patterns.append((sorted(pattern, reverse=True), times))
    return patterns


def places(patterns: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each run of pieces of a length: where it starts, and the sequence and offset of its first piece."""
    given: Counter[int] = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, n in sorted(Counter(pattern).items(), reverse=True):
            rows.append((length, given[length], sequence, n, offset))
            given[length] += n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "each", "offset"), table.T))


PACKED = PIECE + ", sequence_id long, offset long"


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, kept_words: int = CACHED_WORDS
) -> DataFrame:
    """A row per piece: what it is, and the sequence and offset it was given."""
    pieces = session.stage(token_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, kept_words), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most one row per length
    spread = tasks.shares(max(histogram.values(), default=0), RANK_ROWS)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(spread)).cast("int")
    dealt = pieces.withColumn("bucket", bucket)
    before = dealt.groupBy("length", "bucket").count()
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(order) - 1).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    where = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))  # follows the lengths, not the rows

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = where.value
        length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
        run = np.searchsorted((at["length"] << 44) + at["rank"], (length << 44) + rank, "right") - 1
        nth = rank - at["rank"][run]
        sequence = at["sequence"][run] + nth // at["each"][run]
        offset = at["offset"][run] + nth % at["each"][run] * length
        columns = [c.split()[0] for c in PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([*[batch[c] for c in columns], pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    columns = [c.split()[0] for c in PIECE.split(", ")]
    return tasks.per_batch(ranked.select(*columns, F.col("rank").cast("long").alias("rank")), place, PACKED)
