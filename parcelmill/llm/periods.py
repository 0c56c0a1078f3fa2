"""Periodic runs of words in each text: all maximal repetitions of enough turns, from suffix trees.

For each stretch of words that can hold a run, Ukkonen's suffix trees of the stretch and of its reversal are built.
An Euler tour of each answers how far two places agree to the right and to the left (lowest common ancestor, constant
time). The root of each run that is least in rotation, a Lyndon word, is the longest Lyndon word that starts at some
place, in the order of words or the reversed one: it ends before the next smaller, or next greater, suffix. So the at
most two candidates of each place, extended to both sides, give every run with its smallest period.

What can hold a run is told beforehand, exactly: every three neighbouring words of a run of at least six words and four
turns stand again in it within a quarter of its length. Words that lie in no long enough stretch of such triples are
in no run, and aren't indexed. Triples are compared by hash, so a collision can only add words.

A task holds one stretch of one document at a time, with some hundreds of bytes a word.

Defined cases: words are runs without ASCII white space; a null or blank text has no words, no run, and collapses to
the empty text; repeated rows are treated each; a null ``doc_id`` is one like others; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.llm import tasks
from parcelmill.llm.suffix_tree import LongestCommon
from parcelmill.llm.words import Words, pieces, ragged, runs, text_bytes, window_hashes

TURNS = 4
LEAST = 6
TRIPLE = 3
PIECE_BYTES = 1 << 20

Source = Callable[[int | None, int], "np.ndarray | None"]


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """Of each place, the next place of a smaller rank, or the end."""
    out, stack = [0] * len(rank), []
    values = rank.tolist()
    for i in range(len(values) - 1, -1, -1):
        v = values[i]
        while stack and values[stack[-1]] > v:
            stack.pop()
        out[i] = stack[-1] if stack else len(values)
        stack.append(i)
    return np.array(out, np.int64)


def periodic_runs(words: list[int], turns: int = TURNS, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence of positive numbers, by start and period."""
    n = len(words)
    if n < max(least, turns):
        return []
    right, left = LongestCommon(words), LongestCommon(words[::-1])
    rank = right.rank[:n]  # the end is smaller than every suffix
    place = np.arange(n)
    greater = next_smaller(-rank)
    candidates = [(place, next_smaller(rank) - place), (place[greater < n], (greater - place)[greater < n])]
    found = set()
    for at, period in candidates:
        short = turns * period <= n
        at, period = at[short], period[short]
        end = at + period
        ahead = np.where(end < n, right(at, np.minimum(end, n)), 0)
        # the suffix of the reversal that reads leftwards from before a place
        behind = np.zeros(len(at), np.int64)
        inner = np.flatnonzero(at > 0)
        behind[inner] = left(n - at[inner], n - end[inner])
        length = ahead + behind + period
        good = length >= np.maximum(least, turns * period)
        found.update(zip((at - behind)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, first: np.ndarray, turns: int = TURNS, least: int = LEAST) -> list[tuple[int, int]]:
    """Starts and ends of the words that can hold runs, by the hashes of the words of some documents."""
    n = len(hashes)
    if n < TRIPLE:
        return []
    grams = window_hashes(hashes, TRIPLE)
    document = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = document[TRIPLE - 1 :] == document[: len(grams)]
    order = np.lexsort((np.arange(len(grams)), grams))
    again = (grams[order][1:] == grams[order][:-1]) & (document[order][1:] == document[order][:-1])
    gap = np.full(len(grams), n, np.int64)  # to the nearest equal triple of the document
    step = order[1:] - order[:-1]
    gap[order[:-1][again]] = step[again]
    gap[order[1:][again]] = np.minimum(gap[order[1:][again]], step[again])
    mask = whole & (gap < n)
    while True:
        starts, ends = runs(mask)  # no triple over the edge of a document is set
        length = ends - starts + TRIPLE - 1  # words
        enough = length >= least
        starts, ends, length = starts[enough], ends[enough], length[enough]
        kept = np.zeros(len(grams), bool)
        inside = ragged(starts, ends - starts)
        kept[inside] = turns * gap[inside] <= np.repeat(length, ends - starts)
        if np.array_equal(kept, mask):
            return list(zip(starts.tolist(), (ends + TRIPLE - 1).tolist()))
        mask = kept


class Found:
    """Runs of one document, and its words that stay."""

    def __init__(self, n: int):
        self.runs: list[tuple[int, int, int]] = []
        self.dropped = np.zeros(n, bool)

    def add(self, start: int, found: list[tuple[int, int, int]]) -> None:
        for a, length, period in found:
            self.runs.append((start + a, length, period))
            self.dropped[start + a + period : start + a + length] = True


def documents(texts: pa.Array, ids: list, source: Source | None, turns: int, least: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Of each text: its runs, and the bytes of its words that stay, joined by one blank."""
    data, at = text_bytes(texts)
    for i, j, d, a in pieces(data, at, PIECE_BYTES):
        words = Words(d, a)
        first = words.first
        given = [source(doc_id, n) if source else None for doc_id, n in zip(ids[i:j], np.diff(first).tolist())]
        place = np.arange(len(words))
        for k, numbers in enumerate(given):
            if numbers is not None:
                place[first[k] : first[k + 1]] = first[k] + numbers
        hashes = words.hashes[place]
        by_document: dict[int, list[tuple[int, int]]] = {}
        spans = stretches(hashes, first, turns, least)
        owner = np.searchsorted(first, [s for s, _ in spans], "right") - 1
        for k, span in zip(owner.tolist(), spans):
            by_document.setdefault(k, []).append(span)
        for k in range(j - i):
            own = d[a[k] : a[k + 1]].tobytes().split()
            if given[k] is not None:
                own = [own[x] for x in given[k].tolist()]
            found = Found(len(own))
            for start, end in by_document.get(k, ()):
                start, end = start - int(first[k]), end - int(first[k])
                number: dict[bytes, int] = {}
                found.add(start, periodic_runs([number.setdefault(w, len(number) + 1) for w in own[start:end]], turns, least))
            if found.runs:
                own = [own[x] for x in np.flatnonzero(~found.dropped).tolist()]
            yield found.runs, b" ".join(own)


def collapsed(docs: DataFrame, turns: int = TURNS, least: int = LEAST, source=None) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row: its runs by start and period, and its words without what runs repeat.

    ``source(doc_id, n)`` may give the numbers of the words that stand at the places of a text of ``n`` words, or None.
    """

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, found, kept = batch["doc_id"].to_pylist(), [], []
        for runs_, text in documents(batch["text"], ids, source, turns, least):
            found.append([{"start": s, "length": n, "period": p} for s, n, p in runs_])
            kept.append(text)
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        arrays = [batch["doc_id"].cast(pa.int64()), pa.array(found, pa.list_(run)), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "runs", "collapsed"])

    kinds = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return tasks.per_batch(tasks.texts(docs), each, kinds)


def made_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """The words of one text in ten, by its id, with a tail that repeats its first part (a null id is as empty)."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    numbers = np.arange(n)
    numbers[a:] = a + (numbers[a:] - a) % p
    return numbers


def digest_rows(found: DataFrame) -> DataFrame:
    """The longest run and digests of all runs and of the collapsed text, per row of ``collapsed``."""
    longest = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), "
        "(best, r) -> if(best is null or r.length > best.length, r, best))"
    )  # the runs are in order of start and period, so the first of the longest stays
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    best = found.select("doc_id", "runs", "collapsed", longest.alias("best"), listed.alias("listed"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def oracle() -> str:
    """The same from all pairs of equal words: islands of pairs at one distance are runs if no shorter one covers them."""
    return rf"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                  list_reduce(flatten(list_transform(range(len(coalesce(doc_id::VARCHAR, ''))), lambda i: list_transform(range(8), lambda b: (ascii(substr(doc_id::VARCHAR, i::BIGINT + 1, 1)) >> b) & 1))),
                              lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT) AS c FROM documents),
x AS (SELECT doc_id, ws, len(ws) AS n, xor(coalesce(c, 4294967295), 4294967295) AS h FROM w),
y AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM x),
z AS (SELECT doc_id, n, a, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN ws[i + 1]
                  ELSE ws[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws FROM y),
o AS (SELECT doc_id, n, unnest(ws) AS w, unnest(range(n)) AS i FROM z),
e AS (SELECT s.doc_id, s.i, t.i - s.i AS q FROM o s JOIN o t ON s.doc_id = t.doc_id AND s.w = t.w AND t.i > s.i AND {TURNS} * (t.i - s.i) <= s.n),
j AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
k AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM j GROUP BY doc_id, q, island HAVING count(*) + q >= greatest({LEAST}, {TURNS} * q)),
r AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM k m WHERE m.doc_id = k.doc_id AND m.q < k.q AND m.s <= k.s AND m.s + m.len >= k.s + k.len)),
d AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM r),
left_ AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS kept FROM o ANTI JOIN d USING (doc_id, i) GROUP BY doc_id),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM r GROUP BY doc_id),
f AS (SELECT DISTINCT ON (doc_id) doc_id, s, len, q FROM r ORDER BY doc_id, len DESC, s, q)
SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, len::BIGINT AS length, q::BIGINT AS period,
       (1000 * len // q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN left_ USING (doc_id)"""
