"""Periodic runs, collocations and mixing against brute force, on the small tables and on odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from conftest_texts import LONG, TEXTS
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from parcelmill.llm import mixing, periods, phrases
from parcelmill.llm.suffix_tree import LongestCommon

CLASH = ("no", "block", "place", "words", "start", "rank", "key", "runs", "size", "id", "chunk")
SCHEMA = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType())]
    + [StructField(c, IntegerType()) for c in CLASH]
)


@pytest.fixture(scope="module")
def strange(spark):
    """Every odd text with languages and sources, some null, and columns of clashing names."""
    more = [
        (20, "a b " * 9), (21, "x x x x x x x"), (22, "one two, one two, one two. " * 8), (23, "One two! one TWO? " * 6), (30, "go " * 40),
        (40, "p q r s t " * 7 + "p q u"), (None, "same row"), (None, "same row"), (None, "same row"), (50, "\x0b\x0c x\r\ty"),
    ]
    langs, sources = ["en", None, "de"], ["b", None, "a", "B", ""]
    rows = [(i, t, langs[k % 3], sources[k % 5], *[k] * len(CLASH)) for k, (i, t) in enumerate(TEXTS + more)]
    rows += [rows[-2], rows[-2]]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(params=["strange", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, expected), key=key)


def test_no_rows(strange):
    none = strange.limit(0)
    results = [periods.digest_rows(periods.collapsed(none)), phrases.collocations(none), mixing.taken(none)]
    assert [df.count() for df in results] == [0, 0, 0]


def test_only_nulls(spark):
    rows = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    same(mixing.taken(rows).collect(), [(None, 0, 0, 0.0, 0)] * 3)
    assert phrases.collocations(rows).count() == 0
    assert [r.n_runs for r in periods.digest_rows(periods.collapsed(rows)).collect()] == [0, 0, 0]


# --- periodic runs


def plain_runs(w: list, turns: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    out, n = [], len(w)
    for q in range(1, n // turns + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, turns * q):
                out.append((s, i - s + q, q))
    covered = lambda s, n, q: any(r < q and a <= s and a + m >= s + n for a, m, r in out)
    return sorted((r for r in out if not covered(*r)), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(20):
        w = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randint(1, 9)
            w[a:] = [w[a + (i - a) % p] if a + (i - a) % p < len(w) else 1 for i in range(a, len(w))]
        for turns, least in ((4, 6), (2, 2), (3, 5)):
            assert periods.periodic_runs(w, turns, least) == plain_runs(w, turns, least)
        order = LongestCommon(w)
        assert np.argsort(order.rank).tolist() == sorted(range(len(w) + 1), key=lambda i: w[i:])
        a, b = rng.randrange(len(w)), len(w)
        common = lambda x, y: next((k for k in range(len(w)) if x + k >= len(w) or y + k >= len(w) or w[x + k] != w[y + k]), 0)
        assert order(np.array([a]), np.array([b])).tolist() == [0]
        c = rng.randrange(len(w))
        assert a == c or order(np.array([a]), np.array([c])).tolist() == [common(a, c)]


def plain_row(doc_id, text, source=periods.made_periodic):
    w = words(text)
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if source and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), s, n, q, 1000 * n // q if found else None, sha(listed), sha(kept))


@pytest.mark.parametrize("source", [None, periods.made_periodic])
def test_runs(strange, source):
    rows = strange.select("doc_id", "text").collect()
    short = strange.filter("length(text) < 10000 OR text IS NULL")
    expected = [plain_row(r.doc_id, r.text, source) for r in rows if not r.text or len(r.text) < 10000]
    same(periods.digest_rows(periods.collapsed(short, source=source)).collect(), expected)


def test_one_long_run(spark):
    """A text of over 2 MB that is one run."""
    text = LONG * 35
    row = periods.collapsed(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(0, len(words(text)), 4)] and row.collapsed == "alpha beta gamma delta."


# --- collocations


def plain_collocations(rows, least=10, longest=3, absorbed=50, top=2000):
    sizes, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for n in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        scored = []
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in frequent.items():
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            longer = [b for q, b in frequent.items() if len(q) > len(p) and q.count(p[0]) and inside(q)] if len(p) < longest else []
            if not any(100 * b >= absorbed * a for b in longer):
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return out


@pytest.mark.parametrize("longest, blocks", [(2, 64), (3, 1 << 22), (4, 64)])
def test_collocations(strange, longest, blocks):
    rows = [(r.text, r.lang) for r in strange.collect()]
    got = phrases.collocations(strange, least=3, longest=longest, block_bytes=blocks, top=50)
    same(got.collect(), plain_collocations(rows, least=3, longest=longest, top=50))


def test_shards(strange):
    """Many small shards give what one gives."""
    one, many = (phrases.frequent_phrases(strange, least=3, shard_bytes=b)[0].collect() for b in (1 << 22, 5_000))
    same(one, many)


def test_words_that_share_a_hash(strange, monkeypatch):
    """Two words of one hash fail the job; they are never counted as one."""
    keys = phrases.word_keys
    monkeypatch.setattr(phrases, "word_keys", lambda words, seed: (keys(words, seed)[0] & np.uint64(1), keys(words, seed)[1]))
    batch = np.frombuffer(b"one two three four", np.uint8)
    with pytest.raises(ValueError, match="share a hash"):
        phrases._first_block(0, "en", batch, np.zeros(0, np.int64), 0)


# --- mixing


def plain_targets(sizes: dict, times: int = 3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped = set()
    while True:
        left = sum(sizes.values()) - sum(times * sizes[s] for s in capped)
        parts = sum(w for s, w in weights.items() if s not in capped)
        target = {s: Fraction(times * sizes[s]) if s in capped else Fraction(left * weights[s], parts) for s in names}
        above = {s for s in names if target[s] > times * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("block", [7, 1024])
def test_mixing(docs, block):
    got = mixing.taken(docs, block=block).collect()
    rows = docs.select("doc_id", "text", "source").collect()
    assert sorted(((r.doc_id, r.size) for r in got), key=key) == sorted(((r.doc_id, len(words(r.text))) for r in rows), key=key)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(words(r.text))
    targets = plain_targets(sizes)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_target[r.source_size, r.target] += r.taken
    expected = defaultdict(int)
    for s, t in targets.items():
        expected[sizes[s], float(t)] += int(t + Fraction(1, 2))
    assert by_target == expected
    same(got, mixing.taken(docs.repartition(5), block=block).collect())  # reruns agree


def test_schedule_is_spread(spark):
    """In every head of the schedule each source has its share, up to a few slots."""
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 200).alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    sources = mixing.targets(mixing.sizes(rows), block=50)
    slots = sorted(mixing.schedule(sources, 50).collect())
    want = {r.no: r.slots for r in sources.collect()}
    assert Counter(s.no for s in slots) == want and len({s.position for s in slots}) == len(slots)
    for head in range(1, len(slots), 37):
        seen = Counter(s.no for s in slots[:head])
        assert all(abs(seen[no] - head * n / len(slots)) < 12 for no, n in want.items())
    each = defaultdict(list)
    for s in slots:
        each[s.no].append((getattr(s, "pass"), s.block))
    assert all(x == sorted(x) for x in each.values())


def test_pieces_are_the_blocks(strange):
    """The pieces of a slot fill it without a gap, and lie in their documents."""
    sized, sources, pieces = mixing.mix(strange, block=16)
    limits = {(r.position): r.words for r in mixing.schedule(sources, 16).collect()}
    filled = Counter()
    for p in pieces.filter("position IS NOT NULL").collect():
        assert 0 <= p.skip and p.skip + p.words <= p.size
        filled[p.position] += p.words
    assert {p: n for p, n in limits.items() if n} == {p: n for p, n in filled.items() if n}


def test_a_phrase_worker_hands_back_what_a_group_took(monkeypatch):
    from parcelmill.llm import phrases

    seen, rows = [], object()
    monkeypatch.setattr(phrases.tasks, "release", lambda: seen.append(1))
    assert phrases._released(rows) is rows and seen == [1]
