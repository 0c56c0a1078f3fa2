"""The registered corpus queries and the pipeline, on the small tables."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmill.llm import minhash, queries, winnowing
from parcelmill.llm.quality import THRESHOLD, scores


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, sf, name):
    got = queries.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    expected = connection.sql(queries.ORACLES[name]).select(*columns).fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(expected)


@pytest.mark.parametrize("n", range(1, 11))
def test_one_query_an_operator(n):
    assert sum(bool(re.match(rf"op{n}_", name)) for name in queries.QUERIES) == 1


def test_stages(spark, sf):
    """Each stage keeps what it should of what its predecessor kept, with the columns of documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, docs
    texts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, sf).collect(), docs.schema)
        assert kept.columns == columns
        texts.append({r.doc_id: r.text for r in kept.collect()})
    model = queries.quality_model(spark, sf)
    good = {r.doc_id for r in scores(docs, model).collect() if r.score >= THRESHOLD}
    assert set(texts[0]) == good
    assert set(texts[1]) == good and any(texts[0][d] != texts[1][d] for d in good)
    assert set(texts[2]) < set(texts[1]) and all(texts[1][d] == t for d, t in texts[2].items())
    assert set(texts[3]) <= set(texts[2])
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf).collect()
    assert {r.doc_id for r in packed} == set(texts[3])
    whole = corpus_pipeline.run(spark, sf).collect()
    same = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert same(whole) == same(packed)
    load = defaultdict(int)
    for r in whole:
        load[r.sequence_id] += r.length
    assert max(load.values()) <= 4096


def test_near_copies_and_contamination_go(spark, sf):
    text = " ".join(f"plain{i} words{i * 7 % 31}" for i in range(300)) + "."
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    rows = [(1, text), (2, text), (3, text + " end."), (4, f"before {item} after"), (5, "quite other " * 3)]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()} == {1, 4, 5}
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, docs, sf).collect()} == {1, 2, 3, 5}


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def five(text: str | None) -> frozenset:
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def first_of_groups(rows: list[tuple[int, str]]) -> list[int]:
    """Smallest ids of the groups that similarities of 0.8 or more make, from all pairs."""
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    sets = [(d, five(t)) for d, t in rows]
    for i, (d, a) in enumerate(sets):
        for e, b in sets[:i]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(d), find(e)))
                root[y] = x
    return sorted({find(d) for d, _ in rows})


def test_near_copies_of_changed_words(spark, sf):
    """Copies with several words changed go, down to a similarity of 0.8, also along chains; compared with all pairs."""
    rng, rows = np.random.default_rng(5), []
    for _ in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for n in (0, 0, 1, 2, 3, 3, 4, 6, 9):
            words = list(words)
            for at in rng.choice(150, n, replace=False):
                words[at] = f"n{rng.integers(10**9)}"
            rows.append((int(rng.integers(10**9)), " ".join(words).upper() if n == 1 else " ".join(words)))
    rows += [(-1, "a b"), (-2, "A  b"), (-3, ""), (-4, None), (-5, "a c")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], COLUMNS).repartition(5)
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect())
    expected = first_of_groups(rows)
    assert got == expected and 20 < len(expected) < 80


def test_bitmaps_differ_no_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 700):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.int64))
        b = np.unique(np.concatenate([a[n // 4 :], rng.integers(0, 2**63, n // 3, dtype=np.int64)]))
        differ = sum(int(x).bit_count() for x in (minhash.folded(a) ^ minhash.folded(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b)) and len(minhash.folded(a)) == minhash.FOLD // 64
        assert n != 40 or differ > 0.8 * len(np.setxor1d(a, b))


def test_open_nodes_meet_by_rare_shingles(spark):
    """Sets of several components: every link is among the candidates, and hardly a pair that is none."""
    rng = np.random.default_rng(11)
    sets = []
    for _ in range(6):
        base = rng.integers(-(2**63), 2**63, 120, dtype=np.int64)
        for lost in (0, 3, 8, 12, 30, 45, 60):
            sets.append(np.unique(np.concatenate([base[lost:], rng.integers(-(2**63), 2**63, lost, dtype=np.int64)])))
    known = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "node long, shingles binary")
    open_ = known.select("node", F.col("node").alias("root"))
    alike = {
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
    }
    found = {(r.u, r.v) for r in minhash._across(open_, known, 80).collect()}
    assert alike <= found and len(found) < 2 * len(alike) and len(alike) > 15


def test_one_row_of_shared_and_null_ids_stays(spark, sf):
    text = " ".join(f"plain{i} words{i * 7 % 31}" for i in range(300))
    other = " ".join(f"some{i} text{i * 5 % 29}" for i in range(300))
    rows = [(1, text), (1, text), (None, text), (None, text + " end."), (2, text + " stop."), (None, other), (None, other + " end."), (3, "alone"), (3, "by itself"), (3, "alone")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], COLUMNS)
    got = sorted((r.doc_id or 0, r.text.split()[0]) for r in corpus_pipeline.near_dedup(spark, docs, sf).collect())
    assert got == [(0, "some0"), (1, "plain0"), (3, "alone"), (3, "by")]


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_contaminated_rows_of_shared_and_null_ids_go(spark, sf, most):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = bench.orderBy(F.length("text").desc()).first().text
    rows = [(None, f"before {item}"), (None, "clean without id"), (1, f"after {item}"), (1, "clean one"), (1, "clean one"), (2, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], COLUMNS)
    kept = winnowing.without_contaminated(docs, bench, most_windows=most)
    assert kept.schema == docs.schema
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(str(r) for r in rows if "fore" not in (r[1] or "") and "after" not in (r[1] or ""))
