"""Every operator against brute force, on the small tables and on the odd cases."""

from __future__ import annotations

import hashlib
import math
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from conftest_texts import TEXTS
from pyspark.sql import functions as F

from parcelmill.llm import backoff, exact, licences, lines, packing, personal, quality, queries, simhash, substrings, winnowing


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


@pytest.fixture(params=["odd", "documents"])
def docs(request):
    return request.getfixturevalue(request.param)


def test_no_rows(none, spark):
    bench = none.select(F.col("doc_id").alias("item_id"), "text")
    labels = none.select("doc_id", F.lit(1).alias("quality"))
    results = [
        personal.digest_rows(personal.personal_data(none)), simhash.near_duplicates(none), substrings.without_repeats(none),
        backoff.scores(none, F.lit(True)), licences.licences(none), quality.scores(none, quality.train(none, labels, F.lit(True))),
        winnowing.contamination(none, bench), exact.exact_duplicates(none), lines.clean_runs(none), packing.pack(none),
        simhash.keep_one(none), winnowing.without_contaminated(none, bench),
    ]
    assert [df.count() for df in results] == [0] * len(results)


# --- 1: personal data


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    forms = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for k, (kind, form) in enumerate(forms.items()):
        for m in re.finditer(form, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            odd = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
            good = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and sum(odd) % 10 == 0, "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans(docs):
    expected = []
    for doc_id, text in pairs(docs):
        spans = plain_spans(text or "")
        many = Counter(k for k, _, _ in spans)
        expected.append((doc_id, *[many[k] for k in personal.KINDS], sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))))
    same(personal.digest_rows(personal.personal_data(docs)).drop("spans").collect(), expected)


@pytest.mark.parametrize("text", ["a@b@c.dd.ee@f.gg", "..@a.b-", "1.2.3.4.5.6.7.8", "+1+12 345 67890 (", "0" * 50 + ".1.1.1", "9" * 3000 + "@", "a@b." * 50])
def test_span_edges(text):
    assert personal.base_spans(text)[0] == plain_spans(text)


def test_patterns_discover(spark):
    """A context that stands around enough known numbers gives away an identifier of no base form."""
    rows = [(i, f"zz my account is 10.0.0.{i} please note") for i in range(8)] + [(50, "well my account is AB12-99887 please note")]
    found = personal.digest_rows(personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {r.doc_id: r.spans for r in found.collect()}[50] == "ip:19:29"
    bad = [(i, f"zz my account is 300.0.0.{i} please note") for i in range(20, 40)]
    found = personal.digest_rows(personal.personal_data(spark.createDataFrame(rows + bad, "doc_id long, text string")))
    assert {r.doc_id: r.spans for r in found.collect()}[50] == ""


@pytest.mark.parametrize("form", ["Kundennummer lautet {}", "account {} noted here", "{} is mine", "well {}", "one {} " + "long" * 30])
def test_patterns_at_the_edges_of_a_text(spark, form):
    """Identifiers that begin or end a text, and long neighbours, give patterns too."""
    rows = [(i, form.format(f"10.0.0.{i}")) for i in range(8)] + [(50, form.format("AB12-99887"))]
    found = personal.digest_rows(personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")))
    at = form.index("{")
    assert {r.doc_id: r.spans for r in found.collect()}[50] == f"ip:{at}:{at + 10}"


# --- 2: SimHash


def fingerprint(text: str | None) -> int:
    w = words(lower(text))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_near_duplicates(docs):
    rows = [(d, fingerprint(t)) for d, t in pairs(docs)]
    prints = list({f for _, f in rows})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for d, f in rows:
        if d is not None:
            least[find(f)] = d if least[find(f)] is None else min(d, least[find(f)])
    expected = [(d, f, least[find(f)]) for d, f in rows]
    for segments in (3, 2):
        got = simhash.near_duplicates(docs, segments=segments).collect()
        same([(r.doc_id, r.fp % 2**64, r.component_id) for r in got], expected)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    same(kept.select("doc_id").collect(), [(d,) for d, f in rows if d is None or d == least[find(f)]])


# --- 3: substrings


@pytest.mark.parametrize("hot", [20_000, 0])
def test_without_repeats(docs, hot):
    rows = [(d, words(t)) for d, t in pairs(docs)]
    for length in (35, 7):
        seen = Counter(tuple(w[i : i + length]) for _, w in rows for i in range(len(w) - length + 1))
        expected = []
        for d, w in rows:
            gone = set()
            for i in range(len(w) - length + 1):
                if seen[tuple(w[i : i + length])] > 1:
                    gone.update(range(i, i + length))
            expected.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
        same(substrings.without_repeats(docs, length=length, gram=min(6, length - 2), hot_segments=hot).collect(), expected)


@pytest.mark.parametrize("hot", [20_000, 0])
def test_repeated_rows_add_no_marks(spark, hot, monkeypatch):
    """Repeated rows are searched once, and each marked window reaches their text once."""
    passage, searched = " ".join(f"p{i}" for i in range(60)), []
    rows = [(1, f"left {passage} right")] * 30 + [(None, f"up {passage} down")] * 20 + [(2, f"so {passage} on"), (3, "short")]
    with_text = substrings._with_text

    def seen(*args):
        searched.append(with_text(*args))
        return searched[-1]

    monkeypatch.setattr(substrings, "_with_text", seen)
    kept = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), hot_segments=hot)
    same([(r.doc_id, r.n_removed, r.kept) for r in kept.collect()], [(1, 62, "")] * 30 + [(None, 62, "")] * 20 + [(2, 60, "so on"), (3, 0, "short")])
    assert all(r["count"] == 1 for df in searched for r in df.groupBy("anchor", "seg").count().collect()) and searched[0].count()


# --- 4: language model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(docs, order):
    rows = [(d, words(lower(t)) + [None]) for d, t in pairs(docs)]
    learned = [t for d, t in rows if zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2]
    seen = Counter(tuple(t[i : i + n]) for t in learned for n in range(1, order + 1) for i in range(len(t) - n + 1))
    n, v = sum(len(t) for t in learned), len({k for k in seen if len(k) == 1})
    expected = []
    for d, t in rows:
        base = total = 0.0
        for i, w in enumerate(t):
            p = (seen[(w,)] + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(1, min(order, i + 1)):
                h = tuple(t[i - k : i])
                if seen[h]:
                    p = (seen[(*h, w)] + 4 * p) / (seen[h] + 4)
            total += math.log10(p)
        held = zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
        expected.append((d, held, len(t), sum(seen[(w,)] > 0 for w in t), n, base, total))
    got = backoff.scores(docs, queries.remainder(7) != 2, order=order).collect()
    got, expected = (sorted(map(tuple, x), key=lambda r: key((*r[:4], round(r[5], 6)))) for x in (got, expected))
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_automaton_walks(order):
    """States, arcs and failures against the smoothed probabilities; stretches change nothing."""
    rng = np.random.default_rng(order)
    texts = [rng.zipf(1.4, n) % 30 for n in (1, 2, 5, 400, 90)]
    stream, first = np.concatenate(texts).astype(np.uint64), np.cumsum([0, *map(len, texts)])
    taught = [t[: len(t) // 2].tolist() for t in texts]
    seen = Counter(tuple(t[i : i + n]) for t in taught for n in range(1, order + 1) for i in range(len(t) - n + 1))
    levels = []
    for n in range(1, order + 1):
        grams, last = backoff.ngrams(stream, first, n)
        _, place, inverse = np.unique(grams, return_index=True, return_inverse=True)
        at = np.full(len(stream), -1)
        at[last] = inverse
        counts = [seen[tuple(stream[p - n + 1 : p + 1].astype(int).tolist())] for p in last[place]]
        levels.append(backoff.Grams(at, np.array(counts), last[place]))
    total, distinct = sum(map(len, taught)), sum(len(k) == 1 for k in seen)
    model = backoff.automaton(levels, 4.0, total, distinct)
    assert len(model.fail) == 1 + sum(len(k) < order for k in seen)  # each known shorter n-gram is a state, and the empty one
    expected = []
    for t in texts:
        score = 0.0
        for i, w in enumerate(t.tolist()):
            p = (seen[(w,)] + 1) / (total + distinct + 1)
            for k in range(1, min(order, i + 1)):
                h = tuple(t[i - k : i].tolist())
                if seen[h]:
                    p = (seen[(*h, w)] + 4 * p) / (seen[h] + 4)
            score += math.log10(p)
        expected.append(score)
    for stretch in (1, 3, 64, 1024):
        assert backoff.walk(model, levels[0].at, first, order, stretch) == pytest.approx(expected, rel=1e-9)


# --- 5: licences


def test_licences(odd):
    got = {r.doc_id: (r.sentence_ids, r.licences) for r in licences.licences(odd).collect()}
    assert got[13] == (["mit-released"], ["MIT"])
    assert got[14] == (["mit-permission", "mit-condition"], ["MIT"])
    assert got[0] == got[1] == got[7] == ([], [])


def test_licence_rules(spark):
    """A longer rule stands for those it contains; a broken sequence gives only its parts; order counts."""
    s = licences.SENTENCES
    cases = {
        1: "\n".join(s[k] for k in ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-name")),
        2: "\n".join(s[k] for k in ("bsd-redistribution", "bsd-source", "bsd-binary")),
        3: "\n".join(s[k] for k in ("bsd-source", "bsd-redistribution", "bsd-binary")),
        4: f"Some words. {s['ccbync4'].upper()} More.\n{s['apache2-under']}\n{s['apache2-under']}",
    }
    got = licences.licences(spark.createDataFrame(list(cases.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in got} == {1: ["BSD-3-Clause"], 2: ["BSD-2-Clause"], 3: [], 4: ["Apache-2.0", "CC-BY-NC-4.0"]}


NOTICES = {
    "MIT": """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
""",
    "LGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.
""",
    "Zlib": """Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.
""",
    "EPL-2.0": """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt or copy at
         https://www.boost.org/LICENSE_1_0.txt)
""",
}


def licence_rows() -> list[tuple[int, str, str]]:
    """Each notice as it is, in comments, unwrapped and wrapped elsewhere; pairs of differently wrapped ones."""
    out = []
    for name, text in NOTICES.items():
        blocks = [" ".join(b.split()) for b in text.split("\n\n")]
        narrow = "\n\n".join(textwrap.fill(b, 31, break_long_words=False) for b in blocks)
        shapes = [text, textwrap.indent(text, "// ", lambda line: True), textwrap.indent(text, " * "), "\n".join(blocks), narrow, narrow.replace("\n", "\r\n")]
        out += [(f"{name}", shape) for shape in shapes]
    names = list(NOTICES)
    for one, other in zip(names, names[1:]):
        flat = "\n".join(" ".join(b.split()) for b in NOTICES[one].split("\n\n"))
        out += [(f"{one},{other}", f"{flat}\nsome words\n{NOTICES[other]}"), (f"{one},{other}", f"{NOTICES[other]}\nsome words\n{flat}")]
    out += [("", t) for t in ("", "\n\n", "Released under the", "MIT License. " * 3, "xLicensed under CC BY 4.0.", "E Licensed L under CC BY 4.0.")]
    return [(i, name, text) for i, (name, text) in enumerate(out)]


def test_licences_however_wrapped(spark):
    """Notices are known whatever their line ends, beside others of another wrapping, and DuckDB gives the same rows."""
    rows = licence_rows()
    docs = spark.createDataFrame([(i, t) for i, _, t in rows] + [(None, None)], "doc_id long, text string")
    got = licences.licences(docs).collect()
    assert {r.doc_id: set(r.licences) for r in got if r.doc_id is not None} == {i: set(filter(None, name.split(","))) for i, name, _ in rows}
    texts_table = docs.toPandas()
    with duckdb.connect() as con:
        con.register("documents", texts_table)
        plain = con.execute(licences.oracle()).fetchall()
    same([(r.doc_id, ",".join(r.sentence_ids), ",".join(r.licences)) for r in got], [(None if d is None or d != d else int(d), s, n) for d, s, n in plain])


def test_published_notices(spark):
    """The notices as they are published, with their line ends."""
    rows = [(i, name, text) for i, (name, text) in enumerate(NOTICES.items())]
    got = licences.licences(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).collect()
    assert {r.doc_id: r.licences for r in got} == {i: [name] for i, name, _ in rows}
    assert {r.doc_id: r.sentence_ids for r in got}[1] == ["apache2-notice", "apache2-use", "apache2-copy"]


def test_licences_stay_in_the_engine(documents):
    plan = licences.licences(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 6: quality


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.QUERIES["op6_quality_classifier"](spark, sf)
    right = scored.filter("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95


def test_quality_gradients():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality.FEATURES)).astype(np.float32) for n in (1, 3, 2)]
    y, first, x = np.array([1.0, 0.0, 1.0]), np.array([0, 1, 4, 6]), np.concatenate(bags).astype(float)
    model = quality.fit(bags, y, rounds=1)

    def loss():
        p = model.forward(x, first)[0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    score, got = model.forward(x, first)
    for name, g in quality._gradients(model, score, got, first, y).items():
        part = model.parts[name]
        at = np.unravel_index(rng.integers(part.size), part.shape) if part.shape else ()
        kept = part[at].copy()
        part[at] = kept + 1e-5
        high = loss()
        part[at] = kept - 1e-5
        low = loss()
        part[at] = kept
        assert np.asarray(g)[at] == pytest.approx((high - low) / 2e-5, rel=1e-3, abs=1e-7), name


def test_quality_odd_cases(odd):
    labels = odd.select("doc_id", F.when(F.col("doc_id") > 8, 1).when(F.col("doc_id") > 1, 0).alias("quality"))
    model = quality.train(odd, labels, F.lit(True))
    rows = quality.scores(odd, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    kept = quality.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.score >= quality.THRESHOLD for r in rows)


def test_training_places_are_spread():
    assert quality.spread(3, 8).tolist() == [3, 4, 5, 6, 7]
    assert quality.spread(10, 30, 4).tolist() == [10, 15, 20, 25]


# --- 7: contamination


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_contamination(docs, spark, sf, most):
    item = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    extra = [(900, "ONE"), (901, "one"), (900, "x y"), (902, None), (903, "..."), (904, " ".join(f"Word{i}" for i in range(20))), (905, "word11, word12 tail"), (906, "no id")]
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").unionByName(spark.createDataFrame(extra, "item_id long, text string"))
    windows = defaultdict(set)
    for r in bench.collect():
        w = item.findall(lower(r.text))
        size = min(13, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows[tuple(w[i : i + size])].add(str(r.item_id))
    expected = []
    for d, text in pairs(docs):
        w, hit, items = item.findall(lower(text)), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[i : i + size])):
                    items |= owners
                    hit.update(range(i, i + size))
        expected.append((d, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(w)))
    same(winnowing.contamination(docs, bench, most_windows=most).collect(), expected)


# --- 8: exact duplicates


@pytest.mark.parametrize("counters", [256, 3])
def test_exact_duplicates(docs, counters):
    rows = [(d, t or "") for d, t in pairs(docs)]
    groups = defaultdict(list)
    for d, t in rows:
        groups[t].append(d)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    same(exact.exact_duplicates(docs, counters).collect(), [(d, keep[t], len(groups[t]), d == keep[t], sha(t)) for d, t in rows])


def test_frequent_digests_are_found():
    """Merged summaries hold every value over the share they promise."""
    rng = np.random.default_rng(3)
    values = [str(x) for x in rng.zipf(1.3, 4000) % 500]
    held: dict = {}
    for i in range(0, 4000, 400):
        part = exact.reduce_counters(dict(Counter(values[i : i + 400])), 9)
        held = exact.reduce_counters(dict(Counter(held) + Counter(part)), 9)
    assert {v for v, n in Counter(values).items() if n > 400} <= set(held) and len(held) <= 9


# --- 9: lines


def test_clean_runs(docs):
    rows = sorted(set(pairs(docs)), key=lambda r: (r[0] is None, r[0] or 0))
    left = dict(zip(rows, without_runs([(d, t or "") for d, t in rows], 2)))
    got = lines.clean_runs(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    total = lambda t: 0 if t is None else t.count("\n") + 1
    expected = [(d, None if t is None else b"\n".join(left[d, t]).decode(), total(t), 0 if t is None else total(t) - len(left[d, t])) for d, t in pairs(docs)]
    same([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()], expected)


def test_clean_runs_clashing_columns(spark):
    rows = [(d, "a b\nc\n" * 9, 5, 6, 7, "g") for d in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, uid int, _UID int, gone string")
    same([(r.doc_id, r.n_lines) for r in lines.clean_runs(docs).collect()], [(1, 19), (2, 19)])
    plain = lines.clean_runs(docs, counts=False)
    assert plain.schema == docs.schema
    assert all((r.n_lines, r.uid, r._UID, r.gone) == (5, 6, 7, "g") for r in plain.collect())


def without_runs(rows: list[tuple[int, str]], least: int) -> list[list[bytes]]:
    """Lines left of texts in order, by comparing each run of lines with all that stand earlier."""
    cut, out = [t.encode().split(b"\n") for _, t in rows], []
    for k, own in enumerate(cut):
        gone = set()
        for a in range(len(own)):
            for j, other in enumerate(cut[: k + 1]):
                for b in range(len(other) if j < k else a):
                    n = 0
                    while a + n < len(own) and b + n < (len(other) if j < k else a) and own[a + n] == other[b + n]:
                        n += 1
                    if n >= least:
                        gone.update(range(a, a + n))
        out.append([x for i, x in enumerate(own) if i not in gone])
    return out


@pytest.mark.parametrize("least, every", [(2, 4), (3, 4), (2, 1), (2, 10**9)])
def test_repeated_runs_go_whole(spark, least, every):
    """Every line of every repeated run goes, with its head and tail, and no other; compared with all runs of lines."""
    rng = np.random.default_rng(7)
    texts = ["\n".join(f"line {x}" if x else "" for x in rng.zipf(1.3, rng.integers(1, 25)) % 40) for _ in range(60)]
    texts += ["a\na\na", "a\na\na\na\na", "p\nq\np\nq\np", "x\nhead\none\ntwo\ntail\ny", "z\nhead\none\ntwo\ntail\nw"]
    rows = list(enumerate(texts)) + [(None, texts[-1])]
    expected = without_runs(rows, least)
    got = lines.clean_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), least=least, every=every).collect()
    same(
        [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got],
        [(d, b"\n".join(x).decode(), t.count("\n") + 1, t.count("\n") + 1 - len(x)) for (d, t), x in zip(rows, expected)],
    )


def test_chunks_that_repeat_send_their_windows_once(spark, tmp_path, monkeypatch):
    """Copies of a passage add chunks, not windows, and go whole but for the first."""
    passage = "\n".join(f"line {i * i % 9973}" for i in range(300))
    docs = spark.createDataFrame([(d, passage) for d in range(40)], "doc_id long, text string").repartition(5)
    sizes, stage = {}, lines.session.stage

    def counted(df, label):
        out = stage(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(lines.session, "stage", counted)
    got = {r.doc_id: r for r in lines.clean_runs(docs).collect()}
    assert got[0].text == passage and all(got[d].text == "" and got[d].n_removed == 300 for d in range(1, 40))
    cuts = len(lines.with_ends(lines.cut(passage), 2, lines.SPAN, lines.EVERY))
    assert sizes["chunks"] == 40 * cuts and 299 <= sizes["windows"] < 299 + cuts


def test_runs_in_long_texts(spark):
    """A text of more than two megabytes, with runs that another has at other places."""
    body = [f"{i} of the long text {i * 7919 % 100003}" for i in range(90000)]
    other = ["new", *body[30000:30007], "own", *body[80000:80002], "last"]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(other)), (3, body[5])], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.clean_runs(docs).collect()}
    assert got[1][1] == 0 and len(got[1][0]) > 2 << 20 and got[2] == ("new\nown\nlast", 9) and got[3][1] == 0


def test_runs_of_shared_and_null_ids(spark):
    rows = [(1, "a\nb\nc"), (1, "x\na\nb"), (None, "u\nv\nk"), (None, "u\nv\nl"), (None, None)]
    got = lines.clean_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r.n_removed for r in got) == 4 and [r.n_removed for r in got if r.doc_id == 1 or r.text is None].count(2) == 1


def test_cuts_do_not_shift():
    """A line put in above leaves all later cuts where they were."""
    cut = [f"line {i * i % 97}".encode() for i in range(200)]
    ends = {b for _, b in lines.chunks(cut)}
    moved = {b - 1 for _, b in lines.chunks([b"new", *cut])}
    assert ends - {1, 2} <= moved | {1, 2} and len(ends) > 20


# --- 10: packing


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = Counter((d, t) for d, t in pairs(docs))
    for capacity in (4096, 64):
        expected = []
        for (d, t), n in texts.items():
            ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            for piece, a in enumerate(range(0, len(ids), capacity)):
                part = ids[a : a + capacity]
                expected += [(d, piece, a, len(part), zlib.crc32(part.tobytes()))] * n
        got = packing.pack(docs, capacity=capacity).collect()
        same([tuple(r)[:5] for r in got], expected)
        filled = defaultdict(list)
        for r in got:
            filled[r.sequence_id].append((r.offset, r.length))
        for places in filled.values():
            places.sort()
            assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
            assert sum(n for _, n in places) <= capacity
        assert len(filled) <= -(-sum(r.length for r in got) // capacity) + 2


@pytest.mark.parametrize("seed", range(4))
def test_plans_use_all_and_few(seed):
    rng = np.random.default_rng(seed)
    lengths = Counter((rng.integers(1, 101, 400) if seed % 2 else rng.geometric(0.1, 400).clip(1, 100)).tolist())
    patterns = packing.plan(lengths, 100)
    used = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= 100
        for x in pattern:
            used[x] += n
    assert used == lengths
    assert sum(n for _, n in patterns) <= -(-sum(k * n for k, n in lengths.items()) // 100) + (8 if seed % 2 else 1)
