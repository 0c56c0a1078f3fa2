"""Personal data: fixed forms, and identifiers that their contexts give away.

The base forms (e-mail, IP address, card and phone number) are found in every whole text. What is found seeds a
bootstrap: the words around an identifier are its patterns, and identifiers and patterns make a graph. Spark
scores it in rounds: a pattern is as trustworthy as the identifiers known among those it stands around, an
identifier as its best patterns. Candidates, words with digits that no base form claims, are taken where the
final score is high enough. Strings that look like a base form but fail its check (digits, Luhn, parts) count
against the patterns around them and are never taken.

Defined cases: a null text is empty and has no spans; positions are code points, ends exclusive; repeated rows
each get a row and count as separate occurrences, rows being known by 128 bits of id and text; a null ``doc_id`` is kept; other columns are ignored; no rows
give no rows; a corpus without base spans discovers nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill import session
from parcelmill.llm import tasks
from parcelmill.llm.membership import row_id

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
LEAST_SEEDS = 5  # different known identifiers that a pattern must stand around
TRUST = 0.8
LONG_WORD = 80
LOOKS_LIKE_CARD = 12  # digits; shorter numbers are no cards that fail, but candidates

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# the forms start at the first digit of a run of digits, as the leftmost match does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^ \t\n\r\f\v]+")
_CANDIDATE = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._:/@+-]*[A-Za-z0-9])?")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each at sign, so that long runs cost no more."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _checked(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(len(p) < 4 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in value.split(".")))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the base forms by start and kind, and those of matches that fail their check."""
    good = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    bad = []
    if _DIGIT.search(text):
        for kind, form in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            for m in form.finditer(text):
                if _checked(kind, m.group()):
                    good.append((kind, m.start(), m.end()))
                elif kind != "card" or sum(map(str.isdigit, m.group())) >= LOOKS_LIKE_CARD:
                    bad.append((kind, m.start(), m.end()))
    good.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return good, bad


class _Around:
    """Whole words of a text, to look up those before and after a span."""

    def __init__(self, text: str):
        self.text, self.words = text, [m.span() for m in re.finditer(r"\S+", text)]
        self.starts, self.ends = [a for a, _ in self.words], [b for _, b in self.words]

    def patterns(self, start: int, end: int) -> list[str]:
        """Lexical patterns around a span: two words before it, and one on each side.

        Beyond the start and end of the text stands an empty word, which no other equals; a pattern has one word at
        least. A word of more than ``LONG_WORD`` characters is written as its digest.
        """
        k, j = bisect_left(self.starts, start), bisect_right(self.ends, end)
        before = [self.text[a : min(b, start)] for a, b in self.words[max(0, k - 2) : k]]
        after = [self.text[max(a, end) : b] for a, b in self.words[j : j + 1]]
        clean = [re.sub(r"[0-9]", "9", w.lower()) for w in (*before, *after)]
        clean = [w if len(w) <= LONG_WORD else f"#{hashlib.sha256(w.encode()).hexdigest()}" for w in clean]
        clean = [""] * (2 - len(before)) + clean + [""] * (1 - len(after))
        pairs = ((clean[:2], f"{clean[0]} {clean[1]} _"), (clean[1:], f"{clean[1]} _ {clean[2]}"))
        return [p for words, p in pairs if any(words)]


def occurrences(text: str) -> list[tuple[str, str, int, int, list[str]]]:
    """Kind (``''`` unknown, ``'-'`` failed its check), value, span and patterns of identifiers and candidates."""
    good, bad = base_spans(text)
    taken = sorted((a, b) for _, a, b in (*good, *bad))
    around = _Around(text)
    out = [(k, text[a:b], a, b, around.patterns(a, b)) for k, a, b in good]
    out += [("-", text[a:b], a, b, around.patterns(a, b)) for _, a, b in bad]
    i = 0
    for m in _WORD.finditer(text):
        if not _DIGIT.search(m.group()):
            continue
        for c in _CANDIDATE.finditer(m.group()):
            a, b = m.start() + c.start(), m.start() + c.end()
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if b - a >= 6 and _DIGIT.search(c.group()) and not any(s < b and a < e for s, e in taken[i : i + 4]):
                out.append(("", c.group(), a, b, around.patterns(a, b)))
    return out


FOUND = "uid string, kind string, value string, start int, stop int, patterns array<string>"


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def discovered(seen: DataFrame, rounds: int = ROUNDS, least: int = LEAST_SEEDS, trust: float = TRUST) -> DataFrame:
    """``uid, kind, start, stop`` of candidates that trusted patterns stand around; input as ``FOUND``."""
    seen = session.stage(seen, "occurrences")
    edges = seen.select("kind", "value", F.explode("patterns").alias("pattern")).groupBy("pattern", "value", "kind").count()
    edges = session.stage(edges.select("pattern", "value", "kind"), "pattern-graph")
    # an identifier's score for each kind: seeds are sure, failed ones are sure to be none
    known = edges.filter("kind NOT IN ('', '-')").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    chosen = None
    for _ in range(rounds):
        scored = edges.select("pattern", "value").distinct().join(known.withColumnRenamed("kind", "as"), "value", "left")
        by_kind = scored.filter("as IS NOT NULL").groupBy("pattern", "as").agg(F.sum("score").alias("hits"))
        reach = edges.groupBy("pattern").agg(F.countDistinct("value").alias("values"))
        trusted = (
            by_kind.filter(F.col("hits") >= least)
            .join(reach, "pattern")
            .withColumn("trust", F.col("hits") / F.col("values"))
            .filter(F.col("trust") >= trust)
            .select("pattern", "as", "trust")
        )
        chosen = (
            edges.filter("kind = ''")
            .join(trusted, "pattern")
            .groupBy("value", F.col("as").alias("kind"))
            .agg(F.max("trust").alias("score"))
        )
        chosen = session.stage(chosen, "discovered")
        seeds = edges.filter("kind NOT IN ('', '-')").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
        known = seeds.unionByName(chosen)
    best = chosen.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best")).select("value", F.col("best.kind").alias("as"))
    return seen.filter("kind = ''").join(best, "value").select("uid", F.col("as").alias("kind"), "start", "stop")


def _spans(docs: DataFrame) -> DataFrame:
    """Base spans of every row, and its occurrences for the bootstrap."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, seen = [], []
        for text in batch["text"].to_pylist():
            found = occurrences(text) if text and ("@" in text or _DIGIT.search(text)) else []
            base.append([{"kind": k, "start": a, "stop": b} for k, _, a, b, _ in found if k in KINDS])
            seen.append([{"kind": k, "value": v, "start": a, "stop": b, "patterns": p} for k, v, a, b, p in found])
        span = [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]
        full = [("kind", pa.string()), ("value", pa.string()), *span[1:], ("patterns", pa.list_(pa.string()))]
        arrays = [batch["doc_id"].cast(pa.int64()), batch["uid"], pa.array(base, pa.list_(pa.struct(span))), pa.array(seen, pa.list_(pa.struct(full)))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "uid", "base", "seen"])

    return tasks.per_batch(
        tasks.texts(docs).select("doc_id", row_id().alias("uid"), "text"),
        each,
        "doc_id long, uid string, base array<struct<kind:string,start:int,stop:int>>, "
        "seen array<struct<kind:string,value:string,start:int,stop:int,patterns:array<string>>>",
    )


def personal_data(docs: DataFrame, rounds: int = ROUNDS, least: int = LEAST_SEEDS, trust: float = TRUST) -> DataFrame:
    """``doc_id, base, found``: arrays of spans (kind, start, stop), those of the base forms and those added."""
    spans = session.stage(_spans(docs), "spans")
    seen = spans.select("uid", F.explode("seen").alias("s")).select("uid", "s.*")
    more = discovered(seen, rounds, least, trust).distinct().groupBy("uid").agg(F.collect_list(F.struct("kind", "start", "stop")).alias("found"))
    return spans.select("doc_id", "uid", "base").join(more, "uid", "left").select("doc_id", "base", "found")


def digest_rows(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, ...] = tuple([] for _ in range(6))
        for base, added in zip(batch["base"].to_pylist(), batch["found"].to_pylist()):
            base = [(s["kind"], s["start"], s["stop"]) for s in base]
            added = [(s["kind"], s["start"], s["stop"]) for s in added or ()]
            for column, kind in zip(out, KINDS):
                column.append(sum(k == kind for k, _, _ in base))
            out[4].append(hashlib.sha256(_written(base).encode()).hexdigest())
            out[5].append(_written(base + added))
        arrays = [batch["doc_id"], *[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4]), pa.array(out[5], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return tasks.per_batch(found, each, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
