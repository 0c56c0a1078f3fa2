"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of ``passage_words`` words is encoded by what its characters and
words look like; a gated attention gives each passage a weight, and the weighted mean of the passages' hidden
vectors gives the document's probability. Attention and classifier are learned together from document labels,
by gradient descent on a bounded sample of labelled documents (``sample`` of them, those whose ids hash
lowest, each by at most ``TRAIN_PASSAGES`` passages spread evenly over its whole text); the weights that result
are a few hundred numbers. All documents are scored, over all passages of their whole texts.

Defined cases: a null or wordless text is one empty passage; unlabelled documents are scored like all others;
several labels of a document each count; labels without a document, and null labels, are ignored; with no
labels at all every score is 1; repeated rows are scored each; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.llm import tasks
from parcelmill.llm.words import Words, pieces, text_bytes

PASSAGE_WORDS = 48
SAMPLE = 6_000
TRAIN_PASSAGES = 1_000  # of one sampled document; with SAMPLE, the bound of what the driver trains on: 360 MB
HIDDEN = 16
THRESHOLD = 0.7

# character classes of the encoding, three to a lookup, each summed in 21 bits
_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58),
    [32, 9, 10, 11, 12, 13], b".,;:'\"()-?", b"!",
    b"|", b"%$&*#@~^=<>{}[]\\/_+`", range(128, 256),
]
_LOOKUP = np.zeros((3, 256), np.uint64)
for _i, _members in enumerate(_CLASSES):
    _LOOKUP[_i // 3, list(_members)] += np.uint64(1 << 21 * (_i % 3))
FEATURES = len(_CLASSES) + 6


def encode(column: pa.Array, passage_words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages of all texts, and the first passage of each text."""
    data, at = text_bytes(column)
    vectors, counts = [np.zeros((0, FEATURES), np.float32)], [np.zeros(0, np.int64)]
    for _, _, d, a in pieces(data, at):
        words = Words(d, a)
        own = np.diff(words.first)
        many = np.maximum(1, -(-own // passage_words))
        first = np.concatenate(([0], np.cumsum(many)))
        nth = np.arange(first[-1]) - np.repeat(first[:-1], many)
        begin = np.minimum(np.repeat(words.first[:-1], many) + nth * passage_words, np.repeat(words.first[1:], many))
        end = np.minimum(begin + passage_words, np.repeat(words.first[1:], many))
        n = (end - begin).astype(np.float64)
        starts = np.append(words.starts, len(d))
        low = starts[begin]
        high = np.where(n > 0, np.append(words.ends, 0)[np.maximum(end, 1) - 1], low)
        sums = lambda x: np.concatenate((np.zeros(1, x.dtype), np.cumsum(x)))
        size = np.maximum(high - low, 1).astype(np.float64)
        columns = []
        for lookup in _LOOKUP:
            total = sums(lookup[d])
            total = total[high] - total[low]  # differences of wrapped sums are right while a passage is under 2 MB
            columns += [((total >> np.uint64(21 * k)) & np.uint64((1 << 21) - 1)) / size for k in range(3)]
        h = words.hashes
        same = np.zeros(len(h), np.int64)
        same[1:] = h[1:] == h[:-1]
        lengths = (words.ends - words.starts).astype(np.int64)
        marked = ~np.isin(d[words.ends - 1], _WORD_END) if len(h) else np.zeros(0, bool)
        per = np.maximum(n, 1)
        for values in (same, marked.astype(np.int64), lengths, np.minimum(lengths, 1000) ** 2):
            total = sums(values)
            columns.append((total[end] - total[begin]) / per)
        columns[-2] = np.log1p(columns[-2])
        columns[-1] = np.log1p(columns[-1])
        columns += [np.log1p(n), np.log1p(np.repeat(own, many))]
        vectors.append(np.stack(columns, axis=1).astype(np.float32))
        counts.append(many)
    return np.concatenate(vectors), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


_WORD_END = np.concatenate((np.arange(48, 58), np.arange(65, 91), np.arange(97, 123), np.arange(128, 256), list(b".,;:'\")?"))).astype(np.uint8)


@dataclass
class Model:
    """Encoder, gated attention and classifier."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict]:
        p = self.parts
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["wb"])
        v, u = np.tanh(h @ p["v"] + p["vb"]), 1 / (1 + np.exp(-(h @ p["u"] + p["ub"])))
        e = np.clip((v * u) @ p["a"], -30, 30)
        e = np.exp(e)
        share = e / np.repeat(np.add.reduceat(e, first[:-1]), np.diff(first))
        z = np.add.reduceat(share[:, None] * h, first[:-1], axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["cb"], -30, 30)))
        return score, {"x": x, "h": h, "v": v, "u": u, "share": share, "z": z}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)[0] if len(first) > 1 else np.zeros(0)


def _gradients(model: Model, score: np.ndarray, got: dict, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    p, many = model.parts, np.diff(first)
    dz_out = (score - y) / len(y)
    dz = np.repeat(dz_out[:, None] * p["c"], many, axis=0)
    dshare = (dz * got["h"]).sum(1)
    mean = np.repeat(np.add.reduceat(got["share"] * dshare, first[:-1]), many)
    de = got["share"] * (dshare - mean)
    dv = de[:, None] * p["a"] * got["u"] * (1 - got["v"] ** 2)
    du = de[:, None] * p["a"] * got["v"] * got["u"] * (1 - got["u"])
    dh = (got["share"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - got["h"] ** 2)
    return {
        "c": got["z"].T @ dz_out, "cb": dz_out.sum(), "a": (got["v"] * got["u"]).T @ de,
        "v": got["h"].T @ dv, "vb": dv.sum(0), "u": got["h"].T @ du, "ub": du.sum(0),
        "w": got["x"].T @ dh, "wb": dh.sum(0),
    }


def fit(bags: list[np.ndarray], labels: np.ndarray, hidden: int = HIDDEN, rounds: int = 60, batch: int = 128, rate: float = 0.01) -> Model:
    """A model of the labelled bags, by Adam with a fixed seed."""
    rng = np.random.default_rng(7)
    shapes = {"w": (FEATURES, hidden), "v": (hidden, hidden), "u": (hidden, hidden), "a": (hidden,), "c": (hidden,)}
    parts = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
    parts |= {k: np.zeros(hidden) for k in ("wb", "vb", "ub")} | {"cb": np.zeros(())}
    if not bags:
        parts = {k: np.zeros_like(v) for k, v in parts.items()} | {"cb": np.array(30.0)}
        return Model(np.zeros(FEATURES), np.ones(FEATURES), parts)
    every = np.concatenate(bags).astype(np.float64)
    model = Model(every.mean(0), every.std(0) + 1e-3, parts)
    first_moment = {k: np.zeros_like(v) for k, v in parts.items()}
    second_moment = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            mine = order[i : i + batch]
            x = np.concatenate([bags[j] for j in mine]).astype(np.float64)
            first = np.concatenate(([0], np.cumsum([len(bags[j]) for j in mine])))
            score, got = model.forward(x, first)
            step += 1
            for k, g in _gradients(model, score, got, first, labels[mine]).items():
                g = g + 1e-4 * parts[k]
                first_moment[k] = 0.9 * first_moment[k] + 0.1 * g
                second_moment[k] = 0.999 * second_moment[k] + 0.001 * g * g
                parts[k] -= rate * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)
    return model


def spread(begin: int, end: int, most: int = TRAIN_PASSAGES) -> np.ndarray:
    """All places from begin to before end, or ``most`` of them at even distances."""
    return np.arange(begin, end) if end - begin <= most else begin + np.arange(most) * (end - begin) // most


def train(docs: DataFrame, labels: DataFrame, use: Column, sample: int = SAMPLE, passage_words: int = PASSAGE_WORDS) -> Model:
    """A model from at most ``sample`` labelled documents for which ``use`` holds."""
    known = labels.filter(use & F.col("quality").isNotNull()).select("doc_id", "quality")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, first = encode(batch["text"], passage_words)
        bags = [x[spread(a, b)].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        return pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), batch["quality"].cast(pa.int32()), pa.array(bags, pa.binary())], ["doc_id", "quality", "bag"])

    chosen = tasks.texts(docs).join(F.broadcast(known), "doc_id").select("doc_id", "quality", "text")  # at most ``sample`` rows
    rows = tasks.per_batch(chosen, each, "doc_id long, quality int, bag binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, bytes(r.bag)))
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in rows]
    return fit(bags, np.array([float(r.quality) for r in rows]))


def scores(docs: DataFrame, model: Model, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``doc_id, score`` of every document."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = model.score(*encode(batch["text"], passage_words))
        return pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(score)], ["doc_id", "score"])

    return tasks.per_batch(tasks.texts(docs), each, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    tasks.ship(docs.sparkSession)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(*encode(batch["text"], passage_words)) >= threshold))

    return tasks.per_batch(docs, each, docs.schema)
