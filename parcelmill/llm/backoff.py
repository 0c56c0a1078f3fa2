"""Language-model scores of whole texts by a weighted backoff automaton.

The model is made of the counts of all n-grams of the training documents, none left out. Each n-gram whose
words are seen is a state; an arc reads a word, weighted with its smoothed probability; a state that has no arc
for the next word fails over to its longest known suffix, weighted with the backoff of the state:

    p(w)      = (c(w) + 1) / (N + V + 1)
    p(w | h)  = (c(hw) + strength * p(w | h')) / (c(h) + strength),    h' = h without its first word

so that a known arc has the first form, and a failure multiplies ``strength / (c(h) + strength)`` to what h' says.

The automaton is never in one place. A block of documents asks for the counts of its own different n-grams;
the questions of all blocks are dealt to shards by n-gram hash, a shard adds up what its n-grams occur in all
training documents and answers each block. The block then holds the part of the automaton that its texts can
reach, reads them left to right, carries the state along and adds up logarithms. Blocks and shards have fixed
sizes, so their numbers grow with the corpus.

A state depends on at most ``order - 1`` words, so a long text is read in stretches of ``STRETCH`` tokens side by side,
each of which comes into its state by reading the ``order - 1`` tokens before it without counting them.

Defined cases: tokens are runs without ASCII white space, A-Z in lower case, and one end token a text; a null
or empty text is one end token; repeated rows count and are scored each; a null ``doc_id`` is hashed as empty
text; with no training documents every probability is 1; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.llm import tasks
from parcelmill.llm.words import Words, pieces, text_bytes, window_hashes

ORDER = 2
STRENGTH = 4.0
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 12 << 20  # of text for each shard of n-grams of one order
STRETCH = 1024  # tokens
END = np.uint64(0xD1B54A32D192ED03)

QUESTION = "block int, gram int, shard int, keys binary, counts binary"
ANSWER = "block int, gram int, shard int, counts binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and the first token of each text."""
    data, at = text_bytes(column)
    parts, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, d, a in pieces(data, at):
        words = Words(d, a, lower=True)
        parts.append(np.insert(words.hashes, words.first[1:], END))
        counts.append(np.diff(words.first) + 1)
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts))))


def ngrams(stream: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text, and the place of the last token of each."""
    if n == 1:
        return stream, np.arange(len(stream))
    since = np.arange(len(stream)) - np.repeat(first[:-1], np.diff(first))
    last = np.flatnonzero(since >= n - 1)
    return window_hashes(stream, n)[last - n + 1], last


def packed(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, after one byte that says how many."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or values.max(initial=0) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(value, f"<u{value[0]}", offset=1).astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences, byte by byte, so that the shuffle can compress the high ones."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(value: pa.Buffer) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _dealt(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by shard, and the shards with where each starts in it."""
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    present, begin = np.unique(shard[order], return_index=True)
    return order, present, np.append(begin, len(keys))


def _questions(block: int, stream: np.ndarray, first: np.ndarray, train: np.ndarray, orders: range, shards: int) -> pa.RecordBatch:
    taught = np.repeat(train, np.diff(first))
    out: tuple[list, ...] = ([], [], [], [], [])
    for n in orders:
        grams, last = ngrams(stream, first, n)
        keys, inverse = np.unique(grams, return_inverse=True)
        counts = np.bincount(inverse, weights=taught[last], minlength=len(keys)).astype(np.int64)
        order, present, begin = _dealt(keys, shards)
        for shard, a, b in zip(present.tolist(), begin[:-1], begin[1:]):
            mine = order[a:b]
            for column, value in zip(out, (block, n, shard, packed_keys(keys[mine]), packed(counts[mine]))):
                column.append(value)
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [c.split()[0] for c in QUESTION.split(", ")])


def _totals(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Distinct keys of a shard with their summed counts, and the rows' parts of the asked keys."""
    keys = [unpacked_keys(k.as_buffer()) for k in asked["keys"]]
    counts = [unpacked(c.as_py()) for c in asked["counts"]]
    ends = np.cumsum([len(k) for k in keys])
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return total, inverse, list(zip(np.append(0, ends[:-1]).tolist(), ends.tolist()))


def _answers(asked: pa.Table) -> pa.Table:
    total, inverse, parts = _totals(asked)
    counts = total[inverse]
    return pa.table({"block": asked["block"], "gram": asked["gram"], "shard": asked["shard"], "counts": pa.array([packed(counts[a:b]) for a, b in parts], pa.binary())})


@dataclass(frozen=True)
class Grams:
    """The different n-grams of one order in a block."""

    at: np.ndarray  # number of the n-gram that ends at each token, -1 where none does
    counts: np.ndarray  # in training, of each n-gram
    place: np.ndarray  # a token where it ends


@dataclass(frozen=True)
class Automaton:
    """State 0 is the empty history, which reads every token; weights are log10."""

    tokens: int
    arcs: np.ndarray  # state * tokens + token, ascending
    target: np.ndarray
    weight: np.ndarray
    fail: np.ndarray  # the state that each state without an arc for a token fails over to
    backoff: np.ndarray


def automaton(levels: list[Grams], strength: float, n_total: int, n_distinct: int) -> Automaton:
    """States, arcs and failure arcs of the n-grams of all orders, shortest first."""
    tokens, states = len(levels[0].counts), 1
    arcs, targets, weights, fails, backoffs = [], [], [], [np.zeros(1, np.int64)], [np.zeros(1)]
    for n, grams in enumerate(levels, 1):
        known, token = grams.counts > 0, levels[0].at[grams.place]
        if n == 1:
            source = suffix_state = np.zeros(tokens, np.int64)
            weight, read = (grams.counts + 1.0) / (n_total + n_distinct + 1.0), np.ones(tokens, bool)
        else:
            shorter = levels[n - 2]
            context, suffix = shorter.at[grams.place - 1], shorter.at[grams.place]
            source, suffix_state = state[context], state[suffix]
            weight, read = (grams.counts + strength * weight[suffix]) / (shorter.counts[context] + strength), known
        if n < len(levels):
            state = np.where(known, states + np.cumsum(known) - 1, 0)
            states += int(known.sum())
            fails.append(suffix_state[known])
            backoffs.append(np.log10(strength / (grams.counts[known] + strength)))
            target = state
        else:
            target = suffix_state
        arcs.append((source * tokens + token)[read])
        targets.append(target[read])
        weights.append(np.log10(weight[read]))
    arcs, targets, weights = (np.concatenate(x) for x in (arcs, targets, weights))
    order = np.argsort(arcs)
    return Automaton(tokens, arcs[order], targets[order], weights[order], np.concatenate(fails), np.concatenate(backoffs))


def walk(model: Automaton, token: np.ndarray, first: np.ndarray, order: int, stretch: int = STRETCH) -> np.ndarray:
    """Log-probability of each text, read from left to right; texts and their stretches go side by side."""
    length = np.diff(first)
    parts = -(-length // stretch)
    text = np.repeat(np.arange(len(length)), parts)
    start = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)) * stretch
    begin, end = np.maximum(first[text], start - (order - 1)), np.minimum(start + stretch, first[text + 1])
    longest = np.argsort(begin - end, kind="stable")
    text, start, begin, shorter = text[longest], start[longest], begin[longest], (begin - end)[longest]
    state, score = np.zeros(len(text), np.int64), np.zeros(len(text))
    for t in range(-int(shorter[0]) if len(shorter) else 0):
        live = int(np.searchsorted(shorter, -t))
        here, now, gain, open_ = begin[:live] + t, state[:live], np.zeros(live), np.arange(live)
        read = token[here]
        while len(open_):
            wanted = now[open_] * model.tokens + read[open_]
            arc = np.minimum(np.searchsorted(model.arcs, wanted), len(model.arcs) - 1)
            hit = model.arcs[arc] == wanted
            done, arc, open_ = open_[hit], arc[hit], open_[~hit]
            gain[done] += model.weight[arc]
            now[done] = model.target[arc]
            gain[open_] += model.backoff[now[open_]]
            now[open_] = model.fail[now[open_]]
        score[:live] += np.where(here >= start[:live], gain, 0.0)
    return np.bincount(text, weights=score, minlength=len(length))


def _score(docs: pa.Table, answers: pa.Table, order: int, shards: int, strength: float, n_total: int, n_distinct: int) -> pa.Table:
    stream, first = tokens(docs["text"])
    given: dict[tuple[int, int], np.ndarray] = {
        (g, s): unpacked(c) for g, s, c in zip(answers["gram"].to_pylist(), answers["shard"].to_pylist(), answers["counts"].to_pylist())
    }
    levels = []
    for n in range(1, order + 1):
        grams, last = ngrams(stream, first, n)
        keys, place, inverse = np.unique(grams, return_index=True, return_inverse=True)
        by_shard, present, begin = _dealt(keys, shards)
        counts = np.zeros(len(keys), np.int64)
        for shard, a, b in zip(present.tolist(), begin[:-1], begin[1:]):
            counts[by_shard[a:b]] = given[n, shard]
        at = np.full(len(stream), -1, np.int64)
        at[last] = inverse
        levels.append(Grams(at, counts, last[place]))
    token, seen = levels[0].at, levels[0].counts
    model = automaton(levels, strength, n_total, n_distinct)
    base = np.log10((seen + 1.0) / (n_total + n_distinct + 1.0))
    held = np.logical_not(docs["train"].to_numpy())
    add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  no text is without its end token
    return pa.table(
        {
            "doc_id": docs["doc_id"].cast(pa.int64()),
            "held_out": pa.array(held),
            "n_tokens": pa.array(np.diff(first)),
            "n_known": pa.array(add((seen > 0)[token].astype(np.int64))),
            "train_tokens": pa.array(np.full(len(held), n_total, np.int64)),
            "base_score": pa.array(add(base[token])),
            "score": pa.array(walk(model, token, first, order)),
        }
    )


def scores(docs: DataFrame, train, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """Scores of every document; ``train`` is the condition that marks those to learn from."""
    size = tasks.total_bytes(docs)
    blocks, shards = tasks.shares(size, BLOCK_BYTES), tasks.shares(size, SHARD_BYTES)
    marked = docs.select("doc_id", train.alias("train"), "text")
    tasks.ship(docs.sparkSession)

    def words(batch: pa.RecordBatch) -> pa.RecordBatch:
        stream, first = tokens(batch["text"])
        return _questions(0, stream, first, np.ones(batch.num_rows, bool), range(1, 2), shards)

    def vocabulary(asked: pa.Table) -> pa.Table:
        total, _, _ = _totals(asked)
        return pa.table({"n": [int(total.sum())], "v": [len(total)]})

    taught = tasks.per_batch(marked.filter("train").select("text"), words, QUESTION)
    sums = taught.groupBy("shard").applyInArrow(vocabulary, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    n_total, n_distinct = (int(x or 0) for x in sums)

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        stream, first = tokens(table["text"])
        train_ = table["train"].to_numpy()
        return pa.Table.from_batches([_questions(key[0].as_py(), stream, first, train_, range(1, order + 1), shards)])

    def score(docs_: pa.Table, answers: pa.Table) -> pa.Table:
        return _score(docs_, answers, order, shards, strength, n_total, n_distinct)

    # both uses of the blocks share one exchange
    # the text is hashed too, so that rows with one id, or none, are spread
    blocked = marked.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = blocked.groupBy("block").applyInArrow(ask, QUESTION)
    answers = asked.groupBy("gram", "shard").applyInArrow(_answers, ANSWER)
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORES)
