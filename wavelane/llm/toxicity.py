"""Toxicity: a bidirectional gated recurrent network with attention pooling, over every window of a text.

A word enters as an embedding of itself, the mean embedding of its character trigrams and its smoothed log
odds among the labelled documents. Windows of ``WINDOW`` words overlap and cover the whole text; a text's
score is that of its most toxic window. Training is in numpy on the driver, from a bounded sample: of a toxic
document the window with the most evidence, of others the one that looks worst and one at random; a
document's own count is taken out of the log odds it is trained with. Scoring runs in Arrow batches; what a
word contributes to the gates is worked out once per distinct word.

Defined results: a null, empty or blank text scores the training share of toxic documents (one half of a
percent without labels of both kinds, then for all); rows that repeat are scored each; a null doc_id is not
held out and never trained on; texts of any length are scored whole; extra columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import hashed_sample

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM = 8, 6, 6
TRIGRAMS, VOCABULARY = 1024, 20_000
TOGETHER = 192  # windows read at once: their gates stay in a processor's cache
EDGE = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`"


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def bare(token: str) -> str:
    """A token without punctuation around it, or itself if it is nothing else."""
    return token.strip(EDGE) or token


def windows(n: int) -> list[int]:
    """Starts of windows that overlap and cover n words; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Trigrams(dict):
    """Row of each trigram, by a hash; emptied when it holds ``limit``."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, gram: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[gram] = found = zlib.crc32(gram.encode("utf-8", "replace")) % TRIGRAMS
        return found


_TRIGRAMS = Trigrams()


def trigrams(word: str) -> list[int]:
    padded = f"^{word}$"
    return [_TRIGRAMS[padded[k : k + 3]] for k in range(max(1, len(padded) - 2))]


def _flat(grams: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers one after the other, and their lengths."""
    lengths = np.fromiter(map(len, grams), np.int64, len(grams))
    return np.fromiter(chain.from_iterable(grams), np.int64, int(lengths.sum())), lengths


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights of both directions side by side; gates in the order update, reset, candidate."""

    words: dict[str, int] = field(default_factory=dict)
    odds: np.ndarray = field(default_factory=lambda: np.zeros(1, np.float32))
    prior: float = 0.005
    w: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, words: dict[str, int], odds: np.ndarray, prior: float) -> Network:
        rng = np.random.default_rng(7)
        normal = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        h, d = HIDDEN, 1 + WORD_DIM + CHAR_DIM
        w = {
            "word": normal(len(words) + 1, WORD_DIM),
            "char": normal(TRIGRAMS, CHAR_DIM),
            "in": normal(d, 6 * h, scale=0.3),
            "bias": np.zeros(6 * h, np.float32),
            "back": normal(h, 3 * h, scale=0.3),
            "ahead": normal(h, 3 * h, scale=0.3),
            "mix": normal(2 * h, h, scale=0.3),
            "look": normal(h, scale=0.3),
            "out": normal(2 * h, scale=0.3),
            "level": np.zeros(1, np.float32),
        }
        return cls(words, odds, prior, w)

    def inputs(self, index: np.ndarray, odds: np.ndarray, grams: list[list[int]]) -> np.ndarray:
        """Word vectors: log odds, word embedding (row 0: unknown), mean trigram embedding."""
        flat, lengths = _flat(grams)
        sums = np.add.reduceat(self.w["char"][flat], np.cumsum(lengths) - lengths, axis=0) if grams else np.zeros((0, CHAR_DIM), np.float32)
        char = sums / np.maximum(lengths, 1)[:, None]
        return np.concatenate([odds[:, None], self.w["word"][index], char], axis=1).astype(np.float32)

    def read(self, gates: np.ndarray, there: np.ndarray, keep: bool = False):
        """Run both directions over (windows, steps, 6 hidden) gate inputs; ``there`` masks padding."""
        n, steps, _ = gates.shape
        h = HIDDEN
        states = np.zeros((n, steps, 2 * h), np.float32)
        memory: dict[str, list] = {"ahead": [], "back": []}
        for name, at, order in (("ahead", 0, range(steps)), ("back", 1, range(steps - 1, -1, -1))):
            u, state = self.w[name], np.zeros((n, h), np.float32)
            for t in order:
                x, s = gates[:, t, 3 * h * at : 3 * h * (at + 1)], state @ u
                zr = sigmoid(x[:, : 2 * h] + s[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h :] + r * s[:, 2 * h :])
                if keep:
                    memory[name].append((t, state, z, r, c, s[:, 2 * h :]))
                state = state + (z * there[:, t, None]) * (c - state)
                states[:, t, h * at : h * (at + 1)] = state
        mixed = np.tanh(states @ self.w["mix"])
        weight = np.where(there > 0, mixed @ self.w["look"], -1e9)
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = (weight[:, :, None] * states).sum(axis=1)
        logit = pooled @ self.w["out"] + self.w["level"][0]
        return logit, (states, mixed, weight, pooled, memory)

    def packed(self) -> np.ndarray:
        """The recurrent weights of both directions as one matrix, gates as ``WordGates`` lays them out."""
        h = HIDDEN
        u = np.zeros((2, h, 3, 2, h), np.float32)
        for at, name in enumerate(("ahead", "back")):
            u[at, :, :, at] = self.w[name].reshape(h, 3, h)
        u[:, :, :2] *= 0.5
        return u.reshape(2 * h, 6 * h)

    def logits(self, table: np.ndarray, index: np.ndarray) -> np.ndarray:
        """What ``read`` gives for windows of rows of ``table`` (row 0: padding).

        Both directions take a step together, one from each end. The inputs of a step lie side by side, in the
        order update, reset, candidate and in each ahead, back. Update and reset come halved, as a sigmoid is
        the hyperbolic tangent of half its argument; at padding the update is so low that the state stays."""
        h, order = HIDDEN, np.ascontiguousarray(index.T)
        steps, n = order.shape
        gates = np.empty((steps, n, 3, 2, h), np.float32)
        halves = table.reshape(-1, 3, 2, h)
        gates[:, :, :, 0] = halves[order, :, 0]
        gates[:, :, :, 1] = halves[order[::-1], :, 1]
        gates = gates.reshape(steps, n, 6 * h)
        u, state = self.packed(), np.zeros((n, 2 * h), np.float32)
        states = np.empty((steps, n, 2, h), np.float32)
        for t in range(steps):
            s = state @ u
            both = gates[t, :, : 4 * h] + s[:, : 4 * h]
            np.tanh(both, out=both)
            both *= 0.5
            both += 0.5
            c = s[:, 4 * h :]
            c *= both[:, 2 * h :]
            c += gates[t, :, 4 * h :]
            np.tanh(c, out=c)
            c -= state
            c *= both[:, : 2 * h]
            state = state + c
            states[t, :, 0] = state[:, :h]
            states[steps - 1 - t, :, 1] = state[:, h:]
        states = states.reshape(steps, n, 2 * h)
        weight = np.where(order > 0, np.tanh(states @ self.w["mix"]) @ self.w["look"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        pooled = np.einsum("tn,tnh->nh", weight, states) / weight.sum(axis=0)[:, None]
        return pooled @ self.w["out"] + self.w["level"][0]

    def gradients(self, x: np.ndarray, index: np.ndarray, grams: list[list[list[int]]], there: np.ndarray, y: np.ndarray):
        """Loss and gradients for windows of word vectors ``x`` (windows, steps, inputs)."""
        w, h = self.w, HIDDEN
        gates = x @ w["in"] + w["bias"]
        logit, (states, mixed, weight, pooled, memory) = self.read(gates, there, keep=True)
        p = sigmoid(logit)
        loss = -np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))
        d = (p - y) / len(y)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["out"], g["level"][0] = pooled.T @ d, d.sum()
        dpooled = d[:, None] * w["out"]
        dstates = weight[:, :, None] * dpooled[:, None, :]
        dweight = (states * dpooled[:, None, :]).sum(axis=2)
        dlook = weight * (dweight - (weight * dweight).sum(axis=1, keepdims=True))
        g["look"] = (mixed * dlook[:, :, None]).sum(axis=(0, 1))
        dmixed = dlook[:, :, None] * w["look"] * (1 - mixed**2)
        g["mix"] = np.einsum("ntj,ntk->jk", states, dmixed)
        dstates = dstates + dmixed @ w["mix"].T
        dgates = np.zeros_like(gates)
        for name, at in (("ahead", 0), ("back", 1)):
            u, carried = w[name], np.zeros((len(y), h), np.float32)
            for t, state, z, r, c, s in reversed(memory[name]):
                total = carried + dstates[:, t, h * at : h * (at + 1)]
                moved = total * there[:, t, None]
                dz, dc = moved * (c - state) * z * (1 - z), moved * z * (1 - c**2)
                dr, ds = dc * s * r * (1 - r), dc * r
                back = np.concatenate([dz, dr, ds], axis=1)
                g[name] += state.T @ back
                carried = total - moved * z + back @ u.T
                dgates[:, t, 3 * h * at : 3 * h * (at + 1)] = np.concatenate([dz, dr, dc], axis=1)
        g["in"] = np.einsum("ntj,ntk->jk", x, dgates)
        g["bias"] = dgates.sum(axis=(0, 1))
        dx = dgates @ w["in"].T
        np.add.at(g["word"], index, dx[:, :, 1 : 1 + WORD_DIM] * there[:, :, None])
        flat, lengths = _flat([gram for window in grams for gram in window])
        each = np.concatenate([dx[n, : len(window), 1 + WORD_DIM :] for n, window in enumerate(grams)]) / lengths[:, None]
        np.add.at(g["char"], flat, np.repeat(each, lengths, axis=0))
        return loss, g


class WordGates:
    """What each distinct token adds to the gates, worked out once and laid out as ``Network.logits`` reads it;
    emptied when it holds ``limit`` rows. Row 0 is padding."""

    def __init__(self, network: Network, limit: int = 300_000):
        self.network = network
        self._empty(limit)

    def _empty(self, limit: int) -> None:
        self.limit = limit
        self.rows: dict[str, int] = {}
        self.table = np.zeros((limit + 1, 6 * HIDDEN), np.float32)
        self.table[0, : 2 * HIDDEN] = -1e9

    def indices(self, found: list[str]) -> np.ndarray:
        new = list(set(found).difference(self.rows))
        if len(self.rows) + len(new) > self.limit:
            self.rows.clear()
            new = list(set(found))
            if len(new) > self.limit:  # one text with more distinct tokens than that
                self._empty(len(new))
        if new:
            net, plain = self.network, [bare(t) for t in new]
            index = np.array([net.words.get(p, 0) for p in plain])
            x = net.inputs(index, net.odds[index], [trigrams(p) for p in plain])
            first = len(self.rows) + 1
            gates = (x @ net.w["in"] + net.w["bias"]).reshape(-1, 2, 3, HIDDEN).swapaxes(1, 2)
            gates[:, :2] *= 0.5
            self.table[first : first + len(new)] = gates.reshape(-1, 6 * HIDDEN)
            self.rows.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.rows.__getitem__, found), np.int64, len(found))


def score_texts(network: Network, gates: WordGates, texts: list[str | None]) -> np.ndarray:
    """The score of each text: its largest over all windows."""
    scores = np.full(len(texts), network.prior)
    if not network.w:
        return scores
    # Token rows are valid until the table is emptied, so windows are read text by text group.
    owners, rows = [], []

    def flush() -> None:
        if rows:
            index = np.concatenate(rows)
            np.maximum.at(scores, np.concatenate(owners), sigmoid(network.logits(gates.table, index)))
            owners.clear()
            rows.clear()

    held = 0
    for k, text in enumerate(texts):
        found = tokens(text)
        if not found:
            continue
        scores[k] = 0.0
        if len(gates.rows) + len(found) > gates.limit:
            flush()
            held = 0
        index = gates.indices(found)
        starts = np.array(windows(len(index)))
        for at in range(0, len(starts), TOGETHER):
            place = starts[at : at + TOGETHER, None] + np.arange(WINDOW)
            rows.append(np.where(place < len(index), index[np.minimum(place, len(index) - 1)], 0))
            owners.append(np.full(len(place), k))
            held += len(place)
            if held >= TOGETHER:
                flush()
                held = 0
    flush()
    return scores


def train(texts: list[str | None], toxic: list[int], steps: int = 400, batch: int = 48) -> Network:
    """Fit a network to labelled texts; the same input gives the same network."""
    y = np.array(toxic)
    n_bad, n_good = int(y.sum()), int((1 - y).sum())
    if not n_bad or not n_good:
        return Network()
    found = [[bare(t) for t in tokens(x)] for x in texts]
    bad, good = Counter(), Counter()
    for words_, label in zip(found, y):
        (bad if label else good).update(set(words_))

    def odds(word: str, label: int | None = None) -> float:
        b, g = bad[word] - (label == 1), good[word] - (label == 0)
        value = math.log((b + 0.5) / (n_bad + 1)) - math.log((g + 0.5) / (n_good + 1))
        return value * (b + g) / (b + g + 4.0)

    known = sorted((w for w in {*bad, *good} if bad[w] + good[w] >= 3), key=lambda w: (-abs(odds(w)), w))[:VOCABULARY]
    index = {w: k + 1 for k, w in enumerate(known)}
    network = Network.fresh(index, np.array([0.0, *map(odds, known)], np.float32), n_bad / len(y))
    rng = np.random.default_rng(11)
    examples: list[tuple[list[str], int]] = []
    for words_, label in zip(found, y):
        if words_:
            value = np.array([odds(w, int(label)) if w in index else 0.0 for w in words_])
            starts = windows(len(words_))
            worst = max(starts, key=lambda s: np.sort(value[s : s + WINDOW])[-3:].sum())
            examples.append((words_[worst : worst + WINDOW], int(label)))
            if not label:
                s = starts[rng.integers(len(starts))]
                examples.append((words_[s : s + WINDOW], 0))
    kinds = [[k for k, (_, label) in enumerate(examples) if label == c] for c in (0, 1)]
    if not kinds[0] or not kinds[1]:
        return Network()

    @lru_cache(None)
    def prepared(k: int) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Rows, log odds and trigrams of an example's words."""
        words_, label = examples[k]
        own = np.array([index.get(w, 0) for w in words_])
        return own, np.array([odds(w, label) if r else 0.0 for w, r in zip(words_, own)], np.float32), [trigrams(w) for w in words_]

    first, second = ({k: np.zeros_like(v) for k, v in network.w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        chosen = [*rng.choice(kinds[1], batch // 3), *rng.choice(kinds[0], batch - batch // 3)]
        x = np.zeros((batch, WINDOW, 1 + WORD_DIM + CHAR_DIM), np.float32)
        there, rows, grams = np.zeros((batch, WINDOW), np.float32), np.zeros((batch, WINDOW), np.int64), []
        for n, k in enumerate(chosen):
            words_, label = examples[k]
            # Now and then a word is taken for unknown, so that characters must do.
            own_rows, own_odds, own_grams = prepared(k)
            known_rows = own_rows * (rng.random(len(words_)) > 0.05)
            value = np.where(known_rows > 0, own_odds, np.float32(0))
            x[n, : len(words_)] = network.inputs(known_rows, value, own_grams)
            there[n, : len(words_)], rows[n, : len(words_)] = 1, known_rows
            grams.append(own_grams)
        _, g = network.gradients(x, rows, grams, there, np.array([examples[k][1] for k in chosen], np.float32))
        for k, v in network.w.items():
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
            v -= (0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return network


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_training_rows: int = 6000, max_training_chars: int = 60_000) -> Network:
    """Train on labelled documents that are not held out: about ``max_training_rows`` at most, chosen by a
    hash of the id, one text of each id (the least), of which the first ``max_training_chars`` characters are
    taken. They are what the driver gets."""
    usable = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = hashed_sample(usable, "doc_id", max_training_rows)
    # At most about max_training_rows short rows: the bound of this broadcast.
    sample = docs.select("doc_id", F.substring("text", 1, max_training_chars).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic").toArrow().to_pylist()
    rows.sort(key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], [int(r["toxic"] > 0) for r in rows])


def score(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gates = WordGates(network)
        for batch in parts:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = score_texts(network, gates, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
