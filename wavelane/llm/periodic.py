"""Runs of words: stretches that repeat a period four times or more, found by recompression.

A step takes the words of many texts as one string of numbers, with a symbol of its own between texts, and
builds a run-length grammar of it (``recompression``). For each period p the places 0, p, 2p ... form a grid: a
stretch of at least 4p words holds four neighbouring places, which must hold equal words. What is left are
candidates; the grammar says how far they extend to both sides. Texts are never cut, and nothing is shuffled.

Defined results: a null or blank text has no words and no runs; equal runs found from several places count
once; a stretch has its smallest period only; rows that repeat are judged each; columns other than the key and
the text are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import byte_steps
from wavelane.llm.recompression import Grammar

REPEATS, LEAST = 4, 6
Words = list[bytes]


def candidates(symbols: np.ndarray, longest: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of grid places that hold the same word ``repeats`` times, up to the longest period
    that a text of ``longest`` words can repeat so often."""
    places, periods = [], []
    for period in range(1, longest // repeats + 1):
        grid = symbols[::period]
        same = grid[1:] == grid[:-1]
        if len(same) < repeats - 1:
            break
        held = same[: len(same) - repeats + 2]
        for k in range(1, repeats - 1):
            held = held & same[k : len(same) - repeats + 2 + k]
        at = np.flatnonzero(held)
        if len(at):
            places.append(at * period)
            periods.append(np.full(len(at), period))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of_string(symbols: np.ndarray, longest: int, repeats: int = REPEATS, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period), by start, then period. ``symbols`` as ``Grammar`` wants them."""
    x, period = candidates(symbols, longest, max(repeats, 2))
    if not len(x):
        return np.zeros((0, 3), np.int64)
    grammar = Grammar(symbols)
    left = grammar.extension(x - 1, x + period - 1, -1)
    length = left + grammar.extension(x, x + period) + period
    found = np.stack([x - left, length, period], axis=1)[length >= np.maximum(least, repeats * period)]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)  # of one stretch, the smallest period
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[Words], repeats: int = REPEATS, least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its runs, and which of its words are kept: those that no run holds after its first period."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    lengths = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(lengths + 1) - lengths  # a symbol of its own stands before each text and at the end
    symbols = np.zeros(int(lengths.sum()) + len(texts) + 1, np.int32)
    edges = np.r_[begin - 1, len(symbols) - 1]
    is_word = np.ones(len(symbols), bool)
    is_word[edges] = False
    symbols[edges] = -1 - np.arange(len(edges))
    symbols[is_word] = np.fromiter(map(number.__getitem__, chain.from_iterable(texts)), np.int32, int(lengths.sum()))
    runs = runs_of_string(symbols, int(lengths.max(initial=0)), repeats, least)
    change = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    bounds = np.searchsorted(runs[:, 0], np.r_[begin, len(symbols)])
    return [(runs[a:b] - [at, 0, 0], kept[at : at + n]) for a, b, at, n in zip(bounds, bounds[1:], begin.tolist(), lengths.tolist())]


def find_runs(docs: DataFrame, alter: Callable[[int | None, Words], Words] | None = None, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """doc_id, ``runs`` (start, length, period; by start, then period) and ``collapsed``, the kept words joined
    by one space. ``alter`` may change a text's words first, given its doc_id."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for part in byte_steps(batch, "text"):
                # bytes.split() parts at just the white space that ends a word here.
                texts = [(x or b"").split() for x in part.column("text").to_pylist()]
                if alter:
                    texts = [alter(k, t) for k, t in zip(part.column("doc_id").to_pylist(), texts)]
                runs, collapsed = [], []
                for words, (found, kept) in zip(texts, runs_of_texts(texts, repeats, least)):
                    runs.append(found)
                    stay = words if not len(found) else [w for w, k in zip(words, kept.tolist()) if k]
                    collapsed.append(b" ".join(stay).decode("utf-8", "replace"))
                flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type))
                lists = pa.ListArray.from_arrays(pa.array(ends), rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(judge, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def looped(doc_id: int | None, words: Words) -> Words:
    """A tenth of the documents, by a hash of the id, repeat a stretch from some word on; a null id never does."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def digests(found: DataFrame) -> DataFrame:
    """Per document how many runs there are, the longest (ties: smallest start, then period) and digests."""

    def line(run: Column) -> Column:
        return F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))

    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", line), "")
    counted = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return counted.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
