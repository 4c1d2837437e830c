"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into halves, each half has its own centroids, and a cell is a pair of centroids, so a few
hundred centroids make many fine cells. A query walks the pairs from the nearest on with a heap over the two
sorted lists, summing the halves' distances (how far their inner product falls short of the best one), until
the cells hold enough candidates; these are reranked by the exact inner product in double precision. That
gives each query a k-th score. In a second round it looks at all other cells that can hold a row as good: the
centroids' inner products and the cells' radii bound what a row in them can score. Nothing else ends a search,
so the result is the exact one on any table, with copies or without.

Every row is indexed. Centroids are fitted on a bounded sample. Neighbouring cells share a block; a cell with
many rows (one vector may be a third of the table) has several. Queries go to the blocks they ask for, and a
block has a copy for every ``BLOCK_QUERIES`` of them; a task holds one block and lets its queries pass.

Defined results: vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part; of rows with one id the least vector counts; a null id takes no part; equal scores
go by the smaller id; with fewer candidates than asked for all are returned; an empty table gives an empty
result; extra columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wavelane.llm.common import hashed_sample, store

BLOCK_ROWS = (2048, 16_384)
BLOCK_QUERIES = 20_000
#: Vectors travel packed, in rows of about this many bytes: an Arrow batch of 10,000 rows stays near 80 MB.
ROW_BYTES = 8192


def centroids(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from random distinct vectors; an emptied cluster keeps its place."""
    distinct = np.unique(vectors, axis=0)
    rng = np.random.default_rng(3)
    found = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        near = nearest(vectors, found)
        count = np.bincount(near, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, near, vectors)
        found[count > 0] = total[count > 0] / count[count > 0, None]
    return found


def nearest(vectors: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.argmin((found**2).sum(axis=1) - 2 * vectors @ found.T, axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: dict[int, int], wanted: int) -> list[int]:
    """Cells, nearest first by the sum of two distances, until they hold ``wanted`` rows.

    Pair (i, j) of the sorted lists enters the heap when (i-1, j) and (i, j-1) have left it or don't exist."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, cells, held = [(first[a[0]] + second[b[0]], 0, 0)], set(), [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        seen.add((i, j))
        cell = int(a[i]) * len(second) + int(b[j])
        if cell in sizes:
            cells.append(cell)
            held += sizes[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x == 0 or (x - 1, y) in seen) and (y == 0 or (x, y - 1) in seen):
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))
    return cells


def blocks_of(sizes: dict[int, int], most: int) -> dict[int, range]:
    """The blocks of each cell: neighbours share one of at most ``most`` rows, a cell of more has its own."""
    blocks, last, room = {}, -1, 0
    for cell, n in sorted(sizes.items()):
        count = -(-n // most)
        if n > room:
            blocks[cell] = range(last + 1, last + 1 + count)
            last, room = last + count, most - n if count == 1 else 0
        else:
            blocks[cell] = range(last, last + 1)
            room -= n
    return blocks


@dataclass(frozen=True)
class MultiIndex:
    left: np.ndarray
    right: np.ndarray
    dimension: int

    def cell(self, vectors: np.ndarray) -> np.ndarray:
        half = self.left.shape[1]
        return nearest(vectors[:, :half], self.left) * len(self.right) + nearest(vectors[:, half:], self.right)

    def distances(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        a, b = self.left @ query[:half], self.right @ query[half:]
        return a.max() - a, b.max() - b

    def radii(self, vectors: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half, (i, j) = self.left.shape[1], np.divmod(cell, len(self.right))
        return np.linalg.norm(vectors[:, :half] - self.left[i], axis=1), np.linalg.norm(vectors[:, half:] - self.right[j], axis=1)


class Bounds:
    """What a row of each cell can score at most, from the cells' rows (cell, left, right), the largest radii."""

    def __init__(self, index: MultiIndex, cells: list[Row], blocks: dict[int, range]):
        self.index, self.half = index, index.left.shape[1]
        self.i, self.j = np.divmod(np.array([c["cell"] for c in cells], dtype=int), len(index.right))
        self.left, self.right = (np.array([c[k] for c in cells], dtype=float) for k in ("left", "right"))
        norms = np.linalg.norm(index.left, axis=1)[self.i] + self.left + np.linalg.norm(index.right, axis=1)[self.j] + self.right
        self.reach = norms.max(initial=0.0)
        self.at = np.array([k for k, c in enumerate(cells) for _ in blocks[c["cell"]]], dtype=int)
        self.block = np.array([b for c in cells for b in blocks[c["cell"]]], dtype=int)

    def blocks(self, query: np.ndarray, score: float) -> np.ndarray:
        """Blocks that can hold a row of at least ``score``."""
        a, b = query[: self.half], query[self.half :]
        most = (self.index.left @ a)[self.i] + (self.index.right @ b)[self.j]
        most += np.linalg.norm(a) * self.left + np.linalg.norm(b) * self.right
        # Products round differently from place to place.
        most += 1e-9 * (1 + np.linalg.norm(query) * self.reach)
        return np.unique(self.block[~(most < score)[self.at]])


PACKED = ["block", "part", "kind", "ids", "floors", "vectors"]


class Repeated:
    """Rows of a matrix taken by number, repeated only when they are asked for."""

    def __init__(self, matrix: np.ndarray, who: np.ndarray):
        self.matrix, self.who = matrix.astype(float), who

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        return self.matrix[self.who[places]]


def turns(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number below ``counts`` for each id, spread evenly."""
    return (ids * 2654435761 % (1 << 32)) % counts


def best_of_block(block: int, ids: np.ndarray, vectors: np.ndarray, asked: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a block for each query, of those that reach its floor; with a floor of minus infinity
    a query has a row even if nothing is found, which shows that it was here."""
    rough = queries @ vectors.T
    begun = floors == -np.inf
    floor = floors.copy()
    if len(ids) > k + 1 and begun.any():
        floor[begun] = np.partition(rough[begun], -k - 1, axis=1)[:, -k - 1]
    # The matrix product rounds differently from place to place: it picks, the sum decides.
    floor -= 1e-9 * (1 + np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max())
    q, v = np.nonzero(~(rough < floor[:, None]) & (ids != asked[:, None]))
    scores = np.empty(len(q))
    for at in range(0, len(q), 1 << 15):
        few = slice(at, at + (1 << 15))
        scores[few] = (vectors[v[few]] * queries[q[few]]).sum(axis=1)
    order = np.lexsort((ids[v], -scores, q))
    ends = np.searchsorted(q, np.arange(len(asked) + 1))
    out = [
        (query_id, block, ids[v[order[a : min(a + k, b)]]], scores[order[a : min(a + k, b)]])
        for query_id, begins, a, b in zip(asked, begun, ends, ends[1:])
        if begins or b > a
    ]
    return pd.DataFrame(out, columns=["query_id", "block", "ids", "scores"])


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, one per id."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0)
    )
    return good.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def fit(rows: DataFrame, count: int, max_training_rows: int = 20_000) -> MultiIndex | None:
    """Centroids from at most about ``max_training_rows`` rows, chosen by a hash of the id; their number per
    half is the fourth root of the rows, so there are as many cells as rows in a cell."""
    sample = hashed_sample(rows, "vec_id", max_training_rows).orderBy("vec_id").toPandas()
    if sample.empty:
        return None
    dimension = int(sample["vector"].map(len).mode().iloc[0])
    vectors = np.stack([v for v in sample["vector"] if len(v) == dimension]).astype(float)
    half, k = max(1, dimension // 2), int(np.clip(round(count**0.25), 2, 1024))
    right = vectors[:, half:] if dimension > 1 else np.zeros((len(vectors), 0))
    return MultiIndex(centroids(vectors[:, :half], k), centroids(right, k) if right.shape[1] else np.zeros((1, 0)), dimension)


def search(rows: DataFrame, is_query: Column, k: int = 20, share: float = 0.05, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row on whose vec_id ``is_query`` holds.

    In the first round cells are walked until they hold ``share`` of all rows, in the second all cells are
    looked at that can hold one of the ``k`` nearest. ``share`` has no part in what is found, only in what it
    costs: vectors with structure leave little for the second round; directions at random in 64 dimensions,
    where the nearest of 50,000 is at a cosine of 0.4, leave it all rows, whatever the index."""
    known = store(usable(rows, key, vector), "ann-rows")
    count = known.count()
    index = fit(known, count)
    result = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return rows.sparkSession.createDataFrame([], result)
    wanted = max(5 * k, int(share * count)) + 1
    fitting = known.where(F.size("vector") == index.dimension)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = np.stack(batch["vector"])
                batch["cell"] = index.cell(vectors)
                batch["left"], batch["right"] = index.radii(vectors, batch["cell"].to_numpy())
                yield batch

    placed = store(fitting.mapInPandas(assign, "vec_id long, vector array<double>, cell long, left double, right double"), "ann-cells")
    # At most one row per pair of centroids.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("left").alias("left"), F.max("right").alias("right")).collect()
    sizes = {r["cell"]: r["n"] for r in cells}
    blocks = blocks_of(sizes, int(np.clip(count // 64, *BLOCK_ROWS)))
    bounds = Bounds(index, cells, blocks)
    queries = placed.where(is_query).select("vec_id", "vector")
    per_row = max(1, ROW_BYTES // (8 * index.dimension))
    ask = "vec_id long, floor double, blocks array<long>"
    packed = "block long, part long, kind int, ids array<long>, floors array<double>, vectors binary"

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            walks = [walk(*index.distances(np.asarray(x)), sizes, wanted) for x in batch["vector"]]
            looked_at = [sorted({b for c in cells for b in blocks[c]}) for cells in walks]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "floor": -np.inf, "blocks": looked_at})

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = zip(batch["vector"], batch["floor"], batch["seen"])
            batch["blocks"] = [np.setdiff1d(bounds.blocks(np.asarray(x), floor), seen) for x, floor, seen in asked]
            yield batch[["vec_id", "floor", "blocks"]]

    def found(asks: DataFrame) -> DataFrame:
        """The ``k`` best of every block for each query that asks for it, of those that reach its floor."""
        asks = store(asks, "ann-asks")
        # A row for each block.
        counts = asks.select(F.explode("blocks").alias("block")).groupBy("block").count().collect()
        parts = {r["block"]: -(-r["count"] // BLOCK_QUERIES) for r in counts}

        def rows_of(kind: int, block, part, ids, floors, matrix) -> Iterator[pd.DataFrame]:
            order = np.lexsort((part, block))
            block, part = block[order], part[order]
            new = np.flatnonzero((block[1:] != block[:-1]) | (part[1:] != part[:-1])) + 1
            out = []
            for begin, stop in zip([0, *new], [*new, len(block)]):
                for at in range(begin, stop, per_row):
                    few = order[at : min(at + per_row, stop)]
                    out.append((block[at], part[at], kind, ids[few], floors[few], matrix[few].tobytes()))
                    if len(out) == 1000:
                        yield pd.DataFrame(out, columns=PACKED)
                        out = []
            if out:
                yield pd.DataFrame(out, columns=PACKED)

        def asking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 500):
                    few = batch.iloc[at : at + 500]
                    who = np.repeat(np.arange(len(few)), few["blocks"].map(len))
                    if len(who):
                        block = np.concatenate(few["blocks"].to_list())
                        ids = few["vec_id"].to_numpy()
                        part = turns(ids[who], np.array([parts[b] for b in block.tolist()]))
                        # Only numbers are repeated here, vectors as each row is packed.
                        yield from rows_of(1, block, part, ids[who], few["floor"].to_numpy()[who], Repeated(np.stack(few["vector"]), who))

        def holding(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                own = [blocks[c] for c in batch["cell"]]
                block = np.array([b[0] for b in own]) + turns(batch["vec_id"].to_numpy(), np.array([len(b) for b in own]))
                copies = np.array([parts.get(b, 0) for b in block.tolist()])
                who = np.repeat(np.arange(len(batch)), copies)
                if len(who):
                    part = np.arange(len(who)) - np.repeat(np.cumsum(copies) - copies, copies)
                    vectors = Repeated(np.stack(batch["vector"]), who)
                    yield from rows_of(0, block[who], part, batch["vec_id"].to_numpy()[who], np.zeros(len(who)), vectors)

        def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            key, ids, vectors = None, [], []
            for batch in batches:
                marks = batch[["block", "part", "kind"]].to_numpy()
                new = (np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist()
                for begin, stop in zip([0, *new], [*new, len(batch)] if len(batch) else []):
                    block, part, kind = marks[begin].tolist()
                    rows = batch.iloc[begin:stop]
                    numbers = np.concatenate(rows["ids"].to_list())
                    matrix = np.frombuffer(b"".join(rows["vectors"])).reshape(len(numbers), index.dimension)
                    if key != (block, part):
                        key, ids, vectors = (block, part), [], []
                    if not kind:
                        ids.append(numbers)
                        vectors.append(matrix)
                        continue
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    floors = np.concatenate(rows["floors"].to_list())
                    for at in range(0, len(numbers), 256):
                        few = slice(at, at + 256)
                        yield best_of_block(block, ids[0], vectors[0], numbers[few], matrix[few], floors[few], k)

        both = placed.mapInPandas(holding, packed).union(queries.join(asks, "vec_id").mapInPandas(asking, packed))
        together = both.repartition(max(1, min(sum(parts.values()), 20_000)), "block", "part").sortWithinPartitions("block", "part", "kind")
        return together.mapInPandas(rerank, "query_id long, block long, ids array<long>, scores array<double>")

    def merged(lists: DataFrame) -> DataFrame:
        """A query's lists are one per block it looked at, each at most k long."""
        zipped = lists.select("query_id", "block", F.arrays_zip((F.transform("scores", lambda s: -s)).alias("far"), F.col("ids").alias("id")).alias("x"))
        best = F.slice(F.array_sort(F.flatten(F.collect_list("x"))), 1, k)
        return zipped.groupBy("query_id").agg(best.alias("x"), F.collect_list("block").alias("seen"))

    near = store(found(queries.mapInPandas(first, ask)), "ann-near")
    floor = F.when(F.size("x") >= k, -F.col("x")[k - 1]["far"]).otherwise(F.lit(float("-inf")))
    begun = merged(near).select(F.col("query_id").alias("vec_id"), floor.alias("floor"), "seen")
    rest = found(queries.join(begun, "vec_id").mapInPandas(second, ask))
    ranked = merged(near.unionByName(rest)).select("query_id", F.posexplode("x").alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"))
