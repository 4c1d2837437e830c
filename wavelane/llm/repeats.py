"""Suffix-array dedup: remove every byte that lies in a 200-byte string which also starts anywhere else.

Texts are UTF-8 bytes; matches never cross documents. Every 200-byte window contains an anchor: a 60-byte
string whose hash is the least of 141 in a row, so equal windows hold equal anchors at equal places. Anchors
whose hash occurs once need no further work. Of repeated anchors, those with all 340 bytes around them
equal to another's are repeated in full; they collapse to one class, however many there are. What is left,
distinct surroundings of one anchor, is written as strings of ten symbols (the anchor, four 35-byte blocks on
either side, an end mark) and suffix-sorted by linear grouping: suffixes that share four symbols, 165 bytes,
are the only possible partners of the windows they lie in, and these windows are then compared exactly.

Surroundings of one anchor are dealt to tasks by the anchor. Anchors with over ``HOT`` different surroundings
(the edge of a passage that a third of all documents share) are not: their windows are counted by Spark, with
partial sums before the shuffle, so no task gets a whole group.

Comparisons are of 64-bit hashes. Defined results: a null text is empty; texts under 200 bytes and texts of
other rows' bytes never match; a row that repeats another is a second document, so both lose what is over
199 bytes; rows with one doc_id and different texts are different documents; a null doc_id is an ordinary
document; very long texts are scanned in overlapping pieces; columns of the input keep their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from wavelane.llm.common import discard, store
from wavelane.llm.shingles import mixed
from wavelane.llm.suffix_array import equal_runs, suffix_array

LENGTH, BLOCK = 200, 35
SIDE = 4 * BLOCK  # the widest distance from a window's start to its anchor
ANCHOR = LENGTH - SIDE
WIDTH = SIDE + LENGTH  # the surroundings of an anchor: SIDE bytes before it, LENGTH bytes from it on
CORE = LENGTH - BLOCK  # four symbols, one of them the anchor
HOT = 250
STEP = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were ever needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        if len(cls.up) < n:
            size = 1 << n.bit_length()
            for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(size, _U(x))
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Along the last axis: h[b] - h[a], scaled by ``_Powers.up[a]``, is a hash of data[a:b]."""
    n = data.shape[-1]
    _Powers.upto(n + 1)
    sums = np.zeros((*data.shape[:-1], n + 1), np.uint64)
    np.cumsum(_BYTES[data] * _Powers.down[:n], axis=-1, out=sums[..., 1:])
    return sums


def _least_positions(values: np.ndarray, width: int) -> np.ndarray:
    """Sorted positions that hold the least value (the leftmost of equals) of some ``width`` in a row."""
    n, bits = len(values), len(values).bit_length()
    tagged = (values >> _U(bits) << _U(bits)) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, _U(2**64 - 1))
    padded[:n] = tagged
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _U((1 << bits) - 1)
    return least[np.r_[True, least[1:] != least[:-1]]].astype(np.int64)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of a text's anchors, their hashes, and the hashes of their surroundings."""
    n = len(data)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, n - LENGTH + 1, STEP):
        last = min(first + STEP, n - LENGTH + 1)  # windows that start in [first, last)
        low, high = max(0, first - SIDE), min(n, last + 2 * LENGTH)
        sums = _prefix_hashes(data[low:high])
        begin = np.arange(first - low, last - 1 + SIDE + 1 - low)
        keys = mixed((sums[begin + ANCHOR] - sums[begin]) * _Powers.up[begin])
        at = _least_positions(keys, SIDE + 1)
        keys, at = keys[at], at + first
        a, b = np.maximum(at - SIDE, 0), np.minimum(at + LENGTH, n)
        around = _around(sums, a - low, b - low, at - a, b - at)
        found.append((at, keys, around))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    at, keys, around = (np.concatenate(x) for x in zip(*found))
    at, once = np.unique(at, return_index=True)
    return at, keys[once], around[once]


def _around(sums, a, b, before, after) -> np.ndarray:
    """Hash of the bytes from a to b and of where the anchor lies in them."""
    return mixed((sums[b] - sums[a]) * _Powers.up[a] + mixed((before * 1024 + after).astype(np.uint64)))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc", "version", "at", "key", "around"]
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            rows, found = [], []
            for k, text in enumerate(part.column("text").to_pylist()):
                x = anchors(_bytes(text))
                rows.append(np.full(len(x[0]), k))
                found.append(x)
            row = pa.array(np.concatenate(rows))
            at, key, around = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc").take(row),
                    part.column("version").take(row),
                    pa.array(at.astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(around.view(np.int64)),
                ],
                names=names,
            )


PIECE = "key long, hot boolean, alone boolean, doc long, version int, at int, before int, body binary"


def _piece_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings to compare, cut out of their texts."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            rows = []
            for x in batch.slice(begin, 256).to_pylist():
                data = (x["text"] or "").encode("utf-8", "surrogatepass")
                for p in x["pieces"]:
                    at = p["at"]
                    before = min(at, SIDE)
                    rows.append((p["key"], p["hot"], p["alone"], x["doc"], x["version"], at, before, data[at - before : at + LENGTH]))
            kinds = (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["key", "hot", "alone", "doc", "version", "at", "before", "body"],
            )


class _Pieces:
    """Surroundings as a matrix of bytes, anchors at column SIDE, and their window hashes."""

    def __init__(self, keys: np.ndarray, before: np.ndarray, bodies: list[bytes]):
        self.keys = mixed(keys.view(np.uint64))
        n = len(bodies)
        self.begin = SIDE - before
        self.stop = self.begin + np.fromiter(map(len, bodies), np.int64, n)
        self.data = np.zeros((n, WIDTH), np.uint8)
        for k, body in enumerate(bodies):
            self.data[k, self.begin[k] : self.stop[k]] = np.frombuffer(body, np.uint8)
        self.sums = _prefix_hashes(self.data)

    def hashes(self, column: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the bytes from ``column`` on, with key and column; whether they are all there."""
        value = (self.sums[:, column + width] - self.sums[:, column]) * _Powers.up[column] + self.keys
        return mixed(value + _U(column * 7919 + width)), (self.begin <= column) & (self.stop >= column + width)

    def symbols(self) -> np.ndarray:
        """Ten symbols a row: four blocks, the anchor, four blocks, an end mark. What is not all there gets a
        symbol that occurs nowhere else."""
        n = len(self.keys)
        out = mixed(np.arange(10 * n, dtype=np.uint64) + _U(0x5EED << 40)).reshape(n, 10)
        out[:, 4] = self.keys
        for j in range(4):
            for column, at in ((j, j * BLOCK), (j + 5, SIDE + ANCHOR + j * BLOCK)):
                value = mixed((self.sums[:, at + BLOCK] - self.sums[:, at]) * _Powers.up[at])
                there = (self.begin <= at) & (self.stop >= at + BLOCK)
                out[there, column] = value[there]
        return out.view(np.int64)


def _starts(pieces: _Pieces, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the windows of rows ``alone`` that equal a window of another row of the same key."""
    text = pieces.symbols().ravel()
    order = suffix_array(text)
    column = order % 10
    order = order[(column >= 1) & (column <= 4)]
    run = equal_runs(text, order, 4)
    size = np.bincount(run, minlength=1)
    shared = order[size[run] > 1]
    rows_found, columns_found = [], []
    for q in range(4):
        rows = np.sort(shared[shared % 10 == 4 - q] // 10)
        if not len(rows):
            continue
        for e in range(BLOCK + 1):
            at = SIDE - q * BLOCK - e
            if at < 0 or (e == BLOCK and q < 3):  # the next q has it
                continue
            value, there = pieces.hashes(at, LENGTH)
            value, there = value[rows], there[rows]
            usable = rows[there]
            _, inverse, count = np.unique(value[there], return_inverse=True, return_counts=True)
            repeated = usable[count[inverse] > 1]
            repeated = repeated[alone[repeated]]
            rows_found.append(repeated)
            columns_found.append(np.full(len(repeated), at))
    if not rows_found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows_found), np.concatenate(columns_found)


CUT = "doc long, version int, low int, high int"


def _cold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of repeated bytes; rows come sorted by key, a key has at most HOT rows."""
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> pa.RecordBatch:
        pieces = _Pieces(table["key"].to_numpy(), table["before"].to_numpy().astype(np.int64), table["body"].to_pylist())
        rows, columns = _starts(pieces, table["alone"].to_numpy().astype(bool))
        low = table["at"].to_numpy()[rows].astype(np.int64) - SIDE + columns
        order = np.lexsort((low, rows))
        rows, low = rows[order], low[order]
        # Windows of a row that touch become one interval.
        fresh = np.r_[True, (rows[1:] != rows[:-1]) | (low[1:] > low[:-1] + LENGTH)] if len(rows) else np.empty(0, bool)
        first = np.flatnonzero(fresh)
        last = np.r_[first[1:], len(rows)][: len(first)] - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array(table["doc"].to_numpy()[rows[first]]),
                pa.array(table["version"].to_numpy()[rows[first]]),
                pa.array(low[first].astype(np.int32)),
                pa.array((low[last] + LENGTH).astype(np.int32)),
            ],
            names=["doc", "version", "low", "high"],
        )

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 8000:
            table = pa.Table.from_batches(held)
            keys = table["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if cut:
                for begin, stop in _by_key(keys[:cut], 8000):
                    yield solve(table.slice(begin, stop - begin))
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
    if size:
        table = pa.Table.from_batches(held)
        for begin, stop in _by_key(table["key"].to_numpy(), 8000):
            yield solve(table.slice(begin, stop - begin))


def _by_key(keys: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Slices of about ``size`` rows that end where a key ends."""
    begin = 0
    while begin < len(keys):
        stop = min(begin + size, len(keys))
        stop = int(np.searchsorted(keys, keys[stop - 1], "right"))
        yield begin, stop
        begin = stop


HOT_WINDOWS = "core long, q int, windows array<long>, whole long, alone boolean, doc long, version int, at int"


def _hot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece and block: the hash of the shared 165 bytes, those of its windows and that of
    all the bytes they cover (null: not all there)."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 2048):
            part = batch.slice(begin, 2048)
            pieces = _Pieces(part.column("key").to_numpy(), part.column("before").to_numpy().astype(np.int64), part.column("body").to_pylist())
            for q in range(4):
                core, there = pieces.hashes(SIDE - q * BLOCK, CORE)
                first = SIDE - q * BLOCK
                rows = pa.array(np.flatnonzero(there))

                def lists(spans: list[tuple[int, int]]) -> pa.ListArray:
                    values, usable = zip(*(pieces.hashes(c, width) for c, width in spans))
                    flat = pa.array(np.stack(values, 1).view(np.int64)[there].ravel(), mask=~np.stack(usable, 1)[there].ravel())
                    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(spans)), flat)

                windows = lists([(first - e, LENGTH) for e in range(BLOCK + (q == 3))])
                whole = lists([(first - BLOCK + (q < 3), LENGTH + BLOCK - (q < 3))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)).take(rows),
                        pa.array(np.full(len(rows), q, np.int32)),
                        windows,
                        whole.flatten(),
                        *(part.column(c).take(rows) for c in ("alone", "doc", "version", "at")),
                    ],
                    names=["core", "q", "windows", "whole", "alone", "doc", "version", "at"],
                )


def _hot_intervals(pieces: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """What ``_cold_batches`` finds, for anchors with very many surroundings, by counting hashes; and the stored
    tables that it is read from."""
    every = store(pieces.mapInArrow(_hot_batches, HOT_WINDOWS), "repeat-hot")
    cores = store(_more_than_once(every, "core"), "repeat-cores")
    rows = store(every.join(cores, "core"), "repeat-hot-cores")
    discard(every, cores)
    # Where all the windows are repeated together, none needs a look of its own.
    spans = store(_more_than_once(rows, "whole"), "repeat-spans")
    first = F.col("at") - F.col("q") * BLOCK
    low = first - BLOCK + (F.col("q") < 3).cast("int")
    whole = rows.where("alone").join(spans, "whole").select("doc", "version", low.alias("low"), (first + LENGTH).alias("high"))
    windows = rows.select(F.explode("windows").alias("hash")).where("hash is not null")
    seen = store(_more_than_once(windows, "hash"), "repeat-windows")
    left = rows.where("alone").join(spans, "whole", "left_anti").select("doc", "version", first.alias("first"), F.posexplode("windows").alias("e", "hash"))
    low = F.col("first") - F.col("e")
    some = left.join(seen, "hash").select("doc", "version", low.alias("low"), (low + LENGTH).alias("high"))
    return whole.union(some), [rows, spans, seen]


def _more_than_once(rows: DataFrame, column: str) -> DataFrame:
    """The non-null values of ``column`` that several rows have."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("n > 1").select(column)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove what anchors repeated in full and intervals cover."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            out = []
            texts, whole, cuts = (part.column(c).to_pylist() for c in ("text", "whole", "cuts"))
            for text, full, cut in zip(texts, whole, cuts):
                data = _bytes(text)
                n = len(data)
                edge = np.zeros(n + 1, np.int64)
                at = np.array(full or [], np.int64)
                np.add.at(edge, np.maximum(at - SIDE, 0), 1)
                np.add.at(edge, np.minimum(at + LENGTH, n), -1)
                if cut:
                    np.add.at(edge, np.array([c["low"] for c in cut], np.int64), 1)
                    np.add.at(edge, np.array([c["high"] for c in cut], np.int64), -1)
                gone = np.cumsum(edge)[:-1] > 0
                digest = hashlib.sha256(data[~gone].tobytes()).hexdigest()
                # Each byte with its character: one that a cut went through goes whole.
                character = np.cumsum((data & 0xC0) != 0x80)
                kept = data[np.bincount(character, gone)[character] == 0].tobytes()
                spans = int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])) if n else 0
                out.append((n, int(gone.sum()), spans, digest, kept))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )


def remove_repeats(docs: DataFrame, carry: list[str], keep_bytes: bool = False) -> DataFrame:
    """Per row of ``docs``: ``row`` (a struct of the columns ``carry``), n_bytes, n_removed, n_spans,
    kept_sha256 (of the remaining bytes) and, if asked for, ``kept``: these without the bytes of characters that
    a cut went through."""
    text = F.coalesce("text", F.lit(""))
    known = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("doc"),
        F.hash(text).alias("version"),
        text.alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
    )
    found = store(
        known.select("doc", "version", "text").mapInArrow(_anchor_batches, "doc long, version int, at int, key long, around long"),
        "repeat-anchors",
    )
    again = store(_more_than_once(found, "key"), "repeat-keys")
    repeated = store(found.join(again, "key"), "repeat-repeated")
    discard(found, again)
    classes = store(
        repeated.groupBy("key", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "version", "at")).alias("first")),
        "repeat-classes",
    )
    # Copies of a row (one doc, one text) have their anchors at the same places: each place once per text.
    whole = repeated.join(classes.where("n > 1").select("key", "around"), ["key", "around"]).select("doc", "version", "at").distinct()
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where("m > 1 and least = 1")
    pieces = classes.join(several, "key").select("first.*", "key", (F.col("m") > HOT).alias("hot"), (F.col("n") == 1).alias("alone"))
    orders = whole.withColumns({"key": F.lit(None).cast("long"), "hot": F.lit(None).cast("boolean"), "alone": F.lit(None).cast("boolean")}).unionByName(pieces)
    orders = orders.groupBy("doc", "version").agg(
        F.collect_list(F.when(F.col("key").isNull(), F.col("at"))).alias("whole"),
        F.collect_list(F.when(F.col("key").isNotNull(), F.struct("at", "key", "hot", "alone"))).alias("pieces"),
    )
    # Texts move once: those that nothing repeated touches leave only their digest here.
    touched = F.col("whole").isNotNull()
    placed = store(
        known.join(orders, ["doc", "version"], "left").select(
            "row",
            "doc",
            "version",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(~touched, F.sha2("text", 256)).alias("sha"),
            F.when(touched | F.lit(keep_bytes), F.col("text")).alias("text"),
            "whole",
            "pieces",
        ),
        "repeat-texts",
    )
    discard(repeated, classes)
    cut_out = store(
        placed.where(F.size("pieces") > 0).select("doc", "version", "text", "pieces").mapInArrow(_piece_batches, PIECE), "repeat-pieces"
    )
    cold = cut_out.where("not hot").repartition("key").sortWithinPartitions("key").mapInArrow(_cold_batches, CUT)
    hot, hot_tables = _hot_intervals(cut_out.where("hot"))
    cuts = store(cold.union(hot).groupBy("doc", "version").agg(F.collect_set(F.struct("low", "high")).alias("cuts")), "repeat-cuts")
    discard(cut_out, *hot_tables)
    changed = placed.where(touched).join(cuts, ["doc", "version"], "left").select("row", "text", "whole", "cuts")
    row = changed.schema["row"]
    schema = StructType(
        [row]
        + [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [StructField("kept_sha256", StringType()), StructField("kept", BinaryType())]
    )
    zero = F.lit(0).cast("long")
    same = placed.where(~touched).select("row", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"), F.col("text").cast("binary").alias("kept"))
    out = changed.mapInArrow(_cut_batches, schema).union(same)
    return out if keep_bytes else out.drop("kept")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text`` and ``n_chars``, if there, counted anew. Bytes of a
    character that a cut went through are dropped; rows that the cuts leave without text go."""
    others = [c for c in docs.columns if c != "text"]
    cut = remove_repeats(docs, others, keep_bytes=True)
    text = F.try_validate_utf8(F.col("kept").cast("string"))
    text = F.coalesce(text, F.make_valid_utf8(F.col("kept").cast("string")))
    cleaned = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cleaned.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
