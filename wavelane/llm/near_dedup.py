"""MinHash near-dedup with SetSketch registers.

A register holds the smallest of many exponentially distributed values, rounded on an exponential scale and
truncated to 16 bits: ``clip(floor(1 - log_b x), 0, q + 1)``. Registers of a union are the element-wise
maximum of the registers, so sketches merge; two registers are equal with a probability close to the Jaccard
similarity. Documents that agree on a band of registers are candidates; from both sketches and the set sizes
the similarity is estimated by maximum likelihood; what may reach the limit is confirmed on the full sets.

Work is kept near the number of documents. Equal sets become one class. In a band's bucket each member is
first compared with one hub only: the member that shares its buckets with the most others, which in a group
of near copies is the one closest to the text they come from. Once these links are joined to components,
members of one bucket that are still apart are compared with each other, so no candidate that could join two
components is left out. They are compared in blocks of ``BLOCK`` documents, and only links leave a block: a
large group of texts just too different to be linked makes work, but no rows. Components come from rounds of
contraction, each written to the shared folder.

Defined results: a null, empty or blank text has an empty set, is linked with nothing and is its own
component; a row that repeats another is returned as often; different texts with one id are compared each, and
belong together; a null id takes no part and is its own component (null); extra columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavelane.llm.common import discard, runs_of, store
from wavelane.llm.shingles import WordHashes, mixed, shingle_set

REGISTERS, BAND, BASE, RATE, TOP = 128, 4, 1.001, 20.0, 65534
PERCENT = 75
#: Candidates whose estimate lies this far below the limit go on to the exact check: four and a half standard
#: errors of an estimate from all registers.
SLACK = 0.17
BLOCK = 128

SKETCH_SCHEMA = "doc_id long, n_shingles long, set_hash binary, registers binary"


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes.

    Every element scatters its points in ascending order over all registers, one per register: point j of
    m lies in the j-th of m intervals that are equally likely for an exponential value, its register comes
    from a walk with odd stride. Round j places the j-th point of every element; a set is done when the next
    interval starts above the largest register minimum, so big sets take few rounds.
    """
    lowest = np.full(REGISTERS, np.inf)
    if not len(elements):
        return np.zeros(REGISTERS, np.uint16)
    start = mixed(elements + np.uint64(0x51ED270B))
    stride = mixed(elements + np.uint64(0x2545F491)) | np.uint64(1)
    for j in range(REGISTERS):
        if -np.log1p(-j / REGISTERS) >= lowest.max():
            break
        salt = np.uint64((j + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF)
        unit = (mixed(elements + salt) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        value = -np.log((REGISTERS - j - unit) / REGISTERS)
        register = ((start + np.uint64(j) * stride) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(lowest, register, value)
    scaled = np.floor(1.0 - np.log(np.maximum(lowest, 1e-300) / RATE) / np.log(BASE))
    return np.clip(scaled, 0, TOP + 1).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs (rows of a and b) with known set sizes.

    With shares u, v of the sizes, a register is larger in a with probability p(u - vJ), in b with p(v - uJ),
    where p(x) = -log_b(1 - x (b-1)/b). The likelihood is concave in J: golden-section search.
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1.0 - u

    def probability(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = probability(u - v * j), probability(v - u * j)
        tiny = 1e-12
        return more * np.log(np.maximum(p, tiny)) + less * np.log(np.maximum(q, tiny)) + same * np.log(np.maximum(1 - p - q, tiny))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5.0) - 1) / 2
    for _ in range(40):
        x, y = high - golden * (high - low), low + golden * (high - low)
        right = likelihood(x) < likelihood(y)
        low, high = np.where(right, x, low), np.where(right, high, y)
    return (low + high) / 2


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Per row of registers one 64-bit key per band; four 16-bit registers fill it, the band goes into the mix."""
    rows = registers.reshape(len(registers), -1, BAND).astype(np.uint64)
    packed = rows[..., 0] | rows[..., 1] << np.uint64(16) | rows[..., 2] << np.uint64(32) | rows[..., 3] << np.uint64(48)
    return mixed(packed + np.arange(rows.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def _set_hash(members: np.ndarray) -> bytes:
    """Equal for equal sets, 192 bits."""
    parts = [mixed(members).sum(), np.bitwise_xor.reduce(mixed(members ^ np.uint64(0xABCDEF))), np.uint64(len(members))]
    return np.array(parts, np.uint64).tobytes()


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                members = shingle_set(text, hashes)
                if not len(members):
                    rows.append((doc_id, 0, None, None))
                    continue
                registers = sketch(members)
                rows.append((doc_id, len(members), _set_hash(members), registers.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_hash", "registers"],
            )


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and key of every band."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            registers = np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(part.num_rows, REGISTERS)
            keys = band_keys(registers)
            ids = np.repeat(part.column("doc_id").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.ravel())], names=["doc_id", "key"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, hash and sorted shingle hashes of each text's set."""
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = [shingle_set(text, hashes) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    pa.array([_set_hash(x) for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ],
                names=["doc_id", "set_hash", "members"],
            )


def _likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    limit = PERCENT / 100 - SLACK
    for batch in batches:
        for at in range(0, len(batch), 2048):
            part = batch.iloc[at : at + 2048]
            a, b = (np.frombuffer(b"".join(part[c]), np.uint16).reshape(len(part), -1) for c in ("registers_a", "registers_b"))
            na, nb = part["n_a"].to_numpy(float), part["n_b"].to_numpy(float)
            likely = estimate(a, b, na, nb) >= limit
            yield part.loc[likely, ["a", "b"]]


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        good = []
        for x, y in zip(batch["members_a"], batch["members_b"]):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.loc[np.array(good, bool), ["a", "b"]]


def _confirm(pairs: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a < b, distinct) that reach the limit: first by the sketches, then on the full sets."""
    side = lambda x: heads.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"registers_{x}"))
    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = sized.where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(PERCENT) * F.greatest("n_a", "n_b"))
    likely = store(sized.mapInPandas(_likely, "a long, b long"), "near-likely")
    side = lambda x: sets.select(F.col("doc_id").alias(x), F.col("members").alias(f"members_{x}"))
    both = likely.join(side("b"), "b").join(side("a"), "a")
    links = store(both.mapInPandas(_verified, "a long, b long"), "near-links")
    discard(likely)
    return links


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in runs_of(batches, ["group", "low", "high"]):
        links = _linked_in_block(table.to_pandas())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])


def _linked_in_block(rows: pd.DataFrame) -> list[tuple[int, int]]:
    """Links between the documents of two blocks (or in one) that share a band and have different labels."""
    low, high = (rows[rows["block"] == rows[c].iloc[0]] for c in ("low", "high"))
    one_block = rows["low"].iloc[0] == rows["high"].iloc[0]
    unpack = lambda x: np.frombuffer(b"".join(x["registers"]), np.uint16).reshape(len(x), REGISTERS)
    registers_b, label_b, id_b = unpack(high), high["label"].to_numpy(), high["doc_id"].to_numpy()
    sets_b = [np.frombuffer(x, np.uint64) for x in high["members"]]
    size_b = np.array([len(x) for x in sets_b], float)
    out: list[tuple[int, int]] = []
    for registers, label, doc_id, packed in zip(unpack(low), low["label"], low["doc_id"], low["members"]):
        mine = np.frombuffer(packed, np.uint64)
        n = float(len(mine))
        meet = (label_b != label) & (100 * np.minimum(size_b, n) >= PERCENT * np.maximum(size_b, n))
        if one_block:
            meet &= id_b > doc_id
        near = np.flatnonzero(meet)
        same = (registers_b[near] == registers).reshape(len(near), REGISTERS // BAND, BAND).all(axis=2).any(axis=1)
        near = near[same]
        if not len(near):
            continue
        likely = estimate(np.broadcast_to(registers, (len(near), REGISTERS)), registers_b[near], np.full(len(near), n), size_b[near])
        for k in near[likely >= PERCENT / 100 - SLACK]:
            common = len(np.intersect1d(mine, sets_b[k], assume_unique=True))
            if 100 * common >= PERCENT * (n + size_b[k] - common):
                out.append((min(doc_id, int(id_b[k])), max(doc_id, int(id_b[k]))))
    return out


def _across(apart: DataFrame, heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members (key, doc_id, label) of one bucket whose labels differ.

    Documents connected over shared buckets are one group, cut into blocks by a hash; each pair of a group's
    blocks meets in a task of its own."""
    first = apart.groupBy("key").agg(F.min("doc_id").alias("a"))
    touching = apart.join(first, "key").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    groups = components(touching)
    group = groups.select("doc_id", F.col("label").alias("group"))
    sizes = group.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("blocks"))
    members = apart.select("doc_id", "label").distinct().join(group, "doc_id").join(sizes, "group")
    members = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    members = members.join(heads.select("doc_id", "registers"), "doc_id").join(sets.select("doc_id", "members"), "doc_id")
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    keys = ["group", "low", "high"]
    links = store(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_block_batches, "a long, b long"), "near-across")
    discard(groups)
    return links


def components(links: DataFrame) -> DataFrame:
    """doc_id and the smallest id reachable over links (a, b), for every id in a link.

    By randomised contraction: each round gives the ids another random order, every id goes over to the first of
    its neighbours and itself, and links are redrawn between what is left. A group around a hub is gone after
    one round, and of a chain about a third goes, so all rounds together read little more than the first."""
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = store(ordered.where("a <> b").distinct(), "near-edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        place = lambda c: F.struct(F.xxhash64(c, F.lit(len(steps))).alias("at"), F.col(c).alias("id"))
        both = edges.union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.min(place("b")).alias("near"))
        step = store(first.select(F.col("a").alias("doc_id"), F.least("near", place("a"))["id"].alias("goes_to")), "near-step")
        steps.append(step)
        ends = [step.select(F.col("doc_id").alias(x), F.col("goes_to").alias(f"{x}_to")) for x in ("a", "b")]
        redrawn = edges.join(ends[0], "a").join(ends[1], "b").where("a_to <> b_to")
        before = edges
        edges = store(redrawn.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "near-edges")
        discard(before)
    discard(edges)
    if not steps:
        return links.select(F.col("a").alias("doc_id"), F.col("b").alias("label")).limit(0)
    ends = steps[-1]
    for step in reversed(steps[:-1]):
        further = ends.select(F.col("doc_id").alias("goes_to"), F.col("goes_to").alias("end"))
        ends = step.join(further, "goes_to", "left").select("doc_id", F.coalesce("end", "goes_to").alias("goes_to"))
    ends = store(ends, "near-ends")
    least = ends.groupBy("goes_to").agg(F.min("doc_id").alias("label"))
    labels = store(ends.join(least, "goes_to").select("doc_id", "label"), "near-labels")
    discard(ends, *steps)
    return labels


def _classes(sets: DataFrame) -> DataFrame:
    """A row for each different set: a number of its own, its smallest id, size and registers.

    The number is a hash; should two sets have the same one, the later goes to the next number."""
    distinct = sets.groupBy("set_hash").agg(
        F.min("doc_id").alias("head"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
    )
    number = F.xxhash64("set_hash")
    again = F.row_number().over(Window.partitionBy(number).orderBy("set_hash")) - 1
    return distinct.select((number + again).alias("doc_id"), "set_hash", "head", "n_shingles", "registers")


def _with_labels(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the labels of their ends."""
    ends = [labels.select(F.col("doc_id").alias(x), F.col("label").alias(f"{x}_to")) for x in ("a", "b")]
    both = links.join(ends[0], "a", "left").join(ends[1], "b", "left")
    return both.select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    return _near_duplicates(docs)[0]


def _near_duplicates(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """What ``near_duplicates`` returns, and the stored tables that it is read from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = store(texts.mapInArrow(_sketch_batches, SKETCH_SCHEMA), "near-sketches")
    sets = sketches.where("n_shingles > 0 and doc_id is not null")
    # Equal sets are one class. From here to the end, doc_id is the number of a class.
    heads = store(_classes(sets), "near-heads")
    buckets = heads.select("doc_id", "registers").mapInArrow(_band_batches, "doc_id long, key long")
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = store(buckets.join(sizes, "key"), "near-buckets")
    company = store(crowded.groupBy("doc_id").agg(F.sum("n").alias("company")), "near-company")
    ranked = store(crowded.select("key", "doc_id").join(company, "doc_id"), "near-ranked")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("company", "doc_id")).alias("x")).select("key", F.col("x.doc_id").alias("hub"))
    to_hub = ranked.join(hubs, "key").where("doc_id <> hub")
    to_hub = store(to_hub.select(F.least("doc_id", "hub").alias("a"), F.greatest("doc_id", "hub").alias("b")).distinct(), "near-to-hub")
    discard(ranked)
    # The sets of all classes that have company in a bucket: what any comparison may need.
    wanted = store(heads.join(company, "doc_id", "left_semi").select("doc_id", "set_hash", "head"), "near-wanted")
    members = texts.join(wanted.select(F.col("head").alias("doc_id")), "doc_id", "left_semi")
    members = members.mapInArrow(_set_batches, "doc_id long, set_hash binary, members binary")
    members = members.select(F.col("doc_id").alias("head"), "set_hash", "members").join(wanted, ["head", "set_hash"])
    full = store(members.select("doc_id", "members").dropDuplicates(["doc_id"]), "near-sets")
    discard(company, wanted)
    links = _confirm(to_hub, heads, full)
    labels = components(links)
    discard(to_hub, links)
    # Members of a bucket in different components: every such pair is a candidate that could join them.
    placed = crowded.join(labels, "doc_id", "left").select("key", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    mixed_keys = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    apart = store(placed.join(mixed_keys, "key"), "near-apart")
    discard(crowded)
    more = _across(apart, heads, full)
    discard(apart, full)
    # Different texts of one id belong together.
    numbers = heads.select("set_hash", F.col("doc_id").alias("class"))
    several = sets.groupBy("doc_id").agg(F.min("set_hash").alias("lo"), F.max("set_hash").alias("hi")).where("lo < hi")
    of_id = sets.join(several.select("doc_id", "lo"), "doc_id").select("set_hash", "lo").distinct().join(numbers, "set_hash")
    of_id = of_id.join(numbers.select(F.col("set_hash").alias("lo"), F.col("class").alias("b")), "lo").select(F.col("class").alias("a"), "b")
    joined = components(_with_labels(more.union(of_id), labels))
    further = joined.select(F.col("doc_id").alias("label"), F.col("label").alias("end"))
    ends = heads.select("doc_id", "set_hash", "head").join(labels, "doc_id", "left")
    ends = ends.select("set_hash", "head", F.coalesce("label", "doc_id").alias("label")).join(further, "label", "left")
    ends = store(ends.select("set_hash", "head", F.coalesce("end", "label").alias("label")), "near-ends")
    discard(heads, labels, more, joined)
    least = ends.groupBy("label").agg(F.min("head").alias("component"))
    of_class = ends.join(least, "label").select("set_hash", "component")
    found = sketches.select("doc_id", "n_shingles", "set_hash").join(of_class.withColumnRenamed("set_hash", "of"), F.col("doc_id").isNotNull() & (F.col("set_hash") == F.col("of")), "left")
    found = found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return found.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")), [sketches, ends]


def without_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component of ``docs``, all columns; rows that repeat an id with the same text
    count as copies of each other; rows without an id stay."""
    found, tables = _near_duplicates(docs)
    kept = store(found.where("kept and doc_id is not null").select("doc_id").distinct(), "near-kept")
    discard(*tables)
    stay = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    again = store(again, "near-again")
    if not again.isEmpty():
        once = stay.join(again, "doc_id", "left_anti").select(*docs.columns)
        stay = once.union(stay.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))
    return stay.union(docs.where("doc_id is null"))
