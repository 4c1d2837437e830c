"""Repair of conversations whose turns are blank, repeated, broken off or out of order.

Turns are judged by column expressions, and dealt by conversation and block of turn numbers, not by
conversation alone: each task codes its blocks by one letter a turn and finds the cheapest edits from each way
a block may be entered to each way it may be left (``edit_lattice``). Only these few short ways a block are then
put together along a conversation. Its turns pass once more, in order and without being gathered, to be edited;
a digest of a whole conversation is sequential by its nature.

Defined results: nulls count as one space; turns are taken by number, nulls first, then by role, then by the
SHA-256 of the text, copies next to each other; a null conv_id is a conversation of its own; of equal rows the
first stays; a conversation without turns needs no edits; extra columns are not looked at; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import WHITE, byte_steps, store
from wavelane.llm.edit_lattice import NONE, USER, block_ways, join_ways

BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS  # turns that are solved together
ORDER = ["role", "digest", "copy"]
LEGAL = {"su", "ua", "au"}


def _or_space(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def turns(conversations: DataFrame) -> DataFrame:
    """The rows as the repair takes them: ``key`` stands for conv_id, ``dropped`` rows only keep it alive."""
    return conversations.select(
        _or_space(F.col("conv_id")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        _or_space(F.col("role")).alias("role"),
        _or_space(F.col("text")).alias("text"),
        F.lit(0).alias("copy"),
        F.lit(False).alias("dropped"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Faults by a hash of conversation and turn: one in twenty rows each is dropped, emptied, loses its ends of
    sentences, is repeated, or goes to the user."""
    fault = F.crc32(F.concat("key", F.lit(":"), _or_space(F.col("turn")))) % 20
    marked = rows.withColumn("fault", fault)
    return marked.select(
        "key",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        (F.col("fault") == 0).alias("dropped"),
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Rows without their texts: what is wrong with them, and the first turn with the same role and text."""
    seen = F.btrim("text", F.lit(WHITE))
    turn = F.coalesce("turn", F.lit(-(1 << 63)))  # nulls come first
    marked = rows.select(
        "key",
        turn.alias("at"),
        F.col("turn").isNull().alias("no_turn"),
        "role",
        F.sha2("text", 256).alias("digest"),
        "copy",
        "dropped",
        (F.length(seen) == 0).alias("blank"),
        (~F.substring(seen, -1, 1).isin(".", "!", "?")).alias("broken"),
    )
    sound = marked.where(~F.col("dropped") & ~F.col("blank"))
    # Copies are put together before they are dealt, and a text that fills its conversation is a row here.
    first = sound.groupBy("key", "role", "digest").agg(F.min("at").alias("first_at"))
    block = F.when(F.col("no_turn"), F.lit(-(1 << 62))).otherwise(F.shiftright("at", BLOCK_BITS))
    return marked.join(first, ["key", "role", "digest"], "left").withColumn("block", block)


def _blocks(rows: DataFrame) -> DataFrame:
    """A row for each block of at most ``BLOCK`` turns: its letters, the roles at its ends, and counts."""
    names = ["key", "block", "part", "codes", "first_role", "last_role", "illegal", "blank", "duplicate", "truncated", "least", "most", "n_turns"]
    schema = "key string, block long, part int, codes string, first_role string, last_role string, illegal long, blank long, duplicate long, truncated long, least long, most long, n_turns long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        before: tuple = ()
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("key", "block", "at", "no_turn", "role", "digest", "dropped", "blank", "broken", "first_at")]
            for key, block, at, no_turn, role, digest, dropped, blank, broken, first_at in zip(*columns):
                place = (key, block)
                if now is None or place != (now["key"], now["block"]) or len(now["codes"]) == BLOCK:
                    part = now["part"] + 1 if now and place == (now["key"], now["block"]) else 0
                    if now:
                        out.append(now)
                    now = dict.fromkeys(names, 0) | {"key": key, "block": block, "part": part, "codes": "", "first_role": None, "last_role": None, "least": None, "most": None}
                    before = before if part else ()
                if dropped:
                    continue
                initial = role[:1]
                if now["codes"]:
                    now["illegal"] += now["last_role"] + initial not in LEGAL
                else:
                    now["first_role"] = initial
                now["last_role"] = initial
                if not no_turn:
                    now["n_turns"] += not before or before[0] != at
                    now["least"], now["most"] = at if now["least"] is None else now["least"], at
                # Equal rows of one turn stand next to each other.
                repeated = not blank and (at != first_at or before == (at, role, digest))
                before = (at, role, digest)
                code = initial if initial in ("s", "u", "a") else "o"
                now["blank"] += blank
                now["duplicate"] += repeated
                now["truncated"] += not blank and not repeated and broken
                now["codes"] += "x" if blank or repeated else code.upper() if broken else code
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if now:
            yield pa.RecordBatch.from_pylist([now], schema=arrow)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block", "at", *ORDER)
    return dealt.mapInArrow(cut, schema)


def _with_ways(blocks: DataFrame) -> DataFrame:
    """The cheapest ways through each block."""
    place = F.struct("block", "part")
    ends = blocks.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    known = blocks.join(ends, "key").withColumns({"first": F.col("first") == place, "last": F.col("last") == place})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("letters", pa.string())])
        for batch in batches:
            ways = []
            for codes, first, last in zip(*(batch.column(c).to_pylist() for c in ("codes", "first", "last"))):
                ways.append([dict(zip(("entry", "exit", "cost", "letters"), w)) for w in block_ways(codes, first, last)])
            yield batch.append_column("ways", pa.array(ways, pa.list_(way)))

    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = known.repartition(tasks, "key", "block", "part")  # short rows, much work: not to be put together
    names = ", ".join(f"{name} {kind}" for name, kind in dealt.dtypes)
    return dealt.mapInArrow(find, names + ", ways array<struct<entry:int,exit:int,cost:long,letters:string>>")


def _joined(blocks: DataFrame) -> DataFrame:
    """Per conversation its counts, the least cost and the letters of its edits."""
    schema = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    counted = ["illegal", "blank", "duplicate", "truncated", "n_turns"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None

        def ended() -> dict:
            cost, audit = min(now["ways"].values())
            gaps = 0 if now["least"] is None else now["most"] - now["least"] + 1 - now["n_turns"]
            return {"key": now["key"], "gaps": gaps, "cost": cost, "audit": audit, **{c: now[c] for c in counted[:4]}}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now is None or now["key"] != row["key"]:
                    if now:
                        out.append(ended())
                    now = dict.fromkeys(counted, 0) | {"key": row["key"], "ways": {NONE: (0, "")}, "role": None, "least": None, "most": None}
                now["ways"] = join_ways(now["ways"], [(w["entry"], w["exit"], w["cost"], w["letters"]) for w in row["ways"]])
                for c in counted:
                    now[c] += row[c]
                if row["codes"]:
                    now["illegal"] += now["role"] is not None and now["role"] + row["first_role"] not in LEGAL
                    now["role"] = row["last_role"]
                if row["most"] is not None:
                    now["least"], now["most"] = row["least"] if now["least"] is None else now["least"], row["most"]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if now:
            yield pa.RecordBatch.from_pylist([ended()], schema=arrow)

    arrow = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in schema.split(", ")])
    return blocks.repartition("key").sortWithinPartitions("key", "block", "part").mapInArrow(join, schema)


def plan_repairs(rows: DataFrame) -> DataFrame:
    """Per ``key``: gaps between turn numbers, faults (a row's first one counts), neighbours whose roles don't
    follow each other, the least cost of a repair and the letters of its edits."""
    blocks = store(_blocks(_judged(rows)), "turn-blocks")
    return _joined(_with_ways(blocks))


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: key, place (from 0), role, text, and the letter of the edit that a turn comes
    from. Each conversation is one run of rows of a partition, in order; one that has no turns left is a row
    without place, so that it stays known."""
    asked = rows.where(~F.col("dropped")).select("key", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"), "copy", "text", F.lit(None).cast("string").alias("audit"))
    none = F.lit(None)
    heads = plans.select("key", F.lit(0), none.cast("long"), none.cast("string"), none.cast("string"), none.cast("int"), none.cast("string"), "audit")
    dealt = asked.union(heads).repartition("key").sortWithinPartitions("key", "kind", F.col("turn").asc_nulls_first(), *ORDER)
    schema = "key string, place long, role string, text string, edit string"

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place = "", 0, NONE, 0

        def inserted() -> list[tuple]:
            nonlocal at, state, place
            out = []
            while at < len(audit) and audit[at] == "I":
                state = answered if state == USER else USER
                out.append((key, place, "user" if state == USER else "assistant", "", "I"))
                at, place = at + 1, place + 1
            return out

        answered = -1
        for batch in batches:
            for part in byte_steps(batch, "text"):
                out = []
                for key, kind, role, text, letters in zip(*(part.column(c).to_pylist() for c in ("key", "kind", "role", "text", "audit"))):
                    if kind == 0:
                        audit, at, state, place = letters, 0, NONE, 0
                        out += inserted()
                        if not audit.strip("D"):
                            out.append((key, None, None, None, None))
                        continue
                    letter, at = audit[at], at + 1
                    if letter == "R":
                        role = "assistant" if state == USER else "user"
                    if letter != "D":
                        state = USER if role[:1] == "u" else answered
                        out.append((key, place, role, text, letter))
                        place += 1
                    out += inserted()
                columns = [list(c) for c in zip(*out)] if out else [[]] * 5
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "place", "role", "text", "edit"])

    return dealt.select("key", "kind", "role", "text", "audit").mapInArrow(edit, schema)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """Per key the SHA-256 of the repaired ``role:text``, joined by line feeds. Reads the rows as they come."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for key, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "place", "role", "text"))):
                if key != last:
                    if last is not None:
                        out.append({"key": last, "repaired_sha256": state.hexdigest()})
                    last, state = key, hashlib.sha256()
                if place is not None:
                    state.update(f"{chr(10) * (place > 0)}{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"key": last, "repaired_sha256": state.hexdigest()}], schema=arrow)

    arrow = pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())])
    return repaired.mapInArrow(digest, "key string, repaired_sha256 string")


def repair(rows: DataFrame, id_type: str = "long") -> DataFrame:
    """The plan of each conversation with the digest of what it repairs to."""
    plans = store(plan_repairs(rows), "repair-plans")
    found = plans.join(repaired_digests(repaired_turns(rows, plans)), "key")
    conv_id = F.when(F.col("key") != " ", F.col("key")).cast(id_type)
    return found.select(conv_id.alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
