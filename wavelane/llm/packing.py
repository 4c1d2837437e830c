"""Best-fit packing of tokenised documents into sequences, planned by linear grouping.

Texts are tokenised once, in tasks. Only how many pieces have each length goes to the driver, at most
``capacity`` numbers; the plan made of them (``bin_plan``) says for the k-th piece of a length where it goes.
Pieces are numbered within their length in two steps, in their task and by the tasks' totals before, so a
length that a third of all pieces share is never gathered anywhere.

Defined results: a null text is empty, and an empty text is the end id alone; only documents longer than the
capacity are cut, into pieces of the capacity, the last one may be shorter; rows that repeat are packed each;
extra columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavelane.llm.bin_plan import plan_bins
from wavelane.llm.common import store

CAPACITY = 2048


class WordIds(dict):
    """Ids of a stretch of text without ASCII white space, as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its
    stretches one after the other, and most stretches repeat. A new one of Latin-1 letters, where lower
    case and normal form go character by character, is cut into words by the tokenizer's own pattern and
    each new word goes to its model; others go through the whole tokenizer. Emptied at ``limit`` entries."""

    def __init__(self, path: str, limit: int = 300_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        self.words: dict[str, bytes] = {}
        pattern = _plain_pattern(path)
        self.cut = regex.compile(pattern).findall if pattern else None
        added = [regex.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(added) if added else r"(?!)").search
        self.model = self.tokenizer.model
        # How the model spells bytes: printable ones as themselves, the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelt = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}

    def __missing__(self, stretch: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        text = stretch.decode("utf-8", "replace")
        if self.cut and (text.isascii() or max(text) <= "\xff") and not self.special(text):
            found = b"".join([self.words.get(w) or self._word(w) for w in self.cut(text.lower())])
        else:
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[stretch] = found
        return found

    def _word(self, word: str) -> bytes:
        if len(self.words) >= self.limit:
            self.words.clear()
        spelt = word if word.isascii() and word.isprintable() else "".join(map(self.spelt.__getitem__, word.encode()))
        self.words[word] = found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])
        return found

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").encode("utf-8", "replace").split()))


def _plain_pattern(path: str) -> str | None:
    """The tokenizer's word pattern, if it is of the kind that ``WordIds`` can cut by itself: white space in
    any run, lower case, words by one pattern, then bytes. White space is spelt out, as libraries differ."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if kinds != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    if cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"] or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
        return None
    return cuts[0]["pattern"]["Regex"].replace(r"\s", r"\x09-\x0d\x20\x85\xa0")


def _tokenise(path: str, capacity: int, end_id: int, keep_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        end = np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", *["ids"] * keep_ids]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * keep_ids)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    data = words.ids(text) + end
                    for k, begin in enumerate(range(0, len(data), 4 * capacity)):
                        body = data[begin : begin + 4 * capacity]
                        length = len(body) // 4
                        row = (doc_id, k, begin // 4, length, zlib.crc32(body), task, seen[length])
                        rows.append((*row, np.frombuffer(body, "<u4")) if keep_ids else row)
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names=names)

    return pieces


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ``ids`` if asked for.
    The tokenizer's file must lie at ``tokenizer_path`` on every machine."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<long>" * keep_ids
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    cut = store(texts.mapInArrow(_tokenise(tokenizer_path, capacity, end_id, keep_ids), schema), "pack-pieces")
    by_task = store(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    # At most ``capacity`` rows.
    counts = {row["length"]: row["n"] for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan_bins(counts, capacity)
    slots.sort(key=lambda s: (s.length, s.first))
    table = np.array(slots, np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    names = [c for c in cut.columns if c not in ("task", "nth")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = table[np.searchsorted(starts, length << 44 | rank, "right") - 1] if batch.num_rows else table[:0]
            nth = rank - slot[:, 1]
            sequence, offset = slot[:, 4] + nth // np.maximum(slot[:, 3], 1), slot[:, 5] + nth % np.maximum(slot[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    ranked = cut.join(earlier, ["task", "length"]).select(*names, (F.col("nth") + F.col("earlier")).alias("rank"))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return ranked.mapInArrow(place, out + ", sequence_id long, offset long")
