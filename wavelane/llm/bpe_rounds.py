"""Byte-level BPE by batched merge rounds in numpy, and back.

A step takes some megabytes of text of one task. Words its tables do not know yet are laid out as symbols in
one flat array. In each round the pairs of neighbours are looked up by binary search over the sorted keys of
all merges, each word takes the pair of its lowest rank, and all such pairs of all words are merged at once;
words without a pair leave the array. Known words cost one lookup; what is known is bounded, so a task's
memory is that of a step. Nothing is shuffled.

Decoding gathers the bytes of all ids of a step from one flat table of the vocabulary.

Defined results: a null text is empty and has no ids; texts of any length are cut into words as a whole; strings
of added tokens in a text are those tokens; rows that repeat are encoded each; columns other than ``doc_id`` and
``text`` are not looked at; an empty table gives an empty result; bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelane.llm.common import byte_steps

# The cut into words of byte-level BPE: fixed.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.iinfo(np.int64).max


def _alphabet() -> dict[str, int]:
    """How the vocabulary spells bytes: printable ones as themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _word_pattern(path: str) -> tuple[str, int]:
    """The cut as the tokenizer sees letters and numbers, and the first UTF-8 lead byte from which it may
    differ from this pattern: code points that its Unicode version does not know yet are neither to it."""
    from tokenizers import Tokenizer

    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    young = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]) if unicodedata.category(c) == "Cn"]
    doubtful = regex.findall(r"[\p{L}\p{N}]", "".join(young))
    # A letter or number is no part of a run of signs.
    signs = [c for c in doubtful if len(cut("!" + c)) == 1]
    if not signs:
        return WORD, 0x100
    ranges: list[list[int]] = []
    for at in map(ord, signs):
        if ranges and ranges[-1][1] == at - 1:
            ranges[-1][1] = at
        else:
            ranges.append([at, at])
    known = "(?![" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "])"
    letters, numbers = rf"(?:{known}\p{{L}})+", rf"(?:{known}\p{{N}})+"
    pattern = WORD.replace(r"\p{L}+", letters, 1).replace(r"\p{N}+", numbers, 1)
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|(?!{known})[\p{{L}}\p{{N}}])+")
    return pattern, signs[0].encode()[0]


class Merges:
    """The merges of a vocabulary file, and words encoded so far."""

    def __init__(self, path: str, known_bytes: int = 1 << 26):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut, added = spec["model"], spec["pre_tokenizer"], spec.get("added_tokens") or []
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or spec.get("normalizer") or cut["type"] != "ByteLevel" or cut["add_prefix_space"]:
            raise ValueError(f"{path}: not a plain byte-level BPE {odd}")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
            raise ValueError(f"{path}: added tokens that look at their surroundings")
        vocabulary, letters = model["vocab"], _alphabet()
        self.first_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first_id[byte] = vocabulary[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, made = (np.array([vocabulary[f(m)] for m in merges], np.int64) for f in (lambda m: m[0], lambda m: m[1], "".join))
        self.size = max(*vocabulary.values(), *(x["id"] for x in added), 0) + 1
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made
        # If each token is made by one merge, after its parts, then no merge makes a pair of lower rank than
        # its own, and all equal pairs of a word can go at once; else only the first one of each word does.
        born = np.full(self.size, -1, np.int64)
        born[made] = np.arange(len(made))
        turn = np.arange(len(made))
        self.ordered = len(set(made.tolist())) == len(made) and bool(((born[left] < turn) & (born[right] < turn)).all())
        self.added = {x["content"]: x["id"] for x in added}
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if added else None
        spelt = {i: t for t, i in vocabulary.items()} | {x["id"]: x["content"] for x in added}
        plain = [bytes(map(letters.__getitem__, t)) if (t := spelt.get(i, "")) and all(c in letters for c in t) else t.encode() for i in range(self.size)]
        self.lengths = np.array([len(x) for x in plain], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.table = np.frombuffer(b"".join(plain), np.uint8)
        self.known: dict[str, bytes] = {}
        self.known_bytes, self.held = known_bytes, 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank[at], NEVER)

    def rounds(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as little-endian 32-bit numbers; no word is empty."""
        found = [b""] * len(words)
        symbol = self.first_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(symbol), NEVER, np.int64)  # of a symbol with the next one of its word
        if len(symbol) > 1 and len(self.keys):
            rank[:-1] = np.where(word[:-1] == word[1:], self._ranks(symbol[:-1], symbol[1:]), NEVER)
        while len(symbol):
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            stop = np.r_[begin[1:], len(word)]
            lowest = np.minimum.reduceat(rank, begin)
            done = lowest == NEVER
            if done.any():
                ids = symbol.astype("<u4").tobytes()
                for w, b, e in zip(word[begin[done]].tolist(), begin[done].tolist(), stop[done].tolist()):
                    found[w] = ids[4 * b : 4 * e]
                stays = np.repeat(~done, stop - begin)
                symbol, word, rank, lowest = symbol[stays], word[stays], rank[stays], np.repeat(lowest[~done], (stop - begin)[~done])
                if not len(symbol):
                    break
            else:
                lowest = np.repeat(lowest, stop - begin)
            at = np.flatnonzero(rank == lowest)
            # Pairs that overlap (a run of one symbol): every other one from the left.
            streak = np.r_[True, at[1:] != at[:-1] + 1]
            at = at[(at - at[np.flatnonzero(streak)[np.cumsum(streak) - 1]]) % 2 == 0]
            if not self.ordered:
                at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            symbol[at] = self.made[rank[at]]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            at -= np.arange(len(at))
            symbol, word, rank = symbol[stays], word[stays], rank[stays]
            touched = np.r_[at, at[at > 0] - 1]
            inner = touched[touched < len(symbol) - 1]
            inner = inner[word[inner] == word[inner + 1]]
            rank[touched] = NEVER
            rank[inner] = self._ranks(symbol[inner], symbol[inner + 1])
        return found

    def encode(self, texts: list[str], cut: Callable[[str], list[str]]) -> list[bytes]:
        """The ids of each text."""
        parts: list[list[str]] = []
        whole: dict[int, set[int]] = {}  # where a text's added tokens are
        for k, text in enumerate(texts):
            if self.split is None or not self.split.search(text):
                parts.append(cut(text))
                continue
            words, at = [], 0
            whole[k] = set()
            for hit in self.split.finditer(text):
                words += cut(text[at : hit.start()])
                whole[k].add(len(words))
                words.append(hit.group())
                at = hit.end()
            parts.append(words + cut(text[at:]))
        if self.held > self.known_bytes:
            self.known.clear()
            self.held = 0
        new = list(set().union(*parts) - self.known.keys())
        self.held += sum(map(len, new)) + 64 * len(new)
        self.known.update(zip(new, self.rounds([w.encode() for w in new])))
        ids = []
        for k, words in enumerate(parts):
            if k not in whole:
                ids.append(b"".join(map(self.known.__getitem__, words)))
            else:
                ids.append(b"".join(self.added[w].to_bytes(4, "little") if n in whole[k] else self.known[w] for n, w in enumerate(words)))
        return ids

    def decode(self, ids: list[bytes]) -> list[str]:
        """The text of each list of ids."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        lengths = self.lengths[flat]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = self.table[np.repeat(self.starts[flat] - (ends - lengths), lengths) + np.arange(total)].tobytes()
        stops = np.r_[0, ends][np.cumsum([0, *(len(x) // 4 for x in ids)])].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(stops, stops[1:])]


@lru_cache(1)
def _merges(path: str) -> Merges:
    """One for all tasks of a Python worker, with the words it knows."""
    return Merges(path)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """doc_id and ``ids``: the text's ids as little-endian unsigned 32-bit numbers. The vocabulary file must
    lie at ``path`` on every machine."""
    pattern, odd_from = _word_pattern(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(path)
        plain, exact = regex.compile(WORD).findall, regex.compile(pattern).findall
        for batch in batches:
            for part in byte_steps(batch, "text"):
                raw = [x or b"" for x in part.column("text").to_pylist()]
                young = any(np.frombuffer(x, np.uint8).max(initial=0) >= odd_from for x in raw)
                ids = merges.encode([x.decode("utf-8", "replace") for x in raw], exact if young else plain)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).cast("binary").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with their text back in ``decoded``; null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(path)
        for batch in batches:
            for part in byte_steps(batch, "ids"):
                texts = merges.decode([x or b"" for x in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document how many tokens it has, the digest of its ids, and that of the text they decode to."""
    both = decode(encode(docs, path), path)
    return both.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
