"""Byte-level BPE in merge rounds against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wavelane.llm import bpe_rounds
from wavelane.llm.common import byte_steps, read
from wavelane.llm.queries import QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.01"
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, doc_id, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_query_equals_the_library_on_the_whole_table(spark, tokenizer):
    docs = read(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    found = QUERIES["op11_bpe"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == sorted(expected(tokenizer, r.doc_id, r.text) for r in docs)


def odd_texts():
    rng = random.Random(11)
    letters = [chr(c) for c in [*range(0x300), *range(0x540, 0x600), *range(0x2000, 0x2100), 0x3D001, 0x323B1, 0x1E6C0, 0x1F600]]
    letters += ["'s", "'LL", "  ", "\n", "<|endoftext|>", "e", " the"] * 20
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    return [None, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "aaa", "a" * 5000, "ab" * 999, "x y " * 30_000, "q" + "zx" * 20_000, *texts, texts[0], texts[0]]


def test_odd_texts_equal_the_library(spark, tokenizer):
    texts = odd_texts()
    rows = [(k, t, b"x", 1) for k, t in enumerate(texts)] + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, decoded int")
    found = bpe_rounds.digests(docs, PATH).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(tokenizer, r[0], r[1])) for r in rows)
    assert bpe_rounds.digests(docs.limit(0), PATH).count() == 0


def test_round_trip_and_small_steps(spark):
    texts = [t or "" for t in odd_texts()]
    merges = bpe_rounds.Merges(PATH, known_bytes=100)  # forgets its words between steps
    pattern, _ = bpe_rounds._word_pattern(PATH)
    cut = bpe_rounds.regex.compile(pattern).findall
    at_once = merges.encode(texts, cut)
    assert merges.decode(at_once) == texts
    assert [merges.encode([t], cut)[0] for t in texts] == at_once
    assert merges.ordered
    merges.ordered = False  # one pair of a word in each round gives the same
    merges.known.clear()
    assert merges.encode(texts[10:], cut) == at_once[10:]
    assert merges.decode([b"", np.array([220 + 11], "<u4").tobytes()])[0] == ""


def test_each_code_point_is_cut_like_the_library(tokenizer):
    merges = bpe_rounds.Merges(PATH)
    pattern, _ = bpe_rounds._word_pattern(PATH)
    cut = bpe_rounds.regex.compile(pattern).findall
    points = [chr(c) for c in range(0, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}{c}! {c}" for c in points]
    found = [np.frombuffer(x, "<u4").tolist() for x in merges.encode(texts, cut)]
    assert found == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_batches_are_taken_in_steps_of_bytes():
    batch = bpe_rounds.pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": [b"abc", None, b"defg", b"h" * 50]})
    assert [s.num_rows for s in byte_steps(batch, "text", 5)] == [2, 1, 1]
    assert [s.num_rows for s in byte_steps(batch.slice(0, 0), "text", 5)] == [0]
