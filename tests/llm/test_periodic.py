"""Runs of words by recompression against plain definitions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wavelane.llm import periodic
from wavelane.llm.common import read
from wavelane.llm.queries import QUERIES
from wavelane.llm.recompression import Grammar

SF_DIR = "/root/testdata/sf0.01"


def plain_runs(words):
    """Every period on its own: stretches in which words that far apart are equal, as long as they get."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def expected(doc_id, text, loops=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if loops and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def test_query_equals_plain_runs_on_the_whole_table(spark):
    docs = read(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    found = sorted(map(tuple, QUERIES["op12_periodic"](spark, SF_DIR).collect()))
    assert found == sorted(expected(r.doc_id, r.text) for r in docs)
    assert sum(r[1] for r in found) > 50


def loopy(rng):
    words = []
    while len(words) < rng.randrange(1, 120):
        piece = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        words += piece * rng.randrange(1, 8) + [rng.choice("abc") for _ in range(rng.randrange(3))]
    return words


def test_odd_texts(spark):
    rng = random.Random(12)
    texts = [None, "", " \n\t\x0b", "a", "a a a a a", "a a a a a a", "é é é é é é é", "a b " * 3, "a b " * 4, "a b " * 9, "x " * 30_000]
    texts += [" ".join(loopy(rng)) for _ in range(300)] + ["a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb", " ".join(map(str, range(40_000)))]
    texts += [" ".join([*(str(k) for k in range(700))] * 5)]
    rows = [(k, t, "c", 1) for k, t in enumerate(texts)] + [(None, "a " * 9, None, None), (7, texts[7], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int")
    found = sorted(map(str, map(tuple, periodic.digests(periodic.find_runs(docs)).collect())))
    short = [r for r in rows if len(r[1] or "") < 20_000]
    assert set(found) >= {str(expected(r[0], r[1], loops=False)) for r in short}
    assert len(found) == len(rows)
    long = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.find_runs(docs).collect() if r.doc_id is not None}
    assert long[10] == [(0, 30_000, 1)]
    assert long[312] == [] and long[313] == [(0, 3500, 700)]
    assert periodic.digests(periodic.find_runs(docs.limit(0), periodic.looped)).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_extensions_equal_comparison(letters):
    rng = random.Random(letters)
    texts = [[rng.randrange(letters) for _ in range(rng.randrange(400))] for _ in range(6)]
    texts.append(texts[0] + texts[1][:50] + texts[0])
    symbols = []
    for k, t in enumerate(texts):
        symbols += [-1 - k, *t]
    symbols.append(-1 - len(texts))
    grammar = Grammar(np.array(symbols))
    assert len(grammar.starts) > 2 or letters == 1
    inner = [k for k, s in enumerate(symbols) if s >= 0]
    pairs = [sorted(rng.sample(inner, 2)) for _ in range(3000)]
    x, y = np.array(pairs).T
    for step in (1, -1):
        for (a, b), got in zip(pairs, grammar.extension(x, y, step).tolist()):
            n = 0
            while symbols[a + step * n] == symbols[b + step * n]:
                n += 1
            assert got == n


def test_other_limits_and_many_small_strings():
    rng = random.Random(3)
    texts = [[w.encode() for w in loopy(rng)] for _ in range(200)]
    for (runs, kept), words in zip(periodic.runs_of_texts(texts), texts):
        assert list(map(tuple, runs.tolist())) == plain_runs(words)
        dropped = {i for s, m, q in plain_runs(words) for i in range(s + q, s + m)}
        assert kept.tolist() == [i not in dropped for i in range(len(words))]
    alone = [periodic.runs_of_texts([t])[0][0].tolist() for t in texts]
    assert alone == [r.tolist() for r, _ in periodic.runs_of_texts(texts)]
    assert periodic.runs_of_texts([]) == []
    three = periodic.runs_of_texts([b"a b a b a b c".split()], repeats=3, least=6)[0][0].tolist()
    assert three == [[0, 6, 2]]
