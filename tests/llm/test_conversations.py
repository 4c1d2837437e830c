"""Conversation repair against a plain search over all edits, turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from wavelane.llm import conversations
from wavelane.llm.edit_lattice import ENDS, NONE, block_ways, join_ways, least_edits

ROW = "conv_id long, turn long, role string, text string, key int, dropped string, audit long"


def plain_best(rows):
    """Cost, letters and turns of the cheapest repair: all ways, of which each state keeps its least one."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserted(ways):
        found = dict(ways)
        for _ in range(3):
            for end, (cost, letters, out) in list(found.items()):
                new = after[end]
                way = (cost + 5, letters + "I", [*out, ("user" if new == "u" else "assistant", "")])
                if new not in found or way < found[new]:
                    found[new] = way
        return found

    ways = {"": (0, "", [])}
    for role, text, wrong in rows:
        found = {}

        def offer(end, way):
            if end not in found or way < found[end]:
                found[end] = way

        for end, (cost, letters, out) in with_inserted(ways).items():
            offer(end, (cost + 2, letters + "D", out))
            if wrong in ("blank", "duplicate"):
                continue
            more = 5 if wrong == "truncated" else 0
            new = after[end]
            offer(new, (cost + 1 + more, letters + "R", [*out, ("user" if new == "u" else "assistant", text)]))
            if role[:1] == new or role[:1] == "s" and end == "":
                offer(role[:1], (cost + more, letters + "K", [*out, (role, text)]))
        ways = found
    return min((w for end, w in with_inserted(ways).items() if end in ("", "a")), key=lambda w: w[:2])


def expected(conv_id, rows, hurt=True):
    name = " " if conv_id is None else str(conv_id)
    after = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 99
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        after += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, judged = set(), []
    for _, role, text in after:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        wrong = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, wrong))
    cost, audit, out = plain_best(judged)
    numbers = [t for t, _, _ in after if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    odd = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    faults = [sum(w == kind for _, _, w in judged) for kind in ("blank", "duplicate", "truncated")]
    return (conv_id, gaps, *faults, odd, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def wild_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u", None]
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?  ", None, "é.", "a.b"]
    turns = [None if rng.random() < 0.1 else rng.randrange(-2, n + 2) for _ in range(n)]
    return [(t, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Turn {rng.randrange(3 * n)}.") for t in turns]


@pytest.mark.parametrize("hurt", [True, False])
def test_wild_conversations_equal_plain_search(spark, hurt):
    rng = random.Random(13)
    talks = {k: wild_rows(rng, rng.randrange(1, 9)) for k in range(150)}
    talks[None] = wild_rows(rng, 6)
    talks[-5] = wild_rows(rng, 1700)  # several blocks
    talks[1000] = [(k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(2000)]
    talks[1001] = [(None, "user", "Again.")] * 1300  # one turn, over a block
    talks[1002] = [(3, "system", "x" * 2_000_000 + "."), (3, "user", "x" * 2_000_000)]
    rows = [(k, *r, 1, "d", 2) for k, talk in talks.items() for r in talk]
    rng.shuffle(rows)
    turns = conversations.turns(spark.createDataFrame(rows, ROW).repartition(5))
    found = conversations.repair(conversations.damaged(turns) if hurt else turns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(k, talk, hurt)) for k, talk in talks.items())


def test_empty_table_and_dropped_conversations(spark):
    none = spark.createDataFrame([], ROW)
    assert conversations.repair(conversations.damaged(conversations.turns(none))).count() == 0
    gone = next(k for k in range(10_000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.", 1, "", 1)], ROW)
    found = conversations.repair(conversations.damaged(conversations.turns(one))).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_are_in_order(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Still there."), (2, 0, "user", "")]
    turns = conversations.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    plans = conversations.plan_repairs(turns)
    assert sorted((r.key, r.cost, r.audit) for r in plans.collect()) == [("1", 1, "KRK"), ("2", 2, "D")]
    found = [tuple(r) for r in conversations.repaired_turns(turns, plans).collect()]
    assert [r for r in found if r[0] == "1"] == [("1", 0, "system", "Be kind.", "K"), ("1", 1, "user", "Hello.", "R"), ("1", 2, "assistant", "Still there.", "K")]
    assert [r for r in found if r[0] == "2"] == [("2", None, None, None, None)]


def test_search_equals_plain_search_and_blocks_join():
    rng = random.Random(7)
    wrong = {"x": "blank"}
    for _ in range(600):
        codes = "".join(rng.choice("suauaxoSUAO") for _ in range(rng.randrange(12)))
        rows = [({"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}[c.lower()], "t", wrong.get(c, "truncated" if c.isupper() else "")) for c in codes]
        whole = least_edits(codes, NONE, ENDS)
        assert whole == plain_best(rows)[:2], codes
        cut = rng.randrange(len(codes) + 1)
        ways = join_ways({NONE: (0, "")}, block_ways(codes[:cut], True, False))
        assert min(join_ways(ways, block_ways(codes[cut:], False, True)).values()) == whole
