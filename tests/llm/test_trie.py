"""The prefix trie against one built turn by turn, and its slot table."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from engrama.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows, group=5, most=9):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, role or "", text or ""))
    talks = {c: [t[2:] for t in sorted(ts)] for c, ts in talks.items()}
    members = defaultdict(list)
    built = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(talks.get(c - c % group, [])[:h] + own[h:])
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1].encode()) if node else 0
    return {
        (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(who) if len(built[c]) == len(node)).encode()).hexdigest())
        for node, who in members.items()
    }


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_rows(seed, convs=120, most=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 2), convs):
        for turn in range(rng.randint(1, most)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["", "a", "b", "ab"])))
    return rows


@pytest.mark.parametrize("span", [1, 3, 4096])
def test_random_conversations(spark, span):
    rows = random_rows(span)
    got = result(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5), span=span))
    assert got == brute(rows)


def test_odd_conversations(spark):
    rows = [
        (None, 0, "user", "no conversation"), (None, None, None, None), (5, None, "user", "x"), (5, 0, None, None), (5, 0, None, None),
        (6, 1, "a", "b"), (6, 1, "a", "a"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (8, 3, "é", "long " * 40_000), (11, 0, "u", "only own"),
        (-3, 0, "u", "below zero"), (20, 0, "ab", "c"), (25, 0, "a", "bc"),
    ]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 160) for t in range(3)]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("i", "depth", "n1", "_segment", "length")})
    assert result(trie.prefix_trie(turns, span=2)) == brute(rows)
    assert result(trie.prefix_trie(turns.limit(0))) == set()
    assert result(trie.prefix_trie(turns.where("conv_id IS NULL"))) == set()


def test_one_long_conversation(spark):
    rows = [(10, t, "user", str(t % 3)) for t in range(700)] + [(11, t, "user", str(t % 3)) for t in range(400)]
    assert result(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(7), span=64)) == brute(rows)


def test_slots_are_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50_000):
        high, low = rng.integers(0, 2**64, n, np.uint64), rng.integers(0, 2**64, n, np.uint64)
        table = trie.SlotTable(high, low)
        assert sorted(table.slots(high, low)) == list(range(n))
    with pytest.raises(ValueError):
        table.slots(high[:3] + np.uint64(1), low[:3])


def test_a_shared_digest_raises(spark):
    row = "1L AS conv_id, 1L AS depth, 1L AS length, 7L AS k1, 7L AS k2, 5L AS bytes, 9L AS n1, 9L AS n2, 0L AS p1, 0L AS p2"
    paths = spark.sql(f"SELECT {row} UNION ALL SELECT {row.replace('7L AS k1', '8L AS k1')}")
    with pytest.raises(Exception, match="share a digest"):
        trie._nodes(paths)
