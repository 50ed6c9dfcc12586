"""The trie of conversations against brute force, with components split by joins and inside tasks."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobtide.llm import prefix_trie, queries
from jobtide.session import local_frame

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn int, role string, text string"


def rebuilt_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    return out


def trie_by_hand(rows):
    rebuilt = rebuilt_by_hand(rows)
    members = defaultdict(list)
    for c, ts in sorted(rebuilt.items()):
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not children[node]
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(frame, **rules):
    return sorted(map(tuple, prefix_trie.trie_nodes(frame, prefix_trie.TrieRules(**rules)).collect()), key=repr)


def test_trie_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_prefix_trie(spark, SF)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand(rows)


def branching(n, seed):
    """Conversations of few different turns, a third of them alike, and one much longer than the rest."""
    random_ = random.Random(seed)
    rows = []
    for c in range(n):
        alike = random.Random(1) if c % 3 == 0 else random_
        rows += [(c, t, alike.choice(["user", "assistant"]), alike.choice(["a", "bé", "ccc"])) for t in range(alike.randint(1, 9))]
    return rows + [(n + 7, t, "user", "ab"[t % 2]) for t in range(60)]


@pytest.mark.parametrize("rules", [{"task_rows": 40, "block": 4, "hot_rows": 200}, {}])
def test_components_split_by_joins_and_in_tasks(spark, rules):
    rows = branching(250, 5)
    assert nodes_of(local_frame(spark, rows, TURNS).repartition(5), **rules) == trie_by_hand(rows)


AWKWARD = [
    (100, 0, None, None), (100, 1, "", ""), (101, None, "user", "first"), (101, 3, "user", "x" * 70_000), (101, 2, "user", "é😀"),
    (102, 0, "user", "same"), (102, 0, "user", "same"), (102, 0, "user", "same"), (None, 0, "user", "lost"), (205, 0, "a", "bc"), (206, 0, "ab", "c"),
    (99999999999, 0, "user", "far"), (99999999900, 0, "user", "far"), (300, 5, "user", "one"), *[(c, 0, "user", "one") for c in range(301, 340)],
]


def test_awkward_conversations(spark):
    frame = local_frame(spark, AWKWARD, TURNS)
    for name in ("at", "depth", "owner", "weight", "n", "k", "block", "x", "leaves"):
        frame = frame.withColumn(name, F.lit("z"))
    assert nodes_of(frame) == trie_by_hand(AWKWARD)
    assert nodes_of(frame, task_rows=3, block=2, hot_rows=4) == trie_by_hand(AWKWARD)
    assert nodes_of(frame.limit(0)) == [] and nodes_of(frame.where("conv_id is null")) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    short = next(c for c in range(200, 300) if c % 100 and zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(short, 0, "user", "dropped"), (short + 1000, 0, "user", "x"), (short + 1000, 1, "user", "y")]
    assert nodes_of(local_frame(spark, rows, TURNS)) == trie_by_hand(rows)


def test_sums_of_a_long_chain():
    n = 3000
    sums = prefix_trie.decompose(list(range(-1, n - 1)), list(range(n)), [n - i for i in range(n)], [(int(i == n - 1), i) for i in range(n)])
    assert [s[0] for s in sums] == [1] * n
    assert [s[1] for s in sums] == [sum(range(i, n)) for i in range(n)]
