"""The trie of conversations that share their first turns, with sums over every subtree by centroid decomposition.

A node is a distinct sequence of first turns. Its smallest conversation and its depth name it: a conversation that is the smallest
of a node is the smallest of every longer prefix of its own. Prefixes are told apart by 128 bits: the exclusive or of a
hash of each turn and its place, so that prefixes of a conversation of any length are formed in blocks and put together.

What a node itself holds (members, characters of its last turn) is one aggregate over prefixes. Sums over subtrees take the forest
of parent edges apart. The centroid of a component is its deepest node whose subtree holds more than half of the component's rows
(prefixes of conversations); without it, every part has at most half. Its subtree's total is what the component's totals
below it and its own values add up to, and is added to every node on the path from the centroid to the component's top. The
parts, those below the centroid and the rest with what went off subtracted along the path, are taken apart in turn. Ancestors
need no walk: they are the nodes of the centroid's own conversation at smaller depths, and a node lies below the centroid
if its conversation passes through it. So a round is a few joins for all components together, however deep the trie, and the
number of rounds grows with the logarithm of the rows. Components of at most `task_rows` rows are finished the same way inside tasks.

Defined cases: rows without conv_id are left out; turns without a number come first, turns of one number in the order of a digest of
role and text; repeated rows are repeated turns; null role or text is empty. A conversation that borrows from one that does not exist
begins with its own turns. Conversation numbers below zero borrow from c - c % 100 towards zero. An empty table gives no rows.
The ids that end in a node are read by its digest in order, in strings of at most 256 ids; nothing holds them all at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import documents_only, settle
from jobtide.operators.ranking import By, number_rows

Borrow = Callable[[Column], tuple[Column, Column]]


@dataclass(frozen=True)
class TrieRules:
    """Components of more than task_rows rows are split by joins; block is the number of turns hashed together."""

    task_rows: int = 50_000
    hot_rows: int = 1_000_000
    block: int = 1024


def borrowed_turns(conv_id: Column) -> tuple[Column, Column]:
    """From which conversation, and how many turns at most, a conversation's beginning is taken."""
    return conv_id - conv_id % 100, F.crc32(conv_id.cast("string").cast("binary")) % 6


MOST_BORROWED = 5


def _turns(conversations: DataFrame, rules: TrieRules) -> DataFrame:
    """conv_id, k (place, from 0), a, b (digest of role and text), chars (of the text)."""
    plain = documents_only(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    turns = plain.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", number(1).alias("a"), number(17).alias("b"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("at"),
    )
    # Equal turns may stand in either order; the row's number only lets them be numbered in several tasks.
    order = [By(F.col("turn")), By(F.col("a")), By(F.col("b")), By(F.col("at"))]
    numbered = number_rows(turns, ["conv_id"], order, "n", rules.hot_rows)
    return settle(numbered.select("conv_id", (F.col("n") - 1).alias("k"), "a", "b", "chars"))


def _rebuilt(turns: DataFrame, borrow: Borrow) -> tuple[DataFrame, DataFrame]:
    """conv_id, length of each rebuilt conversation; and conv_id, at (from 0), a, b, chars, length of its turns."""
    counted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    origin, most = borrow(F.col("conv_id"))
    counted = settle(counted.withColumns({"origin": origin, "most": most}))
    theirs = counted.select(F.col("conv_id").alias("their_id"), F.col("n").alias("their_n"))
    taken = F.least("most", F.coalesce("their_n", F.lit(0))).cast("long")
    convs = counted.join(theirs, F.col("origin") == F.col("their_id"), "left").withColumn("taken", taken)
    convs = settle(convs.select("conv_id", "origin", "most", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("most"), F.lit(0))).alias("length")))
    own = turns.join(convs, "conv_id").where("k >= most").select("conv_id", (F.col("taken") + F.col("k") - F.col("most")).alias("at"), "a", "b", "chars", "length")
    first = turns.where(F.col("k") < MOST_BORROWED).select(F.col("conv_id").alias("their_id"), "k", "a", "b", "chars")
    lent = convs.where("taken > 0").join(first, (F.col("origin") == F.col("their_id")) & (F.col("k") < F.col("taken")))
    return convs.select("conv_id", "length"), own.unionByName(lent.select("conv_id", F.col("k").alias("at"), "a", "b", "chars", "length"))


def _prefixes(rebuilt: DataFrame, rules: TrieRules) -> DataFrame:
    """conv_id, depth, x, y (what tells the prefix of that depth from others), chars, length."""
    hashed = rebuilt.select(
        "conv_id", "at", F.floor(F.col("at") / rules.block).cast("long").alias("block"), "chars", "length",
        F.xxhash64("at", "a", "b").alias("x"), F.xxhash64("b", "at", "a", F.lit(1)).alias("y"),
    )
    hashed = settle(hashed)
    blocks = hashed.where(F.col("length") > rules.block).groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(
        blocks.select(
            F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"),
            F.coalesce(F.bit_xor("x").over(earlier), F.lit(0)).alias("x0"), F.coalesce(F.bit_xor("y").over(earlier), F.lit(0)).alias("y0"),
        )
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.withColumns({"x": F.bit_xor("x").over(inside), "y": F.bit_xor("y").over(inside)})
    running = running.join(before, (F.col("conv_id") == F.col("of_conv")) & (F.col("block") == F.col("of_block")), "left")
    whole = lambda c: F.col(c).bitwiseXOR(F.coalesce(F.col(f"{c}0"), F.lit(0))).alias(c)
    return settle(running.select("conv_id", (F.col("at") + 1).alias("depth"), whole("x"), whole("y"), "chars", "length"))


@dataclass(frozen=True)
class Trie:
    """nodes: conv_id, depth, parent_conv_id, n_convs, n_children, weight, leaves, saved (the node's own share of both sums).
    paths: conv_id, depth, owner, parent_owner, block of the conversations that own nodes: which node each of their prefixes is.
    ends: owner, depth, conv_id of every conversation's whole sequence."""

    nodes: DataFrame
    paths: DataFrame
    ends: DataFrame


def build(conversations: DataFrame, rules: TrieRules = TrieRules(), borrow: Borrow = borrowed_turns) -> Trie | None:
    """The trie; None without conversations."""
    convs, rebuilt = _rebuilt(_turns(conversations, rules), borrow)
    root_id, n_convs, weight = convs.agg(F.min("conv_id"), F.count(F.lit(1)), F.sum(F.col("length") + 1)).first()
    if root_id is None:
        return None
    prefixes = _prefixes(rebuilt, rules)
    found = settle(
        prefixes.groupBy("depth", "x", "y").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        )
    )
    owned = prefixes.join(found.select("depth", "x", "y", F.col("conv_id").alias("owner")), ["depth", "x", "y"])
    owned = settle(owned.select("conv_id", "depth", "owner", "length"))

    owners = owned.where("owner = conv_id and depth = length").select("conv_id")
    paths = owned.join(owners, "conv_id", "left_semi").select("conv_id", "depth", "owner")
    tops = owners.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root_id).cast("long").alias("owner"))
    paths = settle(paths.unionByName(tops))
    above = paths.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("parent_owner"))
    paths = settle(paths.join(above, ["conv_id", "depth"], "left").withColumn("block", F.floor(F.col("depth") / rules.block).cast("long")))

    edges = paths.where("owner = conv_id and depth > 0").select("conv_id", "depth", F.col("parent_owner").alias("parent_conv_id"))
    children = edges.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    root = convs.sparkSession.range(1).select(
        F.lit(root_id).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(n_convs).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("chars"), F.lit(weight).cast("long").alias("weight"), F.lit(None).cast("long").alias("parent_conv_id"),
    )
    nodes = found.drop("x", "y").join(edges, ["conv_id", "depth"]).unionByName(root).join(children, ["conv_id", "depth"], "left")
    nodes = nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "weight",
        F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    turnless = convs.where("length = 0").select(F.lit(root_id).cast("long").alias("owner"), F.lit(0).cast("long").alias("depth"), "conv_id")
    ends = owned.where("depth = length").select("owner", "depth", "conv_id").unionByName(turnless)
    return Trie(settle(nodes), paths, ends)


# -- sums over subtrees


def decompose(parent: list[int], depth: list[int], weight: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Sums over subtrees of a component's nodes; parent is -1 outside the component, weight the rows in a node's subtree."""
    sums = [[0, 0] for _ in parent]
    weight = list(weight)
    waiting = [sorted(range(len(parent)), key=depth.__getitem__)]
    while waiting:
        members = waiting.pop()
        top = centre = members[0]
        for v in members:
            if 2 * weight[v] > weight[top]:
                centre = v
        side = {centre: centre}
        below: dict[int, list[int]] = {}
        rest = []
        total = list(values[centre])
        for v in members:
            if v == centre:
                continue
            via = side.get(parent[v])
            if via is None:
                rest.append(v)
                continue
            side[v] = v if via == centre else via
            below.setdefault(side[v], []).append(v)
            total[0] += values[v][0]
            total[1] += values[v][1]
        gone, at = weight[centre], centre
        sums[at][0] += total[0]
        sums[at][1] += total[1]
        while at != top:
            at = parent[at]
            sums[at][0] += total[0]
            sums[at][1] += total[1]
            weight[at] -= gone
        waiting.extend(below.values())
        if rest:
            waiting.append(rest)
    return sums


SUMS = "conv_id long, depth long, leaves long, saved long"


def _in_tasks(small: DataFrame) -> DataFrame:
    """Sums of components that fit a task, a component at a time."""

    def solved(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        at = {(r[2], r[3]): i for i, r in enumerate(rows)}
        parent = [at.get((r[4], r[3] - 1), -1) for r in rows]
        sums = decompose(parent, [r[3] for r in rows], [r[5] for r in rows], [(r[6], r[7]) for r in rows])
        for r, s in zip(rows, sums):
            yield r[2], r[3], s[0], s[1]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)], names=["conv_id", "depth", "leaves", "saved"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns]))
        held: list[tuple] = []
        for _, component in groupby(rows, key=lambda r: (r[0], r[1])):
            held.extend(solved(list(component)))
            if len(held) >= 10_000:
                yield table(held)
                held = []
        yield table(held)

    columns = ["top_conv", "top_depth", "conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved"]
    dealt = small.select(columns).repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth")
    return dealt.mapInArrow(task, SUMS)


def _split(work: DataFrame, paths: DataFrame, rules: TrieRules) -> tuple[DataFrame, DataFrame]:
    """One round for components too large for a task: what it adds to nodes, and the components that are left."""
    heavy = work.where(2 * F.col("weight") > F.col("total")).groupBy("top_conv", "top_depth")
    # The subtrees that hold more than half lie on one path, and shrink with depth.
    centres = settle(heavy.agg(F.min_by(F.struct("conv_id", "depth", "weight"), "weight").alias("c")).select("top_conv", "top_depth", F.col("c.conv_id").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")))
    child = paths.select(F.col("conv_id").alias("via_conv"), F.col("depth").alias("via_depth"), F.col("owner").alias("child_conv"), F.col("parent_owner"))
    deeper = F.col("depth") > F.col("c_depth")
    placed = work.drop("total").join(centres, ["top_conv", "top_depth"]).join(
        child, deeper & (F.col("conv_id") == F.col("via_conv")) & (F.col("c_depth") + 1 == F.col("via_depth")), "left"
    )
    placed = settle(
        placed.withColumns({
            "is_centre": (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth")),
            "below": F.coalesce(F.col("parent_owner") == F.col("c_conv"), F.lit(False)),
        }).drop("via_conv", "via_depth", "parent_owner")
    )
    totals = placed.where("is_centre or below").groupBy("top_conv", "top_depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    centres = settle(centres.join(totals, ["top_conv", "top_depth"]))

    long_way = centres.where("c_depth > top_depth").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("top_depth") / rules.block).cast("long"), F.floor((F.col("c_depth") - 1) / rules.block).cast("long")))
    )
    steps = paths.select(F.col("conv_id").alias("c_conv"), "block", F.col("owner").alias("conv_id"), "depth")
    added = long_way.join(steps, ["c_conv", "block"]).where("depth >= top_depth and depth < c_depth")
    added = settle(added.select("conv_id", "depth", "leaves", "saved", "c_weight"))
    done = centres.select(F.col("c_conv").alias("conv_id"), F.col("c_depth").alias("depth"), "leaves", "saved")

    columns = ["top_conv", "top_depth", "conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved"]
    under = placed.where("below").withColumns({"top_conv": F.col("child_conv"), "top_depth": F.col("c_depth") + 1})
    rest = placed.where("not below and not is_centre").join(added.select("conv_id", "depth", F.col("c_weight").alias("gone")), ["conv_id", "depth"], "left")
    rest = rest.withColumn("weight", F.col("weight") - F.coalesce("gone", F.lit(0)))
    return done.unionByName(added.drop("c_weight")), settle(under.select(columns).unionByName(rest.select(columns)))


def subtree_sums(trie: Trie, rules: TrieRules = TrieRules()) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens of every node."""
    top = trie.nodes.where("depth = 0").select("conv_id").first()[0]
    # Written, so that the joins below meet columns and not constants.
    now = settle(
        trie.nodes.select(
            F.lit(top).cast("long").alias("top_conv"), F.lit(0).cast("long").alias("top_depth"), "conv_id", "depth", "parent_conv_id", "weight", "leaves", "saved"
        )
    )
    parts: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        # A component's top holds the whole of it.
        sizes = now.groupBy("top_conv", "top_depth").agg(F.max("weight").alias("total"))
        large = settle(sizes.where(F.col("total") > rules.task_rows))
        if large.isEmpty():
            small.append(now)
            break
        small.append(now.join(large, ["top_conv", "top_depth"], "left_anti"))
        added, now = _split(settle(now.join(large, ["top_conv", "top_depth"])), trie.paths, rules)
        parts.append(added)
    whole = small[0]
    for more in small[1:]:
        whole = whole.unionByName(more)
    found = _in_tasks(whole)
    for more in parts:
        found = found.unionByName(more.select("conv_id", "depth", "leaves", "saved"))
    return found.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def end_digests(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of every node that a conversation ends in: its ids, ascending, joined by commas."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    strings = ends.groupBy("owner", "depth", F.shiftright("conv_id", 8).alias("block")).agg(F.array_join(ids, ",").alias("ids"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns]))
        for node, own in groupby(rows, key=lambda r: (r[0], r[1])):
            digest = hashlib.sha256()
            for i, r in enumerate(own):
                digest.update(("," if i else "").encode() + r[3].encode())
            held.append((*node, digest.hexdigest()))
            if len(held) >= 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema=kind)
                held = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema=kind)

    names = ["conv_id", "depth", "ends_sha256"]
    kind = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    dealt = strings.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "block")
    return dealt.mapInArrow(task, "conv_id long, depth long, ends_sha256 string")


def trie_nodes(conversations: DataFrame, rules: TrieRules = TrieRules(), borrow: Borrow = borrowed_turns) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    trie = build(conversations, rules, borrow)
    if trie is None:
        return conversations.sparkSession.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
        )
    key = ["conv_id", "depth"]
    rows = trie.nodes.join(subtree_sums(trie, rules), key).join(end_digests(trie.ends), key, "left")
    none = hashlib.sha256(b"").hexdigest()
    return rows.select(*key, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
