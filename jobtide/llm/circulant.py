"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct shingles. Two permutations of the 32-bit numbers make the whole signature: the
first scatters the shingles, the second is shifted round by one more place for every coordinate, and a coordinate is
the smallest value over the set. Bands of `rows` coordinates, drawn from all of them by a fixed rule, are the buckets:
with 48 bands of 6 out of 128, which share coordinates, two sets of similarity 0.8 miss each other about once in 15,000
pairs (simulated), and more similar ones far less often. Every candidate pair that the whole signature does not rule out (it agrees on fewer than 62 %
of the coordinates, five standard deviations below 0.8) is then confirmed on the full sets.

Documents with equal sets become one before banding. A bucket's members are first compared with its smallest member
only, so a group of thousands gives thousands of pairs and not their square. The links found make components; after
that only members of a bucket that are not yet in one component are compared with each other, which is what the first
step may have missed. A passage in many otherwise different documents, or an original with many copies that are unlike
one another, makes buckets with more than `together` members. All members of such a bucket that are in different
components are compared in blocks: signatures first, then the full sets of those that have a partner by signature. Only
links that join what the block has not joined yet leave it, fewer than it has rows, and each pair is looked at in the first bucket it shares. Nobody is left out of a bucket, so work
in blocks grows with the square of the open members. Components are all that is returned, so pairs within one need no look.

Bucket sizes and smallest members are partial aggregates; joins on hot buckets, hubs and copies are dealt out by
adaptive execution. Texts are read twice: once for the sets' signatures, once for the sets of candidates.

Defined cases: a text without words, empty or null, has an empty set and is linked with nothing; one with fewer words
than a shingle is one shingle of all of them; rows without doc_id have a null component and are kept; rows that share a
doc_id are one document. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import mix64, settle
from jobtide.llm.components import components


@dataclass(frozen=True)
class ShingleRules:
    """words in a shingle; similarity of at least share / 100; coordinates, and how bands are made of them."""

    words: int = 5
    share: int = 80
    coordinates: int = 128
    bands: int = 48
    rows: int = 6
    agree: float = 0.62
    together: int = 64
    block_rows: int = 512
    cached_words: int = 600_000


def mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


class Shingles:
    """Sets of shingle hashes; hashes of words are remembered up to a number of entries."""

    def __init__(self, rules: ShingleRules):
        self.rules, self.known = rules, {}

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        if len(known) > self.rules.cached_words:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], dtype=np.uint64)
        width = min(self.rules.words, len(h))
        shingle = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            shingle = mix64(shingle * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
        return np.unique(shingle)


def signature(shingles: np.ndarray, rules: ShingleRules) -> np.ndarray:
    """The smallest value of each shifted permutation over a set."""
    shifts = np.arange(rules.coordinates, dtype=np.uint32)[:, None]
    least = np.full(len(shifts), 0xFFFFFFFF, dtype=np.uint32)
    scattered = mix32((shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BF03635))
    for at in range(0, len(scattered), 512):
        np.minimum(least, mix32(scattered[None, at : at + 512] + shifts).min(axis=1), out=least)
    return least


def band_members(rules: ShingleRules) -> np.ndarray:
    """Which coordinates each band takes."""
    draw = np.random.default_rng(rules.bands * 1000 + rules.rows)
    return np.stack([draw.choice(rules.coordinates, rules.rows, replace=False) for _ in range(rules.bands)])


def band_keys(least: np.ndarray, members: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number included."""
    key = np.arange(len(members), dtype=np.uint64) + np.uint64(1)
    for column in least.astype(np.uint64)[members].T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def sketches(docs: DataFrame, rules: ShingleRules) -> DataFrame:
    """doc_id, n_shingles, hi, lo (digest of the set), bands, signature (a byte of each coordinate)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, members = Shingles(rules), band_members(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingles.of(t) for t in part.column(1).to_pylist()]
                least = [signature(s, rules) for s in sets]
                digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([(d >> 64) - (1 << 63) for d in digests], pa.int64()),
                        pa.array([(d & ((1 << 64) - 1)) - (1 << 63) for d in digests], pa.int64()),
                        pa.array([band_keys(x, members).view(np.int64) if len(s) else [] for s, x in zip(sets, least)], pa.list_(pa.int64())),
                        pa.array([x.astype(np.uint8).tobytes() for x in least], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "hi", "lo", "bands", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, n_shingles long, hi long, lo long, bands array<long>, signature binary")


def sets_of(docs: DataFrame, wanted: DataFrame, rules: ShingleRules) -> DataFrame:
    """doc_id, shingles of the documents named in `wanted` (doc_id)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles.of(t).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    return texts.mapInArrow(task, "doc_id long, shingles array<long>")


def plausible(pairs: DataFrame, alike: DataFrame, rules: ShingleRules) -> DataFrame:
    """The pairs (u, v) whose signatures agree well enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                close = (a == b).mean(axis=1) >= rules.agree
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(close))

    left = alike.select(F.col("doc_id").alias("u"), F.col("signature").alias("a"))
    right = alike.select(F.col("doc_id").alias("v"), F.col("signature").alias("b"))
    both = pairs.join(right.hint("merge"), "v").join(left.hint("merge"), "u").select("u", "v", "a", "b")
    return both.mapInArrow(task, "u long, v long")


def confirmed(pairs: DataFrame, sets: DataFrame, alike: DataFrame, rules: ShingleRules) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough; 100 |both| >= share |either|, in whole numbers."""
    likely = settle(plausible(pairs, alike, rules))
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    checked = likely.join(right.hint("merge"), "v").join(left.hint("merge"), "u")
    sized = checked.select("u", "v", both.alias("x"), (F.size("a") + F.size("b")).alias("y"))
    return settle(sized.where(100 * F.col("x") >= rules.share * (F.col("y") - F.col("x"))).select("u", "v").distinct())


def _size_allows(a: str, b: str, rules: ShingleRules):
    """Sets whose sizes differ too much cannot be similar enough."""
    return 100 * F.least(a, b) >= rules.share * F.greatest(a, b)


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (key, c, ...) of those keys whose rows are in several components, with the number of rows of the key."""
    keys = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("members"))
    return rows.join(keys.where("low <> high").select("key", "members"), "key")


def _within(rows: DataFrame, rules: ShingleRules) -> DataFrame:
    """Pairs of rows of one key that are in different components."""
    one, two = (rows.select("key", *[F.col(c).alias(f"{c}{k}") for c in ("id", "n", "c")]) for k in (1, 2))
    apart = (one["key"] == two["key"]) & (F.col("id1") < F.col("id2")) & (F.col("c1") != F.col("c2")) & _size_allows("n1", "n2", rules)
    return one.join(two, apart).select(F.col("id1").alias("u"), F.col("id2").alias("v"))


def _block_pairs(rows: pa.Table, group: np.ndarray, rules: ShingleRules) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs between two blocks of a bucket, in different groups, whose signatures agree and that share no earlier band.

    `group` is looked at anew for each strip, so that groups the caller has joined since bring no more pairs.
    """
    mine, low, high = (rows[c].to_numpy() for c in ("mine", "low", "high"))
    ids, n = (rows[c].to_numpy() for c in ("id", "n"))
    bands = np.array(rows["bands"].to_pylist(), dtype=np.int64)
    prints = np.frombuffer(b"".join(rows["signature"].to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
    here = int((bands[0] == rows["key"][0].as_py()).argmax())
    left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
    for start in range(0, len(left), 64):
        a = left[start : start + 64]
        apart = (group[a][:, None] != group[right][None]) & (100 * np.minimum(n[a][:, None], n[right]) >= rules.share * np.maximum(n[a][:, None], n[right]))
        if low[0] == high[0]:
            apart &= ids[a][:, None] < ids[right][None]
        i, j = np.nonzero(apart)
        i, j = a[i], right[j]
        for k in range(0, len(i), 65536):
            x, y = i[k : k + 65536], j[k : k + 65536]
            close = np.flatnonzero((prints[x] == prints[y]).mean(axis=1) >= rules.agree)
            x, y = x[close], y[close]
            first = (bands[x] == bands[y]).argmax(axis=1) == here
            yield x[first], y[first]


def _block_open(rules: ShingleRules):
    """The rows of two blocks of a bucket that have a partner by signature."""

    def task(rows: pa.Table) -> pa.Table:
        wanted = np.zeros(rows.num_rows, dtype=bool)
        for x, y in _block_pairs(rows, rows["c"].to_numpy(), rules):
            wanted[x] = wanted[y] = True
        return rows.filter(pa.array(wanted))

    return task


def _block_links(rules: ShingleRules):
    """Links between two blocks of a bucket that join groups not joined yet: fewer than there are rows.

    rows: id, n, c, bands, signature, shingles, and which block they are of. Pairs within a group need no look.
    """

    def task(rows: pa.Table) -> pa.Table:
        ids, group = rows["id"].to_numpy(), rows["c"].to_numpy().copy()
        held = rows["shingles"].combine_chunks()
        flat, ends = held.flatten().to_numpy(), np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
        us, vs = [], []
        for x, y in _block_pairs(rows, group, rules):
            for u, v in zip(x, y):
                if group[u] == group[v]:
                    continue
                a, b = flat[ends[u] : ends[u + 1]], flat[ends[v] : ends[v + 1]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= rules.share * (len(a) + len(b) - both):
                    us.append(ids[u])
                    vs.append(ids[v])
                    group[group == group[v]] = group[u]
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return task


def open_links(member: DataFrame, groups: DataFrame, alike: DataFrame, sets: DataFrame, rules: ShingleRules) -> DataFrame:
    """Links of documents that share a bucket and no component yet. member: key, members, id, n; groups: node, component_id."""
    group_of = groups.withColumnRenamed("node", "id")

    def open_(rows: DataFrame) -> DataFrame:
        return settle(_mixed(rows.join(group_of, "id", "left").select("key", "id", "n", F.coalesce("component_id", "id").alias("c"))))

    moderate = open_(member.where((F.col("members") > 2) & (F.col("members") <= rules.together)).select("key", "id", "n"))
    links = confirmed(_within(moderate, rules).distinct(), sets, alike, rules)
    large = open_(member.where(F.col("members") > rules.together).select("key", "id", "n"))
    blocks = F.ceil(F.col("members") / rules.block_rows).cast("int")
    looks = alike.select(F.col("doc_id").alias("id"), "bands", "signature")
    dealt = (
        large.join(looks.hint("merge"), "id")
        .withColumn("mine", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
        .drop("members", "other")
    )
    dealt = dealt.select("key", "low", "high", "mine", "id", "n", "c", "bands", "signature")
    wanted = settle(dealt.groupBy("key", "low", "high").applyInArrow(_block_open(rules), dealt.schema))
    whole = wanted.join(sets.select(F.col("doc_id").alias("id"), "shingles").hint("merge"), "id")
    return links.unionByName(settle(whole.groupBy("key", "low", "high").applyInArrow(_block_links(rules), "u long, v long").distinct()))


def near_duplicates(docs: DataFrame, rules: ShingleRules = ShingleRules()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept of every row of `docs`."""
    sketched = settle(sketches(docs, rules))
    known = sketched.where("doc_id is not null and n_shingles > 0")
    # Equal sets are one: the smallest doc_id stands for them, with the bands that all of them share.
    alike = settle(known.groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "signature")).alias("rep")).select("hi", "lo", "rep.*"))
    filed = alike.select(F.explode("bands").alias("key"), F.struct(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")).alias("m"))
    hubs = filed.groupBy("key").agg(F.min("m").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    member = settle(filed.join(hubs, "key").where("m.id <> hub.id").select("key", "members", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("m.id").alias("id"), F.col("m.n").alias("n")))
    wanted = member.select(F.col("hub").alias("doc_id")).unionByName(member.select(F.col("id").alias("doc_id"))).distinct()
    sets = settle(sets_of(docs, wanted, rules))
    star = member.where(_size_allows("hub_n", "n", rules)).select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct()
    links = confirmed(star, sets, alike, rules)
    # What the hubs left open: members of one bucket, other than its hub, that are in different components.
    more = open_links(member.select("key", "members", "id", "n"), components(links), alike, sets, rules)
    groups = components(links.unionByName(more))
    # Documents that share an id but not a text are one document as well: components go by doc_id.
    verdicts = alike.select("hi", "lo", F.col("doc_id").alias("rep")).join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    verdicts = verdicts.select(F.col("hi").alias("h"), F.col("lo").alias("l"), F.coalesce("component_id", "rep").alias("component"))
    judged = sketched.join(verdicts, (F.col("hi") == F.col("h")) & (F.col("lo") == F.col("l")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return judged.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
