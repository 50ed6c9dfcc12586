"""Reversible line deduplication: sharded cuckoo filters in front of exact reference counts.

A line's key is the line without white space at its ends, A-Z lower-cased; keys shorter than `min_chars` code
points are never dropped. The store holds, per key, which documents refer to it (the exact table) and, per
shard of keys, a cuckoo filter of the keys it holds. Inserting a batch asks the filters first: a key that its
filter does not know is new for certain and needs no look into the table, only keys that may be known are
joined with it. A whole table goes in as several batches, so that its own later batches ask as well. Deleting
documents takes their references out; keys that nobody refers to any more leave the filter. What a document loses follows from the references alone, so inserting a batch and deleting it again
leaves every verdict as it was.

All counting is grouped with partial sums, so a line that a third of all documents hold is a single row per task
before any shuffle. Shards are sized by the number of keys; one shard's filter is built in one task.

Defined cases: a null or empty text is one empty line; rows that share a doc_id are one document, and each of
them loses the keys that document loses; a null doc_id refers to nothing and loses nothing; an empty table gives
no rows. When a document holds a key several times and is the smallest holder, all its lines stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.common import batches_of, each_row, settle, unused

WHITE = b" \t\n\x0b\x0c\r"
SLOTS = 4


@dataclass(frozen=True)
class LineRules:
    """min_chars code points at least; a key in min_docs documents is repeated; keys per shard; kicks per insertion.

    A table of documents is inserted in `batches` parts by a hash of doc_id; each part after the first asks the filters of those before it.
    """

    min_chars: int = 10
    min_docs: int = 2
    shard_keys: int = 200_000
    kicks: int = 500
    batches: int = 2


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def n_chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def key_digest(key: bytes) -> tuple[int, int]:
    """128 bits as two signed numbers."""
    d = xxhash.xxh3_128_intdigest(key)
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each in one of two buckets; grows by doubling when it is full.

    Fingerprint and buckets come from the two halves of a key's digest. Adding a key twice keeps two prints, so
    callers add a key once. A full table is rebuilt by the caller's `keys`, twice as large.
    """

    def __init__(self, n_keys: int, kicks: int = 500, table: np.ndarray | None = None):
        buckets = 1
        while buckets * SLOTS * 0.9 < max(n_keys, 1):
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16) if table is None else table
        self.kicks = kicks

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        return cls(0, table=np.frombuffer(blob, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and both buckets of keys, given as unsigned halves."""
        mask = np.uint64(len(self.table) - 1)
        prints = (hi >> np.uint64(48)).astype(np.uint64) | np.uint64(1)
        first = lo & mask
        return prints.astype(np.uint16), first.astype(np.int64), (first ^ self.turn(prints)).astype(np.int64)

    def turn(self, prints: np.ndarray) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(len(self.table) - 1)

    def contains(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        p, a, b = self.places(hi, lo)
        return (self.table[a] == p[:, None]).any(axis=1) | (self.table[b] == p[:, None]).any(axis=1)

    def add(self, hi: np.ndarray, lo: np.ndarray) -> bool:
        """False if a key found no place; the filter must then be rebuilt larger."""
        p, a, b = self.places(hi, lo)
        late = []
        for bucket in (a, b):
            rest = np.arange(len(p)) if bucket is a else np.array(late, dtype=np.int64)
            late = []
            for slot in range(SLOTS):
                if not len(rest):
                    break
                free = self.table[bucket[rest], slot] == 0
                take = rest[free]
                _, first = np.unique(bucket[take], return_index=True)
                won = take[first]
                self.table[bucket[won], slot] = p[won]
                rest = np.setdiff1d(rest, won, assume_unique=True)
            late = rest
        return all(self._kick(int(p[i]), int(b[i])) for i in late)

    def _kick(self, print_: int, bucket: int) -> bool:
        for turn in range(self.kicks):
            row = self.table[bucket]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = print_
                return True
            slot = (turn * 7 + print_) % SLOTS
            print_, row[slot] = int(row[slot]), print_
            bucket ^= int(self.turn(np.array([print_]))[0])
        return False

    def remove(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Only keys that were added may be removed."""
        for p, a, b in zip(*self.places(hi, lo)):
            for bucket in (a, b):
                slot = np.flatnonzero(self.table[bucket] == p)
                if len(slot):
                    self.table[bucket, slot[0]] = 0
                    break


def filled(hi: np.ndarray, lo: np.ndarray, kicks: int) -> CuckooFilter:
    """A filter of distinct keys, as large as it has to be."""
    size = len(hi)
    while True:
        table = CuckooFilter(size, kicks)
        if table.add(hi, lo):
            return table
        size = 2 * max(size, 4)


REFERENCE = pa.schema([("doc_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("lines", pa.int64())])


def references(docs: DataFrame, rules: LineRules) -> DataFrame:
    """doc_id, hi, lo, lines: which keys every document holds, and on how many lines."""
    least = rules.min_chars

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[dict]:
            for doc_id, text in each_row(batch, "doc_id", "text"):
                found: dict[tuple[int, int], int] = {}
                for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
                    key = line_key(line)
                    if n_chars(key) >= least:
                        digest = key_digest(key)
                        found[digest] = found.get(digest, 0) + 1
                for (hi, lo), lines in found.items():
                    yield {"doc_id": doc_id, "hi": hi, "lo": lo, "lines": lines}

        for batch in batches:
            yield from batches_of(rows(batch), REFERENCE, 65536)

    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return known.mapInArrow(task, "doc_id long, hi long, lo long, lines long")


def unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


@dataclass(frozen=True)
class LineStore:
    """refs: doc_id, hi, lo, lines. filters: shard, filter. Both are settled tables, or None when empty."""

    rules: LineRules = LineRules()
    shards: int = 0
    refs: DataFrame | None = None
    keys: DataFrame | None = None
    filters: DataFrame | None = None

    def _shard(self, shards: int):
        return F.pmod(F.col("hi"), F.lit(shards)).cast("int").alias("shard")

    def insert(self, docs: DataFrame) -> "LineStore":
        """The store with the documents of a batch. A document already in the store must be deleted first."""
        return self.insert_references(settle(references(docs, self.rules).groupBy("doc_id", "hi", "lo").agg(F.sum("lines").alias("lines"))))

    def insert_in_batches(self, docs: DataFrame) -> "LineStore":
        """The store with the documents of a table, which is read once and inserted part by part."""
        whole = settle(references(docs, self.rules).groupBy("doc_id", "hi", "lo").agg(F.sum("lines").alias("lines")))
        store = self
        for i in range(self.rules.batches):
            store = store.insert_references(whole.where(F.pmod(F.xxhash64("doc_id"), F.lit(self.rules.batches)) == i))
        return store

    def insert_references(self, batch: DataFrame) -> "LineStore":
        """The store with a batch given by its references, a written table or a part of one: doc_id, hi, lo, lines."""
        rules = self.rules
        counted = batch.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))
        if not self.shards:
            counted = settle(counted)
        # A store is laid out for the keys of its first batch; later batches make its filters larger, not more.
        shards = self.shards or max(1, -(-counted.count() // rules.shard_keys))
        kicks = rules.kicks
        known = self.filters if self.filters is not None else batch.sparkSession.createDataFrame([], "shard int, filter binary")

        def admit(new: pa.Table, old: pa.Table) -> pa.Table:
            """Ask the shard's filter about every key of the batch, then put the unknown keys in."""
            hi, lo = unsigned(new["hi"]), unsigned(new["lo"])
            blobs = old["filter"].to_pylist()
            shard = (new["shard"] if new.num_rows else old["shard"])[0].as_py()
            table = CuckooFilter.from_bytes(blobs[0]) if blobs else None
            seen = table.contains(hi, lo) if table is not None else np.zeros(len(hi), dtype=bool)
            out = pa.table({
                "shard": pa.array(np.full(len(hi), shard, dtype=np.int32)), "hi": new["hi"], "lo": new["lo"],
                "docs": new["docs"], "first_doc": new["first_doc"], "maybe": pa.array(seen),
                "filter": pa.nulls(len(hi), pa.binary()),
            })
            # A filter that is full is left empty here and built anew from the table below.
            if table is None:
                table, fits = filled(hi, lo, kicks), True
            else:
                fits = table.add(hi[~seen], lo[~seen])
            blob = table.to_bytes() if fits else b""
            row = pa.table({
                "shard": pa.array([shard], pa.int32()), **{c: pa.nulls(1, pa.int64()) for c in ("hi", "lo", "docs", "first_doc")},
                "maybe": pa.array([None], pa.bool_()), "filter": pa.array([blob], pa.binary()),
            })
            return pa.concat_tables([out.cast(row.schema), row])

        schema = "shard int, hi long, lo long, docs long, first_doc long, maybe boolean, filter binary"
        sharded = counted.select("hi", "lo", "docs", "first_doc", self._shard(shards))
        asked = settle(sharded.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(admit, schema))
        new_keys = asked.where("hi is not null").select("hi", "lo", "docs", "first_doc", "maybe")
        if self.keys is None:
            keys, refs = new_keys.drop("maybe"), batch
        else:
            # Only what the filters may know is looked up; everything else goes to the table as it is.
            asked_for = new_keys.where("maybe").select("hi", "lo", F.col("docs").alias("more"), F.col("first_doc").alias("first_more"))
            old = self.keys.join(asked_for, ["hi", "lo"], "left").select(
                "hi", "lo", (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.least("first_doc", "first_more").alias("first_doc")
            )
            false_alarms = new_keys.where("maybe").join(self.keys.select("hi", "lo"), ["hi", "lo"], "left_anti")
            added = settle(new_keys.where("not maybe").unionByName(false_alarms))
            keys = settle(old.unionByName(added.drop("maybe")))
            refs = self.refs.unionByName(batch)
        filters = asked.where("hi is null").select("shard", "filter")
        if self.keys is not None:
            # A false alarm is a new key after all: its print goes in as well, or a later deletion would lose it.
            late = added.where("maybe").select("hi", "lo", self._shard(shards))
            filters = settle(late.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_admit_late(kicks), "shard int, filter binary"))
            full = filters.where("length(filter) = 0").select("shard")
            rebuilt = _filters(keys.withColumn("shard", self._shard(shards)).join(full, "shard", "left_semi"), shards, kicks)
            filters = settle(filters.where("length(filter) > 0").unionByName(rebuilt))
        return replace(self, shards=shards, refs=refs, keys=keys, filters=filters)

    def delete(self, doc_ids: DataFrame) -> "LineStore":
        """The store without some documents, given by doc_id: as if they had never been inserted."""
        if self.refs is None:
            return self
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        touched = self.refs.join(gone, "doc_id", "left_semi").select("hi", "lo").distinct()
        refs = settle(self.refs.join(gone, "doc_id", "left_anti"))
        again = refs.join(touched, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(
            F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc")
        )
        keys = settle(self.keys.join(touched, ["hi", "lo"], "left_anti").unionByName(again))
        emptied = touched.join(keys.select("hi", "lo"), ["hi", "lo"], "left_anti").select("hi", "lo", self._shard(self.shards))

        def forget(gone_keys: pa.Table, old: pa.Table) -> pa.Table:
            table = CuckooFilter.from_bytes(old["filter"][0].as_py()) if old.num_rows else CuckooFilter(0)
            table.remove(unsigned(gone_keys["hi"]), unsigned(gone_keys["lo"]))
            shard = (old["shard"] if old.num_rows else gone_keys["shard"])[0].as_py()
            return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([table.to_bytes()], pa.binary())})

        filters = settle(emptied.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(forget, "shard int, filter binary"))
        return replace(self, refs=refs, keys=keys, filters=filters)

    def losses(self) -> DataFrame:
        """doc_id and the keys (an array of hi, lo) whose lines it loses."""
        repeated = self.keys.where(F.col("docs") >= self.rules.min_docs)
        return (
            self.refs.join(repeated, ["hi", "lo"])
            .where("doc_id <> first_doc")
            .groupBy("doc_id")
            .agg(F.collect_list(F.struct("hi", "lo")).alias("lost"))
        )


def _admit_late(kicks: int):
    def admit(late: pa.Table, old: pa.Table) -> pa.Table:
        blob = old["filter"][0].as_py() if old.num_rows else b""
        if blob and late.num_rows:
            table = CuckooFilter.from_bytes(blob)
            table.kicks = kicks
            blob = table.to_bytes() if table.add(unsigned(late["hi"]), unsigned(late["lo"])) else b""
        shard = (old["shard"] if old.num_rows else late["shard"])[0].as_py()
        return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([blob], pa.binary())})

    return admit


def _filters(keys: DataFrame, shards: int, kicks: int) -> DataFrame:
    def build(shard_keys: pa.Table) -> pa.Table:
        table = filled(unsigned(shard_keys["hi"]), unsigned(shard_keys["lo"]), kicks)
        return pa.table({"shard": shard_keys["shard"].slice(0, 1).cast(pa.int32()), "filter": pa.array([table.to_bytes()], pa.binary())})

    sharded = keys.select("hi", "lo", F.pmod(F.col("hi"), F.lit(shards)).cast("int").alias("shard"))
    return sharded.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def without_lost_lines(docs: DataFrame, store: LineStore) -> DataFrame:
    """`docs` with text rid of the lines each document loses, and behind its columns n_lines and n_dropped.

    An untouched text stays as it is; a null text becomes an empty one. Where `docs` has columns of these names, the
    counts take the first unused names that begin so.
    """
    least = store.rules.min_chars
    # By place, so that any name will do.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text_at, doc_id = docs.columns.index("text"), F.col(f"c{docs.columns.index('doc_id')}")
    joined = plain.join(store.losses(), doc_id == F.col("doc_id"), "left").select(*plain.columns, "lost")
    schema = T.StructType([*plain.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, lost_keys in zip(batch.column(text_at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
                kept = lines
                if lost_keys:
                    gone = {(k["hi"], k["lo"]) for k in lost_keys}
                    kept = [x for x in lines if n_chars(k := line_key(x)) < least or key_digest(k) not in gone]
                texts.append(b"\n".join(kept).decode("utf-8", "replace"))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = batch.columns[:-1]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=schema.names)

    return joined.mapInArrow(task, schema).toDF(*docs.columns, *[unused(docs, n) for n in ("n_lines", "n_dropped")])


def dedup_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The texts of a table without lost lines; its documents go into an empty store, batch after batch."""
    return without_lost_lines(docs, LineStore(rules).insert_in_batches(docs.select("doc_id", "text")))
