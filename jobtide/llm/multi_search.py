"""Benchmark passages in documents: Wu-Manber search for every window of every item.

The alphabet is words, so an occurrence never starts inside a word. All windows of one length share a shift table from blocks
of two neighbouring words to how far the search may move on, and buckets by the window's last block, parted by its first
block; candidates of a bucket are compared word by word. Most places of a clean document hold a block that no window has,
and the search skips a window's length less one. Windows shorter than the usual length (of short items) have tables of
their own length, so that one short item does not shorten the shifts of all.

Documents are searched where they lie: with a benchmark of up to `shard_bytes` there is no shuffle. The size of the windows is
measured first; a larger benchmark is dealt by digest into shards of that size, each searched in a pass of its own, and only
documents with hits are merged.

Defined cases: null and empty texts have no words; items without words are nowhere; items without item_id cover words but are
not counted; rows sharing an item_id are one item; each document row has one row, repeated rows too; an empty benchmark covers nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import documents_only, settle

Words = list[bytes]


@dataclass(frozen=True)
class SearchRules:
    """Windows of `window` words; windows of at most about `shard_bytes` bytes are sent to the tasks at once."""

    window: int = 10
    shard_bytes: int = 16 << 20


def _letters() -> bytes:
    """For each byte: itself in lower case if it belongs to a word (letters, digits, all beyond ASCII), else a space."""
    return bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


LETTERS = _letters()


def words_of(text: bytes | None) -> Words:
    return text.translate(LETTERS).split() if text else []


class Tables:
    """Shift table and buckets of all windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[str]]]]] = {}
        for window, items in windows.items():
            for at in range(self.far):
                block = window[at : at + self.block]
                self.shift[block] = min(self.shift.get(block, self.far), self.far - 1 - at)
            self.buckets.setdefault(window[-self.block :], {}).setdefault(window[: self.block], []).append((window, items))

    def occurrences(self, words: Words) -> Iterator[tuple[int, list[str]]]:
        """The place of the first word and the items of each occurrence, from left to right."""
        shift, far, size, back = self.shift.get, self.far, self.block, self.length - 1
        end, n = back, len(words)
        while end < n:
            block = tuple(words[end + 1 - size : end + 1])
            step = shift(block, far)
            if step:
                end += step
                continue
            start = end - back
            for window, items in self.buckets[block].get(tuple(words[start : start + size]), ()):
                if tuple(words[start : end + 1]) == window:
                    yield start, items
            end += 1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of what the spans cover."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def search(tables: list[Tables], words: Words) -> tuple[list[tuple[int, int]], list[str]]:
    spans, items = [], set()
    for t in tables:
        run: tuple[int, int] | None = None
        for start, found in t.occurrences(words):
            items.update(found)
            # Occurrences of one length come in order: runs are merged as they come.
            if run and start <= run[1]:
                run = (run[0], start + t.length)
            else:
                if run:
                    spans.append(run)
                run = (start, start + t.length)
        if run:
            spans.append(run)
    return merged(spans), sorted(items)


def windows_of(items: DataFrame, rules: SearchRules) -> DataFrame:
    """Distinct (window, item_id): words joined by a space, and the item as a string."""
    width = rules.window

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for at in range(max(1, len(words) - width + 1) if words else 0):
                    windows.append(b" ".join(words[at : at + width]))
                    ids.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(ids, pa.string())], names=["window", "item_id"])

    plain = documents_only(items, "item_id", "text").select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    return plain.mapInArrow(task, "window binary, item_id string").distinct()


def dealt(pairs: DataFrame, rules: SearchRules) -> int:
    """In how many shards the windows go."""
    size = pairs.agg(F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + 16)).first()[0] or 0
    return max(1, -(-size // rules.shard_bytes))


def tables_of(pairs: DataFrame, part: int, parts: int) -> list[Tables]:
    """The tables of one shard: about shard_bytes, as the digest deals pairs, so that a window of very many items is dealt out as well."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for row in pairs.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(parts)) == part).collect():
        window = tuple(bytes(row["window"]).split(b" "))
        held = by_length.setdefault(len(window), {}).setdefault(window, [])
        if row["item_id"] is not None:
            held.append(row["item_id"])
    return [Tables(length, windows) for length, windows in by_length.items()]


SPANS = "array<struct<start:bigint,end:bigint>>"


def scan(docs: DataFrame, tables: list[Tables]) -> DataFrame:
    """docs (doc_id, text as binary, row_key) with n_words, spans and items instead of the text."""
    held = docs.sparkSession.sparkContext.broadcast(tables)
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                covered, found = search(held.value, words)
                n_words.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in covered])
                items.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pair)), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "row_key", "n_words", "spans", "items"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(task, f"doc_id {kind}, row_key string, n_words bigint, spans {SPANS}, items array<string>")


def _merge(found: DataFrame) -> DataFrame:
    """One row per row_key from a row for each shard; rows that are the same document give the same spans."""
    pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged([(s["start"], s["end"]) for s in x]) for x in batch.column(1).to_pylist()]
            items = [sorted(set(x)) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pair)), pa.array(items, pa.list_(pa.string()))],
                names=["row_key", "spans", "items"],
            )

    each = found.where(F.size("spans") > 0).select("row_key", "spans", "items").distinct()
    both = each.groupBy("row_key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return both.mapInArrow(task, f"row_key string, spans {SPANS}, items array<string>")


def passages(docs: DataFrame, items: DataFrame, rules: SearchRules = SearchRules()) -> DataFrame:
    """doc_id, n_words, spans (maximal runs of covered words, [start, end)), items (ids as sorted strings) of every row of `docs`."""
    plain = documents_only(docs, "doc_id", "text")
    pairs = settle(windows_of(items, rules))
    parts = dealt(pairs, rules)
    if parts == 1:
        narrow = plain.select("doc_id", F.col("text").cast("binary").alias("text"), F.lit(None).cast("string").alias("row_key"))
        return scan(narrow, tables_of(pairs, 0, 1)).drop("row_key")
    keyed = plain.select("doc_id", F.col("text").cast("binary").alias("text"), F.sha2(F.to_json(F.struct("doc_id", "text")), 256).alias("row_key"))
    found = settle(scan(keyed, tables_of(pairs, 0, parts)))
    hits = found
    for part in range(1, parts):
        # One shard at a time is in memory, here and in the tasks.
        hits = hits.unionByName(settle(scan(keyed, tables_of(pairs, part, parts)).where(F.size("spans") > 0)))
    hits = settle(_merge(hits)).withColumnsRenamed({"row_key": "hit_key"})
    empty = F.array().cast(SPANS), F.array().cast("array<string>")
    whole = found.select("doc_id", "row_key", "n_words").join(hits, F.col("row_key") == F.col("hit_key"), "left")
    return whole.select("doc_id", "n_words", F.coalesce("spans", empty[0]).alias("spans"), F.coalesce("items", empty[1]).alias("items"))
