"""Exact removal of repeated byte strings by prefix ranks at growing lengths, over all documents.

Two positions share a string of `length` bytes if and only if they have equal rank among all prefixes of that length.
Ranks are found for growing prefix lengths, and a position leaves as soon as its rank is unique: first over strings of
`anchor` bytes, then over nearly the whole length, then over pairs of half-length ranks. A rank is a 64-bit fingerprint
of the prefix, so equal prefixes have equal ranks everywhere without a global sort; pairs have 128 bits.

The first round does not look at every position. Each string of `length` bytes is stood for by its anchor: of the short
strings in it, the one with the smallest fingerprint, the leftmost of equal ones. Neighbouring positions mostly share
their anchor and travel as one segment; equal strings have equal anchors at equal distances. Then:

1. An anchor whose fingerprint occurs once has no repeated string. If all segments of an anchor are equal, every
   position of theirs is repeated. Of mixed anchors, equal segments are settled, and one of each goes on.
2. Segments are cut into blocks of positions at fixed distances from the anchor. A block's core is what its strings
   have in common. A core that occurs once is done; if all blocks of a core are equal, they are repeated.
3. What is left, some positions at the edges of repeated passages, is compared position by position by the pair of
   ranks of the first and second half.

Ranks are counted with partial aggregates and joined back, where adaptive execution deals out hot ranks; nothing is
gathered per rank. Texts travel as compressed chunks of bounded size.

Defined cases: a null text has no bytes; texts shorter than `length` keep everything; rows are documents of their own
even if doc_id is null or repeated, so repeated rows of that length lose everything. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import mix64, settle


@dataclass(frozen=True)
class RepeatRules:
    """length of strings and anchors in bytes; positions per block; bytes per chunk and per piece worked on at once."""

    length: int = 200
    anchor: int = 40
    block: int = 16
    chunk_bytes: int = 256 << 10
    piece: int = 1 << 20


ODD = np.uint64(0x9E3779B97F4A7C15)
ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A fixed random odd number for every byte.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n, 1).bit_length()
    if size not in _POWERS:
        _POWERS[size] = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, dtype=np.uint64))]) for b in (ODD, ODD_INVERSE))
    return _POWERS[size]


class Prints:
    """Fingerprints of any substring of a buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.down[:n])


def anchors(data: np.ndarray, rules: RepeatRules) -> np.ndarray:
    """For each start of a string, where its anchor starts. The buffer is at most 16 MB."""
    span = rules.length - rules.anchor + 1
    prints = Prints(data).all(rules.anchor)
    # The high 40 bits choose, the position among equal ones: the smallest number is the leftmost smallest print.
    least = (prints & ~np.uint64(0xFFFFFF)) | np.arange(len(prints), dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    return (least & np.uint64(0xFFFFFF)).astype(np.int64)


def segments(data: np.ndarray, lengths: np.ndarray, rules: RepeatRules) -> dict[str, np.ndarray]:
    """Runs of starts with one anchor: at, n, off (anchor less at), anchor and segment fingerprints.

    No string crosses a document's end. Buffers are worked on in pieces; a run cut by a piece's end is two.
    """
    ends = np.cumsum(lengths)
    valid = np.ones(len(data), dtype=bool)
    for low, high in zip(np.maximum(ends - rules.length + 1, ends - lengths), ends):
        valid[low:high] = False
    found = {k: [] for k in ("at", "n", "off", "anchor", "seg")}
    for base in range(0, max(len(data) - rules.length + 1, 0), rules.piece):
        part = data[base : base + rules.piece + rules.length - 1]
        at = anchors(part, rules)
        ok = valid[base : base + len(at)]
        change = np.flatnonzero((at[1:] != at[:-1]) | (ok[1:] != ok[:-1])) + 1
        low = np.concatenate([[0], change])
        high = np.concatenate([change, [len(at)]]) - 1
        low, high = low[ok[low]], high[ok[low]]
        prints = Prints(part)
        n = high - low + 1
        found["at"].append(low + base)
        found["n"].append(n)
        found["off"].append(at[low] - low)
        found["anchor"].append(prints.of(at[low], at[low] + rules.anchor))
        found["seg"].append(prints.of(low, high + rules.length) + n.astype(np.uint64) * ODD)
    return {k: np.concatenate(v) if v else np.zeros(0, dtype=np.uint64 if k in ("anchor", "seg") else np.int64) for k, v in found.items()}


CHUNK = "chunk long, doc_ids array<long>, lengths array<int>, texts binary"


def chunks(docs: DataFrame, rules: RepeatRules) -> DataFrame:
    """Rows of many documents: their texts one after the other, compressed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, packer = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(6)
        doc_ids, texts, size = [], [], 0

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            row = [(part << 32) + made, doc_ids, [len(t) for t in texts], packer.compress(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=["chunk", "doc_ids", "lengths", "texts"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                doc_ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
                if size >= rules.chunk_bytes:
                    yield out()
                    made += 1
                    doc_ids, texts, size = [], [], 0
        if doc_ids:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, CHUNK)


def unpacked(texts: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(texts), dtype=np.uint8)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


SEGMENT = "chunk long, at int, n int, off int, anchor long, seg long"


def all_segments(held: DataFrame, rules: RepeatRules) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lengths, texts in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                s = segments(unpacked(texts), np.array(lengths, dtype=np.int64), rules)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(s["at"]), chunk, dtype=np.int64)),
                        *[pa.array(s[k].astype(np.int32)) for k in ("at", "n", "off")],
                        signed(s["anchor"]),
                        signed(s["seg"]),
                    ],
                    names=["chunk", "at", "n", "off", "anchor", "seg"],
                )

    return held.select("chunk", "lengths", "texts").mapInArrow(task, SEGMENT)


def _blocks(rules: RepeatRules):
    """From segments of a chunk, their blocks: core, variant, at, n."""

    def task(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        at, n, off = (wanted[c].to_numpy().astype(np.int64) for c in ("at", "n", "off"))
        data = unpacked(texts["texts"][0].as_py()) if texts.num_rows and len(at) else np.zeros(0, dtype=np.uint8)
        first = np.repeat(at, n)
        start = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        anchor = np.repeat(at + off, n)
        number = (anchor - start) // rules.block
        segment = np.repeat(np.arange(len(n)), n)
        low = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (segment[1:] != segment[:-1])])) if len(start) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.concatenate([low, [len(start)]]))
        begin, number, anchor = start[low], number[low], anchor[low]
        prints = Prints(data)
        core = anchor - number * rules.block
        cores = mix64(prints.of(core, core + rules.length - rules.block + 1) + number.astype(np.uint64) * ODD)
        variants = prints.of(begin, begin + size - 1 + rules.length) + size.astype(np.uint64) * ODD + (begin - core).astype(np.uint64)
        chunk = wanted["chunk"][0].as_py() if len(at) else 0
        return pa.table({
            "chunk": pa.array(np.full(len(low), chunk, dtype=np.int64)), "at": pa.array(begin.astype(np.int32)), "n": pa.array(size.astype(np.int32)),
            "core": signed(cores), "variant": signed(variants),
        })

    return task


def _positions(rules: RepeatRules):
    """From blocks of a chunk, each position with the ranks of both halves of its string."""

    def task(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        at, n = (wanted[c].to_numpy().astype(np.int64) for c in ("at", "n"))
        data = unpacked(texts["texts"][0].as_py()) if texts.num_rows and len(at) else np.zeros(0, dtype=np.uint8)
        start = np.repeat(at, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        prints, half = Prints(data), rules.length // 2
        chunk = wanted["chunk"][0].as_py() if len(at) else 0
        return pa.table({
            "chunk": pa.array(np.full(len(start), chunk, dtype=np.int64)), "at": pa.array(start.astype(np.int32)),
            "first_half": signed(prints.of(start, start + half)), "second_half": signed(prints.of(start + half, start + rules.length)),
        })

    return task


def repeated_starts(held: DataFrame, rules: RepeatRules) -> DataFrame:
    """chunk, at, n: runs of positions whose string also starts elsewhere."""
    found = all_segments(held, rules)
    ranks = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), (F.min("seg") != F.max("seg")).alias("mixed"))
    live = settle(found.join(ranks.where("times > 1").select("anchor", "mixed"), "anchor"))
    runs = [live.where("not mixed").select("chunk", "at", "n")]
    open_ = live.where("mixed")
    place = F.struct("chunk", "at", "n", "off")
    variants = settle(open_.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("one")))
    runs.append(open_.join(variants.where("times > 1").select("anchor", "seg"), ["anchor", "seg"]).select("chunk", "at", "n"))
    texts = held.select("chunk", "texts").groupBy("chunk")
    blocks = settle(texts.cogroup(variants.select("one.*").groupBy("chunk")).applyInArrow(_blocks(rules), "chunk long, at int, n int, core long, variant long"))
    cores = blocks.groupBy("core").agg(F.count(F.lit(1)).alias("times"), (F.min("variant") != F.max("variant")).alias("mixed"))
    cut = settle(blocks.join(cores.where("times > 1").select("core", "mixed"), "core").select("chunk", "at", "n", "mixed"))
    runs.append(cut.where("not mixed").select("chunk", "at", "n"))
    edges = settle(
        texts.cogroup(cut.where("mixed").select("chunk", "at", "n").groupBy("chunk")).applyInArrow(
            _positions(rules), "chunk long, at int, first_half long, second_half long"
        )
    )
    pairs = edges.groupBy("first_half", "second_half").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    runs.append(edges.join(pairs, ["first_half", "second_half"]).select("chunk", "at", F.lit(1).alias("n")))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def without_repeats(docs: DataFrame, rules: RepeatRules = RepeatRules()) -> DataFrame:
    """doc_id, n_bytes, removed (start, end of each run of removed bytes), kept (the other bytes) of every row of `docs`."""
    held = settle(chunks(docs, rules))

    def task(texts: pa.Table, runs: pa.Table) -> pa.Table:
        data, lengths = unpacked(texts["texts"][0].as_py()), np.array(texts["lengths"][0].as_py(), dtype=np.int64)
        steps = np.zeros(len(data) + 1, dtype=np.int32)
        at, n = (runs[c].to_numpy().astype(np.int64) for c in ("at", "n"))
        np.add.at(steps, at, 1)
        np.add.at(steps, at + n - 1 + rules.length, -1)
        gone = np.cumsum(steps[:-1]) > 0
        removed, kept = [], []
        for end, size in zip(np.cumsum(lengths), lengths):
            mine = gone[end - size : end]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            removed.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
            kept.append(data[end - size : end][~mine].tobytes())
        return pa.table({
            "doc_id": pa.array(texts["doc_ids"][0].as_py(), pa.int64()), "n_bytes": pa.array(lengths),
            "removed": pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(kept, pa.binary()),
        })

    schema = "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"
    return held.groupBy("chunk").cogroup(repeated_starts(held, rules).groupBy("chunk")).applyInArrow(task, schema)
