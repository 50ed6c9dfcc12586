"""Vector codes: the entry nearest to each of 16 parts, found again after each change of the codebooks through Drake-Hamerly bounds.

Vectors become whole numbers and are cut into equal parts, each with a codebook of at most 64 entries. The first assignment looks at
every entry. It leaves, per part, the b closest other entries in order with a lower bound of the distance to each, and one outer
bound for all the rest; this state is written beside the vector. After the entries have moved, bounds shrink by the moves and are
put in order again from the right; with the exact distance to a part's own entry, the first bound above it says how many of the
near entries can still be closer: none (the assignment stands), some (those are compared as whole numbers), or perhaps one beyond
the outer bound (all are). Bounds are rounded down to steps and moves up, so they are never too sharp, and whatever they leave
open is settled in whole numbers: codes are exact, ties to the lower index. b adapts: a block of vectors keeps as many near entries
as its parts had to look at, at least `least`.

Codebooks are the one thing sent to all tasks and fetched: entries x components whole numbers, whatever the input. Sums for new
entries are formed in the tasks and added up by Spark.

Defined cases: rows whose vector is null or holds null or non-finite components are left out; an empty vector is all zeros. Vectors
of different lengths are filled with zeros to the longest length (a multiple of the parts). Whole numbers beyond 2^24 in size (a
component of 65,536) are held there, so that a distance fits a long; a sum of errors that does not is given as the largest long.
Rows without vec_id start no entry; equal vec_ids start entries in the order of their vectors. Repeated rows have a row each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import documents_only, settle

HIGHEST = 1 << 24
TOP = 65535


@dataclass(frozen=True)
class CodeRules:
    """near is the first b; least the smallest."""

    scale: int = 256
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    near: int = 8
    least: int = 2


def whole_numbers(vectors: DataFrame, rules: CodeRules) -> DataFrame:
    """vec_id, label, ints (binary, little-endian, 32 bits each) of the vectors that take part."""
    plain = documents_only(vectors, "vec_id", "label", "embedding").withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    label = plain.schema["label"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = []
            for x in batch.column(2):
                # The bound comes first: a float times 256 may be beyond all floats.
                bound = HIGHEST / rules.scale
                x = np.clip(np.asarray(x.values, dtype=np.float64), -bound, bound)
                ints.append(np.floor(x * rules.scale).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ints, pa.binary())], names=["vec_id", "label", "ints"])

    return plain.where(F.col("embedding").isNotNull() & finite).mapInArrow(task, f"vec_id long, label {label}, ints binary")


@dataclass(frozen=True)
class Shape:
    """How many components a part has, the largest whole number's size, and the step of the bounds."""

    width: int
    most: int
    parts: int

    @property
    def step(self) -> float:
        return max(1 / 16, 2.0 * self.most * np.sqrt(self.width) / TOP)

    def cut(self, rows: list[bytes]) -> np.ndarray:
        """Vectors x parts x components."""
        out = np.zeros((len(rows), self.parts * self.width), dtype=np.int64)
        full = out.shape[1] * 4
        if all(len(r) == full for r in rows):
            out[:] = np.frombuffer(b"".join(rows), dtype="<i4").reshape(out.shape)
        else:
            for i, r in enumerate(rows):
                out[i, : len(r) // 4] = np.frombuffer(r, dtype="<i4")
        return out.reshape(len(rows), self.parts, self.width)

    def squares(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Exact squared distances of rows (n, width) to entries (m, width)."""
        # Sums of squares below 2^53 are exact in doubles, whose products are the fast ones.
        kind = np.float64 if 4 * self.most * self.most * self.width < 1 << 53 else np.int64
        x, entries = x.astype(kind), entries.astype(kind)
        return ((x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None]).astype(np.int64)


def shape_of(numbers: DataFrame, rules: CodeRules) -> Shape:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest, most = 0, 0
        for batch in batches:
            for r in batch.column(0).to_pylist():
                x = np.frombuffer(r, dtype="<i4")
                longest, most = max(longest, len(x)), max(most, int(np.abs(x).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([longest], pa.int64()), pa.array([most], pa.int64())], names=["longest", "most"])

    longest, most = numbers.select("ints").mapInArrow(task, "longest long, most long").agg(F.max("longest"), F.max("most")).first()
    return Shape(max(1, -(-(longest or 0) // rules.parts)), max(1, most or 0), rules.parts)


def first_books(numbers: DataFrame, shape: Shape, rules: CodeRules) -> np.ndarray:
    """parts x entries x components."""
    rows = numbers.where("vec_id is not null").orderBy("vec_id", "ints").limit(rules.entries).select("ints").collect()
    return shape.cut([bytes(r[0]) for r in rows]).transpose(1, 0, 2)


# -- state: per vector and part the own entry, b near entries, their lower bounds in steps, and the outer bound


@dataclass
class State:
    own: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray

    def rows(self) -> list[bytes]:
        """Per vector: own, outer, near, low; b follows from the length."""
        n = len(self.own)
        flat = [self.own.reshape(n, -1).view(np.uint8), self.outer.astype("<u2").reshape(n, -1).view(np.uint8)]
        flat += [self.near.reshape(n, -1), np.ascontiguousarray(self.low.astype("<u2").reshape(n, -1)).view(np.uint8)]
        return [r.tobytes() for r in np.concatenate(flat, axis=1)]

    @staticmethod
    def of(rows: list[bytes], parts: int) -> State:
        n, size = len(rows), len(rows[0])
        b = (size - 3 * parts) // (3 * parts)
        raw = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(n, size)
        ends = np.cumsum([parts, 2 * parts, parts * b, 2 * parts * b])
        own, outer, near, low = (np.ascontiguousarray(x) for x in np.split(raw, ends[:-1], axis=1))
        return State(own, near.reshape(n, parts, b), low.view("<u2").reshape(n, parts, b), outer.view("<u2").reshape(n, parts))


def in_steps(distance: np.ndarray, step: float) -> np.ndarray:
    """Distances as whole steps, rounded down; what is beyond the scale stays a lower bound."""
    return np.clip(np.floor(distance * (1 - 1e-9) / step), 0, TOP).astype(np.uint16)


def nearest(squares: np.ndarray, b: int, step: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Own entry, b near ones, their bounds and the outer bound, from all exact distances."""
    order = np.argsort(squares, axis=1, kind="stable")
    far = np.sqrt(np.take_along_axis(squares, order, axis=1).astype(np.float64))
    outer = in_steps(far[:, b + 1], step) if far.shape[1] > b + 1 else np.full(len(far), TOP, dtype=np.uint16)
    return order[:, 0].astype(np.uint8), order[:, 1 : b + 1].astype(np.uint8), in_steps(far[:, 1 : b + 1], step), outer


def assign_all(x: np.ndarray, books: np.ndarray, shape: Shape, b: int) -> State:
    own, near, low, outer = zip(*[nearest(shape.squares(x[:, p], books[p]), b, shape.step) for p in range(shape.parts)])
    return State(*(np.stack(a, axis=1) for a in (own, near, low, outer)))


def assign_again(x: np.ndarray, old: State, books: np.ndarray, moved: np.ndarray, shape: Shape, least: int) -> tuple[State, np.ndarray, dict[str, int]]:
    """The state for books that have moved by at most `moved` (parts x entries), and exact squared distances to the own entries."""
    n, parts, b = old.near.shape
    entries = books.shape[1]
    step = shape.step
    state = State(old.own.copy(), old.near.copy(), old.low.copy(), old.outer.copy())
    errors = np.empty((n, parts), dtype=np.int64)
    looked, seen = 0, {"stood": 0, "near": 0, "all": 0}
    for p in range(parts):
        book, move = books[p], moved[p]
        own, near = old.own[:, p].astype(np.int64), old.near[:, p].astype(np.int64)
        gap = x[:, p] - book[own]
        exact = (gap * gap).sum(1)
        reach = np.sqrt(exact.astype(np.float64)) * (1 + 1e-9)
        bounds = np.concatenate([old.low[:, p] * step - move[near], (old.outer[:, p] * step - move.max())[:, None]], axis=1)
        if entries <= b + 1:
            bounds[:, -1] = np.inf  # nobody is outside
        bounds = np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]
        # The first bound above the distance to the own entry: only the entries before it can be as close.
        above = reach[:, None] < bounds
        first = np.where(above.any(axis=1), above.argmax(axis=1), b + 1)
        low = in_steps(np.maximum(bounds[:, :b], 0), step)
        outer = in_steps(np.minimum(np.maximum(bounds[:, b], 0), TOP * step), step)
        some = np.flatnonzero((first > 0) & (first <= b))
        every = np.flatnonzero(first > b)
        if len(some):
            # Own entry and near ones; bounds stand in for the distances of those that cannot be closer.
            who = np.concatenate([own[some][:, None], near[some]], axis=1)
            gap = x[some, p][:, None, :] - book[who]
            squares = (gap * gap).sum(2)
            open_ = np.arange(b + 1)[None] <= first[some][:, None]
            best = np.lexsort((np.where(open_, who, entries), np.where(open_, squares, np.iinfo(np.int64).max)), axis=1)[:, 0]
            at = np.arange(len(some))
            exact[some], state.own[some, p] = squares[at, best], who[at, best]
            bound = np.where(open_, in_steps(np.sqrt(squares.astype(np.float64)), step).astype(np.int64), np.concatenate([np.zeros((len(some), 1), dtype=np.int64), low[some].astype(np.int64)], axis=1))
            bound[at, best] = -1
            order = np.argsort(bound, axis=1, kind="stable")[:, 1:]
            near[some], low[some] = np.take_along_axis(who, order, axis=1), np.take_along_axis(bound, order, axis=1)
        if len(every):
            squares = shape.squares(x[every, p], book)
            state.own[every, p], near[every], low[every], outer[every] = nearest(squares, b, step)
            exact[every] = squares[np.arange(len(every)), state.own[every, p]]
        looked = max(looked, int(first.max(initial=0)))
        for name, rows in (("near", len(some)), ("all", len(every)), ("stood", n - len(some) - len(every))):
            seen[name] += rows
        state.near[:, p], state.low[:, p], state.outer[:, p], errors[:, p] = near, low, outer, exact
    keep = min(b, max(least, looked))
    if keep < b:
        # What is no longer kept by itself is beyond the outer bound.
        state.outer = np.minimum(state.outer, state.low[:, :, keep])
        state.near, state.low = np.ascontiguousarray(state.near[:, :, :keep]), np.ascontiguousarray(state.low[:, :, :keep])
    return state, errors, seen


# -- rounds


def _alike(batch: pa.RecordBatch, size: int = 2048) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of a batch whose states have one b."""
    for at in range(0, batch.num_rows, size):
        piece = batch.slice(at, size)
        lengths = np.array([len(s) for s in piece.column("state").to_pylist()])
        for length in np.unique(lengths):
            some = piece.take(pa.array(np.flatnonzero(lengths == length)))
            yield some, some.column("state").to_pylist()


def started(numbers: DataFrame, books: np.ndarray, shape: Shape, rules: CodeRules) -> DataFrame:
    """numbers with state."""
    held = numbers.sparkSession.sparkContext.broadcast(books)
    b = min(rules.near, books.shape[1] - 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                piece = batch.slice(at, 2048)
                state = assign_all(shape.cut(piece.column("ints").to_pylist()), held.value, shape, b)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(state.rows(), pa.binary())], names=[*piece.schema.names, "state"])

    label = numbers.schema["label"].dataType.simpleString()
    return numbers.mapInArrow(task, f"vec_id long, label {label}, ints binary, state binary")


def moved_on(held_rows: DataFrame, old: np.ndarray, books: np.ndarray, shape: Shape, rules: CodeRules, last: bool) -> DataFrame:
    """The rows with the state for the new books; after the last round code and error instead."""
    gap = (books - old).astype(np.float64)
    held = held_rows.sparkSession.sparkContext.broadcast((books, np.sqrt((gap * gap).sum(2)) * (1 + 1e-9)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, moved = held.value
        for batch in batches:
            for piece, states in _alike(batch):
                x = shape.cut(piece.column("ints").to_pylist())
                state, errors, _ = assign_again(x, State.of(states, shape.parts), now, moved, shape, rules.least)
                ids, labels = piece.column("vec_id"), piece.column("label")
                if last:
                    code = ["".join(f"{e:02x}" for e in row) for row in state.own.tolist()]
                    yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code), pa.array(errors.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])
                else:
                    yield pa.RecordBatch.from_arrays([ids, labels, piece.column("ints"), pa.array(state.rows(), pa.binary())], names=["vec_id", "label", "ints", "state"])

    label = held_rows.schema["label"].dataType.simpleString()
    return held_rows.mapInArrow(task, f"vec_id long, label {label}, " + ("code string, error long" if last else "ints binary, state binary"))


def means(held_rows: DataFrame, books: np.ndarray, shape: Shape) -> np.ndarray:
    """Each entry as the componentwise floor of the mean of its parts; unused entries as they are."""
    parts, entries, width = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books_shape, dtype=np.int64), np.zeros(books_shape[:2], dtype=np.int64)
        for batch in batches:
            x = shape.cut(batch.column("ints").to_pylist())
            own = np.array([np.frombuffer(s, dtype=np.uint8, count=parts) for s in batch.column("state").to_pylist()]).reshape(-1, parts)
            for p in range(parts):
                np.add.at(sums[p], own[:, p], x[:, p])
                counts[p] += np.bincount(own[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e], pa.int64()), pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "sums"])

    books_shape = books.shape
    added = held_rows.select("ints", "state").mapInArrow(task, "part int, entry int, n long, sums array<long>")
    total = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    out = books.copy()
    for part, entry, n, *sums in total.collect():
        out[part, entry] = [s // n for s in sums]
    return out


def book_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, rules: CodeRules = CodeRules()) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of each vector that takes part, and the codebooks (parts x entries x components)."""
    numbers = settle(whole_numbers(vectors, rules))
    shape = shape_of(numbers, rules)
    books = first_books(numbers, shape, rules)
    if not books.shape[1]:
        return numbers.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    now = started(numbers, books, shape, rules)
    for left in reversed(range(rules.rounds)):
        now = settle(now)
        old, books = books, means(now, books, shape)
        now = moved_on(now, old, books, shape, rules, last=left == 0)
    return settle(now), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error: the sum of errors over equal labels, null being equal to null."""
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy(F.col("label").alias("of_label")).agg(F.least(F.sum(F.col("error").cast("decimal(19,0)")), most).cast("long").alias("label_error"))
    sums = settle(sums)
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
