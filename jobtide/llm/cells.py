"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one vector of a group kept.

Equal vectors are one before anything is compared. Cells come from spherical k-means, started from the vectors with
the smallest digests. Every vector is at home in the cell with the largest product; it also visits each cell of a
smaller number in whose home vectors could lie within the angle of the threshold. If x is at home in a and y in b, then
x.(c_a - c_b) >= 0, and a y within the angle of x has y.(c_a - c_b) >= -sin(angle) |c_a - c_b|: a vector that misses this bound has no
link into a. So no link is lost, whatever the cells look like; how few cells are visited depends on the data.

Cells are cut into blocks of at most about `block_rows` home vectors and visitors; a task multiplies two blocks in double
precision, a strip at a time, and gives per vector the number of links and an edge to the smallest of its group in the
blocks, never the pairs. A hot cell only has more blocks. The number of cells is bounded, and with it the centres,
the one thing sent to all tasks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components have no link and are kept; so are
rows without vec_id, whose component is null; vectors of different lengths are not compared; repeated rows are linked
with each other. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import settle
from jobtide.llm.components import components


@dataclass(frozen=True)
class CellRules:
    """cell_rows vectors in a cell on average, as long as there are no more than max_cells."""

    threshold: float = 0.95
    cell_rows: int = 2048
    max_cells: int = 1024
    rounds: int = 4
    block_rows: int = 2048
    strip: int = 512


def unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), dtype=np.float64).reshape(len(rows), -1)
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _plain(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _usable():
    """Whether a row has an id and a vector with a direction; never null."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(F.col("vec_id").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def packed(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, vector (binary doubles) of the vectors that can be compared."""
    good = _plain(vectors).where(_usable())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in values], pa.int32()), pa.array([(np.array(x) + 0.0).tobytes() for x in values], pa.binary())],
                names=["vec_id", "dim", "vector"],
            )

    return good.mapInArrow(task, "vec_id long, dim int, vector binary")


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Row numbers and vectors of a batch, one length at a time."""
    dims, vectors = batch.column("dim").to_numpy(), batch.column("vector").to_pylist()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield at, [vectors[i] for i in at]


def products(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    n = min(x.shape[1], centres.shape[1])
    return x[:, :n] @ centres[:, :n].T


def fit(vectors: DataFrame, n: int, rules: CellRules) -> np.ndarray:
    """Centres of spherical k-means over all of `vectors`, as rows; their number is bounded by the rules."""
    k = min(rules.max_cells, max(2, -(-n // rules.cell_rows)))
    first = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(k).select("vector").collect()
    width = max((len(r[0]) // 8 for r in first), default=1)
    centres = np.zeros((max(len(first), 1), width))
    for i, r in enumerate(first):
        x = unit([bytes(r[0])])[0]
        centres[i, : len(x)] = x
    for _ in range(rules.rounds):
        centres = _round(vectors, centres)
    return centres


def _round(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros_like(centres)
        for batch in batches:
            for _, rows in by_dim(batch):
                x = unit(rows)
                width = min(x.shape[1], centres.shape[1])
                np.add.at(sums[:, :width], products(x, centres).argmax(axis=1), x[:, :width])
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([s.tolist() for s in sums[used]], pa.list_(pa.float64()))], names=["cell", "sums"])

    parts = vectors.select("dim", "vector").mapInArrow(task, "cell int, sums array<double>")
    added = parts.select("cell", F.posexplode("sums").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x"))
    rows = added.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("c")).select("cell", "c.x").collect()
    out = centres.copy()
    for cell, x in rows:
        norm = float(np.linalg.norm(x))
        if norm > 0:
            out[cell] = np.array(x) / norm
    return out


def placed(vectors: DataFrame, centres: np.ndarray, rules: CellRules) -> DataFrame:
    """vectors with home and visits: the cells with smaller numbers in which a link could be at home."""
    reach = float(np.sqrt(1 - rules.threshold**2)) + 1e-9
    held = vectors.sparkSession.sparkContext.broadcast(centres)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, gaps = held.value, {}
        for batch in batches:
            home, visits = np.zeros(batch.num_rows, dtype=np.int32), [None] * batch.num_rows
            for at, rows in by_dim(batch):
                x = unit(rows)
                width = min(x.shape[1], c.shape[1])
                # |c_a - c_b| over the components a vector of that length has.
                if width not in gaps:
                    part = c[:, :width]
                    square = (part * part).sum(axis=1)
                    gaps[width] = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * part @ part.T, 0))
                p = products(x, c)
                own = p.argmax(axis=1)
                home[at] = own
                near = p - p[np.arange(len(own)), own][:, None] >= -reach * gaps[width][own] - 1e-9
                for i, o, row in zip(at, own, near):
                    visits[i] = np.flatnonzero(row[:o]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(visits, pa.list_(pa.int32()))], names=[*batch.schema.names, "home", "visits"]
            )

    return vectors.mapInArrow(task, "vec_id long, copies long, dim int, vector binary, home int, visits array<int>")


def _compare(rules: CellRules):
    def compare(rows: pa.Table) -> pa.Table:
        left = np.array(rows["is_left"].to_pylist(), dtype=bool)
        ids, copies = rows["vec_id"].to_numpy(), rows["copies"].to_numpy()
        x = unit(rows["vector"].to_pylist())
        same = bool(rows["same"][0].as_py())
        a = np.flatnonzero(left)
        b = a if same else np.flatnonzero(~left)
        links = np.zeros(len(ids), dtype=np.int64)
        label = np.arange(len(ids))
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), dtype=np.int64)
        rank[order] = np.arange(len(ids))
        pairs_a, pairs_b = [], []
        for start in range(0, len(a), rules.strip):
            part = a[start : start + rules.strip]
            i, j = np.nonzero(x[part] @ x[b].T >= rules.threshold)
            i, j = part[i], b[j]
            if same:
                i, j = i[i < j], j[i < j]
            links += np.bincount(i, weights=copies[j], minlength=len(ids)).astype(np.int64)
            links += np.bincount(j, weights=copies[i], minlength=len(ids)).astype(np.int64)
            # Each strip's links shrink to one edge per vector before the next strip.
            i, j = _forest(rank[i], rank[j], len(ids))
            pairs_a.append(i)
            pairs_b.append(j)
        i, j = _forest(np.concatenate(pairs_a or [label[:0]]), np.concatenate(pairs_b or [label[:0]]), len(ids))
        some = np.flatnonzero(links)
        return pa.table({
            "vec_id": pa.array(np.concatenate([ids[some], ids[order[i]]]), pa.int64()),
            "links": pa.array(np.concatenate([links[some], np.zeros(len(i), dtype=np.int64)]), pa.int64()),
            "to_id": pa.array([None] * len(some) + ids[order[j]].tolist(), pa.int64()),
        })

    return compare


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most one edge per node that joins the same nodes: to the smallest of its group."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            moved = np.flatnonzero(label != np.arange(n))
            return moved, label[moved]
        label = new


def compared(homes: DataFrame, rules: CellRules) -> DataFrame:
    """vec_id, links (of a pair of blocks), to_id (null, or an edge)."""
    visitors = homes.select("vec_id", "copies", "dim", "vector", F.explode("visits").alias("cell"))
    at_home = homes.select("vec_id", "copies", "dim", "vector", F.col("home").alias("cell"))
    blocks = F.ceil(F.count(F.lit(1)) / rules.block_rows).cast("int")
    n_home = at_home.groupBy("dim", "cell").agg(blocks.alias("home_blocks"))
    n_visit = visitors.groupBy("dim", "cell").agg(blocks.alias("visit_blocks"))
    layout = settle(n_home.join(n_visit, ["dim", "cell"], "left").na.fill(0))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("home_blocks")).cast("int")
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    task = "struct<kind:int,i:int,j:int,is_left:boolean,same:boolean>"

    def struct(kind, i, j, is_left, same):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), is_left.alias("is_left"), same.alias("same")).cast(task)

    true, false = F.lit(True), F.lit(False)
    home_tasks = F.concat(
        F.transform(up_to(F.col("home_blocks")), lambda b: struct(0, F.least(F.col("mine"), b), F.greatest(F.col("mine"), b), F.col("mine") <= b, F.col("mine") == b)),
        F.transform(up_to(F.col("visit_blocks")), lambda b: struct(1, F.col("mine"), b, true, false)),
    )
    visit_tasks = F.transform(up_to(F.col("home_blocks")), lambda b: struct(1, b, F.col("mine"), false, false))
    # Only cells someone is at home in have anything to compare.
    sent = (
        at_home.join(layout, ["dim", "cell"]).withColumn("mine", mine).withColumn("task", F.explode(home_tasks))
        .unionByName(
            visitors.join(layout, ["dim", "cell"])
            .withColumn("mine", F.pmod(F.xxhash64("vec_id"), F.col("visit_blocks")).cast("int"))
            .withColumn("task", F.explode(visit_tasks))
        )
        .select("vec_id", "copies", "vector", "dim", "cell", "task.*")
    )
    return sent.groupBy("dim", "cell", "kind", "i", "j").applyInArrow(_compare(rules), "vec_id long, links long, to_id long")


def near_duplicates(vectors: DataFrame, rules: CellRules = CellRules()) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors` (vec_id, embedding)."""
    usable = settle(packed(vectors))
    alike = settle(usable.groupBy("dim", "vector").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies")).select("vec_id", "copies", "dim", "vector"))
    centres = fit(alike, alike.count(), rules)
    found = settle(compared(settle(placed(alike, centres, rules)), rules))
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    groups = components(found.where("to_id is not null").select(F.col("vec_id").alias("u"), F.col("to_id").alias("v")))
    judged = (
        alike.join(links, "vec_id", "left")
        .join(groups.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("dim", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    )
    linked = usable.join(judged, ["dim", "vector"]).select("vec_id", "n_links", "component_id")
    alone = _plain(vectors).where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
