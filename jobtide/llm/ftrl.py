"""Quality classifier: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

Features are hashed to a fixed number of weights: words, pairs of words, and runs of one to three word shapes
(letters' case, digits, marks, `=` for a word equal to the one before). Each family is scaled to length one by the
square roots of its counts, so long and short texts weigh alike. A score is the logistic of the sparse dot product
with the weights; it looks at the text alone.

Learning uses at most `train_rows` labelled rows, those with the smallest digests of their ids: a bound stated here,
which lets them be found in the documents by a broadcast of that many ids. Examples are dealt to a fixed number of
learners; after each pass their states, of fixed size, are averaged. Scoring reads every text once and shuffles nothing.

Defined cases: null and empty texts have the bias alone and get its score; without any label all scores are 0.5; labels
with a null are ignored, several labels of one document count as their mean; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.llm.common import mix64, settle, unused

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Texts whose features are held at once.
BATCH = 256


@dataclass(frozen=True)
class FtrlRules:
    bits: int = 18
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    passes: int = 3
    learners: int = 4
    train_rows: int = 20_000
    folds: int = 5
    threshold: float = 0.3
    cached_words: int = 400_000


def shape(word: str) -> str:
    if not (word[0].isalnum() or word[0] == "_"):
        return word[0] + ("+" if len(word) > 1 else "")
    if word.isdigit():
        return "0"
    return ("X" if word.isupper() else "Xx" if word[0].isupper() else "x") + ("" if len(word) > 2 else ".")


class Features:
    """Sparse features of texts; hashes of words are remembered up to a number of entries."""

    def __init__(self, rules: FtrlRules):
        self.mask, self.most = np.uint64((1 << rules.bits) - 1), rules.cached_words
        self.known: dict[str, int] = {}
        self.words, self.shapes = array("Q"), array("Q")

    def _learn(self, words: list[str]) -> np.ndarray:
        known = self.known
        for w in words:
            if w not in known:
                known[w] = len(known)
                self.words.append(xxhash.xxh64_intdigest(w.lower()))
                self.shapes.append(xxhash.xxh64_intdigest(shape(w), 1))
        return np.array([known[w] for w in words], dtype=np.int64)

    def _family(self, hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        index, count = np.unique(mix64(np.concatenate(hashes)) & self.mask, return_counts=True)
        value = np.sqrt(count)
        return index, (value / np.sqrt(float((value * value).sum()) or 1.0)).astype(np.float32)

    def of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(self.known) > self.most:
            self.known, self.words, self.shapes = {}, array("Q"), array("Q")
        split = [self._learn(TOKEN.findall(t or "")) for t in texts]
        # Views, gone again before the next words come in.
        words, shapes = (np.frombuffer(a, dtype=np.uint64) for a in (self.words, self.shapes))
        return [self._one(ids, words, shapes) for ids in split]

    def _one(self, ids: np.ndarray, words: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bias = (np.zeros(1, dtype=np.int32), np.ones(1, dtype=np.float32))
        if not len(ids):
            return bias
        w, s = words[ids], shapes[ids].copy()
        s[1:][ids[1:] == ids[:-1]] = np.uint64(7)
        odd = np.uint64(0x9E3779B97F4A7C15)
        pairs = w[:-1] * odd + w[1:]
        shape_pairs = s[:-1] * odd + s[1:]
        triples = shape_pairs[:-1] * odd + s[2:]
        families = [self._family([w]), self._family([s, shape_pairs, triples])]
        if len(pairs):
            families.append(self._family([pairs]))
        index = np.concatenate([bias[0], *[f[0].astype(np.int32) for f in families]])
        return index, np.concatenate([bias[1], *[f[1] for f in families]])


class Ftrl:
    """Per-coordinate FTRL-proximal: z and n are sums over the examples seen, weights follow from them."""

    def __init__(self, rules: FtrlRules, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.rules = rules
        self.z = np.zeros(1 << rules.bits) if z is None else z
        self.n = np.zeros(1 << rules.bits) if n is None else n

    def weights(self, at=slice(None)) -> np.ndarray:
        r, z = self.rules, self.z[at]
        w = -(z - np.sign(z) * r.l1) / ((r.beta + np.sqrt(self.n[at])) / r.alpha + r.l2)
        return np.where(np.abs(z) > r.l1, w, 0.0)

    def learn(self, index: np.ndarray, value: np.ndarray, label: float) -> None:
        # Families may share a slot; such features act as one.
        at, back = np.unique(index, return_inverse=True)
        x = np.bincount(back, weights=value)
        w = self.weights(at)
        g = (logistic(float(w @ x)) - label) * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.rules.alpha * w
        self.n[at] = grown


def logistic(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(x, -35.0), 35.0)))


def training_rows(docs: DataFrame, labels: DataFrame, rules: FtrlRules) -> DataFrame:
    """doc_id, label, index, value of the labelled rows that are learned from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(rules.folds))
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where("doc_id is not null and quality is not null")
        .where(fold != 0)
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rules.train_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(rules)
        for batch in (whole.slice(at, BATCH) for whole in batches for at in range(0, whole.num_rows, BATCH)):
            doc_id, text, label = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "label"))
            found = features.of(text.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [doc_id, label, pa.array([f[0].tobytes() for f in found], pa.binary()), pa.array([f[1].tobytes() for f in found], pa.binary())],
                names=["doc_id", "label", "index", "value"],
            )

    return texts.mapInArrow(task, "doc_id long, label double, index binary, value binary")


def _learner(rules: FtrlRules, z: np.ndarray, n: np.ndarray, turn: int):
    """One pass of one learner over its examples, from a given state."""

    def learn(rows: pa.Table) -> pa.Table:
        state = Ftrl(rules, z.astype(np.float64), n.astype(np.float64))
        ids, labels, index, value = (rows[c].combine_chunks() for c in ("doc_id", "label", "index", "value"))
        turns = [(xxhash.xxh64_intdigest(str(d), turn), d, y) for d, y in zip(ids.to_pylist(), labels.to_pylist())]
        order = sorted(range(len(turns)), key=turns.__getitem__)
        for (_, _, label), alike in groupby(order, key=turns.__getitem__):
            same = list(alike)
            # Only rows alike so far are told apart by their features; the others stay where they lie.
            for i in same if len(same) == 1 else sorted(same, key=lambda i: (index[i].as_py(), value[i].as_py())):
                state.learn(np.frombuffer(index[i].as_buffer(), dtype=np.int32), np.frombuffer(value[i].as_buffer(), dtype=np.float32), label)
        return pa.table({c: pa.array([v.astype(np.float32).tobytes()], pa.binary()) for c, v in (("z", state.z), ("n", state.n))})

    return learn


def train(docs: DataFrame, labels: DataFrame, rules: FtrlRules = FtrlRules()) -> np.ndarray:
    """The weights, one per hash slot."""
    examples = settle(training_rows(docs, labels, rules).withColumn("learner", F.pmod(F.xxhash64("doc_id"), F.lit(rules.learners)).cast("int")))
    z = n = np.zeros(1 << rules.bits)
    for turn in range(rules.passes):
        # One row per learner, of a size fixed by `bits`.
        states = examples.groupBy("learner").applyInArrow(_learner(rules, z, n, turn), "z binary, n binary").collect()
        if states:
            z, n = (np.mean([np.frombuffer(s[c], dtype=np.float32) for s in states], axis=0) for c in ("z", "n"))
    return Ftrl(rules, z.astype(np.float64), n.astype(np.float64)).weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, rules: FtrlRules = FtrlRules()) -> DataFrame:
    """`docs` (any columns, with text) and behind them a score, 0 to 1: quality_score, or the first unused name that begins so."""
    held = docs.sparkSession.sparkContext.broadcast(weights)
    score_name = unused(docs, "quality_score")
    # By place, so that any name will do.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text_at = docs.columns.index("text")
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(rules), held.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found = features.of(part.column(text_at).to_pylist())
                scores = [logistic(float(np.dot(w[i].astype(np.float64), v))) for i, v in found]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, "score"])

    return plain.mapInArrow(task, schema).toDF(*docs.columns, score_name)


