"""Vector codes and benchmark passages against brute force, and on awkward rows."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.llm import multi_search, part_codes, queries
from jobtide.session import local_frame

SF = "/root/testdata/sf0.001"
LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def passages_by_hand(docs, items, width=10):
    windows = {}
    for item, text in items:
        words = LETTER.findall(lower(text))
        for at in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[at : at + width]), set()).add(item)
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        words, hit, found = LETTER.findall(lower(text)), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if (here := windows.get(tuple(words[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found.update(str(i) for i in here if i is not None)
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def digest_of(found):
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    rows = found.select("doc_id", "n_words", n_hit, F.size("items"), F.sha2(F.concat_ws(",", "items"), 256), F.size("spans") > 0)
    return sorted(map(tuple, rows.collect()), key=repr)


def pairs(frame, key):
    return [(r[key], r["text"]) for r in frame.collect()]


def test_passages_of_the_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted(map(tuple, queries.op13_multi_search(spark, SF).collect()), key=repr)
    assert got == passages_by_hand(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert any(r[5] for r in got)


LONG = "alpha beta " * 9000
ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from here"),
    (2, "SOLO"), (3, "two words"), (3, "brown fox"), (4, None), (5, ""), (6, "-- !"), (None, "unnamed item here"),
    (7, "éa ßb " * 6), (7, "alpha beta " * 5), (8, "alpha beta " * 5), (9, "x x x x x x x x x x x x"), (10, "Über den Wolken"),
]
DOCS = [
    (1, "a quick, brown fox jumps over the lazy dog and runs away from here; SOLO!"),
    (1, "a quick, brown fox jumps over the lazy dog and runs away from here; SOLO!"),
    (2, None), (3, ""), (None, "solo"), (4, "Two\nWORDS two two words unnamed item here"), (5, LONG), (6, "x " * 25 + "y" + " x" * 9),
    (7, "ÉA ßB " * 9), (8, "éa ßB " * 9), (9, "über den wolken"), (10, "Über DEN\x00wolken"), (11, "solos so-lo"),
]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_awkward_passages(spark, shard_bytes):
    docs, items = local_frame(spark, DOCS, "doc_id bigint, text string"), local_frame(spark, ITEMS, "item_id bigint, text string")
    for name in ("words", "row_key", "hit_key", "spans", "items", "window", "n_words", "start"):
        docs, items = docs.withColumn(name, F.lit("x")), items.withColumn(name, F.lit(1))
    rules = multi_search.SearchRules(shard_bytes=shard_bytes)
    expected = passages_by_hand(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert digest_of(multi_search.passages(docs, items, rules)) == expected
    assert multi_search.passages(docs.limit(0), items, rules).count() == 0
    assert digest_of(multi_search.passages(docs, items.limit(0), rules)) == passages_by_hand(pairs(docs, "doc_id"), [])


def test_shift_tables_skip():
    tables = multi_search.Tables(10, {tuple(f"w{i}".encode() for i in range(10)): ["1"]})
    assert tables.far == 9 and tables.shift[(b"w0", b"w1")] == 8 and tables.shift[(b"w8", b"w9")] == 0
    words = [b"x"] * 95 + [f"w{i}".encode() for i in range(10)] + [b"x"] * 95
    assert [s for s, _ in tables.occurrences(words)] == [95]


def codes_by_hand(rows, rules=part_codes.CodeRules()):
    """rows: (vec_id, vector, label); codes, errors and books by looking at every entry each time."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in kept), default=0)
    width = max(1, -(-longest // rules.parts))
    ints = [np.array([int(np.floor(float(x) * rules.scale)) for x in v] + [0] * (width * rules.parts - len(v)), dtype=np.int64).reshape(rules.parts, width) for _, v, _ in kept]
    first = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: kept[k][0])[: rules.entries]
    books = np.stack([ints[k] for k in first], axis=1)
    def nearest():
        squares = [((x[:, None, :] - books) ** 2).sum(2) for x in ints]
        return [s.argmin(1) for s in squares], [int(s.min(1).sum()) for s in squares]
    for _ in range(rules.rounds):
        own, _e = nearest()
        new = books.copy()
        for p in range(rules.parts):
            for e in range(books.shape[1]):
                held = [x[p] for x, o in zip(ints, own) if o[p] == e]
                if held:
                    new[p, e] = sum(held) // len(held)
        books = new
    own, errors = nearest()
    per = {}
    for (_, _, label), e in zip(kept, errors):
        per[label] = per.get(label, 0) + e
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in o), e, per[label], digest) for (i, _, label), o, e in zip(kept, own, errors)), key=repr)


def coded(vectors, rules=part_codes.CodeRules()):
    rows, books = part_codes.compress(vectors, rules)
    found = part_codes.with_label_errors(rows).withColumn("books", F.lit(part_codes.book_digest(books)))
    return sorted(map(tuple, found.select("vec_id", "code", "error", "label_error", "books").collect()), key=repr)


def test_codes_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, queries.op12_part_codes(spark, SF).collect()), key=repr) == codes_by_hand(rows)


def random_rows(n, dim, seed=3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(20, dim))
    # Clusters, coarse values for ties, and a third of all rows alike.
    vectors = np.round(centres[random.integers(0, 20, n)] + random.normal(size=(n, dim)) * 0.3, 1)
    vectors[: n // 3] = vectors[0]
    return [(int(i), [float(x) for x in v], int(i) % 4 or None) for i, v in zip(random.permutation(n), vectors)]


AWKWARD = [
    (900001, None, 1), (900002, [None] * 32, 1), (900003, [float("nan")] * 32, 2), (900004, [float("inf")] + [0.0] * 31, 2),
    (900005, [0.0] * 32, None), (900005, [0.0] * 32, None), (None, [-0.001] * 32, 3), (900006, [1.0] * 7, 3), (900007, [], 3), (900008, [-300.0] * 32, None),
]


@pytest.mark.parametrize("near,least", [(8, 2), (1, 1), (63, 2)])
def test_codes_are_those_of_a_full_search(spark, near, least):
    rows = random_rows(3000, 32) + AWKWARD
    frame = local_frame(spark, rows, "vec_id bigint, embedding array<double>, label int")
    for name in ("ints", "state", "code", "error", "of_label", "part", "n"):
        frame = frame.withColumn(name, F.lit("x"))
    assert coded(frame.repartition(5), part_codes.CodeRules(near=near, least=least)) == codes_by_hand(rows)


def test_bounds_spare_most_entries():
    rows = random_rows(4000, 32)
    shape = part_codes.Shape(2, 4000, 16)
    x = np.floor(np.array([v for _, v, _ in rows]) * 256).astype(np.int64).reshape(len(rows), 16, 2)
    books = x[np.linspace(0, 3999, 64).astype(int)].transpose(1, 0, 2)
    state = part_codes.assign_all(x, books, shape, 8)
    assert part_codes.State.of(state.rows(), 16).low.tolist() == state.low.tolist()
    moved = np.zeros(books.shape[:2])
    moved[:, ::3] = np.sqrt(2) * 3
    after = books.copy()
    after[:, ::3] += 3
    new, errors, seen = part_codes.assign_again(x, state, after, moved, shape, 2)
    assert errors.tolist() == [[int(((a - after[p]) ** 2).sum(1).min()) for p, a in enumerate(v)] for v in x]
    assert seen["stood"] > 0.3 * len(x) * 16 and seen["all"] < 0.4 * len(x) * 16


def test_few_and_no_vectors(spark):
    few = [(i, [float(i + j) for j in range(16)], 1) for i in range(3)]
    assert coded(local_frame(spark, few, "vec_id bigint, embedding array<double>, label int")) == codes_by_hand(few)
    none = local_frame(spark, AWKWARD[:4], "vec_id bigint, embedding array<double>, label int")
    assert coded(none) == [] and coded(none.limit(0)) == []
    huge = coded(local_frame(spark, [(1, [1e30] * 16, 1), (2, [-1e30] * 16, 1), (3, [0.0] * 16, 1)], "vec_id bigint, embedding array<double>, label int"))
    assert [r[2] for r in huge] == [0, 0, 0]
