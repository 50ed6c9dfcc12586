"""The corpus operators against brute force on small tables, and on awkward rows."""

import collections
import dataclasses
import resource
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from jobtide.llm import cells, circulant, class_lm, components, doubling, ftrl, host_rules, line_store, mixing, packing, queries, url_ratio
from jobtide.session import local_frame

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars int"
LONG = "word " * 3000
AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, "one", None, None, 3),
    (4, "a line that is long enough\nshort\na line that is long enough", "en", "b", 50),
    (5, "  A LINE that is long enough \nother", "en", "b", 50),
    (5, "  A LINE that is long enough \nother", "en", "b", 50),
    (None, LONG, "en", "b", 15000),
    (7, LONG, "en", None, 15000),
    (8, LONG + "end", "fr", "é", 15003),
    (9, "#$% <|endoftext|> É ß " * 30, "de", "", 600),
]


@pytest.fixture
def awkward(spark):
    # Further columns, with names like those the operators use inside.
    extra = ["key", "words", "size", "bucket", "score", "n", "id"]
    frame = local_frame(spark, AWKWARD, DOCS)
    for name in extra:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.collect()]


def test_mix_meets_targets(spark, documents):
    got = mixing.mix(documents).collect()
    per = collections.defaultdict(list)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        per[r["source"]].append(r)
    for rows in per.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 1
        assert rows[0]["source_size"] == sum(r["size"] for r in rows)
    total = sum(r["size"] for r in got)
    assert abs(sum(rows[0]["target"] for rows in per.values()) - total) < 1
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(documents).collect()))


def test_mix_awkward(awkward):
    got = mixing.mix(awkward).collect()
    assert len(got) == len(AWKWARD)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    out = mixing.mixed_documents(awkward)
    assert out.columns == awkward.columns
    assert sum(len(t.split()) for _, t in texts_of(out)) == sum(r["taken"] for r in got)
    assert mixing.mix(awkward.limit(0)).count() == 0


def lines_by_hand(rows):
    key = lambda line: line.encode().strip(line_store.WHITE).lower()
    holders = collections.defaultdict(set)
    for doc_id, text in rows:
        for line in text.split("\n"):
            if doc_id is not None and len(key(line).decode()) >= 10:
                holders[key(line)].add(doc_id)
    lost = lambda doc_id, line: doc_id is not None and len(holders.get(key(line), ())) >= 2 and min(holders[key(line)]) != doc_id
    return sorted((str(d), "\n".join(x for x in t.split("\n") if not lost(d, x))) for d, t in rows)


def test_lines(documents, awkward):
    for frame in (documents, awkward):
        got = line_store.dedup_lines(frame.select("doc_id", "text"))
        assert sorted((str(d), t) for d, t in texts_of(got)) == lines_by_hand(texts_of(frame))


def test_lines_in_any_number_of_batches(documents, awkward):
    for frame in (documents, awkward):
        plain = frame.select("doc_id", "text")
        whole, parted = (sorted(line_store.dedup_lines(plain, line_store.LineRules(batches=n)).collect(), key=repr) for n in (1, 3))
        assert whole == parted
        store = line_store.LineStore(line_store.LineRules(batches=3, shard_keys=500)).insert_in_batches(plain)
        filters = {r["shard"]: line_store.CuckooFilter.from_bytes(r["filter"]) for r in store.filters.collect()}
        for r in store.keys.collect():
            assert filters[r["hi"] % store.shards].contains(*(np.array([r[c]]).view(np.uint64) for c in ("hi", "lo"))).all()


def test_lines_are_reversible(documents):
    one, two = documents.where("doc_id % 3 <> 0"), documents.where("doc_id % 3 = 0")
    losses = lambda store: sorted((r[0], sorted(map(tuple, r[1]))) for r in store.losses().collect())
    first = line_store.LineStore().insert(one)
    both = first.insert(two)
    assert losses(both) == losses(line_store.LineStore().insert(documents))
    back = both.delete(two.select("doc_id"))
    assert losses(back) == losses(first)
    assert losses(back.insert(two)) == losses(both)


def test_cuckoo_filter():
    draw = np.random.default_rng(1)
    hi, lo = (draw.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    table = line_store.filled(hi[:4000], lo[:4000], 500)
    assert table.contains(hi[:4000], lo[:4000]).all()
    assert table.contains(hi[4000:], lo[4000:]).mean() < 0.01
    table.remove(hi[:2000], lo[:2000])
    assert table.contains(hi[2000:4000], lo[2000:4000]).all()
    assert table.contains(hi[:2000], lo[:2000]).mean() < 0.01


def test_words_as_the_tokenizer_has_them():
    from tokenizers import Tokenizer

    rules = queries.pack_rules()
    texts = ["".join(map(chr, range(k, k + 16))) for k in range(1, 0x400, 16)] + [f"a{chr(c)}B" for c in range(1, 0x400)]
    texts += ["it's I'LL 3½ ΣΑΣ 漢字 🙂 e\u0301 ﬁ ǅ \u212a İstanbul", "<|endoftext|> a<|startoftext|>b", "'s'' ''t", "", " "]
    want = Tokenizer.from_file(rules.vocabulary).encode_batch(texts, add_special_tokens=False)
    words = packing.Words(rules)
    assert [np.frombuffer(ids, words.width).tolist() for ids in words.encode(texts)] == [w.ids + [2] for w in want]


def test_packing(documents, awkward):
    from tokenizers import Tokenizer

    rules = queries.pack_rules()
    tokenizer = Tokenizer.from_file(rules.vocabulary)
    for frame in (documents, awkward):
        want = collections.Counter()
        for doc_id, text in texts_of(frame):
            want[(doc_id, tuple(tokenizer.encode(text, add_special_tokens=False).ids + [2]))] += 1
        pieces = packing.pack(frame, rules).collect()
        seats, total = collections.defaultdict(list), collections.Counter()
        for p in pieces:
            ids = np.frombuffer(p["ids"], dtype="<u4")
            assert len(ids) == p["length"] > 0
            seats[p["sequence_id"]].append((p["offset"], p["length"]))
            total[p["doc_id"]] += p["length"]
        for seat in seats.values():
            end = 0
            for offset, length in sorted(seat):
                assert offset == end
                end += length
            assert end == rules.length or end & (end - 1) == 0 and end < rules.length
        assert total == sum((collections.Counter({d: len(i) * n}) for (d, i), n in want.items()), collections.Counter())
        if frame is documents:
            mine = collections.defaultdict(list)
            for p in pieces:
                mine[p["doc_id"]].append((p["start"], p["ids"]))
            for doc_id, ids in want:
                assert b"".join(b for _, b in sorted(mine[doc_id])) == np.array(ids, dtype="<u4").tobytes()


def repeats_by_hand(rows, length):
    seen = collections.Counter(t[p : p + length] for _, t in rows for p in range(len(t) - length + 1))
    out = []
    for doc_id, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        out.append((str(doc_id), bytes(c for c, g in zip(t, gone) if not g)))
    return sorted(out)


def test_repeats(spark, documents, awkward):
    for frame in (documents.where("doc_id < 60"), awkward):
        rows = [(d, t.encode()) for d, t in texts_of(frame)]
        got = doubling.without_repeats(frame).select("doc_id", "kept").collect()
        assert sorted((str(d), bytes(k)) for d, k in got) == repeats_by_hand(rows, 200)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (None, 3)]
    got = dict(components.components(local_frame(spark, chain, "u bigint, v bigint")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


def near_by_hand(rows, width):
    sets = collections.defaultdict(set)
    for doc_id, text in rows:
        w = text.encode().lower().split()
        sets[doc_id] |= {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    group = {d: d for d in sets}
    while True:
        before = dict(group)
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
        if group == before:
            return group


def test_near_documents(documents, awkward):
    for frame in (documents, awkward.where("doc_id is not null")):
        got = circulant.near_duplicates(frame, circulant.ShingleRules(words=2)).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == near_by_hand(texts_of(frame), 2)
    lone = circulant.near_duplicates(awkward).where("doc_id is null").first()
    assert lone["component_id"] is None and lone["kept"]
    assert circulant.near_duplicates(awkward.limit(0)).count() == 0


def test_star_of_near_copies(spark):
    """Copies like the original alone, which has a middle doc_id: many share only a few bands with it, all of them large."""
    draw = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(201)]
    rows = [(300, " ".join(plain))]
    for k in range(600):
        words, gone = list(plain), 2 * draw.choice(99, 9 + k % 3, replace=False) + 1
        for i in gone:
            words[i] = f"c{k}x{i}"
        rows.append((k if k < 300 else k + 1, " ".join(words)))
    got = circulant.near_duplicates(local_frame(spark, rows, "doc_id bigint, text string"), circulant.ShingleRules(words=2)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_a_block_gives_a_forest():
    rules, n = circulant.ShingleRules(words=2), 200
    same = np.arange(1000, 1100)
    sets = [np.concatenate([same, [i]]) for i in range(n)]
    prints = circulant.signature(same.astype(np.uint64), rules).astype(np.uint8).tobytes()
    rows = pa.table({
        "key": np.full(n, 7), "low": np.zeros(n, dtype=int), "high": np.zeros(n, dtype=int), "mine": np.zeros(n, dtype=int),
        "id": np.arange(n) * 3, "n": np.full(n, 101), "c": np.arange(n) * 3,
        "bands": pa.array([[7, 5]] * n, pa.list_(pa.int64())), "signature": [prints] * n,
        "shingles": pa.array([x.tolist() for x in sets], pa.list_(pa.int64())),
    })
    links = circulant._block_links(rules)(rows).to_pylist()
    assert len(links) == n - 1
    group = list(range(n))
    for link in links:
        u, v = group[link["u"] // 3], group[link["v"] // 3]
        assert u != v
        group = [u if g == v else g for g in group]
    assert len(set(group)) == 1


def test_vectors(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(60, 8))
    near = [(base[i % 20] + draw.normal(size=8) * 0.15).tolist() for i in range(120)]
    rows = [(i, v) for i, v in enumerate(base.tolist() + near)]
    odd = [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] + [1.0] * 7), (904, [1.0, None]), (905, rows[0][1]), (906, [1.0, 2.0]), (None, rows[1][1])]
    got = {r["vec_id"]: r for r in cells.near_duplicates(local_frame(spark, rows + odd, "vec_id bigint, embedding array<double>"), cells.CellRules(cell_rows=12, block_rows=8)).collect()}
    full = [*rows, (905, rows[0][1])]
    x = np.array([v for _, v in full])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.95
    assert {i: got[i]["n_links"] for i, _ in full} == {i: int(close[k].sum()) - 1 for k, (i, _) in enumerate(full)}
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 906, None))


def test_host_figures(documents, awkward):
    for frame in (documents, awkward):
        got = collections.Counter(tuple(r)[:1] + tuple(r)[2:7] for r in host_rules.figures(frame).collect())
        want = collections.Counter()
        for doc_id, text in texts_of(frame):
            w = text.encode().split()
            n = collections.Counter(zip(w, w[1:], w[2:]))
            covered = {k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
            lines = [x for x in text.split("\n") if x.encode().split()]
            want[(doc_id, len(w), sum(len(x.decode()) for x in w), sum(c in host_rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))] += 1
        assert got == want
    assert host_rules.judge(awkward).count() == len(AWKWARD)


def verdicts_by_hand(rows, rules):
    """(doc_id, host, base_failed, fails) to what is kept, hosts judged one by one."""
    hosts = collections.defaultdict(list)
    for _, host, _, fails in rows:
        hosts[host].append(fails)
    rates = {h: sum(x) / len(x) for h, x in hosts.items()}
    m, single = np.mean(list(rates.values())), np.mean([1 / len(x) for x in hosts.values()])
    v = (np.var(list(rates.values()), ddof=1) - m * (1 - m) * single) / (1 - single) if len(rates) > 1 and single < 1 else 0.0
    rejected, suspect = {h: m > rules.host_rate for h in hosts}, dict.fromkeys(hosts, False)
    if v > 1e-12:
        strength = max(0.0, m * (1 - m) / v - 1)
        for h, x in hosts.items():
            rate = (sum(x) + strength * m) / (len(x) + strength)
            rejected[h] = rate > rules.host_rate
            suspect[h] = rate - rules.bound * (rate * (1 - rate) / (len(x) + strength + 1)) ** 0.5 > m
    return {doc_id: not (base or rejected[h] or (suspect[h] and fails)) for doc_id, h, base, fails in rows}


def test_host_verdicts(spark, documents, awkward):
    clean = " ".join(f"word{i}" for i in range(60))
    soft = clean + " #" * 30
    short = "too short"
    rows, number = [], 0
    for host, n_clean, n_soft, n_short in ((None, 90, 5, 5), ("b", 80, 10, 2), ("c", 52, 46, 2), ("d", 30, 60, 20), ("e", 1, 0, 0), ("f", 0, 1, 0), ("g", 20, 2, 0)):
        for text, n in ((clean, n_clean), (soft, n_soft), (short, n_short)):
            for _ in range(n):
                rows.append((number, text, "en", host, 0))
                number += 1
    frame = local_frame(spark, rows, DOCS)
    rules = host_rules.HostRules()
    want = verdicts_by_hand([(d, h, t == short, t != clean) for d, t, _, h, _ in rows], rules)
    got = {r["doc_id"]: r["kept"] for r in host_rules.judge(frame).collect()}
    assert got == want
    by_host = {h: {t: got[d] for d, t, _, g, _ in rows if g == h} for h in (None, "c", "d")}
    # A good host's softer failures stay, a suspect one's go, a rejected one loses clean documents too.
    assert by_host[None] == {clean: True, soft: True, short: False}
    assert by_host["d"] == {clean: False, soft: False, short: False}
    assert by_host["c"] == {clean: True, soft: False, short: False}
    # Only one host, hosts of one document each, no documents: nobody is suspect.
    for part in (frame.where("source = 'b'"), frame.where("source in ('e', 'f')")):
        assert all(r["kept"] for r in host_rules.judge(part).where("not base_failed").collect())
    assert host_rules.judge(frame.limit(0)).count() == 0
    figures = [(r["doc_id"], r["source"], r["base_failed"], r["fails"]) for r in host_rules.figures(documents).collect()]
    assert {r["doc_id"]: r["kept"] for r in host_rules.judge(documents).collect()} == verdicts_by_hand(figures, rules)


def test_urls(spark):
    urls = ["http://www.Example.com/en/1", "http://a.example.com/en/x?q", "https://x.com/de", "http://x.net/es/", "http://net/fr/2", "x.net/es/", None, "", "http://x.com", "http://q.org/a#b"]
    got = {r["page_id"]: r for r in url_ratio.judge_urls(local_frame(spark, list(enumerate(urls)), "page_id bigint, url string")).collect()}
    assert [got[i]["rule"] for i in range(10)] == ["www.example.com/en/", "example.com/en/", "com/", "net/es/", "net/fr/", None, None, None, None, None]
    assert (got[0]["host"], got[0]["path"], got[9]["path"]) == ("www.example.com", "/en/1", "/a")
    assert all(got[i]["verdict"] in ("allow", "block") for i in range(10))


def test_class_lm(spark, documents, awkward):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    got = class_lm.score_documents(documents, held).collect()
    rows = [(d, [*t.encode().lower().split(), b""]) for d, t in texts_of(documents)]
    c = collections.Counter(w for d, ws in rows if zlib.crc32(str(d).encode()) % 10 for w in ws)
    total = sum(c.values())
    want = {d: sum(np.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in ws) for d, ws in rows}
    for r in got:
        assert r["base_score"] == pytest.approx(want[r["doc_id"]]) and r["train_tokens"] == total
    out = [r for r in got if r["held_out"]]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert class_lm.score_documents(awkward, held).count() == len(AWKWARD)


def test_units_grow_with_the_corpus(spark):
    """30 words in turn with 30 others, each too rare a share of a corpus of fillers: they come to two classes by what is beside them."""
    draw = np.random.default_rng(8)
    one, two = [f"p{chr(97 + i % 26)}{i}xxx" for i in range(30)], [f"q{chr(97 + i % 26)}{i}xxx" for i in range(30)]
    text = " ".join(w for _ in range(900) for w in ("left", draw.choice(one), "right", draw.choice(two), *["fill"] * 46))
    docs = local_frame(spark, [(i, text) for i in range(2)], "doc_id bigint, text string")
    rules = class_lm.LmRules(classes=6)
    held = class_lm.settle(class_lm.chunks(docs, F.lit(False), rules))
    word = Window.partitionBy("word")
    lists = class_lm.word_lists(held).withColumn("c", F.sum("n").over(word)).withColumn("is_first", F.row_number().over(word.orderBy("chunk")) == 1)
    vocabulary = lists.where("is_first").select("word", "c")
    total = vocabulary.agg(F.sum("c")).first()[0]
    assert class_lm.representatives(vocabulary, total, rules).size < 8
    texts, model = class_lm.fit(held, lists, rules)
    row = texts.first()
    unpack = class_lm.zstandard.ZstdDecompressor().decompress
    units = np.frombuffer(unpack(row["units"]), dtype=np.int32)
    found = dict(zip(unpack(held.first()["words"]).decode().split(" "), model.of[units].tolist()))
    assert len(set(units.tolist())) == 64
    assert len({found[w] for w in one}) == len({found[w] for w in two}) == 1 and found[one[0]] != found[two[0]]


def test_packing_lets_go_of_words_when_it_fills_sequences(spark):
    rules = dataclasses.replace(queries.pack_rules(), kept_words=10)
    docs = local_frame(spark, [(i, " ".join(f"w{i}x{k}" for k in range(50))) for i in range(64)], "doc_id bigint, text string")

    def kept(batches):
        # Tokenizes as a stage before has done, and fills as the last stage does.
        words = packing.words_of(rules)
        met = len(words.encode([f"a{k} b{k}" for k in range(50)])) and len(words)
        words.release(rules.kept_words)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([met]), pa.array([len(words) + len(words.pieces)])], names=["met", "n"])

    found = spark.range(0, 8, 1, 2).mapInArrow(kept, "met long, n long").collect()
    assert all(r["met"] >= 100 and r["n"] == 0 for r in found) and packing.pack(docs, rules).count() >= 1


def test_counts_beside_units_need_little_memory():
    rng, k, size, n, tokens = np.random.default_rng(1), 48, 256, 60_000, 400_000
    units, of = np.arange(n, dtype=np.int32), rng.integers(0, k, n).astype(np.uint8)
    ids, trains = rng.integers(0, n, tokens).astype(np.int32), rng.random(tokens) < 0.8
    held = {}
    tracemalloc.start()
    class_lm.add_counts(held, units, ids, trains, of, k, size)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.concatenate([held[b] for b in sorted(held)])[:n]
    before = np.concatenate([[class_lm.STOP], ids[:-1]])
    want = np.zeros((n, 2 * k + 1), dtype=np.int64)
    np.add.at(want, (ids[trains], of[before[trains]]), 1)
    np.add.at(want, (before[trains], k + of[ids[trains]].astype(int)), 1)
    np.add.at(want, (ids[trains & (ids == before)], 2 * k), 1)
    assert (got == want).all()
    # Half of what the counts of all units at once would take twice over in 64 bits.
    assert peak < want.nbytes


def test_counts_of_units_far_apart_grow_with_the_text(spark):
    """20,000 words, each the only unit met of its block: tasks that put whole blocks together take 2 GB here."""
    n, k, rules = 20_000, 48, class_lm.LmRules()
    units = np.concatenate([[class_lm.STOP], np.arange(1, n) * rules.block]).astype(np.int32)
    ids, of = np.arange(n, dtype=np.int32)[::-1], (np.arange(n * rules.block) % k).astype(np.uint8)
    row = [[False], [n], class_lm.pack(ids), class_lm.zstandard.ZstdCompressor().compress(units.tobytes())]
    texts = class_lm.settle(local_frame(spark, [row], "held array<boolean>, tokens array<int>, ids binary, units binary"))
    found = class_lm.beside(texts, of, k, rules)
    got = {}
    for block, counts in found.collect():
        dense = np.frombuffer(class_lm.zstandard.ZstdDecompressor().decompress(counts), dtype=np.int64).reshape(-1, 2 * k + 1)
        got |= {(block * rules.block + int(u), int(c)): int(dense[u, c]) for u, c in zip(*dense.nonzero())}
    now = units[ids]
    before = np.concatenate([[class_lm.STOP], now[:-1]])
    want = collections.Counter((int(u), int(of[b])) for u, b in zip(now, before)) + collections.Counter((int(b), k + int(of[u])) for u, b in zip(now, before))
    assert got == want

    def peak(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([resource.getrusage(resource.RUSAGE_SELF).ru_maxrss])], names=["kb"]) for _ in batches)

    assert max(r[0] for r in spark.range(0, 64, 1, 16).mapInArrow(peak, "kb long").collect()) < 1 << 20


def test_chunks_hold_texts_in_few_bytes(spark, documents):
    rules = class_lm.LmRules(chunk_bytes=100_000)
    rows = class_lm.chunks(documents.coalesce(1), F.col("doc_id") % 10 == 0, rules).collect()
    pairs = [(r, class_lm.Chunk.of(r["ids"], r["words"], r["tokens"], r["held"])) for r in rows]
    words = {d: [] for r in rows for d in r["doc_ids"]}
    for r, c in pairs:
        ends = np.cumsum(c.tokens)
        for d, lo, hi in zip(r["doc_ids"], ends - c.tokens, ends):
            words[d] = [c.words[i] for i in c.ids[lo:hi]]
        assert len(set(c.words)) == len(c.words) and r["held"] == [d % 10 == 0 for d in r["doc_ids"]]
    assert len(rows) > 1 and words == {d: [*t.encode().lower().split(), b""] for d, t in texts_of(documents)}
    plain = sum(len(class_lm.zstandard.ZstdCompressor(3).compress(c.ids.tobytes())) for _, c in pairs)
    assert sum(len(r["ids"]) for r in rows) < 0.95 * plain


def test_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = ftrl.FtrlRules()
    weights = ftrl.train(docs, labels, rules)
    scored = ftrl.score(docs, weights, rules).join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    rows = [(r["quality_score"], r["quality"]) for r in scored.collect()]
    good, bad = [s for s, q in rows if q == 1], [s for s, q in rows if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.8
    empty = ftrl.train(docs, labels.limit(0), rules)
    assert {r[0] for r in ftrl.score(docs, empty, rules).select("quality_score").collect()} == {0.5}


#: Names used inside the stages beside the columns of documents, and some that Spark could take apart.
INNER = [
    "quality_score", "lost_id", "lost_keys", "line_text", "line_lost", "text_before", "n_lines", "n_dropped", "lost", "kept_id", "rows", "kept", "row", "own_id",
    "of_id", "digest", "other", "part", "tie", "p_doc_id", "p_source", "p_tie", "p_hash", "p_size", "p_taken", "p_rows", "size", "draw", "range", "taken", "bucket",
    "ids", "label", "learner", "index", "value", "hi", "lo", "component_id", "a.b", "QUALITY_SCORE_",
]


@pytest.fixture
def crowded(awkward):
    for name in INNER:
        if name not in awkward.columns:
            awkward = awkward.withColumn(name, F.lit(f"mine {name}"))
    return awkward


def test_stages_leave_further_columns_alone(spark, crowded):
    import corpus_pipeline

    names = [n for n in INNER if n not in ("size", "bucket")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, crowded, SF)
        assert out.columns == crowded.columns, name
        assert out.schema == crowded.schema or [f.dataType for f in out.schema] == [f.dataType for f in crowded.schema]
        for row in out.select([f"`{n}`" for n in names]).distinct().collect():
            assert [row[n] for n in names] == [f"mine {n}" for n in names], name
    assert corpus_pipeline.STAGES[-1][1](spark, crowded, SF).count() >= crowded.count()
    scored = ftrl.score(crowded, np.zeros(1 << ftrl.FtrlRules().bits, dtype=np.float32))
    assert scored.columns[:-1] == crowded.columns and scored.columns[-1].startswith("quality_score_")
    assert {r[0] for r in scored.select(scored.columns[-1]).collect()} == {0.5}
    cut = line_store.dedup_lines(crowded)
    assert set(crowded.columns) < set(cut.columns) and len(cut.columns) == len(crowded.columns) + 2


def test_near_copies_lose_no_text(spark):
    import corpus_pipeline

    base = [f"w{i}" for i in range(120)]
    near = base[:119] + ["changed"]
    other, third, fourth = ([f"{c}{i}" for i in range(60)] for c in "xyz")
    rows = [
        (1, " ".join(base), "en", "a", 1), (1, " ".join(other), "en", "a", 2), (2, " ".join(third), "en", "b", 3),
        (2, " ".join(near), "en", "b", 4), (3, " ".join(other), "en", "c", 5), (4, " ".join(fourth), "en", "c", 6),
        (4, " ".join(fourth), "en", "d", 7), (None, " ".join(base), "en", "d", 8), (5, None, "en", "d", 9), (5, "", "en", "d", 10), (6, None, "en", "d", 9),
    ]
    docs = local_frame(spark, rows, DOCS)
    of = lambda frame: sorted(map(str, frame.select("doc_id", "text", "n_chars").collect()))
    got = corpus_pipeline.near_copies(spark, docs, SF)
    texts = sorted((str(d), t) for d, t in ((r["doc_id"], r["text"]) for r in got.collect()) if t)
    assert texts == sorted([("1", rows[0][1]), ("1", rows[1][1]), ("2", rows[2][1]), ("4", rows[5][1]), ("None", rows[7][1])])
    assert got.where("text is null").count() == 2 and got.where("text = ''").count() == 1
    assert of(got) == of(corpus_pipeline.near_copies(spark, docs.repartition(7), SF))
    assert corpus_pipeline.near_copies(spark, docs.limit(0), SF).count() == 0


def test_pipeline_stages_on_empty_tables(spark, awkward):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward.limit(0), SF).count() == 0, name


def test_pipeline_on_awkward_rows(spark, awkward):
    import corpus_pipeline

    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == awkward.columns
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.count() >= docs.count()
