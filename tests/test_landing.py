"""Run folders on disk: reading, accounting, upsert, replacement, pruning, streaming."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from jobtide.checks.publishing import PAGE_EVENTS, _paged
from jobtide.plans.daily import daily_build
from jobtide.plans.load import load_runs
from jobtide.plans.model_checks import require_clean
from jobtide.plans.staging import flatten_runs
from jobtide.sources import landing, seeds, tables
from jobtide.sources.schemas import RAW_TABLES
from jobtide.sources.tables import RawTable, prune, read_table, replace_run, stamped, upsert, upsert_latest
from jobtide.sources.texts import TextStore
from jobtide.streaming.incremental import land_new_files
from sample_runs import DAY, DETAILS, LISTINGS, OFFERS


def write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        json.dump(body, handle, ensure_ascii=False, indent=2)


def page(term, key, *postings):
    return {"search_term": term, "results_key": key, "payload": {key: list(postings), "maxErgebnisse": 9}}


@pytest.fixture()
def raw(tmp_path):
    root = str(tmp_path / "raw")
    first, second = f"{root}/arbeitsagentur/2026-09-11", f"{root}/arbeitsagentur/2026-09-12"
    write(f"{first}/page_0001.json", page("data", "stellenangebote", {"refnr": "a", "v": 1}, {"refnr": "b", "v": 1}))
    write(f"{first}/page_0002.json", page("bi", "stellenangebote", {"hashId": "a", "v": 2}, {"v": 3}, {"referenznummer": "", "refnr": "c"}))
    write(f"{first}/details/YQ.json", {"id": "a", "payload": {"stellenangebotsBeschreibung": "x\ny"}})
    write(f"{first}/_manifest.json", {"source": "arbeitsagentur", "results_key": "stellenangebote", "max_pages": 2, "per_term": {"data": 2}})
    write(f"{second}/page_0001.json", page("data", "ergebnisliste", {"referenznummer": "a", "v": 5}))
    write(f"{second}/page_0002.json", {"search_term": "x", "results_key": "neu", "payload": {"neu": [{"refnr": "n"}]}})
    write(f"{second}/page_0003.json", {"search_term": "x", "results_key": "neu", "payload": {"neu": None}})
    write(f"{root}/arbeitnow/2026-09-12/page_0001.json", {"data": [{"slug": "s1", "t": "ü"}, {"slug": ""}, {"t": 1}, {"slug": "s1", "t": "z"}]})
    return root


def test_pages_become_rows(spark, raw):
    pages = landing.read_run_files(spark, raw, "arbeitsagentur", "page_*.json")
    read = landing.enveloped_rows(pages)
    found = {(str(r["run_date"]), r["source_id"], r["search_term"], json.loads(r["payload"]).get("v")) for r in read.collect()}
    assert found == {
        ("2026-09-11", "a", "data", 1), ("2026-09-11", "b", "data", 1), ("2026-09-11", "a", "bi", 2),
        ("2026-09-11", "c", "bi", None), ("2026-09-12", "a", "data", 5), ("2026-09-12", "n", "x", None),
    }
    kept = landing.collapse(read)
    assert sorted((str(r["run_date"]), r["source_id"], json.loads(r["payload"]).get("v") or 0) for r in kept.collect()) == [
        ("2026-09-11", "a", 2), ("2026-09-11", "b", 1), ("2026-09-11", "c", 0), ("2026-09-12", "a", 5), ("2026-09-12", "n", 0),
    ]
    only = landing.read_run_files(spark, raw, "arbeitsagentur", "page_*.json", "2026-09-12")
    assert only.count() == 3


def test_board_details_runs(spark, raw):
    board = landing.plain_rows(landing.read_run_files(spark, raw, "arbeitnow", "page_*.json"))
    assert board.count() == 2
    assert [json.loads(r["payload"])["t"] for r in landing.collapse(board).collect()] == ["z"]
    details = landing.detail_rows(landing.read_run_files(spark, raw, "arbeitsagentur", "details/*.json")).collect()
    assert [(r["source"], str(r["run_date"]), r["source_id"]) for r in details] == [("arbeitsagentur", "2026-09-11", "a")]
    assert json.loads(details[0]["payload"]) == {"stellenangebotsBeschreibung": "x\ny"}
    runs = landing.list_runs(spark, raw)
    assert [(r[0], str(r[1])) for r in runs.collect()] == [
        ("arbeitnow", "2026-09-12"), ("arbeitsagentur", "2026-09-11"), ("arbeitsagentur", "2026-09-12"),
    ]
    assert landing.read_run_files(spark, raw, "nobody", "page_*.json").isEmpty()
    # A run is its folder, also with a manifest and nothing else; other folders are none.
    write(f"{raw}/other/2026-09-13/_manifest.json", {})
    write(f"{raw}/other/notes/page_0001.json", {})
    assert [(r[0], str(r[1])) for r in landing.list_runs(spark, raw).collect()][-1] == ("other", "2026-09-13")
    assert [r[0] for r in landing.list_runs(spark, raw, "2026-09-13").collect()] == ["other"]


def test_manifest_carries_the_counts(spark, raw):
    read = landing.enveloped_rows(landing.read_run_files(spark, raw, "arbeitsagentur", "page_*.json"))
    manifests = landing.read_manifests(spark, raw)
    merged = landing.load_manifests(manifests, landing.run_accounting(read))
    assert json.loads(merged.first()["manifest"]) == {
        "source": "arbeitsagentur", "results_key": "stellenangebote", "max_pages": 2, "per_term": {"data": 2},
        "rows_read": 4, "duplicates_collapsed": 1,
    }
    assert tuple(flatten_runs(merged).first())[2:] == (4, 1, "stellenangebote")
    for odd in ('{"rows_read": "3"}', '{"rows_read": 3.5}', '{"rows_read": {"x": 1}}', '{"rows_read": null}', "[1]", "{", None):
        counted = landing.load_manifests(manifests.withColumn("document", F.lit(odd)), landing.run_accounting(read))
        assert json.loads(counted.first()["manifest"]) == {"rows_read": 4, "duplicates_collapsed": 1}
    empty = manifests.withColumn("document", F.lit("{}"))
    assert json.loads(landing.load_manifests(empty, landing.run_accounting(read)).first()["manifest"])["rows_read"] == 4


def test_truncated_terms(spark):
    body = lambda n, total: json.dumps({"payload": {"ergebnisliste": [{}] * n, "maxErgebnisse": total}})
    pages = spark.createDataFrame(
        [("cut", 1, body(3, 9)), ("cut", 2, body(3, 8)), ("short", 1, body(1, 5)), ("full", 1, body(3, 6)), ("full", 2, body(3, 6))],
        "search_term string, page int, document string",
    )
    assert [tuple(r) for r in landing.truncated_terms(pages, 2).collect()] == [("cut", 6, 8, 2)]


def board_rows(spark, *items):
    return spark.createDataFrame(list(items), "source_id string, run_date string, payload string").withColumn(
        "run_date", F.col("run_date").cast("date")
    )


def content(spark, table):
    return sorted((r["source_id"], str(r["run_date"]), r["payload"]) for r in read_table(spark, table).collect())


def test_upsert_replay_replace_and_prune(spark, tmp_path):
    table = RawTable.at(str(tmp_path / "raw"), "board")
    staging = str(tmp_path / "staging")
    first = board_rows(spark, ("a", "2026-09-01", "1"), ("b", "2026-09-01", "1"), ("a", "2026-09-02", "1"))
    upsert(table, first, staging)
    once = content(spark, table)
    upsert(table, first, staging)
    assert content(spark, table) == once and len(once) == 3
    upsert(table, board_rows(spark, ("b", "2026-09-01", "2"), ("c", "2026-09-01", "2")), staging)
    assert content(spark, table) == [
        ("a", "2026-09-01", "1"), ("a", "2026-09-02", "1"), ("b", "2026-09-01", "2"), ("c", "2026-09-01", "2"),
    ]
    upsert(table, first.limit(0), staging)
    assert len(content(spark, table)) == 4
    replace_run(table, board_rows(spark, ("z", "2026-09-02", "3")), run_date="2026-09-02")
    assert [r for r in content(spark, table) if r[1] == "2026-09-02"] == [("z", "2026-09-02", "3")]
    replace_run(table, first.limit(0), run_date="2026-09-02")
    assert {r[1] for r in content(spark, table)} == {"2026-09-01"}
    upsert(table, board_rows(spark, ("n", "2026-09-30", "4")), staging)
    gone = prune(spark, [table], "2026-10-02", 30)
    assert [(str(r["run_date"]), r["rows"]) for r in gone.collect()] == [("2026-09-01", 3)]
    assert content(spark, table) == [("n", "2026-09-30", "4")]


def test_interrupted_upsert_can_be_repeated(spark, tmp_path, monkeypatch):
    table, staging = RawTable.at(str(tmp_path / "raw"), "board"), str(tmp_path / "staging")
    upsert(table, board_rows(spark, ("a", "2026-09-01", "1"), ("b", "2026-09-01", "1")), staging)
    before = content(spark, table)
    newer = board_rows(spark, ("b", "2026-09-01", "2"), ("c", "2026-09-02", "2"))

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_write_partitions", lost)
        with pytest.raises(RuntimeError):
            upsert(table, newer, staging)
    assert content(spark, table) == before
    upsert(table, newer, staging)
    assert content(spark, table) == [("a", "2026-09-01", "1"), ("b", "2026-09-01", "2"), ("c", "2026-09-02", "2")]


def test_runs_table_is_replaced_per_source(spark, tmp_path):
    table = RawTable.at(str(tmp_path / "raw"), "runs")
    frame = spark.createDataFrame([("x", "2026-09-01", "{}"), ("y", "2026-09-01", "{}")], "source string, run_date string, manifest string")
    upsert(table, frame.withColumn("run_date", F.col("run_date").cast("date")), str(tmp_path / "staging"))
    replace_run(table, frame.withColumn("run_date", F.col("run_date").cast("date")).limit(0), source="x", run_date="2026-09-01")
    assert [r["source"] for r in read_table(spark, table).collect()] == ["y"]


def test_new_files_land_once(spark, raw, tmp_path):
    table = RawTable.at(str(tmp_path / "tables"), "board")
    land = lambda: land_new_files(
        spark, f"{raw}/arbeitnow/*/page_*.json", table, landing.plain_rows, str(tmp_path / "seen"), str(tmp_path / "staging")
    )
    land()
    assert [(r[0], json.loads(r[2])["t"]) for r in content(spark, table)] == [("s1", "z")]
    write(f"{raw}/arbeitnow/2026-09-13/page_0001.json", {"data": [{"slug": "s1", "t": "new"}]})
    land()
    land()
    assert [(r[0], r[1], json.loads(r[2])["t"]) for r in content(spark, table)] == [
        ("s1", "2026-09-12", "z"), ("s1", "2026-09-13", "new"),
    ]


def test_files_in_the_wrong_order_land_like_one_batch(spark, tmp_path):
    raw, table = str(tmp_path / "raw"), RawTable.at(str(tmp_path / "tables"), "board")
    folder = f"{raw}/arbeitnow/2026-09-12"
    pages = {
        "0003": [{"slug": "b", "t": 3}, {"slug": "d", "t": 3}],
        "0001": [{"slug": "a", "t": 1}, {"slug": "b", "t": 1}, {"slug": "b", "t": 1.5}],
        "0002": [{"slug": "a", "t": 2}, {"slug": "b", "t": 2}, {"slug": "c", "t": 2}],
    }
    for number, data in pages.items():
        write(f"{folder}/page_{number}.json", {"data": data})
        land_new_files(
            spark, f"{raw}/arbeitnow/*/page_*.json", table, landing.plain_rows, str(tmp_path / "seen"), str(tmp_path / "staging")
        )
    batch = landing.collapse(landing.plain_rows(landing.read_run_files(spark, raw, "arbeitnow", "page_*.json")))
    assert content(spark, table) == sorted((r["source_id"], str(r["run_date"]), r["payload"]) for r in batch.collect())
    assert [json.loads(r[2])["t"] for r in content(spark, table)] == [2, 3, 2, 3]


def test_upsert_by_place(spark, tmp_path, monkeypatch):
    table, staging = RawTable.at(str(tmp_path / "raw"), "board"), str(tmp_path / "staging")
    schema = "source_id string, run_date string, payload string, place int"
    placed = lambda *items: spark.createDataFrame(list(items), schema).withColumn("run_date", F.col("run_date").cast("date"))
    early, late = placed(("a", "2026-09-01", "early", 1), ("b", "2026-09-01", "only", 1)), placed(("a", "2026-09-01", "late", 2))
    upsert_latest(table, late, ["place"], staging)
    upsert_latest(table, early.limit(0), ["place"], staging)
    # Rows are written, then the executor that writes their places is lost; the batch is repeated.
    real = tables.upsert

    def half(target, rows, folder):
        if target.path.endswith(tables.PLACES):
            raise RuntimeError("executor lost")
        real(target, rows, folder)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "upsert", half)
        with pytest.raises(RuntimeError):
            upsert_latest(table, early, ["place"], staging)
    expected = [("a", "2026-09-01", "late"), ("b", "2026-09-01", "only")]
    assert content(spark, table) == expected
    upsert_latest(table, early, ["place"], staging)
    upsert_latest(table, late, ["place"], staging)
    assert content(spark, table) == expected
    # A run that is replaced or pruned forgets its places.
    replace_run(table, board_rows(spark, ("a", "2026-09-01", "replaced")), run_date="2026-09-01")
    upsert_latest(table, early, ["place"], staging)
    assert content(spark, table) == [("a", "2026-09-01", "early"), ("b", "2026-09-01", "only")]
    prune(spark, [table], "2026-12-01", 30)
    assert content(spark, table) == [] and not [n for n in os.listdir(table.path + tables.PLACES) if "=" in n]


def test_a_page_is_read_once_and_not_per_element(spark):
    document = json.dumps({"search_term": "t", "payload": {"ergebnisliste": [{"refnr": "a"}, {"refnr": "b"}]}})
    rows = landing.enveloped_rows(spark.createDataFrame([("f", document)], "file string, document string"))
    assert [tuple(r) for r in rows.orderBy("position").collect()] == [("f", "t", 0, '{"refnr":"a"}', "a"), ("f", "t", 1, '{"refnr":"b"}', "b")]
    plan = rows._jdf.queryExecution().sparkPlan().toString().splitlines()
    exploded = [line for line in plan if "Generate posexplode" in line]
    # The whole page would come along with each of its elements, to be parsed again.
    assert len(exploded) == 1 and "document#" not in exploded[0]


def test_a_text_far_from_its_copy_costs_little(spark):
    """Landed rows repeat a text every day; what lies between its copies must not keep them from being written as one."""
    texts = [random.Random(i).randbytes(40_000).hex() for i in range(4)]
    listed = spark.createDataFrame([(f"{day}{text}",) for day in range(6) for text in texts], "description string").coalesce(1)
    store = TextStore.scratch(spark)
    store.add(listed)
    sizes = [os.path.getsize(f"{folder}/{name}") for folder, _, names in os.walk(store.path.removeprefix("file:")) for name in names if name.endswith(".parquet")]
    assert store.read().count() == 24 and sum(sizes) < 24 * 80_000 / 2


def test_pages_are_filled_within_a_run(spark):
    events = spark.range(200).select((F.col("id") * PAGE_EVENTS).alias("event_id"), F.lit(1).alias("user_id"), F.lit(True).alias("federal"), F.lit(DAY).cast("date").alias("run_date"))
    assert [tuple(r) for r in _paged(events).groupBy("page").count().collect()] == [(0, 200)]


def test_load_runs(spark, raw, tmp_path):
    home = str(tmp_path / "tables")
    load = lambda **more: load_runs(spark, raw, home, "arbeitsagentur", "arbeitnow", **more)
    held = lambda name: sorted((r[RAW_TABLES[name][1][0]], str(r["run_date"])) for r in read_table(spark, RawTable.at(home, name)).collect())
    assert load().count() == 0
    before = {name: held(name) for name in RAW_TABLES}
    assert before == {
        "listings": [("a", "2026-09-11"), ("a", "2026-09-12"), ("b", "2026-09-11"), ("c", "2026-09-11"), ("n", "2026-09-12")],
        "details": [("a", "2026-09-11")],
        "board": [("s1", "2026-09-12")],
        "runs": [("arbeitsagentur", "2026-09-11")],
    }
    manifest = json.loads(read_table(spark, RawTable.at(home, "runs")).first()["manifest"])
    assert (manifest["rows_read"], manifest["duplicates_collapsed"], manifest["max_pages"]) == (4, 1, 2)
    load(run_date="2026-09-12")
    assert {name: held(name) for name in RAW_TABLES} == before
    gone = load(run_date="2026-09-12", today="2026-10-12", retain_days=30).collect()
    assert sorted((r["table"].rsplit("/", 1)[1], str(r["run_date"]), r["rows"]) for r in gone) == [
        ("details", "2026-09-11", 1), ("listings", "2026-09-11", 3), ("runs", "2026-09-11", 1),
    ]
    assert held("listings") == [("a", "2026-09-12"), ("n", "2026-09-12")] and held("runs") == []


def test_daily_build_from_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    listed = [{"refnr": k, **v} for k, v in LISTINGS.items()]
    write(f"{root}/arbeitsagentur/{DAY}/page_0001.json", page("data engineer", "ergebnisliste", *listed[:6]))
    write(f"{root}/arbeitsagentur/{DAY}/page_0002.json", page("data engineer", "ergebnisliste", *listed[5:]))
    write(f"{root}/arbeitsagentur/{DAY}/_manifest.json", {"results_key": "ergebnisliste"})
    for key, body in DETAILS.items():
        write(f"{root}/arbeitsagentur/{DAY}/details/{key}.json", {"id": key, "payload": body})
    write(f"{root}/arbeitnow/{DAY}/page_0001.json", {"data": [{"slug": k, **v} for k, v in OFFERS.items()]})

    files = lambda source, name: landing.read_run_files(spark, root, source, name)
    listings = landing.enveloped_rows(files("arbeitsagentur", "page_*.json"))
    raw = {
        "listings": landing.collapse(listings),
        "details": landing.collapse(landing.detail_rows(files("arbeitsagentur", "details/*.json"))),
        "board": landing.collapse(landing.plain_rows(files("arbeitnow", "page_*.json"))),
        "runs": landing.load_manifests(landing.read_manifests(spark, root, DAY), landing.run_accounting(listings)),
    }
    tables = daily_build(raw, seeds.skills(spark), seeds.city_aliases(spark), str(tmp_path / "warehouse"))
    funnel = {r["stage"]: r["records"] for r in tables["mart_pipeline_funnel"].collect()}
    # Twelve federal rows were read, one of them twice; the board has no manifest and counts its own.
    assert funnel["rows_read"] == 20 and funnel["distinct_postings"] == 19 and funnel["with_description"] == 7
    assert tables["mart_skill_frequency"].count() == 15
    assert stamped(raw["board"]).columns[-1] == "loaded_at"
    assert rows(tables["mart_language_requirement"])[0]["postings"] == 7


def test_violations_stop_a_build(spark):
    clean = spark.createDataFrame([("not_null", "t", "c", 0)], "check string, table_name string, column_name string, violations long")
    require_clean(clean)
    with pytest.raises(ValueError, match="not_null on t.c: 2"):
        require_clean(clean.withColumn("violations", F.lit(2)))
