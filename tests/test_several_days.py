"""Several runs: reappearing postings, stale ones, missing manifests, half-euro medians, nulls."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from jobtide.params import Params
from jobtide.plans import marts, reporting
from jobtide.plans.daily import publish
from jobtide.plans.places import with_verdicts
from jobtide.plans.postings import SCORED_COLUMNS, published, published_postings
from jobtide.session import local_frame
from jobtide.sources import one_file, seeds, snapshots
from sample_runs import ENGLISH, GERMAN, build, listing, offer, place

D1, D2, D3 = "2026-09-01", "2026-09-10", "2026-09-12"
BERLIN = place("Berlin", "Berlin")


def paid(title, employer, low, high=None, where=BERLIN, **more):
    return listing(title, employer, where, gehaltsspanneVon=low, gehaltsspanneBis=high or "", **more)


LISTINGS = [
    ("stale", D1, listing("Data Engineer", "A", BERLIN)),
    ("back", D1, listing("Data Analyst", "B", BERLIN)),
    ("back", D3, listing("Data Analyst", "B", BERLIN)),
    ("moved", D2, listing("Data Architect", "C", place("Wien", "Wien", "OESTERREICH"))),
    ("moved", D1, listing("Data Architect", "C", BERLIN)),
    ("renamed", D2, listing("Data Scientist", "D", BERLIN)),
    ("renamed", D3, listing("Gärtner", "D", BERLIN)),
    ("noname", D3, listing("Data Steward", None, BERLIN)),
    ("noname2", D3, listing("DATA STEWARD", None, place("Frankfurt am Main", "Hessen"))),
    ("notitle", D3, listing(None, "E", BERLIN)),
    ("s1", D3, paid("Data Engineer I", "F", "50000", "70000.50")),
    ("s2", D3, paid("Data Engineer II", "F", "60001.00")),
    ("s3", D3, paid("Data Engineer III", "F", "60002.00", "90000")),
    ("s4", D3, paid("Data Engineer IV", "F", "70000", "60000.50")),
    ("tiny", D3, paid("Data Engineer V", "F", "19999.99", "99999", place("Frankfurt", "Hessen"))),
    ("null-region", D3, listing("Data Engineer VI", "G", place("St. Augustin", None))),
]
DETAILS = [
    ("s1", D1, {"stellenangebotsBeschreibung": "old"}),
    ("s1", D2, {"stellenangebotsBeschreibung": ENGLISH}),
    *[(k, D3, {"stellenangebotsBeschreibung": ENGLISH}) for k in ("s2", "s3", "s4")],
    ("back", D1, {"stellenangebotsBeschreibung": GERMAN}),
]
OFFERS = [
    ("o1", D1, offer("Data Engineer", "X", "Frankfurt am Main", True)),
    ("o1", D3, offer("Data Engineer", "X", "Frankfurt am Main, Hessen", True)),
    ("o2", D3, offer("BI Engineer", "Y", None, False)),
    ("o3", D3, offer("Data Analyst", "b", "Berlin", False)),
    ("o4", D3, offer("Data Nerd", "Z", "St. Augustin / Berlin", False)),
    ("o5", D3, offer("Data Fan", "Z", "Munich, München", False)),
    ("o6", D3, offer("Data Hero", "Z", "Frankfurt, USA", False)),
]
MANIFESTS = [("arbeitsagentur", D1, 10), ("arbeitsagentur", D3, 20), ("arbeitnow", D1, 4)]


@pytest.fixture(scope="module")
def models(spark):
    built = build(spark, LISTINGS, DETAILS, OFFERS, MANIFESTS)
    built["scored"] = built["scored"].cache()
    return built


def by_id(df, *columns):
    return {(r["posting_id"], str(r["run_date"])): tuple(r[c] for c in columns) for r in df.collect()}


def test_one_row_per_posting_and_run(models):
    assert models["scored"].count() == len(LISTINGS) + len(OFFERS)
    assert models["scored"].columns == SCORED_COLUMNS


def test_flags_over_runs(models):
    found = by_id(models["scored"], "title_in_scope", "country_known", "run_rank", "days_since_latest_run", "still_advertised")
    assert found["stale", D1] == (True, True, 1, 11, False)
    assert found["back", D3] == (True, True, 1, 0, True) and found["back", D1] == (True, True, 2, 11, False)
    # Rows are ranked within the scope flag: the last in-scope run counts, not the last run.
    assert found["renamed", D2] == (True, True, 1, 2, True) and found["renamed", D3] == (False, True, 1, 0, False)
    assert found["moved", D1] == (True, True, 1, 11, False) and found["moved", D2] == (True, False, 1, 2, False)
    assert found["notitle", D3][0] is None and found["notitle", D3][4] is None
    assert found["o2", D3][1] is None
    assert found["o6", D3][:2] == (True, False)


def test_details_are_the_newest_ever(models):
    texts = by_id(models["scored"], "description", "has_description", "requires_german", "description_length")
    assert texts["s1", D3][0] == ENGLISH and texts["back", D3][2] is True
    assert texts["noname", D3] == (None, False, None, 0)


def test_dedup_merges_across_sources_and_missing_employers(models):
    kept = {r["posting_id"] for r in published(models["scored"]).collect()}
    assert "back" in kept and "o3" not in kept
    assert len(kept & {"noname", "noname2"}) == 1
    direct = published_postings(models["listings"], models["details"], models["board"], models["located"])
    assert rows(direct, "posting_id") == rows(published(models["scored"]), "posting_id")


def test_stored_verdicts_join_on_both_keys(models):
    joined = with_verdicts(models["board"], models["verdicts"])
    assert joined.count() == len(OFFERS)
    assert rows(joined.select(*models["located"].columns), "posting_id", "run_date") == rows(
        models["located"], "posting_id", "run_date"
    )


def test_places(models):
    found = by_id(models["verdicts"], "resolved_country", "resolved_city", "resolved_region")
    assert found["o1", D3] == ("DEUTSCHLAND", "Frankfurt am Main", "Hessen")
    assert found["o4", D3] == ("DEUTSCHLAND", None, None)
    assert found["o5", D3][:2] == ("DEUTSCHLAND", "München")
    assert found["o6", D3] == ("FOREIGN", None, None)
    assert found["o2", D3] == (None, None, None)


def test_funnel_falls_back_where_no_manifest_is(models):
    stages = {r["stage"]: r["records"] for r in marts.pipeline_funnel(models["scored"], models["runs"]).collect()}
    # 10 + 20 + 4 from manifests; the federal run of the 10th has two rows, the board run of the 12th six.
    assert stages["rows_read"] == 10 + 20 + 4 + 2 + 6
    assert stages["distinct_postings"] == 23


def test_salaries(spark, models):
    postings = published(models["scored"])
    mentioned = marts.mentions(postings, seeds.skills(spark))
    table = {r["skill_key"]: tuple(r)[3:] for r in marts.salary_by_skill(postings, mentioned).collect()}
    # Four salaries give 60001.5, to the even neighbour 60002; of three upper bounds the middle is
    # 70000.50, to 70000; extremes round half up.
    assert table["sql"] == (4, 60002, 70000, 50000, 90000)
    half = postings.filter("posting_id in ('s1', 's3', 's4')").withColumn("salary_from", F.col("salary_from") + 0.5)
    again = marts.salary_by_skill(half.withColumn("salary_from", F.col("salary_from").cast("decimal(12,2)")), mentioned)
    assert {r["min_salary_from"] for r in again.collect()} == {50001}


def test_cities_order_and_nulls(models):
    postings = published(models["scored"])
    found = [tuple(r) for r in marts.city_stats(postings, Params(min_city_postings=1)).collect()]
    # Six Berlin rows if the nameless vacancy kept is the Berlin one (it has the smaller id).
    assert found[0][:3] == ("Berlin", "Berlin", 7) and found[0][5] == 60002
    assert ("Frankfurt", "Hessen", 1, 0, 1, None) in found
    assert ("St. Augustin", None, 1, 0, 0, None) in found
    assert ("Unknown", None, 1, 0, 0, None) in found


def test_language_rows(models):
    postings = published(models["scored"])
    few = marts.language_requirement(postings, Params(min_source_postings=5)).collect()
    assert [r["population"] for r in few] == ["ALL", "arbeitsagentur"]


def test_empty_inputs_still_give_the_overall_row(spark, models):
    none = models["scored"].limit(0)
    mentioned = marts.mentions(published(none), seeds.skills(spark))
    tables = publish(none, published(none), models["runs"].limit(0), mentioned)
    assert [tuple(r) for r in tables["mart_language_requirement"].collect()] == [("ALL", 0, 0, 0, 0, None, None)]
    assert tables["mart_skill_frequency"].isEmpty() and tables["mart_city_stats"].isEmpty()
    assert tables["mart_salary_by_skill"].isEmpty()
    funnel = tables["mart_pipeline_funnel"].collect()
    assert [r["records"] for r in funnel] == [None, 0, 0, 0, 0, 0, 0, 0]


def test_snapshots_and_history(spark, models, tmp_path):
    root = str(tmp_path / "snapshots")
    mentioned = marts.mentions(published(models["scored"]), seeds.skills(spark))
    tables = publish(models["scored"], published(models["scored"]), models["runs"], mentioned)
    for day in ("2026-09-11", "2026-09-12"):
        snapshots.export_snapshot(tables, root, day)
    empty = tables | {"mart_salary_by_skill": tables["mart_salary_by_skill"].limit(0)}
    snapshots.export_snapshot(empty, root, "2026-09-13")
    # A plain file per mart, as another writer would leave it, without the optional one.
    other = tmp_path / "snapshots" / "2026-09-14"
    other.mkdir()
    (other / "mart_skill_frequency.csv").write_text(
        "skill_key,display_name,category,postings,postings_with_text,pct_of_postings\nsql,SQL,language,1,,40\n"
    )
    (other / "mart_language_requirement.csv").write_text(
        "population,postings,requires_german,mentions_english,english_without_german,pct_requires_german,"
        "pct_english_without_german\nALL,5,1,1,1,20.0,\n"
    )
    (other / "mart_city_stats.csv").write_text("city,region,postings,home_office_postings,postings_with_salary,median_salary_from\n")
    incomplete = tmp_path / "snapshots" / "2026-09-15"
    incomplete.mkdir()
    (incomplete / "mart_city_stats.csv").write_text((other / "mart_city_stats.csv").read_text())
    assert {str(r[0]) for r in snapshots.read_history(spark, root)["mart_city_stats"].select("snapshot_date").distinct().collect()} == {
        "2026-09-11", "2026-09-12", "2026-09-13",
    }
    (other / "mart_salary_by_skill.csv").write_text("skill_key,display_name,category,postings_with_salary,median_salary_from,median_salary_to,min_salary_from,max_salary_to\n")
    past = snapshots.read_history(spark, root)
    days = reporting.history(past["mart_skill_frequency"], past["mart_language_requirement"]).collect()
    assert [str(r["snapshot_date"]) for r in days] == ["2026-09-11", "2026-09-12", "2026-09-13", "2026-09-14"]
    assert days[3]["skills"] == {"sql": 40.0} and days[3]["postings"] == 5
    last = past["mart_skill_frequency"].filter("snapshot_date = '2026-09-14'").first()
    assert last["postings_with_text"] is None
    steps = {(str(r["snapshot_date"]), r["skill_key"]): (r["previous_pct"], r["change"]) for r in reporting.trend(past["mart_skill_frequency"]).collect()}
    assert steps["2026-09-11", "sql"] == (None, None) and steps["2026-09-12", "sql"][1] == 0.0
    assert rows(past["mart_pipeline_funnel"].filter("snapshot_date = '2026-09-12'").drop("snapshot_date"), "stage_order") == rows(
        tables["mart_pipeline_funnel"], "stage_order"
    )
    # One plain file per mart, in the mart's own order.
    lines = (tmp_path / "snapshots" / "2026-09-12" / "mart_city_stats.csv").read_text().splitlines()
    assert lines[0] == ",".join(tables["mart_city_stats"].columns)
    assert [line.split(",")[0].strip('"') for line in lines[1:]] == [r["city"] for r in tables["mart_city_stats"].collect()]

    # The stored history gives the same rows and grows by the days it does not have.
    warehouse = str(tmp_path / "warehouse")
    first = snapshots.extend_history(spark, root, warehouse)
    by_day = lambda frames: {n: sorted(map(str, f.collect())) for n, f in frames.items()}
    assert by_day(snapshots.stored_history(first)) == by_day(past)
    assert snapshots.extend_history(spark, root, warehouse).number == first.number
    (incomplete / "mart_skill_frequency.csv").write_text(
        "category,note,pct_of_postings,skill_key,postings\nlanguage,new,12.5,sql,\n"
    )
    for name in ("mart_language_requirement", "mart_salary_by_skill"):
        (incomplete / f"{name}.csv").write_text((other / f"{name}.csv").read_text())
    second = snapshots.extend_history(spark, root, warehouse)
    moved = snapshots.stored_history(second)["mart_skill_frequency"].filter("snapshot_date = '2026-09-15'").collect()
    assert [(r["skill_key"], r["category"], r["pct_of_postings"], r["postings"], r["display_name"]) for r in moved] == [("sql", "language", 12.5, None, None)]
    assert set(second.runs("history_days")) - set(first.runs("history_days")) == {"2026-09-15"}
    assert second.runs("history_mart_city_stats")["2026-09-11"] == first.runs("history_mart_city_stats")["2026-09-11"]
    snapshots.export_snapshot(tables, root, "2026-09-15")
    third = snapshots.extend_history(spark, root, warehouse, ["2026-09-15"])
    assert snapshots.stored_history(third)["mart_skill_frequency"].filter("snapshot_date = '2026-09-15'").count() == tables["mart_skill_frequency"].count()


def test_dump_in_one_file(spark, tmp_path):
    frame = local_frame(spark, [(2, "b\nc", None), (1, "a", 0.5), (10, None, -0.0)], "n int, t string, x double")
    path = str(tmp_path / "dumps" / "t.txt")
    for _ in range(2):
        one_file.write_dump(frame.repartition(3), path)
    lines = (tmp_path / "dumps" / "t.txt").read_text().splitlines()
    assert lines[0] == "n|t|x" and len(lines) == 4 and "2|b c|NULL" in lines
    assert [r["line"] for r in one_file.read_dump(spark, path).orderBy("place").collect()] == lines
    assert [p.name for p in (tmp_path / "dumps").iterdir() if not p.name.startswith(".")] == ["t.txt"]


def test_seed_columns_stay_text(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("alias,city,note\n007,Köln,\n")
    seed = seeds.read_seed(spark, str(path), seeds.ALIAS_COLUMNS)
    assert dict(seed.dtypes) == {"alias": "string", "city": "string", "note": "string"}
    assert tuple(seed.first()) == ("007", "Köln", None)
    assert local_frame(spark, [], "a string").isEmpty()


def test_one_text_and_title_on_most_rows(spark):
    """Most rows share employer, title and an empty location; ranks and published rows stay the same."""
    hot = [(f"h{i:03d}", D3, listing("Data Engineer", None, BERLIN)) for i in range(60)]
    cold = [(f"c{i:03d}", D3, listing(f"Data Engineer {i}", "Z", BERLIN)) for i in range(10)]
    offers = [(f"o{i:03d}", D3, offer("Data Engineer", None, None, False)) for i in range(40)]
    plain = build(spark, hot + cold, [], offers, [])
    spread = build(spark, hot + cold, [], offers, [], params=Params(hot_rows=20))
    columns = ["posting_id", "source", "run_rank", "still_advertised", "dedup_rank"]
    ranks = rows(plain["scored"].select(*columns), "posting_id")
    assert rows(spread["scored"].select(*columns), "posting_id") == ranks
    assert sorted(r["dedup_rank"] for r in ranks if r["posting_id"].startswith("h")) == list(range(1, 61))
    kept = published_postings(plain["listings"], plain["details"], plain["board"], plain["located"])
    assert {r["posting_id"] for r in kept.collect()} == {"h000"} | {f"c{i:03d}" for i in range(10)}
