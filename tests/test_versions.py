"""Tables published together, day by day."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from jobtide.plans import daily
from jobtide.session import local_frame
from jobtide.sources import seeds
from jobtide.sources.tables import names_in
from jobtide.sources.texts import TextStore, addressed, text_key, with_texts
from jobtide.sources.versions import VersionedTables
from sample_runs import DETAILS, LISTINGS, OFFERS, raw_documents, raw_runs

DAYS = ["2026-09-11", "2026-09-12"]


def numbers(spark, *values):
    return local_frame(spark, list(values), "day string, n int")


def test_readers_see_whole_versions(spark, tmp_path):
    tables = VersionedTables(spark, str(tmp_path))
    assert tables.current().number == 0 and tables.current().tables == {}
    first = tables.draft()
    first.write("a", numbers(spark, ("x", 1)))
    first.write_runs("b", numbers(spark, ("x", 1), ("y", 2), ("y", 3), (None, 4)), "day")
    assert tables.current().number == 0
    old = first.publish()
    second, late = tables.draft(), tables.draft()
    second.write("a", numbers(spark, ("x", 9)))
    held = second.write_runs("b", numbers(spark, ("y", 7), ("z", 8)), "day", ["x", "y"])
    # While the draft is written, and for whoever still holds it, the old version is whole.
    for version in (tables.current(), old):
        assert rows(version.read("a")) == [{"day": "x", "n": 1}] and version.read("b").count() == 4
    new = second.publish()
    assert rows(tables.current().read("a")) == [{"day": "x", "n": 9}]
    # Run x had no new rows and is gone, z was not named, the run without a date was not touched.
    assert sorted((str(r["day"]), r["n"]) for r in held.collect()) == [("None", 4), ("y", 7)]
    kept = [r for r in new.runs("b") if r not in ("x", "y")]
    assert kept and all(new.runs("b")[r] == old.runs("b")[r] for r in kept) and new.runs("b")["y"] != old.runs("b")["y"]
    with pytest.raises(RuntimeError, match="another build"):
        late.publish()
    assert old.read("b").count() == 4
    tables.vacuum(keep=1)
    assert tables.numbers() == [2] and rows(tables.current().read("b")) == rows(new.read("b"))
    assert tables.current().read("b").count() == 2
    empty = tables.draft()
    empty.write_runs("b", numbers(spark), "day")
    assert empty.publish().read("b").columns == ["day", "n"]


def test_texts_are_written_once(spark, tmp_path):
    store = TextStore(spark, str(tmp_path / "texts"))
    assert store.read().count() == 0
    posts = local_frame(spark, [(1, "one"), (2, "two"), (3, "one"), (4, None), (5, "")], "id int, description string")
    store.add(posts)
    files = names_in(spark, store.path)
    store.add(posts.filter("id > 2"))
    assert names_in(spark, store.path) == files
    store.add(posts.unionByName(local_frame(spark, [(6, "three")], "id int, description string")))
    assert sorted(r["text"] for r in store.read().collect()) == ["", "one", "three", "two"]
    back = with_texts(addressed(posts), store.read())
    assert rows(back.select("id", "description"), "id") == rows(posts, "id")
    assert len(spark.range(1).select(text_key(F.lit("x"))).first()[0]) == 32


def raw_days(spark, days):
    def of(documents, **more):
        parts = [raw_documents(spark, [(k, d, v) for d in days for k, v in documents.items()])]
        return parts[0].selectExpr("*", *[f"{v} {k}" for k, v in more.items()])

    return {
        "listings": of(LISTINGS, search_term="cast(null as string)"), "details": of(DETAILS), "board": of(OFFERS),
        "runs": raw_runs(spark, [("arbeitsagentur", d, 20) for d in days]),
    }


def test_daily_build_run_by_run(spark, tmp_path, monkeypatch):
    warehouse = str(tmp_path / "warehouse")
    seeded = seeds.skills(spark), seeds.city_aliases(spark)
    tables = VersionedTables(spark, warehouse)
    daily.daily_build(raw_days(spark, DAYS[:1]), *seeded, warehouse)
    first = tables.current()
    stepwise = daily.daily_build(raw_days(spark, DAYS), *seeded, warehouse, runs=DAYS[1:])
    second = tables.current()
    for name in ("listings", "details", "board"):
        assert second.runs(name)[DAYS[0]] == first.runs(name)[DAYS[0]] and set(second.runs(name)) == set(DAYS)
    assert "description" not in second.read("scored").columns and "description" not in second.read("board").columns
    assert second.read("scored").count() == 2 * first.read("scored").count()
    at_once = daily.daily_build(raw_days(spark, DAYS), *seeded, str(tmp_path / "other"))
    for name, table in at_once.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, stepwise[name].collect())), name
    texts = TextStore(spark, f"{warehouse}/texts").read()
    assert texts.count() == texts.select("text").distinct().count()

    # A build that breaks a rule leaves the published version alone.
    before = {name: sorted(map(str, second.read(name).collect())) for name in stepwise}
    broken = daily.publish
    monkeypatch.setattr(daily, "publish", lambda *a: broken(*a) | {"mart_pipeline_funnel": broken(*a)["mart_pipeline_funnel"].withColumn("records", F.lit(-1).cast("bigint"))})
    with pytest.raises(ValueError, match="build rules violated"):
        daily.daily_build(raw_days(spark, DAYS), *seeded, warehouse, runs=DAYS[1:])
    assert tables.current().number == second.number
    assert {name: sorted(map(str, tables.current().read(name).collect())) for name in before} == before
    assert json.dumps(second.tables)
