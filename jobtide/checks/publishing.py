"""The steps of a day over the given tables: load, build, check, export, read back."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.checks import world as w
from jobtide.checks.base import Registry, table
from jobtide.checks.tables import DAILY_SQL, daily_marts
from jobtide.fixed_values import MART_NAMES
from jobtide.operators.ranking import By, number_rows
from jobtide.plans import reporting
from jobtide.plans.daily import daily_build
from jobtide.plans.load import load_runs
from jobtide.plans.model_checks import check_build, checks_of
from jobtide.session import shared_folder
from jobtide.sources import landing, snapshots
from jobtide.sources.one_file import read_dump, write_dump
from jobtide.sources.tables import RawTable, names_in, place_text, read_table, rename
from jobtide.sources.versions import VersionedTables

registry = Registry()
RAW = ("listings", "details", "board", "runs")


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/jobtide/{uuid.uuid4().hex}"


def _built(spark: SparkSession, sf: str, runs: list[str] | None) -> VersionedTables:
    """A first build, and a second one on top that parses `runs` alone."""
    world = w.World(spark, sf)
    raw = {name: world.raw(name) for name in RAW}
    tables = VersionedTables(spark, _new_folder(spark))
    for part in (None, runs) if runs else (None,):
        daily_build(
            raw, world.skills, world.aliases, tables.root, runs=part, rules=w.RULES, language=w.LANGUAGE, foreign_terms=w.FOREIGN_WORDS
        )
    return tables


FIGURES = {
    "mart_skill_frequency": ("skill_key", "postings"),
    "mart_language_requirement": ("population", "requires_german"),
    "mart_city_stats": ("coalesce(city, '') || '/' || coalesce(region, '')", "postings"),
    "mart_salary_by_skill": ("skill_key", "median_salary_to"),
    "mart_pipeline_funnel": ("stage", "records"),
}
MART_SQL = (*w.TO_MENTIONS, w.FREQUENCY_SQL, w.LANGUAGE_SQL, w.CITIES_SQL, w.SALARY_SQL, w.FUNNEL_SQL)
OF_MART = dict(zip(FIGURES, ("frequency", "language", "cities", "salary", "funnel")))


@registry.add("daily_build_events", w.with_sql(*MART_SQL, select=" union all ".join(
    f"select '{mart}' as mart, {item} as item, cast({figure} as bigint) as figure from {OF_MART[mart]}" for mart, (item, figure) in FIGURES.items()
)))
def daily_build_events(spark, sf):
    """Two builds in turn, the second parsing two runs anew; a figure per row of each published table."""
    version = _built(spark, sf, ["2024-01-05", "2024-01-06"]).current()
    parts = [
        version.read(mart).select(F.lit(mart).alias("mart"), F.expr(item).alias("item"), F.col(figure).cast("bigint").alias("figure"))
        for mart, (item, figure) in FIGURES.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


BROKEN = {
    ("not_null", "published", "title"): "(select count(*) from kept where city is null)",
    ("accepted_values", "published", "country"): "(select count(*) from kept where source = 'arbeitnow')",
    ("relationships", "mentions", "skill_key"): "(select count(*) from mention where skill_key = 'the')",
    ("unique", "places", "city_norm"): "(select count(*) from places where region = 'ASIA')",
    ("not_null", "mart_pipeline_funnel", "records"): "1",
}
RULE_NAMES = [(c.check, c.table, c.column) for c in checks_of("HOME")]
RULE_NAMES += [("funnel_is_monotonic", "mart_pipeline_funnel", "records"), ("funnel_tail_is_denominator", "mart_pipeline_funnel", "records")]


@registry.add("check_build_events", w.with_sql(*MART_SQL, select=" union all ".join(
    f"""select '{rule}' as "check", '{name}' as table_name, '{column}' as column_name, cast({BROKEN.get((rule, name, column), '0')} as bigint) as violations"""
    for rule, name, column in RULE_NAMES
)))
def check_build_events(spark, sf):
    """Every rule of a build over tables that have been spoiled in five places."""
    world = w.World(spark, sf)
    version = _built(spark, sf, None).current()
    tables = {name: version.read(name) for name in version.tables}
    tables |= {name: world.raw(name) for name in ("listings", "details", "board")} | {"skills": world.skills, "aliases": world.aliases}
    tables["published"] = tables["published"].withColumns({
        "title": F.when(F.col("city").isNotNull(), F.col("title")),
        "country": F.when(F.col("source") == "arbeitnow", "ELSEWHERE").otherwise(F.col("country")),
    })
    tables["skills"] = tables["skills"].filter("skill_key <> 'the'")
    tables["places"] = tables["places"].unionByName(tables["places"].filter("region = 'ASIA'"))
    tables["mart_pipeline_funnel"] = tables["mart_pipeline_funnel"].withColumn("records", F.when(F.col("stage_order") != 3, F.col("records")))
    return check_build(tables, checks_of("HOME"))


@registry.add("snapshot_roundtrip", w.with_sql(*w.TO_SCORED, w.CITIES_SQL, select="select date '2024-02-01' as snapshot_date, * from cities"))
def snapshot_roundtrip(spark, sf):
    """The published tables exported as CSV files, and one of them read back with its types."""
    version = _built(spark, sf, None).current()
    root = _new_folder(spark)
    snapshots.export_snapshot({name: version.read(name) for name in MART_NAMES}, root, "2024-02-01")
    return snapshots.read_history(spark, root)["mart_city_stats"]


@registry.add("history_from_snapshots", DAILY_SQL + """
select d.snapshot_date, d.postings, d.pct_requires_german, f.skill_key, f.pct_of_postings
from d join f on f.snapshot_date = d.snapshot_date where d.snapshot_date <> (select max(snapshot_date) from d)""")
def history_from_snapshots(spark, sf):
    """A file per table and day, a history in two steps from them, without the day that lacks a required table.

    Columns stand in another order in every second file, and no day has the optional funnel.
    """
    frequency, language = daily_marts(spark, sf)
    frames = {
        "mart_skill_frequency": frequency, "mart_language_requirement": language,
        "mart_city_stats": language.select("snapshot_date", F.col("population").alias("city"), "postings"),
        "mart_salary_by_skill": frequency.select("snapshot_date", "skill_key"),
    }
    root, warehouse = _new_folder(spark), _new_folder(spark)
    days = [str(r[0]) for r in language.select("snapshot_date").orderBy("snapshot_date").collect()]
    for name, df in frames.items():
        columns = [c for c in df.columns if c != "snapshot_date"]
        for turned, part in ((False, df.filter("day(snapshot_date) % 2 = 0")), (True, df.filter("day(snapshot_date) % 2 = 1"))):
            order = columns[::-1] if turned else columns
            rows = part.withColumn("day", F.col("snapshot_date").cast("string"))
            parts = f"{root}/parts-{name}-{turned}"
            rows.repartition("day").select(*order, "day").write.option("header", True).partitionBy("day").csv(parts)
            for folder in names_in(spark, parts):
                day = folder.removeprefix("day=")
                written = [f for f in names_in(spark, f"{parts}/{folder}") if f.startswith("part-")]
                if folder.startswith("day=") and not (name == "mart_city_stats" and day == days[-1]):
                    rename(spark, f"{parts}/{folder}/{written[0]}", f"{root}/{day}/{name}.csv")
    snapshots.extend_history(spark, root, warehouse, days[: len(days) // 2])
    past = snapshots.stored_history(snapshots.extend_history(spark, root, warehouse))
    spread = reporting.history(past["mart_skill_frequency"], past["mart_language_requirement"])
    return spread.select(
        "snapshot_date", "postings", "pct_requires_german", F.explode("skills").alias("skill_key", "pct_of_postings")
    )


@registry.add("dump_with_header", """
with d as (select n_nationkey, n_name, n_regionkey from nation),
lines as (select n_nationkey || '|' || n_name || '|' || n_regionkey as line from d)
select cast(0 as integer) as place, 'n_nationkey|n_name|n_regionkey' as line
union all select cast(row_number() over (order by split_part(line, '|', 1), split_part(line, '|', 2), split_part(line, '|', 3)) as integer), line from lines""")
def dump_with_header(spark, sf):
    """The lines of a dump file in their order, the header first."""
    path = f"{_new_folder(spark)}/nation.txt"
    write_dump(table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    return read_dump(spark, path)


PAGE_EVENTS = 20_000
HOT_EVENTS = 1_000_000


def _paged(events: DataFrame) -> DataFrame:
    """Events with the page of their run they stand on, in the order of their ids.

    Pages are filled within a run, so files are as many as events fill, and at most one more per run.
    """
    order = [By(F.col("event_id")), By(F.col("user_id"))]
    numbered = number_rows(events, ["federal", "run_date"], order, "number", HOT_EVENTS)
    return numbered.withColumn("page", F.floor((F.col("number") - 1) / PAGE_EVENTS).cast("int")).drop("number")


def _land_pages(spark: SparkSession, pages: DataFrame, raw: str) -> None:
    """Documents (source, run_date, page, document) as files of run folders."""
    parts = f"{raw}-parts"
    pages.repartition("source", "run_date", "page").write.partitionBy("source", "run_date", "page").text(parts)
    for source in [s for s in names_in(spark, parts) if "=" in s]:
        for day in names_in(spark, f"{parts}/{source}"):
            for page in names_in(spark, f"{parts}/{source}/{day}"):
                folder = f"{parts}/{source}/{day}/{page}"
                file = next(f for f in names_in(spark, folder) if f.startswith("part-"))
                target = f"{raw}/{source.split('=')[1]}/{day.split('=')[1]}/page_{int(page.split('=')[1]):04d}.json"
                rename(spark, f"{folder}/{file}", target)


@registry.add("load_runs_events", """
with e as (
  select event_id, cast(ts as date) as run_date, case when event_type in ('view', 'click', 'signup') then 'u' else 'b' end || user_id as source_id,
         case when event_type in ('view', 'click', 'signup') then 'listings' else 'board' end as table_name,
         case when event_type in ('view', 'click', 'signup') then 'arbeitsagentur' else 'arbeitnow' end as source
  from events
)
select table_name, source_id, run_date, event_id as figure from e
qualify row_number() over (partition by table_name, source_id, run_date order by event_id desc) = 1
union all
select 'runs', source, run_date, count(*) - count(distinct source_id) from e where run_date <= date '2024-01-20' group by all""")
def load_runs_events(spark, sf):
    """Landed page files and manifests into raw tables, one run a second time."""
    raw, warehouse = f"{_new_folder(spark)}/raw", _new_folder(spark)
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("run_date"), "user_id", F.col("event_type").isin("view", "click", "signup").alias("federal"),
    )
    events = _paged(events)
    federal = F.struct(F.concat(F.lit("u"), "user_id").alias("refnr"), "event_id")
    boarded = F.struct(F.concat(F.lit("b"), "user_id").alias("slug"), "event_id")
    in_order = lambda posting: F.transform(F.array_sort(F.collect_list(F.struct("event_id", posting.alias("p")))), lambda x: x["p"])
    by_page = [F.col("run_date"), F.col("page")]
    listed = events.filter("federal").groupBy(*by_page).agg(in_order(federal).alias("ergebnisliste"))
    offered = events.filter("not federal").groupBy(*by_page).agg(in_order(boarded).alias("data"))
    envelope = F.struct(F.lit("ergebnisliste").alias("results_key"), F.lit("all").alias("search_term"), F.struct("ergebnisliste").alias("payload"))
    pages = listed.select(F.lit("arbeitsagentur").alias("source"), *by_page, F.to_json(envelope).alias("document")).unionByName(
        offered.select(F.lit("arbeitnow").alias("source"), *by_page, F.to_json(F.struct("data")).alias("document"))
    )
    _land_pages(spark, pages, raw)
    runs = landing.list_runs(spark, raw).filter("run_date <= date '2024-01-20'").collect()
    for run in runs:
        place_text(spark, f"{raw}/{run['source']}/{run['run_date']}/{landing.MANIFEST_NAME}", '{"results_key": "ergebnisliste", "rows_read": 0}')
    load_runs(spark, raw, warehouse, "arbeitsagentur", "arbeitnow")
    load_runs(spark, raw, warehouse, "arbeitsagentur", "arbeitnow", run_date=str(runs[0]["run_date"]))

    def loaded(name: str, key: str, document: str, field: str) -> DataFrame:
        figure = F.get_json_object(document, f"$.{field}").cast("bigint").alias("figure")
        return read_table(spark, RawTable.at(warehouse, name)).select(F.lit(name).alias("table_name"), F.col(key).alias("source_id"), "run_date", figure)

    found = [loaded(name, "source_id", "payload", "event_id") for name in ("listings", "board")]
    return found[0].unionByName(found[1]).unionByName(loaded("runs", "source", "manifest", "duplicates_collapsed"))
