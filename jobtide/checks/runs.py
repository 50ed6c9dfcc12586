"""Landing and run management: pages to rows, last-wins, upsert, retention, gaps, samples."""

from pyspark.sql import functions as F

from jobtide.checks.base import Registry, table
from jobtide.functions.json import first_present, json_text, truthy_text
from jobtide.functions.numbers import days_between, epoch_date, half_even_int, half_up_int, is_fresh
from jobtide.functions.text import first_filled
from jobtide.operators.ranking import By, last_wins, last_written_wins, number_rows, number_small_groups, top_per_key
from jobtide.operators.tables import latest_per_day, missing_dates, not_present, seeded_sample
from jobtide.plans import reporting
from jobtide.plans.places import canonical_places
from jobtide.plans.postings import newest_details
from jobtide.sources.landing import (
    collapse, detail_rows, enveloped_rows, load_manifests, plain_rows, run_accounting, truncated_terms,
)
from jobtide.sources.tables import expired_runs, merge_rows

registry = Registry()
DAY = "cast(ts as date)"


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("run_date", F.col("ts").cast("date"))


@registry.add("land_pages_conversations", """
select 'c' || conv_id || '/' || (turn // 2) as source_id, role as search_term, md5(text) as digest, conv_id as file_no
from conversations
qualify row_number() over (partition by conv_id, turn // 2 order by turn desc) = 1""")
def land_pages_conversations(spark, sf):
    """Each turn is a page whose results array is named by the page; ids come under three names."""
    turn = table(spark, sf, "conversations")
    found = F.concat(F.lit("c"), "conv_id", F.lit("/"), F.floor(F.col("turn") / 2).cast("string"))
    even = F.col("turn") % 2 == 0
    posting = F.struct(
        F.when(even, found).otherwise(F.lit("")).alias("referenznummer"),
        F.when(~even, found).alias("refnr"), F.col("text").alias("text"),
    )
    newer = F.struct(F.col("role").alias("search_term"), F.lit("ergebnisliste").alias("results_key"),
                     F.struct(F.array(posting).alias("ergebnisliste")).alias("payload"))
    older = F.struct(F.col("role").alias("search_term"), F.lit("stellenangebote").alias("results_key"),
                     F.struct(F.array(posting).alias("stellenangebote")).alias("payload"))
    pages = turn.select(
        F.lit("2024-01-01").cast("date").alias("run_date"), F.lpad(F.col("turn").cast("string"), 8, "0").alias("file"),
        "conv_id", F.when(even, F.to_json(newer)).otherwise(F.to_json(older)).alias("document"),
    )
    return collapse(enveloped_rows(pages)).select(
        "source_id", "search_term", F.md5(json_text(F.col("payload"), "text")).alias("digest"),
        F.col("conv_id").alias("file_no"),
    )


@registry.add("land_board_events", f"""
select 'u' || user_id as source_id, {DAY} as run_date, event_id, value from events
where json_extract_string(props, '$.k') <> '0'
qualify row_number() over (partition by user_id, {DAY} order by event_id desc) = 1""")
def land_board_events(spark, sf):
    """A page per event, with a second entry whose slug is empty; empty slugs are skipped."""
    k = json_text(F.col("props"), "k")
    slug = F.when(k == "0", "").otherwise(F.concat(F.lit("u"), F.col("user_id")))
    entry = F.struct("event_id", slug.alias("slug"), "value")
    nameless = F.struct("event_id", F.lit("").alias("slug"), "value")
    files = _events(spark, sf).select(
        "run_date", F.lpad(F.col("event_id").cast("string"), 19, "0").alias("file"),
        F.to_json(F.struct(F.array(entry, nameless).alias("data"))).alias("document"),
    )
    payload = F.col("payload")
    return collapse(plain_rows(files)).select(
        "source_id", "run_date", json_text(payload, "event_id").cast("bigint").alias("event_id"),
        json_text(payload, "value").cast("double").alias("value"),
    )


@registry.add("land_details_documents", """
select 'd' || doc_id as source_id, md5(text) as digest, lang from documents""")
def land_details_documents(spark, sf):
    body = F.struct(F.concat(F.lit("d"), "doc_id").alias("id"), F.struct("text", "lang").alias("payload"))
    files = table(spark, sf, "documents").select(F.to_json(body).alias("document"))
    payload = F.col("payload")
    return detail_rows(files).select(
        "source_id", F.md5(json_text(payload, "text")).alias("digest"), json_text(payload, "lang").alias("lang")
    )


@registry.add("run_accounting_events", f"""
select event_type as source, {DAY} as run_date, count(*) as rows_read,
       count(*) - count(distinct user_id) as duplicates_collapsed
from events group by all""")
def run_accounting_events(spark, sf):
    return run_accounting(
        _events(spark, sf).select(F.col("event_type").alias("source"), "run_date", F.col("user_id").alias("source_id"))
    )


@registry.add("load_manifests_events", f"""
with c as (
  select event_type as source, {DAY} as run_date, count(*) as rows_read,
         count(*) - count(distinct user_id) as duplicates_collapsed
  from events group by all
)
select source, run_date, cast(rows_read as varchar) as rows_read,
       cast(duplicates_collapsed as varchar) as duplicates_collapsed, 'by ' || source as written_by
from c""")
def load_manifests_events(spark, sf):
    counts = run_accounting_events(spark, sf)
    written = F.concat(F.lit('{"rows_read": 3, "written_by": "by '), "source", F.lit('"}'))
    manifest = F.col("manifest")
    return load_manifests(counts.select("source", "run_date", written.alias("document")), counts).select(
        "source", "run_date",
        *[json_text(manifest, f).alias(f) for f in ("rows_read", "duplicates_collapsed", "written_by")],
    )


@registry.add("load_manifests_odd_counts", f"""
with c as (
  select event_type as source, {DAY} as run_date, count(*) as rows_read,
         count(*) - count(distinct user_id) as duplicates_collapsed
  from events group by all
)
select source, run_date, cast(rows_read as varchar) as rows_read,
       cast(duplicates_collapsed as varchar) as duplicates_collapsed, '9' as nested, 'by ' || source as written_by
from c""")
def load_manifests_odd_counts(spark, sf):
    """Counts that were texts, fractions, nulls, lists or objects before; a nested member of the name stays."""
    counts = run_accounting_events(spark, sf)
    before = F.element_at(F.array(*[F.lit(v) for v in ('"3"', "3.5", "null", "[1, 2]", '{"rows_read": 1}')]), F.day("run_date") % 5 + 1)
    written = F.format_string('{"rows_read": %s, "per_term": {"rows_read": 9}, "written_by": "by %s"}', before, F.col("source"))
    merged = load_manifests(counts.select("source", "run_date", written.alias("document")), counts)
    manifest = F.col("manifest")
    return merged.select(
        "source", "run_date", json_text(manifest, ["per_term", "rows_read"]).alias("nested"),
        *[json_text(manifest, f).alias(f) for f in ("rows_read", "duplicates_collapsed", "written_by")],
    )


@registry.add("truthy_ids_events", """
select event_id, case k % 6 when 1 then '0' when 5 then 'x' || k else 'b' || k end as id
from (select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events)""")
def truthy_ids_events(spark, sf):
    """A first id that is the number 0, the text "0", false, an empty list, an empty text, or filled."""
    k = json_text(F.col("props"), "k").cast("int")
    filled = F.concat(F.lit('"x'), k, F.lit('"'))
    first = F.element_at(F.array(*[F.lit(v) for v in ("0", '"0"', "false", "[]", '""')], filled), k % 6 + 1)
    payload = F.format_string('{"a": %s, "b": "b%d"}', first, k)
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(truthy_text(payload, "a"), truthy_text(payload, "b")).alias("id")
    )


@registry.add("first_truthy_id", """
select event_id, coalesce(nullif(case when k % 3 = 0 then '' when k % 3 = 1 then null else 'a' || k end, ''),
                          nullif(case when k % 2 = 0 then 'b' || k else '' end, ''), 'c' || k) as id
from (select event_id, cast(json_extract_string(props, '$.k') as integer) as k from events)""")
def first_truthy_id(spark, sf):
    k = json_text(F.col("props"), "k").cast("int")
    first = F.when(k % 3 == 0, "").when(k % 3 == 2, F.concat(F.lit("a"), k))
    second = F.when(k % 2 == 0, F.concat(F.lit("b"), k)).otherwise("")
    third = F.concat(F.lit("c"), k)
    return table(spark, sf, "events").select("event_id", first_filled(first, second, third).alias("id"))


@registry.add("first_present_key", """
select event_id, case when event_type = 'click' then '' else cast(value as varchar) end as picked
from events where event_type in ('click', 'view')
union all
select event_id, case event_type when 'error' then null else json_extract_string(props, '$.k') end from events
where event_type not in ('click', 'view')""")
def first_present_key(spark, sf):
    """A key that is there wins even when it is empty; a missing one does not."""
    kind = F.col("event_type")
    text = F.when(kind == "click", F.lit('{"new": "", "old": 1}'))
    text = text.when(kind == "view", F.concat(F.lit('{"old": "'), F.col("value").cast("string"), F.lit('"}')))
    text = text.when(kind == "error", F.lit('{"other": 5}')).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", first_present(text, ["new", "old", "k"]).alias("picked"))


@registry.add("truncated_terms", f"""
select user_id || '/' || {DAY} as search_term, cast(sum(least(cast(json_extract_string(props, '$.k') as integer), 3))
       as bigint) as fetched, cast(arg_max(cast(json_extract_string(props, '$.k') as integer), event_id) as bigint)
       as reported, count(*) as pages
from events group by 1
having fetched < reported and count(*) = 3""")
def truncated_terms_events(spark, sf):
    """A term per user and day, a page per event; three pages are the cap."""
    k = json_text(F.col("props"), "k").cast("int")
    postings = F.array_repeat(F.struct(F.lit(1).alias("x")), F.least(k, F.lit(3)))
    body = F.struct(F.struct(postings.alias("ergebnisliste"), k.alias("maxErgebnisse")).alias("payload"))
    term = F.concat("user_id", F.lit("/"), F.col("run_date").cast("string"))
    pages = _events(spark, sf).select(term.alias("search_term"), F.col("event_id").alias("page"), F.to_json(body).alias("document"))
    return truncated_terms(pages, 3)


@registry.add("daily_last_wins", f"""
select user_id, {DAY} as run_date, event_id, event_type from events
qualify row_number() over (partition by user_id, {DAY} order by event_id desc) = 1""")
def daily_last_wins(spark, sf):
    return last_wins(_events(spark, sf), ["user_id", "run_date"], ["event_id"]).select(
        "user_id", "run_date", "event_id", "event_type"
    )


@registry.add("written_last_wins", f"""
select user_id, {DAY} as run_date, event_id, event_type, props from events
qualify row_number() over (partition by user_id, {DAY} order by event_id desc) = 1""")
def written_last_wins(spark, sf):
    """The last event of a user's day with its payload, which only the rows that stay are read for."""
    rows = _events(spark, sf).select("user_id", "run_date", "event_id", "event_type", "props")
    return last_written_wins(rows, ["user_id", "run_date"], ["event_id"])


@registry.add("upsert_events", """
with target as (
  select user_id, cast(ts as date) as run_date, event_id from events where event_type <> 'signup'
  qualify row_number() over (partition by user_id, cast(ts as date) order by event_id desc) = 1
), incoming as (
  select user_id, cast(ts as date) as run_date, event_id from events where event_type = 'signup'
  qualify row_number() over (partition by user_id, cast(ts as date) order by event_id desc) = 1
)
select * from incoming
union all
select t.* from target t
where not exists (select 1 from incoming i where i.user_id = t.user_id and i.run_date = t.run_date)""")
def upsert_events(spark, sf):
    keys = ["user_id", "run_date"]
    events = _events(spark, sf).select(*keys, "event_id", "event_type")
    target = last_wins(events.filter("event_type <> 'signup'"), keys, ["event_id"])
    incoming = last_wins(events.filter("event_type = 'signup'"), keys, ["event_id"])
    return merge_rows(target, incoming, keys).select(*keys, "event_id")


@registry.add("retention_report", f"""
select {DAY} as run_date, count(*) as rows from events where {DAY} < date '2024-02-10' - 30 group by 1""")
def retention_report(spark, sf):
    return expired_runs(_events(spark, sf), "2024-02-10", 30)


@registry.add("latest_per_day", f"""
select {DAY} as run_date, event_id, event_type from events
where event_type <> 'error' and {DAY} between date '2024-01-05' and date '2024-01-25'
qualify row_number() over (partition by {DAY} order by user_id desc, event_id) = 1""")
def latest_per_day_events(spark, sf):
    """Ties in the creation value go to the row listed first."""
    rows = _events(spark, sf).select("run_date", "event_id", "event_type", "user_id")
    newest = latest_per_day(
        rows, "run_date", "user_id", "2024-01-05", "2024-01-25", "event_id", F.col("event_type") != "error"
    )
    return newest.select("run_date", "event_id", "event_type")


@registry.add("not_present", f"""
select distinct user_id, {DAY} as run_date from events where event_type = 'click'
and {DAY} not in (select {DAY} from events where value > 400)""")
def not_present_events(spark, sf):
    events = _events(spark, sf)
    wanted = events.filter("event_type = 'click'").select("user_id", "run_date").distinct()
    return not_present(wanted, events.filter("value > 400"), "run_date").select("user_id", "run_date")


@registry.add("missing_dates", f"""
select cast(d as date) as run_date from generate_series(timestamp '2023-12-25', timestamp '2024-02-07', interval 1 day) t(d)
where cast(d as date) not in (select {DAY} from events where value > 300)""")
def missing_dates_events(spark, sf):
    return missing_dates(_events(spark, sf).filter("value > 300"), "run_date", "2023-12-25", 45)


@registry.add("seeded_sample", """
select doc_id from documents order by md5('2024-01-30' || doc_id), doc_id limit 200""")
def seeded_sample_docs(spark, sf):
    return seeded_sample(table(spark, sf, "documents"), "doc_id", "2024-01-30", 200)


@registry.add("newest_detail", """
select 'c' || conv_id as posting_id, turn as run_date, role, length(text) as chars from conversations
qualify row_number() over (partition by conv_id order by turn desc) = 1""")
def newest_detail(spark, sf):
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id").alias("posting_id"), F.col("turn").alias("run_date"), "role",
        F.length("text").cast("bigint").alias("chars"),
    )
    return newest_details(turns)


@registry.add("canonical_spelling", """
select lower(p_name) as city_norm, city, region
from (select p_name, case when p_size > 25 then upper(p_name) else p_name end as city, p_brand as region, count(*) as n
      from part where p_type <> 'SMALL' group by all)
qualify row_number() over (partition by lower(p_name) order by n desc, md5(city), md5(region)) = 1""")
def canonical_spelling(spark, sf):
    listed = table(spark, sf, "part").select(
        F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("city"),
        F.col("p_brand").alias("region"), F.when(F.col("p_type") != "SMALL", "HOME").alias("country"),
    )
    return canonical_places(listed, "HOME")


@registry.add("latest_snapshot", f"""
with d as (
  select user_id, {DAY} as run_date, event_type as source, event_id, value > 30 as flag from events
  qualify row_number() over (partition by event_type, user_id, {DAY} order by event_id desc) = 1
)
select *, row_number() over (partition by source, user_id, flag order by run_date desc, event_id desc) as run_rank
from d""")
def latest_snapshot(spark, sf):
    rows = _events(spark, sf).withColumnRenamed("event_type", "source")
    daily = last_wins(rows, ["source", "user_id", "run_date"], ["event_id"])
    flagged = daily.withColumn("flag", F.col("value") > 30)
    order = [F.col("run_date").desc(), F.col("event_id").desc()]
    return number_small_groups(flagged, ["source", "user_id", "flag"], order, "run_rank").select(
        "user_id", "run_date", "source", "event_id", "flag", "run_rank"
    )


@registry.add("fresh_postings", f"""
select event_id, cast((select max({DAY}) from events) - {DAY} as integer) as days_since_latest_run
from events where (select max({DAY}) from events) - {DAY} < 7""")
def fresh_postings(spark, sf):
    events = _events(spark, sf)
    newest = events.agg(F.max("run_date")).scalar()
    dated = events.withColumn("newest", newest)
    kept = dated.filter(is_fresh(F.col("run_date"), F.col("newest"), 7))
    return kept.select("event_id", days_between(F.col("newest"), F.col("run_date")).alias("days_since_latest_run"))


@registry.add("rank_orders_hot_groups", """
select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by o_orderdate desc, o_orderkey)
       as place
from orders""")
def rank_orders_hot_groups(spark, sf):
    """Three statuses share all orders; with a low limit every group is ranked by range over many tasks."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    order = [By(F.col("o_orderdate"), down=True, nulls_last=True), By(F.col("o_orderkey"))]
    return number_rows(orders, ["o_orderstatus"], order, "place", hot_rows=1000).select(
        "o_orderkey", "o_orderstatus", "place"
    )


@registry.add("sample_per_group", """
select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by o_orderkey) as rn
from orders qualify rn <= 4""")
def sample_per_group(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return top_per_key(orders, ["o_orderpriority"], [F.col("o_orderkey")], 4, rank="rn")


@registry.add("epoch_and_age", f"""
select event_id, {DAY} as published_at, cast(date '2024-02-01' - {DAY} as integer) as age,
       case when date '2024-02-01' - {DAY} <= 0 then 'today' when date '2024-02-01' - {DAY} = 1 then 'yesterday'
            else (date '2024-02-01' - {DAY}) || ' days ago' end as label
from events""")
def epoch_and_age(spark, sf):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    dated = table(spark, sf, "events").select("event_id", epoch_date(seconds).alias("published_at"))
    age = reporting.age_in_days(F.col("published_at"), "2024-02-01")
    return dated.select("event_id", "published_at", age.alias("age"), reporting.age_label(age).alias("label"))


@registry.add("rounding_to_int", """
select p_partkey, cast(round_even(floor(p_retailprice) / 2, 0) as integer) as half_even,
       cast(round(cast(floor(p_retailprice) / 2 as decimal(12,2)), 0) as integer) as half_up
from part""")
def rounding_to_int(spark, sf):
    half = F.floor("p_retailprice") / 2
    return table(spark, sf, "part").select(
        "p_partkey", half_even_int(half).alias("half_even"), half_up_int(half.cast("decimal(12,2)")).alias("half_up")
    )
