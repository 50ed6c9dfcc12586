"""Tables against each other and against their rules; medians, shares and the dated history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.checks.base import Registry, table
from jobtide.functions.numbers import half_even_int, plausible, share
from jobtide.operators.aggregates import any_true, count_where, exact_medians, merge_groups, scale_to_leader, sole_value
from jobtide.operators.quality import AcceptedValues, NonNegative, NotNull, Relationship, Unique, duplicates, run_checks
from jobtide.operators.tables import canonical_lines, diff_tables, orphans, reconcile
from jobtide.plans import marts, reporting

registry = Registry()


@registry.add("median_by_group", """
select p_type, count(*) as lines,
       cast(round_even(quantile_cont(l_extendedprice, 0.5), 0) as integer) as median_price,
       cast(round_even(quantile_cont(l_extendedprice, 0.5) filter (l_returnflag = 'R'), 0) as integer) as median_returned
from lineitem join part on p_partkey = l_partkey where l_extendedprice between 20000 and 250000
group by p_type having count(*) >= 30""")
def median_by_group(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_returnflag")
    priced = lines.filter(plausible(F.col("l_extendedprice"), 20_000, 250_000)).join(part, "l_partkey")
    price = F.col("l_extendedprice")
    returned = F.when(F.col("l_returnflag") == "R", price)
    sizes = priced.groupBy("p_type").agg(F.count("*").alias("lines"))
    both = merge_groups(["p_type"], sizes, exact_medians(priced, ["p_type"], {"a": price, "b": returned}))
    return both.filter("lines >= 30").select(
        "p_type", "lines", half_even_int(F.col("a")).alias("median_price"),
        half_even_int(F.col("b")).alias("median_returned"),
    )


@registry.add("median_wide_values", """
select l_returnflag, quantile_cont(l_extendedprice / 1e8, 0.5) as tiny, quantile_cont(l_extendedprice * 1e3 - 5e7, 0.5) as wide,
       quantile_cont(l_quantity, 0.5) as tied, count(*) as lines
from lineitem group by l_returnflag""")
def median_wide_values(spark, sf):
    """Groups far larger than the sketch's accuracy, with values from 0 to 0.001, of many millions, and of fifty distinct ones."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    price = F.col("l_extendedprice")
    mids = exact_medians(lines, ["l_returnflag"], {"tiny": price / 1e8, "wide": price * 1e3 - 5e7, "tied": F.col("l_quantity")}, accuracy=200)
    return merge_groups(["l_returnflag"], lines.groupBy("l_returnflag").agg(F.count("*").alias("lines")), mids).select(
        "l_returnflag", "tiny", "wide", "tied", "lines"
    )


@registry.add("median_of_all", """
select l_linestatus, quantile_cont(l_quantity, 0.5) as mid_quantity from lineitem group by 1""")
def median_of_all(spark, sf):
    return exact_medians(table(spark, sf, "lineitem"), ["l_linestatus"], {"mid_quantity": F.col("l_quantity")})


@registry.add("geo_stats", """
select coalesce(nullif(n_name, 'NATION_3'), 'Unknown') as city, c_mktsegment as region, count(*) as postings,
       count(*) filter (c_acctbal > 0) as home_office_postings,
       count(nullif(cast(c_acctbal * 30 as decimal(12,2)), 0)) as postings_with_salary,
       cast(round_even(quantile_cont(cast(cast(c_acctbal * 30 as decimal(12,2)) as double), 0.5)
            filter (cast(c_acctbal * 30 as decimal(12,2)) between 20000 and 250000), 0) as integer) as median_salary_from
from customer left join nation on n_nationkey = c_nationkey
group by 1, 2 having count(*) >= 2""")
def geo_stats(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    pay = (F.col("c_acctbal") * 30).cast("decimal(12,2)")
    people = table(spark, sf, "customer").join(nation, "c_nationkey", "left").select(
        F.nullif("n_name", F.lit("NATION_3")).alias("city"), F.col("c_mktsegment").alias("region"),
        (F.col("c_acctbal") > 0).alias("allows_home_office"), F.nullif(pay, F.lit(0)).alias("salary_from"),
    )
    return marts.city_stats(people)


@registry.add("group_flags", """
select o_custkey, bool_or(o_orderstatus = 'P') as any_pending,
       case when count(distinct o_orderpriority) = 1 then max(o_orderpriority) end as only_priority
from orders group by 1""")
def group_flags(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        any_true(F.col("o_orderstatus") == "P").alias("any_pending"),
        sole_value(F.col("o_orderpriority")).alias("only_priority"),
    )


@registry.add("scale_to_leader", """
select n_regionkey, n_name, customers,
       round(100.0::double * customers / max(customers) over (partition by n_regionkey), 1) as width
from (select n_regionkey, n_name, count(*) as customers from customer join nation on n_nationkey = c_nationkey
      group by all)""")
def scale_to_leader_nations(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    counted = table(spark, sf, "customer").join(nation, "c_nationkey").groupBy("n_regionkey", "n_name").agg(
        F.count("*").alias("customers")
    )
    return scale_to_leader(counted, "customers", "width", ["n_regionkey"])


@registry.add("three_slices", """
select o_orderpriority, count(*) as postings, count(*) filter (o_orderstatus = 'F') as first_part,
       count(*) filter (o_orderstatus = 'O') as second_part,
       count(*) - count(*) filter (o_orderstatus = 'F') - count(*) filter (o_orderstatus = 'O') as neither
from orders group by 1""")
def three_slices(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("postings"), count_where(F.col("o_orderstatus") == "F").alias("first_part"),
        count_where(F.col("o_orderstatus") == "O").alias("second_part"),
    )
    rest = reporting.neither(F.col("postings"), F.col("first_part"), F.col("second_part"))
    return counted.withColumn("neither", rest)


@registry.add("published_profile", """
select count(*) as total_postings, count(distinct cast(o_orderdate as date)) as run_count,
       min(cast(o_orderdate as date)) as first_run, max(cast(o_orderdate as date)) as last_run
from orders""")
def published_profile(spark, sf):
    return reporting.profile(table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("run_date")))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))


@registry.add("table_diff", """
with o as (select *, cast(o_orderdate as date) as day, cast(round(o_totalprice * 100) as bigint) as cents from orders),
     l as (select o_custkey, o_orderstatus, day, cents from o where o_orderpriority <> '1-URGENT'),
     r as (select o_custkey, o_orderstatus, day, cents from o where o_orderpriority <> '5-LOW'),
     d as (select 'left_only' as side, * from (select * from l except all select * from r)
           union all select 'right_only', * from (select * from r except all select * from l))
select side, cast(o_custkey as varchar) as o_custkey, o_orderstatus, cast(day as varchar) as day, cast(cents as varchar) as cents, count(*) as copies
from d group by side, o_custkey, o_orderstatus, day, cents""")
def table_diff(spark, sf):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = table(spark, sf, "orders").withColumns({"day": F.col("o_orderdate").cast("date"), "cents": cents})
    columns = ["o_custkey", "o_orderstatus", "day", "cents"]
    left = orders.filter("o_orderpriority <> '1-URGENT'").select(*columns)
    right = orders.filter("o_orderpriority <> '5-LOW'").select(*columns)
    return diff_tables(left, right).select("side", *columns, "copies")


@registry.add("canonical_dump", """
select concat_ws('|', c_custkey, c_name, coalesce(cast(nullif(c_nationkey, 3) as varchar), 'NULL'), c_mktsegment,
       cast(c_custkey // 2 as varchar) || case when c_custkey % 2 = 1 then '.5' else '' end) as line
from customer""")
def canonical_dump(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).alias("nation"), "c_mktsegment",
        (F.col("c_custkey") / 2).alias("half"),
    )
    return canonical_lines(rows)


@registry.add("reconcile_totals", """
select a.n as first_count, b.n as second_count
from (select o_custkey as n from orders where o_orderstatus = 'P' group by 1) a
full join (select o_custkey as n from orders where o_orderpriority = '5-LOW' group by 1) b on a.n = b.n
where a.n is null or b.n is null""")
def reconcile_totals(spark, sf):
    orders = table(spark, sf, "orders")
    first = orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("first_count")).distinct()
    second = orders.filter("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("second_count")).distinct()
    return reconcile(first, "first_count", second, "second_count")


@registry.add("orphans", """
select distinct d.doc_id from documents d where d.doc_id not in (select doc_id from labels)""")
def orphans_docs(spark, sf):
    return orphans(table(spark, sf, "documents").select("doc_id"), "doc_id", table(spark, sf, "labels"), "doc_id")


@registry.add("duplicate_keys", """
select o_custkey, cast(o_orderdate as date) as day, count(*) as rows_for_key from orders group by 1, 2 having count(*) > 1""")
def duplicate_keys(spark, sf):
    return duplicates(_orders(spark, sf), ["o_custkey", "day"])


CHECKS = [
    NotNull("orders", "o_custkey"), NotNull("part", "p_name"), NotNull("labels", "toxic"),
    NonNegative("customer", "c_acctbal"), NonNegative("orders", "o_totalprice"),
    AcceptedValues("orders", "o_orderstatus", ("O", "F")), AcceptedValues("documents", "lang", ("en", "de", "fr")),
    Unique("customer", ("c_custkey",)), Unique("part", ("p_name",)), Unique("orders", ("o_custkey", "o_orderdate")),
    Relationship("labels", "doc_id", "documents", "doc_id"), Relationship("documents", "doc_id", "labels", "doc_id"),
]


@registry.add("quality_violations", """
select 'not_null' as "check", 'orders' as table_name, 'o_custkey' as column_name, count(*) filter (o_custkey is null) as violations from orders
union all select 'not_null', 'part', 'p_name', count(*) filter (p_name is null) from part
union all select 'not_null', 'labels', 'toxic', count(*) filter (toxic is null) from labels
union all select 'non_negative', 'customer', 'c_acctbal', count(*) filter (c_acctbal < 0) from customer
union all select 'non_negative', 'orders', 'o_totalprice', count(*) filter (o_totalprice < 0) from orders
union all select 'accepted_values', 'orders', 'o_orderstatus', count(*) filter (o_orderstatus not in ('O', 'F')) from orders
union all select 'accepted_values', 'documents', 'lang', count(*) filter (lang not in ('en', 'de', 'fr')) from documents
union all select 'unique', 'customer', 'c_custkey', count(*) from (select 1 from customer group by c_custkey having count(*) > 1)
union all select 'unique', 'part', 'p_name', count(*) from (select 1 from part group by p_name having count(*) > 1)
union all select 'unique', 'orders', 'o_custkey,o_orderdate', count(*)
  from (select 1 from orders group by o_custkey, o_orderdate having count(*) > 1)
union all select 'relationships', 'labels', 'doc_id', count(*) from labels where doc_id not in (select doc_id from documents)
union all select 'relationships', 'documents', 'doc_id', count(*) from documents where doc_id not in (select doc_id from labels)""")
def quality_violations(spark, sf):
    names = {c.table for c in CHECKS}
    return run_checks({n: table(spark, sf, n) for n in names}, CHECKS)


def daily_marts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A frequency and a language table per day of events, as dated snapshots would hold them."""
    events = table(spark, sf, "events").withColumn("snapshot_date", F.col("ts").cast("date"))
    per_day = events.groupBy("snapshot_date").agg(
        F.count("*").alias("postings"), count_where(F.col("value") > 50).alias("high")
    )
    language = per_day.select(
        "snapshot_date", F.lit("ALL").alias("population"), "postings",
        share(F.col("high"), F.col("postings")).alias("pct_requires_german"),
    )
    counted = events.groupBy("snapshot_date", F.col("event_type").alias("skill_key")).agg(F.count("*").alias("n"))
    frequency = counted.join(per_day, "snapshot_date").select(
        "snapshot_date", "skill_key", share(F.col("n"), F.col("postings")).alias("pct_of_postings")
    )
    return frequency, language


DAILY_SQL = """
with e as (select *, cast(ts as date) as snapshot_date from events),
d as (select snapshot_date, count(*) as postings,
             round(100.0::double * count(*) filter (value > 50) / count(*), 1) as pct_requires_german
      from e group by 1),
f as (select e.snapshot_date, e.event_type as skill_key, round(100.0::double * count(*) / any_value(d.postings), 1)
             as pct_of_postings
      from e join d on d.snapshot_date = e.snapshot_date group by 1, 2)
"""


@registry.add("history_map", DAILY_SQL + """
select d.snapshot_date, d.postings, d.pct_requires_german, f.skill_key, f.pct_of_postings
from d join f on f.snapshot_date = d.snapshot_date""")
def history_map(spark, sf):
    """The daily map, spread out again so that rows can be compared."""
    days = reporting.history(*daily_marts(spark, sf))
    return days.select(
        "snapshot_date", "postings", "pct_requires_german", F.explode("skills").alias("skill_key", "pct_of_postings")
    )


@registry.add("history_span", DAILY_SQL + """
select min(snapshot_date) as first_date, max(snapshot_date) as latest_date, count(*) as days_tracked from d""")
def history_span(spark, sf):
    return reporting.tracked(reporting.history(*daily_marts(spark, sf)))


@registry.add("trend", DAILY_SQL + """
select *, lag(pct_of_postings) over (partition by skill_key order by snapshot_date) as previous_pct,
       round(pct_of_postings - lag(pct_of_postings) over (partition by skill_key order by snapshot_date), 1) as change
from f""")
def trend(spark, sf):
    return reporting.trend(daily_marts(spark, sf)[0])
