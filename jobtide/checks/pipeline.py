"""The whole pipeline on postings derived from the given tables, model by model."""

from pyspark.sql import functions as F

from jobtide.checks import world as w
from jobtide.checks.base import Registry
from jobtide.functions.text import fold_german
from jobtide.operators.quality import growing_stages, tail_mismatch
from jobtide.operators.phrases import longest_only
from jobtide.plans import audits, marts, reporting
from jobtide.plans.places import place_matches, with_verdicts
from jobtide.plans.postings import PUBLISHED_COLUMNS, published_rows
from jobtide.session import settle

registry = Registry()
SCORED = [
    "posting_id", "source", "run_date", "title", "employer", "city", "region", "country", "salary_from", "salary_to",
    "is_full_time", "published_at", "allows_home_office", "is_temp_agency", "requires_german", "mentions_english",
    "description_length", "title_in_scope", "country_known", "run_rank", "days_since_latest_run",
    "still_advertised", "dedup_rank", "has_description",
]
LISTING = [
    "posting_id", "run_date", "search_term", "title", "occupation", "employer", "is_full_time", "salary_from",
    "salary_to", "city", "region", "country", "published_at",
]


@registry.add("staged_listings", w.with_sql(w.EVENTS_SQL, select=f"select {', '.join(LISTING)}, 1 as location_count from listing"))
def staged_listings(spark, sf):
    return w.World(spark, sf).listings.select(*LISTING, "location_count")


@registry.add("staged_details", w.with_sql(w.EVENTS_SQL, select="""
select posting_id, run_date, md5(description) as digest, allows_home_office, is_temp_agency from detail"""))
def staged_details(spark, sf):
    return w.World(spark, sf).details.select(
        "posting_id", "run_date", F.md5("description").alias("digest"), "allows_home_office", "is_temp_agency"
    )


@registry.add("staged_board", w.with_sql(w.EVENTS_SQL, select="""
select posting_id, run_date, title, employer, md5(description) as digest, location as city, allows_home_office,
       published_at from offer"""))
def staged_board(spark, sf):
    return w.World(spark, sf).board.select(
        "posting_id", "run_date", "title", "employer", F.md5("description").alias("digest"), "city",
        "allows_home_office", "published_at",
    )


@registry.add("staged_runs", w.with_sql(w.EVENTS_SQL, select="""
select source as source_name, run_date, cast(rows_read as integer) as rows_read,
       cast(duplicates_collapsed as integer) as duplicates_collapsed, 'ergebnisliste' as results_key from run"""))
def staged_runs(spark, sf):
    return w.World(spark, sf).runs


@registry.add("gazetteer_events", w.with_sql(w.EVENTS_SQL, w.PLACES_SQL, select="select * from places"))
def gazetteer_events(spark, sf):
    return w.World(spark, sf).places()


@registry.add("location_verdicts", w.with_sql(w.EVENTS_SQL, w.PLACES_SQL, w.VERDICTS_SQL, select="select * from verdict"))
def location_verdicts(spark, sf):
    return w.World(spark, sf).verdicts()


@registry.add("board_with_verdicts", w.with_sql(w.EVENTS_SQL, w.PLACES_SQL, w.VERDICTS_SQL, select="""
select o.posting_id, o.run_date, o.title, v.raw_location, v.resolved_country, v.resolved_city
from offer o left join verdict v on v.posting_id = o.posting_id and v.run_date = o.run_date"""))
def board_with_verdicts(spark, sf):
    world = w.World(spark, sf)
    return with_verdicts(world.narrow_board, settle(world.verdicts())).select(
        "posting_id", "run_date", "title", "raw_location", "resolved_country", "resolved_city"
    )


@registry.add("scored_events", w.with_sql(*w.TO_SCORED, select=f"select {', '.join(SCORED)}, md5(description) as digest from scored"))
def scored_events(spark, sf):
    return w.World(spark, sf).score().select(*SCORED, F.md5("description").alias("digest"))


PUBLISHED = [c for c in PUBLISHED_COLUMNS if c != "description"]
PUBLISHED_SQL = w.with_sql(*w.TO_SCORED, select=f"select {', '.join(PUBLISHED)}, md5(description) as digest from kept")


@registry.add("published_events", PUBLISHED_SQL)
def published_events(spark, sf):
    return w.World(spark, sf).publish().select(*PUBLISHED, F.md5("description").alias("digest"))


@registry.add("published_from_scored", PUBLISHED_SQL)
def published_from_scored(spark, sf):
    world = w.World(spark, sf)
    return published_rows(world.narrow_scored(), world.texts).select(*PUBLISHED, F.md5("description").alias("digest"))


@registry.add("mentions_events", w.with_sql(*w.TO_MENTIONS, select="select * from mention"))
def mentions_events(spark, sf):
    world = w.World(spark, sf)
    return marts.mentions(world.published(), world.skills)


@registry.add("skill_frequency_events", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, select="select * from frequency"))
def skill_frequency_events(spark, sf):
    world = w.World(spark, sf)
    postings = world.published()
    return marts.skill_frequency(postings, world.mentions(postings))


@registry.add("salary_by_skill_events", w.with_sql(*w.TO_MENTIONS, w.SALARY_SQL, select="select * from salary"))
def salary_by_skill_events(spark, sf):
    world = w.World(spark, sf)
    postings = world.published()
    return marts.salary_by_skill(postings, world.mentions(postings))


@registry.add("city_stats_events", w.with_sql(*w.TO_SCORED, w.CITIES_SQL, select="select * from cities"))
def city_stats_events(spark, sf):
    return marts.city_stats(w.World(spark, sf).published())


@registry.add("language_requirement_events", w.with_sql(*w.TO_SCORED, w.LANGUAGE_SQL, select="select * from language"))
def language_requirement_events(spark, sf):
    return marts.language_requirement(w.World(spark, sf).published())


@registry.add("funnel_events", w.with_sql(*w.TO_SCORED, w.FUNNEL_SQL, select="select * from funnel"))
def funnel_events(spark, sf):
    world = w.World(spark, sf)
    return marts.pipeline_funnel(world.scored(), world.runs)


@registry.add("funnel_is_monotonic", w.with_sql(*w.TO_SCORED, w.FUNNEL_SQL, select="""
select stage_order, previous_stage, previous_records, stage, records from (
  select *, lag(stage) over (order by stage_order) as previous_stage,
         lag(records) over (order by stage_order) as previous_records from funnel)
where records > previous_records"""))
def funnel_is_monotonic(spark, sf):
    return growing_stages(funnel_events(spark, sf))


@registry.add("funnel_tail_matches", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, w.FUNNEL_SQL, select="""
select f.records as funnel_tail, p.postings_with_text as published_denominator
from (select records from funnel where stage_order = 8) f
full join (select distinct postings_with_text from frequency) p on p.postings_with_text = f.records
where f.records is null or p.postings_with_text is null"""))
def funnel_tail_matches(spark, sf):
    return tail_mismatch(funnel_events(spark, sf), skill_frequency_events(spark, sf))


@registry.add("funnel_growth_found", w.with_sql(*w.TO_SCORED, w.FUNNEL_SQL, select="""
select stage_order, previous_stage, previous_records, stage, records from (
  select stage_order, stage, grown as records, lag(stage) over (order by stage_order) as previous_stage,
         lag(grown) over (order by stage_order) as previous_records
  from (select *, case when stage_order in (4, 7) then records + 1000000 else records end as grown from funnel))
where records > previous_records"""))
def funnel_growth_found(spark, sf):
    """The rule on a funnel in which two stages have grown."""
    grown = F.when(F.col("stage_order").isin(4, 7), F.col("records") + 1000000).otherwise(F.col("records"))
    return growing_stages(funnel_events(spark, sf).withColumn("records", grown))


@registry.add("funnel_tail_mismatch_found", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, w.FUNNEL_SQL, select="""
select f.records as funnel_tail, p.postings_with_text as published_denominator
from (select records + 1 as records from funnel where stage_order = 8) f
full join (select distinct postings_with_text from frequency) p on p.postings_with_text = f.records"""))
def funnel_tail_mismatch_found(spark, sf):
    """The rule on a funnel whose last stage is one off."""
    off = funnel_events(spark, sf).withColumn("records", F.col("records") + 1)
    return tail_mismatch(off, skill_frequency_events(spark, sf))


SCOPE_SQL = """
scope as (
  select posting_id, source, run_date, title, employer, city, lower(coalesce(employer, '')) as ek, lower(title) as tk
  from scored where title_in_scope and country_known and run_rank = 1
)"""


@registry.add("audit_merge_types", w.with_sql(*w.TO_SCORED, SCOPE_SQL, select="""
select merge_type, count(*) as groups, cast(sum(n) as bigint) as rows_involved,
       cast(sum(n) - count(*) as bigint) as rows_dropped
from (select count(*) as n,
             case when count(*) = 1 then 'unique (not merged)'
                  when count(distinct source) > 1 then 'merged ACROSS sources'
                  when count(distinct coalesce(city, '?')) > 1 then 'merged within one source, DIFFERENT cities'
                  else 'merged within one source, same city' end as merge_type
      from scope group by ek, tk)
group by merge_type"""))
def audit_merge_types(spark, sf):
    return audits.merge_types(audits.audit_scope(w.World(spark, sf).scored()))


@registry.add("audit_split_whatif", w.with_sql(*w.TO_SCORED, SCOPE_SQL, select="""
select case when s > 1 then 'across sources - risks double counting'
            else 'within one source - likely real vacancies' end as split_type,
       count(*) as groups_that_would_split, cast(sum(c) - count(*) as bigint) as postings_recovered
from (select count(*) as n, count(distinct source) as s, count(distinct lower(coalesce(city, ''))) as c
      from scope group by ek, tk)
where n > 1 and c > 1 group by 1"""))
def audit_split_whatif(spark, sf):
    return audits.split_whatif(audits.audit_scope(w.World(spark, sf).scored()))


@registry.add("audit_cross_source_spans", w.with_sql(*w.TO_SCORED, """
loose as (
  select source, lower(employer) as employer, lower(title) as title, city
  from scored where title_in_scope and country_known and run_rank = 1
)""", select="""
select left(employer, 30) as employer, left(title, 34) as title, count(*) as rows,
       left(array_to_string(list_sort(list(distinct source || ':' || coalesce(city, '?'))), ' | '), 58)
           as source_and_city
from loose group by loose.employer, loose.title
having count(distinct source) > 1 and count(distinct lower(coalesce(city, ''))) > 1
order by count(*) desc, loose.employer nulls first, loose.title nulls first limit 20"""))
def audit_cross_source_spans(spark, sf):
    scope = audits.audit_scope(w.World(spark, sf).scored())
    folded = scope.withColumns({"employer": F.lower("employer"), "title": F.lower("title")})
    return audits.cross_source_spans(folded)


@registry.add("audit_within_source_spans", w.with_sql(*w.TO_SCORED, SCOPE_SQL, select="""
select left(employer, 30) as employer, left(title, 34) as title, count(*) as rows,
       count(distinct lower(coalesce(city, ''))) as cities,
       left(array_to_string(list_sort(list(distinct coalesce(city, '?'))), ', '), 48) as city_list
from scope group by scope.employer, scope.title
having count(*) > 1 and count(distinct source) = 1 and count(distinct lower(coalesce(city, ''))) > 1
order by cities desc, rows desc, scope.employer nulls first, scope.title nulls first limit 20"""))
def audit_within_source_spans(spark, sf):
    return audits.within_source_spans(audits.audit_scope(w.World(spark, sf).scored()))


@registry.add("audit_text_verdict", w.with_sql(*w.TO_SCORED, SCOPE_SQL, select="""
select case when t < n then 'some rows carry no text - undecidable'
            when d = 1 then 'IDENTICAL text - one vacancy, many sites'
            else 'different text - genuinely separate vacancies' end as verdict,
       count(*) as groups, cast(sum(c) - count(*) as bigint) as postings_recovered_if_split
from (select count(*) as n, count(distinct lower(coalesce(s.city, ''))) as c, count(x.description) as t,
             count(distinct x.description) as d
      from scope s left join newest_detail x on x.posting_id = s.posting_id group by ek, tk)
where n > 1 and c > 1 group by 1"""))
def audit_text_verdict(spark, sf):
    world = w.World(spark, sf)
    return audits.text_verdict(audits.audit_scope(world.scored()), world.details)


@registry.add("audit_dropped_by_source", w.with_sql(*w.TO_SCORED, select="""
select source, count(*) as total, count(*) filter (title_in_scope) as kept,
       count(*) filter (not title_in_scope) as dropped,
       count(*) filter (not title_in_scope and regexp_matches(title, '(widget|rod)', 'i'))
           as dropped_but_german_data_word
from scored where run_rank = 1 group by source"""))
def audit_dropped_by_source(spark, sf):
    return audits.dropped_by_source(w.World(spark, sf).scored(), "(?:widget|rod)")


@registry.add("audit_dropped_titles", w.with_sql(*w.TO_SCORED, select="""
select distinct left(title, 62) as dropped_title from scored
where source = 'arbeitsagentur' and not title_in_scope order by 1 limit 30"""))
def audit_dropped_titles(spark, sf):
    return audits.dropped_titles(w.World(spark, sf).scored())


@registry.add("audit_surviving_locations", w.with_sql(*w.TO_SCORED, select="""
select left(city, 40) as location, count(*) as postings from kept where source = 'arbeitnow'
group by 1 order by 2 desc, 1 nulls last limit 40"""))
def audit_surviving_locations(spark, sf):
    return audits.surviving_locations(w.World(spark, sf).published())


@registry.add("headline_events", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, w.LANGUAGE_SQL, """
named as (
  select *, row_number() over (order by postings desc, skill_key) as place
  from frequency where skill_key in ('the', 'of_the', 'in_the')
)""".replace("named", "top_named"), select="""
select l.postings as with_text, l.pct_requires_german, l.pct_english_without_german,
       round(100.0::double * (l.postings - l.requires_german - l.english_without_german) / nullif(l.postings, 0), 1)
           as pct_neither,
       p.*, a.display_name as leader, b.display_name as second, a.pct_of_postings as leader_pct,
       b.pct_of_postings as second_pct,
       case when b.pct_of_postings = 0 then 0.0 else round(a.pct_of_postings / b.pct_of_postings, 1) end as ratio
from language l,
     (select count(*) as total_postings, count(distinct run_date) as run_count, min(run_date) as first_run,
             max(run_date) as last_run from kept) p
     left join top_named a on a.place = 1 left join top_named b on b.place = 2
where l.population = 'ALL'"""))
def headline_events(spark, sf):
    world = w.World(spark, sf)
    postings = world.published()
    frequency = marts.skill_frequency(postings, world.mentions(postings))
    return reporting.headline(marts.language_requirement(postings), frequency, postings, ["the", "of_the", "in_the"])


@registry.add("leaders_events", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, select="""
select * from frequency where skill_key in ('the', 'of_the', 'in_the')"""))
def leaders_events(spark, sf):
    return reporting.leaders(skill_frequency_events(spark, sf), ["the", "of_the", "in_the"])


@registry.add("dashboard_kpis", w.with_sql(*w.TO_MENTIONS, w.FREQUENCY_SQL, w.LANGUAGE_SQL, w.CITIES_SQL, select="""
select 'Currently advertised' as tile, cast(postings as double) as value from language where population = 'ALL'
union all select 'Require German', pct_requires_german from language where population = 'ALL'
union all select 'Tools tracked', cast(count(*) as double) from frequency
union all select 'Cities hiring', cast(count(*) as double) from cities"""))
def dashboard_kpis(spark, sf):
    world = w.World(spark, sf)
    postings = world.published()
    frequency = marts.skill_frequency(postings, world.mentions(postings))
    return reporting.kpis(marts.language_requirement(postings), frequency, marts.city_stats(postings))


@registry.add("dashboard_language_split", w.with_sql(*w.TO_SCORED, w.LANGUAGE_SQL, select="""
select 'Requires German' as slice, pct_requires_german as pct from language where population = 'ALL'
union all select 'English, no German required', pct_english_without_german from language where population = 'ALL'
union all select 'Neither stated', round(100.0::double - pct_requires_german - pct_english_without_german, 1)
from language where population = 'ALL'"""))
def dashboard_language_split(spark, sf):
    return reporting.language_split(language_requirement_events(spark, sf))


@registry.add("dashboard_funnel_bars", w.with_sql(*w.TO_SCORED, w.FUNNEL_SQL, select="""
select stage_order, replace(stage, '_', ' ') as label, records,
       round(cast(records as double) / nullif(max(case when stage_order = 1 then records end) over (), 0) * 100, 2)
           as width,
       pct_of_first, grain_changes_here as unit_break
from funnel"""))
def dashboard_funnel_bars(spark, sf):
    return reporting.funnel_bars(funnel_events(spark, sf))


@registry.add("dashboard_top_cities", w.with_sql(*w.TO_SCORED, w.CITIES_SQL, select="""
select city, lower(region) as region, postings, home_office_postings, postings_with_salary, median_salary_from
from cities order by postings desc, city, region nulls last limit 12"""))
def dashboard_top_cities(spark, sf):
    return reporting.top_cities(city_stats_events(spark, sf))


@registry.add("dashboard_salary_ranking", w.with_sql(*w.TO_MENTIONS, w.SALARY_SQL, select="""
select skill_key, display_name, category, median_salary_from, median_salary_to, postings_with_salary from salary"""))
def dashboard_salary_ranking(spark, sf):
    return reporting.salary_ranking(salary_by_skill_events(spark, sf))


def _board_texts(world):
    return world.narrow_board.select(fold_german(F.coalesce("city", F.lit(""))).alias("loc_norm")).distinct()


@registry.add("place_matches_events", w.with_sql(w.EVENTS_SQL, w.PLACES_SQL, w.VERDICTS_SQL, select="""
select loc as loc_norm, city_norm, city, region, at_start as is_leading from hit"""))
def place_matches_events(spark, sf):
    world = w.World(spark, sf)
    return place_matches(_board_texts(world), settle(world.places()))


@registry.add("longest_places_events", w.with_sql(w.EVENTS_SQL, w.PLACES_SQL, w.VERDICTS_SQL, select="""
select loc as loc_norm, city_norm, city, region, at_start as is_leading from long_hit"""))
def longest_places_events(spark, sf):
    world = w.World(spark, sf)
    places = settle(world.places())
    return longest_only(place_matches(_board_texts(world), places), "loc_norm", places, "city_norm")
