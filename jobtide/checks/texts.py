"""Text operators over whole documents, pages and conversations."""

from pyspark.sql import functions as F

from jobtide.checks import world as w
from jobtide.checks.base import Registry, table
from jobtide.functions.json import json_array_size, json_text
from jobtide.functions.numbers import blank_to_null, share
from jobtide.functions.text import finds_word, fold_german, has_text
from jobtide.operators.aggregates import by_group_and_all, count_where
from jobtide.operators.dictionary import dictionary_match
from jobtide.operators.flags import in_country, in_scope
from jobtide.operators.phrases import phrase_join
from jobtide.operators.ranking import By, number_rows
from jobtide.params import Params, ScopeRules
from jobtide.plans import audits, marts, reporting
from jobtide.session import local_frame

registry = Registry()
def _documents(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("posting_id"), "source", F.col("text").alias("description"), "lang", "n_chars"
    )


def _found_sql(select: str, grouped: bool = True, minimum: int = 200, keys: list[str] | None = None) -> str:
    return f"""with {w.WORDS_SQL},
mention as materialized (
  select f.doc_id as posting_id, f.source, f.text, w.skill_key, w.display_name, w.category, w.pattern
  from {w.found_sql('documents', 'text', grouped, keys)} f join word w on w.skill_key = f.skill_key
  where length(f.text) > {minimum}
)
{select}"""


FREQUENCY = """, total as (select count(*) as n from documents where length(text) > 200)
select skill_key, display_name, category, count(distinct posting_id) as postings, any_value(n) as postings_with_text,
       round(100.0::double * count(distinct posting_id) / nullif(any_value(n), 0), 1) as pct_of_postings
from mention, total group by 1, 2, 3"""
MENTION = "select posting_id, source, skill_key, display_name, category from mention"


@registry.add("word_match_dictionary", _found_sql(MENTION))
def word_match_dictionary(spark, sf):
    return marts.mentions(_documents(spark, sf), w.words(spark))


@registry.add("word_match_dictionary_ungrouped", _found_sql(MENTION, grouped=False))
def word_match_dictionary_ungrouped(spark, sf):
    return marts.mentions(_documents(spark, sf), w.words(spark), grouped=False)


@registry.add("word_match_by_phrases", _found_sql("select posting_id, skill_key, pattern from mention", minimum=-1))
def word_match_by_phrases(spark, sf):
    """The whole dictionary over all texts, short ones too, with the pattern that was found."""
    dictionary = local_frame(spark, [(k, p) for k, _, _, p in w.WORDS], "skill_key string, pattern string")
    texts = _documents(spark, sf).select("posting_id", "description")
    return dictionary_match(texts, "description", dictionary, "skill_key", "pattern")


REPEATED = [("licence", "mit"), ("licence", "apache"), ("article", "der"), ("article", "the"), ("article", "the"), ("for", "für|for")]


@registry.add("word_match_repeated_keys", rf"""
with word(skill_key, pattern) as (values {", ".join(str(r) for r in REPEATED)})
select doc_id, skill_key, pattern from documents
join word on regexp_matches(text, '(^|[^\pL\pN_])(' || pattern || ')([^\pL\pN_]|$)', 'i')""")
def word_match_repeated_keys(spark, sf):
    dictionary = local_frame(spark, REPEATED, "skill_key string, pattern string")
    texts = table(spark, sf, "documents").select("doc_id", "text")
    return dictionary_match(texts, "text", dictionary, "skill_key", "pattern")


LONG = 600
ODD = [("odd1", "licen[cs]e"), ("odd2", "über|für"), ("odd3", "mit|apache")]


@registry.add("word_match_long_dictionary", rf"""
with spelled as (
  select distinct doc_id, unnest(regexp_extract_all(lower(text), '[\pL\pN_]+')) as term from documents
), term as (
  select term from spelled where regexp_full_match(term, '[a-zäöü]{{3,}}') group by term order by count(*) desc, term limit {LONG}
), odd(skill_key, pattern) as (values {", ".join(str(r) for r in ODD)})
select doc_id, term as skill_key, term as pattern from spelled join term using (term)
union all select doc_id, p_name, p_name
from (select distinct p_name, lower(regexp_extract(p_name, '[\pL\pN_]+')) as term from part) join spelled using (term)
join documents using (doc_id)
where contains(lower(text), lower(p_name)) and regexp_matches(text, '(^|[^\pL\pN_])' || p_name || '([^\pL\pN_]|$)', 'i')
union all select doc_id, skill_key, pattern from documents
join odd on regexp_matches(text, '(^|[^\pL\pN_])' || pattern || '([^\pL\pN_]|$)', 'i')""")
def word_match_long_dictionary(spark, sf):
    """The most frequent words, all names of parts and a few other patterns, without grouping."""
    texts = table(spark, sf, "documents").select("doc_id", "text")
    spelled = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))).alias("term"))
    counted = spelled.filter(F.col("term").rlike("^[a-zäöü]{3,}$")).groupBy("term").count()
    terms = counted.orderBy(F.col("count").desc(), "term").limit(LONG).select("term")
    terms = terms.unionByName(table(spark, sf, "part").select(F.col("p_name").alias("term")).distinct())
    dictionary = terms.select(F.col("term").alias("skill_key"), F.col("term").alias("pattern"))
    dictionary = dictionary.unionByName(local_frame(spark, ODD, "skill_key string, pattern string"))
    return dictionary_match(texts, "text", dictionary, "skill_key", "pattern", grouped=False)


@registry.add("skill_frequency_docs", _found_sql(FREQUENCY))
def skill_frequency_docs(spark, sf):
    documents = _documents(spark, sf)
    return marts.skill_frequency(documents, marts.mentions(documents, w.words(spark)))


@registry.add("skill_frequency_docs_ungrouped", _found_sql(FREQUENCY, grouped=False))
def skill_frequency_docs_ungrouped(spark, sf):
    documents = _documents(spark, sf)
    return marts.skill_frequency(documents, marts.mentions(documents, w.words(spark), grouped=False))


@registry.add("dashboard_ranked_skills", "with f as (" + _found_sql(FREQUENCY) + """)
select row_number() over (order by pct_of_postings desc, postings desc, skill_key) as position, skill_key,
       display_name, category, pct_of_postings,
       round(pct_of_postings / nullif(max(pct_of_postings) over (), 0) * 100, 1) as width,
       round(pct_of_postings / nullif(max(pct_of_postings) over (partition by category), 0) * 100, 1)
           as width_in_category,
       row_number() over (order by pct_of_postings desc, postings desc, skill_key) <= 15 as shown
from f""")
def dashboard_ranked_skills(spark, sf):
    return reporting.ranked_skills(skill_frequency_docs(spark, sf))


@registry.add("dashboard_top_skills", _found_sql(FREQUENCY) + " order by postings desc, skill_key limit 15")
def dashboard_top_skills(spark, sf):
    return skill_frequency_docs(spark, sf).limit(Params.top_skills)


@registry.add("dashboard_categories", _found_sql("select distinct category from mention"))
def dashboard_categories(spark, sf):
    return reporting.categories(skill_frequency_docs(spark, sf))


@registry.add("pattern_risk", _found_sql("""
select skill_key, pattern, cast(length(pattern) as integer) as pattern_len, count(distinct posting_id) as postings
from mention group by 1, 2, 3 order by pattern_len, postings desc, skill_key limit 15""", minimum=-1))
def pattern_risk(spark, sf):
    return audits.pattern_risk(_documents(spark, sf), w.words(spark))


RISKY = ["the", "license", "by_nc", "ring", "mit"]


@registry.add("kwic_sample", _found_sql(r"""
, sampled as (
  select *, row_number() over (partition by skill_key order by posting_id, source) as rn from mention
)
select skill_key, replace(regexp_extract(lower(text),
       '(?s)((?:.{0,44}[^\pL\pN_]|^)(?:' || pattern || ')(?:[^\pL\pN_].{0,44}|$))', 1), chr(10), ' ') as context
from sampled where rn <= 4""", minimum=-1, keys=RISKY))
def kwic_sample(spark, sf):
    return audits.keyword_in_context(_documents(spark, sf), w.words(spark), RISKY)


@registry.add("norm_fold_docs", """
select doc_id, md5(lower(replace(translate(text, 'äöüÄÖÜ', 'aouAOU'), 'ß', 'ss'))) as digest from documents""")
def norm_fold_docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(fold_german(F.col("text"))).alias("digest"))


SCOPE = ScopeRules(
    include="(?:license|tion|ung)", exclude="(?:apache|sche?n)", noise="mit license", head="the[ /&-]*(?:on|of)",
    home_country="en",
)


@registry.add("scope_flags_docs", """
select doc_id, source,
       regexp_matches(text, '(license|tion|ung)', 'i') and not regexp_matches(text, '(apache|sche?n)', 'i')
       and not (regexp_matches(text, 'mit license', 'i') and not regexp_matches(text, 'the[ /&-]*(on|of)', 'i'))
           as in_scope,
       nullif(lang, 'de') = 'en' as country_known, length(text) > 200 as has_text
from documents""")
def scope_flags_docs(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", "source", in_scope(text, SCOPE).alias("in_scope"),
        in_country(F.nullif("lang", F.lit("de")), SCOPE.home_country).alias("country_known"),
        has_text(text, 200).alias("has_text"),
    )


@registry.add("whole_word_docs", rf"""
select lang, count(*) as documents,
       count(*) filter (regexp_matches(text, '(^|[^\pL\pN_])(der|über|el)([^\pL\pN_]|$)', 'i')) as found
from documents group by lang""")
def whole_word_docs(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.count("*").alias("documents"), count_where(finds_word(F.col("text"), "der|über|el")).alias("found")
    )


@registry.add("share_with_all_row", """
with c as (
  select lang as population, count(*) as postings, count(*) filter (regexp_matches(text, 'license', 'i')) as licensed
  from documents where length(text) > 200 group by lang
), r as (
  select * from c where postings >= 150
  union all select 'ALL', cast(coalesce(sum(postings), 0) as bigint), cast(coalesce(sum(licensed), 0) as bigint) from c
)
select *, round(100.0::double * licensed / nullif(postings, 0), 1) as pct_licensed from r""")
def share_with_all_row(spark, sf):
    texts = table(spark, sf, "documents").filter(has_text(F.col("text"), 200))
    counts = {"postings": F.count("*"), "licensed": count_where(F.col("text").rlike("(?i)license"))}
    rows = by_group_and_all(texts, "lang", counts, "postings", 150, "population")
    return rows.withColumn("pct_licensed", share(F.col("licensed"), F.col("postings")))


@registry.add("dedup_documents", """
select doc_id, source, row_number() over (
         partition by lower(text) order by case when source = 'src0' then 0 else 1 end, n_chars desc nulls last, doc_id
       ) as dedup_rank
from documents""")
def dedup_documents(spark, sf):
    """Ranks within copies of a text; a digest stands for the text so that it is not shuffled."""
    keyed = table(spark, sf, "documents").select(
        "doc_id", "source", "n_chars", F.sha2(F.lower("text"), 256).alias("text_key")
    )
    order = [By(F.when(F.col("source") == "src0", 0).otherwise(1)), By(F.col("n_chars"), down=True, nulls_last=True), By(F.col("doc_id"))]
    return number_rows(keyed, ["text_key"], order, "dedup_rank", Params.hot_rows).select("doc_id", "source", "dedup_rank")


@registry.add("json_text_events", """
select event_id, json_extract_string(props, '$.k') as k, cast(json_extract_string(props, '$.k') as integer) > 50 as high,
       json_extract_string(props, '$.missing') as missing,
       nullif(case when json_extract_string(props, '$.k') = '0' then '' else json_extract_string(props, '$.k') end, '')
           as filled
from events""")
def json_text_events(spark, sf):
    k = json_text(F.col("props"), "k")
    return table(spark, sf, "events").select(
        "event_id", k.alias("k"), (k.cast("int") > 50).alias("high"),
        json_text(F.col("props"), ["missing"]).alias("missing"),
        blank_to_null(F.when(k == "0", "").otherwise(k)).alias("filled"),
    )


@registry.add("json_array_len_conv", """
select conv_id, turn, cast(turn as integer) as turns, case when turn > 1 then role end as second_role,
       cast(null as integer) as absent
from conversations""")
def json_array_len_conv(spark, sf):
    """A document per turn whose array has as many entries as the turn's number."""
    entries = F.array_repeat(F.struct("role", F.col("turn").alias("at")), F.col("turn").cast("int"))
    docs = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.to_json(F.struct(entries.alias("turns"))).alias("body")
    )
    body = F.col("body")
    return docs.select(
        "conv_id", "turn", json_array_size(body, "turns").alias("turns"),
        json_text(body, ["turns", 1, "role"]).alias("second_role"), json_array_size(body, "absent").alias("absent"),
    )


@registry.add("phrases_in_part_names", r"""
with name as (select distinct p_name from part),
term as (
  select distinct p_name as term from part where p_type in ('STANDARD', 'PROMO')
  union select distinct unnest(string_split(p_name, ' ')) from part
)
select n.p_name, t.term from name n join term t
  on contains(n.p_name, t.term)
where regexp_matches(n.p_name, '(^|[^\pL\pN_])' || t.term || '([^\pL\pN_]|$)')""")
def phrases_in_part_names(spark, sf):
    part = table(spark, sf, "part")
    whole = part.filter(F.col("p_type").isin("STANDARD", "PROMO")).select(F.col("p_name").alias("term"))
    single = part.select(F.explode(F.split("p_name", " ")).alias("term"))
    return phrase_join(part.select("p_name").distinct(), "p_name", whole.union(single).distinct(), "term")
