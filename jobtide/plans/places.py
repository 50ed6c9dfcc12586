"""Place names learned from the listings, and locations resolved against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.text import finds, finds_word, fold_german
from jobtide.operators.aggregates import any_true, sole_value
from jobtide.operators.phrases import longest_only, phrase_join
from jobtide.operators.ranking import first_per_key
from jobtide.session import settle

# Names made of anything else false-match in free text.
PLACE_NAME = "^[a-z0-9 .-]+$"
VERDICT = [
    "raw_location", "has_foreign_marker", "matches_german_place", "resolved_country", "resolved_city", "resolved_region",
]
# What may follow a place that opens a location; a hyphen separates only with spaces around it.
AFTER_PLACE = r"^ *(\z|[,;/|(]| - )"


def canonical_places(listings: DataFrame, home_country: str = fixed.HOME_COUNTRY) -> DataFrame:
    """Per folded name the spelling and state listed most often; ties fall by md5."""
    spellings = (
        listings.filter(F.col("city").isNotNull() & (F.col("country") == home_country))
        .groupBy(fold_german(F.col("city")).alias("city_norm"), "city", "region")
        .agg(F.count("*").alias("listed"))
    )
    region = F.coalesce("region", F.lit(""))
    order = [F.col("listed").desc(), F.md5("city"), F.md5(region), F.col("region").asc_nulls_last()]
    return first_per_key(spellings, ["city_norm"], order).select("city_norm", "city", "region")


def gazetteer(
    listings: DataFrame, aliases: DataFrame, min_chars: int = 4, home_country: str = fixed.HOME_COUNTRY
) -> DataFrame:
    """Folded name -> published city and state, with aliases for names not listed themselves."""
    listed = canonical_places(listings, home_country)
    homes = listed.select(F.col("city_norm").alias("home_norm"), "region")
    named = aliases.select(
        fold_german(F.col("alias")).alias("city_norm"), "city", fold_german(F.col("city")).alias("home_norm")
    )
    from_aliases = (
        named.join(homes, "home_norm", "left")
        .select("city_norm", "city", "region")
        .join(listed.select("city_norm"), "city_norm", "left_anti")
    )
    usable = (F.length("city_norm") >= min_chars) & finds(F.col("city_norm"), PLACE_NAME)
    return listed.unionByName(from_aliases).filter(usable)


def opens_with(text: Column, place: Column) -> Column:
    start = F.ltrim(text)
    rest = F.substring(start, F.length(place) + 1, F.length(start))
    return F.startswith(start, place) & F.rlike(rest, F.lit(AFTER_PLACE))


def place_matches(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Distinct folded texts with each place they name and whether they open with it."""
    found = phrase_join(texts, "loc_norm", places, "city_norm")
    return found.withColumn("is_leading", opens_with(F.col("loc_norm"), F.col("city_norm")))


def resolve_texts(texts: DataFrame, places: DataFrame, foreign_terms: list[str]) -> DataFrame:
    """Verdict per distinct folded text; several names published as one city count once."""
    # Looked at twice by the longest-match rule; taking a text apart is the costly step.
    matches = settle(place_matches(texts, places))
    named = (
        longest_only(matches, "loc_norm", places, "city_norm")
        .groupBy("loc_norm")
        .agg(
            any_true(F.col("is_leading")).alias("opens"),
            sole_value(F.col("city")).alias("only_city"),
            F.max("region").alias("a_region"),
        )
    )
    abroad = finds_word(F.col("loc_norm"), "|".join(foreign_terms))
    at_home = F.coalesce(F.col("opens").isNotNull(), F.lit(False))
    clear = ~F.col("has_foreign_marker") & F.col("opens") & F.col("only_city").isNotNull()
    return (
        texts.withColumn("has_foreign_marker", abroad)
        .join(named, "loc_norm", "left")
        .select(
            "loc_norm",
            "has_foreign_marker",
            at_home.alias("matches_german_place"),
            F.when(clear, F.col("only_city")).alias("resolved_city"),
            F.when(clear, F.col("a_region")).alias("resolved_region"),
        )
    )


def locate(
    board: DataFrame,
    places: DataFrame,
    foreign_terms: list[str] = fixed.FOREIGN_TERMS,
    home_country: str = fixed.HOME_COUNTRY,
) -> DataFrame:
    """Board rows with their verdict. A foreign marker beats a place; neither leaves country null.

    The same location text recurs over many postings and runs, so it is resolved once per distinct
    text and joined back. One text, such as none at all, may stand on a large part of the rows: the
    verdicts are written first, so that the join either broadcasts them, if their true size allows,
    or meets two plain shuffles, which AQE splits where a text is hot.
    """
    folded = board.withColumn("loc_norm", fold_german(F.coalesce("city", F.lit(""))))
    verdicts = settle(resolve_texts(folded.select("loc_norm").distinct(), places, foreign_terms))
    country = F.when(F.col("has_foreign_marker"), fixed.FOREIGN).when(
        F.col("matches_german_place"), home_country
    )
    return (
        folded.join(verdicts, "loc_norm", "left")
        .withColumn("resolved_country", country)
        .withColumnRenamed("city", "raw_location")
        .drop("loc_norm")
    )


def verdict_table(located: DataFrame) -> DataFrame:
    """Country and city per (posting_id, run_date), as a table of its own."""
    return located.select("posting_id", "run_date", *VERDICT)


def with_verdicts(board: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Board rows with a stored verdict table. Both keys count: a posting is judged anew each run."""
    return board.drop("city").join(verdicts, ["posting_id", "run_date"], "left")
