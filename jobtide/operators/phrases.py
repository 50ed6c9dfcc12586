"""Finding many phrases in many texts as an equi-join on word sequences.

A phrase occurs as whole words exactly when some run of consecutive words of the text, separators
included, spells it. Both sides are therefore reduced to such runs and joined by equality, which
Spark can hash, shuffle and split; no text is ever compared with every phrase. An index of the
phrases' first words and lengths, of a fixed size, goes to the texts: runs that start no phrase are
not put together and never leave their task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import NOT_WORD, WORD, WORD_END, WORD_START

# Longs in the index of phrase beginnings: 64 KiB, whatever the number of phrases. A full index only lets more runs through.
SLOTS = 8192


def _pieces(text: Column) -> Column:
    """Words and separators in turn."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}+|{NOT_WORD}+"), F.lit(0))


def _core(phrase: Column) -> Column:
    """The phrase from its first to its last word character."""
    return F.regexp_extract(phrase, rf"(?s){WORD}(?:.*{WORD})?", 0)


def _bit(word: Column, pieces: Column) -> Column:
    """The place of a first word and a number of pieces in the index."""
    return F.pmod(F.xxhash64(word, pieces.cast("int")), F.lit(SLOTS * 64))


def _index(phrases: DataFrame, core: str) -> DataFrame:
    """One row: the most pieces of a phrase, and a fixed number of bits that say which first words
    may start a phrase of which number of pieces."""
    starts = phrases.select(_pieces(F.col(core)).alias("p")).select(F.col("p")[0].alias("word"), F.size("p").alias("pieces")).distinct()
    bits = starts.select("pieces", _bit(F.col("word"), F.col("pieces")).alias("bit")).groupBy(
        F.shiftright("bit", 6).alias("slot")
    ).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"), F.max("pieces").alias("pieces"))
    slots = phrases.sparkSession.range(SLOTS).withColumnRenamed("id", "slot").join(bits, "slot", "left")
    rows = F.array_sort(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0)).alias("bits"))))
    return slots.agg(F.struct(F.coalesce(F.max("pieces"), F.lit(0)).alias("widest"), F.transform(rows, lambda r: r["bits"]).alias("bits")))


def _word_runs(pieces: Column, index: Column) -> Column:
    """Distinct runs of pieces (words and the separators between them) that may be a phrase.

    A run is only put together where its first word starts some phrase of that many pieces. `pieces`
    and `index` have to be columns of their own: a lambda would work out an expression anew per element.
    """
    size = F.size(pieces)

    def may_start(word: Column, n: Column) -> Column:
        bit = _bit(word, n)
        return F.getbit(F.get(index["bits"], F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1

    def runs_from(piece: Column, i: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.least(index["widest"], size - i), F.lit(2))
        kept = F.filter(lengths, lambda n: may_start(piece, n))
        runs = F.transform(kept, lambda n: F.array_join(F.slice(pieces, i + 1, n), ""))
        return F.when(F.rlike(piece, F.lit(f"^{WORD}")) & (index["widest"] > 0), runs).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.transform(pieces, runs_from)))


def phrase_join(
    texts: DataFrame, text: str, phrases: DataFrame, phrase: str, key: str | None = None
) -> DataFrame:
    """All pairs of a text and a phrase it contains as whole words.

    `texts` has one row per distinct text. Short texts are their own key; long ones should come with
    a short `key` column, which is then all that travels, and phrases that begin and end in a word
    character. The result has the key (or text) and all phrase columns.
    """
    identity = key or text
    keyed = phrases.withColumn("__core", _core(F.col(phrase))).filter(F.col("__core") != "")
    index = _index(keyed, "__core").scalar()
    split = texts.select(identity, _pieces(F.col(text)).alias("__pieces"), index.alias("__index"))
    runs = split.select(identity, F.explode(_word_runs(F.col("__pieces"), F.col("__index"))).alias("__run"))
    found = runs.join(keyed, F.col("__run") == F.col("__core"))
    whole = F.col(phrase) == F.col("__core")
    if key is None:
        # Phrases that begin or end in punctuation still have to be there in full.
        quoted = F.concat(F.lit(WORD_START + r"\Q"), F.col(phrase), F.lit(r"\E" + WORD_END))
        whole = whole | F.rlike(F.col(text), quoted)
    return found.filter(whole).select(identity, *phrases.columns)


def longest_only(matches: DataFrame, text: str, phrases: DataFrame, phrase: str) -> DataFrame:
    """Drop a match whose phrase lies inside another phrase matched in the same text.

    Which phrases lie inside which depends on the phrases alone, so it is worked out once by the
    same join and then removed by key; matches of one text are never paired with each other.
    """
    names = phrases.select(phrase).distinct()
    inner = phrase_join(
        names.withColumnRenamed(phrase, "__outer"), "__outer", names, phrase
    ).filter(F.col("__outer") != F.col(phrase))
    covered = (
        matches.select(text, F.col(phrase).alias("__outer"))
        .join(inner, "__outer")
        .select(text, phrase)
        .distinct()
    )
    return matches.join(covered, [text, phrase], "left_anti")
