"""Documents to training sequences: quality, repeated lines, near copies, mix of sources, packing.

Each stage is written and read again before the next one, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import circulant, ftrl, line_store, mixing, packing
from jobtide.llm.common import read, settle
from jobtide.llm.queries import pack_rules
from jobtide.operators.ranking import By, first_per_key, number_rows

#: Texts that one task puts in order, where documents share an id.
HOT_ROWS = 1_000_000


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of `docs`, with n_chars following the text."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))
    return changed.select(_names(docs))


def _names(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from their labels, does not reject.

    Null and empty texts have the score of a document without features; rows without doc_id teach nothing and are scored
    like others; repeated rows are scored alike. Without labels every score is 0.5 and all stay.
    """
    rules = ftrl.FtrlRules()
    weights = ftrl.train(docs, read(spark, sf_dir, "labels"), rules)
    scored = ftrl.score(docs, weights, rules)
    return scored.where(F.col(f"`{scored.columns[-1]}`") >= rules.threshold).select(_names(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them.

    Every row stays, with a text that may have become empty; a null text becomes an empty one. Rows without doc_id neither
    lose lines nor make others lose any; rows that share a doc_id are one document and keep their lines.
    """
    return _like(docs, line_store.without_lost_lines(docs, line_store.LineStore().insert_in_batches(docs)))


def _own_ids(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), own_id: an id for each distinct text of a doc_id.

    The text with the smallest digest keeps the doc_id; further ones, in order, get numbers above the largest.
    """
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), _text_digest().alias("digest")).distinct()
    texts = settle(texts)
    first = texts.groupBy("doc_id").agg(F.min("digest").alias("first_digest"), F.count(F.lit(1)).alias("n"))
    several = first.where("n > 1").withColumnRenamed("doc_id", "of_id")
    more = texts.join(several, (F.col("doc_id") == F.col("of_id")) & (F.col("digest") > F.col("first_digest"))).select("doc_id", "digest")
    top = texts.agg(F.max("doc_id").alias("top"))
    numbered = number_rows(more, [], [By(F.col("doc_id")), By(F.col("digest"))], "n", HOT_ROWS)
    return settle(numbered.select("doc_id", "digest", (F.col("n") + top.scalar()).alias("own_id")))


def _text_digest():
    return F.sha2(F.concat(F.col("text").isNull().cast("string"), F.coalesce("text", F.lit(""))), 256)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    A document is a text under a doc_id: different texts that share a doc_id are judged apart, and a text goes only if a near
    copy of it stays. Repeated rows are one; of rows alike in doc_id and text the one whose other columns have the smallest
    digest stays. Texts without words are linked with nothing; rows without doc_id stay.
    """
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    more = _own_ids(docs).withColumnsRenamed({"doc_id": "of_id", "digest": "of_digest"})
    if more.isEmpty():
        held = held.withColumn("own_id", F.col("doc_id"))
    else:
        match = (F.col("doc_id") == F.col("of_id")) & (_text_digest() == F.col("of_digest"))
        held = settle(held.join(more, match, "left").withColumn("own_id", F.coalesce("own_id", "doc_id")).select("row", "text", "own_id"))
    judged = circulant.near_duplicates(held.select(F.col("own_id").alias("doc_id"), "text"))
    kept = settle(judged.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias("kept_id")).agg(F.count(F.lit(1)).alias("rows")))
    of = F.col("own_id") == F.col("kept_id")
    once = held.join(kept.where("rows = 1"), of, "left_semi")
    several = held.join(kept.where("rows > 1"), of, "left_semi").withColumn("other", F.sha2(F.to_json("row"), 256))
    rows = once.select("row").unionByName(first_per_key(several, ["own_id"], [F.col("other")]).select("row"))
    return rows.unionByName(held.where("own_id is null").select("row")).select([F.col("row").getField(c).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, taken once, or left out.

    Texts without words and null texts are left out; a null source is a source; rows alike in doc_id, source and text
    are taken together.
    """
    return _like(docs, mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences; a null or empty text is its end mark alone."""
    pieces = packing.pack(docs, pack_rules())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_copies),
    ("source_mix", mix),
    ("packing", pack),
]

#: The classifier is learned and tokens are looked up in a vocabulary: neither can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
