"""Mix sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions alone.

Every document draws an exponential key, divided by its quality weight; within its source the documents
with the smallest keys come first. A source's word budget is spent on complete epochs first (every document
once more each) and then on the documents in key order until the budget's last word, so the last document
may be taken in part. Keys come from a digest of doc_id and seed: reruns agree.

The order within a source is never sorted in one task. Keys are cut into `buckets` ranges of equal
probability; sizes are summed per range before the shuffle, and only the one range per source in which the
budget ends is sorted, about 1 / buckets of the source.

Defined cases: a null text has size 0 and nothing of it is taken; a null source is a source of its own, last
in order; documents without any word take nothing; rows with equal doc_id draw equal keys and are ordered by
a digest of their text, equal rows in any order (they are alike); an empty table gives no rows. The table of
sources has one row per source and is put in order in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import BLANKS, native_words, settle
from jobtide.operators.ranking import first_per_key


@dataclass(frozen=True)
class MixRules:
    """weights go round the sources in their order; share of all words to take; repeats at most per document."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.0
    repeats: int = 3
    seed: int = 17
    buckets: int = 65536
    symbol_penalty: float = 8.0


def quality_weight(text: Column, size: Column, penalty: float) -> Column:
    """1 for plain prose, less the more of `#*$%&|<>!` a text has for each word."""
    text = F.coalesce(text, F.lit(""))
    symbols = sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in "#*$%&|<>!"), F.lit(0))
    return 1.0 / (1.0 + penalty * symbols / F.greatest(size, F.lit(1)))


def _uniform(doc_id: Column, seed: int) -> Column:
    """Strictly between 0 and 1, from 52 bits of a digest."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """source, source_size, target: shares by weight, none above `repeats` times its source.

    A target is the smaller of its bound and level x weight; the level is such that all targets add up to
    the share. Sources reach their bounds in order of bound / weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in rules.weights]), (F.pmod(F.row_number().over(order) - 1, len(rules.weights)) + 1).cast("int")
    )
    ranked = sizes.withColumn("w", weight).withColumn("bound", F.col("source_size") * rules.repeats)
    filling = Window.orderBy(F.col("bound") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("want", F.sum("source_size").over(whole) * F.lit(rules.share))
        .withColumn("place", F.row_number().over(filling))
        .withColumn("left_words", F.col("want") - F.coalesce(F.sum("bound").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("level", F.col("left_words") / F.col("left_weight"))
        .withColumn("is_open", F.col("level") * F.col("w") <= F.col("bound"))
    )
    # The first source in filling order that stays within its bound sets the level for all that follow.
    first_open = F.min(F.when(F.col("is_open"), F.struct(F.col("place"), F.col("level")))).over(whole)
    filled = filled.withColumn("final_level", first_open["level"])
    target = F.when(F.col("final_level").isNull(), F.col("bound").cast("double")).otherwise(
        F.least(F.col("bound").cast("double"), F.col("final_level") * F.col("w"))
    )
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and the key (`draw`) of every row of `docs`.

    `docs` has doc_id, source and text. taken counts words: epochs x size, and for the fractional epoch the
    whole size, the budget's last words, or nothing.
    """
    size = F.size(native_words(F.col("text"))).cast("long")
    drawn = settle(
        docs.select("doc_id", "source", "text")
        .withColumn("size", size)
        .withColumn("draw", -F.log(_uniform(F.col("doc_id"), rules.seed)) / quality_weight(F.col("text"), F.col("size"), rules.symbol_penalty))
        .select("doc_id", "source", "size", "draw", F.xxhash64("text").alias("tie"))
        # 1 - exp(-draw) is uniform for weight 1: ranges of about equal numbers of documents.
        .withColumn("range", F.floor((1.0 - F.exp(-F.col("draw"))) * rules.buckets).cast("int"))
    )
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = (
        targets(sizes, rules)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    )
    ranges = drawn.groupBy("source", "range").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spent = (
        ranges.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .join(goals.withColumnRenamed("source", "g"), F.col("source").eqNullSafe(F.col("g")))
        .drop("g")
        .withColumn("is_cut", (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .withColumnsRenamed({"source": "s", "range": "r"})
    )
    placed = drawn.join(spent, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).drop("s", "r")
    base = F.col("epochs") * F.col("size")
    clear = placed.where(~F.col("is_cut")).withColumn(
        "taken", base + F.when(F.col("before") + F.col("words") <= F.col("rest"), F.col("size")).otherwise(F.lit(0))
    )
    in_cut = Window.partitionBy("source").orderBy("draw", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        placed.where("is_cut")
        .withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(in_cut), F.lit(0)))
        .withColumn("taken", base + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead"))))
        .drop("ahead")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "taken", "draw", "tie"]
    return clear.select(columns).unionByName(cut.select(columns))


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix itself: each document as often as it is taken, the last one of a source cut after its last word.

    Columns are those of `docs`, whatever their names. A part is cut behind a word and keeps the white space before it. Rows alike
    in doc_id, source and text are taken together, as one row that holds the words of all: the one whose other columns have
    the smallest digest.
    """
    keys = ["doc_id", "source", "tie"]
    plan = (
        mix(docs, rules)
        .groupBy(*keys, "size")
        .agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("rows"))
        .where("taken > 0")
        .select(*[F.col(c).alias(f"p_{c}") for c in [*keys, "size", "taken", "rows"]])
    )
    # The row as one value: its columns cannot meet those of the plan.
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.xxhash64("text").alias("tie"))
    doc_id, source, text = (F.col("row").getField(c) for c in ("doc_id", "source", "text"))
    joined = held.join(plan, doc_id.eqNullSafe(F.col("p_doc_id")) & source.eqNullSafe(F.col("p_source")) & (F.col("tie") == F.col("p_tie")))
    pieces = F.split(text, f"(?<=[^{BLANKS}])(?=[{BLANKS}])")
    part = (F.col("p_taken") % F.col("p_size")).cast("int")
    cut = F.when(part > 0, F.array(F.array_join(F.slice(pieces, 1, part), ""))).otherwise(F.array().cast("array<string>"))
    whole = F.floor(F.col("p_taken") / F.col("p_size")).cast("int")

    def texts(rows: DataFrame) -> DataFrame:
        taken = rows.select("row", F.explode(F.concat(F.array_repeat(text, whole), cut)).alias("part"))
        return taken.select(*[(F.col("part") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])

    single = texts(joined.where("p_rows = 1"))
    several = joined.where("p_rows > 1").withColumn("digest", F.sha2(F.to_json("row"), 256))
    alike = first_per_key(several, ["p_doc_id", "p_source", "p_tie"], [F.col("digest")])
    return single.unionByName(texts(alike))
