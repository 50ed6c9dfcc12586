"""Reading landed run folders: <raw>/<source>/<run_date>/page_*.json, details/*.json, _manifest.json.

Files become rows of text first; everything after that is column work on the text, so the same
functions also serve JSON that is already in a table. `file` and `position` keep the read order.
"""

from __future__ import annotations

import datetime
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions.json import first_present, json_array_size, json_elements, json_text, truthy_text
from jobtide.operators.ranking import last_wins, last_written_wins
from jobtide.session import local_frame
from jobtide.sources.tables import read_text

RUN_PATH = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/(?:details/)?[^/]+$"
RUN_FILE = "source string, run_date date, file string, document string"
MANIFEST_NAME = "_manifest.json"
COUNTS = ("rows_read", "duplicates_collapsed")
READ_ORDER = ["file", "position"]
MANIFEST_READERS = 16
RUN_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def read_run_files(spark: SparkSession, raw: str, source: str, name: str, run_date: str | None = None) -> DataFrame:
    """One row per file: (source, run_date, file, document). A date narrows the listing itself."""
    files = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
    folder = f"{raw}/{source}/{run_date or '*'}"
    path = F.col("_metadata.file_path")
    try:
        text = files.load(f"{folder}/{name}")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], RUN_FILE)
    return text.select(
        F.regexp_extract(path, RUN_PATH, 1).alias("source"),
        F.regexp_extract(path, RUN_PATH, 2).cast("date").alias("run_date"),
        path.alias("file"),
        F.col("value").alias("document"),
    )


def list_runs(spark: SparkSession, raw: str, run_date: str | None = None) -> DataFrame:
    """Distinct (source, run_date) on disk, oldest first within a source.

    A run is its folder, whatever lies in it; folders are listed and no file is read.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{raw}/*/{run_date or '*'}")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [s.getPath() for s in system.globStatus(pattern) or [] if s.isDirectory()]
    named = [(f.getParent().getName(), f.getName()) for f in folders]
    runs = sorted((source, datetime.date.fromisoformat(day)) for source, day in named if RUN_DAY.fullmatch(day))
    return local_frame(spark, runs, "source string, run_date date")


def read_manifests(spark: SparkSession, raw: str, run_date: str | None = None) -> DataFrame:
    """The manifest of each run that has one.

    Spark's file sources skip names that begin with an underscore, so these are read through the
    file system, several at a time; there is one small file per retained run.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{raw}/*/{run_date or '*'}/{MANIFEST_NAME}")
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [status.getPath().toString() for status in system.globStatus(pattern) or []]

    def read(path: str) -> tuple:
        source, day = path.split("/")[-3:-1]
        return source, datetime.date.fromisoformat(day), path, read_text(spark, path)

    with ThreadPoolExecutor(MANIFEST_READERS) as readers:
        found = list(readers.map(read, paths))
    return local_frame(spark, found, RUN_FILE)


def enveloped_rows(documents: DataFrame) -> DataFrame:
    """Postings of pages that name their own results array, one row per element with an id."""
    document = F.col("document")
    key = F.coalesce(json_text(document, "results_key"), F.lit(fixed.RESULT_KEYS[0]))
    payload = json_text(document, "payload")
    array = F.lit(None).cast("string")
    for known in fixed.RESULT_KEYS:
        array = F.when(key == known, json_text(payload, known)).otherwise(array)
    # A key outside the known list is looked up by name.
    fallback = F.element_at(F.from_json(payload, "map<string,string>"), key)
    array = F.when(key.isin(*fixed.RESULT_KEYS), array).otherwise(fallback)
    # What a page says once is read once, in a generator of its own: beside the elements it would be read anew for each of them.
    once = F.struct(json_text(document, "search_term").alias("search_term"), json_elements(array).alias("__elements"))
    others = [c for c in documents.columns if c != "document"]
    pages = documents.select(*others, F.inline(F.array(once)))
    elements = pages.select(*others, "search_term", F.posexplode("__elements").alias("position", "payload"))
    found = F.coalesce(*[truthy_text(F.col("payload"), name) for name in fixed.ID_FIELDS])
    return elements.withColumn("source_id", found).filter(F.col("source_id").isNotNull())


def plain_rows(documents: DataFrame) -> DataFrame:
    """Postings of pages with a `data` array; elements without a slug are skipped."""
    elements = documents.select(
        *[c for c in documents.columns if c != "document"],
        F.posexplode(json_elements(json_text(F.col("document"), "data"))).alias("position", "payload"),
    )
    return elements.withColumn("source_id", truthy_text(F.col("payload"), "slug")).filter(F.col("source_id").isNotNull())


def detail_rows(documents: DataFrame) -> DataFrame:
    document = F.col("document")
    return documents.select(
        *[c for c in documents.columns if c != "document"],
        json_text(document, "id").alias("source_id"),
        F.lit(0).alias("position"),
        json_text(document, "payload").alias("payload"),
    )


def collapse(rows: DataFrame) -> DataFrame:
    """One row per (source_id, run_date): the one read last."""
    return last_wins(rows, ["source_id", "run_date"], READ_ORDER)


def collapse_written(rows: DataFrame) -> DataFrame:
    """`collapse` for rows that lie in a table; payloads stay where they are."""
    return last_written_wins(rows, ["source_id", "run_date"], READ_ORDER)


def run_accounting(rows: DataFrame) -> DataFrame:
    """Posting rows read per run and how many of them the grain collapsed."""
    return rows.groupBy("source", "run_date").agg(
        F.count("*").alias("rows_read"),
        (F.count("*") - F.count_distinct("source_id")).alias("duplicates_collapsed"),
    )


def load_manifests(manifests: DataFrame, accounting: DataFrame) -> DataFrame:
    """Manifests with the loader's counts written over whatever they said before.

    Only top-level members of these names are replaced, of whatever type. A document that is missing
    or no object counts as one without members.
    """
    counted = manifests.join(accounting, ["source", "run_date"], "left")
    members = "map<string,variant>"
    said = F.coalesce(F.from_json("document", members), F.from_json(F.lit("{}"), members))
    others = F.map_filter(said, lambda name, _: ~name.isin(*COUNTS))
    count = lambda name: F.parse_json(F.coalesce(F.col(name), F.lit(0)).cast("string"))
    counts = F.create_map(*[c for name in COUNTS for c in (F.lit(name), count(name))])
    return counted.select("source", "run_date", F.to_json(F.map_concat(others, counts)).alias("manifest"))


def truncated_terms(pages: DataFrame, max_pages: int) -> DataFrame:
    """Search terms whose pages ran into the cap before all reported postings were fetched.

    `pages` holds (search_term, page, document); the total is the one on the term's last page.
    """
    payload = json_text(F.col("document"), "payload")
    per_page = pages.select(
        "search_term",
        "page",
        F.coalesce(*[json_array_size(payload, key) for key in fixed.RESULT_KEYS], F.lit(0)).alias("postings"),
        first_present(payload, fixed.TOTAL_KEYS).cast("bigint").alias("total"),
    )
    return (
        per_page.groupBy("search_term")
        .agg(
            F.sum("postings").alias("fetched"),
            F.max_by("total", "page").alias("reported"),
            F.count("*").alias("pages"),
        )
        .filter((F.col("fetched") < F.col("reported")) & (F.col("pages") == max_pages))
    )
