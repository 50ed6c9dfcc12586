"""Operators against brute force on small random data."""

import datetime
import decimal
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from jobtide.functions.numbers import epoch_date, half_even_int, half_up_int
from jobtide.functions.text import finds_ignoring_case, fold_german, in_context
from jobtide.operators.aggregates import exact_medians, joined_distinct
from jobtide.operators.dictionary import dictionary_match
from jobtide.operators.flags import in_scope
from jobtide.operators.phrases import longest_only, phrase_join
from jobtide.operators.quality import AcceptedValues, NonNegative, NotNull, Relationship, Unique, run_checks
from jobtide.operators.ranking import By, last_wins, last_written_wins, number_rows
from jobtide.operators.tables import canonical_lines, column_differences, diff_tables
from jobtide.params import ScopeRules
from jobtide.plans.places import opens_with

W = r"[^\W]"


def test_phrase_join_equals_regex_theta_join(spark):
    rng = random.Random(5)
    words = ["bad", "frankfurt", "am", "main", "st.", "augustin", "neu-ulm", "ulm", "x", "a.m."]
    seps = [" ", ", ", "/", " - ", "  ", "; ", "-"]
    names = sorted({"frankfurt", "frankfurt am main", "main", "st. augustin", "neu-ulm", "ulm", "bad ulm", "am", "a.m.", "frankfurt a.m."})
    texts = sorted({"".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 6))) for _ in range(400)})
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    n = spark.createDataFrame([(x,) for x in names], "n string")
    found = {(r["t"], r["n"]) for r in phrase_join(t, "t", n, "n").collect()}
    hits = lambda text, name: re.search(rf"(?<!\w){re.escape(name)}(?!\w)", text) is not None
    expected = {(x, y) for x in texts for y in names if hits(x, y)}
    assert found == expected and len(found) > 300
    kept = {(r["t"], r["n"]) for r in longest_only(phrase_join(t, "t", n, "n"), "t", n, "n").collect()}
    inside = lambda x, y: any((x, o) in expected and o != y and hits(o, y) for o in names)
    assert kept == {(x, y) for x, y in expected if not inside(x, y)}


@pytest.mark.parametrize("text,place,expected", [
    ("berlin, germany", "berlin", True), ("  berlin", "berlin", True), ("berlin mitte", "berlin", False),
    ("berlin - mitte", "berlin", True), ("berlin-mitte", "berlin", False), ("berlin (mitte)", "berlin", True),
    ("remote / berlin", "berlin", False), ("berliner", "berlin", False), ("st. augustin", "st. augustin", True),
    ("stx augustin", "st. augustin", False), ("berlin\n", "berlin", False),
])
def test_opening_place(spark, text, place, expected):
    row = spark.createDataFrame([(text, place)], "t string, p string")
    assert row.select(opens_with(F.col("t"), F.col("p"))).first()[0] is expected


DICTIONARY = [
    ("etl", "etl|elt"), ("spark", "spark|pyspark"), ("sap", "sap"), ("sql", "sql"), ("server", "sql server|mssql|t-sql"),
    ("lake", "data lake|lakehouse"), ("dlh", "data lakehouse"), ("uber", "über|uber"), ("cpp", r"c\+\+"), ("dot", "n.t"),
]
TEXTS = [
    "Umwelt und Sparkasse", "ELT, PySpark", "üsap", "SAP-Berater", "SQL Server", "t-sql", "mssql5", "sql_server sql",
    "Data Lakehouse", "data lake house", "ÜBER", "c++", "net n-t", "nt", "", None, "spark", "xspark sparky", "etl\nelt",
    "data  lake", "postgresql", "sql serverless",
]


@pytest.mark.parametrize("grouped", [True, False])
def test_dictionary_equals_one_regex_per_pattern(spark, grouped):
    def found(text, pattern):
        inner = f"(?:{pattern})" if grouped else pattern
        return text is not None and re.search(rf"(?<!\w){inner}(?!\w)", text, re.I) is not None

    t = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    d = spark.createDataFrame(DICTIONARY, "key string, pattern string")
    got = {(r["id"], r["key"]) for r in dictionary_match(t, "text", d, "key", "pattern", grouped).collect()}
    assert got == {(i, k) for i, x in enumerate(TEXTS) for k, p in DICTIONARY if found(x, p)}


def test_long_dictionary_gives_the_same_matches(spark):
    """More rows, also with accents, repeated keys and expressions, change nothing for the rows before."""
    t = spark.createDataFrame([*enumerate(TEXTS), (90, "8\u212as K8s FÜR für alpha-beta gamma")], "id int, text string")
    few = [*DICTIONARY, ("k", "k8s"), ("k", "absent"), ("fur", "für"), ("two", "alpha|alpha-beta"), ("gap", "beta")]
    many = few + [(f"w{i}", f"word{i}|alphabet {i}") for i in range(700)]
    pairs = lambda rows, **o: sorted(
        tuple(r) for r in dictionary_match(t, "text", spark.createDataFrame(rows, "key string, pattern string"), "key", "pattern", **o).collect()
    )
    found = pairs(few)
    assert pairs(many) == found
    assert {(k, p) for i, k, p in found if i == 90} >= {("k", "k8s"), ("fur", "für"), ("two", "alpha|alpha-beta"), ("gap", "beta")}
    assert not [p for _, _, p in found if p == "absent"]
    assert {p for i, _, p in pairs(few, cased=True) if i == 90 and p in ("k8s", "für")} == {"für"}
    assert pairs(many, grouped=False) == pairs(few, grouped=False)


def test_numbering_of_oversized_groups(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "a", "a", "b", None, "c"]), rng.choice([None, *range(10)]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, v int, id int").repartition(7)
    for nulls_last in (True, False):
        order = [By(F.col("v"), down=True, nulls_last=nulls_last), By(F.col("id"))]
        plain = {(r["id"], r["n"]) for r in number_rows(df, ["g"], order, "n", 10**6).collect()}
        split = {(r["id"], r["n"]) for r in number_rows(df, ["g"], order, "n", 600).collect()}
        assert split == plain and len(plain) == 3000
        expected = set()
        for g in ("a", "b", "c", None):
            members = sorted(
                (x for x in data if x[0] == g), key=lambda x: ((x[1] is None) == nulls_last, -(x[1] or 0), x[2])
            )
            expected |= {(x[2], i + 1) for i, x in enumerate(members)}
        assert plain == expected


def test_numbering_by_every_type(spark):
    rng = random.Random(5)
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(days=n)
    data = [
        (i, rng.choice([None, "", "a", "ab", "é"]), rng.random() < 0.5, day(rng.randint(0, 40)), decimal.Decimal(rng.randint(-3, 3)) / 4,
         rng.choice([None, float("nan"), -0.5, 1e300, float("-inf")]), datetime.datetime(2020, 1, 1, rng.randint(0, 23)))
        for i in range(1500)
    ]
    df = spark.createDataFrame(data, "id bigint, s string, b boolean, d date, m decimal(5,2), x double, t timestamp")
    by = lambda rows: [r["id"] for r in rows.collect()]
    for i, column in enumerate(["s", *df.columns]):
        order = [By(F.col(column), i > 0, i % 2 == 0), By(F.col("id"), down=True)]
        expected = by(df.orderBy(order[0].sorted, order[1].sorted))
        assert by(number_rows(df, [], order, "n", 400).orderBy("n")) == expected



def test_median(spark):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, round(rng.uniform(-500, 90000), 2), 60000.5])) for _ in range(999)]
    data.append(("one", 5.5))
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: r["m"] for r in exact_medians(df, ["g"], {"m": F.col("v")}).collect()}
    expected = {g: statistics.median([v for k, v in data if k == g and v is not None]) for g in ("a", "b", None, "one")}
    assert got == pytest.approx(expected)
    # A coarse sketch, whose brackets hold a small part of each group.
    coarse = {r["g"]: r["m"] for r in exact_medians(df, ["g"], {"m": F.col("v")}, accuracy=20).collect()}
    assert coarse == pytest.approx(expected)


def test_median_of_any_scale(spark):
    rng = random.Random(11)
    data = [(i % 3, rng.expovariate(1) ** 9 * 10 ** (3 * (i % 3)) * rng.choice([-1, 1])) for i in range(5000)] + [(4, 1e300), (4, -1e300)]
    df = spark.createDataFrame(data, "g int, v double").repartition(6)
    got = {r["g"]: r["m"] for r in exact_medians(df, ["g"], {"m": F.col("v")}, accuracy=100).collect()}
    assert got == pytest.approx({g: statistics.median([v for k, v in data if k == g]) for g in (0, 1, 2, 4)})
    plan = exact_medians(df.limit(0), ["g"], {"m": F.col("v")})
    assert plan.collect() == []


def test_rounding_folding_dates(spark):
    row = spark.range(1).select(
        *[half_even_int(F.lit(v)).alias(f"e{i}") for i, v in enumerate((69143.5, 69144.5, 60000.5))],
        half_up_int(F.lit("60000.50").cast("decimal(12,2)")).alias("up"),
        fold_german(F.lit("Größe ÄÖÜ Straße")).alias("fold"),
        epoch_date(F.lit("1788912000")).alias("d"),
        epoch_date(F.lit("-1")).alias("before"),
    ).first()
    assert tuple(row)[:5] == (69144, 69144, 60000, 60001, "grosse aou strasse")
    assert str(row["d"]) == "2026-09-09" and str(row["before"]) == "1969-12-31"


@pytest.mark.parametrize("text,pattern,expected", [
    ("ÜBER uns", "über", True), ("uber", "über", False), ("FLIESSEND", "fließend", False), ("Fließend", "FLIEßEND", True),
    ("ÉTÉ", "[é]t[é]", True), ("straße", "STRAßE", True), ("Kelvin", "kelvin", True),
])
def test_ignoring_case(spark, text, pattern, expected):
    found = spark.createDataFrame([(text,)], "t string").select(finds_ignoring_case(F.col("t"), pattern)).first()[0]
    assert found is expected


def test_context_spans_line_breaks(spark):
    text = "x" * 60 + " first\nSQL\nhere " + "y" * 60
    got = spark.createDataFrame([(text,)], "t string").select(in_context(F.col("t"), "sql")).first()[0]
    assert got == "x" * 38 + " first sql here " + "y" * 39


def test_scope_is_three_valued_and_substring(spark):
    titles = ["Data Engineer", "Mobi", "Bildredakteur", "NTT DATA AI", "NTT DATA Data Engineer", "Datenschutz Data", None, "BI/Analyst", "Duale Studien Data"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert [r[0] for r in df.select(in_scope(F.col("t"), ScopeRules())).collect()] == [
        True, True, False, False, True, False, None, True, False,
    ]


def test_joined_distinct_is_cut_exactly(spark):
    values = [chr(97 + i % 26) * (i % 3) for i in range(200)] + [None]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v string")
    got = joined_distinct(df, ["g"], "v", ", ", 48, "j").first()["j"]
    assert got == ", ".join(sorted({v for v in values if v is not None}))[:48]


def test_diff_and_dump(spark):
    a = spark.createDataFrame([(1, 2.50, "x"), (1, 2.5, "x"), (2, 0.0, None)], "i int, d double, s string")
    b = spark.createDataFrame([(1, 2.5, "x"), (3, 1e30, "l\nm")], "i int, d double, s string")
    got = {tuple(r) for r in diff_tables(a, b).collect()}
    assert got == {("left_only", "1", "2.5", "x", 1), ("left_only", "2", "0", None, 1), ("right_only", "3", "1.0E30", "l\nm", 1)}
    assert diff_tables(a, a).isEmpty()
    assert column_differences(a, b) == [] and column_differences(a, b.drop("s")) == ["s"]
    with pytest.raises(ValueError):
        diff_tables(a, b.drop("s"))
    assert [r[0] for r in canonical_lines(b).collect()] == ["1|2.5|x", "3|1.0E30|l m"]


def test_rules_of_odd_keys_in_one_scan_per_table(spark, tmp_path):
    schema = "k string, d double, t timestamp, b binary, ref int, n int"
    at = datetime.datetime(2026, 9, 1)
    child = [
        ("x", 0.0, at, b"\x00", 1, 1), ("x", -0.0, at.replace(microsecond=1), b"\x00", 1, -1), (None, None, None, None, None, None),
        (None, 1.0, None, None, 9, 0), ("null", 1.5, at, b"\xff", 9, 2),
    ]
    spark.createDataFrame(child, schema).write.parquet(str(tmp_path / "child"))
    spark.createDataFrame([(1,), (None,), (1,)], "id bigint").write.parquet(str(tmp_path / "parent"))
    frames = {n: spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent")}
    checks = [
        Unique("child", ("k",)), Unique("child", ("d",)), Unique("child", ("t",)), Unique("child", ("b",)), Unique("child", ("k", "t")),
        Unique("parent", ("id",)), Relationship("child", "ref", "parent", "id"), Relationship("parent", "id", "child", "ref"),
        NotNull("child", "k"), NonNegative("child", "n"), AcceptedValues("child", "n", (0, 1)), NotNull("child", "k"),
    ]
    report = run_checks(frames, checks)
    expected = [1, 1, 1, 1, 1, 1, 2, 0, 2, 1, 2, 2]
    assert sorted(tuple(r) for r in report.collect()) == sorted((c.check, c.table, c.column, n) for c, n in zip(checks, expected))
    assert report._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 2
    empty = run_checks({n: f.limit(0) for n, f in frames.items()}, checks)
    assert [r["violations"] for r in empty.collect()] == [0] * len(checks)


def test_last_written_row_of_each_key(spark, tmp_path):
    hot = [("hot", "2026-09-01", f"f{i % 7}", i, "x" * i) for i in range(500)]
    items = [*hot, (None, None, "f1", 900, "a"), (None, None, "f0", 901, "b"), ("one", None, "f9", 902, None)]
    spark.createDataFrame(items, "k string, day string, file string, position int, payload string").write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    got = last_written_wins(written, ["k", "day"], ["file", "position"])
    assert got.columns == written.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, last_wins(written, ["k", "day"], ["file", "position"]).collect()), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort" not in plan and "hashpartitioning" not in plan
    assert last_written_wins(written.limit(0), ["k", "day"], ["file", "position"]).count() == 0
