"""Matching texts against a reviewed dictionary of patterns.

The dictionary is a seed that people read line by line, so its patterns are taken to the driver
and become literals of one projection: each text is scanned where it lies, with no join and no
shuffle. All plain terms share one expression that branches by letter, so the cost of a text hardly
depends on how many terms there are; any other pattern is an expression of its own.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.text import WORD_END, WORD_START, both_cases, bounded, ignore_case
from jobtide.session import local_frame

# Letters, with accents as far as each has one form per case, digits, and what parts words in a name.
PLAIN_TERM = re.compile(r"[A-Za-z0-9_À-ſ](?:[A-Za-z0-9_À-ſ \-/&#,:;]*[A-Za-z0-9_À-ſ])?")


def _one_form_per_case(letter: str) -> bool:
    lower, upper = letter.lower(), letter.upper()
    return len(lower) == len(upper) == 1 and lower.upper() == upper and upper.lower() == lower and lower != upper


def _starts_with_word(longer: str, shorter: str) -> bool:
    """Whether `longer` begins with `shorter` as whole words."""
    rest = longer[len(shorter):]
    return longer.startswith(shorter) and not re.match(r"\w", rest)


def _plain_terms(pattern: str, cased: bool) -> list[str] | None:
    terms = pattern.split("|")
    if not all(PLAIN_TERM.fullmatch(t) and all(c.isascii() or _one_form_per_case(c) for c in t) for t in terms):
        return None
    return terms if cased else [t.lower() for t in terms]


def _alternation(terms: list[str], cased: bool) -> str:
    """An expression for any of the terms, the longest where several fit, with common beginnings written once."""
    spelled = (lambda c: re.escape(c)) if cased else (lambda c: re.escape(c) if c.isascii() else both_cases(c))
    by_letter: dict[str, list[str]] = {}
    for term in terms:
        if term:
            by_letter.setdefault(term[0], []).append(term[1:])
    branches = [spelled(letter) + _alternation(rests, cased) for letter, rests in sorted(by_letter.items())]
    if not branches:
        return ""
    if len(branches) == 1 and "" not in terms:
        return branches[0]
    return f"(?:{'|'.join(branches)}){'?' if '' in terms else ''}"


def _rows_by_single_scan(text: Column, rows_of_term: dict[str, list[int]], cased: bool, from_start: bool, to_end: bool) -> Column:
    """Dictionary rows of all plain terms in the text, found in one pass.

    `from_start` and `to_end` say at which ends a term has to be bounded. The terms sit in a
    look-ahead, so every place where one may start reports its longest term; terms that are a
    beginning of that term are known beforehand.
    """
    flag = "" if cased else "(?i)"
    first = "".join(sorted({c for term in rows_of_term for c in (term[0] if cased else term[0] + term[0].upper())}))
    end = WORD_END if to_end else ""
    # Most positions are passed over by their letter alone.
    scan = f"{flag}(?=[{first}]){WORD_START if from_start else ''}(?=({_alternation(sorted(rows_of_term), cased)}){end})"
    hits = F.regexp_extract_all(text, F.lit(scan), F.lit(1))
    holds = _starts_with_word if to_end else str.startswith
    beginnings = lambda term: (term[:n] for n in range(1, len(term) + 1))
    implied = {
        term: sorted({r for t in beginnings(term) if t in rows_of_term and holds(term, t) for r in rows_of_term[t]})
        for term in rows_of_term
    }
    distinct_hits = F.array_distinct(hits if cased else F.transform(hits, F.lower))
    return F.flatten(F.transform(distinct_hits, _look_up(implied)))


def _look_up(rows_of_term: dict[str, list[int]]) -> Callable[[Column], Column]:
    """The rows of a term, from a literal table of a place or two per digest of a term."""
    places = 1 << len(rows_of_term).bit_length()
    table: list[list[dict]] = [[] for _ in range(places)]
    for term, rows in rows_of_term.items():
        table[zlib.crc32(term.encode()) % places].append({"term": term, "rows": rows})
    known = F.from_json(F.lit(json.dumps(table)), "array<array<struct<term:string,rows:array<int>>>>")

    def rows(hit: Column) -> Column:
        at = (F.crc32(hit.cast("binary")) % places).cast("int")
        return F.flatten(F.transform(F.filter(F.get(known, at), lambda x: x["term"] == hit), lambda x: x["rows"]))

    return rows


def _rows_by_pattern(text: Column, patterns: list[tuple[int, str]], cased: bool, grouped: bool) -> Column:
    """Dictionary rows of the patterns found, testing one regular expression after the other."""
    tests = []
    for row, pattern in patterns:
        expression = bounded(pattern, grouped)
        found = text.rlike(expression if cased else ignore_case(expression))
        tests.append(F.when(found, F.lit(row)))
    return F.array_compact(F.array(*tests))


def matching_rows(text: Column, patterns: list[str], cased: bool = False, grouped: bool = True) -> Column:
    """Array of the positions of the patterns that occur in the text between word boundaries.

    Ungrouped, the boundaries bind to the first and last alternative: the first has to begin a word,
    the last to end one, and those between may stand anywhere. Each kind is one pass over the text.
    """
    scans: dict[tuple[bool, bool], dict[str, list[int]]] = {}
    one_by_one: list[tuple[int, str]] = []
    for row, pattern in enumerate(patterns):
        terms = _plain_terms(pattern, cased)
        if terms is None:
            one_by_one.append((row, pattern))
            continue
        for i, term in enumerate(terms):
            bounds = (grouped or i == 0, grouped or i == len(terms) - 1)
            scans.setdefault(bounds, {}).setdefault(term, []).append(row)
    parts = [_rows_by_single_scan(text, terms, cased, *bounds) for bounds, terms in scans.items()]
    if one_by_one:
        parts.append(_rows_by_pattern(text, one_by_one, cased, grouped))
    if not parts:
        return F.array().cast("array<int>")
    return F.array_distinct(F.concat(*parts))


def dictionary_match(
    df: DataFrame, text: str, dictionary: DataFrame, key: str, pattern: str, grouped: bool = True, cased: bool = False
) -> DataFrame:
    """One row per (row of df, dictionary row whose pattern occurs in it), without the text.

    A key may stand in several dictionary rows; only those whose pattern occurs are returned. A null
    pattern occurs nowhere.
    """
    kept = [c for c in df.columns if c != text]
    spark = dictionary.sparkSession
    rows = [tuple(r) for r in dictionary.filter(F.col(pattern).isNotNull()).collect()]
    at = dictionary.columns.index(pattern)
    found = df.select(*kept, F.explode(matching_rows(F.col(text), [r[at] for r in rows], cased, grouped)).alias("__row"))
    numbered = T.StructType([*dictionary.schema.fields, T.StructField("__row", T.IntegerType())])
    # The rows have just been on the driver; the planner knows their size and picks the join.
    by_row = local_frame(spark, [(*r, i) for i, r in enumerate(rows)], numbered)
    return found.join(by_row, "__row").select(*kept, *dictionary.columns)
