"""Positions of pattern matches, with DataFrame functions only.

Matches are leftmost and do not overlap. A match's start is the sum of the lengths of what
stands before it: the pieces that ``split`` leaves and the matches of ``regexp_extract_all``, both in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = "array<struct<start:int,end:int,text:string>>"
SPANS = "array<struct<start:int,kind:int,end:int>>"


def find_matches(df: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """For each name -> (text column, pattern) a column of (start, end, text) of all matches.

    Texts are cut only where there is a match. Patterns match no empty string.
    """
    found = {f"{name}_found": F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)) for name, (text, pattern) in patterns.items()}
    df = df.select("*", *(c.alias(n) for n, c in found.items()))
    located = {name: _located(F.col(text), pattern, F.col(f"{name}_found")) for name, (text, pattern) in patterns.items()}
    return df.select("*", *(c.alias(n) for n, c in located.items())).drop(*found)


def _located(text: Column, pattern: str, found: Column) -> Column:
    start = F.struct(F.lit(0).alias("at"), F.array().cast(MATCHES).alias("out"))
    steps = F.zip_with(found, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda m, gap: F.struct(m.alias("m"), F.char_length(gap).alias("gap")))

    def add(acc: Column, step: Column) -> Column:
        begin = acc["at"] + step["gap"]
        end = begin + F.char_length(step["m"])
        entry = F.struct(begin.alias("start"), end.alias("end"), step["m"].alias("text"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(entry)).cast(MATCHES).alias("out"))

    every = F.aggregate(steps, start, add, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, every).otherwise(F.array().cast(MATCHES))


def as_spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))).cast(SPANS)


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (s["end"] > start))


def leftmost(spans: Column) -> Column:
    """Of spans in order, those that do not overlap one taken before."""

    def add(acc: Column, span: Column) -> Column:
        free = (F.size(acc) == 0) | (F.element_at(acc, -1)["end"] <= span["start"])
        return F.when(free, F.concat(acc, F.array(span))).otherwise(acc)

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def written(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)
