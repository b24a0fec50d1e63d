"""Spans of regular expressions as DataFrame operations.

A pattern's matches and the gaps between them come from ``regexp_extract_all``
and ``split`` of the same pattern, so positions are running sums of lengths.
They are summed by a window over the matches of one text, not inside an array,
so a text with very many matches costs in proportion to them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlcat.llm.common import unused


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str | Column  #: never matches an empty string
    group: int  #: whose text is ``value``
    likely: Callable[[Column], Column]  #: cheap test of a value; a text none of whose values pass it has no match to keep
    keep: Callable[[Column], Column]  #: the exact test of a value
    needs: str = ""  #: cheap pattern found in every text with a match to keep; other texts aren't searched


def text_key() -> Column:
    """Key of a row by content, of 128 bits; equal rows share it, and equal results."""
    said = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.struct(F.xxhash64(F.struct("doc_id"), said).alias("a"), F.xxhash64(F.lit("b"), said, F.struct("doc_id")).alias("b"))


def searched(rows: DataFrame, kinds: list[Kind]) -> DataFrame:
    """``rows`` with a column for each kind: the text, or nothing where its cheap test finds that there is nothing to search."""
    return rows.withColumns({f"__text_{k}": F.when(F.col("text").rlike(kind.needs), F.col("text")).otherwise("") if kind.needs else F.col("text") for k, kind in enumerate(kinds)})


def hits(kinds: list[Kind], more: Callable[[Column, Column], dict[str, Column]] | None = None) -> Column:
    """Array of (k, pos, gap, len, value, and what ``more`` makes of the neighbouring gaps) over all kinds, of rows from ``searched``."""
    found = []
    for k, kind in enumerate(kinds):
        number, pattern, text = k, F.lit(kind.pattern) if isinstance(kind.pattern, str) else kind.pattern, F.col(f"__text_{k}")
        whole = F.regexp_extract_all(text, pattern, F.lit(0))
        value = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else whole
        gaps = F.split(text, pattern, -1)
        # Zipped, so that each pattern runs over a text once and not once a match.
        rows = F.zip_with(gaps, whole, lambda g, w: F.struct(g.alias("g"), w.alias("w"), w.alias("v")))
        if kind.group:
            rows = F.zip_with(rows, value, lambda s, v: F.struct(s["g"].alias("g"), s["w"].alias("w"), v.alias("v")))
        if more:
            rows = F.zip_with(rows, F.slice(gaps, F.lit(2), F.size(gaps)), lambda s, n: F.struct(s["g"].alias("g"), s["w"].alias("w"), s["v"].alias("v"), n.alias("n")))

        def hit(s: Column, i: Column) -> Column:
            own = {"k": F.lit(number), "pos": i, "gap": F.length(s["g"]), "len": F.coalesce(F.length(s["w"]), F.lit(0)), "value": F.coalesce(s["v"], F.lit(""))}
            own |= more(s["g"], s["n"]) if more else {}
            return F.struct(*(c.alias(n) for n, c in own.items()))

        every = F.transform(rows, hit)
        found.append(F.when(F.exists(value, kind.likely), every).otherwise(F.filter(F.slice(every, F.lit(1), F.lit(0)), lambda _: F.lit(False))))
    return F.flatten(F.array(*found))


def placed(found: DataFrame, kinds: list[Kind]) -> DataFrame:
    """Rows (key, k, start, end, value, ...) of the matches to keep; ``found`` has ``key`` and ``hits``."""
    once = found.where(F.size("hits") > 0).dropDuplicates(["key"])
    flat = once.select("key", F.explode("hits").alias("h")).select("key", "h.*")
    before = Window.partitionBy("key", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap") + F.coalesce(F.sum(F.col("gap") + F.col("len")).over(before), F.lit(0))
    at = flat.withColumns({"start": start.cast("long"), "end": (start + F.col("len")).cast("long")})
    keep = F.lit(False)
    for k, kind in enumerate(kinds):
        keep = F.when(F.col("k") == k, kind.keep(F.col("value"))).otherwise(keep)
    return at.where((F.col("len") > 0) & keep).drop("pos", "gap", "len")


def listing(spans: Column, names: list[str], which: Callable[[Column], Column] | None = None) -> Column:
    """``kind:start:end`` of an array of (start, k, end, ...), by start and kind, comma-joined."""
    if which:
        spans = F.filter(spans, which)
    kinds = F.array(*(F.lit(n) for n in names))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def redacted(text: Column, spans: Column, marker: Callable[[Column], Column]) -> Column:
    """``text`` with its spans (start, k, end, ...) replaced; of spans that overlap, the earliest stays."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(
        F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), marker(s))).alias("out"))
    )
    finish = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, F.aggregate(F.array_sort(spans), start, step, finish)).otherwise(text)


def replaced(docs: DataFrame, scanned: DataFrame, marker: Callable[[Column], Column]) -> DataFrame:
    """``docs`` with the spans of ``scanned`` (key, spans) replaced in ``text``; all columns stay, whatever they are called."""
    key, spans = unused("key", docs.columns), unused("spans", docs.columns)
    some = scanned.select(F.col("key").alias(key), F.col("spans").alias(spans)).where(F.size(spans) > 0).dropDuplicates([key])
    keyed = docs.withColumn(key, text_key()).join(some, key, "left")
    return keyed.withColumn("text", F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col(spans), marker))).select(*docs.columns)
