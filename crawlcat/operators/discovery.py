"""Discovery: from the anchors of an index to accepted, ordered, distinct items.

Anchors are rows (index_id, base_url, source_index, href, title, marked); many
indexes are handled at once, each in its own partition of the windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlcat.config import HostPolicy, Thresholds
from crawlcat.functions import text, urls


def classify(anchors: DataFrame, policy: HostPolicy) -> DataFrame:
    """Adds url, stable_id, is_permalink, accepted and the first reason for rejection, in a fixed order."""
    # In stages: an expression used often is a column, so that it is neither repeated in the plan nor in the work.
    full = anchors.withColumn("__full", urls.resolve(F.col("base_url"), F.col("href"))).withColumn("__error", urls.url_error(F.col("__full"), policy))
    out = full.withColumn("url", urls.canonical(F.col("__full"), policy))
    reason = F.when(F.coalesce(F.trim("title"), F.lit("")) == "", "empty title").when(F.col("__error").isNotNull(), F.col("__error")).when(~urls.content_candidate(F.col("url"), F.col("title"), policy), "not a content candidate")
    out = out.withColumn("rejection_reason", reason).withColumn("accepted", F.col("rejection_reason").isNull()).drop("__full", "__error")
    return out.withColumns({"stable_id": F.when(F.col("accepted"), urls.stable_id(F.col("url"), policy)), "is_permalink": F.when(F.col("accepted"), urls.is_permalink(F.col("url"), policy))})


def first_wins(rows: DataFrame, group: list[str], key: str, order: str) -> DataFrame:
    """Adds ``nth``: 1 for the first row of a key in document order, more for its repeats."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*group, key).orderBy(order)))


def items(classified: DataFrame) -> DataFrame:
    """Accepted anchors, the first of each identity, with dense positions from 1."""
    kept = first_wins(classified.where("accepted"), ["index_id"], "stable_id", "source_index").where("nth = 1").drop("nth")
    return kept.withColumn("position", F.row_number().over(Window.partitionBy("index_id").orderBy("source_index")))


def rejections(classified: DataFrame) -> DataFrame:
    return classified.where("not accepted").select("index_id", "source_index", F.concat("href", F.lit(": "), "rejection_reason").alias("rejection"))


def missing_required(found: DataFrame, required: list[str]) -> DataFrame:
    """(index_id, missing): required paths an index lacks, sorted and comma-joined; indexes that have all don't appear."""
    own = found.groupBy("index_id").agg(F.collect_set(F.when(urls.path(F.col("url")).isin(*required), urls.path(F.col("url")))).alias("have"))
    lacking = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.col("have")))
    return own.select("index_id", F.array_join(lacking, ",").alias("missing")).where("missing <> ''")


def discover(anchors: DataFrame, policy: HostPolicy, min_items: int, allow_fallback: bool) -> tuple[DataFrame, DataFrame]:
    """(items, report).  Marked anchors count if they are enough, else all, where a fallback is allowed; else the index has no items.

    The report has a row for each index: strategy, marked and item counts,
    duplicates, rejections, drift and an error.
    """
    # Dealt by index once; the windows and sums of an index are taken where it is.
    own = Window.partitionBy("index_id", "stable_id").orderBy("source_index")
    every = classify(anchors, policy).repartition("index_id").withColumn("nth", F.row_number().over(own))
    every = every.withColumn("nth_marked", F.when(F.col("marked"), F.count_if("marked").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    on = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    accepted, marked = F.col("accepted"), F.col("marked")
    sizes = every.groupBy("index_id").agg(
        on(marked).alias("marked_count"), on(accepted & (F.col("nth_marked") == 1)).alias("m_items"), on(accepted & (F.col("nth_marked") > 1)).alias("m_duplicates"), on(~accepted & marked).alias("m_rejections"),
        on(accepted & (F.col("nth") == 1)).alias("f_items"), on(accepted & (F.col("nth") > 1)).alias("f_duplicates"), on(~accepted).alias("f_rejections"),
    )
    sized = sizes.withColumn("strategy", F.when(F.col("m_items") >= min_items, "marker").when(F.lit(allow_fallback), "fallback").otherwise("none"))
    chosen = lambda n: F.when(F.col("strategy") == "marker", F.col(f"m_{n}")).when(F.col("strategy") == "fallback", F.col(f"f_{n}")).otherwise(F.lit(0).cast("long")).alias(f"n_{n}")
    report = sized.select("index_id", "strategy", "marked_count", *map(chosen, ("items", "duplicates", "rejections")))
    drift = text.drift_score(F.col("n_items"), F.col("marked_count"), F.col("strategy") == "fallback", F.col("n_duplicates"), F.col("n_rejections"))
    error = F.when(F.col("strategy") == "none", "too few marked items").when(F.col("n_items") < min_items, "too few items")
    kept = every.where("accepted").join(sized.select("index_id", "strategy"), "index_id").where("(strategy = 'marker' and nth_marked = 1) or (strategy = 'fallback' and nth = 1)").drop("nth", "nth_marked")
    found = kept.withColumn("position", F.row_number().over(Window.partitionBy("index_id").orderBy("source_index")))
    return found, report.select("index_id", "strategy", "marked_count", "n_items", "n_duplicates", "n_rejections", drift.alias("drift_score"), error.alias("error"))


def anomaly(prior: DataFrame, found: DataFrame, fallback: Column, t: Thresholds = Thresholds()) -> DataFrame:
    """One row for each catalog: set sizes and the first reason to distrust the new set; ``prior`` and ``found`` have catalog_id, stable_id."""
    both = prior.select("catalog_id", "stable_id", F.lit(1).alias("p")).join(found.select("catalog_id", "stable_id", F.lit(1).alias("f")), ["catalog_id", "stable_id"], "full_outer")
    n = both.groupBy("catalog_id").agg(F.count("p").alias("n_prior"), F.count_if(F.col("p").isNotNull() & F.col("f").isNull()).alias("n_removed"), F.count_if(F.col("p").isNull()).alias("n_added"), F.count_if(F.col("p").isNotNull() & F.col("f").isNotNull()).alias("n_common"))
    share = lambda c: F.col(c) / F.col("n_prior")
    reason = (
        F.when(F.col("n_prior") == 0, None)
        .when((share("n_removed") > t.removed_share) & (F.col("n_removed") >= t.removed_least), "removed")
        .when((share("n_added") > t.added_share) & (F.col("n_added") >= t.added_least), "added")
        .when((share("n_common") < t.overlap_share) & (F.col("n_prior") >= t.overlap_prior), "overlap")
        .when(fallback & (share("n_removed") > t.fallback_removed_share), "fallback")
    )
    return n.withColumn("reason", reason)


def index_fingerprint(found: DataFrame) -> DataFrame:
    """(index_id, fingerprint): hash of position, identity, address and title of all items in order."""
    line = F.concat_ws("\t", F.col("position").cast("string"), "stable_id", "url", "title")
    return found.groupBy("index_id").agg(F.sha2(F.expr("listagg(line, '\n') within group (order by position)"), 256).alias("fingerprint")) if "line" in found.columns else index_fingerprint(found.withColumn("line", line))
