"""Catalog: snapshot comparison, merge of new evidence, refresh planning, digests.

Tables are keyed by (catalog_id, stable_id); ``now`` is always an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from crawlcat.config import Thresholds
from crawlcat.functions import text
from crawlcat.functions.http import backoff_hours

KEY = ["catalog_id", "stable_id"]
#: Columns of an entry that discovery overwrites; the rest is kept from the prior one.
FROM_INDEX = ("url", "title", "position")


def change(prior: DataFrame, found: DataFrame) -> DataFrame:
    """(catalog_id, stable_id, change): added, removed, updated (title or address) or unchanged; position alone says nothing."""
    p = prior.select(*KEY, F.col("url").alias("p_url"), F.col("title").alias("p_title"), F.lit(True).alias("p"))
    f = found.select(*KEY, "url", "title", F.lit(True).alias("f"))
    kind = F.when(F.col("p").isNull(), "added").when(F.col("f").isNull(), "removed").when(F.col("url").eqNullSafe(F.col("p_url")) & F.col("title").eqNullSafe(F.col("p_title")), "unchanged").otherwise("updated")
    return p.join(f, KEY, "full_outer").select(*KEY, kind.alias("change"))


def reconcile(prior: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """The next catalog: found items with the prior evidence; what isn't found is gone."""
    rest = [c for c in prior.columns if c not in (*KEY, *FROM_INDEX, "first_seen_at", "last_seen_at", "observed_updated_at")]
    p = prior.select(*KEY, F.col("url").alias("p_url"), F.col("title").alias("p_title"), "first_seen_at", "observed_updated_at", *rest, F.lit(True).alias("p"))
    same = F.col("url").eqNullSafe(F.col("p_url")) & F.col("title").eqNullSafe(F.col("p_title"))
    joined = found.select(*KEY, *FROM_INDEX).join(p, KEY, "left")
    return joined.select(*KEY, *FROM_INDEX, F.coalesce("first_seen_at", now).alias("first_seen_at"), now.alias("last_seen_at"), F.when(F.col("p").isNotNull() & same, F.col("observed_updated_at")).otherwise(now).alias("observed_updated_at"), *rest)


def invariants(entries: DataFrame, order: DataFrame) -> DataFrame:
    """(catalog_id, fault, stable_id) rows: identities in the order but not the entries, the other way round, repeats, blank addresses, shared positions."""
    shared = F.count("*").over(Window.partitionBy("catalog_id", "position")) > 1
    own = entries.select(*KEY, F.lit(0).alias("ordered"), F.lit(1).alias("entry"), F.coalesce(text.blank(F.col("url")), F.lit(True)).cast("int").alias("blank"), shared.cast("int").alias("shared"))
    every = order.select(*KEY, F.lit(1).alias("ordered"), *(F.lit(0).alias(c) for c in ("entry", "blank", "shared"))).unionByName(own)
    n = every.groupBy(*KEY).agg(*(F.sum(c).cast("int").alias(c) for c in ("ordered", "entry", "blank", "shared")))
    times = {
        "missing entry": F.when(F.col("entry") == 0, F.col("ordered")), "not in order": F.when(F.col("ordered") == 0, F.col("entry")), "repeated in order": (F.col("ordered") > 1).cast("int"),
        "repeated entry": (F.col("entry") > 1).cast("int"), "blank url": F.col("blank"), "shared position": F.col("shared"),
    }
    faults = F.flatten(F.array(*(F.array_repeat(F.lit(name), F.coalesce(k, F.lit(0))) for name, k in times.items())))
    return n.select("catalog_id", F.explode(faults).alias("fault"), "stable_id")


def success_clock(success: Column, checked: Column) -> Column:
    return F.coalesce(success, checked)


def is_stale(success: Column, now: Column, t: Thresholds = Thresholds()) -> Column:
    """Never, in the future, or at least ``freshness_days`` ago."""
    return success.isNull() | (success > now) | (F.unix_micros(now) - F.unix_micros(success) >= t.freshness_days * 86_400_000_000)


def reasons(success: Column, summary: Column, retry_at: Column, canary: Column, now: Column, enrich: bool = True, force: bool = False, t: Thresholds = Thresholds()) -> Column:
    """Why a page is due, in a fixed order; ``not_due`` alone if it isn't."""
    if force:
        return F.array(F.lit("force"))
    on = F.lit(enrich)
    missing = text.non_empty(summary).isNull() & (retry_at.isNull() | (retry_at <= now))
    every = F.array_compact(F.array(F.when(on & is_stale(success, now, t), "stale"), F.when(on & missing, "missing_metadata"), F.when(canary, "canary")))
    return F.when(F.size(every) == 0, F.array(F.lit("not_due"))).otherwise(every)


def grant(decisions: DataFrame, budget: int | None, cursor: Column | int = 0) -> DataFrame:
    """Adds ``granted``: the first ``budget`` due entries of each catalog, round from ``cursor``; reasons stay.

    ``decisions`` has catalog_id, position (dense from 0) and due.
    """
    if budget is None:
        return decisions.withColumn("granted", F.col("due"))
    n = F.count("*").over(Window.partitionBy("catalog_id"))
    start = F.pmod(F.lit(cursor) if isinstance(cursor, int) else cursor, n)
    turn = F.pmod(F.col("position") - start, n)
    nth = F.row_number().over(Window.partitionBy("catalog_id", "due").orderBy("__turn"))
    return decisions.withColumn("__turn", turn).withColumn("granted", F.col("due") & (nth <= budget)).drop("__turn")


def next_cursor(cursor: Column, served: Column, n: Column) -> Column:
    return F.pmod(cursor + F.greatest(served, F.lit(1)), F.greatest(n, F.lit(1)))


def merge(catalog: DataFrame, evidence: DataFrame, now: Column, t: Thresholds = Thresholds()) -> DataFrame:
    """Entries after a round of fetches.

    ``evidence`` has catalog_id, stable_id, status (null: no answer), summary,
    published_hint, published_at, etag, raw_sha256 and, if there are any,
    last_modified, decoded_sha256, selected_encoding, error_kind and
    error_message; a row with an error_kind is a failure whatever its status.
    No row: the entry stays.  A failure moves attempt and answer clocks and the
    backoff only, and keeps its reason; 304 moves the success clocks and keeps
    validators that it doesn't repeat; 200 replaces the page's evidence and
    applies the summary rules: a good new summary also becomes the last good
    one, and the last good one stands in for a missing or damaged new one.
    Columns that the catalog lacks are left out.
    """
    names = ("summary", "published_hint", "published_at", "etag", "raw_sha256", "last_modified", "decoded_sha256", "selected_encoding", "error_kind", "error_message")
    e = evidence.select(*KEY, "status", *((F.col(c) if c in evidence.columns else F.lit(None).cast("string")).alias(f"n_{c}") for c in names), F.lit(True).alias("seen"))
    j = catalog.join(e, KEY, "left")
    old = lambda c: F.col(c) if c in catalog.columns else F.lit(None)
    sound = F.coalesce(F.col("seen"), F.lit(False)) & F.col("n_error_kind").isNull()
    # In stages, so that what is used often is worked out once.
    j = j.withColumns({"m_ok": sound & F.coalesce(F.col("status").between(200, 299), F.lit(False)), "m_same": sound & F.coalesce(F.col("status") == 304, F.lit(False)), "m_new": text.non_empty(F.col("n_summary"))})
    ok, same, new = F.col("m_ok"), F.col("m_same"), F.col("m_new")
    j = j.withColumns({"m_failed": F.coalesce(F.col("seen"), F.lit(False)) & ~ok & ~same, "m_damaged": F.coalesce(new.contains(text.REPLACEMENT), F.lit(False))})
    failed, damaged = F.col("m_failed"), F.col("m_damaged")
    j = j.withColumn("m_good", F.when((new.isNotNull() & ~damaged) | (old("prior_good_summary").isNull() & new.isNotNull()), new).otherwise(old("prior_good_summary")))
    good = F.col("m_good")
    good_clean = good.isNotNull() & ~F.coalesce(good.contains(text.REPLACEMENT), F.lit(False))
    j = j.withColumn("m_effective", F.when(new.isNull() & good.isNotNull(), good).when(damaged & good_clean, good).otherwise(new))
    effective = F.col("m_effective")
    material = (F.coalesce(effective, F.lit("")) != F.coalesce(old("summary"), F.lit(""))) | ~F.col("n_published_hint").eqNullSafe(old("published_hint")) | ~F.col("n_published_at").eqNullSafe(old("published_at"))
    failures = F.coalesce(old("failure_count"), F.lit(0)) + 1
    none = F.lit(None)
    n = lambda c: F.col(f"n_{c}")
    kept = lambda c: F.coalesce(n(c), old(c))
    reason = F.coalesce(n("error_kind"), F.when(F.col("status").isNull(), "missing_evidence").otherwise("status"))
    said = F.coalesce(n("error_message"), F.when(F.col("status").isNull(), "no answer").otherwise(F.concat(F.lit("HTTP "), F.col("status").cast("string"))))
    # By column: what a 200, a 304 and a failure make of it; None: the old value.
    rules = {
        "summary": (effective, None, None), "prior_good_summary": (good, None, None), "summary_source": (F.when(new.isNotNull(), F.lit("page")).otherwise(old("summary_source")), None, None),
        "summary_quality": (text.coarse_quality(effective), None, None), "published_hint": (kept("published_hint"), None, None), "published_at": (kept("published_at"), None, None),
        "observed_updated_at": (F.when(material, now).otherwise(old("observed_updated_at")), None, None),
        "etag": (n("etag"), kept("etag"), None), "last_modified": (n("last_modified"), kept("last_modified"), None),
        "raw_sha256": (kept("raw_sha256"), None, None), "decoded_sha256": (kept("decoded_sha256"), None, None), "selected_encoding": (n("selected_encoding"), None, None),
        "last_checked_at": (now, now, None), "last_success_at": (now, now, None), "last_attempted_at": (now, now, now), "last_response_at": (now, now, now),
        "failure_count": (F.lit(0), F.lit(0), failures), "status_code": (F.col("status"), F.lit(304), F.col("status")), "last_error_kind": (none, none, reason), "last_error_message": (none, none, said),
        "next_retry_at": (none, none, now + F.make_dt_interval(hours=backoff_hours(failures, t))),
    }

    def pick(c: str) -> Column:
        kind = catalog.schema[c].dataType
        on = [(F.col(c) if v is None else v).cast(kind) for v in rules[c]]
        return F.when(ok, on[0]).when(same, on[1]).when(failed, on[2]).otherwise(F.col(c)).alias(c)

    return j.select(*(pick(c) if c in rules else F.col(c) for c in catalog.columns))


def migrate_resource(rows: DataFrame) -> DataFrame:
    """Version-1 page evidence as version 2: the one clock becomes three, set only where they are empty; a failed status gives no success."""
    fine = F.col("status_code").isNull() | F.col("status_code").isin(200, 304)
    old = F.col("version") == 1
    fill = lambda name, on: F.when(old & on, F.coalesce(F.col(name), F.col("last_checked_at"))).otherwise(F.col(name))
    return rows.withColumns({"last_success_at": fill("last_success_at", fine), "last_attempted_at": fill("last_attempted_at", F.lit(True)), "last_response_at": fill("last_response_at", F.lit(True)), "version": F.lit(2)})


def bootstrap(items: DataFrame, now: Column) -> DataFrame:
    """A first catalog from the items of a published JSON feed (catalog_id, n, id, url, title, summary): complete rows, the first of each id, dense positions from 0."""
    rows = items.select("catalog_id", "n", *(text.non_empty(F.col(c)).alias(c) for c in ("id", "url", "title", "summary"))).where("id is not null and url is not null and title is not null")
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("catalog_id", "id").orderBy("n"))).where("k = 1")
    place = F.row_number().over(Window.partitionBy("catalog_id").orderBy("n")) - 1
    return first.select("catalog_id", F.col("id").alias("stable_id"), "url", "title", place.alias("position"), now.alias("first_seen_at"), now.alias("last_seen_at"), now.alias("observed_updated_at"), "summary", F.col("summary").alias("prior_good_summary"))


def digest(entries: DataFrame, columns: list[str]) -> DataFrame:
    """(catalog_id, digest) over the material columns of all entries, clocks left out."""
    line = F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(columns)))
    rows = entries.select("catalog_id", "position", "stable_id", line.alias("line"))
    return rows.groupBy("catalog_id").agg(F.sha2(F.expr("listagg(line, '\n') within group (order by position, stable_id)"), 256).alias("digest"))


def skip_publish(changes: DataFrame, plan: DataFrame, force: bool = False, artifacts: bool = True) -> DataFrame:
    """(catalog_id, skip): nothing added, updated or removed, and nothing due."""
    c = changes.groupBy("catalog_id").agg(F.count_if(F.col("change") != "unchanged").alias("n_changed"))
    d = plan.groupBy("catalog_id").agg(F.count_if("due").alias("n_due"))
    skip = (F.coalesce("n_changed", F.lit(0)) == 0) & (F.coalesce("n_due", F.lit(0)) == 0) & F.lit(not force and artifacts)
    return c.join(d, "catalog_id", "full_outer").select("catalog_id", skip.alias("skip"))


def probe_set(entries: DataFrame, due: DataFrame, most: int | None) -> DataFrame:
    """Entries that aren't fetched this time, from the front, ``most`` of each catalog."""
    rest = entries.join(due.where("due").select(*KEY), KEY, "left_anti")
    if most is None:
        return rest
    return rest.withColumn("k", F.row_number().over(Window.partitionBy("catalog_id").orderBy("position"))).where(F.col("k") <= most).drop("k")
