"""A whole run: index to catalog to verified, published feeds.

Stages are lazy DataFrames; what leaves the cluster are the feed documents and
a small state file that points to the catalog table of this run.  The index and
the pages come from the live source or, where they are given, as recorded
exchanges; links may be probed.  The state keeps the index's validators, the
cursor of the page budget and the fingerprint of the settings, so a run asks
conditionally and goes on where the last one stopped.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from crawlcat.config import Settings
from crawlcat.functions import http, urls
from crawlcat.operators import catalog, discovery, feeds, publish, verify
from crawlcat.sources import decode, fetch, html

ENTRY = (
    "catalog_id int, stable_id string, url string, title string, position int, first_seen_at timestamp, last_seen_at timestamp, observed_updated_at timestamp, summary string, prior_good_summary string, summary_source string, "
    "summary_quality double, published_hint string, published_at timestamp, etag string, last_modified string, raw_sha256 string, decoded_sha256 string, selected_encoding string, status_code int, last_checked_at timestamp, "
    "last_success_at timestamp, last_attempted_at timestamp, last_response_at timestamp, failure_count int, next_retry_at timestamp, last_error_kind string, last_error_message string"
)
MATERIAL = ["position", "stable_id", "url", "title", "summary", "published_hint", "published_at", "raw_sha256"]
VERSION = 2
OUTPUTS = {"enriched": ("rss.xml", "atom.xml", "feed.json"), "simple": ("rss.simple.xml", "atom.simple.xml", "feed.simple.json")}
FILES = [n for names in OUTPUTS.values() for n in names]


class UpdateError(RuntimeError):
    """A run that must not publish."""


class NetworkError(UpdateError):
    """The index couldn't be fetched."""


@dataclass(frozen=True)
class Outcome:
    action: str  #: unchanged, state_changed or updated
    n_items: int
    changes: dict[str, int]
    n_fetched: int = 0
    probes: tuple[int, int, list[str]] | None = None  #: checked, failed, the first failures


@dataclass(frozen=True)
class Index:
    """What is known of the index after this run's look at it; ``html`` is null where it hasn't changed."""

    html: str | None
    etag: str | None = None
    last_modified: str | None = None
    raw_sha256: str | None = None
    status_code: int | None = 200


def tables(root: Path, settings: Settings) -> str:
    return (settings.tables or str(root / "catalog")).rstrip("/")


def state_of(root: Path) -> dict:
    """The state of the last run; empty where there is none."""
    pointer = root / "catalog.json"
    if not pointer.exists():
        return {}
    try:
        said = json.loads(pointer.read_text())
        return {"generation": str(said["generation"]), "version": int(said["version"]), **said}
    except (ValueError, KeyError, TypeError, AttributeError) as e:
        raise UpdateError(f"catalog.json can't be read: {e}") from e


def load(spark: SparkSession, root: Path, settings: Settings = Settings()) -> DataFrame:
    """The catalog of the last run, brought to the present version; empty where there is none."""
    state = state_of(root)
    if not state:
        return spark.createDataFrame([], ENTRY)
    if state["version"] not in (1, VERSION):
        raise UpdateError(f"catalog.json has version {state['version']}")
    rows = spark.read.schema(ENTRY).parquet(f"{tables(root, settings)}/{state['generation']}")
    if state["version"] == 1:
        rows = catalog.migrate_resource(rows.withColumn("version", F.lit(1))).select(*rows.columns)
    return rows


def bootstrapped(spark: SparkSession, root: Path, now: str) -> DataFrame:
    """A first catalog from the feed that is published, if there is one."""
    empty = spark.createDataFrame([], ENTRY)
    path = root / "feed.json"
    if not path.exists():
        return empty
    views, broken = verify.parse_json(spark.createDataFrame([("0", path.read_text())], "feed_id string, body string"))
    if broken.limit(1).count():
        raise UpdateError("feed.json can't be read")
    items = views.select(F.lit(0).alias("catalog_id"), F.col("idx").alias("n"), F.col("item_id").alias("id"), "url", "title", "summary")
    return empty.unionByName(catalog.bootstrap(items, F.lit(now).cast("timestamp")), allowMissingColumns=True)


def ask_index(settings: Settings, client: fetch.Client, known: dict) -> Index:
    """The index by a conditional request; raises ``NetworkError``."""
    made = fetch.fetch(settings.source_url, client, known.get("etag"), known.get("last_modified"))
    if made.status == 304 and (known.get("etag") or known.get("last_modified")):
        return Index(None, made.etag or known.get("etag"), made.last_modified or known.get("last_modified"), known.get("raw_sha256"), 304)
    if made.error_kind or made.status != 200 or made.body is None:
        raise NetworkError(f"{settings.source_url}: {made.error_message or f'HTTP {made.status}'}")
    charset = (made.content_type or "").lower().partition("charset=")[2].strip("\"' ;") or None
    return Index(decode.decode(made.body, charset)[0], made.etag, made.last_modified, hashlib.sha256(made.body).hexdigest())


def _found(spark: SparkSession, index: Index, base_url: str, prior: DataFrame, settings: Settings, allow_fallback: bool) -> tuple[DataFrame, int]:
    """The items that the index lists, checked, or those of the catalog where it hasn't changed."""
    if index.html is None:
        return prior.select("catalog_id", "stable_id", "url", "title", "position"), prior.count()
    t, policy = settings.thresholds, settings.policy
    page = spark.createDataFrame([(0, base_url, index.html)], "index_id int, base_url string, html string")
    found, report = discovery.discover(html.page_anchors(page, "index_id", "html", "base_url"), policy, t.min_items, allow_fallback)
    said = report.head()
    if said is None or said["error"]:
        raise UpdateError(said["error"] if said else "no anchors")
    if policy.required_paths and (lacking := discovery.missing_required(found, list(policy.required_paths)).head()):
        raise UpdateError(f"required paths are missing: {lacking['missing']}")
    if wrong := found.select(urls.link_error(F.col("url"), policy).alias("e"), "url").where("e is not null").head():
        raise UpdateError(f"{wrong['url']}: {wrong['e']}")
    found = found.select(F.lit(0).alias("catalog_id"), "stable_id", "url", "title", (F.col("position") - 1).alias("position"))
    odd = discovery.anomaly(prior, found, F.lit(said["strategy"] == "fallback"), t).head()
    if odd and odd["reason"]:
        raise UpdateError(f"anomalous index: {odd['reason']}")
    return found, said["n_items"]


def evidence_of(exchanges: DataFrame, asked: DataFrame, settings: Settings) -> DataFrame:
    """Rows for ``catalog.merge`` of every asked page; ``exchanges`` are rows of the live source.  A page without a row is a failure."""
    got = exchanges.dropDuplicates(["url"])
    kind = F.when(F.col("status").between(200, 299) & F.col("error_kind").isNull() & F.col("content_type").isNotNull() & ~http.is_soft_html(http.media_type(F.col("content_type"))), "content_type")
    got = got.withColumn("error_kind", F.coalesce("error_kind", kind)).withColumn("fine", F.coalesce(F.col("status").between(200, 299), F.lit(False)) & F.col("error_kind").isNull())
    read = decode.decoded(got.where("fine").select("url", "body", http.charset(F.col("content_type")).alias("transport_charset")), "url")
    pages = html.metadata(read.select("url", F.col("url").alias("page_id"), "text", "encoding", F.sha2("text", 256).alias("decoded_sha256")), settings.policy, settings.thresholds, html="text", keep=("encoding", "decoded_sha256"))
    said = pages.select(F.col("page_id").alias("url"), "summary", "published_hint", F.col("encoding").alias("selected_encoding"), "decoded_sha256")
    facts = got.select("url", "status", "etag", "last_modified", F.when(F.col("fine"), F.sha2("body", 256)).alias("raw_sha256"), "error_kind", "error_message")
    return asked.select("catalog_id", "stable_id", "url").join(facts, "url", "left").join(said, "url", "left").withColumn("published_at", F.lit(None).cast("timestamp"))


def recorded(pages: DataFrame) -> DataFrame:
    """Exchanges as rows of the live source from a table of url, status, html (null: no answer), etag."""
    null = lambda kind: F.lit(None).cast(kind)
    return pages.select("url", "status", null("string").alias("content_type"), "etag", (F.col("last_modified") if "last_modified" in pages.columns else null("string")).alias("last_modified"), F.encode("html", "UTF-8").alias("body"), null("string").alias("error_kind"), null("string").alias("error_message"))


def update(
    spark: SparkSession, root: Path, index_html: str | None, base_url: str, now: str, settings: Settings = Settings(), pages: DataFrame | None = None, allow_fallback: bool = False, live: bool = False, from_feeds: bool = False, client: fetch.Client | None = None,
) -> Outcome:
    """One run.

    ``index_html`` null: the index is fetched from ``source_url``.  ``pages``
    are recorded exchanges (url, status, html, etag); with ``live`` pages that
    are due are fetched instead.  Raises ``UpdateError`` for an index of too few
    items, missing required paths, addresses that can't be published, an
    anomalous set, or feeds that don't verify; nothing is published then.
    """
    at, t = F.lit(now).cast("timestamp"), settings.thresholds
    client = client or fetch.Client(settings.policy, t, settings.retries + 1, settings.timeout, settings.identity.generator, settings.host_gap)
    state = {} if from_feeds else state_of(root)
    prior = load(spark, root, settings) if state else bootstrapped(spark, root, now)
    known = state.get("index") or {}
    same_settings = state.get("settings") == settings.fingerprint()
    index = Index(index_html, raw_sha256=known.get("raw_sha256")) if index_html is not None else ask_index(settings, client, known)
    found, n_items = _found(spark, index, base_url, prior, settings, allow_fallback)

    changes = catalog.change(prior, found)
    counted = {r["change"]: r["n"] for r in changes.groupBy("change").agg(F.count("*").alias("n")).collect()}
    entries = catalog.reconcile(prior, found, at)
    reasons = catalog.reasons(catalog.success_clock(F.col("last_success_at"), F.col("last_checked_at")), F.col("summary"), F.col("next_retry_at"), F.lit(False), at, settings.enrich, settings.force, t)
    cursor = max(0, int(state.get("cursor") or 0))
    plan = catalog.grant(entries.withColumn("due", ~F.array_contains(reasons, "not_due")), settings.max_page_fetches, cursor)
    ready = all((root / n).exists() for n in FILES)
    if same_settings and catalog.skip_publish(changes, plan.select("catalog_id", F.col("granted").alias("due")), settings.force, ready).head()["skip"]:
        return Outcome("unchanged", n_items, counted)

    generation, folder = uuid.uuid4().hex, tables(root, settings)
    probes, served = None, plan.where("granted").count()
    if settings.validate_links:
        rest = catalog.probe_set(plan, plan.select("catalog_id", "stable_id", (F.col("granted") & F.lit(settings.enrich)).alias("due")), settings.max_link_validations)
        fetch.probe_links(rest, client).write.parquet(f"{folder}/probes-{generation}")
        probes = fetch.probe_report(spark.read.parquet(f"{folder}/probes-{generation}"))
    if settings.enrich and (pages is not None or live):
        asked = plan.where("granted").select("catalog_id", "stable_id", "url", "etag", "last_modified")
        got = recorded(pages) if pages is not None else _kept(fetch.fetch_pages(asked, client), f"{folder}/exchanges-{generation}")
        entries = catalog.merge(entries, evidence_of(got, asked, settings), at, t)

    _kept(entries.select(*(f.name for f in prior.schema.fields)), f"{folder}/{generation}")
    entries = spark.read.schema(ENTRY).parquet(f"{folder}/{generation}")
    items = feeds.snapshot(entries, settings.identity, t)
    feeds.require_clocks(items)
    index_hash = hashlib.sha256(index.html.encode()).hexdigest() if index.html is not None else known.get("decoded_sha256") or index.raw_sha256
    rows = {r["variant"]: r for r in feeds.documents(items, settings.identity, feed_urls(settings), index_hash, _fingerprint(entries)).collect()}
    if set(rows) != set(OUTPUTS):
        raise UpdateError("the catalog is empty")
    verify_documents(spark, {v: (r["rss"], r["atom"], r["json"]) for v, r in rows.items()}, settings)
    files = {n: rows[v][k].encode() for v, names in OUTPUTS.items() for n, k in zip(names, ("rss", "atom", "json"))}
    same = not settings.force and ready and all((root / n).read_bytes() == b for n, b in files.items()) and _digest(prior) == _digest(entries)
    step = cursor if settings.max_page_fetches is None else (cursor + max(1, served)) % max(1, n_items)
    saved = {
        "generation": generation, "previous": state.get("generation"), "version": VERSION, "settings": settings.fingerprint(), "generator": settings.identity.generator, "cursor": step,
        "index": {"etag": index.etag or known.get("etag"), "last_modified": index.last_modified or known.get("last_modified"), "raw_sha256": index.raw_sha256, "decoded_sha256": index_hash, "last_checked_at": now, "status_code": index.status_code},
    }
    pointer = {"catalog.json": json.dumps(saved, indent=2, sort_keys=True).encode()}
    publish.publish(root, pointer if same else files | pointer, last="catalog.json")
    # A reader may still be at the generation before this one.
    for name in (f"exchanges-{generation}", f"probes-{generation}", state.get("previous")):
        if name:
            _removed(spark, f"{folder}/{name}")
    return Outcome("state_changed" if same else "updated", n_items, counted, served if settings.enrich and (pages is not None or live) else 0, probes)


def feed_urls(settings: Settings) -> dict[str, str | None]:
    """The public address of the JSON feed of each variant."""
    base = settings.public_base_url
    own = settings.feed_json_url or (f"{base.rstrip('/')}/feed.json" if base else None)
    return {"enriched": own, "simple": own and own.replace("feed.json", "feed.simple.json")}


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _removed(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _fingerprint(entries: DataFrame) -> str | None:
    row = discovery.index_fingerprint(entries.select(F.col("catalog_id").alias("index_id"), (F.col("position") + 1).alias("position"), "stable_id", "url", "title")).head()
    return row["fingerprint"] if row else None


def _digest(entries: DataFrame) -> str | None:
    row = catalog.digest(entries, MATERIAL).head()
    return row["digest"] if row else None


def verify_documents(spark: SparkSession, documents: dict[str, tuple[str, str, str]], settings: Settings = Settings()) -> None:
    """Hold the three formats of every variant against each other; raises ``UpdateError``."""
    t = settings.thresholds
    for variant, bodies in documents.items():
        if any(len(b.encode()) > t.max_artifact_bytes for b in bodies):
            raise UpdateError(f"{variant}: a feed is too large")
    rows = spark.createDataFrame([(v, *b) for v, b in documents.items()], "feed_id string, rss string, atom string, json string")
    parsed = [f(rows.select("feed_id", F.col(c).alias("body"))) for f, c in ((verify.parse_rss, "rss"), (verify.parse_atom, "atom"), (verify.parse_json, "json"))]
    views, broken = parsed[0][0], parsed[0][1]
    for v, b in parsed[1:]:
        views, broken = views.unionByName(v), broken.unionByName(b)
    faults = broken.unionByName(verify.duplicates(views).drop("first_idx")).unionByName(verify.field_faults(views, t.summary_chars)).unionByName(verify.parity(views, t.min_items))
    try:
        verify.raise_on_failure(faults)
    except ValueError as e:
        raise UpdateError(str(e)) from e


def check(spark: SparkSession, root: Path, settings: Settings = Settings()) -> int:
    """Verify what is published against itself and the catalog; the number of items."""
    read = lambda *names: tuple((root / n).read_text() for n in names)
    try:
        documents = {v: read(*names) for v, names in OUTPUTS.items()}
        entries = load(spark, root, settings)
    except FileNotFoundError as e:
        raise UpdateError(f"missing: {e.filename}") from e
    verify_documents(spark, documents, settings)
    for variant, bodies in documents.items():
        views = verify.parse_json(spark.createDataFrame([("0", bodies[2])], "feed_id string, body string"))[0]
        wrong = verify.order_parity(entries.withColumn("catalog_id", F.col("catalog_id").cast("string")), views).limit(1).collect()
        if wrong:
            raise UpdateError(f"{variant}: the feed isn't in the catalog's order at {wrong[0]['idx']}")
    return entries.count()
