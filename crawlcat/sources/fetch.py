"""Live source: pages and probes by HTTP, one polite client a partition.

Only ``urllib``, without the proxies of the environment.  Every hop is held
against the host policy, bodies are capped before and while they are read, and
what is worth it is tried again after the longer of a random wait and what the
server asked for.  Errors become rows.  A task that runs again fetches again,
so the result belongs in a written table.
"""

from __future__ import annotations

import datetime as dt
import email.utils
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from crawlcat.config import HostPolicy, Thresholds
from crawlcat.functions import urls
from crawlcat.functions.http import REDIRECTS, RETRYABLE

SCHEMA = "url string, final_url string, hops array<string>, status int, content_type string, etag string, last_modified string, body binary, error_kind string, error_message string"
# Statuses to a HEAD that are asked again by GET.
HEAD_REFUSED = (405, 501)


class Exchange(NamedTuple):
    """A row of SCHEMA; ``hops`` are the addresses that were redirected."""

    url: str
    final_url: str
    hops: list[str]
    status: int | None = None
    content_type: str | None = None
    etag: str | None = None
    last_modified: str | None = None
    body: bytes | None = None
    error_kind: str | None = None
    error_message: str | None = None


@dataclass(frozen=True)
class Client:
    """How to fetch; ``opener``, ``sleep``, ``chance`` and ``now`` are there to be replaced in tests."""

    policy: HostPolicy
    limits: Thresholds = Thresholds()
    attempts: int = 4
    timeout: float = 15.0
    agent: str = "crawlcat/0.1"
    gap: float = 0.5
    opener: object | None = None
    sleep: Callable[[float], None] = time.sleep
    chance: Callable[[], float] = random.random
    now: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc)


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def permitted(url: str, policy: HostPolicy) -> bool:
    u = urllib.parse.urlsplit(url)
    h = (u.hostname or "").lower()
    return u.scheme == "https" and not u.username and (h in policy.hosts or any(h == s or h.endswith(f".{s}") for s in policy.suffixes))


def asked_wait(header: str | None, now: dt.datetime, most: float) -> float:
    """Seconds that a Retry-After header asks for, by number or date; 0 if neither."""
    said = (header or "").strip()
    if said.removeprefix("+").isascii() and said.removeprefix("+").isdigit():
        return float(min(most, int(said)))
    try:
        return min(most, max(0.0, (email.utils.parsedate_to_datetime(said) - now).total_seconds()))
    except (ValueError, TypeError):
        return 0.0


def fetch(url: str, client: Client, etag: str | None = None, last_modified: str | None = None, method: str = "GET") -> Exchange:
    """One exchange: retries what is worth it, follows permitted hops, asks conditionally where there are validators."""
    opener = client.opener or urllib.request.build_opener(urllib.request.ProxyHandler({}), _NoRedirect)
    t, tried = client.limits, 0
    conditions = {k: v for k, v in (("If-None-Match", etag), ("If-Modified-Since", last_modified)) if v}
    while True:
        at, hops, after = url, [], 0.0
        while True:
            if not permitted(at, client.policy):
                return Exchange(url, at, hops, error_kind="host", error_message="host not allowed")
            request = urllib.request.Request(at, headers={"User-Agent": client.agent, **({} if hops else conditions)}, method=method)
            try:
                try:
                    answer = opener.open(request, timeout=client.timeout)
                except urllib.error.HTTPError as e:
                    answer = e
                status, head = answer.status if hasattr(answer, "status") else answer.code, answer.headers if hasattr(answer, "headers") else {}
                if status in REDIRECTS and head.get("Location"):
                    if len(hops) >= t.max_redirects:
                        return Exchange(url, at, hops, status, error_kind="redirects", error_message="too many redirects")
                    hops.append(at)
                    at = urllib.parse.urljoin(at, head["Location"])
                    continue
                said = (head.get("Content-Length") or "").strip().removeprefix("+")
                body = b"" if method == "HEAD" else None if said.isdigit() and int(said) > t.max_response_bytes else answer.read(t.max_response_bytes + 1)
                if body is None or len(body) > t.max_response_bytes:
                    return Exchange(url, at, hops, status, head.get("Content-Type"), error_kind="size", error_message="too large")
                made = Exchange(url, at, hops, status, head.get("Content-Type"), head.get("ETag"), head.get("Last-Modified"), body)
                if status >= 400:
                    made = made._replace(error_kind="status", error_message=f"HTTP {status}")
                if status not in RETRYABLE:
                    return made
                after = asked_wait(head.get("Retry-After"), client.now(), t.max_retry_after)
            except OSError as e:
                made = Exchange(url, at, hops, error_kind="transport", error_message=f"{type(e).__name__}: {e}"[:200])
            break
        tried += 1
        if tried >= client.attempts:
            return made
        client.sleep(max(client.chance() * min(t.jitter_max, t.jitter_initial * t.jitter_base ** (tried - 1)), after))


def probe(url: str, client: Client) -> str | None:
    """What is wrong with a link, if anything: HEAD, or GET where that is refused."""
    made = fetch(url, client, method="HEAD")
    if made.status in HEAD_REFUSED:
        made = fetch(url, client)
    if made.error_kind:
        return f"{url} → {made.error_message}"
    return None


def _by_host(links: DataFrame, ask, schema: str, arrow: pa.Schema, client: Client) -> DataFrame:
    """Rows of ``ask`` of every link; a host's links stay in one task, ``gap`` seconds apart."""

    def rows(batches):
        last: dict[str, float] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                host = urllib.parse.urlsplit(row[0]).hostname or ""
                client.sleep(max(0.0, last.get(host, -client.gap) + client.gap - time.monotonic()))
                made = ask(*row)
                last[host] = time.monotonic()
                yield pa.RecordBatch.from_pylist([dict(zip(arrow.names, made))], arrow)

    return links.where("url is not null").repartition(urls.host(F.col("url"))).mapInArrow(rows, schema)


_ARROW = pa.schema([("url", pa.string()), ("final_url", pa.string()), ("hops", pa.list_(pa.string())), ("status", pa.int32()), ("content_type", pa.string()), ("etag", pa.string()), ("last_modified", pa.string()), ("body", pa.binary()), ("error_kind", pa.string()), ("error_message", pa.string())])


def fetch_pages(links: DataFrame, client: Client) -> DataFrame:
    """SCHEMA rows of ``links`` (url, etag, last_modified)."""
    return _by_host(links.select("url", "etag", "last_modified"), lambda u, e, m: fetch(u, client, e, m), SCHEMA, _ARROW, client)


def probe_links(links: DataFrame, client: Client) -> DataFrame:
    """(url, failure) of ``links`` (url); a null failure is a link that answers."""
    return _by_host(links.select("url"), lambda u: (u, probe(u, client)), "url string, failure string", pa.schema([("url", pa.string()), ("failure", pa.string())]), client)


def probe_report(probes: DataFrame, most: int = 10) -> tuple[int, int, list[str]]:
    """(checked, failed, the first failures): links stay in the catalog whatever the probe says."""
    n = probes.agg(F.count("*").alias("n"), F.count("failure").alias("bad")).head()
    return n["n"], n["bad"], [r["failure"] for r in probes.where("failure is not null").orderBy("url").limit(most).collect()]
