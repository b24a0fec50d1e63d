"""Transport decisions over recorded requests and responses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from crawlcat.config import HostPolicy, Thresholds
from crawlcat.functions.urls import allowed, host, scheme

# Statuses by what a client does about them.
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)
PERMANENT_LEAST, PERMANENT_MOST = 400, 499
RETRYABLE_CLIENT = (408, 425, 429)
REDIRECTS = (301, 302, 303, 307, 308)
# Encodings by label; all Latin-1 names are read as windows-1252.
ENCODINGS = {"utf-8": "utf-8", "utf8": "utf-8", "windows-1252": "windows-1252", "cp1252": "windows-1252", "iso-8859-1": "windows-1252", "latin-1": "windows-1252", "latin1": "windows-1252"}


def is_retryable(status: Column) -> Column:
    return status.isin(*RETRYABLE)


def is_permanent(status: Column) -> Column:
    return status.between(PERMANENT_LEAST, PERMANENT_MOST) & ~status.isin(*RETRYABLE_CLIENT)


def result_kind(status: Column) -> Column:
    return F.when(status == 304, "not_modified").when(status.between(200, 299), "fetched").otherwise("failed")


def encoding(label: Column) -> Column:
    key = F.replace(F.lower(F.trim(label)), F.lit("_"), F.lit("-"))
    out = None
    for name, is_ in ENCODINGS.items():
        out = (F if out is None else out).when(key == name, is_)
    return out


def media_type(header: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.element_at(F.split(header, ";"), 1))), F.lit(""))


def charset(header: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(header, r"""(?i);\s*charset\s*=\s*["']?([^"';\s]+)""", 1)), F.lit(""))


def is_soft_html(kind: Column) -> Column:
    return F.coalesce(kind, F.lit("")).isin("text/html", "application/xhtml+xml", "application/xml", "text/xml", "text/plain")


def content_length(header: Column) -> Column:
    return F.when(F.trim(header).rlike(r"^\+?\d{1,18}$"), F.trim(header).cast("bigint"))


def retry_after(header: Column, now: Column, t: Thresholds = Thresholds()) -> Column:
    """Seconds to wait by a Retry-After header: digits or an HTTP date; null if neither."""
    s = F.trim(header)
    seconds = F.when(F.length(F.regexp_replace(s, r"^\+?0*", "")) > 9, F.lit(t.max_retry_after)).otherwise(F.try_to_number(F.regexp_replace(s, r"^\+", ""), F.lit("999999999999")).cast("double"))
    date = F.regexp_extract(s, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1)
    ahead = (F.unix_timestamp(F.try_to_timestamp(F.nullif(date, F.lit("")), F.lit("dd MMM yyyy HH:mm:ss"))) - F.unix_timestamp(now)).cast("double")
    raw = F.when(s.rlike(r"^\+?\d+$"), seconds).otherwise(ahead)
    return F.when(raw.isNotNull(), F.least(F.lit(t.max_retry_after), F.greatest(F.lit(0.0), raw)))


def jitter_bound(attempt: Column, t: Thresholds = Thresholds()) -> Column:
    """Upper bound of the full-jitter wait before the next attempt."""
    n = F.greatest(attempt, F.lit(1)) - 1
    return F.least(F.lit(t.jitter_max), F.lit(t.jitter_initial) * F.pow(F.lit(t.jitter_base), F.least(n, F.lit(60)).cast("double")))


def wait_bound(attempt: Column, after: Column, t: Thresholds = Thresholds()) -> Column:
    return F.greatest(jitter_bound(attempt, t), F.coalesce(after, F.lit(0.0)))


def conditional_headers(etag: Column, last_modified: Column) -> Column:
    every = F.create_map(F.lit("If-None-Match"), etag, F.lit("If-Modified-Since"), last_modified)
    return F.map_filter(every, lambda _, v: v.isNotNull() & (v != ""))


def hop_allowed(url: Column, policy: HostPolicy, loopback_start: Column | None = None) -> Column:
    local = host(url).isin("localhost", "127.0.0.1")
    ours = (scheme(url) == "https") & allowed(host(url), policy)
    return ours if loopback_start is None else ours | (loopback_start & local)


def backoff_hours(failures: Column, t: Thresholds = Thresholds()) -> Column:
    """1, 2, 4, ... hours, at most a week."""
    n = F.least(F.greatest(failures - 1, F.lit(0)), F.lit(30))
    return F.least(F.lit(t.max_backoff_hours), F.pow(F.lit(2.0), n.cast("double")).cast("int"))


def host_schedule_start(position: Column, gap: float) -> Column:
    """Seconds from the start at which the n-th request (from 0) of a host may go."""
    return position * F.lit(gap)
