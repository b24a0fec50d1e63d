"""URL functions over columns: resolution, canonical form, identity, policy."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from crawlcat.config import HostPolicy

#: Splits any reference: 2 scheme, 4 authority, 5 path, 7 query, 9 fragment (the pattern of RFC 3986, appendix B).
PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"
#: The URL namespace of RFC 4122.
NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"


def let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), 0)


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 2))


def host(url: Column) -> Column:
    """Lower-case host without user information and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, 4), r"^.*@", ""), r":[^:\]]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_replace(part(url, 5), "^$", "/")


def without_dots(p: Column) -> Column:
    """A rooted path without ``.`` and ``..`` segments."""
    names = F.split(p, "/")
    last = F.element_at(names, -1)
    kept = F.aggregate(F.slice(names, F.lit(2), F.size(names)), F.array().cast("array<string>"), lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(last.isin(".", "..") & (joined != "/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve(base: Column, href: Column) -> Column:
    """``href`` as an absolute URL against an absolute ``base``."""
    parts = F.struct(base.alias("base"), href.alias("href"), *(part(base, n).alias(f"b{n}") for n in (1, 2, 4, 5, 6)), *(part(href, n).alias(f"h{n}") for n in (2, 3, 5, 6, 8)))

    def joined(x: Column) -> Column:
        origin = F.concat(x["b2"], F.lit("://"), x["b4"])
        folder = F.regexp_replace(F.regexp_replace(x["b5"], "^$", "/"), r"[^/]*$", "")
        rooted = F.when(x["h5"].startswith("/"), x["h5"]).otherwise(F.concat(folder, x["h5"]))
        return (
            F.when(x["href"] == "", x["base"])
            .when(x["h2"] != "", x["href"])
            .when(x["h3"] != "", F.concat(x["b1"], x["href"]))
            .when(x["h5"] != "", F.concat(origin, let(rooted, without_dots), x["h6"], x["h8"]))
            .when(x["h6"] != "", F.concat(origin, x["b5"], x["h6"], x["h8"]))
            .otherwise(F.concat(origin, x["b5"], x["b6"], x["h8"]))
        )

    return let(parts, joined)


def _below(names: tuple[str, ...]) -> str:
    return "(^|\\.)(" + "|".join(re.escape(n) for n in names) + ")$" if names else "$^"


def allowed(h: Column, policy: HostPolicy) -> Column:
    exact = "^(" + "|".join(re.escape(n) for n in policy.hosts) + ")$" if policy.hosts else "$^"
    return h.rlike(f"{exact}|{_below(policy.suffixes)}")


def apex_host(h: Column, policy: HostPolicy) -> Column:
    """``www.`` dropped where the policy names the host without it, or a host below."""
    names = "|".join(re.escape(n) for n in policy.apex)
    return F.regexp_replace(h, rf"^www\.((?:.*\.)?(?:{names}))$", "$1") if names else h


def _under(h: Column, names: tuple[str, ...]) -> Column:
    return h.rlike(_below(names))


def url_error(url: Column, policy: HostPolicy) -> Column:
    """Why an absolute URL is not acceptable; null where it is."""
    return F.when(url.isNull() | (F.trim(url) == ""), "empty url").when(scheme(url) != "https", "not https").when(~allowed(host(url), policy), "host not allowed")


def canonical(url: Column, policy: HostPolicy) -> Column:
    """Canonical form of an absolute URL, null where the policy refuses it.

    Host lower-case and at its apex; port, user information and fragment
    dropped; path ``/`` by default; no query on CDN hosts.
    """
    def form(u: Column) -> Column:
        return let(apex_host(host(u), policy), lambda h: F.concat(F.lit("https://"), h, path(u), F.when(_under(h, policy.cdn), "").otherwise(part(u, 6))))

    return let(url, lambda u: F.when(url_error(u, policy).isNull(), form(u)))


def normalized(url: Column, policy: HostPolicy, loopback: bool = False) -> tuple[Column, Column]:
    """(url, error) of the stricter form: absolute only, no user information, any ``www.`` with two dots dropped, port and query kept."""
    u = F.trim(url)
    authority, h = part(u, 4), host(u)
    bare = F.when(h.startswith("www.") & (F.length(h) - F.length(F.replace(h, F.lit("."), F.lit(""))) >= 2), F.substring(h, 5, 1_000)).otherwise(h)
    port = F.regexp_extract(authority, r":(\d+)$", 1)
    keep = F.when((port != "") & ~((scheme(u) == "https") & (port == "443")) & ~((scheme(u) == "http") & (port == "80")), F.concat(F.lit(":"), port)).otherwise("")
    local = h.isin("localhost", "127.0.0.1") & F.lit(loopback)
    error = (
        F.when(u.isNull() | (u == ""), "empty url")
        .when(authority == "", "not absolute")
        .when(authority.contains("@"), "user information")
        .when((scheme(u) != "https") & ~(local & (scheme(u) == "http")), "not https")
        .when(~allowed(bare, policy) & ~local, "host not allowed")
    )
    return F.when(error.isNull(), F.concat(scheme(u), F.lit("://"), bare, keep, path(u), part(u, 6))), error


def content_candidate(url: Column, title: Column, policy: HostPolicy) -> Column:
    apex = ~_under(host(url), policy.cdn)
    return (F.coalesce(title, F.lit("")) != "") & ~(apex & path(url).isin(*policy.excluded_paths))


def uuid5(name: Column) -> Column:
    """Version-5 UUID of a URL."""
    def dashed(h: Column) -> Column:
        variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))

    return let(F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(name, "UTF-8"))), dashed)


def is_permalink(url: Column, policy: HostPolicy) -> Column:
    return ~_under(host(url), policy.cdn)


def stable_id(url: Column, policy: HostPolicy) -> Column:
    """The URL itself, or on CDN hosts a name-based UUID of it without query and fragment."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    return F.when(is_permalink(url, policy), url).otherwise(F.concat(F.lit("urn:uuid:"), uuid5(bare)))


def link_error(url: Column, policy: HostPolicy) -> Column:
    """Structural fault of a catalog link, null if there is none."""
    return F.coalesce(url_error(url, policy), F.when(url.contains("#"), "fragment").when(path(url).rlike("^/https?:/"), "nested url").when(url.rlike(r"\s"), "white space"))


def image_or_null(url: Column, policy: HostPolicy) -> Column:
    return F.when(url_error(url, policy).isNull(), url)


def index_host_allowed(url: Column, index_host: str, loopback: bool = False) -> Column:
    h = F.regexp_replace(host(url), r"^www\.", "")
    return ((scheme(url) == "https") & (h == index_host)) | (F.lit(loopback) & (scheme(url) == "http") & h.isin("localhost", "127.0.0.1"))


def self_link(json_url: Column, kind: str) -> Column:
    """Address of the RSS or Atom feed beside a JSON feed; an unknown name stays."""
    # Suffix by kind, for enriched and simple feeds.
    suffix = {"json": ("feed.json", "feed.simple.json"), "rss": ("rss.xml", "rss.simple.xml"), "atom": ("atom.xml", "atom.simple.xml")}[kind]
    plain = F.regexp_replace(json_url, r"feed\.json$", suffix[0])
    simple = F.regexp_replace(json_url, r"feed\.simple\.json$", suffix[1])
    return F.when(json_url.endswith("feed.simple.json"), simple).when(json_url.endswith("feed.json"), plain).otherwise(json_url)
