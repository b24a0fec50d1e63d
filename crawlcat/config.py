"""Host policy, thresholds and feed identity: what a deployment decides."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class HostPolicy:
    """Which hosts and paths a catalog accepts.

    ``hosts`` are exact, ``suffixes`` allow a domain and all below it.  Hosts in
    ``apex`` lose a leading ``www.``; URLs on ``cdn`` hosts lose their query and
    get an identity of their own instead of being their identity.
    """

    hosts: tuple[str, ...] = ()
    suffixes: tuple[str, ...] = ("example.com", "example.org", "example.net")
    apex: tuple[str, ...] = ("example.com", "example.org")
    cdn: tuple[str, ...] = ("example.net",)
    excluded_paths: tuple[str, ...] = ("/", "/index.html", "/articles.html", "/rss.html")
    required_paths: tuple[str, ...] = ()


@dataclass(frozen=True)
class Thresholds:
    # Limits of discovery, enrichment, planning and verification.
    min_items: int = 233
    max_response_bytes: int = 5 * 1024 * 1024
    max_artifact_bytes: int = 20 * 1024 * 1024
    summary_chars: int = 400
    min_paragraph_chars: int = 40
    max_scan_chars: int = 2_000
    hint_chars: int = 400
    freshness_days: int = 30
    max_backoff_hours: int = 168
    max_retry_after: float = 120.0
    jitter_initial: float = 0.4
    jitter_max: float = 8.0
    jitter_base: float = 2.0
    max_redirects: int = 6
    removed_share: float = 0.15
    removed_least: int = 5
    added_share: float = 0.50
    added_least: int = 20
    overlap_share: float = 0.70
    overlap_prior: int = 20
    fallback_removed_share: float = 0.05


@dataclass(frozen=True)
class FeedIdentity:
    title: str = "Linked pages"
    description: str = "Metadata feeds of linked pages, newest first."
    author: str = "The authors"
    author_url: str = "https://example.com/"
    home_page_url: str = "https://example.com/articles.html"
    feed_id: str = "tag:example.com,2026:feed"
    feed_id_simple: str = "tag:example.com,2026:feed:simple"
    generator: str = "crawlcat/0.1"
    language: str = "en-US"
    category: str = "Pages"
    ttl_minutes: int = 1440
    meta_key: str = "_catalog"


class ConfigurationError(ValueError):
    """Settings that can't be used."""


def _require_url(name: str, said: str, plain: bool) -> None:
    """An absolute address without user information; ``http`` only where ``plain`` says so or on this machine."""
    from urllib.parse import urlsplit

    u = urlsplit(said)
    if u.scheme not in ("https", "http"):
        raise ConfigurationError(f"{name} must use https: {said!r}")
    if u.username or u.password:
        raise ConfigurationError(f"{name} must not hold user information")
    if not u.hostname:
        raise ConfigurationError(f"{name} must be absolute: {said!r}")
    if u.scheme == "http" and not plain and u.hostname not in ("localhost", "127.0.0.1", "::1"):
        raise ConfigurationError(f"{name} must use https: {said!r}")


@dataclass(frozen=True)
class Settings:
    policy: HostPolicy = field(default_factory=HostPolicy)
    thresholds: Thresholds = field(default_factory=Thresholds)
    identity: FeedIdentity = field(default_factory=FeedIdentity)
    enrich: bool = True
    force: bool = False
    max_page_fetches: int | None = None
    max_link_validations: int | None = None
    validate_links: bool = False
    public_base_url: str | None = None
    feed_json_url: str | None = None
    source_url: str = "https://example.com/articles.html"
    timeout: float = 15.0
    retries: int = 3
    host_gap: float = 0.5
    #: Folder of the catalog's tables, on any store that the cluster shares; beside the feeds where it is unset.
    tables: str | None = None

    def __post_init__(self):
        if self.public_base_url is not None and not self.public_base_url.strip():
            object.__setattr__(self, "public_base_url", None)
        for name, local in (("source_url", True), ("public_base_url", False)):
            if (said := getattr(self, name)) is not None:
                _require_url(name, said.strip(), local)

    def fingerprint(self) -> str:
        """Sixteen hex digits over the settings that change what is published."""
        import hashlib

        said = "|".join(map(str, (self.policy, self.thresholds.min_items, self.enrich, self.public_base_url, self.feed_json_url, self.identity.generator)))
        return hashlib.sha256(said.encode()).hexdigest()[:16]
