"""Command line: ``python -m crawlcat.cli update|check ROOT``."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import os
import sys
from pathlib import Path

from crawlcat.config import ConfigurationError, HostPolicy, Settings, Thresholds

# Exit codes.
OK, FAILED, USAGE, NETWORK, VERIFICATION = range(5)
#: Where a job of a build service leaves values for the next ones.
OUTPUT_FILE = "GITHUB_OUTPUT"
log = logging.getLogger("crawlcat")


def _flag(said: str) -> bool:
    if said.strip().lower() in ("1", "true", "yes", "on"):
        return True
    if said.strip().lower() in ("0", "false", "no", "off"):
        return False
    raise ConfigurationError(f"not yes or no: {said!r}")


def settings(args: argparse.Namespace, env=os.environ) -> Settings:
    """Command line before environment (``CRAWLCAT_...``) before defaults."""

    def choose(name: str, kind, default):
        said = getattr(args, name)
        if said is not None:
            return said
        said = env.get(f"CRAWLCAT_{name.upper()}")
        try:
            return default if said is None else kind(said)
        except ValueError as e:
            raise ConfigurationError(f"CRAWLCAT_{name.upper()}: {e}") from e

    base, t = Settings(), Thresholds()
    suffixes = choose("hosts", str, None)
    policy = HostPolicy(suffixes=tuple(suffixes.split(","))) if suffixes else HostPolicy()
    limits = Thresholds(min_items=choose("min_items", int, t.min_items), max_response_bytes=choose("max_bytes", int, t.max_response_bytes), freshness_days=choose("freshness_days", int, t.freshness_days))
    own = {
        "enrich": _flag, "force": _flag, "validate_links": _flag, "max_page_fetches": int, "max_link_validations": int, "public_base_url": str, "source_url": str, "timeout": float, "retries": int, "host_gap": float, "tables": str,
    }
    made = Settings(policy=policy, thresholds=limits, **{n: choose(n, kind, getattr(base, n)) for n, kind in own.items()})
    for name, least in (("timeout", 0.1), ("retries", 0), ("host_gap", 0), ("max_page_fetches", 0), ("max_link_validations", 0)):
        if getattr(made, name) is not None and getattr(made, name) < least:
            raise ConfigurationError(f"{name} must be {least} at least")
    return made


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="crawlcat")
    p.add_argument("command", choices=("update", "check"))
    p.add_argument("root", type=Path)
    p.add_argument("--index", type=Path, help="HTML of the index; fetched from the source where it isn't given")
    p.add_argument("--source-url", help="address of the index")
    p.add_argument("--base-url", help="base of the links of --index; the source's address where it isn't given")
    p.add_argument("--hosts", help="comma-separated domains that are accepted")
    for name, kind in (("min-items", int), ("max-bytes", int), ("freshness-days", int), ("max-page-fetches", int), ("max-link-validations", int), ("timeout", float), ("retries", int), ("host-gap", float), ("public-base-url", str), ("tables", str)):
        p.add_argument(f"--{name}", type=kind)
    for name in ("enrich", "force", "validate-links"):
        p.add_argument(f"--{name}", action=argparse.BooleanOptionalAction, default=None)
    p.add_argument("--allow-fallback", action="store_true")
    p.add_argument("--from-feeds", action="store_true", help="begin with the feed that is published instead of the catalog")
    p.add_argument("--offline", action="store_true", help="fetch no pages")
    p.add_argument("--result-file", type=Path)
    p.add_argument("--quiet", "-q", action="store_true")
    p.add_argument("--verbose", "-v", action="store_true")
    return p


def emit(done, result_file: Path | None, env=os.environ) -> None:
    """Leave the action for a build service and in the result file."""
    lines = f"action={done.action}\nitems={done.n_items}\nchanged={'false' if done.action == 'unchanged' else 'true'}\n"
    for path in {str(p) for p in (result_file, env.get(OUTPUT_FILE)) if p}:
        with open(path, "a") as f:
            f.write(lines)


def read_index(path: Path, most: int) -> str:
    """The index of a file, decoded as a page is; at most ``most`` bytes."""
    from crawlcat.sources.decode import decode

    with path.open("rb") as f:
        body = f.read(most + 1)
    if len(body) > most:
        raise ConfigurationError(f"{path} is larger than {most} bytes")
    return decode(body)[0]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.ERROR if args.quiet else logging.DEBUG if args.verbose else logging.INFO, format="%(message)s", stream=sys.stderr)
    try:
        chosen = settings(args)
        index = read_index(args.index, chosen.thresholds.max_response_bytes) if args.command == "update" and args.index else None
    except (ConfigurationError, OSError) as e:
        print(e, file=sys.stderr)
        return USAGE
    from pyspark.sql import SparkSession

    from crawlcat.plans.update import NetworkError, UpdateError, check, update

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if args.command == "check":
            print(f"{check(spark, args.root, chosen)} items verified")
            return OK
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        done = update(spark, args.root, index, args.base_url or chosen.source_url, now, chosen, allow_fallback=args.allow_fallback, live=not args.offline, from_feeds=args.from_feeds)
        emit(done, args.result_file)
        if done.probes:
            checked, failed, few = done.probes
            log.info("Link probes: %d checked, %d failed", checked, failed)
            for said in few:
                log.warning("WARNING link failed: %s", said)
        log.debug(json.dumps(done.changes))
        print(f"{done.action}: {done.n_items} items, {done.changes}")
        return OK
    except NetworkError as e:
        print(e, file=sys.stderr)
        return NETWORK
    except UpdateError as e:
        print(e, file=sys.stderr)
        return VERIFICATION if args.command == "check" else FAILED


if __name__ == "__main__":
    sys.exit(main())
