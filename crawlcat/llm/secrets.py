"""Secret scans with corpus-wide ownership frequency.

Candidates are the base patterns and long mixed-character strings.  Each value
is hashed and counted by distinct owner and repository over the whole corpus.
A value of several owners, or of one that has it in very many repositories
and shares it with another, is a copied example; any other that looks random
is live: it belongs to its owner.  Live strings that no base pattern covers
are added as spans of kind ``owned``; base spans stay whatever the verdict.

DataFrame functions only.  The texts are read once into a narrow written table
of candidates; the counts pre-aggregate by (hash, owner, repository), then by
(hash, owner), so a value in a third of all rows reaches the shuffle once a
task and is spread by its repositories.  Only examples are joined back to the
candidates, by a key that adaptive execution splits where it is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlcat.llm.common import written
from crawlcat.llm.spans import Kind, hits, listing, placed, replaced, searched, text_key

#: A value of this many owners or more is an example; so is one of this many repositories, of more owners than one.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 20
#: Different characters of a random-looking value, at least.
LIVE_DISTINCT = 8

# Fixed values of the base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
#: The added kind: 20 characters and more with a digit and letters of either case.
OWNED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"

_some = lambda v: F.lit(True)
_mixed = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]") & (F.size(F.array_distinct(F.split(v, ""))) >= 14)
KINDS = [
    Kind("assign", ASSIGN, 2, lambda v: F.length(v) >= 6, lambda v: F.length(v) >= 6, "(?i:passw|secret|token|api_?key)"),
    Kind("access", ACCESS, 0, _some, _some, "AKIA"),
    Kind("hex", HEX, 0, _some, _some, "[0-9a-f]{24}"),
    Kind("owned", OWNED, 0, _mixed, _mixed, "[A-Za-z0-9+/_=-]{20}"),
]
NAMES = [k.name for k in KINDS]
BASE = 3


def ownership(spans: DataFrame, owners: DataFrame) -> DataFrame:
    """(h, n_owners, n_repos) of every value; ``spans`` has key and h, ``owners`` key, owner and repo.  A repository is told by its owner and name."""
    held = spans.select("key", "h").distinct().join(owners.distinct(), "key").groupBy("h", "owner", "repo").agg(F.lit(1).alias("one"))
    return held.groupBy("h", "owner").agg(F.count("*").alias("repos")).groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """Rows of ``docs`` as (doc_id, key, spans); spans are (start, k, end, value, verdict).

    By default every document is a repository of its source.  The verdict is
    ``example``, ``live`` or ``weak`` (not an example, but not random-looking).
    A null text counts as empty, a null repository or owner as one more of its
    own; where the table has no such column, all rows have the same.  Repeated
    rows get the same spans each, and count once for their owner.  An empty
    table gives no rows.
    """
    named = lambda c: (F.col(c) if c in docs.columns else F.lit(None)).cast("string")
    rows = docs.select("doc_id", named(repo_col).alias("repo"), named(owner_col).alias("owner"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = written(searched(rows, KINDS).select("doc_id", "repo", "owner", text_key().alias("key"), hits(KINDS).alias("hits")), "candidates")
    spans = placed(found, KINDS).withColumn("h", F.md5("value"))
    counts = ownership(spans, found.where(F.size("hits") > 0).select("key", "repo", "owner"))
    example = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_owners") > 1) & (F.col("n_repos") >= EXAMPLE_REPOS)
    random = F.size(F.array_distinct(F.split("value", ""))) >= LIVE_DISTINCT
    verdict = F.when(F.col("example"), "example").when(random, "live").otherwise("weak")
    judged = spans.join(counts.where(example).select("h", F.lit(True).alias("example")), "h", "left").withColumn("verdict", verdict)
    by_key = judged.where((F.col("k") < BASE) | (F.col("verdict") == "live")).groupBy("key").agg(F.collect_list(F.struct("start", "k", "end", "value", "verdict")).alias("spans"))
    # An added span inside or across a base one says nothing new.
    base = F.filter("spans", lambda s: s["k"] < BASE)
    clear = F.filter("spans", lambda s: (s["k"] < BASE) | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,value:string,verdict:string>>")
    return found.select("doc_id", "key").join(by_key.select("key", clear.alias("spans")), "key", "left").withColumn("spans", F.coalesce("spans", none))


def report(scanned: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    of = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long")
    by = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long")
    return scanned.select(
        "doc_id", *(of(k).alias(f"n_{NAMES[k]}") for k in range(BASE)),
        F.sha2(listing(F.col("spans"), NAMES, lambda s: s["k"] < BASE), 256).alias("base_sha256"),
        listing(F.col("spans"), NAMES).alias("spans"),
        by("live").alias("n_live"), by("example").alias("n_example"),
    )


def redact(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """``docs`` with every span but examples replaced by ``[kind]``.

    All columns stay, whatever they are called; a null text stays null,
    repeated rows are answered alike, an empty table gives no rows.
    """
    live = scan(docs, repo_col, owner_col).select("key", F.filter("spans", lambda s: s["verdict"] != "example").alias("spans"))
    kinds = F.array(*(F.lit(f"[{n}]") for n in NAMES))
    return replaced(docs, live, lambda s: F.get(kinds, s["k"]))
