"""Text, digest and date functions over columns."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Months, promotion and navigation lines, in their order.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
PROMO = r"(?i)(want to start a startup|get funded by y combinator|subscribe|click here|sign up for|join our newsletter|follow us|share this)"
NAV_LIKE = r"(?i)(want to start a startup|get funded by y combinator|\bhome\b\s*[|/]\s*\babout\b|\bmenu\b|\bnavigation\b)"
CHROME_WORDS = ("home", "about", "essays", "rss", "index")
REPLACEMENT = "\ufffd"
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


@functools.lru_cache
def _unsettled() -> str:
    """Class of the characters that composition may change: marks, vowel and final jamo, and whatever isn't its own composed form."""
    alone = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    first = [c for c, last in zip(alone, [-2, *alone]) if c != last + 1]
    final = [c for c, after in zip(alone, [*alone[1:], -2]) if c != after - 1]
    return r"[\p{M}\x{1161}-\x{1175}\x{11A8}-\x{11C2}" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in zip(first, final)) + "]"


@F.pandas_udf(StringType())
def _composed(x: pd.Series) -> pd.Series:
    return x.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")


def nfc(s: Column) -> Column:
    """Composed form; Spark has no function of its own for it, so texts that may change, and only these, go through Python."""
    # All characters below the first mark are settled: one range to test before the many.
    return F.coalesce(_composed(F.when(s.rlike(r"[\x{300}-\x{10FFFF}]") & s.rlike(_unsettled()), s)), s)


def blank(s: Column) -> Column:
    """Whether there is nothing but white space; null for null."""
    return ~s.rlike(f"[^{SPACE[1:-2]}]")


def trimmed(s: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(s, f"^{SPACE}|{SPACE}$", "")


def normalized(s: Column, compose: bool = True) -> Column:
    """Composed, without controls, white space runs as one space, trimmed."""
    s = nfc(s) if compose else s
    s = F.regexp_replace(s, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return F.trim(F.regexp_replace(s, SPACE, " "))


def non_empty(s: Column) -> Column:
    return F.nullif(trimmed(s), F.lit(""))


def right_trimmed(s: Column) -> Column:
    return F.regexp_replace(s, SPACE + "$", "")


def truncated(s: Column, limit: int = 400) -> Column:
    """At most ``limit`` characters, cut at the last space, with an ellipsis."""
    if limit <= 1:
        return F.when(F.length(s) <= limit, s).otherwise("…"[:limit])
    head = F.substring(s, 1, limit - 1)
    word = right_trimmed(F.regexp_replace(head, r"(?s) [^ ]*$", ""))
    return F.when(F.length(s) <= limit, s).otherwise(F.concat(F.when(word == "", head).otherwise(word), F.lit("…")))


def blurb(title: Column, author: str) -> Column:
    return F.concat(F.lit("Read “"), title, F.lit(f"” by {author}."))


def feed_summary(summary: Column, content: Column, title: Column, author: str, limit: int = 400) -> Column:
    said = F.coalesce(F.nullif(summary, F.lit("")), F.nullif(content, F.lit("")), blurb(title, author))
    return F.coalesce(F.nullif(truncated(said, limit), F.lit("")), blurb(title, author))


def published_hint(*chunks: Column, within: int = 400) -> Column:
    """First "Month year" in the first characters of the chunks, in their order."""
    pattern = rf"(?i)\b({MONTHS})\s+(\d{{4}})\b"
    one = lambda c: F.when(F.substring(c, 1, within).rlike(pattern), F.concat(F.initcap(F.regexp_extract(F.substring(c, 1, within), pattern, 1)), F.lit(" "), F.regexp_extract(F.substring(c, 1, within), pattern, 2)))
    return F.coalesce(*map(one, chunks))


def _faults(s: Column) -> list[tuple[str, float, Column]]:
    # Penalties of a summary, in the order they are taken off.
    return [
        ("too_short", 0.35, F.length(F.trim(s)) < 40),
        ("subscribe", 0.40, F.lower(s).contains("subscribe")),
        ("click_here", 0.30, F.lower(s).contains("click here")),
        ("nav_like", 0.40, s.rlike(NAV_LIKE)),
        ("replacement_char", 0.50, s.contains(REPLACEMENT)),
    ]


def summary_quality(s: Column) -> tuple[Column, Column]:
    """(score in 0 to 1, flags)."""
    nothing = F.coalesce(blank(s), F.lit(True))
    score, flags = F.lit(1.0), []
    for name, off, fault in _faults(s):
        score = score - F.when(fault, F.lit(off)).otherwise(F.lit(0.0))
        flags.append(F.when(fault, F.lit(name)))
    return F.when(nothing, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))), F.when(nothing, F.array(F.lit("empty"))).otherwise(F.array_compact(F.array(*flags)))


def coarse_quality(s: Column) -> Column:
    return F.when(F.coalesce(blank(s), F.lit(True)), F.lit(None).cast("double")).when(s.contains(REPLACEMENT), F.lit(0.35)).otherwise(F.lit(0.9))


def is_promo(s: Column) -> Column:
    return (s == "") | s.rlike(PROMO) | ((F.length(s) < 12) & F.lower(s).isin(*CHROME_WORDS))


def sha256(s: Column) -> Column:
    return F.sha2(s, 256)


def rfc822(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def xml_text(s: Column) -> Column:
    return F.replace(F.replace(F.replace(s, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_attribute(s: Column) -> Column:
    return F.replace(F.replace(xml_text(s), F.lit('"'), F.lit("&quot;")), F.lit("\n"), F.lit("&#10;"))


def drift_score(items: Column, marked: Column, fallback: Column, duplicates: Column, rejections: Column) -> Column:
    """How far a discovery pass is from a clean one, 0 to 1."""
    base = F.when(fallback, F.greatest(F.lit(0.0), 1 - marked / F.greatest(items, F.lit(1)))).otherwise(F.lit(0.0))
    score = base + 0.05 * F.least(duplicates, F.lit(4)) + 0.01 * F.least(rejections, F.lit(10))
    return F.when(items == 0, F.lit(1.0)).otherwise(F.round(F.least(F.lit(1.0), score), 4))
