"""Personal data: base patterns, and terms that give a protected entity away.

Every base span is a protected entity.  Terms near an entity are counted with
it over the corpus; a term discloses an entity when nearly all the different
texts that hold the term hold the entity beside it (``SHARE``), in ``SUPPORT``
different texts or more, and the pointwise mutual information of the two is
``BITS`` or more.  Such terms become spans of kind ``term`` wherever they
stand.  A term is generalised to a broader one: a word that stands beside the
entity in most of the texts of the term (``BROADER``), is in at least twice as
many texts of the corpus and discloses nothing itself; the rarest such word is
taken.  A term without one is removed.

DataFrame functions only.  Joint counts come from the narrow table of matches.
The number of different texts of a term is a sum over the words of every text,
each divided by how often its text is repeated, so nothing but sums by word is
shuffled; what the matches ask for is joined to the sums.  Only words over the
thresholds are then looked for in the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crawlcat.llm.common import written
from crawlcat.llm.spans import Kind, hits, listing, placed, replaced, searched, text_key

WINDOW_CHARS = 160
SUPPORT, SHARE, BITS = 3, 0.9, 4.0
#: Share of the texts of a term and its entity that a broader term is in, and how many times as many texts have it.
BROADER, WIDER = 0.8, 2

# Fixed values of the base patterns; a run is tried once, from its start.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"\p{L}{4,}+"

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
_some = lambda v: F.lit(True)


def luhn(v: Column) -> Column:
    """Whether the digits of ``v`` pass the check sum."""
    doubled = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int"))
    each = F.transform(F.split(F.reverse(_digits(v)), ""), doubled)
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _card(v: Column) -> Column:
    # The check sum sees 19 digits at most, however long the match is.
    size = F.length(_digits(v))
    return F.when(size.between(14, 19), luhn(v)).otherwise(F.lit(False))


KINDS = [
    Kind("email", EMAIL, 0, _some, _some, "@[A-Za-z0-9-]"),
    Kind("ip", IP, 0, _some, lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    Kind("card", CARD, 0, lambda v: F.length(v) >= 14, _card, r"[0-9](?:[\x20-]?[0-9]){13}"),
    Kind("phone", PHONE, 0, _some, lambda v: F.length(_digits(v)).between(10, 15), r"\+[0-9]"),
]
NAMES = [*(k.name for k in KINDS), "term"]
BASE = len(KINDS)


def _around(gap: Column, following: Column) -> dict[str, Column]:
    """Whole words within WINDOW_CHARS of a match; one cut by the window's edge doesn't count."""
    before = F.when(F.length(gap) > WINDOW_CHARS, F.substring(gap, -WINDOW_CHARS, WINDOW_CHARS)).otherwise(F.concat(F.lit(" "), gap))
    after = F.substring(F.concat(F.coalesce(following, F.lit("")), F.lit(" ")), 1, WINDOW_CHARS)
    words = lambda c, p: F.regexp_extract_all(F.lower(c), F.lit(p), F.lit(0))
    return {"near": F.array_distinct(F.concat(words(before, r"(?<=\P{L})\p{L}{4,}+"), words(after, r"(?<!\p{L})\p{L}{4,}+(?=\P{L})")))}


def _words(text: Column) -> Column:
    return F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))))


def entities(spans: DataFrame, found: DataFrame) -> DataFrame:
    """(text_hash, entity, near) of every base span; the same text comes once."""
    texts = found.where(F.size("hits") > 0).select("key", "text_hash").distinct()
    return spans.join(texts, "key").select("text_hash", F.md5(F.concat_ws(":", F.col("k").cast("string"), F.lower("value"))).alias("entity"), "near")


def term_counts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(term, n_t): the number of different texts of ``rows`` that hold each word."""
    times = found.groupBy("text_hash").agg(F.count("*").alias("times")).where("times > 1")
    weighed = rows.withColumn("text_hash", F.xxhash64("text")).join(times, "text_hash", "left").select((1 / F.coalesce("times", F.lit(1))).alias("weight"), "text")
    return weighed.select("weight", _words(F.col("text")).alias("term")).groupBy("term").agg(F.round(F.sum("weight")).cast("long").alias("n_t"))


def disclosing(near: DataFrame, of_term: DataFrame, n_texts: DataFrame) -> DataFrame:
    """(term, bits, share, broader) of the terms over the thresholds; ``broader`` is null for a term to remove.

    ``near``: rows of ``entities``; ``of_term``: rows of ``term_counts``;
    ``n_texts``: one row, ``n`` different texts.  A term counts for the entity
    that it points to most, the least of several.
    """
    of_entity = near.groupBy("entity").agg(F.count_distinct("text_hash").alias("n_e"))
    joint = near.select("text_hash", "entity", F.explode("near").alias("term")).distinct().groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= SUPPORT)
    scored = written(joint.join(of_entity, "entity").join(of_term, "term").crossJoin(n_texts), "scored_terms")  # one row on the right
    share = F.col("n_te") / F.col("n_t")
    bits = F.log2(F.col("n_te") * F.col("n") / (F.col("n_t") * F.col("n_e")))
    over = scored.select("term", "entity", "n_t", "n_te", bits.alias("bits"), share.alias("share")).where((F.col("share") >= SHARE) & (F.col("bits") >= BITS))
    best = written(over.groupBy("term").agg(F.max(F.struct("bits", "share", "entity", "n_t", "n_te")).alias("b")).select("term", "b.*"), "disclosing_terms")
    # Words beside a term and its entity, counted by different texts.
    beside = near.select("text_hash", "entity", "near", F.explode("near").alias("term")).join(best.select("term", "entity"), ["term", "entity"]).select("term", "text_hash", F.explode("near").alias("word")).where("word <> term").distinct()
    with_word = beside.groupBy("term", "word").agg(F.count("*").alias("n_tw"))
    clear = with_word.join(best.select(F.col("term").alias("word")), "word", "left_anti").join(of_term.select(F.col("term").alias("word"), F.col("n_t").alias("n_w")), "word")
    chosen = clear.join(best.select("term", "n_t", "n_te"), "term").where((F.col("n_tw") >= BROADER * F.col("n_te")) & (F.col("n_w") >= WIDER * F.col("n_t"))).groupBy("term").agg(F.min(F.struct("n_w", "word"))["word"].alias("broader"))
    return best.select("term", "bits", "share").join(chosen, "term", "left")


def scan(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` as (doc_id, key, spans); spans are (start, k, end, value, action, broader).

    ``action`` is ``mask`` for base spans, ``generalise`` or ``remove`` for
    terms.  A null text counts as empty.  Repeated rows get the same spans
    each; thresholds count different texts, so copies don't make a term
    disclosing.  An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = written(searched(rows, KINDS).select("doc_id", text_key().alias("key"), F.xxhash64("text").alias("text_hash"), hits(KINDS, _around).alias("hits")), "matches")
    spans = written(placed(found, KINDS), "base_spans")
    near = written(entities(spans, found), "entities")
    of_term = written(term_counts(rows, found), "term_counts")
    flagged = written(disclosing(near, of_term, found.agg(F.count_distinct("text_hash").alias("n"))), "disclosing")

    # The terms of a text are found by one pattern of its own, so only their places leave it.
    held = rows.select(text_key().alias("key"), _words(F.col("text")).alias("term")).join(flagged.select("term"), "term", "left_semi")
    own = held.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("term")), "|").alias("terms"))
    term = Kind("term", F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.col("terms"), F.lit(r")(?!\p{L})")), 0, _some, _some)
    held = written(searched(rows.withColumn("key", text_key()).join(own, "key"), [term]).select("key", hits([term]).alias("hits")), "term_matches")
    terms = placed(held, [term]).withColumn("term", F.lower("value")).join(flagged.select("term", "broader"), "term").withColumn("action", F.when(F.col("broader").isNull(), "remove").otherwise("generalise"))
    all_spans = spans.select("key", F.struct("start", "k", "end", "value", F.lit("mask").alias("action"), F.lit(None).cast("string").alias("broader")).alias("s")).unionByName(terms.select("key", F.struct("start", F.lit(BASE).alias("k"), "end", "value", "action", "broader").alias("s")))
    base = F.filter("spans", lambda s: s["k"] < BASE)
    clear = F.filter("spans", lambda s: (s["k"] < BASE) | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    by_key = all_spans.groupBy("key").agg(F.collect_list("s").alias("spans")).select("key", clear.alias("spans"))
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,value:string,action:string,broader:string>>")
    return found.select("doc_id", "key").join(by_key, "key", "left").withColumn("spans", F.coalesce("spans", none))


def report(scanned: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    of = lambda k: F.size(F.filter("spans", lambda s: s["k"] == k)).cast("long")
    return scanned.select(
        "doc_id", *(of(k).alias(f"n_{NAMES[k]}") for k in range(BASE)),
        F.sha2(listing(F.col("spans"), NAMES, lambda s: s["k"] < BASE), 256).alias("base_sha256"),
        listing(F.col("spans"), NAMES).alias("spans"),
        of(BASE).alias("n_term"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities masked as ``[kind]``, terms generalised to ``[broader term]`` or removed.

    All columns stay, whatever they are called; a null text stays null,
    repeated rows are answered alike, an empty table gives no rows.
    """
    kinds = F.array(*(F.lit(f"[{n}]") for n in NAMES))
    marker = lambda s: F.when(s["action"] == "remove", "").when(s["action"] == "generalise", F.concat(F.lit("["), s["broader"], F.lit("]"))).otherwise(F.get(kinds, s["k"]))
    return replaced(docs, scan(docs), marker)
