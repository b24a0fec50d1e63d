"""Chat formatting by quotation linking.

Quoted lines (``>``, nested by repetition) are parsed into passages of one
level; passages and the unquoted parts of every message (all of it, its
paragraphs, lines and sentences) are hashed after normalisation, which forgets
where lines were wrapped.  A part of a passage is joined to the latest earlier
message of its conversation that holds it.  The outermost level that is found
decides, in it the longest part, then the latest message: the quoting message
becomes a reply to that one.  A message without a passage that is found
continues the one before it.

Messages that continue each other form a run; a found quotation starts a run
that hangs on the message quoted.  Conversations are read run by run, a message
first, then what continues it, then the replies that hang on it, later
messages' replies before earlier ones' (the preorder of the reply tree).  The
order comes from ranking the Euler tour of the runs by pointer doubling, so a
conversation with very many runs needs more rounds, not a larger task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from crawlcat.llm.common import released, written

_QUOTE = re.compile(r"^\s{0,3}((?:>\s?)+)(.*)$")
#: Turns that one ordered task sees at once; runs of turns are carried over by their maxima.
TURNS = 1_024

PARSED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("own", T.ArrayType(T.LongType())),
        T.StructField("quoted", T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("hash", T.LongType())]))),
        T.StructField("n_passages", T.IntegerType()),
        T.StructField("max_level", T.IntegerType()),
    ]
)


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text without quoted lines, and its (level, passage) in order."""
    body, passages, level = [], [], 0
    for line in text.split("\n"):
        m = _QUOTE.match(line)
        if m is None:
            body.append(line)
            level = 0
            continue
        depth = m[1].count(">")
        if depth == level:
            passages[-1][1].append(m[2])
        else:
            passages.append((depth, [m[2]]))
        level = depth
    text = re.sub(r"\n{3,}", "\n\n", "\n".join(body)).strip("\n")
    return text, [(d, "\n".join(lines)) for d, lines in passages]


def hashed(text: str) -> tuple[int, int] | None:
    """(hash, number) of the words of a text, whatever their case, spacing and punctuation; none without words.

    Hashes are compared inside a conversation only; 64 bits of BLAKE2 are ample.
    """
    words = re.findall(r"\w+", text.lower())
    if not words:
        return None
    data = " ".join(words).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True), len(words)


def parts(text: str) -> set[tuple[int, int]]:
    """Hashes and sizes of the whole text, its paragraphs, lines and sentences."""
    paragraphs = re.split(r"\n\s*\n", text)
    pieces = {text, *paragraphs, *text.split("\n"), *(s for p in paragraphs for s in re.split(r"(?<=[.!?…])\s+", p))}
    return {h for p in pieces if (h := hashed(p)) is not None}


def parsed(messages: DataFrame) -> DataFrame:
    """PARSED rows of (conv_id, turn, role, text)."""

    def rows(batches):
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                body, passages = parse(text)
                quoted = [{"level": d, "size": n, "hash": h} for d, p in passages for h, n in sorted(parts(p))]
                out.append((conv, turn, role, body, sorted(h for h, _ in parts(body)), quoted, len(passages), max((d for d, _ in passages), default=0)))
            for lo in range(0, len(out), 1_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[lo : lo + 1_000]), _ARROW)], PARSED.names)

    plain = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(released(rows), PARSED)


_ARROW = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.struct([("level", pa.int32()), ("size", pa.int32()), ("hash", pa.int64())])), pa.int32(), pa.int32())


def parents(found: DataFrame) -> DataFrame:
    """(conv_id, turn, parent): what each quoting message replies to; the outermost level that is found decides, then the longest part, then the latest message."""
    quotes = found.where((F.size("quoted") > 0) & F.col("turn").isNotNull()).select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.*").distinct()
    # Only hashes that are quoted at all go on, and a message counts once for each.
    asked = quotes.select("conv_id", "hash").distinct()
    own = found.where(F.col("turn").isNotNull()).select("conv_id", "turn", F.explode("own").alias("hash")).alias("o").join(asked.alias("a"), F.expr("o.conv_id <=> a.conv_id and o.hash = a.hash"), "left_semi").distinct()
    rank = F.struct((-F.col("level")).alias("l"), "size")
    marked = own.select("conv_id", "hash", "turn", F.lit(None).cast(quotes.select(rank.alias("r")).schema["r"].dataType).alias("rank"), F.col("turn").alias("source")).unionByName(quotes.select("conv_id", "hash", "turn", rank.alias("rank"), F.lit(None).cast("long").alias("source")))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    linked = marked.withColumn("parent", F.max("source").over(earlier)).where("rank is not null and parent is not null")
    return linked.groupBy("conv_id", "turn").agg(F.max(F.struct("rank", "parent"))["parent"].alias("parent"))


def _runs(turns: DataFrame, starts: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn) with ``run``, the latest start at or before the turn; null before the first."""
    marked = turns.select("conv_id", "turn", F.lit(False).alias("s")).unionByName(starts.select("conv_id", "turn", F.lit(True).alias("s"))).groupBy("conv_id", "turn").agg(F.max("s").alias("s"))
    marked = marked.withColumn("part", F.floor(F.col("turn") / TURNS)).withColumn("start", F.when(F.col("s"), F.col("turn")))
    maxima = marked.groupBy("conv_id", "part").agg(F.max("start").alias("m"))
    carried = maxima.withColumn("carry", F.max("m").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "carry")
    inside = marked.withColumn("own", F.max("start").over(Window.partitionBy("conv_id", "part").orderBy("turn")))
    return inside.join(carried, F.expr("conv_id <=> c and part = p")).select("conv_id", "turn", F.coalesce("own", "carry").alias("run"))


def ranks(tokens: DataFrame) -> DataFrame:
    """(token, behind): the summed weight from each token to the end of its list; ``tokens`` has token, next, weight."""
    now = written(tokens.select("token", "next", F.col("weight").alias("behind")), "tour")
    while now.where("next is not null").limit(1).count():
        ahead = now.select(F.col("token").alias("next"), F.col("next").alias("far"), F.col("behind").alias("more"))
        now = written(now.join(ahead, "next", "left").select("token", F.col("far").alias("next"), (F.col("behind") + F.coalesce("more", F.lit(0))).alias("behind")), "tour")
    return now.select("token", "behind")


def _read_order(runs: DataFrame) -> DataFrame:
    """(conv_id, run, place) in reading order; ``runs`` has conv_id, run, attach, above (the run it hangs on, null: the first)."""
    first = runs.select("conv_id").distinct().select("conv_id", F.lit(None).cast("long").alias("run"))
    key = lambda run, end: F.struct("conv_id", F.coalesce(run, F.lit(0)).alias("run"), run.isNull().alias("first"), F.lit(end).alias("end"))
    siblings = Window.partitionBy("conv_id", "above").orderBy(F.col("attach").desc(), "run")
    sib = runs.withColumns({"after": F.lead("run").over(siblings), "at": F.row_number().over(siblings)})
    eldest = sib.where("at = 1").select(F.col("conv_id").alias("c"), F.col("above").alias("a"), F.col("run").alias("child"))
    nodes = runs.select("conv_id", "run").unionByName(first)
    enter = nodes.join(eldest, F.expr("conv_id <=> c and run <=> a"), "left").select(
        key(F.col("run"), False).alias("token"), F.when(F.col("child").isNotNull(), key(F.col("child"), False)).otherwise(key(F.col("run"), True)).alias("next"), F.lit(1).cast("long").alias("weight")
    )
    leave = sib.select(key(F.col("run"), True).alias("token"), F.when(F.col("after").isNotNull(), key(F.col("after"), False)).otherwise(key(F.col("above"), True)).alias("next"), F.lit(0).cast("long").alias("weight"))
    end = first.select(key(F.col("run"), True).alias("token"), F.lit(None).cast(leave.schema["next"].dataType).alias("next"), F.lit(0).cast("long").alias("weight"))
    ranked = ranks(enter.unionByName(leave).unionByName(end)).where("not token.end").select("token.conv_id", F.when(~F.col("token.first"), F.col("token.run")).alias("run"), "behind")
    sizes = nodes.groupBy("conv_id").agg(F.count("*").alias("n")).withColumnRenamed("conv_id", "c")
    return ranked.join(sizes, F.expr("conv_id <=> c")).select("conv_id", "run", (F.col("n") - F.col("behind")).alias("place"))


def format_chat(messages: DataFrame) -> DataFrame:
    """One row a message: conv_id, turn, role, text (without quotes), parent, run_place, reply, n_passages, max_level.

    Read a conversation by (``run_place``, ``turn``).  ``messages`` has
    ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored.  Null
    texts count as empty; rows of the same conversation and turn stand side by
    side and share parent and place.  A null ``turn`` is in no run: it comes
    first and is nobody's parent; a null ``conv_id`` is a conversation of its
    own.  A null role stays null.  An empty table gives no rows.
    """
    found = written(parsed(messages), "messages")
    linked = written(parents(found), "parents")
    rows = found.select("conv_id", "turn", "role", F.col("body").alias("text"), "n_passages", "max_level")
    touched = linked.select(F.col("conv_id").alias("c")).distinct()
    turns = found.join(touched, F.expr("conv_id <=> c"), "left_semi").where("turn is not null").select("conv_id", "turn").distinct()
    run_of = written(_runs(turns, linked), "runs")
    above = run_of.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("run").alias("above"))
    runs = linked.join(above, F.expr("conv_id <=> c and parent = t")).select("conv_id", F.col("turn").alias("run"), F.col("parent").alias("attach"), "above")
    order = _read_order(written(runs, "replies"))
    o = order.select(F.col("conv_id").alias("c"), F.col("run").alias("r"), "place")
    placed = run_of.join(o, F.expr("conv_id <=> c and run <=> r")).select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"), "place")
    l = linked.select(F.col("conv_id").alias("lc"), F.col("turn").alias("lt"), "parent")
    out = rows.join(placed, F.expr("conv_id <=> pc and turn = pt"), "left").join(l, F.expr("conv_id <=> lc and turn = lt"), "left")
    return out.select("conv_id", "turn", "role", "text", "n_passages", "max_level", "parent", F.coalesce("place", F.lit(0).cast("long")).alias("run_place"), F.col("parent").isNotNull().alias("reply"))


def rendered(formatted: DataFrame) -> DataFrame:
    """The turn as training text, between markers of its role."""
    role = F.coalesce("role", F.lit("unknown"))
    return formatted.withColumn("chat", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")))
