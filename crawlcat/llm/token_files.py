"""Token ids in compressed files with a shared zstandard dictionary.

Format, version 2: a folder of shards, each shard a range of ``doc_id``, held
as rows of a Parquet table (so that any store Spark writes to will do, and its
committer takes care of lost executors).  A row is a block of neighbouring
documents:

``shard``, ``block``      place in ascending ``doc_id`` order
``before``                ids of the shard before this block
``first_id``, ``last_id``   least and greatest ``doc_id``, nulls left out
``dict_hash``             SHA-256 of the dictionary the frames were made with
``doc_ids``               one per document
``n_tokens``              ids of each document, the end id among them
``offsets``               where each document's frame starts in ``payload``
``payload``               one zstandard frame per document, each on its own

Ids are little-endian unsigned integers of ``width`` bytes.  The dictionary is
trained on serialized id arrays of a bounded sample and lies beside the shards
under its hash; a reader refuses blocks of another dictionary.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from crawlcat.llm.common import released, shared_dir
from crawlcat.llm.wordids import END_ID, encoder, slices, vocabulary_path

#: The dictionary is trained on this many documents of at most SAMPLE_CHARS characters, lowest hash first.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 2_000, 8_192, 65_536
#: Documents in a shard, about, and the payload bytes after which a block ends.
SHARD_DOCS, BLOCK_BYTES = 4_096, 1 << 20
#: The range cuts in every task stay this few; beyond, shards grow and blocks don't.
MAX_SHARDS = 20_000
LEVEL = 3

_FRAMES = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("frame", T.BinaryType())])
_BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("before", T.LongType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("dict_hash", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARROW = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
_ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class TokenFiles:
    spark: SparkSession
    path: str
    dict_hash: str

    def dictionary(self) -> bytes:
        row = self.spark.read.parquet(f"{self.path}/dictionary").where(F.col("dict_hash") == self.dict_hash).head()
        if row is None or hashlib.sha256(row["data"]).hexdigest() != self.dict_hash:
            raise ValueError(f"dictionary {self.dict_hash} is missing or damaged in {self.path}")
        return bytes(row["data"])


def _serialized(ids: np.ndarray, width: int) -> bytes:
    return np.append(ids, np.uint32(END_ID)).astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, n_docs: int, path: str, width: int) -> bytes:
    """Dictionary from the sample; empty where there is too little to train on."""
    enc = encoder(path)
    hashed = docs.where(F.length("text") <= SAMPLE_CHARS).select("text", F.xxhash64("text", "doc_id").alias("h"))
    # So few come through the first test that no task, nor the driver, holds more than about twice the sample.
    share = min(1.0, 2 * SAMPLE_DOCS / max(1, n_docs))
    few = hashed.where(F.pmod("h", F.lit(1_000_003)) / F.lit(1_000_003.0) < share).orderBy("h", "text").limit(SAMPLE_DOCS)
    ids, at = enc.encode(pa.array([r["text"] for r in few.collect()], pa.string()))
    samples = [_serialized(ids[a:b], width) for a, b in zip(at[:-1], at[1:]) if b > a]
    if len(samples) < 8 or sum(map(len, samples)) < 4_096:
        return b""
    size = min(DICT_BYTES, max(1_024, sum(map(len, samples)) // 8))
    return zstandard.train_dictionary(size, samples).as_bytes()


def write(docs: DataFrame, path: str | None = None, vocabulary: str | None = None, width: int = 2) -> TokenFiles:
    """Encode ``docs`` (``doc_id``, ``text``; other columns are ignored) and write the files.

    A null text counts as empty (the end id alone).  Rows with a repeated
    ``doc_id`` are kept each, next to one another, ordered by their frame; a
    null ``doc_id`` comes first.  An empty table gives a folder without shards.
    ``width`` is 2 or 4 bytes an id; 2 holds vocabularies up to 65,536.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/token_files"
    vocabulary = vocabulary or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.agg(F.count("*").alias("n")).head()["n"]
    data = train_dictionary(rows, found, vocabulary, width)
    dict_hash = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(dict_hash, data)], "dict_hash string, data binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")

    # Ranges of doc_id from the column alone; the texts are read once.
    shards = min(MAX_SHARDS, max(1, -(-found // SHARD_DOCS)))
    cuts = [] if shards == 1 else sorted(set(rows.agg(F.percentile_approx("doc_id", [i / shards for i in range(1, shards)], 100 * shards).alias("c")).head()["c"] or []))

    def frames(batches):
        enc = encoder(vocabulary)
        packer = zstandard.ZstdCompressor(LEVEL, zstandard.ZstdCompressionDict(data) if data else None)
        for batch in batches:
            for first, end in slices(batch.column(1)):
                part = batch.slice(first, end - first)
                ids, at = enc.encode(part.column(1))
                shard = [0 if i is None else bisect.bisect_left(cuts, i) for i in part.column(0).to_pylist()]
                made = [packer.compress(_serialized(ids[a:b], width)) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), part.column(0), pa.array(np.diff(at) + 1, pa.int64()), pa.array(made, pa.binary())], ["shard", "doc_id", "n_tokens", "frame"])

    def blocks(batches):
        shard, block, before, held, size = None, 0, 0, [], 0

        def made():
            ids, sizes, made_of = zip(*held)
            named = [i for i in ids if i is not None]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in made_of])])[:-1].tolist()
            row = (shard, block, before, min(named, default=None), max(named, default=None), dict_hash, width, sum(sizes), ids, sizes, offsets, b"".join(made_of))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _ARROW)], _BLOCKS.names)

        for batch in batches:
            for s, i, n, f in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (s != shard or size >= BLOCK_BYTES):
                    yield made()
                    block, before = (block + 1, before + sum(n for _, n, _ in held)) if s == shard else (0, 0)
                    held, size = [], 0
                shard = s
                held.append((i, n, f))
                size += len(f)
        if held:
            yield made()

    framed = rows.mapInArrow(released(frames), _FRAMES)
    dealt = framed.repartition("shard").sortWithinPartitions("shard", "doc_id", "frame")
    dealt.mapInArrow(released(blocks), _BLOCKS).write.mode("overwrite").parquet(f"{path}/shards")
    return TokenFiles(spark, path, dict_hash)


def read(files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """Every document of the files with its place among all ids, from the files alone."""
    data, expected = files.dictionary(), files.dict_hash
    blocks = files.spark.read.schema(_BLOCKS).parquet(f"{files.path}/shards")
    # MAX_SHARDS rows at most, so the one ordered window and the broadcast are small; the payload stays where it is read.
    totals = blocks.groupBy("shard").agg(F.sum("tokens").alias("own"))
    starts = F.broadcast(totals.select("shard", (F.sum("own").over(Window.orderBy("shard")) - F.col("own")).alias("shard_start")))

    def rows(batches):
        unpacker = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(data) if data else None)
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_hash"] != expected:
                    raise ValueError(f"block of dictionary {r['dict_hash']}, not {expected}")
                start, out = r["start"], []
                ends = [*r["offsets"][1:], len(r["payload"])]
                for i, n, a, b in zip(r["doc_ids"], r["n_tokens"], r["offsets"], ends):
                    own = np.frombuffer(unpacker.decompress(r["payload"][a:b]), f"<u{r['width']}").astype("<u4").tobytes()
                    if len(own) != 4 * n:
                        raise ValueError(f"document {i} has {len(own) // 4} ids, not {n}")
                    out.append((i, start, n, zlib.crc32(own), own if with_ids else None))
                    start += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return blocks.join(starts, "shard").withColumn("start", F.col("shard_start") + F.col("before")).mapInArrow(released(rows), _ROWS)


def fetch(files: TokenFiles, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this id, each from its own frame; only blocks whose range of ids holds it are read."""
    data = files.dictionary()
    unpacker = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(data) if data else None)
    found = files.spark.read.schema(_BLOCKS).parquet(f"{files.path}/shards").where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    place = F.posexplode("doc_ids").alias("k", "id")
    one = found.select("width", "payload", "offsets", place).where(F.col("id") == doc_id)
    cut = one.select("width", F.expr("substring(payload, cast(get(offsets, k) + 1 as int), cast(coalesce(get(offsets, k + 1), length(payload)) - get(offsets, k) as int))").alias("frame"))
    return [np.frombuffer(unpacker.decompress(bytes(r["frame"])), f"<u{r['width']}").tolist() for r in cut.collect()]
