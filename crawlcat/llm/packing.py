"""Packing by power-of-two decomposition.

A document of n ids is cut, from its start, into n // 2048 pieces of 2048 ids
and one piece for each set bit of the rest, the largest first.  Every piece is
a sequence of its own: its length is a power of two, so it needs no padding,
it never meets another document.  ``bucket`` is log2 of the length, and the
pieces of a bucket are dealt to batches of BATCH_TOKENS ids: a batch holds equal
lengths only, so it is a rectangle without padding.  Batches are filled inside
a task, which leaves one unfilled a bucket and task at most.

One narrow stage: no shuffle, so a very long document or a hot source costs
only its own ids.  ``sequence_id`` is unique: partition number and place in it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from crawlcat.llm.common import released
from crawlcat.llm.wordids import END_ID, encoder, slices, vocabulary_path

MAX_TOKENS, BATCH_TOKENS = 2048, 65_536

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def piece_lengths(n: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    out = [max_tokens] * (n // max_tokens)
    rest, bit = n % max_tokens, max_tokens
    while bit := bit >> 1:
        if rest & bit:
            out.append(bit)
    return out


def pack(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS, with_ids: bool = True, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Pieces of ``docs`` (``doc_id``, ``text``); other columns are ignored.

    A null text counts as empty: one piece with the end id alone.  Repeated
    rows are packed each; an empty table gives no pieces.  ``max_tokens`` must
    be a power of two, ``batch_tokens`` no smaller.  ``ids`` holds unsigned little-endian 32-bit integers.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    if batch_tokens < max_tokens:
        raise ValueError("batch_tokens must be max_tokens at least")
    path = path or vocabulary_path()

    def pieces(batches):
        enc = encoder(path)
        task, made = TaskContext.get().partitionId() << 40, 0
        open_batches: dict[int, tuple[int, int]] = {}  # by length: the batch being filled and the room in it
        for batch in batches:
            for first, end in slices(batch.column(1)):
                part = batch.slice(first, end - first)
                ids, at = enc.encode(part.column(1))
                at = at.tolist()
                sizes, starts, totals, sums, blobs, source, dealt = [], [], [], [], [], [], []
                for row in range(part.num_rows):
                    own = ids[at[row] : at[row + 1]].tobytes() + END_BYTES
                    begin = 0
                    for size in piece_lengths(len(own) // 4, max_tokens):
                        blob = own[4 * begin : 4 * (begin + size)]
                        number, room = open_batches.get(size, (0, 0))
                        if room < size:
                            number, room, made = task + made, batch_tokens, made + 1
                        open_batches[size] = number, room - size
                        dealt.append(number)
                        source.append(row)
                        starts.append(begin)
                        sizes.append(size)
                        totals.append(len(own) // 4)
                        sums.append(zlib.crc32(blob))
                        if with_ids:
                            blobs.append(blob)
                        begin += size
                out = [part.column(0).take(pa.array(source, pa.int64())), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(totals, pa.int64()), pa.array(np.log2(np.array(sizes)).astype(np.int32)), pa.array(dealt, pa.int64())]
                names = PIECES.names[:-1]
                if with_ids:
                    out.append(pa.array(blobs, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = PIECES if with_ids else T.StructType(PIECES.fields[:-1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(pieces), schema).withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


END_BYTES = np.array([END_ID], "<u4").tobytes()
