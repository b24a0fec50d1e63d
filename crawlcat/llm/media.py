"""Media columns: texts as sound, and spectral-peak pair fingerprints.

The payload (UTF-8, padded with zero bytes to a positive multiple of 64) is
stored as one WAV file of unsigned 8-bit mono samples, written and read back
with the wave module.  A short-time Fourier transform of the samples gives
spectral peaks; each peak is paired with the next ones in time, and the pairs
are kept as two arrays, ``times`` (frame of the first peak) and ``codes``
(both frequencies and the distance in time).

Narrow: one pass, a text at a time, the transform in runs of FRAMES frames, so
equal texts get equal values wherever they stand.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from crawlcat.llm.common import released

RATE, PAD = 8_000, 64
FRAME, HOP, FRAMES = 256, 128, 4_096
#: Peaks of a frame, followers of a peak it is paired with, and the greatest distance of a pair in frames.
PEAKS, FOLLOWERS, REACH = 3, 4, 16
_WINDOW = np.hanning(FRAME).astype(np.float32)

MEDIA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("n_frames", T.LongType()),
        T.StructField("times", T.ArrayType(T.IntegerType())),
        T.StructField("codes", T.ArrayType(T.IntegerType())),
        T.StructField("media", T.BinaryType()),
    ]
)


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % PAD) if data else bytes(PAD)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("not a mono 8-bit file")
        return w.readframes(w.getnframes())


def peaks(payload: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(frame, bin) of every spectral peak in order, and the number of frames.

    A peak is a bin above its neighbours in frequency and in time and above the
    mean of its frame; of a frame the PEAKS strongest count, the lower bin first
    where they tie.  Times before the first and after the last frame are silent.
    """
    samples = np.frombuffer(payload, np.uint8).astype(np.float32) - np.float32(128)
    n = max(1, -(-(len(samples) - FRAME) // HOP) + 1)
    samples = np.pad(samples, (0, (n - 1) * HOP + FRAME - len(samples)))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    times, bins = [], []
    for lo in range(0, n, FRAMES):
        begin, end = max(0, lo - 1), min(n, lo + FRAMES + 1)
        power = np.abs(np.fft.rfft(frames[begin:end] * _WINDOW, axis=1)).astype(np.float32)
        inner = power[:, 1:-1]
        top = (inner > power[:, :-2]) & (inner >= power[:, 2:]) & (inner > power.mean(axis=1, keepdims=True))
        top[1:] &= inner[1:] >= inner[:-1]
        top[:-1] &= inner[:-1] > inner[1:]
        top = top[lo - begin : lo - begin + FRAMES][: min(FRAMES, n - lo)]
        strength = np.where(top, inner[lo - begin : lo - begin + len(top)], -1)
        best = np.sort(np.argsort(-strength, axis=1, kind="stable")[:, :PEAKS], axis=1)
        t, k = np.nonzero(np.take_along_axis(strength, best, axis=1) > 0)
        times.append(t + lo)
        bins.append(best[t, k] + 1)
    return np.concatenate(times), np.concatenate(bins), n


def fingerprint(times: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time-coded pairs: (frame of the first peak, bins and distance in one number)."""
    t, c = [], []
    for k in range(1, FOLLOWERS + 1):
        gap = times[k:] - times[:-k]
        near = (gap >= 1) & (gap <= REACH)
        t.append(times[:-k][near])
        c.append((bins[:-k][near] << 15) | (bins[k:][near] << 6) | gap[near])
    t, c = np.concatenate(t), np.concatenate(c)
    order = np.lexsort((c, t))
    return t[order].astype(np.int32), c[order].astype(np.int32)


def store(docs: DataFrame, with_media: bool = True) -> DataFrame:
    """MEDIA rows of ``docs`` (``doc_id``, ``text``; other columns are ignored), one for each.

    A null text counts as empty: 64 silent samples, no peaks.  Repeated rows are
    answered each; an empty table gives no rows.  Without ``with_media`` the
    file itself is left out once its features are taken.
    """

    def stored(batches):
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode("utf-8", "surrogatepass")
                media = to_wav(padded(data))
                payload = from_wav(media)
                at, bins, n = peaks(payload)
                times, codes = fingerprint(at, bins)
                row = [i, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), n, times, codes, media if with_media else None]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW)], MEDIA.names)

    def gathered(batches):
        held, size = [], 0
        for b in stored(batches):
            held.append(b)
            size += b.nbytes
            if len(held) >= 256 or size > 8_000_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(released(gathered), MEDIA)


_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())


def digest(stored: DataFrame) -> DataFrame:
    """The contract's row: ``feature`` names frames, pairs and a hash of the time-coded arrays."""
    arrays = F.concat_ws(";", F.concat_ws(",", F.col("times").cast("array<string>")), F.concat_ws(",", F.col("codes").cast("array<string>")))
    feature = F.concat_ws(":", F.lit("peaks"), "n_frames", F.size("codes"), F.sha2(arrays, 256))
    return stored.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
