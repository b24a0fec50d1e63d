"""Language identification by nearest centroid.

A text becomes counts of letter trigrams (over the bytes of its lower-cased
UTF-8, all else than letters as one space), hashed to DIMS places, damped by a
square root, weighted by inverse document frequency and scaled to length one.
Every language has up to CENTROIDS centroids from spherical k-means; the
language of the nearest one by cosine wins.  A text is rejected when its cosine
lies below what texts of its size reach in training (each held against
centroids without itself), with a wide margin.

The model is fitted on SAMPLE_TEXTS different labelled texts, taken by the hash
of the text in equal shares a language; prediction sees the text only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from crawlcat.llm.common import released, unused, written
from crawlcat.llm.wordids import _flat, slices

DIMS = 4_096
SAMPLE_TEXTS, CENTROIDS, ROUNDS = 6_000, 4, 12
#: Languages whose sizes are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 10_000
#: Share of the lowest training cosine (by size of text) below which a text is rejected.
MARGIN = 0.5
#: Training texts of a size or smaller that a threshold rests on; sizes with fewer reject nothing but what has no letters.
ENOUGH = 30
UNDETERMINED = "und"
#: Texts and bytes of one block of vectors.
BLOCK_TEXTS, BLOCK_BYTES = 512, 3_000_000

_CLASS = np.zeros(256, np.int32)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:256] = np.arange(27, 155)


def counts(texts: pa.Array) -> np.ndarray:
    """Hashed trigram counts, a row for each text."""
    raw, at = _flat(pc.utf8_lower(texts.fill_null("")))
    out = np.zeros((len(at) - 1, DIMS), np.float32)
    if len(raw) < 3:
        return out
    c = _CLASS[raw]
    h = ((c[:-2] * 155 + c[1:-1]) * 155 + c[2:]).astype(np.uint32)
    inside = np.ones(len(h), bool)  # no trigram over the end of a text
    for back in (1, 2):
        edge = at[1:-1] - back
        inside[edge[(edge >= 0) & (edge < len(h))]] = False
    inside &= (c[:-2] > 0) | (c[1:-1] > 0)
    h = ((h * np.uint32(2654435761)) >> np.uint32(32 - 12)).astype(np.int64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(h)]
    out += np.bincount((row * DIMS + h)[inside], minlength=out.size).reshape(out.shape)
    return out


def blocks(texts: pa.Array):
    """(first, end) ranges of rows, bounded in bytes and in rows."""
    for first, end in slices(texts, BLOCK_BYTES):
        for a in range(first, end, BLOCK_TEXTS):
            yield a, min(end, a + BLOCK_TEXTS)


def size_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1).astype(int), 15)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray  #: a row each
    owner: np.ndarray  #: index of the language of each
    least: np.ndarray  #: by size class

    def vectors(self, c: np.ndarray) -> np.ndarray:
        v = np.sqrt(c) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, cosine and rejection of each row of counts."""
        if not len(self.centroids):
            return np.full(len(c), -1), np.zeros(len(c)), np.ones(len(c), bool)
        cosine = self.vectors(c) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(c)), best].astype(float), 0, 1)
        return self.owner[best], score, score < self.least[size_class(c.sum(axis=1))]


def _cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from farthest-first starts."""
    mean = v.mean(axis=0)
    chosen = [int((v @ mean).argmax())]
    near = v @ v[chosen[0]]
    while len(chosen) < min(k, len(v)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, v @ v[chosen[-1]])
    centres = v[chosen]
    for _ in range(ROUNDS):
        sums, held = _sums(v, (v @ centres.T).argmax(axis=1), len(centres))
        sums = np.where(held[:, None] > 0, sums, centres)
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def _sums(v: np.ndarray, nearest: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of each centre and how many they are, without copies of the rows."""
    member = np.zeros((len(v), k), np.float32)
    member[np.arange(len(v)), nearest] = 1
    return member.T @ v, np.bincount(nearest, minlength=k)


def _others(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Greatest cosine of each row with the centres of its language, its own share left out of its own centre."""
    cosine = v @ centres.T
    nearest = cosine.argmax(axis=1)
    sums, held = _sums(v, nearest, len(centres))
    for a in range(0, len(v), BLOCK_TEXTS):
        rows = np.arange(a, min(len(v), a + BLOCK_TEXTS))
        without = sums[nearest[rows]] - v[rows]
        own = np.einsum("ij,ij->i", without, v[rows]) / np.maximum(np.linalg.norm(without, axis=1), 1e-9)
        cosine[rows, nearest[rows]] = np.where(held[nearest[rows]] == 1, 0, own)
    return cosine.max(axis=1)


def _sample(labelled: DataFrame) -> DataFrame:
    """(lang, counts) of the texts the model rests on, as a written table; see ``fit``."""
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).withColumn("h", F.xxhash64("text"))
    sizes = written(rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")), "language_sizes")
    languages = sizes.agg(F.count("*")).head()[0]
    share = max(1, SAMPLE_TEXTS // max(1, languages))
    # Few more than the share pass a test of the hash, so the ordered window sees a bounded number a language.
    chance = (2 * share + 50) / F.col("n")
    few = rows.join(F.broadcast(sizes) if languages <= MOST_BROADCAST else sizes, "lang").where(F.pmod("h", F.lit(1_000_003)) / F.lit(1_000_003.0) < chance).groupBy("lang", "h").agg(F.first("text").alias("text"))
    kept = few.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("nth") <= share).select("lang", "h", "text")

    def counted(batches):
        for batch in batches:
            for a, b in blocks(batch.column(2)):
                c = np.minimum(counts(batch.column(2).slice(a, b - a)), 65_535).astype("<u2")
                place = [np.flatnonzero(x).astype("<u2") for x in c]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in (0, 1)), pa.array([i.tobytes() for i in place], pa.binary()), pa.array([x[i].tobytes() for x, i in zip(c, place)], pa.binary())], ["lang", "h", "place", "counts"])

    return written(kept.mapInArrow(released(counted), "lang string, h long, place binary, counts binary").where("length(place) > 0"), "language_sample")


def _dense(place, count) -> np.ndarray:
    out = np.zeros((len(place), DIMS), np.float32)
    for row, i, c in zip(out, place, count):
        row[np.frombuffer(i, "<u2")] = np.frombuffer(c, "<u2")
    return out


def fit(labelled: DataFrame) -> Model:
    """Model from ``labelled`` (``text``, ``lang``); rows with a null in either, or without letters, don't count.

    The sample has the same number of texts of every language, those of the
    least hashes, SAMPLE_TEXTS in all but at least one each; copies count once.
    The same text under several languages counts for each.  No labelled row
    gives a model without centroids, which rejects everything.

    The sample stays in the cluster: document frequencies come as one sum,
    centroids from one task a language, which holds its share of the sample
    and no more.  The driver sees frequencies, centroids and 16 least cosines
    a language.
    """
    sample = _sample(labelled)

    def frequencies(batches):
        seen, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for place in batch.column(0).to_pylist():
                seen[np.frombuffer(place, "<u2")] += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([seen.tolist()], pa.list_(pa.int64()))], ["n", "seen"])

    each = sample.select("place").mapInArrow(released(frequencies), "n long, seen array<long>").select("n", F.posexplode("seen").alias("dim", "k"))
    df = {r["dim"]: r for r in each.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).collect()}  # DIMS rows
    none = (np.empty((0, DIMS), np.float32), np.empty(0, int), np.zeros(16))
    if not df:
        return Model((), np.ones(DIMS, np.float32), *none)
    idf = np.array([np.log((1 + df[i]["n"]) / (1 + df[i]["k"])) + 1 for i in range(DIMS)], np.float32)
    bare = Model((), idf, *none)

    def clustered(table: pa.Table) -> pa.Table:
        c = _dense(table.column("place").to_pylist(), table.column("counts").to_pylist())
        kinds = size_class(c.sum(axis=1))
        v = bare.vectors(c)
        del c
        centres = _cluster(v, CENTROIDS).astype(np.float32)
        own = _others(v, centres)
        said = [(int((kinds == k).sum()), float(own[kinds == k].min()) if (kinds == k).any() else 1.0) for k in range(16)]
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()]), "centres": pa.array([centres.tobytes()], pa.binary()), "n": pa.array([[n for n, _ in said]]), "least": pa.array([[x for _, x in said]])})

    got = sorted(sample.groupBy("lang").applyInArrow(clustered, "lang string, centres binary, n array<long>, least array<double>").collect(), key=lambda r: r["lang"])
    groups = [np.frombuffer(bytes(r["centres"]), "<f4").reshape(-1, DIMS) for r in got]
    n, least = np.array([r["n"] for r in got]), np.array([r["least"] for r in got])
    # A text is never asked for more than any training text of its size or smaller has reached.
    asked = [least[:, : k + 1].min() if n[:, : k + 1].sum() >= ENOUGH else 0.0 for k in range(16)]
    return Model(tuple(r["lang"] for r in got), idf, np.concatenate(groups), np.concatenate([[i] * len(g) for i, g in enumerate(groups)]), MARGIN * np.clip(asked, 0, 1))


def _answers(model: Model, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index (-1: without letters), score and rejection of each text."""
    letters = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
    own, score, rejected = model.predict(counts(text))
    return np.where(letters, own, -1), np.where(letters, score, 0.0), ~letters | rejected


ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])


def identify(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``doc_id``, the columns in ``keep``, ``lang_pred``, ``score`` (0 to 1) and ``rejected`` of every row of ``docs``.

    A null text, or one without a letter, is ``und``, scores 0 and is rejected.
    Any other text gets a learned language, rejected or not; ties go to the
    first centroid.  Repeated rows are answered each, an empty table gives no
    rows.  A kept column of the name of an added one gives way to it.
    """
    names = ["doc_id", *(k for k in keep if k not in ("doc_id", *ADDED.names))]
    fields = [docs.schema[n] for n in names]
    m = docs.sparkSession.sparkContext.broadcast(model)  # CENTROIDS * languages * DIMS floats

    def predicted(batches):
        learned = np.array([*m.value.languages, UNDETERMINED], object)
        for batch in batches:
            for a, b in blocks(batch.column(0)):
                own, score, rejected = _answers(m.value, batch.column(0).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[1:]), pa.array(learned[own], pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], [*names, *ADDED.names])

    return docs.select(F.col("text").cast("string").alias(unused("text", names)), *names).mapInArrow(released(predicted), T.StructType([*fields, *ADDED.fields]))


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that aren't rejected, with all their columns, whatever these are called.

    ``text`` has to be a string column.  Nulls, texts without letters, repeated
    rows and empty tables are as in ``identify``.
    """
    m = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def kept(batches):
        for batch in batches:
            for a, b in blocks(batch.column(at)):
                part = batch.slice(a, b - a)
                yield part.filter(pa.array(~_answers(m.value, part.column(at))[2]))

    return docs.mapInArrow(released(kept), docs.schema)


def held_out(doc_id) -> F.Column:
    """Whether the fold is kept from training: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
