"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of WINDOW words, STEP apart.  Over the terms that occur in
the benchmark, a randomised SVD of the TF-IDF passages of the whole corpus (and
of the benchmark, weighted to the same energy) gives RANK latent directions:
one distributed pass sums A'(A Omega) for a Gaussian Omega together with the
passage frequencies, and the driver finishes with a Nystroem decomposition of
a matrix as large as the benchmark's terms, not the corpus.

A second pass leaves out, without loss, what lacks the words that the checks
ask for (REACH words and their neighbours at a time), projects the remaining
passages and settles them exactly, by the longest common subsequence of words
and by the answer (beside words of some weight in the passage): in a wide
region around a passage whose cosine with a benchmark window reaches COSINE,
and whatever the cosine in a region of the item's own length, so a copy is
found however short the item and however common or many the words around it.

What is searched for is the whole item: an excerpt of a long item that stays
under COPIED of its words, and without its answer, isn't reported.

Both passes are narrow; only sums of (terms x sketch) are shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from crawlcat.llm.common import released
from crawlcat.llm.wordids import _flat, slices

WINDOW, STEP = 16, 8
RANK, OVERSAMPLE, SEED = 64, 16, 7
COSINE = 0.5
#: Words of a text whose passages are left out together.
REACH = 64
#: Share of an item's words in the common subsequence: enough alone, and enough beside its answer.
COPIED, PARAPHRASED, ANSWERED = 0.75, 0.5, 0.8
#: Share of a full item window's own IDF mass whose words must be in the passage where the answer decides, and the greatest IDF in it, which keeps it from growing with the corpus.
SHARED, IDF_MAX = 0.35, 8.0
#: Characters of the benchmark in one pass over the corpus, about; a larger one is searched in parts.
PART_CHARS = 400_000
#: Bytes whose words are numbered at once, and words whose vectors are held at once, about.
BLOCK_BYTES, BLOCK_WORDS = 4_000_000, 10_000
_CHUNK = 256
#: Runs of REACH words whose terms are looked at together, so that a very long text takes no more memory than several short ones.
ABLE_ROWS = 256

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True

HITS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("lcs", T.DoubleType()), T.StructField("cosine", T.DoubleType()), T.StructField("answered", T.BooleanType()), T.StructField("word", T.LongType())])


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words (runs of ASCII letters and digits or any other characters above) on end, and each text's offset in them."""
    raw, at = _flat(pc.utf8_lower(texts.fill_null("")))
    word = _WORD[raw]
    if not word.any():
        return pa.array([], pa.binary()), np.zeros(len(at), np.int64)
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = at[:-1][at[:-1] < len(raw)]
    first[begins] = word[begins]
    kept = np.cumsum(word)
    starts = np.flatnonzero(first)
    offsets = np.append(kept[starts] - 1, kept[-1]).astype(np.int32)
    array = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[word])])
    return array, np.searchsorted(starts, at)


@dataclass(frozen=True)
class Items:
    """A benchmark part: terms, and each item's term ids, answer ids and windows."""

    ids: list[int]
    terms: list[bytes]
    words: list[np.ndarray]
    answers: list[np.ndarray]

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Term number of every word, -1 for others, and the offsets of the texts."""
        array, at = words(texts)
        if not len(array):
            return np.empty(0, np.int32), at
        coded = array.dictionary_encode()
        number = pc.index_in(coded.dictionary, pa.array(self.terms, pa.binary())).fill_null(-1).to_numpy().astype(np.int32)
        return number[coded.indices.to_numpy()], at


def groups(at: np.ndarray):
    """(first, end) ranges of texts of about BLOCK_WORDS words, one text at least."""
    first = 0
    while first < len(at) - 1:
        end = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_WORDS, "right")) - 1)
        yield first, end
        first = end


def closing(text: str) -> str:
    """The last sentence, which stands for the answer where the benchmark has no column of it."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if re.search(r"\w", p)]
    return parts[-1] if parts else text


def items_of(rows: list) -> Items:
    """Items of (item_id, text, answer) rows without words are left out: nothing can hold them."""
    texts = [words(pa.array([r[1], r[2] if r[2] is not None else closing(r[1])], pa.string())) for r in rows]
    split = [([w for w in a[: at[1]].to_pylist()], [w for w in a[at[1] :].to_pylist()]) for a, at in texts]
    kept = [(r[0], w, x) for r, (w, x) in zip(rows, split) if w]
    terms = sorted({w for _, own, answer in kept for w in (*own, *answer)})
    number = {w: i for i, w in enumerate(terms)}
    ids = lambda own: np.array([number[w] for w in own], np.int32)
    return Items([i for i, _, _ in kept], terms, [ids(w) for _, w, _ in kept], [ids(x) for _, _, x in kept])


@dataclass(frozen=True)
class Passages:
    """Blocks of STEP words over the texts of a slice; passage j is blocks j and j + 1 of the same text."""

    block: np.ndarray  #: of every word
    first: np.ndarray  #: by text: its first block
    joined: np.ndarray  #: by block: whether the next one is of the same text

    @staticmethod
    def of(at: np.ndarray) -> "Passages":
        sizes = np.diff(at)
        n = -(-sizes // STEP)
        first = np.concatenate([[0], np.cumsum(n)])
        inside = np.arange(at[-1]) - np.repeat(at[:-1], sizes)
        joined = np.ones(first[-1], bool)
        joined[first[1:][n > 0] - 1] = False
        return Passages(np.repeat(first[:-1], sizes) + inside // STEP, first, joined)

    def sums(self, number: np.ndarray, table: np.ndarray) -> np.ndarray:
        """For every passage the sum of its terms' rows of ``table``."""
        known = number >= 0
        rows, block = table[number[known]], self.block[known]
        out = np.zeros((len(self.joined), table.shape[1]), np.float32)
        if len(block):
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            out[block[starts]] = np.add.reduceat(rows, starts, axis=0)
            out[:-1] += np.where(self.joined[:-1, None], out[1:], 0)
        return out


def omega(terms: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((terms, RANK + OVERSAMPLE), np.float32)


def sketch(number: np.ndarray, at: np.ndarray, table: np.ndarray, total: np.ndarray, seen: np.ndarray) -> int:
    """Add A'(A table) of these texts' passages to ``total`` and the blocks that hold each term to ``seen``; the number of blocks."""
    p = Passages.of(at)
    if not len(p.joined):
        return 0
    w = p.sums(number, table)
    both = w.copy()
    both[1:] += np.where(p.joined[:-1, None], w[:-1], 0)
    known = np.flatnonzero(number >= 0)
    if len(known):
        known = known[np.argsort(number[known], kind="stable")]
        term, block = number[known], p.block[known]
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        total[term[starts]] += np.add.reduceat(both[block], starts, axis=0)
        new = np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])
        seen += np.bincount(term[new], minlength=len(seen))
    return len(p.joined)


def directions(docs: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(terms x RANK) matrix that takes term counts to the latent space, IDF included, and the IDF."""
    spark = docs.sparkSession
    n, width = len(items.terms), RANK + OVERSAMPLE
    shared = spark.sparkContext.broadcast(items)

    def summed(batches):
        own, table = shared.value, omega(n)
        total, seen, blocks = np.zeros((n, width)), np.zeros(n), 0
        for batch in batches:
            for a, b in slices(batch.column(0), BLOCK_BYTES):
                number, at = own.numbered(batch.column(0).slice(a, b - a))
                for c, d in groups(at):
                    blocks += sketch(number[at[c] : at[d]], at[c : d + 1] - at[c], table, total, seen)
        if blocks:
            every = np.concatenate([total, seen[:, None]], axis=1)
            parts = [every[i : i + _CHUNK].astype("<f8").tobytes() for i in range(0, n, _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(parts)), pa.int64()), pa.array([np.float64(blocks).tobytes(), *parts], pa.binary())], ["part", "sums"])

    def added(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(blob, "<f8")
                totals[part] = totals[part] + own if part in totals else own
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["part", "sums"])

    partial = docs.select("text").mapInArrow(released(summed), "part long, sums binary")
    got = {r["part"]: np.frombuffer(bytes(r["sums"])) for r in partial.repartition("part").mapInArrow(released(added), "part long, sums binary").collect()}
    total, seen, blocks = np.zeros((n, width)), np.zeros(n), got.pop(-1, np.zeros(1))[0]
    for part, sums in got.items():
        own = sums.reshape(-1, width + 1)
        total[part * _CHUNK : part * _CHUNK + len(own)], seen[part * _CHUNK : part * _CHUNK + len(own)] = own[:, :-1], own[:, -1]

    table = omega(n)
    bench, held = np.zeros((n, width)), np.zeros(n)
    own_at = np.concatenate([[0], np.cumsum([len(w) for w in items.words])])
    blocks += sketch(np.concatenate(items.words), own_at, table, bench, held)
    idf = np.maximum(np.log((blocks + 1) / (seen + held + 1)), 0.05)
    ours, theirs = np.linalg.norm(idf[:, None] * total), np.linalg.norm(idf[:, None] * bench)
    y = idf[:, None] * (total + (ours / theirs if ours and theirs else 1) * bench)
    core = (table / idf[:, None]).T @ y
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > value.max() * 1e-9
    u, _, _ = np.linalg.svd(y @ (vector[:, good] / np.sqrt(value[good])), full_matrices=False)
    return (idf[:, None] * u[:, :RANK]).astype(np.float32), idf


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def common(masks: dict[int, int], size: int, numbers: list[int]) -> int:
    """Length of the longest common subsequence, by bits of the item's positions."""
    full = (1 << size) - 1
    v = full
    for x in numbers:
        if m := masks.get(x):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def _masks(own: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(own.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


@dataclass(frozen=True)
class Holders:
    """Items that are searched for in so many neighbours of REACH words: by term, those that hold it (and, after them, whose answers do) and at how many places."""

    items: np.ndarray
    reach: int
    at: np.ndarray
    holder: np.ndarray
    places: np.ndarray
    sizes: np.ndarray  #: of the items, then of the answers

    @staticmethod
    def of(items: Items) -> list["Holders"]:
        reach = np.array([-(-(len(w) + WINDOW + STEP) // REACH) for w in items.words])
        out = []
        for k in np.unique(reach):
            mine = np.flatnonzero(reach == k)
            both = [texts[i] for texts in (items.words, items.answers) for i in mine]
            sizes = np.array([len(x) for x in both])
            key, places = np.unique(np.concatenate(both).astype(np.int64) * len(both) + np.repeat(np.arange(len(both)), sizes), return_counts=True)
            out.append(Holders(mine, int(k), np.searchsorted(key, np.arange(len(items.terms) + 1) * len(both)), key % len(both), places.astype(float), sizes))
        return out


def able(holders: list[Holders], number: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first word, item) of the REACH words of a text whose passages may pass the checks: the words are there, in whatever order."""
    sizes, terms = np.diff(at), len(holders[0].at) - 1
    first = np.concatenate([[0], np.cumsum(-(-sizes // REACH))])
    text = np.repeat(np.arange(len(sizes)), np.diff(first))
    known = np.flatnonzero(number >= 0)
    inside = known - np.repeat(at[:-1], sizes)[known]
    row, term = np.repeat(first[:-1], sizes)[known] + inside // REACH, number[known]
    out = []
    for h in holders:
        for lo in range(0, len(text), ABLE_ROWS):
            hi = min(len(text), lo + ABLE_ROWS)
            begin, end = max(0, lo - h.reach), min(len(text), hi + h.reach)
            a, b = np.searchsorted(row, [begin, end])
            held = np.zeros((hi - lo, terms), bool)
            for by in range(-h.reach, h.reach + 1):
                to = row[a:b] + by
                same = (to >= lo) & (to < hi) & (to >= first[text[row[a:b]]]) & (to < first[text[row[a:b]] + 1])
                held[to[same] - lo, term[a:b][same]] = True
            chunk, near = np.divmod(np.flatnonzero(held), terms)
            many = h.at[near + 1] - h.at[near]
            ends = np.cumsum(many)
            entry = np.arange(many.sum()) + np.repeat(h.at[near] - (ends - many), many)
            n = len(h.items)
            there = np.bincount(np.repeat(chunk * 2 * n, many) + h.holder[entry], h.places[entry], (hi - lo) * 2 * n).reshape(-1, 2 * n)
            own, answer = there[:, :n] / h.sizes[:n], there[:, n:]
            c, i = np.nonzero((own >= COPIED) | (own >= PARAPHRASED) & (h.sizes[n:] > 0) & (answer >= ANSWERED * h.sizes[n:]))
            c += lo
            out += zip(text[c].tolist(), (at[text[c]] + (c - first[text[c]]) * REACH).tolist(), h.items[i].tolist())
    return out


def _searcher(docs: DataFrame, items: Items):
    """A function that makes, in a worker, the search of a string column: (row, item number, share, cosine, answered, word) of every hit."""
    shared = docs.sparkSession.sparkContext.broadcast((items, *directions(docs.select(_text().alias("text")), items)))

    def prepared():
        own, table, idf = shared.value
        at = np.concatenate([[0], np.cumsum([len(w) for w in own.words])])
        p = Passages.of(at)
        every = unit(p.sums(np.concatenate(own.words), table))
        queries = [every[a:b] for a, b in zip(p.first[:-1], p.first[1:])]
        masks, answers = [_masks(w) for w in own.words], [_masks(x) for x in own.answers]
        holders = Holders.of(own)
        weight = np.minimum(idf, IDF_MAX)
        windows = [[w[k : k + WINDOW] for k in {*range(0, len(w) - WINDOW, STEP), max(0, len(w) - WINDOW)}] for w in own.words]

        def passed(i: int, near: list[int], around: list[int], passage: list[int]) -> tuple[float, bool] | None:
            """Common share and answer of an item, if they are enough: the share in ``near``, the answer ``around`` it."""
            size, asked = len(own.words[i]), len(own.answers[i])
            lcs = common(masks[i], size, near) / size
            if lcs < PARAPHRASED:
                return None
            answered = asked > 0 and common(answers[i], asked, around) >= ANSWERED * asked
            # Usual words alone, answer included, are no sign of the item.
            if lcs < COPIED and not (answered and any(weight[w][np.isin(w, passage)].sum() >= SHARED * weight[w].sum() for w in windows[i])):
                return None
            return lcs, answered

        def of_group(number: np.ndarray, at: np.ndarray) -> dict[tuple[int, int], tuple]:
            best: dict[tuple[int, int], tuple] = {}
            p = v = None
            for d, begin, i in able(holders, number, at):
                size, first, last = len(own.words[i]), int(at[d]), int(at[d + 1])
                region = number[max(first, begin - size - STEP) : min(last, begin + REACH + WINDOW + size + STEP)].tolist()
                if passed(i, region, region, region) is None:
                    continue
                if v is None:
                    p = Passages.of(at)
                    v = unit(p.sums(number, table))
                for start in range(begin, min(begin + REACH, last), STEP):
                    c = float((queries[i] @ v[p.first[d] + (start - first) // STEP]).max())
                    around = number[max(first, start - size - STEP) : min(last, start + WINDOW + size + STEP)].tolist()
                    got = passed(i, around if c >= COSINE else number[start : min(last, start + size + STEP)].tolist(), around, number[start : min(last, start + WINDOW)].tolist())
                    if got:
                        best[d, i] = max(best.get((d, i), (0.0,)), (got[0], min(1.0, max(0.0, c)), got[1], start - first))
            return best

        def search(texts: pa.Array) -> list[tuple]:
            out = []
            for a, b in slices(texts, BLOCK_BYTES):
                number, at = own.numbered(texts.slice(a, b - a))
                for c, e in groups(at):
                    best = of_group(number[at[c] : at[e]], at[c : e + 1] - at[c])
                    out += [(a + c + d, i, *rest) for (d, i), rest in best.items()]
            return out

        return search

    return prepared


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _parts(benchmark: DataFrame):
    """The items of ``benchmark`` in parts of about PART_CHARS characters."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    asked = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer")).distinct()
    chars = asked.agg(F.sum(F.length("text"))).head()[0] or 0
    parts = max(1, -(-chars // PART_CHARS))
    for part in range(parts):
        items = items_of(asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text", "answer").collect())
        if items.ids:
            yield items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, lcs, cosine, answered, word) of every document that holds a benchmark item.

    ``docs``: ``doc_id``, ``text``; ``benchmark``: ``item_id``, ``text`` and,
    optionally, ``answer`` (else the last sentence is asked for).  Other columns
    are ignored.  A null or empty text holds nothing; items without words are
    held by nothing; repeated documents are answered each, repeated items once.
    Either table empty: no rows.  ``word`` is where the best passage begins.
    """
    rows, out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text")), None
    for items in _parts(benchmark):
        prepared, names = _searcher(docs, items), items.ids

        def found(batches, prepared=prepared, names=names):
            search = prepared()
            for batch in batches:
                hits = search(batch.column(1))
                ids = batch.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
                columns = [*zip(*hits)][2:] if hits else [()] * 4
                yield pa.RecordBatch.from_arrays([ids, pa.array([names[h[1]] for h in hits], pa.int64()), *(pa.array(c, t) for c, t in zip(columns, (pa.float64(), pa.float64(), pa.bool_(), pa.int64())))], HITS.names)

        own = rows.mapInArrow(released(found), HITS)
        out = own if out is None else out.unionByName(own)
    return out if out is not None else docs.sparkSession.createDataFrame([], HITS)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose own text holds no benchmark item, with all their columns, whatever these are called.

    Every row is judged by itself: repeated and null ids don't matter.  Null
    and empty texts stay.  ``text`` has to be a string column.
    """
    at, schema, out = docs.columns.index("text"), docs.schema, docs
    for items in _parts(benchmark):
        prepared = _searcher(docs, items)

        def kept(batches, prepared=prepared):
            search = prepared()
            for batch in batches:
                dirty = np.zeros(batch.num_rows, bool)
                dirty[[h[0] for h in search(batch.column(at).fill_null(""))]] = True
                yield batch.filter(pa.array(~dirty))

        out = out.mapInArrow(released(kept), schema)
    return out
