"""Self-join on the Jaccard similarity of word n-grams, by chosen paths.

Texts with the same set of n-grams are one class of copies from the start.
Every other set has a signature of SIZE minimum hashes, which turns Jaccard
similarity into the share of equal tokens (place, minimum).  A run splits the
sets recursively: each node of the tree samples a few places, from a hash of
the path that leads to it, and hands the set on to the child of its token at
each.  Buckets of SMALL sets or fewer are compared by brute force; larger ones
are split further, DEPTH times at most.  Runs repeat until a pair at the
threshold is met with probability RECALL at the last depth.  What is still
large there is dealt into blocks, which share pivots; then all sets outside the
greatest component of the bucket so far are compared with all of the bucket.

What meets is linked loosely by its signatures.  Inside the components of the
loose links all pairs are then decided exactly, on the n-grams, in blocks of a
bounded size, so a component that holds a third of all rows is spread over
many tasks; only counts and a spanning set of links leave a block, not pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from crawlcat.llm.common import released, removed, shared_dir, unused, written
from crawlcat.llm.components import components
from crawlcat.llm.decontaminate import words
from crawlcat.llm.wordids import slices

N, THRESHOLD, RECALL = 5, 0.8, 0.999
SIZE, CHILDREN, SMALL, FIRST_DEPTH, DEPTH = 64, 1.6, 64, 2, 4
#: Signatures this alike are linked loosely; four deviations below the threshold.
LOOSE = 0.6
#: Sets compared by signature in one block, and pivots of a bucket in each of its blocks.
BLOCK, PIVOTS = 1_024, 8
#: Sets and n-grams in a block of the exact step (a task holds two), and sets compared at once in it.
EXACT_SETS, EXACT_GRAMS, AT_ONCE = 8_192, 3_000_000, 1_024
#: Bits of the filter that tells which texts the exact step needs, and how many there are for each such text; texts beyond that are picked by a join.
FILTER_BITS, FILTER_SHARE = 1 << 24, 4
SLICE_BYTES, STEP_GRAMS, DENSE = 4_000_000, 16_384, 64

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RNG = np.random.default_rng(20)
_A = (_RNG.integers(0, 1 << 31, SIZE, np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, SIZE, np.uint32)


def met(depth: int, threshold: float = THRESHOLD) -> float:
    """Probability that a pair at the threshold shares a path of ``depth`` in one run."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-CHILDREN * threshold * q)
    return q


def runs(recall: float = RECALL, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - met(depth)))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def grams(texts: pa.Array, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different n-grams of each text on end, sorted, and the offsets of the texts.

    A text of fewer words, but one, has a single gram of all its words.
    """
    array, at = words(texts)
    if not len(array):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    coded = array.dictionary_encode()
    hashed = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object), categorize=False)[coded.indices.to_numpy()]
    sizes = np.diff(at)
    ends = np.maximum(sizes - n + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(sizes)), ends)
    start = np.arange(ends.sum()) - np.repeat(np.concatenate([[0], np.cumsum(ends)[:-1]]), ends) + np.repeat(at[:-1], ends)
    total = np.zeros(len(start), np.uint64)
    for k in range(n):
        inside = start + k < at[text + 1]
        w = hashed[np.minimum(start + k, len(hashed) - 1)]
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, w, np.uint64(k + 1)))
    order = np.lexsort((total, text))
    total, text = total[order], text[order]
    new = np.concatenate([[True], (total[1:] != total[:-1]) | (text[1:] != text[:-1])]) if len(total) else np.empty(0, bool)
    return total[new], np.concatenate([[0], np.cumsum(np.bincount(text[new], minlength=len(sizes)))]).astype(np.int64)


def signatures(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SIZE minimum hashes a set; of an empty set all are the greatest value."""
    out = np.full((len(at) - 1, SIZE), np.uint32(0xFFFFFFFF))
    h = (found >> np.uint64(32)).astype(np.uint32)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for lo in range(0, len(h), STEP_GRAMS):
        own = text[lo : lo + STEP_GRAMS]
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        values = h[lo : lo + STEP_GRAMS, None] * _A
        values += _B
        out[own[starts]] = np.minimum(out[own[starts]], np.minimum.reduceat(values, starts, axis=0))
    return out


def set_keys(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of each set: of its size and the sum of its mixed members."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(found ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)])
    return mix((sums[at[1:]] - sums[at[:-1]]) + mix(np.diff(at).astype(np.uint64) + np.uint64(17))).view(np.int64)


def children(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) of the children of nodes: places sampled by a hash of path and place."""
    chance = mix(path.view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, SIZE + 1, dtype=np.uint64))
    row, place = np.nonzero(chance < np.uint64(int(CHILDREN / SIZE * 2.0**64)))
    return row, mix(chance[row, place] + sig[row, place].astype(np.uint64) * _M2).view(np.int64)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows (doc_id, text_hash, set_key, n_grams, sig) of every document."""

    def signed(batches):
        for batch in batches:
            for a, b in slices(batch.column(2), SLICE_BYTES):
                found, at = grams(batch.column(2).slice(a, b - a), n)
                sig = signatures(found, at)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(set_keys(found, at)), pa.array(np.diff(at)), pa.array([s.tobytes() for s in sig], pa.binary())], ["doc_id", "text_hash", "set_key", "n_grams", "sig"])

    return docs.select("doc_id", "text_hash", "text").mapInArrow(released(signed), "doc_id long, text_hash long, set_key long, n_grams long, sig binary")


def _matrix(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<u4").reshape(-1, SIZE)


def _grouped(batches, keys: int):
    """Runs of rows, as lists of columns, of equal first ``keys`` columns; the partition is sorted by them."""
    held, key = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def _roots(n: int, pairs) -> np.ndarray:
    """Least member of each of n things under links."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def _spanning(linked: np.ndarray) -> np.ndarray:
    """Root of each row of a square matrix of links, a row at a time from what isn't reached yet."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] < 0:
            reached = np.zeros(len(linked), bool)
            front = np.array([i])
            reached[i] = True
            while len(front):
                new = linked[front].any(axis=0) & ~reached
                reached |= new
                front = np.flatnonzero(new)
            root[reached] = i
    return root


def _loose_edges(sets: DataFrame, n_runs: int, n_sets: int | None = None) -> DataFrame:
    """(a, b) of set keys: a spanning set of the loose links of every bucket."""
    n_sets = sets.count() if n_sets is None else n_sets
    under = shared_dir(sets.sparkSession)
    seeds = mix(np.arange(1, n_runs + 1, dtype=np.uint64) * _M1).view(np.int64)

    def first(batches):
        for batch in batches:
            sig, keys = _matrix(batch.column(1).to_pylist()), batch.column(0).to_numpy()
            for seed in seeds:
                row, path = np.arange(len(keys)), np.full(len(keys), seed)
                for _ in range(FIRST_DEPTH):
                    at, path = children(path, sig[row])
                    row = row[at]
                if len(row):
                    yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(keys[row])], ["bucket", "set_key"])

    def further(batches):
        for batch in batches:
            row, path = children(batch.column(0).to_numpy(), _matrix(batch.column(2).to_pylist()))
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(batch.column(1).to_numpy()[row])], ["bucket", "set_key"])

    def linked(batches):
        for _, rows in _grouped(batches, 2):
            keys = np.array([r[0] for r in rows])
            sig = _matrix([r[1] for r in rows])
            alike = np.zeros((len(keys), len(keys)), np.uint8)
            for k in range(SIZE):
                alike += sig[:, k][:, None] == sig[:, k][None, :]
            root = keys[_spanning(alike >= LOOSE * SIZE)]
            other = root != keys
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(root[other]), pa.array(keys[other])], ["a", "b"])

    nodes, ready = sets.select("set_key", "sig").mapInArrow(released(first), "bucket long, set_key long"), None
    most = math.ceil(n_sets * n_runs * CHILDREN**FIRST_DEPTH * 1.1)
    for depth in range(FIRST_DEPTH, DEPTH + 1):
        nodes = written(nodes, f"nodes_{depth}", most, under)
        most = nodes.count() * 2  # children of each, on the average 1.6
        pivots = F.array_distinct(F.array(*(F.min(F.struct(F.xxhash64("set_key", F.lit(i)), "set_key"))["set_key"] for i in range(PIVOTS))))
        sizes = nodes.groupBy("bucket").agg(F.count("*").alias("size"), pivots.alias("pivots")).where("size > 1")
        last = depth == DEPTH
        done = sizes if last else sizes.where(F.col("size") <= SMALL)
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        inside = nodes.join(done.select("bucket", blocks.alias("blocks")), "bucket").select("bucket", F.pmod(F.xxhash64("set_key", "bucket"), "blocks").cast("int").alias("block"), "set_key")
        if last:
            shared = done.where(F.col("size") > BLOCK).select("bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "pivots").select("bucket", "block", F.explode("pivots").alias("set_key"))
            inside = inside.union(shared).distinct()
        ready = inside if ready is None else ready.union(inside)
        if not last:
            large = sizes.where(F.col("size") > SMALL).select("bucket")
            nodes = nodes.join(large, "bucket").join(sets.select("set_key", "sig"), "set_key").select("bucket", "set_key", "sig").mapInArrow(released(further), "bucket long, set_key long")
    dealt = ready.join(sets.select("set_key", "sig"), "set_key").select("bucket", "block", "set_key", "sig").repartition("bucket", "block").sortWithinPartitions("bucket", "block", "set_key")
    edges = written(dealt.mapInArrow(released(linked), "a long, b long").distinct(), "links", most)
    hot = nodes.join(sizes.where(F.col("size") > BLOCK).select("bucket"), "bucket").select("bucket", "set_key")
    hot = written(hot, "hot", most)
    removed(sets.sparkSession, under)  # links and hot buckets are written, so the nodes are used up
    return edges.union(_across(hot, sets, edges)).distinct()


def _across(hot: DataFrame, sets: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b) of component labels under ``edges``: the loose links between components inside each of the buckets of ``hot`` (bucket, set_key)."""
    spark = hot.sparkSession
    if not hot.limit(1).count():
        return spark.createDataFrame([], "a long, b long")
    n_hot, n_edges = hot.count(), edges.count()
    labels = components(edges, "first_links", n_edges).withColumnRenamed("v", "set_key")
    named = written(hot.join(labels, "set_key", "left").select("bucket", "set_key", F.coalesce("label", "set_key").alias("label")), "hot_labels", n_hot)
    per = named.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    # Two components of a bucket aren't both the greatest one, so the rest against all covers every pair of components.
    main = per.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("size"), (F.sum("n") - F.max("n")).alias("rest")).where("rest > 0")
    dealt = named.join(main.select("bucket", "main", F.ceil(F.col("rest") / BLOCK).alias("los"), F.ceil(F.col("size") / BLOCK).alias("his")), "bucket").withColumn("h", F.xxhash64("set_key", "bucket"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rest = dealt.where("label != main").select("bucket", F.pmod("h", "los").alias("lo"), every("his").alias("hi"), F.lit(True).alias("own"), "set_key", "label")
    whole = dealt.select("bucket", every("los").alias("lo"), F.pmod("h", "his").alias("hi"), F.lit(False).alias("own"), "set_key", "label")
    faced = rest.union(whole).join(sets.select("set_key", "sig"), "set_key").select("bucket", "lo", "hi", "own", "label", "sig")

    def linked(batches):
        for _, rows in _grouped(batches, 3):
            own = np.array([r[0] for r in rows])
            if own.all() or not own.any():
                continue
            label, sig = np.array([r[1] for r in rows]), _matrix([r[2] for r in rows])
            alike = np.zeros((int(own.sum()), int((~own).sum())), np.uint8)
            for k in range(SIZE):
                alike += sig[own, k][:, None] == sig[~own, k][None, :]
            a, b = np.nonzero(alike >= LOOSE * SIZE)
            names, number = np.unique(label, return_inverse=True)
            pairs = np.unique(number[own][a] * len(names) + number[~own][b])
            root = names[_roots(len(names), zip(*(x.tolist() for x in np.divmod(pairs, len(names)))))]
            other = root != names
            if other.any():
                yield pa.RecordBatch.from_arrays([pa.array(root[other]), pa.array(names[other])], ["a", "b"])

    return faced.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").mapInArrow(released(linked), "a long, b long")


def exact(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> np.ndarray:
    """Square matrix of the links among sets; where sides differ, only those between the two."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.zeros((len(sets), len(sets)), np.float32)
    dense = df > DENSE
    number = np.cumsum(dense) - 1
    mine = dense[column]
    for lo in range(0, int(dense.sum()), 1_024):
        part = mine & (number[column] >= lo) & (number[column] < lo + 1_024)
        held = np.zeros((len(sets), min(1_024, int(dense.sum()) - lo)), np.float32)
        held[row[part], number[column[part]] - lo] = 1
        shared += held @ held.T
    few = (df > 1) & ~dense
    order = np.flatnonzero(few[column])
    order = order[np.argsort(column[order], kind="stable")]
    where = np.concatenate([[0], np.cumsum(df[few])])
    for size in np.unique(df[few]):
        begin = where[:-1][df[few] == size]
        member = row[order[begin[:, None] + np.arange(size)]]
        for lo in range(0, len(member), 1 + 2_000_000 // int(size * size)):
            m = member[lo : lo + 1 + 2_000_000 // int(size * size)]
            key = (m[:, :, None] * len(sets) + m[:, None, :]).ravel()
            k, c = np.unique(key, return_counts=True)
            shared.ravel()[k] += c
    union = sizes[:, None] + sizes[None, :] - shared
    out = shared >= threshold * union - 1e-6
    out &= (side[:, None] != side[None, :]) | (side.max() == side.min())
    np.fill_diagonal(out, False)
    return out


def decide(sets: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(root, links) of each set, AT_ONCE of them held against as many; where sides differ, only links between the two count."""
    links, pairs = np.zeros(len(sets), np.int64), []
    parts = [np.flatnonzero(side == v)[k : k + AT_ONCE] for v in np.unique(side) for k in range(0, int((side == v).sum()), AT_ONCE)]
    alone = side.min() == side.max()
    for i, a in enumerate(parts):
        for b in parts[i:] if alone else [p for p in parts[i + 1 :] if side[p[0]] != side[a[0]]]:
            both = a if b is a else np.concatenate([a, b])
            halves = np.zeros(len(both), int)
            halves[len(a) :] = 1
            found = exact([sets[k] for k in both], halves, threshold)
            links[both] += found.sum(axis=1)
            root = both[_spanning(found)]
            pairs += zip(root[root != both].tolist(), both[root != both].tolist())
    return _roots(len(sets), pairs), links


def _needed(asked: DataFrame) -> np.ndarray:
    """A filter of FILTER_BITS bits over the text hashes that are asked for, put together by the executors."""
    place = F.pmod("text_hash", F.lit(FILTER_BITS))
    words = asked.select(place.alias("p")).select(F.expr("cast(p div 32 as int)").alias("word"), F.expr("shiftleft(1L, cast(p % 32 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, np.uint32)  # and as many rows at most
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def _decided(docs: DataFrame, threshold: float, n: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, set_key) of ``docs`` and (set_key, label, first, n_links) of every set; ``first`` is its least (unnamed, doc_id, text_hash)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    members = written(_sets(rows, n), "members")
    n_rows = members.count()
    sets = written(members.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("first"), F.min("n_grams").alias("n_grams"), F.first("sig").alias("sig")), "sets", n_rows)
    links = _loose_edges(sets.where("n_grams > 0"), runs(recall), n_rows)
    loose = components(links, "loose")

    # All pairs inside the loose components, in blocks.
    inside = written(loose.join(sets.select(F.col("set_key").alias("v"), "first", "n_grams"), "v").select(F.col("v").alias("set_key"), "label", "first.*", "n_grams"), "loose_members", n_rows)
    sizes = inside.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / EXACT_SETS), F.ceil(F.sum("n_grams") / EXACT_GRAMS)).cast("int").alias("blocks"))
    asked = inside.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("set_key"), "blocks").cast("int"))
    few = inside.count() <= FILTER_BITS // FILTER_SHARE
    needed = rows.sparkSession.sparkContext.broadcast(_needed(asked) if few else None)  # FILTER_BITS / 8 bytes
    if not few:  # the filter would let too many through
        rows = rows.join(asked.select("text_hash").distinct(), "text_hash", "left_semi")

    def gram_rows(batches):
        bits = needed.value
        for batch in batches:
            if bits is not None:
                place = batch.column(1).to_numpy() % FILTER_BITS
                batch = batch.filter(pa.array((bits[place >> 5] >> (place & 31).astype(np.uint32)) & 1 == 1))
            for a, b in slices(batch.column(2), SLICE_BYTES):
                part = batch.slice(a, b - a)
                found, at = grams(part.column(2), n)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array([found[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary())], ["d", "t", "grams"])

    own = rows.select("doc_id", "text_hash", "text").mapInArrow(released(gram_rows), "d long, t long, grams binary")
    grammed = own.join(asked.select("doc_id", "text_hash", "set_key", "label", "block", "blocks"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
    facing = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = grammed.select("label", "block", "set_key", "grams", facing).select("label", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "set_key", "block", "grams")

    def decided(batches):
        for (_, lo, hi), rows in _grouped(batches, 3):
            group = [r for r, last in zip(rows, [None, *rows]) if last is None or r[0] != last[0]]  # repeated rows come once
            keys, side = np.array([r[0] for r in group]), np.array([r[1] for r in group])
            if lo != hi and side.min() == side.max():
                continue  # nothing in the other block
            root, links = decide([np.frombuffer(r[2], np.uint64) for r in group], side, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(keys[root]), pa.array(links)], ["set_key", "root", "links"])

    decisions = written(paired.repartition("label", "lo", "hi").sortWithinPartitions("label", "lo", "hi", "set_key").mapInArrow(released(decided), "set_key long, root long, links long"), "decisions")
    n_decisions = decisions.count()
    tied = components(decisions.select(F.col("set_key").alias("a"), F.col("root").alias("b")), "exact", n_decisions)
    counted = decisions.groupBy("set_key").agg(F.sum("links").alias("n_links"))
    return members, sets.select("set_key", "first").join(tied.withColumnRenamed("v", "set_key"), "set_key", "left").join(counted, "set_key", "left").select("set_key", F.coalesce("label", "set_key").alias("label"), "first", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = N, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``class_id`` is the least ``doc_id`` among the documents joined by links,
    ``n_links`` the number of other different sets of n-grams at ``threshold``
    or more.  Equal sets are copies and have the same links.  Null and empty
    texts, and those without words, have the empty set, alike to itself only.
    Repeated rows are answered each; a null ``doc_id`` is answered, and names a
    class only if nothing else is in it.  An empty table gives no rows.
    """
    members, of_set = _decided(docs, threshold, n, recall)
    named = of_set.groupBy("label").agg(F.min("first.doc_id").alias("class_id"))
    return members.select("doc_id", "set_key").join(of_set.join(named, "label").select("set_key", "class_id", "n_links"), "set_key").select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each class, its columns as they are.

    A row is told by its id and its text.  The one of the least id stays, of
    several texts with that id the one of the least hash, of rows that repeat
    both any one; a null id comes after all others, so it stays only where its
    whole class has none.  Documents without words are one class.
    """
    members, of_set = _decided(docs, THRESHOLD, N, RECALL)
    first = of_set.groupBy("label").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_hash")
    times = members.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "n")
    chosen = written(first.join(times, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).select("doc_id", "text_hash", (F.col("n") > 1).alias("repeated")), "chosen")

    text_hash = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))

    def rows_of(those: DataFrame) -> DataFrame:
        return docs.join(those, docs["doc_id"].cast("long").eqNullSafe(those["doc_id"]) & (text_hash == those["text_hash"]), "left_semi")

    if not chosen.where("repeated").limit(1).count():
        return rows_of(chosen)
    mark = unused("hash", docs.columns)
    again = rows_of(chosen.where("repeated")).withColumn(mark, text_hash).dropDuplicates(["doc_id", mark]).drop(mark)
    return rows_of(chosen.where("not repeated")).unionByName(again)
