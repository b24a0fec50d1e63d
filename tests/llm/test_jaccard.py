"""The n-gram join against all pairs, and components against a plain union."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from crawlcat.llm import jaccard
from crawlcat.llm.components import components


def gram_set(text, n=5):
    w = re.findall("[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(rows):
    """{doc_id: (class_id, n_links)} of (doc_id, text) rows."""
    sets = defaultdict(list)
    for i, t in rows:
        sets[gram_set(t)].append(i)
    keys = list(sets)
    postings = defaultdict(list)
    for k, s in enumerate(keys):
        for g in s:
            postings[g].append(k)
    links, root = [0] * len(keys), list(range(len(keys)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, s in enumerate(keys):
        met = defaultdict(int)
        for g in s:
            for b in postings[g]:
                met[b] += 1
        for b, c in met.items():
            if b > a and c >= 0.8 * (len(s) + len(keys[b]) - c) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    least = {}
    for k, s in enumerate(keys):
        ids = [i for i in sets[s] if i is not None]
        least[find(k)] = min([*ids, *([least[find(k)]] if find(k) in least else [])], default=None)
    return {i: (least[find(k)], links[k]) for k, s in enumerate(keys) for i in sets[s]}


def near_copies(n, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = r.choices(words, k=r.choice([8, 40, 90, 300]))
        for _ in range(n if g == 0 else 12):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append(" ".join(t))
    r.shuffle(rows)
    return list(enumerate(rows))


def test_equal_to_all_pairs(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(jaccard, "EXACT_SETS", 50)
    monkeypatch.setattr(jaccard, "AT_ONCE", 16)
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    monkeypatch.setattr(jaccard, "SMALL", 8)
    monkeypatch.setattr(jaccard, "DENSE", 4)
    rows = near_copies(160)
    rows += [(10_000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, " .,"), (-4, "one"), (-5, "One!"), (-6, "x " * 30_000), (None, "one"), (-7, rows[0][1]), (-7, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' as class_id", "1 as set_key", "2 as label", "3 as block")
    got = jaccard.classes(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    wrong = [(r, want[r["doc_id"]]) for r in got if (r["class_id"], r["n_links"]) != want[r["doc_id"]]]
    assert not wrong, (len(wrong), wrong[:5])
    kept = jaccard.keep_one(docs).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({c for c, _ in want.values()})


def test_keep_one_tells_rows_by_id_and_text(spark):
    texts = [" ".join(f"t{k}w{i}" for i in range(30)) for k in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (6, texts[4]), (6, texts[4]), (None, texts[5]), (9, texts[5] + " more"), (None, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as label", "2 as text_hash", "3 as _hash", "'x' as first", "true as repeated", "map('a', 1) as set_key")
    got = jaccard.keep_one(docs)
    assert got.schema == docs.schema
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=key) == sorted([rows[0], rows[1], rows[2], rows[3], rows[4], rows[7]], key=key)


def test_pairs_of_one_boilerplate_meet_in_buckets_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 100)
    r, n = np.random.default_rng(8), 400
    rows = []
    for k in range(n):
        place = r.permutation(jaccard.SIZE - 37) + 37  # 37 places are those of all rows, 2 the pair's own: enough for a loose link
        one = np.concatenate([np.arange(37), r.integers(1_000, 1 << 32, jaccard.SIZE - 37)]).astype("<u4")
        other = one.copy()
        other[place[2:]] = r.integers(1_000, 1 << 32, len(place) - 2)
        rows += [(2 * k, bytearray(one.tobytes())), (2 * k + 1, bytearray(other.tobytes()))]
    sets = spark.createDataFrame(rows, "set_key long, sig binary")
    label = {x["v"]: x["label"] for x in components(jaccard._loose_edges(sets, jaccard.runs())).collect()}
    missed = sum(label.get(2 * k, -1) != label.get(2 * k + 1, -2) for k in range(n))
    assert missed == 0


def test_runs_reach_the_recall_at_the_last_depth():
    assert (1 - jaccard.met(jaccard.DEPTH)) ** jaccard.runs() <= 1 - jaccard.RECALL


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.classes(docs).count() == 0 and jaccard.keep_one(docs).count() == 0


def test_exact_links():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 40, 30).astype(np.uint64)) for _ in range(60)]
    side = np.array([0] * 30 + [1] * 30)
    for own in (np.zeros(60, int), side):
        links = jaccard.exact(sets, own, 0.5)
        for a in range(60):
            for b in range(60):
                j = len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
                assert links[a, b] == (a != b and j >= 0.5 and (own is not side or side[a] != side[b]))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(60)], [(100, i) for i in range(90)] + [(5, 200), (300, 301), (301, 302), (302, 300)]])
def test_components(spark, edges):
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["v"]: r["label"] for r in got} == {i: find(i) for i in list(root)} and len(got) == len(root)
