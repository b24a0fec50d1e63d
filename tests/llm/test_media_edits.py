"""Media columns and edit-aware counts against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from crawlcat.llm import edit_counts, media
from crawlcat.llm.common import written
from crawlcat.llm.wordids import vocabulary_path

TEXTS = ["", None, "a" * 64, "b" * 63, "é😀" * 50, "The quick brown fox. " * 3000, "x" * 5000, " \n ", "tail \n", "word, " * 400]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    rows = [(-i, t) for i, t in enumerate(TEXTS, 1)] + [(None, "no id"), (-3, TEXTS[2])]
    extra = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spark.createDataFrame(rows, "doc_id long, text string").unionByName(extra).selectExpr("*", "1 as media", "'x' as n_bytes")


def test_media_round_trip(docs, monkeypatch):
    rows = {(r["doc_id"], r["text"]): None for r in docs.collect()}
    got = media.store(docs).collect()
    assert len(got) == docs.count()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t or "")
    seen = {}
    for r in got:
        data = texts[r["doc_id"]].encode()
        payload = media.padded(data)
        assert len(payload) % 64 == 0 and len(payload) >= 64
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert media.from_wav(bytes(r["media"])) == payload and r["media_sha256"] == hashlib.sha256(bytes(r["media"])).hexdigest() and r["media_bytes"] == len(r["media"])
        assert seen.setdefault(payload, (r["times"], r["codes"])) == (r["times"], r["codes"])
        assert r["times"] == sorted(r["times"])
    assert any(len(r["codes"]) > 50 for r in got)
    assert media.digest(media.store(docs, with_media=False)).count() == len(got)


def test_peaks_of_a_tone_and_runs_of_frames(monkeypatch):
    n = np.arange(40_000)
    tone = (128 + 60 * np.sin(2 * np.pi * 32 / media.FRAME * n) * (1 + 0.5 * np.sin(n / 900))).astype(np.uint8).tobytes()
    t, k, frames = media.peaks(tone)
    assert set(k.tolist()) & {32} and frames == 1 + -(-(40_000 - 256) // 128)
    whole = media.peaks(tone)
    monkeypatch.setattr(media, "FRAMES", 7)
    parts = media.peaks(tone)
    assert all(np.array_equal(a, b) for a, b in zip(whole[:2], parts[:2]))
    assert len(media.peaks(bytes(64))[0]) == 0


def test_pairs():
    t, b = np.array([0, 0, 3, 40]), np.array([5, 9, 7, 8])
    times, codes = media.fingerprint(t, b)
    assert times.tolist() == [0, 0] and codes.tolist() == sorted([(5 << 15) | (7 << 6) | 3, (9 << 15) | (7 << 6) | 3])


def test_edits_equal_a_full_count(spark, docs, monkeypatch):
    tok = Tokenizer.from_file(vocabulary_path())
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    monkeypatch.setattr(edit_counts, "LEAF", 40)
    monkeypatch.setattr(edit_counts, "FAN", 3)
    r = random.Random(2)
    base = [(i, (row["text"] or "")[:4000]) for i, row in enumerate(docs.select("text").collect())]
    rows, want = [], {}
    for i, text in base:
        edits, now = [], text
        for _ in range(r.randint(0, 6)):
            a = r.randint(-3, len(now) + 5)
            b = a + r.choice([0, 0, 1, 2, 30, 500])
            new = r.choice(["", "x", " ", "ab cd", "é.\n", "long " * 60, "y" * 90])
            edits.append((a, b, new))
            s = min(max(0, a), len(now))
            now = now[:s] + new + now[min(max(s, b), len(now)) :]
        rows.append((i, text, edits))
        want[i] = (n(text), len(edits), n(now), len(now))
    data = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:long,end:long,text:string>>")
    for g in edit_counts.count(data).collect():
        assert tuple(g)[1:5] == want[g["doc_id"]], g


def test_stored_trees_take_further_edits_and_untouched_leaves_are_never_encoded(spark, monkeypatch):
    tok = Tokenizer.from_file(vocabulary_path())
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    r = random.Random(5)
    texts = [" ".join(r.choices(["word", "and", "é.", "longer,"], k=k)) for k in (0, 3, 900, 4_000)]
    trees = written(edit_counts.build(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")), "trees")
    kind = "array<struct<start:long,end:long,text:string>>"
    for turn in range(3):
        asked = {i: [(a := r.randint(0, len(t)), a + r.choice([0, 3, 40]), r.choice(["", " new words", "x"]))] for i, t in enumerate(texts) if i != turn}
        edits = spark.createDataFrame(list(asked.items()), f"doc_id long, edits {kind}")
        got = {x["doc_id"]: x for x in edit_counts.update(trees.join(edits, "doc_id", "left")).collect()}
        for i, es in asked.items():
            for a, b, t in es:
                texts[i] = texts[i][:a] + t + texts[i][b:]
        for i, x in got.items():
            assert (x["text"], x["n_tokens_edited"], sum(x["leaf_tokens"]), sum(x["leaf_chars"])) == (texts[i], n(texts[i]), n(texts[i]), len(texts[i]))
            assert x["reencoded_chars"] <= 3 * edit_counts.LEAF and (i in asked or not x["reencoded_chars"])
        trees = written(spark.createDataFrame([tuple(x[k] for k in edit_counts.TREES.names) for x in got.values()], edit_counts.TREES), "trees")

    class Seen:
        def __init__(self):
            self.chars = 0

        def encode(self, column):
            self.chars += sum(map(len, column.to_pylist()))
            return None, np.zeros(len(column) + 1, int)

    seen = Seen()
    leaves = edit_counts.cut("some words here " * 8_000)
    tree = edit_counts.Tree("".join(leaves), [len(x) for x in leaves], [1] * len(leaves))
    first, last, new = tree.splice(60_000, 60_004, "new")
    tree.settle(first, last, new, edit_counts._sizes(seen, new))
    assert seen.chars <= 3 * edit_counts.LEAF and len(tree.levels) > 2 and all((x.sum(axis=0) == tree.levels[0].sum(axis=0)).all() for x in tree.levels)


def test_many_inserts_at_one_place_split_their_leaf():
    tree, chars = edit_counts.Tree("start end", [9], [2]), 0
    for k in range(2_000):
        first, last, leaves = tree.splice(6, 6, f"word{k} ")
        chars += sum(map(len, leaves))
        tree.settle(first, last, leaves, [len(x.split()) for x in leaves])
    assert tree.tokens == 2_002 and chars < 2_000 * 3 * edit_counts.LEAF and len(tree.text) == tree.levels[-1][0, 0]


def test_edits_reencode_little_and_nulls(spark):
    text = "some words here " * 4000
    data = spark.createDataFrame([(1, text, [(30_000, 30_004, "new")]), (2, None, None), (3, "a b", [None, (None, None, None)])], "doc_id long, text string, edits array<struct<start:long,end:long,text:string>>")
    got = {g["doc_id"]: g for g in edit_counts.count(data).collect()}
    assert got[1]["reencoded_chars"] < 2 * edit_counts.LEAF + 10 and got[1]["n_chars_edited"] == len(text) - 1
    assert got[2]["n_tokens"] == got[2]["n_tokens_edited"] == 0 and got[3]["n_tokens_edited"] == 2
    edits = spark.createDataFrame([(1, 2, 0, 4, "x"), (1, 1, 0, 0, "abc ")], "doc_id long, seq long, start long, end long, text string")
    assert edit_counts.count(edit_counts.gathered(data, edits)).where("doc_id = 1").head()["n_chars_edited"] == len(text) + 1


def test_empty(spark, docs):
    assert media.store(docs.where("false")).count() == 0 and edit_counts.count(docs.where("false")).count() == 0
