"""Exact ids, packing and token files against the tokenizers library alone."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from crawlcat.llm import packing, queries, token_files
from crawlcat.llm.wordids import WordEncoder, encoder, vocabulary_path

TEXTS = [
    "", None, "Hello, world. It's   a\ttest\n\n…. É.x ÀÉ, don't . ,. a.b,c ÷. ×, x̂.y", "<|endoftext|> <|ENDOFTEXT|> Abc.", "ΑΣ. İstanbul ſ K",
    "123.45,6", "áb Å.", "emoji😀.ok", "\x1c\x1d x\x85y z w", "é.é,é;é", "word " * 3000, "x" * 5000, ".,.,", "Straße.Über,ÿ",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_is_exact(plain, spark, sf_dir):
    texts = TEXTS + [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    enc = encoder(vocabulary_path())
    for kind in (pa.string(), pa.large_string()):
        ids, at = enc.encode(pa.array(texts, kind))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(t)[:-1] for t in texts]
    ids, at = enc.encode(pa.array(["zz", *texts], pa.string()).slice(1))
    assert len(at) == len(texts) + 1 and ids[at[2] : at[3]].tolist() == plain(texts[2])[:-1]


def test_encoder_forgets_and_stays_exact(plain, monkeypatch):
    monkeypatch.setattr("crawlcat.llm.wordids.CACHE_ENTRIES", 3)
    enc = WordEncoder(vocabulary_path())
    for k in range(4):
        ids, at = enc.encode(pa.array([f"one two {k} three", f"four {k}"]))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(f"one two {k} three")[:-1], plain(f"four {k}")[:-1]]


def test_piece_lengths():
    assert packing.piece_lengths(1) == [1]
    assert packing.piece_lengths(4096 + 13) == [2048, 2048, 8, 4, 1]
    assert packing.piece_lengths(0) == []


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2]), (2, "other"), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as ids", "2 as shard")


def test_pack_whole_texts(docs, plain):
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, plain(r["text"])) for r in docs.collect())
    got, seen = {}, set()
    for r in docs.transform(packing.pack).collect():
        assert r["length"] <= 2048 and r["length"] == 1 << r["bucket"] and r["offset"] == 0
        assert r["sequence_id"] not in seen and not seen.add(r["sequence_id"])
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert crc(ids) == r["ids_crc32"] and len(ids) == r["length"]
        got.setdefault((r["doc_id"] if r["doc_id"] is not None else -1, r["doc_tokens"]), []).append((r["start"], ids))
    assert sum(map(len, (i for p in got.values() for _, i in p))) == sum(len(i) for _, i in want)
    for doc, ids in want:
        pieces = sorted(got[doc, len(ids)])
        assert [x for _, i in pieces[: len(packing.piece_lengths(len(ids)))] for x in i] == ids or len(pieces) > len(packing.piece_lengths(len(ids)))


def test_token_files_round_trip(docs, plain):
    files = token_files.write(docs)
    rows = sorted(token_files.read(files, with_ids=True).collect(), key=lambda r: r["start"])
    want = [(r["doc_id"], tuple(plain(r["text"]))) for r in docs.collect()]
    assert sorted(((r["doc_id"], tuple(np.frombuffer(bytes(r["ids"]), "<u4").tolist())) for r in rows), key=str) == sorted(want, key=str)
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in want), key=lambda d: -1 if d is None else d)
    start = 0
    for r in rows:
        assert r["start"] == start and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        start += r["n_tokens"]
    assert sorted(map(tuple, token_files.fetch(files, 2))) == sorted(t for d, t in want if d == 2)
    with pytest.raises(ValueError):
        token_files.read(token_files.TokenFiles(files.spark, files.path, "0" * 64))


def test_token_files_over_many_shards(spark, sf_dir, plain, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_DOCS", 17)
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 4_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = token_files.write(docs)
    assert len(files.dictionary()) > 0
    rows = sorted(token_files.read(files).collect(), key=lambda r: r["start"])
    start = 0
    for r, (doc, text) in zip(rows, sorted((d["doc_id"], d["text"]) for d in docs.collect()), strict=True):
        ids = plain(text)
        assert tuple(r)[:4] == (doc, start, len(ids), crc(ids))
        start += len(ids)


def test_empty_tables(docs):
    none = docs.where("false")
    assert packing.pack(none).count() == 0
    assert token_files.read(token_files.write(none)).count() == 0


def test_op1_and_op8_agree(spark, sf_dir):
    packed = queries.QUERIES["op1_power_of_two_packing"](spark, sf_dir).groupBy("doc_id").sum("length").collect()
    filed = queries.QUERIES["op8_token_files"](spark, sf_dir).collect()
    assert {r[0]: r[1] for r in packed} == {r["doc_id"]: r["n_tokens"] for r in filed}


def test_batches_hold_equal_lengths(docs, spark, sf_dir):
    whole = docs.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    batches = {}
    for r in packing.pack(whole, with_ids=False, batch_tokens=4_096).collect():
        batches.setdefault(r["batch_id"], []).append(r["length"])
    assert all(len(set(b)) == 1 and sum(b) <= 4_096 for b in batches.values())
    unfilled = [b for b in batches.values() if sum(b) < 4_096]
    assert len(unfilled) <= 12 * whole.rdd.getNumPartitions() and len(batches) > len(unfilled)


def test_blocks_know_their_range_and_place(docs, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 60)
    files = token_files.write(docs)
    rows = files.spark.read.parquet(f"{files.path}/shards").orderBy("shard", "block").collect()
    assert len(rows) > 3
    for r, last in zip(rows, [None, *rows]):
        ids = [i for i in r["doc_ids"] if i is not None]
        assert (r["first_id"], r["last_id"]) == (min(ids, default=None), max(ids, default=None))
        assert r["before"] == (last["before"] + last["tokens"] if last and last["shard"] == r["shard"] else 0)
    assert len(token_files.fetch(files, 2)) == 3 and token_files.fetch(files, 999) == []
