import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.fixtures import ROWS, documents
from waymesh.llm import encoding, packing, token_store
from waymesh.llm.encoding import encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
plain, as_text = Tokenizer.from_file(VOCABULARY), Tokenizer.from_file(VOCABULARY)
as_text.encode_special_tokens = True
ODD = "a'ts \t\n\r\x0b\x0c\x1c\x85\xa0 　​<|endoftext|>9½é中\U0001f600.,don't  !"


def direct(text):
    return plain.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=ODD, max_size=60)))
def test_encoder_is_the_tokenizer(text):
    assert np.frombuffer(encoder(VOCABULARY).encode(text), dtype="<u4").tolist() == direct(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|", "endoftext", "|>", " ", "a", "\n", "é", "<", "'s"]), max_size=12).map("".join))
def test_strings_of_special_tokens(text):
    assert np.frombuffer(encoder(VOCABULARY).encode(text), dtype="<u4").tolist() == direct(text)
    assert np.frombuffer(encoder(VOCABULARY, True).encode(text), dtype="<u4").tolist() == as_text.encode(text, add_special_tokens=False).ids


def test_generations_of_chunks_and_other_files(tmp_path, monkeypatch):
    monkeypatch.setattr(encoding, "CACHED_CHUNKS", 3)
    made = encoding.Encoder(VOCABULARY)
    for text in ["a b c d e f g a b c", "é x y z a b", "a a a b c d d"] * 3:
        assert np.frombuffer(made.encode(text), dtype="<u4").tolist() == direct(text)
    assert len(made.ids) <= 3 and len(made.older) <= 3
    # a file that puts a blank before each text is not encoded by chunks
    file = json.loads(plain.to_str())
    file["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(file))
    other, truth = encoding.Encoder(str(tmp_path / "v.json")), Tokenizer.from_file(str(tmp_path / "v.json"))
    assert not other.by_chunks and made.by_chunks
    assert np.frombuffer(other.encode("word by word"), dtype="<u4").tolist() == truth.encode("word by word", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def key(d):
    return -1 if d is None else d


def test_packing_covers_each_id_once(spark):
    rows = packing.op1_packing(documents(spark).repartition(3), VOCABULARY).collect()
    by = {}
    for r in rows:
        by.setdefault(key(r["doc_id"]), []).append(r)
    want = {}
    for d, t, *_ in ROWS:
        want.setdefault(key(d), []).append(direct(t) + [0])
    assert by.keys() == want.keys()
    for d, pieces in by.items():
        copies = want[d]
        got = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces)
        expected = []
        for ids in copies:
            at = 0
            for size in packing.piece_lengths(len(ids)):
                expected.append((at, size, crc(ids[at : at + size]), len(ids)))
                at += size
            assert at == len(ids)
        assert got == sorted(expected)
    assert all(r["length"] <= 1024 and r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0 for r in rows)
    numbered = sorted((r["sequence_id"], r["length"]) for r in rows)
    assert [n for n, _ in numbered] == list(range(len(rows)))
    assert [size for _, size in numbered] == sorted(size for _, size in numbered)


def test_store_reads_back_every_document(spark):
    rows = token_store.op2_token_store(documents(spark).repartition(3), VOCABULARY).orderBy("start").collect()
    assert [key(r["doc_id"]) for r in rows] == sorted(key(r[0]) for r in ROWS)
    at = 0
    pool = {}
    for d, t, *_ in ROWS:
        ids = direct(t) + [2]
        pool.setdefault(key(d), []).append((len(ids), crc(ids)))
    for r in rows:
        assert r["start"] == at
        pool[key(r["doc_id"])].remove((r["n_tokens"], r["ids_crc32"]))
        at += r["n_tokens"]
    assert not any(pool.values())


def test_store_keeps_chunks_once_and_finds_damage(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    docs = documents(spark)
    token_store.write_store(docs, path, VOCABULARY)
    chunks, recipes = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/recipes")
    assert chunks.count() == chunks.select("hash").distinct().count() == recipes.select(F.explode("hashes")).distinct().count()
    whole = {(key(r["doc_id"]), bytes(r["ids"])) for r in token_store.read_ids(spark, path).collect()}
    assert whole == {(key(d), np.array(direct(t) + [2], dtype="<u4").tobytes()) for d, t, *_ in ROWS}
    # one wrong byte in a chunk
    broken = chunks.withColumn("ids", F.when(F.col("n") == chunks.agg(F.max("n")).first()[0], F.concat(F.lit(b"\x07\x07"), F.expr("substring(ids, 3)"))).otherwise(F.col("ids")))
    broken.write.parquet(f"{path}-b/chunks")
    recipes.write.parquet(f"{path}-b/recipes")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{path}-b/manifest")
    with pytest.raises(Exception, match="is damaged"):
        token_store.read_digests(spark, f"{path}-b").collect()
    # a document left out
    recipes.where("start > 0").write.parquet(f"{path}-c/recipes")
    chunks.write.parquet(f"{path}-c/chunks")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{path}-c/manifest")
    with pytest.raises(ValueError, match="manifest"):
        token_store.read_digests(spark, f"{path}-c")


def test_store_finds_changed_and_missing_parts(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    token_store.write_store(documents(spark).repartition(4), path, VOCABULARY)
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("chunks", "recipes", "manifest")}
    first = tables["recipes"].agg(F.min("shard")).first()[0]
    last = F.lit(tables["recipes"].agg(F.max("start")).first()[0])
    cases = {
        "no_chunk": {"chunks": tables["chunks"].where(F.col("hash") != tables["recipes"].where(F.col("start") == last).first()["hashes"][0])},
        "ends": {"recipes": tables["recipes"].withColumn("ends", F.transform("ends", lambda e, k: F.when(k < F.size("ends") - 1, e - 1).otherwise(e)))},
        "ids": {"recipes": tables["recipes"].withColumn("doc_id", F.col("doc_id") + 1)},
        "places": {"recipes": tables["recipes"].withColumn("start", F.col("start") + 1)},
        "shard": {n: tables[n].where(F.col("shard") != first) for n in ("recipes", "manifest")},
    }
    for name, changed in cases.items():
        for n, t in (tables | changed).items():
            t.write.parquet(f"{path}-{name}/{n}")
        with pytest.raises(Exception, match="missing|manifest"):
            token_store.read_digests(spark, f"{path}-{name}").collect()


def test_chunks_follow_content():
    rnd = np.random.default_rng(3)
    shared = rnd.integers(0, 50_000, 6000).astype("<u4")
    a, b = np.concatenate((rnd.integers(0, 50_000, 777).astype("<u4"), shared)), shared
    pieces = []
    for x in (a, b):
        ends = token_store.cuts(len(x), token_store.marks(x))
        assert ends[-1] == len(x) and all(0 < q - p <= token_store.MOST for p, q in zip([0, *ends], ends))
        pieces.append({x[p:q].tobytes() for p, q in zip([0, *ends], ends)})
    assert len(pieces[0] & pieces[1]) > len(pieces[1]) / 2


def test_moved_crc_is_crc_of_the_whole():
    rnd = np.random.default_rng(5)
    parts = [rnd.bytes(int(n)) for n in (0, 1, 4, 400, 5000)]
    after = np.array([sum(map(len, parts[k + 1 :])) for k in range(len(parts))])
    each = token_store.moved(np.array([zlib.crc32(p) for p in parts], dtype=np.uint32), after)
    assert int(np.bitwise_xor.reduce(each)) == zlib.crc32(b"".join(parts))


def test_empty(spark):
    assert packing.op1_packing(documents(spark, []), VOCABULARY).count() == 0
    assert token_store.op2_token_store(documents(spark, []), VOCABULARY).count() == 0
