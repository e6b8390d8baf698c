import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tarnlog.llm import bpe, packing

ODD = ["", None, " ", "  a", "a  b", "\n\nb \n c", "a \n", "'s 's don't I'LL", "aaaaaaaaaa " * 3, "　x 　y", "x" * 5000, " " * 300 + "z", "a\x85 b", "<|endoftext|> q", "\x00\x1c b \x1c", "né é­訂單🙂", "12 345,67"]


@pytest.fixture(scope="module")
def reference_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_ids_equal_the_public_library(spark, reference_ids):
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(ODD)], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(df).collect()}
    for i, x in enumerate(ODD):
        assert got[i] == reference_ids(x), repr(x)
    assert got[0] == got[1] == []
    assert bpe.encode_documents(df.where("false")).count() == 0
    assert {r["doc_id"]: r["n_tokens"] for r in bpe.token_counts(df).collect()} == {i: len(v) for i, v in got.items()}


def test_random_texts(reference_ids):
    rnd = np.random.default_rng(0)
    chars = list(" \n\t abcdeABC0129.,'é訂") + ["'s", " the"]
    texts = ["".join(rnd.choice(chars, rnd.integers(0, 60))) for _ in range(400)]
    bounds, ids = bpe.BlockEncoder(bpe.default_vocabulary()).encode(pa.array(texts))
    for i, x in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == reference_ids(x)


def test_blocks_cut_between_rows(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 10)
    batch = pa.record_batch({"text": pa.array(["a" * 8, None, "b" * 30, "c", ""])})
    parts = [p.column("text").to_pylist() for p in bpe.blocks(batch, "text")]
    assert sum(parts, []) == ["a" * 8, None, "b" * 30, "c", ""] and len(parts) > 1


def best_fit_plain(sizes, capacity):
    rooms, out = [], np.empty(len(sizes), dtype=int)
    for k in np.argsort(-sizes, kind="stable"):
        fits = [r for r in rooms if r >= sizes[k]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - sizes[k])
            out[k] = min(fits) - sizes[k]
        else:
            rooms.append(capacity - sizes[k])
            out[k] = capacity - sizes[k]
    return sorted(rooms)


def test_tree_against_plain_search():
    rnd = np.random.default_rng(1)
    for capacity in (1, 7, 64, 256):
        sizes = rnd.integers(0, capacity + 1, 200)
        bins = packing.best_fit_decreasing(sizes, capacity)
        rooms = sorted(capacity - np.bincount(bins, weights=sizes).astype(int))
        assert rooms == best_fit_plain(sizes, capacity)


def test_pack(spark):
    items = spark.createDataFrame([(1, 10), (2, 25), (3, 0), (4, None), (None, 3), (1, 10), (5, 20)], "doc_id long, n_tokens long")
    caps = spark.createDataFrame([("s", 10), ("l", 100), ("l", 100), ("bad", 0), ("null", None)], "size_name string, capacity_tokens int")
    for shard in (1 << 25, 20):
        got = packing.pack(items, caps, shard_tokens=shard)
        rows = got.collect()
        assert {r["size_name"] for r in rows} == {"s", "l"}
        for name, cap in (("s", 10), ("l", 100)):
            mine = [r for r in rows if r["size_name"] == name]
            assert sum(r["n_tokens"] for r in mine) == 68
            assert max(r[0] for r in got.where(F.col("size_name") == name).groupBy("container").agg(F.sum("n_tokens")).select("sum(n_tokens)").collect()) <= cap
        two = sorted((r["piece"], r["start"], r["n_tokens"]) for r in rows if r["doc_id"] == 2 and r["size_name"] == "s")
        assert two == [(1, 0, 10), (2, 10, 10), (3, 20, 5)]
    assert packing.pack(items.where("false"), caps).count() == 0
    many = spark.createDataFrame([(None, 0)] * 300 + [(7, 0)] * 300, "doc_id long, n_tokens long")
    few = packing.pack(many, caps, shard_items=100).where("size_name = 's'")
    assert few.count() == 600 and few.select("container").distinct().count() == 7
    one = items.groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))
    assert sorted(r[2:] for r in map(tuple, packing.violations(packing.pack(one, caps), one).collect())) == [(6, True, True)] * 2
    assert [r["whole"] for r in packing.violations(packing.pack(one, caps).where("doc_id is not null or n_tokens < 3"), one.withColumn("n_tokens", F.col("n_tokens") + 1)).collect()] == [False] * 2
    assert packing.pack(items, caps.where("false")).count() == 0
    report = {r["size_name"]: r for r in packing.fill_report(packing.pack(items, caps)).collect()}
    assert report["l"]["containers"] == 1 and report["s"]["least_containers"] == 7
