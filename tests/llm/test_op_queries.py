"""The contract queries themselves over whole tables: against their SQL, or, where SQL can't say it, against brute force."""

import glob
import hashlib
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_text import best_fit, brute_pieces, groups, plain_fingerprint, tokenizer  # noqa: F401

from skylattice.llm import sharding, shingles
from skylattice.llm.queries import ORACLES, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    r = duck.sql(ORACLES[name])
    assert sorted(r.columns) == sorted(df.columns)
    at = [r.columns.index(c) for c in df.columns]
    assert Counter(tuple(x) for x in df.collect()) == Counter(tuple(x[i] for i in at) for x in r.fetchall())


def test_op2(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op2_simhash"](spark, DATA).collect()}
    prints = {i: plain_fingerprint(t, 3) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    ids = sorted(prints)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {i: r["component_id"] for i, r in got.items()} == groups(pairs, ids)


def test_op8(spark, texts, tokenizer):  # noqa: F811
    ids = sorted(texts)
    got = QUERIES["op8_best_fit"](spark, DATA).collect()
    want = [(ids[i], *rest) for i, *rest in brute_pieces(tokenizer, [texts[i] for i in ids])]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        ends = np.cumsum([n for _, n in sorted(spans)])
        assert [o for o, _ in sorted(spans)] == [0, *ends[:-1].tolist()] and ends[-1] <= 1024
    assert len(by) == best_fit([x[3] for x in want], 1024)


def test_op9(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op9_toxicity"](spark, DATA).collect()}
    assert set(got) == set(texts)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for i, r in got.items())
    same = {}
    for i, t in texts.items():
        same.setdefault(t or "", set()).add(round(got[i]["score"], 5))
    assert all(len(s) == 1 for s in same.values())


def test_op10(spark, texts, tokenizer):  # noqa: F811
    got = {r["doc_id"]: r for r in QUERIES["op10_bpe"](spark, DATA).collect()}
    for i, t in texts.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        said = tokenizer.decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:4] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())


def test_shards_prune(spark):
    """A filter on any one dimension leaves out shards: runs of the curve are boxes that are small in each."""
    rows = [(i, "x" * (i * 37 % 4000), f"l{i % 4}", f"s{i % 20}") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = sharding.shards(docs, count=24).join(docs.select("doc_id", "lang", "source"), "doc_id")
    shards = placed.groupBy("shard").agg(F.collect_set("lang").alias("langs"), F.collect_set("source").alias("sources"), F.min("size").alias("lo"), F.max("size").alias("hi")).collect()
    assert len(shards) == 24
    assert sum("l0" in r["langs"] for r in shards) <= 12
    assert sum("s0" in r["sources"] for r in shards) <= 16
    assert sum(r["lo"] <= 300 <= r["hi"] for r in shards) <= 16
    bounds = sharding.bounds(placed).collect()
    assert sum(r["n_rows"] for r in bounds) == 2400 and all(r["min_curve"] <= r["max_curve"] for r in bounds)


def test_partners_are_chosen_in_rounds_without_loss(spark, monkeypatch):
    """Groups whose members choose one partner a round, and whole lists in the last: the same groups as from all pairs at once."""
    import random

    r = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(150):
        t = list(base)
        for _ in range(r.randrange(0, 6)):
            t[r.randrange(len(t))] = f"x{r.randrange(10**6)}"
        texts.append(t)
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    pairs = [(a, b) for a in range(150) for b in range(a + 1, 150) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for windows, block in (((1, 2, None), 512), ((1, 3, None), 16)):
        monkeypatch.setattr(shingles, "WINDOWS", windows)
        monkeypatch.setattr(shingles, "BLOCK", block)
        assert {x["doc_id"] for x in shingles.distinct_documents(docs).collect()} == set(groups(pairs, range(150)).values())


def test_distinct_documents_edges(spark):
    """Nulls, ties, repeated rows, names that the operator uses inside."""
    base = " ".join(f"w{k}" for k in range(40))
    rows = [(5, base, 1, "a"), (5, base, 1, "a"), (3, base + " more", 2, "b"), (None, base, 3, "c"), (None, None, 4, "d"), (None, "", 4, "d"), (9, "  ", 5, "e"), (None, "alone here", 6, "f"), (None, "alone here", 6, "f"), (7, base.upper(), 7, "g"), (8, "x", 8, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__key` int, `__doc` string").withColumn("c0", F.lit(1))
    got = shingles.distinct_documents(docs)
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["__key"]) for r in got.collect()) == Counter([(3, 2), (9, 5), (None, 6), (8, 8)])
    assert shingles.distinct_documents(docs.where("false")).count() == 0
