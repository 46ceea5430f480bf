from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from starloom.llm import mixing
from starloom.llm.queries import QUERIES


def plain_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MAX_RATE):
    """Share by weight, stop the full ones, share again what is left."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, targets, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(targets.values())
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if most * sizes[s] < level * weight[s]}
        if not full:
            targets |= {s: level * weight[s] for s in free}
            break
        targets |= {s: most * sizes[s] for s in full}
        free -= full
    return targets


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    random = np.random.default_rng(seed)
    names = [None, "", "a", "B", "ä", "z", "Z", "😀", "�"][: random.integers(1, 10)]
    sizes = {s: int(random.lognormal(4, 2.5)) * int(random.random() > 0.2) for s in names}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items() for n in (n // 2, n - n // 2)], "source string, size long")
    got = {r["source"]: r for r in mixing.source_targets(frame).collect()}
    want = plain_targets(sizes)
    assert set(got) == set(want)
    for s, target in want.items():
        assert got[s]["target"] == pytest.approx(target, rel=1e-9, abs=1e-9) and got[s]["source_size"] == sizes[s]
        assert got[s]["target"] <= 3 * sizes[s] + 1e-6


def test_query(spark, sf_dir):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op9_mixing"](spark, sf_dir).collect()
    sizes, taken = Counter(), defaultdict(int)
    for d in docs.values():
        sizes[d["source"]] += len(d["text"].encode().split())
    want = plain_targets(sizes)
    for r in got:
        source = docs[r["doc_id"]]["source"]
        assert r["size"] == len(docs[r["doc_id"]]["text"].encode().split()) and r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source]) and r["taken"] <= 3 * r["size"]
        rate = want[source] / sizes[source]
        assert r["taken"] in (int(rate) * r["size"], (int(rate) + 1) * r["size"])
        taken[source] += r["taken"]
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.15)
    again = QUERIES["op9_mixing"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), f"s{i % 4}") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = mixing.taken_words(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want"))
    for r in sums.collect():
        assert r["t"] == pytest.approx(r["want"], rel=0.06)


def test_copies_agree_with_taken(spark, messy):
    mixed = mixing.mix(messy)
    assert mixed.columns == messy.columns
    words = mixed.select(mixing.word_count(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert (words or 0) == mixing.taken_words(messy).agg(F.sum("taken")).first()[0]


def test_messy(messy, no_docs):
    got = mixing.taken_words(messy).collect()
    assert len(got) == messy.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.taken_words(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0
