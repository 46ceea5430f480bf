from __future__ import annotations

import numpy as np
import pytest
from starloom.llm import neighbours as nn
from starloom.llm.queries import QUERIES


def exact(rows, every=nn.QUERY_EVERY, k=nn.K):
    out = {}
    for q, v in rows:
        if q % every == 0:
            others = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in rows if i != q)
            out[q] = others[:k]
    return out


def test_query_recall(spark, sf_dir):
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = exact(rows)
    got = QUERIES["op5_neighbours"](spark, sf_dir).collect()
    vectors = dict(rows)
    assert sorted({r["query_id"] for r in got}) == sorted(want)
    hits = 0
    for q, best in want.items():
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        for r in mine:
            assert r["score"] == pytest.approx(float(np.sqrt(((vectors[q] - vectors[r["vec_id"]]) ** 2).sum())), abs=1e-12)
        hits += len({r["vec_id"] for r in mine} & {i for _, i in best})
    assert hits >= 0.9 * 10 * len(want)


def test_probing_retrieves_exactly_the_codes_within_the_radius():
    random = np.random.default_rng(4)
    codes = random.integers(0, 1 << 63, 400, dtype=np.int64).view(np.uint64)
    queries = codes[:20] ^ np.uint64(0b1011)
    for radius in (0, 7, 8, 20, 31, 64):
        want = np.bitwise_count(queries[:, None] ^ codes[None, :]) <= radius
        assert (nn.candidates(codes, queries, radius) == want).all()


def test_copies_ties_nulls_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(1, 60)]
    rows = [
        *base,
        (0, [1.0, 1.0, 1.0]),
        (0, [1.0, 1.0, 1.0]),
        (None, [1.0, 1.0, 1.0]),
        (100, None),
        (200, [0.0, 0.0, 0.0]),
        (300, [1.0, None, 2.0]),
        (400, [nan, 1.0, 1.0]),
        (500, [inf, 1.0, 1.0]),
        (600, [1.0, 2.0]),
        (700, [5.0, 5.0, 5.0]),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = nn.search(frame).collect()
    assert {r["query_id"] for r in got} == {0, 700}
    usable = [(i, np.array(v)) for i, v in rows if v is not None and len(v) == 3 and None not in v and np.isfinite(v).all() and any(v)]
    for q in (0, 700):
        mine = [(r["score"], r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        me = next(v for i, v in usable if i == q)
        want = sorted((float(np.sqrt(((v - me) ** 2).sum())), i is None, i if i is not None else 0) for i, v in usable if i != q)[:10]
        assert [s for s, _ in mine] == pytest.approx([s for s, _, _ in want])
        assert [i for _, i in mine] == [None if none else i for _, none, i in want]
    assert nn.search(frame.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [4.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"]) for r in nn.search(few).collect()] == [(1, 1), (2, 2)]


def test_only_probed_buckets_are_read():
    """Rows of other buckets don't turn up, even if their codes are changed to that of the query once the tables stand."""
    codes = np.array([0, 1, 0x0101010101010101, (1 << 64) - 1], np.uint64)
    buckets = nn.Buckets(codes)
    assert buckets.within(np.uint64(0), 8).tolist() == [0, 1, 2] and buckets.within(np.uint64(0), 7).tolist() == [0, 1]
    buckets.codes = np.zeros(4, np.uint64)
    assert buckets.within(np.uint64(0), 7).tolist() == [0, 1] and buckets.within(np.uint64(0), 64).tolist() == [0, 1, 2, 3]
    assert nn.Buckets(codes[:0]).within(np.uint64(0), 64).tolist() == []
