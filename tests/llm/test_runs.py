from __future__ import annotations

import hashlib
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import runs
from starloom.llm.queries import QUERIES


def plain_runs(words, least_words=24, least_periods=3):
    """All runs by trying every period at every place."""
    found, n = {}, len(words)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, least_periods * q):
                found.setdefault((i, length), q)  # periods ascend, so the smallest stays
            i = j
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (
        doc_id,
        len(found),
        *best,
        best[0] is not None and 1000 * best[1] // best[2] or None,
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


@given(st.data())
@settings(max_examples=300, deadline=None)
def test_against_brute_force(data):
    letters = data.draw(st.integers(1, 4))
    base = data.draw(st.lists(st.integers(0, letters), max_size=40))
    blocks = data.draw(st.lists(st.tuples(st.lists(st.integers(0, letters), min_size=1, max_size=6), st.integers(1, 12)), max_size=5))
    ids = base[:20]
    for block, times in blocks:
        ids += block * times
    ids += base[20:]
    least = data.draw(st.sampled_from([3, 6, 24]))
    got = runs.runs_of(np.array(ids, np.int64), least)
    assert [tuple(r) for r in got.tolist()] == plain_runs(ids, least)


def test_two_periods_and_fibonacci_words(no_docs):
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    got = runs.runs_of(np.array(b), 4, 2)
    assert [tuple(r) for r in got.tolist()] == plain_runs(b, 4, 2)
    with pytest.raises(ValueError):
        runs.find_runs(no_docs, 24, 1)


@pytest.mark.parametrize("period", [1, 7, 50_000])
def test_very_long_texts(period):
    random = np.random.default_rng(period)
    block = random.integers(0, 1000, period) if period > 1 else np.zeros(1, np.int64)
    ids = np.concatenate(([-1], np.tile(block, 200_000 // period), [-2]))
    start = time.perf_counter()
    got = runs.runs_of(ids)
    assert got.tolist() == [[1, len(ids) - 2, period]]
    assert time.perf_counter() - start < 20


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_runs"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(plain_row(d["doc_id"], d["text"]) for d in docs)
    assert sum(r[1] > 0 for r in rows) >= 10


def test_messy(messy, no_docs, spark):
    got = runs.find_runs(messy).collect()
    assert len(got) == messy.count()
    by_id = {r["doc_id"]: r for r in got}
    assert [tuple(r) for r in by_id[200]["runs"]] == [(0, 120_000, 3)] and by_id[200]["collapsed"] == "abc defg hij"
    assert by_id[150]["n_words"] == 0 and by_id[150]["collapsed"] == "" and by_id[150]["runs"] == []
    assert by_id[300]["collapsed"].startswith("Ünïcode ▁ text — with “marks” and 日本語")
    assert runs.find_runs(no_docs).count() == 0
    nothing = spark.createDataFrame([(None, None), (7, None), (7, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in runs.find_runs(nothing).collect()] == [(0, [], "")] * 3
