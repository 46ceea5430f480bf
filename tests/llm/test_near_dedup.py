from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from starloom.llm import near_dedup as nd
from starloom.llm.components import connected_components
from starloom.llm.queries import QUERIES


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, radius=4):
    """Smallest key per component of (key, number) pairs."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, (_, a) in enumerate(items):
        for j in range(i):
            if (a ^ items[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(items):
        best[find(i)] = min(key, best.get(find(i), key))
    return {key: best[find(i)] for i, (key, _) in enumerate(items)}


@given(st.text(alphabet="aB \n\tÄ x", max_size=40))
@settings(max_examples=100, deadline=None)
def test_fingerprint(text):
    assert nd.fingerprint_of(text.encode()) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("width", [1, 2, 4])
def test_embedding_is_a_lower_bound(spark, width):
    random = np.random.default_rng(width)
    bits = random.integers(0, 1 << 63, 300, dtype=np.int64) * 2 + random.integers(0, 2, 300)
    code = nd.thermometer_np(bits.view(np.uint64), width)
    frame = spark.createDataFrame([(int(b),) for b in bits], "fp long").select("fp", nd.thermometer(F.col("fp"), width).alias("c"))
    assert {r["fp"]: r["c"] % (1 << 64) for r in frame.collect()} == dict(zip(bits.tolist(), code.tolist()))
    counts = np.array([[(int(b) >> s & (1 << width) - 1).bit_count() for s in range(0, 64, width)] for b in bits.view(np.uint64)])
    for i in range(0, 300, 2):
        manhattan = int(np.abs(counts[i] - counts[i + 1]).sum())
        assert int(np.bitwise_count(code[i] ^ code[i + 1])) == manhattan <= int(np.bitwise_count((bits[i] ^ bits[i + 1]).view(np.uint64)))


@pytest.mark.parametrize("zeros", [2, 3])
def test_grids_cover_every_close_pair(zeros):
    random = np.random.default_rng(zeros)
    masks = np.array(nd.grids(4, zeros), np.uint64)
    for _ in range(300):
        a = random.integers(0, 1 << 63, dtype=np.int64)
        flips = random.choice(64, random.integers(0, 5), replace=False)
        b = np.bitwise_xor.reduce([np.uint64(a), *(np.uint64(1) << flips.astype(np.uint64))])
        x, y = nd.thermometer_np(np.array([np.uint64(a), b]))
        assert (((x ^ y) & masks) == 0).any()


def test_links_with_crowded_cells(spark, monkeypatch):
    """A large group of mutual neighbours, chains, and loose points, with cells cut into blocks."""
    monkeypatch.setattr(nd, "BLOCK", 20)
    random = np.random.default_rng(5)
    numbers = {int(x) for x in random.integers(0, 1 << 62, 150)}
    centre = int(random.integers(0, 1 << 62))
    for _ in range(300):
        x = centre
        for bit in random.choice(64, random.integers(1, 4), replace=False):
            x ^= 1 << int(bit)
        numbers.add(x)
    chain = int(random.integers(0, 1 << 62))
    for step in range(0, 40, 4):
        chain ^= 0b1111 << step
        numbers.add(chain)
    values = [nd.signed(x) for x in sorted(numbers)]
    points = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = nd.links(points, "fp")
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 4).count() == 0
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    want = plain_components([(v, v % (1 << 64)) for v in values])
    assert {v: roots.get(v, v) for v in values} == want


def test_components(spark):
    edges = [(1, 2), (2, 1), (3, 2), (4, 4), (5, 6), (6, 7), (7, 8), (8, 9), (None, 3), (20, 10), (10, 30), (5, 9)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 10: 10, 20: 10, 30: 10}
    assert len(got) == 12
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    component = plain_components(sorted(prints.items()))
    got = QUERIES["op3_near_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        k: (f"{p:016x}", component[k]) for k, p in prints.items()
    }


def test_messy(messy, no_docs):
    got = nd.near_components(messy).collect()
    assert len(got) == messy.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["component_id"] == by_id[50]["component_id"] == 0
    assert by_id[100]["fingerprint"] == by_id[250]["fingerprint"] == "0" * 16
    assert by_id[100]["component_id"] == by_id[150]["component_id"] == by_id[250]["component_id"] == 100
    assert nd.near_components(no_docs).count() == 0
