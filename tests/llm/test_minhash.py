from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import minhash
from starloom.llm.queries import QUERIES


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 2]) for i in range(len(words) - 1)} or ({words[0]} if words else set())


def plain_rows(docs):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [plain_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    best = {}
    for i, (key, _) in enumerate(docs):
        best[find(i)] = min(key, best.get(find(i), key))
    return sorted((key, len(sets[i]), best[find(i)], key == best[find(i)]) for i, (key, _) in enumerate(docs))


@given(st.text(alphabet="aB \n\tÄ x", max_size=40))
@settings(max_examples=100, deadline=None)
def test_sets(text):
    want = {tuple(s.encode().split(b" ")) for s in plain_set(text)}
    assert minhash.shingle_set(text.encode()) == want
    hashes = minhash.shingle_hashes(text.encode())
    assert len(hashes) == len(want) and (np.diff(hashes.astype(object)) > 0).all()


@pytest.mark.parametrize("size", [1, 3, 5, 20, 200, 3000])
def test_bins_agree_as_often_as_sets_are_alike(size):
    """Mean over pairs of the share of equal bins; a biased densification would show for small sets."""
    signer, random = minhash.Signer(), np.random.default_rng(size)
    both, shares = max(1, round(0.8 * size)), []
    for _ in range(300 if size < 3000 else 60):
        values = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        part = np.sort(random.permutation(values)[:both])
        shares.append((signer.signature(values) == signer.signature(part)).mean())
    assert abs(np.mean(shares) - both / size) < 0.03


@pytest.mark.parametrize("size", [5, 10, 50, 500])
def test_pairs_at_the_limit_share_a_bucket(size):
    signer, random = minhash.Signer(), np.random.default_rng(size)
    for _ in range(1500):
        values = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        part = np.sort(random.permutation(values)[: round(0.8 * size)])
        assert (signer.buckets(values) == signer.buckets(part)).any()


def near_texts(random, count, words):
    """Families of texts whose members drift away from each other around the limit."""
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    while len(texts) < count:
        current = list(random.choice(vocabulary, words))
        for _ in range(int(random.integers(1, 12))):
            texts.append(" ".join(current))
            if random.random() < 0.5:
                current.append(str(random.choice(vocabulary)))
                continue
            for at in random.integers(0, words, max(1, words // int(random.integers(8, 25)))):
                current[at] = str(random.choice(vocabulary))
    return texts[:count]


@pytest.mark.parametrize("words", [6, 30, 120])
def test_components_against_all_pairs(spark, words, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    random = np.random.default_rng(words)
    docs = list(enumerate(near_texts(random, 250, words)))
    docs += [(1000 + i, docs[i][1].upper()) for i in range(0, 250, 7)] + [(2000, "Alone"), (2001, "alone\n"), (2002, ""), (2003, None), (2004, " ")]
    got = minhash.near_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    rows = sorted(map(tuple, got.collect()))
    want = plain_rows(docs)
    assert rows == want
    assert len({r[2] for r in want}) < 240


@pytest.mark.parametrize("block", [4096, 20])
def test_hub_without_links_loses_none(spark, monkeypatch, block):
    """Few large buckets: most hubs link to nothing, and the rest is found across components."""
    monkeypatch.setattr(minhash.near_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash.Signer, "buckets", lambda self, hashes: np.array([int(hashes[0]) % 2, 7, 8]) if len(hashes) else np.empty(0, np.int64))
    random = np.random.default_rng(3)
    docs = list(enumerate(near_texts(random, 60, 40)))
    got = minhash.near_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == plain_rows(docs)


@pytest.mark.parametrize("size", [1, 5, 40, 150, 600, 9000])
def test_sketches_leave_out_no_pair_at_the_limit(size):
    random = np.random.default_rng(size)
    for _ in range(1500):
        values = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        part = np.sort(random.permutation(values)[: max(1, -(-len(values) * 4 // 5))])
        one, other = (np.frombuffer(minhash.sketch_of(x), np.uint8) for x in (values, part))
        assert minhash.may_be_alike(one, other[None, :], len(values), np.array([len(part)]), 80)[0]
    far = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
    if size >= 40:
        less = np.sort(far[: size * 6 // 10])
        one, other = (np.frombuffer(minhash.sketch_of(x), np.uint8) for x in (less, far))
        assert not minhash.may_be_alike(one, other[None, :], len(less), np.array([len(far)]), 80)[0]


@pytest.mark.parametrize("size", [1, 5, 150, 1024, 1300, 9000])
def test_short_hashes(size):
    """Exact for small sets; for large ones no pair at the limit is left out, also where the two ranges differ."""
    random = np.random.default_rng(size)
    for share in (1.0, 0.9, 0.8, 0.75, 0.5):
        for _ in range(100):
            values = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            part = np.sort(random.permutation(values)[: max(1, int(np.ceil(len(values) * share)))])
            alike = 100 * len(part) >= 80 * len(values)
            got = minhash.still_alike(*minhash.short_hashes(values), *minhash.short_hashes(part), 80)
            assert got == minhash.still_alike(*minhash.short_hashes(part), *minhash.short_hashes(values), 80)
            if alike or len(values) <= minhash.SHORT:
                assert got == alike
            if share == 0.5:
                assert not got or size == 1
            assert len(minhash.short_hashes(values)[1]) <= 4 * minhash.SHORT


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_minhash"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == plain_rows([(d["doc_id"], d["text"]) for d in docs])


def test_messy(messy, no_docs):
    got = minhash.near_components(messy).collect()
    assert len(got) == messy.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert by_id[0] == [(10, 0, True)] * 2 and by_id[50] == [(10, 0, False)]
    assert by_id[100] == [(0, 100, True)] and by_id[150] == [(0, 150, True)] and by_id[250] == [(0, 250, True)]
    assert sorted(by_id[None]) == [(0, None, False), (8, None, False)] and by_id[200] == [(3, 200, True)]
    assert minhash.near_components(no_docs).count() == 0
