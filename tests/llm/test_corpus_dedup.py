from __future__ import annotations

import numpy as np
import pytest
from starloom.llm import minhash, near_dedup
from starloom.llm.common import table
from starloom.llm.corpus_dedup import keep_one_of_each


def shingles(text, words=5):
    parts = text.lower().split()
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))}


def alike(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def kept_by_brute_force(texts):
    """Smallest id of each component of all pairs whose sets of five-word shingles are alike by 0.8 or more."""
    ids = sorted(texts)
    sets = [shingles(texts[i]) for i in ids]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if 10 * min(len(sets[i]), len(sets[j])) >= 8 * max(len(sets[i]), len(sets[j])) and find(i) != find(j):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return sorted({ids[find(i)] for i in range(len(ids))})


def sample(random, n):
    return [f"w{random.integers(400)}" for _ in range(n)]


@pytest.mark.parametrize("size", [8, 12, 24, 200, 1000])
def test_copies_above_the_limit_go_and_others_stay(spark, size):
    """Pairs on both sides of the limit at any length, all against exact similarity."""
    random = np.random.default_rng(size)
    texts, above, below = {}, 0, 0
    for group in range(60):
        words = sample(random, size)
        texts[10 * group] = " ".join(words)
        for copy in range(1, 4):
            edited = list(words)
            if random.random() < 0.5:
                edited += sample(random, int(random.integers(1, max(2, size // 3))))
            else:
                for at in random.choice(size, max(1, size // int(random.integers(20, 90))), replace=False):
                    edited[at] = "new" + str(random.integers(10**6))
            texts[10 * group + copy] = " ".join(edited)
            share = alike(texts[10 * group + copy], texts[10 * group])
            above, below = above + (0.8 <= share < 1), below + (0.5 <= share < 0.8)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in keep_one_of_each(docs).collect())
    assert kept == kept_by_brute_force(texts)
    assert above >= 5 and below >= 5


def test_a_large_group(spark, monkeypatch):
    """Near copies of one text, in blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    monkeypatch.setattr(minhash, "BLOCK", 20)
    random = np.random.default_rng(3)
    words, texts = sample(random, 150), {}
    for i in range(150):
        edited = list(words)
        edited[random.integers(150)] = f"new{i}"
        texts[i] = " ".join(edited)
    texts |= {i: " ".join(sample(random, 40)) for i in range(200, 260)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in keep_one_of_each(docs).collect())
    assert kept == kept_by_brute_force(texts) == [0, *range(200, 260)]


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    kept = sorted(r["doc_id"] for r in keep_one_of_each(docs).collect())
    assert kept == kept_by_brute_force({r["doc_id"]: r["text"] for r in docs.collect()})


def test_messy(messy, no_docs):
    kept = keep_one_of_each(messy)
    assert kept.columns == messy.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [0, 100, 200, 300, 350]
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["words without any id at all but with text"]
    assert keep_one_of_each(no_docs).count() == 0
