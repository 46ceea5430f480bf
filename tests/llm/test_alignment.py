from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import alignment
from starloom.llm.queries import QUERIES
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(alignment.FIRST_PATH)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND_PATH)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair()


def plain_tokens(libraries, text):
    """(id, end) of both tokenizers' tokens."""
    first, second = libraries
    letters = alignment.byte_letters()
    a, b, at = [], [], 0
    for i in first.encode(" " + text, add_special_tokens=False).ids:
        at += len([letters[c] for c in first.id_to_token(i)])
        a.append((i, at))
    at = 0
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        at += 1 if second.is_byte(i) else len(piece.replace("▁", " ").encode())
        b.append((i, at))
    return (a, b) if a and b and a[-1][1] == b[-1][1] == len(f" {text}".encode()) else ([], [])


def plain_groups(a, b):
    common = sorted({e for _, e in a} & {e for _, e in b})
    groups, start = [], 0
    for end in common:
        sides = (",".join(str(i) for i, e in side if start < e <= end) for side in (a, b))
        groups.append("|".join(sides))
        start = end
    links = [(x, y) for x, e in a for y, f in b if e == f]
    return links, groups


def plain_rows(libraries, docs):
    cut = [(key, *plain_tokens(libraries, text or "")) if text and "▁" not in text else (key, [], []) for key, text in docs]
    found = [(key, a, b, *plain_groups(a, b)) for key, a, b in cut]
    counts = Counter(link for row in found for link in row[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (
            key,
            len(a),
            len(b),
            len(groups),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            len(links),
            sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links),
        )
        for key, a, b, links, groups in found
    ]


TEXTS = ["", " ", "a  b", "Hello, world! <|endoftext|> <s> </s> <unk> <0x0A>", "日本語 и текст\n\n\ttabs", "é   ​ 🙂🙂", "x" * 300, "no▁mark"]


@given(st.one_of(st.sampled_from(TEXTS), st.text(max_size=40), st.text(alphabet="aeé 'st \n1<|>", max_size=60)))
@settings(max_examples=200, deadline=None)
def test_groups(libraries, pair, text):
    a, b = pair.encoded(text)
    want_a, want_b = plain_tokens(libraries, text)
    if "▁" in text:
        want_a, want_b = [], []
    if len(a) or want_a:
        assert [i for i, _ in want_a] == a.tolist() and [i for i, _ in want_b] == b.tolist()
    links, n, written = pair.groups(a, b)
    want_links, groups = plain_groups(want_a, want_b)
    assert written == ";".join(groups) and n == len(groups)
    assert links.tolist() == [y << alignment.SHIFT | x for x, y in want_links]
    n_a, n_b, n, written, links = pair.aligned(text)
    assert (n_a, n_b, n, written) == (len(want_a), len(want_b), len(groups), ";".join(groups))
    assert links.tolist() == [y << alignment.SHIFT | x for x, y in want_links]


@pytest.mark.parametrize("character", ["a", " ", "é", "語"])
def test_very_long_words(pair, character):
    a, b = pair.encoded(character * 100_000)
    links, n, written = pair.groups(a, b)
    assert len(links) == n == written.count(";") + 1


def test_links_of_tokens_without_bytes():
    got = alignment.links_of(np.array([1, 2, 3]), np.array([0, 0, 2]), np.array([7, 8, 9]), np.array([0, 0, 2]))
    assert [(x & 0xFFFFF, x >> alignment.SHIFT) for x in got.tolist()] == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 9)]


def test_runs_merge_in_order(monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 5)
    random, records, runs = np.random.default_rng(1), Counter(), []
    for _ in range(6):
        pairs, rows = random.integers(0, 9, 40), random.integers(0, 5, 40)
        for p, r in zip(pairs.tolist(), rows.tolist()):
            records[p, r] += 1
        runs += alignment.runs_of([(pairs, rows)], 1)["run"]
    seen, order = Counter(), []
    for p, head, at in alignment.merged(runs):
        order.append(p)
        part = slice(head.starts[at], head.starts[at + 1])
        assert head.sums[at] == head.times[part].sum()
        for r, n in zip(head.rows[part].tolist(), head.times[part].tolist()):
            seen[p, r] += n
    assert order == sorted(order) and seen == records


@pytest.mark.parametrize("most", [alignment.SLICE_RECORDS, 7])
def test_counts(spark, libraries, most, monkeypatch):
    """Small runs, and sides whose records fill many slices."""
    monkeypatch.setattr(alignment, "HELD", 11)
    random = np.random.default_rng(most)
    words = ["the", "a", "Cat", "über", "token", "tokens", ",", "\n", "zzqx"]
    docs = [(i, " ".join(random.choice(words, int(random.integers(0, 30))))) for i in range(80)] + [(7, "the the"), (None, "the"), (81, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = alignment.with_counts(alignment.aligned(frame), "doc_id", "n_a", "n_b", "n_groups", "groups", most=most).collect()
    key = lambda r: (r[0] is None, r)
    rows = [(r[0], r[1], r[2], r[3], hashlib.sha256(r[4].encode()).hexdigest() if r[4] else "", *r[5:]) for r in map(tuple, got)]
    assert sorted(rows, key=key) == sorted(plain_rows(libraries, docs), key=key)


def test_query(spark, sf_dir, libraries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_alignment"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_rows(libraries, [(d["doc_id"], d["text"]) for d in docs]))


def test_messy(messy, no_docs):
    got = alignment.with_counts(alignment.aligned(messy), "doc_id", "n_a", "groups").collect()
    assert len(got) == messy.count()
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["n_a"] == 0 and by_id[i]["groups"] == "" and by_id[i]["count_sum"] == 0 for i in (100, 150, 300))
    assert by_id[200]["n_a"] > 100_000
    assert alignment.with_counts(alignment.aligned(no_docs), "doc_id").count() == 0


def test_several_texts_at_once(libraries, pair, monkeypatch):
    calls, links_of = [], alignment.links_of
    monkeypatch.setattr(alignment, "links_of", lambda *args: calls.append(1) or links_of(*args))
    several = ["", *TEXTS, "", "the cat's 1,234 hats", "no▁mark either", " \n x"]
    links, found = pair.aligned_all(several)
    assert len(calls) == 1
    at, written = 0, found["groups"].to_pylist()
    for k, text in enumerate(several):
        a, b = plain_tokens(libraries, text) if "▁" not in text else ([], [])
        want, groups = plain_groups(a, b)
        assert [found[c][k] for c in ("n_a", "n_b", "n_groups", "n_links")] == [len(a), len(b), len(groups), len(want)]
        assert written[k] == ";".join(groups)
        assert links[at : at + len(want)].tolist() == [y << alignment.SHIFT | x for x, y in want]
        at += len(want)
    assert at == len(links)
    links, found = pair.aligned_all(["", "no▁mark"])
    assert len(links) == 0 and found["groups"].to_pylist() == ["", ""] and found["n_links"].tolist() == [0, 0]


def test_several_texts_with_tokens_without_bytes():
    pair = object.__new__(alignment.Pair)
    spelled = [b"a", b"bc", b""]
    pair.a = pair.b = alignment.Tokens(spelled)
    kinds = ",", "|", ",", ";", ""
    pair.starts = np.arange(0, 16, 3)
    pair.written = alignment.pa.array([f"{i}{end}".encode() for end in kinds for i in range(3)], alignment.pa.large_binary())
    texts = [([0, 2, 1], [0, 2, 2, 1]), ([], []), ([1, 2], [1, 2, 2]), ([0, 0], [0, 2, 0])]
    a, b = (np.array([i for text in texts for i in text[side]]) for side in (0, 1))
    sizes = (np.array([len(text[side]) for text in texts]) for side in (0, 1))
    links, n_groups, n_links, written = pair.groups_all(a, b, *sizes)
    want = [plain_groups(*(list(zip(ids, np.cumsum([len(spelled[i]) for i in ids]).tolist())) for ids in text)) for text in texts]
    assert links.tolist() == [y << alignment.SHIFT | x for found, _ in want for x, y in found]
    assert n_links.tolist() == [len(found) for found, _ in want] and n_groups.tolist() == [len(groups) for _, groups in want]
    assert written.to_pylist() == [";".join(groups) for _, groups in want]
