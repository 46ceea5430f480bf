from __future__ import annotations

import time
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starloom.llm import pieces
from starloom.llm.queries import QUERIES

VOCABULARY = pieces.Vocabulary.load()


def applied(result):
    """The N best as (score, ids)."""
    out = [(result["score"], result["ids"].tolist())]
    for other in result["alternatives"]:
        ids = result["ids"].tolist()
        for change in reversed(other["changes"]):
            ids[change["at"] : change["at"] + change["removed"]] = change["ids"]
        out.append((other["score"], ids))
    return out


def every_path(encoder, text):
    word = " " + text
    reach, shown = encoder.reach(word), encoder.shown(word)
    edges, paths = [[] for _ in word], [[] for _ in range(len(word) + 1)]
    for end in range(1, len(word) + 1):
        for _, i, score, ids in encoder.into(word, shown, end, reach):
            edges[i].append((end, score, ids))
    paths[0] = [(0.0, ())]
    for i, found in enumerate(edges):
        for (score, ids), (j, more, piece) in product(paths[i], found):
            paths[j].append((score + more, ids + piece))
    return paths[-1]


@given(st.text(alphabet="the an\n▁é日", max_size=9))
@settings(max_examples=150, deadline=None)
def test_best_paths_are_those_of_all_paths(text):
    encoder = pieces.Encoder(VOCABULARY, 4)
    got = applied(encoder.encode(text))
    if not text:
        assert got == [(0.0, [])]
        return
    paths = sorted((-s for s, _ in every_path(encoder, text)))[:4]
    assert [-s for s, _ in got] == pytest.approx(paths)
    assert len({tuple(ids) for _, ids in got}) == len(got)
    assert {(round(s, 6), tuple(ids)) for s, ids in got} <= {(round(s, 6), ids) for s, ids in every_path(encoder, text)}


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_round_trip(text):
    encoder = pieces.Encoder(VOCABULARY)
    result = encoder.encode(text)
    assert result["round_trip"]
    assert all(encoder.decode(ids) == text for _, ids in applied(result) if text)


def test_forgetting_changes_nothing(monkeypatch):
    whole = pieces.Encoder(VOCABULARY).encode("some words that go on and on")
    monkeypatch.setattr(pieces, "REMEMBERED", 1)
    small = pieces.Encoder(VOCABULARY)
    small.encode("other words before")
    again = small.encode("some words that go on and on")
    assert again["ids"].tolist() == whole["ids"].tolist() and again["alternatives"] == whole["alternatives"]


def test_query(spark, sf_dir):
    rows = QUERIES["op2_sentence_pieces"](spark, sf_dir)
    text = pieces.decoded(rows, "ids", VOCABULARY)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = rows.select("doc_id", "round_trip", "n_pieces", "ids", text.alias("back")).join(docs, "doc_id")
    assert back.count() == docs.count()
    assert back.where("back <> text OR NOT round_trip OR n_pieces <> size(ids)").count() == 0


def test_messy(spark, messy, no_docs):
    rows = pieces.segmented(messy).collect()
    assert len(rows) == messy.count() and all(r["round_trip"] for r in rows)
    assert sum(r["n_pieces"] == 0 for r in rows) == 3
    assert pieces.segmented(no_docs).count() == 0


@pytest.mark.parametrize("word", ["a" * 100_000, "ab" * 50_000, "itwasthebestoftimesitwastheworstoftimes" * 2_000, "▁" * 50_000])
def test_very_long_words(word):
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    start = time.perf_counter()
    got = encoder.encode(f"x {word} y")
    assert time.perf_counter() - start < 20
    assert got["round_trip"] and encoder.decode(got["ids"]) == f"x {word} y"
    scores = [got["score"], *(a["score"] for a in got["alternatives"])]
    assert len(scores) == pieces.BEST and scores == sorted(scores, reverse=True)
    for a in got["alternatives"]:
        ids = got["ids"].tolist()
        for change in sorted(a["changes"], key=lambda c: -c["at"]):
            ids[change["at"] : change["at"] + change["removed"]] = change["ids"]
        assert encoder.decode(ids) == f"x {word} y" and ids != got["ids"].tolist()


def test_words_are_forgotten_by_their_length(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_CHARACTERS", 1000)
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    encoder.encode("z" * 2000)
    encoder.encode("short")
    assert len(encoder.words) == 1


def test_one_query_at_a_time_is_remembered(monkeypatch):
    monkeypatch.setattr(pieces, "_ENCODERS", {})

    class Shared:
        @property
        def value(self):
            assert not pieces._ENCODERS  # the other query's tables are gone before these are read
            return VOCABULARY

    first, second = Shared(), Shared()
    known = pieces._encoder(first, 3)
    assert pieces._encoder(first, 3) is known
    assert pieces._encoder(second, 3) is not known and len(pieces._ENCODERS) == 1


def test_what_a_worker_holds():
    assert VOCABULARY.nodes().step.nbytes < 25_000_000
    encoder = pieces.Encoder(VOCABULARY)
    encoder.encode(" ".join(map("".join, product("aeioubcd", repeat=5))))
    tables = encoder.score, encoder.loss, encoder.start, encoder.count, encoder.paths
    assert sum(t.nbytes for t in tables) < 100 * len(encoder.words) and len(encoder.words) == 8**5


def test_words_of_all_lengths_are_learned_together(monkeypatch):
    words = sorted({w[:n] for w in (" international", " 1,234.56", " été", " xqzjv", "   ", " of日本") for n in range(1, len(w) + 1)})
    alone, together = pieces.Encoder(VOCABULARY), pieces.Encoder(VOCABULARY)
    for word in words:
        alone._learn(word)
    calls, arrive = [], pieces.Encoder._arrive
    monkeypatch.setattr(pieces.Encoder, "_arrive", staticmethod(lambda *args: calls.append(1) or arrive(*args)))
    together.learn(words)
    longest = max(map(len, words))
    assert 0 < len(calls) <= longest * (longest + 1) // 2 + 2 * longest
    for word in words:
        a, b = alone.words[word], together.words[word]
        assert together.path(word).tolist() == alone.path(word).tolist()
        assert (together.score[b], together.loss[b]) == (alone.score[a], alone.loss[a])


def test_several_texts_at_once():
    several = ["", "one", "", "two words", "no▁mark", "� é日", "", "x" * 70]
    encoder = pieces.Encoder(VOCABULARY)
    for text, got in zip(several, encoder.encode_all(several)):
        want = pieces.Encoder(VOCABULARY).encode(text)
        assert got["ids"].tolist() == want["ids"].tolist() and got["alternatives"] == want["alternatives"]
        assert got["score"] == want["score"] and got["round_trip"] and encoder.decode(got["ids"]) == text
    assert encoder.encode_all([]) == []
