"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. Where no child fits, the link leads to the
state for what is left after the longest matches, and the number of pieces popped on the way is
precomputed per node; so a word is counted in one pass over its bytes, and no piece is ever built.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import slices, texts

VOCABULARY_PATH = "/opt/tokenizers/word_bpe_49k.json"
#: Words a Python worker remembers over its tasks; it forgets all when there are more.
REMEMBERED = 150_000
#: Byte that stands for the end of a word; UTF-8 never holds it.
END = 0xFF
#: Fixed value: how the vocabulary's own tokenizer cuts normalised text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_CUT = regex.compile(WORDS)


@dataclass
class Automaton:
    """Transitions by ``node << 8 | byte``; per node the failure link (-1: none) and the pieces popped with it.

    Node 0 starts a word and node 1 goes on in one; they are one node where pieces have no
    continuation form.
    """

    step: dict[int, int]
    link: list[int]
    popped: list[int]
    inner: int

    @classmethod
    def build(cls, starting: Iterable[bytes], going_on: Iterable[bytes] | None = None) -> Automaton:
        """From pieces at a word's start and after it; ``None``: the same pieces serve both."""
        inner = 0 if going_on is None else 1
        step: dict[int, int] = {}
        last = [False] * (inner + 1)
        for root, pieces in ((0, starting), (1, going_on or ())):
            for piece in pieces:
                node = root
                for byte in piece:
                    after = step.get(node << 8 | byte)
                    if after is None:
                        after = step[node << 8 | byte] = len(last)
                        last.append(False)
                    node = after
                if piece:
                    last[node] = True
        children: list[list[tuple[int, int]]] = [[] for _ in last]
        for key, node in step.items():
            children[key >> 8].append((key & 255, node))
        link, popped = [-1] * len(last), [0] * len(last)
        todo = deque(range(inner + 1))
        while todo:
            parent = todo.popleft()
            for byte, node in children[parent]:
                todo.append(node)
                if last[node]:
                    link[node], popped[node] = inner, 1
                    continue
                back, count = link[parent], popped[parent]
                while back >= 0 and (back << 8 | byte) not in step:
                    count += popped[back]
                    back = link[back]
                if back >= 0:
                    link[node], popped[node] = step[back << 8 | byte], count
        return cls(step, link, popped, inner)

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; a word that can't be matched to its end counts as one unknown piece."""
        step, link, popped = self.step, self.link, self.popped
        node = total = 0
        for byte in word:
            while (after := step.get(node << 8 | byte)) is None:
                back = link[node]
                if back < 0:
                    return 1
                total += popped[node]
                node = back
            node = after
        while node != self.inner:
            back = link[node]
            if back < 0:
                return 1 if word else 0
            total += popped[node]
            node = back
        return total


def _byte_of() -> dict[str, int]:
    """Bytes by the printable characters that byte-level vocabularies write them with."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_pieces(path: str = VOCABULARY_PATH) -> list[bytes]:
    """Pieces of a byte-level vocabulary with word-end marks, as bytes; special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec["added_tokens"]}
    mark, byte_of = spec["model"]["end_of_word_suffix"] or "", _byte_of()
    pieces = []
    for token in spec["model"]["vocab"]:
        if token not in special:
            ends = bool(mark) and token.endswith(mark)
            body = token[: -len(mark)] if ends else token
            pieces.append(bytes(byte_of[c] for c in body) + bytes([END] * ends))
    return pieces


def words_of(text: str) -> list[str]:
    """Words of a text as the vocabulary's tokenizer cuts them: composed characters, lower case."""
    return _CUT.findall(unicodedata.normalize("NFC", text).lower())


class _Counts(dict):
    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        self[word] = n = self.automaton.count(word.encode() + bytes([END]))
        return n


_KNOWN: dict[str, _Counts] = {}


def counts(docs: DataFrame, automaton: Automaton) -> Column:
    """``docs.text`` as a struct of its words and pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    @arrow_udf("struct<n_words:long,n_pieces:long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _KNOWN.get("counts")
        if known is None or known.automaton is not shared.value:
            known = _KNOWN["counts"] = _Counts(shared.value)
        for part in slices(batches):
            words, pieces = [], []
            for text in texts(part):
                if len(known) > REMEMBERED:
                    known.clear()
                found = words_of(text)
                words.append(len(found))
                pieces.append(sum(map(known.__getitem__, found)))
            yield pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(pieces, pa.int64())], names=["n_words", "n_pieces"])

    return run(docs["text"])


def counted(docs: DataFrame, path: str = VOCABULARY_PATH) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_pieces`` for every row of ``docs``.

    Null and empty texts have none. Repeated rows and null ids are kept, other columns are
    not read; empty table: no rows. The vocabulary is read on the driver and broadcast.
    """
    rows = docs.select("doc_id", "text")
    return rows.select("doc_id", counts(rows, Automaton.build(load_pieces(path))).alias("c")).select("doc_id", "c.n_words", "c.n_pieces")
