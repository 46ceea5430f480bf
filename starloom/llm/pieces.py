"""SentencePiece encoding with the N best segmentations, and decoding.

No piece holds a space after another character, and some characters (line ends, say) are in no
longer piece, so the piece lattice of a text falls apart into one lattice per word. Each has a
forward Viterbi pass; its scores are the exact heuristic of a backward A-star search that
yields segmentations best first. A text's N best differ from its best only in the N - 1 words
whose runner-up costs least, so A-star runs for those alone.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from itertools import chain, compress, product
from math import inf

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from starloom.llm.common import short, slices, texts

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 3
#: Words a Python worker remembers over its tasks, and their characters; it forgets all when there are more.
REMEMBERED = 150_000
REMEMBERED_CHARACTERS = 4_000_000
#: Characters that words learned together may hold; the table has a row of so many numbers per prefix.
COMMON_CHARACTERS = 192
LONGEST = 64
LEARNED_AT_ONCE = 4096
#: Bytes of texts that are encoded together.
AT_ONCE = 1 << 20
#: The mark for a space inside pieces.
MARK = "▁"
#: What a character without a piece costs below the worst piece, as in the unigram model.
UNKNOWN_PENALTY = 10.0

_PATH = pa.struct([("score", pa.float64()), ("changes", pa.list_(pa.struct([("at", pa.int32()), ("removed", pa.int32()), ("ids", pa.list_(pa.int32()))])))])
SCHEMA = "struct<ids:array<int>,score:double,round_trip:boolean,alternatives:array<struct<score:double,changes:array<struct<at:int,removed:int,ids:array<int>>>>>>"


@dataclass
class Vocabulary:
    """Pieces as a prefix table: a prefix of a piece maps to None, a piece to (id, score)."""

    table: dict[str, tuple[int, float] | None]
    octets: list[bytes]
    byte_ids: list[int]
    alone: str

    def nodes(self) -> Nodes:
        """Built once per worker and not sent."""
        if "_nodes" not in self.__dict__:
            self._nodes = Nodes.build(self.table)
        return self._nodes

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        """Read on the driver; the tables travel to the tasks as a broadcast of a few MB."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        table: dict[str, tuple[int, float] | None] = {}
        byte_ids, octets = [0] * 256, [b""] * len(ids)
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                octets[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"a piece holds a space after another character: {piece!r}")
                for end in range(1, len(piece)):
                    table.setdefault(piece[:end])
                table[piece] = (i, model.get_score(i))
                octets[i] = piece.replace(MARK, " ").encode()
        longer = set("".join(p for p in table if len(p) > 1))
        alone = "".join(c for c in map(chr, range(128)) if c not in longer and c != " ")
        return cls(table, octets, byte_ids, alone)


@dataclass
class Nodes:
    """The prefix table as an array: next node by node and kind of character (0: none), piece id by node, score by id."""

    kind_of: np.ndarray
    step: np.ndarray
    piece: np.ndarray
    score: np.ndarray

    @classmethod
    def build(cls, table: dict[str, tuple[int, float] | None], kinds: int = COMMON_CHARACTERS) -> Nodes:
        """Characters in most prefixes get a kind of their own; a word with another one is learned by itself."""
        used = Counter(chain.from_iterable(table))
        kind_of = np.zeros(1 << 16, np.uint8)
        for kind, (char, _) in enumerate(sorted(used.items(), key=lambda x: (-x[1], x[0]))[: kinds - 1], 1):
            if ord(char) < len(kind_of) - 1:
                kind_of[ord(char)] = kind
        number = {"": 0} | {prefix: i for i, prefix in enumerate(table, 1)}
        step = np.zeros((len(number), kinds), np.uint16 if len(number) <= 1 << 16 else np.int32)
        piece = np.full(len(number), -1, np.int32)
        score = np.zeros(1 + max((e[0] for e in table.values() if e), default=0))
        for prefix, entry in table.items():
            kind = kind_of[ord(prefix[-1])] if ord(prefix[-1]) < len(kind_of) else 0
            if kind:
                step[number[prefix[:-1]], kind] = number[prefix]
            if entry:
                piece[number[prefix]], score[entry[0]] = entry
        return cls(kind_of, step, piece, score)


@dataclass
class Encoder:
    """Words met so far with their best segmentation, its score and the loss of the runner-up."""

    vocabulary: Vocabulary
    best: int = BEST
    words: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        scores = [s for entry in self.vocabulary.table.values() if entry for s in entry[1:]]
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.vocabulary.table), default=1)
        alone = re.escape(self.vocabulary.alone)
        self.cut = re.compile(f"[{alone}]| *[^ {alone}]+| +" if alone else " *[^ ]+| +")
        self.spelled = pa.array(self.vocabulary.octets, pa.large_binary())
        self.forget()

    def forget(self) -> None:
        self.words, self.nbest_of = {}, {}
        #: Per word: its score, the runner-up's loss, and where the ids of its path begin and how many there are.
        self.score, self.loss, self.start, self.count = np.empty(1024), np.empty(1024), np.empty(1024, np.int64), np.empty(1024, np.int64)
        self.paths, self.written = np.empty(4096, np.int32), 0
        self.characters = 0

    def path(self, word: str) -> np.ndarray:
        """Ids of a known word's best path."""
        place = self.words[word]
        return self.paths[self.start[place] : self.start[place] + self.count[place]]

    def shown(self, word: str) -> str:
        """The word as pieces are written. A mark that stands in the text itself is spelled in bytes."""
        return word.replace(MARK, "\0").replace(" ", MARK)

    def reach(self, word: str) -> array:
        """Best score of a path from the start to each position."""
        table, size, shown = self.vocabulary.table, len(word), self.shown(word)
        best = array("d", [-inf]) * (size + 1)
        best[0] = 0.0
        for i in range(size):
            base, single = best[i], False
            for j in range(i + 1, size + 1):
                entry = table.get(shown[i:j], False)
                if entry is False:
                    break
                if entry:
                    single |= j == i + 1
                    best[j] = max(best[j], base + entry[1])
            if not single:
                best[i + 1] = max(best[i + 1], base + self.unknown)
        return best

    def into(self, word: str, shown: str, end: int, reach: array) -> list[tuple[float, int, float, tuple[int, ...]]]:
        """(score of the best path over it, start, score, ids) of the pieces that end at a position, best first."""
        table, found = self.vocabulary.table, []
        for i in range(max(0, end - self.longest), end):
            if entry := table.get(shown[i:end]):
                found.append((reach[i] + entry[1], i, entry[1], (entry[0],)))
        if not table.get(shown[end - 1 : end]):
            ids = tuple(self.vocabulary.byte_ids[b] for b in word[end - 1].encode())
            found.append((reach[end - 1] + self.unknown, end - 1, self.unknown, ids))
        return sorted(found, key=lambda e: (-e[0], -e[1]))

    def _learn(self, word: str) -> None:
        """Forward Viterbi with the two best scores per position: the best path and the loss of the runner-up."""
        table, size = self.vocabulary.table, len(word)
        shown = (word.replace(MARK, "\0") if MARK in word else word).replace(" ", MARK)
        best, second = [0.0] + [-inf] * size, [-inf] * (size + 1)
        came: list = [None] * (size + 1)
        for i in range(size):
            first, runner, single = best[i], second[i], False
            for j in range(i + 1, size + 1):
                entry = table.get(shown[i:j], False)
                if entry is None:
                    continue
                if entry is False:
                    break
                single |= j == i + 1
                score = first + entry[1]
                if score > best[j]:
                    second[j] = max(best[j], runner + entry[1])
                    best[j], came[j] = score, (i, entry[0])
                elif score > second[j]:
                    second[j] = score
            if not single:
                j, score = i + 1, first + self.unknown
                if score > best[j]:
                    second[j] = max(best[j], runner + self.unknown)
                    best[j], came[j] = score, (i, None)
                elif score > second[j]:
                    second[j] = score
        ids: list[int] = []
        at = size
        while at:
            start, piece = came[at]
            if piece is None:
                ids.extend(self.vocabulary.byte_ids[b] for b in reversed(word[start].encode()))
            else:
                ids.append(piece)
            at = start
        ids.reverse()
        self._keep([word], np.array(ids, np.int32), np.array([len(ids)]), best[size], best[size] - second[size])

    def _keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray, scores, losses) -> None:
        """Remember new words and their paths, one path after another in ``ids``."""
        first = len(self.words)
        self.score, self.loss, self.start, self.count = (_room(x, first + len(words)) for x in (self.score, self.loss, self.start, self.count))
        self.paths = _room(self.paths, self.written + len(ids))
        rows = slice(first, first + len(words))
        self.score[rows], self.loss[rows], self.count[rows] = scores, losses, counts
        self.start[rows] = self.written + np.cumsum(counts) - counts
        self.paths[self.written : self.written + len(ids)] = ids
        self.written += len(ids)
        self.words.update(zip(words, range(first, first + len(words))))

    def learn(self, words: Iterable[str]) -> None:
        """``_learn`` for many new words at once: they advance together, a character at a time."""
        nodes, together = self.vocabulary.nodes(), []
        for word in words:
            if MARK in word or len(word) > LONGEST:
                self._learn(word)
            else:
                together.append(word)
        together.sort(key=len, reverse=True)
        for at in range(0, len(together), LEARNED_AT_ONCE):
            self._learn_together(together[at : at + LEARNED_AT_ONCE], nodes)

    def _learn_together(self, words: list[str], nodes: Nodes) -> None:
        """For words in falling order of length; a position is reached by the first of them."""
        sizes = np.array(list(map(len, words)))
        shown = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        kind = nodes.kind_of[np.minimum(shown, len(nodes.kind_of) - 1)]
        common = np.minimum.reduceat(kind, np.cumsum(sizes) - sizes) > 0
        if not common.all():
            for k in np.flatnonzero(~common):
                self._learn(words[k])  # rare characters: by itself
            kind, words, sizes = kind[np.repeat(common, sizes)], list(compress(words, common.tolist())), sizes[common]
        if not words:
            return
        longest, n, every = int(sizes[0]), len(words), np.arange(len(words))
        kinds = np.zeros((longest, n), np.intp)
        kinds.T[np.arange(longest) < sizes[:, None]] = kind
        best, second = np.full((longest + 1, n), -inf), np.full((longest + 1, n), -inf)
        start, piece = np.zeros((longest + 1, n), np.int32), np.zeros((longest + 1, n), np.int32)
        best[0] = 0.0
        for i in range(longest):
            rows = every[: np.searchsorted(-sizes, -i)]
            node = np.zeros(len(rows), np.intp)
            for j in range(i + 1, longest + 1):
                node = nodes.step[node, kinds[j - 1, rows]]
                if not (alive := node > 0).all():
                    if j == i + 1:
                        self._arrive(best, second, start, piece, i, j, rows[~alive], self.unknown, -1)
                    rows, node = rows[alive], node[alive]
                    if not len(rows):
                        break
                ids = nodes.piece[node]
                whole = ids >= 0
                if j == i + 1 and not whole.all():
                    self._arrive(best, second, start, piece, i, j, rows[~whole], self.unknown, -1)
                ids = ids[whole]
                if len(ids):
                    self._arrive(best, second, start, piece, i, j, rows[whole], nodes.score[ids], ids)
        steps, at = [], sizes.copy()
        while at.any():
            steps.append(np.where(at > 0, piece[at, every], -2))
            unknown = np.flatnonzero(steps[-1] == -1)
            at = np.where(at > 0, start[at, every], 0)
            steps[-1][unknown] = -10 - at[unknown]  # the place of a character that is spelled in bytes
        score, paths = best[sizes, every], np.array(steps[::-1]).T
        loss, plain = score - second[sizes, every], (paths > -10).all(axis=1)
        for k in np.flatnonzero(~plain):
            ids = chain.from_iterable([x] if x >= 0 else map(self.vocabulary.byte_ids.__getitem__, words[k][-10 - x].encode()) for x in paths[k].tolist() if x != -2)
            ids = np.fromiter(ids, np.int32)
            self._keep([words[k]], ids, np.array([len(ids)]), score[k], loss[k])
        used = paths[plain] >= 0
        self._keep(list(compress(words, plain.tolist())), paths[plain][used], used.sum(axis=1), score[plain], loss[plain])

    @staticmethod
    def _arrive(best, second, start, piece, i, j, rows, score, ids) -> None:
        """Offer position ``j`` the paths that come from ``i`` by one piece."""
        total, now = best[i, rows] + score, best[j, rows]
        better = total > now
        runner = second[i, rows] + score
        second[j, rows] = np.where(better, np.maximum(now, runner), np.maximum(second[j, rows], total))
        best[j, rows] = np.where(better, total, now)
        start[j, rows] = np.where(better, i, start[j, rows])
        piece[j, rows] = np.where(better, ids, piece[j, rows])

    def nbest(self, word: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best (score, ids) of a word by A-star from its end; the first is the Viterbi path.

        An entry of the heap stands for a path's last pieces and the k-th best piece before them. It points back at the piece
        behind it, so an entry has a fixed size, and leaves the (k + 1)-th piece to one further entry. Of equal scores the
        latest entry goes on, so that ties do not widen the search.
        """
        if (known := self.nbest_of.get(word)) is not None:
            return known
        reach, shown = self.reach(word), self.shown(word)
        before: dict[int, list] = {}
        heap: list = []
        count = 0

        def offer(at: int, k: int, behind: float, tail: tuple | None) -> None:
            nonlocal count
            if at not in before:
                before[at] = self.into(word, shown, at, reach)
            if k < len(before[at]):
                count += 1
                heappush(heap, (-(before[at][k][0] + behind), -count, at, k, behind, tail))

        out: list[tuple[float, tuple[int, ...]]] = []
        offer(len(word), 0, 0.0, None)
        while heap and len(out) < self.best + 1:
            _, _, at, k, behind, tail = heappop(heap)
            _, i, score, ids = before[at][k]
            offer(at, k + 1, behind, tail)
            if i:
                offer(i, 0, score + behind, (ids, tail))
                continue
            path, tail = [], (ids, tail)
            while tail:
                path.extend(tail[0])
                tail = tail[1]
            out.append((score + behind, tuple(path)))
        first = tuple(self.path(word).tolist())
        rest = [x for x in out if x[1] != first][: self.best - 1]
        self.nbest_of[word] = known = [(float(self.score[self.words[word]]), first), *rest]
        return known

    def encode(self, text: str) -> dict:
        """Best ids and score, the alternatives as changes to them, and whether all decode to the text."""
        return self.encode_all([text])[0]

    def encode_all(self, several: list[str]) -> list[dict]:
        """``encode`` for a few texts, whose new words are learned together."""
        if len(self.words) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self.forget()
        cut = [self.cut.findall(" " + text) if text else [] for text in several]
        new = set().union(*cut).difference(self.words)
        self.characters += sum(map(len, new))
        self.learn(new)
        sizes = np.array([len(parts) for parts in cut], np.int64)
        places = np.fromiter(map(self.words.__getitem__, chain.from_iterable(cut)), np.int64, sizes.sum())
        counts = self.count[places]
        ends = np.cumsum(counts)
        ids = self.paths[np.repeat(self.start[places] - (ends - counts), counts) + np.arange(counts.sum())]
        # what is returned is decoded
        octets = self.spelled.take(pa.array(ids))
        _, stops, octets = octets.buffers()
        octets, stops = octets.to_pybytes() if octets else b"", np.frombuffer(stops, np.int64, len(ids) + 1)
        till = np.cumsum(sizes)
        pieces = np.concatenate(([0], ends))[np.concatenate(([0], till))]
        stops, pieces = stops[pieces].tolist(), pieces.tolist()
        out = []
        for k, (text, parts, j) in enumerate(zip(several, cut, till.tolist())):
            mine = slice(pieces[k], pieces[k + 1])
            spelled = octets[stops[k] : stops[k + 1]]
            own = slice(j - len(parts), j)
            out.append(self._encode(text, parts, places[own], ends[own] - counts[own] - pieces[k], ids[mine], spelled))
        return out

    def _encode(self, text: str, parts: list[str], places: np.ndarray, starts: np.ndarray, ids: np.ndarray, spelled: bytes) -> dict:
        if not parts:
            return {"ids": np.empty(0, np.int32), "score": 0.0, "round_trip": not text, "alternatives": []}
        total, loss = float(self.score[places].sum()), self.loss[places]
        few = min(self.best - 1, len(parts))
        near = np.sort(np.argpartition(loss, few - 1)[:few] if few else np.empty(0, np.int64))
        options = [self.nbest(parts[p]) for p in near.tolist()]
        combined = sorted(
            (sum(o[0][0] - o[k][0] for o, k in zip(options, pick)), pick) for pick in product(*(range(len(o)) for o in options))
        )
        # each alternative's changes are decoded against the ids that they replace
        alternatives, good = [], spelled == f" {text}".encode() or spelled.decode(errors="replace")[1:] == text
        for lost, pick in combined[1 : self.best]:
            changes = []
            for p, option, k in zip(near.tolist(), options, pick):
                if k:
                    at, removed = int(starts[p]), int(self.count[places[p]])
                    changes.append({"at": at, "removed": removed, "ids": list(option[k][1])})
                    good &= self._octets(option[k][1]) == self._octets(ids[at : at + removed].tolist())
            alternatives.append({"score": total - lost, "changes": changes})
        return {"ids": ids, "score": total, "round_trip": good, "alternatives": alternatives}

    def _octets(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.octets.__getitem__, ids))

    def decode(self, ids) -> str:
        """Text of piece ids: the space that was put in front is taken off, broken bytes become replacement characters."""
        return self._octets(ids.tolist() if isinstance(ids, np.ndarray) else ids).decode(errors="replace")[1:]


def _room(table: np.ndarray, most: int) -> np.ndarray:
    """The table, longer by half if it has less room."""
    if most <= len(table):
        return table
    return np.concatenate((table, np.empty(max(most, len(table) * 3 // 2) - len(table), table.dtype)))


_ENCODERS: dict[int, tuple[Broadcast, Encoder]] = {}


def _encoder(shared: Broadcast, best: int) -> Encoder:
    """The worker's encoder: tasks of one query go on with the words of the earlier ones, another query's are dropped first."""
    if best in _ENCODERS and _ENCODERS[best][0] is not shared:
        _ENCODERS.clear()
    if best not in _ENCODERS:
        _ENCODERS[best] = shared, Encoder(shared.value, best)
    return _ENCODERS[best][1]


def encoded(docs: DataFrame, vocabulary: Vocabulary, best: int = BEST) -> Column:
    """``docs.text`` as a struct of ``ids``, ``score``, ``round_trip`` and ``alternatives``.

    ``alternatives`` holds the 2nd to ``best``-th segmentation, fewer if there are no more:
    each as its score and the runs of pieces that differ from ``ids``. Equal scores are
    ordered by the words' place in the text. Null and empty texts have no pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @arrow_udf(SCHEMA)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, best)
        for part in (part for batch in batches for part in short(batch, AT_ONCE)):
            done = encoder.encode_all(texts(part))
            yield pa.StructArray.from_arrays(
                [
                    pa.array([d["ids"] for d in done], pa.list_(pa.int32())),
                    pa.array([d["score"] for d in done], pa.float64()),
                    pa.array([d["round_trip"] for d in done], pa.bool_()),
                    pa.array([d["alternatives"] for d in done], pa.list_(_PATH)),
                ],
                names=["ids", "score", "round_trip", "alternatives"],
            )

    return run(docs["text"])


def decoded(frame: DataFrame, ids: str, vocabulary: Vocabulary) -> Column:
    """Text of an array of piece ids; null and empty arrays give the empty text."""
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary)

    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value)
        for part in slices(batches):
            yield pa.array([encoder.decode(x) if x else "" for x in part.to_pylist()], pa.string())

    return run(frame[ids])


def segmented(docs: DataFrame, path: str = MODEL_PATH, best: int = BEST) -> DataFrame:
    """``doc_id``, ``n_pieces``, ``score``, ``round_trip``, ``ids``, ``alternatives`` for every row of ``docs``.

    Repeated rows and null ids are kept, other columns are not read; empty table: no rows.
    """
    rows = docs.select("doc_id", "text")
    found = rows.select("doc_id", encoded(rows, Vocabulary.load(path), best).alias("e"))
    return found.select("doc_id", F.size("e.ids").alias("n_pieces"), "e.score", "e.round_trip", "e.ids", "e.alternatives")
