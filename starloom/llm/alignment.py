"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked token ids.

Where tokens of both end at the same byte, the texts fall into groups, and the two tokens are linked. How often
an id pair is linked in the whole corpus is counted by external spilling: tasks turn links into (pair, document)
records, part them by radix of the second tokenizer's id (the side), sort them side-major and write each part as a
zstd run. Runs of one radix are dealt into slices of bounded size. A slice is counted by a k-way heap merge of its
runs, which hands out pair after pair in side-major order; partial counts of slices add up, and a side's largest
count follows. Then the same runs are merged again, now beside the counts, and every document gets its share back.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import short, texts
from starloom.session import stage

FIRST_PATH = "/opt/tokenizers/byte_bpe_50k.json"
SECOND_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: Parts of the second tokenizer's ids, by remainder.
RADICES = 64
#: Bytes of texts that are aligned together.
AT_ONCE = 1 << 18
#: Records that a task holds before it writes its runs, records of a block of a run, and of a slice.
HELD = 1 << 20
BLOCK = 1 << 14
SLICE_RECORDS = 1 << 22
#: An id pair as one number: the second id, then the first.
SHIFT = 20

MARK = "▁"


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable bytes as themselves, all others as the letters from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_bpe(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a tokenizer file; its special tokens are ordinary text.

    Merges must be in the order of ids, so that an id is the rank of its merge.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, vocabulary = byte_letters(), model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        raise ValueError("merges are not in the order of ids")
    known = set(made) | {vocabulary[c] for c in letters}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if i in known}
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Bytes of every token id, and their lengths."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.spelled = pa.array(spelled, pa.large_binary())
        self.lengths = np.array([len(s) for s in spelled], np.int64)

    def spell(self, ids: np.ndarray, sizes: list[int], wanted: list[bytes]) -> list[bool]:
        """Whether the first ``sizes`` of the ids spell the first of the bytes wanted, and so on."""
        found, stops = joined(self.spelled, ids)
        spelled, ends = found.to_pybytes(), stops[np.cumsum(sizes)].tolist()
        return [j - i == len(w) and spelled.startswith(w, i) for i, j, w in zip([0, *ends], ends, wanted)]


def joined(values: pa.Array, at: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The values at these places one after another, and where each starts, with the end of the last."""
    taken = values.take(pa.array(at))
    _, stops, found = taken.buffers()
    return found or pa.py_buffer(b""), np.frombuffer(stops, np.int64, len(taken) + 1)


NONE = np.empty(0, np.int64)


class Pair:
    """Both tokenizers."""

    def __init__(self, first_path: str = FIRST_PATH, second_path: str = SECOND_PATH) -> None:
        self.first = byte_bpe(first_path)
        self.a = Tokens([self.first.decode_single_token_bytes(i) for i in range(self.first.n_vocab)])
        self.second = sentencepiece.SentencePieceProcessor(model_file=second_path)
        self.b = Tokens([self._piece(i) for i in range(self.second.get_piece_size())])
        # a token inside a group, one at the end of its side, and the last of a text
        kinds = [(self.a, ","), (self.a, "|"), (self.b, ","), (self.b, ";"), (self.b, "")]
        written = [[f"{i}{end}".encode() for i in range(len(t.spelled))] for t, end in kinds]
        self.starts = np.cumsum([0, *map(len, written)])
        self.written = pa.array([text for part in written for text in part], pa.large_binary())

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace(MARK, " ").encode()

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both tokenizers; none where one of them does not spell space + text."""
        a, b, *_ = self.encoded_all([text])
        return a, b

    def encoded_all(self, several: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``encoded`` for some texts: the ids of all, one text after another, and how many each has."""
        a = [self.first.encode_to_numpy(" " + text).astype(np.int64) if text else NONE for text in several]
        b = [np.array(self.second.encode(text), np.int64) if text else NONE for text in several]
        spelled = [f" {text}".encode() if text else b"" for text in several]
        good = [t.spell(np.concatenate(ids), [*map(len, ids)], spelled) for t, ids in ((self.a, a), (self.b, b))]
        for k, both in enumerate(zip(*good)):
            if not all(both):
                a[k] = b[k] = NONE
        return np.concatenate(a), np.concatenate(b), *(np.array([len(x) for x in ids], np.int64) for ids in (a, b))

    def aligned(self, text: str) -> tuple[int, int, int, str, np.ndarray]:
        """Numbers of tokens of both sides and of groups, the groups written out, and the linked pairs of a text."""
        links, found = self.aligned_all([text])
        return *(found[c][0].item() for c in ("n_a", "n_b", "n_groups")), found["groups"][0].as_py(), links

    def aligned_all(self, several: list[str]) -> tuple[np.ndarray, dict]:
        """The linked pairs of some texts, one text after another, and the columns ``_NAMES``."""
        a, b, n_a, n_b = self.encoded_all(several)
        links, n_groups, n_links, written = self.groups_all(a, b, n_a, n_b)
        return links, dict(zip(_NAMES, (n_a, n_b, n_groups, written, n_links)))

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int, str]:
        """The linked pairs in order, the number of groups, and the groups written as ``a1,a2|b1;a3|b2,b3``."""
        links, n, _, written = self.groups_all(a, b, *(np.array([len(x)]) for x in (a, b)))
        return links, n[0].item(), written[0].as_py()

    def groups_all(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """``groups`` for some texts, one after another, of ``n_a`` and ``n_b`` tokens: the links of all; groups, links and written groups of each.

        Both sides of a text end together, so the texts are cut like a single one.
        """
        if not len(a):
            none = np.zeros(len(n_a), np.int64)
            return NONE, none, none, pa.array([""] * len(none), pa.string())
        stops_a, stops_b, some = np.cumsum(n_a), np.cumsum(n_b), n_a > 0
        ends_a, ends_b = self.a.lengths[a], self.b.lengths[b]
        for ends, first in ((ends_a, (stops_a - n_a)[some]), (ends_b, (stops_b - n_b)[some])):
            ends[first] += 1  # a place before each text, so that a token without bytes does not end with the text before
            np.cumsum(ends, out=ends)
        common, other = np.zeros((2, ends_a[-1] + 1), bool)
        common[ends_a], other[ends_b] = True, True
        common &= other
        # a token without bytes would end where the one before it does, and each of the two be linked
        last_a, last_b = common[ends_a], common[ends_b]
        up_to = np.cumsum(common)
        group_a, group_b = up_to[ends_a] - last_a, up_to[ends_b] - last_b
        links = links_of(a[last_a], group_a[last_a], b[last_b], group_b[last_b])
        final_a = np.concatenate((group_a[1:] != group_a[:-1], [True]))
        final_b = np.concatenate((group_b[1:] != group_b[:-1], [True]))
        # every group has tokens of both sides
        till_a, till_b = (np.concatenate(([0], np.flatnonzero(f) + 1)) for f in (final_a, final_b))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + till_b[group_a]] = a + np.where(final_a, self.starts[1], 0)
        codes_b = b + np.where(final_b, self.starts[3], self.starts[2])
        at = stops_b[some] - 1
        codes_b[at] = b[at] + self.starts[4]
        codes[np.arange(len(b)) + till_a[1:][group_b]] = codes_b
        done = np.concatenate(([0], group_a + 1))[stops_a]
        per_group = np.ones(done[-1], np.int64)
        if len(links) != len(per_group):
            per_group = np.bincount(group_a[last_a], minlength=done[-1]) * np.bincount(group_b[last_b], minlength=done[-1])
        n_links = np.diff(np.concatenate(([0], np.cumsum(per_group)))[done], prepend=0)
        found, stops = joined(self.written, codes)
        stops = stops[np.concatenate(([0], stops_a + stops_b))].astype(np.int32)
        written = pa.StringArray.from_buffers(len(n_a), pa.py_buffer(stops), found)
        return links, np.diff(done, prepend=0), n_links, written


def links_of(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray) -> np.ndarray:
    """Pair numbers of all tokens that end a group together."""
    if len(a) == len(b) and (group_a == group_b).all() and (np.diff(group_a) > 0).all():
        return (b << SHIFT) | a
    starts, ends = np.searchsorted(group_b, group_a), np.searchsorted(group_b, group_a, "right")
    sizes = ends - starts
    at = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return (b[at] << SHIFT) | np.repeat(a, sizes)


@dataclass
class Alignment:
    """Tokens of every document, and the runs of all links."""

    tokens: DataFrame
    runs: DataFrame


def aligned(docs: DataFrame, first_path: str = FIRST_PATH, second_path: str = SECOND_PATH, radices: int = RADICES) -> Alignment:
    """``tokens`` has one row per row of ``docs``: ``row`` (a number), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``groups``, ``n_links``.

    The first tokenizer encodes space + text, the second, which adds the space itself, the text; neither adds special
    tokens, and their strings inside a text are plain text. ``groups`` is ``a1,a2|b1;a3|b2,b3`` in decimal ids. Texts that
    are null, empty or not spelled by both have no tokens: zeros, an empty ``groups``. Repeated rows and null ids
    are kept; other columns are not read; empty table: no rows.

    ``runs`` (``radix``, ``records``, ``run``) holds the linked pairs, ``second << SHIFT | first``, with their documents. Both are
    written in one pass to one staged table.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(first_path, second_path)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count, schema = 0, pa.schema([])
        for batch in batches:
            schema = pa.schema([("row", pa.int64()), ("doc_id", batch.schema.field(1).type), *_REST])
            for part in short(batch, AT_ONCE):
                links, columns = pair.aligned_all(texts(part.column(2)))
                rows = np.repeat(part.column(0).to_numpy(), columns["n_links"])
                for i in range(0, len(links), HELD):
                    held.append((links[i : i + HELD], rows[i : i + HELD]))
                    count += len(held[-1][0])
                    if count >= HELD:
                        yield _made(runs_of(held, radices), schema)
                        held, count = [], 0
                yield _made({"row": part.column(0), "doc_id": part.column(1), **columns}, schema)
        if count:
            yield _made(runs_of(held, radices), schema)

    key = docs.select("doc_id").schema[0].dataType.simpleString()
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    types = f"row long, doc_id {key}, n_a long, n_b long, n_groups long, groups string, n_links long, radix int, records long, run binary"
    staged = stage(numbered.mapInArrow(align, types), "aligned")
    return Alignment(staged.where("radix IS NULL").select("row", "doc_id", *_NAMES), staged.where("radix IS NOT NULL").select("radix", "records", "run"))


_NAMES = ("n_a", "n_b", "n_groups", "groups", "n_links")
_REST = [*zip(_NAMES, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())), ("radix", pa.int32()), ("records", pa.int64()), ("run", pa.binary())]


def _made(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the staged table; columns that are not given are null."""
    size = len(next(iter(columns.values())))
    arrays = [c if isinstance(c := columns.get(f.name), pa.Array) else pa.nulls(size, f.type) if c is None else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# --- runs ---------------------------------------------------------------------------------


def written_run(pairs: np.ndarray, rows: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted records as zstd frames of ``BLOCK`` records each, every frame behind its length."""
    press, out = zstandard.ZstdCompressor(level=3), []
    for i in range(0, len(pairs), BLOCK):
        part = slice(i, i + BLOCK)
        columns = [np.diff(c[part], prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T for c in (pairs, rows, times)]
        frame = press.compress(np.concatenate([np.ascontiguousarray(c).ravel() for c in columns]).tobytes())
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def read_run(run: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The blocks of a run, one at a time."""
    open_, at = zstandard.ZstdDecompressor(), 0
    while at < len(run):
        size = int.from_bytes(run[at : at + 4], "little")
        planes = np.frombuffer(open_.decompress(run[at + 4 : at + 4 + size]), np.uint8).reshape(3, 8, -1)
        yield tuple(np.cumsum(np.ascontiguousarray(p.T).view("<i8").ravel()) for p in planes)
        at += 4 + size


@dataclass
class Head:
    """The block of a run that is being read: its pairs, where each starts, how often it is there, and the records."""

    pairs: list[int]
    starts: list[int]
    sums: list[int]
    rows: np.ndarray
    times: np.ndarray
    at: int = 0

    @classmethod
    def of(cls, pairs: np.ndarray, rows: np.ndarray, times: np.ndarray) -> Head:
        starts = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        return cls(pairs[starts].tolist(), [*starts.tolist(), len(pairs)], np.add.reduceat(times, starts).tolist(), rows, times)


def merged(runs: list[bytes]) -> Iterator[tuple[int, Head, int]]:
    """(pair, head, place in it) of every stretch of equal pairs in ascending order of pairs, by a heap over the heads of all runs."""
    blocks = [read_run(r) for r in runs]
    heads = [Head.of(*next(b)) for b in blocks]
    heap = [(head.pairs[0], i) for i, head in enumerate(heads)]
    heapq.heapify(heap)
    while heap:
        pair, i = heap[0]
        head = heads[i]
        yield pair, head, head.at
        head.at += 1
        if head.at == len(head.pairs):
            block = next(blocks[i], None)
            if block is None:
                heapq.heappop(heap)
                continue
            head = heads[i] = Head.of(*block)
        heapq.heapreplace(heap, (head.pairs[head.at], i))


def runs_of(held: list[tuple[np.ndarray, np.ndarray]], radices: int) -> dict[str, list]:
    """One run per radix of the records held, as columns: equal (pair, row) counted, then sorted by pair and row."""
    pairs, rows = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((rows, pairs))
    pairs, rows = pairs[order], rows[order]
    first = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (rows[1:] != rows[:-1]))))
    times = np.diff(np.concatenate((first, [len(pairs)])))
    pairs, rows = pairs[first], rows[first]
    radix = (pairs >> SHIFT) % radices
    made: dict[str, list] = {"radix": [], "records": [], "run": []}
    for r in np.unique(radix).tolist():
        mine = radix == r
        for name, value in zip(made, (r, int(mine.sum()), written_run(pairs[mine], rows[mine], times[mine]))):
            made[name].append(value)
    return made


def in_slices(runs: DataFrame, most: int = SLICE_RECORDS) -> DataFrame:
    """``runs`` with the ``slice`` of each: as many per radix as its records need."""
    slices = runs.groupBy("radix").agg(F.ceil(F.sum("records") / most).cast("int").alias("slices"))
    # one row per radix
    return runs.join(F.broadcast(slices), "radix").withColumn("slice", F.pmod(F.xxhash64("run"), F.col("slices")).cast("int"))


def pair_counts(sliced: DataFrame) -> DataFrame:
    """(``radix``, ``pair``, ``total``, ``best``): links of every pair, and whether no other pair of its side has more."""

    def count(group: pa.Table) -> pa.Table:
        pairs, sums = [], []
        for pair, head, at in merged(group["run"].to_pylist()):
            if pairs and pairs[-1] == pair:
                sums[-1] += head.sums[at]
            else:
                pairs.append(pair)
                sums.append(head.sums[at])
        radix = pa.array([group["radix"][0].as_py()] * len(pairs), pa.int32())
        return pa.table([radix, pa.array(pairs, pa.int64()), pa.array(sums, pa.int64())], ["radix", "pair", "n"])

    parts = sliced.select("radix", "slice", "run").groupBy("radix", "slice").applyInArrow(count, "radix int, pair long, n long")
    totals = parts.groupBy("radix", "pair").agg(F.sum("n").alias("total"))
    # a side has no more pairs than the first tokenizer has ids
    side = Window.partitionBy("radix", F.shiftright("pair", SHIFT))
    return totals.withColumn("best", F.col("total") == F.max("total").over(side))


def shares(sliced: DataFrame, counts: DataFrame) -> DataFrame:
    """(``row``, ``n_best``, ``count_sum``): what the counts of its links give each row."""
    slices = sliced.select("radix", "slices").distinct()
    copies = counts.join(F.broadcast(slices), "radix").select("radix", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "pair", "total", "best")

    def give(group: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known["pair"].to_numpy())
        pairs, totals, best = (known[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "total", "best"))
        names = pairs.tolist()
        done = [(np.empty(0, np.int64),) * 3]
        held, which, place = [], [], 0
        for pair, head, at in merged(group["run"].to_pylist()):
            while names[place] < pair:
                place += 1
            part = slice(head.starts[at], head.starts[at + 1])
            held.append((head.rows[part], head.times[part]))
            which.append(place)
            if len(held) >= BLOCK:
                done, held, which = [summed([*done, weighted(held, which, totals, best)])], [], []
        if held:
            done.append(weighted(held, which, totals, best))
        rows, n_best, count_sum = summed(done)
        return pa.table([rows, n_best, count_sum], ["row", "n_best", "count_sum"])

    groups = sliced.select("radix", "slice", "run").groupBy("radix", "slice")
    given = groups.cogroup(copies.groupBy("radix", "slice")).applyInArrow(give, "row long, n_best long, count_sum long")
    return given.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def weighted(held: list, which: list[int], totals: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the stretches, with their times where the pair is a best one, and times the pair's count."""
    rows, times = (np.concatenate(c) for c in zip(*held))
    at = np.repeat(which, [len(r) for r, _ in held])
    return rows, times * best[at], times * totals[at]


def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per row with the sums of the other two columns."""
    rows, *values = (np.concatenate(c) for c in zip(*parts))
    if not len(rows):
        return rows, *values
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    return rows[first], *(np.add.reduceat(v[order], first) for v in values)


def with_counts(found: Alignment, *columns: Column | str, most: int = SLICE_RECORDS) -> DataFrame:
    """``columns`` of the tokens, and ``n_links``, ``n_best``, ``count_sum`` of their links in the whole table.

    ``n_best`` counts the links whose pair is linked as often as any pair of the same second id, ``count_sum`` adds up
    how often each link's pair is linked. Rows without links have zeros. An id of the second tokenizer that is in
    very many links has its runs in many slices, and a pair's counts are added up over them. Only ``columns`` are
    shuffled beside the sums.
    """
    sliced = in_slices(found.runs, most)
    counts = stage(pair_counts(sliced), "alignment-counts")
    given = stage(shares(sliced, counts), "alignment-shares")
    mine = found.tokens.select("row", *columns, "n_links")
    zero = F.lit(0).cast("long")
    sums = (F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum"))
    return mine.join(given, "row", "left").select(*mine.columns[1:], *sums)
