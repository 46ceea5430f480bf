"""MinHash near-dedup: one-permutation hashing, banded buckets, star-shaped candidates, exact links.

One hash of every shingle gives a whole signature: the hash range is cut into bins and each
keeps its smallest hash. A bin without shingles takes the value of another one, the first
with shingles in a random order of bins of its own (optimal densification), so that bins
agree with a probability of the Jaccard similarity for small sets too. Bands of bins are
buckets. The members of a bucket are compared with one of them, its hub, and not with each
other; candidates are confirmed on the full sets of shingles.

A bucket whose members end up in one component needs nothing else. In the others, nodes outside the largest
component are compared with those of other components, each pair in the first bucket that it shares: by finer
one-permutation sketches first, then by short hashes of their shingles, both of which leave out what is surely
below the limit, and what is left on the full sets. So no link between two texts with a bucket in common depends on the choice of hubs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import near_dedup
from starloom.llm.common import among, slices, utf8
from starloom.llm.components import apart, connected_components
from starloom.session import stage

SHINGLE_WORDS = 2
#: Per cent of the union that the intersection of two linked sets has at least.
PERCENT = 80
#: At a similarity of 0.8 two sets share no bucket once in 20 million pairs: (1 - 0.8**4)**32.
BANDS = 32
BAND_BINS = 4
#: Members that are compared with one copy of a hub's text.
BLOCK = 4096
#: Bins of a sketch, one byte each, and how many standard deviations below the limit a pair is left out.
SKETCH = 512
DEVIATIONS = 5.5
#: Short hashes of a set at most.
SHORT = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values of the splitmix64 finaliser


def mixed(values: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: bytes, size: int = SHINGLE_WORDS) -> set:
    """The distinct shingles themselves; the whole sequence where there are fewer words, none without words."""
    words = text.lower().split()
    if len(words) <= size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of :func:`shingle_set`."""
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    width = min(size, len(words))
    rolled = np.full(len(words) - width + 1 if words else 0, np.uint64(width))
    for i in range(width):
        rolled = mixed(rolled * _STEP + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(rolled)


class Signer:
    """One-permutation signatures with fixed orders in which empty bins look for a value."""

    def __init__(self, bands: int = BANDS, band_bins: int = BAND_BINS, seed: int = 13) -> None:
        self.bands, self.bins = bands, bands * band_bins
        random = np.random.default_rng(seed)
        self.orders = random.permuted(np.tile(np.arange(self.bins), (self.bins, 1)), axis=1)
        self.salts = mixed(np.arange(1, self.bins + 1, dtype=np.uint64) * _STEP)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest hash of every bin; ``hashes`` are sorted and not empty."""
        bins = ((hashes >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        values, filled = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        values[bins[first]], filled[bins[first]] = hashes[first], True
        empty = np.flatnonzero(~filled)
        if len(empty):
            orders = self.orders[empty]
            values[empty] = values[orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]]
        return values

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """One bucket number per band; none for the empty set."""
        if not len(hashes):
            return np.empty(0, np.int64)
        terms = mixed(self.signature(hashes) + self.salts).reshape(self.bands, -1)
        return mixed(np.bitwise_xor.reduce(terms, axis=1)).view(np.int64)


def sketch_of(hashes: np.ndarray, bins: int = SKETCH) -> bytes:
    """A byte from 1 on of the smallest hash of every bin, 0 where there is none."""
    at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(hashes) else at[:0].astype(np.int64)
    sketch = np.zeros(bins, np.uint8)
    sketch[at[first]] = mixed(hashes[first]) % np.uint64(255) + np.uint64(1)
    return sketch.tobytes()


def may_be_alike(one: np.ndarray, others: np.ndarray, n_one: int, n_others: np.ndarray, percent: int) -> np.ndarray:
    """Which sketches do not show that their set is less alike, but for one in 50 million.

    A filled bin draws an element of the union without putting it back, so the equal bins of a pair at the
    limit follow the hypergeometric distribution, which is narrow where most of a small set is drawn.
    """
    equal = ((others == one) & (one != 0)).sum(axis=1)
    drawn = ((others != 0) | (one != 0)).sum(axis=1)
    limit = percent / 100
    union = (n_one + n_others) / (1 + limit)
    left = np.clip(1 - drawn / union, 0, 1)
    return equal >= limit * drawn - 1 - DEVIATIONS * np.sqrt(limit * (1 - limit) * drawn * left)


def short_hashes(hashes: np.ndarray, most: int = SHORT) -> tuple[int, bytes]:
    """32 bits of each hash in the lowest 2**-k of their range, with the smallest k that leaves at most so many; and k."""
    k = 0
    while int(np.searchsorted(hashes, np.uint64(1 << (64 - k)) if k else np.uint64((1 << 64) - 1), "right")) > most:
        k += 1
    low = hashes[: np.searchsorted(hashes, np.uint64(1 << (64 - k)), "left")] if k else hashes
    return k, ((low << np.uint64(k)) >> np.uint64(32)).astype("<u4").tobytes()


def still_alike(k: int, one: bytes, k_other: int, other: bytes, percent: int) -> bool:
    """Whether short hashes of two sets do not show that these are less alike. All hashes of both decide it but for the
    hashes' own equal ones, which only add; a part of them decides for all but one in 50 million."""
    a, b = np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4")
    if k > k_other:
        k, k_other, a, b = k_other, k, b, a
    d = k_other - k
    if d:
        # of the larger range the part that the smaller one covers, and of that as many bits as both have
        a, b = a[a < (1 << (32 - d))], b >> np.uint32(d)
    both = int(np.isin(a, b).sum())
    union = len(a) + len(b) - both
    limit = percent / 100
    return both >= limit * union - (1 + DEVIATIONS * math.sqrt(limit * (1 - limit) * union) if k_other else 0)


def marked(docs: DataFrame, size: int = SHINGLE_WORDS, bands: int = BANDS, band_bins: int = BAND_BINS) -> DataFrame:
    """``row``, ``doc_id``, ``n`` shingles, ``digest`` of the set, ``buckets`` of every row; an empty set has no digest."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, band_bins)
        for part in slices(batches):
            sets = [shingle_hashes(t, size) for t in utf8(part.column(2))]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            buckets = pa.array([signer.buckets(s) for s in sets], pa.list_(pa.int64()))
            made = [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), buckets]
            yield pa.RecordBatch.from_arrays(made, ["row", "doc_id", "n", "digest", "buckets"])

    key = docs.select("doc_id").schema[0].dataType.simpleString()
    return docs.select("row", "doc_id", "text").mapInArrow(sign, f"row long, doc_id {key}, n long, digest binary, buckets array<long>")


# --- candidates and exact links -----------------------------------------------------------


def _may_link(a: str, b: str, percent: int) -> str:
    """Whether the sizes allow the similarity."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def confirmed(pairs: DataFrame, texts: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, merge: bool = True) -> DataFrame:
    """The ``pairs`` (``hub``, ``node``; distinct) of rows of ``texts`` (``row``, ``text``) whose sets are alike enough.

    A node's text goes where its hub's is, so each task holds one hub's set and reads the others one by one; a hub
    with very many nodes is dealt out in blocks with a copy of its text each. Sets are compared word by word.
    """
    crowds = pairs.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    crowds = stage(crowds, "minhash-crowds")
    many = crowds.where("blocks > 1")
    dealt = pairs.join(F.broadcast(many) if many.count() <= 10_000 else many, "hub", "left").select(
        "hub", F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"), "node"
    )
    hubs = crowds.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("hub").alias("node"))
    asked = stage(dealt.unionByName(hubs), "minhash-asked")
    # many pairs are merged at any size, so that a run's cost grows with its input alone; few are left to Spark
    wanted = among(texts.withColumnRenamed("row", "node"), asked, "node")
    sent = (asked.hint("merge") if merge else asked).join(wanted, "node").select("hub", "block", (F.col("hub") != F.col("node")).alias("other"), "node", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, its_set = None, set()
        for part in slices(batches):
            rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist(), utf8(part.column(4)))
            found = []
            for a, block, other, b, text in rows:
                mine = shingle_set(text, size)
                if not other:
                    hub, its_set = (a, block), mine
                    continue
                if hub != (a, block):
                    raise ValueError("a hub's text comes before those of its nodes")
                both = len(its_set & mine)
                if 100 * both >= percent * (len(its_set) + len(mine) - both):
                    found.append((a, b))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return sent.repartition("hub", "block").sortWithinPartitions("hub", "block", "other").mapInArrow(compare, "a long, b long")


def _star(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of the smallest node of every bucket with those of its other nodes that are in other components."""
    hubs = members.groupBy("bucket").agg(F.min(F.struct("node", "n", "root")).alias("h"))
    pairs = members.join(apart(hubs), "bucket").where("node <> h.node AND root <> h.root").where(_may_link("n", "h.n", percent))
    return pairs.select(F.col("h.node").alias("hub"), "node").distinct()


def _details(nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(``node``, ``sketch``, ``k``, ``short``) of the given nodes, from their texts."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [shingle_hashes(t, size) for t in utf8(part.column(1))]
            ks, shorts = zip(*(short_hashes(s) for s in sets))
            made = [part.column(0), pa.array([sketch_of(s) for s in sets], pa.binary()), pa.array(ks, pa.int32()), pa.array(shorts, pa.binary())]
            yield pa.RecordBatch.from_arrays(made, ["node", "sketch", "k", "short"])

    own = among(texts.withColumnRenamed("row", "node"), nodes, "node").select("node", "text")
    return own.mapInArrow(describe, "node long, sketch binary, k int, short binary")


def _across(members: DataFrame, nodes: DataFrame, details: DataFrame, percent: int) -> DataFrame:
    """Pairs (``hub``, ``node``) of one bucket but different components that may be alike by their sketches and short hashes.

    Every pair is looked at in the first bucket that it shares. Buckets with very many members are cut into
    blocks, and every two blocks meet in a task of their own.
    """
    cells = near_dedup.in_blocks(members.withColumn("cell", F.col("bucket")), F.xxhash64("node"))
    known = cells.join(details.join(among(nodes.select("node", "buckets"), details, "node"), "node"), "node")
    known = known.select("cell", "node", "n", "root", "bucket", "buckets", "sketch", "k", "short")

    def meet(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, n, root, bucket = (rows[c].to_numpy() for c in ("node", "n", "root", "bucket"))
        buckets = np.ascontiguousarray(rows["buckets"].combine_chunks().flatten().to_numpy().reshape(len(node), -1).T)
        sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint8).reshape(len(node), -1)
        ks, shorts = rows["k"].to_pylist(), rows["short"].to_pylist()
        band = int(np.flatnonzero(buckets[:, 0] == bucket[0])[0])
        roots, sizes = np.unique(root, return_counts=True)
        large = roots[sizes.argmax()]
        place = np.arange(len(node))
        for i in place[root != large].tolist():
            fit = (root != root[i]) & ((root == large) | (place > i))
            fit &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
            for earlier in buckets[:band]:
                fit &= earlier != earlier[i]
            others = place[fit]
            others = others[may_be_alike(sketch[i], sketch[others], n[i], n[others], percent)]
            others = node[[j for j in others.tolist() if still_alike(ks[i], shorts[i], ks[j], shorts[j], percent)]]
            if len(others):
                mine = np.full(len(others), node[i])
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(mine, others)), pa.array(np.maximum(mine, others))], ["hub", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))).tolist()
            for start, end in zip(starts, [*starts[1:], len(cell)]):
                if held and held[0].column(0)[0].as_py() != cell[start]:
                    yield from meet(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from meet(pa.Table.from_batches(held))

    return known.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "hub long, node long").distinct()


def node_roots(nodes: DataFrame, texts: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, others: DataFrame | None = None) -> DataFrame:
    """(``node``, ``root``) of all ``nodes`` (``node``, ``n``, ``buckets``) with a link; ``texts`` has ``row`` and ``text``.

    ``others`` are further candidates (``hub``, ``node``), which are confirmed like those of the buckets.
    """
    placed = nodes.select(F.explode("buckets").alias("bucket"), "node", "n")
    shared = apart(placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"))
    members = stage(placed.join(shared, "bucket"), "minhash-members")
    stars = _star(members.withColumn("root", F.col("node")), percent)
    if others is not None:
        stars = stars.unionByName(others).distinct()
    stars = stage(stars, "minhash-stars")
    links = stage(confirmed(stars, texts, size, percent), "minhash-links")
    roots = stage(connected_components(links, label="minhash"), "minhash-roots")
    named = members.join(roots, "node", "left").select("bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    named = stage(named, "minhash-named")
    torn = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("hub"))
    torn = apart(torn.where("low <> high").select("bucket", "hub"))
    # the hub has met all others of its bucket
    open_ = stage(named.join(torn, "bucket").where("node <> hub").drop("hub"), "minhash-open")
    details = stage(_details(open_.select("node"), texts, size), "minhash-details")
    across = stage(_across(open_, nodes, details, percent), "minhash-across")
    found = stage(confirmed(across, texts, size, percent, merge=False), "minhash-links")
    if found.isEmpty():
        return roots
    # components of components
    of = roots.union(open_.select("node", F.col("root")).distinct().join(roots.select("node"), "node", "left_anti"))
    joined = found.join(of.toDF("a", "u"), "a").join(of.toDF("b", "v"), "b").select("u", "v")
    merged = stage(connected_components(joined, "u", "v", label="minhash"), "minhash-roots").toDF("old", "new")
    renamed = stage(of.toDF("node", "old").join(apart(merged), "old", "left"), "minhash-renamed")
    return renamed.select("node", F.coalesce("new", "old").alias("root"))


def near_components(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS, band_bins: int = BAND_BINS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Rows are linked if the intersection of their sets of word shingles has ``percent`` per cent of the union
    or more; rows with equal sets are. A-Z are lower-cased, words end at ASCII white space, and a text with fewer
    words than a shingle is one. ``component_id`` is the smallest ``doc_id`` within reach and ``kept`` says
    that it is the row's own. Null and empty texts have no shingles and stand alone. Repeated rows are kept and
    alike; a null ``doc_id`` is no candidate for the smallest and never ``kept``, a component of such rows
    has a null id. Empty table: no rows. Other columns are not read.
    Texts are staged with a row number, as they are read again when candidates are confirmed: a second scan
    of the input may split its files otherwise and number them otherwise.
    """
    texts = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "minhash-texts")
    signed = stage(marked(texts, size, bands, band_bins), "minhash-signed")
    # of equal sets one takes part; its row names them all
    firsts = signed.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first"))
    firsts = stage(firsts, "minhash-sets")
    nodes = among(signed, firsts.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "n", "buckets")
    nodes = stage(nodes, "minhash-nodes")
    roots = node_roots(nodes, texts.select("row", "text"), size, percent)
    joined = firsts.join(roots, "node", "left").select("digest", "first", F.coalesce("root", "node").alias("root"))
    joined = stage(joined, "minhash-joined")
    smallest = apart(joined.groupBy("root").agg(F.min("first").alias("component_id")))
    names = stage(joined.join(smallest, "root").select("digest", "component_id"), "minhash-names")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")
    linked = signed.where("n > 0").join(names, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", kept)
