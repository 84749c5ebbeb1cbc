"""SimHash near-duplicates by vantage-point trees over Hamming distance.

Fingerprints of 64 bits come from three-word shingles of the lower-cased
text. Documents with equal fingerprints are one point. A vantage-point tree,
grown on a bounded sample of the points, splits them into shards: a node has
a vantage point v and a radius m; points with d(x, v) <= m go inside, the
others outside, and outside points with d(x, v) <= m + r also inside, as the
triangle bound allows a link of length r only across that boundary. So the
two ends of every link meet in at least one shard, and each shard is
searched on its own, first by more splits of the same kind, then by blocks
of XOR and bit count. A shard returns a spanning star of each group of
linked points, never all its pairs; the components of those stars are found
with joins.

The sample only shapes the tree; every point is indexed and every link
within ``max_bits`` is found, so recall is 1.

The tree on the driver has a bounded number of leaves. Shards that hold more
than ``SHARD_LIMIT`` points are split again in Spark, each by a small tree grown
in a task on a bounded sample of its points, with the same boundary overlap,
until none is larger. Points that no vantage point separates (and those left
after ``MAX_SPLITS`` rounds) are dealt by the pigeonhole principle instead: of
``max_bits + 1`` blocks of bits, two linked points have one in common.

Defined cases: a text without words (null, empty) has fingerprint zero and
is linked like any other; a null doc_id counts as the largest id and is
given back as null (a component of such rows only has a null id); repeated rows are one point; an empty table gives no
rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import carried, stored
from .components import components

SEED = 42
SHARD_POINTS = 1_000  # points of a shard before its boundary points
MAX_SHARDS = 8_192
SAMPLE_PER_SHARD = 32
SHARD_LIMIT = 50_000  # points that one task searches, boundary points included
FAN_OUT = 8  # leaves of the tree that splits a larger shard
SPLIT_SAMPLE = 2_000  # points that shape such a tree
MAX_SPLITS = 12
LEAF_POINTS = 2_000  # points of a shard that are compared in blocks
NO_ID = (1 << 63) - 1


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 of every shingle of the words, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def fingerprint(text: str | None, size: int = 3) -> int:
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int = 3) -> Column:
    """Fingerprint as a long with the same 64 bits."""
    @F.pandas_udf("long")
    def compute(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, size) for t in batch], np.uint64).view(np.int64))
    return compute(text)


def _distance(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v)


def split(points: np.ndarray, r: int, tries: int = 8) -> tuple[np.uint64, int] | None:
    """Vantage point and radius for ``points``, or None if none separates
    them: of a few spread candidates, the one whose split leaves the fewest
    pairs to compare."""
    best = None
    for v in points[:: max(1, len(points) // tries)][:tries]:
        counts = np.cumsum(np.bincount(_distance(points, v), minlength=64 + r + 1))
        inside, outside = counts[r:65 + r].astype(float), len(points) - counts[:65].astype(float)
        cost = inside ** 2 + outside ** 2
        m = int(np.argmin(cost))
        if best is None or cost[m] < best[0]:
            best = (cost[m], v, m)
    return None if best is None or best[0] >= 0.9 * len(points) ** 2 else best[1:]


def grow(sample: np.ndarray, leaves: int, r: int) -> list:
    """A tree of [vantage, radius, inside, outside] nodes and leaf numbers,
    with about ``leaves`` leaves of equal home points."""
    number = iter(range(1 << 30))

    def node(points: np.ndarray, share: int):
        cut = split(points, r) if share > 1 and len(points) > 1 else None
        if cut is None:
            return next(number)
        v, m = cut
        near = _distance(points, v) <= m
        n = min(share - 1, max(1, round(share * near.mean())))
        return [int(v), m, node(points[near], n), node(points[~near], share - n)]
    return node(sample, leaves)


def route(tree, points: np.ndarray, r: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, positions) of ``points`` for every leaf they belong to."""
    todo = [(tree, np.arange(len(points)))]
    while todo:
        at, rows = todo.pop()
        if isinstance(at, int):
            yield at, rows
        elif len(rows):
            d = _distance(points[rows], np.uint64(at[0]))
            todo += [(at[2], rows[d <= at[1] + r]), (at[3], rows[d > at[1]])]


class _Groups:
    """Groups of points linked so far, each known by one of its positions."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, rows: np.ndarray, cols: np.ndarray) -> None:
        a, b = self.label[rows], self.label[cols]
        differ = a != b
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        pairs = np.unique(np.minimum(a, b) * len(self.label) + np.maximum(a, b))
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x
        for p in pairs.tolist():
            x, y = find(p // len(self.label)), find(p % len(self.label))
            if x != y:
                parent[max(x, y)] = min(x, y)
        to = np.arange(len(self.label))
        for x in parent:
            to[x] = find(x)
        self.label = to[self.label]


def link_points(points: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of each group of points linked within ``r`` bits, as
    (point, centre) for all points but the centres."""
    groups = _Groups(len(points))
    todo = [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        cut = split(points[rows], r) if len(rows) > LEAF_POINTS else None
        if cut is not None:
            d = _distance(points[rows], cut[0])
            todo += [rows[d <= cut[1] + r], rows[d > cut[1]]]
            continue
        own = points[rows]
        step = max(1, (1 << 21) // max(1, len(own)))
        for i in range(0, len(own), step):
            near = np.bitwise_count(own[i:i + step, None] ^ own[None, i:]) <= r
            a, b = np.nonzero(near)
            groups.link(rows[i + a], rows[i + b])
    centre = points[groups.label]
    linked = centre != points
    return points[linked], centre[linked]


def _by_tree(points: DataFrame, r: int) -> DataFrame:
    """(fingerprint, shard) for every shard of one tree that a point belongs to."""
    n = points.count()
    leaves = max(1, min(MAX_SHARDS, -(-n // SHARD_POINTS)))
    # A bounded sample, the same for every run: it only shapes the tree.
    sample = (points.select("fingerprint").orderBy(F.xxhash64("fingerprint"), "fingerprint")
              .limit(leaves * SAMPLE_PER_SHARD).toPandas()["fingerprint"])
    tree = grow(sample.to_numpy(np.int64).view(np.uint64), leaves, r)

    def to_shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fingerprint"].to_numpy(np.int64).view(np.uint64)
            for shard, rows in route(tree, own, r):
                if len(rows):
                    yield batch.iloc[rows].assign(shard=np.int64(shard))
    return stored(points.select("fingerprint").mapInPandas(to_shards, "fingerprint long, shard long"), "simhash-placed")


def _split_shards(placed: DataFrame, r: int) -> DataFrame:
    """(fingerprint, shard) with the shards over ``SHARD_LIMIT`` points split,
    so that the ends of every link still meet in a shard."""
    def plant(shard: pd.DataFrame) -> pd.DataFrame:
        points = np.sort(shard["fingerprint"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"shard": shard["shard"].iloc[:1], "tree": json.dumps(grow(points, FAN_OUT, r))})

    def to_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (shard, tree), rows in batch.groupby(["shard", "tree"]):
                own = rows["fingerprint"].to_numpy(np.int64)
                for leaf, at in route(json.loads(tree), own.view(np.uint64), r):
                    yield pd.DataFrame({"fingerprint": own[at], "shard": shard, "leaf": leaf})

    ready = []
    for round_ in range(MAX_SPLITS + 1):
        sizes = stored(placed.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > SHARD_LIMIT),
                       "simhash-large")
        if sizes.isEmpty():
            return reduce(DataFrame.union, ready, placed)
        large = placed.join(sizes, "shard")
        ready.append(placed.join(sizes, "shard", "left_anti").select("fingerprint", "shard"))
        if round_ < MAX_SPLITS:
            place = F.pmod(F.xxhash64("shard", "fingerprint"), F.lit(1 << 30)) / F.lit(float(1 << 30))
            trees = large.where(place * F.col("n") < SPLIT_SAMPLE).select("fingerprint", "shard")
            trees = stored(trees.groupBy("shard").applyInPandas(plant, "shard long, tree string"), "simhash-trees")
            trees = trees.where("tree like '[%'")  # a node, not one leaf
            split_ = large.join(trees, "shard").select("fingerprint", "shard", "tree").mapInPandas(
                to_leaves, "fingerprint long, shard long, leaf int")
            placed = stored(split_.select("fingerprint", F.xxhash64("shard", "leaf").alias("shard")), "simhash-split")
            large = large.join(trees, "shard", "left_anti")
        ready.append(_by_blocks(large, r))
    return reduce(DataFrame.union, ready)


def _by_blocks(large: DataFrame, r: int) -> DataFrame:
    """The points dealt by each of r + 1 blocks of their bits."""
    cuts = [64 * i // (r + 1) for i in range(r + 2)]
    blocks = [F.shiftrightunsigned(F.shiftleft("fingerprint", 64 - b), 64 - b + a) for a, b in zip(cuts, cuts[1:])]
    keys = F.array(*[F.xxhash64("shard", F.lit(i), b) for i, b in enumerate(blocks)])
    return large.select("fingerprint", F.explode(keys).alias("shard"))


def find_links(points: DataFrame, r: int) -> DataFrame:
    """(a, b) edges that connect the different fingerprints of ``points``
    linked within ``r`` bits: a star per shard and group."""
    def search(group: pd.DataFrame) -> pd.DataFrame:
        a, b = link_points(group["fingerprint"].to_numpy(np.int64).view(np.uint64), r)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
    return _split_shards(_by_tree(points, r), r).groupBy("shard").applyInPandas(search, "a long, b long")


def simhash_components(docs: DataFrame, size: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash (of the text, to tell rows
    with the same id apart), fingerprint (long), group (a fingerprint of the
    component) and component_id (its smallest doc_id)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = stored(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                              F.xxhash64(text).alias("text_hash"),
                              fingerprints(text, size).alias("fingerprint")), "simhash-slim")
    points = stored(slim.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "simhash-points")
    found = components(find_links(points, max_bits))
    grouped = stored(points.join(found, points["fingerprint"] == found["node"], "left").select(
        "fingerprint", "id", F.coalesce("component", "fingerprint").alias("group")), "simhash-groups")
    smallest = grouped.groupBy("group").agg(F.min("id").alias("component_id"))
    named = grouped.join(smallest, "group").drop("id")
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return slim.join(named, "fingerprint").select(
        back("doc_id"), "text_hash", "fingerprint", "group", back("component_id"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicate(docs: DataFrame, size: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest
    id (of rows with that id, the smallest text hash)."""
    found = simhash_components(docs, size, max_bits)
    first = (found.groupBy("group")
             .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_hash").alias("h"))).alias("k"))
             .select("k.id", "k.h"))
    rows = docs.select(F.struct(*carried(docs, [])).alias("row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    # Equal rows are reduced in each task before the shuffle, so copies of one
    # row never meet in one task; the join finds the result dealt by its keys.
    single = rows.groupBy("id", "h").agg(F.first("row").alias("row"))
    return single.join(first, ["id", "h"]).select("row.*")
