"""Suffix-array deduplication with a logarithmic index family.

Removes every byte covered by a string of ``length`` bytes (UTF-8) that
also starts anywhere else in the corpus, the same document included.

Only some suffixes are indexed. Of every window of ``length`` bytes the
leftmost ``anchor``-byte string of least hash is an anchor, so equal
windows hold an anchor at the same offset, and it is enough to compare
places with equal anchors ("a class"). Per class:

* An anchor whose whole neighbourhood (all windows that can hold it) is
  found twice needs no comparison: all of it goes. Exact copies and the
  inside of long repeats end here, by counting alone.
* One place of each other neighbourhood carries its bytes to a shard of
  the index, dealt by class. A shard takes its places in batches. A batch is
  sorted into a suffix array (by the bytes from the anchor) and a prefix
  array (by the bytes before it, read backwards), and merge-scanned against
  the existing levels for places of its classes. In the merged order, places
  whose neighbours have common prefixes of x bytes or more form an interval,
  so two places hold the same window with its anchor at offset o if they
  share an interval of the suffixes for ``length - o`` bytes and one of the
  prefixes for ``o`` bytes. Then levels of equal rank merge, so there are
  never more than about log2(batches) of them.
* A class with more than ``hot`` neighbourhoods never meets in a task. Its
  windows are counted instead, in two steps: blocks of 16 windows are
  decided by the string they all share (seen once: none repeats) and by
  the string that holds them all (seen twice: all repeat); only the blocks
  between, at the edges of repeats, are counted window by window.

In the index, bytes are compared; neighbourhoods and the windows of hot
classes are compared by 64-bit hashes of their bytes, texts by a 64-bit hash
and their length. Matches never cross documents.

``deduplicate`` takes a whole table. ``SuffixStore`` is the same family kept
in shared storage for a collection that grows: its levels are tables of
anchors in sorted buckets, a batch of documents is merge-scanned against
them, and levels of equal rank merge.

Defined cases: a null text is empty; texts shorter than ``length`` stay as
they are; repeated rows remove each other; a null id is given back; an
empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored

BLOCK = 16  # offsets decided together in a hot class
HOT = 4_096
SHARD_RECORDS = 4_096
BATCH_RECORDS = 1_024
PART_RECORDS = 2_048  # places matched at a time, but whole classes
SEGMENT = 1 << 22  # bytes of a long text hashed at a time
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, 1 << 16)
        _POWERS[:] = [np.cumprod(np.array([1] + [b] * size, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def _sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash along the last axis."""
    power, _ = _powers(data.shape[-1])
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


@dataclass(frozen=True)
class Spec:
    """Sizes in bytes: of the repeated string and of its anchors."""

    length: int = 400
    anchor: int = 193

    @property
    def offsets(self) -> int:
        """Places that an anchor can have in a window."""
        return self.length - self.anchor + 1

    def anchors(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class, neighbourhood hash, position) of the anchors of a text."""
        found = [self._anchors(text[s:s + SEGMENT + self.length - 1], s)
                 for s in range(0, max(1, len(text) - self.length + 1), SEGMENT)]
        if len(found) == 1:
            pos, own = found[0]
        else:
            pos, at = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
            own = np.concatenate([f[1] for f in found])[at]
        return own, self._around(text, pos, own), pos

    def _anchors(self, part: bytes, start: int) -> tuple[np.ndarray, np.ndarray]:
        k, w, n = self.anchor, self.offsets, len(part)
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        sums = _sums(np.frombuffer(part, np.uint8))
        grams = _mix((sums[k:] - sums[:-k]) * _powers(n)[1][:n - k + 1])
        # The position in the low bits makes the leftmost of equals the least.
        low = np.uint64((1 << 24) - 1)
        keyed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        m = len(keyed)
        cells = np.full(-(-m // w) * w, np.uint64(2**64 - 1))
        cells[:m] = keyed
        cells = cells.reshape(-1, w)
        before = np.minimum.accumulate(cells, axis=1).ravel()
        after = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
        pos = np.unique(np.minimum(after[:m - w + 1], before[w - 1:m]) & low).astype(np.int64)
        return pos + start, grams[pos]

    def _around(self, text: bytes, pos: np.ndarray, own: np.ndarray) -> np.ndarray:
        if not len(pos):
            return own
        a, b = np.maximum(0, pos - self.offsets + 1), np.minimum(len(text), pos + self.length)
        sizes = (pos - a).astype(np.uint64) * np.uint64(1_000_003) + (b - pos).astype(np.uint64)
        out = np.empty(len(pos), np.uint64)
        step = 1 << 12
        for i in range(0, len(pos), step):  # a long text is hashed in parts
            s, e = int(a[i]), int(b[min(i + step, len(pos)) - 1])
            sums = _sums(np.frombuffer(text[s:e], np.uint8))
            x, y = a[i:i + step] - s, b[i:i + step] - s
            out[i:i + step] = _mix((sums[y] - sums[x]) * _powers(e - s)[1][x] + sizes[i:i + step] * _MIX)
        return out

    def context(self, text: bytes, pos: int) -> tuple[bytes, bytes]:
        """The bytes before and from an anchor that its windows can hold."""
        return text[max(0, pos - self.offsets + 1):pos], text[pos:pos + self.length]


class Contexts:
    """Hashes of strings around anchors of several places at once."""

    def __init__(self, spec: Spec, classes: np.ndarray, left: list[bytes], right: list[bytes]):
        self.spec, self.classes = spec, classes.view(np.uint64)
        self.room = spec.offsets - 1
        raw = b"".join(a.rjust(self.room, b"\0") + b.ljust(spec.length, b"\0") for a, b in zip(left, right))
        self.sums = _sums(np.frombuffer(raw, np.uint8).reshape(len(left), self.room + spec.length))
        self.left = np.array([len(x) for x in left], np.int64)
        self.right = np.array([len(x) for x in right], np.int64)

    def strings(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, whether the text has them) of the strings from ``starts``
        to ``ends`` relative to the anchors: one column for each."""
        inverse = _powers(self.sums.shape[1])[1]
        h = (self.sums[:, ends + self.room] - self.sums[:, starts + self.room]) * inverse[starts + self.room]
        tag = (starts.astype(np.int64) * 4096 + ends).astype(np.uint64) * _MIX
        h = _mix(h + tag + self.classes[:, None] * np.uint64(_BASE))
        return h, (self.left[:, None] >= -starts) & (self.right[:, None] >= ends)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows, one column for each offset of the anchor."""
        starts = -np.arange(self.spec.offsets)
        return self.strings(starts, starts + self.spec.length)


Record = tuple[int, bytes, int]  # class, bytes in the order of the array, number


@dataclass
class SuffixIndex:
    """Index family of one shard: sorted arrays of geometric sizes.

    A level is (rank, suffix array, prefix array): the same places in the
    order of the bytes from their anchors and of the bytes before them."""

    spec: Spec
    levels: list[tuple[int, list[Record], list[Record]]] = field(default_factory=list)
    records: int = 0
    spans: dict[int, tuple[int, int]] = field(default_factory=dict)  # number -> offsets

    def add(self, batch: list[tuple[int, bytes, bytes]]) -> None:
        """Index (class, left, right) places and match them with all."""
        first = self.records
        self.records += len(batch)
        suffixes = sorted((c, right, first + i) for i, (c, _, right) in enumerate(batch))
        prefixes = sorted((c, left[::-1], first + i) for i, (c, left, _) in enumerate(batch))
        classes = {c for c, _, _ in batch}
        self._match(self._scan(classes, suffixes, [level[1] for level in self.levels]),
                    self._scan(classes, prefixes, [level[2] for level in self.levels]))
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, old_suffixes, old_prefixes = self.levels.pop()
            suffixes, prefixes = sorted(old_suffixes + suffixes), sorted(old_prefixes + prefixes)
            rank += 1
        self.levels.append((rank, suffixes, prefixes))

    @staticmethod
    def _scan(classes: set[int], own: list[Record], levels: list[list[Record]]) -> list[Record]:
        """One sorted array of a batch and the places of its classes in the
        levels: all are sorted runs, which ``sorted`` merges. Classes with one
        place are left out."""
        array = sorted(chain(own, *([r for r in level if r[0] in classes] for level in levels)))
        sizes = Counter(r[0] for r in array)
        return [r for r in array if sizes[r[0]] > 1]

    def _match(self, suffixes: list[Record], prefixes: list[Record]) -> None:
        start = 0
        while start < len(suffixes):
            end = min(len(suffixes), start + PART_RECORDS)
            while end < len(suffixes) and suffixes[end][0] == suffixes[end - 1][0]:
                end += 1
            # Both are in the order of the classes: the slices hold the same places.
            for number, lo, hi in repeated_offsets(self.spec, suffixes[start:end], prefixes[start:end]):
                old = self.spans.get(number, (lo, hi))
                self.spans[number] = (min(lo, old[0]), max(hi, old[1]))
            start = end


def common_prefixes(array: list[Record], width: int) -> np.ndarray:
    """Length of the common prefix of each record and the next one, of at
    most ``width`` bytes; -1 between classes."""
    width = max(1, width)
    raw = np.frombuffer(b"".join(r[1].ljust(width, b"\0") for r in array), np.uint8).reshape(-1, width)
    sizes = np.array([len(r[1]) for r in array])
    classes = np.array([r[0] for r in array], np.int64)
    differ = raw[1:] != raw[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    common = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    return np.where(classes[1:] == classes[:-1], common, -1)


def intervals(common: np.ndarray, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each ``needed`` length (a row) and record (a column): the number of
    the interval of records that share so long a prefix, and whether it holds
    more than this one."""
    cut = np.ones((len(needed), len(common) + 2), bool)
    cut[:, 1:-1] = common < needed[:, None]
    return np.cumsum(cut[:, :-1], axis=1, dtype=np.int32), ~(cut[:, :-1] & cut[:, 1:])


def repeated_offsets(spec: Spec, suffixes: list[Record], prefixes: list[Record]) -> list[tuple[int, int, int]]:
    """(number, least offset, greatest offset) of the places with a window
    that another place has too, from their suffix and prefix arrays. All of
    a place's windows hold its anchor, so the bytes they cover are one run."""
    offsets, n = np.arange(spec.offsets), len(suffixes)
    after, shared_after = intervals(common_prefixes(suffixes, spec.length), spec.length - offsets)
    before, shared_before = intervals(common_prefixes(prefixes, spec.offsets - 1), offsets)
    number = np.array([r[2] for r in suffixes])
    rank = np.empty(n, np.int64)  # of each suffix's place among the prefixes
    rank[np.argsort(number)] = np.argsort(np.array([r[2] for r in prefixes]))
    place, offset = np.nonzero((shared_after & shared_before[:, rank]).T)
    keys = (offset * (n + 1) + after[offset, place]) * (n + 1) + before[offset, rank[place]]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    place, offset = place[twice], offset[twice]  # ordered by place, then offset
    if not len(place):
        return []
    starts = np.concatenate([[0], np.nonzero(np.diff(place))[0] + 1])
    ends = np.concatenate([starts[1:], [len(place)]]) - 1
    return list(zip(number[place[starts]].tolist(), offset[starts].tolist(), offset[ends].tolist()))


def _text_key(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("tid"), F.octet_length(text).alias("n")]


def long_texts(docs: DataFrame, spec: Spec) -> DataFrame:
    """(tid, n, text) of the rows that can hold a repeated string."""
    return docs.select(*_text_key(F.col("text")), "text").where(F.col("n") >= spec.length)


def anchor_table(texts: DataFrame, spec: Spec) -> DataFrame:
    """(tid, n, pos, class, around) of every anchor of every text."""
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [spec.anchors(t.encode("utf-8", "replace")) for t in batch["text"]]
            yield pd.DataFrame({"tid": batch["tid"], "n": batch["n"], "class": [f[0].view(np.int64) for f in found],
                                "around": [f[1].view(np.int64) for f in found], "pos": [f[2].astype(np.int32) for f in found]})
    kept = stored(texts.mapInPandas(index, "tid long, n int, class array<long>, around array<long>, pos array<int>"),
                  "suffix-anchors")
    return (kept.select("tid", "n", F.explode(F.arrays_zip("class", "around", "pos")).alias("a"))
            .select("tid", "n", "a.pos", "a.class", "a.around"))


def _edges(texts: DataFrame, needed: DataFrame, spec: Spec) -> DataFrame:
    """The places of ``needed`` (tid, n, pos, class, hot) with their bytes."""
    per_text = needed.groupBy("tid", "n").agg(F.collect_list(F.struct("pos", "class", "hot")).alias("places"))
    # Copies of a text are reduced in each task, before the shuffle.
    texts = texts.groupBy("tid", "n").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for tid, n, text, places in zip(batch["tid"], batch["n"], batch["text"], batch["places"]):
                text = text.encode("utf-8", "replace")
                rows += [(tid, n, p["pos"], p["class"], p["hot"], *spec.context(text, p["pos"])) for p in places]
            yield pd.DataFrame(rows, columns=["tid", "n", "pos", "class", "hot", "left", "right"])
    return texts.join(per_text, ["tid", "n"]).mapInPandas(
        cut, "tid long, n int, pos int, class long, hot boolean, left binary, right binary")


def _indexed_spans(edges: DataFrame, spec: Spec) -> DataFrame:
    """Removed (tid, n, start, end) by the shards of the suffix index."""
    shards = max(1, -(-edges.count() // SHARD_RECORDS))

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["tid", "n", "pos"])  # the same batches in every attempt
        index = SuffixIndex(spec)
        rows = list(zip(shard["class"].tolist(), shard["left"], shard["right"]))
        for i in range(0, len(rows), BATCH_RECORDS):
            index.add(rows[i:i + BATCH_RECORDS])
        at = np.fromiter(index.spans, np.int64, len(index.spans))
        found = np.array([index.spans[i] for i in at.tolist()], np.int64).reshape(-1, 2)
        own = shard.iloc[at]
        return pd.DataFrame({"tid": own["tid"].array, "n": own["n"].array, "start": own["pos"].to_numpy() - found[:, 1],
                             "end": own["pos"].to_numpy() - found[:, 0] + spec.length})
    return (edges.withColumn("shard", F.pmod(F.xxhash64("class"), F.lit(shards))).drop("hot")
            .groupBy("shard").applyInPandas(search, "tid long, n int, start int, end int"))


def _hot_spans(edges: DataFrame, spec: Spec) -> DataFrame:
    """The same for hot classes, by counting blocks, then windows."""
    place = ["tid", "n", "pos"]
    firsts = np.arange(0, spec.offsets, BLOCK)
    lasts = np.minimum(firsts + BLOCK, spec.offsets) - 1

    def contexts(batch: pd.DataFrame) -> Contexts:
        return Contexts(spec, batch["class"].to_numpy(np.int64), list(batch["left"]), list(batch["right"]))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 4_096):
                part = batch.iloc[i:i + 4_096]
                own = contexts(part)
                core, any_fits = own.strings(-firsts, spec.length - lasts)
                whole, all_fit = own.strings(-lasts, spec.length - firsts)
                rows, block = np.nonzero(any_fits)
                out = part[place].iloc[rows].assign(block=block.astype(np.int32), core=core[rows, block].view(np.int64))
                out["whole"] = pd.array(whole[rows, block].view(np.int64), "Int64")
                out.loc[~all_fit[rows, block], "whole"] = pd.NA
                yield out
    made = stored(edges.mapInPandas(blocks, "tid long, n int, pos int, block int, core long, whole long"), "suffix-blocks")
    shared = stored(made.groupBy("core").agg(F.count("*").alias("m")).where("m > 1").select("core"), "suffix-cores")
    made = stored(made.join(shared, "core", "left_semi"), "suffix-shared")
    twice = stored(made.where("whole is not null").groupBy("whole")
                   .agg(F.count("*").alias("m"), F.min(F.struct(*place, "block")).alias("one")).where("m > 1"), "suffix-twice")
    done = made.join(twice.select("whole"), "whole", "left_semi").select(
        "tid", "n", (F.col("pos") - F.least(F.col("block") * BLOCK + BLOCK, F.lit(spec.offsets)) + 1).alias("start"),
        (F.col("pos") - F.col("block") * BLOCK + spec.length).alias("end"))
    # Undecided blocks, and one place of each decided block as their partner.
    open_ = (made.join(twice.select("whole"), "whole", "left_anti").select(*place, "block")
             .union(twice.select(*[f"one.{c}" for c in place], "one.block"))
             .groupBy(*place).agg(F.collect_set("block").alias("blocks")))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 2_048):
                part = batch.iloc[i:i + 2_048]
                wanted = np.zeros((len(part), len(firsts)), bool)
                for row, own in enumerate(part["blocks"]):
                    wanted[row, own] = True
                h, fits = contexts(part).windows()
                rows, offset = np.nonzero(fits & np.repeat(wanted, BLOCK, axis=1)[:, :spec.offsets])
                yield part[place].iloc[rows].assign(offset=offset.astype(np.int32), key=h[rows, offset].view(np.int64))
    counted = stored(edges.drop("hot").join(open_, place)
                     .mapInPandas(windows, "tid long, n int, pos int, offset int, key long"), "suffix-windows")
    again = stored(counted.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "suffix-again")
    rest = (counted.join(again, "key", "left_semi").groupBy(*place)
            .agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"))
            .select("tid", "n", (F.col("pos") - F.col("hi")).alias("start"),
                    (F.col("pos") - F.col("lo") + spec.length).alias("end")))
    return done.union(rest)


def repeated_spans(texts: DataFrame, rows: DataFrame, spec: Spec = Spec(), hot: int = HOT) -> DataFrame:
    """(tid, n, spans) of the ``texts`` with repeated strings, from the anchors
    ``rows`` in them; the spans of (start, end) bytes may overlap.

    Aggregates are stored before the rows they came from are joined to them:
    both sides of a join are then plain exchanges, whose hot partitions (a
    class, a neighbourhood, a text of very many places) AQE splits."""
    classes = rows.groupBy("class").agg(F.count("*").alias("m"), F.min("around").alias("a"), F.max("around").alias("b"))
    classes = stored(classes.where("m > 1").select("class", (F.col("a") != F.col("b")).alias("mixed")), "suffix-classes")
    rows = stored(rows.join(classes, "class"), "suffix-rows")
    # Neighbourhoods found twice: every window in them is repeated.
    key = ["class", "around"]
    seen = stored(rows.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1").select(*key), "suffix-seen")
    whole = rows.join(seen, key, "left_semi").select(
        "tid", "n", F.greatest(F.lit(0), F.col("pos") - spec.offsets + 1).alias("start"),
        F.least(F.col("n"), F.col("pos") + spec.length).alias("end"))
    # One place of each neighbourhood, in classes that have several.
    one = stored(rows.where("mixed").groupBy(*key).agg(F.min(F.struct("tid", "n", "pos")).alias("p")), "suffix-places")
    sizes = stored(one.groupBy("class").agg((F.count("*") > hot).alias("hot")), "suffix-sizes")
    needed = one.join(sizes, "class").select("p.tid", "p.n", "p.pos", "class", "hot")
    edges = stored(_edges(texts, needed, spec), "suffix-edges")
    spans = whole.union(_indexed_spans(edges.where("not hot"), spec)).union(_hot_spans(edges.where("hot"), spec))
    return spans.groupBy("tid", "n").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


class SuffixStore:
    """Index family of a collection that grows, in the shared folder.

    Each level is a table of anchors (tid, n, pos, class, around) in buckets
    sorted by class; the texts are kept beside, as given. ``levels`` and
    ``texts`` name the tables, all that a later session needs."""

    def __init__(self, spark: SparkSession, spec: Spec = Spec(), hot: int = HOT, buckets: int | None = None,
                 levels: list[tuple[int, str]] | None = None, texts: list[str] | None = None):
        self.spark, self.spec, self.hot = spark, spec, hot
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels, self.texts = list(levels or []), list(texts or [])

    def _write(self, rows: DataFrame, by: str) -> str:
        name = f"suffix_{uuid.uuid4().hex}"
        (rows.repartition(self.buckets, by).write.bucketBy(self.buckets, by).sortBy(by)
         .option("path", scratch_path(self.spark, "suffix-level")).saveAsTable(name))
        return name

    def add(self, docs: DataFrame) -> DataFrame:
        """Index a batch of documents. Returns (tid, n, spans) of what is
        repeated now because of it, in its texts and in earlier ones."""
        texts = long_texts(docs, self.spec)
        own = self._write(anchor_table(texts, self.spec), "class")
        rows = self.spark.table(own)
        classes = rows.select("class").distinct()
        for _, level in self.levels:
            rows = rows.unionByName(self.spark.table(level).join(classes, "class", "left_semi").select(*rows.columns))
        # Copies of a text are reduced in each task, before the shuffle.
        once = texts.groupBy("tid", "n").agg(F.first("text").alias("text"))
        self.texts.append(self._write(once, "tid"))
        known = self.spark.table(self.texts[0])
        for name in self.texts[1:]:
            known = known.unionByName(self.spark.table(name))
        spans = stored(repeated_spans(known, stored(rows, "suffix-scan"), self.spec, self.hot), "suffix-spans")
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            _, older = self.levels.pop()
            own = self._write(self.spark.table(older).unionByName(self.spark.table(own)), "class")
            rank += 1
        self.levels.append((rank, own))
        return spans


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching (start, end) spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in (spans if spans is not None else [])):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def deduplicate(docs: DataFrame, spec: Spec = Spec(), hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (the remaining bytes),
    n_removed and n_spans."""
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept, removed, count = [], [], []
            for text, spans in zip(batch["text"], batch["spans"]):
                text, runs = text.encode("utf-8", "replace"), merged(spans)
                cuts = [0, *(x for run in runs for x in run), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                removed.append(len(text) - len(kept[-1]))
                count.append(len(runs))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n"], "kept": kept,
                                "n_removed": removed, "n_spans": count})
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_text_key(F.col("text")))
    long = long_texts(docs, spec)
    spans = stored(repeated_spans(long, anchor_table(long, spec), spec, hot), "suffix-spans")
    return texts.join(spans, ["tid", "n"], "left").mapInPandas(
        remove, "doc_id long, n_bytes long, kept binary, n_removed long, n_spans long")


