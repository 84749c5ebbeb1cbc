"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item may occur in a document with up to k errors (6 % of its
characters). It is split into k + 1 pieces; whatever the k edits are, one
piece stays exact, so an Aho-Corasick scan for all pieces finds every
candidate place. Each place is verified with Myers' bit-parallel distance
between the item and the best substring of the window around it.

Items and texts are compared in lower case with runs of white space as one
space. The items are held in blocks of at most ``BLOCK_CHARS`` characters. A
larger benchmark takes one scan per block, each written before the next one
starts, so the driver and a worker hold one block at a time, whatever the
size of the benchmark. Documents are never shuffled.

Items shorter than ``MIN_CHARS`` (32) must occur exactly and between word
boundaries: 6 % of fewer characters is one edit or none, and with an edit
allowed, a short item ("the answer is four") would be met in clean prose.

Defined cases: null or blank items match nothing, null or blank texts hold
nothing; equal items are each reported; each of repeated document rows is
reported (or dropped) by itself; very long texts are scanned whole; other
columns of the documents, whatever their names, are kept by ``decontaminate``
and not read by ``find_items``; an empty table gives no rows, an empty
benchmark no matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

ERROR_PERCENT = 6
MIN_CHARS = 32
BLOCK_CHARS = 1_000_000


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str) -> int:
    return len(item) * ERROR_PERCENT // 100 if len(item) >= MIN_CHARS else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of k + 1 pieces of nearly equal length."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, item: str):
        self.size, self.peq = len(item), defaultdict(int)
        for i, c in enumerate(item):
            self.peq[c] |= 1 << i

    def distance(self, text: str) -> tuple[int, int]:
        """(least edit distance to a substring of ``text``, its end)."""
        full, high = (1 << self.size) - 1, 1 << (self.size - 1)
        pv, mv, score, peq = full, 0, self.size, self.peq.get
        best, end = score, 0
        for at, c in enumerate(text, 1):
            eq = peq(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph, mh = ph << 1, mh << 1
            pv = (mh | ~(xv | ph)) & full
            mv = ph & xv & full
            if score < best:
                best, end = score, at
        return best, end


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, n) for i, n in ((i, normalise(t)) for i, t in items) if n]
        self.budgets = [budget(n) for _, n in self.items]
        self.patterns: dict[int, Pattern] = {}
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, (_, item) in enumerate(self.items):
            for offset, piece in pieces(item, self.budgets[at]):
                places[piece].append((at, offset + len(piece)))
        self.automaton = None
        if places:
            self.automaton = ahocorasick.Automaton()
            for piece, where in places.items():
                self.automaton.add_word(piece, where)
            self.automaton.make_automaton()

    def _verify(self, text: str, at: int, start: int, last: int) -> tuple[int, int] | None:
        """Best (distance, end) of an item that starts between two places."""
        item, k = self.items[at][1], self.budgets[at]
        if not k:
            if len(item) >= MIN_CHARS:
                return 0, start + len(item)
            end = start + len(item)
            whole = not (text[start - 1:start].isalnum() or text[end:end + 1].isalnum())
            return (0, end) if whole else None
        if at not in self.patterns:
            self.patterns[at] = Pattern(item)
        begin = max(0, start - k)
        distance, end = self.patterns[at].distance(text[begin:last + len(item) + k])
        return (distance, begin + end) if distance <= k else None

    def matches(self, text: str | None, first: bool = False) -> list[tuple[int | None, int, int]]:
        """(item id, least distance, end in the normalised text) of every item
        found; with ``first``, of one of them."""
        text = normalise(text)
        if not text or self.automaton is None:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, where in self.automaton.iter(text):
            for at, piece_end in where:
                starts[at].add(end + 1 - piece_end)
        out = []
        for at in sorted(starts):
            best = None
            k, todo = self.budgets[at], sorted(starts[at])
            i = 0
            while i < len(todo) and (best is None or best[0]):
                j = i  # hits of one occurrence start within 2k of each other
                while k and j + 1 < len(todo) and todo[j + 1] - todo[j] <= k:
                    j += 1
                found = self._verify(text, at, todo[i], todo[j])
                if found and (best is None or found < best):
                    best = found
                i = j + 1
            if best:
                out.append((self.items[at][0], *best))
                if first:
                    break
        return out


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[int, Iterator[list[tuple[int | None, str]]]]:
    """The number of blocks of about ``block_chars`` characters, and each of
    them (collected when it is its turn)."""
    items = benchmark.select("item_id", "text").where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, ([tuple(r) for r in items.where(block == b).orderBy("item_id", "text").collect()] for b in range(n))


_LATEST: list = [None, None]  # the last block of this Python worker, and its matcher


def _matcher(shared) -> Matcher:
    if _LATEST[0] is not shared.value:
        _LATEST[:] = [shared.value, Matcher(shared.value)]
    return _LATEST[1]


def find_items(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance,
    end_char (in the normalised text)."""
    spark, found = docs.sparkSession, None
    n, parts = blocks(benchmark, block_chars)
    for items in parts:
        shared = spark.sparkContext.broadcast(items)

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            matcher = _matcher(shared)
            for batch in batches:
                rows = [(doc, *m) for doc, text in zip(batch["doc_id"], batch["text"]) for m in matcher.matches(text)]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "end_char"]).convert_dtypes()
        part = docs.select("doc_id", "text").mapInPandas(scan, "doc_id long, item_id long, distance int, end_char int")
        if n > 1:
            part = stored(part, "benchmark-found")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def _clean(shared):
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = _matcher(shared)
        for batch in texts:
            yield pd.Series([not matcher.matches(t, first=True) for t in batch], dtype=bool)
    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows in which an item is found."""
    spark = docs.sparkSession
    n, parts = blocks(benchmark, block_chars)
    for items in parts:
        shared = spark.sparkContext.broadcast(items)
        docs = docs.where(_clean(shared)("text"))
        if n > 1:
            docs = stored(docs, "benchmark-free")
            shared.destroy()
    return docs
