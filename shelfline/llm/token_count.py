"""Token counts by heap-and-linked-list byte-pair merging.

Counts the tokens that a sentencepiece BPE model gives a text, without
building any identifier. The symbols of a text (its characters, with a
space mark in front and for each space) form a linked list; a heap holds
the adjacent pairs that a vocabulary piece joins. The pair of the best rank
(leftmost of equals) is popped and merged until none is left. The count is
the initial symbols minus the merges; a character that is no piece counts
as its UTF-8 bytes.

A merge never crosses a boundary that no piece of the vocabulary contains:
before a space mark that follows another character, around a line feed, and
between a letter and another character. ``Counter`` checks this for the
model it loads and then merges each chunk between such boundaries on its
own, remembering the counts of recent words and chunks in two bounded
generations, so memory stays bounded.

Defined cases: a null or empty text has no tokens; special strings such as
``</s>`` inside a text are ordinary characters; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo

MARK = "▁"  # the space mark of sentencepiece
CACHE_CHUNKS = 400_000  # per generation and Python worker
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"  # Latin
SIGNS = r"\x00-\x09\x0b-@\[-`{-\x7f"  # ASCII without letters and line feed
PLAIN = re.compile(f"[{LETTERS}\\x00-\\x7f]*").fullmatch


def load_pieces(model_path: str) -> dict[str, int]:
    """Piece -> rank (0 merges first; equal scores share a rank)."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2
    model = model_pb2.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    norm, kinds = model.normalizer_spec, model_pb2.ModelProto.SentencePiece
    if (model.trainer_spec.model_type != model_pb2.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
            or norm.precompiled_charsmap or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix or not norm.escape_whitespaces
            or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
        raise ValueError(f"{model_path}: not a plain BPE model with byte fallback")
    scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
    rank = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    return {p: rank[s] for p, s in scores.items()}


class Counter:
    """Token counts of texts under one vocabulary."""

    def __init__(self, pieces: dict[str, int], cache_chunks: int = CACHE_CHUNKS):
        self.pieces = pieces
        self.size_bits = max(map(len, pieces), default=1).bit_length()
        self.words = Memo(self._count_word, cache_chunks)
        self.inner = Memo(self.count_chunk, cache_chunks // 4)
        pairs = {pair for p in pieces for pair in zip(p, p[1:])}
        # Does every space mark after another character start a chunk?
        self.by_word = not any(b == MARK != a for a, b in pairs)
        lines = "" if any("\n" in pair for pair in pairs) else "\n"
        self.chunks = re.compile(f"{MARK}*[^{MARK}{lines}]+|{MARK}+" + (f"|{lines}" if lines else "")
                                 if self.by_word else r"(?s).+")
        # Do letters and other characters never share a piece?
        self.fine = None
        if self.by_word and lines and not any(a.isalpha() != b.isalpha() for a, b in pairs if a != MARK):
            self.fine = re.compile(f"{MARK}?(?:[{LETTERS}]+|[{SIGNS}]+)|{MARK}|\n")

    def count_chunk(self, chunk: str) -> int:
        """Merge one chunk. Heap entries are integers: rank, position of the
        left symbol, and length of the joined piece, from high to low bits."""
        rank, low, high = self.pieces.get, self.size_bits, self.size_bits + 40
        sym = list(chunk)
        n = count = len(sym)
        heap = [(r << high) | (i << low) | 2
                for i, r in enumerate(map(rank, map(add, sym, sym[1:]))) if r is not None]
        if heap:
            heapify(heap)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            position, size_mask = (1 << 40) - 1, (1 << low) - 1
            while heap:
                entry = heappop(heap)
                i = (entry >> low) & position
                left, j = sym[i], after[i]
                # The pair may be gone, or changed since it was pushed.
                if not left or j >= n or len(left) + len(sym[j]) != entry & size_mask:
                    continue
                left += sym[j]
                sym[i], sym[j] = left, ""
                count -= 1
                j = after[i] = after[j]
                if j < n:
                    before[j] = i
                    joined = left + sym[j]
                    r = rank(joined)
                    if r is not None:
                        heappush(heap, (r << high) | (i << low) | len(joined))
                k = before[i]
                if k >= 0:
                    joined = sym[k] + left
                    r = rank(joined)
                    if r is not None:
                        heappush(heap, (r << high) | (k << low) | len(joined))
        for s in sym:
            if s and s not in self.pieces:  # one unknown character: its bytes
                count += len(s.encode("utf-8", "replace")) - 1
        return count

    def _count_word(self, word: str) -> int:
        """Tokens of a word that follows one space mark."""
        fine = self.fine if self.fine and PLAIN(word) else self.chunks
        parts = fine.findall(MARK + word)
        if len(parts) == 1:
            return self.count_chunk(parts[0])
        first = self.words[parts[0][1:]] if len(parts[0]) > 1 else self.inner[parts[0]]
        return first + sum(map(self.inner.__getitem__, parts[1:]))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.by_word and not (text[0] == " " or text[-1] == " " or "  " in text or MARK in text):
            return sum(map(self.words.__getitem__, text.split(" ")))
        # Runs of space marks join pieces: cut the whole marked text.
        return sum(map(self.inner.__getitem__, self.chunks.findall(MARK + text.replace(" ", MARK))))


_COUNTERS: dict[str, Counter] = {}


def counter(model_path: str) -> Counter:
    """The counter of this Python worker for one model file."""
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = Counter(load_pieces(model_path))
    return _COUNTERS[model_path]


def n_tokens(text: Column, model_path: str) -> Column:
    """Token count (long) of a text column."""
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(model_path)
        for batch in texts:
            yield pd.Series([own.count(t) for t in batch], dtype="int64")
    return count(text)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    return (docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        n_tokens(F.col("text"), model_path).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
