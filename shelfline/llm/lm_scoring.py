"""Language-model scoring of whole documents.

Two scores per text. The base score sums ``log10((c + 1) / (N + V + 1))``
over its words (A-Z in lower case) and one end token, with the counts of
all training documents. The model score is the log10 probability of the
text under the causal self-attention model of ``attention_lm``, over the
subword ids of its words and one end, in overlapping windows.

Tasks count their own words, and a grouped sum adds the counts up. At most
``FREQUENT`` words can hold more than a ``1 / FREQUENT`` share of all
tokens; only those are broadcast, so the broadcast is bounded whatever the
corpus. The one pass over the texts stores their subword ids, which the
training and the scoring read, adds up their terms and hands on the other
words, which meet their counts in a shuffle join; by their definition none of
them is a hot key. Subwords are counted from the counts of the words.

The model learns from every training document. The subword ids are
stored in rounds dealt by hash, each a little larger than the one before.
For a round the parameters are broadcast, the tasks add up gradients and the
responsibilities by subword and expert, these sums are added by key with a
partial aggregation, and the driver, which only ever holds the model and
one such sum, makes the step. The experts start from the subword counts of
all training documents. The tokenizer is a given public file.

Defined cases: a null or empty text is just the end token; a null id is
hashed as the empty string; repeated rows are scored one by one; without
training documents every count is 0; an empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .attention_lm import DIM, EOS, EXPERTS, Model, Sums
from .common import Memo, stored

FREQUENT = 200_000
MIN_ROUNDS, MAX_ROUNDS = 48, 96
ROUND_WORDS = 1_000_000  # a round more for each, between the two bounds
RATE = 0.1
TASK_TOKENS = 500_000  # subwords that make a task of a round worth while
CACHE_WORDS = 500_000  # per generation and Python worker
COUNTED_WORDS = 500_000  # different words that a task counts before it hands them on
CHUNK_WORDS = 40_000
END = ""  # no word is empty


def _crc(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def held_out(doc_id: Column) -> Column:
    return _crc(doc_id) % 7 == 2


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case; other white space than
    ASCII's belongs to the words."""
    return (text or b"").lower().split()


def split_words(text: str | None) -> list[str]:
    return [w.decode("utf-8") for w in lower_words((text or "").encode("utf-8", "replace"))]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over ``docs``, with one END token per document."""
    def rows(found: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in found], "c": list(found.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Counter()
        for batch in batches:
            for text in batch["text"]:
                found.update(lower_words(text))
                if len(found) >= COUNTED_WORDS:
                    yield rows(found)
                    found = Counter()
            found[END.encode()] += len(batch)
        if found:
            yield rows(found)
    return (docs.select(F.col("text").cast("binary").alias("text")).mapInPandas(count, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


class Subwords:
    """Subword ids of words, as bytes of 16-bit numbers, for recent words."""

    def __init__(self, model_path: str, cache: int = CACHE_WORDS):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        if self.model.get_piece_size() > 1 << 16:
            raise ValueError("subword ids must fit in 16 bits")
        self.known = Memo(self._word, cache)

    def _word(self, word: bytes) -> bytes:
        return array("H", self.model.encode(word.decode("utf-8", "replace"))).tobytes()

    def joined(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.known.__getitem__, words))

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        return _ids(self.joined([w.encode("utf-8") for w in t]) for t in texts)


_SUBWORDS: dict[str, Subwords] = {}


def subwords(model_path: str) -> Subwords:
    if model_path not in _SUBWORDS:
        _SUBWORDS[model_path] = Subwords(model_path)
    return _SUBWORDS[model_path]


def _ids(column: Iterable[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(i, np.uint16).astype(np.int32) for i in column]


ENCODED = ("round int, row_id long, doc_id long, held_out boolean, n_tokens long, n_frequent long, "
           "frequent_score double, others array<string>, ids binary")


def _encoded(docs: DataFrame, model_path: str, rounds: int, terms: dict[str, float], out: Column) -> DataFrame:
    """Every document in one pass over its text: subword ids, the sum of the
    ``terms`` of its words, its other words, and its round. Round r gets a
    share proportional to r + 1; held ``out`` documents are in round -1."""
    place = F.xxhash64(F.lit("lm"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    share = F.pmod(place, F.lit(1 << 30)) / F.lit(float(1 << 30))
    number = F.floor((F.sqrt(1 + 4 * share * F.lit(float(rounds * (rounds + 1)))) - 1) / 2)
    number = F.least(number, F.lit(rounds - 1)).cast("int")
    shared = docs.sparkSession.sparkContext.broadcast({w.encode(): x for w, x in terms.items()})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, get = subwords(model_path), shared.value.get
        next_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a in range(0, len(batch), 512):
                rows = batch.iloc[a:a + 512]
                texts = [lower_words(t) for t in rows["text"]]
                ids = [own.joined(t) for t in texts]
                for t in texts:
                    t.append(END.encode())
                found = [list(map(get, t)) for t in texts]
                others = [[w.decode("utf-8", "replace") for w, x in zip(t, f) if x is None] for t, f in zip(texts, found)]
                yield pd.DataFrame({
                    "round": rows["round"].array, "row_id": np.arange(next_id, next_id + len(rows)),
                    "doc_id": rows["doc_id"].array, "held_out": rows["held_out"].array,
                    "n_tokens": [len(t) for t in texts], "n_frequent": [len(f) - len(o) for f, o in zip(found, others)],
                    "frequent_score": [sum(filter(None, f), 0.0) for f in found], "others": others, "ids": ids})
                next_id += len(rows)
    numbered = docs.select("doc_id", out.alias("held_out"), F.when(out, -1).otherwise(number).alias("round"),
                           F.col("text").cast("binary").alias("text"))
    return stored(numbered.mapInPandas(encode, ENCODED), "lm-encoded", by=("round",))


def _subword_counts(counts: DataFrame, model_path: str) -> np.ndarray:
    """Counts of the targets, subwords and an end of each document, from the
    ``counts`` of words."""
    vocab = subwords(model_path).model.get_piece_size()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, out = subwords(model_path).model, np.zeros(vocab, np.int64)
        for batch in batches:
            c = batch["c"].to_numpy(np.int64)
            ids = own.encode(batch["word"].tolist(), num_threads=1)
            np.add.at(out, np.fromiter(chain.from_iterable(ids), np.int64), np.repeat(c, [len(i) for i in ids]))
            out[EOS] += c[(batch["word"] == END).to_numpy()].sum()
        at = np.nonzero(out)[0]
        yield pd.DataFrame({"subword": at.astype(np.int32), "c": out[at]})
    found = counts.mapInPandas(count, "subword int, c long").groupBy("subword").agg(F.sum("c").alias("c")).collect()
    out = np.zeros(vocab, np.int64)
    for subword, c in found:
        out[subword] = c
    return out


SUM_COLUMNS = [f"s{i}" for i in range(DIM + EXPERTS)]


def _round_sums(texts: DataFrame, model: Model) -> Sums:
    """The sums of one round under the present parameters."""
    shared = texts.sparkSession.sparkContext.broadcast(model.bare())

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        sums = Sums(own)
        for batch in batches:
            ids = _ids(batch["ids"])
            for i, j in _chunks(ids):
                own.add_sums(ids[i:j], sums)
        if sums.tokens:
            keys, rows = sums.flat()
            yield pd.DataFrame(rows.astype(np.float32), columns=SUM_COLUMNS).assign(subword=keys.astype(np.int32))[["subword", *SUM_COLUMNS]]
    schema = "subword int, " + ", ".join(f"{c} float" for c in SUM_COLUMNS)
    # At most a row per subword of the vocabulary, whatever the corpus.
    found = (texts.mapInPandas(add, schema).groupBy("subword")
             .agg(*[F.sum(c).alias(c) for c in SUM_COLUMNS]).toArrow())
    shared.destroy()
    sums = Sums(model)
    values = np.array([found.column(c).to_numpy() for c in ["subword", *SUM_COLUMNS]], np.float64)
    sums.add_flat(values[0].astype(np.int64), values[1:].T)
    return sums


def train_model(docs: DataFrame, model_path: str, sample_docs: int | None = None, steps: int = MAX_ROUNDS,
                rate: float = RATE) -> Model:
    """The attention model, trained on all of ``docs`` in ``steps`` rounds.
    (``sample_docs`` is there for older callers: nothing is sampled.)"""
    counts = _subword_counts(word_counts(docs), model_path)
    return _trained(_encoded(docs, model_path, steps, {}, F.lit(False)), counts, steps, rate)


def _trained(encoded: DataFrame, counts: np.ndarray, steps: int, rate: float = RATE) -> Model:
    """The model trained on the rounds of ``encoded``, with the ``counts`` of
    their targets."""
    tokens = int(counts.sum())
    model = Model(len(counts))
    if not tokens:
        counts[EOS] = 1
    model.start(counts, steps, rate)
    for r in range(steps if tokens else 0):
        share = 2 * (r + 1) / (steps * (steps + 1))
        texts = encoded.where(F.col("round") == r).select("ids").coalesce(-int(-tokens * share // TASK_TOKENS))
        model.update(_round_sums(texts, model))
    return model.bare()


def _chunks(texts: list) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about CHUNK_WORDS words or ids."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= CHUNK_WORDS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


SCORED = ("row_id long, doc_id long, held_out boolean, n_tokens long, n_frequent long, frequent_score double, "
          "score double")


def score_documents(docs: DataFrame, model_path: str, frequent: int = FREQUENT,
                    sample_docs: int | None = None, steps: int | None = None, **fit) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score of every document. The model takes ``steps`` rounds (by default
    more on more words, within bounds)."""
    spark = docs.sparkSession
    training = docs.where(~held_out(F.col("doc_id")))
    counts = stored(word_counts(training), "lm-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    steps = steps or min(MAX_ROUNDS, max(MIN_ROUNDS, n // ROUND_WORDS))
    # At most ``frequent`` rows, by the share that each of them holds.
    top = {w: c for w, c in counts.where(F.col("c") * frequent > n).collect()}
    encoded = _encoded(docs, model_path, steps, {w: float(np.log10((c + 1) / (n + v + 1))) for w, c in top.items()},
                       held_out(F.col("doc_id")))
    shared = spark.sparkContext.broadcast(_trained(encoded, _subword_counts(counts, model_path), steps, **fit))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            ids = _ids(batch.pop("ids"))
            scores = [model.score(ids[i:j]) for i, j in _chunks(ids)]
            yield batch.assign(score=np.concatenate([*scores, np.zeros(0)]))

    scored = stored(encoded.drop("round", "others").mapInPandas(score, SCORED), "lm-scored")
    rare = counts.where(F.col("c") * frequent <= n)
    other = (encoded.select("row_id", F.explode("others").alias("word")).join(rare, "word", "left")
             .groupBy("row_id").agg(F.sum(F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(n + v + 1)))).alias("other_score"),
                                    F.count("c").alias("n_other")))
    return (scored.join(other, "row_id", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_frequent") + F.coalesce("n_other", F.lit(0))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("frequent_score") + F.coalesce("other_score", F.lit(0.0))).alias("base_score"), "score"))
