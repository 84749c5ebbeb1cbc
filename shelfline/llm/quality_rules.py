"""Quality rules: hashed n-gram log-likelihood ratio, in DataFrame functions.

Base rules count words, symbols, repeated lines and words in repeated
five-word windows. A document that passes them is kept unless its text is
clearly less likely under the trusted documents than under the raw corpus: its
tokens (runs of letters and digits, runs of other signs) and pairs of
neighbouring tokens are hashed into a fixed number of buckets, two
multinomials over the buckets are estimated, one from the trusted documents
and one from every document, and the mean log ratio over the n-grams of the
document is compared with a fixed threshold. The threshold is -0.25 rather
than 0, because trusted documents are a mix of their own: prose in a language
or domain that is rarer among them than in the corpus falls a little below 0
without being worse. It was set by hand so that clean prose of all four
languages stays, not fitted to labels. The target multinomial is
smoothed towards the raw one, so unseen buckets say nothing.

Both multinomials come from one pass that counts buckets with a map-side
partial sum; scoring gets them as one constant, an array with one number
per bucket.
Windows are compared by a 64-bit hash.

Defined cases: a null or empty text has no words and fails the base rules;
each of repeated rows is judged by itself (and counted in the corpus); very
long texts are read whole; columns named like the added ones are replaced,
others are carried along; with no trusted document every ratio is 0 and the base rules decide; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, table, with_small_side, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BUCKETS = 1 << 14
PRIOR = 10_000.0  # pseudo-counts of the target multinomial
THRESHOLD = -0.25  # mean log ratio (natural logarithm) per n-gram
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body
    reads it and wherever the optimizer moves the whole expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words_: Column) -> Column:
    """Words in five-word windows that occur at least twice."""
    last = F.size(words_) - WINDOW
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        *[F.get(words_, i + j) for j in range(WINDOW)]))

    def count(ordered: Column) -> Column:
        found = F.filter(ordered, lambda x, j: (
            (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"])))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sort_array(F.transform(found, lambda x: x["i"])), start, lambda a, p: F.struct(
            (p + WINDOW).alias("end"),
            (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")), lambda a: a["n"])

    # Only texts with a repeated window sort their windows.
    repeats = _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _let(
        F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)))
    return F.coalesce(F.when(last >= 0, repeats), F.lit(0).cast("long"))


def base_counts(text: Column) -> Column:
    """Struct of the base counts of a text."""
    has_word = lambda line: F.length(_without(line, SPACES)) > 0
    text = F.coalesce(text, F.lit(""))
    return _let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        _let(F.filter(F.split(text, "\n"), has_word),
             lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words")))


def grams(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the tokens of a text and of the pairs of neighbours."""
    bucket = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")
    pairs = lambda t: F.when(F.size(t) > 1, F.transform(
        F.sequence(F.lit(0), F.size(t) - 2),
        lambda i: bucket(F.get(t, i), F.get(t, i + 1)))).otherwise(F.array().cast("array<int>"))
    return _let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0)),
                lambda t: F.concat(F.transform(t, lambda x: bucket(x)), pairs(t)))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, n_trusted: int, buckets: int = BUCKETS,
               prior: float = PRIOR) -> DataFrame:
    """One row: ``ratios``, the log ratio of every bucket in order.

    ``trusted_ids`` has distinct, non-null ``doc_id`` values.
    """
    marked = (docs.select("doc_id", "text")
              .join(with_small_side(trusted_ids.select("doc_id", F.lit(1).alias("trusted")), n_trusted), "doc_id", "left"))
    # The outer form, as the plain one would tokenise once more to filter.
    seen = marked.select("trusted", F.explode_outer(grams(F.col("text"), buckets)).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(counts, "bucket", "left").na.fill(0)
    packed = counts.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"),
        F.sum("raw").alias("r"), F.sum("target").alias("t"))
    p_raw = lambda x: (x["raw"] + 1.0) / (F.col("r") + buckets)
    ratio = lambda x: F.log((x["target"] + prior * p_raw(x)) / (F.col("t") + prior) / p_raw(x))
    return packed.select(F.transform("c", ratio).alias("ratios"))


def quality(docs: DataFrame, trusted_ids: DataFrame, n_trusted: int, buckets: int = BUCKETS,
            prior: float = PRIOR, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``docs`` (those named like an added one are replaced)
    with the base counts, ``base_failed``, ``mean_log_ratio`` and ``kept``."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "mean_log_ratio", "kept"]
    ratios = log_ratios(docs, trusted_ids, n_trusted, buckets, prior)
    # One row of a fixed size; as a folded constant it is not copied by row.
    by_bucket = F.split(F.lit(",".join(map(repr, ratios.first()["ratios"]))), ",").cast("array<double>")
    mean = _let(grams(F.col("text"), buckets), lambda g: F.when(F.size(g) > 0, F.aggregate(
        g, F.lit(0.0), lambda a, b: a + F.get(by_bucket, b)) / F.size(g)).otherwise(F.lit(0.0)))
    failed = lambda c: (c["n_words"] < MIN_WORDS) | (
        100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    verdict = _let(F.struct(base_counts(F.col("text")).alias("c"), mean.alias("m")), lambda v: F.struct(
        *[v["c"][name].alias(name) for name in added[:5]], failed(v["c"]).alias("base_failed"),
        v["m"].alias("mean_log_ratio"), (~failed(v["c"]) & (v["m"] >= threshold)).alias("kept")))
    return docs.select(*carried(docs, added), verdict.alias("verdict_")).select(
        *carried(docs, added), *[F.col(f"verdict_.{name}").alias(name) for name in added])


def trusted_documents(spark, sf_dir: str) -> tuple[DataFrame, int]:
    """Ids labelled of good quality and not toxic, and their number."""
    ids = (table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0 and doc_id is not null")
           .select("doc_id").distinct())
    return ids, ids.count()
