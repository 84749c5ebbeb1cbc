"""Small tables for the operator tests."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Columns that documents may carry beside their own, named like columns that
# the operators use or add.
CLASHES = {"shard": "7", "epoch": "8", "kept": "x", "n_words": "y", "row": "r", "path": "p", "tokens": "t", "w": "w",
           "fingerprint": "f", "group": "g", "id": "i", "h": "h", "turn": "u", "taken": "v", "Domain": "D", "lines": "l"}


def docs_frame(spark, rows, extra=False):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src1",
             len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(v).alias(k) for k, v in CLASHES.items()])
    return df


def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    prose = "the quick brown fox jumps over the lazy dog while seven wise wizards watch from a quiet hill"
    return [(1, prose), (1, prose), (2, prose), (3, None), (4, ""), (5, " \t\n"), (None, prose + " again"), (None, None),
            (6, prose * 3000), (7, "a" * 100_000), (8, "w " * 20_000), (9, "naïve café 漢字 😀 " + prose, None, None),
            (10, prose.upper(), "de", "src2"), (11, "x", "fr", ""), (6, prose * 3000)]


def table(spark, name, sf=SF001):
    return spark.read.parquet(f"{sf}/{name}.parquet")
