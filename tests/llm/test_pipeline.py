"""The corpus pipeline against plain-Python versions of its stages."""

import brute
from conftest_llm import CLASHES, SF001, docs_frame, odd_rows, table
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import decontamination, mixing, quality_rules, simhash
from test_table_operators import _domain, _weight


def test_pipeline_against_brute_force(spark):
    docs = [tuple(r) for r in table(spark, "documents").select("doc_id", "text", "lang", "source").collect()]
    trusted = {r.doc_id for r in table(spark, "labels").where("quality = 1 and toxic = 0").collect()}
    kept = brute.quality([d[:2] for d in docs], trusted, quality_rules.BUCKETS, quality_rules.PRIOR, quality_rules.THRESHOLD)
    docs = [d for d, k in zip(docs, kept) if k[2]]
    n_quality = len(docs)
    label = brute.groups([brute.fingerprint(d[1]) for d in docs])
    first = {}
    for d, g in zip(docs, label):
        if g not in first or d[0] < first[g][0]:
            first[g] = d
    docs = sorted(first.values())
    n_simhash = len(docs)
    items = [decontamination.normalise(r.text) for r in table(spark, "benchmark").collect()]
    docs = [d for d in docs if not any(i in decontamination.normalise(d[1]) for i in items)]
    assert len(docs) < n_simhash < n_quality
    tokens = {}
    for _, text, lang, source in docs:
        leaf = (_domain(source), lang, source)
        tokens[leaf] = tokens.get(leaf, 0) + len(brute.words(text))
    budget = sum(tokens.values()) * mixing.BUDGET_PERCENT // 100
    mixed = brute.mix(docs, _domain, brute.leaf_budgets(tokens, budget, _weight, 1), 1, mixing.SEED)
    docs = [d[:2] for d in docs if mixed[d[0], 0]]
    want = sorted(brute.manifest(docs, 16))
    got = sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.grown_shard)
                 for r in corpus_pipeline.run(spark, SF001).collect())
    assert got == want and got


def test_stages_keep_the_columns_and_bear_odd_rows(spark):
    docs = docs_frame(spark, odd_rows(), extra=True)
    for frame in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF001)
            rows = out.collect()
            if name != "sharding":
                assert out.columns == frame.columns, name
                assert len(rows) <= frame.count()


def test_stages_keep_the_values_of_clashing_columns(spark):
    extra = {**CLASHES, "base_failed": "b", "mean_log_ratio": "m", "n_tokens": "n", "leaf_budget": "e", "doc_": "d"}
    docs = table(spark, "documents").select("*", *[F.lit(v).alias(k) for k, v in extra.items()])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.select(*extra).distinct().collect()] == [tuple(extra.values())], name


def test_repeated_rows_are_reduced_before_the_shuffle(spark):
    docs = docs_frame(spark, [(None, "the same text of many rows")] * 400 + [(1, "another one, quite different")]).repartition(8)
    out = simhash.deduplicate(docs)
    assert out.count() == 2
    tree = out._jdf.queryExecution().executedPlan().toString()
    # From the documents up: partial reduction, shuffle, final reduction; the
    # join above has no shuffle of its own on that side.
    lines = [x.strip(" :+-*()0123456789") for x in tree.splitlines()]
    partial = next(i for i, x in enumerate(lines) if "partial_first" in x)
    final = max(i for i, x in enumerate(lines[:partial]) if "functions=[first(" in x)
    between = [x for x in lines[final + 1:partial] if x.startswith("Exchange")]
    assert len(between) == 1 and "hashpartitioning(id" in between[0]
    join = max(i for i, x in enumerate(lines[:final]) if "Join" in x)
    assert not [x for x in lines[join:final] if x.startswith("Exchange")]
