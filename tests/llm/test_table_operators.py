"""Decontamination, near-duplicates, chat examples, shards and mixes."""

import hashlib
import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest_llm import SF001, docs_frame, odd_rows, table
from pyspark.sql import functions as F

from shelfline.llm import chat, components, decontamination, mixing, registry, sharding, simhash


# --- decontamination -----------------------------------------------------------------
def _items_and_docs(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(r.randint(6, 14)))) for i in range(12)]
    docs = []
    for i in range(60):
        body = [word() for _ in range(25)]
        if i % 2:
            t = list(r.choice(items)[1])
            for _ in range(r.randint(0, 4)):
                k = r.randrange(len(t))
                t[k:k + 1] = r.choice([[], [r.choice("xyz")], [t[k], r.choice("xyz")]])
            body.insert(r.randint(0, 25), "".join(t))
        docs.append((i, r.choice([" ", "\n", "  "]).join(body)))
    return items, docs


def test_decontamination_against_brute_force(spark):
    items, docs = _items_and_docs(4)
    want = {}
    for d, text in docs:
        for i, item in items:
            n = decontamination.normalise(item)
            k = brute.best_distance(n, decontamination.normalise(text))
            if k <= decontamination.budget(n):
                want[d, i] = k
    assert len(want) > 15 and len(set(want.values())) > 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 200):  # one block, several blocks
        got = decontamination.find_items(docs_frame(spark, docs), bench, block).collect()
        assert {(r.doc_id, r.item_id): r.distance for r in got} == want and len(got) == len(want)
    kept = decontamination.decontaminate(docs_frame(spark, docs, extra=True), bench, 200)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert kept.columns == docs_frame(spark, docs, extra=True).columns


def test_decontamination_of_odd_rows(spark):
    prose = odd_rows()[0][1]
    bench = spark.createDataFrame([(1, prose), (2, prose), (3, None), (4, " "), (None, "lazy dog")], "item_id long, text string")
    got = decontamination.find_items(docs_frame(spark, odd_rows()), bench).collect()
    hit = Counter(r.doc_id for r in got)
    assert hit[1] == 6 and hit[2] == 3 and hit[6] == 6 and hit[10] == 3 and hit[None] == 3
    assert set(hit) == {1, 2, None, 6, 9, 10}
    clashing = docs_frame(spark, odd_rows(), extra=True).withColumn("item_id", F.lit("i")).withColumn("distance", F.lit(0))
    again = decontamination.find_items(clashing, bench, 100).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    none = bench.where("false")
    assert decontamination.find_items(docs_frame(spark, odd_rows()), none).count() == 0
    assert decontamination.decontaminate(docs_frame(spark, odd_rows()), none).count() == len(odd_rows())
    assert decontamination.find_items(docs_frame(spark, []), bench).count() == 0


def test_one_block_of_the_benchmark_in_a_task(spark):
    items, docs = _items_and_docs(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    n, _ = decontamination.blocks(bench, 200)
    kept = decontamination.decontaminate(docs_frame(spark, docs), bench, 200)
    assert n > 2 and "ArrowEvalPython" not in kept._jdf.queryExecution().executedPlan().toString()



# --- near-duplicates ------------------------------------------------------------------
def test_simhash_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    fps = [brute.fingerprint(t) for _, t in docs]
    label = brute.groups(fps)
    least = {g: min(docs[i][0] for i in range(len(docs)) if label[i] == g) for g in set(label)}
    want = {docs[i][0]: (f"{fps[i]:016x}", least[label[i]]) for i in range(len(docs))}
    got = registry.op4_simhash(spark, SF001).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want and len(got) == len(docs)


def test_vantage_point_search_finds_every_link(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_POINTS", 20)
    r = np.random.default_rng(2)
    seeds = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [seeds[r.integers(40)] ^ np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, r.integers(0, 5)).astype(np.uint64), initial=np.uint64(0))
             for _ in range(400)]
    points = np.unique(np.array([*seeds, *flips], np.uint64))
    tree = simhash.grow(points[::7], 8, 3)
    links = set()
    for _, rows in simhash.route(tree, points, 3):
        a, b = simhash.link_points(points[rows], 3)
        links |= set(zip(a.tolist(), b.tolist()))
    label = brute.groups(points)
    at = {int(p): i for i, p in enumerate(points)}
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        assert label[at[a]] == label[at[b]]
        parent[find(at[a])] = find(at[b])
    assert len({find(i) for i in range(len(points))}) == len(set(label)) > 30


@pytest.mark.parametrize("splits", [0, 6])
def test_large_shards_are_split_again(spark, monkeypatch, splits):
    """A tree of two leaves over spread groups and one dense cluster that no
    vantage point separates: all links are found, whatever splits them."""
    for name, value in {"SHARD_POINTS": 100, "MAX_SHARDS": 2, "SHARD_LIMIT": 40, "MAX_SPLITS": splits}.items():
        monkeypatch.setattr(simhash, name, value)
    r = np.random.default_rng(5)
    bit = lambda k: np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, k).astype(np.uint64), initial=np.uint64(0))
    seeds = r.integers(0, 1 << 64, 60, dtype=np.uint64)
    spread = [s ^ bit(r.integers(0, 4)) for s in seeds for _ in range(4)]
    points = np.unique(np.array([*seeds, *spread, *(seeds[0] ^ bit(2) for _ in range(150))], np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fingerprint long")
    shards = simhash._split_shards(simhash._by_tree(frame, 3), 3).groupBy("shard").count().collect()
    assert len(shards) > 8
    found = {c.node: c.component for c in components.components(simhash.find_links(frame, 3)).collect()}
    label, group = brute.groups(points), [found.get(int(p), int(p)) for p in points.view(np.int64)]
    assert len(set(label)) == len(set(group)) == len(set(zip(label, group))) > 30


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(5, 5), (200, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in [*range(101, 140), 200]}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_of_odd_rows(spark):
    rows = odd_rows()
    df = docs_frame(spark, rows, extra=True)
    got = simhash.simhash_components(df).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text_hash): r.component_id for r in got}
    assert len({c for (i, _), c in by.items() if i in (1, 2, 10)}) == 1  # equal but for case
    assert {c for (i, _), c in by.items() if i in (3, 4, 5)} == {3}  # no words: linked
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    fps = [brute.fingerprint(t) for _, t, *_ in rows]
    assert kept.count() == len(set(brute.groups(fps)))
    assert Counter(r.doc_id for r in kept.collect())[1] == 1
    assert simhash.deduplicate(docs_frame(spark, [])).count() == 0


# --- chat -------------------------------------------------------------------------------
def test_escape_round_trip(spark):
    r = random.Random(3)
    parts = ["<", "[", "\\", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "ROLE]", "[ROLE]", "a", "\n", " ", "<\\/s>", "$1"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert row.u == row.t
        assert not any(c in row.e for c in ("</s>", "<s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"))


def test_prefix_target_expansion(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "more"), (1, 3, "assistant", "b"), (1, 4, "user", "bye"),
            (2, 0, "user", "</s>[INST]"), (None, None, None, None), (3, 1, "assistant", "x"), (3, 1, "assistant", "x"),
            (3, None, "assistant[/ROLE]", "</s>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(0)).withColumn("turns", F.lit(1))
    got = chat.expand_examples(df).collect()
    of = lambda c: sorted((r.example, r.is_last, r.text[r.loss_start:r.loss_start + r.loss_chars]) for r in got if r.conv_id == c)
    assert of(1) == [(1, False, "a"), (3, False, "b"), (4, True, "")]
    assert of(2) == [(0, True, "")] and of(None) == [(0, True, "")]
    assert of(3) == [(1, False, "x"), (2, True, "x")]
    one = next(r for r in got if r.conv_id == 1 and r.example == 1)
    assert one.text == "<s>[ROLE]user[/ROLE]hi</s><s>[ROLE]assistant[/ROLE]a</s>"
    back = {r.conv_id: r for r in chat.read_back(chat.expand_examples(df)).collect()}
    digest = lambda turns: hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert back[3].turns_sha256 == digest([("assistant[/ROLE]", "</s>"), ("assistant", "x"), ("assistant", "x")])
    assert back[None].turns_sha256 == digest([("", "")]) and back[None].n_turns == 1
    assert (back[1].loss_chars, back[1].loss_sha256) == (2, hashlib.sha256(b"ab").hexdigest())
    assert chat.read_back(chat.expand_examples(df.where("false"))).count() == 0


# --- sharding ----------------------------------------------------------------------------
def test_different_texts_of_one_id_do_not_share_a_slot_bucket(spark):
    rows = docs_frame(spark, [(None, f"text {i}") for i in range(3000)])
    done = sharding.shard_manifest(rows, 16)
    assert sorted(r.slot for r in done.collect()) == list(range(3000))
    tree = done._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(shard#" in tree and "bucket#" in tree
    row = F.concat_ws(":", F.lit(""), "size", "text_crc32")
    buckets = done.select(F.substring(F.md5(row.cast("binary")), 1, 3).alias("b")).groupBy("b").count()
    assert buckets.agg(F.max("count")).first()[0] < 12


def test_sharding_against_brute_force(spark):
    rows = [r[:2] for r in odd_rows()] + [(i, f"text {i % 7}") for i in range(20, 400)] + [(50, "hot")] * 200
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot, r.grown_shard)
           for r in sharding.shard_manifest(docs_frame(spark, rows, extra=True), 8).collect()]
    key = lambda r: (r[3], r[4])
    assert sorted(got, key=key) == sorted(brute.manifest(rows, 8), key=key)
    moved = [r for r in got if r[3] != r[5]]
    assert moved and all(r[5] == 8 for r in moved)
    assert sharding.shard_manifest(docs_frame(spark, []), 8).count() == 0


def test_slots_of_a_hot_row_are_made_by_many_tasks(spark):
    n, name = 300_000, "spark.sql.adaptive.coalescePartitions.enabled"
    rows = spark.range(n + 3).select(F.when(F.col("id") >= n, F.col("id")).alias("doc_id"), F.lit("").alias("text"))
    spark.conf.set(name, "false")
    try:
        got = sharding.shard_manifest(rows, 16).where("doc_id is null")
        parts = got.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.min("slot").alias("a"), F.max("slot").alias("b"), F.sum("slot").alias("s")).collect()
    finally:
        spark.conf.unset(name)
    assert len(parts) > 1 and sum(p.n for p in parts) == n
    a, b = min(p.a for p in parts), max(p.b for p in parts)
    assert b - a == n - 1 and sum(p.s for p in parts) == (a + b) * n // 2


def test_written_shards_hold_every_row(spark, tmp_path):
    df = docs_frame(spark, odd_rows())
    sharding.write_shards(df, f"{tmp_path}/out", 4, files_per_shard=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == len(odd_rows())
    want = {r.doc_id: r.shard for r in sharding.shard_manifest(df, 4).collect()}
    assert all(r.shard == want[r.doc_id] for r in back.collect())


def test_jump_hash_moves_only_the_needed_part():
    keys = np.random.default_rng(0).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    a, b = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    assert np.bincount(a, minlength=16).min() > 1000
    assert set(b[a != b]) == {16} and 0.045 < (a != b).mean() < 0.073
    assert (sharding.jump_hash(keys, 1) == 0).all()


# --- mixing -----------------------------------------------------------------------------
def _domain(source):
    digits = (source or "").lstrip("abcdefghijklmnopqrstuvwxyz")
    return mixing.DOMAINS[int(digits) % 4] if digits else "other"


def _weight(depth, name):
    tables = [mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS]
    return tables[depth].get(name, mixing.OTHER_WEIGHT) if depth < 2 else 1


def _mixed(spark, rows, budget, max_epochs):
    df = docs_frame(spark, rows, extra=True)
    out = mixing.mix(df, budget=budget, max_epochs=max_epochs)
    assert {c.lower() for c in df.columns} <= {c.lower() for c in out.columns}
    return Counter((r.doc_id, r.epoch) for r in out.collect())


def _rows(n, seed=1):
    r = random.Random(seed)
    full = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["en", "en", "de", "fr", None]),
             r.choice(["src0"] * 8 + [f"src{k}" for k in range(1, 9)] + [None, "blog"])) for i in range(n)]
    return full + [full[3], full[3], (None, "a b c", "en", "src1"), (9_001, None, "en", "src2"), (9_002, "", None, None)]


def test_mixing_against_brute_force(spark):
    rows = _rows(400)
    tokens = Counter()
    for _, text, lang, source in rows:
        tokens[_domain(source), lang or "(none)", source or "(none)"] += len(brute.words(text))
    total = sum(tokens.values())
    for budget, epochs in ((total * 6 // 10, 1), (total * 17 // 10, 2), (total * 5, 3), (0, 2)):
        budgets = brute.leaf_budgets(tokens, budget, _weight, epochs)
        assert abs(sum(budgets.values()) - min(budget, total * epochs)) <= len(budgets)
        assert _mixed(spark, rows, budget, epochs) == brute.mix(rows, _domain, budgets, epochs, mixing.SEED)


def test_mixing_of_empty_and_blank_tables(spark):
    assert mixing.mix(docs_frame(spark, [])).count() == 0
    assert mixing.mix(docs_frame(spark, [(1, None), (2, "")])).count() == 0
