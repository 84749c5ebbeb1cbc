"""Fill-in-the-middle, conversation repair and line deduplication."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import CLASHES, SF001, docs_frame, odd_rows, table
from pyspark.sql import functions as F

from shelfline.llm import conversation_repair as cr
from shelfline.llm import fill_middle, line_dedup, registry


# --- fill in the middle ----------------------------------------------------------------
def fim_brute(doc_id, text):
    """n, form, prefix and middle characters, output of one document."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:i], text[i:j], text[j:]
    if h[3] % 100 < 20:
        return n, "spm", i, j - i, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", i, j - i, f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_middle_against_brute_force(spark):
    r = random.Random(5)
    rows = odd_rows() + [(100 + i, "".join(r.choice("ab<PSM>é漢😀\n") for _ in range(r.randint(0, 60)))) for i in range(300)]
    docs = docs_frame(spark, rows, extra=True).withColumn("Form", F.lit("mine"))
    done = fill_middle.fill_in_middle(docs)
    got = done.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows) and {g.form for g in got} == {"plain", "psm", "spm"}
    want = sorted((repr((d, *fim_brute(d, t))) for d, t, *_ in rows))
    assert sorted(repr((g.doc_id, g.n, g.form, g.prefix_chars, g.middle_chars, g.output)) for g in got) == want
    assert all(g.back == (g.text or "") for g in got)
    assert all(g.shard == CLASHES["shard"] for g in got) and "Form" not in done.columns
    assert fill_middle.fill_in_middle(docs.where("false")).count() == 0


@pytest.mark.parametrize("window", [1, 5, 64, 1 << 20])
def test_pieces_do_not_depend_on_the_window(window):
    texts = ["", "a", "é漢😀" * 9, "", "xyz" * 40, "😀"]
    first, second = np.array([0, 1, 4, 0, 50, 0]), np.array([0, 1, 20, 0, 50, 1])
    arr = pa.array(["skipped", *texts]).slice(1)
    got = fill_middle.cut_pieces(arr, first, second, window)
    want = [(t[:i], t[i:j], t[j:]) for t, i, j in zip(texts, first, second, strict=True)]
    assert list(zip(*(p.to_pylist() for p in got), strict=True)) == want


# --- conversation repair -----------------------------------------------------------------
def cheapest(rows):
    """Least (cost, audit) by a search over whole strings."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            return cost, audit
        want, to = ("a", 3) if state == 2 else ("u", 2)
        heapq.heappush(heap, (cost + 2, audit + "I", i, to))
        if i == len(rows):
            continue
        initial, faulty, cut = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
        if not faulty:
            if initial == want:
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, to))
            if initial == "s" and state == 0:
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, 1))
            heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, to))


def repair_brute(rows):
    """The contract's columns from (turn, role, text) rows after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, flags, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        core = re.sub(r"\A[ \t-\r]+|[ \t-\r]+\Z", "", text)
        kind = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else 3
        seen.add((role, text))
        flags.append((role[:1], kind < 2, kind == 2))
        if kind < 3:
            counts[kind] += 1
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(flags, flags[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, audit = cheapest(flags)
    out, roles, at = [], "", iter(rows)
    for edit in audit:
        _, role, text = next(at) if edit != "I" else (None, "", "")
        if edit != "D":
            out.append(role if edit == "K" else "assistant" if roles[-1:] == "u" else "user")
            roles += out[-1][0]
            out[-1] += ":" + text
    assert re.fullmatch(r"(s?(ua)+)?", roles)
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def damage_brute(rows):
    """Conversations (a list of rows each) after the contract's damage."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def test_repair_of_the_whole_table_against_brute_force(spark):
    conv = table(spark, "conversations", SF001)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in conv.collect()]
    got = {r.conv_id: tuple(r)[1:] for r in registry.op12_conversation_repair(spark, SF001).collect()}
    assert got == {k: repair_brute(v) for k, v in damage_brute(rows).items()}
    assert len({v[6] for v in got.values()}) > 10


def test_repair_of_odd_rows(spark):
    long = "word " * 50_000 + "."
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "hi."), (1, None, "system", "s."),
            (1, 2, "user", "a"), (1, 2, "user", "a"), (1, 2, "assistant", "b!"), (1, 9, "assistant", long), (2, 0, "", "x."),
            (3, 1, "tool", "\t\n"), (4, 5, "user", None), (5, 0, "user", "🙂"), (5, 1, "user", long), (5, 1, "user", long)]
    rows += [(6, i // 2, "user" if i % 2 else "assistant", f"t {i % 40}.") for i in range(300)] + [(7, 1, "user", "same.")] * 500
    schema = "conv_id long, turn int, role string, text string"
    df = spark.createDataFrame(rows, schema).withColumn("audit", F.lit("x")).withColumn("copies", F.lit("y"))
    got = {r.conv_id: tuple(r)[1:] for r in cr.digests(df).collect()}
    assert got == {k: repair_brute(v) for k, v in damage_brute(rows).items()}
    undamaged = defaultdict(list)
    for conv, turn, role, text in rows:
        undamaged[conv].append((turn, role or ("" if role == "" else " "), " " if text is None else text))
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                       hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in r.repaired).encode()).hexdigest())
           for r in cr.repair(df).collect()}
    assert got == {k: repair_brute(v) for k, v in undamaged.items()}
    assert cr.digests(df.where("false")).count() == 0


@pytest.mark.parametrize(("modulus", "nodes"), [((1 << 61) - 1, 4096), (3, 4096), ((1 << 61) - 1, 1), (3, 20)])
def test_audits_with_and_without_hash_collisions(modulus, nodes):
    r = random.Random(7)
    for _ in range(1500):
        rows = [(r.choice("suaax"), r.random() < .2, r.random() < .3) for _ in range(r.randint(0, 14))]
        program = cr.Repair(cr.Audits(modulus), nodes)
        for row in rows:
            program.row(*row)
        assert program.best() == cheapest(rows), rows


def test_long_conversations_hold_few_nodes():
    r = random.Random(8)
    rows = [(r.choice("uua"), r.random() < .1, r.random() < .2) for _ in range(20_000)]
    whole, settled, most = cr.Repair(nodes=10**9), cr.Repair(), 0
    for row in rows:
        whole.row(*row)
        settled.row(*row)
        most = max(most, len(settled.audits.up))
    assert settled.best() == whole.best() and most < 10_000 < len(whole.audits.up)


# --- line deduplication ------------------------------------------------------------------
def lines_brute(rows, min_docs=5, min_chars=40):
    """Sorted (doc_id, lines, dropped, kept text) of (doc_id, text) rows."""
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    top = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(seed, n=120, first=0):
    r = random.Random(seed)
    common = [f"{'Shared line number ' + str(i):<20} é漢 " + "x" * (18 + i) for i in range(14)]
    rows = []
    for i in range(n):
        lines = [r.choice([r.choice(common), " \t" + r.choice(common).upper() + "\r", f"own {i} {r.random()} " + "y" * 30, "short", ""])
                 for _ in range(r.randint(1, 9))]
        rows.append((first + i, "\n".join(lines)))
    return rows


def test_lines_against_brute_force(spark):
    hot = "a very common line that stands in nearly every document of all"
    rows = [(d, t + ("\n" + hot) * (d % 3)) for d, t in line_rows(3)]
    rows += [(d, t) for d, t, *_ in odd_rows()] + [(None, hot)] * 30 + [(5000, hot + "\n" + hot)] * 2 + [(4999, (hot + "\n") * 3000)]
    docs = docs_frame(spark, rows, extra=True).withColumn("KEPT", F.lit(1)).withColumn("k1", F.lit("z"))
    for batches, fan_in in ((1, 2), (4, 2), (7, 3)):
        done = line_dedup.deduplicate(docs, batches=batches, fan_in=fan_in)
        got = done.collect()
        assert sorted(((g.doc_id, g.n_lines, g.n_dropped, g.kept) for g in got), key=repr) == lines_brute(rows)
        assert all(g.lines == CLASHES["lines"] and g.k1 == "z" for g in got) and "KEPT" not in done.columns
    assert line_dedup.deduplicate(docs.where("false")).count() == 0


def test_runs_are_disjoint_and_batches_can_be_added(spark):
    rows = line_rows(9)
    index = line_dedup.LineRuns(spark, fan_in=2)
    for part in range(3):
        docs = docs_frame(spark, [x for x in rows if x[0] % 3 == part])
        index.add(line_dedup.key_lines(docs, batches=1))
        keys = [tuple(r) for run in index.runs() for r in run.select("k1", "k2").collect()]
        assert len(keys) == len(set(keys))
    assert [len(level) for level in index.levels] == [1, 1]
    more = line_rows(10, first=1000)
    index.add(line_dedup.key_lines(docs_frame(spark, more), batches=1))
    assert [len(level) for level in index.levels] == [0, 0, 1]
    everything = line_dedup.LineRuns(spark)
    everything.add(line_dedup.key_lines(docs_frame(spark, rows + more), batches=1))
    want = sorted(tuple(r) for r in everything.frequent(5).collect())
    assert sorted(tuple(r) for r in index.frequent(5).collect()) == want and len(want) == 28  # É is not lower-cased


def test_batches_merge_with_runs_without_shuffle(spark):
    index = line_dedup.LineRuns(spark)
    index.add(line_dedup.key_lines(docs_frame(spark, line_rows(1)), batches=1))
    batch = index._write_run(line_dedup.key_lines(docs_frame(spark, line_rows(2)), batches=1).select("k1", "k2"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = spark.table(batch).join(index.runs()[0].select("k1", "k2"), ["k1", "k2"], "left_anti")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
