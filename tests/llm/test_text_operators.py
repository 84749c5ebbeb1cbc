"""Token counts, quality rules, classifier and language model."""

import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest_llm import SF001, SF01, docs_frame, odd_rows, table
from pyspark.sql import functions as F

from shelfline.llm import attention_lm as lm
from shelfline.llm import classifier, lm_scoring, quality_rules, registry, token_count

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- token counts -------------------------------------------------------------
def test_token_counts_equal_the_library_on_whole_texts(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in registry.op2_token_counts(spark, SF001).collect()}
    for r in table(spark, "documents").collect():
        n = len(sp.encode(r.text or ""))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 4096)
        assert got[r.doc_id].n_bytes == len((r.text or "").encode())


def test_token_counts_of_random_strings():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    own = token_count.Counter(token_count.load_pieces(MODEL), cache_chunks=50)
    r = random.Random(5)
    parts = [*"abcXYZ \n\t▁<>/s01é😀\x00漢​.,²", "</s>", "<s>", "<0x0A>", "  ", "the", "▁▁", "\r\n", "ing "]
    for _ in range(5000):
        s = "".join(r.choice(parts) for _ in range(r.randint(0, 30)))
        assert own.count(s) == len(sp.encode(s)), repr(s)


def test_token_counts_of_odd_rows(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = token_count.token_counts(docs_frame(spark, odd_rows(), extra=True), MODEL).collect()
    want = Counter((i, len(sp.encode(t or ""))) for i, t, *_ in odd_rows())
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert token_count.token_counts(docs_frame(spark, []), MODEL).count() == 0


# --- quality rules ----------------------------------------------------------------
def _quality(spark, docs, trusted, **kw):
    ids = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    return quality_rules.quality(docs, ids, len(trusted), **kw).collect()


def _same(row, want):
    counts, mean, kept = want
    return all(row[k] == v for k, v in counts.items()) and row.kept == kept and math.isclose(
        row.mean_log_ratio, mean, rel_tol=1e-9, abs_tol=1e-9)


def test_quality_rules_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    trusted = {r.doc_id for r in table(spark, "labels").where("quality = 1 and toxic = 0").collect()}
    want = dict(zip([i for i, _ in docs], brute.quality(
        docs, trusted, quality_rules.BUCKETS, quality_rules.PRIOR, quality_rules.THRESHOLD)))
    got = registry.op3_quality_rules(spark, SF001).collect()
    assert len(got) == len(docs)
    for row in got:
        assert _same(row, want[row.doc_id]), row


def test_quality_rules_of_odd_rows(spark):
    rows = odd_rows()
    want = brute.quality([r[:2] for r in rows], {1, 9}, 512, 50.0, -0.1)
    got = _quality(spark, docs_frame(spark, rows, extra=True), [1, 9], buckets=512, prior=50.0, threshold=-0.1)
    assert len(got) == len(rows)
    left = list(zip([r[0] for r in rows], want))
    for row in got:
        match = next(x for x in left if x[0] == row.doc_id and _same(row, x[1]))
        left.remove(match)
    assert {"shard", "turn"} <= set(got[0].asDict())  # other columns stay
    assert all(r.mean_log_ratio == 0 for r in _quality(spark, docs_frame(spark, rows), []))
    assert _quality(spark, docs_frame(spark, []), [1]) == []


# --- classifier --------------------------------------------------------------------
def test_classifier_on_held_out_labels(spark):
    got = {r.doc_id: r for r in registry.op7_classifier(spark, SF01).collect()}
    docs = {r.doc_id for r in table(spark, "documents", SF01).collect()}
    assert set(got) == docs
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in table(spark, "labels", SF01).collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.93
    assert {p for p, _ in held} == {q for _, q in held} == {0, 1}


def test_ftrl_against_plain_python():
    r = random.Random(2)
    rows = [([r.randrange(12) for _ in range(r.randint(0, 9))], r.randint(0, 1)) for _ in range(80)]
    model = classifier.Ftrl(12)
    z, n = [0.0] * 13, [0.0] * 13

    def weight(i):
        if abs(z[i]) <= classifier.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * classifier.L1) / ((classifier.BETA + math.sqrt(n[i])) / classifier.ALPHA + classifier.L2)
    for _ in range(3):
        for grams, y in rows:
            x = {i: c / math.sqrt(max(1, len(grams))) for i, c in Counter(grams).items()} | {12: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / classifier.ALPHA * w[i]
                n[i] += g * g
            model.update(*classifier.vector(np.array(grams, np.int64), 12), y)
    assert np.allclose(model.weights(), [weight(i) for i in range(13)]) and any(weight(i) for i in range(12))


def test_classifier_scores_depend_on_the_text_alone(spark):
    rows = odd_rows()
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (8, 0), (None, 1), (10, None), (8, 0)], "doc_id long, label int")
    got = classifier.classify(docs_frame(spark, rows, extra=True), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
    none = classifier.classify(docs_frame(spark, rows), labels.where("false")).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert classifier.classify(docs_frame(spark, []), labels).count() == 0


def test_classifier_training_rows_are_bounded(spark, monkeypatch):
    rows = [(1, "one good text")] * 200 + [(2, f"text number {i}") for i in range(200)] + [(3, "bad one")]
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, label int")
    sizes, plain = [], classifier.Ftrl.update
    monkeypatch.setattr(classifier.Ftrl, "update", lambda self, at, x, y: (sizes.append(y), plain(self, at, x, y)))
    classifier.train(docs_frame(spark, rows), labels, max_train=20, epochs=1)
    assert len(sizes) == 20
    sizes.clear()
    classifier.train(docs_frame(spark, rows[:200] + rows[-1:]), labels, max_train=20, epochs=1)
    assert sorted(sizes) == [0, 1]


# --- language model ------------------------------------------------------------------
def _base(rows):
    toks = {i: [*brute.words(brute.lower(t)), None] for i, t in rows}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    c = Counter(w for i, ws in toks.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (out[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
            for i, ws in toks.items()}


@pytest.mark.parametrize("frequent", [200_000, 30])
def test_base_score_against_brute_force(spark, frequent):
    docs = table(spark, "documents")
    want = _base([(r.doc_id, r.text) for r in docs.collect()])
    got = lm_scoring.score_documents(docs, MODEL, frequent=frequent, sample_docs=20, steps=5).collect()
    assert len(got) == len(want)
    for r in got:
        held, n, known, train, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
        assert r.score < 0


def test_lm_scoring_of_odd_rows(spark):
    rows = odd_rows()
    got = lm_scoring.score_documents(docs_frame(spark, rows, extra=True), MODEL, sample_docs=5, steps=3).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert lm_scoring.score_documents(docs_frame(spark, []), MODEL, steps=2).count() == 0


def test_lm_scores_every_token_once_and_causally():
    model = lm.Model(50, seed=3)
    model.fit([np.arange(3, 40) % 50] * 4, steps=30, batch=8)
    text = np.random.default_rng(1).integers(3, 50, 70)
    x, y, counts = lm.windows([text, text[:0], text[:lm.STRIDE - 1]], 50)
    assert counts.tolist() == [3, 1, 1]
    assert [t for t in y.ravel().tolist() if t >= 0] == [*text, lm.EOS, lm.EOS, *text[:lm.STRIDE - 1], lm.EOS]
    # Probabilities of the next token sum to one.
    gate = model.forward(x)["gate"]
    assert np.allclose((gate @ model.experts.T).sum(2), 1, atol=1e-4)
    # Scoring takes fewer passes to the same probabilities.
    slow = (gate * model.experts[np.maximum(y, 0)]).sum(2)
    assert np.allclose(model._mixed(x, y), slow, rtol=1e-4)
    model.p["q"] *= 1000  # beyond the bound: the plain way
    assert np.allclose(model._mixed(x, y), (model.forward(x)["gate"] * model.experts[np.maximum(y, 0)]).sum(2), rtol=1e-4)
    model.p["q"] /= 1000
    # A later token changes no earlier score.
    changed = text.copy()
    changed[60] = (changed[60] + 1) % 47 + 3
    a, b = (np.log10(np.einsum("nsk,nsk->ns", model.forward(w[0])["gate"], model.experts[np.maximum(w[1], 0)])).ravel()
            for w in (lm.windows([text], 50), lm.windows([changed], 50)))
    assert np.allclose(a[:60], b[:60]) and not np.allclose(a[60:71], b[60:71])


def test_lm_gradients_and_learning():
    r = np.random.default_rng(0)
    texts = [np.tile([5, 6, 7, 8], 30)[:r.integers(40, 110)] for _ in range(40)]
    model = lm.Model(12, seed=1)
    x, y, _ = lm.windows(texts, 12)
    model.experts = r.dirichlet(np.ones(12), lm.EXPERTS).T.astype(np.float32)
    f = model.forward(x)
    joint = f["gate"] * model.experts[np.maximum(y, 0)]
    g = model._gradients(x, y, f, joint / joint.sum(2, keepdims=True))
    for name in ("q", "k", "v", "w1", "g", "pos"):
        p, at = model.p[name], (1, 2)
        old, eps = p[at], 1e-2
        p[at] = old + eps
        up = model.log_prob(x, y).sum()
        p[at] = old - eps
        down = model.log_prob(x, y).sum()
        p[at] = old
        slope = (up - down) * math.log(10) / (2 * eps) / (y >= 0).sum()
        assert math.isclose(slope, g[name][at], rel_tol=0.1, abs_tol=2e-4), name
    before = model.score(texts).sum()
    model.fit(texts, steps=150, batch=32)
    assert model.score(texts).sum() > 0.5 * before


def test_lm_learns_from_every_training_document(spark):
    words = ["apple", "river", "window", "garden", "music", "paper", "silver", "forest", "doctor", "winter",
             "bridge", "market", "candle", "engine", "island", "pencil"]
    rows = [(i, f"{words[i % 16]} {words[i * 7 % 16]} ") for i in range(60)]
    rows += [(100 + i, w * 3) for i, w in enumerate(["zebra ", "quartz ", "lagoon ", "tundra ", "violin "])]
    docs = docs_frame(spark, rows)
    model = lm_scoring.train_model(docs, MODEL, 5, steps=4)
    seen = np.unique(np.concatenate(lm_scoring.subwords(MODEL).ids([lm_scoring.split_words(t) for _, t in rows])))
    # Every subword of every document is above the share that all have.
    assert (model.experts[seen].max(1) > 2 * lm.FLOOR / model.vocab).all()


def test_lm_encodes_each_text_once(spark):
    rows = [(i, f"apple river {i} window") for i in range(40)] + [(3, "apple river 3 window"), (50, None), (51, "")]
    out = lm_scoring.held_out(F.col("doc_id"))
    docs = docs_frame(spark, rows)
    got = lm_scoring._encoded(docs, MODEL, 3, {"apple": -1.0, "river": -2.0}, out).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows) and len({r.row_id for r in got}) == len(rows)
    assert all((r.round == -1) == r.held_out and r.round < 3 for r in got) and any(r.held_out for r in got)
    own = lm_scoring.subwords(MODEL)
    for r in got:
        words = lm_scoring.split_words(dict(rows)[r.doc_id])
        assert bytes(r.ids) == own.ids([words])[0].astype("<u2").tobytes()
        assert (r.n_tokens, r.n_frequent, r.frequent_score) == (len(words) + 1, 2 if words else 0, -3.0 if words else 0)
        assert r.others == [*words[2:], lm_scoring.END]


def test_lm_sums_of_tasks_are_those_of_all_texts(spark):
    r = np.random.default_rng(4)
    texts = [r.integers(3, 200, r.integers(0, 90)).astype(np.int32) for _ in range(50)]
    model = lm.Model(200, seed=2)
    model.start(np.bincount(np.concatenate(texts), minlength=200) + 1, 3, 0.1)
    whole = lm.Sums(model)
    model.add_sums(texts, whole)
    rows = spark.createDataFrame([(t.astype("<u2").tobytes(),) for t in texts], "ids binary")
    for parts in (1, 6):
        got = lm_scoring._round_sums(rows.repartition(parts), model)
        assert got.tokens == whole.tokens == sum(len(t) + 1 for t in texts)
        assert (got.seen == whole.seen).all() and np.allclose(got.rows, whole.rows, rtol=1e-3, atol=1e-3)
        assert all(np.allclose(got.dense[k], whole.dense[k], rtol=1e-3, atol=1e-2) for k in whole.dense)
    assert math.isclose(whole.rows[:, lm.DIM:].sum(), whole.tokens, rel_tol=1e-4)


def test_lm_fast_sums_equal_the_plain_ones():
    r = np.random.default_rng(8)
    texts = [r.integers(3, 60, n) for n in (0, 1, 23, 24, 25, 70, 200)]
    model = lm.Model(60, seed=5)
    model.experts = r.dirichlet(np.ones(60), lm.EXPERTS).T.astype(np.float32)
    x, y, _ = lm.windows(texts, 60)

    def near(a, b):
        return np.abs(a - b).max() <= 1e-3 * max(1, np.abs(b).max())
    for scale in (1, 100):  # the second goes beyond the bound of exp()
        model.p["q"] *= scale
        f = model.forward(x)
        share = model._responsibility(f, y) * (y >= 0)[..., None]
        plain = model._gradient_sums(x, y, f, share)
        fast, inputs, joint = model._fast_sums(x, y)
        assert near(joint.reshape(share.shape), share) and near(inputs, plain["e"])
        assert all(near(fast[k], plain[k]) for k in fast) and {*fast, "e"} == set(plain)
        want, sums = np.zeros((61, lm.DIM + lm.EXPERTS)), lm.Sums(model)
        np.add.at(want[:, :lm.DIM], x.ravel(), plain["e"].reshape(-1, lm.DIM))
        np.add.at(want[:, lm.DIM:], np.maximum(y, 0).ravel(), share.reshape(-1, lm.EXPERTS))
        model.add_sums(texts, sums, batch=3)
        assert near(sums.rows, want) and sums.tokens == sum(len(t) + 1 for t in texts)


def test_lm_counts_words_and_their_subwords(spark):
    rows = [(i, f"Apple river\x0b{i} window\tÉTÉ APPLE") for i in range(40)] + [(50, None), (51, ""), (52, "\u2028x")]
    docs = docs_frame(spark, rows)
    texts = [brute.words(brute.lower(t)) for _, t in rows]
    counts = lm_scoring.word_counts(docs)
    assert {r.word: r.c for r in counts.collect()} == Counter(w for t in texts for w in [*t, lm_scoring.END])
    want = np.zeros(lm_scoring.subwords(MODEL).model.get_piece_size(), np.int64)
    for ids in lm_scoring.subwords(MODEL).ids(texts):
        np.add.at(want, [*ids, lm.EOS], 1)
    assert (lm_scoring._subword_counts(counts, MODEL) == want).all()
