"""Suffix-array deduplication against all windows counted by brute force."""

import hashlib
import random
from collections import Counter

import pytest
from conftest_llm import docs_frame

from shelfline.llm import suffix_dedup as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(hit) if x and not (i and hit[i - 1]))
        kept = bytes(c for c, x in zip(d, hit) if not x)
        out.append((len(d), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


def made_texts(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé ") for _ in range(r.randint(2, 9)))
    passages = [" ".join(word() for _ in range(r.randint(6, 30))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 25))) for _ in range(3)]
        if r.random() < 0.6:
            parts[1:1] = [r.choice(passages)]
        if r.random() < 0.3:
            p = r.choice(passages)
            parts.append(p[r.randint(0, 20):r.randint(30, 200)])
        texts.append("".join(parts))
    texts += [None, "", "x" * 300, "ab" * 90, texts[0], texts[1], texts[1], texts[2][:60], texts[2][5:] + "!"]
    return texts


def run(spark, texts, spec, hot):
    df = docs_frame(spark, [(i, t) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
           for r in S.deduplicate(df, spec, hot).collect()}
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 2), (3, 0)])
def test_matches_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(S, "BATCH_RECORDS", 7)
    monkeypatch.setattr(S, "SEGMENT", 64)
    texts = made_texts(seed, 60)
    assert run(spark, texts, S.Spec(48, 20), hot) == brute(texts, 48)


def test_index_levels_are_geometric():
    index = S.SuffixIndex(S.Spec(48, 20))
    for i in range(11):
        index.add([(j, b"", b"%d" % (i * 10 + j)) for j in range(4)])
    assert [r for r, _, _ in index.levels] == [3, 1, 0]
    assert [len(a) for _, a, _ in index.levels] == [32, 8, 4]
    assert all(a == sorted(a) and b == sorted(b) for _, a, b in index.levels)


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_index_matches_by_suffix_order_whatever_the_batches(batch):
    """Places of two classes, with bytes that sort low and short contexts at
    the ends of a text, against the windows themselves."""
    r = random.Random(batch)
    spec, places = S.Spec(12, 5), []
    for c in (3, 5):
        anchor = bytes([c]) * 5
        sides = [bytes(r.choice(b"\0\0\0a") for _ in range(r.randint(0, 7))) for _ in range(40)]
        places += [(c, r.choice(sides), anchor + r.choice(sides)) for _ in range(80)]
    places.append((9, b"x" * 7, b"y" * 12))
    index = S.SuffixIndex(spec)
    for i in range(0, len(places), batch):
        index.add(places[i:i + batch])
    windows = {}
    for i, (c, left, right) in enumerate(places):
        for o in range(spec.offsets):
            if o <= len(left) and spec.length - o <= len(right):
                windows.setdefault((c, left[len(left) - o:] + right[:spec.length - o], o), []).append(i)
    want = {}
    for (_, _, o), found in windows.items():
        for i in found if len(found) > 1 else []:
            want[i] = (min(o, want.get(i, (o, o))[0]), max(o, want.get(i, (o, o))[1]))
    assert want and index.spans == want


def test_later_batches_join_a_stored_index(spark):
    """Spans of three batches added one after another equal brute force over
    all texts; a store opened from its table names goes on."""
    spec, texts = S.Spec(48, 20), made_texts(8, 45)
    docs = [(i, t) for i, t in enumerate(texts)]
    store = S.SuffixStore(spark, spec, hot=8, buckets=2)
    found = {}
    for start in range(0, len(docs), 20):
        if start == 40:
            store = S.SuffixStore(spark, spec, hot=8, buckets=2, levels=store.levels, texts=store.texts)
        for row in store.add(docs_frame(spark, docs[start:start + 20])).collect():
            found.setdefault((row.tid, row.n), []).extend(row.spans)
    assert [rank for rank, _ in store.levels] == [1, 0]
    keys = docs_frame(spark, docs).select("doc_id", *S._text_key(S.F.col("text"))).collect()
    got = {k.doc_id: S.merged(found.get((k.tid, k.n))) for k in keys}
    want = brute(texts, 48)
    assert [(sum(b - a for a, b in got[i]), len(got[i])) for i in range(len(texts))] == [(w[1], w[2]) for w in want]


def test_empty_table(spark):
    assert S.deduplicate(docs_frame(spark, [])).count() == 0


def test_registered_sizes_null_ids_and_clashing_columns(spark):
    """Passages of over 50 words on either side of 400 bytes: what is under it
    stays by contract, what is over it goes wherever it stands."""
    r = random.Random(6)
    prose = lambda words: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(words))
    short, long = prose(55), prose(140)
    assert len(short) < 400 < len(long)
    rows = [(i, f"{prose(40)} {[short, long, prose(60)][i % 3]} {prose(30)}") for i in range(30)]
    rows += [(None, prose(20) + long + prose(5)), (None, None), (None, prose(90)), (40, long * 3), (40, ""), (41, rows[0][1]), (41, rows[0][1])]
    got = S.deduplicate(docs_frame(spark, rows, extra=True)).collect()
    want = brute([t for _, t in rows], 400)
    assert sorted(map(repr, ((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, hashlib.sha256(g.kept).hexdigest()) for g in got))) == \
        sorted(map(repr, ((i, *w) for (i, _), w in zip(rows, want))))
    removed = {g.doc_id: g.n_removed for g in got if g.doc_id is not None and g.doc_id < 30}
    assert all(removed[i] >= len(long) for i in range(1, 30, 3)) and not any(removed[i] for i in range(3, 30, 3))
