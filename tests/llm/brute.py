"""Plain-Python versions of the operators, for small tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import regex
import xxhash

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def chain(*parts):
    """Signed XXH64 of strings, each seeded with the hash of those before."""
    h = 42
    for p in parts:
        h = xxhash.xxh64(p.encode(), seed=h).intdigest()
    return h - (1 << 64) if h >> 63 else h


# --- quality rules ------------------------------------------------------------
def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(grams)
    hit = set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            hit.update(range(i, i + 5))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "base_failed": len(w) < 10 or 100 * len(hit) > 20 * len(w)}


def buckets(text, n):
    t = TOKEN.findall(text or "")
    return [chain(x) % n for x in t] + [chain(a, b) % n for a, b in zip(t, t[1:])]


def quality(docs, trusted, n, prior, threshold):
    """docs: (doc_id, text) -> [(counts, mean log ratio, kept)]."""
    raw, target = Counter(), Counter()
    for i, text in docs:
        b = buckets(text, n)
        raw.update(b)
        if i in trusted:
            target.update(b)
    r, t = sum(raw.values()), sum(target.values())
    p = [(raw[b] + 1) / (r + n) for b in range(n)]
    ratio = [math.log((target[b] + prior * p[b]) / (t + prior) / p[b]) for b in range(n)]
    out = []
    for _, text in docs:
        c, b = base_counts(text), buckets(text, n)
        mean = sum(ratio[x] for x in b) / len(b) if b else 0.0
        out.append((c, mean, not c["base_failed"] and mean >= threshold))
    return out


# --- simhash --------------------------------------------------------------------
def fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups(fps, max_bits=3):
    """A group number for each fingerprint."""
    f = np.array(fps, np.uint64)
    label = list(range(len(f)))

    def find(x):
        while label[x] != x:
            label[x] = x = label[label[x]]
        return x
    for i in range(len(f)):
        for j in np.nonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= max_bits)[0]:
            a, b = find(i), find(i + 1 + int(j))
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


# --- decontamination ---------------------------------------------------------------
def best_distance(item, text):
    """Least edit distance of ``item`` to a substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


# --- mixing ----------------------------------------------------------------------------
def fill(budget, children):
    """Shares of (weight, capacity) children: full ones give their rest to
    the others by weight."""
    share, open_ = [0.0] * len(children), set(range(len(children)))
    left = budget
    while open_:
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if children[i][1] <= left * children[i][0] / total + 1e-9]
        if not full:
            for i in open_:
                share[i] = left * children[i][0] / total
            return share
        for i in full:
            share[i] = children[i][1]
            open_.discard(i)
        left -= sum(children[i][1] for i in full)
    return share


def leaf_budgets(tokens, budget, weight, max_epochs):
    """tokens: {(domain, lang, source): n} -> {leaf: budget}; ``weight`` gives
    the weight of a name at a depth."""
    out = {}

    def down(prefix, amount):
        kids = sorted({leaf[:len(prefix) + 1] for leaf in tokens if leaf[:len(prefix)] == prefix and tokens[leaf]})
        if not kids:
            return
        if len(prefix) == 3:
            return
        caps = [sum(n for leaf, n in tokens.items() if leaf[:len(k)] == k) * max_epochs for k in kids]
        for k, s in zip(kids, fill(amount, [(weight(len(prefix), k[-1]), c) for k, c in zip(kids, caps)])):
            if len(k) == 3:
                out[k] = math.floor(s + 1e-6)
            else:
                down(k, s)
    down((), budget)
    return out


def order(seed, epoch, doc_id):
    return int(hashlib.md5(f"{seed}:{epoch}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)


def mix(docs, domain, budgets, max_epochs, seed):
    """docs: (doc_id, text, lang, source) -> Counter of (doc_id, epoch)."""
    leaves = defaultdict(list)
    for i, text, lang, source in docs:
        leaves[domain(source), lang or "(none)", source or "(none)"].append((i, len(words(text))))
    out = Counter()
    for leaf, rows in leaves.items():
        total = sum(n for _, n in rows)
        if leaf not in budgets:
            continue
        whole = min(budgets[leaf] // total, max_epochs)
        rest = budgets[leaf] - whole * total if whole < max_epochs else 0
        places = defaultdict(int)
        for i, n in rows:
            places[order(seed, whole, i)] += n
        prior, taken = 0, set()
        for place in sorted(places):
            if prior < rest:
                taken.add(place)
            prior += places[place]
        for i, _ in rows:
            for e in range(whole + (order(seed, whole, i) in taken)):
                out[i, e] += 1
    return out


# --- sharding -----------------------------------------------------------------------------
def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def manifest(docs, n):
    """docs: (doc_id, text) -> sorted rows (doc_id, size, crc, shard, slot, grown)."""
    rows = []
    for i, text in docs:
        data = (text or "").encode()
        h = hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
        key = int(h[:16], 16)
        place = hashlib.md5(f"{'' if i is None else i}:{len(data) + 1}:{zlib.crc32(data)}".encode()).hexdigest()
        rows.append((jump(key, n), int(place[:3], 16), -1 if i is None else i, len(data) + 1,
                     zlib.crc32(data), jump(key, n + 1), i))
    out, slots = [], Counter()
    for shard, _, _, size, crc, grown, i in sorted(rows, key=lambda r: r[:5]):
        out.append((i, size, crc, shard, slots[shard], grown))
        slots[shard] += 1
    return out
