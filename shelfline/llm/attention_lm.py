"""A small causal self-attention language model in numpy.

One attention head over a window of subword ids, a feed-forward layer, and
an output that mixes ``experts`` distributions over the vocabulary with
gates computed from the hidden state: p(y | context) = sum_k g_k P_k(y).
This sums to one over the whole vocabulary and costs a few dozen operations
per token, where a full softmax would cost a million. Gates and attention
are trained by Adam on the gradient of the log likelihood, the experts by
online expectation-maximisation. Both need only sums over the texts of a
round (``Sums``), which tasks can make apart and add up.

Texts are scored in overlapping windows: each window of ``CONTEXT + STRIDE``
inputs scores only its last ``STRIDE`` tokens, so each token is scored once,
with at least ``CONTEXT`` tokens of context where the text has them. Windows
of many texts form one batch with a causal mask that also hides padding.
"""

from __future__ import annotations

from copy import copy

import numpy as np

DIM, KEY, HIDDEN, EXPERTS = 16, 8, 32, 32
CONTEXT, STRIDE = 8, 24
WINDOW = CONTEXT + STRIDE
FLOOR = 0.02  # share of the uniform distribution in every expert
BOS, EOS = 1, 2


def windows(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs (n, WINDOW), targets (n, STRIDE) with -1 as none, number of
    windows of each text). A text is BOS + ids, and predicts ids + EOS."""
    counts = np.array([-(-(len(t) + 1) // STRIDE) for t in texts])
    n = int(counts.sum())
    x = np.full(n * STRIDE + CONTEXT * len(texts), pad, np.int32)
    y = np.full(n * STRIDE, -1, np.int32)
    rows = np.empty(n, np.int64)
    at_x = at_y = done = 0
    for t, c in zip(texts, counts):
        start = at_x + CONTEXT
        x[start] = BOS
        x[start + 1:start + 1 + len(t)] = t
        y[at_y:at_y + len(t)] = t
        y[at_y + len(t)] = EOS
        rows[done:done + c] = at_x + STRIDE * np.arange(c)
        at_x, at_y, done = at_x + CONTEXT + c * STRIDE, at_y + c * STRIDE, done + c
    return x[rows[:, None] + np.arange(WINDOW)], y.reshape(n, STRIDE), counts


def by_subword(ids: np.ndarray, rows: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different ids and the sums of their rows (those ``at`` places)."""
    if not len(ids):
        return np.zeros(0, np.int64), rows[:0]
    # A stable sort of 16-bit numbers goes by digits, without comparisons.
    order = np.argsort(ids.astype(np.uint16) if ids.max() < 1 << 16 else ids, kind="stable")
    ids = ids[order]
    first = np.concatenate([[0], np.nonzero(ids[1:] != ids[:-1])[0] + 1])
    rows = np.ascontiguousarray(rows, np.float32).take(order if at is None else at[order], axis=0)
    # Two numbers at a time: complex numbers add up by their parts.
    return ids[first], np.add.reduceat(rows.view(np.complex64), first, axis=0).view(np.float32)


class Sums:
    """What a round of texts adds up to, of a size bounded by the model: by
    subword the gradient of its embedding and its responsibilities by
    expert, the gradients of the other parameters, the predicted tokens."""

    def __init__(self, model: Model):
        self.rows = np.zeros((model.vocab + 1, DIM + EXPERTS))
        self.seen = np.zeros(model.vocab + 1, bool)
        self.dense = {k: np.zeros(v.shape) for k, v in model.p.items() if k != "emb"}
        self.tokens = 0

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys and rows to add up by key: subwords, and below 0 the rest."""
        rest = np.concatenate([*(d.ravel() for d in self.dense.values()), [self.tokens]])
        rest = np.pad(rest, (0, -len(rest) % (DIM + EXPERTS))).reshape(-1, DIM + EXPERTS)
        at = np.nonzero(self.seen)[0]
        return np.concatenate([-1 - np.arange(len(rest)), at]), np.concatenate([rest, self.rows[at]])

    def add_flat(self, keys: np.ndarray, rows: np.ndarray) -> None:
        at = keys >= 0
        self.rows[keys[at]] += rows[at]
        self.seen[keys[at]] = True
        rest = np.zeros((int((~at).sum()), DIM + EXPERTS))
        rest[-1 - keys[~at]] = rows[~at]
        rest, done = rest.ravel(), 0
        if len(rest):
            for d in self.dense.values():
                d += rest[done:done + d.size].reshape(d.shape)
                done += d.size
            self.tokens += int(round(rest[done]))


class Model:
    """Parameters of one vocabulary; the id ``vocab`` is padding."""

    def __init__(self, vocab: int, seed: int = 7):
        r = np.random.default_rng(seed)
        self.vocab = vocab

        def normal(*shape):
            return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "emb": (r.standard_normal((vocab + 1, DIM)) * 0.3).astype(np.float32),
            "pos": (r.standard_normal((WINDOW, DIM)) * 0.1).astype(np.float32),
            "q": normal(DIM, KEY), "k": normal(DIM, KEY), "v": normal(DIM, DIM),
            "w1": normal(DIM, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, DIM),
            "g": normal(DIM, EXPERTS), "bg": np.zeros(EXPERTS, np.float32)}
        self.experts = np.full((vocab, EXPERTS), 1.0 / vocab, np.float32)
        hide = np.triu(np.ones((STRIDE, WINDOW), bool), CONTEXT + 1)
        self.mask = np.where(hide, np.float32(-1e9), np.float32(0))

    def forward(self, x: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        e = p["emb"][x] + p["pos"]
        n = len(x)
        own = np.ascontiguousarray(e[:, CONTEXT:])
        flat = own.reshape(-1, DIM)
        q, k = flat @ (p["q"] * np.float32(1 / np.sqrt(KEY))), e.reshape(-1, DIM) @ p["k"]
        s = q.reshape(n, STRIDE, KEY) @ k.reshape(n, WINDOW, KEY).transpose(0, 2, 1)
        s += self.mask
        pad = x == self.vocab
        rows = np.nonzero(pad.any(1))[0]
        s[rows] += np.where(pad[rows], np.float32(-1e9), np.float32(0))[:, None]
        # A maximum is taken only where exp() could overflow; sums of short
        # rows are products with ones.
        if n and (q * q).sum(1).max() * (k * k).sum(1).max() > 40 ** 2:
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s /= (s @ np.ones(WINDOW, np.float32))[..., None]
        v = (e.reshape(-1, DIM) @ p["v"]).reshape(n, WINDOW, DIM)
        h = own + s @ v
        a = np.maximum(h.reshape(-1, DIM) @ p["w1"] + p["b1"], 0)
        o = h.reshape(-1, DIM) + a @ p["w2"]
        z = (o @ p["g"] + p["bg"]).reshape(n, STRIDE, EXPERTS)
        a, o = a.reshape(n, STRIDE, HIDDEN), o.reshape(n, STRIDE, DIM)
        if n and (z.max() > 60 or z.min() < -60):
            z -= z.max(axis=2, keepdims=True)
        np.exp(z, out=z)
        z /= (z @ np.ones(EXPERTS, np.float32))[..., None]
        return {"e": e, "s": s, "v": v, "h": h, "a": a, "o": o, "gate": z}

    def _hidden(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """The same as ``forward`` in fewer passes over memory, for windows
        as ``windows`` makes them, up to the hidden state and the gates
        before they are divided by their sums. Values carry a column of ones,
        so that one product gives the weighted sum and the sum of weights,
        and hidden states keep it for the biases. Rows of all windows go
        through one product; a maximum is taken only where exp() could
        overflow."""
        p, n = self.p, len(x)
        e = p["emb"].take(x, axis=0)
        e += p["pos"]
        flat = e.reshape(-1, DIM)
        kv1 = flat @ np.concatenate([p["k"], p["v"], np.zeros((DIM, 1), np.float32)], 1)
        kv1[:, -1] = 1
        k, v1 = kv1.reshape(n, WINDOW, -1)[..., :KEY], kv1.reshape(n, WINDOW, -1)[..., KEY:]
        own = np.ascontiguousarray(e[:, CONTEXT:]).reshape(-1, DIM)
        q = own @ (p["q"] * np.float32(1 / np.sqrt(KEY)))
        s = q.reshape(n, STRIDE, KEY) @ k.transpose(0, 2, 1)
        pad = x == self.vocab
        rows = np.nonzero(pad[:, 0] | pad[:, -1])[0]
        keys = kv1[:, :KEY]
        if np.einsum("ij,ij->i", q, q).max() * np.einsum("ij,ij->i", keys, keys).max() > 40 ** 2:
            s += self.mask
            s[rows] += np.where(pad[rows], np.float32(-1e9), np.float32(0))[:, None]
            s -= s.max(axis=2, keepdims=True)
        np.exp(s, out=s)
        s *= self.mask == 0
        s[rows] *= ~pad[rows][:, None]
        h1 = (s @ v1).reshape(-1, DIM + 1)
        weight = np.reciprocal(h1[:, -1:])
        h1 *= weight
        h1[:, :DIM] += own
        a = h1 @ np.concatenate([p["w1"], p["b1"][None]])
        np.maximum(a, 0, out=a)
        o1 = a @ np.concatenate([p["w2"], np.zeros((HIDDEN, 1), np.float32)], 1)
        o1 += h1
        z = o1 @ np.concatenate([p["g"], p["bg"][None]])
        if z.max() > 60 or z.min() < -60:
            z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        return {"e": flat, "own": own, "q": q, "k": k, "v1": v1, "s": s, "weight": weight, "h1": h1, "a": a, "o1": o1,
                "z": z}

    def _mixed(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The probability of each target."""
        z = self._hidden(x)["z"]
        ones = np.ones(EXPERTS, np.float32)
        total = z @ ones
        z *= self.experts.take(np.maximum(y, 0).ravel(), axis=0)
        return (z @ ones / total).reshape(y.shape)

    def log_prob(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log10 probability of each window's targets, summed by window."""
        p = self._mixed(x, y)
        return np.where(y >= 0, np.log10(np.maximum(p, 1e-30)), 0).sum(axis=1, dtype=np.float64)

    def score(self, texts: list[np.ndarray], batch: int = 128) -> np.ndarray:
        """Log10 probability of each text of subword ids."""
        x, y, counts = windows(texts, self.vocab)
        out = np.concatenate([self.log_prob(x[i:i + batch], y[i:i + batch])
                              for i in range(0, len(x), batch)] or [np.zeros(0)])
        return np.add.reduceat(out, np.concatenate([[0], np.cumsum(counts)[:-1]])) if len(texts) else np.zeros(0)

    def _gradients(self, x, y, f, responsibility) -> dict[str, np.ndarray]:
        """Gradient of the mean log likelihood, by hand."""
        n = max(1.0, float((y >= 0).sum()))
        g = {k: d / np.float32(n) for k, d in self._gradient_sums(x, y, f, responsibility).items()}
        de = g.pop("e")
        g["emb"] = np.zeros_like(self.p["emb"])
        at, sums = by_subword(x.ravel(), de.reshape(-1, DIM))
        g["emb"][at] = sums
        return g

    def _gradient_sums(self, x, y, f, responsibility) -> dict[str, np.ndarray]:
        """Gradient of the summed log likelihood; "e" is that of each input
        of each window. Rows of all windows go through one product."""
        p, g, n = self.p, {}, len(x)
        scale = np.float32(1 / np.sqrt(KEY))
        flat = lambda t: t.reshape(-1, t.shape[-1])
        dz = flat(responsibility - f["gate"])
        dz *= (y >= 0).reshape(-1, 1)
        o, a, h, e = flat(f["o"]), flat(f["a"]), flat(f["h"]), flat(f["e"])
        g["g"], g["bg"] = o.T @ dz, dz.sum(0)
        do = dz @ p["g"].T
        da = do @ p["w2"].T
        da *= a > 0
        g["w2"] = a.T @ do
        g["w1"], g["b1"] = h.T @ da, da.sum(0)
        dh = do + da @ p["w1"].T
        dh3, s = dh.reshape(n, STRIDE, DIM), f["s"]
        ds = dh3 @ f["v"].transpose(0, 2, 1)
        turned = s.transpose(0, 2, 1)
        dv = flat(turned @ dh3)
        # The sum over a row of ds * s is dh . (s @ v), and s @ v is h - own.
        own = np.ascontiguousarray(f["e"][:, CONTEXT:]).reshape(-1, DIM)
        ds -= (((h - own) * dh) @ np.ones(DIM, np.float32)).reshape(n, STRIDE, 1)
        ds *= s
        ds *= scale
        q, k = (own @ p["q"]).reshape(n, STRIDE, KEY), (e @ p["k"]).reshape(n, WINDOW, KEY)
        dq, dk = flat(ds @ k), flat(ds.transpose(0, 2, 1) @ q)
        g["q"], g["k"], g["v"] = own.T @ dq, e.T @ dk, e.T @ dv
        de = (dk @ p["k"].T + dv @ p["v"].T).reshape(n, WINDOW, DIM)
        de[:, CONTEXT:] += (dh + dq @ p["q"].T).reshape(n, STRIDE, DIM)
        g["pos"], g["e"] = de.sum(0), de
        return g

    def _responsibility(self, f: dict[str, np.ndarray], y: np.ndarray) -> np.ndarray:
        joint = f["gate"] * self.experts[np.maximum(y, 0)]
        joint /= np.maximum(joint @ np.ones(EXPERTS, np.float32), 1e-30)[..., None]
        return joint

    def _fast_sums(self, x: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """What ``_gradient_sums`` and ``_responsibility`` give, from
        ``_hidden``: gradients by parameter, the gradient of each input, the
        responsibilities of each target (0 where there is none)."""
        p, f, n = self.p, self._hidden(x), len(x)
        ones, live = np.ones(EXPERTS, np.float32), (y >= 0).ravel()
        h1, a, z, s, k, v1 = (f[c] for c in ("h1", "a", "z", "s", "k", "v1"))
        joint = self.experts.take(np.maximum(y, 0).ravel(), axis=0)
        joint *= z
        joint *= (live / np.maximum(joint @ ones, 1e-30))[:, None].astype(np.float32)
        z *= (live / (z @ ones))[:, None].astype(np.float32)
        dz = np.subtract(joint, z, out=z)
        g_bg = f["o1"].T @ dz
        do = dz @ p["g"].T
        da = do @ p["w2"].T
        da *= a > 0
        w1_b1 = h1.T @ da
        g = {"g": g_bg[:DIM], "bg": g_bg[DIM], "w2": a.T @ do, "w1": w1_b1[:DIM], "b1": w1_b1[DIM]}
        dh = do
        dh += da @ p["w1"].T
        # Weights are exp(s) / sum, and the sum over a row of ds * s is
        # dh . (h - own): both go into the rows before the products.
        row1 = np.empty_like(h1)
        row = np.multiply(dh, f["weight"], out=row1[:, :DIM])
        row1[:, DIM] = np.einsum("ij,ij->i", row, f["own"] - h1[:, :DIM])
        row1 = row1.reshape(n, STRIDE, -1)
        ds = row1 @ v1.transpose(0, 2, 1)
        ds *= s
        dq = (ds @ k).reshape(-1, KEY)
        dkv = np.empty((n, WINDOW, KEY + DIM), np.float32)
        np.matmul(ds.transpose(0, 2, 1), f["q"].reshape(n, STRIDE, KEY), out=dkv[..., :KEY])
        np.matmul(s.transpose(0, 2, 1), row1[..., :DIM], out=dkv[..., KEY:])
        dkv = dkv.reshape(-1, KEY + DIM)
        dq *= np.float32(1 / np.sqrt(KEY))
        g["q"], both = f["own"].T @ dq, f["e"].T @ dkv
        g["k"], g["v"] = both[:, :KEY], both[:, KEY:]
        de = (dkv @ np.concatenate([p["k"], p["v"]], 1).T).reshape(n, WINDOW, DIM)
        dh += dq @ p["q"].T
        de[:, CONTEXT:] += dh.reshape(n, STRIDE, DIM)
        g["pos"] = (np.ones(n, np.float32) @ de.reshape(n, -1)).reshape(WINDOW, DIM)
        return g, de, joint

    def add_sums(self, texts: list[np.ndarray], sums: Sums, batch: int = 192) -> None:
        """Add what one update needs of ``texts``: gradients and, by expert
        and subword, responsibilities."""
        x, y, counts = windows(texts, self.vocab)
        if not len(x):
            return
        # An input is the target of the place before, so that row r holds the
        # gradient of place r and the responsibilities of place r - 1.
        rows = np.zeros((y.size + 1, DIM + EXPERTS), np.float32)
        places, targets = rows[:-1].reshape(*y.shape, -1)[..., :DIM], rows[1:, DIM:]
        for i in range(0, len(x), batch):
            g, de, joint = self._fast_sums(x[i:i + batch], y[i:i + batch])
            end = i + len(de)
            targets[i * STRIDE:end * STRIDE] = joint
            places[i:end] = de[:, CONTEXT:]
            # A context is the end of the text's window before, or padding.
            before = max(i, 1)
            places[before - 1:end - 1, STRIDE - CONTEXT:] += de[before - i:, :CONTEXT]
            for k, d in g.items():
                sums.dense[k] += d
        starts = STRIDE * (np.cumsum(counts) - counts)
        sums.rows[BOS, :DIM] += rows[starts, :DIM].sum(0)
        sums.seen[BOS] = True
        rows[starts, :DIM] = 0
        live = np.nonzero(y.ravel() >= 0)[0]
        at, added = by_subword(y.ravel()[live], rows, live + 1)
        sums.rows[at] += added
        sums.seen[at] = True
        sums.tokens += len(live)

    def start(self, counts: np.ndarray, steps: int, rate: float, seed: int = 11) -> None:
        """Prepare for ``steps`` updates: every expert starts near the
        subword ``counts`` of all training texts."""
        r = np.random.default_rng(seed)
        self.counts, self.steps, self.step, self.rate = counts.astype(np.float64), steps, 0, rate
        start = self.counts[:, None] * np.exp(r.standard_normal((self.vocab, EXPERTS))) + 1e-9
        self.total = start / start.sum(0) * 1_000
        self._set_experts(self.total)
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.u = {k: np.zeros_like(v) for k, v in self.p.items()}

    def _ascend(self, gradients: dict[str, np.ndarray]) -> None:
        step, m, u = self.step, self.m, self.u
        for k, d in gradients.items():
            m[k] += 0.1 * (d - m[k])
            u[k] += 0.01 * (d * d - u[k])
            scale = self.rate * (1 - step / self.steps) / (1 - 0.9 ** (step + 1))
            self.p[k] += (scale * m[k] / (np.sqrt(u[k] / (1 - 0.99 ** (step + 1))) + 1e-8)).astype(np.float32)

    def _smooth_experts(self) -> None:
        self._set_experts(self.total + 0.01 * self.counts[:, None] / self.counts.sum() * self.total.sum(0) * 0.1)

    def update(self, sums: Sums) -> None:
        """One step with the sums of a round of texts. The weight of a round
        falls by its age, to 1 / step for the first one and never to 0."""
        if sums.tokens:
            gradients = {k: (d / sums.tokens).astype(np.float32) for k, d in sums.dense.items()}
            self._ascend({**gradients, "emb": (sums.rows[:, :DIM] / sums.tokens).astype(np.float32)})
            self.total *= 1 - 1 / (2 + self.step)
            self.total += sums.rows[:self.vocab, DIM:]
            self._smooth_experts()
        self.step += 1

    def bare(self) -> Model:
        """A view of this model without what only updates need."""
        out = copy(self)
        for k in ("counts", "total", "m", "u"):
            out.__dict__.pop(k, None)
        return out

    def fit(self, texts: list[np.ndarray], steps: int = 250, batch: int = 256, rate: float = 0.01,
            seed: int = 11) -> None:
        """Train on the windows of ``texts`` in memory, in a seeded order."""
        self.start(np.bincount(np.concatenate([*texts, [EOS] * max(1, len(texts))]).astype(np.int64),
                               minlength=self.vocab), steps, rate, seed)
        x, y, _ = windows(texts, self.vocab)
        if not len(x):
            return
        r = np.random.default_rng(seed + 1)
        order = np.concatenate([r.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
        for step in range(steps):
            rows = order[step * batch:(step + 1) * batch]
            bx, by = x[rows], y[rows]
            f = self.forward(bx)
            responsibility = self._responsibility(f, by)
            self._ascend(self._gradients(bx, by, f, responsibility))
            live = by >= 0
            self.total *= 1 - 1 / (2 + step) ** 0.6 if step < 50 else 0.99
            np.add.at(self.total, by[live], responsibility[live])
            self._smooth_experts()
            self.step += 1

    def _set_experts(self, total: np.ndarray) -> None:
        p = total / total.sum(0)
        self.experts = ((1 - FLOOR) * p + FLOOR / self.vocab).astype(np.float32)
