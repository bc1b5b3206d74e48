"""A character BiLSTM with CRF transitions in numpy: training and batched decoding.

Tags are O and, for each of four kinds, B and I.  Windows of one length run as a
batch: the loops are over the window's characters, not over windows.  Everything
is seeded, so the same windows give the same model.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
LENGTH = 64               # characters a window
PAD = 0

_CLASS = np.full(129, 2, np.int64)          # 2: any other character, 128 stands for beyond ASCII
_CLASS[128] = 3
_CLASS[[9, 10, 13, 32]] = [4, 5, 5, 6]
_CLASS[48:58] = 7
for _i in range(26):
    _CLASS[65 + _i] = _CLASS[97 + _i] = 8 + _i
for _j, _c in enumerate("@.+-()%_:;,/\\#\"'<>=[]!?*&$~|"):
    _CLASS[ord(_c)] = 34 + _j
CLASSES = 34 + 28


def classes(text: str) -> np.ndarray:
    """Character class of every character."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(cp, 128)]


def _sig(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _lse(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, hidden: int = 16, seed: int = 5):
        r = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["E" + d] = r.normal(0, 0.3, (CLASSES, 4 * hidden))
            self.p["U" + d] = r.normal(0, 0.25, (hidden, 4 * hidden))
        for d in "fb":
            self.p["E" + d][:, hidden:2 * hidden] += 0.5          # forget gates open
        self.p["W"] = r.normal(0, 0.3, (2 * hidden, TAGS))
        self.p["c"] = np.zeros(TAGS)
        self.p["T"] = np.zeros((TAGS, TAGS))

    def _run(self, x, d, keep):
        """Hidden states of one direction, windows x time x hidden."""
        n, length = x.shape
        h, c = np.zeros((n, self.h)), np.zeros((n, self.h))
        out, kept = np.empty((n, length, self.h)), []
        k = self.h
        for t in (range(length) if d == "f" else range(length - 1, -1, -1)):
            z = self.p["E" + d][x[:, t]] + h @ self.p["U" + d]
            i, f, o, g = _sig(z[:, :k]), _sig(z[:, k:2 * k]), _sig(z[:, 2 * k:3 * k]), np.tanh(z[:, 3 * k:])
            was, c0 = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                kept.append((t, was, c0, i, f, o, g, tc))
        return out, kept

    def emissions(self, x, keep=False):
        a, ka = self._run(x, "f", keep)
        b, kb = self._run(x, "b", keep)
        both = np.concatenate([a, b], axis=2)
        return both @ self.p["W"] + self.p["c"], both, ka, kb

    def _alphas(self, e):
        n, length, _ = e.shape
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for t in range(1, length):
            a[:, t] = e[:, t] + _lse(a[:, t - 1][:, :, None] + self.p["T"], 1)
        for t in range(length - 2, -1, -1):
            b[:, t] = _lse(self.p["T"] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        return a, b, _lse(a[:, -1], 1)

    def _back(self, x, d, kept, dh_out, grads):
        k = self.h
        dh, dc = np.zeros((len(x), k)), np.zeros((len(x), k))
        for t, was, c0, i, f, o, g, tc in reversed(kept):
            dh = dh + dh_out[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            np.add.at(grads["E" + d], x[:, t], dz)
            grads["U" + d] += was.T @ dz
            dh, dc = dz @ self.p["U" + d].T, dc * f

    def gradients(self, x, y):
        e, both, ka, kb = self.emissions(x, True)
        a, b, z = self._alphas(e)
        n, length = x.shape
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(a + b - z[:, None, None])
        for t in range(1, length):
            pair = np.exp(a[:, t - 1][:, :, None] + self.p["T"] + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None])
            g["T"] += pair.sum(0)
        np.add.at(g["T"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0)
        de[np.arange(n)[:, None], np.arange(length), y] -= 1.0
        g["W"] = np.einsum("ntk,ntj->kj", both, de)
        g["c"] = de.sum((0, 1))
        dh = de @ self.p["W"].T
        self._back(x, "f", ka, dh[:, :, :self.h], g)
        self._back(x, "b", kb, dh[:, :, self.h:], g)
        return {k: v / n for k, v in g.items()}

    def fit(self, x, y, steps=280, batch=32, rate=0.02, seed=9):
        """Adam over shuffled batches; the number of steps is fixed."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        while step < steps:
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                g = self.gradients(x[order[lo:lo + batch]], y[order[lo:lo + batch]])
                step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        return self

    def decode(self, x):
        """(best tags by Viterbi, their posterior probabilities)."""
        e = self.emissions(x)[0]
        n, length, _ = e.shape
        best, back = e[:, 0], np.empty((n, length, TAGS), np.int64)
        for t in range(1, length):
            s = best[:, :, None] + self.p["T"]
            back[:, t] = s.argmax(1)
            best = s.max(1) + e[:, t]
        tags = np.empty((n, length), np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(length - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
        a, b, z = self._alphas(e)
        prob = np.exp(a + b - z[:, None, None])[np.arange(n)[:, None], np.arange(length), tags]
        return tags, prob
