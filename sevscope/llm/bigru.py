"""A bidirectional gated recurrent network with attention pooling over windows of words, in numpy.

A word enters as its learned vector (one shared vector for words outside the vocabulary) beside
the mean of its hashed character trigrams' learned vectors. Two recurrent layers read a window
in either direction; attention weighs their states; one logit comes out.
"""
from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

LENGTH = 16  # words of a window
HIDDEN = 8
WORD_DIM = CHAR_DIM = 8
TRIGRAMS = 1 << 13
#: Windows scored at a time.
BLOCK = 4096
#: Vectors learn more slowly than the network, and weights decay, so that a small sample's rare words are not learned by heart.
VECTOR_RATE, DECAY = {"words": 0.05, "chars": 0.3}, 0.01


def trigrams(word: str) -> list[int]:
    """Buckets of the character trigrams of a word with its ends marked; long words: all of them."""
    w = f"<{word}>"
    return [zlib.crc32(w[i:i + 3].encode("utf-8", "surrogatepass")) % TRIGRAMS for i in range(len(w) - 2)]


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    vocabulary: dict[str, int]  # word -> row of ``words``; row 0 stands for all others
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self, rng: np.random.Generator, word_first: np.ndarray, gram_first: np.ndarray) -> "Network":
        """Random weights; the first coordinates of the word and trigram vectors are given."""
        r = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
        words = rng.normal(0, 0.05, (len(self.vocabulary) + 1, WORD_DIM)).astype(np.float32)
        words[:, 0] = word_first
        words[0] = 0
        chars = rng.normal(0, 0.1, (TRIGRAMS, CHAR_DIM)).astype(np.float32)
        chars[:, 0] = gram_first
        self.p = {"words": words, "chars": chars, "W": r(WORD_DIM + CHAR_DIM, 6 * HIDDEN), "b": np.zeros(6 * HIDDEN, np.float32),
                  "U": r(2, HIDDEN, 3 * HIDDEN), "Wa": r(2 * HIDDEN, HIDDEN), "va": r(HIDDEN), "w": r(2 * HIDDEN), "c": np.zeros(1, np.float32)}
        return self

    # --- inputs of the recurrent layers, one row per distinct word ---

    def encode(self, words: list[str]):
        """(word rows, trigrams, their starts) of distinct words."""
        grams = [trigrams(w) or [0] for w in words]
        n = np.array([len(g) for g in grams])
        return (np.array([self.vocabulary.get(w, 0) for w in words]), np.fromiter((t for g in grams for t in g), np.int64), np.cumsum(n) - n, n)

    def inputs(self, rows, grams, starts, n):
        chars = np.add.reduceat(self.p["chars"][grams], starts, axis=0) / n[:, None].astype(np.float32)
        x = np.concatenate([self.p["words"][rows], chars], axis=1)
        return x, x @ self.p["W"] + self.p["b"]

    # --- windows ---

    def forward(self, proj, ids, mask, keep=False):
        """Logits of windows; ``ids`` (windows, LENGTH) are rows of ``proj``, ``mask`` is 1 on words."""
        p, (b, length), h_ = self.p, ids.shape, HIDDEN
        x = proj[ids].reshape(b, length, 2, 3 * h_).transpose(1, 2, 0, 3)  # step, direction, window, gates
        m = mask.T[:, None, :, None]
        h, steps = np.zeros((2, b, h_), np.float32), []
        states = np.zeros((length, 2, b, h_), np.float32)
        for t in range(length):
            xt = np.stack([x[t, 0], x[length - 1 - t, 1]])
            mt = np.concatenate([m[t], m[length - 1 - t]])
            hu = h @ p["U"]
            zr = _sigmoid(xt[..., :2 * h_] + hu[..., :2 * h_])
            z, r = zr[..., :h_], zr[..., h_:]
            n = np.tanh(xt[..., 2 * h_:] + r * hu[..., 2 * h_:])
            new = h + mt * (n - h) * (1 - z)
            if keep:
                steps.append((h, mt, z, r, n, hu[..., 2 * h_:]))
            h = new
            states[t, 0], states[length - 1 - t, 1] = h[0], h[1]
        s = states.transpose(2, 0, 1, 3).reshape(b, length, 2 * h_)
        a = np.tanh(s @ p["Wa"])
        e = a @ p["va"] - 1e9 * (1 - mask)
        e = np.exp(e - e.max(1, keepdims=True))
        alpha = e / e.sum(1, keepdims=True)
        pooled = np.einsum("bl,blh->bh", alpha, s)
        logit = pooled @ p["w"] + p["c"][0]
        return (logit, (steps, s, a, alpha, pooled)) if keep else logit

    def gradients(self, enc, ids, mask, label, weight):
        """Mean weighted loss and its gradient, backwards through time."""
        p, h_, (b, length) = self.p, HIDDEN, ids.shape
        rows, grams, starts, n_grams = enc
        x, proj = self.inputs(*enc)
        logit, (steps, s, a, alpha, pooled) = self.forward(proj, ids, mask, keep=True)
        prob = _sigmoid(logit)
        loss = -np.mean(weight * (label * np.log(prob + 1e-7) + (1 - label) * np.log(1 - prob + 1e-7)))
        d = (weight * (prob - label) / b).astype(np.float32)
        g = {"w": d @ pooled, "c": d.sum(keepdims=True)}
        d_pooled = d[:, None] * p["w"]
        d_s = alpha[:, :, None] * d_pooled[:, None, :]
        d_alpha = np.einsum("bh,blh->bl", d_pooled, s)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
        g["va"] = np.einsum("bl,bla->a", d_e, a)
        d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
        g["Wa"] = np.einsum("blh,bla->ha", s, d_a)
        d_s = (d_s + d_a @ p["Wa"].T).reshape(b, length, 2, h_)
        d_h, g["U"] = np.zeros((2, b, h_), np.float32), np.zeros_like(p["U"])
        d_x = np.zeros((b, length, 2, 3 * h_), np.float32)
        for t in range(length - 1, -1, -1):
            h, mt, z, r, n, hun = steps[t]
            d_h = d_h + np.stack([d_s[:, t, 0], d_s[:, length - 1 - t, 1]])
            d_new = mt * d_h
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (h - n) * z * (1 - z)
            d_r = d_n * hun * r * (1 - r)
            gates = np.concatenate([d_z, d_r, d_n], axis=2)
            through = np.concatenate([d_z, d_r, d_n * r], axis=2)
            g["U"] += h.transpose(0, 2, 1) @ through
            d_h = d_h - d_new * (1 - z) + through @ p["U"].transpose(0, 2, 1)
            d_x[:, t, 0], d_x[:, length - 1 - t, 1] = gates[0], gates[1]
        d_proj = np.zeros_like(proj)
        np.add.at(d_proj, ids.ravel(), d_x.reshape(b * length, 6 * h_))
        g["W"], g["b"] = x.T @ d_proj, d_proj.sum(0)
        back = d_proj @ p["W"].T
        g["words"] = np.zeros_like(p["words"])
        np.add.at(g["words"], rows, back[:, :WORD_DIM])
        g["chars"] = np.zeros_like(p["chars"])
        np.add.at(g["chars"], grams, np.repeat(back[:, WORD_DIM:] / n_grams[:, None], n_grams, axis=0))
        return loss, g


def window_starts(n: int, stride: int) -> np.ndarray:
    """Starts of the overlapping windows that cover ``n`` words; none for none."""
    if n == 0:
        return np.zeros(0, np.int64)
    last = max(0, n - LENGTH)
    return np.unique(np.append(np.arange(0, last + 1, stride), last))


def train(net: Network, examples, steps: int, rng: np.random.Generator, batch: int = 256, rate: float = 0.01):
    """Adam over ``examples``: (windows of words, labels); ``windows`` are lists of words."""
    texts, labels = examples
    labels = np.asarray(labels, np.float32)
    pos = max(1.0, labels.sum())
    weight = np.where(labels == 1, len(labels) / (2 * pos), len(labels) / (2 * max(1.0, len(labels) - pos))).astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(texts), batch)
        own: dict[str, int] = {}
        ids = np.zeros((batch, LENGTH), np.int64)
        mask = np.zeros((batch, LENGTH), np.float32)
        for i, j in enumerate(pick):
            w = texts[j]
            ids[i, :len(w)] = [own.setdefault(x, len(own)) for x in w]
            mask[i, :len(w)] = 1
        enc = net.encode(list(own))
        # some words are read by their characters alone, as unknown words will be
        enc = (np.where(rng.random(len(own)) < 0.2, 0, enc[0]), *enc[1:])
        _, g = net.gradients(enc, ids, mask, labels[pick], weight[pick])
        for k, x in net.p.items():
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.001 * (g[k] * g[k] - v[k])
            own_rate = rate * VECTOR_RATE.get(k, 1.0)
            x -= (own_rate * ((m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8) + DECAY * x)).astype(np.float32)
    return net
