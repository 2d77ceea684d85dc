"""A character tagger in numpy: embedding, bidirectional LSTM, CRF.

Both directions run in the same arrays, (direction, window, unit), one step per
character.  The CRF adds a score per pair of neighbouring tags; pairs that no
labelling can have are ruled out by a large fixed score.  Training minimises
the negative log-likelihood of whole tag sequences with Adam; gradients are
worked out by hand (backpropagation through time, forward-backward sums).
"""

from __future__ import annotations

import numpy as np

RULED_OUT = -1e4


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    def __init__(self, classes: int, kinds: int, width: int = 12, units: int = 16, seed: int = 1,
                 params: dict | None = None):
        """Tags: 0 for none, 2k + 1 where kind k begins, 2k + 2 inside."""
        self.tags, self.units = 2 * kinds + 1, units
        r = np.random.default_rng(seed)
        scaled = lambda *s: r.normal(0, 1 / np.sqrt(s[-2]), s)
        self.params = params or {
            "emb": r.normal(0, 0.3, (classes, width)), "wx": scaled(2, width, 4 * units),
            "b": np.zeros((2, 4 * units)), "wh": scaled(2, units, 4 * units),
            "out": scaled(2 * units, self.tags), "bias": np.zeros(self.tags),
            "pair": np.zeros((self.tags, self.tags)), "start": np.zeros(self.tags)}
        if params is None:
            self.params["b"][:, units:2 * units] = 1.0  # remember at first
        a, b = np.arange(self.tags)[:, None], np.arange(self.tags)[None]
        inside = (b > 0) & (b % 2 == 0)
        self.barred = np.where(inside & (a != b) & (a != b - 1), RULED_OUT, 0.0)

    def _pairs(self) -> np.ndarray:
        return self.params["pair"] + self.barred

    # ------------------------------------------------------------- network
    def _run(self, x: np.ndarray, keep: bool):
        """(window, position, 2 * unit) states; with ``keep`` the steps too."""
        p, u = self.params, self.units
        table = np.matmul(p["emb"][None], p["wx"]) + p["b"][:, None]
        n, length = x.shape
        # gates i, f, o as halves of tanh, g as tanh
        half = np.ones(4 * u, dtype=table.dtype)
        half[:3 * u] = 0.5
        table, wh = table * half, p["wh"] * half
        h = np.zeros((2, n, u), dtype=table.dtype)
        c = np.zeros_like(h)
        states = np.empty((n, length, 2 * u), dtype=table.dtype)
        steps = []
        for t in range(length):
            back = length - 1 - t
            z = np.matmul(h, wh)
            z[0] += table[0][x[:, t]]
            z[1] += table[1][x[:, back]]
            np.tanh(z, out=z)
            z[..., :3 * u] *= 0.5
            z[..., :3 * u] += 0.5
            i, f, o, g = (z[..., j * u:(j + 1) * u] for j in range(4))
            before, last = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[:, t, :u], states[:, back, u:] = h[0], h[1]
            if keep:
                steps.append((z, before, last, tc))
        return states, steps

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self._run(x, False)[0] @ self.params["out"] + self.params["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag sequence of each window (Viterbi)."""
        e, pairs = self.emissions(x), self._pairs()
        n, length, _ = e.shape
        score = self.params["start"] + e[:, 0]
        via = np.empty((length, n, self.tags), dtype=np.int8)
        for t in range(1, length):
            both = score[:, :, None] + pairs
            via[t] = both.argmax(axis=1)
            score = both.max(axis=1) + e[:, t]
        out = np.empty((n, length), dtype=np.int8)
        out[:, -1] = score.argmax(axis=1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = via[t][rows, out[:, t]]
        return out

    # ------------------------------------------------------------ training
    def loss(self, x: np.ndarray, tags: np.ndarray):
        """Mean negative log-likelihood and its gradient by parameter."""
        p, u = self.params, self.units
        n, length = x.shape
        states, steps = self._run(x, True)
        e = states @ p["out"] + p["bias"]
        pairs = self._pairs()
        ahead = np.empty_like(e)
        ahead[:, 0] = p["start"] + e[:, 0]
        for t in range(1, length):
            ahead[:, t] = _lse(ahead[:, t - 1][:, :, None] + pairs, 1) + e[:, t]
        total = _lse(ahead[:, -1], 1)
        back = np.zeros_like(e)
        for t in range(length - 2, -1, -1):
            back[:, t] = _lse(pairs + (e[:, t + 1] + back[:, t + 1])[:, None], 2)
        one = np.eye(self.tags)[tags]
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        de = np.exp(ahead + back - total[:, None, None]) - one
        grad["start"] = de[:, 0].sum(axis=0)
        both = ahead[:, :-1, :, None] + pairs + (e[:, 1:] + back[:, 1:])[:, :, None]
        grad["pair"] = np.exp(both - total[:, None, None, None]).sum(axis=(0, 1)) \
            - np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
        best = p["start"][tags[:, 0]] + np.take_along_axis(e, tags[..., None].astype(np.int64), 2) \
            .sum(axis=(1, 2)) + pairs[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        grad["bias"] = de.sum(axis=(0, 1))
        grad["out"] = np.einsum("ntu,nta->ua", states, de)
        ds = de @ p["out"].T
        dh = np.zeros((2, n, u))
        dc = np.zeros_like(dh)
        for t in range(length - 1, -1, -1):
            rev = length - 1 - t
            z, before, last, tc = steps[t]
            i, f, o, g = (z[..., j * u:(j + 1) * u] for j in range(4))
            dh = dh + np.stack([ds[:, t, :u], ds[:, rev, u:]])
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f),
                                 dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=2)
            dc = dc * f
            dh = np.matmul(dz, p["wh"].transpose(0, 2, 1))
            grad["wh"] += np.matmul(last.transpose(0, 2, 1), dz)
            grad["b"] += dz.sum(axis=1)
            for d, at in enumerate((x[:, t], x[:, rev])):
                grad["wx"][d] += p["emb"][at].T @ dz[d]
                np.add.at(grad["emb"], at, dz[d] @ p["wx"][d].T)
        return float((total - best).mean()), {k: g / n for k, g in grad.items()}

    def train(self, x: np.ndarray, tags: np.ndarray, epochs: int = 10, batch: int = 64,
              rate: float = 0.015, seed: int = 1) -> list:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        step, history = 0, []
        for epoch in range(epochs):
            order, losses = r.permutation(len(x)), []
            pace = rate * (1 - epoch / epochs)
            for a in range(0, len(x), batch):
                at = order[a:a + batch]
                value, grad = self.loss(x[at], tags[at])
                losses.append(value)
                size = np.sqrt(sum((g * g).sum() for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(size, 1e-12))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.params[k] -= pace * (first[k] / (1 - 0.9 ** step)) \
                        / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
            history.append(float(np.mean(losses)))
        return history

    def narrowed(self) -> Tagger:
        """The same tagger in single precision, for decoding."""
        out = Tagger(1, (self.tags - 1) // 2, units=self.units,
                     params={k: v.astype(np.float32) for k, v in self.params.items()})
        out.barred = out.barred.astype(np.float32)
        return out
