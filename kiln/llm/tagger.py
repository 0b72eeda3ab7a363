"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Characters go through an embedding and one LSTM in either direction; a linear
layer gives a score per tag, and a transition matrix scores pairs of tags.
Training maximises the likelihood of whole tag sequences (forward-backward
gradients, back-propagation through time, Adam).
"""

from __future__ import annotations

import numpy as np

OTHER_LETTER, OTHER_SIGN, LINE, PAD = 95, 96, 97, 98
ALPHABET = 99
FORBIDDEN = -1e4


def char_ids(text: str) -> np.ndarray:
    """Printable ASCII as itself, other letters and other signs as one each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    out = np.where((points >= 32) & (points < 127), points - 32, OTHER_SIGN)
    out[points == 10] = LINE
    high = np.flatnonzero(points >= 127)
    if len(high):
        out[high] = [OTHER_LETTER if chr(p).isalpha() else OTHER_SIGN for p in points[high]]
    return out.astype(np.int16)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Parameters and passes; ``allowed[i, j]`` tells whether tag j may follow tag i, ``first[j]`` start a text."""

    def __init__(self, allowed: np.ndarray, first: np.ndarray, embedding: int = 12, hidden: int = 20, seed: int = 0):
        rng = np.random.default_rng(seed)
        tags = len(first)
        self.hidden = hidden

        def init(*shape: int) -> np.ndarray:
            return (rng.normal(0, 1 / np.sqrt(shape[0]), shape)).astype(np.float32)

        self.p: dict[str, np.ndarray] = {"emb": init(ALPHABET, embedding), "out": init(2 * hidden, tags),
                                         "out_b": np.zeros(tags, np.float32), "trans": np.zeros((tags, tags), np.float32),
                                         "start": np.zeros(tags, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": init(embedding, 4 * hidden), f"h{d}": init(hidden, 4 * hidden),
                       f"b{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"b{d}"][hidden:2 * hidden] = 1          # remember at first
        self.block = np.where(allowed, 0, FORBIDDEN).astype(np.float32)
        self.block_first = np.where(first, 0, FORBIDDEN).astype(np.float32)

    def _lstm(self, ids: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (time, row, hidden) of one direction; ``keep`` the values that the gradient needs."""
        n, t = ids.shape
        k = self.hidden
        table = self.p["emb"] @ self.p[f"x{d}"] + self.p[f"b{d}"]       # input gates of every character
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out, cache = np.empty((t, n, k), np.float32), []
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            z = h @ self.p[f"h{d}"]
            z += table[ids[:, s]]
            gates = _sigmoid(z[:, :3 * k])
            i, f, o = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:]
            g = np.tanh(z[:, 3 * k:])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[s] = h
            if keep:
                cache.append((s, i, f, o, g, tc, *before))
        return out, cache

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores (row, time, tag)."""
        both = np.concatenate([self._lstm(ids, d, False)[0] for d in "fb"], axis=2)
        return (both @ self.p["out"] + self.p["out_b"]).transpose(1, 0, 2)

    def loss_and_grads(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        n, t = ids.shape
        k = self.hidden
        runs = {d: self._lstm(ids, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        e = (both @ self.p["out"] + self.p["out_b"]).astype(np.float64)
        trans = (self.p["trans"] + self.block).astype(np.float64)
        start = (self.p["start"] + self.block_first).astype(np.float64)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + start
        for s in range(1, t):
            alpha[s] = e[s] + _logsum(alpha[s - 1][:, :, None] + trans, 1)
        for s in range(t - 2, -1, -1):
            beta[s] = _logsum(trans + (e[s + 1] + beta[s + 1])[:, None, :], 2)
        total = _logsum(alpha[-1], 1)
        rows = np.arange(n)
        gold = start[tags[:, 0]] + e[0, rows, tags[:, 0]]
        de = np.exp(alpha + beta - total[None, :, None])
        dtrans = np.zeros_like(trans)
        for s in range(1, t):
            pair = alpha[s - 1][:, :, None] + trans + (e[s] + beta[s])[:, None, :] - total[:, None, None]
            dtrans += np.exp(pair).sum(axis=0)
            np.add.at(dtrans, (tags[:, s - 1], tags[:, s]), -1)
            gold += trans[tags[:, s - 1], tags[:, s]] + e[s, rows, tags[:, s]]
        for s in range(t):
            de[s, rows, tags[:, s]] -= 1
        grads = {"trans": dtrans / n, "start": de[0].sum(axis=0) / n}
        de = (de / n).astype(np.float32)
        grads["out"] = np.tensordot(both, de, axes=((0, 1), (0, 1)))
        grads["out_b"] = de.sum(axis=(0, 1))
        dboth = de @ self.p["out"].T
        grads["emb"] = np.zeros_like(self.p["emb"])
        for d, part in zip("fb", (dboth[:, :, :k], dboth[:, :, k:]), strict=True):
            dh, dc = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
            dtable = np.zeros((ALPHABET, 4 * k), np.float32)
            dhh = np.zeros_like(self.p[f"h{d}"])
            for s, i, f, o, g, tc, h0, c0 in reversed(runs[d][1]):
                dh = dh + part[s]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate((dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o),
                                     dc * i * (1 - g * g)), axis=1)
                dhh += h0.T @ dz
                np.add.at(dtable, ids[:, s], dz)
                dh, dc = dz @ self.p[f"h{d}"].T, dc * f
            grads[f"h{d}"], grads[f"b{d}"] = dhh, dtable.sum(axis=0)
            grads[f"x{d}"] = self.p["emb"].T @ dtable
            grads["emb"] += dtable @ self.p[f"x{d}"].T
        return float((total - gold).mean()), grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01,
            seed: int = 0) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of every epoch."""
        m = {k: np.zeros_like(v, dtype=np.float32) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in m.items()}
        rng, step, history = np.random.default_rng(seed), 0, []
        for epoch in range(epochs):
            order, losses = rng.permutation(len(ids)), []
            for a in range(0, len(ids), batch):
                own = order[a:a + batch]
                loss, grads = self.loss_and_grads(ids[own], tags[own])
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                pace = rate * 0.5 * (1 + np.cos(np.pi * (epoch + a / len(ids)) / epochs))
                for k, g in grads.items():
                    g = (g * min(1.0, 5.0 / (norm + 1e-9))).astype(np.float32)
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= (pace * (m[k] / (1 - 0.9 ** step))
                                  / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            history.append(float(np.mean(losses)))
        return history

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags of one score sequence (time, tag)."""
        trans, t = self.p["trans"] + self.block, len(e)
        best = e[0] + self.p["start"] + self.block_first
        back = np.empty((t, len(best)), dtype=np.int8)
        for s in range(1, t):
            x = best[:, None] + trans
            back[s] = x.argmax(axis=0)
            best = x.max(axis=0) + e[s]
        out = np.empty(t, dtype=np.int64)
        out[-1] = best.argmax()
        for s in range(t - 1, 0, -1):
            out[s - 1] = back[s, out[s]]
        return out
