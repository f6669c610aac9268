"""A bidirectional LSTM over characters with a conditional random field on top, in NumPy: training and decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_FORBIDDEN = -1e4


def symbols(texts: list[str], width: int) -> np.ndarray:
    """``len(texts) x width`` symbol numbers: ASCII as it is, classes of other characters, 0 past the end."""
    out = np.zeros((len(texts), width), np.int16)
    for row, text in zip(out, texts, strict=True):
        codes = np.frombuffer(text[:width].encode("utf-32-le", "surrogatepass"), np.uint32)
        row[: len(codes)] = np.where(codes < 127, np.maximum(codes, 1), np.where(codes < 0x250, 127, 128))
    return out


SYMBOLS = 129


@dataclass(frozen=True)
class Tags:
    """``O`` and, for every kind, its first and its further characters."""

    kinds: tuple[str, ...]

    @property
    def n(self) -> int:
        return 1 + 2 * len(self.kinds)

    def allowed(self) -> np.ndarray:
        """0 where a tag may follow another, else a number that rules it out; a kind goes on only after itself."""
        out = np.zeros((self.n, self.n))
        for k in range(len(self.kinds)):
            out[:, 2 + 2 * k] = _FORBIDDEN
            out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0
        return out

    def first(self) -> np.ndarray:
        out = np.zeros(self.n)
        out[2::2] = _FORBIDDEN
        return out

    def of(self, width: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
        """Tags of a text of ``width`` characters with ``spans (start, end, kind)``."""
        out = np.zeros(width, np.int8)
        for start, end, kind in spans:
            k = self.kinds.index(kind)
            out[start:end] = 2 + 2 * k
            out[start] = 1 + 2 * k
        return out


def fresh(tags: Tags, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Parameters to start from: input table, recurrence, output and transitions."""
    rng = np.random.Generator(np.random.PCG64(seed))
    scale = 1 / np.sqrt(hidden)
    table = rng.uniform(-scale, scale, (2, SYMBOLS, 4 * hidden))
    table[:, :, hidden:2 * hidden] += 1.0  # remember at first
    return {"table": table, "u": rng.uniform(-scale, scale, (2, hidden, 4 * hidden)),
            "out": rng.uniform(-scale, scale, (2 * hidden, tags.n)), "bias": np.eye(tags.n)[0] * 3, "trans": np.zeros((tags.n, tags.n))}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _run(p: dict, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states ``T x 2 x B x H`` in reading order of either direction, and what the way back needs."""
    b, t = x.shape
    h = p["u"].shape[1]
    both = np.stack([x, x[:, ::-1]])
    state = np.zeros((2, b, h), p["u"].dtype)
    cell = np.zeros_like(state)
    out, saved = np.empty((t, 2, b, h), p["u"].dtype), []
    for i in range(t):
        z = np.stack([p["table"][0][both[0, :, i]], p["table"][1][both[1, :, i]]]) + state @ p["u"]
        gates = _sigmoid(z[:, :, : 3 * h])
        new = np.tanh(z[:, :, 3 * h:])
        before, cell = cell, gates[:, :, h:2 * h] * cell + gates[:, :, :h] * new
        squashed = np.tanh(cell)
        if keep:
            saved.append((state, before, gates, new, squashed))
        state = gates[:, :, 2 * h:] * squashed
        out[i] = state
    return out, saved


def emissions(p: dict, x: np.ndarray, keep: bool = False):
    """``B x T x tags`` scores from both directions."""
    states, saved = _run(p, x, keep)
    joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=2).transpose(1, 0, 2)
    return joined @ p["out"] + p["bias"], joined, saved


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _forward(e: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    a = np.empty_like(e)
    a[:, 0] = e[:, 0] + first
    for i in range(1, e.shape[1]):
        a[:, i] = _logsum(a[:, i - 1, :, None] + trans, 1) + e[:, i]
    return a


def _backward(e: np.ndarray, trans: np.ndarray) -> np.ndarray:
    b = np.zeros_like(e)
    for i in range(e.shape[1] - 2, -1, -1):
        b[:, i] = _logsum(trans + (e[:, i + 1] + b[:, i + 1])[:, None, :], 2)
    return b


def marginals(e: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of every tag at every place, given the whole window."""
    a = _forward(e, trans, first)
    return np.exp(a + _backward(e, trans) - _logsum(a[:, -1], 1)[:, None, None])


def loss(p: dict, tags: Tags, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the tags ``y``, and its gradient."""
    n, t = x.shape
    e, joined, saved = emissions(p, x, True)
    trans, first = p["trans"] + tags.allowed(), tags.first()
    a, b = _forward(e, trans, first), _backward(e, trans)
    z = _logsum(a[:, -1], 1)
    rows, places = np.arange(n)[:, None], np.arange(t)[None]
    gold = e[rows, places, y].sum(1) + first[y[:, 0]] + trans[y[:, :-1], y[:, 1:]].sum(1)
    de = np.exp(a + b - z[:, None, None])
    de[rows, places, y] -= 1
    pair = np.exp(a[:, :-1, :, None] + trans + (e + b)[:, 1:, None, :] - z[:, None, None, None])
    dtrans = pair.sum((0, 1))
    np.add.at(dtrans, (y[:, :-1], y[:, 1:]), -1)
    de /= n
    grad = {"trans": dtrans / n, "bias": de.sum((0, 1)), "out": np.einsum("btj,btk->jk", joined, de),
            "table": np.zeros_like(p["table"]), "u": np.zeros_like(p["u"])}
    h = p["u"].shape[1]
    back = (de @ p["out"].T).transpose(1, 0, 2)
    dh = np.stack([back[:, :, :h], back[::-1, :, h:]], axis=1)
    both = np.stack([x, x[:, ::-1]])
    state = np.zeros((2, n, h))
    cell = np.zeros_like(state)
    dz = np.empty((t, 2, n, 4 * h))
    for i in range(t - 1, -1, -1):
        before, c0, gates, new, squashed = saved[i]
        state = state + dh[i]
        o = gates[:, :, 2 * h:]
        cell = cell + state * o * (1 - squashed**2)
        dz[i, :, :, :h] = cell * new
        dz[i, :, :, h:2 * h] = cell * c0
        dz[i, :, :, 2 * h:3 * h] = state * squashed
        dz[i, :, :, :3 * h] *= gates * (1 - gates)
        dz[i, :, :, 3 * h:] = cell * gates[:, :, :h] * (1 - new**2)
        grad["u"] += before.transpose(0, 2, 1) @ dz[i]
        state = dz[i] @ p["u"].transpose(0, 2, 1)
        cell = cell * gates[:, :, h:2 * h]
    for d in range(2):
        np.add.at(grad["table"][d], both[d].T, dz[:, d])
    return float((z - gold).mean()), grad


def train(tags: Tags, batches, hidden: int = 24, steps: int = 300, rate: float = 0.03, seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters after ``steps`` steps of Adam; ``batches(i)`` gives the symbols and tags of step ``i``."""
    p = fresh(tags, hidden, seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    for i in range(steps):
        _, grad = loss(p, tags, *batches(i))
        now = rate * (1 - 0.95 * i / steps)
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g**2
            p[k] -= now * (m[k] / (1 - 0.9 ** (i + 1))) / (np.sqrt(s[k] / (1 - 0.99 ** (i + 1))) + 1e-8)
    return {k: v.astype(np.float32) for k, v in p.items()}


def decode(p: dict, tags: Tags, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags of every window (Viterbi) and the probability of each of them at its place."""
    e = emissions(p, x)[0].astype(np.float64)
    trans, first = p["trans"] + tags.allowed(), tags.first()
    n, t, _ = e.shape
    best, back = e[:, 0] + first, np.empty((t, n, tags.n), np.int8)
    for i in range(1, t):
        paths = best[:, :, None] + trans
        back[i] = paths.argmax(1)
        best = paths.max(1) + e[:, i]
    out = np.empty((n, t), np.int8)
    out[:, -1] = best.argmax(1)
    for i in range(t - 1, 0, -1):
        out[:, i - 1] = back[i][np.arange(n), out[:, i]]
    sure = marginals(e, trans, first)
    return out, sure[np.arange(n)[:, None], np.arange(t)[None], out]
