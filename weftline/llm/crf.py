"""A linear-chain conditional random field with two labels, over many sequences at once.

Sequences lie one after another in flat arrays. `emit` is the log-odds of label 1 that a position's own features give; `trans` the 2 x 2 log-potentials between neighbours. Ratios of forward (and of backward) messages obey a Moebius recurrence, so each position costs a few operations and nothing overflows.
"""

from __future__ import annotations

import numpy as np


class Chains:
    """The layout of sequences, for stepping through all of them together."""

    def __init__(self, lengths: np.ndarray) -> None:
        lengths = np.asarray(lengths, dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(lengths) else lengths
        order = np.argsort(-lengths, kind="stable")
        order = order[: np.count_nonzero(lengths)]
        self.starts, self.lengths = starts[order], lengths[order]
        self.most = int(self.lengths[0]) if len(order) else 0
        self.total = int(lengths.sum())
        #: how many sequences are longer than t
        self.active = np.searchsorted(-self.lengths, -np.arange(self.most), side="left") if self.most else np.empty(0, int)
        self.follows = np.ones(self.total, dtype=bool)
        self.follows[self.starts] = False


def messages(chains: Chains, emit: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward ratios, backward ratios and exp(emit), by position."""
    e = np.exp(np.clip(emit, -30, 30))
    (a00, a01), (a10, a11) = np.exp(trans)
    fwd, bwd = np.empty_like(e), np.empty_like(e)
    if not chains.most:
        return fwd, bwd, e
    r = e[chains.starts]
    fwd[chains.starts] = r
    for t in range(1, chains.most):
        n = chains.active[t]
        at = chains.starts[:n] + t
        r = r[:n]
        r = e[at] * (r * a11 + a01) / (r * a10 + a00)
        fwd[at] = r
    last = chains.starts + chains.lengths - 1
    bwd[last] = 1.0
    s = np.ones(len(chains.starts))
    for t in range(1, chains.most):
        n = chains.active[t]
        at = last[:n] - t
        x = e[at + 1] * s[:n]
        s = (x * a11 + a10) / (x * a01 + a00)
        bwd[at] = s
    return fwd, bwd, e


def marginals(chains: Chains, emit: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The probability of label 1 at every position."""
    fwd, bwd, _ = messages(chains, emit, trans)
    z = fwd * bwd
    return z / (1.0 + z)


def expectations(chains: Chains, emit: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of each transition."""
    fwd, bwd, e = messages(chains, emit, trans)
    z = fwd * bwd
    a = np.exp(trans)
    to = np.flatnonzero(chains.follows)
    f, x = fwd[to - 1], e[to] * bwd[to]
    pair = np.stack([np.full(len(to), a[0, 0]), a[0, 1] * x, a[1, 0] * f, a[1, 1] * f * x])
    pair /= pair.sum(axis=0)
    return z / (1.0 + z), pair.sum(axis=1).reshape(2, 2)


def observed(chains: Chains, y: np.ndarray) -> np.ndarray:
    to = np.flatnonzero(chains.follows)
    return np.bincount(2 * y[to - 1] + y[to], minlength=4).reshape(2, 2).astype(float)


def fit(chains: Chains, y: np.ndarray, emission, gradient, n_weights: int, steps: int = 60, rate: float = 0.3, l2: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Maximise the penalised likelihood of the labels y by Adam.

    emission(w) gives the positions' log-odds, gradient(d) the sum of d over each weight's positions.
    """
    w, trans, want = np.zeros(n_weights), np.zeros((2, 2)), observed(chains, y)
    flat = np.zeros(n_weights + 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        p, got = expectations(chains, emission(w), trans)
        g = np.concatenate([gradient(y - p) - l2 * w, (want - got).ravel() - l2 * trans.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        flat += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8) * (1 - step / (steps + 1))
        w, trans = flat[:-4], flat[-4:].reshape(2, 2)
    return w, trans


def calibrate(z: np.ndarray, y: np.ndarray, l2: float = 0.01) -> tuple[float, float]:
    """Slope and intercept of the logistic curve that maps z to the chance of y = 1; the base rate alone where a class is missing."""
    if len(set(y.tolist())) < 2:
        p = (y.sum() + 0.01) / (len(y) + 0.02) if len(y) else 0.5
        return 0.0, float(np.log(p / (1 - p)))
    a, b = 1.0, 0.0
    x = np.stack([z, np.ones_like(z)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        s = p * (1 - p) + 1e-6
        h = (x * s) @ x.T + l2 * np.eye(2)
        d = np.linalg.solve(h, x @ (y - p) - l2 * np.array([a - 1.0, b]))
        a, b = a + float(np.clip(d[0], -2, 2)), b + float(np.clip(d[1], -4, 4))
        if abs(d).max() < 1e-6:
            break
    return a, b


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p: np.ndarray, eps: float = 1e-6) -> np.ndarray:
    p = np.clip(p, eps, 1 - eps)
    return np.log(p / (1 - p))
