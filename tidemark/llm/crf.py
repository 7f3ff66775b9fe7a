"""Linear-chain conditional random fields over many short sequences at once, in numpy.

Sequences lie one after another in flat arrays.  All recursions walk the
positions of a sequence in step and are vectorised over the sequences, longest
first, so a step touches only those that are that long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Steps:
    """The order in which recursions walk sequences of the given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        order = np.argsort(-self.lengths, kind="stable")
        self.starts, self.sorted = starts[order], self.lengths[order]
        longest = int(self.sorted[0]) if len(self.sorted) else 0
        self.active = np.searchsorted(-self.sorted, -np.arange(longest), side="left")  # sequences longer than t

    def at(self, t: int) -> np.ndarray:
        return self.starts[: self.active[t]] + t


@dataclass
class Model:
    """Scores: ``features @ weights`` at a position, ``transitions[i, j]`` from label i to j."""

    weights: np.ndarray
    transitions: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def unary(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def forward_backward(unary: np.ndarray, transitions: np.ndarray, lengths: np.ndarray):
    """Marginals of each position, expected transitions over all sequences, and the sum of log partition functions."""
    steps, top = Steps(lengths), unary.max(axis=1, keepdims=True, initial=-np.inf)
    psi, move = np.exp(unary - top), np.exp(transitions)
    alpha, beta, scale = np.zeros_like(psi), np.ones_like(psi), np.ones(len(psi))
    expected = np.zeros_like(transitions)
    for t in range(len(steps.active)):
        at = steps.at(t)
        a = psi[at] if t == 0 else psi[at] * (alpha[at - 1] @ move)
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    for t in range(len(steps.active) - 1, 0, -1):
        at = steps.at(t)
        ahead = psi[at] * beta[at] / scale[at][:, None]
        beta[at - 1] = ahead @ move.T
        expected += move * (alpha[at - 1].T @ ahead)
    return alpha * beta, expected, float(np.log(scale).sum() + top.sum())


def _normed(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def _scan(steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The vectors start @ steps[0] @ ... @ steps[t], each up to a factor, for all t.

    The steps are cut into about sqrt(n) runs that are multiplied in step, so a long
    sequence takes about sqrt(n) array operations.
    """
    n, k = len(steps), steps.shape[1]
    length = max(1, int(n**0.5))
    runs = -(-n // length)
    steps = np.concatenate([steps, np.broadcast_to(np.eye(k), (runs * length - n, k, k))]).reshape(runs, length, k, k)
    whole = np.broadcast_to(np.eye(k), (runs, k, k))
    for t in range(length):
        whole = whole @ steps[:, t]
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    first = np.empty((runs, k))
    for r in range(runs):
        first[r] = start
        start = _normed(start @ whole[r])
    out, v = np.empty((runs, length, k)), first
    for t in range(length):
        v = _normed(np.einsum("ri,rij->rj", v, steps[:, t]))
        out[:, t] = v
    return out.reshape(-1, k)[:n]


def _potentials(unary: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    psi = np.exp(unary - unary.max(axis=1, keepdims=True))
    return psi, np.exp(transitions - transitions.max()) * psi[:, None, :]


def forward(unary: np.ndarray, transitions: np.ndarray, before: np.ndarray | None) -> np.ndarray:
    """Forward vectors of a piece of one sequence; ``before``: that of the position before it, None at the start."""
    psi, steps = _potentials(unary, transitions)
    if before is None:
        return np.vstack([_normed(psi[:1]), _scan(steps[1:], _normed(psi[0]))])
    return _scan(steps, before)


def backward(unary: np.ndarray, transitions: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backward vectors of a piece, given that of its ``last`` position, and that of the position before the piece."""
    _, steps = _potentials(unary, transitions)
    turned = _scan(steps[::-1].transpose(0, 2, 1), last)[::-1]
    return np.vstack([turned[1:], _normed(last)[None]]), turned[0]


def viterbi(unary: np.ndarray, transitions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best label sequence of each sequence; the smaller label on ties."""
    steps = Steps(lengths)
    best, back = unary.astype(float).copy(), np.zeros(unary.shape, np.int64)
    for t in range(1, len(steps.active)):
        at = steps.at(t)
        through = best[at - 1][:, :, None] + transitions[None]
        back[at] = through.argmax(axis=1)
        best[at] += through.max(axis=1)
    labels = np.zeros(len(unary), np.int64)
    for t in range(len(steps.active) - 1, -1, -1):
        at = steps.at(t)
        last = steps.sorted[: len(at)] == t + 1
        labels[at[last]] = best[at[last]].argmax(axis=1)
        if t:
            labels[at - 1] = back[at, labels[at]]
    return labels


def fit(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, n_labels: int, l2: float = 1e-3, rounds: int = 150, rate: float = 0.1) -> Model:
    """Penalised maximum likelihood by full-batch gradient steps with moment estimates; the same input gives the same model."""
    n = max(1, len(features))
    mean = features.mean(axis=0) if len(features) else np.zeros(features.shape[1])
    scale = features.std(axis=0) if len(features) else np.ones(features.shape[1])
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = np.hstack([(features - mean) / scale, np.ones((len(features), 1))])
    truth = np.eye(n_labels)[labels]
    inner = np.ones(len(features), bool)
    inner[np.cumsum(lengths)[:-1] if len(lengths) else []] = False
    if len(features):
        inner[0] = False
    seen = np.zeros((n_labels, n_labels))
    follow = np.flatnonzero(inner)
    np.add.at(seen, (labels[follow - 1], labels[follow]), 1)
    w, tr = np.zeros((x.shape[1], n_labels)), np.zeros((n_labels, n_labels))
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, tr)]
    for step in range(1, rounds + 1):
        marginals, expected, _ = forward_backward(x @ w, tr, lengths)
        for p, grad, (m, v) in zip((w, tr), (x.T @ (truth - marginals) / n - l2 * w, (seen - expected) / n - l2 * tr), moments):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(w, tr, mean, scale)
