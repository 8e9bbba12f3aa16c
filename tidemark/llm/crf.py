"""Linear-chain conditional random fields over many chains at once.

Chains lie one after another in flat arrays. They are sorted by length and stepped
through together, so NumPy works on all chains that are still running.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Lanes:
    """Chains in order of length: ``starts`` and ``running[t]`` chains longer than t."""

    starts: np.ndarray
    running: np.ndarray

    @classmethod
    def of(cls, starts: np.ndarray, lengths: np.ndarray) -> Lanes:
        order = np.argsort(-lengths, kind="stable")
        down = -lengths[order]
        steps = np.arange(int(lengths.max(initial=0)))
        return cls(starts[order], np.searchsorted(down, -steps, side="left"))


def _scaled(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max(axis=1, keepdims=True)) if len(scores) else scores


def marginals(
    scores: np.ndarray, lanes: Lanes, moves: np.ndarray, *, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """Probability of each label at each place, by forward-backward.

    ``scores`` are log scores by place and label, ``moves`` those of a label after a
    label. With ``pairs`` the expected number of each move is returned as well.
    """
    weight, step = _scaled(scores), np.exp(moves - moves.max())
    ahead = np.empty_like(weight)
    behind = np.ones_like(weight)
    expected = np.zeros_like(moves) if pairs else None
    now = None
    for t, n in enumerate(lanes.running):
        at = lanes.starts[:n] + t
        now = weight[at] if now is None else (now[:n] @ step) * weight[at]
        now = now / (now.sum(axis=1, keepdims=True) + 1e-300)
        ahead[at] = now
    for t in range(len(lanes.running) - 2, -1, -1):
        at = lanes.starts[: lanes.running[t + 1]] + t
        after = weight[at + 1] * behind[at + 1]
        if pairs:
            before = ahead[at]
            z = ((before @ step) * after).sum(axis=1, keepdims=True) + 1e-300
            expected += (before / z).T @ after * step
        here = after @ step.T
        behind[at] = here / (here.sum(axis=1, keepdims=True) + 1e-300)
    both = ahead * behind
    return both / (both.sum(axis=1, keepdims=True) + 1e-300), expected


def best_labels(scores: np.ndarray, lanes: Lanes, moves: np.ndarray) -> np.ndarray:
    """The most likely labels of each chain, by Viterbi decoding."""
    back = np.zeros(scores.shape, dtype=np.int16)
    best = np.array(scores, dtype=np.float64)
    for t in range(1, len(lanes.running)):
        at = lanes.starts[: lanes.running[t]] + t
        ways = best[at - 1][:, :, None] + moves[None]
        back[at] = ways.argmax(axis=1)
        best[at] += ways.max(axis=1)
    out = np.zeros(len(scores), dtype=np.int64)
    label = np.zeros(len(lanes.starts), dtype=np.int64)
    for t in range(len(lanes.running) - 1, -1, -1):
        n = lanes.running[t]
        at = lanes.starts[:n] + t
        ending = lanes.running[t + 1] if t + 1 < len(lanes.running) else 0
        label[ending:n] = best[at[ending:]].argmax(axis=1)
        if ending:
            label[:ending] = back[at[:ending] + 1, label[:ending]]
        out[at] = label[:n]
    return out


def observed_moves(labels: np.ndarray, lanes: Lanes, n: int) -> np.ndarray:
    out = np.zeros((n, n))
    for t in range(1, len(lanes.running)):
        at = lanes.starts[: lanes.running[t]] + t
        out += np.bincount(labels[at - 1] * n + labels[at], minlength=n * n).reshape(n, n)
    return out


class Ascent:
    """AdaGrad steps on an array."""

    def __init__(self, shape, rate: float):
        self.value, self.squares, self.rate = np.zeros(shape), np.full(shape, 1e-6), rate

    def add(self, gradient: np.ndarray, shrink: float = 0.0) -> None:
        gradient = gradient - shrink * self.value
        self.squares += gradient**2
        self.value += self.rate * gradient / np.sqrt(self.squares)
