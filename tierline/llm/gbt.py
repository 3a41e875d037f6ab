"""Gradient-boosted trees with logistic loss, flattened to node arrays.

Training is a histogram method in numpy on a bounded sample.  A feature with
a monotone sign only takes splits whose leaf values keep the sign, and the
middle of the two values bounds all leaves below either side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """``feature`` is -1 at leaves; ``roots`` are the trees' first nodes."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``; NaN goes left."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                go = x[rows, np.maximum(f, 0)] > self.threshold[at]
                at = np.where(f < 0, at, np.where(go, self.right[at], self.left[at]))
            out += self.value[at]
        return out


def train(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 40, depth: int = 4,
          rate: float = 0.2, bins: int = 48, l2: float = 1.0, least: int = 8) -> Trees:
    """``y`` is 0/1; ``monotone`` gives +1 or -1 for features on which the
    score must not fall or not rise."""
    sign = np.zeros(x.shape[1], int)
    for f, v in (monotone or {}).items():
        sign[f] = v
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(mean / (1 - mean)))
    nodes: list[list] = []
    roots = []
    base = float(score[0])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([-1, 0.0, 0, 0, 0.0])
        todo = [(len(nodes) - 1, np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            k, rows, level, lo, hi = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, 0, 0.0, 0.0)
            if level < depth and len(rows) >= 2 * least:
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    m = len(c) + 1
                    gl = np.cumsum(np.bincount(code[rows, f], g[rows], m))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, f], h[rows], m))[:-1]
                    nl = np.cumsum(np.bincount(code[rows, f], minlength=m))[:-1]
                    vl, vr = np.clip(gl / (hl + l2), lo, hi), np.clip((gs - gl) / (hs - hl + l2), lo, hi)
                    gain = gl**2 / (hl + l2) + (gs - gl)**2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    ok = (nl >= least) & (len(rows) - nl >= least) & (sign[f] * (vr - vl) >= 0)
                    gain = np.where(ok, gain, -1)
                    j = int(gain.argmax())
                    if gain[j] > best[0]:
                        best = (gain[j], f, j, vl[j], vr[j])
            _, f, j, vl, vr = best
            if f < 0:
                nodes[k][4] = rate * float(np.clip(gs / (hs + l2), lo, hi))
                score[rows] += nodes[k][4]
                continue
            mid = (vl + vr) / 2
            nodes[k][:4] = [f, float(cuts[f][j]), len(nodes), len(nodes) + 1]
            nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
            left = code[rows, f] <= j
            a = (lo, mid) if sign[f] > 0 else (mid, hi) if sign[f] < 0 else (lo, hi)
            b = (mid, hi) if sign[f] > 0 else (lo, mid) if sign[f] < 0 else (lo, hi)
            todo += [(len(nodes) - 2, rows[left], level + 1, *a), (len(nodes) - 1, rows[~left], level + 1, *b)]
    f, t, left, right, v = (np.array(c) for c in zip(*nodes))
    return Trees(base, np.array(roots), f.astype(int), t.astype(float), left.astype(int), right.astype(int), v.astype(float), depth)
