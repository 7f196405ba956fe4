"""Generative label models over votes, fitted by expectation-maximisation on counted vote patterns.

A pattern is one vote per voter: 1, -1 or 0 (abstain).  Rows enter as counts per distinct pattern, so the fit costs
the same at every size: at most 3 ** voters patterns.
"""

from __future__ import annotations

import numpy as np

#: Pseudo-counts of the estimates.
SMOOTH = 1.0


class LabelModel:
    """Two classes; each voter votes 1, 0 or -1 with probabilities of its own in each class.

    ``prior`` is the share of class 1, ``table[c, j, v + 1]`` voter j's probability of vote v in class c, ``weight``
    scales each voter's evidence (1 unless correlated).
    """

    def __init__(self, votes: np.ndarray, counts: np.ndarray, start: np.ndarray, fixed: np.ndarray | None = None,
                 rounds: int = 50, correlated: bool = False):
        """``start``: first guess of P(class 1) by pattern; ``fixed``: known labels (nan where unknown)."""
        self.votes, self.counts = votes.astype(np.int64), counts.astype(float)
        known = np.zeros(len(votes), bool) if fixed is None else ~np.isnan(fixed)
        self.weight = np.ones(votes.shape[1])
        p = np.where(known, fixed, start) if fixed is not None else start
        for step in range(rounds if len(votes) else 1):
            self.estimate(p)
            if correlated and step >= 2:
                self.weight = 1 / (1 + np.abs(self.correlations(p)).sum(axis=0))
            new = self.posterior(self.votes)
            if fixed is not None:
                new = np.where(known, fixed, new)
            if len(new) and np.abs(new - p).max() < 1e-6:
                break
            p = new
        self.p = p

    def estimate(self, p: np.ndarray) -> None:
        k = self.votes.shape[1]
        self.table = np.empty((2, k, 3))
        for c, share in enumerate((1 - p, p)):
            w = self.counts * share
            for v in (-1, 0, 1):
                self.table[c, :, v + 1] = (w[:, None] * (self.votes == v)).sum(axis=0) + SMOOTH
        self.table /= self.table.sum(axis=2, keepdims=True)
        total = self.counts.sum()
        self.prior = float(((self.counts * p).sum() + SMOOTH) / (total + 2 * SMOOTH))

    def correlations(self, p: np.ndarray) -> np.ndarray:
        """Mean over the classes of the voters' correlations within a class, with 0 on the diagonal."""
        out = np.zeros((self.votes.shape[1],) * 2)
        for share in (1 - p, p):
            w = self.counts * share
            if w.sum() > 1:
                x = self.votes - np.average(self.votes, axis=0, weights=w)
                cov = (w[:, None] * x).T @ x / w.sum()
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                out += cov / np.outer(sd, sd) * (w.sum() / self.counts.sum())
        np.fill_diagonal(out, 0)
        return np.where(np.abs(out) > 0.1, out, 0)

    def accuracy(self) -> np.ndarray:
        """Each voter's probability of being right when it votes."""
        right = self.prior * self.table[1, :, 2] + (1 - self.prior) * self.table[0, :, 0]
        wrong = self.prior * self.table[1, :, 0] + (1 - self.prior) * self.table[0, :, 2]
        return right / (right + wrong)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(class 1) of each pattern; an abstention is no evidence."""
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for j in range(votes.shape[1]):
            for v in (-1, 1):
                odds += (votes[:, j] == v) * self.weight[j] * np.log(self.table[1, j, v + 1] / self.table[0, j, v + 1])
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
