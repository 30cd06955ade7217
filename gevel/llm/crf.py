"""Linear-chain conditional random field with two states, over many chains at once.

The potential of a token is the log odds of state 1 over state 0, those of neighbouring states are a
2 x 2 matrix of logarithms. A message is kept as the ratio of its two entries. Chains are cut into
blocks of ``BLOCK`` tokens; the 2 x 2 products of the blocks carry the messages between them, so all
blocks of all chains advance together and a chain of any length is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 64


@dataclass
class Messages:
    """Forward and backward messages and own potential of each token, as ratios of state 1 to state 0."""

    forward: np.ndarray
    backward: np.ndarray
    node: np.ndarray

    def marginals(self) -> np.ndarray:
        """Probability of state 1."""
        odds = self.forward * self.backward
        return odds / (1 + odds)

    def pair_totals(self, pair: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Expected number of neighbours in each pair of states."""
        later = np.ones(len(self.node), bool)
        later[first[:-1][first[:-1] < first[1:]]] = False
        at = np.flatnonzero(later)
        before, after = self.forward[at - 1], self.node[at] * self.backward[at]
        t = np.exp(pair)
        joint = [[t[0, 0] * np.ones(len(at)), t[0, 1] * after], [t[1, 0] * before, t[1, 1] * before * after]]
        total = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
        return np.array([[(x / total).sum() for x in row] for row in joint])


def messages(odds: np.ndarray, first: np.ndarray, pair: np.ndarray) -> Messages:
    """``odds``: log odds of each token; ``first``: bounds of the chains, of any length from 0."""
    n = len(odds)
    node = np.exp(np.clip(odds, -40, 40).astype(float))
    if not n:
        return Messages(node, node, node)
    t00, t01, t10, t11 = np.exp(pair - pair.max()).ravel()
    blocks = -(-np.diff(first) // BLOCK)
    chain = np.repeat(np.arange(len(blocks)), blocks)
    depth = np.arange(len(chain)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[:-1][chain] + depth * BLOCK
    size = np.minimum(BLOCK, first[1:][chain] - begin)
    order = np.argsort(-size, kind="stable")  # blocks that are through come last
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    begin, size, depth = begin[order], size[order], depth[order]
    top, head = int(size[0]), depth == 0
    active = np.searchsorted(-size, -np.arange(top), side="left")
    grid = node[np.minimum(begin[None, :] + np.arange(top)[:, None], n - 1)]

    enter, leave = np.ones(len(begin)), np.ones(len(begin))
    deepest = int(depth.max())
    if deepest:
        a, b, c, d = np.ones(len(begin)), np.zeros(len(begin)), np.zeros(len(begin)), np.ones(len(begin))
        for at in range(top):
            k = int(active[at])
            w = grid[at, :k]
            if at == 0:
                a, b, c, d = np.where(head, a, t00), np.where(head, b, t01) * w, np.where(head, c, t10), np.where(head, d, t11) * w
            else:
                p, q, r, s = a[:k], b[:k], c[:k], d[:k]
                p, q, r, s = p * t00 + q * t10, (p * t01 + q * t11) * w, r * t00 + s * t10, (r * t01 + s * t11) * w
                scale = 1 / (p + q + r + s)
                a[:k], b[:k], c[:k], d[:k] = p * scale, q * scale, r * scale, s * scale
        by_depth = np.argsort(depth, kind="stable")
        levels = np.searchsorted(depth[by_depth], np.arange(deepest + 2))
        for level in range(1, deepest + 1):
            here = by_depth[levels[level] : levels[level + 1]]
            i = place[order[here] - 1]
            enter[here] = (b[i] + enter[i] * d[i]) / (a[i] + enter[i] * c[i])
        for level in range(deepest, 0, -1):
            i = by_depth[levels[level] : levels[level + 1]]
            leave[place[order[i] - 1]] = (c[i] + leave[i] * d[i]) / (a[i] + leave[i] * b[i])

    forward, backward = np.empty(n), np.empty(n)
    state = enter.copy()
    for at in range(top):
        k = int(active[at])
        r = state[:k]
        moved = (t01 + r * t11) / (t00 + r * t10)
        if at == 0:
            moved = np.where(head[:k], r, moved)
        state[:k] = moved * grid[at, :k]
        forward[begin[:k] + at] = state[:k]
    state = leave.copy()
    for at in range(top - 1, -1, -1):
        k = int(active[at])
        backward[begin[:k] + at] = state[:k]
        seen = state[:k] * grid[at, :k]
        state[:k] = (t10 + t11 * seen) / (t00 + t01 * seen)
    return Messages(forward, backward, node)
