"""A linear-chain conditional random field with two labels, on arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Rounds, step and decay of the fit (Adam).
ROUNDS, STEP, DECAY = 250, 0.08, 1e-4


@dataclass
class Chain:
    """Weights of binary features for each label, of label pairs, and of the
    first and last label."""

    emit: np.ndarray  # features x 2
    move: np.ndarray  # 2 x 2
    first: np.ndarray
    last: np.ndarray

    def decode(self, rows: list[list[int]]) -> list[int]:
        """Viterbi: the most likely labels of a chain, given each place's features."""
        if not rows:
            return []
        score = np.array([self.emit[r].sum(axis=0) for r in rows])
        best, back = self.first + score[0], []
        for s in score[1:]:
            ways = best[:, None] + self.move
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + s
        now = int((best + self.last).argmax())
        out = [now]
        for b in reversed(back):
            now = int(b[now])
            out.append(now)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis=axis)) + m.squeeze(axis)


def fit(chains: list[tuple[list[list[int]], list[int]]], n_features: int) -> Chain:
    """Greatest likelihood of (features of each place, labels) of chains that
    have at least one place; all chains step together, padded to the longest."""
    n, t = len(chains), max(len(y) for _, y in chains)
    x = np.zeros((n, t, n_features), np.float32)
    y, there = np.zeros((n, t), int), np.zeros((n, t), bool)
    for i, (rows, labels) in enumerate(chains):
        for k, r in enumerate(rows):
            x[i, k, r] = 1
        y[i, : len(labels)], there[i, : len(labels)] = labels, True
    end = there.sum(axis=1) - 1
    every = np.arange(n)
    given = np.eye(2)[y] * there[..., None]
    shape = [(n_features, 2), (2, 2), (2,), (2,)]
    params = [np.zeros(s) for s in shape]
    m1, m2 = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape]
    for step in range(1, ROUNDS + 1):
        emit, move, first, last = params
        score = (x.reshape(-1, n_features) @ emit.astype(np.float32)).reshape(n, t, 2).astype(float)
        forth, back = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        forth[:, 0] = first + score[:, 0]
        for k in range(1, t):
            forth[:, k] = _log_sum(forth[:, k - 1, :, None] + move, 1) + score[:, k]
        back[every, end] = last
        for k in range(t - 2, -1, -1):
            go = _log_sum(move + (score[:, k + 1] + back[:, k + 1])[:, None, :], 2)
            back[:, k] = np.where((k < end)[:, None], go, back[:, k])
        z = _log_sum(forth[every, end] + last, 1)
        p = np.exp(forth + back - z[:, None, None]) * there[..., None]
        pair = np.exp(
            forth[:, :-1, :, None] + move + (score + back)[:, 1:, None, :] - z[:, None, None, None]
        ) * there[:, 1:, None, None]
        real = given[:, :-1, :, None] * given[:, 1:, None, :]
        off = (p - given).reshape(-1, 2)
        grads = [
            x.reshape(-1, n_features).T.astype(float) @ off / n, (pair - real).sum(axis=(0, 1)) / n,
            (p[:, 0] - given[:, 0]).mean(axis=0), (p[every, end] - given[every, end]).mean(axis=0),
        ]
        for i, g in enumerate(grads):
            g = g + DECAY * params[i]
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.99 * m2[i] + 0.01 * g * g
            params[i] = params[i] - STEP * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.99**step)) + 1e-8)
    return Chain(*params)
