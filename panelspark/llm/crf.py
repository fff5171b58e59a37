"""A linear-chain conditional random field with two states over binary features, in numpy."""

from __future__ import annotations

import numpy as np


class LineCrf:
    """State 0 is content, state 1 boilerplate. ``weights`` is (2, features), ``moves`` (2, 2)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """Most probable states of one sequence of feature rows; ties go to content."""
        scores = features @ self.weights.T
        stay, enter = self.moves[0], self.moves[1]
        content, junk = scores[0]
        came = np.zeros((len(scores), 2), np.int8)
        for at in range(1, len(scores)):
            from_content, from_junk = content + stay[0], junk + enter[0]
            to_junk, keep_junk = content + stay[1], junk + enter[1]
            came[at] = from_junk > from_content, keep_junk >= to_junk
            content = max(from_content, from_junk) + scores[at, 0]
            junk = max(to_junk, keep_junk) + scores[at, 1]
        states = np.zeros(len(scores), np.int8)
        states[-1] = junk > content
        for at in range(len(scores) - 1, 0, -1):
            states[at - 1] = came[at, states[at]]
        return states


def log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def fit(features: np.ndarray, states: np.ndarray, real: np.ndarray, rounds: int = 150, step: float = 0.2,
        decay: float = 1e-3) -> LineCrf:
    """Maximum likelihood by Adam. ``features`` (n, length, k), ``states`` and mask ``real`` (n, length)."""
    n, length, k = features.shape
    params = np.zeros(2 * k + 4)
    first, second = np.zeros_like(params), np.zeros_like(params)
    gold = (np.stack([states == 0, states == 1], axis=2) & real[..., None]).astype(float)
    pair = real[:, 1:] & real[:, :-1]
    gold_emit = np.einsum("nls,nlk->sk", gold, features)
    gold_move = np.einsum("nls,nlt,nl->st", gold[:, :-1], gold[:, 1:], pair)
    total = max(1, int(real.sum()))
    for t in range(1, rounds + 1):
        weights, moves = params[:2 * k].reshape(2, k), params[2 * k:].reshape(2, 2)
        emit = np.where(real[..., None], features @ weights.T, 0.0)
        ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
        ahead[:, 0] = emit[:, 0]
        for at in range(1, length):
            new = log_sum(ahead[:, at - 1, :, None] + moves, 1) + emit[:, at]
            ahead[:, at] = np.where(real[:, at, None], new, ahead[:, at - 1])
        for at in range(length - 2, -1, -1):
            new = log_sum(moves + (emit[:, at + 1] + behind[:, at + 1])[:, None, :], 2)
            behind[:, at] = np.where(real[:, at + 1, None], new, 0.0)
        norm = log_sum(ahead[:, -1], 1)
        share = np.exp(ahead + behind - norm[:, None, None]) * real[..., None]
        joint = np.exp(ahead[:, :-1, :, None] + moves + (emit[:, 1:] + behind[:, 1:])[:, :, None, :]
                       - norm[:, None, None, None]) * pair[..., None, None]
        gradient = np.concatenate([
            ((gold_emit - np.einsum("nls,nlk->sk", share, features)) / total).ravel(),
            ((gold_move - joint.sum(axis=(0, 1))) / total).ravel()]) - decay * params
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        params = params + step * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return LineCrf(params[:2 * k].reshape(2, k), params[2 * k:].reshape(2, 2))
