"""A linear-chain conditional random field in numpy: training by maximum likelihood, decoding by Viterbi."""

from __future__ import annotations

import numpy as np


def _soft(x, axis):
    """log(sum(exp(x))) along an axis."""
    m = x.max(axis=axis, keepdims=True)
    return m.squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))


def fit(feats: np.ndarray, gold: np.ndarray, first: np.ndarray, n_features: int, states: int, steps: int = 250,
        rate: float = 0.2, decay: float = 0.02):
    """Weights (n_features, states) and transitions (states, states) for items with rows of feature numbers.

    Sequence i is the items first[i]..first[i + 1] - 1. The last feature is padding: its weights stay 0.
    Penalised maximum likelihood by Adam; the result is the same on every run.
    """
    lengths = np.diff(first)
    n, longest = len(lengths), lengths.max()
    at = np.minimum(first[:-1, None] + np.arange(longest), first[1:, None] - 1)
    real = np.arange(longest) < lengths[:, None]
    weights, moves = np.zeros((n_features, states)), np.zeros((states, states))
    params = [weights, moves]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    seen = np.zeros_like(weights)
    np.add.at(seen, (feats, gold[:, None]), 1)
    inner = np.ones(len(gold), dtype=bool)
    inner[first[:-1]] = False
    pairs = np.flatnonzero(inner)
    seen_moves = np.zeros_like(moves)
    np.add.at(seen_moves, (gold[pairs - 1], gold[pairs]), 1)
    for step in range(1, steps + 1):
        emit = weights[feats].sum(axis=1)[at]
        fwd = [emit[:, 0]]
        for t in range(1, longest):
            nxt = _soft(fwd[-1][:, :, None] + moves, 1) + emit[:, t]
            fwd.append(np.where(real[:, t, None], nxt, fwd[-1]))
        back = [np.zeros((n, states))]
        for t in range(longest - 1, 0, -1):
            prev = _soft(moves[None] + (emit[:, t] + back[-1])[:, None, :], 2)
            back.append(np.where(real[:, t, None], prev, back[-1]))
        back = back[::-1]
        total = _soft(fwd[-1], 1)
        want, want_moves = np.zeros_like(weights), np.zeros_like(moves)
        for t in range(longest):
            rows = real[:, t]
            p = np.exp(fwd[t] + back[t] - total[:, None])[rows]
            np.add.at(want, feats[at[rows, t]], p[:, None, :])
            if t:
                joint = fwd[t - 1][:, :, None] + moves + (emit[:, t] + back[t])[:, None, :] - total[:, None, None]
                want_moves += np.exp(joint[rows]).sum(axis=0)
        grads = [seen - want - decay * weights, seen_moves - want_moves - decay * moves]
        grads[0][-1] = 0
        for k, grad in enumerate(grads):
            mean[k] = 0.9 * mean[k] + 0.1 * grad
            var[k] = 0.99 * var[k] + 0.01 * grad ** 2
            params[k] += rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.99 ** step)) + 1e-6)
    return weights.astype(np.float32), moves.astype(np.float32)


def viterbi(emit: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best label of every item; sequence i is the items first[i]..first[i + 1] - 1. All sequences advance together."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    start, lengths = first[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    labels = np.zeros(len(emit), dtype=np.int64)
    if not longest:
        return labels
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    states = emit.shape[1]
    came = np.zeros((len(emit), states), dtype=np.uint8)
    score = emit[start[: active[0]]]
    ends = np.zeros(len(lengths), dtype=np.int64)
    for t in range(1, longest):
        k = active[t]
        ends[k: len(score)] = score[k:].argmax(axis=1)
        step = score[:k, :, None] + moves
        best = step.argmax(axis=1)
        came[start[:k] + t] = best
        score = np.take_along_axis(step, best[:, None, :], axis=1)[:, 0] + emit[start[:k] + t]
    ends[: len(score)] = score.argmax(axis=1)
    now = ends
    for t in range(longest - 1, -1, -1):
        k = active[t]
        labels[start[:k] + t] = now[:k]
        if t:
            now[:k] = came[start[:k] + t, now[:k]]
    return labels
