"""A linear-chain conditional random field over table-driven token features."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Crf(NamedTuple):
    """Weights: one table (value, label) per feature; start and transition scores."""

    tables: list[np.ndarray]
    start: np.ndarray
    transitions: np.ndarray

    def emissions(self, features: list[np.ndarray]) -> np.ndarray:
        scores = self.tables[0][features[0]]
        for table, values in zip(self.tables[1:], features[1:]):
            scores = scores + table[values]
        return scores


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def fit_crf(
    features: list[np.ndarray],
    widths: list[int],
    labels: np.ndarray,
    first: np.ndarray,
    n_labels: int,
    *,
    l2: float = 0.5,
    steps: int = 80,
    rate: float = 0.2,
) -> Crf:
    """Maximise the conditional likelihood of tagged sequences.

    ``features`` holds one value per token and feature, ``first`` the number of
    the first token of every sequence and, last, the number of all tokens.
    Gradients are exact (forward and backward sums over all sequences at once).
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    steps_long = int(lengths[0]) if len(lengths) else 0
    active = [int((lengths > k).sum()) for k in range(steps_long)]
    tokens = len(labels)
    is_first = np.zeros(tokens, dtype=bool)
    is_first[first[:-1][np.diff(first) > 0]] = True
    gold_pairs = np.zeros((n_labels, n_labels))
    np.add.at(gold_pairs, (labels[:-1][~is_first[1:]], labels[1:][~is_first[1:]]), 1.0)
    gold_start = np.bincount(labels[is_first], minlength=n_labels).astype(float)
    hot = np.eye(n_labels)[labels]

    parameters = [np.zeros((w, n_labels)) for w in widths] + [np.zeros(n_labels), np.zeros((n_labels, n_labels))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    for step in range(1, steps + 1):
        model = Crf(parameters[:-2], parameters[-2], parameters[-1])
        score = model.emissions(features)
        alpha, beta = np.zeros((tokens, n_labels)), np.zeros((tokens, n_labels))
        for k in range(steps_long):
            at = begin[: active[k]] + k
            if k == 0:
                alpha[at] = model.start + score[at]
            else:
                alpha[at] = _logsumexp(alpha[at - 1][:, :, None] + model.transitions, 1) + score[at]
        for k in range(steps_long - 2, -1, -1):
            at = begin[: active[k + 1]] + k
            beta[at] = _logsumexp(model.transitions + (score[at + 1] + beta[at + 1])[:, None, :], 2)
        norm = np.zeros(tokens)
        total = _logsumexp(alpha + beta, 1)
        norm[:] = total
        chance = np.exp(alpha + beta - norm[:, None])
        later = np.flatnonzero(~is_first)
        pairs = (
            alpha[later - 1][:, :, None]
            + model.transitions
            + (score[later] + beta[later])[:, None, :]
            - norm[later][:, None, None]
        )
        wrong = chance - hot
        gradients = [
            np.stack([np.bincount(f, weights=wrong[:, y], minlength=w) for y in range(n_labels)], axis=1)
            for f, w in zip(features, widths)
        ]
        gradients += [chance[is_first].sum(axis=0) - gold_start, np.exp(pairs).sum(axis=0) - gold_pairs]
        for i, gradient in enumerate(gradients):
            gradient = gradient + l2 * parameters[i]
            m, v = moments[i]
            m = 0.9 * m + 0.1 * gradient
            v = 0.999 * v + 0.001 * gradient**2
            moments[i] = m, v
            parameters[i] = parameters[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    tables = [p.astype(np.float32) for p in parameters]
    return Crf(tables[:-2], tables[-2], tables[-1])


def viterbi(model: Crf, score: np.ndarray, first: np.ndarray, rest: int) -> np.ndarray:
    """Best labels of many sequences, ``first`` as in ``fit_crf``; ``rest`` is the usual label.

    Where the usual label leads by more than any two transitions and the start
    can make up, the best path has it for certain.  Only the stretches between
    such tokens are searched, all at once, token by token; the result is that
    of the search over whole sequences.
    """
    tokens, n_labels = score.shape
    labels = np.full(tokens, rest, dtype=np.int8)
    if not tokens:
        return labels
    changes = np.concatenate((model.transitions.ravel(), model.start))
    reach = 2 * float(changes.max() - changes.min())
    others = np.delete(score, rest, axis=1).max(axis=1)
    doubt = score[:, rest] - others <= reach
    is_first = np.zeros(tokens + 1, dtype=bool)
    is_first[first] = True
    begins = np.flatnonzero(doubt & (is_first[:-1] | ~np.concatenate(([False], doubt[:-1]))))
    if not len(begins):
        return labels
    ends = np.flatnonzero(doubt & (is_first[1:] | ~np.concatenate((doubt[1:], [False]))))
    order = np.argsort(begins - ends, kind="stable")
    begins, lengths = begins[order], (ends - begins + 1)[order]
    back = np.zeros((tokens, n_labels), dtype=np.int8)
    best = np.where(is_first[begins][:, None], model.start, model.transitions[rest]) + score[begins]
    final = np.empty((len(begins), n_labels))
    for k in range(1, int(lengths[0]) + 1):
        going = int((lengths > k).sum())
        final[going : len(best)] = best[going:]
        if not going:
            break
        at = begins[:going] + k
        paths = best[:going][:, :, None] + model.transitions
        back[at] = paths.argmax(axis=1)
        best = paths.max(axis=1) + score[at]
    last = begins + lengths - 1
    # what follows a stretch is the usual label, or the end of the sequence
    final += np.where(is_first[last + 1][:, None], 0.0, model.transitions[:, rest])
    label = final.argmax(axis=1).astype(np.int8)
    for k in range(int(lengths[0])):
        going = int((lengths > k).sum())
        at = last[:going] - k
        labels[at] = label[:going]
        label[:going] = back[at, label[:going]]
    return labels
