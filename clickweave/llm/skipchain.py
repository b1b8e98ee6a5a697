"""A skip-chain conditional random field: a chain per text, and edges between distant tokens that are alike.

Inference is loopy belief propagation over all edges of many texts at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# the usual label
REST = 0
# kinds of edges: neighbours in the text, tokens that repeat, tokens that are similar
CHAIN, REPEAT, SIMILAR = 0, 1, 2
EDGE_KINDS = 3
SWEEPS, TOLERANCE, DAMPING = 60, 1e-3, 0.25


class Edges(NamedTuple):
    """Undirected edges from ``one`` to ``other``, by kind; of a chain, ``one`` stands first."""

    one: np.ndarray
    other: np.ndarray
    kind: np.ndarray

    def of(self, chosen: np.ndarray) -> Edges:
        return Edges(self.one[chosen], self.other[chosen], self.kind[chosen])


class SkipChain(NamedTuple):
    """One weight table (value, label) per feature, and a table (label, label) per kind of edge."""

    tables: list[np.ndarray]
    links: np.ndarray

    def emissions(self, features: list[np.ndarray]) -> np.ndarray:
        scores = self.tables[0][features[0]]
        for table, values in zip(self.tables[1:], features[1:]):
            scores = scores + table[values]
        return scores


def chain_edges(text: np.ndarray) -> Edges:
    """Edges between neighbouring tokens of one text."""
    one = np.flatnonzero(text[1:] == text[:-1])
    return Edges(one, one + 1, np.full(len(one), CHAIN))


def skip_edges(text: np.ndarray, keys: np.ndarray, linked: np.ndarray, kind: int) -> Edges:
    """Edges from each linked token to the next one of its text with the same key: as many as tokens, not as pairs."""
    at = np.flatnonzero(linked)
    order = at[np.lexsort((at, keys[at], text[at]))]
    same = (text[order[1:]] == text[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]])
    # neighbours are linked by the chain
    same &= np.diff(order) > 1
    return Edges(order[:-1][same], order[1:][same], np.full(int(same.sum()), kind))


def join_edges(*parts: Edges) -> Edges:
    return Edges(*[np.concatenate(columns) for columns in zip(*parts)])


class _Messages:
    """Messages along both directions of every edge, updated together."""

    def __init__(self, edges: Edges, nodes: int, labels: int):
        self.source = np.concatenate((edges.one, edges.other))
        self.target = np.concatenate((edges.other, edges.one))
        self.count, self.nodes = len(edges.one), nodes
        kinds = np.concatenate((edges.kind, edges.kind + EDGE_KINDS))
        self.of_kind = [np.flatnonzero(kinds == k) for k in range(2 * EDGE_KINDS)]
        self.values = np.zeros((2 * self.count, labels))

    def beliefs(self, unary: np.ndarray) -> np.ndarray:
        out = np.array(unary, dtype=float)
        for y in range(out.shape[1]):
            out[:, y] += np.bincount(self.target, self.values[:, y], minlength=self.nodes)
        return out

    def cavity(self, beliefs: np.ndarray) -> np.ndarray:
        """What each source believes without what the target told it, largest 0."""
        back = np.concatenate((self.values[self.count :], self.values[: self.count]))
        left = beliefs[self.source] - back
        return left - left.max(axis=1, keepdims=True)

    def sweep(self, unary: np.ndarray, links: np.ndarray, *, best: bool) -> float:
        """Update all messages (``best``: of the likeliest labelling, else of the marginals); the largest change."""
        left = self.cavity(self.beliefs(unary))
        fresh = np.empty_like(self.values)
        for k, at in enumerate(self.of_kind):
            link = links[k] if k < EDGE_KINDS else links[k - EDGE_KINDS].T
            if best:
                told = left[at]
                for y in range(link.shape[1]):
                    most = told[:, 0] + link[0, y]
                    for x in range(1, link.shape[0]):
                        np.maximum(most, told[:, x] + link[x, y], out=most)
                    fresh[at, y] = most
            else:
                fresh[at] = np.log(np.exp(left[at]) @ np.exp(link))
        fresh -= fresh.max(axis=1, keepdims=True)
        change = float(np.abs(fresh - self.values).max(initial=0.0))
        self.values += (1 - DAMPING) * (fresh - self.values)
        return change


def _joint(messages: _Messages, beliefs: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Expected label pairs per kind of edge."""
    left = np.exp(messages.cavity(beliefs))
    out = np.zeros_like(links)
    for k in range(EDGE_KINDS):
        at = messages.of_kind[k]
        one, other, link = left[at], left[at + messages.count], np.exp(links[k])
        norm = ((one @ link) * other).sum(axis=1, keepdims=True)
        out[k] = link * ((one / norm).T @ other)
    return out


def fit_skip_chain(
    features: list[np.ndarray],
    widths: list[int],
    labels: np.ndarray,
    edges: Edges,
    n_labels: int,
    *,
    l2: float = 0.5,
    steps: int = 80,
    rate: float = 0.15,
    sweeps: int = 2,
) -> SkipChain:
    """Maximise the likelihood of tagged tokens, with expectations by loopy belief propagation.

    Messages are kept from step to step, so a few sweeps per step follow the weights.
    """
    hot = np.eye(n_labels)[labels]
    gold = np.zeros((EDGE_KINDS, n_labels, n_labels))
    np.add.at(gold, (edges.kind, labels[edges.one], labels[edges.other]), 1.0)
    parameters = [np.zeros((w, n_labels)) for w in widths] + [np.zeros((EDGE_KINDS, n_labels, n_labels))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    messages = _Messages(edges, len(labels), n_labels)
    for step in range(1, steps + 1):
        model = SkipChain(parameters[:-1], parameters[-1])
        unary = model.emissions(features)
        for _ in range(sweeps):
            messages.sweep(unary, model.links, best=False)
        beliefs = messages.beliefs(unary)
        chance = np.exp(beliefs - beliefs.max(axis=1, keepdims=True))
        wrong = chance / chance.sum(axis=1, keepdims=True) - hot
        gradients = [
            np.stack([np.bincount(f, weights=wrong[:, y], minlength=w) for y in range(n_labels)], axis=1)
            for f, w in zip(features, widths)
        ]
        pairs = _joint(messages, beliefs, model.links) - gold
        # a skip edge has no direction
        pairs[1:] = (pairs[1:] + pairs[1:].transpose(0, 2, 1)) / 2
        for i, gradient in enumerate([*gradients, pairs]):
            gradient = gradient + l2 * parameters[i]
            m, v = moments[i]
            m = 0.9 * m + 0.1 * gradient
            v = 0.999 * v + 0.001 * gradient**2
            moments[i] = m, v
            parameters[i] = parameters[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    tables = [p.astype(np.float32) for p in parameters]
    return SkipChain(tables[:-1], tables[-1])


def _doubtful(links: np.ndarray, unary: np.ndarray, edges: Edges, rounds: int = 4) -> np.ndarray:
    """Tokens that some labelling of their neighbours could move off the usual label.

    For all others the usual label leads by more than their edges can make up,
    so the best labelling has it there for certain.
    """
    n, labels = unary.shape
    # most that an edge can add to a label over the usual one, whatever stands at its far end, or if the usual one does
    forward = links - links[:, :, REST : REST + 1]
    backward = links - links[:, REST : REST + 1, :]
    any_forward, any_backward = forward.max(axis=1), backward.max(axis=2)
    rest_forward, rest_backward = forward[:, REST, :], backward[:, :, REST]
    # first as if every token had two neighbours in its chain, and with its own number of skip edges
    skips = edges.kind != CHAIN
    kind = edges.kind[skips]
    doubt = np.zeros(n, dtype=bool)
    for y in range(labels):
        if y != REST:
            most = unary[:, y] - unary[:, REST] + (any_forward[CHAIN, y] + any_backward[CHAIN, y])
            most += np.bincount(edges.other[skips], any_forward[kind, y], minlength=n)
            most += np.bincount(edges.one[skips], any_backward[kind, y], minlength=n)
            doubt |= most > 0
    one, other, kind = edges
    for _ in range(rounds):
        # edges with no doubtful end say nothing new
        live = doubt[one] | doubt[other]
        one, other, kind = one[live], other[live], kind[live]
        at = np.flatnonzero(doubt)
        place = np.full(n, len(at))
        place[at] = np.arange(len(at))
        ends = np.concatenate((place[other], place[one]))
        to_other = np.where(doubt[one][:, None], any_forward[kind], rest_forward[kind])
        to_one = np.where(doubt[other][:, None], any_backward[kind], rest_backward[kind])
        gain = np.concatenate((to_other, to_one))
        lead = unary[at] - unary[at, REST][:, None]
        most = np.full(len(at), -np.inf)
        for y in range(labels):
            if y != REST:
                added = np.bincount(ends, gain[:, y], minlength=len(at) + 1)[: len(at)]
                most = np.maximum(most, lead[:, y] + added)
        if (most > 0).all():
            break
        doubt[at[most <= 0]] = False
    return doubt


def decode(model: SkipChain, unary: np.ndarray, edges: Edges) -> np.ndarray:
    """Labels by max-product belief propagation; the usual label wins ties.

    Only tokens in doubt exchange messages; their certain neighbours act as
    fixed.  Along stretches of more doubtful tokens than there are sweeps, and
    around loops, the result is approximate.
    """
    labels = np.full(len(unary), REST, dtype=np.int8)
    doubt = _doubtful(model.links, unary, edges)
    at = np.flatnonzero(doubt)
    if not len(at):
        return labels
    number = np.cumsum(doubt) - 1
    own = unary.astype(float)
    to_other = edges.of(~doubt[edges.one] & doubt[edges.other])
    np.add.at(own, to_other.other, model.links[to_other.kind, REST, :])
    to_one = edges.of(doubt[edges.one] & ~doubt[edges.other])
    np.add.at(own, to_one.one, model.links[to_one.kind, :, REST])
    inner = edges.of(doubt[edges.one] & doubt[edges.other])
    messages = _Messages(Edges(number[inner.one], number[inner.other], inner.kind), len(at), unary.shape[1])
    for _ in range(SWEEPS):
        if messages.sweep(own[at], model.links, best=True) < TOLERANCE:
            break
    beliefs = messages.beliefs(own[at])
    beliefs[:, REST] += 1e-6
    labels[at] = beliefs.argmax(axis=1)
    return labels
