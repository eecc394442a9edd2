"""A two-state linear-chain conditional random field over tokens (ordinary, offending).

Tokens are numbered; all features of a token depend on its own letters, so a
token's emission score is computed once for each different token. Sequences
are stored one after another and ordered by length, so that step t of the
forward and backward passes is one vector operation over all sequences that
are longer than t.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np

#: Longest sequence; a longer sentence goes on in the next.
MOST_TOKENS = 256
#: Lengths of word beginnings that are features: inflected and compound words share them.
BEGINNINGS = (3, 4, 5, 6, 7)
_EDGES = "\"'()[]{}<>.,;:!?*#$%&|-_=+~`…«»„“”"


def core_of(token: str) -> str:
    return token.strip(_EDGES).lower()


def shape_of(token: str) -> str:
    return "upper" if token.isupper() else "title" if token[:1].isupper() else "lower"


def token_features(token: str) -> list[str]:
    core = core_of(token)
    return [f"w={core}", *(f"b={core[:n]}" for n in BEGINNINGS if n < len(core)), f"e={core[-3:]}", f"l={min(len(core), 12)}", f"k={shape_of(token)}"]


def ends_sentence(token: str) -> bool:
    return token[-1] in ".!?"


def sequences(ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each sequence: cut after sentence ends, between documents and at ``MOST_TOKENS``.

    ``docs`` are the starts of the (non-empty) documents.
    """
    n = len(ends)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.unique(np.concatenate([docs, np.flatnonzero(ends[:-1]) + 1])).astype(np.int64)
    sizes = np.diff(np.append(starts, n))
    pieces = -(-sizes // MOST_TOKENS)
    first = np.repeat(starts, pieces)
    within = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cut = first + within * MOST_TOKENS
    return cut, np.minimum(MOST_TOKENS, np.repeat(starts + sizes, pieces) - cut)


@dataclass
class Chain:
    """Transition factors and the passes over emission scores."""

    #: factors[s, t] of going from state s to t (0 ordinary, 1 offending); first[s] of starting in s
    factors: np.ndarray = field(default_factory=lambda: np.ones((2, 2)))
    first: np.ndarray = field(default_factory=lambda: np.ones(2))

    def passes(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Normalised forward and backward weight of the offending state at each token."""
        e = np.exp(np.clip(scores, -30, 30))
        (oo, ot), (to, tt) = self.factors
        ahead, behind = np.empty(len(e)), np.empty(len(e))
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        longer = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
        p = None
        for t, k in enumerate(longer.tolist()):
            at = starts[:k] + t
            if t == 0:
                on, off = self.first[1] * e[at], self.first[0]
            else:
                q = p[:k]
                on, off = (q * tt + (1 - q) * ot) * e[at], q * to + (1 - q) * oo
            p = on / (on + off)
            ahead[at] = p
        q = np.full(len(sizes), 0.5)  # beyond the end both states weigh the same
        for t in range(len(longer) - 1, -1, -1):
            k = longer[t]
            at = starts[:k] + t
            behind[at] = q[:k]
            on = tt * e[at] * q[:k] + to * (1 - q[:k])
            off = ot * e[at] * q[:k] + oo * (1 - q[:k])
            q[:k] = on / (on + off)
        return ahead, behind

    def marginals(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability of the offending state at each token."""
        ahead, behind = self.passes(scores, starts, sizes)
        on = ahead * behind
        return on / (on + (1 - ahead) * (1 - behind))

    def expectations(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Marginals, and the expected number of each of the 2x2 transitions; a token stands for ``counts`` of its kind."""
        ahead, behind = self.passes(scores, starts, sizes)
        on = ahead * behind
        follows = np.ones(len(scores), bool)
        follows[starts] = False
        all_, moves = np.flatnonzero(follows), np.zeros((2, 2))
        for part in range(0, len(all_), 100_000):
            now = all_[part : part + 100_000]
            e = np.exp(np.clip(scores[now], -30, 30))
            left = np.stack([1 - ahead[now - 1], ahead[now - 1]], 1)
            right = np.stack([1 - behind[now], behind[now] * e], 1)
            joint = left[:, :, None] * self.factors * right[:, None, :]
            each = 1.0 if counts is None else counts[now][:, None, None]
            moves += (each * joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return on / (on + (1 - ahead) * (1 - behind)), moves


class Features:
    """Numbers of the features of each different token, in two flat arrays."""

    def __init__(self, tokens: Iterable[str]):
        self.names: dict[str, int] = {}
        owner, feature = array("i"), array("i")
        for i, token in enumerate(tokens):
            for f in token_features(token):
                owner.append(i)
                feature.append(self.names.setdefault(f, len(self.names)))
        self.owner, self.feature = np.array(owner, np.int32), np.array(feature, np.int32)


def train(features: Features, ids: np.ndarray, states: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rounds: int = 60, rate: float = 0.3, decay: float = 2e-3, weights: np.ndarray | None = None) -> tuple[dict[str, float], float, Chain]:
    """Feature weights, bias and chain that maximise the likelihood of ``states`` (0 or 1 to a token).

    ``ids`` are the numbers of the tokens of ``features`` in order of
    appearance. Gradients are the difference of observed and expected counts
    (Adagrad on the whole sample). A sequence (in order of its start) counts
    ``weights`` times.
    """
    names, owner_, feature_ = features.names, features.owner, features.feature
    different = int(owner_.max()) + 1
    each = np.ones(len(ids)) if weights is None else np.repeat(weights, sizes)  # to a token
    share = np.average(states, weights=each)
    w, bias, moves, start = np.zeros(len(names)), np.log((share + 1e-6) / (1 - share + 1e-6)), np.zeros((2, 2)), np.zeros(2)
    total = [np.full(x.shape, 1e-8) for x in (w, np.zeros(1), moves, start)]
    follows = np.ones(len(ids), bool)
    follows[starts] = False
    now = np.flatnonzero(follows)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (states[now - 1], states[now]), each[now])
    seen_start = np.bincount(states[starts], weights=each[starts], minlength=2)
    observed = np.bincount(ids, weights=states * each, minlength=different)
    n = max(1.0, float((states * each).sum()))
    for _ in range(rounds):
        token_score = np.bincount(owner_, weights=w[feature_], minlength=different) + bias
        chain = Chain(np.exp(moves), np.exp(start))
        p, expected_moves = chain.expectations(token_score[ids], starts, sizes, each)
        missing = observed - np.bincount(ids, weights=p * each, minlength=different)
        grads = (
            np.bincount(feature_, weights=missing[owner_], minlength=len(w)) / n - decay * w,
            np.array([missing.sum() / n]),
            (seen_moves - expected_moves) / n - decay * moves,
            (seen_start - np.array([((1 - p[starts]) * each[starts]).sum(), (p[starts] * each[starts]).sum()])) / n - decay * start,
        )
        steps = []
        for g, t in zip(grads, total):
            t += g * g
            steps.append(rate * g / np.sqrt(t))
        w, bias, moves, start = w + steps[0], bias + steps[1][0], moves + steps[2], start + steps[3]
    return {f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-2}, float(bias), Chain(np.exp(moves), np.exp(start))
