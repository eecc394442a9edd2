"""Hidden Markov chains over whole sequences of symbols: exact likelihoods and Baum-Welch counts, in numpy.

A sequence is cut into segments of at most ``SEGMENT`` symbols that are worked
on side by side. So that nothing changes by the cuts, each segment of a longer
sequence is first reduced to its transfer matrix (what it does to any
distribution over states); products of these give the exact distribution in
which each segment starts and the exact weight of all that follows it.
Probabilities are scaled at each symbol. Memory follows ``BLOCK`` symbols and
one matrix for each segment, not the length of a sequence. All work is done in
the chain's own precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SEGMENT = 1024
BLOCK = 400_000


@dataclass(frozen=True)
class Chain:
    """``start`` (states), ``move`` (from, to) and ``emit`` (symbol, state); emissions of a state sum to 1."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def single(self) -> Chain:
        """In single precision."""
        return Chain(*(a.astype(np.float32) for a in (self.start, self.move, self.emit)))


class Segments:
    """Segments of sequences laid end to end (``sizes``, each at least 1), in their order."""

    def __init__(self, sizes: np.ndarray) -> None:
        pieces = -(-sizes // SEGMENT)
        self.sequence = np.repeat(np.arange(len(sizes)), pieces)
        self.nth = np.arange(len(self.sequence)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + self.nth * SEGMENT
        self.size = np.minimum(SEGMENT, np.repeat(sizes, pieces) - self.nth * SEGMENT)
        self.pieces = pieces
        self.first = np.cumsum(pieces) - pieces

    def blocks(self, of: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Numbers of neighbouring segments, about ``BLOCK`` symbols at a time."""
        chosen = np.arange(len(self.size)) if of is None else of
        group = (np.cumsum(self.size[chosen]) - self.size[chosen]) // BLOCK
        yield from np.split(chosen, np.flatnonzero(np.diff(group)) + 1) if len(chosen) else []


class _Packed:
    """A block's segments, longest first, symbol by symbol: the symbols at one distance from the start are neighbours."""

    def __init__(self, begin: np.ndarray, size: np.ndarray) -> None:
        self.order = np.argsort(-size, kind="stable")
        steps = np.arange(int(size.max()))
        self.alive = np.searchsorted(-size[self.order], -steps, side="left")  # segments longer than each distance
        offset = np.cumsum(self.alive) - self.alive
        total = int(size.sum())
        segment = np.repeat(np.arange(len(size)), size)
        step = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        rank = np.empty(len(size), np.int64)
        rank[self.order] = np.arange(len(size))
        self.to = offset[step] + rank[segment]  # from the order of the sequences into this one
        self.at = np.empty(total, np.int64)
        self.at[self.to] = begin[segment] + step
        self.offset = offset


def _forward(chain: Chain, emit: np.ndarray, packed: _Packed, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filtered state distribution and scale of each symbol; ``ahead``: distribution in which each segment starts."""
    alpha, scale = np.empty_like(emit), np.empty(len(emit), emit.dtype)
    for o, n in zip(packed.offset.tolist(), packed.alive.tolist()):
        a = ahead[:n] * emit[o : o + n]
        s = a.sum(1)
        a /= s[:, None]
        alpha[o : o + n], scale[o : o + n] = a, s
        ahead = a @ chain.move
    return alpha, scale


def _transfers(chain: Chain, symbols: np.ndarray, segments: Segments, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled transfer matrix of each chosen segment and the logarithm of its scale."""
    k = len(chain.start)
    out, logs = np.empty((len(chosen), k, k)), np.empty(len(chosen))
    done = 0
    for block in segments.blocks(chosen):
        packed = _Packed(segments.begin[block], segments.size[block])
        emit = chain.emit[symbols[packed.at]]
        x = np.broadcast_to(np.eye(k, dtype=emit.dtype), (len(block), k, k)).copy()
        log = np.zeros(len(block))
        for o, n in zip(packed.offset.tolist(), packed.alive.tolist()):
            y = x[:n] * emit[o : o + n, None, :]
            s = y.sum((1, 2))
            y /= s[:, None, None]
            log[:n] += np.log(s)
            x[:n] = (y.reshape(-1, k) @ chain.move).reshape(n, k, k)
        out[done + packed.order], logs[done + packed.order] = x, log
        done += len(block)
    return out, logs


def _scan(chain: Chain, segments: Segments, matrices: np.ndarray, logs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the chosen segments (all of some sequences): distribution ahead of each, weight of what follows, log-likelihood by segment."""
    k = len(chain.start)
    ahead, follows, likely = np.empty((len(chosen), k)), np.ones((len(chosen), k)), np.zeros(len(chosen))
    nth = segments.nth[chosen]
    last = segments.pieces[segments.sequence[chosen]] - 1
    by_nth = np.argsort(nth, kind="stable")
    levels = np.split(by_nth, np.flatnonzero(np.diff(nth[by_nth])) + 1)
    for level in levels:
        v = np.where(nth[level, None] == 0, chain.start, ahead[level])
        ahead[level] = v
        v = (v[:, None, :] @ matrices[level])[:, 0]
        s = v.sum(1)
        likely[level] = np.log(s) + logs[level]
        on = level[nth[level] < last[level]]
        ahead[on + 1] = (v / s[:, None])[nth[level] < last[level]]
    for level in reversed(levels[1:]):
        w = (matrices[level] @ follows[level][:, :, None])[:, :, 0]
        follows[level - 1] = w / w.sum(1, keepdims=True)
    return ahead, follows, likely


def log_likelihoods(chain: Chain, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each sequence of ``symbols`` (laid end to end)."""
    segments = Segments(sizes)
    out = np.zeros(len(sizes))
    long = np.flatnonzero(segments.pieces[segments.sequence] > 1)
    if len(long):
        likely = _scan(chain, segments, *_transfers(chain, symbols, segments, long), long)[2]
        np.add.at(out, segments.sequence[long], likely)
    for block in segments.blocks(np.flatnonzero(segments.pieces[segments.sequence] == 1)):
        packed = _Packed(segments.begin[block], segments.size[block])
        ahead = np.broadcast_to(chain.start, (len(block), len(chain.start)))
        scale = _forward(chain, chain.emit[symbols[packed.at]], packed, ahead)[1]
        owner = np.repeat(np.arange(len(block)), segments.size[block])
        out[segments.sequence[block]] = np.bincount(owner, np.log(scale)[packed.to], len(block))
    return out


class Counts:
    """Expected counts of Baum-Welch: of first states, of moves, and of (symbol, state); and the log-likelihood."""

    def __init__(self, chain: Chain) -> None:
        self.chain = chain
        self.start, self.move, self.emit = (np.zeros(a.shape) for a in (chain.start, chain.move, chain.emit))
        self.likely = 0.0

    def add(self, symbols: np.ndarray, sizes: np.ndarray) -> None:
        chain = self.chain
        segments = Segments(sizes)
        k = len(chain.start)
        ahead = np.broadcast_to(chain.start, (len(segments.size), k)).copy()
        follows = np.ones((len(segments.size), k))
        long = np.flatnonzero(segments.pieces[segments.sequence] > 1)
        if len(long):
            ahead[long], follows[long], _ = _scan(chain, segments, *_transfers(chain, symbols, segments, long), long)
        last = np.zeros((0, k))  # state at the end of the block before, if a sequence goes on
        for block in segments.blocks():
            packed = _Packed(segments.begin[block], segments.size[block])
            own = symbols[packed.at].astype(np.intp)
            emit = chain.emit[own]
            alpha, scale = _forward(chain, emit, packed, ahead[block][packed.order].astype(emit.dtype))
            self.likely += float(np.log(scale).sum(dtype=float))
            beta = (follows[block] @ chain.move.T)[packed.order].astype(emit.dtype)
            weight = np.empty_like(emit)  # of each symbol's state, by it and all that follows
            for o, n in zip(packed.offset[::-1].tolist(), packed.alive[::-1].tolist()):
                alpha[o : o + n] *= beta[:n]
                u = beta[:n] * emit[o : o + n]
                u /= u.sum(1, keepdims=True)
                weight[o : o + n] = u
                beta[:n] = u @ chain.move.T
            # alpha now holds filtered state times what follows: normalised, the posterior
            posterior = alpha / alpha.sum(1, keepdims=True)
            for s, column in enumerate(np.ascontiguousarray(posterior.T, np.float64)):
                self.emit[:, s] += np.bincount(own, column, len(chain.emit))
            firsts = (np.cumsum(segments.size[block]) - segments.size[block])[segments.nth[block] == 0]
            posterior, weight = posterior[packed.to], weight[packed.to]
            self.start += posterior[firsts].sum(0)
            if len(last) and 0 not in firsts[:1]:  # the block goes on with the sequence of the one before
                self._moves(last, weight[:1], firsts[:0])
            self._moves(posterior[:-1], weight[1:], firsts[firsts > 0] - 1)
            last = posterior[-1:].copy()

    def _moves(self, before: np.ndarray, after: np.ndarray, none: np.ndarray) -> None:
        """Expected moves from the state before each symbol, but for the rows ``none``, which begin a sequence.

        Given the state before and all symbols, the next state is as ``move``
        times its weight.
        """
        total = after @ self.chain.move.T  # by the state before: sum over next states
        total[none] = np.inf
        self.move += self.chain.move * ((before / total).T @ after)


def mixture_counts(chain: Chain, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected counts of sequences and of (symbol, state) if each sequence kept one state from end to end."""
    k = len(chain.start)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    logs = np.log(chain.emit)
    likely = np.tile(np.log(chain.start, dtype=float), (len(sizes), 1))
    parts = [slice(a, a + BLOCK) for a in range(0, len(symbols), BLOCK)]
    for part in parts:
        first = np.flatnonzero(np.diff(owner[part], prepend=-1))
        likely[owner[part][first]] += np.add.reduceat(logs[symbols[part]], first, axis=0)
    posterior = np.exp(likely - likely.max(1, keepdims=True))
    posterior /= posterior.sum(1, keepdims=True)
    emit = np.zeros(chain.emit.shape)
    for part in parts:
        for s in range(k):
            emit[:, s] += np.bincount(symbols[part], posterior[owner[part], s], len(emit))
    return posterior.sum(0), emit


def refit(chain: Chain, start: np.ndarray, move: np.ndarray, emit: np.ndarray, prior: np.ndarray, strength: float) -> Chain:
    """The chain of given counts; emissions lean towards ``prior`` as ``strength`` more symbols of each state would."""
    moved = move + 1.0
    begun = start + 1.0
    out = emit + strength * prior[:, None]
    return Chain(begun / begun.sum(), moved / moved.sum(1, keepdims=True), out / out.sum(0))
