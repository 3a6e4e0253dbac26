"""Hidden Markov chains over class sequences: scaled forward recursion and Baum-Welch counts, in numpy.

Sequences are worked on side by side, longest first, one step of time after another, so a step is a few
array operations whatever the number of sequences. A sequence of over ``SEGMENT`` symbols is scored in
segments, each from every start state at once, and the segments are then multiplied: the likelihood is
exact and one long sequence doesn't hold up a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEGMENT, TRAIN_SEGMENT, CHUNK = 4_096, 1_024, 400_000


@dataclass
class Chain:
    """Start (K), transitions (K, K), and emissions by symbol (C, K)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _in_step(starts: np.ndarray, lengths: np.ndarray):
    """Rows in order of falling length, and how many are still running at each step."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    running = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), "left")
    return order, starts[order], running


def _run(chain: Chain, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray, opening: bool) -> tuple[np.ndarray, np.ndarray]:
    """Scaled state vectors after the last symbol of each row, and the logarithms of their scales.

    ``opening``: ``first`` holds chances at the first symbol; else those before it, to be moved once.
    """
    order, at, running = _in_step(starts, lengths)
    now, logs = first[order].astype(float), np.zeros(len(order))
    for t, m in enumerate(running.tolist()):
        live = now[:m]
        if t or not opening:
            live = live @ chain.move
        live = live * chain.emit[symbols[at[:m] + t]]
        scale = live.sum(axis=1)
        now[:m] = live / scale[:, None]
        logs[:m] += np.log(scale)
    out, out_logs = np.empty_like(now), np.empty_like(logs)
    out[order], out_logs[order] = now, logs
    return out, out_logs


def log_likelihoods(chain: Chain, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The natural logarithm of each row's likelihood; an empty row has likelihood 1."""
    starts, lengths = rows[:-1].astype(np.int64), np.diff(rows).astype(np.int64)
    heads = np.minimum(lengths, SEGMENT)
    now, logs = _run(chain, symbols, starts, heads, np.repeat(chain.start[None], len(starts), axis=0), True)
    long = np.flatnonzero(lengths > SEGMENT)
    if not len(long):
        return logs
    states = len(chain.start)
    pieces = [(k, s) for k in long for s in range(SEGMENT, int(lengths[k]), SEGMENT)]
    begin = np.repeat([starts[k] + s for k, s in pieces], states)
    size = np.repeat([min(SEGMENT, int(lengths[k]) - s) for k, s in pieces], states)
    moved, scales = _run(chain, symbols, begin, size, np.tile(np.eye(states), (len(pieces), 1)), False)
    for p, (k, _) in enumerate(pieces):
        part, scale = moved[p * states : (p + 1) * states], scales[p * states : (p + 1) * states]
        top = scale.max()
        vector = (now[k] * np.exp(scale - top)) @ part
        now[k], logs[k] = vector / vector.sum(), logs[k] + top + np.log(vector.sum())
    return logs


def expected_counts(chain: Chain, symbols: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts: of start states, transitions, and emissions by symbol.

    Rows of over ``TRAIN_SEGMENT`` symbols count as several sequences, of which the first one opens.
    """
    states = len(chain.start)
    starts, lengths = rows[:-1].astype(np.int64), np.diff(rows).astype(np.int64)
    pieces = -(-lengths // TRAIN_SEGMENT)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(starts, pieces) + part * TRAIN_SEGMENT
    size = np.minimum(np.repeat(lengths, pieces) - part * TRAIN_SEGMENT, TRAIN_SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin, size, opening = begin[order], size[order], (part == 0)[order]
    first, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros(chain.emit.shape)
    usual = chain.start @ np.linalg.matrix_power(chain.move, 64)
    cuts = np.searchsorted(np.cumsum(size), np.arange(0, size.sum() + CHUNK, CHUNK))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            f, m, seen, chances = _counts(chain, symbols, begin[a:b], size[a:b], opening[a:b], usual)
            first += f
            move += m
            for k in range(states):
                emit[:, k] += np.bincount(seen, chances[:, k], len(emit))
    return first, move, emit


def _counts(chain: Chain, symbols: np.ndarray, at: np.ndarray, size: np.ndarray, opening: np.ndarray, usual: np.ndarray):
    """Rows must come in order of falling length."""
    running = np.searchsorted(-size, -np.arange(size[0]), "left")
    offsets = np.concatenate([[0], np.cumsum(running)])
    ahead, seen, scales = np.empty((offsets[-1], len(chain.start))), np.empty(offsets[-1], np.int64), np.empty(offsets[-1])
    now = np.where(opening[:, None], chain.start, usual)
    for t, m in enumerate(running.tolist()):
        here = slice(offsets[t], offsets[t] + m)
        s = symbols[at[:m] + t]
        now = (now[:m] @ chain.move if t else now[:m]) * chain.emit[s]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        ahead[here], seen[here], scales[here] = now, s, scale
    move = np.zeros_like(chain.move)
    behind = np.ones((running[-1], len(chain.start)))
    for t in range(len(running) - 1, 0, -1):
        m, before = running[t], running[t - 1]
        here, earlier = slice(offsets[t], offsets[t] + m), slice(offsets[t - 1], offsets[t - 1] + m)
        weighted = chain.emit[seen[here]] * behind / scales[here, None]
        ahead[here] *= behind
        move += ahead[earlier].T @ weighted
        behind = np.ones((before, len(chain.start)))
        behind[:m] = weighted @ chain.move.T
    ahead[: running[0]] *= behind
    return ahead[: running[0]][opening].sum(axis=0), move * chain.move, seen, ahead


def refitted(first: np.ndarray, move: np.ndarray, emit: np.ndarray, usual: np.ndarray, weight: float = 20.0) -> Chain:
    """A chain from counts; emissions lean on the symbols' overall chances, transitions on one count each."""
    emit = emit + weight * usual[:, None]
    return Chain((first + 1) / (first + 1).sum(), (move + 1) / (move + 1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def seeded_chain(usual: np.ndarray, states: int, spread: float = 0.5, seed: int = 5) -> Chain:
    """A chain to begin with that no text was drawn for: each state's emissions are the symbols' overall chances, perturbed."""
    emit = usual[:, None] * np.exp(spread * np.random.default_rng(seed).standard_normal((len(usual), states)))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    return Chain(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def first_chain(symbols: np.ndarray, rows: np.ndarray, usual: np.ndarray, states: int, rounds: int = 12, seed: int = 5) -> Chain:
    """A chain to begin with: states as clusters of whole rows, each row drawn from one state's emissions."""
    rng = np.random.default_rng(seed)
    n = len(rows) - 1
    lengths = np.diff(rows)
    share = np.full((states, len(usual)), usual) if n == 0 else None
    row_of = np.repeat(np.arange(n), lengths)
    chance = rng.dirichlet(np.full(states, 0.3), n)
    for _ in range(rounds if n else 0):
        share = np.stack([np.bincount(symbols, chance[row_of, k], len(usual)) for k in range(states)]) + 20 * usual
        share /= share.sum(axis=1, keepdims=True)
        logs = np.stack([np.bincount(row_of, np.log(share[k][symbols]), n) for k in range(states)], axis=1) / np.maximum(lengths, 1)[:, None] ** 0.5
        logs += np.log(chance.mean(axis=0) + 1e-3)
        chance = np.exp(logs - logs.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    return Chain(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), share.T.copy())
