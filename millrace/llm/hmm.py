"""Hidden Markov model over token classes in numpy: Baum-Welch counts and scaled forward."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Tokens that are worked on one after the other when counts are made; longer sequences go side by side.
SEGMENT = 512


@dataclass(frozen=True)
class Hmm:
    first: np.ndarray  # (states)
    step: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states): chance of each class in a state

    @staticmethod
    def start(shares: np.ndarray, states: int, seed: int = 3) -> Hmm:
        """States that stay, with the classes' shares disturbed differently in each."""
        rng = np.random.Generator(np.random.PCG64(seed))
        emit = shares[:, None] * np.exp(rng.normal(0, 0.5, (len(shares), states)))
        step = np.full((states, states), 0.02 / max(1, states - 1))
        np.fill_diagonal(step, 0.98 if states > 1 else 1.0)
        return Hmm(np.full(states, 1 / states), step, emit / emit.sum(axis=0))

    def reestimated(self, first: np.ndarray, step: np.ndarray, emit: np.ndarray, shares: np.ndarray) -> Hmm:
        """Parameters from expected counts. A prior of the class shares keeps every chance above 0."""
        first = first + 1
        step = step + 1
        emit = emit + 50 * shares[:, None]
        return Hmm(first / first.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _lanes(sequences: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Sequences, longest first: order, all classes end to end, starts, and how many reach each step."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([sequences[k] for k in order])
    sorted_lengths = lengths[order]
    starts = np.cumsum(sorted_lengths) - sorted_lengths
    alive = np.searchsorted(-sorted_lengths, -np.arange(1, sorted_lengths[0] + 1), "right")
    return order, flat, starts, alive


def log_likelihoods(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log of the chance of each non-empty sequence, by scaled forward recursion."""
    if not sequences:
        return np.zeros(0)
    order, flat, starts, alive = _lanes(sequences)
    total = np.zeros(len(sequences))
    state = None
    for t, n in enumerate(alive.tolist()):
        emitted = model.emit[flat[starts[:n] + t]]
        state = model.first * emitted if t == 0 else (state[:n] @ model.step) * emitted
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(
    model: Hmm, sequences: list[np.ndarray], segment: int = SEGMENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected first states, transitions and (classes, states) emissions of non-empty sequences.

    Long sequences are worked on in segments side by side, which changes nothing: each segment begins with
    the state that the whole sequence gives it, ends with the chance of all that follows, and the
    transition into it is counted.
    """
    single = Hmm(*(x.astype(np.float32) for x in (model.first, model.step, model.emit)))
    states = len(model.first)
    pieces, before, after, inner = _segments(single, sequences, segment)
    order, flat, starts, alive = _lanes(pieces)
    before, after, inner = before[order], after[order], inner[order]
    forward, scales = [], []
    for t, n in enumerate(alive.tolist()):
        emitted = single.emit[flat[starts[:n] + t]]
        if t == 0:
            state = np.where(inner[:, None], before @ single.step, single.first) * emitted
        else:
            state = (forward[-1][:n] @ single.step) * emitted
        scale = state.sum(axis=1, keepdims=True)
        forward.append(state / scale)
        scales.append(scale)
    share = np.empty((len(flat), states), np.float32)
    steps = np.zeros((states, states))
    m, through = 0, np.empty((0, states), np.float32)
    for t in range(len(alive) - 1, -1, -1):
        n = int(alive[t])
        ahead = np.empty((n, states), np.float32)
        steps += forward[t][:m].T @ through
        ahead[:m] = through @ single.step.T
        # Segments that end here; the shares of a token's states add up to one.
        ahead[m:] = after[m:n] / (forward[t][m:] * after[m:n]).sum(axis=1, keepdims=True)
        share[starts[:n] + t] = forward[t] * ahead
        through = single.emit[flat[starts[:n] + t]] * ahead / scales[t]
        m = n
    steps += before[inner].T @ through[inner]
    emitted = np.stack([np.bincount(flat, share[:, s], len(model.emit)) for s in range(states)], axis=1)
    return share[starts[~inner]].sum(axis=0).astype(float), steps * model.step, emitted


def _segments(
    model: Hmm, sequences: list[np.ndarray], segment: int
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of all sequences; the state before each, the chances of what comes after, whether it has one before.

    A segment turns the state it begins with into the one it ends with by a matrix. The matrices of all segments
    are made side by side, so a sequence costs a few steps per segment, not per token, one after the other.
    """
    pieces = [s for s in sequences if len(s) <= segment]
    short, states = len(pieces), len(model.first)
    long = [s for s in sequences if len(s) > segment]
    pieces += [s[at : at + segment] for s in long for at in range(0, len(s), segment)]
    before = np.ones((len(pieces), states), np.float32)
    after, inner = before.copy(), np.zeros(len(pieces), bool)
    if long:
        through = _transfers(model, pieces[short:])
        at = short
        for s in long:
            stop = at - (-len(s) // segment)
            state = model.first @ through[at - short]
            for j in range(at + 1, stop):
                before[j] = state / state.sum()
                state = (before[j] @ model.step) @ through[j - short]
            for j in range(stop - 1, at, -1):
                ahead = model.step @ (through[j - short] @ after[j])
                after[j - 1] = ahead / ahead.sum()
            inner[at + 1 : stop] = True
            at = stop
    return pieces, before, after, inner


def _transfers(model: Hmm, pieces: list[np.ndarray]) -> np.ndarray:
    """(pieces, states, states): chance, up to a factor a piece, of its tokens and last state given its first."""
    order, flat, starts, alive = _lanes(pieces)
    states = len(model.first)
    matrix = np.eye(states, dtype=np.float32) * model.emit[flat[starts]][:, None, :]
    for t, n in enumerate(alive.tolist()[1:], 1):
        grown = (matrix[:n].reshape(-1, states) @ model.step).reshape(n, states, states)
        grown *= model.emit[flat[starts[:n] + t]][:, None, :]
        matrix[:n] = grown / grown.max(axis=(1, 2), keepdims=True)
    out = np.empty_like(matrix)
    out[order] = matrix
    return out
