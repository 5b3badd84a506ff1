"""A bidirectional gated recurrent network over bytes that labels every position.

Texts are read in stretches of ``STRETCH`` bytes, each from a zero state in both
directions. A byte's input row already holds its product with the input weights,
so a step is one row lookup, one product with the recurrent weights and the
gates. With s(x) = x / (1 + |x|), a gate is (1 + s) / 2 and a candidate s, which
costs a fifth of the hyperbolic functions. Many stretches take each step
together. Training is backpropagation through time over whole stretches with
Adam updates.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the network reads from one zero state.
STRETCH = 64
#: Units of the state in each direction.
UNITS = 16
#: Rows of one matrix product; small enough for the BLAS library to stay on one thread.
ROWS = 256

_DIRECTIONS = ("ahead", "back")


def fresh(labels: int, seed: int, units: int = UNITS) -> dict[str, np.ndarray]:
    """Random weights: per direction an input row per byte, recurrent weights, a candidate bias and output weights."""
    rng = np.random.default_rng(seed)
    weights = {"bias": np.zeros(labels)}
    for side in _DIRECTIONS:
        weights[f"{side}_input"] = rng.normal(0, 0.3, (256, 3 * units))
        weights[f"{side}_state"] = rng.normal(0, 1 / np.sqrt(units), (units, 3 * units))
        weights[f"{side}_candidate"] = np.zeros(units)
        weights[f"{side}_output"] = rng.normal(0, 1 / np.sqrt(units), (units, labels))
    return {k: v.astype(np.float32) for k, v in weights.items()}


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first byte and length of all stretches of texts that lie one after the other in ``data``."""
    sizes = np.diff(offsets)
    many = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = offsets[owner] + nth * STRETCH
    return owner, start, np.minimum(offsets[owner + 1] - start, STRETCH)


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes (position, stretch) and which of them exist; missing ones are zero."""
    at = np.arange(STRETCH)[:, None]
    valid = at < length
    return np.where(valid, data[np.minimum(start + at, max(len(data) - 1, 0))], 0).astype(np.uint8), valid


def letters(codes: np.ndarray) -> np.ndarray:
    """Bytes that can belong to a letter: ASCII letters and all bytes of longer code points."""
    low = codes | 0x20
    return (codes >= 0x80) | ((low >= 0x61) & (low <= 0x7A))


def _bounded(x: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|) in place; ``room`` is overwritten."""
    np.abs(x, out=room)
    room += 1
    x /= room


def label_sums(weights: dict[str, np.ndarray], codes: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Per stretch the sum of the label probabilities of its letter positions.

    The number of stretches must be a multiple of ``ROWS``.
    """
    steps, many = codes.shape
    labels = len(weights["bias"])
    logits = np.empty((steps, many, labels), np.float32)
    logits[:] = weights["bias"]
    ragged = not valid.all()
    blocks = many // ROWS
    for side in _DIRECTIONS:
        units = len(weights[f"{side}_candidate"])
        table, recurrent, out = (weights[f"{side}_{part}"] for part in ("input", "state", "output"))
        gate_table, new_table = (np.ascontiguousarray(table[:, c]) for c in (slice(2 * units), slice(2 * units, None)))
        # Half of a reset gate's product is taken here, so gates stay 1 + s.
        gate_state, new_state = np.ascontiguousarray(recurrent[:, : 2 * units]), recurrent[:, 2 * units :] / 2
        bias = weights[f"{side}_candidate"] / 2
        state = np.zeros((many, units), np.float32)
        gates, gate_room = np.empty((2, many, 2 * units), np.float32)
        new, room = np.empty((2, many, units), np.float32)
        seen = np.empty((many, labels), np.float32)

        def times(matrix: np.ndarray, into: np.ndarray, state: np.ndarray = state, units: int = units) -> None:
            np.matmul(state.reshape(blocks, ROWS, units), matrix, out=into.reshape(blocks, ROWS, -1))

        for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
            np.take(gate_table, codes[t], axis=0, out=gates, mode="clip")
            times(gate_state, gate_room)
            gates += gate_room
            _bounded(gates, gate_room)
            gates += 1
            np.take(new_table, codes[t], axis=0, out=new, mode="clip")
            times(new_state, room)
            room += bias
            room *= gates[:, units:]
            new += room
            _bounded(new, room)
            state -= new
            state *= gates[:, :units]
            state *= 0.5
            state += new
            if ragged:
                state *= valid[t][:, None]
            times(out, seen)
            logits[t] += seen
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    weight = (letters(codes) & valid) / logits.sum(axis=2)
    return np.einsum("tbl,tb->bl", logits, weight.astype(np.float32))


def _forward(weights, side, codes, valid):
    units = len(weights[f"{side}_candidate"])
    state = np.zeros((codes.shape[1], units), weights["bias"].dtype)
    order = range(len(codes)) if side == "ahead" else range(len(codes) - 1, -1, -1)
    kept = []
    for t in order:
        given = weights[f"{side}_input"][codes[t]]
        held = state @ weights[f"{side}_state"]
        gates = given[:, : 2 * units] + held[:, : 2 * units]
        gates = (1 + gates / (1 + np.abs(gates))) / 2
        inner = held[:, 2 * units :] + weights[f"{side}_candidate"]
        new = given[:, 2 * units :] + gates[:, units:] * inner
        new = new / (1 + np.abs(new))
        after = (new + gates[:, :units] * (state - new)) * valid[t][:, None]
        kept.append((t, state, gates, inner, new, after))
        state = after
    return kept


def loss_and_gradient(weights: dict[str, np.ndarray], codes: np.ndarray, valid: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of the letter positions, each labelled like its stretch, and its gradient."""
    steps, many = codes.shape
    kept = {side: _forward(weights, side, codes, valid) for side in _DIRECTIONS}
    logits = np.zeros((steps, many, len(weights["bias"])), weights["bias"].dtype) + weights["bias"]
    for side in _DIRECTIONS:
        for t, *_, after in kept[side]:
            logits[t] += after @ weights[f"{side}_output"]
    logits -= logits.max(axis=2, keepdims=True)
    odds = np.exp(logits)
    odds /= odds.sum(axis=2, keepdims=True)
    weight = letters(codes) & valid
    total = max(1, int(weight.sum()))
    right = odds[:, np.arange(many), labels]
    loss = -float((np.log(np.maximum(right, 1e-9)) * weight).sum()) / total
    error = odds
    error[:, np.arange(many), labels] -= 1
    error *= (weight / total).astype(error.dtype)[:, :, None]
    gradient = {"bias": error.sum(axis=(0, 1))}
    flat = codes.ravel()
    order = np.argsort(flat, kind="stable")
    seen, begin = np.unique(flat[order], return_index=True)
    for side in _DIRECTIONS:
        units = len(weights[f"{side}_candidate"])
        state_weights, out = weights[f"{side}_state"], weights[f"{side}_output"]
        later = np.zeros((many, units), error.dtype)
        by_input = np.zeros((steps, many, 3 * units), error.dtype)
        by_state, by_out = np.zeros_like(state_weights), np.zeros_like(out)
        by_candidate = np.zeros(units, error.dtype)
        for t, before, gates, inner, new, after in reversed(kept[side]):
            by_out += after.T @ error[t]
            d = (later + error[t] @ out.T) * valid[t][:, None]
            keep, reset = gates[:, :units], gates[:, units:]
            d_new = d * (1 - keep) * (1 - np.abs(new)) ** 2
            d_keep = d * (before - new) * (1 - np.abs(2 * keep - 1)) ** 2 / 2
            d_reset = d_new * inner * (1 - np.abs(2 * reset - 1)) ** 2 / 2
            d_inner = d_new * reset
            by_input[t] = np.concatenate([d_keep, d_reset, d_new], 1)
            through = np.concatenate([d_keep, d_reset, d_inner], 1)
            by_state += before.T @ through
            by_candidate += d_inner.sum(axis=0)
            later = d * keep + through @ state_weights.T
        table = np.zeros_like(weights[f"{side}_input"])
        table[seen] = np.add.reduceat(by_input.reshape(-1, 3 * units)[order], begin, axis=0)
        gradient |= {
            f"{side}_input": table,
            f"{side}_state": by_state,
            f"{side}_candidate": by_candidate,
            f"{side}_output": by_out,
        }
    return loss, gradient


def fit(
    weights: dict[str, np.ndarray],
    codes: np.ndarray,
    valid: np.ndarray,
    labels: np.ndarray,
    epochs: int,
    rate: float,
    seed: int,
    batch: int = 128,
) -> dict[str, np.ndarray]:
    """Weights after some epochs of Adam updates over shuffled batches."""
    rng = np.random.default_rng(seed)
    weights = {k: v.copy() for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    turn = 0
    for _ in range(epochs):
        order = rng.permutation(codes.shape[1])
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            _, gradient = loss_and_gradient(weights, codes[:, some], valid[:, some], labels[some])
            turn += 1
            for k, g in gradient.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
                weights[k] -= (rate * step).astype(np.float32)
    return weights
