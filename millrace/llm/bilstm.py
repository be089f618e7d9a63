"""A small character BiLSTM with CRF transitions in numpy."""

from __future__ import annotations

import numpy as np

#: Embedding and hidden sizes; each direction has one layer.
EMBEDDED, HIDDEN = 12, 16
#: ASCII has a code each; other characters share one by kind.
CODES = 132


def codes_of(text: str) -> np.ndarray:
    """Character codes: ASCII as it is, others as lower letter, capital, digit or something else."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = points.astype(np.int64)
    for at in np.flatnonzero(points > 127).tolist():
        c = text[at]
        codes[at] = 128 + (0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3)
    return codes


def new_parameters(tags: int, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))

    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    made = {"embedding": drawn(CODES, EMBEDDED), "out": drawn(2 * HIDDEN, tags), "bias": np.zeros(tags)}
    for side in ("f", "b"):
        made[f"x_{side}"] = drawn(EMBEDDED, 4 * HIDDEN)
        made[f"h_{side}"] = drawn(HIDDEN, 4 * HIDDEN)
        made[f"c_{side}"] = np.zeros(4 * HIDDEN)
        made[f"c_{side}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    made |= {"step": np.zeros((tags, tags)), "first": np.zeros(tags), "last": np.zeros(tags)}
    return {name: value.astype(np.float32) for name, value in made.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, wh: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states (time, rows, HIDDEN) of inputs already times their weights."""
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    out, saved = np.empty((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(x.shape[0]):
        g = x[t] + h @ wh
        gates = _sigmoid(g[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        z = np.tanh(g[:, 3 * HIDDEN :])
        before, c = c, f * c + i * z
        if keep:
            saved.append((h, before, i, f, o, z, c))
        h = o * np.tanh(c)
        out[t] = h
    return out, saved


def _lstm_gradient(d_out: np.ndarray, wh: np.ndarray, saved: list) -> tuple[np.ndarray, np.ndarray]:
    d_x = np.empty((*d_out.shape[:2], 4 * HIDDEN), np.float32)
    d_wh = np.zeros_like(wh)
    d_h = d_c = np.zeros(d_out.shape[1:], np.float32)
    for t in range(len(saved) - 1, -1, -1):
        h, before, i, f, o, z, c = saved[t]
        d_h = d_h + d_out[t]
        tanh_c = np.tanh(c)
        d_c = d_c + d_h * o * (1 - tanh_c**2)
        d_g = d_x[t]
        d_g[:, :HIDDEN] = d_c * z * i * (1 - i)
        d_g[:, HIDDEN : 2 * HIDDEN] = d_c * before * f * (1 - f)
        d_g[:, 2 * HIDDEN : 3 * HIDDEN] = d_h * tanh_c * o * (1 - o)
        d_g[:, 3 * HIDDEN :] = d_c * i * (1 - z**2)
        d_wh += h.T @ d_g
        d_h, d_c = d_g @ wh.T, d_c * f
    return d_x, d_wh


def scores(p: dict[str, np.ndarray], codes: np.ndarray, saved: dict | None = None) -> np.ndarray:
    """Tag scores (time, rows, tags) of windows of codes (rows, time)."""
    x = p["embedding"][codes.T]
    sides = []
    for side in ("f", "b"):
        ordered = x if side == "f" else x[::-1]
        h, kept = _lstm(ordered @ p[f"x_{side}"] + p[f"c_{side}"], p[f"h_{side}"], saved is not None)
        sides.append(h if side == "f" else h[::-1])
        if saved is not None:
            saved[side] = ordered, kept
    both = np.concatenate(sides, axis=2)
    if saved is not None:
        saved["both"] = both
    return both @ p["out"] + p["bias"]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def loss_and_gradient(p: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray):
    """Mean negative log likelihood of the tag paths, and its gradient."""
    saved: dict = {}
    s = scores(p, codes, saved)
    time, rows, kinds = s.shape
    gold = tags.T
    ahead = np.empty_like(s)
    ahead[0] = s[0] + p["first"]
    for t in range(1, time):
        ahead[t] = s[t] + _log_sum(ahead[t - 1][:, :, None] + p["step"], 1)
    total = _log_sum(ahead[-1] + p["last"], 1)
    back = np.empty_like(s)
    back[-1] = p["last"]
    for t in range(time - 2, -1, -1):
        back[t] = _log_sum(p["step"] + (s[t + 1] + back[t + 1])[:, None, :], 2)
    d_s = np.exp(ahead + back - total[:, None])
    d_step = np.zeros_like(p["step"])
    for t in range(1, time):
        pair = ahead[t - 1][:, :, None] + p["step"] + (s[t] + back[t])[:, None, :] - total[:, None, None]
        d_step += np.exp(pair).sum(axis=0)
    at = np.arange(rows)
    path = p["first"][gold[0]] + p["last"][gold[-1]] + s[0, at, gold[0]]
    d_first, d_last = d_s[0].sum(axis=0), d_s[-1].sum(axis=0)
    np.subtract.at(d_first, gold[0], 1)
    np.subtract.at(d_last, gold[-1], 1)
    for t in range(time):
        d_s[t, at, gold[t]] -= 1
        if t:
            path = path + s[t, at, gold[t]] + p["step"][gold[t - 1], gold[t]]
            np.subtract.at(d_step, (gold[t - 1], gold[t]), 1)
    d_s /= rows
    grad = {"step": d_step / rows, "first": d_first / rows, "last": d_last / rows}
    flat = d_s.reshape(-1, kinds)
    grad["out"] = saved["both"].reshape(-1, 2 * HIDDEN).T @ flat
    grad["bias"] = flat.sum(axis=0)
    d_both = d_s @ p["out"].T
    d_embedding = np.zeros_like(p["embedding"])
    for side, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[::-1, :, HIDDEN:])):
        ordered, kept = saved[side]
        d_x, grad[f"h_{side}"] = _lstm_gradient(part, p[f"h_{side}"], kept)
        grad[f"x_{side}"] = ordered.reshape(-1, EMBEDDED).T @ d_x.reshape(-1, 4 * HIDDEN)
        grad[f"c_{side}"] = d_x.sum(axis=(0, 1))
        ends = codes.T if side == "f" else codes.T[::-1]
        np.add.at(d_embedding, ends, d_x @ p[f"x_{side}"].T)
    grad["embedding"] = d_embedding
    return float((total - path).mean()), grad


def fitted(
    codes: np.ndarray, tags: np.ndarray, kinds: int, steps: int = 500, batch: int = 64, rate: float = 0.02
) -> dict[str, np.ndarray]:
    """Parameters trained by Adam on windows (rows, time) and their tags; the same each time."""
    p = new_parameters(kinds)
    mean = {name: np.zeros_like(v) for name, v in p.items()}
    spread = {name: np.zeros_like(v) for name, v in p.items()}
    rng = np.random.Generator(np.random.PCG64(5))
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(codes), batch)
        _, grad = loss_and_gradient(p, codes[rows], tags[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
        now = rate * min(1.0, 5.0 / max(norm, 1e-9)) * (1 - 0.9 * step / steps)
        for name, g in grad.items():
            mean[name] += 0.1 * (g - mean[name])
            spread[name] += 0.01 * (g * g - spread[name])
            unbiased = np.sqrt(spread[name] / (1 - 0.99**step)) + 1e-6
            p[name] = (p[name] - now * mean[name] / (1 - 0.9**step) / unbiased).astype(np.float32)
    return p


def best_paths(p: dict[str, np.ndarray], codes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Best tag path (rows, time) of each window; ``allowed`` tells which tag may follow which."""
    s = scores(p, codes)
    step = np.where(allowed, p["step"], -1e9)
    back = np.empty(s.shape, np.int64)
    best = s[0] + p["first"] + np.where(allowed[0], 0, -1e9)
    for t in range(1, len(s)):
        through = best[:, :, None] + step
        back[t] = through.argmax(axis=1)
        best = np.take_along_axis(through, back[t][:, None, :], 1)[:, 0] + s[t]
    path = np.empty(codes.shape, np.int64)
    path[:, -1] = (best + p["last"]).argmax(axis=1)
    for t in range(len(s) - 1, 0, -1):
        path[:, t - 1] = np.take_along_axis(back[t], path[:, t][:, None], 1)[:, 0]
    return path
