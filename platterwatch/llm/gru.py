"""A bidirectional gated recurrent network over bytes, in numpy.

One step: z, r = sigmoid(A[x] + h U), n = tanh(B[x] + r * (h V)), h = n + z * (h - n), where x is a byte
(256 pads the end of a window). Two such networks read each window in either direction; their states
give the label of every position by a softmax layer. Training is backpropagation through time over
whole windows, with Adam.
"""

from __future__ import annotations

import numpy as np

PAD = 256


def sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def softmax(x: np.ndarray) -> np.ndarray:
    """In place. States lie between -1 and 1, so logits of trained weights are far from overflow."""
    np.exp(np.clip(x, -60, 60, out=x), out=x)
    x /= (x @ np.ones(x.shape[-1], x.dtype))[..., None]
    return x


def start(hidden: int, labels: int, seed: int) -> dict[str, np.ndarray]:
    rng, w = np.random.default_rng(seed), {}
    for side in "fb":
        w[f"A{side}"] = rng.normal(0, 0.3, (257, 2 * hidden))
        w[f"B{side}"] = rng.normal(0, 0.3, (257, hidden))
        w[f"U{side}"] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden))
        w[f"V{side}"] = rng.normal(0, hidden**-0.5, (hidden, hidden))
        w[f"W{side}"] = rng.normal(0, 0.3, (hidden, labels))
    w["c"] = np.zeros(labels)
    return {k: v.astype(np.float32) for k, v in w.items()}


def states(w: dict, side: str, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each step of byte windows x (steps, windows), in the order of x's steps."""
    a, b, u, v = (w[k + side] for k in "ABUV")
    hidden = len(u)
    out = np.empty((*x.shape, hidden), np.float32)
    h = np.zeros((x.shape[1], hidden), np.float32)
    steps = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
    for t in steps:
        zr = a.take(x[t], 0)
        zr += h @ u
        sigmoid(zr)
        hv = h @ v
        n = zr[:, hidden:] * hv
        n += b.take(x[t], 0)
        n *= 2  # tanh(n) = 2 sigmoid(2 n) - 1, faster than np.tanh
        sigmoid(n)
        n *= 2
        n -= 1
        if trace is not None:
            trace.append((t, h, zr, hv, n))
        h = h - n
        h *= zr[:, :hidden]
        h += n
        out[t] = h
    return out


def label_positions(w: dict, x: np.ndarray) -> np.ndarray:
    """Label probabilities of every position, (steps, windows, labels)."""
    x = x.astype(np.intp)
    logits = states(w, "f", x) @ w["Wf"]
    logits += states(w, "b", x) @ w["Wb"]
    logits += w["c"]
    return softmax(logits)


def gradients(w: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """(mean loss per position, gradients) for windows x with a label each."""
    g = {k: np.zeros_like(v) for k, v in w.items()}
    traces = {"f": [], "b": []}
    h = {side: states(w, side, x, traces[side]) for side in "fb"}
    p = softmax(h["f"] @ w["Wf"] + h["b"] @ w["Wb"] + w["c"])
    real = x != PAD
    n = max(1, int(real.sum()))
    picked = np.take_along_axis(p, np.broadcast_to(y[None, :, None], (*x.shape, 1)), 2)[..., 0]
    loss = float(-(np.log(picked + 1e-9) * real).sum() / n)
    d = p.copy()
    d[:, np.arange(x.shape[1]), y] -= 1
    d *= real[..., None] / np.float32(n)
    g["c"] = d.sum((0, 1))
    for side in "fb":
        g[f"W{side}"] = np.einsum("tbh,tbk->hk", h[side], d)
        back = d @ w[f"W{side}"].T
        through_time(w, g, side, x, traces[side], back)
    return loss, g


def through_time(w: dict, g: dict, side: str, x: np.ndarray, trace: list, back: np.ndarray) -> None:
    u, v = w[f"U{side}"], w[f"V{side}"]
    hidden, carry = len(u), 0
    for t, h, zr, hv, n in reversed(trace):
        dh = back[t] + carry
        z, r = zr[:, :hidden], zr[:, hidden:]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * hv * r * (1 - r)
        dzr = np.concatenate([dz, dr], axis=1)
        dhv = dn * r
        carry = dh * z + dzr @ u.T + dhv @ v.T
        g[f"U{side}"] += h.T @ dzr
        g[f"V{side}"] += h.T @ dhv
        np.add.at(g[f"A{side}"], x[t], dzr)
        np.add.at(g[f"B{side}"], x[t], dn)


def train(
    x: np.ndarray, y: np.ndarray, labels: int, hidden: int, rounds: int, batch: int, seed: int
) -> dict[str, np.ndarray]:
    """Weights after a fixed number of Adam rounds over windows x (steps, windows)."""
    w = start(hidden, labels, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    s = {k: np.zeros_like(v) for k, v in w.items()}
    for k in range(1, rounds + 1):
        chosen = rng.integers(0, x.shape[1], batch)
        _, g = gradients(w, x[:, chosen], y[chosen])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = 0.02 * min(1, 2 * (1 - k / (rounds + 1)))
        for name, d in g.items():
            d = d * min(1.0, 1 / (norm + 1e-9))
            m[name] += 0.1 * (d - m[name])
            s[name] += 0.01 * (d * d - s[name])
            w[name] -= rate * (m[name] / (1 - 0.9**k)) / (np.sqrt(s[name] / (1 - 0.99**k)) + 1e-6)
    return {k: v.astype(np.float32) for k, v in w.items()}
