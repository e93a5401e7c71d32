"""A bidirectional gated recurrent network with attention pooling, over characters and words, in numpy.

The bytes of a word go through a character network (embedding, bidirectional gated recurrent
units, attention over positions) to a vector. With an embedding of the word's hash it
is the input of a second network of the same kind over the words of a window, whose
pooled state gives the window's logit. Both are trained together by Adam.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a token; longer words are several tokens.
TOKEN_BYTES = 20
#: Words of a window, and how far the next window begins: all windows overlap by half.
WINDOW, STRIDE = 32, 16
CHAR_DIM, CHAR_STATE, WORD_DIM, WORD_STATE = 8, 8, 8, 8
WORD_BUCKETS = 1 << 12
#: Rows that the network works on at once, so that they stay in a processor's cache.
CHUNK = 1 << 11


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _halves(inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gate inputs of the two directions."""
    half = inputs.shape[1] // 2
    return np.ascontiguousarray(inputs[:, :half]), np.ascontiguousarray(inputs[:, half:])


class Layer:
    """Bidirectional units and attention pooling over the steps of ``inputs`` (rows, steps, 6 * state).

    The inputs are those of the gates, already multiplied by the input weights: the
    first half for the forward direction, the second for the backward one.
    """

    def __init__(self, weights: dict[str, np.ndarray], name: str):
        self.u = (weights[f"{name}_uf"], weights[f"{name}_ub"])
        self.v = weights[f"{name}_v"]
        self.name, self.state = name, self.u[0].shape[0]

    def forward(self, inputs, mask: np.ndarray, keep: bool = False) -> np.ndarray:
        """The pooled state of each row. ``inputs(d, t)`` gives the gate inputs of direction d at step t; ``mask`` is 1 for real steps."""
        n, steps = mask.shape
        s = self.state
        states = np.zeros((n, steps, 2 * s), np.float32)
        full = mask.all(0)
        self.kept = ([None] * steps, [None] * steps)
        for d, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            h = np.zeros((n, s), np.float32)
            for t in order:
                x = inputs(d, t)
                g = h @ self.u[d]
                zr = x[:, : 2 * s] + g[:, : 2 * s]
                zr *= 0.5
                np.tanh(zr, out=zr)
                zr *= 0.5
                zr += 0.5
                c = zr[:, s:] * g[:, 2 * s :]
                c += x[:, 2 * s :]
                np.tanh(c, out=c)
                new = h - c
                new *= zr[:, :s]
                new += c
                if not full[t]:
                    new *= mask[:, t : t + 1]
                if keep:
                    self.kept[d][t] = (h, g, zr, c)
                h = states[:, t, s * d : s * (d + 1)] = new
        score = np.where(mask > 0, states @ self.v, np.float32(-30))
        score -= score.max(1, keepdims=True)
        np.exp(score, out=score)
        weight = score / score.sum(1, keepdims=True)
        if keep:
            self.states, self.weight, self.mask = states, weight, mask
        return np.matmul(weight[:, None, :], states)[:, 0]

    def backward(self, pooled: np.ndarray, grads: dict[str, np.ndarray]) -> np.ndarray:
        """Gradients of the inputs (rows, steps, 6 * state) from those of the pooled state; adds those of the weights."""
        n, steps = self.mask.shape
        s = self.state
        by_weight = np.matmul(self.states, pooled[:, :, None])[:, :, 0]
        by_score = self.weight * (by_weight - (self.weight * by_weight).sum(1, keepdims=True)) * self.mask
        grads[f"{self.name}_v"] += np.einsum("nt,nts->s", by_score, self.states)
        by_state = self.weight[:, :, None] * pooled[:, None, :] + by_score[:, :, None] * self.v
        out = np.zeros((n, steps, 6 * s), np.float32)
        for d, order in enumerate((range(steps - 1, -1, -1), range(steps))):
            dh = np.zeros((n, s), np.float32)
            for t in order:
                h, g, zr, c = self.kept[d][t]
                z, r = zr[:, :s], zr[:, s:]
                dh = (dh + by_state[:, t, s * d : s * (d + 1)]) * self.mask[:, t : t + 1]
                dc = dh * (1 - z) * (1 - c * c)
                gates = np.concatenate([dh * (h - c) * z * (1 - z), dc * g[:, 2 * s :] * r * (1 - r), dc], 1)
                out[:, t, 3 * s * d : 3 * s * (d + 1)] = gates
                gates = gates.copy()
                gates[:, 2 * s :] *= r
                grads[f"{self.name}_u{'fb'[d]}"] += h.T @ gates
                dh = dh * z + gates @ self.u[d].T
        return out


def initial(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float | None = None) -> np.ndarray:
        return (rng.standard_normal(shape) * (scale or shape[0] ** -0.5)).astype(np.float32)

    token = 2 * CHAR_STATE + WORD_DIM
    weights = {
        "char": normal(256, CHAR_DIM, scale=0.5), "word": normal(WORD_BUCKETS, WORD_DIM, scale=0.1),
        "c_w": normal(CHAR_DIM, 6 * CHAR_STATE), "c_b": np.zeros(6 * CHAR_STATE, np.float32), "c_v": normal(2 * CHAR_STATE, scale=0.3),
        "w_w": normal(token, 6 * WORD_STATE), "w_b": np.zeros(6 * WORD_STATE, np.float32), "w_v": normal(2 * WORD_STATE, scale=0.3),
        "o_w": normal(2 * WORD_STATE), "o_b": np.zeros(1, np.float32),
    }
    for name, state in (("c", CHAR_STATE), ("w", WORD_STATE)):
        for d in "fb":
            weights[f"{name}_u{d}"] = normal(state, 3 * state)
    return weights


def token_inputs(weights: dict[str, np.ndarray], chars: np.ndarray, buckets: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The gate inputs of the word network for each token; a last row for no token. ``chars`` is padded with 0."""
    out = np.zeros((len(chars) + 1, 6 * WORD_STATE), np.float32)
    by_char = _halves(weights["char"] @ weights["c_w"] + weights["c_b"])
    length = (chars > 0).sum(1)
    order = np.argsort(length, kind="stable")
    for begin in range(0, len(chars), chunk):
        at = order[begin : begin + chunk]
        own = chars[at, : max(1, int(length[at[-1]]))]
        pooled = Layer(weights, "c").forward(lambda d, t: by_char[d][own[:, t]], (own > 0).astype(np.float32))
        out[at] = np.concatenate([pooled, weights["word"][buckets[at]]], 1) @ weights["w_w"] + weights["w_b"]
    return out


def window_logits(weights: dict[str, np.ndarray], inputs: np.ndarray, windows: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The logit of each window, a row of indices into ``inputs``; its last row stands for no token."""
    out, halves = np.empty(len(windows), np.float32), _halves(inputs)
    for begin in range(0, len(windows), chunk):
        own = windows[begin : begin + chunk]
        pooled = Layer(weights, "w").forward(lambda d, t: halves[d][own[:, t]], (own < len(inputs) - 1).astype(np.float32))
        out[begin : begin + chunk] = pooled @ weights["o_w"] + weights["o_b"]
    return out


def _gradients(weights, chars, buckets, windows, labels) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of some windows, and the gradients of all weights. The tokens of ``windows`` are rows of ``chars``, -1 none."""
    grads = {k: np.zeros_like(v) for k, v in weights.items()}
    used, inverse = np.unique(windows, return_inverse=True)
    inverse = inverse.reshape(windows.shape)
    none = int(used[0] < 0)
    own = chars[used[none:]]
    own = own[:, : max(1, int((own > 0).sum(1).max(initial=1)))]
    embedded = weights["char"][own]
    gates = embedded @ weights["c_w"] + weights["c_b"]
    char_layer, word_layer = Layer(weights, "c"), Layer(weights, "w")
    pooled = char_layer.forward(lambda d, t: gates[:, t, 3 * CHAR_STATE * d : 3 * CHAR_STATE * (d + 1)], (own > 0).astype(np.float32), keep=True)
    token = np.concatenate([pooled, weights["word"][buckets[used[none:]]]], 1)
    inputs = np.concatenate([np.zeros((none, 6 * WORD_STATE), np.float32), token @ weights["w_w"] + weights["w_b"]])
    mask = (windows >= 0).astype(np.float32)
    halves = _halves(inputs)
    state = word_layer.forward(lambda d, t: halves[d][inverse[:, t]], mask, keep=True)
    logit = state @ weights["o_w"] + weights["o_b"]
    p = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - labels * logit))
    d_logit = ((p - labels) / len(labels)).astype(np.float32)
    grads["o_w"] += state.T @ d_logit
    grads["o_b"] += d_logit.sum()
    d_inputs = word_layer.backward(d_logit[:, None] * weights["o_w"], grads) * mask[:, :, None]
    summed = _sums(inverse.ravel(), d_inputs.reshape(-1, inputs.shape[1]), len(inputs))[none:]
    grads["w_w"] += token.T @ summed
    grads["w_b"] += summed.sum(0)
    d_token = summed @ weights["w_w"].T
    grads["word"] += _sums(buckets[used[none:]], d_token[:, 2 * CHAR_STATE :], WORD_BUCKETS)
    d_gates = char_layer.backward(np.ascontiguousarray(d_token[:, : 2 * CHAR_STATE]), grads) * (own > 0)[:, :, None]
    flat = d_gates.reshape(-1, d_gates.shape[-1])
    grads["c_w"] += embedded.reshape(-1, CHAR_DIM).T @ flat
    grads["c_b"] += flat.sum(0)
    grads["char"] += _sums(own.ravel(), flat @ weights["c_w"].T, 256)
    return loss, grads


def _sums(keys: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each key from 0 to n - 1."""
    return np.column_stack([np.bincount(keys, column, n) for column in rows.T]).astype(rows.dtype)


def trained(chars: np.ndarray, buckets: np.ndarray, windows: np.ndarray, labels: np.ndarray, *, epochs: int = 4, batch: int = 128,
            rate: float = 0.01, seed: int = 5, start: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Weights fitted to windows (rows of token indices, -1 for none) and their labels 0 or 1, from ``start`` on if given."""
    rng = np.random.default_rng(seed)
    weights = {k: v.copy() for k, v in start.items()} if start else initial(seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step, steps = 0, epochs * -(-len(windows) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), batch):
            at = order[begin : begin + batch]
            _, grads = _gradients(weights, chars, buckets, windows[at], labels[at].astype(np.float32))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            pace = rate * min(1.0, 20 * (steps - step + 1) / (19 * steps + 1)) / max(1.0, norm / 5)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                weights[k] -= pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return weights
