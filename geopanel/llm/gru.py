"""A bidirectional gated recurrent network over bytes, trained by backpropagation through time.

Arrays are (units, windows), one step at a time, so that all work is on whole rows of
windows. Gates use the hard sigmoid; its slope and offset are part of the weights.
"""

from __future__ import annotations

import numpy as np

UNITS = 8
WINDOW = 64
#: Windows that are run side by side.
SIDE = 8192

#: Bytes that count as letters: A-Z, a-z and all that are part of other characters.
LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = LETTER[ord("A"):ord("Z") + 1] = LETTER[0x80:] = True


class Direction:
    """One gated layer; reset gates act on the recurrent part of the candidate."""

    def __init__(self, draw: np.random.Generator, units: int):
        self.units = units
        take = draw.normal(0, 0.3, (3 * units, 256))
        back = draw.normal(0, units ** -0.5, (3 * units, units))
        take[:2 * units] = 0.2 * take[:2 * units] + 0.5
        back[:2 * units] *= 0.2
        self.take, self.back = take.astype(np.float32), back.astype(np.float32)
        self.bias = np.zeros((units, 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.take, self.back, self.bias]

    def step(self, codes: np.ndarray, state: np.ndarray):
        """(state, update gate, reset gate, recurrent part, candidate) after one byte."""
        k = self.units
        given = np.take(self.take, codes, axis=1)
        own = self.back @ state
        gates = given[:2 * k]
        gates += own[:2 * k]
        np.clip(gates, 0, 1, out=gates)
        own = own[2 * k:]
        own += self.bias
        fresh = gates[k:] * own
        fresh += given[2 * k:]
        np.tanh(fresh, out=fresh)
        new = state - fresh
        new *= gates[:k]
        new += fresh
        return new, gates[:k], gates[k:], own, fresh

    def backward(self, codes, states, saved, grads_out):
        """Gradients of the parameters; ``grads_out`` is that of every state, in step order."""
        k = self.units
        d_take = np.zeros(self.take.shape)
        d_back, d_bias = np.zeros_like(self.back), np.zeros_like(self.bias)
        down = np.zeros_like(states[0])
        for t in range(len(codes) - 1, -1, -1):
            before, (_, update, reset, own, fresh) = states[t], saved[t]
            d = down + grads_out[t]
            d_fresh = d * (1 - update) * (1 - fresh * fresh)
            d_update = d * (before - fresh) * ((update > 0) & (update < 1))
            d_reset = d_fresh * own * ((reset > 0) & (reset < 1))
            d_own = d_fresh * reset
            d_rec = np.concatenate([d_update, d_reset, d_own])
            d_in = np.concatenate([d_update, d_reset, d_fresh])
            for i in range(3 * k):
                d_take[i] += np.bincount(codes[t], d_in[i], 256)
            d_back += d_rec @ before.T
            d_bias += d_own.sum(1, keepdims=True)
            down = d * update + self.back.T @ d_rec
        return [d_take.astype(np.float32), d_back, d_bias]


class ByteTagger:
    """Label probabilities of every byte from the states of both directions."""

    def __init__(self, labels: int, units: int = UNITS, seed: int = 42):
        draw = np.random.default_rng(seed)
        self.units = units
        self.ahead, self.behind = Direction(draw, units), Direction(draw, units)
        self.out = draw.normal(0, 0.3, (labels, 2 * units)).astype(np.float32)
        self.base = np.zeros((labels, 1), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.ahead.parameters(), *self.behind.parameters(), self.out, self.base]

    def pooled(self, codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """(labels, windows): probabilities summed over the letters of each window.

        ``codes`` and ``letters`` are (steps, windows).
        """
        k, (steps, n) = self.units, codes.shape
        state = np.zeros((k, n), np.float32)
        logits = []
        for t in range(steps):
            state = self.ahead.step(codes[t], state)[0]
            logits.append(self.out[:, :k] @ state)
        state = np.zeros((k, n), np.float32)
        total = np.zeros((self.out.shape[0], n), np.float32)
        for t in range(steps - 1, -1, -1):
            state = self.behind.step(codes[t], state)[0]
            logit = logits.pop()
            logit += self.out[:, k:] @ state
            logit += self.base
            logit -= logit.max(0)
            np.exp(logit, out=logit)
            logit *= letters[t] / logit.sum(0)
            total += logit
        return total

    def gradients(self, codes: np.ndarray, letters: np.ndarray, label: np.ndarray):
        """(loss per letter, gradients) of one batch of windows."""
        k, (steps, n) = self.units, codes.shape
        passes = []
        for layer, order in ((self.ahead, range(steps)), (self.behind, range(steps - 1, -1, -1))):
            states, saved = [np.zeros((k, n), np.float32)], []
            for t in order:
                saved.append(layer.step(codes[t], states[-1]))
                states.append(saved[-1][0])
            passes.append((layer, list(order), states, saved))
        ahead = np.stack(passes[0][2][1:])
        behind = np.stack(passes[1][2][1:][::-1])
        both = np.concatenate([ahead, behind], 1)
        logit = np.einsum("lk,tkn->tln", self.out, both, optimize=True) + self.base
        logit -= logit.max(1, keepdims=True)
        prob = np.exp(logit)
        prob /= prob.sum(1, keepdims=True)
        weight = letters / max(1.0, letters.sum())
        at = np.take_along_axis(prob, np.broadcast_to(label, (steps, 1, n)).astype(np.int64), 1)
        loss = float(-(np.log(at[:, 0] + 1e-12) * weight).sum())
        np.put_along_axis(prob, np.broadcast_to(label, (steps, 1, n)).astype(np.int64), at - 1, 1)
        d_logit = (prob * weight[:, None]).astype(np.float32)
        d_out = np.einsum("tln,tkn->lk", d_logit, both, optimize=True)
        d_base = d_logit.sum((0, 2))[:, None]
        d_both = np.einsum("lk,tln->tkn", self.out, d_logit, optimize=True)
        grads = []
        for (layer, order, states, saved), part in zip(
                passes, (d_both[:, :k], d_both[:, k:]), strict=True):
            grads += layer.backward(codes[order], states, saved, part[order])
        return loss, [*grads, d_out, d_base]

    def fit(self, windows: np.ndarray, label: np.ndarray, passes: int = 8, batch: int = 256,
            rate: float = 0.01, seed: int = 42) -> ByteTagger:
        """Adam on the cross entropy of every letter; ``windows`` is (windows, steps) of bytes."""
        draw = np.random.default_rng(seed)
        slow = [np.zeros_like(p) for p in self.parameters()]
        square = [np.zeros_like(p) for p in self.parameters()]
        at, steps = 0, passes * -(-len(windows) // batch)
        for _ in range(passes):
            order = draw.permutation(len(windows))
            for begin in range(0, len(order), batch):
                some = order[begin:begin + batch]
                codes = np.ascontiguousarray(windows[some].T)
                _, grads = self.gradients(codes, LETTER[codes].astype(np.float32), label[some])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
                at += 1
                pace = rate * (1 - at / (steps + 1))
                for p, g, m, v in zip(self.parameters(), grads, slow, square, strict=True):
                    g = g / max(1.0, norm)
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= pace * (m / (1 - 0.9 ** at)) / (np.sqrt(v / (1 - 0.99 ** at)) + 1e-8)
        return self


def windows_of(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, steps) of all bytes, and how many windows each text has; ends are zeros."""
    count = np.array([-(-len(b) // WINDOW) for b in bodies], np.int64)
    data = b"".join([b.ljust(n * WINDOW, b"\0")
                     for b, n in zip(bodies, count.tolist(), strict=True)])
    return np.frombuffer(data, np.uint8).reshape(-1, WINDOW), count
