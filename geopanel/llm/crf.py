"""A linear-chain conditional random field over sparse binary features, in numpy."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class ChainCRF:
    """Labels 0 .. n-1; a token is a list of feature numbers below ``size``."""

    def __init__(self, labels: int, size: int):
        self.emit = np.zeros((size, labels))
        self.move = np.zeros((labels, labels))
        self.start = np.zeros(labels)

    def _scores(self, tokens: np.ndarray) -> np.ndarray:
        """(..., labels) of padded feature numbers; number 0 is the padding and weighs nothing."""
        out = np.zeros((*tokens.shape[:-1], self.emit.shape[1]))
        for i in range(tokens.shape[-1]):
            out += self.emit[tokens[..., i]]
        return out

    def fit(self, chains: Sequence[Sequence[Sequence[int]]], labels: Sequence[Sequence[int]],
            rounds: int = 60, rate: float = 0.3, decay: float = 1e-4) -> ChainCRF:
        """Maximise the conditional likelihood by AdaGrad over all chains at once."""
        n, longest = len(chains), max(map(len, chains))
        wide = max(len(t) for c in chains for t in c)
        feats = np.zeros((n, longest, wide), np.int32)
        gold = np.zeros((n, longest), np.int64)
        length = np.array([len(c) for c in chains])
        for i, (chain, tags) in enumerate(zip(chains, labels, strict=True)):
            gold[i, :len(tags)] = tags
            for t, token in enumerate(chain):
                feats[i, t, :len(token)] = token
        live = np.arange(longest) < length[:, None]
        count = self.emit.shape[1]
        seen = [np.full_like(w, 1e-6) for w in (self.emit, self.move, self.start)]
        hot = np.zeros((n, longest, count))
        np.put_along_axis(hot, gold[..., None], 1.0, 2)
        hot *= live[..., None]
        for _ in range(rounds):
            score = self._scores(feats)
            ahead = np.zeros((n, longest, count))
            ahead[:, 0] = score[:, 0] + self.start
            for t in range(1, longest):
                step = _logsum(ahead[:, t - 1, :, None] + self.move, 1) + score[:, t]
                ahead[:, t] = np.where(live[:, t, None], step, ahead[:, t - 1])
            total = _logsum(ahead[:, -1], 1)
            back = np.zeros((n, longest, count))
            pairs = np.zeros((count, count))
            for t in range(longest - 2, -1, -1):
                on = live[:, t + 1]
                after = score[:, t + 1] + back[:, t + 1]
                back[:, t] = np.where(on[:, None], _logsum(
                    self.move + after[:, None, :], 2), 0.0)
                joint = np.exp(ahead[:, t, :, None] + self.move + after[:, None, :]
                               - total[:, None, None])
                pairs += joint[on].sum(0)
            # Ends: alpha carries the last live value on, so beta is zero behind it.
            share = np.exp(ahead + back - total[:, None, None]) * live[..., None]
            gap = hot - share
            grads = [np.zeros_like(self.emit), np.zeros_like(self.move), gap[:, 0].sum(0)]
            for y in range(count):
                for i in range(wide):
                    grads[0][:, y] += np.bincount(
                        feats[..., i].ravel(), gap[..., y].ravel(), self.emit.shape[0])
            grads[0][0] = 0
            np.add.at(grads[1], (gold[:, :-1][live[:, 1:]], gold[:, 1:][live[:, 1:]]), 1.0)
            grads[1] -= pairs
            for weight, grad, past in zip((self.emit, self.move, self.start), grads, seen,
                                          strict=True):
                grad = grad - decay * n * weight
                past += grad * grad
                weight += rate * grad / np.sqrt(past)
        return self

    def decode(self, chain: Sequence[Sequence[int]]) -> list[int]:
        """The most likely labels of a chain (Viterbi)."""
        return self.best(np.array([self.emit[list(t)].sum(0) for t in chain]))

    def best(self, score: np.ndarray, before: int | None = None,
             after: int | None = None) -> list[int]:
        """The most likely labels of tokens with these scores, between given labels if any."""
        best, back = score[0] + (self.start if before is None else self.move[before]), []
        for row in score[1:]:
            ways = best[:, None] + self.move
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        label = int((best if after is None else best + self.move[:, after]).argmax())
        out = [label]
        for pointer in reversed(back):
            label = int(pointer[label])
            out.append(label)
        return out[::-1]

    def lead(self, label: int) -> np.ndarray:
        """By how much ``label`` must lead each other one to be the best whatever is beside it."""
        into = np.vstack([self.move, self.start])
        out_of = np.hstack([self.move, np.zeros((self.start.size, 1))])
        return ((into - into[:, [label]]).max(0) + (out_of - out_of[label]).max(1))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))
