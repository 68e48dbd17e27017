"""A small convolutional network over characters, in numpy.

Characters are embedded, convolved (width 5), rectified, pooled by maximum
and mean, and weighted into one logit. Trained with Adam on minibatches.
"""

from __future__ import annotations

import numpy as np

EMBED, WIDTH, FILTERS, ALPHABET = 8, 5, 24, 128


def encode(strings: list[bytes], length: int) -> np.ndarray:
    """ASCII strings of ``length`` bytes as codes."""
    return np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), length).astype(np.int64) & 127


class CharCNN:
    """``marks``: a fixed extra input per position."""

    def __init__(self, marks: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.marks = marks.astype(np.float32)
        self.p = {
            "embed": rng.normal(0, 0.5, (ALPHABET, EMBED)),
            "conv": rng.normal(0, (2 / (WIDTH * (EMBED + 1))) ** 0.5, (WIDTH * (EMBED + 1), FILTERS)),
            "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.2, 2 * FILTERS), "out_bias": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.slope, self.shift = 1.0, 0.0  # of the calibration

    def state(self) -> dict:
        return {"marks": self.marks, "p": self.p, "slope": self.slope, "shift": self.shift}

    @classmethod
    def from_state(cls, state: dict) -> "CharCNN":
        out = cls(state["marks"])
        out.p, out.slope, out.shift = state["p"], state["slope"], state["shift"]
        return out

    def _forward(self, codes: np.ndarray) -> tuple:
        n, length = codes.shape
        x = np.empty((n, length, EMBED + 1), np.float32)
        x[:, :, :EMBED] = self.p["embed"][codes]
        x[:, :, EMBED] = self.marks
        steps = length - WIDTH + 1
        views = np.concatenate([x[:, k:k + steps] for k in range(WIDTH)], axis=2)
        h = np.maximum(views.reshape(n * steps, -1) @ self.p["conv"] + self.p["bias"], 0).reshape(n, steps, FILTERS)
        top = h.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h, top[:, None, :], 1)[:, 0], h.mean(axis=1)], axis=1)
        return views, h, top, pooled, pooled @ self.p["out"] + self.p["out_bias"][0]

    def logits(self, codes: np.ndarray, batch: int = 512) -> np.ndarray:
        return np.concatenate([self._forward(codes[i:i + batch])[-1] for i in range(0, len(codes), batch)]
                              or [np.zeros(0, np.float32)])

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.logits(codes).astype(np.float64) + self.shift)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        views, h, top, pooled, logit = self._forward(codes)
        n, steps, _ = h.shape
        d = ((sigmoid(logit) - labels) / n).astype(np.float32)
        d_pooled = d[:, None] * self.p["out"][None, :]
        d_h = np.repeat(d_pooled[:, None, FILTERS:] / steps, steps, axis=1)
        at = np.arange(n)[:, None], top, np.arange(FILTERS)[None, :]
        d_h[at] += d_pooled[:, :FILTERS]
        d_h[h <= 0] = 0
        flat = d_h.reshape(n * steps, FILTERS)
        d_views = (flat @ self.p["conv"].T).reshape(n, steps, WIDTH, EMBED + 1)
        d_x = np.zeros((n, codes.shape[1], EMBED), np.float32)
        for k in range(WIDTH):
            d_x[:, k:k + steps] += d_views[:, :, k, :EMBED]
        d_embed = np.zeros_like(self.p["embed"])
        np.add.at(d_embed, codes.ravel(), d_x.reshape(-1, EMBED))
        return {"embed": d_embed, "conv": views.reshape(n * steps, -1).T @ flat, "bias": flat.sum(axis=0),
                "out": pooled.T @ d, "out_bias": d.sum(keepdims=True)}

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01,
            seed: int = 7) -> "CharCNN":
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for i in range(0, len(order), batch):
                t += 1
                for k, g in self._gradients(codes[order[i:i + batch]], labels[order[i:i + batch]]).items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    self.p[k] -= (rate * (first[k] / (1 - 0.9 ** t))
                                  / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
        return self

    def calibrate(self, codes: np.ndarray, labels: np.ndarray, rounds: int = 200) -> "CharCNN":
        """Platt scaling on rows not trained on, by damped Newton steps."""
        z = self.logits(codes).astype(np.float64)
        hits, misses = labels.sum(), len(labels) - labels.sum()
        goal = np.where(labels > 0, (hits + 1) / (hits + 2), 1 / (misses + 2))
        a, b = 1.0, 0.0
        for _ in range(rounds):
            p = sigmoid(a * z + b)
            w = np.maximum(p * (1 - p), 1e-9)
            g = np.array([((p - goal) * z).sum(), (p - goal).sum()])
            hess = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]]) + 1e-3 * np.eye(2)
            step = np.clip(np.linalg.solve(hess, g), -0.5, 0.5)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = max(a, 1e-3), b
        return self


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def recall_threshold(probabilities: np.ndarray, recall: float) -> float:
    """The highest threshold that at least ``recall`` of the positives' probabilities reach."""
    ranked = np.sort(probabilities)[::-1]
    return float(ranked[max(0, int(np.ceil(recall * len(ranked))) - 1)])
