"""A small network with one hidden layer, trained on the driver on bounded samples."""

from __future__ import annotations


class Net:
    """Rows of measures to a probability; f(x) > 0 means positive."""

    def __init__(self, rows, hidden: int, seed: int):
        import numpy as np

        rng = np.random.default_rng(seed)
        d = rows.shape[1]
        self.mean, self.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
        self.weights = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0]

    def scaled(self, rows):
        import numpy as np

        return np.clip((np.asarray(rows, float).reshape(-1, len(self.mean)) - self.mean) / self.scale, -6, 6)

    def forward(self, x):
        import numpy as np

        w1, b1, w2, b2 = self.weights
        h = np.tanh(x @ w1 + b1)
        return h, h @ w2 + b2

    def score(self, rows):
        return sigmoid(self.forward(self.scaled(rows))[1])

    def descend(self, draw, steps: int, rate: float, ridge: float = 1e-4) -> None:
        """Adam. ``draw`` gives scaled rows and a function from their f to the slope of the loss in it."""
        import numpy as np

        first, second = ([np.zeros_like(np.asarray(w, float)) for w in self.weights] for _ in range(2))
        for step in range(1, steps + 1):
            x, slope = draw()
            h, f = self.forward(x)
            g = slope(f)
            t = (g[:, None] * self.weights[2]) * (1 - h**2)
            grads = [x.T @ t + ridge * self.weights[0], t.sum(axis=0), h.T @ g + ridge * self.weights[2], g.sum()]
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                self.weights[k] = self.weights[k] - pace * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)


def sigmoid(f):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def sample_of(rng, x, most: int):
    """The rows, or as many drawn with replacement as a step may have."""
    return x if len(x) <= most else x[rng.integers(0, len(x), most)]


def fit_labelled(rows, y, hidden: int = 12, steps: int = 1500, rate: float = 0.01, seed: int = 3, batch: int = 2048) -> Net:
    """Logistic loss on labels of 0 and 1."""
    import numpy as np

    net, rng = Net(rows, hidden, seed), np.random.default_rng(seed)
    x = np.column_stack([net.scaled(rows), y])

    def draw():
        some = sample_of(rng, x, batch)
        return some[:, :-1], lambda f: (sigmoid(f) - some[:, -1]) / len(some)

    net.descend(draw, steps, rate)
    return net


def fit_pu(positive, unlabelled, prior: float, hidden: int = 12, steps: int = 1500, rate: float = 0.01, seed: int = 3, batch: int = 2048) -> Net:
    """Minimise the non-negative risk: prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).

    The loss is logistic, so the sigmoid of f estimates the probability. Where the
    part under the maximum falls below zero, the step goes against it, as the
    method asks, instead of fitting positives inside the unlabelled as negatives.
    """
    import numpy as np

    net, rng = Net(np.concatenate([positive, unlabelled]), hidden, seed), np.random.default_rng(seed)
    p, u = net.scaled(positive), net.scaled(unlabelled)

    def draw():
        a, b = sample_of(rng, p, batch), sample_of(rng, u, batch)

        def slope(f):
            fa, fb = f[: len(a)], f[len(a) :]
            rest = np.logaddexp(0, fb).mean() - prior * np.logaddexp(0, fa).mean()
            plus, minus, own = prior * (sigmoid(fa) - 1) / len(a), prior * sigmoid(fa) / len(a), sigmoid(fb) / len(b)
            return np.concatenate([plus - minus, own] if rest >= 0 else [minus, -own])

        return np.concatenate([a, b]), slope

    net.descend(draw, steps, rate)
    return net
