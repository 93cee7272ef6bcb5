"""Gradient optimizers (T5a-T5f, T6).

Each rule exists twice: a numpy step on the flat parameter vector (the
training loop, model-sized on the driver) and a column projection over a
parameter table ``(w, g, state...)`` (the same update as a Spark job over a
parameter table of any size, checkable with SQL).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Optimizer names.
OPTIMIZERS = ("SGD", "Adagrad", "RMSProp", "Adadelta", "Adam")


def _pos(v: float, default: float) -> float:
    return v if v is not None and not (isinstance(v, float) and math.isnan(v)) and v > 0 else default


@dataclass
class Optimizer:
    name: str
    learning_rate: float
    momentum: float = 0.0
    nesterov: bool = False
    beta_1: float = 0.9
    beta_2: float = 0.999
    rho: float = 0.9
    epsilon: float = 1e-7
    initial_accumulator: float = 0.0
    state: dict = field(default_factory=dict)

    # ------------------------------------------------------------ numpy
    def init_state(self, n: int) -> None:
        """Velocity / moments zero, accumulator at its initial value."""
        self.state = {"v": np.zeros(n), "acc": np.full(n, float(self.initial_accumulator)),
                      "d": np.zeros(n), "t": 0}

    def lookahead(self, w: np.ndarray) -> np.ndarray | None:
        """Nesterov look-ahead weights used to pass deltas backwards."""
        if self.name == "SGD" and self.nesterov and self.momentum:
            return w - self.momentum * self.state["v"]
        return None

    def step(self, w: np.ndarray, g: np.ndarray) -> np.ndarray:
        s, lr, eps = self.state, self.learning_rate, self.epsilon
        if self.name == "SGD":
            s["v"] = self.momentum * s["v"] + lr * g
            return w - s["v"]
        if self.name == "Adagrad":
            s["acc"] = s["acc"] + g * g
            return w - lr * g / np.sqrt(s["acc"] + eps)
        if self.name == "RMSProp":
            s["acc"] = self.rho * s["acc"] + (1 - self.rho) * g * g
            s["v"] = self.momentum * s["v"] + lr * g / np.sqrt(s["acc"] + eps)
            return w - s["v"]
        if self.name == "Adadelta":
            s["acc"] = self.rho * s["acc"] + (1 - self.rho) * g * g
            u = lr * g * np.sqrt((s["d"] + eps) / (s["acc"] + eps))
            s["d"] = self.rho * s["d"] + (1 - self.rho) * u * u
            return w - u
        # Adam, bias correction per step
        s["t"] += 1
        s["v"] = self.beta_1 * s["v"] + (1 - self.beta_1) * g
        s["acc"] = self.beta_2 * s["acc"] + (1 - self.beta_2) * g * g
        mhat = s["v"] / (1 - self.beta_1 ** s["t"])
        vhat = s["acc"] / (1 - self.beta_2 ** s["t"])
        return w - lr * mhat / (np.sqrt(vhat) + eps)

    # ---------------------------------------------------------- columns
    def update_columns(self, w: Column, g: Column, v: Column, acc: Column, d: Column,
                       t: int = 1) -> dict[str, Column]:
        """New ``w`` and state columns for one step (``t`` = step number)."""
        lr, eps = F.lit(self.learning_rate), F.lit(self.epsilon)
        one = F.lit(1.0)
        if self.name == "SGD":
            v2 = F.lit(self.momentum) * v + lr * g
            return {"w": w - v2, "v": v2, "acc": acc, "d": d}
        if self.name == "Adagrad":
            a2 = acc + g * g
            return {"w": w - lr * g / F.sqrt(a2 + eps), "v": v, "acc": a2, "d": d}
        rho = F.lit(self.rho)
        if self.name == "RMSProp":
            a2 = rho * acc + (one - rho) * g * g
            v2 = F.lit(self.momentum) * v + lr * g / F.sqrt(a2 + eps)
            return {"w": w - v2, "v": v2, "acc": a2, "d": d}
        if self.name == "Adadelta":
            a2 = rho * acc + (one - rho) * g * g
            u = lr * g * F.sqrt((d + eps) / (a2 + eps))
            return {"w": w - u, "v": v, "acc": a2, "d": rho * d + (one - rho) * u * u}
        b1, b2 = F.lit(self.beta_1), F.lit(self.beta_2)
        v2 = b1 * v + (one - b1) * g
        a2 = b2 * acc + (one - b2) * g * g
        mhat = v2 / F.lit(1 - self.beta_1 ** t)
        vhat = a2 / F.lit(1 - self.beta_2 ** t)
        return {"w": w - lr * mhat / (F.sqrt(vhat) + eps), "v": v2, "acc": a2, "d": d}


def new_optimizer(name: str, learning_rate: float = 0, momentum: float = 0, nesterov: bool = False,
                  beta_1: float = 0, beta_2: float = 0, rho: float = 0, epsilon: float = 0,
                  initial_accumulator: float = 0) -> Optimizer:
    """Factory with the defaults used when a value is <= 0 or NaN."""
    if name not in OPTIMIZERS:
        raise ValueError(f"unknown optimizer {name!r}")
    eps = _pos(epsilon, 1e-7)
    if name == "SGD":
        return Optimizer(name, _pos(learning_rate, 0.01), _pos(momentum, 0.0), bool(nesterov), epsilon=eps)
    lr = _pos(learning_rate, 0.001)
    if name == "Adagrad":
        return Optimizer(name, lr, epsilon=eps, initial_accumulator=_pos(initial_accumulator, 0.1))
    if name == "RMSProp":
        return Optimizer(name, lr, momentum=_pos(momentum, 0.0), rho=_pos(rho, 0.9), epsilon=eps)
    if name == "Adadelta":
        return Optimizer(name, lr, rho=_pos(rho, 0.95), epsilon=eps)
    return Optimizer(name, lr, beta_1=_pos(beta_1, 0.9), beta_2=_pos(beta_2, 0.999), epsilon=eps)
