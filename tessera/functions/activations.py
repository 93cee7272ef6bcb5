"""Activation functions and their derivatives as JVM column expressions
(F1-F8).

Scalar forms work on DOUBLE columns; array forms on ARRAY<DOUBLE> with
``transform``/``aggregate`` so a whole row vector is handled inside one
codegen'd projection (no explode, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted activation names.
ACTIVATIONS = ("linear", "none", "relu", "sigmoid", "tanh", "softmax", "softplus")


def check_activation(name: str) -> str:
    if name not in ACTIVATIONS:
        raise ValueError(f"unknown activation {name!r}")
    return "linear" if name == "none" else name


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def softplus(z: Column) -> Column:
    """log(1 + e^z) without overflow for large z."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def activate(z: Column, name: str) -> Column:
    """Element-wise activation of a scalar column (softmax needs a vector)."""
    name = check_activation(name)
    if name == "linear":
        return z
    if name == "relu":
        return F.when(z > 0, z).otherwise(F.lit(0.0))
    if name == "sigmoid":
        return sigmoid(z)
    if name == "tanh":
        return F.tanh(z)
    if name == "softplus":
        return softplus(z)
    raise ValueError("softmax is a vector function: use activate_array")


def derivative(a: Column, z: Column, name: str) -> Column:
    """f'(z) given the activation a = f(z) and z (element-wise functions)."""
    name = check_activation(name)
    if name == "linear":
        return F.lit(1.0)
    if name == "relu":
        return F.when(z > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    if name == "sigmoid":
        return a * (F.lit(1.0) - a)
    if name == "tanh":
        return F.lit(1.0) - a * a
    if name == "softplus":
        return sigmoid(z)
    raise ValueError("softmax has no element-wise derivative: use softmax_jvp")


def _per_element(x: Column, value: Column) -> Column:
    """``value`` repeated once per element of ``x``. Row-level reductions are
    passed into ``zip_with`` this way instead of being referenced inside a
    lambda, where they would be re-evaluated for every element."""
    return F.array_repeat(value, F.size(x))


def softmax_array(x: Column) -> Column:
    """Max-shifted softmax of one vector (linear in the vector length)."""
    e = F.zip_with(x, _per_element(x, F.array_max(x)), lambda v, m: F.exp(v - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.zip_with(e, _per_element(x, s), lambda v, t: v / t)


def activate_array(x: Column, name: str) -> Column:
    name = check_activation(name)
    if name == "softmax":
        return softmax_array(x)
    if name == "linear":
        return x
    return F.transform(x, lambda v: activate(v, name))


def derivative_array(a: Column, z: Column, name: str) -> Column:
    name = check_activation(name)
    return F.zip_with(a, z, lambda av, zv: derivative(av, zv, name))


def softmax_jvp(a: Column, g: Column) -> Column:
    """Jacobian-vector product of softmax: a * (g - sum(a * g))."""
    dot = F.aggregate(F.zip_with(a, g, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)
    ag = F.arrays_zip(a.alias("a"), g.alias("g"))
    return F.zip_with(ag, _per_element(a, dot), lambda p, d: p["a"] * (p["g"] - d))


def segmented(x: Column, segments: int, width: int, fn) -> Column:
    """Apply a vector function to consecutive ``width``-long slices of a flat
    array (e.g. every matrix row of every channel of a channel-row-col
    tensor) and concatenate the results."""
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(segments - 1)),
                                 lambda r: fn(F.slice(x, r * width + 1, width))))


def softmax_tensor_rows(x: Column, channels: int, rows: int, cols: int) -> Column:
    """Softmax over every matrix row inside every channel."""
    return segmented(x, channels * rows, cols, softmax_array)
