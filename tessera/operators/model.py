"""Sequential models: layer specs, shape propagation, parameters and the
numpy row kernels used inside Spark tasks (N1-N7, T1-T4).

The kernels work on one Arrow batch of rows at a time (``x`` of shape
``(n, features)``); Spark decides how rows are partitioned and the driver only
ever holds model-sized arrays (parameters, gradients, optimizer state).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

from tessera.functions.activations import check_activation


# ----------------------------------------------------------------- specs
@dataclass
class Dense:
    units: int
    activation: str = "linear"
    dropout: list[float] = field(default_factory=list)
    kind: str = "dense"


@dataclass
class Conv2D:
    filters: int
    kernel: tuple[int, int]
    stride: tuple[int, int] = (1, 1)
    padding: tuple[int, int] = (0, 0)
    activation: str = "linear"
    dropout: list[float] = field(default_factory=list)
    kind: str = "conv"


@dataclass
class MaxPool2D:
    pool: tuple[int, int]
    stride: tuple[int, int] = (1, 1)
    padding: tuple[int, int] = (0, 0)
    dropout: list[float] = field(default_factory=list)
    kind: str = "maxpool"


@dataclass
class AvgPool2D:
    pool: tuple[int, int]
    stride: tuple[int, int] = (1, 1)
    padding: tuple[int, int] = (0, 0)
    dropout: list[float] = field(default_factory=list)
    kind: str = "avgpool"


@dataclass
class Flatten:
    dropout: list[float] = field(default_factory=list)
    kind: str = "flatten"


LAYER_TYPES = {"dense": Dense, "conv": Conv2D, "maxpool": MaxPool2D, "avgpool": AvgPool2D,
               "flatten": Flatten}


def out_size(n: int, k: int, p: int, s: int) -> int:
    return (n - k + 2 * p) // s + 1


def md5_uniform(seed: int, tag: str, n: int) -> np.ndarray:
    """Reproducible uniform(-0.1, 0.1) values (same rule as the SQL/Spark
    parameter initialiser); seed 0 gives zeros."""
    if seed == 0:
        return np.zeros(n)
    out = np.empty(n)
    for i in range(n):
        h = hashlib.md5(f"{seed}:{tag}:{i}".encode()).hexdigest()
        out[i] = int(h[:8], 16) / 4294967296.0 * 0.2 - 0.1
    return out


class Sequential:
    """Ordered layers with shapes fixed at build time.

    ``input_shape`` is ``(features,)`` for a dense-first model or
    ``(channels, rows, cols)`` for a conv/pool-first model.
    """

    def __init__(self, input_shape: tuple[int, ...], layers: list, seed: int = 1,
                 params: list[dict[str, np.ndarray]] | None = None):
        self.input_shape = tuple(input_shape)
        self.layers = list(layers)
        self.shapes: list[tuple[int, ...]] = []
        shape = self.input_shape
        for i, layer in enumerate(self.layers):
            for r in layer.dropout:
                if not 0 <= r < 1:
                    raise ValueError(f"dropout ratio {r} of layer {i} must be in [0, 1)")
            if isinstance(layer, Dense):
                if len(shape) != 1:
                    raise ValueError(f"layer {i}: dense layer needs a flat input, got {shape}")
                check_activation(layer.activation)
                shape = (layer.units,)
            elif isinstance(layer, (Conv2D, MaxPool2D, AvgPool2D)):
                if len(shape) != 3:
                    raise ValueError(f"layer {i}: {layer.kind} needs a (channels, rows, cols) input, got {shape}")
                c, h, w = shape
                k = layer.kernel if isinstance(layer, Conv2D) else layer.pool
                oh = out_size(h, k[0], layer.padding[0], layer.stride[0])
                ow = out_size(w, k[1], layer.padding[1], layer.stride[1])
                if oh <= 0 or ow <= 0:
                    raise ValueError(f"layer {i}: window larger than its input")
                if isinstance(layer, Conv2D):
                    check_activation(layer.activation)
                    c = layer.filters
                shape = (c, oh, ow)
            elif isinstance(layer, Flatten):
                shape = (int(np.prod(shape)),)
            else:
                raise ValueError(f"unknown layer {layer!r}")
            self.shapes.append(shape)
        self.in_shapes = [self.input_shape] + self.shapes[:-1]
        self.params = params if params is not None else self._init(seed)

    @property
    def output_shape(self) -> tuple[int, ...]:
        return self.shapes[-1]

    def _init(self, seed: int) -> list[dict[str, np.ndarray]]:
        out = []
        for i, layer in enumerate(self.layers):
            if isinstance(layer, Dense):
                fan_in = self.in_shapes[i][0]
                w = md5_uniform(seed, f"{i}:w", fan_in * layer.units).reshape(fan_in, layer.units)
                b = md5_uniform(seed, f"{i}:b", layer.units)
                out.append({"w": w, "b": b})
            elif isinstance(layer, Conv2D):
                cin = self.in_shapes[i][0]
                kh, kw = layer.kernel
                w = md5_uniform(seed, f"{i}:w", layer.filters * cin * kh * kw) \
                    .reshape(layer.filters, cin, kh, kw)
                b = md5_uniform(seed, f"{i}:b", layer.filters)
                out.append({"w": w, "b": b})
            else:
                out.append({})
        return out

    # flat parameter vector (layer order, w then b)
    def flat(self) -> np.ndarray:
        parts = [p[k].ravel() for p in self.params for k in ("w", "b") if k in p]
        return np.concatenate(parts) if parts else np.zeros(0)

    def unflat(self, v: np.ndarray) -> list[dict[str, np.ndarray]]:
        out, pos = [], 0
        for p in self.params:
            q = {}
            for k in ("w", "b"):
                if k in p:
                    n = p[k].size
                    q[k] = v[pos:pos + n].reshape(p[k].shape)
                    pos += n
            out.append(q)
        return out

    def param_rows(self):
        """(layer, param, idx, v) rows of all parameters."""
        for li, p in enumerate(self.params):
            for k in ("w", "b"):
                if k in p:
                    for idx, v in enumerate(p[k].ravel()):
                        yield (li, k, idx, float(v))


# ----------------------------------------------------------- activations
def act_np(z: np.ndarray, name: str) -> np.ndarray:
    name = check_activation(name)
    if name == "linear":
        return z
    if name == "relu":
        return np.where(z > 0, z, 0.0)
    if name == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if name == "tanh":
        return np.tanh(z)
    if name == "softplus":
        return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))
    # softmax along the last axis (dense: per row; conv: per matrix row per channel)
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def act_backward(a: np.ndarray, z: np.ndarray, name: str, g: np.ndarray) -> np.ndarray:
    """dL/dz from dL/da (element-wise derivative, softmax by its JVP)."""
    name = check_activation(name)
    if name == "linear":
        return g
    if name == "relu":
        return g * (z > 0)
    if name == "sigmoid":
        return g * a * (1 - a)
    if name == "tanh":
        return g * (1 - a * a)
    if name == "softplus":
        return g / (1.0 + np.exp(-z))
    return a * (g - (a * g).sum(axis=-1, keepdims=True))


# ------------------------------------------------------------ windowed ops
def _windows(x: np.ndarray, k, s, p, fill: float):
    """(n, C, Ho, Wo, kh, kw) view of zero/``fill``-padded input windows."""
    xp = np.pad(x, ((0, 0), (0, 0), (p[0], p[0]), (p[1], p[1])), constant_values=fill)
    ho = out_size(x.shape[2], k[0], p[0], s[0])
    wo = out_size(x.shape[3], k[1], p[1], s[1])
    win = sliding_window_view(xp, (k[0], k[1]), axis=(2, 3))
    return win[:, :, ::s[0], ::s[1]][:, :, :ho, :wo], xp.shape


def conv_forward(x, w, b, s, p):
    """Cross-correlation summed over input channels, plus bias."""
    win, _ = _windows(x, w.shape[2:], s, p, 0.0)
    return np.einsum("nchwij,ocij->nohw", win, w, optimize=True) + b[None, :, None, None]


def conv_backward(x, w, dz, s, p, deltas: bool = True):
    """(dW, db, dx) for a conv layer given dL/dz (sums over the batch); only dx
    depends on ``w``, and it is None without ``deltas``."""
    win, pshape = _windows(x, w.shape[2:], s, p, 0.0)
    dw = np.einsum("nohw,nchwij->ocij", dz, win, optimize=True)
    db = dz.sum(axis=(0, 2, 3))
    if not deltas:
        return dw, db, None
    dxp = np.zeros((x.shape[0], x.shape[1], pshape[2], pshape[3]))
    ho, wo = dz.shape[2], dz.shape[3]
    for i in range(w.shape[2]):
        for j in range(w.shape[3]):
            dxp[:, :, i:i + s[0] * ho:s[0], j:j + s[1] * wo:s[1]] += \
                np.einsum("nohw,oc->nchw", dz, w[:, :, i, j], optimize=True)
    dx = dxp[:, :, p[0]:p[0] + x.shape[2], p[1]:p[1] + x.shape[3]]
    return dw, db, dx


def maxpool_forward(x, k, s, p):
    """Window max ignoring padding; also returns the first arg-max offset."""
    win, _ = _windows(x, k, s, p, -np.inf)
    flat = win.reshape(win.shape[:4] + (k[0] * k[1],))
    arg = flat.argmax(axis=-1)
    return np.take_along_axis(flat, arg[..., None], axis=-1)[..., 0], arg


def maxpool_backward(x, k, s, p, arg, dy):
    n, c, h, w = x.shape
    dxp = np.zeros((n, c, h + 2 * p[0], w + 2 * p[1]))
    ho, wo = dy.shape[2], dy.shape[3]
    ii, jj = np.divmod(arg, k[1])
    rows = ii + (np.arange(ho) * s[0])[None, None, :, None]
    cols = jj + (np.arange(wo) * s[1])[None, None, None, :]
    nn = np.arange(n)[:, None, None, None]
    cc = np.arange(c)[None, :, None, None]
    np.add.at(dxp, (np.broadcast_to(nn, dy.shape), np.broadcast_to(cc, dy.shape), rows, cols), dy)
    return dxp[:, :, p[0]:p[0] + h, p[1]:p[1] + w]


def avgpool_forward(x, k, s, p):
    """Window sum / (kh*kw): padding counts in the divisor."""
    win, _ = _windows(x, k, s, p, 0.0)
    return win.sum(axis=(-1, -2)) / (k[0] * k[1])


def avgpool_backward(x, k, s, p, dy):
    n, c, h, w = x.shape
    dxp = np.zeros((n, c, h + 2 * p[0], w + 2 * p[1]))
    ho, wo = dy.shape[2], dy.shape[3]
    g = dy / (k[0] * k[1])
    for i in range(k[0]):
        for j in range(k[1]):
            dxp[:, :, i:i + s[0] * ho:s[0], j:j + s[1] * wo:s[1]] += g
    return dxp[:, :, p[0]:p[0] + h, p[1]:p[1] + w]


def rot_kernels(w: np.ndarray) -> np.ndarray:
    """Kernels rotated by 180 degrees with input and output channels swapped:
    (out, in, kh, kw) -> (in, out, kh, kw). With stride 1, the input delta of
    a convolution is the full-padded convolution of the output delta with
    these kernels."""
    return np.ascontiguousarray(np.flip(w, axis=(2, 3)).transpose(1, 0, 2, 3))


def fill_params(model: "Sequential", value: float) -> None:
    """Set every weight and bias of the model to one value."""
    model.params = [{k: np.full_like(v, float(value)) for k, v in p.items()} for p in model.params]


# ----------------------------------------------------------- dropout masks
def dropout_mask(units: int, ratio: float, seed: int, step: int, layer: int, k: int = 0) -> np.ndarray:
    """Scale per unit: 0 for the ``round(ratio*units)`` units with the
    smallest md5(seed:step:layer:k:unit), ``1/(1-ratio)`` for the others."""
    if ratio <= 0 or units == 0:
        return np.ones(units)
    n_drop = int(np.floor(ratio * units + 0.5))
    keys = [hashlib.md5(f"{seed}:{step}:{layer}:{k}:{u}".encode()).hexdigest() for u in range(units)]
    order = sorted(range(units), key=lambda u: (keys[u], u))
    m = np.full(units, 1.0 / (1.0 - ratio))
    m[order[:n_drop]] = 0.0
    return m


def layer_masks(model: Sequential, seed: int, step: int) -> list[np.ndarray | None]:
    """Combined dropout mask per layer (chained ratios act on the units that
    are still active, each scaling the survivors)."""
    out = []
    for li, layer in enumerate(model.layers):
        if not layer.dropout:
            out.append(None)
            continue
        units = model.shapes[li][0]          # dense units or channels
        m = np.ones(units)
        for k, r in enumerate(layer.dropout):
            alive = np.flatnonzero(m)
            sub = dropout_mask(len(alive), r, seed, step, li, k)
            m[alive] *= sub
        out.append(m)
    return out


# ------------------------------------------------------- forward / backward
def _reshape_in(model: Sequential, x: np.ndarray) -> np.ndarray:
    width = int(np.prod(model.input_shape))
    if x.shape[1] != width:
        raise ValueError(f"rows have {x.shape[1]} features, the model expects {model.input_shape} = {width}")
    return x.reshape((x.shape[0],) + model.input_shape)


def forward(model: Sequential, params, x: np.ndarray, masks=None, keep=False):
    """Run all layers on a batch ``x`` (n, features). Returns the output
    (n, out_features) and, with ``keep``, the per-layer caches."""
    a = _reshape_in(model, x)
    caches = []
    for li, layer in enumerate(model.layers):
        p = params[li]
        cache = {"x": a}
        if isinstance(layer, Dense):
            z = a @ p["w"] + p["b"]
            a = act_np(z, layer.activation)
            cache.update(z=z, a=a)
        elif isinstance(layer, Conv2D):
            z = conv_forward(a, p["w"], p["b"], layer.stride, layer.padding)
            a = act_np(z, layer.activation)
            cache.update(z=z, a=a)
        elif isinstance(layer, MaxPool2D):
            a, arg = maxpool_forward(a, layer.pool, layer.stride, layer.padding)
            cache.update(arg=arg)
        elif isinstance(layer, AvgPool2D):
            a = avgpool_forward(a, layer.pool, layer.stride, layer.padding)
        elif isinstance(layer, Flatten):
            a = a.reshape(a.shape[0], -1)
        m = masks[li] if masks is not None else None
        if m is not None:
            shape = (1, -1) if a.ndim == 2 else (1, -1, 1, 1)
            a = a * m.reshape(shape)
            cache["mask"] = m.reshape(shape)
        cache["out"] = a
        caches.append(cache)
    out = a.reshape(a.shape[0], -1)
    return (out, caches) if keep else out


def output_delta(model: Sequential, loss: str, out: np.ndarray, y: np.ndarray, cache) -> np.ndarray:
    """dL/dz of the last layer per sample (not yet divided by the batch size)."""
    last = model.layers[-1]
    act = check_activation(getattr(last, "activation", "linear"))
    diff = out - y
    if cache.get("mask") is not None:
        diff = diff * cache["mask"].reshape(1, -1)
    if loss in ("categorical_crossentropy", "binary_crossentropy"):
        return diff.reshape(cache["out"].shape)
    a, z = cache.get("a"), cache.get("z")
    if a is None:  # last layer without activation (pool / flatten)
        return diff.reshape(cache["out"].shape)
    return act_backward(a, z, act, diff.reshape(a.shape))


def check_loss_pair(model: Sequential, loss: str) -> None:
    last = model.layers[-1]
    act = check_activation(getattr(last, "activation", "linear"))
    if loss == "categorical_crossentropy" and act != "softmax":
        raise ValueError("categorical_crossentropy needs a softmax output layer")
    if loss == "binary_crossentropy" and act != "sigmoid":
        raise ValueError("binary_crossentropy needs a sigmoid output layer")
    if loss not in ("mse", "categorical_crossentropy", "binary_crossentropy"):
        raise ValueError(f"unknown loss {loss!r}")


def backward(model: Sequential, params, caches, delta, lookahead=None):
    """Gradient sums over the batch for every parameter; ``delta`` is dL/dz
    of the last layer. ``lookahead`` (Nesterov) replaces the weights used to
    pass deltas to the previous layer."""
    grads = [dict() for _ in model.layers]
    g_z = delta
    for li in range(len(model.layers) - 1, -1, -1):
        layer, c, p = model.layers[li], caches[li], params[li]
        wprop = (lookahead[li]["w"] if lookahead is not None and "w" in p else p.get("w"))
        if li != len(model.layers) - 1:
            g_a = g_z
            if c.get("mask") is not None:
                g_a = g_a * c["mask"]
            if isinstance(layer, (Dense, Conv2D)):
                g_z = act_backward(c["a"], c["z"], layer.activation, g_a)
            else:
                g_z = g_a
        if isinstance(layer, Dense):
            grads[li] = {"w": c["x"].T @ g_z, "b": g_z.sum(axis=0)}
            g_z = g_z @ wprop.T
        elif isinstance(layer, Conv2D):
            # below the first layer no delta is needed
            dw, db, g_z = conv_backward(c["x"], wprop, g_z, layer.stride, layer.padding, deltas=li > 0)
            grads[li] = {"w": dw, "b": db}
        elif isinstance(layer, MaxPool2D):
            g_z = maxpool_backward(c["x"], layer.pool, layer.stride, layer.padding, c["arg"], g_z)
        elif isinstance(layer, AvgPool2D):
            g_z = avgpool_backward(c["x"], layer.pool, layer.stride, layer.padding, g_z)
        elif isinstance(layer, Flatten):
            g_z = g_z.reshape(c["x"].shape)
    return grads


# ----------------------------------------------------------- losses (sums)
def loss_sum(loss: str, out: np.ndarray, y: np.ndarray, rank: int = 1) -> tuple[float, float]:
    """(sum, denominator) so that partition sums add up exactly. ``rank`` is
    the rank of the model output: binary cross-entropy uses output 0 of a
    vector output and every element of a tensor output."""
    n, k = y.shape
    if loss == "mse":
        return float(((out - y) ** 2).sum()), float(n * k)
    if loss == "mae":
        return float(np.abs(out - y).sum()), float(n * k)
    if loss == "binary_crossentropy":
        p, t = (out, y) if rank == 3 else (out[:, :1], y[:, :1])
        p = np.clip(p, 1e-8, 1 - 1e-8)
        return float((-(t * np.log(p) + (1 - t) * np.log(1 - p))).sum()), float(p.size)
    if loss == "categorical_crossentropy":
        if rank == 3:
            raise ValueError("categorical_crossentropy is not defined for tensor outputs")
        return float(-(np.log(out + 1e-10) * (y == 1.0)).sum()), float(n)
    raise ValueError(f"unknown loss {loss!r}")


def metric_sum(metric: str, out: np.ndarray, y: np.ndarray, rank: int = 1) -> tuple[float, float]:
    n, k = y.shape
    if metric == "accuracy":
        if rank == 3:
            raise ValueError("accuracy is not defined for tensor outputs")
        metric = "binary_accuracy" if k == 1 else "categorical_accuracy"
    if metric in ("mse", "mae"):
        return loss_sum(metric, out, y)
    if metric == "binary_accuracy":
        p, t = (out, y) if rank == 3 else (out[:, :1], y[:, :1])
        return float(((p > 0.5).astype(float) == t).sum()), float(p.size)
    if metric == "categorical_accuracy":
        if rank == 3:
            raise ValueError("categorical_accuracy is not defined for tensor outputs")
        return float(y[np.arange(n), out.argmax(axis=1)].sum()), float(n)
    raise ValueError(f"unknown metric {metric!r}")
