"""NumPy kernels for network layers, run inside Arrow batches (``mapInPandas``).

A network is a list of layer tuples::

    ("reshape", (C, H, W)) | ("linear", name) | ("relu",) | ("bn", name) | ("dropout", p)
    | ("conv", name, k) | ("pool", k) | ("flatten",)

Parameters are a dict ``name -> ndarray``: ``<name>.weight`` / ``<name>.bias`` and, for
batch norm, ``<name>.running_mean`` / ``<name>.running_var``. Linear weights are
(out, in); convolution weights are stored as (out, in*k*k) rows and viewed as (out, in, k, k).
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

BN_EPS = 1e-5


def conv2d(X: np.ndarray, Wt: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Valid convolution, stride 1. X (n, C, H, W); Wt (O, C, k, k); b (O,)."""
    k = Wt.shape[2]
    win = sliding_window_view(X, (k, k), axis=(2, 3))          # n, C, H', W', k, k
    return np.einsum("nchwij,ocij->nohw", win, Wt, optimize=True) + b[None, :, None, None]


def max_pool(X: np.ndarray, k: int = 2) -> np.ndarray:
    """k x k max pooling with stride k; odd edges dropped (floor)."""
    n, c, h, w = X.shape
    h2, w2 = h // k, w // k
    return X[:, :, :h2 * k, :w2 * k].reshape(n, c, h2, k, w2, k).max(axis=(3, 5))


def conv_weight(params: dict, name: str, k: int) -> np.ndarray:
    Wt = params[f"{name}.weight"]
    return Wt.reshape(Wt.shape[0], -1, k, k)


def forward(X: np.ndarray, layers: list[tuple], params: dict) -> np.ndarray:
    """Inference forward pass (dropout is the identity, batch norm uses stored statistics)."""
    t = X
    for layer in layers:
        op = layer[0]
        if op == "reshape":
            t = t.reshape((t.shape[0],) + tuple(layer[1]))
        elif op == "flatten":
            t = t.reshape(t.shape[0], -1)
        elif op == "linear":
            t = t @ params[f"{layer[1]}.weight"].T + params[f"{layer[1]}.bias"]
        elif op == "relu":
            t = np.maximum(t, 0.0)
        elif op == "bn":
            nm = layer[1]
            t = (t - params[f"{nm}.running_mean"]) / np.sqrt(params[f"{nm}.running_var"] + BN_EPS) \
                * params[f"{nm}.weight"] + params[f"{nm}.bias"]
        elif op == "dropout":
            pass
        elif op == "conv":
            t = conv2d(t, conv_weight(params, layer[1], layer[2]), params[f"{layer[1]}.bias"])
        elif op == "pool":
            t = max_pool(t, layer[1])
        else:
            raise ValueError(op)
    return t


def argmax_rows(S: np.ndarray) -> np.ndarray:
    """Row arg-max, ties -> lowest index (NumPy's rule)."""
    return np.argmax(S, axis=1)


def log_softmax(S: np.ndarray) -> np.ndarray:
    m = S.max(axis=1, keepdims=True)
    return S - (m + np.log(np.exp(S - m).sum(axis=1, keepdims=True)))
