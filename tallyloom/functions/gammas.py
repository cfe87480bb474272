"""Logarithm and derivatives of the gamma function over numpy arrays of positive numbers."""

from __future__ import annotations

import numpy as np

#: Arguments are raised above this, where the asymptotic series hold to double precision.
_LARGE = 10


def _raised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arguments raised to `_LARGE` or more by whole steps, and how many steps each took."""
    x = np.asarray(x, np.float64)
    steps = np.maximum(0.0, np.ceil(_LARGE - x))
    return x + steps, steps


def digamma(x: np.ndarray) -> np.ndarray:
    """First derivative of the logarithm of gamma."""
    x = np.asarray(x, np.float64)
    y = x + _LARGE  # every argument is raised by ten steps, whose reciprocals are summed in pairs
    r = 1.0 / (y * y)
    out = np.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r * (1 / 132)))))
    pair = x * (x + 9)
    taken = 1.0 / pair
    for more in (8, 14, 18, 20):  # (x + 1)(x + 8) and so on are `pair` and this
        taken += 1.0 / (pair + more)
    return out - taken * (2 * x + 9)


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of the logarithm of gamma."""
    x = np.asarray(x, np.float64)
    y, steps = _raised(x)
    r = 1.0 / (y * y)
    out = 1.0 / y + 0.5 * r + r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * (5 / 66)))))
    for i in range(_LARGE):
        out += np.where(steps > i, 1.0 / (x + i) ** 2, 0.0)
    return out


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of gamma."""
    x = np.asarray(x, np.float64)
    y, steps = _raised(x)
    r = 1.0 / (y * y)
    out = (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680)))) / y
    for i in range(_LARGE):
        out -= np.where(steps > i, np.log(np.where(steps > i, x + i, 1.0)), 0.0)
    return out
