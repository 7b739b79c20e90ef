"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

By Sylvester's law the pivots of an LDL' factorisation of ``matrix - shift`` have as many positive signs as there are
eigenvalues above the shift.  Bisection over such counts gives each leading eigenvalue an interval of its own; Rayleigh
quotient iteration, which converges cubically, finishes it there, and counts on both sides certify its number.
Eigenvalues closer than rounding lets counts tell apart share an interval; their vectors are made orthogonal to each other.
"""

from __future__ import annotations

import numpy as np

GROWTH = (1 + 17**0.5) / 8  # of Bunch and Parlett: when a pivot of two rows is the better one
ROUNDS = 40


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above the shift: positive pivots of one or two rows, chosen over the whole rest."""
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        size = len(rest)
        diagonal = np.abs(np.diag(rest))
        one = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diag(rest)))
        i, j = divmod(int(off.argmax()), size)
        if diagonal[one] == 0 and off[i, j] == 0:  # only eigenvalues equal to the shift are left
            break
        rows = [one] if diagonal[one] >= GROWTH * off[i, j] else [i, j]
        others = np.delete(np.arange(size), rows)
        pivot, border = rest[np.ix_(rows, rows)], rest[np.ix_(others, rows)]
        if len(rows) == 1:
            above += int(pivot[0, 0] > 0)
            rest = rest[np.ix_(others, others)] - border @ border.T / pivot[0, 0]
        else:
            above += 1  # such a pivot has one eigenvalue of either sign
            rest = rest[np.ix_(others, others)] - border @ np.linalg.solve(pivot, border.T)
        rest = (rest + rest.T) / 2
    return above


def intervals(matrix: np.ndarray, number: int) -> list[tuple[float, float]]:
    """For each of the leading eigenvalues an interval that holds it, and no other unless they are too close."""
    radius = np.abs(matrix).sum(1) - np.abs(np.diag(matrix))  # of Gershgorin's discs
    low, high = float((np.diag(matrix) - radius).min()), float((np.diag(matrix) + radius).max())
    size = max(abs(low), abs(high)) or 1.0
    margin, closest = size * 1e-3, 64 * np.finfo(float).eps * size
    known = {low - margin: len(matrix), high + margin: 0}  # shift: eigenvalues above it

    out = []
    for k in range(1, number + 1):
        while True:
            left = max(s for s, n in known.items() if n >= k)
            right = min(s for s, n in known.items() if n < k and s > left)
            if (known[left] == k and known[right] == k - 1) or right - left <= closest or not left < (left + right) / 2 < right:
                break
            middle = (left + right) / 2
            known[middle] = min(max(count_above(matrix, middle), known[right]), known[left])
        out.append((left, right))
    return out


def leading(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the ``number`` greatest ones."""
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    number = min(number, size)
    scale = max(float(np.abs(matrix).max(initial=0.0)), 1e-300)
    rng = np.random.default_rng(11)
    values, vectors = [], np.zeros((size, 0))

    def clear(x: np.ndarray) -> np.ndarray:
        """Unit vector without the parts that lie in vectors found before."""
        for _ in range(2):
            x = x - vectors @ (vectors.T @ x)
        return x / np.linalg.norm(x)

    def solved(shift: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 1e-15, 1e-14, 1e-13):
            try:
                y = np.linalg.solve(matrix - (shift + nudge * scale) * np.eye(size), x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return y
        return x

    rounding = 16 * np.finfo(float).eps * scale * size
    for k, (left, right) in enumerate(intervals(matrix, number), 1):
        for _ in range(ROUNDS):
            off, value, x = _iterated(matrix, (left + right) / 2, clear(rng.standard_normal(size)), clear, solved, rounding)
            if off <= 64 * rounding and left - rounding <= value <= right + rounding:
                break
            left, right = _halved(matrix, left, right, k)  # closer to the start, so that no other one is reached
        values.append(value)
        vectors = np.c_[vectors, x]
    _certify(matrix, np.array(values), scale)
    return np.array(values), vectors


def _iterated(matrix, start, x, clear, solved, rounding) -> tuple[float, float, np.ndarray]:
    """Inverse iteration at ``start``, then at the quotients; the residual, quotient and vector that came closest."""
    for _ in range(3):
        x = clear(solved(start, x))
    best, since = (np.inf, start, x), 0
    while since < 3:
        quotient = float(x @ matrix @ x)
        off = float(np.linalg.norm(matrix @ x - quotient * x))
        best, since = ((off, quotient, x), 0) if off < best[0] else (best, since + 1)
        if off <= rounding / 16:
            break
        x = clear(solved(quotient, x))
    return best


def _halved(matrix: np.ndarray, left: float, right: float, k: int) -> tuple[float, float]:
    middle = (left + right) / 2
    return (middle, right) if count_above(matrix, middle) >= k else (left, middle)


def _certify(matrix: np.ndarray, values: np.ndarray, scale: float) -> None:
    """The k-th value has k - 1 eigenvalues above it and k from it on, as far as rounding can tell."""
    slack = 1e-10 * scale * max(len(matrix), 1)
    for k, value in enumerate(values, 1):
        if not count_above(matrix, value + slack) < k <= count_above(matrix, value - slack):
            raise ArithmeticError(f"eigenvalue {k} is not the {k}-th of the matrix")
