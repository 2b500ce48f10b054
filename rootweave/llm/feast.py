"""Largest eigenpairs of a small symmetric matrix by contour integration (FEAST).

An interval of the spectrum is enclosed by a circle in the complex plane. The integral of the resolvent
along it is the projector onto the eigenvectors inside; Gauss-Legendre quadrature turns it into a
weighted sum of solutions of complex shifted systems. Applied to a random block of vectors and repeated,
with a Rayleigh-Ritz step in between, it gives the eigenpairs of the interval. How many there must be
is known beforehand: the inertia of the shifted matrix counts the eigenvalues below a shift. A result with another count is not accepted.
"""

from __future__ import annotations

import numpy as np

NODES = 16
ROUNDS = 40
SLICE = 24  # eigenvalues per interval, if they can be told apart


class NotFound(ArithmeticError):
    """An interval did not give as many eigenpairs as its inertia counts."""


class Inertia:
    """Counts of the eigenvalues on either side of a shift.

    The matrix is brought to tridiagonal form once, by reflections, which keep its eigenvalues. The signs of the
    pivots of the symmetric factorisation of that form minus a shift are its inertia.
    """

    def __init__(self, matrix: np.ndarray):
        rest = np.array(matrix, float)
        self.size = len(rest)
        self.floor = max(np.finfo(float).tiny, (np.finfo(float).eps * np.abs(rest).max(initial=0.0)) ** 2)
        self.diagonal, self.beside = [], []
        while len(rest):
            self.diagonal.append(float(rest[0, 0]))
            column, rest = rest[1:, 0], rest[1:, 1:]
            if not len(column):
                break
            length = float(np.linalg.norm(column))
            self.beside.append(length * length)
            mirror = column.copy()
            mirror[0] += np.copysign(length, mirror[0])
            norm = mirror @ mirror
            if norm > 0:
                half = rest @ mirror * (2 / norm)
                half -= mirror * (mirror @ half / norm)
                rest = rest - np.outer(mirror, half) - np.outer(half, mirror)

    def below(self, shift: float) -> int:
        """Eigenvalues below ``shift``."""
        negative, pivot = 0, 1.0
        for entry, square in zip(self.diagonal, [0.0, *self.beside]):
            pivot = entry - shift - square / pivot
            if pivot == 0:
                pivot = self.floor**0.5 or self.floor
            negative += pivot < 0
        return negative

    def above(self, shift: float) -> int:
        """Eigenvalues from ``shift`` up."""
        return self.size - self.below(shift)


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part in the eigenvectors between the limits, by quadrature along the upper half circle."""
    centre, radius = (low + high) / 2, (high - low) / 2
    total = np.zeros_like(block)
    for t, weight in zip(*np.polynomial.legendre.leggauss(NODES)):
        z = radius * np.exp(0.5j * np.pi * (t + 1))
        solved = np.linalg.solve((centre + z) * np.eye(len(matrix)) - matrix, block.astype(complex))
        total += 0.5 * weight * (z * solved).real
    return total


def interval(matrix: np.ndarray, low: float, high: float, expected: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``expected`` eigenpairs between the limits."""
    n, scale = len(matrix), max(np.abs(matrix).sum(axis=0).max(), np.finfo(float).tiny)
    tolerance = 64 * np.finfo(float).eps * scale * np.sqrt(n)
    block = rng.standard_normal((n, min(n, expected + max(6, expected // 2))))
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(project(matrix, block, low, high))
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ turn
        off = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        inside = (values >= low) & (values <= high)
        if inside.sum() == expected and (off[inside] <= tolerance).all():
            return values[inside], vectors[:, inside]
        block = vectors
    raise NotFound(f"{int(inside.sum())} of {expected} eigenvalues between {low} and {high}, residuals up to {off[inside].max(initial=0)}")


def _end(inertia: Inertia, inside: float, outside: float, count: int) -> float:
    """How far towards ``outside`` the count stays the same, from ``inside`` on."""
    for _ in range(40):
        probe = (inside + outside) / 2
        if inertia.above(probe) == count:
            inside = probe
        else:
            outside = probe
    return inside


def _cut(inertia: Inertia, lowest: float, highest: float, wanted: int) -> tuple[float, int]:
    """A shift in the middle of a gap with ``wanted`` eigenvalues above it, or all of the cluster that the last belongs to."""
    low, high = lowest, highest
    fewest = np.finfo(float).eps * 64 * max(abs(low), abs(high))
    middle = (low + high) / 2
    while (count := inertia.above(middle)) != wanted and high - low > fewest:
        low, high = (middle, high) if count > wanted else (low, middle)
        middle = (low + high) / 2
    if count != wanted:
        middle, count = low, inertia.above(low)
    under = _end(inertia, middle, lowest, count)
    above = _end(inertia, middle, highest, count)
    return (under + above) / 2, count


def largest(matrix: np.ndarray, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors in columns; k is at most the size."""
    n = len(matrix)
    k = min(k, n)
    bound = np.abs(matrix).sum(axis=0).max(initial=0.0)
    if not k or not bound:
        return np.zeros(k), np.eye(n)[:, :k]
    rng, inertia = np.random.default_rng(seed), Inertia(matrix)
    low, high = -bound * 1.01, bound * 1.01
    values, vectors, done, top = [], [], 0, high
    while done < k:  # slices from the top, each cut in a gap
        wanted = min(k, done + SLICE)
        end, upto = (low, n) if wanted == n else _cut(inertia, low, top, wanted)
        found, columns = interval(matrix, end, top, upto - done, rng)
        values.append(found)
        vectors.append(columns)
        done, top = upto, end
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    if len(values) != inertia.above(top):
        raise NotFound(f"{len(values)} eigenvalues above {top}, the inertia counts {inertia.above(top)}")
    order = np.argsort(-values, kind="stable")[:k]
    # Slices are orthogonal to each other up to rounding only.
    basis, turn = np.linalg.qr(vectors[:, order])
    return values[order], basis * np.sign(np.diag(turn))
