"""Leading eigenvectors of a symmetric matrix by spectral divide and conquer.

The orthogonal polar factor of ``A - sI`` is +1 on the eigenvectors above the
shift s and -1 on those below it, so half of its sum with the identity projects
on the invariant subspace above. An orthonormal basis of the two subspaces cuts
the matrix in two smaller ones, which are split in the same way until a part is
a single direction or a multiple of the identity.

Polar factors come from dynamically weighted Halley steps (QDWH): products, QR
and Cholesky factorisations only, about six steps whatever the condition.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without an eigenvalue zero, which is its sign."""
    size = len(matrix)
    identity = np.eye(size)
    x = matrix / np.linalg.norm(matrix)
    low = EPS / 4
    for _ in range(60):
        d = math.cbrt(4 * (1 - low * low) / low**4)
        root = math.sqrt(1 + d)
        a = root + math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * root))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, identity]))
            step = q[:size] @ q[size:].T * ((a - b / c) / math.sqrt(c))
        else:
            lower = np.linalg.cholesky(identity + c * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            step = np.linalg.solve(lower.T, half).T * (a - b / c)
        new = x * (b / c) + step
        new = (new + new.T) / 2
        moved = float(np.linalg.norm(new - x))
        x = new
        low = min(1.0, low * (a + b * low * low) / (1 + c * low * low))
        if 1 - low <= 10 * EPS and moved <= math.cbrt(5 * EPS):
            break
    return x


def _bases(part: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the subspaces above and below a shift; None if the part is a multiple of the identity.

    The mean of the eigenvalues lies strictly between the greatest and the least;
    where it hits one, it is moved by less than any of them must differ from it.
    """
    size = len(part)
    mean = float(np.trace(part)) / size
    spread = float(np.linalg.norm(part - mean * np.eye(size))) / math.sqrt(size)
    if spread <= 4 * EPS * scale:
        return None
    start = np.random.default_rng(size).standard_normal((size, size))
    for move in (0, 1, -1, 2, -2, 3, -3):
        sign = polar(part - (mean + move * spread / (8 * size)) * np.eye(size))
        above = (sign + np.eye(size)) / 2
        count = round(float(np.trace(above)))
        if not 0 < count < size or np.linalg.norm(sign @ sign - np.eye(size)) > 1e-8:
            continue
        basis = start
        for _ in range(3):
            turned = above @ basis
            basis, _ = np.linalg.qr(np.hstack([turned[:, :count], basis[:, count:] - turned[:, count:]]))
            upper, lower = basis[:, :count], basis[:, count:]
            if np.linalg.norm(lower.T @ part @ upper) <= 10 * size * EPS * scale:
                break
        return upper, lower
    return None


def leading(matrix: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Parts below enough greater eigenvalues are not split any further. Of equal
    eigenvalues any basis of their subspace is given. Signs are such that the
    largest entry of a vector, the first of equals, is positive.
    """
    size = len(matrix)
    wanted = size if most is None else min(most, size)
    scale = float(np.linalg.norm(matrix))
    axes: list[np.ndarray] = []
    # Parts by falling eigenvalues, the greatest last; a basis each.
    rest = [np.eye(size)] if size else []
    while rest and len(axes) < wanted:
        basis = rest.pop()
        part = basis.T @ matrix @ basis
        part = (part + part.T) / 2
        cut = _bases(part, scale) if len(part) > 1 else None
        if cut is None:
            axes.extend(basis.T)
        else:
            rest += [basis @ cut[1], basis @ cut[0]]
    vectors = np.array(axes).reshape(len(axes), size).T
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors, values = vectors[:, order], values[order]
    if vectors.size:
        vectors = vectors / np.linalg.norm(vectors, axis=0)
        top = np.argmax(np.abs(vectors), axis=0)
        vectors = vectors * np.where(vectors[top, np.arange(len(values))] < 0, -1.0, 1.0)
    return values, vectors
