"""Leading eigenvectors of a symmetric matrix that is known by its products only, by the
block Jacobi-Davidson method. Everything here has the size of a few vectors; ``product``
does the work on the data."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
"""The matrix times the columns of a block."""

EPSILON = float(np.finfo(np.float64).eps)
INNER_STEPS = 4
"""Steps of the inner solver; each is one product with all columns."""
BASIS = 6
"""Size of the subspace, in blocks, from which it is reduced to its best vectors."""
ROUNDS = 200


def _norms(block: np.ndarray) -> np.ndarray:
    return np.sqrt((block * block).sum(axis=0))


def minres(apply: Product, right: np.ndarray, steps: int, rtol: float) -> np.ndarray:
    """Solve for all columns of ``right`` in lockstep by the minimal residual method. A column
    rests once its residual fell to ``rtol`` of the start, or it cannot go on."""
    x = np.zeros_like(right)
    v_old, w_old, w = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    beta = _norms(right)
    active = beta > 0
    v = right / np.where(active, beta, 1.0)
    eta, start = beta.copy(), beta.copy()
    cos_old, cos = np.ones_like(beta), np.ones_like(beta)
    sin_old, sin = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        if not active.any():
            break
        image = apply(v * active)
        alpha = (v * image).sum(axis=0)
        v_new = image - alpha * v - beta * v_old
        beta_new = _norms(v_new)
        delta = cos * alpha - cos_old * sin * beta
        rho = np.hypot(delta, beta_new)
        active &= rho > EPSILON * start
        safe = np.where(active, rho, 1.0)
        w_new = (v - sin_old * beta * w_old - (sin * alpha + cos_old * cos * beta) * w) / safe
        cos_old, cos, sin_old, sin = cos, delta / safe, sin, beta_new / safe
        x += np.where(active, cos * eta, 0.0) * w_new
        eta = -sin * eta
        w_old, w, v_old = w, w_new, v
        active &= (np.abs(eta) > rtol * start) & (beta_new > EPSILON * start)
        v, beta = v_new / np.where(beta_new > 0, beta_new, 1.0), beta_new
    return x


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """What ``block`` adds to the orthonormal columns ``against``, orthonormal itself."""
    out: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        if not size > 0 or len(out) + against.shape[1] >= len(column):
            continue
        column = column / size
        for _ in range(3):
            column = column - against @ (against.T @ column)
            for other in out:
                column = column - other * (other @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            out.append(column)
    return np.stack(out, axis=1) if out else np.zeros((len(block), 0))


def leading(product: Product, d: int, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Each round: Rayleigh-Ritz on the subspace; vectors whose residual has reached the rounding
    of a product are locked, largest first; for the others the projected correction equations
    are solved roughly by MINRES, and the corrections enlarge the subspace. A residual that
    has come close to that and stops falling is at its rounding too.
    """
    k = min(k, d)
    if k == 0:
        return np.zeros(0), np.zeros((d, 0))
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, k)), np.zeros((d, 0)))
    images = product(basis)
    best = np.full(k, np.inf)
    stalled = np.zeros(k, dtype=int)
    values, vectors = np.zeros(k), basis
    for _ in range(ROUNDS):
        inner = basis.T @ images
        theta, ritz = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-theta)
        theta, ritz = theta[order], ritz[:, order]
        values, vectors = theta[:k], basis @ ritz[:, :k]
        residuals = images @ ritz[:, :k] - vectors * values
        size = _norms(residuals)
        scale = max(float(np.abs(theta).max()), np.finfo(np.float64).tiny)
        stalled = np.where(size < 0.5 * best, 0, stalled + 1)
        best = np.minimum(best, size)
        exact = size <= 4 * EPSILON * np.sqrt(d) * scale
        settled = exact | ((size <= 1e-12 * scale) & (stalled >= 2))
        locked = int(np.argmin(np.r_[settled, False]))
        if locked == k:
            break
        if basis.shape[1] >= min(BASIS * k, d):
            kept = min(2 * k, basis.shape[1])
            if basis.shape[1] == d:  # nothing is left to add: these are the eigenvectors
                if stalled.min() >= 1:
                    break
                kept = k
            basis, images = basis @ ritz[:, :kept], images @ ritz[:, :kept]
        wanted = slice(locked, k)

        def off(block: np.ndarray, known: np.ndarray = vectors) -> np.ndarray:
            return block - known @ (known.T @ block)

        shifts = values[wanted]
        correction = minres(lambda t: off(product(off(t)) - off(t) * shifts), -off(residuals[:, wanted]), INNER_STEPS, 1e-3)
        new = _orthonormal(off(correction), basis)
        if not new.shape[1]:
            new = _orthonormal(off(residuals[:, wanted]), basis)
        if not new.shape[1]:
            break
        basis, images = np.c_[basis, new], np.c_[images, product(new)]
    # One more Rayleigh-Ritz on exact images of the vectors themselves.
    vectors, _ = np.linalg.qr(vectors)
    inner = vectors.T @ product(vectors)
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, vectors = values[::-1], vectors @ turn[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values, vectors * np.where(signs == 0, 1.0, signs)
