"""The largest eigenpairs of a symmetric matrix that is known only by its products (block Jacobi-Davidson)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

EPS = np.finfo(float).eps

#: blocks of vectors in the subspace before it is cut back to its best two
MOST_BLOCKS = 4
#: pairs that are improved beside the wanted ones, so that none is overlooked
GUARDS = 2


def _new_directions(block: np.ndarray, *known: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to orthonormal ``known`` columns."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        for basis in known:
            block = block - basis @ (basis.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10]
    for basis in known:
        u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0]


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one per column, side by side: each step is one product with a block.

    Ends when every residual has fallen by ``reduction``, or after ``steps``.
    """
    solution = np.zeros_like(right)
    first = np.linalg.norm(right, axis=0)
    tiny = np.finfo(float).tiny
    before, current, fresh = np.zeros_like(right), right.copy(), right.copy()
    w_before, w = np.zeros_like(right), np.zeros_like(right)
    beta_before, beta = np.ones_like(first), first.copy()
    cosine, sine, d_bar, epsilon, phi_bar = -np.ones_like(first), np.zeros_like(first), np.zeros_like(first), np.zeros_like(first), first.copy()
    for step in range(steps):
        alive = (beta > 10 * EPS * first) & (first > 0)
        if not (alive & (phi_bar > reduction * first)).any():
            break
        v = np.where(alive, fresh / np.maximum(beta, tiny), 0)
        fresh = apply(v)
        if step:
            fresh = fresh - before * (beta / np.maximum(beta_before, tiny))
        alpha = np.sum(v * fresh, axis=0)
        fresh = np.where(alive, fresh - current * (alpha / np.maximum(beta, tiny)), 0)
        before, current = current, fresh
        beta_before, beta = beta, np.linalg.norm(fresh, axis=0)
        epsilon_before = epsilon
        delta = cosine * d_bar + sine * alpha
        g_bar = sine * d_bar - cosine * alpha
        epsilon, d_bar = sine * beta, -cosine * beta
        gamma = np.maximum(np.hypot(g_bar, beta), EPS * np.maximum(first, tiny))
        cosine, sine = g_bar / gamma, beta / gamma
        phi, phi_bar = cosine * phi_bar, np.abs(sine * phi_bar)
        w_before, w = w, np.where(alive, (v - w_before * epsilon_before - w * delta) / gamma, 0)
        solution += np.where(alive, w * phi, 0)
    return solution


def largest_eigenpairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, seed: int = 11,
                       inner_steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """``(values, vectors)``: the ``wanted`` largest eigenvalues, falling, of a positive semidefinite matrix with ``size``
    rows, and their unit vectors as columns.

    ``product`` multiplies the matrix with a block of columns. Each round takes the Ritz pairs of the subspace,
    locks the leading ones whose residual is rounding noise, and widens the subspace by approximate solutions of
    the projected correction equations of the others.
    """
    wanted = min(wanted, size)
    block = min(size, wanted + GUARDS)
    locked = np.zeros((size, 0))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, block)))[0]
    image = product(basis)
    noise, best, stalled = 4 * EPS * np.sqrt(size), np.inf, 0
    scale = 0.0
    while locked.shape[1] < wanted:
        small = basis.T @ image
        values, rotation = np.linalg.eigh((small + small.T) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        basis, image = basis @ rotation, image @ rotation
        scale = max(scale, float(values[0]))
        residual = image - basis * values
        residual -= locked @ (locked.T @ residual)
        need = wanted - locked.shape[1]
        errors = np.linalg.norm(residual[:, :need], axis=0)
        whole = basis.shape[1] + locked.shape[1] >= size
        # products carry rounding errors of their own: a worst error that no longer falls is theirs
        worst = float(errors.max())
        stalled = stalled + 1 if worst > best / 2 else 0
        best = min(best, worst)
        enough = noise * scale if stalled < 3 else max(noise * scale, min(worst, 1e-12 * scale))
        held = errors <= enough
        ready = need if whole or held.all() else int(np.argmin(held))
        if ready:
            locked = np.hstack([locked, basis[:, :ready]])
            basis, image, values, residual = basis[:, ready:], image[:, ready:], values[ready:], residual[:, ready:]
            best, stalled = np.inf, 0
            if locked.shape[1] >= wanted:
                break
        active = min(basis.shape[1], wanted - locked.shape[1] + GUARDS)
        if basis.shape[1] + active > MOST_BLOCKS * block:
            basis, image = basis[:, :2 * block], image[:, :2 * block]
        ritz = basis[:, :active]
        shift = values[:active]

        def projected(x: np.ndarray) -> np.ndarray:
            for known in (locked, ritz):
                x = x - known @ (known.T @ x)
            return x

        correction = minres(lambda x: projected(product(projected(x)) - x * shift), -projected(residual[:, :active]), inner_steps, 0.05)
        fresh = _new_directions(correction, locked, basis)
        if not fresh.shape[1]:  # the corrections lie in the subspace already
            fresh = _new_directions(np.random.default_rng(seed + locked.shape[1] + stalled).standard_normal((size, 1)), locked, basis)
        basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    small = locked.T @ product(locked)
    values, rotation = np.linalg.eigh((small + small.T) / 2)
    return values[::-1], (locked @ rotation)[:, ::-1]
