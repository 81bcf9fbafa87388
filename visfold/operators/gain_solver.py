"""Levenberg-Marquardt for antenna gains in several directions, on the samples of one solution interval.

The model of a baseline pq is sum_d m_d G_p,d G_q,d^H with 1x1 (scalar) or 2x2 (Jones) gains and known
patch models m_d. A sample's derivatives only touch its two antennas, so the normal equations are
put together from one small Gram matrix per baseline; the step solves them for all antennas and directions at
once. Unlike antenna-by-antenna updates this doesn't creep where directions are hardly told apart: it
ends at rounding errors for data that the model can explain.
"""

from __future__ import annotations

import numpy as np

#: Steps that lower the misfit by less than this share end the search.
STALLED = 1e-9
#: Entries of per-sample Gram matrices held at once.
HELD = 4_000_000


def _model(G: np.ndarray, m: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.einsum("sd,sdik,sdjk->sij", m, G[p], G[q].conj())


def _jacobian(G: np.ndarray, m: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Real derivatives (sample, residual part, parameter of p then of q)."""
    S, D, n = len(p), m.shape[1], G.shape[2]
    z = (m[:, :, None, None] * G[q].conj()).transpose(0, 2, 1, 3)  # s, j, d, k: of G_p's row i
    y = (m[:, :, None, None] * G[p]).transpose(0, 2, 1, 3)         # s, i, d, k: of the conjugate of G_q's row j
    of_p, of_q = np.zeros((S, n, n, 2, D, n, n, 2)), np.zeros((S, n, n, 2, D, n, n, 2))
    for i in range(n):
        of_p[:, i, :, 0, :, i, :, 0], of_p[:, i, :, 0, :, i, :, 1] = z.real, -z.imag
        of_p[:, i, :, 1, :, i, :, 0], of_p[:, i, :, 1, :, i, :, 1] = z.imag, z.real
        of_q[:, :, i, 0, :, i, :, 0], of_q[:, :, i, 0, :, i, :, 1] = y.real, y.imag
        of_q[:, :, i, 1, :, i, :, 0], of_q[:, :, i, 1, :, i, :, 1] = y.imag, -y.real
    rows = 2 * n * n
    return np.concatenate([of_p.reshape(S, rows, -1), of_q.reshape(S, rows, -1)], axis=2)


def _normal(G, V, m, p, q, w, edges):
    """Normal matrix and right-hand side; samples are sorted by baseline, which start at ``edges``."""
    na, D, n = G.shape[:3]
    C = 2 * D * n * n
    A, b = np.zeros((na, C, na, C)), np.zeros((na, C))
    ends = np.append(edges[1:], len(p))
    step = max(1, HELD // (2 * C * (2 * C + 2 * n * n)))
    for start, end in zip(edges.tolist(), ends.tolist()):
        i, j = p[start], q[start]
        gram, right = np.zeros((2 * C, 2 * C)), np.zeros(2 * C)
        for at in range(start, end, step):
            s = slice(at, min(at + step, end))
            J = _jacobian(G, m[s], p[s], q[s]) * np.sqrt(w[s])[:, None, None]
            R = (V[s] - _model(G, m[s], p[s], q[s])) * np.sqrt(w[s])[:, None, None]
            J = J.reshape(-1, 2 * C)
            gram += J.T @ J
            right += J.T @ np.stack([R.real, R.imag], axis=3).ravel()
        A[i, :, i, :] += gram[:C, :C]
        A[i, :, j, :] += gram[:C, C:]
        A[j, :, i, :] += gram[C:, :C]
        A[j, :, j, :] += gram[C:, C:]
        b[i] += right[:C]
        b[j] += right[C:]
    return A.reshape(na * C, na * C), b.ravel()


def fit_gains(V: np.ndarray, m: np.ndarray, p: np.ndarray, q: np.ndarray, w: np.ndarray, antennas: int,
              max_iter: int = 100) -> tuple[np.ndarray, int, bool]:
    """Gains (antenna, direction, n, n), iterations, settled. V: (sample, n, n), m: (sample, direction).

    Starts at unit gains. Settled means that no step lowers the misfit any more; finite input is expected.
    """
    order = np.lexsort((q, p))
    V, m, p, q, w = V[order], m[order], p[order], q[order], w[order]
    edges = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (q[1:] != q[:-1])]))
    n, D = V.shape[1], m.shape[1]
    G = np.broadcast_to(np.eye(n, dtype=complex), (antennas, D, n, n)).copy()

    def misfit(gains):
        return float((w[:, None, None] * np.abs(V - _model(gains, m, p, q)) ** 2).sum())
    total, now, damping = float((w[:, None, None] * np.abs(V) ** 2).sum()), misfit(G), 1e-3
    A = None
    for turn in range(1, max_iter + 1):
        if now <= 1e-28 * total:
            return G, turn - 1, True
        if A is None:
            A, b = _normal(G, V, m, p, q, w, edges)
            scale = np.diag(A).copy()
            scale = np.maximum(scale, 1e-12 * max(scale.max(), 1e-300))
        try:
            step = np.linalg.solve(A + np.diag(damping * scale), b)
        except np.linalg.LinAlgError:
            step = np.full(len(b), np.nan)
        step = step.reshape(antennas, D, n, n, 2)
        tried = G + step[..., 0] + 1j * step[..., 1]
        then = misfit(tried)
        if then < now:
            gain, G, now, damping, A = (now - then) / now, tried, then, max(damping / 6, 1e-14), None
            if gain < STALLED:
                return G, turn, True
        else:
            damping *= 10
            if damping > 1e10:  # no direction leads down
                return G, turn, True
    return G, max_iter, False
