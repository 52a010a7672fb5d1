"""How near a vector of a ball can be to a query: bounds from the triangle and the Cauchy-Schwarz inequality."""

from __future__ import annotations

import numpy as np

#: Room for the last digits of distances and radii.
SLACK = 1e-6


def least_distances(queries: np.ndarray, centers: np.ndarray, radius: np.ndarray, least: np.ndarray, most: np.ndarray,
                    measure: str) -> np.ndarray:
    """(queries, balls): no vector in a ball is nearer than this.

    A ball holds vectors within ``radius`` of its center, with lengths from ``least`` to ``most``. Distances are those of
    ``vector_search``: 1 - product for ``dot``, 1 - product of unit vectors for ``cosine``, the length of the difference for
    ``euclidean``.
    """
    q, c = queries.astype(np.float64), centers.astype(np.float64)
    own = np.sqrt((q ** 2).sum(axis=1))[:, None]
    inner = q @ c.T
    apart = np.sqrt(np.maximum((own ** 2) + (c ** 2).sum(axis=1) - 2 * inner, 0))
    gap = np.maximum(apart - radius, 0)
    room = SLACK * (1 + own * (1 + most))
    if measure == "euclidean":
        return np.maximum(gap - room, 0)
    straight = inner + own * radius
    if measure == "dot":
        return 1 - np.minimum(straight, (own ** 2 + most ** 2 - gap ** 2) / 2) - room
    with np.errstate(divide="ignore", invalid="ignore"):
        by_product = np.where(straight > 0, straight / (own * least), straight / (own * most))
        # (|q|^2 - gap^2 + t^2) / (2 |q| t) is largest at one end of the lengths t.
        ends = [(own ** 2 - gap ** 2 + t ** 2) / (2 * own * t) for t in (least, most)]
        best = np.minimum(by_product, np.maximum(*ends))
    # Directions of vectors without length are unknown.
    return np.where((least > 0) & (own > 0) & np.isfinite(best), 1 - np.minimum(best, 1) - SLACK, -SLACK)
