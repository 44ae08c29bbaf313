"""Cells that cover a polygon: whole cells inside it, and cells on its edge with the edges that touch them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Each level's cells are so many times narrower than those of the level before.
FAN = 8
#: Where in a cell its reference point lies: off all round numbers, so that no vertex is level with it.
SPOT_X, SPOT_Y = 0.5130712, 0.4869341
#: A polygon begins with the cells of which it spans so many at most.
SPAN = 4


def edges_of(rings: list[list[tuple[float, float]]]) -> np.ndarray:
    """Rows (x1, y1, x2, y2) of all rings, closed."""
    out = []
    for ring in rings:
        if ring:
            xy = np.array([(p["x"], p["y"]) for p in ring], float)
            out.append(np.hstack([xy, np.roll(xy, -1, axis=0)]))
    return np.concatenate(out) if out else np.empty((0, 4))


def start_level(edges: np.ndarray, cell: float, finest: int) -> int:
    """The finest level at which the polygon spans SPAN cells at most; level 0 has cells of width ``cell``."""
    width = max(np.ptp(edges[:, [0, 2]]), np.ptp(edges[:, [1, 3]]), 1e-12)
    return int(min(finest, np.floor(np.log(SPAN * cell / width) / np.log(FAN))))


def inside(edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd rule for each point: an odd number of edges lies to the right."""
    x1, y1, x2, y2 = edges.T[:, None, :]
    y = y[:, None]
    crossed = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((crossed & (x[:, None] < x1 + (x2 - x1) * (y - y1) / (y2 - y1))).sum(axis=1) % 2).astype(bool)


def touching(edges: np.ndarray, x0: float, y0: float, size: float, nx: int, ny: int) -> list[np.ndarray]:
    """For each of nx * ny cells from (x0, y0), row by row: which edges touch it, a hair's breadth included."""
    out: list[list[np.ndarray]] = [[] for _ in range(nx * ny)]
    hair = 1e-9 * size
    low_x, high_x = np.minimum(edges[:, 0], edges[:, 2]) - hair, np.maximum(edges[:, 0], edges[:, 2]) + hair
    low_y, high_y = np.minimum(edges[:, 1], edges[:, 3]) - hair, np.maximum(edges[:, 1], edges[:, 3]) + hair
    dx, dy = edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]
    for j in range(ny):
        b = y0 + j * size
        row = np.flatnonzero((high_y >= b) & (low_y <= b + size))
        for i in range(nx):
            a = x0 + i * size
            near = row[(high_x[row] >= a) & (low_x[row] <= a + size)]
            # Corners on both sides of the edge's line, or on it.
            mid = dx[near] * (b + size / 2 - edges[near, 1]) - dy[near] * (a + size / 2 - edges[near, 0])
            out[j * nx + i] = near[np.abs(mid) <= (np.abs(dx[near]) + np.abs(dy[near])) * (size / 2 + hair)]
    return out


def split(edges: np.ndarray, level: int, cx: int, cy: int, odd: bool, cell: float) -> Iterator[tuple[int, int, int, bool, np.ndarray]]:
    """The cells of the next level within a cell: level, cx, cy, whether the reference point is inside, touching edges. Cells outside are left out.

    A child's reference point is reached from the cell's own by a way up and a way across within the cell, so the cell's
    edges tell how often the border is crossed.
    """
    size = cell / float(FAN) ** level
    small = size / FAN
    x0, y0 = cx * size, cy * size
    rx, ry = x0 + SPOT_X * size, y0 + SPOT_Y * size
    px = x0 + (np.arange(FAN) + SPOT_X) * small
    py = y0 + (np.arange(FAN) + SPOT_Y) * small
    x1, y1, x2, y2 = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        across = y1 + (y2 - y1) * (rx - x1) / (x2 - x1)
        up = ((x1 > rx) != (x2 > rx)) & ((across[None, :] > ry) != (across[None, :] > py[:, None]))
        level_x = x1 + (x2 - x1) * (py[:, None] - y1) / (y2 - y1)
    met = (y1 > py[:, None]) != (y2 > py[:, None])
    way = met[:, None, :] & ((rx < level_x)[:, None, :] != (px[None, :, None] < level_x[:, None, :]))
    odds = (int(odd) + up.sum(axis=1)[:, None] + way.sum(axis=2)) % 2 == 1
    near = touching(edges, x0, y0, small, FAN, FAN)
    for j in range(FAN):
        for i in range(FAN):
            some = near[j * FAN + i]
            if len(some) or odds[j, i]:
                yield level + 1, cx * FAN + i, cy * FAN + j, bool(odds[j, i]), edges[some]


def cover(edges: np.ndarray, cell: float, most: int, finest: int) -> Iterator[tuple[int, int, int, bool, np.ndarray]]:
    """The cells of a polygon, split until each has ``most`` edges at most or is of the finest level."""
    if not len(edges):
        return
    level = start_level(edges, cell, finest)
    size = cell / float(FAN) ** level
    low = np.floor(np.minimum(edges[:, :2], edges[:, 2:]).min(axis=0) / size).astype(int)
    high = np.floor(np.maximum(edges[:, :2], edges[:, 2:]).max(axis=0) / size).astype(int)
    nx, ny = (high - low + 1).tolist()
    near = touching(edges, low[0] * size, low[1] * size, size, nx, ny)
    i, j = (x.ravel() for x in np.meshgrid(low[0] + np.arange(nx), low[1] + np.arange(ny)))
    odds = inside(edges, (i + SPOT_X) * size, (j + SPOT_Y) * size)
    left = [(level, int(i[k]), int(j[k]), bool(odds[k]), edges[near[k]]) for k in range(nx * ny) if odds[k] or len(near[k])]
    while left:
        one = left.pop()
        if len(one[4]) > most and one[0] < finest:
            left.extend(split(one[4], one[0], one[1], one[2], one[3], cell))
        else:
            yield one
