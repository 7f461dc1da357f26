"""Robust locally weighted regression (Cleveland 1979) over points that are merged by x.

Weights depend on x only, so points with one x are one level with sums of their robust weights,
and all columns of y share the work. Levels that lie whole on one side of a fit point and inside
its neighbourhood enter by moments: the tricube weight of a distance is a polynomial of degree 9,
so the weighted sums of such levels follow from the sums of their powers. Moments are taken about
the middle of a node and scaled to its width, which keeps the expansion well conditioned, and
moments of neighbouring nodes can be merged. Only levels at the edges of the neighbourhoods and
around the fit points are weighed one by one.
"""

from dataclasses import dataclass
from math import comb

import numpy as np

#: Fit points that share one split of the levels, and levels of one node.
STEP = 128
#: Powers of a node: degree 9 of the weight and 2 of the regression.
POWERS = 12
#: Residuals up to this share of the largest one are rounding errors of an exact fit and count as 0.
NOISE = 1e-9
#: A neighbourhood with less weight than this has none: what is left are distances rounded at its edge.
NO_WEIGHT = 1e-12
#: (1 - u^3)^3 by powers of u.
TRICUBE = {0: 1.0, 3: -3.0, 6: 3.0, 9: -1.0}
_CHOOSE = np.array([[comb(p, i) for i in range(POWERS)] for p in range(POWERS)], float)


@dataclass
class Node:
    """Sums of r t^p and r y t^p over some levels, t = (x - middle) / half, for each column."""
    middle: float
    half: float
    r: np.ndarray  # POWERS x columns
    ry: np.ndarray


def node(x: np.ndarray, r: np.ndarray, ry: np.ndarray) -> Node:
    middle = (x[0] + x[-1]) / 2
    half = (x[-1] - x[0]) / 2
    powers = ((x - middle) / (half or 1.0))[:, None] ** np.arange(POWERS)
    return Node(middle, half, powers.T @ r, powers.T @ ry)


def merged(nodes: list[Node]) -> Node | None:
    """One node of all the levels of `nodes`."""
    if len(nodes) < 2:
        return nodes[0] if nodes else None
    low = min(n.middle - n.half for n in nodes)
    high = max(n.middle + n.half for n in nodes)
    middle, half = (low + high) / 2, (high - low) / 2
    shift = np.array([(n.middle - middle) / (half or 1.0) for n in nodes])
    scale = np.array([n.half / (half or 1.0) for n in nodes])
    p, i = np.indices((POWERS, POWERS))
    move = _CHOOSE * shift[:, None, None] ** np.maximum(p - i, 0) * scale[:, None, None] ** i
    return Node(middle, half, np.einsum("npi,nic->pc", move, np.array([n.r for n in nodes])),
                np.einsum("npi,nic->pc", move, np.array([n.ry for n in nodes])))


def _far_sums(fit_x, radius, centre, far: Node, side: int):
    """Weighted sums of a node that lies on one side (-1: below) of all fit points, inside their radius."""
    a = side * (far.middle - fit_x) / radius
    b = side * far.half / radius
    weight = np.zeros((len(fit_x), POWERS - 2))
    for e, sign in TRICUBE.items():
        for p in range(e + 1):
            weight[:, p] += sign * comb(e, p) * a ** (e - p) * b ** p
    gap, half, n = far.middle - centre, far.half, POWERS - 2
    r, ry = far.r, far.ry
    return [weight @ r[:n], weight @ (gap * r[:n] + half * r[1: n + 1]),
            weight @ (gap * gap * r[:n] + 2 * gap * half * r[1: n + 1] + half * half * r[2:]),
            weight @ ry[:n], weight @ (gap * ry[:n] + half * ry[1: n + 1])]


def _near_sums(fit_x, radius, centre, x, r, ry):
    """The same for levels that are weighed one by one."""
    d = np.abs(x - fit_x[:, None])
    d /= radius[:, None]
    np.minimum(d, 1.0, out=d)
    w = d * d * d
    np.subtract(1.0, w, out=w)
    w *= w * w
    z = (x - centre)[:, None]
    sums = w @ np.hstack([r, r * z, r * z * z, ry, ry * z])
    return np.hsplit(sums, 5)


def window_radius(fit_x, x, before, n: int, k: int, low: int, high: int) -> np.ndarray:
    """Distance of the k-th nearest of n points from each fit point.

    The neighbours are the points of rank l to l + k - 1, where l is the first rank between `low`
    and `high` with (x of rank l + x of rank l + k) / 2 >= fit_x, or n - k. Level i holds the ranks
    from before[i] on; levels of other ranks than these may be missing.
    """
    def at(rank):
        return x[np.maximum(np.searchsorted(before, rank, "right") - 1, 0)]

    low, high = np.full(len(fit_x), low), np.full(len(fit_x), min(high, n - k))
    while (low < high).any():
        middle = (low + high) // 2
        far = (middle >= n - k) | ((at(middle) + at(np.minimum(middle + k, n - 1))) / 2.0 >= fit_x)
        open_ = low < high
        high = np.where(open_ & far, middle, high)
        low = np.where(open_ & ~far, middle + 1, low)
    return np.maximum(fit_x - at(low), at(low + k - 1) - fit_x)


def fitted(fit_x, radius, x, r, ry, y, below: Node | None = None, above: Node | None = None) -> np.ndarray:
    """Local lines at the sorted `fit_x`, one column per column of `r`.

    x (sorted), r and ry are levels with the sums of robust weights and of weighted y; `below` and
    `above` stand for further levels on either side that lie inside the radius of every fit point.
    A fit point whose neighbours all have weight 0 gets `y`, the mean of its own level.
    """
    out = np.empty((len(fit_x), r.shape[1]))
    nodes = [node(x[a: a + STEP], r[a: a + STEP], ry[a: a + STEP]) for a in range(0, len(x) - STEP + 1, STEP)]
    for a in range(0, len(fit_x), STEP):
        part = slice(a, min(a + STEP, len(fit_x)))
        f, h = fit_x[part], radius[part]
        centre = (f[0] + f[-1]) / 2
        # Without a radius only the level itself counts.
        safe = np.where(h > 0, h, np.finfo(float).tiny)
        left, right = f - h, f + h
        begin, inside = np.searchsorted(x, left.min(), "left"), np.searchsorted(x, left.max(), "left")
        own, past = np.searchsorted(x, f[0], "left"), np.searchsorted(x, f[-1], "right")
        covered, end = np.searchsorted(x, right.min(), "right"), np.searchsorted(x, right.max(), "right")
        lower = range(-(-inside // STEP), own // STEP)
        upper = range(-(-past // STEP), min(covered // STEP, len(nodes)))
        rows, at = [], begin
        for some in (lower, upper):
            if len(some):
                rows.append(slice(at, some[0] * STEP))
                at = (some[-1] + 1) * STEP
        rows.append(slice(at, end))
        near = [np.concatenate([c[s] for s in rows]) for c in (x, r, ry)]
        sums = _near_sums(f, safe, centre, *near)
        for side, some, far in ((-1, lower, below), (1, upper, above)):
            whole = merged([nodes[i] for i in some] + ([far] if far is not None else []))
            if whole is not None:
                for total, more in zip(sums, _far_sums(f, safe, centre, whole, side)):
                    total += more
        s0, s1, s2, t0, t1 = sums
        ok = s0 > NO_WEIGHT
        s0 = np.where(ok, s0, 1.0)
        mean_x, mean_y = s1 / s0, t0 / s0
        spread = np.maximum(s2 / s0 - mean_x * mean_x, 1e-12)
        slope = (t1 / s0 - mean_x * mean_y) / spread
        line = mean_y + ((f - centre)[:, None] - mean_x) * slope
        out[part] = np.where(ok, line, y[part])
    return out


def block_ranks(first, last, start, n: int, k: int):
    """Bounds of the left neighbour rank for the fit points of each block of levels.

    Blocks are in the order of x; `first` and `last` are their smallest and largest x and `start`
    is the rank of their first point. The rank of the left end of a neighbourhood grows with x, so
    x at the starts of blocks bounds it from both sides.
    """
    # At the start of a block x is known; k ranks further it lies between the ends of a block.
    ahead = np.maximum(np.searchsorted(start, np.minimum(start + k, n - 1), "right") - 1, 0)
    open_ = start + k < n
    most = np.where(open_, (first + last[ahead]) / 2, np.inf)
    least = np.where(open_, (first + first[ahead]) / 2, np.inf)
    low = np.searchsorted(most, first, "left") - 1  # the last start whose middle is surely smaller
    high = np.searchsorted(least, last, "left")  # the first one whose middle is surely reached
    starts = np.append(start, n - k)
    return np.where(low >= 0, starts[low], 0), np.minimum(starts[np.minimum(high, len(start))], n - k)


def block_plan(first, last, start, n: int, frac: float):
    """Which blocks the fit points of each block need: rows (fit, block, side, low, high).

    side 0: its levels one by one; -1 and 1: its moments, since it lies whole inside every
    neighbourhood, below or above the fit points. low and high bound the left neighbour rank.
    """
    k = neighbours(n, frac)
    low, high = block_ranks(first, last, start, n, k)

    def block_of(rank):
        return np.searchsorted(start, rank, "right") - 1

    own = np.arange(len(start))
    a, b = block_of(low), block_of(high)
    c, d = block_of(low + k - 1), block_of(np.minimum(high + k, n - 1))
    rows = []
    for i in own.tolist():
        needed = {*range(a[i], b[i] + 1), *range(c[i], d[i] + 1), i}
        for j in range(min(a[i], i), max(d[i], i) + 1):
            rows.append((i, j, 0 if j in needed else -1 if j < i else 1, low[i], high[i]))
    return np.array(rows, np.int64).reshape(-1, 5)


def neighbours(n: int, frac: float) -> int:
    return max(min(int(frac * n + 1e-10), n), 1)


def lowess(x, y, frac=0.30, iterations=3):
    """Fitted values at the sorted distinct x, one column per column of y.

    Returns (distinct x, fits). `iterations` counts the robustifying passes.
    """
    x = np.asarray(x, dtype=float)
    y = np.asarray(y, dtype=float).reshape(len(x), -1)
    levels, where, size = np.unique(x, return_inverse=True, return_counts=True)
    before = np.cumsum(size) - size
    k = neighbours(len(x), frac)
    radius = window_radius(levels, levels, before, len(x), k, 0, len(x) - k)

    order = np.argsort(where, kind="stable")

    def sums(values):
        return np.add.reduceat(values[order], before, axis=0)

    robust, mean = np.ones_like(y), sums(y) / size[:, None]
    for step in range(iterations + 1):
        fits = fitted(levels, radius, levels, sums(robust), sums(robust * y), mean)
        if step < iterations:
            residual = np.abs(y - fits[where])
            residual[residual <= NOISE * residual.max(axis=0)] = 0.0
            robust = bisquare(residual, np.median(residual, axis=0))
    return levels, fits


def bisquare(residual, middle):
    """Robust weights of absolute residuals with their median."""
    scale = 6.0 * middle
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.where(scale > 0, residual / scale, np.where(residual > 0, 1.0, 0.0))
    u[u >= 0.999] = 1.0
    u[u <= 0.001] = 0.0
    return (1.0 - u * u) ** 2


def corrected(y, gc, frac=0.30, grid=None):
    """y - fit(gc) + median(y) per column; without a usable gc spread the fit is the median.

    `grid` rounds gc for the fit and interpolates between grid points: an approximation.
    """
    y = np.asarray(y, dtype=float).reshape(len(gc), -1)
    gc = np.asarray(gc, dtype=float)
    middle = np.nanmedian(y, axis=0)
    if len(gc) < 5 or gc.min() == gc.max():
        fit = np.broadcast_to(middle, y.shape)
    else:
        x = np.round(gc / grid) * grid if grid else gc
        fit_x, fits = lowess(x, y, frac)
        fit = np.column_stack([np.interp(gc, fit_x, fits[:, c]) for c in range(y.shape[1])])
    return y - fit + middle
