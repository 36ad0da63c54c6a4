"""Plane geometry in numpy: areas of unions, containment, distances. A ring is an (n, 2) array of x, y in metres; holes are
not known, a ring that crosses itself is filled by the even-odd rule."""

from __future__ import annotations

import numpy as np

SIDES = 256


def ring(points) -> np.ndarray:
    """Without the repeated last point; an empty array for fewer than three points or no area."""
    p = np.asarray(points, float).reshape(-1, 2)
    if len(p) > 1 and np.allclose(p[0], p[-1]):
        p = p[:-1]
    return p if len(p) >= 3 and abs(signed_area(p)) > 1e-9 else np.zeros((0, 2))


def signed_area(p: np.ndarray) -> float:
    x, y = p[:, 0], p[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


def circle(radius: float, sides: int = SIDES) -> np.ndarray:
    t = np.arange(sides) * (2 * np.pi / sides)
    return np.column_stack([radius * np.cos(t), radius * np.sin(t)])


def _edges(rings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    e = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
    owner = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    flip = e[:, 0] > e[:, 2]
    e[flip] = e[flip][:, [2, 3, 0, 1]]
    return e, owner


def _crossings(e: np.ndarray) -> np.ndarray:
    """x of all places where two edges cross."""
    a, d = e[:, :2], e[:, 2:] - e[:, :2]
    det = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    gap = a[None] - a[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / det
        u = (gap[..., 0] * d[:, None, 1] - gap[..., 1] * d[:, None, 0]) / det
    i, j = np.nonzero((np.abs(det) > 1e-12) & (t > 0) & (t < 1) & (u > 0) & (u < 1))
    return a[i, 0] + t[i, j] * d[i, 0]


def union_area(rings: list[np.ndarray], inside: np.ndarray | None = None) -> float:
    """Area that any of the rings covers, only within the convex ring `inside` where that is given. The plane is cut into
    upright slabs at all corners and crossings; in a slab no edges cross, so its covered parts are trapezoids."""
    rings = [r for r in rings if len(r)]
    if not rings:
        return 0.0
    low, high = np.min([r.min(axis=0) for r in rings], axis=0), np.max([r.max(axis=0) for r in rings], axis=0)
    if inside is not None and all(contains(inside, c) for c in ((low[0], low[1]), (low[0], high[1]), (high[0], low[1]), (high[0], high[1]))):
        inside = None
    e, owner = _edges(rings if inside is None else [*rings, inside])
    near = (e[:, 2] >= low[0]) & (e[:, 0] <= high[0])
    e, owner = e[near], owner[near]
    xs = np.unique(np.concatenate([e[:, 0], e[:, 2], _crossings(e)]))
    xs = xs[(xs >= low[0]) & (xs <= high[0])]
    width, mid = np.diff(xs), (xs[:-1] + xs[1:]) / 2
    mid, width = mid[width > 1e-9], width[width > 1e-9]
    total = 0.0
    for a in range(0, len(mid), 256):
        m, w = mid[a : a + 256, None], width[a : a + 256]
        live = (e[:, 0] <= m) & (e[:, 2] > m)
        with np.errstate(divide="ignore", invalid="ignore"):
            y = np.where(live, e[:, 1] + (e[:, 3] - e[:, 1]) * (m - e[:, 0]) / (e[:, 2] - e[:, 0]), np.inf)
        order = np.argsort(y, axis=1, kind="stable")
        y = np.take_along_axis(y, order, axis=1)
        who = np.where(np.isfinite(y), owner[order], -1)
        odd = lambda k: np.cumsum(who == k, axis=1) % 2 == 1
        covered = np.zeros(who.shape, bool)
        for k in range(len(rings)):
            covered |= odd(k)
        if inside is not None:
            covered &= odd(len(rings))
        step = np.diff(np.where(np.isfinite(y), y, 0.0), axis=1)
        total += float(((step * (covered[:, :-1] & np.isfinite(y[:, 1:]))).sum(axis=1) * w).sum())
    return total


def trapezoids(rings: list[np.ndarray], low, high) -> np.ndarray:
    """What any of the rings covers of a box, as trapezoids that do not overlap: rows x0, x1, lower y at both, upper y at both.
    Slabs as in union_area; in each, what is covered without a gap is one trapezoid."""
    box = np.array([(low[0], low[1]), (high[0], low[1]), (high[0], high[1]), (low[0], high[1])])
    e, owner = _edges([*rings, box])
    near = (e[:, 2] >= low[0]) & (e[:, 0] <= high[0])
    e, owner = e[near], owner[near]
    xs = np.unique(np.concatenate([e[:, 0], e[:, 2], _crossings(e)]))
    xs = xs[(xs >= low[0]) & (xs <= high[0])]
    x0, x1 = xs[:-1], xs[1:]
    out = []
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    for a in range(0, len(x0), 256):
        first, last = x0[a : a + 256, None], x1[a : a + 256, None]
        m = (first + last) / 2
        live = (e[:, 0] <= m) & (e[:, 2] > m)
        with np.errstate(invalid="ignore"):
            y = np.where(live, e[:, 1] + slope * (m - e[:, 0]), np.inf)
        order = np.argsort(y, axis=1, kind="stable")
        y = np.take_along_axis(y, order, axis=1)
        who = np.where(np.isfinite(y), owner[order], -1)
        covered = np.zeros(who.shape, bool)
        for k in range(len(rings)):
            covered |= np.cumsum(who == k, axis=1) % 2 == 1
        covered &= np.cumsum(who == len(rings), axis=1) % 2 == 1
        before = np.hstack([np.zeros((len(covered), 1), bool), covered[:, :-1]])
        row, start = np.nonzero(covered & ~before)
        _, end = np.nonzero(~covered & before)  # the box's own top ends what is covered at the latest
        at = lambda edge, x: e[edge, 1] + slope[edge] * (x - e[edge, 0])
        under, over, left, right = order[row, start], order[row, end], first[row, 0], last[row, 0]
        out.append(np.column_stack([left, right, at(under, left), at(under, right), at(over, left), at(over, right)]))
    return np.concatenate(out) if out else np.zeros((0, 6))


def covered(rings: list[np.ndarray], low, high, most: int, depth: int = 8) -> np.ndarray:
    """As trapezoids, where a box with more than `most` rings is cut into four unless one of them fills it."""
    corners = [(low[0], low[1]), (low[0], high[1]), (high[0], low[1]), (high[0], high[1])]
    met = []
    for r in rings:
        if (r.max(axis=0) <= low).any() or (r.min(axis=0) >= high).any():
            continue
        if len(r) == 4 and (r.min(axis=0) <= low).all() and (r.max(axis=0) >= high).all() and fills(r, corners):
            return np.array([[low[0], high[0], low[1], low[1], high[1], high[1]]])
        met.append(r)
    if not met:
        return np.zeros((0, 6))
    if len(met) <= most or not depth:
        return trapezoids(met, low, high)
    mid = (np.asarray(low) + high) / 2
    boxes = [((x0, y0), (x1, y1)) for x0, x1 in ((low[0], mid[0]), (mid[0], high[0])) for y0, y1 in ((low[1], mid[1]), (mid[1], high[1]))]
    return np.concatenate([covered(met, np.array(a), np.array(b), most, depth - 1) for a, b in boxes])


def convex(r: np.ndarray) -> bool:
    """Does a ring turn one way only, and once round."""
    d = np.roll(r, -1, axis=0) - r
    after = np.roll(d, -1, axis=0)
    turn = np.arctan2(d[:, 0] * after[:, 1] - d[:, 1] * after[:, 0], (d * after).sum(axis=1))
    return bool(((turn >= 0).all() or (turn <= 0).all()) and abs(abs(turn.sum()) - 2 * np.pi) < 1e-6)


def fills(r: np.ndarray, points) -> bool:
    """Is a ring convex, and are all points in it or on its border."""
    p, d = np.asarray(points, float), np.roll(r, -1, axis=0) - r
    side = d[:, 0] * (p[:, None, 1] - r[:, 1]) - d[:, 1] * (p[:, None, 0] - r[:, 0])
    return bool(((side >= 0).all() or (side <= 0).all()) and convex(r))


def quads_in_circle(x: np.ndarray, y: np.ndarray, radius: float, sides: int = SIDES) -> np.ndarray:
    """Areas of many shapes of four corners (n, 4), counter-clockwise, inside circle(radius)."""
    x2, y2 = np.roll(x, -1, axis=1), np.roll(y, -1, axis=1)
    out = (x * y2 - x2 * y) / 2
    at = np.nonzero(np.maximum(x * x + y * y, x2 * x2 + y2 * y2) > (radius * np.cos(np.pi / sides)) ** 2)
    edges = [c[at] for c in (x, y, x2, y2)]
    if len(at[0]):
        out[at] = np.concatenate([_inside_circle(*(c[k : k + 8192] for c in edges), radius, sides) for k in range(0, len(at[0]), 8192)])
    return out.sum(axis=1)


class Ragged:
    """Many rings at once: corners x, y in metres, ring after ring, and how many each has. Those that ring() makes empty are
    left out; `which` tells the others' numbers."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray):
        n, rows = n.astype(np.int64), np.arange(len(n))
        first = np.cumsum(n) - n
        some = n > 1
        last = first[some] + n[some] - 1
        same = np.isclose(x[first[some]], x[last]) & np.isclose(y[first[some]], y[last])
        kept = np.ones(len(x), bool)
        kept[last[same]] = False
        n[rows[some][same]] -= 1
        self._take(x[kept], y[kept], n, rows)
        fit = np.zeros(len(n), bool)
        if len(self.which):
            fit[self.which] = np.abs(self._sum(self.cross) / 2) > 1e-9
        self._take(x[kept], y[kept], n, rows[fit])

    def _take(self, x, y, n, which):
        which = which[n[which] >= 3]
        at = np.zeros(len(n), bool)
        at[which] = True
        corners = np.repeat(at, n)
        self.which, self.n, self.x, self.y = which, n[which], x[corners], y[corners]
        self.first = np.cumsum(self.n) - self.n
        after = np.arange(1, len(self.x) + 1)
        after[self.first + self.n - 1] = self.first
        self.x2, self.y2 = self.x[after], self.y[after]
        self.cross = self.x * self.y2 - self.x2 * self.y

    def _sum(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else np.zeros(0)

    def distances(self) -> np.ndarray:
        """As distance() from the origin."""
        if not len(self.first):
            return np.zeros(0)
        x, y, dx, dy = self.x, self.y, self.x2 - self.x, self.y2 - self.y
        with np.errstate(divide="ignore", invalid="ignore"):
            east = ((y > 0) != (self.y2 > 0)) & (x - y * dx / dy > 0)
        t = np.clip(-(x * dx + y * dy) / np.maximum(dx * dx + dy * dy, 1e-18), 0, 1)
        d = np.sqrt(np.minimum.reduceat((x + t * dx) ** 2 + (y + t * dy) ** 2, self.first))
        return np.where(self._sum(east.astype(np.int64)) % 2 == 1, 0.0, d)

    def areas_in_circle(self, radius: float, sides: int = SIDES) -> np.ndarray:
        """As union_area([ring], circle(radius)) for rings that do not cross themselves: each edge adds what lies between it
        and the origin inside the circle's polygon."""
        out = self.cross / 2
        beyond = np.maximum(self.x**2 + self.y**2, self.x2**2 + self.y2**2) > (radius * np.cos(np.pi / sides)) ** 2
        at = np.flatnonzero(beyond)
        for some in np.array_split(at, 1 + len(at) // 8192):
            out[some] = _inside_circle(self.x[some], self.y[some], self.x2[some], self.y2[some], radius, sides)
        return np.abs(self._sum(out))


def _sides_met(x, y, dx, dy, radius: float, sides: int) -> np.ndarray:
    """The sides of circle(radius, sides) that edges can cross: a line enters and leaves the polygon half a side at most from
    where it does the circle."""
    length = np.sqrt(np.maximum(dx * dx + dy * dy, 1e-300))
    ux, uy = dx / length, dy / length
    along, off = -(x * ux + y * uy), x * uy - y * ux  # up to the place nearest to the middle, and how far that is
    half = np.sqrt(np.maximum(radius * radius - off * off, 0))
    at = along[:, None] + np.stack([-half, half], axis=1)
    angle = np.arctan2(y[:, None] + at * uy[:, None], x[:, None] + at * ux[:, None])
    k = np.floor(angle * (sides / (2 * np.pi))).astype(np.int64)
    return ((k[:, :, None] + np.arange(-2, 3)) % sides).reshape(len(x), -1)


def _inside_circle(x, y, x2, y2, radius: float, sides: int) -> np.ndarray:
    """Signed area between edges and the origin inside the polygon circle(radius, sides)."""
    step = 2 * np.pi / sides
    middle = (np.arange(sides) + 0.5) * step
    c, s, limit = np.cos(middle), np.sin(middle), radius * np.cos(step / 2)
    dx, dy = x2 - x, y2 - y
    nearest = np.clip(-(x * dx + y * dy) / np.maximum(dx * dx + dy * dy, 1e-18), 0, 1)
    meets = np.flatnonzero(np.hypot(x + nearest * dx, y + nearest * dy) < radius)
    t0, t1 = np.ones(len(x)), np.ones(len(x))
    if len(meets):
        side = _sides_met(x[meets], y[meets], dx[meets], dy[meets], radius, sides)
        c, s = c[side], s[side]
        room = limit - (x[meets, None] * c + y[meets, None] * s)  # to each side: negative beyond it
        speed = dx[meets, None] * c + dy[meets, None] * s
        with np.errstate(divide="ignore", invalid="ignore"):
            t = room / speed
        enter = np.where(speed < 0, t, np.where((speed == 0) & (room < 0), np.inf, -np.inf)).max(axis=1)
        leave = np.where(speed > 0, t, np.inf).min(axis=1)
        t0[meets] = np.clip(enter, 0, 1)
        t1[meets] = np.maximum(np.clip(leave, 0, 1), t0[meets])
    whole = sides * radius**2 * np.sin(step) / 2

    def swept(t):
        """Area of the polygon up to the direction of a place on the edge."""
        a = np.arctan2(y + t * dy, x + t * dx) % (2 * np.pi)
        k = np.minimum(np.floor(a / step), sides - 1)
        part = a - k * step
        return k * whole / sides + radius * limit / np.cos(part - step / 2) * np.sin(part) / 2

    def between(p, q):
        d = swept(q) - swept(p)
        return np.where(p == q, 0.0, d - whole * np.round(d / whole))

    zero, one = np.zeros(len(x)), np.ones(len(x))
    inside = ((x + t0 * dx) * (y + t1 * dy) - (x + t1 * dx) * (y + t0 * dy)) / 2
    return between(zero, t0) + inside + between(t1, one)


def boxes_in_circle(x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray, radius: float, sides: int = SIDES) -> np.ndarray:
    """Areas of upright boxes inside circle(radius), whose sides must be a multiple of eight: the polygon then looks the same
    from the north and from the east, and its height at x is its width at y."""
    quarter, step = sides // 4, 2 * np.pi / sides
    t = np.arange(quarter + 1) * step
    c, s = radius * np.cos(t), radius * np.sin(t)  # corners from the east to the north
    c[-1] = 0.0
    slope = np.diff(s) / -np.diff(c)
    under = np.append(np.cumsum((-np.diff(c) * (s[1:] + s[:-1]) / 2)[::-1])[::-1], 0.0)  # up to each corner, from the middle

    def edge(v):
        """How far from the middle, at most the radius; the polygon's height there; the area below it up to there; and the
        same area up to the height."""
        v = np.minimum(np.abs(v), radius)
        k = np.minimum((np.arccos(v / radius) / step).astype(np.int64), quarter - 1)
        high = np.maximum(s[k] + slope[k] * (c[k] - v), 0.0)
        other = quarter - 1 - k
        return v, high, under[k] - (c[k] - v) * (s[k] + high) / 2, under[other] - (c[other] - high) * (s[other] + v) / 2

    def corner(x, y, east, north):
        """From the middle to a corner, counted negative where one side is."""
        (u, _, area, _), (v, wide, _, known) = east, north
        part = np.where(u <= wide, u * v, wide * v + area - known)
        return np.where((x < 0) != (y < 0), -part, part)

    west, east, south, north = edge(x0), edge(x1), edge(y0), edge(y1)
    return np.maximum(corner(x1, y1, east, north) - corner(x0, y1, west, north) - corner(x1, y0, east, south) + corner(x0, y0, west, south), 0.0)


def simple(r: np.ndarray) -> bool:
    """Does a ring enclose once what it encloses: no edges cross, and the even-odd rule leaves nothing out."""
    if len(r) < 3:
        return True
    r = r - r.mean(axis=0)
    return not len(_crossings(_edges([r])[0])) and abs(union_area([r]) - abs(signed_area(r))) <= 1e-9 * abs(signed_area(r)) + 1e-9


def clip_box(convex: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The part of a convex ring inside a box; empty if they share no area."""
    for axis in (0, 1):
        for sign, limit in ((1, high[axis]), (-1, -low[axis])):
            if not len(convex):
                return convex
            over = sign * convex[:, axis] - limit
            after = np.roll(convex, -1, axis=0)
            next_over = np.roll(over, -1)
            with np.errstate(divide="ignore", invalid="ignore"):
                cut = convex + (after - convex) * (over / (over - next_over))[:, None]
            keep, crosses = over <= 0, (over > 0) != (next_over > 0)
            both = np.stack([convex, cut], axis=1).reshape(-1, 2)
            convex = both[np.stack([keep, crosses], axis=1).ravel()]
    return ring(convex)


def noded(p: np.ndarray, grid: float = 1e-6) -> np.ndarray:
    """The edges (n, 2, 2) of a ring cut wherever they meet one another, corners rounded to the grid; an edge that is run
    through an even number of times bounds nothing and is left out."""
    p = np.round(p / grid) * grid
    p = p[np.any(p != np.roll(p, 1, axis=0), axis=1)]
    if len(p) < 3:
        return np.zeros((0, 2, 2))
    a, d = p, np.roll(p, -1, axis=0) - p
    length = np.hypot(d[:, 0], d[:, 1])
    pieces = []
    for i in range(len(p)):
        gap, det = a - a[i], d[i, 0] * d[:, 1] - d[i, 1] * d[:, 0]
        off = gap[:, 0] * d[i, 1] - gap[:, 1] * d[i, 0]  # twice the area between edge i and a corner: 0 on its line
        flat = np.abs(det) <= 1e-12 * length[i] * length
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[:, 0] * d[:, 1] - gap[:, 1] * d[:, 0]) / det
            u = off / det
        slack = grid / length
        meets = ~flat & (t >= -slack[i]) & (t <= 1 + slack[i]) & (u >= -slack) & (u <= 1 + slack)
        along = (gap @ d[i]) / length[i] ** 2
        on_line = np.abs(off) <= grid * length[i]  # corners on the edge's line cut it too
        cuts = np.concatenate([[0.0, 1.0], t[meets], along[on_line]])
        cuts = np.unique(np.clip(cuts, 0, 1))
        corners = np.round((a[i] + cuts[:, None] * d[i]) / grid).astype(np.int64)
        pieces.append(np.stack([corners[:-1], corners[1:]], axis=1)[np.any(corners[:-1] != corners[1:], axis=1)])
    edges = np.concatenate(pieces)
    swap = (edges[:, 0, 0] > edges[:, 1, 0]) | ((edges[:, 0, 0] == edges[:, 1, 0]) & (edges[:, 0, 1] > edges[:, 1, 1]))
    edges[swap] = edges[swap][:, ::-1]
    each, times = np.unique(edges.reshape(-1, 4), axis=0, return_counts=True)
    return each[times % 2 == 1].reshape(-1, 2, 2) * grid


def _directed(edges: np.ndarray) -> np.ndarray:
    """The edges with what they enclose (an odd number of them on the way out) at their left."""
    (x0, y0), (x1, y1) = edges[:, 0].T, edges[:, 1].T
    out = edges.copy()
    for i, (a, b) in enumerate(edges):
        mx, my = (a + b) / 2
        if a[1] != b[1]:  # count what lies west of the middle
            cross = (np.minimum(y0, y1) <= my) & (np.maximum(y0, y1) > my)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = x0 + (my - y0) * (x1 - x0) / (y1 - y0)
            cross[i] = False
            inside = np.count_nonzero(cross & (at < mx)) % 2 == 1
            forward = (b[1] > a[1]) == inside
        else:  # count what lies south of it
            cross = (np.minimum(x0, x1) <= mx) & (np.maximum(x0, x1) > mx)
            with np.errstate(divide="ignore", invalid="ignore"):
                at = y0 + (mx - x0) * (y1 - y0) / (x1 - x0)
            cross[i] = False
            inside = np.count_nonzero(cross & (at < my)) % 2 == 1
            forward = (b[0] < a[0]) == inside
        if not forward:
            out[i] = out[i, ::-1]
    return out


def simple_rings(p, grid: float = 1e-6) -> list[np.ndarray]:
    """A ring that may cross or touch itself, have spikes or repeat corners, as rings that do not: what it fills by the
    even-odd rule. Outer rings run counter-clockwise, holes clockwise; parts that share a corner only are separate."""
    edges = _directed(noded(np.asarray(p, float).reshape(-1, 2), grid))
    leaving: dict[tuple[float, float], list[int]] = {}
    for i, (a, _) in enumerate(edges):
        leaving.setdefault(tuple(a), []).append(i)
    angle = np.arctan2(edges[:, 1, 1] - edges[:, 0, 1], edges[:, 1, 0] - edges[:, 0, 0])
    left, out = np.ones(len(edges), bool), []
    for first in range(len(edges)):
        path, at, now = [], {}, first
        while left[now]:
            left[now] = False
            start, end = tuple(edges[now, 0]), tuple(edges[now, 1])
            at[start] = len(path)
            path.append(now)
            if end in at:  # a loop closes: it is a ring, and what came before goes on
                loop, path = path[at[end] :], path[: at[end]]
                out.append(edges[loop, 0])
                at = {tuple(edges[e, 0]): k for k, e in enumerate(path)}
            ways = [e for e in leaving.get(end, []) if left[e]]
            if not ways:
                break
            # the sharpest turn to the left keeps to the same part
            now = min(ways, key=lambda e: (angle[now] + np.pi - angle[e]) % (2 * np.pi) or 2 * np.pi)
    return [r for r in out if abs(signed_area(r)) > 1e-9]


def contains(r: np.ndarray, point) -> bool:
    x, y = point
    a, b = r, np.roll(r, -1, axis=0)
    crosses = (a[:, 1] > y) != (b[:, 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool((crosses & (x < at)).sum() % 2)


def distance(r: np.ndarray, point=(0.0, 0.0)) -> float:
    """From a point to the filled ring; 0 inside."""
    if contains(r, point):
        return 0.0
    p, a = np.asarray(point, float), r
    d = np.roll(r, -1, axis=0) - a
    t = np.clip(((p - a) * d).sum(axis=1) / np.maximum((d * d).sum(axis=1), 1e-18), 0, 1)
    return float(np.sqrt((((a + t[:, None] * d) - p) ** 2).sum(axis=1)).min())


def joined(a: np.ndarray, b: np.ndarray) -> bool:
    """Do two rings overlap or share a stretch of border (a single common point does not join them)."""
    if (a.max(axis=0) < b.min(axis=0) - 1e-6).any() or (b.max(axis=0) < a.min(axis=0) - 1e-6).any():
        return False
    both = union_area([a, b])
    if both < union_area([a]) + union_area([b]) - 1e-6:
        return True
    return _shared_border(a, b) > 1e-6


def _shared_border(a: np.ndarray, b: np.ndarray) -> float:
    total = 0.0
    for p, q in zip(a, np.roll(a, -1, axis=0), strict=True):
        d = q - p
        n = np.hypot(*d)
        if n < 1e-9:
            continue
        u = d / n
        c, e = b - p, np.roll(b, -1, axis=0) - p
        off = np.maximum(np.abs(c[:, 0] * u[1] - c[:, 1] * u[0]), np.abs(e[:, 0] * u[1] - e[:, 1] * u[0]))
        s, t = c @ u, e @ u
        lap = np.minimum(np.maximum(s, t), n) - np.maximum(np.minimum(s, t), 0)
        total += float(lap[(off < 1e-6) & (lap > 0)].sum())
    return total


def groups(rings: list[np.ndarray]) -> list[list[int]]:
    """Indices of rings joined to one another, directly or through others; each group and all groups in order."""
    root = list(range(len(rings)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rings)):
        for j in range(i):
            if find(i) != find(j) and joined(rings[i], rings[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    out: dict[int, list[int]] = {}
    for i in range(len(rings)):
        out.setdefault(find(i), []).append(i)
    return list(out.values())


def point_inside(r: np.ndarray) -> tuple[float, float]:
    """A point inside the ring: the middle of the widest stretch of a line across it."""
    ys = np.unique(r[:, 1])
    y = (ys[len(ys) // 2 - 1] + ys[len(ys) // 2]) / 2 if len(ys) > 1 else float(ys[0])
    a, b = r, np.roll(r, -1, axis=0)
    k = (a[:, 1] > y) != (b[:, 1] > y)
    xs = np.sort(a[k, 0] + (y - a[k, 1]) * (b[k, 0] - a[k, 0]) / (b[k, 1] - a[k, 1]))
    if len(xs) < 2:
        return float(r[0, 0]), float(r[0, 1])
    widths = xs[1::2] - xs[::2][: len(xs[1::2])]
    w = int(np.argmax(widths))
    return float((xs[2 * w] + xs[2 * w + 1]) / 2), float(y)


def stitch(lines: list[np.ndarray]) -> list[np.ndarray]:
    """Closed rings from pieces that meet end to end, in either direction."""
    left, out = [np.asarray(x, float) for x in lines if len(x) >= 2], []
    while left:
        now, moved = left.pop(0), True
        while moved and not np.allclose(now[0], now[-1]):
            moved = False
            for i, x in enumerate(left):
                if np.allclose(now[-1], x[0]) or np.allclose(now[-1], x[-1]):
                    now = np.vstack([now, (x if np.allclose(now[-1], x[0]) else x[::-1])[1:]])
                    left.pop(i)
                    moved = True
                    break
        if np.allclose(now[0], now[-1]) and len(r := ring(now)):
            out.append(r)
    return out
