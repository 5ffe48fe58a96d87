"""Plain numpy geometry of one pair of polygons, which the tests hold the
edge relations of the library against.

Core idea: cut every edge of one polygon at its crossings with the other
polygon's boundary and classify each piece (inside, outside, on the other
boundary in the same or the opposite direction). Areas of intersections
and unions then follow from Green's theorem over the kept pieces, with no
polygon clipping library: ``area = ½ Σ cross(p0, p1)`` over the pieces.
"""

from __future__ import annotations

import numpy as np

OUT, IN, SAME, OPP = 0, 1, 2, 3
EPS = 1e-9


class Poly:
    """Edges of a (multi)polygon, shells CCW and holes CW, relative to an
    origin chosen by the caller (keeps cross products small)."""

    __slots__ = ("ax", "ay", "bx", "by", "rings", "_convex")

    def __init__(self, xs, ys, rs, rk, ox=0.0, oy=0.0):
        xs = np.asarray(xs, dtype=float) - ox
        ys = np.asarray(ys, dtype=float) - oy
        ax, ay, bx, by, rings = [], [], [], [], []
        start = 0
        for size, shell in zip(rs, rk):
            rx, ry = xs[start:start + size], ys[start:start + size]
            start += size
            if size < 4:
                continue
            a2 = np.sum(rx[:-1] * ry[1:] - rx[1:] * ry[:-1])
            if (a2 > 0) != bool(shell):
                rx, ry = rx[::-1], ry[::-1]
            rings.append((rx, ry))
            ax.append(rx[:-1]); ay.append(ry[:-1]); bx.append(rx[1:]); by.append(ry[1:])
        cat = lambda v: np.concatenate(v) if v else np.zeros(0)
        self.ax, self.ay, self.bx, self.by = cat(ax), cat(ay), cat(bx), cat(by)
        self.rings = rings
        self._convex = 0

    @property
    def n(self):
        return len(self.ax)

    def area(self):
        return 0.5 * float(np.sum(self.ax * self.by - self.bx * self.ay))


def contains_points(p: Poly, px, py):
    """Even-odd test; returns (inside, on_boundary) boolean arrays."""
    px = np.asarray(px, dtype=float)[:, None]
    py = np.asarray(py, dtype=float)[:, None]
    ax, ay, bx, by = p.ax[None, :], p.ay[None, :], p.bx[None, :], p.by[None, :]
    dx, dy = bx - ax, by - ay
    ln2 = dx * dx + dy * dy
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / np.where(ln2 > 0, ln2, 1), 0, 1)
    d2 = (ax + t * dx - px) ** 2 + (ay + t * dy - py) ** 2
    scale = max(1.0, float(np.max(np.abs(np.concatenate([p.ax, p.ay])))) if p.n else 1.0)
    on = np.any(d2 <= (EPS * scale) ** 2, axis=1)
    cond = (ay > py) != (by > py)
    xint = ax + (py - ay) * dx / np.where(dy != 0, dy, 1)
    crossing = cond & (px < xint)
    inside = (np.sum(crossing, axis=1) % 2 == 1) & ~on
    return inside, on


def pieces(p: Poly, q: Poly):
    """Cut p's edges at q's boundary. Returns (edge index, t0, t1, class)."""
    n, m = p.n, q.n
    if n == 0:
        return np.zeros(0, int), np.zeros(0), np.zeros(0), np.zeros(0, int)
    rx, ry = (p.bx - p.ax)[:, None], (p.by - p.ay)[:, None]
    sx, sy = (q.bx - q.ax)[None, :], (q.by - q.ay)[None, :]
    qpx, qpy = q.ax[None, :] - p.ax[:, None], q.ay[None, :] - p.ay[:, None]
    den = rx * sy - ry * sx
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (qpx * sy - qpy * sx) / den
        u = (qpx * ry - qpy * rx) / den
        ok = (den != 0) & (t > 0) & (t < 1) & (u >= -EPS) & (u <= 1 + EPS)
        tc = np.where(ok, t, np.nan)
        r2 = rx * rx + ry * ry
        col = (den == 0) & (np.abs(qpx * ry - qpy * rx) <= EPS * np.sqrt(r2) * (1 + np.abs(qpx) + np.abs(qpy)))
        tq0 = (qpx * rx + qpy * ry) / r2
        tq1 = ((q.bx[None, :] - p.ax[:, None]) * rx + (q.by[None, :] - p.ay[:, None]) * ry) / r2
    c0 = np.where(col & (tq0 > 0) & (tq0 < 1), tq0, np.nan)
    c1 = np.where(col & (tq1 > 0) & (tq1 < 1), tq1, np.nan)
    cuts = np.concatenate([np.zeros((n, 1)), tc, c0, c1, np.ones((n, 1))], axis=1)
    cuts = np.sort(cuts, axis=1)
    lo, hi = cuts[:, :-1], cuts[:, 1:]
    keep = np.isfinite(hi) & (hi - lo > 1e-12)
    ei = np.nonzero(keep)[0]
    t0, t1 = lo[keep], hi[keep]
    mt = 0.5 * (t0 + t1)
    mx = p.ax[ei] + mt * (p.bx - p.ax)[ei]
    my = p.ay[ei] + mt * (p.by - p.ay)[ei]
    inside, on = contains_points(q, mx, my)
    cls = np.where(inside, IN, OUT)
    if np.any(on):
        idx = np.nonzero(on)[0]
        # direction of the q edge the midpoint lies on
        dx, dy = sx[0], sy[0]
        ln2 = dx * dx + dy * dy
        px_, py_ = mx[idx][:, None], my[idx][:, None]
        tt = np.clip(((px_ - q.ax[None, :]) * dx + (py_ - q.ay[None, :]) * dy) / np.where(ln2 > 0, ln2, 1), 0, 1)
        d2 = (q.ax[None, :] + tt * dx - px_) ** 2 + (q.ay[None, :] + tt * dy - py_) ** 2
        j = np.argmin(d2, axis=1)
        dot = (p.bx - p.ax)[ei[idx]] * dx[j] + (p.by - p.ay)[ei[idx]] * dy[j]
        cls[idx] = np.where(dot > 0, SAME, OPP)
    return ei, t0, t1, cls


def _cross(p: Poly, ei, t0, t1):
    """½·cross(P(t0), P(t1)) summed: the Green's-theorem area term."""
    c = p.ax[ei] * p.by[ei] - p.bx[ei] * p.ay[ei]
    return 0.5 * float(np.sum((t1 - t0) * c))


def _ring_is_convex(x, y) -> bool:
    n = len(x) - 1
    sign = 0
    for i in range(n):
        j, k = (i + 1) % n, (i + 2) % n
        cr = (x[j] - x[i]) * (y[k] - y[j]) - (y[j] - y[i]) * (x[k] - x[j])
        if cr != 0:
            s = 1 if cr > 0 else -1
            if sign and s != sign:
                return False
            sign = s
    return True


def convex_parts(p: Poly):
    """The parts as CCW vertex lists when every ring is a convex shell
    (no holes), else None. Cached on the polygon."""
    cached = getattr(p, "_convex", 0)
    if cached != 0:
        return cached
    parts = []
    for rx, ry in p.rings:
        x, y = rx.tolist(), ry.tolist()
        area2 = sum(x[i] * y[i + 1] - x[i + 1] * y[i] for i in range(len(x) - 1))
        if area2 <= 0 or not _ring_is_convex(x, y):
            parts = None
            break
        parts.append(list(zip(x[:-1], y[:-1])))
    p._convex = parts
    return parts


def _clip_area(subject, clip) -> float:
    """Signed area of ``subject`` (closed ring as a vertex list) clipped by
    the convex CCW polygon ``clip`` (Sutherland-Hodgman). The signed area of
    the output is exact even for a concave subject."""
    out = subject
    k = len(clip)
    for i in range(k):
        ax, ay = clip[i]
        bx, by = clip[(i + 1) % k]
        ex, ey = bx - ax, by - ay
        if ex == 0 and ey == 0:
            continue
        inp, out = out, []
        if not inp:
            return 0.0
        sx, sy = inp[-1]
        s_in = ex * (sy - ay) - ey * (sx - ax) >= 0
        for px, py in inp:
            p_in = ex * (py - ay) - ey * (px - ax) >= 0
            if p_in != s_in:
                dx, dy = px - sx, py - sy
                den = ex * dy - ey * dx
                t = (ex * (ay - sy) - ey * (ax - sx)) / den if den else 0.0
                out.append((sx + t * dx, sy + t * dy))
            if p_in:
                out.append((px, py))
            sx, sy, s_in = px, py, p_in
    n = len(out)
    return 0.5 * sum(out[i][0] * out[(i + 1) % n][1] - out[(i + 1) % n][0] * out[i][1] for i in range(n))


def _inter_area_convex(clip_parts, other: Poly) -> float:
    total = 0.0
    for rx, ry in other.rings:
        ring = list(zip(rx[:-1].tolist(), ry[:-1].tolist()))
        for part in clip_parts:
            total += _clip_area(ring, part)
    return max(0.0, total)


def inter_area(a: Poly, b: Poly) -> float:
    """``ST_Area(ST_Intersection(a, b))`` (G10). When either side is made
    of convex hole-free parts, clip the other by it (fast path); otherwise
    integrate the boundary pieces (Green's theorem)."""
    if a.n == 0 or b.n == 0:
        return 0.0
    ca = convex_parts(a)
    if ca is not None:
        return _inter_area_convex(ca, b)
    cb = convex_parts(b)
    if cb is not None:
        return _inter_area_convex(cb, a)
    return inter_area_general(a, b)


def inter_area_general(a: Poly, b: Poly) -> float:
    """Intersection area by boundary pieces, any valid polygons."""
    ei, t0, t1, c = pieces(a, b)
    k = (c == IN) | (c == SAME)
    s = _cross(a, ei[k], t0[k], t1[k])
    ej, u0, u1, d = pieces(b, a)
    k2 = d == IN
    s += _cross(b, ej[k2], u0[k2], u1[k2])
    return max(0.0, s)


def _seg_cross(ax, ay, bx, by, cx, cy, dx, dy):
    o = lambda px, py, qx, qy, rx, ry: np.sign((qx - px) * (ry - py) - (qy - py) * (rx - px))
    o1, o2 = o(ax, ay, bx, by, cx, cy), o(ax, ay, bx, by, dx, dy)
    o3, o4 = o(cx, cy, dx, dy, ax, ay), o(cx, cy, dx, dy, bx, by)
    proper = (o1 * o2 <= 0) & (o3 * o4 <= 0)
    colin = (o1 == 0) & (o2 == 0)
    ovx = (np.minimum(ax, bx) <= np.maximum(cx, dx)) & (np.minimum(cx, dx) <= np.maximum(ax, bx))
    ovy = (np.minimum(ay, by) <= np.maximum(cy, dy)) & (np.minimum(cy, dy) <= np.maximum(ay, by))
    return np.where(colin, ovx & ovy, proper)


def _pt_seg_d2(px, py, ax, ay, bx, by):
    dx, dy = bx - ax, by - ay
    ln2 = dx * dx + dy * dy
    t = np.clip(((px - ax) * dx + (py - ay) * dy) / np.where(ln2 > 0, ln2, 1), 0, 1)
    return (ax + t * dx - px) ** 2 + (ay + t * dy - py) ** 2


def distance(a: Poly, b: Poly) -> float:
    """``ST_Distance`` for polygons (0 when they intersect). Disjoint convex
    parts: the smallest vertex-to-edge distance, in plain Python."""
    if a.n == 0 or b.n == 0:
        return float("inf")
    if intersects(a, b):
        return 0.0
    ca, cb = convex_parts(a), convex_parts(b)
    if ca is not None and cb is not None:
        return _convex_distance(ca, cb)
    d1 = _pt_seg_d2(a.ax[:, None], a.ay[:, None], b.ax[None, :], b.ay[None, :], b.bx[None, :], b.by[None, :])
    d2 = _pt_seg_d2(b.ax[:, None], b.ay[:, None], a.ax[None, :], a.ay[None, :], a.bx[None, :], a.by[None, :])
    return float(np.sqrt(min(d1.min(), d2.min())))


def _sat_separated(p, q) -> bool:
    """True when an edge normal of convex CCW ``p`` strictly separates it
    from ``q`` (touching is not separation)."""
    k = len(p)
    for i in range(k):
        ax, ay = p[i]
        bx, by = p[(i + 1) % k]
        ex, ey = bx - ax, by - ay
        if ex == 0 and ey == 0:
            continue
        if all(ex * (qy - ay) - ey * (qx - ax) < 0 for qx, qy in q):
            return True
    return False


def _convex_intersects(pa, pb) -> bool:
    return any(not _sat_separated(x, y) and not _sat_separated(y, x) for x in pa for y in pb)


def _seg_point_d2(px, py, ax, ay, bx, by) -> float:
    dx, dy = bx - ax, by - ay
    l2 = dx * dx + dy * dy
    t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / l2))
    ex, ey = ax + t * dx - px, ay + t * dy - py
    return ex * ex + ey * ey


def _convex_distance(pa, pb) -> float:
    best = float("inf")
    for x in pa:
        for y in pb:
            for src, dst in ((x, y), (y, x)):
                k = len(dst)
                for px, py in src:
                    for i in range(k):
                        ax, ay = dst[i]
                        bx, by = dst[(i + 1) % k]
                        d2 = _seg_point_d2(px, py, ax, ay, bx, by)
                        if d2 < best:
                            best = d2
    return best ** 0.5


def intersects(a: Poly, b: Poly) -> bool:
    """``ST_Intersects`` (G11): boundaries meet, or one holds the other.
    Convex hole-free parts use the separating-axis test."""
    if a.n == 0 or b.n == 0:
        return False
    ca, cb = convex_parts(a), convex_parts(b)
    if ca is not None and cb is not None:
        return _convex_intersects(ca, cb)
    return intersects_general(a, b)


def intersects_general(a: Poly, b: Poly) -> bool:
    if a.n == 0 or b.n == 0:
        return False
    hit = _seg_cross(a.ax[:, None], a.ay[:, None], a.bx[:, None], a.by[:, None],
                     b.ax[None, :], b.ay[None, :], b.bx[None, :], b.by[None, :])
    if np.any(hit):
        return True
    ins, on = contains_points(b, a.ax[:1], a.ay[:1])
    if ins[0] or on[0]:
        return True
    ins, on = contains_points(a, b.ax[:1], b.ay[:1])
    return bool(ins[0] or on[0])


def point_distance(a: Poly, x: float, y: float) -> float:
    """Distance from a point to a polygon (0 inside or on it)."""
    if a.n == 0:
        return float("inf")
    ins, on = contains_points(a, [x], [y])
    if ins[0] or on[0]:
        return 0.0
    return float(np.sqrt(np.min(_pt_seg_d2(x, y, a.ax, a.ay, a.bx, a.by))))


def _norm_ring(rx, ry):
    x, y = rx[:-1], ry[:-1]
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    if len(x) > 1 and x[0] == x[-1] and y[0] == y[-1]:
        keep[-1] = False
    x, y = x[keep], y[keep]
    changed = True
    while changed and len(x) >= 3:
        px, py = np.roll(x, 1), np.roll(y, 1)
        nx, ny = np.roll(x, -1), np.roll(y, -1)
        col = (x - px) * (ny - py) - (y - py) * (nx - px) == 0
        changed = bool(np.any(col))
        if changed:
            first = np.nonzero(col)[0][0]
            x, y = np.delete(x, first), np.delete(y, first)
    k = int(np.lexsort((y, x))[0])
    return tuple(zip(np.roll(x, -k).tolist(), np.roll(y, -k).tolist()))


def equals(a: Poly, b: Poly) -> bool:
    """``ST_Equals`` (G18) up to vertex order, start point and collinear
    or repeated vertices: the same set of normalised rings."""
    ra = sorted(_norm_ring(x, y) for x, y in a.rings)
    rb = sorted(_norm_ring(x, y) for x, y in b.rings)
    return ra == rb


def _clip_halfplane(x, y, nx, ny, c):
    """Keep points with nx*x + ny*y >= c (Sutherland-Hodgman, one plane)."""
    ox, oy = [], []
    k = len(x)
    for i in range(k):
        j = (i + 1) % k
        vi, vj = nx * x[i] + ny * y[i] - c, nx * x[j] + ny * y[j] - c
        if vi >= 0:
            ox.append(x[i]); oy.append(y[i])
        if (vi >= 0) != (vj >= 0):
            t = vi / (vi - vj)
            ox.append(x[i] + t * (x[j] - x[i])); oy.append(y[i] + t * (y[j] - y[i]))
    return np.array(ox), np.array(oy)


def erode_convex(a: Poly, d: float):
    """``ST_Buffer(a, -d)`` of convex hole-free parts: each is the
    intersection of its edge half-planes shifted inward. None if empty."""
    xs, ys, rs, rk = [], [], [], []
    for rx, ry in a.rings:
        x, y = rx[:-1].copy(), ry[:-1].copy()
        ex, ey = rx[1:] - rx[:-1], ry[1:] - ry[:-1]
        for i in range(len(ex)):
            ln = np.hypot(ex[i], ey[i])
            if ln == 0 or len(x) < 3:
                continue
            nx, ny = -ey[i] / ln, ex[i] / ln
            x, y = _clip_halfplane(x, y, nx, ny, nx * rx[i] + ny * ry[i] + d)
        if len(x) >= 3:
            area2 = np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)
            if area2 > 1e-12:
                xs.extend(list(x) + [x[0]]); ys.extend(list(y) + [y[0]])
                rs.append(len(x) + 1); rk.append(1)
    return Poly(xs, ys, rs, rk) if rs else None


ARC_STEP = np.pi / 16       # 8 chords a quarter turn, the default of ST_Buffer
EROSION_EPS = 1e-6          # metres: touching is not crossing


def _eroded_away(a: Poly, d: float):
    """What ``ST_Buffer(a, -d)`` removes from ``a``: a strip of width ``d``
    inside each edge and, at each reflex vertex, the triangles of an arc.
    Returns the pieces as CCW quads (a triangle repeats a corner), arrays of
    shape (pieces, 4), and their far sides ``(ax, ay, bx, by)``, moved inward
    by twice the tolerance."""
    quads, far = [], []
    for rx, ry in a.rings:
        moved = (rx[1:] != rx[:-1]) | (ry[1:] != ry[:-1])
        vx, vy = rx[:-1][moved], ry[:-1][moved]
        ex, ey = np.roll(vx, -1) - vx, np.roll(vy, -1) - vy
        ln = np.hypot(ex, ey)
        ux, uy = ex / ln, ey / ln
        for i in range(len(vx)):
            ax, ay, bx, by = vx[i], vy[i], vx[i] + ex[i], vy[i] + ey[i]
            nx, ny = -uy[i], ux[i]
            quads.append([(ax, ay), (bx, by), (bx + d * nx, by + d * ny), (ax + d * nx, ay + d * ny)])
            out = d + 2 * EROSION_EPS
            far.append((ax + out * nx, ay + out * ny, bx + out * nx, by + out * ny))
            mx, my = -uy[i - 1], ux[i - 1]
            turn = np.arctan2(nx * my - ny * mx, mx * nx + my * ny)     # > 0: reflex
            if turn <= 1e-9:
                continue
            k = max(1, int(turn / ARC_STEP + 0.5))
            ang = np.arctan2(my, mx) - turn * np.arange(k + 1) / k
            cx, cy = np.cos(ang), np.sin(ang)
            for j in range(k):
                p, q = (ax + d * cx[j], ay + d * cy[j]), (ax + d * cx[j + 1], ay + d * cy[j + 1])
                quads.append([(ax, ay), q, p, p])
                h = 2 * EROSION_EPS / np.cos(turn / k / 2)
                hx, hy = h * np.cos((ang[j] + ang[j + 1]) / 2), h * np.sin((ang[j] + ang[j + 1]) / 2)
                far.append((p[0] + hx, p[1] + hy, q[0] + hx, q[1] + hy))
    return np.array(quads), np.array(far).T


def _left_over(a: Poly, quads, ax, ay, bx, by):
    """Midpoints of the parts of the given segments that lie in ``a``
    outside all pieces. A line meets a convex piece in one interval."""
    vx, vy = quads[:, :, 0], quads[:, :, 1]
    ex, ey = np.roll(vx, -1, axis=1) - vx, np.roll(vy, -1, axis=1) - vy
    ln = np.hypot(ex, ey)
    flat = ln == 0
    safe = np.where(flat, 1.0, ln)
    nx, ny = np.where(flat, 0.0, -ey / safe), np.where(flat, 0.0, ex / safe)
    level = nx * vx + ny * vy - EROSION_EPS
    dx, dy = bx - ax, by - ay
    # half-plane n.p >= level along p = a + t d, for every (segment, piece, side)
    at = nx[None] * ax[:, None, None] + ny[None] * ay[:, None, None] - level[None]
    slope = nx[None] * dx[:, None, None] + ny[None] * dy[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = -at / slope
    level_side = np.abs(slope) < 1e-15
    lo = np.where(level_side, np.where(at >= 0, -np.inf, np.inf), np.where(slope > 0, t, -np.inf)).max(axis=2)
    hi = np.where(level_side, np.inf, np.where(slope < 0, t, np.inf)).min(axis=2)
    lo, hi = np.clip(lo, 0, 1), np.clip(hi, 0, 1)
    lo, hi = np.where(hi > lo, lo, 0.0), np.where(hi > lo, hi, 0.0)
    order = np.argsort(lo, axis=1)
    lo = np.take_along_axis(lo, order, axis=1)
    reach = np.maximum.accumulate(np.take_along_axis(hi, order, axis=1), axis=1)
    ones, zeros = np.ones((len(ax), 1)), np.zeros((len(ax), 1))
    start, end = np.concatenate([zeros, reach], axis=1), np.concatenate([lo, ones], axis=1)
    seg, gap = np.nonzero((end - start) * np.hypot(dx, dy)[:, None] > EROSION_EPS)
    mid = (start[seg, gap] + end[seg, gap]) / 2
    mx, my = ax[seg] + mid * dx[seg], ay[seg] + mid * dy[seg]
    if not len(mx):
        return mx, my
    inside, _ = contains_points(a, mx, my)
    return mx[inside], my[inside]


def contains_eroded_general(b: Poly, r: Poly, d: float = 0.5) -> bool:
    """:func:`contains_eroded` for polygons of any shape. The erosion lies
    in ``b`` when the boundary of ``b`` nowhere enters it and each stretch of
    its own boundary is in ``b``; every part of it has such a stretch."""
    if r.n == 0 or b.n == 0:
        return False
    quads, far = _eroded_away(r, d)
    mx, my = _left_over(r, quads, *far)
    if not len(mx):
        return False                                     # empty erosion
    inside, on = contains_points(b, mx, my)
    if not np.all(inside | on):
        return False
    return len(_left_over(r, quads, b.ax, b.ay, b.bx, b.by)[0]) == 0


def contains_eroded(b: Poly, r: Poly, d: float = 0.5) -> bool:
    """``ST_Contains(b, ST_Buffer(r, -d))`` (G16 + G17); an empty erosion
    is contained in nothing. Convex hole-free parts are eroded directly."""
    if convex_parts(r) is None:
        return contains_eroded_general(b, r, d)
    e = erode_convex(r, d)
    if e is None:
        return False
    ae = e.area()
    return bool(ae > 0 and inter_area(e, b) >= ae * (1 - 1e-9) - 1e-9)


def cover_pieces(p: Poly, q: Poly, q_first: bool):
    """Pieces of p's boundary that q hides in a union of both: strictly
    inside q, on q's boundary in the opposite direction, or (when q ranks
    first) in the same direction, so a shared piece is counted once."""
    ei, t0, t1, c = pieces(p, q)
    k = (c == IN) | (c == OPP) | ((c == SAME) & q_first)
    return ei[k], t0[k], t1[k]


def edge_terms(p: Poly):
    """Per edge: ½·cross(a, b) (area term) and length."""
    return 0.5 * (p.ax * p.by - p.bx * p.ay), np.hypot(p.bx - p.ax, p.by - p.ay)


def buffer_polygon(x: float, y: float, d: float, quad_segs: int = 8) -> Poly:
    """The polygon PostGIS builds for ``ST_Buffer(point, d)``: a regular
    ``4 * quad_segs``-gon inscribed in the circle, first vertex due east."""
    n = 4 * quad_segs
    ang = -2 * np.pi * np.arange(n + 1) / n
    xs = x + d * np.cos(ang)
    ys = y + d * np.sin(ang)
    xs[-1], ys[-1] = xs[0], ys[0]
    return Poly(xs, ys, [n + 1], [1])


def covered_fraction(n: int, cov, extra=None) -> np.ndarray:
    """Covered fraction per edge: the union length of its intervals."""
    out = np.zeros(n)
    iv = [] if cov is None else [(int(c["e"]), float(c["t0"]), float(c["t1"])) for c in cov]
    iv = sorted(iv + list(extra or []))
    if not iv:
        return out
    cur_e, lo, hi = None, 0.0, 0.0
    for e, a, b in iv:
        if e != cur_e or a > hi:
            if cur_e is not None:
                out[cur_e] += hi - lo
            cur_e, lo, hi = e, a, b
        else:
            hi = max(hi, b)
    out[cur_e] += hi - lo
    return np.clip(out, 0, 1)
