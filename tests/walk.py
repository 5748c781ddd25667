"""The trajectory rules as one sequential walk over a small list, for comparison only."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from math import acos, atan2, cos, hypot, radians, sin, sqrt


def r5(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.00001"), ROUND_HALF_UP))


def miles(a, b) -> float:
    (la, lo), (lb, lp) = [(radians(r5(p[1])), radians(r5(p[2]))) for p in (a, b)]
    h = sin((lb - la) / 2) ** 2 + cos(la) * cos(lb) * sin((lp - lo) / 2) ** 2
    return 6373.0 * 0.621371 * 2 * atan2(sqrt(h), sqrt(max(0.0, 1 - h)))


def walk(points, upper=20.0, thres=300.0, cap=100.0, shortest=4):
    """points: (sec, lat, long) of one device. Returns sec -> (speed, angle, mean angle)."""
    pts = sorted(points)
    n = len(pts)
    if n < shortest:
        return {p[0]: (-1.0, -1.0, -1.0) for p in pts}
    gap = [(pts[i + 1][0] - pts[i][0]) / 60 for i in range(n - 1)]
    mph = [miles(pts[i], pts[i + 1]) / gap[i] * 60 for i in range(n - 1)]
    ok = [mph[i] if gap[i] < upper and mph[i] < cap else -1.0 for i in range(n - 1)]
    speed = [ok[0]]
    for i in range(1, n - 1):
        if gap[i] >= upper:
            speed.append(ok[i - 1])
            continue
        v = mph[i] if ok[i - 1] == -1 else (ok[i - 1] + mph[i]) / 2
        speed.append(v if v < cap else -1.0)
    speed.append(ok[-1])
    angle = [-1.0] * n
    for i in range(1, n - 1):
        if pts[i][0] - pts[i - 1][0] > thres or pts[i + 1][0] - pts[i][0] > thres:
            continue
        a = [pts[i - 1][k] - pts[i][k] for k in (1, 2)]
        b = [pts[i + 1][k] - pts[i][k] for k in (1, 2)]
        na, nb = hypot(*a), hypot(*b)
        if na == 0 or nb == 0 or (na < 1e-5 and nb < 1e-5):
            continue
        angle[i] = acos(max(-1.0, min(1.0, (a[0] * b[0] + a[1] * b[1]) / na / nb)))
    mean = []
    for i in range(n):
        near = [j for j in range(n) if abs(pts[j][0] - pts[i][0]) <= thres]
        used = [angle[j] for j in near[:-1] if angle[j] >= 0]
        both = 0 < i < n - 1 and near[0] < i < near[-1]
        mean.append(sum(used) / len(used) if both and used else -1.0)
    return {p[0]: (s, a, m) for p, s, a, m in zip(pts, speed, angle, mean)}
