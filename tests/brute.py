"""Literal, row-at-a-time versions of the rules, for comparing with the Spark operators on
small inputs."""

from __future__ import annotations

import math


def gaps(ts: list[int]) -> list[tuple[int, int]]:
    """(ts, lead(ts, 1, ts) - ts) in timestamp order."""
    s = sorted(ts)
    return [(t, (s[i + 1] if i + 1 < len(s) else t) - t) for i, t in enumerate(s)]


def interval(ts: list[int]) -> int | None:
    pos = [g for _, g in gaps(ts) if g > 0]
    return min(pos) if pos else None


def upsample(rows: list[tuple[int, float | None]], step: int) -> list[tuple[int, float | None]]:
    """Rows (ts, v) with distinct ts; each row copied to ts + i*step, 0 <= i < max(g div step, 1)."""
    rows = sorted(rows)
    out = []
    for i, (t, v) in enumerate(rows):
        g = (rows[i + 1][0] if i + 1 < len(rows) else t) - t
        for j in range(max(g // step, 1)):
            out.append((t + j * step, v))
    return out


def downsample(rows: list[tuple[int, float | None]], iv: int) -> list[tuple[int, float | None]]:
    buckets: dict[int, list] = {}
    for t, v in rows:
        buckets.setdefault(t - t % iv, []).append((t, v))
    out = []
    for b, items in buckets.items():
        vals = [v for _, v in items if v is not None]
        out.append((min(t for t, _ in items), sum(vals) / len(vals) if vals else None))
    return out


def resample(rows: list[tuple[int, float | None]], new: int) -> list[tuple[int, float | None]]:
    old = interval([t for t, _ in rows])
    if old is None:
        return downsample(rows, new)
    if old == new:
        return upsample(rows, new)
    step = old if old < new else math.gcd(old, new)
    return downsample(upsample(rows, step), new)
