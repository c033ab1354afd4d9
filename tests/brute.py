
from __future__ import annotations

import math


def gap_flags(values, min_n=10, coef=0.95, offset=0.2):
    """Return {value: 'upper'|'lower'} for one key, or None if the key is dropped."""
    x = sorted({float(v) for v in values if v is not None})
    n = len(x)
    if n < min_n:
        return None
    mx = sum(x) / n
    t1 = coef * math.sqrt(n) + offset
    y = []
    for i in range(n - 1):
        gap = x[i + 1] - x[i]
        y.append(gap * (mx - x[i]) if x[i] < mx else gap * (x[i + 1] - mx))
    if not y:
        return {}
    my = sum(y) / len(y)
    sd = math.sqrt(sum((v - my) ** 2 for v in y) / len(y))
    if sd == 0:
        return {}
    med = x[(n + 1) // 2 - 1]
    sig = [x[i] for i in range(n - 1) if y[i] / sd > t1]
    above = [v for v in sig if v > med]
    below = [v for v in sig if v < med]
    out = {}
    if above:
        hi = max(above)
        out.update({v: "upper" for v in x if v >= hi})
    if below:
        lo = min(below)
        out.update({v: "lower" for v in x if v <= lo})
    return out
