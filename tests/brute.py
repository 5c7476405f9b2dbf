"""Indicator definitions as plain loops over one symbol, for comparison."""

import math

import numpy as np


def mean(xs):
    return sum(xs) / len(xs)


def rolling(xs, n, f, first=None):
    first = first or n
    return [f(xs[max(0, i - n + 1): i + 1]) if i + 1 >= first else None for i in range(len(xs))]


def seeded(xs, n, k, start=0):
    """Average seeded by the mean of n values from ``start``; step weight k."""
    out, y = [], None
    for i, x in enumerate(xs):
        if i == start + n - 1:
            y = mean(xs[start: i + 1])
        elif i >= start + n:
            y = y + k * (x - y)
        out.append(y if i >= start + n - 1 else None)
    return out


def ema(xs, n, start=0):
    return seeded(xs, n, 2 / (n + 1), start)


def everything(g):
    c, h, l, v = (g[x].tolist() for x in ("adj_close", "high", "low", "volume"))
    n = len(c)
    out = {}
    for k in (5, 25, 50, 75, 200):
        out[f"sma{k}"] = rolling(c, k, mean)
        q = 1 - 2 / (k + 1)
        num = den = 0.0
        out[f"ewma{k}"] = []
        for x in c:
            num, den = num * q + x, den * q + 1
            out[f"ewma{k}"].append(num / den)
    up = [0.0] + [max(c[i] - c[i - 1], 0) for i in range(1, n)]
    dn = [0.0] + [max(c[i - 1] - c[i], 0) for i in range(1, n)]
    for k in (9, 14):
        u, d = seeded(up, k, 1 / k, 1), seeded(dn, k, 1 / k, 1)
        out[f"rsi{k}"] = [None if a is None else (100 * a / (a + b) if a + b else 0.0) for a, b in zip(u, d)]
    tp = [(a + b + x) / 3 for a, b, x in zip(h, l, c)]
    mfi = []
    for i in range(n):
        if i < 14:
            mfi.append(None)
            continue
        pos = sum(tp[j] * v[j] for j in range(i - 13, i + 1) if tp[j] > tp[j - 1])
        neg = sum(tp[j] * v[j] for j in range(i - 13, i + 1) if tp[j] < tp[j - 1])
        mfi.append(0.0 if pos + neg < 1 else 100 * pos / (pos + neg))
    out["mfi14"] = mfi
    for k in (10, 25, 50, 75, 150):
        out[f"roc{k}"] = [(c[i] / c[i - k] - 1) * 100 if i >= k else None for i in range(n)]
    for k in (10, 25):
        out[f"mom{k}"] = [c[i] - c[i - k] if i >= k else None for i in range(n)]

    def cci(xs):
        m = mean(xs)
        dev = mean([abs(x - m) for x in xs])
        return 0.0 if dev < 1e-12 or abs(xs[-1] - m) < 1e-12 else (xs[-1] - m) / (0.015 * dev)

    out["cci14"] = rolling(tp, 14, cci)
    tr = [None] + [max(h[i], c[i - 1]) - min(l[i], c[i - 1]) for i in range(1, n)]
    bp = [None] + [c[i] - min(l[i], c[i - 1]) for i in range(1, n)]
    ult = []
    for i in range(n):
        if i < 28:
            ult.append(None)
            continue
        total = 0.0
        for k, w in ((7, 4), (14, 2), (28, 1)):
            t = sum(tr[i - k + 1: i + 1])
            total += w * (sum(bp[i - k + 1: i + 1]) / t if t else 0.0)
        ult.append(100 * total / 7)
    out["ultosc"] = ult

    def raw_k(i, k):
        lo, hi = min(l[i - k + 1: i + 1]), max(h[i - k + 1: i + 1])
        return 100 * (c[i] - lo) / (hi - lo) if hi > lo else 0.0

    k5 = [raw_k(i, 5) if i >= 4 else None for i in range(n)]
    k3 = [mean(k5[i - 2: i + 1]) if i >= 6 else None for i in range(n)]
    d3 = [mean(k3[i - 2: i + 1]) if i >= 8 else None for i in range(n)]
    out["slowk"] = [k3[i] if i >= 8 else None for i in range(n)]
    out["slowd"] = d3
    out["fastk"] = [k5[i] if i >= 6 else None for i in range(n)]
    out["fastd"] = k3
    fast, slow = ema(c, 12, 14), ema(c, 26)
    line = [a - b if b is not None else 0.0 for a, b in zip(fast, slow)]
    sig = ema(line, 9, 25)
    out["macd"] = [x if s is not None else None for x, s in zip(line, sig)]
    out["macdsignal"] = sig
    out["macdhist"] = [x - s if s is not None else None for x, s in zip(line, sig)]
    e, xs = [], c
    for k in range(6):
        xs = ema(xs, 5, 4 * k)
        e.append(xs)
        xs = [x or 0.0 for x in xs]
    b = 0.7
    mid = [
        None if e[5][i] is None
        else -(b**3) * e[5][i] + 3 * (b**2 + b**3) * e[4][i] + (-6 * b**2 - 3 * (b + b**3)) * e[3][i]
        + (1 + 3 * b + b**3 + 3 * b**2) * e[2][i]
        for i in range(n)
    ]
    sd = rolling(c, 5, lambda w: float(np.std(w)))
    out["middleband"] = mid
    out["upperband"] = [None if m is None else m + 2 * s for m, s in zip(mid, sd)]
    out["lowerband"] = [None if m is None else m - 2 * s for m, s in zip(mid, sd)]
    out["willr14"] = [
        None if i < 13 else (lambda lo, hi: -100 * (hi - c[i]) / (hi - lo) if hi > lo else 0.0)(
            min(l[i - 13: i + 1]), max(h[i - 13: i + 1])
        )
        for i in range(n)
    ]
    out["tr"] = tr
    out["vl"] = [None if t is None else t / p * 100 for t, p in zip(tr, tp)]
    out["atr"] = seeded([t or 0.0 for t in tr], 14, 1 / 14, 1)
    out["natr"] = [None if a is None else a / x * 100 for a, x in zip(out["atr"], c)]
    out["ret_index"] = [x / c[0] for x in c]
    out["vol"] = [
        float(np.std(out["ret_index"][max(0, i - 249): i + 1], ddof=1)) * math.sqrt(250) if i >= 49 else None
        for i in range(n)
    ]
    rate = [x / max(v) if max(v) else None for x in v]
    out["v_rate"] = [None if r is None else r * 50 for r in rate]
    out["v_rate_p"] = [None if r is None else r * (max(h) - min(l)) / 4 + min(l) for r in rate]
    out["sar"] = parabolic(h, l)
    return out


def parabolic(h, l, acc=0.02, top=0.2):
    """Both sides spelled out."""
    n = len(h)
    out = [None] * n
    if n < 2:
        return out
    rise, fall = h[1] - h[0], l[0] - l[1]
    long = not (fall > 0 and fall > rise)
    ep, sar = (h[1], l[0]) if long else (l[1], h[0])
    af = acc
    nl, nh = l[1], h[1]
    for i in range(1, n):
        pl, ph, nl, nh = nl, nh, l[i], h[i]
        if long:
            if nl <= sar:
                long = False
                sar = max(ep, ph, nh)
                out[i] = sar
                af, ep = acc, nl
                sar = max(sar + af * (ep - sar), ph, nh)
            else:
                out[i] = sar
                if nh > ep:
                    ep, af = nh, min(af + acc, top)
                sar = min(sar + af * (ep - sar), pl, nl)
        elif nh >= sar:
            long = True
            sar = min(ep, pl, nl)
            out[i] = sar
            af, ep = acc, nh
            sar = min(sar + af * (ep - sar), pl, nl)
        else:
            out[i] = sar
            if nl < ep:
                ep, af = nl, min(af + acc, top)
            sar = max(sar + af * (ep - sar), ph, nh)
    return out


def gini_tree(x, y, w, depth):
    """Exhaustive search tree: (feature, cut, left, right) or a share of label 1."""
    total, pos = w.sum(), (w * y).sum()
    best = None
    if depth and 0 < pos < total:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values[:-1], values[1:]):
                left = x[:, f] <= (a + b) / 2
                gain = 0.0
                for side in (left, ~left):
                    n, p = w[side].sum(), (w * y)[side].sum()
                    gain += (p * p + (n - p) ** 2) / n
                key = (gain, -f, -(a + b) / 2)
                if best is None or key > best[0]:
                    best = (key, f, (a + b) / 2, left)
    if best is None:
        return pos / total
    _, f, cut, left = best
    return (f, cut, gini_tree(x[left], y[left], w[left], depth - 1), gini_tree(x[~left], y[~left], w[~left], depth - 1))


def descend(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree
