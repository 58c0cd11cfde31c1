"""Trees on 0/1 targets in NumPy: growing from folded rows of bin codes, and scoring."""

from __future__ import annotations

import numpy as np

# One record per node in the order of their ids: the root is 0, a right child follows its left one, a leaf has no children (-1).
NODE = np.dtype([("left", "<i4"), ("feature", "<i4"), ("threshold", "<f8"), ("cover", "<f8"), ("value", "<f8")])
ROWS_AT_ONCE, NODES_AT_ONCE = 1 << 17, 512  # of a level; a larger node is worked on alone
LEAST_GAIN = 1e-15  # less is rounding


def bin_codes(x: np.ndarray, cuts: list[np.ndarray], kind: type) -> np.ndarray:
    """(rows, features) of values -> the same shape of codes: how many cut points lie below a value."""
    return np.stack([np.searchsorted(c, x[:, f], side="left").astype(kind) for f, c in enumerate(cuts)], axis=1)


def code_values(codes: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """A value of every code: its upper cut point, which belongs to it."""
    return np.stack([np.append(c, np.inf)[codes[:, f]] for f, c in enumerate(cuts)], axis=1)


def _best_splits(x, rows, w0, w1, sizes, t0, t1, c0, c1, cuts, picked, min_leaf):
    """Per node: its best feature (-1: none), bin, and the counts of both classes on the left of it."""
    m, best, drawn = len(sizes), np.full(len(sizes), -np.inf), np.zeros(len(sizes), int)
    feature, at, left0, left1 = np.full(m, -1), np.zeros(m, int), np.zeros(m), np.zeros(m)
    weight, ones = c0 * t0 + c1 * t1, c1 * t1
    for f in np.flatnonzero(np.bincount(picked.ravel(), minlength=len(cuts))):
        bins, asked = len(cuts[f]) + 1, (picked == f).any(axis=1)
        if bins == 1:
            continue
        if asked.all():
            who, mine, a0, a1 = np.arange(m), rows, w0, w1
        else:
            who, here = np.flatnonzero(asked), np.flatnonzero(np.repeat(asked, sizes))
            mine, a0, a1 = rows[here], w0[here], w1[here]
        key = x[f][mine].astype(np.intp)
        if len(who) > 1:
            key += np.repeat(np.arange(len(who)) * bins, sizes[who])
        n0, n1 = (np.bincount(key, a, len(who) * bins).reshape(-1, bins).cumsum(axis=1)[:, :-1] for a in (a0, a1))
        count, all0, all1 = n0 + n1, t0[who, None], t1[who, None]
        ones_left, weight_left = c1 * n1, c0 * n0 + c1 * n1
        ones_right, weight_right = ones[who, None] - ones_left, weight[who, None] - weight_left
        possible = (count >= min_leaf) & (all0 + all1 - count >= min_leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(possible, ones_left**2 / weight_left + ones_right**2 / weight_right, -np.inf)
        place = score.argmax(axis=1)
        pick, turn = np.arange(len(who)), (picked[who] == f).argmax(axis=1)
        found = score[pick, place]
        # Features of a day part rows alike, so equal scores are common: the one drawn first is taken, whatever its place.
        better = (found > best[who]) | ((found == best[who]) & (turn < drawn[who]) & (found > -np.inf))
        to, place, pick = who[better], place[better], pick[better]
        best[to], feature[to], at[to], drawn[to] = score[pick, place], f, place, turn[better]
        left0[to], left1[to] = n0[pick, place], n1[pick, place]
    feature[~((best - ones**2 / weight) / weight > LEAST_GAIN)] = -1
    return feature, at, left0, left1


def grow(x: np.ndarray, n0: np.ndarray, n1: np.ndarray, c0: float, c1: float, cuts: list[np.ndarray], rng: np.random.Generator,
         depth: int, min_leaf: int, subset: int) -> np.ndarray:
    """One tree (``NODE`` records) on a bootstrap of folded rows.

    ``x``: (features, rows) of bin codes; ``n0``, ``n1``: how many rows of either class a folded row stands for; ``c0``, ``c1``: weights
    of the classes. Each row is drawn a Poisson(1) number of times, so a folded row Poisson(n) times. Every node tries ``subset``
    features, each with all its bins, for the split that lowers the variance most and leaves ``min_leaf`` drawn rows on either side.
    """
    w0, w1 = rng.poisson(n0), rng.poisson(n1)
    rows = np.flatnonzero(w0 + w1).astype(np.int32)
    w0, w1 = w0[rows].astype(float), w1[rows].astype(float)

    def nodes(t0, t1):
        out = np.zeros(len(t0), NODE)
        out["left"] = out["feature"] = -1
        out["threshold"], out["cover"] = np.nan, c0 * t0 + c1 * t1
        out["value"] = np.divide(c1 * t1, out["cover"], out=np.zeros(len(t0)), where=out["cover"] > 0)
        return out

    def open_(t0, t1, level):
        return (t0 > 0) & (t1 > 0) & (t0 + t1 >= 2 * min_leaf) & (level < depth)

    t0, t1 = np.array([w0.sum()]), np.array([w1.sum()])
    levels, total = [nodes(t0, t1)], 1
    ids = np.flatnonzero(open_(t0, t1, 0))  # places of the open nodes in the last level
    sizes = np.array([len(rows)])[ids]
    t0, t1 = t0[ids], t1[ids]
    for level in range(depth):
        if not len(ids):
            break
        picked = rng.random((len(ids), len(cuts))).argsort(axis=1)[:, :subset]
        ends = sizes.cumsum()
        kept, stats, kids, a = [], [], [], 0
        while a < len(ids):
            start = ends[a] - sizes[a]
            b = min(max(a + 1, int(np.searchsorted(ends, start + ROWS_AT_ONCE, side="right"))), a + NODES_AT_ONCE)
            some, span = slice(a, b), slice(start, ends[b - 1])
            a = b
            mine, a0, a1, size = rows[span], w0[span], w1[span], sizes[some]
            feature, at, left0, left1 = _best_splits(x, mine, a0, a1, size, t0[some], t1[some], c0, c1, cuts, picked[some], min_leaf)
            split = feature >= 0
            if not split.any():
                continue
            last = levels[-1]
            places = ids[some][split]
            last["feature"][places] = feature[split]
            last["threshold"][places] = [cuts[f][i] for f, i in zip(feature[split], at[split])]
            last["left"][places] = total + 2 * (sum(len(k) for k in kids) + np.arange(len(places)))
            kids.append(places)
            # Children side by side: 2 i and 2 i + 1 of the i-th split node of the chunk.
            child0 = np.stack([left0[split], t0[some][split] - left0[split]], axis=1).ravel()
            child1 = np.stack([left1[split], t1[some][split] - left1[split]], axis=1).ravel()
            stats.append((child0, child1))
            stays = open_(child0, child1, level + 1)
            if not stays.any():
                continue
            if len(size) == 1:
                right = x[feature[0]][mine] > at[0]
                halves = [np.flatnonzero(right == side) for side, stay in ((False, stays[0]), (True, stays[1])) if stay]
                order, grown = np.concatenate(halves), np.array([len(h) for h in halves])
            else:
                node = np.repeat(np.arange(len(size)), size)
                code = x.ravel()[feature[node] * x.shape[1] + mine]
                number = np.cumsum(split) - 1
                key = (2 * number[node] + (code > at[node])).astype(np.int16)
                use = np.flatnonzero(split[node])
                use = use[stays[key[use]]]
                order = use[key[use].argsort(kind="stable")]
                grown = np.bincount(key[use], minlength=len(stays))[stays]
            kept.append((mine[order], a0[order], a1[order], grown))
        if not stats:
            break
        t0, t1 = (np.concatenate(s) for s in zip(*stats))
        total += len(t0)
        levels.append(nodes(t0, t1))
        ids = np.flatnonzero(open_(t0, t1, level + 1))
        t0, t1 = t0[ids], t1[ids]
        if kept:
            rows, w0, w1, sizes = (np.concatenate(k) for k in zip(*kept))
    return np.concatenate(levels)


def walks(trees: list[np.ndarray]) -> list[tuple[np.ndarray, ...]]:
    """Trees as ``mean_scores`` walks them: a leaf is its own left child, and no value is above its threshold."""
    out = []
    for t in trees:
        leaf, depth, level = t["left"] < 0, 0, t["left"][:1]
        while (level := level[level > 0]).size:
            depth, level = depth + 1, t["left"][np.concatenate([level, level + 1])]
        out.append((depth, np.where(leaf, np.arange(len(t), dtype=np.int32), t["left"]), np.where(leaf, 0, t["feature"]),
                    np.where(leaf, np.inf, t["threshold"]), t["value"].copy()))
    return out


def mean_scores(x: np.ndarray, forest: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Mean leaf value over all ``walks`` for (rows, features) of values; a value up to the threshold goes left, NaN right."""
    width = x.shape[1]
    flat = np.where(np.isnan(x), np.inf, x).ravel()
    base, total = np.arange(len(x)) * width, np.zeros(len(x))
    for depth, left, feature, threshold, value in forest:
        node = np.zeros(len(x), np.int32)
        for _ in range(depth):
            node = left[node] + (flat[base + feature[node]] > threshold[node])
        total += value[node]
    return total / len(forest)


def split_decreases(tree: np.ndarray, width: int) -> np.ndarray:
    """Per feature the sum of (cover x decrease of variance) over its splits, as shares of the tree's; zeros for a stump."""
    inner = np.flatnonzero(tree["left"] >= 0)
    mass = tree["cover"] * tree["value"] ** 2
    gain = mass[tree["left"][inner]] + mass[tree["left"][inner] + 1] - mass[inner]
    out = np.bincount(tree["feature"][inner], gain, width)
    return out / out.sum() if out.sum() else out
