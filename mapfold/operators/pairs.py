"""The overlay of pairs of small polygons, many pairs at once in integer arrays.

``outlines`` takes the steps of :mod:`mapfold.operators.polygons` for the pairs of
an Arrow batch: cuts, pieces, pieces that both polygons share, and the side of every
other piece by an odd number of edges west of its midpoint.  Coordinates are 64-bit
integers and crossing points are rounded as in SQL, so the rows are those of the
other plans.  A step holds as many pairs as make ``STEP`` pairs of edges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

EDGE = ["x1", "y1", "x2", "y2"]

#: pairs of edges that are in memory together
STEP = 1 << 18

#: whether a side belongs to the region, by whether it lies in either polygon (arrays or columns)
REGIONS: dict[str, Callable] = {
    "intersection": lambda a, b: a & b,
    "difference": lambda a, b: a & ~b,
    "union": lambda a, b: a | b,
    "symdiff": lambda a, b: a != b,
}


class Side:
    """The edges of one side: coordinates, the pair of each edge, and whether it is the first of its equals."""

    def __init__(self, lists: pa.ListArray):
        flat = lists.flatten()
        self.count = np.diff(lists.offsets.to_numpy())
        self.xy = [flat.field(c).to_numpy() for c in EDGE]
        self.once = flat.field("once").to_numpy(zero_copy_only=False)
        self.pair = np.repeat(np.arange(len(self.count)), self.count)

    def start(self) -> np.ndarray:
        return np.cumsum(self.count) - self.count


def _beside(pair: np.ndarray, count: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row of ``pair`` beside each of the other side's rows of its pair: numbers of both."""
    times = count[pair]
    mine = np.repeat(np.arange(len(pair)), times)
    return mine, np.arange(len(mine)) - np.repeat(np.cumsum(times) - times - start[pair], times)


def _box(side: Side, pairs: int) -> list[np.ndarray]:
    """Least and greatest x and y of each pair's edges."""
    x1, y1, x2, y2 = side.xy
    at = side.start()
    return [f.reduceat(g(p, q), at) for p, q in ((x1, x2), (y1, y2)) for f, g in ((np.minimum, np.minimum), (np.maximum, np.maximum))]


def _near(side: Side, box: list[np.ndarray]) -> np.ndarray:
    """The edges, each once, that meet the other polygon's box."""
    x1, y1, x2, y2 = side.xy
    x0, x9, y0, y9 = (b[side.pair] for b in box)
    return np.flatnonzero(side.once & (np.maximum(x1, x2) >= x0) & (np.minimum(x1, x2) <= x9) & (np.maximum(y1, y2) >= y0) & (np.minimum(y1, y2) <= y9))


def _cuts(l: Side, r: Side, pairs: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(edge, x, y) of the points that cut the edges of either side."""
    near_l, near_r = _near(l, _box(r, pairs)), _near(r, _box(l, pairs))
    count = np.bincount(r.pair[near_r], minlength=pairs)
    i, j = _beside(l.pair[near_l], count, np.cumsum(count) - count)
    i, j = near_l[i], near_r[j]
    low = lambda s, k, a: np.minimum(s.xy[a], s.xy[a + 2])[k]
    high = lambda s, k, a: np.maximum(s.xy[a], s.xy[a + 2])[k]
    on = (high(l, i, 0) >= low(r, j, 0)) & (low(l, i, 0) <= high(r, j, 0)) & (high(l, i, 1) >= low(r, j, 1)) & (low(l, i, 1) <= high(r, j, 1))
    i, j = i[on], j[on]
    px1, py1, px2, py2 = (c[i] for c in l.xy)
    qx1, qy1, qx2, qy2 = (c[j] for c in r.xy)
    dx, dy, ex, ey = px2 - px1, py2 - py1, qx2 - qx1, qy2 - qy1
    den = dx * ey - dy * ex
    t, u = (qx1 - px1) * ey - (qy1 - py1) * ex, (qx1 - px1) * dy - (qy1 - py1) * dx
    sign, most = np.sign(den), np.abs(den)
    t_, u_ = t * sign, u * sign
    met = np.flatnonzero((den != 0) & (t_ >= 0) & (t_ <= most) & (u_ >= 0) & (u_ <= most))
    at = t[met].astype(np.float64) / den[met].astype(np.float64)
    x = np.floor(px1[met] + at * dx[met] + 0.5).astype(np.int64)
    y = np.floor(py1[met] + at * dy[met] + 0.5).astype(np.int64)
    found = {"l": [(i[met], x, y)], "r": [(j[met], x, y)]}
    line = np.flatnonzero((den == 0) & (t == 0) & (u == 0))
    for s, mine, k, o, others in (("l", l, i[line], r, j[line]), ("r", r, j[line], l, i[line])):
        for end in (0, 2):
            x, y = o.xy[end][others], o.xy[end + 1][others]
            held = (x >= low(mine, k, 0)) & (x <= high(mine, k, 0)) & (y >= low(mine, k, 1)) & (y <= high(mine, k, 1))
            found[s].append((k[held], x[held], y[held]))
    return [tuple(np.concatenate(c) for c in zip(*found[s])) for s in "lr"]


def _pieces(side: Side, cuts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """(pair, ax, ay, bx, by, turn) of the pieces of a side's edges: a before b, turn 1 if the edge runs from a to b, else -1."""
    e, x, y = cuts
    x1, y1, x2, y2 = side.xy
    inner = ((x != x1[e]) | (y != y1[e])) & ((x != x2[e]) | (y != y2[e]))
    e, x, y = e[inner], x[inner], y[inner]
    is_cut = np.zeros(len(x1), bool)
    is_cut[e] = True
    whole, cut = np.flatnonzero(side.once & ~is_cut), np.flatnonzero(is_cut)
    e, x, y = np.concatenate([cut, cut, e]), np.concatenate([x1[cut], x2[cut], x]), np.concatenate([y1[cut], y2[cut], y])
    at = (x2[e] - x1[e]) * (x - x1[e]) + (y2[e] - y1[e]) * (y - y1[e])
    order = np.lexsort((y, x, at, e))
    e, x, y = e[order], x[order], y[order]
    on = np.flatnonzero(e[1:] == e[:-1])
    e = np.concatenate([whole, e[on]])
    sx, sy = np.concatenate([x1[whole], x[on]]), np.concatenate([y1[whole], y[on]])
    zx, zy = np.concatenate([x2[whole], x[on + 1]]), np.concatenate([y2[whole], y[on + 1]])
    some = (sx != zx) | (sy != zy)
    e, sx, sy, zx, zy = (c[some] for c in (e, sx, sy, zx, zy))
    ahead = (sx < zx) | ((sx == zx) & (sy < zy))
    a, b = (np.where(ahead, sx, zx), np.where(ahead, sy, zy)), (np.where(ahead, zx, sx), np.where(ahead, zy, sy))
    return [side.pair[e], *a, *b, np.where(ahead, 1, -1)]


def _shared(pieces: list[list[np.ndarray]]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Equal pieces of a pair as one: (pair, ax, ay, bx, by), the turns of both sides and how many pieces these have."""
    *keys, turn = (np.concatenate(c) for c in zip(*pieces))
    right = np.arange(len(turn)) >= len(pieces[0][0])
    mix = np.zeros(len(turn), np.uint64)
    for c in keys[1:]:
        mix = (mix ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    mix = (keys[0].astype(np.uint64) << np.uint64(40)) | (mix >> np.uint64(24))

    def starts(order: np.ndarray) -> np.ndarray:
        new = np.ones(len(order), bool)
        new[1:] = False
        for c in keys:
            new[1:] |= c[order[1:]] != c[order[:-1]]
        return new

    order = np.argsort(mix)
    new = starts(order)
    if (new[1:] & (mix[order[1:]] == mix[order[:-1]])).any():  # places with equal numbers: by the places themselves
        order = np.lexsort(keys[::-1])
        new = starts(order)
    first = np.flatnonzero(new)
    turn, right = turn[order], right[order]
    add = lambda v: np.add.reduceat(v, first) if len(first) else v
    return [k[order][first] for k in keys], [add(turn * ~right), add(turn * right)], [add((~right).astype(np.int64)), add(right.astype(np.int64))]


def _odd(pair: np.ndarray, px: np.ndarray, py: np.ndarray, side: Side) -> np.ndarray:
    """The points, in doubled coordinates, lie inside the side's polygon: an odd number of edges passes west."""
    i, j = _beside(pair, side.count, side.start())
    x1, y1, x2, y2 = side.xy
    y = py[i]
    spans = np.flatnonzero((y1[j] * 2 > y) != (y2[j] * 2 > y))
    i, j, y = i[spans], j[spans], y[spans]
    dx, dy = x2[j] - x1[j], y2[j] - y1[j]
    beside = (x1[j] * 2 - px[i]) * dy + (y - y1[j] * 2) * dx
    west = np.where(dy > 0, beside < 0, beside > 0)
    return np.bincount(i[west], minlength=len(pair)) % 2 == 1


def outlines(l: Side, r: Side, region: str) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(pair, x1..y2 of the region's directed edges, whether the insides of each pair overlap)."""
    pairs = len(l.count)
    cut_l, cut_r = _cuts(l, r, pairs)
    (pair, ax, ay, bx, by), turns, many = _shared([_pieces(l, cut_l), _pieces(r, cut_r)])
    within = np.zeros(len(pair), bool)
    for side, n in ((l, many[0]), (r, many[1])):
        k = np.flatnonzero(n == 0)
        within[k] = _odd(pair[k], ax[k] + bx[k], ay[k] + by[k], side)

    def beside(s: int, on_left: bool) -> np.ndarray:
        turn = turns[s]
        return np.where(many[s] == 0, within, (turn == 0) | ((turn > 0) if on_left else (turn < 0)))

    (ll, rl), (lr, rr) = ((beside(0, on), beside(1, on)) for on in (True, False))
    left, right = REGIONS[region](ll, rl), REGIONS[region](lr, rr)
    overlap = np.zeros(pairs, bool)
    overlap[pair[(ll & rl) != (lr & rr)]] = True
    k = np.flatnonzero(left != right)
    pair, left, ax, ay, bx, by = (c[k] for c in (pair, left, ax, ay, bx, by))
    return pair, [np.where(left, ax, bx), np.where(left, ay, by), np.where(left, bx, ax), np.where(left, by, ay)], overlap


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Side, Side]]:
    sizes = [np.diff(batch.column(c).offsets.to_numpy()).astype(np.int64) for c in ("le", "re")]
    ends = np.cumsum((sizes[0] + sizes[1]) * np.maximum(*sizes))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        part = batch.slice(at, to - at)
        yield part, Side(part.column("le")), Side(part.column("re"))
        at = to


def overlaid(met: DataFrame, region: str, overlapping: bool) -> DataFrame:
    """(lid, rid, x1..y2) from rows (lid, rid, le, re), the edges of both sides: the region's directed
    edges, if ``overlapping`` of the pairs alone whose insides overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, l, r in _steps(batch):
                pair, ends, overlap = outlines(l, r, region)
                if overlapping:
                    on = overlap[pair]
                    pair, ends = pair[on], [c[on] for c in ends]
                rows = pa.array(pair)
                yield pa.RecordBatch.from_arrays([part.column("lid").take(rows), part.column("rid").take(rows), *map(pa.array, ends)], ["lid", "rid", *EDGE])

    kinds = dict(met.select("lid", "rid").dtypes)
    return met.select("lid", "rid", "le", "re").mapInArrow(run, f"lid {kinds['lid']}, rid {kinds['rid']}, x1 long, y1 long, x2 long, y2 long")


def left_within_right(met: DataFrame) -> DataFrame:
    """(lid, rid) of the pairs whose difference has no edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, l, r in _steps(batch):
                pair, _, _ = outlines(l, r, "difference")
                rows = pa.array(np.flatnonzero(np.bincount(pair, minlength=len(l.count)) == 0))
                yield pa.RecordBatch.from_arrays([part.column("lid").take(rows), part.column("rid").take(rows)], ["lid", "rid"])

    kinds = dict(met.select("lid", "rid").dtypes)
    return met.select("lid", "rid", "le", "re").mapInArrow(run, f"lid {kinds['lid']}, rid {kinds['rid']}")
