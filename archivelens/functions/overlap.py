"""Pairs of sets that share enough members, counted block against block without a row for each pair and member."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: What is returned of each pair.
FOUND = "g1 bigint, g2 bigint"
#: Counts that are held at once, and members that so many of a block's sets have that a matrix product counts them.
CELLS, OFTEN = 4_000_000, 64


def _rows(t: pa.Table) -> tuple[np.ndarray, ...]:
    bags = t["bag"].combine_chunks()
    bags = bags.combine_chunks() if isinstance(bags, pa.ChunkedArray) else bags
    size = np.diff(bags.offsets.to_numpy()).astype(np.int64)
    return t["g"].to_numpy(), t["n"].to_numpy(), size, bags.flatten().to_numpy(zero_copy_only=False)


def _counts(x: tuple, y: tuple):
    """Of each run of rows of ``x``: where it starts, and how many members each of its rows shares with each of ``y``."""
    words, inverse = np.unique(np.concatenate([x[3], y[3]]), return_inverse=True)
    wx, wy = inverse[: len(x[3])], inverse[len(x[3]) :]
    ny = len(y[2])
    ry = np.repeat(np.arange(ny), y[2])
    df = np.bincount(wy, minlength=len(words))
    often = np.flatnonzero(df > max(OFTEN, ny // OFTEN))
    column = np.full(len(words), -1)
    column[often] = np.arange(len(often))
    dense = np.zeros((ny, len(often)), np.float32)
    held = column[wy] >= 0
    dense[ry[held], column[wy[held]]] = 1
    order = np.argsort(wy[~held], kind="stable")
    rare = ry[~held][order]
    df[often] = 0
    ends = np.cumsum(df)
    starts = np.concatenate([[0], np.cumsum(x[2])])
    step = max(1, CELLS // max(ny, len(often), 1))
    for a in range(0, len(x[2]), step):
        b = min(a + step, len(x[2]))
        w = wx[starts[a] : starts[b]]
        r = np.repeat(np.arange(b - a), x[2][a:b])
        own = np.zeros((b - a, len(often)), np.float32)
        held = column[w] >= 0
        own[r[held], column[w[held]]] = 1
        counts = np.rint(own @ dense.T).astype(np.int64)
        k = df[w]
        to = np.cumsum(k)
        # so many at once that a few very common members don't fill the memory
        cuts = np.searchsorted(to, np.arange(0, (to[-1] if len(to) else 0) + CELLS, CELLS), "left")
        for p, q in zip(cuts, [*cuts[1:], len(w)], strict=True):
            n = k[p:q]
            total = int(n.sum())
            if total:
                at = np.repeat(ends[w[p:q]] - n - (np.cumsum(n) - n), n) + np.arange(total)
                counts += np.bincount(np.repeat(r[p:q], n) * ny + rare[at], minlength=(b - a) * ny).reshape(b - a, ny)
        yield a, counts


def alike(share: float, length: float) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """For cogroups of rows (g, n, bag) by x and y, blocks as ``band:number``: pairs of which the smaller set shares ``share`` of its members, and n is alike.

    Rows of the left side meet those of the right; with the first block of the next band, they also meet each other.
    """

    def met(x: tuple, y: tuple, same: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for a, counts in _counts(x, y) if len(x[0]) and len(y[0]) else ():
            to = a + len(counts)
            enough = counts >= share * np.minimum(x[2][a:to, None], y[2][None])
            n, m = x[1][a:to, None], y[1][None]
            enough &= np.minimum(n, m) >= length * np.maximum(n, m)
            if same:
                enough &= x[0][a:to, None] < y[0][None]
            i, j = np.nonzero(enough)
            out.append((x[0][a + i], y[0][j]))
        return out

    def pairs(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        x, y = _rows(left), _rows(right)
        band = int(key[0].as_py().split(":")[0])
        found = met(x, x, True) if key[1].as_py() == f"{band + 1}:0" else []
        found += met(x, y, False)
        none = np.zeros(0, np.int64)
        return pa.table({"g1": np.concatenate([none, *(f[0] for f in found)]), "g2": np.concatenate([none, *(f[1] for f in found)])})

    return pairs
