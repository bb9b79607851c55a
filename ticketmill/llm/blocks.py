"""Groups of rows in tasks: rows sorted by a group number, whole groups at a time, pairs in them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 2048


def whole_groups(batches: Iterator[pa.RecordBatch], column: str = "group", step: int = STEP) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by the group number; several small groups
    together, about `step` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            group = part.column(column).to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if not cut and held and held[-1].column(column)[-1].as_py() != group[0]:
                yield pa.Table.from_batches(held)
                held = []
            if cut:
                yield pa.Table.from_batches([*held, part.slice(0, cut)])
                held = []
            held.append(part.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def pairs(group: np.ndarray, side: np.ndarray, across: np.ndarray, limit: int = 1 << 16
          ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within runs of equal `group`: all of a run, or only those of different sides
    where `across`; about `limit` at a time."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], len(group)]
    partners = np.repeat(ends, ends - starts) - np.arange(len(group)) - 1
    total = np.cumsum(partners)
    at = 0
    while at < len(group):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, "right")))
        n = partners[at:to]
        a = np.repeat(np.arange(at, to), n)
        b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + a + 1
        keep = ~across[a] | (side[a] != side[b])
        yield a[keep], b[keep]
        at = to


class Forest:
    """Which numbers are connected so far."""

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.root.setdefault(x, x) != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True


def spanning(u, v) -> list[tuple[int, int]]:
    """Edges that connect what (u, v) connects, without cycles."""
    forest = Forest()
    return [(x, y) for x, y in zip(u, v) if forest.join(x, y)]
