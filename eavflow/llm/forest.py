"""Links found between rows of a tile, kept as a spanning forest."""

from __future__ import annotations

import numpy as np


class Forest:
    """Components of ``n`` rows.  ``edges`` are at most n - 1 pairs of rows that connect what is linked."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        new = a != b
        if not new.any():
            return
        pairs = np.unique(np.column_stack([np.maximum(a[new], b[new]), np.minimum(a[new], b[new])]), axis=0)
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while x in up:
                if up[x] in up:
                    up[x] = up[up[x]]
                x = up[x]
            return x

        for x, y in pairs.tolist():
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
                self.edges.append((max(x, y), min(x, y)))
        to = np.arange(len(self.label))
        for x in up:
            to[x] = root(x)
        self.label = to[self.label]
