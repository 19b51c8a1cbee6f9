"""Cutting stock by column generation: which mixtures of piece lengths fill sequences with least left over."""

from __future__ import annotations

import numpy as np

Pattern = tuple[dict[int, int], int]


def price(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of whole pieces within the capacity: knapsack by dynamic programming."""
    best, came = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            gain = value[:n] + best[room - sizes[:n]]
            top = gain.argmax()
            if gain[top] > best[room] + 1e-12:
                best[room], came[room] = gain[top], top
    pattern, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if came[room] < 0:
            room -= 1
        else:
            pattern[came[room]] += 1
            room -= sizes[came[room]]
    return float(best[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional uses that cover ``demand`` with fewest sequences.

    Revised simplex that keeps the inverse of the basis; a column enters if its pieces are
    worth more than a sequence at the current prices. Ends when the bound from the best
    column proves the result within ``gap`` of the optimum.
    """
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    for _ in range(most):
        used = inverse @ demand
        value = inverse.sum(0)
        worth, pattern = price(np.maximum(value, 0), sizes, capacity)
        total = used.sum()
        if worth <= 1 + 1e-9 or total - total / worth <= gap * total:
            break
        enter = inverse @ pattern
        ratio = np.where(enter > 1e-9, used / np.where(enter > 1e-9, enter, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        row = inverse[leave] / enter[leave]
        inverse -= np.outer(enter, row)
        inverse[leave] = row
        basis[:, leave] = pattern
    return basis, np.maximum(np.linalg.solve(basis, demand), 0) if m else np.zeros(0)


def patterns(histogram: dict[int, int], capacity: int, gap: float = 0.001, most: int = 20_000) -> list[Pattern]:
    """Patterns {size: pieces} with how often each is used, which together hold exactly the pieces of ``histogram``.

    Whole parts of the relaxed solution are taken; what they leave over, at most a few pieces
    per size, is filled largest first. The work depends on the number of sizes, not of pieces.
    """
    sizes = np.array(sorted(k for k, n in histogram.items() if n), dtype=np.int64)
    left = np.array([histogram[int(k)] for k in sizes], dtype=np.int64)
    out: list[Pattern] = []
    if not len(sizes):
        return out
    basis, used = relaxed(sizes, left.astype(float), capacity, gap, most)
    for column in np.argsort(-used, kind="stable"):
        pattern = np.rint(basis[:, column]).astype(np.int64)
        taken = pattern > 0
        times = int(min(np.floor(used[column] + 1e-7), (left[taken] // pattern[taken]).min()))
        if times > 0:
            left -= times * pattern
            out.append(({int(s): int(p) for s, p in zip(sizes[taken], pattern[taken], strict=True)}, times))
    while left.any():
        room, pattern = capacity, np.zeros(len(sizes), dtype=np.int64)
        for k in np.flatnonzero(left)[::-1]:
            pattern[k] = min(left[k], room // sizes[k])
            room -= pattern[k] * sizes[k]
        taken = pattern > 0
        times = int((left[taken] // pattern[taken]).min())
        left -= times * pattern
        out.append(({int(s): int(p) for s, p in zip(sizes[taken], pattern[taken], strict=True)}, times))
    return out
