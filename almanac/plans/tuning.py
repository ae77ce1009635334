"""Search spaces and candidate grids (M1).

A space maps a parameter to ``["quniform", "int"|"float", low, high, q]`` or
``["choice", option, ...]``. Candidates are control data (a handful of parameter sets
derived from the config), so they are built in Python and enter Spark plans as literals.
"""

from __future__ import annotations

import math
import random


def _axis(spec: list) -> list:
    kind = spec[0]
    if kind == "quniform":
        typ, low, high, q = spec[1], float(spec[2]), float(spec[3]), float(spec[4])
        lo_k, hi_k = math.ceil(low / q - 1e-9), math.floor(high / q + 1e-9)
        values = [round(k * q, 10) for k in range(lo_k, hi_k + 1)]
        return [int(round(v)) for v in values] if typ == "int" else values
    if kind == "choice":
        return list(spec[1:])
    raise ValueError(f"unsupported distribution {kind!r}")


def grid_size(space: dict) -> int:
    return math.prod(len(_axis(spec)) for spec in space.values())


def grid_point(space: dict, index: int) -> dict:
    """Combination ``index`` of the grid (last parameter fastest), without building the grid."""
    point = {}
    for name in reversed(list(space)):
        axis = _axis(space[name])
        index, at = divmod(index, len(axis))
        point[name] = axis[at]
    return {name: point[name] for name in space}


def full_grid(space: dict) -> list[dict]:
    """Every combination, parameters in the order given, values ascending (small spaces only)."""
    return [grid_point(space, i) for i in range(grid_size(space))]


def candidate_grid(space: dict, limit: int, method: str = "random", seed: int = 42) -> list[dict]:
    """At most ``limit`` candidates, picked by index: the grid itself is never built.

    ``random`` (default): a seeded sample without replacement, in grid order. With a handful
    of trials a sequential optimiser draws its first points at random too.
    ``spread``: points ``floor(i * size / limit)`` of the grid, so the picks span it evenly.
    """
    size = grid_size(space)
    if limit <= 0 or size <= limit:
        return full_grid(space)
    if method == "spread":
        return [grid_point(space, (i * size) // limit) for i in range(limit)]
    if method == "random":
        rng, picks = random.Random(seed), set()
        while len(picks) < limit:
            picks.add(rng.randrange(size))
        return [grid_point(space, i) for i in sorted(picks)]
    raise ValueError(f"unknown method {method!r}")
