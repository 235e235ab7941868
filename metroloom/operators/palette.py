"""Line colours (J15, A15, G8, G9, G16, O7): the meeting graph on Spark, the small searches on the driver."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.colour import delta_e

LOOSE = 10.0


def meeting_graph(station_lines: DataFrame, families: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b), a < b, of families that share a station or are joined by a walk.

    station_lines: station_id, line_id; families: family, line_ids; links: a_id, b_id. Families are
    made distinct at each station first, so a station with very many lines sends few rows on."""
    of_line = families.select("family", F.explode("line_ids").alias("line_id")).distinct()
    at = station_lines.join(of_line, "line_id").select("station_id", "family").distinct()
    x, y = at.select("station_id", F.col("family").alias("a")), at.select("station_id", F.col("family").alias("b"))
    shared = x.join(y, "station_id").filter("a <> b").select("a", "b")
    over = links.join(x.withColumnRenamed("station_id", "a_id"), "a_id").join(y.withColumnRenamed("station_id", "b_id"), "b_id").filter("a <> b").select("a", "b")
    return shared.union(over).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def measure_pairs(grid: list[tuple[str, str]]) -> dict[tuple[int, int], float]:
    """The smaller of both modes' colour distances of every pair of (light, dark) candidates."""
    return {(i, j): min(delta_e(grid[i][0], grid[j][0]), delta_e(grid[i][1], grid[j][1])) for i, j in combinations(range(len(grid)), 2)}


def max_clique(n: int, ok: Callable[[int, int], bool]) -> list[int]:
    """A largest set of pairwise compatible items, smallest items first among equals (G8): branch and bound."""
    near = [{j for j in range(n) if j != i and ok(min(i, j), max(i, j))} for i in range(n)]
    best: list[int] = []

    def grow(held: list[int], left: list[int]) -> None:
        nonlocal best
        if len(held) > len(best):
            best = held
        for k, i in enumerate(left):
            if len(held) + len(left) - k <= len(best):
                return
            grow([*held, i], [j for j in left[k + 1 :] if j in near[i]])

    grow([], list(range(n)))
    return best


def assign(families: list[str], meets: set[frozenset[str]], colours: int, strict: Callable[[int, int], bool], distance: dict[tuple[int, int], float], loose: float = LOOSE) -> dict[str, int] | None:
    """A colour for each family, all different (G9, O7): strict for pairs that meet, at least ``loose`` otherwise.

    Families that meet most others go first; None if there is no assignment."""
    degree = {f: sum(f in m for m in meets) for f in families}
    order = sorted(families, key=lambda f: -degree[f])
    chosen: dict[str, int] = {}

    def fits(f: str, c: int) -> bool:
        for g, d in chosen.items():
            pair = (min(c, d), max(c, d))
            if c == d or not (strict(*pair) if frozenset((f, g)) in meets else distance[pair] >= loose):
                return False
        return True

    def place(k: int) -> bool:
        if k == len(order):
            return True
        for c in range(colours):
            if fits(order[k], c):
                chosen[order[k]] = c
                if place(k + 1):
                    return True
                del chosen[order[k]]
        return False

    return dict(chosen) if place(0) else None
