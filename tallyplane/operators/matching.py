"""Matchings within small groups: least-cost maximum matching, greedy assignment, greedy thinning, overlap components. Each group is a panel or a page."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def transport(places: list[tuple[float, int, int]], tolerance: float) -> list[tuple[int, int, int]]:
    """Least cost for the most pairs of places (value, number on the left, number on the right), values rising: (place left, place right, pairs).

    One sweep. Its state is how many of one side wait for a partner (left ones count up, right ones down). What a state is worth, pairs
    before cost, is concave in it: steps[0] holds the steps up from zero and steps[1] those down, the ones next to zero last. A gap makes
    each step away from zero dearer by its width; a place puts in one step as long as its number; those too far from the next place
    fall off the far end. The way back then tells how many of each place take part, and of these the latest are the ones that wait.
    """
    steps: tuple[list, list] = ([], [])  # (-1 for a step that gains a pair away from zero else 1, minus its cost less its shift, length)
    near, held, length = (deque(), deque()), [0, 0], [0, 0]
    events = []
    for at, (x, *numbers) in enumerate(places):
        for side, m in enumerate(numbers):
            if not m:
                continue
            own, other = steps[side], steps[1 - side]
            i = bisect_left(other, (-1, x))
            if i < len(other):
                events.append((at, side, m, -sum(n for *_, n in other[i:])))
                other.insert(i, (-1, x, m))
                left = m
                while left:
                    gain, cost, n = other.pop()
                    if n > left:
                        other.append((gain, cost, n - left))
                    own.append((-gain, 2 * x - cost, min(n, left)))
                    left -= min(n, left)
            else:
                i = bisect_left(own, (1, x, float("inf")))
                events.append((at, side, m, sum(n for *_, n in own[i:])))
                own.insert(i, (1, x, m))
            length[side] += m
            near[side].append((x, m))
            held[side] += m
        if at + 1 < len(places):
            for side in (0, 1):
                while near[side] and places[at + 1][0] - near[side][0][0] > tolerance:
                    held[side] -= near[side].popleft()[1]
                while length[side] > held[side]:
                    gain, cost, n = steps[side].pop(0)
                    over = min(n, length[side] - held[side])
                    if n > over:
                        steps[side].insert(0, (gain, cost, n - over))
                    length[side] -= over
    state, taken = 0, []
    for _, side, m, best in reversed(events):
        up = -1 if side else 1
        taken.append(min(max(up * state - best, 0), m))
        state -= up * taken[-1]
    waiting, pairs = deque(), []
    for (at, side, m, _), j in zip(events, reversed(taken)):
        up = -1 if side else 1
        meet = min(j, max(-up * state, 0))
        state += up * j
        rest = m - meet
        while meet:
            other, n = waiting.popleft()
            pairs.append((other, at, min(n, meet)) if side else (at, other, min(n, meet)))
            if n > meet:
                waiting.appendleft((other, n - meet))
            meet -= min(n, meet)
        if up * state > 0:
            waiting.append((at, rest))
            over = sum(n for _, n in waiting) - up * state
            while over:
                other, n = waiting.popleft()
                if n > over:
                    waiting.appendleft((other, n - over))
                over -= min(n, over)
    return pairs


def least_cost(left: list[float], right: list[float], tolerance: float) -> list[tuple[int, int]]:
    """Least cost for the most pairs of one left and one right value at most tolerance apart, as their indices."""
    at: dict[float, tuple[list, list]] = {}
    for side, values in enumerate((left, right)):
        for i, v in enumerate(values):
            at.setdefault(v, ([], []))[side].append(i)
    places = [(v, *at[v]) for v in sorted(at)]
    out, used = [], [[0, 0] for _ in places]
    for p, q, n in transport([(v, len(a), len(b)) for v, a, b in places], tolerance):
        i, j = used[p][0], used[q][1]
        out += zip(places[p][1][i : i + n], places[q][2][j : j + n])
        used[p][0], used[q][1] = i + n, j + n
    return sorted(out)


#: Most equal pairs in one row between the matching and their expansion.
PAIRS_A_ROW = 10_000


def match(marks: DataFrame, truth: DataFrame, by: str, a: str, b: str, tolerance: float) -> DataFrame:
    """(by, a, b) of the matched values of each group. Equal values are counted first, so a group's task holds its distinct values only; values that are null or not finite match nothing."""

    def side(df: DataFrame, x: str, left: int) -> DataFrame:
        v = F.col(x).cast("double")
        return df.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))).groupBy(by, v.alias("_v")).agg((F.count("*") * left).alias("_n"), (F.count("*") * (1 - left)).alias("_m"))

    schema = marks.select(by).schema.add(a, "double").add(b, "double").add("_n", "long")
    arrow = to_arrow_schema(schema)

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        places = sorted(zip(*[table.column(c).to_pylist() for c in ("_v", "_n", "_m")]))
        rows = [(key[0].as_py(), places[p][0], places[q][0], min(n - k, PAIRS_A_ROW)) for p, q, n in transport(places, tolerance) for k in range(0, n, PAIRS_A_ROW)]
        return pa.Table.from_pylist([dict(zip(arrow.names, r)) for r in rows], schema=arrow)

    counts = side(marks, a, 1).unionByName(side(truth, b, 0)).groupBy(by, "_v").agg(F.sum("_n").alias("_n"), F.sum("_m").alias("_m"))
    found = counts.groupBy(by).applyInArrow(one, schema)
    return found.select(by, a, b, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i")).drop("_i")


def assign_greedily(scores: DataFrame, by: str, caption: str, region: str, score: str, margin: float) -> DataFrame:
    """One region for each caption, the highest score first. AMBIGUOUS if its two best free regions are within margin, TAKEN if others hold all, NO_CANDIDATE without any."""
    t = dict(scores.dtypes)
    arrow = to_arrow_schema(scores.select(by, caption, region).schema.add("state", "string"))

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        last = lambda x: (x is None or x != x, 0 if x is None or x != x else x)
        rows = list(zip(*[table.column(c).to_pylist() for c in (score, caption, region)]))
        rows.sort(key=lambda r: (last(None if r[0] is None else -r[0]), last(r[1]), last(r[2])))
        # the rows of a caption, best first; captions come in the order of their best row
        mine: dict = {}
        for s, c, r in rows:
            at = mine.setdefault(c, [])
            if c is not None and r is not None:
                at.append((s, r))
        regions, states, used = [], [], set()
        for at in mine.values():
            free = list(islice(((s, r) for s, r in at if r not in used), 2))
            if not free:
                regions.append(None)
                states.append("TAKEN" if at else "NO_CANDIDATE")
            elif len(free) > 1 and None not in (free[0][0], free[1][0]) and free[0][0] - free[1][0] <= margin:
                regions.append(None)
                states.append("AMBIGUOUS")
            else:
                regions.append(free[0][1])
                states.append("ASSIGNED")
                used.add(free[0][1])
        return pa.Table.from_pydict({by: [key[0].as_py()] * len(mine), caption: list(mine), region: regions, "state": states}, schema=arrow)

    return scores.select(by, caption, region, score).groupBy(by).applyInArrow(one, f"{by} {t[by]}, {caption} {t[caption]}, {region} {t[region]}, state string")


def thin(points: DataFrame, by: str, x: str, distance: float) -> DataFrame:
    """Each group's values, in order, that lie more than distance from the last kept one."""

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        kept: list[float] = []
        for v in sorted(pdf[x]):
            if not kept or v - kept[-1] > distance:
                kept.append(v)
        return pd.DataFrame({by: [key[0]] * len(kept), x: kept})

    return points.select(by, x).groupBy(by).applyInPandas(one, f"{by} {dict(points.dtypes)[by]}, {x} double")
