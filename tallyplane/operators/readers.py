"""Pixel readers: marks of coloured lines, bars, boxes and scattered points, one panel a row.

Panels (with their raster's bytes) are read in mapInPandas, so that any number of panels spreads over tasks and nothing is
grouped or collected. A reader refuses rather than guesses: what it cannot tell apart gives no row for that position,
and the declared position stays empty. Values come from pixels by expressions afterwards.

A panel's boxes are x0, x1, y0, y1 with y downwards; positions are declared as label and pixel; series as name, colour and tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Least ink of a marker's row, least rows of a marker, and half the window around a declared position.
ROW_INK, MARKER_ROWS, WINDOW = 5, 4, 12
#: How much a rule of a box may differ in width from the widest.
RULE_TOLERANCE = 0.12
#: Pixels that a scattered point must have.
POINT_PIXELS = 9


def colour_mask(rgb: np.ndarray, colour, tolerance: float) -> np.ndarray:
    d = rgb.astype(np.int32) - np.asarray(colour, np.int32)
    return (d * d).sum(axis=2) <= tolerance * tolerance


def spans(rows: np.ndarray, gap: int = 1) -> list[tuple[int, int]]:
    """First and last of each run of sorted numbers whose steps are at most gap."""
    if not len(rows):
        return []
    cut = np.flatnonzero(np.diff(rows) > gap)
    return list(zip(rows[np.r_[0, cut + 1]].tolist(), rows[np.r_[cut, len(rows) - 1]].tolist(), strict=True))


def marker_at(mask: np.ndarray, x: float, box, half: int = WINDOW):
    """(centre, top, bottom, both caps seen) of the marker at a declared x, or None."""
    _, _, y0, y1 = box
    c = int(round(x))
    lo = max(0, c - half)
    ink = mask[y0:y1, lo : c + half + 1].sum(axis=1)
    bands = spans(np.flatnonzero(ink >= ROW_INK))
    if not bands:
        return None
    a, b = max(bands, key=lambda s: (s[1] - s[0], ink[s[0] : s[1] + 1].sum()))
    if b - a + 1 < MARKER_ROWS:
        return None
    centre = (a + b) / 2
    over = [s for s in bands if s[1] < a]
    under = [s for s in bands if s[0] > b]
    stem = spans(np.flatnonzero(mask[y0:y1, max(0, c - 1) : c + 2].any(axis=1)), 2)
    reach = next((s for s in stem if s[0] - 2 <= centre <= s[1] + 2), (a, b))
    top = sum(over[-1]) / 2 if over else reach[0]
    bottom = sum(under[0]) / 2 if under else reach[1]
    return y0 + centre, y0 + top, y0 + bottom, bool(over and under)


def read_lines(rgb, box, positions, series) -> list[dict]:
    """A marker of each series at each declared position; one that another series' colour claims too is told."""
    masks = {n: colour_mask(rgb, c, t) for n, c, t in series}
    out = []
    for name, mask in masks.items():
        for label, x in positions:
            if m := marker_at(mask, x, box):
                row, col = int(round(m[0])), int(round(x))
                shared = sum(bool(o[row - 1 : row + 2, col - 1 : col + 2].any()) for k, o in masks.items() if k != name)
                out.append({"series": name, "position": label, "x": float(x), "y": m[0], "upper": m[1], "lower": m[2], "stem": m[3], "overlap": shared})
    return out


def read_bars(rgb, box, positions, series, baseline: float) -> list[dict]:
    """Bars that stand on the baseline; each belongs to the nearest declared slot of its series, within half the least distance of slots. Two bars of a series at one slot are refused."""
    xs = np.array([x for _, x in positions], float)
    limit = np.diff(np.sort(xs)).min() / 2 if len(xs) > 1 else box[1] - box[0]
    base, out = int(round(baseline)), []
    for name, colour, tolerance in series:
        mask = colour_mask(rgb, colour, tolerance)
        foot = mask[max(box[2], base - 4) : base + 5, box[0] : box[1]].any(axis=0)
        at: dict[str, list[dict]] = {}
        for a, b in spans(np.flatnonzero(foot), 1):
            if b - a < 3:
                continue
            part = mask[box[2] : box[3], box[0] + a : box[0] + b + 1].mean(axis=1)
            body = spans(np.flatnonzero(part >= 0.5), 2)
            body = next((s for s in body if s[0] <= base - box[2] + 4 and s[1] >= base - box[2] - 4), None)
            if body is None:
                continue
            up = base - box[2] - body[0] >= body[1] - (base - box[2])
            centre = box[0] + (a + b) / 2
            k = int(np.argmin(np.abs(xs - centre)))
            if abs(xs[k] - centre) <= limit:
                at.setdefault(positions[k][0], []).append({"series": name, "position": positions[k][0], "x": centre, "y": float(box[2] + (body[0] if up else body[1])), "upper": None, "lower": None, "stem": False, "overlap": 0})
        out += [v[0] for v in at.values() if len(v) == 1]
    return out


def longest_runs(rows: np.ndarray, centre: int) -> np.ndarray:
    """For each row the length of the run of ink over the centre column."""
    out = np.zeros(len(rows), int)
    for i, r in enumerate(rows):
        if r[centre]:
            left = np.flatnonzero(~r[: centre + 1])
            right = np.flatnonzero(~r[centre:])
            out[i] = centre + (right[0] if len(right) else len(r) - centre) - (left[-1] + 1 if len(left) else 0)
    return out


def read_boxes(mask, box, positions) -> list[dict]:
    """Five rows of each box: three rules of one width, and the ends of the stem on either side; anything else is refused."""
    xs = [x for _, x in positions]
    half = int(0.45 * (min(abs(a - b) for a, b in zip(xs, xs[1:], strict=False)) if len(xs) > 1 else (box[1] - box[0]) / 2))
    out = []
    for label, x in positions:
        c = int(round(x))
        part = mask[box[2] + 1 : box[3] - 1, max(box[0], c - half) : min(box[1], c + half + 1)]
        mid = c - max(box[0], c - half)
        width = longest_runs(part, mid)
        rules = None
        for w in sorted({int(v) for v in width if v > 4}, reverse=True):
            bands = spans(np.flatnonzero(width >= w * (1 - RULE_TOLERANCE)), 2)
            if len(bands) == 3:
                rules = bands
                break
        if rules is None:
            continue
        stem = spans(np.flatnonzero(part[:, max(0, mid - 1) : mid + 2].any(axis=1)), 2)
        over = next((s for s in stem if s[0] < rules[0][0] and s[1] >= rules[0][0] - 2), None)
        under = next((s for s in reversed(stem) if s[1] > rules[2][1] and s[0] <= rules[2][1] + 2), None)
        if over is None or under is None:
            continue
        y = box[2] + 1
        q = [y + sum(r) / 2 for r in rules]
        out.append({"series": "", "position": label, "x": float(x), "y": q[1], "upper": q[0], "lower": q[2], "whisker_top": float(y + over[0]), "whisker_bottom": float(y + under[1]), "stem": True, "overlap": 0})
    return out


def labelled(mask: np.ndarray) -> list[np.ndarray]:
    """Pixels of each connected piece (8 neighbours), by joining runs of neighbouring rows."""
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs, before = [], []
    for y in range(mask.shape[0]):
        now = []
        for a, b in spans(np.flatnonzero(mask[y])):
            k = len(parent)
            parent.append(k)
            for p, q, j in before:
                if p <= b + 1 and q >= a - 1:
                    parent[root(j)] = root(k)
            now.append((a, b, k))
        runs += [(y, a, b, k) for a, b, k in now]
        before = now
    pieces: dict[int, list[np.ndarray]] = {}
    for y, a, b, k in runs:
        pieces.setdefault(root(k), []).append(np.stack([np.full(b - a + 1, y), np.arange(a, b + 1)], axis=1))
    return [np.concatenate(p) for p in pieces.values()]


def read_points(rgb, box, series) -> list[dict]:
    """The centre and area of each piece of a series' colour that is large enough."""
    out = []
    for name, colour, tolerance in series:
        mask = colour_mask(rgb, colour, tolerance)[box[2] : box[3], box[0] : box[1]]
        for k, p in enumerate(sorted((p for p in labelled(mask) if len(p) >= POINT_PIXELS), key=lambda p: (p[:, 1].mean(), p[:, 0].mean()))):
            out.append({"series": name, "position": str(k + 1), "x": float(box[0] + p[:, 1].mean()), "y": float(box[2] + p[:, 0].mean()), "area": float(len(p)), "stem": False, "overlap": 0})
    return out


FIELDS = ("series", "position", "x", "y", "upper", "lower", "whisker_top", "whisker_bottom", "area", "stem", "overlap")
SCHEMA = "panel string, mark_type string, state string, series string, position string, x double, y double, upper double, lower double, whisker_top double, whisker_bottom double, area double, stem boolean, overlap int"


def read_panel(row) -> tuple[str, list[dict]]:
    """(state, marks) of one panel."""
    raw = np.frombuffer(row.data, np.uint8)
    rgb = raw.reshape(row.height, row.width, -1)[:, :, 2::-1]  # rasters hold blue, green, red
    box = tuple(row.box)
    if not (0 <= box[0] < box[1] <= row.width and 0 <= box[2] < box[3] <= row.height):
        return "PANEL_GEOMETRY_UNRESOLVED", []
    positions = [(p["label"], p["x"]) for p in row.positions]
    series = [(s["name"], list(s["rgb"]), s["tolerance"]) for s in row.series]
    kind = row.mark_type
    if kind in ("LINE_COLOR", "BAR_COLOR", "SCATTER") and not series:
        return "SERIES_IDENTITY_UNRESOLVED", []
    if kind == "LINE_COLOR":
        marks = read_lines(rgb, box, positions, series)
    elif kind == "BAR_COLOR":
        marks = read_bars(rgb, box, positions, series, row.baseline)
    elif kind == "BOX_VIOLIN":
        ink = colour_mask(rgb, series[0][1], series[0][2]) if series else rgb.mean(axis=2) < 100
        marks = read_boxes(ink, box, positions)
    elif kind == "SCATTER":
        marks = read_points(rgb, box, series)
    else:
        return "NO_READER_AVAILABLE", []
    return ("READ" if marks else "MANUAL_POINT_READ"), marks


def read_panels(panels: DataFrame) -> DataFrame:
    """Marks of every panel; a panel without marks gives one row with its state.

    panels: panel, mark_type, height, width, data, box (array of 4), positions (array of label, x), series (array of name, rgb, tolerance), baseline.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                state, marks = read_panel(r)
                rows += [{"panel": r.panel, "mark_type": r.mark_type, "state": state, **{f: m.get(f) for f in FIELDS}} for m in marks or [{}]]
            out = pd.DataFrame(rows, columns=["panel", "mark_type", "state", *FIELDS])
            yield out.astype({c: "float64" for c in ("x", "y", "upper", "lower", "whisker_top", "whisker_bottom", "area")}).astype({"stem": "boolean", "overlap": "Int32"})

    return panels.select("panel", "mark_type", "height", "width", "data", "box", "positions", "series", "baseline").mapInPandas(run, SCHEMA)
