"""Drawn panels are read back."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyplane.operators import readers as P
from tallyplane.sources import manifests as M

RED, BLUE = (220, 30, 30), (30, 30, 220)


def png(rgb):
    h, w, _ = rgb.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + rgb[y].tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def blank():
    return np.full((300, 400, 3), 255, np.uint8)


def line_panel():
    a = blank()
    for x, y in ((100, 80), (200, 120), (300, 160)):
        a[y - 5 : y + 6, x - 5 : x + 6] = RED
        a[y - 30 : y + 31, x] = RED
        for cap in (y - 30, y + 30):
            a[cap - 1 : cap + 2, x - 6 : x + 7] = RED
    a[230:241, 95:106] = BLUE
    return a


def bar_panel():
    a = blank()
    a[100:251, 90:111] = RED
    a[150:251, 190:211] = RED
    a[60:251, 115:136] = BLUE
    return a


def box_panel():
    a = blank()
    a[100:201, 80] = a[100:201, 120] = 0
    for y in (100, 140, 200):
        a[y - 1 : y + 2, 80:121] = 0
    a[50:100, 100] = a[200:260, 100] = 0
    a[49:52, 92:109] = a[259:262, 92:109] = 0
    return a


def points_panel():
    a = blank()
    for x, y in ((60, 60), (120, 90), (200, 200)):
        a[y - 3 : y + 4, x - 3 : x + 4] = RED
    a[100:102, 100:102] = RED
    return a


@pytest.fixture(scope="module")
def read(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("rasters")
    series = [{"name": "R", "rgb": list(RED), "tolerance": 60.0}, {"name": "B", "rgb": list(BLUE), "tolerance": 60.0}]
    rows = []
    for n, kind, a, pos, s in (("line", "LINE_COLOR", line_panel(), (100, 200, 300), series), ("bar", "BAR_COLOR", bar_panel(), (100, 200), series[:1]), ("box", "BOX_VIOLIN", box_panel(), (100, 300), []), ("points", "SCATTER", points_panel(), (), series[:1]), ("none", "LINE_COLOR", blank(), (100,), series), ("odd", "PIE", blank(), (), []), ("nameless", "SCATTER", blank(), (), [])):
        (d / f"{n}.png").write_bytes(png(a))
        rows.append((n, kind, [0, 400, 0, 300], [{"label": f"T{i}", "x": float(x)} for i, x in enumerate(pos)], s, 250.0))
    panels = spark.createDataFrame(rows, "panel string, mark_type string, box array<int>, positions array<struct<label:string,x:double>>, series array<struct<name:string,rgb:array<int>,tolerance:double>>, baseline double")
    images = M.rasters(spark, str(d)).withColumn("panel", F.regexp_extract("origin", r"([^/]+)\.png$", 1))
    return P.read_panels(panels.join(images, "panel")).collect()


def test_line(read):
    got = {(r["series"], r["position"]): r for r in read if r["panel"] == "line"}
    assert {k: r["y"] for k, r in got.items()} == {("R", "T0"): 80, ("R", "T1"): 120, ("R", "T2"): 160, ("B", "T0"): 235}
    assert (got["R", "T0"]["upper"], got["R", "T0"]["lower"], got["R", "T0"]["stem"]) == (50, 110, True) and not got["B", "T0"]["stem"]


def test_bar(read):
    assert {(r["series"], r["position"]): r["y"] for r in read if r["panel"] == "bar"} == {("R", "T0"): 100, ("R", "T1"): 150}


def test_box(read):
    (r,) = [r for r in read if r["panel"] == "box"]
    assert (r["position"], r["upper"], r["y"], r["lower"]) == ("T0", 100, 140, 200)
    assert abs(r["whisker_top"] - 50) <= 2 and abs(r["whisker_bottom"] - 260) <= 2


def test_points(read):
    assert [(r["x"], r["y"], r["area"]) for r in read if r["panel"] == "points"] == [(60, 60, 49), (120, 90, 49), (200, 200, 49)]


def test_refusals(read):
    assert {r["panel"]: r["state"] for r in read if r["position"] is None} == {"none": "MANUAL_POINT_READ", "odd": "NO_READER_AVAILABLE", "nameless": "SERIES_IDENTITY_UNRESOLVED"}
