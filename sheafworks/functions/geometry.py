"""Boxes as struct<x, y, width, height>: overlaps, containment, conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), w.alias("width"), h.alias("height"))


def valid(b: Column) -> Column:
    return (b["width"] >= 0) & (b["height"] >= 0)


def area(b: Column) -> Column:
    return b["width"] * b["height"]


def overlap_area(a: Column, b: Column) -> Column:
    """0 unless both extents overlap; null if a box is null."""
    dx = F.least(a["x"] + a["width"], b["x"] + b["width"]) - F.greatest(a["x"], b["x"])
    dy = F.least(a["y"] + a["height"], b["y"] + b["height"]) - F.greatest(a["y"], b["y"])
    zero = F.lit(0.0)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(zero, dx) * F.greatest(zero, dy))


def distance(a: Column, b: Column) -> Column:
    """Between the nearest points of two boxes, 0 where they meet."""
    dx = F.greatest(a["x"] - (b["x"] + b["width"]), b["x"] - (a["x"] + a["width"]), F.lit(0.0))
    dy = F.greatest(a["y"] - (b["y"] + b["height"]), b["y"] - (a["y"] + a["height"]), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), F.hypot(dx, dy))


def is_close(a: Column, b: Column, rel: float = 1e-9, abs_: float = 0.0) -> Column:
    return F.abs(a - b) <= F.greatest(rel * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_))


def contained(inner: Column, outer: Column) -> Column:
    return is_close(overlap_area(inner, outer), area(inner))


def overlap_ratio(word: Column, entity: Column) -> Column:
    """Share of the word's area inside the entity; null for a word without area."""
    return F.try_divide(overlap_area(word, entity), area(word))


def rescale(b: Column, fx: Column, fy: Column) -> Column:
    return box(b["x"] * fx, b["y"] * fy, b["width"] * fx, b["height"] * fy)


def yolo_box(b: Column, page_width: Column, page_height: Column) -> Column:
    """Centre and size as shares of the page."""
    return F.struct(
        ((b["x"] + b["width"] / 2) / page_width).alias("cx"),
        ((b["y"] + b["height"] / 2) / page_height).alias("cy"),
        (b["width"] / page_width).alias("w"),
        (b["height"] / page_height).alias("h"),
    )


def corner_box(b: Column) -> Column:
    """[left, top, right, bottom], truncated to integers."""
    return F.array(*[v.cast("bigint") for v in (b["x"], b["y"], b["x"] + b["width"], b["y"] + b["height"])])


def from_corners(c: Column) -> Column:
    return box(c[0], c[1], c[2] - c[0], c[3] - c[1])
