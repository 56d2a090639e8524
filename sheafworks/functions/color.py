"""Colours of entity categories: conversions (hue 0-179, saturation and value 0-255) and cycles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """[red, green, blue] as integers, rounded; the hue is in half degrees."""

    def channel(n: int) -> Column:
        k = F.pmod(F.lit(float(n)) + h / 30.0, F.lit(6.0))
        return F.round(v - v * (s / 255.0) * F.greatest(F.lit(0.0), F.least(k, F.lit(4.0) - k, F.lit(1.0)))).cast("int")

    return F.array(channel(5), channel(3), channel(1))


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """[hue, saturation, value] as integers, rounded."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    part = F.when(span == 0, 0.0).when(top == r, F.pmod((g - b) / span, F.lit(6.0))).when(top == g, (b - r) / span + 2.0).otherwise((r - g) / span + 4.0)
    return F.array((F.round(part * 30.0) % 180).cast("int"), F.when(top == 0, 0).otherwise(F.round(span * 255.0 / F.greatest(top, F.lit(1)))).cast("int"), top.cast("int"))


def rgb_to_hex(rgb: Column) -> Column:
    two = lambda k: F.lower(F.lpad(F.hex(F.pmod(rgb[k], F.lit(256))), 2, "0"))
    return F.concat(F.lit("#"), two(0), two(1), two(2))


def cycled_value(position: Column, start: int = 255, step: int = 2, least: int = 200) -> Column:
    """The value of the position-th (from 0) box of a category: from ``start`` down by ``step`` to ``least``, then again."""
    return (start - step * F.pmod(position, F.lit((start - least) // step + 1))).cast("int")


def table_cycle(position: Column, sat: int = 255, val: int = 255, step: int = 2, least: int = 50) -> Column:
    """(saturation, value) of a table's position-th cell (from 0): the value goes down by ``step`` to ``least``; then it begins again
    with a saturation less by ``step``, which begins again below ``least``."""
    values, sats = (val - least) // step + 1, (sat - least) // step + 1
    s = sat - step * F.pmod(F.floor(position / values), F.lit(sats))
    return F.struct(s.cast("int").alias("s"), (val - step * F.pmod(position, F.lit(values))).cast("int").alias("v"))
