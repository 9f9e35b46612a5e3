"""Colours: sRGB to OKLCh and the registered buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Buckets of the registry.
BUCKETS = ("black", "blue", "brown", "cyan", "gray", "green", "orange", "other", "pink", "purple", "red", "white", "yellow")
#: Linear sRGB to LMS, and roots of LMS to OKLab.
LMS = ((0.4122214708, 0.5363325363, 0.0514459929), (0.2119034982, 0.6806995451, 0.1073969566), (0.0883024619, 0.2817188376, 0.6299787005))
LAB = ((0.2104542553, 0.7936177850, -0.0040720468), (1.9779984951, -2.4285922050, 0.4505937099), (0.0259040371, 0.7827717662, -0.8086757660))
#: Hue ranges that follow black, white, gray, brown and red.
HUES = (("orange", 25.0, 55.0), ("yellow", 55.0, 85.0), ("green", 85.0, 165.0), ("cyan", 165.0, 215.0), ("blue", 215.0, 270.0), ("purple", 270.0, 310.0), ("pink", 310.0, 345.0))


def srgb8_to_oklch(r: Column, g: Column, b: Column) -> Column:
    """struct(l, c, h): lightness, chroma, hue in degrees from 0 to 360."""

    def linear(v: Column) -> Column:
        u = v / 255.0
        return F.when(u <= 0.04045, u / 12.92).otherwise(F.pow((u + 0.055) / 1.055, F.lit(2.4)))

    rgb = [linear(v) for v in (r, g, b)]
    dot = lambda row, v: sum((F.lit(k) * x for k, x in zip(row[1:], v[1:])), F.lit(row[0]) * v[0])
    roots = [F.cbrt(dot(row, rgb)) for row in LMS]
    light, a, bb = (dot(row, roots) for row in LAB)
    hue = F.degrees(F.atan2(bb, a))
    return F.struct(light.alias("l"), F.hypot(a, bb).alias("c"), F.when(hue < 0, hue + 360.0).otherwise(hue).alias("h"))


def color_bucket(l: Column, c: Column, h: Column) -> Column:  # noqa: E741
    """The first rule that holds."""
    out = (
        F.when(l < 0.12, "black").when((l > 0.92) & (c < 0.08), "white").when(c < 0.05, "gray")
        .when((h >= 20.0) & (h < 75.0) & (l >= 0.12) & (l <= 0.60), "brown").when((h < 25.0) | (h >= 345.0), "red")
    )
    for name, low, high in HUES:
        out = out.when((h >= low) & (h < high), name)
    return out.otherwise("other")
