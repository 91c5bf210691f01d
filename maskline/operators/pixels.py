"""Pixel arrays: stretches, inversion, black fill, descriptors, verification states."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.binding import bind


def interpolated(ordered: Column, q: float) -> Column:
    """The q-quantile of a sorted array, linear between neighbours."""
    spot = F.lit(q) * (F.size(ordered) - 1)
    low = F.floor(spot).cast("int")
    a, b = F.element_at(ordered, low + 1), F.element_at(ordered, F.least(low + 2, F.size(ordered)))
    return a + (b - a) * (spot - low)


def stretch(px: Column, span: Column) -> Column:
    """px from span's low..high to 0..255, cut off outside, fractions dropped; all 0 where the range is empty. The span is computed once."""

    def run(s: Column) -> Column:
        one = lambda x: F.floor(F.least(F.greatest((x - s["low"]) / (s["high"] - s["low"]), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")
        return F.when(s["high"] > s["low"], F.transform(px, one)).otherwise(F.transform(px, lambda x: F.lit(0)))

    return bind(span, run)


def percentile_stretch(px: Column) -> Column:
    return stretch(px, bind(F.array_sort(px), lambda o: F.struct(interpolated(o, 0.01).alias("low"), interpolated(o, 0.99).alias("high"))))


def minmax_stretch(px: Column) -> Column:
    return stretch(px, F.struct(F.array_min(px).alias("low"), F.array_max(px).alias("high")))


def invert(px: Column) -> Column:
    return bind(F.array_max(px), lambda most: F.transform(px, lambda x: most - x))


def black_fill(px: Column, width: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """px (row by row) with the array's least value inside the box, cut to the frame."""

    def run(least: Column) -> Column:
        def one(x, i):
            col, row = i % width, F.floor(i / width)
            return F.when((col >= x1) & (col < x2) & (row >= y1) & (row < y2), least).otherwise(x)

        return F.transform(px, one)

    return bind(F.array_min(px), run)


def black_fill_frames(dtype: str):
    """The same for binary frames of a dtype: (content, frames, rows, cols, boxes) to content; all frames, Arrow batches."""

    @F.pandas_udf("binary")
    def run(content: pd.Series, frames: pd.Series, rows: pd.Series, cols: pd.Series, boxes: pd.Series) -> pd.Series:
        def one(data, f, r, c, found):
            a = np.frombuffer(data, dtype).reshape(int(f), int(r), int(c)).copy()
            least = a.min() if a.size else 0
            for b in found:
                a[:, max(0, b["y1"]) : max(0, b["y2"]), max(0, b["x1"]) : max(0, b["x2"])] = least
            return a.tobytes()

        return pd.Series([one(*x) for x in zip(content, frames, rows, cols, boxes)])

    return run


def descriptors(dtype: Column) -> Column:
    """Stored bits, highest bit, sign, and representation of an array's type; other types are written as uint16."""
    bits = F.when(dtype == "uint8", 8).otherwise(16)
    return F.struct(bits.alias("bits_allocated"), bits.alias("bits_stored"), (bits - 1).alias("high_bit"),
                    F.when(dtype == "int16", 1).otherwise(0).alias("signed"), F.when(bits <= 8, "OB").otherwise("OW").alias("vr"))


def verification(first_clean: Column, escalated: Column, second_clean: Column) -> Column:
    """The status after two tiers of checking."""
    return F.when(first_clean & ~escalated, "PASSED").when(second_clean, "PASSED (Escalated)").otherwise("FAILED")


def pixel_presence(has_pixels: Column, has_geometry: Column, samples: Column) -> Column:
    return (
        F.when(has_pixels & (samples > 1), "error: colour").when(has_pixels, "image")
        .when(has_geometry, "error: geometry without pixels").otherwise("metadata only")
    )
