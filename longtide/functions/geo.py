"""Points: place on a Hilbert curve, WKB, bounding boxes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def hilbert_index(x: Column, y: Column, order: int = 16) -> Column:
    """Distance along the Hilbert curve of 2^order by 2^order cells."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(s, k):
        side = F.expr("1L") * F.call_function("shiftleft", F.lit(1).cast("long"), k)
        rx = F.when(s["x"].bitwiseAND(side) > 0, 1).otherwise(0)
        ry = F.when(s["y"].bitwiseAND(side) > 0, 1).otherwise(0)
        d = s["d"] + side * side * (F.lit(3) * rx).bitwiseXOR(ry)
        # the quarter is turned so that the curve goes on where the last one ended
        inner_x, inner_y = s["x"].bitwiseAND(side - 1), s["y"].bitwiseAND(side - 1)
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, side - 1 - inner_x).otherwise(inner_x), F.when(flip, side - 1 - inner_y).otherwise(inner_y)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    return F.aggregate(F.sequence(F.lit(order - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s["d"])


def hilbert_key(lon: Column, lat: Column, order: int = 16) -> Column:
    """Hilbert distance of a point's cell on a grid of 2^order by 2^order over the globe; points outside lie on the border."""
    last = (1 << order) - 1

    def cell(degrees: Column, reach: float) -> Column:
        share = (degrees + reach) / (2 * reach)
        return F.least(F.greatest((share * last).cast("long"), F.lit(0)), F.lit(last)).cast("long")

    return F.when(lon.isNotNull() & lat.isNotNull(), hilbert_index(cell(lon, 180.0), cell(lat, 90.0), order))


@F.pandas_udf(BinaryType())
def wkb_point(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """A point as 21 bytes of little-endian WKB; null where a coordinate is."""
    both = np.stack([lon.to_numpy(float), lat.to_numpy(float)], 1).astype("<f8")
    known = ~np.isnan(both).any(1)
    return pd.Series([b"\x01\x01\x00\x00\x00" + p.tobytes() if k else None for p, k in zip(both, known, strict=True)], dtype=object)


def bbox(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax"))


def bbox_inside(box: str, west: float, south: float, east: float, north: float) -> Column:
    """Strictly inside, on the covering column's fields, so that the scan can skip row groups."""
    f = lambda k: F.col(f"{box}.{k}")
    return (f("xmin") > west) & (f("xmax") < east) & (f("ymin") > south) & (f("ymax") < north)
