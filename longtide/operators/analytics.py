"""Star joins and rollups over observations, stations and variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import bytes_per_row
from ..functions.times import month

#: Dimensions up to this estimated size are broadcast by hint; larger ones are left to the optimiser.
BROADCAST_BYTES = 64 << 20


def small(dimension: DataFrame) -> DataFrame:
    """A broadcast hint if the optimiser's own size of the table is within the bound."""
    size = int(str(dimension._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(dimension) if size <= BROADCAST_BYTES else dimension


def in_box(stations: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    return stations.where(F.col("lon").between(west, east) & F.col("lat").between(south, north))


def of_kind(variables: DataFrame, standard_name: str, cell_method: str) -> DataFrame:
    return variables.where((F.col("standard_name") == standard_name) & (F.col("cell_method") == cell_method))


def between(rows: DataFrame, lo, hi, time: str = "obs_time") -> DataFrame:
    """Times in [lo, hi)."""
    return rows.where((F.col(time) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(time) < F.lit(hi).cast("timestamp_ntz")))


def in_periods(rows: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows of the periods; with periods read from a file this prunes partitions at run time."""
    return rows.join(periods.select("period"), "period", "left_semi")


def monthly_means(rows: DataFrame, stations: DataFrame, variables: DataFrame) -> DataFrame:
    """station_name, month, mean, n."""
    joined = rows.join(small(variables.select("variable_id")), "variable_id").join(small(stations.select("station_id", "station_name")), "station_id")
    return joined.groupBy("station_name", month(F.col("obs_time")).alias("month")).agg(F.round(F.avg("value"), 2).alias("mean"), F.count("*").alias("n"))


def series(rows: DataFrame, stations: DataFrame, variables: DataFrame, wanted: DataFrame) -> DataFrame:
    """network_name, native_id, name, obs_time, value of the series wanted by natural key (network_name, native_id, name), in order."""
    keys = wanted.select("network_name", "native_id", "name").distinct()
    st = small(stations.join(small(keys), ["network_name", "native_id"]).select("network_name", "native_id", "name", "station_id"))
    found = rows.join(st, "station_id").join(small(variables.select("variable_id", "name")), ["variable_id", "name"])
    return found.select("network_name", "native_id", "name", "obs_time", "value").orderBy("network_name", "native_id", "name", "obs_time", "value")


def station_means(rows: DataFrame, stations: DataFrame) -> DataFrame:
    means = rows.groupBy("station_id").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    return means.join(small(stations.select("station_id", "station_name", "lon", "lat")), "station_id")


def monthly_climatology(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by, F.month("obs_time").alias("month")).agg(F.avg("value").alias("mean"), F.count("*").alias("n"))


def variable_groups(variables: DataFrame) -> DataFrame:
    """standard_name, cell_method, variable_ids."""
    return variables.groupBy("standard_name", "cell_method").agg(F.sort_array(F.collect_set("variable_id")).alias("variable_ids"))


def freshness(rows: DataFrame) -> DataFrame:
    """The newest time in rows, and how many stations they are from."""
    return rows.agg(F.max("obs_time").alias("newest"), F.count_distinct("station_id").alias("n_stations"))


def inventory(manifest: DataFrame) -> DataFrame:
    """What the manifest says of each period: n_files, n_rows, size_mib, row_bytes."""
    size = F.sum("file_bytes")
    columns = {
        "n_files": F.count("path"),
        "n_rows": F.sum("rows"),
        "size_mib": F.round(size / float(1 << 20), 1),
        "row_bytes": F.round(bytes_per_row(size, F.sum("rows")), 2),
    }
    return manifest.groupBy("period").agg(*[c.alias(n) for n, c in columns.items()])


def extent(points: DataFrame, default=(-180.0, -90.0, 180.0, 90.0)) -> DataFrame:
    """west, south, east, north, first_time, last_time, rows; null coordinates do not count, none at all give the default box."""
    sides = (F.min("lon"), F.min("lat"), F.max("lon"), F.max("lat"))
    return points.agg(
        *[F.coalesce(s, F.lit(d)).alias(n) for s, d, n in zip(sides, default, ("west", "south", "east", "north"), strict=True)],
        F.min("min_obs_time").alias("first_time"), F.max("max_obs_time").alias("last_time"), F.count("*").alias("rows"),
    )


def point_grid(points: DataFrame, cells: int = 100, least_squeeze: float = 0.1) -> DataFrame:
    """col, row, n: how many points lie in each square cell of a grid over their own extent, rows counted from the north.

    The longer side of the extent, with degrees of longitude squeezed to the
    length they have at its middle latitude, has `cells` cells. Points without
    coordinates are left out; points at one place are one cell.
    """
    at = points.select("lon", "lat").na.drop()
    bounds = at.agg(F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"))
    squeeze = F.greatest(F.cos(F.radians(F.col("south") + (F.col("north") - F.col("south")) / 2)), F.lit(least_squeeze))
    side = F.greatest((F.col("east") - F.col("west")) * squeeze, F.col("north") - F.col("south"))
    frame = bounds.select("west", "north", squeeze.alias("squeeze"), F.try_divide(side, F.lit(float(cells))).alias("cell"))
    # one row, so a broadcast of a fixed size
    placed = at.join(F.broadcast(frame))
    bin_of = lambda distance: F.least(F.lit(cells - 1), F.coalesce(F.floor(F.try_divide(distance, F.col("cell"))), F.lit(0))).cast("int")
    col, row = bin_of((F.col("lon") - F.col("west")) * F.col("squeeze")), bin_of(F.col("north") - F.col("lat"))
    return placed.groupBy(col.alias("col"), row.alias("row")).agg(F.count("*").alias("n"))
