"""Hotels, weather points and the geohash cells that connect them.

No join here names a table to broadcast: the planner compares the sides with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where AQE splits a hot cell. Only the
leading characters of the hotels' cells are sent to all tasks, as there are few of them by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.functions.cleaning import is_missing
from staylake.functions.geohash import distinct_cells
from staylake.functions.temperature import exact_mean


# Characters of a cell by which weather is chosen before it is shuffled: at most 32**4 different ones.
PREFIX = 4


def repair_coords(
    hotels: DataFrame, gazetteer: DataFrame, keys=("Address", "City"), lat="Latitude", lng="Longitude"
) -> DataFrame:
    """Fill only the missing coordinate(s) of each hotel from the gazetteer.

    The gazetteer is reduced to one row per key first, so a repeated entry adds no hotel rows: the
    southernmost, then westernmost point whole, never the latitude of one entry with the longitude of
    another.
    """
    point = F.struct(
        F.col("lat").try_cast("double").alias("y"),
        F.col("lng").try_cast("double").alias("x"),
        F.col("lat").cast("string").alias("lat"),
        F.col("lng").cast("string").alias("lng"),
    )
    known = gazetteer.groupBy(*keys).agg(F.min(point).alias("_p"))
    known = known.select(*keys, F.col("_p.lat").alias("_lat"), F.col("_p.lng").alias("_lng"))
    return (
        hotels.join(known, list(keys), "left")
        .withColumn(lat, F.when(is_missing(lat), F.col("_lat")).otherwise(F.col(lat)))
        .withColumn(lng, F.when(is_missing(lng), F.col("_lng")).otherwise(F.col(lng)))
        .select(*hotels.columns)
    )


def semi_prefilter(weather: DataFrame, hotels: DataFrame, cell: str = "Geohash") -> DataFrame:
    """Weather rows whose cell holds at least one hotel."""
    return weather.join(distinct_cells(hotels, cell), cell, "left_semi")


def join_on_cell(hotels: DataFrame, weather: DataFrame, how: str = "inner", cell: str = "Geohash") -> DataFrame:
    """Hotels with every weather row of their cell; ``left`` keeps hotels without weather.

    All pairs of a cell are asked for, so a cell's rows grow as a product; ``join_cell_daily`` is the form
    for dense cells. The left join is the inner one and the hotels whose cell has no weather: an outer
    join could neither keep its hotels in a task nor have a hot cell of its weather split.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join mode must be inner or left, got {how}")
    joined = _pairs(hotels, weather, cell)
    if how == "inner":
        return joined
    lone = hotels.join(distinct_cells(weather, cell), cell, "left_anti")
    return joined.unionByName(_without_weather(lone, hotels, weather, cell))


def _pairs(hotels: DataFrame, weather: DataFrame, cell: str) -> DataFrame:
    """Every weather row with the hotels of its cell, cell by cell.

    Stored by columns, the pairs of a weather row are runs of one value, and the next row of the cell repeats the
    same hotels. With a hotel's pairs together instead, each would be stored with all values of its cell's weather.
    The merge brings the rows of a cell together, whatever the size of the hotels; a task holds the hotels of a cell.
    """
    joined = _near(weather, hotels, cell).join(hotels.hint("merge"), cell)
    names, own = joined.columns, len(weather.columns)
    order = [0, *range(own, len(names)), *range(1, own)]
    numbered = joined.toDF(*[f"_{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"_{i}").alias(names[i]) for i in order])


def _near(weather: DataFrame, hotels: DataFrame, cell: str) -> DataFrame:
    """Weather without the rows whose cell no hotel's cell begins like: they need no shuffle."""
    cells = distinct_cells(hotels.select(F.substring(cell, 1, PREFIX).alias("_start")), "_start")
    return weather.join(F.broadcast(cells), F.substring(cell, 1, PREFIX) == F.col("_start"), "left_semi")


def _without_weather(lone: DataFrame, hotels: DataFrame, weather: DataFrame, cell: str) -> DataFrame:
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in weather.schema if f.name != cell]
    return lone.select(cell, *[c for c in hotels.columns if c != cell], *empty)


def daily_cell_weather(weather: DataFrame, cell: str = "Geohash") -> DataFrame:
    """One row per cell and day: exact mean temperature and number of measurements."""
    return weather.groupBy(cell, "wthr_date").agg(
        exact_mean("avg_tmpr_c").alias("mean_tmpr_c"), F.count(F.lit(1)).alias("measurements")
    )


def join_cell_daily(hotels: DataFrame, weather: DataFrame, cell: str = "Geohash") -> DataFrame:
    """Left join to the daily reduction, so a hotel has one row per day.

    Weather of cells without a hotel is left out before it is aggregated.
    """
    return hotels.join(daily_cell_weather(semi_prefilter(weather, hotels, cell), cell), cell, "left")


def join_unmatched(hotels: DataFrame, weather: DataFrame, cell: str = "Geohash") -> DataFrame:
    """Distinct rows of the left join that the inner join lacks.

    These are the hotels without weather, so the two joins and their difference are not built.
    """
    lone = hotels.dropDuplicates().join(distinct_cells(weather, cell), cell, "left_anti")
    return _without_weather(lone, hotels, weather, cell)
