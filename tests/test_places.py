from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylake.functions.cleaning import mask_field, missing_coords, null_profile
from staylake.functions.geohash import add_geohash
from staylake.operators import places
from staylake.streaming.medallion import SILVER_COLUMNS, silver_projection
from tests.test_geohash import GOLDEN

HOTEL = "Id string, Name string, Country string, City string, Address string, Latitude string, Longitude string"
WEATHER = (
    "lng double, lat double, avg_tmpr_f double, avg_tmpr_c double, wthr_date string, year int, month int, day int"
)


@pytest.fixture
def hotels(spark):
    rows = [(str(i), f"h{i}", "US", "c", f"a{i}", lat, lng) for i, (lat, lng, _) in enumerate(GOLDEN[:8])]
    return add_geohash(spark.createDataFrame(rows, HOTEL), "Latitude", "Longitude")


@pytest.fixture
def weather(spark):
    rows = [(float(lng), float(lat), 70.0, 21.0, "2017-08-29", 2017, 8, 29) for lat, lng, _ in GOLDEN[8:]]
    return add_geohash(spark.createDataFrame(rows, WEATHER), "lat", "lng")


def test_join_counts_and_columns(hotels, weather):
    five = hotels.where("cast(Id as int) < 5")
    assert places.semi_prefilter(weather, five).count() == 5
    joined = places.join_on_cell(five, weather)
    assert joined.count() == 5
    assert joined.columns == (
        "Geohash Id Name Country City Address Latitude Longitude lng lat avg_tmpr_f avg_tmpr_c wthr_date year month day"
    ).split()
    assert places.join_on_cell(hotels, weather.where("lat > 40"), "left").count() == 8


def _dense(spark, cells):
    """20 hotels in each cell and 20 in one without weather; 120,000 weather rows with fine values, a sixth of them elsewhere."""
    cell = lambda number: F.lpad(number.cast("string"), 4, "0").alias("Geohash")
    name = F.sha2(F.col("id").cast("string"), 256).alias("Name")
    hotels = spark.range((cells + 1) * 20).select(cell(F.col("id") % (cells + 1)), F.col("id").cast("string").alias("Id"), name)
    at = F.when(F.col("id") % 6 == 0, 9999).otherwise(F.pmod(F.xxhash64("id"), F.lit(cells)))
    points = spark.range(0, 120_000, 1, 8).select(cell(at), F.rand(7).alias("avg_tmpr_c"), F.rand(8).alias("avg_tmpr_f"))
    return hotels, points


@pytest.mark.parametrize("cells,threshold", [(2, "-1"), (500, "10MB")])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_pairs_of_a_cell_are_stored_small(spark, tmp_path, how, cells, threshold):
    """Two million pairs with two random doubles each; 100,000 weather rows have them."""
    hotels, points = _dense(spark, cells)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        places.join_on_cell(hotels, points, how).write.parquet(str(tmp_path / "pairs"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 2_000_000 + 20 * (how == "left")
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 2 * 2_000_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_weather_without_hotels_is_not_shuffled(spark, tmp_path, how):
    """A filter by the hotels' cells lies between the weather and its shuffle."""
    hotels, points = _dense(spark, 4)
    points.write.parquet(str(tmp_path / "points"))
    text = places.join_on_cell(hotels, spark.read.parquet(str(tmp_path / "points")), how)._jdf.queryExecution().toString()
    lines = text[text.index("== Physical Plan ==") :].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "avg_tmpr_c" in line)
    shuffle = max(i for i, line in enumerate(lines[:scan]) if " Exchange " in line)
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in lines[shuffle:scan])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_pairs_are_those_of_a_plain_join(spark, how):
    """Null, empty, repeated and longer cells, cells that begin alike, columns of one name."""
    cells = ["9qfx", "9qfx", "9qfxa", "9qfxb", "9q", None, "dqc7", ""]
    hotels = spark.createDataFrame([(c, f"h{i % 5}", i % 3) for i, c in enumerate(cells)], "Geohash string, Id string, x int")
    weather = [(1.5, c, 7) for c in ["9qfx", "9qfx", "9qfxa", "9qfxc", "9q", None, "", "far0"]]
    points = spark.createDataFrame(weather, "lng double, Geohash string, y int")
    got, want = places.join_on_cell(hotels, points, how), hotels.join(points, "Geohash", how)
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    if how == "inner":
        same = points.withColumnRenamed("y", "x")
        got, want = places.join_on_cell(hotels, same), hotels.join(same, "Geohash")
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_unknown_join_mode(hotels, weather):
    with pytest.raises(ValueError):
        places.join_on_cell(hotels, weather, "outer")


def test_unmatched_is_left_minus_inner(hotels, weather):
    some = weather.where("lat > 40").unionByName(weather.where("lat > 43"))
    twice = hotels.unionByName(hotels)
    left, inner = places.join_on_cell(twice, some, "left"), places.join_on_cell(twice, some)
    want = left.subtract(inner)
    got = places.join_unmatched(twice, some)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr
    )


def test_daily_join_has_one_row_per_day(hotels, weather):
    repeated = weather.unionByName(weather)
    daily = places.join_cell_daily(hotels, repeated)
    assert daily.count() == 8
    assert {r.measurements for r in daily.collect()} == {2}


def test_repair_is_independent_per_coordinate(spark):
    rows = [
        ("1", "n", "US", "c", "a1", None, "5.5"),
        ("2", "n", "US", "c", "a2", "NA", "NAN"),
        ("3", "n", "US", "c", "a3", "0", "0"),
        ("4", "n", "US", "c", "nowhere", None, None),
        ("5", "n", "US", "other", "a1", None, None),
    ]
    known = [("a1", "c", "1.5", "2.5"), ("a2", "c", "3.5", "4.5"), ("a1", "c", "1.5", "2.5"), ("a3", "c", "9", "9")]
    hotels = spark.createDataFrame(rows, HOTEL)
    gazetteer = spark.createDataFrame(known, "Address string, City string, lat string, lng string")
    got = {r.Id: (r.Latitude, r.Longitude) for r in places.repair_coords(hotels, gazetteer).collect()}
    assert got == {
        "1": ("1.5", "5.5"),
        "2": ("3.5", "4.5"),
        "3": ("0", "0"),
        "4": (None, None),
        "5": (None, None),
    }
    assert missing_coords(hotels).count() == 4
    assert {r.column: r.has_nulls for r in null_profile(hotels).collect()}["Latitude"] is True


def test_repair_takes_one_gazetteer_row_whole(spark):
    """The two minima of a repeated key lie in different rows, and text order differs from number order."""
    hotels = spark.createDataFrame([("1", "n", "US", "c", "a", None, None)], HOTEL)
    known = [("a", "c", "10", "50"), ("a", "c", "9", "70"), ("a", "c", "20", "40")]
    row = places.repair_coords(hotels, spark.createDataFrame(known, "Address string, City string, lat string, lng string")).first()
    assert (row.Latitude, row.Longitude) == ("9", "70")


def test_means_of_fine_values(spark):
    """Finer than any place that is kept: the input must not be rounded."""
    rows = [("a", 3e-9, "d"), ("a", 4e-9, "d"), ("b", 0.000003, "d"), ("b", 0.000004, "d"), ("c", None, "d")]
    weather = spark.createDataFrame(rows, "Geohash string, avg_tmpr_c double, wthr_date string")
    got = {r.Geohash: r.mean_tmpr_c for r in places.daily_cell_weather(weather).collect()}
    assert got == {"a": 3.5e-9, "b": 0.0000035, "c": None}


def test_silver_drops_a_row_with_any_null(spark):
    schema = (
        "address string, city string, country string, geoHash string, id string, name string, wthr_date string, "
        "year int, month int, day int, avg_tmpr_c double, avg_tmpr_f double, latitude double, longitude double"
    )
    full = ("hotel", "c", "US", "9qfx", "1", "street", "2017-08-29", 2017, 8, 29, 1.0, 2.0, 3.0, 4.0)
    rows = [full] + [full[:i] + (None,) + full[i + 1 :] for i in range(len(full))]
    got = silver_projection(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 1
    assert (got[0].name, got[0].address) == ("hotel", "street")
    assert got[0].__fields__ == list(SILVER_COLUMNS)


def test_mask_keeps_null(spark):
    df = spark.createDataFrame([("2015-08-18 12:37:10",), (None,)], "t string")
    assert [r.t for r in mask_field(df, "t").collect()] == ["0000-00-00 00:00:00", None]
