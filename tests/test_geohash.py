import random

import pytest
from pyspark.sql import functions as F

from staylake.functions.geohash import GEOHASH_ALPHABET, add_geohash, geohash

# Fixed values: (lat, lng, cell) of eight hotels and eight weather points.
GOLDEN = [
    ("39.244493", "-119.936437", "9qfx"),
    ("38.66893", "-76.87629", "dqc7"),
    ("44.31141", "-96.76286", "9zgh"),
    ("39.6286685", "-106.0451009", "9xh9"),
    ("42.06258050", "-87.89069", "dp3r"),
    ("38.648378", "-85.456373", "dng5"),
    ("28.02077", "-97.05601", "9ufz"),
    ("42.56297", "-114.46087", "9rwd"),
    ("42.0497", "-88.1964", "dp3r"),
    ("44.3281", "-96.9856", "9zgh"),
    ("38.5031", "-85.7572", "dng5"),
    ("42.545", "-114.408", "9rwd"),
    ("27.9514", "-97.3793", "9ufz"),
    ("39.2037", "-120.142", "9qfx"),
    ("38.5235", "-76.9781", "dqc7"),
    ("39.5543", "-106.009", "9xh9"),
]


def bisect(lat, lng, precision):
    """The textbook definition: halve the ranges in turn."""
    ranges, values, out = [[-180.0, 180.0], [-90.0, 90.0]], [lng, lat], ""
    bits = []
    for i in range(5 * precision):
        low, high = ranges[i % 2]
        middle = (low + high) / 2
        upper = values[i % 2] >= middle
        bits.append(int(upper))
        ranges[i % 2][0 if upper else 1] = middle
    for i in range(0, len(bits), 5):
        out += GEOHASH_ALPHABET[int("".join(map(str, bits[i : i + 5])), 2)]
    return out


def test_golden_cells(spark):
    rows = spark.createDataFrame(GOLDEN, "Latitude string, Longitude string, want string")
    got = add_geohash(rows, "Latitude", "Longitude")
    assert got.where("Geohash <> want or Geohash is null").count() == 0


def test_agrees_with_bisection_and_prefixes_nest(spark):
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(0.0, 0.0), (90.0, 180.0), (-90.0, -180.0), (45.0, 90.0)]
    df = spark.createDataFrame(points, "lat double, lng double")
    precisions = (1, 2, 3, 4, 5, 6, 9, 12)
    cells = df.select("lat", "lng", *[geohash(F.col("lat"), F.col("lng"), p).alias(f"g{p}") for p in precisions])
    for row in cells.collect():
        for p in precisions:
            assert row[f"g{p}"] == bisect(row.lat, row.lng, p)
            assert row.g12.startswith(row[f"g{p}"])


def test_missing_and_out_of_range(spark):
    rows = [(None, "1"), ("1", None), ("NA", "NA"), ("", "1"), ("91", "0"), ("0", "-180.5"), ("NaN", "0")]
    got = add_geohash(spark.createDataFrame(rows, "a string, b string"), "a", "b")
    assert got.where("Geohash is not null").count() == 0


def test_precision_is_checked():
    with pytest.raises(ValueError):
        geohash(None, None, 13)
