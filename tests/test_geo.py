import math
import random

import pytest
from pyspark.sql import functions as F

from wayfold.functions import geo


def one(spark, lat1, lon1, lat2, lon2):
    df = spark.createDataFrame([(lat1, lon1, lat2, lon2)], "a double, b double, c double, d double")
    return geo.with_geodesic_km(df, "a", "b", "c", "d", "km").first()["km"]


def test_published_baseline(spark):
    flinders = -(37 + 57 / 60 + 3.72030 / 3600), 144 + 25 / 60 + 29.52440 / 3600
    buninyong = -(37 + 39 / 60 + 10.15610 / 3600), 143 + 55 / 60 + 35.38390 / 3600
    assert one(spark, *flinders, *buninyong) == pytest.approx(54.972271, abs=1e-6)


def test_same_point_and_unsettled(spark):
    assert one(spark, 39.47, -0.37, 39.47, -0.37) == 0.0
    assert one(spark, 0.0, 0.0, 0.3, 179.8) is None  # three steps do not settle it


def settled(spark, *points):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    return [r.km for r in geo.with_geodesic_km(df, "a", "b", "c", "d", "km", far=True).collect()]


def test_almost_opposite_points_have_a_distance(spark):
    # Published solutions of the inverse problem: equator 0.5 degrees short of opposite with latitude 0.5, and the half meridian.
    got = settled(spark, (0.0, 0.0, 0.5, 179.5), (0.0, 0.0, 0.0, 180.0), (30.0, 10.0, -30.0, -170.0), (90.0, 0.0, -90.0, 55.0), (0.0, 0.0, 0.5, 179.7))
    assert got[0] == pytest.approx(19936.288579, abs=1e-3)
    assert got[1:4] == pytest.approx([20003.931459] * 3, abs=1e-3)
    assert got[4] == pytest.approx(19944.127421, abs=1e-3)


def test_other_continents(spark):
    valencia = (39.4699, -0.3763)
    got = settled(spark, *[(*valencia, *far) for far in ((-33.8688, 151.2093), (-33.4489, -70.6693), (-36.8509, 174.7645))])
    flat = [17420, 10840, 19494]
    assert all(x == pytest.approx(y, rel=0.01) for x, y in zip(got, flat))
    df = spark.createDataFrame([(*valencia, -36.8509, 174.7645)], "a double, b double, c double, d double")
    within = df.select(*[geo.is_within_km("a", "b", "c", "d", got[2] + gap).alias(n) for n, gap in (("wide", 5.0), ("tight", -5.0))]).first()
    assert within.wide and not within.tight


def test_far_points_and_both_forms(spark):
    df = spark.createDataFrame([(39.47, -0.37, -33.87, 151.21), (39.47, -0.37, 39.48, -0.36), (0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    rows = geo.with_geodesic_km(df, "a", "b", "c", "d", "km", far=True).withColumn("k2", geo.geodesic_km("a", "b", "c", "d", 20)).collect()
    assert [r.km for r in rows][3] is None
    ball = df.select(geo.haversine_m("a", "b", "c", "d") / 1000).first()[0]
    assert rows[0].km == pytest.approx(ball, rel=geo.SPHERE_SLACK) and rows[2].km == pytest.approx(111.319491, abs=1e-6)
    assert all(r.km == pytest.approx(r.k2, abs=1e-7) for r in rows[:3])


def test_filter_on_the_result_stays_above_the_series(spark):
    df = spark.range(1000).select((39 + F.col("id") / 1e4).alias("a"), F.lit(0.0).alias("b"), F.lit(39.0).alias("c"), F.lit(0.0).alias("d"))
    near = geo.with_geodesic_km(df, "a", "b", "c", "d", "km").where("km <= 1.0").where("km > 0.5")
    assert 0 < near.count() < 1000


@pytest.mark.parametrize("base", [(39.46, -0.37), (0.0, 0.0), (-80.2, 179.99), (89.2, 10.0), (66.5, -179.98), (89.97, 0.0), (-89.98, 90.0)])
def test_cells_lose_no_pair(spark, base):
    rnd = random.Random(7)
    spread = 0.06 / max(math.cos(math.radians(base[0])), 0.02) if abs(base[0]) < 89.9 else 180.0

    def points(n):
        return [(i, max(min(base[0] + rnd.uniform(-0.05, 0.05), 90.0), -90.0), (base[1] + rnd.uniform(-spread, spread) + 180) % 360 - 180) for i in range(n)]

    a = spark.createDataFrame(points(120), "i long, lat double, lon double")
    b = spark.createDataFrame(points(120), "j long, lat2 double, lon2 double")
    km = 2.0
    near = geo.haversine_m("lat", "lon", "lat2", "lon2") <= km * 1000
    plain = a.crossJoin(b).where(near).select("i", "j")
    left = a.withColumn("c", F.explode(geo.cells_around("lat", "lon", km)))
    right = b.withColumn("c", geo.cell("lat2", "lon2", km))
    celled = left.join(right, "c").where(near).select("i", "j")
    assert plain.count() > 0
    assert celled.exceptAll(plain).isEmpty() and plain.exceptAll(celled).isEmpty()


def test_wide_cells_hold_all_partners_in_fewer_cells(spark):
    """Every user within the radius sits in one of the vehicle's cells, at the date line and near the poles too."""
    rnd, km = random.Random(4), 2.0
    rows = []
    for _ in range(4000):
        lat, lon = rnd.choice([rnd.uniform(-89.99, 89.99), rnd.uniform(39, 40), rnd.choice([-1, 1]) * rnd.uniform(89.8, 89.999)]), rnd.choice([rnd.uniform(-180, 180), 180 - rnd.uniform(0, 0.02)])
        turn, far = rnd.uniform(0, 2 * math.pi), rnd.uniform(0, km) / 111.7
        there = lat + far * math.cos(turn)
        if abs(there) < 90:
            rows.append((lat, lon, there, (lon + far * math.sin(turn) / max(math.cos(math.radians(lat)), 1e-6) + 540) % 360 - 180))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").where(geo.is_within_km("a", "b", "c", "d", km))
    assert df.count() > 2000
    for side in (km, 2 * km, 4 * km):
        missed = df.where(~F.array_contains(geo.cells_around("a", "b", km, side), geo.cell("c", "d", side)))
        assert missed.isEmpty()
    size = lambda side: df.where("abs(a) < 80").agg(F.avg(F.size(geo.cells_around("a", "b", km, side)))).first()[0]
    assert size(2 * km) < 0.6 * size(None)
