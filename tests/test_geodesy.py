import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terratally.functions import geodesy
from terratally.sources.places import nautical_zone

PARIS, BERLIN = (48.8566, 2.3522), (52.52, 13.405)
NEW_YORK, SHANGHAI = (40.7128, -74.006), (31.2304, 121.4737)


def distances(spark, pairs):
    rows = [(i, *a, *b) for i, (a, b) in enumerate(pairs)]
    frame = spark.createDataFrame(
        rows, "i int, lat1 double, lon1 double, lat2 double, lon2 double"
    )
    prepared = frame.select(
        "i",
        geodesy.reduced_latitude("lat1").alias("p1"),
        F.radians("lon1").alias("l1"),
        geodesy.reduced_latitude("lat2").alias("p2"),
        F.radians("lon2").alias("l2"),
    )
    measured = geodesy.with_distance(prepared, ("p1", "l1"), ("p2", "l2"), ["i"])
    return [r.distance_km for r in measured.orderBy("i").collect()]


def vincenty(a, b):
    """Vincenty's inverse iteration, the yardstick; None when it does not settle."""
    radius, f = 6378.137, 1 / 298.257223563
    polar = radius * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(p[0]))) for p in (a, b))
    gap = math.radians(b[1] - a[1])
    turn = gap
    for _ in range(200):
        sin_s = math.hypot(
            math.cos(u2) * math.sin(turn),
            math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(turn),
        )
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(turn)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(turn) / sin_s
        cos2 = 1 - sin_a**2
        mid = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        following = gap + (1 - c) * f * sin_a * (
            s + c * sin_s * (mid + c * cos_s * (2 * mid**2 - 1))
        )
        settled = abs(following - turn) < 1e-12
        turn = following
        if settled:
            break
    else:
        return None
    u = cos2 * (radius**2 - polar**2) / polar**2
    big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    shift = big_b * sin_s * (
        mid
        + big_b / 4 * (
            cos_s * (2 * mid**2 - 1)
            - big_b / 6 * mid * (4 * sin_s**2 - 3) * (4 * mid**2 - 3)
        )
    )
    return polar * big_a * (s - shift)


def test_known_distances(spark):
    found = distances(spark, [(PARIS, BERLIN), (PARIS, NEW_YORK), (BERLIN, SHANGHAI)])
    assert found == pytest.approx([879.699, 5852.935, 8416.064], abs=0.001)


def test_symmetry_identity_and_missing(spark):
    there, back, same, missing = distances(
        spark, [(PARIS, SHANGHAI), (SHANGHAI, PARIS), (PARIS, PARIS), (PARIS, (None, 1.0))]
    )
    assert there == pytest.approx(back, abs=1e-6)
    assert same == 0.0
    assert missing is None


def test_antipodes_stay_within_half_a_meridian(spark):
    found = distances(spark, [((0.0, 0.0), (0.0, 180.0)), ((10.0, 20.0), (-10.0, -160.0))])
    assert all(d == pytest.approx(geodesy.HALF_MERIDIAN_KM, abs=0.01) for d in found)


point = st.tuples(
    st.floats(-75, 75, allow_nan=False), st.floats(-179, 179, allow_nan=False)
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(point, point), min_size=40, max_size=40))
def test_close_to_vincenty(spark, pairs):
    for (a, b), found in zip(pairs, distances(spark, pairs), strict=True):
        exact = vincenty(a, b)
        if exact is not None and exact < 15000:
            assert found == pytest.approx(exact, abs=0.002)


def test_nautical_zone(spark):
    frame = spark.createDataFrame([(0.0,), (22.0,), (-74.0,), (None,)], "lon double")
    zones = [r[0] for r in frame.select(nautical_zone(F.col("lon"))).collect()]
    assert zones == ["Etc/GMT", "Etc/GMT-1", "Etc/GMT+5", None]
