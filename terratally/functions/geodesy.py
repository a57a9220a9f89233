"""Distance on the WGS-84 ellipsoid as plain column arithmetic.

The geodesic is approximated in closed form to second order in the flattening
(P. D. Thomas, "Spheroidal Geodesics, Reference Systems and Local Geometry", 1970).
Compared with Vincenty's iteration on random pairs the error stays below 4 cm up to
10,000 km and below 2 m up to 17,000 km. No UDF is involved, so the
whole computation lives in generated code.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EQUATOR_KM = 6378.137
FLATTENING = 1 / 298.257223563
HALF_MERIDIAN_KM = 20003.931459

# Squared half chord on the unit sphere at which two points touch or face each other.
_TOUCHING = 1e-15
_FACING = 1 - 1e-15

# The formula in steps; each step may use the columns named before it.
_STEPS = {
    "_sin_half": "sin(({lat2} - {lat1}) / 2)",
    "_sin_mean": "sin(({lat2} + {lat1}) / 2)",
    "_sin_turn": "sin(({lon2} - {lon1}) / 2)",
    "_half": "_sin_half * _sin_half",
    "_mean": "_sin_mean * _sin_mean",
    "_chord": "_half + (1 - _half - _mean) * _sin_turn * _sin_turn",
    "_safe": f"if(_chord > {_TOUCHING}D and _chord < {_FACING}D, _chord, 0.5D)",
    "_root": "sqrt(_safe * (1 - _safe))",
    "_u": "2 * _mean * (1 - _half) / (1 - _safe)",
    "_v": "2 * _half * (1 - _mean) / _safe",
    "_t": "asin(sqrt(_safe)) / _root",
    "_e": "2 * (1 - 2 * _safe)",
    "_d": "4 * _t * _t",
    "_x": "_u + _v",
    "_y": "_u - _v",
    "_first": "_t * _x - _y",
    "_second": (
        "_x * (_d * _e + (_t - (_d * _e - _e) / 2) * _x)"
        " - _y * (2 * _d + _e * _y) + _d * _x * _y"
    ),
    "_km": (
        f"{2 * EQUATOR_KM}D * _root * (_t - {FLATTENING / 4!r}D * _first"
        f" + {FLATTENING**2 / 64!r}D * _second)"
    ),
}
_RESULT = f"""CASE WHEN _chord <= {_TOUCHING}D THEN 0D
    WHEN _chord >= {_FACING}D THEN {HALF_MERIDIAN_KM}D
    WHEN _chord IS NOT NULL THEN round(least(_km, {HALF_MERIDIAN_KM}D), 6) END"""


def reduced_latitude(latitude: str) -> Column:
    """Latitude on the auxiliary sphere, in radians."""
    return F.expr(f"atan({1 - FLATTENING!r}D * tan(radians({latitude})))")


def with_distance(
    frame: DataFrame,
    origin: tuple[str, str],
    destination: tuple[str, str],
    keep: list[str],
    name: str = "distance_km",
) -> DataFrame:
    """``keep`` and ``name``, in km, from two (reduced latitude, longitude) column pairs.

    Longitudes are radians; the distance is NULL when a coordinate is. The steps refer to
    each other by alias, which Spark turns into a stack of projections; their columns
    are used several times further up, so the optimizer keeps the projections apart and
    computes every term once per row. The result leaves through a one-element ``inline``,
    which a filter on the distance cannot be pushed through; pushed, it would repeat the
    whole formula for every mention of the distance.
    """
    columns = dict(zip(("lat1", "lon1", "lat2", "lon2"), (*origin, *destination), strict=True))
    terms = [f"{text.format(**columns)} AS {term}" for term, text in _STEPS.items()]
    return frame.selectExpr("*", *terms).selectExpr(
        *keep, f"inline(array(named_struct('{name}', {_RESULT})))"
    )
