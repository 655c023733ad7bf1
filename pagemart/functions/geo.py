"""Distance on the WGS-84 ellipsoid, as a chain of native projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

# WGS-84 axes in kilometres and the flattening.
MAJOR_KM = 6378.137
MINOR_KM = 6356.752314245
FLATTENING = 1 / 298.257223563


def _sphere(n: int) -> list[str]:
    """Arc and azimuth on the auxiliary sphere for the longitude difference of round n."""
    return [
        f"sqrt(pow(_cu2 * sin(_lam{n}), 2) + pow(_cu1 * _su2 - _su1 * _cu2 * cos(_lam{n}), 2)) AS _ss{n}",
        f"_su1 * _su2 + _cu1 * _cu2 * cos(_lam{n}) AS _cs{n}",
        f"atan2(_ss{n}, _cs{n}) AS _sigma{n}",
        f"coalesce(_cu1 * _cu2 * sin(_lam{n}) / nullif(_ss{n}, 0D), _ss{n}) AS _sa{n}",
        f"1 - _sa{n} * _sa{n} AS _c2{n}",
        f"coalesce(_cs{n} - 2 * _su1 * _su2 / nullif(_c2{n}, 0D), _c2{n}) AS _mid{n}",
    ]


def with_distance(
    df: DataFrame, here: tuple[Column, Column], there: tuple[Column, Column], out: str, rounds: int = 5
) -> DataFrame:
    """Add the distance in km, 2 decimals, between two (lat, lon) points in degrees.

    Vincenty's inverse formula with a fixed number of rounds: each shrinks the error about 300
    times, so 5 settle the result except for nearly opposite points, where the formula has no
    limit. The terms are aliases that later terms name, so shared ones are computed once.
    """
    f, last = repr(FLATTENING), rounds
    terms = [
        f"atan((1 - {f}D) * tan(radians(_lat1))) AS _u1",
        f"atan((1 - {f}D) * tan(radians(_lat2))) AS _u2",
        "sin(_u1) AS _su1", "cos(_u1) AS _cu1", "sin(_u2) AS _su2", "cos(_u2) AS _cu2",
        "radians(_lon2) - radians(_lon1) AS _lam0",
    ]
    for n in range(rounds):
        terms += [
            *_sphere(n),
            f"{f}D / 16 * _c2{n} * (4 + {f}D * (4 - 3 * _c2{n})) AS _k{n}",
            f"_lam0 + (1 - _k{n}) * {f}D * _sa{n} * (_sigma{n} + _k{n} * _ss{n} * (_mid{n} + _k{n} * _cs{n} "
            f"* (2 * _mid{n} * _mid{n} - 1))) AS _lam{n + 1}",
        ]
    terms += [
        *_sphere(last),
        f"_c2{last} * {(MAJOR_KM**2 - MINOR_KM**2) / MINOR_KM**2!r}D AS _q",
        "1 + _q / 16384 * (4096 + _q * (-768 + _q * (320 - 175 * _q))) AS _a",
        "_q / 1024 * (256 + _q * (-128 + _q * (74 - 47 * _q))) AS _b",
        f"round({MINOR_KM!r}D * _a * (_sigma{last} - _b * _ss{last} * (_mid{last} + _b / 4 * (_cs{last} "
        f"* (2 * _mid{last} * _mid{last} - 1) - _b / 6 * _mid{last} * (4 * _ss{last} * _ss{last} - 3) "
        f"* (4 * _mid{last} * _mid{last} - 3)))), 2) AS `{out}`",
    ]
    points = {"_lat1": here[0], "_lon1": here[1], "_lat2": there[0], "_lon2": there[1]}
    return df.withColumns(points).selectExpr("*", *terms).select(*df.columns, out)
