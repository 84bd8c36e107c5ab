"""Great-circle geometry on columns in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rad(*cs: Column | str) -> list[Column]:
    return [F.radians(F.col(c) if isinstance(c, str) else c) for c in cs]


def central_angle(lon1, lat1, lon2, lat2) -> Column:
    """Haversine angle between two points, in radians."""
    l1, p1, l2, p2 = _rad(lon1, lat1, lon2, lat2)
    half = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return 2 * F.asin(F.sqrt(half))


def gc_point(lon1, lat1, lon2, lat2, fraction) -> Column:
    """Struct (lon, lat) of the point at `fraction` of the way; the start itself where both ends coincide."""
    l1, p1, l2, p2 = _rad(lon1, lat1, lon2, lat2)
    f = F.col(fraction) if isinstance(fraction, str) else fraction
    lon1 = F.col(lon1) if isinstance(lon1, str) else lon1
    lat1 = F.col(lat1) if isinstance(lat1, str) else lat1
    angle = central_angle(lon1, lat1, lon2, lat2)
    near, far = F.sin((1 - f) * angle), F.sin(f * angle)
    # The common divisor sin(angle) cancels in both arc tangents below, so it is left out.
    x = near * F.cos(p1) * F.cos(l1) + far * F.cos(p2) * F.cos(l2)
    y = near * F.cos(p1) * F.sin(l1) + far * F.cos(p2) * F.sin(l2)
    z = near * F.sin(p1) + far * F.sin(p2)
    moved = F.struct(
        F.degrees(F.atan2(y, x)).alias("lon"), F.degrees(F.atan2(z, F.sqrt(x * x + y * y))).alias("lat")
    )
    return F.when(angle == 0, F.struct(lon1.alias("lon"), lat1.alias("lat"))).otherwise(moved)


def gc_bearing(lon1, lat1, lon2, lat2) -> Column:
    """Initial bearing in degrees."""
    l1, p1, l2, p2 = _rad(lon1, lat1, lon2, lat2)
    turn = l2 - l1
    return F.degrees(
        F.atan2(F.sin(turn) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(turn))
    )


def fraction_flown(minute, dep, duration) -> Column:
    """Share of the trip done at `minute`, within [0, 1]; null for trips without a duration."""
    minute, dep, duration = (F.col(c) if isinstance(c, str) else c for c in (minute, dep, duration))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(minute - dep, duration)))


def route_paths(routes: DataFrame, n: int = 48, ends: tuple[str, str, str, str] = ("ox", "oy", "dx", "dy")) -> DataFrame:
    """Adds `path`: n + 1 points (step, lon, lat) from start to end with longitudes continuous across the date line.

    Everything happens inside the row, so no shuffle is needed and rows stay whole.
    """
    step = F.transform(
        F.sequence(F.lit(0), F.lit(n)),
        lambda i: F.struct(i.alias("step"), gc_point(*ends, i.cast("double") / n).alias("p")),
    )
    finite = F.filter(step, lambda s: ~(F.isnan(s["p"]["lon"]) | F.isnan(s["p"]["lat"]) | s["p"]["lon"].isNull()))
    point = "array<struct<step:int,lon:double,lat:double>>"

    def follow(path, s):
        raw = s["p"]["lon"]
        gap = raw - F.try_element_at(path, F.lit(-1))["lon"]
        lon = (
            F.when(gap > 180, raw - 360 * F.ceil((gap - 180) / 360))
            .when(gap < -180, raw + 360 * F.ceil((-gap - 180) / 360))
            .otherwise(raw)
        )
        return F.concat(path, F.array(F.struct(s["step"].alias("step"), lon.alias("lon"), s["p"]["lat"].alias("lat"))))

    return routes.withColumn("_raw", finite).withColumn(
        "path", F.aggregate("_raw", F.array().cast(point), follow)
    ).drop("_raw")
