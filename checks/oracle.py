"""The catalog's queries as DuckDB SQL over the same generated tables."""

from __future__ import annotations



def half_even(x: str, digits: int = 2) -> str:
    """Half-even rounding of the decimal value, free of the noise of binary products."""
    return f"CAST(round_even(CAST({x} AS DECIMAL(18, 9)), {digits}) AS DOUBLE)"


CTES = {
    "trips": """
        SELECT event_id AS flight_id, CAST(ts AS DATE) AS flight_date, CAST(month(ts) AS INT) AS month,
            CAST(isodow(ts) AS INT) AS day_of_week, CAST(hour(ts) AS INT) AS dep_hour,
            CAST(hour(ts) * 60 + minute(ts) AS INT) AS dep_min,
            printf('%02d00-%02d59', hour(ts), hour(ts)) AS dep_block,
            event_type AS airline, CAST(user_id AS VARCHAR) AS tail,
            'A' || lpad(CAST(hub AS VARCHAR), 2, '0') AS origin,
            'A' || lpad(CAST((hub + 1 + k % 24) % 25 AS VARCHAR), 2, '0') AS dest,
            200 + 20 * k AS distance, CASE WHEN k % 50 <> 7 THEN 40 + 2 * k END AS crs_elapsed,
            CAST(k = 13 AS INT) AS cancelled, CAST(k = 14 AS INT) AS diverted,
            CASE WHEN k NOT IN (13, 14) THEN value - 35 END AS arr_delay,
            CASE WHEN k NOT IN (13, 14) THEN CAST(value - 35 >= 15 AS INT) END AS arr_del15,
            CASE WHEN k <> 13 THEN CAST(value - 38 >= 15 AS INT) END AS dep_del15
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k,
                CAST(floor((event_id % 25) * (floor(event_id / 25) % 25) / 24) AS INT) AS hub
              FROM events)""",
    "airports": """
        SELECT 'A' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iata, n_name AS name, r_name AS city,
            'US' AS country, CAST(25 + (n_nationkey * 7) % 24 AS DOUBLE) AS lat,
            CAST(-120 + (n_nationkey * 13) % 50 AS DOUBLE) AS lon
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "weather": """
        SELECT iata, date,
            CASE WHEN (n + d) % 17 <> 0 THEN CAST((31 * n + 17 * d) % 200 AS DOUBLE) / 10 END AS prcp,
            CASE WHEN (n + d) % 9 = 0 THEN CAST((n + d) % 40 AS DOUBLE) / 10 END AS snow,
            CASE WHEN (3 * n + d) % 13 <> 0 THEN CAST(5 + (5 * n + 3 * d) % 40 AS DOUBLE) END AS wspd,
            CASE WHEN (n + 2 * d) % 19 <> 0 THEN CAST(-5 + (3 * n + d) % 30 AS DOUBLE) END AS tavg
        FROM (SELECT iata, CAST(substr(iata, 2, 2) AS INT) AS n, date, CAST(day(date) AS INT) AS d
              FROM airports, (SELECT DISTINCT flight_date AS date FROM trips))
        WHERE (n + d) % 11 <> 0""",
    "served": "SELECT * FROM airports WHERE iata IN (SELECT origin FROM trips)",
    "clean": """
        SELECT iata, date, coalesce(prcp, 0) AS prcp, coalesce(snow, 0) AS snow,
            coalesce(wspd, median(wspd) OVER ()) AS wspd, coalesce(tavg, median(tavg) OVER ()) AS tavg
        FROM weather WHERE iata IN (SELECT iata FROM served)""",
    "clim": """
        SELECT iata, CAST(month(date) AS INT) AS month, avg(prcp) AS prcp, avg(snow) AS snow, avg(wspd) AS wspd,
            avg(tavg) AS tavg FROM clean GROUP BY ALL""",
    "hours": """
        SELECT origin, flight_date, dep_hour, count(*) AS dep_congestion, avg(dep_del15) AS dep_rate
        FROM trips GROUP BY ALL""",
    "states": """
        SELECT now.origin, now.flight_date, now.dep_hour, avg(past.dep_rate) AS airport_state
        FROM hours now JOIN hours past USING (origin, flight_date)
        WHERE now.dep_rate IS NOT NULL AND now.dep_hour - past.dep_hour IN (1, 2)
        GROUP BY ALL HAVING count(past.dep_rate) > 0""",
    "legs": """
        SELECT *, coalesce(lag(arr_delay) OVER day_of_tail, 0) AS prev_arr_delay,
            CAST(coalesce(dep_min - lag(dep_min + coalesce(crs_elapsed, 120)) OVER day_of_tail, 240) AS INT) AS turnaround
        FROM trips WINDOW day_of_tail AS (PARTITION BY tail, flight_date ORDER BY dep_min, flight_id)""",
    "feat": """
        SELECT legs.*, hours.dep_congestion, coalesce(states.airport_state, 0.2) AS airport_state
        FROM legs JOIN hours USING (origin, flight_date, dep_hour)
        LEFT JOIN states USING (origin, flight_date, dep_hour)""",
    "ready": """
        SELECT *, origin || '_' || dest AS route, origin || '_' || dep_hour AS orig_hour FROM trips
        WHERE cancelled = 0 AND diverted = 0 AND arr_del15 IS NOT NULL AND arr_delay IS NOT NULL
            AND crs_elapsed IS NOT NULL""",
    "train": "SELECT * FROM ready WHERE flight_date < DATE '2024-01-25'",
    "test": "SELECT * FROM ready WHERE flight_date >= DATE '2024-01-25'",
    "whole": """
        SELECT count(*) AS gn, avg(arr_del15) AS g, avg(arr_del15 * arr_del15) - avg(arr_del15) ** 2 AS gv FROM train""",
    "scored": """
        SELECT test.flight_id, test.arr_del15, test.arr_delay,
            round(coalesce(CASE WHEN v + n * gv > 0 THEN n * gv / (v + n * gv) * m + (1 - n * gv / (v + n * gv)) * g END, g), 6) AS score
        FROM test LEFT JOIN (SELECT orig_hour, count(*) AS n, avg(arr_del15) AS m,
                avg(arr_del15 * arr_del15) - avg(arr_del15) ** 2 AS v FROM train GROUP BY orig_hour) USING (orig_hour)
            CROSS JOIN whole""",
    "ranks": """
        SELECT score, pos, neg, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp,
            sum(pos) OVER () AS p, sum(neg) OVER () AS q
        FROM (SELECT score, count(*) FILTER (arr_del15 = 1) AS pos, count(*) FILTER (arr_del15 = 0) AS neg
              FROM scored GROUP BY score)
        WINDOW down AS (ORDER BY score DESC)""",
    "confusion": """
        SELECT count(*) FILTER (score >= t AND arr_del15 = 1) AS tp, count(*) FILTER (score < t AND arr_del15 = 0) AS tn,
            count(*) FILTER (score >= t AND arr_del15 = 0) AS fp, count(*) FILTER (score < t AND arr_del15 = 1) AS fn
        FROM scored, (SELECT avg(arr_del15) AS t FROM train)""",
    "hubs": """
        SELECT h.*, a.name, a.lat, a.lon FROM (
            SELECT origin AS iata, count(*) AS n_flights, avg(arr_del15) AS delay_rate,
                avg(arr_delay) FILTER (cancelled = 0) AS avg_delay, avg(cancelled) AS cancel_rate,
                avg(distance) AS avg_distance
            FROM trips GROUP BY origin HAVING count(*) > (SELECT count(*) * 10 // 1000 FROM trips)) h
        LEFT JOIN airports a USING (iata)""",
    "zhubs": """
        SELECT iata, {z} FROM hubs""".format(
        z=", ".join(
            f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}_z"
            for c in ("n_flights", "delay_rate", "avg_delay", "cancel_rate", "avg_distance")
        )
    ),
    "endpoints": """
        SELECT t.*, o.city AS ocity, d.city AS dcity, o.lat AS olat, o.lon AS olon, d.lat AS dlat, d.lon AS dlon
        FROM trips t JOIN airports o ON o.iata = t.origin JOIN airports d ON d.iata = t.dest""",
    "busy": """
        SELECT origin, dest, n, distance, crs_elapsed, dep_hour, airline, ocity, dcity, olat, olon, dlat, dlon
        FROM (SELECT origin, dest, count(*) AS n, round(avg(distance)) AS distance, round(avg(crs_elapsed)) AS crs_elapsed,
                CAST(round_even(median(dep_hour), 0) AS INT) AS dep_hour,
                any_value(ocity) AS ocity, any_value(dcity) AS dcity, any_value(olat) AS olat, any_value(olon) AS olon,
                any_value(dlat) AS dlat, any_value(dlon) AS dlon
              FROM endpoints WHERE cancelled = 0 AND diverted = 0 AND crs_elapsed IS NOT NULL
              GROUP BY origin, dest HAVING count(*) > (SELECT count(*) // 1000 FROM trips))
        JOIN (SELECT origin, dest, airline FROM (
                SELECT origin, dest, airline, row_number() OVER (PARTITION BY origin, dest ORDER BY count(*) DESC, airline) AS pick
                FROM trips WHERE cancelled = 0 AND diverted = 0 AND crs_elapsed IS NOT NULL GROUP BY origin, dest, airline) WHERE pick = 1)
            USING (origin, dest)
        ORDER BY n DESC, origin, dest LIMIT 200""",
    "routes": """
        SELECT busy.*, c.prcp, c.snow, c.wspd, c.tavg FROM busy LEFT JOIN clim c ON c.iata = busy.origin AND c.month = 1""",
    "requests": """
        SELECT flight_id AS request_id, airline, origin, dest, month, day_of_week, dep_hour,
            CASE WHEN (distance - 200) // 20 % 3 <> 0 THEN distance END AS distance,
            CASE WHEN (distance - 200) // 20 % 4 <> 0 THEN crs_elapsed END AS crs_elapsed,
            CASE WHEN (distance - 200) // 20 % 2 = 0 THEN CAST(trunc(arr_delay) AS INT) END AS prev_arr_delay,
            CASE WHEN (distance - 200) // 20 % 5 <> 0 THEN flight_date END AS date
        FROM trips""",
    "meteo": """
        SELECT q.*, CASE WHEN w.iata IS NOT NULL THEN 'réelle' ELSE 'typique' END AS meteo_source, {m}
        FROM requests q LEFT JOIN weather w ON w.iata = q.origin AND w.date = q.date
            LEFT JOIN clim c ON c.iata = q.origin AND c.month = q.month
            CROSS JOIN (SELECT {g} FROM clim) g""".format(
        m=", ".join(
            f"CASE WHEN w.iata IS NOT NULL THEN {dated} WHEN c.iata IS NOT NULL THEN {half_even('c.' + c)} ELSE g.{c} END AS {c}"
            for c, dated in (
                ("prcp", "coalesce(w.prcp, 0)"),
                ("snow", "coalesce(w.snow, 0) * 10"),
                ("wspd", "coalesce(nullif(w.wspd, 0), 15)"),
                ("tavg", "coalesce(nullif(w.tavg, 0), 15)"),
            )
        ),
        g=", ".join(f"{half_even('avg(' + half_even(c) + ')')} AS {c}" for c in ("prcp", "snow", "wspd", "tavg")),
    ),
    "replay": """
        SELECT t.flight_id, t.flight_date, t.origin AS o, t.dest AS d, t.airline AS al, t.olon AS ox, t.olat AS oy,
            t.dlon AS dx, t.dlat AS dy, t.dep_min AS dep, t.crs_elapsed AS dur,
            CAST((t.distance // 20 * 7 + t.dep_hour * 13) % 101 AS DOUBLE) / 100 AS risk, t.distance // 20 * 3 % 70 - 10 AS pdelay,
            CAST((t.distance // 20 * 11 + t.dep_min * 3) % 101 AS DOUBLE) / 100 AS drisk, t.distance // 20 * 5 % 80 - 10 AS dpdelay,
            t.arr_del15 AS real, CAST(trunc(t.arr_delay) AS INT) AS delay
        FROM endpoints t
        WHERE cancelled = 0 AND diverted = 0 AND crs_elapsed IS NOT NULL AND arr_del15 IS NOT NULL""",
}

NEEDS = {
    "weather": ["airports", "trips"],
    "served": ["airports", "trips"],
    "clean": ["weather", "served"],
    "clim": ["clean"],
    "hours": ["trips"],
    "states": ["hours"],
    "legs": ["trips"],
    "feat": ["legs", "hours", "states"],
    "ready": ["trips"],
    "train": ["ready"],
    "test": ["ready"],
    "whole": ["train"],
    "scored": ["test", "train", "whole"],
    "ranks": ["scored"],
    "confusion": ["scored", "train"],
    "hubs": ["trips", "airports"],
    "zhubs": ["hubs"],
    "endpoints": ["trips", "airports"],
    "busy": ["endpoints", "trips"],
    "routes": ["busy", "clim"],
    "requests": ["trips"],
    "meteo": ["requests", "weather", "clim"],
    "replay": ["endpoints"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for need in NEEDS.get(name, []):
            visit(need)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def sql(uses: str, body: str) -> str:
    """`body` behind the WITH entries it uses and those they need."""
    names = _closure(uses.split())
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in names) + "\n" + body.strip()


def _clusters(steps: int) -> str:
    """k-means steps from the busiest hubs, then the nearest centre of each hub."""
    z = [f"{c}_z" for c in FEATURES]
    gap = " + ".join(f"(h.{c} - c.{c}) * (h.{c} - c.{c})" for c in z)
    parts = [
        """top AS (SELECT z.*, row_number() OVER (ORDER BY n_flights DESC, iata) - 1 AS rn FROM zhubs z JOIN hubs USING (iata))""",
        "c0 AS (SELECT CAST(s AS INT) AS start, CAST(rn - s AS INT) AS cluster, top.* FROM top, range(3) AS r(s) WHERE rn BETWEEN s AND s + 3)",
    ]
    for i in range(steps + 1):
        parts.append(
            f"""n{i} AS (SELECT c.start, c.cluster, h.*, row_number() OVER (PARTITION BY c.start, h.iata ORDER BY {gap}, c.cluster) AS near
            FROM zhubs h, c{i} c QUALIFY near = 1)"""
        )
        means = ", ".join(f"coalesce(avg(n.{c}), any_value(c.{c})) AS {c}" for c in z)
        parts.append(f"c{i + 1} AS (SELECT start, cluster, {means} FROM c{i} c LEFT JOIN n{i} n USING (start, cluster) GROUP BY ALL)")
    return sql("zhubs", "SELECT 1").removesuffix("SELECT 1") + ", " + ",\n".join(parts) + f"\nSELECT start, iata, cluster FROM n{steps}"


def _sample(columns: str, where: str) -> str:
    return sql(
        "trips",
        f"SELECT {columns} FROM (SELECT * FROM trips ORDER BY md5(concat(CAST(flight_id AS VARCHAR), '-1')), flight_id LIMIT 5000) WHERE {where}",
    )


MEASURES = ["prcp", "snow", "wspd", "tavg"]
FEATURES = ["n_flights", "delay_rate", "avg_delay", "cancel_rate", "avg_distance"]
CATEGORIES = ["airline", "origin", "dest", "route", "orig_hour"]
EXTRA = ["prev_arr_delay", "dep_congestion", "turnaround", "airport_state"]


def rounded(columns: list[str], digits: int = 8, suffix: str = "") -> str:
    return ", ".join(f"round({c}{suffix}, {digits}) AS {c}{suffix}" for c in columns)


def _encoded(c: str) -> str:
    return f"""round(coalesce((SELECT CASE WHEN e.v + e.n * gv > 0
        THEN e.n * gv / (e.v + e.n * gv) * e.m + (1 - e.n * gv / (e.v + e.n * gv)) * g ELSE g END
        FROM (SELECT {c} AS c, count(*) AS n, avg(arr_del15) AS m, avg(arr_del15 * arr_del15) - avg(arr_del15) ** 2 AS v
              FROM train GROUP BY ALL) e WHERE e.c = test.{c}), g), 8) AS {c}_enc"""


def _crossfit(c: str) -> str:
    """Encoding of one column for every training row, learnt on the four other folds."""
    return f"""
        SELECT flight_id, CASE WHEN n IS NULL OR n = 0 OR v + n * gv <= 0 OR v + n * gv IS NULL THEN g
            ELSE n * gv / (v + n * gv) * m + (1 - n * gv / (v + n * gv)) * g END AS enc
        FROM (SELECT r.flight_id, x.n, x.s / nullif(x.n, 0) AS m, x.q / nullif(x.n, 0) - (x.s / nullif(x.n, 0)) ** 2 AS v,
                y.s / y.n AS g, y.q / y.n - (y.s / y.n) ** 2 AS gv
              FROM folded r
              LEFT JOIN (SELECT a.c, a.fold, b.n - a.n AS n, CAST(b.s - a.s AS DOUBLE) AS s, CAST(b.q - a.q AS DOUBLE) AS q
                    FROM (SELECT {c} AS c, fold, count(*) AS n, sum(arr_del15) AS s, sum(arr_del15 * arr_del15) AS q FROM folded GROUP BY ALL) a
                    JOIN (SELECT {c} AS c, count(*) AS n, sum(arr_del15) AS s, sum(arr_del15 * arr_del15) AS q FROM folded GROUP BY ALL) b USING (c)) x
                ON x.c = r.{c} AND x.fold = r.fold
              JOIN (SELECT f.fold, t.n - f.n AS n, CAST(t.s - f.s AS DOUBLE) AS s, CAST(t.q - f.q AS DOUBLE) AS q
                    FROM (SELECT fold, count(*) AS n, sum(arr_del15) AS s, sum(arr_del15 * arr_del15) AS q FROM folded GROUP BY ALL) f,
                         (SELECT count(*) AS n, sum(arr_del15) AS s, sum(arr_del15 * arr_del15) AS q FROM folded) t) y
                ON y.fold = r.fold)"""


def _factors() -> str:
    return """concat_ws('|',
        CASE WHEN prev_arr_delay >= 30 THEN 'Avion précédent en retard de ' || prev_arr_delay || ' min:fort'
             WHEN prev_arr_delay >= 15 THEN 'Avion précédent un peu en retard:moyen'
             WHEN prev_arr_delay IS NOT NULL THEN 'Avion précédent à l''heure:faible' END,
        CASE WHEN snow > 1 THEN 'Neige au départ:fort' WHEN prcp > 8 THEN 'Pluie au départ:moyen' END,
        CASE WHEN wspd > 30 THEN 'Vent fort:moyen' END,
        CASE WHEN dep_hour >= 17 THEN 'Départ en soirée:moyen' WHEN dep_hour <= 8 THEN 'Départ tôt le matin:faible' END)"""


def _corr(a: str, b: str) -> str:
    return f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


_MATRIX = ["dep_hour", "day_of_week", "distance", "crs_elapsed", "arr_del15"]
_TOLERANT = "CAST(abs(dpdelay - greatest(-30, least(240, delay))) <= 15 AS INT)"

# Sphere helpers: one CTE per step keeps the formulas readable.
_ARC = """2 * asin(sqrt(sin(radians({lat2} - {lat1}) / 2) ** 2
    + cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) ** 2))"""


def _sphere(source: str, keys: str, lon1: str, lat1: str, lon2: str, lat2: str, f: str) -> str:
    """Point at fraction `f` on the way, as plon/plat next to `keys`."""
    arc = _ARC.format(lon1=lon1, lat1=lat1, lon2=lon2, lat2=lat2)
    return f"""
        SELECT {keys}, CASE WHEN arc = 0 THEN {lon1} ELSE degrees(atan2(y, x)) END AS plon,
            CASE WHEN arc = 0 THEN {lat1} ELSE degrees(atan2(z, sqrt(x * x + y * y))) END AS plat
        FROM (SELECT *, u * cos(radians({lat1})) * cos(radians({lon1})) + w * cos(radians({lat2})) * cos(radians({lon2})) AS x,
                u * cos(radians({lat1})) * sin(radians({lon1})) + w * cos(radians({lat2})) * sin(radians({lon2})) AS y,
                u * sin(radians({lat1})) + w * sin(radians({lat2})) AS z
              FROM (SELECT *, sin((1 - {f}) * arc) / nullif(sin(arc), 0) AS u, sin({f} * arc) / nullif(sin(arc), 0) AS w
                    FROM (SELECT *, {arc} AS arc FROM {source})))"""


def _paths() -> str:
    steps = "(SELECT *, CAST(step AS INT) AS istep, step / 48.0 AS f FROM (SELECT DISTINCT origin, dest, olon, olat, dlon, dlat FROM endpoints), range(0, 49) AS s(step))"
    points = _sphere(steps, "origin, dest, istep AS step", "olon", "olat", "dlon", "dlat", "CAST(f AS DOUBLE)")
    return f"""
        SELECT origin, dest, step, round(plon + sum(hop) OVER trail, 6) AS lon, round(plat, 6) AS lat
        FROM (SELECT *, CASE WHEN plon - lag(plon) OVER trail > 180 THEN -360 WHEN plon - lag(plon) OVER trail < -180 THEN 360 ELSE 0 END AS hop
              FROM ({points}) WINDOW trail AS (PARTITION BY origin, dest ORDER BY step))
        WINDOW trail AS (PARTITION BY origin, dest ORDER BY step)"""


def _positions() -> str:
    flying = "(SELECT *, CAST(720 - dep AS DOUBLE) / dur AS f, least(1.0, CAST(720 - dep AS DOUBLE) / dur + 0.01) AS f2 FROM replay WHERE flight_date = DATE '2024-01-15' AND dep <= 720 AND dep + dur >= 720)"
    here = _sphere(flying, "flight_id, f", "ox", "oy", "dx", "dy", "f")
    ahead = _sphere(flying, "flight_id", "ox", "oy", "dx", "dy", "f2")
    return f"""
        SELECT h.flight_id, round(f, 8) AS fraction, round(h.plon, 6) AS lon, round(h.plat, 6) AS lat,
            round(degrees(atan2(sin(radians(a.plon - h.plon)) * cos(radians(a.plat)),
                cos(radians(h.plat)) * sin(radians(a.plat)) - sin(radians(h.plat)) * cos(radians(a.plat)) * cos(radians(a.plon - h.plon)))), 4) AS bearing
        FROM ({here}) h JOIN ({ahead}) a USING (flight_id)"""


def _silhouette() -> str:
    axes = [f"{c}_z" for c in FEATURES]
    gap = " + ".join(f"(p.{a} - o.{a}) ** 2" for a in axes)
    return f"""
        SELECT round(avg(CASE WHEN own IS NULL THEN 0 ELSE (other - own) / greatest(own, other) END), 6) AS silhouette
        FROM (SELECT iata, max(m) FILTER (pb = ob) AS own, min(m) FILTER (pb <> ob) AS other
              FROM (SELECT p.iata, p.band AS pb, o.band AS ob, sum(sqrt({gap})) / nullif(count(*) - CAST(p.band = o.band AS INT), 0) AS m
                    FROM banded p CROSS JOIN banded o GROUP BY p.iata, p.band, o.band) GROUP BY iata)"""


def _report() -> str:
    bands = [(0.0, 0.15, "0-15"), (0.15, 0.30, "15-30"), (0.30, 0.50, "30-50"), (0.50, 0.75, "50-75"), (0.75, 1.01, "75-100")]
    text = " || '|' || ".join(
        f"'{name}:' || CAST(round_even(100 * avg(real) FILTER (drisk >= {lo} AND drisk < {hi}), 0) AS INT) || ':' || count(*) FILTER (drisk >= {lo} AND drisk < {hi})"
        for lo, hi, name in bands
    )
    return f"""
        SELECT n_trips, n_days, late_pct, within_15_pct, CAST(round_even(100.0 * tp / (tp + fp), 0) AS INT) AS precision_pct,
            CAST(round_even(100.0 * tp / (tp + fn), 0) AS INT) AS recall_pct, tp, tn, fp, fn, bands
        FROM (SELECT count(*) AS n_trips, count(DISTINCT flight_date) AS n_days, CAST(round_even(100 * avg(real), 0) AS INT) AS late_pct,
                CAST(round_even(100 * avg({_TOLERANT}), 0) AS INT) AS within_15_pct,
                count(*) FILTER (drisk >= 0.2139 AND real = 1) AS tp, count(*) FILTER (drisk < 0.2139 AND real = 0) AS tn,
                count(*) FILTER (drisk >= 0.2139 AND real = 0) AS fp, count(*) FILTER (drisk < 0.2139 AND real = 1) AS fn,
                {text} AS bands
              FROM replay WHERE day(flight_date) = 15)"""


ORACLE = {
    "row_count": sql("trips", "SELECT count(*) AS n_rows FROM trips"),
    "ingest_new_months": """
        SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n_rows
        FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) BETWEEN 7 AND 12 GROUP BY ALL""",
    "weather_for_served_airports": sql(
        "weather served",
        """SELECT iata, date, coalesce(prcp, 0) AS prcp, coalesce(snow, 0) AS snow,
            coalesce(wspd, median(wspd) OVER ()) AS wspd, coalesce(tavg, median(tavg) OVER ()) AS tavg
        FROM weather WHERE iata IN (SELECT iata FROM served) AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'""",
    ),
    "profile_export": sql(
        "hubs",
        "SELECT iata, n_flights, {}, name, lat, lon FROM hubs WHERE lat IS NOT NULL AND lon IS NOT NULL".format(
            ", ".join(f"round_even({c}, 3) AS {c}" for c in FEATURES[1:])
        ),
    ),
    "climatology_map": sql(
        "clim",
        "SELECT iata || '_' || month AS key, {} FROM clim".format(", ".join(f"{half_even(c)} AS {c}" for c in MEASURES)),
    ),
    "coords_lookup": sql(
        "airports trips",
        """SELECT iata, city, round_even(lat, 4) AS lat4, round_even(lon, 4) AS lon4, round_even(lon, 3) AS lon3, round_even(lat, 3) AS lat3
        FROM airports WHERE iata IN (SELECT origin FROM trips UNION SELECT dest FROM trips)""",
    ),
    "typed_trips": sql("trips", "SELECT * FROM trips"),
    "landed_trip_files": sql(
        "trips",
        """SELECT flight_date, month, day_of_week, dep_hour, dep_min, dep_block, airline, tail, origin, dest, distance, crs_elapsed,
          cancelled, diverted, arr_delay, arr_del15, dep_del15 FROM trips""",
    ),
    "hhmm_split": sql(
        "trips",
        """SELECT flight_id, hhmm, hhmm // 100 % 24 AS dep_hour, hhmm // 100 * 60 + hhmm % 100 AS dep_min
        FROM (SELECT flight_id, CAST(h + CASE WHEN h < 100 THEN 2400 ELSE 0 END AS INT) AS hhmm
              FROM (SELECT flight_id, dep_min // 60 * 100 + dep_min % 60 AS h FROM trips))""",
    ),
    "feature_crosses": sql("trips", "SELECT flight_id, origin || '_' || dest AS route, origin || '_' || dep_hour AS orig_hour FROM trips"),
    "preview": sql(
        "trips",
        """SELECT flight_id, flight_date, airline, origin, dest, dep_hour, distance, arr_del15 FROM trips
        ORDER BY flight_date, flight_id LIMIT 5""",
    ),
    "model_ready": sql("ready", "SELECT flight_id, arr_del15, arr_delay, crs_elapsed FROM ready"),
    "temporal_split": sql(
        "ready",
        """SELECT CASE WHEN flight_date < DATE '2024-01-25' THEN 'train' ELSE 'test' END AS part, count(*) AS n,
            round(avg(arr_del15), 8) AS rate FROM ready GROUP BY ALL""",
    ),
    "delay_histogram": sql(
        "trips",
        """SELECT CAST(least(floor(60 * (arr_delay - lo) / (hi - lo)) + 1, 60) AS INT) AS bin, count(*) AS n
        FROM (SELECT arr_delay, min(arr_delay) OVER () AS lo, max(arr_delay) OVER () AS hi FROM trips
              WHERE cancelled = 0 AND arr_delay BETWEEN -30 AND 60) GROUP BY ALL""",
    ),
    "valid_codes": sql(
        "airports",
        """SELECT code, count(*) AS n FROM (SELECT substr(c_mktsegment, 1, 4) AS code FROM customer UNION ALL SELECT iata FROM airports)
        WHERE length(code) = 3 AND code <> '\\N' GROUP BY ALL""",
    ),
    "day_slice": sql(
        "trips",
        """SELECT flight_id, dep_min, arr_del15, crs_elapsed FROM trips WHERE flight_date = DATE '2024-01-15' AND cancelled = 0
            AND diverted = 0 AND crs_elapsed IS NOT NULL AND dep_min IS NOT NULL AND arr_del15 IS NOT NULL""",
    ),
    "active_at_minute": sql(
        "replay",
        """SELECT flight_id, dep, dur, drisk, concat_ws('_', o, d, dep, al) AS uid FROM replay
        WHERE flight_date = DATE '2024-01-15' AND 720 BETWEEN dep AND dep + dur AND drisk >= 0.2
        ORDER BY uid = 'A00_A01_700_click' DESC, dep DESC, flight_id LIMIT 40""",
    ),
    "landed_between": sql(
        "replay",
        """SELECT flight_date, tick, flight_id, dep, dur
        FROM (SELECT *, CAST(ceil((dep + dur) / 30.0) * 30 AS INT) AS tick FROM replay)
        QUALIFY row_number() OVER (PARTITION BY flight_date, tick ORDER BY dep, flight_id) <= 2""",
    ),
    "newest_landings": sql(
        "replay",
        """SELECT flight_id, dep + dur AS landed FROM replay WHERE flight_date = DATE '2024-01-15' AND dep + dur <= 900
        ORDER BY landed DESC, flight_id LIMIT 10""",
    ),
    "weather_enriched": sql(
        "trips weather",
        "SELECT flight_id, prcp, snow, wspd, tavg FROM trips LEFT JOIN weather ON iata = origin AND date = flight_date",
    ),
    "trip_endpoints": sql("endpoints", "SELECT flight_id, ocity, dcity, olat, olon, dlat, dlon FROM endpoints"),
    "airport_profile": sql("hubs", f"SELECT iata, n_flights, {rounded(FEATURES[1:])}, name, lat, lon FROM hubs"),
    "airport_state": sql(
        "hours states",
        """SELECT origin, flight_date, dep_hour, round(coalesce(airport_state, 0.2), 8) AS airport_state
        FROM hours LEFT JOIN states USING (origin, flight_date, dep_hour)""",
    ),
    "airport_state_selfjoin": sql("states", "SELECT origin, flight_date, dep_hour, round(airport_state, 8) AS airport_state FROM states"),
    "served_airports": sql("served", "SELECT * FROM served"),
    "request_defaults": sql(
        "requests busy",
        """SELECT request_id, CAST(coalesce(q.distance, b.distance, 800) AS DOUBLE) AS distance,
            CAST(coalesce(q.crs_elapsed, b.crs_elapsed, 120) AS DOUBLE) AS crs_elapsed
        FROM requests q LEFT JOIN busy b USING (origin, dest)""",
    ),
    "request_weather": sql(
        "meteo",
        "SELECT request_id, meteo_source, {} FROM meteo".format(", ".join(f"round_even({c}, 6) AS {c}" for c in MEASURES)),
    ),
    "rate_by_hour": sql("trips", "SELECT dep_hour, round(avg(arr_del15), 8) AS rate, count(*) AS n FROM trips WHERE cancelled = 0 GROUP BY ALL ORDER BY dep_hour"),
    "rate_by_dow": sql("trips", "SELECT day_of_week, round(avg(arr_del15), 8) AS rate FROM trips WHERE cancelled = 0 GROUP BY ALL ORDER BY day_of_week"),
    "rate_by_month": sql("trips", "SELECT month, round(avg(arr_del15), 8) AS rate FROM trips WHERE cancelled = 0 GROUP BY ALL ORDER BY month"),
    "rate_by_airline": sql(
        "trips",
        """SELECT airline, round(avg(arr_del15), 8) AS rate, count(*) AS n FROM trips WHERE cancelled = 0
        GROUP BY ALL HAVING count(*) > (SELECT count(*) * 198 // 1000 FROM trips) ORDER BY rate DESC""",
    ),
    "volume_vs_rate": sql(
        "trips",
        """SELECT origin, round(avg(arr_del15), 8) AS rate, count(*) AS n FROM trips WHERE cancelled = 0
        GROUP BY ALL HAVING count(*) > (SELECT count(*) * 10 // 1000 FROM trips) ORDER BY n DESC""",
    ),
    "overview_rates": sql(
        "trips",
        """SELECT round(avg(arr_del15), 3) AS late_arrival, round(avg(dep_del15), 3) AS late_departure,
            round(avg(cancelled), 4) AS cancelled_share, round(avg(diverted), 4) AS diverted_share FROM trips""",
    ),
    "null_shares": sql(
        "trips",
        "SELECT {} FROM trips".format(
            ", ".join(f"round(1 - count({c}) / count(*), 3) AS null_{c}" for c in ("arr_delay", "arr_del15", "dep_del15", "crs_elapsed", "tail"))
        ),
    ),
    "hourly_dep_rate": sql("hours", "SELECT origin, flight_date, dep_hour, round(dep_rate, 8) AS dep_rate FROM hours WHERE dep_rate IS NOT NULL"),
    "weather_climatology": sql("clim", f"SELECT iata, month, {rounded(MEASURES)} FROM clim"),
    "climatology_global": sql("clim", "SELECT {} FROM clim".format(", ".join(f"{half_even('avg(' + half_even(c) + ')')} AS {c}" for c in MEASURES))),
    "route_table": sql("routes", "SELECT * FROM routes"),
    "distinct_airports": sql("weather", "SELECT count(DISTINCT iata) AS n_distinct FROM weather"),
    "scoreboard_at": sql(
        "replay",
        f"""SELECT count(*) AS landed, round(avg(drisk), 8) AS mean_risk, round(avg(real), 8) AS late_share,
            round(avg({_TOLERANT}), 8) AS within_15_share FROM replay WHERE flight_date = DATE '2024-01-15' AND dep + dur <= 840""",
    ),
    "day_summary": sql(
        "replay",
        """SELECT flight_date, count(*) AS n, round(avg(real), 8) AS late_share, round(avg(risk), 8) AS mean_risk,
            round(avg(drisk), 8) AS mean_drisk FROM replay GROUP BY ALL""",
    ),
    "feature_label_corr": sql(
        "feat",
        "SELECT {} FROM feat WHERE cancelled = 0 AND arr_del15 IS NOT NULL".format(
            ", ".join(f"round({_corr(c, 'arr_del15')}, 6) AS corr_{c}" for c in EXTRA)
        ),
    ),
    "corr_matrix": sql(
        "trips",
        " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round({_corr(a, b)}, 6) AS r FROM trips WHERE cancelled = 0" for a in _MATRIX for b in _MATRIX),
    ),
    "delay_describe": sql(
        "trips",
        """SELECT count(arr_delay) AS count, round(avg(arr_delay), 1) AS mean, round(stddev_samp(arr_delay), 1) AS std,
            round(min(arr_delay), 1) AS min, round(quantile_cont(arr_delay, 0.25), 1) AS q25, round(quantile_cont(arr_delay, 0.5), 1) AS q50,
            round(quantile_cont(arr_delay, 0.75), 1) AS q75, round(max(arr_delay), 1) AS max
        FROM trips WHERE cancelled = 0 AND arr_delay BETWEEN -60 AND 180""",
    ),
    "weather_imputed": sql(
        "ready weather",
        """SELECT flight_id, coalesce(prcp, 0) AS prcp, coalesce(snow, 0) AS snow, coalesce(wspd, median(wspd) OVER ()) AS wspd,
            coalesce(tavg, median(tavg) OVER ()) AS tavg
        FROM ready LEFT JOIN weather ON iata = origin AND date = flight_date""",
    ),
    "delay_median": sql("trips", "SELECT round(median(arr_delay), 8) AS median FROM trips"),
    "prev_leg_delay": sql("legs", "SELECT flight_id, round(prev_arr_delay, 8) AS prev_arr_delay FROM legs"),
    "prev_leg_unregistered": sql(
        "trips",
        """SELECT flight_id, round(coalesce(lag(arr_delay) OVER day_of_tail, 0), 8) AS prev_arr_delay,
            CAST(coalesce(dep_min - lag(dep_min + coalesce(crs_elapsed, 120)) OVER day_of_tail, 240) AS INT) AS turnaround
        FROM (SELECT * REPLACE (CASE WHEN CAST(tail AS INT) % 3 <> 0 THEN tail END AS tail) FROM trips)
        WINDOW day_of_tail AS (PARTITION BY tail, flight_date ORDER BY dep_min, flight_id)""",
    ),
    "congestion": sql("trips", "SELECT flight_id, count(*) OVER (PARTITION BY origin, flight_date, dep_hour) AS dep_congestion FROM trips"),
    "turnaround": sql("legs", "SELECT flight_id, turnaround FROM legs"),
    "dayof_features": sql(
        "feat",
        """SELECT flight_id, flight_date, tail, origin, dest, dep_min, round(prev_arr_delay, 8) AS prev_arr_delay, dep_congestion,
            turnaround, round(airport_state, 8) AS airport_state FROM feat""",
    ),
    "features_after_landings": sql(
        "feat",
        """SELECT flight_id, flight_date, tail, origin, round(prev_arr_delay, 8) AS prev_arr_delay, dep_congestion, turnaround,
            round(airport_state, 8) AS airport_state FROM feat""",
    ),
    "airport_universe": sql("trips", "SELECT origin AS airport FROM trips UNION SELECT dest FROM trips ORDER BY 1"),
    "airline_universe": sql("trips", "SELECT DISTINCT airline FROM trips ORDER BY 1"),
    "rounding_modes": sql(
        "trips",
        """SELECT flight_id, round(arr_delay / 4, 0) AS half_up, round_even(CAST(distance AS DOUBLE) / 40, 0) AS half_even,
            CAST(round_even(CAST(crs_elapsed AS DOUBLE) / 4, 0) AS INT) AS half_even_int FROM trips""",
    ),
    "clipped_delay": sql("trips", "SELECT flight_id, CASE WHEN arr_delay IS NOT NULL THEN least(greatest(arr_delay, -30), 60) END AS clipped FROM trips"),
    "calendar_parts": sql("trips", "SELECT flight_id, month, day_of_week, dep_hour FROM trips"),
    "hhmm_label": sql("trips", "SELECT flight_id, printf('%02d:%02d', dep_min // 60, dep_min % 60) AS label FROM trips"),
    "labelled": sql(
        "trips",
        """SELECT flight_id, CASE airline WHEN 'click' THEN 'Click Air (click)' WHEN 'view' THEN 'View Lines (view)'
            WHEN 'purchase' THEN 'Purchase Jet (purchase)' ELSE airline END AS airline_label FROM trips""",
    ),
    "flight_positions": sql("replay", _positions()),
    "great_circle": sql(
        "endpoints",
        "SELECT flight_id, round({}, 8) AS angle FROM endpoints".format(_ARC.format(lon1="olon", lat1="olat", lon2="dlon", lat2="dlat")),
    ),
    "route_paths": sql("endpoints", _paths()),
    "risk_levels": sql(
        "replay",
        """SELECT flight_id, CASE WHEN risk >= 0.55 THEN 'Risque très élevé' WHEN risk >= 0.35 THEN 'Risque élevé'
            WHEN risk >= 0.2 THEN 'Risque modéré' ELSE 'Risque faible' END AS level FROM replay""",
    ),
    "risk_factors": sql(
        "meteo",
        f"SELECT request_id, CASE WHEN f = '' THEN 'Conditions favorables:faible' ELSE f END AS factors FROM (SELECT request_id, {_factors()} AS f FROM meteo)",
    ),
    "delay_label": sql(
        "replay",
        """SELECT flight_id, CASE WHEN delay >= 10 THEN '+' || delay || ' min' ELSE 'à l''heure' END AS actual,
            CASE WHEN dpdelay >= 10 THEN '+' || dpdelay || ' min' ELSE 'à l''heure' END AS predicted,
            CASE WHEN dpdelay >= 10 THEN 'en moyenne ~' || dpdelay || ' min de retard' ELSE 'à l''heure le plus souvent' END AS expected
        FROM replay""",
    ),
    "forecast_normalised": sql(
        "weather",
        """SELECT iata, date, round(coalesce(prcp, 0), 6) AS prcp, round(coalesce(snow, 0) * 10, 6) AS snow,
            coalesce(nullif(wspd, 0), 15) AS wspd, coalesce(nullif(tavg, 0), 15) AS tavg FROM weather""",
    ),
    "forecast_source": sql(
        "requests",
        """SELECT request_id, CASE WHEN date < DATE '2024-01-15' THEN 'archive' WHEN date IS NOT NULL THEN 'forecast' END AS source
        FROM requests""",
    ),
    "trip_ids": sql("trips", "SELECT flight_id, concat_ws('_', origin, dest, dep_min, airline) AS uid FROM trips"),
    "hash_sample": _sample("flight_id, origin, dest", "true"),
    "hash_sample_before_filter": _sample(
        "flight_id, origin, dest", "cancelled = 0 AND diverted = 0 AND arr_delay IS NOT NULL AND crs_elapsed IS NOT NULL"
    ),
    "target_encoding": sql(
        "test train whole", "SELECT flight_id, {} FROM test CROSS JOIN whole".format(",\n".join(_encoded(c) for c in CATEGORIES))
    ),
    "target_encoding_crossfit": sql(
        "train",
        "SELECT flight_id, {} FROM {}".format(
            ", ".join(f"round({c}_x.enc, 8) AS {c}_enc" for c in CATEGORIES),
            " JOIN ".join(f"({_crossfit(c)}) {c}_x" + (" USING (flight_id)" if i else "") for i, c in enumerate(CATEGORIES)),
        ),
    ).replace("\nSELECT flight_id", ",\nfolded AS (SELECT *, ascii(substr(md5(CAST(flight_id AS VARCHAR)), 1, 1)) % 5 AS fold FROM train)\nSELECT flight_id", 1),
    "standardised_profile": sql("zhubs", f"SELECT iata, {rounded(FEATURES, 6, '_z')} FROM zhubs"),
    "baseline_majority": sql(
        "test train",
        """SELECT 'majority' AS model, 0.5::DOUBLE AS auc, round(avg(arr_del15), 4) AS pr_auc,
            round(CASE WHEN any_value(b) >= any_value(t) THEN 2 * sum(arr_del15) / (count(*) + sum(arr_del15)) ELSE 0 END, 4) AS f1,
            round(avg(CAST(arr_del15 = CAST(b >= t AS INT) AS INT)), 4) AS accuracy
        FROM test, (SELECT avg(arr_del15) AS t, mode(arr_del15) AS b FROM train)""",
    ),
    "auc": sql("ranks", "SELECT round(sum(neg * (tp - pos / 2)) / any_value(p * q), 8) AS auc FROM ranks"),
    "average_precision": sql("ranks", "SELECT round(sum(pos * tp / (tp + fp)) / any_value(p), 8) AS average_precision FROM ranks"),
    "threshold_metrics": sql(
        "confusion",
        """SELECT CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn), 8) END AS f1,
            round((tp + tn) / (tp + tn + fp + fn), 8) AS accuracy FROM confusion""",
    ),
    "confusion_matrix": sql(
        "confusion",
        """SELECT 0 AS actual, 0 AS predicted, tn AS n FROM confusion UNION ALL SELECT 0, 1, fp FROM confusion
        UNION ALL SELECT 1, 0, fn FROM confusion UNION ALL SELECT 1, 1, tp FROM confusion""",
    ),
    "roc_curve": sql("ranks", "SELECT score, round(fp / q, 8) AS fpr, round(tp / p, 8) AS tpr FROM ranks"),
    "calibration": sql(
        "scored",
        """SELECT CAST(CASE WHEN score <= 0.15 THEN 0 WHEN score <= 0.25 THEN 1 WHEN score <= 0.35 THEN 2 WHEN score <= 0.5 THEN 3
            WHEN score <= 0.7 THEN 4 ELSE 5 END AS INT) AS bin, round(avg(score), 8) AS predicted, round(avg(arr_del15), 8) AS actual,
            count(*) AS n FROM scored WHERE score > 0 AND score <= 1.01 GROUP BY ALL""",
    ),
    "mean_calibration": sql("scored", "SELECT round(avg(score), 8) AS mean_predicted, round(avg(arr_del15), 8) AS mean_actual FROM scored"),
    "mae_minutes": sql("replay", "SELECT round(avg(abs(greatest(-30, least(240, delay)) - dpdelay)), 8) AS mae FROM replay"),
    "silhouette": sql("zhubs", _silhouette()).replace(
        "\nSELECT round", ",\nbanded AS (SELECT *, CAST(substr(iata, 2, 2) AS INT) % 3 AS band FROM zhubs)\nSELECT round", 1
    ),
    "clusters_from_fixed_starts": _clusters(3),
    "performance_report": sql("replay", _report()),
    "monthly_reference_days": sql("trips", "SELECT DISTINCT flight_date FROM trips WHERE day(flight_date) = 15"),
    "active_profile": sql(
        "replay",
        """SELECT t.flight_date, CAST(i * 10 AS INT) AS minute,
            (SELECT count(*) FROM replay r WHERE r.flight_date = t.flight_date AND i * 10 BETWEEN r.dep AND r.dep + r.dur) AS active, t.total
        FROM (SELECT flight_date, count(*) AS total FROM replay GROUP BY ALL) t, range(0, 144) AS s(i)""",
    ),
    "scoreboard_windows": sql(
        "replay",
        f"""SELECT strftime(date_trunc('hour', CAST(flight_date AS TIMESTAMP) + to_minutes(dep + dur)), '%Y-%m-%d %H:%M') AS hour_start,
            count(*) AS landed, round(avg(drisk), 8) AS mean_risk, round(avg(real), 8) AS late_share,
            round(avg({_TOLERANT}), 8) AS within_15_share FROM replay GROUP BY ALL""",
    ),
}
ORACLE["scoreboard_stream"] = ORACLE["scoreboard_windows"]
ORACLE["delivered_trip_files"] = ORACLE["landed_trip_files"]
ORACLE["state_stream"] = ORACLE["airport_state"]
ORACLE["prev_leg_stream"] = sql("legs", "SELECT flight_id, round(prev_arr_delay, 8) AS prev_arr_delay, turnaround FROM legs")
ORACLE["landings_stream"] = sql(
    "replay",
    """SELECT flight_id, concat_ws('_', o, d, dep, al) AS uid,
        strftime(CAST(flight_date AS TIMESTAMP) + to_minutes(dep + dur), '%Y-%m-%d %H:%M') AS landed_at, real, delay FROM replay""",
)
