"""Codes, levels and wording of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Carrier code to display name.
CARRIERS = {
    "9E": "Endeavor Air",
    "AA": "American",
    "AS": "Alaska",
    "B6": "JetBlue",
    "DL": "Delta",
    "F9": "Frontier",
    "G4": "Allegiant",
    "HA": "Hawaiian",
    "MQ": "Envoy Air",
    "NK": "Spirit",
    "OH": "PSA Airlines",
    "OO": "SkyWest",
    "UA": "United",
    "WN": "Southwest",
    "YX": "Republic",
}

# Upper bounds of the risk levels and their labels.
RISK_LEVELS = [(0.2, "Risque faible"), (0.35, "Risque modéré"), (0.55, "Risque élevé")]
RISK_TOP = "Risque très élevé"

# Wording of factors, levels, modes and weather sources.
LOW, MEDIUM, HIGH = "faible", "moyen", "fort"
SNOW, RAIN, WIND = "Neige au départ", "Pluie au départ", "Vent fort"
EVENING, MORNING = "Départ en soirée", "Départ tôt le matin"
PREVIOUS_LATE, PREVIOUS_SLIGHT, PREVIOUS_FINE = (
    "Avion précédent en retard de %d min",
    "Avion précédent un peu en retard",
    "Avion précédent à l'heure",
)
NO_FACTOR = "Conditions favorables"
MODE_DAYOF, MODE_BOOKING = "jour du vol", "réservation"
WEATHER_REAL, WEATHER_TYPICAL = "réelle", "typique"
ON_TIME, ON_TIME_LIKELY = "à l'heure", "à l'heure le plus souvent"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named_code(code: Column | str, names: dict[str, str] | None = None) -> Column:
    """`Name (code)` for known codes, the bare code otherwise. For dictionaries of fixed, small size."""
    code = _col(code)
    pairs = [F.lit(x) for pair in (names or CARRIERS).items() for x in pair]
    name = F.try_element_at(F.create_map(*pairs), code)
    return F.when(name.isNotNull(), F.format_string("%s (%s)", name, code)).otherwise(code)


def risk_level(risk: Column | str) -> Column:
    risk = _col(risk)
    label = F.when(risk < RISK_LEVELS[0][0], RISK_LEVELS[0][1])
    for bound, name in RISK_LEVELS[1:]:
        label = label.when(risk < bound, name)
    return label.when(risk.isNotNull(), RISK_TOP)


def delay_text(minutes: Column | str) -> Column:
    minutes = _col(minutes)
    return F.when(minutes < 10, ON_TIME).when(minutes >= 10, F.format_string("+%d min", minutes))


def expected_delay_text(minutes: Column | str) -> Column:
    minutes = _col(minutes)
    return F.when(minutes < 10, ON_TIME_LIKELY).when(
        minutes >= 10, F.format_string("en moyenne ~%d min de retard", minutes)
    )


def trip_uid(*parts: str) -> Column:
    """Readable identity of a trip within a day: origin, destination, departure minute, carrier."""
    return F.concat_ws("_", *[F.col(p) for p in parts])


def clip_delay(delay: Column | str, low: float = -30, high: float = 240) -> Column:
    """Delay bounded to [low, high]; unknown stays unknown."""
    delay = _col(delay)
    return F.when(delay.isNotNull(), F.least(F.greatest(delay, F.lit(low)), F.lit(high)))


def risk_factors(prcp, snow, wspd, hour, previous) -> Column:
    """Ordered array of (label, level): previous leg first, then weather, then time of day; never empty."""
    prcp, snow, wspd, hour, previous = (_col(c) for c in (prcp, snow, wspd, hour, previous))

    def factor(label, level: str) -> Column:
        return F.struct((label if isinstance(label, Column) else F.lit(label)).alias("label"), F.lit(level).alias("level"))

    leg = (
        F.when(previous >= 30, factor(F.format_string(PREVIOUS_LATE, previous), HIGH))
        .when(previous >= 15, factor(PREVIOUS_SLIGHT, MEDIUM))
        .when(previous.isNotNull(), factor(PREVIOUS_FINE, LOW))
    )
    fall = F.when(snow > 1, factor(SNOW, HIGH)).when(prcp > 8, factor(RAIN, MEDIUM))
    wind = F.when(wspd > 30, factor(WIND, MEDIUM))
    time = F.when(hour >= 17, factor(EVENING, MEDIUM)).when(hour <= 8, factor(MORNING, LOW))
    found = F.filter(F.array(leg, fall, wind, time), lambda x: x.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.array(factor(NO_FACTOR, LOW)))
