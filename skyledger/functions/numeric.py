"""Numbers: tolerant parsing, circular means, bands, rendering and pressure reduction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FLOAT_GUARD = (
    r"^\s*[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?|(?i:nan|inf|infinity))\s*$"
)

# Dashboard temperature bands as (lower bound, colour), lowest first.
TEMPERATURE_BANDS = [(None, "blue"), (10.0, "green"), (25.0, "yellow"), (30.0, "orange"), (35.0, "red")]

# Gravity, molar mass of air, gas constant and standard temperature (SI units).
GRAVITY, MOLAR_MASS, GAS_CONSTANT, STANDARD_KELVIN = 9.80665, 0.0289644, 8.31446, 288.15


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_float_or_null(text: Column | str) -> Column:
    """A decimal, exponent, nan or infinity literal, blanks and digit underscores allowed; otherwise NULL."""
    return F.replace(F.regexp_extract(_col(text), FLOAT_GUARD, 0), F.lit("_"), F.lit("")).try_cast("double")


def circular_mean_deg(degrees: Column | str, normalise: bool = False) -> Column:
    """Mean direction in (-180, 180], or in [0, 360) when normalised; NULL without values."""
    angle = F.radians(_col(degrees))
    mean = F.degrees(F.atan2(F.avg(F.sin(angle)), F.avg(F.cos(angle))))
    return F.pmod(mean, F.lit(360.0)) if normalise else mean


def round_numeric(value: Column | str, places: int) -> Column:
    """A double as an exact number of fifteen significant digits, then rounded half away from zero.

    Going by significant digits keeps a mean such as 2.675 a tie, whatever its last binary digit.
    """
    return F.round(F.format_string("%.14e", _col(value)).try_cast("decimal(38,15)"), places)


def threshold_band(value: Column | str, steps: list[tuple[float | None, str]]) -> Column:
    """Label of the highest step whose lower bound the value reaches; NULL stays NULL."""
    col = _col(value)
    floor, *rest = steps
    band = F.lit(floor[1])
    for bound, label in rest:
        band = F.when(col >= F.lit(bound), F.lit(label)).otherwise(band)
    return F.when(col.isNotNull(), band)


def format_value(value: Column | str, decimals: Column | int, unit: Column | str = "") -> Column:
    """``12.3 hPa`` style text, ``null`` for a missing value."""
    unit = unit if isinstance(unit, Column) else F.lit(unit)
    places = decimals if isinstance(decimals, Column) else F.lit(decimals)
    pattern = F.concat(F.lit("%."), places.cast("string"), F.lit("f %s"))
    text = F.call_function("format_string", pattern, _col(value), unit)
    return F.coalesce(F.when(_col(value).isNotNull(), F.rtrim(text)), F.lit("null"))


def sea_level_pressure(pressure: Column | str, elevation: Column | str, temperature_c: Column | str | None = None) -> Column:
    """Station pressure brought to sea level with the exponential barometric formula."""
    kelvin = F.lit(STANDARD_KELVIN) if temperature_c is None else _col(temperature_c) + F.lit(273.15)
    return _col(pressure) * F.exp(F.lit(GRAVITY * MOLAR_MASS / GAS_CONSTANT) * _col(elevation) / kelvin)
