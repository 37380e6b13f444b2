"""The station dimension and the fixed id lists that go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from skyledger.session import literal_table

STATION_SCHEMA = (
    "fiwareid string, station_type string, display_name string, historical_name string, "
    "lat double, lon double, is_active boolean, notes string"
)

# The sixteen current stations.
STATIONS = [
    ("A01_AVFRANCIA_60m", "air", "Francia", "Avda. Francia", 39.45782688751831, -0.342986232422652, True, None),
    ("A02_BULEVARDSUD_60m", "air", "Boulevar Sur", "Bulevard Sud", 39.45039600550536, -0.3963375643758562, True, None),
    ("A03_MOLISOL_60m", "air", "Molí del Sol", "Moli del Sol", 39.48111211090413, -0.4088098969009376, True, None),
    ("A04_PISTASILLA_60m", "air", "Pista de Silla", "Pista Silla", 39.45806095369672, -0.37664393657915707, True, None),
    ("A05_POLITECNIC_60m", "air", "Universidad Politécnica", "Politecnico", 39.47964449692915, -0.33740066052186946, True, None),
    ("A06_VIVERS_60m", "air", "Viveros", "Viveros", 39.47964092480533, -0.36964822314381013, True, None),
    ("A07_VALENCIACENTRE_60m", "air", "Centro", "Valencia Centro", 39.470547670260125, -0.37639765165532396, True, None),
    ("A08_DR_LLUCH_60m", "air", "Dr. Lluch", None, 39.46668475546108, -0.3282894894027388, True, "New station, no historical data"),
    ("A09_CABANYAL_60m", "air", "Cabanyal", None, 39.47439078535677, -0.32853481349274394, True, "New station, no historical data"),
    ("A10_OLIVERETA_60m", "air", "Olivereta", "Valencia Olivereta", 39.46924423509195, -0.40592344552906795, True, None),
    ("A11_PATRAIX_60m", "air", "Patraix", None, 39.45918908999643, -0.4014113292191286, True, "New station, no historical data"),
    ("W01_AVFRANCIA_10m", "weather", "Avd. Francia", "Avda. Francia", 39.457525999921394, -0.34266599991045765, True, None),
    ("W02_NAZARET_10m", "weather", "Nazaret", "Nazaret Meteo", 39.4485309997218, -0.3332980005434063, True, None),
    ("W03_VALENCIAAEROPUERTO_10m", "weather", "Aeropuerto", None, 39.489999999779805, -0.4699999998718748, True, "New station, AEMET 8414A available"),
    ("W04_VALENCIADT_10m", "weather", "Jardines de Viveros", "Viveros", 39.479999999578624, -0.36999999999057726, True, 'Historical "Viveros" weather data'),
    ("W05_VALENCIA_UPV_10m", "weather", "UPV", "Politecnico", 39.48000000035075, -0.3400000005661824, True, 'Historical "Politecnico" weather data'),
]

# The place recorded for each historical name (history rows of either type use it).
HISTORICAL_PLACES = [
    ("Avda. Francia", 39.45782688751831, -0.342986232422652),
    ("Bulevard Sud", 39.45039600550536, -0.3963375643758562),
    ("Moli del Sol", 39.48111211090413, -0.4088098969009376),
    ("Pista Silla", 39.45806095369672, -0.37664393657915707),
    ("Politecnico", 39.47964449692915, -0.33740066052186946),
    ("Viveros", 39.47964092480533, -0.36964822314381013),
    ("Valencia Centro", 39.470547670260125, -0.37639765165532396),
    ("Valencia Olivereta", 39.46924423509195, -0.40592344552906795),
    ("Nazaret Meteo", 39.4485309997218, -0.3332980005434063),
]

# Retired weather ids, rewritten or dropped when ids are consolidated.
RETIRED_IDS = [("W06_VIVERS_10m", "W04_VALENCIADT_10m")]
DROPPED_IDS = ["W07_VALENCIACENTRE_10m", "W_CONSELLERIA_10m"]

# Metres above sea level named for pressure reduction.
ELEVATIONS = [("W03_VALENCIAAEROPUERTO_10m", 73.0), ("W02_NAZARET_10m", 3.0), ("W01_AVFRANCIA_10m", 7.5)]


def station_dimension(spark: SparkSession) -> DataFrame:
    return literal_table(spark, STATIONS, STATION_SCHEMA)


def historical_names(spark: SparkSession, station_type: str) -> DataFrame:
    """``(historical_name, fiwareid, lat, lon)`` for one station type; the place comes by name."""
    places = {name: (lat, lon) for name, lat, lon in HISTORICAL_PLACES}
    rows = [
        (s[3], s[0], *places.get(s[3], (None, None)))
        for s in STATIONS
        if s[1] == station_type and s[3] is not None
    ]
    return literal_table(spark, rows, "historical_name string, fiwareid string, lat double, lon double")


def retired_ids(spark: SparkSession) -> DataFrame:
    return literal_table(spark, RETIRED_IDS, "old_id string, new_id string")
