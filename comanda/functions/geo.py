"""Great-circle distance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from comanda.constants import EARTH_RADIUS_KM


def great_circle(sin: Callable, cos: Callable, radians: Callable, atan2: Callable, sqrt: Callable) -> Callable:
    """The distance in km of (latitude, longitude) pairs, out of the functions of any library.

    What comes back names nothing of this package, so that tasks need not have
    it installed.
    """
    diameter_km = 2 * EARTH_RADIUS_KM

    def km(lat1, lon1, lat2, lon2):
        half_lat = sin(radians(lat2 - lat1) / 2)
        half_lon = sin(radians(lon2 - lon1) / 2)
        chord = half_lat * half_lat + cos(radians(lat1)) * cos(radians(lat2)) * (half_lon * half_lon)
        return atan2(sqrt(chord), sqrt(1 - chord)) * diameter_km

    return km


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return great_circle(F.sin, F.cos, F.radians, F.atan2, F.sqrt)(lat1, lon1, lat2, lon2)
