"""Column expressions shared by the operators; all of them stay in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(value: Column) -> Column:
    """NaN is no data, and no data is null."""
    return F.when(~F.isnan(value), value)


def noleap_doy(date: Column) -> Column:
    """Day 1..365 of a calendar without 29 February; null on that day."""
    leap = F.dayofyear(F.make_date(F.year(date), F.lit(12), F.lit(31))) == 366
    day = F.dayofyear(date)
    return F.when(leap & (day == 60), None).otherwise(F.when(leap & (day > 60), day - 1).otherwise(day)).cast("int")


def noleap_date(year: Column, doy: Column) -> Column:
    """The date of a day 1..365 of a year without 29 February."""
    leap = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - F.when(leap & (doy >= 60), 0).otherwise(1))


def days_in_month(date: Column) -> Column:
    return F.dayofmonth(F.last_day(date))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def quantile_type8(sorted_values: Column, p: float) -> Column:
    """Hyndman-Fan type 8 quantile (both plotting constants a third) of a sorted array without nulls."""
    n = F.size(sorted_values)
    h = (n + 1.0 / 3) * p + 1.0 / 3
    low = F.greatest(F.lit(1), F.least(n, F.floor(h).cast("int")))
    high = F.greatest(F.lit(1), F.least(n, low + 1))
    weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), h - low))
    a, b = F.try_element_at(sorted_values, low), F.try_element_at(sorted_values, high)
    return F.when(n > 0, a + weight * (b - a))


# Albers equal-area conic on the GRS 80 ellipsoid, by the formulas in Snyder, Map Projections: A Working Manual (1987), chapter 14.
_A, _E2 = 6378137.0, 0.0066943800229
_E = math.sqrt(_E2)


def _q(s: float) -> float:
    return (1 - _E2) * (s / (1 - _E2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


class Albers:
    """Forward and inverse projection as column expressions; defaults are EPSG:3338."""

    def __init__(self, lat1: float = 55.0, lat2: float = 65.0, lat0: float = 50.0, lon0: float = -154.0):
        m = [math.cos(math.radians(x)) / math.sqrt(1 - _E2 * math.sin(math.radians(x)) ** 2) for x in (lat1, lat2)]
        q = [_q(math.sin(math.radians(x))) for x in (lat1, lat2, lat0)]
        self.n = (m[0] ** 2 - m[1] ** 2) / (q[1] - q[0])
        self.c = m[0] ** 2 + self.n * q[0]
        self.rho0 = _A * math.sqrt(self.c - self.n * q[2]) / self.n
        self.lon0 = lon0

    def forward(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        s = F.sin(F.radians(lat))
        q = (1 - _E2) * (s / (1 - _E2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
        rho = _A * F.sqrt(self.c - self.n * q) / self.n
        theta = self.n * F.radians(F.pmod(lon - self.lon0 + 180.0, F.lit(360.0)) - 180.0)
        return rho * F.sin(theta), self.rho0 - rho * F.cos(theta)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        rho = F.sqrt(x * x + (self.rho0 - y) * (self.rho0 - y))
        q = (self.c - rho * rho * self.n * self.n / (_A * _A)) / self.n
        lon = F.degrees(F.atan2(x, self.rho0 - y) / self.n) + self.lon0
        qp = _q(1.0)
        beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / qp)))
        e2, e4, e6 = _E2, _E2**2, _E2**3
        lat = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
        return F.degrees(lat), lon


def polar_xy(lat: Column, lon: Column, lat_true: float = 64.0, lon0: float = -152.0, radius: float = 6370000.0) -> tuple[Column, Column]:
    """Spherical north polar-stereographic x and y, true at lat_true."""
    k = radius * (1 + math.sin(math.radians(lat_true)))
    rho = k * F.tan(F.lit(math.pi / 4) - F.radians(lat) / 2)
    theta = F.radians(lon - lon0)
    return rho * F.sin(theta), -rho * F.cos(theta)
