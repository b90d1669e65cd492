"""Closed-form map projections as Column expressions (no Python per row).

Supported systems: EPSG:4326 (also CRS84), EPSG:3035, the UTM zones
EPSG:32601-32660 and 32701-32760, and those of ``SYSTEMS``: Mercator, conformal
conic and polar stereographic projections by their parameters. Datum differences
between them are below the precision this library works at and are treated as zero.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid, EPSG:3035 and UTM parameters.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
LAEA_LAT0, LAEA_LON0 = 52.0, 10.0
LAEA_FALSE_E, LAEA_FALSE_N = 4321000.0, 3210000.0
UTM_SCALE, UTM_FALSE_E, UTM_FALSE_N_SOUTH = 0.9996, 500000.0, 10000000.0

E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)


def _authalic_q(sin_phi: float) -> float:
    es = E * sin_phi
    return (1 - E2) * (sin_phi / (1 - es * es) - math.log((1 - es) / (1 + es)) / (2 * E))


_QP = _authalic_q(1.0)
_SIN_B0 = _authalic_q(math.sin(math.radians(LAEA_LAT0))) / _QP
_COS_B0 = math.sqrt(1 - _SIN_B0**2)
_RQ = SEMI_MAJOR * math.sqrt(_QP / 2)
_SIN_PHI0 = math.sin(math.radians(LAEA_LAT0))
_D = (
    SEMI_MAJOR
    * (math.cos(math.radians(LAEA_LAT0)) / math.sqrt(1 - E2 * _SIN_PHI0**2))
    / (_RQ * _COS_B0)
)

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series coefficients of the transverse Mercator, to fourth order.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)
# Latitude series of the inverse equal-area projection.
_LAT2 = E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040
_LAT4 = 23 * E2**2 / 360 + 251 * E2**3 / 3780
_LAT6 = 761 * E2**3 / 45360


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def xy(x: Column, y: Column) -> Column:
    return F.array(x, y)


def laea_forward(lon: Column, lat: Column) -> Column:
    """EPSG:4326 degrees to EPSG:3035 metres, as array(x, y)."""

    def from_trig(t: Column) -> Column:
        sin_b, cos_dl, sin_dl = t["sin_b"], t["cos_dl"], t["sin_dl"]
        cos_b = F.sqrt(1 - sin_b * sin_b)
        return let(
            F.struct(
                cos_b.alias("cos_b"),
                (_RQ * F.sqrt(2 / (1 + _SIN_B0 * sin_b + _COS_B0 * cos_b * cos_dl))).alias("k"),
            ),
            lambda u: xy(
                LAEA_FALSE_E + u["k"] * _D * u["cos_b"] * sin_dl,
                LAEA_FALSE_N + u["k"] / _D * (_COS_B0 * sin_b - _SIN_B0 * u["cos_b"] * cos_dl),
            ),
        )

    def from_sine(s: Column) -> Column:
        es = E * s
        q = (1 - E2) * (s / (1 - es * es) - F.ln((1 - es) / (1 + es)) / (2 * E))
        dl = F.radians(lon - LAEA_LON0)
        return let(
            F.struct(
                (q / _QP).alias("sin_b"), F.cos(dl).alias("cos_dl"), F.sin(dl).alias("sin_dl")
            ),
            from_trig,
        )

    return let(F.sin(F.radians(lat)), from_sine)


def laea_inverse(x: Column, y: Column) -> Column:
    """EPSG:3035 metres to EPSG:4326 degrees, as array(lon, lat)."""
    dx, dy = x - LAEA_FALSE_E, y - LAEA_FALSE_N

    def from_rho(rho: Column) -> Column:
        return let(
            F.struct(rho.alias("rho"), (2 * F.asin(rho / (2 * _RQ))).alias("c")), from_angle
        )

    def from_angle(t: Column) -> Column:
        rho, sin_c, cos_c = t["rho"], F.sin(t["c"]), F.cos(t["c"])
        b = F.asin(cos_c * _SIN_B0 + _D * dy * sin_c * _COS_B0 / rho)
        lon = F.atan2(dx * sin_c, _D * rho * _COS_B0 * cos_c - _D * _D * dy * _SIN_B0 * sin_c)
        return let(
            b,
            lambda v: xy(
                LAEA_LON0 + F.degrees(lon),
                F.degrees(
                    v + _LAT2 * F.sin(2 * v) + _LAT4 * F.sin(4 * v) + _LAT6 * F.sin(6 * v)
                ),
            ),
        )

    rho = F.sqrt((dx / _D) * (dx / _D) + (_D * dy) * (_D * dy))
    origin = xy(F.lit(LAEA_LON0), F.lit(LAEA_LAT0))
    return F.when(rho == 0, origin).otherwise(let(rho, from_rho))


def _utm_zone(epsg: Column) -> tuple[Column, Column]:
    lon0 = (epsg % 100) * 6 - 183.0
    false_n = F.when(epsg >= 32700, F.lit(UTM_FALSE_N_SOUTH)).otherwise(F.lit(0.0))
    return lon0, false_n


def utm_forward(lon: Column, lat: Column, epsg: Column) -> Column:
    """EPSG:4326 degrees to the UTM zone ``epsg``, as array(x, y)."""
    lon0, false_n = _utm_zone(epsg)
    k = 2 * math.sqrt(_N) / (1 + _N)
    sin_phi = F.sin(F.radians(lat))

    def from_t(v: Column) -> Column:
        t, dl = v["t"], v["dl"]
        return let(
            F.struct(
                F.atan2(t, F.cos(dl)).alias("xi"),
                F.atanh(F.sin(dl) / F.sqrt(1 + t * t)).alias("eta"),
            ),
            series,
        )

    def series(w: Column) -> Column:
        xi, eta = w["xi"], w["eta"]
        north, east = xi, eta
        for j, a in enumerate(_ALPHA, start=1):
            north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return xy(
            UTM_FALSE_E + UTM_SCALE * _RECTIFYING * east,
            false_n + UTM_SCALE * _RECTIFYING * north,
        )

    return let(
        F.struct(
            F.sinh(F.atanh(sin_phi) - k * F.atanh(k * sin_phi)).alias("t"),
            F.radians(lon - lon0).alias("dl"),
        ),
        from_t,
    )


def utm_inverse(x: Column, y: Column, epsg: Column) -> Column:
    """The UTM zone ``epsg`` to EPSG:4326 degrees, as array(lon, lat)."""
    lon0, false_n = _utm_zone(epsg)
    scale = UTM_SCALE * _RECTIFYING

    def series(w: Column) -> Column:
        xi, eta = w["xi"], w["eta"]
        xi1, eta1 = xi, eta
        for j, b in enumerate(_BETA, start=1):
            xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return let(F.struct(xi1.alias("xi"), eta1.alias("eta")), to_degrees)

    def to_degrees(w: Column) -> Column:
        return let(F.asin(F.sin(w["xi"]) / F.cosh(w["eta"])), lambda chi: finish(w, chi))

    def finish(w: Column, chi: Column) -> Column:
        lat = chi
        for j, d in enumerate(_DELTA, start=1):
            lat = lat + d * F.sin(2 * j * chi)
        return xy(
            lon0 + F.degrees(F.atan2(F.sinh(w["eta"]), F.cos(w["xi"]))),
            F.degrees(lat),
        )

    return let(
        F.struct(
            ((y - false_n) / scale).alias("xi"), ((x - UTM_FALSE_E) / scale).alias("eta")
        ),
        series,
    )


@dataclass(frozen=True)
class Conformal:
    """A conformal projection as a function of the isometric latitude; angles in degrees.

    ``kind`` is ``mercator``, ``conic`` or ``polar``. ``lat1`` and ``lat2`` are the standard parallels (one is enough for
    Mercator and polar), ``lat0`` the latitude of the false origin of a conic. ``flattening`` 0 makes a sphere.
    """

    kind: str
    lon0: float
    lat1: float
    lat2: float = 0.0
    lat0: float = 0.0
    false_e: float = 0.0
    false_n: float = 0.0
    semi_major: float = SEMI_MAJOR
    flattening: float = FLATTENING
    scale: float | None = None

    @property
    def ecc(self) -> float:
        return math.sqrt(self.flattening * (2 - self.flattening))

    def isometric(self, lat: float) -> float:
        """Isometric latitude of degrees."""
        s = math.sin(math.radians(lat))
        return math.atanh(s) - self.ecc * math.atanh(self.ecc * s)

    def parallel(self, lat: float) -> float:
        """Radius of a parallel, in semi-major axes."""
        p = math.radians(lat)
        return math.cos(p) / math.sqrt(1 - (self.ecc * math.sin(p)) ** 2)

    @property
    def cone(self) -> tuple[float, float, float]:
        """Cone constant n, radius factor f and the radius at the origin: radius = f * exp(-n * isometric latitude)."""
        if self.kind == "polar":
            sign = -1.0 if self.lat1 < 0 else 1.0
            true = self.parallel(self.lat1) * math.exp(sign * self.isometric(self.lat1)) if abs(self.lat1) < 90 else 2 / math.sqrt((1 + self.ecc) ** (1 + self.ecc) * (1 - self.ecc) ** (1 - self.ecc))
            return sign, sign * self.semi_major * true * (self.scale or 1.0), 0.0
        one, two = self.parallel(self.lat1), self.parallel(self.lat2)
        q1, q2 = self.isometric(self.lat1), self.isometric(self.lat2)
        n = math.sin(math.radians(self.lat1)) if q1 == q2 else math.log(one / two) / (q2 - q1)
        f = self.semi_major * one * math.exp(n * q1) / n * (self.scale or 1.0)
        return n, f, f * math.exp(-n * self.isometric(self.lat0))

    def forward(self, lon: Column, lat: Column) -> Column:
        """Degrees to metres, as array(x, y)."""

        def placed(q: Column) -> Column:
            if self.kind == "mercator":
                k = self.semi_major * (self.scale or self.parallel(self.lat1))
                return xy(self.false_e + k * F.radians(_turned(lon - self.lon0)), self.false_n + k * q)
            n, f, r0 = self.cone
            # f has the sign of n, and so has the radius: a cone that opens to the south is the same formula
            polar = F.struct((f * F.exp(-n * q)).alias("r"), (F.radians(_turned(lon - self.lon0)) * n).alias("a"))
            return let(polar, lambda t: xy(self.false_e + t["r"] * F.sin(t["a"]), self.false_n + r0 - t["r"] * F.cos(t["a"])))

        return let(F.sin(F.radians(lat)), lambda s: let(F.atanh(s) - self.ecc * F.atanh(self.ecc * s), placed))

    def inverse(self, x: Column, y: Column) -> Column:
        """Metres to degrees, as array(lon, lat)."""
        east, north = x - self.false_e, y - self.false_n
        if self.kind == "mercator":
            k = self.semi_major * (self.scale or self.parallel(self.lat1))
            return self._placed(F.degrees(east / k), north / k)
        n, f, r0 = self.cone
        sign = math.copysign(1.0, n)
        side, down = sign * east, sign * (r0 - north)
        radius = F.sqrt(side * side + down * down)
        # the pole itself: an isometric latitude large enough to come out as 90 degrees
        q = F.when(radius == 0, F.lit(40.0 / n)).otherwise(-F.ln(radius / abs(f)) / n)
        return self._placed(F.degrees(F.atan2(side, down)) / n, q)

    def _placed(self, turn: Column, q: Column) -> Column:
        """Degrees of a longitude difference and an isometric latitude, by the series of the conformal latitude."""
        e2 = self.ecc**2
        # Series coefficients of the latitude in terms of the conformal latitude, to the eighth power of e.
        series = (
            e2 / 2 + 5 * e2**2 / 24 + e2**3 / 12 + 13 * e2**4 / 360,
            7 * e2**2 / 48 + 29 * e2**3 / 240 + 811 * e2**4 / 11520,
            7 * e2**3 / 120 + 81 * e2**4 / 1120,
            4279 * e2**4 / 161280,
        )

        def finish(chi: Column) -> Column:
            lat = chi
            for j, c in enumerate(series, start=1):
                lat = lat + c * F.sin(2 * j * chi)
            return let(closer(lat), lambda v: xy(_turned(self.lon0 + turn), F.degrees(closer(v))))

        def closer(lat: Column) -> Column:
            # a fixed-point step leaves e^2 of the error that the series has left
            return F.asin(F.tanh(q + self.ecc * F.atanh(self.ecc * F.sin(lat))))

        return let(F.asin(F.tanh(q)), finish)


def _turned(degrees: Column) -> Column:
    """A longitude brought into [-180, 180]."""
    return F.when(F.abs(degrees) <= 180, degrees).otherwise(F.pmod(degrees + 180, F.lit(360.0)) - 180)


# Parameters of EPSG systems.
SYSTEMS: dict[int, Conformal] = {
    3857: Conformal("mercator", 0, 0, flattening=0.0),
    3395: Conformal("mercator", 0, 0),
    2154: Conformal("conic", 3, 49, 44, 46.5, 700000, 6600000),
    3034: Conformal("conic", 10, 35, 65, 52, 4000000, 2800000),
    3413: Conformal("polar", -45, 70),
    3031: Conformal("polar", 0, -71),
}


def _is_utm(epsg: Column) -> Column:
    return epsg.between(32601, 32660) | epsg.between(32701, 32760)


def _unsupported(epsg: Column) -> Column:
    message = F.concat(F.lit("unsupported coordinate system EPSG:"), epsg.cast("string"))
    return F.raise_error(message).cast("array<double>")


def from_lonlat(lon: Column, lat: Column, epsg: Column) -> Column:
    """Degrees to the system of each row's ``epsg``, as array(x, y)."""
    chosen = (
        F.when(epsg == 4326, xy(lon, lat))
        .when(epsg == 3035, laea_forward(lon, lat))
        .when(_is_utm(epsg), utm_forward(lon, lat, epsg))
    )
    for number, system in SYSTEMS.items():
        chosen = chosen.when(epsg == number, system.forward(lon, lat))
    return chosen.otherwise(_unsupported(epsg))


def to_lonlat(x: Column, y: Column, epsg: Column) -> Column:
    """The system of each row's ``epsg`` to degrees, as array(lon, lat)."""
    chosen = (
        F.when(epsg == 4326, xy(x, y))
        .when(epsg == 3035, laea_inverse(x, y))
        .when(_is_utm(epsg), utm_inverse(x, y, epsg))
    )
    for number, system in SYSTEMS.items():
        chosen = chosen.when(epsg == number, system.inverse(x, y))
    return chosen.otherwise(_unsupported(epsg))


def crs_epsg(crs: Column) -> Column:
    """EPSG number of a CRS name; a missing name and CRS84 both mean 4326."""
    code = F.regexp_extract(crs, r"(?i)EPSG:+(?:[0-9.]*:)?(\d+)$", 1)
    return (
        F.when(crs.isNull() | crs.rlike(r"(?i)CRS:?84$"), F.lit(4326))
        .when(code != "", F.try_to_number(code, F.lit("999999")).cast("int"))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported crs: "), crs)).cast("int"))
    )
