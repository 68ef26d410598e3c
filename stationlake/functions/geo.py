"""Great-circle distance and the grid that finds nearby stations by an equi-join.

The globe is cut into latitude rows of equal height. Every row has its own number of columns,
fewer towards the poles, so that cells stay about as wide as they are high. A circle around a
station therefore touches only about a dozen cells anywhere on the globe, poles included.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
MAX_ROWS = 180_000_000  # cells are at least a millionth of a degree high
MAX_COPIES = 24  # cells that the circle around one point can touch
_PAD = 1e-9  # degrees; keeps stations whose circle just touches a cell border


def distance_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance in kilometres."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * (
        half_lon * half_lon
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on a globe of radius 1."""
    lat, lon = F.radians(lat), F.radians(lon)
    return F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)


def chord_square(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Square of the straight line between two unit vectors; it grows with the distance.

    Comparing and ordering by it takes no trigonometry per pair.
    """
    x, y, z = (p - q for p, q in zip(a, b))
    return x * x + y * y + z * z


def chord_square_of(km: float) -> float:
    """Square of the chord of a distance."""
    half_angle = max(0.0, km) / EARTH_RADIUS_KM / 2
    return 4.0 if half_angle >= math.pi / 2 else (2 * math.sin(half_angle)) ** 2


def distance_of_chord(square: Column) -> Column:
    """Great-circle distance in kilometres of a squared chord."""
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(square) / 2))


def within(square: Column, km: float) -> Column:
    """Is the distance of a squared chord at most ``km``? Only borderline pairs need an arcsine."""
    limit = chord_square_of(km)
    clear, near = limit * (1 - 1e-9), limit * (1 + 1e-9) + 1e-24
    return (square <= near) & ((square < clear) | (distance_of_chord(square) <= F.lit(float(km))))


def _usable(lat: str, lon: str) -> str:
    """A point on the globe: no null, no NaN, no infinite longitude."""
    return f"{lat} BETWEEN -90.0D AND 90.0D AND abs({lon}) < double('Infinity')"


@dataclass(frozen=True)
class Grid:
    """Cells that are not smaller than the search radius."""

    radius_km: float
    rows: int

    @classmethod
    def for_radius(cls, radius_km: float) -> Grid:
        reach = math.degrees(max(radius_km, 0.0) / EARTH_RADIUS_KM)
        rows = MAX_ROWS if reach == 0 else int(min(MAX_ROWS, max(1, 180 // reach)))
        return cls(radius_km, rows)

    def _row(self, lat: str) -> str:
        row = f"floor(({lat} + 90.0D) * {self.rows / 180.0!r}D)"
        return f"cast(greatest(0, least({self.rows - 1}, {row})) AS bigint)"

    def _columns(self, row: str) -> str:
        """Number of columns of a row: twice the rows at the equator, one at the poles."""
        middle = f"({row} + 0.5D) * {180.0 / self.rows!r}D - 90.0D"
        return f"cast(greatest(1, floor(cos(radians({middle})) * {2 * self.rows})) AS bigint)"

    def _column(self, lon: str, columns: str) -> str:
        """Column of a longitude, counted on without wrapping at the antimeridian."""
        return f"floor(({lon} + 180.0D) * {columns} / 360.0D)"

    def _cell(self, row: str, column: str, columns: str) -> str:
        return f"{row} * {2 * self.rows + 1} + pmod({column}, {columns})"

    def cell(self, lat: str, lon: str) -> Column:
        """The one cell of a point; null when the point is not usable."""
        row = self._row(lat)
        columns = self._columns(row)
        cell = self._cell(row, self._column(lon, columns), columns)
        return F.expr(f"CASE WHEN {_usable(lat, lon)} THEN {cell} END")

    def touched_cells(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """One copy of each row per cell that its radius can reach, in column ``cell``."""
        reach = min(180.0, math.degrees(max(self.radius_km, 0.0) / EARTH_RADIUS_KM)) + _PAD
        # Half the width of the circle in degrees of longitude; null when it holds a pole.
        sine = math.sin(math.radians(min(reach, 90.0)))
        spread = f"degrees(asin(least(1.0D, {sine!r}D / cos(radians({lat}))))) + {_PAD!r}D"
        rows = f"sequence({self._row(f'({lat} - {reach!r}D)')}, {self._row(f'({lat} + {reach!r}D)')})"
        west = self._column(f"({lon} - _spread)", "_columns")
        east = self._column(f"({lon} + _spread)", "_columns")
        columns = (
            f"CASE WHEN _spread IS NULL OR {east} - {west} >= _columns "
            f"THEN sequence(0L, _columns - 1) ELSE sequence({west}, {east}) END"
        )
        return (
            df.filter(_usable(lat, lon))
            .selectExpr(
                "*",
                f"CASE WHEN abs({lat}) + {reach!r}D < 90.0D THEN {spread} END AS _spread",
                f"explode({rows}) AS _row",
            )
            .selectExpr("*", f"{self._columns('_row')} AS _columns")
            .selectExpr("*", f"explode({columns}) AS _column")
            .selectExpr(*df.columns, f"{self._cell('_row', '_column', '_columns')} AS cell")
        )
