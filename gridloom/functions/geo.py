"""Web Mercator, tile and grid arithmetic as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_WORLD = 20037508.342789244  # metres from the origin to the edge of EPSG:3857
MAX_LATITUDE = 85.0511287798066
SEASON_METRES, METRES_PER_DEGREE = 150000.0, 111320.0


def _col(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def mercator_x(lon: Column | str) -> Column:
    return _col(lon) * HALF_WORLD / 180.0


def mercator_y(lat: Column | str) -> Column:
    clamped = F.least(F.greatest(_col(lat), F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE))
    return F.log(F.tan((90.0 + clamped) * math.pi / 360.0)) / (math.pi / 180.0) * HALF_WORLD / 180.0


def longitude(x: Column | str) -> Column:
    return _col(x) / HALF_WORLD * 180.0


def latitude(y: Column | str) -> Column:
    """Of a Web Mercator ordinate; also the latitude of a pixel row's centre."""
    return F.degrees(F.atan(F.sinh(_col(y) * math.pi / HALF_WORLD)))


def pixel_size(zoom: Column | str | int, tile: int = 256) -> Column:
    return F.lit(2 * HALF_WORLD) / (F.lit(float(tile)) * F.pow(F.lit(2.0), _col(zoom)))


def snap(low: Column, high: Column, size: Column | float) -> tuple[Column, Column]:
    """An interval widened to the global grid that is anchored at the world's edge."""
    size = _col(size)
    return F.floor((low + HALF_WORLD) / size) * size - HALF_WORLD, F.ceil((high + HALF_WORLD) / size) * size - HALF_WORLD


def tile_at(x: Column | str, y: Column | str, zoom: int) -> tuple[Column, Column]:
    """The XYZ tile of a point."""
    size = 2 * HALF_WORLD / 2**zoom
    return F.floor((_col(x) + HALF_WORLD) / size).cast("int"), F.floor((F.lit(HALF_WORLD) - _col(y)) / size).cast("int")


def tile_bounds(zoom: int, tx: Column, ty: Column) -> tuple[Column, Column, Column, Column]:
    """(minx, miny, maxx, maxy) of an XYZ tile, by way of longitude and latitude."""
    n = float(2**zoom)
    lon = lambda t: t / n * 360.0 - 180.0
    lat = lambda t: F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * t / n))))
    return mercator_x(lon(tx)), mercator_y(lat(ty + 1)), mercator_x(lon(tx + 1)), mercator_y(lat(ty))


def tile_range(minx: Column, miny: Column, maxx: Column, maxy: Column, zoom: int) -> tuple[Column, Column, Column, Column]:
    """Inclusive (tx_min, ty_min, tx_max, ty_max) of the tiles that bounds touch; an edge that lies on a tile border does not count."""
    size = 2 * HALF_WORLD / 2**zoom
    eps, last = max(1e-8, size * 1e-9), 2**zoom - 1
    clamp = lambda c: F.least(F.greatest(F.floor(c).cast("int"), F.lit(0)), F.lit(last))
    return (
        clamp((minx + eps + HALF_WORLD) / size), clamp((F.lit(HALF_WORLD) - maxy + eps) / size),
        clamp((maxx - eps + HALF_WORLD) / size), clamp((F.lit(HALF_WORLD) - miny - eps) / size),
    )


def tms_row(zoom: int, row: Column | str) -> Column:
    return F.lit(2**zoom - 1) - _col(row)


def overlaps(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether bounds (minx, miny, maxx, maxy) overlap; touching edges do not."""
    return (a[0] < b[2]) & (a[2] > b[0]) & (a[1] < b[3]) & (a[3] > b[1])


def envelopes_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """The same for envelopes (minx, maxx, miny, maxy)."""
    return overlaps((a[0], a[2], a[1], a[3]), (b[0], b[2], b[1], b[3]))


def intersection(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Common bounds as a struct, or null where there is no area."""
    x0, y0, x1, y1 = F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3])
    return F.when((x0 < x1) & (y0 < y1), F.struct(x0.alias("minx"), y0.alias("miny"), x1.alias("maxx"), y1.alias("maxy")))


def pixel_window(low: Column, high: Column, origin: float, size: float, count: int, halo: int = 0) -> tuple[Column, Column]:
    """(offset, length) of the pixels along one axis that an interval touches, within the raster and never negative."""
    first = F.greatest(F.floor((low - origin) / size) - halo, F.lit(0))
    last = F.least(F.ceil((high - origin) / size) + halo, F.lit(count))
    return first.cast("int"), F.greatest(last - first, F.lit(0)).cast("int")


def affine(transform: Sequence[float], col: Column, row: Column) -> tuple[Column, Column]:
    """The place of a pixel coordinate by a six-term transform (x origin, x per column, x per row, y origin, y per column, y per row); a cell's centre is at a half."""
    a, b, c, d, e, f = transform
    return a + col * b + row * c, d + col * e + row * f


def raster_bounds(transform: Sequence[float], width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """(minx, miny, maxx, maxy) of a raster by its four corners."""
    zero = F.lit(0)
    corners = [affine(transform, c, r) for c, r in ((zero, zero), (width, zero), (width, height), (zero, height))]
    xs, ys = zip(*corners, strict=True)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def season_weight(lat: Column, winter: bool = False) -> Column:
    """The weight of the first of two dates: a smooth step over 150 km each side of the equator."""
    half = SEASON_METRES / METRES_PER_DEGREE
    t = F.least(F.greatest((lat + half) / (2 * half), F.lit(0.0)), F.lit(1.0))
    w = t * t * (3 - 2 * t)
    return 1 - w if winter else w


def parse_bbox(text: Column) -> Column:
    """array<double> of four comma-separated numbers; anything else is an error."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    good = (F.size(parts) == 4) & ~F.exists(parts, lambda x: x.isNull())
    return F.when(good, parts).otherwise(F.raise_error(F.concat(F.lit("not a bounding box: "), F.coalesce(text, F.lit("null")))).cast("array<double>"))


def subtiles(code: Column) -> Column:
    """The four quarter units of a 100 km square."""
    return F.transform(F.array(*(F.lit(f"_{x}_{y}") for x in (0, 1) for y in (0, 1))), lambda s: F.concat(code, s))
