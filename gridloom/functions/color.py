"""Pixel colour arithmetic as column expressions. Neutral controls leave no trace in the plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RGB = tuple[Column, Column, Column]
# Rec. 709 luma, the depth ramp's stops at even steps, the soft knee, no-data values, the grades and presets.
LUMA = (0.2126, 0.7152, 0.0722)
RAMP = (
    (0, 8, 37), (5, 16, 46), (10, 24, 55), (25, 39, 76), (31, 49, 88), (37, 60, 101), (42, 71, 114), (46, 82, 127), (49, 93, 136), (53, 105, 145), (58, 116, 154),
    (62, 127, 163), (68, 142, 175), (77, 158, 189), (86, 173, 202), (95, 186, 214), (104, 196, 224), (113, 205, 233), (118, 210, 241), (121, 214, 247), (121, 217, 251),
)
SOFT_KNEE = (0.3, 0.75, 1.4, 0.9, 0.5)
NODATA, DEPTH_NODATA = -32768.0, -32767.0


@dataclass(frozen=True)
class Grade:
    """Controls of the grading pipeline; ``high_break`` and ``high_slope`` follow the others if None."""

    exposure: float = 1.0
    gamma: float = 1.0
    shoulder: float = 1.0
    saturation: float = 1.0
    vibrance: float = 1.0
    black: float = 0.0
    white: float = 1.0
    low_break: float = 1.0
    low_slope: float = 1.0
    high_break: float | None = None
    mid_slope: float = 1.0
    high_slope: float | None = None


LAND = Grade(exposure=2.5, gamma=2.2, shoulder=0.5, low_break=0.08, low_slope=0.0, high_break=0.9, high_slope=1.7)
OCEAN = Grade(gamma=1.4, low_break=0.35, low_slope=0.25)
PREVIEW = Grade(saturation=0.9, low_break=0.7, low_slope=0.7)
HDR = Grade(exposure=0.94, gamma=2.82, shoulder=0.5, vibrance=1.14, black=0.011, white=0.996)
PRESETS = {
    "land": {
        "balanced": LAND,
        "punchy": replace(LAND, exposure=2.8, gamma=2.0, shoulder=0.7, saturation=1.1, low_break=0.12, high_break=0.86, low_slope=0.15, mid_slope=1.1, high_slope=1.9),
        "minimal": Grade(exposure=1.0, gamma=2.8, shoulder=1.0, vibrance=1.2, black=0.01, white=0.99, low_break=0.0, high_break=1.0, low_slope=1.0, mid_slope=1.05, high_slope=1.0),
        "hdr": HDR,
    },
    "ocean": {
        "balanced": OCEAN,
        "punchy": replace(OCEAN, exposure=1.1, gamma=2.2, shoulder=1.0, saturation=1.1, low_break=0.14, high_break=0.74, low_slope=0.15, mid_slope=1.1, high_slope=1.5),
        "muted": replace(OCEAN, exposure=0.9, gamma=2.5, shoulder=0.6, saturation=0.75, low_break=0.06, high_break=0.82, low_slope=0.0, mid_slope=0.9, high_slope=1.2),
        "glow": replace(OCEAN, exposure=1.2, gamma=2.0, shoulder=1.3, saturation=0.95, low_break=0.1, high_break=0.7, low_slope=0.05, mid_slope=1.0, high_slope=1.35),
    },
}


def curve_end(g: Grade) -> float:
    """The slope of a grade's last part, its own or the one that ends the curve at (1, 1); 1 where no such slope is."""
    if g.high_slope is not None:
        return g.high_slope
    high_break = g.low_break if g.high_break is None else g.high_break
    return high_slope(g.low_break, high_break, g.low_slope, g.mid_slope)


def preset_frame(spark: SparkSession) -> DataFrame:
    """(mode, name, exposure, gamma, high_slope) of the presets: a fixed, small table."""
    rows = [(mode, name, float(g.exposure), float(g.gamma), float(curve_end(g))) for mode, named in PRESETS.items() for name, g in named.items()]
    return spark.createDataFrame(rows, "mode string, name string, exposure double, gamma double, high_slope double")


def near(a: float, b: float) -> bool:
    return abs(a - b) <= 1e-9


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def luma(rgb: RGB) -> Column:
    return LUMA[0] * rgb[0] + LUMA[1] * rgb[1] + LUMA[2] * rgb[2]


def spread(rgb: RGB) -> Column:
    return F.greatest(*rgb) - F.least(*rgb)


def smoothstep(c: Column, low: float, high: float) -> Column:
    t = clip((c - low) / (high - low))
    return t * t * (3 - 2 * t)


def normalise(dn: Column, low: float = 0.0, high: float = 9000.0) -> Column:
    """Digital numbers to 0..1; null to 0."""
    if high <= low:
        raise ValueError("the range of digital numbers is empty")
    return F.coalesce(clip((dn - low) / (high - low)), F.lit(0.0))


def to_byte(c: Column) -> Column:
    """0..1 to a byte, cut and not rounded; null to 0."""
    return F.coalesce(F.floor(c * 255), F.lit(0)).cast("int")


def piecewise(c: Column, low_break: float, high_break: float, low_slope: float, mid_slope: float, high_slope: float) -> Column:
    """A curve of three straight parts through the origin."""
    if not 0 <= low_break <= high_break <= 1 or min(low_slope, mid_slope, high_slope) < 0:
        raise ValueError("breaks must be ordered within 0..1 and slopes not negative")
    if all(near(s, 1) for s in (low_slope, mid_slope, high_slope)):
        return c
    y1 = low_break * low_slope
    y2 = y1 + (high_break - low_break) * mid_slope
    return clip(F.when(c < low_break, c * low_slope).when(c < high_break, y1 + (c - low_break) * mid_slope).otherwise(y2 + (c - high_break) * high_slope))


def high_slope(low_break: float, high_break: float, low_slope: float, mid_slope: float) -> float:
    """The slope that ends the curve at (1, 1)."""
    if high_break >= 1:
        return 1.0
    slope = (1 - low_break * low_slope - (high_break - low_break) * mid_slope) / (1 - high_break)
    if slope < 0:
        raise ValueError("the curve is above 1 before its last part")
    return slope


def soft_knee(c: Column, exposure: float = 1.0, knee: Sequence[float] = SOFT_KNEE) -> Column:
    c = clip(c)
    if not near(exposure, 1):
        c = clip(c * exposure)
    low, high, s1, s2, s3 = knee
    y1, y2 = low * s1, low * s1 + (high - low) * s2
    return clip(F.when(c < low, c * s1).when(c < high, y1 + (c - low) * s2).otherwise(y2 + (c - high) * s3))


def shoulder(c: Column, power: float, start: float) -> Column:
    """Highlights above ``start`` eased towards 1."""
    if near(power, 1) or start >= 1:
        return c
    t = clip((c - start) / (1 - start))
    return F.when(c > start, start + (1 - start) * (1 - F.pow(1 - t, F.lit(power)))).otherwise(c)


def black_white(c: Column, black: float, white: float) -> Column:
    if black >= white:
        raise ValueError("the black point must be below the white point")
    return c if near(black, 0) and near(white, 1) else clip((c - black) / (white - black))


def vibrance(rgb: RGB, amount: float) -> RGB:
    """Saturation that leaves strong colours alone."""
    if near(amount, 1):
        return rgb
    y, gain = luma(rgb), 1 + (amount - 1) * (1 - spread(rgb))
    return tuple(clip(y + (c - y) * gain) for c in rgb)


def saturate(rgb: RGB, amount: float) -> RGB:
    if near(amount, 1):
        return rgb
    y = luma(rgb)
    return tuple(y + (c - y) * amount for c in rgb)


def grade(rgb: RGB, g: Grade) -> RGB:
    """Black and white points, gamma, shoulder, vibrance, saturation, curve."""
    high_break = g.low_break if g.high_break is None else g.high_break
    slope = high_slope(g.low_break, high_break, g.low_slope, g.mid_slope) if g.high_slope is None else g.high_slope
    rgb = tuple(black_white(clip(c), g.black, g.white) for c in rgb)
    if not near(g.gamma, 1):
        rgb = tuple(F.pow(c, F.lit(1 / g.gamma)) for c in rgb)
    rgb = tuple(shoulder(c, g.shoulder, max(0.5, high_break)) for c in rgb)
    rgb = saturate(vibrance(rgb, g.vibrance), g.saturation)
    return tuple(clip(piecewise(c, g.low_break, high_break, g.low_slope, g.mid_slope, slope)) for c in rgb)


def hdr_weight(rgb: RGB) -> Column:
    """How much a pixel is a bright neutral highlight."""
    return smoothstep(luma(rgb), 0.72, 0.92) * smoothstep(1 - spread(rgb), 0.55, 0.9)


def land_style(rgb: RGB, g: Grade = LAND, tonemap: bool = False, hdr: bool = False) -> RGB:
    """Tone, grade, and with ``hdr`` a blend to the reference grade in highlights; the weight is taken before grading."""
    toned = tuple(soft_knee(c, g.exposure) if tonemap else clip(clip(c) * g.exposure) for c in rgb)
    styled = grade(toned, g)
    if not hdr:
        return styled
    reference, w = grade(tuple(clip(clip(c) * HDR.exposure) for c in rgb), HDR), hdr_weight(toned)
    return tuple(s + (r - s) * w for s, r in zip(styled, reference, strict=True))


def ramp(depth: Column, low: float = -11000.0, high: float = 0.0, stops: Sequence[Sequence[int]] = RAMP) -> RGB:
    """The colour of a depth, 0..1, between evenly spaced stops."""
    last = len(stops) - 1
    pos = clip((depth - low) / (high - low)) * last
    i = F.least(F.floor(pos), F.lit(last - 1)).cast("int")
    out = []
    for k in range(3):
        table = F.array(*(F.lit(s[k] / 255.0) for s in stops))
        a, b = F.element_at(table, i + 1), F.element_at(table, i + 2)
        out.append(a + (b - a) * (pos - i))
    return tuple(out)


def hillshade_modulate(rgb: RGB, shade: Column, floor: float = 0.35) -> RGB:
    return tuple(clip(c * (floor + (1 - floor) * shade / 255.0)) for c in rgb)


def terrarium(elevation: Column, nodata: float | None = None) -> tuple[Column, Column, Column]:
    """Elevation in three bytes: metres above -32768, and 256ths of a metre. No data becomes 0, 0, 0."""
    bad = elevation.isNull() | F.isnan(elevation)
    if nodata is not None:
        bad = bad | (elevation == nodata)
    v = clip(elevation + 32768.0, 0.0, 65535.99609375)
    whole = F.floor(v)
    parts = (F.floor(whole / 256), whole % 256, F.floor((v - whole) * 256))
    return tuple(F.when(bad, F.lit(0)).otherwise(p).cast("int") for p in parts)


def terrarium_decode(r: Column, g: Column, b: Column) -> Column:
    return r * 256.0 + g + b / 256.0 - 32768.0


def blend(a: Column, b: Column, mode: str, mix: float = 0.5, north: Column | None = None, col: Column | None = None, width: int | None = None) -> Column:
    """Two dates' values as one: summer, winter, crossfade, difference, lighter, darker, swipe."""
    if mode in ("summer", "winter"):
        return F.when(north if mode == "summer" else ~north, a).otherwise(b)
    if mode == "crossfade":
        return a * (1 - mix) + b * mix
    if mode == "difference":
        return F.abs(a - b)
    if mode == "lighter":
        return F.greatest(a, b)
    if mode == "darker":
        return F.least(a, b)
    if mode == "swipe":
        return F.when(col < int(round(width * (1 - mix))), a).otherwise(b)
    raise ValueError(f"no such blend mode: {mode}")


def over(bottom: Sequence[Column], top: Sequence[Column]) -> tuple[Column, Column, Column, Column]:
    """Porter and Duff's ``over`` of straight-alpha bytes, in whole numbers, rounded half up."""
    a, b = top[3].cast("long"), bottom[3].cast("long")
    rest = b * (255 - a)
    total = a * 255 + rest  # of 255 x 255
    channel = lambda t, u: F.when(total == 0, F.lit(0)).otherwise(F.floor((t * a * 255 + u * rest + total / 2) / total)).cast("int")
    return (*(channel(t, u) for t, u in zip(top[:3], bottom[:3], strict=True)), F.floor((total + 127) / 255).cast("int"))

