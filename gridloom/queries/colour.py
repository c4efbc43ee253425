"""Colour arithmetic on pixels and grids."""

import functools

from pyspark.sql import functions as F

from ..functions import color, masks
from ..operators.staging import staged
from ..sources.tables import grids, pixels
from .registry import GRIDS, PIXELS, query

UNIT = f'{PIXELS}, p AS (SELECT unit, "row", col, date_idx, least(greatest(r / 9000.0, 0.0), 1.0) AS r, least(greatest(g / 9000.0, 0.0), 1.0) AS g, least(greatest(b / 9000.0, 0.0), 1.0) AS b FROM pixels WHERE r IS NOT NULL)'
KEYS = ["unit", "row", "col", "date_idx"]
SQL_KEYS = 'unit, "row", col, date_idx'
RGB = ("r", "g", "b")


def _unit(spark, sf_dir):
    return pixels(spark, sf_dir).where("r is not null").select(*KEYS, *(color.normalise(F.col(c)).alias(c) for c in RGB))


def _rgb():
    return tuple(F.col(c) for c in RGB)


def _out(df, rgb):
    return df.select(*KEYS, *(F.round(c, 6).alias(n) for c, n in zip(rgb, RGB, strict=True)))


def _each(f):
    """SQL for three bands from a formula of one."""
    return ", ".join(f"round({f(c)}, 6) AS {c}" for c in RGB)


@query("q_normalise", f"WITH {UNIT} SELECT {SQL_KEYS}, {_each(lambda c: c)} FROM p")
def q_normalise(spark, sf_dir):
    return _out(_unit(spark, sf_dir), _rgb())


@query("q_to_byte", f"WITH {UNIT} SELECT {SQL_KEYS}, {', '.join(f'CAST(floor({c} * 255) AS INTEGER) AS {c}' for c in RGB)} FROM p")
def q_to_byte(spark, sf_dir):
    return _unit(spark, sf_dir).select(*KEYS, *(color.to_byte(F.col(c)).alias(c) for c in RGB))


def _clip(x):
    return f"least(greatest({x}, 0.0), 1.0)"


@query("q_soft_knee", f"WITH {UNIT}, e AS (SELECT {SQL_KEYS}, {', '.join(f'{_clip(f'{c} * 1.3')} AS {c}' for c in RGB)} FROM p) SELECT {SQL_KEYS}, {_each(lambda c: _clip(f'CASE WHEN {c} < 0.3 THEN {c} * 1.4 WHEN {c} < 0.75 THEN 0.42 + ({c} - 0.3) * 0.9 ELSE 0.825 + ({c} - 0.75) * 0.5 END'))} FROM e")
def q_soft_knee(spark, sf_dir):
    return _out(_unit(spark, sf_dir), tuple(color.soft_knee(c, 1.3) for c in _rgb()))


@query("q_curve", f"WITH {UNIT} SELECT {SQL_KEYS}, {_each(lambda c: _clip(f'CASE WHEN {c} < 0.2 THEN {c} * 0.5 WHEN {c} < 0.8 THEN 0.1 + ({c} - 0.2) * 1.2 ELSE 0.1 + 0.6 * 1.2 + ({c} - 0.8) * 0.9 END'))} FROM p")
def q_curve(spark, sf_dir):
    return _out(_unit(spark, sf_dir), tuple(color.piecewise(c, 0.2, 0.8, 0.5, 1.2, 0.9) for c in _rgb()))


@query("q_shoulder", f"WITH {UNIT} SELECT {SQL_KEYS}, {_each(lambda c: f'CASE WHEN {c} > 0.6 THEN 0.6 + 0.4 * (1 - pow(1 - {_clip(f'({c} - 0.6) / 0.4')}, 0.5)) ELSE {c} END')} FROM p")
def q_shoulder(spark, sf_dir):
    return _out(_unit(spark, sf_dir), tuple(color.shoulder(c, 0.5, 0.6) for c in _rgb()))


@query("q_bw", f"WITH {UNIT} SELECT {SQL_KEYS}, {_each(lambda c: _clip(f'({c} - 0.05) / (0.95 - 0.05)'))} FROM p")
def q_bw(spark, sf_dir):
    return _out(_unit(spark, sf_dir), tuple(color.black_white(c, 0.05, 0.95) for c in _rgb()))


LUMA = "(0.2126 * r + 0.7152 * g + 0.0722 * b)"
SPREAD = "(greatest(r, g, b) - least(r, g, b))"


@query("q_vibrance", f"WITH {UNIT} SELECT {SQL_KEYS}, {_each(lambda c: _clip(f'{LUMA} + ({c} - {LUMA}) * (1 + 0.4 * (1 - {SPREAD}))'))} FROM p")
def q_vibrance(spark, sf_dir):
    return _out(_unit(spark, sf_dir), color.vibrance(_rgb(), 1.4))


def _grade_sql(source, g, name):
    """SQL steps of the grading pipeline, from columns r, g, b of ``source``."""
    hb = g.low_break if g.high_break is None else g.high_break
    y1, y2 = g.low_break * g.low_slope, g.low_break * g.low_slope + (hb - g.low_break) * g.mid_slope
    hs = g.high_slope if g.high_slope is not None else 1.0 if hb >= 1 else (1 - y2) / (1 - hb)
    start = max(0.5, hb)
    eased = (lambda c: c) if g.shoulder == 1 or start >= 1 else (lambda c: f"CASE WHEN {c} > {start} THEN {start} + (1 - {start}) * (1 - pow(1 - {_clip(f'({c} - {start}) / (1 - {start})')}, {g.shoulder})) ELSE {c} END")
    step = lambda f: ", ".join(f"{f(c)} AS {c}" for c in RGB)
    return f"""{name}1 AS (SELECT {SQL_KEYS}, {step(lambda c: f'pow({_clip(f"({_clip(c)} - {g.black}) / ({g.white} - {g.black})")}, {1 / g.gamma!r})')} FROM {source}),
{name}2 AS (SELECT {SQL_KEYS}, {step(eased)} FROM {name}1),
{name}3 AS (SELECT {SQL_KEYS}, {step(lambda c: _clip(f'{LUMA} + ({c} - {LUMA}) * (1 + ({g.vibrance} - 1) * (1 - {SPREAD}))') if g.vibrance != 1 else c)} FROM {name}2),
{name}4 AS (SELECT {SQL_KEYS}, {step(lambda c: f'{LUMA} + ({c} - {LUMA}) * {g.saturation}' if g.saturation != 1 else c)} FROM {name}3),
{name} AS (SELECT {SQL_KEYS}, {step(lambda c: _clip(f'CASE WHEN {c} < {g.low_break} THEN {c} * {g.low_slope} WHEN {c} < {hb} THEN {y1!r} + ({c} - {g.low_break}) * {g.mid_slope} ELSE {y2!r} + ({c} - {hb}) * {hs!r} END'))} FROM {name}4)"""


@query("q_preview", f"WITH {UNIT}, {_grade_sql('p', color.PREVIEW, 'd')} SELECT {SQL_KEYS}, {', '.join(f'round({c}, 11) AS {c}' for c in RGB)} FROM d")
def q_preview(spark, sf_dir):
    # All factors are short decimals, so values end within ten digits: at eleven no engine has a tie to round.
    rgb = color.grade(_rgb(), color.PREVIEW)
    return _unit(spark, sf_dir).select(*KEYS, *(F.round(c, 11).alias(n) for c, n in zip(rgb, RGB, strict=True)))


PRESETS = [(mode, name, g) for mode, named in color.PRESETS.items() for name, g in named.items()]
STYLED = ", ".join(f"p{k} AS (SELECT * FROM p WHERE unit % {len(PRESETS)} = {k}), {_grade_sql(f'p{k}', g, f'd{k}_')}" for k, (_, _, g) in enumerate(PRESETS))


@query("q_presets", f"WITH {UNIT}, {STYLED} " + " UNION ALL ".join(f"SELECT '{mode}' AS mode, '{name}' AS preset, {SQL_KEYS}, {', '.join(f'round({c}, 4) AS {c}' for c in RGB)} FROM d{k}_" for k, (mode, name, _) in enumerate(PRESETS)))
def q_presets(spark, sf_dir):
    """Each unit's pixels in the style of one of the presets."""
    known, found = staged(_unit(spark, sf_dir), "pixels"), []
    for k, (mode, name, g) in enumerate(PRESETS):
        rgb = color.grade(_rgb(), g)
        found.append(known.where(F.col("unit") % len(PRESETS) == k).select(F.lit(mode).alias("mode"), F.lit(name).alias("preset"), *KEYS, *(F.round(c, 4).alias(n) for c, n in zip(rgb, RGB, strict=True))))
    return functools.reduce(lambda a, b: a.unionByName(b), found)


def _smooth(x, a, b):
    t = _clip(f"({x} - {a}) / ({b} - {a})")
    return f"({t} * {t} * (3 - 2 * {t}))"


WEIGHT = f"{_smooth(LUMA, 0.72, 0.92)} * {_smooth(f'(1 - {SPREAD})', 0.55, 0.9)}"


@query("q_hdr_weight", f"WITH {UNIT} SELECT {SQL_KEYS}, round({WEIGHT}, 6) AS w FROM p")
def q_hdr_weight(spark, sf_dir):
    return _unit(spark, sf_dir).select(*KEYS, F.round(color.hdr_weight(_rgb()), 6).alias("w"))


TONED = f"t AS (SELECT {SQL_KEYS}, {', '.join(f'{_clip(f'{c} * 2.5')} AS {c}' for c in RGB)} FROM p)"


@query("q_land_style", f"WITH {UNIT}, {TONED}, {_grade_sql('t', color.LAND, 'd')} SELECT {SQL_KEYS}, {_each(lambda c: c)} FROM d")
def q_land_style(spark, sf_dir):
    return _out(_unit(spark, sf_dir), color.land_style(_rgb()))


@query("q_land_style_hdr", f"""WITH {UNIT}, {TONED}, h AS (SELECT {SQL_KEYS}, {', '.join(f'{_clip(f'{c} * 0.94')} AS {c}' for c in RGB)} FROM p), w AS (SELECT {SQL_KEYS}, {WEIGHT} AS w FROM t),
{_grade_sql('t', color.LAND, 'd')}, {_grade_sql('h', color.HDR, 'k')} SELECT d.unit, d."row", d.col, d.date_idx, {', '.join(f'round(d.{c} + (k.{c} - d.{c}) * w.w, 4) AS {c}' for c in RGB)}
FROM d JOIN k USING (unit, "row", col, date_idx) JOIN w USING (unit, "row", col, date_idx)""")
def q_land_style_hdr(spark, sf_dir):
    rgb = color.land_style(_rgb(), hdr=True)
    return _unit(spark, sf_dir).select(*KEYS, *(F.round(c, 4).alias(n) for c, n in zip(rgb, RGB, strict=True)))


@query("q_terrarium", f"""WITH {GRIDS}, v AS (SELECT raster_id, "row", col, least(greatest(depth + 32768.0, 0.0), 65535.99609375) AS v FROM grids)
  SELECT raster_id, "row", col, CAST(floor(floor(v) / 256) AS INTEGER) AS r, CAST(CAST(floor(v) AS BIGINT) % 256 AS INTEGER) AS g, CAST(floor((v - floor(v)) * 256) AS INTEGER) AS b FROM v""")
def q_terrarium(spark, sf_dir):
    return grids(spark, sf_dir).select("raster_id", "row", "col", *(c.alias(n) for c, n in zip(color.terrarium(F.col("depth")), RGB, strict=True)))


def _ramp_sql(k):
    table = "[" + ", ".join(f"{s[k]} / 255.0" for s in color.RAMP) + "]"
    return f"({table}[i + 1] + ({table}[i + 2] - {table}[i + 1]) * (pos - i))"


RAMPED = f"""{GRIDS}, f AS (SELECT raster_id, "row", col, depth, {_clip('(depth * 60 - -11000.0) / 11000.0')} * 20 AS pos FROM grids), i AS (SELECT *, CAST(least(floor(pos), 19) AS INTEGER) AS i FROM f)"""


@query("q_ramp", f"""WITH {RAMPED} SELECT raster_id, "row", col, {', '.join(f'round({_ramp_sql(k)}, 6) AS {c}' for k, c in enumerate(RGB))} FROM i""")
def q_ramp(spark, sf_dir):
    rgb = color.ramp(F.col("depth") * 60)
    return grids(spark, sf_dir).select("raster_id", "row", "col", *(F.round(c, 6).alias(n) for c, n in zip(rgb, RGB, strict=True)))


@query("q_hillshade_mod", f"""WITH {RAMPED}, s AS (SELECT *, CAST((raster_id * 31 + "row" * 8 + col) % 256 AS DOUBLE) AS hs FROM i)
  SELECT raster_id, "row", col, {', '.join(f'round({_clip(f"{_ramp_sql(k)} * (0.35 + 0.65 * hs / 255.0)")}, 6) AS {c}' for k, c in enumerate(RGB))} FROM s""")
def q_hillshade_mod(spark, sf_dir):
    hs = ((F.col("raster_id") * 31 + F.col("row") * 8 + F.col("col")) % 256).cast("double")
    rgb = color.hillshade_modulate(color.ramp(F.col("depth") * 60), hs)
    return grids(spark, sf_dir).select("raster_id", "row", "col", *(F.round(c, 6).alias(n) for c, n in zip(rgb, RGB, strict=True)))


@query("q_alpha", f"""WITH {GRIDS}, m AS (SELECT raster_id, "row", col, depth > -60 AS valid, CAST((raster_id + "row" * 37 + col * 11) % 256 AS INTEGER) AS oa, (raster_id + "row") % 5 <> 0 AS covered, (raster_id + col) % 7 = 0 AS filled FROM grids)
  SELECT raster_id, "row", col, CASE WHEN valid THEN 255 ELSE 0 END AS plain, CASE WHEN covered THEN CASE WHEN filled THEN 255 ELSE 255 - oa END ELSE 0 END AS masked,
  CASE WHEN covered THEN CASE WHEN oa < 254.5 THEN 255 ELSE 0 END ELSE 0 END AS allowed FROM m""")
def q_alpha(spark, sf_dir):
    i, r, c = F.col("raster_id"), F.col("row"), F.col("col")
    m = grids(spark, sf_dir).select("raster_id", "row", "col", (F.col("depth") > -60).alias("valid"), ((i + r * 37 + c * 11) % 256).cast("int").alias("oa"), ((i + r) % 5 != 0).alias("covered"), ((i + c) % 7 == 0).alias("filled"))
    valid, oa, covered, filled = (F.col(x) for x in ("valid", "oa", "covered", "filled"))
    return m.select(
        "raster_id", "row", "col", masks.alpha(valid).alias("plain"), masks.alpha(valid, oa, covered=covered, filled=filled).alias("masked"),
        masks.alpha(valid, oa, allowed=masks.fill_allowed(oa, F.lit(True)), covered=covered).alias("allowed"),
    )


BLEND = {"summer": "CASE WHEN unit % 2 = 0 THEN a ELSE b END", "winter": "CASE WHEN unit % 2 = 0 THEN b ELSE a END", "crossfade": "a * 0.75 + b * 0.25", "difference": "abs(a - b)", "lighter": "greatest(a, b)", "darker": "least(a, b)", "swipe": "CASE WHEN col < 24 THEN a ELSE b END"}


@query("q_blend_modes", f"""WITH {UNIT}, two AS (SELECT x.unit, x."row", x.col, x.r AS a, y.r AS b FROM p x JOIN p y ON x.unit = y.unit AND x."row" = y."row" AND x.col = y.col AND x.date_idx = 0 AND y.date_idx = 1)
  SELECT unit, "row", col, {', '.join(f'round({sql}, 6) AS {name}' for name, sql in BLEND.items())} FROM two""")
def q_blend_modes(spark, sf_dir):
    p = _unit(spark, sf_dir)
    two = p.where("date_idx = 0").select("unit", "row", "col", F.col("r").alias("a")).join(p.where("date_idx = 1").select("unit", "row", "col", F.col("r").alias("b")), ["unit", "row", "col"])
    a, b, north = F.col("a"), F.col("b"), F.col("unit") % 2 == 0
    return two.select("unit", "row", "col", *(F.round(color.blend(a, b, mode, 0.25, north, F.col("col"), 32), 6).alias(mode) for mode in BLEND))
