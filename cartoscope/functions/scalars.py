"""Column functions: names, units, coordinates, transforms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Micrometres of a metre, and full-resolution pixels of a downsampled one.
M_UM, SCALE = 1_000_000, 32.0


def zero_pad(section: Column, largest: int) -> Column:
    """Section as text of three digits, or four if sections go beyond 1000."""
    return F.lpad(section.cast("string"), 4 if largest > 1000 else 3, "0")


def slide_number(name: Column) -> Column:
    """The number behind `slide` in a file name; null if there is none."""
    return F.nullif(F.regexp_extract(name, r"slide(\d+)", 1), F.lit("")).cast("long")


def scene_filename(czi: Column, scene: Column, channel: Column) -> Column:
    """File of one scene and channel of a slide file."""
    name = F.concat(F.replace(czi, F.lit(".czi"), F.lit("")), F.lit("_S"), scene.cast("string"), F.lit("_C"), channel.cast("string"), F.lit(".tif"))
    return F.replace(name, F.lit("__"), F.lit("_"))


def section_from_name(name: Column) -> Column:
    """Section of `detections_NNN.csv`, else of `section_N`, else the first number in the name."""
    tries = [F.nullif(F.regexp_extract(name, p, 1), F.lit("")) for p in (r"detections_(\d+)\.csv", r"section_(\d+)", r"(\d+)")]
    return F.coalesce(*tries).cast("long")


def category_prediction(name: Column) -> Column:
    """2, 0 or -2 for `<threshold>_sure`, `_unsure`, `_null`."""
    tail = F.split_part(name, F.lit("_"), F.lit(2))
    return F.when(tail == "sure", 2).when(tail == "unsure", 0).when(tail == "null", -2)


def after_dash(name: Column) -> Column:
    return F.split_part(name, F.lit("-"), F.lit(2))


def side(structure: Column) -> Column:
    """L or R of a structure's suffix; null for a structure of the midline."""
    return F.nullif(F.regexp_extract(structure, r"_([LR])$", 1), F.lit(""))


def human_size(n: Column) -> Column:
    """Bytes as text with two decimals and a unit of powers of 1024."""
    i = F.when(n > 0, F.least(F.floor(F.ln(n) / F.ln(F.lit(1024.0)) + 1e-12), F.lit(4))).otherwise(0).cast("int")
    unit = F.element_at(F.array(*map(F.lit, ("B", "KB", "MB", "GB", "TB"))), i + 1)
    return F.when(n == 0, "0B").otherwise(F.concat(F.format_string("%.2f", F.bround(n / F.pow(F.lit(1024.0), i), 2)), F.lit(" "), unit))


def to_pixels(um: Column, resolution: Column) -> Column:
    """Micrometres to whole pixels, halves to even."""
    return F.bround(um / resolution, 0).cast("long")


def metres_to_pixels(metres: Column, resolution: Column) -> Column:
    return to_pixels(metres * M_UM, resolution)


def section_centre(section: Column) -> Column:
    return section.cast("double") + 0.5


def downsampled(pixels: Column) -> Column:
    return F.bround(pixels / SCALE, 0).cast("long")


def resolution_vector(orientation: Column, xy: Column, z: Column) -> Column:
    """Resolutions along the three axes: coronal (z, xy, xy), horizontal (xy, z, xy), sagittal (xy, xy, z)."""
    return F.when(orientation == "coronal", F.array(z, xy, xy)).when(orientation == "horizontal", F.array(xy, z, xy)).when(orientation == "sagittal", F.array(xy, xy, z))


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for p, q in zip(a, b, strict=True):
        total = total + (p - q) * (p - q)
    return F.sqrt(total)


def stretch(v: Column, low: float, high: float, top: float) -> Column:
    """v from [low, high] to [0, top], linearly."""
    return (v - low) * F.lit(float(top)) / (high - low)


def round_to(v: Column, unit: int) -> Column:
    """To the nearest multiple of unit, halves to the even multiple."""
    return (F.bround(v / unit, 0) * unit).cast("long")


def id_to_rgb(i: Column) -> tuple[Column, Column, Column]:
    """Three bytes of an id, the lowest first."""
    return tuple(F.shiftright(i, k).bitwiseAND(F.lit(255)) for k in (0, 8, 16))


def rigid_matrix(rotation: Column, dx: Column, dy: Column, centre: tuple[float, float]) -> list[Column]:
    """The upper two rows of the 3 x 3 matrix that rotates about a centre and shifts."""
    c, s = F.cos(rotation), F.sin(rotation)
    cx, cy = centre
    return [c, -s, dx + cx - F.lit(cx) * c + F.lit(cy) * s, s, c, dy + cy - F.lit(cx) * s - F.lit(cy) * c]


def rigid_parameters(m: Sequence[Column], centre: tuple[float, float]) -> tuple[Column, Column, Column]:
    """Rotation and shifts of a rigid matrix about a centre."""
    rotation = F.atan2(m[3], m[0])
    cx, cy = centre
    return rotation, m[2] - cx + cx * m[0] + cy * m[1], m[5] - cy + cx * m[3] + cy * m[4]


def resample_points(points: DataFrame, sizes: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Scale each axis by new size / old size. sizes: axis -> (old, new) in voxel size, so the ratio is old / new."""
    return points.withColumns({c: F.col(c) * (old / new) for c, (old, new) in sizes.items()})


def reorder_axes(points: DataFrame, order: Sequence[str], reverse: Mapping[str, float]) -> DataFrame:
    """Columns x, y, z from the axes in order; an axis in reverse counts from its size down."""
    taken = [F.lit(reverse[c]) - 1 - F.col(c) if c in reverse else F.col(c) for c in order]
    return points.withColumns(dict(zip(("x", "y", "z"), taken, strict=True)))


def stable_id(*columns: str) -> Column:
    """A text id that follows from its key columns."""
    return F.sha1(F.concat_ws("|", *columns).cast("binary"))
