"""Numbers, boxes and vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def centred_cosine(a: Column, b: Column) -> Column:
    """Pearson correlation of two arrays of one length; 0 where one has no variance."""
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x)
    ma, mb = mean(a), mean(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: (x - ma) * (y - mb)), F.lit(0.0), lambda s, v: s + v)
    norm = lambda x, m: F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - m) * (v - m)))
    return F.coalesce(F.try_divide(dot, norm(a, ma) * norm(b, mb)), F.lit(0.0))


def unit_vector(a: Column) -> Column:
    """An array centred and scaled to length 1, so that a plain dot product is the centred cosine."""
    centre = F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a)
    centred = F.transform(a, lambda v: v - centre)
    norm = F.sqrt(F.aggregate(centred, F.lit(0.0), lambda s, v: s + v * v))
    return F.transform(centred, lambda v: F.coalesce(F.try_divide(v, norm), F.lit(0.0)))


def picture_size(style: Column, most: float = 430.0) -> Column:
    """(width, height) in points from a style text in pixels, kept in proportion under ``most``."""
    px = lambda name: F.try_to_number(F.nullif(F.regexp_extract(style, rf"(?i)(?:^|[;\s]){name}\s*:\s*([0-9]+)(?:\.[0-9]+)?px", 1), F.lit("")), F.lit("999999")).cast("double") * 0.75
    w, h = px("width"), px("height")
    scale = F.least(F.lit(1.0), F.lit(most) / w)
    return F.struct((w * F.coalesce(scale, F.lit(1.0))).alias("width"), (h * F.coalesce(scale, F.lit(1.0))).alias("height"))


def grid_box(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column, grid: int = 1000) -> Column:
    """A box on a grid of ``grid`` as pixels, clamped to the picture; null if nothing is left."""
    at = lambda v, size: F.least(F.greatest(F.bround(v * size / grid).cast("long"), F.lit(0).cast("long")), size.cast("long"))
    a, b, c, d = at(x0, w), at(y0, h), at(x1, w), at(y1, h)
    return F.when((c > a) & (d > b), F.struct(a.alias("x0"), b.alias("y0"), c.alias("x1"), d.alias("y1")))


def fit_within(w: Column, h: Column, most: int) -> Column:
    """(width, height) scaled down, in proportion, to a longest side of ``most``."""
    scale = F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(w, h))
    return F.struct(F.greatest(F.floor(w * scale), F.lit(1)).alias("width"), F.greatest(F.floor(h * scale), F.lit(1)).alias("height"))


def label_padding(w: Column, h: Column) -> Column:
    """Padding of a label box: a tenth of its long side, 4 at least."""
    return F.greatest(F.lit(4).cast("long"), F.bround(F.greatest(w, h) * 0.1).cast("long"))


def overlaps(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two boxes (x0, y0, x1, y1) share an area."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def inside(box: dict[str, Column], w: Column, h: Column) -> Column:
    """Whether a box lies within a picture and has an area."""
    return (box["x0"] >= 0) & (box["y0"] >= 0) & (box["x1"] <= w) & (box["y1"] <= h) & (box["x0"] < box["x1"]) & (box["y0"] < box["y1"])


def sniff(data: Column) -> Column:
    """The picture format that the first bytes tell."""
    head = F.hex(F.substring(data, 1, 12))
    return F.when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("FFD8FF"), "jpg").when(head.startswith("47494638"), "gif").when(head.startswith("25504446"), "pdf").when(head.startswith("52494646") & head.endswith("57454250"), "webp").when(F.trim(F.decode(F.substring(data, 1, 200), "iso-8859-1")).rlike(r"(?s)^(?:<\?xml.*)?<svg|^<\?xml"), "svg")


def png_size(data: Column) -> Column:
    """(width, height) from a PNG header."""
    number = lambda at: F.conv(F.hex(F.substring(data, at, 4)), 16, 10).cast("long")
    return F.when(sniff(data) == "png", F.struct(number(17).alias("width"), number(21).alias("height")))


def version_at_least(text: Column, major: int, minor: int) -> Column:
    """Whether the first ``x.y`` of a text is at least a version."""
    m = F.regexp_extract_all(text, F.lit(r"([0-9]+)\.([0-9]+)"), F.lit(0))
    first = F.split(F.try_element_at(m, F.lit(1)), r"\.")
    a, b = first[0].cast("int"), first[1].cast("int")
    return F.coalesce((a > major) | (a == major) & (b >= minor), F.lit(False))


# -- rasters (numpy; used inside mapInPandas) --------------------------------------------------


def normalise_raster(gray: np.ndarray, side: int = 128, ink: int = 200, blur: float = 2.2) -> np.ndarray:
    """The inked box of a picture fitted into a square, centred and blurred, 0 paper to 1 ink."""
    rows, cols = np.flatnonzero((gray < ink).any(1)), np.flatnonzero((gray < ink).any(0))
    out = np.zeros((side, side), np.float32)
    if not len(rows):
        return out
    box = 1 - gray[rows[0] : rows[-1] + 1, cols[0] : cols[-1] + 1].astype(np.float32) / 255
    scale = min(side / box.shape[0], side / box.shape[1])
    h, w = max(1, int(box.shape[0] * scale)), max(1, int(box.shape[1] * scale))
    small = box[np.minimum((np.arange(h) / scale).astype(int), box.shape[0] - 1)][:, np.minimum((np.arange(w) / scale).astype(int), box.shape[1] - 1)]
    top, left = (side - h) // 2, (side - w) // 2
    out[top : top + h, left : left + w] = small
    at = np.arange(-int(3 * blur), int(3 * blur) + 1)
    kernel = np.exp(-(at**2) / (2 * blur**2))
    kernel /= kernel.sum()
    for axis in (0, 1):
        out = np.apply_along_axis(lambda v: np.convolve(v, kernel, "same"), axis, out)
    return out.astype(np.float32)


def runs(profile: np.ndarray, gap: int, size: int) -> list[tuple[int, int]]:
    """Runs of ink in a profile that are ``gap`` apart at least and ``size`` long at least."""
    at = np.flatnonzero(profile)
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > gap)
    starts, ends = np.append(at[0], at[cuts + 1]), np.append(at[cuts], at[-1]) + 1
    return [(int(a), int(b)) for a, b in zip(starts, ends) if b - a >= size]


def panels(gray: np.ndarray, gap: int = 12, size: int = 24, ink: int = 200) -> list[tuple[int, int, int, int]]:
    """Boxes (x0, y0, x1, y1) of the sub-figures: rows of ink first, columns inside each row."""
    dark = gray < ink
    return [(a, y, b, z) for y, z in runs(dark.any(1), gap, size) for a, b in runs(dark[y:z].any(0), gap, size)]


def ink_share(gray: np.ndarray, box: tuple[int, int, int, int], ink: int = 200) -> float:
    """The share of dark pixels in a box."""
    part = gray[box[1] : box[3], box[0] : box[2]]
    return float((part < ink).mean()) if part.size else 0.0
