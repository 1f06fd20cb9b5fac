"""Column functions on boxes, frames and pictures' sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pixels around an overlay.
RENDER_PADDING = 8
MAX_BYTES, MAX_PIXELS, MAX_RATIO = 50 * 1024 * 1024, 25_000_000, 20


def clamp(c: Column, low, high) -> Column:
    return F.greatest(F.lit(low) if not isinstance(low, Column) else low, F.least(F.lit(high) if not isinstance(high, Column) else high, c))


def iou(x: Column, y: Column, w: Column, h: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Intersection over union of an x, y, w, h box with a corner box; 0 without overlap."""
    wide = F.greatest(F.lit(0.0), F.least(x + w, x2) - F.greatest(x, x1))
    high = F.greatest(F.lit(0.0), F.least(y + h, y2) - F.greatest(y, y1))
    inter = wide * high
    union = w * h + (x2 - x1) * (y2 - y1) - inter
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(F.lit(0.0))


def clip_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """struct<x,y,w,h> inside the frame, whole numbers, sides not negative."""
    left, top = clamp(x, 0, width).cast("int"), clamp(y, 0, height).cast("int")
    right, bottom = clamp(x + w, 0, width).cast("int"), clamp(y + h, 0, height).cast("int")
    zero = F.lit(0)
    return F.struct(left.alias("x"), top.alias("y"), F.greatest(zero, right - left).alias("w"), F.greatest(zero, bottom - top).alias("h"))


def face_quality(blur: Column, area: Column, conf: Column, reference: float = 100.0) -> Column:
    """Weighted mean of saturating sharpness, area share and detection confidence."""
    sharp = blur / (blur + max(1.0, reference))
    return (0.4 * sharp + 0.3 * clamp(area, 0.0, 1.0) + 0.3 * clamp(conf, 0.0, 1.0)) / (0.4 + 0.3 + 0.3)


def prominence(w: Column, h: Column, width: Column, height: Column) -> Column:
    return clamp((w * h) / (width * height), 0.0, 1.0)


def centeredness(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """1 less the distance of the centres over half the diagonal, at least 0."""
    half = F.hypot(width / 2.0, height / 2.0)
    away = F.hypot(x + w / 2.0 - width / 2.0, y + h / 2.0 - height / 2.0)
    return F.when(half > 0, F.greatest(F.lit(0.0), 1 - away / half)).otherwise(F.lit(0.0))


def reference_quality(prom: Column, sharp: Column, centre: Column, occlusion: Column, size: Column) -> Column:
    """How well a crop stands for its cluster."""
    stable = F.least(F.lit(1.0), size / 5.0)
    return 0.35 * prom + 0.25 * sharp + 0.10 * centre - 0.15 * clamp(occlusion, 0.0, 1.0) + 0.15 * stable


def crop_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """struct<x1,y1,x2,y2> inside the frame, at least one pixel a side."""
    x1, y1 = clamp(x, 0, width - 1), clamp(y, 0, height - 1)
    x2, y2 = clamp(x + w, x1 + 1, width), clamp(y + h, y1 + 1, height)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def polygon_box(points: Column, width: Column, height: Column) -> Column:
    """array<array<double>> polygon -> normalised array(x1, y1, x2, y2), each in 0 to 1."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    side = lambda v, n: clamp(v / F.greatest(n, F.lit(1)), 0.0, 1.0)
    return F.array(side(F.array_min(xs), width), side(F.array_min(ys), height), side(F.array_max(xs), width), side(F.array_max(ys), height))


def corners_to_box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.cast("int").alias("x"), y1.cast("int").alias("y"), (x2 - x1).cast("int").alias("w"), (y2 - y1).cast("int").alias("h"))


def shrink_pixels(x: Column, y: Column, w: Column, h: Column, by: int) -> Column:
    """struct<x,y,w,h> of a pixel box made smaller by so much on each side; it may end up empty."""
    return F.struct((x + by).alias("x"), (y + by).alias("y"), (w - 2 * by).alias("w"), (h - 2 * by).alias("h"))


def duration_seconds(frame_count: Column, fps: Column) -> Column:
    """Frames over rate, 0 where either is unknown."""
    return F.when((frame_count > 0) & (fps > 0), frame_count / fps).otherwise(F.lit(0.0))


def shrink_norm(box: Column, sx: Column, sy: Column) -> Column:
    """A normalised box made smaller on all sides; a side never passes the opposite one."""
    return F.array(F.least(box[0] + sx, box[2]), F.least(box[1] + sy, box[3]), F.greatest(box[2] - sx, box[0]), F.greatest(box[3] - sy, box[1]))


def norm_to_pixels(box: Column, width: Column, height: Column, pad: float = 0.0) -> Column:
    """Outward rounding inside the frame; pad widens each side by that share of the box."""
    bw, bh = (box[2] - box[0]) * pad, (box[3] - box[1]) * pad
    near = lambda v, n: F.floor(F.greatest(F.lit(0.0), v) * n).cast("int")
    far = lambda v, n: F.ceil(F.least(F.lit(1.0), v) * n).cast("int")
    return F.array(near(box[0] - bw, width), near(box[1] - bh, height), far(box[2] + bw, width), far(box[3] + bh, height))


def mask_rect(box: Column, width: Column, height: Column, shrink: int = 0) -> Column:
    """Half-even rounding of the corners, shrunk in pixels, inside the frame."""
    near = lambda v, n: clamp((F.bround(v * n) + shrink).cast("int"), 0, n)
    far = lambda v, n: clamp((F.bround(v * n) - shrink).cast("int"), 0, n)
    return F.array(near(box[0], width), near(box[1], height), far(box[2], width), far(box[3], height))


def blur_kernel(w: Column, h: Column) -> Column:
    """Odd kernel, two fifths of the longer side, 31 at least."""
    return F.greatest(F.lit(31), F.floor(F.greatest(w, h) * F.lit(0.4)).cast("int").bitwiseOR(F.lit(1)))


def frame_ms(index: Column, fps: Column) -> Column:
    return F.bround(index * 1000.0 / fps).cast("long")


def average_fps(frames: Column, total_ms: Column) -> Column:
    return F.coalesce(F.try_divide(frames * F.lit(1000.0), total_ms), F.lit(0.0))


def valid_picture(size: Column, width: Column, height: Column) -> Column:
    ratio = F.greatest(width, height) / F.greatest(F.least(width, height), F.lit(1))
    return (size <= MAX_BYTES) & (width.cast("long") * height <= MAX_PIXELS) & (ratio <= MAX_RATIO)


def resize_plan(width: Column, height: Column, most: int = 448) -> Column:
    """struct<w,h> with the longest side at most ``most``."""
    big = F.greatest(width, height) > most
    w = F.when(~big, width).when(width >= height, F.lit(most)).otherwise(F.floor(width * F.lit(most) / height))
    h = F.when(~big, height).when(width >= height, F.floor(height * F.lit(most) / width)).otherwise(F.lit(most))
    return F.struct(w.cast("int").alias("w"), h.cast("int").alias("h"))


def shadow_padding(dx: Column, dy: Column, blur: Column, spread: Column) -> Column:
    return F.abs(dx) + F.abs(dy) + blur + spread


def overlay_layout(
    text: Column, row_widths: Column, font_px: Column, line_height: Column, highlight_px: Column, shadow: Column, stroke_px: Column,
    margin: int = RENDER_PADDING,
) -> Column:
    """Sizes of a text overlay: row advance, picture size, origin of the text and the highlight box.

    row_widths: measured widths of the rows; shadow: the padding of shadow_padding, null without one; stroke_px: null without one.
    """
    rows = F.greatest(F.size(F.split(F.coalesce(text, F.lit("")), "\n")), F.lit(1))
    advance = F.floor(font_px * line_height).cast("int")
    extra = F.greatest(F.coalesce(shadow, F.lit(0)), F.coalesce(stroke_px, F.lit(0))) + margin
    inner_w, inner_h = F.coalesce(F.array_max(row_widths), F.lit(0)), advance * rows
    origin = extra + highlight_px
    box = F.array(extra, extra, origin + inner_w + highlight_px, origin + inner_h + highlight_px)
    return F.struct(
        advance.alias("row_advance"), (inner_w + 2 * highlight_px + 2 * extra).alias("width"), (inner_h + 2 * highlight_px + 2 * extra).alias("height"),
        origin.alias("origin"), box.alias("highlight_box"),
    )
