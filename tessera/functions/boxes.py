"""Box algebra as Column expressions.

A box is four columns ``(y1, x1, y2, x2)`` with the upper corner exclusive in
pixel space. ``box_cols(prefix)`` names them; every function takes such tuples.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["box_cols", "box_area", "iou", "intersection", "box_refinement", "apply_box_deltas",
           "norm_boxes", "denorm_boxes", "to_xywh", "clip", "clip_boxes", "window_to_image",
           "resize_geometry", "pyramid_level"]

Box = tuple


def _c(c) -> Column:
    if isinstance(c, (int, float)):
        return F.lit(c)
    return F.col(c) if isinstance(c, str) else c


def box_cols(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{n}") for n in ("y1", "x1", "y2", "x2"))


def box_area(b: Box) -> Column:
    y1, x1, y2, x2 = b
    return (y2 - y1) * (x2 - x1)


def intersection(a: Box, b: Box) -> Column:
    h = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    w = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    return w * h


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; the union is the two areas minus the intersection."""
    inter = intersection(a, b)
    return inter.cast("double") / (box_area(a) + box_area(b) - inter).cast("double")


def _centre_size(b: Box):
    y1, x1, y2, x2 = (c.cast("double") for c in b)
    h = y2 - y1
    w = x2 - x1
    return y1 + 0.5 * h, x1 + 0.5 * w, h, w


def box_refinement(box: Box, gt: Box, std=None, prefix: str = "d") -> list[Column]:
    """(dy, dx, log dh, log dw) that move ``box`` onto ``gt``; optional division by std devs."""
    cy, cx, h, w = _centre_size(box)
    gy, gx, gh, gw = _centre_size(gt)
    d = [(gy - cy) / h, (gx - cx) / w, F.log(gh / h), F.log(gw / w)]
    if std is not None:
        d = [x / F.lit(float(s)) for x, s in zip(d, std)]
    return [x.alias(f"{prefix}{n}") for x, n in zip(d, ("y", "x", "h", "w"))]


def apply_box_deltas(box: Box, deltas, std=None, prefix: str = "") -> list[Column]:
    """Inverse of ``box_refinement``: shift centre by (dy*h, dx*w), scale size by exp(dh), exp(dw)."""
    cy, cx, h, w = _centre_size(box)
    dy, dx, dh, dw = (_c(d) for d in deltas)
    if std is not None:
        dy, dx, dh, dw = (d * F.lit(float(s)) for d, s in zip((dy, dx, dh, dw), std))
    cy = cy + dy * h
    cx = cx + dx * w
    h = h * F.exp(dh)
    w = w * F.exp(dw)
    y1 = cy - 0.5 * h
    x1 = cx - 0.5 * w
    return [y1.alias(f"{prefix}y1"), x1.alias(f"{prefix}x1"),
            (y1 + h).alias(f"{prefix}y2"), (x1 + w).alias(f"{prefix}x2")]


def norm_boxes(b: Box, h, w, prefix: str = "n") -> list[Column]:
    """Pixels -> 0..1: shift (0,0,1,1) then divide by (h-1, w-1, h-1, w-1)."""
    hh = _c(h).cast("double") - 1
    ww = _c(w).cast("double") - 1
    y1, x1, y2, x2 = b
    return [(y1 / hh).alias(f"{prefix}y1"), (x1 / ww).alias(f"{prefix}x1"),
            ((y2 - 1) / hh).alias(f"{prefix}y2"), ((x2 - 1) / ww).alias(f"{prefix}x2")]


def denorm_boxes(b: Box, h, w, prefix: str = "") -> list[Column]:
    """0..1 -> pixels, rounded half to even (inverse of ``norm_boxes``)."""
    hh = _c(h).cast("double") - 1
    ww = _c(w).cast("double") - 1
    y1, x1, y2, x2 = b
    return [F.bround(y1 * hh).cast("int").alias(f"{prefix}y1"),
            F.bround(x1 * ww).cast("int").alias(f"{prefix}x1"),
            F.bround(y2 * hh + 1).cast("int").alias(f"{prefix}y2"),
            F.bround(x2 * ww + 1).cast("int").alias(f"{prefix}x2")]


def to_xywh(b: Box) -> list[Column]:
    """[y1,x1,y2,x2] -> x, y, width, height with one decimal."""
    y1, x1, y2, x2 = b
    return [F.bround(x1.cast("double"), 1).alias("bx"), F.bround(y1.cast("double"), 1).alias("by"),
            F.bround((x2 - x1).cast("double"), 1).alias("bw"),
            F.bround((y2 - y1).cast("double"), 1).alias("bh")]


def clip(c, lo, hi) -> Column:
    return F.greatest(F.least(_c(c), _c(hi)), _c(lo))


def clip_boxes(b: Box, window: Box, prefix: str = "") -> list[Column]:
    """Clip each coordinate into the window (y1, x1, y2, x2)."""
    wy1, wx1, wy2, wx2 = window
    y1, x1, y2, x2 = b
    return [clip(y1, wy1, wy2).alias(f"{prefix}y1"), clip(x1, wx1, wx2).alias(f"{prefix}x1"),
            clip(y2, wy1, wy2).alias(f"{prefix}y2"), clip(x2, wx1, wx2).alias(f"{prefix}x2")]


def window_to_image(b: Box, window: Box, h, w, orig_h, orig_w, prefix: str = "") -> list[Column]:
    """Normalised detection boxes inside a padded window -> pixel boxes of the original image."""
    nw = norm_boxes(window, h, w, prefix="w")
    wy1, wx1, wy2, wx2 = nw
    wh = wy2 - wy1
    ww = wx2 - wx1
    y1, x1, y2, x2 = b
    on_window = ((y1 - wy1) / wh, (x1 - wx1) / ww, (y2 - wy1) / wh, (x2 - wx1) / ww)
    return denorm_boxes(on_window, orig_h, orig_w, prefix=prefix)


def resize_geometry(h, w, mode: str, min_dim: int | None = None, max_dim: int | None = None,
                    min_scale: float | None = None) -> Column:
    """Scale, window and padding of an image resize without touching pixels.

    Returns struct(scale, new_h, new_w, top_pad, bottom_pad, left_pad, right_pad,
    window_y1, window_x1, window_y2, window_x2). Modes: none, square, pad64.
    """
    hc, wc = _c(h).cast("double"), _c(w).cast("double")
    one = F.lit(1.0)
    if mode == "none":
        scale = one
    else:
        scale = F.greatest(one, F.lit(float(min_dim)) / F.least(hc, wc)) if min_dim else one
        if min_scale:
            scale = F.when(scale < F.lit(float(min_scale)), F.lit(float(min_scale))).otherwise(scale)
        if max_dim and mode == "square":
            image_max = F.greatest(hc, wc)
            # Python's round() is half-to-even
            scale = F.when(F.bround(image_max * scale) > F.lit(max_dim),
                           F.lit(float(max_dim)) / image_max).otherwise(scale)
    nh = F.when(scale != 1, F.bround(hc * scale)).otherwise(hc).cast("int")
    nw = F.when(scale != 1, F.bround(wc * scale)).otherwise(wc).cast("int")
    zero = F.lit(0)
    if mode == "square":
        top = F.floor((F.lit(max_dim) - nh) / 2).cast("int")
        bottom = F.lit(max_dim) - nh - top
        left = F.floor((F.lit(max_dim) - nw) / 2).cast("int")
        right = F.lit(max_dim) - nw - left
    elif mode == "pad64":
        def pads(n):
            padded = n - F.pmod(n, F.lit(64)) + 64
            first = F.when(F.pmod(n, F.lit(64)) > 0, F.floor((padded - n) / 2).cast("int")).otherwise(zero)
            second = F.when(F.pmod(n, F.lit(64)) > 0, padded - n - first).otherwise(zero)
            return first, second
        top, bottom = pads(nh)
        left, right = pads(nw)
    elif mode == "none":
        top = bottom = left = right = zero
    else:
        raise ValueError(f"unsupported mode {mode!r} (crop is random and not built)")
    return F.struct(scale.alias("scale"), nh.alias("new_h"), nw.alias("new_w"),
                    top.alias("top_pad"), bottom.alias("bottom_pad"),
                    left.alias("left_pad"), right.alias("right_pad"),
                    top.alias("window_y1"), left.alias("window_x1"),
                    (nh + top).alias("window_y2"), (nw + left).alias("window_x2"))


def pyramid_level(b: Box, image_h, image_w) -> Column:
    """Feature-pyramid level 2..5 of a normalised box: 4 + round(log2(sqrt(hw) / (224/sqrt(area))))."""
    y1, x1, y2, x2 = b
    area = _c(image_h).cast("double") * _c(image_w).cast("double")
    lvl = F.log2(F.sqrt((y2 - y1) * (x2 - x1)) / (F.lit(224.0) / F.sqrt(area)))
    return F.least(F.lit(5), F.greatest(F.lit(2), F.lit(4) + F.bround(lvl).cast("int")))
