"""Pixel-run (mask) operators.

A mask is never a dense array. It comes as a run table (image_id, instance_id,
start, length) with column-major 1-based starts (image height H), or packed: one row a
mask whose column ``runs`` is an array of (start, length). Every operator takes either form;
a run table is packed by one aggregation, and from then on a row is a mask, or the part of
a mask in one band of columns, so shuffles and sorts carry masks, never runs or pixels.
``runs_to_pixels`` is a utility only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["once", "pack_runs", "runs_to_pixels", "pixels_to_runs", "run_length_encode", "run_length_decode", "mask_iou_join",
           "resolve_mask_overlaps", "occlude", "run_length_encode_rowmajor", "submission_rle",
           "video_submission", "mask_areas"]


def runs_to_pixels(runs: DataFrame, keys=("image_id", "instance_id"), extra=()) -> DataFrame:
    """One row per set pixel: (keys, extra, pos) with 1-based column-major pos."""
    k = [*keys, *extra]
    return runs.filter(F.col("length") > 0).select(
        *k, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos"))


def pixels_to_runs(pixels: DataFrame, keys=("image_id", "instance_id"), pos: str = "pos") -> DataFrame:
    """Maximal runs of consecutive positions (gaps and islands: pos - row_number is constant)."""
    k = list(keys)
    w = Window.partitionBy(*k).orderBy(pos)
    isl = pixels.select(*k, pos, (F.col(pos) - F.row_number().over(w)).alias("_isl"))
    return isl.groupBy(*k, "_isl").agg(F.min(pos).alias("start"), F.count(F.lit(1)).alias("length")).drop("_isl")


def once(col):
    """Evaluated once a row: the optimiser otherwise copies the expression into every filter and
    lambda that uses it, where it would run again for every element."""
    return F.when(F.spark_partition_id() >= 0, col)


def _islands(df: DataFrame, starts, ends, out: str = "runs") -> DataFrame:
    """Union of half-open intervals as maximal runs ``out``, all inside the row: with both ends
    sorted on their own, an island begins at the i-th start that lies beyond the (i-1)-th end
    and stops at the i-th end that the (i+1)-th start lies beyond."""
    df = df.withColumns({"_S": once(F.sort_array(starts)), "_E": once(F.sort_array(ends))})
    first = F.filter("_S", lambda x, i: (i == 0) | (x > F.get("_E", i - 1)))
    last = F.filter("_E", lambda x, i: (i == F.size("_E") - 1) | (F.get("_S", i + 1) > x))
    df = df.withColumns({"_F": once(first), "_L": once(last)}).drop("_S", "_E")
    return df.withColumn(out, once(F.transform("_F", lambda s, i: F.struct(s.alias("start"), (F.get("_L", i) - s).alias("length"))))) \
             .drop("_F", "_L")


def pack_runs(runs: DataFrame, keys=("image_id", "instance_id")) -> DataFrame:
    """One row a mask: its maximal runs, ascending, in the array ``runs`` (overlapping or touching
    ones merged). Empty runs are left out, and masks that have no others. Columns of a packed
    input stay."""
    k = list(keys)
    if "runs" not in runs.columns:
        runs = runs.filter(F.col("length") > 0).groupBy(*k).agg(F.collect_list(F.struct("start", "length")).alias("runs"))
    p = runs.withColumn("runs", once(F.filter("runs", lambda r: r["length"] > 0))).filter(F.size("runs") > 0)
    return _islands(p, F.transform("runs", lambda r: r["start"]), F.transform("runs", lambda r: r["start"] + r["length"]))


def _total(col: str):
    return F.aggregate(col, F.lit(0).cast("long"), lambda n, r: n + r["length"])


def run_length_encode(runs: DataFrame, keys=("image_id", "instance_id"), out: str = "rle") -> DataFrame:
    """'start length start length ...' per mask, runs merged and ascending."""
    return pack_runs(runs, keys).select(
        *keys, F.array_join(F.transform("runs", lambda x: F.concat_ws(" ", x["start"], x["length"])), " ").alias(out))


def run_length_decode(df: DataFrame, rle: str, height: int, width: int, keys=("image_id", "instance_id"),
                      packed: bool = False) -> DataFrame:
    """'s l s l ...' -> run table, with bound checks (W9): a run outside 1..H*W is an error
    row (valid = 0) instead of silently clipped. ``packed``: one row a mask, its runs with
    their flags in the array ``runs``."""
    k = list(keys)
    nums = df.select(*k, once(F.transform(F.split(F.trim(F.col(rle)), r"\s+"), lambda x: x.cast("long"))).alias("_n"))
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("_n") - 1) / 2).cast("int")),
                        lambda i: F.struct(F.get("_n", 2 * i).alias("start"), F.get("_n", 2 * i + 1).alias("length")))
    pairs = F.filter(pairs, lambda p: p["start"].isNotNull() & p["length"].isNotNull())

    def ok(p):
        return (p["start"] >= 1) & (p["length"] >= 0) & (p["start"] + p["length"] - 1 <= height * width)
    r = nums.select(*k, once(F.transform(pairs, lambda p: F.struct(
        p["start"].alias("start"), p["length"].alias("length"), ok(p).cast("int").alias("valid")))).alias("runs"))
    return r.filter(F.size("runs") > 0) if packed else r.select(*k, F.inline("runs"))


def mask_areas(runs: DataFrame, keys=("image_id", "instance_id")) -> DataFrame:
    return pack_runs(runs, keys).select(*keys, _total("runs").alias("area"))


def _banded(masks: DataFrame, size: int, kind: str | None = None) -> DataFrame:
    """Packed masks cut at every ``size`` positions: a row for each band ``_b`` that a mask
    touches, with its runs inside the band as the arrays ``_s`` and ``_e`` (half open, 1-based;
    with ``kind``, from the band's first position on and of that type)."""
    cols = [c for c in masks.columns if c != "runs"]
    first, last = F.get("runs", F.lit(0)), F.element_at("runs", -1)
    bands = F.sequence(F.floor((first["start"] - 1) / size), F.floor((last["start"] + last["length"] - 2) / size))
    b = masks.select(*cols, "runs", F.explode(bands).alias("_b"))
    lo, hi = F.col("_b") * size + 1, (F.col("_b") + 1) * size + 1
    b = b.withColumn("runs", once(F.filter("runs", lambda r: (r["start"] < hi) & (r["start"] + r["length"] > lo)))).filter(F.size("runs") > 0)
    at = (lambda x: (x - lo).cast(kind)) if kind else (lambda x: x)
    return b.select(*cols, "_b", F.transform("runs", lambda r: at(F.greatest(r["start"], lo))).alias("_s"),
                    F.transform("runs", lambda r: at(F.least(r["start"] + r["length"], hi))).alias("_e"))


def mask_iou_join(a: DataFrame, b: DataFrame, height: int, a_key: str = "instance_id",
                  b_key: str = "instance_id", block: int = 32, a_cols=(), b_cols=()) -> DataFrame:
    """IoU of every overlapping pair of masks of the same image (J16). Masks are cut into bands
    of ``block`` columns and joined on (image, band); the overlaps of a pair's runs are added up
    inside the row, then over the bands. Masks with no overlap give no pair (IoU 0), an empty
    side gives no pairs. ``a_cols``, ``b_cols``: columns of packed masks that go along as a_*, b_*."""
    def seg(df, key, p, cols):
        m = pack_runs(df, ["image_id", key]).filter(F.col(key).isNotNull())
        m = m.select("image_id", F.col(key).alias(f"{p}id"), *[F.col(c).alias(f"{p}{c}") for c in cols],
                     _total("runs").alias(f"area_{p[0]}"), "runs")
        return _banded(m, height * block).withColumnsRenamed({"_s": f"{p}s", "_e": f"{p}e"})
    j = seg(a, a_key, "a_", a_cols).join(seg(b, b_key, "b_", b_cols), ["image_id", "_b"], "inner")
    j = j.filter((F.get("a_s", F.lit(0)) < F.element_at("b_e", -1)) & (F.get("b_s", F.lit(0)) < F.element_at("a_e", -1)))
    keys = ["image_id", "a_id", "b_id"]
    rest = ["area_a", "area_b", *[f"a_{c}" for c in a_cols], *[f"b_{c}" for c in b_cols]]
    j = j.select(*keys, *rest, "a_s", "a_e", "b_s", "b_e")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in j.schema.fields[:-4])
    out = j.mapInArrow(lambda batches: map(_shared_positions, batches), f"{ddl}, inter long") \
           .groupBy(*keys).agg(F.sum("inter").alias("inter"), *[F.first(c).alias(c) for c in rest])
    return out.select(*keys, "inter", *rest,
                      (F.col("inter") / (F.col("area_a") + F.col("area_b") - F.col("inter"))).alias("iou"))


def _shared_positions(batch):
    """Rows whose last four columns are the runs of two masks (starts, ends, starts, ends; half open,
    ascending, apart) to the other columns and the positions that both masks hold: a run of the second
    holds as many as the first has before its end, less those before its start."""
    import numpy as np
    import pyarrow as pa
    cols = batch.columns
    a_s, a_e, b_s, b_e = (c.flatten().to_numpy() for c in cols[-4:])
    a_row, b_row = (np.repeat(np.arange(len(c)), np.diff(c.offsets.to_numpy())) for c in (cols[-4], cols[-2]))
    base = int(min(a_s.min(initial=0), b_s.min(initial=0)))
    step = int(max(a_e.max(initial=0), b_e.max(initial=0))) - base + 1
    start, size = a_row * step + a_s - base, a_e - a_s
    before = np.concatenate([[0], np.cumsum(size)])

    def held(x):
        i = np.searchsorted(start, x, side="right")  # runs that begin at or before x
        k = np.maximum(i - 1, 0)
        return before[k] + np.where(i > 0, np.minimum(x - start[k], size[k]), 0) if len(start) else np.zeros(len(x), np.int64)
    n = held(b_row * step + b_e - base) - held(b_row * step + b_s - base)
    inter = np.bincount(b_row, weights=n, minlength=batch.num_rows).astype(np.int64)
    some = inter > 0
    out = pa.RecordBatch.from_arrays([*cols[:-4], pa.array(inter)], names=[*batch.schema.names[:-4], "inter"])
    return out.filter(pa.array(some))


def _resolved(runs: DataFrame, scores: DataFrame, prefer: str, tile: int) -> DataFrame:
    """Packed masks with every position left to one of them (see ``resolve_mask_overlaps``)."""
    k = ["image_id", "instance_id"]
    m = pack_runs(runs.select(*k, *[c for c in ("runs", "start", "length") if c in runs.columns]), k)
    kind = "short" if tile < 1 << 15 else "int"  # of places inside a tile: what shuffles carry
    parts = _banded(m.join(scores.select(*k, "score"), k, "inner"), tile, kind)
    best = prefer == "best"
    one = F.struct(F.col("score").alias("score"), (-F.col("instance_id") if best else F.col("instance_id")).alias("o"),
                   F.col("instance_id").alias("id"), F.col("_s").alias("s"), F.col("_e").alias("e"))
    # rows are dealt before they are collected: a row is smaller than a collection of one
    g = parts.repartition("image_id", "_b").groupBy("image_id", "_b").agg(F.sort_array(F.collect_list(one), asc=not best).alias("_m"))
    g = g.select("image_id", "_b", *[F.col(f"_m.{c}").alias(c) for c in ("id", "s", "e")])
    kinds = {f.name: f.dataType.simpleString() for f in m.schema.fields}
    won = g.mapInArrow(lambda batches: map(_tile_winners, batches),
                       f"image_id {kinds['image_id']}, _b long, instance_id {kinds['instance_id']}, _s array<{kind}>, _l array<{kind}>")
    # dealt by image, as a caller joins them: its lines need no shuffle of their own
    first = F.col("_b") * tile + 1
    won = won.repartition("image_id").groupBy(*k).agg(F.flatten(F.collect_list(F.transform("_s", lambda x: x + first))).alias("_s"),
                                                      F.flatten(F.collect_list(F.col("_l").cast("array<long>"))).alias("_l"))
    won = won.select(*k, once(F.arrays_zip(F.col("_s").alias("start"), F.col("_l").alias("length"))).alias("runs"))
    return pack_runs(won, k)


def _tile_winners(batch):
    """Rows (image_id, _b, id, s, e) of tiles, masks in their order, to (image_id, _b, id, starts, lengths):
    the run ends of a tile cut it into segments, and the first mask that covers a segment takes it."""
    import numpy as np
    import pyarrow as pa
    image, band, ids, s, e = batch.columns
    sizes = np.diff(ids.offsets.to_numpy())
    s, e, ids = s.flatten(), e.flatten(), ids.flatten()
    n_masks = len(ids)
    row = np.repeat(np.arange(len(image)), sizes)  # of each mask
    mask = np.repeat(np.arange(n_masks), np.diff(s.offsets.to_numpy()))  # of each run
    s, e = (c.flatten().to_numpy() for c in (s, e))
    kind, s, e = s.dtype, s.astype(np.int64), e.astype(np.int64)
    base = int(s.min(initial=0))
    step = int(e.max(initial=0)) - base + 1  # rows apart, so that no segment joins two of them
    at = row[mask] * step - base
    cuts = np.unique(np.concatenate([at + s, at + e]))
    i, j = np.searchsorted(cuts, at + s), np.searchsorted(cuts, at + e)
    n = j - i
    seg = np.repeat(i, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    owner = np.full(len(cuts), n_masks)
    np.minimum.at(owner, seg, np.repeat(mask, n))
    k = np.flatnonzero(owner < n_masks)
    own, lo, hi = owner[k], cuts[k], cuts[np.minimum(k + 1, len(cuts) - 1)]
    new = np.ones(len(k), bool)  # a segment that does not go on from the one before
    new[1:] = (own[1:] != own[:-1]) | (lo[1:] != hi[:-1])
    first = np.flatnonzero(new)
    own, lo, hi = own[first], lo[first], hi[np.append(first[1:], len(k))[:len(first)] - 1]
    order = np.argsort(own, kind="stable")
    own, lo, hi = own[order], lo[order], hi[order]
    u, at_u = np.unique(own, return_index=True)
    offsets = pa.array(np.append(at_u, len(own)).astype("int32"))
    start = lo - row[own] * step + base
    return pa.RecordBatch.from_arrays(
        [image.take(pa.array(row[u])), band.take(pa.array(row[u])), ids.take(pa.array(u)),
         pa.ListArray.from_arrays(offsets, pa.array(start.astype(kind))), pa.ListArray.from_arrays(offsets, pa.array((hi - lo).astype(kind)))],
        names=["image_id", "_b", "instance_id", "_s", "_l"])


def resolve_mask_overlaps(runs: DataFrame, scores: DataFrame, prefer: str = "best", tile: int = 2048) -> DataFrame:
    """Each pixel goes to one instance (W10): the best score wins (ties: smaller id);
    ``prefer='lowest'`` gives the reference's effective behaviour (lowest score wins).
    Returns the resolved run table.

    Works on segments, not pixels: masks are cut at fixed tiles of ``tile`` positions; in each
    (image, tile), a row, the run ends split the axis into elementary segments, each covered by a
    fixed set of masks, and the first of the order takes it; an instance's won segments merge back
    into maximal runs. Rows grow with masks; a row holds the masks that touch one tile."""
    return _resolved(runs, scores, prefer, tile).select("image_id", "instance_id", F.inline("runs"))


def occlude(runs: DataFrame, z: DataFrame) -> DataFrame:
    """Later shapes (larger z) hide earlier ones."""
    return resolve_mask_overlaps(runs, z.withColumnRenamed("z", "score"), prefer="best")


def _in_arrays(runs: DataFrame, keys) -> DataFrame:
    """A run table as one row a mask with its runs as they are; masks that come so stay."""
    if "runs" in runs.columns:
        return runs
    return runs.filter(F.col("length") > 0).groupBy(*keys).agg(F.collect_list(F.struct("start", "length")).alias("runs"))


def run_length_encode_rowmajor(runs: DataFrame, height: int, width: int,
                               keys=("image_id", "instance_id"), extra=()) -> DataFrame:
    """Row-major 0-based runs 'start count|start count|...' and the pixel count.
    The last run has its full length. ``extra``: columns of packed masks that go along.

    All inside the mask's row, in Arrow batches: a row of the image has a run wherever a column begins or ends
    against its neighbour, so only those places are listed, not the pixels; runs touching across a row end merge."""
    @F.arrow_udf("struct<encoded_pixels: string, pixel_count: long>")
    def encoded(masks: pa.Array) -> pa.Array:
        return _rowmajor(masks, height, width)
    p = _in_arrays(runs, keys).select(*keys, *extra, once(encoded("runs")).alias("_e")).filter(F.col("_e").isNotNull())
    return p.select(*keys, *extra, "_e.encoded_pixels", "_e.pixel_count")


#: Pixels of the masks that are encoded at once (a larger mask is alone).
ENCODED_PIXELS = 1 << 22


def _rowmajor(masks: pa.Array, height: int, width: int) -> pa.Array:
    """Masks (lists of start and length) to their row-major runs as text and their pixels; null without a run."""
    lists = pc.fill_null(pc.list_value_length(masks), 0).to_numpy()
    flat = masks.flatten()
    start, length = (pc.struct_field(flat, n).cast(pa.int64()) for n in ("start", "length"))
    some = pc.fill_null(pc.and_(pc.greater(length, 0), pc.is_valid(start)), False).to_numpy(zero_copy_only=False)
    mask = np.repeat(np.arange(len(masks)), lists)[some]
    start, length = (c.fill_null(0).to_numpy()[some] for c in (start, length))
    size = np.concatenate([[0], np.cumsum(np.bincount(mask, weights=length, minlength=len(masks)).astype(np.int64))])
    out, at = [], 0
    while at < len(masks):
        end = max(at + 1, int(np.searchsorted(size, size[at] + ENCODED_PIXELS, side="right")) - 1)
        a, b = np.searchsorted(mask, [at, end])
        out.append(_rowmajor_runs(mask[a:b] - at, start[a:b], length[a:b], end - at, height, width))
        at = end
    return pa.concat_arrays(out) if out else pa.array([], pa.struct([("encoded_pixels", pa.string()), ("pixel_count", pa.int64())]))


def _maximal(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of half-open intervals of every row (ascending): (row, start, end), see ``_islands``."""
    base = int(start.min(initial=0))
    step = int(end.max(initial=0)) - base + 2  # rows apart
    s, e = np.sort(row * step + start - base), np.sort(row * step + end - base)
    first = np.concatenate([np.ones(min(1, len(s)), bool), s[1:] > e[:-1]])
    s, e = s[first], e[np.concatenate([first[1:], np.ones(min(1, len(s)), bool)])]
    return s // step, s % step + base, e - s // step * step + base


def _rowmajor_runs(mask: np.ndarray, start: np.ndarray, length: np.ndarray, n: int, height: int, width: int) -> pa.Array:
    mask, s, e = _maximal(mask, start - 1, start - 1 + length)
    lo, hi = s // height, (e - 1) // height
    times = hi - lo + 1  # columns of a run
    piece = np.repeat(np.arange(len(s)), times)
    x = lo[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(times) - times, times)
    y0, y1, mask = np.maximum(s[piece] - x * height, 0), np.minimum(e[piece] - x * height, height), mask[piece]
    left = int(x.min(initial=0)) - 1
    columns, rows = int(x.max(initial=0)) - left + 2, height + 1

    def alone(by: int):
        """(mask, column, row) of the pixels whose neighbour ``by`` columns on is not set."""
        own, other = ((mask * columns + x - left + k) * rows for k in (0, -by))
        event = np.concatenate([(own + y0) * 4, (own + y1) * 4 + 1, (other + y0) * 4 + 2, (other + y1) * 4 + 3])
        event.sort()
        kind, place = event & 3, event >> 2
        here = np.cumsum(np.array([1, -1, 0, 0])[kind])
        there = np.cumsum(np.array([0, 0, 1, -1])[kind])
        k = np.flatnonzero((here[:-1] > 0) & (there[:-1] == 0) & (place[1:] > place[:-1])) if len(place) else np.zeros(0, int)
        count = place[k + 1] - place[k]
        at = np.repeat(place[k], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at, y = at // rows, at % rows
        return at // columns, at % columns + left, y

    (m, first, top), (_, last, bottom) = alone(-1), alone(1)  # of every run its first and its last pixel, as many a mask
    m, s, e = _maximal(m, top * width + first, bottom * width + last + 1)
    text = pc.binary_join_element_wise(pa.array(s).cast(pa.string()), pa.array(e - s).cast(pa.string()), " ")
    found = np.bincount(m, minlength=n)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(found)]).astype(np.int32)), text)
    encoded = pc.binary_join_element_wise(pc.binary_join(lists, "|"), "", "|")
    total = np.concatenate([[0], np.cumsum(e - s)])[np.concatenate([[0], np.cumsum(found)])]
    return pa.StructArray.from_arrays([encoded, pa.array(np.diff(total))], names=["encoded_pixels", "pixel_count"], mask=pa.array(found == 0))


def submission_rle(images: DataFrame, runs: DataFrame, scores: DataFrame) -> DataFrame:
    """ImageId, EncodedPixels lines (D15): overlaps resolved by score, one line per instance,
    one empty line for an image without instances."""
    enc = run_length_encode(_resolved(runs, scores, "best", 2048))
    lines = images.select("image_id").join(enc, "image_id", "left")
    return lines.select(F.col("image_id").alias("ImageId"), "instance_id",
                        F.coalesce(F.col("rle"), F.lit("")).alias("EncodedPixels"))


def video_submission(runs: DataFrame, detections: DataFrame, label_map: dict, height: int, width: int) -> DataFrame:
    """ImageId, LabelId, Confidence, PixelCount, EncodedPixels (D19): wanted classes only,
    class ids mapped, empty masks skipped, id = file name before '.jp'."""
    from tessera.operators.clean import map_values
    det = detections.filter(F.col("class_id").isin(list(label_map.keys())))
    k = ["image_id", "instance_id"]
    # masks meet their detections as they are, so no encoded text is moved
    j = det.join(_in_arrays(runs, k).select(*k, "runs"), k, "inner")
    j = run_length_encode_rowmajor(j, height, width, k, ("file_name", "class_id", "score")).filter(F.col("pixel_count") > 0)
    return j.select(F.substring_index("file_name", ".jp", 1).alias("ImageId"),
                    map_values("class_id", label_map).alias("LabelId"),
                    F.col("score").alias("Confidence"), F.col("pixel_count").alias("PixelCount"),
                    F.col("encoded_pixels").alias("EncodedPixels"))
