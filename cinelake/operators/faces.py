"""Faces: detection filters, box matching, identity templates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions import geometry, vectors

CELL = 8192  # about the most boxes, and faces, that are matched at a time
SIDES = ("left", "top", "right", "bottom", "area")


def keep_faces(frames: DataFrame, min_size: int, min_conf: float) -> DataFrame:
    """frames with ``bboxes`` cut down to large and sure ones; frames without any stay."""
    return frames.withColumn("bboxes", F.filter("bboxes", lambda b: (b["w"] >= min_size) & (b["h"] >= min_size) & (b["det_conf"] >= min_conf)))


def frame_stats(frames: DataFrame) -> DataFrame:
    """One row per video: num_timestamps, frames_with_faces, total_faces."""
    n = F.size("bboxes")
    return frames.groupBy("video_id").agg(F.count(F.lit(1)).alias("num_timestamps"), F.count_if(n > 0).alias("frames_with_faces"), F.sum(n).cast("long").alias("total_faces"))


def match_boxes(boxes: DataFrame, faces: DataFrame, min_iou: float = 0.3, cell: int = CELL) -> DataFrame:
    """boxes(video_id, frame_idx, ord, x, y, w, h) x faces(video_id, frame_idx, ford, x1, y1, x2, y2) of the same frame ->
    every box with its best face (first on ties; null if none overlaps) and whether the match is accepted.

    Pairs are never rows: boxes and faces of a frame lie together in one task, in order, and each box leaves with one face.
    The pairs of a frame of more than ``cell`` boxes or faces are dealt to cells of about as many of each, so a cell's memory is bounded.
    """
    met = best_overlaps(boxes, faces, cell)
    best = met.groupBy("video_id", "frame_idx", "ord").agg(F.min(F.struct((-F.col("iou")).alias("neg"), "ford")).alias("b"))
    out = boxes.join(best, ["video_id", "frame_idx", "ord"], "left")
    iou = F.coalesce(-F.col("b.neg"), F.lit(0.0))
    return out.select(*boxes.columns, F.col("b.ford").alias("ford"), iou.alias("iou"), (iou >= min_iou).alias("accepted"))


def best_overlaps(boxes: DataFrame, faces: DataFrame, cell: int = CELL) -> DataFrame:
    """(video_id, frame_idx, ord, iou, ford): of each box, the best face of each cell that has one overlapping it."""
    key = ["video_id", "frame_idx"]
    ord_type, ford_type = boxes.schema["ord"].dataType, faces.schema["ford"].dataType

    def sides(left: str, top: str, right: Column, bottom: Column, area: Column) -> list[Column]:
        return [c.cast("double").alias(n) for n, c in zip(SIDES, (F.col(left), F.col(top), right, bottom, area))]

    b = boxes.select(*key, F.lit(False).alias("face"), "ord", F.lit(None).cast(ford_type).alias("ford"), *sides("x", "y", F.expr("x + w"), F.expr("y + h"), F.expr("w * h")))
    f = faces.select(*key, F.lit(True).alias("face"), F.lit(None).cast(ord_type).alias("ord"), "ford", *sides("x1", "y1", F.col("x2"), F.col("y2"), F.expr("(x2 - x1) * (y2 - y1)")))
    rows = b.unionByName(f).where("video_id is not null and frame_idx is not null")
    n = rows.groupBy(*key).agg(F.count_if(~F.col("face")).alias("nb"), F.count_if("face").alias("nf"))
    hot = n.where((F.col("nb") > cell) | (F.col("nf") > cell))  # at most one in ``cell`` rows is such a frame
    hot = hot.select(*key, *(F.greatest(F.ceil(F.col(c) / F.lit(cell)), F.lit(1)).cast("int").alias(c) for c in ("nb", "nf")))
    rows = rows.join(F.broadcast(hot), key, "left").withColumn("nb", F.coalesce("nb", F.lit(1))).withColumn("nf", F.coalesce("nf", F.lit(1)))
    own = F.floor(F.rand(7) * F.when(F.col("face"), F.col("nf")).otherwise(F.col("nb"))).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.when(F.col("face"), F.col("nb")).otherwise(F.col("nf")) - 1))
    rows = rows.withColumn("own", own).withColumn("other", met)
    rows = rows.withColumn("i", F.when(F.col("face"), F.col("other")).otherwise(F.col("own"))).withColumn("j", F.when(F.col("face"), F.col("own")).otherwise(F.col("other")))
    rows = rows.select(*key, "i", "j", "face", "ord", "ford", *SIDES).repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j", "face", "ford")
    out = T.StructType([*(T.StructField(c, boxes.schema[c].dataType) for c in (*key, "ord")), T.StructField("iou", T.DoubleType()), T.StructField("ford", ford_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cuts in _cells(batches):
            face = t.column("face").to_numpy(zero_copy_only=False)
            sides = np.stack([t.column(c).to_numpy(zero_copy_only=False) for c in SIDES])
            at, best, value = [], [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                mid = lo + int(np.count_nonzero(~face[lo:hi]))
                if lo < mid < hi:
                    k, v = _best_faces(sides[:, lo:mid], sides[:, mid:hi])
                    own = np.flatnonzero(v > 0)
                    at.append(own + lo), best.append(k[own] + mid), value.append(v[own])
            if at:
                which = pa.array(np.concatenate(at))
                columns = [t.column(c).take(which) for c in (*key, "ord")]
                columns += [pa.array(np.concatenate(value)), t.column("ford").take(pa.array(np.concatenate(best)))]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return rows.mapInArrow(run, out)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole cells, with the places where each begins, and the end."""
    held = None
    for b in batches:
        held = b if held is None else pa.concat_batches([held, b])
        if held.num_rows:
            new = np.zeros(held.num_rows - 1, dtype=bool)
            for c in ("video_id", "frame_idx", "i", "j"):
                x = held.column(c)
                new |= pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
            if cuts[-1]:
                yield held.slice(0, int(cuts[-1])), cuts
                held = held.slice(int(cuts[-1]))
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def _best_faces(boxes: np.ndarray, faces: np.ndarray, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(place, overlap) of each box's best face, the first on ties; overlap 0 without one. Both are rows of SIDES.

    As geometry.iou counts: a missing side (NaN) gives way to the other one's. Boxes near each other meet, a block at a time, the faces
    that reach into the block's bounds.
    """
    n = boxes.shape[1]
    low, high = np.where(np.isnan(boxes[:2]), -np.inf, boxes[:2]), np.where(np.isnan(boxes[2:4]), np.inf, boxes[2:4])
    order = np.arange(n)
    if n > block:
        strips = max(1, int(np.sqrt(n / block)))
        strip = np.empty(n, np.int64)
        strip[np.argsort(low[0], kind="stable")] = order * strips // n
        order = np.lexsort((low[1], strip))
    f_low, f_high = np.where(np.isnan(faces[:2]), -np.inf, faces[:2]), np.where(np.isnan(faces[2:4]), np.inf, faces[2:4])
    place, value = np.zeros(n, np.int64), np.zeros(n)
    for first in range(0, n, block):
        own = order[first : first + block]
        reach = (f_low < high[:, own].max(axis=1)[:, None]) & (f_high > low[:, own].min(axis=1)[:, None])
        near = np.flatnonzero(reach[0] & reach[1])
        if not len(near):
            continue
        b, f = boxes[:, own][:, :, None], faces[:, near][:, None, :]
        inter = np.fmax(np.fmin(b[2], f[2]) - np.fmax(b[0], f[0]), 0.0)
        inter *= np.fmax(np.fmin(b[3], f[3]) - np.fmax(b[1], f[1]), 0.0)
        union = b[4] + f[4] - inter
        iou = np.divide(inter, union, out=np.zeros_like(inter), where=(inter > 0) & (union > 0))
        k = iou.argmax(axis=1)
        place[own], value[own] = near[k], iou[np.arange(len(own)), k]
    return place, value


def quality_rows(boxes: DataFrame, q_min: float | None = 0.25) -> DataFrame:
    """boxes(x, y, w, h, width, height, blur, det_conf) that are not degenerate after clipping, with area share and quality."""
    c = {n: F.col(n) for n in ("x", "y", "w", "h", "width", "height", "blur", "det_conf")}
    out = boxes.withColumn("clip", geometry.clip_box(c["x"], c["y"], c["w"], c["h"], c["width"], c["height"])).where("clip.w > 0 and clip.h > 0")
    out = out.withColumn("bbox_area_ratio", F.col("clip.w") * F.col("clip.h") / (c["width"] * c["height"]))
    out = out.withColumn("quality", geometry.face_quality(c["blur"], F.col("bbox_area_ratio"), c["det_conf"]))
    return out if q_min is None else out.where(F.col("quality") >= q_min)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("__rn = 1").drop("__rn")


def best_face(faces: DataFrame, key: str) -> DataFrame:
    """The surest face of each key, the first on ties."""
    return faces.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("det_conf"), "ord"))).where("__rn = 1").drop("__rn")


def centroids(rows: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """(key, centroid): normalised mean vector. The mean is per dimension, so partial sums leave each task."""
    parts = rows.select(key, F.posexplode(vec).alias("dim", "v")).groupBy(key, "dim").agg(F.avg("v").alias("m"))
    whole = parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("centroid"))
    return whole.withColumn("centroid", vectors.normalise(F.col("centroid")))


def identity_templates(rows: DataFrame, key: str, order: str, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """(templates: key, centroid and the statistics of its members' cosines; exemplars: the top members, first on ties)."""
    rows = rows.withColumn("embedding", vectors.normalise(F.col("embedding").cast("array<double>")))
    scored = rows.join(centroids(rows, key), key).withColumn("similarity", vectors.cosine(F.col("embedding"), F.col("centroid")))
    s = F.col("similarity")
    stats = scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("count"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"), F.any_value("centroid").alias("centroid")
    )
    # Rounded, so that sums in another order rank alike.
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.bround("similarity", 9)), order))
    return stats, scored.withColumn("rank", rank).where(F.col("rank") <= max(1, top))


def identity_documents(rows: DataFrame, top: int = 5) -> DataFrame:
    """rows(identity_id, image_path, embedding) -> one JSON template per identity: centroid, exemplars, statistics, sources."""
    stats, best = identity_templates(rows, "identity_id", "image_path", top)
    chosen = best.groupBy("identity_id").agg(F.array_sort(F.collect_list(F.struct("rank", "image_path", "similarity", "embedding"))).alias("exemplars"))
    sources = rows.groupBy("identity_id").agg(F.array_sort(F.collect_list("image_path")).alias("sources"))
    intra = F.struct("count", F.col("mean").alias("mean_cosine"), F.col("std").alias("std_cosine"), F.col("min").alias("min_cosine"), F.col("max").alias("max_cosine"))
    out = stats.join(chosen, "identity_id").join(sources, "identity_id")
    document = F.struct("identity_id", F.size("centroid").alias("embedding_dim"), "centroid", "exemplars", intra.alias("intra_class"), "sources")
    return out.select("identity_id", F.to_json(document).alias("document"))


def sample_times(videos: DataFrame, fps: float, around: DataFrame | None = None, window_s: float = 0.5) -> DataFrame:
    """(video_id, ts): a grid of 1/fps below the duration, and points around boundaries(video_id, boundary_s)."""
    n = F.ceil(F.col("duration_s") * fps).cast("long")
    grid = videos.where("duration_s > 0").select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k")).select("video_id", (F.col("k") / fps).alias("ts"))
    if around is not None:
        b = F.col("boundary_s")
        near = around.join(videos, "video_id").select("video_id", "duration_s", F.explode(F.array(b - window_s, b, b + window_s)).alias("ts"))
        grid = grid.unionByName(near.where((F.col("ts") >= 0) & (F.col("ts") < F.col("duration_s"))).select("video_id", "ts"))
    return grid.distinct()
