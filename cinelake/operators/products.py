"""Product catalogue: keyframe sampling, detection joins, clustering, reference pick and noise rules."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subsample(frames: DataFrame, most: int, key: str = "video_id", order: str = "ord") -> DataFrame:
    """At most ``most`` rows a video, evenly spaced: rows int(i * n / most) where there are more. Adds rank from 0."""
    per = Window.partitionBy(key)
    rows = frames.withColumn("__i", F.row_number().over(per.orderBy(order)) - 1).withColumn("__n", F.count(F.lit(1)).over(per))
    # Row r is taken if some i has floor(i * n / most) = r; the first such i is its new rank.
    i = F.ceil(F.col("__i") * F.lit(float(most)) / F.col("__n"))
    taken = (F.col("__n") <= most) | ((i < most) & (F.floor(i * (F.col("__n") / F.lit(float(most)))) == F.col("__i")))
    return rows.where(taken).withColumn("rank", F.when(F.col("__n") <= most, F.col("__i")).otherwise(i).cast("long")).drop("__i", "__n")


def batches(rows: DataFrame, size: int) -> DataFrame:
    return rows.withColumn("batch_id", F.floor(F.col("rank") / size).cast("long"))


def back_map(detections: DataFrame, keyframes: DataFrame) -> DataFrame:
    """Detections whose (video_id, batch_id, scene_id, frame_idx) is a sent keyframe; of equal keyframes the last counts."""
    key = ["video_id", "batch_id", "scene_id", "frame_idx"]
    last = keyframes.groupBy(*key).agg(F.max("ord").alias("keyframe_ord"))
    return detections.join(last, key)


def total_cost(batch_rows: DataFrame) -> DataFrame:
    return batch_rows.groupBy("video_id").agg(F.sum("cost_usd").alias("cost_usd"))


CLUSTER_SCHEMA = "video_id bigint, ord bigint, cluster_id bigint, cluster_size bigint"


def _greedy(vecs: np.ndarray, frames: list, threshold: float) -> list[int]:
    """Cluster of each vector, in order: the most similar centroid (the later on ties) without a member of the same frame,
    if it reaches the threshold; else a new cluster. Centroids are normalised means of the members."""
    sums = np.zeros((max(len(vecs), 1), vecs.shape[1] if vecs.ndim == 2 else 1))
    unit, held, out = np.zeros_like(sums), [], []
    for v, frame in zip(vecs, frames):
        n, length = len(held), np.linalg.norm(v)
        best = -1
        if n and length:
            sims = unit[:n] @ v / length
            for k in np.flatnonzero([frame in h for h in held]):
                sims[k] = -np.inf
            k = n - 1 - int(np.argmax(sims[::-1]))
            best = k if sims[k] >= threshold else -1
        if best < 0:
            best = n
            held.append(set())
        held[best].add(frame)
        sums[best] += v
        size = np.linalg.norm(sums[best])
        unit[best] = sums[best] / size if size else 0
        out.append(best)
    return out


def cluster_detections(rows: DataFrame, threshold: float = 0.85) -> DataFrame:
    """rows(video_id, ord, frame_key, embedding) -> cluster of every detection.

    Order decides, so a video is one group; the design size is some hundreds of detections a video.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord", kind="stable")
        ids = _greedy(np.array(pdf["embedding"].tolist(), dtype=float), pdf["frame_key"].tolist(), threshold)
        sizes = np.bincount(ids, minlength=1)
        return pd.DataFrame({"video_id": pdf["video_id"], "ord": pdf["ord"], "cluster_id": ids, "cluster_size": sizes[ids] if ids else []})

    return rows.select("video_id", "ord", "frame_key", "embedding").groupBy("video_id").applyInPandas(one, CLUSTER_SCHEMA)


def pick_reference(rows: DataFrame, score: str = "composite") -> DataFrame:
    """The best row of each cluster, the first on ties."""
    rank = F.row_number().over(Window.partitionBy("video_id", "cluster_id").orderBy(F.desc(score), "ord"))
    return rows.withColumn("__rn", rank).where("__rn = 1").drop("__rn")


def noise_reason(size: Column, conf: Column, prom: Column, min_size: int = 2, min_conf: float = 0.6, min_prom: float = 0.03) -> Column:
    """Why a product is rejected; null if it is not."""
    return F.when(size < min_size, "single_keyframe").when(conf < min_conf, "low_confidence").when(prom < min_prom, "low_prominence")
