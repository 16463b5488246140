"""Quality classifier: ridge regression on random Fourier features, isotonic calibration.

Random Fourier features approximate a Gaussian kernel over document statistics.  Each
partition sums its part of the normal equations, Spark adds the parts up, and the
solution of a few hundred unknowns is found on the driver.  Two halves of the labelled
rows are fitted apart; each half is scored by the other's fit, and those scores set the
isotonic calibration.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold_of
from tessera.llm.textstats import FEATURES, stats_table

FOLDS, HELD_OUT = 3, 1
LOW, HIGH, BINS = -1.0, 2.0, 1500


def fourier_map(size: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of `size` features of a Gaussian kernel of that width."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, 1.0 / width, (len(FEATURES), size)), rng.uniform(0.0, 2.0 * np.pi, size)


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """Rows of [1, Fourier features] of standardised statistics, cut to 8 deviations."""
    z = np.clip((x - mean) / scale, -8.0, 8.0)
    return np.hstack([np.ones((len(z), 1)), np.sqrt(2.0 / len(phases)) * np.cos(z @ frequencies + phases)])


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest non-decreasing sequence in weighted least squares."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def isotonic(histogram: list[tuple[int, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw score, probability) from (bin, rows, rows labelled 1); probabilities keep 0.001 away from 0 and 1."""
    rows = sorted(histogram)
    if not rows:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    at = np.array([LOW + (r[0] + 0.5) * (HIGH - LOW) / BINS for r in rows])
    n = np.array([float(r[1]) for r in rows])
    ones = np.array([float(r[2]) for r in rows])
    p = pool_adjacent(ones / n, n)
    return at, np.clip(p, 1e-3, 1 - 1e-3)


def _design(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("features").to_pylist(), np.float64).reshape(batch.num_rows, len(FEATURES))


def quality_scores(docs: DataFrame, labels: DataFrame, size: int = 256, width: float = 4.0, ridge: float = 0.3, seed: int = 11) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every document.

    Learns from all labelled rows outside the held-out fold; labels, language, source and
    id are never inputs of a score.  Null and empty texts are scored by their zero
    statistics.  Labels that are null are not used; a document labelled twice counts with
    its lower label.  Without any usable label every score is 0.5.
    """
    stats = stats_table(docs)
    truth = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("double").alias("y"))
    fold = fold_of(F.col("doc_id"), FOLDS)
    train = stats.select("doc_id", "features", fold.alias("fold")).filter(F.col("fold") != HELD_OUT).join(truth, "doc_id")

    k = len(FEATURES)
    moments = train.select(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(F.col("features")[i]).alias(f"m{i}") for i in range(k)),
        *(F.stddev_pop(F.col("features")[i]).alias(f"s{i}") for i in range(k)),
    ).first()
    n = moments["n"]
    held = (fold == HELD_OUT).alias("held_out")
    if not n:
        return stats.select("doc_id", held, F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    mean = np.array([moments[f"m{i}"] for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 1.0 for i in range(k)])
    frequencies, phases = fourier_map(size, width, seed)

    def normal_equations(batches):
        """Rows (half, i, row i of [X'X | X'y | n]) of this partition's sums."""
        sums = np.zeros((2, size + 1, size + 2))
        for batch in batches:
            x = expand(_design(batch), mean, scale, frequencies, phases)
            y = np.array(batch.column("y").to_pylist())
            half = np.array(batch.column("fold").to_pylist()) == 2
            for h in (0, 1):
                own = half == bool(h)
                sums[h] += x[own].T @ np.hstack([x[own], y[own, None]])
        keep = [(h, i) for h in (0, 1) for i in range(size + 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in keep], pa.int64()), pa.array([i for _, i in keep], pa.int64()), pa.array([sums[h, i].tolist() for h, i in keep], pa.list_(pa.float64()))], ["half", "i", "row"]
        )

    # One row per partition, half and i comes here; sums of columns hold one row of each group at a time.
    parts = train.mapInArrow(normal_equations, "half long, i long, row array<double>")
    solved = parts.groupBy("half", "i").agg(*(F.sum(F.col("row")[j]).alias(f"s{j}") for j in range(size + 2))).collect()
    sums = np.zeros((2, size + 1, size + 2))
    for r in solved:
        sums[r["half"], r["i"]] = r[2:]
    if not all(sums[h, 0, 0] for h in (0, 1)):  # one half has no rows: both use what there is
        sums[:] = sums.sum(axis=0)
    penalty = ridge * np.eye(size + 1)
    penalty[0, 0] = 0.0
    weights = np.stack([np.linalg.lstsq(sums[h][:, : size + 1] + penalty, sums[h][:, size + 1], rcond=None)[0] for h in (0, 1)])

    def raw_scores(batches):
        for batch in batches:
            x = expand(_design(batch), mean, scale, frequencies, phases)
            own = x @ weights.T
            half = np.array(batch.column("fold").to_pylist()) == 2
            across = np.where(half, own[:, 0], own[:, 1])
            b = np.clip(np.floor((across - LOW) / (HIGH - LOW) * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(b), batch.column("y")], ["bin", "y"])

    histogram = train.mapInArrow(raw_scores, "bin long, y double").groupBy("bin").agg(F.count(F.lit(1)), F.sum(F.when(F.col("y") >= 1, 1.0).otherwise(0.0))).collect()
    knots, chances = isotonic([tuple(r) for r in histogram])

    def score(batches):
        for batch in batches:
            x = expand(_design(batch), mean, scale, frequencies, phases)
            p = np.interp((x @ weights.T).mean(axis=1), knots, chances) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p, pa.float64())], ["doc_id", "held_out", "score"])

    scored = stats.select("doc_id", held, "features").mapInArrow(score, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
