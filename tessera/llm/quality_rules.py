"""Quality rules: an isolation forest over rule statistics.

Rule statistics of every document (repetition, symbols, case, word lengths) go into a
forest of random splits.  Documents that random splits isolate after few steps are
anomalous; the score above which one is rejected comes from labelled rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import unit_hash
from tessera.llm.textstats import BASE, FEATURES, stats_table

#: Statistics that the forest splits on.  The text's length is left out: a long or short text is no anomaly.
RULES = (
    "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "punct_share",
    "digit_share", "bangs_per_word", "letter_share", "long_word_share", "bars_per_word",
)
AT = [FEATURES.index(x) for x in RULES]
MIN_WORDS, REPEAT_PERCENT = 20, 30
BINS = 2000
NODES = "tree long, node long, feature long, split double, depth double"


def average_path(n: float) -> float:
    """Mean steps of an unsuccessful search in a binary search tree of n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def grow_tree(points: np.ndarray, seed: int) -> list[tuple[int, int, float, float]]:
    """Nodes (number, feature, split, depth) of one tree; children of k are 2k+1 and 2k+2, leaves have feature -1."""
    rng = np.random.default_rng(seed)
    limit = max(1, math.ceil(math.log2(max(len(points), 2))))
    nodes, todo = [], [(0, points, 0)]
    while todo:
        number, rows, depth = todo.pop()
        low, high = (rows.min(0), rows.max(0)) if len(rows) else (np.zeros(0), np.zeros(0))
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not open_features.size:
            nodes.append((number, -1, 0.0, depth + average_path(len(rows))))
            continue
        feature = int(rng.choice(open_features))
        split = float(rng.uniform(low[feature], high[feature]))
        left = rows[:, feature] < split
        nodes.append((number, feature, split, float(depth)))
        todo += [(2 * number + 1, rows[left], depth + 1), (2 * number + 2, rows[~left], depth + 1)]
    return nodes


def fit_forest(stats: DataFrame, trees: int, sample: int, seed: str) -> DataFrame:
    """The forest's nodes.  Every tree grows in a task of its own on about `sample` rows and never more.

    Rows are chosen by a hash of their id and statistics, so rows of one id spread over the trees;
    of the rows that fall to a tree those with the lowest hashes stay.  Spark cuts each partition's
    share before it shuffles it, so rows that are all alike don't meet in a tree's task either.
    """
    some = stats.filter(F.col("n_words") > 0)
    n = max(some.count(), 1)
    copies = max(1, min(trees, math.ceil(trees * sample / n)))
    row = F.xxhash64("doc_id", "features")
    fallen = (
        some.select("features", row.alias("row"), unit_hash(row, seed).alias("u"))
        .filter(F.col("u") < F.lit(trees * sample / n))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("tree", F.pmod(F.col("row") + F.col("copy"), F.lit(trees)))
    )
    lowest = Window.partitionBy("tree").orderBy("u", "row")
    chosen = fallen.withColumn("place", F.row_number().over(lowest)).filter(F.col("place") <= sample).select("tree", "place", "features")

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        points = np.stack(rows["features"].to_numpy())[:, AT]
        found = pd.DataFrame(grow_tree(points, int(key[0])), columns=["node", "feature", "split", "depth"])
        return found.assign(tree=int(key[0]))[["tree", "node", "feature", "split", "depth"]]

    return chosen.groupBy("tree").applyInPandas(grow, NODES)


def pack_forest(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Per tree: feature, split, depth and the places of both children."""
    forest = []
    for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
        numbers = tree["node"].to_numpy()
        left = np.searchsorted(numbers, 2 * numbers + 1)
        right = np.searchsorted(numbers, 2 * numbers + 2)
        forest.append((tree["feature"].to_numpy(), tree["split"].to_numpy(), tree["depth"].to_numpy(), left, right))
    return forest


def path_score(forest: list[tuple[np.ndarray, ...]], points: np.ndarray, norm: float) -> np.ndarray:
    """2 ** (-mean path length / norm): near 1 for anomalies."""
    total = np.zeros(len(points))
    every = np.arange(len(points))
    for feature, split, depth, left, right in forest:
        at = np.zeros(len(points), np.int64)
        inner = every[feature[at] >= 0]
        while inner.size:
            k = at[inner]
            at[inner] = np.where(points[inner, feature[k]] < split[k], left[k], right[k])
            inner = inner[feature[at[inner]] >= 0]
        total += depth[at]
    return np.power(2.0, -total / max(len(forest), 1) / max(norm, 1e-9))


def calibrate(histogram: list[tuple[int, int, int]], false_rejects: float) -> float:
    """The lowest score bound that rejects at most that share of the rows labelled good.

    histogram: (bin, quality, rows).  Without rows labelled good nothing is rejected.
    """
    good = np.zeros(BINS + 1)
    bad = np.zeros(BINS + 1)
    for b, quality, n in histogram:
        (good if quality == 1 else bad)[min(max(int(b), 0), BINS)] += n
    if not good.sum():
        return 2.0
    above_good = good[::-1].cumsum()[::-1]  # rejected if the bound is the start of bin b
    above_bad = bad[::-1].cumsum()[::-1]
    allowed = np.flatnonzero(above_good <= false_rejects * good.sum())
    if not allowed.size:
        return 2.0
    # Among allowed bounds with the same catch the highest leaves most room to clean rows.
    best = max(allowed.tolist(), key=lambda b: (above_bad[b], b))
    return best / BINS


def quality_rules(docs: DataFrame, labels: DataFrame, trees: int = 100, sample: int = 256, false_rejects: float = 0.004, seed: str = "forest") -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept of every document.

    docs: doc_id, text; labels: doc_id, quality.  Each tree is fitted on about `sample`
    rows and never more (the method's own subsample, 100 x 256 rows at most in all); counts, scores and
    the calibration cover every row.  Null and empty texts have no words: base_failed.
    Rows whose doc_id is null are judged like others.  Labels that are null are not
    used; a document labelled twice counts with its lower label.
    """
    stats = stats_table(docs)
    nodes = fit_forest(stats, trees, sample, seed).toPandas()
    forest = pack_forest(nodes)
    total = stats.filter(F.col("n_words") > 0).count()
    norm = average_path(min(sample, max(total, 2)))

    def score(batches):
        for batch in batches:
            x = np.array(batch.column("features").to_pylist(), np.float64).reshape(batch.num_rows, len(FEATURES))
            found = path_score(forest, x[:, AT], norm) if batch.num_rows else np.zeros(0)
            columns = [c for c in batch.schema.names if c != "features"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(found, pa.float64())], [*columns, "score"])

    schema = "doc_id long, has_text boolean, " + ", ".join(f"{c} long" for c in BASE) + ", score double"
    scored = stats.mapInArrow(score, schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    )
    truth = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    histogram = (
        scored.filter(~F.col("base_failed"))
        .select("doc_id", F.floor(F.col("score") * BINS).alias("bin"))
        .join(truth, "doc_id")
        .groupBy("bin", "quality")
        .count()
        .collect()
    )
    bound = calibrate([tuple(r) for r in histogram], false_rejects)
    return scored.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("score") < F.lit(bound))).alias("kept"), "score")
