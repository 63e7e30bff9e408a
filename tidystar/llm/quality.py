"""Quality scores from document statistics: random Fourier features, ridge, isotonic calibration.

1. One narrow pass turns every whole text into a few statistics.
2. Labelled rows only: statistics are standardised and mapped to ``FEATURES``
   random Fourier features, which approximate a Gaussian kernel. Features are
   rounded to fixed point, so each partition's part of the normal equations is a
   table of exact integers; Spark sums the parts, and the result does not depend
   on the partitioning. The driver solves one FEATURES x FEATURES system.
3. Two folds are fitted and each scores the other; the scores are counted in
   fixed bins over all labelled rows and a monotone (isotonic) curve through the
   bins turns a ridge score into a probability.

What reaches the driver is bounded by FEATURES and BINS, not by the rows.

Defined results: a NULL text counts as empty; empty texts get a score like any
other. Labels that are NULL are left out, of several labels of one id the
largest counts, and rows with a NULL id are never learned from. Without labelled
rows every score is 0.5. Rows that repeat an id are each scored. Only the text
is an input of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm.common import SLICE_BYTES, annotate, cut_lineage, text_buffers
from tidystar.llm.near_dedup import HASHED_BYTES, word_hashes

FEATURES = 256
BINS = 2048
RIDGE = 1e-3
#: Fixed point of a feature: 12 bits.
_SCALE = 4096.0
#: Rows whose features are held at a time, whatever the size of a batch.
FEATURE_ROWS = 1024

_SPACE, _NEWLINE, _LOWER, _UPPER, _DIGIT, _POINT, _BANG, _BAR, _SIGN, _HIGH, _CONTROL = range(11)
N_STATS = 15


def _byte_kinds() -> np.ndarray:
    out = np.full(256, _SIGN, np.uint8)
    out[:32] = out[127] = _CONTROL
    out[[9, 32]] = _SPACE
    out[[10, 13]] = _NEWLINE
    out[ord("a"):ord("z") + 1] = _LOWER
    out[ord("A"):ord("Z") + 1] = _UPPER
    out[ord("0"):ord("9") + 1] = _DIGIT
    out[[ord(c) for c in ".,;:?'\"()-"]] = _POINT
    out[ord("!")] = _BANG
    out[ord("|")] = _BAR
    out[128:] = _HIGH
    return out


_KINDS = _byte_kinds()


def document_stats(column: pa.Array) -> np.ndarray:
    """(texts, N_STATS) statistics of whole texts."""
    data, offsets = text_buffers(column)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    if n == 1:  # a very long text is alone in its slice; counting takes 8 bytes for each of its bytes
        counts = sum((np.bincount(_KINDS[data[a:a + SLICE_BYTES]], minlength=16)
                      for a in range(0, len(data), SLICE_BYTES)), np.zeros(16, np.int64))[None].astype(float)
    else:
        doc = np.repeat(np.arange(n, dtype=np.int64), sizes)
        counts = np.bincount(doc * 16 + _KINDS[data], minlength=16 * n)[:16 * n].reshape(n, 16).astype(float)
    share = counts / np.maximum(sizes, 1)[:, None]
    words, bounds = word_hashes(data, offsets)
    n_words = np.diff(bounds)
    distinct, top = np.ones(n), np.zeros(n)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            x = np.sort(words[a:b])
            edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]]))
            distinct[i] = (len(edge) - 1) / (b - a)
            top[i] = np.diff(edge).max() / (b - a)
    return np.stack([
        np.log1p(sizes), np.minimum(sizes / np.maximum(n_words, 1), 40.0), np.log1p(n_words) * (1 - distinct), top,
        *(np.sqrt(share[:, k]) for k in range(11))], axis=1)


@dataclass
class QualityModel:
    mean: np.ndarray = None
    scale: np.ndarray = None
    project: np.ndarray = None     # (N_STATS, FEATURES)
    phase: np.ndarray = None
    weights: np.ndarray = None     # (FEATURES + 1,)
    curve_x: np.ndarray = None     # ridge score -> probability, monotone
    curve_y: np.ndarray = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Fixed-point random Fourier features and a constant, whole numbers."""
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.rint(np.cos(x @ self.project + self.phase) * _SCALE)
        return np.concatenate([z, np.full((len(z), 1), _SCALE)], axis=1)

    def ridge(self, stats: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.empty(len(stats))
        for at in _pieces(len(stats)):
            out[at] = self.features(stats[at]) @ weights / _SCALE
        return out

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.ridge(stats, self.weights), self.curve_x, self.curve_y), 0.0, 1.0)


def _pieces(n: int) -> list[slice]:
    return [slice(a, min(a + FEATURE_ROWS, n)) for a in range(0, n, FEATURE_ROWS)]


def _stats_array(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("stats").flatten()).reshape(batch.num_rows, N_STATS)


def _normal_parts(rows: DataFrame, model: QualityModel) -> DataFrame:
    """Sums over all rows, by fold, of products of features (i <= j) and of feature and label (j = -1).

    A sum is ``high * 2**32 + low``: sums of two longs stay exact however many partitions there are.
    """
    upper = np.triu_indices(FEATURES + 1)
    i = np.concatenate([upper[0], np.arange(FEATURES + 1)]).astype(np.int32)
    j = np.concatenate([upper[1], np.full(FEATURES + 1, -1)]).astype(np.int32)

    def run(batches):
        sums = {}
        for batch in batches:
            stats = _stats_array(batch)
            y = np.asarray(batch.column("label"), dtype=float)
            fold = np.asarray(batch.column("fold"))
            for at in _pieces(batch.num_rows):
                z = model.features(stats[at])
                for f in (0, 1):
                    part = z[fold[at] == f]
                    gram, right = sums.setdefault(f, [np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)])
                    gram += part.T @ part
                    right += part.T @ y[at][fold[at] == f]
        for f, (gram, right) in sums.items():
            value = np.concatenate([gram[upper], right]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), f, np.int32)), pa.array(i), pa.array(j),
                 pa.array(value >> 32), pa.array(value & 0xFFFFFFFF)],
                names=["fold", "i", "j", "high", "low"])

    return rows.mapInArrow(run, "fold int, i int, j int, high bigint, low bigint") \
        .groupBy("fold", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    n = max(gram[-1, -1], 1.0)
    penalty = RIDGE * n * np.eye(len(gram))
    penalty[-1, -1] = 0
    return np.linalg.lstsq(gram + penalty, right, rcond=None)[0]


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted ``x``: block centres and their non-decreasing means."""
    blocks: list[list[float]] = []  # [weight, weighted y, weighted x]
    for xi, yi, wi in zip(x, y, weight):
        blocks.append([wi, wi * yi, wi * xi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks]))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality",
        text_col: str = "text", seed: int = 5) -> QualityModel:
    """Learn from every labelled row of ``docs`` where ``learn`` holds (joined on doc_id)."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max(F.col(label_col).cast("double")).alias("label"))
    stats = annotate(docs.where(learn), text_col, ["doc_id"], "stats array<double>", lambda: lambda column: [
        pa.FixedSizeListArray.from_arrays(pa.array(document_stats(column).ravel()), N_STATS)
        .cast(pa.list_(pa.float64()))], max_bytes=HASHED_BYTES)
    rows = cut_lineage(spark, stats.join(marked, "doc_id").select(
        "stats", "label", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")), "labelled")

    values = [F.col("stats")[k] for k in range(N_STATS)]
    found = rows.agg(F.count("*"), *(F.avg(v) for v in values), *(F.stddev_pop(v) for v in values)).first()
    if not found[0]:
        return QualityModel()
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean=np.round(np.array(found[1:1 + N_STATS]), 6),
        scale=np.maximum(np.round(np.array(found[1 + N_STATS:]), 6), 1e-3),
        project=rng.normal(0, 1.0 / np.sqrt(N_STATS), (N_STATS, FEATURES)),
        phase=rng.uniform(0, 2 * np.pi, FEATURES))

    gram, right = np.zeros((2, FEATURES + 1, FEATURES + 1)), np.zeros((2, FEATURES + 1))
    parts = _normal_parts(rows, model).toArrow()  # bounded by FEATURES squared
    fold, i, j = (parts.column(c).to_numpy() for c in ("fold", "i", "j"))
    value = parts.column("high").to_numpy() * 2.0 ** 32 + parts.column("low").to_numpy()
    of_label = j < 0
    right[fold[of_label], i[of_label]] = value[of_label] / _SCALE
    fold, i, j, value = (x[~of_label] for x in (fold, i, j, value))
    gram[fold, i, j] = gram[fold, j, i] = value / _SCALE ** 2
    del parts, fold, i, j, value
    model.weights = _solve(gram.sum(axis=0), right.sum(axis=0))
    other = [_solve(gram[1 - f], right[1 - f]) for f in (0, 1)]

    def scored(batches):
        for batch in batches:
            stats, fold = _stats_array(batch), np.asarray(batch.column("fold"))
            score = np.where(fold == 0, model.ridge(stats, other[0]), model.ridge(stats, other[1]))
            at = np.floor(np.clip(score, -1, 2) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["bin", "label"])

    bins = rows.mapInArrow(scored, "bin bigint, label double").groupBy("bin") \
        .agg(F.count("*").alias("n"), F.sum("label").alias("y")).orderBy("bin").collect()
    n = np.array([b["n"] for b in bins], float)
    model.curve_x, model.curve_y = isotonic(
        np.array([(b["bin"] + 0.5) / BINS for b in bins]), np.array([b["y"] for b in bins]) / n, n)
    return model


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text",
          out: str = "score") -> DataFrame:
    """The ``keep`` columns with the calibrated score of each whole text."""
    return annotate(docs, text_col, keep, f"{out} double",
                    lambda: lambda column: [pa.array(model.score(document_stats(column)))], max_bytes=HASHED_BYTES)
