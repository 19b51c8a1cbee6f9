"""A quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sedgemill.llm.docstats import FEATURES, features
from sedgemill.llm.textkit import Texts, held_out, map_texts

#: Most labelled rows a model is fitted on (in expectation: ids are taken by a hash threshold).
TRAINING_ROWS = 20_000


@dataclass
class Forest:
    """Complete trees of one depth as arrays: node ``k`` has children ``2k + 1`` and ``2k + 2``."""

    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.prior)
        flat, row = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (flat[row + feature[node]] > threshold[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        smooth: float = 1.0, least: float = 1.0) -> Forest:
    """Fit by logistic loss: histograms of gradients per bin, best split per node, one level at a time."""
    nodes, leaves = 2**depth - 1, 2**depth
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    prior = float(np.log(mean / (1 - mean)))
    empty = Forest(depth, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, leaves)), prior)
    if not len(y) or y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    margin = np.full(len(y), prior)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf)
        for level in range(depth):
            base, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            cut = np.zeros(width, dtype=np.int64)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (node - base) * bins + binned[f]
                g = np.bincount(cell, grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(cell, hess, width * bins).reshape(width, bins).cumsum(1)
                gl, hl, gt, ht = g[:, : len(e)], h[:, : len(e)], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                gain[(hl < least) | (ht - hl < least)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], cut[better] = top[better], at[better]
                feature[base:base + width][better] = f
                threshold[base:base + width][better] = e[at[better]]
            go = x[np.arange(len(y)), feature[node]] > threshold[node]
            node = 2 * node + 1 + go
        at = node - nodes
        leaf = -rate * np.bincount(at, grad, leaves) / (np.bincount(at, hess, leaves) + smooth)
        margin += leaf[at]
        made.append((feature, threshold, leaf))
    return Forest(depth, *(np.stack(c) for c in zip(*made, strict=True)), prior)


def _statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        x = features(texts)
        rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([part.column(0), rows], ["doc_id", "x"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return map_texts(rows, "_text", "doc_id long, x array<double>", work)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    rows: int = TRAINING_ROWS,
) -> Forest:
    """Fit on about ``rows`` labelled documents that are not held out, chosen by a hash of their id.

    A label that is null is none; of several labels of an id the smallest counts. Only the ids
    chosen (bounded by ``rows``) are broadcast, and only their statistics reach the driver.
    """
    ids = labels.where(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    n = ids.count()
    share = min(1.0, rows / n) if n else 1.0
    chosen = ids.where(F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(1 << 30)) < int(share * (1 << 30)))
    chosen = chosen.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(F.col(label).cast("int")).alias("y"))
    got = _statistics(docs.join(F.broadcast(chosen.select(F.col("doc_id").alias(doc_id))), doc_id, "left_semi"), doc_id, text)
    table = got.join(F.broadcast(chosen), "doc_id").select("doc_id", "x", "y").toPandas().sort_values("doc_id", kind="stable")
    if not len(table):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = np.stack(table["x"].to_numpy())
    order = np.lexsort((*x.T, table["doc_id"].to_numpy()))
    return fit(x[order], (table["y"].to_numpy() == 1)[order].astype(float))


def quality_scores(docs: DataFrame, forest: Forest, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; the score is the chance of label 1.

    Null and empty texts get the score of a text whose statistics are all 0. Every row is
    scored alone, so repeated rows and null ids make no difference (a null id is not held
    out). Without labels of both kinds all scores are the labelled share, 0.5 without any.
    Other columns are not read.
    """

    def work(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(forest.score(features(texts)))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    scored = map_texts(rows, "_text", "doc_id long, score double", work)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
