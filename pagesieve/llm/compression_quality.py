"""Quality classification by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is cut into blocks, each compressed with either dictionary on its
own, so that what the dictionary knows counts in every part of a long text. The
normalised difference ``(good - bad) / (good + bad)`` of the two sizes says which
text it is more like; a logistic curve, fitted on labelled texts that went into
neither dictionary, makes a probability of it.

Dictionaries and curve are fitted on a bounded sample of the labelled rows:
``rows_per_class`` documents of each class, in the order of a hash of their id,
and at most ``bytes_per_row`` characters of each, in pieces spread over the whole text. The
curve is set to the classes' shares among all labelled rows. Every text is scored
whole.

Cases: null or empty text: the share of good rows, as with no evidence. No
labelled rows, or only one class: every score is that share (0.5 without any).
Repeated label rows of a document count as often as they occur; null labels do
not count. Columns besides id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
BLOCK = 2048
DICTIONARY_BYTES = 64 * 1024
ROWS_PER_CLASS = 1000
BYTES_PER_ROW = 8 * 1024


@dataclass(frozen=True)
class Model:
    """Both dictionaries (empty: no evidence), the curve ``(bias, slope)`` and the share of good rows."""

    good: bytes
    bad: bytes
    bias: float
    slope: float
    share: float


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8")
    return [data[i: i + BLOCK] for i in range(0, len(data), BLOCK)]


class Difference:
    """Normalised difference of the two compressed sizes; one per task."""

    def __init__(self, good: bytes, bad: bytes):
        self._sides = []
        for raw in (good, bad):
            dictionary = zstandard.ZstdCompressionDict(raw)
            dictionary.precompute_compress(level=LEVEL)
            self._sides.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False,
                write_dict_id=False))

    def of(self, text: str | None) -> float:
        parts = blocks(text)
        good, bad = (sum(len(side.compress(p)) for p in parts) for side in self._sides)
        return (good - bad) / (good + bad) if parts else 0.0


def spread_piece(text: str, size: int) -> str:
    """At most ``size`` characters: sixteen stretches from all over the text."""
    if len(text) <= size:
        return text
    part, step = size // 16, len(text) / 16
    return "".join(text[int(k * step): int(k * step) + part] for k in range(16))


def fit_curve(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic regression with a small ridge; classes are weighted to ``share`` of good rows."""
    weight = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1))
    weight = weight * len(y)
    scale = float(np.abs(x).mean()) or 1.0
    design, beta = np.stack([np.ones_like(x), x / scale], axis=1), np.zeros(2)
    ridge = np.diag([1e-6, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge @ beta
        hessian = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1] / scale)


def fit(texts: Sequence[tuple[int, str]], share: float) -> Model:
    """From sampled ``(label, text)``: two of three rows make the dictionaries, the third the curve."""
    sides = {0: [], 1: []}
    for label, text in texts:
        sides[label].append(text)
    nothing = Model(b"", b"", math.log(max(share, 1e-6) / max(1 - share, 1e-6)), 0.0, share)
    if min(len(v) for v in sides.values()) < 3:
        return nothing
    made = {}
    for label, found in sides.items():
        pieces = [b for k, t in enumerate(found) if k % 3 for b in blocks(t)]
        size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 4)
        try:
            made[label] = zstandard.train_dictionary(size, pieces).as_bytes()
        except zstandard.ZstdError:  # too little text to find anything common: its own bytes serve
            made[label] = b"".join(pieces)[-DICTIONARY_BYTES:]
    if min(len(v) for v in made.values()) < 8:
        return nothing
    measure = Difference(made[1], made[0])
    kept = [(measure.of(t), label) for label, found in sides.items() for k, t in enumerate(found) if k % 3 == 0]
    x, y = np.array([a for a, _ in kept]), np.array([b for _, b in kept], np.float64)
    bias, slope = fit_curve(x, y, share)
    return Model(made[1], made[0], bias, slope, share)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS,
          bytes_per_row: int = BYTES_PER_ROW) -> Model:
    """``labels``: the labelled rows to learn from, all of which count for the classes' shares."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("cq_id"), F.col(label_col).cast("int").alias("cq_label"))
    counts = {r["cq_label"]: r["count"] for r in known.groupBy("cq_label").count().collect()}
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    present = docs.where(F.length(text_col) > 0).select(F.col(id_col).alias("cq_id")).distinct()
    there = known.join(present, "cq_id").withColumn("cq_hash", F.xxhash64("cq_id"))
    chosen = None
    for label in (0, 1):
        part = there.where(F.col("cq_label") == label).orderBy("cq_hash", "cq_id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = [(r["cq_id"], r["cq_label"]) for r in chosen.collect()]  # at most 2 * rows_per_class
    label_of = dict(ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([spread_piece(t, bytes_per_row) for t in batch.column(1).to_pylist()])],
                names=["cq_id", "cq_text"])

    small = docs.sparkSession.createDataFrame(ids or [(0, 0)], "cq_id long, cq_label int").select("cq_id").distinct()
    picked = docs.where(F.length(text_col) > 0).select(F.col(id_col).alias("cq_id"), F.col(text_col).alias("cq_text"))
    rows = picked.join(F.broadcast(small), "cq_id", "left_semi").mapInArrow(cut, "cq_id long, cq_text string")
    found = sorted((r["cq_id"], r["cq_text"]) for r in rows.limit(4 * rows_per_class).collect())
    order = {key: k for k, (key, _) in enumerate(ids)}
    found.sort(key=lambda x: (order.get(x[0], 0), x[1]))
    return fit([(label_of[key], text) for key, text in found if key in label_of], share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Difference(model.good, model.bad) if model.good else None
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                if not text or measure is None:
                    out.append(model.share)
                else:
                    odds = model.bias + model.slope * measure.of(text)
                    out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, odds)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(scored, f"`{id_col}` {id_type}, score double")
