"""Quality classifier learned from trusted positives and unlabelled text.

Method: positive-unlabelled learning with the non-negative risk. With p the class prior,
P positives, U unlabelled documents and l the logistic loss, the fit minimises

    p * mean_P l(+) + max(0, mean_U l(-) - p * mean_P l(-)),

and where the second part falls below zero it is raised again before the fit goes on.
The prior is estimated first: a plain P against U model scores every training document,
and the least ratio of the shares of U and P above a score bounds the share of
positives in U (each half of the rows is scored by a model of the other). These shares are counted over all training rows; only the fits
themselves take a sample of at most ``FIT_ROWS`` rows of P and of U each.

A document is described by the shape of its whole text (bytes by kind, word lengths,
repeats); labels, language, source and ids are no inputs. Labels of 0 are never used.

Defined results: text null or empty: scored from all-zero measures. Several labels of one
document: the highest counts; a null label is none. doc_id null: held out, never learned
from. Without a positive or an unlabelled training document every score is 0.5. Rows are
kept as they are, repeated ones too; an empty table gives no rows. Other columns,
whatever their names, are not read (``keep_good`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, query, sliced, stored, table

#: Most rows that a fit takes of the positives, and of the unlabelled.
FIT_ROWS = 20_000
STEPS = 400
RATE = 0.05
RIDGE = 1e-2
BINS = 1000
#: A document is rejected below this score.
THRESHOLD = 0.3

#: Kinds of bytes whose shares of a text are measured.
KINDS = (
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100)),
    b"0123456789",
    b" \t\r\f\v",
    b"\n",
    b".,;:",
    b"!",
    b"?",
    b"'\"-()",
    b"#$%&*<>@^~=+\\/_`[]{}",
    b"|",
    bytes(range(9)) + bytes(range(14, 32)),
)
KIND_OF = np.zeros((256, len(KINDS)))
for _k, _bytes in enumerate(KINDS):
    KIND_OF[list(_bytes), _k] = 1.0


def measures(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text."""
    words = Words(column, lower=False)
    length = (words.end - words.start).astype(np.float64)
    hashes = words.hashes()
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    closes = np.zeros(256, dtype=bool)
    closes[list(b".,;:!?")] = True
    closed = closes[words.data[words.end - 1]]
    out = np.zeros((len(column), len(KINDS) + 10))
    for k in range(len(column)):
        a, b = words.bounds[k], words.bounds[k + 1]
        if a == b:
            continue
        counts = np.bincount(words.data[a:b], minlength=256) / (b - a)
        seen = counts[counts > 0]
        row = [*np.sqrt(counts @ KIND_OF), np.log1p(b - a), -(seen * np.log(seen)).sum(), np.sqrt(counts.max())]
        i, j = words.first[k], words.first[k + 1]
        if i < j:
            n = j - i
            distinct = len(np.unique(hashes[i:j]))
            of = length[i:j]
            row += [
                np.log1p(of.mean()),
                np.log1p(of.std()),
                np.sqrt((of >= 15).mean()),
                np.sqrt(same[i + 1 : j].sum() / n),
                np.log(distinct) / np.log(n + 1),
                distinct / n,
                np.sqrt(closed[i:j].mean()),
            ]
        out[k, : len(row)] = row
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text"):
            rows = measures(part.column(part.schema.get_field_index("text"))).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), pa.array(list(rows), pa.list_(pa.float32()))],
                names=["doc_id", "measures"],
            )


@dataclass
class Model:
    """Logistic model on how far each measure is above and below its mean; weights None: constant 0.5."""

    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.centre) / self.scale, -6, 6)
        return np.hstack([np.maximum(x, 0), np.maximum(-x, 0), np.ones((len(x), 1))])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), 0.5)
        return _sigmoid(self.inputs(rows) @ self.weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Model:
    """Non-negative risk with a prior; without one, plain positives against unlabelled."""
    both = np.vstack([positive, unlabelled])
    model = Model(both.mean(axis=0), both.std(axis=0) + 1e-3)
    p, u = model.inputs(positive), model.inputs(unlabelled)
    w = np.zeros(p.shape[1])
    mean, spread = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        s_p, s_u = _sigmoid(p @ w), _sigmoid(u @ w)
        up = p.T @ (s_p - 1) / len(p)  # of mean_P l(+)
        down = u.T @ s_u / len(u)  # of mean_U l(-)
        if prior is None:
            slope = (up + down) / 2
        else:
            negative = -np.log1p(-s_u + 1e-12).mean() + prior * np.log1p(-s_p + 1e-12).mean()
            down = down - prior * (p.T @ s_p) / len(p)
            slope = prior * up + down if negative >= 0 else -down
        slope = slope + RIDGE * w
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        w = w - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    model.weights = w
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from counts by score bin."""
    above_p = np.cumsum(positive[::-1]) / max(1, positive.sum())
    above_u = np.cumsum(unlabelled[::-1]) / max(1, unlabelled.sum())
    # Deviation that counts of this size leave open, so that thin tails do not decide.
    slack = np.sqrt(np.log(40) / 2 / max(1, positive.sum())) + np.sqrt(np.log(40) / 2 / max(1, unlabelled.sum()))
    wide = above_p >= 0.1
    bound = ((above_u + slack) / np.maximum(above_p, 1e-9))[wide]
    best = int(np.argmin(bound))
    return float(np.clip((above_u / np.maximum(above_p, 1e-9))[wide][best], 0.01, 0.99))


def remainder(doc_id: str = "doc_id", folds: int = 5) -> F.Column:
    """crc32 of the id as text, modulo the folds; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def _with_scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.scores(rows), pa.float64()), *batch.columns[2:]],
                    names=["doc_id", "score", *batch.schema.names[2:]],
                )

    return run


def learn(measured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[Model, float | None]:
    """Model and class prior from all rows of ``measured`` (doc_id, measures) outside the held-out fold."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("best"), F.lit(True).alias("labelled"))
    training = stored(
        measured.where(remainder() != 0)
        .join(known, "doc_id", "left")
        .select(
            "doc_id", "measures", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"),
            F.when(F.col("best") == 1, 1).when(F.col("best").isNull(), 0).alias("positive"),
        )
        .where("positive is not null")
    )
    counts = {r["positive"]: r["count"] for r in training.groupBy("positive").count().collect()}
    if not counts.get(1) or not counts.get(0):
        return Model(), None
    # At most ``fit_rows`` of each kind in expectation, chosen by a hash of the id.
    share = F.when(F.col("positive") == 1, F.lit(fit_rows / counts[1])).otherwise(F.lit(fit_rows / counts[0]))
    chosen = training.where(F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    chosen = chosen.select("positive", "half", "measures")
    sample = chosen.toPandas()
    rows = np.array(sample["measures"].tolist(), np.float64)
    is_positive = sample["positive"].to_numpy() == 1
    positive, unlabelled = rows[is_positive], rows[~is_positive]
    if not len(positive) or not len(unlabelled):
        return Model(), None
    # Each half of the rows is scored by the model of the other half.
    held = np.zeros((2, BINS))
    for half in (0, 1):
        learned = [x[sample["half"].to_numpy()[is_positive == kind] != half] for x, kind in ((positive, True), (unlabelled, False))]
        if not len(learned[0]) or not len(learned[1]):
            return Model(), None
        scored = training.where(F.col("half") == half).select(F.col("positive").cast("long").alias("doc_id"), "measures")
        scored = scored.mapInArrow(_with_scores(fit(*learned, None)), "doc_id long, score double")
        bins = scored.groupBy("doc_id", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin")).count()
        for r in bins.collect():
            held[r["doc_id"], r["bin"]] += r["count"]
    prior = class_prior(held[1], held[0])
    return fit(positive, unlabelled, prior), prior


def measured_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text").mapInArrow(_measured, "doc_id long, measures array<float>")


@query("op2_pu_quality")
def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(measured_documents(table(spark, sf_dir, "documents")))
    model, _ = learn(measured, table(spark, sf_dir, "labels"))
    return measured.mapInArrow(_with_scores(model), "doc_id long, score double").select(
        "doc_id", (remainder() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


# --- stage of the pipeline -----------------------------------------------------------------


def _good_rows(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                rows = measures(part.column(part.schema.get_field_index("text")))
                yield part.filter(pa.array(model.scores(rows.astype(np.float32).astype(np.float64)) >= threshold))

    return run


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of ``docs`` that the model, learned from these same documents, does not reject."""
    model, _ = learn(measured_documents(docs), table(spark, sf_dir, "labels"))
    return docs.mapInArrow(_good_rows(model, THRESHOLD), docs.schema)
