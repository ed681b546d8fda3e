"""Quality classifier: Naive Bayes support vectors.

Features are indicators of hashed n-grams: byte trigrams of the text, five-grams of its shape (letters by case, digits,
other signs, runs counted once) and pairs of words that repeat side by side or two apart. Class log-count ratios scale
the indicators; a linear hinge-loss model is then fitted on the scaled rows by dual coordinate descent.

The ratios come from all training rows: per-task counts are summed per feature, so what is gathered is bounded by
`FEATURES`. The linear model is fitted in one task on about `FIT_ROWS` of them, chosen by a hash of their ids (a
documented bound). Both together are the model, two arrays of `FEATURES` numbers, which is what workers get.

The score is a logistic curve of the margin, fitted on the same rows; 0.5 is where the curve separates the classes.

Defined cases: null and empty texts have no features and get the score of the bias; a label other than 0 or 1, or null,
is not learnt from; without both classes among the training rows every score is 0.5 and nothing is rejected; repeated
ids are scored row by row; labels of one id that disagree both count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlewick.llm.common import in_rows, mixed, packed_text, release, remainder, stored, table, text_bytes, unpacked

FEATURES = 1 << 20
FIT_ROWS = 8_000
EPOCHS = 12
COST = 1.0


def _shape_table() -> np.ndarray:
    table_ = np.arange(256, dtype=np.uint8)
    table_[ord("A") : ord("Z") + 1] = ord("A")
    table_[ord("a") : ord("z") + 1] = ord("a")
    table_[ord("0") : ord("9") + 1] = ord("0")
    table_[128:] = ord("a")
    return table_


_SHAPE = _shape_table()


def _grams(data: np.ndarray, n: int, kind: int) -> np.ndarray:
    if len(data) < n:
        return np.zeros(0, np.uint64)
    code = np.full(len(data) - n + 1, kind, np.uint64)
    for i in range(n):
        code = (code << np.uint64(8)) | data[i : len(data) - n + 1 + i]
    return code


def features(text: str | bytes | None) -> np.ndarray:
    """Distinct feature numbers of a whole text, ascending."""
    raw = text if isinstance(text, bytes) else text_bytes(text)
    data = np.frombuffer(raw, np.uint8)
    shape = _SHAPE[data]
    shape = shape[np.append(True, shape[1:] != shape[:-1])[: len(shape)]]
    words = raw.split()
    extra = []
    for gap in (1, 2):
        repeats = sum(map(bytes.__eq__, words, words[gap:]))
        if repeats:  # how often, in powers of four of the share of words
            extra.append((gap << 8) | int(np.log2(len(words) / repeats) // 2))
    codes = np.concatenate([_grams(data, 3, 1), _grams(shape, 5, 2), np.array(extra, np.uint64) | np.uint64(3 << 24)])
    return np.unique(mixed(np.unique(codes)) >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int32)


@dataclass
class Model:
    """Rows are indicators scaled by `ratio` and brought to length 1."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, at: np.ndarray) -> float:
        scaled = self.ratio[at]
        return self.bias + float(self.weights[at] @ scaled) / max(float(np.sqrt(scaled @ scaled)), 1e-12)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features(text)) + self.offset, -500, 500))))


def no_model() -> Model:
    return Model(np.zeros(FEATURES), np.zeros(FEATURES))


def labelled_features(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y, at) of the training rows, stored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "y", "packed"]):
            at = [features(unpacked(x)) for x in batch["packed"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "at": at})

    train = labels.select(F.col("doc_id"), F.col(label).alias("y")).where(F.col("y").isin(0, 1)).where(
        remainder(F.col("doc_id"), 3) != 1)
    kept = docs.where(remainder(F.col("doc_id"), 3) != 1).select("doc_id", packed_text("text").alias("packed"))
    # Labels grow with the documents: both sides are sorted at any size, none is broadcast.
    return stored(kept.join(train.hint("merge"), "doc_id").mapInPandas(run, "doc_id long, y int, at array<int>"), "quality-train")


def class_counts(train: DataFrame) -> np.ndarray:
    """How many rows of class 0 and 1 have each feature, over all training rows; row counts in the last column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, FEATURES + 1), np.int64)
        for batch in batches:
            for y, at in zip(batch["y"], batch["at"]):
                counts[y, at] += 1
                counts[y, FEATURES] += 1
        at = np.flatnonzero(counts.any(0))
        yield pd.DataFrame({"at": at, "n0": counts[0, at], "n1": counts[1, at]})

    summed = train.select("y", "at").mapInPandas(run, "at int, n0 long, n1 long").groupBy("at").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()  # at most FEATURES + 1 rows
    counts = np.zeros((2, FEATURES + 1))
    counts[:, summed["at"].to_numpy()] = summed["n0"].to_numpy(), summed["n1"].to_numpy()
    return counts


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, epochs: int, cost: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear hinge-loss model on unit rows of `scale`, by dual coordinate descent."""
    w, b = np.zeros(len(scale)), 0.0
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(3)
    length = [max(np.sqrt((scale[at] ** 2).sum()), 1e-12) for at in rows]
    square = np.array([((scale[at] / l) ** 2).sum() + 1 for at, l in zip(rows, length)])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i], scale[rows[i]] / length[i]
            gradient = y[i] * (w[at] @ v + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * v
                b += step
                alpha[i] = new
    return np.append(w, b)


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve 1 / (1 + exp(-(slope m + offset))), by Newton steps with a small penalty."""
    x, p = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        gradient = x.T @ (weight * (q - y)) + 1e-3 * p
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        p = p - np.linalg.solve(curve, gradient)
    return float(p[0]), float(p[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    rows = labelled_features(docs, labels, label)
    counts = class_counts(rows)
    n = counts[:, FEATURES]
    if not n.all():
        return no_model()
    smooth = counts[:, :FEATURES] + 1
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    share = min(1.0, fit_rows / n.sum())
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    # About `fit_rows` rows meet in one task; the limit only acts if many rows have one id.
    sample = rows.where(spread).select("doc_id", "y", "at").limit(fit_rows + fit_rows // 4)

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [row for batch in batches for row in zip(batch["doc_id"], batch["y"], batch["at"])]
        held.sort(key=lambda row: (row[0], row[1], row[2].tobytes()))  # the fit depends on the order: reruns agree
        model = fitted_model(ratio, [at for _, _, at in held], np.array([y for _, y, _ in held], np.int64) * 2 - 1)
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": model.bias, "slope": model.slope,
                            "offset": model.offset, "fitted": bool(model.ratio.any())})

    # The driver gets the fitted numbers, never the sample.
    out = sample.mapInPandas(fit, "weights binary, bias double, slope double, offset double, fitted boolean").toArrow()
    release(rows)
    found = out.to_pylist()
    if not any(row["fitted"] for row in found):
        return no_model()
    row = found[0]
    return Model(ratio, np.frombuffer(row["weights"]), row["bias"], row["slope"], row["offset"])


def fitted_model(ratio: np.ndarray, rows: list[np.ndarray], y: np.ndarray) -> Model:
    """The linear model on `rows` with labels -1 and 1; both classes weigh the same in all."""
    if len(set(y.tolist())) < 2:
        return no_model()
    cost = COST * np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    fitted = dual_descent(rows, y, ratio, EPOCHS, cost)
    model = Model(ratio, fitted[:-1], float(fitted[-1]))
    margin = np.array([model.margin(at) for at in rows])
    model.slope, model.offset = logistic_curve(margin, (y > 0).astype(float), np.ones(len(y)))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with a score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of FEATURES numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_rows(batches, ["doc_id", "text"], 4096):
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "score": [sent.value.score(text) for text in batch["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that score at least 0.5, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def keeps(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(text) >= 0.5 for text in texts], index=texts.index)

    return docs.where(keeps("text"))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
