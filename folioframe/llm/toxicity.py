"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.llm.toxicity_features import FEATURES, Featurizer, lexicon_terms
from folioframe.llm.words import byte_column
from folioframe.session import cut, discard

#: Most labelled rows that are learned from, and most terms of the lexicon.
TRAINING_ROWS, LEXICON_TERMS = 20_000, 4_000
#: Least number of toxic texts that hold a term, and least log odds ratio.
_LEAST_TEXTS, _LEAST_ODDS = 5, 2.0
_FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text divides by 5."""
    return F.crc32(doc_id.cast("string")) % _FOLDS == 0


class ToxicityModel:
    """A lexicon of weighted terms, boosted trees and their calibration; ``None`` where nothing was learned."""

    def __init__(
        self, weights: dict[str, float], trees: GBTClassificationModel | None, calibration: IsotonicRegressionModel | None,
    ):
        self.weights, self.trees, self.calibration = weights, trees, calibration

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``(doc_id, score, predicted)`` for every row; the text alone decides.

        The score is the calibrated probability of the toxic class, with a hundredth of the trees'
        own probability mixed in to order texts of one calibration step. A model without trees
        scores 0. A null text counts as empty and is scored as such.
        """
        source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        if self.trees is None:
            return source.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
        judged = self.trees.transform(_assembled(_features(source, ["doc_id"], self.weights)))
        judged = judged.select("doc_id", vector_to_array("probability")[1].alias("raw"))
        if self.calibration is None:
            score = F.col("raw")
        else:
            judged = self.calibration.transform(judged)
            score = F.lit(0.99) * F.col("calibrated") + F.lit(0.01) * F.col("raw")
        bounded = judged.withColumn("score", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))
        return bounded.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, trees: int = 24, depth: int = 4,
    doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicityModel:
    """Learn from labelled rows that are not held out, at most ``max_rows`` of them.

    The sample are the rows of smallest id hash. Two fifths of it give the lexicon: terms (words and
    word beginnings, disguises undone) that far more toxic texts hold than others, with their
    log odds. Two fifths, unseen by the lexicon, train the trees on the dense features, and the
    last fifth calibrates them. Labels serve as labels only; language, source and id are no
    inputs. Rows without id or label are left out; of several labels of an id the largest counts.
    """
    given = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("double").alias("label"))
        .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")).where("label IS NOT NULL")
    )
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    # bounded by max_rows, so the texts needn't be shuffled to meet their labels
    sample, sample_path = cut(source.join(F.broadcast(chosen), "doc_id"), "labelled")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5))

    weights = _lexicon(sample.where(part < 2))
    featured, feature_path = cut(
        _features(sample.select("label", part.alias("part"), "text"), ["label", "part"], weights).repartition(12), "features"
    )
    learning, calibrating = featured.where((F.col("part") >= 2) & (F.col("part") < 4)), featured.where("part = 4")
    model = ToxicityModel(weights, None, None)
    if learning.select("label").distinct().count() == 2:
        boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7, maxMemoryInMB=128)
        model.trees = boosted.fit(_assembled(learning))
        if calibrating.select("label").distinct().count() == 2:
            judged = model.trees.transform(_assembled(calibrating)).select("label", vector_to_array("probability")[1].alias("raw"))
            model.calibration = IsotonicRegression(featuresCol="raw", predictionCol="calibrated").fit(judged)
    discard(docs.sparkSession, sample_path, feature_path)
    return model


def _lexicon(sample: DataFrame) -> dict[str, float]:
    """Log odds ratios of the terms that mark toxic texts; at most ``LEXICON_TERMS`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, data in zip(batch.column("label").to_pylist(), byte_column(batch, "text"), strict=True):
                terms = sorted(lexicon_terms(data.decode("utf-8", "replace")))
                yield pa.RecordBatch.from_arrays([
                    pa.array(terms, pa.string()), pa.array([label] * len(terms), pa.float64())
                ], names=["term", "label"])

    totals = sample.agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = totals["toxic"] or 0.0, (totals["n"] or 0) - (totals["toxic"] or 0.0)
    counts = sample.select("label", "text").mapInArrow(run, "term string, label double").groupBy("term").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")
    )
    odds = F.log(((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1)))
    best = counts.where(F.col("a") >= _LEAST_TEXTS).select("term", "a", odds.alias("odds")).where(F.col("odds") >= _LEAST_ODDS)
    rows = best.orderBy(F.desc(F.col("odds") * F.log1p("a")), "term").limit(LEXICON_TERMS).collect()
    return {row["term"]: row["odds"] for row in rows}


def _features(rows: DataFrame, keys: list[str], weights: dict[str, float]) -> DataFrame:
    """The keys and the features of every row with a ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(weights)
        for batch in batches:
            table = [featurize(data.decode("utf-8", "replace")) for data in byte_column(batch, "text")]
            columns = list(zip(*table, strict=True)) if table else [[] for _ in FEATURES]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key) for key in keys] + [pa.array(column, pa.float64()) for column in columns],
                names=[*keys, *FEATURES],
            )

    types = ", ".join(f"{key} {rows.schema[key].dataType.simpleString()}" for key in keys)
    return rows.select(*keys, "text").mapInArrow(run, f"{types}, " + ", ".join(f"{name} double" for name in FEATURES))


def _assembled(featured: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured).drop(*FEATURES)
