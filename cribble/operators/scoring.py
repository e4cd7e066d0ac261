"""Two-headed scoring: class with confidence and price from one saved pipeline.

The heads are linear: a softmax over class scores, and a price that sees the features and the predicted class.  They are
compiled into SQL stages of a ``PipelineModel``, so one artifact holds encoding, features and both heads, is saved and
loaded like any other, and scores tables and streams by expressions alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESPONSE = ["categorie", "categorie_id", "confiance", "probabilites", "prix_estime", "pipeline"]


@dataclass
class Heads:
    """Weights of both heads over ``features`` (the raw columns, then source code and density)."""
    columns: Sequence[str]
    sources: Sequence[str]        # code = place; any other value scores as code 0
    labels: Sequence[str]
    class_weights: list[list[float]]
    class_bias: list[float]
    price_weights: list[float]    # of the features, then of the predicted class id
    price_bias: float
    ratio: tuple[str, str] = ("poids", "volume")
    source: str = "source"

    @property
    def features(self) -> list[str]:
        return [*self.columns, "src_code", "density"]


def _text(v: str) -> str:
    quoted = v.replace(chr(92), chr(92) * 2).replace("'", chr(92) + "'")
    return f"'{quoted}'"


def linear_sql(weights: Sequence[float], bias: float, names: Sequence[str]) -> str:
    return " + ".join([f"CAST({bias!r} AS DOUBLE)", *[f"CAST({w!r} AS DOUBLE) * {n}" for w, n in zip(weights, names)]])


def pipeline(h: Heads) -> PipelineModel:
    """The saved form: features, class scores, probabilities, response."""
    codes = " ".join(f"WHEN {_text(s)} THEN {i}" for i, s in enumerate(h.sources))
    scores = ", ".join(linear_sql(w, b, h.features) for w, b in zip(h.class_weights, h.class_bias))
    names = ", ".join(_text(v) for v in h.labels)
    steps = [
        f"SELECT *, CASE {h.source} {codes} ELSE 0 END AS src_code, {h.ratio[0]} / ({h.ratio[1]} + 1e-6) AS density FROM __THIS__",
        f"SELECT *, array({scores}) AS class_scores FROM __THIS__",
        "SELECT *, transform(class_scores, z -> exp(z - array_max(class_scores))) AS class_odds FROM __THIS__",
        "SELECT *, transform(class_odds, e -> e / aggregate(class_odds, 0D, (a, x) -> a + x)) AS class_p, "
        "CAST(array_position(class_scores, array_max(class_scores)) - 1 AS INT) AS categorie_id FROM __THIS__",
        f"SELECT *, element_at(array({names}), categorie_id + 1) AS categorie, array_max(class_p) AS confiance, "
        f"array_sort(class_p) AS probabilites, {linear_sql(h.price_weights, h.price_bias, [*h.features, 'categorie_id'])} "
        "AS prix_estime, 'numeric' AS pipeline FROM __THIS__",
        "SELECT * EXCEPT (src_code, density, class_scores, class_odds, class_p) FROM __THIS__"]
    return PipelineModel(stages=[SQLTransformer(statement=s) for s in steps])


def fit_heads(df: DataFrame, columns: Sequence[str], label: str, price: str, source: str = "source",
              ratio: tuple[str, str] = ("poids", "volume"), max_codes: int = 10_000) -> Heads:
    """Fit both heads on rows whose columns, label and price are known.

    Codes are places in the sorted values; more than ``max_codes`` sources or labels raise.
    """
    # held before the codes are looked up; the classifier keeps its own blocks of the features
    rows = df.where(" AND ".join(f"{c} IS NOT NULL" for c in (*columns, label, price))).select(
        *dict.fromkeys((*columns, source, label, price))).persist()

    def values(c: str) -> list[str]:
        got = sorted(r[0] for r in rows.where(F.col(c).isNotNull()).select(c).distinct().limit(max_codes + 1).collect())
        if len(got) > max_codes:
            raise ValueError(f"{c} has more than {max_codes} values")
        return got

    sources, labels = values(source), values(label)
    empty = Heads(columns, sources, labels, [[0.0] * (len(columns) + 2)] * len(labels), [0.0] * len(labels),
                  [0.0] * (len(columns) + 3), 0.0, ratio, source)
    if not labels:
        raise ValueError("no row has a label, a price and all columns")
    known = pipeline(empty).stages[0].transform(rows).withColumn(
        "y", F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)).cast("double") - 1)
    x = VectorAssembler(inputCols=empty.features, outputCol="x").transform(known)
    if len(labels) > 1:
        m = LogisticRegression(featuresCol="x", labelCol="y", maxIter=500, family="multinomial").fit(x)
        empty.class_weights = [list(map(float, r)) for r in m.coefficientMatrix.toArray()]
        empty.class_bias = list(map(float, m.interceptVector.toArray()))
    # the price sees the predicted class, as it will when scoring
    scored = pipeline(empty).transform(x.drop("src_code", "density", "y", "x")).select(
        *columns, source, price, F.col("categorie_id").cast("double").alias("k"))
    scored = pipeline(empty).stages[0].transform(scored)
    r = LinearRegression(featuresCol="z", labelCol=price, solver="normal").fit(
        VectorAssembler(inputCols=[*empty.features, "k"], outputCol="z").transform(scored))
    empty.price_weights, empty.price_bias = list(map(float, r.coefficients.toArray())), float(r.intercept)
    rows.unpersist()
    return empty


def respond(batch: DataFrame, scorer: PipelineModel, columns: Sequence[str], key: str = "item_id") -> DataFrame:
    """key, response and valid of every request, in one pass over the batch; incomplete requests are not valid and
    have no response."""
    ok = F.expr(" AND ".join(f"{c} IS NOT NULL" for c in columns))
    # a request is scored whole or not at all
    asked = batch.withColumn("valid", ok).withColumns({c: F.when(F.col("valid"), F.col(c)) for c in columns})
    return scorer.transform(asked).select(key, *[F.when(F.col("valid"), F.col(c)).alias(c) for c in RESPONSE], "valid")
