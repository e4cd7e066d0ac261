"""Model operators on Spark ML.

Everything is a ``pyspark.ml`` Pipeline, so fitting is distributed, the
vectorizer is saved together with the classifier (no vectorizer/classifier
mismatch), and the fitted PipelineModel scores tables and streams alike.
Text features use the exact vocabulary and smoothed idf of the relational
TF-IDF operator (``CountVectorizerModel.from_vocabulary`` +
``ElementwiseProduct`` + ``Normalizer``); raw term counts replace the
sublinear tf there, because no Spark ML stage applies ``1 + ln(tf)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (LinearSVC, LogisticRegression, NaiveBayes, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import (PCA, CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer,
                                StandardScaler, StopWordsRemover, VectorAssembler, Word2Vec)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.functions import text as T
from cribble.operators import cluster
from cribble.operators.vectorize import Vocab

# ------------------------------------------------------------------ grids (reference defaults)


@dataclass
class Grids:
    """Hyper-parameter grids of the published model search."""
    # -- fixed values: the published grids.
    logreg_c: Sequence[float] = (0.1, 1.0, 10.0)
    rf_trees: Sequence[int] = (100, 200)
    rf_depth: Sequence[int | None] = (None, 10, 20)
    rf_min_split: Sequence[int] = (2, 5)
    gbt_iter: Sequence[int] = (100, 200)
    gbt_step: Sequence[float] = (0.05, 0.1)
    gbt_depth: Sequence[int] = (3, 5)
    svc_c: Sequence[float] = (0.1, 1.0, 10.0)
    svc_features: int = 100                         # random Fourier features of the rbf kernel
    reg_rf_depth: Sequence[int | None] = (None, 10)
    ridge_alpha: Sequence[float] = (0.1, 1.0, 10.0, 100.0)
    cv_folds: int = 5
    extra: dict = field(default_factory=dict)


# ------------------------------------------------------------------ feature stages

def text_stages(text_col: str, vocab: Vocab, out: str = "text_features", weighted: bool = True) -> list:
    """Cleaning -> n-grams -> exact vocabulary counts -> smoothed idf -> L2 (N1, N6-N9); without
    ``weighted`` the counts themselves."""
    raw, sw, vt, ng, tf, ti = (f"__{out}_{s}" for s in ("raw", "sw", "vt", "ng", "tf", "ti"))
    s1 = SQLTransformer(statement=(
        f"SELECT *, filter(split(regexp_replace(regexp_replace(lower(coalesce({text_col}, '')), r'{T.UNIT_RE}', '$1$2'), "
        f"r'{T.PUNCT_RE}', ' '), r'{T.SPLIT_RE}'), t -> length(t) > 0) AS {raw} FROM __THIS__"))
    s2 = StopWordsRemover(inputCol=raw, outputCol=sw, stopWords=T.STOPWORDS, caseSensitive=True)
    s3 = SQLTransformer(statement=(
        f"SELECT *, regexp_extract_all(lower(array_join(filter({sw}, t -> length(t) > 2 OR t rlike r'{T.ISDIGIT_RE}'), ' ')), "
        f"r'{T.VECTOR_TOKEN_RE}', 0) AS {vt} FROM __THIS__"))
    s4 = SQLTransformer(statement=(
        f"SELECT *, concat({vt}, zip_with(slice({vt}, 1, greatest(size({vt}) - 1, 0)), "
        f"slice({vt}, 2, greatest(size({vt}) - 1, 0)), (a, b) -> concat_ws(' ', a, b))) AS {ng} FROM __THIS__"))
    s5 = CountVectorizerModel.from_vocabulary(list(vocab.terms), inputCol=ng, outputCol=tf)
    if not weighted:
        s5 = CountVectorizerModel.from_vocabulary(list(vocab.terms), inputCol=ng, outputCol=out)
        return [s1, s2, s3, s4, s5, SQLTransformer(statement=f"SELECT * EXCEPT ({raw}, {sw}, {vt}, {ng}) FROM __THIS__")]
    s6 = ElementwiseProduct(scalingVec=Vectors.dense([vocab.idf(t) for t in vocab.terms]), inputCol=tf, outputCol=ti)
    s7 = Normalizer(p=2.0, inputCol=ti, outputCol=out)
    drop = SQLTransformer(statement=f"SELECT * EXCEPT ({raw}, {sw}, {vt}, {ng}, {tf}, {ti}) FROM __THIS__")
    return [s1, s2, s3, s4, s5, s6, s7, drop]


def vector_from_array(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


# ------------------------------------------------------------------ estimators

def logreg(c: float, n_rows: int, max_iter: int = 500, **kw) -> LogisticRegression:
    """C-parameterised logistic regression: regParam = 1 / (C * n), no internal standardisation (M2)."""
    return LogisticRegression(regParam=1.0 / (c * max(n_rows, 1)), elasticNetParam=0.0, standardization=False,
                              maxIter=max_iter, family="auto", **kw)


def scale_stage(scales: dict, suffix: str = "") -> SQLTransformer:
    """Fitted population-std scaling as a savable pipeline stage (E5 inside the model)."""
    exprs = ", ".join(f"({c} - {s.mean!r}) / {s.std!r} AS {c}{suffix}" for c, s in scales.items())
    keep = ", ".join(f"`{c}`" for c in scales) if not suffix else ""
    body = f"SELECT * EXCEPT ({keep}), {exprs} FROM __THIS__" if keep else f"SELECT *, {exprs} FROM __THIS__"
    return SQLTransformer(statement=body)


def rf_classifier(trees: int = 100, depth: int = 10, min_split: int = 2, seed: int = 42, **kw):
    """Random forest; min samples per split maps to minInstancesPerNode = ceil(min_split / 2) (M3)."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=max(1, (min_split + 1) // 2),
                                  seed=seed, **kw)


def linear_svc_ovr(c: float = 1.0, n_rows: int = 1, max_iter: int = 2000, parallelism: int = 8,
                   **kw) -> OneVsRest:
    """Linear SVM, one-vs-rest for multiclass (M6); regParam = 1 / (C * n); the tolerance ends the fit."""
    return OneVsRest(classifier=LinearSVC(regParam=1.0 / (c * max(n_rows, 1)), maxIter=max_iter),
                     parallelism=parallelism, **kw)


def naive_bayes(**kw) -> NaiveBayes:
    """Multinomial naive Bayes, alpha = 1 (M7; Spark also smooths the prior, see closed form)."""
    return NaiveBayes(smoothing=1.0, modelType="multinomial", **kw)


def ridge(alpha: float, n_rows: int, y_std: float, **kw) -> LinearRegression:
    """Ridge with sklearn's alpha: regParam = alpha * sigma_y / n, normal equations (M8)."""
    return LinearRegression(regParam=alpha * y_std / max(n_rows, 1), elasticNetParam=0.0, solver="normal",
                            standardization=False, **kw)


def fold_sums(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, tuple]:
    """Per fold number of rows, sums and products of features and label about their means: two aggregations, whatever the
    number of penalties and folds tried on them."""
    cols = [*features, label]
    mean = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    z = [F.col(c) - F.lit(mean[i]) for i, c in enumerate(cols)]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    got = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(z)],
                               *[F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    out = {}
    for r in got:
        p = np.zeros((len(z), len(z)))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[r[fold]] = (r["n"], np.array([r[f"s{i}"] for i in range(len(z))]), p)
    return out


def ridge_search(df: DataFrame, features: Sequence[str], label: str, fold: str, alphas: Sequence[float]) -> dict[float, float]:
    """Mean R2 of every penalty over the folds, each predicted by the ridge fit on the others (M8)."""
    sums = fold_sums(df, features, label, fold)
    n_all, s_all, p_all = (sum(x[i] for x in sums.values()) for i in range(3))
    scores: dict[float, list[float]] = {a: [] for a in alphas}
    for n, s, p in sums.values():
        m = n_all - n
        if not m:
            continue
        at = (s_all - s) / m
        c = (p_all - p) - m * np.outer(at, at)
        spread = p[-1, -1] - s[-1] ** 2 / n
        for a in alphas:
            b = np.linalg.solve(c[:-1, :-1] + a * np.eye(len(at) - 1), c[:-1, -1])
            # the error is y - x b - b0: its sums follow from those of the fold
            v, b0 = np.append(-b, 1.0), at[-1] - b @ at[:-1]
            error = v @ p @ v - 2 * b0 * (v @ s) + n * b0 ** 2
            scores[a].append(1 - error / spread if spread > 0 else float(error <= 0))
    return {a: float(np.mean(v)) if v else float("nan") for a, v in scores.items()}


def rf_regressor(trees: int = 100, depth: int = 10, seed: int = 42, **kw):
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, **kw)


def gbt_regressor(iters: int = 100, step: float = 0.1, depth: int = 5, seed: int = 42, **kw):
    return GBTRegressor(maxIter=iters, stepSize=step, maxDepth=depth, seed=seed, **kw)


# ------------------------------------------------------------------ search, scoring, metrics

def evaluate(pred: DataFrame, label: str = "label") -> dict:
    acc = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(pred)
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="f1").evaluate(pred)
    return {"accuracy": acc, "f1_weighted": f1}


def confidence(pred: DataFrame, prob: str = "probability") -> DataFrame:
    """Max class probability (A24) and the class probabilities sorted ascending."""
    arr = vector_to_array(F.col(prob))
    return pred.withColumn("confidence", F.array_max(arr)).withColumn("proba_sorted", F.array_sort(arr))


def kmeans_sweep(df: DataFrame, features: str, k_min: int = 2, k_max: int = 10, restarts: int = 10,
                 seed: int = 42) -> DataFrame:
    """K = k_min..k_max, best of ``restarts`` seeds by training cost, silhouette (squared
    Euclidean, Spark's linear-time form) per K (M16, A21 fast, A22).

    Every run starts from Spark ML's k-means|| centres of its seed; the iterations of all runs share their passes over the rows."""
    from concurrent.futures import ThreadPoolExecutor

    ev = ClusteringEvaluator(featuresCol=features, metricName="silhouette", distanceMeasure="squaredEuclidean")
    data = df.select(features).persist()
    data.count()

    def start(args):
        k, r = args
        est = KMeans(k=k, seed=seed + r, featuresCol=features, initMode="k-means||", maxIter=0, solver="row")
        return np.array(est.fit(data).clusterCenters())

    # independent starts are submitted concurrently; Spark schedules their jobs side by side
    runs = [(k, r) for k in range(k_min, k_max + 1) for r in range(restarts)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        starts = list(pool.map(start, runs))
    vectors = data.select(vector_to_array(features).alias("x"))
    blocks = cluster.packed_vectors(vectors, "x")
    fits = cluster.lloyd(blocks, starts)
    blocks.unpersist()
    best = {k: min((i for i, run in enumerate(runs) if run[0] == k), key=lambda i: (fits[i][1], i)) for k in range(k_min, k_max + 1)}
    labelled = cluster.assign_all(data.withColumn("x", vector_to_array(features)), "x", [fits[i][0] for i in best.values()],
                                  "nearest").drop("x").persist()
    rows = [(k, float(fits[i][1]), float(ev.evaluate(labelled.withColumn("prediction", F.col("nearest")[at]))))
            for at, (k, i) in enumerate(best.items())]
    labelled.unpersist()
    data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def pca_2d(df: DataFrame, features: str, k: int = 2):
    """PCA on centred features (Spark's PCA projects un-centred rows); returns the model,
    the projection and the explained variance percentage (M17, A23)."""
    centred = StandardScaler(inputCol=features, outputCol="__centred", withMean=True, withStd=False).fit(df)
    c = centred.transform(df)
    model = PCA(k=k, inputCol="__centred", outputCol="pca").fit(c)
    proj = model.transform(c).drop("__centred")
    proj = proj.withColumn("__p", vector_to_array("pca")).select(
        "*", F.col("__p")[0].alias("PC1"), F.col("__p")[1].alias("PC2")).drop("__p")
    return model, proj, float(sum(model.explainedVariance)) * 100.0


def token_partitions(df: DataFrame, tokens_col: str, tokens_per_partition: int = 200_000) -> int:
    """Partitions of a Word2Vec fit, from the tokens alone: no setting of the session changes the vectors."""
    n = df.agg(F.sum(F.greatest(F.size(tokens_col), F.lit(0)).cast("long"))).first()[0] or 0
    return max(1, -(-n // tokens_per_partition))


def word2vec(tokens_col: str, partitions: int, out: str = "w2v", seed: int = 42) -> Word2Vec:
    """100-d, window 5, min count 2, 15 epochs."""
    return Word2Vec(vectorSize=100, windowSize=5, minCount=2, maxIter=15, seed=seed, inputCol=tokens_col,
                    outputCol=out, numPartitions=partitions)


def mean_pool(df: DataFrame, id_col: str, tokens_col: str, vectors: DataFrame, dim: int) -> DataFrame:
    """Mean of the vectors of in-vocabulary tokens only; zeros when none.

    ``vectors`` is ``(word, vector)`` as returned by ``Word2VecModel.getVectors()``.
    Tokens are exploded and joined to the vector table (shuffle join: the
    table grows with the vocabulary), then averaged per document.
    """
    toks = df.select(id_col, F.explode_outer(tokens_col).alias("word"))
    pooled = (toks.join(vectors.select("word", "vector"), "word", "inner").groupBy(id_col)
              .agg(vector_to_array(Summarizer.mean(F.col("vector"))).alias("pooled")))
    zeros = F.array_repeat(F.lit(0.0), dim)
    return (df.select(id_col).join(pooled, id_col, "left")
            .select(id_col, F.coalesce("pooled", zeros).alias("pooled")))


def _grams_of_length(w: F.Column, n: int) -> F.Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1)))
    return F.filter(F.transform(starts, lambda i: F.substring(w, i, n)), lambda s: F.length(s) == n)


def char_ngrams(word: F.Column, n_min: int = 3, n_max: int = 6) -> F.Column:
    """Character n-grams of '<word>' for n in [n_min, n_max], shorter n first (FastText subwords, N11)."""
    w = F.concat(F.lit("<"), word, F.lit(">"))
    return F.flatten(F.array(*[_grams_of_length(w, n) for n in range(n_min, n_max + 1)]))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
