"""Registered model queries.  Fitted estimators cannot be
recomputed in SQL, so most keys are rows-only checks with invariants in the
tests; the closed-form ones (naive Bayes, 2-feature ridge, linear attribution,
subword n-grams, hybrid decision) carry a DuckDB twin.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cribble.functions import text as T
from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import joint, linear, prep, search, subword, trees
from cribble.operators import models as ML
from cribble.operators import vectorize as V
from cribble.plans.registry import register
from cribble.sources import catalog
from cribble.sources.io import scratch_path

# ---------------------------------------------------------------- data


def emb_splits(spark, sf):
    e = catalog.table(spark, sf, "embeddings")
    e = ML.vector_from_array(e, "embedding", "features").withColumn("y", F.col("label").cast("double"))
    s = prep.stratified_split(e, "label", "vec_id").persist(StorageLevel.MEMORY_AND_DISK)
    return catalog.right_size(s, s.count())


def _fit_predict(spark, sf, est, name):
    s = emb_splits(spark, sf)
    train, test = s.where(F.col("split") != "test"), s.where(F.col("split") == "test")
    model = Pipeline(stages=[est]).fit(train)
    pred = model.transform(test)
    cols = ["vec_id", "y", "prediction"]
    if "probability" in pred.columns:
        pred = ML.confidence(pred)
        cols.append(rnd("confidence", 6).alias("confidence"))
    else:
        cols.append(F.lit(None).cast("double").alias("confidence"))
    return pred.select(*cols).withColumn("model", F.lit(name))


def _n_train(spark, sf):
    return emb_splits(spark, sf).where(F.col("split") != "test").count()


@register("logreg", ops=("M2", "A24", "L5"))
def q_logreg(spark, sf):
    n = _n_train(spark, sf)
    return _fit_predict(spark, sf, ML.logreg(10.0, n, featuresCol="features", labelCol="y"), "logreg")


@register("rf_classifier", ops=("M3",))
def q_rf(spark, sf):
    return _fit_predict(spark, sf, ML.rf_classifier(100, 10, 2, featuresCol="features", labelCol="y"), "rf")


@register("gbt_ovr", ops=("M4", "A24"))
def q_gbt(spark, sf):
    """Softmax boosting of all classes in joint rounds: 200 rounds of depth 5."""
    d = _emb_design(emb_splits(spark, sf).withColumn("fold", F.when(F.col("split") != "test", 0)))
    model = trees.fit_boosting(d, [trees.Boosting(200, 0.1, 5)])[0]
    pred = joint.score(d, [0], lambda block, m: model.scores(block.x), lambda block, m: block.fold == -1)
    return pred.select(F.col("id").alias("vec_id"), "y", "prediction", rnd(F.array_max("scores"), 6).alias("confidence"),
                       F.lit("gbt_ovr").alias("model"))


def _emb_design(splits):
    return joint.design(splits, "vec_id", "features", "y", "fold", models=100)


@register("linear_svc", ops=("M6",))
def q_linear_svc(spark, sf):
    n = _n_train(spark, sf)
    return _fit_predict(spark, sf, ML.linear_svc_ovr(10.0, n, featuresCol="features", labelCol="y"),
                        "linear_svc")


@register("svc_rff", ops=("M5", "A24", "L5"))
def q_svc_rff(spark, sf):
    """Kernel SVM (C = 10) on random Fourier features of an RBF kernel, with probabilities: sigmoids of the
    margins are fitted on five folds' held-out rows."""
    s = emb_splits(spark, sf)
    train = prep.fold_assign(s.where(F.col("split") != "test"), "label", "vec_id", 5)
    d = _emb_design(train.unionByName(s.where(F.col("split") == "test"), allowMissingColumns=True))
    wave = linear.Fourier.draw(d.width, rbf_gamma(d), 100)
    fits = linear.fit_linear(d, [linear.Linear("hinge", 10.0, f, 2000, fourier=wave) for f in (*range(5), None)])

    def margins(holds):
        return joint.score(d, range(6), lambda block, m: fits[m].scores(block.x), holds)

    unseen = margins(lambda block, m: (block.fold == m) & (m < 5))
    out = linear.calibrated(margins(lambda block, m: (block.fold == -1) & (m == 5)), linear.fit_sigmoids(class_margins(unseen)))
    return out.select(F.col("id").alias("vec_id"), "y", "prediction", rnd(F.array_max("probability"), 6).alias("confidence"),
                      F.array_sort(F.transform("probability", lambda p: rnd(p, 6))).alias("proba_sorted"),
                      F.lit("svc_rff").alias("model"))


def class_margins(scored):
    """(class, m, hit): one row for every class of every scored row."""
    return scored.select("y", F.posexplode("scores").alias("class", "m")).select(
        "class", "m", (F.col("y") == F.col("class")).alias("hit"))


def rbf_gamma(d) -> float:
    """1 / (features x variance of all feature values), from sums of the rows that train."""
    n, a, b = joint.sums(d, [0], joint.moments).get(0, np.zeros(3))
    var = b / n - (a / n) ** 2 if n else 0.0
    return 1.0 / (d.width * var) if var > 0 else 1.0


def search_points(width: int, gamma: float = 1.0, grids: ML.Grids | None = None) -> dict:
    """The points of the published classification grids by family."""
    return search.grid_points(grids or ML.Grids(), width, gamma)


@register("cv_leaderboard", ops=("M1", "M2", "M3", "M4", "M5", "W2", "L1"))
def q_cv_leaderboard(spark, sf):
    """5-fold search over the published grids (32 points).  The best point of every family is fitted on the training
    rows and scored on validation and test rows; the family that is best on validation is searched again on both
    and that model is tested (stage final)."""
    return model_search(emb_splits(spark, sf), "label", "vec_id")


def model_search(splits, label: str, key: str, grids: ML.Grids | None = None, folds: int = 5):
    """Rows (stage, model, params, cv_f1, val_accuracy, val_f1, test_accuracy, test_f1); columns that a stage does not
    measure are null.  ``splits`` has features, y and split (train, val, test)."""
    spark = splits.sparkSession
    train = prep.fold_assign(splits.where("split = 'train'"), label, key, folds)
    d = joint.design(train.unionByName(splits.where("split != 'train'"), allowMissingColumns=True), key, "features", "y", "fold",
                     models=200)
    points, cuts, rows, best = search_points(d.width, rbf_gamma(d), grids), joint.cut_points(d), [], {}
    part = splits.select(F.col(key).alias("id"), "split")
    for family, ps in points.items():
        pred = stage_predictions(search.held_out(d, family, ps, range(folds), cuts))
        cv = search.choose(search.metrics_by(pred, ["point", "fold"]))
        top = min(cv, key=lambda r: (-r["cv_f1"], r["point"]))
        rows += [("search", family, ps[r["point"]].params, r["cv_f1"], None, None, None, None) for r in cv]
        scored = stage_predictions(search.held_out(d, family, [ps[top["point"]]], [None], cuts)).join(part, "id")
        met = {r["split"]: r for r in search.metrics_by(scored, ["split"]).collect()}
        best[family] = (met["val"]["f1"], top["cv_f1"], ps[top["point"]].params)
        rows.append(("family", family, ps[top["point"]].params, top["cv_f1"], met["val"]["accuracy"], met["val"]["f1"],
                     met["test"]["accuracy"], met["test"]["f1"]))
    d.unpersist()
    winner = max(best, key=lambda k: (best[k][0], best[k][1], k))
    both = prep.fold_assign(splits.where("split != 'test'"), label, key, folds)
    d = joint.design(both.unionByName(splits.where("split = 'test'"), allowMissingColumns=True), key, "features", "y", "fold",
                     models=200)
    ps, cuts = search_points(d.width, rbf_gamma(d), grids)[winner], joint.cut_points(d)
    cv = search.choose(search.metrics_by(stage_predictions(search.held_out(d, winner, ps, range(folds), cuts)), ["point", "fold"]))
    top = min(cv, key=lambda r: (-r["cv_f1"], r["point"]))
    tested = stage_predictions(search.held_out(d, winner, [ps[top["point"]]], [None], cuts))
    met = search.metrics_by(tested.withColumn("all", F.lit(1)), ["all"]).first()
    rows.append(("final", winner, ps[top["point"]].params, top["cv_f1"], None, None, met["accuracy"], met["f1"]))
    d.unpersist()
    return spark.createDataFrame(rows, "stage string, model string, params string, cv_f1 double, val_accuracy double, "
                                       "val_f1 double, test_accuracy double, test_f1 double")


def stage_predictions(pred, scores: bool = False):
    """The predictions of a search, written once: metrics of every grouping are counts over this table."""
    path, pred = scratch_path(pred.sparkSession, "predictions"), pred if scores else pred.drop("scores")
    pred.write.parquet(path)
    return pred.sparkSession.read.schema(pred.schema).parquet(path)


# ---------------------------------------------------------------- regression (M8, M9)

ITEM_MATRIX = ["w", "v", "c", "o", "r", "density", "src_enc"]


def _item_splits(spark, sf):
    from cribble.plans.prepare import prepare
    prepared, fitted = prepare(catalog.items(spark, sf))
    a = VectorAssembler(inputCols=ITEM_MATRIX, outputCol="features").transform(prepared).persist(
        StorageLevel.MEMORY_AND_DISK)
    return catalog.right_size(a, a.count())


def _regress(spark, sf, make, name):
    d = _item_splits(spark, sf)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    model = make(train).fit(train)
    from cribble.operators.metrics import regression_metrics
    return regression_metrics(model.transform(test), "price", "prediction").withColumn("model", F.lit(name))


@register("ridge", ops=("M8",))
def q_ridge(spark, sf):
    """Ridge regression: the published penalties are searched over 5 folds of the training rows by mean R2, the best one is
    fitted on all of them and tested."""
    return best_ridge(_item_splits(spark, sf), ITEM_MATRIX, "price", "item_id")


def best_ridge(splits, feats: list[str], label: str, key: str, grids: ML.Grids | None = None):
    """(r2, mae, rmse, model, alpha, cv_r2) of the penalty with the greatest mean R2; of equals the first of the grid.

    Folds follow a hash of the key (equal in size up to chance), so the search needs no shuffle of the rows.
    """
    from cribble.operators.metrics import regression_metrics
    grids = grids or ML.Grids()
    train, test = splits.where(F.col("split") == "train"), splits.where(F.col("split") == "test")
    folds = train.select(*feats, label, F.pmod(F.xxhash64(key), F.lit(grids.cv_folds)).alias("fold"))
    cv = ML.ridge_search(folds, feats, label, "fold", grids.ridge_alpha)
    alpha = max(grids.ridge_alpha, key=lambda a: -np.inf if np.isnan(cv[a]) else cv[a])
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).collect()[0]
    model = ML.ridge(alpha, st["n"], st["s"], featuresCol="features", labelCol=label).fit(train)
    return regression_metrics(model.transform(test), label, "prediction").select(
        "*", F.lit("ridge").alias("model"), F.lit(float(alpha)).alias("alpha"), F.lit(round(cv[alpha], 6)).alias("cv_r2"))


@register("rf_reg", ops=("M9",))
def q_rf_reg(spark, sf):
    return _regress(spark, sf, lambda t: ML.rf_regressor(100, 10, featuresCol="features", labelCol="price"), "rf")


@register("gbt_reg", ops=("M9",))
def q_gbt_reg(spark, sf):
    return _regress(spark, sf, lambda t: ML.gbt_regressor(100, 0.1, 5, featuresCol="features", labelCol="price"),
                    "gbt")


# ---------------------------------------------------------------- closed forms with SQL twins

def ridge_closed_form(df, x1: str, x2: str, y: str, alpha: float):
    """Two-feature ridge with unpenalised intercept from centred Gram sums (one-row frame)."""
    m = df.agg(F.avg(x1).alias("m1"), F.avg(x2).alias("m2"), F.avg(y).alias("my")).collect()[0]
    a1, a2, ay = (F.col(x1) - F.lit(m["m1"])), (F.col(x2) - F.lit(m["m2"])), (F.col(y) - F.lit(m["my"]))
    g = df.agg(F.sum(a1 * a1).alias("s11"), F.sum(a1 * a2).alias("s12"), F.sum(a2 * a2).alias("s22"),
               F.sum(a1 * ay).alias("s1y"), F.sum(a2 * ay).alias("s2y"))
    a = F.col("s11") + F.lit(alpha)
    d = F.col("s22") + F.lit(alpha)
    det = a * d - F.col("s12") * F.col("s12")
    b1 = (d * F.col("s1y") - F.col("s12") * F.col("s2y")) / det
    b2 = (a * F.col("s2y") - F.col("s12") * F.col("s1y")) / det
    return g.select(b1.alias("coef_1"), b2.alias("coef_2"),
                    (F.lit(m["my"]) - b1 * F.lit(m["m1"]) - b2 * F.lit(m["m2"])).alias("intercept"))


def _ridge_sql(alpha: float = 1.0) -> str:
    return f"""
WITH d AS (SELECT l_extendedprice AS y, l_quantity AS x1, l_discount AS x2 FROM lineitem),
m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM d),
g AS (SELECT sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12, sum((x2 - m2) * (x2 - m2)) AS s22,
             sum((x1 - m1) * (y - my)) AS s1y, sum((x2 - m2) * (y - my)) AS s2y FROM d, m),
c AS (SELECT ((s22 + {alpha}) * s1y - s12 * s2y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b1,
             ((s11 + {alpha}) * s2y - s12 * s1y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS b2 FROM g)"""


def _ridge_frame(spark, sf):
    li = catalog.table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x1"), F.col("l_discount").alias("x2"))
    return li


@register("ridge_closed_form", ops=("M8",), sql=_ridge_sql() + f"""
SELECT {sql_rnd('b1', 6)} AS coef_1, {sql_rnd('b2', 4)} AS coef_2, {sql_rnd('my - b1 * m1 - b2 * m2', 4)} AS intercept
FROM c, m""")
def q_ridge_closed_form(spark, sf):
    r = ridge_closed_form(_ridge_frame(spark, sf), "x1", "x2", "y", 1.0)
    return r.select(rnd("coef_1", 6).alias("coef_1"), rnd("coef_2", 4).alias("coef_2"),
                    rnd("intercept", 4).alias("intercept"))


@register("linear_shap", ops=("M15",), sql=_ridge_sql() + f"""
SELECT 'x1' AS feature, {sql_rnd('avg(abs(b1 * (x1 - m1)))', 4)} AS mean_abs_contribution FROM d, m, c
UNION ALL SELECT 'x2', {sql_rnd('avg(abs(b2 * (x2 - m2)))', 4)} FROM d, m, c""")
def q_linear_shap(spark, sf):
    """Exact linear attribution: mean |coef * (x - mean)| per feature (M15, linear model)."""
    d = _ridge_frame(spark, sf)
    coef = ridge_closed_form(d, "x1", "x2", "y", 1.0).collect()[0]
    m = d.agg(F.avg("x1").alias("m1"), F.avg("x2").alias("m2")).collect()[0]
    out = d.agg(F.avg(F.abs(F.lit(coef["coef_1"]) * (F.col("x1") - F.lit(m["m1"])))).alias("x1"),
                F.avg(F.abs(F.lit(coef["coef_2"]) * (F.col("x2") - F.lit(m["m2"])))).alias("x2"))
    long = out.unpivot([], ["x1", "x2"], "feature", "v")
    return long.select("feature", F.when(F.col("feature") == "x1", rnd("v", 4)).otherwise(rnd("v", 4))
                       .alias("mean_abs_contribution"))


def _nb_frames(spark, sf):
    docs = catalog.spread(catalog.table(spark, sf, "documents")).select("doc_id", "text")
    labels = catalog.table(spark, sf, "labels").select("doc_id", "quality")
    d = T.with_clean_text(docs, "text", "clean").withColumn("vt", T.vector_tokens("clean"))
    counts = (d.select("doc_id", F.explode_outer("vt").alias("term")).where(F.col("term").isNotNull())
              .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n")))
    return docs, labels, counts.persist(StorageLevel.MEMORY_AND_DISK)


def naive_bayes_closed_form(docs, labels, counts, vocab: V.Vocab):
    """Multinomial NB with Laplace-smoothed likelihoods and the unsmoothed class prior (M7).

    Class x term log-likelihoods (bounded by classes x vocabulary) are broadcast;
    document scores are one join + groupBy; ties go to the smallest class.
    """
    vocab_df = F.broadcast(V.vocab_frame(docs.sparkSession, vocab).select("term"))
    lc = counts.join(vocab_df, "term").join(labels, "doc_id")
    n_ct = lc.groupBy("quality", "term").agg(F.sum("n").alias("n_ct"))
    classes = labels.groupBy("quality").agg(F.count(F.lit(1)).alias("n_docs"))
    n_c = n_ct.groupBy("quality").agg(F.sum("n_ct").alias("n_c"))
    n_lab = labels.count()
    vsize = len(vocab.terms)
    cls_rows = classes.join(n_c, "quality", "left").collect()
    # every (class, term) pair, including unseen ones: classes x vocabulary rows (bounded)
    grid = F.broadcast(docs.sparkSession.createDataFrame(
        [(r["quality"], t) for r in cls_rows for t in vocab.terms], "quality int, term string"))
    nc_map = F.create_map(*[x for r in cls_rows for x in (F.lit(r["quality"]), F.lit(float(r["n_c"] or 0)))])
    loglik = grid.join(n_ct, ["quality", "term"], "left").select(
        "quality", "term",
        F.log((F.coalesce("n_ct", F.lit(0)) + F.lit(1.0)) / (F.element_at(nc_map, F.col("quality")) + F.lit(float(vsize))))
        .alias("ll"))
    prior = {r["quality"]: r["n_docs"] / n_lab for r in cls_rows}
    pr_map = F.create_map(*[x for k, v in prior.items() for x in (F.lit(k), F.lit(float(v)))])
    scores = (counts.join(F.broadcast(loglik), "term")
              .groupBy("doc_id", "quality").agg(F.sum(F.col("n") * F.col("ll")).alias("s"))
              .withColumn("score", F.log(F.element_at(pr_map, F.col("quality"))) + F.col("s")))
    best = scores.groupBy("doc_id").agg(F.max_by("quality", F.struct(F.col("score"), -F.col("quality"))).alias("pred"))
    prior_best = sorted(prior, key=lambda k: (-prior[k], k))[0]
    return docs.select("doc_id").join(best, "doc_id", "left").select(
        "doc_id", F.coalesce("pred", F.lit(prior_best)).alias("pred"))


_NB_SQL = f"""
WITH vt AS (SELECT doc_id, {T.sql_vector_tokens(T.sql_clean_text('text'))} AS vt FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(vt) AS term FROM vt) GROUP BY doc_id, term),
s AS (SELECT term FROM c GROUP BY term HAVING count(*) >= 2 ORDER BY sum(n) DESC, term LIMIT 500),
lc AS (SELECT c.doc_id, c.term, c.n, l.quality FROM c JOIN s USING (term) JOIN labels l USING (doc_id)),
nct AS (SELECT quality, term, sum(n) AS n_ct FROM lc GROUP BY quality, term),
cls AS (SELECT quality, count(*) AS n_docs FROM labels GROUP BY quality),
nc AS (SELECT cls.quality, coalesce(sum(nct.n_ct), 0)::DOUBLE AS n_c FROM cls LEFT JOIN nct USING (quality)
       GROUP BY cls.quality),
ll AS (SELECT nc.quality, s.term, ln((coalesce(nct.n_ct, 0) + 1.0) / (nc.n_c + (SELECT count(*) FROM s)::DOUBLE)) AS ll
       FROM nc CROSS JOIN s LEFT JOIN nct ON nct.quality = nc.quality AND nct.term = s.term),
pr AS (SELECT quality, n_docs::DOUBLE / (SELECT count(*) FROM labels)::DOUBLE AS p FROM cls),
sc AS (SELECT c.doc_id, ll.quality, ln(pr.p) + sum(c.n * ll.ll) AS score
       FROM c JOIN ll USING (term) JOIN pr USING (quality) GROUP BY c.doc_id, ll.quality, pr.p),
best AS (SELECT doc_id, quality AS pred FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, quality) AS rk FROM sc) WHERE rk = 1),
pb AS (SELECT quality FROM cls ORDER BY n_docs DESC, quality LIMIT 1)
SELECT d.doc_id, coalesce(b.pred, (SELECT quality FROM pb)) AS pred FROM documents d LEFT JOIN best b USING (doc_id)"""


@register("multinomial_nb", ops=("M7",), sql=_NB_SQL)
def q_multinomial_nb(spark, sf):
    docs, labels, counts = _nb_frames(spark, sf)
    vocab = V.fit_vocab(counts, docs.count())
    return naive_bayes_closed_form(docs, labels, counts, vocab)


@register("char_ngrams", ops=("N11",), sql=f"""
WITH w AS (SELECT DISTINCT unnest({T.sql_clean_tokens('text')}) AS word FROM documents),
g AS (SELECT word, '<' || word || '>' AS b FROM w)
SELECT word, CAST(len(gr) AS INTEGER) AS n_grams, array_to_string(gr, '|') AS grams
FROM (SELECT word, flatten([list_filter(list_transform(range(1, greatest(length(b) - n + 1, 1) + 1),
                                                        lambda i: substr(b, i, n)), lambda s: length(s) = n)
                             FOR n IN range(3, 7)]) AS gr FROM g)""")
def q_char_ngrams(spark, sf):
    d = T.with_clean_tokens(catalog.spread(catalog.table(spark, sf, "documents")).select("text"), "text", "toks")
    words = d.select(F.explode_outer("toks").alias("word")).where(F.col("word").isNotNull()).distinct()
    g = words.withColumn("gr", ML.char_ngrams(F.col("word")))
    return g.select("word", F.size("gr").alias("n_grams"), F.array_join("gr", "|").alias("grams"))


@register("hybrid_decision", ops=("N14", "N13"), sql=f"""
WITH t AS (SELECT doc_id, {T.sql_lexical_category(T.sql_whitespace_words(T.sql_clean_text('text')))} AS lexical,
                  {T.sql_lexical_category(T.sql_whitespace_words('lower(text)'))} AS model FROM documents)
SELECT doc_id, CASE WHEN lexical IS NOT NULL AND model IS NOT NULL AND lexical <> model THEN lexical
                    WHEN model IS NOT NULL THEN model ELSE lexical END AS decision,
       CASE WHEN lexical IS NOT NULL AND model IS NOT NULL AND lexical <> model THEN 'lexical'
            WHEN model IS NOT NULL THEN 'model' WHEN lexical IS NOT NULL THEN 'lexical' END AS provenance
FROM t""")
def q_hybrid_decision(spark, sf):
    """Lexical rule on the cleaned text vs a second scorer on the raw words: lexical wins
    on disagreement, else the model, else the lexical rule (N14)."""
    d = T.with_clean_tokens(catalog.spread(catalog.table(spark, sf, "documents")).select("doc_id", "text"), "text", "toks")
    d = d.select("doc_id", T.lexical_category(F.col("toks")).alias("lexical"),
                 T.lexical_category(T.whitespace_words(F.lower("text"))).alias("model"))
    return d.select("doc_id", *hybrid(F.col("lexical"), F.col("model")))


def hybrid(lexical, model):
    disagree = lexical.isNotNull() & model.isNotNull() & (lexical != model)
    decision = F.when(disagree, lexical).when(model.isNotNull(), model).otherwise(lexical)
    prov = (F.when(disagree, F.lit("lexical")).when(model.isNotNull(), F.lit("model"))
            .when(lexical.isNotNull(), F.lit("lexical")))
    return decision.alias("decision"), prov.alias("provenance")


# ---------------------------------------------------------------- clustering

@register("kmeans_sweep", ops=("M16", "A21", "A22"))
def q_kmeans_sweep(spark, sf):
    e = ML.vector_from_array(catalog.table(spark, sf, "embeddings"), "embedding", "features")
    return ML.kmeans_sweep(e, "features")


@register("pca2", ops=("M17", "A23", "S8"))
def q_pca2(spark, sf):
    e = ML.vector_from_array(catalog.table(spark, sf, "embeddings"), "embedding", "features")
    _, proj, pct = ML.pca_2d(e, "features")
    return proj.select("vec_id", "label", rnd("PC1", 6).alias("PC1"), rnd("PC2", 6).alias("PC2"),
                       F.lit(round(pct, 2)).alias("explained_pct"))


# ---------------------------------------------------------------- embeddings

def _doc_tokens(spark, sf):
    d = T.with_clean_tokens(catalog.spread(catalog.table(spark, sf, "documents")).select("doc_id", "text"), "text", "toks")
    return d.select("doc_id", "toks").persist(StorageLevel.MEMORY_AND_DISK)


@register("word2vec", ops=("N10", "N12", "J5"))
def q_word2vec(spark, sf):
    d = _doc_tokens(spark, sf)
    model = ML.word2vec("toks", ML.token_partitions(d, "toks")).fit(d)
    pooled = ML.mean_pool(d, "doc_id", "toks", model.getVectors(), 100)
    return pooled.select("doc_id", F.size("pooled").alias("dim"),
                         rnd(F.aggregate("pooled", F.lit(0.0), lambda a, x: a + x * x), 6).alias("sq_norm"))


@register("subword_embed", ops=("N11",))
def q_subword_embed(spark, sf):
    """Subword vectors: skip-gram over whole documents in order, a word being the mean of the vectors of
    its '<word>' character n-grams, so words never seen in training still get one."""
    return subword_vectors(_doc_tokens(spark, sf))


def subword_vectors(d):
    """(word, dim, vector) of every distinct word of the token lists."""
    words = d.select(F.explode_outer("toks").alias("word")).where(F.col("word").isNotNull()).distinct()
    out = subword.word_vectors(words, "word", subword.fit(d, "toks"))
    return out.select("word", F.size("vector").alias("dim"), "vector")


# ---------------------------------------------------------------- text models, fusion, stacking

def _labelled_docs(spark, sf):
    docs = catalog.spread(catalog.table(spark, sf, "documents")).select("doc_id", "text", "n_chars")
    labels = catalog.table(spark, sf, "labels").select("doc_id", "quality")
    d = docs.join(labels, "doc_id").withColumn("y", F.col("quality").cast("double"))
    d = d.withColumn("n_words", F.size(T.whitespace_words("text")).cast("double")) \
         .withColumn("log_chars", F.log1p(F.col("n_chars").cast("double")))
    s = prep.stratified_split(d, "quality", "doc_id").persist(StorageLevel.MEMORY_AND_DISK)
    return catalog.right_size(s, s.count())


def _text_vocab(train, pairs: bool = True):
    d = T.with_clean_text(train, "text", "clean").withColumn("vt", T.vector_tokens("clean"))
    d = T.with_ngrams_1_2(d, "vt", "ng") if pairs else d.withColumn("ng", F.col("vt"))
    counts = (d.select("doc_id", F.explode_outer("ng").alias("term")).where(F.col("term").isNotNull())
              .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n")))
    return V.fit_vocab(counts, train.count())


def matrix_specs(vectorizer: str) -> dict:
    """Classifiers of the text matrix; naive Bayes only on the vectors without negative values."""
    specs = {"linear_svc": linear.Linear("hinge", 1.0, max_iter=2000), "logreg": linear.Linear("softmax", 1.0, max_iter=500),
             "rf": trees.Forest(100)}
    if vectorizer in ("bow", "tfidf"):
        specs["naive_bayes"] = ML.naive_bayes(featuresCol=vectorizer, labelCol="y")
    return specs


def matrix_features(s):
    """``s`` with one vector column per vectorizer, each fitted on the training rows."""
    train = s.where(F.col("split") == "train")
    stages = (ML.text_stages("text", _text_vocab(train, pairs=False), "bow", weighted=False)
              + ML.text_stages("text", _text_vocab(train), "tfidf"))
    out = Pipeline(stages=stages).fit(train).transform(s)
    d = T.with_clean_tokens(s, "text", "toks").select("doc_id", "split", "toks").persist(StorageLevel.MEMORY_AND_DISK)
    fit_on = d.where(F.col("split") == "train")
    model = ML.word2vec("toks", ML.token_partitions(fit_on, "toks")).fit(fit_on)
    for name, pooled in (("word2vec", ML.mean_pool(d, "doc_id", "toks", model.getVectors(), 100)),
                         ("subword", subword.pooled(d, "doc_id", "toks", subword.fit(fit_on, "toks")))):
        out = out.join(ML.vector_from_array(pooled, "pooled", name).drop("pooled"), "doc_id")
    return out


@register("nlp_matrix", ops=("M10", "A11"))
def q_nlp_matrix(spark, sf):
    """Text vectorizers x classifiers on the labelled documents (14 fits); val/test metrics."""
    s = matrix_features(_labelled_docs(spark, sf)).select(
        "doc_id", "y", "split", "bow", "tfidf", "word2vec", "subword").persist(StorageLevel.MEMORY_AND_DISK)
    s = s.withColumn("fold", F.when(F.col("split") == "train", 0))
    part, scored = s.select(F.col("doc_id").alias("id"), "split"), None
    for vectorizer in ("bow", "tfidf", "word2vec", "subword"):
        specs = matrix_specs(vectorizer)
        names = [n for n in specs if n != "naive_bayes"]
        d = joint.design(s, "doc_id", vectorizer, "y", "fold", models=100)
        pred = search.fit_and_score(d, [specs[n] for n in names], [
            search.Read(i, -1, search.plain, whole_forest(specs[n])) for i, n in enumerate(names)])
        pred = pred.select(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("model") + 1).alias("classifier"),
                           "id", "y", "prediction")
        if "naive_bayes" in specs:
            nb = specs["naive_bayes"].fit(s.where("fold = 0")).transform(s.where("fold IS NULL"))
            pred = pred.unionByName(nb.select(F.lit("naive_bayes").alias("classifier"), F.col("doc_id").alias("id"), "y", "prediction"))
        pred = stage_predictions(pred.withColumn("vectorizer", F.lit(vectorizer)).withColumn("scores", F.lit(None)))
        d.unpersist()
        scored = pred if scored is None else scored.unionByName(pred)
    met = search.metrics_by(scored.join(part, "id"), ["vectorizer", "classifier", "split"])
    by = {k: F.max(F.when(F.col("split") == sp, F.col(m))).alias(k) for k, sp, m in (
        ("val_accuracy", "val", "accuracy"), ("val_f1", "val", "f1"), ("test_accuracy", "test", "accuracy"), ("test_f1", "test", "f1"))}
    return met.groupBy("vectorizer", "classifier").agg(*by.values())


FUSION_NUM = ["n_words", "log_chars"]


def _fused_features(spark, sf):
    """Fit the feature stages once (numeric scaling + text TF-IDF) and cache the
    transformed training and test rows; every classifier below reuses them."""
    s = _labelled_docs(spark, sf)
    train, test = s.where(F.col("split") != "test"), s.where(F.col("split") == "test")
    vocab = _text_vocab(train)
    scales = prep.fit_scale(train, FUSION_NUM)
    stages = [ML.scale_stage(scales)] + ML.text_stages("text", vocab, "tfidf")
    feats = Pipeline(stages=stages).fit(train)
    keep = ["doc_id", "quality", "y", *FUSION_NUM, "tfidf"]
    tr = feats.transform(train).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    te = feats.transform(test).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
    tr, te = catalog.right_size(tr, tr.count()), catalog.right_size(te, te.count())
    return feats, tr, te, test


def _assembler(weight: float = 1.0) -> list:
    """Numeric block (optionally weighted, M12) joined to the TF-IDF block."""
    stages = []
    num = FUSION_NUM
    if weight != 1.0:
        stmt = ", ".join(f"{c} * {weight!r} AS w_{c}" for c in FUSION_NUM)
        stages.append(SQLTransformer(statement=f"SELECT *, {stmt} FROM __THIS__"))
        num = [f"w_{c}" for c in FUSION_NUM]
    stages.append(VectorAssembler(inputCols=num + ["tfidf"], outputCol="features", handleInvalid="keep"))
    return stages


@register("multimodal", ops=("M11", "S9", "M13", "M14"))
def q_multimodal(spark, sf):
    """Numeric + TF-IDF fused into one vector, one-vs-rest linear SVM; the whole pipeline
    (scaling, text stages, assembler, classifier) is saved, reloaded and scores raw rows."""
    feats, tr, te, raw_test = _fused_features(spark, sf)
    n = tr.count()
    head = Pipeline(stages=_assembler() + [ML.linear_svc_ovr(1.0, n, featuresCol="features",
                                                              labelCol="y")]).fit(tr)
    model = PipelineModel(stages=feats.stages + head.stages)
    path = scratch_path(spark, "model")
    ML.save(model, path)
    pred = ML.load(path).transform(raw_test)
    met = ML.evaluate(pred, "y")
    return pred.select("doc_id", "y", "prediction", F.lit(met["accuracy"]).alias("test_accuracy"),
                       F.lit(met["f1_weighted"]).alias("test_f1"))


@register("weighted_fusion", ops=("M12",))
def q_weighted_fusion(spark, sf):
    _, tr, te, _ = _fused_features(spark, sf)
    n = tr.count()
    rows = []
    for w in (1.0, 2.0, 0.5):
        model = Pipeline(stages=_assembler(w) + [ML.linear_svc_ovr(1.0, n, featuresCol="features",
                                                                   labelCol="y")]).fit(tr)
        met = ML.evaluate(model.transform(te), "y")
        rows.append((f"numeric x {w:g}", met["accuracy"], met["f1_weighted"]))
    return spark.createDataFrame(rows, "approach string, test_accuracy double, test_f1 double")


def whole_forest(spec) -> tuple | None:
    """The cut of a read that takes all of a forest; None for other models."""
    return (spec.trees, spec.depth) if isinstance(spec, trees.Forest) else None


def stacked(d, bases: dict, folds: int = 3):
    """(id, y, meta): the scores of all base models side by side, out of fold for the rows that train (each
    scored by the fit that did not see its fold), by the fit on all of them for the others (fold -1)."""
    each = [(n, f) for n in bases for f in (*range(folds), None)]
    pred = stage_predictions(search.fit_and_score(d, [search.without_fold(bases[n], f) for n, f in each], [
        search.Read(i, -1 if f is None else f, search.plain, whole_forest(bases[n])) for i, (n, f) in enumerate(each)]), scores=True)
    each = F.struct((F.col("model") / (folds + 1)).cast("int").alias("base"), "scores")
    return pred.groupBy("id").agg(F.max("y").alias("y"), F.array_sort(F.collect_list(each)).alias("s")).select(
        "id", "y", F.flatten(F.col("s.scores")).alias("meta"))


@register("stacking", ops=("M12b",))
def q_stacking(spark, sf):
    """Three base models, 3-fold out-of-fold scores, logistic meta-model on them."""
    _, tr0, te0, _ = _fused_features(spark, sf)
    asm = VectorAssembler(inputCols=FUSION_NUM + ["tfidf"], outputCol="features", handleInvalid="keep")
    rows = prep.fold_assign(asm.transform(tr0), "quality", "doc_id", 3).unionByName(asm.transform(te0), allowMissingColumns=True)
    d = joint.design(rows, "doc_id", "features", "y", "fold", models=100)
    bases = {"svc": linear.Linear("hinge", 1.0, max_iter=2000), "lr": linear.Linear("softmax", 1.0), "rf": trees.Forest(100)}
    meta = stacked(d, bases).join(d.rows.where("lane = 0").select("id", F.when(F.col("fold") >= 0, 0).alias("fold")), "id")
    m = joint.design(meta, "id", "meta", "y", "fold")
    top = linear.fit_linear(m, [linear.Linear("softmax", 1.0, max_iter=200)])[0]
    pred = stage_predictions(joint.score(m, [0], lambda block, k: top.scores(block.x), lambda block, k: block.fold == -1))
    met = search.metrics_by(pred, ["model"]).select("model", F.col("f1").alias("test_f1"))
    return pred.join(F.broadcast(met), "model").select(F.col("id").alias("doc_id"), "y", "prediction", "test_f1")


# ---------------------------------------------------------------- attribution

def rotated_accuracies(pos, n: int, feats: list[str], model) -> dict[int, float]:
    """Accuracy of ``model`` on the rows (-1) and with the values of each feature (by its number) rotated by one position:
    one join with the next row, one scoring pass over all variants."""
    shifted = pos.select((F.col("_pos") % n + 1).alias("_pos"), *[F.col(f).alias(f"_n_{f}") for f in feats])
    variants = [F.struct(F.lit(i).alias("variant"), *[F.col(f"_n_{g}" if g == f else g).alias(g) for g in feats])
                for i, f in enumerate([None, *feats], -1)]
    rows = pos.join(shifted, "_pos").select("y", F.explode(F.array(*variants)).alias("v")).select("y", "v.*")
    hits = model.transform(rows).groupBy("variant").agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("a"))
    return {r["variant"]: r["a"] for r in hits.collect()}


@register("perm_importance", ops=("M15",))
def q_perm_importance(spark, sf):
    """Random-forest importances plus permutation importance: each feature's values are
    rotated by one position in md5 order (a deterministic permutation) and the accuracy
    drop is measured."""
    from cribble.functions.positions import hash_positions
    d, feats = _item_splits(spark, sf), ITEM_MATRIX
    train = d.where(F.col("split") == "train").where(F.col("cat_enc").isNotNull())
    lab = F.col("cat_enc").cast("double")
    test = d.where(F.col("split") == "test").select("item_id", *feats, lab.alias("y"))
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             ML.rf_classifier(100, 10, featuresCol="features", labelCol="y")]).fit(
        train.drop("features").withColumn("y", lab))
    n = test.count()
    pos = hash_positions(test.withColumn("_h", F.md5(F.col("item_id").cast("string"))).withColumn("_g", F.lit(1)),
                         ["_g"], "_h", n).select("_pos", "y", *feats).persist()
    acc = rotated_accuracies(pos, n, feats, model)
    nan, imp = float("nan"), model.stages[-1].featureImportances
    rows = [(f, float(imp[i]), acc.get(-1, nan) - acc.get(i, nan)) for i, f in enumerate(feats)]
    return spark.createDataFrame(rows, "feature string, rf_importance double, permutation_drop double").orderBy(
        F.desc("permutation_drop"), F.asc("feature"))


@register("top_features", ops=("L3", "M15"))
def q_top_features(spark, sf):
    """The five features with the largest permutation importance (ties by name)."""
    return q_perm_importance(spark, sf).orderBy(F.desc("permutation_drop"), F.asc("feature")).limit(5)
