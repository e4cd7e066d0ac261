"""Quality classifier as a sparse rule ensemble.

Statistics of the text are Spark columns.  A small forest is grown on a bounded sample
of labelled rows, every tree path becomes a conjunctive rule over the statistics, a
lasso logistic regression keeps few of the rules, and those are compiled back into one
Spark column expression, so scoring is a projection without shuffle or Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import given_back, kept, stage

STATS = ["log_chars", "upper", "symbol", "digit", "space", "mean_word", "distinct_words", "symbol_words",
         "short_words", "stops", "mean_line", "marks"]
Condition = tuple[int, bool, float]  # statistic, True for <=, threshold


@dataclass
class Rule:
    conditions: tuple[Condition, ...]
    weight: float = 0.0


@dataclass
class RuleModel:
    intercept: float
    rules: list[Rule] = field(default_factory=list)

    def score(self) -> Column:
        """Probability of label 1 from the statistics columns."""
        z = F.lit(self.intercept)
        for r in self.rules:
            z = z + F.when(fires(r), F.lit(r.weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, stats): the columns of ``docs`` as one struct and the statistics of the whole text as another.

    A null text counts as empty; an empty text has zero for every statistic.  The statistics come out of a generator:
    filters on what is computed from them are not pushed below it, so each pattern runs once a text.  They are taken
    in a function of array elements, which Spark does not compile: with all patterns in one compiled method executors
    passed 3000 MB, without it they stay at half of that.
    """
    def raw(t: Column) -> Column:
        def count(pattern: str) -> Column:
            return F.regexp_count(t, F.lit(pattern)).cast("double")

        return F.struct(
            F.length(t).cast("double").alias("chars"), count(r"\p{Lu}").alias("upper"),
            count(r"[^\p{L}\p{N}\s]").alias("symbol"), count(r"\p{N}").alias("digit"), count(r"\s").alias("space"),
            count(r"\S+").alias("words"), count(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)").alias("symbol_words"),
            count(r"(?<![\p{L}\p{N}])\p{L}{1,3}(?![\p{L}\p{N}])").alias("short_words"),
            count(r"[.?!]").alias("stops"), count(r"\n").alias("breaks"), count(r"[#$%&*|]").alias("marks"),
            F.size(F.array_distinct(F.split(t, r"\s+"))).cast("double").alias("distinct"))

    rows = (docs.select(kept(docs).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
            .select("row", F.inline(F.transform(F.array("t"), raw))))
    one = F.lit(1.0)
    chars, word = F.greatest(F.col("chars"), one), F.greatest(F.col("words"), one)
    stats = F.struct(
        F.log1p(F.col("chars")).alias("log_chars"), (F.col("upper") / chars).alias("upper"),
        (F.col("symbol") / chars).alias("symbol"), (F.col("digit") / chars).alias("digit"),
        (F.col("space") / chars).alias("space"), ((F.col("chars") - F.col("space")) / word).alias("mean_word"),
        (F.least("distinct", "words") / word).alias("distinct_words"),
        (F.col("symbol_words") / word).alias("symbol_words"),
        (F.col("short_words") / word).alias("short_words"), (F.col("stops") / word).alias("stops"),
        F.log1p(F.col("chars") / (F.col("breaks") + 1)).alias("mean_line"),
        (F.col("marks") / chars).alias("marks"))
    return rows.select("row", F.explode(F.array(stats)).alias("stats"))


def fires(rule: Rule) -> Column:
    out = F.lit(True)
    for i, below, threshold in rule.conditions:
        c = F.col(f"stats.{STATS[i]}")
        out = out & (c <= threshold if below else c > threshold)
    return out


def tree_rules(forest) -> list[Rule]:
    """The conjunction along every path from a root to a node, repeated bounds merged."""
    found: dict[tuple[Condition, ...], None] = {}

    def walk(node, path: dict[tuple[int, bool], float]) -> None:
        if path:
            found[tuple(sorted((i, below, t) for (i, below), t in path.items()))] = None
        if node.getClass().getSimpleName() == "LeafNode":
            return
        i, t = node.split().featureIndex(), node.split().threshold()
        left, right = path.get((i, True), t), path.get((i, False), t)
        walk(node.leftChild(), {**path, (i, True): min(left, t)})
        walk(node.rightChild(), {**path, (i, False): max(right, t)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return [Rule(c) for c in sorted(found)]


def fit(docs: DataFrame, labels: DataFrame, key: str, label: str, max_rows: int = 20_000, trees: int = 24,
        depth: int = 3, penalty: float = 5e-4, seed: int = 7) -> RuleModel:
    """Fit on labelled rows of ``docs`` (joined on ``key``), at most about ``max_rows`` of them.

    The bound is on the fitting sample only and picks rows by a hash of key and text, the
    same ones every run; labels other than 0 and 1 are ignored, a key labelled
    both ways teaches both, a null key joins nothing.  With no label, or one label
    alone, the model is a constant (0.5, or that label's side); so it is, with the share of the
    labels, where no statistic tells them apart.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(
        F.col(key).alias("_k"), F.col(label).cast("double").alias("label")).distinct()
    n = known.count()
    slot = F.pmod(F.xxhash64("_k", F.lit(seed)), F.lit(1 << 30))
    picked = known.where(slot < min(1.0, max_rows / max(n, 1)) * float(1 << 30))
    rows = docs.select(F.col(key).alias("_k"), "text").join(picked, "_k").dropDuplicates()
    # a bounded number of small rows: few partitions, or every pass is only task starts
    sample = stage(with_stats(rows).select("stats", "row.label"), "quality-sample").coalesce(4)
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return RuleModel({0.0: -4.0, 1.0: 4.0}[next(iter(seen))] if seen else 0.0)
    stats = array_to_vector(F.array(*[F.col(f"stats.{s}") for s in STATS]))
    grown = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt",
                                   maxBins=64).fit(sample.select(stats.alias("features"), "label"))
    rules = tree_rules(grown)
    if not rules:  # no statistic tells the labels apart
        return RuleModel(math.log(seen[1.0] / seen[0.0]))
    fired = array_to_vector(F.array(*[fires(r).cast("double") for r in rules]))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False,
                               aggregationDepth=2)
    table = stage(sample.select(fired.alias("features"), "label"), "quality-rules")
    fitted = lasso.fit(table)
    weights = fitted.coefficients.toArray()
    kept = [Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6]
    return RuleModel(float(fitted.intercept), kept)


def score(docs: DataFrame, model: RuleModel, threshold: float = 0.7) -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 when score >= threshold, else 0).

    Null and empty texts are scored by their all-zero statistics; repeated rows get equal
    scores; columns named score or predicted are replaced, all others pass through;
    no rows give no rows.
    """
    names = ("score", "predicted")
    scored = with_stats(docs).select("row", model.score().alias("score"))
    return scored.select(*given_back(docs, "row", *names), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
