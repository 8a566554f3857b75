"""Binary-classifier evaluation and model selection on Spark (ML and aggregations).

* ``stratified_split`` — exact, repeatable split per label by md5 order of a key, without a
  window over a whole label (which would put each label in one task).
* ``confusion`` / ``classification_report`` — one aggregation, rows derived from it.
* ``roc_points`` / ``auc`` — per-score counts, then a distributed running sum.
* ``best_run`` — top-1 with tie-breaks (TakeOrderedAndProject, no sort).
* ``grid_search`` / ``refit`` — Spark ML ``CrossValidator`` over logistic regression or GBT.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.running import running_sums
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.tables import materialize

# Hash buckets for the split histogram: 16^5 ≈ 1M buckets per label bound the boundary bucket
# (the only rows ranked individually) to about n / 1M rows.
SPLIT_HEX_DIGITS = 5
MAX_LABELS_BROADCAST = 100_000


def _key_hash(key_cols: Sequence[str], seed: Any) -> Column:
    """md5 of the key as text: a single key and the seed as they are; of several keys each with its length, NULL marked."""
    text = [F.col(k).cast("string") for k in key_cols]
    if len(text) > 1:
        text = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("N")) for t in text]
    return F.md5(F.concat_ws("|", *text, F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str] | str, test_fraction: float = 0.2,
                     seed: Any = 55, split_col: str = "split") -> DataFrame:
    """Per label, the ``ceil(test_fraction * n_label)`` rows first in ``md5(key|seed)`` order are
    ``test``, the rest ``train``.  Exact and repeatable for a unique key.  Rows with a NULL label
    are a stratum of their own; a NULL key counts as a key.

    Plan: a histogram of rows per (label, hash-prefix bucket) — a partial-aggregated groupBy —
    gives, per label, the bucket where the test quota ends; rows before it are test, after it
    train, and only rows of that one boundary bucket are ranked by a window partitioned by
    (label, bucket).
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    h = df.withColumn("_h", _key_hash(keys, seed)).withColumn(
        "_b", F.conv(F.substring("_h", 1, SPLIT_HEX_DIGITS), 16, 10).cast("long")
    )
    hist = h.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("_cum", F.sum("_c").over(w)).withColumn(
        "_n", F.sum("_c").over(Window.partitionBy(label))
    ).withColumn("_target", F.ceil(F.col("_n") * F.lit(float(test_fraction))))
    boundary = cum.filter((F.col("_cum") - F.col("_c") < F.col("_target")) & (F.col("_target") <= F.col("_cum"))).select(
        F.col(label), F.col("_b").alias("_bb"), (F.col("_target") - (F.col("_cum") - F.col("_c"))).alias("_need")
    )
    # computed once (checkpointed to the shared folder): counted here, joined below
    ensure_checkpoint_dir(df.sparkSession)
    boundary = boundary.checkpoint(eager=True)
    n_labels = boundary.count()  # one row per label that has test rows
    if n_labels <= MAX_LABELS_BROADCAST:
        boundary = F.broadcast(boundary)
    boundary = boundary.withColumnRenamed(label, "_label")
    j = h.join(boundary, F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    rest = j.filter(F.col("_bb").isNull() | (F.col("_b") != F.col("_bb"))).withColumn(
        split_col, F.when(F.col("_b") < F.col("_bb"), F.lit("test")).otherwise(F.lit("train"))
    )
    # Boundary bucket (~n/16^5 rows per label): rows with equal (hash, key) are collapsed first so
    # a duplicated key is one entry; entries are ranked by (hash, key) within the label.
    at = j.filter(F.col("_b") == F.col("_bb"))
    groups = at.groupBy(label, "_h", *keys).agg(F.count(F.lit(1)).alias("_k"), F.first("_need").alias("_need"))
    gw = Window.partitionBy(label).orderBy("_h", *keys).rowsBetween(Window.unboundedPreceding, 0)
    groups = groups.withColumn("_before", F.sum("_k").over(gw) - F.col("_k")).withColumn(
        "_take", F.greatest(F.lit(0), F.least(F.col("_k"), F.col("_need") - F.col("_before")))
    )
    of = {c: f"_g{i}" for i, c in enumerate(dict.fromkeys([label, "_h", *keys]))}
    groups = groups.select(*[F.col(c).alias(g) for c, g in of.items()], F.col("_k"), F.col("_take"))
    at = at.join(groups, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(g)) for c, g in of.items()]), "inner")
    whole = at.filter((F.col("_take") == 0) | (F.col("_take") == F.col("_k"))).withColumn(
        split_col, F.when(F.col("_take") == F.col("_k"), F.lit("test")).otherwise(F.lit("train"))
    )
    # at most one group per label straddles the quota: only its rows are numbered
    row_order = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    sw = Window.partitionBy(label, "_h", *keys).orderBy(row_order)
    straddle = at.filter((F.col("_take") > 0) & (F.col("_take") < F.col("_k"))).withColumn(
        split_col, F.when(F.row_number().over(sw) <= F.col("_take"), F.lit("test")).otherwise(F.lit("train"))
    )
    cols = [F.col(f"`{c}`") for c in df.columns] + [F.col(split_col)]
    return rest.select(*cols).unionByName(whole.select(*cols)).unionByName(straddle.select(*cols))


# --------------------------------------------------------------------------- labels and counts


def predict_class(score: str | Column, threshold: float = 0.5) -> Column:
    """Hard label from a score: 1 when ``score > threshold``."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row ``tp, fp, tn, fn`` (one aggregation)."""
    yc, pc = F.col(y), F.col(yhat)
    return df.agg(
        F.count_if((yc == 1) & (pc == 1)).alias("tp"),
        F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 0) & (pc == 0)).alias("tn"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"),
    )


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def classification_report(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Rows per class ``0``/``1``, ``accuracy``, ``macro avg``, ``weighted avg`` with precision,
    recall, f1_score (0 where undefined) and support; values rounded to 6 places."""
    c = confusion(df, y, yhat)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _safe_div(tp + tn, n)

    def row(label, p, r, f, s):
        rnd = (lambda x: F.round(x, 6).cast("double"))
        return F.struct(F.lit(label).alias("class"), rnd(p).alias("precision"), rnd(r).alias("recall"),
                        rnd(f).alias("f1_score"), s.cast("bigint").alias("support"))

    return c.select(F.inline(F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n),
    )))


def _score_counts(df: DataFrame, y: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (hot scores collapse in the partial aggregate).
    Rows without a score or a label can't be placed on the curve and are left out.

    Checkpointed to the shared folder: the quantile sketch, the range totals and the running
    sums all read it, so the source is scanned once and lineage is cut.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
    g = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )
    return g.checkpoint(eager=True)


def roc_points(df: DataFrame, y: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """ROC curve: ``threshold, tpr, fpr`` per distinct score, thresholds descending.

    Totals are scalar subqueries; cumulative counts use the distributed running sum.
    """
    g = _score_counts(df, y, score)
    cum = running_sums(g, "threshold", ["pos", "neg"], descending=True, n_buckets=n_buckets)
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P = tot.select("P").scalar()
    N = tot.select("N").scalar()
    return cum.select(
        "threshold",
        F.round(F.try_divide(F.col("cum_pos").cast("double"), P), 6).alias("tpr"),
        F.round(F.try_divide(F.col("cum_neg").cast("double"), N), 6).alias("fpr"),
    )


def auc(df: DataFrame, y: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve (trapezoids between consecutive thresholds), one row ``auc``.

    ``sum(neg_s * (2 * cum_pos_s - pos_s)) / (2 * P * N)``; on hard 0/1 scores this is
    ``(TPR + TNR) / 2``.
    """
    g = _score_counts(df, y, score)
    cum = running_sums(g, "threshold", ["pos", "neg"], descending=True, n_buckets=n_buckets)
    return cum.agg(
        F.round(
            F.try_divide(
                F.sum(F.col("neg").cast("double") * (F.lit(2.0) * F.col("cum_pos") - F.col("pos"))),
                F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
            ),
            6,
        ).alias("auc")
    )


def hard_label_metrics(df: DataFrame, y: str, yhat: str, by: Iterable[str] = ()) -> DataFrame:
    """Per group: ``auc`` = (TPR + TNR) / 2 and ``accuracy`` from hard labels (one aggregation)."""
    yc, pc = F.col(y), F.col(yhat)
    g = df.groupBy(*by).agg(
        F.count_if((yc == 1) & (pc == 1)).alias("tp"), F.count_if(yc == 1).alias("p"),
        F.count_if((yc == 0) & (pc == 0)).alias("tn"), F.count_if(yc == 0).alias("n"),
    )
    tpr = F.try_divide(F.col("tp").cast("double"), F.col("p"))
    tnr = F.try_divide(F.col("tn").cast("double"), F.col("n"))
    return g.select(
        *by,
        F.round((tpr + tnr) / 2, 6).alias("auc"),
        F.round(F.try_divide((F.col("tp") + F.col("tn")).cast("double"), F.col("p") + F.col("n")), 6).alias("accuracy"),
    )


def best_run(runs: DataFrame, auc_col: str = "auc", acc_col: str = "accuracy", order_col: str = "run_id") -> DataFrame:
    """Top run: highest AUC, then highest accuracy, then first in ``order_col`` (TakeOrderedAndProject)."""
    return runs.orderBy(F.col(auc_col).desc_nulls_last(), F.col(acc_col).desc_nulls_last(), F.col(order_col).asc()).limit(1)


# --------------------------------------------------------------------------- grid search (Spark ML)

# The documented grids (fixed values), in Spark's terms.
PENALTIES = ("l1", "l2", "elasticnet")
INVERSE_STRENGTHS = (0.001, 0.01, 0.1, 1, 10, 100)
LEARNING_RATES = (0.01, 0.05, 0.1)
BOOSTING_ROUNDS = (50, 100, 150)
#: Depths 16, 24, 31 and 40 and leaves 31, 40 and 80 have no equivalent as they are: Spark grows whole levels, to a depth
#: of 30 at most.  A tree of 31, 40 or 80 leaves needs a depth of 5, 6 or 7.
TREE_DEPTHS = (5, 6, 7)


def penalty_c_grid(penalties: Sequence[str], Cs: Sequence[float], n_train: int) -> dict:
    """Map a penalty/C grid to Spark: l2 → elasticNet 0, l1 → 1, elasticnet → 0.5; regParam = 1/(C·n)."""
    en = {"l2": 0.0, "l1": 1.0, "elasticnet": 0.5}
    return {"regParam": sorted({1.0 / (c * n_train) for c in Cs}), "elasticNetParam": sorted({en[p] for p in penalties})}


def default_grid(model: str, n_train: int) -> dict:
    """The documented grid of a model: 18 combinations of the logistic regression, 27 of the boosted trees."""
    if model == "log_reg":
        return penalty_c_grid(PENALTIES, INVERSE_STRENGTHS, max(n_train, 1))
    if model == "gbt":
        return {"stepSize": list(LEARNING_RATES), "maxIter": list(BOOSTING_ROUNDS), "maxDepth": list(TREE_DEPTHS)}
    raise ValueError(f"unknown model {model!r}")


def with_folds(df: DataFrame, key: str | Sequence[str], folds: int, seed: Any = 55, name: str = "fold") -> DataFrame:
    """A fold (0 to ``folds`` - 1) from the hash of the row's key: the same at any partitioning, engine and run."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(name, F.pmod(F.conv(F.substring(_key_hash(keys, seed), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int"))


def _estimator(model: str, features: str, label: str, seed: int):
    from pyspark.ml.classification import GBTClassifier, LogisticRegression

    if model == "log_reg":
        return LogisticRegression(featuresCol=features, labelCol=label, maxIter=500)
    if model == "gbt":
        return GBTClassifier(featuresCol=features, labelCol=label, seed=seed)
    raise ValueError(f"unknown model {model!r}")


def _to_fit(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows, written once and read in a session of their own with the settings of the frame's.

    A fitted logistic regression holds its training summary, which names the session of its rows and goes to the
    tasks with the model; a session that has observed metrics (``DataFrame.observe``) can't be sent there.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "fit")
    if set(columns) <= set(rows.columns):  # a feature may also name a nested field
        rows = rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)])
    schema = materialize(rows, path).schema
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    return own.read.schema(schema).parquet(path)


def _fit_by_folds(cv, rows: DataFrame):
    """What ``cv.fit`` does, with the folds of the column ``_fold`` (``foldCol`` would ask a Python function for every row):
    folds are plain filters on the rows."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.tuning import CrossValidatorModel

    est, maps, evaluator = cv.getEstimator(), cv.getEstimatorParamMaps(), cv.getEvaluator()
    scores = [[0.0] * cv.getNumFolds() for _ in maps]
    tasks = [(i, j) for j in range(cv.getNumFolds()) for i in range(len(maps))]

    def one(task):
        i, j = task
        fitted = est.fit(rows.where(F.col("_fold") != j), maps[i])
        scores[i][j] = evaluator.evaluate(fitted.transform(rows.where(F.col("_fold") == j)))

    with ThreadPool(min(cv.getParallelism(), len(tasks))) as pool:
        pool.map(inheritable_thread_target(rows.sparkSession)(one), tasks)
    means = [sum(s) / len(s) for s in scores]
    best = est.fit(rows, maps[max(range(len(maps)), key=means.__getitem__)])
    spread = [(sum((x - m) ** 2 for x in s) / len(s)) ** 0.5 for s, m in zip(scores, means)]
    return cv._copyValues(CrossValidatorModel(best, means, None, spread))


def grid_search(df: DataFrame, feature_cols: Sequence[str], label: str, model: str = "log_reg",
                grid: Mapping[str, Sequence] | None = None, folds: int = 5, seed: int = 55, parallelism: int = 4,
                key: str | Sequence[str] | None = None):
    """K-fold cross-validated grid search; returns ``(cv_model, results_frame)``.

    ``results_frame`` has one row per parameter combination: params as text and mean AUC.  ``grid`` defaults to
    :func:`default_grid`.  With ``key`` the folds come from the key (:func:`with_folds`), so the search doesn't
    depend on how the rows are partitioned; without it Spark deals the rows at random.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    est = _estimator(model, "_features", label, seed)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="_features"), est])
    builder = ParamGridBuilder()
    for name, values in (grid or default_grid(model, df.count())).items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, seed=seed, parallelism=parallelism)
    rows = df.withColumn(label, F.col(label).cast("double"))
    if key is None:
        cvm = cv.fit(_to_fit(rows, [*feature_cols, label]))
    else:
        cvm = _fit_by_folds(cv, _to_fit(with_folds(rows, key, folds, seed, "_fold"), [*feature_cols, label, "_fold"]))
    rows = [
        (model, ",".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(metric))
        for m, metric in zip(maps, cvm.avgMetrics)
    ]
    res = df.sparkSession.createDataFrame(rows, "model string, params string, mean_auc double")
    return cvm, res


def refit(df: DataFrame, feature_cols: Sequence[str], label: str, model: str, params: Mapping[str, Any], seed: int = 55):
    """Fit the chosen model with the best parameters on all rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    est = _estimator(model, "_features", label, seed)
    for k, v in params.items():
        est.set(est.getParam(k), v)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(feature_cols), outputCol="_features"), est])
    return pipe.fit(_to_fit(df.withColumn(label, F.col(label).cast("double")), [*feature_cols, label]))


def positive_probability(pred: DataFrame, name: str = "score") -> DataFrame:
    """Probability of class 1 from a fitted model's output, as a plain double column."""
    from pyspark.ml.functions import vector_to_array

    return pred.withColumn(name, vector_to_array(F.col("probability"))[1])
