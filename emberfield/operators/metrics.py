"""Evaluation of prediction tables (label column, probability column).

Ranking metrics work on counts per distinct score with distributed running totals;
ties move in one step, as exact average precision and ROC area require.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfield.operators.ordering import running_sums
from emberfield.operators.quality import QualityError, require_no_rows
from emberfield.session import durable

EPS = 1e-12


def _eps(x: Column) -> Column:
    return x + F.lit(EPS)


def confusion_counts(df: DataFrame, label: str, prob: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    pred, actual = F.col(prob) >= threshold, F.col(label) >= 0.5
    return df.groupBy(*(by or [])).agg(
        F.count_if(pred & actual).alias("tp"), F.count_if(pred & ~actual).alias("fp"),
        F.count_if(~pred & actual).alias("fn"), F.count_if(~pred & ~actual).alias("tn"),
    )


def climatology_baseline(df: DataFrame, label: str, beta: float = 2.0) -> DataFrame:
    """Scores without skill: the base rate, and calling every cell positive."""
    n = F.count(F.lit(1))
    rate = F.when(n > 0, F.count_if(F.col(label) >= 0.5) / n).otherwise(F.lit(0.0))
    b2 = beta**2
    return df.agg(rate.alias("base_rate")).select(
        "base_rate", F.col("base_rate").alias("pr_auc_no_skill"),
        F.col("base_rate").alias("always_positive_precision"), F.lit(1.0).alias("always_positive_recall"),
        ((1 + b2) * F.col("base_rate") / _eps(b2 * F.col("base_rate") + 1)).alias(f"always_positive_f{beta:g}"),
    )


def score_curve(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Per distinct score, highest first: counts and running totals of rows and positives."""
    per_score = df.groupBy(F.col(prob).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) >= 0.5).alias("pos")
    )
    return running_sums(per_score.withColumn("_d", -F.col("score")), ["_d"], {"cum_n": "n", "cum_pos": "pos"}).drop("_d")


def ranking_metrics(curve: DataFrame) -> DataFrame:
    """Average precision and ROC area from a score curve; NULL when one class is absent."""
    totals = curve.agg(F.struct(F.sum("pos").alias("p"), F.sum("n").alias("n"))).scalar()
    c = curve.withColumn("_t", totals)
    p, n = F.col("_t.p").cast("double"), F.col("_t.n").cast("double")
    both = (p > 0) & (p < n)
    precision = F.col("cum_pos") / F.col("cum_n")
    above = F.col("cum_pos") - F.col("pos") / F.lit(2.0)
    return c.agg(
        F.sum(F.when(both, F.col("pos") / p * precision)).alias("pr_auc"),
        F.sum(F.when(both, (F.col("n") - F.col("pos")) * above / p / (n - p))).alias("roc_auc"),
    )


def compute_metrics(df: DataFrame, label: str, prob: str, threshold: float, beta: float = 2.0) -> DataFrame:
    """One row with counts, calibration, thresholded and ranking metrics."""
    b2 = beta**2
    # every count and the squared error come from the table of distinct scores
    curve = score_curve(df, label, prob)
    over = F.col("score") >= threshold
    neg = F.col("n") - F.col("pos")
    base = curve.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_cells"), F.coalesce(F.sum("pos"), F.lit(0)).alias("n_positive"),
        F.coalesce(F.sum(F.when(over, F.col("pos"))), F.lit(0)).alias("tp"), F.coalesce(F.sum(F.when(over, neg)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~over, F.col("pos"))), F.lit(0)).alias("fn"), F.coalesce(F.sum(F.when(~over, neg)), F.lit(0)).alias("tn"),
        (F.sum(F.col("pos") * F.pow(F.col("score") - 1, 2) + neg * F.col("score") * F.col("score")) / F.sum("n")).alias("brier"),
    )
    rank = ranking_metrics(curve).select(F.struct("*")).scalar()
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = base.withColumn("_r", rank).withColumns({
        "threshold": F.lit(float(threshold)), "beta": F.lit(float(beta)),
        "degenerate": (F.col("n_positive") == 0) | (F.col("n_positive") == F.col("n_cells")),
        "positive_rate": F.when(F.col("n_cells") > 0, F.col("n_positive") / F.col("n_cells")).otherwise(0.0),
    })

    def defined(c: Column) -> Column:
        return F.when(~F.col("degenerate"), c)

    out = out.withColumns({"precision": defined(tp / _eps(tp + fp)), "recall": defined(tp / _eps(tp + fn))})
    pr, rc = F.col("precision"), F.col("recall")
    return out.withColumns({
        f"f{beta:g}": (1 + b2) * pr * rc / _eps(b2 * pr + rc),
        "f1": 2 * pr * rc / _eps(pr + rc),
        "iou": defined(tp / _eps(tp + fp + fn)),
        "pr_auc": F.col("_r.pr_auc"), "roc_auc": F.col("_r.roc_auc"),
        "skill": F.when(F.col("positive_rate") > 0, F.col("_r.pr_auc") / F.col("positive_rate")),
    }).drop("_r")


def find_best_threshold(df: DataFrame, label: str, prob: str, beta: float = 2.0) -> DataFrame:
    """Threshold with the largest F-beta, the lowest on ties; 0.5 and NULL when one class is absent."""
    b2 = beta**2
    curve = score_curve(df, label, prob)
    totals = curve.agg(F.struct(F.sum("pos").alias("p"), F.sum("n").alias("n"))).scalar()
    c = curve.withColumn("_t", totals)
    precision = F.col("cum_pos") / F.col("cum_n")
    recall = F.col("cum_pos") / F.col("_t.p")
    f = (1 + b2) * precision * recall / _eps(b2 * precision + recall)
    both = (F.col("_t.p") > 0) & (F.col("_t.p") < F.col("_t.n"))
    best = c.agg(F.max(F.when(both, F.struct(f.alias("f"), (-F.col("score")).alias("neg")))).alias("b"))
    return best.select(
        F.coalesce(-F.col("b.neg"), F.lit(0.5)).alias("threshold"), F.col("b.f").alias(f"f{beta:g}")
    )


def flatten_valid(predictions: DataFrame, labels: DataFrame, mask: DataFrame, keys: list[str], cell: list[str]) -> DataFrame:
    """Label and probability of the valid cells; both tables must cover the same keys.

    Both meet once in a full join, whose stored result is checked and returned.
    """
    valid_p = predictions.join(mask, cell, "left_semi").withColumn("_p", F.lit(True))
    valid_y = labels.join(mask, cell, "left_semi").withColumn("_y", F.lit(True))
    both = durable(valid_p.join(valid_y, keys, "full_outer"))
    no_label, no_prediction = both.agg(F.count_if(F.col("_y").isNull()), F.count_if(F.col("_p").isNull())).first()
    if no_label or no_prediction:
        raise QualityError(f"shape mismatch: {no_label} predictions without label, {no_prediction} labels without prediction")
    return both.drop("_p", "_y")


def regression_metrics(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """MAE, RMSE and MAPE per named (actual, predicted) pair and over all of them."""
    errors = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.col(a).cast("double").alias("a"), F.col(p).cast("double").alias("p"))
        for name, (a, p) in pairs.items()
    ])).alias("e")).select("e.*")
    err = F.col("a") - F.col("p")
    stats = [
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(err / (F.col("a") + F.lit(1e-8)))) * 100).alias("mape"),
    ]
    # per feature first; the overall row then needs no second pass over the data
    return errors.rollup("feature").agg(*stats).select(
        F.coalesce("feature", F.lit("overall")).alias("feature"), "mae", "rmse", "mape"
    )


def class_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: accuracy, binary and macro scores and the confusion matrix; empty input raises."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    require_no_rows(row.where("n = 0"), "no rows to evaluate")

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = row.withColumns({
        "accuracy": ratio(tp + tn, F.col("n")), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn), "precision_0": ratio(tn, tn + fn), "recall_0": ratio(tn, tn + fp),
        "f1_0": ratio(2 * tn, 2 * tn + fn + fp),
    })
    return out.withColumn("macro_f1", (F.col("f1") + F.col("f1_0")) / 2)


def evaluation_summary(df: DataFrame, split: str, label: str, prob: str, threshold: float = 0.5) -> DataFrame:
    """Per split: ROC area, thresholded scores and the false alarm rate."""
    per = df.groupBy(split, F.col(prob).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) >= 0.5).alias("pos")
    )
    per = per.withColumn("_d", -F.col("score"))
    cum = running_sums(per, [split, "_d"], {"cum_pos": "pos"})
    totals = per.groupBy(split).agg(F.sum("pos").alias("p"), F.sum("n").alias("t"))
    start = cum.groupBy(split).agg(F.min(F.col("cum_pos") - F.col("pos")).alias("_before"))
    c = cum.join(totals.join(start, split), split)
    inside = F.col("cum_pos") - F.col("_before")
    p, n = F.col("p").cast("double"), (F.col("t") - F.col("p")).cast("double")
    auc = c.groupBy(split).agg(
        F.sum(F.when((p > 0) & (n > 0), (F.col("n") - F.col("pos")) * (inside - F.col("pos") / 2.0) / p / n)).alias("roc_auc")
    )
    k = confusion_counts(df, label, prob, threshold, [split])
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return k.join(auc, split).withColumns({
        "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "false_alarm_rate": ratio(fp, fp + tn),
    })


def auc_gap(summary: DataFrame, split: str, first: str, second: str, limit: float = 0.02) -> DataFrame:
    """Difference of the ROC areas of two splits and whether it stays below the limit."""
    def area(name: str) -> Column:
        return F.max(F.when(F.col(split) == name, F.col("roc_auc")))

    return summary.agg(F.abs(area(first) - area(second)).alias("auc_gap")).withColumn("stable", F.col("auc_gap") < limit)


def loss_terms(
    df: DataFrame, label: str, logit: str, alpha: float = 0.85, gamma: float = 2.0,
    tversky: tuple[float, float, float] = (0.3, 0.7, 1e-6),
) -> DataFrame:
    """Focal and Tversky loss of raw scores (logits), and their squared error, over valid cells."""
    y, z = F.col(label).cast("double"), F.col(logit)
    prob = 1 / (1 + F.exp(-z))
    bce = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    pt = prob * y + (1 - prob) * (1 - y)
    weight = (alpha * y + (1 - alpha) * (1 - y)) * F.pow(1 - pt, F.lit(gamma))
    a, b, smooth = tversky
    tp, fp, fn = F.sum(prob * y), F.sum(prob * (1 - y)), F.sum((1 - prob) * y)
    return df.agg(
        F.avg(weight * bce).alias("focal"),
        (1 - (tp + smooth) / (tp + a * fp + b * fn + smooth)).alias("tversky"),
        F.avg((z - y) * (z - y)).alias("mse"),
    )
