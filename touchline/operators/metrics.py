"""Evaluation of stored predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ordered import top_k_per_group

PROBS = {"H": "prob_home_win", "D": "prob_draw", "A": "prob_away_win"}


def resolve_predictions(predictions: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Predictions with ``actual_result`` and ``was_correct`` (both NULL while the match is open)."""
    actual = fixtures.select("fixture_id", F.col("result").alias("actual_result"))
    return predictions.join(actual, "fixture_id", "left").withColumn(
        "was_correct", F.col("predicted_result") == F.col("actual_result")
    )


def auc_by_class(resolved: DataFrame, ranges: int = 1024) -> DataFrame:
    """One-vs-rest AUC per model version and class, ties counted half.

    Counts per exact score come first. Scores are then ranked inside ``ranges`` equal ranges of [0, 1], with the totals
    of the ranges below as offsets, so no class is sorted in one task.
    """
    scored = resolved.select(
        "model_version",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.col(col).alias("score"),
                        (F.col("actual_result") == label).cast("long").alias("hit"),
                    )
                    for label, col in PROBS.items()
                ]
            )
        ),
    )
    counts = scored.groupBy("model_version", "label", "score").agg(
        F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")
    )
    place = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))) * ranges)
    counts = counts.withColumn("range", place)
    group = ["model_version", "label"]

    def before(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    offsets = counts.groupBy(*group, "range").agg(F.sum("neg").alias("n")).select(
        *group, "range", F.coalesce(F.sum("n").over(before(*group, order="range")), F.lit(0)).alias("offset")
    )
    inside = F.coalesce(F.sum("neg").over(before(*group, "range", order="score")), F.lit(0))
    ranked = counts.withColumn("inside", inside).join(offsets, [*group, "range"]).withColumn("neg_below", F.col("inside") + F.col("offset"))
    return ranked.groupBy("model_version", "label").agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)), (F.sum("pos") * F.sum("neg")).cast("double")
        ).alias("auc")
    )


def model_performance(resolved: DataFrame) -> DataFrame:
    """Log loss, accuracy, Brier score per class and mean one-vs-rest AUC per model version."""
    done = resolved.filter(F.col("actual_result").isNotNull())

    def squared(label: str) -> Column:
        return F.pow(F.col(PROBS[label]) - (F.col("actual_result") == label).cast("double"), 2.0)

    likelihood = (
        F.when(F.col("actual_result") == "H", F.col("prob_home_win"))
        .when(F.col("actual_result") == "D", F.col("prob_draw"))
        .otherwise(F.col("prob_away_win"))
    )
    scores = done.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if("was_correct").alias("correct_predictions"),
        F.avg(F.col("was_correct").cast("double")).alias("accuracy"),
        F.avg(-F.ln(F.greatest(likelihood, F.lit(1e-15)))).alias("log_loss"),
        F.avg(squared("H")).alias("brier_home"),
        F.avg(squared("D")).alias("brier_draw"),
        F.avg(squared("A")).alias("brier_away"),
    )
    auc = auc_by_class(done).groupBy("model_version").agg(F.avg("auc").alias("roc_auc"))
    return scores.join(auc, "model_version", "left")


def confusion_matrix(resolved: DataFrame) -> DataFrame:
    """Counts of predicted labels per actual label."""
    return (
        resolved.filter(F.col("actual_result").isNotNull())
        .groupBy("model_version", "actual_result")
        .agg(*[F.count_if(F.col("predicted_result") == p).alias(f"predicted_{p.lower()}") for p in PROBS])
    )


def accuracy_trend(resolved: DataFrame) -> DataFrame:
    """Monthly and cumulative accuracy per model version; the window runs over months, not predictions."""
    monthly = (
        resolved.filter(F.col("was_correct").isNotNull())
        .groupBy("model_version", F.trunc("match_date", "month").alias("month"))
        .agg(F.count(F.lit(1)).alias("predictions"), F.count_if("was_correct").alias("correct"))
    )
    so_far = Window.partitionBy("model_version").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.withColumns(
        {
            "accuracy": F.col("correct") / F.col("predictions"),
            "cumulative_accuracy": F.sum("correct").over(so_far) / F.sum("predictions").over(so_far),
        }
    )


def drift_check(resolved: DataFrame, n: int = 50, tolerance: float = 0.10) -> DataFrame:
    """Accuracy of the newest ``n`` predictions against the overall accuracy; drifted on a larger drop."""
    done = resolved.filter(F.col("was_correct").isNotNull())
    newest = top_k_per_group(done, ["model_version"], [F.desc("match_date"), F.desc("fixture_id")], n)
    recent = newest.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("recent_n"), F.avg(F.col("was_correct").cast("double")).alias("recent_accuracy")
    )
    overall = done.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("overall_n"), F.avg(F.col("was_correct").cast("double")).alias("overall_accuracy")
    )
    return overall.join(recent, "model_version").withColumn(
        "drifted", F.col("overall_accuracy") - F.col("recent_accuracy") > tolerance
    )


def compare_models(candidate: DataFrame, incumbent: DataFrame) -> DataFrame:
    """Candidate metrics with the incumbent's log loss and the promotion decision.

    Promoted when the log loss is lower, or when there is no incumbent.
    """
    current = incumbent.agg(F.min("log_loss")).scalar()
    decided = candidate.withColumn("current_log_loss", current)
    return decided.withColumn(
        "should_promote", F.col("current_log_loss").isNull() | (F.col("log_loss") < F.col("current_log_loss"))
    )


def register_models(register: DataFrame, metrics: DataFrame, decided: DataFrame) -> DataFrame:
    """Model register with new versions added; a promoted version becomes the only active one."""
    fresh = metrics.join(decided.select("model_version", "should_promote"), "model_version", "left").withColumn(
        "is_active", F.coalesce("should_promote", F.lit(False))
    )
    promoted = fresh.agg(F.max(F.when(F.col("is_active"), F.col("model_version")))).scalar()
    kept = register.join(fresh.select("model_version"), "model_version", "left_anti")
    merged = kept.unionByName(fresh.drop("should_promote"), allowMissingColumns=True).withColumn("_new", promoted)
    return merged.withColumn(
        "is_active",
        F.when(F.col("_new").isNull(), F.col("is_active")).otherwise(F.col("model_version") == F.col("_new")),
    ).drop("_new")
