"""Quality of click scores, computed as distributed aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.session import materialize


def auc_accuracy(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """One row (auc, accuracy, n) from (score, label 0/1).

    The exact rank-sum area: every pair of a click and a non-click counts 1 if
    the click scores higher and 1/2 on a tie. Equal scores are combined first,
    then ranges of scores are summed in parallel; the last step sees one row
    per range. Without both labels the area is null.
    """
    score = F.col("score")
    values = scores.groupBy("score").agg(
        F.sum(F.col("label").cast("double")).alias("pos"),
        F.sum(1.0 - F.col("label").cast("double")).alias("neg"),
        F.sum(((score >= cutoff).cast("int") == F.col("label").cast("int")).cast("long")).alias("hits"))
    ranged = values.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    below = Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ranged.withColumn("lower", F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
        .groupBy("part").agg(
            F.min("score").alias("start"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
            F.sum("hits").alias("hits"),
            F.sum(F.col("pos") * (F.col("lower") + F.col("neg") / 2)).alias("wins"))
    )
    before = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("neg").over(before), F.lit(0.0))
    wins = parts.withColumn("wins", F.col("wins") + F.col("pos") * offset)
    return wins.agg(
        F.expr("sum(wins) / nullif(sum(pos) * sum(neg), 0)").alias("auc"),
        (F.sum("hits") / F.sum(F.col("pos") + F.col("neg"))).alias("accuracy"),
        F.sum(F.col("pos") + F.col("neg")).cast("long").alias("n"))


def roc_curve(scores: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score.

    Rates count rows scoring at least the threshold. Scores are combined first,
    then ranges of scores are summed in parallel and shifted by what lies above.
    """
    values = scores.groupBy("score").agg(F.sum(F.col("label").cast("double")).alias("pos"),
                                         F.sum(1.0 - F.col("label").cast("double")).alias("neg"))
    ranged = materialize(values.repartitionByRange(F.desc("score")).withColumn("part", F.spark_partition_id()), "roc")
    parts = ranged.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    parts = parts.select("part", F.coalesce(F.sum("p").over(before), F.lit(0.0)).alias("p0"),
                         F.coalesce(F.sum("n").over(before), F.lit(0.0)).alias("n0"),
                         F.sum("p").over(every).alias("p"), F.sum("n").over(every).alias("n"))
    upto = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(parts), "part").select(  # one row per range
        F.col("score").alias("threshold"),
        F.try_divide(F.sum("neg").over(upto) + F.col("n0"), F.col("n")).alias("fpr"),
        F.try_divide(F.sum("pos").over(upto) + F.col("p0"), F.col("p")).alias("tpr"))
