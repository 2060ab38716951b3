"""Quality of a binary classifier from its logits, and choice between runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import scoring as S
from verbatide.operators.ordering import with_row_index
from verbatide.storage import cut_lineage


def accuracy_from_logits(df: DataFrame, logit: str = "logit", label: str = "label") -> DataFrame:
    return df.agg(F.round(F.avg(S.logit_correct(logit, label)), 6).alias("accuracy"))


def batched_evaluation(
    df: DataFrame,
    order_by,
    batch_size: int = 32,
    logit: str = "logit",
    label: str = "label",
) -> DataFrame:
    """Mean of per-batch accuracies, sum of per-batch mean losses, number of batches.

    Batches are consecutive rows in the given total order. Numbering moves the
    three short columns once, by ranges; each batch then lies in one or two
    partitions and its sums combine before they are shuffled.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    # Stored first: numbering sorts by ranges, which samples its input, and a model in
    # front would score every row for that as well.
    numbered = with_row_index(cut_lineage(df.select(*keys, logit, label)), keys, "_row")
    batches = numbered.groupBy(F.floor(F.col("_row") / batch_size).alias("_batch")).agg(
        F.avg(S.logit_correct(logit, label)).alias("_accuracy"),
        F.avg(S.bce_with_logits(logit, label)).alias("_loss"),
    )
    return batches.agg(
        F.round(F.avg("_accuracy"), 6).alias("accuracy"),
        F.round(F.sum("_loss"), 6).alias("loss"),
        F.count("*").alias("batches"),
    )


def select_best_run(
    runs: DataFrame, group_cols=(), epoch: str = "epoch", accuracy: str = "accuracy"
) -> DataFrame:
    """The run to keep: best accuracy above 0, the earliest epoch on a tie."""
    best = F.max(F.struct(F.col(accuracy), (-F.col(epoch)).alias("_before")))
    return (
        runs.filter(F.col(accuracy) > 0)
        .groupBy(*group_cols)
        .agg(best.alias("_best"))
        .filter(F.col("_best").isNotNull())
        .select(
            *group_cols,
            (-F.col("_best._before")).alias(epoch),
            F.col(f"_best.{accuracy}").alias(accuracy),
        )
    )
