"""The integrated run: enriched comments, features, predictions, analysis, records."""

from pyspark.sql import DataFrame, SparkSession

from verbatide.operators.preprocess import preprocess_enriched
from verbatide.operators.sentiment import attach_predictions, score_rules
from verbatide.plans.report import results_analysis
from verbatide.sinks.tables import save_json, save_records
from verbatide.sources.files import scan_enriched
from verbatide.storage import cut_lineage, scratch_path


def run_integrated(
    spark: SparkSession, comments: str, output: str, scorer=score_rules, report: bool = True
) -> DataFrame:
    """Scan, prepare, score, join the predictions, analyse, save; the scored comments.

    ``scorer`` takes prepared comments and adds ``sentiment_label`` and
    ``confidence_score``; both are joined by id, as predictions made elsewhere would be.
    Predictions are stored, so that no comment is scored twice, and so are the joined
    comments, so that texts are shuffled once for all that is made of them.
    """
    prepared = scan_enriched(spark, comments).transform(preprocess_enriched)
    predictions = cut_lineage(
        scorer(prepared.drop("sentiment_label", "confidence_score")).select(
            "id", "sentiment_label", "confidence_score"
        )
    )
    path = scratch_path(spark, "scored")
    joined = attach_predictions(prepared, predictions)
    joined.write.parquet(path)
    scored = spark.read.schema(joined.schema).parquet(path)
    analysis = cut_lineage(results_analysis(scored))
    save_records(scored, analysis, output.rstrip("/"))
    if report:
        save_json(analysis, f"{output.rstrip('/')}/report", single_file=True)
    return scored
