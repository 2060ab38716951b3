"""A text classifier trained with Spark ML."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.functions import lexicons
from verbatide.functions import scoring as S
from verbatide.storage import cut_lineage, scratch_path


def train_text_classifier(
    train: DataFrame,
    text: str = "sentence",
    label: str = "label",
    epochs: int = 20,
    buckets: int = 1 << 16,
    regularization: float = 0.01,
    tree_depth: int = 2,
) -> PipelineModel:
    """Hashed word counts, weighted by rarity, into a logistic regression.

    The size of the model depends on ``buckets`` alone, not on the vocabulary.
    Training passes over its input once per epoch, so the hashed counts are stored
    first, not the texts; gradients are summed in a tree. More executors: raise
    ``tree_depth``. A null text counts as empty; rows without label are left out
    (unlabelled_count tells how many).
    """
    rows = train.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("double").alias("label")
    ).filter(F.col("label").isNotNull())
    tokenizer = RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}]+")
    hashing = HashingTF(inputCol="words", outputCol="counts", numFeatures=buckets)
    counts = cut_lineage(hashing.transform(tokenizer.transform(rows)).select("counts", "label"))
    rarity = IDF(inputCol="counts", outputCol="features").fit(counts)
    regression = LogisticRegression(
        maxIter=epochs, regParam=regularization, aggregationDepth=tree_depth,
        featuresCol="features", labelCol="label",
    ).fit(rarity.transform(counts))
    # A fitted model's summary holds its session, which does not travel to the tasks once
    # it has observed a query; what is stored and read again has the weights and settings.
    path = scratch_path(counts.sparkSession, "regression")
    regression.write().save(path)
    regression = LogisticRegressionModel.read().session(counts.sparkSession).load(path)
    return PipelineModel([tokenizer, hashing, rarity, regression])


def unlabelled_count(train: DataFrame, label: str = "label") -> int:
    """Rows that training leaves out."""
    return train.filter(F.col(label).isNull()).count()


def save_model(model: PipelineModel, path: str) -> None:
    """Weights, settings and tokenizer lie together below one path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def add_logits(df: DataFrame, model: PipelineModel, text: str = "sentence") -> DataFrame:
    """The log-odds of the positive class for every row; other columns are kept."""
    kept = df.columns
    prepared = df.withColumn("_source", F.struct(*kept)).select(
        "_source", F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return model.transform(prepared).select(
        "_source.*", vector_to_array("rawPrediction")[1].alias("logit")
    )


def score_with_classifier(
    df: DataFrame,
    model: PipelineModel,
    text: str = "text",
    out: str = "sentiment_result",
    name: str = lexicons.TFIDF_MODEL,
) -> DataFrame:
    """The common result struct from a trained classifier, null where text is null."""
    result = S.expand_probabilities(
        S.logit_label("logit"), S.logit_percent("logit"), name
    )
    return (
        add_logits(df, model, text)
        .withColumn(out, F.when(F.col(text).isNotNull(), result))
        .drop("logit")
    )
