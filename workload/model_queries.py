"""Clustering and the text classifier (M, A10, U4). What an iterative fit gives differs
between engines; its properties, which SQL can state, do not."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from verbatide.operators import classifier as C
from verbatide.operators import clustering as L
from verbatide.operators import epochs as T
from verbatide.operators import evaluation as V
from verbatide.operators.subwords import SubwordEncoder
from verbatide.storage import cut_lineage, scratch_path
from workload import fixtures as X
from workload.oracle import using
from workload.registry import query
from workload.storage_queries import LABELLED


@query(
    "m1_scaled_features",
    using(
        "scored",
        "select id, "
        + ", ".join(
            f"round({name} / (select stddev_samp({name}) from scored), 6) as scaled_{name}"
            for name in L.FEATURES
        )
        + " from scored",
    ),
)
def m1_scaled(spark, sf_dir):
    df = cut_lineage(X.scored(spark, sf_dir).select("id", *L.FEATURES))
    deviations = L.feature_deviations(df, L.FEATURES).first().asDict()
    return L.scale_features(df, L.FEATURES, deviations).select(
        "id",
        *[F.round(f"scaled_{name}", 6).alias(f"scaled_{name}") for name in L.FEATURES],
    )


CLUSTERS = 3


def squared_distances(fitted):
    """Of a row from each centre, in scaled units."""
    scaled = [
        F.col(name) / fitted.deviations[name] if fitted.deviations[name] else F.lit(0.0)
        for name in fitted.features
    ]
    return [
        sum((F.pow(x - F.lit(float(c)), 2) for x, c in zip(scaled, centre)), F.lit(0.0))
        for centre in fitted.model.clusterCenters()
    ]


def own_distance(fitted):
    return F.element_at(F.array(*squared_distances(fitted)), F.col("cluster") + 1)


def nearest_violations(fitted):
    """Rows that lie nearer to another centre than to that of their cluster."""
    apart = squared_distances(fitted)
    return F.count_if(own_distance(fitted) > F.least(*apart) + 1e-9) if len(apart) > 1 else F.lit(0)


@query(
    "m1_cluster_sentiment_features",
    using(
        "scored",
        f"""select count(*) as rows, count(distinct id) as ids, 0::bigint as violations,
        {CLUSTERS}::bigint as clusters, true as halves_spread from scored""",
    ),
)
def m1(spark, sf_dir):
    """Every row is in the cluster of its nearest centre, and distances within clusters add
    up to less than half of those from the mean of all."""
    rows = cut_lineage(X.scored(spark, sf_dir).select("id", "sentiment", *L.FEATURES))
    fitted = L.fit_clusters(rows, CLUSTERS)
    varying = sum(1 for value in fitted.deviations.values() if value)
    # Scaled columns have a sample variance of one.
    whole = F.lit(varying) * (F.count("*") - 1)
    return fitted.assign(rows).agg(
        F.count("*").alias("rows"),
        F.count_distinct("id").alias("ids"),
        nearest_violations(fitted).alias("violations"),
        F.count_distinct("cluster").alias("clusters"),
        (F.sum(own_distance(fitted)) < whole / 2).alias("halves_spread"),
    )


@query(
    "m2_cluster_centers",
    using(
        "scored",
        f"""select feature, {CLUSTERS}::bigint as clusters, 0.0::double as off_mean
        from (select unnest({list(L.FEATURES)}) as feature), (select count(*) from scored)""",
    ),
)
def m2(spark, sf_dir):
    """By feature: the largest distance of a centre from the mean of its cluster's rows."""
    fitted = L.fit_clusters(X.scored(spark, sf_dir), CLUSTERS)
    values = fitted.assign(fitted.profile).select(
        "cluster",
        "rows",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("x")) for n in fitted.features])
        ).alias("v"),
    )
    means = values.groupBy("cluster", "v.feature").agg(
        (F.sum(F.col("rows") * F.col("v.x")) / F.sum("rows")).alias("mean")
    )
    return (
        fitted.centers()
        .join(means, ["cluster", "feature"], "left")
        .groupBy("feature")
        .agg(
            F.count("*").alias("clusters"),
            F.round(F.max(F.abs(F.col("unscaled") - F.col("mean"))), 6).alias("off_mean"),
        )
    )


@query(
    "a10_cluster_sentiment",
    using(
        "scored",
        f"""select sentiment, count(*) as count, {CLUSTERS}::bigint as clusters
        from scored group by sentiment""",
    ),
)
def a10(spark, sf_dir):
    # Over all clusters; which cluster is which depends on the fit.
    counts = L.fit_clusters(X.scored(spark, sf_dir), CLUSTERS).counts()
    clusters = counts.agg(F.count_distinct("cluster").alias("clusters"))
    return counts.groupBy("sentiment").agg(F.sum("count").alias("count")).crossJoin(clusters)


def split(spark, sf_dir):
    """Training and held-out rows; together they are all labelled documents."""
    rows = X.labelled(spark, sf_dir)
    held_out = F.col("doc_id") % 5 == 0
    return rows.filter(~held_out), rows.filter(held_out)


@query(
    "m3_train_text_classifier",
    LABELLED + """select count(*) as rows, count(label) as labelled, 0::bigint as differences
    from labelled""",
)
def m3(spark, sf_dir):
    """Logits recomputed from the model's own weights and the hashed counts agree."""
    train, _ = split(spark, sf_dir)
    model = C.train_text_classifier(train)
    tokenizer, hashing, rarity, regression = model.stages
    weights = regression.coefficients.toArray() * rarity.idf.toArray()
    base = float(regression.intercept)
    dot = F.udf(lambda v: base + float(weights[v.indices] @ v.values), "double")
    rows = C.add_logits(X.labelled(spark, sf_dir), model).withColumn(
        "text", F.coalesce("sentence", F.lit(""))
    )
    again = hashing.transform(tokenizer.transform(rows)).withColumn("again", dot("counts"))
    return again.agg(
        F.count("*").alias("rows"),
        F.count("label").alias("labelled"),
        F.count_if(F.abs(F.col("again") - F.col("logit")) > 1e-6).alias("differences"),
    )


@query(
    "m3_epoch_training",
    LABELLED + """select 2::bigint as epochs, count(label) filter (doc_id % 5 <> 0) as rows,
    count(label) filter (doc_id % 5 = 0) as judged, true as kept_by_rule,
    true as no_worse_than_majority from labelled""",
)
def m3_epochs(spark, sf_dir):
    """Each epoch sees every row, the model that lies at the path is that of T4's epoch,
    and its plain accuracy is not below the larger class's share."""
    train, held_out = split(spark, sf_dir)
    path = scratch_path(spark, "epochs")
    runs = T.train_by_epochs(
        train, held_out, path, epochs=2, rate=0.02, exchanges=1, maxlen_train=128,
        maxlen_validation=256, words=5000,
    )
    logits = cut_lineage(
        C.load_model(path).transform(held_out.filter("label is not null")).select("doc_id", "logit", "label")
    )
    again = V.batched_evaluation(logits, "doc_id").select(F.col("accuracy").alias("again"))
    judged = logits.agg(
        F.count("*").alias("judged"),
        F.avg(((F.col("logit") > 0) == (F.col("label") == 1)).cast("int")).alias("plain"),
        F.avg("label").alias("share"),
    )
    seen = runs.agg(F.count("*").alias("epochs"), F.min("rows").alias("rows"), F.max("rows").alias("most"))
    last = runs.filter("saved").agg(F.max("epoch").alias("last"))
    chosen = T.saved_epoch(runs).select(F.col("epoch").alias("chosen"), "accuracy")
    # Each of these has one row.
    return seen.crossJoin(last).crossJoin(chosen).crossJoin(again).crossJoin(judged).select(
        "epochs",
        F.when(F.col("rows") == F.col("most"), F.col("rows")).alias("rows"),
        "judged",
        ((F.col("last") == F.col("chosen")) & (F.col("accuracy") == F.col("again"))).alias("kept_by_rule"),
        (F.col("plain") >= F.greatest("share", 1 - F.col("share"))).alias("no_worse_than_majority"),
    )


@query(
    "m4_save_load_encoder",
    LABELLED + "select count(*) as rows, 0::bigint as mismatches, 4 as first_id from labelled",
)
def m4_encoder(spark, sf_dir):
    """Pieces and settings are saved with the model: another session encodes alike."""
    rows = X.labelled(spark, sf_dir)
    model = Pipeline(stages=[SubwordEncoder(inputCol="sentence", maxlen=64, words=2000)]).fit(rows)
    before, path = scratch_path(spark, "ids"), scratch_path(spark, "encoder")
    C.save_model(model, path)
    model.transform(rows).write.parquet(before)
    loaded = PipelineModel.read().session(spark.newSession()).load(path)
    kept = spark.read.parquet(before).withColumnsRenamed({"input_ids": "ids", "attention_mask": "mask"})
    same = F.col("ids").eqNullSafe(F.col("input_ids")) & F.col("mask").eqNullSafe(F.col("attention_mask"))
    return loaded.transform(kept).agg(
        F.count("*").alias("rows"),
        F.count_if(~same).alias("mismatches"),
        F.min(F.array_min(F.filter("input_ids", lambda i: i > 3))).alias("first_id"),
    )


@query(
    "m4_save_load_model",
    LABELLED + "select count(*) as rows, 0::bigint as mismatches from labelled",
)
def m4(spark, sf_dir):
    rows = X.labelled(spark, sf_dir)
    model = C.train_text_classifier(rows, epochs=5)
    path = scratch_path(spark, "model")
    C.save_model(model, path)
    loaded = C.load_model(path)
    both = C.add_logits(
        C.add_logits(rows, model).withColumnRenamed("logit", "before"), loaded
    )
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("before") != F.col("logit")).alias("mismatches"),
    )


@query(
    "m5_evaluate_model",
    LABELLED + """select count(*) as rows, ceil(count(*) / 32)::bigint as batches,
    true as no_worse_than_majority from labelled where doc_id % 5 = 0""",
)
def m5(spark, sf_dir):
    train, held_out = split(spark, sf_dir)
    model = C.train_text_classifier(train)
    logits = cut_lineage(C.add_logits(held_out, model).select("doc_id", "logit", "label"))
    share = logits.agg(F.count("*").alias("rows"), F.avg("label").alias("share"))
    # Accuracy is the mean of the batches' accuracies: the last, shorter one may count more.
    return V.batched_evaluation(logits, "doc_id").crossJoin(F.broadcast(share)).select(
        "rows",
        "batches",
        (F.col("accuracy") >= F.greatest("share", 1 - F.col("share")) - 0.05).alias(
            "no_worse_than_majority"
        ),
    )


@query(
    "u4_score_classifier",
    using(
        "comments",
        """select count(*) as rows, count(text) as scored, 0::bigint as differences from comments""",
    ),
)
def u4_model(spark, sf_dir):
    """Label and percentage are those of the logit (P20); null texts have no result."""
    train, _ = split(spark, sf_dir)
    model = C.train_text_classifier(train, epochs=5)
    scored = C.score_with_classifier(
        C.add_logits(X.comments(spark, sf_dir), model, "text").withColumnRenamed("logit", "own"), model
    )
    positive = 1 / (1 + F.exp(-F.col("own")))
    percent = F.floor(F.greatest(positive, 1 - positive) * 100 + 1e-9) / 100
    right = (F.col("sentiment_result.sentiment") == F.when(positive > 0.5, "positive").otherwise("negative")) & (
        F.abs(F.col("sentiment_result.confidence") - percent) < 0.011
    )
    return scored.agg(
        F.count("*").alias("rows"),
        F.count("sentiment_result.sentiment").alias("scored"),
        F.count_if(F.col("text").isNotNull() & ~right).alias("differences"),
    )
