"""A text classifier trained epoch by epoch, in mini-batches over a barrier stage."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.operators.encoding import PAD
from verbatide.operators.evaluation import batched_evaluation, select_best_run
from verbatide.operators.subwords import SubwordEncoder
from verbatide.storage import scratch_path

# Fixed values of the Adam step.
FIRST_DECAY, SECOND_DECAY, TINY = 0.9, 0.999, 1e-8


class EpochClassifierModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``logit``: the bias and the weights of a row's ids over the root of their
    number. Padding does not count; a row of padding alone has the bias."""

    weights = Param(Params._dummy(), "weights", "one for each id", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "log-odds of a row without ids", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, weights=(), bias=0.0):
        super().__init__()
        self._setDefault(weights=[], bias=0.0)
        self._set(**{k: list(v) if k == "weights" else v for k, v in self._input_kwargs.items()})

    def _transform(self, dataset):
        held, bias, pad = self.getOrDefault("weights"), self.getOrDefault("bias"), PAD

        def logits(column):
            import numpy as np
            import pyarrow as pa

            weights = np.array(held)
            ids = column.flatten().to_numpy()
            row = np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy())
            real = ids != pad
            total = np.bincount(row[real], weights[ids[real]], len(column))
            number = np.bincount(row[real], minlength=len(column))
            return pa.array(bias + total / np.sqrt(np.maximum(number, 1)))

        return dataset.withColumn("logit", F.arrow_udf(logits, "double")("input_ids"))


def epoch_rows(encoded: DataFrame, epoch: int, workers: int, seed: int) -> DataFrame:
    """(input_ids, label) dealt to ``workers`` partitions, in this epoch's order.

    Both follow from the row and the seed alone, so a lost task finds the same rows in
    the same order. Equal rows go to one partition; they are equally good anywhere.
    """
    order = F.xxhash64(F.lit(seed), F.lit(epoch), "input_ids", "label", "key")
    return (
        encoded.withColumn("_order", order)
        .repartition(workers, "_order")
        .sortWithinPartitions("_order", "input_ids", "label")
        .select("input_ids", "label")
    )


def _epoch(start, batch: int, steps: int, rate: float, pad: int):
    """A barrier task's work: one epoch over its rows from the state ``start``.

    A step takes ``batch`` rows. After ``steps`` of them the tasks exchange their
    weights and moments and go on from the mean of those that had rows, by their number
    of rows; all add up in one order and so hold equal states. A task that has run out
    of rows goes on exchanging until all have.
    """
    decay_1, decay_2, tiny = FIRST_DECAY, SECOND_DECAY, TINY

    def run(batches):
        import base64

        import numpy as np
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        # Weights, first and second moments; the bias is the last weight.
        state = np.array(start[0])
        size = state.shape[1]
        step, seen, loss_sum = start[1], 0, 0.0

        def chunks():
            # Batches of Arrow end anywhere; a step's rows may come from several.
            waiting, held = [], 0
            for part in batches:
                waiting.append(part)
                held += part.num_rows
                while held >= batch:
                    table = pa.Table.from_batches(waiting)
                    yield table.slice(0, batch)
                    rest = table.slice(batch)
                    waiting, held = rest.to_batches(), rest.num_rows
            if held:
                yield pa.Table.from_batches(waiting)

        def gradient(weights, table):
            listed = table.column(0).combine_chunks()
            ids = listed.flatten().to_numpy()
            row = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy())
            real = ids != pad
            ids, row = ids[real], row[real]
            scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(listed)), 1))
            logit = weights[-1] + scale * np.bincount(row, weights[ids], len(listed))
            label = table.column(1).to_numpy()
            loss = np.maximum(logit, 0) - logit * label + np.log1p(np.exp(-np.abs(logit)))
            off = 1 / (1 + np.exp(-logit)) - label
            slope = np.bincount(ids, (off * scale)[row], size)
            slope[-1] += off.sum()
            return slope / len(listed), loss.sum()

        own, going = chunks(), True
        while going:
            rows, local, done = 0, state.copy(), step
            for _ in range(steps):
                table = next(own, None)
                if table is None:
                    break
                slope, loss = gradient(local[0], table)
                rows, done, loss_sum = rows + table.num_rows, done + 1, loss_sum + loss
                local[1] = decay_1 * local[1] + (1 - decay_1) * slope
                local[2] = decay_2 * local[2] + (1 - decay_2) * slope * slope
                first, second = local[1] / (1 - decay_1**done), local[2] / (1 - decay_2**done)
                local[0] -= rate * first / (np.sqrt(second) + tiny)
            head = np.array([rows, done], np.float64).tobytes()
            sent = head + (local.tobytes() if rows else b"")
            mean, total = np.zeros_like(state), 0
            for message in context.allGather(base64.b64encode(sent).decode()):
                got = base64.b64decode(message)
                n, reached = (int(x) for x in np.frombuffer(got, np.float64, 2))
                if n:
                    mean += n * np.frombuffer(got, np.float64, offset=16).reshape(state.shape)
                    total, step = total + n, max(step, reached)
            going = total > 0
            if going:
                state, seen = mean / total, seen + total
        losses = [np.frombuffer(base64.b64decode(m))[0] for m in context.allGather(
            base64.b64encode(np.array([loss_sum]).tobytes()).decode()
        )]
        if context.partitionId() == 0:
            listed = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in state]
            counts = [pa.array([step]), pa.array([seen]), pa.array([float(sum(losses))])]
            yield pa.record_batch(
                [*listed, *counts], names=["weights", "first", "second", "step", "rows", "loss"]
            )

    return run


class EpochClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One epoch after another of Adam steps on binary cross-entropy over ``input_ids``.

    ``workers`` tasks run at the same time, so the cluster needs as many free cores. Each
    takes steps of ``batch`` rows; ``exchanges`` times an epoch they meet and go on from
    their mean state. An exchange takes about a second, however many rows lie between
    two. With one worker this is plain training in mini-batches. What a task holds is
    bounded by the number of ids (``size``) and the batch.
    """

    size = Param(Params._dummy(), "size", "number of ids", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    batch = Param(Params._dummy(), "batch", "rows in a step of one worker", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "length of a step", TypeConverters.toFloat)
    workers = Param(Params._dummy(), "workers", "tasks of the barrier stage", TypeConverters.toInt)
    exchanges = Param(Params._dummy(), "exchanges", "meetings in an epoch", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the order in each epoch", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, size=0, epochs=2, batch=32, rate=2e-5, workers=2, exchanges=4, seed=0):
        super().__init__()
        self._setDefault(size=0, epochs=2, batch=32, rate=2e-5, workers=2, exchanges=4, seed=0)
        self._set(**self._input_kwargs)

    def models(self, dataset):
        """(epoch, model, rows, mean loss on the way) after each epoch."""
        get = self.getOrDefault
        workers = get("workers")
        largest = -(-dataset.count() // workers)
        steps = max(1, -(-largest // (get("batch") * get("exchanges"))))
        zeros = [0.0] * (get("size") + 1)
        state = ([zeros] * 3, 0)
        types = (
            "weights array<double>, first array<double>, second array<double>, "
            "step long, rows long, loss double"
        )
        for epoch in range(get("epochs")):
            rows = epoch_rows(dataset, epoch, workers, get("seed"))
            work = _epoch(state, get("batch"), steps, get("rate"), PAD)
            found = rows.mapInArrow(work, types, barrier=True).toArrow().to_pylist()
            # Without rows Spark starts no task.
            weights, first, second = state[0]
            found = found[0] if found else {
                "weights": weights, "first": first, "second": second, "step": state[1], "rows": 0, "loss": 0.0
            }
            state = ([found[k] for k in ("weights", "first", "second")], found["step"])
            model = EpochClassifierModel(weights=found["weights"][:-1], bias=found["weights"][-1])
            yield epoch, model, found["rows"], found["loss"] / max(found["rows"], 1)

    def _fit(self, dataset):
        model = EpochClassifierModel(weights=[0.0] * self.getOrDefault("size"))
        for _, model, _, _ in self.models(dataset):
            pass
        return model


def train_by_epochs(
    train: DataFrame,
    validation: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "sentence",
    label: str = "label",
    epochs: int = 2,
    batch: int = 32,
    rate: float = 2e-5,
    maxlen_train: int = 30,
    maxlen_validation: int = 50,
    words: int = 20_000,
    workers: int = 2,
    exchanges: int = 4,
    seed: int = 0,
) -> DataFrame:
    """Train, validate after each epoch, and keep the strictly best at ``path``.

    Returns the runs: (epoch, rows, train_loss, accuracy, loss, saved). Accuracy and loss
    are those of ``batched_evaluation`` in the order of ``key``. An epoch is saved if its
    accuracy is above that of all before it, and above 0. What is saved is one
    PipelineModel of the word pieces with their settings and the classifier, so
    ``load_model(path)`` encodes and scores alike in any session.

    Rows without label take no part, null texts count as empty. Without a labelled row
    for training all weights stay zero; without one for validation nothing is saved.
    """
    spark = train.sparkSession
    chosen = lambda df: df.filter(F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias(text), F.col(label).cast("double").alias("label")
    )
    train, validation = chosen(train), chosen(validation)
    encoder = SubwordEncoder(inputCol=text, maxlen=maxlen_train, words=words).fit(train)
    longer = encoder.copy({encoder.maxlen: maxlen_validation})
    size = 4 + len(encoder.getOrDefault("pieces"))
    # Every epoch reads ids, not texts.
    stored = []
    for rows, stage in ((train, encoder), (validation, longer)):
        place = scratch_path(spark, "encoded")
        stage.transform(rows).select("key", "input_ids", "label").write.parquet(place)
        stored.append(spark.read.parquet(place))
    classifier = EpochClassifier(
        size=size, epochs=epochs, batch=batch, rate=rate, workers=workers, exchanges=exchanges,
        seed=seed,
    )
    runs, best = [], 0.0
    for epoch, model, rows, train_loss in classifier.models(stored[0]):
        judged = batched_evaluation(model.transform(stored[1]), "key", batch).first()
        saved = judged.accuracy is not None and judged.accuracy > best
        if saved:
            best = judged.accuracy
            PipelineModel([longer, model]).write().overwrite().save(path)
        runs.append((epoch, rows, train_loss, judged.accuracy, judged.loss, saved))
    return spark.createDataFrame(
        runs, "epoch int, rows long, train_loss double, accuracy double, loss double, saved boolean"
    )


def saved_epoch(runs: DataFrame) -> DataFrame:
    """(epoch, accuracy) of the run that ``train_by_epochs`` has kept."""
    return select_best_run(runs)
