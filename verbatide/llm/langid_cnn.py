"""Language identification by a convolutional network over bytes, in numpy.

Bytes fall into classes (A-Z like a-z, one for digits, one for white space, one for
other signs, the rest for bytes of longer characters). Filters of several widths slide
over a window; each one's maximum, rectified, feeds a softmax over the languages.

A text is cut into windows of a fixed length, all of them read, and the windows'
probabilities are averaged by the letters they hold. A filter over one-hot classes is a
sum of table rows, so that two look-ups of byte pairs give all filters at a place.

The network is trained on the driver on at most DOCS_PER_LANGUAGE documents of each
language, and WINDOWS_PER_DOC windows of each; that bounds what the driver reads.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.llm.sampling import first_of_groups
from verbatide.llm.windows import text_bytes

UNKNOWN = "und"
WINDOW, WIDTHS, FILTERS, CLASSES = 256, (2, 3, 4), 8, 128
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 400, 4
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 7
_AT_ONCE = 48


def _byte_classes() -> np.ndarray:
    classes = np.full(256, 1, np.uint8)
    classes[[9, 10, 11, 12, 13, 32]] = 0
    classes[48:58] = 2
    classes[65:91] = classes[97:123] = np.arange(3, 29)
    classes[128:] = 29 + np.arange(128) % (CLASSES - 29)
    return classes


BYTE_CLASSES = _byte_classes()
LETTERS_BY_CLASS = np.arange(CLASSES) > 2


class Network:
    """Filters by width as (width, class, filter) tables, biases, and the output layer."""

    def __init__(self, languages, seed=SEED):
        draw = np.random.default_rng(seed)
        self.languages = list(languages)
        self.tables = [
            draw.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS
        ]
        hidden = FILTERS * len(WIDTHS)
        self.bias = np.zeros(hidden, np.float32)
        self.out = draw.normal(0, 0.3, (hidden, len(self.languages))).astype(np.float32)
        self.base = np.zeros(len(self.languages), np.float32)

    def parameters(self):
        return [*self.tables, self.bias, self.out, self.base]

    def pairs(self):
        """Tables by class pair: the first two bytes of all filters, then the next two."""
        two, three, four = self.tables
        pair = lambda t: (t[0][:, None] + t[1][None]).reshape(-1, FILTERS)
        third = np.repeat(three[2][:, None], CLASSES, 1).reshape(-1, FILTERS)
        none = np.zeros_like(third)
        ahead = np.concatenate([pair(two), pair(three), pair(four)], 1)
        return ahead, np.concatenate([none, third, pair(four[2:])], 1)

    def activations(self, windows: np.ndarray, pairs) -> np.ndarray:
        """(windows, places, filters) for rows of byte classes."""
        codes = windows[:, :-1].astype(np.int32) * CLASSES + windows[:, 1:]
        found = pairs[0][codes[:, :-2]]
        found += pairs[1][codes[:, 2:]]
        return found

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.maximum(pooled + self.bias, 0) @ self.out + self.base
        logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, windows: np.ndarray, pairs) -> np.ndarray:
        parts = [
            self.activations(windows[i : i + _AT_ONCE], pairs).max(axis=1)
            for i in range(0, len(windows), _AT_ONCE)
        ]
        return self.probabilities(np.concatenate(parts))

    def gradients(self, windows, target):
        found = self.activations(windows, self.pairs())
        place = found.argmax(axis=1)
        pooled = np.take_along_axis(found, place[:, None], 1)[:, 0] + self.bias
        hidden = np.maximum(pooled, 0)
        error = self.probabilities(pooled - self.bias)
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        back = (error @ self.out.T) * (pooled > 0)
        tables = []
        for k, width in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            grad = np.zeros_like(self.tables[k])
            filters = np.broadcast_to(np.arange(FILTERS), place[:, own].shape)
            for j in range(width):
                seen = windows[np.arange(len(windows))[:, None], place[:, own] + j]
                np.add.at(grad[j], (seen, filters), back[:, own])
            tables.append(grad)
        return [*tables, back.sum(0), hidden.T @ error, error.sum(0)]


def train(windows: np.ndarray, target: np.ndarray, languages) -> Network:
    """Adam over shuffled batches; the same input gives the same network."""
    network = Network(languages)
    draw = np.random.default_rng(SEED)
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            for p, g, m, v in zip(
                network.parameters(), network.gradients(windows[some], target[some]), first, second
            ):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def windows_of(classes: np.ndarray, starts: np.ndarray):
    """(rows of WINDOW classes, document of each): all windows of all texts, the last
    of each filled up with white space."""
    sizes = np.diff(starts)
    each = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), each)
    turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    begin = starts[owner] + turn * WINDOW
    place = begin[:, None] + np.arange(WINDOW)
    rows = classes[np.minimum(place, max(len(classes) - 1, 0))]
    rows[place >= starts[owner + 1][:, None]] = 0
    return rows, owner


def is_held_out(doc_id) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def learn(docs: DataFrame) -> Network:
    """Train on documents with text and language that are not held out."""
    labelled = (
        docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        .filter(~F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)))
        .select("lang", "text", F.xxhash64("doc_id", "text").alias("order"))
    )
    # Hashes are drawn first, texts read after; what is broadcast has a known size.
    # A repeated row is drawn and read once.
    hashes = labelled.select("lang", "order").distinct()
    drawn = first_of_groups(hashes, "lang", "order", DOCS_PER_LANGUAGE)
    chosen = docs.sparkSession.createDataFrame(drawn.toPandas(), "lang string, order long")

    def pick(batches):
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            rows, owner = windows_of(BYTE_CLASSES[data], starts)
            order = batch.column("order").to_numpy()
            keep = []
            for i in range(batch.num_rows):
                own = np.flatnonzero(owner == i)
                draw = np.random.default_rng(int(order[i]) & 0xFFFFFFFF)
                keep.append(draw.permutation(own)[:WINDOWS_PER_DOC])
            keep = np.concatenate(keep) if keep else np.zeros(0, int)
            yield pa.record_batch(
                [
                    batch.column("lang").take(pa.array(owner[keep])),
                    pa.array([row.tobytes() for row in rows[keep]], pa.binary()),
                ],
                names=["lang", "classes"],
            )

    picked = labelled.join(F.broadcast(chosen), ["lang", "order"])
    picked = picked.groupBy("lang", "order").agg(F.min("text").alias("text"))
    drawn = picked.mapInArrow(pick, "lang string, classes binary").toPandas()
    drawn = drawn.sort_values(["lang", "classes"], ignore_index=True)
    languages = sorted(drawn["lang"].unique())
    if not languages:
        return Network([])
    rows = np.frombuffer(b"".join(drawn["classes"]), np.uint8).reshape(-1, WINDOW)
    target = np.searchsorted(np.array(languages, object), drawn["lang"].to_numpy(object))
    return train(rows, target.astype(np.int64), languages)


def predict_languages(docs: DataFrame, network: Network, columns=("doc_id",)) -> DataFrame:
    """The rows of ``docs``, of which ``columns``, with held_out, lang_pred, score.

    A text that is null or has no letter is ``und`` with score 0, as is every text if
    no language was learned. Repeated rows stay. A missing doc_id is not held out.
    """

    def read(batches):
        pairs = network.pairs()
        for batch in batches:
            data, starts = text_bytes(batch.column("text"))
            n, known = batch.num_rows, len(network.languages)
            total = np.zeros((n, max(known, 1)))
            # As many texts as make up a part of bounded size, and one at least.
            at = 0
            while at < n and known:
                end = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20), "right")) - 1)
                for lo in range(int(starts[at]), int(starts[end]), 1 << 22):
                    hi = min(lo + (1 << 22), int(starts[end]))
                    cut = np.clip(starts[at : end + 1], lo, hi) - lo
                    rows, owner = windows_of(BYTE_CLASSES[data[lo:hi]], cut)
                    if len(rows):
                        weight = 1e-6 + LETTERS_BY_CLASS[rows].sum(axis=1)
                        np.add.at(total, at + owner, network.predict(rows, pairs) * weight[:, None])
                at = end
            share = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)
            best = share.argmax(axis=1)
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False) & (known > 0)
            names = np.array([*network.languages, UNKNOWN], object)
            pred = np.where(lettered, names[best] if known else UNKNOWN, UNKNOWN)
            score = np.where(lettered, np.clip(share[np.arange(n), best], 0, 1), 0.0)
            made = [batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score)]
            yield pa.record_batch(
                [*map(batch.column, columns), *made],
                names=[*columns, "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        *columns,
        F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        *(["text"] if "text" not in columns else []),
    )
    types = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in columns)
    return rows.mapInArrow(read, f"{types}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row: learn, then predict all."""
    return predict_languages(docs, learn(docs))


def accept_languages(docs: DataFrame, network: Network, least: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with their columns, whose language is known: not ``und``,
    and predicted with a score of ``least`` or more."""
    plain = [f"_{i}" for i in range(len(docs.columns))]
    plain = [c if c in ("doc_id", "text") else p for c, p in zip(docs.columns, plain)]
    judged = predict_languages(docs.toDF(*plain), network, plain)
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns)])
