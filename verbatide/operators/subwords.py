"""Fixed-length ids of word pieces, as a Spark ML stage that is saved with its settings."""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.operators.encoding import (
    CLASSIFY,
    FIRST_WORD_ID,
    HEAD_KEY_LENGTH,
    PAD,
    SEPARATOR,
    UNKNOWN,
    build_vocabulary,
    tokens,
)

# How a piece within a word, not at its start, is spelled in the list of pieces.
WITHIN = "##"


def word_pieces(df: DataFrame, text: str = "text", words: int = 20_000) -> list[str]:
    """The pieces in the order of their ids, from FIRST_WORD_ID on.

    First the most frequent words (ties by the word; those of over 64 characters are no
    pieces), then the same within other words, then every other character that occurs,
    at a word's start and within. So any word of characters seen here has pieces. The
    list is bounded by ``words`` and the number of characters.
    """
    vocabulary = build_vocabulary(df, text)
    head = vocabulary.filter(F.col("token_id") < FIRST_WORD_ID + words).filter(
        F.length("token") <= HEAD_KEY_LENGTH
    )
    frequent = [r.token for r in head.orderBy("token_id").select("token").collect()]
    seen = vocabulary.select(F.explode(F.split("token", "")).alias("c")).distinct()
    rare = sorted({r.c for r in seen.collect() if r.c} - set(frequent))
    return [*frequent, *(WITHIN + w for w in frequent), *rare, *(WITHIN + c for c in rare)]


def _longest_match(pieces: list[str], room: int):
    """A function from arrays of words to arrays of at most ``room`` piece ids."""
    within, first_id, unknown = WITHIN, FIRST_WORD_ID, UNKNOWN

    def encode(column):
        import numpy as np
        import pyarrow as pa

        state = encode.__dict__
        if "starts" not in state:
            # Once for each task: pieces by their place in a word.
            state["starts"] = {p: i for i, p in enumerate(pieces, first_id) if not (p.startswith(within) and len(p) > 2)}
            state["inner"] = {p[2:]: i for i, p in enumerate(pieces, first_id) if p.startswith(within) and len(p) > 2}
            state["longest"] = max(map(len, pieces), default=1)
        starts, inner, longest = state["starts"], state["inner"], state["longest"]

        def match(word):
            whole = starts.get(word)
            if whole is not None:
                return [whole]
            found, at = [], 0
            while at < len(word):
                known = inner if at else starts
                for end in range(min(len(word), at + longest), at, -1):
                    piece = known.get(word[at:end])
                    if piece is not None:
                        break
                else:
                    # As a whole: a character that the pieces lack.
                    return [unknown]
                found.append(piece)
                at = end
            return found

        listed = column.fill_null([]) if column.null_count else column
        ends = np.cumsum(np.append(0, listed.value_lengths().to_numpy(zero_copy_only=False)))
        coded = listed.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        made = [match(w) for w in coded.dictionary.to_pylist()]
        sizes = np.array([len(m) for m in made] or [0])
        flat = np.array([i for m in made for i in m], np.int32)
        begins = np.cumsum(sizes) - sizes
        counts = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        after = np.cumsum(counts)
        ids = flat[np.repeat(begins[codes] - (after - counts), counts) + np.arange(counts.sum())]
        bounds = np.append(0, after)[ends]
        kept = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds)) < room
        offsets = np.append(0, np.cumsum(np.minimum(np.diff(bounds), room))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[kept]))

    return encode


class _Settings(HasInputCol):
    maxlen = Param(Params._dummy(), "maxlen", "length of input_ids", TypeConverters.toInt)

    def _defaults(self):
        self._setDefault(inputCol="text", maxlen=50)


class SubwordEncoder(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Counts the words of ``inputCol``; see SubwordEncoderModel."""

    words = Param(Params._dummy(), "words", "most frequent words that are pieces", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="text", maxlen=50, words=20_000):
        super().__init__()
        self._defaults()
        self._setDefault(words=20_000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        found = word_pieces(dataset, self.getInputCol(), self.getOrDefault("words"))
        return SubwordEncoderModel(
            inputCol=self.getInputCol(), maxlen=self.getOrDefault("maxlen"), pieces=found
        )


class SubwordEncoderModel(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Adds input_ids and attention_mask of length ``maxlen`` to every row.

    Words are lower-cased runs of letters and digits, or single signs. A word is cut
    into pieces from its start on, the longest first; one with a character that no
    piece has is UNKNOWN as a whole. Ids beyond maxlen - 2 are cut off. A null text has
    no words. Rows stay where they are: pieces are looked up in Arrow batches, each
    distinct word of a batch once.
    """

    pieces = Param(Params._dummy(), "pieces", "pieces in the order of their ids", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol="text", maxlen=50, pieces=()):
        super().__init__()
        self._defaults()
        self._setDefault(pieces=[])
        self._set(**{k: list(v) if k == "pieces" else v for k, v in self._input_kwargs.items()})

    def _transform(self, dataset):
        room = self.getOrDefault("maxlen") - 2
        look_up = F.arrow_udf(_longest_match(self.getOrDefault("pieces"), room), "array<int>")
        # Every word has one id or more: what lies beyond the room is never looked at.
        words = F.slice(F.coalesce(tokens(self.getInputCol()), F.array().cast("array<string>")), 1, room)
        special = lambda i: F.array(F.lit(i))
        padding = F.array_repeat(F.lit(PAD), F.lit(room) - F.size("_body"))
        return (
            dataset.withColumn("_body", look_up(words))
            .withColumn("input_ids", F.concat(special(CLASSIFY), "_body", special(SEPARATOR), padding))
            .withColumn("attention_mask", F.transform("input_ids", lambda i: (i != PAD).cast("int")))
            .drop("_body")
        )
