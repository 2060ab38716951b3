"""A corpus from raw documents: five stages, each over all that its predecessor kept."""

from pyspark.sql import functions as F

from verbatide.llm.decontaminate import drop_contaminated
from verbatide.llm.langid_cnn import accept_languages, learn
from verbatide.llm.mixing import mix
from verbatide.llm.queries import MIX_WEIGHTS, label_domains
from verbatide.llm.registry import table
from verbatide.llm.simhash_vptree import keep_first
from verbatide.llm.suffix_dedup import cut_repeats
from verbatide.storage import scratch_path


def known_languages(spark, docs, sf_dir):
    """Documents whose language is known; texts without letters go."""
    return accept_languages(docs, learn(docs), least=0.3)


def first_of_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: those linked by a Jaccard similarity
    of 0.8 or more of their distinct five-word shingles. Vantage-point trees over SimHash
    fingerprints find candidates within 4 bits, bands of least hashes those further off.

    Null and blank texts are one group. Of repeated rows, one stays; rows without doc_id
    stay if no row of their group has one. An empty table stays empty."""
    return keep_first(docs, words=5, radius=4, wide=2, total=54, similarity=0.8)


def without_repeats(spark, docs, sf_dir):
    """Texts less the strings of 50 bytes or more that an earlier document holds."""
    cut = cut_repeats(docs, window=50)
    length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold less than half of any benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), least=5, coverage=0.5)


def mixed(spark, docs, sf_dir):
    """Every document's rate and copies in a mix with the target shares of domains."""
    labels = label_domains(table(spark, sf_dir, "labels"))
    return mix(docs, labels, MIX_WEIGHTS).drop("place")


STAGES = [
    ("language_id", known_languages),
    ("near_dedup", first_of_near_copies),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

# Learned models and iterative fits: tested against plain versions instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {}
