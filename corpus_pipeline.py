"""From raw documents to sampled token ids: language, near copies, repeated passages, benchmark passages, pieces."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from causal_logs.llm import decontaminate, jaccard, language, repeats, sampling
from causal_logs.llm.queries import VOCABULARY, language_model
from causal_logs.session import collected, release, written

# A document goes if no language, or none with this posterior, is found.
LEAST_SCORE = 0.5
# Sampled segmentations of each document at the end.
SAMPLES = 2

# Models and exact searches over bytes are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learnt from the labelled ones. Null texts and texts without letters go."""
    own = {c: f"own_{c}" for c in docs.columns if c.lower() in ("lang_pred", "score")}
    found = language.predict(docs.withColumnsRenamed(own), language_model(docs))
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.drop("lang_pred", "score").withColumnsRenamed({new: c for c, new in own.items()}).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the smallest id."""
    with collected() as used:
        kept = jaccard.deduplicated(docs)
    # The index is done with; what the result reads stays.
    release(spark, used, kept)
    return kept


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier document has too; a document of which nothing is left goes."""
    # The other columns come along with each text: ids may be missing or repeated, so rows are not found again by id.
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    found = repeats.repeats(docs, kept=True, carry=others).where("n_removed = 0 OR kept <> ''")
    text = F.when(~F.col("none"), F.col("kept"))
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return found.select(*[new[c].alias(c) if c in new else F.col("own")[c].alias(c) for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of the documents, as piece ids."""
    return sampling.segmentations(docs, VOCABULARY, k=SAMPLES)


STAGES = [
    ("language ID", identified),
    ("n-gram Jaccard join", without_near_copies),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``; each one's result is stored and read again.

    A stage removes nothing that its result reads. Here, once a stage's result is stored, what it had stored on the way goes, and so does its input if
    that was the result of the stage before.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with collected() as used:
            found = stage(spark, docs, sf_dir)
            with collected() as result:
                docs = written(found, name.replace(" ", "-"))
        release(spark, [*before, *(p for p in used if p not in result)])
        before = result
    return docs
