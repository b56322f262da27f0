"""The registered queries of this package, each over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from . import codes, decontaminate, jaccard, language, licenses, quality, repair, repeats, rows, sampling, simhash, toxicity, urls, warc

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op5_quality_rules(spark, sf_dir):
    """Counts and verdict of the quality rules for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@_query
def op6_decontamination(spark, sf_dir):
    """Benchmark windows in every document."""
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.contamination(docs, items))


def language_model(docs: DataFrame) -> language.Model:
    """Learnt from the labelled documents that are not held out."""
    return language.train(docs.where(~rows.held_out(F.col("doc_id"))), VOCABULARY)


@_query
def op10_language_id(spark, sf_dir):
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", rows.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op9_license_scan(spark, sf_dir):
    """License phrases and notices in every document."""
    found = licenses.licenses(_table(spark, sf_dir, "documents"))
    join = lambda name: F.array_join(name, ",").alias(name)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", join("base_labels"), join("labels"), "score")


URL_RULES = [urls.Rule("block", "net/"), urls.Rule("allow", "example.net/en/"), urls.Rule("block", "example.com/de/"), urls.Rule("allow", "org/fr/")]


@_query
def op3_url_filter(spark, sf_dir):
    """Rules and trees for the URL of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@_query
def op4_warc(spark, sf_dir):
    """Every page written to archives and read back."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    files = warc.write_warc(pages, new_path(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return warc.read_warc(files, payload=False).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


@_query
def op8_jaccard_join(spark, sf_dir):
    """Components of documents whose shingle sets are similar."""
    found = jaccard.similar(_table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@_query
def op7_repeated_bytes(spark, sf_dir):
    """Bytes of every document that an earlier one has too."""
    return repeats.repeats(_table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


@_query
def op1_sentencepiece_sampling(spark, sf_dir):
    """Three distinct sampled segmentations of every document, decoded again."""
    return sampling.segmentations(_table(spark, sf_dir, "documents"), VOCABULARY)


@_query
def op2_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~rows.held_out(F.col("doc_id"))).select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return toxicity.scored(docs, model).select("doc_id", rows.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query
def op11_vector_codes(spark, sf_dir):
    """Product codes of every vector."""
    return codes.coded(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@_query
def op12_conversation_repair(spark, sf_dir):
    """The cheapest repair of every conversation, after damage."""
    turns = repair.damaged(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return repair.repaired(turns).withColumnRenamed("conv", "conv_id")


@_query
def op13_simhash_groups(spark, sf_dir):
    """Groups of documents with similar fingerprints."""
    return simhash.near_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))
