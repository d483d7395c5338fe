"""From raw documents to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; where a stage changes a text, n_chars follows it.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclim.llm import langid, linededup, packing, simhash, suffixes
from gridclim.llm.common import fold, stage

#: A language below this score is no language that was learned.
LEAST_SCORE = 0.5


def _like(done: DataFrame, docs: DataFrame) -> DataFrame:
    """done with the columns of docs and the length of its own texts."""
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that the labelled two thirds of the documents teach stay, those without a doc_id too; documents go
    that have no letter, whose language is unsure, or whose n-grams are likelier to be drawn evenly than in any language."""
    model = langid.fit(docs.where(F.coalesce(fold(F.col("doc_id"), 3) != 1, F.lit(True))))
    names = {c: f"_{c}" for c in ("lang_pred", "score", "fit") if c in docs.columns}
    found = langid.predict(docs.withColumnsRenamed(names), model, keep_text=True)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE) & (F.col("fit") > 0)
    return found.where(known).drop("lang_pred", "score", "fit").withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return _like(linededup.dedup_lines(docs), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays, once. Different texts that share a doc_id
    are different documents."""
    return simhash.one_of_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by strings that occur more than once go."""
    return _like(suffixes.cut_repeats(docs, as_text=True), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest is tokenised and packed: a row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

#: SimHash fingerprints, tokens and packing have no SQL; tests/llm compares the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = step(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, _ = stage(docs, f"pipeline-{name}")
    return docs
