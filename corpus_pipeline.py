"""A cleaning pipeline from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``. SQL can't express the outlier estimates, so
the whole is tested against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirelens.llm import jaccard_join, line_dedup, mixing, packing, quality
from wirelens.llm.common import durable

TOKENIZER = "byte_bpe_50k.json"
#: Target weights of the sources by name; None for their tempered row counts.
SHARES: dict[str, float] | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base limits that are no outliers of their language and source.

    Cases: each row is judged by itself, repeated ones and those with one or no doc_id too. A null or empty text fails; null
    languages and sources are groups of their own. Columns of any name pass; an empty table gives an empty one.
    """
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least five documents share; n_chars follows, and documents left blank go.

    Cases: of a shared line those of the largest doc_id stay, all of them; rows without doc_id hold lines as one document
    would. Null and empty texts share nothing and stay as they are. Columns of any name pass; an empty table gives an empty one.
    """
    out = line_dedup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    cut = out.where(~changed | (F.btrim("kept_text", F.lit(line_dedup.TRIMMED)) != ""))
    return cut.withColumns({"text": text, "n_chars": F.when(changed, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a Jaccard similarity of 0.75.

    Cases: rows are documents whatever their ids; of a group the least doc_id stays (nulls last), of ties the least hash of the
    text, of rows equal in both any one. Texts without words link with nothing, so each such row stays. Columns of any name
    pass; an empty table gives an empty one.
    """
    return jaccard_join.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the Pfair mixture of their sources.

    Cases: a null source is mixed as ''. Repeated rows stay, those equal in id, source and text side by side. Columns of any
    name pass; an empty table gives an empty one.
    """
    return mixing.interleaved(docs, SHARES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into sequences of at most 1024 that follow the mixture.

    Documents have no column for a slot, so slots are found again: they depend on the rows and ``SHARES`` only. Cases: a null
    or empty text is one end token. Repeated rows, and those with one or no doc_id, are packed each. An empty table gives none.
    """
    carry = ["doc_id", "lang", "source"]
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), carry=carry, follow=mixing.places(docs, SHARES))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("jaccard_join", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = durable(docs, name)
    return docs
