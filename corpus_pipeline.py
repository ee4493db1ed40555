"""From documents to packed sequences: four stages, each one of the operators of ``stintgraph.llm``.

Every stage takes all that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintgraph.llm import jaccard_join, packing, quality_rules, suffix_dedup
from stintgraph.llm.shared import written


#: So many words are a passage, though they have fewer than 400 bytes.
WORDS = 50


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null and empty texts hold no word and go; repeated rows
    are judged one by one; an empty table stays empty."""
    return quality_rules.keep(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one row, of the least id; of rows that repeat that id the one of
    the least class and text. Rows with a null id or without words link with nothing and all stay."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 400 bytes, or of WORDS words, that also start elsewhere. A character of which a
    part is cut goes as a whole. Texts from which nothing is cut stay as they are, null ones null; one
    that is cut wholly is empty. Rows that repeat a text repeat all its strings."""
    cut = suffix_dedup.remove_repeats(docs, words=WORDS)
    rest, changed, kinds = F.col("_cut.text"), F.col("_cut.n_removed") > 0, dict(docs.dtypes)
    own = {
        "text": F.when(changed, rest).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.length(rest).cast(kinds.get("n_chars", "int"))).otherwise(F.col("n_chars")) if "n_chars" in kinds else None,
    }
    return cut.select(*[own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns])


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 1024 ids; null and empty texts are one id, their end. Null ids and
    repeated rows are documents like any other; an empty table gives no piece."""
    return packing.with_crc(packing.pack(docs, *packing.public_paths()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("n-gram jaccard join", keep_one_of_each),
    ("suffix-array dedup", cut_repeats),
    ("harmonic packing", pack_all),
]

#: Shuffled hashes and tokenization have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
