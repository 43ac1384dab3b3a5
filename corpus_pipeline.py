"""A training-data pipeline over documents: each stage's rows are written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, linededup, neardup, quality
from ledgerline.llm import queries as q
from ledgerline.llm.shared import materialize, table


def _with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of docs from changed, with its column `text` as the text and n_chars to suit."""
    out = {"text": F.col(text), "n_chars": F.when(F.col(text).isNotNull(), F.length(text)).cast(docs.schema["n_chars"].dataType)}
    return changed.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, failing lines go."""
    return _with_text(docs, quality.judge(docs).where("q_kept"), "q_clean")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; a document that has nothing left goes too."""
    cut = linededup.remove_lines(docs)
    return _with_text(docs, cut.where("l_removed = 0 or l_removed < l_lines"), "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the row with the smallest id stays."""
    return neardup.remove_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that matches a benchmark item go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return q.bpe_digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_ids),
]

#: Near-copy groups and BPE ids are beyond SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name.lower().replace(' ', '-')}")
    return docs
