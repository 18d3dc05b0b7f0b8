"""Training-data pipeline: documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result
as Parquet to the shared folder and reads it back as the next stage's docs. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapquarry.llm import bpe, decontaminate, quality, secrets, simhash
from snapquarry.llm.common import WRITTEN, drop_tables, materialise, packed, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from this stage's input, rejects go.

    Null and empty texts are scored by the bias alone; repeated rows are kept or go together;
    without labels every document scores 0.5 and stays; an empty table stays empty.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(packed(docs), model, ["row"]).filter(F.col("score") >= 0.5).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (components of Jaccard similarity 0.8 or more over distinct five-word shingles) stays.

    The one with the smallest id stays; a null id only where there is no other. Null, empty
    and blank texts have no shingle and are copies of each other; texts under five words are
    compared as one shingle; of repeated rows one stays; an empty table stays empty.
    """
    return simhash.without_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with up to 5 % edits, go.

    Null and empty texts hold none; repeated rows are kept or go together; with an empty
    benchmark all stay.
    """
    found = decontaminate.contaminated(packed(docs), table(spark, sf_dir, "benchmark"), ["row"])
    return found.filter(F.size("item_ids") == 0).select("row.*")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; n_chars follows. Null texts and their n_chars stay as they are; no row goes, repeated ones repeat."""
    none = F.col("text").isNull()
    new = {"text": F.when(~F.col("none"), F.col("redacted")), "n_chars": F.when(F.col("none"), F.col("row.n_chars")).otherwise(F.char_length("redacted"))}
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    found = secrets.scan(docs.select(row.alias("row"), none.alias("none"), "text"), ["row", "none"])
    return found.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and the text they decode to. Null and empty texts have no ids; repeated rows repeat."""
    import public_tokenizers

    return bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "lang", "source"])


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("bpe", bpe_stage),
]
#: SQL can express none of the stages but trivially; tests/llm holds each stage's operator against brute force, and
#: run() against a plain pipeline of Python sets, scans and the tokenizers library on a small table.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables of a stage are dropped when the next stage's result is written."""
    docs, before = table(spark, sf_dir, "documents"), len(WRITTEN)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs)
            drop_tables(spark, WRITTEN[before:-1])
    return docs
