"""The corpus pipeline, from raw documents to subword ids.

``STAGES`` are (name, function); each takes (spark, docs, sf_dir), calls one operator and
returns a DataFrame that is written as Parquet and read again as the next stage's docs. All
but the last return the columns of ``documents``.

1. toxicity: documents that the factorization machine rejects go.
2. near_duplicates: one document of each SimHash group stays.
3. decontamination: documents with a twentieth of their words in benchmark windows go.
4. pii: personal values become keyed pseudonyms (n_chars follows the new text).
5. sentencepiece: texts become subword ids, with their next best segmentations.

Null and empty texts, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import decontaminate, pii, sentencepieces, simhash, toxicity
from marlstone.llm.store import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.pseudonymised(docs).drop("pii_kinds")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepieces.encoded(docs).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("sentencepiece", encode),
]

#: The model, the hashes and the lattice of the stages are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
