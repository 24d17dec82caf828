"""Evidence: resolving ids, what is missing, and on what a judgment rests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.checks import require_none
from marlstone.functions.text import evidence_text


def texts(items: DataFrame) -> DataFrame:
    """(evidence_id, text) of the rows that have an id, under any of the usual names."""
    return items.select(
        F.coalesce(*[F.col(c) for c in ("evidence_id", "id") if c in items.columns]).cast("string").alias("evidence_id"),
        evidence_text(*[F.col(c) for c in ("text", "content", "chunk_text", "normalized_text") if c in items.columns]).alias("text"),
    ).where("evidence_id is not null")


def checked_lookup(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """Stored values of ``wanted`` keys (evidence_id); a key that isn't stored is an error."""
    met = wanted.select("evidence_id").distinct().join(items, "evidence_id", "left")
    require_none(met.where("content_sha256 is null").select("evidence_id"), "evidence that isn't stored")
    return met


def lookup(items: DataFrame) -> DataFrame:
    """evidence_id, text, content_sha256; rows without an id are skipped (first text by hash if they conflict)."""
    own = texts(items)
    return own.withColumn("content_sha256", F.sha2("text", 256)).groupBy("evidence_id").agg(F.min_by("text", "content_sha256").alias("text"), F.min("content_sha256").alias("content_sha256"))


def conflicting(items: DataFrame) -> DataFrame:
    """Ids that come with different contents."""
    return items.groupBy("evidence_id").agg(F.count_distinct(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("contents")).where("contents > 1")


def resolved(records: DataFrame, evidence: DataFrame) -> DataFrame:
    """Found items (in list order) and missing ids of each record's ``evidence_ids``.

    A left join on the id and one regrouping; a list is as long as one record says.
    """
    ids = records.select("record_id", F.posexplode_outer("evidence_ids").alias("pos", "evidence_id"))
    met = ids.join(evidence.select("evidence_id", "content_sha256"), "evidence_id", "left")
    item = F.struct("pos", "evidence_id", "content_sha256")
    lists = met.groupBy("record_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("content_sha256").isNotNull(), item))).alias("found"),
        F.array_sort(F.collect_list(F.when(F.col("content_sha256").isNull() & F.col("evidence_id").isNotNull(), F.struct("pos", "evidence_id")))).alias("lost"),
    )
    return lists.select(
        "record_id",
        F.transform("found", lambda x: F.struct(x["evidence_id"].alias("evidence_id"), x["content_sha256"].alias("content_sha256"))).alias("resolved_evidence"),
        F.transform("lost", lambda x: x["evidence_id"]).alias("missing_evidence_ids"),
    )


def basis(n_ids: Column, n_found: Column, n_missing: Column, policy: str) -> Column:
    """evidence-grounded with all ids found; else by policy unjudgeable or reference-only."""
    grounded = (n_ids > 0) & (n_found > 0) & (n_missing == 0)
    return F.when(grounded, "evidence-grounded").otherwise("unjudgeable" if policy == "unjudgeable" else "reference-only")


def unresolved_ids(ids: DataFrame, evidence: DataFrame) -> DataFrame:
    return ids.join(evidence, "evidence_id", "left_anti")


def resolved_ids(ids: DataFrame, evidence: DataFrame) -> DataFrame:
    return ids.join(evidence, "evidence_id", "left_semi")


def summary(resolutions: DataFrame) -> DataFrame:
    """Per candidate: records, resolved items, missing ids and whether all resolve."""
    return resolutions.groupBy("candidate_id").agg(
        F.count("*").alias("records"),
        F.sum("n_found").alias("resolved"),
        F.sum("n_missing").alias("missing"),
        F.bool_and(F.col("n_missing") == 0).alias("all_resolvable"),
    )
