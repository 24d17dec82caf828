"""A sample of labelled rows, bounded in rows and bytes, for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(folds: int, id_column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, target: Column, folds: int, held_out: int, most: int, most_bytes: int = 64 << 20) -> list[tuple[str, int]]:
    """(text, label) of at most ``most`` labelled ids of the other folds, with ``most_bytes`` of text, in a fixed order.

    The rows with the smallest hashes of their ids are taken, so the sample doesn't depend on
    how the tables are laid out; a text that is longer than what is left of the bytes is passed
    over. Rows without a label, an id or a document are skipped; an id's least label counts.
    Of an id that occurs in several documents the text with the least hash is taken.
    """
    own = labels.select("doc_id", target.cast("int").alias("_label")).where("doc_id is not null and _label is not null").where(fold(folds) != held_out)
    picked = own.groupBy("doc_id").agg(F.min("_label").alias("_label")).orderBy(F.xxhash64(F.lit(folds), "doc_id"), "doc_id").limit(most)
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", F.xxhash64(text).alias("_hash"), F.octet_length(text).cast("long").alias("_size")).join(F.broadcast(picked), "doc_id")
    found = found.groupBy("doc_id", "_label").agg(F.min(F.struct("_hash", "_size")).alias("_text"))
    rows = found.orderBy(F.xxhash64(F.lit(folds), "doc_id"), "doc_id").select("doc_id", "_label", "_text.*").collect()
    chosen, left = [], most_bytes
    for r in rows:
        if r["_size"] <= left:
            left -= r["_size"]
            chosen.append((r["doc_id"], r["_label"], r["_hash"]))
    if not chosen:
        return []
    id_type = docs.schema["doc_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(chosen, f"doc_id {id_type}, _label int, _hash long")
    texts = docs.select("doc_id", text.alias("_text"), F.xxhash64(text).alias("_hash")).join(F.broadcast(wanted), ["doc_id", "_hash"]).groupBy("doc_id", "_label").agg(F.first("_text").alias("_text"))
    return sorted((r["_text"], r["_label"]) for r in texts.collect())
