"""JSONL sources with line numbers, verified content and located errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.functions.text import is_blank, stripped
from marlstone.operators.records import PROMOTED, normalize_messages

RECORD_DDL = (
    "record_id STRING, split STRING, messages ARRAY<STRUCT<role: STRING, content: STRING>>, instruction STRING, prompt STRING, question STRING, output STRING, response STRING, gold_reference STRING, "
    "metadata STRING, research_role STRING, training_eligible BOOLEAN, evaluation_set_id STRING, evaluation_set_version STRING, source_record_id STRING, source_reference_id STRING, fact_group_id STRING, knowledge_unit_id STRING, variant_id STRING, record_provenance STRING, source_evidence STRING"
)


def file_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """(source_uri, line_number, line) of the lines that aren't blank, read split by split.

    Lines end at line feeds. Numbers count blank lines too: a line's place in its split, after
    the lines of the file's earlier splits (one small row a split).
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("source_uri"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("place")
    )
    blocks = lines.groupBy("source_uri", "block").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("source_uri").orderBy("block")) - F.col("n")
    met = lines.join(blocks.withColumn("earlier", earlier).drop("n"), ["source_uri", "block"])
    number = (F.col("place") - F.col("first") + F.col("earlier") + 1).cast("int")
    return met.where(~is_blank(F.col("line"))).select("source_uri", number.alias("line_number"), "line")


def whole_files(spark: SparkSession, *paths: str) -> DataFrame:
    """One row a file: source_uri and its text (for small documents)."""
    return spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("source_uri"), F.col("value").alias("text"))


def numbered_lines(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """Lines that aren't blank, with 1-based numbers that count the blank ones."""
    lines = df.select(*keys, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return lines.where(~is_blank(F.col("line"))).select(*keys, (F.col("pos") + 1).alias("line_number"), "line")


def parsed(lines: DataFrame, ddl: str = RECORD_DDL) -> DataFrame:
    """Typed fields in ``r``, the raw line, and ``error`` (uri:line) where it is no JSON object."""
    is_object = F.startswith(stripped(F.col("line")), F.lit("{")) & F.try_parse_json("line").isNotNull()
    where = F.concat(F.col("source_uri"), F.lit(":"), F.col("line_number").cast("string"), F.lit(" must contain a JSON object"))
    return lines.select("*", F.when(is_object, F.from_json("line", ddl)).alias("r"), F.when(~is_object, where).alias("error"))


def has_key(line: Column, key: str) -> Column:
    """Whether a key is present, null or not (absent and null differ in canonical JSON)."""
    return F.array_contains(F.json_object_keys(line), key)


def records(spark: SparkSession, *sources: str) -> DataFrame:
    """Normalisable records of several files in order: source_ordinal, line_number, fields.

    Lines that aren't objects come with ``error``; check it before use (checks.py).
    """
    out = None
    for ordinal, path in enumerate(sources):
        one = parsed(file_lines(spark, path)).withColumn("source_ordinal", F.lit(ordinal))
        out = one if out is None else out.unionByName(one)
    nonblank = lambda *names: F.coalesce(*[F.nullif(F.col(f"r.{n}"), F.lit("")) for n in names])
    meta = [F.get_json_object("r.metadata", f"$.{k}").alias(f"meta_{k}") for k in (*PROMOTED, "original_split")]
    return out.select(
        "r.record_id",
        "r.split",
        normalize_messages(F.col("r.messages"), nonblank("instruction", "prompt", "question"), nonblank("output", "response", "gold_reference")).alias("messages"),
        *[F.col(f"r.{k}").alias(k) for k in PROMOTED],
        *meta,
        F.json_object_keys("line").alias("top_keys"),
        F.json_object_keys("r.metadata").alias("meta_keys"),
        "source_ordinal",
        "source_uri",
        "line_number",
        "error",
    )


def capacity_records(spark: SparkSession, count: int, token_target: int) -> DataFrame:
    """Synthetic records with twice ``token_target`` words each."""
    return capacity_records_of(spark.range(count).withColumn("token_target", F.lit(token_target)))


def capacity_records_of(targets: DataFrame) -> DataFrame:
    """A synthetic record for each row (id, token_target), with twice as many words as its target, at least one."""
    word = lambda w: F.concat(F.lit("capacity_"), F.col("id").cast("string"), F.lit("_"), (w % 997).cast("string"))
    last = F.greatest(2 * F.col("token_target") - 1, F.lit(0))
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), word), " ")
    pair = F.array(F.struct(F.lit("user").alias("role"), text.alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("ok").alias("content")))
    return targets.select(F.concat(F.lit("capacity-"), F.col("id").cast("string")).alias("record_id"), F.lit("train").alias("split"), pair.alias("messages"))
