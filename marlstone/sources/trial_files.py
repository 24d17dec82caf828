"""Trial results and session recovery from JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators.trials import trial_number

TRIAL_DDL = (
    "trial_id STRING, stage STRING, status STRING, configuration STRUCT<model_name: STRING, max_sequence_length: INT, max_examples: INT, per_device_train_batch_size: INT, gradient_accumulation_steps: INT, lora_rank: INT, load_in_4bit: BOOLEAN, max_steps: INT>, "
    "runtime_seconds DOUBLE, model_loading_seconds DOUBLE, training_seconds DOUBLE, completed_steps INT, longest_step_seconds DOUBLE, model_weights_reused BOOLEAN, gpu_memory_peak_percent DOUBLE, system_ram_peak_percent DOUBLE, "
    "gpu_utilization_peak_percent DOUBLE, gpu_power_peak_watts DOUBLE, gpu_energy_joules DOUBLE, gpu_temperature_peak_celsius DOUBLE, threshold_reason STRING, timeout_type STRING"
)


def trial_results(spark: SparkSession, path: str) -> DataFrame:
    """All readable trial files, one object each; unreadable ones go."""
    df = spark.read.schema(TRIAL_DDL).json(path, multiLine=True, mode="PERMISSIVE")
    return df.where("trial_id is not null").withColumn("trial_number", trial_number(F.col("trial_id")))


def completed_results(spark: SparkSession, path: str) -> DataFrame:
    return trial_results(spark, path).where("status = 'completed' and configuration.model_name is not null").orderBy("trial_number")


def recovered(configs: DataFrame, reports: DataFrame) -> DataFrame:
    """A trial table after an interruption: every configuration, with its report if it has one."""
    return configs.join(reports, "trial_id", "left").withColumn("status", F.coalesce("status", F.lit("interrupted")))
