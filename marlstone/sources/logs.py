"""Process logs: lines from raw output, progress events, mount tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import strip_terminal_control, stripped

#: What the lines of a trial contain (a process may write a name before each).
MARKERS = {"started": "TRAINING_STARTED", "training_completed": "TRAINING_COMPLETED", "completed": "TRIAL_COMPLETED", "failed": "TRIAL_FAILED", "model_loaded": "MODEL_LOADED", "reused": "MODEL_LOADED reused"}


def split_output(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Output cut at carriage returns and line feeds; empty records go."""
    rows = df.select(*keys, F.posexplode(F.split(value, "[\r\n]+")).alias("ordinal", "line"))
    return rows.where("line <> ''")


def step_events(df: DataFrame, line: str = "line", markers: Mapping[str, str] = MARKERS) -> DataFrame:
    """step / of_steps of lines that begin with ``step N/M``, and the ``markers`` a line carries."""
    clean = stripped(F.regexp_replace(strip_terminal_control(F.col(line)), r"(?U)\s+", " "))
    number = lambda k: F.regexp_extract(clean, r"^step\s+(\d+)/(\d+)\b", k).try_cast("int")
    return df.select("*", number(1).alias("step"), number(2).alias("of_steps"), *[F.contains(clean, F.lit(m)).alias(k) for k, m in markers.items()])


def mounts(df: DataFrame, line: str = "line") -> DataFrame:
    """(mount, file_system, device) of mountinfo lines."""
    parts = F.split(line, " ")
    tail = F.split(F.element_at(F.split(line, " - "), 2), " ")
    return df.select(F.replace(F.get(parts, F.lit(4)), F.lit("\\040"), F.lit(" ")).alias("mount"), F.get(tail, F.lit(0)).alias("file_system"), F.get(tail, F.lit(1)).alias("device")).where("mount is not null and file_system is not null")
