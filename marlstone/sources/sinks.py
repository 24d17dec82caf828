"""Write-once sinks: JSONL datasets, JSON documents, stages, terminal manifests, metrics, reports.

Paths may be in any store that Spark reaches. Writing the same content again is a no-op;
other content under the same name is an error. A terminal manifest is written last.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.lineage import checksum, stable_json
from marlstone.operators.publication import attempt_rows
from marlstone.sources.digests import EMPTY, digests


class WriteConflict(ValueError):
    """Other content is stored under the same name."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark names files."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString()


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """One rename; an error if the target is there. The target's folder is made."""
    p, fs = _fs(spark, target)
    fs.mkdirs(p.getParent())
    _rename(spark, source, target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    p, fs = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _rename(spark: SparkSession, source: str, target: str, replace: bool = False) -> None:
    """Atomically where the store can; an error if the target is there, unless it is a file to be replaced."""
    sc = spark.sparkContext
    src, _ = _fs(spark, source)
    dst, fs = _fs(spark, target)
    option = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = sc._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE if replace else option.NONE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(src), fs.makeQualified(dst), options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Under another name first, then renamed over what is there: readers see the old text or the new one."""
    p, fs = _fs(spark, path)
    temporary, _ = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    _rename(spark, temporary.toString(), path, replace=True)


def put_json(spark: SparkSession, path: str, value: Any) -> str:
    """Write-once JSON; returns its checksum."""
    text = stable_json(value)
    if exists(spark, path):
        if read_text(spark, path) != text:
            raise WriteConflict(path)
    else:
        write_text(spark, path, text)
    return checksum(value)


def file_checksums(spark: SparkSession, *paths: str) -> DataFrame:
    """path, sha256 and size_bytes of stored files (each is read by one task)."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


#: What a committed dataset says of itself; Spark's readers pass over names that begin so.
MANIFEST = "_manifest.json"


def dataset_manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest of a committed dataset: sha256, size_bytes, line_count and parts in order; None if there is none."""
    p, fs = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def verified_dataset(spark: SparkSession, path: str) -> dict[str, Any]:
    """The manifest of a dataset whose stored parts, in order, still have its digest; anything else is an error."""
    manifest = dataset_manifest(spark, path)
    if manifest is None:
        raise WriteConflict(f"{path}: no committed dataset")
    found = _described(spark, path)
    if found != manifest:
        raise WriteConflict(f"{path}: what is stored differs from its manifest")
    return manifest


def _described(spark: SparkSession, folder: str) -> dict[str, Any]:
    p, fs = _fs(spark, folder)
    parts = sorted(name for name in (f.getPath().getName() for f in fs.listStatus(p)) if name.startswith("part-"))
    row = digests(spark, folder, by_folder=True).first()
    found = EMPTY if row is None else row.asDict()
    return {k: found[k] for k in ("sha256", "size_bytes", "line_count")} | {"parts": parts}


def put_jsonl(df: DataFrame, path: str, order: Sequence[str], json_column: str = "line", replace: bool = False) -> str:
    """Write-once JSONL in ``order`` (then by line): parts are ranges, so read by name they are the ordered file.

    The parts are written to a folder beside the target, described by a manifest with the SHA-256
    of their bytes in order, and committed by one rename; a write that fails leaves nothing. The same
    lines again are a no-op; others are an error, or with ``replace`` take the place of the old ones,
    which are set aside until the new ones are there. Returns the digest.
    """
    spark = df.sparkSession
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    p, fs = _fs(spark, staged)
    try:
        df.orderBy(*order, json_column).select(F.col(json_column).alias("value")).write.option("lineSep", "\n").text(staged)
        made = _described(spark, staged)
        there = exists(spark, path)
        if there and (dataset_manifest(spark, path) or {}).get("sha256") == made["sha256"]:
            return made["sha256"]
        if there and not replace:
            raise WriteConflict(path)
        write_text(spark, f"{staged}/{MANIFEST}", stable_json(made))
        if there:
            _rename(spark, path, f"{staged}.old")
        _rename(spark, staged, path)
        fs.delete(p.suffix(".old"), True)
    finally:
        fs.delete(p, True)
    return made["sha256"]


def append_attempts(df: DataFrame, path: str) -> None:
    """Attempts by candidate; a request id that is stored already is not written again. Of differing rows the first counts."""
    spark = df.sparkSession
    new = attempt_rows(df)
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select("request_id"), "request_id", "left_anti")
    new.write.mode("append").partitionBy("candidate_id").parquet(path)


def put_stage(spark: SparkSession, root: str, stage: str, rows: int, checksums: Mapping[str, str], done: Iterable[str]) -> None:
    put_json(spark, f"{root}/stages/{stage}.json", {"stage": stage, "rows": rows, "checksums": dict(checksums), "completed": sorted(done)})


def finalize(spark: SparkSession, root: str, artifacts: Mapping[str, str], expected: Mapping[str, str], extra: Mapping[str, Any]) -> None:
    """Verify every artifact's checksum, then write the terminal manifest."""
    wrong = sorted(k for k, v in expected.items() if artifacts.get(k) != v)
    if wrong:
        raise WriteConflict(f"artifacts differ: {wrong}")
    put_json(spark, f"{root}/manifest.json", {"status": "completed", "artifact_checksums": dict(artifacts), **extra})


def completed(spark: SparkSession, root: str) -> dict[str, Any] | None:
    """The terminal manifest, the only sign of success."""
    path = f"{root}/manifest.json"
    return json.loads(read_text(spark, path)) if exists(spark, path) else None


def with_failure(spark: SparkSession, root: str, work: Callable[[], Any]) -> Any:
    """Run ``work``; a failure leaves failure.json and is raised again, whatever happens to that file."""
    try:
        return work()
    except Exception as e:
        try:
            write_text(spark, f"{root}/failure.json", stable_json({"error": type(e).__name__, "detail": str(e)[:1000]}))
        except Exception:
            logging.getLogger(__name__).exception("failure.json could not be written")
        raise


class Tracker:
    """Metric events as a long table; ``policy`` 'warn' logs one failure and goes quiet, 'error' raises."""

    def __init__(self, spark: SparkSession, path: str | None, run_id: str, policy: str = "warn") -> None:
        if policy not in ("warn", "error"):
            raise ValueError(f"unknown policy {policy}")
        self.spark, self.path, self.run_id, self.policy, self.active = spark, path, run_id, policy, path is not None

    def log_metrics(self, values: Mapping[str, float], step: int = 0) -> None:
        rows = [(self.run_id, k, float(v), step) for k, v in values.items() if isinstance(v, (int, float)) and not isinstance(v, bool)]
        self._write(lambda: self.spark.createDataFrame(rows, "run_id string, name string, value double, step long").write.mode("append").parquet(f"{self.path}/metrics"), bool(rows))

    def log_artifacts(self, artifacts: Mapping[str, tuple[str, str]]) -> None:
        rows = [(self.run_id, k, uri, digest) for k, (uri, digest) in artifacts.items()]
        self._write(lambda: self.spark.createDataFrame(rows, "run_id string, name string, uri string, checksum string").write.mode("append").parquet(f"{self.path}/artifacts"), bool(rows))

    def _write(self, write: Callable[[], None], some: bool) -> None:
        if not (self.active and some):
            return
        try:
            write()
        except Exception:
            if self.policy == "error":
                raise
            logging.getLogger(__name__).warning("tracking failed and is off from here", exc_info=True)
            self.active = False


def render_table(rows: Sequence[Mapping[str, Any]]) -> str:
    """Fixed-width text; columns in the order in which they first occur; 'No records.' without rows."""
    if not rows:
        return "No records."
    columns = list(dict.fromkeys(k for r in rows for k in r))
    cells = [columns, *[["" if r.get(c) is None else str(r[c]) for c in columns] for r in rows]]
    widths = [max(len(line[k]) for line in cells) for k in range(len(columns))]
    return "\n".join("  ".join(x.ljust(w) for x, w in zip(line, widths)).rstrip() for line in cells)


def render_nested(value: Any, indent: int = 0) -> str:
    """Any JSON value as indented text: labelled fields, flat lists of objects as tables, other lists by number."""
    pad = " " * indent
    show = lambda v: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, sort_keys=True, default=str)
    nested = lambda v: isinstance(v, (Mapping, list, tuple))
    if isinstance(value, Mapping):
        lines = [f"{pad}{_label(k)}:\n{render_nested(v, indent + 2)}" if nested(v) else f"{pad}{_label(k)}: {show(v)}" for k, v in value.items()]
        return "\n".join(lines) or f"{pad}No fields."
    if not nested(value):
        return pad + show(value)
    if not value:
        return f"{pad}No records."
    if all(isinstance(v, Mapping) and v and not any(map(nested, v.values())) for v in value):
        columns = list(dict.fromkeys(k for v in value for k in v))
        cells = [[_label(c) for c in columns], *[[show(v.get(c)) for c in columns] for v in value]]
        widths = [max(map(len, column)) for column in zip(*cells)]
        rows = ["  ".join(x.ljust(w) for x, w in zip(line, widths)) for line in [cells[0], ["-" * w for w in widths], *cells[1:]]]
        return "\n".join(pad + r.rstrip() for r in rows)
    return "\n".join(f"{pad}Record {k}:\n{render_nested(v, indent + 2)}" if nested(v) else f"{pad}- {show(v)}" for k, v in enumerate(value, 1))


def _label(name: str) -> str:
    return str(name).replace("_", " ").strip().capitalize()


def render_markdown(rows: Sequence[Mapping[str, Any]]) -> str:
    if not rows:
        return "No records."
    columns = list(dict.fromkeys(k for r in rows for k in r))
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([line(columns), line(["---"] * len(columns)), *[line([r.get(c) for c in columns]) for r in rows]])


def to_toml(values: Mapping[str, Any]) -> str:
    """Flat settings as TOML; nulls are left out."""
    render = lambda v: json.dumps(v, ensure_ascii=False) if not isinstance(v, (list, tuple)) else "[" + ", ".join(json.dumps(x, ensure_ascii=False) for x in v) + "]"
    return "".join(f"{k} = {render(v)}\n" for k, v in values.items() if v is not None)
