"""Publishing runs: identities, requests, predictions, bundles, and the terminal manifest last."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.checks import ConstraintError, require_none
from marlstone.lineage import LineageIds, checksum
from marlstone.operators import publication as P
from marlstone.operators.metrics import bundle_checksum
from marlstone.sources import sinks

TERMINAL = "publication-manifest.json"


def run_root(root: str, ids: LineageIds) -> str:
    return f"{root}/experiments/{ids.experiment_id}/runs/{ids.training_run_id}"


def put_experiment(spark: SparkSession, root: str, ids: LineageIds, details: Mapping[str, Any]) -> str:
    """The experiment's document; what was written first stays if the details are the same."""
    return sinks.put_json(spark, f"{root}/experiments/{ids.experiment_id}/experiment.json", {"experiment_id": ids.experiment_id, **details})


def put_variant(spark: SparkSession, root: str, ids: LineageIds, identity: Mapping[str, Any], lineage: Mapping[str, Any]) -> str:
    body = {"experiment_id": ids.experiment_id, "training_variant_id": ids.training_variant_id, "identity": dict(identity), "lineage": dict(lineage), "identity_checksum": checksum(identity)}
    return sinks.put_json(spark, f"{root}/experiments/{ids.experiment_id}/variants/{ids.training_variant_id}.json", body)


def put_request(spark: SparkSession, root: str, ids: LineageIds, lineage: Mapping[str, Any], request: Mapping[str, Any]) -> str:
    keys = ("dataset_manifest_uri", "dataset_manifest_checksum")
    return sinks.put_json(spark, f"{run_root(root, ids)}/training-request.json", {**ids.as_dict(), **{k: lineage.get(k) for k in keys}, "request": dict(request)})


def put_predictions(rows: DataFrame, path: str) -> str:
    """Prediction rows as JSONL, ordered by record id; returns their digest. A later call replaces them."""
    line = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    lines = rows.select("dataset_record_id", line.alias("line"))
    return sinks.put_jsonl(lines, path, ["dataset_record_id"], replace=True)


def bundle_files(spark: SparkSession, folder: str, manifest_uri: str) -> DataFrame:
    """(manifest_uri, path, sha256, size_bytes) of a stored bundle's files, without its descriptions."""
    base = sinks.qualified(spark, folder)
    found = sinks.file_checksums(spark, folder).withColumn("path", F.substring_index("path", base + "/", -1))
    return found.where(~F.col("path").isin(*P.DESCRIPTIONS)).select(F.lit(manifest_uri).alias("manifest_uri"), "path", "sha256", "size_bytes")


def verified_bundle(spark: SparkSession, folder: str, required: Sequence[str] = P.REQUIRED_FILES) -> str:
    """The checksum of a bundle that is as its manifest says; anything else is an error."""
    uri = f"{folder}/adapter-manifest.json"
    manifest = json.loads(sinks.read_text(spark, uri))
    listing = json.loads(sinks.read_text(spark, f"{folder}/checksums.json"))
    if listing != {"files": manifest["files"], "bundle_checksum": manifest["bundle_checksum"]}:
        raise ConstraintError(f"{folder}: the list of checksums and the manifest differ")
    ddl = "manifest_uri string, path string, sha256 string, size_bytes long"
    files = spark.createDataFrame([(uri, f["path"], f["sha256"], int(f["size_bytes"])) for f in manifest["files"]], ddl)
    declared = spark.createDataFrame([(uri, manifest["bundle_checksum"])], "manifest_uri string, bundle_checksum string")
    require_none(P.bundle_problems(files, bundle_files(spark, folder, uri), declared, required), f"bundle {folder}")
    return manifest["bundle_checksum"]


def put_bundle(spark: SparkSession, folder: str, ids: LineageIds, details: Mapping[str, Any], required: Sequence[str] = P.REQUIRED_FILES) -> str:
    """Describe the files of a stored bundle and verify it; returns the bundle's checksum."""
    rows = bundle_files(spark, folder, "").orderBy("path").collect()
    files = [{"path": r.path, "sha256": r.sha256, "size_bytes": r.size_bytes} for r in rows]
    whole = bundle_checksum(spark.createDataFrame([("", f["path"], f["sha256"], f["size_bytes"]) for f in files], "k string, path string, sha256 string, size_bytes long"), "k").first().checksum if files else ""
    sinks.put_json(spark, f"{folder}/checksums.json", {"files": files, "bundle_checksum": whole})
    sinks.put_json(spark, f"{folder}/adapter-manifest.json", {**ids.as_dict(), **details, "files": files, "bundle_checksum": whole})
    return verified_bundle(spark, folder, required)


def publish_run(spark: SparkSession, root: str, ids: LineageIds, bundle: str, documents: Mapping[str, Mapping[str, Any]], predictions: Mapping[str, DataFrame], details: Mapping[str, Any] | None = None) -> dict[str, Any]:
    """Bundle, documents, predictions, and the terminal manifest when all of them are stored."""
    where = run_root(root, ids)
    sums = {"adapter_bundle": put_bundle(spark, bundle, ids, details or {})}
    sums |= {f"{name}.json": sinks.put_json(spark, f"{where}/{name}.json", body) for name, body in documents.items()}
    sums |= {f"{name}-predictions": put_predictions(rows, f"{where}/{name}-predictions") for name, rows in predictions.items()}
    terminal = {"status": "completed", **ids.as_dict(), "adapter_uri": bundle, "artifact_checksums": sums, **{f"{name}_predictions_uri": f"{where}/{name}-predictions" for name in predictions}}
    sinks.put_json(spark, f"{where}/{TERMINAL}", terminal)
    return terminal


def completed_run(spark: SparkSession, root: str, ids: LineageIds) -> dict[str, Any] | None:
    """A run's terminal manifest, after verifying that it is this run's and that the bundle is whole; None if there is none."""
    path = f"{run_root(root, ids)}/{TERMINAL}"
    if not sinks.exists(spark, path):
        return None
    terminal = json.loads(sinks.read_text(spark, path))
    wrong = [k for k, v in ids.as_dict().items() if terminal.get(k) != v]
    if terminal.get("status") != "completed" or wrong:
        raise ConstraintError(f"{path}: not the completed run that was asked for ({wrong or 'status'})")
    if verified_bundle(spark, terminal["adapter_uri"]) != terminal["artifact_checksums"].get("adapter_bundle"):
        raise ConstraintError(f"{path}: another bundle is stored")
    return terminal


def finalize_evaluation(spark: SparkSession, root: str, artifacts: Mapping[str, str], extra: Mapping[str, Any]) -> dict[str, str]:
    """Checksums of all artifacts (name to path), computed from what is stored, then the terminal manifest."""
    found = {r.path: r.sha256 for r in sinks.file_checksums(spark, *artifacts.values()).collect()}
    by_name = {name: found.get(sinks.qualified(spark, path)) for name, path in artifacts.items()}
    missing = sorted(k for k, v in by_name.items() if v is None)
    if missing:
        raise ConstraintError(f"artifacts aren't stored: {missing}")
    sinks.finalize(spark, root, by_name, by_name, extra)
    return by_name


def final_report(models: Mapping[str, Mapping[str, Any]]) -> str:
    """The safest combination of each model as Markdown: one table of settings and figures a model."""
    if not models:
        return "# Safe combinations\n\nNo completed trials.\n"
    show = lambda v: "unavailable" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v)
    parts = ["# Safe combinations", ""]
    for name, fields in models.items():
        parts += [f"## {name}", "", *(f"- {k}: {show(v)}" for k, v in fields.items()), ""]
    return "\n".join(parts)
