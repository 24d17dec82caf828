"""Datasets behind manifests: research packages, their checks, and evidence by lineage."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.checks import ConstraintError, require_none
from marlstone.functions.text import is_blank
from marlstone.lineage import checksum, manifest_checksum
from marlstone.operators import evidence
from marlstone.operators import records as R
from marlstone.sources import digests, jsonl
from marlstone.sources.sinks import read_text

#: The fields in which a package's reference equals the evaluation set's manifest.
REFERENCE_FIELDS = ("evaluation_set_id", "evaluation_set_version", "research_role", "records_checksum", "record_count", "freeze_checksum", "manifest_checksum")
REQUIRED_ROLE = "exact_recall"


def load_manifest(spark: SparkSession, path: str) -> dict[str, Any]:
    value = json.loads(read_text(spark, path))
    if not isinstance(value, dict):
        raise ConstraintError(f"{path} must contain a JSON object")
    return value


def package_problems(package: dict[str, Any], manifests: dict[str, dict[str, Any]], dataset: dict[str, Any] | None = None, schemas: dict[str, str] | None = None) -> list[str]:
    """What is wrong with a package, its dataset and its evaluation sets, in a fixed order.

    ``manifests`` are the evaluation sets' by URI; ``schemas`` names the expected schema of
    ``dataset`` and ``evaluation_set``, where a deployment has fixed them.
    """
    schemas, out = schemas or {}, []
    if package.get("manifest_checksum") is None:
        out.append("package checksum is missing")
    elif package["manifest_checksum"] != manifest_checksum(package):
        out.append("package checksum differs")
    ref = package.get("dataset")
    if not isinstance(ref, dict) or not ref.get("manifest_uri"):
        out.append("package needs one dataset")
    elif dataset is not None:
        if "dataset" in schemas and dataset.get("schema_version") != schemas["dataset"]:
            out.append("dataset schema differs")
        if dataset.get("records_checksum") != ref.get("records_checksum"):
            out.append("dataset records_checksum differs")
    roles = []
    for ref in package.get("evaluation_sets", []):
        m = manifests.get(ref.get("manifest_uri"))
        if m is None:
            out.append(f"missing manifest {ref.get('manifest_uri')}")
            continue
        if "evaluation_set" in schemas and m.get("schema") != schemas["evaluation_set"]:
            out.append(f"{m.get('evaluation_set_id')}: schema differs")
        if m.get("manifest_checksum") != manifest_checksum(m):
            out.append(f"{m.get('evaluation_set_id')}: its own checksum differs")
        if m.get("training_eligible") is not False:
            out.append(f"{m.get('evaluation_set_id')} must not be trainable")
        out += [f"{m.get('evaluation_set_id')}: {k} differs" for k in REFERENCE_FIELDS if ref.get(k) != m.get(k)]
        roles.append(m.get("research_role"))
    if len(set(roles)) < len(roles):
        out.append("roles must be unique")
    if REQUIRED_ROLE not in roles:
        out.append(f"{REQUIRED_ROLE} is required")
    return out


def package_records(spark: SparkSession, package_path: str, locate: Callable[[str], str] = lambda uri: uri, schemas: dict[str, str] | None = None) -> DataFrame:
    """Dataset records, then each evaluation set's, normalised, after all checks of package, files and records."""
    package = load_manifest(spark, locate(package_path))
    dataset = load_manifest(spark, locate(package["dataset"]["manifest_uri"])) if isinstance(package.get("dataset"), dict) else {}
    manifests = {r["manifest_uri"]: load_manifest(spark, locate(r["manifest_uri"])) for r in package.get("evaluation_sets", [])}
    problems = package_problems(package, manifests, dataset, schemas)
    if problems:
        raise ConstraintError("; ".join(problems))
    return _checked_records(spark, dataset, list(manifests.values()), locate)


def dataset_records(spark: SparkSession, manifest_path: str, locate: Callable[[str], str] = lambda uri: uri) -> DataFrame:
    """The normalised records of one dataset manifest, after the checks of file and records."""
    return _checked_records(spark, load_manifest(spark, locate(manifest_path)), [], locate)


def _checked_records(spark: SparkSession, dataset: dict[str, Any], sets: list[dict[str, Any]], locate: Callable[[str], str]) -> DataFrame:
    files = {locate(m["records_uri"]): m.get("records_checksum") for m in (dataset, *sets)}
    lacking = [p for p, c in files.items() if not c]
    if lacking:
        raise ConstraintError(f"no records checksum for {lacking}")
    require_none(digests.differing(spark, files), "records checksum differs")
    raw = jsonl.records(spark, *files)
    require_none(raw.where("error is not null").select("error"), "records that are no JSON objects")
    own = R.with_metadata(raw)
    bad = own.where(F.col("split").isNull() | R.messages_error(F.col("messages")).isNotNull())
    require_none(bad.select("source_uri", "line_number", R.messages_error(F.col("messages")).alias("why")), "invalid records")
    require_none(R.read_problems(own, {k + 1: m for k, m in enumerate(sets)}), "records break their manifests")
    return own


#: Counts of a manifest that make up its split summary and record counts.
SPLIT_COUNTS = {"train": "train_count", "validation": "validation_count", "test": "test_count", "evaluation_total": "eval_count"}
RECORD_COUNTS = {"accepted": "accepted_count", "candidates": "candidate_count", "rejected": "rejected_count", "needs_review": "needs_review_count", "duplicates": "duplicate_count"}
#: Fields of a lineage that come from the manifest, those that are checksums, and those of an evaluation set.
LINEAGE_FIELDS = ("dataset_id", "dataset_name", "dataset_version", "dataset_variant_id", "records_uri", "recipe", "source_manifest_uri")
LINEAGE_CHECKSUMS = ("records_checksum", "source_manifest_checksum", "configuration_checksum")
SET_FIELDS = ("evaluation_set_id", "evaluation_set_version", "research_role", "records_uri", "records_checksum", "record_count", "manifest_checksum", "freeze_checksum")


def dataset_lineage(manifest: dict[str, Any], uri: str, package: dict[str, Any] | None = None, sets: dict[str, dict[str, Any]] | None = None) -> dict[str, Any]:
    """The lineage of a dataset: 21 fields, known zero counts kept, absent counts absent.

    ``uri`` is what was asked for: the dataset's manifest, or the package that leads to it.
    """
    bare = lambda c: None if c is None else c.removeprefix("sha256:")
    counts = lambda name, parts: dict(manifest.get(name) or {}) or {k: int(manifest[c]) for k, c in parts.items() if manifest.get(c) is not None}
    own = package or {}
    return {
        **{k: manifest.get(k) for k in LINEAGE_FIELDS},
        **{k: bare(manifest.get(k)) for k in LINEAGE_CHECKSUMS},
        "dataset_manifest_uri": manifest.get("dataset_manifest_uri") or (own.get("dataset") or {}).get("manifest_uri") or uri,
        "dataset_manifest_checksum": checksum(manifest),
        "split_summary": counts("split_summary", SPLIT_COUNTS),
        "record_counts": counts("record_counts", RECORD_COUNTS),
        "overlength_policy": str(manifest.get("overlength_policy", "error")),
        "skipped_records": list(manifest.get("skipped_records") or ()),
        "research_package_manifest_uri": uri if package else None,
        "research_package_manifest_checksum": own.get("manifest_checksum"),
        "research_package_id": own.get("research_package_id"),
        "research_package_version": own.get("research_package_version"),
        "evaluation_sets": [{"manifest_uri": u, **{k: m.get(k) for k in SET_FIELDS}} for u, m in (sets or {}).items()],
    }


def preflight_problems(manifest: dict[str, Any], counted: dict[str, int], packaged: bool = False) -> list[str]:
    """Where a manifest's counts and the counted records differ (``counted``: one row of records.preflight)."""
    out = []
    pairs = [("train_count", "trainable_records")] + ([] if packaged else [("eval_count", "evaluation_records")])
    out += [f"{a}: {manifest[a]} declared, {counted[b]} found" for a, b in pairs if manifest.get(a) is not None and int(manifest[a]) != counted[b]]
    if manifest.get("accepted_count") is not None and int(manifest["accepted_count"]) < counted["accepted_examples"]:
        out.append(f"accepted_count: {manifest['accepted_count']} declared, {counted['accepted_examples']} accepted")
    if not counted["accepted_examples"]:
        out.append("no trainable example is left")
    return out


def evidence_of(spark: SparkSession, lineage: dict[str, Any], locate: Callable[[str], str] = lambda uri: uri) -> tuple[DataFrame | None, list[dict[str, Any]]]:
    """Evidence by way of lineage, dataset manifest and source manifest, and failure rows (uri, category, detail).

    Nothing raises: a missing link, an unreadable file or ids with different contents are failures.
    """
    failures: list[dict[str, Any]] = []

    def load(uri: Any, what: str) -> dict[str, Any] | None:
        if not isinstance(uri, str) or not uri:
            failures.append({"uri": uri, "category": "missing_uri", "detail": what})
            return None
        try:
            return load_manifest(spark, locate(uri))
        except Exception as e:  # noqa: BLE001  failures are collected
            failures.append({"uri": uri, "category": "artifact_unavailable", "detail": str(e).splitlines()[0]})
            return None

    dataset = load(lineage.get("dataset_manifest_uri"), "dataset_manifest_uri")
    source_uri = None if dataset is None else dataset.get("source_manifest_uri") or lineage.get("source_manifest_uri")
    source = None if dataset is None else load(source_uri, "source_manifest_uri")
    if source is None:
        return None, failures
    if not isinstance(source.get("evidence_refs"), list):
        failures.append({"uri": source_uri, "category": "evidence_refs_missing", "detail": "no list of evidence"})
        return None, failures
    found, more = evidence_items(spark, source, locate)
    failures += more
    if found is not None:
        differ = evidence.conflicting(evidence.texts(found)).orderBy("evidence_id").limit(20).collect()
        failures += [{"uri": source_uri, "category": "conflicting_evidence", "detail": r.evidence_id} for r in differ]
    return found, failures


def evidence_items(spark: SparkSession, source_manifest: dict[str, Any], locate: Callable[[str], str] = lambda uri: uri) -> tuple[DataFrame | None, list[dict[str, str]]]:
    """Evidence rows of all ``evidence_refs``, and the references that can't be read."""
    found, failures = None, []
    for ref in source_manifest.get("evidence_refs", []):
        uri = ref.get("uri") if isinstance(ref, dict) else ref
        try:
            lines = spark.read.text(locate(uri)).where(~is_blank(F.col("value")))
            lines.limit(1).collect()
        except Exception as e:  # noqa: BLE001  failures are collected
            failures.append({"uri": uri, "category": "unreadable", "detail": str(e).splitlines()[0]})
            continue
        r = F.from_json("value", "evidence_id STRING, id STRING, text STRING, content STRING, chunk_text STRING, normalized_text STRING")
        own = lines.select(r.alias("r")).select("r.*")
        found = own if found is None else found.unionByName(own)
    return found, failures
