"""Published runs as tables: prediction rows, evidence to keep, and what is wrong with candidates.

JSON columns hold text. A key that is absent and one that holds null differ: of several objects
that are merged the last one that *has* the key decides.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import is_blank, strip_checksum
from marlstone.operators.metrics import bundle_checksum

#: Identities of a run, columns copied from an output under another name, and merged keys.
IDENTITIES = ("experiment_id", "training_variant_id", "training_run_id", "adapter_id")
RENAMED = {"dataset_record_id": "record_id", "prompt": "prompt", "expected_answer": "expected", "generated_answer": "generated"}
LISTS = ("evidence_ids", "source_asset_ids", "document_ids")
MERGED = ("probe_id", "probe_class", "recipe", "research_role", "evaluation_set_id", "evaluation_set_version", "source_record_id", "source_reference_id", "fact_group_id")
#: Files that a bundle must have, and those that describe it.
REQUIRED_FILES = ("adapter_config.json", "adapter_model.safetensors")
DESCRIPTIONS = ("checksums.json", "adapter-manifest.json")


def has(json: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(json), key), F.lit(False))


def merged_value(key: str, *objects: Column) -> Column:
    """The value of ``key`` as text in the last of ``objects`` (JSON) that has it, null or not."""
    value = F.lit(None).cast("string")
    for own in objects:
        value = F.when(has(own, key), F.get_json_object(own, f"$.{key}")).otherwise(value)
    return value


def string_list(json: Column) -> Column:
    """A JSON list, or one value as a list of one, as distinct strings in order, without nulls; null is empty."""
    many = F.when(F.startswith(json, F.lit("[")), F.from_json(json, "array<string>")).when(json.isNotNull(), F.array(json))
    return F.coalesce(F.array_distinct(F.array_compact(many)), F.array().cast("array<string>"))


def prediction_rows(outputs: DataFrame, prediction_type: str, decoding: str = "{}", base_model: str = "{}") -> DataFrame:
    """The 29 columns of saved predictions from outputs: the identities and ``output`` (a JSON object).

    Keys are looked up in the output, then its metadata, then its provenance. A single knowledge
    unit leads its list; only trained predictions name an adapter.
    """
    o = F.col("output")
    part = lambda k: F.coalesce(F.get_json_object(o, f"$.{k}"), F.lit("{}"))
    own = outputs.withColumns({"_p": part("provenance"), "_m": part("metadata")})
    order = (F.col("_p"), F.col("_m"), o)
    unit, units = merged_value("knowledge_unit_id", *order), string_list(merged_value("knowledge_unit_ids", *order))
    led = F.when(unit.isNull() | F.array_contains(units, unit), units).otherwise(F.concat(F.array(unit), units))
    return own.select(
        *IDENTITIES[:3],
        (F.col("adapter_id") if prediction_type == "trained" else F.lit(None).cast("string")).alias("adapter_id"),
        *[F.get_json_object(o, f"$.{k}").alias(name) for name, k in RENAMED.items()],
        *[F.get_json_object(o, f"$.{k}").cast("boolean").alias(k) for k in ("exact_match", "contains_expected")],
        unit.alias("knowledge_unit_id"),
        led.alias("knowledge_unit_ids"),
        *[string_list(merged_value(k, *order)).alias(k) for k in LISTS],
        *[merged_value(k, *order).alias(k) for k in MERGED],
        F.col("_p").alias("provenance"),
        F.col("_m").alias("metadata"),
        F.lit(decoding).alias("decoding"),
        F.lit(base_model).alias("base_model"),
        F.lit(prediction_type).alias("prediction_type"),
    )


def stored_evidence(found: Column, store_text: bool = False) -> Column:
    """What is kept of resolved evidence: id and hash, and the text only if wanted."""
    names = ("evidence_id", "content_sha256", *(("text",) if store_text else ()))
    return F.transform(found, lambda e: F.struct(*[e[n].alias(n) for n in names]))


def rejection(request_id: Column, reason: str, detail: Column) -> tuple[Column, ...]:
    """The columns of a rejected attempt beside its keys."""
    return request_id.alias("request_id"), F.lit(reason).alias("reason"), detail.alias("detail")


def evaluation_view(manifests: DataFrame) -> DataFrame:
    """The five fields of an evaluation's terminal manifest that a reader is shown."""
    return manifests.select("evaluation_run_id", "evaluation_variant_id", "status", "aggregate", "recommendation")


def attempt_rows(attempts: DataFrame) -> DataFrame:
    """Stored attempts in the order of their request ids, each request once.

    Of a request's differing rows the first by their text as JSON counts; ``conflicting_attempts`` tells of the others.
    """
    text = F.to_json(F.struct(*attempts.columns), {"ignoreNullFields": "false"})
    first = attempts.groupBy("request_id").agg(F.min_by(F.struct(*attempts.columns), text).alias("first"))
    return first.select("first.*").orderBy(F.coalesce("request_id", F.lit("")))


def conflicting_attempts(attempts: DataFrame) -> DataFrame:
    """Requests that are stored with different contents: how many contents and rows."""
    text = F.to_json(F.struct(*attempts.columns), {"ignoreNullFields": "false"})
    by_content = attempts.groupBy("request_id", F.sha2(text, 256).alias("content")).agg(F.count("*").alias("n"))
    return by_content.groupBy("request_id").agg(F.count("*").alias("contents"), F.sum("n").alias("rows")).where("contents > 1")


def distinct_identities(df: DataFrame, *columns: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct identities as sorted canonical texts, one array a key (short: one entry an identity)."""
    one = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return df.select(*keys, one.alias("identity")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("identity")).alias("identities"))


def parameter_counts(parameters: DataFrame) -> DataFrame:
    """All and trainable parameters of models from rows (model, elements, trainable)."""
    return parameters.groupBy("model").agg(F.sum("elements").alias("total"), F.coalesce(F.sum(F.when(F.col("trainable"), F.col("elements"))), F.lit(0)).alias("trainable"))


def directory_sizes(files: DataFrame, *keys: str) -> DataFrame:
    """Bytes of all files by key, from a listing (path, length)."""
    return files.groupBy(*keys).agg(F.sum("length").alias("size_bytes"), F.count("*").alias("files"))


def peak_percentages(reports: DataFrame) -> DataFrame:
    """Largest device memory share (nulls skipped) and host memory share of each report."""
    peaks = F.transform("gpu_usage", lambda g: g["memory_peak_percent"].cast("double"))
    return reports.select("report_id", F.array_max(F.array_compact(peaks)).alias("gpu_memory_peak_percent"), F.col("system_usage.system_ram_peak_percent").cast("double").alias("ram_peak_percent"))


def _problem(rows: DataFrame, rule: str, detail: Column) -> DataFrame:
    return rows.select(F.col("manifest_uri"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def bundle_problems(files: DataFrame, stored: DataFrame, declared: DataFrame, required: Sequence[str] = REQUIRED_FILES) -> DataFrame:
    """What is wrong with published bundles, as rows (manifest_uri, rule, detail).

    ``files`` (manifest_uri, path, sha256, size_bytes) is what manifests say, ``stored`` the same
    columns as found, ``declared`` (manifest_uri, bundle_checksum) each manifest's own checksum.
    Rules: required files, paths that leave the bundle, missing files, sizes, hashes, the bundle.
    """
    wanted = F.explode(F.array(*[F.lit(r) for r in required])).alias("path")
    lacking = declared.select("manifest_uri", wanted).join(files, ["manifest_uri", "path"], "left_anti")
    escapes = files.where(F.col("path").rlike(r"^/|(^|/)\.\.(/|$)"))
    got = stored.select("manifest_uri", "path", F.col("sha256").alias("got"), F.col("size_bytes").alias("got_size"))
    met = files.where(~F.col("path").isin(*DESCRIPTIONS)).join(got, ["manifest_uri", "path"], "left")
    path = F.col("path")
    whole = bundle_checksum(files, "manifest_uri").join(declared, "manifest_uri", "right").where(~F.col("checksum").eqNullSafe(strip_checksum(F.col("bundle_checksum"))))
    return (
        _problem(lacking, "required_file", path)
        .union(_problem(escapes, "path_escapes", path))
        .union(_problem(met.where("got is null"), "file_missing", path))
        .union(_problem(met.where("got_size <> size_bytes"), "size_differs", path))
        .union(_problem(met.where("got_size = size_bytes and got <> sha256"), "checksum_differs", path))
        .union(_problem(whole, "bundle_differs", F.col("bundle_checksum")))
    )


def candidate_problems(manifests: DataFrame, artifacts: DataFrame, schema_version: str, uris: Sequence[str]) -> DataFrame:
    """What keeps published runs from being compared, as rows (manifest_uri, rule, detail).

    ``manifests`` has manifest_uri, schema_version, status, training_run_id, adapter_id and the
    columns ``uris``; ``artifacts`` (manifest_uri, name, expected, actual) their checksums.
    """
    out = _problem(manifests.where(~F.col("schema_version").eqNullSafe(F.lit(schema_version))), "schema", F.col("schema_version"))
    out = out.union(_problem(manifests.where(~F.col("status").eqNullSafe(F.lit("completed"))), "not_completed", F.col("status")))
    for name in ("training_run_id", "adapter_id"):
        out = out.union(_problem(manifests.where(is_blank(F.col(name))), f"{name}_missing", F.col(name)))
        again = manifests.where(~is_blank(F.col(name))).groupBy(name).agg(F.count("*").alias("n"), F.max("manifest_uri").alias("manifest_uri")).where("n > 1")
        out = out.union(_problem(again, f"{name}_repeated", F.col(name)))
    for name in uris:
        out = out.union(_problem(manifests.where(~F.coalesce(F.startswith(name, F.lit("storage://")), F.lit(False))), "uri", F.lit(name)))
    differs = artifacts.where(~strip_checksum(F.col("expected")).eqNullSafe(F.col("actual")))
    return out.union(_problem(differs, "artifact_differs", F.col("name")))


def suite_rows(reports: DataFrame) -> DataFrame:
    """(run_id, phase, suite, name, value): the numbers of every suite of a run's report, for backfilling a tracker.

    ``reports`` has run_id and ``report`` (JSON text); booleans and texts aren't numbers.
    """
    phase = F.explode(F.array(F.lit("baseline"), F.lit("trained"))).alias("phase")
    own = reports.select("run_id", "report", phase)
    suites = F.coalesce(*[F.when(F.col("phase") == p, F.get_json_object("report", f"$.evaluation.{p}.suite_metrics")) for p in ("baseline", "trained")])
    one = own.select("run_id", "phase", F.explode(F.from_json(suites, "map<string,string>")).alias("suite", "body"))
    values = one.select("run_id", "phase", "suite", F.explode(F.from_json("body", "map<string,string>")).alias("name", "text"))
    return values.where(F.col("text").rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$")).select("run_id", "phase", "suite", "name", F.col("text").cast("double").alias("value"))


def backfill_payload(publication: Mapping, metrics: Mapping, report: Mapping) -> dict:
    """A tracker's payload of a completed run from its stored documents (the suites come from ``suite_rows``)."""
    if publication.get("status") != "completed":
        raise ValueError("only a completed publication can be tracked")
    references = ("adapter_uri", "adapter_manifest_uri", "training_report_uri", "baseline_predictions_uri", "trained_predictions_uri")
    return {
        "identity": {k: publication.get(k) for k in IDENTITIES},
        "parameters": dict(report.get("configuration") or {}),
        "metrics": dict(metrics),
        "resources": {k: report.get(k) for k in ("system_usage", "gpu_usage")},
        "run_metadata": {"registration_mode": "backfill", **{f"original_{k}": report.get(k) for k in ("started_at", "finished_at", "duration_seconds")}},
        "artifact_references": {k: publication.get(k) for k in references},
        "artifact_checksums": dict(publication.get("artifact_checksums") or {}),
    }
