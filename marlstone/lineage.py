"""Deterministic and unique ids of experiments, runs, variants and requests (driver side)."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from typing import Any

SEPARATOR = "\x1f"


def stable_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def checksum(value: Any) -> str:
    return hashlib.sha256(stable_json(value).encode()).hexdigest()


def manifest_checksum(manifest: dict[str, Any]) -> str:
    """The checksum of a manifest without its own checksum field."""
    return checksum({k: v for k, v in manifest.items() if k != "manifest_checksum"})


def _unique(prefix: str) -> str:
    return f"{prefix}-{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def experiment_id() -> str:
    return _unique("exp")


def training_run_id(run: str | None = None) -> str:
    if run is None:
        return _unique("trun")
    return run if run.startswith("trun-") else f"trun-{run}"


def adapter_id(experiment: str, run: str) -> str:
    return "adp-" + hashlib.sha256(SEPARATOR.join((experiment, run)).encode()).hexdigest()[:24]


def variant_id(identity: dict[str, Any], prefix: str = "tvar-") -> str:
    return prefix + checksum(identity)[:20]


#: The settings and dataset fields that change a training result.
RESULT_SETTINGS = (
    "backend", "load_in_4bit", "lora_rank", "lora_alpha", "lora_dropout", "max_sequence_length", "learning_rate", "per_device_train_batch_size", "gradient_accumulation_steps",
    "max_examples", "max_steps", "seed", "overlength_policy", "data_order",
)
RESULT_DATASET = ("dataset_id", "dataset_version", "dataset_variant_id", "manifest_checksum", "records_checksum", "recipe")


def variant_identity(configuration: dict[str, Any], dataset: dict[str, Any], base_model: dict[str, Any] | None = None) -> dict[str, Any]:
    """What changes a training result, and nothing else; target modules in order; unset is null."""
    own = {k: configuration.get(k) for k in RESULT_SETTINGS}
    own["target_modules"] = sorted(configuration.get("target_modules") or ())
    return {"dataset": {k: dataset.get(k) for k in RESULT_DATASET}, "base_model": dict(base_model or {}), "training": own}


def package_lineage(lineage: dict[str, Any]) -> dict[str, Any] | None:
    """The research package behind a dataset (never a part of the variant's identity), if there is one."""
    if lineage.get("research_package_manifest_uri") is None:
        return None
    keys = ("research_package_id", "research_package_version", "research_package_manifest_uri", "research_package_manifest_checksum")
    return {**{k.removeprefix("research_package_") if "manifest" in k else k: lineage.get(k) for k in keys}, "evaluation_sets": [dict(s) for s in lineage.get("evaluation_sets", ())]}


#: Prefixes of the identities.
PREFIXES = {"experiment_id": "exp-", "training_variant_id": "tvar-", "training_run_id": "trun-", "adapter_id": "adp-"}
_SEGMENT = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def validated(value: str, prefix: str) -> str:
    """The id, if it has the prefix and is one path segment of safe characters; else an error."""
    if value.startswith(prefix) and _SEGMENT.fullmatch(value):
        return value
    raise ValueError(f"{value!r} is no safe id that starts with {prefix}")


@dataclass(frozen=True)
class LineageIds:
    """The four identities of one training run."""

    experiment_id: str
    training_variant_id: str
    training_run_id: str
    adapter_id: str

    def __post_init__(self) -> None:
        for name, prefix in PREFIXES.items():
            validated(getattr(self, name), prefix)

    def as_dict(self) -> dict[str, str]:
        return asdict(self)


def lineage_ids(identity: dict[str, Any], experiment: str | None = None, run: str | None = None) -> LineageIds:
    """Identities of a run: the variant's follow from ``identity``, the adapter's from experiment and run."""
    e, r = validated(experiment or experiment_id(), "exp-"), validated(training_run_id(run), "trun-")
    return LineageIds(e, variant_id(identity), r, adapter_id(e, r))
