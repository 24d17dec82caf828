"""Typed configurations whose fields carry their rules, from mappings or TOML files."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field, fields
from typing import Any

from marlstone.functions.text import REDACTED
from marlstone.lineage import validated
from marlstone.operators.evalagg import GATES

Rule = tuple[str, Callable[[Any], bool]]


def load_toml(path: str) -> dict[str, Any]:
    with open(path, "rb") as f:
        return tomllib.load(f)


def _require(ok: bool, why: str) -> None:
    if not ok:
        raise ValueError(why)


POSITIVE: Rule = ("must be positive", lambda v: v > 0)
NOT_NEGATIVE: Rule = ("must not be negative", lambda v: v >= 0)
SHARE: Rule = ("must be a share from 0 to 1", lambda v: 0 <= v <= 1)
PERCENT: Rule = ("must be more than 0 and 100 at most", lambda v: 0 < v <= 100)
FILLED: Rule = ("must not be empty", lambda v: bool(v) and str(v).strip() != "")
ALL_POSITIVE: Rule = ("must be positive numbers", lambda v: bool(v) and min(v) > 0)


def one_of(*choices: str) -> Rule:
    return f"must be one of {', '.join(choices)}", lambda v: v in choices


def ruled(default: Any, *rules: Rule) -> Any:
    """A field with rules; a default of None means that null is allowed and bound by no rule."""
    return field(default=default, metadata={"rules": rules})


class Settings:
    """Validation and construction for the dataclasses below."""

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]):
        known = {f.name: f for f in fields(cls)}
        _require(set(values) <= set(known), f"unknown settings of {cls.__name__}: {sorted(set(values) - set(known))}")
        made = cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
        made.validate()
        return made

    def validate(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            for why, holds in f.metadata.get("rules", ()):
                _require((value is None and f.default is None) or holds(value), f"{f.name} {why}")
        self.check()

    def check(self) -> None:
        """Rules between fields."""


@dataclass(frozen=True)
class JudgeConfig(Settings):
    provider: str = ruled("local", FILLED)
    model: str = ""
    context_tokens: int = ruled(32768, POSITIVE)
    max_output_tokens: int = ruled(768, POSITIVE)
    temperature: float = ruled(0.0, NOT_NEGATIVE)
    seed: int | None = 42
    timeout_seconds: float = ruled(300.0, POSITIVE)
    maximum_retries: int = ruled(2, NOT_NEGATIVE)

    def check(self) -> None:
        _require(self.context_tokens > self.max_output_tokens, "output tokens must fit the context")


@dataclass(frozen=True)
class EvidenceConfig(Settings):
    required: bool = False
    missing_policy: str = ruled("reference-only", one_of("reference-only", "unjudgeable", "error"))
    store_text: bool = False

    def check(self) -> None:
        _require(not (self.required and self.missing_policy == "reference-only"), "required evidence can't be replaced by references")


@dataclass(frozen=True)
class GateConfig(Settings):
    values: Mapping[str, float | bool] = field(default_factory=lambda: dict(GATES))

    def check(self) -> None:
        _require(set(self.values) <= set(GATES), "unknown gate")
        _require(all(isinstance(v, bool) or 0 <= v <= 1 for v in self.values.values()), "gates are shares from 0 to 1")


@dataclass(frozen=True)
class EvaluationConfig(Settings):
    candidates: tuple[str, ...] = ()
    name: str = "evaluation"
    judge: JudgeConfig = JudgeConfig()
    evidence: EvidenceConfig = EvidenceConfig()
    gates: GateConfig = GateConfig()
    checkpoint_interval: int = ruled(10, POSITIVE)
    minimum_record_overlap: float = ruled(0.80, SHARE, POSITIVE)

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> EvaluationConfig:
        own = dict(values)
        parts = {"judge": JudgeConfig.from_mapping(own.pop("judge", {})), "evidence": EvidenceConfig.from_mapping(own.pop("evidence", {})), "gates": GateConfig({**GATES, **own.pop("gates", {})})}
        return super().from_mapping({**own, **parts})

    def check(self) -> None:
        _require(len(set(self.candidates)) == len(self.candidates), "candidates must be unique")
        _require(bool(self.name.strip()), "name must not be empty")
        for part in (self.judge, self.evidence, self.gates):
            part.validate()


@dataclass(frozen=True)
class TrainingConfig(Settings):
    backend: str = ruled("custom-pytorch", FILLED)
    model_name: str = ""
    model_revision: str | None = None
    run_id: str | None = None
    training_run_id: str | None = None
    experiment_id: str | None = None
    publication_mode: str = ruled("local", one_of("local", "storage"))
    dataset_input_mode: str = ruled("auto", one_of("auto", "manifest", "jsonl"))
    overlength: str = ruled("error", one_of("error", "skip"))
    data_order: str = ruled("source", one_of("source"))
    max_sequence_length: int = ruled(512, POSITIVE)
    max_examples: int | None = ruled(None, POSITIVE)
    max_steps: int = ruled(1, POSITIVE)
    per_device_train_batch_size: int = ruled(1, POSITIVE)
    gradient_accumulation_steps: int = ruled(1, POSITIVE)
    learning_rate: float = ruled(2e-4, POSITIVE)
    seed: int = 42
    load_in_4bit: bool = True
    lora_rank: int = ruled(8, POSITIVE)
    lora_alpha: int = ruled(16, POSITIVE)
    lora_dropout: float = ruled(0.05, ("must be 0 or more and less than 1", lambda v: 0 <= v < 1))
    target_modules: tuple[str, ...] = ("q_proj", "k_proj", "v_proj", "o_proj")
    progress_interval: int = ruled(1, POSITIVE)
    evaluation_max_new_tokens: int = ruled(32, POSITIVE)
    resource_sample_interval_seconds: float = ruled(1.0, POSITIVE)
    host_telemetry_source: str = ruled("auto", one_of("auto", "windows", "wsl"))
    host_installed_memory_gib: float | None = ruled(None, POSITIVE)
    tracking_backend: str = ruled("none", one_of("none", "table"))
    tracking_experiment_name: str | None = None
    tracking_failure_policy: str = ruled("warn", one_of("warn", "error"))

    def check(self) -> None:
        for name in ("run_id", "training_run_id"):
            value = getattr(self, name)
            _require(value is None or (bool(value) and os.path.basename(value) == value), f"{name} must be one file name")
        _require(self.run_id is None or self.training_run_id is None, "run_id and training_run_id exclude each other")
        if self.experiment_id is not None:
            validated(self.experiment_id, "exp-")
        _require(self.tracking_backend == "none" or bool(self.tracking_experiment_name), "tracking needs an experiment name")


@dataclass(frozen=True)
class CapacityConfig(Settings):
    axes: tuple[str, ...] = ()
    candidates: Mapping[str, tuple] = field(default_factory=dict)
    strategy: str = ruled("staged", one_of("staged", "grid"))
    max_trials: int = ruled(100, POSITIVE)
    trial_max_steps: int = ruled(2, POSITIVE)
    gpu_memory_limit_percent: float | None = ruled(None, PERCENT)
    ram_limit_percent: float | None = ruled(None, PERCENT)
    gpu_temperature_limit_celsius: float | None = None
    gpu_power_limit_watts: float | None = None
    limits: Mapping[str, float | None] = field(default_factory=dict)
    sustain_seconds: float = ruled(3.0, NOT_NEGATIVE)
    model_loading_timeout_seconds: float | None = ruled(None, POSITIVE)
    trial_timeout_seconds: float | None = ruled(None, POSITIVE)
    no_step_progress_timeout_seconds: float | None = ruled(None, POSITIVE)
    cooldown_seconds: float = ruled(3.0, NOT_NEGATIVE)
    sequence_lengths: tuple[int, ...] = ruled((128, 256, 512, 1024, 2048), ALL_POSITIVE)
    batch_sizes: tuple[int, ...] = ruled((1, 2, 4, 8), ALL_POSITIVE)
    lora_ranks: tuple[int, ...] = ruled((8, 16, 32, 64), ALL_POSITIVE)
    bridge_max_age_seconds: float = ruled(5.0, POSITIVE)
    max_trials_per_worker: int = ruled(25, POSITIVE)
    reuse_loaded_model: bool = False
    restart_worker_after_oom: bool = True

    def check(self) -> None:
        known = {f.name for f in fields(TrainingConfig)} | set(self.candidates)
        _require(set(self.axes) <= known, f"unknown axes: {sorted(set(self.axes) - known)}")
        _require(all(self.candidates.get(a) for a in self.axes), "each axis needs candidates")
        _require(self.restart_worker_after_oom or not self.reuse_loaded_model, "a reused model needs a new worker after it ran out of memory")


@dataclass(frozen=True)
class Resolved:
    """A configuration with where each setting comes from and what the command line changed."""

    configuration: Any
    sources: Mapping[str, str]
    overrides: tuple[Mapping[str, Any], ...]


def resolve(cls: type, file_values: Mapping[str, Any], arguments: Mapping[str, Any], path: str = "file") -> Resolved:
    """Defaults, then the file, then arguments that aren't null; secrets are hidden in the overrides."""
    given = {k: v for k, v in arguments.items() if v is not None}
    made = cls.from_mapping({**file_values, **given})
    before = asdict(cls.from_mapping(file_values))
    now = asdict(made)
    hide = lambda k, v: REDACTED if v is not None and any(m in k.lower() for m in ("secret", "password", "token_", "api_key")) else v
    changed = tuple({"key": k, "source": f"--{k.replace('_', '-')}", "previous": hide(k, before[k]), "effective": hide(k, now[k])} for k in sorted(given) if before[k] != now[k])
    origin = {k: f"--{k.replace('_', '-')}" if k in given else path if k in file_values else "built-in" for k in now}
    return Resolved(made, origin, changed)


def overrides(defaults: Any, effective: Any) -> dict[str, tuple[Any, Any]]:
    """Settings that differ, as (default, effective)."""
    a, b = asdict(defaults), asdict(effective)
    return {k: (a[k], b[k]) for k in a if a[k] != b[k]}


def storage_root(injected: str | None = None, config: str | None = None, root: str | None = None, default: str = ".") -> str:
    """The storage root by precedence: injected, config, root, default."""
    return next(x for x in (injected, config, root, default) if x)


def dataset_mode(uri: str, mode: str = "auto") -> str:
    """manifest for storage URIs, jsonl for local files; contradictions raise."""
    stored = uri.startswith("storage://")
    found = "manifest" if stored else "jsonl"
    _require(mode in ("auto", "manifest", "jsonl"), f"unknown input mode {mode}")
    _require(mode in ("auto", found), f"{uri} can't be read as {mode}")
    return found
