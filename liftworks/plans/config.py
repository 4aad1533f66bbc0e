"""Experiment configuration."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path

# Names of the pipeline stages, in order.
STAGES = ("stage_01", "stage_02", "stage_03", "stage_04", "stage_05", "stage_06", "stage_07")


@dataclass(frozen=True)
class Config:
    name: str
    target: str
    master: str
    aux: str
    output: str
    exposure: str | None = None
    key: str = "vin_date"
    fold: str = "fold"
    join_type: str = "inner"
    debug_level: int = 0
    test_fold: int = 6
    # Training folds of each debug level.
    fold_mapping: Mapping[int, Sequence[int]] = field(
        default_factory=lambda: {1: (1,), 2: (1, 2), 3: (1, 2, 3, 4, 5), 0: (1, 2, 3, 4, 5)}
    )
    columns_to_load: Sequence[str] | None = None
    features: Sequence[str] = ()
    conversions: Sequence[str] = ()
    model: Mapping[str, object] = field(default_factory=lambda: {"method": "boost"})
    stages: Mapping[str, bool] = field(default_factory=dict)
    stop_on_error: bool = True
    top_features: int | None = None  # all
    explain_fraction: float = 1.0
    excluded: Sequence[str] = ()
    blanked: Sequence[str] = ()
    strict: bool = False

    @property
    def train_folds(self) -> list[int]:
        return list(self.fold_mapping[self.debug_level])

    def enabled(self, stage: str) -> bool:
        return bool(self.stages.get(stage, True))


# Option names of boosted-tree settings files, and ours.
_MODEL_OPTIONS = {
    "tweedie_variance_power": "power",
    "tweedie_p": "power",
    "learning_rate": "learning_rate",
    "base_margin_factor": "learning_rate",
    "max_depth": "max_depth",
    "min_child_weight": "min_child_weight",
    "subsample": "subsample",
    "colsample_bytree": "colsample",
    "alpha": "alpha",
    "n_estimators": "rounds",
    "num_round": "rounds",
    "random_state": "seed",
    "reg_alpha": "alpha",
    "lambda": "ridge",
    "reg_lambda": "ridge",
    "max_bin": "max_bins",
}

# Options that choose an engine or its messages, which have no counterpart here.
_ENGINE_OPTIONS = {"objective", "eval_metric", "tree_method", "device", "verbosity", "nthread", "n_jobs"}

# Keys of each section.
_KEYS = {
    "experiment": {"name", "target", "exposure", "description", "coverage", "version"},
    "debug": {"level", "test_fold", "fold_mapping", "train_folds", "enabled"},
    "data": {"master_file", "aux_file", "join_key", "fold_column", "join_type", "columns_to_load_file"},
    "features": {"inclusion_file", "exclusion_file", "blank_file"},
    "execution": {"stages", "stop_on_error", "cleanup_memory"},
}


def _refuse_unknown(raw: dict) -> None:
    unknown = [
        f"{section}.{k}" for section, keys in _KEYS.items() for k in set(raw.get(section) or {}) - keys
    ]
    options = set(raw.get("xgboost") or {}) - set(_MODEL_OPTIONS) - _ENGINE_OPTIONS
    unknown += [f"xgboost.{k}" for k in options]
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")


def _parse(path: Path) -> dict:
    text = path.read_text()
    if path.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as err:
        raise ValueError("YAML configurations need the yaml package; use JSON instead") from err
    return yaml.safe_load(text)


def _column_list(path: Path) -> list[str]:
    """First column of a small CSV sheet beside the configuration, comments left out."""
    lines = [ln for ln in path.read_text().splitlines() if ln.strip() and not ln.startswith("#")]
    return [ln.split(",")[0] for ln in lines[1:]]


def load_config(path: str) -> Config:
    """Configuration from a YAML or JSON file; sheets it names are looked up beside it."""
    file = Path(path)
    raw = _parse(file)
    _refuse_unknown(raw)
    exp, data, debug = raw["experiment"], raw["data"], raw.get("debug", {})
    execution, root = raw.get("execution", {}), raw["paths"].get("data_root", "")

    def sheet(name: str | None) -> list[str] | None:
        if not name:
            return None
        if not (file.parent / name).exists():
            raise ValueError(f"{name} is not beside {file.name}")
        return _column_list(file.parent / name)

    conversions = file.parent / "type_conversions.csv"
    model = {"method": "boost"} | {
        _MODEL_OPTIONS[k]: v for k, v in raw.get("xgboost", {}).items() if k in _MODEL_OPTIONS
    }
    optional = {}
    if "fold_mapping" in debug:
        optional["fold_mapping"] = {int(k): tuple(v) for k, v in debug["fold_mapping"].items()}
    return Config(
        name=exp["name"],
        target=exp["target"],
        exposure=exp.get("exposure"),
        master=f"{root}/{data['master_file']}",
        aux=f"{root}/{data['aux_file']}",
        output=raw["paths"]["output_base"],
        key=data.get("join_key", "vin_date"),
        fold=data.get("fold_column", "fold"),
        join_type=data.get("join_type", "inner"),
        debug_level=debug.get("level", 0),
        test_fold=debug.get("test_fold", 6),
        columns_to_load=sheet(data.get("columns_to_load_file")),
        features=sheet(raw.get("features", {}).get("inclusion_file")) or (),
        conversions=sheet(conversions.name if conversions.exists() else None) or (),
        excluded=sheet((raw.get("features") or {}).get("exclusion_file")) or (),
        blanked=sheet((raw.get("features") or {}).get("blank_file")) or (),
        model=model,
        stages=execution.get("stages", {}),
        stop_on_error=execution.get("stop_on_error", True),
        **optional,
    )


def find_configs(base: str) -> list[str]:
    """Configuration files of all experiments below a folder."""
    found = [p for p in Path(base).rglob("config.*") if p.suffix in (".yaml", ".yml", ".json")]
    return sorted(str(p) for p in found)
