"""What a stage was made from: input files, settings, and the files it left.

A manifest is one JSON record per stage below the experiment's output, written after everything else of the
stage, so a stage that was cut short has none. A stage is current if its manifest names the settings, the
input files and the output files that are there now. Files are told by path, size and time of change,
which Spark lists in parallel without reading them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from liftworks.plans.config import Config
from liftworks.sources import exists

#: What each stage reads and leaves, below the output folder; the first one reads the configured tables.
READS = {
    "stage_01": (),
    "stage_02": ("data/01_assembled",),
    "stage_03": ("data/02_conditioned",),
    "stage_04": ("data/02_conditioned",),
    "stage_05": ("data/02_conditioned",),
    "stage_06": ("data/02_conditioned", "models/model"),
    "stage_07": ("data/02_conditioned", "models/model", "results/05_facts_test", "results/06_contrib_test"),
}
LEAVES = {
    "stage_01": ("data/01_assembled",),
    "stage_02": ("data/02_conditioned",),
    "stage_03": ("results/03_verification",),
    "stage_04": ("results/04_split",),
    "stage_05": ("models/model", "results/05_facts_train", "results/05_facts_test", "results/05_predictions"),
    "stage_06": ("results/06_contrib_train", "results/06_contrib_test"),
    "stage_07": ("results/07_totals",),
}
#: Settings that are no part of what a stage makes.
ASIDE = ("name", "output", "stages", "stop_on_error")
#: Settings that only some stages use; all others count for every stage.
USED = {
    "model": ("stage_05",),
    "explain_fraction": ("stage_06",),
    "top_features": ("stage_07",),
    "features": ("stage_04", "stage_05"),
    "excluded": ("stage_04", "stage_05"),
    "conversions": ("stage_02",),
    "blanked": ("stage_02",),
    "columns_to_load": ("stage_01",),
}

_SCHEMA = "settings string, inputs map<string,string>, outputs map<string,string>, rows bigint"


def settings_of(cfg: Config, stage: str) -> str:
    """Digest of the settings that matter to a stage."""
    kept = {k: v for k, v in asdict(cfg).items() if k not in ASIDE and stage in USED.get(k, (stage,))}
    return hashlib.sha256(repr(sorted(kept.items(), key=str)).encode()).hexdigest()


def files_of(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """A mark of the files below each path, empty if there are none."""
    out = {}
    for path in paths:
        if not exists(spark, path):
            out[path] = ""
            continue
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        mark = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
        n, total, files = listed.agg(F.count(F.lit(1)), F.sum("length"), mark).first()
        out[path] = f"{n}:{total}:{files}"
    return out


def _paths(cfg: Config, names: Mapping[str, Sequence[str]], stage: str) -> list[str]:
    own = [f"{cfg.output}/{n}" for n in names[stage]]
    return [cfg.master, cfg.aux] if stage == "stage_01" and names is READS else own


def inputs_of(spark: SparkSession, cfg: Config, stage: str) -> dict[str, str]:
    return files_of(spark, _paths(cfg, READS, stage))


def commit(spark: SparkSession, cfg: Config, stage: str, inputs: Mapping[str, str], rows: int) -> None:
    """Write a stage's manifest; ``inputs`` are those listed before it began."""
    outputs = files_of(spark, _paths(cfg, LEAVES, stage))
    record = [(settings_of(cfg, stage), dict(inputs), outputs, rows)]
    written: DataFrame = spark.createDataFrame(record, _SCHEMA).coalesce(1)
    written.write.mode("overwrite").json(f"{cfg.output}/manifests/{stage}")


def current(spark: SparkSession, cfg: Config, stage: str) -> int | None:
    """The rows a stage produced if it needn't run again, else None."""
    path = f"{cfg.output}/manifests/{stage}"
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    said = spark.read.schema(_SCHEMA).json(path).first()
    same = (
        said is not None
        and said["settings"] == settings_of(cfg, stage)
        and said["inputs"] == inputs_of(spark, cfg, stage)
        and said["outputs"] == files_of(spark, _paths(cfg, LEAVES, stage))
    )
    return said["rows"] if same else None
