import json
import shutil
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from liftworks.operators import model as md
from liftworks.plans import stages
from liftworks.plans.config import STAGES, Config, find_configs, load_config


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    rows = spark.range(1200).select(
        F.concat(F.lit("v"), F.col("id")).alias("vin_date"),
        (F.col("id") % 4).cast("int").alias("lvl"),
        F.when(F.col("id") % 10 == 0, "Unknown").otherwise((F.col("id") % 3).cast("string")).alias("text_raw"),
        (F.col("id") % 2 == 0).alias("flag"),
        F.lit("same").alias("unused"),
        "id",
    )
    rows.drop("id").write.parquet(f"{root}/master.parquet")
    rows.select(
        F.col("vin_date").alias("VIN_Date"),
        (F.col("id") % 6 + 1).alias("fold"),
        F.when(F.col("id") % 3 == 0, 1.0 + F.col("id") % 4).otherwise(0.0).alias("pp_bi"),
        (1 + F.col("id") % 2).alias("ee"),
    ).write.parquet(f"{root}/aux.parquet")
    return root


def config(inputs, tmp_path, **changes):
    settings = dict(
        name="e1", target="pp_bi", exposure="ee_bi", master=f"{inputs}/master.parquet", aux=f"{inputs}/aux.parquet",
        output=f"{tmp_path}/out", debug_level=2, features=["lvl", "text_raw", "flag", "gone"],
        columns_to_load=["lvl", "text_raw", "flag", "gone"], conversions=["text_raw"],
        model={"method": "boost", "rounds": 2, "max_depth": 2, "learning_rate": 0.3}, top_features=2,
    )
    return Config(**(settings | changes))


def test_all_stages(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path)
    log = {r["stage"]: r for r in stages.run_stages(spark, cfg).collect()}
    assert [r["error"] for r in log.values()] == [None] * 7
    assert [log[s]["status"] for s in STAGES] == ["success"] * 7
    assert log["stage_01"]["rows"] == 600 and log["stage_05"]["rows"] == 200

    done = spark.read.parquet(f"{cfg.output}/data/02_conditioned")
    assert "unused" not in done.columns
    assert dict(done.dtypes)["text_raw"] == "double" and done.filter("text_raw is null").count() == 0
    metrics = spark.read.json(f"{cfg.output}/results/05_metrics").first()
    assert (metrics["train_size"], metrics["test_size"], metrics["n_features"]) == (400, 200, 3)
    folds = {"train": "fold in (1, 2)", "test": "fold = 6"}
    for part in folds:
        lift = spark.read.csv(f"{cfg.output}/results/05_lift_{part}", header=True, inferSchema=True)
        assert lift.agg(F.sum("weight")).first()[0] == done.filter(folds[part]).agg(F.sum("ee")).first()[0]
    contrib = spark.read.parquet(f"{cfg.output}/results/06_contrib_test")
    model = md.load_model(spark, f"{cfg.output}/models/model")
    pred = spark.read.parquet(f"{cfg.output}/results/05_predictions")
    gap = contrib.join(pred, "vin_date").select(
        F.abs(sum((F.col(f) for f in model.features), F.col("base_value")) - F.log("pred")).alias("gap")
    )
    assert gap.count() == 200 and gap.agg(F.max("gap")).first()[0] < 1e-9
    assert spark.read.parquet(f"{cfg.output}/results/07_ranges").count() > 0
    assert spark.read.parquet(f"{cfg.output}/results/06_contrib_train").count() == 400
    assert stages.run_summary(spark.read.parquet(f"{cfg.output}/run_log")).first()["success"] == 7


def test_skipped_and_failed_stages(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path, target="absent", stages={"stage_03": False})
    log = [(r["stage"], r["status"]) for r in stages.run_stages(spark, cfg).collect()]
    assert log == [("stage_01", "success"), ("stage_02", "failed")]
    cfg = config(inputs, tmp_path / "b", target="absent", stages={"stage_03": False}, stop_on_error=False)
    log = {r["stage"]: r for r in stages.run_stages(spark, cfg).collect()}
    assert len(log) == 7 and log["stage_03"]["status"] == "skipped" and log["stage_02"]["error"]


def test_fold_column_is_required(spark, inputs, tmp_path):
    log = stages.run_stages(spark, config(inputs, tmp_path, fold="cv")).first()
    assert log["status"] == "failed" and "cv" in log["error"]


def test_strict_exposure(spark, inputs, tmp_path):
    log = stages.run_stages(spark, config(inputs, tmp_path, strict=True)).collect()[-1]
    assert log["stage"] == "stage_05" and "ee_bi" in log["error"]


def _files(tmp_path, inputs):
    pytest.importorskip("yaml")
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir(), second.mkdir()
    (first / "columns.csv").write_text("# loaded columns\ncolumn_name,category\nlvl,driver\nflag,driver\n")
    (first / "type_conversions.csv").write_text("column_name,source_dtype,target_dtype,notes\ntext_raw,object,numeric,\n")
    (first / "config.yaml").write_text(f"""
experiment: {{name: first, target: pp_bi, exposure: ee_bi}}
debug: {{level: 1, test_fold: 6, fold_mapping: {{1: [1], 0: [1, 2, 3, 4, 5]}}}}
paths: {{data_root: "{inputs}", output_base: "{tmp_path}/out_a"}}
data: {{master_file: master.parquet, aux_file: aux.parquet, join_key: vin_date, fold_column: fold,
        join_type: inner, columns_to_load_file: columns.csv}}
features: {{inclusion_file: columns.csv}}
xgboost: {{tweedie_variance_power: 1.5, learning_rate: 0.05, max_depth: 2, n_estimators: 2, device: cpu}}
execution: {{stages: {{stage_06: false, stage_07: false}}, stop_on_error: true}}
""")
    (second / "config.json").write_text(json.dumps({
        "experiment": {"name": "second", "target": "pp_bi"},
        "paths": {"data_root": str(inputs), "output_base": f"{tmp_path}/out_b"},
        "data": {"master_file": "nothing.parquet", "aux_file": "aux.parquet"},
    }))


def test_configuration_files(spark, inputs, tmp_path):
    _files(tmp_path, inputs)
    paths = find_configs(str(tmp_path))
    assert len(paths) == 2
    cfg = load_config(paths[0])
    assert cfg.train_folds == [1] and cfg.columns_to_load == ["lvl", "flag"] and cfg.conversions == ["text_raw"]
    assert cfg.model == {"method": "boost", "power": 1.5, "learning_rate": 0.05, "max_depth": 2, "rounds": 2}
    assert not cfg.enabled("stage_06") and cfg.enabled("stage_01")

    summary = {r["experiment"]: r for r in stages.run_summary(stages.run_all(spark, paths)).collect()}
    assert (summary["first"]["success"], summary["first"]["skipped"]) == (5, 2)
    assert summary["second"]["failed"] == 1
    assert stages.run_all(spark, []).count() == 0


def test_settings_are_honoured_or_refused(spark, inputs, tmp_path):
    _files(tmp_path, inputs)
    folder = tmp_path / "b"
    (folder / "out.csv").write_text("column_name\nflag\n")
    (folder / "blank.csv").write_text("column_name\nlvl\n")
    raw = json.loads((folder / "config.json").read_text())
    raw["features"] = {"exclusion_file": "out.csv", "blank_file": "blank.csv"}
    (folder / "config.json").write_text(json.dumps(raw))
    cfg = load_config(str(folder / "config.json"))
    assert cfg.excluded == ["flag"] and cfg.blanked == ["lvl"]
    run = config(inputs, tmp_path / "r", excluded=cfg.excluded, blanked=cfg.blanked)
    stages.run_stages(spark, run)
    assert spark.read.parquet(f"{run.output}/data/02_conditioned").filter("lvl != 0").count() == 0
    assert "flag" not in md.load_model(spark, f"{run.output}/models/model").features
    for section, key in (("xgboost", "gamma_ray"), ("data", "master"), ("features", "inclusion")):
        wrong = raw | {section: (raw.get(section) or {}) | {key: 1}}
        (folder / "config.json").write_text(json.dumps(wrong))
        with pytest.raises(ValueError, match=key):
            load_config(str(folder / "config.json"))


def test_text_features_are_refused(spark, inputs, tmp_path):
    log = stages.run_stages(spark, config(inputs, tmp_path, conversions=[])).collect()[-1]
    assert log["status"] == "failed" and "text_raw" in log["error"]


def test_comparison(spark):
    a = stages.metrics_long(spark.createDataFrame([(1.0, 5)], "mae double, size int"))
    b = stages.metrics_long(spark.createDataFrame([(4.0, 5)], "mae double, size int"))
    rows = {r["metric"]: r["difference"] for r in stages.compare_metrics(a, b).collect()}
    assert rows == {"mae": 3.0, "size": 0.0}


def test_a_slow_experiment_is_stopped_and_others_complete(spark, inputs, tmp_path, monkeypatch):
    whole = stages.STAGE_FUNCTIONS["stage_01"]

    def slow(session, cfg):
        if cfg.name == "slow":
            def wait(batches):
                time.sleep(240)
                yield from batches

            session.range(0, 1, 1, 1).mapInArrow(wait, "id long").collect()
        return whole(session, cfg)

    monkeypatch.setitem(stages.STAGE_FUNCTIONS, "stage_01", slow)
    only = {f"stage_0{k}": False for k in range(2, 8)}
    runs = [config(inputs, tmp_path / n, name=n, stages=only) for n in ("slow", "a", "b")]
    began = time.monotonic()
    log = {(r["experiment"], r["stage"]): r for r in stages.run_all(spark, runs, limit=25.0, at_once=3).collect()}
    assert time.monotonic() - began < 180
    assert log["slow", "stage_01"]["status"] == "timeout" and ("slow", "stage_02") not in log
    assert [log[n, "stage_01"]["error"] for n in "ab"] == [None, None]


def test_one_that_hangs_outside_of_spark_is_left(spark, inputs, tmp_path, monkeypatch):
    monkeypatch.setitem(stages.STAGE_FUNCTIONS, "stage_01", lambda session, cfg: time.sleep(15) or 1)
    monkeypatch.setattr(stages, "GRACE", 1.0)
    log = stages.run_all(spark, [config(inputs, tmp_path)], limit=0.5).collect()
    assert [(r["stage"], r["status"]) for r in log] == [("run", "timeout")]


def test_what_is_stale(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path, stages={f"stage_0{k}": False for k in (3, 4, 5, 6, 7)})

    def run(c):
        return [r["status"] for r in stages.run_stages(spark, c, reuse=True).collect()][:2]

    assert run(cfg) == ["success", "success"]
    assert run(cfg) == ["reused", "reused"]
    assert run(replace(cfg, blanked=["lvl"])) == ["reused", "success"]
    assert run(replace(cfg, blanked=["lvl"], stages=cfg.stages | {"stage_01": False})) == ["skipped", "reused"]
    # a manifest goes with its files: without them the stage runs again
    shutil.rmtree(f"{cfg.output}/data/02_conditioned")
    assert run(replace(cfg, blanked=["lvl"])) == ["reused", "success"]
    shutil.rmtree(f"{cfg.output}/manifests/stage_01")
    assert run(replace(cfg, blanked=["lvl"], stages=cfg.stages | {"stage_01": False}))[0] == "stale"
    assert run(replace(cfg, blanked=["lvl"])) == ["success", "success"]
