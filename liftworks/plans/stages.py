"""The staged batch job: assemble, condition, verify, split, fit, explain, analyse.

A stage reads the Parquet output of earlier stages and writes its own, so any stage can be run
again alone. Stages return the number of rows they produced.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession, functions as F

from liftworks.operators import assemble as asm
from liftworks.operators import catalog as cat
from liftworks.operators import condition as con
from liftworks.operators import evaluate as ev
from liftworks.operators import explain as ex
from liftworks.operators import model as md
from liftworks.plans import manifests
from liftworks.plans.config import STAGES, Config, load_config
from liftworks.sources import read_parquet, write_csv, write_metrics, write_parquet
from liftworks.sources.files import predictions


def _at(cfg: Config, name: str) -> str:
    return f"{cfg.output}/{name}"


def _read(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    return spark.read.parquet(_at(cfg, name))


def _features(cfg: Config, df: DataFrame) -> list[str]:
    """Listed columns the data has (all numeric ones without a list), less the excluded ones."""
    listed = cat.included(df.columns, cfg.features or None)
    fixed = {cfg.key, cfg.fold, cfg.target, *cat.TARGETS, *cfg.excluded}
    numeric = set(cat.numeric_columns(df, fixed))
    taken = {cfg.exposure, "ee", "ee_imps", "weight"}
    if cfg.features and (text := [c for c in listed if c not in numeric and c not in fixed]):
        raise ValueError(f"listed features that are not numeric: {text}; convert or encode them")
    return [c for c in listed if c in numeric and (cfg.features or c not in taken)]


def assemble(spark: SparkSession, cfg: Config) -> int:
    aux = read_parquet(spark, cfg.aux)
    aux = asm.fold_filter(aux, [*cfg.train_folds, cfg.test_fold], cfg.fold)
    master = read_parquet(spark, cfg.master)
    key = asm.resolve_key(master.columns, cfg.key)
    if cfg.columns_to_load:
        master = read_parquet(spark, cfg.master, cfg.columns_to_load, always=[key])
    joined = asm.with_key(asm.assemble(master, aux, cfg.key, cfg.join_type), cfg.key)
    if cfg.fold not in joined.columns:
        raise ValueError(f"Fold column {cfg.fold} is missing after the join")
    write_parquet(joined, _at(cfg, "data/01_assembled"), [cfg.fold])
    return _read(spark, cfg, "data/01_assembled").count()


def condition(spark: SparkSession, cfg: Config) -> int:
    df = _read(spark, cfg, "data/01_assembled")
    write_csv(con.missing_profile(df), _at(cfg, "results/02_missing"))
    listed = [(c, "numeric") for c in cfg.conversions]
    if listed:
        df = con.apply_conversions(df, spark.createDataFrame(listed, "column_name string, target_dtype string"))
    df = con.fill_missing(con.bool_to_int(df))
    df = con.blank_out(df, [c for c in cfg.blanked if c in df.columns])
    write_parquet(df, _at(cfg, "data/02_conditioned"), [cfg.fold])
    done = _read(spark, cfg, "data/02_conditioned")
    write_csv(con.target_stats(done, cfg.target), _at(cfg, "results/02_target"))
    return done.count()


def verify(spark: SparkSession, cfg: Config) -> int:
    report = con.verification_report(_read(spark, cfg, "data/02_conditioned"), cfg.target, cfg.fold)
    write_parquet(report.coalesce(1), _at(cfg, "results/03_verification"))
    return _read(spark, cfg, "results/03_verification").count()


def _parts(spark: SparkSession, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Training and test rows: the conditioned table is partitioned by fold, so these are pruned
    reads of it, not copies."""
    df = _read(spark, cfg, "data/02_conditioned")
    return asm.split_by_fold(df, cfg.train_folds, cfg.test_fold, cfg.fold)


def prepare(spark: SparkSession, cfg: Config) -> int:
    train, test = _parts(spark, cfg)
    counts = [("train", train.count()), ("test", test.count())]
    features = _features(cfg, train)
    sizes = spark.createDataFrame([(*c, len(features)) for c in counts], "part string, rows long, features int")
    write_csv(sizes, _at(cfg, "results/04_split"))
    return sum(n for _, n in counts)


def fit(spark: SparkSession, cfg: Config) -> int:
    train, test = _parts(spark, cfg)
    features = _features(cfg, train)
    options = dict(cfg.model)
    if options.get("method") == "boost":
        options.setdefault("key", cfg.key)
    model = md.fit_tweedie(train, features, cfg.target, **options)
    md.save_model(spark, model, _at(cfg, "models/model"))

    exposure = ev.weight_column(train.columns, cfg.exposure, cfg.strict)
    for name, rows in (("train", train), ("test", test)):
        slim = rows.select(cfg.key, cfg.target, *dict.fromkeys([*features, *([exposure] if exposure else [])]))
        facts = ev.score_facts(md.score(model, slim), cfg.target, exposure)
        kept = [cfg.key, cfg.target, "pred", "incurred_act", "incurred_pred", "denom", "weight"]
        write_parquet(facts.select(*kept), _at(cfg, f"results/05_facts_{name}"))
        facts = _read(spark, cfg, f"results/05_facts_{name}")
        table = ev.lift(facts, "weight", cfg.key).orderBy("decile")
        write_csv(table, _at(cfg, f"results/05_lift_{name}"))
    both = _read(spark, cfg, "results/05_facts_train").withColumn("train", F.lit(True)).unionByName(
        _read(spark, cfg, "results/05_facts_test").withColumn("train", F.lit(False))
    )
    write_metrics(
        ev.run_metrics(both, cfg.target, "pred", F.col("train"), len(features)),
        _at(cfg, "results/05_metrics"),
    )
    scored = _read(spark, cfg, "results/05_facts_test")
    write_parquet(predictions(scored, cfg.key, cfg.target), _at(cfg, "results/05_predictions"))
    return scored.count()


def explain(spark: SparkSession, cfg: Config) -> int:
    model = md.load_model(spark, _at(cfg, "models/model"))
    train, test = _parts(spark, cfg)
    exposure = ev.weight_column(train.columns, cfg.exposure)
    drawn = asm.hash_sample(train, cfg.key, cfg.explain_fraction)
    for name, rows in (("train", drawn), ("test", test)):
        write_parquet(model.contributions(rows, cfg.key, exposure), _at(cfg, f"results/06_contrib_{name}"))
    contrib = _read(spark, cfg, "results/06_contrib_test")
    importance = ex.importance(contrib, list(model.features)).orderBy(F.desc("importance"), "field")
    write_csv(importance, _at(cfg, "results/06_importance"))
    return contrib.count() + _read(spark, cfg, "results/06_contrib_train").count()


def analyse(spark: SparkSession, cfg: Config) -> int:
    model = md.load_model(spark, _at(cfg, "models/model"))
    features = list(model.features)
    contrib = _read(spark, cfg, "results/06_contrib_test")
    _, test = _parts(spark, cfg)
    totals = ex.contrib_totals(contrib, features, "weight").coalesce(1)
    write_parquet(totals, _at(cfg, "results/07_totals"))
    totals = _read(spark, cfg, "results/07_totals")
    shares = ex.with_shares(totals)
    write_csv(shares.orderBy(F.desc("total_shap"), "field"), _at(cfg, "results/07_aggregate"))
    n = len(features) if cfg.top_features is None else cfg.top_features
    top = [r["field"] for r in ex.top_features(shares, "total_shap", n).collect()]
    if top:
        long = ex.long_contributions(contrib, test, top, cfg.key, "weight")
        write_parquet(ex.contrib_range(long), _at(cfg, "results/07_ranges"))
    facts = _read(spark, cfg, "results/05_facts_test").drop(cfg.target)
    facts = facts.join(test.select(cfg.key, *[c for c in top if c not in facts.columns]), cfg.key)
    if top:
        tables = ev.residual_tables(facts, top, "weight")
        write_csv(tables.orderBy("field", "lo"), _at(cfg, "results/07_residuals"))
    return totals.count()


STAGE_FUNCTIONS: dict[str, Callable[[SparkSession, Config], int]] = dict(
    zip(STAGES, (assemble, condition, verify, prepare, fit, explain, analyse))
)

_LOG = "experiment string, stage string, status string, rows bigint, seconds double, error string"


@dataclass(frozen=True)
class Stop:
    """The tag of an experiment's jobs, and whether its time is up."""

    tag: str
    reached: threading.Event = field(default_factory=threading.Event)


def run_stages(
    spark: SparkSession, cfg: Config, reuse: bool = False, stop: Stop | None = None
) -> DataFrame:
    """Run the enabled stages in order; returns and appends the run log.

    A failed stage ends the run if the configuration says so; stages after it are not logged. With
    ``reuse``, stages whose settings, inputs and outputs are as their manifest says are ``reused``, and
    disabled ones that are not are ``stale`` rather than ``skipped``. Once ``stop`` is set, the stage that
    runs is logged as ``timeout`` and ends the run.
    """
    log = []
    for name, run in STAGE_FUNCTIONS.items():
        began = time.monotonic()
        rows = manifests.current(spark, cfg, name) if reuse else None
        if not cfg.enabled(name):
            stale = reuse and rows is None
            log.append((cfg.name, name, "stale" if stale else "skipped", None, 0.0, None))
            continue
        if rows is not None:
            log.append((cfg.name, name, "reused", rows, time.monotonic() - began, None))
            continue
        try:
            inputs = manifests.inputs_of(spark, cfg, name)
            rows, status, error = run(spark, cfg), "success", None
            if stop is None or not stop.reached.is_set():
                manifests.commit(spark, cfg, name, inputs, rows)
        except Exception as err:  # the log records what went wrong
            rows, status, error = None, "failed", str(err)
        if stop is not None and stop.reached.is_set():
            rows, status, error = None, "timeout", "stopped at the time limit"
            spark.sparkContext.removeJobTag(stop.tag)  # the log below is not to be cancelled
        log.append((cfg.name, name, status, rows, time.monotonic() - began, error))
        if status == "timeout" or status == "failed" and cfg.stop_on_error:
            break
    frame = spark.createDataFrame(log, _LOG).coalesce(1)
    frame.write.mode("append").parquet(_at(cfg, "run_log"))
    return frame


#: Seconds an experiment may take, as in the surveyed batch runner.
LIMIT = 3600.0
#: Seconds a stopped experiment has to notice it.
GRACE = 30.0


def run_all(
    spark: SparkSession, configs: Sequence[Config | str], limit: float = LIMIT, at_once: int = 2, reuse: bool = False
) -> DataFrame:
    """Run several experiments, ``at_once`` side by side; a failure does not stop the others.

    Each has a thread, a job tag and a scheduler pool of its own. After ``limit`` seconds its jobs are
    cancelled by tag, again and again until the thread ends, and its stage is logged as ``timeout``. One that
    runs no job then, and so cannot be cancelled, is left after ``GRACE`` seconds with a log line of its own.
    """
    loaded = [load_config(c) if isinstance(c, str) else c for c in configs]
    logs: list[DataFrame | None] = [None] * len(loaded)
    waiting = list(range(len(loaded)))
    running: dict[int, tuple[InheritableThread, Stop, float]] = {}

    def work(i: int, stop: Stop) -> None:
        sc = spark.sparkContext
        sc.addJobTag(stop.tag)
        sc.setLocalProperty("spark.scheduler.pool", stop.tag)
        try:
            logs[i] = run_stages(spark, loaded[i], reuse, stop)
        except Exception as err:  # whatever is outside the stages
            logs[i] = spark.createDataFrame([(loaded[i].name, "run", "failed", None, 0.0, str(err))], _LOG)
        finally:
            sc.removeJobTag(stop.tag)

    while waiting or running:
        while waiting and len(running) < max(1, at_once):
            i, stop = waiting.pop(0), Stop(f"experiment-{uuid.uuid4().hex}")
            thread = InheritableThread(target=work, args=(i, stop), daemon=True)
            thread.start()
            running[i] = (thread, stop, time.monotonic())
        time.sleep(0.05)
        for i, (thread, stop, began) in list(running.items()):
            took = time.monotonic() - began
            if not thread.is_alive():
                del running[i]
            elif took > limit + GRACE:
                line = (loaded[i].name, "run", "timeout", None, took, "left running outside of Spark")
                logs[i] = spark.createDataFrame([line], _LOG)
                del running[i]
            elif took > limit:
                stop.reached.set()
                spark.sparkContext.cancelJobsWithTag(stop.tag)
                time.sleep(0.2)
    out = None
    for log in logs:
        out = log if out is None else out.unionByName(log)
    return spark.createDataFrame([], _LOG) if out is None else out


def run_summary(log: DataFrame) -> DataFrame:
    """Stages per experiment by outcome, and the total time."""
    return log.groupBy("experiment").agg(
        *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in ("success", "failed", "skipped", "reused", "stale", "timeout")],
        F.sum("seconds").alias("seconds"),
    )


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One-row metrics record as ``(metric, value)``."""
    doubles = metrics.select(*[F.col(c).cast("double").alias(c) for c in metrics.columns])
    return doubles.unpivot([], metrics.columns, "metric", "value")


def compare_metrics(first: DataFrame, second: DataFrame) -> DataFrame:
    """``(metric, first, second, difference)`` of two metrics tables."""
    a = first.select("metric", F.col("value").alias("first"))
    b = second.select("metric", F.col("value").alias("second"))
    return a.join(b, "metric").withColumn("difference", F.col("second") - F.col("first"))
