"""The scheduled jobs: customers -> features -> model -> recommendations and log -> monitoring.

Jobs talk through stored tables only, so each can be rerun by itself. Every job takes its clock as an
argument; a rerun with the same clock leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from actionspark.config import EngineConfig
from actionspark.functions.numeric import as_column
from actionspark.operators import drift, encoding, evaluation, keys, profiles, training
from actionspark.operators.features import features, labels
from actionspark.operators.logs import health_summary, inference_log, mean_drift, performance_report
from actionspark.operators.readiness import monitor_status, readiness
from actionspark.plans.forest import fit_forest, forest_scores, predict
from actionspark.sources import ledger, versions
from actionspark.sources.schemas import (
    FEATURES,
    INFERENCE_LOG,
    RAW_CUSTOMERS,
    RECOMMENDATIONS,
    conform,
)
from actionspark.sources.tables import (
    append_log,
    baseline_full,
    baseline_sample,
    baseline_version,
    materialize,
    overwrite_table,
    read_log,
    read_table,
    scratch,
    table_exists,
)
from actionspark.streaming.scoring import score_stream

RAW, FEATURE_TABLE, VOCABULARY, VERSIONS = "customers_raw", "features", "vocabulary", "model_versions"
RECS, LOG = "recommendations", "inference_log"
BASELINE = "baseline"


def build_customers(raw: DataFrame, cfg: EngineConfig) -> None:
    """Store raw customers, from the warehouse view or from the generator."""
    overwrite_table(conform(raw, RAW_CUSTOMERS), cfg.path(RAW), keep=cfg.keep_versions)


def build_features(spark: SparkSession, cfg: EngineConfig, run_ts) -> DataFrame:
    """Derive and store the features as the table's next version; keys that are NULL or repeated are repaired on the way.
    Returns the key check of what was derived."""
    raw = read_table(spark, cfg.path(RAW), RAW_CUSTOMERS)
    derived = features(raw, run_ts)
    checked = keys.key_check(derived, ["customer_id"])
    clean = checked.first()["key_ok"]
    table = derived if clean else keys.dedupe_latest(derived, ["customer_id"], ["updated_at"])
    overwrite_table(table, cfg.path(FEATURE_TABLE), keep=cfg.keep_versions)
    return checked


@dataclass(frozen=True)
class TrainedModel:
    version: int
    accuracy: float
    report: DataFrame
    confusion: DataFrame


def _model_path(cfg: EngineConfig, version: int) -> str:
    return cfg.path(f"models/{cfg.model_name}/{version}")


def model_aliases(spark: SparkSession, cfg: EngineConfig) -> dict[str, int | None]:
    """champion, prev_champion, challenger and staging of the configured model; empty before training."""
    if not table_exists(spark, cfg.path(VERSIONS)):
        return {}
    mine = read_table(spark, cfg.path(VERSIONS)).filter(F.col("model") == cfg.model_name)
    row = evaluation.promotion_aliases(mine).first()  # one row per model
    return {} if row is None else {k: v for k, v in row.asDict().items() if k != "model"}


def train_model(spark: SparkSession, cfg: EngineConfig, lookup: bool = False) -> TrainedModel:
    """Fit, evaluate on the held-out quota of each class, and register the next version.

    ``lookup`` keeps labels without features in the training set; the fit then fails on their NULLs
    rather than inventing values.
    """
    with scratch(spark):
        return _train_model(spark, cfg, lookup)


def _train_model(spark: SparkSession, cfg: EngineConfig, lookup: bool) -> TrainedModel:
    raw = read_table(spark, cfg.path(RAW), RAW_CUSTOMERS)
    feats = read_table(spark, cfg.path(FEATURE_TABLE), FEATURES)
    vocabulary = encoding.fit_vocabulary(feats, cfg.categorical_features)
    joined = training.training_set(labels(raw), feats, cfg.features, "left" if lookup else "inner")
    joined = materialize(joined, "training_set")
    parts = training.exact_split(joined, "customer_id", "action_label", cfg.test_fraction, cfg.seed)

    version = (model_aliases(spark, cfg).get("staging") or 0) + 1
    stored_vocabulary = f"{_model_path(cfg, version)}/{VOCABULARY}"
    overwrite_table(vocabulary, stored_vocabulary)
    vocabulary = read_table(spark, stored_vocabulary)

    model = fit_forest(
        parts.filter(F.col("split") == "train"),
        vocabulary,
        cfg.categorical_features,
        cfg.numeric_features,
        trees=cfg.trees,
        depth=cfg.max_depth,
        seed=cfg.seed,
        partitions=cfg.fit_partitions,
        max_bins=cfg.max_bins,
        fit_rows=cfg.fit_rows,
    )
    model.write().overwrite().save(f"{_model_path(cfg, version)}/forest")

    held_out = parts.filter(F.col("split") == "test")
    scored_path = f"{_model_path(cfg, version)}/held_out"
    scored = predict(
        model, held_out, vocabulary, cfg.categorical_features, cfg.numeric_features, ["customer_id", "action_label"]
    )
    overwrite_table(scored, scored_path)
    scored = read_table(spark, scored_path)
    accuracy = evaluation.accuracy(scored).first()["accuracy"]

    entry = spark.range(1).select(
        F.lit(cfg.model_name).alias("model"), F.lit(version).alias("version"), F.lit(accuracy).alias("accuracy")
    )
    append_log(entry, cfg.path(VERSIONS), partition_by=["model", "version"])
    return TrainedModel(
        version, accuracy, evaluation.classification_report(scored), evaluation.confusion_matrix(scored)
    )


def load_model(cfg: EngineConfig, version: int) -> tuple[PipelineModel, DataFrame]:
    """A stored version and the vocabulary it was fitted with."""
    spark = SparkSession.active()
    vocabulary = read_table(spark, f"{_model_path(cfg, version)}/{VOCABULARY}")
    forest = PipelineModel.load(f"{_model_path(cfg, version)}/forest")
    return forest, vocabulary


def score_batch(spark: SparkSession, cfg: EngineConfig, run_ts, log_date, batch_id: str | None = None) -> int:
    """Score every feature row with the champion, store the recommendations, append them to the log.

    One lookup decides the version that scores and the version that is logged. Returns it. ``batch_id`` (by default the
    run's clock) names the batch in the log: the same batch again replaces itself, another one adds up.
    """
    version = model_aliases(spark, cfg).get("champion")
    if version is None:
        raise LookupError(f"no champion for {cfg.model_name}: train a model first")
    model, vocabulary = load_model(cfg, version)
    feats = read_table(spark, cfg.path(FEATURE_TABLE), FEATURES)
    scored = forest_scores(
        model, feats, vocabulary, cfg.categorical_features, cfg.numeric_features, str(version), as_column(run_ts)
    )
    overwrite_table(scored, cfg.path(RECS), keep=cfg.keep_versions)
    recs = read_table(spark, cfg.path(RECS), RECOMMENDATIONS)
    log = inference_log(recs, feats, log_date, run_ts, columns=cfg.features)
    append_log(log, cfg.path(LOG), batch_id=str(run_ts) if batch_id is None else batch_id)
    return version


def score_arrivals(
    spark: SparkSession, cfg: EngineConfig, source: str, sink: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Score feature files as they land in ``source`` with the champion of the moment the query starts. Of a versioned
    table the rows of its newest version are scored."""
    version = model_aliases(spark, cfg).get("champion")
    if version is None:
        raise LookupError(f"no champion for {cfg.model_name}: train a model first")
    model, vocabulary = load_model(cfg, version)

    def score(rows: DataFrame) -> DataFrame:
        return forest_scores(
            model,
            rows,
            vocabulary,
            cfg.categorical_features,
            cfg.numeric_features,
            str(version),
            F.col("updated_at"),
            ["updated_at"],
        )

    if versions.is_versioned(spark, source):
        source = versions.version(spark, source).folder
    return score_stream(spark, source, sink, checkpoint, score, once=once)


def build_baselines(spark: SparkSession, cfg: EngineConfig, full: bool = True) -> list[str]:
    """Make baselines of the monitored tables, whole or as a fixed-size sample; absent or empty ones are skipped.

    A whole baseline of a versioned table pins its newest version; the log, which grows by partitions, is copied.
    """
    made = []
    for name in (FEATURE_TABLE, LOG):
        if not table_exists(spark, cfg.path(name)):
            continue
        df = read_log(spark, cfg.path(name)) if name == LOG else read_table(spark, cfg.path(name))
        if df.isEmpty():
            continue
        made.append(name)
        if full and versions.is_versioned(spark, cfg.path(name)):
            baseline_version(spark, cfg.path(name), BASELINE)
            continue
        rows = df if full else baseline_sample(df, "customer_id", cfg.baseline_rows)
        baseline_full(rows, cfg.path(f"{name}_baseline"))
        versions.unpin(spark, cfg.path(name), BASELINE)
    return made


def feature_baseline(spark: SparkSession, cfg: EngineConfig) -> DataFrame | None:
    """The baseline of the features made last: the pinned version, or the stored sample; None before there is one."""
    if BASELINE in versions.pins(spark, cfg.path(FEATURE_TABLE)):
        return versions.read_pinned(spark, cfg.path(FEATURE_TABLE), BASELINE)
    path = cfg.path(f"{FEATURE_TABLE}_baseline")
    return read_table(spark, path) if table_exists(spark, path) else None


def refresh_from_files(
    spark: SparkSession,
    table: str,
    path: str,
    granularity: str,
    cols: Sequence[str],
    slices: Sequence[str] = (),
    schema: StructType | None = None,
    date_col: str = "log_date",
    exact: bool = False,
) -> DataFrame:
    """Bring the profile at ``path`` up to date with a table that is partitioned by date; returns the stored profile.

    The files a profile was made of are stored with it. Only windows of dates whose files changed since are counted
    again, and only their partitions are read; windows without any partition left go. Windows are those of the partition
    date. The rows are committed before the files, so a refresh that is cut short is repeated, not lost.
    """
    now = ledger.files_of(spark, table, date_col)
    files = f"{path}_files_{granularity}"
    window = profiles.window_start("part", granularity)
    there_is = table_exists(spark, path)
    known = there_is and table_exists(spark, files)
    changed = ledger.changed_dates(read_table(spark, files), now) if known else now.select("part").distinct()
    stale = [r[0] for r in changed.select(window.alias("w")).distinct().collect()]  # one date a window
    there = now.select("part", window.alias("w")).distinct()
    dates = [r["part"] for r in there.filter(ledger.on_dates("w", stale)).collect()]
    log = read_log(spark, table, schema).filter(ledger.on_dates(date_col, dates))
    fresh = profiles.profile(log, date_col, granularity, cols, slices, exact)
    if there_is:
        stored = read_table(spark, path)
        others = F.col("granularity") != granularity
        if known:
            others = others | ~F.coalesce(ledger.on_dates("window_start", stale), F.lit(False))
        fresh = stored.filter(others).select(*fresh.columns).unionByName(fresh)
    overwrite_table(fresh, path, keep=versions.KEEP)
    overwrite_table(now, files, keep=1)
    return read_table(spark, path)


def _update_profile(
    df: DataFrame, path: str, ts: str, granularity: str, cols: Sequence[str], slices: Sequence[str] = ()
) -> None:
    """Profile the windows whose rows changed since they were profiled, however old, and replace just those, so history
    stays; windows that lost all their rows go."""
    spark = df.sparkSession
    if table_exists(spark, path):
        stored = read_table(spark, path)
        if "content" in stored.columns:
            stale = profiles.stale_windows(stored, df, ts, granularity, cols, slices)
            known = stored.filter(
                (F.col("granularity") != granularity) | ~F.coalesce(ledger.on_dates("window_start", stale), F.lit(False))
            )
            df = df.filter(profiles.in_windows(ts, granularity, stale))
            fresh = profiles.profile(df, ts, granularity, cols, slices)
            overwrite_table(known.select(*fresh.columns).unionByName(fresh), path, keep=versions.KEEP)
            return
    overwrite_table(profiles.profile(df, ts, granularity, cols, slices), path, keep=versions.KEEP)


def monitor(
    spark: SparkSession, cfg: EngineConfig, as_of, log_schema: StructType | None = INFERENCE_LOG
) -> dict[str, DataFrame]:
    """Bring the stored profiles up to date and return the reports, lazily.

    ``log_schema`` None merges the columns of all log files instead, which opens every one of them.
    """
    feats = read_table(spark, cfg.path(FEATURE_TABLE), FEATURES)
    log = read_log(spark, cfg.path(LOG), log_schema)
    paths = {name: cfg.path(f"{name}_profile") for name in (FEATURE_TABLE, LOG)}
    for granularity in profiles.GRANULARITIES:
        _update_profile(feats, paths[FEATURE_TABLE], "updated_at", granularity, cfg.numeric_features)
    refresh_from_files(
        spark, cfg.path(LOG), paths[LOG], "day", cfg.numeric_features, ["model_version"], log_schema
    )
    stored = {name: read_table(spark, path) for name, path in paths.items()}

    out = {
        "readiness": readiness(spark, {"features": feats, "inference_log": log}),
        "monitor_status": monitor_status(spark, stored),
        "null_rates": keys.null_rates(feats, cfg.numeric_features),
        "duplicate_rate": keys.duplicate_rate(feats, "customer_id"),
        "performance_report": performance_report(log, as_of),
        "health_summary": health_summary(log, as_of),
        "mean_drift": mean_drift(log, cfg.numeric_features),
        "prediction_profile": profiles.prediction_profile(log),
        "consecutive_drift": profiles.drift_consecutive(stored[LOG]),
    }
    baseline = feature_baseline(spark, cfg)
    if baseline is not None:
        out["numeric_drift"] = drift.numeric_drift(feats, baseline, cfg.numeric_features)
        out["categorical_drift"] = drift.categorical_drift(feats, baseline, cfg.categorical_features)
    return out
