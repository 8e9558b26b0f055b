"""Queries on metrics, run tables, splits and grids.

The scored rows come from simple fleet predictors, so every number can be checked
in SQL: remaining life taken from the mean or longest life of the train engines,
or a constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.rul import nasa_term, version_of
from wearspan.operators.metrics import early_stopping, evaluate, metric_columns, mse, ranked_leaderboard, weighted_mean
from wearspan.operators.splits import background_sample, exact_holdout, expand_grid, grid_frame, with_holdout
from wearspan.queries.common import labelled, round_metrics, rounded, split_panels
from wearspan.queries.registry import ROW_KEY, LIFE, SPLIT, TELEMETRY, query, sql_metrics, sql_percentile
from wearspan.schema import CYCLE, ENGINE, REGIME, RUL
from wearspan.sources.catalog import best_runs, coverage, latest_runs, list_runs, result_rows
from wearspan.sources.tables import regime_of, table

KEYS = [ENGINE, CYCLE]
MODELS = ["constant", "longest_life", "mean_life"]
DATASETS = ["FD001", "FD002", "FD003", "FD004"]
SECONDS = "yyyy-MM-dd'T'HH:mm:ssXXX"

SCORED = (
    SPLIT
    + ","
    + LIFE
    + """,
scored AS (SELECT *, CAST(least(125, greatest(0, mean_life - "cycle")) AS DOUBLE) AS prediction FROM split_panel CROSS JOIN life)"""
)

RUNS = (
    SPLIT
    + ","
    + LIFE
    + f""",
guesses AS (
  SELECT s.*, 'constant' AS model_name, CAST(62.5 AS DOUBLE) AS prediction FROM split_panel s
  UNION ALL SELECT s.*, 'longest_life', CAST(least(125, greatest(0, top_life - "cycle")) AS DOUBLE) FROM split_panel s CROSS JOIN life
  UNION ALL SELECT s.*, 'mean_life', CAST(least(125, greatest(0, mean_life - "cycle")) AS DOUBLE) FROM split_panel s CROSS JOIN life),
runs AS (
  SELECT model_name, 'FD00' || CAST(1 + engine_id % 4 AS VARCHAR) AS dataset,
         CAST(extract('year' FROM observed_on) AS VARCHAR) || '1231T000000Z' AS version,
         CAST(extract('year' FROM observed_on) AS VARCHAR) || '-12-31T00:00:00Z' AS created_at,
         count(*) AS n, {sql_metrics()}
  FROM guesses GROUP BY ALL)"""
)


def _lives(train: DataFrame) -> DataFrame:
    return train.groupBy(ENGINE).agg(F.max(CYCLE).alias("life"))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Both splits with the mean-life prediction; the mean is a scalar subquery."""
    panels = split_panels(spark, folder)
    mean_life = _lives(panels.train).agg(F.avg("life")).scalar()
    guess = F.least(F.lit(125.0), F.greatest(F.lit(0.0), mean_life - F.col(CYCLE)))
    return panels.both().withColumn("prediction", guess)


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run per predictor, subset and year of observation, with its metrics.

    The predictors are columns of one pass; their metrics are unpivoted after the
    aggregation, so rows are never multiplied.
    """
    panels = split_panels(spark, folder)
    lives = _lives(panels.train)
    limits = {"mean_life": lives.agg(F.avg("life")).scalar(), "longest_life": lives.agg(F.max("life")).scalar()}
    guesses = {m: F.least(F.lit(125.0), F.greatest(F.lit(0.0), v - F.col(CYCLE))) for m, v in limits.items()}
    guesses["constant"] = F.lit(62.5)
    year = F.make_date(F.year("observed_on"), F.lit(12), F.lit(31)).cast("timestamp")
    rows = panels.both().select(
        RUL, F.concat(F.lit("FD00"), (1 + F.col(ENGINE) % 4).cast("string")).alias("dataset"), year.alias("_at"),
        *[guesses[m].cast("double").alias(m) for m in MODELS],
    )
    cells = [c.alias(f"{m}__{i}") for m in MODELS for i, c in enumerate(metric_columns(RUL, m))]
    wide = rows.groupBy("dataset", "_at").agg(F.count(F.lit(1)).alias("n"), *cells)
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("model_name"),
                *[F.col(f"{m}__{i}").alias(name) for i, name in enumerate(("rmse", "mae", "r2", "nasa_score"))],
            )
            for m in MODELS
        ]
    )
    long = wide.select(
        "dataset", version_of(F.col("_at")).alias("version"), F.date_format("_at", SECONDS).alias("created_at"), "n", F.inline(entries)
    )
    return round_metrics(long)


# --- metrics ------------------------------------------------------------------


@query(f"WITH {SCORED}\nSELECT split, count(*) AS n, {sql_metrics()} FROM scored GROUP BY split")
def naive_baseline_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: label, predict from the mean life, evaluate each split."""
    return round_metrics(evaluate(_scored(spark, folder), ["split"]))


@query(f"WITH {SCORED}\nSELECT count(*) AS n, {sql_metrics()} FROM scored")
def metrics_overall(spark: SparkSession, folder: str) -> DataFrame:
    return round_metrics(evaluate(_scored(spark, folder)))


@query(f"WITH {SCORED}\nSELECT regime AS operating_regime, split, count(*) AS n, {sql_metrics()} FROM scored GROUP BY ALL")
def metrics_by_regime(spark: SparkSession, folder: str) -> DataFrame:
    return round_metrics(evaluate(_scored(spark, folder).withColumn(REGIME, regime_of()), [REGIME, "split"]))


@query(
    f"""WITH {SCORED}
SELECT split, engine_id, "cycle", round(abs(prediction - rul), 6) AS abs_error,
  round(CASE WHEN prediction < rul THEN exp(-(prediction - rul) / 13.0) - 1 ELSE exp((prediction - rul) / 10.0) - 1 END, 4) AS nasa
FROM scored"""
)
def nasa_score_rows(spark: SparkSession, folder: str) -> DataFrame:
    y, p = F.col(RUL).cast("double"), F.col("prediction")
    return _scored(spark, folder).select(
        "split", *KEYS, F.round(F.abs(p - y), 6).alias("abs_error"), F.round(nasa_term(y, p), 4).alias("nasa")
    )


@query(
    f"""WITH {SCORED},
batches AS (SELECT split, observed_on, avg((prediction - rul) * (prediction - rul)) AS loss, count(*) AS size FROM scored GROUP BY ALL)
SELECT split, round(sum(loss * size) / greatest(sum(size), 1), 5) AS mean_loss FROM batches GROUP BY split"""
)
def weighted_batch_loss(spark: SparkSession, folder: str) -> DataFrame:
    """Losses of daily batches combined by batch size."""
    y, p = F.col(RUL).cast("double"), F.col("prediction")
    batches = _scored(spark, folder).groupBy("split", "observed_on").agg(mse(y, p).alias("loss"), F.count(F.lit(1)).alias("size"))
    return rounded(
        batches.groupBy("split").agg(weighted_mean(F.col("loss"), F.col("size")).alias("mean_loss")), ["mean_loss"], 5
    )


@query(
    f"""WITH {SCORED},
history AS (
  SELECT split, CAST((extract('year' FROM observed_on) - 1995) * 12 + extract('month' FROM observed_on) AS INTEGER) AS epoch,
         round(avg((prediction - rul) * (prediction - rul)), 5) AS validation_loss
  FROM scored GROUP BY ALL),
seen AS (
  SELECT *, row_number() OVER w AS n, min(validation_loss) OVER (w ROWS UNBOUNDED PRECEDING) AS best_loss,
         min(validation_loss) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before
  FROM history WINDOW w AS (PARTITION BY split ORDER BY epoch)),
marked AS (SELECT *, best_before IS NULL OR validation_loss < best_before AS improved FROM seen),
followed AS (
  SELECT *, CAST(n - max(CASE WHEN improved THEN n END) OVER (PARTITION BY split ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS INTEGER)
         AS epochs_since_best
  FROM marked)
SELECT split, epoch, validation_loss, best_loss, improved, epochs_since_best,
  coalesce(max(CASE WHEN epochs_since_best >= 10 THEN 1 ELSE 0 END)
    OVER (PARTITION BY split ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS stopped_before
FROM followed"""
)
def early_stop_history(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly losses read as a training history: best so far and where patience ends."""
    y, p = F.col(RUL).cast("double"), F.col("prediction")
    epoch = (F.year("observed_on") - 1995) * 12 + F.month("observed_on")
    history = _scored(spark, folder).groupBy("split", epoch.alias("epoch")).agg(F.round(mse(y, p), 5).alias("validation_loss"))
    return early_stopping(history, ["split"])


# --- run tables ---------------------------------------------------------------

RUN_COLUMNS = ["model_name", "dataset", "version", "created_at", "n", "rmse", "mae", "r2", "nasa_score"]


@query(f"WITH {RUNS}\nSELECT {', '.join(RUN_COLUMNS)} FROM runs")
def runs_list(spark: SparkSession, folder: str) -> DataFrame:
    """All runs, newest first."""
    return list_runs(_runs(spark, folder)).select(*RUN_COLUMNS)


@query(f"WITH {RUNS}\nSELECT {', '.join(RUN_COLUMNS)} FROM runs WHERE model_name = 'mean_life' AND dataset = 'FD001'")
def runs_filtered(spark: SparkSession, folder: str) -> DataFrame:
    return list_runs(_runs(spark, folder), "mean_life", "FD001").select(*RUN_COLUMNS)


@query(
    f"""WITH {RUNS}
SELECT {', '.join(RUN_COLUMNS)} FROM runs
QUALIFY row_number() OVER (PARTITION BY model_name, dataset ORDER BY created_at DESC, version DESC) = 1"""
)
def runs_latest(spark: SparkSession, folder: str) -> DataFrame:
    return latest_runs(_runs(spark, folder)).select(*RUN_COLUMNS)


@query(
    f"""WITH {RUNS}
SELECT {', '.join(RUN_COLUMNS)} FROM runs
QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY rmse, created_at, model_name) = 1"""
)
def runs_best(spark: SparkSession, folder: str) -> DataFrame:
    return best_runs(_runs(spark, folder)).select(*RUN_COLUMNS)


@query(
    f"""WITH {RUNS}
SELECT model_name, dataset, version, CAST(rank() OVER (g ORDER BY rmse) AS INTEGER) AS rmse_rank,
  CAST(rank() OVER (g ORDER BY mae) AS INTEGER) AS mae_rank, CAST(rank() OVER (g ORDER BY nasa_score) AS INTEGER) AS nasa_score_rank,
  CAST(rank() OVER (g ORDER BY r2 DESC NULLS LAST) AS INTEGER) AS r2_rank
FROM runs WINDOW g AS (PARTITION BY dataset)"""
)
def leaderboard_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ranked_leaderboard(_runs(spark, folder))
    return ranked.select("model_name", "dataset", "version", "rmse_rank", "mae_rank", "nasa_score_rank", "r2_rank")


@query(
    f"""WITH {RUNS}
SELECT model_name, {", ".join(f"count(*) FILTER (WHERE dataset = '{d}') AS {d}" for d in DATASETS)} FROM runs GROUP BY model_name"""
)
def coverage_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return coverage(_runs(spark, folder), DATASETS)


@query(
    f"""WITH {RUNS}
SELECT model_name, dataset, version,
  '| ' || model_name || ' | ' || dataset || ' | ' || printf('%.4f', rmse) || ' | ' || printf('%.4f', mae) || ' | '
  || printf('%.4f', r2) || ' | ' || printf('%.4f', nasa_score) || ' |' AS line
FROM runs"""
)
def leaderboard_lines(spark: SparkSession, folder: str) -> DataFrame:
    return result_rows(_runs(spark, folder)).select("model_name", "dataset", "version", "line")


# --- splits and grids ---------------------------------------------------------


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", {sql_percentile(ROW_KEY)} < 20 AS is_validation FROM telemetry"""
)
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return with_holdout(rows, 20).select(*KEYS, "is_validation")


@query(f"""WITH {TELEMETRY} SELECT engine_id, "cycle", {sql_percentile("CAST(engine_id AS BIGINT) * 7919")} < 20 AS is_validation FROM telemetry""")
def holdout_split_by_engine(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return with_holdout(rows, 20, "engine").select(*KEYS, "is_validation")


# The first 15 hexadecimal digits of the key's MD5, as a number.
HASHED = """hashed AS (SELECT *, CAST('0x' || substr(md5(CAST(engine_id AS VARCHAR) || ':' || CAST("cycle" AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM labelled)"""


@query(
    f"""WITH {TELEMETRY}, {HASHED}
SELECT engine_id, "cycle", row_number() OVER (ORDER BY h, engine_id, "cycle")
       <= greatest(1, CAST(floor(0.2 * count(*) OVER ()) AS BIGINT)) AS is_validation
FROM hashed"""
)
def holdout_exact(spark: SparkSession, folder: str) -> DataFrame:
    """A hold-out of exactly one fifth of the rows."""
    rows, _ = labelled(spark, folder)
    return exact_holdout(rows, 0.2).select(*KEYS, "is_validation")


@query(f"""WITH {TELEMETRY}, {HASHED} SELECT engine_id, "cycle", s_2, rul FROM hashed ORDER BY h, engine_id, "cycle" LIMIT 100""")
def background_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The sampling operator: 100 background rows without replacement."""
    rows, _ = labelled(spark, folder)
    return background_sample(rows, 100).select(*KEYS, "s_2", RUL)


@query(
    """WITH a AS (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS i FROM (SELECT DISTINCT l_returnflag AS flag FROM lineitem)),
b AS (SELECT status, row_number() OVER (ORDER BY status) - 1 AS j FROM (SELECT DISTINCT l_linestatus AS status FROM lineitem)),
c AS (SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS k FROM (SELECT DISTINCT event_type AS kind FROM events))
SELECT CAST((i * (SELECT count(*) FROM b) + j) * (SELECT count(*) FROM c) + k AS INTEGER) AS ordinal, flag, status, kind
FROM a CROSS JOIN b CROSS JOIN c"""
)
def param_grid(spark: SparkSession, folder: str) -> DataFrame:
    """All combinations of three short code lists found in the tables, first list slowest."""

    def codes(name: str, column: str):
        return table(spark, folder, name).agg(F.array_sort(F.collect_set(column))).scalar()

    lists = table(spark, folder, "lineitem").agg(
        F.array_sort(F.collect_set("l_returnflag")).alias("flag"), F.array_sort(F.collect_set("l_linestatus")).alias("status")
    )
    return grid_frame(lists.withColumn("kind", codes("events", "event_type")), ["flag", "status", "kind"])


GRID = {"cap": [100, 125, 150], "shift": [-20, 0, 20]}
CANDIDATES = expand_grid(GRID)


@query(
    f"""WITH {SCORED},
grid(ordinal, cap, shift) AS (VALUES {", ".join(f"({i}, {c['cap']}, {c['shift']})" for i, c in enumerate(CANDIDATES))}),
tried AS (
  SELECT ordinal, cap, shift, rul, CAST(least(cap, greatest(0, mean_life + shift - "cycle")) AS DOUBLE) AS guess
  FROM scored CROSS JOIN grid
  WHERE split = 'train' AND {sql_percentile(ROW_KEY)} < 20),
log AS (SELECT ordinal, cap, shift, count(*) AS n, {sql_metrics("rul", "guess")} FROM tried GROUP BY ALL)
SELECT *, row_number() OVER (ORDER BY rmse, ordinal) = 1 AS is_best FROM log"""
)
def grid_search_fleet_life(spark: SparkSession, folder: str) -> DataFrame:
    """Grid search of the fleet predictor on the hold-out rows, with its whole log.

    Every candidate is a set of aggregates of the same single pass over the rows.
    """
    panels = split_panels(spark, folder)
    mean_life = _lives(panels.train).agg(F.avg("life")).scalar()
    held = with_holdout(panels.train, 20).where("is_validation").withColumn("_life", mean_life)
    cells = []
    for i, c in enumerate(CANDIDATES):
        guess = F.least(F.lit(float(c["cap"])), F.greatest(F.lit(0.0), F.col("_life") + c["shift"] - F.col(CYCLE)))
        cells += [m.alias(f"c{i}_{j}") for j, m in enumerate(metric_columns(F.col(RUL), guess))]
    wide = held.agg(F.count(F.lit(1)).alias("n"), *cells)
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(c["cap"]).alias("cap"),
                F.lit(c["shift"]).alias("shift"),
                F.col("n"),
                *[F.col(f"c{i}_{j}").alias(name) for j, name in enumerate(("rmse", "mae", "r2", "nasa_score"))],
            )
            for i, c in enumerate(CANDIDATES)
        ]
    )
    log = round_metrics(wide.select(F.inline(entries)))
    first = log.agg(F.min_by("ordinal", F.struct("rmse", "ordinal"))).scalar()
    return log.withColumn("is_best", F.col("ordinal") == first)
