"""Queries on labels, features and exploratory profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators import explore
from wearspan.operators.labels import add_test_rul, add_train_rul, join_last_cycle, label_breaks, missing_final_rul
from wearspan.operators.normalize import fit_normalization, long_moments, moments, normalize
from wearspan.operators.rolling import add_rolling, rolling_column_names
from wearspan.operators.sequences import last_cycle_snapshot
from wearspan.plans.features import FeatureConfig, build_features, of_engines, select_features
from wearspan.plans.scoring import apply_contract
from wearspan.queries.common import labelled, rounded, split_panels
from wearspan.queries.registry import EVENTS, FINAL_RUL, SPLIT, TELEMETRY, query
from wearspan.schema import CYCLE, ENGINE, REGIME, RUL, SETTINGS, rolling_names
from wearspan.sources.tables import (
    EVENT_SENSORS,
    TELEMETRY_ACTIVE,
    TELEMETRY_SENSORS,
    is_test,
    regime_of,
    supplier_final_rul,
    table,
    telemetry,
    telemetry_events,
)
from wearspan.sources.telemetry import with_notebook_names

KEYS = [ENGINE, CYCLE]

# --- labels -------------------------------------------------------------------


@query(f"WITH {TELEMETRY} SELECT engine_id, \"cycle\", rul FROM labelled")
def rul_train_label(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return rows.select(*KEYS, RUL)


@query(
    f"""WITH {TELEMETRY}, {FINAL_RUL}
SELECT engine_id, "cycle", CAST(least(last_cycle - "cycle" + final_rul, 125) AS INTEGER) AS rul
FROM labelled JOIN final_rul USING (engine_id)"""
)
def rul_test_label(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry(spark, folder)
    return add_test_rul(source.rows, supplier_final_rul(spark, folder), profile=source.profile).select(*KEYS, RUL)


@query(
    f"""WITH {TELEMETRY}, {FINAL_RUL}
SELECT engine_id, "cycle", CAST(last_cycle - "cycle" + final_rul AS INTEGER) AS rul
FROM labelled JOIN final_rul USING (engine_id)"""
)
def rul_test_label_uncapped(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry(spark, folder)
    labelled_rows = add_test_rul(source.rows, supplier_final_rul(spark, folder), None, source.profile)
    return labelled_rows.select(*KEYS, RUL)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", CAST(CASE WHEN engine_id % 3 <> 0 THEN least(last_cycle - "cycle" + 20 + engine_id % 100, 125) END AS INTEGER) AS rul
FROM labelled"""
)
def rul_null_final(spark: SparkSession, folder: str) -> DataFrame:
    """Engines whose official life is empty get no label, not the cap."""
    source = telemetry(spark, folder)
    final = supplier_final_rul(spark, folder).withColumn("final_rul", F.when(F.col(ENGINE) % 3 != 0, F.col("final_rul")))
    return add_test_rul(source.rows, final, profile=source.profile, check=False).select(*KEYS, RUL)


# A reading that is no number, on a ninth of the rows; SQL has null in its place.
NO_NUMBER = "(engine_id + \"cycle\") % 9 = 0"
WITH_GAPS = f"gaps AS MATERIALIZED (SELECT engine_id, \"cycle\", CASE WHEN NOT ({NO_NUMBER}) THEN s_2 END AS s_2 FROM labelled)"


def _with_nan(spark: SparkSession, folder: str):
    source = telemetry(spark, folder)
    bad = (F.col(ENGINE) + F.col(CYCLE)) % 9 == 0
    return source.rows.withColumn("s_2", F.when(bad, float("nan")).otherwise(F.col("s_2"))), source.profile


@query(
    f"""WITH {TELEMETRY}, {WITH_GAPS}
SELECT engine_id, "cycle", round(avg(s_2) OVER w, 6) AS s_2_roll5_mean, round(coalesce(stddev_samp(s_2) OVER w, 0.0), 4) AS s_2_roll5_std
FROM gaps WINDOW w AS (PARTITION BY engine_id ORDER BY "cycle" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
)
def rolling_with_nan(spark: SparkSession, folder: str) -> DataFrame:
    """Rolling statistics skip readings that are no numbers."""
    rows, profile = _with_nan(spark, folder)
    rolled = add_rolling(rows, ["s_2"], (5,), profile).select(*KEYS, "s_2_roll5_mean", "s_2_roll5_std")
    return rounded(rounded(rolled, ["s_2_roll5_mean"], 6), ["s_2_roll5_std"], 4)


@query(
    f"""WITH {TELEMETRY}, {WITH_GAPS},
scoped AS MATERIALIZED (SELECT *, 0 AS scope FROM gaps),
fitted AS MATERIALIZED (SELECT scope, avg(s_2) AS s_2_m, stddev_samp(s_2) AS s_2_d FROM scoped WHERE engine_id % 5 <> 0 GROUP BY scope)
SELECT engine_id, "cycle", round((s_2 - s_2_m) / s_2_d, 6) AS s_2 FROM scoped JOIN fitted USING (scope)"""
)
def normalize_with_nan(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling is fitted on the readings that are numbers; the others stay missing."""
    rows, _ = _with_nan(spark, folder)
    stats = fit_normalization(rows.where(~is_test()), ["s_2"])
    scaled = normalize(rows.select(*KEYS, "s_2"), stats)
    return rounded(scaled.withColumn("s_2", F.nanvl("s_2", F.lit(None).cast("double"))), ["s_2"], 6)


@query(
    f"""WITH {TELEMETRY},
known AS (SELECT CAST(s_suppkey AS INTEGER) AS engine_id FROM supplier WHERE s_acctbal >= 0)
SELECT DISTINCT engine_id FROM telemetry WHERE engine_id NOT IN (SELECT engine_id FROM known)"""
)
def rul_missing_engines(spark: SparkSession, folder: str) -> DataFrame:
    """Engines without an official label; here only solvent suppliers have one."""
    solvent = table(spark, folder, "supplier").where(F.col("s_acctbal") >= 0)
    known = solvent.select(F.col("s_suppkey").cast("int").alias(ENGINE))
    return missing_final_rul(telemetry(spark, folder).rows, known)


@query(
    f"""WITH {TELEMETRY},
steps AS (SELECT *, lag(rul) OVER (PARTITION BY engine_id ORDER BY "cycle") AS previous FROM labelled)
SELECT engine_id, count(*) AS n_rows, CAST(sum(CASE WHEN rul > previous THEN 1 ELSE 0 END) AS BIGINT) AS violations,
       max(CASE WHEN "cycle" = last_cycle THEN rul END) AS last_rul, max(rul) AS top_rul
FROM steps GROUP BY engine_id"""
)
def label_monotone_check(spark: SparkSession, folder: str) -> DataFrame:
    rows, profile = labelled(spark, folder)
    return label_breaks(rows, profile)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id AS unit_nr, "cycle" AS time_cycles, last_cycle AS max_cycle, last_cycle - "cycle" AS rul FROM labelled"""
)
def max_cycle_join(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry(spark, folder)
    joined = join_last_cycle(source.rows.select(*KEYS), source.profile)
    return with_notebook_names(joined).withColumn(RUL, F.col("max_cycle") - F.col("time_cycles"))


# --- features -----------------------------------------------------------------


def _rolling_sql(sensors: list[str], windows: tuple[int, ...], digits: int = 4) -> str:
    cells = []
    for n in windows:
        means, spreads = rolling_names(sensors, n)
        frame = f'(PARTITION BY engine_id ORDER BY "cycle" ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'
        cells += [f"avg({s}) OVER {frame} AS {m}" for s, m in zip(sensors, means)]
        cells += [f"coalesce(stddev_samp({s}) OVER {frame}, 0.0) AS {d}" for s, d in zip(sensors, spreads)]
    return ",\n  ".join(cells)


def _round_sql(columns: list[str], digits: int) -> str:
    return ",\n  ".join(f"round({c}, {digits}) AS {c}" for c in columns)


ROLLED = rolling_column_names(TELEMETRY_ACTIVE, (5, 10))
ROLLED_MEANS = [c for c in ROLLED if c.endswith("_mean")]
ROLLED_STDS = [c for c in ROLLED if c.endswith("_std")]
ROLLED_SQL = f"rolled AS MATERIALIZED (SELECT *, {_rolling_sql(TELEMETRY_ACTIVE, (5, 10))} FROM labelled)"


@query(
    f"""WITH {TELEMETRY}, {ROLLED_SQL}
SELECT engine_id, "cycle", {_round_sql(ROLLED_MEANS, 6)}, {_round_sql(ROLLED_STDS, 4)} FROM rolled"""
)
def rolling_features_5_10(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry(spark, folder)
    rolled = add_rolling(source.rows, TELEMETRY_ACTIVE, (5, 10), source.profile)
    return rounded(rounded(rolled.select(*KEYS, *ROLLED), ROLLED_MEANS, 6), ROLLED_STDS, 4)


EVENT_ROLLED = rolling_column_names(EVENT_SENSORS, (3,))


@query(
    f"""WITH {EVENTS}, rolled AS (SELECT *, {_rolling_sql(EVENT_SENSORS, (3,))} FROM telemetry_events)
SELECT engine_id, "cycle", {_round_sql(EVENT_ROLLED, 5)} FROM rolled"""
)
def rolling_features_events(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry_events(spark, folder)
    rolled = add_rolling(source.rows, EVENT_SENSORS, (3,), source.profile)
    return rounded(rolled.select(*KEYS, *EVENT_ROLLED), EVENT_ROLLED, 5)


@query(
    f"""WITH {TELEMETRY}, {ROLLED_SQL}
SELECT engine_id, "cycle", {_round_sql(ROLLED_MEANS, 6)}, {_round_sql(ROLLED_STDS, 4)} FROM rolled"""
)
def bucketed_rolling(spark: SparkSession, folder: str) -> DataFrame:
    """The same features with every longer engine cut into segments, as heavy engines are."""
    segment = 256
    source = telemetry(spark, folder, rows_per_task=segment)
    rolled = add_rolling(source.rows, TELEMETRY_ACTIVE, (5, 10), source.profile, segment)
    return rounded(rounded(rolled.select(*KEYS, *ROLLED), ROLLED_MEANS, 6), ROLLED_STDS, 4)


def _digits(column: str) -> int:
    """Decimals of a statistic: past those of an exact mean for small values, few for large ones, so that none is a tie."""
    return {"s_4": 10, "s_7": 10, "s_3": 4}.get(column[:3], 8)


def _round_stats(stats: DataFrame) -> DataFrame:
    digits = F.when(F.col("column").rlike("^s_[47]"), "small").when(F.col("column").startswith("s_3"), "large").otherwise("other")
    by_size = {"small": 10, "large": 4, "other": 8}

    def rounded_column(c: str):
        out = None
        for size, n in by_size.items():
            out = F.when(digits == size, F.round(c, n)) if out is None else out.when(digits == size, F.round(c, n))
        return out

    return stats.withColumns({c: rounded_column(c) for c in ("mean", "std")})


def _stats_sql(columns: list[str], source: str, by: str = "") -> str:
    select = "regime AS operating_regime, " if by else ""
    return "\nUNION ALL\n".join(
        f"SELECT {select}'{c}' AS \"column\", round(avg({c}), {_digits(c)}) AS mean, "
        f"round(CASE WHEN coalesce(stddev_samp({c}), 0) = 0 THEN 1.0 ELSE stddev_samp({c}) END, {_digits(c)}) AS std FROM {source} {by}"
        for c in columns
    )


@query(f"WITH {TELEMETRY}, {ROLLED_SQL}\n{_stats_sql(TELEMETRY_SENSORS + ROLLED, 'rolled')}")
def norm_stats_global(spark: SparkSession, folder: str) -> DataFrame:
    source = telemetry(spark, folder)
    columns = TELEMETRY_SENSORS + ROLLED
    rolled = add_rolling(source.rows, TELEMETRY_ACTIVE, (5, 10), source.profile)
    return _round_stats(long_moments(moments(rolled, columns), columns))


@query(f"WITH {TELEMETRY}\n{_stats_sql(TELEMETRY_SENSORS, 'labelled', 'GROUP BY regime')}")
def norm_stats_regime(spark: SparkSession, folder: str) -> DataFrame:
    rows = telemetry(spark, folder).rows.withColumn(REGIME, regime_of())
    wide = moments(rows, TELEMETRY_SENSORS, [REGIME])
    return _round_stats(long_moments(wide, TELEMETRY_SENSORS, [REGIME]))


def _z(c: str, mean: str, std: str) -> str:
    return f"({c} - {mean}) / (CASE WHEN coalesce({std}, 0) = 0 THEN 1.0 ELSE {std} END)"


def _fit_sql(columns: list[str], source: str, name: str, by: str = "") -> str:
    cells = ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_d" for c in columns)
    return f"{name} AS MATERIALIZED (SELECT {by + ', ' if by else ''}{cells} FROM {source}{' GROUP BY ' + by if by else ''})"


@query(
    f"""WITH {TELEMETRY},
scoped AS MATERIALIZED (SELECT *, 0 AS scope FROM labelled),
{_fit_sql(TELEMETRY_SENSORS, "scoped WHERE engine_id % 5 <> 0", "fitted", "scope")}
SELECT engine_id, "cycle", {", ".join(f"round({_z(c, c + '_m', c + '_d')}, 6) AS {c}" for c in TELEMETRY_SENSORS)}
FROM scoped JOIN fitted USING (scope)"""
)
def normalize_global(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling fitted on the train engines, applied to all engines."""
    rows = telemetry(spark, folder).rows
    stats = fit_normalization(rows.where(~is_test()), TELEMETRY_SENSORS)
    return rounded(normalize(rows.select(*KEYS, *TELEMETRY_SENSORS), stats), TELEMETRY_SENSORS, 6)


@query(
    f"""WITH {EVENTS},
keyed AS (SELECT *, CAST(setting_1 * 1000 + s_3 AS INTEGER) AS regime FROM telemetry_events),
{_fit_sql(["s_2", "s_3"], "keyed WHERE engine_id % 5 <> 0", "fitted")},
{_fit_sql(["s_2", "s_3"], "keyed WHERE engine_id % 5 <> 0", "by_regime", "regime")}
SELECT engine_id, "cycle", b.regime IS NOT NULL AS seen,
  {", ".join(
      "round(CASE WHEN b.regime IS NULL THEN " + _z("k." + c, "f." + c + "_m", "f." + c + "_d")
      + " ELSE " + _z("k." + c, "b." + c + "_m", "b." + c + "_d") + f" END, 6) AS {c}" for c in ("s_2", "s_3"))}
FROM keyed k CROSS JOIN fitted f LEFT JOIN by_regime b ON k.regime = b.regime"""
)
def normalize_regime_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling per hour and load level; levels not seen in training use the global scaling."""
    rows = telemetry_events(spark, folder).rows.withColumn(REGIME, (F.col("setting_1") * 1000 + F.col("s_3")).cast("int"))
    stats = fit_normalization(rows.where(~is_test()), ["s_2", "s_3"], by_regime=True)
    scaled = normalize(rows.select(*KEYS, REGIME, "s_2", "s_3"), stats)
    known = stats.regimes.select(REGIME, F.lit(True).alias("seen"))
    marked = scaled.join(F.broadcast(known) if stats.small else known, REGIME, "left")
    return rounded(
        marked.select(*KEYS, F.coalesce("seen", F.lit(False)).alias("seen"), "s_2", "s_3"), ["s_2", "s_3"], 6
    )


FEATURES = [*SETTINGS, *TELEMETRY_ACTIVE, *ROLLED]
SCALED = [*TELEMETRY_ACTIVE, *ROLLED]
SPLIT_ROLLED = SPLIT + f", rolled AS MATERIALIZED (SELECT *, {_rolling_sql(TELEMETRY_ACTIVE, (5, 10))} FROM split_panel)"


@query(
    f"""WITH {SPLIT_ROLLED},
scoped AS MATERIALIZED (SELECT *, 0 AS scope FROM rolled),
{_fit_sql(SCALED, "scoped WHERE split = 'train'", "fitted", "scope")}
SELECT split, engine_id, "cycle", setting_1, setting_2, setting_3,
  {", ".join(f"round({_z(c, c + '_m', c + '_d')}, 5) AS {c}" for c in SCALED)}, rul
FROM scoped JOIN fitted USING (scope)"""
)
def build_features_global(spark: SparkSession, folder: str) -> DataFrame:
    panels = split_panels(spark, folder)
    made = build_features(
        panels.train, panels.test, FeatureConfig(), train_profile=panels.train_profile, test_profile=panels.test_profile
    )
    both = made.train.withColumn("split", F.lit("train")).unionByName(made.test.withColumn("split", F.lit("test")))
    return rounded(both, SCALED, 5)


@query(
    f"""WITH {SPLIT_ROLLED}, {_fit_sql(SCALED, "rolled WHERE split = 'train'", "fitted", "regime")}
SELECT split, engine_id, "cycle", regime AS operating_regime, setting_1, setting_2, setting_3,
  {", ".join(f"round({_z(c, c + '_m', c + '_d')}, 5) AS {c}" for c in SCALED)}, rul
FROM rolled JOIN fitted USING (regime)"""
)
def build_features_by_regime(spark: SparkSession, folder: str) -> DataFrame:
    panels = split_panels(spark, folder)
    train = panels.train.withColumn("regime", regime_of())
    test = panels.test.withColumn("regime", regime_of())
    made = build_features(
        train, test, FeatureConfig(normalize_by_regime=True), "regime", panels.train_profile, panels.test_profile
    )
    both = made.train.withColumn("split", F.lit("train")).unionByName(made.test.withColumn("split", F.lit("test")))
    return rounded(both, SCALED, 5)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", s_7, s_4, s_3, s_2, CAST(setting_1 AS DOUBLE) AS setting_1 FROM telemetry"""
)
def feature_contract_select(spark: SparkSession, folder: str) -> DataFrame:
    """Features put into the order a registered model asks for."""
    contract = ["s_7", "s_4", "s_3", "s_2", "setting_1"]
    rows = telemetry(spark, folder).rows.select(*KEYS, "setting_1", *TELEMETRY_ACTIVE)
    return apply_contract(rows, contract, KEYS)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", setting_1, setting_2, s_2, s_3, s_4, s_7, rul FROM labelled WHERE "cycle" = last_cycle"""
)
def last_cycle_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return last_cycle_snapshot(rows.select(*KEYS, "setting_1", "setting_2", *TELEMETRY_ACTIVE, RUL))


@query(f"WITH {TELEMETRY} SELECT engine_id, \"cycle\", s_7, s_2, s_4, rul FROM labelled")
def feature_target_split(spark: SparkSession, folder: str) -> DataFrame:
    """The columns a model is fitted on: features in its order, then the target."""
    rows, _ = labelled(spark, folder)
    return select_features(rows, ["s_7", "s_2", "s_4"])


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", s_2 FROM telemetry
WHERE engine_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 8)"""
)
def engine_membership(spark: SparkSession, folder: str) -> DataFrame:
    """Histories of chosen engines, here those of suppliers in eight nations."""
    chosen = table(spark, folder, "supplier").where("s_nationkey < 8").select(F.col("s_suppkey").cast("int").alias(ENGINE))
    return of_engines(telemetry(spark, folder).rows, chosen).select(*KEYS, "s_2")


# --- exploration --------------------------------------------------------------


def _per_sensor(expression: str, value: str, tail: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS sensor, {expression.format(c=c)} AS {value} FROM labelled {tail.format(c=c)}"
        for c in TELEMETRY_SENSORS
    )


@query(f"WITH {TELEMETRY}\n{_per_sensor('round(stddev_samp({c}), 4)', 'std')}")
def sensor_std_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.sensor_spread(telemetry(spark, folder).rows, TELEMETRY_SENSORS), ["std"], 4)


@query(f"WITH {TELEMETRY}, spread AS ({_per_sensor('stddev_samp({c})', 'std')})\nSELECT sensor, round(std, 6) AS std FROM spread WHERE std < 1e-4")
def flat_sensors(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(explore.flat_sensors(telemetry(spark, folder).rows, TELEMETRY_SENSORS), ["std"], 6)


@query(
    f"""WITH {TELEMETRY}
{_per_sensor("round(CASE WHEN stddev_samp({c}) = 0 THEN NULL ELSE covar_samp({c}, rul) / (stddev_samp({c}) * stddev_samp(rul)) END, 4)", "correlation")}"""
)
def sensor_rul_corr(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return rounded(explore.rul_correlation(rows, TELEMETRY_SENSORS), ["correlation"], 4)


@query(
    f"""WITH {TELEMETRY}
SELECT regime AS operating_regime, round(avg(s_2), 4) AS s_2_mean, round(avg(s_3), 4) AS s_3_mean, round(avg(s_4), 4) AS s_4_mean
FROM labelled GROUP BY regime"""
)
def regime_sensor_means(spark: SparkSession, folder: str) -> DataFrame:
    rows = telemetry(spark, folder).rows.withColumn(REGIME, regime_of())
    return rounded(explore.regime_means(rows, ["s_2", "s_3", "s_4"]), ["s_2_mean", "s_3_mean", "s_4_mean"], 4)


@query(
    f"""WITH {TELEMETRY}
{_per_sensor('count(*) AS n_rows, count(DISTINCT engine_id) AS n_engines, CAST(sum(CASE WHEN {c} IS NULL OR isnan({c}) OR isinf({c}) THEN 1 ELSE 0 END) AS BIGINT)', 'n_bad')}"""
)
def quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    return explore.quality_profile(telemetry(spark, folder).rows, TELEMETRY_SENSORS)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, count(*) AS n_cycles, min("cycle") AS first_cycle, max("cycle") AS max_cycle FROM telemetry GROUP BY engine_id"""
)
def engine_lives(spark: SparkSession, folder: str) -> DataFrame:
    return explore.engine_lives(telemetry(spark, folder).rows)


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", s_2, s_3, rul FROM labelled ORDER BY engine_id, "cycle" LIMIT 5"""
)
def head_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The preview report: first five rows in key order."""
    rows, _ = labelled(spark, folder)
    return rows.select(*KEYS, "s_2", "s_3", RUL).orderBy(*KEYS).limit(5)
