"""The sensor layers derived from the ``events`` table, in Spark and in DuckDB SQL.

One user plays one batch. The raw view spells readings the way a historian
does: four timestamp formats and some garbage, thousands separators, null
tokens, impossible zeros, and a second copy of some rows. It is a projection of
the whole table, so every query over it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchlake.functions.cells import HASH_RANGE
from batchlake.functions.schema import BATCH, MODEL_INPUTS, TARGET, TIME
from batchlake.operators.features import build_features
from batchlake.operators.learn import prediction_table, split
from batchlake.operators.series import SLICE_ROWS, BatchProfile, profile_batches
from batchlake.plans.medallion import clean
from batchlake.plans.monitor import LATEST_ROWS, latest_n
from batchlake.session import prepare

HEADERS = {
    "Time": "timestamp",
    "Batch Time (mins)": "batch_time_mins",
    "R1_VISC_CP": "viscosity_cp",
    "R1_TEMP_C": "temperature_c",
    "R1_PH_R02": "ph_level",
    "R1_MASS_KG": "r1_mass",
}

EPOCH_2024_MICROS = 1_704_067_200_000_000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def sensor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historian rows with their original headers, all text."""
    n = F.col("event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - EPOCH_2024_MICROS
    cents = F.round(F.col("value") * 100).cast("bigint")
    ph = n % 141
    time_s = (
        F.when(n % 97 == 0, "garbage")
        .when(n % 4 == 0, F.date_format("ts", "M/d/yyyy h:mm:ss.SSS a"))
        .when(n % 4 == 1, F.date_format("ts", "M/d/yyyy H:mm:ss"))
        .when(n % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "M/d/yyyy h:mm a"))
    )
    minutes = F.concat(
        F.expr(f"(unix_micros(cast(ts as timestamp)) - {EPOCH_2024_MICROS}) div 60000000"),
        F.lit("."),
        F.lpad(F.floor((micros % 60_000_000) / 60).cast("string"), 6, "0"),
    )
    copies = F.when(n % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # a file of few row groups is few tasks, and spelling and parsing are the work
    dealt = events(spark, sf_dir).repartition("event_id")
    rows = dealt.select(
        time_s.alias("Time"),
        F.when(n % 50 == 0, "0").when(n % 53 == 0, "Null").otherwise(minutes).alias(
            "Batch Time (mins)"
        ),
        F.when(n % 11 == 0, "Null")
        .otherwise(F.concat(F.floor(cents / 10).cast("bigint"), F.lit("."), cents % 10))
        .alias("R1_VISC_CP"),
        F.get_json_object("props", "$.k").alias("R1_TEMP_C"),
        F.concat(F.floor(ph / 10).cast("bigint"), F.lit("."), ph % 10).alias("R1_PH_R02"),
        F.concat(F.lit("b"), "user_id").alias(BATCH),
        F.explode(copies).alias("copy"),
        n.alias("line_no"),
    )
    mass = F.when(F.col("line_no") % 17 == 0, "NaN").otherwise(
        F.concat("line_no", F.lit(",000."), F.col("copy") + 5)
    )
    return rows.select(
        *list(HEADERS)[:-1],
        mass.alias("R1_MASS_KG"),
        BATCH,
        F.concat(F.lit("copy"), "copy").alias("source_file"),
        F.lit(0).cast("bigint").alias("block_start"),
        "line_no",
    )


def event_profile(spark: SparkSession, sf_dir: str, slice_rows: int = SLICE_ROWS) -> BatchProfile:
    """Batch sizes from the events, an upper bound of the rows after cleaning."""
    keyed = events(spark, sf_dir).select(
        F.concat(F.lit("b"), "user_id").alias(BATCH), F.col("ts").alias(TIME)
    )
    return profile_batches(keyed, slice_rows=slice_rows)


def sensor_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sensor_raw(spark, sf_dir))


def sensor_gold(spark: SparkSession, sf_dir: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    profile = event_profile(spark, sf_dir, slice_rows)
    return build_features(sensor_silver(spark, sf_dir), profile)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test split with the last viscosity as the forecast, so that SQL can check it."""
    _, test = split(sensor_gold(spark, sf_dir))
    return prediction_table(test.withColumn("prediction", F.col("viscosity_lag_1")))


def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_n(predictions(spark, sf_dir))


# -- the same layers in DuckDB SQL ---------------------------------------------

RAW_SQL = f"""
raw0 AS (
  SELECT event_id AS n, ts, user_id, props,
         CAST(round(value * 100) AS BIGINT) AS cents,
         epoch_us(ts) - {EPOCH_2024_MICROS} AS us,
         unnest(CASE WHEN event_id % 13 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM events),
raw AS (
  SELECT CASE WHEN n % 97 = 0 THEN 'garbage'
              WHEN n % 4 = 0 THEN strftime(ts, '%-m/%-d/%Y %-I:%M:%S.%g %p')
              WHEN n % 4 = 1 THEN strftime(ts, '%-m/%-d/%Y %-H:%M:%S')
              WHEN n % 4 = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%-m/%-d/%Y %-I:%M %p') END AS "timestamp",
         CASE WHEN n % 50 = 0 THEN '0' WHEN n % 53 = 0 THEN 'Null'
              ELSE concat(us // 60000000, '.', lpad(CAST((us % 60000000) // 60 AS VARCHAR), 6, '0'))
              END AS batch_time_mins,
         CASE WHEN n % 11 = 0 THEN 'Null' ELSE concat(cents // 10, '.', cents % 10) END AS viscosity_cp,
         props->>'$.k' AS temperature_c,
         concat((n % 141) // 10, '.', (n % 141) % 10) AS ph_level,
         CASE WHEN n % 17 = 0 THEN 'NaN' ELSE concat(n, ',000.', copy + 5) END AS r1_mass,
         concat('b', user_id) AS batch_id,
         concat('copy', copy) AS source_file,
         n AS line_no
  FROM raw0)"""


def _number(col: str) -> str:
    tokens = "'Null', 'null', 'NULL', 'nan', 'NaN', 'None', ''"
    bare = f"replace({col}, ',', '')"
    return f"try_cast(CASE WHEN {bare} IN ({tokens}) THEN NULL ELSE {bare} END AS DOUBLE) AS {col}"


TIME_SQL = """coalesce(try_strptime("timestamp", '%m/%d/%Y %I:%M:%S.%g %p'),
                  try_strptime("timestamp", '%m/%d/%Y %H:%M:%S'),
                  try_strptime("timestamp", '%Y-%m-%d %H:%M:%S'),
                  try_strptime("timestamp", '%m/%d/%Y %I:%M %p'))"""

TYPED_SQL = f"""
typed AS (
  SELECT {TIME_SQL} AS "timestamp",
         {_number('batch_time_mins')}, {_number('viscosity_cp')}, {_number('temperature_c')},
         {_number('ph_level')}, {_number('r1_mass')}, batch_id, source_file, line_no
  FROM raw)"""

SILVER_SQL = """
silver AS (
  SELECT "timestamp", batch_time_mins, viscosity_cp, temperature_c, ph_level, r1_mass, batch_id
  FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, "timestamp"
                                     ORDER BY source_file, line_no) AS rn
        FROM typed
        WHERE "timestamp" IS NOT NULL AND batch_time_mins > 0 AND ph_level > 0)
  WHERE rn = 1)"""

WIDE_SQL = """
wide0 AS (
  SELECT *,
    avg(temperature_c) OVER w5 AS temp_rolling_avg_5,
    avg(ph_level) OVER w5 AS ph_rolling_avg_5,
    avg(viscosity_cp) OVER w5 AS visc_rolling_avg_5,
    lag(temperature_c, 1) OVER w AS temp_lag_1,
    lag(viscosity_cp, 1) OVER w AS viscosity_lag_1,
    lag(viscosity_cp, 5) OVER w AS viscosity_lag_5,
    lag(viscosity_cp, 10) OVER w AS viscosity_lag_10,
    temperature_c - lag(temperature_c, 1) OVER w AS temp_rate_change,
    ph_level - lag(ph_level, 1) OVER w AS ph_rate_change,
    viscosity_cp - lag(viscosity_cp, 1) OVER w AS visc_rate_change,
    min(batch_time_mins) OVER (PARTITION BY batch_id) AS batch_start,
    max(batch_time_mins) OVER (PARTITION BY batch_id) AS batch_end,
    lead(viscosity_cp, 10) OVER w AS viscosity_target_10min
  FROM silver
  WINDOW w AS (PARTITION BY batch_id ORDER BY "timestamp"),
         w5 AS (PARTITION BY batch_id ORDER BY "timestamp" ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
wide AS (
  SELECT *, (batch_time_mins - batch_start) / nullif(batch_end - batch_start, 0) * 100
            AS batch_progress_pct
  FROM wide0)"""

COMPLETE_SQL = " AND ".join(f"{c} IS NOT NULL" for c in [*MODEL_INPUTS, TARGET])

GOLD_SQL = f"""
gold AS (SELECT * FROM wide WHERE {COMPLETE_SQL} AND {TARGET} > 0)"""


def split_sql(by: str = "row", seed: int = 42, train_frac: float = 0.8) -> str:
    key = "batch_id"
    if by == "row":
        key += """, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%f')"""
    text = f"concat_ws('|', '{seed}', {key})"
    number = f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"
    return f"CASE WHEN {number} < {int(train_frac * HASH_RANGE)} THEN 'train' ELSE 'test' END"


PREDICTIONS_SQL = f"""
labelled AS (SELECT *, {split_sql()} AS split FROM gold),
predictions AS (
  SELECT "timestamp", temperature_c, ph_level, viscosity_target_10min,
         viscosity_lag_1 AS prediction, batch_id
  FROM labelled WHERE split = 'test')"""


def recent_sql(n: int = LATEST_ROWS) -> str:
    return f"""
recent AS (
  SELECT *, abs(prediction - viscosity_target_10min) AS error
  FROM predictions ORDER BY "timestamp" DESC, batch_id DESC LIMIT {n})"""


_CHAIN = [
    ("raw", RAW_SQL),
    ("typed", TYPED_SQL),
    ("silver", SILVER_SQL),
    ("wide", WIDE_SQL),
    ("gold", GOLD_SQL),
    ("predictions", PREDICTIONS_SQL),
    ("recent", recent_sql()),
]


def sql_over(layer: str, body: str) -> str:
    """``body`` with the common table expressions up to ``layer`` in front."""
    names = [name for name, _ in _CHAIN]
    parts = [text for _, text in _CHAIN[: names.index(layer) + 1]]
    return "WITH " + ",".join(parts) + "\n" + body
