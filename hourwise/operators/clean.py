"""Cleaning and data-quality operators (DataFrame -> DataFrame; the medians write their value counts)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import canonical_text, rain_fault, temp_fault
from ..sources.io import materialize
from .prefix import quantiles_of_counts

CATEGORICAL_COLUMNS = ("weather_main", "weather_description", "holiday")
DEFAULT_KEYS = ("sensor", "date_time")


def standardize_categoricals(df: DataFrame, cols: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """trim + lower; NULL stays NULL."""
    return df.withColumns({c: canonical_text(c) for c in cols})


def category_collapse_report(df: DataFrame, cols: Sequence[str] = CATEGORICAL_COLUMNS) -> DataFrame:
    """Per column: distinct spellings before and after trim+lower, and rows whose
    spelling is not the most frequent spelling of their canonical value.

    One scan: the columns are stacked into (column, spelling) pairs and counted
    with a partial aggregate; everything after that is over distinct spellings.
    """
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    spell = (df.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, spelling)")
             .filter(F.col("spelling").isNotNull())
             .groupBy("column_name", "spelling").agg(F.count(F.lit(1)).alias("n")))
    per_canon = (spell.withColumn("canonical", canonical_text("spelling"))
                 .groupBy("column_name", "canonical")
                 .agg(F.count(F.lit(1)).alias("n_spellings"), F.sum("n").alias("n_rows"),
                      F.max("n").alias("n_modal")))
    return (per_canon.groupBy("column_name")
            .agg(F.sum("n_spellings").cast("bigint").alias("n_before"),
                 F.count(F.lit(1)).alias("n_after"),
                 F.sum(F.col("n_rows") - F.col("n_modal")).cast("bigint").alias("n_changed")))


def parse_datetime(df: DataFrame, col: str = "date_time", fmt: str | None = None) -> DataFrame:
    """Strings become TIMESTAMP_NTZ (bad text → NULL, no ANSI error); typed columns pass."""
    if dict(df.dtypes)[col] == "string":
        parsed = F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))
        return df.withColumn(col, parsed.cast("timestamp_ntz"))
    return df


def parse_datetime_or_drop(df: DataFrame, col: str = "date_time", fmt: str | None = None) -> DataFrame:
    return parse_datetime(df, col, fmt).filter(F.col(col).isNotNull())


def dedupe_min_rowid(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                     order_col: str = "row_id") -> DataFrame:
    """One row per key: the row with the smallest ``order_col`` (unique per row).

    The smallest order value of each key is a hash aggregate of plain columns
    (partial in every task, so a hot key costs one row a task); a hash semi-join
    on (key, order value) then picks the rows. Raw rows are never sorted.
    """
    keys = list(keys)
    least = (df.groupBy(*keys).agg(F.min(order_col).alias("_least"))
             .select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_least"))
    same = F.col(order_col) == F.col("_least")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return df.join(least.hint("shuffle_hash"), same, "left_semi")


def dedupe_keep_first(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                      tie_break: str = "row_id") -> DataFrame:
    """'Sort by time, keep first' needs a named tie-break to be deterministic;
    with the file order carried in ``tie_break`` it is ``dedupe_min_rowid``."""
    return dedupe_min_rowid(df, keys, tie_break)


def flag_outliers(df: DataFrame, temp: str = "temp", rain: str = "rain_1h") -> DataFrame:
    return df.withColumns({"temp_fault": temp_fault(temp).cast("int"),
                           "rain_fault": rain_fault(rain).cast("int")})


def impute_by_group_median(df: DataFrame, column: str, fault: Column,
                           group: Column | None = None, group_name: str = "_grp") -> DataFrame:
    """Replace faulty values by the median of the non-faulty rows of the same
    group (default: calendar month of ``date_time`` over all years); a group
    without a clean row falls back to the overall clean median. NULL values are neither faults nor part of a median.
    """
    group = F.month("date_time") if group is None else group
    return _impute(df, {column: fault}, group, group_name)


def impute_outliers(df: DataFrame, temp: str = "temp", rain: str = "rain_1h") -> DataFrame:
    """Temperature and rain faults replaced by month medians (overall clean
    median when a month has none), all medians from one table of value counts, so
    the input is scanned twice (rows + counts) however many columns are repaired. Rain
    medians do not depend on the temperature repair, so doing both at once
    equals the reference's temperature-then-rain order."""
    return impute_by_month_medians(df, {temp: temp_fault(temp), rain: rain_fault(rain)})


def impute_by_month_medians(df: DataFrame, rules: dict[str, Column], ts: str = "date_time") -> DataFrame:
    return _impute(df, rules, F.month(ts), "_month")


def _impute(df: DataFrame, rules: dict[str, Column], group: Column, group_name: str) -> DataFrame:
    """Each column's faults by its group's median, else its overall one. The clean values of all columns
    are counted once per (column, group, value); exact medians come from the running totals of the counts, and
    the table of medians (a row a group) is joined back."""
    grouped = df.withColumn(group_name, group)
    pairs = ", ".join(f"'{c}', `_ok_{c}`" for c in rules)
    clean = grouped.select(group_name, *[F.when(~fault, F.col(c).cast("double")).alias(f"_ok_{c}") for c, fault in rules.items()])
    counts = materialize(
        clean.selectExpr(f"`{group_name}`", f"stack({len(rules)}, {pairs}) AS (_column, _v)").filter("_v IS NOT NULL")
        .groupBy("_column", group_name, "_v").agg(F.count(F.lit(1)).alias("_n")), "clean-counts")
    own = quantiles_of_counts(counts, (0.5,), ["_own"], ["_column", group_name])
    every = counts.groupBy("_column", "_v").agg(F.sum("_n").alias("_n"))
    overall = quantiles_of_counts(every, (0.5,), ["_overall"], ["_column"])
    pick = lambda table, c, name: F.max(F.when(F.col("_column") == c, F.col(table))).alias(f"{name}_{c}")
    by_group = own.groupBy(F.col(group_name).alias("_g")).agg(*[pick("_own", c, "_med") for c in rules])
    whole = overall.agg(*[pick("_overall", c, "_all") for c in rules])                         # one row
    joined = (grouped.join(by_group, F.col(group_name).eqNullSafe(F.col("_g")), "left").crossJoin(F.broadcast(whole)))
    fixed = {c: F.when(fault, F.coalesce(f"_med_{c}", f"_all_{c}")).otherwise(F.col(c)) for c, fault in rules.items()}
    return joined.withColumns(fixed).select(*df.columns)


def range_check_report(df: DataFrame) -> DataFrame:
    """Suspect values that are reported, not corrected."""
    return df.agg(
        F.count_if(F.col("rain_1h") < 0).alias("n_negative_rain"),
        F.count_if(F.col("snow_1h") < 0).alias("n_negative_snow"),
        F.count_if((F.col("clouds_all") < 0) | (F.col("clouds_all") > 100)).alias("n_clouds_out_of_range"),
    )


def clean_readings(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """standardize → parse (drop bad times) → dedupe → impute temp → impute rain."""
    return (df.transform(standardize_categoricals)
              .transform(parse_datetime_or_drop)
              .transform(lambda d: dedupe_min_rowid(d, keys))
              .transform(impute_outliers))


def dq_metrics(raw: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """The per-stage counts of the cleaning log as a long (stage, metric, value)
    table: two one-row aggregates, cross-joined and unpivoted."""
    parsed = parse_datetime(standardize_categoricals(raw))
    a = parsed.agg(F.count(F.lit(1)).alias("raw_rows"),
                   F.count_if(F.col("date_time").isNull()).alias("unparseable_dates"))
    hourly = dedupe_min_rowid(parsed.filter(F.col("date_time").isNotNull()), keys)
    b = hourly.agg(F.count(F.lit(1)).alias("hourly_rows"),
                   F.count_if(temp_fault("temp")).alias("temp_faults"),
                   F.count_if(rain_fault("rain_1h")).alias("rain_faults"),
                   F.count_if((F.col("rain_1h") < 0) | (F.col("snow_1h") < 0)).alias("negative_rain_snow"),
                   F.count_if((F.col("clouds_all") < 0) | (F.col("clouds_all") > 100))
                   .alias("clouds_out_of_range"))
    wide = a.crossJoin(F.broadcast(b)).withColumn(
        "duplicates_removed", F.col("raw_rows") - F.col("unparseable_dates") - F.col("hourly_rows"))
    stages = [("load", "raw_rows"), ("parse", "unparseable_dates"), ("dedupe", "duplicates_removed"),
              ("dedupe", "hourly_rows"), ("outliers", "temp_faults"), ("outliers", "rain_faults"),
              ("range_check", "negative_rain_snow"), ("range_check", "clouds_out_of_range")]
    expr = ", ".join(f"'{s}', '{m}', CAST(`{m}` AS BIGINT)" for s, m in stages)
    return wide.selectExpr(f"stack({len(stages)}, {expr}) AS (stage, metric, value)")
