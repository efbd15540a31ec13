"""The eight indicator pipelines, each ``DataFrame(s) -> DataFrame``.

Sources and sinks are separate (see :mod:`indicata.sources`,
:mod:`indicata.sinks`); each function builds one lazy plan and runs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.dates import format_day, parse_timestamp
from indicata.functions.numbers import (default_zero, parse_decimal_comma, scale_and_round_col,
                                        to_number)
from indicata.functions.observed import RunCounts, watch
from indicata.operators.aggregates import group_average, one_row_per_key, period_totals
from indicata.operators.filters import drop_all_null, keep_present, non_empty_key
from indicata.operators.joins import join_all_on_key, join_on_key, join_stems, join_year_month
from indicata.operators.ordering import sort_asc, sort_desc
from indicata.operators.projection import exclude, keep, rename
from indicata.operators.windows import period_change
from indicata.session import scratch_path
from indicata.sources.preamble import read_indicator_folder

# Fixed values of the pipelines.
REGION_FACTORS = (("parana", "0.1"), ("santafe", "0.2"), ("cordoba", "0.3"))
INCIDENT_CODE_COLUMNS = ("DR_NO", "Date Rptd", "Rpt Dist No", "Mocodes",
                         "Crm Cd 1", "Crm Cd 2", "Crm Cd 3", "Crm Cd 4", "Premis Cd")
DEPOSIT_PRESENTATION_COLUMNS = ("logo", "enlace")
SERIES_ID_COLUMNS = ("catalogo_id", "serie_id", "dataset_id", "distribucion_id")
SERIES_KEYS = ("serie_titulo", "serie_unidades", "serie_descripcion",
               "distribucion_descripcion", "dataset_responsable", "dataset_titulo")
CASE_COLUMNS = ("location", "date", "total_cases", "new_cases")
CASE_MEASURES = ("total_cases", "new_cases")
INDICATOR_KEY = "Country Name"
INDICATOR_YEAR = "2023"


def _as_timestamp(df: DataFrame, column: str) -> DataFrame:
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return df
    return df.withColumn(column, parse_timestamp(column))


# E1 ------------------------------------------------------------------------

def _month_rows(monthly: DataFrame, yearly: DataFrame) -> DataFrame:
    m = _as_timestamp(rename(monthly, {"fecha": "fecha_inflacion", "valor": "valor_mensual"}),
                      "fecha_inflacion")
    a = _as_timestamp(rename(yearly, {"fecha": "fecha_inflacion", "valor": "valor_anual"}),
                      "fecha_inflacion")
    return join_on_key(m, a, "fecha_inflacion")


def _daily_rows(daily_risk: DataFrame) -> DataFrame:
    return _as_timestamp(rename(daily_risk, {"fecha": "fecha_riesgo", "valor": "valor_riesgo"}), "fecha_riesgo")


def monthly_index(monthly: DataFrame, yearly: DataFrame, daily_risk: DataFrame) -> DataFrame:
    """The months of E1's result, one row each: what E2 scales, without the
    fan-out to days and the sort (fecha_inflacion, valor_mensual, valor_anual)."""
    months = join_year_month(_month_rows(monthly, yearly), "fecha_inflacion", _daily_rows(daily_risk),
                             "fecha_riesgo", how="left_semi")
    return months.select(format_day("fecha_inflacion").alias("fecha_inflacion"), "valor_mensual", "valor_anual")


def monthly_index_with_daily_risk(monthly: DataFrame, yearly: DataFrame, daily_risk: DataFrame) -> DataFrame:
    """Monthly and year-on-year index joined with every daily risk value of
    the same month, newest month first, dates as 'yyyy-MM-dd' (E1).

    Inputs are (fecha, valor) series.  Output: fecha_inflacion,
    valor_mensual, valor_anual, fecha_riesgo, valor_riesgo.
    """
    joined = join_year_month(_month_rows(monthly, yearly), "fecha_inflacion", _daily_rows(daily_risk),
                             "fecha_riesgo")
    return (sort_desc(joined, "fecha_inflacion", "fecha_riesgo")
            .select(format_day("fecha_inflacion").alias("fecha_inflacion"),
                    "valor_mensual", "valor_anual",
                    format_day("fecha_riesgo").alias("fecha_riesgo"), "valor_riesgo"))


# E2 ------------------------------------------------------------------------

def region_scaled_series(indices: DataFrame,
                         factors: Sequence[tuple[str, str]] = REGION_FACTORS) -> DataFrame:
    """E1's result scaled by a factor per region, one row per region and
    month (E2).

    One job for all regions: rows are first reduced to one per month (the
    scaled columns depend on the month only), then each month row is fanned
    out to the regions by exploding a literal array -- a generator, not a
    join.  Output: region, fecha_inflacion, valor_mensual, valor_anual.
    """
    per_month = one_row_per_key(
        exclude(indices, ["fecha_riesgo", "valor_riesgo"]), ["fecha_inflacion"])
    table = F.array(*[F.struct(F.lit(name).alias("region"), F.lit(f).alias("factor"))
                      for name, f in factors])
    fanned = per_month.select("*", F.inline(table))
    return fanned.select(
        "region", "fecha_inflacion",
        scale_and_round_col(to_number("valor_mensual"), "factor").alias("valor_mensual"),
        scale_and_round_col(to_number("valor_anual"), "factor").alias("valor_anual"),
    )


def region_table(scaled: DataFrame, region: str) -> DataFrame:
    """One region's table, as the per-region tasks produced it."""
    return scaled.filter(F.col("region") == region).drop("region")


# E3 ------------------------------------------------------------------------

def price_index_change(df: DataFrame, period: str = "Periodo", index: str = "Indice_IPC",
                       monthly: str = "v_m_IPC", yearly: str = "v_i_a_IPC",
                       parse_text: bool = True, value_type: str = "float",
                       partition_by: Sequence[str] | None = None,
                       partial_counts: tuple[str, str] | None = None,
                       counts: RunCounts | None = None) -> DataFrame:
    """Per-period index total, average monthly and yearly change, and the
    percent change of the total against the previous period (E3).

    Text measures with a decimal comma are parsed (unreadable -> null).  The
    first period (and a zero base) has no change and is removed.  Newest
    period first.  With ``partition_by`` one series per key.
    ``partial_counts`` = (monthly count, yearly count) columns when the rows
    are already partial sums on a finer key (see ``period_totals``).
    ``counts`` gets the texts that are no numbers.
    """
    keys = list(partition_by or [])
    count_cols = list(partial_counts or [])
    df = keep(df, *keys, period, index, monthly, yearly, *count_cols)
    if parse_text:
        df = watch(counts, df, **{f"unreadable_{c}": F.nullif(F.col(c), F.lit("")).isNotNull()
                                  & parse_decimal_comma(c, value_type).isNull() for c in (index, monthly, yearly)})
        df = df.withColumns({c: parse_decimal_comma(c, value_type) for c in (index, monthly, yearly)})
    value_counts = dict(zip(("avg_ipc_mensual", "avg_ipc_interanual"), count_cols))
    totals = period_totals(df, [*keys, period], (index, "indice_ipc"),
                           {"avg_ipc_mensual": monthly, "avg_ipc_interanual": yearly}, counts=value_counts)
    changed = period_change(totals, "indice_ipc", period, "ipc_anterior", "variacion_mensual",
                            partition_by=keys or None)
    out = keep_present(changed, "variacion_mensual").select(
        *keys, period, "avg_ipc_mensual", "variacion_mensual", "avg_ipc_interanual")
    return sort_desc(out, period, *keys)


# E4 ------------------------------------------------------------------------

def indicator_frames(long: DataFrame, stems: Sequence[str], key: str = INDICATOR_KEY,
                     year: str = INDICATOR_YEAR) -> list[DataFrame]:
    """One (key, '<stem> <year>') frame per indicator of a long table.

    Value text -> float (unreadable -> null -> 0); rows with an empty key go.
    """
    frames = []
    for stem in stems:
        one = long.filter(F.col("stem") == stem).select(
            key, default_zero(to_number(year, "float")).alias(f"{stem} {year}"))
        frames.append(non_empty_key(one, key))
    return frames


def country_indicators(frames: Sequence[DataFrame], key: str = INDICATOR_KEY) -> DataFrame:
    """Indicators joined on the country name (inner), sorted by it."""
    return sort_asc(join_all_on_key(frames, key), key)


def country_indicators_from_long(long: DataFrame, stems: Sequence[str], key: str = INDICATOR_KEY,
                                 year: str = INDICATOR_YEAR, counts: RunCounts | None = None) -> DataFrame:
    """E4 from a long (stem, key, value text) table.

    The long table is written to the shared folder once, so the source files are read
    and parsed once, and joined by one grouped pass over it (``join_stems``).
    ``counts`` gets the rows without a key and the values read as 0.
    """
    path = scratch_path(long.sparkSession, "indicators-long")
    named = non_empty_key(watch(counts, long.select("stem", key, year), no_key=~F.coalesce(
        F.col(f"`{key}`") != "", F.lit(False))), key)
    number = to_number(year, "float")
    named = watch(counts, named, unreadable=F.nullif(F.col(f"`{year}`"), F.lit("")).isNotNull() & number.isNull())
    named.select("stem", key, default_zero(number).alias("_value")).write.parquet(path)
    shared = long.sparkSession.read.parquet(path)
    # An indicator with no records would empty the inner join; fail instead
    # (one row per indicator comes back to the driver).
    present = {r["stem"] for r in shared.select("stem").distinct().collect()}
    missing = [st for st in stems if st not in present]
    if missing:
        raise ValueError(f"indicator files without records (no header or data line): {missing}")
    return sort_asc(join_stems(shared, stems, key, "_value", [f"{st} {year}" for st in stems]), key)


def country_indicators_from_folder(spark: SparkSession, path: str, stems: Sequence[str],
                                   key: str = INDICATOR_KEY, year: str = INDICATOR_YEAR) -> DataFrame:
    """E4 end to end from a folder of preamble-headed indicator files."""
    return country_indicators_from_long(read_indicator_folder(spark, path, key, year), stems, key, year)


# E5 ------------------------------------------------------------------------

def cases_with_counts(df: DataFrame, columns: Sequence[str] = CASE_COLUMNS,
                      measures: Sequence[str] = CASE_MEASURES, date: str = "date",
                      counts: RunCounts | None = None) -> DataFrame:
    """Case counts by place and date, rows with no count removed, newest
    first (E5).

    Rows of one date follow in the order of the other columns: the order is
    repeatable, and the range-partitioned sort can split a date that holds
    a large share of the rows over several tasks.  With ``counts`` (the rows without any
    count) the rows kept are written before they are sorted, as a sort reads its input twice.
    """
    missing = F.lit(True)
    for m in measures:
        missing = missing & F.col(m).isNull()
    kept = drop_all_null(watch(counts, keep(df, *columns), no_measure=missing), measures)
    if counts is not None:
        path = scratch_path(df.sparkSession, "cases")
        kept.write.parquet(path)
        kept = df.sparkSession.read.schema(kept.schema).parquet(path)
    return sort_desc(kept, date, *[c for c in columns if c != date])


# E6 ------------------------------------------------------------------------

def incidents_without_codes(df: DataFrame,
                            codes: Sequence[str] = INCIDENT_CODE_COLUMNS) -> DataFrame:
    """Incident table without the code columns."""
    return exclude(df, codes)


# E7 ------------------------------------------------------------------------

def deposit_tables(rates: DataFrame, deposits_30_days: DataFrame,
                   presentation: Sequence[str] = DEPOSIT_PRESENTATION_COLUMNS
                   ) -> tuple[DataFrame, DataFrame]:
    """Bank rates without presentation columns, and the 30-day deposit
    series passed through (E7)."""
    return exclude(rates, presentation), deposits_30_days


# E8 ------------------------------------------------------------------------

def series_average(df: DataFrame, keys: Sequence[str] = SERIES_KEYS, value: str = "valor",
                   ids: Sequence[str] = SERIES_ID_COLUMNS, counts: RunCounts | None = None) -> DataFrame:
    """Average value per series over its descriptive keys (E8); ``counts`` gets the values that are
    no numbers."""
    df = watch(counts, df, unreadable=F.nullif(F.col(value).cast("string"), F.lit("")).isNotNull()
               & to_number(value, "double").isNull())
    return group_average(exclude(df, ids), list(keys), value, "promedio_x_serie")
