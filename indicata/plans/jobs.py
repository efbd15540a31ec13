"""One function per pipeline, from landed files to output tables.

Each job reads its landed inputs, builds the pipeline's plan and runs it
once: the result goes to a CSV directory (``out``) and/or a JDBC table
(``jdbc`` = dict of url, user, password, driver and optionally ``as_text``),
replaced on every run.  With both, the table is loaded from the CSV just
written, and the frame returned reads it too; without ``out`` the frame
returned is the plan.  Downloading the inputs and scheduling the jobs are left to the
caller.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.observed import RunCounts
from indicata.plans.pipelines import (cases_with_counts, country_indicators_from_long, deposit_tables,
                                      incidents_without_codes, monthly_index_with_daily_risk, price_index_change,
                                      region_scaled_series, region_table, series_average,
                                      INDICATOR_KEY, INDICATOR_YEAR, REGION_FACTORS)
from indicata.session import scratch_path
from indicata.sinks.files import as_text_table, write_csv
from indicata.sinks.jdbc import write_jdbc
from indicata.sources.archives import ZipCatalogue, archive_stems, member_table
from indicata.sources.csv import read_csv_text
from indicata.sources.json import read_json_records, read_json_series
from indicata.functions.tokens import split_quoted
from indicata.sources.preamble import PREAMBLE_LINES, folder_stems, indicator_values, preamble_lines, preamble_records

# The output table of each pipeline.
TABLES = {
    "indices": "indices",
    "parana": "indices_parana",
    "santafe": "indices_santafe",
    "cordoba": "indices_cordoba",
    "ipc": "promedio_ipc_mensual",
    "country_indicators": "banco_mundial_indicators",
    "covid": "covid_indicators",
    "crime": "crime_data",
    "rates": "plazo_fijo",
    "deposits": "deposito_30_dias",
    "series": "series_tiempo",
}


def _emit(df: DataFrame, out: str | None, jdbc: Mapping[str, str] | None, table: str) -> DataFrame:
    if out is not None:
        write_csv(df, out)
        if df.columns:  # what follows reads the landed result, the plan is not run again
            df = df.sparkSession.read.schema(df.schema).csv(out, header=True)
    if jdbc is not None and df.columns:
        # ``as_text`` stores every column as text, as tables loaded from the
        # CSV hand-off are; by default the typed result is written.
        data = as_text_table(df) if str(jdbc.get("as_text", "")).lower() in ("1", "true") else df
        write_jdbc(data, jdbc["url"], table, jdbc.get("user"), jdbc.get("password"), jdbc.get("driver"))
    return df


def indices_job(spark: SparkSession, monthly_json: str, yearly_json: str, risk_json: str,
                out: str | None = None, jdbc: Mapping[str, str] | None = None,
                multi_line: bool = True) -> DataFrame:
    """E1 from the three landed JSON series (arrays, or JSON Lines with
    ``multi_line=False``)."""
    monthly = read_json_series(spark, monthly_json, multi_line=multi_line)
    yearly = read_json_series(spark, yearly_json, multi_line=multi_line)
    risk = read_json_series(spark, risk_json, value_type="long", multi_line=multi_line)
    return _emit(monthly_index_with_daily_risk(monthly, yearly, risk), out, jdbc, TABLES["indices"])


def region_jobs(spark: SparkSession, indices: DataFrame | str, out_dir: str | None = None,
                jdbc: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """One table per region from E1's result (a DataFrame or its CSV)."""
    e1 = read_csv_text(spark, indices) if isinstance(indices, str) else indices
    scaled = region_scaled_series(e1)
    if out_dir is not None or jdbc is not None:
        # Up to six writes read the same small table (one row per region and
        # month): compute it once instead of once per write.
        path = scratch_path(spark, "region-scaled")
        scaled.write.parquet(path)
        scaled = spark.read.schema(scaled.schema).parquet(path)
    return {name: _emit(region_table(scaled, name), f"{out_dir}/{name}" if out_dir else None,
                        jdbc, TABLES[name])
            for name, _ in REGION_FACTORS}


def ipc_job(spark: SparkSession, csv_path: str, out: str | None = None,
            jdbc: Mapping[str, str] | None = None, encoding: str = "UTF-8",
            counts: RunCounts | None = None) -> DataFrame:
    """E3 from the ';' price-index CSV (``encoding`` e.g. 'ISO-8859-1')."""
    df = read_csv_text(spark, csv_path, sep=";", encoding=encoding)
    return _emit(price_index_change(df, counts=counts), out, jdbc, TABLES["ipc"])


def country_indicators_job(spark: SparkSession, path: str, from_archives: bool = False,
                           out: str | None = None, jdbc: Mapping[str, str] | None = None,
                           key: str = INDICATOR_KEY, year: str = INDICATOR_YEAR,
                           keep_empty: bool = False, counts: RunCounts | None = None) -> DataFrame:
    """E4 from a folder of indicator CSVs, or of zip archives whose 'API'
    member is the indicator file (named after its archive).  ``keep_empty``
    tokenises lines with CSV semantics instead of the source rule.  ``counts`` gets the copies of
    headers, the rows without a key and the values that are no numbers."""
    if from_archives:
        members = ZipCatalogue(spark, path, member_prefix="API", skip=PREAMBLE_LINES)
        stems = archive_stems(spark, path)
        lines = members.preamble_lines(keep_empty, (key, year))
    else:
        lines = preamble_lines(spark, path, PREAMBLE_LINES, keep_empty, (key, year))
        stems = folder_stems(spark, path)
    if counts is not None:
        lines = counts.watch(lines, header_copies=split_quoted("line", keep_empty) == F.col("header_raw"))
    long = indicator_values(preamble_records(lines, keep_empty), key, year)
    result = country_indicators_from_long(long, stems, key, year, counts)
    return _emit(result, out, jdbc, TABLES["country_indicators"])


def covid_job(spark: SparkSession, csv_path: str, out: str | None = None,
              jdbc: Mapping[str, str] | None = None, encoding: str = "UTF-8",
              counts: RunCounts | None = None) -> DataFrame:
    """E5 from the landed cases CSV."""
    df = read_csv_text(spark, csv_path, encoding=encoding)
    return _emit(cases_with_counts(df, counts=counts), out, jdbc, TABLES["covid"])


def crime_job(spark: SparkSession, csv_path: str, out: str | None = None,
              jdbc: Mapping[str, str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """E6 from the landed incidents CSV."""
    df = read_csv_text(spark, csv_path, encoding=encoding)
    return _emit(incidents_without_codes(df), out, jdbc, TABLES["crime"])


def deposit_jobs(spark: SparkSession, rates_json: str, deposits_json: str, out_dir: str | None = None,
                 jdbc: Mapping[str, str] | None = None,
                 multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """E7 from the two landed JSON record arrays (or JSON Lines)."""
    rates, deposits = deposit_tables(read_json_records(spark, rates_json, multi_line=multi_line),
                                     read_json_records(spark, deposits_json, multi_line=multi_line))
    return (_emit(rates, f"{out_dir}/rates" if out_dir else None, jdbc, TABLES["rates"]),
            _emit(deposits, f"{out_dir}/deposits" if out_dir else None, jdbc, TABLES["deposits"]))


def series_job(spark: SparkSession, path: str, from_archive: bool = False, out: str | None = None,
               jdbc: Mapping[str, str] | None = None, encoding: str = "UTF-8",
               counts: RunCounts | None = None) -> DataFrame:
    """E8 from the series dump: a CSV, or archives whose last member is it."""
    if from_archive:
        codec = "utf-8-sig" if encoding.upper().replace("_", "-") == "UTF-8" else encoding
        members = ZipCatalogue(spark, path, last_member=True, encoding=codec)
        dump = member_table(members.lines(), members.columns(), members.headers()).drop("archive", "member")
    else:
        dump = read_csv_text(spark, path, encoding=encoding)
    return _emit(series_average(dump, counts=counts), out, jdbc, TABLES["series"])
