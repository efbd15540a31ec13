"""Queries over the driver tables, one per operator group of the inventory.

Each query derives the input shape of a pipeline from the given tables
(landing files in the shared folder where the operator under test is a
file reader), runs the library's pipeline on it, and returns the lazy
result.  All queries read whole tables.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions.dates import format_day, format_month, parse_timestamp
from indicata.functions.numbers import parse_decimal_comma, percent_change, round_half_up, truncate_to_long
from indicata.functions.observed import RunCounts
from indicata.functions.tokens import clean_tokens, split_quoted
from indicata.operators.skew import join_spread
from indicata.operators.windows import previous_row
from indicata.plans import landing
from indicata.plans.jobs import (country_indicators_job, covid_job, crime_job, deposit_jobs,
                                 indices_job, region_jobs, series_job)
from indicata.plans.partials import merged_average, refresh
from indicata.plans.pipelines import (INDICATOR_KEY, INDICATOR_YEAR, REGION_FACTORS, cases_with_counts, country_indicators_from_folder,
                                      country_indicators_from_long, deposit_tables, incidents_without_codes,
                                      indicator_frames, monthly_index, monthly_index_with_daily_risk,
                                      price_index_change, region_scaled_series, series_average)
from indicata.session import scratch_path
from indicata.sinks.files import csv_roundtrip, write_csv
from indicata.sinks.preview import first_n
from indicata.sources.archives import ZipCatalogue, member_table
from indicata.sources.csv import read_csv_text, read_csv_typed
from indicata.sources.faults import fault_report, set_aside
from indicata.sources.json import json_records_checked, read_json_records, read_json_series
from indicata.sources.memory import rows_to_frame
from indicata.sources.preamble import folder_stems, read_indicator_folder

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- E3: aggregate + window ---------------------------------------------------

def _orders_price_index(orders: DataFrame) -> DataFrame:
    price = F.col("o_totalprice").cast(MONEY)
    return orders.select(
        format_month("o_orderdate").alias("Periodo"),
        price.alias("Indice_IPC"),
        (price * F.lit(Decimal("0.01"))).alias("v_m_IPC"),
        (F.col("o_custkey") % 100).cast(MONEY).alias("v_i_a_IPC"),
        "o_custkey",
    )


def period_over_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _orders_price_index(table(spark, sf_dir, "orders"))
    return price_index_change(src, parse_text=False)


def period_over_period_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 with one series per market segment.

    Orders are reduced to partial sums and counts per (customer, period)
    before the customer join: a customer holding a large share of the
    orders collapses map-side to at most one row per period, so the join
    sees no skew; the segment averages are rebuilt exactly from the partials.
    """
    orders = _orders_price_index(table(spark, sf_dir, "orders"))
    per_cust = orders.groupBy("o_custkey", "Periodo").agg(
        F.sum("Indice_IPC").alias("Indice_IPC"),
        F.sum("v_m_IPC").alias("v_m_IPC"), F.count("v_m_IPC").alias("n_m"),
        F.sum("v_i_a_IPC").alias("v_i_a_IPC"), F.count("v_i_a_IPC").alias("n_ia"))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    src = per_cust.join(cust, "o_custkey")
    return price_index_change(src, parse_text=False, partition_by=["c_mktsegment"],
                              partial_counts=("n_m", "n_ia"))


def period_over_period_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 end to end: orders landed as the ';' price-index CSV with decimal
    commas (unreadable '///' for pending orders), parsed to float as text
    measures are, then aggregated."""
    o = table(spark, sf_dir, "orders")
    comma = lambda c: F.translate(c.cast("string"), ".", ",")
    src = o.select(
        format_month("o_orderdate").alias("Periodo"),
        F.when(F.col("o_orderstatus") == "P", F.lit("///"))
        .otherwise(comma(F.col("o_totalprice"))).alias("Indice_IPC"),
        comma(F.col("o_totalprice") / 1000).alias("v_m_IPC"),
        comma((F.col("o_custkey") % 100).cast("double")).alias("v_i_a_IPC"),
        F.col("o_orderpriority").alias("Region"),
    )
    path = landing.land_csv(spark, src, "price-index", sep=";")
    return price_index_change(read_csv_text(spark, path, sep=";"))


def previous_row_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's value next to the one before it, over one ordering of all events, and the
    change in percent: ranges of the ordering, no single task."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", F.col("value").cast(MONEY).alias("valor"))
    before = previous_row(ev, "valor", ["ts", "event_id"], "valor_anterior")
    return before.select("event_id", F.col("valor").cast("double").alias("valor"),
                         F.col("valor_anterior").cast("double").alias("valor_anterior"),
                         percent_change("valor", "valor_anterior").alias("variacion"))


# --- E1 / E2: key join, year-month join, per-region scaling ---------------------

def _index_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    price = F.col("o_totalprice").cast(MONEY)
    # One pass over orders: exact per-day sum and count (decimal), from which
    # both the daily series and the monthly roll-up are derived.  The join
    # filters Catalyst infers differ between the two uses, so the plans would
    # not share a scan; the per-day table (one row per calendar day) is
    # written to the shared folder once instead.
    daily_stats = (orders.groupBy(F.date_trunc("day", "o_orderdate").alias("fecha"))
                   .agg(F.sum(price).alias("s"), F.count(price).alias("n")))
    path = scratch_path(spark, "orders-per-day")
    daily_stats.write.parquet(path)
    daily_stats = spark.read.schema(daily_stats.schema).parquet(path)
    daily = daily_stats.select("fecha", truncate_to_long(F.col("s") / F.col("n")).alias("valor"))
    monthly = (daily_stats.groupBy(F.date_trunc("month", "fecha").alias("fecha"))
               .agg(round_half_up(F.sum("s") / F.sum("n") / F.lit(1000)).alias("valor")))
    yearly = (lineitem.groupBy(F.date_trunc("month", "l_shipdate").alias("fecha"))
              .agg(round_half_up(F.avg("l_quantity")).alias("valor")))
    return monthly, yearly, daily


def monthly_daily_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_index_with_daily_risk(*_index_series(spark, sf_dir))


def indices_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 end to end through files: the three series landed as JSON
    (fecha text, valor number) and run by the E1 job."""
    paths = []
    for name, series in zip(("monthly", "yearly", "risk"), _index_series(spark, sf_dir)):
        line = F.to_json(F.struct(format_day("fecha").alias("fecha"), F.col("valor")))
        paths.append(landing.land_lines(spark, series.select(line.alias("line")), f"series-{name}"))
    return indices_job(spark, *paths, multi_line=False)


def region_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region_scaled_series(monthly_index(*_index_series(spark, sf_dir)))


def region_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2's three tables, landed by the region job from E1's landed CSV, with
    each region's factor from an in-memory lookup table."""
    e1 = landing.land_csv(spark, monthly_daily_join(spark, sf_dir), "indices-csv")
    tables = region_jobs(spark, e1, out_dir=scratch_path(spark, "regions"))
    factors = rows_to_frame(spark, REGION_FACTORS, "region string, factor string")
    out = None
    for name, table_ in tables.items():
        one = table_.select(F.lit(name).alias("region"), *table_.columns)
        out = one if out is None else out.unionByName(one)
    return out.join(factors, "region")


# --- E4: per-nation indicators ----------------------------------------------------

INDICATOR_STEMS = ("customer", "orders", "supplier")


def _nation_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table (stem, Country Name, Country Code, 2023 as text)."""
    nation = table(spark, sf_dir, "nation")
    names = nation.select("n_nationkey", "n_name", "n_regionkey")
    cust = table(spark, sf_dir, "customer")
    supp = table(spark, sf_dir, "supplier")
    orders = table(spark, sf_dir, "orders")
    c = (cust.groupBy(F.col("c_nationkey").alias("n_nationkey"))
         .agg(F.sum(F.col("c_acctbal").cast(MONEY)).alias("v")))
    s = (supp.groupBy(F.col("s_nationkey").alias("n_nationkey"))
         .agg(F.sum(F.col("s_acctbal").cast(MONEY)).alias("v")))
    # Orders are summed per customer before the join: a customer holding a
    # large share of the orders is collapsed by the map-side partial
    # aggregate instead of skewing the join.
    per_cust = orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("v"))
    o = (per_cust.join(cust.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
         .groupBy(F.col("c_nationkey").alias("n_nationkey"))
         .agg(F.sum("v").alias("v")))

    def shape(df: DataFrame, stem: str) -> DataFrame:
        j = df.join(names, "n_nationkey")
        key = F.col("n_name")
        value = F.col("v").cast("string")
        if stem == "orders":  # one nation with an empty name: removed by the key filter
            key = F.when(F.col("n_nationkey") == 0, F.lit("")).otherwise(key)
        if stem == "supplier":  # one region's values missing: read as 0
            value = F.when(F.col("n_regionkey") == 1, F.lit("")).otherwise(value)
        return j.select(F.lit(stem).alias("stem"), key.alias("Country Name"),
                        F.format_string("N%02d", "n_nationkey").alias("Country Code"),
                        value.alias("2023"))

    out = shape(c, "customer")
    for stem, df in (("orders", o), ("supplier", s)):
        out = out.unionByName(shape(df, stem))
    return out


def nway_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_indicators_from_long(_nation_indicators(spark, sf_dir), INDICATOR_STEMS)


WIDE_STEMS = 50


def nway_key_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty indicators per order priority joined in one grouped pass; the first two have a
    value per order status, so their keys repeat."""
    orders = table(spark, sf_dir, "orders").where("o_totalprice is not null")
    which = F.pmod("o_orderkey", F.lit(WIDE_STEMS))
    stem = F.format_string("s%02d", which.cast("int"))
    long = orders.groupBy(stem.alias("stem"), F.col("o_orderpriority").alias(INDICATOR_KEY),
                          F.when(which < 2, F.col("o_orderstatus")).alias("status")).agg(
        F.max(F.col("o_totalprice").cast(MONEY)).cast("string").alias(INDICATOR_YEAR))
    return country_indicators_from_long(long.drop("status"), [f"s{i:02d}" for i in range(WIDE_STEMS)])


def dropped_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the E4 job drops or reads as 0, counted in the run that writes its table: orders as
    indicator files, some without a name, some values no numbers, one file with its header twice."""
    orders = table(spark, sf_dir, "orders")
    files = max(2, orders.count() // LARGE_FILE_ROWS)
    key = F.col("o_orderkey")
    long = orders.select(
        F.concat(F.lit("orders_"), F.pmod(key, F.lit(files)).cast("string")).alias("stem"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(key.cast("string")).alias(INDICATOR_KEY),
        F.lit("x").alias("Country Code"),
        F.when(F.pmod(key, F.lit(7)) == 0, F.lit("n/a")).when(F.pmod(key, F.lit(11)) == 0, F.lit(""))
        .otherwise(F.col("o_totalprice").cast("string")).alias(INDICATOR_YEAR))
    path = landing.land_preamble_folder(spark, long, INDICATOR_KEY, INDICATOR_YEAR, "orders-preamble", INDICATOR_PREAMBLE,
                                        code="Country Code", repeat_header_for="orders_0")
    counts = RunCounts()
    country_indicators_job(spark, path, counts=counts)
    return rows_to_frame(spark, sorted(counts.get().items()), "metric string, n bigint")


# The preamble lines of the indicator files.
INDICATOR_PREAMBLE = ['"Data Source","Indicator catalogue",',
                      "",
                      '"Last Updated Date","2024-10-24",',
                      ""]


def _landed_indicator_folder(spark: SparkSession, sf_dir: str) -> str:
    return landing.land_preamble_folder(
        spark, _nation_indicators(spark, sf_dir), "Country Name", "2023", "indicators",
        INDICATOR_PREAMBLE, code="Country Code", repeat_header_for="customer")


def preamble_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_indicator_folder(spark, sf_dir)
    return read_indicator_folder(spark, path, "Country Name", "2023")


def folder_scan_file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_indicator_folder(spark, sf_dir)
    return country_indicators_from_folder(spark, path, folder_stems(spark, path))


LARGE_FILE_ROWS, LARGE_SPLIT_BYTES = 20_000, 64 * 1024


def preamble_lines_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as preamble-headed files of about ``LARGE_FILE_ROWS`` records, read
    in ranges far smaller than a file; more files as the table grows."""
    ev = table(spark, sf_dir, "events")
    files = max(2, ev.count() // LARGE_FILE_ROWS)
    long = ev.select(
        F.concat(F.lit("events_"), F.pmod("event_id", F.lit(files)).cast("string")).alias("stem"),
        F.concat_ws(", ", "event_type", F.col("event_id").cast("string")).alias("Country Name"),
        F.col("user_id").cast("string").alias("Country Code"),
        F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise(F.lit("")).alias("2023"))
    path = landing.land_preamble_folder(spark, long, "Country Name", "2023", "events-preamble", INDICATOR_PREAMBLE,
                                        code="Country Code", repeat_header_for="events_0")
    return read_indicator_folder(spark, path, "Country Name", "2023", split_bytes=LARGE_SPLIT_BYTES)


def indicators_from_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 end to end from zip archives, one per indicator, via the E4 job."""
    path = landing.land_indicator_archives(
        spark, _nation_indicators(spark, sf_dir), "Country Name", "2023", "indicator-zips",
        INDICATOR_PREAMBLE, code="Country Code", repeat_header_for="customer")
    return country_indicators_job(spark, path, from_archives=True)


def year_value_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    long = ev.select(
        F.lit("events").alias("stem"),
        F.when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.concat_ws("-", "event_type", F.col("event_id").cast("string"))).alias("Country Name"),
        F.when(F.col("event_type") == "error", F.lit(""))
        .otherwise(F.col("value").cast("string")).alias("2023"),
    )
    return indicator_frames(long, ["events"])[0]


# --- E8: grouped average over six keys ---------------------------------------------

def series_average_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8's average over six keys, four of which come from part and supplier.

    Pruned line items are joined to the two dimensions, which AQE broadcasts
    while they are small (a hot part or supplier is dealt over salts), and averaged
    with one partial aggregate on the six keys.  Some flags are null and some values unreadable.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"), "l_linestatus",
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string")).alias("valor"))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size")
    supp = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    # Beyond the broadcast size a part or supplier with much of the rows is found first and its rows are dealt out.
    dump = join_spread(join_spread(li, part, "l_partkey"), supp, "l_suppkey").select(
        F.col("l_partkey").cast("string").alias("dataset_id"),
        F.col("l_suppkey").cast("string").alias("distribucion_id"),
        F.col("p_type").alias("serie_titulo"),
        F.col("p_brand").alias("serie_unidades"),
        F.col("p_size").cast("string").alias("serie_descripcion"),
        F.col("l_returnflag").alias("distribucion_descripcion"),
        F.col("s_nationkey").cast("string").alias("dataset_responsable"),
        F.col("l_linestatus").alias("dataset_titulo"), "valor")
    return series_average(dump)


MERGED_FILES = 16


def series_average_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average value per six keys over line items landed as CSV files in two batches, each added
    to the partial totals of the files before; the second lands one file of the first again."""
    keys = ["l_returnflag", "l_linestatus", "l_linenumber", "l_tax", "l_discount", "l_suppkey"]
    li = table(spark, sf_dir, "lineitem").select(
        F.pmod(F.xxhash64("l_orderkey"), F.lit(MERGED_FILES)).alias("stem"), *keys,
        F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string")).alias("valor"))
    first = F.col("stem") < MERGED_FILES // 2
    state = scratch_path(spark, "series-partials")
    read = lambda paths: read_csv_text(spark, paths)
    path = landing.land_stem_files(spark, li.where(first), "stem", "series-files")
    refresh(spark, path, state, read, keys, "valor")
    landing.land_stem_files(spark, li.where(~first | (F.col("stem") == 0)), "stem", "", path=path)
    refresh(spark, path, state, read, keys, "valor")
    return merged_average(spark, state, keys, "promedio_x_serie")


def series_from_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8 end to end through files: the series dump (line items with their
    part and supplier attributes, value as text) landed as CSV inside zip
    archives, read back from each archive's last member by the E8 job."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size")
    supp = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    dump = li.join(part, "l_partkey").join(supp, "l_suppkey").select(
        F.col("l_orderkey").alias("catalogo_id"), F.col("l_linenumber").alias("serie_id"),
        F.col("l_partkey").alias("dataset_id"), F.col("l_suppkey").alias("distribucion_id"),
        F.col("p_type").alias("serie_titulo"), F.col("p_brand").alias("serie_unidades"),
        F.col("p_size").alias("serie_descripcion"), F.col("l_returnflag").alias("distribucion_descripcion"),
        F.col("s_nationkey").alias("dataset_responsable"), F.col("l_linestatus").alias("dataset_titulo"),
        F.col("l_extendedprice").alias("valor"))
    path = landing.land_zip_archives(spark, dump, "series-zip", member_prefix="series_tiempo",
                                     extra_member="Leeme")
    return series_job(spark, path, from_archive=True)


# --- E5 / E6 / K4: filter, exclusion, first-n -----------------------------------------

def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("location"),
        format_day("ts").alias("date"),
        F.when(~F.col("event_type").isin("error", "view"), F.col("value")).alias("total_cases"),
        F.when(~F.col("event_type").isin("error", "signup"), F.col("value")).alias("new_cases"),
        F.col("event_id").alias("iso_code"),
    )


def filter_any_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases_with_counts(_cases(spark, sf_dir))


def cases_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 end to end: the cases table landed as header CSV, run by the E5 job
    (columns stay text, as the CSV is read)."""
    path = landing.land_csv(spark, _cases(spark, sf_dir), "cases-csv")
    return covid_job(spark, path)


def incidents_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 end to end: line items landed as an incident CSV whose columns
    include six of the nine code columns, run by the E6 job."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("DR_NO"), F.col("l_shipdate").alias("Date Rptd"),
        F.col("l_suppkey").alias("Rpt Dist No"), F.col("l_returnflag").alias("Mocodes"),
        F.col("l_partkey").alias("Crm Cd 1"), F.col("l_linenumber").alias("Premis Cd"),
        "l_quantity", "l_extendedprice", "l_discount", "l_linestatus")
    path = landing.land_csv(spark, li, "incidents-csv")
    return crime_job(spark, path)


# Columns dropped from lineitem; the last name is absent and ignored.
LINEITEM_EXCLUDED = ("l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_comment")


def project_excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents_without_codes(table(spark, sf_dir, "lineitem"), LINEITEM_EXCLUDED)


def latest_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return first_n(ev, 100, [F.col("ts").desc_nulls_last(), F.col("event_id").asc()])


# --- scalar parsing ----------------------------------------------------------------------

def decimal_comma_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("///"))
            .when(F.col("event_type") == "view",
                  F.concat(F.lit("1."), F.translate(F.col("value").cast("string"), ".", ",")))
            .otherwise(F.translate(F.col("value").cast("string"), ".", ",")))
    return ev.select("event_id", parse_decimal_comma(text).alias("valor"))


def text_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")) \
        .otherwise(F.col("o_orderdate").cast("string"))
    return o.select("o_orderkey", parse_timestamp(text, "timestamp_ntz").alias("fecha"))


def quoted_line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.lit('"'), F.col("event_type"), F.lit(", "), F.col("user_id").cast("string"),
                    F.lit('",'), F.col("value").cast("string"), F.lit(',,"", "'),
                    F.col("event_id").cast("string"), F.lit('" ,'))
    toks = clean_tokens(split_quoted(line))
    return ev.select("event_id", F.size(toks).alias("n_tokens"),
                     F.array_join(toks, "|").alias("tokens"))


def quoted_line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with empty first, middle and last fields, every field kept."""
    ev = table(spark, sf_dir, "events")
    first = F.when(F.col("event_type") != "view", F.concat(F.lit('"a, '), F.col("event_type"), F.lit('"'))).otherwise(F.lit(""))
    line = F.concat(first, F.lit(","), F.col("value").cast("string"), F.lit(',,"",'), F.col("event_id").cast("string"), F.lit(","))
    fields = clean_tokens(split_quoted(line, keep_empty=True))
    return ev.select("event_id", F.size(fields).alias("n_fields"), F.array_join(fields, "|").alias("fields"))


# --- JSON sources ----------------------------------------------------------------------------

def json_series_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    value = F.col("value").cast("string")
    valor = F.when(F.col("event_type") == "click", F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    line = F.concat(F.lit('{"fecha": "'), format_day("ts"), F.lit('", "valor": '), valor,
                    F.lit(', "tipo": "'), F.col("event_type"), F.lit('"}'))
    path = landing.land_lines(spark, ev.select(line.alias("line")), "json-series")
    series = read_json_series(spark, path, multi_line=False)
    return series.withColumn("valor_entero", truncate_to_long("valor"))


def json_records_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    tna = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.concat(F.lit(', "tna": '), F.col("value").cast("string")))
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"),
                    F.lit(', "entidad": "'), F.col("event_type"), F.lit('"'), tna,
                    F.lit(', "logo": "logo.png", "enlace": "https://example.org/'),
                    F.col("user_id").cast("string"), F.lit('"}'))
    path = landing.land_lines(spark, ev.select(line.alias("line")), "json-records")
    recs = read_json_records(spark, path, ["event_id", "entidad", "tna", "logo", "enlace"],
                             multi_line=False)
    return deposit_tables(recs, recs)[0]


def _deposits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """E7 end to end: both tables landed as JSON arrays (header from the first
    record, all keys present, missing values null), run by the E7 job."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("entidad"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("tna"),
        F.lit("logo.png").alias("logo"),
        F.concat(F.lit("https://example.org/"), F.col("user_id").cast("string")).alias("enlace"))
    daily = (table(spark, sf_dir, "events").groupBy(format_day("ts").alias("fecha"))
             .agg(F.count("value").alias("valor")))
    rates_path = landing.land_json_arrays(spark, ev, "rates-json")
    deposits_path = landing.land_json_arrays(spark, daily, "deposits-json")
    return deposit_jobs(spark, rates_path, deposits_path)


def deposits_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deposits(spark, sf_dir)[0]


def deposits_30_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deposits(spark, sf_dir)[1]


LARGE_ARRAY_FILES = 2


def json_array_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as two array files, however many there are, each read in ranges far
    smaller than the file; texts hold quotes, brackets and backslashes."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit('["'), F.col("event_type"), F.lit('\\"]}, {')).alias("label"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "props")
    path = landing.land_json_arrays(spark, ev, "events-arrays", roll_bytes=1 << 62, files=LARGE_ARRAY_FILES)
    return read_json_records(spark, path, split_bytes=LARGE_SPLIT_BYTES)


def json_faults_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON Lines in a folder per event type, some cut off, some no
    records, some with text behind, some with an unknown key: counted per folder and
    reason, next to the sound ones, which are kept."""
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "valor": '), F.col("value").cast("string"))
    nth = lambda k, r: F.pmod("event_id", F.lit(k)) == r
    made = (F.when(nth(97, 1), line).when(nth(101, 2), F.col("event_id").cast("string"))
            .when(nth(103, 3), F.concat(line, F.lit("} {}"))).when(nth(107, 4), F.concat(line, F.lit(', "otra": 1}')))
            .otherwise(F.concat(line, F.lit("}"))))
    path = landing.land_lines_by_stem(spark, ev.select(F.col("event_type").alias("stem"), made.alias("line")), "events-faults")
    checked = json_records_checked(spark, path, ["event_id", "valor"], multi_line=False)
    checked = checked.withColumn("stem", F.regexp_extract("file", r"stem=([^/]+)/", 1))
    sound, faulty = set_aside(checked)
    good = sound.groupBy("stem").agg(F.lit("sound").alias("reason"), F.count("*").alias("n"))
    return good.unionByName(fault_report(faulty, "stem"))


# --- CSV sources and the CSV hand-off -------------------------------------------------------------

def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing.land_csv(spark, table(spark, sf_dir, "customer"), "customer-csv")
    return read_csv_text(spark, path)


def csv_scan_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        F.translate(F.col("o_totalprice").cast("string"), ".", ",").alias("o_totalprice"))
    path = landing.land_csv(spark, o, "orders-semicolon", sep=";")
    df = read_csv_text(spark, path, sep=";")
    return df.withColumn("o_totalprice", parse_decimal_comma("o_totalprice"))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landing.land_csv(spark, table(spark, sf_dir, "customer"), "customer-inferred")
    return read_csv_typed(spark, path)


def csv_roundtrip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice", "o_orderdate", "o_orderpriority",
        # Every third stamp is a whole second, the others have a fraction.
        (F.col("o_orderdate") + F.make_dt_interval(
            secs=((F.col("o_orderkey") % 3) * F.lit(Decimal("0.120301"))))).alias("stamp"))
    return csv_roundtrip(spark, o, scratch_path(spark, "orders-roundtrip"))


def csv_replace_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV table replaced by a newer one with other rows, each swapped in when it is whole."""
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-replaced")
    write_csv(customer.where("c_acctbal < 0"), path)
    write_csv(customer.where("c_acctbal >= 0").withColumn("c_acctbal", F.col("c_acctbal").cast(MONEY) * 2), path)
    return read_csv_text(spark, path)


# --- zip archives ---------------------------------------------------------------------------

def zip_member_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = landing.land_zip_archives(spark, customer, "customer-zip")
    return _archive_table(spark, path, customer.columns)


def _archive_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    members = ZipCatalogue(spark, path, member_prefix="API")
    return member_table(members.lines(), columns, members.headers()).drop("archive", "member")


def zip_member_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small archives in two column orders, some without two of the columns, with
    blank lines before the header and between records and with empty members."""
    customer = table(spark, sf_dir, "customer")
    third = F.pmod("c_custkey", F.lit(3)) == 1
    odd = {"roll_bytes": 4096, "turn_odd": True, "blank_lines": True}
    path = landing.land_zip_archives(spark, customer.where(~third), "customer-zip-mixed", **odd)
    landing.land_zip_archives(spark, customer.where(third).drop("c_acctbal", "c_mktsegment"), "", path=path, label="b", **odd)
    return _archive_table(spark, path, customer.columns)


MEMBERS_PER_ARCHIVE, MEMBER_BYTES = 64, 16 * 1024


def zip_member_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a few archives of many members each, which are dealt to tasks."""
    orders = table(spark, sf_dir, "orders")
    path = landing.land_zip_archives(spark, orders, "orders-zip", roll_bytes=MEMBER_BYTES, members=MEMBERS_PER_ARCHIVE)
    return _archive_table(spark, path, orders.columns)


QUERIES = {
    "period_over_period": period_over_period,
    "period_over_period_by_key": period_over_period_by_key,
    "period_over_period_csv": period_over_period_csv,
    "monthly_daily_join": monthly_daily_join,
    "indices_from_json": indices_from_json,
    "region_scaled_series": region_scaled,
    "region_tables": region_tables,
    "nway_key_join": nway_key_join,
    "series_average": series_average_q,
    "series_average_merged": series_average_merged,
    "series_from_archive": series_from_archive,
    "previous_row_large": previous_row_large,
    "nway_key_join_wide": nway_key_join_wide,
    "dropped_counts": dropped_counts,
    "csv_replace_commit": csv_replace_commit,
    "filter_any_measure": filter_any_measure,
    "cases_from_csv": cases_from_csv,
    "project_excluding": project_excluding,
    "incidents_from_csv": incidents_from_csv,
    "latest_n_rows": latest_n_rows,
    "year_value_default": year_value_default,
    "decimal_comma_parse": decimal_comma_parse,
    "text_to_timestamp": text_to_timestamp,
    "quoted_line_tokens": quoted_line_tokens,
    "quoted_line_fields": quoted_line_fields,
    "json_series_scan": json_series_scan,
    "json_records_to_table": json_records_to_table,
    "deposits_from_json": deposits_from_json,
    "deposits_30_days": deposits_30_days,
    "csv_scan_strings": csv_scan_strings,
    "csv_scan_semicolon": csv_scan_semicolon,
    "csv_scan_inferred": csv_scan_inferred,
    "csv_roundtrip_text": csv_roundtrip_text,
    "preamble_csv_scan": preamble_csv_scan,
    "preamble_lines_large": preamble_lines_large,
    "folder_scan_file_key": folder_scan_file_key,
    "indicators_from_archives": indicators_from_archives,
    "zip_member_scan": zip_member_scan,
    "zip_member_layouts": zip_member_layouts,
    "zip_member_parallel": zip_member_parallel,
    "json_array_large": json_array_large,
    "json_faults_set_aside": json_faults_set_aside,
}
