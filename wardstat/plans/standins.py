"""The checked queries: package composites run over the driver's tables.

The driver's tables stand in for the facility files (see README):

- lineitem x supplier x nation = daily staffing facts (supplier = facility,
  nation = state, ``l_quantity`` = hours, ``l_discount`` = census,
  ``l_tax`` = readmission rate);
- events = appended snapshots (user = facility, ``ts`` = load stamp,
  ``event_type`` = measure code, ``value`` = score);
- customer / orders = provider / MDS rows (``c_acctbal`` = beds,
  ``o_totalprice`` = residents, ``o_orderpriority`` = resident type).

Missing values do not occur in these tables, so some queries make dirt in
the query itself (``nullif``, padding, mixed case), identically in the
oracle SQL.  Each function takes ``(spark, sf_dir)`` and reads whole
tables; nothing is sampled or capped except where a limit is the feature
(top 10, first five names, the 5,000-row preview).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.functions.cleaning import clean_code, clean_text, parse_date, to_number, to_number_or
from wardstat.functions.measures import guarded_ratio, null_safe_sum
from wardstat.operators.columns import normalize_headers, trim_all, with_columns
from wardstat.operators.dedup import dedup_by_key, latest_per_key
from wardstat.operators.joins import join_keep_left
from wardstat.operators.quality import quality_counts
from wardstat.operators.select import present
from wardstat.plans import checks, gold, jobs, partials, serving, silver
from wardstat.plans.snapshot import latest, refresh_latest
from wardstat.session import scratch_path
from wardstat.sources import infer
from wardstat.sources.files import read_csv, read_table
from wardstat.sources.intake import allow_listed, changed_files, ingest_changed, list_files, rebuild_if_changed
from wardstat.sources.ordered import overwrite_sorted, read_range
from wardstat.sources.sinks import BATCH_COL, append_batch, overwrite
from wardstat.streaming.landing import run_landing_once

# --- fixed values used by the checked queries ---------------------------------
STATE_PICK = "NATION_3"
HOSPITAL_PICK = ("Supplier#000000001", "Supplier#000000007")
ALLOWED_SOURCES = ("src0", "src3", "src5")
ALLOWED_KIND = "en"
SHORT_DOC_CHARS = 100
MEASURE_PICK = "purchase"
LAST_RUN_CUTOFF = "2024-01-30 12:00:00"
LANDED_FILES = 8  # files of an arrival
# ------------------------------------------------------------------------------


# --- fixed values: column types of the driver tables ------------------------------
# Declared so a read does not run a footer-reading job to infer them; parquet
# matches the columns by name.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
# ------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


# --- stand-in views -------------------------------------------------------------


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facility dimension: supplier with its state name (one row each)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return sup.join(nat, sup.s_nationkey == nat.n_nationkey).drop("s_nationkey", "n_nationkey")


def staffing_facts(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    """lineitem rows (``cols``) with facility name and state attached.

    Joined fact-first (lineitem -> supplier -> nation): without table
    statistics Spark estimates a join's size as the product of its inputs,
    so a pre-joined supplier x nation would look larger than the fact table
    and the fact would be picked as the broadcast side.
    """
    li = table(spark, sf_dir, "lineitem").select(*cols)
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, F.col("s_nationkey") == nat.n_nationkey)
        .drop("s_suppkey", "s_nationkey", "n_nationkey")
    )


def staffing_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver staffing table shape: one row per lineitem with state/day."""
    f = staffing_facts(
        spark, sf_dir, ["l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate"]
    )
    return f.select(
        F.col("l_suppkey").alias("PROVNUM"),
        F.col("s_name").alias("PROVNAME"),
        F.col("n_name").alias("STATE"),
        F.to_date("l_shipdate").alias("WorkDate"),
        F.col("l_quantity").alias("Hrs_RNDON"),
        F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("TotalNursing_Hours"),
        F.col("l_discount").alias("MDScensus"),
        F.col("l_tax").alias("RN_Ratio"),
        F.col("l_linenumber").alias("CNA_Ratio"),
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider stand-in: customer with its state (one load, no stamp)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return cust.join(nat, cust.c_nationkey == nat.n_nationkey).select(
        F.col("c_custkey").alias("CCN"),
        F.col("c_name"),
        F.col("n_name"),
        F.col("c_acctbal").alias("beds"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended-snapshot stand-in: events keyed by user, stamped by ts."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("CCN"), "event_id", "ts", "event_type", "value"
    )


# --- projections and scalar functions --------------------------------------------


def q_clean_strings(spark, d):
    c = table(spark, d, "customer")
    raw = c.select(
        "c_custkey",
        F.nullif(F.col("c_custkey"), F.lit(7)).alias("key"),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
        F.concat(F.col("c_name"), F.lit("  ")).alias("name"),
    )
    out = with_columns(present(raw, "key"), {"segment": clean_code("segment"), "name": clean_text("name")})
    return out.select("c_custkey", "segment", "name")


def q_normalize_headers(spark, d):
    raw = table(spark, d, "nation").toDF(
        "CMS Certification Number (CCN)",
        "Performance Period: FY 2022 Risk-Standardized Readmission Rate",
        "County/Parish",
    )
    return normalize_headers(raw, rules="extended")


def q_cast_numeric_or_null(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey",
        to_number(F.substr(F.col("p_brand"), F.lit(7))).alias("brand_no"),
        to_number("p_type").alias("type_no"),
    )


def q_cast_numeric_or_default(spark, d):
    p = table(spark, d, "part")
    text = F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(F.substr(F.col("p_brand"), F.lit(7)))
    return p.select("p_partkey", to_number_or(text, 0.0).alias("score"))


def q_work_date(spark, d):
    e = table(spark, d, "events")
    text = F.date_format("ts", "yyyy-MM-dd")
    return e.select("event_id", parse_date(text, "yyyy-MM-dd").alias("work_date"))


def q_dedup_by_key(spark, d):
    li = table(spark, d, "lineitem")
    order = [
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    out = dedup_by_key(li, ["l_orderkey", "l_linenumber"], order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def q_null_safe_total(spark, d):
    li = table(spark, d, "lineitem")
    rn = F.nullif(F.col("l_quantity"), F.lit(1.0))
    disc = F.nullif(F.col("l_discount"), F.lit(0.0))
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(null_safe_sum([rn, disc, tax]), 6).alias("total_hours"),
        F.round(null_safe_sum([disc, tax]), 6).alias("admin_hours"),
    )


def q_guarded_ratio(spark, d):
    li = table(spark, d, "lineitem")
    rn = F.nullif(F.col("l_quantity"), F.lit(1.0))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(guarded_ratio(rn, "l_discount"), 6).alias("rn_ratio"),
    )


# --- intake -------------------------------------------------------------------


def q_changed_files(spark, d):
    e = table(spark, d, "events")
    listing = e.groupBy(F.col("user_id").alias("file_id")).agg(F.max("ts").alias("modified"))
    # every event before the cutoff is a record an earlier run wrote
    manifest = e.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(LAST_RUN_CUTOFF))).select(
        F.col("user_id").alias("file_id"), F.col("ts").alias("seen")
    )
    return changed_files(listing, manifest, key="file_id").select("file_id", "modified")


def q_allow_listed_files(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", "source", "lang", (F.col("n_chars") < SHORT_DOC_CHARS).alias("trashed")
    )
    picked = allow_listed(
        docs, ALLOWED_SOURCES, name_col="source", kind_col="lang", kind=ALLOWED_KIND, trashed_col="trashed"
    )
    return picked.select("doc_id", "source", "lang")


# --- silver staffing ------------------------------------------------------------


def q_silver_master(spark, d):
    li = staffing_facts(
        spark, d,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"],
    )
    raw = li.select(
        F.col("l_suppkey").cast("string").alias("PROVNUM"),
        F.col("l_suppkey"),
        F.col("n_name").alias("STATE"),
        F.col("l_shipdate").alias("WorkDate"),  # a typed source: no text round trip
        F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("Hrs_RN"),
        F.col("l_tax").alias("Hrs_LPN"),
        F.col("l_discount").alias("MDScensus"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
    )
    # the survivor order of the oracle: ..., l_quantity, l_discount, l_tax
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "MDScensus", "Hrs_LPN"]
    s = silver.master_staffing(raw, order=order)
    return s.select(
        "l_suppkey",
        F.col("STATE").alias("state"),
        F.col("WorkDate").alias("work_date"),
        F.col("TotalNursing_Hours").alias("total_hours"),
        F.round(guarded_ratio("TotalNursing_Hours", "MDScensus"), 6).alias("ratio"),
    )


# --- gold staffing --------------------------------------------------------------


def q_onduty_hours_by_state_day(spark, d):
    h = gold.onduty_hours(staffing_silver(spark, d))
    return h.select(
        F.col("STATE").alias("state"),
        F.col("WorkDate").alias("work_date"),
        F.round("Total_RN_Hours", 6).alias("total_rn_hours"),
    )


def q_nurse_ratio_by_hospital(spark, d):
    r = gold.nurse_ratio(staffing_silver(spark, d), ["PROVNUM", "PROVNAME"], "Avg_Nurse_Ratio_ByHospital")
    return r.select(
        F.col("PROVNUM").alias("s_suppkey"),
        F.col("PROVNAME").alias("s_name"),
        F.round("Avg_Nurse_Ratio_ByHospital", 6).alias("avg_ratio"),
    )


def q_nurse_ratio_by_state(spark, d):
    r = gold.nurse_ratio(staffing_silver(spark, d), ["STATE"], "Avg_Nurse_Ratio_ByState")
    return r.select(F.col("STATE").alias("state"), F.round("Avg_Nurse_Ratio_ByState", 6).alias("avg_ratio"))


def q_nurse_ratio_by_department(spark, d):
    li = table(spark, d, "lineitem")
    s = li.select(
        F.col("l_tax").alias("RN_Ratio"),
        F.col("l_linenumber").alias("CNA_Ratio"),
        F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("TotalNursing_Hours"),
        F.col("l_discount").alias("MDScensus"),
    )
    r = gold.nurse_ratio(s, ["RN_Ratio", "CNA_Ratio"], "Avg_Nurse_Ratio_ByDepartment")
    return r.select(
        F.col("RN_Ratio").alias("rn_ratio"),
        F.col("CNA_Ratio").alias("cna_ratio"),
        F.round("Avg_Nurse_Ratio_ByDepartment", 6).alias("avg_ratio"),
    )


# --- latest record --------------------------------------------------------------


def q_latest_per_key(spark, d):
    s = latest_per_key(snapshots(spark, d), "CCN", stamp="ts", tie_break="event_id")
    return s.select(F.col("CCN").alias("user_id"), "event_id", "ts", "value")


def q_latest_per_key_for_measure(spark, d):
    s = snapshots(spark, d).filter(F.col("event_type") == F.lit(MEASURE_PICK))
    s = latest_per_key(s, "CCN", stamp="ts", tie_break="event_id")
    return s.select(F.col("CCN").alias("user_id"), "event_id", "ts", "value")


# --- joins and the bed / throughput gold tables ------------------------------------


def q_join_keep_left_columns(spark, d):
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_acctbal")
    orders = table(spark, d, "orders").withColumnRenamed("o_custkey", "custkey")
    return join_keep_left(cust, orders, "custkey", keep=["o_orderkey", "o_totalprice"])


def _mds(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("CCN"), "o_orderpriority", "o_totalprice"
    )


def _bed_providers(spark, d) -> DataFrame:
    """Provider stand-in for the bed tables: customer only; the state name
    is attached after the fact-sized join (see ``_with_state``)."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("CCN"), "c_name", "c_nationkey", F.col("c_acctbal").alias("beds")
    )


def _with_state(spark, d):
    nat = table(spark, d, "nation").select("n_nationkey", "n_name")

    def enrich(df: DataFrame) -> DataFrame:
        return df.join(nat, df.c_nationkey == nat.n_nationkey).drop("c_nationkey", "n_nationkey")

    return enrich


def q_bed_utilization_by_hospital(spark, d):
    b = gold.bed_utilization(
        _bed_providers(spark, d), _mds(spark, d), by=["c_name", "n_name"], name="bed_utilization",
        key="CCN", residents="o_totalprice", beds="beds", stamp=None, enrich=_with_state(spark, d),
    )
    return b.select("c_name", F.col("n_name").alias("state"), "bed_utilization")


def q_bed_utilization_by_department(spark, d):
    return gold.bed_utilization(
        _bed_providers(spark, d), _mds(spark, d), by=["o_orderpriority"], name="bed_utilization",
        key="CCN", residents="o_totalprice", beds="beds", stamp=None,
    )


def q_bed_utilization_preaggregated(spark, d):
    """Residents taken from the provider side (``c_nationkey`` stands in), so
    the MDS rows can be reduced to counts per facility and resident type
    before the join."""
    prov = _bed_providers(spark, d).withColumn("residents", F.col("c_nationkey").cast("double"))
    return gold.bed_utilization(
        prov, _mds(spark, d), by=["o_orderpriority"], name="bed_utilization",
        key="CCN", residents="residents", beds="beds", stamp=None, pre_aggregate=True,
    )


def _throughput(spark, d) -> DataFrame:
    t = gold.patient_throughput(
        providers(spark, d), snapshots(spark, d), key="CCN",
        measure=MEASURE_PICK, measure_col="event_type", score="value", beds="beds",
        skilled_keep=["value"], provider_stamp=None, skilled_stamp="ts",
        skilled_tie_break="event_id", name="throughput",
    )
    return t.select(
        F.col("CCN").alias("user_id"), "c_name", F.col("n_name").alias("state"),
        F.col("value").alias("score"), "throughput",
    )


def q_patient_throughput(spark, d):
    return _throughput(spark, d)


def q_throughput_top10(spark, d):
    return serving.top_throughput(
        _throughput(spark, d), 10, by="throughput", key="user_id",
        columns=["user_id", "c_name", "throughput", "state"],
    )


# --- staffing x readmission -----------------------------------------------------


def _readmission(spark, d, missing: str, count_name: str | None = None):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        F.col("l_suppkey").alias("fkey"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("readmission"),
    )
    nat = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    # facilities that have a state; the name is attached to the (fact-sized)
    # detail afterwards, so every join is fact x dimension and the size
    # estimates pick the dimension as the broadcast side
    fac = (
        table(spark, d, "supplier")
        .select(F.col("s_suppkey").alias("fkey"), "s_name", "s_nationkey")
        .join(nat, F.col("s_nationkey") == nat.n_nationkey, "left_semi")
    )
    detail, summary = gold.staffing_readmission(
        li, fac, key="fkey", hours="l_quantity", rate="readmission",
        missing=missing, stamp=None, count_name=count_name,
    )
    detail = detail.join(nat, detail.s_nationkey == nat.n_nationkey).drop("s_nationkey", "n_nationkey")
    return detail, summary


def q_staffing_band_detail(spark, d):
    detail, _ = _readmission(spark, d, "zero")
    return detail.select("l_orderkey", "l_linenumber", "l_partkey", "s_name", "state", "l_quantity", "readmission")


def q_staffing_readmission_corr(spark, d):
    _, summary = _readmission(spark, d, "zero")
    return summary.select(F.round(gold.CORRELATION, 6).alias("correlation"))


def q_staffing_readmission_corr_drop_missing(spark, d):
    _, summary = _readmission(spark, d, "drop", count_name="n")
    return summary.select(F.round(gold.CORRELATION, 6).alias("correlation"), "n")


def q_ols_trend_by_state(spark, d):
    detail, _ = _readmission(spark, d, "zero")
    fit = serving.trend_line(detail, y="l_extendedprice", x="l_quantity", by=["state"])
    return fit.select(
        "state", "n",
        F.round("slope", 4).alias("slope"),
        F.round("intercept", 4).alias("intercept"),
        F.round("r2", 6).alias("r2"),
    )


def q_facility_kpis_for_state(spark, d):
    detail, _ = _readmission(spark, d, "zero")
    return serving.facility_kpis(detail, STATE_PICK, state_col="state", hours="l_quantity", digits=6)


def q_facility_kpi_cards(spark, d):
    detail, _ = _readmission(spark, d, "zero")
    return serving.kpi_cards(
        detail, STATE_PICK, state_col="state", hours="l_quantity", rate="readmission", digits=6
    )


def q_facility_kpis_all_states(spark, d):
    detail, _ = _readmission(spark, d, "zero")
    return serving.facility_kpis(detail, serving.ALL, state_col="state", hours="l_quantity", digits=6)


# --- serving lists ------------------------------------------------------------


def q_total_onduty_hours(spark, d):
    li = table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("WorkDate"), F.col("l_quantity").alias("Hrs_RNDON")
    )
    hours = gold.onduty_hours(li, by=["WorkDate"])
    return serving.total_hours(hours, name="total_rn_hours")


def q_distinct_states(spark, d):
    return serving.states(table(spark, d, "nation"), state_col="n_name", alias="state")


def q_default_first_five(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name")
    return serving.default_selection(sup, name_col="s_name", n=5)


def q_hospitals_in_state(spark, d):
    return serving.hospitals_in_state(facilities(spark, d), STATE_PICK, name_col="s_name", state_col="n_name")


def q_select_hospitals(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return serving.selected_hospitals(sup, list(HOSPITAL_PICK), name_col="s_name")


def q_preview_rows(spark, d):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return checks.preview(table(spark, d, "lineitem"), columns=cols, n=checks.PREVIEW_ROWS)


def q_quality_checks(spark, d):
    li = table(spark, d, "lineitem").select(
        F.nullif(F.col("l_suppkey"), F.lit(7)).alias("PROVNUM"), "l_orderkey", "l_linenumber"
    )
    staffing = quality_counts(li, not_null=["PROVNUM"], unique=["l_orderkey", "l_linenumber"])
    cust = table(spark, d, "customer")
    seg = (
        F.when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
        .when(F.col("c_nationkey") == 4, F.concat(F.col("c_mktsegment"), F.lit(" ")))
        .when(F.col("c_nationkey") == 5, F.concat(F.lit("\t"), F.col("c_mktsegment")))
        .when(F.col("c_nationkey") == 6, F.concat(F.col("c_mktsegment"), F.lit("\u00a0")))
        .otherwise(F.col("c_mktsegment"))
    )
    trims = quality_counts(cust.select(seg.alias("STATE")), trimmed=["STATE"], row_count=False)
    return staffing.unionByName(trims)



# --- raw CSV files -> silver (files written from the driver tables) ---------------


def _write_raw_csv(spark, df: DataFrame, name: str) -> str:
    """Write ``df`` as a headed CSV folder in shared scratch space, keeping
    leading/trailing spaces (the silver jobs must trim them)."""
    path = scratch_path(spark, name)
    (
        df.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _pad(c) -> F.Column:
    return F.concat(F.lit(" "), c, F.lit("  "))


def q_silver_provider_info(spark, d):
    prov = providers(spark, d)
    cust = table(spark, d, "customer").select(F.col("c_custkey").alias("CCN"), "c_mktsegment")
    raw = prov.join(cust, "CCN").select(
        F.lpad(F.col("CCN").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        _pad(F.col("c_name")).alias("Provider Name"),
        _pad(F.col("n_name")).alias("State"),
        F.col("beds").cast("string").alias("Number of Certified Beds"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Not Available"))
        .otherwise((F.col("beds") / 10).cast("string"))
        .alias("Average Number of Residents per Day"),
    )
    path = _write_raw_csv(spark, raw, "raw-provider-info")
    out = silver.provider_info(read_csv(spark, path))
    return out.drop(silver.STAMP)


def q_silver_facility_performance(spark, d):
    sup = table(spark, d, "supplier")
    raw = sup.select(
        F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        _pad(F.col("s_name")).alias("Provider Name"),
        F.when(F.col("s_acctbal") < 0, F.lit("Not Available"))
        .otherwise((F.col("s_acctbal") / 1000).cast("string"))
        .alias("Performance Period: FY 2022 Risk-Standardized Readmission Rate"),
        F.concat(F.lit("CITY "), F.col("s_nationkey").cast("string")).alias("City/Town"),
    )
    path = _write_raw_csv(spark, raw, "raw-facility-performance")
    return silver.facility_performance(read_csv(spark, path)).drop(silver.STAMP)


def q_silver_skilled_nursing(spark, d):
    ev = table(spark, d, "events")
    raw = ev.select(
        F.lpad(F.col("user_id").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        F.col("event_id").cast("string").alias("Row Id"),
        _pad(F.col("event_type")).alias("Measure Code"),
        F.when(F.col("event_type") == "error", F.lit("Not Available"))
        .otherwise(F.col("value").cast("string"))
        .alias("Score"),
    )
    path = _write_raw_csv(spark, raw, "raw-skilled-nursing")
    return silver.skilled_nursing(read_csv(spark, path)).drop(silver.STAMP)


def q_silver_quality_mds(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        F.col("o_orderkey").cast("string").alias("Measure-Row (Id)"),
        _pad(F.col("o_orderpriority")).alias("Resident type"),
    )
    path = _write_raw_csv(spark, raw, "raw-quality-mds")
    return silver.quality_mds(read_csv(spark, path)).drop(silver.STAMP)


def q_silver_quality_claims(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CMS Certification Number (CCN)"),
        F.col("o_orderkey").cast("string").alias("Claim Row"),
        _pad(F.col("o_orderstatus")).alias("Measure Status"),
    )
    path = _write_raw_csv(spark, raw, "raw-quality-claims")
    return silver.quality_claims(read_csv(spark, path)).drop(silver.STAMP)


def q_silver_master_csv(spark, d):
    f = staffing_facts(spark, d, ["l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate"])
    raw = f.select(
        _pad(F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("PROVNUM"),
        F.col("s_name").alias("PROVNAME"),
        _pad(F.lower(F.col("n_name"))).alias("STATE"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("WorkDate"),
        F.col("l_quantity").cast("string").alias("Hrs_RNDON"),
        F.col("l_quantity").cast("string").alias("Hrs_RN"),
        F.col("l_tax").cast("string").alias("Hrs_LPN"),
        F.when(F.col("l_discount") > 0.05, F.col("l_tax").cast("string")).alias("Hrs_CNA"),
        F.col("l_discount").cast("string").alias("MDScensus"),
    )
    path = _write_raw_csv(spark, raw, "raw-master-staffing")
    out = silver.master_staffing(read_csv(spark, path))
    return out.select(
        "PROVNUM", "STATE", "WorkDate",
        F.round("TotalNursing_Hours", 6).alias("TotalNursing_Hours"),
        F.round("RN_Ratio", 6).alias("RN_Ratio"),
        F.round("CNA_Ratio", 6).alias("CNA_Ratio"),
        F.round("LPN_Ratio", 6).alias("LPN_Ratio"),
    )


CSV_SCAN_SCHEMA = "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"


def q_csv_scan(spark, d):
    """A CSV folder read with a declared schema (no inference pass)."""
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]
    path = _write_raw_csv(spark, table(spark, d, "lineitem").select(*cols), "raw-csv-scan")
    return read_csv(spark, path, schema=CSV_SCAN_SCHEMA)


# --- sinks: repeatable append, schema merge, overwrite ---------------------------


def q_roundtrip_append_replay(spark, d):
    o = table(spark, d, "orders")
    path = scratch_path(spark, "silver-append")
    first = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    append_batch(first, path, "load-1")
    append_batch(first, path, "load-1")  # replay after a failure: replaces, no duplicates
    later = o.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    append_batch(later, path, "load-2")  # brings a new column
    return read_table(spark, path).drop(BATCH_COL)


def q_roundtrip_overwrite(spark, d):
    path = scratch_path(spark, "gold-throughput")
    overwrite(_throughput(spark, d).filter(F.col("throughput") > 0), path)
    overwrite(_throughput(spark, d), path)  # replaces the first write
    return read_table(spark, path)


# --- multi-output gold jobs --------------------------------------------------------


def q_staffing_rollups(spark, d):
    r = jobs.staffing_rollups(staffing_silver(spark, d))
    path = scratch_path(spark, "gold-staffing")
    jobs.write_rollups(r, path)
    stored = read_table(spark, path)
    return stored.select(
        jobs.SUMMARY, "STATE", "WorkDate", "PROVNUM", "PROVNAME", "RN_Ratio", "CNA_Ratio",
        F.round(gold.TOTAL_RN_HOURS, 6).alias(gold.TOTAL_RN_HOURS),
        F.round("Avg_Nurse_Ratio", 6).alias("Avg_Nurse_Ratio"),
    )


BED_STANDIN_SETS = {
    "utilization_by_hospital": ("c_name", "n_name"),
    "utilization_by_department": ("o_orderpriority",),
}


def q_bed_utilization_rollups(spark, d):
    return jobs.bed_utilization_rollups(
        _bed_providers(spark, d), _mds(spark, d), key="CCN", residents="o_totalprice", beds="beds",
        stamp=None, sets=BED_STANDIN_SETS, enrich=_with_state(spark, d),
    )


def q_staffing_readmission_written(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_suppkey").alias("fkey"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("readmission"),
    )
    fac = table(spark, d, "supplier").select(F.col("s_suppkey").alias("fkey"), "s_name")
    detail, summary = jobs.staffing_readmission_tables(
        spark, li, fac, scratch_path(spark, "gold-detail"), scratch_path(spark, "gold-corr"),
        key="fkey", hours="l_quantity", rate="readmission", stamp=None,
    )
    return summary.select(F.round(gold.CORRELATION, 6).alias("correlation"))


def q_csv_inferred_types(spark, d):
    """How many values of each text column have the form of each type, and
    the type that follows: keys with leading zeros stay text."""
    o = table(spark, d, "orders")
    status = F.col("o_orderstatus")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("order no"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("code"),
        _pad(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(status == "F", "Not Available").when(status == "P", " ").otherwise((F.col("o_custkey") * 1000000000).cast("string")).alias("score"),
        F.when(status != "F", (F.col("o_custkey") * 1000000000).cast("string")).alias("big"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("moment"),
        F.when(status == "O", "TRUE").otherwise("false").alias("open"),
        F.lit("").alias("nothing"),
        "o_orderpriority",
    )
    rows = read_csv(spark, _write_raw_csv(spark, raw, "raw-typed"))
    counts = infer.type_counts(rows)
    return counts.select(F.col("column").alias("name"), "n_values", *[f"n_{t}" for t in infer.TYPES], infer.chosen_type().alias("type"))


def q_roundtrip_append_widened(spark, d):
    """Three loads that bring the same columns with other types."""
    o = table(spark, d, "orders")
    path = scratch_path(spark, "widened")

    def load(status, cust, code, day):
        rows = o.filter(F.col("o_orderstatus") == status)
        append_batch(rows.select("o_orderkey", cust.alias("cust"), code.alias("code"), day.alias("day")), path, f"load-{status}")

    small, whole = (F.col("o_orderkey") % 100).cast("int"), F.col("o_orderkey")
    load("F", F.col("o_custkey").cast("int"), small, F.col("o_orderdate").cast("date"))
    load("O", F.col("o_custkey"), F.concat(F.lit("C"), whole.cast("string")), F.col("o_orderdate"))
    load("P", F.col("o_custkey").cast("int"), whole, F.lit(None))
    load("O", F.col("o_custkey"), F.concat(F.lit("C"), whole.cast("string")), F.col("o_orderdate"))  # replayed
    return read_table(spark, path).drop(BATCH_COL)


def q_latest_snapshot(spark, d):
    """Five provider loads, the snapshot of their latest records refreshed
    after each one; the last load is replayed with other values."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("CCN"), "c_name", "c_acctbal")
    path, snapshot = scratch_path(spark, "loads"), scratch_path(spark, "loads-latest")

    def load(k, beds):
        rows = c.filter((F.col("CCN") % (k + 1)) == 0)
        rows = rows.select("CCN", "c_name", beds.alias("beds"), F.lit(f"2024-{k + 1:02d}-01 00:00:00").cast("timestamp_ntz").alias("loaded"))
        append_batch(rows, path, f"load-{k}")
        return refresh_latest(spark, path, snapshot, "CCN", "loaded", "beds")

    for k in range(5):
        done = load(k, F.col("c_acctbal") + k)
        if done.rebuilt != (k == 0) or done.loads != (f"load-{k}",):
            raise AssertionError(f"load {k}: {done}")
    load(4, F.col("c_acctbal") * 2)
    return latest(spark, snapshot).select("CCN", "c_name", "beds", "loaded")


def q_hours_stored_in_order(spark, d):
    """The hours table stored by day, and one year of it read back."""
    path = scratch_path(spark, "gold-hours")
    overwrite_sorted(gold.onduty_hours(staffing_silver(spark, d)), path, ["WorkDate", "STATE"], files=6)
    rows = read_range(spark, path, F.lit("1995-01-01").cast("date"), F.lit("1995-12-31").cast("date"))
    return rows.select(
        F.col("STATE").alias("state"), F.col("WorkDate").alias("work_date"), F.round(gold.TOTAL_RN_HOURS, 6).alias("total_rn_hours")
    )


def q_staffing_rollups_incremental(spark, d):
    """The staffing tables after three loads, each reduced once when it came."""
    silver_rows, path, states = staffing_silver(spark, d), scratch_path(spark, "silver-loads"), scratch_path(spark, "partials")
    for k in range(3):
        append_batch(silver_rows.filter(F.pmod("CNA_Ratio", F.lit(3)) == k), path, f"load-{k}")
        if partials.refresh_staffing(spark, path, states) != [f"load-{k}"]:
            raise AssertionError("a refresh did not read just the new load")
    return partials.staffing_rollups(spark, path, states).select(
        jobs.SUMMARY, "STATE", "WorkDate", "PROVNUM", "PROVNAME", "RN_Ratio", "CNA_Ratio",
        F.round(gold.TOTAL_RN_HOURS, 6).alias(gold.TOTAL_RN_HOURS),
        F.round("Avg_Nurse_Ratio", 6).alias("Avg_Nurse_Ratio"),
    )


def q_bed_utilization_incremental(spark, d):
    """Bed utilisation from the provider snapshot and the counts of MDS loads."""
    path, snapshot, mds, counts = (scratch_path(spark, n) for n in ("provider-loads", "provider-latest", "mds-loads", "mds-counts"))
    both = _loads(spark, d)
    for name, day in (("first", "2024-10-01"), ("second", "2024-11-01")):
        append_batch(both.filter(F.col("loaded") == F.lit(day).cast("timestamp_ntz")), path, name)
        refresh_latest(spark, path, snapshot, "CCN", "loaded", "beds")
    rows = _mds(spark, d).select("CCN", "o_orderpriority", "o_totalprice")
    for k in range(2):
        append_batch(rows.filter((F.col("o_totalprice") > 100000) == bool(k)).drop("o_totalprice"), mds, f"load-{k}")
        partials.refresh_mds_counts(spark, mds, counts, ["o_orderpriority"], key="CCN")
    return partials.bed_utilization(
        spark, latest(spark, snapshot), mds, counts, by=["o_orderpriority"], name="bed_utilization", mds_by=["o_orderpriority"],
        key="CCN", residents="residents", beds="beds",
    )


def q_readmission_null_keys(spark, d):
    """The cross-check with NULL facility keys that match each other."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.nullif(F.col("l_suppkey"), F.lit(7)).alias("fkey")
    )
    fac = table(spark, d, "supplier").select(F.nullif(F.col("s_suppkey"), F.lit(7)).alias("fkey"), "s_nationkey")
    _, summary = gold.staffing_readmission(
        li, fac, key="fkey", hours="l_quantity", rate="s_nationkey", missing="drop", stamp=None, count_name="n",
        null_safe=True, skewed="left",
    )
    return summary.select(F.round(gold.CORRELATION, 6).alias("correlation"), "n")


def q_bed_utilization_hot_key(spark, d):
    """A third of all MDS rows at one facility, joined row by row to the
    latest provider load."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey")).alias("CCN"),
    )
    return gold.bed_utilization(
        _loads(spark, d), o, by=["o_orderpriority"], name="bed_utilization", key="CCN", residents="o_totalprice", beds="beds",
        stamp="loaded", tie_break="beds", pre_aggregate=False, mds_keep=["o_orderkey", "o_orderpriority", "o_totalprice"], hot="auto",
    )


def q_report_scatter_binned(spark, d):
    """All points of the scatter page as cells, with the line through them."""
    detail, _ = _readmission(spark, d, "drop")
    cells = serving.scatter_binned(detail, "l_quantity", "readmission", (0.0, 16.0), (0.0, 0.08), bins=8)
    return cells.select(
        "x_bin", "y_bin", "points", *[F.round(c, 6).alias(c) for c in ("mean_x", "mean_y", "slope", "intercept", "r2")]
    )


# --- streaming intake of a landing folder ---------------------------------------------


LANDING_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def q_streaming_landing(spark, d):
    """Events land as CSV in two arrivals; the availableNow stream is run after
    each, and the second run must take only the files that are new."""
    ev = table(spark, d, "events")
    cut = F.col("ts") < F.to_timestamp_ntz(F.lit(LAST_RUN_CUTOFF))
    cols = ["event_id", "user_id", "event_type", "value"]
    land, target = scratch_path(spark, "landing"), scratch_path(spark, "landed")
    ckpt = scratch_path(spark, "landing-checkpoint")
    ev.filter(cut).select(*cols).write.option("header", True).csv(land)
    run_landing_once(spark, land, LANDING_SCHEMA, target, trim_all, checkpoint=ckpt)
    ev.filter(~cut).select(*cols).write.mode("append").option("header", True).csv(land)
    run_landing_once(spark, land, LANDING_SCHEMA, target, trim_all, checkpoint=ckpt)
    return read_table(spark, target).drop(BATCH_COL)


# --- intake of landed files ----------------------------------------------------------


def q_intake_replay(spark, d):
    """Events land as several CSV files per user group.  The first run crashes
    before its manifest counts, more files arrive, and the re-run replaces
    what the crashed run wrote; a further run finds nothing to do."""
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    land, target = scratch_path(spark, "landing"), scratch_path(spark, "intake")
    manifest = scratch_path(spark, "manifest")

    def arrive(k):
        part = ev.filter(F.pmod("user_id", F.lit(4)) == k)
        part.repartition(LANDED_FILES).write.option("header", True).csv(f"{land}/group={k}")

    def take(manifest_path):
        listing = list_files(spark, land, glob="*.csv")
        return ingest_changed(spark, listing, manifest_path, target, trim_all, job="events")

    arrive(0)
    arrive(1)
    take(scratch_path(spark, "manifest-lost"))
    arrive(2)
    arrive(3)
    take(manifest)
    if take(manifest):
        raise AssertionError("an unchanged file was taken again")
    stored = read_table(spark, target)
    return stored.select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", F.col("value").cast("double")
    )


def _raw_staffing(spark, d):
    f = staffing_facts(spark, d, ["l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate"])
    return f.select(
        "l_linenumber",
        _pad(F.lpad(F.col("l_suppkey").cast("string"), 6, "0")).alias("PROVNUM"),
        F.col("s_name").alias("PROVNAME"),
        _pad(F.lower(F.col("n_name"))).alias("STATE"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("WorkDate"),
        F.col("l_quantity").cast("string").alias("Hrs_RNDON"),
        F.col("l_quantity").cast("string").alias("Hrs_RN"),
        F.col("l_tax").cast("string").alias("Hrs_LPN"),
        F.when(F.col("l_discount") > 0.05, F.col("l_tax").cast("string")).alias("Hrs_CNA"),
        F.col("l_discount").cast("string").alias("MDScensus"),
    )


def q_master_two_files(spark, d):
    """The staffing table after more files arrive: rebuilt from all."""
    raw = _raw_staffing(spark, d)
    land, target, manifest = (scratch_path(spark, n) for n in ("master-landing", "master", "master-manifest"))
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

    def take():
        listing = list_files(spark, land, glob="*.csv")
        rebuild_if_changed(spark, listing, manifest, lambda rows: overwrite(silver.master_staffing(rows), target), job="master")

    for name, part in (("early", F.col("l_linenumber") <= 3), ("late", F.col("l_linenumber") > 3)):
        raw.filter(part).drop("l_linenumber").repartition(LANDED_FILES).write.options(**options).csv(f"{land}/{name}")
        take()
    return read_table(spark, target).select(
        "PROVNUM", "STATE", "WorkDate",
        F.round("TotalNursing_Hours", 6).alias("TotalNursing_Hours"),
        F.round("RN_Ratio", 6).alias("RN_Ratio"),
        F.round("CNA_Ratio", 6).alias("CNA_Ratio"),
        F.round("LPN_Ratio", 6).alias("LPN_Ratio"),
    )


def q_csv_mixed_headers(spark, d):
    """Two CSV folders whose headers differ in order and columns, one read."""
    o = table(spark, d, "orders")
    a = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.filter(F.col("o_orderstatus") != "F").select("o_totalprice", "o_orderpriority", "o_orderkey", "o_custkey")
    rows = read_csv(spark, [_write_raw_csv(spark, a, "raw-mixed"), _write_raw_csv(spark, b, "raw-mixed")])
    return rows.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), F.col("o_totalprice").cast("double"), "o_orderpriority"
    )


# --- gold over appended loads ----------------------------------------------------------


def _loads(spark, d) -> DataFrame:
    """Two stamped provider loads: all facilities, then a newer load of two
    thirds of them, in which every fifth comes twice."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("CCN"), "c_name", "c_nationkey", "c_acctbal")

    def load(rows, stamp, beds):
        return rows.select("CCN", "c_name", (F.col("c_nationkey") + 1).cast("double").alias("residents"), beds.alias("beds"),
                           F.lit(stamp).cast("timestamp_ntz").alias("loaded"))

    newer = c.filter(F.pmod("CCN", F.lit(3)) != 0)
    return (
        load(c, "2024-10-01 00:00:00", F.col("c_acctbal") * 2)
        .unionByName(load(newer, "2024-11-01 00:00:00", F.col("c_acctbal")))
        .unionByName(load(newer.filter(F.pmod("CCN", F.lit(5)) == 0), "2024-11-01 00:00:00", F.col("c_acctbal") + 100))
    )


def q_bed_utilization_latest(spark, d):
    return gold.bed_utilization(
        _loads(spark, d), _mds(spark, d).select("CCN", "o_orderpriority"), by=["o_orderpriority"], name="bed_utilization",
        key="CCN", residents="residents", beds="beds", stamp="loaded", tie_break="beds",
    )


def q_throughput_latest(spark, d):
    t = gold.patient_throughput(
        _loads(spark, d), snapshots(spark, d), key="CCN", measure=MEASURE_PICK, measure_col="event_type", score="value",
        beds="beds", skilled_keep=["value"], provider_stamp="loaded", provider_tie_break="beds", skilled_stamp="ts",
        skilled_tie_break="event_id", name="throughput",
    )
    return t.select(F.col("CCN").alias("user_id"), "beds", F.col("value").alias("score"), "throughput")


def q_readmission_latest(spark, d):
    loads = _loads(spark, d)
    prov = loads.select("CCN", "c_name", (F.col("beds") / 1000).alias("hours"), "loaded", F.col("beds").alias("tie"))
    fac = loads.select("CCN", (F.col("residents") + F.col("beds") / 5000).alias("rate"), "loaded", F.col("beds").alias("tie"))
    _, summary = gold.staffing_readmission(
        prov, fac, key="CCN", hours="hours", rate="rate", facility_keep=["rate"], stamp="loaded", tie_break="tie", count_name="n"
    )
    return summary.select(F.round(gold.CORRELATION, 6).alias("correlation"), "n")


# --- report pages over written gold tables -----------------------------------------------


def _written_rollups(spark, d) -> DataFrame:
    path = scratch_path(spark, "gold-staffing")
    jobs.write_rollups(jobs.staffing_rollups(staffing_silver(spark, d)), path)
    return read_table(spark, path)


def q_report_total_hours(spark, d):
    return serving.total_hours(_written_rollups(spark, d), digits=4)


def q_report_hours_series(spark, d):
    part = jobs.summary_part(_written_rollups(spark, d), "onduty_hours_summary", jobs.STAFFING_SETS)
    return serving.hours_series(part).select(
        F.col("STATE").alias("state"), F.col("WorkDate").alias("work_date"), F.round(gold.TOTAL_RN_HOURS, 6).alias("hours"))


def q_report_hospital_bars(spark, d):
    """The bars shown first: the first five hospital names."""
    part = jobs.summary_part(_written_rollups(spark, d), "ratio_by_hospital", jobs.STAFFING_SETS)
    return serving.hospital_bars(part, None, "PROVNAME").select(
        "PROVNUM", "PROVNAME", F.round("Avg_Nurse_Ratio", 6).alias("avg_ratio"))


def q_report_bed_bars(spark, d):
    """Bed utilisation of chosen facilities of one state."""
    loads = _loads(spark, d)
    nat = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    state = nat.select(F.col("c_custkey").alias("CCN"), F.col("n_name").alias("State"))
    bars = gold.bed_utilization(
        loads, _mds(spark, d).select("CCN", "o_orderpriority"), by=["c_name", "State"], name="bed_utilization", key="CCN",
        residents="residents", beds="beds", stamp="loaded", tie_break="beds", enrich=lambda df: df.join(state, "CCN"),
    )
    path = scratch_path(spark, "gold-bed")
    overwrite(bars, path)
    return serving.hospital_bars(read_table(spark, path), None, "c_name", STATE_PICK, "State")


def q_report_scatter(spark, d):
    detail, _ = _readmission(spark, d, "drop")
    points = serving.scatter_points(detail, "l_quantity", "readmission", state=STATE_PICK, state_col="state")
    return points.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "readmission")


def q_report_kpis_stored(spark, d):
    """The cards with the correlation read from the stored summary."""
    li = table(spark, d, "lineitem").select(
        "l_quantity", F.col("l_suppkey").alias("fkey"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("readmission")
    )
    fac = table(spark, d, "supplier").select(F.col("s_suppkey").alias("fkey"), F.col("s_nationkey").cast("string").alias("State"))
    detail, summary = jobs.staffing_readmission_tables(
        spark, li, fac, scratch_path(spark, "gold-detail"), scratch_path(spark, "gold-corr"),
        key="fkey", hours="l_quantity", rate="readmission", stamp=None,
    )
    stored = serving.scalar(summary, gold.CORRELATION)
    return serving.kpi_cards(detail, "3", hours="l_quantity", rate="readmission", digits=4, stored=stored, use_stored=True)


QUERIES = {
    "clean_strings": q_clean_strings,
    "normalize_headers": q_normalize_headers,
    "cast_numeric_or_null": q_cast_numeric_or_null,
    "cast_numeric_or_default": q_cast_numeric_or_default,
    "work_date": q_work_date,
    "dedup_by_key": q_dedup_by_key,
    "null_safe_total": q_null_safe_total,
    "guarded_ratio": q_guarded_ratio,
    "changed_files": q_changed_files,
    "allow_listed_files": q_allow_listed_files,
    "silver_master": q_silver_master,
    "onduty_hours_by_state_day": q_onduty_hours_by_state_day,
    "nurse_ratio_by_hospital": q_nurse_ratio_by_hospital,
    "nurse_ratio_by_state": q_nurse_ratio_by_state,
    "nurse_ratio_by_department": q_nurse_ratio_by_department,
    "latest_per_key": q_latest_per_key,
    "latest_per_key_for_measure": q_latest_per_key_for_measure,
    "join_keep_left_columns": q_join_keep_left_columns,
    "bed_utilization_by_hospital": q_bed_utilization_by_hospital,
    "bed_utilization_by_department": q_bed_utilization_by_department,
    "bed_utilization_preaggregated": q_bed_utilization_preaggregated,
    "patient_throughput": q_patient_throughput,
    "throughput_top10": q_throughput_top10,
    "staffing_band_detail": q_staffing_band_detail,
    "staffing_readmission_corr": q_staffing_readmission_corr,
    "staffing_readmission_corr_drop_missing": q_staffing_readmission_corr_drop_missing,
    "ols_trend_by_state": q_ols_trend_by_state,
    "facility_kpis_for_state": q_facility_kpis_for_state,
    "facility_kpis_all_states": q_facility_kpis_all_states,
    "facility_kpi_cards": q_facility_kpi_cards,
    "total_onduty_hours": q_total_onduty_hours,
    "distinct_states": q_distinct_states,
    "default_first_five": q_default_first_five,
    "hospitals_in_state": q_hospitals_in_state,
    "select_hospitals": q_select_hospitals,
    "preview_rows": q_preview_rows,
    "quality_checks": q_quality_checks,
    "silver_provider_info": q_silver_provider_info,
    "silver_facility_performance": q_silver_facility_performance,
    "silver_skilled_nursing": q_silver_skilled_nursing,
    "silver_quality_mds": q_silver_quality_mds,
    "silver_quality_claims": q_silver_quality_claims,
    "silver_master_csv": q_silver_master_csv,
    "csv_scan": q_csv_scan,
    "roundtrip_append_replay": q_roundtrip_append_replay,
    "roundtrip_overwrite": q_roundtrip_overwrite,
    "staffing_rollups": q_staffing_rollups,
    "bed_utilization_rollups": q_bed_utilization_rollups,
    "staffing_readmission_written": q_staffing_readmission_written,
    "streaming_landing": q_streaming_landing,
    "intake_replay": q_intake_replay,
    "master_two_files": q_master_two_files,
    "csv_mixed_headers": q_csv_mixed_headers,
    "csv_inferred_types": q_csv_inferred_types,
    "roundtrip_append_widened": q_roundtrip_append_widened,
    "latest_snapshot": q_latest_snapshot,
    "hours_stored_in_order": q_hours_stored_in_order,
    "staffing_rollups_incremental": q_staffing_rollups_incremental,
    "bed_utilization_incremental": q_bed_utilization_incremental,
    "readmission_null_keys": q_readmission_null_keys,
    "bed_utilization_hot_key": q_bed_utilization_hot_key,
    "report_scatter_binned": q_report_scatter_binned,
    "bed_utilization_latest": q_bed_utilization_latest,
    "throughput_latest": q_throughput_latest,
    "readmission_latest": q_readmission_latest,
    "report_total_hours": q_report_total_hours,
    "report_hours_series": q_report_hours_series,
    "report_hospital_bars": q_report_hospital_bars,
    "report_bed_bars": q_report_bed_bars,
    "report_scatter": q_report_scatter,
    "report_kpis_stored": q_report_kpis_stored,
}
