"""


The queries are the package's composites run over the driver tables (see
``wardstat/plans/standins.py`` for which table stands in for which facility
file).  Un-rounded floating aggregates are rounded to 4-6 places in both
the query and the oracle, since summation order differs between engines.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardstat.plans import standins  # noqa: E402

try:  # the training-data operators and their pipeline are optional
    import corpus_pipeline
    from wardstat.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

_BAND_JOIN = (
    "from lineitem join supplier on l_suppkey=s_suppkey join nation on s_nationkey=n_nationkey "
    "where l_quantity>1 and l_quantity<15"
)
_STAFF_JOIN = "from lineitem join supplier on l_suppkey=s_suppkey join nation on s_nationkey=n_nationkey"
_HOURS = "round(sum(l_quantity),6)"
_RATIO = "round(avg(coalesce(nullif(l_quantity,1.0),0)/nullif(l_discount,0)),6)"
# two provider loads; the newer one holds two thirds of the facilities, every fifth of them twice
_LOADS = (
    "(select * from (select *, row_number() over (partition by CCN order by loaded desc, beds desc) as rn from ("
    "select c_custkey as CCN, c_name, c_nationkey + 1.0 as residents, c_acctbal * 2 as beds, 1 as loaded from customer "
    "union all select c_custkey, c_name, c_nationkey + 1.0, c_acctbal, 2 from customer where c_custkey % 3 <> 0 "
    "union all select c_custkey, c_name, c_nationkey + 1.0, c_acctbal + 100, 2 from customer "
    "where c_custkey % 3 <> 0 and c_custkey % 5 = 0) l) r where rn = 1)"
)
_LATEST_PURCHASE = (
    "(select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn "
    "from events where event_type='purchase') r where rn=1)"
)
_THROUGHPUT = (
    "select user_id, c_name, n_name as state, coalesce(value,0.0) as score, "
    "round(coalesce(value,0.0)/nullif(c_acctbal,0),2) as throughput "
    f"from {_LATEST_PURCHASE} s join customer on user_id=c_custkey join nation on c_nationkey=n_nationkey"
)

# text columns whose types are inferred
_TYPED = ("order no", "code", "price", "score", "big", "day", "moment", "open", "nothing", "o_orderpriority")
_MASTER_CSV = (
    "select PROVNUM, STATE, WorkDate, "
    "round(coalesce(hrs_rn,0)+coalesce(hrs_lpn,0)+coalesce(hrs_cna,0),6) as TotalNursing_Hours, "
    "round(case when census>0 then hrs_rn/census else 0 end,6) as RN_Ratio, "
    "round(case when census>0 then hrs_cna/census else 0 end,6) as CNA_Ratio, "
    "round(case when census>0 then hrs_lpn/census else 0 end,6) as LPN_Ratio "
    "from (select lpad(cast(l_suppkey as varchar),6,'0') as PROVNUM, upper(n_name) as STATE, "
    "cast(l_shipdate as date) as WorkDate, l_quantity as hrs_rn, l_tax as hrs_lpn, "
    "case when l_discount>0.05 then l_tax end as hrs_cna, l_discount as census, "
    "row_number() over (partition by l_suppkey, cast(l_shipdate as date) order by s_name, upper(n_name), "
    "l_quantity, l_quantity, l_tax, case when l_discount>0.05 then l_tax end nulls first, l_discount) as rn "
    f"{_STAFF_JOIN}) t where rn=1"
)

ORACLE_SQL: dict[str, str] = {
    "clean_strings": (
        "select c_custkey, upper(trim(concat('  ',lower(c_mktsegment),' '))) as segment, "
        "trim(concat(c_name,'  ')) as name from customer where nullif(c_custkey,7) is not null"
    ),
    "normalize_headers": (
        "select n_nationkey as CMS_Certification_Number_CCN, "
        "n_name as Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate, "
        'n_regionkey as "County/Parish" from nation'
    ),
    "cast_numeric_or_null": (
        "select p_partkey, try_cast(substr(p_brand,7) as double) as brand_no, "
        "try_cast(p_type as double) as type_no from part"
    ),
    "cast_numeric_or_default": (
        "select p_partkey, coalesce(try_cast(case when p_size>25 then p_brand else substr(p_brand,7) end "
        "as double),0.0) as score from part"
    ),
    "work_date": "select event_id, cast(ts as date) as work_date from events",
    "dedup_by_key": (
        "select l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice from (select *, row_number() over "
        "(partition by l_orderkey,l_linenumber order by l_shipdate,l_partkey,l_suppkey,l_extendedprice,"
        "l_quantity,l_discount,l_tax,l_returnflag,l_linestatus) as rn from lineitem) t where rn=1"
    ),
    "null_safe_total": (
        "select l_orderkey,l_linenumber,l_partkey, round(coalesce(nullif(l_quantity,1.0),0)"
        "+coalesce(nullif(l_discount,0.0),0)+coalesce(nullif(l_tax,0.0),0),6) as total_hours, "
        "round(coalesce(nullif(l_discount,0.0),0)+coalesce(nullif(l_tax,0.0),0),6) as admin_hours from lineitem"
    ),
    "guarded_ratio": (
        "select l_orderkey,l_linenumber,l_partkey, round(case when l_discount>0 then "
        "nullif(l_quantity,1.0)/l_discount else 0 end,6) as rn_ratio from lineitem"
    ),
    "changed_files": (
        "select l.user_id as file_id, l.modified from (select user_id, max(ts) as modified from events "
        "group by user_id) l left join (select user_id, max(ts) as seen from events "
        "where ts < timestamp '2024-01-30 12:00:00' group by user_id) b on l.user_id=b.user_id "
        "where l.modified > coalesce(b.seen, timestamp '1900-01-01 00:00:00')"
    ),
    "allow_listed_files": (
        "select doc_id, source, lang from documents where source in ('src0','src3','src5') "
        "and lang='en' and not (n_chars<100)"
    ),
    "silver_master": (
        "select l_suppkey, state, work_date, total_hours, round(case when census>0 then total_hours/census "
        "else 0 end,6) as ratio from (select l_suppkey, upper(trim(n_name)) as state, cast(l_shipdate as date) "
        "as work_date, coalesce(nullif(l_quantity,1.0),0)+coalesce(l_tax,0) as total_hours, l_discount as census, "
        "row_number() over (partition by l_suppkey, cast(l_shipdate as date) order by l_orderkey,l_linenumber,"
        f"l_partkey,l_extendedprice,l_quantity,l_discount,l_tax) as rn {_STAFF_JOIN}) t where rn=1"
    ),
    "onduty_hours_by_state_day": (
        "select n_name as state, cast(l_shipdate as date) as work_date, round(sum(l_quantity),6) as "
        f"total_rn_hours {_STAFF_JOIN} group by n_name, cast(l_shipdate as date)"
    ),
    "nurse_ratio_by_hospital": (
        "select s_suppkey, s_name, round(avg(coalesce(nullif(l_quantity,1.0),0)/nullif(l_discount,0)),6) "
        f"as avg_ratio {_STAFF_JOIN} group by s_suppkey, s_name"
    ),
    "nurse_ratio_by_state": (
        "select n_name as state, round(avg(coalesce(nullif(l_quantity,1.0),0)/nullif(l_discount,0)),6) "
        f"as avg_ratio {_STAFF_JOIN} group by n_name"
    ),
    "nurse_ratio_by_department": (
        "select l_tax as rn_ratio, l_linenumber as cna_ratio, round(avg(coalesce(nullif(l_quantity,1.0),0)"
        "/nullif(l_discount,0)),6) as avg_ratio from lineitem group by l_tax, l_linenumber"
    ),
    "latest_per_key": (
        "select user_id, event_id, ts, value from (select * from (select *, row_number() over "
        "(partition by user_id order by ts desc, event_id desc) as rn from events) r where rn=1) t"
    ),
    "latest_per_key_for_measure": f"select user_id, event_id, ts, value from {_LATEST_PURCHASE} t",
    "join_keep_left_columns": (
        "select c_custkey as custkey, c_name, c_acctbal, o_orderkey, o_totalprice "
        "from customer join orders on c_custkey=o_custkey"
    ),
    "bed_utilization_by_hospital": (
        "select c_name, n_name as state, round(avg(o_totalprice/nullif(c_acctbal,0)*100),2) as "
        "bed_utilization from customer join orders on c_custkey=o_custkey join nation on "
        "c_nationkey=n_nationkey group by c_name, n_name"
    ),
    "bed_utilization_by_department": (
        "select o_orderpriority, round(avg(o_totalprice/nullif(c_acctbal,0)*100),2) as bed_utilization "
        "from customer join orders on c_custkey=o_custkey group by o_orderpriority"
    ),
    "bed_utilization_preaggregated": (
        "select o_orderpriority, round(avg(c_nationkey/nullif(c_acctbal,0)*100),2) as bed_utilization "
        "from customer join orders on c_custkey=o_custkey group by o_orderpriority"
    ),
    "patient_throughput": _THROUGHPUT,
    "throughput_top10": (
        f"select user_id, c_name, throughput, state from ({_THROUGHPUT}) t where throughput is not null "
        "order by throughput desc, user_id limit 10"
    ),
    "staffing_band_detail": (
        "select l_orderkey,l_linenumber,l_partkey,s_name,n_name as state,l_quantity,"
        f"coalesce(nullif(l_tax,0.0),0.0) as readmission {_BAND_JOIN}"
    ),
    "staffing_readmission_corr": (
        f"select round(corr(l_quantity, coalesce(nullif(l_tax,0.0),0.0)),6) as correlation {_BAND_JOIN}"
    ),
    "staffing_readmission_corr_drop_missing": (
        f"select round(corr(l_quantity, nullif(l_tax,0.0)),6) as correlation, count(*) as n {_BAND_JOIN}"
    ),
    "ols_trend_by_state": (
        "select n_name as state, cast(regr_count(l_extendedprice,l_quantity) as bigint) as n, "
        "round(regr_slope(l_extendedprice,l_quantity),4) as slope, "
        "round(regr_intercept(l_extendedprice,l_quantity),4) as intercept, "
        f"round(regr_r2(l_extendedprice,l_quantity),6) as r2 {_BAND_JOIN} group by n_name"
    ),
    "facility_kpis_for_state": (
        f"select count(*) as facilities, round(avg(l_quantity),6) as avg_hours {_BAND_JOIN} "
        "and n_name='NATION_3'"
    ),
    "facility_kpis_all_states": f"select count(*) as facilities, round(avg(l_quantity),6) as avg_hours {_BAND_JOIN}",
    "facility_kpi_cards": (
        "select count(case when n_name='NATION_3' then 1 end) as facilities, "
        "round(avg(case when n_name='NATION_3' then l_quantity end),6) as avg_hours, "
        f"round(corr(l_quantity, coalesce(nullif(l_tax,0.0),0.0)),6) as correlation {_BAND_JOIN}"
    ),
    "total_onduty_hours": "select round(sum(l_quantity),2) as total_rn_hours from lineitem",
    "distinct_states": "select distinct n_name as state from nation where n_name is not null",
    "default_first_five": (
        "select s_suppkey, s_name from supplier where s_name in (select s_name from supplier "
        "order by s_name limit 5)"
    ),
    "hospitals_in_state": (
        "select distinct s_name from supplier join nation on s_nationkey=n_nationkey where n_name='NATION_3'"
    ),
    "select_hospitals": (
        "select s_suppkey, s_name, s_acctbal from supplier "
        "where s_name in ('Supplier#000000001','Supplier#000000007')"
    ),
    "preview_rows": (
        "select l_orderkey,l_linenumber,l_partkey,l_extendedprice from lineitem "
        "order by l_orderkey,l_linenumber,l_partkey,l_extendedprice limit 5000"
    ),
    "quality_checks": (
        "select 'row_count' as check_name, count(*) as n from lineitem "
        "union all select 'null_key', count(*) from lineitem where nullif(l_suppkey,7) is null "
        "union all select 'untrimmed', count(*) from customer where case when c_nationkey=3 then null "
        "when c_nationkey=4 then concat(c_mktsegment,' ') when c_nationkey=5 then concat(chr(9),c_mktsegment) "
        "when c_nationkey=6 then concat(c_mktsegment,chr(160)) else c_mktsegment end is distinct from "
        "trim(c_mktsegment) "
        "union all select 'duplicate_key', (select count(*) from lineitem) - (select count(*) from "
        "(select distinct l_orderkey,l_linenumber from lineitem) d)"
    ),
    "silver_provider_info": (
        "select lpad(cast(c_custkey as varchar),6,'0') as CMS_Certification_Number_CCN, c_name as Provider_Name, "
        "n_name as State, c_acctbal as Number_of_Certified_Beds, case when c_mktsegment='BUILDING' then null "
        "else c_acctbal/10 end as Average_Number_of_Residents_per_Day "
        "from customer join nation on c_nationkey=n_nationkey"
    ),
    "silver_facility_performance": (
        "select lpad(cast(s_suppkey as varchar),6,'0') as CMS_Certification_Number_CCN, s_name as Provider_Name, "
        "case when s_acctbal < 0 then null else s_acctbal/1000 end as "
        "Performance_Period_FY_2022_Risk_Standardized_Readmission_Rate, "
        "'CITY ' || cast(s_nationkey as varchar) as \"City/Town\" from supplier"
    ),
    "silver_skilled_nursing": (
        "select lpad(cast(user_id as varchar),6,'0') as CMS_Certification_Number_CCN, "
        "cast(event_id as varchar) as Row_Id, event_type as Measure_Code, "
        "case when event_type='error' then 0.0 else value end as Score from events"
    ),
    "silver_quality_mds": (
        "select lpad(cast(o_custkey as varchar),6,'0') as CMS_Certification_Number_CCN, "
        "cast(o_orderkey as varchar) as Measure_Row_Id, o_orderpriority as Resident_type from orders"
    ),
    "silver_quality_claims": (
        "select lpad(cast(o_custkey as varchar),6,'0') as CMS_Certification_Number_CCN, "
        "cast(o_orderkey as varchar) as Claim_Row, o_orderstatus as Measure_Status from orders"
    ),
    "silver_master_csv": _MASTER_CSV,
    "master_two_files": _MASTER_CSV,
    "csv_scan": "select l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate from lineitem",
    "roundtrip_append_replay": (
        "select o_orderkey, o_custkey, o_totalprice, case when o_orderstatus='F' then null "
        "else o_orderpriority end as o_orderpriority from orders"
    ),
    "roundtrip_overwrite": _THROUGHPUT,
    "staffing_rollups": " union all ".join(
        f"select '{name}' as summary, {keys}, {hours} as Total_RN_Hours, {ratio} as Avg_Nurse_Ratio "
        f"{_STAFF_JOIN} group by {group}"
        for name, hours, ratio, keys, group in (
            ("onduty_hours_summary", _HOURS, "cast(null as double)",
             "n_name as STATE, cast(l_shipdate as date) as WorkDate, cast(null as bigint) as PROVNUM, "
             "cast(null as varchar) as PROVNAME, cast(null as double) as RN_Ratio, cast(null as int) as CNA_Ratio",
             "n_name, cast(l_shipdate as date)"),
            ("ratio_by_hospital", "null", _RATIO, "null, null, s_suppkey, s_name, null, null", "s_suppkey, s_name"),
            ("ratio_by_state", "null", _RATIO, "n_name, null, null, null, null, null", "n_name"),
            ("ratio_by_department", "null", _RATIO, "null, null, null, null, l_tax, l_linenumber", "l_tax, l_linenumber"),
        )
    ),
    "bed_utilization_rollups": (
        "select 'utilization_by_hospital' as summary, c_name, n_name, cast(null as varchar) as o_orderpriority, "
        "round(avg(o_totalprice/nullif(c_acctbal,0)*100),2) as Bed_Utilization from customer join orders "
        "on c_custkey=o_custkey join nation on c_nationkey=n_nationkey group by c_name, n_name "
        "union all select 'utilization_by_department', null, null, o_orderpriority, "
        "round(avg(o_totalprice/nullif(c_acctbal,0)*100),2) from customer join orders on c_custkey=o_custkey "
        "join nation on c_nationkey=n_nationkey group by o_orderpriority"
    ),
    "streaming_landing": "select event_id, user_id, event_type, value from events",
    "intake_replay": "select event_id, user_id, event_type, value from events",
    "csv_mixed_headers": (
        "select o_orderkey, o_custkey, o_totalprice, case when o_orderstatus='F' then null "
        "else o_orderpriority end as o_orderpriority from orders"
    ),
    "csv_inferred_types": (
        "with t as (select cast(o_orderkey as varchar) as \"order no\", lpad(cast(o_custkey as varchar), 8, '0') as code, "
        "cast(o_totalprice as varchar) as price, case o_orderstatus when 'F' then 'Not Available' when 'P' then ' ' "
        "else cast(o_custkey * 1000000000 as varchar) end as score, "
        "case when o_orderstatus <> 'F' then cast(o_custkey * 1000000000 as varchar) end as big, "
        "strftime(o_orderdate, '%Y-%m-%d') as day, case when o_orderstatus = 'F' then "
        "strftime(o_orderdate, '%Y-%m-%d') else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as moment, case when o_orderstatus = 'O' then 'TRUE' else 'false' end as open, "
        "'' as nothing, o_orderpriority from orders), "
        "u as (" + " union all ".join(f"select '{c}' as name, \"{c}\" as raw from t" for c in _TYPED) + "), "
        "v as (select name, nullif(trim(raw), '') as v from u), "
        "n as (select name, count(v) as n_values, "
        "count(*) filter (where regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)') and try_cast(v as int) is not null) as n_int, "
        "count(*) filter (where regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)') and try_cast(v as bigint) is not null) as n_bigint, "
        "count(*) filter (where regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)([.][0-9]*)?([eE][+-]?[0-9]{1,3})?') "
        "and isfinite(try_cast(v as double))) as n_double, "
        "count(*) filter (where lower(v) in ('true', 'false')) as n_boolean, "
        "count(*) filter (where regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') and try_cast(v as date) is not null) as n_date, "
        "count(*) filter (where regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?') "
        "and try_cast(v as timestamp) is not null) as n_timestamp from v group by name) "
        "select *, case n_values when 0 then 'string' when n_int then 'int' when n_bigint then 'bigint' when n_double then 'double' "
        "when n_boolean then 'boolean' when n_date then 'date' when n_timestamp then 'timestamp' else 'string' end as type from n"
    ),
    "roundtrip_append_widened": (
        "select o_orderkey, o_custkey as cust, case o_orderstatus when 'F' then cast(o_orderkey % 100 as varchar) "
        "when 'O' then 'C' || o_orderkey else cast(o_orderkey as varchar) end as code, "
        "case o_orderstatus when 'F' then cast(cast(o_orderdate as date) as timestamp) when 'O' then o_orderdate end as day "
        "from orders where o_orderstatus in ('F', 'O', 'P')"
    ),
    "hours_stored_in_order": (
        "select n_name as state, cast(l_shipdate as date) as work_date, round(sum(l_quantity),6) as total_rn_hours "
        f"{_STAFF_JOIN} where cast(l_shipdate as date) between date '1995-01-01' and date '1995-12-31' "
        "group by n_name, cast(l_shipdate as date)"
    ),
    "bed_utilization_incremental": (
        "select o_orderpriority, round(avg(residents/nullif(beds,0)*100),2) as bed_utilization "
        f"from {_LOADS} p join orders on CCN=o_custkey group by o_orderpriority"
    ),
    "readmission_null_keys": (
        "select round(corr(l_quantity, cast(s_nationkey as double)),6) as correlation, count(*) as n from lineitem join supplier "
        "on nullif(l_suppkey,7) is not distinct from nullif(s_suppkey,7) where l_quantity>1 and l_quantity<15"
    ),
    "bed_utilization_hot_key": (
        "select o_orderpriority, round(avg(o_totalprice/nullif(beds,0)*100),2) as bed_utilization "
        f"from {_LOADS} p join orders on CCN=case when o_orderkey % 3 = 0 then 1 else o_custkey end group by o_orderpriority"
    ),
    "report_scatter_binned": (
        "with p as (select l_quantity as x, nullif(l_tax,0.0) as y "
        f"{_BAND_JOIN} and nullif(l_tax,0.0) is not null), "
        "f as (select regr_slope(y,x) as slope, regr_intercept(y,x) as intercept, regr_r2(y,x) as r2 from p) "
        "select least(greatest(floor(x/16.0::double*8),0),7)::int as x_bin, least(greatest(floor(y/0.08::double*8),0),7)::int as y_bin, "
        "count(*) as points, round(avg(x),6) as mean_x, round(avg(y),6) as mean_y, round(any_value(slope),6) as slope, "
        "round(any_value(intercept),6) as intercept, round(any_value(r2),6) as r2 from p, f group by 1, 2"
    ),
    "latest_snapshot": (
        "select CCN, c_name, beds, loaded from (select c_custkey as CCN, c_name, case when k = 4 then c_acctbal * 2 "
        "else c_acctbal + k end as beds, make_timestamp(2024, k + 1, 1, 0, 0, 0) as loaded, "
        "row_number() over (partition by c_custkey order by k desc) as rn "
        "from customer, range(5) r(k) where c_custkey % (k + 1) = 0) t where rn = 1"
    ),
    "bed_utilization_latest": (
        "select o_orderpriority, round(avg(residents/nullif(beds,0)*100),2) as bed_utilization "
        f"from {_LOADS} p join orders on CCN=o_custkey group by o_orderpriority"
    ),
    "throughput_latest": (
        "select user_id, beds, coalesce(value,0.0) as score, "
        "round(coalesce(value,0.0)/nullif(beds,0),2) as throughput "
        f"from {_LATEST_PURCHASE} s join {_LOADS} p on user_id=CCN"
    ),
    "readmission_latest": (
        "select round(corr(hours, rate),6) as correlation, count(*) as n from "
        f"(select beds/1000 as hours, residents + beds/5000 as rate from {_LOADS} p) t where hours>1 and hours<15"
    ),
    "report_total_hours": f"select round(sum(l_quantity),4) as Total_RN_Hours {_STAFF_JOIN}",
    "report_hours_series": (
        f"select n_name as state, cast(l_shipdate as date) as work_date, {_HOURS} as hours {_STAFF_JOIN} "
        "group by n_name, cast(l_shipdate as date)"
    ),
    "report_hospital_bars": (
        f"select s_suppkey as PROVNUM, s_name as PROVNAME, {_RATIO} as avg_ratio {_STAFF_JOIN} "
        "where s_name in (select s_name from lineitem join supplier on l_suppkey=s_suppkey group by s_name "
        "order by s_name limit 5) group by s_suppkey, s_name"
    ),
    "report_bed_bars": (
        "with b as (select c_name, n_name as State, round(avg(residents/nullif(beds,0)*100),2) as bed_utilization "
        f"from {_LOADS} p join orders on CCN=o_custkey join nation on n_nationkey=residents-1 "
        "where n_name='NATION_3' group by c_name, n_name) "
        "select * from b where c_name in (select c_name from b group by c_name order by c_name limit 5)"
    ),
    "report_scatter": (
        "select l_orderkey, l_linenumber, l_partkey, l_quantity, nullif(l_tax,0.0) as readmission "
        f"{_BAND_JOIN} and nullif(l_tax,0.0) is not null and n_name='NATION_3'"
    ),
    "report_kpis_stored": (
        "select count(*) filter (where s_nationkey=3) as facilities, "
        "round(avg(l_quantity) filter (where s_nationkey=3),4) as avg_hours, "
        "round(corr(l_quantity, coalesce(nullif(l_tax,0.0),0.0)),4) as correlation "
        "from lineitem join supplier on l_suppkey=s_suppkey where l_quantity>1 and l_quantity<15"
    ),
    "staffing_readmission_written": (
        "select round(corr(l_quantity, coalesce(nullif(l_tax,0.0),0.0)),6) as correlation "
        "from lineitem join supplier on l_suppkey=s_suppkey where l_quantity>1 and l_quantity<15"
    ),
}

ORACLE_SQL["staffing_rollups_incremental"] = ORACLE_SQL["staffing_rollups"]


def entry(spark: SparkSession) -> DataFrame:
    """
    latest record per facility, join, guarded ratio)."""
    return standins.q_patient_throughput(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(standins.QUERIES)
    if llm_queries is not None:
        out.update(llm_queries.QUERIES)
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """For each key in ``queries()``, equivalent SQL runnable by DuckDB on the
    same parquet tables."""
    out = {k: v for k, v in ORACLE_SQL.items() if k in standins.QUERIES}
    if llm_queries is not None:
        out.update(llm_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
