"""Row shaping and row checks (P4-P12, A1, Q1-Q7, S8, S9, scalar functions)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from tidegate import functions as fn
from tidegate.operators import quality, shape
from tidegate.plans.ingest import parsed_once
from tidegate.session import new_folder
from tidegate.sources.database import read_query
from tidegate.sources.files import read_json, with_source
from tidegate.sources.partitions import folders_after
from tidegate.sources.routing import add_route
from tidegate.sources.rules import read_rules, rules_from_frame
from tidegate.spec import RuleSpec
from tidegate.workload.registry import Tables, query


@query("lineage_stamp", """
    SELECT s_suppkey, s_name, 'job_1' AS job_id, 'in/suppliers.json' AS file_name, '2024-09-15' AS file_load_dt
    FROM supplier
""")
def lineage_stamp(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", "s_name")
    return shape.stamp_lineage(rows, "job_1", "in/suppliers.json", "2024-09-15")


@query("pad_project_rename", """
    SELECT c_custkey AS customer_id, c_mktsegment AS segment, '' AS region_code, c_acctbal AS balance FROM customer
""")
def pad_project_rename(t: Tables) -> DataFrame:
    projected = shape.pad_and_project(t.customer, ["c_custkey", "c_mktsegment", "c_region", "c_acctbal"])
    names = {"c_custkey": "customer_id", "c_mktsegment": "segment", "c_region": "region_code",
             "c_acctbal": "balance", "c_unknown": "ignored"}
    return shape.rename(projected, names)


MIXED_TEXT = """
    CASE event_type WHEN 'error' THEN 'n/a' WHEN 'view' THEN '' ELSE CAST(value AS VARCHAR) END
"""


@query("declared_cast", """
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value END AS amount,
           CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d') END AS day,
           CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_no
    FROM events
""")
def declared_cast(t: Tables) -> DataFrame:
    texts = _texts(t)
    typed = shape.cast_declared(texts, {"amount": "double", "day": "date", "user_no": "integer"})
    return typed.withColumn("day", fn.iso_date(F.col("day")))


def _texts(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.select(
        "event_id",
        F.when(kind == "error", "n/a").when(kind == "view", "").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(kind == "click", fn.iso_date(F.col("ts"))).otherwise("soon").alias("day"),
        F.when(kind == "signup", "u").otherwise(F.col("user_id").cast("string")).alias("user_no"),
    )


@query("cast_failures", """
    SELECT count(*) FILTER (event_type = 'error') AS amount,
           count(*) FILTER (event_type <> 'click') AS day,
           count(*) FILTER (event_type = 'signup') AS user_no
    FROM events
""")
def cast_failures(t: Tables) -> DataFrame:
    return shape.cast_failures(_texts(t), {"amount": "double", "day": "date", "user_no": "integer"})


@query("tenant_from_link", """
    SELECT page_id, coalesce(regexp_extract_all(url, '[^/]+')[2], '') AS company_id FROM pages
""")
def tenant_from_link(t: Tables) -> DataFrame:
    return shape.add_tenant(t.pages.select("page_id", "url"), "url")


@query("tenant_of_file", """
    SELECT event_id, event_type AS company_id FROM events
""")
def tenant_of_file(t: Tables) -> DataFrame:
    """One id per file, from its first row; a file holds the events of one type."""
    folder = new_folder(t.spark, "events-by-type")
    link = F.concat(F.lit("/companies/"), "event_type", F.lit("/"), F.col("user_id").cast("string"))
    t.events.select("event_id", "event_type", link.alias("link")).write.partitionBy("event_type").json(folder)
    raw = parsed_once(with_source(read_json(t.spark, f"{folder}/*", "event_id bigint, link string"), ordered=True))
    tenants = shape.file_tenants(raw, "link")
    return shape.add_file_tenant(raw, tenants, "link").select("event_id", "company_id")


@query("import_date_parts", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS import_date, strftime(o_orderdate, '%d') AS import_day,
           strftime(o_orderdate, '%m') AS import_month, strftime(o_orderdate, '%Y') AS import_year
    FROM orders
""")
def import_date_parts(t: Tables) -> DataFrame:
    path = F.concat(F.lit("raw/orders_"), fn.compact_date(F.col("o_orderdate")), F.lit("/part.json"))
    return shape.add_import_date(t.orders.select("o_orderkey", path.alias("path")), F.col("path")).drop("path")


@query("dedup_rows", "SELECT DISTINCT * FROM lineitem")
def dedup_rows(t: Tables) -> DataFrame:
    """Every line repeated as often as its line number says, then each once."""
    copies = t.lineitem.withColumn("copy", F.explode(F.sequence(F.lit(1), "l_linenumber"))).drop("copy")
    return shape.drop_duplicates(copies)


@query("dedup_ignoring_lineage", "SELECT DISTINCT l_partkey, l_suppkey, 'job_1' AS job_id FROM lineitem")
def dedup_ignoring_lineage(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_partkey", "l_suppkey").withColumn("job_id", F.lit("job_1"))
    return shape.drop_duplicates(rows, ignore=["job_id"])


def _customers(t: Tables) -> DataFrame:
    """Customers whose segment or balance may be missing."""
    return t.customer.select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )


CUSTOMERS = """
    (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
            CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)
"""


@query("null_check_flag", f"""
    SELECT c_custkey, segment, balance, (segment IS NULL OR balance IS NULL) AS null_check_result FROM {CUSTOMERS}
""")
def null_check_flag(t: Tables) -> DataFrame:
    return quality.flag_missing(_customers(t), quality.parse_column_list("segment, balance"))


@query("quarantine_split", f"""
    SELECT c_custkey, segment, balance,
           CASE WHEN segment IS NULL OR balance IS NULL THEN 'quarantined' ELSE 'loaded' END AS outcome
    FROM {CUSTOMERS}
""")
def quarantine_split(t: Tables) -> DataFrame:
    good, bad = quality.split_rows(quality.flag_missing(_customers(t), ["segment", "balance"]))
    return good.withColumn("outcome", F.lit("loaded")).unionByName(bad.withColumn("outcome", F.lit("quarantined")))


RULES = [
    RuleSpec(1, ("segment",)),
    RuleSpec(2, ("balance",)),
    RuleSpec(3, ("segment", "balance")),
    RuleSpec(4, ("c_custkey",)),
]


@query("rule_violations", f"""
    SELECT CAST(1 AS BIGINT) AS rule_id, count(*) FILTER (segment IS NULL) AS violations FROM {CUSTOMERS}
    UNION ALL SELECT 2, count(*) FILTER (balance IS NULL) FROM {CUSTOMERS}
    UNION ALL SELECT 3, count(*) FILTER (segment IS NULL OR balance IS NULL) FROM {CUSTOMERS}
    UNION ALL SELECT 4, count(*) FILTER (c_custkey IS NULL) FROM {CUSTOMERS}
""")
def rule_violations(t: Tables) -> DataFrame:
    """Rules come from a written rule document."""
    folder = new_folder(t.spark, "rules")
    rules = [{"rule_id": r.rule_id, "rule_type": r.rule_type, "columns": list(r.columns)} for r in RULES]
    document = json.dumps({"dq_id": 1, "rules": rules}, indent=1)
    t.spark.range(1).select(F.lit(document).alias("value")).write.text(folder)
    return quality.count_violations(_customers(t), rules_from_frame(read_rules(t.spark, folder)))


@query("rule_check_rows", f"""
    SELECT c_custkey,
           concat_ws(',', CASE WHEN segment IS NULL THEN '1' END, CASE WHEN balance IS NULL THEN '2' END,
                     CASE WHEN segment IS NULL OR balance IS NULL THEN '3' END) AS broken
    FROM {CUSTOMERS}
""")
def rule_check_rows(t: Tables) -> DataFrame:
    checked = quality.check_rules(_customers(t), RULES)
    return checked.select("c_custkey", F.array_join("violated_rules", ",").alias("broken"))


@query("load_metrics", f"""
    SELECT count(*) AS total_record_count, count(*) FILTER (segment IS NOT NULL AND balance IS NOT NULL) AS load_record_count,
           count(*) FILTER (segment IS NULL OR balance IS NULL) AS error_record_count
    FROM {CUSTOMERS}
""")
def load_metrics(t: Tables) -> DataFrame:
    return quality.load_metrics(quality.flag_missing(_customers(t), ["segment", "balance"]))


ROUTED_KEY = """
    concat('in/', CASE o_orderpriority WHEN '1-URGENT' THEN 'BALANCESHEET_transaction' WHEN '2-HIGH' THEN 'tpsclaims'
                       WHEN '3-MEDIUM' THEN 'Supplier_invoices' WHEN '4-NOT SPECIFIED' THEN 'codat_BillPayments'
                       ELSE 'other' END,
           '_', o_orderstatus, '_', CAST(o_orderkey AS VARCHAR), '.json')
"""


@query("route_files", f"""
    SELECT key,
           CASE WHEN lower(key) LIKE '%balancesheet%' THEN 'BalanceSheet' WHEN lower(key) LIKE '%tpsclaims%' THEN 'TPSClaims'
                WHEN lower(key) LIKE '%tpspayments%' THEN 'TPSPayments' WHEN lower(key) LIKE '%profitandloss%' THEN 'profitAndLoss'
                WHEN lower(key) LIKE '%invoices%' THEN 'Invoices' WHEN lower(key) LIKE '%paymnt%' THEN 'Paymnt'
                WHEN lower(key) LIKE '%supplier%' THEN 'Supplier' WHEN lower(key) LIKE '%transaction%' THEN 'transaction'
                WHEN lower(key) LIKE '%codat\\_bills%' ESCAPE '\\' THEN 'Codat_bills'
                WHEN lower(key) LIKE '%codat\\_billpayments%' ESCAPE '\\' THEN 'Codat_billPayments' END AS dataset,
           CASE WHEN lower(key) LIKE '%balancesheet%' THEN 'balance_sheet' WHEN lower(key) LIKE '%tpsclaims%' THEN 'trizetto_claims'
                WHEN lower(key) LIKE '%invoices%' THEN 'invoice' WHEN lower(key) LIKE '%codat\\_billpayments%' ESCAPE '\\'
                THEN 'codat_billPayments' END AS spec
    FROM (SELECT {ROUTED_KEY} AS key FROM orders)
""")
def route_files(t: Tables) -> DataFrame:
    token = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "BALANCESHEET_transaction")
        .when(F.col("o_orderpriority") == "2-HIGH", "tpsclaims")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Supplier_invoices")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "codat_BillPayments")
        .otherwise("other")
    )
    key = F.concat(
        F.lit("in/"), token, F.lit("_"), "o_orderstatus", F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".json")
    )
    return add_route(t.orders.select(key.alias("key")), "key")


@query("incremental_partitions", """
    SELECT DISTINCT concat('raw/import_date=', strftime(o_orderdate, '%Y%m%d')) AS folder
    FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) > 19960101
""")
def incremental_partitions(t: Tables) -> DataFrame:
    path = F.concat(
        F.lit("raw/import_date="), fn.compact_date(F.col("o_orderdate")), F.lit("/part-"), F.col("o_orderkey"), F.lit(".json")
    )
    return folders_after(t.orders.select(path.alias("path")), "path", "19960101")


@query("load_slice", """
    SELECT l_returnflag AS company_name, l_linestatus AS level_name,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS bal_amt
    FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') = '1998-09-15' GROUP BY ALL
""")
def load_slice(t: Tables) -> DataFrame:
    """A load-date slice through SQL, with the date as a parameter; the filter reaches the scan."""
    t.lineitem.createOrReplaceTempView("tidegate_stage_lines")
    return read_query(
        t.spark,
        "SELECT l_returnflag AS company_name, l_linestatus AS level_name, "
        "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS bal_amt "
        "FROM tidegate_stage_lines "
        "WHERE l_shipdate >= CAST(:load_date AS TIMESTAMP_NTZ) "
        "AND l_shipdate < CAST(:load_date AS TIMESTAMP_NTZ) + INTERVAL 1 DAY "
        "GROUP BY l_returnflag, l_linestatus",
        load_date="1998-09-15",
    )


@query("concat_key", """
    SELECT c_custkey, concat_ws('$$', n_name, nullif(c_mktsegment, 'BUILDING'), c_name) AS key
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def concat_key(t: Tables) -> DataFrame:
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    parts = [F.col("n_name"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("c_name")]
    return joined.select("c_custkey", fn.concat_key(parts).alias("key"))


@query("scalar_misc", """
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y%m%d') AS day,
           CASE WHEN value > 10 THEN 'YES' ELSE 'NO' END AS large,
           string_split(concat(event_type, ',', CAST(user_id AS VARCHAR)), ',')[2] AS second,
           regexp_replace(concat('a/', event_type, '/', CAST(event_id AS VARCHAR)), '/[^/]*$', '') AS parent
    FROM events
""")
def scalar_misc(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    return t.events.select(
        "event_id",
        fn.compact_timestamp(F.col("ts")).alias("stamp"),
        fn.compact_date(F.col("ts")).alias("day"),
        F.when(F.col("value") > 10, "YES").otherwise("NO").alias("large"),
        F.element_at(fn.split_list(F.concat_ws(",", "event_type", user)), 2).alias("second"),
        fn.parent_folder(F.concat_ws("/", F.lit("a"), "event_type", F.col("event_id").cast("string"))).alias("parent"),
    )
