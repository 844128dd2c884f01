"""Flattening (P1-P3) and JSON scans (S1, S2)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.flatten import flatten, flatten_separately, flatten_structs
from tidegate.plans.ingest import ingest, read_child
from tidegate.session import new_folder
from tidegate.sinks import files as sink
from tidegate.sources.files import read_json, read_json_multiline
from tidegate.specs import SET_A
from tidegate.workload import documents as docs
from tidegate.workload.registry import Tables, query

LINE_CHARGES = """
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag, l_linestatus,
           'discount' AS kind, l_discount AS rate FROM lineitem WHERE l_discount <> 0
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag, l_linestatus,
           'tax', l_tax FROM lineitem WHERE l_tax <> 0
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag, l_linestatus,
           NULL, NULL FROM lineitem WHERE l_discount = 0 AND l_tax = 0
"""


@query("flatten_order_docs", f"""
    SELECT l_orderkey AS results_order_id, l_linenumber AS results_order_line_number,
           l_extendedprice AS results_price, strftime(l_shipdate, '%Y-%m-%d') AS results_shipped,
           kind AS results_charges_kind, rate AS results_charges_rate
    FROM ({LINE_CHARGES})
""")
def flatten_order_docs(t: Tables) -> DataFrame:
    return flatten(docs.parsed(docs.as_json(docs.order_documents(t)), docs.LINE_PAGE))


@query("flatten_structs", """
    SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS customer_home_nation,
           c_acctbal AS balance
    FROM customer
""")
def flatten_struct_levels(t: Tables) -> DataFrame:
    nested = t.customer.select(
        F.struct(
            F.col("c_custkey").alias("key"),
            F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("nation")).alias("home"),
        ).alias("customer"),
        F.col("c_acctbal").alias("balance"),
    )
    return flatten_structs(nested)


@query("flatten_sibling_arrays", f"""
    SELECT l_orderkey AS order_id, l_linenumber AS order_number, kind AS charges_kind, rate AS charges_rate, marks
    FROM (SELECT *, l_returnflag AS marks FROM ({LINE_CHARGES})
          UNION ALL SELECT *, l_linestatus FROM ({LINE_CHARGES}))
""")
def flatten_sibling_arrays(t: Tables) -> DataFrame:
    return flatten(docs.parsed(docs.as_json(docs.line_documents(t)), docs.LINE_DOCUMENT))


@query("flatten_separate_arrays", f"""
    SELECT '' AS part, l_orderkey AS order_id, l_linenumber AS order_number, NULL AS position, NULL AS item FROM lineitem
    UNION ALL
    SELECT 'charges', l_orderkey, l_linenumber,
           CASE WHEN kind = 'tax' AND l_discount <> 0 THEN 1 ELSE 0 END, kind
    FROM (SELECT l_orderkey, l_linenumber, l_discount, 'discount' AS kind FROM lineitem WHERE l_discount <> 0
          UNION ALL SELECT l_orderkey, l_linenumber, l_discount, 'tax' FROM lineitem WHERE l_tax <> 0)
    UNION ALL
    SELECT 'marks', l_orderkey, l_linenumber, 0, l_returnflag FROM lineitem
    UNION ALL
    SELECT 'marks', l_orderkey, l_linenumber, 1, l_linestatus FROM lineitem
""")
def flatten_separate_arrays(t: Tables) -> DataFrame:
    # One scan per child table, each of only its own array.
    folder = new_folder(t.spark, "line-documents")
    docs.as_json(docs.line_documents(t)).write.text(folder)
    nested = read_json(t.spark, folder, docs.LINE_DOCUMENT)
    keys = ["order_id", "order_number"]
    tables = flatten_separately(nested, keys)
    none = F.lit(None)
    parts = [
        tables[""].select(F.lit("").alias("part"), *keys, none.cast("int").alias("position"),
                          none.cast("string").alias("item")),
        tables["charges"].select(F.lit("charges").alias("part"), *keys, F.col("charges_position").alias("position"),
                                 F.col("charges_kind").alias("item")),
        tables["marks"].select(F.lit("marks").alias("part"), *keys, F.col("marks_position").alias("position"),
                               F.col("marks").alias("item")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("flatten_leaf_names", """
    SELECT c_custkey AS key, c_acctbal AS amount, word, n_name AS nation, r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
         unnest(string_split(c_name, '#')) AS words(word)
""")
def flatten_leaf_names(t: Tables) -> DataFrame:
    nested = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.struct(F.col("c_custkey").alias("key"), F.struct(F.col("c_acctbal").alias("amount")).alias("balance"))
            .alias("customer"),
            F.split("c_name", "#").alias("word"),
            F.struct(F.col("n_name").alias("nation"), F.col("r_name").alias("region")).alias("place"),
        )
    )
    return flatten(nested, naming="leaf")


@query("flatten_nested_arrays", """
    SELECT doc_id AS id, lang AS origin_lang, count(*) AS words, CAST(sum(length(word)) AS BIGINT) AS characters
    FROM documents, unnest(string_split(text, chr(10))) AS p(paragraph), unnest(string_split(paragraph, ' ')) AS w(word)
    GROUP BY doc_id, lang
""")
def flatten_nested_arrays(t: Tables) -> DataFrame:
    nested = t.documents.select(
        F.col("doc_id").alias("id"),
        F.struct("lang", "source").alias("origin"),
        F.transform(
            F.split("text", "\n"), lambda line: F.struct(F.split(line, " ").alias("words"))
        ).alias("paragraphs"),
    )
    flat = flatten(nested)
    return flat.groupBy("id", "origin_lang").agg(
        F.count("*").alias("words"), F.sum(F.length("paragraphs_words").cast("bigint")).alias("characters")
    )


EVENT_PROPS = "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events"


@query("json_props", EVENT_PROPS)
def json_props(t: Tables) -> DataFrame:
    """Documents written one per line and scanned again."""
    folder = new_folder(t.spark, "events-json")
    with_props = t.events.select("event_id", "user_id", F.from_json("props", "k bigint").alias("props"))
    with_props.write.json(folder)
    return flatten(read_json(t.spark, folder, "event_id bigint, user_id bigint, props struct<k: bigint>"))


@query("multiline_scan", "SELECT c_custkey AS results_key, c_name AS results_name, c_acctbal AS results_balance FROM customer")
def multiline_scan(t: Tables) -> DataFrame:
    """One pretty-printed document per file, a page of customers each."""
    folder = new_folder(t.spark, "customer-pages")
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    paged = docs.pages(customers, 11).select(F.to_json(F.struct("results"), {"pretty": "true"}).alias("value"))
    paged.write.option("maxRecordsPerFile", 1).text(folder)
    schema = "results array<struct<key: bigint, name: string, balance: double>>"
    return flatten(read_json_multiline(t.spark, folder, schema))


# Bank feeds of an order: one account or two, and up to three transactions.
FEED_ACCOUNTS = (("concat('A', CAST(o_custkey AS VARCHAR(20)))", "true"), ("concat('B', CAST(o_custkey AS VARCHAR(20)))", "o_custkey % 2 = 0"))
FEED_PAYMENTS = tuple((f"concat('T', CAST(o_orderkey AS VARCHAR(20)), '-{n}')", f"o_orderkey % 4 > {n}") for n in range(3))


def bank_feeds(t: Tables) -> DataFrame:
    """A document for each order; one in eight has neither account nor transaction."""
    def elements(pairs, made) -> Column:
        listed = F.array(*[F.when(F.expr(f"o_orderkey % 8 <> 0 AND {when}"), made(F.expr(key))) for key, when in pairs])
        return F.filter(listed, lambda x: x.isNotNull())

    account = F.col("o_custkey").cast("string")
    return t.orders.select(
        elements(FEED_ACCOUNTS, lambda key: F.struct(key.alias("account_id"), account.alias("name"))).alias("accounts"),
        elements(FEED_PAYMENTS, lambda key: F.struct(
            account.alias("account_id"), F.col("o_totalprice").alias("amount"), key.alias("transaction_id"),
            F.array(F.lit("a"), F.col("o_orderstatus")).alias("category"),
        )).alias("transactions"),
        F.struct(F.struct(F.concat(F.lit("/companies/"), F.col("o_orderkey").cast("string")).alias("href")).alias("self")).alias("_links"),
    )


@query("transactions_separate", " UNION ALL ".join([
    *[f"""SELECT 'accounts' AS child, CAST(o_orderkey AS VARCHAR) AS company_id, {key} AS id, CAST(NULL AS DOUBLE) AS amount, NULL AS category
          FROM orders WHERE o_orderkey % 8 <> 0 AND {when}""" for key, when in FEED_ACCOUNTS],
    *[f"""SELECT 'transactions', CAST(o_orderkey AS VARCHAR), {key}, CAST(o_totalprice AS DOUBLE), {category}
          FROM orders WHERE o_orderkey % 8 <> 0 AND {when}""" for key, when in FEED_PAYMENTS for category in ("'a'", "o_orderstatus")],
    "SELECT 'quarantined', CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM orders WHERE o_orderkey % 8 = 0",
]))
def transactions_separate(t: Tables) -> DataFrame:
    """The shipped bank feed with its two arrays loaded separately, in one scan and one write."""
    spec = replace(SET_A["transactions"], arrays="separate").repaired()
    folder, root = new_folder(t.spark, "feeds"), new_folder(t.spark, "staging")
    docs.as_json(bank_feeds(t)).write.text(folder)
    ingest(t.spark, spec, folder, "job_1", root, load_date="2024-09-15")
    accounts, payments = (read_child(t.spark, root, spec, child) for child in ("accounts", "transactions"))
    none = F.lit(None)
    return (
        accounts.select(F.lit("accounts").alias("child"), "company_id", F.col("acc_id").alias("id"),
                        none.cast("double").alias("amount"), none.cast("string").alias("category"))
        .unionByName(payments.select(F.lit("transactions").alias("child"), "company_id", F.col("trans_id").alias("id"),
                                     F.col("trans_amt").alias("amount"), F.col("trans_cat").alias("category")))
        .unionByName(sink.read_loads(t.spark, root, sink.QUARANTINED).select(
            F.lit("quarantined").alias("child"), "company_id", F.col("acc_id").alias("id"),
            F.col("trans_amt").alias("amount"), F.col("trans_cat").alias("category")))
    )
