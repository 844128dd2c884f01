"""Nested documents derived from the flat tables.

Pages hold a fixed number of neighbouring rows of one scan partition, as a paged
export does. They are cut by place and not by key, so no value of a column can
make a page large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidegate.workload.registry import Tables

PAGE_BITS = 8


def as_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON text in the column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def parsed(texts: DataFrame, schema: str | StructType) -> DataFrame:
    return texts.select(F.from_json("value", schema).alias("document")).select("document.*")


def pages(rows: DataFrame, bits: int = PAGE_BITS) -> DataFrame:
    """One document per page of ``2 ** bits`` rows, which become the array ``results``."""
    numbered = rows.select(
        F.struct("*").alias("row"), F.shiftright(F.monotonically_increasing_id(), bits).alias("page")
    )
    return numbered.groupBy("page").agg(F.collect_list("row").alias("results"))


def iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def charges() -> Column:
    """A line's discount and tax where they are not zero: an array of none, one or two."""
    every = F.array(
        F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("rate")),
        F.struct(F.lit("tax").alias("kind"), F.col("l_tax").alias("rate")),
    )
    return F.filter(every, lambda charge: charge["rate"] != 0)


def order_documents(t: Tables) -> DataFrame:
    """One ledger document per line, its charges nested in its result. Made row by row, without a shuffle."""
    return t.lineitem.select(F.array(F.struct(
        F.struct(
            F.col("l_orderkey").alias("id"), F.struct(F.col("l_linenumber").alias("number")).alias("line")
        ).alias("order"),
        F.col("l_extendedprice").alias("price"),
        iso("l_shipdate").alias("shipped"),
        charges().alias("charges"),
    )).alias("results"))


LINE_PAGE = (
    "results array<struct<order: struct<id: bigint, line: struct<number: int>>, "
    "price: double, shipped: string, charges: array<struct<kind: string, rate: double>>>>"
)


LINE_DOCUMENT = (
    "order struct<id: bigint, number: int>, charges array<struct<kind: string, rate: double>>, marks array<string>"
)


def line_documents(t: Tables) -> DataFrame:
    """One document per line with two sibling arrays: its charges, and its two status marks."""
    return t.lineitem.select(
        F.struct(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("number")).alias("order"),
        charges().alias("charges"),
        F.array("l_returnflag", "l_linestatus").alias("marks"),
    )


def invoice_documents(t: Tables) -> DataFrame:
    """Ledger pages of one order each, linked to the customer as tenant.

    Orders in process have no invoice number yet, low-priority ones no customer.
    """
    in_process = F.col("o_orderstatus") == "P"
    result = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(~in_process, F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string"))).alias("invoiceNumber"),
        iso("o_orderdate").alias("issueDate"),
        F.lit("EUR").alias("currency"),
        F.col("o_totalprice").alias("totalAmount"),
        F.col("o_orderpriority").alias("status"),
        F.when(
            F.col("o_orderpriority") != "5-LOW",
            F.struct(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id")),
        ).alias("customerRef"),
        F.struct(in_process.alias("isDeleted")).alias("metadata"),
        F.array(
            F.struct(F.col("o_totalprice").alias("amount")), F.struct((F.col("o_totalprice") / 2).alias("amount"))
        ).alias("lines"),
    )
    link = F.concat(F.lit("/companies/"), F.col("o_custkey").cast("string"), F.lit("/orders"))
    return t.orders.select(
        F.struct(F.struct(link.alias("href")).alias("self")).alias("_links"),
        F.array(result).alias("results"),
    )
