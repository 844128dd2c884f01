"""Daily totals and history merges (A2, J1-J3, Q6, H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.operators import history as ops
from tidegate.plans.history_load import create_history, load_history, read_history
from tidegate.session import new_folder
from tidegate.spec import HistorySpec
from tidegate.specs import DAILY_BALANCE
from tidegate.workload.registry import Tables, query

KEYS = ("customer", "priority", "state")
VALUE = "amount"
RUN_DATE = "2024-09-15"

STAGE_SQL = """
    SELECT o_custkey AS customer, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, o_orderstatus AS state,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
    FROM orders GROUP BY ALL
"""
# What the table holds before the run: nothing for orders in process, an outdated
# amount for open ones, the right amount and an older version for finished ones.
HISTORY_SQL = f"""
    SELECT customer, priority, state, CAST(CASE WHEN state = 'O' THEN amount - 1 ELSE amount END AS DECIMAL(28,2)) AS amount,
           'N' AS flag_del, '9999-12-31' AS last_updt_dt FROM ({STAGE_SQL}) WHERE state <> 'P'
    UNION ALL
    SELECT customer, priority, state, amount - 5, 'Y', '2024-01-31' FROM ({STAGE_SQL}) WHERE state = 'F'
"""
COLUMNS = "customer, priority, state, CAST(amount AS DOUBLE) AS amount, flag_del, last_updt_dt"
NEW_SQL = f"""
    SELECT customer, priority, state, amount, 'N' AS flag_del, '9999-12-31' AS last_updt_dt FROM ({STAGE_SQL}) s
    WHERE NOT EXISTS (SELECT 1 FROM ({HISTORY_SQL}) h WHERE h.customer IS NOT DISTINCT FROM s.customer
                      AND h.priority IS NOT DISTINCT FROM s.priority AND h.state IS NOT DISTINCT FROM s.state)
"""
PAIRS_SQL = f"""
    SELECT s.customer, s.priority, s.state, s.amount AS new_amount, h.amount AS old_amount
    FROM ({STAGE_SQL}) s JOIN ({HISTORY_SQL}) h
      ON h.customer IS NOT DISTINCT FROM s.customer AND h.priority IS NOT DISTINCT FROM s.priority
     AND h.state IS NOT DISTINCT FROM s.state
    WHERE h.flag_del = 'N' AND h.amount <> s.amount
"""
UPDATED_SQL = f"""
    SELECT customer, priority, state, new_amount AS amount, 'N' AS flag_del, '9999-12-31' AS last_updt_dt
    FROM ({PAIRS_SQL})
"""
EXPIRED_SQL = f"""
    SELECT customer, priority, state, old_amount AS amount, 'Y' AS flag_del, '{RUN_DATE}' AS last_updt_dt
    FROM ({PAIRS_SQL})
"""
MERGED_SQL = f"""
    SELECT {COLUMNS} FROM ({NEW_SQL}) UNION ALL SELECT {COLUMNS} FROM ({UPDATED_SQL})
    UNION ALL SELECT {COLUMNS} FROM ({EXPIRED_SQL})
    UNION ALL SELECT {COLUMNS} FROM ({HISTORY_SQL}) WHERE flag_del = 'Y' OR state = 'F'
"""


def stage_rows(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("customer"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def stage_totals(t: Tables) -> DataFrame:
    return ops.grouped_sum(stage_rows(t), KEYS, VALUE)


def history_before(t: Tables) -> DataFrame:
    totals = stage_totals(t)
    amount, state = F.col("amount"), F.col("state")
    current = totals.where(state != "P").withColumns({
        "amount": F.when(state == "O", amount - 1).otherwise(amount).cast("decimal(28,2)"),
        "flag_del": F.lit("N"),
        "last_updt_dt": F.lit("9999-12-31"),
    })
    expired = totals.where(state == "F").withColumns({
        "amount": (amount - 5).cast("decimal(28,2)"),
        "flag_del": F.lit("Y"),
        "last_updt_dt": F.lit("2024-01-31"),
    })
    return current.unionByName(expired)


def as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


@query("daily_sum", """
    SELECT l_returnflag AS company_name, l_linestatus AS level_name, l_suppkey AS acc_id,
           strftime(l_shipdate, '%Y-%m-%d') AS bal_dt, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS bal_amt
    FROM lineitem GROUP BY ALL
""")
def daily_sum(t: Tables) -> DataFrame:
    # Grouped by the timestamp and turned to text after the sum: the text is made per group, not per line.
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("company_name"),
        F.col("l_linestatus").alias("level_name"),
        F.col("l_suppkey").alias("acc_id"),
        F.col("l_shipdate").cast("date").alias("bal_dt"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("bal_amt"),
    )
    summed = ops.grouped_sum(rows, ["company_name", "level_name", "acc_id", "bal_dt"], "bal_amt")
    return summed.withColumns({
        "bal_dt": F.date_format("bal_dt", "yyyy-MM-dd"),
        "bal_amt": F.col("bal_amt").cast("double"),
    })


@query("scd2_new", f"SELECT {COLUMNS} FROM ({NEW_SQL})")
def scd2_new(t: Tables) -> DataFrame:
    return as_double(ops.new_rows(stage_totals(t), history_before(t), KEYS))


@query("scd2_updated", f"SELECT {COLUMNS} FROM ({UPDATED_SQL})")
def scd2_updated(t: Tables) -> DataFrame:
    return as_double(ops.updated_rows(stage_totals(t), history_before(t), KEYS, VALUE))


@query("scd2_expired", f"SELECT {COLUMNS} FROM ({EXPIRED_SQL})")
def scd2_expired(t: Tables) -> DataFrame:
    return as_double(ops.expired_rows(stage_totals(t), history_before(t), KEYS, VALUE, RUN_DATE))


@query("scd2_merged", MERGED_SQL)
def scd2_merged(t: Tables) -> DataFrame:
    return as_double(ops.merge_history(stage_totals(t), history_before(t), KEYS, VALUE, RUN_DATE))


@query("scd2_changes", f"""
    SELECT {COLUMNS}, 'new' AS change FROM ({NEW_SQL}) UNION ALL SELECT {COLUMNS}, 'updated' FROM ({UPDATED_SQL})
    UNION ALL SELECT {COLUMNS}, 'expired' FROM ({EXPIRED_SQL})
""")
def scd2_changes(t: Tables) -> DataFrame:
    """All three outputs of a run from one comparison."""
    return as_double(ops.history_changes(stage_totals(t), history_before(t), KEYS, VALUE, RUN_DATE))


@query("scd2_concat_key", f"""
    SELECT customer, priority, state, CAST(amount AS DOUBLE) AS amount
    FROM ({STAGE_SQL}) s
    WHERE concat_ws('$$', customer, priority, state) NOT IN
          (SELECT concat_ws('$$', customer, priority, state) FROM ({HISTORY_SQL}))
""")
def scd2_concat_key(t: Tables) -> DataFrame:
    """New rows under the joined-text key."""
    return as_double(ops.unknown_rows(stage_totals(t), history_before(t), KEYS, "concat"))


COLLIDING_SQL = """
    SELECT o_custkey AS customer, o_orderstatus AS state, bool_or(o_orderkey % 2 = 1) AS odd,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
    FROM orders GROUP BY ALL
"""


@query("scd2_merged_concat", f"""
    SELECT customer, CASE WHEN NOT odd THEN state END AS first_state, CASE WHEN odd THEN state END AS second_state,
           CAST(amount AS DOUBLE) AS amount, 'N' AS flag_del, '9999-12-31' AS last_updt_dt FROM ({COLLIDING_SQL})
    UNION ALL
    SELECT customer, state, NULL, CAST(amount - 1 AS DOUBLE), 'Y', '{RUN_DATE}' FROM ({COLLIDING_SQL}) WHERE state = 'F'
""")
def scd2_merged_concat(t: Tables) -> DataFrame:
    """Keys that differ by column but join to one text: one current row and one expired row for each text."""
    keys = ("customer", "first_state", "second_state")
    even = F.col("o_orderkey") % 2 == 0
    rows = t.orders.select(
        F.col("o_custkey").alias("customer"),
        F.when(even, F.col("o_orderstatus")).alias("first_state"),
        F.when(~even, F.col("o_orderstatus")).alias("second_state"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    stage = ops.grouped_sum(rows, keys, VALUE, key_style="concat")
    state = F.coalesce("first_state", "second_state")
    history = stage.where(state == "F").select(
        "customer", state.alias("first_state"), F.lit(None).cast("string").alias("second_state"),
        (F.col("amount") - 1).cast(stage.schema["amount"].dataType).alias("amount"),
        F.lit("N").alias("flag_del"), F.lit("9999-12-31").alias("last_updt_dt"),
    )
    return as_double(ops.merge_history(stage, history, keys, VALUE, RUN_DATE, "concat"))


@query("compare_amounts", f"""
    SELECT s.customer, s.priority, s.state,
           CASE WHEN s.amount <> h.amount THEN 'YES' ELSE 'NO' END AS is_due_amt_updated
    FROM ({STAGE_SQL}) s LEFT JOIN (SELECT * FROM ({HISTORY_SQL}) WHERE flag_del = 'N') h
      ON h.customer IS NOT DISTINCT FROM s.customer AND h.priority IS NOT DISTINCT FROM s.priority
     AND h.state IS NOT DISTINCT FROM s.state
""")
def compare_amounts(t: Tables) -> DataFrame:
    pairs = ops.compare_rows(stage_totals(t), ops.current_rows(history_before(t)), KEYS)
    return pairs.select(
        "new.customer", "new.priority", "new.state",
        ops.changed(F.col("new.amount"), F.col("old.amount")).alias("is_due_amt_updated"),
    )


@query("history_load", MERGED_SQL)
def history_load(t: Tables) -> DataFrame:
    """The same merge through written tables: changes first, then the parts they touch."""
    spec = HistorySpec(KEYS, VALUE, partition_column="state")
    path, export = new_folder(t.spark, "history"), new_folder(t.spark, "changes")
    create_history(history_before(t), path, spec)
    load_history(t.spark, stage_rows(t), path, spec, RUN_DATE, "day_20240915", export)
    return as_double(read_history(t.spark, path))


BALANCE_SQL = """
    SELECT o_orderstatus AS company_name, o_orderpriority AS level_name, CAST(o_custkey % 50 AS VARCHAR) AS acc_id,
           CAST(NULL AS VARCHAR) AS acc_name, strftime(o_orderdate, '%Y-%m-01') AS bal_dt,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS old_amt,
           sum(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS new_amt
    FROM orders GROUP BY ALL
"""


@query("history_daily_balance", f"""
    SELECT company_name, level_name, acc_id, acc_name, bal_dt, CAST(new_amt AS DOUBLE) AS bal_amt, 'N' AS flag_del,
           '9999-12-31' AS last_updt_dt FROM ({BALANCE_SQL})
    UNION ALL
    SELECT company_name, level_name, acc_id, acc_name, bal_dt, CAST(old_amt AS DOUBLE), 'Y', '2024-09-16'
    FROM ({BALANCE_SQL}) WHERE company_name = 'O'
""")
def history_daily_balance(t: Tables) -> DataFrame:
    """The declared daily balance over two days: orders in process come on the second, open ones change."""
    path, export = new_folder(t.spark, "balance"), new_folder(t.spark, "changes")
    open_order = F.col("o_orderstatus") == "O"
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    rows = t.orders.select(
        F.col("o_orderstatus").alias("company_name"),
        F.col("o_orderpriority").alias("level_name"),
        (F.col("o_custkey") % 50).cast("string").alias("acc_id"),
        F.lit(None).cast("string").alias("acc_name"),
        F.date_format("o_orderdate", "yyyy-MM-01").alias("bal_dt"),
        amount.alias("bal_amt"),
        (amount + F.when(open_order, 1).otherwise(0)).alias("later"),
    )
    first = rows.where("company_name <> 'P'").drop("later")
    second = rows.drop("bal_amt").withColumnRenamed("later", "bal_amt")
    for day, stage in (("2024-09-15", first), ("2024-09-16", second)):
        load_history(t.spark, stage, path, DAILY_BALANCE, day, f"day_{day}", export)
    return read_history(t.spark, path).withColumn("bal_amt", F.col("bal_amt").cast("double"))


@query("history_export", f"""
    SELECT 'new' AS change, {COLUMNS} FROM ({NEW_SQL}) UNION ALL SELECT 'updated', {COLUMNS} FROM ({UPDATED_SQL})
    UNION ALL SELECT 'expired', {COLUMNS} FROM ({EXPIRED_SQL})
""")
def history_export(t: Tables) -> DataFrame:
    """What a load leaves for readers downstream, read back from its folder."""
    spec = HistorySpec(KEYS, VALUE, partition_column="state")
    path, export = new_folder(t.spark, "history"), new_folder(t.spark, "changes")
    create_history(history_before(t), path, spec)
    result = load_history(t.spark, stage_rows(t), path, spec, RUN_DATE, "day_20240915", export)
    return as_double(t.spark.read.parquet(result.changes_path))


@query("history_empty_slice", f"SELECT {COLUMNS} FROM ({HISTORY_SQL})")
def history_empty_slice(t: Tables) -> DataFrame:
    """A stage slice without rows changes nothing."""
    spec = HistorySpec(KEYS, VALUE, partition_column="state")
    path, export = new_folder(t.spark, "history"), new_folder(t.spark, "changes")
    create_history(history_before(t), path, spec)
    none = stage_rows(t).where(F.col("customer") < 0)
    load_history(t.spark, none, path, spec, RUN_DATE, "day_20240915", export)
    return as_double(read_history(t.spark, path))
