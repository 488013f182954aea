"""Report-layer analyses over the order star schema: basket affinity with
the top seller, new-product trend, rollup report, data-quality checks and
table reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_product(lineitem: DataFrame, part: str = "l_partkey", qty: str = "l_quantity") -> DataFrame:
    """The product with the largest total quantity (smallest key on ties).
    A top-1 report: partial top-1 per partition, then one merge."""
    totals = lineitem.groupBy(part).agg(F.sum(qty).alias("_q"))
    return totals.orderBy(F.col("_q").desc(), F.col(part).asc()).limit(1).select(part)


TASK_ROWS = 1_200_000    # order lines that a task sorts
DAYS = 100_000    # a day table has a row a day


def basket_affinity(lineitem: DataFrame, order: str = "l_orderkey", part: str = "l_partkey",
                    qty: str = "l_quantity", digits: int = 6) -> DataFrame:
    """Products bought together with the top seller.

    Orders holding the top seller are flagged, and products are counted over
    all and over flagged orders in one aggregate, so no pairs are formed and
    the work is linear in the data.  For each other product:
    ``co_orders``, ``support = co/all orders``, ``confidence = co/orders
    with top`` and ``lift = confidence / (orders with product / all)``.

    The lines are dealt by order into shares of about ``TASK_ROWS``, counted
    beforehand, so that a task's memory does not grow with the table.
    """
    top = top_product(lineitem, part, qty).scalar()
    lines = lineitem.select(order, part)
    shares = -(-lines.count() // TASK_ROWS) or 1
    # one layout and one sort by order and product serve the distinct pairs,
    # the flag whether the order holds the top seller, and the count of orders
    in_order = Window.partitionBy(order).orderBy(part)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    op = lines.repartition(shares, order).withColumn("_is_top", F.col(part) == top)
    flagged = (op.select(part, "_is_top", F.max("_is_top").over(whole).alias("_with_top"),
                         (F.row_number().over(in_order) == 1).alias("_first"),
                         F.lag(part).over(in_order).alias("_before"))
                 .where(F.col("_first") | ~F.col(part).eqNullSafe(F.col("_before"))))
    per_part = flagged.groupBy(part).agg(
        F.count(F.lit(1)).alias("part_orders"), F.count_if("_with_top").alias("co_orders"),
        F.bool_or("_is_top").alias("_is_top"), F.count_if("_first").alias("_orders"),
        F.count_if(F.col("_first") & F.col("_with_top")).alias("_top_orders"))
    # one row, read off the same aggregate
    totals = per_part.agg(F.struct(F.sum("_orders").alias("n"), F.sum("_top_orders").alias("top"))).scalar()
    j = (per_part.where(~F.col("_is_top") & (F.col("co_orders") > 0)).withColumn("_totals", totals))
    n_orders, n_top = F.col("_totals.n"), F.col("_totals.top")
    conf = F.col("co_orders") / n_top
    return j.select(
        part, "co_orders",
        F.round(F.col("co_orders") / n_orders, digits).alias("support"),
        F.round(conf, digits).alias("confidence"),
        F.round(conf / (F.col("part_orders") / n_orders), digits).alias("lift"),
    )


def new_product_trend(lineitem: DataFrame, part: str = "l_partkey", ts: str = "l_shipdate",
                      qty: str = "l_quantity") -> DataFrame:
    """Monthly quantity per product since its first sale, with the previous
    month's quantity and the growth ratio.

    Lines are first aggregated to (product, month) - map-side combined, so
    hot products shrink before the shuffle, fractions kept - and the window then runs over
    at most one row per month per product.
    """
    ym = (F.year(ts) * 12 + F.month(ts) - 1).alias("_ym")
    monthly = (lineitem.groupBy(part, ym)
                       .agg(F.sum(F.col(qty).cast("decimal(18,6)")).cast("double").alias("qty")))
    # one window spec (one sort): first month over the whole frame, lags
    w = Window.partitionBy(part).orderBy("_ym")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = monthly.select(part, "_ym", "qty",
                         F.min("_ym").over(whole).alias("_first"),
                         F.lag("_ym").over(w).alias("_prev_ym"),
                         F.lag("qty").over(w).alias("prev_qty"))
    growth = F.when(F.col("prev_qty") > 0,
                    F.round((F.col("qty") - F.col("prev_qty")) / F.col("prev_qty"), 4))
    return out.select(part, (F.col("_ym") - F.col("_first")).alias("month_no"), "qty",
                      (F.col("_prev_ym") - F.col("_first")).alias("prev_month_no"), "prev_qty",
                      growth.alias("growth"),
                      F.format_string("%04d-%02d", (F.col("_ym") / 12).cast("int"),
                                      (F.col("_ym") % 12 + 1).cast("int")).alias("month"))


def report_rollup(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                  region: DataFrame) -> DataFrame:
    """Order totals by region > nation > status with subtotals and grand
    total (ROLLUP).  Money is summed in integer cents so totals are exact."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    # one row a customer and status before the join, one a nation and status
    # before the names; only that small table is rolled up
    per_customer = orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents).alias("cents"))
    per_nation = (per_customer.join(customer.select("c_custkey", "c_nationkey"),
                                    F.col("o_custkey") == F.col("c_custkey"))
                              .groupBy("c_nationkey", "o_orderstatus").agg(F.sum("n").alias("n"),
                                                                           F.sum("cents").alias("cents")))
    return rollup_nations(per_nation, nation, region)


def rollup_nations(per_nation: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """The rollup of one row a nation and status (``c_nationkey``,
    ``o_orderstatus``, ``n``, ``cents``).  ``level`` = number of rolled-up
    columns (0 = detail, 3 = grand total)."""
    j = (per_nation.join(nation.select("n_nationkey", "n_name", "n_regionkey"),
                         F.col("c_nationkey") == F.col("n_nationkey"))
                   .join(region.select("r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")))
    return (j.rollup("r_name", "n_name", "o_orderstatus")
             .agg(F.sum("n").alias("n_orders"), F.sum("cents").alias("total_cents"),
                  F.grouping_id().alias("gid"))
             .withColumn("level", F.expr("bit_count(gid)").cast("int"))
             .drop("gid"))


def _checks(df: DataFrame, table: str, checks: dict) -> DataFrame:
    """One aggregation pass; ``checks`` maps name -> count expression.
    Output rows (table_name, check_name, n_bad)."""
    names = list(checks)
    agg = df.agg(*[checks[n].alias(f"_c{i}") for i, n in enumerate(names)])
    stack = "stack({n}, {items}) as (check_name, n_bad)".format(
        n=len(names), items=", ".join(f"'{n}', cast(_c{i} as bigint)" for i, n in enumerate(names)))
    return agg.selectExpr(f"'{table}' as table_name", stack)


def _one_check(n_bad: DataFrame, table: str, check: str) -> DataFrame:
    return n_bad.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
                        F.coalesce("n_bad", F.lit(0)).cast("bigint").alias("n_bad"))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key without nulls, as ``n_bad``."""
    whole = df.select(*keys).dropna()
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("n_bad"))


def orphans(child: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key, if any, has no parent, as ``n_bad``.  The keys
    are grouped first, so a hot key is one row in the join."""
    keys = child.where(F.col(foreign).isNotNull()).groupBy(foreign).agg(F.count(F.lit(1)).alias("n"))
    return (keys.join(parent.select(F.col(key).alias(foreign)), foreign, "left_anti")
                .agg(F.sum("n").alias("n_bad")))


def dq_checks(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
              customer: DataFrame) -> DataFrame:
    """Null, duplicate-key, orphan and range checks; one row per check.
    Null keys are counted by the null checks only."""
    li = _checks(lineitem, "lineitem", {
        "null_orderkey": F.count_if(F.col("l_orderkey").isNull()),
        "null_partkey": F.count_if(F.col("l_partkey").isNull()),
        "null_shipdate": F.count_if(F.col("l_shipdate").isNull()),
        "bad_quantity": F.count_if(F.col("l_quantity") <= 0),
        "bad_discount": F.count_if((F.col("l_discount") < 0) | (F.col("l_discount") > 1)),
        "bad_tax": F.count_if((F.col("l_tax") < 0) | (F.col("l_tax") > 1)),
    })
    o = _checks(orders, "orders", {
        "null_custkey": F.count_if(F.col("o_custkey").isNull()),
        "bad_totalprice": F.count_if(F.col("o_totalprice") < 0),
    })
    p = _checks(part, "part", {"bad_retailprice": F.count_if(F.col("p_retailprice") <= 0)})
    return reduce(DataFrame.unionByName, [
        li, o, p,
        _one_check(duplicates(lineitem, "l_orderkey", "l_linenumber"), "lineitem", "dup_key"),
        _one_check(duplicates(orders, "o_orderkey"), "orders", "dup_key"),
        _one_check(duplicates(part, "p_partkey"), "part", "dup_key"),
        _one_check(orphans(lineitem, "l_orderkey", orders, "o_orderkey"), "lineitem", "orphan_order"),
        _one_check(orphans(lineitem, "l_partkey", part, "p_partkey"), "lineitem", "orphan_part"),
        _one_check(orphans(orders, "o_custkey", customer, "c_custkey"), "orders", "orphan_customer"),
    ])


def reconcile(tables: dict) -> DataFrame:
    """Row count, key checksum and content checksum per table (``tables``:
    name -> (df, key)).

    The checksums are exact decimal sums, of the key and of a hash of all
    columns of a row, as text; the order of rows does not matter."""
    parts = []
    for name, (df, key) in tables.items():
        # map columns cannot be hashed; their JSON text can
        columns = [F.to_json(c) if t.startswith("map") else F.col(f"`{c}`") for c, t in df.dtypes]
        marked = F.xxhash64(*columns, *[c.isNull() for c in columns])
        parts.append(df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(F.col(key).cast("decimal(38,0)")).cast("string").alias("key_sum"),
            F.sum(marked.cast("decimal(38,0)")).cast("string").alias("row_sum"),
        ).select(F.lit(name).alias("table_name"), "n_rows", "key_sum", "row_sum"))
    return reduce(DataFrame.unionByName, parts)


def compare_copies(sources: dict, copies: dict) -> DataFrame:
    """Per table: row counts and key sums of source and copy, and ``in_sync``
    (counts, keys and contents agree).  Both as for :func:`reconcile`."""
    s = reconcile(sources).select("table_name", F.col("n_rows").alias("source_rows"),
                                  F.col("key_sum").alias("source_key_sum"), F.col("row_sum").alias("_s"))
    c = reconcile(copies).select("table_name", F.col("n_rows").alias("copy_rows"),
                                 F.col("key_sum").alias("copy_key_sum"), F.col("row_sum").alias("_c"))
    same = ((F.col("source_rows") == F.col("copy_rows")) & F.col("source_key_sum").eqNullSafe(F.col("copy_key_sum"))
            & F.col("_s").eqNullSafe(F.col("_c")))
    return (s.join(c, "table_name", "full_outer").withColumn("in_sync", F.coalesce(same, F.lit(False)))
             .drop("_s", "_c"))


def of_days(fact: DataFrame, days: DataFrame, day_col: str) -> DataFrame:
    """Rows of a table partitioned by ``day_col`` for the days of a (filtered)
    day table, with its columns.  The days become known when the query runs
    and prune the partitions before the scan; a day table of more than
    ``DAYS`` rows is not hinted as a broadcast."""
    few = days.select(day_col).limit(DAYS + 1).count() <= DAYS
    return fact.join(F.broadcast(days) if few else days, day_col)
