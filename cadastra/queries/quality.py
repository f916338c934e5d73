"""Constraint reports, table writes and incremental ingest."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import quality as qu
from ..operators import sinks
from ..session import scratch_path
from ..sources import manifest
from ..streaming.incremental import ingest_parquet
from .base import Tables, day, micros, query


@query(
    "unique_report",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique_report(t: Tables):
    return qu.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "unique_where_report",
    """
    SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, count(*) AS n
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def unique_where_report(t: Tables):
    rows = t.orders.select("o_custkey", day("o_orderdate").alias("order_day"), "o_orderstatus")
    return qu.repeated_keys(rows, ["o_custkey", "order_day"], F.col("o_orderstatus") == "F")


@query(
    "check_report",
    """
    SELECT 'quantity range' AS rule, count(*) FILTER (NOT (l_quantity BETWEEN 1 AND 45)) AS violations FROM lineitem
    UNION ALL SELECT 'flag domain', count(*) FILTER (l_returnflag NOT IN ('A', 'R')) FROM lineitem
    UNION ALL SELECT 'status length', count(*) FILTER (length(l_linestatus) <> 1) FROM lineitem
    UNION ALL SELECT 'ship day known', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
    """,
)
def check_report(t: Tables):
    return qu.rule_report(
        t.lineitem,
        {
            "quantity range": F.col("l_quantity").between(1, 45),
            "flag domain": F.col("l_returnflag").isin("A", "R"),
            "status length": F.length("l_linestatus") == 1,
            "ship day known": F.col("l_shipdate").isNotNull(),
        },
    )


@query(
    "fk_report",
    """
    SELECT o_custkey, count(*) AS n FROM orders
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
    GROUP BY 1
    """,
)
def fk_report(t: Tables):
    return qu.orphans(t.orders, t.customer.filter("c_mktsegment <> 'BUILDING'"), "o_custkey", "c_custkey")


@query(
    "strict_append",
    """
    SELECT 'repeated in batch' AS outcome, CAST(count(*) > 0 AS BIGINT) AS n FROM (
      SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'repeated in table', CAST(count(*) > 0 AS BIGINT) FROM orders
    UNION ALL SELECT 'missing keys repeat', CAST(1 AS BIGINT)
    UNION ALL SELECT 'stored', count(*) FROM orders
    """,
)
def strict_append(t: Tables):
    """Clean batches are stored; one with repeated keys, of its own or of the table, is refused."""
    path = scratch_path(t.spark, "strict")
    half = F.col("o_orderkey") % 2 == 0
    orders = t.orders.withColumn("part", half)
    for batch in (orders.filter(half), orders.filter(~half)):
        sinks.append_strict(batch, path, ["o_orderkey"], within=F.col("part") == batch.first().part)

    def refused(batch, target, keys):
        try:
            sinks.append_strict(batch, target, keys)
        except qu.ConstraintError:
            return 1
        return 0

    blank = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey")).alias("key")
    outcomes = [
        ("repeated in batch", refused(t.lineitem, scratch_path(t.spark, "refused"), ["l_orderkey"])),
        ("repeated in table", refused(orders.filter(half), path, ["o_orderkey"])),
        ("missing keys repeat", refused(t.orders.select(blank), scratch_path(t.spark, "refused"), ["key"])),
    ]
    stored = t.spark.read.parquet(path).agg(F.lit("stored").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return t.spark.createDataFrame(outcomes, "outcome string, n long").unionByName(stored)


@query(
    "saved_tables",
    """
    SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day
    FROM orders WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1
    """,
)
def saved_tables(t: Tables):
    """Bucketed table, rebuilt view, job slice and a query with bound parameters."""
    folder = scratch_path(t.spark, "saved")
    name = f"saved_orders_{folder[-16:]}"
    bucketed = sinks.save_bucketed(t.orders, name, "o_custkey", f"{folder}/orders")

    def totals(tables):
        # Bucketed on the grouping key: no shuffle.
        return {
            "totals": tables["orders"].filter("o_orderdate >= DATE '1997-01-01'").groupBy("o_custkey").agg(
                F.count(F.lit(1)).alias("orders"),
                F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
                F.max("o_orderdate").alias("last_order"),
            )
        }

    def skipped(tables):
        raise AssertionError("outside the slice")

    jobs = [(1, "skipped", skipped), (2, "totals", totals), (3, "skipped", skipped)]
    made = sinks.run_jobs(
        jobs, {"orders": bucketed}, run_from=2, run_till=2,
        save=lambda table, df: sinks.rebuild(df, f"{folder}/{table}"),
    )
    made["totals"].createOrReplaceTempView(f"totals_{folder[-16:]}")
    return sinks.query_table(
        t.spark,
        f"""SELECT o_custkey, orders, cents, CAST(CAST(last_order AS DATE) AS STRING) AS last_day
            FROM totals_{folder[-16:]} WHERE orders >= :least""",
        least=1,
    )


@query(
    "incremental_ingest",
    "SELECT event_id, user_id, event_type, epoch_us(ts) AS at_us, value FROM events",
)
def incremental_ingest(t: Tables):
    """Files taken in by a stream that is started twice; the second run and repeated keys add nothing."""
    folder = scratch_path(t.spark, "stream")
    events = t.events
    events.repartition(4, "event_id").write.parquet(f"{folder}/in")
    for _ in range(2):
        ingest_parquet(t.spark, f"{folder}/in", events.schema, f"{folder}/out", f"{folder}/marks", ["event_id"], ["ts"])
        # The same rows published again under other file names.
        events.repartition(3, "user_id").write.mode("append").parquet(f"{folder}/in")
    out = t.spark.read.schema(events.schema).parquet(f"{folder}/out")
    return out.select("event_id", "user_id", "event_type", micros("ts").alias("at_us"), "value")


_MANIFEST_SQL = """
    WITH f AS (
      SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS published_year, CAST(o_orderdate AS DATE) AS d,
        CASE WHEN o_orderkey % 10 = 0 THEN '/ps/plain_' || o_orderkey || '.DAT'
             WHEN o_orderkey % 10 = 1 THEN '/ps/x_' || strftime(o_orderdate, '%d%m%Y') || '-checkpoint.DAT'
             ELSE '/ps/' || o_orderkey || '_' || strftime(o_orderdate, '%d%m%Y') || '.DAT' END AS file_path
      FROM orders)
"""


def _files(t: Tables):
    stamp = "date_format(o_orderdate, 'ddMMyyyy')"
    return t.orders.select(
        "o_orderkey",
        F.year("o_orderdate").alias("published_year"),
        F.expr(
            f"""CASE WHEN o_orderkey % 10 = 0 THEN '/ps/plain_' || o_orderkey || '.DAT'
                 WHEN o_orderkey % 10 = 1 THEN '/ps/x_' || {stamp} || '-checkpoint.DAT'
                 ELSE '/ps/' || o_orderkey || '_' || {stamp} || '.DAT' END"""
        ).alias("file_path"),
    )


@query(
    "manifest_filter",
    _MANIFEST_SQL
    + """
    SELECT 'bounded' AS bounds, o_orderkey, file_path, CAST(d AS VARCHAR) AS download_day FROM f
    WHERE o_orderkey % 10 > 1 AND published_year BETWEEN 1996 AND 1999 AND d BETWEEN DATE '1996-07-01' AND DATE '1999-03-31'
    UNION ALL
    SELECT 'open', o_orderkey, file_path, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(d AS VARCHAR) END FROM f
    WHERE o_orderkey % 10 <> 1
    """,
)
def manifest_filter(t: Tables):
    bounded = manifest.select_files(_files(t), 1996, 1999, date(1996, 7, 1), date(1999, 3, 31))
    free = manifest.select_files(_files(t))
    both = bounded.withColumn("bounds", F.lit("bounded")).unionByName(free.withColumn("bounds", F.lit("open")))
    return both.select("bounds", "o_orderkey", "file_path", day("download_date").alias("download_day"))


@query(
    "snapshot_select",
    """
    WITH o AS (SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS m FROM orders),
    d AS (SELECT DISTINCT m FROM o), top AS (SELECT max(m) AS t, min(m) AS f FROM d),
    s AS (SELECT m, row_number() OVER (ORDER BY m DESC) - 1 AS i FROM d, top WHERE month(m) = month(t)),
    modes AS (
      SELECT 'all' AS mode, m FROM d UNION ALL SELECT 'latest', t FROM top
      UNION ALL SELECT 'each-year', m FROM s UNION ALL SELECT 'every-2nd-year', m FROM s WHERE i % 2 = 0
      UNION ALL SELECT 'every-3rd-first', m FROM s WHERE i % 3 = 0
      UNION ALL SELECT 'every-3rd-first', f FROM top WHERE f NOT IN (SELECT m FROM s WHERE i % 3 = 0)
      UNION ALL SELECT 'these-years', m FROM s WHERE year(m) IN (1996, 1999))
    SELECT mode, CAST(m AS VARCHAR) AS month, count(*) AS n FROM modes JOIN o USING (m) GROUP BY 1, 2
    """,
)
def snapshot_select(t: Tables):
    rows = t.orders.select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("m"))
    modes = {
        "all": manifest.SNAPSHOT_MODES["all"],
        "latest": manifest.SNAPSHOT_MODES["latest"],
        "each-year": manifest.SNAPSHOT_MODES["each-year"],
        "every-2nd-year": manifest.SNAPSHOT_MODES["every-2nd-year"],
        "every-3rd-first": {"every": 3, "include_first": True},
        "these-years": {"every": 1, "years": {1996, 1999}},
    }
    out = None
    for name, mode in modes.items():
        part = manifest.select_snapshots(rows, "m", **mode).groupBy("m").agg(F.count(F.lit(1)).alias("n"))
        part = part.select(F.lit(name).alias("mode"), F.col("m").cast("string").alias("month"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "append_by_kind",
    """
    SELECT o_orderstatus AS kind, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS batch FROM orders
    WHERE o_orderstatus IN ('F', 'O')
    """,
)
def append_by_kind(t: Tables):
    """Two batches that share half of their records, to one table per kind; the kind without a table is dropped."""
    folder = scratch_path(t.spark, "kinds")
    targets = {kind: f"{folder}/{kind}" for kind in ("F", "O")}
    rows = t.orders.select(F.col("o_orderstatus").alias("kind"), "o_orderkey")
    for number, part in ((1, rows.filter("o_orderkey % 2 = 0")), (2, rows)):
        sinks.append_by_kind(part.withColumn("batch", F.lit(number)), "kind", targets, ["o_orderkey"])
    return t.spark.read.parquet(*targets.values())


@query(
    "checked_load",
    """
    SELECT 'rows' AS rule, count(*) AS n, sum(l_orderkey) AS stored FROM lineitem
    UNION ALL SELECT 'discount below quantity', count(*) FILTER (NOT (l_discount * 100 < l_quantity)), sum(l_orderkey) FROM lineitem
    UNION ALL SELECT 'returned before 1996', count(*) FILTER (l_returnflag = 'R' AND year(l_shipdate) >= 1996), sum(l_orderkey) FROM lineitem
    UNION ALL SELECT 'has a key', 0, sum(l_orderkey) FROM lineitem
    """,
)
def checked_load(t: Tables):
    """Rules counted in the pass that writes the table, beside what is stored then; a strict load of it is refused and changes nothing."""
    path = scratch_path(t.spark, "checked")
    rules = {
        "discount below quantity": F.col("l_discount") * 100 < F.col("l_quantity"),
        "returned before 1996": (F.col("l_returnflag") != "R") | (F.year("l_shipdate") < 1996),
        "has a key": F.col("l_orderkey").isNotNull(),
    }
    found = sinks.load_checked(t.lineitem, path, rules, strict=False)
    try:
        sinks.load_checked(t.lineitem.filter("l_quantity > 10"), path, {"few": F.col("l_quantity") <= 10})
    except qu.ConstraintError:
        pass
    stored = t.spark.read.parquet(path).agg(F.sum("l_orderkey").alias("stored"))
    counts = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(n).cast("long").alias("n")) for k, n in found.items()])
    return stored.select(F.inline(counts), "stored")
