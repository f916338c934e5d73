"""One row per key, histories, aggregates and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.codes import normalised_id
from ..functions.values import completeness
from ..operators import aggregates as ag
from ..operators import history as hi
from ..operators import joins as jo
from ..operators.keys import newest
from ..operators.sinks import new_rows
from ..plans import analytics
from .base import Tables, day, micros, query

CUTOFFS = [date(y, 1, 1) for y in range(1996, 2002)]


@query(
    "latest_per_key",
    """
    SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, o_totalprice
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1
    """,
)
def latest_per_key(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    kept = hi.latest(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return kept.select("o_custkey", "o_orderkey", day("o_orderdate").alias("order_day"), "o_totalprice")


@query(
    "best_complete_row",
    """
    WITH q AS (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1),
    r AS (
      SELECT o_custkey, o_orderkey, o_orderdate, quantity,
             CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS price,
             CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority
      FROM orders LEFT JOIN q ON l_orderkey = o_orderkey)
    SELECT o_custkey, o_orderkey, quantity, price, priority,
           CAST((quantity IS NOT NULL)::INT + (price IS NOT NULL)::INT + (priority IS NOT NULL)::INT AS INTEGER) AS score
    FROM r
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
      (quantity IS NOT NULL)::INT + (price IS NOT NULL)::INT + (priority IS NOT NULL)::INT DESC,
      o_orderdate DESC NULLS FIRST, o_orderkey) = 1
    """,
)
def best_complete_row(t: Tables):
    quantity = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity")
    )
    rows = t.orders.join(quantity, "o_orderkey", "left").select(
        "o_custkey", "o_orderkey", "o_orderdate", "quantity",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    score = completeness("quantity", "price", "priority")
    kept = hi.best_row(rows, ["o_custkey"], score, "o_orderdate", ["o_orderkey"])
    return kept.drop("o_orderdate").withColumn("score", score)


@query(
    "asof_snapshots",
    """
    WITH c AS (SELECT make_date(CAST(y AS BIGINT), 1, 1) AS cutoff FROM range(1996, 2002) r(y))
    SELECT CAST(cutoff AS VARCHAR) AS cutoff, o_custkey, o_orderkey,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, o_totalprice
    FROM c JOIN orders ON CAST(o_orderdate AS DATE) <= cutoff
    QUALIFY row_number() OVER (PARTITION BY cutoff, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
)
def asof_snapshots(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    snaps = hi.as_of(rows, ["o_custkey"], "o_orderdate", CUTOFFS, ["o_orderkey"])
    return snaps.select(
        F.col("cutoff").cast("string").alias("cutoff"), "o_custkey", "o_orderkey",
        day("o_orderdate").alias("order_day"), "o_totalprice",
    )


@query(
    "first_sighting",
    """
    SELECT user_id, event_type, event_id, epoch_us(ts) AS first_us FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
)
def first_sighting(t: Tables):
    rows = t.events.select("user_id", "event_type", "event_id", "ts")
    kept = hi.first_sighting(rows, ["user_id", "event_type"], "ts", ["event_id"])
    return kept.select("user_id", "event_type", "event_id", micros("ts").alias("first_us"))


@query(
    "unpivot_history",
    """
    WITH l AS (
      SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, 'quantity' AS measure, l_quantity AS v FROM lineitem
      UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, 'price', l_extendedprice FROM lineitem
      UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, 'discount', l_discount FROM lineitem
      UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, 'tax', CASE WHEN l_tax > 0 THEN l_tax END FROM lineitem
      UNION ALL SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, 'supplier', CAST(l_suppkey AS DOUBLE) FROM lineitem)
    SELECT l_partkey, measure, v, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day FROM l WHERE v IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY l_partkey, measure
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, v DESC) = 1
    """,
)
def unpivot_history(t: Tables):
    values = t.lineitem.select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate",
        F.col("l_quantity").alias("v1"), F.col("l_extendedprice").alias("v2"), F.col("l_discount").alias("v3"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("v4"), F.col("l_suppkey").cast("double").alias("v5"),
    )
    newest = hi.newest_known(values, ["l_partkey"], [f"v{i}" for i in range(1, 6)], "l_shipdate", ["l_orderkey", "l_linenumber"])
    names = ("quantity", "price", "discount", "tax", "supplier")
    wide = newest.withColumns({f"m{i}": F.lit(name) for i, name in enumerate(names, 1)})
    groups = [{"measure": f"m{i}", "v": f"v{i}"} for i in range(1, 6)]
    long = hi.unpivot(wide, ["l_partkey", "l_orderkey", "l_linenumber", "l_shipdate"], groups)
    kept = hi.latest(
        long.filter(F.col("v").isNotNull()), ["l_partkey", "measure"], "l_shipdate",
        ["l_orderkey", "l_linenumber", "v"],
    )
    return kept.select("l_partkey", "measure", "v", day("l_shipdate").alias("ship_day"))


@query(
    "concat_fragments",
    """
    SELECT conv_id, string_agg(text, '' ORDER BY turn) AS whole_text, arg_min(role, turn) AS first_role
    FROM conversations GROUP BY conv_id
    """,
)
def concat_fragments(t: Tables):
    return ag.concat_in_order(
        t.conversations, ["conv_id"], "text", "turn", "whole_text", F.min_by("role", "turn").alias("first_role")
    )


@query(
    "participants_array",
    """
    SELECT c_custkey, coalesce(types, '') AS event_types
    FROM customer LEFT JOIN (
      SELECT user_id, string_agg(event_type || '*' || n, ',' ORDER BY event_type) AS types
      FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY user_id)
    ON user_id = c_custkey
    """,
)
def participants_array(t: Tables):
    types = ag.value_runs(
        t.events.select(F.col("user_id").alias("c_custkey"), "event_type"), ["c_custkey"], "event_type", "types"
    )
    text = F.array_join(F.transform("types", lambda r: F.concat(r["value"], F.lit("*"), r["n"].cast("string"))), ",")
    joined = t.customer.select("c_custkey").join(types, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce(text, F.lit("")).alias("event_types"))


@query(
    "union_identifiers",
    """
    SELECT c_nationkey AS nation FROM customer WHERE c_nationkey IS NOT NULL
    UNION SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL
    UNION SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL
    """,
)
def union_identifiers(t: Tables):
    return jo.distinct_union(
        [(t.customer, "c_nationkey"), (t.supplier, "s_nationkey"), (t.nation, "n_nationkey")], "nation"
    )


@query(
    "idempotent_append",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'held' ELSE 'added' END AS state
    FROM orders
    """,
)
def idempotent_append(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    held = rows.filter(F.col("o_orderdate") < F.lit(date(1998, 1, 1)))
    batch = rows.unionByName(rows)
    added = new_rows(batch, held, ["o_orderkey"], ["o_custkey", "o_orderdate"])
    both = held.withColumn("state", F.lit("held")).unionByName(added.withColumn("state", F.lit("added")))
    return both.drop("o_orderdate")


@query(
    "unseen_only",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    """,
)
def unseen_only(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    flagged = jo.with_seen_flag(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), returned, ["o_orderkey"], "seen")
    return flagged.filter(~F.col("seen")).drop("seen")


@query(
    "anti_join",
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount >= 0.1 AND l_tax >= 0.08)
    """,
)
def anti_join(t: Tables):
    dear = t.lineitem.filter("l_discount >= 0.1 AND l_tax >= 0.08").select(F.col("l_partkey").alias("p_partkey"))
    return jo.unseen(t.part.select("p_partkey", "p_name"), dear, ["p_partkey"])


_UNITS_SQL = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 5 END AS unit FROM orders"


@query(
    "null_safe_join",
    f"""
    WITH u AS ({_UNITS_SQL}), g AS (SELECT o_custkey, unit, count(*) AS n FROM u GROUP BY 1, 2)
    SELECT u.o_orderkey, u.o_custkey, u.unit, n, u.o_custkey || '/' || coalesce(u.unit, -1) AS normalised
    FROM u JOIN g ON u.o_custkey = g.o_custkey AND u.unit IS NOT DISTINCT FROM g.unit
    """,
)
def null_safe_join(t: Tables):
    units = t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 5).alias("unit")
    )
    sizes = units.groupBy("o_custkey", "unit").agg(F.count(F.lit(1)).alias("n"))
    joined = jo.null_safe_join(units, sizes, ["o_custkey", "unit"])
    key = normalised_id("o_custkey", "unit")
    text = F.concat_ws("/", key["property_id"].cast("string"), key["strata_lot_num"].cast("string"))
    return joined.withColumn("normalised", text)


@query(
    "dim_two_key_lookup",
    """
    WITH f AS (
      SELECT c_custkey, r_name, CASE WHEN c_custkey % 10 <> 0 THEN n_name END AS n_name
      FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
    SELECT c_custkey, r.r_regionkey, n.n_nationkey
    FROM f LEFT JOIN region r USING (r_name)
    LEFT JOIN nation n ON n.n_name = f.n_name AND n.n_regionkey = r.r_regionkey
    """,
)
def dim_two_key_lookup(t: Tables):
    nation = t.nation.withColumnRenamed("n_regionkey", "r_regionkey")
    facts = (
        t.customer.join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, "r_regionkey")
        .select("c_custkey", "r_name", F.when(F.col("c_custkey") % 10 != 0, F.col("n_name")).alias("n_name"))
    )
    found = jo.two_step_lookup(facts, t.region, nation, "r_name", "r_regionkey", "n_name")
    return found.select("c_custkey", "r_regionkey", "n_nationkey")


@query(
    "percentile_by_group",
    """
    SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95
    FROM lineitem GROUP BY 1, 2
    """,
)
def percentile_by_group(t: Tables):
    out = ag.group_percentile(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.95, "p95")
    return out.withColumn("p95", F.round("p95", 6))


_ALL = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _ALL))
def table_counts(t: Tables):
    return ag.table_counts({name: getattr(t, name) for name in _ALL})


@query(
    "calendar_histogram",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
    FROM orders WHERE o_orderdate > DATE '1900-01-01' AND o_orderdate < DATE '2024-12-01' GROUP BY 1, 2
    """,
)
def calendar_histogram(t: Tables):
    return analytics.observation_counts(t.orders, "o_orderdate", date(1900, 1, 1), date(2024, 12, 1))


@query(
    "range_by_group",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, spread
    FROM lineitem JOIN (
      SELECT l_orderkey, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY 1) USING (l_orderkey)
    WHERE spread > 0
    """,
)
def range_by_group(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return ag.varying_groups(rows, ["l_orderkey"], "l_quantity")


@query(
    "completion_ratio",
    """
    SELECT event_type, count(*) FILTER (value >= 10) AS done, count(*) AS total,
           round(count(*) FILTER (value >= 10) / count(*), 6) AS ratio
    FROM events GROUP BY 1
    """,
)
def completion_ratio(t: Tables):
    done = (F.col("value") >= 10).cast("long")
    out = ag.completion(t.events, ["event_type"], F.coalesce(done, F.lit(0)), F.lit(1).cast("long"))
    return out.withColumn("ratio", F.round("ratio", 6))


@query(
    "ntile_segments",
    """
    WITH s AS (SELECT CAST(o_orderdate AS DATE) AS d, ntile(8) OVER (ORDER BY o_orderdate, o_orderkey) AS segment FROM orders)
    SELECT segment, CAST(min(d) AS VARCHAR) AS start_date, CAST(max(d) AS VARCHAR) AS end_date,
           count(*) AS count_in_segment
    FROM s GROUP BY 1
    """,
)
def ntile_segments(t: Tables):
    out = analytics.observation_segments(t.orders, "o_orderdate", 8)
    return out.select(
        F.col("segment").cast("bigint").alias("segment"), day("start_date").alias("start_date"),
        day("end_date").alias("end_date"), "count_in_segment",
    )


@query(
    "rank_values",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank() OVER (ORDER BY l_extendedprice) AS rank FROM lineitem",
)
def rank_values(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return ag.global_rank(rows, "l_extendedprice")


TRAIL_SECONDS, TRAIL_DEPTH = 2 * 86400, 4


@query(
    "trailing_rate",
    f"""
    WITH e AS (
      SELECT event_id, user_id, value, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    w AS (
      SELECT *, min(i) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN {TRAIL_SECONDS}000000 PRECEDING AND CURRENT ROW) AS a FROM e),
    k AS (SELECT event_id, user_id, value, t, i, greatest(a, i - {TRAIL_DEPTH - 1}) AS j FROM w)
    SELECT k.event_id, k.user_id, CAST(k.i - k.j + 1 AS INTEGER) AS window_rows,
           round(CASE WHEN k.t = e.t THEN 0 ELSE (k.value - e.value) / ((k.t - e.t) / 1000000.0) END, 9) AS rate
    FROM k JOIN e ON e.user_id = k.user_id AND e.i = k.j
    """,
)
def trailing_rate(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = hi.trailing_rate(rows, ["user_id"], "ts", "value", TRAIL_SECONDS, TRAIL_DEPTH, "event_id")
    return out.select("event_id", "user_id", F.col("window_rows").cast("int").alias("window_rows"), F.round("rate", 9).alias("rate"))


@query(
    "paged_rows",
    """
    SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day
    FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 100
    """,
)
def paged_rows(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return hi.page(rows, ["o_orderdate", "o_orderkey"], 100, 50).select(
        "o_orderkey", "o_custkey", day("o_orderdate").alias("order_day")
    )


@query(
    "earliest_rows",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
    FROM lineitem
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 25
    """,
)
def earliest_rows(t: Tables):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return analytics.earliest(t.lineitem.select(*order), order, 25).select(
        "l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("ship_day")
    )


@query(
    "text_search",
    """
    SELECT doc_id, lang,
           regexp_matches(text, '[0-9]{4,}') AS digits,
           text ILIKE '%license%' AS licence,
           lang IN ('en', 'fr') AS listed
    FROM documents
    WHERE regexp_matches(text, '[0-9]{4,}') OR text ILIKE '%license%' OR (lang IN ('en', 'fr') AND length(text) > 1)
    """,
)
def text_search(t: Tables):
    digits = F.col("text").rlike("[0-9]{4,}")
    licence = F.col("text").ilike("%license%")
    listed = F.col("lang").isin("en", "fr")
    return t.documents.filter(digits | licence | (listed & (F.length("text") > 1))).select(
        "doc_id", "lang", digits.alias("digits"), licence.alias("licence"), listed.alias("listed")
    )


@query(
    "orphan_to_null",
    """
    SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN o_custkey END AS o_custkey,
           CASE WHEN c_custkey IS NOT NULL THEN o_orderstatus END AS o_orderstatus, o_orderpriority
    FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY')
    ON c_custkey = o_custkey
    """,
)
def orphan_to_null(t: Tables):
    parents = t.customer.filter("c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY'")
    child = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return jo.null_orphans(child, parents, "o_custkey", "c_custkey", ["o_custkey", "o_orderstatus"])


@query(
    "reconcile",
    """
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
           CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' ELSE 'both' END AS status
    FROM (SELECT o_orderkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) a
    FULL JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1) b ON a.k = b.k
    """,
)
def reconcile(t: Tables):
    left = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    right = t.lineitem.filter("l_returnflag <> 'N'").select(F.col("l_orderkey").alias("k"))
    return jo.reconcile(left, right, ["k"])


@query(
    "match_report",
    """
    SELECT count(*) AS total, count(*) FILTER (k IS NOT NULL) AS matched, count(*) FILTER (k IS NULL) AS failed
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'A') ON k = o_orderkey
    """,
)
def match_report(t: Tables):
    right = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    return jo.match_report(t.orders.select("o_orderkey"), right, ["o_orderkey"])


@query(
    "right_join",
    """
    SELECT p_partkey, p_brand, l_orderkey, l_linenumber, l_quantity
    FROM (SELECT * FROM lineitem WHERE l_quantity >= 45) RIGHT JOIN part ON l_partkey = p_partkey
    """,
)
def right_join(t: Tables):
    lines = t.lineitem.filter("l_quantity >= 45").select(
        F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    return lines.join(t.part.select("p_partkey", "p_brand"), "p_partkey", "right").select(
        "p_partkey", "p_brand", "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "lateral_first",
    """
    SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_extendedprice
    FROM orders JOIN (
      SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1) ON l_orderkey = o_orderkey
    """,
)
def lateral_first(t: Tables):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    order = [newest("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey"]
    return jo.first_match(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"], order).drop("l_suppkey")


@query(
    "inherited_union",
    """
    WITH d AS (SELECT 'document' AS kind, doc_id AS id, source AS origin, n_chars, NULL::VARCHAR AS event_type FROM documents),
    e AS (SELECT 'event', event_id, 'user-' || user_id, NULL::BIGINT, event_type FROM events)
    SELECT u.kind, u.id, u.origin, u.n_chars, u.event_type, quality
    FROM (SELECT * FROM d UNION ALL SELECT * FROM e) u LEFT JOIN labels ON doc_id = u.id AND u.kind = 'document'
    """,
)
def inherited_union(t: Tables):
    documents = t.documents.select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("source").alias("origin"), "n_chars"
    )
    events = t.events.select(
        F.lit("event").alias("kind"), F.col("event_id").alias("id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("origin"), "event_type",
    )
    parent = jo.union_parents([documents, events])
    labels = t.labels.select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), "quality")
    return parent.join(labels, ["id", "kind"], "left").select("kind", "id", "origin", "n_chars", "event_type", "quality")
