"""Name linkage and range shards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import linkage as li
from ..operators import shards as sh
from ..operators.quality import short_shards
from ..session import cut_lineage
from .base import Tables, query

# Part names per brand against the same names without their first letter.
_NAMES = """
    n AS (SELECT DISTINCT p_brand, p_name FROM part),
    c AS (SELECT DISTINCT p_brand, substr(p_name, 2) AS choice FROM part)
"""


def _names(t: Tables):
    return t.part.select("p_brand", "p_name")


def _choices(t: Tables):
    return t.part.select("p_brand", F.expr("substr(p_name, 2)").alias("choice"))


@query(
    "fuzzy_best",
    f"""
    WITH {_NAMES}, s AS (
      SELECT p_brand, p_name, choice, 1 - levenshtein(p_name, choice) / greatest(length(p_name), length(choice)) AS score
      FROM n JOIN c USING (p_brand))
    SELECT p_brand, p_name, choice, round(score, 6) AS score FROM s
    QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY score DESC, choice) = 1
    """,
)
def fuzzy_best(t: Tables):
    out = li.best_match(_names(t), _choices(t), ["p_brand"], "p_name", "choice")
    return out.withColumn("score", F.round("score", 6))


@query(
    "fuzzy_near_pairs",
    f"""
    WITH {_NAMES}, s AS (
      SELECT p_brand, p_name, choice,
        CAST(100 - round((1 - levenshtein(p_name, choice) / greatest(length(p_name), length(choice))) * 100) AS INTEGER) AS cost
      FROM n JOIN c USING (p_brand))
    SELECT * FROM s WHERE cost <= 20
    """,
)
def fuzzy_near_pairs(t: Tables):
    return li.near_pairs(_names(t), _choices(t), ["p_brand"], "p_name", "choice")


@query(
    "fuzzy_assign",
    f"""
    WITH RECURSIVE {_NAMES}, s AS (
      SELECT p_brand, p_name, choice,
        CAST(100 - round((1 - levenshtein(p_name, choice) / greatest(length(p_name), length(choice))) * 100) AS INTEGER) AS cost,
        CAST('0x' || substr(md5(p_brand || '|' || p_name || '|' || choice), 1, 8) AS BIGINT) AS tie
      FROM n JOIN c USING (p_brand)),
    e AS (SELECT * FROM s WHERE cost <= 20),
    -- Names of one connected group, by the smallest of them.
    near AS (SELECT DISTINCT a.p_brand, a.p_name AS x, b.p_name AS y FROM e a JOIN e b USING (p_brand, choice)),
    reach AS (SELECT p_brand, x, x AS y FROM near UNION SELECT r.p_brand, r.x, m.y FROM reach r
      JOIN near m ON m.p_brand = r.p_brand AND m.x = r.y),
    grp AS (SELECT p_brand, x AS p_name, min(y) AS g FROM reach GROUP BY 1, 2),
    member AS (SELECT *, row_number() OVER (PARTITION BY p_brand, g ORDER BY p_name) AS i FROM grp),
    option AS (
      SELECT m.p_brand, m.g, m.i, m.p_name, e.choice, e.cost, e.tie FROM member m JOIN e USING (p_brand, p_name)
      UNION ALL SELECT p_brand, g, i, p_name, NULL, 100, 0 FROM member),
    -- All ways to serve the first i names of a group; of those that use the same choices, the cheapest.
    way AS (
      SELECT DISTINCT p_brand, g, 0::BIGINT AS i, []::VARCHAR[] AS used, []::VARCHAR[] AS picked, 0::BIGINT AS cost, 0::BIGINT AS tie
      FROM member
      UNION ALL
      SELECT w.p_brand, w.g, o.i,
        CASE WHEN o.choice IS NULL THEN w.used ELSE list_sort(list_append(w.used, o.choice)) END AS used,
        list_append(w.picked, o.choice) AS picked, w.cost + o.cost AS cost, w.tie + o.tie AS tie
      FROM way w JOIN option o ON o.p_brand = w.p_brand AND o.g = w.g AND o.i = w.i + 1
      WHERE o.choice IS NULL OR NOT list_contains(w.used, o.choice)
      QUALIFY row_number() OVER (PARTITION BY w.p_brand, w.g, o.i,
        CASE WHEN o.choice IS NULL THEN w.used ELSE list_sort(list_append(w.used, o.choice)) END
        ORDER BY w.cost + o.cost, w.tie + o.tie) = 1),
    best AS (
      SELECT w.p_brand, w.g, w.picked FROM way w JOIN (SELECT p_brand, g, max(i) AS i FROM member GROUP BY 1, 2) USING (p_brand, g, i)
      QUALIFY row_number() OVER (PARTITION BY w.p_brand, w.g ORDER BY w.cost, w.tie) = 1),
    pairs AS (
      SELECT m.p_brand, m.p_name, e.choice, e.cost FROM member m JOIN best USING (p_brand, g)
      JOIN e ON e.p_brand = m.p_brand AND e.p_name = m.p_name AND e.choice = best.picked[m.i])
    SELECT p_brand, p_name, choice, cost FROM n LEFT JOIN pairs USING (p_brand, p_name)
    """,
)
def fuzzy_assign(t: Tables):
    """One-to-one pairs of least total cost and the names left over; also checked by brute force in the tests."""
    pairs, left_over = li.assign_one_to_one(_names(t), _choices(t), ["p_brand"], "p_name", "choice")
    rest = left_over.withColumn("choice", F.lit(None).cast("string")).withColumn("cost", F.lit(None).cast("int"))
    return pairs.unionByName(rest)


@query(
    "repeated_names",
    "SELECT p_brand, p_name, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1",
)
def repeated_names(t: Tables):
    return li.repeated_names(t.part, ["p_brand"], "p_name")


def _plan(t: Tables):
    """A plan whose size does not depend on the table: about 1/400 of the rows per shard."""
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    depth = rows.count() // 400 + 1
    return rows, depth, sh.plan_shards(rows, "d", "o_totalprice", date(1995, 1, 1), date(2002, 1, 1), 1e7, depth)


@query(
    "range_shards",
    "SELECT count(*) AS row_count, 0 AS too_full, CAST(0 AS BIGINT) AS unplaced FROM orders",
)
def range_shards(t: Tables):
    """Shards hold every row once and no more than the wanted depth."""
    rows, depth, plan = _plan(t)
    placed = sh.with_shard(rows, plan, "d", "o_totalprice")
    counts = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    checked = plan.join(counts, "shard", "left")
    total = rows.agg(F.count(F.lit(1)).alias("all_rows"))
    sums = checked.agg(
        F.sum("n").alias("row_count"),
        F.count_if((F.col("expected") > depth) & ~F.col("full")).cast("int").alias("too_full"),
    )
    both = sums.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")
    return both.select("row_count", "too_full", (F.col("all_rows") - F.col("row_count")).alias("unplaced"))


@query(
    "shard_counts",
    "SELECT count(*) AS expected, CAST(0 AS BIGINT) AS short_shards, count(*) AS paged FROM orders",
)
def shard_counts(t: Tables):
    """Announced rows arrive in every shard, and its pages add up to them."""
    rows, _, plan = _plan(t)
    arrived = sh.with_shard(rows, plan, "d", "o_totalprice")
    short = short_shards(plan, arrived, "shard", "expected").agg(F.count(F.lit(1)).alias("short_shards"))
    pages = sh.shard_pages(plan, 75).agg(F.sum("size").alias("paged"))
    total = plan.agg(F.sum("expected").alias("expected"))
    out = total.withColumn("_k", F.lit(1))
    for part in (short, pages):
        out = out.join(part.withColumn("_k", F.lit(1)), "_k")
    return out.drop("_k")


@query(
    "crowded_shards",
    """
    WITH r AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d, CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END AS v FROM orders)
    SELECT CAST(d AS VARCHAR) AS d, count(*) AS expected, count(*) AS placed, count(v) AS valued, CAST(0 AS BIGINT) AS too_full,
      CAST(0 AS BIGINT) AS outside, TRUE AS split FROM r GROUP BY d
    """,
)
def crowded_shards(t: Tables):
    """Days of many rows are cut by value: what each day's shards announce, hold and hold wrongly."""
    value = F.when(F.col("o_orderkey") % 9 > 0, F.col("o_totalprice"))
    rows = cut_lineage(t.orders.select(F.trunc("o_orderdate", "quarter").alias("d"), value.alias("v")), "crowded-days")
    # About a fifth of a mean quarter.
    depth = rows.count() // (rows.select("d").distinct().count() * 5) + 1
    plan = cut_lineage(sh.plan_shards(rows, "d", "v", date(1990, 1, 1), date(2003, 1, 1), 1e6, depth), "shards")
    placed = sh.with_shard(rows, plan, "d", "v").join(plan.select("shard", "value_from", "value_to", "value_missing"), "shard")
    right = F.when(F.col("value_missing"), F.col("v").isNull()).otherwise(
        (F.col("v") >= F.col("value_from")) & (F.col("v") < F.col("value_to"))
    )
    held = placed.groupBy("shard", "d").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("with_value"), F.count_if(~F.coalesce(right, F.lit(False))).alias("wrong")
    )
    return plan.join(held, "shard", "left").groupBy(F.col("day_from").cast("string").alias("d")).agg(
        F.sum("expected").alias("expected"),
        F.sum("n").alias("placed"),
        F.sum("with_value").alias("valued"),
        F.count_if((F.col("n") > depth) & ~F.col("full")).alias("too_full"),
        F.sum("wrong").alias("outside"),
        (F.count(F.lit(1)) > 1).alias("split"),
    )


@query(
    "crowded_day_shards",
    """
    WITH r AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS d, CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END AS v FROM orders),
    k AS (SELECT count(*) // (count(DISTINCT d) * 2) + 1 AS depth FROM r),
    crowded AS (SELECT r.* FROM r JOIN (SELECT d FROM r, k GROUP BY d, depth HAVING count(*) > depth) USING (d)),
    tens AS (SELECT lo, lo * 10 AS hi FROM (SELECT unnest([1.0::DOUBLE, 10, 100, 1000, 10000, 100000]) AS lo)),
    p1 AS (SELECT d, lo, hi, count(*) AS n FROM crowded JOIN tens ON v >= lo AND v < hi GROUP BY ALL),
    steps AS (
      SELECT lo AS up, CASE WHEN i = 0 THEN lo ELSE floor(pow(10, log10(lo) + i / 11.0::DOUBLE)) END AS lo,
        CASE WHEN i = 10 THEN hi ELSE floor(pow(10, log10(lo) + (i + 1) / 11.0::DOUBLE)) END AS hi FROM tens, range(11) g(i)),
    p2 AS (
      SELECT crowded.d, steps.lo, steps.hi, count(*) AS n FROM p1 JOIN k ON n > depth JOIN steps ON up = p1.lo
      JOIN crowded ON crowded.d = p1.d AND v >= steps.lo AND v < steps.hi GROUP BY ALL)
    SELECT CAST(d AS VARCHAR) AS d, lo AS value_from, hi AS value_to, FALSE AS value_missing, n AS expected, n AS placed FROM p1, k WHERE n <= depth
    UNION ALL SELECT CAST(d AS VARCHAR), lo, hi, FALSE, n, n FROM p2
    UNION ALL SELECT CAST(d AS VARCHAR), NULL, NULL, TRUE, count(*), count(*) FROM crowded WHERE v IS NULL GROUP BY d
    """,
)
def crowded_day_shards(t: Tables):
    """The shards of crowded days themselves: powers of ten, crowded ones cut in eleven again, and the missing values."""
    value = F.when(F.col("o_orderkey") % 9 > 0, F.col("o_totalprice"))
    rows = cut_lineage(t.orders.select(F.trunc("o_orderdate", "quarter").alias("d"), value.alias("v")), "crowded-days")
    # Half of a mean quarter: its dearest rows are cut once more.
    depth = rows.count() // (rows.select("d").distinct().count() * 2) + 1
    plan = cut_lineage(sh.plan_shards(rows, "d", "v", date(1990, 1, 1), date(2003, 1, 1), 1e6, depth), "shards")
    placed = sh.with_shard(rows, plan, "d", "v").groupBy("shard").agg(F.count(F.lit(1)).alias("placed"))
    of_values = plan.filter(F.col("value_missing") | F.col("value_from").isNotNull())
    return of_values.join(placed, "shard", "left").select(
        F.col("day_from").cast("string").alias("d"), "value_from", "value_to", "value_missing", "expected", "placed"
    )
