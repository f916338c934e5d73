"""The dealt operators as queries over the shared tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch, configure
from .bfd_packing import pack_matrix
from .chat import format_chats, read_loss, read_turns
from .decontaminate import find_leaks
from .exact_topk import scaled, top_scores, usable
from .language import fit_languages, predict_languages
from .line_dedup import without_boilerplate
from .ngram_join import link_copies
from .online_packing import pack_online
from .prefix_trie import prefix_trie, rebuilt, sequences
from .quality import fit_quality, score_quality
from .simhash import simhash_copies
from .url_filter import judge_urls, parsed
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, steps: bool = False):
    """Register a query; with ``steps`` its written intermediates go when its result, small beside them, is written."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepared(spark)
            if not steps:
                return fn(spark, folder.rstrip("/"))
            with Scratch(spark) as scratch:
                return scratch.keep(fn(spark, folder.rstrip("/")), name)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn

    return register


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a batch of the longest texts still fits a Python worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


@query("op1_pack_bfd")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as packed id rows with segment ends and position resets."""
    return pack_matrix(spark.read.parquet(f"{folder}/documents.parquet"))


@query("op5_ngram_jaccard_join", steps=True)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document under links of 4-word shingle Jaccard at 85 % or more."""
    return link_copies(spark.read.parquet(f"{folder}/documents.parquet"))


@query("op6_pack_online")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed online, one row per piece."""
    return pack_online(spark.read.parquet(f"{folder}/documents.parquet"), keep_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the folds other than 2."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return predict_languages(docs, fit_languages(docs))


LEAKS_SQL = r"""
WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
size AS (SELECT DISTINCT least(len(w), 5) AS k FROM b WHERE len(w) > 0),
ds AS (SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
       FROM d JOIN size ON len(w) >= k),
bs AS (SELECT DISTINCT id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
       FROM b JOIN size ON least(len(w), 5) = k),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, n.n AS n_shingles, count(*) AS matched
FROM ds JOIN bs ON ds.g = bs.g AND ds.k = bs.k JOIN n ON n.id = bs.id
GROUP BY ds.id, bs.id, n.n HAVING 100 * count(*) >= 80 * n.n
"""


@query("op8_benchmark_decontamination", LEAKS_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and test item that it contains."""
    return find_leaks(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


@query("op10_quality_classifier")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from labels of the folds other than 2."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return score_quality(docs, fit_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")))


LINES_SQL = r"""
WITH page AS (SELECT source, list_distinct(list_filter(string_split(text, chr(10)), lambda x: length(trim(x, ' ')) > 0)) AS l
              FROM documents),
pages AS (SELECT source, count(*) AS pages FROM page GROUP BY source),
seen AS (SELECT source, line, count(*) AS n FROM (SELECT source, unnest(l) AS line FROM page) GROUP BY source, line),
bad AS (SELECT s.source, list(s.line) AS lines FROM seen s JOIN pages p ON s.source IS NOT DISTINCT FROM p.source
        WHERE s.n >= 3 AND s.n > 0.05 * p.pages GROUP BY s.source),
kept AS (SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS lines,
           CASE WHEN b.lines IS NULL THEN string_split(d.text, chr(10))
                ELSE list_filter(string_split(d.text, chr(10)),
                       lambda x: NOT (length(trim(x, ' ')) > 0 AND list_contains(b.lines, x))) END AS kept
         FROM documents d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, array_to_string(kept, chr(10)) AS text, CAST(len(lines) - len(kept) AS INTEGER) AS dropped_lines FROM kept
"""


@query("op3_line_dedup", LINES_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that more than a twentieth of its source's pages share."""
    return without_boilerplate(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "text", "dropped_lines")


CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (SELECT conv_id, role, row_number() OVER w AS p, coalesce(lag(role) OVER w, '') || '>' || role AS step FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
v AS (SELECT conv_id, CAST(min(p - 1) FILTER (step NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user',
        'assistant>tool', 'tool>assistant', 'tool>tool')) AS INTEGER) AS bad_turn, arg_max(role, p) = 'assistant' AS ends
      FROM o GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, any_value(bad_turn IS NULL AND ends) AS valid, any_value(bad_turn) AS bad_turn,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM c JOIN v USING (conv_id) GROUP BY conv_id
"""


@query("op7_chat_format", CHAT_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one that holds control strings, formatted and read back."""
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    said = [F.struct(*map(F.lit, (-1, turn, role, tricky))) for turn, role in enumerate(("user", "assistant"))]
    extra = spark.range(1).select(F.inline(F.array(*said)).alias(*table.columns))
    chats = format_chats(table.unionByName(extra)).withColumn("loss_text", read_loss(F.col("segments")))
    read = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.withColumn("read", read).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        "valid",
        "bad_turn",
        F.sha2(F.array_join("read", ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _url_sql() -> str:
    """The template tree in SQL: one group of CTEs a level, as the operator has one pass a level."""
    parts = [
        r"""WITH raw AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest FROM pages),
hp AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM raw),
seg AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS s FROM hp),
r0 AS (SELECT page_id, host, path, coalesce(s[1], '') AS s1, coalesce(s[2], '') AS s2, coalesce(s[3], '') AS s3,
  coalesce(array_to_string(s[4:], '/'), '') AS s4, TRY_CAST(regexp_extract(path, '/([0-9]{1,18})(?:[./]|$)', 1) AS BIGINT) AS id FROM seg)"""
    ]
    for i in range(1, 5):
        above = ", ".join(["host", *(f"t{k}" for k in range(1, i))])
        on = " AND ".join(f"r.{c} = k.{c}" for c in above.split(", "))
        parts.append(
            f"""c{i} AS (SELECT {above}, s{i}, count(*) AS n FROM r{i - 1} GROUP BY {above}, s{i}),
k{i} AS (SELECT {above}, s{i} FROM (SELECT *, sum(n) OVER (PARTITION BY {above}) AS whole FROM c{i})
  WHERE n >= 5 AND s{i} <> '' AND n >= 0.02::DOUBLE * whole),
r{i} AS (SELECT r.*, CASE WHEN r.s{i} = '' OR k.host IS NOT NULL THEN r.s{i} ELSE '*' END AS t{i}
  FROM r{i - 1} r LEFT JOIN k{i} k ON {on} AND r.s{i} = k.s{i})"""
        )
    parts.append(
        """l AS (SELECT doc_id, (quality = 1 AND toxic = 0) AS good FROM labels),
m0 AS (SELECT r.host, r.t1, r.t2, r.t3, r.t4, count(l.good) AS m, count(l.good) FILTER (l.good) AS g
  FROM r4 r LEFT JOIN l ON l.doc_id = r.id GROUP BY ALL),
o AS (SELECT coalesce(sum(g)::DOUBLE / nullif(sum(m), 0), 1.0) AS share FROM m0)"""
    )
    for i in range(1, 5):
        above = ", ".join(["host", *(f"g{k}" for k in range(1, i))])
        on = " AND ".join(f"a.{c} = b.{c}" for c in above.split(", "))
        parts.append(
            f"""b{i} AS (SELECT {above}, t{i}, sum(m) AS bm, sum(g) AS bg FROM m{i - 1} GROUP BY {above}, t{i}),
p{i} AS (SELECT *, sum(bg) OVER (PARTITION BY {above})::DOUBLE / nullif(sum(bm) OVER (PARTITION BY {above}), 0) AS r FROM b{i}),
m{i} AS (SELECT a.*, CASE WHEN b.r IS NULL OR abs(b.bg - b.bm * b.r) <= 1.96::DOUBLE * sqrt(b.bm * b.r * (1 - b.r)) + 0.5
    THEN '~' ELSE b.t{i} END AS g{i} FROM m{i - 1} a JOIN p{i} b ON {on} AND a.t{i} = b.t{i})"""
        )
    parts.append(
        """v AS (SELECT host, g1, g2, g3, g4, sum(m) = 0
    OR (sum(g) + 10.0::DOUBLE * any_value(share)) / (sum(m) + 10.0::DOUBLE) >= 0.5 AS allowed
  FROM m4, o GROUP BY host, g1, g2, g3, g4),
tv AS (SELECT m4.host, t1, t2, t3, t4, allowed FROM m4 JOIN v USING (host, g1, g2, g3, g4)),
j AS (SELECT r.page_id, r.host, r.path, tv.allowed, CASE
    WHEN (r.host = 'example.org' OR r.host LIKE '%.example.org') AND starts_with(r.path, '/en/1') THEN 'example.org/en/1'
    WHEN (r.host = 'example.org' OR r.host LIKE '%.example.org') AND starts_with(r.path, '/es/') THEN 'example.org/es/'
    WHEN (r.host = 'com' OR r.host LIKE '%.com') AND starts_with(r.path, '/fr/') THEN 'com/fr/'
    WHEN (r.host = 'com' OR r.host LIKE '%.com') AND starts_with(r.path, '/de/') THEN 'com/de/'
    WHEN (r.host = 'org' OR r.host LIKE '%.org') AND starts_with(r.path, '/') THEN 'org/' END AS rule
  FROM r4 r JOIN tv USING (host, t1, t2, t3, t4))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN allowed THEN 'allow' ELSE 'block' END AS verdict FROM j"""
    )
    return ",\n".join(parts[:-1]) + ",\n" + parts[-1]


@query("op9_url_filter", _url_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict.  A page's path carries the id of its document; labels of documents label urls."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    document = F.regexp_extract("path", r"/([0-9]{1,18})(?:[./]|$)", 1)
    ids = parsed(pages).select("url", document.try_cast("long").alias("id"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(
        "doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )
    return judge_urls(pages, ids.join(labels, F.col("id") == F.col("doc_id")).select("url", "good")).drop("template")


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op4_exact_topk", TOPK_SQL, steps=True)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector with all others."""
    table = spark.read.parquet(f"{folder}/embeddings.parquet").where(usable(F.col("embedding")))
    vectors = table.select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_scores(vectors, F.col("vec_id") % 50 == 0)


@query("op13_simhash_copies", steps=True)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document, and its component under links of three or fewer differing bits."""
    return simhash_copies(spark.read.parquet(f"{folder}/documents.parquet"))


TRIE_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda crc, x: list_reduce(list_concat([xor(crc, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, t.p, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.p <= c.h
  UNION ALL SELECT c.conv_id, 1, t.p, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.p > c.h),
s AS (SELECT conv_id, row_number() OVER w AS d, string_agg(md5(role) || md5(text), '') OVER w AS k,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, p)),
m AS (SELECT conv_id, 0 AS d, '' AS k, 0 AS words FROM c UNION ALL SELECT conv_id, d, k, words FROM s),
node AS (SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
    left(k, 64 * (any_value(d) - 1)) AS above FROM m GROUP BY k),
kids AS (SELECT above AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY above),
below AS (SELECT left(k, 64 * unnest(range(0, depth + 1))) AS k, n, words, k NOT IN (SELECT k FROM kids) AS leaf FROM node),
sums AS (SELECT k, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * words) AS saved FROM below GROUP BY k),
ends AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, arg_max(k, d) AS k FROM m GROUP BY conv_id) GROUP BY k)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, node.n AS n_convs,
  coalesce(kids.n, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  coalesce(sha, sha256('')) AS ends_sha256
FROM node JOIN sums USING (k) LEFT JOIN kids USING (k) LEFT JOIN ends USING (k)
LEFT JOIN node up ON up.k = node.above AND node.depth > 0
"""


@query("op12_prefix_trie", TRIE_SQL, steps=True)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every shared prefix of the conversations, each begun as the first of its twenty."""
    chats = rebuilt(sequences(spark.read.parquet(f"{folder}/conversations.parquet")))
    return prefix_trie(chats).drop("turn_a", "turn_b")


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The first four whitened components of every vector, fitted on the distinct ones."""
    return whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
