"""Self-join of documents on the Jaccard similarity of their word shingles.

Tokens are shingle hashes.  They are ordered by how many documents hold them,
rarest first, and a document is found through its first tokens in that order.
The prefix is extended, so that similar documents share several tokens in it:
rare tokens are indexed singly, frequent ones as pairs of one token class (a
residue).  By the pigeonhole principle every similar pair shares a rare token or
a pair; see ``_index_rows``.  Candidates are verified on their whole sets.

Steps that keep the work small without losing a link:

* Documents of equal sets form one class; the join runs between classes.
* A quarter of the token space is counted first.  A class of which that quarter
  alone holds as many unshared tokens as a prefix is long links with nothing;
  most texts end here, and only the rest is read again.
* Every index entry is compared with a pivot of its key first.  Links found so
  form components, and only members outside their pivot's component are compared
  further.  A group of near copies costs about one comparison a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .names import distinct_names, own
from .text_arrays import mix, shingle_sets

SHINGLE = 4
PERCENT = 85
#: A token of more documents than this is frequent.
RARE = 16
#: Rows of two ids that may be broadcast: 16 MB.
BROADCAST_ROWS = 1_000_000
#: Words of a parity sketch; the two highest bits of a token choose its word.
WORDS = 4
#: Frequent tokens are split into one class for so many tokens of a set.
CLASS_SIZE = 32
SAMPLE = np.uint64(1 << 62)
#: Characters of text turned into arrays at a time.
CHUNK_CHARS = 1 << 20

_BASE = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int32()), ("cls", pa.int64()), ("sample", pa.list_(pa.int64()))])
_SETS = pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])
_INDEX = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("n", pa.int32()), ("rest", pa.int32()), ("own", pa.int32())])


def chunks(
    batches: Iterator[pa.RecordBatch], chars: int = CHUNK_CHARS, column: int = -1
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches cut so that their texts (the last column, or the one at a place) stay near a number of characters."""
    for batch in batches:
        texts = batch.column(column % batch.num_columns).to_pylist()
        begin = held = 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= chars or i + 1 == len(texts):
                yield batch.slice(begin, i + 1 - begin), texts[begin : i + 1]
                begin, held = i + 1, 0


def _class_of(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)))


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def least_overlap(n: Column, percent: int) -> Column:
    """Tokens that a set of ``n`` shares at least with any set it links to."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _can_link(percent: int, a: str, b: str) -> Column:
    """Sizes, and the tokens that both sides have from their common key on, still allow a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(f"{a}.rest", f"{b}.rest")
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


def _index_rows(percent: int, rare: int):
    """Index keys of one class: what a similar class must share.

    Two linked sets share at least ``c + 1`` tokens among the first
    ``n - ceil(t n) + 1 + c`` of each.  If one of these is rare, its single key
    is common.  Otherwise they are ``c + 1`` frequent tokens in ``c`` token
    classes, so two fall into one class, and that pair is a common key.  ``c``
    follows the power of two a size lies in; sizes near a power of two are
    indexed under both, so that linked sets always meet under one.

    ``rest`` bounds the overlap from the key's place on: before the first common
    rare token lies no common token, before the first common pair lie at most
    ``c``, and from there a set has only its remaining tokens.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, sizes, keys, rests, own = [], [], [], [], []
            for c, n, items in zip(*(batch.column(i) for i in range(3)), strict=True):
                n, values = n.as_py(), items.values
                tokens = np.asarray(values.field("token")).view(np.uint64)
                often = np.asarray(values.field("df")) > rare
                need = -(-n * percent // 100)
                unshared = n - len(tokens)
                low, high = need, n * 100 // percent
                found, bound = [], []
                for power in range(max(1, low).bit_length() - 1, max(1, high).bit_length()):
                    classes = 1 + (1 << power) // CLASS_SIZE
                    head = max(0, n - need + 1 + classes - unshared)
                    single = np.flatnonzero(~often[:head])
                    found.append(tokens[single])
                    bound.append(len(tokens) - single)
                    place = np.flatnonzero(often[:head])
                    residue = tokens[place] % np.uint64(classes)
                    order = np.argsort(residue, kind="stable")
                    place, residue = place[order], residue[order]
                    for step in range(1, len(place)):
                        same = residue[step:] == residue[:-step]
                        if not same.any():
                            break
                        first, second = place[:-step][same], place[step:][same]
                        found.append(mix(tokens[first] * np.uint64(31) + mix(tokens[second] + np.uint64(power))))
                        bound.append(len(tokens) - first + classes)
                found, bound = np.concatenate(found), np.concatenate(bound)
                found, at = np.unique(found, return_index=True)
                keys.append(found.view(np.int64))
                rests.append(bound[at])
                for column, value in ((cls, c.as_py()), (sizes, n), (own, unshared)):
                    column.append(np.full(len(found), value))
            columns = [np.concatenate(c) if c else [] for c in (keys, cls, sizes, rests, own)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(columns, _INDEX, strict=True)], schema=_INDEX
            )

    return rows


def _parities(tokens: Column) -> Column:
    """For each residue of the tokens whether their number is odd, as bits of ``WORDS`` words.

    The words of two sets differ in at most as many bits as the sets differ in
    tokens: tokens in common cancel out.
    """

    def word(w: int) -> Column:
        own = F.filter(tokens, lambda t: F.shiftrightunsigned(t, 62) == w)
        bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(t, F.lit(61)).cast("int"))
        return F.aggregate(own, F.lit(0).cast("long"), lambda odd, t: odd.bitwiseXOR(bit(t)))

    return F.array(*(word(w) for w in range(WORDS)))


def _differ_little(percent: int) -> Column:
    """The parities of both sides, and the tokens that no other set has, still allow a link."""
    odd = F.col("a.own") + F.col("b.own")
    for w in range(WORDS):
        odd += F.bit_count(F.col("a.parity")[w].bitwiseXOR(F.col("b.parity")[w]))
    return (100 + percent) * odd <= (100 - percent) * (F.col("a.n") + F.col("b.n"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``u, v`` pairs whose whole sets are similar enough.  Unshared tokens cannot overlap and are left out."""
    tokens = sets.select("cls", "n", F.col("items.token").alias("tokens"))
    joined = pairs.join(tokens.select(F.col("cls").alias("u"), F.col("n").alias("nu"), F.col("tokens").alias("tu")), "u").join(
        tokens.select(F.col("cls").alias("v"), F.col("n").alias("nv"), F.col("tokens").alias("tv")), "v"
    )
    overlap = F.size(F.array_intersect("tu", "tv")).cast("long")
    return (
        joined.select("u", "v", "nu", "nv", overlap.alias("overlap"))
        .where(100 * F.col("overlap") >= percent * (F.col("nu") + F.col("nv") - F.col("overlap")))
        .select("u", "v")
    )


def _beside(keys: DataFrame) -> DataFrame:
    """Fixed-width rows of a written table, sent to all tasks if they are few enough; otherwise texts are shuffled to them."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def link_copies(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rare: int = RARE
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``doc_id, text``: see ``link_rows``."""
    return link_rows(docs, shingle, percent, rare).select("doc_id", "n_shingles", "component_id")


def link_rows(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rare: int = RARE
) -> DataFrame:
    """``doc_id, row, n_shingles, label, component_id`` of every row of ``doc_id, text``.

    Words are runs of bytes other than the space and 0x09-0x0D, A-Z lowered.
    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their
    sets of ``shingle``-word shingles; fewer words form one shingle.
    ``component_id`` is the smallest id reachable over links.  ``row`` is a
    hash of the text and ``label`` names the component also where ids are
    repeated; rows without words or id have no label.

    Null, empty and wordless texts have size 0 and their own id.  A null id
    keeps a null component and takes part in no link.  Rows repeated under
    one id are each returned; other columns are ignored; an empty table
    gives no rows.  Sets are compared by 64-bit hashes of their shingles.
    """

    def base_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts, shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([_class_of(s) for s in sets], pa.int64()),
                    _lists([s[: np.searchsorted(s, SAMPLE)] for s in sets]),
                ],
                schema=_BASE,
            )

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts, shingle)
            found = [(w, s) for w, s in zip(batch.column(0).to_pylist(), sets, strict=True) if _class_of(s) == w]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w for w, _ in found], pa.int64()),
                    pa.array([len(s) for _, s in found], pa.int32()),
                    _lists([s for _, s in found]),
                ],
                schema=_SETS,
            )

    base = cut_lineage(
        docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
        .mapInArrow(base_rows, "doc_id long, row long, n int, cls long, sample array<long>"),
        "sets",
    )
    usable = base.where("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("cls").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"))
    need = least_overlap(F.col("n"), percent)

    # Tokens of one class only, in the sampled quarter of the token space.
    token = usable.select("cls", F.explode("sample").alias("token"))
    lone = (
        token.groupBy("token").agg(F.min("cls").alias("cls"), F.max("cls").alias("other"))
        .where("cls = other").groupBy("cls").agg(F.count("*").alias("lone"))
    )
    left = cut_lineage(
        classes.where("n > 1").join(lone, "cls", "left")
        .where(F.coalesce("lone", F.lit(0)) < F.col("n") - need + 1)
        .select("cls", "first_id", "n"),
        "linkable",
    )

    # The whole sets of what is left, with the tokens that others hold too.
    texts = docs.select("doc_id", "text").join(_beside(left.select("cls", "first_id")), F.col("doc_id") == F.col("first_id"))
    whole = cut_lineage(
        texts.select("cls", "text").mapInArrow(set_rows, "cls long, n int, tokens array<long>"), "whole-sets"
    )
    token = whole.select("cls", "n", F.explode("tokens").alias("token"))
    often = token.groupBy("token").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    sets = cut_lineage(
        token.join(often, "token").groupBy("cls", "n")
        .agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("items"))
        .where(F.size("items") >= need),
        "shared-tokens",
    )

    index = cut_lineage(
        sets.select("cls", "n", "items").mapInArrow(
            _index_rows(percent, rare), "key long, cls long, n int, rest int, own int"
        ),
        "index",
    )
    pivots = index.groupBy("key").agg(
        F.min(F.struct("own", "cls", "n", "rest")).alias("pivot"),
        F.count("*").alias("members"),
    )
    index = index.join(pivots.where("members > 1"), "key").select(
        "key", F.struct("cls", "n", "rest", "own").alias("m"), "pivot"
    )
    near = cut_lineage(
        index.where(F.col("m.cls") != F.col("pivot.cls")).where(_can_link(percent, "m", "pivot"))
        .select(*_pair("m.cls", "pivot.cls")).distinct(),
        "pivot-pairs",
    )
    links = cut_lineage(_verified(near, sets, percent), "pivot-links")
    label = components(links)

    # Members outside their pivot's component meet all others of the key.
    labels = label.select(F.col("node").alias("cls"), F.col("label"))
    labelled = cut_lineage(
        index.withColumn("cls", F.col("m.cls")).join(labels, "cls", "left")
        .withColumn("mine", F.coalesce("label", "cls")).drop("label", "cls")
        .withColumn("cls", F.col("pivot.cls")).join(labels, "cls", "left")
        .withColumn("main", F.col("mine") == F.coalesce("label", "cls"))
        .select("key", "m", "mine", "main"),
        "labelled",
    )
    mixed = labelled.where("NOT main").select("key").distinct()
    sketches = sets.select("cls", _parities(F.col("items.token")).alias("parity"))
    member = labelled.join(mixed, "key").withColumn("cls", F.col("m.cls")).join(sketches, "cls").select(
        "key", F.struct("m.cls", "m.n", "m.rest", "m.own", "mine", "main", "parity").alias("m")
    )
    minor = member.where("NOT m.main").select("key", F.col("m").alias("a"))
    every = member.select("key", F.col("m").alias("b"))
    rest = (
        minor.join(every, "key")
        .where(F.col("a.mine") != F.col("b.mine"))
        .where((F.col("b.main") | (F.col("a.cls") < F.col("b.cls"))) & _can_link(percent, "a", "b") & _differ_little(percent))
        .select(*_pair("a.cls", "b.cls")).distinct()
    )
    rest = rest.join(near, ["u", "v"], "left_anti")
    more = cut_lineage(_verified(rest, sets, percent), "further-links")
    stars = label.select(F.col("node").alias("u"), F.col("label").alias("v"))
    label = components(stars.unionByName(more))

    named = (
        classes.join(label.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "first_id", F.coalesce("label", "cls").alias("label"))
    )
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(smallest, "label").select("cls", "label", "component_id")
    linked = usable.select("doc_id", "row", "n", "cls").join(of_class, "cls")
    alone = base.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", "row", "n", F.lit(None).cast("long").alias("label"),
        F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id"),
    )
    return linked.select("doc_id", "row", "n", "label", "component_id").unionByName(alone).select(
        "doc_id", "row", F.col("n").cast("long").alias("n_shingles"), "label", "component_id"
    )


def keep_one(docs: DataFrame, linked: DataFrame) -> DataFrame:
    """One row of each component of ``link_rows(docs)``: of its smallest id, there the text of smallest hash.

    It is decided row by row, so one id with several texts loses none of
    their components.  Rows repeated under one id and text are one document.
    Rows without an id, and texts without words, belong to no component and
    stay.  Other columns stay as they are; an empty table gives no rows.
    Only ids and hashes move; texts are filtered in place.
    """
    names = distinct_names(docs)
    known = cut_lineage(linked.where("doc_id IS NOT NULL"), "linked-rows")  # used twice
    first = known.where("doc_id = component_id AND label IS NOT NULL").groupBy("label").agg(F.min("row").alias("first"))
    rows = known.groupBy("doc_id", "row").agg(
        F.first("label").alias("label"), F.first("component_id").alias("component_id"), F.count("*").alias("rows")
    )
    gone = F.col("label").isNotNull() & ((F.col("doc_id") != F.col("component_id")) | (F.col("row") != F.col("first")))
    marked = cut_lineage(
        rows.join(first, "label", "left").select("doc_id", "row", gone.alias("gone"), "rows").where("gone OR rows > 1"),
        "component-marks",
    )

    def same(marks: DataFrame) -> tuple[DataFrame, Column]:
        return _beside(marks.select("doc_id", "row")).alias("m"), (own("doc_id", "d") == F.col("m.doc_id")) & (
            F.xxhash64(own("text", "d")) == F.col("m.row")
        )

    left = docs.alias("d")
    once = left.join(*same(marked.where("NOT gone")), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(*same(marked), "left_anti").select(*map(own, names)).unionByName(once.select(*map(own, names)))
