"""Near copies by SimHash: deletion-variant signatures of fingerprint segments.

A fingerprint has one bit for each bit of a 64-bit hash, set where over half of
a text's shingles have it set.  Fingerprints that differ in few bits link.

Two fingerprints that differ in at most ``d`` bits, cut into ``d // 2 + 1``
segments, differ by at most one bit in one of them.  Each segment is therefore
indexed once per bit with that bit deleted: segments at most one bit apart
share a variant, and an equality join on variants finds every pair.  For three
bits these are two segments of 32 bits, so 64 variants a fingerprint.

Members of a variant are verified without listing all pairs of a crowd: each is
compared with the variant's smallest member first, the links found so form
components, and only members outside that member's component meet the others.
Where many are outside, whole fingerprints are indexed by variants instead
(one bit flipped, one deleted): two that share one are at most three bits apart,
and two so near share one, so that nothing is left to compare.

Joins are merged and never broadcast: an explode is planned at the size of its
input, and written variants repeat and pack well, so that Spark takes tables of
millions of rows for small ones.
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
from .ngram_join import chunks

SHINGLE = 3
DISTANCE = 3
SEED = 42
BITS = 64
#: Members outside the component of their variant's smallest one, up to which they are compared directly.
FEW = 64
#: Bytes of a text whose words are held at a time.
SLICE = 1 << 20

_BLANK = frozenset(b" \t\n\r\x0b\x0c")
_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _word_slices(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text with A-Z lowered, in slices cut between words."""
    begin = 0
    while begin < len(raw):
        end = min(begin + SLICE, len(raw))
        while end < len(raw) and raw[end] not in _BLANK:
            end += 1
        yield raw[begin:end].lower().split()
        begin = end


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1]
    spans = zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)
    return np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole text as an unsigned number; 0 without words."""
    ones, n, words = np.zeros(BITS, dtype=np.int64), 0, []

    def count(found: list[bytes], size: int) -> None:
        nonlocal n
        hashes = _hashes(found, size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[:] += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)

    for more in _word_slices((text or "").encode("utf-8", "surrogatepass")):
        words = words + more
        if len(words) >= shingle:
            count(words, shingle)
            words = words[len(words) - shingle + 1 :]
    if not n and words:
        count(words, len(words))
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def variant_masks(distance: int) -> list[int]:
    """For each bit: the other bits of its segment."""
    parts = distance // 2 + 1
    edges = [BITS * k // parts for k in range(parts + 1)]
    masks = []
    for low, high in zip(edges, edges[1:], strict=False):
        segment = (1 << high) - (1 << low)
        masks += [segment & ~(1 << bit) for bit in range(low, high)]
    return masks


def _variants(prints: DataFrame, distance: int) -> DataFrame:
    masks = F.array(*map(_signed, variant_masks(distance)))
    return prints.select("fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))).alias("bit", "rest"))


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _meeting_points(crowd: DataFrame, distance: int) -> DataFrame:
    """Links between the labels of fingerprints at most ``distance`` apart, by variants of whole fingerprints.

    ``distance // 2`` bits are flipped and ``distance % 2`` deleted, so two
    fingerprints share a variant exactly if they are that near.  A variant has
    at most twice as many members as bits, so that its labels fit a cell.
    """
    flips = F.array(*map(_signed, [0] + [1 << b for b in range(BITS) if distance > 1]))
    keeps = F.array(*map(_signed, [~(1 << b) & ((1 << BITS) - 1) for b in range(BITS)] if distance % 2 else [(1 << BITS) - 1]))
    flipped = crowd.select("label", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("near"))
    points = flipped.select("label", F.posexplode(F.transform(keeps, lambda m: F.col("near").bitwiseAND(m))).alias("bit", "rest"))
    met = points.groupBy("bit", "rest").agg(F.collect_set("label").alias("labels")).where(F.size("labels") > 1)
    return met.select(F.array_min("labels").alias("u"), F.explode("labels").alias("v")).where("u <> v").distinct()


def link_fingerprints(prints: DataFrame, distance: int = DISTANCE, few: int = FEW) -> DataFrame:
    """``fp, label`` of each of the distinct ``fp`` that has links; the label is the smallest of its component.

    Fingerprints are signed 64-bit numbers and link at ``distance`` (1 to 3)
    or fewer differing bits.  Null ones take no part.
    """
    if not 1 <= distance <= 3:
        raise ValueError("a distance of 1 to 3 bits")
    prints = prints.where("fp IS NOT NULL")
    index = _variants(prints, distance)
    pivots = index.groupBy("bit", "rest").agg(F.min("fp").alias("pivot"), F.count("*").alias("members")).where("members > 1")
    crowds = cut_lineage(index.join(pivots.hint("merge"), ["bit", "rest"]).select("bit", "rest", "fp", "pivot"), "variants")
    links = cut_lineage(
        crowds.where((F.col("fp") != F.col("pivot")) & _near(F.col("fp"), F.col("pivot"), distance))
        .select(*_pair("fp", "pivot")).distinct(),
        "pivot-links",
    )

    # Members outside their pivot's component meet the others of their variant.
    labels = components(links).select(F.col("node").alias("fp"), "label")
    of_pivot = labels.select(F.col("fp").alias("pivot"), F.col("label").alias("main"))
    labelled = cut_lineage(
        crowds.join(labels.hint("merge"), "fp", "left").join(of_pivot.hint("merge"), "pivot", "left")
        .select("bit", "rest", "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("main", "pivot").alias("main")),
        "labelled-variants",
    )
    outside = labelled.where("label <> main")
    mixed = outside.groupBy("bit", "rest").agg(F.count("*").alias("outside")).hint("merge")
    every = labelled.join(mixed.where(F.col("outside") <= few), ["bit", "rest"]).select("bit", "rest", "fp", "label", "main")
    near = (
        outside.select("bit", "rest", F.col("fp").alias("a"), F.col("label").alias("own")).join(every.hint("merge"), ["bit", "rest"])
        .where((F.col("own") != F.col("label")) & ((F.col("label") == F.col("main")) | (F.col("a") < F.col("fp"))))
        .where(_near(F.col("a"), F.col("fp"), distance))
        .select(*_pair("own", "label"))
    )
    crowd = labelled.join(mixed.where(F.col("outside") > few), ["bit", "rest"]).select("fp", "label").distinct()
    more = cut_lineage(near.unionByName(_meeting_points(crowd, distance)).distinct(), "further-links")
    return components(links.unionByName(more)).select(F.col("node").alias("fp"), "label")


def simhash_copies(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``doc_id, text``.

    Words are runs of bytes other than the space and 0x09-0x0D, A-Z lowered;
    shingles of ``shingle`` words joined by spaces, repeats included, are
    hashed by XXH64 of seed 42; fewer words form one shingle.  ``fingerprint``
    is 16 hex digits; ``component_id`` the smallest id reachable over links of
    at most ``distance`` differing bits, the row's own included.

    Null, empty and wordless texts have fingerprint zero and link like any
    other.  A null id keeps a null component and takes part in no link.  Rows
    repeated under one id are each returned with their own text's fingerprint;
    other columns are ignored; an empty table gives no rows.
    """

    def print_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64))], schema=_FINGERPRINTS
            )

    base = cut_lineage(docs.select("doc_id", "text").mapInArrow(print_rows, "doc_id long, fp long"), "fingerprints")
    known = base.where("doc_id IS NOT NULL")
    prints = cut_lineage(known.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    labels = link_fingerprints(prints.select("fp"), distance)
    named = prints.join(labels.hint("merge"), "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label"))
    smallest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_print = named.join(smallest.hint("merge"), "label").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return known.join(of_print.hint("merge"), "fp").select("doc_id", digits, "component_id").unionByName(
        base.where("doc_id IS NULL").select("doc_id", digits, F.lit(None).cast("long").alias("component_id"))
    )
