"""Trie of shared conversation prefixes, from sorted sequences and their common prefixes.

Each distinct sequence of turns stands once, in sorted order, beside the length
of the prefix it shares with the one before (LCP).  A prefix of depth ``d`` is
an interval of that order in which all inner LCPs are ``d`` or more.  Candidates
are every sequence at its full length and every LCP at its place; each finds its
interval alone, by binary searches to the left and right over a sparse table of
range minima, without a stack.  Intervals and prefix sums give all figures.

On the cluster, distinct sequences are range-partitioned and streamed in bounded
blocks.  A sequence knows its LCP with the one before it also across blocks and
partitions (a partition is handed its predecessor's last sequence).  A node
inside a block is complete there; one that may reach beyond an edge is a prefix
of the block's first or last sequence, and its sums, which add up over blocks,
are merged by the hash of the prefix.

Turns travel as 128-bit hashes of role and text with a word count, never as texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .text_arrays import mix

#: Turns in a block of sorted sequences.
BLOCK_TURNS = 1 << 16

_NODES = pa.schema([
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
    ("open", pa.bool_()), ("key_a", pa.int64()), ("key_b", pa.int64()), ("parent_a", pa.int64()), ("parent_b", pa.int64()),
    ("turn_a", pa.int64()), ("turn_b", pa.int64()),
])
_NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, open boolean, key_a long, key_b long, parent_a long, parent_b long, turn_a long, turn_b long"
)
_ENDS = pa.schema([("conv_id", pa.int64()), ("n_ends", pa.int64()), ("ends_sha256", pa.string())])
_NO_TURNS = "array<struct<a:bigint,b:bigint,words:int>>"


def _turn_hash(role: Column, text: Column) -> list[Column]:
    return [F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b")]


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` of every conversation of ``conv_id, turn, role, text``: its turns' hashes and word counts in order.

    Turns stand by ``turn``, null first; ties by role, then text; repeated
    rows stay repeated.  A null role or text is empty.  Rows without a
    ``conv_id`` belong to no conversation and are left out; other columns
    are ignored; an empty table gives no rows.
    """
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # Texts move only where they have to settle a tie.
    tied = cut_lineage(rows.groupBy("conv_id", "turn").count().where("count > 1").select("conv_id", "turn"), "tied-turns")
    same = (F.col("r.conv_id") == F.col("t.conv_id")) & F.col("r.turn").eqNullSafe(F.col("t.turn"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("int").alias("words")
    hashed = [*_turn_hash(F.col("role"), F.col("text")), words]
    alone = rows.select("conv_id", "turn", F.lit(0).alias("place"), *hashed).alias("r").join(tied.alias("t"), same, "left_anti")
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    settled = rows.alias("r").join(tied.alias("t"), same, "left_semi").withColumn("place", F.row_number().over(order))
    every = alone.unionByName(settled.select("conv_id", "turn", "place", *hashed))
    listed = every.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "place", "a", "b", "words"))).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["a"], t["b"], t["words"])).cast(_NO_TURNS).alias("turns"))


def _ends(chats: DataFrame) -> DataFrame:
    """Of each distinct sequence: its smallest conversation, their number and the digest of their ids.

    Ids stream through in order, so a sequence of any number of conversations
    needs no list of them.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, state = None, None, 0, None
        for batch in batches:
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            done = []
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)], strict=True):
                if low == high:
                    continue
                own = ids[low:high].tolist()
                if (a[low], b[low]) != key:
                    if key:
                        done.append((first, n, state.hexdigest()))
                    key, first, n, state = (a[low], b[low]), own[0], 0, hashlib.sha256()
                state.update((("," if n else "") + ",".join(map(str, own))).encode())
                n += len(own)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t.type) for i, t in enumerate(_ENDS)], schema=_ENDS)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((first, n, state.hexdigest()), _ENDS, strict=True)], schema=_ENDS)

    keys = chats.select(F.xxhash64("turns").alias("a"), F.xxhash64(F.lit(1), "turns").alias("b"), "conv_id")
    return keys.repartition("a", "b").sortWithinPartitions("a", "b", "conv_id").mapInArrow(
        digests, "conv_id long, n_ends long, ends_sha256 string"
    )


class RangeMinimum:
    """Sparse table of the minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (1 << len(self.levels)) <= 2 * len(values):
            half = 1 << (len(self.levels) - 1)
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.empty(len(first), dtype=self.levels[0].dtype)
        level = np.frexp(last - first + 1)[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << int(k)) + 1])
        return out

    def extents(self, place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The widest interval around each place whose inner values (all but its first) reach ``depth``."""
        n = len(self.levels[0])
        left, right = place.copy(), place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table, step = self.levels[k], 1 << k
            at = left - step
            left = np.where((at >= 0) & (table[np.clip(at + 1, 0, len(table) - 1)] >= depth), at, left)
            at = right + step
            right = np.where((at < n) & (table[np.minimum(right + 1, len(table) - 1)] >= depth), at, right)
        return left, right


class Block:
    """Sorted distinct sequences, flat, and the sequence before the first one, if any."""

    def __init__(self, a, b, words, lengths, n_ends, conv_id, before):
        self.a, self.b, self.lengths, self.n_ends, self.conv_id = a, b, lengths, n_ends, conv_id
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(len(a)) - self.offsets[self.row]
        self.words = np.concatenate([[0], np.cumsum(words)])
        salt = mix(self.at.astype(np.uint64) + np.uint64(1))
        self.keys = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x.view(np.uint64) + salt))]) for x in (a, b)]
        self.lcp = self._common(before)
        #: Whether a sequence only prolongs the one before.
        ends = np.concatenate([[len(before[0]) if before else -2], lengths[:-1]])
        self.prolongs = (self.lcp == ends).astype(np.int64)

    def _common(self, before) -> np.ndarray:
        """Turns in common with the sequence before; -1 where there is none."""
        lcp = self.lengths.copy()
        partner = np.where(self.row > 0, self.offsets[np.maximum(self.row, 1) - 1] + self.at, 0)
        inside = (self.row > 0) & (self.at < self.lengths[np.maximum(self.row, 1) - 1])
        partner = np.where(inside, partner, 0)
        other = np.flatnonzero((self.row > 0) & ~(inside & (self.a == self.a[partner]) & (self.b == self.b[partner])))
        rows, first = np.unique(self.row[other], return_index=True)
        lcp[rows] = self.at[other[first]]
        lcp[0] = -1
        if before:
            n = min(len(before[0]), int(self.lengths[0]))
            other = np.flatnonzero((before[0][:n] != self.a[:n]) | (before[1][:n] != self.b[:n]))
            lcp[0] = other[0] if len(other) else n
        return lcp

    def words_to(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        low = self.offsets[row]
        return self.words[low + np.clip(depth, 0, None)] - self.words[low]

    def key(self, row: np.ndarray, depth: np.ndarray) -> list[np.ndarray]:
        low = self.offsets[row]
        return [(k[low + depth] - k[low]).view(np.int64) for k in self.keys]

    def nodes(self, digests: pa.Array) -> pa.RecordBatch:
        m = len(self.lengths)
        own = self.lcp.copy()
        own[0] = -1
        edged = np.append(own, -1)
        depths, least = RangeMinimum(own), RangeMinimum(self.conv_id)
        rows = np.arange(m)

        # Every sequence at its length, every common prefix at its place, and the root.
        place, depth = np.concatenate([rows, rows[1:], [0]]), np.concatenate([self.lengths, own[1:], [0]])
        left, right = depths.extents(place, depth)
        order = np.lexsort((depth, right, left))
        left, right, depth = left[order], right[order], depth[order]
        widest = np.append((left[1:] != left[:-1]) | (right[1:] != right[:-1]), True)
        left, right, deepest = left[widest], right[widest], depth[widest]

        # An interval's prefixes: all depths below those of the intervals around it.
        top = np.maximum(edged[left], edged[right + 1]) + 1
        up_left, up_right = depths.extents(left, top - 1)
        chain = np.repeat(np.arange(len(left)), deepest - top + 1)
        steps = np.arange(len(chain)) - np.repeat(np.cumsum(deepest - top + 1) - (deepest - top + 1), deepest - top + 1)
        d, l, r = top[chain] + steps, left[chain], right[chain]
        first = steps == 0
        pl, pr = np.where(first, up_left[chain], l), np.where(first, up_right[chain], r)

        def over(values: np.ndarray, low: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[r + 1] - sums[low]

        goes_on = (l == 0) & (d <= self.lcp[0])  # the block before holds the prefix as well
        whole = self.words_to(rows, self.lengths)
        new = whole - self.words_to(rows, self.lcp)
        above = self.words_to(l, d - 1)
        n = over(self.n_ends, l)
        distinct = over(new, l + 1) + np.where(goes_on, new[0], whole[l] - above)
        saved = over(self.n_ends * whole, l) - n * above - distinct
        leaves = r - l + 1 - over(self.prolongs, l + 1) - np.where(goes_on, self.prolongs[0], 0)
        marks = np.sort(own * (m + 1) + rows)
        branches = np.searchsorted(marks, d * (m + 1) + r, "right") - np.searchsorted(marks, d * (m + 1) + l, "right")
        children = branches + np.where(goes_on, self.lcp[0] == d, self.lengths[l] > d)

        is_end = ~goes_on & (self.lengths[l] == d)
        root = d == 0
        parent_open = (pr == m - 1) | ((pl == 0) & (d - 1 <= self.lcp[0]))
        last = np.maximum(self.offsets[l] + d - 1, 0)
        turn = [np.where(root, 0, x[np.minimum(last, len(x) - 1)]) if len(x) else np.zeros(len(d), np.int64) for x in (self.a, self.b)]
        none = lambda x, gone: pa.array(x, pa.int64(), mask=gone)
        columns = [
            pa.array(least.of(l, r)), pa.array(d), none(least.of(pl, pr), root | parent_open), pa.array(n), pa.array(children),
            pa.array(leaves), pa.array(saved), digests.take(pa.array(np.where(is_end, l, 0), mask=~is_end)),
            pa.array(goes_on | (r == m - 1)), *map(pa.array, self.key(l, d)),
            *(none(k, root) for k in self.key(l, np.maximum(d - 1, 0))), *(none(t, root) for t in turn),
        ]
        return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, _NODES, strict=True)], schema=_NODES)


def _flat(turns: pa.ListArray) -> tuple[list[np.ndarray], np.ndarray]:
    values = turns.flatten()
    return [values.field(i).to_numpy() for i in range(3)], np.diff(turns.offsets.to_numpy()).astype(np.int64)


def _block_rows(block_turns: int):
    """Nodes of the rows ``part, turns, n_ends, conv_id, ends_sha256``, sorted by part and turns.

    A row without ``n_ends`` is the last sequence of an earlier part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = before = None
        held: list[pa.RecordBatch] = []
        size = 0

        def done() -> pa.RecordBatch:
            nonlocal before, held, size
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            (a, b, words), lengths = _flat(table.column("turns"))
            block = Block(
                a, b, words.astype(np.int64), lengths, table.column("n_ends").to_numpy(), table.column("conv_id").to_numpy(), before
            )
            tail = int(block.offsets[-2])
            before, held, size = (a[tail:].copy(), b[tail:].copy()), [], 0
            return block.nodes(table.column("ends_sha256"))

        for batch in batches:
            parts = batch.column("part").to_numpy()
            ghost = batch.column("n_ends").is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((parts[1:] != parts[:-1]) | ghost[:-1]) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(parts)], strict=True):
                if low == high:
                    continue
                if parts[low] != part:
                    if held:
                        yield done()
                    part, before = parts[low], None
                run = batch.slice(low, high - low)
                if ghost[low]:
                    (a, b, _), _ = _flat(run.column("turns"))
                    before = (a.copy(), b.copy())
                    continue
                held.append(run)
                size += len(run.column("turns").flatten()) + len(run)
                if size >= block_turns:
                    yield done()
        if held:
            yield done()

    return rows


def prefix_trie(chats: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of the ``turns`` of ``conv_id, turns`` (see ``sequences``), the empty one included.

    ``conv_id`` is the smallest conversation that starts with the prefix,
    ``parent_conv_id`` that of the prefix one turn shorter (root: null),
    ``n_convs`` the number of conversations, ``n_children`` of prefixes one
    turn longer, ``n_leaves`` of prefixes below (or the node itself) that
    nothing prolongs; ``saved_tokens`` sums ``(n_convs - 1) * words`` of the
    last turn over the node and all below it.  ``ends_sha256`` is the digest
    of the ascending ids of conversations that are just the prefix.
    ``turn_a, turn_b`` hash the last turn, see ``with_turns``.

    Conversations of equal turns are one leaf; one without turns ends at the
    root.  Each ``conv_id`` stands once; other columns are ignored; an empty
    table gives no rows, not even a root.
    """
    chats = cut_lineage(chats.select("conv_id", "turns"), "chats")
    distinct = chats.join(_ends(chats), "conv_id").select("turns", "n_ends", "conv_id", "ends_sha256")
    placed = cut_lineage(distinct.repartitionByRange("turns").withColumn("part", F.spark_partition_id()), "sorted-chats")
    following = placed.select("part").distinct().withColumn("next", F.lead("part").over(Window.orderBy("part")))
    last = placed.groupBy("part").agg(F.max("turns").alias("turns")).join(following.where("next IS NOT NULL"), "part")
    fed = placed.unionByName(last.select(F.col("next").alias("part"), "turns"), allowMissingColumns=True)
    nodes = cut_lineage(
        fed.select("part", "turns", "n_ends", "conv_id", "ends_sha256").repartition("part")
        .sortWithinPartitions("part", "turns").mapInArrow(_block_rows(block_turns), _NODE_DDL),
        "trie-nodes",
    )
    same = ["depth", "key_a", "key_b"]
    whole = F.lit(None).cast("long").alias("parent_conv_id")
    shared = cut_lineage(
        nodes.where("open").groupBy(*same).agg(
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            *(F.max(c).alias(c) for c in ("ends_sha256", "parent_a", "parent_b", "turn_a", "turn_b")),
        ),
        "shared-nodes",
    )
    every = nodes.where("NOT open").drop("open").unionByName(shared.withColumn("parent_conv_id", whole))
    parents = shared.select(
        (F.col("depth") + 1).alias("depth"), F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"),
        F.col("conv_id").alias("above"),
    )
    found = every.where("parent_conv_id IS NULL").join(parents, ["depth", "parent_a", "parent_b"], "left").withColumn(
        "parent_conv_id", F.col("above")
    )
    return every.where("parent_conv_id IS NOT NULL").unionByName(found.drop("above")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "turn_a", "turn_b",
    )


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with ``role`` and ``text`` of their last turn; the root has none."""
    known = turns.select(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    hashed = known.select(*(h.alias(f"turn_{h_name}") for h, h_name in zip(_turn_hash(F.col("role"), F.col("text")), "ab", strict=True)), "role", "text")
    return nodes.join(hashed, ["turn_a", "turn_b"], "left")


def rebuilt(chats: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations that begin as another: the first ``h`` turns of conversation ``c - c % group``, then the own from ``h`` on.

    ``h`` is the unsigned CRC-32 of the decimal id modulo ``most``; fewer
    turns are all taken, an absent conversation gives none.
    """
    chats = cut_lineage(chats, "chat-turns")
    heads = chats.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = chats.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn("h", h).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(_NO_TURNS)), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))
