"""The prefix trie beside a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm.prefix_trie import RangeMinimum, prefix_trie, rebuilt, sequences, with_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """conv_id -> its (role, text) turns."""
    chats = {}
    for c, turn, role, text in sorted(
        (r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    ):
        chats.setdefault(c, []).append((role or "", text or ""))
    return chats


def rebuilt_by_hand(chats):
    out = {}
    for c, own in chats.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = chats.get(c - c % 20, [])[:h] + own[h:]
    return out


def trie_by_hand(chats):
    members = {}
    for c, turns in chats.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        stack = [p]
        while stack:
            q = stack.pop()
            stack += children[q]
            yield q

    rows = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(chats[c]) == len(p))
        subtree = list(below(p))
        rows.append((
            min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]),
            sum(not children[q] for q in subtree), sum((len(members[q]) - 1) * words(q) for q in subtree),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=repr)


def rows_of(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


def many_chats(seed, n=300):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 2, 3, 5, 9])):
            rows.append((c, t, ["user", "assistant"][t % 2], rng.choice(["hi", "hi", "hi there", "a  b\tc", ""])))
    rows += [(n + k, t, "user", "hi") for k in range(100) for t in range(3)]  # a third are copies
    rows += [(9999, t, "user", "hi" if t < 40 else f"turn {t}") for t in range(120)]
    return rows


@pytest.mark.parametrize("block", [1, 40, 1 << 16])
def test_trie_equals_dictionary(spark, block):
    rows = many_chats(block)
    chats = rebuilt_by_hand(ordered(rows))
    table = spark.createDataFrame(rows, SCHEMA)
    got = rows_of(prefix_trie(rebuilt(sequences(table)), block))
    assert got == trie_by_hand(chats) and len(got) > 300


def test_odd_turns(spark):
    rows = [
        (0, None, "user", "first"), (0, 1, "b", "x"), (0, 1, "a", "z"), (0, 1, "a", "y"), (0, 1, "a", "y"), (0, 2, None, None),
        (1, 0, "user", None), (1, 1, "", "t"), (None, 0, "user", "nobody"), (25, 0, "user", "one"), (25, 1, "user", "two"),
        (41, 5, "user", "w " * 5000), (-3, 0, "user", "below"), (42, None, None, None),
    ]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit(1)).withColumn("a", F.lit("x")).withColumn("place", F.lit(0))
    chats = ordered(rows)
    assert chats[0][1:5] == [("a", "y"), ("a", "y"), ("a", "z"), ("b", "x")]
    assert rows_of(prefix_trie(sequences(table))) == trie_by_hand(chats)
    # Truncated remainders, as Spark and SQL have them.
    again = {c: chats.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[: zlib.crc32(str(c).encode()) % 4] for c in chats}
    again = {c: head + chats[c][zlib.crc32(str(c).encode()) % 4 :] for c, head in again.items()}
    got = prefix_trie(rebuilt(sequences(table)))
    assert rows_of(got) == trie_by_hand(again)
    assert any(not turns for turns in again.values())
    texts = {(r.depth, r.conv_id): (r.role, r.text) for r in with_turns(got, table).collect()}
    assert all(texts[d, c] == again[c][d - 1] for d, c in texts if d)
    assert prefix_trie(sequences(spark.createDataFrame([], SCHEMA))).collect() == []


def test_range_minimum_finds_extents():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 64, 100):
        values = rng.integers(0, 6, n)
        table = RangeMinimum(values)
        place, depth = rng.integers(0, n, 50), rng.integers(0, 7, 50)
        left, right = table.extents(place, depth)
        for p, d, l, r in zip(place, depth, left, right, strict=True):
            a = b = p
            while a > 0 and values[a] >= d:
                a -= 1
            while b + 1 < n and values[b + 1] >= d:
                b += 1
            assert (a, b) == (l, r)
        first = rng.integers(0, n, 50)
        last = np.minimum(n - 1, first + rng.integers(0, n, 50))
        assert table.of(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]
