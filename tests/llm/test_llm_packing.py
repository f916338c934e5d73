"""Token ids and both packings: exact round trips and bounds."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
hypothesis = pytest.importorskip("hypothesis")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from cadastra.llm import bfd_packing, online_packing, tokens  # noqa: E402

ROWS = [
    (1, "a short text"), (2, ""), (3, None), (4, "word " * 5000), (5, "same text"), (5, "same text"),
    (None, "no id"), (7, "x" * 3000), (8, "été\n\n  über <|endoftext|> 漢字"), (9, "tail " * 700),
]
SCHEMA = "doc_id long, text string, sequence_id string, offset int"


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=200))
def test_ids_equal_the_json_tokenizer(text):
    want = tokens.reference_tokenizer(tokens.json_file()).encode(text, add_special_tokens=False).ids
    assert tokens.encode(text).tolist() == want


@pytest.mark.parametrize("text", [" \n\t " * 50, "aaaa" * 5000, "1234567890" * 300, "a<|endoftext|>b", "it's  we'll\r\n", "\x00\x85 x"])
def test_ids_of_odd_texts(text):
    want = tokens.reference_tokenizer(tokens.json_file()).encode(text, add_special_tokens=False).ids
    assert tokens.encode(text).tolist() == want


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def _wanted(rows, end):
    return sorted((-1 if i is None else i, (*tokens.encode(t).tolist(), end)) for i, t in rows)


@pytest.mark.parametrize("partitions", [1, 3, 40])
@pytest.mark.parametrize("length", [16, 2048])
def test_online_round_trip(spark, partitions, length):
    got = online_packing.pack_online(
        _table(spark, ROWS).repartition(partitions), length=length, open_windows=3, min_cut=4, merge=4
    ).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length > 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids.tolist()))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
    short = [(i, t) for i, t in ROWS if i != 5]
    want = _wanted(short, online_packing.END_ID)
    have = sorted(
        (-1 if i is None else i, tuple(x for _, part in sorted(parts) for x in part)) for (i, _), parts in by_doc.items() if i != 5
    )
    assert have == want
    # The repeated row is packed twice.
    assert sum(n for _, n in [(r.doc_id, r.length) for r in got if r.doc_id == 5]) == 2 * (len(tokens.encode("same text")) + 1)


def test_online_pads_little(spark):
    rows = [(i, "some words " * (i % 90 + 1)) for i in range(600)]
    got = online_packing.pack_online(_table(spark, rows).repartition(8), length=256, keep_ids=False).collect()
    total = sum(r.length for r in got)
    sequences = len({r.sequence_id for r in got})
    assert sequences * 256 - total < 256 + 0.03 * total
    assert all(r.ids is None or r.length for r in got)


def test_online_empty(spark):
    assert online_packing.pack_online(_table(spark, ROWS).where("false")).collect() == []


def test_packer_keeps_a_fixed_number_open():
    out = []
    packer = online_packing.Packer(out.append, 100, 4, 5)
    rng = np.random.default_rng(3)
    for doc in range(400):
        packer.add(doc, np.zeros(int(rng.integers(1, 350)), dtype="<u4"))
        assert len(packer.room) <= 4
    filled = [sum(len(p[2]) for p in w) for w in out]
    assert max(filled) == 100 and min(filled) > 95


@given(st.lists(st.integers(1, 64), max_size=200))
@settings(max_examples=100, deadline=None)
def test_best_fit_decreasing_is_what_it_says(lengths):
    rows = bfd_packing.best_fit_decreasing(lengths, 64)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= 64 for r in rows)
    # The plain form: the fullest row that holds the piece.
    rooms = []
    for piece in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= piece]
        if fits:
            rooms[rooms.index(min(fits))] -= piece
        else:
            rooms.append(64 - piece)
    assert len(rooms) == len(rows)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(rooms)


@pytest.mark.parametrize("shard", [50, 4_000_000])
def test_matrix_round_trip(spark, tmp_path, shard):
    path = str(tmp_path / "matrix")
    bfd_packing.write_matrix(_table(spark, ROWS).repartition(2), path, length=64, shard_ids=shard)
    by_doc = {}
    for r in spark.read.parquet(path).collect():
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == 64 and r.segment_ends[0] == 0 and r.segment_ends[-1] == r.n_tokens
        assert r.position_resets == r.segment_ends[:-1]
        assert (ids[r.n_tokens :] == bfd_packing.END_ID).all()
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.segment_ends, r.segment_ends[1:], strict=False):
            by_doc.setdefault(doc, []).append((start, ids[a:b].tolist()))
    by_doc.pop(5)
    have = sorted((-1 if i is None else i, tuple(x for _, p in sorted(v) for x in p)) for i, v in by_doc.items())
    assert have == _wanted([(i, t) for i, t in ROWS if i != 5], bfd_packing.END_ID)
    assert bfd_packing.read_matrix(spark.read.parquet(path), 64).shape[1] == 64


def test_matrix_empty(spark):
    assert bfd_packing.pack_matrix(_table(spark, ROWS).where("false")).collect() == []


def test_matrix_refuses_ids_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="fit"):
        bfd_packing.pack_matrix(_table(spark, ROWS), end_id=70_000)
