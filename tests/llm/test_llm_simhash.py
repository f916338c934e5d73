"""SimHash components beside plain loops over all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cadastra.llm import simhash
from cadastra.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def print_by_hand(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, distance=3):
    """The smallest place reachable from each place of a list of fingerprints."""
    label = list(range(len(prints)))
    while True:
        after = [min(label[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= distance) for a in prints]
        if after == label:
            return label
        label = after


def test_fingerprints_equal_plain_loops(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 7)  # every text is cut
    texts = [
        None, "", " \t\n ", "One", "one TWO", "a b c", "a b c a b c a b c", "Ünter dem ẞ Baum İ Kelvin K",
        "x\x0by\x0cz w v u", "long" * 40 + " of a kind", "a b " * 300,
    ]
    assert [simhash.fingerprint(t) for t in texts] == [print_by_hand(t) for t in texts]
    assert simhash.fingerprint("ONE  two") == simhash.fingerprint("one\ttwo") != 0 == simhash.fingerprint(" ")


@pytest.mark.parametrize(("distance", "few"), [(3, 64), (3, 0), (2, 64), (1, 0)])
def test_links_equal_all_pairs(spark, distance, few):
    """A crowd around one fingerprint, chains and strangers; with ``few`` 0 every mixed variant goes to meeting points."""
    rng = random.Random(distance)
    far = [rng.getrandbits(64) for _ in range(40)]
    prints = list(far)
    for centre in far[:3]:
        for _ in range(40):
            prints.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, distance + 1))))
    prints.append(prints[-1] ^ 0x7)
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(p,) for p in [*signed, None]], "fp long")
    got = {r.fp: r.label for r in simhash.link_fingerprints(rows, distance, few).collect()}
    want = components_by_hand(prints, distance)
    groups, found = {}, {}
    for place, p in enumerate(signed):
        groups.setdefault(want[place], set()).add(p)
        found.setdefault(got.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))
    assert all(label == min(members) for label, members in found.items())
    assert max(map(len, groups.values())) > 5


def test_variants_meet_exactly_when_a_segment_is_near():
    for distance in (1, 2, 3):
        masks = simhash.variant_masks(distance)
        assert len(masks) == 64 and all(bin(m).count("1") == 64 // (distance // 2 + 1) - 1 for m in masks)
        rng = random.Random(0)
        for _ in range(200):
            other = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(other & m == 0 for m in masks)


def test_odd_rows(spark):
    text = "the same words in every copy of this short text " * 4
    rows = [(7, text), (3, text), (3, "another " + text), (None, text), (5, None), (9, ""), (9, " "), (4, "word"), (4, "word")]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(1)).withColumn("label", F.lit("x"))
    got = sorted((tuple(r) for r in simhash.simhash_copies(table).collect()), key=repr)
    prints = [print_by_hand(t) for _, t in rows]
    known = [i for i, r in enumerate(rows) if r[0] is not None]
    label = components_by_hand([prints[i] for i in known])
    least = {}
    for i, g in zip(known, label, strict=True):
        least[g] = min(least.get(g, 99), rows[i][0])
    want = [(None, f"{prints[3]:016x}", None)]
    want += [(rows[i][0], f"{prints[i]:016x}", least[g]) for i, g in zip(known, label, strict=True)]
    assert got == sorted(want, key=repr)
    assert simhash.simhash_copies(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        simhash.link_fingerprints(table.select(F.lit(1).cast("long").alias("fp")), 4)


def test_query_equals_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    prints = [print_by_hand(t) for _, t in docs]
    label = components_by_hand(prints)
    want = [(d, f"{p:016x}", docs[g][0]) for (d, _), p, g in zip(docs, prints, label, strict=True)]
    assert sorted(tuple(r) for r in QUERIES["op13_simhash_copies"](spark, FOLDER).collect()) == want


def test_exploded_variants_are_never_broadcast(spark, monkeypatch):
    """Spark plans an explode at the size of its input, so that millions of variants would pass for a small table."""
    plans, write = [], simhash.cut_lineage

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(simhash, "cut_lineage", lambda df, name: write(planned(df), name))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    rows = [(i, f"words of text {i} " * 3) for i in range(40)] * 2
    got = planned(simhash.simhash_copies(spark.createDataFrame(rows, SCHEMA)))
    assert got.count() == 80
    joins = [line for plan in plans for line in plan.split("\n") if "Join" in line]
    assert len(joins) > 8 and not [line for line in joins if "Broadcast" in line]
