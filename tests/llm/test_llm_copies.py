"""Shingle arrays, components, the n-gram join and decontamination beside brute force."""

import random
import re

import numpy as np
import pytest

from cadastra.llm import components, decontaminate, ngram_join, text_arrays

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words_of(text):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    return WORD.findall((text or "").encode().translate(lower))


def shingles(words, size):
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def components_by_hand(rows, size, percent):
    sets = [shingles(words_of(t), size) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    links = [
        (x, y)
        for x in range(len(rows)) for y in range(x)
        if sets[x] and sets[y] and rows[x][0] is not None and rows[y][0] is not None
        and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
    ]
    while changed:
        changed = False
        for x, y in links:
            low = min(label[x], label[y])
            changed |= label[x] != label[y]
            label[x] = label[y] = low
    out = [(i, len(s), c if s else i) for (i, _), s, c in zip(rows, sets, label, strict=True)]
    return sorted(out, key=repr)


def corpus(seed=5):
    """Copies, chains of edits, a passage shared by many, repeated words and odd rows."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(pool) for _ in range(n)]
    rows, base, passage = [], text(150), text(60)
    for i in range(90):
        edited = list(base)
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(edited))
            kind = rng.random()
            if kind < 0.4:
                edited[at] = rng.choice(pool)
            elif kind < 0.7:
                del edited[at]
            else:
                edited.insert(at, rng.choice(pool[:5]))
        rows.append((1000 - i, " ".join(edited)))
    rows += [(2000 + i, " ".join(text(rng.randrange(1, 60)) + passage + text(rng.randrange(1, 30)))) for i in range(60)]
    rows += [(3000 + i, " ".join(text(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(4000 + i, " ".join(passage)) for i in range(40)]
    long = text(3000)
    rows += [(5000 + i, " ".join(long[: 3000 - 90 * i])) for i in range(10)]
    rows += [(6000, ""), (6001, None), (6002, " \n\t"), (6003, "One Two"), (6004, "one  two"), (6005, "three"), (None, "one two")]
    rows += [(7000, "same row of a few words"), (7000, "same row of a few words")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent", "rare"), [(4, 85, 16), (5, 80, 16), (4, 85, 1), (3, 60, 4)])
def test_components_equal_brute_force(spark, size, percent, rare):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, n long, component_id string")
    got = sorted((tuple(r) for r in ngram_join.link_copies(docs, size, percent, rare).collect()), key=repr)
    assert got == components_by_hand(rows, size, percent)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.link_copies(docs).collect() == []
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_of_each_component_stays(spark):
    rows = corpus(8)
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, gone string")
    kept = ngram_join.keep_one(docs, ngram_join.link_rows(docs, 5, 80))
    assert kept.columns == docs.columns
    want = [c for c in {c for i, _, c in components_by_hand(rows, 5, 80) if i is not None}]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)
    assert kept.where("doc_id IS NULL").count() == 1


def test_chain_and_star_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    rng.shuffle(links)
    got = {r.node: r.label for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {500 + i: 500 for i in range(40)} | {900: 900, 901: 900}
    assert got == want


def test_words_do_not_depend_on_slices(monkeypatch):
    texts = ["a bb  ccc\nDDD", "", None, "x" * 500, "é ü " * 50, " lead and trail "]
    for letters in (False, True):
        whole, bounds = text_arrays.word_hashes(texts, letters)
        monkeypatch.setattr(text_arrays, "SLICE", 7)
        cut, cut_bounds = text_arrays.word_hashes(texts, letters)
        monkeypatch.undo()
        assert np.array_equal(whole, cut) and np.array_equal(bounds, cut_bounds)
    assert np.diff(text_arrays.word_hashes(texts)[1]).tolist() == [len(words_of(t)) for t in texts]


BENCH = [
    (1, "one two three four five six seven eight nine ten"), (2, "short item"), (3, None), (4, ""),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"),
    (None, "an item without an id but with words"),
]


def leaks_by_hand(docs, bench, size=5, percent=80):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = []
    for item, text in set(bench):
        n = min(size, len(split(text)))  # an item of fewer words is looked for as one run of them
        own = shingles(split(text), n)
        for doc, body in docs if own else []:
            hit = len(own & shingles(split(body), n))
            if 100 * hit >= percent * len(own):
                out.append((doc, item, len(own), hit))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [3, 2_000_000])
def test_leaks_equal_brute_force(spark, block):
    rng = random.Random(4)
    filler = lambda n: " ".join(rng.choice(["red", "green", "blue", "sky"]) for _ in range(n))
    rows = [(0, None), (1, ""), (2, "short item"), (3, "Short, ITEM!"), (None, BENCH[0][1])]
    for i in range(60):
        item = rng.choice([b[1] for b in BENCH if b[1]]).split()
        for _ in range(rng.randrange(0, 3)):
            item[rng.randrange(len(item))] = "changed"
        rows.append((10 + i, f"{filler(rng.randrange(0, 400))} {' '.join(item).title()}. {filler(30)}"))
    rows += [(100, rows[10][1]), (100, rows[10][1])]
    docs = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    want = leaks_by_hand(rows, BENCH)
    got = sorted((tuple(r) for r in decontaminate.find_leaks(docs, bench, block=block).collect()), key=repr)
    assert got == want and len({w[1] for w in want}) >= 3
    clean = decontaminate.without_leaks(docs, bench, block=block)
    leaked = {w[0] for w in want}
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted((i for i, _ in rows if i not in leaked), key=repr)


def test_leaks_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).collect() == []
    assert decontaminate.without_leaks(docs, bench).count() == 1
    assert decontaminate.find_leaks(docs.where("false"), spark.createDataFrame(BENCH, "item_id long, text string")).collect() == []


def test_labels_found_before_take_one_round(spark, monkeypatch):
    """Stars settle in one round of two tables, so that joining them with further links costs no more rounds than those need."""
    from cadastra.operators import components as joined

    written, write = [], joined.cut_lineage
    monkeypatch.setattr(joined, "cut_lineage", lambda df, name: (written.append(name), write(df, name))[1])
    rows = [(2, 1), (1, 3), (3, 1), (9, 8), (4, 4), (None, 5)]
    got = joined.components(spark.createDataFrame(rows, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)]
    assert written == ["links", "large-stars", "stars"]
