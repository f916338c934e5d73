"""The registered queries beside their SQL, and the pipeline stage by stage beside brute force."""

import importlib.util
import os

import pytest

from cadastra.llm.queries import ORACLE, QUERIES
from cadastra.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")

_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _load(name, *path):
    spec = importlib.util.spec_from_file_location(name, os.path.join(_root, *path))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


oracle_check = _load("oracle_check", "tools", "oracle_check.py")
by_hand = _load("copies_by_hand", "tests", "llm", "test_llm_copies.py")


def test_one_query_of_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = oracle_check.connect(FOLDER)
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got, want = oracle_check.rows_of(df.columns, df.collect()), oracle_check.rows_of(names, cur.fetchall())
    assert want and got == want


@pytest.mark.parametrize("name", ["op3_line_dedup", "op7_chat_format", "op9_url_filter"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_copies_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op5_ngram_jaccard_join"](spark, FOLDER).collect()), key=repr)
    assert got == by_hand.components_by_hand(rows, 4, 85)


def test_packing_queries_hold_every_id(spark):
    from cadastra.llm import tokens

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    pieces = QUERIES["op6_pack_online"](spark, FOLDER).collect()
    assert {r.doc_id for r in pieces} == set(docs)
    assert sum(r.length for r in pieces) == sum(len(tokens.encode(t)) + 1 for t in docs.values())
    rows = QUERIES["op1_pack_bfd"](spark, FOLDER).collect()
    assert sum(r.n_tokens for r in rows) == sum(r.length for r in pieces)


def test_pipeline_stages_equal_brute_force(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    (_, identify), (_, drop_lines), (_, drop_copies), (_, drop_leaks), (_, pack) = p.STAGES

    spoken = identify(spark, docs, FOLDER)
    kept = {r.doc_id for r in spoken.collect()}
    letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert spoken.columns == columns and kept <= letters and len(kept) >= 0.98 * len(letters)

    lined = drop_lines(spark, spoken, FOLDER)
    assert lined.columns == columns and lined.count() == len(kept)
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    rows = [(r.doc_id, r.text) for r in lined.collect()]
    one = drop_copies(spark, lined, FOLDER)
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, _, c in by_hand.components_by_hand(rows, 5, 80)})

    rows = [(r.doc_id, r.text) for r in one.collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaked = {x[0] for x in by_hand.leaks_by_hand(rows, bench)}
    clean = drop_leaks(spark, one, FOLDER)
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - leaked and leaked

    pieces = pack(spark, clean, FOLDER).collect()
    ran = p.run(spark, FOLDER).collect()
    total = lambda rows: sorted({(r.doc_id, r.doc_tokens) for r in rows})
    assert {r.doc_id for r in pieces} == {i for i, _ in rows} - leaked
    assert total(ran) == total(pieces) and sum(r.length for r in ran) == sum(r.length for r in pieces)


@pytest.mark.parametrize("edits", [0, 2])
def test_one_of_a_third_of_copies_keeps_its_text(spark, tmp_path, edits):
    import random

    import corpus_pipeline as p

    rng = random.Random(7)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pool = sorted({w for r in given.collect() for w in r.text.split() if w.isalpha()})
    base = [rng.choice(pool) for _ in range(180)]
    rows = []
    for i in range(given.count() // 2):
        words = list(base)
        for _ in range(edits if i else 0):
            words[rng.randrange(len(words))] = f"{rng.choice(pool)}{i}"
        text = "\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))
        rows.append((10**6 + i, text, "en", f"src{i % 20}", len(text)))
    texts = {r[0]: r[1] for r in rows}
    given.unionByName(spark.createDataFrame(rows, given.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in p.STAGES[1:-1]:
        docs = cut_lineage(stage(spark, docs, str(tmp_path)))
    left = [(r.doc_id, r.text) for r in docs.where(f"doc_id >= {10**6}").collect()]
    assert left == [(i, texts[i]) for i, _ in left] and len(left) == 1
