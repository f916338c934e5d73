"""Operators in DataFrame functions, and exact top-k, beside plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import chat, exact_topk, line_dedup, url_filter

HARD = ["", None, "plain", "<|im_end|>", "<\\|im_end|>", "<\\\\|x|>", "a<", "|b", "<<|", "\\", "\\n<|", "é\n<|im_start|>user\n", "x" * 9000]


def test_escape_round_trip(spark):
    rng = random.Random(1)
    texts = [t or "" for t in HARD] + ["".join(rng.choice("<|\\ab\n") for _ in range(rng.randrange(12))) for _ in range(500)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"),
        chat.unescape_role(chat.escape_role(F.col("t"))).alias("r"), chat.escape_role(F.col("t")).alias("q"),
    )
    rows = frame.collect()
    assert all(r.u == r.t and r.r == r.t and "<|" not in r.e and "<|" not in r.q and "\n" not in r.q for r in rows)
    assert len({r.e for r in rows}) == len({r.t for r in rows})


def test_chats_read_back(spark):
    rng = random.Random(2)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(["system", "user", "assistant", "tool", "od\nd", None]), rng.choice(HARD), 1))
    rows += rows[:5]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    got = chat.format_chats(table).withColumn("read", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("segments"))
    )
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(r)
    found = got.collect()
    assert len(found) == len(want)
    for r in found:
        turns = sorted(want[r.conv_id], key=key)
        assert [(t.role, t.text) for t in r.read] == [(t[2] or "", t[3] or "") for t in turns]
        assert r.loss == "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted and r.n_turns == len(turns)


@pytest.mark.parametrize(
    ("roles", "valid", "bad"),
    [("ua", True, None), ("sua", True, None), ("u", False, None), ("au", False, 0), ("uaa", False, 2), ("sus", False, 2),
     ("uata", True, None), ("uxa", False, 1)],
)
def test_order_of_roles(spark, roles, valid, bad):
    names = {"u": "user", "a": "assistant", "s": "system", "t": "tool", "x": None}
    rows = [(1, i, names[r], "t") for i, r in enumerate(roles)]
    r = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert (r.valid, r.bad_turn) == (valid, bad)


def test_no_chats(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def lines_by_hand(rows, ratio, least):
    pages, seen = Counter(), Counter()
    for _, text, host, _ in rows:
        pages[host] += 1
        seen.update((host, line) for line in {x for x in (text or "").split("\n") if x.strip(" ")})
    bad = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for doc, text, host, extra in rows:
        kept = None if text is None else [x for x in text.split("\n") if (host, x) not in bad]
        out.append((doc, None if kept is None else "\n".join(kept), host, extra, 0 if kept is None else len(text.split("\n")) - len(kept)))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        host = rng.choice(["hot", "hot", "b", "c", None])
        lines = [rng.choice(["menu", "foot", " ", "", f"own {rng.randrange(300)}", "é|"]) for _ in range(rng.randrange(0, 7))]
        rows.append((i, rng.choice(["\n".join(lines)] * 9 + [None]), host, "x"))
    rows += [(5, "menu\nmenu", "hot", "x"), (None, "menu\nlonely", "rare", "x")] + [rows[0]] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, host string")
    got = sorted((tuple(r) for r in line_dedup.without_boilerplate(table, ratio=0.3).collect()), key=repr)
    want = lines_by_hand(rows, 0.3, 3)
    assert got == want and any(r[-1] for r in want)
    assert line_dedup.without_boilerplate(table.where("false")).collect() == []
    with pytest.raises(ValueError, match="apart"):
        line_dedup.without_boilerplate(table.withColumn("dropped_lines", F.lit(1)))


def test_urls_and_rules(spark):
    cases = [
        ("http://Shop.Example.ORG/es/a?b#c", "shop.example.org", "/es/a", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
        ("http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
        ("http://x.com/it/", "x.com", "/it/", None, "allow"),
        ("http://x.org", "x.org", "", None, "allow"), ("http://x.org?/a", "x.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("://h", "h", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://\u00c9.net/", "\u00c9.net", "/", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)], "page_id long, url string, host string")
    none = spark.createDataFrame([], "url string, good boolean")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, none).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    assert url_filter.judge_urls(pages.where("false"), none).collect() == []


def test_templates_are_rejected_by_their_labels(spark):
    rows = [(i, f"http://h.net/{'spam' if i % 3 else 'news'}/{i}.html") for i in range(600)]
    rows += [(1000 + i, f"http://deep.net/a/b/c/d/{i}/e/{i}") for i in range(50)] + [(0, rows[0][1])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(u, "spam" not in u) if i % 2 else (u, None) for i, u in rows if i < 600], "url string, good boolean")
    got = url_filter.judge_urls(pages, labels).collect()
    assert len(got) == len(rows)
    assert {(r.template, r.verdict) for r in got} == {
        ("h.net/spam/*", "block"), ("h.net/news/*", "allow"), ("deep.net/a/b/c/*", "allow"),
    }


def top_by_hand(rows, query, k):
    width = max(len(v) for _, v in rows)
    own = {i: np.array([*v, *[0] * (width - len(v))], dtype=object) for i, v in rows}
    out = []
    for q in own:
        if query(q):
            scored = sorted((-int(own[q] @ own[x]), x) for x in own if x != q)[:k]
            out += [(q, i + 1, x, -s) for i, (s, x) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize(("chunk", "block", "low", "high"), [(64, 16, -5, 5), (7, 3, 0, 2), (2048, 512, -(1 << 29), 1 << 29), (50, 50, -9, -1)])
def test_top_scores_equal_brute_force(spark, monkeypatch, chunk, block, low, high):
    monkeypatch.setattr(exact_topk, "CHUNK", chunk)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", block)
    rng = random.Random(chunk)
    rows = [(i * 3 - 90, [rng.randrange(low, high) for _ in range(6)]) for i in range(200)]
    rows += [(9001 + i, list(rows[5][1])) for i in range(12)] + [(10_000, [1]), (10_001, [0] * 6)]
    table = spark.createDataFrame([(*r, 1) for r in rows] + [(None, [1] * 6, 1), (8000, None, 1)], "vec_id long, vector array<long>, score int")
    got = exact_topk.top_scores(table.unionByName(table.where("vec_id = 0")).repartition(5), F.col("vec_id") % 5 == 0, k=5)
    assert sorted(tuple(r) for r in got.collect()) == top_by_hand(rows, lambda i: i % 5 == 0, 5)


def test_few_vectors_and_odd_components(spark):
    rows = [(0, [0.1, -0.1]), (50, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (100, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").where(exact_topk.usable(F.col("embedding")))
    vectors = table.select("vec_id", exact_topk.scaled(F.col("embedding")).alias("vector"))
    got = sorted(tuple(r) for r in exact_topk.top_scores(vectors, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 50, 25 * 128 - 26 * 128), (50, 1, 0, 25 * 128 - 26 * 128)]
    assert exact_topk.top_scores(vectors.where("false"), F.lit(True)).collect() == []
    assert exact_topk.top_scores(vectors.where("vec_id = 0"), F.lit(True)).collect() == []


def test_pipeline_drops_repeated_lines_on_every_host(spark):
    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    rows = []
    for host, share in enumerate((8, 9, 10, 11, 12, 13)):
        for i in range(200):
            lines = [" ".join(word() for _ in range(8)) for _ in range(3)]
            lines += ["repeated on every host"] * (i < 2 * share) + ["an ordinary line"] * (i % 25 == 3)
            rows.append((len(rows), "\n".join(lines), "en", f"h{host}", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_boilerplate(spark, docs, "").collect()
    assert not any("repeated" in r.text for r in got)
    assert sum("ordinary" in r.text for r in got) == 6 * 8
