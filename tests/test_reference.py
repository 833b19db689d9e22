"""Operators on small inputs whose results are known, and against plain Python."""

from __future__ import annotations

import itertools
import json
import math
import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill.functions import register
from lexmill.functions import text as T
from lexmill.operators import chunking, evaluate, fusion, gold_rules, lexical, synth, vector
from lexmill.operators import pages as P
from lexmill.operators.best import Best
from lexmill.plans import gold_queries
from lexmill.plans.engine import Cache, Engine, RetrievalConfig
from lexmill.sources import readers, writers
from lexmill.streaming import ingest


def pages(spark, texts, doc="d"):
    return spark.createDataFrame([(doc, i + 1, t) for i, t in enumerate(texts)], "doc_id string, page_num long, text string")


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column).first()[0]


# cleaning and pages


def test_shares_are_written_as_other_engines_do(spark):
    own = [0.0, 1e-7, 1e-6, 9e-6, 1e-5, 1.2e-5, 9.9e-5, 1e-4, 0.00039, 0.001, 0.02, 0.1, 0.123456, 1 / 3, 0.5, 1.0]
    got = spark.createDataFrame(list(enumerate(own)), "k long, v double").select("k", T.millionths(F.col("v"))).orderBy("k").collect()
    assert [r[1] for r in got] == [r[0] for r in duckdb.connect().execute("SELECT round(unnest(?::DOUBLE[]), 6)::VARCHAR", [own]).fetchall()]


def test_clean_joins_hyphens(spark):
    got = one(spark, T.clean_block(F.col("t")), t="Header\r\nSection\nLong-\nword  continues here \n\n\n\nFooter\n")
    assert got == "Header\nSection\nLongword continues here\n\nFooter"


@pytest.mark.parametrize("text", ["", "a", "a\n", "a\r\nb\x0bc\x85d e\x1cf", "\n\n", "x\r\n"])
def test_lines_and_strip(spark, text):
    assert one(spark, T.lines(F.col("t")), t=text) == text.splitlines()
    assert one(spark, T.strip(F.col("t")), t=f" \t  {text}\x1f\n") == f" \t  {text}\x1f\n".strip()


def test_headers_and_footers_go(spark):
    own = pages(spark, [f"ACME Report\nbody {i}\nline\nPage footer" for i in range(3)])
    assert sorted(r.text for r in P.strip_edges(own).collect()) == [f"body {i}\nline" for i in range(3)]


def test_routes(spark):
    of = lambda texts, least: P.density(pages(spark, texts), least).join(P.layout(pages(spark, texts)), "doc_id").select(P.fallback_reason(F.col("total_pages"), F.col("empty_page_ratio"), F.col("layout_complexity"))).first()[0]
    assert of(["", "Digits 123\n45 67", " "], 200) == "empty_ratio"
    assert of(["x" * 250, "y" * 250], 300) == "empty_ratio"
    assert of(["a dense line of words that goes on for more than forty characters\n" * 5] * 2, 10) is None


@pytest.mark.parametrize("planned, per_doc, total, allowed", [([2, 2, 1], 5, 3, [2, 1, 0]), ([2, 3, 1], 800, 1200, [2, 3, 1])])
def test_page_budget(spark, planned, per_doc, total, allowed):
    files = spark.createDataFrame([(i, f"f{i}", n) for i, n in enumerate(planned)], "file_ord long, file_name string, planned_pages long")
    got = P.page_budget(files, per_doc, total)
    assert [r.allowed for r in got.orderBy("file_ord").collect()] == allowed
    report = P.run_report(got).first()
    assert (report.total_docs, report.total_pages, report.truncated) == (sum(a > 0 for a in allowed), sum(allowed), allowed != planned)


def test_running_sum_over_blocks(spark):
    own = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("o"))
    got = P.running_sum(own, "g", "o", F.col("o"), "before", block=64).toPandas().sort_values(["g", "o"])
    want = got.groupby("g")["o"].cumsum() - got["o"]
    assert (got["before"] == want).all()


# chunking


def test_long_text_gives_windows():
    made = chunking.pack([{"kind": "paragraph", "text": " ".join(f"token{i}" for i in range(1000)), "page_num": 1}], 700, 200, 100, 3)
    assert [c["token_len"] for c in made] == [700, 400]


def test_pack_contract():
    r = random.Random(1)
    for _ in range(50):
        own = [{"kind": r.choice(["paragraph", "heading"]), "text": " ".join(f"w{r.randint(0, 10**6)}" for _ in range(r.randint(0, 80))), "page_num": 1 + i // 4} for i in range(20)]
        made = chunking.pack(own, 100, 40, 10, 3)
        words = set(itertools.chain.from_iterable(c["text"].split() for c in made))
        assert words == set(itertools.chain.from_iterable(b["text"].split() for b in own))  # no token is lost
        assert all(c["token_len"] <= 100 or c["merged_tail"] for c in made)
        assert all(c["page_start"] <= c["page_end"] for c in made)


def test_small_blocks_grow_past_the_limit_and_tails_merge():
    block = lambda n, k=0: {"kind": "paragraph", "text": " ".join(f"b{k}_{i}" for i in range(n)), "page_num": 1}
    made = chunking.pack([block(30, 1), block(90, 2)], 100, 40, 0, 3)
    assert [c["token_len"] for c in made] == [100, 20]
    made = chunking.pack([block(90, 1), block(90, 2), block(5, 3)], 100, 40, 0, 3)
    assert [(c["token_len"], c["merged_tail"]) for c in made] == [(90, False), (95, False)]
    made = chunking.pack([block(90, 1), block(98, 2), block(5, 3)], 100, 40, 0, 3)
    assert [(c["token_len"], c["merged_tail"]) for c in made] == [(90, False), (103, True)]


def test_tables_stay_fixed(spark):
    made = chunking.chunk_documents(pages(spark, ["Row | Col\n1 | 2 | 3\n4 | 5 | 6"])).collect()
    assert [c.strategy for c in made] == ["fixed_table"] and made[0].chunk_id == "d:0"
    prose = ". ".join(f"Sentence number {i} has quite a few words in it so that lines are long" for i in range(20))
    assert chunking.chunk_documents(pages(spark, [prose])).first().strategy == "semantic"


def test_windows_of_sentences_are_hashed_once(monkeypatch):
    r, asked = random.Random(8), []
    parts = [" ".join(r.choices(["Red", "fox", "ΟΔΟΣ", "İl", "sun", "ß", "\u3000"], k=r.randrange(7))) for _ in range(60)] + ["", " "]
    want = [chunking.hashed_embedding(" ".join(parts[max(0, i - 1) : i + 2])) for i in range(len(parts))]
    assert np.array_equal(chunking._hashed_windows(parts, 1), np.array(want))
    assert chunking.semantic_groups(parts) == chunking.semantic_groups(parts, lambda t: chunking.hashed_embedding(t))
    monkeypatch.setattr(chunking, "_word_hash", lambda w: asked.append(w) or 1)
    chunking.semantic_groups(parts)
    assert len(asked) == sum(len(p.lower().split()) for p in parts)


def test_runs_are_packed_without_frames(spark):
    long = ". ".join(f"Sentence number {i} has quite a few words in it so that lines are long" for i in range(90))
    made = chunking.chunk_documents(pages(spark, [long, "a | b\n1 | 2", long]))
    assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()
    got = sorted(made.collect(), key=lambda c: (c.run_id, c.chunk_seq))
    assert [c.run_id for c in got] == sorted(c.run_id for c in got) and {c.run_id for c in got} == {0, 1, 2}
    assert [c.chunk_id for c in got] == [f"d:{i}" for i in range(len(got))] and {c.strategy for c in got} == {"semantic", "fixed_table"}


def test_block_spans(spark):
    text = "INTRO\n\nfirst paragraph\nof two lines\n \nsecond  "
    for b in chunking.blocks(pages(spark, [text])).collect():
        assert text[b.char_start : b.char_end].strip() == b.text
    assert [b.kind for b in chunking.blocks(pages(spark, [text])).orderBy("block_seq").collect()] == ["heading", "paragraph", "paragraph"]


def test_guardrail_ends_only_its_document(spark):
    own = spark.createDataFrame([(1, 0, 5), (1, 1, 9), (1, 2, 1), (2, 0, 3), (2, 1, 4), (3, 0, 2)], "doc_ord long, chunk_seq long, token_len long")
    assert sorted((r.doc_ord, r.chunk_seq) for r in chunking.guardrail(own, 10).collect()) == [(1, 0), (2, 0), (3, 0)]


# retrieval


def test_bm25_counts_repeats_and_fills_with_zeros(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c", "a a d", "e f", "", "g h"])], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "b b"), (1, "zzz")], "item_id long, text string")
    got = lexical.search(docs, asked, 3).orderBy("item_id", "rank").collect()
    assert [(r.item_id, r.doc_id) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2)]
    once = lexical.search(docs, spark.createDataFrame([(0, "b")], "item_id long, text string"), 1).first()
    assert got[0].score == pytest.approx(2 * once.score) and got[1].score == 0


def bm25_by_hand(docs, asked, words=r"[a-z0-9]+"):
    """{query: {id: score}} of the chunks that share a word."""
    bags = {i: Counter(re.findall(words, t)) for i, t in docs}
    mean, df = sum(sum(b.values()) for b in bags.values()) / len(bags), Counter(w for b in bags.values() for w in b)
    plain = {w: math.log(len(bags) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    idf = {w: 0.25 * sum(plain.values()) / len(plain) if x < 0 else x for w, x in plain.items()}
    part = lambda b, w: idf[w] * b[w] * 2.5 / (b[w] + 1.5 * (0.25 + 0.75 * sum(b.values()) / mean))
    return {q: {i: sum(part(b, w) for w in re.findall(words, t) if w in b) for i, b in bags.items() if set(b) & set(re.findall(words, t))} for q, t in asked}


@pytest.fixture
def tables_written(monkeypatch):
    """Row counts of the tables that BM25 writes."""
    sizes, write = [], lexical.written

    def spy(rows, name):
        out = write(rows, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(lexical, "written", spy)
    return sizes


def test_hard_negatives_against_brute_force(spark, monkeypatch, tables_written):
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 7)
    monkeypatch.setattr(lexical, "_MOST_COMMON", 2)
    r = random.Random(1)
    texts = [" ".join(["the", *r.choices("abcdefghijklmnop", k=r.randrange(12))]) for _ in range(120)]
    rows = [(f"c{i}", f"d{i % 3}" if i % 11 else None, i % 5 if i % 7 else None, t) for i, t in enumerate(texts)]
    chunks = spark.createDataFrame(rows, "chunk_id string, doc_id string, page_start long, text string").repartition(5)
    gold = spark.createDataFrame([(i, t, "x the", d, p) for i, (_, d, p, t) in enumerate(rows[:40])], "id long, question string, answer_text string, doc_id string, page_start long")
    got = {x.id: x.hard_negative_ids for x in lexical.hard_negatives(chunks, gold).collect()}
    scores = bm25_by_hand([(c, t) for c, _, _, t in rows], [(i, f"{rows[i][3]} x the") for i in range(40)])
    place = {c: (d, p) for c, d, p, _ in rows}
    for q, found in scores.items():
        other = sorted((c for c in found if place[c] != rows[q][1:3]), key=lambda c: (-round(found[c], 9), c))
        assert got[q] == other[:5]
    assert max(tables_written) < 600  # 40 queries meet 120 chunks; not the 4 800 pairs, and postings are packed


def test_products_of_common_and_rare_words(monkeypatch):
    monkeypatch.setattr(lexical, "_PRODUCTS", 50)
    monkeypatch.setattr(lexical, "_MOST_COMMON", 2)
    r = np.random.default_rng(3)
    weight, value = r.normal(size=(30, 17)) * (r.random((30, 17)) < 0.4), r.normal(size=(23, 30)) * (r.random((23, 30)) < 0.4)
    t, q = np.nonzero(weight)
    entries = pa.table({"q": pa.array(q), "term": pa.array([f"t{x}" for x in t]), "weight": pa.array(weight[t, q]), "df": pa.array((value != 0).sum(axis=0)[t])})
    own = lexical.block(pa.array(np.arange(17)), entries, 23)
    at = [int(str(x)[1:]) for x in own.terms]
    d, k = np.nonzero(value[:, at])
    assert own.full.shape == (2, 17)
    np.testing.assert_allclose(lexical.products(own, d, k, value[:, at][d, k], 23), value @ weight, atol=1e-12)
    np.testing.assert_array_equal(lexical.products(own, d, k, value[:, at][d, k], 23, ones=True), (value != 0).astype(int) @ (weight != 0).astype(int))


@pytest.mark.parametrize("cap", [None, 2])
def test_best_of_tiles(cap):
    r = np.random.default_rng(4)
    scores, ids = r.integers(0, 40, size=(900, 6)) / 7 + 1e-13 * r.normal(size=(900, 6)), r.permutation(900)
    for named in (ids, np.array([f"{i:04}" for i in ids], object)):
        kept = Best(6, 5, cap)
        kept.waiting = -10**9 if cap else 10**6  # cut at the end alone, or once early
        for a in range(0, 900, 70):
            kept.add(scores[a : a + 70], named[a : a + 70], scores[a : a + 70] < 5, ids[a : a + 70] % 3 if cap else None)
        q, i, s = kept.rows()
        for n in range(6):
            order = [j for j in np.lexsort((ids, -np.round(scores[:, n], 9))) if scores[j, n] < 5]
            want = [j for k, j in enumerate(order[:400]) if cap is None or sum(ids[o] % 3 == ids[j] % 3 for o in order[:k]) < cap][:5]
            assert named[want].tolist() == i[q == n].tolist()


def test_vector_search_multiplies_tiles():
    r = np.random.default_rng(5)
    rows, ids = r.normal(size=(10_000, 4)).astype(np.float32), np.arange(2000)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), pa.array(list(rows))], names=["vec_id", "embedding"])
    tracemalloc.start()
    got = list(vector._kept(iter([batch]), ids, rows[:2000].astype(float), 3, "vec_id", None, True))[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6  # all scores of the batch are 160 MB
    for q in (0, 1999):
        s = rows.astype(float) @ rows[q].astype(float)
        s[q] = -np.inf
        assert got["vec_id"].to_numpy()[got["query_id"].to_numpy() == q].tolist() == np.argsort(-s)[:3].tolist()


def test_capped_lists_of_parts_merge(spark):
    r = random.Random(2)
    docs = [(i, " ".join(r.choices("abcdef", k=6))) for i in range(60)]
    own = spark.createDataFrame([(i, t, f"s{i % 4}") for i, t in docs], "doc_id long, text string, source string").repartition(6)
    asked = [(0, "a b"), (1, "c"), (2, "zzz")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    rows = lexical.best(lexical.build(own, keep={"kept": F.col("source")}), items, 5, cap=2).collect()
    for q, found in bm25_by_hand(docs, asked).items():
        cut = lambda ids, score: [i for i in sorted(ids, key=lambda i: (-round(score[i], 9), i))]
        keep = lambda ids: [i for k, i in enumerate(ids) if sum(j % 4 == i % 4 for j in ids[:k]) < 2][:5]
        mine = {x.doc_id: x.score for x in rows if x.item_id == q}
        assert keep(cut(mine, mine)) == keep(cut(found, found))


def test_search_keeps_few_rows(spark, tables_written):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("all of them "), F.col("id").cast("string")).alias("text"))
    asked = spark.range(20).select(F.col("id").alias("item_id"), F.concat(F.lit("all "), F.col("id").cast("string")).alias("text"))
    got = lexical.search(docs, asked, 2).collect()
    assert len(got) == 40 and all(r.item_id == r.doc_id for r in got if r["rank"] == 1)
    assert max(tables_written) < 400  # 6 000 pairs share a word


def test_fusion_by_hand(spark):
    a = spark.createDataFrame([("q", "x", 9.0, 1), ("q", "y", 5.0, 2)], "query_id string, chunk_id string, score double, rank int")
    b = spark.createDataFrame([("q", "y", 3.0, 1), ("q", "z", 3.0, 2)], "query_id string, chunk_id string, score double, rank int")
    got = {r.chunk_id: r.fused for r in fusion.rrf(a, b, 60).collect()}
    assert got == pytest.approx({"x": 1 / 61, "y": 1 / 62 + 1 / 61, "z": 1 / 62})
    assert {r.chunk_id: r.fused for r in fusion.weighted(a, b).collect()} == pytest.approx({"x": 0.6, "y": 0.4, "z": 0.4})
    swapped = {r.chunk_id: r.fused for r in fusion.rrf(b, a, 60).collect()}
    assert swapped == pytest.approx(got)


def test_context_choice():
    v = [np.array([1.0, 0]), np.array([1.0, 0]), np.array([0, 1.0]), None]
    pick = fusion.select_for_context
    assert pick(["a", "b", "c", "d"], [0.9, 0.8, 0.7, 0.1], list("wxyz"), [10] * 4, v, budget=20) == [0, 2]
    assert pick(["a", "b", "c"], [0.9, 0.8, 0.7], ["w", "w", "w"], [10] * 3, None, budget=100, cap=2) == [0, 1]
    assert pick(["a", "b"], [0.9, 0.8], ["w", "x"], [500, 5], None, budget=100) == [0]
    assert pick(["a", "a"], [0.9, 0.9], ["w", "w"], [0, 0], None) == [0]


def test_vector_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector, "QUERY_BLOCK", 3)
    r = np.random.default_rng(0)
    x = r.normal(size=(40, 8)).astype(np.float32)
    own = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")
    got = vector.search(own, own.where("vec_id % 5 = 0"), 3).toPandas()
    for q in range(0, 40, 5):
        want = np.argsort(-(x.astype(float) @ x[q].astype(float)), kind="stable")[:3]
        assert got[got.query_id == q].sort_values("rank").vec_id.tolist() == want.tolist()


def test_rerank_keeps_all_unless_asked(spark):
    rows = spark.createDataFrame([("q", i, "red fox", t, i + 1) for i, t in enumerate(["blue", "red fox", "fox"])], "query_id string, chunk_id long, query string, text string, rank int")
    assert [r.chunk_id for r in fusion.rerank(rows, 1).orderBy("rerank_rank").collect()] == [1, 2, 0]
    assert fusion.rerank(rows, 1, truncate=True).count() == 1
    assert {r.rerank_score for r in fusion.rerank(rows, 0).collect()} == {0.0}


# evaluation


def test_metrics_by_hand(spark):
    res = spark.createDataFrame([("e", 1, k, p, p) for k, p in enumerate([9, 3, 8, 3], 1)], "engine string, query_id long, rank int, page_start int, page_end int")
    gold = spark.createDataFrame([(1, 2, 4)], "query_id long, page_start int, page_end int")
    got = evaluate.judged(res, gold).groupBy("query_id").agg(evaluate.hit_at(1).alias("h1"), evaluate.hit_at(2).alias("h2"), evaluate.mrr_at(10).alias("m"), evaluate.ndcg_at(10).alias("n")).first()
    want = (1 / np.log2(3) + 1 / np.log2(5)) / (1 + 1 / np.log2(3))
    assert (got.h1, got.h2, got.m) == (0, 1, 0.5) and got.n == pytest.approx(want)


def test_bootstrap(spark):
    own = spark.createDataFrame([("a", "b", i, 0.1 + 0.01 * (i % 5)) for i in range(60)], "engine_a string, engine_b string, query_id long, diff double")
    got = evaluate.bootstrap(own, 300).first()
    assert got.ci_low < got.diff_mean < got.ci_high and got.p_value == 0.0
    again = evaluate.bootstrap(own, 300).first()
    assert got == again


# gold rules


def test_candidates_hold_their_places(spark):
    text = "SYSTEM OVERVIEW\n\nThe cache is a store of recent pages. It helps.\n\nTimeout: 30 seconds allowed\nFigure 1: Flow of data\nThe NASA API keeps 40 GB"
    own = spark.createDataFrame([("d", "Doc", 1, text)], "doc_id string, doc_name string, page_num long, text string")
    got = gold_rules.harvest(own, 20).collect()
    assert {r.source_type for r in got} == {"heading_para", "definition", "table", "caption", "numeric"}
    assert all(text[r.char_start : r.char_end] == r.answer_text for r in got)
    kept = gold_rules.extract(own).collect()
    assert kept and all(r.question.endswith("?") for r in kept) and len({r.wh for r in kept}) >= 4
    assert own.select(gold_rules.nearest_heading(F.col("text"), F.lit(60))).first()[0] == "SYSTEM OVERVIEW"


@pytest.mark.parametrize("text", ["A cache is fast. Memory refers to state", "x are y is z means w", "no", "Größe is wichtig"])
def test_definitions_match_python(spark, text):
    pattern = re.compile(r"\b([\w\-/ ]{2,70}?)(?:\s+is|\s+are|\s+refers to|\s+means|\s+defined as)\b", re.I)
    got = one(spark, gold_rules.match_spans(F.col("t"), gold_rules.DEFINITION), t=text)
    assert [(m["start"], m["end"]) for m in got] == [m.span() for m in pattern.finditer(text)]


def test_wh_quota_shapes(spark):
    asked = [f"What is thing {i}?" for i in range(6)] + ["Why is it so?", "How does it work?", "Which one is it?", "When was it?"]
    got = gold_rules.wh_quota(spark.createDataFrame([(q,) for q in asked], "question string")).collect()
    assert sum(r.wh == "what" for r in got) <= 4 and {"why", "how", "which", "when"} <= {r.wh for r in got}


def test_stratified_sample_takes_no_row_twice(spark):
    rows = spark.createDataFrame([(i, ["x" if i % 4 else "y"]) for i in range(50)], "k long, tags array<string>")
    got = [r.k for r in gold_rules.stratified_sample(rows, {"x": 0.2, "y": 0.5}, 20, "k").collect()]
    assert len(got) == len(set(got)) == 20 and sum(k % 4 == 0 for k in got) >= 10


def test_segments_and_chunks_hold_all_sentences(spark):
    text = " ".join(f"Sentence number w{i} ends here." for i in range(700))
    own = pages(spark, [text])
    segments = chunking.semantic_segments(own).orderBy("segment_seq").collect()
    assert " ".join(r.text for r in segments) == text
    assert [text[r.char_start : r.char_end] for r in segments] == [r.text for r in segments]
    assert " ".join(r.text for r in chunking.semantic_segments(own, most=300).orderBy("segment_seq").collect()) == text[: text.index(" Sentence number w300 ")]
    held = {w for r in chunking.chunk_documents(own).collect() for w in r.text.split()}
    assert held == set(text.split())


def test_wh_quota_mmr_equals_brute_force(spark):
    r = random.Random(3)
    some = lambda n: " ".join(r.choice("valve pump inlet outlet seal rotor shaft gauge flow motor".split()) + str(r.randint(0, 60)) for _ in range(n))
    own = [(f"k{i:05d}", f"What {some(4)} ?", some(8)) for i in range(2300)] + [(f"w{i}", f"Why {some(3)} ?", some(5)) for i in range(3)]
    frame = spark.createDataFrame(own, "key string, question string, about string")
    shares = {"what": 0.01, "why": 0.5}
    got = synth.wh_quota_mmr(frame, targets=shares).collect()
    bag = lambda t: Counter(w for w in re.findall(r"\w{2,}", t.lower()) if w not in gold_rules.STOPWORDS)
    bags = [(bag(q), bag(a)) for _, q, a in own]
    df = Counter(w for both in bags for b in both for w in b)

    def unit(b):
        w = {t: c * (math.log((1 + 2 * len(own)) / (1 + df[t])) + 1) for t, c in b.items()}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / size for t, x in w.items()}

    dot = lambda a, b: sum(x * b.get(t, 0.0) for t, x in a.items())
    left = sorted((q, k, unit(b), dot(unit(b), unit(a))) for (k, q, _), (b, a) in zip(own, bags, strict=True) if k.startswith("k"))
    chosen = []
    for _ in range(math.ceil(len(own) * 0.01)):
        best = max(left, key=lambda x: (round(0.7 * x[3] - 0.3 * max([dot(x[2], c[2]) for c in chosen], default=0.0), 9)))
        chosen.append(best), left.remove(best)
    assert sorted(x.key for x in got if x.wh == "what") == sorted(c[1] for c in chosen)
    assert sorted(x.key for x in got if x.wh == "why") == ["w0", "w1", "w2"]


def test_tfidf_cosine_equals_brute_force(spark, tmp_path):
    r = random.Random(8)
    own = {i: " ".join(r.choice(["valve", "pump", "inlet", "outlet", "seal", "rotor", "the", "x"]) for _ in range(r.randint(1, 6))) for i in range(45)}
    spark.createDataFrame(list(own.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    bags = {i: Counter(w for w in t.split() if len(w) > 1 and w not in gold_rules.STOPWORDS) for i, t in own.items()}
    df = Counter(w for b in bags.values() for w in b)
    raw = {i: {w: c * (math.log((1 + len(own)) / (1 + df[w])) + 1) for w, c in b.items()} for i, b in bags.items()}
    unit = {i: {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()} for i, v in raw.items()}
    want = {(q, i): sum(x * unit[i].get(w, 0.0) for w, x in unit[q].items()) for q in (0, 20, 40) for i in own if unit[q].keys() & unit[i].keys()}
    got = {(x.query_id, x.doc_id): x.cosine for x in gold_queries.tfidf_cosine(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_mmr_prefers_new_words():
    texts = ["red fox jumps", "red fox jumps high", "green turtle swims"]
    assert gold_rules.mmr(texts, "red fox jumps green turtle", 2, 0.5) in ([0, 2], [1, 2], [2, 0])
    assert gold_rules.mmr(texts, "x", 3) == [0, 1, 2]


# model-made questions


@pytest.mark.parametrize("question, reason", [
    ("Which valve opens first?", None), ("What do I need to open?", "person"), ("Which valve should you open?", "person"), ("Who is someone in charge?", "vague_subject"),
    ("According to the text, which valve opens?", "meta_reference"), ("Is section I am first?", None), ("What does section I do?", None), ("Why? How?", "question_mark"), ("", "question_length"),
])
def test_item_rules(spark, question, reason):
    got = one(spark, synth.invalid_reason(F.col("q"), F.lit("which"), F.lit("multi hop"), F.lit("the inlet"), F.array(F.lit("The inlet opens first."))), q=question)
    assert got == reason


def test_evidence_places():
    text = "First sentence here.  Second  sentence\nruns on. Third one!"
    bounds = synth.sentence_spans(text)
    assert [text[a:b] for a, b in bounds] == ["First sentence here.", "Second  sentence", "runs on.", "Third one!"]
    assert [text[a:b] for a, b in synth.evidence_spans(["SECOND sentence runs on.", {"index": 3}, "first  Sentence here."], bounds, text)] == ["Second  sentence\nruns on.", "Third one!", "First sentence here."]
    assert synth.answer_span("one", text, [(0, 10)]) == (text.index("one"), text.index("one") + 3)
    assert synth.answer_span("none", text, []) == (-1, -1)


def test_find_span_falls_back():
    text = "Alpha beta  gamma. alpha BETA gamma"
    assert synth.find_span("Alpha beta", text)[2] == "exact"
    assert synth.find_span("ALPHA BETA", text)[2] == "case"
    assert synth.find_span("beta gamma.", text) == (6, 18, "blank")
    assert synth.find_span("beta gammax", "the betta gammax is", least=85)[2] == "fuzzy"
    assert synth.find_span("nothing alike", text) is None


def test_windows_keep_budgets():
    own = [(i, "x" * n) for i, n in enumerate([50, 50, 0, 300, 10, 10], 1)]
    got = synth.windows_of(own, max_pages=2, max_chars=120, max_tokens=1000)
    assert [(a, b) for a, b, _ in got] == [(1, 2), (4, 4), (5, 6)]


def test_calls_are_retried_and_cached(spark, tmp_path):
    waits, tries = [], iter([synth.RetryableError(), synth.RetryableError(), "ok"])

    def call():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert synth.with_retry(call, sleep=waits.append) == "ok" and waits == [1.0, 1.6]
    with pytest.raises(synth.RetryableError):
        synth.with_retry(lambda: (_ for _ in ()).throw(synth.RetryableError()), attempts=2, sleep=waits.append)
    prompts = spark.createDataFrame([("w1", "s", "p1"), ("w2", "s", "p2")], "window_id string, system string, prompt string")
    first = synth.complete(prompts.limit(1), lambda m, o: f"answer to {m[1]['content']}")
    writers.cache_store(first, str(tmp_path / "cache"))
    again = synth.complete(prompts, lambda m, o: "fresh", cached=readers.response_cache(spark, str(tmp_path / "cache")))
    assert sorted(r.response for r in again.collect()) == ["answer to p1", "fresh"]
    assert readers.response_cache(spark, str(tmp_path / "nothing")).count() == 0


def test_synthesis_with_judge(spark):
    own = pages(spark, ["Pumps move water to the tank. Valves close when the tank is full.", "Sensors report the level every minute."]).withColumn("doc_name", F.lit("Doc"))
    kept = synth.synthesize(own).where("reason is null").collect()
    assert kept and all(r.char_start >= 0 for r in kept)
    none = synth.synthesize(own, judge=lambda r: (False, ["no"])).where("reason is null").count()
    assert none == 0


# files, engine, streaming


def test_files_to_answers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Pumps move water to the tank.\fValves close when the tank is full.", encoding="utf-8")
    (tmp_path / "b.md").write_text("Sensors report the level every minute.", encoding="utf-8")
    engine = Engine(spark)
    own, chunks, report = engine.ingest([str(tmp_path / n) for n in ("a.txt", "b.md", "c.txt", "d.doc")])
    assert own.count() == 3 and sorted(report.first().skipped_docs) == ["c.txt: missing", "d.doc: missing"]
    first = engine.build_indexes(chunks)
    assert engine.build_indexes(chunks) is first
    for name in ("lexical", "semantic", "hybrid"):
        config = RetrievalConfig.of(engine=name, nonsense=1)
        got = engine.retrieve("when do valves close", config)
        assert "Valves" in got["final_chunks"][0].get("text", "") or "Valves" in got["rerank_candidates"][0]["text"]
        assert engine.retrieve("When do valves close ", config)["provenance"]["cache_hit"]
    assert engine.retrieve("  ")["final_chunks"] == []
    assert RetrievalConfig.of(engine="other").engine == "semantic"


def test_engine_without_embedder_is_lexical(spark):
    def broken(text):
        raise OSError("no model")

    engine = Engine(spark, [broken])
    engine.build_indexes(chunking.chunk_documents(pages(spark, ["Pumps move water to the tank and back again."])))
    assert engine.engine_for("hybrid")[0] == "lexical" and engine.indexes.notices


def test_evaluation_run(spark, tmp_path):
    engine = Engine(spark)
    engine.build_indexes(chunking.chunk_documents(pages(spark, ["Pumps move water to the big tank.", "Valves close when it is full."])))
    gold = spark.createDataFrame([("1", "pumps move water", 1, 1, None, None, ["x"]), ("2", "valves close", 2, 2, None, None, [])], "query_id string, query string, page_start int, page_end int, char_start int, char_end int, tags array<string>")
    out = engine.evaluate(gold, [RetrievalConfig(engine="lexical"), RetrievalConfig(engine="semantic")], str(tmp_path))
    assert {r.engine for r in out["aggregates"].collect()} == {"lexical", "semantic"}
    assert {r.tag for r in out["per_tag"].collect()} == {"x", "untagged"}
    assert readers.runs(spark, [f"{tmp_path}/*_run.json"]).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.runs(spark, [f"{tmp_path}/none*.json"])


def test_gold_files(spark, tmp_path):
    (tmp_path / "g.csv").write_text('id,question,doc_id,page_start,page_end,tags,char_start\n1,"Why, so?",d,2,3,a; b;,x\n', encoding="utf-8")
    r = readers.gold(spark, str(tmp_path / "g.csv")).first()
    assert (r.question, r.page_start, r.tags, r.char_start) == ("Why, so?", 2, ["a", "b"], None)
    (tmp_path / "g.jsonl").write_text('{"id": "1", "question": "Q?", "tags": ["t"]}\n\n', encoding="utf-8")
    assert readers.gold(spark, str(tmp_path / "g.jsonl")).first().tags == ["t"]
    with pytest.raises(ValueError):
        readers.gold(spark, "g.xml")


def test_broken_bytes_become_replacement_characters(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"ok \xff\xfe end\x0cnext")
    got = readers.text_pages(spark, str(tmp_path / "x.txt"), 5).orderBy("page_num").collect()
    assert [r.text for r in got] == ["ok \ufffd\ufffd end", "next"]


def test_pdf_adapter(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"one|two|three")
    got = readers.pdf_pages(spark, str(tmp_path / "x.pdf"), 2, lambda content, n: content.decode().split("|")[:n])
    assert sorted((r.page_num, r.text) for r in got.collect()) == [(1, "one"), (2, "two")]


def test_parsed_docs_and_exports(spark, tmp_path):
    own = P.with_offsets(pages(spark, ["one", "two"])).withColumn("doc_name", F.lit("Doc"))
    writers.gold_inputs(own, pages(spark, ["c"]), str(tmp_path))
    assert spark.read.json(str(tmp_path / "parsed_docs")).first().doc_name == "Doc"
    folder = tmp_path / "docs"
    folder.mkdir()
    (folder / "d.json").write_text('{"doc_id": "d", "pages": [{"page_num": 1, "text": "x"}, {"page_num": 2, "text": " "}]}', encoding="utf-8")
    assert [(r.doc_name, r.page_num) for r in readers.parsed_docs(spark, str(folder)).collect()] == [("d", 1)]
    assert readers.parsed_docs(spark, str(folder), drop_empty=False).count() == 2


def test_cache_forgets_the_oldest():
    c = Cache(2)
    for q in "abc":
        c.put(c.key(RetrievalConfig(), q), [q])
    assert c.get(c.key(RetrievalConfig(), "a")) is None and c.get(c.key(RetrievalConfig(), " C ")) == ["c"]
    assert c.key(RetrievalConfig(), "a") != c.key(RetrievalConfig(top_k=9), "a")


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one  two\fthree", encoding="utf-8")
    for _ in range(2):
        ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.page_num, r.text) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "one two"), (2, "three")]


def test_hooks(spark):
    register.register_tokenizer(spark, "n_tokens", str.split)
    register.register_embedder(spark, "embed_", chunking.hashed_embedding)
    register.register_reranker(spark, "score_", lambda q, t: float(q in t))
    got = spark.sql("select n_tokens('a b c') n, size(embed_('a b')) d, score_('a', 'cab') s").first()
    assert (got.n, got.d, got.s) == (3, 64, 1.0)


def test_files_of_one_name_and_broken_files(spark, tmp_path):
    for folder, text in (("a", "one\x0ctwo"), ("b", "three\x0cfour\x0cfive")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.txt").write_text(text, encoding="utf-8")
    (tmp_path / "good.pdf").write_bytes(b"six|seven")
    (tmp_path / "bad.pdf").write_bytes(b"broken")

    def extract(content, n):
        if b"|" not in content:
            raise ValueError("no pages here")
        return content.decode().split("|")[:n]

    paths = [str(tmp_path / p) for p in ("a/x.txt", "bad.pdf", "b/x.txt", "good.pdf", "none.txt", "y.doc")]
    (tmp_path / "y.doc").write_text("z", encoding="utf-8")
    found, report = readers.read_documents(spark, paths, 800, 4, extract)
    assert [(r.file_ord, r.text) for r in found.orderBy("file_ord", "page_num").collect()] == [(0, "one"), (0, "two"), (2, "three"), (2, "four")]
    assert report.first().skipped_docs == ["good.pdf", "none.txt: missing", "y.doc: unsupported", "bad.pdf: ValueError: no pages here"]


def test_layout_adapter(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"x")
    found, errors = readers.layout_pages(spark, str(tmp_path / "x.pdf"), 9, lambda content, n: [(None, "title"), (3, "c"), (1, "body")])
    assert [(r.page_num, r.text) for r in found.orderBy("page_num").collect()] == [(1, "title\nbody"), (2, ""), (3, "c")] and errors.count() == 0


def test_two_configurations_of_one_engine(spark, tmp_path):
    engine = Engine(spark)
    engine.build_indexes(chunking.chunk_documents(pages(spark, [f"Pump number {k} moves water to tank {k}." for k in range(12)])))
    gold = spark.createDataFrame([("1", "pump number 3", 4, 4, None, None, ["x"])], "query_id string, query string, page_start int, page_end int, char_start int, char_end int, tags array<string>")
    out = engine.evaluate(gold, [RetrievalConfig(engine="lexical", top_k=1), RetrievalConfig(engine="lexical", top_k=9), RetrievalConfig(engine="hybrid")], str(tmp_path))
    assert {r.engine for r in out["items"].collect()} == {"lexical-1", "lexical-2", "hybrid"}
    assert {"bm25", "rerank", "pack", "total"} <= {r.key for r in out["latency"].where("engine = 'lexical-1'").collect()}
    assert {"encode", "vectors", "bm25", "fusion"} <= {r.key for r in out["latency"].where("engine = 'hybrid'").collect()}
    assert (tmp_path / "report.html").read_text(encoding="utf-8").startswith("<!doctype html>")
    run = json.loads((tmp_path / "lexical-2_run.json").read_text(encoding="utf-8"))
    assert run["config"]["top_k"] == 9 and run["latency"]["total"]["p50"] > 0
    assert len(engine.ablation(gold, ["lexical"])["aggregates"].collect()) == 4
    assert engine.status().first().chunks == engine.chunk_view().count() == engine.debug_view("pump", RetrievalConfig(engine="lexical")).count()


def test_reranker_that_fails(spark):
    def broken(query, text):
        return F.raise_error(F.lit("no reranker"))

    engine = Engine(spark, scorer=broken)
    engine.build_indexes(spark.createDataFrame([(str(k), "d", k, k, f"Pump number {k} moves water.", 5) for k in range(9)], "chunk_id string, doc_id string, page_start int, page_end int, text string, token_len int"))
    out = engine.retrieve("pump number 3", RetrievalConfig(engine="hybrid", rerank_top_n=2))
    assert len(out["rerank_candidates"]) == 2 and all(r["rerank_score"] == 0 for r in out["rerank_candidates"])
    assert any("reranker failed" in n for n in out["provenance"]["notices"])
    assert out["provenance"]["fusion"]["both"] > 0 and len(out["provenance"]["fused_debug"]) == 5


def test_paraphrases_join_assembly_with_hard_negatives(spark):
    text = "PUMP SYSTEM\n\nThe pump is a device that moves water to the tank.\n\nsize: 40 gb | limit"
    own = spark.createDataFrame([("d", "Manual", 1, text), ("d", "Manual", 2, "The pump system and its device are cleaned. Water moves."), ("e", "Other", 1, "Nothing here at all.")], "doc_id string, doc_name string, page_num int, text string")
    cand = gold_rules.with_text(gold_rules.harvest(own), own)
    same, decided = gold_rules.paraphrase(cand)
    assert all("paraphrase" not in r.tags for r in same.collect()) and decided.count() == cand.count()
    other, all_ = gold_rules.paraphrase(cand, lambda q, formal: ["How does the pump system move water?", "How does the pump system move water? ", "It?"])
    rows = other.collect()
    assert [r.question for r in rows] == ["How does the pump system move water?"] and "paraphrase" in rows[0].tags
    stats = {(r.kind, r.name): r.n for r in gold_rules.paraphrase_stats(other, all_).collect()}
    assert stats["all", "total"] == 1 and stats["wh", "how"] == 1 and any(k == "rejected" for k, _ in stats)
    chunks = own.select(F.concat_ws(":", "doc_id", F.col("page_num").cast("string")).alias("chunk_id"), "doc_id", F.col("page_num").alias("page_start"), "text")
    gold = gold_rules.assemble(cand, total=50, paraphrases=other, chunks=chunks).collect()
    assert gold and all("d:1" not in r.hard_negative_ids for r in gold) and any("d:2" in r.hard_negative_ids for r in gold)


def test_cosine_shuffles_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BLOCK", 3)
    r = random.Random(6)
    texts = [" ".join(r.choices(["the", "red", "fox", "hen", "log", "sun", "sky"], k=r.randrange(9))) for _ in range(30)]
    own = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = gold_rules.packed_tfidf(own, "doc_id")
    out = gold_rules.cosine(made.where("doc_id % 4 = 0").withColumnRenamed("doc_id", "query_id"), made, "query_id", "doc_id")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    bags = [Counter(w for w in t.split() if w != "the") for t in texts]
    idf = {w: math.log(31 / (1 + sum(w in b for b in bags))) + 1 for b in bags for w in b}
    size = [math.sqrt(sum((c * idf[w]) ** 2 for w, c in b.items())) for b in bags]
    want = {(q, d): sum(c * bags[d][w] * idf[w] ** 2 for w, c in bags[q].items()) / size[q] / size[d] for q in range(0, 30, 4) for d in range(30) if set(bags[q]) & set(bags[d])}
    assert {(x.query_id, x.doc_id): x.cosine for x in out.collect()} == pytest.approx(want)


def test_questions_of_a_row_are_those_of_the_tables(spark):
    values = [{"heading": "Pump", "section": "Pump", "scope": "{term} of it", "doc_name": "Doc", "topic": "Tanks ", "term": "tanks"}, {"metric": "4 gb", "scope": "x", "unit_item": "Items", "topic": "t", "entity_type": "row"}]
    tags = [["definition", "whyhow", "other", "generic"], ["numeric", "table", "generic"]]
    rows = spark.createDataFrame([(f"k{i}", t, v) for i, (t, v) in enumerate(zip(tags, values, strict=True))], "id string, tags array<string>, slots map<string,string>")
    found = gold_rules.generate_questions(rows.select("id", F.explode("tags").alias("tag"), "slots"), "id", 2).collect()
    for i, (t, v) in enumerate(zip(tags, values, strict=True)):
        own = {}
        for q in sorted((r.tag, r.question) for r in found if r.id == f"k{i}"):
            own.setdefault(q[1].lower(), q)
        assert own and gold_rules.template_questions(f"k{i}", t, v, 2) == sorted(own.values())


def test_texts_are_met_once_and_late(spark, monkeypatch):
    """No table of candidates holds pages' texts, and results are those of candidates with texts."""
    written, write = [], gold_rules.written
    monkeypatch.setattr(gold_rules, "written", lambda rows, name: written.append((name, rows.columns)) or write(rows, name))
    line = "size: 40 gb | limit\nspeed: 7 ms | low\nThe pump is a device that moves water.\n   is it so\nFigure 1: Flow"
    own = spark.createDataFrame([("d", "Manual", k, f"PUMP SYSTEM {k}\n\n{line}") for k in range(3)], "doc_id string, doc_name string, page_num int, text string")
    with_text = gold_rules.with_text(gold_rules.harvest(own), own)
    columns = ["gold_id", "question", "page_num", "char_start"]
    want = [r for r in gold_rules.assemble(with_text, total=20).select(columns).orderBy("gold_id").collect()], sorted(gold_rules.paraphrase(with_text)[0].select("cand_id", "question", "wh").collect())
    written.clear()
    assert gold_rules.assemble(gold_rules.harvest(own), total=20, pages=own).select(columns).orderBy("gold_id").collect() == want[0]
    assert sorted(gold_rules.paraphrase(gold_rules.harvest(own), pages=own)[0].select("cand_id", "question", "wh").collect()) == want[1]
    assert gold_rules.extract(own).count() > 0
    assert {"candidates", "wordings", "expanded"} <= {n for n, _ in written} and all("text" not in c for _, c in written)


def test_choice_by_relevance_and_difference():
    r, stop = random.Random(7), set(gold_rules.STOPWORDS)
    for _ in range(30):
        texts = [" ".join(r.choices("red fox hen log sun sky the it".split(), k=r.randrange(1, 6))) for _ in range(7)]
        about = " ".join(r.choices("red fox hen log rain wind snow the".split(), k=r.randrange(12)))
        bags = [Counter(w for w in t.split() if w not in stop and len(w) > 1) for t in [*texts, about]]
        idf = {w: math.log(9 / (1 + sum(w in b for b in bags))) + 1 for b in bags for w in b}
        unit = [{w: c * idf[w] for w, c in b.items()} for b in bags]
        unit = [{w: x / math.sqrt(sum(y * y for y in u.values())) for w, x in u.items()} for u in unit]
        like = lambda a, b: sum(x * unit[b].get(w, 0) for w, x in unit[a].items())  # noqa: B023, E731
        want = []
        while len(want) < 4:
            value = [-9 if i in want else round(0.7 * like(i, 7) - 0.3 * max((like(i, j) for j in want), default=0), 12) for i in range(7)]
            want.append(value.index(max(value)))
        assert gold_rules.mmr(texts, about, 4) == want


def test_gold_is_made_once_for_all_configurations(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(q):
        made.add(1)
        return q

    def no_model(text):
        raise OSError("no model here")

    engine = Engine(spark, [no_model])
    engine.build_indexes(spark.createDataFrame([("c", "d", 1, 1, "red fox", 2)], "chunk_id string, doc_id string, page_start int, page_end int, text string, token_len int"))
    rows = spark.createDataFrame([("q", "red", 1, 1, None, None, ["t"])], "query_id string, query string, page_start int, page_end int, char_start int, char_end int, tags array<string>")
    out = engine.evaluate(rows.withColumn("query", seen("query")), [RetrievalConfig(engine="lexical"), RetrievalConfig(engine="lexical", top_k=3)])
    assert [r.pre_hit_at_k for r in out["aggregates"].collect()] == [1.0, 1.0] and made.value == 1


def test_hash_ranks_count_within_a_class(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 10 > 0, "hot").alias("c"))
    found = gold_rules.hash_ranks(rows, "c", F.sha1(F.col("id").cast("string"))).collect()
    for c in ("hot", None):
        own = sorted((r for r in found if r.c == c), key=lambda r: r._h)
        assert [r._k for r in own] == list(range(1, len(own) + 1)) and len(own) == (4500 if c else 500)
