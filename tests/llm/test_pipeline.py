from __future__ import annotations

import hashlib
import re

import sentencepiece

import corpus_pipeline
from lexmill.llm import toxicity
from lexmill.llm.queries import vocabulary

from .test_operators import brute_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    """Every stage keeps a subset in full rows, and what it drops has a reason that brute force sees."""
    docs = corpus_pipeline.table(spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        after = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        rows = {r.doc_id: r for r in after.collect()}
        assert after.columns == docs.columns and len(rows) == after.count() and all(rows[i] == before[i] for i in rows)
        kept.append((name, before, rows))
        docs = after
    _, before, rows = kept[1]
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, r in before.items():
        groups.setdefault(norm(r.text), []).append((-len(r.text or ""), i))
    assert set(rows) == {min(g)[1] for g in groups.values()}
    _, before, rows = kept[3]
    items = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    holds = {i for i, r in before.items() if any(f" {x} " in f" {' '.join(re.findall(r'[^\W_]+', r.text.lower()))} " for x in items)}
    assert holds == set(before) - set(rows)
    _, before, rows = kept[0]
    scored = toxicity.report(corpus_pipeline.table(spark, SF, "documents"), corpus_pipeline.table(spark, SF, "labels"))
    assert set(rows) == {r.doc_id for r in scored.collect() if r.score < 0.3}
    _, before, rows = kept[2]
    assert set(rows) == set(brute_components({i: slow_fingerprint(r.text) for i, r in before.items()}).values())
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    before = {r.doc_id: r.text for r in docs.collect()}
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    assert set(last) == set(before)
    for i, text in before.items():
        ids = sp.encode(text or "", add_eos=True)
        assert list(last[i].ids) == ids and last[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_hard_rows_and_empty_tables(spark, hard, none, tmp_path):
    """All stages on nulls, blanks, repeats, a long text and clashing names; and on tables without rows."""
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 1, 0), (6, 0, 0), (7, 1, 0), (8, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog by the river bank"), (None, None)], "item_id long, text string")
    for name, docs in (("hard", hard), ("none", none)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        (labels if name == "hard" else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        (items if name == "hard" else items.limit(0)).write.parquet(f"{folder}/benchmark.parquet")
        found = sorted((r.doc_id or -1) for r in corpus_pipeline.run(spark, folder).collect())
        # blank texts are one group, of which the one with the most characters stays; 1 and 2 hold the passage
        assert found == ([-1, 5, 6, 7, 8, 9] if name == "hard" else [])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[:2] == ["doc_id", "n_tokens"]
