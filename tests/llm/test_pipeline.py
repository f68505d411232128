"""The pipeline's stages, each against a brute-force version on its own input."""

import re
from collections import Counter

import numpy as np
import sentencepiece

import corpus_pipeline as P
from nimbria.llm import mixing, quality
from nimbria.llm.queries import oracle_sql, queries, tokenizer
from tests.compare import connect, same
from tests.llm.test_operators import brute_classes, brute_lines


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5 and P.ORACLE_SQL is None
    held = {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf).cache()
        held[name] = docs.collect(), out.collect()
        if name != names[-1]:
            assert out.columns == P.COLUMNS
        docs = out
    before, after = held["quality rules"]
    verdict = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(before, docs.sparkSession.read.parquet(f"{sf}/documents.parquet").schema)).collect()}
    assert {r.doc_id for r in after} == {d for d, k in verdict.items() if k}
    before, after = held["line dedup"]
    import hashlib

    want = {int(d): s for d, _, _, s in brute_lines([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = held["simhash near-dedup"]
    assert sorted(r.doc_id for r in after) == sorted(set(brute_classes(before)))
    before, after = held["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.plan(spark.createDataFrame(before, P.COLUMNS and docs.sparkSession.read.parquet(f"{sf}/documents.parquet").schema)).collect()}
    assert Counter(r.doc_id for r in after) == Counter(copies) - Counter()
    before, after = held["sentencepiece"]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in before}
    assert len(before) == len(after) and all(r.piece_ids == sp.encode(texts[r.doc_id]) and r.round_trip for r in after)


def test_sql(spark, sf):
    con = connect(sf)
    made = queries()
    for name, sql in oracle_sql().items():
        same(made[name](spark, sf), con, sql)


def test_queries_are_named():
    names = list(queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14)) and np.unique(names).size == 13


EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows(spark):
    fine = lambda k: " ".join(f"w{(k * 37 + i * (k + 7)) % 4001}" for i in range(70))
    line = "a line that is long enough to count"
    rows = [
        (0, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t", "en", "b", 3), (3, "short", "en", "a", 5), (None, fine(3), "en", None, 300), (None, fine(3), "en", None, 300),
        (4, fine(4), None, "a", None), (5, fine(5), "en", "a", 300), (5, fine(5), "en", "a", 300), (6, fine(6), "en", "a", 300), (7, fine(6) + " end", "en", "a", 304), (8, "word " * 40_000, "en", "a", 200_000),
        (9, " ".join(f"x{i}" for i in range(60_000)), "de", "b", 0), *[(20 + i, f"{fine(20 + i)}\n{line}", "en", "a", 0) for i in range(4)], (30, line, "en", "a", 0),
    ]
    return spark.createDataFrame(rows, EDGE_SCHEMA).selectExpr("*", "'clash' as n_words", "1 as kept", "2 as root", "3 as at", "'clash' as piece_ids", "4 as __row")


def test_stages_on_edge_rows(spark, sf):
    """Nulls, empty and very long texts, ties, repeats and clashing columns in every stage, and empty tables."""
    edge = edge_rows(spark)
    before = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in edge.collect()]
    shown = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    first = P.quality_rules(spark, edge, sf)
    assert first.columns == P.COLUMNS
    got = shown(first)
    assert got[None, before[4][1]] == 2 and got[5, before[7][1]] == 2 and {d for d, _ in got} >= {4, 6, 7, 9, 20} and not {d for d, _ in got} & {0, 1, 2, 3, 8, 30}
    second = P.line_dedup(spark, edge, sf)
    assert second.columns == P.COLUMNS
    want = {(d, s) for d, _, _, s in brute_lines([(d, t) for d, t, *_ in before])}
    import hashlib

    rows = second.collect()
    assert {(str(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows} == want and len(rows) == len(before)
    assert {r.n_chars for r in rows if r.doc_id == 21} == {len(next(r.text for r in rows if r.doc_id == 21))} and next(r.text for r in rows if r.doc_id == 0) is None
    third = P.near_dedup(spark, edge, sf)
    assert third.columns == P.COLUMNS
    near = Counter(r.doc_id for r in third.collect())
    assert near == Counter([None, 0, 3, 4, 5, 6, 8, 9, 20, 21, 22, 23, 30])  # 1 and 2 are like 0, 7 like 6; 5 and the null id repeat
    fourth = P.mix(spark, edge, sf)
    assert fourth.columns == P.COLUMNS and max(Counter(r.doc_id for r in fourth.where("doc_id not in (5)").collect()).values()) <= 6
    copies = Counter()
    for r in mixing.plan(edge.select(P.COLUMNS)).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in fourth.collect()) == +copies
    last = P.sentencepiece(spark, edge, sf)
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    assert sorted((str(r.doc_id), r.n_pieces, r.round_trip) for r in last.collect()) == sorted((str(d), len(sp.encode(t or "")), True) for d, t, *_ in before)
    for _, stage in P.STAGES:
        assert stage(spark, edge.where("doc_id > 1000"), sf).count() == 0
