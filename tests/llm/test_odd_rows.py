"""Defined results for nulls, empty, blank and very long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlemill.llm import decontaminate, extract, fertility, lm, mixing, neardup, passages, quality, token_files, toxicity
from candlemill.llm.labels import remainder
from candlemill.sources.staging import new_folder

from .conftest import odd_rows, sentence

LABELS = "doc_id long, quality int, toxic int"


def labels(spark, rows=((1, 1, 0), (2, 1, None), (4, 0, 1), (4, 1, 1), (None, 1, 1), (10, None, None), (99, 0, 0))):
    return spark.createDataFrame(list(rows), LABELS)


def ids(rows):
    return sorted((r[0] is not None, r[0] or 0) for r in rows)


ALL = sorted((r[0] is not None, r[0] or 0) for r in odd_rows())


@pytest.mark.parametrize("rows", [None, [], [(1, 1, 1)], [(1, 1, 0), (6, 0, 1), (9, 1, 0)]])
def test_classifiers(shipped_spark, odd_docs, no_docs, rows):
    marks = labels(shipped_spark) if rows is None else labels(shipped_spark, rows)
    fold = remainder(F.col("doc_id"), 5) >= 0
    model = quality.fit(odd_docs, marks, fold)
    scored = quality.classify(odd_docs, model).collect()
    assert ids([(r.doc_id,) for r in scored]) == ALL
    assert all(0 <= r.quality_score <= 1 for r in scored)
    kept = quality.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.quality_pass for r in scored)
    judge = toxicity.fit(odd_docs, marks, fold)
    scored = toxicity.score(odd_docs, judge).collect()
    assert ids([(r.doc_id,) for r in scored]) == ALL
    assert all(0 <= r.toxic_score <= 1 and r.toxic_sentence >= 0 for r in scored)
    assert quality.classify(no_docs, model).count() == toxicity.score(no_docs, judge).count() == 0
    assert quality.fit(no_docs, marks, fold).score() is not None and toxicity.fit(no_docs, marks, fold).bias == -30


def test_passages(odd_docs, no_docs):
    found = {(r.doc_id, r.first_word, r.n_words, r.partner_id) for r in passages.repeated_passages(odd_docs).collect()}
    assert found == {(1, 0, 60, 2), (2, 0, 60, 1)}
    assert passages.repeated_passages(no_docs).count() == 0


def test_decontamination(shipped_spark, odd_docs, no_docs):
    items = [(1, "Two one"), (2, "one, TWO!"), (3, None), (None, "one two"), (4, ""), (5, sentence(20_000, 3)), (2, "zz")]
    bench = shipped_spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(odd_docs, bench).collect()}
    assert found == {(7, 2, 0), (8, 2, 0), (6, 5, 0)}
    clean = decontaminate.decontaminate(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert ids(clean.collect()) == sorted(x for x in ALL if x[1] not in (6, 7, 8))
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(odd_docs, bench.where("false")).count() == 0
    assert decontaminate.decontaminate(odd_docs, bench.where("false")).count() == len(ALL)


def test_mixing(odd_docs, no_docs):
    rows = mixing.mix_sources(odd_docs).collect()
    assert ids(rows) == ALL
    by_source = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        total, target, size = by_source.get(r.source, (0, r.target, r.source_size))
        by_source[r.source] = (total + r.taken, target, size)
    assert all(abs(taken - target) <= 0.5 + 1e-6 for taken, target, _ in by_source.values())
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_sources(odd_docs).collect()), key=str)
    taken = mixing.apply_mix(odd_docs)
    assert taken.columns == odd_docs.columns
    words = {r[0]: r[1] for r in taken.groupBy("source").agg(F.sum(mixing.word_count(F.col("text")))).collect()}
    assert words == {s: t for s, (t, _, _) in by_source.items() if t}
    assert mixing.mix_sources(no_docs).count() == mixing.apply_mix(no_docs).count() == 0


def test_extraction(shipped_spark):
    long = "<p>" + "the cat and the dog of it " * 9000 + "</p>"
    pages = [(1, "u", None, "x"), (2, None, "", None), (None, "u", long, "y"), (4, "u", long, "y"), (4, "u", "<nav>a</nav>", "")]
    df = shipped_spark.createDataFrame(pages, "page_id long, url string, html string, main_text string")
    rows = extract.extract(df).collect()
    assert sorted(r.main_chars for r in rows) == [0, 0, 0, 9000 * 26 - 1, 9000 * 26 - 1]
    assert extract.extract(df.where("false")).columns == ["page_id", "url", "html", "main_text", "main_chars"]


def test_near_duplicates(odd_docs, no_docs):
    rows = [tuple(r) for r in neardup.near_duplicates(odd_docs).collect()]
    assert sorted(rows, key=str) == sorted(
        [
            (1, 56, 1, True),
            (2, 56, 1, False),
            (2, 56, 1, False),
            (3, 0, 3, True),
            (4, 0, 4, True),
            (5, 0, 5, True),
            (None, 66, None, True),
            (None, 0, None, True),
            (6, 19_996, 6, True),
            (7, 1, 7, True),
            (8, 1, 7, False),
            (9, 2, 9, True),  # six words
            (10, 1, 10, True),
        ],
        key=str,
    )
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert ids(kept.collect()) == sorted(x for x in ALL if x[1] not in (2, 8))
    assert neardup.near_duplicates(no_docs).count() == neardup.keep_one(no_docs).count() == 0


def test_repeated_ids_are_one_node(frame):
    a, b = sentence(30, 1), sentence(30, 2)
    docs = frame("doc_id long, text string", (5, a), (5, b), (3, a), (4, b), (5, ""), (9, "alone"))
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()}
    assert got == {(5, 3), (3, 3), (4, 3), (9, 9)}


def test_token_files(shipped_spark, odd_docs, no_docs):
    path = new_folder(shipped_spark, "tokens")
    token_files.write_tokens(odd_docs, path)
    rows = sorted(token_files.digest(shipped_spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in rows] == ALL
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    assert {r.doc_id: r.n_tokens for r in rows}[3] == {r.doc_id: r.n_tokens for r in rows}[5] == 1
    path = new_folder(shipped_spark, "tokens")
    token_files.write_tokens(no_docs, path)
    assert token_files.digest(shipped_spark, path).count() == 0


def test_lm_scores(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs, remainder(F.col("doc_id"), 5) == 1).collect()
    assert ids(rows) == ALL
    assert all(r.base_score - 0.302 < r.score < 0 and r.n_known <= r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert lm.score_documents(no_docs, F.lit(False)).count() == 0
    # Without anything to learn from every share is that of an unknown word.
    rows = lm.score_documents(odd_docs, F.lit(True)).collect()
    assert ids(rows) == ALL and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)


def test_fertility(odd_docs, no_docs):
    rows = fertility.fertility_rules(odd_docs).collect()
    assert ids([(r.doc_id,) for r in rows]) == ALL
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert by_id[3].base_failed and by_id[4].base_failed and by_id[7].base_failed and by_id[10].base_failed
    assert not by_id[1].base_failed and by_id[9].word_chars == 17
    assert not any(r.kept and r.base_failed for r in rows)
    assert fertility.fertility_rules(no_docs).count() == 0
    assert fertility.fertility_rules(odd_docs.drop("lang")).count() == len(ALL)


def test_pipeline_stages(shipped_spark, odd_docs, no_docs, tmp_path):
    """Stages keep the columns of documents, and take an empty table."""
    for name, rows in (("labels", labels(shipped_spark)), ("benchmark", shipped_spark.createDataFrame([(1, "one two")], "item_id long, text string"))):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(shipped_spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(shipped_spark, docs, str(tmp_path)).count() <= 3 * len(ALL) * bool(docs.count())
        assert corpus_pipeline.STAGES[-1][1](shipped_spark, docs, str(tmp_path)).count() == docs.count()
