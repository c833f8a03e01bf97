"""The stages one after another, each against what its operator says of its own input."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillvault.llm import decontaminate as dc
from quillvault.llm.pii import base_spans
from quillvault.llm.quality import quality_scores
from quillvault.llm.simhash import near_copies


@pytest.fixture(scope="module")
def results(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(corpus_pipeline.staged(stage(spark, found[-1], sf_dir), name))
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "simhash", "decontamination", "personal_data", "bpe_encoding",
    ]
    for df in results[1:-1]:
        assert df.schema == results[0].schema
    assert all(a.count() >= b.count() for a, b in zip(results, results[1:], strict=False))


def test_quality_keeps_what_scores_enough(spark, sf_dir, results):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality_scores(results[0], labels).collect()
    assert ids(results[1]) == sorted(r.doc_id for r in scores if r.score >= 0.3)


def test_simhash_keeps_one_of_each_group(results):
    groups = near_copies(results[1]).collect()
    assert ids(results[2]) == sorted({r.component_id for r in groups})


def test_no_benchmark_passage_is_left(spark, sf_dir, results):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bench = dc.Benchmark([(i, t) for i, t in items])
    held = {r.doc_id for r in results[2].collect() if bench.matches(r.text)}
    assert held and ids(results[3]) == sorted(set(ids(results[2])) - held)


def test_personal_data_is_masked_and_nothing_else_changes(results):
    before = {r.doc_id: r.text for r in results[3].collect()}
    masked = 0
    for r in results[4].collect():
        spans = base_spans(before[r.doc_id])
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if spans:
            masked += 1
        else:
            assert r.text == before[r.doc_id]
    assert masked and len(before) == results[4].count()


def test_tokens_are_the_librarys(results):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in results[4].collect()}
    rows = results[5].collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids) == (len(want), " ".join(map(str, want)))
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame(
        [], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
