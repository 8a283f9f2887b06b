"""The pipeline and its stages."""

import corpus_pipeline
import pytest
from tokenizers import Tokenizer

from fundloom.llm.catalog import WORD_BPE
from fundloom.session import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir, documents):
    found, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        found[name] = docs
    return found


def test_stages_hand_on_documents(stages, documents):
    names = list(stages)
    assert names == ["language", "near_duplicates", "secrets", "mixture", "tokens"]
    for name in names[:-1]:
        assert stages[name].columns == documents.columns
    counts = [stages[n].count() for n in names]
    assert documents.count() >= counts[0] > counts[1] == counts[2] == counts[3] == counts[4]


def test_last_stage_encodes_what_is_left(stages):
    library = Tokenizer.from_file(WORD_BPE)
    texts = {r.doc_id: r.text for r in stages["mixture"].collect()}
    for r in stages["tokens"].collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert not any("token = " in t for t in texts.values())


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == {r.doc_id: r.n_tokens for r in stages["tokens"].collect()}


def test_stages_on_odd_and_empty_tables(spark, sf_dir, edges, clashing, empty):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
        stage(spark, clashing, sf_dir).write.format("noop").mode("overwrite").save()
    docs = edges
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    assert {r.doc_id for r in docs.collect()} >= {1, 8, 9}


def test_rows_of_run_follow_the_mixture(spark, monkeypatch, tmp_path):
    """Over a table of several files: by position, each source is less than one block away from its share."""
    sizes, shares = {"a": 6400, "b": 1600}, {"a": 2 / 3, "b": 1 / 3}  # by the square roots of the sizes
    rows = [(1 + i * 2 + (s == "b"), f"text {i}", "en", s, 6) for s, n in sizes.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(7).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    got = corpus_pipeline.run(spark, str(tmp_path)).select("source", "block", "slot", "position").toPandas()
    got = got.sort_values("position")
    assert got.position.tolist() == list(range(len(rows))) and got.slot.is_monotonic_increasing
    assert (got.groupby("slot").source.nunique() == 1).all()
    for slots in range(1, 75):  # until b ends
        done = got[got.slot < slots].groupby("source").block.nunique()
        for source, share in shares.items():
            assert abs(done.get(source, 0) - share * slots) < 1 + slots * 0.001  # shares are whole thousandths
