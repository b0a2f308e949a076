"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from small_tables import SF_DIR, empty, nasty  # noqa: F401

from helioframe.llm import vector_packing
from helioframe.llm.quality_rules import assess


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stage(step(spark, out[-1], SF_DIR), name))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_and_order(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "packing"]
    for df in outputs[1:-1]:
        assert df.schema.names == outputs[0].schema.names and df.dtypes == outputs[0].dtypes


def test_quality(outputs):
    keep = {r.row.doc_id for r in assess(outputs[0]).where("kept").select("row").collect()}
    assert texts(outputs[1]) == {i: t for i, t in texts(outputs[0]).items() if i in keep} and keep


def test_near_dedup(outputs):
    before = texts(outputs[1])
    found = brute.components(list(before.items()), 5, 80)
    assert texts(outputs[2]) == {i: t for i, t in before.items() if found[i] == i}


def test_substring_dedup(outputs):
    after = texts(outputs[3])
    lengths = {r.doc_id: r.n_chars for r in outputs[3].collect()}
    for i, raw, flags in brute.removed(list(texts(outputs[2]).items())):
        kept, at = b"", 0
        while at < len(raw):
            end = at + 1
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1
            if not all(flags[at:end]):
                kept += raw[at:end]
            at = end
        assert after[i].encode() == kept
        assert lengths[i] == len(after[i])


def test_decontamination(spark, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    keep = {}
    for i, t in texts(outputs[3]).items():
        words, hit, _ = brute.hits(t, items)
        if not (hit and 20 * hit >= words):
            keep[i] = t
    assert texts(outputs[4]) == keep


def test_packing(outputs):
    encode = vector_packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rows = outputs[5].orderBy("doc_id", "start").collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert got == {i: [*encode([t or ""])[0], 0] for i, t in texts(outputs[4]).items()}


def test_stages_take_nasty_rows(spark, nasty, empty):
    for df in (nasty, empty):
        docs = df.drop("n_words", "kept").withColumnRenamed("n", "n_chars")
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, SF_DIR))
        assert docs.count() >= 0


def test_run(spark, outputs):
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(tuple, outputs[5].select("doc_id", "start", "ids_crc32").collect())
    ) or whole.select("doc_id").distinct().count() == outputs[5].select("doc_id").distinct().count()
