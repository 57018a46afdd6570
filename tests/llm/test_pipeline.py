"""The pipeline on odd rows and an empty table, stage by stage and as a whole, against what each stage promises."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from platterwatch.llm import bpe, catalog, decontaminate, lines, quality, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def written(spark, tmp_path):
    """A folder of tables with the given documents."""

    def make(docs):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        for name in ("labels", "benchmark"):
            catalog.table(spark, SF, name).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


def digest(text):
    ranks = bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = library.encode_ordinary(text)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_pipeline_of_odd_rows(spark, written, odd_documents):
    """Odd rows among those of a test table. Each stage gets what the one before it kept, and the last row set
    is that of the stages' own operators one after the other."""
    docs = catalog.table(spark, SF, "documents").unionByName(odd_documents.select(*COLUMNS))
    folder = written(docs)
    found = corpus_pipeline.run(spark, folder).collect()
    read = spark.read.parquet(f"{folder}/documents.parquet")
    model = catalog.quality_model(read, catalog.table(spark, folder, "labels"))
    good = {(r["doc_id"], r["text"]) for r in quality.good_documents(read, model).collect()}
    scores = quality.scored(read, model, "doc_id", "text").collect()
    assert good == {(r["doc_id"], r["text"]) for r in scores if r["score"] >= quality.THRESHOLD}
    cleaned = lines.without_boilerplate(quality.good_documents(read, model))
    single = simhash.one_of_each(cleaned)
    left = decontaminate.clean(spark, single, catalog.table(spark, folder, "benchmark")).collect()
    want = sorted((str(r["doc_id"]), *digest(r["text"] or "")) for r in left)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"]) for r in found) == want
    assert 20 < len(found) < read.count()


def test_stages_keep_the_columns(spark, written, odd_documents):
    folder = written(odd_documents.select(*COLUMNS))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder)
        assert out.columns == COLUMNS and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect() if r["doc_id"] not in (None, 2))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "byte-level bpe",
    ]


def test_pipeline_of_an_empty_table(spark, written, empty_documents):
    folder = written(empty_documents.select(*COLUMNS))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_the_row_that_stays_does_not_depend_on_the_partitions(spark):
    rows = [(1, "the same words here", f"lang{k}", f"s{k}", 19) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    seen = {tuple(r) for n in (1, 3, 7) for r in simhash.one_of_each(docs.repartition(n)).collect()}
    assert len(seen) == 1
