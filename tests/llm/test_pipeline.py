"""The pipeline stage by stage against brute force, and on awkward and empty tables."""

from collections import Counter

import public_tokenizers as tokenizers

import corpus_pipeline as pipeline
from winnow.llm.storage import written
from winnow.llm.vocabulary import encoding_of

from llm_cases import SF
from test_exact_dedup import LOWER
from test_ngram_join import brute


def test_stages(spark, documents):
    docs, kept = documents, []
    for _, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "stage")
        kept.append(docs)
    language, exact, near, mix, tokens = kept
    assert all(df.columns == documents.columns for df in kept[:-1])
    texts = {r.doc_id: r.text for r in documents.collect()}
    lettered = {i for i, t in texts.items() if any(map(str.isalpha, t or ""))}
    first = {r.doc_id for r in language.select("doc_id").collect()}
    assert first == lettered  # no clean document goes
    last = {}
    for i in first:
        k = texts[i].translate(LOWER)
        last[k] = max(last.get(k, i), i)
    second = {r.doc_id for r in exact.select("doc_id").collect()}
    assert second == set(last.values())
    third = {r.doc_id for r in near.select("doc_id").collect()}
    assert third == {c for _, _, c in brute([(i, texts[i]) for i in second], 5, 4, 5)}
    fourth = Counter(r.doc_id for r in mix.select("doc_id").collect())
    assert set(fourth) <= third and set(fourth.values()) == {1}
    size = lambda ids: sum((len((texts[i] or "").encode()) + 3) // 4 for i in ids)
    assert 0.8 * size(third) < size(fourth) <= 0.9 * size(third)
    encode = encoding_of(tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN).encode_ordinary
    assert {r.doc_id: r.n_tokens for r in tokens.collect()} == {i: len(encode(texts[i])) for i in fourth}


def test_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for _, stage in pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == awkward.columns
        assert pipeline.STAGES[-1][1](spark, docs, SF).count() <= awkward.count()


def test_stages_with_whole_texts_take_them_in_small_batches(spark, awkward):
    import pyarrow as pa

    import corpus_pipeline
    from winnow.llm import language

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = pa.schema([("n", pa.int64())])

    def sized(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], schema=sizes)

    def largest():
        return spark.range(3000, numPartitions=1).mapInArrow(sized, "n long").agg({"n": "max"}).first()[0]

    try:
        for stage in (corpus_pipeline.language_id, corpus_pipeline.byte_bpe):
            spark.conf.set(key, "10000")
            stage(spark, awkward, "")
            assert largest() <= corpus_pipeline.BATCH_ROWS
        spark.conf.set(key, "100")
        corpus_pipeline.byte_bpe(spark, awkward, "")
        assert largest() == 100
    finally:
        spark.conf.set(key, before)
    assert language.SLICE <= 500_000


def test_bitmap_of_nodes_marks_each_of_them(spark):
    import numpy as np

    from winnow.llm import ngram_join

    nodes = [0, 1, 63, 64, -1, -(1 << 63), (1 << 63) - 1, 5 * ngram_join.FILTER_BITS + 17]
    bitmap = ngram_join._node_filter(spark.createDataFrame([(n,) for n in nodes], "node long"))
    assert ngram_join._marked(bitmap, np.array(nodes)).all() and bitmap.nbytes * 8 == ngram_join.FILTER_BITS
    others = np.array([2, 62, 65, 18, 1 << 20])
    assert not ngram_join._marked(bitmap, others).any()
