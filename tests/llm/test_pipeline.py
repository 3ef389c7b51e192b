"""The pipeline against a brute-force version of its stages."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from orderstream.llm import quality, queries
from orderstream.llm.common import read_table
from test_copies_and_leaks import brute_leaks
from test_near_dedup import brute_classes

SF001 = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup",
                                                      "benchmark decontamination", "BPE encoding and decoding"]
    assert "pipeline" in E.queries() and "pipeline" not in E.oracle_sql()


def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: r.text or "" for r in read_table(spark, SF001, "documents").collect()}
    accepted = {r.doc_id for r in queries.op1_quality(spark, SF001).collect() if r.score >= quality.ACCEPT}
    first = {}
    for i in sorted(accepted):
        first.setdefault(docs[i], i)
    kept = sorted(first.values())
    of = brute_classes([(i, docs[i]) for i in kept])
    kept = [i for i in kept if of[i] == i]
    items = [(r.item_id, r.text) for r in read_table(spark, SF001, "benchmark").collect()]
    kept = [i for i in kept if not brute_leaks(docs[i], items, 10)[1]]
    library = Tokenizer.from_file(public_tokenizers.path(queries.BPE_FILE))
    want = {i: hashlib.sha256(" ".join(map(str, library.encode(docs[i], add_special_tokens=False).ids)).encode()).hexdigest() for i in kept}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF001).collect()} == want


def test_stages_return_the_columns_of_documents(spark):
    docs = read_table(spark, SF001, "documents").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns


def test_stages_handle_odd_rows(spark):
    """Nulls, empty and repeated rows, ids that are missing or shared, columns with names that operators use."""
    text = read_table(spark, SF001, "documents").where("text IS NOT NULL").first().text
    rows = [(1, None), (2, ""), (3, ""), (4, text), (5, text), (5, text), (None, text), (6, text + " and one more word"), (None, None), (7, "x" * 200_000)]
    extra = [("number", 1), ("id", 2), ("key", 3), ("hash", 4), ("score", 5), ("f", 6)]
    docs = spark.createDataFrame([(*r, "en", "s", None, *[v for _, v in extra]) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c, _ in extra))
    for odd, left in ((docs, None), (docs.where("false"), 0)):
        out = odd
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF001)
            assert out.columns == docs.columns, name
            if name != "quality classifier" and left is None:
                ids = [r.doc_id for r in out.where(F.col("text") == text).collect()]
                assert ids == [] or ids == [4], name  # of all copies the smallest id
        last = corpus_pipeline.STAGES[-1][1](spark, out, SF001)
        assert last.count() == out.count() and (left is None or last.count() == left)


def test_labelled_documents_are_picked_where_they_are_read(spark):
    docs, labels = read_table(spark, SF001, "documents"), read_table(spark, SF001, "labels")
    want = {r.doc_id for r in labels.where("quality IS NOT NULL").collect() if zlib.crc32(str(r.doc_id).encode()) % 5} & {r.doc_id for r in docs.collect()}
    got = quality.labelled(docs.withColumn("Number", F.lit(1)), labels)
    assert {r.doc_id for r in got.collect()} == want and got.columns == [*docs.columns, "Number"]
    whole = quality.fit(quality.document_statistics(docs), labels)
    part = quality.fit(quality.document_statistics(got), labels)
    assert np.allclose(whole.beta, part.beta)
