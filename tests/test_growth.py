"""What must not grow with the input: a key's calls to the state store, a ledger's folders, the rows of one file."""

import pathlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from orderstream.llm import near_dedup, pii
from orderstream.operators.windows import with_event_watermark
from orderstream.plans import catalog
from orderstream.schema import TOPIC_RECORD
from orderstream.sources import once
from orderstream.sources.once import OnceTable
from orderstream.streaming import window_function


def test_windows_take_no_calls_by_key(spark, tmp_dir, monkeypatch):
    """Lists collect in Spark's aggregate; the function still sees each of many windows once, with all its rows."""
    monkeypatch.setattr(window_function, "WINDOWS", 7)
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    schema = "k string, n int, event_time timestamp, v double, at timestamp"
    rows = spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 50).alias("k"), F.when(F.col("id") % 50 % 2 == 0, 1).cast("int").alias("n"),
                                   F.timestamp_seconds(F.col("id") % 3 * 60).alias("event_time"), F.col("id").cast("double").alias("v"),
                                   F.timestamp_seconds("id").alias("at"))
    rows.write.parquet(src)

    def sums(key, start, end, rows):
        assert list(rows.columns) == ["v", "at"] and rows["at"].dt.tz is None and (end - start).total_seconds() == 60
        return pd.DataFrame([(key[0], key[1], start, rows["v"].sum(), rows["at"].max())], columns=["k", "n", "start", "total", "last"])

    stream = with_event_watermark(spark.readStream.schema(schema).parquet(src))
    made = window_function.window_apply(stream, ["k", "n"], ["v", "at"], sums, "k string, n int, start timestamp, total double, last timestamp")
    assert "TransformWithState" not in made._jdf.queryExecution().logical().toString()
    q = made.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_dir}/ck").start()
    try:
        q.processAllAvailable()
        for s in (9000, 9001):
            spark.range(1).select(F.lit("end").alias("k"), F.lit(0).alias("n"), F.timestamp_seconds(F.lit(s)).alias("event_time"), F.lit(0.0).alias("v"),
                                  F.timestamp_seconds(F.lit(s)).alias("at")).write.mode("append").parquet(src)
            q.processAllAvailable()
    finally:
        q.stop()
    want = rows.groupBy("k", "n", F.col("event_time").alias("start")).agg(F.sum("v").alias("total"), F.max("at").alias("last"))
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, want.collect())) and want.count() == 150


def test_a_ledger_has_bounded_folders(spark, tmp_dir):
    def batch(low, high):
        return spark.range(low, high).select(*[(F.col("id") if f.name == "offset" else F.lit(None)).cast(f.dataType).alias(f.name) for f in TOPIC_RECORD.fields]).withColumns(
            {"topic": F.lit("t"), "partition": (F.col("offset") % 12).cast("int")})

    t = OnceTable(f"{tmp_dir}/t", TOPIC_RECORD, offset_range=10, run="a")
    t.write_batch(batch(-35, 20_000), 0)
    folders = list(pathlib.Path(f"{tmp_dir}/t/ledger").rglob("last_range=*"))
    assert 1 < len(folders) <= once.FOLDERS  # and not one for each of 2,004 ranges
    assert len(list(pathlib.Path(f"{tmp_dir}/t/ledger").rglob("*.parquet"))) <= once.FOLDERS + 8
    t.write_batch(batch(19_990, 20_005), 1)
    t.write_batch(batch(-40, -30), 2)
    t.write_batch(batch(9_995, 10_005), 3)
    t.write_batch(batch(20_003, 20_010), 4)
    assert [r["rows"] for r in t.commits(spark).orderBy("batch_id").collect()] == [20_035, 5, 5, 0, 5]
    assert t.read(spark).select("offset").distinct().count() == t.read(spark).count() == 20_050


def test_a_lot_has_files_of_bounded_size(spark, tmp_dir, monkeypatch):
    """A large lot is several files, which one batch takes together; no task reads the whole table alone."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 100)
    records = spark.range(0, 2000, 1, 3).select(F.col("id").alias("offset"))
    files = catalog._parts_by_offset(records, f"{tmp_dir}/in")
    sizes = spark.read.parquet(f"{tmp_dir}/in").groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.expr("offset div 50 % 4")).alias("lots")).collect()
    assert files == 5 and len(sizes) == 20 and all(90 <= r["n"] <= 110 and r["lots"] == 1 for r in sizes)
    seen = []
    q = (spark.readStream.schema("offset long").option("maxFilesPerTrigger", str(files)).parquet(f"{tmp_dir}/in").writeStream
         .foreachBatch(lambda df, i: seen.append(sorted({r[0] for r in df.selectExpr("offset div 50 % 4").collect()})))
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert seen == [[0], [1], [2], [3]]
    assert catalog._parts_by_offset(records.limit(0), f"{tmp_dir}/none") == 1


def test_personal_data_is_learnt_from_every_text(spark, monkeypatch):
    """Beyond 4,000 texts of a kind too: all their candidates train, calibrate or set thresholds, and the trees are those of all rows."""
    docs = spark.range(0, 4400, 1, 4).select(F.col("id").alias("doc_id"), F.concat(F.lit("mail ann"), "id", F.lit("@host.example.com, lot "), F.col("id") * 7919 % 10**7, F.lit(" at noon")).alias("text"))
    seen, boost_rows = {}, pii.boost_rows

    def watch(rows, mean, **kw):
        seen["rows"] = rows.collect()
        monkeypatch.setattr(pii, "TREES", 3)
        return seen.setdefault("trees", boost_rows(rows, mean, trees=3))

    monkeypatch.setattr(pii, "boost_rows", watch)
    monkeypatch.setattr(pii, "REFRESH", 2)
    model = pii.fit(docs)
    assert sum(r.y for r in seen["rows"]) > 0.7 * 4400  # three fourths of all positives train
    x, y = np.array([r.x for r in seen["rows"]], np.float64), np.array([r.y for r in seen["rows"]])
    here = pii.Trees(seen["trees"].edges)
    b = here.binned(x)
    pii._grow(here, y.mean(), lambda split, width: pii._sums(b, y, here.add(b, np.full(len(b), here.start)), split, width), 3, pii.DEPTH, pii.RATE, 1.0)
    assert np.allclose(here.margin(x), model.trees.margin(x)) and model.thresholds[0] <= 1


def test_words_are_hashed_in_bounded_parts(monkeypatch):
    """The texts that one call hashes have a bound well under a batch, and the parts don't change the result."""
    texts = [b" ".join(b"w%d" % (i * j % 997) for j in range(9000)) for i in range(1, 61)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], names=["id", "text"])
    sizes, shingles = [], near_dedup.shingles
    monkeypatch.setattr(near_dedup, "shingles", lambda column, k: sizes.append(sum(map(len, column.to_pylist()))) or shingles(column, k))
    small = pa.Table.from_batches(near_dedup._sign([batch], 5))
    assert max(sizes) <= 512 << 10 and len(sizes) > 4
    monkeypatch.setattr(near_dedup, "TEXT_BYTES", 1 << 30)
    assert small.combine_chunks() == pa.Table.from_batches(near_dedup._sign([batch], 5)).combine_chunks()
