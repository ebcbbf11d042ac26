"""Split archives, archive streams and the committed sink."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from grist.sources import files, warc
from test_sources import http, record


def members(n, seed=0):
    r = random.Random(seed)
    out = [record("warcinfo", b"software: test")]
    for i in range(n):
        body = bytes(r.randrange(256) for _ in range(r.randrange(0, 900))) + b"\x1f\x8b\x08" + b"WARC/1.0\r\n"
        out.append(record("response", http(200, body), f"http://a.example/{i}"))
    return out


def write(path, records, per_member=1):
    with open(path, "wb") as fh:
        for i in range(0, len(records), per_member):
            fh.write(gzip.compress(b"".join(records[i:i + per_member])))


def rows(df):
    return sorted((r.file, r.rec, r.warc_type, r.url, r.status, bytes(r.body)) for r in df.collect())


def test_three_members_are_read_by_three_tasks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "three.warc.gz")
    write(path, members(2))
    sizes = [len(gzip.compress(m)) for m in members(2)]
    index = os.path.join(tmp_dir, "index")
    warc.write_index(spark, path, index, split_bytes=max(sizes))
    parts = warc._read_index(index)[path]
    assert len(parts) >= 2 and sum(r.records for r in spark.read.parquet(index).collect()) == 3
    warc.write_index(spark, path, index, split_bytes=min(sizes))
    assert len(warc._read_index(index)[path]) == 3
    df = warc.read_archives(spark, path, index=index)
    assert df.rdd.getNumPartitions() == 3
    assert rows(df) == rows(warc.read_archives(spark, path))


@pytest.mark.parametrize("per_member,split", [(1, 500), (1, 64), (3, 1000), (7, 333), (1, 10 ** 9)])
def test_ranges_give_the_rows_of_the_sequential_parser(spark, tmp_dir, per_member, split):
    for k in range(2):
        write(os.path.join(tmp_dir, f"{k}.warc.gz"), members(30, seed=k), per_member)
    with open(os.path.join(tmp_dir, "plain.warc"), "wb") as fh:
        fh.write(b"".join(members(3)))
    index = os.path.join(tmp_dir, "index")
    warc.write_index(spark, f"{tmp_dir}/*.warc*", index, split_bytes=split)
    whole = warc.read_archives(spark, f"{tmp_dir}/*.warc*")
    assert rows(warc.read_archives(spark, f"{tmp_dir}/*.warc*", index=index)) == rows(whole)
    typed = warc.read_archives(spark, f"{tmp_dir}/*.warc*", index=index, types="warcinfo")
    assert sorted((r.file[-6:], r.rec) for r in typed.collect()) == sorted((r.file[-6:], 0) for r in typed.collect()) and typed.count() == 3


def test_cut_archive_is_an_error_and_empty_ones_have_no_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cut.warc.gz")
    write(path, members(3))
    with open(path, "rb+") as fh:
        fh.truncate(os.path.getsize(path) - 5)
    with pytest.raises(Exception, match="gzip member"):
        list(warc.parse_archive(path, part=(0, 1 << 40, 0)))
    empty = os.path.join(tmp_dir, "empty.warc.gz")
    open(empty, "wb").close()
    assert warc.index_archives(spark, empty).count() == 0


def test_stream_takes_each_archive_once_over_restarts(spark, tmp_dir):
    src, out, log, mark = (os.path.join(tmp_dir, x) for x in ("src", "out", "log", "mark"))
    os.mkdir(src)

    def run():
        stream = warc.stream_archives(spark, f"{src}/*.warc.gz", log, maxFilesPerTrigger=1)
        q = (stream.withColumn("name", F.element_at(F.split("file", "/"), -1)).select("name", "rec", "url").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.name, r.rec) for r in spark.read.parquet(out).collect())

    def expected(*names):
        return sorted((f"{n}.warc.gz", i) for n in names for i in range(5))

    write(os.path.join(src, "b.warc.gz"), members(4))
    assert run() == expected("b")
    # a batch whose offset was logged but never run is planned again, with the same files
    write(os.path.join(src, "a.warc.gz"), members(4, seed=1))
    reader = warc.ArchiveStreamReader({"path": f"{src}/*.warc.gz", "log": log})
    assert reader.latestOffset() == {"batch": 2} == reader.latestOffset()
    write(os.path.join(src, "c.warc.gz"), members(4, seed=2))
    run()
    assert run() == expected("a", "b", "c")
    assert [p.path[-9:] for p in reader.partitions({"batch": 1}, {"batch": 2})] == ["a.warc.gz"]


def lines(folder):
    return {n: [json.loads(x) for x in open(os.path.join(folder, n), encoding="utf-8")] for n in sorted(os.listdir(folder)) if n.endswith(".jsonl")}


def test_committed_sink(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    os.mkdir(out)
    schema = "file string, rec int, text string, url string"
    first = spark.createDataFrame([("/x/a.warc.gz", i, f"t{i}é", None) for i in range(50)] + [("/x/b.warc.gz", 0, "b", "u")], schema)
    files.write_jsonl_per_file(first.repartition(5), out)
    assert [x["text"] for x in lines(out)["a.warc.jsonl"]] == [f"t{i}é" for i in range(50)]
    assert lines(out)["b.warc.jsonl"] == [{"text": "b", "url": "u"}]
    # other inputs come beside them, a rerun replaces its own
    files.write_jsonl_per_file(spark.createDataFrame([("/x/c.warc.gz", 0, "c", None), ("/x/b.warc.gz", 0, "new", None)], schema), out)
    assert {n: len(v) for n, v in lines(out).items()} == {"a.warc.jsonl": 50, "b.warc.jsonl": 1, "c.warc.jsonl": 1}
    assert lines(out)["b.warc.jsonl"][0]["text"] == "new"


def test_failed_tasks_leave_nothing(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    os.mkdir(out)
    schema = "file string, rec int, text string, url string"
    df = spark.createDataFrame([(f"/x/{k}.gz", i, f"{k}", None) for k in "abcd" for i in range(20)], schema)
    bad = df.withColumn("text", F.when((F.col("file") == "/x/c.gz") & (F.col("rec") == 19), F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        files.write_jsonl_per_file(bad, out)
    assert lines(out) == {}
    with pytest.raises(Exception, match="one name"):          # two folders with files of one name
        files.write_jsonl_per_file(df.withColumn("file", F.concat(F.lit("/"), F.col("rec") % 2, F.lit("/a.gz"))), out)
    assert lines(out) == {} and not [n for n in os.listdir(os.path.join(out, "_temporary")) if n]
    files.write_jsonl_per_file(df, out)
    assert len(lines(out)) == 4
