"""Archive source (S1, S2, F5, P1-P3) and file sinks."""

import gzip
import json
import os

from pyspark.sql import functions as F

from grist.sources import files, warc


def record(wtype, block, url=None):
    head = [b"WARC/1.0", f"WARC-Type: {wtype}".encode()]
    if url:
        head.append(f"WARC-Target-URI: {url}".encode())
    head.append(f"Content-Length: {len(block)}".encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def http(status, body, charset=None):
    ct = b"Content-Type: text/html" + (f"; charset={charset}".encode() if charset else b"")
    return f"HTTP/1.1 {status} X\r\n".encode() + ct + b"\r\n\r\n" + body


def write_archive(path):
    members = [
        record("warcinfo", b"software: test"),
        record("response", http(200, b"<html><body><p>Hello <b>world</b></p></body></html>"),
               "http://a.example/1"),
        record("response", http(404, b"<p>gone</p>"), "http://a.example/2"),
        record("response", http(200, "<p>café</p>".encode("latin-1"), "iso-8859-1"),
               "http://a.example/3"),
        record("conversion", b"plain text \xff body", "http://a.example/4"),
    ]
    with open(path, "wb") as fh:
        for m in members:
            fh.write(gzip.compress(m))  # one gzip member per record


def test_archive_source(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one.warc.gz")
    write_archive(path)
    recs = warc.read_archives(spark, tmp_dir)
    assert recs.count() == 5
    resp = {r["url"]: r["text"] for r in warc.extract_responses(recs).collect()}
    assert resp == {"http://a.example/1": "Hello world", "http://a.example/3": "café"}
    conv = warc.extract_conversions(recs).collect()
    assert conv[0]["text"] == "plain text � body"
    first = warc.first_records(recs, 2).collect()
    assert [r["rec"] for r in first] == [0, 1]


def test_jsonl_round_trip_keeps_null_url(spark, tmp_dir):
    df = spark.createDataFrame([("a", None), ("b", "http://x")], "text string, url string")
    out = os.path.join(tmp_dir, "jsonl")
    files.write_jsonl(df, out)
    lines = []
    for name in sorted(os.listdir(out)):
        if name.endswith(".json"):
            with open(os.path.join(out, name), encoding="utf-8") as fh:
                lines += [json.loads(x) for x in fh if x.strip()]
    assert {"text": "a", "url": None} in lines
    back = files.read_jsonl(spark, out)
    assert back.count() == 2 and back.select("doc_id").distinct().count() == 2


def test_url_list_and_names(spark, tmp_dir):
    p = os.path.join(tmp_dir, "urls.txt")
    with open(p, "w") as fh:
        fh.write("u1\nu2\n")
    assert [r["url"] for r in files.read_url_list(spark, p).collect()] == ["u1", "u2"]
    df = spark.createDataFrame([("/d/x.warc.wet.gz",)], "f string")
    assert df.select(files.output_name(F.col("f"))).first()[0] == "x.warc.wet.jsonl"


def test_identical_json_records_have_ids_of_their_own(spark, tmp_dir):
    from grist.operators import exact, minhash

    text = "the river runs past the old mill and the bridge " * 4
    p = os.path.join(tmp_dir, "d.jsonl")
    with open(p, "w") as fh:
        for t in (text, text, "another text about the stars and the sea " * 4):
            fh.write(json.dumps({"text": t, "url": "u"}) + "\n")
    df = files.read_jsonl(spark, p)
    assert df.select("doc_id").distinct().count() == 3
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, files.read_jsonl(spark, p).collect()))
    assert minhash.fuzzy_dedup(df).kept.count() == 2
    assert exact.exact_doc_dedup_rows(df, keep="first").count() == 2


def test_fuzzy_dedup_of_files_by_their_names(spark, tmp_dir):
    from grist.operators import minhash

    text = "the river runs past the old mill and the bridge " * 10
    for name, t in (("a.txt", text), ("b.txt", text + "end"), ("c.txt", "another text about the stars and the sea " * 9)):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(t)
    for verify in (False, True):
        kept = minhash.fuzzy_dedup(files.read_whole_files(spark, tmp_dir), minhash.MinHashParams(20, 10, 2), verify=verify, id_col="file").kept
        assert sorted(r["file"].rsplit("/", 1)[1] for r in kept.collect()) == ["a.txt", "c.txt"]


def test_archive_options_skip_records_and_uris_are_paths(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one.warc.gz")
    write_archive(path)
    assert len(list(warc.parse_archive("file://" + path, frozenset(["response"]), frozenset([200])))) == 2
    assert {r[-1] for r in warc.parse_archive(path, body=False)} == {None}
    assert warc.ArchiveReader({"path": "file://" + tmp_dir + "/*.gz"}).files == ["file://" + path]
    records = warc.read_archives(spark, "file://" + tmp_dir, types="response,conversion", statuses="200", body="false")
    assert [r["body"] for r in records.collect()] == [None, None]
    every = warc.read_archives(spark, "file://" + tmp_dir)
    assert every.filter("warc_type = 'response' and status = 200").count() == 2 and every.count() == 5


def test_archives_to_json_lines(spark, tmp_dir):
    from grist.plans import curate as X

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    heads = X.train_heads(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = docs.orderBy("doc_id").collect()
    os.mkdir(os.path.join(tmp_dir, "in"))
    for k in range(2):
        with open(os.path.join(tmp_dir, "in", f"{k}.warc.wet.gz"), "wb") as fh:
            fh.write(gzip.compress(record("warcinfo", b"x", "http://info")))
            for r in rows[k::2]:
                fh.write(gzip.compress(record("conversion", r["text"].encode(), f"http://d/{r['doc_id']}")))
    out, stats = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "stats")
    X.curate_archives(spark, os.path.join(tmp_dir, "in"), heads, out, stats)
    by_file = {r["file"].rsplit("/", 1)[1]: r["n"] for r in spark.read.parquet(stats).groupBy("file").agg(F.sum("n").alias("n")).collect()}
    assert by_file == {"0.warc.wet.gz": 100, "1.warc.wet.gz": 100}
    expected = sorted((f"http://d/{r['doc_id']}", r["text"]) for r in X.kept(X.funnel(docs, heads)).collect())
    assert sorted((r["url"], r["text"]) for r in files.read_jsonl(spark, out).collect()) == expected
    X.curate_archives(spark, os.path.join(tmp_dir, "in"), heads, out, stats, params=X.minhash.MinHashParams(10, 2, 2))
    assert 0 < files.read_jsonl(spark, out).count() <= len(expected)
