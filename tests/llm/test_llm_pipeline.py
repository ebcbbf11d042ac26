"""The pipeline against plain versions of its stages, and the entry's guard."""

import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_mixing import plain_targets
from test_llm_simhash import plain_groups, plain_print
from test_llm_substring import plain
from tokenizers import Tokenizer

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(stages):
    assert [d.columns for d in stages[:5]] == [stages[0].columns] * 5
    assert {"doc_id", "n_tokens", "ids"} <= set(stages[5].columns)


def test_quality_keeps_clean_documents_whole(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].join(labels, "doc_id", "left")
    good = labels.filter("quality = 1")
    assert kept.filter("quality = 1").count() >= 0.98 * good.count()
    assert kept.filter("quality = 0").count() <= 0.1 * labels.filter("quality = 0").count()
    assert stages[1].exceptAll(stages[0]).count() == 0


def test_one_document_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    prints = {i: plain_print(t) for i, t in before.items()}
    group = plain_groups(set(prints.values()))
    first = {}
    for i in sorted(prints):
        first.setdefault(group[prints[i]], i)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(first.values())
    assert stages[2].exceptAll(stages[1]).count() == 0


def test_repeated_passages_go(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    expected = {i: (removed, kept) for i, _, removed, kept in plain(rows, 50)}
    for r in stages[3].collect():
        removed, kept = expected[r.doc_id]
        assert r.text == (kept if removed else dict(rows)[r.doc_id]) and r.n_chars == len(r.text)
    assert stages[3].count() == len(rows)


def test_mix_meets_the_targets(stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))      # noqa: E731
    before, sizes, taken, own = Counter(), defaultdict(int), defaultdict(int), defaultdict(list)
    for r in stages[3].collect():
        before[r.doc_id] += 1
        sizes[r.source] += size(r.text)
        own[r.source].append(size(r.text))
    after = Counter()
    for r in stages[4].collect():
        after[r.doc_id] += 1
        taken[r.source] += size(r.text)
    assert set(after) <= set(before) and max(after.values()) <= 3
    for s, t in plain_targets(sizes).items():
        # few documents: the nearest sum that whole documents can give
        reach = {0}
        for x in own[s]:
            reach |= {x + y for y in reach}
        rest = round(t) % sizes[s]
        assert abs(taken[s] - t) <= min(abs(x - rest) for x in reach) + 1
    assert stages[4].dropDuplicates().exceptAll(stages[3]).count() == 0


def test_ids_are_the_librarys(stages):
    library = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[4].collect())
    for r in rows:
        own = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == own and r.n_tokens == len(own) and r.exact


def test_run_is_the_stages(spark, stages):
    key = lambda df: Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in df.collect())      # noqa: E731
    assert key(P.run(spark, SF)) == key(stages[5])


@pytest.mark.parametrize("k", range(5))
def test_defined_cases(spark, k):
    name, stage = P.STAGES[k]
    text = "the cat sat on the mat and the dog lay on the rug by the fire in the old house of the town " * 5
    rows = [(1, text, "en", "a", len(text)), (1, text, "en", "a", len(text)), (2, None, None, None, None), (3, "", "en", "a", 0), (None, text + "x", "en", None, 1), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "p", 2, "q") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, perplexity string, kept int, _key string")
    out = stage(spark, docs, SF)
    if k < 4:
        assert out.columns == docs.columns
        got = [(r.doc_id, r.perplexity, r.kept, r._key) for r in out.collect()]
        assert {x[1:] for x in got} <= {("p", 2, "q")}
        ids = Counter(x[0] for x in got)
        assert ids == [Counter({1: 2, None: 1}), Counter({1: 1, 2: 1}) if (plain_print(text) ^ plain_print(text + "x")).bit_count() <= 3 else Counter({1: 1, 2: 1, None: 1}),
                       Counter({1: 2, 2: 1, 3: 1, None: 2}), ids][k]
        if k == 3:
            assert set(ids) <= {1, None} and ids
    else:
        assert Counter(r.n_tokens > 0 for r in out.collect()) == Counter({True: 3, False: 3})
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_registered_queries():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", n).group() for n in names if n.startswith("op")} and "pipeline" in names
    assert {"op3_exact_top_k", "op5_license_scan", "op7_substring_dedup"} <= set(E.oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op3_exact_top_k", "op5_license_scan", "op7_substring_dedup"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    import __spark_entry__ as E

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(res.fetchall())
