"""The stages of the pipeline against brute force, each on what the one before it kept; the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import mixing
from tessera.llm.queries import ORACLES, QUERIES

from test_documents_ops import SCHEMA, WORD, brute_classes, brute_targets, corpus, counts

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows = corpus(200, seed=3)
    leak = "a benchmark question of a dozen words that is found nowhere else in here"
    rows = [(i, f"{t} {leak}" if i is not None and t and i % 13 == 1 else t, a, b, n) for i, t, a, b, n in rows]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, leak


def test_stages_against_brute_force(spark, folder, tmp_path):
    d, rows, leak = folder
    docs, at = spark.read.parquet(f"{d}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(str(tmp_path / str(i)))
        docs = at[name] = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == spark.read.parquet(f"{d}/documents.parquet").columns
    ids = {n: sorted(str(r["doc_id"]) for r in x.collect()) for n, x in at.items()}
    kept = [r for r in rows if (c := counts(r[1]))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    assert ids["quality_rules"] == sorted(str(r[0]) for r in kept)
    heads = set(brute_classes(kept).values())
    one = {r[0]: r for r in kept if r[0] in heads}
    stays = [*one.values(), *(r for r in kept if r[0] is None)]
    assert ids["near_dedup"] == sorted(str(r[0]) for r in stays)
    clean = [r for r in stays if leak not in r[1]]
    assert 0 < len(clean) < len(stays) and ids["decontamination"] == sorted(str(r[0]) for r in clean)
    size = {r[0]: len(WORD.findall(r[1])) for r in clean}
    total = Counter()
    for r in clean:
        total[r[3]] += size[r[0]]
    want, got = brute_targets(total), Counter()
    times = Counter(r["doc_id"] for r in at["mix_sources"].collect())
    for r in clean:
        got[r[3]] += times[r[0]] * size[r[0]]
    assert max(times.values()) <= 2 and all(abs(got[s] - want[s]) <= max(size[r[0]] for r in clean if r[3] == s) for s in want)
    last = at["shard"].collect()
    assert sorted(str(r["doc_id"]) for r in last) == ids["mix_sources"]
    for s in {r["shard"] for r in last}:
        own = [r["slot"] for r in last if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))
    assert sorted(map(str, corpus_pipeline.run(spark, d).collect())) == sorted(map(str, last))


def test_registered_queries_run(spark):
    found = entry.queries()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)} and set(ORACLES) <= set(QUERIES)
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name in QUERIES:
        rows = found[name](spark, DATA).count()
        if name.split("_")[0] in ("op1", "op4", "op5", "op6", "op7", "op9", "op10"):
            assert rows == n
    assert found["pipeline"](spark, DATA).count() > 0
    assert mixing.WEIGHTS == (3, 1, 2)


def test_stages_on_empty_tables_and_clashing_columns(spark, tmp_path):
    d = str(tmp_path / "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
    clashes = ["h1", "_likely", "class_id", "n_words", "kept", "item_id", "_key", "shard", "node", "slot"]
    rows = [(i, f"{i} " + " ".join(f"w{(i * 7 + j) % 997}x{i}" for j in range(60)), "en", f"s{i % 2}", 0) for i in range(12)] + [(None, None, None, None, None), (99, "", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"own {c}") for c in clashes})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, d)
        assert got.columns == docs.columns and all(r[c] == f"own {c}" for r in got.collect() for c in clashes), name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert last.count() == len(rows) and len(last.columns) == len(set(last.columns))
