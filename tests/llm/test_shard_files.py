"""Written shards: whole documents, in slot order, pruned by any dimension."""

import pytest

from ledgerlens.llm import sharding


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shards") / "documents")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, path, sharding.write_shards(docs, path)


def test_shards_hold_all_documents(spark, written):
    docs, path, bounds = written
    whole = spark.read.parquet(path)
    assert listed(whole.select(*docs.columns)) == listed(docs)
    expected = {(r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(docs).collect()}
    assert {(r.doc_id, r.shard, r.slot) for r in whole.collect()} == expected
    assert bounds.count() == 24 and sum(r.rows for r in bounds.collect()) == docs.count()


@pytest.mark.parametrize("name", ["size", "source", "lang"])
def test_a_range_of_one_dimension_reads_fewer_files(spark, written, name):
    docs, path, _ = written
    value = {"size": "octet_length(text) + 8"}.get(name, name)
    rows = docs.selectExpr(f"{value} AS v").where("v IS NOT NULL").orderBy("v").collect()
    low, high = rows[0].v, rows[len(rows) // 20].v
    pruned = sharding.read_shards(spark, path, **{name: (low, high)})
    wanted = f"{value} BETWEEN {low!r} AND {high!r}"
    assert listed(pruned.where(wanted).select("doc_id")) == listed(docs.where(wanted).select("doc_id"))
    # The executed scan lists the files of the remaining shards only.
    scan = pruned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.selectedPartitions().totalNumberOfFiles() < len(spark.read.parquet(path).inputFiles())


def test_edges(spark, edge, nothing, tmp_path):
    sharding.write_shards(edge, str(tmp_path / "edge"))
    assert listed(spark.read.parquet(str(tmp_path / "edge")).select(*edge.columns)) == listed(edge)
    assert sharding.write_shards(nothing, str(tmp_path / "nothing")).count() == 0
