"""Tables that are folders of files give streams what single files give."""

import os

import pytest

import __spark_entry__ as entry
from checks import registry
from tests.oracle_compare import as_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    for name in ["benchmark", "documents", "events", "orders"]:
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(3).write.parquet(f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", ["documents", "events"])
def test_stream_reads_files_and_folders(spark, folders, name):
    for folder in (FOLDER, folders + "/"):
        tables = registry.Tables(spark, folder)
        seen = []
        stream = tables.stream(name).writeStream.foreachBatch(lambda batch, _: seen.append(batch.count()))
        stream.trigger(availableNow=True).start().awaitTermination()
        assert sum(seen) == tables(name).count() > 0


@pytest.mark.parametrize("name", ["q_stream_filter", "q_stream_terms", "q_stream_percolate"])
def test_stream_queries_over_folders(spark, folders, name):
    one, many = (entry.queries()[name](spark, folder) for folder in (FOLDER, folders))
    assert as_rows(one.columns, one.collect()) == as_rows(many.columns, many.collect()) != []
