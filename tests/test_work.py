import os

import pytest
from pyspark.sql import functions as F

from inkmill.operators import work
from inkmill.operators.graph import connected_components
from inkmill.sources import files, sinks
from inkmill import schemas


def folders(spark):
    at = work.shared_folder(spark)
    return set(os.listdir(at)) if os.path.isdir(at) else set()


def test_scoped_tables_go_when_nothing_reads_them(spark):
    work.release()
    before = folders(spark)

    @work.scoped
    def inner(spark):
        work.materialise(spark.range(3), "unused")
        return work.materialise(spark.range(4), "used").where("id > 0")

    @work.scoped
    def outer(spark):
        return work.materialise(inner(spark), "copy").withColumn("x", F.lit(1))

    @work.scoped
    def fails(spark):
        work.materialise(spark.range(3), "lost", buckets=2, by="id")
        raise ValueError

    out = outer(spark)
    assert out.count() == 3 and len(folders(spark) - before) == 1
    with pytest.raises(ValueError):
        fails(spark)
    assert len(folders(spark) - before) == 1 and not [t for t in spark.catalog.listTables() if t.name.startswith("inkmill_lost")]
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 8), (None, 1), (4, 4)], "a long, b long")
    assert {tuple(r) for r in connected_components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    work.release()
    assert folders(spark) == before


def test_bucketed_tables_are_kept_for_results_that_read_them(spark):
    @work.scoped
    def f(spark):
        return work.materialise(spark.range(10), "b", buckets=2, by="id")

    assert f(spark).groupBy("id").count().count() == 10
    work.release()


@pytest.mark.parametrize("limit", [0, 100])
@pytest.mark.parametrize("keep", [True, False])
def test_rows_in(spark, limit, keep):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    keys = spark.createDataFrame([(1,), (None,), (9,)], "k long")
    got = {r.v for r in work.rows_in(df, keys, ["k"], keep, limit).collect()}
    assert got == ({"a", "b"} if keep else {"c", "d"})


def test_a_manifest_outlives_a_stopped_writer(spark, tmp_path):
    path = str(tmp_path / "m")
    row = ("book", 1, "data/p.png", "abc", 400, 10, 10, False, "rtl", 0.5)
    sinks.write_manifest(spark, path, spark.createDataFrame([row], schemas.MANIFEST))
    os.rename(path, path + ".next")
    assert files.read_manifest(spark, path).count() == 1
    sinks.write_manifest(spark, path, spark.createDataFrame([("book", 2, *row[2:])], schemas.MANIFEST))
    assert sorted(r.page_number for r in files.read_manifest(spark, path).collect()) == [1, 2]
    assert sorted(os.listdir(tmp_path)) == ["m"]


def test_results_below_a_scratch_folder_keep_it(spark):
    @work.scoped
    def read_back():
        for folder in (first, second):
            folder.append(work.scratch_folder(spark, "below"))
            spark.range(3).write.parquet(f"{folder[0]}/deep/table")
        return spark.read.parquet(f"{first[0]}/deep/table")

    first, second = [], []
    assert read_back().count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{second[0]}/deep/table")


def test_batches_of_a_written_table_are_bounded_in_bytes(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    key, texts = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(6000, numPartitions=1).select(F.expr("repeat('x', 3000)").alias("text"))
    before = spark.conf.get(key)
    found = work.materialise(texts.mapInArrow(sizes, "rows long, bytes long")).collect()
    assert sum(r.rows for r in found) == 6000 and max(r.bytes for r in found) <= work.BATCH_BYTES + 100_000
    assert spark.conf.get(key) == before
    work.release()


@pytest.mark.parametrize("buckets", [None, 2])
def test_row_groups_of_a_written_table_are_bounded(spark, buckets):
    import pyarrow.parquet as pq

    rows = spark.range(12000, numPartitions=1).select("id", F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(k)), 512) for k in range(8)]).alias("text"))
    table = work.materialise(rows, buckets=buckets, by="id")
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in table.inputFiles()]
    stored = [sum(m.row_group(k).column(c).total_compressed_size for c in range(m.num_columns)) for m in groups for k in range(m.num_row_groups)]
    assert sum(m.num_rows for m in groups) == 12000 and sum(stored) > 3 * work.ROW_GROUP_BYTES
    assert max(stored) <= 1.5 * work.ROW_GROUP_BYTES
    work.release()
