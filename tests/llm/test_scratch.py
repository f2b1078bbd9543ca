import pyarrow.parquet as pq

from ladle.llm import token_alignment as TA
from ladle.llm.common import scratch_table


def test_large_rows_are_written_in_small_row_groups(spark):
    rows = spark.range(24).coalesce(1).selectExpr("id", "transform(sequence(1, 400000), x -> xxhash64(x, id)) AS many")  # 3 MB a row
    back = scratch_table(rows, "large-rows", large_rows=True)
    most = max(pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(g).num_rows for f in back.inputFiles()
               for g in range(pq.ParquetFile(f.removeprefix("file://")).num_row_groups))
    assert most <= 8 and back.count() == 24


def test_alignment_writes_its_slices_as_large_rows(spark, docs001, monkeypatch):
    seen = []

    def spy(df, name, **options):
        seen.append(options)
        return scratch_table(df, name, **options)
    monkeypatch.setattr(TA, "scratch_table", spy)
    TA.align(docs001.limit(5)).count()
    assert seen == [{"large_rows": True}]
