"""What a batch of the deduplicating stream writes."""

import os

from docroute.llm import exact_dedup


def test_a_commit_of_state_is_one_file(spark, tmp_path):
    located = "named_struct('file', 'f', 'row', id)"
    rows = spark.range(40).selectExpr("id AS doc_id", f"{located} AS locator", "CAST(id % 30 AS string) AS digest")
    rows.write.parquet(f"{tmp_path}/digests")
    groups = exact_dedup.stream_groups(spark, f"{tmp_path}/digests", str(tmp_path))
    assert sorted((r.digest, r.n) for r in groups.filter("n > 1").collect()) == sorted((str(i), 2) for i in range(10))
    names = [n for _, _, files in os.walk(f"{tmp_path}/checkpoint/state") for n in files if not n.startswith(".")]
    assert "1.changelog" in names
    assert not [n for n in names if n.endswith(".crc")]
