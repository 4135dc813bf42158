"""Written files are bounded and no task holds a whole table."""

import glob

from cohortgraph import catalogue


def test_arrays_are_bounded_by_blocks_of_ids(spark, tmp_path, monkeypatch):
    path, sf = str(tmp_path / "arrays"), "/root/testdata/sf0.001"
    monkeypatch.setattr(catalogue, "IDS_PER_ARRAY", 50)
    catalogue._write_arrays(spark, sf, path)
    counts = []
    for name in glob.glob(f"{path}/*/part-*"):
        with open(name) as file:
            counts.append(file.read().count('"followers_count"'))
    assert sum(counts) == sum(spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("customer", "supplier"))
    assert max(counts) <= 100 and len(counts) > 25
