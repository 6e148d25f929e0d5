from __future__ import annotations

from pathlib import Path

import pytest

from cellrecon.session import scratch_path, scratch_scope, written


def local(path):
    return Path(path.removeprefix("file:"))


def test_scratch_tables_go_with_their_scope(spark):
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_scope(spark):
        outer = scratch_path(spark, "outer")
        spark.range(3).write.parquet(outer)
        with scratch_scope(spark):
            inner = written(spark.range(5), "inner")
            assert inner.count() == 5
        assert not local(inner.inputFiles()[0]).exists() and local(outer).exists()
    assert not local(outer).exists() and local(kept).exists()
    with pytest.raises(RuntimeError), scratch_scope(spark):
        path = scratch_path(spark, "failed")
        spark.range(3).write.parquet(path)
        raise RuntimeError
    assert not local(path).exists()
