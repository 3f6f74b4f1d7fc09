import os

import pytest

from lapsewise.session import (
    checkpoint_dir,
    local_path,
    materialize,
    release_scratch,
    run_concurrently,
    scratch_path,
)


def test_run_concurrently_keeps_order_and_raises(spark):
    out = run_concurrently(lambda: spark.range(3).count(), lambda: spark.range(5).count())
    assert out == [3, 5]
    with pytest.raises(ZeroDivisionError):
        run_concurrently(lambda: 1, lambda: 1 / 0)


def test_scratch_lives_under_checkpoint_dir_and_is_released(spark):
    base = checkpoint_dir(spark)
    p = scratch_path(spark, "t")
    assert p.startswith(base.rstrip("/") + "/lapsewise-work/")
    df = materialize(spark.range(10), "ten")
    assert df.count() == 10
    work = local_path(base.rstrip("/") + "/lapsewise-work")
    assert os.path.isdir(work)
    release_scratch(spark)
    assert not os.path.exists(work)
    assert os.path.isdir(local_path(base))  # the checkpoint folder itself stays


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert checkpoint_dir(spark).replace("file:", "").startswith(configured.replace("file:", ""))
