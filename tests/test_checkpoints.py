"""The checkpoint folder: set once, and dropped intermediates go."""

import gc
import os
import time

from gazetta.operators.keys import materialize
from gazetta.session import checkpoint_dir


def stored(folder):
    return [d for d, _, files in os.walk(folder) if any(f.startswith("part-") for f in files)]


def test_folder_is_set_once(spark):
    checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_dropped_intermediates_are_gone(spark):
    checkpoint_dir(spark)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(stored(folder))
    frames = [materialize(spark.range(1000 + i)) for i in range(5)]
    mine = set(stored(folder)) - before
    assert len(mine) == 5 and sum(f.count() for f in frames) == 5010
    del frames
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.25)
        if not mine & set(stored(folder)):
            break
    assert not mine & set(stored(folder))
