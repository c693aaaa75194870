"""Near duplicates give back what each of their queries has shuffled when it ends."""

import gc
import time

from starloom.llm import near_duplicates


def _shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in blocks.split("\n") if "/shuffle_" in x}


def test_shuffles_go_before_the_result_is_read(spark):
    texts = [" ".join(f"w{k % 9}x{i}" for i in range(30)) + (f" end{k}" if k % 2 else "") for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before = _shuffled(spark)
    result = near_duplicates.deduplicated(docs)
    for _ in range(50):
        # A query that stops after its first rows keeps what it shuffled.
        if len(left := _shuffled(spark) - before) <= 12:
            break
        time.sleep(0.1)
    assert len(left) <= 12
    assert result.count() == len(result.collect()) == len(result.collect()) == 9
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
