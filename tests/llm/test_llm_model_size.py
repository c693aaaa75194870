"""The language model moves its grams once for each order's contexts and once for their tails, and leaves no files."""

import os

from conftest import plan_of

from starloom.llm import language_model
from starloom.session import shared_dir


def test_discounts_move_no_grams(spark):
    rows = spark.createDataFrame([("en", k * 4097 % (1 << 24), 1 + k % 4) for k in range(500)], "lang string, gram long, c long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(language_model.model(rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The highest order's contexts, its tails, and the order below.
    assert plan.count("Exchange hashpartitioning") <= 3


def test_counts_of_several_tasks_add_up(spark):
    once = [("0en", 1, 5), ("1en", 1, 3), ("1en", 2, 0), ("0de", 1, 5), ("1de", 2, 0)]
    parts = [("0en", 1, 2), ("0en", 1, 3), ("0en", 1, 0), ("1en", 1, 3), ("1en", 2, 0), ("1en", 2, 0), ("0de", 1, 5), ("1de", 2, 0)]
    one, two = (
        sorted(map(tuple, language_model.held_out(spark.createDataFrame(x, "lang string, gram long, c long")).collect())) for x in (once, parts)
    )
    assert one == two and ("0en", 1, 3) in one and ("1en", 1, 5) in one


def test_nothing_is_left_in_the_shared_folder(spark):
    folder = shared_dir(spark).removeprefix("file:")
    kept = lambda: {x for x in os.listdir(folder) if x.startswith("kept-")}
    before = kept()
    docs = spark.createDataFrame([(k, "one two three " * (1 + k % 3), "en") for k in range(30)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    for rows in (10**6, 0):
        judged = language_model.judge(docs, labels, table_rows=rows)
        assert kept() == before
        assert judged.count() == 30 and {r["perplexity"] is None for r in judged.collect()} == {False}
