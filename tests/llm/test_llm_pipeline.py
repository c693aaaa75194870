"""The pipeline on small tables with odd rows."""

import random

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, sample string"


def tables(spark, folder, docs, labels=(), items=()):
    rows = [(k, t, "en", f"s{i}", len(t or ""), "x", "y") for i, (k, t) in enumerate(docs)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def prose(r, n=60):
    return " ".join(r.choice(["the", "cat", "dog", "sat", "ran", "home", "tree", "blue"]) + str(r.randrange(50)) for _ in range(n))


def kept(spark, folder):
    out = corpus_pipeline.run(spark, folder).where("sample = 0").collect()
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_pieces"] == 0) for r in out)


def test_odd_rows(spark, tmp_path):
    r = random.Random(1)
    a, b, c = prose(r), prose(r), prose(r)
    docs = [(1, None), (2, ""), (3, a), (3, a), (4, a), (5, b), (5, c), (None, b), (None, None), (6, b + " end"), (7, "x " + " ".join(f"q{k}" for k in range(12)))]
    folder = tables(spark, tmp_path, docs, items=[(1, " ".join(f"q{k}" for k in range(12))), (2, None)])
    assert kept(spark, folder) == [(False, 1, True), (False, 2, True), (False, 3, False), (False, 5, False), (False, 5, False), (True, 0, False), (True, 0, True)]


def test_stages_keep_the_columns(spark, tmp_path):
    r = random.Random(2)
    folder = tables(spark, tmp_path, [(k, prose(r)) for k in range(12)], labels=[(k, 1, 0) for k in range(10)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_no_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0
