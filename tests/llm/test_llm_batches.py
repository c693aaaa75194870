"""What tasks hold at a time follows neither the number of rows in a batch nor the length of a slice."""

import tracemalloc

import numpy as np
import pyarrow as pa

from starloom.llm import language_model, near_duplicates, segmentations
from starloom.llm.common import BATCH, span_hashes, words

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _largest(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect())


def test_batches_are_bounded_by_bytes(spark):
    text = " ".join(f"word{i}" for i in range(600))
    docs = spark.createDataFrame([(k, "en", f"{text} {k}") for k in range(3_000)], "doc_id long, lang string, text string").coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    steps = [
        lambda: near_duplicates.signatures(docs, 5),
        lambda: language_model.accepted(docs, labels),
        lambda: segmentations.encode(docs),
    ]
    assert spark.conf.get(BYTES, None) is None or int(spark.conf.get(BYTES)) == BATCH
    for step in steps:
        spark.conf.unset(BYTES)
        step()
        assert _largest(docs) < 1.1 * BATCH
    spark.conf.set(BYTES, "1000000")
    try:
        near_duplicates.signatures(docs, 5)
        assert spark.conf.get(BYTES) == "1000000"
    finally:
        spark.conf.unset(BYTES)


def test_hashes_are_worked_out_in_blocks():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"abcdefgh ", np.uint8), 4 << 20)
    data[1 << 20 : 1 << 21] = ord("x")
    starts, ends, _ = words(data, np.array([0, len(data)]))
    tracemalloc.start()
    hashes = span_hashes(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The word of a megabyte needs arrays of 8 MB; whole slices took 32 MB in each.
    assert peak < 100 << 20
    # Where a word stands doesn't change its hash.
    for k in [0, 1, len(starts) // 2, len(starts) - 1, int(np.argmax(ends - starts))]:
        alone = data[starts[k] : ends[k]]
        assert span_hashes(alone, np.array([0]), np.array([len(alone)]))[0] == hashes[k]
