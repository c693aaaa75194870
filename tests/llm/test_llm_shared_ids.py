"""Near duplicates where a doc_id stands beside several texts, and short texts in the search for repeats."""

import random

import pytest

from starloom.llm import near_duplicates

DOC = "doc_id long, text string, lang string, low string, class string, n_shingles string"
A = " ".join(f"a{k}" for k in range(60))
B = " ".join(f"b{k}" for k in range(60))
C = " ".join(f"c{k}" for k in range(60))
NEAR_A = A.replace("a59", "x")


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, f"l{i}", "x", "y", "z") for i, (k, t) in enumerate(rows)], DOC)


def components(df):
    return sorted(((x["doc_id"], x["component_id"]) for x in df.collect()), key=lambda x: (x[0] is None, x))


def test_texts_of_one_id_are_linked_by_it(spark):
    rows = [(3, B), (5, A), (5, B), (7, A), (9, A), (11, C)]
    got = components(near_duplicates.groups(docs_of(spark, rows)))
    assert got == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 3), (11, 11)]


def test_no_text_is_lost(spark):
    rows = [(3, B), (5, A), (5, B), (7, A), (9, A), (11, C)]
    out = near_duplicates.deduplicated(docs_of(spark, rows))
    assert sorted((x["doc_id"], x["text"]) for x in out.collect()) == [(3, B), (5, A), (11, C)]
    assert out.columns == DOC.replace(",", "").split()[::2]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, A), (1, A)], [(1, A)]),
        ([(1, A), (1, A), (2, NEAR_A)], [(1, A)]),
        ([(2, A), (1, NEAR_A), (1, B), (1, NEAR_A)], [(1, B), (1, NEAR_A)]),
        ([(1, None), (1, ""), (1, A), (None, A), (None, A)], [(1, None), (1, ""), (1, A), (None, A), (None, A)]),
        ([(1, A), (1, NEAR_A)], None),
        ([], []),
    ],
)
def test_one_row_of_each_stays(spark, rows, want):
    out = [(x["doc_id"], x["text"]) for x in near_duplicates.deduplicated(docs_of(spark, rows)).collect()]
    if want is None:
        assert len(out) == 1 and out[0] in rows
    else:
        order = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
        assert sorted(out, key=order) == sorted(want, key=order)


def test_shared_ids_among_many(spark):
    r = random.Random(3)
    base = [[f"w{r.randrange(5000)}" for _ in range(80)] for _ in range(5)]
    rows = []
    for _ in range(120):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2])):
            words[r.randrange(80)] = f"x{r.randrange(10**6)}"
        rows.append((r.randrange(60), " ".join(words)))
    sets = [frozenset(tuple(t.split()[i : i + 4]) for i in range(77)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), d), d)
    want = sorted((d, least[root(k)]) for k, (d, _) in enumerate(rows))
    assert components(near_duplicates.groups(docs_of(spark, rows))) == want


def test_repeats_of_short_texts(spark):
    from starloom.llm import repeats

    docs = spark.range(300_000).selectExpr("id AS doc_id", "concat('short ', id) AS text")
    out = repeats.without_repeats(docs)
    assert out.count() == 300_000 and out.where("n_removed > 0").isEmpty()
