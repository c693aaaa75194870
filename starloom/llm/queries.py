"""The registered queries of the operators: whole tables, production parameters, contract columns first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    alignment,
    binpack,
    decontaminate,
    language_model,
    main_text,
    near_duplicates,
    personal_data,
    prefix_trie,
    quality_rules,
    repeats,
    segmentations,
    substrings,
    url_language,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("failures").bitwiseAND(F.lit(quality_rules.mask("base")).cast("long")) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), quality_rules.passes("v2").alias("kept"), "failures",
    )


def op3_url_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_language.judge(table(spark, sf_dir, "pages"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations.encode(table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept", "class_id"
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op8_binpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contaminated(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    )
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.nodes(prefix_trie.paths(prefix_trie.rebuilt(lists)))


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_main_text, op2_quality_rules, op3_url_language, op4_language_model, op5_segmentations,
        op6_near_duplicates, op7_repeats, op8_binpack, op9_decontaminate, op10_personal_data,
        op11_alignment, op12_prefix_trie, op13_substrings,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_quality_rules": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (
            SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
                [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
            FROM t
        ),
        places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
        keys AS (SELECT doc_id, i, ws[i] || chr(9) || ws[i + 1] || chr(9) || ws[i + 2] AS k FROM places),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM keys) WHERE n > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
        ),
        m AS (
            SELECT w.doc_id, len(ws)::BIGINT AS n_words,
                coalesce(length(array_to_string(ws, '')), 0)::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
                len(lines) AS n_lines,
                length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
                length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
                length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks
            FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
        ),
        f AS (
            SELECT *, ((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
                + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
                + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END)
                + (CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END)
                + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
                + (CASE WHEN 2 * n_upper > n_letters THEN 32 ELSE 0 END)
                + (CASE WHEN 2 * n_marks > n_words THEN 64 ELSE 0 END))::BIGINT AS failures
            FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
            failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
        FROM f
    """,
    "op6_near_duplicates": rf"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
        ),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS k
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        sets AS (SELECT doc_id, list_sort(list(k)) AS v FROM s GROUP BY doc_id),
        classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY v) AS class_id FROM sets),
        leaders AS (SELECT doc_id FROM classes WHERE doc_id = class_id),
        common AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
            FROM (SELECT s.* FROM s SEMI JOIN leaders USING (doc_id)) a
            JOIN (SELECT s.* FROM s SEMI JOIN leaders USING (doc_id)) b ON a.k = b.k AND a.doc_id < b.doc_id
            GROUP BY ALL
        ),
        links AS (
            SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
            WHERE 100 * shared >= 80 * (x.n + y.n - shared)
        ),
        edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
        reach AS (
            SELECT doc_id AS id, doc_id AS r FROM leaders
            UNION SELECT reach.id, edges.v FROM reach JOIN edges ON edges.u = reach.r
        ),
        roots AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
        SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
            d.doc_id = coalesce(component, d.doc_id) AS kept, coalesce(class_id, d.doc_id) AS class_id
        FROM documents d
        LEFT JOIN sizes ON sizes.doc_id = d.doc_id
        LEFT JOIN classes ON classes.doc_id = d.doc_id
        LEFT JOIN roots ON roots.id = classes.class_id
    """,
    "op9_decontaminate": rf"""
        WITH d AS (
            SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
            FROM documents
        ),
        b AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
        ),
        patterns AS (
            SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS k
            FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
        ),
        places AS (
            SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS k
            FROM (
                SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
                FROM d, (SELECT DISTINCT n FROM patterns) WHERE len(ws) >= n
            )
        ),
        hits AS (SELECT doc_id, item_id, places.n, i FROM places JOIN patterns USING (n, k)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
        ),
        items AS (
            SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS h
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, coalesce(h, sha256('')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit_words ON hit_words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
    """,
    "op12_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id, role, text, strlen(text) AS n, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)
            ) AS i
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
            WHERE conv_id IS NOT NULL
        ),
        c AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
                list_concat([4294967295::BIGINT], [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
                lambda a, b: list_reduce(
                    list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
                )
            )) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM t)
        ),
        rebuilt AS (
            SELECT conv_id, role, text, n, row_number() OVER (PARTITION BY conv_id ORDER BY own, i) AS d
            FROM (
                SELECT c.conv_id, role, text, n, 0 AS own, i FROM c JOIN t ON t.conv_id = base AND i <= h
                UNION ALL
                SELECT c.conv_id, role, text, n, 1 AS own, i FROM c JOIN t ON t.conv_id = c.conv_id AND i > h
            )
        ),
        steps AS (
            SELECT conv_id, 0 AS d, '' AS k, 0 AS n FROM c
            UNION ALL
            SELECT conv_id, d, md5(string_agg(md5(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d)), n
            FROM rebuilt
        ),
        ends AS (SELECT conv_id, max(d) AS d FROM steps GROUP BY conv_id),
        node AS (
            SELECT d, k, min(s.conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
                sha256(coalesce(string_agg(s.conv_id::VARCHAR, ',' ORDER BY s.conv_id) FILTER (e.d IS NOT NULL), '')) AS ends_sha256
            FROM steps s LEFT JOIN ends e USING (conv_id, d) GROUP BY d, k
        ),
        child AS (
            SELECT a.d, a.k, p.k AS pk, m.conv_id AS parent
            FROM node a JOIN steps p ON p.conv_id = a.conv_id AND p.d = a.d - 1 JOIN node m ON m.d = p.d AND m.k = p.k
        ),
        kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM child GROUP BY ALL),
        full_ AS (
            SELECT node.*, coalesce(n_children, 0) AS n_children, parent
            FROM node LEFT JOIN kids USING (d, k) LEFT JOIN child USING (d, k)
        ),
        sums AS (
            SELECT a.d, a.k, sum((f.n_children = 0)::INT) AS n_leaves, sum((f.n_convs - 1) * f.n) AS saved
            FROM full_ f JOIN steps a ON a.conv_id = f.conv_id AND a.d <= f.d GROUP BY a.d, a.k
        )
        SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs::BIGINT AS n_convs,
            n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
        FROM full_ JOIN sums USING (d, k)
    """,
}
