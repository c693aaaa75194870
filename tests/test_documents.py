"""Documents read in ranges against the same documents read whole."""

import gzip
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from starloom.sources import documents
from starloom.sources.envelope import document_tables, explode_extract, keep_rows, read_documents, read_extract, read_single, read_transformed, table_rows

ROW = T.StructType().add("id", T.LongType()).add("name", T.StringType()).add("x", T.VariantType())


@pytest.fixture()
def ranges(spark):
    """Files are cut into ranges of some hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)
        spark.conf.set(names[2], 1)

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def text(r, n=12):
    return "".join(r.choice(['{', '}', '[', ']', ',', ':', '"', '\\', '\\\\', 'a', 'b"', 'é', '漢', '\U0001f600', '\n', ' ', 'sample', '{"']) for _ in range(r.randrange(n)))


def value(r, deep=2):
    kind = r.randrange(6 if deep else 4)
    if kind < 2:
        return r.choice([None, True, r.randrange(10**6), -2.25])
    if kind < 4:
        return text(r)
    if kind == 4:
        return [value(r, deep - 1) for _ in range(r.randrange(4))]
    return {text(r) + str(k): value(r, deep - 1) for k in range(r.randrange(4))}


def rows_of(r, n):
    return [{"id": r.randrange(10**6), "name": text(r, 40), "x": value(r, 3)} for _ in range(n)]


def written(r, doc):
    return json.dumps(doc, ensure_ascii=r.random() < 0.5, indent=r.choice([None, None, 2]))


def found(df, *names):
    got = table_all(df).collect()
    return Counter((*[r[n] for n in names], r["file"].rsplit("/", 1)[-1], r["pos"], json.dumps(json.loads(r["row"]), sort_keys=True)) for r in got)


def table_all(df):
    names = [c for c in ("_database", "table") if c in df.columns]
    return df.select(*names, "_pos.file", "_pos.pos", F.to_json("row").alias("row"))


def wanted(entries):
    return Counter((*names, file, k, json.dumps(row, sort_keys=True)) for *names, file, rows in entries for k, row in enumerate(rows))


@pytest.mark.parametrize("size", [700])
def test_extracts_in_ranges(spark, tmp_path, ranges, size):
    r, want = random.Random(size), []
    for f in range(3):
        doc = {"extraction_metadata": {"total": 1, "sample": [{"no": 1}]}}
        for d in range(r.randrange(1, 4)):
            name = f"db{d}" + text(r, 4)
            doc[name] = {"odd": 5}
            for t in range(r.randrange(4)):
                rows = rows_of(r, r.choice([0, 1, 7, 30]))
                doc[name][f"t{t}"] = {"records": len(rows), "columns": [["a", {"sample": [1]}]], "sample": rows, "more": {"sample": [{"no": 2}]}}
                want.append((name, f"t{t}", f"f{f}.json", rows))
        (tmp_path / f"f{f}.json").write_text(written(r, doc) + r.choice(["", "\n", "  \n"]))
    ranges(size)
    rows = read_extract(spark, str(tmp_path / "*.json"))
    assert found(rows, "_database", "table") == wanted(want)
    assert documents.fragments(spark, str(tmp_path / "*.json")).rdd.getNumPartitions() > 5


@pytest.mark.parametrize("size", [900])
def test_single_and_transformed_in_ranges(spark, tmp_path, ranges, size):
    r = random.Random(size + 1)
    (tmp_path / "s").mkdir()
    (tmp_path / "t").mkdir()
    ones, twos = [], []
    for f in range(2):
        rows = rows_of(r, 25)
        named = {"database": "d" + text(r), "table": f"t{f}"}
        doc = {"note": text(r, 90), "data": rows, **named} if f % 2 else {**named, "data": rows, "meta": {"data": [1]}}
        (tmp_path / "s" / f"{f}.json").write_text(written(r, doc))
        ones.append((named["database"], f"t{f}", f"{f}.json", rows))
        tables = {f"dim{k}": rows_of(r, 15) for k in range(3)} | {"none": []}
        (tmp_path / "t" / f"{f}.json").write_text(written(r, {"etl": text(r), "tables": tables, "list": [{"no": 1}]} if f % 2 else tables))
        twos += [(name, f"{f}.json", v) for name, v in tables.items()]
    ranges(size)
    assert found(read_single(spark, str(tmp_path / "s")), "_database", "table") == wanted(ones)
    assert found(read_transformed(spark, str(tmp_path / "t")), "table") == wanted(twos)


def test_equal_to_documents_read_whole(spark, tmp_path, ranges):
    r = random.Random(9)
    doc = {f"db{d}": {"users": {"sample": rows_of(r, 50)}} for d in range(3)}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    ranges(500)
    one = table_rows(read_extract(spark, str(tmp_path / "d.json")), "users", ROW)
    two = table_rows(explode_extract(read_documents(spark, str(tmp_path / "d.json"))), "users", ROW)
    plain = lambda df: sorted(str(x) for x in df.withColumn("x", F.to_json("x")).collect())
    assert plain(one) == plain(two) and one.count() == 150


def test_large_document_is_many_tasks(spark, tmp_path, ranges):
    rows = [{"id": k, "name": "x" * 200, "x": {"k": [k, {"d": "}"}]}} for k in range(30_000)]
    (tmp_path / "d.json").write_text(json.dumps({"db": {"users": {"records": len(rows), "sample": rows}}}))
    ranges(256 << 10)
    df = read_extract(spark, str(tmp_path / "d.json"))
    assert documents.fragments(spark, str(tmp_path / "d.json")).rdd.getNumPartitions() >= 20
    users = table_rows(df, "users", T.StructType.fromDDL("id bigint"))
    assert users.agg(F.count("*"), F.sum("id"), F.countDistinct("_pos")).first()[:] == (30_000, sum(range(30_000)), 30_000)
    assert users.filter("_pos.pos <> id").isEmpty()


@pytest.mark.parametrize(
    "broken",
    ['{"db": {"t": {"sample": [{"a": 1}', '{"db": {"t": {"sample": [{"a": "1', '{"db": {"t": {"sample": [{"a": 1}]}}', '{"db": {}}}', "", "no json", '{"a": {}} {"b": {}}', '{"a": {}} x',
     '{"db": {"t": {"sample": [{"a" 1}]}}}'],
)
@pytest.mark.parametrize("size", [8])
def test_broken_documents_raise(spark, tmp_path, ranges, broken, size):
    (tmp_path / "x.json").write_text(broken)
    ranges(size)
    with pytest.raises(Exception, match="(?i)malformed|json"):
        table_all(read_extract(spark, str(tmp_path / "x.json"))).collect()
        if not broken:
            raise ValueError("malformed JSON")  # a file without bytes has no range at all


def test_compressed_documents_are_streams(spark, tmp_path, ranges):
    rows = [{"id": k} for k in range(5000)]
    with gzip.open(tmp_path / "d.json.gz", "wt") as out:
        json.dump({"db": {"users": {"sample": rows}}}, out)
    ranges(1000)
    users = table_rows(read_extract(spark, str(tmp_path / "d.json.gz")), "users", T.StructType.fromDDL("id bigint"))
    assert users.agg(F.count("*"), F.sum("id")).first()[:] == (5000, sum(range(5000)))


def test_rows_are_kept_by_table(spark, tmp_path):
    doc = {"db": {"users": {"sample": [{"id": 1, "user_id": 1}]}, "project": {"sample": [{"id": 2, "tenant_tsid": 5}]}}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    rows = read_extract(spark, str(tmp_path / "d.json"))
    kept = keep_rows(rows, str(tmp_path / "kept"))
    assert document_tables(kept)["project"].select("id").collect()[0][0] == 2
    assert "= users)" in plan_of(table_rows(kept, "users", ROW)).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(map(str, table_all(kept).collect())) == sorted(map(str, table_all(rows).collect()))


def test_summaries_join_like_the_text():
    r = random.Random(4)
    for _ in range(60):
        raw = json.dumps(value(r, 4), ensure_ascii=False).encode()
        cuts = sorted(r.sample([k for k, b in enumerate(raw) if b == ord("{")] or [0], min(3, raw.count(b"{"))))
        parts = [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)]) if b > a]
        now = documents.Stretch(False)
        for part in parts:
            now = now.then(documents.stretches(part)[now.inside])
        whole = documents.stretches(raw)[0]
        assert (now.inside, now.closed, now.opened, now.commas) == (whole.inside, whole.closed, whole.opened, whole.commas)


@pytest.mark.parametrize("seed", range(40))
def test_rows_with_boundaries_anywhere(seed):
    """The reader alone, with boundaries at some braces and states from the summaries."""
    r = random.Random(seed)
    doc, want = {"m": text(r)}, []
    for d in range(r.randrange(1, 4)):
        name = f"d{d}" + text(r, 4)
        doc[name] = {"n": value(r)}
        for t in range(r.randrange(4)):
            rows = [value(r, 3) for _ in range(r.randrange(6))]
            doc[name][f"t{t}" + text(r, 3)] = {"x": [value(r)], "sample": rows, "y": value(r)}
            want += [(name, list(doc[name])[-1], k, row) for k, row in enumerate(rows)]
    raw = json.dumps(doc, ensure_ascii=False, indent=r.choice([None, 1])).encode()
    braces = [k for k, b in enumerate(raw) if b == ord("{") and k]
    cuts = sorted(r.sample(braces, r.randrange(len(braces) + 1)))
    state, parts, got = documents.Stretch(False), {}, []
    for a, b in zip([0, *cuts], [*cuts, len(raw)]):
        reader = documents._Reader(state, documents._extract_place, 4)
        half = r.choice([a, b, *[k for k in braces if a < k < b]])
        for found in (*reader.read(raw[a:half]), *reader.read(raw[half:b]), reader.rest()):
            if found and found[4]:
                got.append((*found[:2], found[3], found[5]))
            elif found:
                parts.setdefault((*found[:2], found[3]), []).append(found[5])
        state = state.then(documents.stretches(raw[a:b])[state.inside])
    got += [(*key, b"".join(pieces)) for key, pieces in parts.items()]
    got = [(*key, json.loads(piece)) for *key, piece in got if piece.strip()]
    order = lambda rows: sorted(rows, key=lambda x: (x[0], x[1], x[2]))
    assert order(got) == order(want) and not state.opened and not state.closed


def test_quotes_behind_backslashes():
    raw = b'"a\\"b" "\\\\" "\\\\\\"" x'
    assert documents._quotes(np.frombuffer(raw, np.uint8)).tolist() == [0, 5, 7, 10, 12, 17]
