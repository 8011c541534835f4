"""One document in byte ranges of any size against json.loads."""

import json
import random

import pytest
from pyspark.sql import types as T

from cumulus.sources.files import read_json_envelope_at
from cumulus.sources.json_ranges import read_json_document

INNER = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.ArrayType(
    T.StructType([T.StructField("z", T.LongType())])))])
RECORD = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                       T.StructField("c", INNER)])
LIMIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def ranges(spark):
    old = {k: spark.conf.get(k) for k in (LIMIT, "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set(LIMIT, str(n))
    for k, v in old.items():
        spark.conf.set(k, v)


def flat(x):
    c = x.get("c")
    return x["a"], x.get("b"), (c["x"], [z["z"] for z in c["y"]]) if c else None


def read(spark, path, field="recs"):
    return sorted((flat(r.asDict(True)) for r in read_json_document(spark, str(path), RECORD, field).collect()),
                  key=lambda t: t[0])


@pytest.mark.parametrize("size,indent,ascii_", [(48, None, True), (64, 2, False), (700, 1, True),
                                                (1 << 20, 2, False)])
def test_records_of_one_document(spark, tmp_path, ranges, size, indent, ascii_):
    rng = random.Random(size)

    def text():
        return "".join(rng.choice('ab{}[]",:\\\n é"recs":') for _ in range(rng.randint(0, 14)))

    def record(i):
        out = {"a": i, "b": rng.choice([None, text(), "plain"])}
        if rng.random() < .5:
            out["c"] = {"x": text(), "y": [{"z": j} for j in range(rng.randint(0, 3))]}
        return out
    records = [record(i) for i in range(120)]
    doc = {"runid": text(), "meta": {"recs": [{"a": -1}], "k": [1, {"q": 3}]}, "none": [], "recs": records,
           "after": [{"a": -2}, {"a": -3}], "z": {"recs": [{"a": -9}]}}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=indent, ensure_ascii=ascii_) + ("\n" if indent == 1 else ""))
    ranges(size)
    df = read_json_document(spark, str(path), RECORD, "recs")
    want = [flat(r) for r in records]
    assert read(spark, path) == want
    if size < 100:
        scans = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
        assert scans > 20 and df.columns == ["a", "b", "c"]


def test_documents_behind_each_other_and_in_several_files(spark, tmp_path, ranges):
    ranges(100)
    for f in range(2):
        docs = [{"n": [1], "recs": [{"a": 100 * f + 10 * i + j, "b": "}"} for j in range(i)]} for i in range(5)]
        (tmp_path / f"{f}.json").write_text("\n".join(map(json.dumps, docs)) + "\n")
    assert [r[0] for r in read(spark, tmp_path)] == sorted(
        100 * f + 10 * i + j for f in range(2) for i in range(5) for j in range(i))


@pytest.mark.parametrize("doc,want", [({"recs": []}, 0), ({"n": 1}, 0), ({"recs": [{"a": 1}]}, 1),
                                      ({"recs": [], "x": [{"a": 5}]}, 0), ({"x": [{"a": 5}], "recs": [{}]}, 1)])
def test_empty_and_missing_fields(spark, tmp_path, ranges, doc, want):
    ranges(60)
    (tmp_path / "d.json").write_text(json.dumps(doc))
    assert read_json_document(spark, str(tmp_path), RECORD, "recs").count() == want


@pytest.mark.parametrize("text", ['{"recs":[{"a":1},null,{"a":2}]}', '{"recs":[{"a":1},{"a":2', '{"recs":[{"a":"x}',
                                  '{"recs":[{"a":1},{"a":2 3}]}', '{"recs":[7]}'])
def test_what_is_no_document_of_records_fails(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed|no object"):
        read_json_document(spark, str(tmp_path), RECORD, "recs").collect()


def test_member_by_position(spark, tmp_path):
    row = {"a": 1, "b": "x", "c": {"x": "}", "y": [{"z": 2}]}}
    for name, doc in {"1": {"runid": 5, "anything": [row, {"a": 2}], "recs": [{"a": -1}]},
                      "2": {"z": {"k": [1]}, "a renamed field": [row]}, "3": {"only": [row]},
                      "4": {"runid": 5, "recs": None}, "5": {"runid": 5, "recs": []}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, indent=1))
    got = read_json_envelope_at(spark, str(tmp_path), RECORD, 2, multi_line=True)
    assert got.columns == RECORD.fieldNames()
    assert sorted(r["a"] for r in got.collect()) == [1, 1, 2]
    (tmp_path / "lines.txt").write_text('{"x": 1, "y": [{"a": 7}]}\n\n{"q": 1, "p": [{"a": 8}]}\n')
    lines = read_json_envelope_at(spark, str(tmp_path / "lines.txt"), RECORD, 2)
    assert sorted(r["a"] for r in lines.collect()) == [7, 8]


@pytest.mark.parametrize("text", ['{"x": 1, "y": {"a": 7}}', '{"x": 1, "y": "[]"', '{"x": 1, "y": [{"a": "no"}]}'])
def test_member_of_another_kind_fails(spark, tmp_path, text):
    (tmp_path / "d.json").write_text(text)
    with pytest.raises(Exception):
        read_json_envelope_at(spark, str(tmp_path), RECORD, 2).collect()
