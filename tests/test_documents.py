"""JSON collections byte for byte, by ranges, and what is refused."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tilewright.sources import documents as src


def data():
    strings = ["plain", 'quote " and \\ and },{"id":"x"', "line\nbreak", "é   ☾", "[{", ""]
    return [{"id": f"r{i:04}", "text": strings[i % 6] * (1 + i % 5), "nested": {"a": [i, [1.5, None]], "b": {}}, "list": [], "n": i / 7} for i in range(300)]


def keyed(spark, rows, key=lambda r: r["id"]):
    return spark.createDataFrame([(key(r), json.dumps(r)) for r in rows], "key string, value string")


@pytest.mark.parametrize("pretty", [True, False])
@pytest.mark.parametrize("layout", ["array", "map"])
def test_round_trip_byte_for_byte(spark, tmp_path, layout, pretty):
    rows, path = data(), str(tmp_path / "a.json")
    src.registered(spark)
    keyed(spark, rows[::-1]).repartitionByRange(5, "key").sortWithinPartitions("key").write.format("json_collection").mode("append").option("layout", layout).option("pretty", str(pretty).lower()).save(path)
    want = rows if layout == "array" else {r["id"]: r for r in rows}
    text = json.dumps(want, indent=2) if pretty else json.dumps(want, separators=(",", ":"))
    assert open(path, encoding="utf-8").read() == text and os.listdir(tmp_path) == ["a.json"]
    for size in (50, 1000, 1 << 25):
        got = src.read_collection(spark, path, range_bytes=size)
        assert sorted((r["key"], json.loads(r["value"])["n"]) for r in got.collect()) == [(r["id"], r["n"]) for r in rows]
        assert pretty or got.rdd.getNumPartitions() == 1
    again = str(tmp_path / "b.json")
    src.read_collection(spark, path, range_bytes=500).orderBy("key").write.format("json_collection").mode("append").option("layout", layout).option("pretty", str(pretty).lower()).save(again)
    assert open(again, encoding="utf-8").read() == text


def test_pieces_end_anywhere():
    doc = json.dumps(data()[:12], ensure_ascii=False).encode()
    want = [json.dumps(r, ensure_ascii=False).encode() for r in data()[:12]]
    for n in (1, 2, 3, 7, 50, 10_000):
        assert [r for _, r in src.records(iter([doc[i : i + n] for i in range(0, len(doc), n)]))] == want
    with pytest.raises(ValueError):
        list(src.records(iter([doc[:-9]])))


def test_rows_as_documents(spark, tmp_path):
    rows = [("b", 2, [(1.0, 2.5)], {"k": 1.0}), ("a", None, [], None), ("c", 3, None, {})]
    df = spark.createDataFrame(rows, "id string, n int, points array<struct<x:double,y:double>>, m map<string,double>")
    path = str(tmp_path / "c.json")
    src.write_collection(df, path, "id", pretty=True)
    want = [{"id": "a", "n": None, "points": [], "m": None}, {"id": "b", "n": 2, "points": [{"x": 1.0, "y": 2.5}], "m": {"k": 1.0}}, {"id": "c", "n": 3, "points": None, "m": {}}]
    assert open(path).read() == json.dumps(want, indent=2)
    src.write_collection(df, path, "id", layout="map", value="points")
    assert open(path).read() == json.dumps({r["id"]: r["points"] for r in want}, separators=(",", ":"))
    src.write_collection(df.where("false"), path, "id")
    assert open(path).read() == "[]" and src.read_collection(spark, path).count() == 0


@pytest.mark.parametrize("bad", ["a double", "b array<double>", "c struct<x:array<struct<y:double>>>", "d map<string,array<float>>"])
def test_numbers_that_json_lacks_are_refused_at_any_depth(spark, tmp_path, bad):
    name, kind = bad.split(" ")
    nan = {"a": "double('NaN')", "b": "array(1d, double('inf'))", "c": "named_struct('x', array(named_struct('y', 0d), named_struct('y', double('NaN'))))", "d": "map('k', array(float('-inf')))"}[name]
    df = spark.range(50).withColumn(name, F.when(F.col("id") == 31, F.expr(nan)).cast(kind))
    path = str(tmp_path / "d.json")
    src.write_collection(df.where("id <> 31"), path, "id")
    before = open(path).read()
    with pytest.raises(Exception, match="not finite"):
        src.write_collection(df, path, "id")
    assert open(path).read() == before and os.listdir(tmp_path) == ["d.json"]
    with pytest.raises(Exception, match="JSON has"):
        src.registered(spark).createDataFrame([("k", "[1, NaN]")], "key string, value string").write.format("json_collection").mode("append").save(path)
    assert open(path).read() == before


def test_a_folder_of_details(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"t{i}.json").write_text(json.dumps([{"id": f"{i}-{j}", "v": j} for j in range(i)], indent=2 if i % 2 else None))
    got = src.read_collection(spark, str(tmp_path))
    assert sorted(r["key"] for r in got.collect()) == sorted(f"{i}-{j}" for i in range(5) for j in range(i))


def test_a_compact_document_by_ranges_of_any_size(tmp_path):
    """Each record is read once, wherever the ranges begin: in strings, after backslashes, in letters of several bytes, in the last blanks."""
    rows = data()[:8] + ["a \\", '\\"', {"k]": "}\\\\"}, 1.5, [], ""]
    for layout in (rows, {f'k"{i}': r for i, r in enumerate(rows)}):
        path = tmp_path / "a.json"
        path.write_text("  " + json.dumps(layout, ensure_ascii=False, separators=(",", ":")) + " \n" * 9, encoding="utf-8")
        doc, name = path.read_bytes(), str(path)
        want = [r for _, r in src.records(iter([doc]))]
        assert len(want) == len(rows)
        reader = src._Reader(name, "id", 1 << 20, "{}")
        for size in (*range(1, 40), 100, 333, 5000):
            ranges = [(a, min(a + size, len(doc))) for a in range(0, len(doc), size)]
            with open(path, "rb") as file:
                begins = src.begins([src.counted(iter([doc[a : (a + b) // 2], doc[(a + b) // 2 : b]]), src._escaped(file, a)) for a, b in ranges])
            got = [r for (a, b), begin in zip(ranges, begins, strict=True) for r in reader._records(src._Range(name, a, b, False, begin))]
            assert got == want, size
    with open(path, "wb") as file:
        file.write(b"x" + b"\\" * 1001)
    with open(path, "rb") as file:
        assert [src._escaped(file, a) for a in (0, 1, 2, 999, 1000, 1002)] == [False, False, True, False, True, True]


def test_large_compact_documents_are_many_tasks_work(spark, tmp_path):
    rows = [dict(r, id=f"{r['id']}-{j}") for j in range(110) for r in data()]
    rows[7]["text"] = '},{"id":"x"\\' * 1_000_000  # longer than a range
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows, separators=(",", ":")))
    got, later = (src.read_collection(spark, str(path), range_bytes=1000) for _ in range(2))
    assert got.rdd.getNumPartitions() == -(-path.stat().st_size // src.COMPACT) >= 5
    assert sorted(tuple(r) for r in got.collect()) == sorted((r["id"], json.dumps(r, separators=(",", ":"))) for r in rows)
    path.write_text(json.dumps(rows[20:], separators=(",", ":")))  # another document, of which nobody has counted anything
    assert later.count() == len(rows) - 20
    with pytest.raises(Exception, match="was replaced"):
        got.where("key is not null").count()
    path.write_text(json.dumps(rows, separators=(",", ":"))[:-9])
    with pytest.raises(Exception, match="within a record"):
        src.read_collection(spark, str(path)).count()


def test_documents_indented_otherwise(spark, tmp_path):
    for n, text in (("four", json.dumps(data(), indent=4)), ("lines", "[\n" + ",\n".join(json.dumps(r) for r in data()) + "\n]"), ("none", "[\n]")):
        (tmp_path / f"{n}.json").write_text(text)
        assert src.read_collection(spark, str(tmp_path / f"{n}.json")).count() == (0 if n == "none" else 300)
