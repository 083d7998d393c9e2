"""JSON arrays read by byte ranges against json.loads, at many range sizes."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioframe.session import settings
from folioframe.sources import arrays, files

SCHEMA = "title string, n bigint, inner struct<a: string, b: array<struct<c: string>>>"


def ranges(size):
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}


def elements(n):
    random.seed(n)
    nasty = ['}', '{', '[', ']', '"', '\\', '\\"', '},{', '"}', '\n', 'é漢🙂', ', ', '\\\\', '{"a": 1}', ' ']
    return [
        {"title": "".join(random.choices(nasty, k=random.randint(0, 12))), "n": i,
         "inner": {"a": random.choice(nasty), "b": [{"c": random.choice(nasty)} for _ in range(i % 3)]}}
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
@pytest.mark.parametrize("layout", [{"indent": 2, "ensure_ascii": False}, {"separators": (",", ":")}])
def test_same_rows_at_every_range_size(spark, tmp_path, size, layout):
    rows = elements(40)
    (tmp_path / "a b%20.json").write_text(json.dumps(rows, **layout), encoding="utf-8")
    (tmp_path / "one.json").write_text(json.dumps(rows[:1], **layout) + "\n", encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ] ")
    with settings(spark, ranges(size)):
        got = files.read_json_array(spark, str(tmp_path), SCHEMA, "FAILFAST", "*.json")
        table = [r.asDict(recursive=True) for r in got.collect()]
    for name, expected in (("a b%20.json", rows), ("one.json", rows[:1])):
        mine = sorted((r for r in table if r["file_name"] == name), key=lambda r: r["pos"])
        assert [{k: r[k] for k in ("title", "n", "inner")} for r in mine] == expected
        assert [r["pos"] for r in mine] == list(range(len(expected)))
    assert len(table) == len(rows) + 1


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps([{"n": i, "title": "x" * 50} for i in range(3000)]))
    with settings(spark, ranges(1 << 14)):
        found = arrays.array_elements(spark, str(tmp_path))
        assert arrays.fragments(spark, str(tmp_path), "}").rdd.getNumPartitions() > 10
        whole = arrays.fragments(spark, str(tmp_path), "}").select("range_start").distinct().count()
        assert whole > 10 and found.where("element IS NOT NULL").count() == 3000
        # only what goes over a border is put together by a shuffle
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(file_path" in plan and "wholetext" not in plan
        states = arrays._range_states(spark, str(tmp_path), None)
        assert states.count() == whole


@pytest.mark.parametrize("size", [9, 1 << 20])
def test_broken_files_give_no_rows_and_come_back_whole(spark, tmp_path, size):
    good = json.dumps(elements(12))
    broken = {
        "cut.json": good[: len(good) // 2], "after.json": good[:-1], "object.json": good[:-1] + "x]", "comma.json": good[:-1] + ",]",
        "twice.json": good + good, "numbers.json": "[1, 2]", "mixed.json": '[{"n": 1}, 2, {"n": 3}]', "type.json": '[{"n": 1} {"n": 2}]',
        "open.json": '[{"title": "a}', "text.json": "no json at all", "brace.json": '[{"n": 1}',
    }
    (tmp_path / "good.json").write_text(good)
    for name, text in broken.items():
        (tmp_path / name).write_text(text)
    with settings(spark, ranges(size)):
        rows = files.read_json_array(spark, str(tmp_path), SCHEMA, glob="*.json")
        assert {r["file_name"] for r in rows.select("file_name").distinct().collect()} == {"good.json"} and rows.count() == 12
        bad = {r["file_path"].rsplit("/", 1)[-1]: r["raw"] for r in files.unreadable_arrays(spark, str(tmp_path), SCHEMA, "*.json").collect()}
        assert bad == broken
        with pytest.raises(PySparkException, match="invalid JSON array"):
            files.read_json_array(spark, str(tmp_path), SCHEMA, "FAILFAST", "*.json").agg(F.max("n")).collect()
