"""CSV read by byte ranges against the csv module, at many range sizes."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from folioframe.session import settings
from folioframe.sources import files, quoted


def ranges(size):
    return {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}


def text_of(rows, **how):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", **how).writerows(rows)
    return out.getvalue()


def table(n):
    random.seed(n)
    nasty = ['"', '""', "\n", ",", "\n\n", "é漢", " ", "a", '\\', "'", "b\n\"c\""]
    return [[str(i), "x" + "".join(random.choices(nasty, k=random.randint(0, 9))), random.choice(nasty) + "."] for i in range(n)]


@pytest.mark.parametrize("size", [5, 64, 1000, 1 << 20])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_same_rows_at_every_range_size(spark, tmp_path, size, quoting):
    rows = table(60)
    (tmp_path / "a.csv").write_text(text_of([["n", "a b", "c"], *rows[:40]], quoting=quoting), encoding="utf-8")
    (tmp_path / "b.csv").write_text(text_of([["n", "a b", "c"], *rows[40:]], quoting=quoting)[:-1], encoding="utf-8")
    with settings(spark, ranges(size)):
        df = files.read_csv(spark, str(tmp_path))
        assert df.columns == ["n", "a b", "c"]
        assert sorted(([r[0], r[1], r[2]] for r in df.collect()), key=lambda r: int(r[0])) == rows
        typed = files.read_csv(spark, str(tmp_path), "id bigint, t string, u string")
        assert typed.agg(F.sum("id")).first()[0] == sum(range(60))


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    rows = [[str(i), "line\nbreak, and \"quotes\" " * (i % 3)] for i in range(2000)]
    (tmp_path / "big.csv").write_text(text_of([["n", "t"], *rows]))
    with settings(spark, ranges(1 << 13)):
        states = quoted._range_states(spark, str(tmp_path)).collect()
        assert len(states) > 5 and {r["inside"] for r in states} == {0, 1}
        assert files.read_csv(spark, str(tmp_path), "n bigint, t string").count() == 2000


def test_odd_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"never\nclosed')
    (tmp_path / "crlf.csv").write_text('a,b\r\n2,"x\r\ny"\r\n\r\n3,z\r\n', newline="")
    (tmp_path / "header.csv").write_text("a,b\n")
    got = {r["a"]: r["b"] for r in files.read_csv(spark, str(tmp_path), "a int, b string").collect()}
    assert set(got) == {1, 2, 3} and got[3] == "z" and got[1].startswith("never") and got[2].split() == ["x", "y"]
