"""CSV files with line breaks in quotes, read in splits of any size, and headers read without the files."""

from __future__ import annotations

import csv
import io
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratum.sources import landing

HEADER = "flavour_id,name,description"


def texts(seed, n=60):
    rnd = random.Random(seed)
    parts = ["a", "é", "b c", ",", '"', "\n", "\r\n", "\n\n", "", "long " * 5, '""', '"\n', ",\n,"]
    rows = [(str(i), "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5))), "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 5)))) for i in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator=rnd.choice(["\n", "\r\n"])).writerows([HEADER.split(","), *rows])
    return out.getvalue()


def sequential(text):
    rows = [[c.replace("\r\n", "\n") for c in r] for r in csv.reader(io.StringIO(text, newline=""))]
    return [(int(a), b or None, c or None) for a, b, c in rows[1:]]


@pytest.fixture
def split_size(spark):
    def change(size):
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.set(name, str(size))

    yield change
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def loaded(spark, folder, **more):
    found = landing.manifest(landing.list_files(spark, str(folder)))
    return landing.load(spark, found, "flavours", datetime(2024, 5, 8), **more)


@pytest.mark.parametrize("size", [97, 1000, 10**9])
def test_any_split_size_equals_a_sequential_parse(spark, tmp_path, split_size, size):
    expected = Counter()
    for seed in range(2):
        text = texts(seed)
        (tmp_path / f"Flavours_20240506_{seed}.csv").write_bytes(text.encode())
        expected.update(sequential(text))
    plain = HEADER + "\n7,plain,x\n8,\"quoted, on one \"\"line\"\"\",y\n"
    (tmp_path / "Flavours_20240507_1.csv").write_text(plain)
    expected.update(sequential(plain))
    (tmp_path / "Flavours_20240507_2.csv").write_text(HEADER + '\n1,"left open,x\n2,y,z\n')
    split_size(size)
    for whole_file in (0, 10**9):
        load = loaded(spark, tmp_path, whole_file=whole_file)
        rows = Counter(tuple(r) for r in load.rows.select("flavour_id", "name", "description").collect())
        assert rows == expected, whole_file
        assert [(r.delivery[-5:], r.reason) for r in load.rejects.collect()] == [("2.csv", "bad value")]


def test_a_record_beyond_the_limit_breaks_its_file_only(spark, split_size):
    lines = [("f", i // 3 * 10, i, v) for i, v in enumerate(["h", 'a"', "x" * 9, 'b"', "c"])] + [("g", 0, 0, "h"), ("g", 0, 1, "ok")]
    table = spark.createDataFrame(lines, "file string, start long, at long, value string").withColumn("quotes", F.expr(landing._QUOTES))
    cut = lambda n: sorted((r.file, r.record, r.text) for r in landing.cut_records(table, n).collect())
    assert cut(100) == [("f", 1, "h"), ("f", 2, 'a"\n' + "x" * 9 + '\nb"'), ("f", 3, "c"), ("g", 1, "h"), ("g", 2, "ok")]
    assert cut(12) == [("f", 2, None), ("g", 1, "h"), ("g", 2, "ok")]


def test_other_delimiters_come_from_the_header(spark, tmp_path):
    for i, d in enumerate(";\t|,"):
        lines = [d.join(["Name", "flavour_id", "description"]), d.join(["a,b" if d != "," else '"a,b"', str(i), '"x\ny"'])]
        (tmp_path / f"Flavours_20240506_{i}.csv").write_text("\n".join(lines) + "\n")
    for whole_file in (0, 10**9):
        load = loaded(spark, tmp_path, whole_file=whole_file)
        assert {tuple(r) for r in load.rows.select("flavour_id", "name", "description").collect()} == {(i, "a,b", "x\ny") for i in range(4)}
        assert load.rejects.count() == 0


def test_headers_do_not_read_the_files(spark, tmp_path):
    big = tmp_path / "Flavours_20240506_1.csv"
    line = "1,some name,some description that is a little longer\n"
    with big.open("w") as f:
        f.write(HEADER + "\n")
        for _ in range(60):
            f.write(line * 20_000)  # 60 MB in all
    (tmp_path / "Flavours_20240506_2.csv").write_text(HEADER + "\n")
    found = landing.manifest(landing.list_files(spark, str(tmp_path)))
    store = spark._jsc.sc().statusStore()
    jobs = {j.jobId() for j in _each(store.jobsList(None))}
    headers = {d.file_name[-5]: d.header for d in landing.probe(spark, found, "flavours")}
    assert headers == {"1": tuple(HEADER.split(",")), "2": tuple(HEADER.split(","))}
    read = 0
    for job in _each(store.jobsList(None)):
        if job.jobId() not in jobs:
            for stage in _each(job.stageIds()):
                read += store.lastStageAttempt(stage).inputBytes()
    assert 0 < read < 8_000_000


def _each(seq):
    return [seq.apply(i) for i in range(seq.size())]
