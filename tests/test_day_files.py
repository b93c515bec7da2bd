"""S11 on a stream: repeatable batches, merged files, no record twice or missing at any step."""

import json
import os
import time

from pyspark.sql import functions as F

from tidemart.sinks.days import DayFiles

DAY = 86_400_000
FIRST = 1_705_276_800_000  # 2024-01-15


def record(n, at):
    return (json.dumps({"n": n, "at": at}),)


def batch(spark, *rows):
    return spark.createDataFrame(rows, "value string")


def seen(files, spark, days=None):
    found = files.read(spark, days).select(F.get_json_object("value", "$.n").cast("int"), "day").collect()
    return sorted((n if n is not None else -1, day) for n, day in found)


def text_files(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".txt")]


EXPECTED = [(n, d) for n in range(0, 40, 2) for d in ["20240115"]] + [(n, "20240116") for n in range(1, 40, 2)]


def test_batches_repeat_and_merge(spark, tmp_path):
    files = DayFiles(str(tmp_path), "at")
    for k in range(4):
        rows = [record(n, FIRST + (n % 2) * DAY) for n in range(k * 10, k * 10 + 10)]
        files.write(batch(spark, *rows).repartition(3), k)
        files.write(batch(spark, *rows), k)  # run again
    assert seen(files, spark) == sorted(EXPECTED)
    assert files.roll(spark) == []  # neither idle nor old nor large
    now = time.time()
    assert files.roll(spark, before=3, now=now + 301) == ["20240115", "20240116"]
    assert seen(files, spark) == sorted(EXPECTED)
    assert len(text_files(tmp_path / "rolled")) == 2
    files.write(batch(spark, *[record(n, FIRST + (n % 2) * DAY) for n in range(10)]), 0)  # again, when it is merged
    assert seen(files, spark) == sorted(EXPECTED)
    assert seen(files, spark, ["20240116"]) == [x for x in sorted(EXPECTED) if x[1] == "20240116"]
    assert not any("day=20240115" in f for f in files.folders(spark, ["20240116"]))
    assert len(files.expire(spark, 3600)) == 0
    assert len(files.expire(spark, -1)) == 3
    assert seen(files, spark) == sorted(EXPECTED)
    assert len(files.folders(spark)) == 4  # two merged days, two of the last batch
    assert files.roll(spark, now=now + 900) == ["20240115", "20240116"]
    assert files.roll(spark, now=now + 900) == []
    assert seen(files, spark) == sorted(EXPECTED)


def test_only_the_idle_day_is_merged(spark, tmp_path):
    files = DayFiles(str(tmp_path), "at", idle=300, age=1e9)
    files.write(batch(spark, record(1, FIRST), record(2, FIRST + DAY)), 0)
    files.write(batch(spark, record(3, FIRST + DAY)), 1)
    old = time.time() - 1000
    day = tmp_path / "batches" / f"{0:020d}" / "day=20240115"
    for name in os.listdir(day):
        os.utime(day / name, (old, old))
    assert files.roll(spark) == ["20240115"]
    assert seen(files, spark) == [(1, "20240115"), (2, "20240116"), (3, "20240116")]
    files.write(batch(spark, record(4, FIRST)), 2)  # late for the merged day
    assert seen(files, spark) == [(1, "20240115"), (2, "20240116"), (3, "20240116"), (4, "20240115")]
    assert files.expire(spark, -1) == []  # the batch has a day that is not merged


def test_large_day_and_unfinished_merge(spark, tmp_path):
    files = DayFiles(str(tmp_path), "at", file_bytes=2000)
    files.write(batch(spark, *[record(n, FIRST) for n in range(200)]), 0)
    assert files.roll(spark) == ["20240115"]
    whole = [(n, "20240115") for n in range(200)]
    assert seen(files, spark) == whole
    roll = tmp_path / "rolled" / os.listdir(tmp_path / "rolled")[0]
    (roll / "_SUCCESS").unlink()  # as if the job had been lost
    assert seen(files, spark) == whole
    assert files.folders(spark) == [f"{tmp_path}/batches/{0:020d}/day=20240115"]
    assert files.roll(spark) == ["20240115"] and seen(files, spark) == whole


def test_odd_records(spark, tmp_path):
    files = DayFiles(str(tmp_path), "at", idle=0)
    assert files.read(spark).count() == 0 and files.roll(spark) == [] and files.expire(spark, 0) == []
    rows = [(None,), ("",), ("{bad",), record(1, "none"), record(2, FIRST // 1000), record(2, FIRST // 1000)]
    files.write(batch(spark, *rows), 0)
    files.write(batch(spark), 1)
    expected = [(-1, "error_bucket")] * 3 + [(1, "error_bucket"), (2, "20240115"), (2, "20240115")]
    assert seen(files, spark) == sorted(expected)
    files.roll(spark)
    assert seen(files, spark) == sorted(expected)
    plain = DayFiles(f"{tmp_path}/plain", None, idle=0)
    plain.write(batch(spark, ("x",), ("y",)), 0)
    assert plain.roll(spark) == ["all"] and plain.read(spark).count() == 2
