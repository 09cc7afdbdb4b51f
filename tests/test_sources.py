"""Readers, headers, edits and overlap counts."""

import pytest
from conftest import stamp
from pyspark.sql import functions as F

from gustline.operators import quality as Q
from gustline.settings import FarmSettings
from gustline.sources import headers as B
from gustline.sources import readers as A


def test_headers_keep_the_largest_sensor_number():
    names = B.standard_names(["PCTimeStamp", "TB01_Ambient WindSpeed Avg. (1)", "TB01_Ambient WindSpeed Avg. (13)",
                              "TB02_Grid Production Power Avg.", "Some Note (x)."])
    assert names == {"PCTimeStamp": "timestamp", "TB01_Ambient WindSpeed Avg. (13)": "TB01_wind_speed",
                     "TB02_Grid Production Power Avg.": "TB02_power", "Some Note (x).": "some_note_x"}


def test_wide_and_back(spark, scada):
    long = scada(power=[1.0, 2.0], wind_speed=[3.0, None]).union(scada("TB02", power=[5.0, 6.0]))
    wide = B.long_to_wide(long, ["TB01", "TB02"])
    assert B.wide_to_long(wide).exceptAll(long).count() == 0


def test_first_file_wins(spark, tmp_path):
    a, b = f"{tmp_path}/a.csv", f"{tmp_path}/b.parquet"
    spark.createDataFrame([("2024-01-01 00:00:00", 1.0), ("bad", 9.0)], "ts string, power double").write.option("header", True).csv(a)
    spark.createDataFrame([(stamp(0), 7.0), (stamp(1), 8.0)], "ts timestamp_ntz, power double").write.parquet(b)
    got = {r.ts: r.power for r in A.read_all(spark, [b, a], ["ts"]).collect()}
    assert got == {stamp(0): 1.0, stamp(1): 8.0}


def test_weather_needs_its_columns(spark, tmp_path):
    path = f"{tmp_path}/w.csv"
    spark.createDataFrame([("2024-01-01", 60)], "timestamp string, lead_minutes int").write.option("header", True).csv(path)
    with pytest.raises(ValueError):
        A.load_weather(spark, path)


def test_edit_log(scada):
    df = scada(power=[1.0, 2.0])
    out, log = A.apply_edits(df, [
        {"condition_column": "ts", "condition_value": "2024-01-01 00:10:00", "target_column": "power", "new_value": 9.0},
        {"condition_column": "ts", "condition_value": "2030-01-01", "target_column": "power", "new_value": 0.0},
        {"condition_value": "2024-01-01", "target_column": "nope", "new_value": 0.0}])
    assert [r.power for r in out.orderBy("ts").collect()] == [1.0, 9.0]
    assert [r.applied for r in log.orderBy("edit").collect()] == [True, False, False]


def test_overlap_counts_equal_pairwise(spark):
    import random

    rng = random.Random(1)
    files = []
    for i in range(60):
        start = rng.randrange(0, 400)
        files.append((f"f{i}", stamp(start), stamp(start + rng.randrange(0, 30))))
    df = spark.createDataFrame(files, "file_name string, first_ts timestamp_ntz, last_ts timestamp_ntz")
    got = {r.file_name: r.overlapping_files for r in A.overlapping_windows(df).collect()}
    assert len(got) == 60
    for name, s, e in files:
        assert got[name] == sum(1 for n, s2, e2 in files if n != name and s <= e2 and s2 <= e)


def test_files_are_listed_and_hashed(spark, tmp_path):
    import hashlib

    path = tmp_path / "a.csv"
    path.write_text("ts,power\n2024-01-01 00:00:00,1\n2024-01-01 00:10:00,2\n")
    row = A.file_manifest(spark, [str(path)]).first()
    assert row.sha256 == hashlib.sha256(path.read_bytes()).hexdigest() and row.n_rows == 2
    assert [r.file_name for r in A.list_files(spark, str(tmp_path)).collect()] == ["a.csv"]


def test_swapped_days_are_repaired_only_inside_the_period(spark):
    rows = [("2021-05-03 10:00:00", "01.2021-02.2021"), ("2021-02-13 00:00:00", "01.2021-02.2021"),
            ("2021-05-06 00:00:00", "01.2021-06.2021"), ("2021-12-01 00:00:00", "01.2021-06.2021")]
    df = spark.createDataFrame(rows, "t string, name string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = [str(r.ts) for r in A.repair_swapped_days(df, F.col("name")).collect()]
    assert got == ["2021-05-03 10:00:00", "2021-02-13 00:00:00", "2021-05-06 00:00:00", "2021-01-12 00:00:00"]


def test_timestamp_checks_with_copies(spark, scada):
    df = scada(power=[1.0] * 10, skip=(4,))
    checks = Q.check_timestamps(df.union(df.limit(2)), FarmSettings()).first()
    assert (checks.n_rows, checks.duplicate_timestamps, checks.unusual_intervals) == (11, 2, 3)
    assert (checks.min_interval, checks.max_interval) == (0, 20)


def test_coverage_audit_counts_copies_once(spark, scada):
    df = scada(power=[1.0] * 6).select("ts")
    row = Q.coverage_audit(df.union(df.limit(2))).where("label = 'overall'").first()
    assert (row.n_rows, row.n_missing_timestamps, row.coverage_ratio) == (6, 0, 1.0)


def test_first_copy_inside_a_file_wins(spark, tmp_path):
    path = f"{tmp_path}/a.parquet"
    rows = [(stamp(0), None), (stamp(0), 3.0), (stamp(1), 9.0), (stamp(1), 2.0), (stamp(1), None)]
    spark.createDataFrame(rows, "ts timestamp_ntz, power double").coalesce(1).write.parquet(path)
    assert {r.ts: r.power for r in A.read_all(spark, [path], ["ts"]).collect()} == {stamp(0): None, stamp(1): 9.0}
    text = f"{tmp_path}/b.csv"
    (tmp_path / "b.csv").write_text("ts,power,note\n2024-01-01 00:00:00,,x\n2024-01-01 00:00:00,5,7\n2024-01-01 00:10:00,bad,1\n")
    got = A.read_all(spark, [text], ["ts"])
    assert dict(got.dtypes)["power"] == "double" and dict(got.dtypes)["note"] == "string"
    assert {r.ts: r.power for r in got.collect()} == {stamp(0): 5.0, stamp(1): None}


def test_targets_name_one_horizon(spark):
    rows = spark.createDataFrame([("a_target_1hour", "1hour"), ("b_target_1hour", "1hour"), ("b_target_1hour", "6hour")],
                                 "target string, horizon string")
    assert {r.target: r.status for r in Q.target_horizons(rows).collect()} == {"a_target_1hour": "PASS", "b_target_1hour": "FAIL"}


def test_digest_of_a_large_file_is_fed_in_pieces(spark, tmp_path):
    """3 GB, more than a binary value holds; the file is sparse, so it takes no room."""
    import hashlib

    large, small = tmp_path / "large.bin", tmp_path / "small file.bin"
    with open(large, "wb") as f:
        f.truncate(3 << 30)
        f.seek((3 << 30) - 3)
        f.write(b"end")
    small.write_bytes(b"few bytes")
    want, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range((3 << 10) - 1):
        want.update(zeros)
    want.update(zeros[:-3] + b"end")
    got = {r.file_name: (r.size_bytes, r.sha256) for r in A.file_digests(spark, [str(tmp_path)]).collect()}
    assert got == {"large.bin": (3 << 30, want.hexdigest()), "small file.bin": (9, hashlib.sha256(b"few bytes").hexdigest())}
