import json
import os
from functools import reduce

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.classic.dataframe import DataFrame

from shedlake.contracts import CAMERA, ENVIRONMENTAL
from shedlake.functions.columns import fitted
from shedlake.sources import landing
from shedlake.sources.landing import HeaderBook, header_groups, header_mismatch, header_names, infer_feed_schema, read_files

HEADER = "DAY,HOUR,BRIGHTNESS,BIRD_ACTIVITY,SOUND_LEVEL,CAMERA_OPERATIONAL\n"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as file:
        file.write(text)
    return path


def test_files_are_grouped_by_header(spark, scratch):
    a = put(scratch, "a.csv", "DAY,HOUR\n1,2\n")
    b = put(scratch, "b.csv", "DAY,HOUR\n")
    c = put(scratch, "c.csv", "HOUR,DAY\n2,1\n")
    empty = put(scratch, "d.csv", "")
    assert header_groups(spark, [a, b, c, empty]) == {("DAY", "HOUR"): [a, b], ("HOUR", "DAY"): [c]}


def test_reordered_and_extra_headers(spark, scratch):
    paths = [
        put(scratch, "Environmental_Farm_1_Shed_1.csv", "DAY,HOUR,temperature,humidity\n1,2,20.5,60\n"),
        put(scratch, "Environmental_Farm_1_Shed_2.csv", "humidity,Temperature,HOUR,DAY,CO2\n61,21.5,3,1,400\n"),
    ]
    rows = {r._source_file_name: r for r in read_files(spark, paths, ENVIRONMENTAL).collect()}
    first, second = rows["Environmental_Farm_1_Shed_1.csv"], rows["Environmental_Farm_1_Shed_2.csv"]
    assert (first.DAY, first.HOUR, first.temperature, first.humidity) == ("1", "2", "20.5", "60")
    assert (second.DAY, second.HOUR, second.temperature, second.humidity) == ("1", "3", "21.5", "61")
    assert first._rescued_data is None
    assert json.loads(second._rescued_data) == {"CO2": "400"}


def test_record_longer_than_its_header_keeps_the_whole_line(spark, scratch):
    path = put(scratch, "Camera_Farm_1_Shed_1.csv", HEADER + "1,2,3,4,5,true\n1,3,3,4,5,true,surplus\n1,4,3\n")
    rows = {r.HOUR: r for r in read_files(spark, [path], CAMERA).collect()}
    assert rows["2"]._rescued_data is None
    assert json.loads(rows["3"]._rescued_data) == {"_corrupt_record": "1,3,3,4,5,true,surplus"}
    assert rows["4"]._rescued_data is None and rows["4"].SOUND_LEVEL is None


def test_file_names_with_glob_characters_are_taken_literally(spark, scratch):
    odd = put(scratch, "Camera_Farm_1_Shed_[12].csv", HEADER + "1,1,1,1,1,true\n")
    put(scratch, "Camera_Farm_1_Shed_1.csv", HEADER + "2,2,2,2,2,true\n")
    assert [r.DAY for r in read_files(spark, [odd], CAMERA).collect()] == ["1"]


def test_quoted_values(spark, scratch):
    path = put(scratch, "Camera_Farm_1_Shed_1.csv", HEADER + '1,2,"3","1,5",5,true\n')
    row = read_files(spark, [path], CAMERA).first()
    assert row.BRIGHTNESS == "3" and json.loads(row._rescued_data) == {"BIRD_ACTIVITY": "1,5"}


def test_inferred_types(spark, scratch):
    put(scratch, "Camera_Farm_1_Shed_1.csv", HEADER + "1,2,3.5,4,,true\n1,3,3,bad,5,false\n")
    put(scratch, "Other.csv", "DAY\nnot a number\n")
    found = {r.column_name: (r.inferred_type, r.filled) for r in infer_feed_schema(spark, scratch, CAMERA.glob).collect()}
    assert found == {
        "DAY": ("int", 2), "HOUR": ("int", 2), "BRIGHTNESS": ("double", 2), "BIRD_ACTIVITY": ("string", 2),
        "SOUND_LEVEL": ("int", 1), "CAMERA_OPERATIONAL": ("boolean", 2),
    }


def test_inferred_types_of_files_whose_headers_differ(spark, scratch):
    put(scratch, "Camera_Farm_1_Shed_1.csv", "DAY,HOUR,SOUND_LEVEL\n1,2,3.5\n")
    put(scratch, "Camera_Farm_1_Shed_2.csv", "SOUND_LEVEL,DAY,HOUR,EXTRA\n4.5,1,3,word\n,1,3,word\n")
    found = {r.column_name: (r.inferred_type, r.filled) for r in infer_feed_schema(spark, scratch, CAMERA.glob).collect()}
    assert found == {"DAY": ("int", 3), "HOUR": ("int", 3), "SOUND_LEVEL": ("double", 2), "EXTRA": ("string", 2)}


def test_inferred_type_is_the_narrowest_of_all_files(spark, scratch):
    """Decimals and dates too; what fits only in some files widens the type, columns without values are text."""
    put(scratch, "Camera_Farm_1_Shed_1.csv", "A,B,C,D,E,F,G,H\n1,5000000000,12345678901234567890,1.5,2024-01-02,2024-01-02,yes,\n")
    put(f"{scratch}/deep", "Camera_Farm_1_Shed_2.csv", "\n\nH,G,F,E,D,C,B,A\n,1,2024-01-02 10:00:00,2024-2-3,7,-00000000000000000000009,3,2\n")
    put(scratch, "Camera_Farm_1_Shed_3.csv", "A,Only\n3,3,surplus\n")
    put(scratch, "Camera_Farm_1_Shed_4.csv", "Late\n")
    put(scratch, "Camera_Farm_1_Shed_5.csv", "")
    found = [tuple(r) for r in infer_feed_schema(spark, scratch, CAMERA.glob).orderBy("position").collect()]
    assert found == [
        (0, "A", "int", 3), (1, "B", "bigint", 2), (2, "C", "decimal(20,0)", 2), (3, "D", "double", 2), (4, "E", "date", 2),
        (5, "F", "timestamp", 2), (6, "G", "boolean", 2), (7, "H", "string", 0), (8, "Only", "int", 1), (9, "Late", "string", 0),
    ]


def test_inference_of_an_empty_folder(spark, scratch):
    put(scratch, "Other.csv", "DAY\n1\n")
    assert infer_feed_schema(spark, scratch, CAMERA.glob).count() == 0


def test_inference_brings_no_path_to_the_driver(spark, scratch, monkeypatch):
    """What is collected are the headers that differ, however many files there are."""
    for n in range(50):
        put(scratch, f"Camera_Farm_1_Shed_{n}.csv", f"DAY,C{n % 2}\n{n},2.5\n")
    brought, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: brought.append(collect(df)) or brought[-1])
    frame = infer_feed_schema(spark, scratch, CAMERA.glob)
    assert [len(rows) for rows in brought] == [2]
    assert sorted((r.column_name, r.filled) for r in collect(frame)) == [("C0", 25), ("C1", 25), ("DAY", 50)]


@pytest.mark.parametrize("odd", ["a`b", "_corrupt_record", "a.b", "x y", "`", "_rescued_data"])
def test_odd_headers_are_rescued(spark, scratch, odd):
    path = put(scratch, "Camera_Farm_1_Shed_1.csv", f"DAY,HOUR,{odd}\n1,2,mine\n")
    row = read_files(spark, [path], CAMERA).first()
    assert (row.DAY, row.HOUR) == ("1", "2")
    assert list(json.loads(row._rescued_data).values()) == ["mine"]


def test_header_names():
    assert header_names('a,"b,c",,A, d ') == ("a0", "b,c", "_c2", "A3", "d")
    assert header_names("\ufeffDAY,HOUR") == ("DAY", "HOUR")


def test_no_job_finds_the_headers_of_many_files(spark, scratch):
    paths = [put(scratch, f"file {n}%20.csv", f"DAY,HOUR,C{n % 2}\n1,2,3\n") for n in range(60)]
    spark.sparkContext.setJobGroup("headers", "")
    groups = header_groups(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(len, groups.values())) == [30, 30] and len(jobs) == 0


def test_first_lines_are_found_below_blank_ones_and_in_compressed_files(spark, scratch):
    import gzip

    blank = put(scratch, "blank.csv", "\n  \nDAY,HOUR\n1,2\n")
    packed = f"{scratch}/packed.csv.gz"
    with gzip.open(packed, "wt") as file:
        file.write("DAY,H\u00d6HE\n1,2\n")
    assert header_groups(spark, [blank, packed, put(scratch, "none.csv", " \n")]) == {("DAY", "HOUR"): [blank], ("DAY", "H\u00d6HE"): [packed]}


def test_a_checked_scan_refuses_other_headers(spark, scratch):
    same = put(scratch, "Camera_Farm_1_Shed_1.csv", "DAY,HOUR\n1,2\n")
    for n, other in enumerate(("HOUR,DAY\n1,2\n", "DAY\n1\n", "DAY,HOUR,X\n1,2,3\n")):
        path = put(scratch, f"Camera_Farm_2_Shed_{n}.csv", other)
        rows = read_files(spark, [], CAMERA, groups={("DAY", "HOUR"): [same, path]}, checked=True)
        with pytest.raises(Exception) as failure:
            rows.collect()
        assert header_mismatch(failure.value)
    assert read_files(spark, [], CAMERA, groups={("DAY", "HOUR"): [same]}, checked=True).first().HOUR == "2"


def test_headers_are_kept_with_the_stream(spark, scratch):
    book = HeaderBook(spark, f"{scratch}/headers")
    assert book.expected() is None
    book.learn([("DAY", "a \u00fc")], 0)
    assert HeaderBook(spark, f"{scratch}/headers").expected() == ("DAY", "a \u00fc")
    book.learn([("DAY", "a \u00fc")], 1)
    book.learn([("HOUR",), ("DAY", "a \u00fc")], 2)
    again = HeaderBook(spark, f"{scratch}/headers")
    assert again.known == {("DAY", "a \u00fc"), ("HOUR",)} and again.expected() is None
    for odd in ((" DAY",), ("_rescued_data",)):
        book = HeaderBook(spark, f"{scratch}/{odd[0].strip()}")
        book.learn([odd], 0)
        assert book.expected() is None


def test_no_files_give_an_empty_bronze_frame(spark):
    rows = read_files(spark, [], CAMERA)
    assert rows.count() == 0 and rows.schema == CAMERA.bronze_schema()


def test_header_named_like_an_operational_column_is_rescued(spark, scratch):
    path = put(scratch, "Camera_Farm_1_Shed_1.csv", "DAY,HOUR,_source_file_name\n1,2,mine\n")
    row = read_files(spark, [path], CAMERA).first()
    assert row._source_file_name == "Camera_Farm_1_Shed_1.csv"
    assert json.loads(row._rescued_data) == {"_source_file_name_in_file": "mine"}


def test_looks_decide_nothing_that_a_cast_decides_otherwise(spark):
    """A cell has the types that plain casts give it, which are tried only where it looks like one."""
    cells = [
        "", " ", "0", "+0", "-", ".", "1.", ".5", "1e5", "1e", "1d", "NaN", "-nan", "inf", "-Infinity", "0x1p3", "0x1", "1L",
        "2147483647", "2147483648", "-2147483649", "9223372036854775808", "-9223372036854775808", "0" * 30 + "12", "9" * 25,
        "2024", "294247", "294248", "300000", "-2024", "2024-1", "2024-01-01", "2024-13-01", "2024-01-01 10:30:00", "T10:30",
        " T10:30", "10:30", "123:00", "+12345-01-01", "\x7f12\x7f", "\x7f1.5", "\x1f1.5\x1f", "2024\n", "１２", "yes", "on hold",
    ]
    plain = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}
    value, places = F.col("value"), {kind: 1 << i for i, kind in enumerate(landing.INFERRED_TYPES)}
    casts = [F.when(fitted(value, t).isNotNull(), F.lit(places[kind])).otherwise(F.lit(0)) for kind, t in plain.items()]
    wanted = reduce(lambda a, b: a + b, casts)
    found = landing._fitting_types(value).bitwiseAND(sum(places[kind] for kind in plain))
    rows = spark.createDataFrame([(c,) for c in cells], "value string").select("value", wanted.alias("w"), found.alias("f"))
    assert [tuple(r) for r in rows.where("w != f").collect()] == []
    looks = {"int": landing.LIKE_LONG, "double": landing.LIKE_DOUBLE, "timestamp": landing.LIKE_TIME}
    for kind, pattern in looks.items():  # common misfits are not cast at all
        misfits = [c for c in ("on hold", "1.125", "2024-01-01", "9" * 25) if (kind, c) not in (("double", "1.125"), ("double", "9" * 25), ("timestamp", "2024-01-01"))]
        assert spark.createDataFrame([(c,) for c in misfits], "value string").where(value.rlike(pattern)).count() == 0


def test_mixed_headers_of_words_dates_and_times(spark, scratch):
    """Cells that look like several types keep those that all of a column's cells have, under any header."""
    os.makedirs(scratch)
    with open(f"{scratch}/Camera_Farm_1_Shed_1_Period_0.csv", "w") as f:
        f.write("A,B,C\n2024,12,2024-01-01\n1999,1e3,10:30\n")
    with open(f"{scratch}/Camera_Farm_1_Shed_1_Period_1.csv", "w") as f:
        f.write("Vet,C,B,A\nnone,2024-01-01 10:30:00,nan,2024-05\n,,,\n")
    found = {r.column_name: (r.inferred_type, r.filled) for r in infer_feed_schema(spark, scratch, CAMERA.glob).collect()}
    assert found == {"A": ("timestamp", 3), "B": ("double", 3), "C": ("timestamp", 3), "Vet": ("string", 1)}


def test_plain_numbers_and_words_have_types_by_their_looks_alone(spark, monkeypatch):
    """No pattern of a type is tried on them, and they have the types that the patterns and casts give."""
    cells = ["0", "1", "7", "007", "123456789", "999999999", "2147483647", "2147483648", "5000000123", "9" * 18, "0" * 18, "1.5", "0.0", "12.", "2024.5",
             "none", "true", "No", "on hold", "N", "Tuesday", "\u00fcber", "~", "_", "1\n", "1.5\n", "2024", "0000", "294248", "Infinity", "nan", "inf ", "T1:02", "T"]
    value = F.col("value")
    rows = spark.createDataFrame([(c,) for c in cells], "value string")

    def names(types):
        return {r.value: {k for i, k in enumerate(landing.INFERRED_TYPES) if r.types >> i & 1} for r in rows.select("value", types.alias("types")).collect()}

    found = names(landing._fitting_types(value))
    kinds = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}
    for r in rows.select("value", *(fitted(value, t).isNotNull().alias(k) for k, t in kinds.items())).collect():
        assert found[r.value] - {"decimal", "date"} == {k for k in kinds if r[k]}, r.value
        assert ("decimal" in found[r.value]) == r.value.strip().isdecimal() and "date" not in found[r.value]
    for pattern in ("LIKE_LONG", "LIKE_DOUBLE", "WHOLE_NUMBER", "PLAIN_DATE", "LIKE_TIME"):
        monkeypatch.setattr(landing, pattern, "(?!)")
    alone = names(landing._fitting_types(value))
    assert {c: alone[c] for c in cells[:11]} == {c: found[c] for c in cells[:11]}
    assert {c: alone[c] for c in ("1.5", "0.0", "2024.5", "none", "true", "on hold")} == {c: found[c] for c in ("1.5", "0.0", "2024.5", "none", "true", "on hold")}


def test_digits_of_decimals_are_counted_without_signs_and_leading_zeros(spark, scratch):
    long = "1" + "0" * 20
    put(scratch, "Camera_Farm_1_Shed_1.csv", f"A,B,C\n{long},+00{long},0\n7,007,-000{long}1\n")
    found = {r.column_name: r.inferred_type for r in infer_feed_schema(spark, scratch, CAMERA.glob).collect()}
    assert found == {"A": "decimal(21,0)", "B": "decimal(21,0)", "C": "decimal(22,0)"}


def test_inference_scans_a_folder_twice(spark, scratch):
    """Once for the headers, which are stored, and once for the cells."""
    put(scratch, "Camera_Farm_1_Shed_1.csv", "DAY,HOUR\n1,2\n")
    put(scratch, "Camera_Farm_1_Shed_2.csv", "HOUR,Vet,DAY\n1,none,2\n")
    plan = infer_feed_schema(spark, scratch, CAMERA.glob)._jdf.queryExecution().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan
