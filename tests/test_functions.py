import json
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import CAMERA, ENVIRONMENTAL, FEEDS, SYNTHETIC
from shedlake.functions.columns import fit
from shedlake.functions import (
    cast_contract,
    clean_header,
    decimals_to_double,
    derive_keys,
    rescue,
    sanitize_headers,
    split_quarantine,
    standardize,
)

CAMERA_TEXT = "DAY string, HOUR string, BRIGHTNESS string, BIRD_ACTIVITY string, SOUND_LEVEL string, CAMERA_OPERATIONAL string"


@pytest.mark.parametrize(
    "raw, clean", [("Weight(g)", "Weight_g"), ("Weight (g)", "Weight__g"), ("Day", "Day"), ("a b", "a_b")]
)
def test_clean_header(raw, clean):
    assert clean_header(raw) == clean


def test_colliding_headers_are_an_error(spark):
    with pytest.raises(ValueError, match="a_b"):
        sanitize_headers(spark.createDataFrame([(1, 2)], ["a b", "a(b"]))


def test_contract_accepts_both_spellings_of_the_weight_header(spark):
    for header in ("Weight_g", "Weight__g", "WEIGHT_G"):
        rows = cast_contract(spark.createDataFrame([("3", "12.345")], f"Day string, {header} string"), SYNTHETIC)
        assert [tuple(r) for r in rows.collect()] == [(3, Decimal("12.35"))]
        assert rows.columns == ["DAY", "WEIGHT_GM"]


def test_values_that_do_not_fit_become_null(spark):
    rows = spark.createDataFrame(
        [("40000", "", "12345.678", "bad", "12.345", "maybe"), ("1", "23", "9999.99", "-5", "0.005", "Yes")], CAMERA_TEXT
    )
    assert [tuple(r) for r in cast_contract(rows, CAMERA).collect()] == [
        (None, None, None, None, Decimal("12.35"), None),
        (1, 23, Decimal("9999.99"), Decimal("-5.00"), Decimal("0.01"), True),
    ]


@pytest.mark.parametrize("text, flag", [("1", True), ("0", False), ("Yes", True), ("TRUE", True), ("1.0", None), ("maybe", None)])
def test_booleans(spark, text, flag):
    rows = spark.createDataFrame([("1", "1", "1", "1", "1", text)], CAMERA_TEXT)
    assert cast_contract(rows, CAMERA).first().CAMERA_OPERATIONAL is flag


def test_rename_leaves_its_source_and_case_change_does_not(spark):
    raw = spark.createDataFrame([("1", "2", "20.5", "60", "x")], "DAY string, HOUR string, temperature string, humidity string, extra string")
    assert cast_contract(raw, ENVIRONMENTAL).columns == ["DAY", "HOUR", "TEMPRATURE", "HUMIDITY"]
    kept = cast_contract(raw, ENVIRONMENTAL, keep_source_columns=True)
    assert kept.columns == ["DAY", "HOUR", "TEMPRATURE", "HUMIDITY", "temperature", "extra"]


def test_rescue_keeps_every_value_it_takes_away(spark):
    raw = spark.createDataFrame(
        [("1", "2", "3", "bad", "5", "maybe", "new"), ("1", "2", "3", "4", "5", "0", None)], CAMERA_TEXT + ", Lux string"
    )
    bad, good = rescue(raw, CAMERA).collect()
    assert json.loads(bad._rescued_data) == {"BIRD_ACTIVITY": "bad", "CAMERA_OPERATIONAL": "maybe", "Lux": "new"}
    assert bad.BIRD_ACTIVITY is None and bad.BRIGHTNESS == "3"
    assert good._rescued_data is None and good.CAMERA_OPERATIONAL == "0"


def test_rescue_fills_columns_that_a_file_lacks(spark):
    rows = rescue(spark.createDataFrame([("1",)], "DAY string"), CAMERA)
    assert rows.columns == [*(c.name for c in CAMERA.columns), "_rescued_data"]
    assert rows.first().HOUR is None and rows.first()._rescued_data is None


@pytest.mark.parametrize(
    "name, keys",
    [
        ("Camera_Farm_12_Shed_3.csv", (12, 3)),
        ("Synthetic_Poultry_7.csv", (None, None)),
        ("Farm_1_Farm_2_Shed_4_Shed_5.csv", (1, 4)),
        ("Farm_99999999999_Shed_1.csv", (None, 1)),
    ],
)
def test_keys_from_file_name(spark, name, keys):
    rows = spark.createDataFrame([(name,)], "_source_file_name string")
    assert tuple(derive_keys(rows, CAMERA.key_patterns).select("FARM_NO", "SHED_NO").first()) == keys


def test_quarantine_takes_exactly_the_rows_with_a_null_key(spark):
    rows = spark.createDataFrame([(1, 1), (None, 1), (1, None), (None, None)], "a int, b int")
    good, bad = split_quarantine(rows, ["a", "b"])
    assert (good.count(), bad.count()) == (1, 3)


@pytest.mark.parametrize("feed", list(FEEDS))
@pytest.mark.parametrize("keep", [False, True])
def test_standardize_gives_the_declared_schema(spark, feed, keep):
    contract = FEEDS[feed]
    empty = spark.createDataFrame([], contract.bronze_schema())
    declared = contract.standard_schema(keep)
    assert standardize(empty, contract, keep).schema.simpleString() == declared.simpleString()


def test_decimals_to_double_leaves_other_types(spark):
    rows = spark.range(1).select(F.lit("1.25").cast("decimal(10,6)").alias("a"), F.lit(1).alias("b"), F.lit("x").alias("c"))
    assert decimals_to_double(rows).dtypes == [("a", "double"), ("b", "int"), ("c", "string")]
    assert tuple(decimals_to_double(rows).first()) == (1.25, 1, "x")


def test_strict_casts_fail_on_what_they_would_lose(spark):
    good = spark.createDataFrame([("1", None, "3", "4", "5", "1")], CAMERA_TEXT)
    assert tuple(cast_contract(good, CAMERA, strict=True).first())[:2] == (1, None)
    bad = spark.createDataFrame([("1", "2", "12345.678", "4", "5", "1")], CAMERA_TEXT)
    with pytest.raises(PySparkException, match="BRIGHTNESS is not a decimal"):
        cast_contract(bad, CAMERA, strict=True).collect()


ODD_TEXTS = [
    "1", " 1 ", "+1", "-1", "1.", ".5", "1e2", "1E-2", "0x1", "", " ", "\t7\n", "\x7f7", "007", "32767", "32768", "99999",
    "2147483648", "1_000", "--1", "-", "+", ".", "e5", "NaN", "Infinity", "bad", "N/A", "t", "T", "true ", " TRUE",
    "yes", "Yes", "y", "no", "n", "f", "false", "falsey", "on", "1.0", "0", "10", "\u0663", "9999.99", "9999.995", "#REF!",
    "12345.678", "cam-7", "2024-02-30", "2024-02-29", "2024-02-29 10:00:00", "1,5", "\u00a01", "truefalse", "none",
]


KINDS = [T.ShortType(), T.IntegerType(), T.LongType(), T.DecimalType(6, 2), T.BooleanType(), T.StringType(), T.DoubleType(), T.FloatType(), T.DateType(), T.TimestampType(), T.BinaryType()]


@pytest.mark.parametrize("kind", KINDS, ids=lambda k: k.simpleString())
def test_fit_is_a_try_cast(spark, kind):
    texts = spark.createDataFrame([(t,) for t in ODD_TEXTS], "t string")
    wrong = texts.where(~fit(texts, "t", kind).eqNullSafe(F.col("t").try_cast(kind)))
    assert [r.t for r in wrong.collect()] == []


def test_columns_pass_through_to_the_standard_rows(spark):
    contract = replace(CAMERA, pass_through=("Batch", "Gone"))
    df = spark.createDataFrame([("1", "2", "3", "b7", "x")], "DAY string, HOUR string, SOUND_LEVEL string, BATCH string, other string")
    df = df.withColumn("_processing_timestamp", F.current_timestamp()).withColumn("_source_file_name", F.lit("Camera_Farm_1_Shed_1.csv"))
    bronze = rescue(df, contract)
    assert bronze.schema.names == contract.bronze_schema().names
    row = standardize(bronze, contract).first()
    assert (row.Batch, row.Gone) == ("b7", None) and json.loads(row._rescued_data) == {"other": "x"}
    assert standardize(bronze, contract, True).schema.names == contract.standard_schema(True).names
