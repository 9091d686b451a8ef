"""Column operators: rescue, casts, headers, keys from file names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shedlake.contracts import CAMERA, KEY_PATTERNS, SOURCE_FILE
from shedlake.functions.columns import cast_contract, derive_keys, fit, split_quarantine
from shedlake.functions.headers import sanitize_headers
from shedlake.functions.rescue import rescue
from shedlake.plans.oracle import feeds
from shedlake.plans.registry import query
from shedlake.sources.derived import FIRST_DAY, load, reading_number


def text_rows(spark, sf_dir):
    """Events as a camera file might hold them: all text, and not all of it fit for the contract.

    Brightness is in hundredths and overflows its type for large readings, activity holds a word
    where a sensor failed, and the operational flag is a number of which only 0 and 1 are valid.
    """
    day = F.date_diff(F.to_date("ts"), F.lit(FIRST_DAY).cast("date")) + 1
    k = reading_number()
    return load(spark, sf_dir, "events").select(
        day.cast("string").alias("DAY"),
        F.hour("ts").cast("string").alias("HOUR"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("BRIGHTNESS"),
        F.when(F.col("event_type") == "error", F.col("event_type"))
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
        .alias("BIRD_ACTIVITY"),
        k.alias("SOUND_LEVEL"),
        k.alias("CAMERA_OPERATIONAL"),
        "event_type",
        "props",
    )


TEXT = """
text_rows AS (
  SELECT CAST(DAY AS VARCHAR) AS DAY, CAST(HOUR AS VARCHAR) AS HOUR,
         CAST(CAST(round(e.value * 100) AS BIGINT) AS VARCHAR) AS BRIGHTNESS,
         CASE WHEN site.event_type = 'error' THEN 'error' ELSE CAST(CAST(e.value AS DECIMAL(12,2)) AS VARCHAR) END
           AS BIRD_ACTIVITY,
         CAST(k AS VARCHAR) AS SOUND_LEVEL, CAST(k AS VARCHAR) AS CAMERA_OPERATIONAL,
         site.event_type, e.props
  FROM site JOIN events e USING (event_id))"""


def _json_part(column: str, shown: str | None = None) -> str:
    return f"""'"{column}":"' || {shown or column} || '"'"""


def _unless(fits: str, column: str) -> str:
    return f"CASE WHEN NOT ({fits}) THEN {_json_part(column)} END"


BRIGHTNESS_FITS = "TRY_CAST(BRIGHTNESS AS DECIMAL(6,2)) IS NOT NULL"
ACTIVITY_FITS = "event_type <> 'error'"
FLAG_FITS = "CAMERA_OPERATIONAL IN ('0', '1')"
BAD = [
    _unless(BRIGHTNESS_FITS, "BRIGHTNESS"),
    _unless(ACTIVITY_FITS, "BIRD_ACTIVITY"),
    _unless(FLAG_FITS, "CAMERA_OPERATIONAL"),
]
UNKNOWN = [_json_part("event_type"), _json_part("props", """replace(props, '"', '\\"')""")]


def _rescued(parts: list[str]) -> str:
    return f"'{{' || nullif(concat_ws(',', {', '.join(parts)}), '') || '}}' AS _rescued_data"


FITTING = f"""DAY, HOUR, CASE WHEN {BRIGHTNESS_FITS} THEN BRIGHTNESS END AS BRIGHTNESS,
  CASE WHEN {ACTIVITY_FITS} THEN BIRD_ACTIVITY END AS BIRD_ACTIVITY, SOUND_LEVEL,
  CASE WHEN {FLAG_FITS} THEN CAMERA_OPERATIONAL END AS CAMERA_OPERATIONAL"""


def text_sql(select: str) -> str:
    return feeds("").rstrip() + "," + TEXT + "\n" + select


@query(text_sql(f"SELECT {FITTING}, {_rescued(BAD)} FROM text_rows"))
def rescue_bad_values(spark, sf_dir):
    return rescue(text_rows(spark, sf_dir).drop("event_type", "props"), CAMERA)


@query(text_sql(f"SELECT {FITTING}, {_rescued(BAD + UNKNOWN)} FROM text_rows"))
def rescue_unknown_columns(spark, sf_dir):
    """Two columns outside the contract travel in the rescue column with the values that do not fit."""
    return rescue(text_rows(spark, sf_dir), CAMERA)


@query(text_sql(f"""
SELECT CAST(DAY AS SMALLINT) AS DAY, CAST(HOUR AS SMALLINT) AS HOUR,
       TRY_CAST(BRIGHTNESS AS DECIMAL(6,2)) AS BRIGHTNESS,
       CASE WHEN {ACTIVITY_FITS} THEN TRY_CAST(BIRD_ACTIVITY AS DECIMAL(6,2)) END AS BIRD_ACTIVITY,
       CAST(SOUND_LEVEL AS DECIMAL(6,2)) AS SOUND_LEVEL,
       CASE CAMERA_OPERATIONAL WHEN '1' THEN true WHEN '0' THEN false END AS CAMERA_OPERATIONAL
FROM text_rows"""), name="cast_contract")
def cast_text_rows(spark, sf_dir):
    return cast_contract(text_rows(spark, sf_dir), CAMERA)


def flag(column: str) -> str:
    return (
        f"CASE WHEN lower({column}) IN ('t', 'true', 'y', 'yes', '1') THEN true "
        f"WHEN lower({column}) IN ('f', 'false', 'n', 'no', '0') THEN false END AS {column}"
    )


@query(f"""
SELECT l_orderkey, {flag('l_returnflag')}, {flag('l_linestatus')},
       {flag('l_linenumber')}
FROM (SELECT l_orderkey, l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem)""")
def cast_boolean(spark, sf_dir):
    """Letters and digits as booleans: some spell one, the others become null."""
    lines = load(spark, sf_dir, "lineitem")
    texts = lines.select("l_orderkey", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    return texts.select("l_orderkey", *(fit(texts, c, T.BooleanType()).alias(c) for c in texts.columns[1:]))


@query("""
SELECT event_id, event_type AS event_type, value AS Weight__g, value / 1000 AS Weight_kg, user_id AS Bird_count
FROM events""", name="sanitize_headers")
def sanitize_event_headers(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return sanitize_headers(
        events.select(
            "event_id",
            "event_type",
            F.col("value").alias("Weight (g)"),
            (F.col("value") / 1000).alias("Weight(kg)"),
            F.col("user_id").alias("Bird count"),
        )
    )


# File names of three shapes: farm and shed, farm alone, and neither.
FILE_NAME = """CASE event_type
  WHEN 'click' THEN 'Synthetic_Poultry_' || user_id || '.csv'
  WHEN 'view' THEN 'Camera_Farm_' || user_id || '.csv'
  ELSE 'Camera_Farm_' || user_id || '_Shed_' || event_id || '_Farm_0.csv' END"""


def named_rows(spark, sf_dir):
    def joined(*parts):
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    name = (
        F.when(F.col("event_type") == "click", joined("Synthetic_Poultry_", user, ".csv"))
        .when(F.col("event_type") == "view", joined("Camera_Farm_", user, ".csv"))
        .otherwise(joined("Camera_Farm_", user, "_Shed_", event, "_Farm_0.csv"))
    )
    return load(spark, sf_dir, "events").select("event_id", name.alias(SOURCE_FILE))


KEYED = f"""
SELECT event_id, {FILE_NAME} AS _source_file_name,
       CASE WHEN event_type <> 'click' THEN CAST(user_id AS INTEGER) END AS FARM_NO,
       CASE WHEN event_type NOT IN ('click', 'view') THEN CAST(event_id AS INTEGER) END AS SHED_NO
FROM events"""


@query(KEYED)
def derive_keys_from_filename(spark, sf_dir):
    return derive_keys(named_rows(spark, sf_dir), KEY_PATTERNS)


@query(f"SELECT * FROM ({KEYED}) WHERE FARM_NO IS NULL OR SHED_NO IS NULL")
def quarantine_unkeyed(spark, sf_dir):
    """Rows whose file name does not give a complete key."""
    return split_quarantine(derive_keys(named_rows(spark, sf_dir), KEY_PATTERNS), list(KEY_PATTERNS))[1]
