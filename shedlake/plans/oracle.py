"""SQL building blocks of the oracles: the derived feeds and their folds, written for DuckDB."""

SITE = """
site AS (
  SELECT event_id, event_type, ts, user_id,
         CAST(user_id % 4 AS INTEGER) AS FARM_NO,
         CAST((user_id // 4) % 2 AS INTEGER) AS SHED_NO,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS SMALLINT) AS DAY,
         CAST(hour(ts) AS SMALLINT) AS HOUR,
         TRY_CAST(value AS DECIMAL(6,2)) AS v,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
camera AS (
  SELECT event_id, ts, FARM_NO, SHED_NO, DAY, HOUR,
         CAST(100 - k AS DECIMAL(6,2)) AS BRIGHTNESS,
         CASE WHEN event_type <> 'view' THEN v END AS BIRD_ACTIVITY,
         CASE WHEN event_type <> 'click' THEN CAST(k AS DECIMAL(6,2)) END AS SOUND_LEVEL,
         k >= 50 AS CAMERA_OPERATIONAL
  FROM site WHERE event_type IN ('click', 'view', 'purchase')),
environmental AS (
  SELECT event_id, ts, FARM_NO, SHED_NO, DAY, HOUR, v AS TEMPRATURE,
         CASE WHEN event_type = 'error' THEN CAST(k AS DECIMAL(6,2)) END AS HUMIDITY
  FROM site WHERE event_type IN ('signup', 'error')),
synthetic AS (
  SELECT event_id, ts, FARM_NO, SHED_NO, DAY, v AS WEIGHT_GM
  FROM site WHERE event_type = 'purchase')"""


def last_value(column: str, order: str = "event_id") -> str:
    return f"arg_max({column}, {order}) FILTER (WHERE {column} IS NOT NULL) AS {column}"


CAMERA_VALUES = ("BRIGHTNESS", "BIRD_ACTIVITY", "SOUND_LEVEL", "CAMERA_OPERATIONAL")
ENVIRONMENTAL_VALUES = ("TEMPRATURE", "HUMIDITY")
HOURLY = "FARM_NO, SHED_NO, DAY, HOUR"
DAILY = "FARM_NO, SHED_NO, DAY"


def fold(source: str, keys: str, values: tuple[str, ...]) -> str:
    return f"SELECT {keys}, {', '.join(last_value(v) for v in values)} FROM {source} GROUP BY {keys}"


def tied_fold(source: str, keys: str, values: tuple[str, ...]) -> str:
    """Fold when every change of a key has the same time: the greatest value of each column decides."""
    return f"SELECT {keys}, {', '.join(f'max({v}) AS {v}' for v in values)} FROM {source} GROUP BY {keys}"


def silver_ctes(folder=fold) -> str:
    return f"""{SITE},
silver_camera AS ({folder('camera', HOURLY, CAMERA_VALUES)}),
silver_environmental AS ({folder('environmental', HOURLY, ENVIRONMENTAL_VALUES)}),
silver_synthetic AS ({folder('synthetic', DAILY, ('WEIGHT_GM',))})"""


def gold_ctes(folder=fold) -> str:
    return f"""{silver_ctes(folder)},
hourly AS (
  SELECT e.DAY, e.HOUR, e.FARM_NO, e.SHED_NO, c.BIRD_ACTIVITY, c.SOUND_LEVEL, e.TEMPRATURE, e.HUMIDITY
  FROM silver_environmental e JOIN silver_camera c USING (FARM_NO, SHED_NO, DAY, HOUR)),
daily AS (
  SELECT FARM_NO, SHED_NO, DAY,
         CAST(AVG(BIRD_ACTIVITY) AS DECIMAL(10,6)) AS AVG_BIRD_ACTIVITY,
         CAST(AVG(SOUND_LEVEL) AS DECIMAL(10,6)) AS AVG_SOUND_LEVEL,
         CAST(AVG(TEMPRATURE) AS DECIMAL(10,6)) AS AVG_TEMPRATURE,
         CAST(AVG(HUMIDITY) AS DECIMAL(10,6)) AS AVG_HUMIDITY
  FROM hourly GROUP BY FARM_NO, SHED_NO, DAY)"""


def feeds(select: str) -> str:
    return f"WITH {SITE}\n{select}"


def silver(select: str) -> str:
    return f"WITH {silver_ctes()}\n{select}"


def gold(select: str) -> str:
    return f"WITH {gold_ctes()}\n{select}"


def landed_silver(select: str) -> str:
    return f"WITH {silver_ctes(tied_fold)}\n{select}"


def landed_gold(select: str) -> str:
    return f"WITH {gold_ctes(tied_fold)}\n{select}"
