"""Feed contracts: what each landing feed must look like once it is in silver."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

PROCESSING_TIME = "_processing_timestamp"
SOURCE_FILE = "_source_file_name"
RESCUED = "_rescued_data"
OPERATIONAL = (PROCESSING_TIME, SOURCE_FILE, RESCUED)


@dataclass(frozen=True)
class ColumnRule:
    """One silver column: its type and the (sanitised) headers it may arrive under."""

    name: str
    type: T.DataType
    sources: tuple[str, ...] = ()

    @property
    def accepted(self) -> tuple[str, ...]:
        return self.sources or (self.name,)

    @property
    def raw_name(self) -> str:
        """Name of the column in bronze, where it still holds the text of the file."""
        return self.accepted[0]

    @property
    def leaves_source_behind(self) -> bool:
        """A rename keeps its source column; a case change replaces it."""
        return self.raw_name.lower() != self.name.lower()

    def pick(self, columns: Iterable[str]) -> str | None:
        """The first accepted header present in ``columns``, ignoring letter case."""
        by_lower = {c.lower(): c for c in columns}
        for source in self.accepted:
            if source.lower() in by_lower:
                return by_lower[source.lower()]
        return None


@dataclass(frozen=True)
class FeedContract:
    """Everything the flows need to know about one feed."""

    name: str
    glob: str
    columns: tuple[ColumnRule, ...]
    key_patterns: dict[str, str]
    keys: tuple[str, ...]
    sequence: str = PROCESSING_TIME
    except_columns: tuple[str, ...] = (SOURCE_FILE, RESCUED)
    max_files: int = 5
    pass_through: tuple[str, ...] = ()  # columns outside the contract that bronze keeps as text
    properties: dict[str, str] = field(
        default_factory=lambda: {"quality": "bronze"}
    )

    @property
    def value_columns(self) -> list[str]:
        return [c.name for c in self.columns if c.name not in self.keys]

    def stored_columns(self, keep_source_columns: bool = False) -> list[str]:
        """Non-key columns kept in silver."""
        leftovers = [c.raw_name for c in self.columns if c.leaves_source_behind]
        everything = [
            *self.value_columns, *(leftovers if keep_source_columns else []), *self.pass_through, *OPERATIONAL
        ]
        return [c for c in everything if c not in self.except_columns]

    def bronze_schema(self) -> T.StructType:
        names = [*(c.raw_name for c in self.columns), *self.pass_through]
        raw = [T.StructField(name, T.StringType()) for name in names]
        return T.StructType(
            raw
            + [
                T.StructField(PROCESSING_TIME, T.TimestampType()),
                T.StructField(SOURCE_FILE, T.StringType()),
                T.StructField(RESCUED, T.StringType()),
            ]
        )

    def standard_schema(self, keep_source_columns: bool = False) -> T.StructType:
        """Schema of the rows that ``standardize`` produces."""
        schema = T.StructType()
        for key in self.key_patterns:
            schema.add(key, T.IntegerType())
        for rule in self.columns:
            schema.add(rule.name, rule.type)
        if keep_source_columns:
            for rule in self.columns:
                if rule.leaves_source_behind:
                    schema.add(rule.raw_name, T.StringType())
        for name in self.pass_through:
            schema.add(name, T.StringType())
        for name in OPERATIONAL:
            schema.add(self.bronze_schema()[name])
        return schema


# File globs, file-name patterns, column names, types and keys.
SMALLINT = T.ShortType()
READING = T.DecimalType(6, 2)
BOOLEAN = T.BooleanType()
KEY_PATTERNS = {"FARM_NO": r"Farm_(\d+)", "SHED_NO": r"Shed_(\d+)"}
HOURLY_KEYS = ("FARM_NO", "SHED_NO", "DAY", "HOUR")
DAILY_KEYS = ("FARM_NO", "SHED_NO", "DAY")

CAMERA = FeedContract(
    name="camera",
    glob="Camera_Farm_*.csv",
    columns=(
        ColumnRule("DAY", SMALLINT),
        ColumnRule("HOUR", SMALLINT),
        ColumnRule("BRIGHTNESS", READING),
        ColumnRule("BIRD_ACTIVITY", READING),
        ColumnRule("SOUND_LEVEL", READING),
        ColumnRule("CAMERA_OPERATIONAL", BOOLEAN),
    ),
    key_patterns=KEY_PATTERNS,
    keys=HOURLY_KEYS,
)

ENVIRONMENTAL = FeedContract(
    name="environmental",
    glob="Environmental_Farm_*.csv",
    columns=(
        ColumnRule("DAY", SMALLINT),
        ColumnRule("HOUR", SMALLINT),
        ColumnRule("TEMPRATURE", READING, ("temperature",)),
        ColumnRule("HUMIDITY", READING, ("humidity",)),
    ),
    key_patterns=KEY_PATTERNS,
    keys=HOURLY_KEYS,
)

SYNTHETIC = FeedContract(
    name="synthetic",
    glob="Synthetic_Poultry_*.csv",
    columns=(
        ColumnRule("DAY", SMALLINT, ("Day",)),
        ColumnRule("WEIGHT_GM", READING, ("Weight_g", "Weight__g")),
    ),
    key_patterns=KEY_PATTERNS,
    keys=DAILY_KEYS,
)

FEEDS = {c.name: c for c in (CAMERA, ENVIRONMENTAL, SYNTHETIC)}
