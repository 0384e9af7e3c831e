"""Table specifications.

One ``TableSpec`` per captured table gives everything that differs between tables:
the topic, the JSON schemas of key and row image, and the columns of the change log.
Adding a table is adding a specification; no decode code changes.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import types as T

# How each source type travels in JSON.
#   int        32-bit JSON number
#   long       64-bit JSON number
#   text       JSON string
#   decimal    base64 of the big-endian two's-complement unscaled integer
#   timestamp  64-bit microseconds since the epoch (zone-less source column)
#   date       32-bit days since the epoch
#   short, double, float, boolean  as JSON has them
WIRE_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "text": T.StringType(),
    "decimal": T.BinaryType(),
    "timestamp": T.LongType(),
    "date": T.IntegerType(),
    "short": T.ShortType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class Field:
    """A source column: its name, how it is written on the wire, and its constraint."""

    name: str
    wire: str
    precision: int = 20
    scale: int = 2
    not_null: bool = True
    unique: bool = False

    def __post_init__(self):
        if self.wire not in WIRE_TYPES:
            raise ValueError(f"unknown wire type {self.wire!r} for column {self.name!r}")

    @property
    def wire_type(self) -> T.DataType:
        return WIRE_TYPES[self.wire]

    @property
    def log_type(self) -> T.DataType:
        if self.wire == "decimal":
            return T.DecimalType(self.precision, self.scale)
        if self.wire == "timestamp":
            return T.TimestampType()
        if self.wire == "date":
            return T.DateType()
        return self.wire_type


@dataclass(frozen=True)
class TableSpec:
    """A captured table: where its changes arrive and what its rows look like.

    ``position`` says how the source writes log positions, and so how changes are ordered: as a
    ``number`` (``lsn``); as text with numbers in it, such as a file and an offset, ``natural``; or as
    ``text`` of equal lengths, such as hexadecimal.
    """

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ("id",)
    schema: str = "public"
    prefix: str = "appdb"
    position: str = "number"

    def __post_init__(self):
        if self.position not in ("number", "natural", "text"):
            raise ValueError(f"unknown kind of position {self.position!r} for {self.name!r}")
        missing = set(self.key) - {f.name for f in self.fields}
        if missing:
            raise ValueError(f"key columns {sorted(missing)} are not columns of {self.name!r}")

    @property
    def topic(self) -> str:
        return f"{self.prefix}.{self.schema}.{self.name}"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def key_columns(self) -> list[str]:
        """Names of the key in the change log."""
        return [f"pk_{name}" for name in self.key]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def key_type(self) -> T.StructType:
        return T.StructType([T.StructField(n, self.field(n).wire_type) for n in self.key])

    def image_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.wire_type) for f in self.fields])

    def log_type(self) -> T.StructType:
        """Schema of the change log, in column order."""
        keys = [T.StructField(f"pk_{n}", self.field(n).log_type) for n in self.key]
        images = [T.StructField(f.name, f.log_type) for f in self.fields]
        return T.StructType(
            [
                *keys,
                T.StructField("op", T.StringType()),
                *images,
                T.StructField("event_ts", T.TimestampType()),
                T.StructField("is_deleted", T.BooleanType()),
            ]
        )

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, conf: dict) -> TableSpec:
        rest = {k: v for k, v in conf.items() if k not in ("fields", "key")}
        return cls(
            fields=tuple(Field(**f) for f in conf["fields"]),
            key=tuple(conf.get("key", ("id",))),
            **rest,
        )

    @classmethod
    def from_file(cls, path: str) -> TableSpec:
        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(json.load(handle))


ORDERS = TableSpec(
    "orders",
    (
        Field("id", "int", unique=True),
        Field("user_id", "int"),
        Field("product_name", "text"),
        Field("amount", "decimal"),
        Field("created_at", "timestamp"),
    ),
)

USERS = TableSpec(
    "users",
    (
        Field("id", "int", unique=True),
        Field("full_name", "text"),
        Field("email", "text", unique=True),
        Field("created_at", "timestamp"),
    ),
)
