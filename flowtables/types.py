"""Column types by name, and conformance of rows to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the accepted type names; unsigned types widen to the next signed type that holds them
NAMES = {
    T.ByteType(): ("int8", "i8"),
    T.ShortType(): ("int16", "i16", "uint8", "u8"),
    T.IntegerType(): ("int32", "i32", "int", "uint16", "u16"),
    T.LongType(): ("int64", "i64", "uint32", "u32"),
    T.DecimalType(20, 0): ("uint64", "u64"),
    T.FloatType(): ("float16", "f16", "float32", "f32", "float"),
    T.DoubleType(): ("float64", "f64", "double"),
    T.BooleanType(): ("bool", "boolean"),
    T.StringType(): ("string", "str", "utf8", "large_string", "large_utf8"),
    T.BinaryType(): ("binary", "bytes"),
    T.DateType(): ("date32", "date"),
    T.TimestampType(): ("timestamp", "datetime"),
}
BY_NAME = {name: kind for kind, names in NAMES.items() for name in names}


def declared(columns: dict[str, str]) -> T.StructType:
    """The schema of a source declared as {column: type name}; every column is nullable. Unknown names raise ValueError."""
    unknown = {c: t for c, t in columns.items() if t.strip().lower() not in BY_NAME}
    if unknown:
        raise ValueError(f"unknown type in {unknown}")
    return T.StructType([T.StructField(c, BY_NAME[t.strip().lower()]) for c, t in columns.items()])


def mismatches(df: DataFrame, schema: T.StructType) -> list[str]:
    """What keeps the rows of `df` from being rows of a source: columns missing, not declared, or of another type."""
    have, want = ({f.name: f.dataType for f in s.fields} for s in (df.schema, schema))
    out = [f"missing column {c}" for c in want if c not in have] + [f"undeclared column {c}" for c in have if c not in want]
    return out + [f"{c} is {have[c].simpleString()}, declared {want[c].simpleString()}" for c in want if c in have and have[c] != want[c]]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` in the declared column order; raises ValueError on any mismatch instead of casting or dropping."""
    if found := mismatches(df, schema):
        raise ValueError("; ".join(found))
    return df.select([F.col(f.name) for f in schema.fields])
