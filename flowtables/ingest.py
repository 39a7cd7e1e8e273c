"""Payloads to rows: JSON, CSV and columnar texts, malformed ones split off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


CSV_RECORD = r'(?:[^"\n]++|"(?:[^"]++|"")*+")++'
CSV_FIELD = r',(?:"(?:[^"]++|"")*+"|[^,"]*+)'


def _one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; the parser by itself passes over what follows a value."""
    wrapped = F.try_parse_json(F.concat(F.lit('{"x":[['), text, F.lit("]]}")))
    return wrapped.isNotNull() & F.try_variant_get(wrapped, "$.x[0][0]", "variant").isNotNull() & F.try_variant_get(wrapped, "$.x[0][1]", "variant").isNull()


def json_records(df: DataFrame, payload: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """`keep`, record (its text), parsed (a struct of `schema`) and problem: a row per record of a JSON payload, problem null where it is sound.

    A payload is an object a line, or an array of objects, or one object over several lines. Blank lines are no records. A line or an element that
    is no object of the schema is one malformed record; a payload that is no JSON as a whole nor by lines one for each of its lines, or one for all
    of it if it begins as an array. A null or blank payload or an empty array is one record with the problem 'empty'.
    """
    text = F.btrim(F.col(payload), F.lit(" \t\r\n"))
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")
    is_object = lambda x: x.startswith("{") & _one_value(x)
    sound = _one_value(text)
    records = F.when(text.isNull() | (text == ""), F.array(F.lit("")))
    records = records.when(text.startswith("["), F.when(sound, F.from_json(text, "array<string>")).otherwise(F.array(text)))
    records = records.when(F.forall(lines, is_object), lines).when(sound, F.array(text)).otherwise(lines)
    rows = df.select(*(keep or []), F.explode(F.when(F.size(records) == 0, F.array(F.lit(""))).otherwise(records)).alias("record"))
    rows = rows.withColumn("parsed", F.from_json("record", f"{schema}, __corrupt string", {"columnNameOfCorruptRecord": "__corrupt"}))
    bad = ~is_object(F.col("record")) | F.col("parsed.__corrupt").isNotNull()
    problem = F.when(F.col("record") == "", "empty").when(F.coalesce(bad, F.lit(True)), "malformed")
    return _found(rows.select(*(keep or []), "record", F.col("parsed").dropFields("__corrupt").alias("parsed"), problem.alias("problem")))


def csv_records(df: DataFrame, payload: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """Like `json_records` for CSV payloads whose first record names the columns, in any order; columns that are not in the schema are passed over.

    Fields may be quoted, with commas, line breaks and doubled quotes inside; lines end in \\n or \\r\\n. Malformed are records with
    another number of fields than the header, with a stray quote, or with a value that is not of its column's type; the whole payload, where a quote is never closed or
    a column of the schema is missing. An empty field without quotes is null. A payload without records after its header is 'empty'.
    """
    fields = [f.split(None, 1) for f in schema.split(",")]
    text = F.replace(F.col(payload), F.lit("\r\n"), F.lit("\n"))
    rows = df.select(*(keep or []), text.alias("__text")).withColumn("__records", F.regexp_extract_all("__text", F.lit(CSV_RECORD), F.lit(0)))
    rows = rows.withColumn("__header", _csv_fields(F.get("__records", F.lit(0))))
    whole = (F.regexp_count("__text", F.lit('"')) % 2 == 1) | ~F.forall(F.array(*[F.lit(n) for n, _ in fields]), lambda n: F.array_contains("__header", n))
    body = F.slice("__records", 2, F.greatest(F.size("__records") - 1, F.lit(1)))
    none = F.coalesce(F.size("__records") < 2, F.lit(True))
    one = F.when(none & F.coalesce(F.size("__records") == 0, F.lit(True)), F.array(F.lit(""))).when(F.coalesce(whole, F.lit(True)), F.array("__text")).when(none, F.array(F.lit(""))).otherwise(body)
    rows = rows.withColumn("__whole", F.coalesce(whole, F.lit(True))).withColumn("record", F.explode(one)).withColumn("__fields", _csv_fields(F.col("record")))
    fits = (F.size("__fields") == F.size("__header")) & (F.aggregate(_csv_parts(F.col("record")), F.lit(0), lambda n, x: n + F.length(x)) == F.length("record") + 1)
    value = lambda n: F.get("__fields", (F.array_position("__header", n) - 1).cast("int"))
    parsed = F.struct(*[value(n).try_cast(t).alias(n) for n, t in fields])
    wrong = F.array(*[value(n).isNotNull() & value(n).try_cast(t).isNull() for n, t in fields])
    problem = F.when(F.col("record") == "", "empty").when(F.col("__whole") | ~F.coalesce(fits, F.lit(False)) | F.exists(wrong, lambda x: x), "malformed")
    return _found(rows.select(*(keep or []), "record", parsed.alias("parsed"), problem.alias("problem")))


def _found(records: DataFrame) -> DataFrame:
    """Nothing is parsed of a record with a problem."""
    return records.withColumn("parsed", F.when(F.col("problem").isNull(), F.col("parsed")))


def _csv_parts(record: Column) -> Column:
    return F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(CSV_FIELD), F.lit(0))


def _csv_fields(record: Column) -> Column:
    def plain(part: Column) -> Column:
        field = F.substring(part, F.lit(2), F.length(part))
        inside = F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        return F.when(field.startswith('"'), inside).when(field != "", field)

    return F.transform(_csv_parts(record), plain)


def columnar_records(df: DataFrame, payload: str, columns: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Like `json_records` for payloads that hold an array for each column, read side by side. A payload is malformed as a whole, if it is no
    object, a column is missing or no array of its type, or the arrays are of unequal length; without rows it is 'empty'."""
    kinds = ", ".join(f"{c} array<{t}>" for c, t in columns.items())
    rows = df.select(*(keep or []), F.col(payload).alias("record"), F.from_json(payload, f"{kinds}, __corrupt string", {"columnNameOfCorruptRecord": "__corrupt"}).alias("__p"))
    sizes = F.array(*[F.coalesce(F.size(f"__p.{c}"), F.lit(-1)) for c in columns])
    bad = F.col("__p").isNull() | F.col("__p.__corrupt").isNotNull() | (F.array_min(sizes) < 0) | (F.array_min(sizes) != F.array_max(sizes))
    zipped = F.arrays_zip(*[F.col(f"__p.{c}").alias(c) for c in columns])
    problem = F.when(F.coalesce(bad, F.lit(True)), "malformed").when(F.array_max(sizes) == 0, "empty")
    return rows.withColumn("problem", problem).select(*(keep or []), F.when(F.col("problem").isNotNull(), F.col("record")).alias("record"), F.explode_outer(F.when(F.col("problem").isNull(), zipped)).alias("parsed"), "problem")


def dead_letters(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of sound records, and the records that have a problem with it: together as many as there are records."""
    keep = [c for c in records.columns if c not in ("record", "parsed", "problem")]
    return records.where("problem is null").select(*keep, "parsed.*"), records.where("problem is not null").select(*keep, "record", "problem")


def strict(records: DataFrame, empty: bool = True) -> DataFrame:
    """The rows of records; a malformed one fails the query, and an empty payload too unless `empty` lets it pass as no rows."""
    keep = [c for c in records.columns if c not in ("record", "parsed", "problem")]
    allowed = F.lit(empty) & (F.col("problem") == "empty")
    failed = F.raise_error(F.concat_ws(" ", "problem", F.lit("payload:"), F.left("record", F.lit(200))))
    checked = F.when(F.col("problem").isNotNull() & ~allowed, failed.cast(records.schema["parsed"].dataType)).otherwise(F.col("parsed"))
    rows = records.where(F.col("problem").isNull() | ~allowed)
    return rows.select(*keep, checked.alias("parsed")).select(*keep, "parsed.*")


def json_rows(df: DataFrame, payload: str, schema: str, keep: list[str] | None = None, empty: bool = True) -> DataFrame:
    """The rows of JSON payloads (see `json_records`); a malformed record fails the query."""
    return strict(json_records(df, payload, schema, keep), empty)


def csv_rows(df: DataFrame, payload: str, schema: str, keep: list[str] | None = None, empty: bool = True) -> DataFrame:
    """The rows of CSV payloads (see `csv_records`); a malformed record fails the query."""
    return strict(csv_records(df, payload, schema, keep), empty)


def columnar_rows(df: DataFrame, payload: str, columns: dict[str, str], keep: list[str] | None = None, empty: bool = True) -> DataFrame:
    """The rows of columnar payloads (see `columnar_records`); a malformed one fails the query."""
    return strict(columnar_records(df, payload, columns, keep), empty)


# from narrow to wide; a column has the first type that all of its values fit
CSV_TYPES = ("boolean", "bigint", "double", "date", "timestamp", "string")


def csv_schema(df: DataFrame, payload: str) -> DataFrame:
    """column, type and n (values that are not null): what all values of each header column of CSV payloads fit, seen over every row.

    true and false are boolean, numbers bigint if all are whole, else double, dates and times such, anything else and mixtures of these string; a
    column without values is string. Tasks send one row a column.
    """
    text = F.replace(F.col(payload), F.lit("\r\n"), F.lit("\n"))
    rows = df.select(F.regexp_extract_all(text, F.lit(CSV_RECORD), F.lit(0)).alias("__records")).withColumn("__header", _csv_fields(F.get("__records", F.lit(0))))
    body = rows.where(F.size("__records") > 1).select("__header", F.explode(F.slice("__records", 2, F.greatest(F.size("__records") - 1, F.lit(1)))).alias("__r"))
    cells = body.select(F.explode(F.arrays_zip(F.col("__header").alias("column"), _csv_fields(F.col("__r")).alias("value"))).alias("__c")).select("__c.*").where("column is not null")
    value = F.col("value")
    fits = {
        "boolean": F.lower(value).isin("true", "false"),
        "bigint": value.rlike(r"^[+-]?[0-9]+$") & value.try_cast("bigint").isNotNull(),
        "double": value.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"),
        "date": value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(),
        "timestamp": value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9:.]+)?$") & value.try_cast("timestamp").isNotNull(),
    }
    seen = cells.groupBy("column").agg(F.count("value").alias("n"), *[F.bool_and(fit).alias(f"__{t}") for t, fit in fits.items()])
    kind = F.coalesce(*[F.when(F.col(f"__{t}"), t) for t in fits], F.lit("string"))
    return seen.select("column", F.when(F.col("n") > 0, kind).otherwise("string").alias("type"), "n")


def split_malformed(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """The rows with a struct `parsed` and `malformed`: whether the payload is no object of the schema."""
    parsed = F.from_json(payload, f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("parsed", parsed).withColumn("malformed", F.col(payload).isNull() | F.col("parsed._corrupt_record").isNotNull())


def fail_on_malformed(df: DataFrame, payload: str, schema: str) -> DataFrame:
    """The rows with the struct `parsed`; a malformed payload fails the query."""
    return df.withColumn("parsed", F.from_json(payload, schema, {"mode": "FAILFAST"}))


def json_schema(payload: str) -> Column:
    """An aggregate: the schema that all JSON payloads of a group fit, seen over every row."""
    return F.schema_of_variant_agg(F.parse_json(payload))


def decode(df: DataFrame, value: str, form: str, schema: str) -> DataFrame:
    """Message bytes to columns by `form`: json, csv, or raw, which leaves them as they are."""
    if form == "raw":
        return df
    if form not in ("json", "csv"):
        raise ValueError(f"unknown format {form}")
    text = F.col(value).cast("string")
    parsed = F.from_json(text, schema) if form == "json" else F.from_csv(text, schema)
    return df.withColumn("__row", parsed).select(*[c for c in df.columns if c != value], "__row.*")


def event_time(millis: Column) -> Column:
    """The time of an epoch-millisecond column."""
    return F.timestamp_millis(millis)
