"""Raw lines to typed rows, with the cause and the text of every line that is turned away.

The typed CSV readers turn a field they cannot read into a null and say no more. Here every line
of text is parsed once into strings, each field is cast on its own, and a line gets one status:
kept, or the first cause that applies, in the order of ``CAUSES``. Rejects keep their line and the
names of the fields that were no numbers or times, so they can be mended and sent again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripfold.sources.prepare import (
    BAD_YEAR,
    KEPT,
    NULL_PICKUP,
    STATUS,
    with_calendar,
    with_measures,
    with_timestamps,
)

BLANK, SHORT, LONG = "blank_line", "short_line", "long_line"
BAD_NUMBER, BAD_TIME = "bad_number", "bad_time"
CAUSES = (BLANK, SHORT, LONG, BAD_NUMBER, BAD_TIME, NULL_PICKUP, BAD_YEAR)

LINE, BAD_FIELDS = "raw_line", "bad_fields"
# Raw time column -> the parsed one.
TIMES = {"tpep_pickup_datetime": "pickup_ts", "tpep_dropoff_datetime": "dropoff_ts"}


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines of a folder of CSV files, without the header of any of them."""
    header = ",".join(StructType.fromDDL(schema).names).lower()
    lines = spark.read.text(path).select(F.col("value").alias(LINE))
    return lines.filter(F.lower(F.trim(F.translate(LINE, '"\r', ""))) != header)


def field_count(line: Column) -> Column:
    """Fields of a CSV line; commas between quotes separate none."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.translate(bare, ",", "")) + 1


def screened_trips(
    lines: DataFrame, schema: str, layout: str, year: int, least_fields: int | None = None
) -> DataFrame:
    """Every line as a prepared row with its status; rejects also have ``raw_line`` and ``bad_fields``.

    ``least_fields`` is how many fields make a line, by default all of the schema; fields beyond
    those a shorter line has are null.
    """
    fields = StructType.fromDDL(schema)
    least = len(fields) if least_fields is None else least_fields
    found = F.from_csv(F.rtrim(F.translate(F.col(LINE), "\r", "")), _ddl(fields.names), {"mode": "PERMISSIVE"})
    typed, unreadable = [], []
    for field, kind in zip(fields.names, _kinds(schema)):
        text = F.col(f"parsed.`{field}`")
        value = text if kind == "string" else F.trim(text).try_cast(kind)
        typed.append(value.alias(field))
        if kind != "string":
            unreadable.append(F.when(F.trim(text).isNotNull() & value.isNull(), F.lit(field)))
    parsed = lines.select(LINE, field_count(F.col(LINE)).alias("field_count"), found.alias("parsed"))
    rows = parsed.select(
        LINE, "field_count", _named(unreadable).alias("bad_numbers"), F.struct(*typed).alias("typed")
    )
    timed = with_timestamps(_once(rows, "bad_numbers", "field_count", "typed").select(
        LINE, "field_count", "bad_numbers", "typed.*"
    ), layout)
    missed = [
        F.when(F.col(raw).isNotNull() & F.col(parsed).isNull(), F.lit(raw)) for raw, parsed in TIMES.items()
    ]
    timed = timed.withColumn("bad_times", _named(missed))
    tests = {
        BLANK: F.trim(LINE) == "",
        SHORT: F.col("field_count") < least,
        LONG: F.col("field_count") > len(fields),
        BAD_NUMBER: F.size("bad_numbers") > 0,
        BAD_TIME: F.size("bad_times") > 0,
        NULL_PICKUP: F.col("pickup_ts").isNull(),
        BAD_YEAR: F.year("pickup_ts") != year,
    }
    status = F.lit(KEPT)
    for cause in reversed(CAUSES):
        status = F.when(tests[cause], cause).otherwise(status)
    turned_away = F.col(STATUS) != KEPT
    # A line of the wrong length has its fields in the wrong places: they say nothing.
    whole = ~F.col(STATUS).isin(KEPT, BLANK, SHORT, LONG)
    return with_measures(
        with_calendar(
            timed.withColumn(STATUS, status).withColumns(
                {
                    BAD_FIELDS: F.when(whole, F.concat("bad_numbers", "bad_times")),
                    LINE: F.when(turned_away, F.col(LINE)),
                }
            )
        )
    ).drop("field_count", "bad_numbers", "bad_times")


def _named(found: list[Column]) -> Column:
    """The names that are not null; ``array_compact`` would have their tests interpreted, not compiled."""
    return F.array_except(F.array(*found), F.array(F.lit(None).cast("string")))


def _once(rows: DataFrame, *names: str) -> DataFrame:
    """The rows, with the named columns worked out once a row.

    A filter on the status would be moved below all projections, and with it a copy of the parsing
    for each field it mentions: 123 of them for the counts of bad fields. No filter moves below the
    explosion of what it tests, here of an array of one.
    """
    others = [name for name in rows.columns if name not in names]
    exploded = rows.select(*others, F.explode(F.array(F.struct(*names))).alias("once"))
    return exploded.select(*others, "once.*")


def _kinds(schema: str) -> list[str]:
    return [field.dataType.simpleString() for field in StructType.fromDDL(schema)]


def _ddl(names: list[str]) -> str:
    return ", ".join(f"`{name}` STRING" for name in names)


def line_accounting(screened: DataFrame) -> DataFrame:
    """Lines by status; every line is in exactly one row."""
    return screened.groupBy(STATUS).agg(F.count("*").alias("lines"))


def bad_field_counts(screened: DataFrame) -> DataFrame:
    """Lines by status and unreadable field; a line counts under each of its fields."""
    return (
        screened.select(STATUS, F.explode(BAD_FIELDS).alias("field"))
        .groupBy(STATUS, "field")
        .agg(F.count("*").alias("lines"))
    )


def rejects(screened: DataFrame) -> DataFrame:
    """What was turned away: cause, unreadable fields and the line itself."""
    return screened.filter(F.col(STATUS) != KEPT).select(STATUS, BAD_FIELDS, LINE)
