"""Access-log lines to typed columns, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.timeparts import parse_web_log_time

# The line pattern and the names of its nine groups.
LINE_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
FIELDS = (
    "host", "client_identd", "user_id", "date_time", "method",
    "endpoint", "protocol", "response_code", "content_size",
)

_MARK = "\u0001"


def line_fields(line: Column) -> Column:
    """Array of the nine fields, or of one element if the line does not match.

    One replace that swallows the whole line costs a single regex run instead of
    one per group. Lines that already hold the separator take the per-group way.
    """
    template = _MARK.join(f"${i}" for i in range(1, len(FIELDS) + 1))
    single_run = F.split(F.regexp_replace(line, f"(?s){LINE_PATTERN}.*$", template), _MARK)
    per_group = F.when(
        line.rlike(LINE_PATTERN),
        F.array(*[F.regexp_extract(line, LINE_PATTERN, i + 1) for i in range(len(FIELDS))]),
    ).otherwise(F.array(line))
    return F.when(line.contains(_MARK), per_group).otherwise(single_run)


def parse_lines(logs: DataFrame, column: str = "value") -> DataFrame:
    """Add the nine fields plus ``parse_ok``; unmatched lines get NULL fields."""
    cut = logs.withColumn("__parts", line_fields(F.col(column)))
    ok = F.coalesce(F.size("__parts") == len(FIELDS), F.lit(False))
    fields = {
        name: F.when(F.col("parse_ok"), F.col("__parts")[i]) for i, name in enumerate(FIELDS)
    }
    fields["content_size"] = F.when(fields["content_size"] == "-", F.lit("0")).otherwise(fields["content_size"])
    return cut.withColumn("parse_ok", ok).withColumns(fields).drop("__parts")


def parse_map(line: Column) -> Column:
    """The same fields as one map column; NULL for a line that does not match."""
    names = F.array(*[F.lit(f) for f in FIELDS])

    def as_map(parts: Column) -> Column:
        size = F.when(parts[8] == "-", F.lit("0")).otherwise(parts[8])
        values = F.concat(F.slice(parts, 1, 8), F.array(size))
        return F.when(F.size(parts) == len(FIELDS), F.map_from_arrays(names, values))

    # As the element of an array the fields are made once and used by name.
    return F.transform(F.array(line_fields(line)), as_map)[0]


def typed(parsed: DataFrame) -> DataFrame:
    """Typed columns for a parsed log: status, size in bytes and request time."""
    return parsed.withColumns(
        {
            "response_code": F.col("response_code").try_cast("int"),
            "content_size_bytes": F.col("content_size").try_cast("long"),
            "request_time": parse_web_log_time(F.col("date_time")),
        }
    )
