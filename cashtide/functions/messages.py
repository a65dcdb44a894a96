"""JSON message text."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Messages are strict JSON, whatever kind they are.
STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_message(columns: Sequence[Column | str], message_type: str | None = None) -> Column:
    """Encode columns as one JSON object, with a leading ``type`` field if given."""
    fields = [F.col(c) if isinstance(c, str) else c for c in columns]
    if message_type is not None:
        fields = [F.lit(message_type).alias("type"), *fields]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def is_single_object(text: Column) -> Column:
    """Whether text whose start the JSON reader took as an object ends where that object ends.

    The reader does not look behind the first object.  Without its strings, the braces of a single
    object return to depth zero only at the last character.  Most messages have one closing brace, and need no
    scan.
    """
    trimmed = F.rtrim(text, F.lit(" \t\r\n"))
    one_brace = F.length(trimmed) - F.length(F.replace(trimmed, F.lit("}"), F.lit(""))) == 1
    outside = F.regexp_replace(F.regexp_replace(trimmed, r"(?s)\\.", ""), '"[^"]*"', "")
    braces = F.split(F.regexp_replace(outside, "[^{}]+", ""), "")
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends"))
    scan = F.aggregate(
        F.filter(braces, lambda b: b != ""),
        start,
        lambda s, b: F.struct(
            (s["depth"] + F.when(b == "{", 1).otherwise(-1)).alias("depth"),
            (s["ends"] + F.when((b == "}") & (s["depth"] <= 1), 1).otherwise(0)).alias("ends"),
        ),
    )
    whole = F.when(one_brace, F.lit(True)).otherwise((scan["depth"] == 0) & (scan["ends"] == 1))
    return F.endswith(trimmed, F.lit("}")) & whole
