"""Optional re-typing of text values: integer, else float, else text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: accepted number forms, ASCII whitespace around them -------
INTEGER_FORM = r"^[ \t\n\r\f\x0B]*[+-]?[0-9]+[ \t\n\r\f\x0B]*\z"
FLOAT_FORM = (
    r"^[ \t\n\r\f\x0B]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\f\x0B]*\z"
)
NAN_FORM = r"(?i)^[ \t\n\r\f\x0B]*[+-]?nan[ \t\n\r\f\x0B]*\z"
POSITIVE_INFINITY_FORM = r"(?i)^[ \t\n\r\f\x0B]*[+]?inf(inity)?[ \t\n\r\f\x0B]*\z"
NEGATIVE_INFINITY_FORM = r"(?i)^[ \t\n\r\f\x0B]*-inf(inity)?[ \t\n\r\f\x0B]*\z"
# ----------------------------------------------------------------------------


def string_as_long(text: Column) -> Column:
    """The text as bigint, or null where it is no integer or does not fit."""
    return F.when(text.rlike(INTEGER_FORM), text.try_cast("long"))


def string_as_double(text: Column) -> Column:
    """The text as double, or null where it is no number."""
    return (
        F.when(text.rlike(FLOAT_FORM), text.try_cast("double"))
        .when(text.rlike(NAN_FORM), F.lit(float("nan")))
        .when(text.rlike(POSITIVE_INFINITY_FORM), F.lit(float("inf")))
        .when(text.rlike(NEGATIVE_INFINITY_FORM), F.lit(float("-inf")))
    )


def retype_strings(df: DataFrame) -> DataFrame:
    """Move numeric ``str_v`` texts to ``long_v`` or ``dbl_v``.

    An integer too long for a bigint becomes a double. The column moved to is
    overwritten and ``str_v`` becomes null; other rows are left as they are.
    """
    text = F.col("str_v")
    # Columns of their own, so that each pattern is matched once per row.
    tried = df.withColumn("_long", string_as_long(text)).withColumn(
        "_double", F.when(F.col("_long").isNull(), string_as_double(text))
    )
    neither = F.col("_long").isNull() & F.col("_double").isNull()
    return tried.withColumns(
        {
            "str_v": F.when(neither, text),
            "long_v": F.coalesce("_long", "long_v"),
            "dbl_v": F.coalesce("_double", "dbl_v"),
        }
    ).drop("_long", "_double")
