"""Text expressions: packing/unpacking cells, names, null text."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The packed-cell separator, the numeric fill for missing cells, the rule for
# valid column names and the text that stands for a missing value in tag files.
SEPARATOR = ","
NUMERIC_FILL = "0.0"
FIELD_NAME_PATTERN = "^[A-Za-z_][A-Za-z0-9_]*$"
NULL_TEXT = "null"


def quote(name: str) -> str:
    """Backtick-quote a column name (tag ids may contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def pack_values(cols: Sequence[Column], fill: str = NUMERIC_FILL) -> Column:
    """Join cells with the separator; a missing cell becomes ``fill`` first (concat_ws alone
    would silently skip it and shift every later cell)."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(fill)) for c in cols])


# What cannot stand in an escaped cell as it is, and how it is written (the mark first).
ESCAPES = (("%", "%25"), (SEPARATOR, "%2C"), ("\n", "%0A"), ("\r", "%0D"), ("\t", "%09"))
MISSING, EMPTY, SPACE = "%-", "%+", "%20"


def escape_cell(c: Column) -> Column:
    """Text without separators, line ends and outer spaces (text formats would drop those); a missing
    and an empty one as marks that no text gives."""
    out = c
    for raw, written in ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(written))
    out = F.regexp_replace(out, "^ | $", SPACE)
    return F.when(c.isNull(), F.lit(MISSING)).when(c == "", F.lit(EMPTY)).otherwise(out)


def unescape_cell(c: Column) -> Column:
    out = F.replace(c, F.lit(SPACE), F.lit(" "))
    for raw, written in reversed(ESCAPES):
        out = F.replace(out, F.lit(written), F.lit(raw))
    return F.when(c == EMPTY, F.lit("")).when(c != MISSING, out)


def last_component(name: Column) -> Column:
    """Last dot-separated component of a dotted label id ("db.table.col" -> "col")."""
    return F.element_at(F.split(name, r"\."), -1)


def valid_identifier(name: Column) -> Column:
    """True where a column name is a plain identifier."""
    return name.rlike(FIELD_NAME_PATTERN)


def null_text_to_zero(c: Column) -> Column:
    """Missing cell or the text ``null`` -> "0"; other text unchanged (stays a string)."""
    return F.when(c.isNull() | (c == F.lit(NULL_TEXT)), F.lit("0")).otherwise(c)
