"""Tests and field access on JSON carried as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


#: White space as JSON has it; Spark's trim takes spaces only.
WHITE_SPACE = " \t\n\r"


def stripped(body: Column) -> Column:
    return F.btrim(body, F.lit(WHITE_SPACE))


def json_elements(body: Column) -> Column:
    """The texts of a JSON array's elements; NULL unless the text is an array.

    Only text that opens an array is parsed: a failed parse costs far more than
    a good one, and most bodies may be lone objects.
    """
    return F.when(stripped(body).startswith("["), F.from_json(body, "array<string>"))


#: JSON as it is defined; Spark by itself also takes NaN and single quotes.
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def is_json(body: Column) -> Column:
    """Whether the whole text is one JSON value; one parse.

    Spark's parsers stop after the first value, so ``{} junk`` would pass. The text is tried
    as the first of two elements of an array; the second one is the text's own hash, which
    text after a first value cannot bring along.
    """
    mark = F.xxhash64(body).cast("string")
    framed = F.concat(F.lit("["), body, F.lit(","), mark, F.lit("]"))
    parts = F.from_json(framed, "array<string>", _STRICT)
    return F.coalesce((F.size(parts) == 2) & (F.get(parts, F.lit(1)) == mark), F.lit(False))


def json_members(record: Column) -> Column:
    """The members of a JSON object, as a map of texts; NULL if the text is no object."""
    return F.from_json(record, "map<string,string>", _STRICT)


def absent_keys(members: Column, required: Sequence[str]) -> Column:
    """Required keys that an object's members lack; NULL without an object.

    A key holding an explicit null is present.
    """
    wanted = F.array(*[F.lit(name) for name in required])
    return F.array_except(wanted, F.map_keys(members))


def member_texts(members: Column, fields: Sequence[str]) -> dict[str, Column]:
    """The named members as text. Of a name that an object holds twice the last one counts."""
    keys, values = F.reverse(F.map_keys(members)), F.reverse(F.map_values(members))
    return {
        name: F.get(values, (F.array_position(keys, name) - 1).cast("int")) for name in fields
    }
