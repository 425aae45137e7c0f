"""Hour vectors: one cell of text such as ``[0 1 0 ...]`` holding a value per hour of the day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TOKEN = r"[^\[\],\s]+"


# what separates tokens elsewhere than in texts such as ``[0 1 0]``
OTHERWISE = [",", "\t", "\n", "\x0b", "\f", "\r", "  ", "[ ", " ]"]


def _plain(c: Column) -> tuple[Column, Column]:
    """Whether a text is bracketed once and its values lie one blank apart, and what is in the brackets: such texts can be split
    at blanks, which takes half the time of the pattern and gives the same."""
    inner = F.substring(c, F.lit(2), F.length(c) - 2)
    plain = c.startswith("[") & c.endswith("]") & (F.length(c) > 2) & ~inner.contains("[") & ~inner.contains("]")
    for text in OTHERWISE:
        plain = plain & ~c.contains(text)
    return plain, inner


def parse_vector(c: Column | str, element: str = "double") -> Column:
    """Text to array. Any mix of blanks, commas and newlines separates values.

    A token that is no number becomes a NULL element and keeps its hour; empty text gives an empty array.
    The ``int`` variant reads ``1.0`` as 1.
    """
    c = F.col(c) if isinstance(c, str) else c
    plain, inner = _plain(c)
    tokens = F.when(plain, F.split(inner, " ")).otherwise(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0)))
    values = tokens.try_cast("array<double>")
    return values if element == "double" else values.try_cast(f"array<{element}>")


def vector_length(c: Column | str) -> Column:
    """Number of values without building the array."""
    c = F.col(c) if isinstance(c, str) else c
    plain, inner = _plain(c)
    return F.when(plain, F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit(""))) + 1).otherwise(F.regexp_count(c, F.lit(TOKEN)))


def format_vector(c: Column | str) -> Column:
    """Array to text, values separated by single blanks."""
    return F.concat(F.lit("["), F.array_join(F.col(c) if isinstance(c, str) else c, " "), F.lit("]"))


def vector_sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def vector_squares(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + F.coalesce(x * x, F.lit(0.0)))


def positives(v: Column) -> Column:
    return F.filter(v, lambda x: x > 0)


def count_zero(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: x == 0)).cast("bigint")


def count_known(v: Column) -> Column:
    return F.size(F.filter(v, lambda x: x.isNotNull())).cast("bigint")
