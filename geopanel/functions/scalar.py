"""Scalar column expressions.

Missing values are NULL throughout (never NaN): a NULL operand or condition gives
NULL, a zero denominator gives NULL, and only the helpers that say so replace it.
All of them are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Days of the week as numbered by dayofweek().
WEEKDAYS = {"Sun": 1, "Mon": 2, "Tue": 3, "Wed": 4, "Thu": 5, "Fri": 6, "Sat": 7}

# One word: letters, marks, digits and underscores. An apostrophe or a point joins
# two letters or two digits; a comma or semicolon joins two digits.
_RUN = r"[\p{L}\p{M}\p{N}_]++"
_WORD = (
    rf"{_RUN}(?:(?<=[\p{{L}}\p{{M}}])['’.](?=\p{{L}}){_RUN}"
    rf"|(?<=\p{{N}})['’.,;](?=\p{{N}}){_RUN})*+"
)
# A code point no text may contain, and the blank that initcap() looks for.
_WORD_MARK = "\ufdd0 "


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A SQL text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql(template: str, **names: str) -> Column:
    """An expression from SQL text with column names filled in.

    The per-metric expressions are written this way: one call builds a whole
    expression, where the method form costs a round trip per operator.
    """
    return F.expr(template.format(**{k: quoted(v) for k, v in names.items()}))


def ratio(numerator: ColumnLike, denominator: ColumnLike, unbounded: bool = False) -> Column:
    """``numerator / denominator``; NULL when the denominator is 0.

    With ``unbounded`` a non-zero numerator over 0 gives +Inf or -Inf instead.
    """
    n, d = col(numerator), col(denominator)
    quotient = F.try_divide(n.cast("double"), d.cast("double"))
    if not unbounded:
        return quotient
    inf = float("inf")
    return (
        F.when((d == 0) & (n > 0), F.lit(inf))
        .when((d == 0) & (n < 0), F.lit(-inf))
        .otherwise(quotient)
    )


def half_even(c: ColumnLike, digits: int = 0) -> Column:
    """Round, ties to the even neighbour."""
    return F.rint(col(c)) if digits == 0 else F.bround(col(c), digits)


def if_else(condition: Column, yes: Any, no: Any) -> Column:
    """Two-way choice in which a NULL condition gives NULL, not ``no``."""
    return F.when(condition, yes).when(~condition, no)


def cases(branches: Iterable[tuple[Column, Any]], otherwise: Any = None) -> Column:
    """First branch whose condition is true; ``otherwise`` (NULL) when none is."""
    out = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        raise ValueError("cases() needs at least one branch")
    return out if otherwise is None else out.otherwise(otherwise)


def is_member(c: ColumnLike, values: Sequence[Any]) -> Column:
    """Membership as a value: NULL is in no list, so the result is never NULL."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def finite_or(c: ColumnLike, default: Any) -> Column:
    """Replace NULL, NaN and +-Inf (NaN sorts above every number)."""
    x = col(c).cast("double")
    return F.when(F.abs(x) < float("inf"), x).otherwise(F.lit(default).cast("double"))


def as_number(c: ColumnLike) -> Column:
    """Text to DOUBLE; text that is not a number gives NULL."""
    return col(c).try_cast("double")


def pad_key(c: ColumnLike, width: int) -> Column:
    """Left-pad text with zeros; text that is already wider is left whole."""
    return F.when(F.length(col(c)) < width, F.lpad(col(c), width, "0")).otherwise(col(c))


def number_key(c: ColumnLike, width: int) -> Column:
    """Whole number to zero-padded text."""
    return pad_key(col(c).cast("bigint").cast("string"), width)


def slice_text(c: ColumnLike, start: int, end: int) -> Column:
    """Characters ``start`` to ``end``, both included.

    Positions count from 1; negative ones count back from the last character.
    """
    if (start < 0) != (end < 0) or end < start:
        raise ValueError("start and end must count from the same side, start first")
    return F.substring(col(c), start, end - start + 1)


def remove_first(c: ColumnLike, pattern: str) -> Column:
    """Drop only the first match of a regular expression."""
    return F.regexp_replace(col(c), rf"(?s)\A(.*?)(?:{pattern})", "$1")


def remove_first_text(c: ColumnLike, part: str) -> Column:
    """Drop only the first occurrence of a fixed text; cheaper than a pattern."""
    found = F.instr(col(c), part)
    rest = F.concat(
        F.substr(col(c), F.lit(1), found - 1), F.substr(col(c), found + len(part))
    )
    return F.when(found > 0, rest).otherwise(col(c))


def split_first(c: ColumnLike, separator: str) -> tuple[Column, Column]:
    """Text before the first separator, and everything after it (NULL if none)."""
    parts = F.split(col(c), re.escape(separator), 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def title_case(c: ColumnLike) -> Column:
    """Lower-case the text, then capitalise each word, wherever the word starts.

    ``initcap`` has the letter rules but knows only blanks as word breaks, so every
    word gets a marked blank in front, which is taken out again.
    """
    marked = F.regexp_replace(col(c), _WORD, _WORD_MARK + "$0")
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def on_weekday(c: ColumnLike, day: str) -> Column:
    return F.dayofweek(col(c)) == WEEKDAYS[day]


def sum_columns(columns: Sequence[ColumnLike]) -> Column:
    """Sum across columns; NULL as soon as one of them is."""
    return reduce(add, [col(c) for c in columns])


def alias_code(c: ColumnLike, names: Mapping[str, str]) -> Column:
    """Translate codes by a fixed dictionary; unknown codes give NULL."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), col(c))
