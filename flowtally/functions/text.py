"""Text cleaning with native string functions only (no Python UDF)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col, matches

MONEY = "decimal(18,4)"
WRITTEN_MONEY = "decimal(28,4)"  # amounts read from text, which may be larger than any computed here

# Positions where a word starts: a letter that follows neither a letter, a digit,
# an underscore nor an apostrophe.
_WORD_START = r"(?<![\p{L}\p{N}_'])(?=\p{L})"


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Unlike `initcap`, words also start after brackets, hyphens and slashes, and
    an apostrophe does not start one.
    """
    words = F.split(F.lower(as_col(c)), _WORD_START)
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 2**31 - 1))), ""
    )


def remove_first(c: Column | str, pattern: str) -> Column:
    """Remove the first match of a pattern without capture groups."""
    return F.regexp_replace(as_col(c), rf"(?s)^(.*?)(?:{pattern})", "$1")


def remove_all(c: Column | str, pattern: str) -> Column:
    return F.regexp_replace(as_col(c), pattern, "")


def replace_patterns(c: Column | str, replacements: Mapping[str, str]) -> Column:
    """Apply several pattern replacements one after the other."""
    out = as_col(c)
    for pattern, text in replacements.items():
        out = F.regexp_replace(out, pattern, text)
    return out


def trimmed(c: Column | str) -> Column:
    """Strip blanks, tabs and line ends on both sides."""
    return F.regexp_replace(as_col(c), r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def blank_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c != "", c)


def pad_left(c: Column | str, width: int, fill: str = "0") -> Column:
    """Left-pad to a width; longer texts stay whole."""
    c = as_col(c)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, fill))


def leading_digits(c: Column | str) -> Column:
    """Digits at the very start of the text, '' when there are none."""
    return F.regexp_extract(as_col(c), r"^(\d*)", 1)


def between_positions(c: Column | str, first: int, last: int) -> Column:
    """Characters `first`..`last`, both counted from 1 and included."""
    return F.substring(as_col(c), first, last - first + 1)


def last_chars(c: Column | str, n: int) -> Column:
    return F.right(as_col(c), F.lit(n))


def glued(*parts: Column) -> Column:
    """Concatenate, writing NULL as the text 'NA'."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def operation_key(year: Column, number: Column, prefix: str = "RO-") -> Column:
    """Operation id `<prefix><year>-<number padded to 3>`; NULL parts show as 'NA'."""
    return glued(F.lit(prefix), year, F.lit("-"), pad_left(number, 3))


def number_value(c: Column | str) -> Column:
    """Text to double; anything that is not a number becomes NULL.

    The cast ignores blanks and line ends around the number, but would also take the
    Java suffixes of '12f' or '12d'.
    """
    c = as_col(c)
    return F.when(~c.rlike(r"[dDfF]\s*$"), c.try_cast("double"))


def amount_value(c: Column | str) -> Column:
    """Text to an exact amount of money; anything that is not a number becomes NULL."""
    return as_col(c).try_cast(WRITTEN_MONEY)


def money_value(c: Column | str) -> Column:
    """Currency text such as '€ 4 9,883.90' to an exact amount; '€ -' becomes NULL."""
    return _bare_amount(c).try_cast(WRITTEN_MONEY)


def _bare_amount(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), r"[,\s €]", "")


def unfit_amount(c: Column | str) -> Column:
    """Whether a text with digits is read as no amount, or only rounded to four decimals."""
    bare = _bare_amount(c)
    value = bare.try_cast(WRITTEN_MONEY)
    exact = bare.try_cast("decimal(38,10)")
    inexact = value.isNull() | exact.isNull() | (value != exact) | bare.rlike(r"\.\d{11,}")
    return F.coalesce(bare.rlike(r"\d") & inexact, F.lit(False))


def display_amount(c: Column | str, digits: int = 0, currency: str = "€") -> Column:
    """Number for display with '.' between thousands and ',' before decimals, ties away from 0."""
    value = as_col(c)
    text = F.translate(F.format_number(F.round(F.abs(value), digits), digits), ",.", ".,")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit(currency), text)


def computed_once(c: Column, use: Callable[[Column], Column]) -> Column:
    """Use a costly expression several times but work it out once per row."""
    return F.element_at(F.transform(F.array(c), use), 1)


def apply_rules(
    c: Column | str,
    rules: Sequence[tuple[str, str | None]],
    exact: Mapping[str, str | None] | None = None,
    ignore_case: bool = False,
) -> Column:
    """Rewrite a name by the first pattern that matches it, then by exact names.

    A text that meets no rule, and NULL, stay as they are. A rule may map to NULL.
    """
    if isinstance(c, Column):
        return computed_once(c, lambda value: _first_rule(value, rules, exact, ignore_case))
    return _first_rule(as_col(c), rules, exact, ignore_case)


def _first_rule(c: Column, rules, exact, ignore_case) -> Column:
    cases = [(matches(c, pattern, ignore_case), to) for pattern, to in rules]
    cases += [(c == name, to) for name, to in (exact or {}).items()]
    if not cases:
        return c
    first, *rest = cases
    out = F.when(first[0], F.lit(first[1]).cast("string"))
    for condition, to in rest:
        out = out.when(condition, F.lit(to).cast("string"))
    return out.otherwise(c)
