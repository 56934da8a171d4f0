"""Text, number and date expressions. Each is a plain Column, so it stays inside generated code."""

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import fixed_values as fixed

# Shapes allow white space at both ends, so a text is stripped only where it has the right shape.
_EDGE = r"[\p{IsWhite_Space}\x1c-\x1f]*"  # the characters of WHITE_SPACE


def _shape(pattern: str) -> str:
    return rf"\A{_EDGE}(?:{pattern}){_EDGE}\z"


_NUMBER = r"(?i)[+-]?(?:[0-9]+{point}?[0-9]*(?:e[+-]?[0-9]+)?|{point}[0-9]+(?:e[+-]?[0-9]+)?|inf|infinity)"
_DOT, _DOT_OR_COMMA = [_shape(_NUMBER.format(point=p)) for p in (r"\.", "[.,]")]
_INTEGER = _shape("[+-]?[0-9]+")

# Years that a 64-bit nanosecond timestamp holds in full.
_YEAR = "(?:167[89]|16[89][0-9]|1[7-9][0-9]{2}|2[01][0-9]{2}|22[0-5][0-9]|226[01])"

# Date formats by the name the dictionary uses, as (shape, Spark pattern, day prefix).
_DATE_FORMATS = {
    name: (_shape(shape.replace("9", "[0-9]{1,2}").replace("Y", _YEAR)), pattern, prefix)
    for name, (shape, pattern, prefix) in {
        "DD.MM.YYYY": (r"9\.9\.Y", "d.M.yyyy", ""),
        "MM.YYYY": (r"9\.Y", "d.M.yyyy", "1."),
        "MM-DD-YYYY": (r"9-9-Y", "M-d-yyyy", ""),
        "MM-YYYY": (r"9-Y", "d-M-yyyy", "1-"),
        "YYYY-MM-DD": (r"Y-9-9", "yyyy-M-d", ""),
        "DD/MM/YYYY": (r"9/9/Y", "d/M/yyyy", ""),
    }.items()
}
VALUE_DATE_FORMATS = ("DD.MM.YYYY", "MM.YYYY", "MM-DD-YYYY", "MM-YYYY", "YYYY-MM-DD")
DAY_FIRST_FORMATS = ("DD.MM.YYYY", "DD/MM/YYYY", "YYYY-MM-DD")


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(fixed.WHITE_SPACE))


def strip_plain(text: Column) -> Column:
    """As :func:`strip`, for texts of large tables: one that begins and ends with a printable ASCII character, as nearly
    all do, is left as it is without a search. Its code is longer, so it has no place in long expressions: the JVM does
    not compile a method of more than 8,000 bytes."""
    plain = text.between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(plain, text).otherwise(strip(text))


def has_value(text: Column) -> Column:
    """True where the text is present and not blank; never null.

    A text that begins with a printable ASCII character, as nearly all do, need not be stripped to know.
    """
    return F.when(text.cast("string").between("!", "~"), True).otherwise(F.coalesce(strip(text) != "", F.lit(False)))


def is_true(text: Column) -> Column:
    """True where a flag text reads ``true``; never null."""
    return F.coalesce(F.lower(strip(text)) == "true", F.lit(False))


def normalise_nulls(df: DataFrame, columns=None) -> DataFrame:
    """Turn every missing-value token into null."""
    columns = df.columns if columns is None else columns
    missing = list(fixed.MISSING_TOKENS)
    return df.withColumns({c: F.when(~F.col(c).isin(missing), F.col(c)) for c in columns})


def is_number_text(text: Column) -> Column:
    """Whether a text reads as a number with a dot or comma as decimal point."""
    return text.rlike(_DOT_OR_COMMA)


def to_number(text: Column, comma: bool = True) -> Column:
    """Number written in a text, or null. ``comma`` also reads a comma as the decimal point."""
    plain = F.replace(text, F.lit(","), F.lit(".")) if comma else text
    return F.when(text.rlike(_DOT_OR_COMMA if comma else _DOT), strip(plain).try_cast("double"))


def is_integer_text(text: Column) -> Column:
    return text.rlike(_INTEGER)


def _dated(text: Column, name: str) -> Column:
    shape, pattern, prefix = _DATE_FORMATS[name]
    clean = strip(text)
    return F.when(text.rlike(shape), F.try_to_date(F.concat(F.lit(prefix), clean) if prefix else clean, pattern))


def to_date_in(text: Column, format_name: Column, names=VALUE_DATE_FORMATS, otherwise=None) -> Column:
    """Date written in the format that ``format_name`` names, or null.

    Month formats mean the first of the month. ``otherwise`` gives the formats tried, in order, where the
    name is not known; without it such rows are null. The name is compared as it is: strip it on the rule
    table, once per rule rather than once per value.
    """
    chain = F.when(F.lit(False), F.lit(None).cast("date"))
    for name in names:
        chain = chain.when(format_name == name, _dated(text, name))
    if otherwise:
        chain = chain.otherwise(to_date_any(text, otherwise))
    return chain


def to_date_any(text: Column, names=DAY_FIRST_FORMATS) -> Column:
    """Date written in any of the named formats, tried in order."""
    return F.coalesce(*[_dated(text, name) for name in names])
