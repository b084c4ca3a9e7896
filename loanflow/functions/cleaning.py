"""Tolerant text-to-type parsing for the Silver layer.

Every function is ``DataFrame -> DataFrame``, touches only the named columns
that exist, and is a single projection, so Catalyst sees one Project per step
instead of one per column.  Wide projections are written as SQL expression
text (one ``selectExpr``): the same Catalyst expressions as ``Column``
objects, built without a driver round trip per column.  Malformed values
become NULL through the ``try_*`` forms, which keeps the functions correct
with ANSI mode on (the Spark 4 default) without changing the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loanflow.schema import DATE_COLUMNS, DATE_FORMAT, NUMERIC_COLUMNS, PERCENT_COLUMNS, existing


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def project(df: DataFrame, replace: dict[str, str], add: dict[str, str] | None = None) -> DataFrame:
    """One projection: columns in ``replace`` get a new SQL expression, others pass through, ``add`` appends."""
    exprs = [f"{replace[c]} AS {ident(c)}" if c in replace else ident(c) for c in df.columns]
    exprs += [f"{e} AS {ident(c)}" for c, e in (add or {}).items()]
    return df.selectExpr(*exprs)


def blank(c: Column) -> Column:
    """True when a text value is empty or spaces only (``trim`` strips spaces, not tabs)."""
    return F.trim(c) == F.lit("")


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty or space-only text -> NULL in every string column; other values untouched (no trimming)."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not strings:
        return df
    return project(df, {c: f"CASE WHEN trim({ident(c)}) = '' THEN NULL ELSE {ident(c)} END" for c in strings})


# A tolerant cast throws and catches an exception for each text it cannot read, which takes many times as long as reading one.
# The tests before the casts let every readable text through: a number is not blank and has no comma, a month-year starts with a
# letter.  They are kept this short because a projection of a hundred of them is compiled as one method.
_NUMBER = "CASE WHEN trim({0}) <> '' AND NOT contains({0}, ',') THEN try_cast({0} AS DOUBLE) END"
_MONTH = f"CASE WHEN {{0}} >= 'A' THEN try_to_date({{0}}, {sql_text(DATE_FORMAT)}) END"


def _number(text: str) -> str:
    return _NUMBER.format(text)


def _percent(text: str) -> str:
    return _number(f"replace({text}, '%', '')")


def parse_percent(df: DataFrame, columns=PERCENT_COLUMNS) -> DataFrame:
    """'13.99%' -> 13.99: delete every '%', then a tolerant cast to double."""
    return project(df, {c: _percent(ident(c)) for c in existing(df, columns)})


def cast_numeric(df: DataFrame, columns=NUMERIC_COLUMNS) -> DataFrame:
    """Tolerant cast to double; text that is not a number becomes NULL."""
    return project(df, {c: _number(ident(c)) for c in existing(df, columns)})


def parse_month_date(df: DataFrame, columns=DATE_COLUMNS, fmt: str = DATE_FORMAT) -> DataFrame:
    """'Dec-2015' -> 2015-12-01; text in another layout becomes NULL."""
    form = _MONTH if fmt == DATE_FORMAT else f"try_to_date({{0}}, {sql_text(fmt)})"
    return project(df, {c: form.format(ident(c)) for c in existing(df, columns)})


#: SQL form of a text column by its kind.  Blank text is NULL in every kind.
_FORMS = {
    **dict.fromkeys(PERCENT_COLUMNS, _percent),
    **dict.fromkeys(NUMERIC_COLUMNS, _number),
    **dict.fromkeys(DATE_COLUMNS, _MONTH.format),
}


def _text(text: str) -> str:
    return f"CASE WHEN trim({text}) = '' THEN NULL ELSE {text} END"


def typed_columns(df: DataFrame) -> DataFrame:
    """All text columns to their Silver types in one projection: blank text is NULL in every kind, the rest follows the column's kind."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return project(df, {c: _FORMS.get(c, _text)(ident(c)) for c in text})
