"""Text forms of values, surrogate keys, names and URL parts as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climagrid.functions.arithmetic import to_column

# Fixed value: stands for NULL inside the key text, so stored keys keep matching.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"

# URL schemes that are dropped before a URL is cut.
HOST_SCHEMES = ("android-app://", "http://", "https://")
PATH_SCHEMES = ("http://", "https://")


def float_text(value) -> Column:
    """Shortest text of a float or double, plain between 1e-4 and 1e16.

    Spark prints ``1.0E7`` and ``1.0E-4`` where the stored keys were built from
    ``10000000.0`` and ``0.0001``; outside that range the exponent is written as
    ``1e+16`` or ``1e-05``.
    """
    x = to_column(value)
    text = x.cast("string")
    digits = F.regexp_replace(text.cast("decimal(38,22)").cast("string"), r"0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    signed = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E-", "e-"), r"(\.0)?E", "e+")
    scientific = F.regexp_replace(signed, r"e([+-])(\d)$", "e$10$2")
    size = F.abs(x)
    return F.when(~F.contains(text, F.lit("E")), text).otherwise(
        F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(scientific)
    )


def text_of(df: DataFrame, name: str) -> Column:
    """Text of a column of ``df``, with floats written as in ``float_text``."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return float_text(F.col(name))
    return F.col(name).cast("string")


def surrogate_key(df: DataFrame, fields: list[str], null_value: str = KEY_NULL) -> Column:
    """md5 over the texts of ``fields`` joined by ``-``; NULL becomes ``null_value``."""
    parts = [F.coalesce(text_of(df, f), F.lit(null_value)) for f in fields]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def slugify(name: str) -> str:
    """Lower-case identifier: blanks and dashes to ``_``, other signs dropped, no leading digit."""
    slug = re.sub(r"[ -]+", "_", (name or "").lower())
    slug = re.sub(r"[^a-z0-9_]", "", slug)
    return f"_{slug}" if slug[:1].isdigit() else slug


def _without(field: Column, schemes) -> Column:
    for scheme in schemes:
        field = F.replace(field, F.lit(scheme), F.lit(""))
    return field


def _before(field: Column, mark: str) -> Column:
    return F.split_part(field, F.lit(mark), F.lit(1))


def url_host(field) -> Column:
    """Text up to the first ``/`` and ``?`` after schemes are removed wherever they occur."""
    return _before(_before(_without(to_column(field), HOST_SCHEMES), "/"), "?")


def url_path(field) -> Column:
    """Text between the first ``/`` and the query.

    Without a ``/`` the cut starts at the query; without either the whole text is
    the path. The first ``/`` may lie inside the query.
    """
    stripped = _without(to_column(field), PATH_SCHEMES)
    slash = F.instr(stripped, F.lit("/"))
    start = F.when(slash > 0, slash).otherwise(F.instr(stripped, F.lit("?")) - 1)
    return _before(F.right(stripped, F.length(stripped) - start), "?")


def url_parameter(field, name: str) -> Column:
    """Value after the first ``name=`` up to ``&``; empty becomes NULL.

    ``name=`` is matched as plain text, so ``a`` also matches inside ``ba=1``.
    """
    tail = F.split_part(to_column(field), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(tail, "&"), F.lit(""))
