"""Small text expressions used by loads and migrations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .properties import _col


# JSON texts that count as false. The string "0" is not among them.
FALSE_JSON = ["null", "false", "0", "0.0", "-0", "-0.0", '""', "[]", "{}"]


def is_truthy_json(c: Column | str) -> Column:
    """Whether a JSON text is neither absent nor null, false, 0 or empty."""
    return F.coalesce(~_col(c).isin(FALSE_JSON), F.lit(False))


def first_truthy(*choices: tuple[Column | str, Column | str]) -> Column:
    """The value of the first ``(value, whether it is truthy)`` that is, as a string.

    The last one is taken as it is, like the final operand of an ``or`` chain.
    """
    *first, (last, _) = choices
    return F.coalesce(*[F.when(_col(ok), _col(v).cast("string")) for v, ok in first], _col(last).cast("string"))


def clean_insert_id(c: Column | str) -> Column:
    """Keep letters, digits and hyphens; NULL stays NULL."""
    return F.regexp_replace(_col(c), r"[^a-zA-Z0-9-]", "")
