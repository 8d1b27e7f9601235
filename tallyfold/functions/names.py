"""Expressions on batch names, folders and file locations."""

from functools import reduce

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def batch_date(batch_name) -> Column:
    """Date in front of a batch name: ``YYYYMMDD...`` or, when no month follows, 1 January of ``YYYY``."""
    name = _col(batch_name)
    year = F.substring(name, 1, 4)
    month, day = F.substring(name, 5, 2), F.substring(name, 7, 2)
    whole = F.concat_ws("-", year, month, day)
    text = F.when(month.rlike("^[0-9]+$"), whole).otherwise(F.concat(year, F.lit("-01-01")))
    return text.try_cast("date")


def remove_first(text: str, piece) -> Column:
    """Remove the first occurrence of ``piece`` from a column, as plain text and not as a pattern."""
    text, piece = F.col(text), F.lit(piece) if isinstance(piece, str) else piece
    at = F.position(piece, text)
    cut = F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + F.length(piece), F.length(text)))
    return F.when((at > 0) & (F.length(piece) > 0), cut).otherwise(text)


def strip_prefixes(location, *prefixes: str) -> Column:
    """Blank out known prefixes wherever they occur, to show the folder below them."""
    return reduce(lambda text, p: F.replace(text, F.lit(p), F.lit("")) if p else text, prefixes, _col(location))


def contains_any(text, pieces) -> Column:
    """True when ``text`` contains at least one of ``pieces``; no pieces means no restriction."""
    text = _col(text)
    tests = [text.contains(piece) for piece in pieces]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(True)
