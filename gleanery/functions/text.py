"""Text rules of the answer parsers, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
    "           "
    "    　"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A filter on a derived column is pushed below the projection that derives
    it, with the whole expression in place of every mention.  Expressions that
    mention a costly value often are therefore bound with this.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def py_strip(col: Column) -> Column:
    """Strip Unicode white space at both ends (Spark's ``trim`` only knows U+0020)."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def parse_verdict(answer: Column) -> Column:
    """True where a free-text answer starts with YES, in any case."""
    return F.upper(py_strip(answer)).startswith("YES")


def strip_fences(answer: Column) -> Column:
    """Remove one Markdown code fence around an answer."""
    opened = F.regexp_replace(py_strip(answer), r"^```(?iu:json)?", "")
    # White space next to a fence goes with the last strip.
    return py_strip(F.regexp_replace(opened, r"```\z", ""))
