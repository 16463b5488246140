"""Column expressions for labels, titles, defaults and states of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NEGATION = r"(?i)^(no|not|non)[ -]+"
CONTINUED = r"(?i)\s*\(continued\)\s*$"
STORED = ("extracted", "verified", "manual")


def cascade(rules: Sequence[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """The value of the first condition that holds."""
    found = F.lit(default) if not isinstance(default, Column) else default
    for condition, value in reversed(list(rules)):
        found = F.when(condition, value).otherwise(found)
    return found


def defaulted(own: Column, rules: Sequence[tuple[Column, Column | str]], default: Column | str | None = None) -> Column:
    """An explicit value, or else what ordered rules give."""
    return F.coalesce(own, cascade(rules, default))


def positive_label(zero: Column, one: Column | None = None) -> Column:
    """Of a bit's labels for 0 and 1 the one that is not negated; of a negated label alone the word behind the negation."""
    bare = F.regexp_replace(zero, NEGATION, "")
    if one is None:
        return F.when(zero.rlike(NEGATION), bare).otherwise(zero)
    return F.when(zero.rlike(NEGATION) & ~F.coalesce(one.rlike(NEGATION), F.lit(True)), one).when(zero.rlike(NEGATION), bare).otherwise(zero)


def is_continued(title: Column) -> Column:
    return title.rlike(CONTINUED)


def base_title(title: Column, kind: Column | None = None, page: Column | None = None) -> Column:
    """A title without its continuation mark; one without two letters in a row is named by kind and page, where those are given."""
    bare = F.regexp_replace(title, CONTINUED, "")
    if kind is None or page is None:
        return bare
    return F.when(F.coalesce(bare, F.lit("")).rlike("[A-Za-z]{2}"), bare).otherwise(F.concat(kind, F.lit(" p."), page.cast("string")))


def display_label(name: Column, marks: Sequence[tuple[Column, str]]) -> Column:
    """A name with the first mark that fits."""
    mark = cascade(marks)
    return F.when(mark.isNull(), name).otherwise(F.concat_ws(" / ", name, mark))


def promoted(stored: Column, chosen: Column) -> Column:
    """The state of a record after chosen ones were verified: only extracted ones change."""
    return F.when((stored == STORED[0]) & chosen, STORED[1]).otherwise(stored)
