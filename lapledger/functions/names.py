"""Expressions on competitor names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marks after which a letter is a capital besides the space, in the order they apply.
CAPITAL_AFTER = ("-", " mc", "'")
GAP = "\x01 "


def standard_name(name: Column) -> Column:
    """Lower case, then a capital at the start and after each mark: "O'NEIL mcrae" → "O'Neil McRae".

    A gap put behind each mark makes the next letter the start of a word for ``initcap``.
    """
    text = F.lower(name)
    for mark in CAPITAL_AFTER:
        text = F.replace(text, F.lit(mark), F.lit(mark + GAP))
    return F.replace(F.initcap(text), F.lit(GAP), F.lit(""))


def reversed_name(name: Column) -> Column:
    """"LAST1 LAST2 First" → "First LAST1 LAST2"; one word stays as it is."""
    words = F.split(F.trim(F.replace(name, F.lit("  "), F.lit(" "))), " ")
    rest = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    last = F.try_element_at(words, F.lit(-1))
    return F.when(F.size(words) > 1, F.concat_ws(" ", last, rest)).otherwise(last)


def first_name(name: Column) -> Column:
    return F.get(F.split(name, " "), F.lit(0))


def last_name(name: Column) -> Column:
    """The name without "<first> ", or "" when there is only a first name."""
    first = first_name(name)
    rest = F.replace(name, F.concat(first, F.lit(" ")), F.lit(""))
    return F.when(first == name, F.lit("")).otherwise(rest)


def page_ref(name: Column) -> Column:
    return F.concat(F.lit("a-"), F.regexp_replace(F.lower(name), "[ ']", "-"))


def page_link(ref: Column, text: Column) -> Column:
    return F.concat(
        F.lit('<a href="'), ref, F.lit(".html#"), ref, F.lit('">'), text, F.lit("</a>")
    )
