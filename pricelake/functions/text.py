"""Text expressions. All stay inside whole-stage code generation: no UDF, no lambda."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from ..schemas import MISSING_TOKENS, NULL_TEXTS

# Java's \s is ASCII without (?U); the separators x1c-x1f count as blanks too.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"
# Blanks of one byte other than the space.
_CONTROLS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
# A character without case before a letter; and the first half of a mark that the data holds, so that it survives.
_WORD_BREAK = r"([^\p{LC} ])(?=\p{L}|(?<=\x01) )"
_MARK = "\u0001 "


def squash_blanks(c: Column) -> Column:
    """Runs of any Unicode white space become one space; none is left at the ends.

    The regular expression costs far more than the tests before it, and most texts do not need it:
    only those with two spaces in a row, a control character, or characters outside ASCII.
    """
    odd = c.contains("  ") | (F.octet_length(c) != F.length(c))
    for control in _CONTROLS:
        odd = odd | c.contains(control)
    return F.trim(F.when(odd, F.regexp_replace(c, _BLANKS, " ")).otherwise(c))


def title_words(c: Column) -> Column:
    """Capitalise every letter that follows a non-letter (``murang'a`` -> ``Murang'A``).

    ``initcap`` only starts a word after a space, so a mark ending in a space is put where another
    word starts and taken out again afterwards.
    """
    marked = F.regexp_replace(c, _WORD_BREAK, "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def missing_to_null(c: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def null_texts(c: Column, strict: bool = False) -> Column:
    """Texts that mean "missing" become NULL, in any case unless ``strict``."""
    if strict:
        return F.when(~c.isin(*NULL_TEXTS), c)
    return F.when(~F.lower(c).isin(*[t.lower() for t in NULL_TEXTS]), c)


def contains(c: Column, text: str) -> Column:
    """Case-insensitive contains that is false, not NULL, for a missing text."""
    escaped = re.sub(r"([\\%_])", r"\\\1", text)
    return F.coalesce(c.ilike(f"%{escaped}%"), F.lit(False))
