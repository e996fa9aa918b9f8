"""Text cleaning and name pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreline.schemas import PSEUDONYM_HEX_DIGITS

# Every character that counts as white space around a name, not only the blank.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def upper_trim(text: Column) -> Column:
    return F.upper(F.trim(text))


def is_padded(text: Column) -> Column:
    """Has blanks at either end."""
    return F.length(text) != F.length(F.trim(text))


def is_blank(text: Column) -> Column:
    """NULL or the empty string."""
    return text.isNull() | (text == "")


def pseudonym(name: Column) -> Column:
    """Leading hex digits of the SHA-256 of the bare lower-case name; NULL stays NULL."""
    bare = F.lower(F.btrim(name, F.lit(WHITE_SPACE)))
    return F.substring(F.sha2(bare, 256), 1, PSEUDONYM_HEX_DIGITS)
