"""Column expressions for text: line splitting, space counting, tokenising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the tokeniser the reference uses) -------------
# Characters replaced by the split character before splitting, in the reference's order:
#   ! " # $ % & ( ) * + , - . / : ; < = > ? @ [ \ ] ^ _ ` { | } ~ TAB NEWLINE and the apostrophe
DEFAULT_FILTERS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'"
SPLIT = " "
# -----------------------------------------------------------------------------


def char_class(chars: str) -> str:
    """A Java/RE2 regex character class matching any one of ``chars``."""
    out = []
    for ch in chars:
        if ch == "\t":
            out.append("\\t")
        elif ch == "\n":
            out.append("\\n")
        elif ch in "\\[]^-":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "[" + "".join(out) + "]"


def count_char(col: Column, ch: str = " ") -> Column:
    """Occurrences of one character in a string column."""
    return F.length(col) - F.length(F.replace(col, F.lit(ch), F.lit("")))


def word_array(col: Column, filters: str = DEFAULT_FILTERS, lower: bool = True) -> Column:
    """Lower-case, map each filter character to the split character, split on it, drop empties."""
    c = F.lower(col) if lower else col
    if filters:
        c = F.regexp_replace(c, char_class(filters), SPLIT)
    return F.filter(F.split(c, SPLIT), lambda w: w != F.lit(""))
