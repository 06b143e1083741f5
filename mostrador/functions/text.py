"""Text as column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Python's str.strip() takes for blank.
_BLANKS = "".join(char for char in map(chr, range(0x3001)) if char.isspace())
_ASCII_BLANKS = "".join(filter(str.isascii, _BLANKS))
# Where str.splitlines() ends a line.
_LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"
_IN_LINE = r"[^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
_FENCE = "```"


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column that later expressions use many times.

    Catalyst moves a filter below a projection by copying the projected expression into
    it, once per use. It cannot do that through a generator, so the value is made as one.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


@cache
def _character_table() -> tuple[str, str]:
    """Characters in one string, and in another what they become, the last ones nothing.

    Accented ones become the letter or digit they have at heart; combining marks go.
    """
    accented, plain, marks = [], [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) == "Mn":
            marks.append(char)
            continue
        bare = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if len(bare) == 1 and bare[0] != char and re.fullmatch("[a-z0-9]", bare[0]):
            accented.append(char)
            plain.append(bare[0])
    return "".join(accented + marks), "".join(plain)


def normalized(text: Column) -> Column:
    """Lower case, no accents, everything but letters and digits as single blanks."""
    lower = F.lower(text)
    # text of one byte per character has no accents to take off
    ascii_only = F.octet_length(text) == F.length(text)
    plain = F.when(ascii_only, lower).otherwise(F.translate(lower, *_character_table()))
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def as_key(text: Column) -> Column:
    """Normalised text with underscores: the form of a catalog name."""
    return F.translate(normalized(text), " ", "_")


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def one_line(text: Column) -> Column:
    """Every run of blanks as one space, none at the ends."""
    # a class of blanks beyond one byte is tested kind by kind, at every character
    ascii_only = F.octet_length(text) == F.length(text)
    short = F.regexp_replace(text, f"[{_ASCII_BLANKS}]+", " ")
    return F.trim(F.when(ascii_only, short).otherwise(F.regexp_replace(text, f"[{_BLANKS}]+", " ")))


def without_fence(answer: Column) -> Column:
    """A statement without a Markdown fence around it or semicolons after it."""
    text = stripped(answer)
    body = F.regexp_replace(text, f"^{_FENCE}{_IN_LINE}*{_LINE_END}?", "")
    # str.splitlines() sees no empty last line, so a final line end goes as well
    body = F.regexp_replace(body, f"(?:^|{_LINE_END}){_FENCE}{_IN_LINE}*$", "")
    body = F.regexp_replace(body, _LINE_END, "\n")
    unfenced = F.when(F.startswith(text, F.lit(_FENCE)), body).otherwise(text)
    return stripped(F.rtrim(stripped(unfenced), F.lit(";")))


# Fixed value: how a cluster job id looks in a log.
JOB_ID = r"application_\d+_\d+"


def last_match(log: Column, pattern: str = JOB_ID) -> Column:
    """The last occurrence of a pattern, null if there is none."""
    return F.try_element_at(F.regexp_extract_all(log, F.lit(pattern), F.lit(0)), F.lit(-1))
