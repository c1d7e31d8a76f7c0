"""Column expressions for review text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII punctuation marks that are stripped from text.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The code points that separate words (ASCII and Unicode white space), first and last of each range.
SPACE_RANGES = [
    (0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
SPACES = "".join(chr(c) for first, last in SPACE_RANGES for c in range(first, last + 1))

WORD_WHOLE = "^[a-zA-Z]+$"
NUMBER = r"^[0-9]+\.?[0-9]*$|^\.[0-9]+$"


def plain(text: Column) -> Column:
    """``text`` with a blank for every separator and without punctuation, in one pass."""
    return F.translate(text, SPACES + PUNCTUATION, " " * len(SPACES))


def words(text: Column) -> Column:
    """Words of ``text`` without punctuation, as written."""
    return F.array_remove(F.split(plain(text), " "), "")


def starts_with_letter(word: Column) -> Column:
    first = F.ascii(word)
    return first.between(ord("a"), ord("z")) | first.between(ord("A"), ord("Z"))


def categories(text: Column) -> Column:
    """Trimmed comma list; null or empty text has no categories, an empty piece between commas is one."""
    pieces = F.transform(F.split(text, ","), lambda c: F.trim(c))
    return F.when(text.isNotNull() & (text != ""), pieces)


def quoted(items: Column, separator: str = ", ") -> Column:
    """``'a', 'b'``"""
    return F.array_join(F.transform(items, lambda i: F.concat(F.lit("'"), i.cast("string"), F.lit("'"))), separator)
