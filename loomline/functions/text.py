"""Text rules: lossy UTF-8, Unicode strip, words, HTML escape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points str.strip() removes, as ranges and as text.
SPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
SPACES = "".join(chr(c) for low, high in SPACE_RANGES for c in range(low, high + 1))
SPACE_CLASS = "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in SPACE_RANGES)

# The same 29 in the form Java's regex tests fastest.
_SPACE_RUN = r"(?U)[\s\x{1C}-\x{1F}]+"

BOM = "\ufeff"


def lossy_utf8(raw: Column) -> Column:
    """Bytes (or unchecked text) to valid text; bad sequences become U+FFFD."""
    return F.make_valid_utf8(raw.cast("string"))


def strip_space(text: Column) -> Column:
    """trim with its own character set: it looks at the edges only."""
    return F.btrim(text, F.lit(SPACES))


def has_ink(text: Column) -> Column:
    """True when something is left after a strip."""
    return text.rlike(f"[^{SPACE_CLASS}]")


def words(text: Column) -> Column:
    """Words of a stripped, non-empty text."""
    return F.split(text, _SPACE_RUN)


def html_escape(text: Column) -> Column:
    # The five characters and their entities; & must come first.
    for char, entity in (
        ("&", "&amp;"),
        ("<", "&lt;"),
        (">", "&gt;"),
        ('"', "&quot;"),
        ("'", "&#x27;"),
    ):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text
