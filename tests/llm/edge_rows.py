"""Rows that every operator must take."""

from __future__ import annotations

LONG = "long passage of words that goes on " * 20_000

#: Null and repeated ids, null, empty, blank and very long texts, repeated rows.
EDGE = [
    (None, "a text without an id, long enough for words", "en", None),
    (None, None, None, None),
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n ", None, "b"),
    (4, "one two three four five six", "en", "b"),
    (4, "one two three four five six", "en", "b"),
    (5, "one two three four five six", "de", "b"),
    (6, LONG, "en", "a"),
    (7, "word", "de", None),
]
