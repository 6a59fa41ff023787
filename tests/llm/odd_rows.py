"""Rows every operator must stand."""

from __future__ import annotations

# Nulls, empty, blank and very long texts, repeated rows,
# ties, and texts in several scripts.
LONG = "lorem ipsum dolor sit amet consectetur " * 2500
RARE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (4, LONG),
    (5, "a" * 5000),
    (None, "no id here, but a text of some words that goes on for a while"),
    (None, None),
    (6, "日本語のテキスト 😀 and more\n\n\nwords  with   runs"),
    (7, "short"),
    (8, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (9, "the quick brown fox jumps over the lazy dog near the river bank today"),
    (9, "another text with the same id as the one before it"),
    (10, "▁ odd <|endoftext|> mark \x00 and ﻿\n \nnumbers 12.5 and 4111 1111 1111 1111"),
    (11, "1" * 400 + " " + "1.2.3.4.5.6.7.8 a@b.c@d.e +1 (2) 3456789-"),
]
