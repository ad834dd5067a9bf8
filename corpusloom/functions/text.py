"""Text segmentation as string rewriting.

A text is turned into its *segmented* form by a fixed number of linear regex
passes over the whole string.  In it, one character separates each level:

=============  ==========================================
``\\n``         between paragraphs
``SENTENCE``   between sentences of a paragraph
a blank        between tokens that were apart in the text
``GLUE``       between tokens that touched in the text
=============  ==========================================

Paragraphs and sentences without a token do not occur, so positions count kept
ones only.  Reading a level is one ``split``; nothing is done per token in an
interpreted lambda and all of it stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes (used inside brackets), marks, patterns.
BLANK = r"\t\x0B\f\r\p{Z}"
CONTROL = r"\x00-\x08\x0E-\x1F\x7F-\x9F"
WORD = r"\p{L}\p{M}\p{N}"
SENTENCE = "\u0001"
GLUE = "\u0002"
ABBREVIATIONS = "Dr|Mr|Mrs|Ms|Prof|St|vs|etc"
CLOSERS = r"""["'”’)\]]*"""
OPENERS = r"""[\p{Lu}\p{N}"'“‘(\[]"""
JOINERS = r"['’.\-]"
WORD_PATTERN = rf"[{WORD}]+(?:{JOINERS}[{WORD}]+)*"
SENTENCE_PATTERN = rf"([.!?…]{CLOSERS})[{BLANK}]+({OPENERS})"
VISIBLE_PATTERN = rf"[^{BLANK}\n{CONTROL}]"


def _sub(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(replacement))


def _swap(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def _without_controls(text: Column) -> Column:
    """Control characters belong to no token, but they end one.

    Next to a blank they vanish, elsewhere they are a place where two tokens
    touch.  Few texts hold any, and finding that out is cheap.
    """
    slow = _sub(text, f"[{CONTROL}]+", GLUE)
    slow = _sub(slow, rf"{GLUE}?[{BLANK}][{BLANK}{GLUE}]*", " ")
    return F.when(text.rlike(r"[\p{Cc}&&[^\t\n\x0B\f\r]]"), slow).otherwise(text)


def _mark_sentences(col: Column) -> Column:
    """Cut after a full stop and its closers, unless it ends an abbreviation."""
    guard = rf"(?<!(?:^|[^{WORD}])(?:{ABBREVIATIONS})\.)"
    return _sub(col, rf"([.!?…]{guard}{CLOSERS}) (?={OPENERS})", "$1" + SENTENCE)


def segmented(text: Column, sentences: bool = True) -> Column:
    """The segmented form of ``text``; empty when it holds no token.

    Blanks already stand between words; what is added is a mark on both sides
    of every symbol, save those inside a word, after which marks next to a
    blank or to the edge of a line or sentence are dropped.
    """
    col = _sub(_without_controls(F.coalesce(text, F.lit(""))), f"[{BLANK}]+", " ")
    if sentences:
        col = _mark_sentences(col)
    symbol = rf"[^{WORD} \n{SENTENCE}{GLUE}](?!(?<=[{WORD}]{JOINERS})[{WORD}])"
    col = _sub(col, symbol, f"{GLUE}$0{GLUE}")
    col = F.concat(F.lit("\n"), col, F.lit("\n"))
    # Between two tokens stand at most three marks.
    for old, new in (
        (GLUE * 2, GLUE), (GLUE * 2, GLUE), (GLUE + " ", " "), (" " + GLUE, " "),
        (GLUE + SENTENCE, SENTENCE), (SENTENCE + GLUE, SENTENCE), (GLUE + "\n", "\n"), (" \n", "\n"),
    ):
        col = _swap(col, old, new)
    return F.btrim(_sub(col, rf"\n[ \n{GLUE}]+", "\n"), F.lit("\n"))


def paragraphs(segmented_text: Column) -> Column:
    """Array of segmented paragraphs; one empty entry for a text without tokens."""
    return F.split(segmented_text, "\n")


def sentences(paragraph: Column) -> Column:
    """Array of segmented sentences of one paragraph."""
    return F.split(paragraph, SENTENCE)


def tokens(sentence: Column) -> Column:
    """Array of tokens of one sentence; a touching one starts with ``GLUE``."""
    return F.split(_swap(sentence, GLUE, " " + GLUE), " ")


def vertical(paragraph: Column) -> Column:
    """One token per line with ``<p>``, ``<s>`` and ``<g/>`` marks."""
    body = _swap(paragraph, " ", "\n")
    body = _swap(body, GLUE, "\n<g/>\n")
    body = _swap(body, SENTENCE, "\n</s>\n<s>\n")
    return F.concat(F.lit("<p>\n<s>\n"), body, F.lit("\n</s>\n</p>\n"))


def paragraph_key(paragraph: Column) -> Column:
    """128-bit content key of a segmented paragraph, as hexadecimal text."""
    return F.md5(vertical(paragraph))


def raw_paragraphs(text: Column) -> Column:
    """Lines of ``text`` that hold a token, in the order of :func:`paragraphs`."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: line.rlike(VISIBLE_PATTERN))
