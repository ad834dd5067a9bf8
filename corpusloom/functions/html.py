"""HTML to text blocks as string rewriting, one page per row.

Patterns are linear in the page: what is not closed runs to the end (a head to
the body), and tags hold no ``<``, so no piece of text is tried twice.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

# Elements without readable text, block-level elements.
SILENT_PATTERNS = (
    r"(?s)<!--.*?(?:-->|\z)",
    r"(?is)<script(?:\s[^<>]*)?>.*?(?:</script\s*>|\z)",
    r"(?is)<style(?:\s[^<>]*)?>.*?(?:</style\s*>|\z)",
    r"(?is)<head(?:\s[^<>]*)?>.*?(?:</head\s*>|(?=<body[\s>])|\z)",
    r"(?is)<noscript(?:\s[^<>]*)?>.*?(?:</noscript\s*>|\z)",
    r"(?is)<template(?:\s[^<>]*)?>.*?(?:</template\s*>|\z)",
    r"(?is)<svg(?:\s[^<>]*)?>.*?(?:</svg\s*>|\z)",
)
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|button|caption|center|dd|details|dialog|dir|div|dl"
    "|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|legend|li|main"
    "|menu|nav|ol|option|p|pre|section|select|summary|table|tbody|td|textarea|tfoot|th|thead|tr|ul"
)
# Every named entity of HTML, by name without marks; a soft hyphen is no text.
ENTITIES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")} | {"shy": "", "nbsp": " ", "NewLine": " "}
OPEN = "\u0001"
CLOSE = "\u0002"
SPACES = r"[ \t\x0B\f\r\x{00A0}]+"
TITLE_PATTERN = r"(?is)<head>.*?<title>(.*?)</title>.*?</head>"
# The same from the first head on, which is the only one that can match, and
# without going back, which could not help: linear in the page.
FROM_HEAD = r"(?is)<head>.*\z"
TITLE_ATOMIC = r"(?is)\A<head>(?>.*?<title>)(?>(.*?)</title>)(?>.*?</head>)"


def _sub(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(replacement))


def _swap(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def is_html(payload: Column, content_type: Column | None) -> Column:
    """The payload opens with the HTML doctype or is declared as HTML."""
    opens = F.startswith(payload, F.lit("<!DOCTYPE html"))
    if content_type is not None:
        opens = opens | F.contains(F.coalesce(content_type, F.lit("unknown")), F.lit("text/html"))
    return (F.length(payload) > 0) & opens


def title_of(html: Column) -> Column:
    """Title text, ``Unknown`` where there is none; entities stay as written."""
    head = F.regexp_substr(html, F.lit(FROM_HEAD))
    found = F.when(head.rlike(TITLE_ATOMIC), head)
    clean = F.translate(F.regexp_extract(found, TITLE_ATOMIC, 1), '"\n', "'")
    return F.coalesce(clean, F.lit("Unknown"))


def _numeric(name: Column) -> Column:
    """Character named by ``#NNN`` or ``#xHHH``, null for anything else."""
    hexadecimal = F.regexp_extract(name, "^#[xX]0*([0-9a-fA-F]{1,6})$", 1)
    decimal = F.regexp_extract(name, "^#0*([0-9]{1,7})$", 1)
    code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(F.nullif(decimal, F.lit(""))).cast("int")
    valid = F.when(code.between(32, 55295) | code.between(57344, 1114111), code)
    return F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")


def decode_entities(col: Column) -> Column:
    """Decode named and numeric entities, each once.

    The text is cut at ampersands, so the work grows with their number.
    """
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")

    def decoded(piece: Column, i: Column) -> Column:
        name = F.regexp_extract(piece, "^([a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);", 1)
        char = F.when(F.startswith(name, F.lit("#")), _numeric(name)).when(name != "", F.try_element_at(names, name))
        known = F.concat(char, F.substr(piece, F.length(name) + 2))
        return F.when(i == 0, piece).otherwise(F.coalesce(known, F.concat(F.lit("&"), piece)))

    return F.array_join(F.transform(F.split(col, "&"), decoded), "")


def _close_links_per_block(col: Column) -> Column:
    """Repeat link marks so that a link over several blocks marks each of them."""
    def closed(piece: Column, i: Column) -> Column:
        linked = F.substring_index(piece, CLOSE, 1)
        rest = F.substr(piece, F.length(linked) + 1)
        every = F.concat(_swap(linked, "\n", CLOSE + "\n" + OPEN), rest)
        # A link that is never closed ends with its block.
        until_end = _sub(piece, r"^([^\n]*)", "$1" + CLOSE)
        inside = F.when(F.contains(piece, F.lit(CLOSE)), every).otherwise(until_end)
        return F.when(i == 0, piece).otherwise(F.concat(F.lit(OPEN), inside))

    return F.array_join(F.transform(F.split(col, OPEN), closed), "")


def marked_text(html: Column) -> Column:
    """Visible text with one block per line and links between two marks."""
    col = F.translate(html, OPEN + CLOSE + "\n", "  " + " ")
    for pattern in SILENT_PATTERNS:
        col = _sub(col, pattern, "")
    col = _sub(col, r"(?i)<a(?:\s[^<>]*)?>", OPEN)
    col = _sub(col, r"(?i)</a\s*>", CLOSE)
    col = _sub(col, rf"(?i)</?(?:{BLOCK_TAGS})(?:[\s/][^<>]*)?>", "\n")
    col = _sub(col, r"<[/!?a-zA-Z][^<>]*>", "")
    return decode_entities(col)


def block_lines(html: Column) -> Column:
    """Array of the blocks of a page in order, link marks still inside."""
    col = _close_links_per_block(marked_text(html))
    col = _sub(col, SPACES, " ")
    lines = F.split(col, "\n")
    return F.filter(lines, lambda line: line.rlike(rf"[^ {OPEN}{CLOSE}]"))


def plain(line: Column) -> Column:
    """A block without link marks."""
    rewritten = F.regexp_replace(F.translate(line, OPEN + CLOSE, ""), "  +", " ")
    marked = F.contains(line, F.lit(OPEN)) | F.contains(line, F.lit(CLOSE)) | F.contains(line, F.lit("  "))
    return F.btrim(F.when(marked, rewritten).otherwise(line))


def word_count(line: Column) -> Column:
    return F.regexp_count(line, F.lit("[^ ]+"))


def plain_words(text: Column) -> Column:
    """Number of words of a :func:`plain` block, which holds single blanks between words."""
    return F.when(text == "", 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def link_words(line: Column) -> Column:
    """Number of words inside links."""
    pieces = F.regexp_extract_all(line, F.lit(f"{OPEN}([^{CLOSE}]*)"), F.lit(1))
    return F.when(F.contains(line, F.lit(OPEN)), word_count(F.array_join(pieces, " "))).otherwise(0)


def is_content(nw, ld, prev_nw, prev_ld, next_nw) -> Column:
    """Word-count and link-density rule of Kohlschütter et al. (WSDM 2010).

    Fixed values as published; neighbours that do not exist count as zero.
    """
    after_text = (nw > 16) | (next_nw > 15) | (prev_nw > 4)
    after_links = (nw > 40) | (next_nw > 17)
    rule = F.when(prev_ld <= F.lit(5.0 / 9.0), after_text).otherwise(after_links)
    return (ld <= F.lit(1.0 / 3.0)) & rule
