"""Text expressions. All are native column expressions; none needs a Python worker."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.functions.sql import quoted

# The characters Python's str.strip() removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Named character references, as the standard library has them: name -> characters.
NAMED_ENTITIES = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}


def _windows_1252(number: int) -> str:
    try:
        return bytes([number]).decode("cp1252")
    except UnicodeDecodeError:  # five numbers stand for nothing there
        return chr(number)


# Numeric references to these mean what they mean in Windows-1252.
NUMBERS = {number: _windows_1252(number) for number in range(128, 160)}

ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"
# A script, style or comment with all it holds (to the end, if it is not closed), or one tag.
HTML_MARKUP = r"(?is)<(?:script\b.*?(?:</script\s*>|\z)|style\b.*?(?:</style\s*>|\z)|!--.*?(?:-->|\z)|/?[a-zA-Z!?][^>]*>)"
HTML_TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
URL_HEAD = r"^[\x00-\x20]+|[\t\r\n]"
WEB_NETLOC = r"(?i)^https?://([^/?#]+)"


def strip(text: Column) -> Column:
    """Remove surrounding whitespace, in the Unicode sense."""
    return F.btrim(text, F.lit(STRIP_CHARS))


def clean_whitespace(text: Column) -> Column:
    """Collapse runs of spaces, line feeds and no-break spaces to one space, then strip."""
    spaces = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\u00a0"), F.lit(" "))
    return strip(F.regexp_replace(spaces, " {2,}", " "))


def stripped(text: str) -> str:
    """:func:`strip` as SQL text."""
    return f"btrim({text}, {quoted(STRIP_CHARS)})"


def strip_fences(text: str) -> str:
    """Inner text of a whole-text Markdown code fence (with or without ``json``), else the stripped text.

    Takes and returns SQL text.
    """
    body = stripped(text)

    def inner(opening: str) -> str:
        return stripped(f"substring({body}, {len(opening) + 1}, length({body}) - {len(opening) + 3})")

    closed = f"endswith({body}, '```')"
    return (
        f"CASE WHEN startswith({body}, '```json') AND {closed} THEN {inner('```json')} "
        f"WHEN startswith({body}, '```') AND {closed} THEN {inner('```')} ELSE {body} END"
    )


def decode_entities(text: str) -> str:
    """Decode named and numeric character references, each distinct one once. Takes and returns SQL text.

    References to ``&`` come last, so nothing is decoded twice.
    """
    # names are looked up among those with the same first letter
    by_letter: dict[str, list[str]] = {}
    for name, char in NAMED_ENTITIES.items():
        by_letter.setdefault(name[0], []).append(f"{quoted(name)}, {quoted(char)}")
    maps = " ".join(f"WHEN {quoted(letter)} THEN try_element_at(map({', '.join(pairs)}), r)" for letter, pairs in by_letter.items())
    named_char = f"CASE substring(r, 1, 1) {maps} END"
    number = "cast(if(lower(substring(r, 2, 1)) = 'x', conv(substring(r, 3), 16, 10), substring(r, 2)) as bigint)"
    valid = f"{number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111"
    numbers = ", ".join(f"{number}L, {quoted(char)}" for number, char in NUMBERS.items())
    character = f"decode(unhex(lpad(hex(if({valid}, {number}, 65533L)), 8, '0')), 'UTF-32')"
    char = (
        f"CASE WHEN startswith(r, '#') THEN coalesce(try_element_at(map({numbers}), {number}), {character}) "
        f"ELSE {named_char} END"
    )
    references = f"array_distinct(regexp_extract_all({text}, {quoted(ENTITY)}, 1))"
    known = f"filter(transform({references}, r -> struct(r, {char} AS c)), p -> p.c IS NOT NULL)"
    ordered = f"array_sort({known}, (p, q) -> if(p.c = '&', 1, 0) - if(q.c = '&', 1, 0))"
    return f"aggregate({ordered}, {text}, (done, p) -> replace(done, concat('&', p.r, ';'), p.c))"


def visible_markup(markup: Column) -> Column:
    """Markup with scripts, styles, comments and tags replaced by spaces."""
    return F.regexp_replace(markup, HTML_MARKUP, " ")


def is_web_url(value: Column) -> Column:
    """True for ``http``/``https`` with a network location; false for NULL and for unbalanced brackets."""
    netloc = F.regexp_extract(F.regexp_replace(value, URL_HEAD, ""), WEB_NETLOC, 1)
    balanced = netloc.contains("[") == netloc.contains("]")
    return F.coalesce((netloc != "") & balanced, F.lit(False))


def safe_name(name: Column) -> Column:
    """Characters other than letters, digits, ``-`` and ``_`` become ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_")


def output_name(prefix: Column, format_name: Column, from_documents: Column) -> Column:
    """Base name of an output: ``{prefix}_{format}_from_docs`` or ``…_from_query``."""
    tail = F.when(from_documents, F.lit("_from_docs")).otherwise(F.lit("_from_query"))
    return F.concat(prefix, F.lit("_"), safe_name(format_name), tail)
