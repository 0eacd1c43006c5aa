"""Text expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.dictionaries import HTML_ENTITIES
from presswork.functions.binding import let

# --- Fixed values: patterns of a tag and of the host in an address.
TAG = r"<[^>]+>"
HOST = r"https?://(?:www\.)?([^/]+)"

#: Tags that begin or end a block of text, and a link.
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figure|figcaption|form|h[1-6]|header|hr|html"
    r"|li|main|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>"
)
LINK = r"(?is)<a\b[^>]*>(.*?)</a>"

UNICODE_SPACES = r"(?U)\s+"


def replace_tags(text: Column, replacement: str) -> Column:
    return F.regexp_replace(text, TAG, replacement)


def count_words(text: Column) -> Column:
    """Number of words between Unicode white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\S+")), F.lit(0))


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def url_id(url: Column) -> Column:
    return F.md5(url)


def domain_of(url: Column) -> Column:
    """Host without ``www.``; empty when the address is not http(s)."""
    return F.regexp_extract(url, HOST, 1)


def preview(text: Column, limit: int) -> Column:
    """First ``limit`` characters, marked with dots when something was cut."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def percentage(score: Column) -> Column:
    return F.format_string("%.2f%%", score * 100)


def clean_text(text: Column) -> Column:
    """Drop tags, turn white-space runs into one space, strip; null -> ''."""
    bare = replace_tags(F.coalesce(text, F.lit("")), "")
    return F.trim(F.regexp_replace(bare, UNICODE_SPACES, " "))


def _spell_numeric(text: Column) -> Column:
    numeric = r"&#([0-9]{1,7});"
    glyphs = F.transform(
        F.regexp_extract_all(text, F.lit(numeric), F.lit(1)),
        lambda n: F.decode(
            F.try_to_binary(F.lpad(F.hex(n.cast("int")), 8, "0"), F.lit("hex")), "UTF-32"
        ),
    )
    pieces = F.zip_with(
        F.split(text, numeric),
        glyphs,
        lambda piece, glyph: F.concat(piece, F.coalesce(glyph, F.lit(""))),
    )
    return F.when(text.contains("&#"), F.array_join(pieces, "")).otherwise(text)


def _unescaped(text: Column) -> Column:
    """All character references of the standard decoded, in Python."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        import html

        return pd.Series([None if t is None else html.unescape(t) for t in texts], dtype=object)

    return run(text)


def decode_entities(text: Column) -> Column:
    """Decode character references.

    Decimal ones and the usual names are expressions; ``&amp;`` goes last. Only texts with
    others, hexadecimal ones or any other name, go through the full table.
    """
    names = "|".join(r[1:] for r in [*HTML_ENTITIES, "&amp;"])
    others = text.rlike(rf"&(?!(?:{names}|#[0-9]{{1,7}};))(?:#[xX][0-9a-fA-F]|[a-zA-Z][a-zA-Z0-9]*;)")
    out = let(text, _spell_numeric)
    for reference, character in HTML_ENTITIES.items():
        out = F.replace(out, F.lit(reference), F.lit(character))
    usual = F.replace(out, F.lit("&amp;"), F.lit("&"))
    return F.when(others, _unescaped(F.when(others, text))).otherwise(usual)


def content_blocks(page: Column) -> Column:
    """Blocks of a page whose text is not mostly that of links, put together."""

    def holds_content(block: Column) -> Column:
        links = F.array_join(F.regexp_extract_all(block, F.lit(LINK), F.lit(1)), "")
        return 2 * F.length(replace_tags(links, "")) <= F.length(replace_tags(block, ""))

    return F.array_join(F.filter(F.split(page, BLOCK), holds_content), " ")


def _article_or_all(page: Column) -> Column:
    articles = F.regexp_extract_all(
        page, F.lit(r"(?is)<article\b[^>]*>(.*?)</article>"), F.lit(1)
    )
    return F.coalesce(F.nullif(F.array_join(articles, " "), F.lit("")), content_blocks(page))


def main_text(html: Column, min_words: int | None = None) -> Column:
    """Main text of a web page, ``''`` when there is none.

    Comments, scripts, styles and navigation are dropped; the ``<article>``
    elements are used when the page has any, else the blocks of the body that are not
    mostly links. With ``min_words`` a shorter text counts as a failed extraction.
    """
    kept = F.regexp_replace(
        html,
        r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
        r"|<nav\b.*?</nav>|<head\b.*?</head>|<footer\b.*?</footer>",
        " ",
    )
    text = decode_entities(replace_tags(let(kept, _article_or_all), " "))
    text = F.coalesce(F.trim(F.regexp_replace(text, UNICODE_SPACES, " ")), F.lit(""))
    if min_words is None:
        return text
    return let(text, lambda t: F.when(count_words(t) >= min_words, t).otherwise(F.lit("")))
