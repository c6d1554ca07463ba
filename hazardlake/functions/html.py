"""HTML-to-text Column expressions (paragraphs, links).

Pages arrive as an ``html`` string column. Everything here is a JVM-side
regex expression evaluated per row inside whole-stage codegen: no parser
library, no Python. The patterns avoid look-around so the same text works in
Java regex and RE2 (the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake.functions.lookups import HTML_ENTITIES

# Blocks whose text is never page content.
NOISE_RE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
# A paragraph opens at <p> or <p attr=...> (not <pre>, <param>, ...).
P_OPEN_RE = r"(?i)<p(?:\s[^>]*)?>"
# An unclosed paragraph ends where a closing </p> or any block tag starts.
P_END_RE = (r"(?is)(?:</p>|</?(?:article|div|section|footer|nav|header|aside|"
            r"h[1-6]|ul|ol|table|body|html)\b).*$")
TAG_RE = r"(?s)<[^>]*>"
SPACE_RE = r"\s+"
HREF_RE = r"""(?i)<a\s[^>]*?href="([^"]*)\""""
SRC_RE = r"""(?i)<img\s[^>]*?src="([^"]*)\""""


NUMERIC_RE = r"&#(?:[xX][0-9a-fA-F]+|[0-9]+);"


def _numeric_char(ref: Column) -> Column:
    """Character of ``&#n;`` or ``&#xh;``; a reference to no character stays as it is."""
    digits = F.regexp_replace(ref, "[&#;]", "")
    n = F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substr(digits, F.lit(2)), 16, 10)).otherwise(
        digits).try_cast("int")
    valid = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, n)), 8, "0")), "UTF-32")
    return F.coalesce(char, ref)


def numeric_references(c: Column) -> Column:
    """Decode numeric character references; texts without one are left alone."""
    parts = F.split(c, NUMERIC_RE, -1)
    chars = F.transform(F.regexp_extract_all(c, F.lit(NUMERIC_RE), F.lit(0)), _numeric_char)
    joined = F.array_join(F.flatten(F.zip_with(parts, chars, lambda p, x: F.array(p, F.coalesce(x, F.lit(""))))), "")
    return F.when(c.rlike(NUMERIC_RE), joined).otherwise(c)


def unescape_entities(c: Column) -> Column:
    c = numeric_references(c)
    for entity, char in HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def clean_fragment(piece: Column) -> Column:
    """Text of one paragraph piece: cut at its end, drop tags, decode."""
    body = F.regexp_replace(piece, P_END_RE, "")
    body = F.regexp_replace(body, TAG_RE, " ")
    body = F.trim(F.regexp_replace(body, SPACE_RE, " "))
    return unescape_entities(body)


def paragraph_pieces(html: Column) -> Column:
    """Raw pieces after each ``<p>`` opening (array<string>, 0-based)."""
    stripped = F.regexp_replace(html, NOISE_RE, " ")
    parts = F.split(stripped, P_OPEN_RE)
    return F.filter(parts, lambda x, i: i > 0)


def paragraphs(html: Column) -> Column:
    """All paragraph texts of a page, in order, including empty ones."""
    return F.transform(paragraph_pieces(html), clean_fragment)


def page_text(html: Column, sep: str = "") -> Column:
    """Paragraph texts joined (the region-info text uses no separator)."""
    return F.array_join(paragraphs(html), sep)


def links(html: Column) -> Column:
    """``href`` targets of the anchors of a page, in document order; scripts and comments hold none."""
    return F.regexp_extract_all(F.regexp_replace(html, NOISE_RE, " "), F.lit(HREF_RE), 1)


def images_with_suffix(html: Column, suffix: str) -> Column:
    """``src`` targets of the images of a page that end in ``suffix``, in document order."""
    found = F.regexp_extract_all(F.regexp_replace(html, NOISE_RE, " "), F.lit(SRC_RE), 1)
    return F.filter(found, lambda x: F.endswith(x, F.lit(suffix)))


def links_with_suffix(html: Column, suffix: str) -> Column:
    return F.filter(links(html), lambda x: F.endswith(x, F.lit(suffix)))


def element_tag_re(tag: str) -> str:
    """Start and end tags of one element name (``div``, not ``divider``)."""
    return rf"(?i)</?{tag}(?:[\s/][^>]*)?>"


def first_element(html: Column, tag: str = "div") -> Column:
    """Markup inside the first ``tag`` element of a page, nested ones included; null without one.

    One fold over the page's ``tag`` tags keeps the depth: end tags before the first start tag count nothing, the
    element ends where the depth is back at zero, an unclosed one at the end of the page. Scripts,
    styles and comments are left out first.
    """
    clean = F.regexp_replace(html, NOISE_RE, " ")
    pattern = element_tag_re(tag)
    tags, parts = F.regexp_extract_all(clean, F.lit(pattern), F.lit(0)), F.split(clean, pattern, -1)

    def step(s, t):
        opens = ~F.startswith(t, F.lit("</"))
        first = F.when(opens & (s["first"] < 0), s["i"]).otherwise(s["first"])
        depth = F.when(first < 0, F.lit(0)).otherwise(s["depth"] + F.when(opens, 1).otherwise(-1))
        stop = F.when((first >= 0) & (s["stop"] < 0) & (depth == 0), s["i"]).otherwise(s["stop"])
        return F.struct((s["i"] + 1).alias("i"), depth.alias("depth"), first.alias("first"), stop.alias("stop"))

    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(-1).alias("first"), F.lit(-1).alias("stop"))
    found = F.aggregate(tags, start, step)

    def inside(f):
        n = F.when(f["stop"] >= 0, f["stop"]).otherwise(F.size(tags)) - f["first"]
        texts, between = F.slice(parts, f["first"] + 2, n), F.slice(tags, f["first"] + 2, n - 1)
        return F.when(f["first"] >= 0, F.array_join(
            F.zip_with(texts, between, lambda p, t: F.concat(p, F.coalesce(t, F.lit("")))), ""))

    # The fold runs once; its result is bound in a one-element array.
    return F.get(F.transform(F.array(found), inside), F.lit(0))
