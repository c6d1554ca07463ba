"""Text Column expressions: sentences, tokens, places.

All regexes are shared-dialect (no look-around) so the SQL oracle can use
the very same strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlake.functions.lookups import COMPASS_WORDS

# A sentence runs to its terminal punctuation plus trailing space, or to the
# end of the text.
SENTENCE_RE = r"(?s).+?(?:[.!?]+(?:\s+|$)|$)"
STRIP_RE = r"^\s+|\s+$"
TOKEN_RE = r"[\p{L}\p{N}]+"
# "12 km NNE of Chardonniere, Haiti" -> 12 / NNE / Chardonniere, Haiti
PLACE_RE = r"^(\d+) km ([NSEW]{1,3}) of (.+)$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, STRIP_RE, "")


def sentences(text: Column) -> Column:
    """Sentences of one text block, stripped, empties removed."""
    raw = F.regexp_extract_all(text, F.lit(SENTENCE_RE), 0)
    return F.filter(F.transform(raw, strip), lambda s: s != "")


def line_sentences(text: Column) -> Column:
    """Sentences of a multi-line text, split line by line, in order."""
    lines = F.split(text, "\n")
    return F.flatten(F.transform(lines, sentences))


def word_count(s: Column) -> Column:
    """Pieces of ``s`` split on single spaces (the min-words rule)."""
    return F.size(F.split(s, " "))


def has_min_words(s: Column, min_words: int = 2) -> Column:
    return word_count(s) >= min_words


def tokens(text: Column, lowercase: bool = True) -> Column:
    """Letter/digit tokens, punctuation dropped."""
    src = F.lower(text) if lowercase else text
    return F.regexp_extract_all(src, F.lit(TOKEN_RE), 0)


def whitespace_tokens(text: Column, lowercase: bool = True) -> Column:
    """Whitespace tokens with punctuation attached (title keyword rule)."""
    src = F.lower(text) if lowercase else text
    return F.split(src, r"\s+")


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def country_of(place: Column) -> Column:
    """Last ``", "``-separated part of a place (whole string if none)."""
    return F.element_at(F.split(place, ", "), -1)


def place_parts(place: Column) -> Column:
    """struct(distance_km, direction, city); all null when unparsable."""
    ok = place.rlike(PLACE_RE)
    return F.struct(
        F.when(ok, F.regexp_extract(place, PLACE_RE, 1).try_cast("int")).alias("distance_km"),
        F.when(ok, F.regexp_extract(place, PLACE_RE, 2)).alias("direction"),
        F.when(ok, F.regexp_extract(place, PLACE_RE, 3)).alias("city"),
    )


def compass_word(abbrev: Column) -> Column:
    """Decode a 1-3 letter compass abbreviation; unknown -> null."""
    pairs = []
    for k, v in COMPASS_WORDS.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), abbrev)


def compass_abbrevs() -> Column:
    return F.array(*[F.lit(k) for k in COMPASS_WORDS])


def query_string(base: str, params: dict[str, Column | str | int | float]) -> Column:
    """``base`` + ``k=v`` parameters joined by ``&`` (values rendered as text)."""
    parts = [F.concat(F.lit(f"{k}="), (v if isinstance(v, Column) else F.lit(v)).cast("string"))
             for k, v in params.items()]
    return F.concat(F.lit(base), F.concat_ws("&", *parts))


def phrase_query(term: Column, word: str = "earthquake") -> Column:
    """``+("earthquake" AND "<term>")`` (the news search phrase)."""
    return F.concat(F.lit(f'+("{word}" AND "'), term, F.lit('")'))
