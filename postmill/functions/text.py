"""Text expressions, all native."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from postmill import constants as C

# White space beyond the ASCII kinds that a plain \s matches. Texts that have any are translated first;
# that keeps the patterns simple, which the regex engine rewards with several times the speed.
_CONTROL = "\x1c\x1d\x1e\x1f"
_WIDE = _CONTROL + (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE_CHARS = "\t\n\x0b\x0c\r " + _WIDE
_LINE_END = r"\r\n|[\n\x0B\x0C\r\x1C-\x1E\x85\u2028\u2029]"


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def null_if_blank(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def contains_any(col: Column, parts: Sequence[str]) -> Column:
    """Whether any of the fixed parts occurs in the text."""
    hit = F.lit(False)
    for part in parts:
        hit = hit | F.contains(col, F.lit(part))
    return hit


def plain_space(col: Column) -> Column:
    """Every wide white space as a blank."""

    def plain(text: Column) -> Column:
        is_ascii = F.octet_length(text) == F.length(text)
        wide = F.when(is_ascii, contains_any(text, _CONTROL)).otherwise(contains_any(text, _WIDE))
        return F.when(wide, F.translate(text, _WIDE, " " * len(_WIDE))).otherwise(text)

    return bind(col, plain)


def strip(col: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.trim(col, F.lit(_SPACE_CHARS))


def word_count(col: Column) -> Column:
    """Words between white space; null counts as no words."""
    return F.regexp_count(plain_space(blank_if_null(col)), F.lit(r"\S+")).cast("bigint")


def collapse_space(col: Column) -> Column:
    return F.trim(F.regexp_replace(plain_space(col), r"\s+", " "))


def marker_hits(col: Column, parts: Sequence[str]) -> Column:
    """How many of the fixed parts occur in the text."""
    total = F.lit(0)
    for part in parts:
        total = total + F.contains(col, F.lit(part)).cast("int")
    return total


def slug(col: Column, max_len: int = C.SLUG_CHARS) -> Column:
    """A lower-case name with dashes, safe for file names."""
    kept = F.regexp_replace(strip(plain_space(F.lower(col))), r"[^\p{L}\p{N}_\s-]", "")
    dashed = F.regexp_replace(kept, r"[\s_-]+", "-")
    return F.substring(F.regexp_replace(dashed, r"^-|-\z", ""), 1, max_len)


def keywords(col: Column) -> Column:
    """Distinct words of four or more letters or digits, without the stop words."""
    words = F.regexp_extract_all(F.lower(blank_if_null(col)), F.lit("[a-z0-9]{4,}"), F.lit(0))
    return F.array_except(words, F.array(*[F.lit(w) for w in C.TITLE_STOP_WORDS]))


def unescape_marks(col: Column) -> Column:
    return F.replace(F.replace(col, F.lit("\\:"), F.lit(":")), F.lit("\\;"), F.lit(";"))


def clean_lines(col: Column) -> Column:
    """Trimmed lines without blank and noise lines, as an array."""
    lines = F.transform(F.split(unescape_marks(col), _LINE_END), strip)
    noise = [F.lit(line) for line in C.NOISE_LINES]
    return F.filter(lines, lambda x: (x != "") & ~F.lower(x).isin(*noise))


def clean_text(col: Column) -> Column:
    return F.array_join(clean_lines(col), "\n")


def cap_description(col: Column) -> Column:
    return F.substring(col, 1, C.MAX_DESCRIPTION_CHARS)


def org_abbrev(name: Column) -> Column:
    """The first bracketed part of an organisation name, else its first word in capitals."""
    bracketed = F.regexp_extract(name, r"\[([^\]]+)\]", 1)
    first_word = F.regexp_extract(plain_space(name), r"\S+", 0)
    return F.coalesce(null_if_blank(bracketed), F.upper(first_word))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with a +00:00 offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def section_text(sections: Sequence[tuple[str, Column]], title: Column, reference: Column) -> Column:
    """Headed sections that have text, under a title/reference header if there are any."""
    body = F.concat_ws(
        "\n\n",
        *[F.when(text != "", F.concat(F.lit(f"{head}\n"), text)) for head, text in sections],
    )
    header = F.concat_ws(
        "\n",
        *[null_if_blank(strip(blank_if_null(part))) for part in (title, reference)],
    )
    return F.when(body != "", F.concat_ws("\n\n", null_if_blank(header), body)).otherwise("")
