"""Marker-weighted scores."""

from pyspark.sql import Column, functions as F

from postmill import constants as C
from postmill.functions.text import contains_any, keywords, marker_hits, word_count


def pdf_score(url: Column, text: Column, context: Column, title_words: Column) -> Column:
    """How likely a PDF link is the posting itself. `title_words` comes from `keywords`."""
    low_url = F.lower(url)
    blob = F.lower(F.concat_ws(" ", url, text, context))
    overlap = F.size(F.array_intersect(title_words, keywords(blob)))
    return (
        F.contains(low_url, F.lit(".pdf")).cast("int") * 60
        + F.contains(blob, F.lit("download")).cast("int") * 15
        + marker_hits(blob, C.PDF_POSITIVE_MARKERS) * 45
        - marker_hits(blob, C.PDF_NEGATIVE_MARKERS) * 120
        - F.contains(low_url, F.lit(".doc")).cast("int") * 200
        - F.contains(blob, F.lit("application form")).cast("int") * 120
        + F.least(F.lit(120), overlap * 20)
    )


def fragment_score(text: Column) -> Column:
    low = F.lower(text)
    return (
        word_count(text)
        + marker_hits(low, C.SECTION_MARKERS) * 400
        - marker_hits(low, C.SECTION_NOISE) * 120
    )


def leaf_score(path: Column, text: Column) -> Column:
    low = F.lower(text)
    confirm_list = F.contains(low, F.lit("job list")) & F.contains(low, F.lit("confirm"))
    return (
        word_count(text)
        + contains_any(path, C.LEAF_PATH_MARKERS).cast("int") * 250
        - contains_any(low, C.LEAF_NOISE).cast("int") * 500
        - confirm_list.cast("int") * 500
    )
