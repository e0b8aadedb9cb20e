"""Status predicates and failure classes."""

from pyspark.sql import Column, functions as F

from postmill import constants as C
from postmill.functions.text import blank_if_null, contains_any, strip, word_count
from postmill.functions.urls import url_host


def has_js_marker(text: Column) -> Column:
    return contains_any(F.lower(text), C.NEEDS_JS_MARKERS)


def is_short(text: Column) -> Column:
    """Too little text, too few words, or a page that only asks for JavaScript."""
    few = (F.length(strip(text)) < C.MIN_CHARS) | (word_count(text) < C.MIN_WORDS)
    return few | has_js_marker(text)


def needs_rendering(url: Column, text: Column, asks_for_js: Column, browser_host: Column) -> Column:
    """Whether a page wants a browser: by text, by host or by what its HTML says."""
    return has_js_marker(text) | F.contains(url_host(url), F.lit("oraclecloud")) | browser_host | asks_for_js


def asks_for_js(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit("enable javascript"))


def looks_blocked(html: Column, status_code: Column) -> Column:
    by_code = F.coalesce(status_code.isin(*C.BLOCK_STATUS_CODES), F.lit(False))
    return by_code | contains_any(F.lower(html), C.BLOCK_MARKERS)


def is_enriched(status: Column, content_type: Column) -> Column:
    return F.when(status != "", status.isin(*C.DONE_STATUSES)).otherwise(content_type.isin(*C.DONE_TYPES))


def is_successful(status: Column, description: Column) -> Column:
    state = F.lower(strip(blank_if_null(status)))
    return (strip(blank_if_null(description)) != "") & state.isin(*C.SUCCESS_STATUSES)


def is_usable_row(url: Column, title: Column) -> Column:
    return (strip(blank_if_null(url)) != "") & (strip(blank_if_null(title)) != "")


def has_listing_detail(trusted: Column, description: Column) -> Column:
    """A trusted organisation's listing already carries a full description."""
    text = strip(blank_if_null(description))
    return trusted & (word_count(text) >= C.MIN_WORDS) & (F.length(text) >= C.MIN_CHARS)


def classify_error(message: Column) -> Column:
    """Struct (status, reason) of a failure message."""
    low = F.lower(message)

    def pair(status: str, reason: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))

    chain = None
    for status, reason, parts in C.ERROR_CLASSES:
        hit, value = contains_any(low, parts), pair(status, reason)
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain.otherwise(pair(*C.OTHER_ERROR))


def retry_delay(attempt: Column, status_code: Column, retry_after: Column, now: Column) -> Column:
    """Seconds until a failed attempt may be repeated; null when it may not."""
    backoff = F.pow(F.lit(2.0), attempt)
    seconds = retry_after.try_cast("double")
    undated = F.regexp_replace(retry_after, r"^\s*[A-Za-z]+,\s*", "")
    due = F.coalesce(
        F.try_to_timestamp(undated, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(undated, F.lit("d MMM yyyy HH:mm:ss xx")),
    )
    wait = (F.unix_micros(due) - F.unix_micros(now)) / F.lit(1e6)
    asked = F.coalesce(
        F.when(F.isnan(seconds), F.lit(0.0)).when(seconds.isNotNull(), F.greatest(seconds, F.lit(0.0))),
        F.when(wait.isNotNull(), F.greatest(wait, F.lit(0.0))),
        backoff,
    )
    told = (status_code == 429) & (blank_if_null(retry_after) != "")
    delay = F.when(F.coalesce(told, F.lit(False)), asked).otherwise(backoff)
    return F.when(attempt < C.RETRYABLE_ATTEMPTS, delay)
