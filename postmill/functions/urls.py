"""Address expressions. Native wherever the answer needs no general resolution."""

import sys
from urllib.parse import unquote, urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from postmill.functions.text import null_if_blank

# Executors need no copy of this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*"
_PLAIN_HOST = r"[!-.0-9:;=@-Z_a-z~]+"
_TAIL = r"(?:\?[^\s#]+)?(?:#\S+)?"


def _tidy(url: Column) -> Column:
    """Without leading control characters and inner line breaks or tabs."""
    return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(url), rf"^({_SCHEME}):", 1))


def url_authority(url: Column) -> Column:
    return F.regexp_extract(_tidy(url), rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def url_host(url: Column) -> Column:
    """The lower-case authority, with port and user if given."""
    return F.lower(url_authority(url))


def url_path(url: Column) -> Column:
    path = F.regexp_extract(_tidy(url), rf"^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*\z", "")


def url_fragment(url: Column) -> Column:
    return F.regexp_extract(_tidy(url), r"^[^#]*#(.*)\z", 1)


def prefix_url(href: Column, base: Column) -> Column:
    """Plain prefixing: only an address starting with http stays as it is."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


@F.arrow_udf(T.StringType())
def _resolve(base: pa.Array, href: pa.Array) -> pa.Array:
    pairs = zip(base.to_pylist(), href.to_pylist())
    return pa.array([None if h is None else urljoin(b or "", h) for b, h in pairs], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _resolve_all(base: pa.Array, hrefs: pa.Array) -> pa.Array:
    rows = [
        None if row is None else [None if h is None else urljoin(b or "", h) for h in row]
        for b, row in zip(base.to_pylist(), hrefs.to_pylist())
    ]
    return pa.array(rows, pa.list_(pa.string()))


def _site_root(base: Column) -> Column:
    return F.regexp_extract(base, rf"^(https?://{_PLAIN_HOST})(?:[/?#]|\z)", 1)


def _simple_join(root: Column, href: Column) -> Column:
    """Absolute and root-relative references; null for all others."""
    absolute = F.rlike(href, F.lit(rf"^https?://{_PLAIN_HOST}(?:/[^\s?#;]*)?{_TAIL}\z"))
    rooted = F.rlike(href, F.lit(rf"^/(?!/)[^\s?#;]*{_TAIL}\z"))
    dotted = F.rlike(href, F.lit(r"^[^?#]*/\.{1,2}(?:[/?#]|\z)"))
    return F.when(absolute, href).when((root != "") & rooted & ~dotted, F.concat(root, href))


def join_url(base: Column, href: Column) -> Column:
    """Resolve a reference against a base address (RFC 3986)."""
    simple = _simple_join(_site_root(base), href)
    return F.coalesce(simple, _resolve(base, F.when(simple.isNull(), href)))


def join_urls(base: Column, hrefs: Column) -> Column:
    """`join_url` for every item of an array."""
    root = _site_root(base)
    rest = F.transform(hrefs, lambda h: F.when(_simple_join(root, h).isNull(), h))
    return F.zip_with(
        hrefs, _resolve_all(base, rest), lambda h, full: F.coalesce(full, _simple_join(root, h))
    )


@F.arrow_udf(T.StringType())
def _unquote(text: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unquote(t) for t in text.to_pylist()], pa.string())


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves + and broken escapes alone."""
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.coalesce(decoded, _unquote(F.when(decoded.isNull(), text)))


def table_row_index(url: Column) -> Column:
    """The row number in a fragment such as #row-42, else null."""
    return null_if_blank(F.regexp_extract(url_fragment(url), r"row-(\d+)\z", 1)).try_cast("bigint")


def facet_detail_url(base_url: Column, api_url: Column, path: Column) -> Column:
    """Detail address of a facet-search posting; the site comes from the API address."""
    parts = F.split(F.regexp_replace(api_url, r"/+\z", ""), "/")
    site = F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2))).otherwise("External")
    prefix = F.concat(F.lit("/"), site)
    rooted = F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    inside = F.startswith(rooted, F.concat(prefix, F.lit("/")))
    return F.concat(base_url, F.when(inside, rooted).otherwise(F.concat(prefix, rooted)))


def detail_api_url(url: Column) -> Column:
    """JSON address behind a `/{site}/job/{slug}` posting page, else empty."""
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/+\z", ""), r"/apply\z", "")
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    at = F.array_position(parts, "job").cast("int")
    before = F.get(parts, at - 2)
    is_locale = F.rlike(before, F.lit(r"(?i)^[a-z]{2}-[a-z]{2}\z")) & (at >= 3)
    site = F.when(is_locale, F.get(parts, at - 3)).otherwise(before)
    rest = F.array_join(F.slice(parts, at + 1, F.greatest(F.size(parts) - at, F.lit(0))), "/")
    host = url_authority(url)
    tenant = F.lower(F.substring_index(host, ".", 1))
    built = F.concat(
        url_scheme(url), F.lit("://"), host, F.lit("/wday/cxs/"), tenant,
        F.lit("/"), site, F.lit("/job/"), rest,
    )
    return F.when((at >= 2) & (F.size(parts) > at), built).otherwise("")


def vacancy_number(url: Column) -> Column:
    """Number in `/vacancies/{n}`, else null."""
    return null_if_blank(F.regexp_extract(url_path(url), r"/vacancies/(\d+)", 1)).try_cast("bigint")


def vacancy_key(url: Column) -> Column:
    """Hexadecimal key in `/vacancy/{key}`, else empty."""
    return F.regexp_extract(url_path(url), r"(?i)/vacancy/([0-9a-f]{16,32})", 1)


def site_url(url: Column, path: Column) -> Column:
    """Scheme and authority of an address with another path."""
    return F.concat(url_scheme(url), F.lit("://"), url_authority(url), path)


def content_kind(url: Column, header: Column | None = None) -> Column:
    """`pdf` by suffix or by the landed Content-Type header, else `html`."""
    is_pdf = F.lower(url).endswith(".pdf")
    if header is not None:
        is_pdf = is_pdf | F.coalesce(F.contains(F.lower(header), F.lit("application/pdf")), F.lit(False))
    return F.when(is_pdf, "pdf").otherwise("html")


def is_legacy_ats(url: Column) -> Column:
    low = F.lower(url)
    return F.contains(low, F.lit("/careersection/")) & F.contains(low, F.lit("jobdetail.ftl"))


def run_path(*parts: Column | str) -> Column:
    """Slash-joined artifact path."""
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def spread_blank(url: Column, *ids: str) -> Column:
    """Join key of an address. Blank ones match nothing, so each gets a value of its own."""
    return F.when(url == "", F.concat(F.lit(" "), F.xxhash64(*ids).cast("string"))).otherwise(url)
