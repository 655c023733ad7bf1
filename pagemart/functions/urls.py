"""URL helpers as column expressions.

They use ``regexp_*`` instead of ``parse_url``: hrefs taken from pages may hold blanks, bars or bad
percent codes, which ``parse_url`` rejects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemart import constants as K

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"


def _group(url: Column, pattern: str, index: int = 1) -> Column:
    """The captured group, or NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(url, pattern, index), F.lit(""))


def scheme(url: Column) -> Column:
    return _group(url, rf"^({_SCHEME})://")


def origin(url: Column) -> Column:
    """scheme://host[:port] of an absolute URL."""
    return _group(url, rf"^({_SCHEME}://[^/?#]*)")


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def path_of(url: Column) -> Column:
    """Path without query, fragment and parameters of the last segment; '' if there is none."""
    raw = F.regexp_extract(url, rf"^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(raw, r";[^/]*$", "")


def absolutize_keep_query(url: Column, base: Column) -> Column:
    """Prefix the base's origin unless the URL has a scheme or a host of its own."""
    own = url.rlike(rf"^({_SCHEME}:|//)")
    return F.when(own, url).otherwise(F.concat(origin(base), url))


def _drop_dot_segments(path: Column) -> Column:
    parts = F.split(path, "/")
    folded = F.aggregate(
        parts,
        F.slice(parts, 1, 0),
        lambda kept, part: F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part))),
    )
    tail = F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(folded, "/"), tail)


def absolutize_path_only(url: Column, base: Column) -> Column:
    """Origin of the base plus the URL's path; query, fragment and foreign host are lost."""
    path = path_of(url)
    rooted = F.when(path.startswith("/"), path).otherwise(
        F.regexp_replace(F.concat(F.lit("/"), path), "/+", "/")
    )
    clean = F.when(rooted.rlike(r"/\.\.?(/|$)"), _drop_dot_segments(rooted)).otherwise(rooted)
    return F.when(path == "", origin(base)).otherwise(F.concat(origin(base), clean))


def product_id_from_url(url: Column) -> Column:
    return _group(url, r"/catalog/(\d{1,20})/detail\.aspx")


def product_url(base: Column, product_id: Column) -> Column:
    return F.concat(
        scheme(base), F.lit(f"://{K.WB_HOST}/catalog/"), product_id.cast("string"), F.lit("/detail.aspx")
    )


def reviews_url(url: Column, link: Column, order: str = "Asc") -> Column:
    """The dated review list of a product page."""
    tail = F.concat(F.lit(f"otzyvy?field=Date&order={order}&link="), F.coalesce(link, F.lit("")))
    return F.when(url.contains("detail.aspx"), F.concat(F.substring_index(url, "detail.aspx", 1), tail)).otherwise(url)


def listing_api_url(query: Column, page: Column) -> Column:
    return F.concat(F.lit(K.WB_LISTING_API), query, F.lit("&page="), page.cast("string"))


def first_page_params(url: Column) -> Column:
    return F.concat(url, F.lit(K.OZON_FIRST_PAGE))


def quote(text: Column) -> Column:
    """Percent-code all but letters, digits, ``_.-~`` and ``/`` (form coding is put right)."""
    coded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        coded = F.replace(coded, F.lit(found), F.lit(wanted))
    return coded


def wrap_in_api(url: Column) -> Column:
    return F.concat(F.lit(K.OZON_PAGE_API), quote(url))


def host_port(address: Column) -> Column:
    """host:port of a URL or a bare authority, user info dropped; NULL for a one-slash scheme."""
    return (
        F.when(address.rlike(r"^([^/:]+:)?//"), F.regexp_extract(address, r"^(?:[^/:]+:)?//(?:[^/]*@)?([^/]*)", 1))
        .when(address.rlike(r"^([^/:]+:)?/"), F.lit(None).cast("string"))
        .otherwise(F.regexp_extract(address, r"^(?:.*@)?([^@]*)$", 1))
    )


def host_slot(address: Column) -> Column:
    """Host name in lower case, without port and brackets."""
    host = _group(address, rf"^{_SCHEME}://(?:[^/?#]*@)?(\[[^\]]*\]|[^:/?#]*)")
    return F.lower(F.regexp_replace(host, r"[\[\]]", ""))


def with_scheme(address: Column) -> Column:
    return F.when(address.rlike(r"^\w+://"), address).otherwise(F.concat(F.lit("http://"), address))


def limit_to_region(url: Column, region: str) -> Column:
    """Put the region into a producer category URL that does not name it yet."""
    return F.when(url.contains(region), url).otherwise(
        F.replace(url, F.lit("/producers"), F.lit(f"/producers/{region}"))
    )
