"""Text, number and date cleaners as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemart import constants as K

# White space as Unicode sees it; written out, since ``\s`` means different sets in different engines.
_SPACE = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
# The same set as characters; ``trim`` looks at the ends only, a pattern at the whole text.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Trim white space of every kind, the no-break space included (``trim`` leaves it)."""
    return F.trim(text, F.lit(_SPACES))


def price_text(text: Column) -> Column:
    return F.translate(text, K.NO_BREAK_SPACE + K.ROUBLE, "")


def clear_price(text: Column) -> Column:
    return F.translate(price_text(strip(text)), " ", "").try_cast("decimal(12,2)")


def clear_reviews_count(text: Column) -> Column:
    bare = strip(F.regexp_replace(text, K.REVIEW_WORDS, ""))
    return F.translate(bare, " " + K.NO_BREAK_SPACE, "").try_cast("int")


def full_size_image(url: Column) -> Column:
    """Ask for the large picture: only the size segment of the path changes."""
    return F.replace(url, F.lit("/tm/"), F.lit("/big/"))


def full_size_image2(url: Column) -> Column:
    return F.replace(url, F.lit("xsmall"), F.lit("big"))


def collapse_script(script: Column) -> Column:
    """Drop line ends, runs of blanks and the two assignments that are not plain data."""
    flat = F.regexp_replace(F.replace(script, F.lit("\n"), F.lit("")), r"\s{2,}", "")
    for name in ("routes", "routesDictionary"):
        flat = F.replace(flat, F.lit(f"{name}: {name},"), F.lit(""))
    return flat


def script_argument(script: Column, call: str) -> Column:
    """The shortest ``{…}`` that is the whole argument of a named call, or NULL."""
    pattern = call.replace(".", r"\.") + r"\((\{.*?\})\);"
    return F.nullif(F.regexp_extract(script, pattern, 1), F.lit(""))


def join_address(*parts: Column) -> Column:
    return F.nullif(F.concat_ws(" ", *parts), F.lit(""))


def coords_text(body: Column) -> Column:
    found = F.regexp_extract(body, r"coordinates: \[(-?\d+\.\d+, -?\d+\.\d+)\]", 1)
    return F.nullif(found, F.lit(""))


def coords_struct(coords: Column) -> Column:
    parts = F.split(F.replace(coords, F.lit(" "), F.lit("")), ",")
    return F.when(
        coords.isNotNull(),
        F.struct(
            F.get(parts, 0).try_cast("double").alias("lat"),
            F.get(parts, 1).try_cast("double").alias("lon"),
        ),
    )


def clean_article(markup: Column) -> Column:
    flat = F.regexp_replace(markup, _SPACE, "")
    for piece in ('<spanclass="space"></span>', f'<divclass="prod--art">{K.ARTICLE_LABEL}', "</div>"):
        flat = F.replace(flat, F.lit(piece), F.lit(""))
    return flat


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def ceil_div(total: Column, size: Column) -> Column:
    """Number of pages; NULL for a page size of 0."""
    return F.ceil(total / F.nullif(size, F.lit(0)))


def exp_backoff(attempt: Column, base: float = K.BACKOFF_BASE, cap: float = K.BACKOFF_CAP) -> Column:
    """Seconds to wait after the given number of earlier failures."""
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), F.least(attempt, F.lit(60))))


def backoff_jitter(key: Column, attempt: Column, seed: int = 0, **limits: float) -> Column:
    """A wait between 0 and the full back-off, the same for the same key, attempt and seed."""
    steps = 1 << 28
    digest = F.md5(F.concat_ws("|", key.cast("string"), attempt.cast("string"), F.lit(str(seed))))
    draw = F.conv(F.substr(digest, F.lit(1), F.lit(7)), 16, 10).cast("double") / F.lit(float(steps))
    return exp_backoff(attempt, **limits) * draw
