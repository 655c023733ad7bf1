"""Links of pages, page counts turned into rows, edges, duplicates and canonical pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart import constants as K
from pagemart.functions import moments as M
from pagemart.functions import text as X
from pagemart.functions import urls as U
from pagemart.operators import joins
from pagemart.operators.seen import SeenKeys

# The rest of a start tag up to its end, with quoted values that may hold one; and its href, quoted or bare.
_HEAD = r"""^(?:[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>|[^>]*+>)"""
_HREF = r"""(?i)[\s"']href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_BLOCK = 1024


def extract_links(pages: DataFrame, keep: tuple[str, ...], body: str = "body", scope: str | None = None) -> DataFrame:
    """(kept columns, ord from 1, href, text) of each link of pages with plain link markup.

    ``href`` may be quoted either way or bare. ``scope`` is a pattern whose first match limits the search, such as
    ``<nav>.*?</nav>``. Text is the markup up to the end tag, or the next link, without tags; NULL if there
    is none. The page is split at the starts of links, so each part of it is searched once.
    """
    area = F.regexp_extract(body, f"(?s){scope}", 0) if scope else F.col(body)
    parts = F.transform(
        F.filter(F.split(area, r"(?i)<a(?=\s)"), lambda _, i: i > 0),
        lambda p: F.struct(F.regexp_extract(p, _HEAD, 0).alias("head"), p.alias("whole")),
    )
    found = F.transform(parts, lambda p: F.struct(F.regexp_extract(p.head, _HREF, 1).alias("raw"), F.length(p.head).alias("n"), p.whole.alias("whole")))
    text = F.regexp_replace(F.get(F.split(F.expr("substr(link.whole, link.n + 1)"), r"(?i)</a[\s>]"), 0), "<[^>]*>", "")
    linked = F.filter(found, lambda p: p.raw != "")
    return pages.select(*keep, F.posexplode(linked).alias("ord", "link")).select(
        *keep,
        (F.col("ord") + 1).alias("ord"),
        F.regexp_replace("link.raw", r"""^["']|["']$""", "").alias("href"),
        F.nullif(text, F.lit("")).alias("text"),
    )


def explode_count(df: DataFrame, count: Column, out: str) -> DataFrame:
    """One row per number 0 … count-1; none for counts that are NULL or not positive.

    Numbers are made in two steps, blocks first and spread over the cluster, so that one row with a
    huge count neither builds a huge array nor stays in one task.
    """
    own = df.columns
    blocks = (
        df.withColumn("_n", count.cast("long"))
        .select(
            *own,
            "_n",
            F.explode(
                F.when(F.col("_n") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / _BLOCK)))
            ).alias("_b"),
        )
    )
    first = F.col("_b") * _BLOCK
    last = F.least(first + _BLOCK, F.col("_n")) - 1
    return blocks.repartition("_b", *own).select(*own, F.explode(F.sequence(first, last)).alias(out))


def listing_pages_by_total(categories: DataFrame, total: Column, cards: Column) -> DataFrame:
    """(…, page, offset): one row per listing page of a category with a known total."""
    size = cards.cast("long")
    sized = categories.withColumn("_cards", F.when((total > 0) & (size > 0), size))
    pages = X.ceil_div(total, F.col("_cards"))
    return (
        explode_count(sized, pages, "_k")
        .withColumns({"page": F.col("_k") + 1, "offset": F.col("_k") * F.col("_cards")})
        .drop("_k", "_cards")
    )


def review_pages_by_total(targets: DataFrame, total: Column, take: int = K.REVIEW_BATCH) -> DataFrame:
    """(…, skip, take): one row per batch of reviews."""
    batches = F.when(total > 0, X.ceil_div(total, F.lit(take)))
    return (
        explode_count(targets, batches, "_k")
        .withColumns({"skip": F.col("_k") * take, "take": F.lit(take)})
        .drop("_k")
    )


def follow(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with the page id of their target; NULL where it was not captured. URLs of captured
    pages must be unique. Many edges may point to one page, so they are dealt by their source."""
    targets = pages.select(F.col("page_id").alias("to_page"), F.col("url").alias("to_url"))
    return joins.salted_lookup(edges, targets, "to_url", F.col("from_page"))


def dedupe_pages(
    pages: DataFrame, key: Column, seen: DataFrame | SeenKeys | None = None, allow_dupes: bool = False
) -> DataFrame:
    """One page per key: the earliest fetched, then the lowest id; keys in ``seen`` are left out.

    ``seen`` is a table of ``url_key``, or the stored keys of earlier runs, of which only the buckets in question are read. Winners are found by an aggregate over three narrow columns, which combines copies before the
    shuffle, and the pages are then filtered by id. On a table bucketed by page id (``captured_pages`` by name)
    that moves ids only; from plain files Spark shuffles the pages once by id, or sends it the ids if they are few.
    """
    keyed = pages.withColumn("url_key", key)
    if allow_dupes:
        return keyed
    winners = keyed.groupBy("url_key").agg(F.min(M.moment(F.col("fetched_at"), F.col("page_id"))).alias("w"))
    if isinstance(seen, SeenKeys):
        winners = seen.unseen(winners, "url_key")
    elif seen is not None:
        winners = winners.join(seen.select("url_key"), "url_key", "left_anti")
    return keyed.join(winners.select(M.id_of(F.col("w")).alias("page_id")), "page_id", "left_semi")


def canonical_href(body: Column) -> Column:
    """href of the canonical link, whatever the order of its attributes; '' if there is none."""
    return F.regexp_extract(
        body, r"""<link\s(?=[^>]*\brel=["']?canonical\b)[^>]*?\bhref=["']([^"']*)["']""", 1
    )


def resolve_canonical(pages: DataFrame, canonical: Column) -> tuple[DataFrame, DataFrame]:
    """(pages that stand for themselves, edges from the others to their canonical URL).

    A page without a canonical link (NULL or '') stands for itself. Edges keep the page's context
    columns. The test names ``canonical`` once only, so a body is searched once although the filter
    moves below the projection; it runs before any parsing.
    """
    url = F.col("url")
    own_path = F.substr(url, F.length(F.coalesce(U.origin(url), F.lit(""))) + 1)
    same = F.coalesce(canonical, F.lit("")).isin(F.lit(""), url, own_path)
    edges = pages.where(~same).withColumn("to_url", U.strip_query(U.absolutize_keep_query(canonical, url)))
    return pages.where(same), edges.drop("body")
