"""How far the sources of a language differ in their words.

Identical texts of a language are collapsed first: each is kept once with the number of its copies in every
source, and split into terms once; its counts are added to each source times the copies there. Counts of
(language, source, term) are all that goes on. Two sources are compared over the terms that one of them has;
the terms that neither has add the difference of their floor shares, which needs their number only.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemart.llm.base import query, slices, table
from pagemart.session import materialise

#: Letters A-Z and a-z and all signs beyond ASCII, as bytes of UTF-8.
TERM, BREAK = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
MIN_DOCS, SCALE, SMOOTH, TOP_TERMS = 30, 1_000_000_000, 5, 50
#: Bytes of a text split at once, and counts a task holds before it hands them on.
PART, HELD = 1 << 20, 800_000
#: A task's count of a term is its occurrences << DOCS, plus its documents.
DOCS = 48
#: Numbers in one block of sources by terms.
BLOCK = 1 << 17


def parts(text: bytes, most: int = PART) -> Iterator[bytes]:
    """The text in parts that cut no term."""
    begin = 0
    while len(text) - begin > most:
        cut = BREAK.search(text, begin + most)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def copies_of(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(lang, digest, source, n) of the texts' copies, written; and (lang, digest, text), each text once."""
    clean = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    rows = docs.select(*clean).withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = materialise(rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n")), "copies")
    return copies, rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))


def term_counts(copies: DataFrame, texts: DataFrame, part: int = PART, held: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents. ``held`` bounds the counts of a task."""
    lists = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_now: defaultdict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in held_now.items():
                size, both = len(counts), list(counts.values())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                     pa.array(counts, pa.binary()).cast(pa.string()), pa.array([c >> DOCS for c in both], pa.int64()),
                     pa.array([c & (1 << DOCS) - 1 for c in both], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"],
                )
            held_now.clear()

        for batch in slices(batches, "text"):
            columns = (batch.column("lang"), batch.column("text").cast(pa.binary()), batch.column("copies"))
            for lang, text, sources in zip(*(c.to_pylist() for c in columns), strict=True):
                counts: Counter[bytes] = Counter()
                for piece in parts(text, part):
                    counts.update(TERM.findall(piece.lower()))
                for copy in sources if counts else ():
                    own, times = held_now[lang, copy["source"]], copy["n"]
                    before = own.get
                    for term, n in counts.items():
                        own[term] = before(term, 0) + ((n << DOCS) + 1) * times
                if sum(map(len, held_now.values())) > held:
                    yield from handed()
        yield from handed()

    found = texts.join(lists, ["lang", "digest"]).select("lang", "text", "copies")
    found = found.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(SCALE * (n + 5) / (total + 5 * terms)) in whole numbers of 38 digits; null without terms."""
    wide = lambda c: F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(n) + SMOOTH)
    below = wide(total) + wide(terms) * SMOOTH
    return F.when(below > 0, F.call_function("div", top, below) + 1)


def block_distances(rows: pa.Table, own: pa.Table) -> pa.Table:
    """(lang, a, b, value, terms): over a block's terms that a or b has, the sum of differences and their number.

    ``rows`` has (source, term, p) of the block, ``own`` every source of the language with its floor share.
    """
    names = np.array(sorted(zip(own["source"].to_pylist(), own["floor"].to_pylist(), strict=True)), object).reshape(-1, 2)
    place = {s: i for i, s in enumerate(names[:, 0])}
    at = np.fromiter(map(place.__getitem__, rows["source"].to_pylist()), np.int64, rows.num_rows)
    terms = rows["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    width = int(terms.max()) + 1 if len(terms) else 0
    p = np.repeat(names[:, 1].astype(np.int64)[:, None], width, axis=1)
    has = np.zeros(p.shape, bool)
    p[at, terms], has[at, terms] = rows["p"].to_numpy(), True
    n = len(names)
    one_sided, shared, both = (np.zeros((n, n), np.int64) for _ in range(3))
    for a in range(n):
        columns = np.flatnonzero(has[a])
        apart, theirs = np.abs(p[:, columns] - p[a, columns]), has[:, columns]
        one_sided[a], both[a] = apart.sum(axis=1), theirs.sum(axis=1)
        shared[a] = (apart * theirs).sum(axis=1)
    a, b = np.triu_indices(n, 1)
    value = one_sided[a, b] + one_sided[b, a] - shared[a, b]
    size = has.sum(axis=1)
    lang = own["lang"][0].as_py() if n else ""
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(names[a, 0], pa.string()), "b": pa.array(names[b, 0], pa.string()),
        "value": pa.array(value), "terms": pa.array(size[a] + size[b] - both[a, b]),
    })


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS, block: int = BLOCK, part: int = PART, held: int = HELD,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others, and by which terms.

    Part ``pair`` has every other source of the language with the sum of differences over all kept terms, part
    ``term`` the ``top_terms`` terms that the source has more of than its language. A null text, language or source
    counts as ''. A language without kept terms has pairs of value 0. Repeated rows are documents of their own.
    Ties go by the item's bytes. An empty table gives no rows; other columns are not read, whatever their names.
    Per text the list of its sources is held, and per block all sources of a language: the result has a row for
    each two sources, so their number is what sets its size.
    """
    copies, texts = copies_of(docs, lang_col, source_col, text_col)
    # The rows of a term are its sources, so its sums are a window over few rows.
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(copies, texts, part, held).select(
        "*", F.sum("docs").over(of_term).alias("lang_docs"), F.sum("n").over(of_term).alias("lang_n"),
        (F.col("source") == F.min("source").over(of_term)).alias("first"),
    )
    rows = counts.where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first")
    rows = materialise(rows, "kept-counts")

    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = rows.where("first").groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = copies.groupBy("lang", "source").agg(F.lit(1).alias("one")).join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    groups = groups.select("lang", "source", zero("total"), zero("terms"), zero("lang_total"))
    groups = materialise(groups.withColumn("floor", F.coalesce(share(F.lit(0), "total", "terms"), F.lit(0))), "groups")

    shares = rows.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.withColumn("value", F.col("p") - share("lang_n", "lang_total", "terms")).where("value > 0")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    above = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms)

    # Blocks of terms: sources times terms are bounded by ``block``, but a block has no fewer terms than sources.
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.first("terms").alias("terms"))
    sizes = sizes.select("lang", F.ceil(F.col("sources") * F.col("terms") / F.greatest(F.lit(block), F.col("sources") * F.col("sources"))).alias("blocks"))
    dealt = shares.join(sizes, "lang").select("lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "source", "term", "p")
    every = groups.join(sizes.where("blocks > 0"), "lang").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", "floor"
    )
    apart = dealt.groupBy("lang", "block").cogroup(every.groupBy("lang", "block")).applyInArrow(
        block_distances, "lang string, a string, b string, value long, terms long"
    )
    apart = apart.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("seen"))
    apart = apart.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), "value", "seen"),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), "value", "seen"),
    )).alias("e")).select("lang", "e.*")
    others = groups.select("lang", F.col("source").alias("item"), F.col("floor").alias("item_floor"))
    pairs = groups.join(others, "lang").where("source != item").join(apart, ["lang", "source", "item"], "left")
    unseen = (F.col("terms") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("floor") - F.col("item_floor"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", (F.coalesce("value", F.lit(0)) + unseen).alias("value"))
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(above)


_SHARE = "(1 + (1000000000::HUGEINT * ({n} + 5)) // ({total} + 5 * terms))::BIGINT"
ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT id) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS lang_n FROM counts GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*)::HUGEINT AS terms, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts JOIN kept USING (lang, term) GROUP BY lang, source),
sources AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, {_SHARE.format(n="coalesce(n, 0)", total="coalesce(total, 0)")} AS p,
         {_SHARE.format(n="lang_n", total="lang_total")} AS q
  FROM sources JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)
  LEFT JOIN counts USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a
  JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM sources a
  JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
both_parts AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, abs(p - q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM both_parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


@query("op11_source_divergence", ORACLE)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
