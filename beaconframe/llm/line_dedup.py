"""Line dedup by site-relative frequency.

A line is boilerplate of a site if more than `ratio` of that site's pages contain it:
pages containing the line, divided by the site's pages. A line of one page alone repeats
nothing and stays, else each site of few pages would lose all its text. All of it is DataFrame functions; lines travel as 64-bit hashes, and a page's
text is never shuffled while the list of boilerplate lines is small (checked by count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconframe.llm.naming import unused
from beaconframe.session import cut, table

RATIO = 0.1
#: Boilerplate lines of all sites are broadcast up to this number (16 bytes each and the site's name).
BROADCAST_LINES = 500_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate_lines(docs: DataFrame, site: Column, text: Column, ratio: float = RATIO, copies_once: bool = False) -> DataFrame:
    """site, line_hash, pages, site_pages of each line that more than `ratio` of a site's pages contain.

    With copies_once, a site's pages of equal text are one page.
    """
    page = [F.xxhash64(text).alias("page")] if copies_once else []
    once = (lambda d: d.distinct()) if copies_once else (lambda d: d)
    pages = once(docs.select(site.alias("site"), *page)).groupBy("site").agg(F.count(F.lit(1)).alias("site_pages"))
    distinct = F.array_distinct(F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(F.trim(x))))
    counted = once(docs.select(site.alias("site"), *page, F.explode(distinct).alias("line_hash"))).groupBy("site", "line_hash").agg(F.count(F.lit(1)).alias("pages"))
    frequent = counted.where("pages > 1").alias("f")
    return (
        frequent.join(pages.alias("p"), F.col("f.site").eqNullSafe(F.col("p.site")))
        .where(F.col("pages") > F.lit(ratio) * F.col("site_pages"))
        .select("f.site", "line_hash", "pages", "site_pages")
    )


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, copies_once: bool = False) -> DataFrame:
    """docs with boilerplate lines gone from `text`, and columns n_lines and n_dropped after the others.

    Lines are compared after trimming spaces; blank lines are never boilerplate. A null
    text stays null with no lines; a text of boilerplate alone becomes empty. Rows with a
    null site form one site. Copies and repeated rows count as pages of their own, or with
    copies_once as one page. n_lines and n_dropped replace columns of those names; all other
    columns are carried, whatever their names. No rows give no rows.

    A site has at most 1 / ratio times as many boilerplate lines as a page of it has lines.
    """
    kept = docs.drop("n_lines", "n_dropped")
    at, drops, left = (unused(kept.columns, n) for n in ("site_key", "drops", "stays"))
    found = cut(boilerplate_lines(docs, F.col(f"`{site}`"), F.col(f"`{text}`"), ratio, copies_once))
    per_site = found.groupBy(F.col("site").alias(at)).agg(F.collect_set("line_hash").alias(drops))
    per_site = F.broadcast(per_site) if found.count() <= BROADCAST_LINES else cut(per_site)  # cut: with a shuffle of its own, a hot site can be split in the join
    lines = _lines(F.col(f"`{text}`"))
    drop = F.coalesce(F.col(drops), F.array().cast("array<bigint>"))
    stays = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(drop, F.xxhash64(F.trim(x))))
    joined = kept.join(per_site, F.col(f"`{site}`").eqNullSafe(F.col(at)), "left").withColumn(left, stays)
    none = F.col(f"`{text}`").isNull()
    return joined.select(
        *[F.array_join(left, "\n").alias(text) if c == text else F.col(f"`{c}`") for c in kept.columns],
        F.when(none, 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.when(none, 0).otherwise(F.size(lines) - F.size(left)).cast("bigint").alias("n_dropped"),
    )


def without_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """docs with the same columns: boilerplate lines are gone from `text`, and `chars` is its new length in code points.

    A site's pages of equal text count once, so that a text of many copies is not taken for
    boilerplate. Nulls, empty texts and tables are as in drop_boilerplate; no row goes.
    """
    hidden = {c: unused(docs.columns, f"own_{c}") for c in ("n_lines", "n_dropped") if c in docs.columns}
    out = drop_boilerplate(docs.withColumnsRenamed(hidden), site, text, copies_once=True).drop("n_lines", "n_dropped").withColumnsRenamed({v: c for c, v in hidden.items()})
    return out.withColumn(chars, F.length(F.col(f"`{text}`")).cast("bigint")) if chars in docs.columns else out


def query(spark, sf_dir: str) -> DataFrame:
    """op9: `documents` without the boilerplate lines of their source, whole table and whole texts."""
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_lines", "n_dropped", "text")


SQL = f"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
n AS (SELECT source, count(*) AS site_pages FROM documents GROUP BY source),
l AS (SELECT source, unnest(list_distinct(list_transform(list_filter(lines, lambda x: trim(x) <> ''), lambda x: trim(x)))) AS line FROM d),
c AS (SELECT source, line, count(*) AS pages FROM l GROUP BY source, line),
b AS (SELECT c.source, list(c.line) AS drops FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE c.pages > 1 AND c.pages > {RATIO} * n.site_pages GROUP BY c.source),
k AS (SELECT d.doc_id, d.source, d.text AS was, d.lines,
             list_filter(d.lines, lambda x: trim(x) = '' OR NOT list_contains(coalesce(b.drops, []), trim(x))) AS stays
      FROM d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(stays), 0) AS BIGINT) AS n_dropped,
       CASE WHEN was IS NULL THEN NULL ELSE coalesce(array_to_string(stays, chr(10)), '') END AS text
FROM k
"""
