"""Line deduplication by site-relative frequency, in DataFrame operations only.

A line is boilerplate on a host when the pages of the host that contain it, divided by all pages of
the host, exceed a ratio.  Counting needs no shuffle of texts: each page's distinct lines are
exploded as digests and counted per (host, digest) with map-side sums, so a host with a third of all
pages and a line on every page of it arrive as one sum per task.  A host has at most
``mean lines of a page / ratio`` boilerplate lines whatever its size, so they are gathered to one short
array per host, and that small table is joined to the pages (broadcast by its size, else an
adaptive join that splits hot hosts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.util import fresh, stage_table

#: Ordinary repeats stand on a few pages in a thousand, boilerplate on some in a hundred; the ratio lies between them.
RATIO = 0.05
#: A line on one page alone repeats nothing, however few pages its host has.
MIN_PAGES = 2


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, digest, pages, host_pages)`` of the lines on over ``ratio`` of a host's pages and on ``min_pages`` at least."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text")).filter("host is not null")
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _trimmed), lambda x: x != ""))
    counts = pages.select("host", F.explode(lines).alias("line")).groupBy("host", _digest(F.col("line")).alias("digest")).agg(F.count("*").alias("pages"))
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    return counts.filter(F.col("pages") >= min_pages).join(totals, "host").filter(F.col("pages") > F.lit(ratio) * F.col("host_pages"))


def line_dedup(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
               chars_col: str | None = "n_chars", counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text_col``; every row and column stays.

    Lines are compared without surrounding blanks, tabs and carriage returns; blank lines stay.  A line is
    counted once for each page that has it, whatever its repeats there; a repeated row counts as a
    page of its own.  Pages without a host belong to no site and keep all lines, and so do lines on
    exactly the ratio.  A null text stays null, a text of boilerplate alone becomes empty.
    ``chars_col``, where there is such a column, gets the new length.  ``counts`` appends the
    columns ``n_lines`` and ``n_dropped`` (both null where the text is), renamed if taken.
    """
    found = stage_table(boilerplate(docs, text_col, host_col, ratio, min_pages), "boilerplate")
    host, bad, lines, kept = fresh(docs, "bp_host", "bp_digests", "bp_lines", "bp_kept")
    by_host = found.groupBy(F.col("host").alias(host)).agg(F.collect_set("digest").alias(bad))
    out = docs.join(by_host, docs[host_col] == F.col(host), "left")
    out = out.withColumn(lines, F.split(F.col(text_col).cast("string"), "\n"))
    out = out.withColumn(kept, F.when(F.col(bad).isNull(), F.col(lines)).otherwise(
        F.filter(lines, lambda x: (_trimmed(x) == "") | ~F.array_contains(F.col(bad), _digest(_trimmed(x))))))
    fewer = F.size(kept) < F.size(lines)
    text = F.when(fewer, F.array_join(kept, "\n")).otherwise(F.col(text_col))
    cols = {c: F.col(c) for c in docs.columns} | {text_col: text.alias(text_col)}
    if chars_col in docs.columns:
        cols[chars_col] = F.when(fewer, F.char_length(text)).otherwise(F.col(chars_col)).cast(docs.schema[chars_col].dataType).alias(chars_col)
    extra = []
    if counts:
        n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
        has = F.col(text_col).isNotNull()
        extra = [F.when(has, F.size(lines)).alias(n_lines), F.when(has, F.size(lines) - F.size(kept)).alias(n_dropped)]
    return out.select(*cols.values(), *extra)


ORACLE_SQL = f"""
WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
each AS (SELECT source, unnest(list_distinct(list_filter(list_transform(ls, lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> ''))) AS line
         FROM pages WHERE source IS NOT NULL AND text IS NOT NULL),
totals AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
bad AS (SELECT source, line FROM each GROUP BY source, line HAVING count(*) >= {MIN_PAGES}),
n AS (SELECT source, line, count(*) AS pages FROM each GROUP BY source, line),
sets AS (SELECT n.source, list(n.line) AS lines FROM n JOIN bad USING (source, line) JOIN totals USING (source)
         WHERE pages > CAST({RATIO} AS DOUBLE) * host_pages GROUP BY n.source),
kept AS (SELECT doc_id, p.source, text, ls,
         list_filter(ls, lambda x: trim(x, ' ' || chr(9) || chr(13)) = '' OR NOT list_contains(coalesce(s.lines, []), trim(x, ' ' || chr(9) || chr(13)))) AS ks
         FROM pages p LEFT JOIN sets s USING (source))
SELECT doc_id, len(ls) AS n_lines, len(ls) - len(ks) AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(ks, chr(10)), '') END AS text FROM kept
"""
