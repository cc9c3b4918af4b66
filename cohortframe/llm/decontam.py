"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

Index: the postings ``(term, document, position)`` of every training token that some test item uses
are stored as a table in the shared folder (a token that no item uses can take part in no match).
Search: each test window orders its terms by how often the training data have them.
The postings of the rarest one, moved by its offset in the window, give the possible starts; the
list of the second rarest, moved likewise, is intersected with them.  What is left is held
against the documents' own words: equal words are an exact match, and with a ``slop`` (which ``decontaminate``
does not use) all words of the window within that many words more are a proximity match.  Test windows and terms
are small tables, broadcast where they are counted to be few and joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from cohortframe.llm.util import BROADCAST_KEYS, join_keys, stage_table

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters outside words, for texts in which A-Z are still there and for lower-cased ones.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stands after the last word of a document and holds the number of its words as its position.
END = "\x00"


def _words(text: Column) -> Column:
    """Words in their own letter case; null has none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), GAPS), lambda x: x != "")


def _folded(x: Column) -> Column:
    return F.translate(x, UPPER, LOWER)


def _test_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``(item_id, words)``: each ``window`` consecutive words, or all of an item with fewer."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), F.split(F.array_join(_words(_folded(F.col(text_col))), " "), " ").alias("w"))
    words = words.filter("w[0] <> ''")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return words.select(F.coalesce("item_id", F.lit("null")).alias("item_id"), F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, window))).alias("words"))


class Index:
    """Postings of the test terms in the training documents, and the windows to look for."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int):
        self.window = window
        each = stage_table(_test_windows(items, item_col, item_text_col, window).distinct(), "decon-items")
        self.windows = stage_table(each.select("words").distinct().select(F.monotonically_increasing_id().alias("win"), "words"), "decon-windows")
        self.items = stage_table(each.join(self.windows, "words").select("win", "item_id"), "decon-window-items")
        self.slots = stage_table(self.windows.select("win", F.size("words").alias("len"), F.posexplode("words").alias("offset", "term")), "decon-slots")
        terms = self.slots.select("term").distinct().select(F.monotonically_increasing_id().alias("term_id"), "term")
        end = docs.sparkSession.createDataFrame([(-1, END)], "term_id long, term string")
        self.terms = stage_table(terms.union(end).withColumn("lower", F.lower("term")), "decon-terms")
        self.few = self.terms.count() <= BROADCAST_KEYS
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
        tokens = self.docs.select("doc_id", "text_key", F.posexplode(F.concat(_words(F.col("text")), F.array(F.lit(END)))).alias("pos", "token"))
        ascii_only = F.octet_length("token") == F.char_length("token")
        same = (F.lower("token") == F.col("lower")) & (ascii_only | (_folded(F.col("token")) == F.col("term")))
        self.postings = stage_table(tokens.join(self._small(self.terms), same).select("term_id", "doc_id", "text_key", "pos"), "decon-postings")

    def _small(self, terms: DataFrame) -> DataFrame:
        """A table with a row a test term, broadcast where these were counted to be few, so that a common term's rows stay where they are."""
        return F.broadcast(terms) if self.few else terms

    def lengths(self) -> DataFrame:
        """``(doc_id, text_key, n_words)`` for each row of the documents."""
        return self.postings.filter("term_id = -1").select("doc_id", "text_key", F.col("pos").cast("long").alias("n_words"))

    def anchors(self) -> DataFrame:
        """``(win, len, term_id, offset, rank)``: the two rarest terms of each window, the rarest at rank 1."""
        freq = self.postings.groupBy("term_id").agg(F.count("*").alias("n"))
        known = stage_table(self.terms.join(freq, "term_id", "left").na.fill(0, ["n"]).select("term", "term_id", "n"), "decon-freq")
        slots = self.slots.join(self._small(known), "term")
        rank = F.row_number().over(Window.partitionBy("win").orderBy("n", "offset"))
        return slots.withColumn("rank", rank).filter("rank <= 2").select("win", "len", "term_id", "offset", "rank")

    def starts(self, slop: int) -> DataFrame:
        """``(doc_id, text_key, start, win)``: where the moved lists of a window's two rarest terms meet.

        With ``slop``, each start whose span has the rarest term, if the second rarest is near enough to share a span.
        """
        anchors = stage_table(self.anchors(), "decon-anchors")
        key = ["win", "doc_id", "text_key"]

        def moved(rank: int) -> DataFrame:
            at = self.postings.join(anchors.filter(F.col("rank") == rank), "term_id")
            return at.select("doc_id", "text_key", (F.col("pos") - (F.lit(0) if slop else F.col("offset"))).alias("start"), "win", "len")

        first = moved(1) if slop else moved(1).filter("start >= 0")
        alone = first.filter("len = 1").select("doc_id", "text_key", "start", "win", "len")
        first = first.filter("len > 1")
        second = moved(2).select(*key, F.col("start").alias("other"))
        if slop:
            wide = self.window + 2 * slop
            bin_ = F.floor(F.col("start") / wide)
            first = first.withColumn("bin", F.explode(F.array(bin_ - 1, bin_, bin_ + 1)))
            second = second.withColumn("bin", F.floor(F.col("other") / wide))
            near = (F.col("a.bin") == F.col("b.bin")) & (F.abs(F.col("a.start") - F.col("b.other")) < F.col("a.len") + 2 * slop)
        else:
            near = F.col("a.start") == F.col("b.other")
        on = (F.col("a.win") == F.col("b.win")) & (F.col("a.text_key") == F.col("b.text_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & near
        met = first.alias("a").join(second.alias("b"), on, "left_semi").select("doc_id", "text_key", "start", "win", "len").union(alone)
        if slop:
            spans = F.explode(F.sequence(F.col("start") - F.col("len") - slop + 1, F.col("start") + slop))
            met = met.select("doc_id", "text_key", spans.alias("start"), "win")
        return met.select("doc_id", "text_key", "start", "win").distinct()


def matches(index: Index, slop: int = 0) -> DataFrame:
    """``(doc_id, text_key, win, start, len, kind)``: exact phrases, and with ``slop`` also proximity matches.

    An exact match has the window's words in place.  A proximity match has each of them, as often as the
    window has it, among the words from ``start - slop`` to ``slop`` words past the window's length, in any
    order, and is not exact; every such start has a row.
    """
    found = stage_table(index.starts(slop), "decon-starts")
    suspects = stage_table(found.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).distinct(), "decon-suspects")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
    texts = join_keys(index.docs, suspects, same, "left_semi").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), _words(_folded(F.col("text"))).alias("w"))
    both = found.join(index.windows, "win").join(texts, same)
    n = F.size("words")
    exact = (F.col("start") >= 0) & F.coalesce(F.slice("w", F.greatest(F.col("start"), F.lit(0)) + 1, n) == F.col("words"), F.lit(False))
    if slop:
        low = F.greatest(F.col("start") - slop, F.lit(0))
        around = F.slice("w", low + 1, F.greatest(F.col("start") + n + slop - low, F.lit(0)))
        both = both.withColumn("around", around)
        times = lambda words, x: F.size(F.filter(words, lambda y: y == x))
        kind = F.when(exact, "exact").when(F.forall("words", lambda x: times("around", x) >= times("words", x)), "proximity")
    else:
        kind = F.when(exact, "exact")
    return both.select("doc_id", "text_key", "win", "start", n.alias("len"), kind.alias("kind")).filter("kind is not null")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated)`` for each row of ``docs``.

    A word is hit when it stands in an occurrence of a window of some item.  A null or wordless text has
    no words and is clean; items without words have no windows; items of the same id count
    once, and an item without id counts as ``null``.  Repeated rows each get the same result.  An
    empty ``items`` leaves all clean; an empty ``docs`` gives no rows.  Other columns are not
    looked at.  ``text_key`` tells apart texts that share a doc_id.
    """
    index = Index(docs, items, id_col, text_col, item_col, item_text_col, window)
    found = stage_table(matches(index).select("doc_id", "text_key", "win", "start", "len"), "decon-matches")
    key = ["doc_id", "text_key"]
    spans = found.groupBy(*key, "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    hits = spans.withColumn("new", new).groupBy(key).agg(F.sum("new").alias("n_hit"))
    listed = found.select(*key, "win").distinct().join(index.items, "win").groupBy(key).agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    same = lambda x: F.col("l.doc_id").eqNullSafe(F.col(f"{x}.doc_id")) & (F.col("l.text_key") == F.col(f"{x}.text_key"))
    out = index.lengths().alias("l").join(hits.alias("h"), same("h"), "left").join(listed.alias("i"), same("i"), "left")
    ids = F.coalesce("i.ids", F.array().cast("array<string>"))
    return out.select(
        "l.doc_id", "l.text_key", "l.n_words", F.coalesce("h.n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("h.n_hit", F.lit(0)) > 0).alias("contaminated"))


_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SQL_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n,
         array_to_string(list_slice(w, i + 1, i + least(len(w), {WINDOW})), ' ') AS s
         FROM (SELECT *, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
pos AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i + 1, i + n), ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d CROSS JOIN lens WHERE len(w) >= n)),
found AS (SELECT doc_id, i, p.n, item_id FROM pos p JOIN wins v ON p.s = v.s AND p.n = v.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""
