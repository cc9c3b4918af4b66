"""SimHash near-duplicate groups over a Gray-order hierarchical index.

Fingerprints that differ in at most ``max_bits`` bits agree wholly on one of ``max_bits + 1``
blocks of bits.  The upper nodes of the index are therefore masked bit patterns ``(mask, value)``:
each fingerprint stands below one node for each block.  A node with more than ``node_limit``
fingerprints is refined by the same rule on the bits its mask leaves free, so a node never has more
than ``2 ** free bits`` members and the largest one is bounded whatever the data are.
Below a node the fingerprints are sorted by Gray rank (neighbours share most bits), packed in
leaves, and the bits that all members of a leaf or of a run of leaves share are factored into its
parent.  A search adds up the differing shared bits on its way down and leaves a whole group when
the sum exceeds ``max_bits``.  A task emits a spanning forest of the links it found,
never all pairs; the forests meet in :func:`cohortframe.llm.util.connected_components`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortframe.llm.util import connected_components, fresh, stage_table

BITS = 64
NODE_LIMIT = 4096
LEAF, FAN = 16, 16
SEED = 42
#: Shingles hashed at once; bounds the memory of a very long text.
CHUNK = 1 << 16
#: Pairs of nodes or fingerprints held at once.
PAIRS = 1 << 20
#: Index rows gathered before the complete nodes among them are searched.
ROWS = 1 << 17


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Bitwise majority of the XXH64 hashes of all word shingles, as an unsigned integer.

    A-Z are lower-cased, words stand between ASCII white space.  Fewer words than ``shingle``: the
    whole sequence is the only shingle.  No words, or null: zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:at + CHUNK + shingle - 1]
        if len(part) < shingle:
            grams = [b" ".join(part)]
        else:
            grams = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        hashes = np.array([h(g, SEED) for g in grams], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` for each row; ``fp`` holds the 64 bits as a signed long, ``text_key`` a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2).cast(pa.large_binary())], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(run, "doc_id long, text_key long, fp long")


# ---------------------------------------------------------------- index

def child_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` runs of its free bits added; a run may be empty."""
    free = [i for i in range(BITS - 1, -1, -1) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in run) for run in np.array_split(np.array(free, dtype=np.int64), parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(fp: Column) -> Column:
    """Rank of a bit pattern in the reflected Gray sequence, ordered as a signed long."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class _Level:
    """Nodes of one height: what all members share, the children, and the pattern's bits."""

    def __init__(self, ones: np.ndarray, zeros: np.ndarray, first: np.ndarray, count: np.ndarray):
        self.ones, self.zeros, self.first, self.count = ones, zeros, first, count
        self.mask = ~(ones ^ zeros)  # bits in which all members agree
        self.bits = ones & self.mask


def _runs(starts: np.ndarray, counts: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut each run into pieces of ``fan``; (first of each piece, its length, pieces of each run)."""
    pieces = -(-counts // fan)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(starts, pieces) + within * fan
    return first, np.minimum(fan, np.repeat(starts + counts, pieces) - first), pieces


def build(fps: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[_Level]:
    """Levels from the leaves to one root for each group ``fps[starts:starts + counts]`` (Gray-sorted)."""
    levels = []
    ones = zeros = fps  # ones: AND of the members, zeros: OR of them
    fan = LEAF
    while True:
        first, size, pieces = _runs(starts, counts, fan)
        levels.append(_Level(np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(zeros, first), first, size))
        if (pieces <= 1).all():
            return levels
        ones, zeros, fan = levels[-1].ones, levels[-1].zeros, FAN
        counts, starts = pieces, np.cumsum(pieces) - pieces


def _expand(a: np.ndarray, b: np.ndarray, level: _Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of children of the node pairs; the index of the pair each came from."""
    ca, cb = level.count[a], level.count[b]
    n = ca * cb
    pair = np.repeat(np.arange(len(a)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = level.first[a[pair]] + k // cb[pair], level.first[b[pair]] + k % cb[pair]
    keep = (a[pair] != b[pair]) | (i <= j)
    return i[keep], j[keep], pair[keep]


def _slices(a: np.ndarray, b: np.ndarray, level: _Level) -> Iterator[slice]:
    """Cuts of a list of node pairs whose children give about ``PAIRS`` pairs each."""
    total = np.cumsum(level.count[a] * level.count[b])
    at = 0
    while at < len(a):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, side="right")))
        yield slice(at, end)
        at = end


def _descend(levels: list[_Level], k: int, a: np.ndarray, b: np.ndarray, acc: np.ndarray, fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs below the node pairs ``(a, b)`` of level ``k``; ``acc``: differing shared bits so far."""
    level = levels[k]
    for s in _slices(a, b, level):
        i, j, pair = _expand(a[s], b[s], level)
        if k == 0:
            keep = i < j
            i, j = i[keep], j[keep]
            near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
            yield i[near], j[near]
            continue
        below, known = levels[k - 1], (level.mask[a[s]] & level.mask[b[s]])[pair]
        rest = below.mask[i] & below.mask[j] & ~known  # what the children add to the parents' pattern
        more = acc[s][pair] + np.bitwise_count((below.bits[i] ^ below.bits[j]) & rest)
        near = more <= max_bits
        if near.any():
            yield from _descend(levels, k - 1, i[near], j[near], more[near], fps, max_bits)


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of linked members; ``label`` ends as the least member of each class."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (up := label[label]).tobytes() != label.tobytes():
            label[:] = up


def forest(fps: np.ndarray, starts: np.ndarray, counts: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within each group: (member, least-indexed member of its class)."""
    label = np.arange(len(fps))
    levels = build(fps, starts, counts)
    roots = np.arange(len(levels[-1].first))
    for i, j in _descend(levels, len(levels) - 1, roots, roots, np.zeros(len(roots), np.int64), fps, max_bits):
        _join(label, i, j)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _search(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def links(table: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.r_[True, (table[1:, :2] != table[:-1, :2]).any(axis=1)])
            counts = np.diff(np.r_[new, len(table)])
            fps = np.ascontiguousarray(table[np.repeat(counts > 1, counts), 2]).view(np.uint64)
            counts = counts[counts > 1]
            u, v = forest(fps, np.cumsum(counts) - counts, counts, max_bits) if len(counts) else (fps, fps)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1))
            rows += b.num_rows
            if rows >= ROWS:
                table = np.concatenate(held)
                last = int(np.flatnonzero((table[:, :2] == table[-1, :2]).all(axis=1))[0])  # sorted: the last node may go on
                if last:
                    yield links(table[:last])
                held, rows = [table[last:]], len(table) - last
        if rows:
            yield links(np.concatenate(held))

    return run


def near_links(fps: DataFrame, max_bits: int = 3, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints ``fps(fp)`` that connect all pairs within ``max_bits``."""
    spark = fps.sparkSession
    parts = max_bits + 1
    masks, found = [0], None
    open_ = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    while True:
        kids = [(_signed(m), _signed(c)) for m in masks for c in child_masks(m, parts)]
        table = F.broadcast(spark.createDataFrame(kids, "mask long, kid long"))  # parts ** depth rows, depth at most 6
        nodes = open_.join(table, "mask").select(F.col("kid").alias("mask"), F.col("fp").bitwiseAND(F.col("kid")).alias("value"), "fp")
        masks = sorted({c & (1 << 64) - 1 for _, c in kids})
        hot = nodes.groupBy("mask", "value").count().filter(F.col("count") > node_limit).drop("count")
        free = max(BITS - m.bit_count() for m in masks)
        last = 1 << free <= node_limit
        if not last:
            hot = stage_table(hot, "simhash-hot")
            last = hot.isEmpty()
        light = nodes if last else nodes.join(hot, ["mask", "value"], "left_anti")
        ready = light.repartition("mask", "value").sortWithinPartitions("mask", "value", gray_rank(F.col("fp")))
        links = ready.select("mask", "value", "fp").mapInArrow(_search(max_bits), "u long, v long")
        found = links if found is None else found.union(links)
        if last:
            return found
        open_ = stage_table(nodes.join(hot, ["mask", "value"], "left_semi").select("mask", "fp").distinct(), "simhash-open")


# ---------------------------------------------------------------- operator

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, node_limit: int = NODE_LIMIT) -> DataFrame:
    """``(doc_id, fingerprint, component_id, text_key, root)`` for each row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits, equal ones included; ``component_id``
    is the smallest doc_id reachable, ``root`` the component's own key.  A text without words (or
    null) has fingerprint zero and links like any other.  Repeated rows and repeated ids give a row
    each.  A null doc_id stays in its component and is its id only if all members are null.  An
    empty table gives no rows; further columns of ``docs`` are not looked at.
    """
    fps = stage_table(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct = stage_table(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = connected_components(near_links(distinct.select("fp"), max_bits, node_limit), "simhash-links")
    members = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = members.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = members.join(groups, "root").select("fp", "component_id", "root")
    out = fps.join(of_fp, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_key", "root")


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component in ``groups``, the one with the smallest doc_id.

    A null id comes last; among rows that share the id, and among repeated rows, the least by text
    hash and then by all columns stays.  The columns are those of ``docs``.
    """
    doc, text, again = fresh(docs, "kept_id", "kept_text", "repeated")
    each = groups.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = each.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "n")).alias("f"))
    kept = first.select(F.col("f.doc_id").alias(doc), F.col("f.text_key").alias(text), F.col("f.n").alias(again))
    out = docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(text_col) == F.col(text)), "inner")
    if first.filter("f.n > 1").isEmpty():
        return out.select(docs.columns)
    row = F.struct(*docs.columns)
    many = out.filter(F.col(again) > 1).groupBy(doc, text).agg(F.min_by(row, F.to_json(row)).alias(again))
    return out.filter(F.col(again) == 1).select(docs.columns).unionByName(many.select(F.col(again + ".*")))
