"""N-gram Jaccard join over prefix trees.

A document is the set of its distinct word n-grams, each a 64-bit hash.  Equal sets are one class from the start.
For the others, exact conditions leave ever less to compare:

* Prefixes.  In the global order of the hashes, sets that link share ``l`` of the first ``n - ceil(t n) + l`` members.
  One sorted stream of prefix members shows which ones stand in several sets, and a set with too few of those has no link.
* Segments.  Members are dealt to ``m`` segments by hash, and linked sets differ in fewer members than there are
  segments, so some segment is the same in both.  Sets that share a whole segment, over any chain, are a cluster.
* Prefix trees.  The sets of a cluster, members in a common order (frequent ones first), are stored in a tree whose upper nodes
  hold the members that many sets begin with.  Each set walks down the tree once: the overlap with a node's path is
  carried to all sets below it, and a subtree is left when not even all members that remain on both
  sides can reach the bound for any size of set in it.

A cluster of many sets is dealt twice, by different hashes, to trees of bounded size; what these
leave apart of such a cluster is compared tree by tree, so no link is lost and no cluster outgrows a task.
Tasks emit spanning forests, never all pairs, and connected components join them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortframe.llm.util import BROADCAST_KEYS, connected_components, join_keys, sliced, stage_table
from cohortframe.llm.words import SPACED, parts

SEED = 42
#: Words whose hash, and sets whose name, a worker keeps.
CACHE = 200_000
#: Sets and members of one tree at most (or one set).
TREE_SETS, TREE_MEMBERS = 512, 1 << 19
#: Members beyond the plain prefix, and segments beyond the largest difference, in hundredths of a set.
MORE_PREFIX, MORE_SEGMENTS = 5, 3
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- sets

class _Hashes(dict):
    """Hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word, SEED)
        return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


def _ordered(h: np.ndarray) -> np.ndarray:
    """Distinct values in order."""
    h = np.sort(h)
    return h[np.r_[True, h[1:] != h[:-1]]] if len(h) else h


def gram_set(text: bytes | None, grams: int, of: dict) -> np.ndarray:
    """Sorted distinct hashes of the text's word n-grams; of fewer words, the whole sequence is the only one."""
    found, carry = [], np.empty(0, np.uint64)
    for words in parts(text or b"", SPACED):
        h = np.concatenate([carry, np.fromiter(map(of.__getitem__, words), np.uint64, len(words))])
        n = len(h) - grams + 1
        if n > 0:
            out = np.full(n, grams, np.uint64)
            for k in range(grams):
                out = _mix(out * _B + h[k:k + n])
            found.append(_ordered(out))
            carry = h[n:]
        else:
            carry = h
    if found:
        return found[0] if len(found) == 1 else _ordered(np.concatenate(found))
    if not len(carry):
        return carry
    out = np.full(1, len(carry), np.uint64)
    for k in range(len(carry)):
        out = _mix(out * _B + carry[k:k + 1])
    return out


def least_overlap(n: int, percent: int) -> int:
    """Members that a set of ``n`` shares with any set it links with, at least."""
    return -(-percent * n // 100)


def extra(n: int) -> int:
    return 1 + MORE_PREFIX * n // 100


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(flat.view(np.int64)))


def _keys(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())


def prefixes(docs: DataFrame, grams: int, percent: int) -> DataFrame:
    """``(doc_id, text_key, n, key, prefix)`` of each row: size, 128-bit name of the set (null if empty), and its extended prefix.

    A task leaves the prefix out where it has just given the same set's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, given = _Hashes(), set()
        for b in sliced(batches):
            sets = [gram_set(t.as_py(), grams, of) for t in b.column(2).cast(pa.large_binary())]
            keys, heads = _keys(sets), []
            for s, key in zip(sets, keys.to_pylist()):
                heads.append(s[:0] if key in given else s[:len(s) - least_overlap(len(s), percent) + extra(len(s))])
                given.add(key)
            if len(given) >= CACHE:
                given.clear()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), keys, _lists(heads)], ["doc_id", "text_key", "n", "key", "prefix"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, n long, key binary, prefix array<long>")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many members of each set's prefix stand in another set; rows ``(member, name)`` come sorted and may repeat.

    A task's first and last member may go on in other tasks and count as shared, which only keeps more sets.
    """
    before = None
    held: list[np.ndarray] = []
    rows = 0
    found: list[np.ndarray] = []

    def take(table: np.ndarray, after: bool) -> np.ndarray:
        member = table[:, 0]
        same = member[1:] == member[:-1]
        first, last = before is None or before == member[0], not after
        return table[np.r_[first, same] | np.r_[same, last], 1]

    for b in batches:
        if not b.num_rows:
            continue
        held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1))
        rows += b.num_rows
        if rows >= 1 << 18:
            table = _distinct(held)
            last = int(np.searchsorted(table[:, 0], table[-1, 0]))
            if last:
                found.append(take(table[:last], True))
                before = table[last - 1, 0]
            elif len(table) > 1:
                # one member fills all that is held: its rows are shared, the last one stays open
                found.append(table[:-1, 1])
                before, last = table[-1, 0], len(table) - 1
            held, rows = [table[last:]], len(table) - last
            if sum(map(len, found)) >= 1 << 18:
                yield _counted(found)
    if rows:
        found.append(take(_distinct(held), False))
    if found:
        yield _counted(found)


def _distinct(held: list[np.ndarray]) -> np.ndarray:
    table = np.concatenate(held)
    return table[np.r_[True, (table[1:] != table[:-1]).any(axis=1)]]


def _counted(found: list[np.ndarray]) -> pa.RecordBatch:
    name, n = np.unique(np.concatenate(found), return_counts=True)
    found.clear()
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(n)], ["name", "shared"])


# ---------------------------------------------------------------- clusters

def size_class(n: np.ndarray | int, percent: int) -> int:
    """Sets that link are of the same or of neighbouring classes."""
    k, top = 0, 1
    while n > top:
        k, top = k + 1, max(top + 1, top * 100 // percent)
    return k


def class_top(k: int, percent: int) -> int:
    top = 1
    for _ in range(k):
        top = max(top + 1, top * 100 // percent)
    return top


def segments_of(k: int, percent: int) -> tuple[int, int]:
    """``(segments, spare)`` for pairs whose smaller set is of class ``k``: at least ``spare + 1`` segments agree."""
    top = class_top(k, percent)
    # |A| <= top, |B| <= |A| * 100 / percent and the overlap is percent / (100 + percent) of both sizes at least
    differ = top * (100 - percent) // percent
    spare = MORE_SEGMENTS * top // 100 + (top >= 12)
    return differ + spare + 1, spare


def segment_names(members: np.ndarray, k: int, percent: int) -> np.ndarray:
    """Names of the segments by which a set meets its partners among pairs with a smaller set of class ``k``.

    Segments with one member or none are named only if there are more of them than the spare ones.
    """
    m, spare = segments_of(k, percent)
    at = (_mix(members ^ _B) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
    total = np.zeros(m, np.uint64)
    np.add.at(total, at, _mix(members))  # a sum does not depend on the order
    size = np.bincount(at.astype(np.int64), minlength=m)
    name = _mix(_mix(total + np.arange(m, dtype=np.uint64) * _A) ^ np.full(1, k + 1, np.uint64) * _B)
    strong = size > 1
    return name[strong] if m - np.count_nonzero(strong) <= spare else name


def survivors(docs: DataFrame, grams: int, percent: int) -> DataFrame:
    """``(key, n, members, segments)`` of the sets that may have links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _Hashes()
        for b in sliced(batches, 128):
            sets = [gram_set(t.as_py(), grams, of) for t in b.column(0).cast(pa.large_binary())]
            names = []
            for s in sets:
                k = size_class(len(s), percent)
                names.append(np.unique(np.concatenate([segment_names(s, c, percent) for c in (k - 1, k) if c >= 0])))
            yield pa.RecordBatch.from_arrays([_keys(sets), pa.array([len(s) for s in sets], pa.int64()), _lists(sets), _lists(names)], ["key", "n", "members", "segments"])

    return docs.select("text").mapInArrow(run, "key binary, n long, members array<long>, segments array<long>")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between the sets of each segment and the first of them; rows ``(segment, key)`` come sorted.

    A task's first and last segment may go on in other tasks and are vertices themselves (names of 9 bytes).
    """
    seen: set[tuple[bytes, bytes]] = set()
    first_segment, segment, head, n = None, None, None, 0

    def flush() -> pa.RecordBatch:
        out = list(seen)
        seen.clear()
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in out], pa.binary()), pa.array([e[1] for e in out], pa.binary())], ["u", "v"])

    def vertex(segment: int) -> bytes:
        return b"s" + segment.to_bytes(8, "big", signed=True)

    for b in batches:
        for s, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if s != segment:
                if first_segment is None:
                    first_segment = s
                    seen.add((vertex(s), key))
                segment, head = s, key
            elif key != head:
                seen.add((head, key))
        if len(seen) >= 1 << 16:
            yield flush()
    if segment is not None:
        seen.add((vertex(segment), head))
    yield flush()


# ---------------------------------------------------------------- trees

class Tree:
    """A prefix tree of sets with paths without branches in one node.

    ``tokens[first[i]:first[i] + size[i]]`` are the members of node ``i``, ``depth[i]`` those of its path; below it are the sets
    ``low[i]`` to ``high[i]`` in the tree's order, with ``least[i]`` to ``most[i]`` members.
    """

    def __init__(self, sets: list[np.ndarray]):
        values, ranks = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(ranks)
        place = np.empty(len(values), np.int64)
        place[np.lexsort((values, -often))] = np.arange(len(values))  # the common order: frequent members first
        cuts = np.cumsum([len(s) for s in sets])[:-1]
        paths = [np.sort(p) for p in np.split(place[ranks], cuts)]
        self.order = sorted(range(len(sets)), key=lambda i: paths[i].tolist())
        self.paths = [paths[i] for i in self.order]
        self.vocabulary = len(values)
        nodes: list[list] = []  # parent, tokens, depth, low, high
        open_: list[int] = []
        for i, path in enumerate(self.paths):
            if i:
                last = self.paths[i - 1]
                n = min(len(last), len(path))
                differ = np.flatnonzero(last[:n] != path[:n])
                common = int(differ[0]) if len(differ) else n
                while open_ and nodes[open_[-1]][2] - len(nodes[open_[-1]][1]) >= common and common < nodes[open_[-1]][2]:
                    nodes[open_.pop()][4] = i - 1
                if open_ and nodes[open_[-1]][2] > common:  # the branch is within this node: cut it in two
                    node = nodes[open_[-1]]
                    keep = common - (node[2] - len(node[1]))
                    upper = [node[0], node[1][:keep], common, node[3], None]
                    nodes.append(upper)
                    node[0], node[1], node[4] = len(nodes) - 1, node[1][keep:], i - 1
                    open_[-1] = len(nodes) - 1
                at = common
            else:
                at = 0
            nodes.append([open_[-1] if open_ else -1, path[at:], len(path), i, None])
            open_.append(len(nodes) - 1)
        for k in open_:
            nodes[k][4] = len(sets) - 1
        parent = np.array([n[0] for n in nodes])
        level = np.zeros(len(nodes), np.int64)
        up = parent.copy()
        while (up >= 0).any():
            level += up >= 0
            up = np.where(up >= 0, parent[up], -1)
        rank = np.lexsort((np.array([n[3] for n in nodes]), parent, level))
        self.size = np.array([len(nodes[k][1]) for k in rank])
        self.first = np.cumsum(self.size) - self.size
        self.tokens = np.concatenate([nodes[k][1] for k in rank])
        self.depth = np.array([nodes[k][2] for k in rank])
        self.low, self.high = (np.array([nodes[k][j] for k in rank]) for j in (3, 4))
        lengths = np.array([len(p) for p in self.paths])
        self.least = np.array([lengths[a:b + 1].min() for a, b in zip(self.low, self.high)])
        self.most = np.array([lengths[a:b + 1].max() for a, b in zip(self.low, self.high)])
        new = np.empty(len(rank), np.int64)
        new[rank] = np.arange(len(rank))
        above = np.where(parent[rank] >= 0, new[parent[rank]], -1)
        by = np.argsort(above, kind="stable")
        self.roots = by[:np.searchsorted(above[by], 0)]
        kids = above[by]
        self.kid_first, self.kid_last = np.searchsorted(kids, np.arange(len(rank))), np.searchsorted(kids, np.arange(len(rank)), side="right")
        self.kids = by

    def partners(self, path: np.ndarray, percent: int) -> Iterator[int]:
        """Places of the sets that link with the set ``path``, itself included if it is in the tree."""
        n = len(path)
        has = np.zeros(self.vocabulary, np.int64)
        has[path] = 1
        level = self.roots
        overlap = np.zeros(len(level), np.int64)
        while len(level):
            size = self.size[level]
            at = np.repeat(self.first[level] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            tokens = self.tokens[at]
            overlap = overlap + np.add.reduceat(has[tokens], np.cumsum(size) - size)
            deepest = tokens[np.cumsum(size) - 1]
            left = n - np.searchsorted(path, deepest, side="right")  # members of the set beyond the node
            # the bound is easiest for the size at which the rest on both sides is equal
            s = np.clip(self.depth[level] + left, self.least[level], self.most[level])
            alive = (100 + percent) * (overlap + np.minimum(left, s - self.depth[level])) >= percent * (n + s)
            level, overlap = level[alive], overlap[alive]
            whole = self.least[level] == self.depth[level]  # sets that end at the node
            for node, o in zip(level[whole].tolist(), overlap[whole].tolist()):
                if (100 + percent) * o >= percent * (n + int(self.depth[node])):
                    yield int(self.low[node])  # sets are distinct, and the one that ends here comes first
            count = self.kid_last[level] - self.kid_first[level]
            overlap = np.repeat(overlap, count)
            level = self.kids[np.repeat(self.kid_first[level] - (np.cumsum(count) - count), count) + np.arange(count.sum())]


def forest(sets: list[np.ndarray], percent: int, asked: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """Links between ``sets`` (distinct) that connect all linked ones; only links of the ``asked`` if given."""
    tree = Tree(sets)
    label = list(range(len(sets)))

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    wanted = None if asked is None else set(asked)
    for at, i in enumerate(tree.order):
        if wanted is not None and i not in wanted:
            continue
        for other in tree.partners(tree.paths[at], percent):
            j = tree.order[other]
            a, b = find(i), find(j)
            if a != b:
                label[a] = b
                yield i, j


def stars(n: int, links: Iterator[tuple[int, int]]) -> list[int]:
    """For each of ``n`` members the least one of its component."""
    head = list(range(n))

    def find(i: int) -> int:
        while head[i] != i:
            head[i] = i = head[head[i]]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        head[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _walk(percent: int, with_asked: bool):
    """Forests of the groups in rows ``(group, key, members[, asked])`` sorted by group and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sets = None, {}

        def links() -> pa.RecordBatch:
            keys = list(sets)
            asked = [i for i, k in enumerate(keys) if sets[k][1]] if with_asked else None
            head = stars(len(keys), forest([sets[k][0] for k in keys], percent, asked))  # keys come sorted: the least one of each component
            out = [i for i, h in enumerate(head) if h != i]
            return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in out], pa.binary()), pa.array([keys[head[i]] for i in out], pa.binary())], ["u", "v"])

        for b in batches:
            ends = b.column(2).offsets.to_numpy()
            flat = b.column(2).values.to_numpy()
            more = b.column(3).to_pylist() if with_asked else [True] * b.num_rows
            for row, (g, key) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if g != group:
                    if len(sets) > 1:
                        yield links()
                    group, sets = g, {}
                sets[key] = (flat[ends[row]:ends[row + 1]].copy(), more[row] or key in sets and sets[key][1])
        if len(sets) > 1:
            yield links()

    return run


def _trees(rows: DataFrame, percent: int, with_asked: bool = False) -> DataFrame:
    columns = ["tree", "key", "members", *(["asked"] if with_asked else [])]
    dealt = rows.select(*columns).repartition("tree").sortWithinPartitions("tree", "key")
    return dealt.mapInArrow(_walk(percent, with_asked), "u binary, v binary")


def _settled(edges: DataFrame) -> bool:
    """Whether each vertex has one edge up, to a vertex that has none: then these are the components."""
    if not edges.groupBy("u").count().filter("count > 1").isEmpty():
        return False
    return edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def _roots(edges: DataFrame, name: str) -> DataFrame:
    """``(key, root)`` for all vertices but the roots; edges that are stars already need no round."""
    edges = stage_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), name)
    found = edges if _settled(edges) else stage_table(connected_components(edges, name).select("u", F.col("root").alias("v")), name + "-roots")
    return found.select(F.col("u").alias("key"), F.col("v").alias("root"))


def links(docs: DataFrame, table: DataFrame, percent: int, grams: int, tree_sets: int = TREE_SETS, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """``(key, root)``: the component of each set of ``docs`` that has a link, but of the roots themselves; ``table`` holds the sets' prefixes."""
    of_key = table.filter("key is not null")
    name = F.xxhash64("key")
    member = of_key.select(F.explode("prefix").alias("member"), name.alias("name"))
    stream = member.repartitionByRange("member", "name").sortWithinPartitions("member", "name")
    counted = stream.mapInArrow(_shared, "name long, shared long").groupBy("name").agg(F.sum("shared").alias("shared"))
    classes = of_key.groupBy("key").agg(F.min(F.struct("doc_id", "text_key")).alias("of"), F.min("n").alias("n"))
    least = F.lit(1) + F.floor(F.lit(MORE_PREFIX) * F.ceil(F.lit(percent) * F.col("n") / 100) / 100)
    left = classes.join(counted, name == F.col("name")).filter(F.col("shared") >= least)
    left = stage_table(left.select(F.col("of.doc_id").alias("left_id"), F.col("of.text_key").alias("left_text")).distinct(), "jaccard-left")
    texts = join_keys(docs, left, F.col("doc_id").eqNullSafe(F.col("left_id")) & (F.col("text_key") == F.col("left_text")), "left_semi")
    sets = stage_table(survivors(texts, grams, percent), "jaccard-sets")

    segments = sets.select(F.explode("segments").alias("segment"), "key")
    edges = segments.repartitionByRange("segment", "key").sortWithinPartitions("segment", "key").mapInArrow(_stars, "u binary, v binary")
    clusters = _roots(edges, "jaccard-clusters")
    # a cluster's members are its edges' ends and its root; vertices that stand for segments have other names
    inner = clusters.union(clusters.select(F.col("root").alias("key"), "root").distinct()).filter(F.octet_length("key") == 16)
    placed = inner.join(sets.select(F.col("key").alias("of_key"), "n").distinct(), F.col("key") == F.col("of_key")).select("of_key", "root", "n")
    blocks = F.ceil(F.greatest(F.count("*") / tree_sets, F.sum("n") / tree_members)).cast("int")
    large = stage_table(placed.groupBy(F.col("root").alias("of_root")).agg(blocks.alias("blocks")).filter("blocks > 1"), "jaccard-large")
    few = large.count() <= BROADCAST_KEYS  # one in tree_sets of the sets at most
    placed = placed.join(F.broadcast(large) if few else large, F.col("root") == F.col("of_root"), "left")
    placed = stage_table(placed.select("of_key", "root", F.coalesce("blocks", F.lit(1)).alias("blocks")), "jaccard-placed")
    few = placed.count() <= BROADCAST_KEYS
    members = sets.join(F.broadcast(placed) if few else placed, F.col("key") == F.col("of_key")).select("key", "n", "members", "root", "blocks")
    block = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("blocks"))
    deals = F.when(F.col("blocks") > 1, F.array(block(1), block(2) + F.col("blocks"))).otherwise(F.array(F.lit(0).cast("long")))
    tree = F.concat("root", F.concat(F.lit(":"), F.col("deal").cast("string")).cast("binary"))
    found = stage_table(_trees(members.withColumn("deal", F.explode(deals)).withColumn("tree", tree), percent), "jaccard-links")
    if large.isEmpty():
        return _roots(found, "jaccard-components")
    parts = _roots(found, "jaccard-parts")
    rest = stage_table(_trees(_rest(members.filter("blocks > 1"), parts), percent, with_asked=True), "jaccard-rest")
    if rest.isEmpty():
        return parts
    return _roots(parts.select(F.col("key").alias("u"), F.col("root").alias("v")).union(rest), "jaccard-components")


def _rest(large: DataFrame, parts: DataFrame) -> DataFrame:
    """For clusters in several trees: the sets outside the cluster's largest component so far, asked against each tree of the cluster."""
    so_far = large.join(parts.withColumnRenamed("root", "part"), "key", "left").withColumn("part", F.coalesce("part", "key"))
    part = so_far.groupBy("root", "part").agg(F.count("*").alias("sets"))
    most = part.groupBy(F.col("root").alias("m_root")).agg(F.max(F.struct("sets", "part")).alias("m"), F.sum("sets").alias("all"))
    open_ = stage_table(most.filter(F.col("m.sets") < F.col("all")).select("m_root", F.col("m.part").alias("m_part")), "jaccard-open")
    so_far = stage_table(so_far.join(open_, F.col("root") == F.col("m_root")).drop("m_root"), "jaccard-parted")
    asked = so_far.filter(F.col("part") != F.col("m_part"))
    bins = asked.groupBy(F.col("root").alias("b_root")).agg((F.ceil(F.count("*") / TREE_SETS) + F.ceil(F.sum("n") / TREE_MEMBERS)).cast("int").alias("bins"))
    place = F.pmod(F.xxhash64(F.lit(3), "key"), F.col("blocks"))
    dealt = so_far.join(bins, F.col("root") == F.col("b_root")).drop("b_root").withColumn("bin", F.pmod(F.xxhash64(F.lit(4), "key"), F.col("bins")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = dealt.withColumn("place", place).withColumn("bin", every("bins")).withColumn("asked", F.lit(False))
    two = dealt.filter(F.col("part") != F.col("m_part")).withColumn("place", every("blocks")).withColumn("asked", F.lit(True))
    tree = F.concat("root", F.concat(F.lit(":"), F.col("place").cast("string"), F.lit(":"), F.col("bin").cast("string")).cast("binary"))
    columns = ["root", "key", "members", "asked", "place", "bin"]
    return one.select(columns).union(two.select(columns)).withColumn("tree", tree)


def join(docs: DataFrame, grams: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", tree_sets: int = TREE_SETS, tree_members: int = TREE_MEMBERS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``.

    Sets link when ``100 * |A and B| >= percent * |A or B|``; ``component_id`` is the smallest doc_id reachable.
    Null and empty texts, and texts without words, have empty sets and link with nothing: each is a
    component of its own.  Repeated rows and repeated ids give a row each.  A null doc_id stays in its
    component and is its id only if all members are null.  An empty table gives no rows; further
    columns are not looked at.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    table = stage_table(prefixes(rows, grams, percent), "jaccard-prefixes")
    roots = links(rows, table, percent, grams, tree_sets, tree_members)
    classes = table.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    classes = stage_table(classes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key")), "jaccard-named")
    groups = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_key = classes.join(groups, "root").select(F.col("key").alias("of_key"), F.col("component_id").alias("of_id"))
    out = table.drop("prefix").join(of_key, F.col("key") == F.col("of_key"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("of_id")).alias("component_id"))


ORACLE_SQL = """
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM words WHERE len(w) >= 4)
         UNION SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM sets x JOIN sets y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN sizes s ON s.doc_id = x.doc_id JOIN sizes t ON t.doc_id = y.doc_id
          GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 85 * (min(s.n) + min(t.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.a, r.c FROM links l JOIN reach r ON l.b = r.a),
least AS (SELECT a, min(c) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN least l ON l.a = d.doc_id
"""
