"""Similarity join on five-word shingles: prefix clusters, count-vector R-trees, exact check.

Two documents link when ``100 * intersection >= 75 * union`` of their shingle sets.

1. Equal sets become one node, named by a 64-bit hash of the set.
2. Nodes meet through prefixes: of n shingles in one fixed order, any two linked sets
   share one of their first n - ceil(0.75 n) + 1. The nodes of a prefix shingle are
   put into the cluster of the smallest of them, so linked nodes share a cluster.
3. In a cluster, shingles are hashed into groups; the group counts are points of an
   R-tree. The intersection of two sets is at most the sum of the smaller counts,
   which discards subtrees and points; what survives is compared exactly.
   This runs twice: on the points alone, which are small, to drop the nodes that no
   other may link with; then on the sets of the rest.
4. Links become components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm import hashing
from pricegrid.llm.common import SIMILARITY, signed, staged, texts

#: Cells of the table of shingle counts that orders shingles, and its pieces.
CELLS, PIECE = 1 << 20, 1 << 14
#: Shingles of a cluster that one task takes at once; larger clusters are cut into blocks.
BLOCK_SHINGLES = 2_000_000
#: Bits of the table that says which nodes are in clusters.
MEMBER_BITS = 1 << 23
_BATCH = 1 << 20


def links(a: np.ndarray, b: np.ndarray, similarity=SIMILARITY) -> bool:
    """Whether two sorted distinct arrays are similar enough."""
    part, whole = similarity
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if whole * len(small) < part * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return whole * both >= part * (len(a) + len(b) - both)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingles of a text's words."""
    s = hashing.shingle_hashes(words)
    s.sort()
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _sets(batches) -> Iterator[tuple[object, np.ndarray, int]]:
    for batch in batches:
        for doc_id, words in zip(batch["doc_id"].to_pylist(), hashing.rows(batch)):
            s = shingle_set(words)
            yield doc_id, s, node_of(s) if len(s) else 0


# --- pass 1: nodes and counts ---------------------------------------------------

_NODES = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("piece", pa.int32()),
                    ("counts", pa.binary())])
_NODES_DDL = "doc_id long, node long, n long, piece int, counts binary"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end the task's counts of shingles per cell."""
    cells, seen, rows = np.zeros(CELLS, dtype=np.int64), set(), []
    waiting, size = [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODES)], schema=_NODES)

    for doc_id, s, node in _sets(batches):
        rows.append((doc_id, node, len(s), None, None))
        if len(s) and node not in seen:
            seen.add(node)
            waiting.append((s & np.uint64(CELLS - 1)).astype(np.int64))
            size += len(s)
        if size >= CELLS:
            cells += np.bincount(np.concatenate(waiting), minlength=CELLS)
            waiting, size = [], 0
        if len(rows) >= 5_000:
            yield batch_of(rows)
            rows = []
    if rows:
        yield batch_of(rows)
    if waiting:
        cells += np.bincount(np.concatenate(waiting), minlength=CELLS)
    for k in range(0, CELLS, PIECE):
        if cells[k : k + PIECE].any():
            yield batch_of([(None, None, None, k // PIECE, cells[k : k + PIECE].astype("<u4").tobytes())])


def _add_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch["piece"].to_pylist(), batch["counts"].to_pylist()):
            new = np.frombuffer(counts, dtype="<u4").astype(np.int64)
            total[piece] = total[piece] + new if piece in total else new
    for piece, counts in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([counts.astype("<i8").tobytes()], pa.binary())],
            names=["piece", "counts"],
        )


def shingle_levels(nodes: DataFrame) -> np.ndarray:
    """Level of every cell: 0 for usual counts, then one more for each doubling.

    The counts cover every shingle of every distinct set. A cell holds many shingles;
    one that many documents share stands out of it. The table has a fixed size.
    """
    summed = (
        nodes.where("piece IS NOT NULL")
        .select("piece", "counts")
        .repartition(CELLS // PIECE, "piece")
        .mapInArrow(_add_pieces, "piece int, counts binary")
        .collect()
    )
    cells = np.zeros(CELLS)
    for piece, counts in summed:
        cells[piece * PIECE : (piece + 1) * PIECE] = np.frombuffer(counts, dtype="<i8")
    mean = cells.mean()
    usual = mean + 5 * np.sqrt(mean) + 1
    return np.clip(np.floor(np.log2(np.maximum(cells / usual, 0.5))) + 1, 0, 15).astype(np.uint8)


# --- pass 2: prefixes -----------------------------------------------------------


def prefix_of(s: np.ndarray, levels: np.ndarray, similarity=SIMILARITY) -> np.ndarray:
    """The prefix of a set, rare shingles first, as tokens of level and hash."""
    part, whole = similarity
    length = len(s) - -(-part * len(s) // whole) + 1
    level = levels[(s & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    tokens = (level << np.uint64(60)) | (s >> np.uint64(4))
    return np.partition(tokens, length - 1)[:length] if length < len(tokens) else tokens


def _prefixes(batches: Iterator[pa.RecordBatch], levels: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen, tokens, nodes, size = set(), [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(nodes))], names=["token", "node"]
        )

    for _, s, node in _sets(batches):
        if not len(s) or node in seen:
            continue
        seen.add(node)
        p = prefix_of(s, levels)
        tokens.append(p)
        nodes.append(np.full(len(p), node, dtype=np.int64))
        size += len(p)
        if size >= 100_000:
            yield flush()
            tokens, nodes, size = [], [], 0
    if tokens:
        yield flush()


def clusters(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(hub, node): nodes that share a prefix shingle, under the smallest of them.

    A shingle's nodes are first reduced to their smallest and largest in the map tasks;
    the rows then join that result, which the adaptive plan can split at a hot shingle.
    """
    rows = docs.mapInArrow(lambda it: _prefixes(it, levels), "token long, node long")
    shared = (
        rows.groupBy("token")
        .agg(F.min("node").alias("hub"), F.max("node").alias("last"))
        .where("hub <> last")
        .select("token", "hub")
    )
    return rows.join(shared.hint("shuffle_hash"), "token").select("hub", "node").distinct()


# --- pass 3: R-trees ------------------------------------------------------------


class CountTree:
    """R-tree over count vectors, packed bottom up; kept level by level as arrays.

    A node keeps the largest count per group and the smallest and largest set size of
    its points. No set below it shares more with a query than the sum over the groups
    of the smaller count.
    """

    FANOUT = 8

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes
        self.order = self._packed(counts, sizes)
        upper, low, high = counts[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(upper, low, high)]
        while len(upper) > self.FANOUT:
            cut = np.arange(0, len(upper), self.FANOUT)
            upper = np.maximum.reduceat(upper, cut, axis=0)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((upper, low, high))

    @staticmethod
    def _packed(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Points in an order that keeps like ones together: halves along the widest group."""
        out, stack = [], [np.argsort(sizes, kind="stable")]
        while stack:
            ids = stack.pop()
            if len(ids) <= CountTree.FANOUT:
                out.append(ids)
                continue
            part = counts[ids]
            axis = int(np.argmax(part.max(0) - part.min(0)))
            ids = ids[np.argsort(part[:, axis], kind="stable")]
            middle = -(-len(ids) // 2 // CountTree.FANOUT) * CountTree.FANOUT or CountTree.FANOUT
            stack += [ids[middle:], ids[:middle]]
        return np.concatenate(out)

    def search(self, query: np.ndarray, size: int, similarity=SIMILARITY) -> np.ndarray:
        """Points that may link with the query: sizes fit and the bound is large enough."""
        part, whole = similarity
        at = None
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            if at is None:
                at = np.arange(len(upper))
            else:
                at = (at[:, None] * self.FANOUT + np.arange(self.FANOUT)).ravel()
                at = at[at < len(upper)]
            # the smallest partner below that could still link
            least = np.maximum(low[at], -(-part * size // whole))
            fits = (whole * high[at] >= part * size) & (part * low[at] <= whole * size)
            bound = np.minimum(upper[at], query).sum(axis=1)
            fits &= (whole + part) * bound >= part * (size + least)
            at = at[fits]
            if not len(at):
                return at
        return self.order[at]


def groups_for(size: int) -> int:
    """Groups for a set: a power of two, so that a group holds two to four of its shingles."""
    return 1 << max(2, (size // 4).bit_length())


def count_vector(s: np.ndarray) -> np.ndarray:
    return np.bincount((s >> np.uint64(20)).astype(np.int64) & (groups_for(len(s)) - 1), minlength=groups_for(len(s)))


def folded(vector: np.ndarray, groups: int) -> np.ndarray:
    """A vector with fewer groups: each is the sum of some of the old ones."""
    return vector.reshape(-1, groups).sum(axis=0)


class SizeBands:
    """Count-vector trees by set size; sets that may link are in the same band or the next.

    A tree has as many groups as the smallest set of the band below would have, so
    that vectors of all three bands that may ask it can be folded to it.
    """

    def __init__(self, vectors: list[np.ndarray], sizes: np.ndarray):
        self.vectors, self.sizes, self.trees = vectors, sizes, {}
        bands = np.array([int(n).bit_length() for n in sizes])
        for band in np.unique(bands):
            ids = np.flatnonzero(bands == band)
            groups = groups_for(1 << max(0, int(band) - 2))
            counts = np.stack([folded(vectors[k], groups) for k in ids])
            self.trees[int(band)] = (ids, groups, CountTree(counts, sizes[ids]))

    def search(self, vector: np.ndarray, size: int) -> np.ndarray:
        band, found = int(size).bit_length(), []
        for k in (band - 1, band, band + 1):
            if k in self.trees:
                ids, groups, tree = self.trees[k]
                found.append(ids[tree.search(folded(vector, groups), size)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def within_bound(vectors: list[np.ndarray], sizes: np.ndarray, hub: int, own: int) -> np.ndarray:
    """Which of the first ``own`` sets may link with the hub."""
    part, whole = SIMILARITY
    out = np.zeros(own, dtype=bool)
    near = (whole * np.minimum(sizes[:own], sizes[hub]) >= part * np.maximum(sizes[:own], sizes[hub])).nonzero()[0]
    for k in near:
        groups = min(len(vectors[k]), len(vectors[hub]))
        bound = np.minimum(folded(vectors[k], groups), folded(vectors[hub], groups)).sum()
        out[k] = (whole + part) * bound >= part * (sizes[k] + sizes[hub])
    return out


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def block_links(sets: list[np.ndarray], hub: int | None, guests: int = 0) -> tuple[list[tuple[int, int]], list[int]]:
    """Links that connect what is connected in one block, and members not tied to the hub.

    The hub is compared first; members linked with it need no comparison among
    themselves. Everything else is looked up in the trees of all points, and compared
    unless already connected. The last ``guests`` sets are only looked up.
    """
    sizes = np.array([len(s) for s in sets])
    own = len(sets) - guests
    union, edges = _Union(len(sets)), []
    vectors = [count_vector(x) for x in sets]
    if hub is not None:
        for k in np.flatnonzero(within_bound(vectors, sizes, hub, own)):
            if k != hub and links(sets[k], sets[hub]):
                union.join(int(k), hub)
                edges.append((int(k), hub))
    root = union.find(hub) if hub is not None else None
    apart = [k for k in range(own) if union.find(k) != root] if not guests else []
    queries = range(own, len(sets)) if guests else apart
    if own and len(queries):
        trees = SizeBands(vectors[:own], sizes[:own])
        for k in queries:
            for j in trees.search(vectors[k], int(sizes[k])):
                j = int(j)
                if j != k and union.find(j) != union.find(k) and links(sets[j], sets[k]):
                    union.join(j, k)
                    edges.append((k, j))
    return edges, apart


def may_link(vectors: list[np.ndarray], sizes: np.ndarray, hub: int | None) -> np.ndarray:
    """Which sets of a cluster some other set of it may link with, by the bound alone."""
    out = np.zeros(len(sizes), dtype=bool)
    if hub is not None:
        out = within_bound(vectors, sizes, hub, len(sizes))
        out[hub] = False
        out[hub] = out.any()
    if not out.all():
        trees = SizeBands(vectors, sizes)
        for k in np.flatnonzero(~out):
            near = trees.search(vectors[k], int(sizes[k]))
            if len(near) > 1 or (len(near) == 1 and near[0] != k):
                out[k] = True
                out[near] = True
    return out


_SET_DDL = "node long, shingles array<long>"
_LINKS_DDL = "a long, b long, apart boolean"


def _table(keys: DataFrame) -> np.ndarray:
    """Bits of the nodes in a table of fixed size; others are let through now and then."""
    bit = F.col("node").bitwiseAND(F.lit(MEMBER_BITS - 1))
    table = np.zeros(MEMBER_BITS // 64, dtype=np.uint64)
    for word, bits in (
        keys.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
        .collect()  # at most MEMBER_BITS / 64 rows
    ):
        table[word] = np.uint64(bits % (1 << 64))
    return table


def _listed(batches, table: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    seen = set()
    for _, s, node in _sets(batches):
        bit = node & (MEMBER_BITS - 1)
        if len(s) and node not in seen and (int(table[bit >> 6]) >> (bit & 63)) & 1:
            seen.add(node)
            yield s, node


def _members(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Shingles of the nodes that the table has, each once per task."""
    nodes, sets, size = [], [], 0

    def flush():
        lengths = np.cumsum([0, *map(len, sets)])
        values = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(signed(np.concatenate(sets))))
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), values], names=["node", "shingles"])

    for s, node in _listed(batches, table):
        nodes.append(node)
        sets.append(s)
        size += len(s)
        if size >= _BATCH // 2:
            yield flush()
            nodes, sets, size = [], [], 0
    if nodes:
        yield flush()


def _points(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sizes and count vectors of the nodes that the table has, each once per task."""
    nodes, sizes, vectors, held = [], [], [], 0

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary())],
            names=["node", "n", "vector"],
        )

    for s, node in _listed(batches, table):
        v = count_vector(s)
        nodes.append(node)
        sizes.append(len(s))
        # one byte for each group where that is enough; the length tells which
        vectors.append(v.astype(np.uint8 if v.max() < 256 else "<u4").tobytes())
        held += len(vectors[-1])
        if held >= _BATCH:
            yield flush()
            nodes, sizes, vectors, held = [], [], [], 0
    if nodes:
        yield flush()


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each cluster the nodes that some other node of it may link with."""

    def kept(hub, rows):
        names = [r[0] for r in rows]
        sizes = np.array([r[1] for r in rows])
        vectors = [
            np.frombuffer(v, np.uint8 if len(v) == groups_for(n) else "<u4").astype(np.int64) for _, n, v in rows
        ]
        may = may_link(vectors, sizes, names.index(hub) if hub in names else None)
        return [(hub, names[k]) for k in np.flatnonzero(may)]

    def flush(out):
        hubs, nodes = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], names=["hub", "node"])

    hub, rows, out = None, [], []
    for batch in batches:
        for h, *row in zip(*(batch[c].to_pylist() for c in ("hub", "node", "n", "vector"))):
            if h != hub:
                if len(rows) > 1:
                    out += kept(hub, rows)
                hub, rows = h, []
            rows.append(row)
        if len(out) > 20_000:
            yield flush(out)
            out = []
    if len(rows) > 1:
        out += kept(hub, rows)
    if out:
        yield flush(out)


def _runs(batches: Iterator[pa.RecordBatch]):
    """Rows of one (hub, block) at a time, from rows sorted by these."""
    key, rows = None, []
    for batch in batches:
        lists = batch["shingles"]
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
        hubs, blocks = batch["hub"].to_pylist(), batch["block"].to_pylist()
        nodes, guests = batch["node"].to_pylist(), batch["guest"].to_pylist()
        for k in range(batch.num_rows):
            if (hubs[k], blocks[k]) != key:
                if rows:
                    yield key[0], rows
                key, rows = (hubs[k], blocks[k]), []
            begin = int(ends[k - 1]) if k else 0
            rows.append((guests[k], nodes[k], flat[begin : int(ends[k])].copy()))
    if rows:
        yield key[0], rows


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []

    def flush():
        a, b, apart = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(apart, pa.bool_())], names=["a", "b", "apart"]
        )

    for hub, rows in _runs(batches):
        if len(rows) < 2:
            continue
        rows.sort(key=lambda r: r[:2])  # own rows before guests
        guests = sum(r[0] for r in rows)
        if guests == len(rows):
            continue
        names, sets = [r[1] for r in rows], [r[2] for r in rows]
        at = names.index(hub) if not guests and hub in names else None
        edges, apart = block_links(sets, at, guests)
        out += [(names[a], names[b], False) for a, b in edges]
        out += [(names[k], hub, True) for k in apart]
        if len(out) > 20_000:
            yield flush()
            out = []
    if out:
        yield flush()


def find_links(docs: DataFrame, nodes: DataFrame, levels: np.ndarray) -> DataFrame:
    """Links (a, b) that connect all nodes that chains of links connect.

    A cluster of more than ``BLOCK_SHINGLES`` is cut into blocks by a hash, and its hub
    goes to each of them. What is not tied to the hub there is compared with the other
    blocks in a second step; the rest is connected through the hub already.
    """
    pairs = staged(clusters(docs, levels), "jaccard-clusters")
    sizes = nodes.where("n > 0").groupBy("node").agg(F.max("n").alias("n"))
    large = (
        pairs.join(sizes, "node")
        .groupBy("hub")
        .agg(F.sum("n").alias("total"))
        .where(F.col("total") > BLOCK_SHINGLES)
        .select("hub", F.ceil(F.col("total") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    )
    large = staged(large, "jaccard-large")
    # points first, a sixteenth of the sets: most clusters met by chance, and end here
    table = _table(pairs)
    points = docs.mapInArrow(lambda it: _points(it, table), "node long, n long, vector binary").dropDuplicates(["node"])
    small = pairs.join(large, "hub", "left_anti").join(points, "node").select("hub", "node", "n", "vector")
    near = small.repartition("hub").sortWithinPartitions("hub").mapInArrow(_bounded, "hub long, node long")
    pairs = staged(near.unionByName(pairs.join(large, "hub", "left_semi")), "jaccard-near")
    listed = _table(pairs)
    sets = docs.mapInArrow(lambda it: _members(it, listed), _SET_DDL).dropDuplicates(["node"])
    dealt = pairs.join(large, "hub", "left").select(
        "hub", "node", F.coalesce("blocks", F.lit(1)).alias("blocks"), F.expr("pmod(xxhash64(node), coalesce(blocks, 1))").alias("own")
    )
    placed = dealt.select(
        "hub", "node", F.lit(False).alias("guest"),
        F.explode(F.when(F.col("node") == F.col("hub"), F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).otherwise(F.array("own"))).alias("block"),
    )

    def linked(rows: DataFrame) -> DataFrame:
        whole = rows.join(sets, "node").select("hub", "block", "guest", "node", "shingles")
        return whole.repartition("hub", "block").sortWithinPartitions("hub", "block").mapInArrow(_link, _LINKS_DDL)

    first = staged(linked(placed), "jaccard-links")
    edges = first.where("NOT apart").select("a", "b")
    apart = first.where("apart").select(F.col("b").alias("hub"), F.col("a").alias("node")).distinct().join(large, "hub")
    if apart.isEmpty():
        return edges
    every = apart.select(
        "hub", "node", F.expr("pmod(xxhash64(node), blocks)").alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"),
    ).where("own <> block").select("hub", "node", F.lit(True).alias("guest"), "block")
    hosts = placed.join(large.select("hub"), "hub", "left_semi").where("node <> hub OR block = 0")
    return edges.unionByName(linked(hosts.unionByName(every)).where("NOT apart").select("a", "b"))


# --- components -----------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge: the smallest node that edges lead to.

    Alternates two steps on the edge list until it stands still: each node ties its
    larger neighbours to its smallest, then its smaller neighbours to their smallest.
    Smallest neighbours are aggregated before rows meet them. Each round is written to
    the shared folder; nothing is collected but a count and a checksum.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = staged(now, "components"), None
    while True:
        sides = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = sides.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select("a", F.col("low").alias("b")).unionByName(
            small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        now = staged(small.distinct(), "components")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    ``component_id`` is the smallest doc_id that links lead to, the document's own
    included. One row per row of ``docs``. A text of fewer than five words is one
    shingle; null, empty or blank texts have none and link with nothing. Null doc_id
    is kept, and names no component unless all of it is null; rows that repeat a doc_id
    are nodes of their own. Texts and sets may be of any size; other columns are ignored.
    """
    docs = texts(docs)
    counted = staged(docs.mapInArrow(_count, _NODES_DDL), "jaccard-nodes")
    nodes = counted.where("n IS NOT NULL").select("doc_id", "node", "n")
    edges = find_links(docs, nodes, shingle_levels(counted))
    classes = nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    roots = components(edges)
    rooted = classes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(lowest, "root").select("node", "component_id")
    return nodes.withColumn("node", F.when(F.col("n") > 0, F.col("node"))).join(labels, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that stand for their component.

    The row with the component's smallest doc_id stays, and every row without shingles.
    Rows that repeat a doc_id stay or go together, as one document, and stay if one of
    them would; rows without doc_id count as such a document.
    """
    found = jaccard_components(docs)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))  # no name clashes with id
    joined = rows.join(stay, F.col("d.doc_id").cast("long").eqNullSafe(F.col("id")), "left_semi")
    return joined.select(*[F.col("d").getField(c).alias(c) for c in docs.columns])
