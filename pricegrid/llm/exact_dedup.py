"""Exact deduplication with compressed radix tries over whole byte strings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.common import staged, texts

#: Bytes of text that one task keeps in its trie before it hands subtrees on.
TRIE_BYTES = 96 << 20
_BATCH_BYTES = 8 << 20

_LOCAL = pa.schema([("doc_id", pa.int64()), ("owner", pa.int64()), ("sha", pa.string()),
                    ("low", pa.int64()), ("high", pa.int64()), ("size", pa.int64()),
                    ("bytes", pa.binary())])
_LOCAL_DDL = "doc_id long, owner long, sha string, low long, high long, size long, bytes binary"
_OWNED_DDL = "owner long, low long, high long, size long, sha string, bytes binary"
_OWNED = pa.schema([("owner", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("size", pa.int64()),
                    ("sha", pa.string()), ("bytes", pa.binary())])


class Group:
    """What a terminal node keeps: smallest and largest identifier, rows, owners met."""

    __slots__ = ("low", "high", "size", "owners")

    def __init__(self):
        self.low = self.high = None
        self.size = 0
        self.owners = []

    def add(self, low, high, size, owner=None) -> None:
        if low is not None:
            self.low = low if self.low is None else min(self.low, low)
            self.high = high if self.high is None else max(self.high, high)
        self.size += size
        if owner is not None:
            self.owners.append(owner)


#: What a node takes beside its label: the node, its place at the parent, its group
#: with owners and digest (bytes, measured on CPython).
_NODE_BYTES = 700
#: The same for the mark that a subtree leaves behind.
_MARK_BYTES = 300


class _Node:
    """``held`` and ``strings``: estimated bytes and terminal nodes of the whole subtree."""

    __slots__ = ("label", "children", "group", "deferred", "held", "strings")

    def __init__(self, label: bytes, held: int = 0, strings: int = 0):
        self.label, self.children, self.group, self.deferred = label, {}, None, False
        self.held, self.strings = held, strings


class Trie:
    """Compressed radix trie; a path from the root spells the whole string."""

    def __init__(self):
        self.root = _Node(b"")

    @property
    def held(self) -> int:
        """Estimated bytes of all labels, nodes and groups."""
        return self.root.held

    def insert(self, key: bytes) -> _Node | None:
        """The terminal node of ``key``, with its group; None where its subtree has left the trie."""
        node, at, trail, grown = self.root, 0, [self.root], 0
        while not node.deferred and at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                grown = child.held = len(child.label) + _NODE_BYTES
                node.children[key[at]] = child
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                trail.append(node)
                continue
            common = 1
            limit = min(len(label), len(key) - at)
            step = 64
            while common < limit and label[common : common + step] == key[at + common : at + common + step]:
                common += step
            common = min(common, limit)
            while common < limit and label[common] == key[at + common]:
                common += 1
            middle = _Node(label[:common], child.held + _NODE_BYTES, child.strings)
            child.label = label[common:]
            child.held -= common
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            for above in trail:
                above.held += _NODE_BYTES
            node, at = middle, at + common
            trail.append(node)
        if node.deferred:
            return None
        new = node.group is None
        if new:
            node.group = Group()
        if trail[-1] is not node:
            node.strings += new
        for above in trail:
            above.held += grown
            above.strings += new
        return node

    def terminals(self) -> Iterator[tuple[bytes, Group]]:
        """Whole strings with their groups, one at a time."""
        return _terminals(self.root, b"")

    def defer_largest(self) -> Iterator[tuple[bytes, Group]] | None:
        """Take the largest subtree out that leaves some string behind.

        A mark with the first byte of its label stays: later strings that lead there have
        left the trie as well, so equal ones are never parted.

        The strings are spelled out one at a time, since their common prefix is held
        once but would be written many times. None when a single string is left, which
        is kept however long it is.
        """
        path, trail = b"", [self.root]
        while open_ := [c for c in trail[-1].children.values() if c.strings]:
            child = max(open_, key=lambda c: c.held)
            if child.strings < self.root.strings:
                out = _Node(child.label)
                out.children, out.group = child.children, child.group
                freed, strings = child.held - 1 - _MARK_BYTES, child.strings
                child.label, child.children, child.group, child.deferred = child.label[:1], {}, None, True
                child.held, child.strings = 1 + _MARK_BYTES, 0
                for above in trail:
                    above.held -= freed
                    above.strings -= strings
                return _terminals(out, path)
            path += child.label
            trail.append(child)
        return None


def _terminals(start: _Node, prefix: bytes) -> Iterator[tuple[bytes, Group]]:
    stack = [(start, prefix)]
    while stack:
        node, path = stack.pop()
        path += node.label
        if node.group is not None:
            yield path, node.group
        stack += [(c, path) for c in node.children.values()]


def _local(batches: Iterator[pa.RecordBatch], budget: int, digest) -> Iterator[pa.RecordBatch]:
    """One row per document with its owner in this task; the owner's row has the bytes.

    Copies met in one task meet in its trie, so a task sends each text once however
    many copies it holds.
    """
    context = TaskContext.get()
    base = (context.partitionId() if context else 0) << 38
    serial, trie, ids = 0, Trie(), {}
    rows = []

    def release():
        nonlocal trie, ids
        for path, g in trie.terminals():
            owner, sha = ids[id(g)]
            yield None, owner, sha, g.low, g.high, g.size, path
        trie, ids = Trie(), {}

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LOCAL)], schema=_LOCAL)

    def chunks(rows):
        part, held = [], 0
        for row in rows:
            part.append(row)
            held += len(row[6]) if row[6] is not None else 100
            if held >= _BATCH_BYTES:
                yield batch_of(part)
                part, held = [], 0
        if part:
            yield batch_of(part)

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            raw = text.encode("utf-8", "surrogatepass").lower()
            node = trie.insert(raw)
            group = node.group
            if id(group) not in ids:
                serial += 1
                ids[id(group)] = (base + serial, digest(raw))
            group.add(doc_id, doc_id, 1)
            owner, sha = ids[id(group)]
            rows.append((doc_id, owner, sha, None, None, None, None))
        if rows:
            yield batch_of(rows)
            rows = []
        if trie.held > budget:
            yield from chunks(release())
    yield from chunks(release())


def _owned(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """Owners of one partition merged; rows of subtrees put off keep their bytes."""
    trie, shas, away, size = Trie(), {}, [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OWNED)], schema=_OWNED)

    def put_off(subtree):
        for path, g in subtree:
            sha = shas.pop(id(g))
            # one row carries the counts, the others only their owner
            for k, owner in enumerate(g.owners):
                first = (g.low, g.high, g.size) if k == 0 else (None, None, 0)
                yield owner, *first, sha, path

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("owner", "low", "high", "size", "sha", "bytes")]
        for owner, low, high, n, sha, raw in zip(*columns):
            node = trie.insert(raw)
            leaving = iter(())
            if node is None:
                leaving = iter([(owner, low, high, n, sha, raw)])
            else:
                shas.setdefault(id(node.group), sha)
                node.group.add(low, high, n, owner)
            while True:
                for row in leaving:
                    away.append(row)
                    size += len(row[5]) + _NODE_BYTES
                    if size > _BATCH_BYTES:
                        yield batch_of(away)
                        away, size = [], 0
                subtree = trie.defer_largest() if trie.held > budget else None
                if subtree is None:
                    break
                leaving = put_off(subtree)
    if away:
        yield batch_of(away)
    rows = []
    for _, g in trie.terminals():
        sha = shas[id(g)]
        for owner in g.owners:
            rows.append((owner, g.low, g.high, g.size, sha, None))
            if len(rows) >= 20_000:
                yield batch_of(rows)
                rows = []
    if rows:
        yield batch_of(rows)


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def exact_groups(docs: DataFrame, keep: str = "smallest", trie_bytes: int = TRIE_BYTES, digest=sha256_hex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Two texts are equal when identical after lower-casing A-Z only. ``keep`` says
    which identifier of equal texts stays, the ``smallest`` or the ``largest``.

    1. Each task puts its texts into a trie and writes, once per distinct text, its
       bytes with the smallest and largest identifier, under an owner number of its
       own; every document gets that number. Copies are thereby reduced before
       anything is shuffled, and no later key holds more than one task's rows.
    2. Owners are dealt by length and content hash, and whole byte strings are
       inserted again. Beyond ``trie_bytes`` the largest subtree leaves the trie, and
       its rows (and later ones that lead into it) are written for the next round,
       which deals them anew. Each round settles at least one text per partition.
    3. Documents join their owner's group by number.

    Equality is decided on the bytes alone; the digest only deals them out, so a weak
    one costs time but no correctness. Null text counts as empty. Null doc_id stays
    null and is never kept unless no row of the group has one. Rows that repeat a
    doc_id are rows of the group like others, and all rows with the kept doc_id are
    kept. Other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    local = staged(
        texts(docs).mapInArrow(lambda it: _local(it, trie_bytes, digest), _LOCAL_DDL), "exact-local"
    )
    waiting = local.where("bytes IS NOT NULL").select("owner", "low", "high", "size", "sha", "bytes")
    groups, turn = None, 0
    while True:
        dealt = waiting.repartition(F.octet_length("bytes"), "sha", F.lit(turn)).select("owner", "low", "high", "size", "sha", "bytes")
        done = staged(dealt.mapInArrow(lambda it: _owned(it, trie_bytes), _OWNED_DDL), "exact-owned")
        settled = done.where("bytes IS NULL").select("owner", "low", "high", "size", "sha")
        groups = settled if groups is None else groups.unionByName(settled)
        waiting = done.where("bytes IS NOT NULL")
        if waiting.isEmpty():
            break
        turn += 1
    kept = "low" if keep == "smallest" else "high"
    members = local.where("bytes IS NULL").select("doc_id", "owner")
    return members.join(groups, "owner").select(
        "doc_id",
        F.col(kept).alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col(kept)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
