"""Removal of long repeated byte strings with suffix arrays built by two-stage sorting.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier in the
corpus. Strings of that length ("windows") are dealt out so that equal ones meet:

1. Anchors. The k bytes inside a window whose hash is smallest are its anchor. Equal
   windows have equal anchors at equal places, and neighbouring windows mostly share
   one. A segment is a run of windows with one anchor, its text a little longer than a
   window. Windows whose anchor occurs once in the corpus repeat nothing.
2. Segments of repeated anchors are dealt by the anchor's hash. A task takes the
   segments of whole anchors up to a bound and builds their suffix array: suffixes
   smaller than their successors are sorted directly, the others are induced by scanning
   the buckets of first bytes. Neighbours with common prefixes of ``LENGTH`` bytes are
   equal windows; all but the earliest are repeats.
3. An anchor with more segments than a task may hold is split: equal segments become
   one, and the rest is anchored anew with more bytes, at last with whole windows, of
   which no two are equal then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.hashing import mixed
from pricegrid.session import staged, staged_while

LENGTH = 100
#: Bytes of an anchor: at first, and where one is too frequent.
ANCHORS = (32, 64)
#: Segments of one anchor that a task may hold, and bytes of segments it sorts at once.
LIMIT = 1 << 14
BLOCK = 2 << 20
#: Bytes whose windows are hashed at once, a power of two.
PIECE = 1 << 18

_NULL_ID = -(1 << 63)
_BASE = 0x8A5CD789635D2DFF  # a fixed odd multiplier
_PLACE = [("id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]
_RUNS = pa.schema([("h", pa.int64()), *_PLACE])
_SEGMENTS = pa.schema([("h", pa.int64()), *_PLACE, ("text", pa.binary())])
_REPEATS = pa.schema(_PLACE)
RUNS_DDL = "h long, id long, key long, start long, n long"
SEGMENTS_DDL = RUNS_DDL + ", text binary"
REPEATS_DDL = "id long, key long, start long, n long"


# --- anchors ----------------------------------------------------------------------


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Grams:
    """Hashes of all runs of k bytes; made once per task."""

    def __init__(self, k: int, length: int):
        self.k, self.length = k, length
        size = PIECE + length
        self.powers, self.inverse = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)

    def anchors(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window of some bytes, where its anchor begins and the anchor's hash.

        The leftmost of equal hashes is taken, so that equal windows agree.
        """
        k, n = self.k, len(raw)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        hashes = mixed((sums[k:] - sums[:-k]) * self.inverse[: n - k + 1])
        places = np.arange(len(hashes), dtype=np.uint64)
        # places need 19 bits, as a piece is followed by less than a window
        low = (hashes >> np.uint64(19) << np.uint64(19)) | places
        wide, reach = self.length - k + 1, 1
        while 2 * reach <= wide:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < wide:
            low = np.minimum(low[: reach - wide], low[wide - reach :])
        at = (low & np.uint64((1 << 19) - 1)).astype(np.int64)
        return at, hashes[at].view(np.int64)


def _runs(raw: np.ndarray, bounds: np.ndarray, grams: _Grams) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, n, hash, text) arrays: runs of windows with one anchor, none across texts.

    ``bounds`` are the places in ``raw`` where texts begin, and its end.
    """
    length = grams.length
    for p in range(0, len(raw), PIECE):
        piece = raw[p : p + PIECE + length - 1]
        if len(piece) < length:
            break
        at, hashes = grams.anchors(piece)
        fresh = np.ones(len(at), dtype=bool)
        np.not_equal(at[1:], at[:-1], out=fresh[1:])
        inside = bounds[(bounds > p) & (bounds < p + len(at))] - p
        fresh[inside] = True
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(at))
        text = np.searchsorted(bounds, begin + p, "right") - 1
        end = np.minimum(end, bounds[text + 1] - p - length + 1)  # the last window ends with its text
        some = end > begin
        begin, end, text = begin[some], end[some], text[some]
        yield begin + p, end - begin, hashes[begin], text


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each row's begin."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _anchored(batches: Iterator[pa.RecordBatch], k: int, length: int) -> Iterator[pa.RecordBatch]:
    grams = _Grams(k, length)
    for batch in batches:
        raw, bounds = _binary(batch["text"])
        ids, keys = batch["id"].to_numpy(), batch["key"].to_numpy()
        for start, n, h, text in _runs(raw, bounds, grams):
            columns = (h, ids[text], keys[text], start - bounds[text], n)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUNS)], schema=_RUNS)


def _reanchored(batches: Iterator[pa.RecordBatch], k: int, length: int) -> Iterator[pa.RecordBatch]:
    """Segments cut anew by longer anchors; their texts come with them."""
    grams = _Grams(k, length)
    for batch in batches:
        raw, bounds = _binary(batch["text"])
        whole = raw.tobytes()
        ids, keys, starts = (batch[c].to_numpy() for c in ("id", "key", "start"))
        for start, n, h, text in _runs(raw, bounds, grams):
            texts = [whole[a:b] for a, b in zip(start.tolist(), (start + n + length - 1).tolist())]
            columns = (h, ids[text], keys[text], starts[text] + start - bounds[text], n, texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SEGMENTS)], schema=_SEGMENTS)


# --- segments ---------------------------------------------------------------------

#: Bytes of distinct segments that a task holds before it writes them.
_HELD = 24 << 20


def _lists(column: pa.Array, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's structs begin, and the fields of all structs."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    items = column.flatten()
    return bounds - bounds[0], [items.field(n).to_numpy() for n in names]


def _joined(places: list[tuple]) -> list[np.ndarray]:
    """(id, key, start, n) of runs, those that follow one another made one."""
    ids, keys, starts, n = (np.array(c, dtype=np.int64) for c in zip(*places))
    order = np.lexsort((starts, keys, ids))
    ids, keys, starts, ends = ids[order], keys[order], starts[order], (starts + n)[order]
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (starts[1:] != ends[:-1])
    at = np.flatnonzero(fresh)
    last = np.append(at[1:], len(ids)) - 1
    return [ids[at], keys[at], starts[at], ends[last] - starts[at]]


def _segments(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The segments of documents with their texts, equal ones met in a task only once.

    Rows without text are runs of windows that repeat an earlier segment of the task.
    """
    first: dict[bytes, int] = {}
    places: list[tuple] = []  # (id, key, start, n)
    hashes: list[int] = []
    copies: list[tuple] = []

    def release():
        kept, texts = list(first.values()), list(first)
        for at in range(0, len(kept), 1 << 16):
            part = kept[at : at + (1 << 16)]
            columns = [[hashes[i] for i in part], *zip(*(places[i] for i in part)), texts[at : at + (1 << 16)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SEGMENTS)], schema=_SEGMENTS)
        if copies:
            columns = _joined(copies)
            none = len(columns[0])
            columns = [pa.nulls(none, pa.int64()), *map(pa.array, columns), pa.nulls(none, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SEGMENTS)
        first.clear(), places.clear(), hashes.clear(), copies.clear()

    held = 0
    for batch in batches:
        raw, bounds = _binary(batch["text"])
        whole = raw.tobytes()
        ids, keys = batch["id"].to_pylist(), batch["key"].to_pylist()
        edges, (starts, counts, marks) = _lists(batch["runs"], "start", "n", "h")
        for row in range(len(ids)):
            base, own = int(bounds[row]), (ids[row], keys[row])
            part = slice(int(edges[row]), int(edges[row + 1]))
            order = np.argsort(starts[part])
            for start, n, h in zip(*(c[part][order].tolist() for c in (starts, counts, marks))):
                text = whole[base + start : base + start + n + length - 1]
                place = (*own, start, n)
                known = first.get(text)
                if known is None:
                    first[text] = len(places)
                    places.append(place)
                    hashes.append(h)
                    held += len(text) + 200
                elif place < places[known]:
                    copies.append(places[known])
                    places[known] = place
                elif place > places[known]:
                    copies.append(place)
            if held > _HELD or len(copies) > 200_000:
                yield from release()
                held = 0
    yield from release()


# --- two-stage suffix sorting -----------------------------------------------------


class Block:
    """Segments laid end to end, with eight-byte keys that stop at a segment's end."""

    def __init__(self, text: np.ndarray, bounds: np.ndarray):
        self.text, self.bounds = text, bounds
        self.sizes = np.diff(bounds)
        self.ends = np.repeat(bounds[1:], self.sizes)
        padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(text)]
        keys = np.ascontiguousarray(eight).view(">u8")[:, 0].astype(np.uint64)
        for left in range(1, 8):  # positions with so many bytes before their segment's end
            at = (bounds[1:] - left)[self.sizes >= left]
            keys[at] &= np.uint64((1 << 64) - (1 << (64 - 8 * left)))
        self.keys = keys

    def key(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Eight bytes from each place, zeros beyond its segment."""
        out = self.keys[np.minimum(at, len(self.keys) - 1)]
        out[at >= ends] = 0
        return out


def smaller_than_successor(block: Block) -> np.ndarray:
    """Whether each suffix is smaller than the one that begins a byte later.

    Equal bytes leave it to the next place that differs; the last suffix of a segment is
    greater than the empty one behind it.
    """
    text, n = block.text, len(block.text)
    up = np.zeros(n, dtype=bool)
    up[:-1] = text[:-1] < text[1:]
    decided = np.ones(n, dtype=bool)
    decided[:-1] = text[:-1] != text[1:]
    last = block.bounds[1:][block.sizes > 0] - 1
    up[last], decided[last] = False, True
    return up[_next(decided)]


def _next(marks: np.ndarray) -> np.ndarray:
    """For each place the next marked one, itself included; the length if there is none."""
    at = np.where(marks, np.arange(len(marks)), len(marks))
    return np.minimum.accumulate(at[::-1])[::-1]


def direct_sort(block: Block, pos: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes, eight at a time and only where still tied."""
    pos = pos[np.argsort(block.keys[pos])]
    if not len(pos):
        return pos
    head = np.ones(len(pos), dtype=bool)
    head[1:] = block.keys[pos[1:]] != block.keys[pos[:-1]]
    for d in range(8, depth, 8):
        alone = head.copy()
        alone[:-1] &= head[1:]
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        key = block.key(pos[at] + d, block.ends[pos[at]])
        start = head[at]
        differs = ~start
        differs[1:] &= key[1:] != key[:-1]
        if not differs.any():
            continue
        group = np.cumsum(start) - 1
        open_ = np.zeros(group[-1] + 1, dtype=bool)
        open_[group[differs]] = True
        some = open_[group]
        at, key, group = at[some], key[some], group[some]
        order = np.lexsort((key, group))
        pos[at] = pos[at][order]
        key = key[order]
        head[at[1:]] |= key[1:] != key[:-1]
    return pos


def two_stage_sort(block: Block, windows: np.ndarray, depth: int) -> np.ndarray:
    """Places of the first ``windows`` suffixes of each segment, ordered by ``depth`` bytes.

    Suffixes smaller than their successors are sorted directly. Each other one follows
    from its successor: scanning the buckets of first bytes in order, a suffix puts its
    predecessor, where that is greater, behind those already in the predecessor's bucket.
    Only suffixes that the wanted ones follow from are ordered.
    """
    text, bounds = block.text, block.bounds
    small = smaller_than_successor(block)
    # a wanted suffix needs its successors up to the first that is sorted directly
    reach = np.minimum(_next(small)[bounds[:-1] + windows - 1] + 1, bounds[1:])
    sizes = reach - bounds[:-1]
    used = np.repeat(bounds[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    direct = direct_sort(block, used[small[used]], depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    first = np.zeros(len(text) + 1, dtype=bool)
    first[bounds[:-1]] = True
    queues: list[list[np.ndarray]] = [[] for _ in range(256)]

    def deal(places: np.ndarray) -> None:
        letters = text[places]
        order = np.argsort(letters, kind="stable")
        places, letters = places[order], letters[order]
        edges = np.flatnonzero(np.diff(letters)) + 1
        for part in np.split(places, edges):
            if len(part):
                queues[text[part[0]]].append(part)

    # the empty suffixes behind the segments come first and induce the last ones
    deal(reach[(reach == bounds[1:]) & ~small[reach - 1]] - 1)
    out = []
    for letter in range(256):
        bucket = queues[letter]
        queues[letter] = []
        met = np.concatenate(bucket) if bucket else np.zeros(0, dtype=np.int64)
        bucket = [met]
        while len(met):  # runs of the letter extend their own bucket
            met = met[~first[met]] - 1
            met = met[text[met] == letter]
            bucket.append(met)
        bucket.append(direct[cuts[letter] : cuts[letter + 1]])
        whole = np.concatenate(bucket)
        if not len(whole):
            continue
        out.append(whole)
        before = whole[~first[whole]] - 1
        deal(before[text[before] > letter])
    order = np.concatenate(out) if out else np.zeros(0, dtype=np.int64)
    offset = order - np.repeat(bounds[:-1], block.sizes)[order]
    return order[offset < np.repeat(windows, block.sizes)[order]]


def common_prefixes(block: Block, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it, at most ``most``."""
    out = np.zeros(len(order), dtype=np.int64)
    same = np.arange(1, len(order))
    for d in range(0, most, 8):
        a, b = order[same - 1], order[same]
        x = block.key(a + d, block.ends[a]) ^ block.key(b + d, block.ends[b])
        equal = x == 0
        out[same[equal]] += 8
        rest, x = same[~equal], x[~equal]
        for byte in range(1, 8):
            out[rest] += (x >> np.uint64(64 - 8 * byte)) == 0
        same = same[equal]
        if not len(same):
            break
    return np.minimum(out, most)


def repeats_of(block: Block, windows: np.ndarray, ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, length: int):
    """(segment, start, n) of the runs of windows of a block that also start earlier."""
    order = two_stage_sort(block, windows, length)
    by_document = np.lexsort((keys, ids))
    step = np.diff(ids[by_document]).astype(bool) | np.diff(keys[by_document]).astype(bool)
    document = np.empty(len(ids), dtype=np.int64)
    document[by_document] = np.concatenate([[0], np.cumsum(step)])
    segment = np.repeat(np.arange(len(windows)), block.sizes)[order]
    place = (document[segment] << 40) | (starts[segment] + order - block.bounds[segment])
    heads = np.flatnonzero(common_prefixes(block, order, length) < length)
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    earliest = np.minimum.reduceat(place, heads)
    late = np.sort(order[place != earliest[group]])
    if not len(late):
        return (np.zeros(0, dtype=np.int64),) * 3
    segment = np.searchsorted(block.bounds, late, "right") - 1
    fresh = np.ones(len(late), dtype=bool)
    fresh[1:] = (np.diff(late) > 1) | (np.diff(segment) > 0)
    at = np.flatnonzero(fresh)
    n = np.diff(np.append(at, len(late)))
    segment = segment[at]
    return segment, starts[segment] + late[at] - block.bounds[segment], n


def _sorted_blocks(batches: Iterator[pa.RecordBatch], length: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Repeats of segments that come ordered by the hash of their anchor.

    A block is cut where an anchor ends, so it has at most ``block_bytes`` and one anchor more.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        text, bounds = _binary(table["text"].combine_chunks())
        ids, keys, starts, windows = (table[c].to_numpy() for c in ("id", "key", "start", "n"))
        segment, start, n = repeats_of(Block(text, bounds), windows, ids, keys, starts, length)
        columns = (ids[segment], keys[segment], start, n)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REPEATS)], schema=_REPEATS)

    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        table = table.combine_chunks()
        h = table["h"].to_numpy()
        sizes = np.cumsum(pa.compute.binary_length(table["text"]).to_numpy().astype(np.int64))
        edges = np.flatnonzero(h[1:] != h[:-1]) + 1
        at = done = 0
        while (k := int(np.searchsorted(sizes[edges - 1], done + block_bytes))) < len(edges):
            to = int(edges[k])
            yield solve(table.slice(at, to - at))
            at, done = to, int(sizes[to - 1])
        waiting = table.slice(at)
    if waiting is not None and waiting.num_rows:
        yield solve(waiting)


# --- the whole --------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    """(id, key, text): one name for rows that agree in doc_id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.xxhash64(text).alias("key"),
        text.cast("binary").alias("text"),
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """Hashes that more than one row has."""
    return rows.groupBy("h").agg(F.count("*").alias("rows")).where("rows > 1").select("h")


def repeated_windows(
    docs: DataFrame, length: int = LENGTH, anchors: tuple[int, ...] = ANCHORS, limit: int = LIMIT, block: int = BLOCK
) -> DataFrame:
    """``id, key, start, n``: runs of n windows from byte ``start`` that also start earlier.

    ``id`` is the doc_id and ``key`` a hash of the text. A run of n windows covers
    n + length - 1 bytes. No run is missing or doubtful: bytes decide in suffix arrays.
    """
    lengths = [*[k for k in anchors if k < length], length]
    rows = _texts(docs)
    found = []
    with ExitStack() as held:
        with ExitStack() as early:
            runs = early.enter_context(
                staged_while(rows.mapInArrow(lambda it: _anchored(it, lengths[0], length), RUNS_DDL), "suffix-anchors")
            )
            again = early.enter_context(staged_while(_repeated(runs), "suffix-repeated"))
            listed = (
                runs.join(again, "h", "left_semi")
                .groupBy("id", "key")
                .agg(F.collect_list(F.struct("start", "n", "h")).alias("runs"))
            )
            listed = held.enter_context(staged_while(listed, "suffix-runs"))
        cut = rows.join(listed, ["id", "key"]).mapInArrow(lambda it: _segments(it, length), SEGMENTS_DDL)
        cut = held.enter_context(staged_while(cut, "suffix-segments"))
        found.append(cut.where("text IS NULL").select("id", "key", "start", "n"))
        waiting, ready = cut.where("text IS NOT NULL"), []
        for k in [*lengths[1:], None]:
            calm, hot = _by_size(waiting, limit, held)
            ready.append(calm)
            if hot is None:
                break
            merged, copies = _merged(hot, held)
            found.append(copies)
            calm, hot = (merged, None) if k is None else _by_size(merged, limit, held)
            ready.append(calm)
            if hot is None:
                break
            finer = hot.mapInArrow(lambda it, k=k: _reanchored(it, k, length), SEGMENTS_DDL)
            finer = held.enter_context(staged_while(finer, "suffix-finer"))
            waiting = finer.join(_repeated(finer), "h", "left_semi").select(*finer.columns)
        whole = ready[0]
        for part in ready[1:]:
            whole = whole.unionByName(part)
        dealt = whole.repartition("h").sortWithinPartitions("h")
        found.append(dealt.mapInArrow(lambda it: _sorted_blocks(it, length, block), REPEATS_DDL))
        out = found[0]
        for part in found[1:]:
            out = out.unionByName(part)
        return staged(out, "suffix-repeats")


def _by_size(rows: DataFrame, limit: int, held: ExitStack) -> tuple[DataFrame, DataFrame | None]:
    """Rows of anchors with at most ``limit`` rows, and those of the others, if any."""
    large = rows.groupBy("h").agg(F.count("*").alias("rows")).where(F.col("rows") > limit).select("h")
    large = held.enter_context(staged_while(large, "suffix-large"))
    if large.isEmpty():
        return rows, None
    return rows.join(large, "h", "left_anti"), rows.join(large, "h", "left_semi").select(*rows.columns)


def _merged(rows: DataFrame, held: ExitStack) -> tuple[DataFrame, DataFrame]:
    """One row per distinct segment, with its earliest place; and all later places."""
    place = F.struct("id", "key", "start")
    merged = rows.groupBy("h", "n", "text").agg(F.min(place).alias("p")).select("h", "p.*", "n", "text")
    merged = held.enter_context(staged_while(merged, "suffix-merged"))
    owner = merged.select("h", "n", "text", place.alias("p"))
    later = rows.join(owner, ["h", "n", "text"]).where(place != F.col("p")).select("id", "key", "start", "n")
    return merged, later


def _spans(starts: list[int], counts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal covered stretches [from, to) of runs of windows."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(zip(starts, counts)):
        end = start + n + length - 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[e for span in spans for e in span], len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _per_document(batches: Iterator[pa.RecordBatch], length: int, report: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = {n: batch[n] for n in batch.schema.names if n not in ("__runs", "__text")}
        spans, cut = [], []
        edges, (starts, counts) = _lists(batch["__runs"], "start", "n")
        for row, raw in enumerate(batch["__text"]):
            raw, part = raw.as_py(), slice(int(edges[row]), int(edges[row + 1]))
            spans.append(_spans(starts[part].tolist(), counts[part].tolist(), length))
            cut.append((len(raw), _without(raw, spans[-1])))
        if report:
            yield pa.RecordBatch.from_pydict({
                "doc_id": rest["doc_id"],
                "n_bytes": pa.array([n for n, _ in cut], pa.int64()),
                "n_removed": pa.array([n - len(k) for n, k in cut], pa.int64()),
                "n_spans": pa.array([len(s) for s in spans], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for _, k in cut], pa.string()),
            })
        else:
            texts = [k.decode("utf-8", "ignore") if s else None for (_, k), s in zip(cut, spans)]
            yield pa.RecordBatch.from_pydict({**rest, "__kept": pa.array(texts, pa.string())})


def _with_runs(docs: DataFrame, repeats: DataFrame, columns: list) -> DataFrame:
    listed = repeats.groupBy("id", "key").agg(F.collect_list(F.struct("start", "n")).alias("__runs"))
    listed = listed.toDF("__doc", "__key", "__runs")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(
        *columns,
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("__id"),
        F.xxhash64(text).alias("__own"),
        text.cast("binary").alias("__text"),
    )
    joined = own.join(listed, (F.col("__id") == F.col("__doc")) & (F.col("__own") == F.col("__key")), "left")
    return joined.drop("__id", "__own", "__doc", "__key")


def repeat_report(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    Every byte goes that lies in a string of ``length`` bytes that also starts earlier: in
    a document with a smaller doc_id, or further ahead in its own. Strings are judged on
    the input and never cross documents. ``n_spans`` are the maximal removed stretches,
    the digest is that of the bytes that stay, one after the other.

    Null text counts as empty. Null doc_id comes first in the order, as the least number.
    Rows that agree in doc_id and text are one document delivered again and lose the same
    bytes; those with one doc_id and different texts are ordered by a hash of the text.
    Texts shorter than ``length`` lose nothing, very long ones are hashed in pieces. An
    empty table gives no rows; other columns are ignored.
    """
    rows = _with_runs(docs, repeated_windows(docs, length, **settings), [F.col("doc_id").cast("long").alias("doc_id")])
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(lambda it: _per_document(it, length, True), shape)


def without_repeats(docs: DataFrame, length: int = LENGTH, **settings) -> DataFrame:
    """``docs`` without those bytes, all columns kept in their order.

    As :func:`repeat_report`; a character that loses some of its bytes goes altogether,
    and where there is a column ``n_chars`` it is counted anew. Null text stays null.
    """
    clash = {"__id", "__own", "__doc", "__key", "__runs", "__text", "__kept"} & set(docs.columns)
    plain = docs.toDF(*[f"c{i}" if n not in ("doc_id", "text") else n for i, n in enumerate(docs.columns)]) if clash else docs
    rows = _with_runs(plain, repeated_windows(plain, length, **settings), [F.col(f"`{n}`") for n in plain.columns])
    shape = rows.drop("__runs", "__text").schema.add("__kept", "string")
    done = rows.mapInArrow(lambda it: _per_document(it, length, False), shape)
    kept = F.col("__kept")
    columns = []
    for own, name in zip(plain.columns, docs.columns):
        value = F.col(f"`{own}`")
        if name == "text":
            value = F.coalesce(kept, value)
        elif name == "n_chars":
            value = F.when(kept.isNotNull(), F.length(kept)).otherwise(value).cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return done.select(*columns)
