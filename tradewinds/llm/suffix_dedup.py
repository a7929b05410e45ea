"""Removal of repeated passages by common-prefix intervals of a sparse enhanced suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
id. Suffixes are sampled by content: of the ``LENGTH - GRAM + 1`` grams in any string of ``LENGTH``
bytes the one with the smallest hash is an *anchor*, so two equal strings have equal anchors at
equal places, about one byte in eighteen is an anchor, and the order of suffixes need only be known
among those of one gram. Buckets of grams are independent parts of the array:

1. Texts are packed into blocks of about ``BLOCK_BYTES``, written once.
2. Each block sends the distinct hashes of its grams to buckets, which answer with a bit for each:
   whether another block has it.
3. Grams that are in two documents go out again, with the bytes around them, each context once for
   a block, with the smallest id that has it. A bucket sorts the contexts of a gram as suffixes from
   the gram on. A stack scan over their common prefixes yields the interval tree; the occurrences of
   each node, sorted by what stands before them, are scanned once more for the intervals whose left
   extensions differ. These are the maximal repeat groups, each with all its occurrences; the smallest
   id among them decides. The answer names the contexts that a smaller id repeats, and how far.
4. Blocks mark what is covered.

Traffic is a few bytes an anchor and a context once a block: copies within a block are combined
before they are sent, and a passage that a third of all documents share reaches its bucket once a
block. No pairs of documents are formed.

Nulls and ties: a null text is empty. A null doc_id is greater than every other and not smaller than
itself; rows that repeat a doc_id don't remove each other's bytes. A text longer than a block is a
block of its own, read whole; its grams are hashed in slices. A run of one byte has an anchor at each,
with 84 bytes of context. An empty table gives an empty result.
Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import by_key, parts_for, text_bytes, written
from tradewinds.llm.hashing import U, mix, prefix_sums

LENGTH, GRAM = 50, 16
SIDE = LENGTH - GRAM
WIDE = LENGTH + SIDE
BLOCK_BYTES, BUCKET_BYTES = 1 << 20, 8_000_000
#: Bytes whose grams are hashed at a time, and contexts that are cut out at a time.
SLICE, CUT = 1 << 16, 1 << 16
#: Contexts that a bucket sorts at a time.
CONTEXTS = 1 << 14
#: Stands for the id of contexts that only documents with a null id have.
LAST = np.iinfo(np.int64).max
PAD = 255  # in no UTF-8 text


def sliding(x: np.ndarray, width: int, pick, ahead: bool) -> np.ndarray:
    """``pick`` over windows of ``width`` that begin (``ahead``) or end at each place."""
    out, span = x.copy(), 1
    while span < width:
        step = min(span, width - span)
        if ahead:
            out[:-step] = pick(out[:-step], out[step:])
        else:
            out[step:] = pick(out[step:], out[:-step].copy())
        span += step
    return out


def anchors(data: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """Places of the grams that are smallest in some whole string of ``LENGTH`` bytes."""
    places = [np.zeros(0, np.int64)]
    for low in range(0, len(data), SLICE):
        piece = data[low : low + SLICE + LENGTH - 1]
        if len(piece) < LENGTH:
            break
        sums, down = prefix_sums(piece)
        x = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(piece) - GRAM + 1]) | U(1)
        starts = len(piece) - LENGTH + 1
        least = sliding(x, SIDE + 1, np.minimum, True)[:starts]
        whole = np.arange(low + LENGTH, low + LENGTH + starts) <= doc_end[low : low + starts]
        chosen = np.zeros(len(x), U)
        chosen[:starts] = np.where(whole, least, U(0))
        places.append(np.flatnonzero(sliding(chosen, SIDE + 1, np.maximum, False) == x) + low)
    return np.unique(np.concatenate(places))


def gram_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the gram at each place."""
    out = np.zeros(len(places), U)
    for low in range(0, len(places), CUT):
        out[low : low + CUT] = digest(data[places[low : low + CUT, None] + np.arange(GRAM)])
    return out


@dataclass
class Block:
    """Texts of some documents, one after another, and a bit for each byte: whether an anchor begins there.

    ``real`` tells ids from the zeros that stand for null ones.
    """

    ids: np.ndarray
    real: np.ndarray
    sizes: np.ndarray
    data: np.ndarray
    marks: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[bytes]) -> Block:
        sizes, data = np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8)
        chosen = np.zeros(len(data), bool)
        chosen[anchors(data, np.repeat(np.cumsum(sizes), sizes))] = True
        return cls(np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]), sizes, data, np.packbits(chosen))

    def pack(self) -> bytes:
        head = np.array([len(self.ids), len(self.data)], np.int64)
        return zstandard.compress(b"".join(a.tobytes() for a in (head, self.ids, self.sizes, self.real, self.data, self.marks)), 1)

    @classmethod
    def unpack(cls, payload: bytes) -> Block:
        raw = zstandard.decompress(payload)
        n, size = np.frombuffer(raw, np.int64, 2).tolist()
        at = 16 + 17 * n
        return cls(np.frombuffer(raw, np.int64, n, 16), np.frombuffer(raw, bool, n, 16 + 16 * n), np.frombuffer(raw, np.int64, n, 16 + 8 * n), np.frombuffer(raw, np.uint8, size, at), np.frombuffer(raw, np.uint8, offset=at + size))

    def anchored(self) -> Anchored:
        places = np.flatnonzero(np.unpackbits(self.marks, count=len(self.data)))
        return Anchored(self, places, gram_hashes(self.data, places), np.searchsorted(np.cumsum(self.sizes), places, side="right"))


@dataclass
class Anchored:
    block: Block
    places: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray

    def shared_here(self) -> np.ndarray:
        """Distinct hashes that two documents of the block have."""
        order = np.lexsort((self.doc, self.hashes))
        h, d = self.hashes[order], self.doc[order]
        return np.unique(h[1:][(h[1:] == h[:-1]) & (d[1:] != d[:-1])])

    def only(self, keep: np.ndarray) -> Anchored:
        return Anchored(self.block, self.places[keep], self.hashes[keep], self.doc[keep])

    def contexts(self) -> np.ndarray:
        """The bytes around each anchor; ``PAD`` beyond its document."""
        ends = np.cumsum(self.block.sizes)
        starts = ends - self.block.sizes
        out = np.empty((len(self.places), WIDE), np.uint8)
        reach = np.arange(-SIDE, LENGTH)
        for low in range(0, len(out), CUT):
            part = slice(low, low + CUT)
            at = self.places[part, None] + reach
            d = self.doc[part]
            out[part] = self.block.data[np.clip(at, 0, len(self.block.data) - 1)]
            out[part][(at < starts[d, None]) | (at >= ends[d, None])] = PAD
        return out


def columns(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian numbers that sort in the same order, the first column first."""
    pad = -rows.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))) if pad else np.ascontiguousarray(rows)
    return list(wide.view(">u8").astype(U).T)


def digest(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    total = np.zeros(len(rows), U)
    for k, c in enumerate(columns(rows)):
        total = mix(total + c * U(2 * k + 0x9E3779B97F4A7C15 | 1))
    return total


def classes(bucket: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket in which equal rows are neighbours, and where each run of them begins."""
    key = digest(rows)
    order = np.lexsort((key, bucket))
    fresh = np.ones(len(order), bool)
    for low in range(1, len(order), CUT):
        a = order[low : low + CUT]
        fresh[low : low + CUT] = (rows[a] != rows[order[low - 1 : low - 1 + len(a)]]).any(1)
    return order, np.flatnonzero(fresh)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash; it rises with the hash."""
    return ((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def common(rows: np.ndarray) -> np.ndarray:
    """Common prefixes of each row and the one before it; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for low in range(1, len(rows), CUT):
        differ = rows[low : low + CUT] != rows[low - 1 : low - 1 + len(rows[low : low + CUT])]
        out[low : low + CUT] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def intervals(prefix: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals ``(length, first, last)`` of a suffix array, by a stack scan.

    ``prefix[i]`` is the common prefix of suffixes ``i - 1`` and ``i``. Only lengths of at least
    ``least`` are given; a parent comes after its children.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(prefix) + 1):
        here = prefix[i] if i < len(prefix) else 0
        first = i - 1
        while stack and stack[-1][0] > here:
            length, first = stack.pop()
            yield length, first, i - 1
        if here >= least and (not stack or stack[-1][0] < here):
            stack.append((here, first))


@dataclass
class Groups:
    """Maximal repeat groups around grams: ``left`` bytes before the gram and ``right`` from it on.

    The occurrences of group ``k`` are the contexts ``members[starts[k] : starts[k + 1]]``, all that have its string.
    """

    left: np.ndarray
    right: np.ndarray
    starts: np.ndarray
    members: np.ndarray

    def __len__(self) -> int:
        return len(self.left)

    def least(self, values: np.ndarray) -> np.ndarray:
        """The smallest of the occurrences' ``values`` in each group."""
        return np.minimum.reduceat(values[self.members], self.starts[:-1]) if len(self) else values[:0]

    def owners(self) -> np.ndarray:
        """The group of each member."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))


    def only(self, keep: np.ndarray) -> Groups:
        counts = np.diff(self.starts)
        return Groups(self.left[keep], self.right[keep], np.r_[0, np.cumsum(counts[keep])], self.members[np.repeat(keep, counts)])


def strings_of(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What stands ``left`` bytes before each gram to ``right`` bytes from it on, with ``PAD`` after it."""
    at = np.arange(WIDE)
    out = rows[np.arange(len(rows))[:, None], (at + SIDE - left[:, None]) % WIDE]
    out[at >= (left + right)[:, None]] = PAD
    return out


def names_of(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of the string of each group, wherever its gram stands in it."""
    return digest(strings_of(rows, left, right))


def anchored_inside(rows: np.ndarray, groups: Groups) -> np.ndarray:
    """Which groups' strings make their gram an anchor by themselves, so that it is one in each occurrence."""
    size = groups.left + groups.right
    text = strings_of(rows[groups.members[groups.starts[:-1]]], groups.left, groups.right)
    ends = np.cumsum(size)
    places = anchors(text[np.arange(WIDE) < size[:, None]], np.repeat(ends, size))
    return np.isin(ends - size + groups.left, places)


def _over(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``first[k], ..., last[k]`` for each k, one after another."""
    counts = last - first + 1
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _scan(prefix: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The intervals of a suffix array as arrays."""
    found = np.array(list(intervals(prefix.tolist(), least)), np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def _extremes(values: np.ndarray, first: np.ndarray, last: np.ndarray, pick) -> np.ndarray:
    """``pick`` over ``values[first[k] : last[k] + 1]`` for each k."""
    return pick.reduceat(np.r_[values, values[-1:]], np.stack([first, last + 1], 1).ravel())[::2] if len(first) else values[:0]


def repeat_groups(contexts: np.ndarray, inside: tuple[np.ndarray, np.ndarray]) -> Groups:
    """The maximal repeat groups of at least ``LENGTH`` bytes among distinct contexts of whole grams.

    ``inside`` is how many bytes to the left of each gram, and from it on, are its document's. The
    suffixes from the grams on are sorted, and a stack scan of their common prefixes gives the interval
    tree. The occurrences of a node, in the order of what stands before them read backwards, are scanned
    again: each of its intervals is a group whose left extensions differ (or reach the context's end), so
    it can't be extended to the left. It is kept if it isn't within a child of the node, for then it can't
    be extended to the right either.
    """
    none = np.zeros(0, np.int64)
    right, left = contexts[:, SIDE:], np.concatenate([contexts[:, SIDE : SIDE + GRAM], contexts[:, :SIDE][:, ::-1]], 1)
    most = []
    for rows, held in ((right, inside[1]), (left, inside[0] + GRAM)):
        rank = np.lexsort([*columns(rows)][::-1])
        prefix = _within(common(rows[rank]), held[rank])
        share = np.empty(len(rows), np.int64)
        share[rank] = np.maximum(prefix, np.r_[prefix[1:], 0]) - GRAM
        most.append(share)
    some = np.flatnonzero((most[0] >= 0) & (most[1] >= 0) & (most[0] + most[1] + GRAM >= LENGTH))  # others can't share LENGTH bytes
    if not len(some):
        return Groups(none, none, np.zeros(1, np.int64), none)
    some = some[np.lexsort([*columns(right[some])][::-1])]
    prefix = _within(common(right[some]), inside[1][some])
    depth, first, last = _scan(prefix, GRAM)
    # what stands before the occurrences of each node
    place, node = _over(first, last), np.repeat(np.arange(len(depth)), last - first + 1)
    back = np.empty(len(some), np.int64)
    back[np.lexsort([*columns(left[some])][::-1])] = np.arange(len(some))
    order = np.lexsort((back[place], node))
    place, node = place[order], node[order]
    before = _within(common(left[some[place]]), inside[0][some[place]] + GRAM) - GRAM
    fresh = np.r_[True, node[1:] != node[:-1]]
    before[fresh | (before < LENGTH - depth[node])] = -1
    length, low, high = _scan(before, 0)
    # within a child: all suffixes of the group have more than the node's depth in common
    a, b = _extremes(place, low, high, np.minimum), _extremes(place, low, high, np.maximum)
    kept = _extremes(prefix, a + 1, b, np.minimum) == depth[node[low]] if len(low) else np.zeros(0, bool)
    low, high, length = low[kept], high[kept], length[kept]
    return Groups(length, depth[node[low]], np.r_[0, np.cumsum(high - low + 1)], some[place[_over(low, high)]])


def _within(prefix: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Common prefixes cut to what neighbours hold of their documents."""
    out = np.minimum(prefix, held)
    out[1:] = np.minimum(out[1:], held[:-1])
    return out


_REPLY = "block long, role int, bucket int, payload binary"
_PACKED = pa.schema([("block", pa.int64()), ("role", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _batch(block: list, role: int, bucket: list, payload: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array([role] * len(block), pa.int32()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())], schema=_PACKED)


def _columns_of(pieces: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in pieces:
        yield from zip(*(b.column(k).to_pylist() for k in ("block", "role", "bucket", "payload")), strict=True)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Texts packed into blocks, role 0 of ``block, role, bucket, payload``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = (text or "").encode()
                if ids and size + len(raw) > BLOCK_BYTES:
                    yield _batch([number], 0, [0], [Block.of(ids, texts).pack()])
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield _batch([number], 0, [0], [Block.of(ids, texts).pack()])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, _REPLY)


def _cut_by(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted bucket numbers, with the end."""
    return np.searchsorted(bucket, np.arange(buckets + 1))


def _shuffled(x: np.ndarray) -> bytes:
    """Differences of rising numbers, byte by byte, packed."""
    steps = np.diff(x, prepend=U(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unshuffled(payload: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(U).ravel(), dtype=U)


def _ask_grams(buckets: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, payload in _columns_of(batches):
            hashes = np.unique(Block.unpack(payload).anchored().hashes)
            cuts = _cut_by(bucket_of(hashes, buckets), buckets)
            some = np.flatnonzero(np.diff(cuts)).tolist()
            if some:
                yield _batch([block] * len(some), 1, some, [_shuffled(hashes[cuts[k] : cuts[k + 1]]) for k in some])

    return task


def _answer_grams(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked = [(block, bucket, _unshuffled(p)) for block, _, bucket, p in _columns_of(pieces)]
    sizes = [len(h) for _, _, h in asked]
    every = np.concatenate([h for _, _, h in asked])
    order = np.argsort(every, kind="stable")
    h = every[order]
    again = np.r_[False, h[1:] == h[:-1]]
    again |= np.r_[again[1:], False]
    shared = np.empty(len(h), bool)
    shared[order] = again
    bits = [np.packbits(s).tobytes() for s in np.split(shared, np.cumsum(sizes)[:-1])]
    yield _batch([a[0] for a in asked], 1, [a[1] for a in asked], bits)


def _repeated(packed: bytes, answers: dict[int, bytes], buckets: int) -> Anchored:
    """The anchors of a block that two documents have."""
    all_ = Block.unpack(packed).anchored()
    hashes = np.unique(all_.hashes)
    cuts = _cut_by(bucket_of(hashes, buckets), buckets)
    keep = np.zeros(len(hashes), bool)
    for k in range(buckets):
        if cuts[k] < cuts[k + 1]:
            keep[cuts[k] : cuts[k + 1]] = np.unpackbits(np.frombuffer(answers[k], np.uint8), count=cuts[k + 1] - cuts[k])
    wanted = np.union1d(hashes[keep], all_.shared_here())
    at = np.searchsorted(wanted, all_.hashes)
    at[at == len(wanted)] = 0
    return all_.only(wanted[at] == all_.hashes) if len(wanted) else all_.only(np.zeros(len(at), bool))


@dataclass
class Classed:
    """Equal contexts of a block's anchors as classes, in the order of buckets.

    ``run`` is the class of each anchor in ``order``; ``first`` one anchor of each class, ``low`` its
    smallest id, ``real`` whether it has one.
    """

    rows: np.ndarray
    order: np.ndarray
    run: np.ndarray
    first: np.ndarray
    low: np.ndarray
    real: np.ndarray
    bucket: np.ndarray

    @classmethod
    def of(cls, found: Anchored, buckets: int) -> Classed:
        rows = found.contexts()
        bucket = bucket_of(found.hashes, buckets)
        order, at = classes(bucket, rows)
        real, ids = found.block.real[found.doc[order]], found.block.ids[found.doc[order]]
        run = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(order)]))
        low = np.minimum.reduceat(np.where(real, ids, LAST), at) if len(at) else ids
        return cls(rows, order, run, order[at], low, np.logical_or.reduceat(real, at) if len(at) else real, bucket[order[at]])


def extents(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes before each context's gram, and from it on, are its document's."""
    left, right = rows[:, :SIDE][:, ::-1] == PAD, rows[:, SIDE:] == PAD
    return np.where(left.any(1), left.argmax(1), SIDE), np.where(right.any(1), right.argmax(1), LENGTH)


def _ask_strings(buckets: int):
    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, answers = b"", {}
        for _, role, bucket, payload in _columns_of(pieces):
            if role == 0:
                packed = payload
            else:
                answers[bucket] = payload
        found = _repeated(packed, answers, buckets)
        if not len(found.places):
            return
        own = Classed.of(found, buckets)
        cuts = _cut_by(own.bucket, buckets)
        some = np.flatnonzero(np.diff(cuts)).tolist()
        out = []
        for k in some:
            part = slice(cuts[k], cuts[k + 1])
            out.append(zstandard.compress(own.low[part].tobytes() + own.real[part].tobytes() + own.rows[own.first[part]].tobytes(), 1))
        yield _batch([key[0]] * len(some), 2, some, out)

    return work


def _grouped(rows: np.ndarray, low: np.ndarray, real: np.ndarray, every: bool) -> tuple[np.ndarray, ...]:
    """Which contexts have which strings: ``(context, left, right, group)``.

    With ``every``, all occurrences of all groups. Else each context once that is in a group of a smaller
    id: as all its strings hold its gram, they cover what the longest on either side do.
    """
    order, at = classes(np.zeros(len(rows), np.int64), rows)
    one = rows[order[at]]
    held = extents(one)
    groups = repeat_groups(one, held)
    if every:
        groups = groups.only(anchored_inside(one, groups))
    times = np.diff(np.r_[at, len(order)])
    many = np.flatnonzero((held[0] + held[1] >= LENGTH) & (times > 1))  # equal contexts: a group by themselves
    left, right = np.r_[groups.left, held[0][many]], np.r_[groups.right, held[1][many]]
    groups = Groups(left, right, np.r_[groups.starts, groups.starts[-1] + 1 + np.arange(len(many))], np.r_[groups.members, many])
    class_low = np.minimum.reduceat(np.where(real, low, LAST)[order], at)
    class_real = np.logical_or.reduceat(real[order], at)
    owner = groups.owners()
    best = groups.least(class_low)
    some = groups.least(~class_real) == 0  # a group of null ids alone removes nothing
    # occurrences: the contexts of each member's class
    count = times[groups.members]
    first = at[groups.members]
    context, owner = order[_over(first, first + count - 1)], np.repeat(owner, count)
    if not every:
        gone = some[owner] & (~real[context] | (best[owner] < low[context]))
        context, owner = context[gone], owner[gone]
        by = np.argsort(context, kind="stable")
        context, first = np.unique(context[by], return_index=True)
        far = [np.maximum.reduceat(side[owner[by]], first) if len(first) else side[:0] for side in (left, right)]
        return context, *far, np.zeros(len(context), U)
    names = names_of(one[groups.members[groups.starts[:-1]]], left, right)
    return context, left[owner], right[owner], names[owner]


_ANSWER = np.dtype([("context", "<u4"), ("left", "u1"), ("right", "u1"), ("group", "<u8")])


def _answer_strings(every: bool):
    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, low, real, rows = [], [], [], []
        for block, _, bucket, payload in _columns_of(pieces):
            raw = zstandard.decompress(payload)
            n = len(raw) // (9 + WIDE)
            asked.append((block, bucket))
            low.append(np.frombuffer(raw, np.int64, n))
            real.append(np.frombuffer(raw, bool, n, 8 * n))
            rows.append(np.frombuffer(raw, np.uint8, offset=9 * n).reshape(n, WIDE))
        first = np.cumsum([0, *map(len, low)])
        low, real, rows = np.concatenate(low), np.concatenate(real), np.concatenate(rows)
        upper, lower = columns(rows[:, SIDE : SIDE + GRAM])
        order = np.lexsort((lower, upper))
        fresh = np.flatnonzero(np.r_[True, (upper[order][1:] != upper[order][:-1]) | (lower[order][1:] != lower[order][:-1])])
        del upper, lower
        found, at = [], 0
        while at < len(order):  # whole grams, about CONTEXTS of them at a time
            k = np.searchsorted(fresh, at + CONTEXTS)
            end = int(fresh[k]) if k < len(fresh) else len(order)
            part = order[at:end]
            context, left, right, group = _grouped(rows[part], low[part], real[part], every)
            answer = np.empty(len(context), np.dtype([("at", "<i8"), *_ANSWER.descr]))
            answer["at"], answer["left"], answer["right"], answer["group"] = part[context], left, right, group
            found.append(answer)
            at = end
        found = np.concatenate(found)
        found = found[np.argsort(found["at"], kind="stable")]
        cuts = np.searchsorted(found["at"], first)
        found["context"] = found["at"] - np.repeat(first[:-1], np.diff(cuts))
        out = found[list(_ANSWER.names)].astype(_ANSWER)
        held = [k for k in range(len(asked)) if cuts[k] < cuts[k + 1]]
        if held:
            yield _batch([asked[k][0] for k in held], 2, [asked[k][1] for k in held], [zstandard.compress(out[cuts[k] : cuts[k + 1]].tobytes(), 1) for k in held])

    return work


def _answered(own: Classed, strings: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The answers to a block, with the place in ``own.order`` of each anchor that they are for."""
    cuts = _cut_by(own.bucket, buckets)
    answers = [np.zeros(0, _ANSWER)]
    which = [np.zeros(0, np.int64)]
    for k, payload in sorted(strings.items()):
        answers.append(np.frombuffer(zstandard.decompress(payload), _ANSWER))
        which.append(answers[-1]["context"].astype(np.int64) + cuts[k])
    answers, which = np.concatenate(answers), np.concatenate(which)
    begin, end = np.searchsorted(own.run, which), np.searchsorted(own.run, which, side="right")
    return np.repeat(answers, end - begin), _over(begin, end - 1)


def _covered(packed: bytes, grams: dict[int, bytes], strings: dict[int, bytes], buckets: int) -> tuple[Block, np.ndarray]:
    """A block and which of its bytes go."""
    found = _repeated(packed, grams, buckets)
    block = found.block
    n = len(block.data)
    turns = np.zeros(n + 1, np.int64)
    if len(found.places):
        own = Classed.of(found, buckets)
        answers, at = _answered(own, strings, buckets)
        at = found.places[own.order[at]]
        begin, end = at - answers["left"], at + answers["right"]
        # equal contexts within the block: those of greater ids than its smallest
        doc = found.doc[own.order]
        left, right = extents(own.rows[own.first])
        again = own.real[own.run] & (~block.real[doc] | (block.ids[doc] > own.low[own.run])) & ((left + right) >= LENGTH)[own.run]
        places, runs = found.places[own.order[again]], own.run[again]
        np.add.at(turns, np.r_[begin, places - left[runs]], 1)
        np.add.at(turns, np.r_[end, places + right[runs]], -1)
    return block, np.cumsum(turns[:n]) > 0


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _rest(buckets: int, texts: bool):
    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, grams, strings = b"", {}, {}
        for _, role, bucket, payload in _columns_of(pieces):
            if role == 0:
                packed = payload
            else:
                (grams if role == 1 else strings)[bucket] = payload
        block, gone = _covered(packed, grams, strings, buckets)
        out, at = [], 0
        for doc_id, real, size in zip(block.ids.tolist(), block.real.tolist(), block.sizes.tolist(), strict=True):
            here = gone[at : at + size]
            kept = block.data[at : at + size][~here].tobytes()
            spans = int(here[:1].sum() + (here[1:] & ~here[:-1]).sum())
            out.append({"doc_id": doc_id if real else None, "n_bytes": size, "n_removed": int(here.sum()), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept if texts else None})
            at += size
        yield pa.RecordBatch.from_pylist(out, _OUT)

    return work


def _turn() -> Column:
    """A number for each block; those of blocks that one task writes follow each other."""
    return F.expr("shiftright(block, 32) * 7919 + (block & 4294967295)")


def _found(docs: DataFrame, every: bool) -> tuple[DataFrame, int, int]:
    """Blocks with all answers to them; the numbers of tasks and of buckets."""
    total = text_bytes(docs)
    parts = parts_for(total, 2 * BUCKET_BYTES)
    buckets, files = 2 * parts, max(2, parts // 12)
    blocks = written(blocks_of(docs), "suffix-blocks")
    asked = blocks.mapInArrow(_ask_grams(buckets), _REPLY)
    grams = written(by_key(asked, parts, ["bucket"], ["block"], _answer_grams, _REPLY, F.col("bucket")), "suffix-grams", files)
    known = by_key(blocks.unionByName(grams), parts, ["block"], ["role"], _ask_strings(buckets), _REPLY, _turn())
    strings = written(by_key(known, parts, ["bucket"], ["block"], _answer_strings(every), _REPLY, F.col("bucket")), "suffix-strings", files)
    return blocks.unionByName(grams).unionByName(strings), parts, buckets


def remove_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for each row; ``kept`` is null without ``texts``."""
    every, parts, buckets = _found(docs, False)
    return by_key(every, parts, ["block"], ["role"], _rest(buckets, texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary", _turn())


_PLACE = pa.schema([("group", pa.int64()), ("length", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64())])


def _places(buckets: int):
    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, grams, strings = b"", {}, {}
        for _, role, bucket, payload in _columns_of(pieces):
            if role == 0:
                packed = payload
            else:
                (grams if role == 1 else strings)[bucket] = payload
        found = _repeated(packed, grams, buckets)
        if not len(found.places):
            return
        block, own = found.block, Classed.of(found, buckets)
        answers, at = _answered(own, strings, buckets)
        held = extents(own.rows[own.first])
        twice = np.flatnonzero((np.bincount(own.run)[own.run] > 1) & (held[0] + held[1] >= LENGTH)[own.run])  # equal contexts within the block
        runs = own.run[twice]
        anchor = own.order[np.r_[at, twice]]
        left, right = np.r_[answers["left"], held[0][runs]], np.r_[answers["right"], held[1][runs]]
        group = np.r_[answers["group"], names_of(own.rows[own.first], *held)[runs]]
        doc = found.doc[anchor]
        start = found.places[anchor] - left - (np.cumsum(block.sizes) - block.sizes)[doc]
        length = left + right
        yield pa.RecordBatch.from_arrays([pa.array(group.astype(U).view(np.int64)), pa.array(length, pa.int32()), pa.array(block.ids[doc], mask=~block.real[doc]), pa.array(start)], schema=_PLACE)

    return work


def repeats(docs: DataFrame) -> DataFrame:
    """``group, length, doc_id, start``: the maximal repeat groups, each with all its occurrences, in bytes.

    A group is a string of ``LENGTH`` to ``WIDE`` bytes around an anchor; ``group`` is a hash of it. It can't
    be extended, but where it reaches the end of what is looked at around the anchor: longer repeats are
    chains of groups that overlap. Every string of ``LENGTH`` bytes that two documents have lies in one.
    """
    every, parts, buckets = _found(docs, True)
    return by_key(every, parts, ["block"], ["role"], _places(buckets), "group long, length int, doc_id long, start long", _turn()).distinct()
