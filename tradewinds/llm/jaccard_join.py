"""Exact n-gram Jaccard join by universe partition and pigeonhole.

A document's set is its distinct word n-grams. Candidates are found by 64-bit hashes of
them; links are decided by the words themselves. Two sets of sizes
``l`` and ``s`` with similarity ``num/den`` differ in at most ``(den - num)(l + s) / (den + num)``
elements. Sizes fall into bands; each band has its own *space* for the pairs whose larger set lies
in it, and a set joins its band's space and those above that a partner can lie in.

A space hashes the universe into segments. The subset of a set in a segment gives a signature. With
``k`` segments that also index their one-deletion neighbourhoods (these fail only at two errors) and
``h`` errors at most, at least ``exact + 2k - h`` of the ``exact`` other segments agree, so each set
needs only its ``h - 2k + 1`` signatures that come first in an order by content: the largest subsets,
which are the rarest. Empty and tiny subsets, which many sets share, are those left out. ``k`` is
what a cost model finds cheapest for the band.

Texts of equal words are combined within a batch, and of the sets of a batch with one signature only the
smallest id goes on, so a group of copies that holds a third of all rows reaches a bucket as one
entry a batch. In a bucket the smallest id stands for all: pairs to it are verified, by the texts'
own n-grams, and linked; documents that are already connected need no other pair. Components that
still meet in a group are gathered, dealt into blocks of bounded size, and every two blocks are
counted against each other in one matrix product; only the components found go on. So no link is
lost, and no group is expanded into rows of pairs.

Nulls and ties: a null or blank text has an empty set and no link; its component is itself. Rows
with a null doc_id take no part in links and have a null component. Rows that repeat a doc_id are
one node. Texts are read whole, in slices that cut no word, and of any length; those that are compared are
in one task's memory as numbers of words. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import by_key, parts_for, text_bytes, written
from tradewinds.llm.components import components
from tradewinds.llm.hashing import BASE, U, mix

#: Width of a band of sizes.
BAND = 1.5
#: Members of a star that one task verifies.
STAR = 400
#: Documents and n-grams of a block that is counted at once, and columns of a product.
BLOCK_IDS, BLOCK_ITEMS, COLUMNS = 1024, 1_500_000, 2048
#: Words of more bytes are hashed one at a time.
LONG_WORD = 256
#: Text that is hashed or compared at a time, and text to a bucket.
SLICE_BYTES, BUCKET_BYTES = 1 << 20, 6_000_000


_BREAK = re.compile(rb"[ \t-\r]")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where(np.isin(np.arange(256), np.arange(65, 91)), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
#: What is left of 16 bytes, as two numbers, of a word that has so many.
_LEFT = np.tril(np.full((17, 16), 255, np.uint8), -1).view("<u8").astype(U)


def slices(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``SLICE_BYTES``; no word is cut."""
    at = 0
    while at < len(raw):
        found = _BREAK.search(raw, at + SLICE_BYTES) if at + SLICE_BYTES < len(raw) else None
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def word_lists(raw: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, slice by slice."""
    for piece in slices(raw):
        yield piece.lower().split()  # of bytes: ASCII letters and ASCII white space only


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes that end with white space, and where each begins; the words, lower-cased
    and with one space after each, as bytes; and how many of these there are up to each place."""
    space, low = _SPACE[data], _LOWER[data]
    edge = np.diff(space, prepend=True)
    turns = np.flatnonzero(edge)
    starts, length = turns[::2], turns[1::2] - turns[::2]
    blocks = np.lib.stride_tricks.sliding_window_view(np.r_[low, np.zeros(16, np.uint8)], 16)
    h = length.astype(U) * U(0xD6E8FEB86659FD93)
    for k in range(0, LONG_WORD, 16):
        some = np.flatnonzero(length > k)
        if not len(some):
            break
        two = np.ascontiguousarray(blocks[starts[some] + k]).view("<u8") & _LEFT[np.minimum(length[some] - k, 16)]
        h[some] = mix(mix(h[some] + two[:, 0]) * U(BASE) + two[:, 1])
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        word = low[starts[i] : starts[i] + length[i]]
        h[i] = int.from_bytes(hashlib.blake2b(np.ascontiguousarray(word), digest_size=8).digest(), "little")
    kept = ~space
    kept[1:] |= kept[:-1].copy() & space[1:]
    return h, starts, np.where(space, np.uint8(32), low)[kept], np.cumsum(kept)


def described(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text the hashes of its words, and a digest of the words; short texts are read together."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[tuple[np.ndarray, bytes]]:
        hashes, starts, said, place = word_hashes(np.frombuffer(b"\n".join([*held, b""]), np.uint8))
        ends = np.cumsum([len(b) + 1 for b in held])
        marks = [0, *place[ends - 1].tolist()]
        for k, own in enumerate(np.split(hashes, np.searchsorted(starts, ends[:-1]))):
            yield own, hashlib.blake2b(said[marks[k] : marks[k + 1]], digest_size=32).digest()
        held.clear()

    for raw in texts:
        if len(raw) > SLICE_BYTES:
            if held:
                yield from flush()
                size = 0
            digest, parts = hashlib.blake2b(digest_size=32), [np.zeros(0, U)]
            for piece in slices(raw):
                hashes, _, said, _ = word_hashes(np.frombuffer(piece + b"\n", np.uint8))
                digest.update(said)
                parts.append(hashes)
            yield np.concatenate(parts), digest.digest()
            continue
        held.append(raw)
        size += len(raw)
        if size >= SLICE_BYTES:
            yield from flush()
            size = 0
    if held:
        yield from flush()


class _Numbers(dict):
    """Words by the order in which they are first asked for, from 1."""

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self) + 1
        return k


def _numbered(raw: bytes, known: dict) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in word_lists(raw))])


@cache
def _odd(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(BASE)) | U(1)


def set_of(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct n-grams of a sequence of word hashes; all as one if there are fewer."""
    if not len(words):
        return words
    if len(words) < n:
        return mix((words * _odd(n)[: len(words)]).sum(keepdims=True, dtype=U) + U(len(words)))
    grams = words[: len(words) - n + 1] * _odd(n)[0]
    for k in range(1, n):
        grams = grams + words[k : len(words) - n + 1 + k] * _odd(n)[k]
    return np.unique(mix(grams))


def exact_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sets of texts as rising numbers: two are equal only if their n-grams are, word by word.

    Words are numbered by their bytes and n-grams by the numbers of their words, so no hash is trusted.
    """
    known = _Numbers()
    words = [_numbered(raw, known) for raw in texts]
    words = [np.pad(w, (0, n - len(w))) if 0 < len(w) < n else w for w in words]  # a short text is one n-gram, which no other text has
    counts = np.array([max(0, len(w) - n + 1) for w in words], np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *words])
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum([0, *(len(w) for w in words)])[:-1]
    starts = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(owner))
    gram = flat[starts]
    for k in range(1, n):
        gram = np.unique(gram * (len(known) + 1) + flat[starts + k], return_inverse=True)[1]
    distinct = max(1, len(gram))
    held = np.unique(owner * distinct + gram)
    return np.split(held % distinct, np.searchsorted(held, np.arange(1, len(texts)) * distinct))


@dataclass(frozen=True)
class Space:
    """Segments for the pairs whose larger set has ``low`` to ``high`` elements."""

    number: int
    low: int
    high: int
    deletions: int
    exact: int


class Plan:
    """Bands, spaces and their allocation for one threshold."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self._spaces: list[Space] = []

    def errors(self, both: int) -> int:
        """Most elements in which linked sets of this total size differ."""
        return (self.den - self.num) * both // (self.den + self.num)

    def space(self, j: int) -> Space:
        while len(self._spaces) <= j:
            low = self._spaces[-1].high + 1 if self._spaces else 1
            high = max(low, int(low * BAND) - 1)
            self._spaces.append(self._allocate(len(self._spaces), low, high))
        return self._spaces[j]

    def _allocate(self, number: int, low: int, high: int) -> Space:
        h = self.errors(2 * high)
        best = None
        for k in range((h + 1) // 2 + 1):
            need = max(0, h - 2 * k + 1)
            exact = need + (2 + need // 8 if need and h else 0)
            held = high / (k + exact)
            met = lambda a: 1 + 1e4 * 0.05**a  # noqa: E731  an entry, and the chance meetings of a subset of this size
            cost = need * met(held) + k * (held + 1) * met(held - 1)
            if best is None or cost < best[0]:
                best = (cost, k, exact)
        return Space(number, low, high, best[1], best[2])

    def spaces_of(self, size: int) -> Iterator[Space]:
        """The spaces that a set of this size joins."""
        reach, j = size * self.den // self.num, 0
        while (s := self.space(j)).low <= reach:
            if s.high >= size:
                yield s
            j += 1

    def signatures(self, items: np.ndarray) -> np.ndarray:
        """All signatures of a set."""
        size = len(items)
        out = []
        for s in self.spaces_of(size):
            h = self.errors(size + min(size * self.den // self.num, s.high))
            count = s.deletions + s.exact
            salt = U((s.number + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
            value = mix(items + salt)
            segment = ((value >> U(32)) * U(count) >> U(32)).astype(np.int64)
            value = mix(value)
            sums, held = np.zeros(count, U), np.bincount(segment, minlength=count)
            np.add.at(sums, segment, value)
            own = mix(np.arange(count, dtype=U) + salt)
            for k in range(s.deletions):
                out.append(mix(np.r_[sums[k], sums[k] - value[segment == k]] + own[k]))
            need = h - 2 * s.deletions + 1
            if need > 0:
                exact = mix(sums[s.deletions :] + own[s.deletions :])
                first = np.lexsort((exact, -held[s.deletions :]))[:need]
                out.append(exact[first])
        return np.concatenate(out) if out else np.zeros(0, U)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether two sets are similar enough, counted exactly."""
        if min(len(a), len(b)) * self.den < max(len(a), len(b)) * self.num:
            return False
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        at = np.searchsorted(large, small)
        at[at == len(large)] = 0
        shared = int((large[at] == small).sum())
        return shared * self.den >= self.num * (len(a) + len(b) - shared)


_SCHEMA = "kind int, bucket int, a long, b long, na long, nb long, members array<long>, payload binary"
_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("na", pa.int64()), ("nb", pa.int64()), ("members", pa.list_(pa.int64())), ("payload", pa.binary())])
#: Kinds of rows: a document (id, its set's first id, size); a pair to verify; ids that share a signature; packed entries.
DOCUMENT, PAIR, GROUP, ENTRIES = range(4)


def _rows(kind: int, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    full = {"kind": pa.array(np.full(n, kind), pa.int32())}
    for f in _ARROW:
        if f.name in columns:
            full[f.name] = pa.array(columns[f.name], f.type)
        elif f.name not in full:
            full[f.name] = pa.nulls(n, f.type)
    return pa.RecordBatch.from_arrays([full[f.name] for f in _ARROW], schema=_ARROW)


def _pack(signatures: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> bytes:
    head = np.array([len(ids)], np.int64)
    return zstandard.compress(head.tobytes() + np.diff(ids, prepend=0).tobytes() + sizes.astype(np.int64).tobytes() + signatures.tobytes(), 1)


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(payload), np.int64)
    n = int(raw[0])
    return raw[1 + 2 * n :].view(U), np.cumsum(raw[1 : 1 + n]), raw[1 + n : 1 + 2 * n]


def _groups(signatures: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (signature, id) in order, and where each signature begins."""
    order = np.lexsort((ids, signatures))
    s, i, z = signatures[order], ids[order], sizes[order]
    fresh = np.r_[True, (s[1:] != s[:-1]) | (i[1:] != i[:-1])] if len(s) else np.zeros(0, bool)
    s, i, z = s[fresh], i[fresh], z[fresh]
    return s, i, z, np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)


def _stars(s: np.ndarray, i: np.ndarray, z: np.ndarray, starts: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Pairs to the smallest id of each signature, each once, and the groups."""
    counts = np.diff(np.r_[starts, len(s)])
    many = np.flatnonzero(counts > 1)
    if not len(many):
        return
    inside = np.repeat(counts > 1, counts)
    inside[starts] = False
    members = np.flatnonzero(inside)
    firsts = np.repeat(starts, counts)[members]
    pairs = np.unique(np.stack([i[firsts], i[members], z[firsts], z[members]], 1), axis=0)
    yield _rows(PAIR, bucket=(pairs[:, 0] + pairs[:, 1]) % buckets, a=pairs[:, 0], b=pairs[:, 1], na=pairs[:, 2], nb=pairs[:, 3])
    where = starts[many]
    flat = np.flatnonzero(np.repeat(counts > 1, counts))
    offsets = np.r_[0, np.cumsum(counts[many])]
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(i[flat], pa.int64()))
    yield _rows(GROUP, bucket=((s[where] >> U(33)) % U(buckets)).astype(np.int32), a=s[where].view(np.int64), members=lists)


def _signed(plan: Plan, n: int, buckets: int):
    """Batches of ``doc_id, text`` to rows of all kinds."""

    def one(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        first: dict[bytes, int] = {}
        keys, sizes, kept = [], [], {}
        for doc_id, (words, said) in zip(ids, described((t or "").encode() for t in texts), strict=True):
            items = set_of(words, n)
            sizes.append(len(items))
            key = said if len(items) and doc_id is not None else b""
            keys.append(key)
            if key and (key not in first or doc_id < first[key]):
                first[key] = doc_id
            if key and key not in kept:
                kept[key] = items
        yield _rows(DOCUMENT, bucket=[(i or 0) % buckets for i in ids], a=ids, b=[first[k] if k else i for i, k in zip(ids, keys, strict=True)], na=sizes)
        parts = [(first[k], len(items), plan.signatures(items)) for k, items in kept.items()]
        if not parts:
            return
        lengths = [len(p[2]) for p in parts]
        s, i, z, starts = _groups(np.concatenate([p[2] for p in parts]), np.repeat(np.array([p[0] for p in parts], np.int64), lengths), np.repeat(np.array([p[1] for p in parts], np.int64), lengths))
        yield from _stars(s, i, z, starts, buckets)
        s, i, z = s[starts], i[starts], z[starts]  # the smallest id stands for the batch
        to = ((s >> U(33)) % U(buckets)).astype(np.int64)
        order = np.lexsort((i, to))
        s, i, z, to = s[order], i[order], z[order], to[order]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        ends = np.r_[cuts[1:], len(to)]
        yield _rows(ENTRIES, bucket=to[cuts], payload=[_pack(s[x:y], i[x:y], z[x:y]) for x, y in zip(cuts.tolist(), ends.tolist(), strict=True)])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from one(b.column(0).to_pylist(), b.column(1).to_pylist())

    return task


def _met(buckets: int):
    """Rows of a bucket: entries become pairs and groups; all others pass."""

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = []
        for b in pieces:
            is_packed = np.array(b.column("kind")) == ENTRIES
            if not is_packed.all():
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.filter(pa.array(~is_packed)).columns, _ARROW, strict=True)], schema=_ARROW)
            packed += [_unpack(p) for p in b.filter(pa.array(is_packed)).column("payload").to_pylist()]
        if packed:
            yield from _stars(*_groups(*(np.concatenate(x) for x in zip(*packed, strict=True))), buckets)

    return work


def verified(pairs: DataFrame, texts: DataFrame, plan: Plan, n: int, parts: int) -> DataFrame:
    """Those ``a, b`` pairs whose texts are similar enough; ``texts`` has ``doc_id, text``.

    Pairs are gathered by ``a``, in pieces of about ``STAR``, so that its text is read once for each.
    """
    counts = pairs.groupBy(F.col("a").alias("_a")).agg(F.ceil(F.count("*") / STAR).cast("int").alias("pieces"))
    pairs = pairs.join(counts, F.col("a") == F.col("_a")).select("a", "b", "pieces", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("piece"))
    centres = pairs.select("a", "piece").distinct().withColumn("role", F.lit(0)).withColumn("id", F.col("a"))
    others = pairs.select("a", "piece", F.lit(1).alias("role"), F.col("b").alias("id"))
    rows = centres.unionByName(others).join(texts, F.col("id") == F.col("doc_id")).select("a", "piece", "role", "id", "text")

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: list[bytes] = []
        held: list[tuple[int, bytes]] = []
        found: list[int] = []

        def compare() -> None:
            sets = exact_sets([*centre, *(raw for _, raw in held)], n)
            for (i, _), items in zip(held, sets[len(centre) :], strict=True):
                if any(plan.linked(c, items) for c in sets[: len(centre)]):
                    found.append(i)
            held.clear()

        size = 0
        for b in pieces:
            for r, i, text in zip(*(b.column(c).to_pylist() for c in ("role", "id", "text")), strict=True):
                raw = (text or "").encode()
                if r == 0:
                    centre.append(raw)
                    continue
                held.append((i, raw))
                size += len(raw)
                if size >= SLICE_BYTES:
                    compare()
                    size = 0
        compare()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])

    return by_key(rows, parts, ["a", "piece"], ["role"], work, "a long, b long").distinct()


def connected(ids: np.ndarray, sets: list[np.ndarray], plan: Plan) -> np.ndarray:
    """For each id the smallest that links within the block reach, by exact counts of shared items."""
    n = len(ids)
    items, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    place = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    owner, column = owner[shared], place[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((n, n), np.float32)  # exact: far below 2**24
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        x, y = np.searchsorted(column, [low, low + COLUMNS])
        some = np.zeros((n, COLUMNS), np.float32)
        some[owner[x:y], column[x:y] - low] = 1
        counts += some @ some.T
    size = np.array([len(x) for x in sets], np.int64)
    counts = counts.astype(np.int64)
    linked = counts * plan.den >= plan.num * (size[:, None] + size[None, :] - counts)
    label = np.full(n, -1)
    for i in np.argsort(ids, kind="stable").tolist():
        if label[i] < 0:
            label[i], edge = i, [i]
            while edge:
                new = np.flatnonzero(linked[edge].any(0) & (label < 0))
                label[new] = i
                edge = new.tolist()
    return ids[label]


def unsettled(groups: DataFrame, named: DataFrame, files: int) -> DataFrame:
    """``id, size, cluster``: members of components that meet in a group and have pairs that weren't tried.

    ``groups`` has a signature ``a`` and ``members``, a row for each batch that the signature was met
    in and one for its bucket; ``named`` has ``id, label, size`` of all members of groups. Two documents
    without links were tried as a pair; there is no other pair if they are all that have the signature.
    """
    alone = named.groupBy("label").agg((F.count("*") == 1).alias("alone"))
    rows = groups.select("a", F.xxhash64("members").alias("group"), F.size("members").alias("held"))
    several = rows.groupBy("a").agg(F.min("group").alias("x"), F.max("group").alias("y")).where("x <> y").select("a")
    spread = rows.where("held = 2").join(several, "a", "left_semi").select("group").distinct().withColumn("spread", F.lit(True))
    tagged = groups.select("members").distinct().select(F.xxhash64("members").alias("group"), F.size("members").alias("held"), F.explode("members").alias("id"))
    tagged = tagged.join(named.select("id", "label").join(alone, "label"), "id").select("group", "held", "label", "alone")
    meet = tagged.groupBy("group", "held").agg(F.min("label").alias("v"), F.max("label").alias("most"), F.bool_and("alone").alias("alone"))
    meet = meet.where("v <> most").join(spread, "group", "left").where("spread OR NOT (held = 2 AND alone)").select("group", "v")
    edges = written(tagged.join(meet, "group").select(F.col("label").alias("u"), "v").distinct(), "join-meet", files)
    clusters = components(edges, files)
    of = edges.select(F.explode(F.array("u", "v")).alias("label")).distinct().join(clusters, F.col("label") == F.col("node"), "left")
    return named.join(of.select("label", F.coalesce("component", "label").alias("cluster")), "label").select("id", "size", "cluster")


def settled(open_: DataFrame, texts: DataFrame, plan: Plan, n: int, parts: int, files: int) -> DataFrame:
    """``u, v``: links that connect what ``id, size, cluster`` rows hold, all pairs in a cluster counted."""
    blocks = open_.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK_IDS, F.sum("size") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    placed = open_.join(blocks, "cluster").select("id", "cluster", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "blocks")
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    rows = placed.join(texts, F.col("id") == F.col("doc_id")).select("cluster", F.explode(both).alias("at"), "id", "text").select("cluster", "at.i", "at.j", "id", "text")

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = [], []
        for b in pieces:
            ids += b.column("id").to_pylist()
            texts += [(t or "").encode() for t in b.column("text").to_pylist()]
        ids = np.array(ids, np.int64)
        first = connected(ids, exact_sets(texts, n), plan)
        some = first != ids
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(first[some], pa.int64())], ["u", "v"])

    return by_key(rows, parts, ["cluster", "i", "j"], ["id"], work, "u long, v long")


def jaccard_join(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row: n-gram sets with similarity ``num/den`` or more are linked.

    ``component_id`` is the smallest doc_id that links reach.
    """
    plan = Plan(num, den)
    total = text_bytes(docs)
    parts = parts_for(total, 2 * BUCKET_BYTES)
    buckets, files = parts * 2, max(2, parts // 12)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = rows.mapInArrow(_signed(plan, n, buckets), _SCHEMA)
    met = written(by_key(signed, parts, ["bucket"], ["kind"], _met(buckets), _SCHEMA), "join-met", 2 * files)
    pairs = written(met.where(F.col("kind") == PAIR).select("a", "b", "na", "nb").distinct(), "join-pairs", files)
    known = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
    texts = written(rows.join(known.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi"), "join-texts", 2 * files)
    tried = pairs.where(f"least(na, nb) * {den} >= greatest(na, nb) * {num}").select("a", "b")
    links = written(verified(tried, texts, plan, n, parts).select(F.col("a").alias("u"), F.col("b").alias("v")), "join-links", files)
    labels = components(links, files)

    ends = F.array(*(F.struct(F.col(i).alias("id"), F.col(z).alias("size")) for i, z in (("a", "na"), ("b", "nb"))))
    sizes = pairs.select(F.explode(ends).alias("x")).groupBy("x.id").agg(F.max("x.size").alias("size"))
    named = written(sizes.join(labels, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("label"), "size"), "join-named", files)
    open_ = written(unsettled(met.where(F.col("kind") == GROUP).select("a", "members"), named, files), "join-open", files)
    if not open_.isEmpty():
        more = written(settled(open_, texts, plan, n, parts, files), "join-more", files)
        labels = components(links.unionByName(more), files)
    every = met.where(F.col("kind") == DOCUMENT).select(F.col("a").alias("doc_id"), F.col("b").alias("first"), F.col("na").alias("n_shingles"))
    joined = every.join(labels, F.col("first") == F.col("node"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "first").alias("component_id"))


def kept_documents(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that are first in their component, with all their columns."""
    gone = jaccard_join(docs.select("doc_id", "text"), n, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = written(gone, "join-gone")
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_gone"], "left_anti")
