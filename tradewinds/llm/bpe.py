"""Byte-level BPE by corpus-level merge replay.

Texts are cut into pieces by the tokenizer's pattern, block by block of about ``BLOCK_BYTES``. A piece that is
a token is done; the distinct others of a block go to buckets by a hash, so that each piece of the corpus is
merged in one place and once. There the bytes of all pieces form one linked sequence, and an inverted index
leads from the rank of a pair to the positions where it stands. Ranks are taken in rising order; a merge
rewrites all its positions at once and looks up only the pairs to their left and right anew. A piece in which
a merge made a pair of a lower rank, so that rising order over the corpus is not its own order, is merged
alone by its own heap. The tokens go back to the blocks that asked, whose texts wait as numbers of pieces.

What moves are the numbers, packed, and the distinct pieces of each block and their tokens; a piece that all
texts have is one entry a block. A bucket replays ``FLUSH_BYTES`` of pieces at a time, whatever its size.

Nulls and ties: a null text is empty and has no tokens. Rows are independent: repeated doc_ids and
null doc_ids give a row each. A text longer than a block is a block of its own, and is cut lazily. An empty
table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.llm._shared import by_key, parts_for, text_bytes, written

#: Text of a block, text to a bucket, and pieces that merges are replayed on at once.
BLOCK_BYTES, BUCKET_BYTES, FLUSH_BYTES = 32_000_000, 8_000_000, 24_000_000
#: Texts of more characters are cut lazily.
LAZY_CHARS = 4_000_000
NONE = np.iinfo(np.int32).max


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Bpe:
    """A rank file: ``encode_pieces`` by merge replay, ``decode`` by the table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 32 | ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs] or [NONE], np.int32)

    @classmethod
    def load(cls, name: str) -> Bpe:
        with open(tokenizer_path(name), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return cls(ranks, tokenizer_pattern())

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; NONE where they form no token."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def merge_alone(self, piece: bytes) -> list[int]:
        """One piece: again and again the leftmost pair of the lowest rank."""
        token = [int(self.of_byte[b]) for b in piece]
        n = len(token)
        after, before, stands = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def rank(i: int) -> int | None:
            j = after[i]
            return self.ranks.get(self.bytes_of[token[i]] + self.bytes_of[token[j]]) if j < n else None

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not stands[i] or rank(i) != r:
                continue
            j = after[i]
            token[i], after[i], stands[j] = r, after[j], False
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (q := rank(k)) is not None:
                    heapq.heappush(heap, (q, k))
        return [t for t, s in zip(token, stands, strict=True) if s]

    def replay(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all pieces, one after another, and each piece's number of them."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        token = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(token)
        if not n:
            return token, sizes
        ends = np.cumsum(sizes)
        after = np.arange(1, n + 1, dtype=np.int64)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1, dtype=np.int64)
        before[(ends - sizes)] = -1
        rank = np.full(n, NONE, np.int32)
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.rank_of(token[inner], token[inner + 1])
        stands = np.ones(n, bool)
        # the inverted index: positions by the rank of the pair that begins there
        live = np.flatnonzero(rank != NONE)
        live = live[np.argsort(rank[live], kind="stable")]
        ranks, starts = np.unique(rank[live], return_index=True)
        index: dict[int, list[np.ndarray]] = {int(r): [p] for r, p in zip(ranks, np.split(live, starts[1:]), strict=True)} if len(live) else {}
        heap = list(index)
        heapq.heapify(heap)
        chosen = np.zeros(n, bool)
        odd: list[np.ndarray] = []  # positions of pieces with a pair of a lower rank than a merge before
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[rank[at] == r]
            if not len(at):
                continue
            right = after[at]
            chosen[at] = True
            if (clash := chosen[right]).any():  # overlapping places: the leftmost of each run, then every other
                keep = self._leftmost(at, right, clash, chosen)
                chosen[at] = False
                at, right = at[keep], right[keep]
            else:
                chosen[at] = False
            beyond = after[right]
            token[at] = r
            after[at] = beyond
            stands[right] = False
            rank[right] = NONE
            has = beyond >= 0
            before[beyond[has]] = at[has]
            rank[at[~has]] = NONE
            left = before[at]
            touched = np.unique(np.concatenate([at[has], left[left >= 0]]))
            if not len(touched):
                continue
            new = self.rank_of(token[touched], token[after[touched]])
            rank[touched] = new
            some = new != NONE
            touched, new = touched[some], new[some]
            if not len(new):
                continue
            if new.min() < r:
                odd.append(touched[new < r])
            if len(new) == 1:
                self._push(index, heap, int(new[0]), touched)
                continue
            order = np.argsort(new, kind="stable")
            touched, new = touched[order], new[order]
            cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
            lo = 0
            for hi in [*cuts.tolist(), len(new)]:
                self._push(index, heap, int(new[lo]), np.sort(touched[lo:hi]) if hi - lo > 1 else touched[lo:hi])
                lo = hi
        counts = np.add.reduceat(stands, ends - sizes).astype(np.int64)
        ids = token[stands]
        if odd:
            ids, counts = self._mend(pieces, ids, counts, np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")))
        return ids, counts

    @staticmethod
    def _push(index: dict, heap: list, rank: int, at: np.ndarray) -> None:
        if rank in index:
            index[rank].append(at)
        else:
            index[rank] = [at]
            heapq.heappush(heap, rank)

    @staticmethod
    def _leftmost(at: np.ndarray, right: np.ndarray, clash: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Which of sorted places stay, so that none begins in the right part of one that stays."""
        keep = np.ones(len(at), bool)
        taken = -1
        near = np.flatnonzero(clash | np.r_[False, clash[:-1]])
        for k in near.tolist():
            if at[k] == taken:
                keep[k] = False
            else:
                taken = right[k]
        return keep

    def _mend(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(counts) - counts
        parts, done = [], 0
        for k in which.tolist():
            alone = np.array(self.merge_alone(pieces[k]), np.int32)
            parts += [ids[done : starts[k]], alone]
            done = starts[k] + counts[k]
            counts[k] = len(alone)
        return np.concatenate([*parts, ids[done:]]), counts

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Numbers(dict):
    """Pieces by the order in which they are first asked for."""

    def __missing__(self, piece) -> int:
        self[piece] = k = len(self)
        return k


_LOADED: dict[str, Bpe] = {}


def loaded(name: str) -> Bpe:
    """The tokenizer of a file, read once in a process."""
    if name not in _LOADED:
        _LOADED[name] = Bpe.load(name)
    return _LOADED[name]


_REPLY = "block long, role int, bucket int, payload binary"
_PACKED = pa.schema([("block", pa.int64()), ("role", pa.int32()), ("bucket", pa.int32()), ("payload", pa.binary())])


def _batch(block: list, role: int, bucket: list, payload: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array([role] * len(block), pa.int32()), pa.array(bucket, pa.int32()), pa.array(payload, pa.binary())], schema=_PACKED)


def _rows_of(pieces: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in pieces:
        yield from zip(*(b.column(k).to_pylist() for k in ("block", "role", "bucket", "payload")), strict=True)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, each byte by byte, compressed."""
    head = np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], np.int64)
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.compress(b"".join([head.tobytes(), *planes]), 9)


def _unpack(payload: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.decompress(payload)
    at, out = 8 * (1 + 2 * len(kinds)), []
    sizes = np.frombuffer(raw, np.int64, 2 * len(kinds), 8).tolist()
    for kind, n, width in zip(kinds, sizes[::2], sizes[1::2], strict=True):
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at).reshape(width, -1).T).view(kind).ravel())
        at += n * width
    return out


def _escaped(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of which most are small: a byte for each, and the rest of those from 255 on."""
    rest = x[x >= 255] - 255
    return np.minimum(x, 255).astype(np.uint8), (rest & 255).astype(np.uint8), (rest >> 8).astype(np.uint16)


def _plain(first: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = first.astype(np.int32)
    out[first == 255] += low.astype(np.int32) + (high.astype(np.int32) << 8)
    return out


def numbered(text: str, numbers: dict[str, int], pattern, lazy: int) -> np.ndarray:
    """The numbers of a text's pieces, in order."""
    if len(text) <= lazy:
        return np.fromiter(map(numbers.__getitem__, pattern.findall(text)), np.int32)
    found, parts = (m.group() for m in pattern.finditer(text)), []
    while some := list(itertools.islice(found, 100_000)):
        parts.append(np.fromiter(map(numbers.__getitem__, some), np.int32))
    return np.concatenate(parts)


def _cut(name: str, buckets: int):
    """Batches of ``doc_id, text`` to blocks: the texts as numbers (role 0) and the pieces that they ask for (role 1)."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(name)
        block, numbers, held, size = TaskContext.get().partitionId() << 32, _Numbers(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            raw = [p.encode() for p in numbers]
            code = np.array([bpe.ranks.get(p, -1) for p in raw], np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *(at for _, at in held)])
            often = np.argsort(-np.bincount(flat, minlength=len(code)), kind="stable")  # small numbers for frequent pieces
            place = np.empty(len(code), np.int32)
            place[often] = np.arange(len(code))
            rest = often[code[often] < 0]
            to = np.array([zlib.crc32(raw[k]) % buckets for k in rest.tolist()], np.int64)
            code[rest] = -1 - to  # a piece is asked for in its bucket, there in the order of these numbers
            rest, to = rest[np.argsort(to, kind="stable")], np.sort(to)
            real = np.array([i is not None for i, _ in held], np.uint8)
            ids = np.array([i or 0 for i, _ in held], np.int64)
            yield _batch([block], 0, [-1], [_pack(ids, real, np.array([len(at) for _, at in held], np.int64), code[often], *_escaped(place[flat]))])
            cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]).tolist() if len(to) else []
            asked = [[raw[k] for k in rest[x:y].tolist()] for x, y in zip(cuts, [*cuts[1:], len(to)], strict=False)]
            if asked:
                yield _batch([block] * len(asked), 1, to[cuts].tolist(), list(map(_said, asked)))

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                if held and size + len(text) > BLOCK_BYTES:
                    yield from flush()
                    block, numbers, held, size = block + 1, _Numbers(), [], 0
                held.append((doc_id, numbered(text, numbers, bpe.pattern, LAZY_CHARS)))
                size += len(text)
        if held:
            yield from flush()

    return task


def _said(pieces: list[bytes]) -> bytes:
    return _pack(np.array([len(p) for p in pieces], np.int32), np.frombuffer(b"".join(pieces), np.uint8))


def _heard(payload: bytes) -> list[bytes]:
    sizes, flat = _unpack(payload, np.int32, np.uint8)
    raw, ends = flat.tobytes(), np.cumsum(sizes).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _merged(name: str):
    """A bucket's pieces, each merged once, to the tokens of what each block asked for (role 1)."""

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, numbers, asked = loaded(name), _Numbers(), []
        for block, _, _, payload in _rows_of(pieces):
            some = _heard(payload)
            asked.append((block, np.fromiter(map(numbers.__getitem__, some), np.int64, len(some))))
        every = list(numbers)
        ids, counts, low, size = [], [], 0, 0
        for k, piece in enumerate(every):
            size += len(piece)
            if size >= FLUSH_BYTES or k + 1 == len(every):
                part = bpe.replay(every[low : k + 1])
                ids.append(part[0])
                counts.append(part[1])
                low, size = k + 1, 0
        pool, n = np.concatenate(ids), np.concatenate(counts)
        start = np.cumsum(n) - n
        for block, at in asked:
            yield _batch([block], 1, [key[0]], [_pack(n[at].astype(np.int32), pool[_spans(start[at], n[at])])])

    return work


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``start[k], ..., start[k] + n[k] - 1`` for each k, one after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _joined(name: str, build):
    """A block's numbers and the tokens that it asked for to rows of ``build(doc_id, ids, bpe)``."""

    def work(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, payload, answers = loaded(name), b"", {}
        for _, role, bucket, said in _rows_of(pieces):
            if role == 0:
                payload = said
            else:
                answers[bucket] = said
        doc_ids, real, sizes, code, *said = _unpack(payload, np.int64, np.uint8, np.int64, np.int32, np.uint8, np.uint8, np.uint16)
        flat = _plain(*said)
        got = [_unpack(answers[k], np.int32, np.int32) for k in sorted(answers)]
        counts = np.concatenate([np.zeros(0, np.int64), *(g[0] for g in got)])
        pool = np.concatenate([np.zeros(0, np.int32), *(g[1] for g in got), code[code >= 0]])
        whole = code >= 0
        n, start = np.ones(len(code), np.int64), np.empty(len(code), np.int64)
        asked = np.flatnonzero(~whole)
        asked = asked[np.argsort(-1 - code[asked], kind="stable")]
        n[asked], start[asked] = counts, np.cumsum(counts) - counts
        start[whole] = counts.sum() + np.arange(whole.sum())
        rows, low = [], 0
        for doc_id, is_real, size in zip(doc_ids.tolist(), real.tolist(), sizes.tolist(), strict=True):
            at = flat[low : low + size]
            rows.append(build(doc_id if is_real else None, pool[_spans(start[at], n[at])], bpe))
            low += size
            if len(rows) == 2000:
                yield pa.RecordBatch.from_pylist(rows, build.schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, build.schema)

    return work


def _encoded(docs: DataFrame, name: str, build, schema: str) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = parts_for(text_bytes(docs), 2 * BUCKET_BYTES)
    blocks = written(docs.mapInArrow(_cut(name, 2 * parts), _REPLY), "bpe-blocks")
    tokens = by_key(blocks.where("role = 1"), parts, ["bucket"], ["block"], _merged(name), _REPLY, F.col("bucket"))
    turn = F.expr("shiftright(block, 32) * 7919 + (block & 4294967295)")  # blocks of one writing task follow each other
    return by_key(blocks.where("role = 0").unionByName(tokens), parts, ["block"], ["role"], _joined(name, build), schema, turn)


class _Ids:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def __call__(self, doc_id, ids, bpe):
        return {"doc_id": doc_id, "ids": ids}


class _Digests:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def __call__(self, doc_id, ids, bpe):
        back = bpe.decode(ids.tolist())
        return {"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256(back).hexdigest()}


def encode(docs: DataFrame, name: str) -> DataFrame:
    """``doc_id, ids``: the tokens of each text by the rank file ``name``."""
    return _encoded(docs, name, _Ids(), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, name: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; ids that are no whole characters become replacement marks."""

    def task(batches):
        bpe = loaded(name)
        for b in batches:
            texts = [bpe.decode(ids).decode(errors="replace") if ids is not None else None for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, text string")


def encode_digests(docs: DataFrame, name: str) -> DataFrame:
    """``encode`` and ``decode`` in one pass: counts and digests of the ids and of the decoded bytes."""
    return _encoded(docs, name, _Digests(), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
