"""Byte-level BPE encoding and decoding with a bitmap queue of merge ranks."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections import Counter
from heapq import heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame

from adlake.llm.shared import add_columns, kept, utf8

CACHED_PIECES = 600_000  # in each half of the cache; some 130 MB a half
CACHED_PIECE_CHARS = 48
HOT_PIECES = 4_000  # some two thirds of all pieces, and small enough for a core's own cache
HOT_SAMPLE_CHARS = 2_000_000  # of a worker's first texts, counted to find them
IDS = np.dtype("<u4")


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def split_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with ``\s`` meaning Unicode white space and no more.

    Python's ``\s`` also takes the separators U+001C to U+001F, which the
    library that fixed the vocabulary does not.
    """
    inside = regex.sub(r"\[\^\\s", r"[^\\p{White_Space}", pattern)
    return regex.compile(inside.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _join(buckets: dict[int, int | list[int]], rank: int, at: int) -> None:
    """One more position in a bucket that has some: a heap from then on."""
    held = buckets[rank]
    if isinstance(held, list):
        heappush(held, at)
    else:
        buckets[rank] = [held, at] if held < at else [at, held]


class BytePairCodec:
    """Encodes and decodes by merge ranks.

    A piece is a linked list of tokens. Each adjacent pair that merges waits in
    the bucket of its rank; two levels of bitmaps tell the lowest rank with a
    bucket by find-first-set. A bucket is one position or a heap of them, so
    that of equal ranks the leftmost pair merges first. An entry whose pair has changed is stale and is
    skipped when met. A piece of n bytes takes O(n log n), whatever it repeats.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # Both levels of bitmaps have words of about as many bits.
        self.shift = max(max(ranks.values(), default=0).bit_length() + 1, 2) // 2
        self.mask = (1 << self.shift) - 1
        missing = [value for value in range(256) if bytes([value]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.pattern = split_pattern(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = [ranks[bytes([value])] for value in range(256)]
        self.merges = {
            (ranks[token[:cut]], ranks[token[cut:]]): rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        self.low = [0] * ((max(ranks.values(), default=0) >> self.shift) + 1)  # all zero between pieces
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.hot: dict[str, bytes] = {}
        self.counts: Counter[str] = Counter()
        self.counted = 0

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        merges, low, end, shift, mask = self.merges.get, self.low, len(piece), self.shift, self.mask
        high = 0
        ids = list(map(self.single.__getitem__, piece))
        following = list(range(1, end + 1))
        preceding = list(range(-1, end))
        pair_rank = list(map(merges, zip(ids, ids[1:])))
        pair_rank.append(None)
        buckets: dict[int, int | list[int]] = {}
        for at, rank in enumerate(pair_rank):
            if rank is not None:
                if rank in buckets:
                    _join(buckets, rank, at)
                else:
                    buckets[rank] = at
                    word = rank >> shift
                    low[word] |= 1 << (rank & mask)
                    high |= 1 << word
        while high:
            word = (high & -high).bit_length() - 1
            bits = low[word]
            bit = bits & -bits
            rank = (word << shift) | (bit.bit_length() - 1)
            at = buckets[rank]
            if at.__class__ is list:
                bucket = at
                at = heappop(bucket)
                if not bucket:
                    del buckets[rank]
                    low[word] = bits ^ bit
                    if bits == bit:
                        high &= high - 1
            else:
                del buckets[rank]
                low[word] = bits ^ bit
                if bits == bit:
                    high &= high - 1
            if pair_rank[at] != rank:
                continue
            gone = following[at]
            after = following[gone]
            ids[at] = rank
            following[at] = after
            preceding[after] = at
            pair_rank[gone] = None
            if after < end:
                pair_rank[at] = new = merges((rank, ids[after]))
                if new is not None:
                    if new in buckets:
                        _join(buckets, new, at)
                    else:
                        buckets[new] = at
                        word = new >> shift
                        low[word] |= 1 << (new & mask)
                        high |= 1 << word
            else:
                pair_rank[at] = None
            before = preceding[at]
            if before >= 0:
                pair_rank[before] = new = merges((ids[before], rank))
                if new is not None:
                    if new in buckets:
                        _join(buckets, new, before)
                    else:
                        buckets[new] = before
                        word = new >> shift
                        low[word] |= 1 << (new & mask)
                        high |= 1 << word
        out, at = [], 0
        while at < end:
            out.append(ids[at])
            at = following[at]
        return out

    def _encoded(self, piece: str) -> bytes:
        """From the older half of the cache, or anew; then in the newer half."""
        ids = self.older.get(piece)
        if ids is None:
            ids = struct.pack(f"<{len(found)}I", *found) if (found := self.encode_piece(utf8(piece))) else b""
        if len(piece) <= CACHED_PIECE_CHARS:
            if len(self.newer) >= CACHED_PIECES:
                self.older, self.newer = self.newer, {}
            self.newer[piece] = ids
        return ids

    def _count(self, pieces: list[str], chars: int) -> None:
        """Looks out for the most frequent pieces, until enough text was seen."""
        self.counts.update(pieces)
        self.counted += chars
        if self.counted >= HOT_SAMPLE_CHARS:
            self.hot = {piece: self._encoded(piece) for piece, _ in self.counts.most_common(HOT_PIECES)}
            self.counts = Counter()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        pieces = self.pattern.findall(text)
        if self.counted < HOT_SAMPLE_CHARS:
            self._count(pieces, len(text))
        found = list(map(self.hot.get, pieces))
        if None in found:
            cached, encoded = self.newer.get, self._encoded
            found = [(cached(piece) or encoded(piece)) if ids is None else ids for piece, ids in zip(pieces, found)]
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, IDS).tolist()))


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, texts: bool = False) -> DataFrame:
    """Encodes each whole text and decodes its ids again.

    Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (and, with
    ``texts``, the ids as ``token_ids`` array and the decoded text as
    ``decoded``) to the documents' columns. A null text counts as the empty one: no tokens and
    the digests of nothing. Rows are independent: repeated rows, null ids and
    other columns change nothing. The vocabulary is broadcast; its size is
    that of a file, not of the data.
    """
    content = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((content, ranks, pattern))

    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if texts:
        added |= {"token_ids": "array<long>", "decoded": "string"}

    def start():
        content, ranks, pattern = shared.value
        codec = kept(content, lambda: BytePairCodec(ranks, pattern))

        def row(text: str | None) -> tuple:
            ids = codec.encode(text) if text else b""
            decoded = codec.decode(ids)
            digests = len(ids) // IDS.itemsize, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
            return digests + ((np.frombuffer(ids, IDS).astype(np.int64), decoded.decode("utf-8")) if texts else ())

        def run(batch: list[str | None]) -> list:
            rows = [row(text) for text in batch]
            return list(zip(*rows)) if rows else [[]] * len(added)

        return run

    return add_columns(docs, "text", added, start)
