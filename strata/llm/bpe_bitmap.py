"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

One pre-token is a doubly linked list of parts. Every adjacent pair whose
joined bytes have a rank is an entry (left position) in the bucket of that
rank; a two-level bitmap over the ranks says which buckets hold entries:
find-first-set on the top word, then on one 256-bit word, gives the smallest
rank. Merging a pair links its right part out and enters its two new
neighbours' pairs; entries of pairs that no longer exist are left where they
are and skipped when popped (an entry is stale when its left part is gone or
its pair now has another rank). A bucket is a heap of positions, so equal
ranks merge from the left, and a merge that makes a smaller rank is followed
by that rank, as the reference algorithm of byte-pair encoding does. n bytes
take O(n log n), also for one pre-token of a megabyte.

Texts are encoded in Arrow batches by a pandas UDF; tasks share nothing but
the rank file's content, a broadcast of fixed size (the vocabulary). A
worker remembers up to ``CACHE`` short pre-tokens.

Defined cases: a null text is encoded as the empty text (no ids); any text
decodes to its own UTF-8 bytes, as every byte has a rank; repeated rows give
equal results row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

CACHE = 700_000            # remembered pre-tokens of a worker, in each of two generations
CACHED_CHARS = 40          # longer ones are not remembered
WORD_BITS = 8              # 256-bit words in the lower level


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file's lines: base64 of the token's bytes, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_pretoken(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token's bytes."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    part: list = [piece[i:i + 1] for i in range(n)]     # None: merged into its left neighbour
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank_of: list = [None] * n                          # rank of the pair that starts here
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}                          # lower level: 256 ranks a word
    top = 0                                             # upper level: a bit per non-empty word
    rank_get = ranks.get

    for i in range(n - 1):
        r = rank_get(piece[i:i + 2])
        if r is not None:
            rank_of[i] = r
            if r in buckets:
                buckets[r].append(i)                    # increasing positions are a heap
            else:
                buckets[r] = [i]
                w = r >> WORD_BITS
                if w in words:
                    words[w] |= 1 << (r & 255)
                else:
                    words[w] = 1 << (r & 255)
                    top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = words[w]
        low = bits & -bits
        r = w << WORD_BITS | low.bit_length() - 1
        bucket = buckets[r]
        if len(bucket) == 1:
            i = bucket[0]
            del buckets[r]
            if bits == low:
                del words[w]
                top ^= 1 << w
            else:
                words[w] = bits ^ low
        else:
            i = heappop(bucket)
        if rank_of[i] != r:
            continue                                    # stale
        j = after[i]
        merged = part[i] = part[i] + part[j]
        part[j] = rank_of[j] = None
        k = after[i] = after[j]
        h = before[i]
        if k < n:
            before[k] = i
            new = rank_of[i] = rank_get(merged + part[k])
            if new is not None:
                if new in buckets:
                    heappush(buckets[new], i)
                else:
                    buckets[new] = [i]
                    w = new >> WORD_BITS
                    if w in words:
                        words[w] |= 1 << (new & 255)
                    else:
                        words[w] = 1 << (new & 255)
                        top |= 1 << w
        else:
            rank_of[i] = None
        if h >= 0:
            new = rank_of[h] = rank_get(part[h] + merged)
            if new is not None:
                if new in buckets:
                    heappush(buckets[new], h)
                else:
                    buckets[new] = [h]
                    w = new >> WORD_BITS
                    if w in words:
                        words[w] |= 1 << (new & 255)
                    else:
                        words[w] = 1 << (new & 255)
                        top |= 1 << w
    return [ranks[p] for p in part if p is not None]


def narrow_pattern(pattern: str) -> str:
    """The same split pattern for texts of code points under 256, with
    explicit characters for \\p{L}, \\p{N}, \\s and \\S: Python's own
    ``re`` runs it about twice as fast."""
    import re

    import regex
    low = [chr(c) for c in range(256)]
    members = {k: "".join(re.escape(c) for c in low if regex.fullmatch(k, c)) for k in (r"\p{L}", r"\p{N}", r"\s")}
    out, i, inside = [], 0, False
    while i < len(pattern):
        known = next((k for k in (*members, r"\S") if pattern.startswith(k, i)), None)
        if known == r"\S":
            out.append(f"[^{members[chr(92) + 's']}]")
        elif known:
            out.append(members[known] if inside else f"[{members[known]}]")
        else:
            inside = pattern[i] == "[" or inside and pattern[i] != "]"
            out.append(pattern[i])
        i += len(known or "x")
    return "".join(out)


class Pieces(dict):
    """Pre-token -> ids, filled as met. When full, all move to an older
    generation, from which those met again come back."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = tuple(merge_pretoken(piece.encode(), self.ranks))     # a tuple of numbers is no burden to the garbage collector
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import re

        import regex
        self.split_any = regex.compile(pattern).findall
        self.split_low = re.compile(narrow_pattern(pattern)).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.known = Pieces(ranks)

    def pieces(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split_any(text)
        return self.split_low(text)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_KEPT: dict = {}


def _codec_of(shared) -> Codec:
    """The worker's codec, kept for later tasks of the same broadcast."""
    if _KEPT.get("of") is not shared.value:
        ranks, pattern = shared.value
        _KEPT.update(of=shared.value, codec=Codec(ranks, pattern))
    return _KEPT["codec"]


def _share(spark: SparkSession, path: str, pattern: str):
    return spark.sparkContext.broadcast((load_ranks(path), pattern))


def encode(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """array<int>: the ids of a text."""
    shared = _share(spark, path, pattern)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec_of(shared)
        for batch in batches:
            yield pd.Series([codec.encode(t) for t in batch], dtype=object)

    return ids(F.coalesce(text, F.lit("")))


def decode(spark: SparkSession, ids: Column, path: str, pattern: str) -> Column:
    """binary: the bytes of an id array (null: empty)."""
    shared = _share(spark, path, pattern)

    @F.pandas_udf("binary")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec_of(shared)
        for batch in batches:
            yield pd.Series([codec.decode(x) if x is not None else b"" for x in batch], dtype=object)

    return text(ids)


def round_trip(spark: SparkSession, text: Column, path: str, pattern: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of a text: encoded, the
    ids decoded again, digests of both (ids as decimals joined by commas)
    without sending the ids back to the JVM."""
    shared = _share(spark, path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec_of(shared)
        name = [str(i) for i in range(len(codec.tokens))].__getitem__
        sha = hashlib.sha256
        for batch in batches:
            rows = []
            for t in batch:
                ids = codec.encode(t)
                rows.append((len(ids), sha(",".join(map(name, ids)).encode()).hexdigest(), sha(codec.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(F.coalesce(text, F.lit("")))
