"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A pre-token's merges are reproduced without merging: an Aho-Corasick automaton
over the vocabulary, its byte strings read as Latin-1, gives at each byte the
longest token that begins there; a token may follow another only if the two are
what BPE itself makes of their joint bytes, which is decided once per pair and
remembered; and where no token fits, the walk goes back and takes the next
shorter one. Each byte is tried at most once, so the time is linear. Encoded
pre-tokens are remembered by each worker, in its later tasks too, up to a fixed
number of bytes and until it works on another operator; long ones are not.

Null is an empty text; an empty text has no tokens. Decoding gives the exact
bytes back. Rows are independent, repeated rows are encoded again, no rows give
none, and only the named columns are read. A pre-token has one encoding, so there
are no ties.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store, text

#: Bytes that each of a worker's two generations of remembered pre-tokens takes at most, and what
#: an entry takes beside its text and ids. Longer pre-tokens are encoded each time.
REMEMBERED_BYTES, ENTRY_BYTES, LONGEST = 20 << 20, 160, 64
#: Pairs of tokens of which a worker remembers at most whether they may stand side by side.
REMEMBERED_PAIRS = 1 << 17
_NONE = -1


def read_ranks(lines: list[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def decoded(tokens: dict[int, bytes], ids: list[int]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids))


class Encoder:
    """Encodes the bytes of one pre-token into ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=-1) + 1
        self.lengths = [0] * size
        #: The longest token that a token begins with, other than itself.
        self.prefix = [_NONE] * size
        #: Ids of the two tokens that merge into a token; single bytes have none.
        self.parts: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self._compatible: dict[int, bool] = {}
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
            automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        automaton.make_automaton()
        self.automaton = automaton
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for size in range(len(token) - 1, 0, -1):
                if token[:size] in ranks:
                    self.prefix[rank] = ranks[token[:size]]
                    break
            if len(token) > 1 and (parts := self._merged(token, rank)):
                self.parts[rank] = parts
                self.pairs[parts] = rank

    def _merged(self, token: bytes, below: int) -> tuple[int, int] | None:
        """The last merge that makes a token, by merges of lower rank."""
        pieces = [token[i : i + 1] for i in range(len(token))]
        while len(pieces) > 2:
            ranked = [(self.ranks.get(pieces[i] + pieces[i + 1], below), i) for i in range(len(pieces) - 1)]
            rank, i = min(ranked)
            if rank >= below:
                return None
            pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        return (self.ranks[pieces[0]], self.ranks[pieces[1]]) if len(pieces) == 2 else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps the two as they are when their bytes stand side by side."""
        pair = left << 32 | right
        known = self._compatible.get(pair)
        if known is None:
            if len(self._compatible) >= REMEMBERED_PAIRS:
                self._compatible.clear()
            known = self._compatible[pair] = self._decide(left, right)
        return known

    def _decide(self, left: int, right: int) -> bool:
        """Undo the two tokens' merges from the last one on; a merge across the seam that ranks lower would have come first."""
        limit = 1 << 62
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < limit:
                return False
            if left > right:
                limit = left
                if (parts := self.parts.get(left)) is None:
                    limit = right + 1
                    if (parts := self.parts.get(right)) is None:
                        return True
                    right = parts[0]
                else:
                    left = parts[1]
            else:
                limit = right + 1
                if (parts := self.parts.get(right)) is None:
                    limit = left
                    if (parts := self.parts.get(left)) is None:
                        return True
                    left = parts[1]
                else:
                    right = parts[0]

    def longest(self, piece: bytes) -> list[int]:
        """At each byte, the longest token that begins there: matches come by their ends, so the last one."""
        out = [_NONE] * len(piece)
        for end, (before, rank) in self.automaton.iter(piece.decode("latin-1")):
            out[end - before] = rank
        return out

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        longest, lengths, prefix, known = self.longest(piece), self.lengths, self.prefix, self._compatible
        size = len(piece)
        fits = bytearray(b"\x01") * (size + 1)
        ids: list[int] = []
        at, token, last = 0, longest[0], _NONE
        while at < size:
            while token != _NONE:
                end = at + lengths[token]
                if fits[end]:
                    if last == _NONE:
                        break
                    fitting = known.get(last << 32 | token)
                    if fitting or fitting is None and self.compatible(last, token):
                        break
                token = prefix[token]
            if token != _NONE:
                ids.append(token)
                at, last = end, token
                token = longest[at] if at < size else _NONE
            else:
                if not ids:
                    raise ValueError("the vocabulary lacks single bytes")
                fits[at] = 0
                token = ids.pop()
                last = ids[-1] if ids else _NONE
                at -= lengths[token]
                token = prefix[token]
        return ids


class Remembered(dict):
    """Encoded pre-tokens as little-endian 32-bit ids, in two generations of bounded size.

    When the younger one, this dictionary, is full, it becomes the older one and what was that is
    forgotten; an entry that is asked for again moves to the younger one.
    """

    def __init__(self, encoder: Encoder, most: int = REMEMBERED_BYTES):
        super().__init__()
        self.encoder, self.most = encoder, most
        self.older: dict[str, bytes] = {}
        self.size = 0

    def __missing__(self, piece: str) -> bytes:
        made = self.older.get(piece)
        if made is None:
            ids = self.encoder.encode(piece.encode())
            made = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) > LONGEST:
                return made
        if self.size >= self.most:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self[piece] = made
        self.size += ENTRY_BYTES + len(piece) + len(made)
        return made


def remembered(raw: bytes) -> Remembered:
    """What this worker has encoded so far by the ranks in ``raw``; one vocabulary at a time."""
    digest = hashlib.sha256(raw).hexdigest()
    if digest not in text.kept:
        text.kept.clear()
        text.kept[digest] = Remembered(Encoder(read_ranks(raw.split(b"\n"))))
    return text.kept[digest]


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, read by the driver and broadcast."""
    store.ship(spark)
    with open(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame,
    vocabulary: str = "",
    pattern: str = public_tokenizers.PATTERN,
    text_column: str = "text",
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``columns`` with ids (binary, little-endian unsigned 32 bits) and n_tokens of every text."""
    shared = _vocabulary(docs.sparkSession, vocabulary)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = regex.compile(pattern)
        known = remembered(shared.value)
        for batch in (part for whole in batches for part in text.parts(whole, 0)):
            made = [b"".join(map(known.__getitem__, pieces.findall(x or ""))) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k + 1) for k in range(len(columns))), pa.array(made, pa.binary()), pa.array([len(x) // 4 for x in made], pa.int64())],
                names=[*columns, "ids", "n_tokens"],
            )

    schema = f"{fields}{', ' if fields else ''}ids binary, n_tokens bigint"
    return docs.select(F.col(text_column).alias("_text"), *columns).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str = "", columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """``columns`` with ``decoded``, the bytes that the ids stand for; null ids decode to nothing."""
    shared = _vocabulary(encoded.sparkSession, vocabulary)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in encoded.select(*columns).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers change places: one that has encoded before would hold that and the tokens too.
        text.kept.clear()
        tokens = {rank: token for token, rank in read_ranks(shared.value.split(b"\n")).items()}
        for batch in (part for whole in batches for part in text.parts(whole, 0)):
            made = [decoded(tokens, np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(0).to_pylist()]
            kept = [batch.column(k + 1) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.binary())], names=[*columns, "decoded"])

    schema = f"{fields}{', ' if fields else ''}decoded binary"
    return encoded.select(F.col("ids").alias("_ids"), *columns).mapInArrow(run, schema)
