"""Byte-level BPE in numpy: padded matrices of pieces, merged one pair a round in every row.

A text is split by the pattern into pieces. A piece that is a token stands for itself; the
others are grouped by length into padded matrices of token ids. Each round, every row merges
its leftmost pair of least rank: pair ranks come from an open-addressing hash table of all
pairs that make a token, only the pairs beside a merge are looked up anew, rows are closed up
behind the merge, and rows without a pair left leave the matrix.

Texts are split at spaces before other characters, where no piece can cross, and each distinct
stretch is encoded once per task; a worker keeps a bounded number of them. No shuffle.

Results: a null or empty text has no ids; equal texts have equal ids; other columns pass
through, and a column of an output's name is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import concat, released, slices

NONE = np.int64(1) << 40  # rank of a pair that makes no token
PAD = -1
#: Cells of a matrix at most; a longer piece is a matrix of its own.
CELLS = 1 << 19
#: Stretches a task remembers, some 250 bytes each; then it starts afresh.
REMEMBERED = 400_000
#: The same beside ids that are verified, which hold more themselves.
REMEMBERED_VERIFYING = 100_000
# A space that cannot lie inside a piece: what follows is no white space, in any sense.
_CUT, _DOUBT = re.compile(r" (?=[^\s\x1c-\x1f\x85])"), re.compile(r" [\s\x1c-\x1f\x85]")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merges:
    """Pair -> rank of the token it makes; a hash table with linear probing, read in bulk."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, made = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        keys = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        ranked = np.array(made, np.int64)
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(max(2, 2 * len(keys)))))))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int64)
        slot = self._slot(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            free = waiting[self.keys[slot[waiting]] == -1]
            self.keys[slot[free]] = keys[free]  # of several that want a slot, one gets it
            got = self.keys[slot[waiting]] == keys[waiting]
            self.ranks[slot[waiting[got]]] = ranked[waiting[got]]
            waiting = waiting[~got]
            slot[waiting] = (slot[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where a side is PAD or the pair makes no token."""
        keys = (left.astype(np.int64) << 32) | right
        keys[(left < 0) | (right < 0)] = -2
        flat = keys.reshape(-1)
        slot = self._slot(flat)
        seen = self.keys[slot]
        out = np.where(seen == flat, self.ranks[slot], NONE)
        waiting = np.flatnonzero((seen != flat) & (seen != -1))
        while len(waiting):
            slot[waiting] = (slot[waiting] + 1) & self.mask
            seen = self.keys[slot[waiting]]
            found = seen == flat[waiting]
            out[waiting[found]] = self.ranks[slot[waiting[found]]]
            waiting = waiting[~found & (seen != -1)]
        return out.reshape(keys.shape)


class Encoder:
    """Encodes pieces; what it holds is as large as the vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.vocabulary = read_ranks(rank_file)
        self.merges = Merges(self.vocabulary)
        self.pattern = regex.compile(pattern)
        self.byte_ids = np.array([self.vocabulary[bytes([b])] for b in range(256)], np.int64)
        size = max(self.vocabulary.values()) + 1
        tokens = [b""] * size
        for token, rank in self.vocabulary.items():
            tokens[rank] = token
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of every piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        rest: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.vocabulary.get(piece)) is not None:
                out[k] = np.array([whole], np.int64)
            else:
                rest.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(k)
        for width, members in rest.items():
            rows = max(1, CELLS // width)
            for i in range(0, len(members), rows):
                part = members[i : i + rows]
                for k, ids in zip(part, self.matrix([pieces[k] for k in part])):
                    out[k] = ids
        return out

    def stretches(self, fresh: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of stretches of text, each of one or more pieces, as :class:`Remembering` wants them."""
        found = [[p.encode() for p in self.pattern.findall(spelled(s))] for s in fresh]
        distinct = {p: None for pieces in found for p in pieces}
        ids = dict(zip(distinct, self.pieces(list(distinct))))
        flat = [ids[p] for pieces in found for p in pieces]
        lengths = np.array([sum(len(ids[p]) for p in pieces) for pieces in found], np.int64)
        return np.arange(len(fresh)), np.concatenate(flat), lengths

    def matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, all merged together."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max()) + 1  # the last column stays padding
        ids = np.full((len(pieces), width), PAD, np.int64)
        ids[np.arange(width)[None, :] < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), NONE, np.int64)
        ranks[:, :-1] = self.merges.rank(ids[:, :-1], ids[:, 1:])
        out: list[np.ndarray | None] = [None] * len(pieces)
        rows, columns = np.arange(len(pieces)), np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            lane = np.arange(len(rows))
            best = ranks[lane, at]
            done = best == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[rows[k]] = ids[k, : lengths[k]].copy()
                keep = ~done
                rows, at, best, lengths = rows[keep], at[keep], best[keep], lengths[keep]
                if not len(rows):
                    break
                width = int(lengths.max()) + 1
                ids, ranks, columns = ids[keep, :width], ranks[keep, :width], np.arange(width)
                lane = np.arange(len(rows))
            # close up behind the merge: column c takes what stood at c + 1, from at + 1 on
            if len(rows) == 1:
                k = int(at[0])
                ids[0, k + 1 : -1] = ids[0, k + 2 :]
                ranks[0, k + 1 : -1] = ranks[0, k + 2 :]
            else:
                behind = columns[None, :-1] > at[:, None]
                np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=behind)
                np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=behind)
            ids[lane, at] = best
            lengths = lengths - 1
            before = np.maximum(at - 1, 0)
            ranks[lane, at] = self.merges.rank(best, ids[lane, np.minimum(at + 1, width - 1)])
            left = self.merges.rank(ids[lane, before], best)
            some = at > 0
            ranks[lane[some], before[some]] = left[some]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, gathered in one go."""
        lengths = self.token_length[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0)
        return self.token_bytes[at + np.repeat(self.token_start[ids] - (ends - lengths), lengths)].tobytes()


def stretches(text: str) -> list:
    """Keys of the stretches of ``text``, cut at spaces that no piece can cross.

    The first is a tuple of what stands before the first such space, if anything; the others
    are strings without the space that they begin with. :func:`spelled` gives their text.
    """
    parts = text.split(" ") if not _DOUBT.search(text) and not text.endswith(" ") else _CUT.split(text)
    if parts[0]:
        parts[0] = (parts[0],)
        return parts
    return parts[1:]


def spelled(key) -> str:
    return key[0] if isinstance(key, tuple) else f" {key}"


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for; ``fresh`` has the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class Remembering:
    """Texts to ids; distinct stretches are encoded once, a bounded number is kept.

    ``learn`` takes keys of stretches and gives their positions in an order of its own, their
    ids in that order one after the other, and the number of ids of each.
    """

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray]], most: int | None = None):
        self.learn, self.most = learn, most
        self.forget()

    def forget(self) -> None:
        self.place = _Numbers()
        self.flat, self.start, self.length = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _add(self) -> None:
        order, ids, lengths = self.learn(self.place.fresh)
        start, length = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        start[order], length[order] = len(self.flat) + np.cumsum(lengths) - lengths, lengths
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        self.place.fresh = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.place) > (self.most or REMEMBERED):
            self.forget()
        try:
            found = [
                np.fromiter(map(self.place.__getitem__, parts), np.int64, len(parts))
                for parts in (stretches(t) if t else () for t in texts)
            ]
            if self.place.fresh:
                self._add()
        except BaseException:
            self.forget()  # numbers without ids must not stay
            raise
        out = []
        for at in found:
            lengths = self.length[at]
            ends = np.cumsum(lengths)
            n = int(ends[-1]) if len(ends) else 0
            out.append(self.flat[np.arange(n) + np.repeat(self.start[at] - (ends - lengths), lengths)])
        return out


class Coder:
    """An encoder of pieces and what it remembers of texts."""

    def __init__(self, rank_file: bytes, pattern: str, most: int | None = None):
        self.encoder = Encoder(rank_file, pattern)
        self.encode = Remembering(self.encoder.stretches, most).encode


def _columns(spark: SparkSession, path: str, pattern: str, kind: pa.DataType, sql: str, of, most: int | None = None) -> Column:
    with open(path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())  # a vocabulary file

    @F.arrow_udf(sql)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(shared.value, pattern, most)

        def made(part: pa.Array) -> pa.Array:
            texts = [t or "" for t in part.to_pylist()]
            return pa.array([of(coder.encoder, text, ids) for text, ids in zip(texts, coder.encode(texts))], kind)

        try:
            for batch in batches:
                yield concat(map(made, slices(batch)), kind)
        finally:  # the worker process lives on; what this task remembers doesn't
            del coder
            released()

    return run


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text``, as ``array<int>``."""
    run = _columns(df.sparkSession, path, pattern, pa.list_(pa.int32()), "array<int>", lambda _, text, ids: ids.astype(np.int32))
    return df.withColumn(into, run(F.col(text)))


_VERIFIED = pa.struct([("ids", pa.list_(pa.int32())), ("decodes", pa.bool_())])


def encode_and_verify(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with the token ids of ``text``, and whether they decode to it, in one pass of one worker."""

    def both(encoder: Encoder, said: str, ids: np.ndarray) -> dict:
        return {"ids": ids.astype(np.int32), "decodes": encoder.decode(ids) == said.encode()}

    run = _columns(df.sparkSession, path, pattern, _VERIFIED, "struct<ids:array<int>,decodes:boolean>", both, REMEMBERED_VERIFYING)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ("ids", "decodes")]
    return df.select(*kept, run(F.col(text)).alias("ids")).select(*kept, "ids.ids", "ids.decodes")


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for, as binary; null ids stay null."""
    with open(path, "rb") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            # the ids stay in Arrow's array; as Python numbers they would take ten times the room
            cuts, flat = batch.offsets.to_numpy().tolist(), batch.values.to_numpy(zero_copy_only=False)
            present = batch.is_valid().to_pylist()
            rows = (encoder.decode(flat[a:b]) if p else None for p, a, b in zip(present, cuts, cuts[1:]))
            yield pa.array(rows, pa.binary())

    return df.withColumn(into, run(F.col(ids)))


_DIGEST = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _digest(encoder: Encoder, text: str, ids: np.ndarray) -> dict:
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest(),
        "decoded_sha256": hashlib.sha256(encoder.decode(ids)).hexdigest(),
    }


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id, number and hash of the ids of every text, and the hash of the bytes decoded from them."""
    run = _columns(
        df.sparkSession, path, pattern, _DIGEST, "struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>", _digest
    )
    return df.select("doc_id", run(F.col(text)).alias("d")).select("doc_id", "d.*")
