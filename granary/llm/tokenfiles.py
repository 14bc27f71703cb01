"""Token ids of a corpus in ascending document order, in Simple-8b files with block offsets.

A file is: MAGIC; the words of :mod:`granary.llm.simple8b`; a table of documents (valid flag,
doc_id, first token of each, and behind the last); the first word of every block; a footer
with the counts of tokens, documents, words and blocks. A reader takes footer and tables, and
then the words of the blocks that the documents wanted lie in.

Documents are dealt out by ranges of (doc_id, hash of the text), so that rows that share a
doc_id can be parted; a task writes files of bounded size under names that no other attempt
uses, and the list of files that counts is what the writing job returned. Positions of whole
files in the corpus are sums over that list.

Results: null and empty texts are the end id alone; null doc_ids come first; rows that repeat
a doc_id follow each other, in the order of their texts' hashes, as documents of their own;
an empty table gives no files and no rows; other columns are left behind.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm import simple8b
from granary.llm.bpe import Remembering, spelled
from granary.llm.common import exact, folder_uri, longs
from granary.llm.simple8b import BLOCK
from granary.session import durable

MAGIC = b"S8BTOKEN"
FOOTER = "<QQQQ"
END_ID = 0
FILE_IDS = 4 << 20
CHUNK_IDS = 256 * BLOCK
#: Ids that a reader holds at a time, besides those of one document.
READ_IDS = 1 << 20
#: How byte-level vocabularies write a space, and how many stretches are encoded as one text.
SPACE, TOGETHER = "\u0120", 256
#: Stretches a worker remembers.
REMEMBERED = 800_000
#: Partitions of a reading job at most.
READERS = 10_000
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 4 << 20

_WORKER: dict[int, Remembering] = {}


def tokenizer(definition: str) -> Remembering:
    """The tokenizer of this worker process; strings of special tokens in a text are ordinary text."""
    key = hash(definition)
    if key not in _WORKER:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_str(definition)
        loaded.encode_special_tokens = True

        spaced = np.array([loaded.id_to_token(k).startswith(SPACE) for k in range(loaded.get_vocab_size())])

        def ids_of(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in loaded.encode_batch_fast(texts, add_special_tokens=False)]

        def learn(fresh: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Stretches with one space, at their start, are encoded together and parted at the spaces again."""
            plain = np.fromiter((isinstance(s, str) and s != "" and " " not in s for s in fresh), bool, len(fresh))
            words = list(compress(fresh, plain))
            joined = ids_of([" " + " ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)])
            flat = np.fromiter(chain.from_iterable(joined), np.uint32)
            cuts = np.flatnonzero(spaced[flat])
            if len(cuts) != len(words):
                raise ValueError("a token with a space inside a stretch")
            alone = ids_of([spelled(s) for s in compress(fresh, ~plain)])
            lengths = np.concatenate([np.diff(np.append(cuts, len(flat))), np.fromiter(map(len, alone), np.int64, len(alone))])
            order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
            return order, np.concatenate([flat, np.fromiter(chain.from_iterable(alone), np.uint32)]), lengths.astype(np.int64)

        _WORKER.clear()
        _WORKER[key] = Remembering(learn, REMEMBERED)
    return _WORKER[key]


class FileWriter:
    """Streams the documents of one file; holds the tables and less than a chunk of ids."""

    def __init__(self, stream):
        self.stream = stream
        self.stream.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held = self.tokens = self.words = 0
        self.blocks: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.starts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.tokens)
        self.waiting.append(ids)
        self.held += len(ids)
        self.tokens += len(ids)
        if self.held >= CHUNK_IDS:
            self._pack(self.held - self.held % BLOCK)

    def _pack(self, n: int) -> None:
        found = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint64)
        for i in range(0, n, CHUNK_IDS):
            words, first = simple8b.pack(found[i : min(n, i + CHUNK_IDS)])
            self.stream.write(words.astype("<u8").tobytes())
            self.blocks.append(first + self.words)
            self.words += len(words)
        self.waiting = [found[n:]]
        self.held = len(found) - n

    def close(self) -> None:
        self._pack(self.held)
        blocks = np.concatenate(self.blocks) if self.blocks else np.empty(0, np.int64)
        known = np.array([x is not None for x in self.ids], np.uint8)
        for part in (
            known, np.array([x or 0 for x in self.ids], "<i8"), np.array([*self.starts, self.tokens], "<i8"), blocks.astype("<i8")
        ):
            self.stream.write(part.tobytes())
        self.stream.write(struct.pack(FOOTER, self.tokens, len(self.ids), self.words, len(blocks)))
        self.stream.close()


FILES = "path string, documents long, tokens long, first_id long, first_hash long, part int"


def write(documents: DataFrame, folder: str, tokenizer_path: str, text: str = "text") -> DataFrame:
    """Write the ids of all texts below ``folder``; the files with their counts and first keys."""
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = documents.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary

    def files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = tokenizer(shared.value)
        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        out, part = None, 0
        for batch in batches:
            lengths = batch["text"].str.len().cumsum() // GROUP_CHARS
            for _, group in batch.groupby(lengths, sort=False):
                columns = (group[c] for c in ("doc_id", "doc_id_known", "h"))
                for doc, known, h, ids in zip(*columns, coder.encode(group["text"].tolist())):
                    doc = int(doc) if known else None
                    if out is None:
                        path = f"{at}/{uuid.uuid4().hex}.s8b"
                        out, first = FileWriter(store.open_output_stream(path)), (doc, int(h))
                    out.add(doc, np.append(ids, np.uint32(END_ID)))
                    if out.tokens >= FILE_IDS:
                        yield _listed(out, path, first, part)
                        out, part = None, part + 1
        if out is not None:
            yield _listed(out, path, first, part)

    rows = documents.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    return durable(dealt.select(*exact("doc_id"), "text", "h").mapInPandas(files, FILES))


def _listed(out: FileWriter, path: str, first: tuple, part: int) -> pd.DataFrame:
    out.close()
    found = pd.DataFrame(
        {"path": [path], "documents": [len(out.ids)], "tokens": [out.tokens], "first_id": [first[0]], "first_hash": [first[1]], "part": [part]}
    )
    return found.assign(first_id=longs([first[0]]))


class FileReader:
    """Tables of a file, and the ids of runs of its documents."""

    def __init__(self, file):
        self.file = file
        size, foot = file.size(), struct.calcsize(FOOTER)
        if file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        self.tokens, self.documents, self.words, self.blocks = struct.unpack(FOOTER, file.read_at(foot, size - foot))
        at = len(MAGIC) + 8 * self.words
        raw = file.read_at(size - foot - at, at)
        d = self.documents
        self.known = np.frombuffer(raw, np.uint8, d)
        self.ids = np.frombuffer(raw, "<i8", d, d)
        self.starts = np.frombuffer(raw, "<i8", d + 1, 9 * d)
        self.first = np.append(np.frombuffer(raw, "<i8", self.blocks, 9 * d + 8 * (d + 1)), self.words)

    def tokens_of(self, a: int, b: int) -> np.ndarray:
        """Ids of the documents from a up to b, decoded from the blocks they lie in."""
        low, high = int(self.starts[a]), int(self.starts[b])
        if low == high:
            return np.empty(0, np.uint64)
        block, behind = low // BLOCK, -(-high // BLOCK)
        word, end = int(self.first[block]), int(self.first[behind])
        words = np.frombuffer(self.file.read_at(8 * (end - word), len(MAGIC) + 8 * word), "<u8")
        n = min(self.tokens, behind * BLOCK) - block * BLOCK
        return simple8b.unpack(words, self.first[block:behind] - word, n)[low - block * BLOCK : high - block * BLOCK]


def positions(files: DataFrame) -> DataFrame:
    """The files with the number of ids before each; a row is a file."""
    order = Window.orderBy(F.asc_nulls_first("first_id"), "first_hash", "part", "path").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("before"))


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"]):
                with store.open_input_file(path) as file:
                    reader, a = FileReader(file), 0
                    while a < reader.documents:
                        b = max(a + 1, int(np.searchsorted(reader.starts, reader.starts[a] + READ_IDS, side="right")) - 1)
                        ids = reader.tokens_of(a, b).astype("<u4")
                        cuts = (reader.starts[a : b + 1] - reader.starts[a]).tolist()
                        raw = memoryview(ids.tobytes())
                        yield pd.DataFrame(
                            {
                                "doc_id": pd.array(reader.ids[a:b], dtype="Int64").copy(),
                                "start": reader.starts[a:b] + int(before),
                                "n_tokens": np.diff(reader.starts[a : b + 1]),
                                "ids_crc32": [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(cuts, cuts[1:])],
                            }
                        ).assign(doc_id=lambda f, k=reader.known[a:b]: f["doc_id"].where(k == 1))
                        a = b

    # a row is a whole file, however few its bytes are: as many partitions as files, up to READERS
    parts = min(READERS, max(1, files.count()))
    return positions(files).repartition(parts, F.col("path")).mapInPandas(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(documents: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """Write the corpus' ids into the shared folder and read every document back."""
    folder = folder_uri(documents.sparkSession, "tokens")
    return read(write(documents, folder, tokenizer_path, text), folder)
