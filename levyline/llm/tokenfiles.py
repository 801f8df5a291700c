"""Token ids in binary files of byte planes.

Documents are range-partitioned and sorted by doc_id, encoded where they lie, and written as one file per partition. A file is a
row of blocks of `BLOCK` ids; a block's 4-byte ids are transposed into 4 planes (all lowest bytes, then all second bytes, ...), each
compressed by zstandard by itself. Behind the blocks stands the index:

    MAGIC | planes ... | index | length of the index (8 bytes) | MAGIC

The index is zstandard over little-endian 64-bit numbers: n_blocks, n_docs, then per block (offset, ids, 4 plane lengths), then per
document its id, whether it has one, and its number of ids. A file is written under another name and renamed when whole,
so a task that runs again replaces its own file.
"""

from __future__ import annotations

import codecs
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levyline.llm.textsets import small_batches
from levyline.session import work_folder, written

MAGIC = b"BPLANES1"
BLOCK = 65_536
# What a Python worker remembers of units and of words; further ones are encoded each time.
UNITS, PIECES = 250_000, 400_000
END_ID = 2
# The word pattern of byte-level BPE, a fixed value of the vocabulary file's pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"  # the same classes where a text is plain (below)
PLAIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
MARKS = ".,;:!?"
NUMBERS = [struct.Struct(f"<{n}I") for n in range(16)]  # ids of a piece as bytes
_SPACE_RUN = re.compile(r" (?!\S)")
_UNIT = re.compile(r" (?=\S)")
_PLAIN = re.compile("[\x00-ɏ]*")  # where every Unicode version has the same letters, digits and spaces


def _byte_letters() -> str:
    """The letters by which byte-level BPE writes the bytes 0 to 255: printable ones stand for themselves, others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    letters = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return "".join(letters[b] for b in range(256))


class Encoder(dict):
    """Ids as little-endian 32-bit numbers of a unit (a space and what follows up to the next), remembered.

    A text may be cut before any space that a non-space follows, as the pre-tokenizer cuts there, too. The pieces of a
    unit go to the vocabulary's model one by one; units with letters whose class depends on the Unicode version go
    through the whole tokenizer. So do whole texts that hold an added token of the vocabulary, which may reach over spaces.
    With `escape` special tokens inside a text are ordinary text, without it they are what the library's plain call makes of them.
    """

    def __init__(self, path: str, escape: bool = True):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if escape:
            self.tokenizer.encode_special_tokens = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (escape and t.special)]
        self.model, self.pieces, self.letters = self.tokenizer.model, {}, _byte_letters()
        self.space = self.letters[32]
        self.marks = {mark: self._model(mark) for mark in MARKS}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _model(self, letters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(letters)]
        return NUMBERS[len(ids)].pack(*ids) if len(ids) < len(NUMBERS) else np.array(ids, "<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        if not (text.isascii() or _PLAIN.fullmatch(text)):
            return self._whole(text)
        return b"".join([self.pieces.get(p) or self._piece(p) for p in PLAIN_WORDS.findall(text)])

    def _spelled(self, piece: str) -> str:
        return codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]

    def _word(self, word: str) -> bytes | None:
        """Ids of a space and a word; None unless it is nothing but letters that every Unicode version has."""
        if not word.isalpha():
            return None
        if word.isascii():
            return self.get(word) or self._model(self.space + word)
        return self._model(self._spelled(" " + word)) if _PLAIN.fullmatch(word) else None

    def _piece(self, piece: str) -> bytes:
        ids = self._model(self._spelled(piece))
        if len(self.pieces) < PIECES:
            self.pieces[piece] = ids
        return ids

    def __missing__(self, unit: str) -> bytes:
        # most units are a word, or a word and a mark: two pieces that need no pattern
        ids = self._word(unit)
        if ids is None and unit[-1:] in self.marks:
            word = self._word(unit[:-1])
            ids = word and word + self.marks[unit[-1]]
        ids = ids or self._ids(" " + unit)
        if len(self) < UNITS and len(unit) < 64:
            self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if any(a in text for a in self.added):
            return self._whole(text)
        units = _UNIT.split(text) if _SPACE_RUN.search(text) else text.split(" ")
        return self._ids(units[0]) + b"".join(map(self.__getitem__, units[1:]))


@lru_cache(maxsize=2)
def encoder(path: str, escape: bool = True) -> Encoder:
    return Encoder(path, escape)


class Writer:
    """One file: documents in, blocks of planes out; holds one block and the counts of its documents."""

    def __init__(self, sink):
        self.sink, self.at, self.level = sink, 0, zstandard.ZstdCompressor(level=3)
        self.buffer, self.held = [], 0
        self.blocks, self.docs, self.n_ids = [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.buffer.append(ids)
        self.held += len(ids)
        if self.held >= 4 * BLOCK:
            data = b"".join(self.buffer)
            for at in range(0, len(data) - 4 * BLOCK + 1, 4 * BLOCK):
                self._block(data[at:at + 4 * BLOCK])
            rest = data[len(data) // (4 * BLOCK) * 4 * BLOCK:]
            self.buffer, self.held = [rest], len(rest)

    def _block(self, data: bytes) -> None:
        planes = np.frombuffer(data, np.uint8).reshape(-1, 4).T
        packed = [self.level.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
        self.blocks.append((self.at, len(data) // 4, *map(len, packed)))
        self._put(b"".join(packed))

    def close(self) -> None:
        if self.held:
            self._block(b"".join(self.buffer))
        numbers = np.array([len(self.blocks), len(self.docs)], "<i8").tobytes()
        numbers += np.array(self.blocks, "<i8").tobytes() + np.array(self.docs, "<i8").tobytes()
        index = self.level.compress(numbers)
        self._put(index + len(index).to_bytes(8, "little") + MAGIC)


def read_index(source, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and documents of an open file, as rows of the index."""
    source.seek(size - 16)
    tail = source.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a file of byte planes, or cut off")
    length = int.from_bytes(tail[:8], "little")
    source.seek(size - 16 - length)
    numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(length)), "<i8")
    n_blocks, n_docs = numbers[:2]
    return numbers[2:2 + 6 * n_blocks].reshape(-1, 6), numbers[2 + 6 * n_blocks:].reshape(n_docs, 3)


def read_block(source, block: np.ndarray) -> bytes:
    offset, n_ids, *lengths = (int(x) for x in block)
    source.seek(offset)
    unpack = zstandard.ZstdDecompressor()
    planes = [np.frombuffer(unpack.decompress(source.read(n)), np.uint8) for n in lengths]
    return np.stack(planes, axis=1).reshape(4 * n_ids).tobytes()


def write_files(docs: DataFrame, vocabulary: str, folder: str, end_id: int = END_ID, escape: bool = True) -> DataFrame:
    """Encodes and writes `docs` (doc_id, text; others are left out); rows (part, path, n_docs, n_ids), one per file.

    Null ids come first, equal ids by a hash of their text, a null text is empty. An empty table gives no files.
    """
    end = np.array([end_id], "<u4").tobytes()
    small_batches(docs)
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)

    def write(batches):
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place)
        name, writer, sink = f"{place}/part-{part:06d}.planes", None, None
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if writer is None:
                    sink = files.open_output_stream(f"{name}.{attempt}")
                    writer = Writer(sink)
                writer.add(doc_id.as_py(), encoder(vocabulary, escape).encode(text.as_py() or "") + end)
        if writer is not None:
            writer.close()
            sink.close()
            files.move(f"{name}.{attempt}", name)
            yield pa.RecordBatch.from_pydict({
                "part": [part], "path": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids]})

    return written(ordered.mapInArrow(write, "part long, path string, n_docs long, n_ids long"), "token-files")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, read block by block."""
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))
    files = files.repartition(max(1, manifest.count()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(row["path"]) as source:
                    blocks, docs = read_index(source, source.size())
                    starts = row["first"] + np.concatenate([[0], np.cumsum(docs[:, 2])[:-1]])
                    crcs, data, used, number = np.zeros(len(docs), np.int64), b"", 0, 0
                    for i, n in enumerate(docs[:, 2].tolist()):
                        crc, left = 0, 4 * n
                        while left:
                            if used == len(data):
                                data, used, number = read_block(source, blocks[number]), 0, number + 1
                            take = min(left, len(data) - used)
                            crc = zlib.crc32(data[used:used + take], crc)
                            used, left = used + take, left - take
                        crcs[i] = crc
                ids = pa.array(docs[:, 0], mask=docs[:, 1] == 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(docs[:, 2].copy()), pa.array(crcs)], schema=schema)

    return files.select("part", "path", "first").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, vocabulary: str, end_id: int = END_ID, escape: bool = True) -> DataFrame:
    """Writes the files into a new folder of the shared one and sums up what is read back from them.

    `escape`: special tokens inside a text are ordinary text.
    """
    folder = work_folder(docs.sparkSession, "planes")
    return read_files(write_files(docs, vocabulary, folder, end_id, escape), folder)
