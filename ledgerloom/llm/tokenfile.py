"""Token-id files: one zstandard frame per document, a trailing seek table, a checksum per frame.

A file is, in order: the frames of its documents, each with the document's ids as little-endian
unsigned 32-bit integers; a skippable frame with the documents' identifiers (zstandard over
JSON); and the seek table in the public seekable format, a skippable frame with every frame's
compressed size, size and checksum (the low 32 bits of XXH64), so that any zstandard reader can
decompress the whole and a reader that knows the table only the documents it wants.

Documents are sorted by identifier (null first, then by a hash of the text) over all files of a
set; a task writes its stretch to files of its own, under names that no other attempt of the
task uses, and returns a manifest row for each. Only files in the written manifest are read, so
that a lost executor or a second attempt leaves at most files that nobody reads. The files are
written through pyarrow's file systems, next to the session's other shared data.

Null texts are empty and have the end id alone. Repeated rows are documents of their own. An
empty table writes no file. Columns beside identifier and text are not read. A text that holds a
special token's string is encoded as ordinary text. Long texts are encoded in windows, so that
besides the text only its ids are held as a whole.
"""

import functools
import itertools
import json
import os
import struct
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import pretokens
from ledgerloom.llm.bpe import gather
from ledgerloom.llm.common import give_back, materialize, new_path, place, text_blocks
from ledgerloom.llm.windows import windows

END_ID = 2
LEVEL = 3
#: A file is closed when it has grown to this size.
FILE_BYTES = 256 << 20
#: Distinct pieces whose ids a Python worker remembers.
REMEMBERED = 400_000

# Numbers of the seekable format.
SKIPPABLE, SEEK_TABLE = 0x184D2A50, 0x184D2A5E
SEEKABLE, CHECKSUMS = 0x8F92EAB1, 0x80


def checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class Writer:
    """Writes documents to an open binary stream; close() adds identifiers and seek table."""

    def __init__(self, stream):
        self.stream = stream
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.ids: list = []
        self.table: list[bytes] = []
        self.size = 0

    def add(self, doc_id, tokens: np.ndarray) -> None:
        raw = tokens.astype("<u4").tobytes()
        frame = self.compressor.compress(raw)
        self.stream.write(frame)
        self.ids.append(doc_id)
        self.table.append(struct.pack("<III", len(frame), len(raw), checksum(raw)))
        self.size += len(frame)

    def close(self) -> None:
        ids = self.compressor.compress(json.dumps(self.ids).encode())
        self.stream.write(struct.pack("<II", SKIPPABLE, len(ids)) + ids)
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.stream.close()


class Reader:
    """Reads single documents of a seekable binary stream of `size` bytes."""

    def __init__(self, stream, size: int):
        self.stream = stream
        footer = self._at(size - 9, 9)
        n, kind, magic = struct.unpack("<IBI", footer)
        if magic != SEEKABLE or not kind & CHECKSUMS:
            raise ValueError("no seek table with checksums")
        length = 8 + 12 * n + 9
        head = self._at(size - length, length)
        if struct.unpack("<II", head[:8]) != (SEEK_TABLE, length - 8):
            raise ValueError("damaged seek table")
        self.table = np.frombuffer(head, "<u4", 3 * n, 8).reshape(n, 3)
        sizes = self.table[:, 0].astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        ids = int(sizes.sum())
        magic, length = struct.unpack("<II", self._at(ids, 8))
        if magic != SKIPPABLE:
            raise ValueError("no identifiers")
        self.decompressor = zstandard.ZstdDecompressor()
        self.ids = json.loads(self.decompressor.decompress(self._at(ids + 8, length)))

    def _at(self, place: int, size: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(size)

    def __len__(self) -> int:
        return len(self.table)

    def tokens(self, number: int) -> np.ndarray:
        """The ids of document `number` of the file; ValueError if they don't match their checksum."""
        size, length, wanted = (int(x) for x in self.table[number])
        frame = self._at(int(self.starts[number]), size)
        raw = self.decompressor.decompress(frame, max_output_size=max(1, length))
        if len(raw) != length or checksum(raw) != wanted:
            raise ValueError(f"document {number}: checksum differs")
        return np.frombuffer(raw, "<u4")


def open_reader(path: str) -> Reader:
    system, name = place(path)
    return Reader(system.open_input_file(name), system.get_file_info(name).size)


@functools.cache
def tokenizer_of(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class Pieces:
    """Ids of the pieces that a Python worker has met, in one array, for later tasks too."""

    def __init__(self, vocabulary: str):
        self.tokenizer = tokenizer_of(vocabulary)
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def place(self, pieces: list[str]) -> np.ndarray:
        """Numbers of distinct pieces; those not met yet are encoded."""
        if len(self.numbers) + len(pieces) > REMEMBERED:
            self.clear()
        numbers = self.numbers
        new = [p for p in pieces if p not in numbers]
        if new:
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.flat = np.append(self.flat, np.fromiter(itertools.chain.from_iterable(lists), np.int32))
        return np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's ids)."""
        number, distinct, per_text = pretokens.split(texts)
        used = self.place(distinct)[number]
        sizes = self.sizes[used]
        upto = np.append(0, np.cumsum(sizes))
        return gather(self.flat, self.starts[used], sizes), upto[np.append(0, np.cumsum(per_text))]


@functools.cache
def _pieces(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)


def id_batches(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(identifiers, ids of their texts, bounds of each text's ids) of the (identifier, text) rows.

    A long text is encoded in windows, so that only its ids are held as a whole.
    """
    pieces = _pieces(vocabulary)
    for batch, texts in text_blocks(batches):
        if len(texts) == 1:
            ids = np.concatenate([np.empty(0, np.int32), *(pieces.encode([w])[0] for w in windows(texts[0]))])
            yield batch.column(0), ids, np.array([0, len(ids)])
        else:
            yield batch.column(0), *pieces.encode(texts)
    give_back()


MANIFEST = "part int, number int, path string, n_docs bigint, n_tokens bigint"


def write(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Encode and write all documents; the manifest: (part, number, path, n_docs, n_tokens, start), start being the ids before the file."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        system, name = place(folder)
        system.create_dir(name)
        rows: list[tuple] = []
        writer = None
        for leads, ids, bounds in id_batches(batches, vocabulary):
            for i, doc_id in enumerate(leads.to_pylist()):
                if writer is None:
                    file = f"part-{part:06d}-{len(rows):04d}-{uuid.uuid4().hex}.tok.zst"
                    writer, total = Writer(system.open_output_stream(f"{name}/{file}", compression=None)), 0
                tokens = np.append(ids[bounds[i] : bounds[i + 1]], end_id)
                writer.add(doc_id, tokens)
                total += len(tokens)
                if writer.size >= FILE_BYTES:
                    writer.close()
                    rows.append((part, len(rows), f"{folder}/{file}", len(writer.table), total))
                    writer = None
        if writer is not None:
            writer.close()
            rows.append((part, len(rows), f"{folder}/{file}", len(writer.table), total))
        names = ["part", "number", "path", "n_docs", "n_tokens"]
        types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    text = F.col(text_col).cast("string")
    rows = docs.select(id_col, F.xxhash64(text).alias("__hash"), text.alias("__text"))
    rows = rows.repartitionByRange(id_col, "__hash").sortWithinPartitions(id_col, "__hash").select(id_col, "__text")
    manifest = materialize(rows.mapInArrow(run, MANIFEST), "manifest")
    # A row per file: few, whatever the number of documents.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read(manifest: DataFrame, id_type: str = "bigint", wanted: Iterable | None = None) -> DataFrame:
    """(doc_id, start, tokens) of the documents of a manifest, or of those with wanted identifiers."""
    wanted = None if wanted is None else set(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = open_reader(path)
                lengths = reader.table[:, 1].astype(np.int64) // 4
                starts = start + np.cumsum(lengths) - lengths
                numbers = [i for i, x in enumerate(reader.ids) if wanted is None or x in wanted]
                for i in range(0, len(numbers), 500):
                    some = numbers[i : i + 500]
                    tokens = [reader.tokens(j) for j in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([reader.ids[j] for j in some], kind),
                            pa.array(starts[some]),
                            pa.array([t.tobytes() for t in tokens], pa.binary()),
                        ],
                        names=["doc_id", "start", "tokens"],
                    )

    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    n = manifest.count()
    return manifest.select("path", "start").repartition(max(1, n)).mapInArrow(run, f"doc_id {id_type}, start bigint, tokens binary")


def summary(documents: DataFrame) -> DataFrame:
    """Place, number and checksum of the ids of documents as read."""
    n = (F.length("tokens") / 4).cast("long")
    return documents.select("doc_id", "start", n.alias("n_tokens"), F.crc32("tokens").alias("ids_crc32"))
