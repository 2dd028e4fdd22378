"""Token ids in files of fixed-width bits: every id takes the fewest bits the vocabulary allows.

A file holds, in this order: the magic word, a header (bits of an id, ids of a block, ids,
documents), the byte offset of each block, the first id of each document and one past the last,
and the blocks. A block holds a fixed number of ids, a multiple of eight, so it starts at a byte
and is unpacked by itself. Numbers are little-endian, the bits of an id start with the highest.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pointmill.llm.common import dealt, saved
from pointmill.llm.tokens import encoder, slices
from pointmill.workspace import file_system, qualified, scratch_path

MAGIC = b"BITIDS01"
BLOCK = 1 << 16
#: Ids and documents after which a task begins another file.
FILE_IDS = 1 << 24
_FILE_DOCS = 200_000


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    bits = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    if bits[:, : 32 - width].any():
        raise ValueError(f"an id needs more than {width} bits")
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width).reshape(count, width)
    whole = np.zeros((count, 32), np.uint8)
    whole[:, 32 - width :] = bits
    return np.packbits(whole, axis=1).reshape(-1).view(">u4").astype(np.uint32)


class _Writer:
    """One file, held packed until it is written."""

    def __init__(self, width: int):
        self.width, self.blocks, self.rest, self.n_rest, self.starts = width, [], [], 0, [0]

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.starts.extend((self.starts[-1] + np.cumsum(lengths)).tolist())
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= BLOCK:
            flat = np.concatenate(self.rest)
            whole = len(flat) // BLOCK * BLOCK
            self.blocks.extend(pack(flat[k : k + BLOCK], self.width) for k in range(0, whole, BLOCK))
            self.rest, self.n_rest = [flat[whole:]], len(flat) - whole

    def write(self, uri: str) -> None:
        flat = np.concatenate([np.zeros(0, np.uint32), *self.rest])
        blocks = self.blocks + ([pack(flat, self.width)] if len(flat) else [])
        starts = np.array(self.starts, "<u8")
        first = len(MAGIC) + 24 + 8 * (len(blocks) + len(starts))
        offsets = first + np.concatenate([[0], np.cumsum([len(b) for b in blocks])])[: len(blocks)]
        header = np.array([self.width, BLOCK], "<u4").tobytes() + np.array([self.starts[-1], len(starts) - 1], "<u8").tobytes()
        files, path = file_system(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        # A repeated or doubled task writes the same content; the move puts it there in one step.
        attempt = f"{path}.{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(attempt) as out:
            for part in (MAGIC, header, offsets.astype("<u8").tobytes(), starts.tobytes(), *blocks):
                out.write(part)
        files.move(attempt, path)


class Reader:
    """A file of ids: lengths of its documents, and any run of ids by reading only its blocks."""

    def __init__(self, uri: str):
        files, path = file_system(uri)
        self.file = files.open_input_file(path)
        head = self.file.read_at(len(MAGIC) + 24, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{uri} holds no packed ids")
        self.width, self.block = np.frombuffer(head, "<u4", 2, len(MAGIC)).tolist()
        self.n_ids, self.n_docs = np.frombuffer(head, "<u8", 2, len(MAGIC) + 8).tolist()
        n_blocks = -(-self.n_ids // self.block)
        table = self.file.read_at(8 * (n_blocks + self.n_docs + 1), len(head))
        self.offsets = np.frombuffer(table, "<u8", n_blocks)
        self.starts = np.frombuffer(table, "<u8", self.n_docs + 1, 8 * n_blocks).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        out = []
        for k in range(start // self.block, -(-stop // self.block)):
            first = k * self.block
            count = min(self.block, self.n_ids - first)
            data = self.file.read_at(-(-count * self.width // 8), int(self.offsets[k]))
            out.append(unpack(data, self.width, count)[max(0, start - first) : max(0, stop - first)])
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of each document, a few blocks in memory at a time."""
        k = 0
        while k < self.n_docs:
            upto = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + 4 * self.block, side="right")) - 1)
            run = self.ids(int(self.starts[k]), int(self.starts[upto]))
            yield from np.split(run, self.starts[k + 1 : upto] - self.starts[k])
            k = upto


def write_ids(docs: DataFrame, path: str, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2) -> DataFrame:
    """Encode every text, add end_id, and write files of ids under path in ascending order of id.

    Returns the manifest, a row per file: file, n_docs, n_ids, ids (of the documents, in the file's order).
    NULL texts are empty and hold the end id only. NULL ids come first; repeated ids stand
    next to each other, by text. Other columns are ignored. No rows, no files.
    """
    spark = docs.sparkSession
    path = qualified(spark, path)
    kind = docs.schema[id_column].dataType.simpleString()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # The digest splits rows of one id over several tasks.
    ordered = texts.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        width = width_of(max(encode.size, end_id + 1))
        number, names, out = 0, [], _Writer(width)

        def close() -> pa.RecordBatch:
            uri = f"{path}/ids-{TaskContext.get().partitionId():06d}-{number:05d}.bits"
            out.write(uri)
            return pa.RecordBatch.from_arrays(
                [pa.array([uri]), pa.array([len(names)], pa.int64()), pa.array([out.starts[-1]], pa.int64()), pa.array([pa.array(names, id_kind)], pa.list_(id_kind))],
                ["file", "n_docs", "n_ids", "ids"],
            )

        for batch in batches:
            id_kind = batch.column("id").type
            for part in slices(batch, "text"):
                ids, lengths = encode.encode(part.column("text").to_pylist())
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                out.add(ids, lengths + 1)
                names.extend(part.column("id").to_pylist())
                if out.starts[-1] >= FILE_IDS or len(names) >= _FILE_DOCS:
                    yield close()
                    number, names, out = number + 1, [], _Writer(width)
        if names:
            yield close()

    return saved(ordered.select("id", "text").mapInArrow(write, f"file string, n_docs long, n_ids long, ids array<{kind}>"), "manifest")


def read_ids(manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document of the files: id, start (ids of all before it), n_tokens, ids (little-endian 32-bit numbers)."""
    # One row for each file, of many million ids.
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", "n_ids").select("file", F.coalesce(before, F.lit(0)).alias("base"))
    kind = manifest.schema["ids"].dataType.elementType.simpleString()
    each = dealt(manifest.select("file", "ids").join(files, "file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (uri, base) in enumerate(zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True)):
                names, reader, at = batch.column("ids")[k].values, Reader(uri), 0
                held: list[np.ndarray] = []

                def batch_of(held=held, names=names, reader=reader, base=base) -> pa.RecordBatch:
                    stop = at + len(held)
                    start = pa.array(reader.starts[at:stop] + base)
                    return pa.RecordBatch.from_arrays(
                        [names.slice(at, len(held)), start, pa.array([len(x) for x in held], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in held], pa.binary())],
                        [id_column, "start", "n_tokens", "ids"],
                    )

                for ids in reader.documents():
                    held.append(ids)
                    if len(held) >= 2000 or len(ids) > 1_000_000:
                        yield batch_of()
                        at += len(held)
                        held.clear()
                if held:
                    yield batch_of()

    return each.mapInArrow(read, f"{id_column} {kind}, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2) -> DataFrame:
    """Write ids under the scratch folder and report on what the files give back: id, start, n_tokens, ids_crc32."""
    manifest = write_ids(docs, scratch_path(docs.sparkSession, "bits"), vocabulary, id_column, text_column, end_id)
    return read_ids(manifest, id_column).select(id_column, "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

