"""Token-id files: frequency-ranked ids, byte-aligned, with control bytes apart.

Three steps, each of which can be repeated if an executor is lost:

1. the documents are range-sorted by id, encoded, and kept as raw ids in a table
   of blocks in the shared folder (:func:`encode`);
2. ids are counted over all documents and ranked by frequency, so that frequent
   ids become small numbers; the rank table has one row a vocabulary entry;
3. every block is coded (:func:`write`): ranks of 1 to 4 bytes, two control bits
   each (their length less one), all control bytes before all data bytes. A file
   holds the blocks of one task, ``FILE_BLOCKS`` at most.

:func:`read` reads the files back with Spark's binary reader and decodes them by
numpy table lookup: a control byte looks up the lengths and places of 4 values.

Block: magic, then little-endian uint64 fields (documents, ids, bytes of control,
bytes of data, ids of all documents before it), int64 doc ids, uint8 flags (1: the id is null), int64 lengths,
control, data; a line break follows. Blocks hold ascending doc ids, and their starts order them.

Every document's ids end with ``end_id``. Defined cases: a null text is empty
and has the end id only; texts of any length are encoded whole; rows of equal id are all
written, side by side, in the order of their texts' hashes; null
ids come first. An empty table gives no blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.byte_bpe import Encoder
from skein.llm.scratch import cleared, new_path, written
from skein.llm.textarrays import slices
from skein.llm.workers import hold, map_batches, tidy, trim

MAGIC = b"SKTOKEN2"
#: Ids of a block (or those of one slice of texts beyond), and blocks of a file: about 50 MB.
BLOCK_TOKENS, FILE_BLOCKS = 2_000_000, 16
#: Bytes of text encoded at once, or one text.
SLICE = 2 << 20


# -- the number coding ------------------------------------------------------


#: Values that are coded at once (a multiple of 4), so that the work stays in the processor's caches.
BLOCK = 1 << 17


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    parts = [_pack(values[k : k + BLOCK]) for k in range(0, len(values), BLOCK)]
    return b"".join(c for c, _ in parts), b"".join(d for _, d in parts)


def _pack(values: np.ndarray) -> tuple[bytes, bytes]:
    v = values.astype("<u4", copy=False)
    code = (v > 0xFF).astype(np.uint8)
    code += v > 0xFFFF
    code += v > 0xFFFFFF
    padded = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    padded[: len(v)] = code
    q = padded.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    width = int(code.max(initial=0)) + 1
    used = np.arange(width, dtype=np.uint8)[None, :] <= code[:, None]
    return control.tobytes(), np.ascontiguousarray(v).view(np.uint8).reshape(-1, 4)[:, :width][used].tobytes()


def _tables() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    size = np.stack([(byte >> 2 * k & 3) + 1 for k in range(4)], axis=1)
    return size.astype(np.uint8), (np.cumsum(size, axis=1) - size).astype(np.int64), size.sum(axis=1)


#: By control byte: the lengths of its 4 values, where each begins among their bytes, and all their bytes.
SIZE, PLACE, TOTAL = _tables()


def unpack(control, data, n: int) -> np.ndarray:
    """The ``n`` values that :func:`pack` coded."""
    out = np.empty(n, np.uint32)
    c, d = np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8)
    begin = 0
    for k in range(0, n, BLOCK):
        m = min(BLOCK, n - k)
        codes = c[k // 4 : (k + m + 3) // 4]
        total = TOTAL[codes]
        ends = np.cumsum(total)
        at = ((ends - total + begin)[:, None] + PLACE[codes]).reshape(-1)[:m]
        size = SIZE[codes].reshape(-1)[:m]
        v = d[at].astype(np.uint32)
        for b in range(1, int(size.max())):
            more = np.flatnonzero(size > b)
            v[more] |= d[at[more] + b].astype(np.uint32) << np.uint32(8 * b)
        out[k : k + m] = v
        begin += int(size.sum(dtype=np.int64))
    return out


# -- the steps ----------------------------------------------------------------

_SHARDS = "part int, inner long, n_docs long, n_tokens long, doc_ids binary, nulls binary, counts binary, ids binary, seen array<int>, seen_n array<long>"


def encoder(path: str) -> Encoder:
    return hold(("encoder", path), lambda: Encoder(path))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with ``end_id`` after each."""
    counts = counts + 1
    out = np.full(int(counts.sum()), end_id, np.uint16)
    own = np.ones(len(out), bool)
    own[np.cumsum(counts) - 1] = False
    out[own] = ids
    return out, counts


def encode(docs: DataFrame, tokenizer: str, end_id: int = 0, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw ids in ascending doc_id order; ``part`` and ``inner``, the ids of its part before it, order them."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    names = [x.split()[0] for x in _SHARDS.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 4, pa.list_(pa.int32()), pa.list_(pa.int64())]

    # sorted as text, which the shuffle compresses better than ids; the hash deals out rows of one id (or of none)
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        held: list[tuple] = []
        number, size, inner = 0, 0, 0

        def block() -> pa.RecordBatch:
            doc_ids, nulls, counts, ids = (np.concatenate(x) for x in zip(*held))
            total = np.zeros(1 << 16, np.int64)
            for k in range(0, len(ids), BLOCK):
                total += np.bincount(ids[k : k + BLOCK], minlength=1 << 16)
            seen = np.flatnonzero(total)
            row = [number, inner, len(counts), len(ids), *(x.tobytes() for x in (doc_ids, nulls, counts, ids)), seen, total[seen]]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in batches:
            for part in slices(batch, limit=SLICE):
                number = part.column(2)[0].as_py()
                doc = part.column(0)
                ids, counts = with_end(*model.encode(part.column(1)), end_id)
                nulls = doc.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
                held.append((doc.fill_null(0).to_numpy().astype("<i8"), nulls, counts.astype("<i8"), ids.astype("<u2")))
                size += len(ids)
                if size >= block_tokens:
                    yield block()
                    held, size, inner = [], 0, inner + size
        if held:
            yield block()
        trim()

    return written(ordered.transform(map_batches, to_blocks, _SHARDS), "token-blocks", "snappy")


def ranks(blocks: DataFrame) -> list[int]:
    """Ids by falling frequency over all documents (ties: by id); one entry for each id that occurs."""

    pairs = blocks.select(F.explode(F.arrays_zip("seen", "seen_n")).alias("x")).select(F.col("x.seen").alias("id"), F.col("x.seen_n").alias("n"))
    rows = pairs.groupBy("id").agg(F.sum("n").alias("n")).collect()
    return [r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))]


def write(blocks: DataFrame, table: list[int], path: str) -> None:
    """Files of up to ``FILE_BLOCKS`` blocks in ``path/blocks``, and the rank table in ``path/ranks``."""
    spark = blocks.sparkSession
    spark.createDataFrame([(k, i) for k, i in enumerate(table)], "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    to_rank = np.zeros(1 << 16, np.uint32)
    to_rank[np.array(table, np.int64)] = np.arange(len(table), dtype=np.uint32)
    # one row a shuffle partition
    sizes = sorted((r.part, r.n) for r in blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    begins, before = {}, 0
    for part, n in sizes:
        begins[part], before = before, before + n
    shared = spark.sparkContext.broadcast((to_rank, begins))  # at most 65,536 entries, and a number a partition

    @tidy
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, begin = shared.value
        for batch in batches:
            for r in batch.to_pylist():
                ids = rank[np.frombuffer(r["ids"], "<u2")]
                control, data = pack(ids)
                head = np.array([r["n_docs"], len(ids), len(control), len(data), begin[r["part"]] + r["inner"]], "<u8").tobytes()
                blob = b"".join([MAGIC, head, r["doc_ids"], r["nulls"], r["counts"], control, data])
                yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["value"])

    # Spark's text writer puts down the bytes of a column as they are (a cast of binary changes and checks
    # none), a line break after each row, on any file system and with its commit protocol: a task that is
    # run twice leaves one file
    files = blocks.select("part", "inner", "n_docs", "doc_ids", "nulls", "counts", "ids").transform(map_batches, code, "value binary")
    text = files.select(F.col("value").cast("string")).write.option("compression", "none").option("maxRecordsPerFile", FILE_BLOCKS)
    text.text(f"{path}/blocks")


def decode(blob, table: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block of a file: its first id's number, doc ids, null flags, lengths, and ids."""
    at, view = 0, memoryview(blob)
    while at < len(view):
        if view[at : at + 8] != MAGIC:
            raise ValueError("not a token file")
        n, m, c, d, start = map(int, np.frombuffer(view, "<u8", 5, at + 8))
        at += 48
        doc_ids = np.frombuffer(view, "<i8", n, at)
        nulls = np.frombuffer(view, np.uint8, n, at + 8 * n)
        counts = np.frombuffer(view, "<i8", n, at + 9 * n)
        at += 17 * n
        yield start, doc_ids, nulls, counts, table[unpack(view[at : at + c], view[at + c : at + c + d], m)]
        at += c + d + 1  # the line break


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, one row a document: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. Each file is read once and on its own.
    """
    table = np.zeros(1 << 16, np.uint32)
    for r in spark.read.parquet(f"{path}/ranks").collect():  # one row a vocabulary entry
        table[r["rank"]] = r["id"]
    shared = spark.sparkContext.broadcast(table)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0):
                for start, doc_ids, nulls, counts, ids in decode(blob.as_buffer(), shared.value):
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    ends = np.cumsum(counts)
                    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(counts.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, mask=nulls.astype(bool)), pa.array(ends - counts + start), pa.array(counts), pa.array(crc, pa.int64())],
                        names=[x.split()[0] for x in _READ.split(", ")],
                    )

    return spark.read.format("binaryFile").load(f"{path}/blocks").select("content").transform(map_batches, run, _READ)


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 0) -> str:
    """Encode ``docs`` and write the files; returns where they are."""
    path = path or new_path(docs.sparkSession, "token-files")
    with cleared(docs.sparkSession):
        blocks = encode(docs, tokenizer, end_id)
        write(blocks, ranks(blocks), path)
    return path
