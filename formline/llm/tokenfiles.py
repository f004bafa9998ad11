"""Token ids in binary shards that can be searched as they lie: a wavelet matrix in each file.

A shard holds the ids of some documents in a row. Its ids, numbered by the ranks of
those that occur, are dealt into bit-planes; a plane is kept as compressed blocks of
2^18 bits with the number of ones before each. So the id at a place, how often an
id occurs and where are answered from the blocks on the way, one to a plane, and
the sequence as a whole by undoing the deals.

File: MAGIC, sections (zstd), footer (zstd JSON), its stored and plain length (two
64-bit integers), MAGIC. A section is named in the footer by place, stored length
and plain length.

A dataset is a folder of shards and a table of them, ``shards``, written by Spark:
only the files that a committed task named are read, so tasks may be repeated.
"""

from __future__ import annotations

import json
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formline.llm.tokens import encoder
from formline.llm.warc import file_system
from formline.llm.wavelet import WORD, Plane, WaveletMatrix
from formline.llm.words import text_slices

MAGIC = b"FLTOKWM1"
BLOCK_WORDS = (1 << 18) // WORD
MOST_TASKS = 20_000
SHARDS = "part int, number int, file string, docs long, tokens long"


def pack(doc_ids, lengths, ids) -> bytes:
    """One shard: an Arrow array of document ids, the tokens of each, and all token ids."""
    import numpy as np
    import pyarrow as pa

    out, at = [MAGIC], len(MAGIC)
    codec = pa.Codec("zstd")

    def section(data) -> list[int]:
        nonlocal at
        raw = bytes(data)
        out.append(codec.compress(raw, asbytes=True))
        at += len(out[-1])
        return [at - len(out[-1]), len(out[-1]), len(raw)]

    used = np.flatnonzero(np.bincount(ids, minlength=1)).astype("<u4")
    number = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.uint16 if len(used) <= 1 << 16 else np.uint32)
    number[used] = np.arange(len(used))
    matrix = WaveletMatrix.of(number[ids], len(used))
    planes = []
    for plane in matrix.planes:
        words = plane.words.astype("<u8", copy=False)
        blocks = [section(words[i : i + BLOCK_WORDS].tobytes()) for i in range(0, len(words), BLOCK_WORDS)]
        planes.append({"blocks": blocks, "before": section(plane.before[:-1:BLOCK_WORDS].astype("<i8").tobytes()), "ones": plane.ones})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("id", doc_ids.type), ("n", pa.int64())])) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(np.asarray(lengths, np.int64))], ["id", "n"]))
    footer = {"tokens": len(ids), "used": section(used.tobytes()), "docs": section(sink.getvalue()), "planes": planes}
    raw = json.dumps(footer).encode()
    tail = codec.compress(raw, asbytes=True)
    return b"".join([*out, tail, struct.pack("<QQ", len(tail), len(raw)), MAGIC])


class FilePlane(Plane):
    """A plane whose blocks are read when they are asked for; the last few are kept."""

    def __init__(self, shard: TokenFile, spec: dict, length: int):
        import numpy as np

        self.shard, self.spec, self.length = shard, spec, length
        self.first = np.frombuffer(shard.section(spec["before"]), "<i8")
        self.ones, self.zeros = spec["ones"], length - spec["ones"]
        self.held: dict[int, Plane] = {}

    def block(self, k: int) -> Plane:
        import numpy as np

        if k not in self.held:
            if len(self.held) >= 4:
                self.held.pop(next(iter(self.held)))
            words = np.frombuffer(self.shard.section(self.spec["blocks"][k]), "<u8")
            self.held[k] = Plane(words, min(self.length - k * BLOCK_WORDS * WORD, len(words) * WORD))
        return self.held[k]

    def bits(self):
        import numpy as np

        words = np.concatenate([np.frombuffer(self.shard.section(b), "<u8") for b in self.spec["blocks"]])
        return np.unpackbits(words.view(np.uint8), count=self.length, bitorder="little").view(bool)

    def _by_block(self, places, answer, kind):
        import numpy as np

        blocks = places // (BLOCK_WORDS * WORD)
        out = np.empty(len(places), kind)
        for k in np.unique(blocks).tolist():
            mine = np.flatnonzero(blocks == k)
            out[mine] = answer(k, self.block(k), places[mine] - k * BLOCK_WORDS * WORD)
        return out

    def at(self, places):
        return self._by_block(places, lambda k, block, p: block.at(p), bool)

    def rank(self, places):
        import numpy as np

        return self._by_block(places, lambda k, block, p: self.first[k] + block.rank(p), np.int64)

    def select(self, ranks, bit: int):
        import numpy as np

        ranks = np.asarray(ranks, np.int64)
        before = self.first if bit else np.arange(len(self.first), dtype=np.int64) * BLOCK_WORDS * WORD - self.first
        blocks = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for k in np.unique(blocks).tolist():
            mine = np.flatnonzero(blocks == k)
            out[mine] = k * BLOCK_WORDS * WORD + self.block(k).select(ranks[mine] - before[k], bit)
        return out


class TokenFile:
    """An open shard (any file with seek and read)."""

    def __init__(self, f):
        import numpy as np
        import pyarrow as pa

        self.f, self.codec = f, pa.Codec("zstd")
        f.seek(0, 2)
        end = f.tell()
        f.seek(max(0, end - 16 - len(MAGIC)))
        last = f.read()
        if last[16:] != MAGIC:
            raise ValueError("not a token shard, or one that isn't whole")
        stored, raw = struct.unpack("<QQ", last[:16])
        footer = json.loads(self.section([end - 16 - len(MAGIC) - stored, stored, raw]))
        self.length = footer["tokens"]
        self.used = np.frombuffer(self.section(footer["used"]), "<u4")
        docs = pa.ipc.open_stream(self.section(footer["docs"])).read_all()
        self.doc_ids, self.lengths = docs["id"].combine_chunks(), docs["n"].to_numpy()
        self.ends = np.cumsum(self.lengths)
        self.matrix = WaveletMatrix([FilePlane(self, p, self.length) for p in footer["planes"]], self.length)

    def section(self, where: list[int]) -> bytes:
        at, stored, raw = where
        self.f.seek(at)
        return self.codec.decompress(self.f.read(stored), raw, asbytes=True)

    def all(self):
        """Every token id, in order."""
        import numpy as np

        kind = np.uint16 if len(self.used) <= 1 << 16 else np.uint32
        return self.used[self.matrix.codes(kind)] if self.length else np.zeros(0, "<u4")

    def tokens(self, places):
        return self.used[self.matrix.access(places)]

    def document(self, k: int):
        """The token ids of the k-th document."""
        import numpy as np

        return self.tokens(np.arange(self.ends[k] - self.lengths[k], self.ends[k], dtype=np.int64))

    def _code(self, token: int) -> int | None:
        import numpy as np

        k = int(np.searchsorted(self.used, token))
        return k if k < len(self.used) and self.used[k] == token else None

    def count(self, token: int) -> int:
        code = self._code(token)
        return 0 if code is None else self.matrix.count(code)

    def find(self, token: int):
        """``(documents, places)`` of every occurrence: numbers of documents in the shard, places in them."""
        import numpy as np

        code = self._code(token)
        found = np.zeros(0, np.int64) if code is None else self.matrix.find(code)
        doc = np.searchsorted(self.ends, found, side="right")
        return doc, found - (self.ends - self.lengths)[doc]


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text",
    shard_tokens: int = 4_000_000, slice_bytes: int = 8 << 20,
) -> None:
    """Encode every whole text and write its ids, in ascending order of the ids of the documents, as shards below ``path``.

    ``tokenizer`` is a file of the tokenizers library; it is read by the driver and
    sent to the tasks (a file of a few megabytes, whatever the corpus). Special
    tokens are not added; ``end_id`` is appended to every document. A null text has
    no ids but that one. Rows with a null id come first; rows that share an id are
    ordered by a hash of their texts, then as they are read. A shard is ended after
    ``shard_tokens`` ids; a document lies in one shard. Tasks are ranges of rows,
    so an id on many rows is spread over several.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        held = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text"), "__at"]
    ranged = rows.withColumn("__at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("__at")
    root = path.rstrip("/")

    def write(batches):
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encode, part = encoder(held.value), TaskContext.get().partitionId()
        system, folder = file_system(root)
        system.create_dir(folder, recursive=True)
        waiting, size, number = [], 0, 0

        def shard():
            keys, lengths, ids = (list(x) for x in zip(*waiting, strict=True))
            name = f"{part:06d}-{number:05d}-{uuid.uuid4().hex}.tokens"
            lengths, ids = np.concatenate(lengths), np.concatenate(ids)
            with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
                out.write(pack(pa.concat_arrays(keys), lengths, ids))
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "file": name, "docs": len(lengths), "tokens": len(ids)}], schema)

        schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])
        for batch in text_slices(batches, size=slice_bytes):
            ids, ends = encode.encode(batch["text"])
            lengths = np.diff(ends, prepend=0)
            if end_id is not None:
                closing = ends + np.arange(len(ends))
                inner = np.ones(len(ids) + len(ends), bool)
                inner[closing] = False
                with_ends = np.full(len(inner), end_id, np.promote_types(ids.dtype, np.min_scalar_type(end_id)))
                with_ends[np.flatnonzero(inner)] = ids
                ids, lengths = with_ends, lengths + 1
            waiting.append((batch["id"], lengths, ids))
            size += len(ids)
            if size >= shard_tokens:
                yield shard()
                waiting, size, number = [], 0, number + 1
        if waiting:
            yield shard()

    ranged.mapInArrow(write, SHARDS).write.mode("errorifexists").parquet(f"{root}/shards")


def shards_of(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard: ``part, number, file, docs, tokens, start``, ``start`` the ids of all shards before it."""
    table = spark.read.schema(SHARDS).parquet(f"{path.rstrip('/')}/shards")
    parts = table.groupBy("part").agg(F.sum("tokens").alias("__sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task of the writer
    parts = parts.select("part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return table.join(parts, "part").withColumn("start", start).drop("__before")


def _over_shards(spark: SparkSession, path: str, read, schema: str) -> DataFrame:
    """``read(open shard, start)`` of every shard; about as many tasks as shards, since a shard is megabytes though its row is small."""
    root = path.rstrip("/")
    shards = shards_of(spark, root).select("file", "start")
    tasks = max(1, min(spark.read.schema(SHARDS).parquet(f"{root}/shards").count(), MOST_TASKS))

    def each(batches):
        system, folder = file_system(root)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{folder}/{row['file']}") as f:
                    yield from read(TokenFile(f), row["start"])

    return shards.repartition(tasks, "file").mapInArrow(each, schema)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: str = "long", batch_tokens: int = 1 << 20) -> DataFrame:
    """A row per document: ``id, start, n_tokens, ids``; ``ids`` are little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it. A folder without shards
    gives no rows.
    """

    def read(shard, start):
        import numpy as np
        import pyarrow as pa

        ids, ends, first = shard.all().astype("<u4", copy=False), shard.ends, 0
        while first < len(ends):
            begin = int(ends[first] - shard.lengths[first])
            upto = max(first + 1, int(np.searchsorted(ends, begin + batch_tokens, side="right")))
            lengths, last = shard.lengths[first:upto], int(ends[upto - 1])
            offsets = np.concatenate([[0], np.cumsum(lengths)]) * 4
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(ids[begin:last])])
            starts = pa.array(start + begin + offsets[:-1] // 4)
            yield pa.RecordBatch.from_arrays([shard.doc_ids.slice(first, upto - first), starts, pa.array(lengths), data.cast(pa.binary())], ["id", "start", "n_tokens", "ids"])
            first = upto

    return _over_shards(spark, path, read, f"id {id_type}, start long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def find_token(spark: SparkSession, path: str, token: int, id_col: str = "doc_id", id_type: str = "long") -> DataFrame:
    """A row per document that holds the id: ``id, n, places`` (rising, from 0). Only the blocks on the way are read."""

    def read(shard, start):
        import numpy as np
        import pyarrow as pa

        docs, places = shard.find(token)
        held, first, many = np.unique(docs, return_index=True, return_counts=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(docs)).astype(np.int32)), pa.array(places))
        yield pa.RecordBatch.from_arrays([shard.doc_ids.take(pa.array(held)), pa.array(many.astype(np.int64)), lists], ["id", "n", "places"])

    return _over_shards(spark, path, read, f"id {id_type}, n long, places array<long>").withColumnRenamed("id", id_col)


def token_counts(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """``token, n`` over the whole dataset for the ids named."""

    def read(shard, start):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array([shard.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return _over_shards(spark, path, read, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
