"""Top-k rows by cosine similarity to query vectors: exactly, or through an index of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formline.operators.streaks import newest_rows
from formline.sources.tables import overwrite

QUERY_BLOCK = 500
ITEM_BLOCK = 4_096
#: Vectors that a packing task holds for blocks not yet full; beyond it the largest block goes as it is.
HELD_BYTES = 8 << 20
#: Queries of a block scored at a time, and rows dealt to cells at a time.
SCORED_ROWS = 64
DEALT_ROWS = 512
#: Packed queries up to this many bytes are sent to the items; more of them are lanes of that size.
SENT_BYTES = 64 << 20
#: With several lanes, item blocks are dealt into so many parts, and each lane is joined with each part.
PARTS = 64


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two array columns, null for a zero vector."""
    def dot(x, y):
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _reader():
    """A function, sent to the workers as it is, that gives a column of lists as lengths, places of the first numbers, and all numbers.

    Missing lists and lists with a null have length 0.
    """
    def numbers(column):
        import numpy as np

        values = column.values
        offsets = column.offsets.to_numpy().astype(np.int64)
        nulls = np.concatenate([[0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
        whole = column.is_valid().to_numpy(zero_copy_only=False) & (nulls[offsets[1:]] == nulls[offsets[:-1]])
        return np.where(whole, np.diff(offsets), 0), offsets[:-1], values.to_numpy(zero_copy_only=False)

    return numbers


def _packed(df: DataFrame, key: str, vector: str, size: int, cell: Sequence[str] = (), name: str = "x") -> DataFrame:
    """Rows as blocks of about ``size``: ids and vectors side by side, none of them over cells.

    A block is made inside a task, from rows as they come, so nothing is gathered
    by key; vectors with a null in them count as missing. Rows waiting for a full
    block are numbers in arrays, HELD_BYTES of them at most.
    """
    kind = df.schema[key].dataType
    fields = [T.StructField(c, df.schema[c].dataType) for c in cell]
    schema = T.StructType([*fields, T.StructField(f"{name}_ids", T.ArrayType(kind)), T.StructField(f"{name}_vectors", T.BinaryType()), T.StructField(f"{name}_width", T.IntegerType())])

    numbers = _reader()

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        waiting: dict = {}
        held, arrow = 0, None

        def block(at):
            nonlocal held
            ids, vectors = waiting.pop(at)
            held -= sum(v.nbytes for v in vectors)
            ids, data = pa.concat_arrays(ids), b"".join(v.tobytes() for v in vectors)
            lists = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            row = [*(pa.array([c], t) for c, t in zip(at[1:], kinds, strict=True)), lists, pa.array([data], pa.binary()), pa.array([at[0]], pa.int32())]
            return pa.RecordBatch.from_arrays(row, schema=arrow)

        for batch in batches:
            if arrow is None:
                kinds = [batch.schema.field(c).type for c in cell]
                arrow = pa.schema([*zip(cell, kinds, strict=True), (f"{name}_ids", pa.list_(batch.schema.field("_id").type)), (f"{name}_vectors", pa.binary()), (f"{name}_width", pa.int32())])
            widths, starts, values = numbers(batch["_v"])
            groups: dict = {}
            for r, at in enumerate(zip(widths.tolist(), *(batch[c].to_pylist() for c in cell), strict=True)):
                groups.setdefault(at, []).append(r)
            for at, rows in groups.items():
                while rows:
                    ids, vectors = waiting.setdefault(at, ([], []))
                    taken = np.array(rows[: size - sum(map(len, ids))])
                    rows = rows[len(taken) :]
                    ids.append(batch["_id"].take(pa.array(taken)))
                    vectors.append(values[starts[taken][:, None] + np.arange(at[0])])
                    held += vectors[-1].nbytes
                    if sum(map(len, ids)) >= size:
                        yield block(at)
                while held > HELD_BYTES:
                    yield block(max(waiting, key=lambda x: sum(v.nbytes for v in waiting[x][1])))
        for at in list(waiting):
            yield block(at)

    return df.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), *cell).mapInArrow(pack, schema)


def _scored(pairs: DataFrame, query_id: str, item_id: str, query_type, item_type, k: int, alias: str, digits: int | None) -> DataFrame:
    """The k best items of each query within each pair of blocks, ties by item id."""
    schema = T.StructType([T.StructField(query_id, query_type), T.StructField(item_id, item_type), T.StructField(alias, T.DoubleType())])

    def unit(data, width: int):
        import numpy as np

        x = np.frombuffer(data, "<f8").reshape(-1, width)
        with np.errstate(invalid="ignore", divide="ignore"):
            return x / np.sqrt((x * x).sum(axis=1))[:, None]

    def meet(pair):
        """Some queries of a block at a time against a block of items."""
        import numpy as np
        import pyarrow as pa

        asked, ids, width = pair["q_ids"][0].values, pair["i_ids"][0].values, pair["q_width"][0].as_py()
        names = ids.to_pylist()
        order = np.array(sorted(range(len(names)), key=lambda j: (0,) if names[j] is None else (1, names[j])))
        alike = width and width == pair["i_width"][0].as_py()
        if alike:
            queries, items = unit(pair["q_vectors"][0].as_buffer(), width), unit(pair["i_vectors"][0].as_buffer(), width)[order].T
        for at in range(0, len(asked), SCORED_ROWS):
            rows = np.arange(at, min(len(asked), at + SCORED_ROWS))
            # of different lengths, or missing: no similarity
            found = queries[rows] @ items if alike else np.full((len(rows), len(ids)), np.nan)
            if digits is not None:
                found = np.copysign(np.floor(np.abs(found) * 10**digits + 0.5) / 10**digits, found)
            best = np.argsort(np.where(np.isnan(found), np.inf, -found), axis=1, kind="stable")[:, :k]
            values = np.take_along_axis(found, best, 1).ravel()
            yield pa.RecordBatch.from_arrays(
                [asked.take(pa.array(np.repeat(rows, best.shape[1]))), ids.take(pa.array(order[best.ravel()])), pa.array(values, mask=np.isnan(values))],
                [query_id, item_id, alias],
            )

    def score(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                yield from meet(batch.slice(r, 1))
            del batch  # before the next one is read

    return pairs.mapInArrow(score, schema)


def vector_top_k(
    df: DataFrame, queries: DataFrame, query_id: str, query_vector: str, item_id: str, vector: str, k: int, alias: str = "similarity",
    digits: int | None = None,
) -> DataFrame:
    """The k most similar items of every query, ties by item id.

    Both sides are packed into blocks and every block of queries meets every block
    of items in one plan that reads the items once: the packed queries are sent to
    the items when they are small (SENT_BYTES, measured); more of them are lanes of
    that size, and lanes and parts of the items meet in a grid. Each pair of blocks is one product of matrices, of
    which only the k best of each query go on. Rows of queries without an id are
    left out; a vector that is zero, missing or of another length has no similarity
    and comes last.
    """
    asked = queries.filter(F.col(query_id).isNotNull())
    q = _packed(asked, query_id, query_vector, QUERY_BLOCK, name="q")
    size = q.agg(F.coalesce(F.sum(F.octet_length("q_vectors")), F.lit(0))).first()[0]
    i = _packed(df, item_id, vector, ITEM_BLOCK, name="i")
    lanes = max(1, -(-size // SENT_BYTES))
    parts = 1 if lanes == 1 else PARTS
    q = q.withColumn("_lane", F.pmod(F.xxhash64("q_ids"), F.lit(lanes)).cast("int")).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    i = i.withColumn("_part", F.pmod(F.xxhash64("i_ids"), F.lit(parts)).cast("int")).withColumn("_lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    pairs = i.join(F.broadcast(q) if lanes == 1 else q, ["_lane", "_part"])
    return _best(_scored(pairs, query_id, item_id, queries.schema[query_id].dataType, df.schema[item_id].dataType, k, alias, digits), query_id, item_id, alias, k)


def _best(scored: DataFrame, query_id: str, item_id: str, alias: str, k: int) -> DataFrame:
    best = newest_rows(scored, [query_id], [F.col(alias).desc_nulls_last(), F.col(item_id)], k, "rank")
    return best.select(query_id, "rank", item_id, alias)


def centroids(df: DataFrame, item_id: str, vector: str, cells: int, sample: int = 20_000, rounds: int = 8):
    """Unit centres of the cells, an array of one row each, by k-means on the directions of a bounded sample.

    The sample holds the ``sample`` vectors with the smallest hash of their id, so
    reruns agree; the first centres are the first of them. Zero and missing vectors
    aren't used.
    """
    import numpy as np

    rows = df.select(F.xxhash64(item_id).alias("_h"), F.col(vector).cast("array<double>").alias("_v")).filter(F.exists("_v", lambda x: x != 0) & F.forall("_v", lambda x: x.isNotNull()))
    data = np.array([r["_v"] for r in rows.orderBy("_h", "_v").limit(sample).collect()])
    if not len(data):
        return np.zeros((0, 1))
    data /= np.linalg.norm(data, axis=1)[:, None]
    centers = data[:cells].copy()
    for _ in range(rounds):
        near = (data @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, data)
        norms = np.linalg.norm(sums, axis=1)
        centers[norms > 0] = sums[norms > 0] / norms[norms > 0][:, None]
    return centers


def _dealt(df: DataFrame, vector: str, centers, many: int) -> DataFrame:
    """Rows with the ``many`` cells whose centres are nearest, one row for each (cell 0 for vectors without a direction)."""
    held = df.sparkSession.sparkContext.broadcast(centers)  # cells x width numbers
    numbers = _reader()

    def deal(batches):
        import numpy as np
        import pyarrow as pa

        center = held.value
        for batch in batches:
            for first in range(0, batch.num_rows, DEALT_ROWS):
                part = batch.slice(first, DEALT_ROWS)
                widths, starts, values = numbers(part[vector])
                near = np.zeros((len(widths), min(many, max(1, len(center)))), np.int32)
                fit = np.flatnonzero(widths == center.shape[1])
                if len(fit) and len(center):
                    vectors = values[starts[fit][:, None] + np.arange(center.shape[1])].astype(float)
                    near[fit] = np.argsort(-(vectors @ center.T), axis=1, kind="stable")[:, : near.shape[1]]
                at = np.repeat(np.arange(len(widths)), near.shape[1])
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in part.columns), pa.array(near.ravel(), pa.int32())], [*part.schema.names, "_cell"])

    return df.mapInArrow(deal, T.StructType([*df.schema.fields, T.StructField("_cell", T.IntegerType())]))


def build_vector_index(df: DataFrame, item_id: str, vector: str, path: str, cells: int = 64, sample: int = 20_000) -> None:
    """Write every item into the cell of its nearest centre: blocks of a cell's items below ``path``/items, the centres beside them.

    Centres are fitted on a bounded sample (``centroids``); all items are indexed.
    Blocks are made by each task and cell, so a crowded cell is many blocks.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    centers = centroids(df, item_id, vector, cells, sample)
    rows = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cell int, center array<double>")
    overwrite(rows, f"{root}/centers")
    dealt = _dealt(df.select(item_id, vector), vector, centers, 1)
    blocks = _packed(dealt, item_id, vector, ITEM_BLOCK, ["_cell"], "i")
    overwrite(spark.createDataFrame([], blocks.schema), f"{root}/schema")  # folders of cells say nothing when there are no items
    overwrite(blocks, f"{root}/items", ["_cell"])


def index_top_k(
    path: str, queries: DataFrame, query_id: str, query_vector: str, item_id: str, k: int, probes: int = 8, alias: str = "similarity",
    digits: int | None = None,
) -> DataFrame:
    """The k most similar items among those in the ``probes`` nearest cells of each query, by an index of ``build_vector_index``.

    Blocks of queries meet blocks of items by cell, in a join that adaptive
    execution can split; of the items only the cells asked for are read. With as
    many probes as cells the rows are those of ``vector_top_k``.
    """
    import numpy as np

    spark, root = queries.sparkSession, path.rstrip("/")
    centers = np.array([r.center for r in spark.read.parquet(f"{root}/centers").orderBy("cell").collect()])
    asked = queries.filter(F.col(query_id).isNotNull()).select(query_id, F.col(query_vector).cast("array<double>").alias("_q"))
    centers = centers if len(centers) else np.zeros((0, 1))
    q = _packed(_dealt(asked, "_q", centers, probes), query_id, "_q", QUERY_BLOCK, ["_cell"], "q")
    items = spark.read.schema(spark.read.parquet(f"{root}/schema").schema).parquet(f"{root}/items")
    pairs = items.join(q, "_cell")
    kind = items.schema["i_ids"].dataType.elementType
    return _best(_scored(pairs, query_id, item_id, queries.schema[query_id].dataType, kind, k, alias, digits), query_id, item_id, alias, k)


def recall(found: DataFrame, exact: DataFrame, query_id: str, item_id: str) -> DataFrame:
    """One row: ``queries``, ``pairs`` (the exact ones), and the share of them that was found."""
    marked = exact.join(found.select(query_id, item_id, F.lit(True).alias("_found")), [query_id, item_id], "left")
    return marked.agg(
        F.count_distinct(query_id).alias("queries"), F.count(F.lit(1)).alias("pairs"), F.try_divide(F.count("_found"), F.count(F.lit(1))).alias("recall")
    )


def mean_vectors(df: DataFrame, keys: Sequence[str], vector: str, alias: str = "centroid") -> DataFrame:
    """Mean vector per key, for query vectors taken from the data."""
    placed = df.select(*keys, F.posexplode(vector).alias("_i", "_x"))
    means = placed.groupBy(*keys, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    ordered = F.sort_array(F.collect_list(F.struct("_i", "_m")))
    return means.groupBy(*keys).agg(F.transform(ordered, lambda s: s["_m"]).alias(alias))
