"""Near-duplicate documents: banded MinHash, sequential Bayesian verification, exact check.

Documents with one and the same shingle set form a class first, so copies never
meet as pairs. Classes that share a band are candidates. Their signatures are
compared a batch of hashes at a time; with a uniform prior, m matches in n hashes
leave a similarity of at least t with the probability that n + 1 draws of chance
t succeed at most m times, and a pair goes once that is below the chosen miss
probability. Survivors are decided on their full shingle sets.

A band may hold any number of classes. First each member is compared with the
band's smallest id only, which links the bulk of a large group in as many
comparisons as it has members. Components are formed of the links found. Where a
band still holds several components, the members outside its largest one are
compared with all members of other components, in blocks that tasks share out
and arrays compare; only links leave a block. So every two classes of a band are
either compared or known to be connected.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.components import components
from formline.llm.words import hash_runs, hash_words, split_words, text_key, text_slices
from formline.session import reliable_checkpoint

BATCH = 25


@lru_cache
def least_matches(n: int, percent: int, miss: float) -> int:
    """The fewest matches in n hashes with which a similarity of percent / 100 is likelier than ``miss``."""
    t, total = percent / 100, 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= miss:
            return m
    return n + 1


def posterior_passes(one, many, percent: int, miss: float, batch: int = BATCH):
    """Places in ``many`` (rows of hashes) that stay possible partners of ``one`` after all batches."""
    import numpy as np

    at, matches = np.arange(len(many)), np.zeros(len(many), np.int64)
    for n in range(batch, many.shape[1] + 1, batch):
        matches = matches + (many[at, n - batch : n] == one[n - batch : n]).sum(axis=1)
        stay = matches >= least_matches(n, percent, miss)
        at, matches = at[stay], matches[stay]
        if not len(at):
            break
    return at


def _linked(x, y, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    import numpy as np

    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def shingle_sets(texts, size: int):
    """For each text the sorted distinct hashes of its shingles; a shorter text is one shingle, no words none."""
    import numpy as np
    import pyarrow.compute as pc

    words, offsets = split_words(texts)
    (hashes,) = hash_words(pc.ascii_lower(words), ("formline-shingle",))
    runs = hash_runs(hashes, size)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= size:
            x = np.sort(runs[a : b - size + 1])
            sets.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            sets.append(hash_runs(hashes[a:b], b - a) if b > a else hashes[:0])
    return sets


def signatures(sets, hashes: int, seed: int = 7):
    """Rows of 32-bit minima, one for each set; sets may not be empty."""
    import numpy as np

    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 2**31, hashes, np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 2**32, hashes, np.uint32)
    every = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), hashes), np.uint32)
    moved = np.empty_like(every)
    for k in range(hashes):
        np.multiply(every, factors[k], out=moved)
        np.add(moved, shifts[k], out=moved)
        out[:, k] = np.minimum.reduceat(moved, starts)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, size: int = 5, bands: int = 25,
    rows: int = 5, miss: float = 1e-6, block: int = 1024,
) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id, kept``.

    Words are lower-cased in A-Z. A document's set holds its distinct shingles of
    ``size`` words; fewer words are one shingle; null or empty texts have none and
    are linked with nothing. Two documents are linked when the intersection is at
    least ``percent`` of the union; component_id is the smallest id reachable, and
    that document is kept. With the default bands a pair of just 85 % shares no
    band with a chance of 4e-7 (80 %: 5e-5), and ``miss`` bounds what each look at
    the signatures may lose.

    Rows with a null id are linked through their text to others' classes, but name
    no component; such a row without a named class has a null component_id and is
    kept. Rows that repeat an id count as one document. No rows give no rows.
    """
    hashes = bands * rows
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sketch(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa
        from pandas.util import hash_array

        for part in text_slices(batches):
            sets = shingle_sets(part["text"], size)
            full = [i for i, s in enumerate(sets) if len(s)]
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            keys = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            cells = [None] * len(sets)
            if full:
                rows_ = signatures([sets[i] for i in full], hashes)
                mixed = np.zeros((len(full), bands), np.uint64)
                for k in range(rows):
                    mixed = hash_array((mixed * np.uint64(31) + rows_[:, k::rows]).ravel(), categorize=False).reshape(mixed.shape)
                for i, row in zip(full, mixed.view(np.int64), strict=True):
                    cells[i] = row
            yield pa.RecordBatch.from_arrays(
                [part["id"], pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                ["id", "k1", "k2", "n", "bands"],
            )

    sketches = reliable_checkpoint(own.mapInArrow(sketch, f"id {kind}, k1 long, k2 long, n long, bands array<long>"))
    classes = sketches.filter("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    banded = (
        sketches.filter("n > 0").join(classes, ["k1", "k2"]).filter("id = rep").dropDuplicates(["k1", "k2"])
        .select("rep", F.posexplode("bands").alias("band", "hash"))
    )
    heads = banded.groupBy("band", "hash").agg(F.min("rep").alias("head"), F.max("rep").alias("last")).filter("head <> last").drop("last")
    members = reliable_checkpoint(banded.join(heads, ["band", "hash"]))

    def node(batches):
        import pyarrow as pa

        for part in text_slices(batches):
            sets = shingle_sets(part["text"], size)
            full = [i for i, s in enumerate(sets) if len(s)]
            if full:
                rows_ = signatures([sets[i] for i in full], hashes)
                yield pa.RecordBatch.from_arrays(
                    [part["id"].take(pa.array(full)), pa.array([r.tobytes() for r in rows_]), pa.array([sets[i].tobytes() for i in full])],
                    ["id", "sig", "set"],
                )

    wanted = members.select(F.col("rep").alias("id")).distinct()
    nodes = reliable_checkpoint(own.join(wanted, "id", "left_semi").mapInArrow(node, f"id {kind}, sig binary, set binary"))

    def verify(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            good = []
            columns = [batch[c].to_pylist() for c in ("sig_a", "sig_b", "set_a", "set_b")]
            for i, (sa, sb, x, y) in enumerate(zip(*columns, strict=True)):
                one, other = np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32).reshape(1, -1)
                if len(posterior_passes(one, other, percent, miss)) and _linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([batch["a"].take(pa.array(good, pa.int64())), batch["b"].take(pa.array(good, pa.int64()))], ["a", "b"])

    pairs = members.filter("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct()
    ends = pairs.join(nodes.toDF("b", "sig_b", "set_b"), "b").join(nodes.toDF("a", "sig_a", "set_a"), "a")
    stars = reliable_checkpoint(ends.mapInArrow(verify, f"a {kind}, b {kind}"))
    found = reliable_checkpoint(components(stars))

    grouped = members.join(found.toDF("rep", "component"), "rep", "left").select(
        "band", "hash", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = (
        grouped.groupBy("band", "hash", "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("band", "hash").agg(F.max(F.struct("n", "component")).alias("major"), F.sum("n").alias("m"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select(
            "band", "hash", F.col("major.component").alias("major"), F.ceil(F.col("m") / block).cast("int").alias("all_blocks"),
            F.ceil((F.col("m") - F.col("major.n")) / block).cast("int").alias("rest_blocks"),
        )
    )
    open_ = grouped.join(mixed, ["band", "hash"])
    everyone = open_.select(
        "band", "hash", "rep", "component", F.lit(0).alias("side"), F.pmod(F.xxhash64("rep"), "all_blocks").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("rest_blocks") - 1)).alias("j"),
    )
    rest = open_.filter("component <> major").select(
        "band", "hash", "rep", "component", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("i"),
        F.pmod(F.xxhash64("rep"), "rest_blocks").cast("int").alias("j"),
    )
    units = everyone.unionByName(rest).join(nodes.withColumnRenamed("id", "rep"), "rep")

    def compare(table):
        import numpy as np
        import pyarrow as pa

        side, band = table["side"].to_numpy(), table["band"][0].as_py()
        sigs = np.stack([np.frombuffer(x, np.uint32) for x in table["sig"].to_pylist()])
        sets = [np.frombuffer(x, np.uint64) for x in table["set"].to_pylist()]
        ids, parts = table["rep"].to_pylist(), table["component"].to_pylist()
        root = {p: p for p in parts}

        def top(p):
            while root[p] != p:
                root[p] = root[root[p]]
                p = root[p]
            return p

        there, links = np.flatnonzero(side == 0), []
        theirs = sigs[there]
        cut = theirs[:, : band * rows].reshape(len(there), band, rows)
        for s in np.flatnonzero(side == 1):
            near = posterior_passes(sigs[s], theirs, percent, miss)
            # Pairs that an earlier band brings together are compared there.
            near = near[~(cut[near] == sigs[s, : band * rows].reshape(band, rows)).all(axis=2).any(axis=1)]
            for p in there[near]:
                if top(parts[s]) != top(parts[p]) and _linked(sets[s], sets[p], percent):
                    root[top(parts[s])] = top(parts[p])
                    links.append((ids[s], ids[p]))
        column = table.schema.field("rep").type
        return pa.table({"a": pa.array([x for x, _ in links], column), "b": pa.array([y for _, y in links], column)})

    more = units.groupBy("band", "hash", "i", "j").applyInArrow(compare, f"a {kind}, b {kind}")
    # The components known are stars already.
    named = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    smallest = classes.join(named.withColumnRenamed("id", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component_id")
    )
    return (
        sketches.drop("bands").join(smallest, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.col("component_id").isNull()))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, **options) -> DataFrame:
    """The documents, all columns, of which one of each group stays: the one with the smallest id.

    Rows with a null id can't be named by a group and all stay. Of rows that repeat
    id and text one stays.
    """
    kept = near_duplicates(docs, id_col, text_col, percent, **options).filter("kept").select(F.col(id_col).alias("__id")).distinct()
    keyed = docs.withColumn("__id", F.col(id_col)).withColumn("__key", text_key(F.col(text_col)))
    named = keyed.filter(F.col("__id").isNotNull()).dropDuplicates(["__id", "__key"]).join(kept, "__id", "left_semi")
    bare = keyed.filter(F.col("__id").isNull())
    return named.unionByName(bare).select(*docs.columns)
