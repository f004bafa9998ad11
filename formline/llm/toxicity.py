"""Toxicity by class-conditional Kneser-Ney models: of characters, and of expressions, which are runs of one to three words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formline.llm.charlm import CELLS, cells, collected, count_cells, kneser_ney, slices
from formline.llm.net import fit_labelled
from formline.llm.scratch import Scratch
from formline.llm.wordruns import LONGEST, Filter, count_runs, distinct_estimate, parts_of, run_totals, runs_of
from formline.llm.words import text_slices
from formline.session import reliable_checkpoint

SHARED_ORDERS = 2
SAMPLE = 20_000
#: Labels, of an id and two numbers each, that may be sent to every task.
BROADCAST_LABELS = 2_000_000
CLEAR = (1.0, 2.0, 3.5)
#: How clearly an expression must speak, as log P(toxic) - log P(ordinary), and the level of very clear ones.
TELLING = (4.0, 6.0)


def log_ratios(counts: dict):
    """Per cell the logarithm of toxic over ordinary probability; lower orders come from both classes' counts."""
    import numpy as np

    toxic, ordinary = (counts.get(c, np.zeros(CELLS)) for c in ("1", "0"))
    if not toxic.any() or not ordinary.any():
        return np.zeros(CELLS, np.float32)
    both = toxic + ordinary
    p, q = (kneser_ney(n, both, SHARED_ORDERS) for n in (toxic, ordinary))
    return (np.log(p) - np.log(q)).astype(np.float32)


def measures(texts: list[str], ratios):
    """Per text, length-normalised: mean log ratio per symbol, the clearest words, log words, and mean excesses per word.

    The excess of a word is what its log ratio has above a level of CLEAR, so that
    a few plain words in a long text aren't washed out by the many that say nothing.
    """
    import numpy as np

    found, ends = cells(texts)
    out = np.zeros((len(texts), 3 + len(CLEAR)))
    found = found[ends[0] : ends[-1]]
    if not len(found):
        return out
    ends = ends - ends[0]
    logs = ratios[found].astype(np.float64)
    closed = np.flatnonzero(found & 31 == 0)
    words = np.add.reduceat(logs, np.concatenate([[0], closed[:-1] + 1]))
    first = np.searchsorted(closed, ends)
    total = np.concatenate([[0], np.cumsum(logs)])
    n, m = np.diff(ends), np.diff(first)
    out[:, 0] = np.diff(total[ends]) / np.maximum(n, 1)
    out[:, 2] = np.log1p(m)
    for k, level in enumerate(CLEAR):
        excess = np.concatenate([[0], np.cumsum(np.maximum(words - level, 0))])
        out[:, 3 + k] = np.log1p(1000 * np.maximum(np.diff(excess[first]), 0) / np.maximum(m, 1))
    for i in np.flatnonzero(m):
        own = words[first[i] : first[i + 1]]
        out[i, 1] = np.sort(np.partition(own, -3)[-3:] if len(own) > 3 else own).mean()
    return out


def discount(once: float, twice: float) -> float:
    return min(0.95, max(0.1, once / max(1.0, once + 2 * twice)))


def model_totals(known: DataFrame, ordinary: DataFrame) -> dict:
    """Per length: events ``N`` and kinds ``T`` of either class, ``C`` and ``kinds`` of the shared counts, discounts ``d`` and ``d0``.

    ``known`` has the counts of all runs of toxic texts; what only ordinary texts
    have is added up and sketched. Reaches the driver: a row per length, and the sketch.
    """
    n, distinct = run_totals(ordinary)
    sums = [F.sum("t").alias("N"), F.count(F.lit(1)).alias("T"), F.count_if(F.col("t") == 1).alias("once"), F.count_if(F.col("t") == 2).alias("twice"), F.count_if(F.col("o") > 0).alias("both")]
    rows = {r["k"]: r for r in known.groupBy(F.col("run").bitwiseAND(F.lit(3)).alias("k")).agg(*sums).collect()}
    out = {}
    for k in range(1, LONGEST + 1):
        of = {c: float(rows[k][c]) if k in rows else 0.0 for c in ("N", "T", "once", "twice", "both")}
        kinds = max(of["both"], distinct[k - 1])
        shared = of["T"] + kinds
        out[k] = {
            "N_t": max(1.0, of["N"]), "N_o": max(1.0, float(n[k - 1])), "T_t": of["T"], "T_o": kinds, "d": discount(of["once"], of["twice"]),
            "C": max(1.0, shared), "kinds": max(1.0, shared - of["both"]), "d0": discount(shared - 2 * of["both"], of["both"]),
        }
    return out


def shared_probability(m: dict, t: Column, o: Column, below: Column) -> Column:
    """Of the model both classes back off to: a run counts once for each class that has it; ``below`` is what its parts make likely."""
    return F.greatest((t > 0).cast("int") + (o > 0).cast("int") - m["d0"], F.lit(0.0)) / m["C"] + m["d0"] * m["kinds"] / m["C"] * below


def log_ratio(m: dict, t: Column, o: Column, below: Column) -> Column:
    """log P(run | toxic) - log P(run | ordinary); 0 for a run that no toxic text has."""
    shared = shared_probability(m, t, o, below)
    p, q = (
        F.greatest(n - m["d"], F.lit(0.0)) / m[f"N_{c}"] + m["d"] * m[f"T_{c}"] / m[f"N_{c}"] * shared for n, c in ((t, "t"), (o, "o"))
    )
    return F.when(t > 0, F.log(p / q)).otherwise(0.0)


def telling_runs(taught: DataFrame, least: float = TELLING[0]) -> DataFrame:
    """``run, s, s0, s1``: log P(run | toxic) - log P(run | ordinary), and the same for an ordinary and a toxic text that taught it, with itself left out.

    Columns ``__y, text``. Events are runs of one to three words, once per text.
    Each class has an interpolated Kneser-Ney model per length: counts less a
    discount, and the mass so freed goes by the shared model. There a run counts
    once for each class that has it, and backs off to the product of the shared
    probabilities of the run without its last word and of that word; words back
    off to all words alike. Runs seen once take part like others. Runs that don't
    speak by more than ``least`` aren't kept: they say nothing, and a run that no
    toxic text has is left to the shared model in both classes. The table has a
    row for each run that does speak, however many texts there are.
    """
    run, tox, plain = "run", taught.filter("__y = 1"), taught.filter("__y = 0")
    write = Scratch(taught.sparkSession, "toxicity").table  # plans start afresh behind the long conditions below
    toxic = write(count_runs(tox).toDF(run, "t"))
    ordinary = count_runs(plain, Filter(toxic)).toDF(run, "o")
    known = write(toxic.join(ordinary, run, "left").fillna(0))
    totals = model_totals(known, plain)
    length, t, o = F.col(run).bitwiseAND(F.lit(3)), F.col("t"), F.col("o")
    left_out = {"s": (t, o), "s0": (t, F.greatest(o - 1, F.lit(0))), "s1": (t - 1, o)}

    # Backing off makes both classes likelier and clear ratios smaller, so the ratio without it, the row's ordinary text left out, is a bound.
    clear = [(length == k) & (log_ratio(m, *left_out["s0"], F.lit(0.0)) > least) for k, m in totals.items()]
    open_ = write(known.filter(clear[0] | clear[1] | clear[2]))
    whole = open_.join(parts_of(tox, Filter(open_)), run, "left")
    for part in ("head", "w1", "w2", "w3"):
        whole = whole.join(known.select(F.col(run).alias(part), F.col("t").alias(f"{part}_t"), F.col("o").alias(f"{part}_o")), part, "left")
    whole = write(whole.fillna(0))

    anything = F.lit(1 / totals[1]["kinds"])
    w1, w2, w3 = (shared_probability(totals[1], F.col(f"w{i}_t"), F.col(f"w{i}_o"), anything) for i in (1, 2, 3))
    below = {1: anything, 2: w1 * w2, 3: shared_probability(totals[2], F.col("head_t"), F.col("head_o"), w1 * w2) * w3}
    found = [
        whole.filter(length == k).select(run, *[log_ratio(m, *counts, below[k]).alias(name) for name, counts in left_out.items()]) for k, m in totals.items()
    ]
    return write(write(found[0].union(found[1]).union(found[2])).filter(F.col("s0") > least))


def with_evidence(rows: DataFrame, runs: DataFrame, strength) -> DataFrame:
    """Rows of ``at, n, runs, x``: the measures x with those of the row's runs of words behind them, the runs left out.

    The row's clearest run, and the excess of its runs over the levels of TELLING for each of its n words.
    """
    over = [F.sum(F.greatest(F.col("s") - level, F.lit(0.0))).alias(f"e{k}") for k, level in enumerate(TELLING)]
    found = (
        rows.select("at", "y", F.explode("runs").alias("run")).join(runs, "run").select("at", strength.alias("s")).filter(F.col("s") > TELLING[0])
        .groupBy("at").agg(F.max("s").alias("top"), *over)
    )
    more = [F.coalesce("top", F.lit(0.0))] + [F.log1p(1000 * F.coalesce(f"e{k}", F.lit(0.0)) / F.greatest("n", F.lit(1))) for k in range(len(TELLING))]
    return rows.drop("runs").join(found, "at", "left").withColumn("x", F.concat("x", F.array(*more))).drop("at", "n", "top", *[f"e{k}" for k in range(len(TELLING))])


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: ``id, score, mean_log_ratio``.

    Two models of characters and two of expressions, of the texts labelled 1 and
    0, are counted over every labelled row for which ``learn`` (on the id) holds;
    classes back off to shared counts. Those of expressions are a table of log
    ratios that grows with the rows and stays in Spark (``telling_runs``), joined
    with the distinct runs of each text. A text's measures compare its two
    length-normalised log-likelihoods: over all characters (``mean_log_ratio``),
    and, so that a few clear words in a long text aren't washed out by the many
    that say nothing, over clear words and expressions, by word. How they weigh up
    to a probability is fitted on at most ``sample`` labelled rows, the first in
    order of a hash of the id, each measured as if it had not been counted: by
    characters with the models of the half of the rows that it isn't in.

    Labels are counted; up to BROADCAST_LABELS of them go to the texts by
    broadcast, more by a shuffle.

    Null and empty texts get the score of a text without words. A null label, or
    one whose id isn't among the documents, teaches nothing; an id labelled twice
    has its larger label. Without labelled texts of both kinds all scores are 0.
    """
    import numpy as np

    kind = docs.schema[id_col].dataType.simpleString()
    known = labels.filter(learn & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
    half = F.pmod(F.xxhash64("__id"), F.lit(2)).cast("int")
    sized = F.broadcast(known) if known.count() <= BROADCAST_LABELS else known
    taught = docs.filter(learn).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(sized, "__id")
    counts = collected(count_cells(taught.select(F.concat(half, F.lit(":"), "__y").alias("class"), "text"), "class", "text"))
    pick = lambda name, c: counts.get(f"{name}:{c}", np.zeros(CELLS))
    parts = [log_ratios({c: pick(1 - h, c) for c in "01"}) for h in (0, 1)]  # for the rows of half h, counts of the other
    ratios = log_ratios({c: pick(0, c) + pick(1, c) for c in "01"})
    taught = taught.select("__y", "text")
    runs = telling_runs(taught)
    told = Filter(runs)

    some = known.withColumn("half", half).orderBy(F.xxhash64("__id"), "__id").limit(sample)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(some.withColumnRenamed("__y", "y")), "__id")  # at most `sample` ids

    def measured(rows, models, named):
        """``at, y, n, runs, x`` and the named columns of each row. Written, so that ``at`` names a row from here on."""

        def measure(batches):
            import pyarrow as pa

            for batch in text_slices(batches):
                texts = [t or "" for t in batch["text"].to_pylist()]
                for a, b in slices(texts):
                    part = batch.slice(a, b - a)
                    row, found, n = runs_of(part["text"], told)
                    ends = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                    asked = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.view(np.int64)))
                    each = [measures(texts[a:b], r) for r in models]
                    x = each[0] if len(each) == 1 else np.where((part["half"].to_numpy() == 0)[:, None], *each)
                    yield pa.RecordBatch.from_arrays(
                        [*(part[c] for c in named), part["y"], pa.array(n), asked, pa.array(list(x), pa.list_(pa.float64()))], [*named, "y", "n", "runs", "x"]
                    )

        kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in named)
        return reliable_checkpoint(
            rows.mapInArrow(measure, f"{kinds}y int, n long, runs array<long>, x array<double>").withColumn("at", F.monotonically_increasing_id())
        )

    seen = with_evidence(measured(rows, parts, ["__id"]), runs, F.when(F.col("y") == 0, F.col("s0")).otherwise(F.col("s1")))
    seen = seen.groupBy("__id").agg(F.min(F.struct("y", "x")).alias("r")).select("r.y", "r.x").toArrow()  # repeated ids once
    x, y = np.array(seen["x"].to_pylist()).reshape(-1, 4 + len(CLEAR) + len(TELLING)), seen["y"].to_numpy()
    order = np.lexsort(np.column_stack([x, y]).T) if len(y) else np.zeros(0, int)  # rows come in any order
    x, y = x[order], y[order]
    able = len(y) and 0 < y.sum() < len(y)
    probability = fit_labelled(x, y) if able else None

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch["x"].to_pylist(), float).reshape(batch.num_rows, -1)
            p = probability.score(x) if able else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(p), pa.array(x[:, 0])], [id_col, "score", "mean_log_ratio"])

    every = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(None).cast("int").alias("y"), F.lit(0).alias("half"))
    return with_evidence(measured(every, [ratios], ["id"]), runs, F.col("s")).select("id", "x").mapInArrow(score, f"`{id_col}` {kind}, score double, mean_log_ratio double")
