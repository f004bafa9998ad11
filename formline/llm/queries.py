"""The operators applied to the corpus tables, each with the SQL it is checked against, where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formline.llm import collocations, decontaminate, exact, fim, langid, lines, minhash, mixing, pu_quality, substrings, tokenfiles, toxicity, warc
from formline.llm.words import in_fold, word_count
from formline.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark, folder):
    found = substrings.repeated_passages(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op1_substring_dedup"] = r"""
WITH split AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spots AS (
  SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM split WHERE len(words) >= 35)),
repeats AS (SELECT w FROM spots GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM spots JOIN repeats USING (w))),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM split),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (r, p) GROUP BY r),
counts AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r) LEFT JOIN counts USING (r)
"""


@query
def op2_toxicity(spark, folder):
    scored = toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), ~in_fold("doc_id"))
    return scored.select("doc_id", in_fold("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op3_benchmark_decontamination(spark, folder):
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op3_benchmark_decontamination"] = r"""
WITH norm AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT item_id, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)),
spots AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM norm, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
hits AS (SELECT doc_id, i, spots.size AS size, item_id FROM spots JOIN windows ON spots.w = windows.w AND spots.size = windows.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op4_line_dedup(spark, folder):
    found = lines.duplicate_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("kept_sha256"))


SQL["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, i, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
placed AS (
  SELECT *, array_to_string(words, ' ') AS s, row_number() OVER (ORDER BY doc_id NULLS LAST, i) AS place FROM lines WHERE len(words) > 0),
first AS (SELECT s, min(place) AS place, any_value(words) AS words FROM placed GROUP BY s),
less AS (
  SELECT s, place, len(words) AS w, e, array_to_string(list_concat(words[1:e - 1], words[e + 1:]), ' ') AS v
  FROM (SELECT s, place, words, unnest(range(1, len(words) + 1)) AS e FROM first WHERE len(words) >= 8)),
replaced AS (SELECT s FROM (SELECT s, place, min(place) OVER (PARTITION BY w, e, v) AS earliest FROM less) WHERE earliest < place),
shorter AS (SELECT less.s FROM less JOIN first ON less.v = first.s AND len(first.words) >= 8 AND first.place < less.place),
longer AS (SELECT first.s FROM less JOIN first ON less.v = first.s AND len(first.words) >= 8 AND less.place < first.place),
gone AS (SELECT s FROM replaced UNION SELECT s FROM shorter UNION SELECT s FROM longer),
stay AS (SELECT place FROM first ANTI JOIN gone USING (s)),
kept AS (
  SELECT doc_id, i, line FROM placed SEMI JOIN stay USING (place)
  UNION ALL SELECT doc_id, i, line FROM lines WHERE len(words) = 0),
joined AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM documents LEFT JOIN joined USING (doc_id)
"""


@query
def op5_quality_classifier(spark, folder):
    scored = pu_quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), ~in_fold("doc_id"))
    return scored.select("doc_id", in_fold("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op6_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    plan = mixing.mix_plan(docs, ["doc_id"])
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op6_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT source, source_size, w, source_size * CAST(2.0 AS DOUBLE) AS bound,
         (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) - coalesce(sum(source_size * CAST(2.0 AS DOUBLE)) OVER before, 0))
           / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level,
         row_number() OVER (ORDER BY source_size * CAST(2.0 AS DOUBLE) / w, source NULLS LAST) AS k
  FROM totals
  WINDOW before AS (ORDER BY source_size * CAST(2.0 AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(bound, coalesce((SELECT arg_min(level, k) FROM filled WHERE level * w <= bound) * w, bound)) AS target,
         CAST('0x' || substr(md5('mix:' || coalesce(source, chr(0))), 1, 8) AS UBIGINT) / CAST(4294967296 AS DOUBLE) AS shift
  FROM filled),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS DOUBLE) AS r FROM sized),
stepped AS (
  SELECT doc_id, size, source_size, target, r, shift, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS per
  FROM ranked JOIN targets ON ranked.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, CAST(floor(r * per + shift) - floor((r - 1) * per + shift) AS BIGINT) * size AS taken FROM stepped
"""


@query
def op7_minhash_near_dedup(spark, folder):
    return minhash.near_duplicates(table(spark, folder, "documents"), percent=85)


SQL["op7_minhash_near_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id
  WHERE x.s IN (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1) GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query
def op8_exact_dedup(spark, folder):
    return exact.exact_groups(table(spark, folder, "documents"), keep="largest")


SQL["op8_exact_dedup"] = """
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm.t) AS text_sha256
FROM norm JOIN groups USING (t)
"""


@query
def op9_language_id(spark, folder):
    found = langid.identify(table(spark, folder, "documents"), ~in_fold("doc_id"))
    return found.select("doc_id", in_fold("doc_id").alias("held_out"), "lang_pred", "score", "confident")


@query
def op10_warc(spark, folder):
    """The archive stays below the checkpoint folder, since the result is read from it."""
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(warc.as_records(table(spark, folder, "pages")), path)
    found = warc.resolve_revisits(warc.read(spark, path), warc.read(spark, path, payload="false"))
    return found.select(
        F.expr("try_cast(regexp_extract(record_id, '^<urn:page:(.*)>$', 1) AS bigint)").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.expr("try_cast(regexp_extract(refers_to, '^<urn:page:(.*)>$', 1) AS bigint)").alias("refers_to"),
    )


SQL["op10_warc"] = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS t, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY t) AS f FROM sized)
SELECT page_id, n AS payload_bytes, sha256(t) AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
FROM first
"""


@query
def op11_fill_in_middle(spark, folder):
    done = fim.fill_in_middle(table(spark, folder, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return done.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


SQL["op11_fill_in_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS u, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS v,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, substring(t, 1, least(u, v)) AS p, substring(t, least(u, v) + 1, abs(u - v)) AS m, substring(t, greatest(u, v) + 1) AS s FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(u, v) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(u - v) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


@query
def op12_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


SQL["op12_collocations"] = r"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (
  SELECT lang, phrase, any_value(k) AS k, count(*) AS n
  FROM (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) t(k) WHERE len(words) >= k))
  GROUP BY lang, phrase),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
candidates AS (SELECT lang, phrase, k AS size, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10),
parts AS (
  SELECT lang, phrase, size, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM candidates)),
lefts AS (SELECT parts.*, f.n AS l FROM parts JOIN f ON f.lang = parts.lang AND f.phrase = parts.lp),
cuts AS (
  SELECT lefts.*, f.n AS r, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * f.n) AS score
  FROM lefts JOIN f ON f.lang = lefts.lang AND f.phrase = lefts.rp),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nr FROM cuts) WHERE nr = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE size = 3) GROUP BY lang, phrase),
kept AS (SELECT best.*, longer FROM best LEFT JOIN inside ON best.lang = inside.lang AND best.phrase = inside.phrase),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
"""

#: A file of the tokenizers library.
TOKENIZER = "word_bpe_49k.json"
END = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op13_token_files(spark, folder):
    """The shards stay below the checkpoint folder, since the result is read from them."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokenfiles.write_tokens(table(spark, folder, "documents"), path, tokenizer_path(), end_id=END)
    found = tokenfiles.read_tokens(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
