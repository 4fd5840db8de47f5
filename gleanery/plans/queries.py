"""Queries over the test tables, one for each operator that tables can show, and the same in SQL.

The tables hold no images, so each query uses a table with the right shape in place of files: documents for file contents,
embeddings for model vectors and their sign bits for perceptual hashes, orders for files with times, events for pixels,
part for sizes and colours, labels for classifier output, conversations for captions. Thresholds are the ones at which
these tables have near duplicates: 18 bits and a cosine distance of 0.7.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions import hashing, text, vectors
from gleanery.functions.pixels import bounded_side
from gleanery.operators import dedup, models, naming, palette, resume

HASH_DISTANCE, COSINE_DISTANCE = 18, 0.7
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text

_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_CLEAN = rf"trim(regexp_replace(regexp_replace({{0}}, '[^\p{{{{L}}}}\p{{{{N}}}}_{_SPACE.replace('{', '{{').replace('}', '}}')}.,:;!?()\-\[\]''\"«»„“/]', '', 'g'), '[{_SPACE.replace('{', '{{').replace('}', '}}')}]+', ' ', 'g'))"
_THOUGHTS = "'<think>' || role || '</think>' || text || '<THINK x=1>a' || chr(10) || 'b</think >' || '<think> open'"


@query(f"SELECT conv_id, turn, {_CLEAN.format('text')} AS cleaned FROM conversations")
def text_clean(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_text(F.col("text"), thinking=False).alias("cleaned"))


@query(f"SELECT conv_id, turn, {_CLEAN.format('regexp_replace(' + _THOUGHTS + ', ' + chr(39) + '<think\\b[^>]*>.*?</think\\s*>' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'gis' + chr(39) + ')')} AS cleaned FROM conversations")
def text_clean_thinking(spark, sf_dir):
    raw = F.concat(F.lit("<think>"), F.col("role"), F.lit("</think>"), F.col("text"), F.lit("<THINK x=1>a\nb</think ><think> open"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_text(raw).alias("cleaned"))


@query(f"SELECT conv_id, turn, lower({_CLEAN.format('text')}) AS cleaned FROM conversations")
def text_clean_lowercase(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_text(F.col("text"), thinking=False, lowercase=True).alias("cleaned"))


@query("""SELECT page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped,
 '''' || replace(url || '''s', '''', '''\\''''') || '''' AS quoted, 'file://' || '/' || url AS uri FROM pages""".replace("\\\\", "\\"))
def escapes(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.html_escape(url).alias("escaped"), text.shell_quote(F.concat(url, F.lit("'s"))).alias("quoted"), text.file_uri(F.concat(F.lit("/"), url)).alias("uri"))


@query("""SELECT doc_id, CASE WHEN s < 1024 THEN s || ' B' WHEN s < 1048576 THEN printf('%.1f', s / 1024.0::double) || ' KB' ELSE printf('%.1f', s / 1048576.0::double) || ' MB' END AS size
 FROM (SELECT doc_id, n_chars * n_chars AS s FROM documents)""")
def human_size(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.format_size(F.col("n_chars") * F.col("n_chars")).alias("size"))


@query("SELECT p_partkey, printf('#%02x%02x%02x', p_size, (p_partkey % 256)::int, (p_partkey * 7 % 256)::int) AS hex FROM part")
def rgb_hex(spark, sf_dir):
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", text.rgb_hex(F.col("p_size"), key % 256, key * 7 % 256).alias("hex"))


@query("SELECT p_partkey, p_name || '.JPG' AS name FROM part WHERE lower(regexp_extract(CASE WHEN p_partkey % 3 = 0 THEN p_name || '.JPG' ELSE p_name || '.txt' END, '(\\.[^.]*)$', 1)) IN ('.jpg', '.png')")
def suffix_filter(spark, sf_dir):
    named = table(spark, sf_dir, "part").withColumn("name", F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, ".JPG").otherwise(".txt")))
    return named.where(F.lower(text.suffix(F.col("name"))).isin(".jpg", ".png")).select("p_partkey", "name")


@query("SELECT o_orderkey, name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey || '_' || lpad(o_orderkey::varchar, 7, '0') || '.JPG' ELSE o_orderkey || '.jpg' END AS name FROM orders) WHERE NOT regexp_matches(name, '^\\d+_\\d{7}\\.jpg$', 'i')")
def already_named_filter(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    name = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.lpad(key, 7, "0"), F.lit(".JPG"))).otherwise(F.concat(key, F.lit(".jpg")))
    return table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name")).where(~naming.already_named(F.col("name")))


# Hashes, exact duplicates and incremental runs


@query("""SELECT doc_id, md5(text) AS file_hash, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_duplicate FROM documents""")
def content_md5_first_wins(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select("doc_id", hashing.md5_hex(F.col("text")).alias("file_hash"))
    return dedup.first_wins(hashed, "file_hash", ["doc_id"])


@query(None)
def content_blake2b(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hashing.blake2b_128(F.col("text")).alias("file_hash"))


@query("SELECT d.doc_id, d.n_chars FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_anti_join(spark, sf_dir):
    return resume.unprocessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "n_chars")


@query("SELECT b.item_id, md5(b.text) AS file_hash, md5(b.text) IN (SELECT md5(text) FROM documents) AS seen FROM benchmark b")
def checkpoint_mark(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select("item_id", hashing.md5_hex(F.col("text")).alias("file_hash"))
    done = table(spark, sf_dir, "documents").select(hashing.md5_hex(F.col("text")).alias("file_hash"))
    return resume.mark_seen(items, done, "file_hash")


_STATUS = """SELECT doc_id, CASE WHEN l IS NOT NULL THEN 'resumed' WHEN n > 1 THEN 'duplicate' WHEN n_chars < 100 THEN 'error' ELSE 'processed' END AS status
 FROM (SELECT d.doc_id, d.n_chars, l.doc_id AS l, row_number() OVER (PARTITION BY d.text ORDER BY d.doc_id) AS n FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"""


def _statuses(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", hashing.md5_hex(F.col("text")).alias("file_hash"))
    marked = dedup.first_wins(resume.mark_seen(docs, table(spark, sf_dir, "labels"), "doc_id"), "file_hash", ["doc_id"])
    error = F.when(F.col("n_chars") < 100, F.lit("too short"))
    return marked.select("doc_id", resume.status(error, F.col("is_duplicate"), F.col("seen")).alias("status"))


@query(_STATUS)
def status_rows(spark, sf_dir):
    rows = _statuses(spark, sf_dir)
    return resume.merged_status_rows(rows.where("status = 'processed'"), rows.where("status <> 'processed'"))


@query(f"SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'error') AS errors, count(*) FILTER (status = 'duplicate') AS duplicates, count(*) FILTER (status = 'resumed') AS skipped FROM ({_STATUS})")
def dedup_counters(spark, sf_dir):
    return resume.run_counters(_statuses(spark, sf_dir))


@query("SELECT item_id AS id, text FROM benchmark UNION ALL SELECT doc_id AS id, text FROM documents")
def union_append(spark, sf_dir):
    return resume.union_append(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"))


@query("""SELECT count(*) AS n_batches, sum(l_linenumber)::bigint AS n_items, round(sum(l_linenumber) / (sum(l_quantity::decimal(18,2)) + sum(l_quantity::decimal(18,2)))::double, 9) AS items_per_s,
 round(sum(l_quantity::decimal(18,2))::double / count(*) * 1000, 4) AS avg_inference_ms, round(sum(l_quantity::decimal(18,2))::double / count(*) * 1000, 4) AS avg_io_ms FROM lineitem""")
def batch_metrics(spark, sf_dir):
    seconds = F.col("l_quantity").cast("double")
    report = resume.metrics_report(table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("batch_size"), seconds.alias("inference_s"), seconds.alias("io_s")))
    return report.select("n_batches", "n_items", F.round("items_per_s", 9).alias("items_per_s"), F.round("avg_inference_ms", 4).alias("avg_inference_ms"), F.round("avg_io_ms", 4).alias("avg_io_ms"))


@query("SELECT count(*) AS found, count(*) FILTER (l IS NULL) AS new, count(DISTINCT lang) AS groups FROM (SELECT d.lang, l.doc_id AS l FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)")
def result_counts(spark, sf_dir):
    marked = resume.mark_seen(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return marked.agg(F.count(F.lit(1)).alias("found"), F.count_if(~F.col("seen")).alias("new"), F.count_distinct("lang").alias("groups"))


# Rename plans


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS serial,
 epoch(o_orderdate)::bigint || '_' || lpad(row_number() OVER (ORDER BY o_orderdate, o_orderkey)::varchar, 7, '0') || '.jpg' AS new_name FROM orders""")
def serial_rename_plan(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("double")
    files = table(spark, sf_dir, "orders").select("o_orderkey", seconds.alias("ctime"), F.lit("/files").alias("dir"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("path"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".png")).alias("name"))
    return naming.serial_rename_plan(files).select("o_orderkey", "serial", "new_name")


@query("""SELECT doc_id, h || CASE n WHEN 1 THEN '' WHEN 2 THEN '_duplicate' ELSE '_duplicate_' || (n - 2) END || '.txt' AS new_name
 FROM (SELECT doc_id, md5(text) AS h, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents)""")
def hash_rename_plan(spark, sf_dir):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    files = table(spark, sf_dir, "documents").select("doc_id", name.alias("name"), F.lpad(name, 24, "0").alias("path"), hashing.md5_hex(F.col("text")).alias("hash"))
    return naming.changed_names(naming.hash_rename_plan(files)).select("doc_id", "new_name")


@query("""SELECT d.doc_id, CASE WHEN d.r = 0 THEN d.lang || '.txt' ELSE d.lang || '_' || f.i || '.txt' END AS backup_name
 FROM (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS r FROM documents) d
 LEFT JOIN (SELECT source, lang, i, row_number() OVER (PARTITION BY source, lang ORDER BY i) AS r
  FROM (SELECT source, lang, unnest(range(1, 2 * (SELECT count(*) FROM documents) + 1)) AS i FROM (SELECT DISTINCT source, lang FROM documents)) n
  WHERE NOT EXISTS (SELECT 1 FROM documents t WHERE t.source IS NOT DISTINCT FROM n.source AND t.lang IS NOT DISTINCT FROM n.lang AND t.n_chars = n.i)) f
 ON f.source IS NOT DISTINCT FROM d.source AND f.lang IS NOT DISTINCT FROM d.lang AND f.r = d.r""")
def backup_collisions(spark, sf_dir):
    """Every document of a source and language has one name; the backup folder has that name with each document's length."""
    docs = table(spark, sf_dir, "documents")
    plan = docs.select("doc_id", F.concat("lang", F.lit(".txt")).alias("name"), F.col("source").alias("backup_dir"))
    held = docs.select(F.col("source").alias("dir"), F.concat("lang", F.lit("_"), F.col("n_chars").cast("string"), F.lit(".txt")).alias("name"))
    return naming.backup_names(plan, held, ["doc_id"]).select("doc_id", "backup_name")


# Palettes, pixels and scores


@query("""SELECT user_id, event_type, count(*) AS n, printf('%.2f', (count(*)::double / sum(count(*)) OVER (PARTITION BY user_id)) * 100)::double AS percent FROM events GROUP BY user_id, event_type""")
def palette_share(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return palette.with_share(counts, "user_id")


@query("""SELECT user_id, event_type, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS place FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) <= 20""")
def palette_top(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))
    return counts.withColumn("place", place.cast("long")).where("place <= 20")


@query("""SELECT p_partkey, CASE WHEN m > 384 THEN trunc(w * (384.0::double / m))::int ELSE w END AS width, CASE WHEN m > 384 THEN trunc(h * (384.0::double / m))::int ELSE h END AS height
 FROM (SELECT p_partkey, w, h, greatest(w, h) AS m FROM (SELECT p_partkey, p_size * 17 AS w, (p_partkey % 1000 + 1)::int AS h FROM part))""")
def resize_bound(spark, sf_dir):
    sized = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 17).alias("w"), (F.col("p_partkey") % 1000 + 1).cast("int").alias("h"))
    return sized.select("p_partkey", bounded_side(F.col("w"), F.col("h"), 384).alias("width"), bounded_side(F.col("h"), F.col("w"), 384).alias("height"))


@query("""SELECT doc_id, printf('%.4f', CASE WHEN toxic = 1 THEN 0.12345 + quality * 0.3 ELSE 0 END)::double AS nsfw_score, printf('%.4f', greatest(quality * 0.61255, 0.21255))::double AS safe_score FROM labels""")
def score_fold(spark, sf_dir):
    pred = lambda label, score: F.struct(F.lit(label).alias("label"), score.cast("double").alias("score"))
    toxic = F.when(F.col("toxic") == 1, F.lit(0.12345) + F.col("quality") * F.lit(0.3)).otherwise(F.lit(0.0))
    preds = F.array(pred("NSFW_like", toxic), pred("Normal", F.col("quality") * F.lit(0.61255)), pred("unsafe", F.lit(0.21255)), pred("other", F.lit(0.9)))
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("doc_id").cast("string").alias("path"), preds.alias("preds"), F.lit(1.0).alias("inference_ms"), F.lit(None).cast("string").alias("error"))
    unsafe, safe = models.score_fold(F.col("preds"))
    return rows.select("doc_id", text.rounded(unsafe, 4).alias("nsfw_score"), text.rounded(safe, 4).alias("safe_score"))


@query("SELECT doc_id, CASE WHEN s > 0 THEN printf('%.2f', t / s)::double ELSE 0.0 END AS tokens_per_sec, CASE WHEN t > 0 THEN s * 1000 / t END AS amortised_ms FROM (SELECT doc_id, n_chars::double AS t, (doc_id % 7)::double AS s FROM documents)")
def batch_speed(spark, sf_dir):
    tokens, seconds = F.col("n_chars").cast("double"), (F.col("doc_id") % 7).cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", text.tokens_per_second(tokens, seconds).alias("tokens_per_sec"), text.amortised_ms(seconds * 1000, tokens).alias("amortised_ms"))


# Vectors and near duplicates


@query("SELECT vec_id, len(embedding)::int AS embedding_dim FROM embeddings")
def embedding_dim(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", vectors.dimension(F.col("embedding")).alias("embedding_dim"))


@query("SELECT label, (i - 1)::int AS place, round(avg(embedding[i]::double), 6) AS mean FROM embeddings, generate_series(1, 64) AS s(i) GROUP BY label, i")
def mean_pool(spark, sf_dir):
    pooled = models.mean_pool(table(spark, sf_dir, "embeddings").select("label", vectors.doubles(F.col("embedding")).alias("v")), ["label"], "v")
    return pooled.select("label", F.posexplode("v").alias("place", "mean")).withColumn("mean", F.round("mean", 6))


@query("SELECT vec_id, (i - 1)::int AS place, round(embedding[i]::double * 3 / sqrt(list_sum(list_transform(embedding, lambda x: (x::double * 3) * (x::double * 3)))), 9) AS x FROM embeddings, generate_series(1, 64) AS s(i)")
def l2_normalize(spark, sf_dir):
    scaled = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(vectors.doubles(F.col("embedding")), lambda x: x * 3).alias("v"))
    return scaled.select("vec_id", F.posexplode(vectors.l2_normalize(F.col("v"))).alias("place", "x")).withColumn("x", F.round("x", 9))


_SIGNED = "SELECT vec_id AS id, label, embedding::double[] AS v, list_reduce(list_transform(embedding, lambda x: CASE WHEN x >= 0 THEN 1 ELSE 0 END::hugeint), lambda a, x: a * 2 + x) AS h FROM embeddings"
_PAIRS = f"SELECT a.id AS u, b.id AS v, bit_count(xor(a.h, b.h))::int AS distance FROM ({_SIGNED}) a JOIN ({_SIGNED}) b ON a.id < b.id AND bit_count(xor(a.h, b.h)) <= {HASH_DISTANCE}"
_EDGES = "SELECT u, v FROM {0} UNION SELECT v, u FROM {0}"


def _reach(pairs: str) -> str:
    return f"{pairs}_edges AS ({_EDGES.format(pairs)}), {pairs}_reach(u, v) AS (SELECT u, v FROM {pairs}_edges UNION SELECT r.u, e.v FROM {pairs}_reach r JOIN {pairs}_edges e ON r.v = e.u)"


def _signed(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), vectors.sign_bits(F.col("embedding")).alias("phash"), F.col("embedding").alias("vector"))


@query(_PAIRS)
def hamming_pairs(spark, sf_dir):
    return dedup.hamming_pairs(_signed(spark, sf_dir), HASH_DISTANCE)


@query(f"WITH RECURSIVE p AS ({_PAIRS}), {_reach('p')} SELECT u AS node, min(v) AS component FROM p_reach GROUP BY u")
def connected_component_labels(spark, sf_dir):
    return dedup.hamming_components(_signed(spark, sf_dir), HASH_DISTANCE)


_GROUPED = f"p AS ({_PAIRS}), {_reach('p')}, g AS (SELECT r.u AS id, min(r.v) AS group_id FROM p_reach r GROUP BY r.u), s AS ({_SIGNED})"
_COSINE = f"SELECT a.group_id, a.id AS u, b.id AS v FROM g a JOIN g b ON a.group_id = b.group_id AND a.id < b.id JOIN s x ON x.id = a.id JOIN s y ON y.id = b.id WHERE round(list_cosine_distance(x.v, y.v), 12) <= {COSINE_DISTANCE}"


@query(f"WITH RECURSIVE {_GROUPED} {_COSINE}")
def cosine_pairs_in_groups(spark, sf_dir):
    rows = _signed(spark, sf_dir)
    return dedup.cosine_pairs_in_groups(dedup.in_components(rows, dedup.hamming_components(rows, HASH_DISTANCE)), COSINE_DISTANCE)


@query(f"WITH RECURSIVE {_GROUPED}, q AS ({_COSINE}), {_reach('q')}, c AS (SELECT u AS vec_id, min(v) AS group_id FROM q_reach GROUP BY u) SELECT vec_id, group_id, (row_number() OVER (PARTITION BY group_id ORDER BY vec_id) - 1)::int AS rank FROM c")
def neardup_two_stage(spark, sf_dir):
    groups = dedup.near_duplicate_groups(_signed(spark, sf_dir), HASH_DISTANCE, COSINE_DISTANCE)
    return dedup.keep_rank(groups.select("id", "group_id", F.lit(0).alias("size")), path="id").select(F.col("id").alias("vec_id"), "group_id", "rank")


@query("SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) - 1)::int AS rank FROM documents")
def keep_rank(spark, sf_dir):
    return dedup.keep_rank(table(spark, sf_dir, "documents"), "source", "n_chars", "doc_id").select("doc_id", "source", "rank")


@query("SELECT doc_id, md5(text) AS file_hash FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)")
def group_size_filter(spark, sf_dir):
    return dedup.groups_larger_than_one(table(spark, sf_dir, "documents").select("doc_id", hashing.md5_hex(F.col("text")).alias("file_hash")), "file_hash")
