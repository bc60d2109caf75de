"""Queries over texts as sequences and vectors: edit operations, duplicates, batches, embeddings, normalization (X*, D*, B*, K8, M*, S*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import edit, normalize, speech
from ..functions import text as t
from ..functions import vectors as v
from ..operators import batching as b
from ..operators import dedup as dd
from ..operators import joins as jn
from ..operators import ordering as o
from ..session import shared_folder, spread, table
from ..sources import readers
from .quality import _DEDUP, _s
from .registry import query

POOL = "llm_children_100k_asr_complete"


# The distance by character: a row of the table per character of the reference, folded over lists. Equal texts are left out of it.
_DISTANCE = """SELECT a, b, list_reduce(string_split(a, ''), lambda row, ch: list_reduce(list_zip(y, row[:-2], row[2:]), lambda acc, z: list_append(acc, least(acc[-1] + 1, z[2] + CASE WHEN z[1] = ch THEN 0 ELSE 1 END, z[3] + 1)), [row[1] + 1]), range(len(y) + 1))[-1] AS distance
FROM (SELECT DISTINCT ref_normalized AS a, hypo_normalized AS b, string_split(hypo_normalized, '') AS y FROM eval WHERE ref_normalized <> hypo_normalized AND ref_normalized <> '' AND hypo_normalized <> '')"""


@query(f"""WITH d AS ({_DISTANCE}), e AS (SELECT DISTINCT wav, arrived_at, ref_normalized AS a, hypo_normalized AS b FROM eval), r AS (SELECT wav, arrived_at, a, b, CASE WHEN a = b THEN 0 WHEN a = '' OR b = '' THEN length(a) + length(b) ELSE distance END AS distance FROM e LEFT JOIN d USING (a, b))
SELECT wav, arrived_at, distance, length(b) - length(a) AS surplus, CASE WHEN b IS NOT NULL THEN length(a) END AS n, round(distance / nullif(length(a), 0), 6) AS cer FROM r""")
def cer_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distance, insertions minus deletions and rate by character of every distinct row; nulls where a text is missing."""
    df = spread(table(spark, d, "eval", "wav", "arrived_at", "ref_normalized", "hypo_normalized").distinct())
    df = df.withColumn("x", F.when(F.col("ref_normalized").isNotNull() & F.col("hypo_normalized").isNotNull(), edit.char_operations("ref_normalized", "hypo_normalized")))
    dist = F.col("x.s") + F.col("x.i") + F.col("x.d")
    return df.select("wav", "arrived_at", dist.alias("distance"), (F.col("x.i") - F.col("x.d")).alias("surplus"), F.col("x.n").alias("n"), F.round(dist / F.nullif(F.col("x.n"), F.lit(0)), 6).alias("cer"))


@query()
def cer_operations(spark: SparkSession, d: str) -> DataFrame:
    """Substitutions, insertions, deletions and rate of every scored row (X16); cer_pairs checks their sum by SQL. No rate for an empty reference."""
    df = spread(table(spark, d, "eval", "wav", "ref_normalized", "hypo_normalized").where("hypo_normalized is not null")).withColumn("x", edit.char_operations("ref_normalized", "hypo_normalized"))
    return df.select("wav", "x.*", ((F.col("x.s") + F.col("x.i") + F.col("x.d")) / F.nullif(F.col("x.n"), F.lit(0))).alias("cer"))


_W = lambda c: f"regexp_replace(regexp_replace(lower(regexp_replace({c}, '[^\\p{{L}}\\p{{M}}\\p{{N}}''\\s]', '', 'g')), '\\s+', ' ', 'g'), {_s(f'^{t.WS}+|{t.WS}+$')}, '', 'g')"


@query(f"""WITH e AS (SELECT DISTINCT gen_text, asr_hypo, string_split({_W(f"regexp_replace(gen_text, {_s(t.ANY_TAG)}, '', 'g')")}, ' ') AS x, string_split({_W('asr_hypo')}, ' ') AS y FROM eval WHERE asr_hypo IS NOT NULL AND gen_text IS NOT NULL),
d AS (SELECT gen_text, asr_hypo, len(x) AS n, CASE WHEN x = y THEN 0 ELSE list_reduce(x, lambda row, w: list_reduce(list_zip(y, row[:-2], row[2:]), lambda acc, z: list_append(acc, least(acc[-1] + 1, z[2] + CASE WHEN z[1] = w THEN 0 ELSE 1 END, z[3] + 1)), [row[1] + 1]), range(len(y) + 1))[-1] END AS distance FROM e)
SELECT wav, distance, d.n AS n FROM eval JOIN d USING (gen_text, asr_hypo)""")
def wer_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distance by word and words of the reference of every row with a hypothesis."""
    return wer_operations(spark, d).where("n is not null").select("wav", (F.col("s") + F.col("i") + F.col("d")).alias("distance"), "n")


@query()
def wer_operations(spark: SparkSession, d: str) -> DataFrame:
    """Substitutions, insertions and deletions by word."""
    df = spread(table(spark, d, "eval", "wav", "gen_text", "asr_hypo").where("asr_hypo is not null")).withColumn("x", edit.word_operations(t.tts_text(t.untagged("gen_text")), t.tts_text("asr_hypo")))
    return df.select("wav", "x.*")


_BARE = rf"""regexp_replace(lower(text), {_s(rf"({t.WS}|[\[\]，。？！,.?!])+")}, '', 'g')"""


@query(f"SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY md5({_BARE}) ORDER BY seq) AS r FROM {POOL}) WHERE r = 1")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    """First row of each text and bare form."""
    return dd.exact(table(spark, d, POOL, "seq", "text"), "text", "seq").select("seq")


@query(f"""WITH h AS (SELECT seq, md5(text) AS a, md5({_BARE}) AS b FROM {POOL}), k AS (SELECT h, min(seq) AS f FROM (SELECT a AS h, seq FROM h UNION ALL SELECT b, seq FROM h) GROUP BY 1)
SELECT h.seq FROM h JOIN k x ON x.h = h.a JOIN k y ON y.h = h.b WHERE h.a <> h.b AND h.seq = x.f AND h.seq = y.f""")
def dedup_shared_set(spark: SparkSession, d: str) -> DataFrame:
    """The variant in which texts and bare forms share one set (D1, mode reference)."""
    return dd.exact(table(spark, d, POOL, "seq", "text"), "text", "seq", mode="reference").select("seq")


_SETS = f"""WITH r AS (SELECT DISTINCT id, concat_ws(chr(1), coalesce(scenario, ''), coalesce(age_tier, '')) AS c, {_BARE} AS s FROM (SELECT id, scenario, age_tier, text FROM {POOL} WHERE id IS NOT NULL)),
g AS (SELECT id, c, list_distinct(list_concat(list_transform(range(1, length(s)), lambda i: substr(s, i, 2)), regexp_extract_all(s, '[a-zA-Z]+'))) AS t FROM r WHERE length(s) > 0)"""


@query(_SETS + " SELECT a.id AS key_a, b.id AS key_b, len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) AS similarity FROM g a JOIN g b ON a.c = b.c AND a.id < b.id WHERE len(a.t) > 0 AND len(b.t) > 0 AND len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) >= 0.6")
def context_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar pairs inside a context."""
    df = table(spark, d, POOL, "id", "text", "scenario", "age_tier").where("id is not null").distinct()
    return dd.similar_pairs(df, "id", "text", ("scenario", "age_tier"), 0.6)


_CTX = ", ".join(f"coalesce({c}, '')" for c in dd.CONTEXT)


@query(f"""WITH i AS (SELECT id, min(seq) AS seq, arg_min(concat_ws(chr(1), {_CTX}), seq) AS c, arg_min(text, seq) AS text FROM {POOL} WHERE id IS NOT NULL GROUP BY 1), r AS (SELECT id, seq, c, {_BARE} AS s FROM i),
g AS (SELECT id, seq, c, list_distinct(list_concat(list_transform(range(1, length(s)), lambda i: substr(s, i, 2)), regexp_extract_all(s, '[a-zA-Z]+'))) AS t FROM r WHERE length(s) > 0),
p AS (SELECT a.id AS early, b.id AS late, a.seq AS q0, b.seq AS q1 FROM g a JOIN g b ON a.c = b.c AND (a.seq, a.id) < (b.seq, b.id) WHERE len(a.t) > 0 AND len(b.t) > 0 AND len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) >= 0.88),
d AS (SELECT list_reduce(list({{'early': early, 'late': late}} ORDER BY q1, late, q0), lambda gone, x: CASE WHEN list_contains(gone, x.early) OR list_contains(gone, x.late) THEN gone ELSE list_append(gone, x.late) END, []::VARCHAR[]) AS gone FROM p)
SELECT id FROM i, d WHERE NOT coalesce(list_contains(gone, id), false)""")
def dedup_semantic(spark: SparkSession, d: str) -> DataFrame:
    """Greedy first-wins deduplication in a context."""
    df = table(spark, d, POOL, "id", "text", "seq", *dd.CONTEXT).where("id is not null")
    once = df.groupBy("id").agg(F.min(F.struct("seq", "text", *dd.CONTEXT)).alias("m")).select("id", "m.*")  # rows of one id: the first
    return dd.greedy(once, "id", "text", "seq")


@query()
def dedup_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Order-dependent near-duplicate filter (D3)."""
    return dd.incremental(table(spark, d, POOL, "seq", "text", *dd.CONTEXT), "seq", "text", "seq")


@query(f"SELECT seq, CASE WHEN length(f) <= 6 THEN len(list_distinct(list_filter(string_split(f, ''), lambda x: x <> ''))) ELSE len(list_distinct(list_transform(range(1, length(f) - 1), lambda i: substr(f, i, 3)))) END AS shingles FROM (SELECT seq, {_DEDUP} AS f FROM {POOL})")
def shingle_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of shingle sets."""
    return table(spark, d, POOL, "seq", "text").select("seq", F.size(t.shingles(t.dedup_form("text"))).alias("shingles"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) - 1) // 64 AS batch FROM documents")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 64 by descending length."""
    return o.chunked(table(spark, d, "documents", "doc_id", "n_chars"), "n_chars", 64, "batch", descending=True, tie="doc_id").select("doc_id", "batch")


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents) SELECT doc_id, (r % 7)::INT AS worker, floor(r / ceil((SELECT count(*) FROM documents) / 5))::INT AS slice FROM n")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    """Round-robin workers and contiguous slices."""
    df = table(spark, d, "documents", "doc_id")
    return o.contiguous(o.round_robin(df, "doc_id", 7), "doc_id", 5).select("doc_id", "worker", "slice")


@query("SELECT (row_number - 1) // 100 AS shard, count(*) AS items, round(sum(s), 3) AS seconds FROM (SELECT row_number() OVER (ORDER BY doc_id) AS row_number, coalesce(n_chars, 0) / 15 AS s FROM documents) GROUP BY 1")
def shard_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Shards of 100 rows with items and seconds (K8, K9)."""
    df = table(spark, d, "documents", "doc_id", "n_chars").withColumn("s", F.coalesce("n_chars", F.lit(0)) / 15)
    return o.shard_manifest(df, "doc_id", "s", 100)


@query("SELECT (row_number - 1) // 100 AS shard, count(*) AS items, round(sum(n_chars / 15), 3) AS seconds FROM (SELECT row_number() OVER (ORDER BY doc_id) AS row_number, n_chars FROM documents WHERE text IS NOT NULL AND text <> '' AND n_chars > 0) GROUP BY 1")
def success_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards of 100 successes: rows without a text or a length don't fill one (K9)."""
    df = table(spark, d, "documents", "doc_id", "n_chars", "text").withColumn("s", F.col("n_chars") / 15)
    return o.shard_manifest(df, "doc_id", "s", 100, ok=(F.col("text") != "") & (F.col("n_chars") > 0))


@query("SELECT CASE WHEN x >= 10 AND x <= 1500 THEN " + " + ".join(f"(x > {10 + 1490 * k / 20})::INT" for k in range(1, 20)) + " END AS bucket, count(*) AS n FROM (SELECT n_chars AS x FROM documents) GROUP BY 1")
def length_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Documents per length bucket, null outside."""
    return table(spark, d, "documents", "n_chars").groupBy(v.bucket(F.col("n_chars").cast("double"), 10, 1500, 20).alias("bucket")).agg(F.count("*").alias("n"))


_BUCKET = " + ".join(f"(x > {10 + 1490 * k / 20})::INT" for k in range(1, 20))


@query("SELECT bucket, 0 AS part, unnest(ids) AS doc_id, unnest(f.out) AS batch FROM (SELECT bucket, ids, list_reduce(xs, lambda a, x: CASE WHEN greatest(a.top, x) * (a.n + 2) >= 20000 OR a.n + 1 >= 32 "
       "THEN {'top': 0.0::DOUBLE, 'n': 0, 'b': a.b + 1, 'out': list_append(a.out, a.b)} ELSE {'top': greatest(a.top, x), 'n': a.n + 1, 'b': a.b, 'out': list_append(a.out, a.b)} END, {'top': 0.0::DOUBLE, 'n': 0, 'b': 0, 'out': []::INT[]}) AS f "
       f"FROM (SELECT {_BUCKET} AS bucket, list(doc_id ORDER BY doc_id) AS ids, list(x ORDER BY doc_id) AS xs FROM (SELECT doc_id, n_chars::DOUBLE AS x FROM documents) WHERE x BETWEEN 10 AND 1500 GROUP BY 1))")  # fmt: skip
def bucket_batches(spark: SparkSession, d: str) -> DataFrame:
    """Length-bucket batches under a budget (B1)."""
    return b.bucketed(table(spark, d, "documents", "doc_id", F.col("n_chars").cast("double").alias("length")), "doc_id", "length", "doc_id", 10, 1500, 20, 20000, 32)


_FIT = "list_reduce(xs, lambda a, x: CASE WHEN a.used + x > {0} {1} THEN {{'used': x, 'n': a.n + 1, 'out': list_append(a.out, a.n + 1)}} ELSE {{'used': a.used + x, 'n': a.n, 'out': list_append(a.out, a.n)}} END, {{'used': 0.0::DOUBLE, 'n': 0, 'out': []::INT[]}})"


@query(f"SELECT 0 AS part, unnest(ids) AS doc_id, unnest(f.out) AS pack FROM (SELECT ids, {_FIT.format(4000, '')} AS f FROM (SELECT list(doc_id ORDER BY doc_id) AS ids, list(x ORDER BY doc_id) AS xs FROM (SELECT doc_id, n_chars::DOUBLE AS x FROM documents WHERE n_chars <= 4000)))")
def packed(spark: SparkSession, d: str) -> DataFrame:
    """Next-fit packing by length (B2)."""
    return b.packed(table(spark, d, "documents", "doc_id", F.col("n_chars").cast("double").alias("length")), "doc_id", "length", "doc_id", 4000)


@query(f"""WITH p AS (SELECT unnest(ids) AS doc_id, unnest(xs) AS x, unnest(f.out) AS pack FROM (SELECT ids, xs, {_FIT.format(4000, '')} AS f FROM (SELECT list(doc_id ORDER BY doc_id) AS ids, list(x ORDER BY doc_id) AS xs FROM (SELECT doc_id, n_chars::DOUBLE AS x FROM documents WHERE n_chars <= 4000))))
SELECT doc_id, pack, row_number() OVER w - 1 AS document, coalesce(sum(x) OVER (PARTITION BY pack ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS start FROM p WINDOW w AS (PARTITION BY pack ORDER BY doc_id)""")
def pack_positions(spark: SparkSession, d: str) -> DataFrame:
    """Document numbers and positions inside packs."""
    docs = table(spark, d, "documents", "doc_id", F.col("n_chars").cast("double").alias("length"))
    packs = b.packed(docs, "doc_id", "length", "doc_id", 4000).join(docs, "doc_id")
    return b.positions(packs, "doc_id", "length", ["part", "pack"], "doc_id").select("doc_id", "pack", "document", F.col("start").cast("double").alias("start"))


@query(f"SELECT 0 AS range, unnest(ids) AS doc_id, unnest(f.out) AS cluster FROM (SELECT ids, {_FIT.format(20000, 'AND a.used <> 0')} AS f FROM (SELECT list(doc_id ORDER BY x DESC, doc_id) AS ids, list(x ORDER BY x DESC, doc_id) AS xs FROM (SELECT doc_id, n_chars::DOUBLE AS x FROM documents WHERE n_chars IS NOT NULL)))")
def duration_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of similar length under a budget."""
    return b.clustered(table(spark, d, "documents", "doc_id", F.col("n_chars").cast("double").alias("length")), "doc_id", "length", 20000)


@query("SELECT CASE WHEN ref_audio IS NOT NULL AND coalesce(ref_text, '') <> '' THEN 'clone' ELSE 'other' END AS mode, count(*) AS n, count(frames) AS timed FROM reference_audio GROUP BY 1")
def mode_split(spark: SparkSession, d: str) -> DataFrame:
    """References with a text, from which voices are cloned, and the others."""
    df = table(spark, d, "reference_audio", "ref_audio", "ref_text", "frames")
    parts = jn.split_by(df, F.col("ref_audio").isNotNull() & (F.col("ref_text") != ""))
    n = [p.agg(F.count("*").alias("n"), F.count("frames").alias("timed")).select(F.lit(m).alias("mode"), "n", "timed") for m, p in zip(("clone", "other"), parts)]
    return n[0].unionByName(n[1]).where("n > 0")


@query(f"SELECT id, min(seq) AS seq, arg_min(text, seq) AS text FROM {POOL} WHERE id IS NOT NULL GROUP BY 1")
def worker_union(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping outputs of three workers as one table, each id once."""
    df = table(spark, d, POOL, "id", "seq", "text").where("id is not null")
    return jn.merged([df.where(F.pmod("seq", F.lit(3)) == k) for k in range(3)] + [df.where("seq % 10 = 0")], "id", "seq").select("id", "seq", "text")


@query("SELECT doc_id, pos, CASE WHEN pos <= len(c) THEN c[pos] ELSE -1 END AS id, CASE WHEN pos <= len(c) THEN c[pos] ELSE -100 END AS label FROM (SELECT doc_id, c, unnest(range(1, m + 1)) AS pos FROM (SELECT doc_id, c, max(len(c)) OVER (PARTITION BY doc_id // 8) AS m FROM (SELECT doc_id, list_transform(string_split(source, '_'), lambda x: length(x)) AS c FROM documents WHERE source IS NOT NULL)))")
def padded(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a batch padded to its longest."""
    df = table(spark, d, "documents", "doc_id", "source").where("source is not null").select("doc_id", F.transform(F.split("source", "_"), lambda x: F.char_length(x)).alias("c"), F.expr("doc_id div 8").alias("batch"))
    return b.padded(df, "batch", "c", -1, -100).select("doc_id", F.posexplode(F.arrays_zip("ids", "labels")).alias("pos", "z")).select("doc_id", (F.col("pos") + 1).alias("pos"), F.col("z.ids").alias("id"), F.col("z.labels").alias("label"))


@query("SELECT doc_id // 8 AS pack, list(doc_id ORDER BY doc_id) AS ids, sum(n_chars)::BIGINT AS size FROM documents GROUP BY 1")
def pack_rows(spark: SparkSession, d: str) -> DataFrame:
    """Members of a pack in order."""
    df = table(spark, d, "documents", "doc_id", "n_chars").withColumn("pack", F.expr("doc_id div 8"))
    return df.groupBy("pack").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"), F.sum("n_chars").alias("size"))


@query("""WITH c AS (SELECT label, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL) GROUP BY 1)
SELECT vec_id, c.label AS label, round(list_cosine_similarity(e.embedding::DOUBLE[], c.m), 6) AS cosine FROM embeddings e JOIN c ON c.label = e.label""")
def centroid_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Cosine of each vector to its label's centroid (M1)."""
    df = table(spark, d, "embeddings", "vec_id", "embedding", "label")
    long = df.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    c = long.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda z: z["m"]).alias("m"))
    return df.join(c, "label").select("vec_id", "label", F.round(v.cosine(F.transform("embedding", lambda x: x.cast("double")), F.col("m")), 6).alias("cosine"))


@query("SELECT a.vec_id AS query_id, b.vec_id AS vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) DESC, b.vec_id) <= 5")
def nearest_in_label(spark: SparkSession, d: str) -> DataFrame:
    """Five nearest vectors of the label of each query (a row whose id is divisible by 20), against all rows (M1, H1)."""
    return b.nearest(table(spark, d, "embeddings", "vec_id", "embedding", "label"), "vec_id", "embedding", "label", 5)


@query("SELECT k, round(3.0 * (k / 16) / (1 + 2.0 * (k / 16)), 6) AS t FROM (SELECT unnest(range(17)) AS k)")
def time_steps(spark: SparkSession, d: str) -> DataFrame:
    """Shifted time steps."""
    return spark.range(1).select(F.posexplode(v.time_steps(16, 3.0)).alias("k", "t")).select("k", F.round("t", 6).alias("t"))


@query("SELECT cloned_audio, score_version, CASE WHEN score_version = 1 THEN 2 * similarity - 1 ELSE similarity END AS cosine FROM sim WHERE NOT isnan(similarity)")
def legacy_scores(spark: SparkSession, d: str) -> DataFrame:
    """Version 1 scores on the cosine scale (M2)."""
    c = F.when(F.col("score_version") == 1, 2 * F.col("similarity") - 1).otherwise(F.col("similarity"))
    return table(spark, d, "sim", "cloned_audio", "score_version", "similarity").where("similarity is not null and not isnan(similarity)").select("cloned_audio", "score_version", c.alias("cosine"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, json_object('event', event_type, 'k', (props->>'k')::BIGINT)::VARCHAR AS record FROM events")
def json_columns(spark: SparkSession, d: str) -> DataFrame:
    """JSON read and written; nulls are left out."""
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events", "event_id", "event_type", "props").select("event_id", k.alias("k"), F.to_json(F.struct(F.col("event_type").alias("event"), k.alias("k"))).alias("record"))


@query("""WITH m AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events), o AS (SELECT user_id, max_by(event_type, (ts, event_id)) AS status, count(*) AS attempts FROM events, m WHERE ts < half GROUP BY 1),
n AS (SELECT user_id, max_by(event_type, (ts, event_id)) AS status FROM events, m WHERE ts >= half GROUP BY 1)
SELECT user_id, coalesce(n.status, o.status) AS status, coalesce(o.attempts, 0) + (n.user_id IS NOT NULL)::INT AS attempts FROM o FULL JOIN n USING (user_id)""")
def task_upsert(spark: SparkSession, d: str) -> DataFrame:
    """States of the first half of the events, merged with the results of the second: statuses replaced, attempts counted."""
    ev = table(spark, d, "events", "user_id", "event_id", "event_type", "ts")
    half = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).select((F.col("lo") + (F.col("hi") - F.col("lo")) / 2).alias("half"))
    rows = ev.crossJoin(F.broadcast(half))
    last = F.max_by("event_type", F.struct("ts", "event_id")).alias("status")
    return jn.attempted(rows.where("ts < half").groupBy("user_id").agg(last, F.count("*").alias("attempts")), rows.where("ts >= half").groupBy("user_id").agg(last), "user_id")


@query()
def normalized_texts(spark: SparkSession, d: str) -> DataFrame:
    """Strict and safe normal forms of references."""
    lang = t.tag_language("text", "language", "lang_type")[0]
    return spread(table(spark, d, POOL, "seq", "text", "language", "lang_type")).select("seq", normalize.normalized_strict("text").alias("strict"), normalize.reference_form("text", lang).alias("safe"))


@query()
def html_forms(spark: SparkSession, d: str) -> DataFrame:
    """Decoded entities."""
    return spread(table(spark, d, "documents", "doc_id", "text")).select("doc_id", normalize.html_decoded("text").alias("decoded"))


@query()
def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks at punctuation, one row each."""
    return spread(table(spark, d, "documents", "doc_id", "text")).select("doc_id", F.posexplode(speech.chunked("text", 200, 40)).alias("pos", "chunk"))


# Weights of the scripts that the tables hold, written down apart from the function's.
_WEIGHT = """CASE WHEN regexp_matches(c, '\\p{M}') THEN 0.0 WHEN regexp_matches(c, '[\\p{P}\\p{S}]') THEN 0.5 WHEN regexp_matches(c, '\\p{Z}') THEN 0.2 WHEN regexp_matches(c, '\\p{N}') THEN 3.5 WHEN unicode(c) BETWEEN 7936 AND 12543 THEN 2.2 WHEN unicode(c) BETWEEN 12592 AND 12687 THEN 2.5
WHEN unicode(c) BETWEEN 12544 AND 40959 THEN 3.0 WHEN unicode(c) BETWEEN 44032 AND 55215 THEN 2.5 WHEN unicode(c) BETWEEN 63744 AND 64255 OR unicode(c) > 131072 THEN 3.0 ELSE 1.0 END::DOUBLE"""


@query(f"""WITH w AS (SELECT seq, text, coalesce(list_sum(list_transform(string_split(text, ''), lambda c: CASE WHEN c = '' THEN 0.0::DOUBLE ELSE {_WEIGHT} END)), 0) AS weight FROM {POOL}), x AS (SELECT *, coalesce(weight, 0) / 14.1 AS x FROM w)
SELECT seq, CASE WHEN text IS NOT NULL THEN round(weight, 6) END AS weight, round(CASE WHEN x > 0 AND x < 50 THEN 50 * (x / 50) ** (1.0::DOUBLE / 3) ELSE x END, 6) AS seconds FROM x""")
def estimated_durations(spark: SparkSession, d: str) -> DataFrame:
    """Spoken weight and estimated seconds of texts (M3-M5)."""
    df = spread(table(spark, d, POOL, "seq", "text"))
    return df.select("seq", F.round(speech.spoken_weight("text"), 6).alias("weight"), F.round(speech.estimated_seconds("text", F.lit("Nice to meet you."), F.lit(1.0)), 6).alias("seconds"))


@query("SELECT source, count(*) AS n FROM (SELECT source, unnest(range(greatest(1, (doc_id % 3)::INT))) FROM documents) GROUP BY 1")
def repeated_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows repeated by a factor of their own."""
    return table(spark, d, "documents", "source", "doc_id").select("source", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), (F.col("doc_id") % 3).cast("int"))))).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT coalesce(id, 'text_' || lpad(seq::VARCHAR, 6, '0')) AS id, coalesce(scenario, subscene, '') AS scenario, coalesce(language, 'zh') AS language FROM llm_children_100k_asr_complete")
def loaded_texts(spark: SparkSession, d: str) -> DataFrame:
    """Fallbacks of the text loader."""
    return table(spark, d, POOL, "id", "seq", "scenario", "subscene", "language").select(F.coalesce("id", F.concat(F.lit("text_"), F.lpad(F.col("seq").cast("string"), 6, "0"))).alias("id"), F.coalesce("scenario", "subscene", F.lit("")).alias("scenario"), F.coalesce("language", F.lit("zh")).alias("language"))


@query("SELECT speaker_key AS key, max_by(ref_audio, (ref_audio)) AS value FROM reference_audio WHERE speaker_key IS NOT NULL AND ref_audio IS NOT NULL AND NOT regexp_matches(ref_audio, '[ \\t]$') GROUP BY 1")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Lines of speakers and references, written in order and read as a map whose last line wins."""
    lines = table(spark, d, "reference_audio", "speaker_key", "ref_audio").dropna().orderBy("ref_audio").select(F.concat_ws(" ", "speaker_key", "ref_audio").alias("value"))
    path = shared_folder(spark, "lines")
    lines.write.text(path)
    return readers.key_map(spark, path, "lenient")


@query("""WITH a AS (SELECT DISTINCT utt_id, ref_audio FROM reference_audio WHERE utt_id IS NOT NULL AND ref_audio IS NOT NULL), t AS (SELECT utt_id, min(ref_text) AS ref_text FROM reference_audio WHERE ref_text IS NOT NULL GROUP BY 1), s AS (SELECT utt_id, min(speaker_key) AS speaker_key FROM reference_audio WHERE speaker_key IS NOT NULL AND utt_id NOT LIKE '%7' GROUP BY 1)
SELECT a.utt_id AS utt_id, ref_audio, speaker_key, ref_text, '' AS missing FROM a JOIN s USING (utt_id) LEFT JOIN t USING (utt_id) UNION ALL SELECT utt_id, NULL, NULL, NULL, 'speaker' FROM (SELECT utt_id FROM a EXCEPT SELECT utt_id FROM s) UNION ALL SELECT utt_id, NULL, NULL, NULL, 'audio' FROM (SELECT utt_id FROM s EXCEPT SELECT utt_id FROM a)""")
def inventory_join(spark: SparkSession, d: str) -> DataFrame:
    """Audio, texts and speakers of an inventory joined, and what is incomplete (J7); some speakers are left out on purpose."""
    df = table(spark, d, "reference_audio", "utt_id", "ref_audio", "ref_text", "speaker_key").where("utt_id is not null")
    audio, texts = df.where("ref_audio is not null").select("utt_id", "ref_audio").distinct(), df.where("ref_text is not null").groupBy("utt_id").agg(F.min("ref_text").alias("ref_text"))
    whole, lacking = jn.inventory(audio, texts, df.where("speaker_key is not null and utt_id not like '%7'").groupBy("utt_id").agg(F.min("speaker_key").alias("speaker_key")), "utt_id")
    return whole.withColumn("missing", F.lit("")).unionByName(lacking, allowMissingColumns=True).select("utt_id", "ref_audio", "speaker_key", "ref_text", "missing")


@query("SELECT path, list_sort(list(DISTINCT p)) AS parts FROM (SELECT wav AS path, 'eval' AS p FROM eval WHERE stage = 'complete' UNION ALL SELECT cloned_audio, 'sim' FROM sim WHERE similarity > 0.8 AND NOT isnan(similarity) UNION ALL SELECT cloned_audio, 'mos' FROM mos WHERE utmos > 4 AND NOT isnan(utmos)) WHERE path IS NOT NULL GROUP BY 1 HAVING count(DISTINCT p) > 1")
def counted_twice(spark: SparkSession, d: str) -> DataFrame:
    """Clips that more than one inventory counts."""
    parts = {"eval": table(spark, d, "eval", F.col("wav").alias("path"), "stage").where("stage = 'complete'"), "sim": table(spark, d, "sim", F.col("cloned_audio").alias("path"), "similarity").where("similarity > 0.8 and not isnan(similarity)"), "mos": table(spark, d, "mos", F.col("cloned_audio").alias("path"), "utmos").where("utmos > 4 and not isnan(utmos)")}
    return jn.counted_once(parts, "path")


@query("SELECT count(*) FILTER (n_chars >= 50 AND n_chars < 400) AS half_open, count(*) FILTER (n_chars >= 50 AND n_chars <= 400) AS closed, count(*) AS rows FROM documents")
def length_filters(spark: SparkSession, d: str) -> DataFrame:
    """Half-open and closed length filters."""
    df = table(spark, d, "documents", "n_chars")
    return df.agg(F.count_if(jn.half_open("n_chars", 50, 400)).alias("half_open"), F.count_if(F.col("n_chars").between(50, 400)).alias("closed"), F.count("*").alias("rows"))
