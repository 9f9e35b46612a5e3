"""The operators on the driver's tables, each with the same result as SQL.

The tables stand in for observation layers: events are words, spans and windows of their users; orders and customers are
objects and references; boxes and colours are made from keys by rule. The operator code is the library's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import color, geometry, text as tx, timing
from ..operators import audio, edges as eg, equivalence, export, graph, index, intervals as iv, microphones, ocr, package_checks, relationships, search, timeline, transcript, validate
from ..sources import layers
from ..sources.catalog import SEMANTIC, SUPPORT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c: str) -> Column:
    """Microseconds since 1970 of a timestamp without a time zone, whatever the session's zone."""
    t = F.col(c).cast("timestamp_ntz")
    day = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86_400_000_000 + F.hour(t).cast("long") * 3_600_000_000 + F.minute(t).cast("long") * 60_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props", micros("ts").alias("at_us"))


LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
HOUR, MIN = 3_600_000_000, 60_000_000


# --- search and listing ---------------------------------------------------------------------------------------------
@query(f"SELECT doc_id, lang, source FROM documents WHERE position('license' IN {LOWER.format('text')}) > 0 ORDER BY doc_id LIMIT 100")
def find_words(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    return search.find_text(docs, ["text"], "License", ["doc_id"], 100).select("doc_id", "lang", "source")


@query(f"SELECT conv_id, turn, role FROM conversations WHERE position('the' IN {LOWER.format('text')}) > 0 OR position('the' IN {LOWER.format('role')}) > 0 ORDER BY conv_id, turn LIMIT 1")
def find_words_limit_zero(spark, d):
    return search.find_text(table(spark, d, "conversations"), ["text", "role"], "THE", ["conv_id", "turn"], 0).select("conv_id", "turn", "role")


@query("SELECT c_custkey, c_name, CAST(count(o_orderkey) AS BIGINT) AS word_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL")
def list_speakers(spark, d):
    s = table(spark, d, "customer").select(F.col("c_custkey").alias("speaker_id"), "c_name")
    w = table(spark, d, "orders").select(F.col("o_custkey").alias("speaker_id"))
    return search.list_speakers(s, w).select(F.col("speaker_id").alias("c_custkey"), "c_name", "word_count")


COLORS = "SELECT user_id, event_type AS b, count(*) AS n FROM events GROUP BY ALL"


@query(f"""
WITH n AS ({COLORS}), t AS (SELECT user_id, sum(n) AS total FROM n GROUP BY 1),
r AS (SELECT user_id, b, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, b) AS k FROM n)
SELECT r.user_id, b AS dominant_bucket, CAST(total AS BIGINT) AS sampled, round(n / total, 9) AS dominant_coverage, CAST(1.0 AS DOUBLE) AS coverage_total
FROM r JOIN t USING (user_id) WHERE k = 1
""")
def color_summary(spark, d):
    kinds = ("click", "error", "purchase", "signup", "view")
    s = timeline.summarize_samples(events(spark, d), ["user_id"], "event_type", kinds)
    return s.select("user_id", "dominant_bucket", "sampled", F.round(F.element_at("bucket_coverage", F.col("dominant_bucket")), 9).alias("dominant_coverage"), F.round("coverage_total", 6).alias("coverage_total"))


@query(f"""
WITH n AS ({COLORS}), t AS (SELECT user_id, sum(n) AS total FROM n GROUP BY 1),
r AS (SELECT user_id, b, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, b) AS k FROM n)
SELECT r.user_id, b AS dominant_bucket, round(n / total, 9) AS dominant_coverage FROM r JOIN t USING (user_id)
WHERE k = 1 AND position('i' IN b) > 0 AND n / total >= 0.25 ORDER BY user_id LIMIT 50
""")
def list_color_observations(spark, d):
    kinds = ("click", "error", "purchase", "signup", "view")
    s = timeline.summarize_samples(events(spark, d), ["user_id"], "event_type", kinds).withColumn("line_no", F.col("user_id"))
    return search.list_color_observations(s, "I", 0.25, 50).select("user_id", "dominant_bucket", F.round("dominant_coverage", 9).alias("dominant_coverage"))


KINDS = [*SUPPORT, *SEMANTIC, "mentions", "follows"]


def typed_edges(spark, d) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KINDS])
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("line_no"), F.get(names, (F.col("o_orderkey") % len(KINDS)).cast("int")).alias("type"))


_EDGE_SQL = (
    "SELECT o_orderkey AS line_no, list_extract([" + ", ".join(f"'{k}'" for k in KINDS) + f"], CAST(o_orderkey % {len(KINDS)} AS INTEGER) + 1) AS type FROM orders"
)
_CLASS_SQL = "CASE WHEN type IN (" + ", ".join(f"'{k}'" for k in SUPPORT) + ") THEN 'support' WHEN type IN (" + ", ".join(f"'{k}'" for k in SEMANTIC) + ") THEN 'semantic' ELSE 'unknown' END"


@query(f"WITH e AS ({_EDGE_SQL}), c AS (SELECT {_CLASS_SQL} AS k FROM e) SELECT count(*) AS total, count(*) FILTER (k = 'support') AS support, count(*) FILTER (k = 'semantic') AS semantic, count(*) FILTER (k = 'unknown') AS \"unknown\" FROM c")
def relationship_summary(spark, d):
    return search.relationship_summary(typed_edges(spark, d))


@query(f"WITH e AS ({_EDGE_SQL}) SELECT line_no, type, {_CLASS_SQL} AS relationship_class FROM e WHERE {_CLASS_SQL} = 'unknown' ORDER BY line_no LIMIT 100")
def list_relationships(spark, d):
    return search.list_relationships(typed_edges(spark, d), "unknown", 100)


@query(r"SELECT event_type, CAST(count(*) AS BIGINT) AS records, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, CAST(max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_max FROM events GROUP BY 1")
def json_fields(spark, d):
    lines = layers.lines_of(events(spark, d).select("event_id", "event_type", "props"), "props", "event_id")
    typed = lines.select("line_no", layers.int_field(F.col("v"), "k").alias("k"), "malformed").filter(~F.col("malformed"))
    return typed.join(events(spark, d).select(F.col("event_id").alias("line_no"), "event_type"), "line_no").groupBy("event_type").agg(F.count("*").alias("records"), F.sum("k").alias("k_sum"), F.max("k").alias("k_max"))


# --- range aggregations ---------------------------------------------------------------------------------------------
_T0 = "(SELECT min(epoch_us(ts)) FROM events)"
_LOUD = """
WITH w AS (SELECT CAST(user_id AS VARCHAR) AS target_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS e,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE -80 + (event_id * 7) % 75 END AS lufs, -20.0 + event_id % 20 AS peak FROM events),
r AS (SELECT 1704067200000000 AS a, 1704067200000000 + 864000000000 AS b),
o AS (SELECT target_id, lufs, peak, least(e, b) - greatest(s, a) AS ov FROM w, r WHERE e > a AND s < b),
g AS (SELECT target_id, count(*) AS window_count, sum(ov) AS covered_us, 10 * log10(sum(pow(10, lufs / 10.0) * ov) FILTER (lufs > -70) / sum(ov) FILTER (lufs > -70)) - 10 AS gate, max(pow(10, peak / 20.0)) AS pk FROM o GROUP BY 1),
h AS (SELECT o.target_id, 10 * log10(sum(pow(10, lufs / 10.0) * ov) / sum(ov)) AS il FROM o JOIN g USING (target_id) WHERE lufs > -70 AND lufs > gate GROUP BY 1)
SELECT g.target_id, window_count, CAST(covered_us AS BIGINT) AS covered_us, round(il * 10) / 10 AS integrated_lufs, round(20 * log10(pk) * 10) / 10 AS true_peak_dbtp FROM g LEFT JOIN h USING (target_id)
"""
RANGE = (1_704_067_200_000_000, 1_704_067_200_000_000 + 864_000_000_000)


@query(_LOUD)
def loudness_range(spark, d):
    w = events(spark, d).select(
        F.col("user_id").cast("string").alias("target_id"), F.col("at_us").alias("start_us"), (F.col("at_us") + HOUR).alias("end_us"),
        F.when(F.col("event_id") % 11 != 0, (-80 + (F.col("event_id") * 7) % 75).cast("double")).alias("momentary_lufs"), (-20.0 + F.col("event_id") % 20).alias("true_peak_dbtp"),
    )
    return audio.loudness_range(w, *RANGE)


@query("""
WITH w AS (SELECT CAST(label AS VARCHAR) AS target_id, vec_id * 400000 AS s, vec_id * 400000 + 400000 AS e, unnest(embedding) AS db, generate_subscripts(embedding, 1) - 1 AS band FROM embeddings),
o AS (SELECT target_id, band, CAST(db AS DOUBLE) * 10 AS db, least(e, 150000000) - greatest(s, 1100000) AS ov FROM w WHERE band < 10 AND e > 1100000 AND s < 150000000 AND db IS NOT NULL)
SELECT target_id, CAST(band AS INTEGER) AS band, count(*) AS window_count, round(10 * log10(sum(pow(10, db / 10) * ov) / sum(ov)) * 10) / 10 AS mean_db, round(max(db) * 10) / 10 AS max_db FROM o GROUP BY ALL
""")
def spectrum_range(spark, d):
    w = table(spark, d, "embeddings").select(
        F.col("label").cast("string").alias("target_id"), (F.col("vec_id") * 400_000).alias("start_us"), (F.col("vec_id") * 400_000 + 400_000).alias("end_us"),
        F.transform("embedding", lambda v: v.cast("double") * 10).alias("bands"),
    )
    return audio.spectrum_range(w, 1_100_000, 150_000_000)


@query("""
SELECT CAST(user_id AS VARCHAR) AS target_id, CAST(floor(event_id / 50) AS BIGINT) AS "window",
  greatest(-120.0, round(20 * log10(sqrt(avg(value * value))) * 10) / 10) AS rms_db, greatest(-120.0, round(20 * log10(max(abs(value))) * 10) / 10) AS peak_db, count(*) AS samples
FROM events WHERE value > 0 GROUP BY ALL
""")
def waveform_envelope(spark, d):
    s = events(spark, d).filter("value > 0").select(F.col("user_id").cast("string").alias("target_id"), F.col("event_id").alias("i"), "value")
    return audio.envelope(s, 1000).select("target_id", F.col("window").cast("long").alias("window"), "rms_db", "peak_db", "samples")


@query("""
WITH f AS (SELECT CAST(user_id AS VARCHAR) AS target_id, epoch_us(ts) AS at_us, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS v, CAST(event_id % 20 - 20.0 AS DOUBLE) AS p FROM events)
SELECT target_id, CAST(floor(at_us / 86400000000) * 86400000000 AS BIGINT) AS start_us, arg_max(v, at_us) FILTER (v IS NOT NULL) AS momentary_lufs, max(p) AS true_peak_dbtp, count(*) AS frames FROM f GROUP BY ALL
""")
def loudness_windows(spark, d):
    f = events(spark, d).select(F.col("user_id").cast("string").alias("target_id"), "at_us", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("momentary_lufs"), (F.col("event_id") % 20 - 20.0).alias("true_peak_dbtp"))
    return audio.loudness_windows(f, 86_400_000_000).drop("end_us")


# --- intervals ------------------------------------------------------------------------------------------------------
def _spans(spark, d, length: int, kind: str | None = None) -> DataFrame:
    e = events(spark, d)
    if kind:
        e = e.filter(F.col("event_type") == kind)
    return e.select("event_id", "user_id", F.col("at_us").alias("start"), (F.col("at_us") + length).alias("end"))


def _islands_sql(source: str, gap: int) -> str:
    return f"""(SELECT user_id, min(s) AS s, max(e) AS e, count(*) AS parts FROM (
    SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (
      SELECT *, CASE WHEN max(e) OVER w IS NULL OR s - max(e) OVER w > {gap} THEN 1 ELSE 0 END AS n FROM {source}
      WINDOW w AS (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
  GROUP BY user_id, g)"""


def _span_sql(length: int, kind: str | None = None) -> str:
    where = f" WHERE event_type = '{kind}'" if kind else ""
    return f"(SELECT event_id, user_id, epoch_us(ts) AS s, epoch_us(ts) + {length} AS e FROM events{where})"


@query(f"SELECT user_id, s AS \"start\", e AS \"end\", parts FROM {_islands_sql(_span_sql(HOUR), 0)}")
def merge_spans(spark, d):
    return iv.merge_spans(_spans(spark, d, HOUR), ["user_id"], "start", "end").drop("island")


@query(f"SELECT user_id, s AS \"start\", e AS \"end\", parts FROM {_islands_sql(_span_sql(MIN), 6 * HOUR)}")
def sessions(spark, d):
    return iv.merge_spans(_spans(spark, d, MIN), ["user_id"], "start", "end", 6 * HOUR).drop("island")


@query(f"SELECT user_id, CAST(sum(e - s) AS BIGINT) AS covered_us FROM {_islands_sql(_span_sql(4 * HOUR), 0)} GROUP BY 1")
def total_speech(spark, d):
    return iv.union_length(_spans(spark, d, 4 * HOUR), ["user_id"], "start", "end")


@query(f"""
SELECT a.event_id AS word, b.event_id AS segment, least(a.e, b.e) - greatest(a.s, b.s) AS overlap_us
FROM {_span_sql(HOUR, 'click')} a JOIN {_span_sql(2 * HOUR, 'purchase')} b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e
""")
def overlap_join(spark, d):
    a = _spans(spark, d, HOUR, "click").select("user_id", F.col("event_id").alias("word"), F.col("start").alias("l_start"), F.col("end").alias("l_end"))
    b = _spans(spark, d, 2 * HOUR, "purchase").select("user_id", F.col("event_id").alias("segment"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return iv.overlap_join(a, b, 2 * HOUR, ["user_id"]).select("word", "segment", iv.overlap_us(F.col("l_start"), F.col("l_end"), F.col("r_start"), F.col("r_end")).alias("overlap_us"))


@query(f"""
SELECT word, segment FROM (SELECT a.event_id AS word, b.event_id AS segment, row_number() OVER (PARTITION BY a.event_id ORDER BY b.event_id) AS n
FROM {_span_sql(0)} a JOIN {_span_sql(6 * HOUR, 'view')} b ON a.user_id = b.user_id AND b.s <= a.s AND a.s < b.e) WHERE n = 1
""")
def first_segment_of_word(spark, d):
    p = _spans(spark, d, 0).select("user_id", F.col("event_id").alias("word"), F.col("start").alias("at"))
    s = _spans(spark, d, 6 * HOUR, "view").select("user_id", F.col("event_id").alias("segment"), F.col("start").alias("s_start"), F.col("end").alias("s_end"))
    return iv.first_match(p, s, 6 * HOUR, "at", ("s_start", "s_end"), ["word"], "segment", ["user_id"]).select("word", "segment")


@query(f"""
WITH a AS {_islands_sql(_span_sql(3 * HOUR, 'click'), 0)}, b AS {_islands_sql(_span_sql(3 * HOUR, 'view'), 0)},
la AS (SELECT user_id, sum(e - s) AS us FROM a GROUP BY 1), lb AS (SELECT user_id, sum(e - s) AS us FROM b GROUP BY 1),
x AS (SELECT a.user_id, sum(least(a.e, b.e) - greatest(a.s, b.s)) AS us FROM a JOIN b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e GROUP BY 1)
SELECT user_id, CAST(coalesce(x.us, 0) AS BIGINT) AS both_us, CASE WHEN least(coalesce(la.us, 0), coalesce(lb.us, 0)) > 0 THEN round(coalesce(x.us, 0) / least(la.us, lb.us), 9) ELSE 0.0 END AS ratio
FROM la FULL JOIN lb USING (user_id) LEFT JOIN x USING (user_id)
""")
def shared_speech_ratio(spark, d):
    a, b = _spans(spark, d, 3 * HOUR, "click"), _spans(spark, d, 3 * HOUR, "view")
    return iv.shared_ratio(a, b, ["user_id"], 3 * HOUR).withColumn("ratio", F.round("ratio", 9))


@query("""
WITH t AS (SELECT user_id, count(*) * 1000 AS d FROM events GROUP BY 1), c AS (SELECT user_id, d, unnest(range(0, d, 25000)) AS s FROM t)
SELECT user_id, CAST(s / 25000 AS BIGINT) AS ordinal, CAST(s AS BIGINT) AS start_us, CAST(least(s + 30000, d) AS BIGINT) AS end_us, CAST(CASE WHEN s = 0 THEN 0 ELSE least(5000, s) END AS BIGINT) AS overlap_before_us,
  CAST(CASE WHEN s + 25000 < d THEN least(5000, d - s - 25000) ELSE 0 END AS BIGINT) AS overlap_after_us, printf('chunk_%06d', CAST(s / 25000 AS BIGINT)) AS chunk_id FROM c
""")
def chunk_plan(spark, d):
    t = events(spark, d).groupBy("user_id").agg((F.count("*") * 1000).alias("duration_us"))
    return iv.sliding_plan(t, "duration_us", 30_000, 5_000).select("user_id", "ordinal", "start_us", "end_us", "overlap_before_us", "overlap_after_us", "chunk_id")


@query("""
WITH t AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), c AS (SELECT user_id, n, unnest(range(0, n, 16)) AS s FROM t)
SELECT user_id, CAST(s AS BIGINT) AS "start", CAST(least(s + 16, n) AS BIGINT) AS "end", CAST(greatest(s - 4, 0) AS BIGINT) AS process_start, CAST(least(least(s + 16, n) + 4, n) AS BIGINT) AS process_end FROM c
""")
def diarization_windows(spark, d):
    t = events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"))
    return iv.context_windows(t, "n", 16, 4).drop("n")


@query("SELECT user_id, CAST(floor(epoch_us(ts) / 86400000000) * 86400000000 AS BIGINT) AS window_start, count(*) AS n, max(value) AS peak FROM events GROUP BY ALL")
def tumbling_windows(spark, d):
    return iv.tumbling(events(spark, d), "at_us", 86_400_000_000).groupBy("user_id", "window_start").agg(F.count("*").alias("n"), F.max("value").alias("peak"))


@query("SELECT event_type, median(value) AS median_value, count(*) AS n FROM events GROUP BY 1")
def signal_medians(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.percentile("value", 0.5).alias("median_value"), F.count("*").alias("n"))


# --- transcript -----------------------------------------------------------------------------------------------------
@query(f"""
WITH w AS {_span_sql(MIN)}, g AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS s, epoch_us(ts) + {MIN} AS e FROM events WHERE event_type IN ('view', 'purchase')),
p AS (SELECT w.event_id, g.event_type, g.event_id AS seg, least(w.e, g.e) - greatest(w.s, g.s) AS ov,
  CASE WHEN w.e <= g.s THEN g.s - w.e WHEN w.s >= g.e THEN w.s - g.e ELSE 0 END AS dist FROM w JOIN g USING (user_id)),
k AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY CASE WHEN ov > 0 THEN -ov ELSE 1 END, CASE WHEN ov > 0 THEN 0 ELSE dist END, seg) AS n FROM p WHERE ov > 0 OR dist <= 500000)
SELECT w.event_id, coalesce(k.event_type, 'speaker_unknown') AS speaker_id FROM w LEFT JOIN k ON w.event_id = k.event_id AND n = 1
""")
def assign_word_speakers(spark, d):
    e = events(spark, d)
    w = e.select("user_id", F.col("event_id").alias("word_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    s = e.filter("event_type in ('view', 'purchase')").select("user_id", F.col("event_id").alias("seg_no"), F.col("event_type").alias("speaker_id"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    return transcript.assign_speakers(w, s, ["user_id"]).select(F.col("word_no").alias("event_id"), "speaker_id")


@query("""
WITH t AS (SELECT user_id, event_type, sum(event_id % 1000) AS us FROM events GROUP BY ALL)
SELECT user_id, event_type AS dominant FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_type) AS n FROM t WHERE us > 0) WHERE n = 1
""")
def dominant_speaker(spark, d):
    s = events(spark, d).select("user_id", F.col("event_type").alias("speaker_id"), F.lit(0).cast("long").alias("start_us"), (F.col("event_id") % 1000).alias("end_us"))
    return transcript.dominant_speaker(s, ["user_id"])


@query("""
WITH t AS (SELECT user_id, event_type AS speaker_id, CAST(sum(event_id % 1000) AS BIGINT) AS us FROM events GROUP BY ALL), p AS (SELECT *, us / sum(us) OVER (PARTITION BY user_id) AS share FROM t)
SELECT user_id, speaker_id, us, round(share, 9) AS share, max(share) OVER (PARTITION BY user_id) >= 0.95 AS collapse FROM p
""")
def speaker_shares(spark, d):
    s = events(spark, d).select("user_id", F.col("event_type").alias("speaker_id"), F.lit(0).cast("long").alias("start_us"), (F.col("event_id") % 1000).alias("end_us"))
    return transcript.speaker_shares(s, ["user_id"]).withColumn("share", F.round("share", 9))


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
b AS (SELECT *, CASE WHEN lag(event_type) OVER w IN ('purchase') OR epoch_us(ts) - lag(epoch_us(ts)) OVER w > 750000 + 86400000000 THEN 1 ELSE 0 END AS n FROM o WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT event_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS utterance FROM b
""")
def utterances(spark, d):
    w = events(spark, d).select("user_id", F.col("event_id").alias("word_no"), F.when(F.col("event_type") == "purchase", "end.").otherwise("word").alias("text"), F.col("at_us").alias("start_us"), (F.col("at_us") + 86_400_000_000).alias("end_us"))
    return transcript.utterances(w, ["user_id"]).select(F.col("word_no").alias("event_id"), "utterance")


@query()
def decode_speakers(spark, d):
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    w = events(spark, d).select(
        F.col("user_id").alias("stream"), F.col("event_id").alias("word_no"), F.lit("word").alias("text"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"),
        (F.array_position(kinds, F.col("event_type")) - 1).cast("int").alias("segment_speaker"),
        F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.pmod(F.col("event_id") * 13 + k * 29, F.lit(101)) / 101.0 - 0.3).alias("similarity"),
    )
    return transcript.decode_speakers(w, 5)


@query()
def reconcile_chunks(spark, d):
    e = events(spark, d).withColumn("chunk", F.floor(F.col("event_id") / 500).cast("int"))
    begin = e.groupBy(F.col("user_id").alias("stream"), "chunk").agg(F.min("at_us").alias("chunk_start_us")).withColumn("overlap_before_us", F.lit(8 * HOUR))
    w = e.select(F.col("user_id").alias("stream"), "chunk", F.col("event_id").alias("word_no"), F.col("event_type").alias("token"), "at_us").join(begin, ["stream", "chunk"])
    w = w.select("stream", "chunk", "word_no", "token", (F.col("at_us") - F.col("chunk_start_us")).alias("start_us"), (F.col("at_us") - F.col("chunk_start_us") + 8 * HOUR).alias("end_us"))
    return transcript.reconcile_chunks(w, begin)


@query()
def cluster_voices(spark, d):
    o = table(spark, d, "embeddings").select((F.col("vec_id") % 25).alias("stream"), F.col("vec_id").alias("obs_no"), "embedding")
    return transcript.cluster_streams(o)


# --- graph ----------------------------------------------------------------------------------------------------------
def geo_edges(spark, d) -> DataFrame:
    n = table(spark, d, "nation").select((F.col("n_nationkey")).cast("long").alias("edge_idx"), F.lit("frame_in_scene").alias("type"), F.concat(F.lit("nation_"), "n_nationkey").alias("source_id"), F.concat(F.lit("region_"), "n_regionkey").alias("target_id"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") + 1000).alias("edge_idx"), F.lit("near").alias("type"), F.concat(F.lit("supplier_"), "s_suppkey").alias("source_id"), F.concat(F.lit("nation_"), "s_nationkey").alias("target_id"))
    c = table(spark, d, "customer").select((F.col("c_custkey") + 1_000_000_000).alias("edge_idx"), F.lit("lives_in").alias("type"), F.concat(F.lit("customer_"), "c_custkey").alias("source_id"), F.concat(F.lit("nation_"), "c_nationkey").alias("target_id"))
    e = n.unionByName(s).unionByName(c)
    return graph.select_edges(e.select("edge_idx", F.concat(F.lit("rel_"), "edge_idx").alias("relationship_id"), "type", "source_id", "target_id", F.lit(0).cast("long").alias("start_us"), F.col("edge_idx").alias("end_us")))


GEO = """WITH e AS (
  SELECT n_nationkey AS i, 'frame_in_scene' AS type, 'nation_' || n_nationkey AS s, 'region_' || n_regionkey AS t FROM nation
  UNION ALL SELECT s_suppkey + 1000, 'near', 'supplier_' || s_suppkey, 'nation_' || s_nationkey FROM supplier
  UNION ALL SELECT c_custkey + 1000000000, 'lives_in', 'customer_' || c_custkey, 'nation_' || c_nationkey FROM customer)"""


@query(GEO + """, l1 AS (SELECT DISTINCT s AS node FROM e WHERE t = 'region_1'), l2 AS (SELECT DISTINCT s AS node FROM e WHERE t IN (SELECT node FROM l1))
SELECT 'region_1' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM l1 UNION ALL SELECT node, 2 FROM l2 WHERE node NOT IN (SELECT node FROM l1)""")
def traverse(spark, d):
    return graph.traverse(geo_edges(spark, d), "region_1", 2, "incoming").nodes.select("node", "depth")


@query(GEO + """, l1 AS (SELECT i, s AS node, row_number() OVER (ORDER BY i) AS r FROM e WHERE t = 'region_1'),
l2 AS (SELECT e.i, row_number() OVER (ORDER BY r, e.i) + (SELECT count(*) FROM l1) AS k FROM e JOIN l1 ON e.t = l1.node)
SELECT i AS edge_idx, 1 AS depth, r AS edge_rank FROM l1 UNION ALL SELECT i, 2, k FROM l2 WHERE k <= 40""")
def traverse_limited(spark, d):
    return graph.traverse(geo_edges(spark, d), "region_1", 2, "incoming", 40).edges.select("edge_idx", "depth", "edge_rank")


@query(GEO + """, n AS (SELECT t AS nation FROM e WHERE s = 'customer_1'), r AS (SELECT e.i, e.t AS region, n.nation FROM e JOIN n ON e.s = n.nation)
SELECT 1 AS step, e.i AS edge_idx, 'customer_1' AS source, n.nation AS target FROM e JOIN n ON e.s = 'customer_1' AND e.t = n.nation UNION ALL SELECT 2, i, nation, region FROM r""")
def shortest_path(spark, d):
    edges = geo_edges(spark, d)
    goal = edges.filter("source_id = 'customer_1'").first()
    region = edges.filter(F.col("source_id") == goal["target_id"]).first()["target_id"]
    steps = graph.shortest_path(edges, "customer_1", region, 3, "outgoing") or []
    return spark.createDataFrame([(i + 1, s["edge_idx"], s["source"], s["target"]) for i, s in enumerate(steps)], "step int, edge_idx long, source string, target string")


@query(GEO + " SELECT i AS edge_idx, CASE WHEN s = 'nation_3' THEN 'outgoing' ELSE 'incoming' END AS direction, CASE WHEN s = 'nation_3' THEN t ELSE s END AS neighbor FROM e WHERE s = 'nation_3' OR t = 'nation_3' ORDER BY i LIMIT 60")
def context(spark, d):
    return graph.star(geo_edges(spark, d), "nation_3", 60).select("edge_idx", "direction", "neighbor")


@query(GEO + """, o AS (SELECT 'nation_' || n_nationkey AS id FROM nation UNION ALL SELECT 'customer_' || c_custkey FROM customer UNION ALL SELECT 'order_' || o_orderkey FROM orders),
n AS (SELECT s AS node FROM e UNION ALL SELECT t FROM e)
SELECT (SELECT count(*) FROM e) AS total_edges, (SELECT count(*) FROM e WHERE type = 'frame_in_scene') AS support_edges, (SELECT count(*) FROM e WHERE type = 'near') AS semantic_edges,
  (SELECT count(*) FROM e WHERE type = 'lives_in') AS unknown_edges, (SELECT count(DISTINCT node) FROM n) AS total_nodes, (SELECT count(*) FROM n WHERE node NOT IN (SELECT id FROM o)) AS unresolved_endpoints,
  (SELECT count(*) FROM o WHERE id NOT IN (SELECT node FROM n)) AS orphan_objects, (SELECT count(*) FROM o) AS total_objects""")
def graph_health(spark, d):
    ids = lambda t, c, p: table(spark, d, t).select(F.concat(F.lit(p), c).alias("id"))
    objects = ids("nation", "n_nationkey", "nation_").unionByName(ids("customer", "c_custkey", "customer_")).unionByName(ids("orders", "o_orderkey", "order_"))
    return graph.health(geo_edges(spark, d), objects)


@query(GEO + " SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (SELECT s AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT t, 0, 1 FROM e) GROUP BY 1")
def node_degrees(spark, d):
    return graph.node_degrees(geo_edges(spark, d))


@query(GEO + " SELECT CASE type WHEN 'frame_in_scene' THEN 'support' WHEN 'near' THEN 'semantic' ELSE 'unknown' END AS relationship_class, type, count(*) AS edges FROM e WHERE 0 <= 5000 AND CASE WHEN i = 0 THEN 0 = 5000 ELSE 5000 < i END GROUP BY ALL")
def edges_at_a_time(spark, d):
    e = geo_edges(spark, d)
    return graph.type_histogram(e.filter(iv.in_window(F.col("start_us"), F.col("end_us"), at_us=5000)))


# --- relationship builders ------------------------------------------------------------------------------------------
def regions(spark, d) -> DataFrame:
    """Boxes of line items: an order is a frame, a part an entity."""
    x, y = (F.col("l_partkey") % 90) / 100.0, (F.col("l_suppkey") % 90) / 100.0
    w, h = (F.col("l_linenumber") % 5 + 1) / 50.0, (F.col("l_quantity") % 4 + 1) / 50.0
    return table(spark, d, "lineitem").select(
        F.concat("l_orderkey", F.lit("_"), "l_linenumber").alias("id"), F.concat(F.lit("f"), "l_orderkey").alias("frame_id"), F.concat(F.lit("e"), F.col("l_partkey") % 500).alias("entity_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"), (F.col("l_orderkey") * 1000).alias("pts_us"), F.array(x, y, x + w, y + h).alias("box_norm"),
    )


REGIONS = """r AS (SELECT l_orderkey || '_' || l_linenumber AS id, 'f' || l_orderkey AS frame_id, 'e' || (l_partkey % 500) AS entity_id, l_orderkey * 10 + l_linenumber AS line_no, l_orderkey * 1000 AS pts_us,
  (l_partkey % 90) / 100.0::DOUBLE AS x0, (l_suppkey % 90) / 100.0::DOUBLE AS y0, (l_partkey % 90) / 100.0::DOUBLE + (l_linenumber % 5 + 1) / 50.0::DOUBLE AS x1, (l_suppkey % 90) / 100.0::DOUBLE + (l_quantity % 4 + 1) / 50.0::DOUBLE AS y1 FROM lineitem)"""


@query(f"""WITH {REGIONS}
SELECT a.id AS source_id, b.id AS target_id FROM r a JOIN r b ON a.frame_id = b.frame_id AND a.line_no < b.line_no AND a.id <> b.id
WHERE (least(a.x1, b.x1) <= greatest(a.x0, b.x0) OR least(a.y1, b.y1) <= greatest(a.y0, b.y0))
  AND sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2)) <= 0.15""")
def near_regions(spark, d):
    return eg.near_regions(9, regions(spark, d)).select("source_id", "target_id")


@query(f"""WITH {REGIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY pts_us, line_no) AS a, row_number() OVER (PARTITION BY entity_id ORDER BY pts_us DESC, line_no) AS z FROM r)
SELECT 'enters_frame' AS type, entity_id AS source_id, frame_id AS target_id, pts_us AS start_us FROM f WHERE a = 1
UNION ALL SELECT 'exits_frame', l.entity_id, l.frame_id, l.pts_us FROM f l JOIN f s ON l.entity_id = s.entity_id AND l.z = 1 AND s.a = 1 AND l.frame_id <> s.frame_id""")
def enters_exits(spark, d):
    r = regions(spark, d)
    return eg.enters_exits(10, r, r.select(F.col("entity_id").alias("id")), r.select(F.col("frame_id").alias("id"))).select("type", "source_id", "target_id", "start_us")


@query(f"""WITH {REGIONS}, b AS (SELECT entity_id, min(line_no) AS f, max(line_no) AS l, count(*) AS n FROM r GROUP BY 1 HAVING count(*) >= 2),
m AS (SELECT b.entity_id, (q.x0 + q.x1) / 2 - (p.x0 + p.x1) / 2 AS dx, (q.y0 + q.y1) / 2 - (p.y0 + p.y1) / 2 AS dy FROM b JOIN r p ON p.line_no = b.f AND p.entity_id = b.entity_id JOIN r q ON q.line_no = b.l AND q.entity_id = b.entity_id),
d AS (SELECT *, sqrt(dx * dx + dy * dy) AS d FROM m)
SELECT 'stationary_relative_to_camera' AS type, entity_id AS source_id, entity_id AS target_id FROM d WHERE d <= 0.02
UNION ALL SELECT 'moves_with', a.entity_id, c.entity_id FROM d a JOIN d c ON a.entity_id < c.entity_id AND a.d > 0.02 AND c.d > 0.02 AND sqrt(pow(a.dx - c.dx, 2) + pow(a.dy - c.dy, 2)) <= 0.05""")
def motion(spark, d):
    r = regions(spark, d)
    return eg.motion(19, r, r.select(F.col("entity_id").alias("id"))).select("type", "source_id", "target_id")


@query("SELECT 'word_spoken_by' AS type, CAST(o_orderkey AS VARCHAR) AS source_id, CAST(o_custkey AS VARCHAR) AS target_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def reference_edges(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("speaker_id"), F.col("o_orderkey").alias("line_no"), F.lit(0).alias("start_us"), F.lit(1).alias("end_us"))
    owner = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("cid"))
    return eg.reference_edges(4, rows, "id", "speaker_id", owner, "cid", "rel_word_speaker_", "word_spoken_by", "start_us", "end_us").select("type", "source_id", "target_id")


@query(f"""
WITH w AS (SELECT CAST(event_id AS VARCHAR) AS id, event_id, epoch_us(ts) + {MIN // 2} AS mid FROM events), g AS (SELECT 'seg_' || event_id AS segment_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + {5 * MIN} AS e FROM events WHERE event_type = 'view'),
p AS (SELECT w.event_id, id, segment_id, row_number() OVER (PARTITION BY w.event_id ORDER BY g.event_id) AS n FROM w JOIN g ON s <= mid AND mid < e), x AS (SELECT * FROM p WHERE n = 1)
SELECT 'rel_word_seg_' || lpad(CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR), 6, '0') AS id, row_number() OVER (ORDER BY event_id) AS seq, id AS source_id, segment_id AS target_id FROM x
""")
def numbered_word_segments(spark, d):
    e = events(spark, d)
    w = e.select(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("line_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    s = e.filter("event_type = 'view'").select(F.concat(F.lit("seg_"), "event_id").alias("segment_id"), F.col("event_id").alias("line_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + 5 * MIN).alias("end_us"))
    return eg.number(eg.word_segments(4, w, s)).select("id", "seq", "source_id", "target_id")


@query(f"""
SELECT 'seg_' || a.event_id AS source_id, 'user_' || b.user_id AS target_id FROM {_span_sql(MIN, 'view')} a JOIN {_span_sql(0, 'click')} b ON a.s <= b.s AND b.s < a.e GROUP BY ALL
""")
def segments_while_visible(spark, d):
    e = events(spark, d)
    s = e.filter("event_type = 'view'").select(F.concat(F.lit("seg_"), "event_id").alias("segment_id"), F.col("event_id").alias("line_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    r = e.filter("event_type = 'click'").select(F.concat(F.lit("user_"), "user_id").alias("entity_id"), F.col("event_id").alias("line_no"), F.col("at_us").alias("pts_us"))
    return eg.segments_while_visible(16, s, r).select("source_id", "target_id")


@query(f"""
SELECT CAST(a.event_id AS VARCHAR) AS source_id, CAST(b.event_id AS VARCHAR) AS target_id, greatest(a.s, b.s) AS start_us, least(a.e, b.e) AS end_us FROM {_span_sql(MIN, 'signup')} a JOIN {_span_sql(MIN, 'error')} b ON a.s < b.e AND b.s < a.e
""")
def visible_during_speech(spark, d):
    s = lambda k: events(spark, d).filter(F.col("event_type") == k).select(F.col("event_id").cast("string").alias("id"), F.col("event_id").alias("line_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    return eg.span_overlaps(14, s("signup"), "id", s("error"), "id", "rel_tr_speech_", "visible_during_speech").select("source_id", "target_id", "start_us", "end_us")


# --- text, colour, time ---------------------------------------------------------------------------------------------
_NORM = "translate(regexp_replace(regexp_replace(trim({0}, chr(32) || chr(9) || chr(10) || chr(13)), '[ \\t\\r\\n]+', ' ', 'g'), '([.,;:$!]) ', '\\1', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"SELECT doc_id, md5({_NORM.format('text')}) AS normalized_md5, CAST(length({_NORM.format('text')}) AS INTEGER) AS n FROM documents")
def normalize_text(spark, d):
    t = tx.normalize_text(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(t.cast("binary")).alias("normalized_md5"), F.length(t).alias("n"))


@query(f"SELECT conv_id, turn, {LOWER.format("regexp_replace(text, '[^A-Za-z0-9]', '', 'g')")} AS key FROM conversations")
def alphanumeric_key(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", tx.alphanumeric_key(F.col("text")).alias("key"))


@query("""
WITH p AS (SELECT p_partkey, p_name AS a, lead(p_name) OVER (ORDER BY p_partkey) AS b FROM part), s AS (SELECT *, greatest(length(a), length(b)) AS m, levenshtein(a, b) AS d FROM p WHERE b IS NOT NULL)
SELECT p_partkey, CASE WHEN m = 0 THEN 1.0 WHEN d > floor((1.0 - 0.6) * m) THEN 0.0 ELSE round(1.0 - d / m, 9) END AS similarity FROM s
""")
def text_similarity(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("a"))
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return p.join(q, "p_partkey").select("p_partkey", F.round(tx.similarity(F.col("a"), F.col("b"), 0.6), 9).alias("similarity"))


def _near_sql(a: str, b: str) -> str:
    """near_identical of two ASCII keys."""
    short, long = f"CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END", f"CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END"
    clipped = " OR ".join(f"(length(s) > {f + k} AND 2 * (length(s) - {f + k}) >= length(l) AND position(substr(s, {f + 1}, length(s) - {f + k}) IN l) > 0)" for f in range(3) for k in range(3))
    return f"""SELECT p_partkey, (s = l OR (regexp_replace(s, '[^0-9]', '', 'g') = regexp_replace(l, '[^0-9]', '', 'g') AND ({clipped}
  OR CASE WHEN length(l) = 0 THEN true ELSE levenshtein(s, l) <= floor((1.0 - 0.8)::DOUBLE * length(l)) AND 1.0 - levenshtein(s, l)::DOUBLE / length(l) >= 0.8 END))) AS near
FROM (SELECT p_partkey, {short} AS s, {long} AS l FROM k)"""


_KEY = LOWER.format("regexp_replace({0}, '[^A-Za-z0-9]', '', 'g')")


@query(f"""
WITH p AS (SELECT p_partkey, p_name || (p_partkey % 3) AS a FROM part), q AS (SELECT x.p_partkey, x.a, substr(y.a, 1 + x.p_partkey % 3, 40) AS b FROM p x JOIN p y ON y.p_partkey = x.p_partkey + x.p_partkey % 2),
k AS (SELECT p_partkey, {_KEY.format('a')} AS a, {_KEY.format('b')} AS b FROM q) {_near_sql('a', 'b')}
""")
def near_identical_readings(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.col("p_partkey") % 3).alias("a"))
    y = p.select(F.col("p_partkey").alias("other"), F.col("a").alias("b"))
    q = p.join(y, F.col("other") == F.col("p_partkey") + F.col("p_partkey") % 2).withColumn("b", F.substring("b", (F.col("p_partkey") % 3 + 1).cast("int"), F.lit(40)))
    return q.select("p_partkey", tx.near_identical(tx.alphanumeric_key(F.col("a")), tx.alphanumeric_key(F.col("b"))).alias("near"))


@query("""
SELECT doc_id, md5(array_to_string(list_transform(regexp_extract_all(text, '[A-Za-z0-9$,.]+|[^A-Za-z0-9$,.]+'), lambda t:
  CASE WHEN regexp_matches(t, '[0-9]') AND NOT regexp_matches(t, '[AC-HJ-NP-RT-Za-kmnp-z]') THEN CASE WHEN starts_with(t, 'S') THEN 'S' || translate(substr(t, 2), 'OoIlSB', '001158') ELSE translate(t, 'OoIlSB', '001158') END ELSE t END), '')) AS read_md5
FROM documents
""")
def digit_lookalikes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(tx.read_digit_lookalikes(F.col("text")).cast("binary")).alias("read_md5"))


@query()
def numeric_values(spark, d):
    n = table(spark, d, "documents").select("doc_id", F.posexplode(tx.parse_numeric_values("text")).alias("pos", "n"))
    return n.select("doc_id", "pos", "n.raw_text", "n.numeric_value", "n.number_kind", "n.unit")


_LIN = "CASE WHEN {0} / 255.0 <= 0.04045 THEN {0} / 255.0 / 12.92 ELSE pow(({0} / 255.0 + 0.055) / 1.055, 2.4) END"


@query(f"""
WITH p AS (SELECT p_partkey, CAST((p_partkey * 37) % 256 AS DOUBLE) AS r, CAST((p_partkey * 91) % 256 AS DOUBLE) AS g, CAST((p_partkey * 53 + 11) % 256 AS DOUBLE) AS b FROM part),
q AS (SELECT p_partkey, {_LIN.format('r')} AS r, {_LIN.format('g')} AS g, {_LIN.format('b')} AS b FROM p),
m AS (SELECT p_partkey, cbrt(0.4122214708 * r + 0.5363325363 * g + 0.0514459929 * b) AS l, cbrt(0.2119034982 * r + 0.6806995451 * g + 0.1073969566 * b) AS m, cbrt(0.0883024619 * r + 0.2817188376 * g + 0.6299787005 * b) AS s FROM q),
o AS (SELECT p_partkey, 0.2104542553 * l + 0.7936177850 * m - 0.0040720468 * s AS l, 1.9779984951 * l - 2.4285922050 * m + 0.4505937099 * s AS a, 0.0259040371 * l + 0.7827717662 * m - 0.8086757660 * s AS b FROM m),
h AS (SELECT p_partkey, l, sqrt(a * a + b * b) AS c, CASE WHEN degrees(atan2(b, a)) < 0 THEN degrees(atan2(b, a)) + 360 ELSE degrees(atan2(b, a)) END AS h FROM o)
SELECT p_partkey, CASE WHEN l < 0.12 THEN 'black' WHEN l > 0.92 AND c < 0.08 THEN 'white' WHEN c < 0.05 THEN 'gray' WHEN h >= 20 AND h < 75 AND l >= 0.12 AND l <= 0.60 THEN 'brown' WHEN h < 25 OR h >= 345 THEN 'red'
  WHEN h < 55 THEN 'orange' WHEN h < 85 THEN 'yellow' WHEN h < 165 THEN 'green' WHEN h < 215 THEN 'cyan' WHEN h < 270 THEN 'blue' WHEN h < 310 THEN 'purple' ELSE 'pink' END AS bucket FROM h
""")
def color_buckets(spark, d):
    k = F.col("p_partkey")
    p = table(spark, d, "part").select("p_partkey", color.srgb8_to_oklch((k * 37 % 256).cast("double"), (k * 91 % 256).cast("double"), ((k * 53 + 11) % 256).cast("double")).alias("c"))
    return p.select("p_partkey", color.color_bucket(F.col("c.l"), F.col("c.c"), F.col("c.h")).alias("bucket"))


_DAYS = "SELECT user_id, CAST(floor(epoch_us(ts) / 86400000000) AS BIGINT) AS day, event_type AS b, count(*) AS n FROM events GROUP BY ALL"


@query(f"""
WITH n AS ({_DAYS}), t AS (SELECT user_id, day, sum(n) AS total FROM n GROUP BY ALL), k AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS b),
c AS (SELECT t.user_id, t.day, k.b, coalesce(n.n, 0) / t.total AS v, row_number() OVER (PARTITION BY t.user_id, t.day ORDER BY coalesce(n.n, 0) DESC, k.b) AS r FROM t CROSS JOIN k LEFT JOIN n ON n.user_id = t.user_id AND n.day = t.day AND n.b = k.b),
f AS (SELECT user_id, day, max(b) FILTER (r = 1) AS dominant, count(*) FILTER (v >= 0.05) AS div, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS before FROM c GROUP BY user_id, day),
g AS (SELECT f.*, p.dominant AS pd, p.div AS pv FROM f LEFT JOIN f p ON p.user_id = f.user_id AND p.day = f.before),
l AS (SELECT g.user_id, g.day, sum(abs(a.v - b.v)) AS l1, max(abs(a.v - b.v)) FILTER (a.b = g.pd) AS jump FROM g JOIN c a ON a.user_id = g.user_id AND a.day = g.day JOIN c b ON b.user_id = g.user_id AND b.day = g.before AND b.b = a.b GROUP BY ALL)
SELECT g.user_id, g.day, dominant, (before IS NULL OR dominant <> pd OR l1 > 0.5 OR jump > 0.35 OR abs(div - pv) >= 2) AS boundary FROM g LEFT JOIN l USING (user_id, day)
""")
def scene_boundaries(spark, d):
    kinds = ("click", "error", "purchase", "signup", "view")
    e = events(spark, d).withColumn("day", F.floor(F.col("at_us") / 86_400_000_000).cast("long"))
    s = timeline.summarize_samples(e, ["user_id", "day"], "event_type", kinds)
    return timeline.scene_boundaries(s, ["user_id"], "day", buckets=kinds).select("user_id", "day", "dominant", "boundary")


@query()
def scene_segments(spark, d):
    kinds = ("click", "error", "purchase", "signup", "view")
    e = events(spark, d).withColumn("day", F.floor(F.col("at_us") / 86_400_000_000).cast("long"))
    s = timeline.summarize_samples(e, ["user_id", "day"], "event_type", kinds)
    return timeline.scenes(s, "user_id", "day", "day", 2, buckets=kinds)


_SHOTS = """s AS (SELECT user_id, event_id AS i, event_id * 37 % 5000 + event_id // 3 AS f, event_id * 37 % 5000 + event_id // 3 + 40 AS l FROM events),
n AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY user_id) AS n, lead(f) OVER w AS q FROM s WINDOW w AS (PARTITION BY user_id ORDER BY i)),
d AS (SELECT *, n * (20 + user_id % 50) AS d, CASE WHEN user_id % 50 >= 0 THEN 1 ELSE 0 END AS step FROM n),
b AS (SELECT *, CASE WHEN k = n THEN d ELSE (l + q) // 2 END AS b FROM d),
x AS (SELECT *, CASE WHEN k = n THEN d ELSE k + greatest(0, max(b - k) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING)) END AS c FROM b),
y AS (SELECT *, k + min(c - k) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t FROM x),
z AS (SELECT user_id, i, coalesce(lag(t) OVER (PARTITION BY user_id ORDER BY i), 0) AS from_us, t AS to_us FROM y)"""


def _shots(spark, d) -> DataFrame:
    i = F.col("event_id")
    first = i * 37 % 5000 + F.floor(i / 3)
    s = events(spark, d).select("user_id", i.alias("shot_no"), first.alias("first_us"), (first + 40).alias("last_us"), F.concat(F.lit("shot_"), i).alias("shot_id"), F.array(F.concat(F.lit("f"), i), F.concat(F.lit("f"), i + 1)).alias("frame_ids"))
    return timeline.shot_spans(s, s.groupBy("user_id").agg((F.count("*") * (20 + F.col("user_id") % 50)).alias("duration_us")), ["user_id"])


@query(f"WITH {_SHOTS} SELECT user_id, i AS shot_no, CAST(from_us AS BIGINT) AS from_us, CAST(to_us AS BIGINT) AS to_us FROM z")
def shot_spans(spark, d):
    return _shots(spark, d).select("user_id", "shot_no", "from_us", "to_us")


@query(f"""
WITH {_SHOTS}, c AS (SELECT user_id, event_id // 500 AS scene, event_id // 500 * 500 AS a FROM events GROUP BY ALL),
m AS (SELECT c.user_id, c.scene, z.* EXCLUDE (user_id) FROM c JOIN z ON z.user_id = c.user_id AND (z.i IN (a, a + 3, a + 250) OR z.i + 1 IN (a, a + 3, a + 250)))
SELECT c.user_id, 'scene_' || c.scene AS scene_id, coalesce(string_agg('shot_' || m.i, ',' ORDER BY m.i), '') AS shots, CAST(coalesce(arg_min(m.from_us, m.i), -1) AS BIGINT) AS from_us, CAST(coalesce(arg_max(m.to_us, m.i), -2) AS BIGINT) AS to_us
FROM c LEFT JOIN m USING (user_id, scene) GROUP BY c.user_id, c.scene
""")
def scene_spans(spark, d):
    a = F.floor(F.col("event_id") / 500)
    scenes = events(spark, d).select("user_id", a.alias("n")).distinct().select("user_id", F.concat(F.lit("scene_"), "n").alias("scene_id"), F.lit(-1).cast("long").alias("start_us"), F.lit(-2).cast("long").alias("end_us"),
        F.array(*[F.concat(F.lit("f"), F.col("n") * 500 + k) for k in (0, 3, 250)]).alias("frame_ids"))
    return timeline.scene_spans(scenes, _shots(spark, d), ["user_id"]).select("user_id", "scene_id", F.array_join("shot_ids", ",").alias("shots"), "from_us", "to_us")


@query("""
WITH f AS (SELECT user_id, event_id AS i, 'f' || event_id AS id, event_id % 3 = 0 AS kf FROM events),
r AS (SELECT user_id, CASE WHEN i % 2 = 0 THEN 'scene' ELSE 'shot' END AS ty, i // 100 AS n, list(i ORDER BY i) AS fs FROM f GROUP BY ALL),
e AS (SELECT r.user_id, ty, n, f.* EXCLUDE (user_id) FROM r, unnest(fs) u(x), f WHERE f.i = u.x),
k AS (SELECT *, bool_or(kf) OVER (PARTITION BY user_id, ty, n) AS any_kf FROM e),
t AS (SELECT user_id, 'frame' AS ty, id, 0 AS part, 0 AS n, i AS frame FROM f UNION ALL SELECT user_id, ty, ty || '_' || n, CASE ty WHEN 'scene' THEN 1 ELSE 2 END, n, i FROM k WHERE kf OR NOT any_kf),
p AS (SELECT t.*, b.b, CASE b.b WHEN 'red' THEN frame % 4 WHEN 'blue' THEN frame % 3 ELSE 1 END AS c FROM t, (VALUES ('red'), ('blue'), ('gray')) b(b)),
s AS (SELECT user_id, ty, id, part, n, b, sum(c) AS c FROM p GROUP BY ALL), w AS (SELECT *, sum(c) OVER (PARTITION BY user_id, ty, id) AS total, row_number() OVER (PARTITION BY user_id, ty, id ORDER BY c DESC, b) AS k FROM s WHERE c > 0)
SELECT user_id, ty AS target_type, id AS target_id, b AS dominant_bucket, round(c / total, 9) AS share, printf('color_obs_%06d', row_number() OVER (PARTITION BY user_id ORDER BY part, n, id)) AS color_observation_id FROM w WHERE k = 1
""")
def color_records(spark, d):
    i = F.col("event_id")
    f = events(spark, d).select("user_id", i.alias("i"), F.concat(F.lit("f"), i).alias("frame_id"), (i % 3 == 0).alias("keyframe"), "at_us")
    kind = F.when(F.col("i") % 2 == 0, "scene").otherwise("shot")
    r = f.groupBy("user_id", kind.alias("target_type"), F.floor(F.col("i") / 100).alias("target_no")).agg(F.sort_array(F.collect_list("i")).alias("l"))
    r = r.select("user_id", "target_type", "target_no", F.concat("target_type", F.lit("_"), "target_no").alias("target_id"), F.lit(0).cast("long").alias("start_us"), F.lit(1).cast("long").alias("end_us"), F.transform("l", lambda x: F.concat(F.lit("f"), x)).alias("frame_ids"))
    counts = F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), n.cast("long").alias("n")) for b, n in (("red", F.col("i") % 4), ("blue", F.col("i") % 3), ("gray", F.lit(1)))]))
    pixels = f.select("user_id", "frame_id", counts.alias("c")).select("user_id", "frame_id", "c.bucket", "c.n").filter("n > 0")
    out = timeline.color_records(timeline.color_targets(f, r, ["user_id"]), pixels, ["user_id"], ("red", "blue", "gray"))
    return out.select("user_id", "target_type", "target_id", "dominant_bucket", F.round(F.element_at("bucket_coverage", F.col("dominant_bucket")), 9).alias("share"), "color_observation_id")


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS HUGEINT) * 1001 * 1000000 AS n, CAST(30000 AS HUGEINT) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(n // d + CASE WHEN 2 * (n % d) > d OR (2 * (n % d) = d AND (n // d) % 2 = 1) THEN 1 ELSE 0 END AS BIGINT) AS us FROM v
""")
def pts_to_microseconds(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", timing.pts_to_microseconds(F.col("l_partkey"), F.lit(1001), F.lit(30000)).alias("us"))


@query("""
WITH v AS (SELECT o_orderkey, (o_orderkey * 7919 - 500000) AS us FROM orders), p AS (SELECT o_orderkey, us, lpad(CAST(abs(us) % 1000000 AS VARCHAR), 6, '0') AS f FROM v)
SELECT o_orderkey, CASE WHEN us < 0 THEN '-' ELSE '' END || CAST(abs(us) // 1000000 AS VARCHAR) || '.' || f[1:3] || regexp_replace(f[4:6], '0+$', '') AS seconds FROM p
""")
def seconds_text(spark, d):
    return table(spark, d, "orders").select("o_orderkey", timing.microseconds_to_seconds(F.col("o_orderkey") * 7919 - 500_000).alias("seconds"))


@query("""
WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 9) AS cosine FROM embeddings, q ORDER BY list_cosine_similarity(embedding::DOUBLE[], q.v) DESC, vec_id LIMIT 20
""")
def nearest_vectors(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    q = [float(x) for x in v.filter("vec_id = 0").first()["e"]]
    return index.nearest(v, q, "vec_id", "e", 20).withColumn("cosine", F.round("cosine", 9))


@query("""
SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS cosine
FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id = a.vec_id + 10
""")
def cosine_pairs(spark, d):
    a = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").alias("x"))
    b = a.select((F.col("vec_id") - 10).alias("vec_id"), "label", F.col("vec_id").alias("other"), F.col("x").alias("y"))
    return a.join(b, ["vec_id", "label"]).select("vec_id", "other", F.round(geometry.cosine_similarity(F.col("x"), F.col("y")), 9).alias("cosine"))


# --- validation, equivalence, index, export -------------------------------------------------------------------------
@query("""
SELECT code, severity, count(*) AS n FROM (
  SELECT 'ERR_INVALID_TIMING' AS code, 'error' AS severity FROM lineitem WHERE l_quantity - 10 <= 0
  UNION ALL SELECT 'ERR_INVALID_REFERENCE', 'error' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
  UNION ALL SELECT 'WARN_LOW_CONFIDENCE', 'warning' FROM lineitem WHERE l_discount > 0.08
  UNION ALL SELECT 'ERR_DUPLICATE_ID', 'error' FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)) GROUP BY ALL
""")
def validation_findings(spark, d):
    li, o, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer").filter("c_acctbal >= 0")
    key = F.concat_ws("_", "l_orderkey", "l_linenumber")
    f = (
        validate.check(li, validate.bad_time(F.lit(10.0), F.col("l_quantity")), "ERR_INVALID_TIMING", "error", key, "end before start")
        .unionByName(validate.unresolved(o, "o_custkey", c, "c_custkey", "ERR_INVALID_REFERENCE", "error", F.col("o_orderkey"), "no such customer"))
        .unionByName(validate.check(li, F.col("l_discount") > 0.08, "WARN_LOW_CONFIDENCE", "warning", key, "low"))
        .unionByName(validate.duplicates(li, ["l_orderkey", "l_partkey"], "ERR_DUPLICATE_ID", "error", "repeated"))
    )
    return f.groupBy("code", "severity").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT 'warning' AS severity FROM lineitem WHERE l_discount > 0.08 UNION ALL SELECT 'error' FROM lineitem WHERE l_quantity > 49)
SELECT 0::BIGINT AS infos, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') AS errors, 0::BIGINT AS fatals, CASE WHEN count(*) FILTER (severity = 'warning') > 0 THEN 'valid_with_warnings' ELSE 'valid' END AS status FROM f
""")
def validation_status(spark, d):
    li = table(spark, d, "lineitem")
    f = validate.check(li, F.col("l_discount") > 0.08, "WARN_A", "warning", F.col("l_orderkey"), "a").unionByName(validate.check(li, F.col("l_quantity") > 49, "ERR_B", "error", F.col("l_orderkey"), "b"))
    return validate.status(f, ("WARN_A",))


@query("""
WITH w AS (SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS e FROM events), r AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM w)
SELECT event_id, reach FROM r WHERE s < reach
""")
def overlapping_windows(spark, d):
    w = _spans(spark, d, HOUR)
    return validate.out_of_order(w, "user_id", ["start", "event_id"], "start", "end").select("event_id", "reach")


@query("""
WITH a AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders), b AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 0.05 WHEN o_orderkey % 11 = 0 THEN 5 ELSE 0 END AS o_totalprice, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 17 <> 0),
j AS (SELECT o_orderkey, a.o_totalprice AS p, b.o_totalprice AS q, a.o_orderstatus AS s, b.o_orderstatus AS t, b.o_orderkey IS NULL AS gone FROM a LEFT JOIN b USING (o_orderkey))
SELECT verdict, "column", count(*) AS n FROM (
  SELECT 'only_left' AS verdict, '*' AS "column" FROM j WHERE gone
  UNION ALL SELECT CASE WHEN abs(p - q) > 0.1 THEN 'changed' ELSE 'within_tolerance' END, 'o_totalprice' FROM j WHERE NOT gone AND p <> q
  UNION ALL SELECT 'changed', 'o_orderstatus' FROM j WHERE NOT gone AND s <> t) GROUP BY ALL
""")
def table_differences(spark, d):
    a = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    b = a.filter(k % 17 != 0).withColumn("o_totalprice", F.col("o_totalprice") + F.when(k % 7 == 0, 0.05).when(k % 11 == 0, 5.0).otherwise(0.0)).withColumn("o_orderstatus", F.when(k % 13 == 0, "X").otherwise(F.col("o_orderstatus")))
    return equivalence.compare_tables(a, b, ["o_orderkey"], {"o_totalprice": 0.1}).groupBy("verdict", "column").agg(F.count("*").alias("n"))


@query("""
WITH v AS (SELECT l_returnflag, l_quantity AS a, l_quantity + (l_orderkey % 5) AS b FROM lineitem),
r AS (SELECT *, rank() OVER (PARTITION BY l_returnflag ORDER BY a) + (count(*) OVER (PARTITION BY l_returnflag, a) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY l_returnflag ORDER BY b) + (count(*) OVER (PARTITION BY l_returnflag, b) - 1) / 2.0 AS rb FROM v)
SELECT l_returnflag, round(avg(abs(a - b)), 9) AS mae, quantile_disc(abs(a - b), 0.99) AS p99, round(corr(ra, rb), 6) AS spearman FROM r GROUP BY 1
""")
def depth_metrics(spark, d):
    v = table(spark, d, "lineitem").select("l_returnflag", F.col("l_quantity").alias("a"), (F.col("l_quantity") + F.col("l_orderkey") % 5).alias("b"))
    m = equivalence.depth_metrics(v, ["l_returnflag"], "a", "b")
    return m.select("l_returnflag", F.round("mae", 9).alias("mae"), "p99", F.round("spearman", 6).alias("spearman"))


@query(r"SELECT token, conv_id || '_' || turn AS key, count(*) AS n FROM (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token FROM conversations) GROUP BY 1, 2")
def inverted_index(spark, d):
    c = table(spark, d, "conversations").withColumn("key", F.concat_ws("_", "conv_id", "turn"))
    return index.inverted_index(c, "key", "text").select("token", "key", "n")


@query("SELECT sha256('i' || length(CAST(c_custkey AS VARCHAR)) || ':' || c_custkey || ',t' || length(c_name) || ':' || c_name || ',i' || length(CAST(c_nationkey AS VARCHAR)) || ':' || c_nationkey) AS row_hash FROM customer")
def row_stream(spark, d):
    return index.row_digests(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"))


_T = "{1}' || length(CAST({0} AS VARCHAR)) || ':' || {0} || '"
_PARTS = " || '|' || ".join(f"CAST(coalesce(sum(CAST('0x' || substr(h, {1 + 12 * i}, 12) AS BIGINT)), 0) AS VARCHAR)" for i in range(5))


@query(f"WITH r AS (SELECT sha256('{_T.format('o_orderkey', 'i')},{_T.format('o_custkey', 'i')},{_T.format('o_orderstatus', 't')}') AS h FROM orders) SELECT 'orders' AS \"table\", count(*) AS rows, sha256({_PARTS}) AS digest FROM r")
def table_digest(spark, d):
    return index.table_digest(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "orders")


@query("""
WITH c AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 3 <> 0)
SELECT o_orderkey, c.c_custkey IS NOT NULL AS found, c_name, c_mktsegment FROM orders LEFT JOIN c ON o_custkey = c_custkey
""")
def resolve_references(spark, d):
    owner = table(spark, d, "customer").filter("c_custkey % 3 <> 0")
    r = export.resolve(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", owner, "c_custkey", ["c_name", "c_mktsegment"], "ref")
    return r.select("o_orderkey", "ref.found", "ref.c_name", "ref.c_mktsegment")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS line_no FROM orders")
def line_numbers(spark, d):
    return export.with_line_numbers(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "line_no")


@query()
def reconcile_detections(spark, d):
    det = events(spark, d).select(
        F.col("user_id").alias("package_id"), F.col("event_id").alias("line_no"), F.concat("event_type", F.lit(" "), F.col("event_id") % 3).alias("raw_text"),
        F.array(*[F.lit(v) + (F.col("event_id") % 2) * 2.0 for v in (0.0, 0.0, 40.0, 20.0)]).alias("box"), (F.col("at_us") / 1_000_000).cast("long").alias("at_us"), F.col("event_id").alias("frame"),
        ((F.col("event_id") % 10) / 10.0).alias("confidence"), (F.col("event_id") % 4 == 0).alias("reused"),
    )
    return ocr.reconcile(det, 2)


@query("SELECT 'orders' AS \"table\", count(*) AS rows FROM orders UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'events', count(*) FROM events")
def table_counts(spark, d):
    return export.counts_manifest({n: table(spark, d, n) for n in ("orders", "documents", "events")})


# --- further operators ----------------------------------------------------------------------------------------------
@query(f"SELECT a.event_id AS a, b.event_id AS b FROM {_span_sql(0, 'purchase')} a JOIN {_span_sql(0, 'view')} b ON a.user_id = b.user_id AND abs(a.s - b.s) <= {20 * MIN}")
def band_join(spark, d):
    a = _spans(spark, d, 0, "purchase").select("user_id", F.col("event_id").alias("a"), F.col("start").alias("at"))
    b = _spans(spark, d, 0, "view").select("user_id", F.col("event_id").alias("b"), F.col("start").alias("bt"))
    return iv.band_join(a, b, 20 * MIN, ("at", "bt"), ["user_id"]).select("a", "b")


@query("""
WITH t AS (SELECT user_id, count(*) * 30000 AS d FROM events GROUP BY 1), e AS (SELECT user_id, CASE WHEN d > 100000 THEN d - 100000 ELSE d END AS e FROM t),
g AS (SELECT user_id, e, greatest(25000, e // 40) AS step FROM e), l AS (SELECT user_id, e, list_concat(range(0, e, step), [e]) AS t FROM g)
SELECT user_id, CAST(unnest(CASE WHEN len(t) < 3 THEN list_transform(range(0, 3), lambda i: e * (2 * i + 1) // 6) ELSE t END) AS BIGINT) AS at_us FROM l
""")
def sampling_grid(spark, d):
    t = events(spark, d).groupBy("user_id").agg((F.count("*") * 30_000).alias("d"))
    return timeline.sampling_grid(t, "d", gap=25_000, target=40).select("user_id", "at_us")


@query("""
WITH v AS (SELECT user_id, event_id, CASE WHEN lag(event_id) OVER w IS NOT NULL THEN (event_id * 37 % 100) / 250.0::DOUBLE END AS x FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
w AS (SELECT *, lead(x) OVER k AS n, lead(x, 2) OVER k AS m, lag(x) OVER k AS p FROM v WINDOW k AS (PARTITION BY user_id ORDER BY event_id)),
o AS (SELECT *, coalesce(x >= 0.12 AND n >= 0.12 AND m >= 0.12, false) AND coalesce(p, 0) < 0.12 AS transition FROM w)
SELECT event_id, transition, coalesce((x >= 0.08 AND coalesce(n, 1) <= 0.05) OR x >= 0.30, false) OR transition AS cut FROM o
""")
def visual_cuts(spark, d):
    order = Window.partitionBy("user_id").orderBy("event_id")
    f = events(spark, d).select("user_id", "event_id", F.when(F.lag("event_id").over(order).isNotNull(), (F.col("event_id") * 37 % 100) / 250.0).alias("x"))
    return timeline.visual_cuts(f, ["user_id"], "event_id", "x").select("event_id", "transition", "cut")


@query("""
WITH r AS (SELECT user_id, event_type, epoch_us(ts) AS s, epoch_us(ts) + 10 AS e, value FROM events WHERE user_id % 2 = 1),
g AS (SELECT user_id, event_type, min(s) AS first_seen_us, max(e) AS last_seen_us, count(*) AS regions FROM r GROUP BY ALL)
SELECT user_id AS package_id, event_type AS normalized_text, first_seen_us, last_seen_us, regions, printf('entity_%06d', row_number() OVER (PARTITION BY user_id ORDER BY first_seen_us, event_type)) AS entity_id FROM g
""")
def text_entities(spark, d):
    e = events(spark, d)
    r = e.select(F.col("user_id").alias("package_id"), F.col("event_id").cast("string").alias("text_region_id"), F.col("event_type").alias("normalized_text"), F.col("at_us").alias("start_us"), (F.col("at_us") + 10).alias("end_us"), F.lit(1.0).alias("confidence"), "value").withColumnRenamed("value", "area")
    visual = e.filter("user_id % 2 = 0").select(F.col("user_id").alias("package_id"))
    return ocr.text_entities(r, visual).select("package_id", "normalized_text", "first_seen_us", "last_seen_us", F.size("text_region_ids").cast("long").alias("regions"), "entity_id")


@query()
def repaired_speakers(spark, d):
    e = events(spark, d)
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    number = (F.array_position(kinds, F.col("event_type")) - 1).cast("int")
    w = e.select(F.col("user_id").alias("stream"), F.col("event_id").alias("word_no"), F.when(F.col("event_id") % 4 == 0, "so,").otherwise("word").alias("text"), F.col("at_us").alias("start_us"), (F.col("at_us") + 24 * HOUR).alias("end_us"), number.alias("speaker"))
    g = e.filter("event_type <> 'click'").select(F.col("user_id").alias("stream"), F.col("event_id").alias("seg_no"), (number % 3).alias("speaker"), F.col("at_us").alias("start_us"), (F.col("at_us") + 20 * HOUR).alias("end_us"))
    return transcript.repair_speakers(w, g).select("stream", "word_no", "speaker")


@query(f"""
WITH s AS (SELECT user_id, event_type AS k, epoch_us(ts) AS s, epoch_us(ts) + {HOUR} AS e FROM events),
i AS (SELECT user_id, k, min(s) AS s, max(e) AS e FROM (SELECT *, sum(n) OVER (PARTITION BY user_id, k ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY user_id, k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM s)) GROUP BY user_id, k, g),
t AS (SELECT user_id, k, CAST(sum(e - s) AS BIGINT) AS us FROM i GROUP BY ALL), c AS (SELECT user_id, event_type AS k, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, k AS speaker_id, us AS total_speech_us, n AS word_count, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, k) AS INTEGER) AS rank FROM t JOIN c USING (user_id, k)
""")
def speaker_records(spark, d):
    w = events(spark, d).select("user_id", F.col("event_type").alias("speaker_id"), F.col("at_us").alias("start_us"), (F.col("at_us") + HOUR).alias("end_us"))
    return transcript.speaker_records(w, w, ["user_id"])


@query("""
WITH c AS (SELECT l_orderkey AS o_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS refs FROM lineitem GROUP BY 1)
SELECT o_orderkey, array_to_string(list_transform(refs, lambda r: r || CASE WHEN r % 3 <> 0 THEN ':yes' ELSE ':no' END), ',') AS resolved FROM c
""")
def resolve_reference_lists(spark, d):
    o = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("s"))
    rows = o.select("o_orderkey", F.transform("s", lambda x: x["l_partkey"]).alias("refs"))
    owner = table(spark, d, "part").filter("p_partkey % 3 <> 0").select("p_partkey", "p_name")
    r = export.resolve_list(rows, "o_orderkey", "refs", owner, "p_partkey", ["p_name"], "items")
    text = F.transform("items", lambda x: F.concat(x["ref"].cast("string"), F.when(x["found"], ":yes").otherwise(":no")))
    return r.select("o_orderkey", F.array_join(text, ",").alias("resolved"))


# --- all relationship builders --------------------------------------------------------------------------------------
#: Layers made from the tables, as (table, columns); the same expressions make them in both engines.
LAYERS = {
    "shots": ("nation", "n_nationkey AS line_no, 'shot_' || n_nationkey AS id, n_nationkey * 100000 AS start_us, n_nationkey * 100000 + 100000 AS end_us"),
    "scenes": ("region", "r_regionkey AS line_no, 'scene_' || r_regionkey AS id, r_regionkey * 500000 AS start_us, r_regionkey * 500000 + 500000 AS end_us"),
    "frames": ("supplier", "s_suppkey AS line_no, 'f' || s_suppkey AS id, 'shot_' || s_nationkey AS shot_id, 'scene_' || (s_suppkey % 7) AS scene_id, s_suppkey * 20000 AS pts_us"),
    "speakers": ("region", "r_regionkey AS line_no, 'sp_' || r_regionkey AS id"),
    "words": ("customer", "c_custkey AS line_no, 'w_' || c_custkey AS id, 'sp_' || (c_custkey % 7) AS speaker_id, c_custkey * 1500 AS start_us, c_custkey * 1500 + (c_custkey % 4) * 1000 AS end_us"),
    "segments": ("supplier", "s_suppkey AS line_no, CASE WHEN s_suppkey % 2 = 0 THEN 'seg_' || s_suppkey ELSE '' END AS segment_id, 'seg_' || s_suppkey AS id, s_suppkey * 25000 AS start_us, s_suppkey * 25000 + 30000 AS end_us"),
    "entities": ("nation", "n_nationkey AS line_no, 'e' || n_nationkey AS id"),
    "tracks": ("nation", "n_nationkey AS line_no, 't' || n_nationkey AS id, 'e' || n_nationkey AS entity_id"),
    "regions": ("part", "p_partkey AS line_no, 'r' || p_partkey AS id, 'e' || (p_partkey % 30) AS entity_id, 't' || (p_partkey % 40) AS track_id, 'f' || ((p_partkey - p_partkey % 8) / 8) AS frame_id, "
                "(p_partkey - p_partkey % 8) * 2500 AS pts_us, (p_partkey * 7 % 90) / 100.0 AS x0, (p_partkey * 11 % 90) / 100.0 AS y0, (p_partkey * 7 % 90) / 100.0 + (p_partkey % 5 + 1) / 50.0 AS x1, (p_partkey * 11 % 90) / 100.0 + (p_partkey % 3 + 1) / 25.0 AS y1"),
    "masks": ("customer", "c_custkey AS line_no, 'm_' || c_custkey AS id, 'r' || c_custkey AS region_id"),
    "depth": ("customer", "c_custkey AS line_no, 'd_' || c_custkey AS id, 'f' || (c_custkey % 150) AS frame_id, c_custkey AS start_us, c_custkey + 1 AS end_us"),
    "text_regions": ("customer", "c_custkey AS line_no, 'tr_' || c_custkey AS text_region_id, 'shot_' || (c_custkey % 30) AS shot_id, 'scene_' || (c_custkey % 6) AS scene_id, c_custkey * 1000 AS start_us, "
                     "c_custkey * 1000 + (c_custkey % 3) * 700 AS end_us, 0.5 AS confidence, (c_custkey * 3 % 80) / 100.0 AS x0, (c_custkey * 5 % 80) / 100.0 AS y0, (c_custkey * 3 % 80) / 100.0 + 0.2 AS x1, (c_custkey * 5 % 80) / 100.0 + 0.2 AS y1"),
    "text_observations": ("customer", "c_custkey AS line_no, 'ob_' || c_custkey AS text_observation_id, 'tr_' || (c_custkey + c_custkey % 5) AS text_region_id, c_custkey AS start_us, c_custkey + 1 AS end_us, 0.5 AS confidence, 'crop_' || (c_custkey % 60) AS crop_a, 'crop_' || (c_custkey % 45) AS crop_b"),
    "crops": ("nation", "n_nationkey AS line_no, 'crop_' || n_nationkey AS crop_id"),
    "numeric_values": ("customer", "c_custkey AS line_no, 'nv_' || c_custkey AS numeric_value_id, 'ob_' || (c_custkey * 2) AS text_observation_id, c_custkey AS start_us, c_custkey + 1 AS end_us, 0.5 AS confidence"),
    "colors": ("customer", "c_custkey AS line_no, 'co_' || c_custkey AS color_observation_id, CASE c_custkey % 5 WHEN 0 THEN 'frame' WHEN 1 THEN 'shot' WHEN 2 THEN 'scene' WHEN 3 THEN 'region' ELSE 'other' END AS target_type, "
               "CASE c_custkey % 5 WHEN 0 THEN 'f' || (c_custkey % 130) WHEN 1 THEN 'shot_' || (c_custkey % 30) WHEN 2 THEN 'scene_' || (c_custkey % 7) WHEN 3 THEN 'r' || (c_custkey * 3) ELSE 'x' || c_custkey END AS target_id, c_custkey AS start_us, c_custkey + 1 AS end_us"),
    "embeddings": ("customer", "c_custkey AS line_no, 'em_' || c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'text_observation' WHEN 1 THEN 'text_region' WHEN 2 THEN 'word' ELSE 'image' END AS input_kind, "
                   "CASE c_custkey % 4 WHEN 0 THEN 'ob_' || (c_custkey * 2) WHEN 1 THEN 'tr_' || (c_custkey * 2) WHEN 2 THEN 'w_' || c_custkey ELSE 'picture' END AS input_ref, c_custkey AS start_us, c_custkey + 1 AS end_us"),
}


def package_layers(spark, d) -> dict[str, DataFrame]:
    """The layers as typed views; whole numbers are long, and boxes and lists are arrays."""
    out = {}
    for name, (source, columns) in LAYERS.items():
        df = table(spark, d, source).selectExpr(*[c.strip() for c in _split(columns)])
        for c in df.columns:
            if c == "line_no" or c.endswith("_us"):
                df = df.withColumn(c, F.col(c).cast("long"))
        if name == "regions":
            df = df.withColumn("frame_id", F.concat(F.lit("f"), F.floor(F.col("line_no") / 8).cast("string")))
        if "x0" in df.columns:
            df = df.withColumn("bbox_norm" if name == "text_regions" else "box_norm", F.array(*[F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")])).drop("x0", "y0", "x1", "y1")
        if "crop_a" in df.columns:
            df = df.withColumn("evidence_crop_refs", F.array("crop_a", "crop_b")).drop("crop_a", "crop_b")
        out[name] = df
    return out


def _split(columns: str) -> list[str]:
    """A select list cut at its own commas."""
    out, depth = [""], 0
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


_LAYER_SQL = ", ".join(
    f"{n} AS (SELECT {c.replace('(p_partkey - p_partkey % 8) / 8', 'p_partkey // 8').replace('100.0', '100.0::DOUBLE').replace('50.0', '50.0::DOUBLE').replace('25.0', '25.0::DOUBLE')} FROM {t})" for n, (t, c) in LAYERS.items()
)
_NAMED = "(SELECT line_no, coalesce(nullif(segment_id, ''), id) AS sid, start_us AS s, end_us AS e FROM segments)"
_SEEN = "(SELECT * FROM regions WHERE entity_id IN (SELECT id FROM entities))"


@query(f"""
WITH {_LAYER_SQL},
ends AS (SELECT entity_id, frame_id, row_number() OVER (PARTITION BY entity_id ORDER BY pts_us, line_no) AS a, row_number() OVER (PARTITION BY entity_id ORDER BY pts_us DESC, line_no) AS z
  FROM regions WHERE entity_id IN (SELECT id FROM entities) AND frame_id IN (SELECT id FROM frames)),
path AS (SELECT entity_id, arg_min((x0 + x1) / 2, line_no) AS fx, arg_min((y0 + y1) / 2, line_no) AS fy, arg_max((x0 + x1) / 2, line_no) AS lx, arg_max((y0 + y1) / 2, line_no) AS ly FROM {_SEEN} GROUP BY 1 HAVING count(*) >= 2),
move AS (SELECT entity_id, lx - fx AS dx, ly - fy AS dy, sqrt(pow(lx - fx, 2) + pow(ly - fy, 2)) AS d FROM path),
spoken AS (SELECT w.id, sid, row_number() OVER (PARTITION BY w.line_no ORDER BY g.line_no) AS n FROM words w JOIN {_NAMED} g ON g.s <= (w.start_us + w.end_us) // 2 AND (w.start_us + w.end_us) // 2 < g.e)
SELECT 'appears_in_shot' AS type, text_region_id AS source_id, shot_id AS target_id FROM text_regions WHERE shot_id IN (SELECT id FROM shots)
UNION ALL SELECT 'appears_in_scene', text_region_id, scene_id FROM text_regions WHERE scene_id IN (SELECT id FROM scenes)
UNION ALL SELECT 'observation_in_region', text_observation_id, text_region_id FROM text_observations WHERE text_region_id IN (SELECT text_region_id FROM text_regions)
UNION ALL SELECT 'has_evidence_crop', text_observation_id, crop_a FROM text_observations WHERE crop_a IN (SELECT crop_id FROM crops)
UNION ALL SELECT 'has_evidence_crop', text_observation_id, crop_b FROM text_observations WHERE crop_b IN (SELECT crop_id FROM crops)
UNION ALL SELECT 'numeric_value_from_observation', numeric_value_id, text_observation_id FROM numeric_values WHERE text_observation_id IN (SELECT text_observation_id FROM text_observations)
UNION ALL SELECT 'word_spoken_by', id, speaker_id FROM words WHERE speaker_id IN (SELECT id FROM speakers)
UNION ALL SELECT 'word_in_speaker_segment', id, sid FROM spoken WHERE n = 1
UNION ALL SELECT 'color_observation_of', color_observation_id, target_id FROM colors WHERE CASE target_type WHEN 'frame' THEN target_id IN (SELECT id FROM frames) WHEN 'shot' THEN target_id IN (SELECT id FROM shots)
  WHEN 'scene' THEN target_id IN (SELECT id FROM scenes) WHEN 'region' THEN target_id IN (SELECT id FROM regions) ELSE true END
UNION ALL SELECT 'depth_for_frame', id, frame_id FROM depth WHERE frame_id IN (SELECT id FROM frames)
UNION ALL SELECT 'embedding_source_is', id, input_ref FROM embeddings WHERE CASE input_kind WHEN 'text_observation' THEN input_ref IN (SELECT text_observation_id FROM text_observations) WHEN 'text_region' THEN input_ref IN (SELECT text_region_id FROM text_regions)
  WHEN 'word' THEN input_ref IN (SELECT id FROM words) ELSE true END
UNION ALL SELECT 'appears_in_frame', entity_id, id FROM {_SEEN}
UNION ALL SELECT 'track_observation', track_id, id FROM regions WHERE track_id IN (SELECT id FROM tracks)
UNION ALL SELECT 'region_in_frame', id, frame_id FROM regions WHERE frame_id IN (SELECT id FROM frames)
UNION ALL SELECT 'has_mask', region_id, id FROM masks WHERE region_id IN (SELECT id FROM regions)
UNION ALL SELECT 'near', a.id, b.id FROM regions a JOIN regions b ON a.frame_id = b.frame_id AND a.line_no < b.line_no WHERE (least(a.x1, b.x1) <= greatest(a.x0, b.x0) OR least(a.y1, b.y1) <= greatest(a.y0, b.y0))
  AND sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2)) <= 0.15
UNION ALL SELECT 'enters_frame', entity_id, frame_id FROM ends WHERE a = 1
UNION ALL SELECT 'exits_frame', l.entity_id, l.frame_id FROM ends l JOIN ends f ON l.entity_id = f.entity_id AND l.z = 1 AND f.a = 1 AND l.frame_id <> f.frame_id
UNION ALL SELECT 'text_region_overlaps_entity', text_region_id, entity_id FROM text_regions t JOIN {_SEEN} r ON t.start_us <= pts_us AND pts_us < t.end_us AND least(t.x1, r.x1) > greatest(t.x0, r.x0) AND least(t.y1, r.y1) > greatest(t.y0, r.y0)
UNION ALL SELECT 'frame_in_shot', id, shot_id FROM frames WHERE shot_id IN (SELECT id FROM shots)
UNION ALL SELECT 'frame_in_scene', id, scene_id FROM frames WHERE scene_id IN (SELECT id FROM scenes)
UNION ALL SELECT 'appears_in_shot', entity_id, s.id FROM {_SEEN} r JOIN shots s ON s.start_us <= pts_us AND pts_us < s.end_us
UNION ALL SELECT 'appears_in_scene', entity_id, s.id FROM {_SEEN} r JOIN scenes s ON s.start_us <= pts_us AND pts_us < s.end_us
UNION ALL SELECT 'visible_during_speech', text_region_id, sid FROM text_regions t JOIN {_NAMED} g ON t.start_us < t.end_us AND t.start_us < g.e AND g.s < t.end_us
UNION ALL SELECT 'visible_during_speech', entity_id, sid FROM {_SEEN} r JOIN {_NAMED} g ON g.s <= pts_us AND pts_us < g.e
UNION ALL SELECT 'visible_during_word_range', text_region_id, w.id FROM text_regions t JOIN words w ON t.start_us < t.end_us AND w.start_us < w.end_us AND t.start_us < w.end_us AND w.start_us < t.end_us
UNION ALL SELECT DISTINCT 'speaker_active_during_entity_visible', sid, entity_id FROM {_SEEN} r JOIN {_NAMED} g ON g.s <= pts_us AND pts_us < g.e
UNION ALL SELECT 'stationary_relative_to_camera', entity_id, entity_id FROM move WHERE d <= 0.02
UNION ALL SELECT 'moves_with', a.entity_id, b.entity_id FROM move a JOIN move b ON a.entity_id < b.entity_id AND a.d > 0.02 AND b.d > 0.02 AND sqrt(pow(a.dx - b.dx, 2) + pow(a.dy - b.dy, 2)) <= 0.05
""")
def relationship_builders(spark, d):
    """Builders 1 to 16 and 19 over one package, and one numbering of all their edges."""
    return relationships.build_all(package_layers(spark, d)).select("type", "source_id", "target_id")


# --- masks, depth, documents, microphones, records --------------------------------------------------------------------
@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity AS q FROM lineitem WHERE l_linenumber IS NOT NULL),
p AS (SELECT a.l_orderkey AS o, CASE WHEN a.q < b.q THEN a.l_linenumber ELSE b.l_linenumber END AS f, CASE WHEN a.q < b.q THEN b.l_linenumber ELSE a.l_linenumber END AS k
  FROM d a JOIN d b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.q <> b.q)
SELECT o || '' AS frame_id, f || '' AS source_id, k || '' AS target_id, 'foreground_relative_to' AS type FROM p
UNION ALL SELECT o || '', k || '', f || '', 'background_relative_to' FROM p
""")
def depth_relations(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("frame_id"), F.col("l_linenumber").cast("string").alias("region_id"), F.col("l_linenumber").alias("line_no"), F.col("l_quantity").alias("depth"))
    return eg.depth_relations(rows)


#: Masks of customers: a run of set pixels in a raster of 16 x 4; eight customers share a frame.
_MASK_SQL = "SELECT c_custkey // 8 AS f, c_custkey AS i, c_custkey * 5 % 30 AS a, c_custkey * 5 % 30 + 10 + c_custkey % 24 AS b, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 4 END AS z FROM customer"


@query(f"""
WITH m AS ({_MASK_SQL}), p AS (SELECT x.f, x.i, y.i AS j, x.z, y.z AS w, greatest(0, least(x.b, y.b) - greatest(x.a, y.a)) AS n, x.b - x.a AS nx, y.b - y.a AS ny FROM m x JOIN m y ON x.f = y.f AND x.i < y.i),
q AS (SELECT *, n / (nx + ny - n) >= 0.1 AS alike, n / ny >= 0.8 AS holds, n / nx >= 0.8 AS held, coalesce(z <> w, false) AS deep FROM p WHERE n > 0),
r AS (SELECT f, CASE WHEN z < w THEN i ELSE j END AS s, CASE WHEN z < w THEN j ELSE i END AS t FROM q WHERE alike AND deep), o AS (SELECT * FROM q WHERE NOT (alike AND deep))
SELECT f || '' AS frame_id, s || '' AS source_id, t || '' AS target_id, 'occludes' AS type FROM r UNION ALL SELECT f || '', t || '', s || '', 'occluded_by' FROM r
UNION ALL SELECT f || '', i || '', j || '', 'overlaps' FROM o WHERE alike
UNION ALL SELECT f || '', i || '', j || '', 'contains' FROM o WHERE holds UNION ALL SELECT f || '', j || '', i || '', 'contained_by' FROM o WHERE holds
UNION ALL SELECT f || '', j || '', i || '', 'contains' FROM o WHERE held AND NOT holds UNION ALL SELECT f || '', i || '', j || '', 'contained_by' FROM o WHERE held AND NOT holds
""")
def mask_relations(spark, d):
    c = F.col("c_custkey")
    byte = lambda n: F.expr(f"unhex(lpad(hex({n}), 2, '0'))")
    m = table(spark, d, "customer").select(
        F.floor(c / 8).cast("string").alias("frame_id"), c.cast("string").alias("region_id"), c.alias("line_no"), F.lit(16).alias("width"), F.lit(4).alias("height"),
        F.when(c % 3 > 0, (c % 4).cast("double")).alias("depth"), (c * 5 % 30).alias("a"), (10 + c % 24).alias("n"),
    )
    return eg.mask_relations(m.select("frame_id", "region_id", "line_no", "width", "height", "depth", F.concat(byte("a"), byte("n"), byte("64 - a - n")).alias("rle")))


@query("""
SELECT c_custkey || '' AS key, 'c_name is missing' AS message FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT c_custkey || '', 'c_acctbal is too small' FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey || '', 'c_acctbal is too large' FROM customer WHERE c_acctbal > 9000
UNION ALL SELECT c_custkey || '', 'c_mktsegment is not listed' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT c_custkey || '', 'nation does not match' FROM customer WHERE NOT regexp_matches(CAST(c_nationkey AS VARCHAR), '^1')
""")
def schema_findings(spark, d):
    c = table(spark, d, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 11 != 0, F.col("c_name"))).withColumn("nation", F.col("c_nationkey").cast("string"))
    schema = {"required": ["c_name"], "properties": {"c_acctbal": {"type": "number", "minimum": 0, "maximum": 9000}, "c_mktsegment": {"enum": ["BUILDING", "MACHINERY"]}, "nation": {"pattern": "^1"}}}
    return validate.schema_findings(c, schema, F.col("c_custkey")).select("key", "message")


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_discount * 12 - 0.1 AS c, l_tax * 10 AS x0, l_tax * 10 + l_discount * 5 - 0.2 AS x1, l_linenumber = 7 AS short FROM lineitem)
SELECT l_orderkey, l_linenumber, c < 0 OR c > 1 AS bad_confidence, short OR x0 > 1 OR x1 < 0 OR x1 > 1 OR x0 >= x1 AS bad_box FROM v
""")
def record_rules(spark, d):
    x0, x1 = F.col("l_tax") * 10, F.col("l_tax") * 10 + F.col("l_discount") * 5 - 0.2
    v = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 12 - 0.1).alias("c"), F.when(F.col("l_linenumber") == 7, F.array(x0, F.lit(0.0), x1)).otherwise(F.array(x0, F.lit(0.0), x1, F.lit(1.0))).alias("box"))
    return v.select("l_orderkey", "l_linenumber", validate.bad_confidence(F.col("c")).alias("bad_confidence"), validate.bad_box(F.col("box")).alias("bad_box"))


@query("""
WITH e AS (SELECT event_id AS i, event_id % 5 AS a, CASE WHEN event_id % 7 = 0 THEN event_id % 5 + 1 ELSE event_id % 5 END AS b, event_id % 3 AS n, event_id % 4 AS m, event_id % 10 / 10.0::DOUBLE AS x FROM events)
SELECT i, '/a/v/0' AS pointer, 'changed' AS verdict FROM e WHERE a <> b
UNION ALL SELECT i, '/x', CASE WHEN i % 2 = 0 THEN 'within_tolerance' ELSE 'changed' END FROM e
UNION ALL SELECT i, '/a/v/1', 'only_left' FROM e WHERE n = 1 AND m <> 1 UNION ALL SELECT i, '/a/v/1', 'only_right' FROM e WHERE n <> 1 AND m = 1
UNION ALL SELECT i, '/s', 'changed' FROM e WHERE i % 13 = 0
""")
def json_differences(spark, d):
    i = F.col("event_id")
    doc = lambda first, more, x, s: F.parse_json(F.concat(F.lit('{"a":{"v":['), first, F.when(more, F.lit(",7")).otherwise(F.lit("")), F.lit(']},"x":'), x, F.lit(',"s":'), s, F.lit("}")))
    e = table(spark, d, "events").select("event_id")
    tenth = (i % 10).cast("string")
    left = e.select(i.alias("i"), doc((i % 5).cast("string"), i % 3 == 1, F.concat(F.lit("0."), tenth, F.lit("1")), F.lit("1")).alias("v"))
    right = e.select(i.alias("i"), doc((F.when(i % 7 == 0, i % 5 + 1).otherwise(i % 5)).cast("string"), i % 4 == 1, F.concat(F.lit("0."), tenth, F.when(i % 2 == 0, "15").otherwise("3")), F.when(i % 13 == 0, '"1"').otherwise("1")).alias("v"))
    return equivalence.compare_json(left, right, "v", ["i"], [("^/x$", 0.006)]).select("i", "pointer", "verdict")


_HEARD = "SELECT user_id AS p, event_id % 2 AS src, event_id // 2000 AS c, event_id AS n, event_type AS t, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS e FROM events"


def heard(spark, d) -> DataFrame:
    """Words of two microphones for each user."""
    return events(spark, d).select(
        F.col("user_id").alias("package"), (F.col("event_id") % 2).alias("source"), F.floor(F.col("event_id") / 2000).alias("chunk"), F.col("event_id").alias("word_no"),
        F.when(F.col("event_type") == "purchase", "end.").otherwise(F.col("event_type")).alias("text"), F.col("at_us").alias("start_us"), (F.col("at_us") + HOUR).alias("end_us"), F.lit(0.5).alias("confidence"),
    )


@query(f"""
WITH h AS ({_HEARD}), o AS (SELECT *, CASE WHEN lag(c) OVER w IS NULL OR lag(c) OVER w <> c OR lag(t) OVER w = 'purchase' OR s - lag(e) OVER w > 750000 THEN 1 ELSE 0 END AS new FROM h WINDOW w AS (PARTITION BY p, src ORDER BY c, s, n)),
g AS (SELECT *, sum(new) OVER (PARTITION BY p, src ORDER BY c, s, n ROWS UNBOUNDED PRECEDING) AS turn FROM o)
SELECT p AS package, src AS source, CAST(turn AS BIGINT) AS turn, CAST(min(c) AS BIGINT) AS chunk, min(s) AS start_us, max(e) AS end_us, count(*) AS words FROM g GROUP BY ALL
""")
def microphone_turns(spark, d):
    return microphones.turns(heard(spark, d)).select("package", "source", "turn", "chunk", "start_us", "end_us", "words")


@query(f"""
WITH h AS (SELECT p, src, s, e FROM ({_HEARD})), i AS (SELECT p, src, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY p, src ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY p, src ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM h)) GROUP BY p, src, g),
l AS (SELECT p, src, sum(e - s) AS us FROM i GROUP BY ALL), b AS (SELECT a.p, sum(least(a.e, z.e) - greatest(a.s, z.s)) AS us FROM i a JOIN i z ON a.p = z.p AND a.src = 0 AND z.src = 1 AND a.s < z.e AND z.s < a.e GROUP BY 1)
SELECT b.p AS package, 0 AS source_a, 1 AS source_b, CAST(b.us AS BIGINT) AS both_us, round(b.us / least(x.us, y.us), 9) AS ratio FROM b JOIN l x ON x.p = b.p AND x.src = 0 JOIN l y ON y.p = b.p AND y.src = 1
""")
def microphone_overlap(spark, d):
    return microphones.source_overlap(heard(spark, d)).select("package", "source_a", "source_b", "both_us", F.round("ratio", 9).alias("ratio"))


@query(f"""
WITH h AS ({_HEARD}), c AS (SELECT p, src, count(*) AS n FROM h GROUP BY ALL)
SELECT p AS package, src AS source, n AS word_count, CAST(row_number() OVER (PARTITION BY p ORDER BY n DESC, src) AS INTEGER) AS rank FROM c
""")
def microphone_ranks(spark, d):
    return microphones.source_profile(heard(spark, d)).select("package", "source", "word_count", "rank")


@query(f"""
WITH w AS {_span_sql(MIN)}, g AS (SELECT user_id, event_type, epoch_us(ts) AS s, epoch_us(ts) + {HOUR} AS e FROM events WHERE event_type IN ('view', 'purchase'))
SELECT w.event_id, event_type AS speaker_id, CAST(sum(least(w.e, g.e) - greatest(w.s, g.s)) AS BIGINT) AS overlap_us, round(sum(least(w.e, g.e) - greatest(w.s, g.s)) / {MIN}, 9) AS share
FROM w JOIN g ON w.user_id = g.user_id AND w.s < g.e AND g.s < w.e GROUP BY ALL
""")
def overlap_per_speaker(spark, d):
    e = events(spark, d)
    w = e.select("user_id", F.col("event_id").alias("word_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + MIN).alias("end_us"))
    g = e.filter("event_type in ('view', 'purchase')").select("user_id", F.col("event_type").alias("speaker_id"), F.col("at_us").alias("start_us"), (F.col("at_us") + HOUR).alias("end_us"))
    return transcript.overlap_per_speaker(w, g, ["user_id"]).select(F.col("word_no").alias("event_id"), "speaker_id", "overlap_us", F.round("share", 9).alias("share"))


@query("SELECT event_id, printf('word_%06d', row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts), epoch_us(ts) + event_id % 7, event_id)) AS id FROM events")
def word_records(spark, d):
    w = events(spark, d).select("user_id", F.col("event_id").alias("word_no"), F.col("at_us").alias("start_us"), (F.col("at_us") + F.col("event_id") % 7).alias("end_us"))
    return transcript.word_records(w, ["user_id"]).select(F.col("word_no").alias("event_id"), "id")


@query(f"""
WITH p AS (SELECT p_partkey, {_KEY.format(_NORM.format('left(p_name, CAST(p_partkey % 9 AS INTEGER))'))} AS c, {_KEY.format(_NORM.format('left(p_name, CAST(p_partkey % 13 AS INTEGER))'))} AS r FROM part)
SELECT p_partkey, CASE WHEN length(r) < 3 THEN false WHEN c = '' THEN true WHEN r = c THEN false WHEN length(r) <= length(c) + 2 THEN false WHEN length(c) <= 3 THEN true ELSE position(c IN r) > 0 END AS better FROM p
""")
def roi_text_is_better(spark, d):
    p = table(spark, d, "part")
    cut = lambda n: F.left("p_name", (F.col("p_partkey") % n).cast("int"))
    return p.select("p_partkey", tx.roi_text_is_better(cut(9), cut(13)).alias("better"))


@query("""
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)
SELECT a.vec_id, list_cosine_similarity(a.v, list_transform(a.v, lambda x, i: CASE WHEN i <= a.vec_id % 4 THEN -x ELSE x END)) >= 0.999 AS equal FROM v a
""")
def vectors_equal(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    other = F.transform("v", lambda x, i: F.when(i < F.col("vec_id") % 4, -x).otherwise(x))
    return v.select("vec_id", equivalence.vectors_equal(F.col("v"), other).alias("equal"))


@query("SELECT event_id AS i, CAST(event_id // 7 AS BIGINT) AS f, 'shot_' || (event_id // 100) AS shot FROM events")
def rewrite_frames(spark, d):
    e = table(spark, d, "events").select("event_id")
    catalog = e.select(F.col("event_id").alias("frame_id"), F.floor(F.col("event_id") / 7).alias("f"))
    existing = e.select(F.col("event_id").alias("frame_id"), F.lit(-1).alias("f"), F.concat(F.lit("shot_"), F.floor(F.col("event_id") / 100)).alias("shot"))
    return timeline.rewrite_frames(catalog, existing).select(F.col("frame_id").alias("i"), "f", "shot")


@query("""
WITH r AS (SELECT o_orderkey, o_custkey % 50 AS k FROM orders), s AS (SELECT k, 'seg_' || k AS id FROM (SELECT DISTINCT o_custkey % 50 AS k FROM orders) WHERE k % 2 = 0)
SELECT r.o_orderkey AS i, s.id IS NOT NULL AS found, s.id AS target FROM r LEFT JOIN s USING (k)
""")
def first_record_wins(spark, d):
    """References to records whose ids repeat: the first line of an id is the one that counts."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey") % 50)
    o = o.toDF("o_orderkey", "k")
    later = o.filter("k % 2 = 0").select("k", (F.col("o_orderkey") + 10).alias("line_no"), F.concat(F.lit("late_"), "o_orderkey").alias("id"))
    owner = o.filter("k % 2 = 0").select("k").distinct().select("k", F.lit(-1).cast("long").alias("line_no"), F.concat(F.lit("seg_"), "k").alias("id")).unionByName(later)
    r = export.resolve(o, "k", owner, "k", ["id"], "ref", "line_no")
    return r.select(F.col("o_orderkey").alias("i"), "ref.found", F.col("ref.id").alias("target"))


_CHECKED = package_checks.Registry(observation_types=("caption",), color_buckets=("red", "blue", "green"), color_spaces=("oklch",), sampling_bases=("grid",), bucket_registry_version="1")


def _json_lines(df: DataFrame, entry: str, number: str, value: Column) -> DataFrame:
    """Lines of one layer, as reading them gives."""
    v = F.try_parse_json(value)
    return df.select(F.lit("p").alias("package"), F.lit(entry).alias("entry"), F.col(number).alias("line_no"), v.alias("v"), v.isNull().alias("malformed"))


@query("""
WITH p AS (SELECT p_partkey AS k, p_partkey % 11 / 10.0::DOUBLE AS r, CASE WHEN p_partkey % 3 = 0 THEN 1.0 - p_partkey % 11 / 10.0::DOUBLE ELSE 0.5 END AS b FROM part),
t AS (SELECT *, CASE WHEN r BETWEEN 0 AND 1 THEN r ELSE 0 END + CASE WHEN b BETWEEN 0 AND 1 THEN b ELSE 0 END AS total FROM p),
f AS (SELECT k, 'ERR_COLOR_INVALID_BUCKET_ID' AS code FROM t WHERE k % 5 = 0 UNION ALL SELECT k, 'ERR_COLOR_INVALID_PERCENTAGE_TOTAL' FROM t WHERE abs(total - 1) > 1e-6
  UNION ALL SELECT k, 'ERR_COLOR_INVALID_PERCENTAGE_TOTAL' FROM t WHERE abs(1 - total) > 1e-6 UNION ALL SELECT k, 'ERR_COLOR_INVALID_COLOR_SPACE' FROM t WHERE k % 7 = 0
  UNION ALL SELECT k, 'ERR_COLOR_INVALID_DOMINANT_BUCKET' FROM t WHERE b - r > 1e-6 UNION ALL SELECT k, 'ERR_COLOR_INVALID_PERCENTAGE_BOUNDS' FROM t WHERE b < 0)
SELECT '/colors/color_observations.jsonl:' || k AS path, code FROM f
""")
def color_record_findings(spark, d):
    k = F.col("p_partkey")
    r = (k % 11 / 10.0).cast("double")
    b = F.when(k % 3 == 0, F.lit(1.0) - r).otherwise(F.lit(0.5))
    other = F.when(k % 5 == 0, F.lit("mauve")).otherwise(F.lit("blue"))
    body = F.concat(F.lit('{"bucket_coverage":{"red":'), r.cast("string"), F.lit(',"'), other, F.lit('":'), b.cast("string"), F.lit('},"coverage_total":1.0,"dominant_bucket":"red","color_space":"'), F.when(k % 7 == 0, "rgb").otherwise("oklch"), F.lit('"}'))
    # A few megabytes of keys make a hundred times as much JSON: the file's own parts are too few tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    part = table(spark, d, "part").select("p_partkey").repartition(tasks, "p_partkey")
    lines = _json_lines(part, "colors/color_observations.jsonl", "p_partkey", body)
    return package_checks.color_findings(lines, _CHECKED).select("path", "code")


@query("""
WITH w AS (SELECT event_id AS k, user_id AS u, event_id * 1000 AS s, event_id * 1000 + CASE WHEN event_id % 17 = 0 THEN 0 ELSE 100000 END AS e, event_id % 13 = 0 AS odd FROM events),
r AS (SELECT *, max(e) OVER (PARTITION BY u ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM w),
f AS (SELECT k, 'ERR_MEDIA_INVALID_LOUDNESS_TIMING' AS code FROM r WHERE e <= s UNION ALL SELECT k, 'ERR_MEDIA_INVALID_LOUDNESS_TIMING' FROM r WHERE s < reach UNION ALL SELECT k, 'ERR_MEDIA_INVALID_LOUDNESS_VALUE' FROM r WHERE odd)
SELECT '/media/audio/loudness.jsonl:' || k AS path, code FROM f
""")
def loudness_record_findings(spark, d):
    k = F.col("event_id")
    body = F.concat(F.lit('{"target_id":"'), F.col("user_id"), F.lit('","start_us":'), k * 1000, F.lit(',"end_us":'), k * 1000 + F.when(k % 17 == 0, 0).otherwise(100_000), F.lit(',"momentary_lufs":'), F.when(k % 13 == 0, '"loud"').otherwise("-20.5"), F.lit(',"shortterm_lufs":null,"true_peak_dbtp":-1}'))
    lines = _json_lines(table(spark, d, "events"), "media/audio/loudness.jsonl", "event_id", body)
    none = spark.createDataFrame([], "package string, entry string, content binary")
    return package_checks.loudness_findings(none, lines, _CHECKED).select("path", "code")


@query("""
WITH n AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_partkey % 30 AS f FROM lineitem), g AS (SELECT n_nationkey AS f FROM nation)
SELECT k AS line_no, 'f' || n.f AS ref, g.f IS NOT NULL AS found, CASE WHEN g.f IS NOT NULL THEN CAST(n.f * 3 AS VARCHAR) END AS frame_index FROM n LEFT JOIN g USING (f)
""")
def record_references(spark, d):
    n = table(spark, d, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("long"))
    frames = _json_lines(n, "timeline/frames.jsonl", "n_nationkey", F.concat(F.lit('{"id":"f'), F.col("n_nationkey"), F.lit('","frame_index":'), F.col("n_nationkey") * 3, F.lit(',"pts_us":1}')))
    again = frames.withColumn("line_no", F.col("line_no") + 1000).withColumn("v", F.parse_json(F.concat(F.lit('{"id":"f'), F.col("line_no") - 1000, F.lit('","frame_index":-1}'))))  # a later record of the id
    li = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.concat(F.lit('{"frame_id":"f'), F.col("l_partkey") % 30, F.lit('"}')).alias("body"))
    lines = frames.unionByName(again).unionByName(_json_lines(li, "spatial/regions.jsonl", "k", F.col("body")))
    files = spark.createDataFrame([], "package string, entry string, file string")
    blocks = spark.createDataFrame([], "package string, block_file string, block_offset long, block_ordinal int, decoded_file string, decoded_offset long, decoded_length long")
    return export.resolve_records(lines, files, blocks).select("line_no", "ref", "found", "frame_index")
