"""Queries of sessions: users of the events table are sessions, event types are actions."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from disclosa.operators import sessions
from disclosa.plans.catalog import query, table

ACTION = "CASE event_type WHEN 'click' THEN 'open_document' WHEN 'view' THEN 'research' WHEN 'purchase' THEN 'decision' WHEN 'signup' THEN 'replay' ELSE 'oops' END"
ORDERED = f"o AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, {ACTION} AS action FROM events)"


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), seq.alias("seq"), F.expr(ACTION).alias("action"))


@query(f"""WITH {ORDERED}, p AS (SELECT user_id, seq, action, CASE action WHEN 'open_document' THEN 5 WHEN 'research' THEN 10 WHEN 'decision' THEN 0 WHEN 'replay' THEN 0 END AS price FROM o),
 f AS (SELECT user_id, list_reduce(list_prepend(100, list(coalesce(price, 0) ORDER BY seq)), lambda a, x: CASE WHEN a >= x THEN a - x ELSE a END) AS points, count(*) AS n FROM p GROUP BY 1)
 SELECT user_id, points::BIGINT AS points, n FROM f""")
def action_points_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = sessions.points(actions(spark, sf_dir)).groupBy("session_id").agg(F.max_by("points", "seq").cast("long").alias("points"), F.count("*").alias("n"))
    return p.select(F.col("session_id").alias("user_id"), "points", "n")


@query(f"WITH {ORDERED}, d AS (SELECT user_id, min(seq) AS first FROM o WHERE action = 'decision' GROUP BY 1) SELECT o.user_id, count(*) FILTER (o.action = 'replay' AND (d.first IS NULL OR o.seq < d.first)) AS n_locked, count(*) FILTER (o.action = 'oops') AS n_unknown FROM o LEFT JOIN d USING (user_id) GROUP BY 1")
def replay_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = sessions.points(actions(spark, sf_dir)).groupBy("session_id").agg(F.count_if(F.col("error") == "replay_locked").alias("n_locked"), F.count_if(F.col("error") == "unknown_action").alias("n_unknown"))
    return p.withColumnRenamed("session_id", "user_id")


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 1800000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g) SELECT user_id, no::BIGINT AS session_no, count(*) AS n FROM s GROUP BY 1, 2""")
def session_gap_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.gaps(table(spark, sf_dir, "events"), "user_id", "ts", tie="event_id").groupBy("user_id", "session_no").agg(F.count("*").alias("n"))


@query("WITH l AS (SELECT user_id, max(ts) AS seen FROM events GROUP BY 1) SELECT user_id FROM l WHERE epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(seen) <= 864000000000 ORDER BY seen DESC, user_id DESC LIMIT 50")
def lru_keep_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("session_id")).agg(F.max("ts").cast("timestamp").alias("seen"))
    return sessions.survivors(seen, F.lit("2024-01-31 00:00:00").cast("timestamp"), seconds=864000).select(F.col("session_id").alias("user_id"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS turn FROM events")
def trace_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sessions.trace(table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.col("event_id").alias("seq")))
    return t.select(F.col("session_id").alias("user_id"), F.col("seq").alias("event_id"), F.col("turn").cast("long").alias("turn"))


@query("WITH f AS (SELECT user_id, event_type, min(struct_pack(ts := ts, e := event_id)) AS first FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type, ' ' ORDER BY first) AS items FROM f GROUP BY 1")
def ordered_distinct_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions.first_seen(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])
    return s.select("user_id", F.array_join("items", " ").alias("items"))


KINDS = ("click", "error", "purchase", "signup", "view")
CRITICAL = ("purchase", "signup")
ALL_SQL = "u AS (SELECT DISTINCT user_id FROM events), k AS (SELECT * FROM (VALUES (0, 'click', 'risk', false), (1, 'error', 'finance', false), (2, 'purchase', 'finance', true), (3, 'signup', 'business', true), (4, 'view', 'risk', false)) AS v(o, e, c, crit)), f AS (SELECT DISTINCT user_id, event_type AS e FROM events WHERE value > 50)"


def pool(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(all evidence of every session, what it found): event types with a value above 50 are found."""
    events = table(spark, sf_dir, "events")
    kinds = F.array(*(F.struct(F.lit(i).alias("ordinal"), F.lit(k).alias("evidence_id"), F.lit(c).alias("category"), F.lit("critical" if k in CRITICAL else "normal").alias("importance")) for i, (k, c) in enumerate(zip(KINDS, ("risk", "finance", "finance", "business", "risk"), strict=True))))
    every = events.select(F.col("user_id").alias("session_id")).distinct().select("session_id", F.explode(kinds).alias("k")).select("session_id", "k.*")
    return every, events.where("value > 50").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("evidence_id")).distinct()


@query(f"WITH {ALL_SQL} SELECT u.user_id, k.c AS category, count(f.e) AS checked, count(*) AS total, count(f.e) = count(*) AS covered FROM u CROSS JOIN k LEFT JOIN f ON f.user_id = u.user_id AND f.e = k.e GROUP BY 1, 2")
def perspective_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.summary(*pool(spark, sf_dir)).withColumnRenamed("session_id", "user_id")


@query(f"WITH {ALL_SQL}, r AS (SELECT u.user_id, k.e, row_number() OVER (PARTITION BY u.user_id ORDER BY NOT k.crit, k.o) AS nth FROM u CROSS JOIN k WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = u.user_id AND f.e = k.e)) SELECT user_id, e AS evidence_id FROM r WHERE nth = 1")
def missing_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.remaining(*pool(spark, sf_dir)).where("nth = 1").select(F.col("session_id").alias("user_id"), "evidence_id")


@query("SELECT * FROM (VALUES (1, 'a', 'c', 'd'), (2, 'a b', '', 'c d')) AS v(session_id, supporting, counter, missing)")
def decision_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, ["a", "b"], ["c", "d"], ["a", "c"], ["x"]), (2, ["a", "b"], ["c", "d"], [], ["b", "a"])]
    o = spark.createDataFrame(rows, "session_id long, supporting array<string>, counter array<string>, used array<string>, found array<string>")
    return sessions.decision(o).select("session_id", F.array_join("supporting", " ").alias("supporting"), F.array_join("counter", " ").alias("counter"), F.array_join("missing_counter", " ").alias("missing"))


@query("SELECT * FROM (VALUES (1, 1, 'look at risk', false), (2, 2, 'look for figures on risk', false), (3, 3, 'open Report 2023', true), (4, 1, 'all found', false)) AS v(session_id, level, hint, contains_digits)")
def hint_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.createDataFrame([(1, "risk", "t", 0), (2, "risk", "t", 2), (3, "risk", "Report 2023", 9), (4, None, None, 1)], "session_id long, category string, title string, want int")
    return sessions.hint(t, F.col("want")).select("session_id", F.col("level").cast("long").alias("level"), "hint", "contains_digits")


@query("SELECT DISTINCT user_id, event_type AS evidence_id FROM events WHERE event_type IN ('click', 'view') AND event_id % 2 = 0")
def collect_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence collected by opening a document counts only if it belongs to it."""
    a = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), (F.col("event_id") % 2).alias("document_id"), F.array("event_type").alias("collect"))
    ev = spark.createDataFrame([(0, "click"), (0, "view")], "document_id long, evidence_id string")
    return sessions.collected(a, ev).withColumnRenamed("session_id", "user_id")


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN lang END AS future_events FROM documents JOIN labels USING (doc_id)")
def public_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is not unlocked is hidden."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("future_events")).join(table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("future_unlocked")), "doc_id")
    return sessions.public(d).select("doc_id", "future_events")


def _streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = table(spark, sf_dir, name)
    held = tempfile.mkdtemp(prefix="disclosa-stream-")
    source.write.mode("overwrite").parquet(f"{held}/in")
    return spark.readStream.schema(source.schema).parquet(f"{held}/in"), held


@query("""WITH g AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 1800000000 THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g), c AS (SELECT user_id, no, count(*) AS n, max(ts) AS last FROM s GROUP BY 1, 2)
 SELECT user_id, count(*) AS n_sessions, sum(n)::BIGINT AS n_events FROM c WHERE last + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1""")
def stream_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that a stream over all events has closed."""
    from disclosa.streaming import sessions as streaming

    stream, held = _streamed(spark, sf_dir, "events")
    streaming.run_once(streaming.session_counts(stream, "user_id", "ts"), f"{held}/out", f"{held}/ckpt")
    return spark.read.parquet(f"{held}/out").groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.sum("n").alias("n_events"))
