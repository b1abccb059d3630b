"""Sessions as folds over their actions, in batch; the streaming form of the same rules is in disclosa.streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



#: What an action costs, and the points a session starts with.
COSTS = {"open_document": 5, "research": 10, "hint": 15, "term": 0, "decision": 0, "replay": 0}
START = 100
#: Seconds until an idle session ends, and sessions at a time.
IDLE, SESSIONS = 1800, 50
#: The categories an investigation looks at.
PERSPECTIVES = ("finance", "investment", "business", "risk", "timeline")
HINT_LEVELS = 3


def cost(action: Column) -> Column:
    """Null for an unknown action."""
    return F.create_map(*(F.lit(x) for kv in COSTS.items() for x in kv))[action]


def points(actions: DataFrame, enabled: bool = True) -> DataFrame:
    """session_id, seq, action, accepted, error, points after every action of actions(session_id, seq, action).

    An unknown action and one that costs more than is left change nothing; a replay before a decision is charged (it is
    free) but refused. The turns of a session are folded in order: sequential by nature, a few dozen a session.
    """
    turn = F.struct("seq", "action", *(c for c in ("tie",) if c in actions.columns))
    log = actions.groupBy("session_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    out = "array<struct<seq:bigint,action:string,accepted:boolean,error:string,points:int>>"
    state = F.struct(F.lit(START).alias("left"), F.lit(False).alias("decided"), F.array().cast(out).alias("out"))

    def step(s: Column, t: Column) -> Column:
        price = cost(t["action"]) if enabled else F.when(cost(t["action"]).isNotNull(), 0)
        error = F.when(price.isNull(), "unknown_action").when(s["left"] < price, "no_points").when((t["action"] == "replay") & ~s["decided"], "replay_locked")
        left = F.when(error.isNull() | (error == "replay_locked"), s["left"] - price).otherwise(s["left"])
        row = F.struct(t["seq"].cast("bigint").alias("seq"), t["action"].alias("action"), error.isNull().alias("accepted"), error.alias("error"), left.alias("points"))
        return F.struct(left.alias("left"), (s["decided"] | (error.isNull() & (t["action"] == "decision"))).alias("decided"), F.concat(s["out"], F.array(row)).alias("out"))

    return log.select("session_id", F.explode(F.aggregate("t", state, step, lambda s: s["out"])).alias("r")).select("session_id", "r.*")


def first_seen(events: DataFrame, key: str, item: str, order: list[str]) -> DataFrame:
    """key, items: distinct items in order of first appearance."""
    nth = Window.partitionBy(key, item).orderBy(*order)
    first = events.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1")
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("item")))), lambda x: x["item"]).alias("items"))


def collected(actions: DataFrame, evidence: DataFrame) -> DataFrame:
    """session_id, evidence_id that open_document actions(session_id, seq, document_id, collect) really find: theirs only."""
    asked = actions.select("session_id", "document_id", F.explode("collect").alias("evidence_id"))
    return asked.join(evidence.select("document_id", "evidence_id"), ["document_id", "evidence_id"], "left_semi").select("session_id", "evidence_id").distinct()


def remaining(evidence: DataFrame, found: DataFrame) -> DataFrame:
    """session_id, evidence_id, nth: evidence(session_id, ordinal, evidence_id, importance) not yet found, critical first."""
    open_ = evidence.join(found, ["session_id", "evidence_id"], "left_anti")
    order = Window.partitionBy("session_id").orderBy(F.when(F.col("importance") == "critical", 0).otherwise(1), "ordinal")
    return open_.withColumn("nth", F.row_number().over(order))


def summary(evidence: DataFrame, found: DataFrame) -> DataFrame:
    """session_id, category, checked, total, covered over evidence(session_id, evidence_id, category)."""
    marked = evidence.join(found.withColumn("got", F.lit(True)), ["session_id", "evidence_id"], "left")
    n, got = F.count("*"), F.count_if(F.coalesce("got", F.lit(False)))
    return marked.groupBy("session_id", "category").agg(got.alias("checked"), n.alias("total"), ((n > 0) & (got == n)).alias("covered"))


def decision(options: DataFrame) -> DataFrame:
    """supporting, counter and missing_counter of options(session_id, supporting, counter, used, found); used defaults to found."""
    used = F.when(F.size(F.coalesce("used", F.array().cast("array<string>"))) > 0, F.col("used")).otherwise(F.col("found"))
    return options.withColumn("used", used).select("session_id", F.array_intersect("supporting", "used").alias("supporting"), F.array_intersect("counter", "used").alias("counter"), F.array_except("counter", "used").alias("missing_counter"))


def hint(target: DataFrame, level: Column) -> DataFrame:
    """session_id, level, hint of target(session_id, category, title): a direction, a kind of source, then a title."""
    at = F.greatest(F.lit(1), F.least(F.lit(HINT_LEVELS), level))
    text = F.when(F.col("category").isNull(), "all found").when(at == 1, F.concat(F.lit("look at "), "category")).when(at == 2, F.concat(F.lit("look for figures on "), "category")).otherwise(F.concat(F.lit("open "), "title"))
    return target.select("session_id", at.alias("level"), text.alias("hint"), text.rlike("[0-9]").alias("contains_digits"))


def public(states: DataFrame) -> DataFrame:
    """A session's state as its user may see it: future events only once they are unlocked."""
    return states.withColumn("future_events", F.when(F.col("future_unlocked"), F.col("future_events")))


def gaps(events: DataFrame, key: str, ts: str, seconds: int = IDLE, tie: str | None = None) -> DataFrame:
    """events with session_no: a new session after more than `seconds` of silence."""
    order = Window.partitionBy(key).orderBy(ts, *([tie] if tie else []))
    stamp = F.unix_micros(F.col(ts).cast("timestamp"))
    new = F.coalesce((stamp - F.lag(stamp).over(order)) > seconds * 1_000_000, F.lit(True)).cast("int")
    return events.withColumn("_new", new).withColumn("session_no", F.sum("_new").over(order)).drop("_new")


def survivors(last_seen: DataFrame, now: Column, seconds: int = IDLE, most: int = SESSIONS) -> DataFrame:
    """Sessions of last_seen(session_id, seen) that stay: not idle, and the `most` seen last."""
    fresh = last_seen.where(F.unix_micros(now) - F.unix_micros("seen") <= seconds * 1_000_000)
    return fresh.orderBy(F.desc("seen"), F.desc("session_id")).limit(most)


def opened(requests: DataFrame, opened_documents: DataFrame) -> DataFrame:
    """Requests for documents that the session has opened."""
    return requests.join(opened_documents, ["session_id", "document_id"], "left_semi")


def trace(turns: DataFrame) -> DataFrame:
    """turns(session_id, seq, ...) with turn numbered within the session: rows to append to a trace table."""
    return turns.withColumn("turn", F.row_number().over(Window.partitionBy("session_id").orderBy("seq")))


