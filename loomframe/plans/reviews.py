"""More queries by name: full timelines, answers of models, reviews, plans and bookkeeping; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import responses, text
from ..operators import bitmaps, masks, quality, review, sequence, timeline
from ..sources import adapters as src
from ..sources import episodes
from .catalog import _masks, _runs, query

c = F.col

# --- timelines

_POSED = "po AS (SELECT user_id AS episode, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame, least(1.0::DOUBLE, value / 50) * 0.1 AS px, (event_id % 97) / 1000.0::DOUBLE AS py, (event_id % 7) * 0.9::DOUBLE AS rz FROM events)"


def _timeline_sql(closed: float, opened: float) -> str:
    """s4 with n (frames) and mv (the first motion before closing, or close_start)."""
    turn = "((((rz - qz) + pi()) % (2 * pi()) + 2 * pi()) % (2 * pi())) - pi()"
    return f"""{_runs(closed, opened)}, {_POSED}, pl AS (SELECT *, lag(px) OVER w AS qx, lag(py) OVER w AS qy, lag(rz) OVER w AS qz FROM po WINDOW w AS (PARTITION BY episode ORDER BY frame)),
    sc AS (SELECT pl.episode, frame, sqrt((px - qx) ** 2 + (py - qy) ** 2) + 0.05::DOUBLE * abs({turn}) AS score, close_start FROM pl JOIN s4 USING (episode) WHERE close_start IS NOT NULL),
    md AS (SELECT episode, median(score) AS med FROM sc WHERE score IS NOT NULL AND frame <= greatest(1, least(close_start, 3)) GROUP BY 1),
    th AS (SELECT episode, greatest(any_value(med) + 4.0::DOUBLE * median(abs(score - med)), 0.002::DOUBLE) AS threshold FROM sc JOIN md USING (episode) WHERE score IS NOT NULL AND frame <= greatest(1, least(close_start, 3)) GROUP BY 1),
    rn AS (SELECT sc.episode, frame, close_start, count(CASE WHEN score > threshold + 1e-9 THEN 1 END) OVER (PARTITION BY sc.episode ORDER BY frame ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) = 3 AS run FROM sc JOIN th USING (episode)),
    mo AS (SELECT episode, least(min(CASE WHEN run AND frame >= 1 THEN frame END), any_value(close_start)) AS mv FROM rn GROUP BY 1),
    tl AS (SELECT s4.*, n, coalesce(mv, close_start) AS mv FROM s4 JOIN (SELECT episode, count(*) AS n FROM sig GROUP BY 1) USING (episode) LEFT JOIN mo USING (episode))"""


_OUT = "CASE WHEN close_start IS NULL THEN 'no_close' WHEN close_done IS NULL THEN 'no_stable_close' WHEN open_start IS NULL THEN 'no_open' WHEN open_done IS NULL THEN 'no_stable_open' ELSE 'loop' END"


@query(f"WITH {_timeline_sql(0.3, 0.9)} SELECT episode, mv AS move_start, close_start, close_done, open_start, open_done, {_OUT} AS outcome, CASE WHEN open_done IS NULL THEN 'missing' END AS reason FROM tl")
def pick_place_timeline(spark, d):
    e = timeline.pick_place(src.posed(spark, d), closed_at=0.3)
    reason = timeline.order_reason(*(c(n) for n in ("move_start", "close_start", "close_done", "open_start", "open_done")))
    return e.select("episode", "move_start", "close_start", "close_done", "open_start", "open_done", "outcome", reason.alias("reason"))


@query(f"""WITH {_timeline_sql(0.3, 0.7)}, e AS (SELECT fl.episode, bool_and(CASE WHEN frame < 3 THEN f >= 0.7 END) AS so, bool_and(CASE WHEN frame >= n - 3 THEN f <= 0.3 END) AS ec, max(CASE WHEN is_open THEN frame END) AS lo FROM fl JOIN tl USING (episode) GROUP BY 1)
SELECT episode, mv AS remove_start, close_start, close_done AS close_end, close_done IS NOT NULL AND so AND ec AND NOT coalesce(lo > close_done, false) AS accepted, CASE WHEN close_done + 1 < n THEN close_done + 1 END AS hold_start, CASE WHEN close_done + 1 < n THEN n - 1 END AS hold_end FROM tl JOIN e USING (episode)""")
def target_only_timeline(spark, d):
    e = timeline.target_only(src.posed(spark, d), 0.7, 0.3)
    w = timeline.hold_window(e.withColumn("close_done", c("close_end")).withColumn("open_start", F.lit(None).cast("int")))
    return w.select("episode", "remove_start", "close_start", "close_end", "accepted", c("hold.start").alias("hold_start"), c("hold.end").alias("hold_end"))


_RECORDED = """CASE WHEN episode % 11 = 0 THEN NULL WHEN episode % 11 = 1 THEN '{"operation":[0,1]}' ELSE '{"operation":[' || op || '],"target_0":[' || tg || '],"receiver_0":' || rc || ',"gripper":[' || CASE WHEN episode % 11 = 2 THEN '0,0' ELSE op END || ']}' END"""


@query(f"""WITH {_timeline_sql(0.3, 0.9)}, e AS (SELECT *, open_start IS NOT NULL AS loop, episode % 3 = 0 AS held FROM tl WHERE close_done IS NOT NULL AND (open_start IS NULL OR open_done IS NOT NULL)),
w AS (SELECT episode, mv AS a, CASE WHEN loop THEN open_done ELSE n - 1 END AS b, CASE WHEN NOT held THEN close_done WHEN loop THEN open_start - 1 ELSE n - 1 END AS t, CASE WHEN episode % 11 = 3 THEN 1 ELSE 0 END AS off FROM e)
SELECT episode, a AS target_start, t AS target_end, CASE WHEN episode % 11 IN (0, 1) THEN 'keys' WHEN episode % 11 = 2 AND NOT (a = 0 AND b = 0) THEN 'gripper' WHEN off = 1 THEN 'target_0' ELSE '' END AS differs FROM w""")
def recorded_windows(spark, d):
    s = src.posed(spark, d)
    e = timeline.pick_place(s, closed_at=0.3).where("outcome in ('loop', 'no_open')").join(s.groupBy("episode").agg(F.count("*").alias("frames")), "episode")
    w = timeline.recorded_windows(e, c("episode") % 3 == 0)
    pair = lambda n, more=0: F.concat_ws(",", c(f"{n}.start").cast("string"), (c(f"{n}.end") + more).cast("string"))
    off = F.when(c("episode") % 11 == 3, 1).otherwise(0)
    parts = w.select("*", pair("operation").alias("op"), pair("target_0", off).alias("tg"), F.when(c("receiver_0").isNull(), "null").otherwise(F.concat(F.lit("["), pair("receiver_0"), F.lit("]"))).alias("rc"))
    return timeline.window_differences(parts, F.expr(_RECORDED)).select("episode", c("target_0.start").alias("target_start"), c("target_0.end").alias("target_end"), "differs")


@query("""WITH e AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey % 5 - 1 AS a, l_partkey % 5 + l_suppkey % 2 - 1 AS b, l_partkey % 5 + 3 AS x, CASE WHEN l_quantity > 2 THEN l_quantity::BIGINT END AS y, 60 AS z FROM lineitem)
SELECT id, n, CASE WHEN y IS NULL THEN 'missing' WHEN least(a, b, x, y, z) < 0 THEN 'negative' WHEN a > b OR b >= x OR x >= y OR y >= z THEN 'unordered' END AS reason FROM e""")
def event_order(spark, d):
    p = c("l_partkey") % 5
    events = (p - 1, p + c("l_suppkey") % 2 - 1, p + 3, F.when(c("l_quantity") > 2, c("l_quantity").cast("bigint")), F.lit(60).cast("bigint"))
    return src.table(spark, d, "lineitem").select(c("l_orderkey").alias("id"), c("l_linenumber").alias("n"), timeline.order_reason(*events).alias("reason"))


@query(f"""WITH {_runs(0.3, 0.9)}, n AS (SELECT episode, max(frame) AS last FROM fil GROUP BY 1), e AS (SELECT fl.episode, bool_and(CASE WHEN frame < 3 THEN f >= 0.9 END) AS so, bool_and(CASE WHEN frame > last - 3 THEN f <= 0.3 END) AS ec, max(CASE WHEN is_open THEN frame END) AS lo FROM fl JOIN n USING (episode) GROUP BY 1),
a AS (SELECT s4.episode // 2 AS recording, CASE WHEN s4.episode % 2 = 0 THEN 'left' ELSE 'right' END AS arm, (open_done IS NOT NULL)::INT AS l, (close_done IS NOT NULL AND so AND ec AND NOT coalesce(lo > close_done, false)) AS h, CASE WHEN close_done IS NOT NULL THEN close_start END AS cs FROM s4 JOIN e USING (episode)),
g AS (SELECT recording, sum(l) AS l, count(CASE WHEN h THEN 1 END) AS h, min(CASE WHEN l = 1 THEN arm END) AS la, min(CASE WHEN h THEN arm END) AS ha, count(cs) AS n, count(DISTINCT cs) AS dn, arg_min(arm, cs) AS fa FROM a GROUP BY 1)
SELECT recording, CASE WHEN l = 1 THEN 'pick_place' WHEN h = 1 THEN 'close_hold' ELSE 'other' END AS shape, CASE WHEN l = 1 THEN la WHEN h = 1 THEN ha WHEN n = 0 THEN 'none' WHEN n = 2 AND dn = 1 THEN 'both' ELSE fa END AS arm FROM g""")
def recording_shapes(spark, d):
    s = src.signals(spark, d)
    holds = sequence.target_only_events(s, closed_at=0.3).select("episode", c("accepted").alias("holds"))
    e = sequence.loop_events(s, closed_at=0.3).join(holds, "episode")
    arms = e.select(F.floor(c("episode") / 2).alias("recording"), F.when(c("episode") % 2 == 0, "left").otherwise("right").alias("arm"), (c("outcome") == "loop").cast("int").alias("loops"), "holds", "close_start", "close_done")
    return timeline.shapes(arms, "recording")


@query(f"""WITH {_runs(0.3, 0.9)}, a AS (SELECT user_id AS episode, max(event_id) % 9 AS given FROM events WHERE user_id % 4 = 0 GROUP BY 1) SELECT episode, coalesce(given, close_start) AS close_start, CASE WHEN given IS NOT NULL THEN 'recorded' WHEN close_start IS NOT NULL THEN 'detected' END AS origin FROM s4 LEFT JOIN a USING (episode)""")
def composite_events(spark, d):
    given = src.table(spark, d, "events").where("user_id % 4 = 0").groupBy(c("user_id").alias("episode")).agg((F.max("event_id") % 9).alias("given"))
    e = sequence.loop_events(src.signals(spark, d), closed_at=0.3).join(given, "episode", "left")
    return e.select("episode", F.coalesce("given", "close_start").alias("close_start"), F.when(c("given").isNotNull(), "recorded").when(c("close_start").isNotNull(), "detected").alias("origin"))


# --- answers

_CHOICES = (
    '{"decision": "accept", "selected_candidate": " a ", "confidence": 0.9, "reason": "fits  well"}',
    '```json\\n{"decision": "ambiguous", "selected_candidate": null, "confidence": 0.25, "reason": "two"}\\n```',
    '{"decision": "accept", "selected_candidate": null, "confidence": 0.9, "reason": "x"}',
    '{"decision": "reject_all", "selected_candidate": "B", "confidence": 0.9, "reason": "x"}',
    '{"decision": "accept", "selected_candidate": "Z", "confidence": 0.9, "reason": "x"}',
    '{"decision": "maybe", "selected_candidate": null, "confidence": 0.9, "reason": "x"}',
    '{"decision": "accept", "selected_candidate": "A", "confidence": 1.5, "reason": "x"}',
    '{"decision": "accept", "selected_candidate": "A", "confidence": "0.5", "reason": "x"}',
    '{"decision": "accept", "selected_candidate": "A", "confidence": 1, "reason": "  "}',
    '{"decision": "accept", "confidence": 1, "reason": "x"}',
    "```yaml\\nx\\n```",
    "{oops",
    "  ",
)
_CHOSEN = (
    (None, "accept", "A", 0.9, "fits well"), (None, "ambiguous", None, 0.25, "two"), ("missing_selection",), ("selection",), ("candidate",), ("decision",), ("confidence",), ("confidence",), ("reason",),
    ("keys",), ("fence",), ("json",), ("empty",),
)
_BOXES = (
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5, 1], "confidence": 0.5, "reason": "x"}',
    '{"status": "not_visible", "bbox_xyxy": null, "confidence": 0, "reason": "x"}',
    '{"status": "ok", "bbox_xyxy": [0.5, 0.2, 0.5, 1], "confidence": 0.5, "reason": "x"}',
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5, 1.2], "confidence": 0.5, "reason": "x"}',
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5], "confidence": 0.5, "reason": "x"}',
    '{"status": "ambiguous", "bbox_xyxy": [0.1, 0.2, 0.5, 0.6], "confidence": 0.5, "reason": "x"}',
    '{"status": "seen", "bbox_xyxy": null, "confidence": 0.5, "reason": "x"}',
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5, 0.6], "confidence": true, "reason": "x"}',
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5, 0.6], "confidence": 0.5, "reason": ""}',
    '{"status": "ok", "bbox_xyxy": [0.1, 0.2, 0.5, 0.6], "confidence": NaN, "reason": "x"}',
    '{"status": "ok", "status": "ok", "bbox_xyxy": null, "confidence": 0.5, "reason": "x"}',
    "```json\\n{}\\n```",
)
_BOXED = ((None, "ok", "0.1,0.2,0.5,1.0", 0.5), (None, "not_visible", None, 0.0), ("box",), ("box",), ("box",), ("box",), ("status",), ("confidence",), ("reason",), ("json",), ("keys",), ("fence",))


def _case(values: tuple, key: str = "event_id") -> str:
    """SQL for one of the values by ``key``."""
    lit = lambda v: "NULL" if v is None else repr(v) if isinstance(v, float) else "'" + v.replace("'", "''") + "'"
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


def _fields(rows: tuple[tuple, ...], names: tuple[str, ...]) -> str:
    return ", ".join(f"{_case(tuple(r[i] if i < len(r) else None for r in rows))} AS {n}" for i, n in enumerate(names))


def _texts(values: tuple[str, ...]):
    return F.element_at(F.array(*(F.lit(v.replace("\\n", "\n")) for v in values)), (c("event_id") % len(values) + 1).cast("int"))


@query(f"SELECT event_id, {_fields(_CHOSEN, ('error', 'decision', 'selected', 'confidence', 'reason'))} FROM events")
def choice_answers(spark, d):
    return src.table(spark, d, "events").select("event_id", responses.candidate_choice(_texts(_CHOICES), F.array(F.lit("A"), F.lit("B"))).alias("x")).select("event_id", "x.*")


@query(f"SELECT event_id, {_fields(_BOXED, ('error', 'status', 'box', 'confidence'))} FROM events")
def box_answers(spark, d):
    e = src.table(spark, d, "events").select("event_id", responses.box_answer(_texts(_BOXES)).alias("x")).select("event_id", "x.*")
    return e.withColumn("box", F.array_join(c("box").cast("array<string>"), ","))


_MESSAGES = ("event|a|b|c", "error|a|b|c", "error|a", "source_episode|1|done", "result|x", "result|x|y", "urdf_episode|1|x", "result", "other|1")


@query(f"SELECT event_id, {_case(('event', 'error', None, 'source_episode', 'source_result', 'urdf_result', 'urdf_episode', None, None))} AS kind FROM events")
def stream_messages(spark, d):
    return src.table(spark, d, "events").select("event_id", responses.message(F.split(_texts(_MESSAGES), r"\|")).alias("kind"))


_QUERIES = ("dark blue tin-can", "tall red cup", "redwood box", "light grey cup")


@query("""WITH q AS (SELECT p_partkey AS id, [CASE p_partkey % 4 WHEN 0 THEN 'dark blue tin-can' WHEN 1 THEN 'tall red cup' WHEN 2 THEN 'redwood box' ELSE 'light grey cup' END, lower(p_name)] AS q FROM part), w AS (SELECT id, q[1] AS a, string_split(q[1] || ' ' || q[2], ' ') AS w, q FROM q),
x AS (SELECT id, coalesce(list_filter(['light brown', 'dark brown', 'light gray', 'dark gray', 'light green', 'dark green', 'light blue', 'dark blue'], lambda p: contains(q[1], p) OR contains(q[2], p))[1],
list_filter(w, lambda v: list_contains(['beige','black','blue','brown','cyan','gray','green','grey','lime','magenta','maroon','olive','orange','pink','purple','red','silver','teal','white','yellow'], v))[1]) AS color FROM w)
SELECT id, color, replace('the {color} one', '{color}', color) AS alias FROM x""")
def query_color(spark, d):
    first = F.element_at(F.array(*map(F.lit, _QUERIES)), (c("p_partkey") % 4 + 1).cast("int"))
    p = src.table(spark, d, "part").select(c("p_partkey").alias("id"), text.color_of(F.array(first, F.lower("p_name"))).alias("color"))
    return p.select("id", "color", F.replace(F.lit("the {color} one"), F.lit("{color}"), c("color")).alias("alias"))


# --- reviews

_ROLES = "ro AS (SELECT l_orderkey AS episode, CASE WHEN l_linenumber = 1 THEN 'target' WHEN l_linenumber = 2 THEN 'receiver' ELSE 'gripper' END AS role, CASE WHEN l_quantity > 45 THEN 'failed' WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN 'not_applicable' ELSE 'ok' END AS status, CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN 'not_applicable' WHEN l_discount > 0.08 THEN 'failed' ELSE 'passed' END AS qc_status FROM lineitem)"


def _roles(spark, d):
    n, none = c("l_linenumber"), (c("l_linestatus") == "O") & (c("l_linenumber") == 2)
    return src.table(spark, d, "lineitem").select(
        c("l_orderkey").alias("episode"), F.when(n == 1, "target").when(n == 2, "receiver").otherwise("gripper").alias("role"), F.when(c("l_quantity") > 45, "failed").when(none, "not_applicable").otherwise("ok").alias("status"),
        F.when(none, "not_applicable").when(c("l_discount") > 0.08, "failed").otherwise("passed").alias("qc_status"),
    )


@query(f"WITH {_ROLES} SELECT episode, count(CASE WHEN role IN ('target', 'receiver') THEN 1 END) = 2 AND count(DISTINCT nullif(role, 'gripper')) = 2 AND bool_and(role = 'gripper' OR (status = 'ok' AND qc_status = 'passed')) AS complete FROM ro GROUP BY 1")
def resume_complete(spark, d):
    return review.complete(_roles(spark, d), "episode")


@query(f"""WITH {_ROLES}, v AS (SELECT *, replace(status, 'ok', 'valid') AS s FROM ro WHERE role <> 'gripper')
SELECT episode, (count(CASE WHEN s <> 'not_applicable' THEN 1 END) > 0 AND bool_and(s = 'not_applicable' OR (s = 'valid' AND qc_status = 'passed')))::INT AS verified, count(CASE WHEN s = 'valid' THEN 1 END) AS valid, count(CASE WHEN s = 'valid' AND qc_status = 'passed' THEN 1 END) AS passed FROM v GROUP BY 1""")
def run_scores(spark, d):
    return review.run_scores(_roles(spark, d).withColumn("status", F.regexp_replace("status", "^ok$", "valid")), ("episode",))


@query(f"WITH {_ROLES}, r AS (SELECT episode, role, count(*) AS n FROM ro GROUP BY 1, 2), v AS (SELECT episode, role, CASE episode % 5 WHEN 0 THEN 'accept' WHEN 1 THEN 'reject' WHEN 2 THEN 'maybe' WHEN 3 THEN 'review' ELSE 'accept' END AS decision, CASE WHEN episode % 5 = 4 THEN ' ' ELSE 'seen' END AS reason FROM r WHERE episode % 3 <> 0) SELECT r.episode, r.role, CASE WHEN v.episode IS NULL THEN 'none' WHEN v.decision IN ('accept', 'review', 'reject') AND trim(v.reason) <> '' THEN v.decision ELSE 'invalid' END AS identity FROM r LEFT JOIN v ON r.episode = v.episode AND r.role = v.role")
def identity_review(spark, d):
    roles = _roles(spark, d).select("episode", "role").distinct()
    k = c("episode") % 5
    reviews = roles.where("episode % 3 <> 0").select("episode", "role", F.when(k == 1, "reject").when(k == 2, "maybe").when(k == 3, "review").otherwise("accept").alias("decision"), F.when(k == 4, " ").otherwise("seen").alias("reason"))
    return review.identity(roles, reviews, ("episode", "role"))


@query("SELECT p_partkey AS id, coalesce(p_size >= 20 AND (p_partkey % 100) / 100.0 >= 0.5, false) AS pixels_only, coalesce(p_size >= 20 AND (p_partkey % 100) / 100.0 >= 0.5 AND CASE WHEN p_partkey % 7 <> 0 THEN p_partkey % 40 END <= 20, false) AS with_residual FROM part")
def depth_support(spark, d):
    key = c("p_partkey")
    args = (c("p_size"), key % 100 / 100, F.when(key % 7 != 0, key % 40), 20, 0.5)
    return src.table(spark, d, "part").select(key.alias("id"), quality.depth_support(*args).alias("pixels_only"), quality.depth_support(*args, 20.0).alias("with_residual"))


@query("""SELECT l_suppkey AS run, round(count(CASE WHEN l_quantity > 5 AND l_linenumber <> 3 THEN 1 END) / count(CASE WHEN l_quantity > 5 THEN 1 END), 6) AS fraction FROM lineitem GROUP BY 1 HAVING count(CASE WHEN l_quantity > 5 THEN 1 END) > 0 AND count(CASE WHEN l_quantity > 5 AND l_linenumber <> 3 THEN 1 END) / count(CASE WHEN l_quantity > 5 THEN 1 END) < 0.8""")
def quality_threshold(spark, d):
    eligible = c("l_quantity") > 5
    g = src.table(spark, d, "lineitem").groupBy(c("l_suppkey").alias("run")).agg(F.try_divide(F.count_if(eligible & (c("l_linenumber") != 3)), F.count_if(eligible)).alias("fraction"))
    return quality.below(g, c("fraction"), 0.8).select("run", F.round("fraction", 6).alias("fraction"))


_NAMES = ("run-1", " run", "a/b", "..", "a..b", "x\\y", "", "ok.2")


@query("""SELECT p_partkey AS id, p_partkey % 8 IN (0, 7) AS simple, CASE p_partkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false WHEN 3 THEN true WHEN 4 THEN false ELSE false END AS inside FROM part""")
def identifier_guards(spark, d):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (c("p_partkey") % 8 + 1).cast("int"))
    path = F.element_at(F.array(*map(F.lit, ("a/b.npz", "../x", "/etc/x", "a/./../b", "a/../../b/c", " "))), (c("p_partkey") % 6 + 1).cast("int"))
    return src.table(spark, d, "part").select(c("p_partkey").alias("id"), review.simple_name(name).alias("simple"), review.inside(path).alias("inside"))


@query("SELECT o_custkey AS key, count(*) AS times FROM orders GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT min(o_custkey), 1 FROM orders GROUP BY o_custkey HAVING count(*) = 1")
def unique_keys(spark, d):
    ones, more = review.unique_by(src.table(spark, d, "orders").select(c("o_custkey").alias("key")), "key")
    return more.unionByName(ones.select("key", F.lit(1).cast("bigint").alias("times")))


@query("""WITH a AS (SELECT p_brand AS task, 0 AS source FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_brand, 1 FROM part WHERE p_partkey % 50 = 1), t AS (SELECT DISTINCT p_brand AS task FROM part WHERE p_size > 48) SELECT task, count(*) AS times, count(*) > 1 AS duplicate, min(source)::INT AS source FROM a WHERE task IN (SELECT task FROM t) GROUP BY 1""")
def reuse_lookup(spark, d):
    p = src.table(spark, d, "part").withColumnRenamed("p_brand", "task")
    return review.reusable([p.where("p_partkey % 3 = 0"), p.where("p_partkey % 50 = 1")], p.where("p_size > 48"))


@query("SELECT o_custkey AS run, count(*) AS tasks, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS completed, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS failed, bool_and(o_orderstatus = 'F') AS passed FROM orders GROUP BY 1")
def collection_verdict(spark, d):
    return review.collection(src.records(spark, d).select("run", "status"), "run")


@query("""WITH r AS (SELECT o_custkey AS run, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS successful, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS failed FROM orders GROUP BY 1), f AS (SELECT o_custkey AS run, count(*) AS n FROM orders WHERE o_orderkey % 13 = 0 GROUP BY 1) SELECT r.run, successful, failed, coalesce(n, 0) AS failure_attempts FROM r LEFT JOIN f USING (run)""")
def checkpoint_counts(spark, d):
    r = src.records(spark, d)
    return review.checkpoint_counts(r.withColumn("status", F.regexp_replace("status", "^completed$", "complete")), r.where("episode % 13 = 0"), "run")


@query("""WITH r AS (SELECT o_orderkey AS episode, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status FROM orders WHERE o_orderkey % 6 <> 0), j AS (SELECT o.o_orderkey AS episode, coalesce(status, 'pending') AS s FROM orders o LEFT JOIN r ON r.episode = o.o_orderkey)
SELECT episode, CASE WHEN s = 'pending' THEN 'failed' ELSE s END AS status, CASE WHEN s = 'pending' THEN 'SourceEpisodeUnavailable' END AS error_type, CASE WHEN s = 'pending' THEN 'source episode did not become ready' END AS error FROM j""")
def finalize_pending(spark, d):
    r = src.records(spark, d).withColumn("status", F.regexp_replace("status", "^completed$", "complete"))
    return review.finalized(r, r.where("episode % 6 <> 0"))


@query("""SELECT event_id, '{"format_version":"failure_v1","error":"' || event_type || '"}' AS record, concat_ws(',', 'failure', CASE WHEN event_id % 2 = 0 THEN 'rendered_prompt' END, CASE WHEN event_id % 3 = 0 THEN 'raw_response' END) AS files FROM events""")
def failure_records(spark, d):
    e = src.table(spark, d, "events").select("event_id", c("event_type").alias("error"), F.when(c("event_id") % 2 == 0, "p").alias("prompt"), F.when(c("event_id") % 3 == 0, "r").alias("response"))
    return review.failures(e, "event_id", "failure_v1")


@query("""WITH k AS (SELECT l_suppkey AS list, l_orderkey * CASE WHEN l_suppkey % 3 = 0 AND l_linenumber = 1 THEN -1 ELSE 1 END AS episode FROM lineitem), g AS (SELECT list, count(*) AS n, count(DISTINCT k.episode) AS dn, count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS unknown FROM k LEFT JOIN orders ON o_orderkey = k.episode GROUP BY 1)
SELECT list, CASE WHEN n <> dn THEN 'repeated' WHEN list % 7 = 1 THEN 'count' WHEN unknown > 0 THEN 'unknown' END AS reason FROM g""")
def case_lists(spark, d):
    odd = F.when((c("l_suppkey") % 3 == 0) & (c("l_linenumber") == 1), -1).otherwise(1)
    k = src.table(spark, d, "lineitem").select(c("l_suppkey").alias("list"), (c("l_orderkey") * odd).alias("episode"))
    n = k.groupBy("list").agg((F.count("*") + (c("list") % 7 == 1).cast("int")).alias("declared"))
    return review.case_list(k.join(n, "list"), src.table(spark, d, "orders").select(c("o_orderkey").alias("episode")), c("declared"))


@query("""SELECT o_orderkey AS episode, CASE WHEN o_orderkey % 9 = 0 THEN 'missing:masks' || CASE WHEN o_orderkey % 10 = 0 THEN ',loop' ELSE '' END WHEN o_orderkey % 10 = 0 THEN 'missing:loop' WHEN o_orderkey % 7 = 0 THEN 'changed:masks' ELSE 'shapes' END AS reason FROM orders""")
def immutable_plan(spark, d):
    o = src.table(spark, d, "orders").select(c("o_orderkey").alias("episode"), F.when(c("o_orderkey") % 1000 == 1, "240x320").otherwise("480x640").alias("shape"), c("o_custkey").cast("string").alias("digest"))
    m = o.where("episode % 9 <> 0").withColumn("digest_now", F.when(c("episode") % 7 == 0, "x").otherwise(c("digest")))
    return review.planned(o.select("episode", "shape"), {"masks": m, "loop": o.where("episode % 10 <> 0").withColumn("digest_now", c("digest"))})


_TRACK = "tr AS (SELECT l_orderkey AS episode, CASE WHEN l_linenumber % 2 = 1 THEN 'target' ELSE 'receiver' END AS role, l_linenumber AS frame FROM lineitem)"


@query(f"WITH {_TRACK} SELECT 'run2' AS run, episode, role, frame, frame BETWEEN 2 AND 2 + episode % 4 AS in_window FROM tr WHERE NOT (episode % 5 = 1 AND role = 'receiver')")
def derived_run(spark, d):
    t = src.table(spark, d, "lineitem").select(c("l_orderkey").alias("episode"), F.when(c("l_linenumber") % 2 == 1, "target").otherwise("receiver").alias("role"), c("l_linenumber").alias("frame"))
    roles = t.select("episode", "role").distinct()
    decided = roles.withColumn("decision", F.when((c("episode") % 5 == 1) & (c("role") == "receiver"), "reject").otherwise("accept"))
    return review.derived(t, decided, roles.select("episode", "role", F.lit(2).alias("start"), (2 + c("episode") % 4).alias("end")), "run2")


@query(f"WITH {_ROLES} SELECT episode, role, status, qc_status FROM ro WHERE role <> 'gripper' UNION ALL SELECT o_orderkey, 'gripper_' || CASE WHEN o_custkey % 2 = 0 THEN 'left' ELSE 'right' END, CASE WHEN o_custkey % 10 > 0 THEN 'valid' ELSE 'failed' END, CASE WHEN o_custkey % 10 > 0 THEN 'passed' ELSE 'failed' END FROM orders")
def public_payload(spark, d):
    o = src.table(spark, d, "orders")
    arms = F.array(*(F.struct(F.lit(a).alias("arm"), (c("o_custkey") % 2 == i).alias("active")) for i, a in enumerate(("left", "right"))))
    g = o.select(c("o_orderkey").alias("episode"), F.when(c("o_custkey") % 10 > 0, 0.9).otherwise(0.5).alias("fraction"), F.inline(arms))
    return review.payload(_roles(spark, d).where("role <> 'gripper'"), g, "episode")


_PIX = "px AS (SELECT l_suppkey AS frame, CASE WHEN l_linestatus = 'O' THEN 'left' ELSE 'right' END AS joint, l_linenumber % 3 AS q, 7 + l_partkey % 2 AS link, l_extendedprice AS r, CASE WHEN l_quantity < 40 THEN l_extendedprice + l_quantity - 20 END AS s FROM lineitem)"
_JOINTS = f"""{_PIX}, ok AS (SELECT *, r > 0 AND coalesce(s > 0, false) AS ok, abs(r - s) AS d FROM px), jo AS (SELECT frame, joint, q, count(*) AS rendered, count(CASE WHEN ok THEN 1 END) AS comparable, count(CASE WHEN ok AND d <= 8 THEN 1 END) AS consistent, round(coalesce(count(CASE WHEN ok AND d <= 8 THEN 1 END) / nullif(count(CASE WHEN ok THEN 1 END), 0), 0), 6) AS fraction,
round(quantile_cont(CASE WHEN ok THEN d END, 0.5), 6) AS median_residual, round(quantile_cont(CASE WHEN ok THEN d END, 0.9), 6) AS p90_residual, count(CASE WHEN ok AND d <= 8 AND link = 7 THEN 1 END) AS link7, count(CASE WHEN ok AND d <= 8 AND link = 8 THEN 1 END) AS link8 FROM ok GROUP BY 1, 2, 3)"""


def _joints(spark, d):
    p = src.table(spark, d, "lineitem").select(
        c("l_suppkey").alias("frame"), F.when(c("l_linestatus") == "O", "left").otherwise("right").alias("joint"), (c("l_linenumber") % 3).alias("q"), (7 + c("l_partkey") % 2).alias("link"),
        c("l_extendedprice").alias("rendered"), F.when(c("l_quantity") < 40, c("l_extendedprice") + c("l_quantity") - 20).alias("scene"),
    )
    return review.joint_scores(p)


@query(f"WITH {_JOINTS} SELECT * FROM jo")
def joint_scores(spark, d):
    return _joints(spark, d)


@query(f"WITH {_JOINTS} SELECT frame, joint, q, row_number() OVER (PARTITION BY frame, joint ORDER BY coalesce(median_residual, 1e300) <= 9 DESC, consistent DESC, fraction DESC, coalesce(median_residual, 1e300), coalesce(p90_residual, 1e300), least(link7, link8) DESC, abs(q - 1), abs(q - frame % 3), q) AS rank, consistent >= 10 AND fraction >= 0.3 AND least(link7, link8) >= 4 AS supported FROM jo")
def finger_rank(spark, d):
    ranked = review.finger_rank(_joints(spark, d), F.lit(1), c("frame") % 3, 9.0)
    return ranked.select("frame", "joint", "q", "rank", review.supported(ranked, 10, 4, 0.3).alias("supported"))


@query(f"WITH {_masks(0.2)}, g AS (SELECT episode, frame // 4 AS frame, frame % 4 AS i, area, CASE WHEN frame % 7 <> 0 THEN (frame * 37 % 10) / 10.0::DOUBLE END AS p FROM mx), k AS (SELECT *, row_number() OVER (PARTITION BY episode, frame ORDER BY coalesce(p, 1.0) DESC, i) AS r FROM g) SELECT episode, frame, i AS index, area FROM k WHERE r = 1")
def top_masks(spark, d):
    at = c("frame")
    m = src.mask_frames(spark, d, 0.2).select("episode", F.floor(at / 4).alias("frame"), (at % 4).alias("index"), "mask", F.when(at % 7 != 0, (at * 37) % 10 / 10).alias("probability"))
    return review.top_masks(m, ("episode", "frame")).select("episode", "frame", "index", masks.area(c("mask")).alias("area"))


@query("""WITH a AS (SELECT p_partkey AS id, p_partkey % 12 AS k, p_size AS n FROM part) SELECT id, CASE WHEN k = 0 THEN 'version' WHEN k IN (1, 2) THEN 'keys' WHEN n = 1 THEN 'frame_count' WHEN k = 3 THEN 'masks' WHEN k = 4 THEN 'frames' WHEN k = 5 THEN 'channels' END AS reason FROM a""")
def mask_archives(spark, d):
    k, n = c("p_partkey") % 12, c("p_size") - 1
    base = F.array(*map(F.lit, review.ARCHIVE))
    version = F.when(k == 0, "masks_v9").when(k % 2 == 0, "masks_v2").otherwise("masks_v3")
    keys = F.when((k % 2 == 1) & (k != 1), F.array_append(base, F.lit("frame_encoding"))).when(k == 2, F.array_append(base, F.lit("frame_encoding"))).otherwise(base)
    channels = F.when(k == 5, F.array_sort(F.array(*map(F.lit, review.CHANNELS)))).otherwise(F.array(*map(F.lit, review.CHANNELS)))
    channels = F.when(k == 5, F.slice(channels, 1, 3)).otherwise(channels)
    reason = review.archive_reason(version, keys, n + (k == 4).cast("int"), n, channels, F.when(k == 3, "uint8").otherwise("bool"))
    return src.table(spark, d, "part").select(c("p_partkey").alias("id"), reason.alias("reason"))


# --- sources

_META = """'{"episode_index": ' || event_id || ', "tasks": ["  ' || event_type || ' "], "full_structured_tasks": ' || CASE WHEN event_id % 4 = 0 THEN 'null' ELSE '["' || event_type || '", "b"]' END || ', "geometry_valid": true}'"""


@query("SELECT event_id AS episode, event_type AS task_text, CASE WHEN event_id % 4 <> 0 THEN event_type END AS task FROM events")
def metadata_lines(spark, d):
    return episodes.metadata(src.table(spark, d, "events").select(F.expr(_META).alias("value"))).select("episode", "task_text", "task")


@query("""WITH w AS (SELECT unnest(['click', 'purchase', 'nothing']) AS task), n AS (SELECT event_type AS task, count(*) AS n FROM events WHERE event_id % 4 <> 0 GROUP BY 1) SELECT w.task, coalesce(n, 0) AS episodes, n IS NULL AS missing FROM w LEFT JOIN n USING (task)""")
def task_buckets(spark, d):
    return episodes.task_buckets(episodes.metadata(src.table(spark, d, "events").select(F.expr(_META).alias("value"))), ("click", "purchase", "nothing"))


@query("SELECT label::BIGINT AS episode, vec_id AS frame, round(list_sum(embedding[15:20]::DOUBLE[]), 6) AS left_sum, round(list_sum(embedding[21:26]::DOUBLE[]), 6) AS right_sum FROM embeddings WHERE vec_id % 5 <> 0")
def state_joints(spark, d):
    k = c("vec_id") % 5 == 0
    s = src.table(spark, d, "embeddings").select(c("label").cast("bigint").alias("episode_index"), c("vec_id").alias("frame_index"), F.when(k, F.array(F.lit(1.0))).otherwise(F.slice("embedding", 15, 12).cast("array<double>")).alias("observation.state.joint_absolute"))
    total = lambda n: F.round(F.aggregate(n, F.lit(0.0), lambda a, x: a + x), 6)
    return episodes.joints(s, 12).select("episode", "frame", total("left").alias("left_sum"), total("right").alias("right_sum"))


@query("SELECT label::BIGINT AS episode_index, vec_id AS frame_index FROM embeddings WHERE vec_id % 6 IN (0, 1, 2)")
def state_violations(spark, d):
    k, s = c("vec_id") % 6, F.slice("embedding", 1, 14).cast("array<double>")
    state = F.when(k == 0, F.slice(s, 1, 13)).when(k == 1, F.transform(s, lambda x, i: F.when(i == 3, float("nan")).otherwise(x))).when(k == 3, s).when(k == 2, F.lit(None)).otherwise(s)
    return episodes.state_violations(src.table(spark, d, "embeddings").select(c("label").cast("bigint").alias("episode_index"), c("vec_id").alias("frame_index"), state.alias("observation.state")))


@query("""WITH r AS (SELECT o_orderkey, o_custkey, o_orderpriority AS task FROM orders), e AS (SELECT task, o_custkey AS episode FROM r) SELECT task, episode, count(*) AS times FROM e GROUP BY 1, 2""")
def manifest_episodes(spark, d):
    o = src.table(spark, d, "orders")
    one = o.where("o_orderkey % 2 = 0").groupBy(c("o_orderpriority").alias("task"), c("o_orderkey").alias("part")).agg(F.collect_list("o_custkey").alias("episode_indices")).select("task", "episode_indices", F.lit(None).cast("array<struct<task:string,profile:string,episode_indices:array<bigint>>>").alias("datasets"))
    many = o.where("o_orderkey % 2 <> 0").groupBy(c("o_orderkey").alias("part")).agg(F.collect_list(F.struct(c("o_orderpriority").alias("task"), F.lit("p").alias("profile"), F.array("o_custkey").alias("episode_indices"))).alias("datasets")).select(F.lit(None).cast("string").alias("task"), F.lit(None).cast("array<bigint>").alias("episode_indices"), "datasets")
    return episodes.manifest_episodes(one.unionByName(many))


@query("""WITH p AS (SELECT o_orderpriority AS task, min(o_orderkey) AS first, count(*) AS episodes FROM orders GROUP BY 1) SELECT p.task, first, episodes, o_custkey AS frame_count FROM p JOIN orders ON o_orderkey = first""")
def dynamic_manifest(spark, d):
    o = src.table(spark, d, "orders").select(c("o_orderpriority").alias("task"), c("o_orderkey").alias("episode"), c("o_custkey").alias("frame_count"))
    return episodes.dynamic_manifest(o).select("task", c("smoke").alias("first"), F.size("episodes").cast("bigint").alias("episodes"), "frame_count")


@query("""SELECT 'run' || (l_suppkey % 3)::VARCHAR AS run, l_orderkey AS episode FROM lineitem WHERE l_linenumber = 1 AND l_returnflag = 'R'""")
def artifact_scan(spark, d):
    odd = F.when(c("l_linenumber") == 1, "masks.npz").otherwise("seed.png")
    p = src.table(spark, d, "lineitem").select(F.format_string("/runs/run%d/%s/episode_%06d/front/%s", c("l_suppkey") % 3, F.when(c("l_returnflag") == "R", "cup").otherwise("bottle"), c("l_orderkey"), odd).alias("path"))
    return episodes.artifacts(p, "cup", "front").select("run", "episode")


@query("SELECT event_type, count(CASE WHEN user_id % 2 = 0 THEN 1 END) AS kept, count(CASE WHEN user_id % 2 <> 0 THEN 1 END) AS dropped FROM events GROUP BY 1")
def filter_copy(spark, d):
    e = src.table(spark, d, "events")
    accepted = e.where("user_id % 2 = 0").select(c("user_id").alias("episode")).distinct()
    lines = e.select("event_type", F.to_json(F.struct(c("user_id").alias("episode"), "event_id")).alias("value"))
    return episodes.filtered_lines(lines, "episode", accepted).groupBy("event_type").agg(F.count_if("kept").alias("kept"), F.count_if(~c("kept")).alias("dropped"))


@query("SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') || '-' || substr(sha256(event_id::VARCHAR), 1, 8) AS run_id FROM events")
def run_stamps(spark, d):
    return src.table(spark, d, "events").select("event_id", text.run_id(c("ts"), F.sha2(c("event_id").cast("string"), 256)).alias("run_id"))


@query("""SELECT o_orderkey AS episode, '{"episode":' || o_orderkey || ',"status":"' || o_orderstatus || '"' || CASE WHEN o_orderkey % 3 = 0 THEN ',"error":"x"' ELSE '' END || '}' AS record FROM orders""")
def record_projection(spark, d):
    o = src.table(spark, d, "orders").select(c("o_orderkey").alias("episode"), c("o_orderstatus").alias("status"), F.when(c("o_orderkey") % 3 == 0, "x").alias("error"))
    return o.select("episode", F.to_json(F.struct("episode", "status", "error")).alias("record"))


# --- masks of any size: rows of two words, four rows

_BITS = """bm AS (SELECT label AS episode, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, embedding AS e FROM embeddings),
    wd AS (SELECT *, unnest(range(8)) AS w FROM bm), px AS (SELECT episode, frame, w, unnest(range(64)) AS i, e FROM wd),
    wh AS (SELECT episode, frame, (w % 2) * 64 + i AS x, w // 2 AS y FROM px WHERE e[(i * (w + 1) % 64) + 1] > 0.25::FLOAT AND (frame + w) % 5 <> 0 AND frame % 9 <> 4)"""


def _wide(spark, d):
    """Masks of 4 rows of 128 pixels, from vectors: pixel i of word w is set by entry i * (w + 1) mod 64."""
    bit = lambda w: F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"),
        lambda m, i: m.bitwiseOR(F.when(F.get("embedding", i * (w + 1) % 64) > F.lit(0.25).cast("float"), F.call_function("shiftleft", F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint"))),
    )
    order = sequence.Window.partitionBy("label").orderBy("vec_id")
    e = src.table(spark, d, "embeddings").select(c("label").alias("episode"), (F.row_number().over(order) - 1).alias("frame"), "embedding")
    words = F.array(*(F.when(((c("frame") + w) % 5 != 0) & (c("frame") % 9 != 4), bit(w)).otherwise(F.lit(0).cast("bigint")) for w in range(8)))
    return e.select("episode", "frame", words.alias("mask"))


@query(f"""WITH {_BITS}, g AS (SELECT episode, frame, count(*) AS area, avg(x) AS cx, avg(y) AS cy, min(x)::INT AS x0, min(y)::INT AS y0, max(x)::INT AS x1, max(y)::INT AS y1 FROM wh GROUP BY 1, 2),
j AS (SELECT a.episode, a.frame + 1 AS frame, count(*) AS common FROM wh a JOIN wh b ON a.episode = b.episode AND b.frame = a.frame + 1 AND a.x = b.x AND a.y = b.y GROUP BY 1, 2)
SELECT bm.episode, bm.frame, coalesce(g.area, 0) AS area, round(g.cx, 6) AS cx, round(g.cy, 6) AS cy, g.x0, g.y0, g.x1, g.y1, round(CASE WHEN g.area > 0 AND p.area > 0 THEN coalesce(common, 0) / (g.area + p.area - coalesce(common, 0)) END::DOUBLE, 6) AS iou,
round(CASE WHEN g.area > 0 AND p.area > 0 THEN sqrt((g.cx - p.cx) ** 2 + (g.cy - p.cy) ** 2) END, 6) AS jump FROM bm LEFT JOIN g ON g.episode = bm.episode AND g.frame = bm.frame LEFT JOIN g p ON p.episode = bm.episode AND p.frame = bm.frame - 1 LEFT JOIN j ON j.episode = bm.episode AND j.frame = bm.frame""")
def bitmap_measures(spark, d):
    m = bitmaps.measured(_wide(spark, d), 2).withColumn("b", bitmaps.box(c("mask"), 2))
    return m.select("episode", "frame", "area", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"), "b.x0", "b.y0", "b.x1", "b.y1", F.round("iou", 6).alias("iou"), F.round("jump", 6).alias("jump"))


@query(f"""WITH {_BITS}, g AS (SELECT episode, frame, count(*) AS area, avg(x) AS cx, avg(y) AS cy FROM wh GROUP BY 1, 2), a AS (SELECT bm.episode, bm.frame, coalesce(area, 0) AS area, cx, cy FROM bm LEFT JOIN g ON g.episode = bm.episode AND g.frame = bm.frame),
r AS (SELECT episode, cx AS rx, cy AS ry FROM a WHERE frame = 3 AND episode % 2 = 0), k AS (SELECT a.*, rx, ry, lag(area) OVER w AS pa, lag(cx) OVER w AS px, lag(cy) OVER w AS py, lag(a.frame) OVER w AS pf FROM a LEFT JOIN r USING (episode) WHERE frame BETWEEN 2 AND 20 + a.episode % 10 WINDOW w AS (PARTITION BY a.episode ORDER BY frame)),
o AS (SELECT a.episode, a.frame + 1 AS frame, count(*) AS common FROM wh a JOIN wh b ON a.episode = b.episode AND b.frame = a.frame + 1 AND a.x = b.x AND a.y = b.y GROUP BY 1, 2),
x AS (SELECT k.*, min(CASE WHEN area > 0 THEN k.frame END) OVER (PARTITION BY k.episode) AS lo, max(CASE WHEN area > 0 THEN k.frame END) OVER (PARTITION BY k.episode) AS hi, CASE WHEN area > 0 AND pa > 0 THEN coalesce(common, 0) / (area + pa - coalesce(common, 0)) END::DOUBLE AS iou, CASE WHEN area > 0 AND pa > 0 THEN sqrt((cx - px) ** 2 + (cy - py) ** 2) END AS jump, CASE WHEN area > 0 AND pa > 0 THEN abs(area - pa) / pa END::DOUBLE AS ratio, sqrt((cx - rx) ** 2 + (cy - ry) ** 2) AS far FROM k LEFT JOIN o ON o.episode = k.episode AND o.frame = k.frame),
m AS (SELECT episode, count(*) AS window_frames, count(CASE WHEN area > 0 THEN 1 END) AS nonempty_frames, count(CASE WHEN (area > 0) <> (pa > 0) THEN 1 END) AS presence_transitions, count(CASE WHEN area = 0 AND frame BETWEEN lo AND hi THEN 1 END) AS internal_missing_frames, quantile_cont(iou, 0.05) AS i5, quantile_cont(jump, 0.95) AS j95, quantile_cont(ratio, 0.95) AS r95, max(far) AS mr FROM x GROUP BY 1),
s AS (SELECT *, concat_ws(',', CASE WHEN i5 < 0.5 THEN 'low_adjacent_iou_p05' END, CASE WHEN j95 > 5 THEN 'large_centroid_jump_p95' END, CASE WHEN r95 > 0.4 THEN 'large_area_ratio_jump_p95' END) AS strong FROM m)
SELECT episode, window_frames, nonempty_frames, presence_transitions, internal_missing_frames, round(i5, 6) AS iou_p05, round(j95, 6) AS jump_p95, round(r95, 6) AS ratio_p95, round(mr, 6) AS max_reference_distance,
concat_ws(',', nullif(strong, ''), CASE WHEN nonempty_frames < window_frames THEN 'incomplete_window_coverage' END, CASE WHEN internal_missing_frames > 0 THEN 'internal_missing_frames' END) AS issues,
CASE WHEN contains(strong, ',') THEN 'quarantine' WHEN strong <> '' OR nonempty_frames < window_frames OR internal_missing_frames > 0 THEN 'review' ELSE 'pass' END AS status FROM s""")
def temporal_qc_window(spark, d):
    m = _wide(spark, d)
    reference = m.where("frame = 3 and episode % 2 = 0").select("episode", c("mask").alias("reference"))
    q = bitmaps.temporal_qc(m.join(reference, "episode", "left").withColumns({"start": F.lit(2), "end": 20 + c("episode") % 10}), 2)
    return q.select("episode", "window_frames", "nonempty_frames", "presence_transitions", "internal_missing_frames", *(F.round(n, 6).alias(n) for n in ("iou_p05", "jump_p95", "ratio_p95", "max_reference_distance")), "issues", "status")


_DRIVE = "SELECT l_orderkey AS id, l_linenumber AS n, round(greatest(0.0::DOUBLE, least(0.04::DOUBLE, l_discount * 0.5 - 0.001)), 9) AS position, 1 + floor((l_quantity % 7) / 2 + 1e-9)::INT + CASE WHEN abs(floor((l_quantity % 7) / 2 + 1e-9) * 2 - l_quantity % 7) < 1e-9 THEN 0 ELSE 1 END AS steps FROM lineitem"


@query(_DRIVE)
def joint_positions(spark, d):
    from ..functions import geometry

    top = c("l_quantity") % 7
    return src.table(spark, d, "lineitem").select(c("l_orderkey").alias("id"), c("l_linenumber").alias("n"), F.round(geometry.joint_position(c("l_discount"), 0.0, 0.04, 0.5, -0.001), 9).alias("position"), F.size(geometry.grid(F.lit(0.0), top, 2.0)).alias("steps"))
