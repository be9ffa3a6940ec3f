"""Queries over what runs agree on: plans, datasets, recordings, repaired queries, channels and digests; each with its SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import bitmaps, contracts, quality, sequence, stages
from ..sources import adapters as src
from ..sources import episodes
from .catalog import _RAW, ORACLES, _masks, _runs, query
from .reviews import _BITS, _wide

c = F.col

# --- plans


@query("""WITH e AS (SELECT o_custkey AS run, o_orderkey AS episode, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place, o_orderkey % 13 AS digest, CASE WHEN o_orderkey % 6 = 0 THEN 'complete' ELSE 'pending' END AS status FROM orders),
o AS (SELECT run, episode, place + CASE WHEN episode % 17 = 0 THEN 2.5 ELSE 0 END AS position, CASE WHEN episode % 19 = 0 THEN -1 ELSE digest END AS digest FROM e WHERE episode % 4 <> 1 UNION ALL SELECT run, episode, place + 0.25, digest FROM e WHERE episode % 23 = 0 AND episode % 4 <> 1 UNION ALL SELECT run, -episode, place + 0.75, 0 FROM e WHERE episode % 29 = 0),
k AS (SELECT o.*, e.place, e.digest AS want, row_number() OVER (PARTITION BY o.run, o.episode ORDER BY position) AS nth, max(e.place) OVER (PARTITION BY o.run ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM o LEFT JOIN e ON e.run = o.run AND e.episode = o.episode),
a AS (SELECT run, episode, status FROM e WHERE episode % 4 = 1)
SELECT * FROM (SELECT run, episode, CASE WHEN place IS NULL THEN 'undeclared' WHEN nth > 1 THEN 'repeated' WHEN place <= high THEN 'order' WHEN digest <> want THEN 'changed' END AS reason FROM k
UNION ALL SELECT run, episode, CASE WHEN status <> 'pending' THEN 'unplanned' WHEN episode % 5 = 0 THEN 'published' END FROM a) WHERE reason IS NOT NULL""")
def plan_contract(spark, d):
    """Why resumed runs can't go on with the plans recorded so far."""
    o = src.table(spark, d, "orders")
    place = F.row_number().over(sequence.Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    e = o.select(c("o_custkey").alias("run"), c("o_orderkey").alias("episode"), place.alias("place"), (c("o_orderkey") % 13).alias("digest"), F.when(c("o_orderkey") % 6 == 0, "complete").otherwise("pending").alias("status"))
    k, planned = c("episode"), e.where("episode % 4 <> 1")
    old = planned.select("run", "episode", (c("place") + F.when(k % 17 == 0, 2.5).otherwise(0)).alias("position"), F.when(k % 19 == 0, -1).otherwise(c("digest")).alias("digest"))
    old = old.unionByName(planned.where("episode % 23 = 0").select("run", "episode", (c("place") + 0.25).alias("position"), "digest"))
    old = old.unionByName(e.where("episode % 29 = 0").select("run", (-k).alias("episode"), (c("place") + 0.75).alias("position"), F.lit(0).alias("digest")))
    return contracts.plan_violations(old, e.select("run", "episode", "place", "digest"), e.select("run", "episode", "status"), e.where("episode % 5 = 0").select("run", "episode"))


_CATEGORY = f"translate(lower(trim(coalesce({_RAW}, ''))), '- ', '__')"


@query(f"""WITH r AS (SELECT user_id AS run, {_CATEGORY} AS s FROM events), k AS (SELECT run, CASE WHEN s IN ({", ".join(f"'{v}'" for v in quality.SUCCESS)}) THEN 'success' WHEN s IN ({", ".join(f"'{v}'" for v in quality.SKIPPED)}) OR starts_with(s, 'skipped_') THEN 'skipped' WHEN s = 'not_run' OR starts_with(s, 'not_run_') THEN 'not_run' WHEN s IN ({", ".join(f"'{v}'" for v in quality.RUNNING)}) THEN 'running' WHEN s IN ({", ".join(f"'{v}'" for v in quality.PENDING)}, '') THEN 'pending' ELSE 'failed' END AS c FROM r),
t AS (SELECT user_id AS run, count(*) - 10 + user_id % 30 AS total FROM events GROUP BY 1), g AS (SELECT run, count(CASE WHEN c = 'success' THEN 1 END) AS success, count(CASE WHEN c = 'failed' THEN 1 END) AS failed, count(CASE WHEN c = 'skipped' THEN 1 END) AS skipped, count(CASE WHEN c = 'running' THEN 1 END) AS running, count(CASE WHEN c = 'not_run' THEN 1 END) AS not_run, count(*) AS seen FROM k GROUP BY 1)
SELECT run, greatest(total, seen) AS total, success, failed, skipped, running, not_run, greatest(0, greatest(total, seen) - success - failed - skipped - running - not_run) AS remaining FROM t JOIN g USING (run)""")
def dashboard_stats(spark, d):
    """Categories of every run's records against how many episodes were declared, and how many remain."""
    e = src.table(spark, d, "events")
    totals = e.groupBy(c("user_id").alias("run")).agg((F.count("*") - 10 + c("user_id") % 30).alias("total"))
    return contracts.dashboard(e.select(c("user_id").alias("run"), quality.status_category(F.expr(_RAW)).alias("category")), totals)


# --- datasets and recordings

_MAN = """SELECT o_custkey AS id, concat('/data/', CAST(o_custkey AS STRING)) AS root, concat('{"profile":"', CASE WHEN o_custkey % 13 = 0 THEN 'other' ELSE 'pick_place' END, '"', CASE WHEN o_custkey % 17 = 0 THEN '' ELSE concat(',"task":"', CASE WHEN o_custkey % 2 = 0 THEN 'cup' ELSE 'pan' END, '"') END, ',"camera":"', CASE WHEN o_custkey % 19 = 0 THEN '' ELSE 'front' END, '","episode_indices":[', CASE WHEN o_custkey % 23 = 0 THEN '' ELSE eps END, CASE WHEN o_custkey % 29 = 0 THEN ',1.5' WHEN o_custkey % 31 = 0 THEN ',7,7' ELSE '' END, ']}', CASE WHEN o_custkey % 37 = 0 THEN '}' ELSE '' END) AS value FROM m"""


@query(f"""WITH m AS (SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS eps, list(o_orderkey ORDER BY o_orderkey) AS ids FROM orders GROUP BY 1)
SELECT root, NULL::VARCHAR AS part, CASE WHEN reason IS NULL THEN 'cup' END AS task, CASE WHEN reason IS NULL THEN len(ids) END AS episodes, reason FROM (SELECT '/data/' || o_custkey AS root, ids, CASE WHEN o_custkey % 37 = 0 THEN 'json' WHEN o_custkey % 13 = 0 THEN 'profile' WHEN o_custkey % 17 = 0 THEN 'task' WHEN o_custkey % 19 = 0 THEN 'camera' WHEN o_custkey % 23 = 0 AND o_custkey % 29 <> 0 AND o_custkey % 31 <> 0 THEN 'episodes'
WHEN o_custkey % 29 = 0 THEN 'numbers' WHEN o_custkey % 31 = 0 THEN 'repeated_episodes' WHEN o_custkey % 2 = 1 THEN 'absent' END AS reason FROM m)""")
def resolved_datasets(spark, d):
    """Every customer's orders as the manifest of a dataset, asked for one task: its episodes, or why it can't be used."""
    m = src.table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: k.cast("string")), ",").alias("eps"))
    manifests = m.select(*(F.expr(x) for x in _split(_MAN)))
    # an array that begins with a comma isn't JSON: the first two of these cases together
    found = contracts.resolved_datasets(manifests.withColumn("value", F.regexp_replace("value", r"\[,", "[")), "pick_place", "cup")
    return found.select("root", "part", "task", F.size("episodes").cast("long").alias("episodes"), "reason").withColumn("episodes", F.when(c("reason").isNull(), c("episodes")))


def _split(select: str) -> list[str]:
    """The columns of a SELECT, at commas outside of parentheses and quotes."""
    body, out, depth, quoted, start = select.split("SELECT", 1)[1].rsplit(" FROM ", 1)[0], [], 0, False, 0
    for i, ch in enumerate(body):
        quoted ^= ch == "'"
        depth += (ch == "(") - (ch == ")") if not quoted else 0
        if ch == "," and not depth and not quoted:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


@query(f"""WITH {_runs(0.3, 0.9)}, n AS (SELECT episode, max(frame) AS last FROM fil GROUP BY 1), e AS (SELECT fl.episode, bool_and(CASE WHEN frame < 3 THEN f >= 0.9 END) AS so, bool_and(CASE WHEN frame > last - 3 THEN f <= 0.3 END) AS ec, max(CASE WHEN is_open THEN frame END) AS lo FROM fl JOIN n USING (episode) GROUP BY 1),
a AS (SELECT s4.episode // 2 AS recording, CASE WHEN s4.episode % 2 = 0 THEN 'left' ELSE 'right' END AS arm, (open_done IS NOT NULL)::INT AS l, (close_done IS NOT NULL AND so AND ec AND NOT coalesce(lo > close_done, false)) AS h, CASE WHEN close_done IS NOT NULL THEN close_start END AS cs FROM s4 JOIN e USING (episode)),
g AS (SELECT recording, sum(l) AS l, count(CASE WHEN h THEN 1 END) AS h, min(CASE WHEN l = 1 THEN arm END) AS la, min(CASE WHEN h THEN arm END) AS ha, min(cs) AS first FROM a GROUP BY 1), f AS (SELECT g.*, list_sort(list(arm) FILTER (cs = first)) AS w FROM g JOIN a USING (recording) GROUP BY ALL)
SELECT recording, CASE WHEN l = 1 THEN 'pick_place' WHEN h = 1 THEN 'close_hold' ELSE 'other' END AS shape, CASE WHEN l = 1 THEN la WHEN h = 1 THEN ha WHEN first IS NULL THEN 'none' WHEN len(w) > 1 THEN 'both' ELSE w[1] END AS arm, 'v' || recording % 3 AS variant
FROM f WHERE recording % 10 <> 7 AND recording % 9 <> 4""")
def candidate_recordings(spark, d):
    """Shape and arm of recordings of valid geometry that have a video and a sidecar."""
    s = src.signals(spark, d)
    holds = sequence.target_only_events(s, closed_at=0.3).select("episode", c("accepted").alias("holds"))
    e = sequence.loop_events(s, closed_at=0.3).join(holds, "episode")
    arms = e.select(F.floor(c("episode") / 2).alias("recording"), F.when(c("episode") % 2 == 0, "left").otherwise("right").alias("arm"), (c("outcome") == "loop").cast("int").alias("loops"), "holds", "close_start", "close_done")
    rows = arms.select("recording").distinct()
    known = rows.select("recording", (c("recording") % 10 != 7).alias("geometry_valid"), F.concat(F.lit("v"), (c("recording") % 3).cast("string")).alias("variant"))
    files = rows.select("recording", F.explode(F.array(F.lit("video"), F.when(c("recording") % 9 != 4, "sidecar"), F.lit("video"))).alias("part"))
    return contracts.candidate_recordings(arms, known, files, ("video", "sidecar"), "recording").select("recording", "shape", "arm", "variant")


@query(f"""WITH {_runs(0.3, 0.9)}, n AS (SELECT episode, count(*) AS frames FROM sig GROUP BY 1), d AS (SELECT n.episode, frames, CASE WHEN n.episode % 14 = 6 THEN 'video' ELSE '' END AS missing, CASE WHEN open_done IS NOT NULL THEN close_start END AS a, CASE WHEN open_done IS NOT NULL THEN open_done END AS b, n.episode % 4 = 0 AND n.episode % 12 <> 4 AS given, n.episode % 8 = 0 AS holds, n.episode % 5 AS k FROM n JOIN s4 USING (episode)),
x AS (SELECT *, CASE WHEN given THEN 2 ELSE a END AS ma, CASE WHEN given THEN CASE WHEN k <> 1 THEN 2 + CASE WHEN k = 2 THEN 1 ELSE 0 END END ELSE a END AS st, CASE WHEN given THEN CASE WHEN holds THEN frames - 1 ELSE 12 END + CASE WHEN k = 3 THEN 1000 WHEN k = 2 THEN -1 ELSE 0 END ELSE b END AS en FROM d)
SELECT episode, CASE WHEN reason IS NULL THEN st END AS start, CASE WHEN reason IS NULL THEN en END AS "end", CASE WHEN reason IS NULL THEN CASE WHEN given THEN 'recorded' ELSE 'detected' END END AS origin, reason FROM (SELECT *, CASE WHEN missing <> '' THEN 'missing' WHEN given AND k = 1 THEN 'together' WHEN ma IS NULL THEN 'none' WHEN en < st OR en >= frames THEN 'window' WHEN given AND holds AND (st <> 2 OR en <> frames - 1) THEN 'hold' WHEN given AND NOT holds AND (st <> 2 OR en <> 12) THEN 'loop' END AS reason FROM x)""")
def composite_episodes(spark, d):
    """Events and windows of all episodes, some of them recorded, checked against each other and the frames."""
    s, k = src.signals(spark, d), c("episode")
    loops = sequence.loop_events(s, closed_at=0.3).withColumn("move_start", c("close_start"))
    rows = s.groupBy("episode").agg(F.count("*").alias("frames")).withColumn("missing", F.when(k % 14 == 6, "video").otherwise(""))
    holds, case = k % 8 == 0, k % 5
    given = rows.where((k % 4 == 0) & (k % 12 != 4)).select(
        "episode", F.lit(2).alias("move_start"), F.lit(3).alias("close_start"), F.lit(5).alias("close_done"), F.when(~holds, 8).alias("open_start"), F.when(~holds, 12).alias("open_done"),
        F.when(case != 1, 2 + (case == 2).cast("int")).alias("start"), (F.when(holds, c("frames") - 1).otherwise(12) + F.when(case == 3, 1000).when(case == 2, -1).otherwise(0)).alias("end"),
    )
    return contracts.composite(rows, loops, given).select("episode", "start", "end", "origin", "reason")


# --- queries and frames for a review


@query("""WITH e AS (SELECT user_id AS episode, list(event_id ORDER BY event_id) FILTER (event_id % 7 = 0) AS ev, list(event_id ORDER BY event_id) FILTER (event_id % 7 BETWEEN 1 AND 2) AS se FROM events WHERE event_id % 3 = user_id % 3 OR user_id % 5 = 0 GROUP BY 1),
f AS (SELECT episode, coalesce(ev, []) AS ev, coalesce(se, []) AS se FROM e), p AS (SELECT *, CASE WHEN len(ev) > 2 THEN [ev[1], ev[-1]] ELSE ev END AS a, CASE WHEN len(ev) = 0 THEN CASE WHEN len(se) > 2 THEN [se[1], se[-1]] ELSE se END WHEN len(ev) = 1 THEN se[1:1] ELSE [] END AS b FROM f)
SELECT episode, array_to_string(list_sort(a || b), ',') AS frames, least(len(se), CASE WHEN episode % 2 = 0 THEN 3 ELSE 4 END)::INT AS queries FROM p""")
def review_context(spark, d):
    """Frames shown beside a seed, and how many queries fit beside a prior region."""
    k = c("event_id") % 7
    e = src.table(spark, d, "events").where("event_id % 3 = user_id % 3 or user_id % 5 = 0")
    lists = e.groupBy(c("user_id").alias("episode")).agg(F.array_sort(F.collect_list(F.when(k == 0, c("event_id")))).alias("ev"), F.array_sort(F.collect_list(F.when(k.between(1, 2), c("event_id")))).alias("se"))
    shown = contracts.context_frames(c("ev"), c("se"))
    asked = contracts.capped_queries(F.transform("se", lambda x: x.cast("string")), 4, c("episode") % 2 == 0)
    return lists.select("episode", F.array_join(F.transform(shown, lambda x: x.cast("string")), ",").alias("frames"), F.size(asked).alias("queries"))


_FIELDS = ("category", "colour", "shape", "fallback")


@query("""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 4 <> 3 THEN 'cup' END AS category, CASE p_partkey % 3 WHEN 0 THEN ' red  cup' WHEN 1 THEN 'cup' END AS colour, CASE p_partkey % 5 WHEN 0 THEN 'red cup' WHEN 1 THEN 'tall cup' END AS shape, CASE WHEN p_partkey % 7 < 5 THEN 'thing' WHEN p_partkey % 7 = 5 THEN 'tall cup' END AS fallback,
CASE p_partkey % 11 WHEN 0 THEN ['shape', 'colour'] WHEN 1 THEN ['fallback', 'category'] WHEN 2 THEN ['odd'] WHEN 3 THEN ['colour', 'colour '] WHEN 4 THEN ['shape', 'fallback', 'colour', 'category'] ELSE [] END AS ord FROM part),
o AS (SELECT *, list_transform(ord, lambda x: trim(x)) AS so FROM p), l AS (SELECT id, so, f, ['category', 'colour', 'shape', 'fallback'].list_position(f) AS pos, coalesce(nullif(list_position(so, f), 0), 99) AS rank, regexp_replace(trim(q), '\\s+', ' ', 'g') AS q FROM (SELECT id, so, unnest(['category', 'colour', 'shape', 'fallback']) AS f, unnest([category, colour, shape, fallback]) AS q FROM o) WHERE q IS NOT NULL),
w AS (SELECT *, first_value(f) OVER (PARTITION BY id, q ORDER BY f <> 'category', rank, pos) AS owner FROM l), r AS (SELECT id, owner AS f, min(rank) AS rank, min(pos) FILTER (f = owner) AS pos FROM w GROUP BY 1, 2)
SELECT o.id, CASE WHEN reason IS NULL THEN coalesce((SELECT string_agg(f, ',' ORDER BY f = 'fallback', rank, pos) FROM r WHERE r.id = o.id), '') END AS ordered, CASE WHEN reason IS NULL THEN (SELECT count(*) FROM r WHERE r.id = o.id) END AS queries, reason FROM (SELECT *, CASE WHEN len(list_distinct(so)) < len(so) THEN 'repeated' WHEN list_contains(so, 'odd') THEN 'unknown' END AS reason FROM o) o""")
def repaired_banks(spark, d):
    """Banks of queries with repeated ones merged and their order completed."""
    k = c("p_partkey")
    texts = lambda *xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    order = F.when(k % 11 == 0, texts("shape", "colour")).when(k % 11 == 1, texts("fallback", "category")).when(k % 11 == 2, texts("odd")).when(k % 11 == 3, texts("colour", "colour ")).when(k % 11 == 4, texts("shape", "fallback", "colour", "category")).otherwise(texts())
    p = src.table(spark, d, "part").select(
        k.alias("id"), F.when(k % 4 != 3, "cup").alias("category"), F.when(k % 3 == 0, " red  cup").when(k % 3 == 1, "cup").alias("colour"), F.when(k % 5 == 0, "red cup").when(k % 5 == 1, "tall cup").alias("shape"),
        F.when(k % 7 < 5, "thing").when(k % 7 == 5, "tall cup").alias("fallback"), order.alias("order"),
    )
    found = contracts.repaired_bank(p, _FIELDS, "order", "category", "fallback")
    return found.select("id", F.array_join("order", ",").alias("ordered"), F.when(c("reason").isNull(), F.size("bank")).cast("long").alias("queries"), "reason")


# --- channels, records, digests


@query(f"""WITH {_masks(0.2)}, a AS (SELECT episode, frame // 4 AS frame, (frame % 4)::INT AS channel, area FROM mx), t AS (SELECT episode, frame, area FROM a WHERE channel = 1 AND frame % 5 <> 2)
SELECT a.episode, a.channel, a.frame, CASE WHEN a.channel < 2 THEN a.area WHEN a.channel = 2 + a.episode % 2 THEN coalesce(t.area, 0) ELSE 0 END AS pixels, CASE WHEN a.channel < 2 THEN (a.area > 0)::INT WHEN a.channel = 2 + a.episode % 2 THEN (coalesce(t.area, 0) > 0)::INT ELSE 0 END AS code,
CASE WHEN a.channel < 2 OR a.channel = 2 + a.episode % 2 THEN 'valid' ELSE 'not_annotated' END AS status, CASE WHEN a.channel < 2 THEN 'passed' ELSE 'not_run' END AS qc_status, 0 AS differences
FROM a LEFT JOIN t ON t.episode = a.episode AND t.frame = a.frame WHERE a.channel < 2 OR a.episode % 7 <> 5""")
def channel_tracks(spark, d):
    """Four channels of all episodes with a gripper's track in place; the objects' stay as they were."""
    at = c("frame")
    m = src.mask_frames(spark, d, 0.2).select("episode", (at % 4).cast("int").alias("channel"), F.floor(at / 4).alias("frame"), F.array("mask").alias("mask"), (c("mask") != 0).cast("int").alias("code"), F.lit("valid").alias("status"), F.lit("passed").alias("qc_status"))
    track = m.where("channel = 1 and frame % 5 <> 2").select("episode", "frame", "mask")
    arms = m.select("episode").distinct().where("episode % 7 <> 5").withColumn("arm", F.when(c("episode") % 2 == 0, "left").otherwise("right"))
    found = contracts.composed_channels(m, track, arms)
    odd = contracts.composition_differences(found, m).groupBy("episode").agg(F.count("*").alias("differences"))
    return found.join(odd, "episode", "left").select("episode", "channel", "frame", bitmaps.area(c("mask")).alias("pixels"), "code", "status", "qc_status", F.coalesce("differences", F.lit(0)).alias("differences"))


@query("""SELECT o_orderkey AS episode, CASE WHEN o_orderkey % 10 = 0 THEN 'skipped' WHEN o_orderkey % 10 = 1 THEN 'excluded' WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'results' END AS kind, CASE WHEN o_orderkey % 10 = 1 THEN 'contract' END AS reason, CASE WHEN o_orderkey % 10 > 1 AND o_orderstatus = 'P' THEN 'RuntimeError' END AS error_type, CASE WHEN o_orderkey % 10 > 1 AND o_orderstatus <> 'P' THEN o_custkey END AS frames FROM orders""")
def run_records(spark, d):
    """A run's records of all kinds below each other."""
    o = src.table(spark, d, "orders").withColumn("episode", c("o_orderkey"))
    rest = o.where("o_orderkey % 10 > 1")
    return contracts.all_records(
        skipped=o.where("o_orderkey % 10 = 0").select("episode"), excluded=o.where("o_orderkey % 10 = 1").select("episode", F.lit("contract").alias("reason")),
        results=rest.where("o_orderstatus <> 'P'").select("episode", c("o_custkey").alias("frames")), failed=rest.where("o_orderstatus = 'P'").select("episode", F.lit("RuntimeError").alias("error_type")),
    )


@query("""WITH e AS (SELECT event_id, '{"at":{"a":' || user_id || ',"z":[1,null,"é"]},"kind":"' || event_type || '"}' AS body, event_id % 5 AS k FROM events)
SELECT event_id, CASE WHEN k = 4 THEN NULL ELSE sha256(body) END AS digest, CASE k WHEN 4 THEN 'json' WHEN 3 THEN 'none' WHEN 2 THEN 'changed' END AS reason FROM e""")
def record_digests(spark, d):
    """Digests of records whose keys come in any order, and whether the digest that a record carries is its own."""
    k = c("event_id") % 5
    e = src.table(spark, d, "events").withColumn("sorted", F.format_string('{"at":{"a":%d,"z":[1,null,"é"]},"kind":"%s"}', "user_id", "event_type"))
    stated = F.when(k == 2, F.sha2("event_type", 256)).when(k == 3, F.lit("short")).otherwise(F.sha2("sorted", 256))
    value = F.when(k == 4, F.lit("[1]")).otherwise(F.format_string('{ "kind": "%s", "sha": "%s", "at": {"z": [1, null, "é"], "a": %d} }', "event_type", stated, "user_id"))
    return e.select("event_id", F.sha2(contracts.canonical_json(value, "sha"), 256).alias("digest"), contracts.self_hash_reason(value, "sha").alias("reason"))


@query("""WITH s AS (SELECT label::BIGINT AS file, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 + CASE WHEN label % 4 = 1 AND vec_id % 50 = 7 THEN 1 ELSE 0 END AS f, label + CASE WHEN label % 5 = 2 AND vec_id % 40 = 3 THEN 1 ELSE 0 END AS e, vec_id % 6 IN (0, 1) AS bad, vec_id % 5 = 0 AS odd FROM embeddings),
g AS (SELECT file, count(*) AS frames, min(f) AS lo, max(f) AS hi, count(DISTINCT f) AS df, count(DISTINCT e) AS de, count(CASE WHEN bad THEN 1 END) AS states, count(CASE WHEN odd THEN 1 END) AS joints FROM s GROUP BY 1)
SELECT file, frames, states AS odd_states, joints AS odd_joints, concat_ws(',', CASE WHEN lo <> 0 OR hi <> frames - 1 OR df <> frames THEN 'frames' END, CASE WHEN de <> 1 THEN 'episodes' END, CASE WHEN states > 0 THEN 'states' END, CASE WHEN joints > 0 THEN 'joints' END) AS reasons FROM g""")
def state_files(spark, d):
    """What is wrong with every file of states: frames, more than one episode, states and joints that aren't as they should be."""
    v, label = c("vec_id"), c("label")
    at = F.row_number().over(sequence.Window.partitionBy("label").orderBy("vec_id")) - 1
    s = F.slice("embedding", 1, 14).cast("array<double>")
    state = F.when(v % 6 == 0, F.slice(s, 1, 13)).when(v % 6 == 1, F.transform(s, lambda x, i: F.when(i == 3, float("nan")).otherwise(x))).otherwise(s)
    joints = F.when(v % 5 == 0, F.array(F.lit(1.0))).otherwise(F.slice("embedding", 15, 12).cast("array<double>"))
    rows = src.table(spark, d, "embeddings").select(
        label.cast("bigint").alias("file"), (at + F.when((label % 4 == 1) & (v % 50 == 7), 1).otherwise(0)).alias("frame_index"), (label + F.when((label % 5 == 2) & (v % 40 == 3), 1).otherwise(0)).alias("episode_index"),
        state.alias("observation.state"), joints.alias("observation.state.joint_absolute"),
    )
    return episodes.file_violations(rows, "file", 12)


# --- stages taken up again


@query("""WITH e AS (SELECT o_orderkey AS episode, count(*) AS n, any_value(o_custkey) AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1), t AS (SELECT e.*, r.role, row_number() OVER () AS x FROM e, (VALUES ('target'), ('receiver')) r(role)),
p AS (SELECT l_orderkey AS episode, sum(l_suppkey % 2) + count(*) AS pixels, count(DISTINCT l_linenumber) AS lines FROM lineitem GROUP BY 1)
SELECT t.episode, t.role, CASE WHEN reason IS NULL THEN n END AS frames, CASE WHEN reason IS NULL THEN pixels END AS pixels, CASE WHEN reason IS NULL THEN 0 END AS seed_frame, reason FROM (SELECT t.*, pixels, CASE WHEN k % 11 = 0 THEN 'manifest' WHEN k % 13 = 0 THEN 'task' WHEN k % 17 = 0 THEN 'frame_count' WHEN k % 19 = 0 AND role = 'target' THEN 'role' WHEN k % 23 = 0 AND role = 'receiver' THEN 'role'
WHEN k % 5 = 1 THEN 'status' WHEN k % 29 = 0 THEN 'track' WHEN k % 31 = 0 THEN 'frames' WHEN k % 37 = 0 THEN 'seed_frame' WHEN k % 41 = 0 AND role = 'target' THEN 'seed' END AS reason FROM t JOIN p USING (episode)) t""")
def stage_rehydrate(spark, d):
    """Saved roles of every order's episode put together again, or why they can't be."""
    o, k = src.table(spark, d, "orders").select(c("o_orderkey").alias("episode"), c("o_custkey").alias("k")), c("k")
    at = F.row_number().over(sequence.Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount", "l_extendedprice")) - 1
    lines = src.table(spark, d, "lineitem").select(c("l_orderkey").alias("episode"), at.alias("frame"), F.array(F.when(c("l_suppkey") % 2 == 1, 3).otherwise(1).cast("bigint")).alias("mask")).join(o, "episode")
    e = lines.groupBy("episode", "k").agg(F.count("*").alias("frames"))
    expected = e.select("episode", F.lit("cup").alias("task"), F.lit("front").alias("camera"), "frames")
    manifests = e.where(k % 11 != 0).select("episode", F.when(k % 13 == 0, "pan").otherwise("cup").alias("task"), F.lit("front").alias("camera"), (c("frames") + F.when(k % 17 == 0, 1).otherwise(0)).alias("frame_count"))
    each = e.select("episode", "k", F.explode(F.array(F.lit("target"), F.lit("receiver"))).alias("role"))
    name = F.concat_ws("/", c("episode").cast("string"), "role")
    one = each.where(~((k % 19 == 0) & (c("role") == "target"))).select("episode", "role", F.lit("ok").alias("status"), F.when(k % 5 == 1, "failed").otherwise("passed").alias("qc_status"), name.alias("track"), name.alias("seed"), F.when(k % 37 == 0, 99).otherwise(0).alias("seed_frame"), "k")
    roles = one.unionByName(one.where((k % 23 == 0) & (c("role") == "receiver"))).drop("k")
    tracks = lines.where((k % 29 != 0) & ~((k % 31 == 0) & (c("frame") == 0))).unionByName(lines.where((k % 31 == 0) & (k % 29 != 0) & (c("frame") == 0)).withColumn("frame", F.lit(-1)))
    tracks = tracks.select(F.explode(F.array(*(F.concat_ws("/", c("episode").cast("string"), F.lit(r)) for r in ("target", "receiver")))).alias("track"), "frame", "mask")
    seeds = each.select(name.alias("seed"), F.array(F.when((k % 41 == 0) & (c("role") == "target"), 0).otherwise(1).cast("bigint")).alias("mask"))
    return stages.rehydrated(manifests, roles, tracks, seeds, expected, ("target", "receiver"))


_SEEDED = ORACLES["temporal_qc_window"].replace("WHERE frame = 3 AND episode % 2 = 0", "WHERE frame = 3 AND episode % 3 <> 1")


@query(f"""WITH {_BITS}, q AS ({_SEEDED}), sd AS (SELECT episode, count(*) AS seed FROM wh WHERE frame = 3 AND episode % 3 <> 1 GROUP BY 1), n AS (SELECT episode, count(CASE WHEN frame BETWEEN 2 AND 20 + episode % 10 THEN 1 END) AS frames FROM bm GROUP BY 1), p AS (SELECT episode, count(*) AS pixels FROM wh WHERE frame BETWEEN 2 AND 20 + episode % 10 GROUP BY 1),
x AS (SELECT n.episode, n.frames, coalesce(pixels, 0) AS pixels, coalesce(seed, 0) AS seed, q.status AS qc, CASE WHEN coalesce(seed, 0) = 0 THEN 'empty_text_seed' WHEN coalesce(pixels, 0) = 0 THEN 'native_track_empty_in_output_window' WHEN q.status = 'quarantine' THEN 'temporal_qc_quarantine:' || issues WHEN n.episode % 4 = 2 THEN 'identity_qc_reject:wrong object' END AS failure FROM n LEFT JOIN q USING (episode) LEFT JOIN sd USING (episode) LEFT JOIN p USING (episode))
SELECT 'run2' AS run, episode, CASE WHEN episode % 2 = 0 THEN 'target' ELSE 'receiver' END AS role, CASE WHEN failure IS NULL THEN 'ok' WHEN starts_with(failure, 'temporal') OR starts_with(failure, 'identity') THEN 'quarantined' ELSE 'failed' END AS status, failure, frames, CASE WHEN failure IS NULL THEN pixels ELSE 0 END AS pixels, CASE WHEN seed > 0 THEN qc END AS qc_status FROM x""")
def derived_run_qc(spark, d):
    """A run derived from saved tracks: new windows, checks of its own, the review's word, and a digest of each source."""
    role = F.when(c("episode") % 2 == 0, "target").otherwise("receiver").alias("role")
    m = _wide(spark, d).select("episode", role, "frame", "mask")
    seed = m.where("frame = 3 and episode % 3 <> 1").select("episode", c("mask").alias("seed"))
    roles = m.select("episode", "role").distinct().join(seed, "episode", "left").select("episode", "role", F.lit(2).alias("start"), (20 + c("episode") % 10).alias("end"), "seed")
    said = roles.select("episode", "role", F.when(c("episode") % 4 == 2, "reject").otherwise("accept").alias("decision"), F.lit(" wrong  object").alias("reason"))
    return stages.derived_roles(m, roles, said, 2, "run2").drop("source")


@query("""WITH l AS (SELECT l_orderkey AS episode, count(CASE WHEN l_quantity > 30 THEN 1 END) AS valid, bool_or(l_quantity > 30 AND l_linenumber = 1) AS has_a FROM lineitem GROUP BY 1), k AS (SELECT l.*, l.episode % 13 AS k FROM l),
x AS (SELECT *, CASE WHEN valid = 0 THEN 'basic_checks' WHEN k = 0 THEN 'request:timeout 3' WHEN k = 1 THEN 'request:none' WHEN k = 2 THEN 'answer:json' WHEN k IN (3, 4, 5, 6, 12) AND NOT has_a THEN 'answer:candidate' WHEN k = 3 THEN 'confidence' WHEN k IN (7, 8) THEN 'two alike' WHEN k = 9 THEN 'none fits' WHEN k = 10 THEN 'answer:missing_selection' WHEN k = 11 THEN 'answer:empty' ELSE 'fits' END AS reason FROM k)
SELECT episode, CASE WHEN reason = 'basic_checks' OR reason = 'none fits' THEN 'rejected' WHEN contains(reason, ':') THEN 'error' WHEN reason IN ('confidence', 'two alike') THEN 'ambiguous' ELSE 'passed' END AS status, CASE WHEN reason = 'fits' THEN 'A' END AS selected, CASE reason WHEN 'fits' THEN 0.9 WHEN 'confidence' THEN 0.3 WHEN 'two alike' THEN 0.5 WHEN 'none fits' THEN 0.8 END::DOUBLE AS confidence, reason FROM x""")
def visual_reports(spark, d):
    """What a model's answers about every order's candidates come to, failed attempts and unreadable answers included."""
    line = src.table(spark, d, "lineitem").select(c("l_orderkey").alias("episode"), F.char(c("l_linenumber") + 64).alias("candidate"), (c("l_quantity") > 30).alias("valid"))
    k = c("episode") % 13
    said = lambda decision, picked, share, why: F.lit(json.dumps({"decision": decision, "selected_candidate": picked, "confidence": share, "reason": why}))
    text = (
        F.when(k == 2, "{oops").when(k == 3, said("accept", "a", 0.3, "fits")).when(k.isin(7, 8), said("ambiguous", None, 0.5, "two  alike")).when(k == 9, said("reject_all", None, 0.8, "none fits"))
        .when(k == 10, said("accept", None, 0.9, "fits")).when(k == 11, "  ").otherwise(said("accept", "A", 0.9, "fits"))
    )
    # some are answered at the second attempt, some never or too late
    turn = F.explode(F.when(k == 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.lit(4))))
    asked = line.select("episode").distinct().select("episode", turn.alias("attempt"))
    late = ((k == 0) & (c("attempt") < 4)) | ((k == 4) & (c("attempt") == 1))
    answers = asked.select("episode", "attempt", F.when(~late, text).alias("answer"), F.when(late, F.concat(F.lit("timeout "), c("attempt").cast("string"))).alias("error"))
    return stages.visual_reports(line, answers, ["episode"], 3, 0.4)
