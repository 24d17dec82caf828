"""The query catalogue over the test tables: telemetry, trials, sources and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marlstone.functions import text
from marlstone.operators import search
from marlstone.operators import telemetry as tele
from marlstone.operators import trials as tr
from marlstone.plans import views as V
from marlstone.sources import logs, telemetry_csv
from marlstone.streaming import live

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


_MS = "round({0} * 1000, 6)"


@query("""WITH s AS (SELECT event_type, list(value ORDER BY value) AS v, count(*) AS n, avg(value) AS a, quantile_cont(value, 0.5) AS m FROM events GROUP BY 1)
SELECT event_type, n AS sample_count, round(a * 1000, 6) AS average_ms, round(v[1] * 1000, 6) AS minimum_ms, round(m * 1000, 6) AS median_ms, round(v[CAST(round_even((n - 1) * 0.95, 0) AS INT) + 1] * 1000, 6) AS p95_ms,
  round(v[CAST(round_even((n - 1) * 0.99, 0) AS INT) + 1] * 1000, 6) AS p99_ms, round(v[-1] * 1000, 6) AS maximum_ms FROM s""")
def latency_summary(spark, sf_dir):
    out = tele.latency_summary(V.table(spark, sf_dir, "events"), "value", "event_type")
    return out.select("event_type", "sample_count", *[F.round(c, 6).alias(c) for c in ("average_ms", "minimum_ms", "median_ms", "p95_ms", "p99_ms", "maximum_ms")])


@query("""SELECT user_id AS device, count(*) AS sample_count, round(avg(value), 6) AS utilization_average, max(value) AS utilization_peak, max(CASE WHEN event_id % 7 <> 0 THEN value END) AS power_peak,
  CAST(round_even(avg(coalesce(CASE WHEN event_id % 3 <> 0 THEN event_id END, 0)), 0) AS BIGINT) AS memory_average_bytes, max(coalesce(CASE WHEN event_id % 3 <> 0 THEN event_id END, 0)) AS memory_peak_bytes FROM events GROUP BY 1""")
def resource_peaks(spark, sf_dir):
    s = V.samples(spark, sf_dir)
    own = s.select("device", "t", F.col("value").alias("utilization_percent"), F.col("watts").alias("power_draw_watts"), F.col("value").alias("temperature_celsius"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("memory_used_bytes"),
                   F.lit(1 << 40).alias("memory_total_bytes"), F.lit(450.0).alias("power_limit_watts"))
    return tele.gpu_summary(own).select("device", "sample_count", F.round("utilization_average", 6).alias("utilization_average"), "utilization_peak", "power_peak", "memory_average_bytes", "memory_peak_bytes")


@query(f"""WITH {V.SAMPLES_SQL}, st AS (SELECT device, watts, lag(watts) OVER w * (t - lag(t) OVER w) AS step FROM samples WINDOW w AS (PARTITION BY device ORDER BY t, event_id))
SELECT device, round(CASE WHEN count(watts) > 0 THEN coalesce(sum(step), 0) END, 2) AS joules FROM st GROUP BY 1""")
def energy_left_riemann(spark, sf_dir):
    return tele.energy(V.samples(spark, sf_dir), "watts", "event_id").withColumn("joules", F.round("joules", 2))


@query(f"""WITH {V.SAMPLES_SQL}, st AS (SELECT device, watts, lag(watts) OVER w * (t - lag(t) OVER w) AS step FROM samples WHERE coalesce(watts, 0) > 0 WINDOW w AS (PARTITION BY device ORDER BY t, event_id))
SELECT device, round(CASE WHEN count(watts) > 0 THEN coalesce(sum(step), 0) END, 2) AS joules FROM st GROUP BY 1""")
def energy_skip_zero(spark, sf_dir):
    return tele.energy_of_active(V.samples(spark, sf_dir), "watts", "event_id").withColumn("joules", F.round("joules", 2))


@query(f"""WITH {V.SAMPLES_SQL} SELECT device, event_id, round(coalesce(greatest(0.0, value - lag(value) OVER w) / greatest(t - lag(t) OVER w, 1e-9), 0), 4) AS rate FROM samples WINDOW w AS (PARTITION BY device ORDER BY t, event_id)""")
def growth_rates(spark, sf_dir):
    return tele.rates(V.samples(spark, sf_dir), "value", "event_id").select("device", "event_id", F.round("rate", 4).alias("rate"))


@query(f"""WITH {V.SAMPLES_SQL}, m AS (SELECT *, value >= 20 AS over, sum(CASE WHEN value >= 20 THEN 0 ELSE 1 END) OVER (PARTITION BY device ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS island FROM samples),
f AS (SELECT device, t, min(t) OVER (PARTITION BY device, island) AS since FROM m WHERE over)
SELECT device, round(min(t), 3) AS fired_at, round(min_by(since, t), 3) AS since FROM f WHERE t - since >= 3600 GROUP BY 1""")
def sustained_breach(spark, sf_dir):
    s = V.samples(spark, sf_dir)
    return tele.sustained(s, F.col("value") >= 20, 3600.0, "event_id").select("device", F.round("fired_at", 3).alias("fired_at"), F.round("since", 3).alias("since"))


@query("""SELECT event_id, 'gpu_temperature_celsius' AS key, value FROM events WHERE value >= 88 UNION ALL SELECT event_id, 'gpu_memory_percent', value / 2 FROM events WHERE value / 2 >= 99""")
def policy_breaches(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    own = e.select("event_id", (F.col("value") / 2).alias("gpu_memory_percent"), F.col("value").alias("gpu_temperature_celsius"), F.col("value").alias("gpu_power_watts"))
    return tele.breaches(own, {"gpu_memory_percent": 99.0, "gpu_temperature_celsius": 88.0, "gpu_power_watts": None}).select("event_id", "key", "value")


@query(f"""WITH {V.SAMPLES_SQL}, g AS (SELECT device, t, t - lag(t) OVER (PARTITION BY device ORDER BY t, event_id) AS gap FROM samples) SELECT device, count(*) AS marks, round(max(gap), 3) AS longest_gap, round(max(t), 3) AS last_mark FROM g GROUP BY 1""")
def longest_gap(spark, sf_dir):
    return tele.longest_gap(V.samples(spark, sf_dir), "event_id").select("device", "marks", F.round("longest_gap", 3).alias("longest_gap"), F.round("last_mark", 3).alias("last_mark"))


@query(f"""WITH {V.SAMPLES_SQL}, p AS (SELECT device, event_id, t, coalesce(last_value(CASE WHEN event_type IN ('purchase', 'signup') THEN event_type END IGNORE NULLS) OVER w, 'model_loading') AS phase,
  coalesce(last_value(CASE WHEN event_type IN ('purchase', 'signup') THEN t END IGNORE NULLS) OVER w, first_value(t) OVER w) AS began FROM samples WINDOW w AS (PARTITION BY device ORDER BY t, event_id ROWS UNBOUNDED PRECEDING))
SELECT device, event_id, phase, round(t - began, 3) AS phase_seconds FROM p""")
def phase_segments(spark, sf_dir):
    marker = F.when(F.col("event_type").isin("purchase", "signup"), F.col("event_type"))
    return tele.phases(V.samples(spark, sf_dir), marker, "event_id").select("device", "event_id", "phase", F.round("phase_seconds", 3).alias("phase_seconds"))


@query(f"WITH {V.SAMPLES_SQL}, n AS (SELECT max(t) - 3600 AS now FROM samples) SELECT event_id, round(greatest(0, now - t), 3) AS age_seconds FROM samples, n WHERE greatest(0, now - t) <= 7200")
def stale_filter(spark, sf_dir):
    s = V.samples(spark, sf_dir)
    now = s.agg((F.max("t") - 3600).alias("now"))  # one row
    return tele.fresh(s.crossJoin(now), F.col("now"), 7200.0).select("event_id", F.round("age_seconds", 3).alias("age_seconds"))


@query("SELECT user_id AS device, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_snapshot(spark, sf_dir):
    s = V.table(spark, sf_dir, "events").select(F.col("user_id").alias("device"), "event_id", F.struct("ts", F.col("event_id").alias("e")).alias("at"))
    return tele.latest(s, "device", "at", "event_id")


@query("SELECT round(max(total), 4) AS peak FROM (SELECT date_trunc('minute', ts) AS t, sum(value) AS total FROM events GROUP BY 1)")
def running_peak(spark, sf_dir):
    e = V.table(spark, sf_dir, "events").select(F.date_trunc("minute", "ts").alias("t"), "value")
    return tele.running_peaks(e, "value").select(F.round("peak", 4).alias("peak"))


# --- trials ----------------------------------------------------------------------------------


@query(f"WITH {V.TRIALS_SQL} SELECT model, 'size' AS axis, CAST(max(size) AS VARCHAR) AS value, count(*) AS completed FROM trials WHERE status = 'completed' AND size <= 20 GROUP BY 1")
def capacity_frontier(spark, sf_dir):
    values = spark.range(1, 21).select(F.lit("size").alias("axis"), F.col("id").cast("string").alias("value"), F.col("id").alias("ordinal"))
    return tr.capacity_frontier(V.trials(spark, sf_dir), ("size",), values).select("model", "axis", "value", "completed")


@query(f"""WITH {V.TRIALS_SQL} SELECT model, count(*) AS trial_count, count(*) FILTER (WHERE status = 'completed') AS completed_trial_count, count(*) FILTER (WHERE NOT model_weights_reused) AS model_load_count,
  count(*) FILTER (WHERE model_weights_reused) AS reused_trial_count, greatest(0, count(*) FILTER (WHERE NOT model_weights_reused) - 1) AS worker_restart_count, bool_or(status = 'completed') AS supported FROM trials GROUP BY 1""")
def model_execution(spark, sf_dir):
    return tr.model_execution(V.trials(spark, sf_dir))


@query(f"WITH {V.TRIALS_SQL} SELECT model, max(trial_number) AS trial_number, max_by(trial_id, trial_number) AS trial_id, max_by(size, trial_number) AS size FROM trials WHERE status = 'completed' GROUP BY 1")
def latest_safe(spark, sf_dir):
    return tr.latest_safe(V.trials(spark, sf_dir), "trial_id", "size")


_GRID = """models AS (SELECT model, row_number() OVER (ORDER BY model) - 1 AS model_index FROM (SELECT DISTINCT p_brand AS model FROM part)),
sizes AS (SELECT size, row_number() OVER (ORDER BY size) - 1 AS size_index FROM (SELECT DISTINCT p_size AS size FROM part)),
grid AS (SELECT *, row_number() OVER (ORDER BY model_index, size_index) AS position FROM models, sizes)"""


def _grid(spark, sf_dir):
    """All brands with all sizes: the candidate lists are the tables' distinct values, in order."""
    p = V.table(spark, sf_dir, "part")

    def axis(column, name):
        rank = F.row_number().over(Window.orderBy(name)) - 1  # one row a candidate
        return p.select(F.col(column).alias(name)).distinct().withColumn(f"{name}_index", rank)

    return tr.grid(axis("p_brand", "model"), axis("p_size", "size"))


@query(f"WITH {_GRID} SELECT model, size, CAST(position AS INT) AS position FROM grid")
def grid_product(spark, sf_dir):
    return _grid(spark, sf_dir).select("model", "size", "position")


@query(f"""WITH {_GRID}, {V.TRIALS_SQL.strip()}, b AS (SELECT DISTINCT g.* FROM grid g JOIN trials t ON t.model = g.model AND t.size = g.size WHERE t.status = 'timeout')
SELECT model, size FROM grid g WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.model = g.model AND g.position > b.position AND g.size_index >= b.size_index)""")
def grid_pruned(spark, sf_dir):
    """Combinations that no recorded timeout of the model rules out."""
    g = _grid(spark, sf_dir)
    lost = V.trials(spark, sf_dir).where("status = 'timeout'").select("model", "size").distinct()
    kept, _ = tr.pruned(g, g.join(lost, ["model", "size"], "left_semi"), ("model",), "size_index")
    return kept.select("model", "size")


_SEARCHED = """WITH {0}, b AS (SELECT t.*, (SELECT min(b.trial_number) FROM trials b WHERE b.model = t.model AND b.status = 'timeout' AND b.size <= t.size AND b.trial_number < t.trial_number) AS edge FROM trials t),
n AS (SELECT *, count(*) FILTER (WHERE edge IS NULL) OVER (ORDER BY trial_number) AS upto FROM b),
s AS (SELECT *, CASE WHEN upto - CAST(edge IS NULL AS INT) >= {1} THEN 'not_reached' WHEN edge IS NULL THEN 'run' ELSE 'pruned' END AS state FROM n)
SELECT trial_id, s.state, CASE WHEN s.state = 'run' THEN upto END AS number, CASE WHEN s.state = 'pruned' THEN edge END AS boundary_position, CASE WHEN s.state = 'pruned' THEN (SELECT size FROM trials x WHERE x.trial_number = s.edge) END AS boundary_size FROM s"""


def _searched(spark, sf_dir, cap):
    own = V.trials(spark, sf_dir).select("trial_id", "model", "size", F.col("trial_number").alias("position"), "status")
    found = search.grid_search(own, ["model"], "size", cap)
    return found.select("trial_id", "state", F.col("trial_number").alias("number"), "boundary_position", F.col("boundary_index").alias("boundary_size"))


@query(_SEARCHED.format(V.TRIALS_SQL.strip(), 10**9))
def grid_searched(spark, sf_dir):
    """All parts as a grid in order of their keys: the boundaries are what times out on the way."""
    return _searched(spark, sf_dir, None)


@query(_SEARCHED.format(V.TRIALS_SQL.strip(), 60))
def grid_searched_capped(spark, sf_dir):
    """The same search with at most 60 trials."""
    return _searched(spark, sf_dir, 60)


#: The staged search's axes, slowest first.
AXES = {"length": [1, 2, 4, 8], "batch": [1, 2, 3], "rank": [8, 16]}


def _staged_sql() -> str:
    """One part a model; each axis in turn, from the last safe configuration of those before."""
    names = list(AXES)
    status = "CASE (k * 7 + length * 3 + batch * 5 + rank) % 10 WHEN 9 THEN 'threshold_reached' WHEN 8 THEN 'timeout' WHEN 7 THEN 'timeout' ELSE 'completed' END"
    out = ["s0 AS (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS model, p_partkey AS k, FALSE AS gone, FALSE AS least, " + ", ".join(f"{v[0]} AS {a}" for a, v in AXES.items()) + " FROM part)"]
    for n, (axis, values) in enumerate(AXES.items()):
        listed = ", ".join(f"({k}, {v})" for k, v in enumerate(values))
        out.append(f"c{n} AS (SELECT model, k, gone, least, {', '.join('v AS ' + a if a == axis else a for a in names)}, ordinal FROM s{n}, (VALUES {listed}) o(ordinal, v) WHERE NOT gone AND ordinal >= {min(n, 1)})")
        out.append(f"d{n} AS (SELECT *, {status} AS status FROM c{n})")
        out.append(f"e{n} AS (SELECT s.*, (SELECT min(ordinal) FROM d{n} d WHERE d.model = s.model AND d.status <> 'completed') AS fail FROM s{n} s)")
        out.append(f"f{n} AS (SELECT e.*, (SELECT status FROM d{n} d WHERE d.model = e.model AND d.ordinal = e.fail) AS why FROM e{n} e)")
        at = lambda k: f"CAST(list_extract({values}, CAST({k} AS INT)) AS VARCHAR)"  # noqa: E731, B023  counted from 1
        out.append(f"""r{n} AS (SELECT d.model, '{axis}' AS axis, {n} AS axis_number, d.ordinal, {at("d.ordinal + 1")} AS candidate, CASE WHEN f.fail IS NULL OR d.ordinal <= f.fail THEN 'tried' ELSE 'pruned' END AS state,
  CASE WHEN f.fail IS NULL OR d.ordinal <= f.fail THEN d.status END AS status, CASE WHEN least(d.ordinal, coalesce(f.fail, 99)) > 0 THEN {at("least(d.ordinal, coalesce(f.fail, 99))")} END AS last_safe, CASE WHEN d.ordinal > f.fail THEN {at("f.fail + 1")} END AS boundary
  FROM d{n} d JOIN f{n} f USING (model) WHERE f.fail IS NULL OR d.ordinal <= f.fail OR f.why = 'timeout'
  UNION ALL SELECT model, '{axis}', {n}, ordinal, CAST(v AS VARCHAR), 'pruned', NULL, NULL, NULL FROM s{n}, (VALUES {listed}) o(ordinal, v) WHERE least)""")
        safe = f"list_extract({values}, CAST(greatest(coalesce(fail, {len(values)}), 1) AS INT))"
        gone = "coalesce(fail = 0, FALSE) AS gone, coalesce(fail = 0 AND why = 'timeout', FALSE) AS least" if n == 0 else "gone, least"
        out.append(f"s{n + 1} AS (SELECT model, k, {gone}, {', '.join(f'{safe} AS {a}' if a == axis else a for a in names)} FROM f{n})")
    rows = " UNION ALL ".join(f"SELECT * FROM r{n}" for n in range(len(names)))
    return f"WITH {', '.join(out)}, r AS ({rows}) SELECT *, count(*) FILTER (WHERE state = 'tried') OVER (PARTITION BY model ORDER BY axis_number, ordinal) AS trial_number FROM r"


@query(_staged_sql())
def staged_searched(spark, sf_dir):
    """A staged search for each part, over outcomes of all its configurations."""
    out = V.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("model"), F.col("p_partkey").alias("k")).distinct()
    for axis, values in AXES.items():
        out = out.withColumn(axis, F.explode(F.array(*[F.lit(v) for v in values])))
    k = (F.col("k") * 7 + F.col("length") * 3 + F.col("batch") * 5 + F.col("rank")) % 10
    status = F.when(k == 9, "threshold_reached").when(k >= 7, "timeout").otherwise("completed")
    return search.staged_search(out.withColumn("status", status), AXES)


@query(f"""WITH {V.TRIALS_SQL}, o AS (SELECT model, kind AS axis, size AS ordinal, min(status) AS status FROM trials GROUP BY ALL), f AS (SELECT model, axis, min(ordinal) FILTER (WHERE status <> 'completed') AS first_failure FROM o GROUP BY ALL)
SELECT model, axis, first_failure, max(CASE WHEN first_failure IS NULL OR ordinal < first_failure THEN ordinal END) AS last_safe, count(*) FILTER (WHERE first_failure IS NULL OR ordinal <= first_failure) AS tried FROM o JOIN f USING (model, axis) GROUP BY ALL""")
def staged_boundary(spark, sf_dir):
    o = V.trials(spark, sf_dir).groupBy("model", F.col("kind").alias("axis"), F.col("size").alias("ordinal")).agg(F.min("status").alias("status"))
    return tr.staged_boundary(o)


@query("SELECT trial_id, coalesce(TRY_CAST(nullif(regexp_extract(trial_id, '([0-9]+)', 1), '') AS INT), -1) AS number FROM (SELECT CASE WHEN p_partkey % 9 = 0 THEN 'final' ELSE 'trial-' || p_partkey || '-grid' END AS trial_id FROM part)")
def trial_numbers(spark, sf_dir):
    p = V.table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 9 == 0, "final").otherwise(F.concat(F.lit("trial-"), F.col("p_partkey").cast("string"), F.lit("-grid"))).alias("trial_id"))
    return p.select("trial_id", tr.trial_number(F.col("trial_id")).alias("number"))


@query("""WITH m AS (SELECT '/' AS mount UNION ALL SELECT '/mnt/' || lang FROM documents GROUP BY lang UNION ALL SELECT '/mnt/' || lang || '/' || source FROM documents WHERE doc_id % 3 = 0 GROUP BY lang, source),
p AS (SELECT DISTINCT '/mnt/' || lang || '/' || source || '/x/' || (doc_id % 10) AS path FROM documents) SELECT path, max_by(mount, length(mount)) AS mount FROM p JOIN m ON mount = '/' OR starts_with(path, mount || '/') GROUP BY path""")
def longest_prefix(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    m = d.select(F.concat(F.lit("/mnt/"), "lang").alias("mount")).distinct().union(d.where("doc_id % 3 = 0").select(F.concat(F.lit("/mnt/"), "lang", F.lit("/"), "source")).distinct()).union(spark.range(1).select(F.lit("/")))
    p = d.select(F.concat(F.lit("/mnt/"), "lang", F.lit("/"), "source", F.lit("/x/"), (F.col("doc_id") % 10).cast("string")).alias("path")).distinct()
    return tr.longest_prefix(p, m)


# --- sources and text --------------------------------------------------------------------------


@query("""SELECT conv_id, turn, CAST(i AS INT) AS line_number, lines[i] AS line FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS lines FROM conversations), unnest(range(1, len(lines) + 1)) AS t(i) WHERE trim(lines[i]) <> ''""")
def numbered_lines(spark, sf_dir):
    from marlstone.sources import jsonl

    return jsonl.numbered_lines(V.table(spark, sf_dir, "conversations"), "text", "conv_id", "turn")


@query("SELECT event_id, CAST(event_id % 50 AS INT) AS step, 50 AS of_steps, event_id % 5 = 0 AS completed FROM events WHERE event_id % 3 <> 0")
def log_events(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 3 == 0, "idle").otherwise(F.concat(F.lit("\x1b[1mstep "), (F.col("event_id") % 50).cast("string"), F.lit("/50\x1b[0m "), F.when(F.col("event_id") % 5 == 0, "TRIAL_COMPLETED").otherwise("")))
    return logs.step_events(e.select("event_id", line.alias("line"))).where("step is not null").select("event_id", "step", "of_steps", "completed")


@query("""SELECT event_id, CAST(event_id % 3 AS INT) AS device_index, CAST(CASE WHEN event_id % 4 <> 0 THEN (event_id % 1000) * 1048576 END AS BIGINT) AS memory_used_bytes, CAST(32607 * CAST(1048576 AS BIGINT) AS BIGINT) AS memory_total_bytes,
  round(CASE WHEN event_id % 4 <> 0 THEN (event_id % 1000) / 32607 * 100 END, 6) AS memory_used_percent FROM events WHERE event_id % 6 <> 0""")
def gpu_csv(spark, sf_dir):
    e = V.table(spark, sf_dir, "events")
    used = F.when(F.col("event_id") % 4 == 0, "[N/A]").otherwise((F.col("event_id") % 1000).cast("string"))
    line = F.when(F.col("event_id") % 6 == 0, "short, row").otherwise(F.concat_ws(", ", (F.col("event_id") % 3).cast("string"), F.lit("GPU"), used, F.lit("32607"), F.lit("93"), F.lit("450"), F.lit("575"), F.lit("72")))
    return telemetry_csv.gpu_rows(e.select("event_id", line.alias("line")), "line").select("event_id", "device_index", "memory_used_bytes", "memory_total_bytes", F.round("memory_used_percent", 6).alias("memory_used_percent"))


@query("SELECT doc_id, 'Doc id ' || doc_id AS label, CAST(round(n_chars / 7.0, 0) AS BIGINT) AS metric FROM documents WHERE FALSE UNION ALL SELECT doc_id, 'Doc id ' || doc_id, n_chars FROM documents")
def display_text(spark, sf_dir):
    d = V.table(spark, sf_dir, "documents")
    return d.select("doc_id", text.label(F.concat(F.lit("doc_id_"), F.col("doc_id").cast("string"))).alias("label"), text.format_metric(F.col("n_chars"), 0).cast("long").alias("metric"))


@query("""SELECT 'capacity-' || p_partkey AS record_id, CAST(greatest(2 * p_size, 1) AS BIGINT) AS words, 'capacity_' || p_partkey || '_0' AS first_word, 'capacity_' || p_partkey || '_' || ((greatest(2 * p_size, 1) - 1) % 997) AS last_word FROM part""")
def capacity_dataset(spark, sf_dir):
    """A synthetic record for each part, of a length that its size sets."""
    from marlstone.sources import jsonl

    c = jsonl.capacity_records_of(V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("token_target")))
    words = F.split(F.element_at("messages", 1)["content"], " ")
    return c.select("record_id", F.size(words).cast("long").alias("words"), words[0].alias("first_word"), F.element_at(words, -1).alias("last_word"))


# --- streams -----------------------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def stream_hourly(spark, sf_dir):
    """The streaming hourly aggregate, run to the end of the table."""
    out = live.run_to_end(live.hourly(live.event_stream(spark, sf_dir)), "update", "stream_hourly", ("n", "total"))
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "n", F.round("total", 2).alias("total"))


@query(ORACLE_SQL["sustained_breach"])
def stream_breach(spark, sf_dir):
    """First sustained breach of each device from a stateful stream; the same as in batch."""
    out = live.run_to_end(live.sustained_breaches(live.event_stream(spark, sf_dir), 20.0, 3600.0), "append", "stream_breach")
    return out.select("device", F.round("fired_at", 3).alias("fired_at"), F.round("since", 3).alias("since"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_replay(spark, sf_dir):
    """Replayed keys once, by a streaming deduplication."""
    return live.run_to_end(live.deduplicated(live.event_stream(spark, sf_dir), "user_id", "event_type").select("user_id", "event_type"), "append", "stream_replay")
