"""Windows over the events: batch twins of the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.operators import store
from residuum.plans.catalog import query, table
from residuum.streaming import flows


def _out(found, *keys):
    return found.select(F.unix_timestamp("start").alias("start"), F.unix_timestamp("end").alias("end"), *keys, "n", F.round("total", 4).alias("total"))


@query("tumbling_window", """
    SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start, CAST(epoch(date_trunc('day', ts)) + 86400 AS BIGINT) AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY ALL""")  # fmt: skip
def tumbling_window(spark, sf_dir):
    return _out(flows.tumbling(table(spark, sf_dir, "events"), "1 day", "event_type"), "event_type")


@query("sliding_window", """
    WITH e AS (SELECT value, CAST(floor(epoch(ts) / 43200) * 43200 AS BIGINT) AS s FROM events), w AS (SELECT value, unnest([s, s - 43200]) AS start FROM e)
    SELECT start, start + 86400 AS "end", count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY start""")  # fmt: skip
def sliding_window(spark, sf_dir):
    return _out(flows.sliding(table(spark, sf_dir, "events"), "1 day", "12 hours"))


@query("session_window", """
    WITH g AS (SELECT user_id, ts, value, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 7200 THEN 0 ELSE 1 END AS new FROM events),
    r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM g)
    SELECT CAST(floor(epoch(min(ts))) AS BIGINT) AS start, CAST(floor(epoch(max(ts))) AS BIGINT) + 7200 AS "end", user_id, count(*) AS n, round(sum(value), 4) AS total FROM r GROUP BY user_id, run""")  # fmt: skip
def session_window(spark, sf_dir):
    return _out(flows.sessions(table(spark, sf_dir, "events"), "2 hours", "user_id"), "user_id")


@query("refreshed", """
    WITH s AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1), n AS (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'click' GROUP BY 1),
    d AS (SELECT n.user_id, n.t, true AS due FROM n LEFT JOIN s USING (user_id) WHERE s.t IS NULL OR n.t > s.t)
    SELECT coalesce(s.user_id, d.user_id) AS id, CAST(floor(epoch(greatest(coalesce(s.t, d.t), coalesce(d.t, s.t)))) AS BIGINT) AS modified, coalesce(due, false) AS due FROM s FULL JOIN d ON s.user_id = d.user_id""")  # fmt: skip
def refreshed(spark, sf_dir):
    """Users viewed until the middle of the month as the state, their clicks as notices of modification."""
    rows = flows.with_time(table(spark, sf_dir, "events")).select(F.col("user_id").alias("id"), F.col("ts").alias("modified_at"), "event_type")
    state = rows.where("event_type = 'view' AND modified_at < '2024-01-16'").groupBy("id").agg(F.max("modified_at").alias("modified_at"))
    due, after = store.refresh(state, rows.where("event_type = 'click'"))
    marked = after.join(due.select("id", F.lit(True).alias("due")), "id", "left")
    return marked.select("id", F.unix_timestamp("modified_at").alias("modified"), F.coalesce("due", F.lit(False)).alias("due"))
