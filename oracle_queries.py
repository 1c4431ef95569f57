"""Plain SQL for every query in ``__spark_entry__``, run by DuckDB on the same tables.

Written on its own, from the rules and not from the Spark code: windows run over
a machine's whole series here, and groups are formed with DISTINCT and joins.
"""

from __future__ import annotations

_SECONDS = "date_diff('second', TIMESTAMP '1995-01-01 00:00:00', {})"

TABLES = {
    "machine_events": f"""
        SELECT {_SECONDS.format("o_orderdate")} * 1000000 + o_orderkey AS time,
               CAST(floor(o_custkey / 15.0) AS BIGINT) AS machine_id,
               CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS event_type,
               CASE WHEN o_custkey % 23 = 0 THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN CAST(0.25 AS DOUBLE)
                    WHEN o_orderpriority = '2-HIGH' THEN CAST(1.0 AS DOUBLE)
                    ELSE CAST(0.5 AS DOUBLE) END AS cpus
        FROM orders""",
    "job_events": f"""
        SELECT {_SECONDS.format("o_orderdate")} * 1000000 + k * 60000000 AS time,
               o_orderkey AS job_id,
               CASE WHEN k < 2 THEN k
                    WHEN o_custkey % 10 = 0 THEN 2
                    WHEN o_custkey % 10 = 1 THEN 3
                    WHEN o_custkey % 10 IN (2, 3, 4) THEN 5
                    ELSE 4 END AS event_type,
               CASE WHEN o_custkey % 41 = 0 THEN NULL
                    WHEN o_orderpriority = '1-URGENT' THEN 3
                    WHEN o_orderpriority = '2-HIGH' THEN 2
                    WHEN o_orderpriority = '3-MEDIUM' THEN 1
                    ELSE 0 END AS scheduling_class
        FROM orders, (VALUES (0), (1), (2)) AS steps(k)""",
    "task_events": f"""
        SELECT base + CASE k WHEN 0 THEN 0 WHEN 1 THEN 30000000
                             ELSE 30000000 + q * 86400000000 END AS time,
               l_orderkey AS job_id,
               CAST(l_linenumber AS BIGINT) AS task_index,
               CASE WHEN k > 0 THEN l_suppkey END AS machine_id,
               CASE WHEN k < 2 THEN k
                    WHEN l_partkey % 10 IN (0, 1) AND l_suppkey % 4 <> 3 AND q % 12 <> 7 THEN 2
                    WHEN l_partkey % 10 = 2 THEN 3
                    WHEN l_partkey % 10 = 3 THEN 5
                    WHEN l_partkey % 10 = 4 THEN 6
                    ELSE 4 END AS event_type,
               CASE WHEN l_partkey % 29 <> 0 THEN CAST(l_suppkey % 4 AS INTEGER) END
                   AS scheduling_class,
               CAST(q % 12 AS INTEGER) AS priority,
               CASE WHEN l_partkey % 31 <> 0 THEN l_quantity / CAST(400.5 AS DOUBLE) END
                   AS cpu_request
        FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q,
                     ({_SECONDS.format("l_shipdate")} + l_partkey % 86400) * 1000000 AS base
              FROM lineitem), (VALUES (0), (1), (2)) AS steps(k)""",
    "task_usage": f"""
        SELECT base + 30000000 + k * 300000000 AS start_time,
               base + 330000000 + k * 300000000 AS end_time,
               l_orderkey AS job_id,
               CAST(l_linenumber AS BIGINT) AS task_index,
               l_suppkey AS machine_id,
               CASE WHEN l_partkey % 37 <> 0 THEN l_discount * (k + 1) / 20 END AS cpu_rate
        FROM (SELECT *, ({_SECONDS.format("l_shipdate")} + l_partkey % 86400) * 1000000 AS base
              FROM lineitem), (VALUES (0), (1)) AS steps(k)""",
}


def _sql(tables: str, body: str) -> str:
    parts = [f"{name} AS ({TABLES[name]})" for name in tables.split()]
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


# One row per REMOVE or ADD that has a capacity, with the one before it.
_PAIRS = """
    pairs AS (
        SELECT machine_id, time, event_type, cpus,
               lag(time) OVER w AS t0, lag(event_type) OVER w AS e0, lag(cpus) OVER w AS c0
        FROM machine_events
        WHERE cpus IS NOT NULL AND event_type IN (0, 1)
        WINDOW w AS (PARTITION BY machine_id ORDER BY time, event_type, cpus)),
    losses AS (
        SELECT machine_id,
               coalesce(sum(c0 * (time - t0)) FILTER (WHERE event_type = 0 AND e0 = 1), 0) AS lost
        FROM pairs GROUP BY machine_id)"""

_UPTIME = """
    bounds AS (SELECT max(time) AS t_end FROM machine_events WHERE cpus IS NOT NULL),
    ranked AS (
        SELECT machine_id, time, cpus,
               row_number() OVER (PARTITION BY machine_id ORDER BY time, cpus) AS rn
        FROM machine_events WHERE cpus IS NOT NULL AND event_type = 0),
    uptime AS (
        SELECT m.machine_id, coalesce(r.cpus * (t_end - r.time), 0) AS available
        FROM (SELECT DISTINCT machine_id FROM machine_events WHERE cpus IS NOT NULL) m
        CROSS JOIN bounds
        LEFT JOIN ranked r ON r.machine_id = m.machine_id AND r.rn = 1)"""

_CLASSES = """
    seen AS (
        SELECT machine_id, cpus,
               row_number() OVER (PARTITION BY machine_id
                   ORDER BY event_type = 1 DESC,
                            CASE WHEN event_type = 1 THEN -time ELSE time END,
                            CASE WHEN event_type = 1 THEN -cpus ELSE event_type END, cpus) AS rn
        FROM machine_events WHERE cpus IS NOT NULL),
    classes AS (SELECT machine_id, cpus FROM seen WHERE rn = 1)"""

# Demand and capacity as decimals, which add up exactly.
_CHANGES = """
    changes AS (
        SELECT machine_id, time,
               CAST(CASE WHEN event_type = 1 THEN cpu_request ELSE -cpu_request END
                    AS DECIMAL(28, 10)) AS delta
        FROM task_events
        WHERE machine_id IS NOT NULL AND cpu_request IS NOT NULL AND event_type BETWEEN 1 AND 6)"""


def _over(capacities: str, initial: str) -> str:
    return f"""{_CHANGES},
    capacities AS ({capacities}),
    initial AS ({initial}),
    shared AS (SELECT DISTINCT machine_id FROM capacities
               WHERE machine_id IN (SELECT machine_id FROM changes)),
    instants AS (
        SELECT machine_id, time, sum(delta) AS delta, max(cap) AS cap
        FROM (SELECT machine_id, time, delta, NULL AS cap FROM changes
              UNION ALL SELECT machine_id, time, 0, cap FROM capacities)
        WHERE machine_id IN (SELECT machine_id FROM shared)
        GROUP BY machine_id, time),
    states AS (
        SELECT machine_id, lead(time) OVER w - time AS dt,
               sum(delta) OVER (w ROWS UNBOUNDED PRECEDING) AS level,
               coalesce(last_value(instants.cap IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING),
                        initial.cap) AS cap
        FROM instants JOIN initial USING (machine_id)
        WINDOW w AS (PARTITION BY machine_id ORDER BY time)),
    fractions AS (
        SELECT machine_id,
               CASE WHEN coalesce(sum(dt), 0) = 0 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(coalesce(sum(dt) FILTER (WHERE level > cap), 0) AS DOUBLE)
                         / CAST(sum(dt) AS DOUBLE) END AS fraction
        FROM states GROUP BY machine_id)"""


_OVERCOMMIT = _over(
    """SELECT machine_id, time, CAST(cpus AS DECIMAL(28, 10)) AS cap
       FROM machine_events WHERE cpus IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY machine_id, time
                                  ORDER BY event_type DESC, cpus DESC) = 1""",
    """SELECT machine_id, CAST(cpus AS DECIMAL(28, 10)) AS cap
       FROM machine_events WHERE cpus IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY machine_id
                                  ORDER BY time, event_type, cpus) = 1""",
)

# Capacities set at the start of thirty days: the smallest one holds before, the largest from there on.
_MONTHLY = """
    SELECT machine_id, time - time % 2592000000000 AS time,
           CAST(min(cpus) AS DECIMAL(28, 10)) AS low, CAST(max(cpus) AS DECIMAL(28, 10)) AS cap
    FROM machine_events WHERE cpus IS NOT NULL GROUP BY ALL"""
_OVER_MONTHLY = _over(
    f"SELECT machine_id, time, cap FROM ({_MONTHLY})",
    f"SELECT machine_id, arg_min(low, time) AS cap FROM ({_MONTHLY}) GROUP BY machine_id",
)

_USED = """
    used AS (
        SELECT job_id, task_index, avg(cpu_rate) AS used
        FROM task_usage WHERE cpu_rate IS NOT NULL GROUP BY job_id, task_index)"""

_REQUESTED = """
    requested AS (
        SELECT job_id, task_index, max(cpu_request) AS requested
        FROM task_events WHERE cpu_request IS NOT NULL GROUP BY job_id, task_index)"""

_BIGGEST = """
    biggest AS (
        SELECT job_id, task_index, cpu_request, scheduling_class
        FROM task_events WHERE cpu_request IS NOT NULL AND scheduling_class IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY job_id, task_index
                                   ORDER BY cpu_request DESC, scheduling_class DESC) = 1)"""


def _rate(group: str, keep_zero: bool, where: str = "TRUE") -> str:
    join = "LEFT JOIN" if keep_zero else "JOIN"
    return f"""
    WITH entities AS (
        SELECT DISTINCT job_id, task_index, {group} FROM task_events WHERE {where}),
    evicted AS (
        SELECT DISTINCT job_id, task_index, {group} FROM task_events
        WHERE event_type = 2 AND {where}),
    totals AS (SELECT {group}, count(*) AS n_entities FROM entities GROUP BY {group}),
    hits AS (SELECT {group}, count(*) AS n_hit FROM evicted GROUP BY {group})
    SELECT totals.{group}, n_entities, coalesce(n_hit, 0) AS n_hit,
           round(coalesce(n_hit, 0) / CAST(n_entities AS DOUBLE) * 100, 8) AS pct
    FROM totals {join} hits ON hits.{group} = totals.{group}"""


def _rate_pct(group: str, where: str = "TRUE") -> str:
    return (
        _rate(group, False, where)
        .replace(f"SELECT totals.{group}, n_entities, coalesce(n_hit, 0) AS n_hit,",
                 f"SELECT totals.{group},")
    )


def _field_sums(table: str, by: str, *columns: str, extra: str = "") -> str:
    sums = ", ".join(
        f"count({c}) AS n_{c}, CAST(sum({c} % 1000003) AS BIGINT) AS sum_{c}" for c in columns
    )
    return f"SELECT {by}, count(*) AS n, {sums} FROM (SELECT *{extra} FROM {table}) GROUP BY {by}"


def _mandatory(*columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'missing {c}' AS issue, count(*) FILTER (WHERE {c} IS NULL) AS n_rows"
        " FROM task_events"
        for c in columns
    )


ORACLES: dict[str, str] = {
    # The thirteen analytics.
    "capacity_distribution": _sql("machine_events", """
        WITH latest AS (
            SELECT machine_id, cpus,
                   row_number() OVER (PARTITION BY machine_id
                                      ORDER BY time DESC, event_type DESC, cpus DESC) AS rn
            FROM machine_events WHERE cpus IS NOT NULL AND event_type <> 1)
        SELECT cpus, count(*) AS n_machines FROM latest WHERE rn = 1 GROUP BY cpus"""),
    "maintenance_loss_pct": _sql("machine_events", f"""
        WITH {_PAIRS.strip()}, {_UPTIME.strip()}
        SELECT round((SELECT sum(lost) FROM losses)
                     / (SELECT sum(available) FROM uptime) * 100, 8) AS pct_lost"""),
    "loss_share_by_capacity": _sql("machine_events", f"""
        WITH {_PAIRS.strip()}, {_CLASSES.strip()}
        SELECT cpus, round(sum(coalesce(lost, 0))
                           / (SELECT sum(lost) FROM losses) * 100, 8) AS pct
        FROM classes LEFT JOIN losses ON losses.machine_id = classes.machine_id
        GROUP BY cpus"""),
    "class_share_jobs_tasks": _sql("job_events task_events", """
        WITH jobs AS (
            SELECT scheduling_class, count(DISTINCT job_id) AS n
            FROM job_events WHERE scheduling_class IS NOT NULL GROUP BY scheduling_class),
        tasks AS (
            SELECT scheduling_class, count(DISTINCT (job_id, task_index)) AS n
            FROM task_events WHERE scheduling_class IS NOT NULL GROUP BY scheduling_class)
        SELECT scheduling_class,
               round(jobs.n / CAST((SELECT sum(n) FROM jobs) AS DOUBLE) * 100, 8) AS job_pct,
               round(tasks.n / CAST((SELECT sum(n) FROM tasks) AS DOUBLE) * 100, 8) AS task_pct
        FROM jobs FULL JOIN tasks USING (scheduling_class)"""),
    "evicted_or_killed": _sql("job_events task_events", """
        WITH counts AS (
            SELECT 'jobs' AS entity, count(DISTINCT job_id) AS n_total,
                   count(DISTINCT job_id) FILTER (WHERE event_type IN (2, 5)) AS n_hit
            FROM job_events
            UNION ALL
            SELECT 'tasks', count(DISTINCT (job_id, task_index)),
                   count(DISTINCT (job_id, task_index)) FILTER (WHERE event_type IN (2, 5))
            FROM task_events)
        SELECT entity, n_total, n_hit,
               round(n_hit / CAST(n_total AS DOUBLE) * 100, 8) AS pct FROM counts"""),
    "eviction_rate_by_class": _sql(
        "task_events", _rate_pct("scheduling_class", "scheduling_class IS NOT NULL")),
    "machines_per_job": _sql("task_events", """
        WITH spread AS (
            SELECT job_id, count(DISTINCT machine_id) AS n_machines FROM task_events
            WHERE event_type = 1 AND machine_id IS NOT NULL GROUP BY job_id)
        SELECT n_machines, count(*) AS n_jobs FROM spread GROUP BY n_machines"""),
    "request_vs_usage": _sql("task_events task_usage", f"""
        WITH {_REQUESTED.strip()}, {_USED.strip()}
        SELECT job_id, task_index, round(requested, 8) AS requested, round(used, 8) AS used
        FROM requested JOIN used USING (job_id, task_index)"""),
    "usage_vs_evictions": _sql("task_events task_usage", """
        SELECT machine_id, round(mean_cpu, 8) AS mean_cpu, evictions
        FROM (SELECT machine_id, avg(cpu_rate) AS mean_cpu FROM task_usage
              WHERE cpu_rate IS NOT NULL GROUP BY machine_id)
        JOIN (SELECT machine_id, count(*) AS evictions FROM task_events
              WHERE event_type = 2 AND machine_id IS NOT NULL GROUP BY machine_id)
        USING (machine_id)"""),
    "overcommit_fraction": _sql("machine_events task_events", f"""
        WITH {_OVERCOMMIT.strip()}
        SELECT round(avg(fraction), 8) AS avg_fraction FROM fractions"""),
    "overestimation_by_class": _sql("task_events task_usage", f"""
        WITH {_BIGGEST.strip()}, {_USED.strip()}
        SELECT scheduling_class, round(avg(cpu_request / used), 8) AS avg_ratio
        FROM biggest JOIN used USING (job_id, task_index)
        WHERE used > 0 AND cpu_request / used < 50 GROUP BY scheduling_class"""),
    "overestimation_by_eviction": _sql("task_events task_usage", f"""
        WITH {_REQUESTED.strip()}, {_USED.strip()},
        evicted_tasks AS (
            SELECT DISTINCT job_id, task_index FROM task_events
            WHERE event_type = 2 AND cpu_request IS NOT NULL),
        ratios AS (
            SELECT CASE WHEN e.job_id IS NULL THEN 0 ELSE 1 END AS evicted,
                   requested / used AS ratio
            FROM requested r JOIN used u USING (job_id, task_index)
            LEFT JOIN evicted_tasks e
              ON e.job_id = r.job_id AND e.task_index = r.task_index
            WHERE used > 0)
        SELECT evicted, round(avg(ratio), 8) AS avg_ratio
        FROM ratios WHERE ratio < 50 GROUP BY evicted"""),
    "eviction_rate_by_priority": _sql("task_events", _rate_pct("priority")),
    # The operators on their own.
    "overcommit_by_machine": _sql("machine_events task_events", f"""
        WITH {_OVERCOMMIT.strip()}
        SELECT machine_id, round(fraction, 8) AS fraction FROM fractions"""),
    "over_limit_fraction": _sql("machine_events task_events", f"""
        WITH {_OVER_MONTHLY.strip()}
        SELECT machine_id, round(fraction, 8) AS fraction FROM fractions"""),
    "cpu_delta": _sql("task_events", f"""
        WITH {_CHANGES.strip()}
        SELECT machine_id, count(*) AS n_changes,
               CAST(sum(delta) * 10000000000 AS BIGINT) AS net_e10
        FROM changes GROUP BY machine_id"""),
    "running_level": _sql("task_events", f"""
        WITH {_CHANGES.strip()},
        instants AS (SELECT machine_id, time, sum(delta) AS delta
                     FROM changes GROUP BY machine_id, time)
        SELECT machine_id, time,
               CAST(10000000000 * sum(delta) OVER (PARTITION BY machine_id ORDER BY time
                                                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS level_e10
        FROM instants"""),
    "carry_forward": _sql("machine_events", """
        WITH filled AS (
            SELECT machine_id, time,
                   coalesce(last_value(cpus IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING),
                            first_value(cpus IGNORE NULLS) OVER
                                (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
                       AS cpus,
                   row_number() OVER (PARTITION BY machine_id, time
                                      ORDER BY event_type DESC, cpus DESC) AS rn
            FROM machine_events
            WINDOW w AS (PARTITION BY machine_id ORDER BY time, event_type, cpus))
        SELECT machine_id, time, cpus FROM filled WHERE rn = 1"""),
    "gap_loss": _sql("machine_events", f"""
        WITH {_PAIRS.strip()}
        SELECT machine_id, CAST(lost AS DOUBLE) AS lost FROM losses"""),
    "uptime_capacity": _sql("machine_events", f"""
        WITH {_UPTIME.strip()}
        SELECT machine_id, CAST(available AS DOUBLE) AS available FROM uptime"""),
    "down_class": _sql("machine_events", f"""
        WITH {_CLASSES.strip()}
        SELECT machine_id, cpus FROM classes"""),
    "trace_end": _sql("machine_events", """
        SELECT max(time) AS trace_end FROM machine_events WHERE cpus IS NOT NULL"""),
    "latest_by_key": _sql("machine_events", """
        SELECT machine_id, time, event_type, cpus FROM machine_events WHERE cpus IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY machine_id
                                   ORDER BY time DESC, event_type DESC, cpus DESC) = 1"""),
    "first_by_key": _sql("machine_events", """
        SELECT machine_id, time, event_type, cpus FROM machine_events WHERE cpus IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY machine_id
                                   ORDER BY time, event_type, cpus) = 1"""),
    "max_with": _sql("task_events", f"""
        WITH {_BIGGEST.strip()}
        SELECT job_id, task_index, round(cpu_request, 8) AS cpu_request, scheduling_class
        FROM biggest"""),
    "max_request": _sql("task_events", f"""
        WITH {_REQUESTED.strip()}
        SELECT job_id, task_index, round(requested, 8) AS requested FROM requested"""),
    "mean_by": _sql("task_usage", f"""
        WITH {_USED.strip()}
        SELECT job_id, task_index, round(used, 8) AS used FROM used"""),
    "any_event": _sql("task_events", """
        SELECT job_id, task_index, max(CASE WHEN event_type = 2 THEN 1 ELSE 0 END) AS evicted
        FROM task_events GROUP BY job_id, task_index"""),
    "count_by": _sql("task_events", """
        SELECT machine_id, count(*) AS n FROM task_events GROUP BY machine_id"""),
    "share_by": _sql("task_events", """
        WITH counts AS (SELECT event_type, count(*) AS n FROM task_events GROUP BY event_type)
        SELECT event_type, n,
               round(n / CAST((SELECT count(*) FROM task_events) AS DOUBLE) * 100, 8) AS pct
        FROM counts"""),
    "event_rate": _sql("task_events", _rate("priority", False)),
    "event_rate_keep_zero": _sql("task_events", _rate("priority", True)),
    "eviction_rate_by_class_keep_zero": _sql(
        "task_events",
        _rate_pct("scheduling_class", "scheduling_class IS NOT NULL")
        .replace("totals JOIN hits", "totals LEFT JOIN hits")),
    "fanout_histogram": _sql("task_events", """
        WITH spread AS (
            SELECT machine_id, count(DISTINCT job_id) AS n_jobs FROM task_events
            WHERE machine_id IS NOT NULL GROUP BY machine_id)
        SELECT n_jobs, count(*) AS n_machines FROM spread GROUP BY n_jobs"""),
    "request_ratio": _sql("task_events task_usage", f"""
        WITH {_REQUESTED.strip()}, {_USED.strip()}
        SELECT job_id, task_index, round(requested / used, 8) AS ratio
        FROM requested JOIN used USING (job_id, task_index)
        WHERE used > 0 AND requested / used < 50"""),
    "density_grid": _sql("task_events task_usage", f"""
        WITH {_REQUESTED.strip()}, {_USED.strip()}
        SELECT CAST(floor(requested / CAST(0.01 AS DOUBLE)) AS BIGINT) AS xb,
               CAST(floor(used / CAST(0.0007071067811865476 AS DOUBLE)) AS BIGINT) AS yb,
               count(*) AS n
        FROM requested JOIN used USING (job_id, task_index) GROUP BY xb, yb"""),
    "machine_density_grid": _sql("task_events task_usage", """
        SELECT CAST(floor(mean_cpu / CAST(0.0005 AS DOUBLE)) AS BIGINT) AS xb,
               CAST(floor(evictions / CAST(10 AS DOUBLE)) AS BIGINT) AS yb, count(*) AS n
        FROM (SELECT machine_id, avg(cpu_rate) AS mean_cpu FROM task_usage
              WHERE cpu_rate IS NOT NULL GROUP BY machine_id)
        JOIN (SELECT machine_id, count(*) AS evictions FROM task_events
              WHERE event_type = 2 AND machine_id IS NOT NULL GROUP BY machine_id)
        USING (machine_id) GROUP BY xb, yb"""),
    "log_count": _sql("task_events", """
        WITH spread AS (
            SELECT job_id, count(DISTINCT machine_id) AS n_machines FROM task_events
            WHERE event_type = 1 AND machine_id IS NOT NULL GROUP BY job_id)
        SELECT n_machines, count(*) AS n_jobs, round(log10(count(*)), 8) AS log10_n
        FROM spread GROUP BY n_machines"""),
    "label": _sql("task_events task_usage", f"""
        WITH {_REQUESTED.strip()}, {_USED.strip()},
        evicted_tasks AS (
            SELECT DISTINCT job_id, task_index FROM task_events
            WHERE event_type = 2 AND cpu_request IS NOT NULL),
        ratios AS (
            SELECT CASE WHEN e.job_id IS NULL THEN 0 ELSE 1 END AS evicted,
                   requested / used AS ratio
            FROM requested r JOIN used u USING (job_id, task_index)
            LEFT JOIN evicted_tasks e
              ON e.job_id = r.job_id AND e.task_index = r.task_index
            WHERE used > 0)
        SELECT CASE evicted WHEN 1 THEN 'Evicted tasks' ELSE 'Non-evicted tasks' END AS tasks,
               round(avg(ratio), 8) AS avg_ratio
        FROM ratios WHERE ratio < 50 GROUP BY evicted"""),
    "percent_text": _sql("job_events task_events", """
        WITH counts AS (
            SELECT 'jobs' AS entity, count(DISTINCT job_id) AS n_total,
                   count(DISTINCT job_id) FILTER (WHERE event_type IN (2, 5)) AS n_hit
            FROM job_events
            UNION ALL
            SELECT 'tasks', count(DISTINCT (job_id, task_index)),
                   count(DISTINCT (job_id, task_index)) FILTER (WHERE event_type IN (2, 5))
            FROM task_events)
        SELECT entity, n_hit,
               printf('%.2f%%', n_hit / CAST(n_total AS DOUBLE) * 100) AS share FROM counts"""),
    "count_issues": _sql(
        "task_events",
        _mandatory("time", "job_id", "task_index", "event_type", "priority")
        + " UNION ALL SELECT 'missing machine_id',"
          " count(*) FILTER (WHERE machine_id IS NULL) FROM task_events"),
    "parse_lines": _sql("machine_events", """
        SELECT event_type, count(*) AS n, count(cpus) AS n_cpus, sum(time % 1000003) AS time_sum,
               sum(machine_id) AS machine_sum, sum(cpus) AS cpus_sum
        FROM machine_events GROUP BY event_type""").replace(
            "sum(time % 1000003) AS time_sum", "CAST(sum(time % 1000003) AS BIGINT) AS time_sum"
        ).replace("sum(machine_id) AS machine_sum", "CAST(sum(machine_id) AS BIGINT) AS machine_sum"),
    "parse_job_lines": _sql(
        "job_events", _field_sums("job_events", "event_type", "time", "job_id", "scheduling_class")),
    "parse_task_lines": _sql("task_events", _field_sums(
        "task_events", "event_type", "time", "job_id", "task_index", "machine_id",
        "scheduling_class", "priority", "flag",
        extra=", CASE WHEN job_id % 3 < 2 THEN job_id % 3 END AS flag")),
    "parse_usage_lines": _sql("task_usage", _field_sums(
        "task_usage", "task_index", "start_time", "end_time", "job_id", "machine_id", "flag",
        extra=", CASE WHEN task_index % 3 < 2 THEN task_index % 3 END AS flag")),
    "count_line_issues": _sql("task_events", """
        SELECT 'malformed' AS issue, count(*) FILTER (WHERE job_id % 7 < 4) AS n_rows FROM task_events
        UNION ALL
        SELECT 'missing ' || name, CASE name WHEN 'time' THEN n ELSE 0 END
        FROM (SELECT count(*) FILTER (WHERE job_id % 7 = 5) AS n FROM task_events),
             (VALUES ('time'), ('job_id'), ('task_index'), ('event_type'), ('priority')) AS t(name)"""),
}

# What files give when they are read is what their lines give.
ORACLES |= {
    "read_machine_events": ORACLES["parse_lines"],
    "read_job_events": ORACLES["parse_job_lines"],
    "read_task_events": ORACLES["parse_task_lines"],
    "read_task_usage": ORACLES["parse_usage_lines"],
    "read_gzip_usage": ORACLES["parse_usage_lines"],
    "validate_trace": ORACLES["count_line_issues"],
    "read_task_parts": _sql("task_events", """
        SELECT event_type, CASE WHEN job_id % 5 < 3 THEN 'glob' ELSE 'list' END AS way, count(*) AS n,
               count(time) AS n_time, count(job_id) AS n_job_id, count(machine_id) AS n_machine_id,
               count(priority) AS n_priority, CAST(sum(time % 1000003) AS BIGINT) AS sum_time,
               CAST(sum(job_id % 1000003) AS BIGINT) AS sum_job_id,
               CAST(sum(machine_id % 1000003) AS BIGINT) AS sum_machine_id,
               CAST(sum(priority % 1000003) AS BIGINT) AS sum_priority
        FROM task_events GROUP BY ALL"""),
    "gap_loss_by_class": _sql("machine_events", f"""
        WITH {_PAIRS.strip()}, {_CLASSES.strip()}
        SELECT machine_id, cpus, CAST(coalesce(lost, 0) AS DOUBLE) AS lost FROM classes LEFT JOIN losses USING (machine_id)"""),
}
