"""SQL for each registered query, written independently of the Spark plans.

Phases use three EXISTS tests, backlogs the full product of cases and cut
dates, medians the engine's own median.
"""

from __future__ import annotations

TICKETS = """
tickets AS (
  SELECT o_orderkey AS oid,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'DEV' WHEN '2-HIGH' THEN 'DEV-VIP' WHEN '3-MEDIUM' THEN 'SDEV'
              WHEN '4-NOT SPECIFIED' THEN 'RFC' WHEN '5-LOW' THEN 'INC' END AS ticket_type,
         c_mktsegment AS appgroup,
         o_orderdate AS created,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(o_orderkey % 97 AS INT)) END AS closed
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""

CLASSED = """
classed AS (
  SELECT *, CASE WHEN ticket_type = 'DEV' THEN 'Development'
                 WHEN ticket_type IN ('DEV-VIP', 'SDEV') THEN 'Development Small' ELSE ticket_type END AS ticket
  FROM tickets)"""

WORKTIMESHEET = """
worktimesheet AS (
  SELECT l_orderkey AS issue,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey % 4 END AS owner,
         4 + l_partkey % 2 AS actiontypegroup,
         TIMESTAMP '1995-01-01' + to_days(CAST(l_orderkey % 2400 + l_linenumber % 2 AS INT))
           + to_hours(CAST(l_linenumber AS INT)) AS startdate,
         l_quantity AS hours,
         CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'TravelTime' ELSE 'WorkTime' END AS timetype
  FROM lineitem)"""

LOOKUPS = """
users AS (
  SELECT s_suppkey AS oid, 'User#' || CAST(s_suppkey % 2 AS VARCHAR) AS name,
         CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE s_suppkey % 2 END AS defaultorganization
  FROM supplier),
organizations AS (SELECT n_nationkey AS oid, n_name AS name FROM nation),
action_groups AS (SELECT r_regionkey AS oid, r_name AS name FROM region)"""

MILESTONES = """
milestones AS (
  SELECT o_orderkey AS oid,
         CASE WHEN o_orderkey % 4 <> 0
              THEN o_orderdate + to_days(CAST(o_orderkey % 50 AS INT)) + to_hours(9) END AS demand_start,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_days(CAST(200 + o_orderkey % 30 AS INT)) END AS release_start
  FROM orders WHERE o_orderkey % 13 <> 0
  UNION ALL
  SELECT o_orderkey, o_orderdate + to_days(30), NULL
  FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 11 = 0)"""

ENRICHED = """
people AS (
  SELECT users.oid AS person, users.name AS user_worktimesheet, place.name AS userorg_worktimesheet
  FROM users LEFT JOIN organizations AS place ON place.oid = users.defaultorganization),
kinds AS (SELECT oid AS kind, name AS kind_name FROM action_groups),
enriched AS (
  SELECT issue, user_worktimesheet, userorg_worktimesheet, kind_name AS actiontypegroup, startdate, hours
  FROM (SELECT * FROM worktimesheet WHERE timetype = 'WorkTime') AS booked
  LEFT JOIN kinds ON kind = booked.actiontypegroup
  LEFT JOIN people ON person = booked.owner)"""

DAILY = """
daily AS (
  SELECT issue, user_worktimesheet, userorg_worktimesheet, actiontypegroup,
         CAST(startdate AS DATE) AS targetday, sum(hours) AS hours_worktimesheet
  FROM enriched GROUP BY ALL)"""

BY_TICKET = """
by_ticket AS (
  SELECT t.*, d.* FROM tickets t JOIN daily d ON t.oid = d.issue)"""

LABELLED = """
starts AS (
  SELECT oid AS case_oid, min(release_start) AS released, min(demand_start) AS demanded FROM milestones GROUP BY oid),
labelled AS (
  SELECT by_ticket.*,
         CASE WHEN targetday >= released THEN 'Release' WHEN targetday >= demanded THEN 'Demand'
              WHEN targetday < demanded THEN 'Pre-demand' END AS phase
  FROM by_ticket LEFT JOIN starts ON case_oid = by_ticket.oid)"""

MONTH_CUTS = """
cuts AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS DATE)
         AS cutpoint)"""

DAY_CUTS = """
cuts AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 DAY)) AS DATE)
         AS cutpoint)"""

CONFORMANCE = """
detail AS (
  SELECT ticket, oid, strftime(created, '%Y-%m') AS created_month,
         EXISTS (SELECT 1 FROM milestones m WHERE m.oid = t.oid AND m.demand_start IS NOT NULL) AS has_demand,
         EXISTS (SELECT 1 FROM milestones m WHERE m.oid = t.oid AND m.release_start IS NOT NULL) AS has_release,
         coalesce((SELECT min(m.demand_start) <= min(m.release_start) FROM milestones m WHERE m.oid = t.oid), false)
           AS demand_before_release
  FROM classed t WHERE closed IS NOT NULL AND ticket_type IN ('DEV', 'DEV-VIP', 'SDEV')),
conformance AS (
  SELECT *, has_demand AND has_release AND demand_before_release AS conform FROM detail),
conformance_counts AS (
  SELECT created_month, ticket, conform, count(*) AS n FROM conformance GROUP BY ALL)"""

LONGEST = """
longest AS (
  SELECT ticket, row_number() OVER (PARTITION BY ticket ORDER BY date_diff('day', created, DATE '2002-01-01') DESC, oid)
           AS rank, oid, created, CAST(date_diff('day', created, DATE '2002-01-01') AS INT) AS age_days
  FROM classed WHERE closed IS NULL)"""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then.strip()


_NAMED = (WORKTIMESHEET, LOOKUPS, ENRICHED)
_BY_TICKET = (TICKETS, *_NAMED, DAILY, BY_TICKET)
_LABELLED = (*_BY_TICKET, MILESTONES, LABELLED)
_CONFORMANCE = (TICKETS, CLASSED, MILESTONES, CONFORMANCE)


def _by_ticket(columns: str) -> str:
    return _with(*_BY_TICKET, then=f"SELECT {columns} FROM by_ticket")


_FULL = (
    "oid, ticket_type, appgroup, created, closed, issue, user_worktimesheet, userorg_worktimesheet, "
    "actiontypegroup, targetday, hours_worktimesheet"
)
_NO_TEAM = _FULL.replace("appgroup, ", "")


def _moments(step: str) -> str:
    return f"""
cuts AS (
  SELECT unnest(generate_series(TIMESTAMP '1997-03-01 00:00:00', TIMESTAMP '1997-03-31 23:00:00', INTERVAL {step}))
         AS cutpoint)"""


def _backlog(cuts: str, *groups: str, source: str = "tickets", count: str = "COUNT") -> str:
    parts = (TICKETS, CLASSED, cuts) if source == "classed" else (TICKETS, cuts)
    selected = "".join(f", {g} AS {a}" for g, a in (x.split(":") for x in groups))
    return _with(
        *parts,
        then=f"""
SELECT cutpoint AS "CUTPOINT"{selected},
       CAST(sum(CASE WHEN cutpoint >= created AND (closed IS NULL OR cutpoint <= closed) THEN 1 ELSE 0 END) AS BIGINT)
         AS "{count}"
FROM {source} CROSS JOIN cuts GROUP BY ALL""",
    )


def _flow(date: str, label: str, value: str, where: str, team: bool) -> str:
    return _with(
        TICKETS,
        CLASSED,
        then=f"""
SELECT strftime({date}, '%Y-%m') AS "{label}", ticket AS "TICKET"{', appgroup AS "APPGROUP"' if team else ''}, {value}
FROM classed WHERE {where} GROUP BY ALL""",
    )


def _new(team: bool) -> str:
    return _flow("created", "CREATED_MONTH", 'count(*) AS "NEW_TICKET"', "true", team)


def _throughput(team: bool) -> str:
    return _flow("closed", "CLOSED_MONTH", 'count(*) AS "THROUGHPUT"', "closed IS NOT NULL", team)


def _throughput_time(team: bool) -> str:
    median = "median(date_diff('day', created, closed)) AS \"THROUGHPUT_TIME\""
    return _flow("closed", "CLOSED_MONTH", median, "closed IS NOT NULL", team)


def _fte(breakdown: str, alias: str, where: str, team: bool, norm: bool) -> str:
    organisation = ', userorg_worktimesheet AS "USERORG_WORKTIMESHEET"' if team else ""
    booked = "count(DISTINCT CASE WHEN hours_worktimesheet IS NOT NULL THEN oid END)"
    per_ticket = f', sum(hours_worktimesheet) / 160.0::DOUBLE / nullif({booked}, 0) AS "FTE_NORM"' if norm else ""
    return _with(
        *_LABELLED,
        """
timed AS (
  SELECT *, CASE WHEN ticket_type = 'DEV' THEN 'Development'
                 WHEN ticket_type IN ('DEV-VIP', 'SDEV') THEN 'Development Small' ELSE ticket_type END AS ticket
  FROM labelled)""",
        then=f"""
SELECT strftime(targetday, '%Y-%m') AS "MONTH_WORKTIMESHEET", {breakdown} AS "{alias}"{organisation},
       sum(hours_worktimesheet) / 160.0::DOUBLE AS "FTE"{per_ticket}
FROM timed WHERE {where} GROUP BY ALL""",
    )


def _fte_class(team: bool, norm: bool) -> str:
    return _fte("ticket", "TICKET", "true", team, norm)


def _fte_phase(team: bool, norm: bool) -> str:
    return _fte("coalesce(phase, ticket_type)", "FTE_BREAKDOWN", "ticket_type IN ('DEV', 'SDEV', 'RFC')", team, norm)


def _effort_level(level: str, ticket: str, breakdown: str, organisation: str, where: str) -> str:
    return f"""
SELECT '{level}' AS "LEVEL", strftime(targetday, '%Y-%m') AS "MONTH_WORKTIMESHEET", {ticket} AS "TICKET",
       {breakdown} AS "FTE_BREAKDOWN", {organisation} AS "USERORG_WORKTIMESHEET",
       sum(hours_worktimesheet) / 160.0::DOUBLE AS "FTE",
       sum(hours_worktimesheet) / 160.0::DOUBLE / nullif(count(DISTINCT CASE WHEN hours_worktimesheet IS NOT NULL THEN oid END), 0)
         AS "FTE_NORM"
FROM timed WHERE {where} GROUP BY ALL"""


def _effort_rollup() -> str:
    none, phase, team = "CAST(NULL AS VARCHAR)", "coalesce(phase, ticket_type)", "userorg_worktimesheet"
    development = "ticket_type IN ('DEV', 'SDEV', 'RFC')"
    return _with(
        *_LABELLED,
        """
timed AS (
  SELECT *, CASE WHEN ticket_type = 'DEV' THEN 'Development'
                 WHEN ticket_type IN ('DEV-VIP', 'SDEV') THEN 'Development Small' ELSE ticket_type END AS ticket
  FROM labelled)""",
        then="\nUNION ALL".join(
            (
                _effort_level("class", "ticket", none, none, "true"),
                _effort_level("class_team", "ticket", none, team, "true"),
                _effort_level("phase", none, phase, none, development),
                _effort_level("phase_team", none, phase, team, development),
            )
        ),
    )


_CONFORMANCE_DETAIL = _with(
    *_CONFORMANCE,
    then="""
SELECT ticket AS "TICKET", oid AS "OID", created_month AS "CREATED_MONTH", has_demand AS "HAS_DEMAND",
       has_release AS "HAS_RELEASE", demand_before_release AS "DEMAND_BEFORE_RELEASE", conform AS "CONFORM"
FROM conformance""",
)
_PHASE_LABEL = _with(*_LABELLED, then=f"SELECT {_FULL}, phase FROM labelled")
_PHASE_RELEASE = _with(
    *_BY_TICKET,
    MILESTONES,
    then=f"""
SELECT {_FULL} FROM by_ticket w
WHERE EXISTS (SELECT 1 FROM milestones m WHERE m.oid = w.oid AND m.release_start IS NOT NULL
              AND w.targetday >= m.release_start)""",
)

ORACLE: dict[str, str] = {
    "src_tickets": _with(TICKETS, then="SELECT * FROM tickets"),
    "src_worktime": _with(WORKTIMESHEET, then="SELECT * FROM worktimesheet"),
    "src_users": _with(LOOKUPS, then="SELECT oid, name, CAST(defaultorganization AS BIGINT) AS defaultorganization FROM users"),
    "src_organizations": _with(LOOKUPS, then="SELECT CAST(oid AS BIGINT) AS oid, name FROM organizations"),
    "src_action_groups": _with(LOOKUPS, then="SELECT CAST(oid AS BIGINT) AS oid, name FROM action_groups"),
    "src_milestones": _with(MILESTONES, then="SELECT * FROM milestones"),
    "src_csv_reordered": _with(TICKETS, then="SELECT * FROM tickets"),
    "sink_catalog_refresh": _with(TICKETS, then="SELECT * FROM tickets WHERE closed IS NULL"),
    "src_csv_roundtrip": _with(TICKETS, then="SELECT * FROM tickets"),
    "src_csv_set_aside": _with(
        TICKETS,
        then="""
SELECT oid % 1000 = 7 AS "ASIDE", oid % 100 AS "OID_CLASS", count(*) AS "COUNT", CAST(sum(oid) AS BIGINT) AS "OIDS"
FROM tickets GROUP BY ALL""",
    ),
    "sink_full_refresh": _PHASE_LABEL,
    "sink_versions": _with(TICKETS, then="SELECT * FROM tickets WHERE closed IS NULL"),
    "publish_conformance_csv": _CONFORMANCE_DETAIL,
    "filter_worktime": _with(WORKTIMESHEET, then="SELECT * FROM worktimesheet WHERE timetype = 'WorkTime'"),
    "interval_flag": _with(
        TICKETS,
        MILESTONES,
        then="""
SELECT oid, created, closed, first_release,
       CAST(CASE WHEN first_release >= created AND (closed IS NULL OR first_release <= closed) THEN 1 ELSE 0 END
            AS BIGINT) AS flag
FROM (SELECT t.*, (SELECT min(m.release_start) FROM milestones m WHERE m.oid = t.oid) AS first_release FROM tickets t)""",
    ),
    "tickets_open": _with(TICKETS, then="SELECT * FROM tickets WHERE closed IS NULL"),
    "tickets_closed": _with(TICKETS, then="SELECT * FROM tickets WHERE closed IS NOT NULL"),
    "tickets_of_types": _with(TICKETS, then="SELECT * FROM tickets WHERE ticket_type IN ('DEV', 'SDEV', 'RFC')"),
    "ticket_class": _with(TICKETS, CLASSED, then='SELECT oid, ticket_type, ticket AS "TICKET" FROM classed'),
    "ticket_lead_time": _with(
        TICKETS,
        then="""
SELECT oid, created, closed, CAST(date_diff('day', created, closed) AS INT) AS lead_days
FROM tickets WHERE closed IS NOT NULL""",
    ),
    "cutpoints_monthly": _with(
        TICKETS,
        then="""
SELECT CAST(unnest(generate_series(date_trunc('month', min(created)),
                                   date_trunc('month', greatest(max(created), max(closed))), INTERVAL 1 MONTH)) AS DATE)
       AS "CUTPOINT"
FROM tickets""",
    ),
    "worktime_enriched": _with(*_NAMED, then="SELECT * FROM enriched"),
    "worktime_day_trunc": _with(
        WORKTIMESHEET, then="SELECT issue, startdate, CAST(startdate AS DATE) AS targetday FROM worktimesheet"
    ),
    "worktime_daily": _with(*_NAMED, DAILY, then="SELECT * FROM daily"),
    "worktime_by_ticket": _by_ticket(_FULL),
    "worktime_sorted": _by_ticket(_FULL) + " ORDER BY oid NULLS LAST, targetday NULLS LAST",
    "phase_label": _PHASE_LABEL,
    "phase_label_clustered": _PHASE_LABEL,
    "phase_release_clustered": _PHASE_RELEASE,
    "phase_label_stored": _with(*_LABELLED, then=f"SELECT {_FULL}, phase FROM labelled"),
    "phase_relabel_changed": _PHASE_LABEL,
    "phase_unlabelled": _PHASE_LABEL + " WHERE phase IS NULL",
    "phase_release_semi": _PHASE_RELEASE,
    "backlog_total": _backlog(MONTH_CUTS),
    "backlog_by_type": _backlog(MONTH_CUTS, "ticket_type:ticket_type"),
    "backlog_by_type_team": _backlog(MONTH_CUTS, "ticket_type:ticket_type", "appgroup:appgroup"),
    "backlog_daily": _backlog(DAY_CUTS, "ticket_type:ticket_type"),
    "backlog_hourly": _backlog(_moments("1 HOUR"), "ticket_type:ticket_type"),
    "backlog_minutely": _backlog(_moments("1 MINUTE"), "ticket_type:ticket_type"),
    "backlog_at_bookings": _with(
        TICKETS,
        WORKTIMESHEET,
        "cuts AS (SELECT DISTINCT startdate AS cutpoint FROM worktimesheet)",
        """
steps AS (
  SELECT ticket_type, created AS moment, 1 AS step FROM tickets WHERE closed IS NULL OR closed >= created
  UNION ALL SELECT ticket_type, closed + INTERVAL 1 MICROSECOND, -1 FROM tickets WHERE closed >= created),
grid AS (SELECT t.ticket_type, c.cutpoint FROM (SELECT DISTINCT ticket_type FROM tickets) t CROSS JOIN cuts c),
line AS (
  SELECT ticket_type, moment, step, false AS asked FROM steps
  UNION ALL SELECT ticket_type, cutpoint, 0, true FROM grid),
running AS (
  SELECT *, sum(step) OVER (PARTITION BY ticket_type ORDER BY moment RANGE UNBOUNDED PRECEDING) AS n FROM line)""",
        then="""
SELECT moment AS "CUTPOINT", ticket_type, CAST(n AS BIGINT) AS "COUNT" FROM running WHERE asked""",
    ),
    "open_cases_at": _with(
        TICKETS,
        MONTH_CUTS,
        then="""
SELECT cutpoint AS "CUTPOINT", oid, ticket_type FROM tickets JOIN cuts
  ON cutpoint >= created AND (closed IS NULL OR cutpoint <= closed)""",
    ),
    "open_cases_matched": _with(
        TICKETS,
        "cuts AS (SELECT DISTINCT ticket_type AS kind, closed AS cutpoint FROM tickets)",
        then="""
SELECT cutpoint AS "CUTPOINT", ticket_type, count(*) AS "COUNT", CAST(sum(oid) AS BIGINT) AS "OIDS" FROM tickets JOIN cuts
  ON kind = ticket_type AND cutpoint >= created AND (closed IS NULL OR cutpoint <= closed) GROUP BY ALL""",
    ),
    "backlog_matched_cutpoints": _with(
        TICKETS,
        """
cuts AS (
  SELECT f.ticket_type, CAST(f.cut AS DATE) AS cutpoint
  FROM (SELECT ticket_type, unnest(generate_series(date_trunc('month', min(created)), TIMESTAMP '2001-12-01',
                                                   INTERVAL 1 MONTH)) AS cut
        FROM tickets GROUP BY ticket_type) f)""",
        then="""
SELECT c.cutpoint AS "CUTPOINT", t.ticket_type, t.appgroup,
       CAST(sum(CASE WHEN c.cutpoint >= created AND (closed IS NULL OR c.cutpoint <= closed) THEN 1 ELSE 0 END)
            AS BIGINT) AS "COUNT"
FROM tickets t JOIN cuts c ON t.ticket_type = c.ticket_type GROUP BY ALL""",
    ),
    "backlog_observed": _backlog(MONTH_CUTS, "ticket_type:ticket_type"),
    "backlog_progress": _with(
        TICKETS,
        MONTH_CUTS,
        """
changes AS (
  SELECT ticket_type, CASE WHEN closed IS NULL OR closed >= created
                           THEN (SELECT min(cutpoint) FROM cuts WHERE cutpoint >= created) END AS place FROM tickets
  UNION SELECT ticket_type, (SELECT min(cutpoint) FROM cuts WHERE cutpoint > closed) AS place FROM tickets
  WHERE closed >= created AND closed < (SELECT max(cutpoint) FROM cuts))""",
        then="""
SELECT 'cases' AS step, count(*) AS rows FROM tickets
UNION ALL SELECT 'changes', count(*) FROM changes
UNION ALL SELECT 'backlog', count(DISTINCT ticket_type) * (SELECT count(*) FROM cuts) FROM tickets""",
    ),
    "backlog_month_start": _backlog(MONTH_CUTS, 'ticket:"TICKET"', source="classed", count="BACKLOG"),
    "backlog_team": _backlog(
        MONTH_CUTS, 'ticket:"TICKET"', 'appgroup:"APPGROUP"', source="classed", count="BACKLOG"
    ),
    "new_tickets": _new(False),
    "new_tickets_team": _new(True),
    "throughput": _throughput(False),
    "throughput_team": _throughput(True),
    "throughput_time": _throughput_time(False),
    "throughput_time_team": _throughput_time(True),
    "throughput_rollup": _with(
        TICKETS,
        CLASSED,
        then="""
SELECT strftime(closed, '%Y-%m') AS "CLOSED_MONTH", ticket AS "TICKET", appgroup AS "APPGROUP", count(*) AS "THROUGHPUT",
       median(date_diff('day', created, closed)) AS "THROUGHPUT_TIME", 'team' AS "LEVEL"
FROM classed WHERE closed IS NOT NULL GROUP BY ALL
UNION ALL
SELECT strftime(closed, '%Y-%m'), ticket, NULL, count(*), median(date_diff('day', created, closed)), 'class'
FROM classed WHERE closed IS NOT NULL GROUP BY ALL""",
    ),
    "fte_by_type": _fte_class(False, False),
    "fte_norm_by_type": _fte_class(False, True),
    "fte_team": _fte_class(True, False),
    "fte_norm_team": _fte_class(True, True),
    "fte_by_phase": _fte_phase(False, False),
    "fte_norm_by_phase": _fte_phase(False, True),
    "fte_phase_team": _fte_phase(True, False),
    "fte_norm_phase_team": _fte_phase(True, True),
    "fte_rollup": _effort_rollup(),
    "conformance_detail": _CONFORMANCE_DETAIL,
    "conformance_count": _with(
        *_CONFORMANCE,
        then="""
SELECT created_month AS "CREATED_MONTH", ticket AS "TICKET", conform AS "CONFORM", n AS "COUNT"
FROM conformance_counts""",
    ),
    "conformance_cumulative": _with(
        *_CONFORMANCE,
        """
months AS (
  SELECT strftime(unnest(generate_series(min(strptime(created_month, '%Y-%m')), max(strptime(created_month, '%Y-%m')),
                                         INTERVAL 1 MONTH)), '%Y-%m') AS created_month
  FROM conformance_counts),
flags AS (SELECT DISTINCT ticket, conform FROM conformance_counts)""",
        then="""
SELECT created_month AS "CREATED_MONTH", ticket AS "TICKET", conform AS "CONFORM", CAST(coalesce(n, 0) AS BIGINT) AS "COUNT",
       CAST(sum(coalesce(n, 0)) OVER (PARTITION BY ticket, conform ORDER BY created_month) AS BIGINT)
         AS "CUMULATIVE_COUNT"
FROM flags CROSS JOIN months LEFT JOIN conformance_counts USING (created_month, ticket, conform)""",
    ),
    "leaderboard_longest_open": _with(
        TICKETS,
        CLASSED,
        LONGEST,
        then="""
SELECT ticket AS "TICKET", CAST(rank AS INT) AS "RANK", oid AS "OID", created AS "CREATED", age_days AS "AGE_DAYS"
FROM longest WHERE rank <= 10""",
    ),
    "leaderboard_highest_fte": _with(
        *_BY_TICKET,
        CLASSED,
        """
booked AS (SELECT oid, sum(hours_worktimesheet) / 160.0::DOUBLE AS fte FROM by_ticket GROUP BY oid),
ranked AS (
  SELECT ticket, row_number() OVER (PARTITION BY ticket ORDER BY fte DESC NULLS LAST, oid) AS rank, oid, fte
  FROM classed JOIN booked USING (oid) WHERE closed IS NULL)""",
        then="""
SELECT ticket AS "TICKET", CAST(rank AS INT) AS "RANK", oid AS "OID", fte AS "FTE" FROM ranked WHERE rank <= 10""",
    ),
    "leaderboard_display": _with(
        TICKETS,
        CLASSED,
        LONGEST,
        then="""
SELECT CAST(rank AS INT) AS "RANK", oid AS "OID", created AS "CREATED", age_days AS "AGE_DAYS"
FROM longest WHERE rank <= 10 ORDER BY ticket, rank""",
    ),
}
