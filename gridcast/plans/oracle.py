"""Independent SQL for every query that SQL can express, over the raw tables.

Written for one node: plain windows over laps where the Spark side aggregates
and joins. Chains of common table expressions mirror Bronze, Silver and Gold.
"""

from __future__ import annotations


def r6(x: str) -> str:
    return f"round({x} + 1e-9, 6)"


def r3(x: str) -> str:
    return f"round({x} + 1e-9, 3)"


LAPS = """
laps as (
  select
    'D' || cast(l_suppkey as varchar) as Driver, n_name as Team, 2026 as season,
    cast(year(o_orderdate) - 1994 as integer) as round_number,
    'GP' || cast(year(o_orderdate) - 1994 as varchar) as event,
    case o_orderpriority
      when '1-URGENT' then case when l_linestatus = 'F' then 'R' else 'S' end
      when '2-HIGH' then case when l_linestatus = 'F' then 'Q' else 'SQ' end
      when '3-MEDIUM' then 'FP3' when '4-NOT SPECIFIED' then 'FP2' when '5-LOW' then 'FP1'
    end as session_type,
    l_linenumber as LapNumber,
    case when l_orderkey % 97 = 0 then null
      else 80.0e0 + (cast(round(l_extendedprice * 100) as bigint) % 1000) / 100.0e0 end as LapTime,
    25.0e0 + (l_partkey % 100) / 100.0e0 as Sector1Time,
    30.0e0 + (l_orderkey % 100) / 100.0e0 as Sector2Time,
    25.0e0 + (cast(round(l_extendedprice * 100) as bigint) % 700) / 100.0e0 as Sector3Time,
    case p_type when 'SMALL' then 'soft' when 'MEDIUM' then 'Medium' when 'LARGE' then 'HARD'
      when 'STANDARD' then 'INTER' when 'ECONOMY' then 'WET' end as Compound,
    l_quantity as TyreLife,
    l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31 + l_suppkey * 611953 as row_key
  from lineitem
  join orders on l_orderkey = o_orderkey
  left join (supplier join nation on s_nationkey = n_nationkey) on l_suppkey = s_suppkey
  left join part on l_partkey = p_partkey
)"""

COMPLETE = (
    "Driver is not null and Team is not null and LapTime is not null "
    "and session_type is not null and season is not null and event is not null"
)

SILVER = f"""{LAPS},
complete as (
  select * replace (
    case when upper(Compound) in ('SOFT', 'MEDIUM', 'HARD', 'INTER', 'WET')
      then upper(Compound) else 'UNKNOWN' end as Compound)
  from laps where {COMPLETE}
),
silver as (
  select * exclude (best) from (
    select *, min(LapTime) over (partition by season, event, session_type) as best from complete
  ) where LapTime <= best * 1.07e0
)"""

RESULTS = """,
results as (
  select season, event, round_number, Driver as driver, Team as team,
    cast(row_number() over (
      partition by season, event order by n desc, total asc, Driver asc) as integer) as race_position
  from (
    select season, event, round_number, Driver, Team, count(*) as n, round(sum(LapTime), 2) as total
    from laps where session_type = 'R' and LapTime is not null group by all
  )
)"""

FEATURES = """,
featured as (
  select *,
    LapTime - min(LapTime) over ds as lap_time_delta,
    stddev_samp(LapTime) over ds as consistency_score,
    min(Sector1Time) over ds + min(Sector2Time) over ds + min(Sector3Time) over ds
      as best_sector_combo,
    case when max(TyreLife) over dc - min(TyreLife) over dc > 0
      then (max(LapTime) over dc - min(LapTime) over dc)
        / (max(TyreLife) over dc - min(TyreLife) over dc)
      else 0.0e0 end as tyre_deg_rate,
    min(LapTime) over ds - min(LapTime) over ts as pace_vs_teammate
  from silver
  window ds as (partition by season, event, session_type, Driver),
    dc as (partition by season, event, session_type, Driver, Compound),
    ts as (partition by season, event, session_type, Team)
)"""

TREND = """,
round_means as (
  select Driver, season, round_number, avg(lap_time_delta) as avg_delta
  from featured where session_type = 'R' group by all
),
starts as (select distinct Driver, season, round_number from silver),
trends as (
  select s.Driver, s.season, s.round_number,
    avg(case when m.round_number >= s.round_number - 2 then avg_delta end)
    - avg(case when m.round_number < s.round_number - 2 then avg_delta end) as pace_trend
  from starts s left join round_means m
    on m.Driver = s.Driver and m.season = s.season
    and m.round_number between s.round_number - 6 and s.round_number - 1
  group by all
)"""

GOLD_ = f"""{SILVER}{RESULTS}{FEATURES}{TREND},
gold as (
  select f.Driver as driver, f.Team as team, f.round_number, f.event, f.season, f.session_type,
    f.LapNumber as lap_number, f.Compound as compound, f.lap_time_delta, f.consistency_score,
    f.best_sector_combo, f.tyre_deg_rate, f.pace_vs_teammate, t.pace_trend, r.race_position,
    f.row_key
  from featured f
  left join trends t on t.Driver = f.Driver and t.season = f.season
    and t.round_number = f.round_number
  left join results r on r.season = f.season and r.event = f.event and r.driver = f.Driver
)"""

SCORED = f"""{GOLD_},
scored as (
  select *,
    round(1.0e0 / (1.0e0 + (lap_time_delta + pace_vs_teammate + coalesce(consistency_score, 0.0e0)))
      + 1e-9, 6) as win_prob_lap,
    cast(row_key % 20 + 1 as integer) as pred_pos_lap
  from gold
)"""

RANKED = f"""{SCORED},
position_counts as (
  select season, event, driver, team, pred_pos_lap, count(*) as n,
    row_number() over (partition by season, event, driver, team
      order by count(*) desc, pred_pos_lap) as place
  from scored group by season, event, driver, team, pred_pos_lap
),
drivers as (
  select s.season, s.event, s.driver, s.team, max(win_prob_lap) as best,
    any_value(c.pred_pos_lap) as common_position, count(*) as lap_count
  from scored s join position_counts c on c.season = s.season and c.event = s.event
    and c.driver = s.driver and c.team = s.team and c.place = 1
  group by all
),
ranked as (
  select season, event, driver, team, common_position, lap_count,
    best / sum(best) over (partition by season, event) as win_probability,
    cast(row_number() over (partition by season, event order by best desc, driver) as integer)
      as predicted_position
  from drivers
)"""

UNCERTAIN = f"""{RANKED},
draws as (
  select season, event, driver, rep, max(win_prob_lap) as best
  from (
    select s.*, rep, (row_key + rep * 15485863) % 2147483647 as m
    from scored s, range(20) reps(rep)
  ) where ((m * m) % 2147483647) % 1000 < 800
  group by all
),
shares as (
  select season, event, driver, best / sum(best) over (partition by season, event, rep) as share
  from draws
),
uncertain as (
  select season, event, driver, coalesce(stddev_samp(share), 0.0e0) as uncertainty
  from shares group by all
),
final as (
  select r.*, coalesce(uncertainty, 0.0e0) as uncertainty
  from ranked r left join uncertain u
    on u.season = r.season and u.event = r.event and u.driver = r.driver
)"""

HISTORY = f"""{RANKED},
history as (
  select r.season, r.event, g.round_number as round,
    max(case when r.predicted_position = 1 then r.driver end) as predicted, w.driver as actual,
    max(case when r.predicted_position = 1 then r.driver end) = w.driver as winner_hit,
    bool_or(r.driver = w.driver) as top3_hit
  from ranked r
  join (select distinct season, event, round_number from gold) g
    on g.season = r.season and g.event = r.event
  join (select distinct season, event, driver from gold
        where session_type = 'R' and race_position = 1) w
    on w.season = r.season and w.event = r.event
  where r.predicted_position <= 3
  group by r.season, r.event, g.round_number, w.driver
)"""

NAMES = (
    "lap_time_delta",
    "consistency_score",
    "best_sector_combo",
    "tyre_deg_rate",
    "pace_vs_teammate",
    "pace_trend",
)


def _sql(chain: str, body: str) -> str:
    return f"with {chain.strip()}\n{body.strip()}"


def _found(rows: str) -> str:
    """Breaches of each check of Silver among the rows."""
    checks = [
        *[(f"{c} is there", f"{c} is null") for c in ("Driver", "Team", "LapTime", "session_type", "season", "event")],
        ("compound is known", "Compound not in ('SOFT', 'MEDIUM', 'HARD', 'INTER', 'WET', 'UNKNOWN')"),
        ("lap within the outlier rule", "LapTime > best * 1.07e0"),
    ]
    best = f"select *, min(LapTime) over (partition by season, event, session_type) as best from {rows}"
    return (
        'select "check", count(*) as row_count, count(*) filter (breach) as breaches from ('
        + " union all ".join(f"select '{name}' as \"check\", {condition} as breach from ({best})" for name, condition in checks)
        + ") group by all"
    )


def _pearson(x: str) -> str:
    a = f"case when {x} is not null and race_position is not null then {x} end"
    b = f"case when {x} is not null and race_position is not null then race_position end"
    return (
        f"case when stddev_pop({a}) * stddev_pop({b}) <> 0 "
        f"then covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) end"
    )


def _corr_rows(where: str, by: str = "", having: str = "") -> str:
    group = f"group by {by} {having}" if by else ""
    lead = f"{by}, " if by else ""
    return " union all ".join(
        f"select {lead}'{x}' as feature, {r6(_pearson(x))} as r, "
        f"case when {_pearson(x)} > 0 then 'worse position' "
        f"when {_pearson(x)} <= 0 then 'better position' end as direction, count(*) as n "
        f"from gold where {where} {group}"
        for x in NAMES
    )


def _summary_rows() -> str:
    return " union all ".join(
        f"select '{x}' as feature, count({x}) as n, {r6(f'avg({x})')} as mean, "
        f"{r6(f'stddev_samp({x})')} as stddev, {r6(f'min({x})')} as min, "
        f"{r6(f'quantile_cont({x}, 0.25)')} as p25, {r6(f'quantile_cont({x}, 0.75)')} as p75, "
        f"{r6(f'max({x})')} as max from gold where race_position is not null"
        for x in NAMES
    )


def _importance() -> str:
    rows = " union all ".join(
        f"select '{x}' as feature, {r6(f'abs(coalesce({_pearson(x)}, 0.0e0))')} as importance "
        "from gold where race_position is not null"
        for x in NAMES
    )
    return f"importance as ({rows})"


SESSIONS = ("FP1", "FP2", "FP3", "Q", "SQ", "S", "R")
SCORE_COLUMNS = ", ".join(
    f"{r6(f'avg(case when session_type = {s!r} then lap_time_delta end)')} as score_{s}"
    for s in SESSIONS[:-1]
)
ROUNDED_FEATURES = ", ".join(f"{r6(x)} as {x}" for x in NAMES)
SESSION_WEIGHT = (
    "case session_type when 'FP1' then 0.15e0 when 'FP2' then 0.25e0 when 'FP3' then 0.35e0 "
    "when 'Q' then 0.7e0 when 'SQ' then 0.6e0 when 'S' then 0.5e0 when 'R' then 1.0e0 end"
)
RECENCY = "exp(-0.15e0 * ((select max(round_number) from {t}) - round_number))"


def _feature(column: str, third: str) -> str:
    return _sql(
        SILVER + FEATURES,
        f"select row_key, Driver as driver, {third}, {r6(column)} as {column} from featured",
    )


# Every lap goes to one of a race's 22 cars.
FIELD = GOLD_.replace("'D' || cast(l_suppkey as varchar) as Driver, n_name as Team", """
    'C' || cast(l_suppkey % 22 as varchar) as Driver, 'T' || cast(l_suppkey % 22 // 2 as varchar) as Team""")

INPUTS = (*NAMES, "compound_idx")

# Training rows and those to score, with inputs x0 to x6, class number and weight.
SEASON = f"""{FIELD},
classes as (
  select race_position, cast(race_position as varchar) as position,
    row_number() over (order by count(*) desc, cast(race_position as varchar)) - 1 as label
  from gold where race_position is not null group by race_position
),
compounds as (
  select compound, cast(row_number() over (order by count(*) desc, compound) - 1 as double) as compound_idx
  from gold where race_position is not null group by compound
),
inputs as materialized (
  select row_number() over () as lap, g.row_key, g.driver, g.event, g.round_number, c.position, c.label, g.race_position,
    {", ".join(f"{r6(f'coalesce({n}, 0.0e0)')} as x{k}" for k, n in enumerate(NAMES))},
    coalesce(compound_idx, (select count(*) from compounds)) as x6,
    {RECENCY.format(t="gold where race_position is not null")} * {SESSION_WEIGHT} as w
  from gold g left join classes c on c.race_position = g.race_position left join compounds k on k.compound = g.compound
),
train as (select * from inputs where label is not null)"""


def _grown(rows: str, scored: str, depth: int = 2) -> str:
    """CTEs of a tree: ``nodes``, the classes' weights in each (``held``), and where each scored row ends (``ended``)."""
    long = " union all ".join(f"select lap, label, w, {k} as feature, x{k} as x from ({rows})" for k in range(7))
    value = "case feature " + " ".join(f"when {k} then x{k}" for k in range(7)) + " end"
    quantiles = ", ".join(f"{k}/32.0e0" for k in range(1, 32))
    out = [
        f"long as ({long})",
        f"""cuts as (select distinct feature, {r6("q")} as t from (
          select feature, unnest(quantile_cont(x, [{quantiles}])) as q from long group by feature))""",
        f"at0 as (select *, 0 as node from ({rows}))",
        f"end0 as (select *, 0 as node from ({scored}))",
    ]
    for k in range(depth):
        out += [
            f"""sides{k} as (
              select node, l.feature, t, l.label, sum(l.w) filter (x <= t) as below, sum(l.w) as total
              from long l join at{k} a using (lap) join cuts c on c.feature = l.feature group by all
            )""",
            f"""gains{k} as (
              select node, feature, t, sum(coalesce(below, 0)) as l, sum(total) as n, sum(coalesce(below, 0) ** 2) as ll,
                sum((total - coalesce(below, 0)) ** 2) as rr, sum(total ** 2) as tt
              from sides{k} group by all
            )""",
            f"""split{k} as (
              select node, feature, t, gain from (
                select *, row_number() over (partition by node order by gain desc, feature, t) as place from (
                  select node, feature, t, round((ll / l + rr / (n - l) - tt / n) / n + 1e-9, 9) as gain
                  from gains{k} where l > 1e-9 and n - l > 1e-9))
              where place = 1 and gain > 0
            )""",
            *[
                f"""{name}{k + 1} as (
                  select r.* exclude (node), 2 * r.node + (case when {value} <= t then 1 else 2 end) as node
                  from {name}{k} r join split{k} s on s.node = r.node
                )"""
                for name in ("at", "end")
            ],
        ]
    levels = range(depth + 1)
    held = " union all ".join(f"select node, label, w from at{k}" for k in levels)
    splits = " union all ".join(f"select * from split{k}" for k in range(depth))
    ended = " union all ".join(
        f"select * from end{k}" + (f" where node not in (select node from split{k})" if k < depth else "") for k in levels
    )
    out += [
        f"held as (select node, label, sum(w) as w from ({held}) group by all)",
        f"""nodes as (
          select h.node, sum(h.w) as weight, arg_max(h.label, (h.w, -h.label)) as label,
            any_value(s.feature) as feature, any_value(s.t) as threshold, any_value(s.gain) as gain
          from held h left join ({splits}) s on s.node = h.node group by h.node
        )""",
        f"ended as ({ended})",
    ]
    return ", " + ",\n".join(out)


INPUT_NAME = "case feature " + " ".join(f"when {k} then '{n}'" for k, n in enumerate(INPUTS)) + " end"
NOW = "select * from inputs where event = 'GP7'"

ORACLE: dict[str, str] = {
    "scan_laps": _sql(
        LAPS,
        f"""select Driver, Team, LapNumber, {r6('cast(cast(LapTime as float) as double)')} as lap_seconds,
        Compound, session_type, season, event from laps""",
    ),
    "conform_columns": _sql(
        LAPS,
        f"""select Driver, cast(null as varchar) as DriverNumber, Team, LapNumber,
        {r6('TyreLife')} as tyre_life, cast(null as double) as speed_i1,
        cast(null as varchar) as FreshTyre, season, event, cast(null as varchar) as session
        from laps""",
    ),
    "durations_to_seconds": _sql(
        LAPS,
        f"select row_key, {r6('LapTime')} as LapTime, {r6('Sector1Time')} as Sector1Time from laps",
    ),
    "normalise_session": _sql(
        LAPS,
        """select row_key, session_type, 'SQ' as requested,
        case session_type when 'FP1' then 'Practice 1' when 'FP2' then 'Practice 2'
          when 'FP3' then 'Practice 3' when 'Q' then 'Qualifying' when 'SQ' then 'Sprint Shootout'
          when 'S' then 'Sprint' when 'R' then 'Race' end as session_name from laps""",
    ),
    "flag_text": _sql(
        LAPS,
        """select row_key, case when TyreLife <= 3 then 'True' when TyreLife > 3 then 'False' end
          as FreshTyre,
        case when LapTime < 85 then 'True' when LapTime >= 85 then 'False' end as IsPersonalBest
        from laps""",
    ),
    "roundtrip_partitioned": _sql(
        LAPS,
        f"""select season, event, session_type as session, count(*) as laps,
        count(LapTime) as timed, {r6('sum(TyreLife)')} as tyre_life from laps group by all""",
    ),
    "session_coverage": _sql(
        LAPS,
        f"""select e.season, e.event, e.Driver, e.session_type, coalesce(n, 0) as laps,
        case when n > 0 then 'ingested' else 'skipped' end as status
        from (select * from (select distinct season, event, Driver from laps),
              (select unnest([{', '.join(map(repr, SESSIONS))}]) as session_type)) e
        left join (select season, event, Driver, session_type, count(*) as n
                   from laps group by all) f
        using (season, event, Driver, session_type)""",
    ),
    "session_coverage_expected": _sql(
        LAPS,
        f"""select e.season, e.event, e.session_type, coalesce(n, 0) as laps,
        case when n > 0 then 'ingested' else 'skipped' end as status
        from (select * from (select distinct season, event from laps
                             union select season, 'GP' || cast(max(round_number) + 1 as varchar)
                             from laps group by season),
              (select unnest([{', '.join(map(repr, SESSIONS))}]) as session_type)) e
        left join (select season, event, session_type, count(*) as n from laps group by all) f
        using (season, event, session_type)""",
    ),
    "results_conform": _sql(
        LAPS + RESULTS,
        """select driver as Driver, team as TeamName,
        case when race_position % 10 <> 0 then race_position end as Position,
        cast(null as integer) as GridPosition, cast(null as varchar) as Status,
        cast(null as double) as Points, season, event, round_number from results""",
    ),
    "replace_partitions": _sql(
        SILVER,
        """select season, event, session_type, count(*) as laps from silver
        where event <> 'GP7' or session_type = 'R' group by all""",
    ),
    "merge_schema": _sql(
        LAPS,
        """select season, event, count(*) as laps,
        count(case when event = 'GP7' then TyreLife end) as with_tyre_life,
        cast(sum(LapNumber) as bigint) as lap_numbers from laps group by all""",
    ),
    "replace_where": _sql(
        LAPS,
        """select season, event, session_type, Driver, count(*) as laps from laps
        where session_type = case when event = 'GP7' then 'S' else 'R' end group by all""",
    ),
    "partition_pruned_scan": _sql(
        LAPS,
        f"""select Driver, session_type, {r6('LapTime')} as lap_seconds from laps
        where season = 2026 and event = 'GP7'""",
    ),
    "drop_critical_nulls": _sql(
        LAPS,
        f"""select season, round_number, event, session_type, Driver, Team, LapNumber,
        {r6('LapTime')} as LapTime, Compound, row_key from laps where {COMPLETE}""",
    ),
    "cast_lap_number": _sql(
        LAPS, "select row_key, case when LapNumber <> 7 then LapNumber end as LapNumber from laps"
    ),
    "normalise_compound": _sql(
        LAPS, "select row_key, coalesce(upper(Compound), 'UNKNOWN') as Compound from laps"
    ),
    "session_best": _sql(
        LAPS,
        f"""select season, round_number, event, session_type, Driver, {r6('LapTime')} as LapTime,
        row_key, {r6('min(LapTime) over (partition by season, event, session_type)')}
          as session_best from laps""",
    ),
    "rule_107": _sql(
        LAPS,
        f"""select season, round_number, event, session_type, Driver, {r6('LapTime')} as LapTime,
        row_key from (select *, min(LapTime) over (partition by season, event, session_type) as best
          from laps) where LapTime <= best * 1.07e0""",
    ),
    "silver": _sql(
        SILVER,
        f"""select season, round_number, event, session_type, Driver, Team, LapNumber,
        {r6('LapTime')} as LapTime, Compound, row_key from silver""",
    ),
    "row_loss": _sql(
        SILVER,
        """select bronze_rows, bronze_rows - complete_rows as dropped_nulls,
        complete_rows - silver_rows as dropped_outliers, silver_rows,
        round((bronze_rows - silver_rows) * 100.0e0 / bronze_rows + 1e-9, 1) as removed_pct
        from (select (select count(*) from laps) as bronze_rows,
          (select count(*) from complete) as complete_rows,
          (select count(*) from silver) as silver_rows)""",
    ),
    "breach_count": _sql(
        LAPS,
        """select count(*) as breaches
        from (select *, min(LapTime) over (partition by season, event, session_type) as best
          from laps) where LapTime > best * 1.07e0""",
    ),
    "breach_count_silver": _sql(
        SILVER,
        """select count(*) as breaches
        from (select *, min(LapTime) over (partition by season, event, session_type) as best
          from silver) where LapTime > best * 1.07e0""",
    ),
    "count_by_session": _sql(
        LAPS, "select session_type, count(*) as row_count from laps group by all"
    ),
    "count_by_round_session": _sql(
        LAPS,
        "select round_number, event, session_type, count(*) as row_count from laps group by all",
    ),
    "null_counts": _sql(
        LAPS,
        "select "
        + ", ".join(
            f"count(*) - count({c}) as {c}"
            for c in ("Driver", "Team", "LapTime", "session_type", "season", "event", "Compound")
        )
        + " from laps",
    ),
    "null_rates": _sql(
        GOLD_,
        "select "
        + ", ".join(
            f"round((count(*) - count({c})) * 100.0e0 / count(*) + 1e-9, 1) as {c}"
            for c in (*NAMES, "race_position")
        )
        + " from gold",
    ),
    "distinct_compounds": _sql(
        LAPS, "select distinct coalesce(upper(Compound), 'UNKNOWN') as Compound from laps"
    ),
    "sessions_used": _sql(SILVER, "select distinct event, session_type from silver"),
    "lap_time_delta": _feature("lap_time_delta", "session_type"),
    "consistency_score": _feature("consistency_score", "session_type"),
    "best_sector_combo": _feature("best_sector_combo", "session_type"),
    "tyre_deg_rate": _feature("tyre_deg_rate", "Compound as compound"),
    "pace_vs_teammate": _feature("pace_vs_teammate", "Team as team"),
    "round_avg_delta": _sql(
        SILVER + FEATURES + TREND,
        f"""select Driver as driver, season, round_number, {r6('avg_delta')} as avg_delta
        from round_means where round_number < 7""",
    ),
    "pace_trend": _sql(
        SILVER + FEATURES + TREND,
        f"""select Driver as driver, season,
        {r6('''avg(case when round_number between 5 and 6 then avg_delta end)
          - avg(case when round_number between 1 and 4 then avg_delta end)''')} as pace_trend
        from round_means where round_number between 1 and 6 group by all
        having count(case when round_number between 5 and 6 then 1 end) > 0""",
    ),
    "pace_trend_state": _sql(
        SILVER + FEATURES + TREND,
        f"""select Driver as driver, season,
        {r6('''avg(case when round_number between 5 and 6 then avg_delta end)
          - avg(case when round_number between 1 and 4 then avg_delta end)''')} as pace_trend
        from round_means where round_number between 1 and 6 group by all
        having count(case when round_number between 5 and 6 then 1 end) > 0""",
    ),
    "pace_trend_joined": _sql(
        SILVER + FEATURES + TREND,
        f"""select row_key, s.Driver as driver, s.season, {r6('pace_trend')} as pace_trend
        from silver s left join (
          select Driver, season, avg(case when round_number between 5 and 6 then avg_delta end)
            - avg(case when round_number between 1 and 4 then avg_delta end) as pace_trend
          from round_means where round_number between 1 and 6 group by all) t
        on t.Driver = s.Driver and t.season = s.season
        where s.season = 2026 and s.event = 'GP7'""",
    ),
    "label_join": _sql(
        SILVER + RESULTS,
        """select row_key, s.season, s.event, s.Driver as driver, race_position
        from silver s left join results r
        on r.season = s.season and r.event = s.event and r.driver = s.Driver""",
    ),
    "gold": _sql(
        GOLD_,
        f"""select driver, team, round_number, event, season, session_type, lap_number, compound,
        {ROUNDED_FEATURES}, race_position, row_key, cast(null as double) as recency_weight,
        cast(null as double) as session_weight, cast(null as double) as sample_weight from gold""",
    ),
    "session_weight": _sql(
        LAPS,
        f"""select row_key, round_number, session_type, {r6(SESSION_WEIGHT)} as session_weight
        from laps""",
    ),
    "recency_weight": _sql(
        LAPS,
        f"""select row_key, round_number, session_type,
        {r6(RECENCY.format(t='laps'))} as recency_weight from laps""",
    ),
    "sample_weight": _sql(
        LAPS,
        f"""select row_key, round_number, session_type,
        {r6(RECENCY.format(t='laps') + ' * ' + SESSION_WEIGHT)} as sample_weight from laps""",
    ),
    "weight_audit": _sql(
        GOLD_ + ", train as (select * from gold where race_position is not null)",
        f"""select round_number, session_type, {r3('avg(rw)')} as avg_recency,
        {r3('avg(sw)')} as avg_session, {r3('avg(rw * sw)')} as avg_sample
        from (select round_number, session_type, {RECENCY.format(t='train')} as rw,
          {SESSION_WEIGHT} as sw from train) group by all""",
    ),
    "impute_numeric": _sql(
        GOLD_,
        "select row_key, "
        + ", ".join(f"{r6(f'coalesce({x}, 0.0e0)')} as {x}" for x in NAMES)
        + " from gold",
    ),
    "impute_label": _sql(
        GOLD_, "select row_key, driver, coalesce(race_position, -1) as race_position from gold"
    ),
    "labelled_rows": _sql(
        GOLD_,
        "select row_key, driver, event, race_position from gold where race_position is not null",
    ),
    "predicate_filters": _sql(
        LAPS,
        f"""select season, round_number, event, session_type, Driver, Team, LapNumber,
        {r6('LapTime')} as LapTime, upper(Compound) as Compound, row_key from laps
        where season = 2026 and round_number < 7 and session_type = 'R'
          and Compound is not null and LapTime is not null""",
    ),
    "model_version": _sql(
        GOLD_,
        """select season, round_number,
        case when count(race_position) > 0 then 'base_r' else 'qualifying_r' end
          || lpad(cast(round_number as varchar), 2, '0') as model_version
        from gold group by season, round_number""",
    ),
    "temporal_split": _sql(
        GOLD_,
        """select case when round_number < (select max(round_number) from gold
            where race_position is not null) then 'fit' else 'holdout' end as split,
        round_number, count(*) as row_count
        from gold where race_position is not null group by all""",
    ),
    "feature_summary": _sql(GOLD_, _summary_rows()),
    "feature_summary_approx": _sql(
        GOLD_,
        f"""select * exclude (p25, p75), true as p25_within_error, true as p75_within_error
        from ({_summary_rows()})""",
    ),
    "session_profile": _sql(
        GOLD_,
        f"""select session_type, {r3('avg(lap_time_delta)')} as avg_lap_delta,
        {r3('avg(consistency_score)')} as avg_consistency,
        {r3('avg(pace_vs_teammate)')} as avg_vs_teammate,
        {r3('avg(tyre_deg_rate)')} as avg_tyre_deg, count(*) as row_count
        from gold group by session_type""",
    ),
    "driver_leaders": _sql(
        GOLD_,
        f"""select driver, team, {r3('avg(lap_time_delta)')} as avg_lap_delta,
        {r3('avg(consistency_score)')} as avg_consistency,
        {r3('avg(pace_vs_teammate)')} as avg_vs_teammate
        from gold where event = 'GP7' group by driver, team""",
    ),
    "race_leaders": _sql(
        GOLD_,
        f"""select driver, team, race_position, {r3('avg(lap_time_delta)')} as avg_lap_delta,
        {r3('avg(consistency_score)')} as avg_consistency,
        {r3('avg(tyre_deg_rate)')} as avg_tyre_deg
        from gold where event = 'GP7' and session_type = 'R' group by all""",
    ),
    "teammate_gap": _sql(
        GOLD_,
        f"""select driver, team, {r3('avg(pace_vs_teammate)')} as avg_vs_teammate,
        {r3('min(pace_vs_teammate)')} as best_vs_teammate, count(*) as laps
        from gold where session_type = 'R' and race_position is not null group by driver, team""",
    ),
    "compound_effect": _sql(
        GOLD_,
        f"""select compound, {r3('avg(lap_time_delta)')} as avg_lap_delta,
        {r3('avg(tyre_deg_rate)')} as avg_tyre_deg, count(*) as laps
        from gold where compound <> 'UNKNOWN' group by compound""",
    ),
    "trend_leaders": _sql(
        GOLD_,
        f"""select driver, team, {r3('avg(pace_trend)')} as avg_pace_trend
        from gold where session_type = 'R' and pace_trend is not null group by driver, team""",
    ),
    "feature_corr": _sql(
        GOLD_, _corr_rows("race_position is not null and session_type = 'R'")
    ),
    "feature_corr_by_session": _sql(
        GOLD_,
        _corr_rows("race_position is not null", "session_type", "having count(*) >= 10"),
    ),
    "top_n": _sql(
        GOLD_,
        f"""select driver, team, {r3('avg(lap_time_delta)')} as avg_lap_delta,
        {r3('avg(consistency_score)')} as avg_consistency,
        {r3('avg(pace_vs_teammate)')} as avg_vs_teammate
        from gold group by driver, team order by avg_lap_delta, driver limit 20""",
    ),
    "driver_prediction": _sql(
        RANKED,
        f"""select season, event, driver, team, {r6('best')} as win_probability, common_position,
        lap_count from drivers""",
    ),
    "normalise_share": _sql(
        RANKED,
        f"select season, event, driver, {r6('win_probability')} as win_probability from ranked",
    ),
    "rank_drivers": _sql(
        RANKED,
        f"""select season, event, driver, team, {r6('win_probability')} as win_probability,
        predicted_position from ranked""",
    ),
    "subsample_uncertainty": _sql(
        UNCERTAIN,
        f"""select d.season, d.event, d.driver, {r6('coalesce(uncertainty, 0.0e0)')} as uncertainty
        from drivers d left join uncertain u
        on u.season = d.season and u.event = d.event and u.driver = d.driver""",
    ),
    "uncertainty_join": _sql(
        UNCERTAIN,
        f"""select season, event, driver, {r6('win_probability')} as win_probability,
        {r6('uncertainty')} as uncertainty from final""",
    ),
    "uncertainty_band": _sql(
        UNCERTAIN,
        f"""select season, event, driver, uncertainty,
        case when uncertainty < 0.05e0 then 'LOW' when uncertainty < 0.15e0 then 'MED'
          else 'HIGH' end as band
        from (select season, event, driver, {r6('uncertainty / win_probability')} as uncertainty
          from final)""",
    ),
    "prediction_rows": _sql(
        UNCERTAIN,
        f"""select driver, team, event, 7 as round, season, 'base_r07' as model_version,
        predicted_position, {r6('win_probability')} as win_probability,
        {r6('uncertainty')} as uncertainty from final where event = 'GP7'""",
    ),
    "session_scores": _sql(
        GOLD_, f"select season, event, driver, {SCORE_COLUMNS} from gold group by all"
    ),
    "winner_history": _sql(HISTORY, "select * from history"),
    "season_accuracy": _sql(
        HISTORY,
        """select coalesce(round(avg(cast(winner_hit as double)), 4), 0.0e0) as winner_pct,
        count(*) as races from history""",
    ),
    "exact_accuracy": _sql(
        RANKED,
        f"""select {r6('avg(cast(predicted_position = race_position as double))')}
          as exact_accuracy
        from ranked r left join results x
        on x.season = r.season and x.event = r.event and x.driver = r.driver""",
    ),
    "within_k_accuracy": _sql(
        RANKED,
        f"""select {r6('avg(cast(abs(predicted_position - race_position) <= 2 as double))')}
          as within_2_accuracy
        from ranked r left join results x
        on x.season = r.season and x.event = r.event and x.driver = r.driver""",
    ),
    "top3_summary": _sql(
        RANKED,
        f"""select season, event, driver, team, {r6('win_probability')} as win_probability,
        predicted_position as place, 'P' || predicted_position as label
        from ranked where predicted_position <= 3""",
    ),
    "recency_table": _sql(
        LAPS,
        f"""select season, round_number, top - round_number as rounds_ago,
        {r6('exp(-0.15e0 * (top - round_number))')} as decay
        from (select distinct season, round_number,
          max(round_number) over (partition by season) as top from laps)""",
    ),
    "relative_importance": _sql(
        f"{GOLD_}, {_importance()}",
        f"""select feature, importance,
        {r6('greatest(importance / (select max(importance) from importance), 0.01e0)')} as relative
        from importance""",
    ),
    "export_lines": _sql(
        UNCERTAIN,
        """select f.event, f.driver, predicted_position,
        round(win_probability, 4) as win_probability, 'flat' as trend, round(q, 2) as q_score,
        case when q is not null then 0.7e0 end as q_weight
        from final f join (
          select driver, avg(case when session_type = 'Q' then lap_time_delta end) as q
          from gold where event = 'GP7' group by driver) s on s.driver = f.driver
        where f.event = 'GP7'""",
    ),
    "export_document": _sql(
        f"{HISTORY}, {_importance()}",
        """select 'base_r07' as model_version, 'GP7' as event, 7 as round, 2026 as season,
        (select string_agg(session_type, ',' order by session_type) from
          (select distinct session_type from gold where event = 'GP7')) as sessions_used,
        (select coalesce(round(avg(cast(winner_hit as double)), 4), 0.0e0) from history) as top3_pct,
        (select count(*) from history) as races, 0.15e0 as recency_lambda,
        (select count(*) from ranked where event = 'GP7') as drivers,
        (select driver from ranked where event = 'GP7' and predicted_position = 1) as winner,
        (select round(win_probability, 4) from ranked
          where event = 'GP7' and predicted_position = 1) as top_probability,
        (select feature from importance order by importance desc, feature limit 1) as top_feature,
        (select count(*) from history) as history_rows""",
    ),
    "export_document_entries": _sql(
        HISTORY,
        """select driver, team, predicted_position, round(win_probability, 4) as win_probability
        from ranked where event = 'GP7'""",
    ),
    "compound_index": _sql(
        HISTORY,
        """select compound, cast(row_number() over (order by count(*) desc, compound) - 1 as double)
          as compound_idx, count(*) as laps from gold group by compound""",
    ),
    "label_index": _sql(
        HISTORY,
        """select cast(race_position as varchar) as position, cast(row_number() over (
          order by count(*) desc, cast(race_position as varchar)) - 1 as double) as label,
          count(*) as laps from gold where race_position is not null group by race_position""",
    ),
    "feature_vector": _sql(
        SEASON, "select row_key, " + ", ".join(f"x{k} as {n}" for k, n in enumerate(INPUTS)) + " from train"
    ),
    "class_to_position": _sql(
        SEASON,
        """select row_key, class, c.race_position as position from (
          select row_key, cast(row_key % ((select count(*) from classes) + 1) as integer) as class from train
        ) left join classes c on c.label = class""",
    ),
    "win_slot": _sql(
        SEASON,
        f"""select row_key, {r6("((row_key + 7919 * (select label from classes where position = '1')) % 1000) / 1000.0e0")}
          as win_prob_lap from inputs where event = 'GP7'""",
    ),
    "grown_tree": _sql(
        SEASON + _grown("select * from train", NOW),
        f"""select cast(node as integer) as node, {INPUT_NAME} as feature, threshold, {r6("gain")} as gain,
        {r6("weight")} as weight, c.race_position as position from nodes n join classes c on c.label = n.label""",
    ),
    "tree_walk": _sql(
        SEASON + _grown("select * from train", NOW),
        f"""select row_key, driver, cast(e.node as integer) as node,
          {r6("coalesce(h.w, 0) / n.weight")} as win_prob_lap, c.race_position as pred_pos_lap
        from ended e join nodes n on n.node = e.node join classes c on c.label = n.label
          left join held h on h.node = e.node and h.label = (select label from classes where position = '1')""",
    ),
    "tree_importance": _sql(
        SEASON + _grown("select * from train", NOW),
        f"""select i.feature, {r6("coalesce(gained / sum(gained) over (), 0)")} as importance
        from (select unnest({list(INPUTS)}) as feature) i left join (
          select {INPUT_NAME} as feature, sum(gain * weight) as gained from nodes where feature is not null group by all
        ) g on g.feature = i.feature""",
    ),
    "holdout_rows": _sql(
        SEASON
        + _grown(
            "select * from train where round_number < (select max(round_number) from train)",
            "select * from train where round_number = (select max(round_number) from train)",
        ),
        """select row_key, driver, e.race_position as actual_position, c.race_position as predicted_position,
          abs(c.race_position - e.race_position) as off_by, c.race_position = e.race_position as hit,
          abs(c.race_position - e.race_position) <= 2 as within_2
        from ended e join nodes n on n.node = e.node join classes c on c.label = n.label""",
    ),
    # What must hold of each lap.
    "model_round_trip": _sql(
        SEASON, "select row_key, 'base_r07' as model_version, true as same from inputs where event = 'GP7'"
    ),
    "forest_walk": _sql(
        SEASON,
        """select row_key, driver, cast((select count(*) from classes) as integer) as classes, true as same_probabilities,
          true as same_win_probability, true as same_position from inputs where event = 'GP7'""",
    ),
    "forest_importance": _sql(
        "names as (select unnest([" + ", ".join(f"'{n}'" for n in INPUTS) + "]) as feature)",
        "select feature, feature <> 'compound_idx' as exported, true as same from names",
    ),
    "baseline_gradient": _sql(
        SEASON,
        "select c.race_position as position, true as converged, "
        + ", ".join(
            f"{r6(f'sum(w * (1.0e0 / (select count(*) from classes) - (case when t.label = c.label then 1 else 0 end)) * {x}) / sum(w)')} as {n}"
            for x, n in [("1", "intercept"), *((f"x{k}", n) for k, n in enumerate(INPUTS))]
        )
        + " from train t join classes c on true group by c.race_position",
    ),
    "scan_csv_mixed": _sql(
        LAPS,
        f"""select row_key, Driver, case when not cut then LapNumber end as LapNumber,
          case when not cut then session_type end as session_type,
          case when not cut then {r6("cast(cast(LapTime as float) as double)")} end as lap_seconds,
          case when not cut and round_number > 3 then {r6("cast(TyreLife as double)")} end as tyre_life,
          case when cut then 'not 9 fields' end as reason
        from (select *, row_key % 50 = 0 as cut from laps)""",
    ),
    "tag_constants": _sql(
        LAPS,
        """select Driver, row_key, season, event, session_type as session, session_type from laps
        where event = 'GP7' and session_type = 'Q'""",
    ),
    "optional_table": _sql(
        LAPS + RESULTS,
        """select row_key, l.Driver as driver, l.event, race_position as position_now,
          cast(null as integer) as position_before
        from laps l left join results r on r.season = l.season and r.event = l.event and r.driver = l.Driver""",
    ),
    "merge_widened": _sql(
        LAPS,
        f"""select row_key, event,
          case when round_number <= 3 then LapNumber::bigint else LapNumber + 1099511627776::bigint end as LapNumber,
          {r6("case when round_number <= 3 then cast(cast(LapTime as float) as double) else LapTime end")} as lap_seconds,
          case when round_number > 3 then {r6("cast(TyreLife as double)")} end as tyre_life from laps""",
    ),
    "calendar_pruned_scan": _sql(
        LAPS, f"select event, Driver, session_type, {r6('LapTime')} as lap_seconds from laps where round_number >= 6"
    ),
    "verify_silver": _sql(
        SILVER + f", found as ({_found('silver')})",
        """select 'silver' as step, "check", row_count, breaches from found""",
    ),
    "verify_gold": _sql(
        GOLD_,
        "select 'gold' as step, \"check\", count(*) as row_count, count(*) filter (breach) as breaches from ("
        + " union all ".join(
            f"select '{name}' as \"check\", {condition} as breach from gold"
            for name, condition in [
                *[
                    (f"{c} is there", f"{c} is null")
                    for c in ("driver", "team", "round_number", "event", "season", "session_type", "lap_number")
                ],
                *[(f"{c} is a number", f"isnan({c})") for c in NAMES],
                ("no lap beats the driver''s best", "lap_time_delta is null or lap_time_delta < 0"),
                ("no driver beats the team''s best", "pace_vs_teammate < 0"),
                ("positions count from 1", "race_position < 1"),
            ]
        )
        + ") group by all",
    ),
    "verify_refused": _sql(
        LAPS
        + f""", bronze as (
          select * replace (case when upper(Compound) in ('SOFT', 'MEDIUM', 'HARD', 'INTER', 'WET')
            then upper(Compound) else 'UNKNOWN' end as Compound) from laps
        ), found as ({_found("bronze")})""",
        """select 'silver' as step, "check", row_count, breaches, (
            select count(*) from (
              select *, min(LapTime) over (partition by season, event, session_type) as best from bronze
            ) where Driver is null or Team is null or LapTime is null or season is null or event is null
              or session_type is null or LapTime > best * 1.07e0
          ) as rows_aside, false as stored from found""",
    ),
}
