"""SQL (DuckDB) that computes the registered queries straight from ``events``.

Each statement starts from the sample formulas, not from nested bags, and states
the report rules literally: revenue fan-out as a join, distinct counts as such,
sessions as an as-of join. Nothing here follows the Spark plans.
"""

from __future__ import annotations

# One row per event with every value the queries use.
E = r"""
e AS (
  SELECT ts, u, k, v, epoch_us(ts) AS us, CAST(ts AS DATE) AS d, CAST(u AS VARCHAR) AS usr,
    CASE kind WHEN 'signup' THEN CASE WHEN u % 29 = 5 THEN 'session_start' ELSE 'first_open' END WHEN 'view' THEN {view} WHEN 'click' THEN 'level_start'
      WHEN 'error' THEN 'level_end' WHEN 'purchase' THEN {pay} END AS ev,
    '1.0.' || CAST(7 + (u + (CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END)) % 3 AS VARCHAR) AS ver,
    CASE WHEN u % 7 = 0 THEN 'China' WHEN u % 11 = 0 THEN NULL
      ELSE ['Vietnam', 'Brazil', 'Japan'][u % 3 + 1] END AS geo,
    ['Home', 'PushTheBall', 'RedLightGreenLight', 'StealTheBrainrot'][k % 4 + 1] AS scr,
    CASE WHEN kind IN ('click', 'error') AND k % 17 <> 0 THEN
      ['Home', 'PushTheBall', 'RedLightGreenLight', 'StealTheBrainrot'][(k // 3) % 4 + 1] END AS mg,
    CASE WHEN kind = 'error' THEN ['win', 'lose', 'quit', NULL][(k // 4) % 4 + 1] END AS res,
    CASE WHEN kind <> 'error' THEN NULL WHEN k % 13 = 0 THEN 'bad'
      WHEN k % 2 = 1 THEN CAST(CAST(k + 0.5 AS DOUBLE) AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS dur,
    CASE WHEN kind <> 'purchase' OR u % 9 = 4 OR k % 23 = 0 THEN NULL WHEN k % 7 = 0 THEN v
      WHEN k % 5 = 0 THEN floor(v) ELSE v END AS val,
    CASE WHEN kind = 'purchase' AND u % 9 <> 4 AND k % 23 <> 0 AND k % 7 <> 0 AND k % 5 <> 0 THEN v END AS val_real,
    CASE WHEN kind = 'purchase' THEN
      ['BANNER', 'mrec', 'MEDIUM_RECT', 'Interstitial', 'rewarded', 'native'][k % 6 + 1] END AS fmt,
    CASE WHEN kind = 'purchase' THEN
      ['BANNER', 'MREC', 'MREC', 'INTER', 'REWARDED', 'OTHER'][k % 6 + 1] END AS grp,
    CAST(u * 1000 + day(ts) AS BIGINT) AS sid,
    (day(ts) - 1) // 10 + 1 AS snum, 'm' || CAST(u % 4 AS VARCHAR) AS med,
    ['1', 'TRUE', '0', 'f', '2', '3', 'Ctl', NULL][u % 8 + 1] AS arm,
    ['B', 'B', 'A', 'A', 'C', 'D', 'Ctl', NULL][u % 8 + 1] AS arm_label
  FROM (SELECT ts, user_id AS u, event_type AS kind, value AS v,
          CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events))"""

PLAIN = E.format(view="'session_start'", pay="'ad_impression'")
SOME_WITHOUT_SESSION = E.format(
    view="CASE WHEN u % 13 = 0 THEN 'user_engagement' ELSE 'session_start' END",
    pay="'ad_impression'",
)
PURCHASES = E.format(
    view="'session_start'",
    pay="CASE WHEN k % 10 = 3 THEN 'in_app_purchase' ELSE 'ad_impression' END",
)


def sql(body: str, ctes: str = "", base: str = PLAIN) -> str:
    return f"WITH {base}{', ' + ctes if ctes else ''} {body}"


def iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d')"


FMT = {"banner": "BANNER", "mrec": "MREC", "inter": "INTER", "reward": "REWARDED"}

# --- operators -------------------------------------------------------------

SCAN = "SELECT {tag} strftime(d, '%Y%m%d') AS shard, usr AS user_pseudo_id, us AS event_timestamp, ev AS event_name FROM e"
# The bag's entries: (key, present when, text slot, integer slot).
BOTH = "ev IN ('level_start', 'level_end')"
AD = "ev = 'ad_impression'"
END = "ev = 'level_end'"
BAG_ENTRIES = [
    ("ga_session_id", "TRUE", "NULL", "sid"),
    ("ga_session_number", "TRUE", "NULL", "snum"),
    ("engagement_time_msec", "TRUE", "NULL", "k * 100"),
    ("current_screen", "TRUE", "'ep_' || scr", "NULL"),
    ("placement", "TRUE", "'p' || (k % 7)", "NULL"),
    ("placement", "k % 6 = 0", "'q' || (k % 5)", "NULL"),
    ("minigame_id", "mg IS NOT NULL", "mg", "NULL"),
    ("attempt", BOTH, "NULL", "k % 5"),
    ("level", BOTH, "CASE WHEN k % 19 = 0 THEN 'L' ELSE CAST(k AS VARCHAR) END", "k"),
    ("play_type", BOTH, "'t' || (k % 3)", "NULL"),
    ("play_index", BOTH, "NULL", "k"),
    ("deaths", END, "CASE WHEN k % 9 = 0 THEN 'x' ELSE CAST(k % 4 AS VARCHAR) END", "NULL"),
    ("play_duration", END, "CASE WHEN k % 13 = 0 THEN 'bad' END",
     "CASE WHEN k % 13 <> 0 AND k % 2 = 0 THEN k END"),
    ("play_time", END, "NULL", "NULL"),
    ("lose_by", END, "'l' || (k % 6)", "NULL"),
    ("result_by", "res IS NOT NULL", "res", "NULL"),
    ("result", "res IS NOT NULL", "res", "NULL"),
    ("value", AD, "CASE WHEN k % 7 = 0 AND u % 9 <> 4 AND k % 23 <> 0 THEN CAST(v AS VARCHAR) END",
     "CASE WHEN k % 7 <> 0 AND k % 5 = 0 AND u % 9 <> 4 AND k % 23 <> 0 THEN CAST(floor(v) AS BIGINT) END"),
    ("currency", AD, "'USD'", "NULL"),
    ("ad_format", AD, "fmt", "NULL"),
    ("ad_network", AD, "'n' || (k % 4)", "NULL"),
    ("network_name", AD, "'nn' || (k % 3)", "NULL"),
    ("ad_platform", AD, "'pf' || (k % 3)", "NULL"),
    ("ad_source", AD, "'s' || (k % 2)", "NULL"),
    ("ad_duration", AD, "NULL", "k % 31"),
    ("action_seq_10", "k % 2 = 0", "'ten' || k", "NULL"),
    ("action_seq_2", "k % 3 = 0", "'two' || k", "NULL"),
    ("action_seq_1", "k % 5 = 0", "'one' || k", "NULL"),
]
ID = "usr AS user_pseudo_id, us AS event_timestamp"
PLACE_MAX = "CASE WHEN k % 6 = 0 THEN 'q' || (k % 5) ELSE 'p' || (k % 7) END"
ARM_MAX = "CASE WHEN k % 24 = 1 THEN 'zz' ELSE arm END"

USER_DAY = "SELECT usr, d, " + ", ".join(
    [
        f"COUNT(*) FILTER ({c}) AS {p}_imps, COALESCE(SUM(val) FILTER ({c}), 0.0) AS {p}_rev, "
        f"CAST(COUNT(*) FILTER ({c}) > 0 AS INTEGER) AS {p}_seen"
        for p, c in {"total": "TRUE", **{p: f"grp = '{g}'" for p, g in FMT.items()}}.items()
    ]
) + " FROM e WHERE ev = 'ad_impression' GROUP BY usr, d"


def cohort(where: str = "TRUE", extra: str = "", event: str = "first_open") -> str:
    return (
        f"c AS (SELECT usr, ver{extra}, MIN(d) AS j FROM e WHERE ev = '{event}' AND {where} "
        f"GROUP BY usr, ver{extra})"
    )


OUTSIDE = "geo <> 'China'"

STARTS = "s AS (SELECT DISTINCT usr, mg, us FROM e WHERE ev = 'level_start' AND mg <> 'Home')"
# Members find their session by an as-of join on the latest start.
MEMBERS = """
m AS (SELECT b.usr, b.scr AS mg, s.us AS start_us, b.us, b.ev, b.val
  FROM (SELECT * FROM e WHERE scr <> 'Home') b ASOF JOIN s
    ON b.usr = s.usr AND b.scr = s.mg AND b.us >= s.us),
t AS (SELECT usr, mg, start_us, MAX(us) AS last_us, COUNT(*) AS members,
    COUNT(*) FILTER (ev = 'ad_impression') AS imps,
    COALESCE(SUM(val) FILTER (ev = 'ad_impression'), 0.0) AS rev
  FROM m GROUP BY usr, mg, start_us)"""

# --- reports ---------------------------------------------------------------


def retention(days, rolling: bool = False, dims: str = "ver", names: str = "ver AS version",
              where: str = "TRUE") -> str:
    op = ">=" if rolling else "="
    last = max(days)
    extra = dims.replace("ver, ", ", ") if dims != "ver" else ""
    cols = ", ".join(
        f"CASE WHEN COUNT(n) > 0 THEN ROUND(COUNT(DISTINCT usr) FILTER (n {op} {x}) "
        f"/ CAST(COUNT(DISTINCT usr) AS DOUBLE) * 100, 2) END AS d{x}_retention"
        for x in days
    )
    null_dim = " AND geo IS NOT NULL" if "geo" in dims else ""
    return sql(
        f"SELECT {names}, {iso('j')} AS cohort_date, COUNT(DISTINCT usr) AS new_users, {cols}, "
        f"date_diff('day', j, DATE '2024-01-31') >= {last} AS is_d{last}_mature "
        f"FROM x GROUP BY {dims}, j",
        f"{cohort(where, extra)}, "
        "a AS (SELECT DISTINCT usr, d FROM e WHERE ev = 'session_start'), "
        "x AS (SELECT c.*, date_diff('day', c.j, a.d) AS n FROM c LEFT JOIN a ON a.usr = c.usr "
        f"AND date_diff('day', c.j, a.d) BETWEEN 1 AND {1000000 if rolling else last}{null_dim})",
    )


def revenue_ctes(where: str, last: int, extra: str = "", fan: bool = True, event: str = "ad_impression") -> str:
    # Compat rule: an impression counts once per cohort row of its user.
    spread = "JOIN c o ON o.usr = e.usr" if fan else "SEMI JOIN c o ON o.usr = e.usr"
    return (
        f"{cohort(where, extra)}, "
        f"r AS (SELECT e.usr, e.d, e.val FROM e {spread} WHERE e.ev = '{event}'), "
        "y AS (SELECT c.*, date_diff('day', c.j, r.d) AS n, r.val FROM c LEFT JOIN r "
        f"ON r.usr = c.usr AND date_diff('day', c.j, r.d) BETWEEN 0 AND {last})"
    )


def ltv(horizons, where: str = OUTSIDE, dims: str = "ver", names: str = "ver AS version",
        fan: bool = True, base: str = PLAIN, event: str = "ad_impression") -> str:
    last = max(horizons)
    extra = dims.replace("ver, ", ", ") if dims != "ver" else ""
    cols = ", ".join(
        f"ROUND(SUM(CASE WHEN n BETWEEN 0 AND {h} THEN val ELSE 0.0 END) / COUNT(DISTINCT usr), 6) AS ltv_d{h}"
        for h in horizons
    )
    return sql(
        f"SELECT {names}, {iso('j')} AS cohort_date, COUNT(DISTINCT usr) AS new_users, {cols}, "
        f"date_diff('day', j, DATE '2024-01-31') >= {last} AS is_d{last}_mature "
        f"FROM y GROUP BY {dims}, j",
        revenue_ctes(where, last, extra, fan, event),
        base,
    )


def funnel(event: str = "first_open", where: str = OUTSIDE, native: bool = False) -> str:
    fmt = {**FMT, "native": "NATIVE"} if native else FMT
    grp = "CASE WHEN fmt = 'native' THEN 'NATIVE' ELSE grp END" if native else "grp"
    shown = {"total": "g IS NOT NULL", **{p: f"g = '{n}'" for p, n in fmt.items()}}
    day_cols = ", ".join(
        f"CAST(COUNT(g) FILTER ({c}) AS DOUBLE) AS {p}_imps, COALESCE(SUM(val) FILTER ({c}), 0.0) AS {p}_rev, "
        f"CAST(COUNT(DISTINCT usr) FILTER ({c}) AS DOUBLE) AS {p}_seen"
        for p, c in shown.items()
    )
    digits = {"reward": 3}
    out = [
        f"ROUND(AVG({p}_imps / dau), {digits.get(p, 2)}) AS {p}_imp_per_dau" for p in shown
    ] + [
        f"ROUND(AVG({p}_seen * 100.0::DOUBLE / dau), 2) AS "
        + ("ad_viewer_rate" if p == "total" else f"{p}_viewer_rate")
        for p in shown
    ] + [
        f"ROUND(SUM({p}_rev) / NULLIF(SUM({p}_imps), 0) * 1000, 4) AS "
        + ("ecpm" if p == "total" else f"{p}_ecpm")
        for p in shown
    ]
    lt = ", ".join(
        f"SUM(CASE WHEN n BETWEEN 0 AND {h} THEN val ELSE 0.0 END) / COUNT(DISTINCT usr) AS l{h}"
        for h in (0, 3, 7)
    )
    ctes = revenue_ctes(where, 7).replace(
        "ev = 'first_open'", f"ev = '{event}'"
    )
    return sql(
        f"SELECT w.ver AS version, {iso('MIN(w.d)')} AS date_from, {iso('MAX(w.d)')} AS date_to, "
        "COUNT(*) AS num_days, ROUND(AVG(dau), 1) AS avg_dau, ROUND(AVG(fresh), 1) AS avg_new_users, "
        + ", ".join(out)
        + ", ROUND(AVG(total_rev / dau), 6) AS arpdau, "
        + ", ".join(f"(SELECT ROUND(AVG(l{h}), 6) FROM l WHERE l.ver = w.ver) AS ltv_d{h}" for h in (0, 3, 7))
        + " FROM w GROUP BY w.ver",
        f"{ctes}, a AS (SELECT DISTINCT usr, ver, d FROM e WHERE ev = 'session_start'), "
        f"w AS (SELECT a.ver, a.d, CAST(COUNT(DISTINCT a.usr) AS DOUBLE) AS dau, "
        "CAST(COUNT(DISTINCT a.usr) FILTER (j = a.d) AS DOUBLE) AS fresh, "
        + day_cols.replace("DISTINCT usr", "DISTINCT a.usr")
        + " FROM a JOIN c ON c.usr = a.usr AND c.ver = a.ver LEFT JOIN "
        f"(SELECT usr, d, val, {grp} AS g FROM e WHERE ev = 'ad_impression') i "
        "ON i.usr = a.usr AND i.d = a.d GROUP BY a.ver, a.d), "
        f"l AS (SELECT ver, j, {lt} FROM y GROUP BY ver, j)",
    )


def daily(join_event: str = "first_open", active: str = "session_start", by_version: bool = False,
          cohort_only: bool = True, base: str = PLAIN, listed: str = "TRUE") -> str:
    dim = "ver, " if by_version else ""
    same = " AND q.ver = p.ver" if by_version else ""
    shown = {**{p: f"grp = '{g}'" for p, g in FMT.items()}, "total": "grp IS NOT NULL"}
    digits = {"reward": 3}
    rate = lambda p: "total_ad_viewer_rate" if p == "total" else f"{p}_viewer_rate"
    out = [
        f"ROUND(COUNT(*) FILTER ({c}) / dau, {digits.get(p, 2)}) AS {p}_imp_per_dau, "
        f"ROUND(COUNT(DISTINCT usr) FILTER ({c}) * 100.0::DOUBLE / dau, 2) AS {rate(p)}"
        for p, c in shown.items()
    ] + [
        # An impression without a value counts as 0 here.
        f"ROUND(SUM(COALESCE(val, 0.0)) FILTER ({c}) / COUNT(*) FILTER ({c}) * 1000, 4) AS {p}_ecpm"
        for p, c in shown.items()
        if p != "total"
    ]
    return sql(
        f"SELECT {'g.ver AS version, ' if by_version else ''}{iso('g.d')} AS date, g.n AS active_user, "
        + ", ".join(f"h.{x}" for p in shown for x in (f"{p}_imp_per_dau", rate(p)))
        + ", " + ", ".join(f"h.{p}_ecpm" for p in FMT)
        + ", h.arpdau, ROUND(g.back * 100.0::DOUBLE / NULLIF((SELECT q.joined FROM g q WHERE q.d = g.d - 1"
        + (" AND q.ver = g.ver" if by_version else "")
        + "), 0), 2) AS cohort_rr_d1 FROM g JOIN h USING (" + dim + "d)",
        f"uv AS (SELECT * FROM (SELECT usr, MIN(ver) AS ver FROM e WHERE ev = 'first_open' GROUP BY usr) WHERE {listed}), "
        f"uj AS (SELECT usr, MIN(d) AS j FROM e WHERE ev = '{join_event}' AND {listed} GROUP BY usr), "
        # All active users: whoever has a session, wherever the version and the join date come from.
        f"p AS (SELECT DISTINCT e.usr, e.d, uv.ver, uj.j FROM e {'JOIN' if cohort_only else 'LEFT JOIN'} uv USING (usr) "
        f"{'JOIN' if cohort_only else 'LEFT JOIN'} uj USING (usr) WHERE e.ev = '{active}'), "
        f"g AS (SELECT {dim}d, COUNT(*) AS n, COUNT(*) FILTER (d = j) AS joined, "
        f"COUNT(*) FILTER (d = j + 1) AS back FROM p GROUP BY {dim}d), "
        "z AS (SELECT p.usr, p.d, p.ver, i.grp, i.val, (SELECT CAST(COUNT(*) AS DOUBLE) FROM p q "
        f"WHERE q.d = p.d{same}) AS dau FROM p LEFT JOIN "
        "(SELECT usr, d, grp, val FROM e WHERE ev = 'ad_impression') i ON i.usr = p.usr AND i.d = p.d), "
        f"h AS (SELECT {dim}d, " + ", ".join(out)
        + f", ROUND(COALESCE(SUM(val), 0.0) / dau, 6) AS arpdau FROM z GROUP BY {dim}d, dau)",
        base,
    )


def minigame(cap: int, base: str = PLAIN, listed: str = "TRUE") -> str:
    return sql(
        "SELECT f.ver AS version, f.mg AS minigame_id, f.start_user, "
        "ROUND(f.start_user / CAST(f.total_user AS DOUBLE) * 100, 2) AS start_rate_pct, "
        "g.unique_users, g.total_sessions, ROUND(g.mins / g.unique_users, 2) AS avg_playtime_per_user_min, "
        "ROUND(g.mins / g.total_sessions, 2) AS avg_playtime_per_session_min, "
        "COALESCE(g.imps, 0) AS total_ad_impressions, ROUND(COALESCE(g.rev, 0.0), 2) AS total_revenue_usd, "
        "ROUND(g.rev / g.unique_users, 4) AS avg_revenue_per_user_usd, "
        f"ROUND(g.rev / NULLIF(g.imps, 0) * 1000, 2) AS ecpm FROM f LEFT JOIN g USING (ver, mg) WHERE {listed}",
        "uv AS (SELECT usr, MIN(ver) AS ver FROM e WHERE ev = 'session_start' GROUP BY usr), "
        f"{STARTS}, {MEMBERS}, "
        "f AS (SELECT a.ver, a.mg, COUNT(DISTINCT a.usr) AS start_user, ANY_VALUE(b.n) AS total_user FROM "
        "(SELECT uv.ver, e.usr, e.mg FROM e JOIN uv USING (usr) WHERE e.ev = 'level_start' AND e.mg <> 'Home') a "
        "JOIN (SELECT uv.ver, COUNT(DISTINCT usr) AS n FROM e JOIN uv USING (usr) WHERE e.ev = 'level_start' "
        "AND e.mg IS NOT NULL GROUP BY uv.ver) b USING (ver) GROUP BY a.ver, a.mg), "
        "g AS (SELECT uv.ver, mg, COUNT(DISTINCT usr) AS unique_users, COUNT(*) AS total_sessions, "
        "SUM(ROUND((last_us - start_us) / 1e6 / 60, 4)) AS mins, CAST(SUM(imps) AS BIGINT) AS imps, SUM(rev) AS rev "
        f"FROM t JOIN uv USING (usr) WHERE (last_us - start_us) / 1e6 / 60 <= {cap} GROUP BY uv.ver, mg)",
        base,
    )


def play(key: str = "mg", name: str = "minigame_id", where: str = "mg <> 'Home'", means: bool = False,
         base: str = PLAIN, listed: str = "TRUE", results=("win", "lose", "quit")) -> str:
    rates = ", ".join(
        f"ROUND(COUNT(*) FILTER (res = '{r}') * 100.0::DOUBLE / NULLIF(COUNT(res), 0), 2) AS {r}_rate_pct, "
        f"ROUND(SUM(secs) FILTER (res = '{r}') / NULLIF(COUNT(DISTINCT usr) FILTER (res = '{r}'), 0), 2) "
        f"AS avg_duration_{r}_s"
        for r in results
    )
    outs = ", ".join(f"n.{r}_rate_pct, n.avg_duration_{r}_s" for r in results)
    extra = (
        ", ROUND(AVG(CAST(k % 5 AS DOUBLE)), 2) AS avg_attempt, "
        "ROUND(AVG(CASE WHEN k % 9 <> 0 THEN CAST(k % 4 AS DOUBLE) END), 2) AS avg_deaths"
        if means
        else ""
    )
    return sql(
        f"SELECT b.ver AS version, b.g AS {name}, b.n AS users_start, n.users_end, "
        f"ROUND(n.users_end * 100.0::DOUBLE / b.n, 2) AS complete_rate_pct, n.avg_duration_per_user_s, {outs}"
        + (", n.avg_attempt, n.avg_deaths" if means else "")
        + " FROM b LEFT JOIN n USING (ver, g)",
        f"c AS (SELECT DISTINCT usr, ver FROM e WHERE ev = 'first_open' AND {listed}), "
        f"q AS (SELECT c.ver, e.usr, e.k, {key} AS g, e.ev, e.res, "
        "CASE WHEN dur <> 'bad' THEN CAST(dur AS DOUBLE) END AS secs FROM e JOIN c USING (usr) "
        f"WHERE e.ev IN ('level_start', 'level_end') AND {where}), "
        "b AS (SELECT ver, g, COUNT(DISTINCT usr) AS n FROM q WHERE ev = 'level_start' GROUP BY ver, g), "
        "n AS (SELECT ver, g, COUNT(DISTINCT usr) AS users_end, "
        f"ROUND(SUM(secs) / COUNT(DISTINCT usr), 2) AS avg_duration_per_user_s, {rates}{extra} "
        "FROM q WHERE ev = 'level_end' GROUP BY ver, g)",
        base,
    )


def parity(diff: bool = False) -> str:
    side = (
        "SELECT '{src}' AS src, ver AS version, COUNT(*) AS new_users, CAST(SUM(act) AS BIGINT) AS dau, "
        "CAST(SUM(imps) AS BIGINT) AS total_imps, ROUND(SUM(COALESCE({rev}, 0.0)), 6) AS total_rev, "
        "ROUND(SUM({rev}) / NULLIF(SUM(imps), 0) * 1000, 4) AS ecpm, "
        "ROUND(SUM(COALESCE({rev}, 0.0)) / COUNT(*), 6) AS ltv_d0 FROM n GROUP BY ver"
    )
    stacked = side.format(src="RAW", rev="rr") + " UNION ALL " + side.format(src="L2", rev="rt")
    ctes = (
        f"{cohort(OUTSIDE)}, n AS (SELECT c.usr, c.ver, "
        "CAST(EXISTS (SELECT 1 FROM e x WHERE x.ev = 'session_start' AND x.usr = c.usr AND x.ver = c.ver) AS INTEGER) AS act, "
        "(SELECT COUNT(*) FROM e x WHERE x.ev = 'ad_impression' AND x.usr = c.usr) AS imps, "
        "(SELECT SUM(val_real) FROM e x WHERE x.ev = 'ad_impression' AND x.usr = c.usr) AS rr, "
        "(SELECT SUM(val) FROM e x WHERE x.ev = 'ad_impression' AND x.usr = c.usr) AS rt FROM c)"
    )
    if not diff:
        return sql(stacked, ctes)
    figures = ("new_users", "dau", "total_imps", "total_rev", "ecpm", "ltv_d0")
    return sql(
        "SELECT b.version, "
        + ", ".join(f"CAST(ROUND(b.{f} - a.{f}, 6) AS {'BIGINT' if f in figures[:3] else 'DOUBLE'}) AS {f}_diff" for f in figures)
        + " FROM (SELECT * FROM p WHERE src = 'RAW') a JOIN (SELECT * FROM p WHERE src = 'L2') b USING (version)",
        f"{ctes}, p AS ({stacked})",
    )


# --- staging ---------------------------------------------------------------

PLAYING = "ev IN ('level_start', 'level_end')"
LOCAL_DAY = iso("CAST(ts + INTERVAL 7 HOUR AS DATE)")
OPENED = iso("CAST(make_timestamp((1701388800000 + (u % 60) * 43200000) * 1000) + INTERVAL 7 HOUR AS DATE)")
KEY = "md5(usr || CAST(us AS VARCHAR) || ev)"
_STAGE = {
    "surrogate_key": KEY,
    "event_timestamp": "us",
    "event_name": "ev",
    "user_pseudo_id": "usr",
    "platform": "CASE WHEN u % 2 = 0 THEN 'ANDROID' ELSE 'IOS' END",
    "app_version": "ver",
    "device_mobile_marketing_name": "'phone' || (u % 6)",
    "device_mobile_model_name": "'model' || (u % 6)",
    "device_operating_system_version": "CAST(10 + u % 4 AS VARCHAR)",
    "language": "'en'",
    "country": "geo",
    "city": "'city' || (u % 10)",
    "continent": "'Asia'",
    "current_level": "CASE WHEN k % 19 <> 0 THEN CAST(k AS BIGINT) END",
    "first_open_date": OPENED,
    "campaign": "'c' || (u % 5)",
    "adset": "CAST(NULL AS VARCHAR)",
    "firebase_exp": "CASE WHEN k % 24 = 1 THEN 'zz' ELSE arm_label END",
    "ga_session_id": "sid",
    "ga_session_number": "CAST(snum AS BIGINT)",
    "start_type": f"CASE WHEN {PLAYING} THEN 't' || (k % 3) END",
    "play_index": f"CASE WHEN {PLAYING} THEN CAST(k AS BIGINT) END",
    "lose_by": "CASE WHEN ev = 'level_end' THEN 'l' || (k % 6) END",
    "result_by": "res",
    "ad_format": "fmt",
    "ad_network": "CASE WHEN ev = 'ad_impression' THEN 'n' || (k % 4) END",
    "ad_duration": "CASE WHEN ev = 'ad_impression' THEN CAST(k % 31 AS BIGINT) END",
    "value": "val_real",
    "currency": "CASE WHEN ev = 'ad_impression' THEN 'USD' END",
    "event_value_in_usd": "CASE WHEN ev = 'ad_impression' THEN v END",
    "placement": PLACE_MAX,
    "feature_placement": "CAST(NULL AS VARCHAR)",
    "feature_name": "CAST(NULL AS VARCHAR)",
    "feature_duration": "CAST(NULL AS BIGINT)",
    "button_name": "CAST(NULL AS VARCHAR)",
    "button_placement": "CAST(NULL AS VARCHAR)",
    "ad_type": "CAST(NULL AS VARCHAR)",
    "ad_unit_name": "CAST(NULL AS VARCHAR)",
    "reason": "CAST(NULL AS VARCHAR)",
    "resource_type": "CAST(NULL AS VARCHAR)",
    "engagement_time_msec": "CAST(k * 100 AS BIGINT)",
    "resource_amount": "CAST(NULL AS BIGINT)",
}
STAGE_A = {
    **_STAGE,
    "event_date": LOCAL_DAY,
    "level": f"CASE WHEN {PLAYING} AND k % 19 <> 0 THEN CAST(k AS BIGINT) END",
    "play_duration": "CASE WHEN ev = 'level_end' AND k % 13 <> 0 AND k % 2 = 0 THEN CAST(k AS BIGINT) END",
    "ad_platform": "CASE WHEN ev = 'ad_impression' THEN 'pf' || (k % 3) END",
    "ad_source": "CASE WHEN ev = 'ad_impression' THEN 's' || (k % 2) END",
    "current_screen": "'up_' || scr",
    "action_sequence": "concat_ws('|', CASE WHEN k % 5 = 0 THEN 'one' || k END, CASE WHEN k % 3 = 0 THEN 'two' || k END)",
}
STAGE_B = {
    **_STAGE,
    "event_date": iso("d"),
    "advertising_id": "'ad' || u",
    "level": f"CASE WHEN {PLAYING} THEN CAST(k AS BIGINT) END",
    "play_duration": "CASE WHEN ev = 'level_end' THEN CAST(ROUND(k * 0.75::DOUBLE) AS BIGINT) END",
    "ad_platform": "CASE WHEN ev = 'ad_impression' THEN 'nn' || (k % 3) END",
    "current_screen": "'ep_' || scr",
    "action_sequence": "NULLIF(concat_ws('|', CASE WHEN k % 5 = 0 THEN 'one' || k END, "
    "CASE WHEN k % 2 = 0 THEN 'ten' || k END, CASE WHEN k % 3 = 0 THEN 'two' || k END), '')",
}
N_PARAMS = (
    "5 + CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END + CASE WHEN mg IS NOT NULL THEN 1 ELSE 0 END "
    f"+ CASE WHEN {PLAYING} THEN 4 ELSE 0 END + CASE WHEN ev = 'level_end' THEN 4 ELSE 0 END "
    "+ CASE WHEN res IS NOT NULL THEN 2 ELSE 0 END + CASE WHEN ev = 'ad_impression' THEN 8 ELSE 0 END "
    "+ CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END "
    "+ CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END"
)
BASE_NAMES = (
    "surrogate_key event_name event_timestamp event_date user_pseudo_id ga_session_number "
    "ga_session_id app_version device_mobile_marketing_name device_mobile_model_name "
    "device_operating_system_version advertising_id language country city continent "
    "first_open_date current_level campaign adset current_screen firebase_exp"
).split()


def staged(cols: dict[str, str], names=None, params: bool = False, where: str = "TRUE") -> str:
    picked = [n for n in (names or cols) if n in cols]
    out = ", ".join(f"{cols[n]} AS {n}" for n in picked)
    return sql(f"SELECT {out}{f', {N_PARAMS} AS params_n' if params else ''} FROM e WHERE {where}")
