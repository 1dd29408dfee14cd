"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written the plain relational way -- windows joined on day ranges, day grains
by GROUP BY, gaps by LAG over sorted rows, one aggregate per category in long
form and pivoted back -- and not with the bitmaps of the Spark engine, so the
two implementations check each other.

The fixture views turn the benchmark tables ``customer`` / ``events`` into the
four user logs (same mapping as ``dayloom.sources.logs``).  Ratios are
rounded to 6 decimals in both engines; counts are BIGINT, flags INT.
"""

from __future__ import annotations

# The three windows and the day weight table (window day d,
# step weight, cumulative weight W(d)); horizon caps W(2)=.75, W(4)=1.25,
# W(7)=1.625, W(9)=1.75.
WINDOWS_SQL = """windows AS (
  SELECT * FROM (VALUES (1, 1, 16, 0, TRUE), (2, 8, 23, 7, TRUE), (3, 15, 30, 14, FALSE))
    AS t(window_id, feat_begin, feat_end, slide, labelled)),
wt AS (
  SELECT d, CAST(sw AS DOUBLE) AS sw, CAST(cw AS DOUBLE) AS cw FROM (VALUES
    (0, 0.03125, 0), (1, 0.03125, 0.5), (2, 0.03125, 0.75), (3, 0.03125, 1),
    (4, 0.03125, 1.25), (5, 0.03125, 1.375), (6, 0.0625, 1.5), (7, 0.0625, 1.625),
    (8, 0.0625, 1.6875), (9, 0.0625, 1.75), (10, 0.125, 1.8125), (11, 0.125, 1.875),
    (12, 0.125, 1.90625), (13, 0.25, 1.9375), (14, 0.25, 1.96875), (15, 0.25, 2),
    (16, 0.5, 2.03125), (17, 0.03125, 2.0625)) AS t(d, sw, cw))"""
HORIZON_W = {2: 0.75, 4: 1.25, 7: 1.625, 9: 1.75}
HORIZONS = (2, 4, 7, 9)
N_REGISTER_TYPES = 12   # c_nationkey % 12 over the 25 nations
CATS = [f"page{j}" for j in range(5)] + [f"action_type{j}" for j in range(6)]

VIEWS_SQL = """user_register AS (
  SELECT c_custkey AS user_id, CAST(1 + (c_custkey * 7) % 30 AS INT) AS register_day,
         CAST(c_nationkey % 12 AS INT) AS register_type,
         CAST((c_custkey * 13) % 97 AS INT) AS device_type
  FROM customer),
month AS (
  SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INT) AS day
  FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'),
app_launch AS (
  SELECT user_id, day FROM month WHERE event_type = 'view'),
video_create AS (
  SELECT user_id, day FROM month WHERE event_type = 'purchase'),
user_activity AS (
  SELECT user_id, day,
         CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                              WHEN 'signup' THEN 3 ELSE 4 END AS INT) AS page,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS video_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 50 AS author_id,
         CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 6 AS INT) AS action_type
  FROM month)"""


def _h(alias: str, expr: str, agg: str = "SUM") -> str:
    return ",\n    ".join(f"{agg}({expr}) FILTER (WHERE {alias}.d >= {17 - i}) AS {{p}}{i}"
                           for i in HORIZONS)


def _horizon_aggs(alias: str, with_rows: bool) -> str:
    parts = []
    for i in HORIZONS:
        cond = f"{alias}.d >= {17 - i}"
        if with_rows:
            parts.append(f"SUM(n) FILTER (WHERE {cond}) AS r{i}")
            parts.append(f"SUM(wt.sw * n) FILTER (WHERE {cond}) AS wr{i}")
        parts.append(f"SUM(wt.sw) FILTER (WHERE {cond}) AS o{i}")
        parts.append(f"COUNT(*) FILTER (WHERE {cond}) AS nd{i}")
    return ",\n    ".join(parts)


def _flags(alias: str) -> str:
    return (f"MAX(CASE WHEN {alias}.d = 16 THEN 1 ELSE 0 END) * "
            f"MAX(CASE WHEN {alias}.d = 9 THEN 1 ELSE 0 END) AS cyc,\n    "
            f"MAX(CASE WHEN {alias}.d IN (13, 14) THEN 1 ELSE 0 END) * "
            f"MAX(CASE WHEN {alias}.d IN (6, 7) THEN 1 ELSE 0 END) AS wk")


def _cat_pivot() -> str:
    stats = ["rows_", "last_dist", "latest_n", "nmax", "nmin", "nmed", "nstd", "nvar",
             "nmean", "occ", "days"]
    cols = [f"MAX(CASE WHEN cat = '{c}' THEN {s} END) AS {c}_{s}" for c in CATS for s in stats]
    return ",\n    ".join(cols)


FEATURE_CTES = f"""{VIEWS_SQL},
{WINDOWS_SQL},
rt AS (
  SELECT register_type,
         CAST(ROW_NUMBER() OVER (ORDER BY CAST(register_type AS VARCHAR)) - 1 AS INT) AS ord
  FROM (SELECT DISTINCT register_type FROM user_register) x),
spine AS (
  SELECT w.window_id, r.user_id,
         CAST(LEAST(17 - (r.register_day - w.slide), 17) AS INT) AS age,
         r.device_type, rt.ord AS rt_ord, wt.cw AS wage
  FROM user_register r
  JOIN windows w ON r.register_day <= w.feat_end
  JOIN rt ON rt.register_type = r.register_type
  JOIN wt ON wt.d = LEAST(17 - (r.register_day - w.slide), 17)),
la AS (
  SELECT DISTINCT w.window_id, l.user_id, l.day - w.slide AS d
  FROM app_launch l JOIN windows w ON l.day BETWEEN w.feat_begin AND w.feat_end),
la_g AS (
  SELECT la.*, d - LAG(d) OVER (PARTITION BY window_id, user_id ORDER BY d) AS gap FROM la),
la_u AS (
  SELECT g.window_id, g.user_id, 17 - MAX(g.d) AS last_dist,
    MAX(gap) AS gmax, MIN(gap) AS gmin, AVG(gap) AS gmean, COUNT(*) AS days,
    {_horizon_aggs('g', with_rows=False)},
    SUM(wt.cw) AS occ, SUM(wt.sw) AS occ_step,
    {_flags('g')}
  FROM la_g g JOIN wt ON wt.d = g.d
  GROUP BY g.window_id, g.user_id),
la_pair AS (
  SELECT DISTINCT a.window_id, a.user_id
  FROM la a JOIN la b ON a.window_id = b.window_id AND a.user_id = b.user_id AND b.d = a.d - 7
  WHERE a.d BETWEEN 7 AND 16),
lab AS (
  SELECT DISTINCT w.window_id, l.user_id
  FROM app_launch l JOIN windows w ON w.labelled AND l.day BETWEEN w.feat_end + 1 AND w.feat_end + 7),
lab_any AS (
  SELECT DISTINCT w.window_id, x.user_id
  FROM (SELECT user_id, day FROM app_launch UNION ALL SELECT user_id, day FROM video_create
        UNION ALL SELECT user_id, day FROM user_activity) x
  JOIN windows w ON w.labelled AND x.day BETWEEN w.feat_end + 1 AND w.feat_end + 7),
cr_d AS (
  SELECT w.window_id, c.user_id, c.day - w.slide AS d, COUNT(*) AS n
  FROM video_create c JOIN windows w ON c.day BETWEEN w.feat_begin AND w.feat_end
  GROUP BY w.window_id, c.user_id, c.day - w.slide),
cr_g AS (
  SELECT cr_d.*, d - LAG(d) OVER (PARTITION BY window_id, user_id ORDER BY d) AS gap FROM cr_d),
cr_u AS (
  SELECT g.window_id, g.user_id, SUM(n) AS rows_, COUNT(*) AS days,
    MAX(n) AS nmax, MIN(n) AS nmin, AVG(n) AS nmean, arg_max(n, g.d) AS latest_n,
    17 - MAX(g.d) AS last_dist, MAX(gap) AS gmax, MIN(gap) AS gmin, AVG(gap) AS gmean,
    SUM(wt.sw * n) AS wrows, SUM(wt.sw) AS occ,
    {_horizon_aggs('g', with_rows=True)},
    {_flags('g')}
  FROM cr_g g JOIN wt ON wt.d = g.d
  GROUP BY g.window_id, g.user_id),
ac AS (
  SELECT w.window_id, a.user_id, a.day - w.slide AS d, a.page, a.video_id, a.author_id,
         a.action_type
  FROM user_activity a JOIN windows w ON a.day BETWEEN w.feat_begin AND w.feat_end),
ac_d AS (
  SELECT window_id, user_id, d, COUNT(*) AS n FROM ac GROUP BY window_id, user_id, d),
ac_u AS (
  SELECT g.window_id, g.user_id, SUM(n) AS rows_, COUNT(*) AS days,
    MAX(n) AS nmax, MIN(n) AS nmin, AVG(n) AS nmean, MEDIAN(n) AS nmed,
    STDDEV_SAMP(n) AS nstd, VAR_SAMP(n) AS nvar, 17 - MAX(g.d) AS last_dist,
    SUM(wt.sw * n) AS wrows, SUM(wt.sw) AS occ,
    {_horizon_aggs('g', with_rows=True)},
    {_flags('g')}
  FROM ac_d g JOIN wt ON wt.d = g.d
  GROUP BY g.window_id, g.user_id),
ac_rg AS (
  SELECT window_id, user_id, MAX(gap) AS gmax, MIN(gap) AS gmin, AVG(gap) AS gmean
  FROM (SELECT window_id, user_id,
               d - LAG(d) OVER (PARTITION BY window_id, user_id ORDER BY d) AS gap FROM ac) x
  GROUP BY window_id, user_id),
ac_cd AS (
  SELECT window_id, user_id, 'page' || CAST(page AS VARCHAR) AS cat, d, COUNT(*) AS n
  FROM ac GROUP BY window_id, user_id, page, d
  UNION ALL
  SELECT window_id, user_id, 'action_type' || CAST(action_type AS VARCHAR) AS cat, d, COUNT(*) AS n
  FROM ac GROUP BY window_id, user_id, action_type, d),
ac_c AS (
  SELECT c.window_id, c.user_id, c.cat, SUM(n) AS rows_, 17 - MAX(c.d) AS last_dist,
    arg_max(n, c.d) AS latest_n, MAX(n) AS nmax, MIN(n) AS nmin, MEDIAN(n) AS nmed,
    STDDEV_SAMP(n) AS nstd, VAR_SAMP(n) AS nvar, AVG(n) AS nmean, SUM(wt.sw) AS occ,
    COUNT(*) AS days
  FROM ac_cd c JOIN wt ON wt.d = c.d
  GROUP BY c.window_id, c.user_id, c.cat),
ac_cw AS (
  SELECT window_id, user_id,
    {_cat_pivot()}
  FROM ac_c GROUP BY window_id, user_id),
vid_s AS (
  SELECT v.window_id, v.user_id, v.video_id, SUM(wt.sw) AS s_all,
    {_h('v', 'wt.sw').format(p='s')}
  FROM (SELECT DISTINCT window_id, user_id, video_id, d FROM ac) v JOIN wt ON wt.d = v.d
  GROUP BY v.window_id, v.user_id, v.video_id),
vid_u AS (
  SELECT window_id, user_id, MAX(s_all) AS m_all, MAX(s2) AS m2, MAX(s4) AS m4,
         MAX(s7) AS m7, MAX(s9) AS m9
  FROM vid_s GROUP BY window_id, user_id),
aut_s AS (
  SELECT v.window_id, v.user_id, v.author_id, SUM(wt.sw) AS s_all,
    {_h('v', 'wt.sw').format(p='s')}
  FROM (SELECT DISTINCT window_id, user_id, author_id, d FROM ac) v JOIN wt ON wt.d = v.d
  GROUP BY v.window_id, v.user_id, v.author_id),
aut_u AS (
  SELECT window_id, user_id, MAX(s_all) AS m_all, MAX(s2) AS m2, MAX(s4) AS m4,
         MAX(s7) AS m7, MAX(s9) AS m9
  FROM aut_s GROUP BY window_id, user_id),
av AS (
  SELECT window_id, author_id, COUNT(*) AS views FROM ac GROUP BY window_id, author_id),
topa AS (
  SELECT window_id, author_id, views, rk FROM (
    SELECT av.*, ROW_NUMBER() OVER (PARTITION BY window_id ORDER BY views DESC, author_id ASC) AS rk
    FROM av) x
  WHERE rk <= 30),
attr AS (
  SELECT p.window_id, p.user_id, CAST(COUNT(DISTINCT p.author_id) AS DOUBLE) / 30 AS force
  FROM (SELECT DISTINCT window_id, user_id, author_id FROM ac) p
  JOIN topa t ON t.window_id = p.window_id AND t.author_id = p.author_id
  GROUP BY p.window_id, p.user_id),
isa AS (SELECT DISTINCT window_id, author_id AS user_id FROM ac)"""


def r6(expr: str) -> str:
    # half-even rounding to 6 decimals with the same double operations the
    # Spark side uses: rint(x * 1e6) / 1e6
    return (f"(ROUND_EVEN(CAST({expr} AS DOUBLE) * CAST(1000000 AS DOUBLE), 0)"
            f" / CAST(1000000 AS DOUBLE))")


def z(expr: str) -> str:
    return f"COALESCE({expr}, 0)"


def s17(expr: str) -> str:
    return f"COALESCE({expr}, 17)"


def cap(i: int) -> str:
    return f"LEAST(s.age, {i})"


def wcap(i: int) -> str:
    return f"LEAST(s.wage, {HORIZON_W[i]})"


def feature_select(mode: str = "as_computed") -> list[tuple[str, str]]:
    """(name, DuckDB expression) of every block feature, in table order."""
    intended = mode == "intended"
    f: list[tuple[str, str]] = []
    # launch
    f.append(("user_launch_last_day_distance", z("la_u.last_dist")))
    f += [("diff_day_max", s17("la_u.gmax")), ("diff_day_min", s17("la_u.gmin")),
          ("diff_day_mean", s17("la_u.gmean"))]
    for i in HORIZONS:
        raw = z(f"la_u.nd{i}")
        f.append((f"app_launch{i}_day_before_rate",
                  f"{raw} / {cap(i)}" if intended else raw))
    if intended:
        for i in HORIZONS:
            f.append((f"app_launch{i}_day_before_occupy", z(f"la_u.o{i} / {wcap(i)}")))
        f.append(("cycle_user", "CASE WHEN la_pair.user_id IS NULL THEN 0 ELSE 1 END"))
    else:
        f.append(("cycle_user", z("la_u.cyc")))
    f.append(("cycle_week_user", z("la_u.wk")))
    occ = "la_u.occ_step" if intended else "la_u.occ"
    f.append(("user_launch_date_occupied_avg", z(f"{occ} / s.wage")))
    # creation
    f += [("create_video_diff_day_max", s17("cr_u.gmax")),
          ("create_video_diff_day_min", s17("cr_u.gmin")),
          ("create_video_diff_day_mean", s17("cr_u.gmean")),
          ("user_video_create_latest_day_distance", s17("cr_u.last_dist")),
          ("user_video_create_latest_day_num", z("cr_u.latest_n")),
          ("user_video_create_day_max", z("cr_u.nmax")),
          ("user_video_create_day_min", z("cr_u.nmin")),
          ("user_video_create_day_mean", z("cr_u.nmean"))]
    for i in HORIZONS:
        f += [(f"video_create{i}_day_before_sum", z(f"cr_u.r{i} / {cap(i)}")),
              (f"video_create{i}_day_sum_weight", z(f"cr_u.wr{i} / {wcap(i)}")),
              (f"video_create{i}_day_occupy", z(f"cr_u.o{i} / {wcap(i)}")),
              (f"video_create{i}_num_day", z(f"cr_u.nd{i} / {cap(i)}"))]
    if intended:
        f.append(("cycle_user_create_video", "COALESCE(cr_pair.flag, 0)"))
    else:
        f.append(("cycle_user_create_video", z("cr_u.cyc")))
    f += [("user_week_both_create_video", z("cr_u.wk")),
          ("video_create_avg", z("cr_u.rows_ / s.age")),
          ("user_create_video_day_num_occupy", z("cr_u.days / s.age")),
          ("user_video_create_day_occupy_rate", z("cr_u.occ / s.wage")),
          ("weight_create_count_rate", z("cr_u.wrows / s.wage"))]
    # activity
    f += [("video_operate_times", z("ac_u.rows_ / s.age")),
          ("user_operate_video_weight", z("ac_u.wrows")),
          ("user_operate_video_day_max", z("ac_u.nmax")),
          ("user_operate_video_day_min", z("ac_u.nmin")),
          ("user_operate_video_day_mean", z("ac_u.nmean")),
          ("user_operate_video_day_median", z("ac_u.nmed")),
          ("user_operate_video_day_std", z("ac_u.nstd")),
          ("user_operate_video_day_var", z("ac_u.nvar")),
          ("operate_video_distance_day", s17("ac_u.last_dist")),
          ("operate_video_day_occupy", z("ac_u.occ / s.wage")),
          ("user_operate_video_day_num", z("ac_u.days / s.age")),
          ("weight_user_view_video_weight", z("vid_u.m_all")),
          ("user_view_same_author_weight", z("aut_u.m_all"))]
    for c in CATS:
        p = f"ac_cw.{c}"
        f += [(f"user_operate_{c}_sum", z(f"{p}_rows_ / s.age")),
              (f"day_distance_to_operate_{c}", s17(f"{p}_last_dist")),
              (f"last_day_operate_{c}_times", z(f"{p}_latest_n")),
              (f"user_operated_{c}_day_max", z(f"{p}_nmax"))]
        if intended:
            f.append((f"user_operated_{c}_day_min", z(f"{p}_nmin")))
        f += [(f"user_operated_{c}_day_median", z(f"{p}_nmed")),
              (f"user_operated_{c}_day_std", z(f"{p}_nstd")),
              (f"user_operated_{c}_day_var", z(f"{p}_nvar")),
              (f"user_operated_{c}_day_mean", z(f"{p}_nmean")),
              (f"user_operate_{c}_occupy", z(f"{p}_occ / s.wage")),
              (f"user_operate_{c}_day_ocupy", z(f"{p}_days / s.age"))]
    for i in HORIZONS:
        f += [(f"weight_user_view_video_{i}_weight", z(f"vid_u.m{i}")),
              (f"user_view_same_author_{i}_weight", z(f"aut_u.m{i}")),
              (f"user_activity{i}_day_sum", z(f"ac_u.r{i} / {cap(i)}")),
              (f"user_activity{i}_day_sum_weight", z(f"ac_u.wr{i} / {wcap(i)}")),
              (f"user_activity{i}_day_occupy", z(f"ac_u.o{i} / {wcap(i)}")),
              (f"user_activity{i}_num_day", z(f"ac_u.nd{i} / {cap(i)}"))]
    f += [("user_activity_diff_day_max", s17("ac_rg.gmax")),
          ("user_activity_diff_day_min", s17("ac_rg.gmin")),
          ("user_activity_diff_day_mean", s17("ac_rg.gmean")),
          ("author_atttractive_force", z("attr.force"))]
    for i in HORIZONS:
        f += [(f"weight_user_view_video_{i}_weight_rete", z(f"vid_u.m{i} / {wcap(i)}")),
              (f"user_view_same_author_{i}_weight_rate", z(f"aut_u.m{i} / {wcap(i)}"))]
    f.append(("user_is_author", "CASE WHEN isa.user_id IS NULL THEN 0 ELSE 1 END"))
    if intended:
        f.append(("cycle_user_user_activity", "COALESCE(ac_pair.flag, 0)"))
    else:
        f.append(("cycle_user_user_activity", z("ac_u.cyc")))
    f.append(("user_week_both_user_activity", z("ac_u.wk")))
    return f


def _pair_cte(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT a.window_id, a.user_id, 1 AS flag
  FROM {src} a JOIN {src} b ON a.window_id = b.window_id AND a.user_id = b.user_id
   AND b.d = a.d - 7
  WHERE a.d BETWEEN 7 AND 16)"""


def feature_matrix_sql(mode: str = "as_computed", where: str = "",
                       round_values: bool = True) -> str:
    intended = mode == "intended"
    onehot = ",\n  ".join(f"CASE WHEN s.rt_ord = {k} THEN 1 ELSE 0 END AS register_type{k}"
                          for k in range(N_REGISTER_TYPES))
    fmt = r6 if round_values else (lambda e: f"CAST({e} AS DOUBLE)")
    feats = ",\n  ".join(f"{fmt(e)} AS {n}" for n, e in feature_select(mode))
    lab = "lab_any" if intended else "lab"
    extra_ctes = ""
    extra_joins = ""
    if intended:
        extra_ctes = ",\n" + _pair_cte("cr_pair", "cr_d") + ",\n" + _pair_cte("ac_pair", "ac_d")
        extra_joins = """
LEFT JOIN la_pair ON la_pair.window_id = s.window_id AND la_pair.user_id = s.user_id
LEFT JOIN cr_pair ON cr_pair.window_id = s.window_id AND cr_pair.user_id = s.user_id
LEFT JOIN ac_pair ON ac_pair.window_id = s.window_id AND ac_pair.user_id = s.user_id"""
    return f"""WITH {FEATURE_CTES}{extra_ctes}
SELECT s.window_id, s.user_id, s.age AS register_day_distance, s.device_type,
  {onehot},
  {feats},
  CAST(CASE WHEN s.window_id IN (1, 2) THEN
         CASE WHEN {lab}.user_id IS NULL THEN 0 ELSE 1 END END AS INT) AS label
FROM spine s
LEFT JOIN la_u ON la_u.window_id = s.window_id AND la_u.user_id = s.user_id
LEFT JOIN cr_u ON cr_u.window_id = s.window_id AND cr_u.user_id = s.user_id
LEFT JOIN ac_u ON ac_u.window_id = s.window_id AND ac_u.user_id = s.user_id
LEFT JOIN ac_rg ON ac_rg.window_id = s.window_id AND ac_rg.user_id = s.user_id
LEFT JOIN ac_cw ON ac_cw.window_id = s.window_id AND ac_cw.user_id = s.user_id
LEFT JOIN vid_u ON vid_u.window_id = s.window_id AND vid_u.user_id = s.user_id
LEFT JOIN aut_u ON aut_u.window_id = s.window_id AND aut_u.user_id = s.user_id
LEFT JOIN attr ON attr.window_id = s.window_id AND attr.user_id = s.user_id
LEFT JOIN isa ON isa.window_id = s.window_id AND isa.user_id = s.user_id
LEFT JOIN {lab} ON {lab}.window_id = s.window_id AND {lab}.user_id = s.user_id{extra_joins}
{where}"""


# --- per-operator oracles ------------------------------------------------------

def _with(body: str, extra: str = "") -> str:
    return f"WITH {FEATURE_CTES}{extra}\n{body}"


def register_spine_sql() -> str:
    onehot = ",\n  ".join(f"CASE WHEN s.rt_ord = {k} THEN 1 ELSE 0 END AS register_type{k}"
                          for k in range(N_REGISTER_TYPES))
    return _with(f"""SELECT s.window_id, s.user_id, s.age AS register_day_distance, s.device_type,
  {onehot},
  {r6('s.wage')} AS register_day_count
FROM spine s""")


def register_duplicates_sql() -> str:
    return """SELECT o_custkey AS user_id, CAST(COUNT(*) AS BIGINT) AS registrations
FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1"""


def launch_daily_distinct_sql() -> str:
    return _with("SELECT window_id, user_id, CAST(d AS INT) AS wday FROM la")


def launch_recency_weight_sql() -> str:
    return _with(f"""SELECT window_id, user_id, CAST(last_dist AS INT) AS user_launch_last_day_distance,
  {r6('occ')} AS user_launch_date_occupied, {r6('occ_step')} AS launch_step_weight,
  CAST(days AS BIGINT) AS launch_days
FROM la_u""")


def launch_gaps_sql() -> str:
    return _with(f"""SELECT window_id, user_id, {r6('gmax')} AS diff_day_max,
  {r6('gmin')} AS diff_day_min, {r6('gmean')} AS diff_day_mean FROM la_u""")


def horizon_counts_sql() -> str:
    cols = ", ".join(f"CAST(nd{i} AS BIGINT) AS app_launch{i}_day_before_rate" for i in HORIZONS)
    return _with(f"SELECT window_id, user_id, {cols} FROM la_u")


def create_gaps_sql() -> str:
    return _with(f"""SELECT window_id, user_id, {r6('gmax')} AS create_video_diff_day_max,
  {r6('gmin')} AS create_video_diff_day_min, {r6('gmean')} AS create_video_diff_day_mean
FROM cr_u""")


def create_day_rollup_sql() -> str:
    return _with(f"""SELECT window_id, user_id,
  CAST(rows_ AS BIGINT) AS video_create_times, CAST(days AS BIGINT) AS day_num_create_video,
  CAST(nmax AS BIGINT) AS user_video_create_day_max, CAST(nmin AS BIGINT) AS user_video_create_day_min,
  {r6('nmean')} AS user_video_create_day_mean,
  CAST(last_dist AS INT) AS user_video_create_latest_day_distance,
  CAST(latest_n AS BIGINT) AS user_video_create_latest_day_num,
  {r6('occ')} AS user_video_create_day_occupy, {r6('wrows')} AS weight_create_count
FROM cr_u""")


def activity_gaps_sql() -> str:
    return _with(f"""SELECT window_id, user_id, {r6('gmax')} AS user_activity_diff_day_max,
  {r6('gmin')} AS user_activity_diff_day_min, {r6('gmean')} AS user_activity_diff_day_mean
FROM ac_rg""")


def activity_day_stats_sql() -> str:
    return _with(f"""SELECT window_id, user_id,
  CAST(rows_ AS BIGINT) AS video_operate_times, CAST(days AS BIGINT) AS user_operate_video_day_num,
  CAST(nmax AS BIGINT) AS user_operate_video_day_max, CAST(nmin AS BIGINT) AS user_operate_video_day_min,
  {r6('nmean')} AS user_operate_video_day_mean, {r6('nmed')} AS user_operate_video_day_median,
  {r6('nstd')} AS user_operate_video_day_std, {r6('nvar')} AS user_operate_video_day_var,
  CAST(last_dist AS INT) AS operate_video_distance_day,
  {r6('wrows')} AS user_operate_video_weight, {r6('occ')} AS operate_video_day_occupy
FROM ac_u""")


def category_profile_sql(prefix: str) -> str:
    return _with(f"""SELECT window_id, user_id, cat AS category, CAST(rows_ AS BIGINT) AS rows,
  CAST(last_dist AS INT) AS last_day_distance, CAST(latest_n AS BIGINT) AS latest_n,
  CAST(nmax AS BIGINT) AS day_max, CAST(nmin AS BIGINT) AS day_min, {r6('nmed')} AS day_median,
  {r6('nstd')} AS day_std, {r6('nvar')} AS day_var, {r6('nmean')} AS day_mean,
  {r6('occ')} AS occupy, CAST(days AS BIGINT) AS active_days
FROM ac_c WHERE cat LIKE '{prefix}%'""")


def action_score_sql() -> str:
    return _with("""SELECT window_id, user_id,
  CAST(SUM(CASE WHEN action_type <= 3 THEN action_type + 1 ELSE action_type - 6 END) AS BIGINT)
    AS action_score
FROM ac GROUP BY window_id, user_id""")


def _flag_sql(kind: str) -> str:
    if kind == "pair":
        extra = (",\n" + _pair_cte("la_p", "la") + ",\n" + _pair_cte("cr_p", "cr_d")
                 + ",\n" + _pair_cte("ac_p", "ac_d"))
        return _with("""SELECT 'launch' AS log, window_id, user_id FROM la_p
UNION ALL SELECT 'create' AS log, window_id, user_id FROM cr_p
UNION ALL SELECT 'activity' AS log, window_id, user_id FROM ac_p""", extra)
    return _with(f"""SELECT 'launch' AS log, window_id, user_id FROM la_u WHERE {kind} = 1
UNION ALL SELECT 'create' AS log, window_id, user_id FROM cr_u WHERE {kind} = 1
UNION ALL SELECT 'activity' AS log, window_id, user_id FROM ac_u WHERE {kind} = 1""")


def _affinity_sql(src: str, full: str, horizon: str) -> str:
    cols = ", ".join(f"{r6(f'm{i}')} AS {horizon.format(i=i)}" for i in HORIZONS)
    return _with(f"SELECT window_id, user_id, {r6('m_all')} AS {full}, {cols} FROM {src}")


def top_authors_sql() -> str:
    return _with("""SELECT window_id, author_id, CAST(views AS BIGINT) AS views,
  CAST(rk AS INT) AS author_rank FROM topa""")


def author_attraction_sql() -> str:
    return _with(f"SELECT window_id, user_id, {r6('force')} AS author_atttractive_force FROM attr")


def user_top_author_set_sql() -> str:
    return _with("""SELECT p.window_id, p.user_id,
  string_agg(CAST(p.author_id AS VARCHAR), ',' ORDER BY p.author_id) AS top_authors_viewed
FROM (SELECT DISTINCT window_id, user_id, author_id FROM ac) p
JOIN topa t ON t.window_id = p.window_id AND t.author_id = p.author_id
GROUP BY p.window_id, p.user_id""")


def is_author_flag_sql() -> str:
    return _with("""SELECT s.window_id, s.user_id FROM spine s
JOIN isa ON isa.window_id = s.window_id AND isa.user_id = s.user_id""")


def label_sql(src: str) -> str:
    return _with(f"SELECT window_id, user_id, 1 AS label FROM {src}")


def normalized_horizons_sql() -> str:
    names = ([f"video_create{i}_{s}" for i in HORIZONS
              for s in ("day_before_sum", "day_sum_weight", "day_occupy", "num_day")]
             + [f"user_activity{i}_{s}" for i in HORIZONS
                for s in ("day_sum", "day_sum_weight", "day_occupy", "num_day")]
             + [f"weight_user_view_video_{i}_weight_rete" for i in HORIZONS]
             + [f"user_view_same_author_{i}_weight_rate" for i in HORIZONS])
    return f"""WITH fm AS ({feature_matrix_sql()})
SELECT window_id, user_id, {', '.join(names)} FROM fm"""


def feature_profile_sql() -> str:
    return f"""WITH fm AS ({feature_matrix_sql(round_values=False)}),
casted AS (SELECT CAST(COLUMNS(* EXCLUDE (window_id, user_id)) AS DOUBLE) FROM fm),
long AS (UNPIVOT casted ON COLUMNS(*) INTO NAME feature VALUE value)
SELECT feature,
  CASE WHEN feature IN ('register_day_distance', 'device_type', 'label') OR feature SIMILAR TO 'register_type[0-9]+'
       THEN 'int' ELSE 'double' END AS dtype,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM fm) AS n_rows, CAST(COUNT(value) AS BIGINT) AS non_null,
  {r6('CAST(SUM(CAST(value AS DECIMAL(38, 12))) AS DOUBLE) / COUNT(value)')} AS mean,
  {r6('STDDEV_SAMP(value)')} AS std, {r6('MIN(value)')} AS min,
  {r6('QUANTILE_DISC(value, 0.25)')} AS q25, {r6('QUANTILE_DISC(value, 0.5)')} AS median,
  {r6('QUANTILE_DISC(value, 0.75)')} AS q75, {r6('MAX(value)')} AS max
FROM long GROUP BY feature"""


def weekly_windows_sql() -> str:
    """The feature matrix over eight windows a week apart, all labelled; their logs go to day 72."""
    standard = "(1, 1, 16, 0, TRUE), (2, 8, 23, 7, TRUE), (3, 15, 30, 14, FALSE)"
    weekly = ", ".join(f"({k + 1}, {1 + 7 * k}, {16 + 7 * k}, {7 * k}, TRUE)" for k in range(8))
    return feature_matrix_sql().replace(standard, weekly).replace(
        "CASE WHEN s.window_id IN (1, 2) THEN", "CASE WHEN TRUE THEN").replace("TIMESTAMP '2024-01-31'", "TIMESTAMP '2024-03-13'")


def auc_of_feature_sql() -> str:
    """Exact AUC by ranks: equal values share their mean rank."""
    return f"""WITH fm AS ({feature_matrix_sql()}),
ranked AS (
  SELECT window_id, label,
         RANK() OVER (PARTITION BY window_id ORDER BY video_operate_times)
         + (COUNT(*) OVER (PARTITION BY window_id, video_operate_times) - 1) / 2.0 AS r
  FROM fm WHERE label IS NOT NULL)
SELECT CAST(window_id AS INT) AS window_id,
  {r6("(SUM(CASE WHEN label = 1 THEN r ELSE 0 END) - SUM(label) * (SUM(label) + 1) / 2.0) / (SUM(label) * (COUNT(*) - SUM(label)))")} AS auc
FROM ranked GROUP BY window_id"""


def importance_check_sql() -> str:
    return f"""WITH fm AS ({feature_matrix_sql()}),
long AS (UNPIVOT (SELECT CAST(COLUMNS(* EXCLUDE (window_id, user_id, label)) AS DOUBLE) FROM fm LIMIT 1)
         ON COLUMNS(*) INTO NAME feature VALUE value)
SELECT feature, TRUE AS valid FROM long"""


def score_check_sql() -> str:
    return _with("SELECT CAST(user_id AS BIGINT) AS user_id, TRUE AS valid FROM spine WHERE window_id = 3")


def final_node_check_sql() -> str:
    """No fault of any kind, no tree missing."""
    return """SELECT unnest(['rows', 'grad', 'hess', 'gain', 'depth', 'least', 'children', 'value', 'root', 'missing trees']) AS fault, 0::BIGINT AS n"""


def all_sql() -> dict[str, str]:
    return {
        "register_spine": register_spine_sql(),
        "register_duplicates": register_duplicates_sql(),
        "launch_daily_distinct": launch_daily_distinct_sql(),
        "launch_recency_weight": launch_recency_weight_sql(),
        "launch_gaps": launch_gaps_sql(),
        "horizon_counts": horizon_counts_sql(),
        "create_gaps": create_gaps_sql(),
        "create_day_rollup": create_day_rollup_sql(),
        "activity_gaps": activity_gaps_sql(),
        "activity_day_stats": activity_day_stats_sql(),
        "page_profile": category_profile_sql("page"),
        "action_profile": category_profile_sql("action_type"),
        "action_score": action_score_sql(),
        "cycle_flags": _flag_sql("cyc"),
        "week_flags": _flag_sql("wk"),
        "cycle_flags_any_lag": _flag_sql("pair"),
        "item_affinity_video": _affinity_sql("vid_u", "weight_user_view_video_weight",
                                             "weight_user_view_video_{i}_weight"),
        "item_affinity_author": _affinity_sql("aut_u", "user_view_same_author_weight",
                                              "user_view_same_author_{i}_weight"),
        "top_authors": top_authors_sql(),
        "author_attraction": author_attraction_sql(),
        "user_top_author_set": user_top_author_set_sql(),
        "is_author_flag": is_author_flag_sql(),
        "label_launch": label_sql("lab"),
        "label_any_log": label_sql("lab_any"),
        "normalized_horizons": normalized_horizons_sql(),
        "feature_matrix_all_windows": feature_matrix_sql(),
        "feature_matrix_w1": feature_matrix_sql(where="WHERE s.window_id = 1"),
        "feature_matrix_intended": feature_matrix_sql(mode="intended"),
        "training_union": feature_matrix_sql(where="WHERE s.window_id IN (1, 2)"),
        "feature_profile": feature_profile_sql(),
        "csv_roundtrip": feature_matrix_sql(),
        "windows_roundtrip": feature_matrix_sql(),
        "tsv_feature_matrix": feature_matrix_sql(where="WHERE s.window_id = 1"),
        "incremental_windows": feature_matrix_sql(),
        "feature_matrix_bucketed": feature_matrix_sql(),
        "stored_window_launches": _with("SELECT window_id, user_id, CAST(d AS INT) AS wday FROM la WHERE window_id IN (1, 2)"),
        "user_author_lists": _with("SELECT DISTINCT window_id, user_id, author_id FROM ac WHERE author_id IS NOT NULL"),
        "weekly_windows": weekly_windows_sql(),
        "auc_of_feature": auc_of_feature_sql(),
        "importance_check": importance_check_sql(),
        "score_check": score_check_sql(),
        "final_node_check": final_node_check_sql(),
    }
