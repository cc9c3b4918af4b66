"""DuckDB oracle SQL, written from each operator's definition.

Each string runs on the driver's tables registered as views.  The fixture
SQL is shared text (it only builds the input); everything after it is an
independent formulation of the operator.  Doubles are rounded to 6 digits
and counts cast to BIGINT, matching the presentation of the Spark side.
"""

from __future__ import annotations

from cohortframe.sources.fixtures import fixture_sql

ORACLE: dict[str, str] = {}


def with_(*names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({fixture_sql(n)})" for n in names)


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


# columns of the cohort fixture by type (the oracle's own list)
NUMERIC = ["age", "academic_pressure", "work_pressure", "cgpa", "study_satisfaction",
           "job_satisfaction", "hours", "financial_stress"]
STRINGS_MODE = ["gender", "city", "cohort", "sleep_duration", "dietary_habits", "degree",
                "suicidal", "family_history"]
STUDENT_ONLY = ["academic_pressure", "study_satisfaction", "cgpa"]
PROF_ONLY = ["work_pressure", "job_satisfaction"]
ALL_COLS = ["id", "name", "gender", "age", "city", "cohort", "profession", "academic_pressure",
            "work_pressure", "cgpa", "study_satisfaction", "job_satisfaction", "sleep_duration",
            "dietary_habits", "degree", "suicidal", "hours", "financial_stress", "family_history",
            "label"]


def _mode_sql(src: str, col: str, where: str = "TRUE") -> str:
    return (f"(SELECT coalesce((SELECT v FROM (SELECT {col} AS v, count(*) AS n FROM {src} "
            f"WHERE {col} IS NOT NULL AND ({where}) GROUP BY {col}) ORDER BY n DESC, v ASC LIMIT 1), 'Unknown'))")


def _impute_stats_rows(src: str = "cohort") -> str:
    parts = []
    for c in STUDENT_ONLY:
        parts.append(f"SELECT 'impute' AS stage, '{c}' AS feature, 'Student' AS cohort, 'median' AS stat, "
                     f"median({c}) FILTER (WHERE cohort = 'Student') AS value, CAST(NULL AS VARCHAR) AS value_str FROM {src}")
    for c in PROF_ONLY:
        parts.append(f"SELECT 'impute', '{c}', 'Working Professional', 'median', "
                     f"median({c}) FILTER (WHERE cohort = 'Working Professional'), NULL FROM {src}")
    for c in NUMERIC:
        parts.append(f"SELECT 'impute', '{c}', 'all', 'median', median({c}), NULL FROM {src}")
    for c in STRINGS_MODE:
        parts.append(f"SELECT 'impute', '{c}', 'all', 'mode', CAST(NULL AS DOUBLE), {_mode_sql(src, c)}")
    parts.append("SELECT 'impute', 'profession', 'Working Professional', 'mode', CAST(NULL AS DOUBLE), "
                 + _mode_sql(src, "profession", "cohort = 'Working Professional'"))
    return "\nUNION ALL\n".join(parts)


ORACLE["impute_fit"] = with_("cohort") + f""",
stats AS ({_impute_stats_rows()})
SELECT stage, feature, cohort, stat, {r6('value')} AS value, value_str FROM stats
"""


def _impute_apply_select(src: str = "cohort", stats: str = "stats") -> str:
    def med(c, who):
        return f"(SELECT value FROM {stats} WHERE feature = '{c}' AND cohort = '{who}' AND stat = 'median')"

    def mode(c, who="all"):
        return f"(SELECT value_str FROM {stats} WHERE feature = '{c}' AND cohort = '{who}' AND stat = 'mode')"
    sel = []
    for c in ALL_COLS:
        if c == "profession":
            e = (f"CASE WHEN profession IS NULL AND cohort = 'Student' THEN 'Student' "
                 f"WHEN profession IS NULL AND cohort = 'Working Professional' THEN {mode('profession', 'Working Professional')} "
                 f"ELSE profession END")
        elif c in STUDENT_ONLY:
            e = f"CASE WHEN {c} IS NULL AND cohort = 'Student' THEN {med(c, 'Student')} ELSE {c} END"
        elif c in PROF_ONLY:
            e = f"CASE WHEN {c} IS NULL AND cohort = 'Working Professional' THEN {med(c, 'Working Professional')} ELSE {c} END"
        elif c in NUMERIC:
            e = f"coalesce({c}, {med(c, 'all')})"
        elif c in STRINGS_MODE:
            e = f"coalesce({c}, {mode(c)})"
        else:
            e = c
        if c in NUMERIC:
            e = r6(e)
        sel.append(f"{e} AS {c}")
    return "SELECT " + ",\n  ".join(sel) + f" FROM {src}"


ORACLE["impute_apply"] = with_("cohort") + f""",
stats AS ({_impute_stats_rows()})
{_impute_apply_select()}
"""


def _nan_mean(cols):
    n = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in cols)
    s = " + ".join(f"coalesce({c}, 0)" for c in cols)
    return f"(CASE WHEN ({n}) > 0 THEN ({s}) / ({n}) END)", n


def _stress_sql(src_cols=("academic_pressure", "work_pressure", "financial_stress")):
    mean, n = _nan_mean(src_cols)
    sq = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN ({c} - {mean}) * ({c} - {mean}) ELSE 0 END" for c in src_cols)
    return {
        "total_stress_index": mean,
        "max_stress": f"greatest({', '.join(src_cols)})",
        "stress_variance": f"(CASE WHEN ({n}) > 0 THEN ({sq}) / ({n}) END)",
        "stress_saturated": f"ln(1 + {mean})",
    }


ORACLE["feat_stress"] = with_("cohort") + """
SELECT id, {ap} AS academic_pressure, {wp} AS work_pressure, {fs} AS financial_stress,
""".format(ap=r6("academic_pressure"), wp=r6("work_pressure"), fs=r6("financial_stress")) + ",\n".join(
    f"{r6(e)} AS {k}" for k, e in _stress_sql().items()) + " FROM cohort"

ORACLE["pipeline_slice"] = with_("cohort") + f""",
stats AS ({_impute_stats_rows()}),
imputed AS ({_impute_apply_select()}),
feat AS (SELECT label, {_stress_sql()['total_stress_index']} AS tsi FROM imputed)
SELECT label, CAST(count(*) AS BIGINT) AS n, {r6('avg(tsi)')} AS avg_total_stress FROM feat GROUP BY label
"""


# ------------------------------------------------------------------ E

ORACLE["impute_structural_report"] = with_("cohort") + """
SELECT 'Student' AS cohort, f AS feature, CAST(n AS BIGINT) AS n_structural FROM (
  SELECT 'work_pressure' AS f, count(*) FILTER (WHERE cohort = 'Student' AND work_pressure IS NULL) AS n FROM cohort
  UNION ALL SELECT 'job_satisfaction', count(*) FILTER (WHERE cohort = 'Student' AND job_satisfaction IS NULL) FROM cohort
  UNION ALL SELECT 'profession', count(*) FILTER (WHERE cohort = 'Student' AND profession IS NULL) FROM cohort)
UNION ALL
SELECT 'Working Professional', f, CAST(n AS BIGINT) FROM (
  SELECT 'academic_pressure' AS f, count(*) FILTER (WHERE cohort = 'Working Professional' AND academic_pressure IS NULL) AS n FROM cohort
  UNION ALL SELECT 'study_satisfaction', count(*) FILTER (WHERE cohort = 'Working Professional' AND study_satisfaction IS NULL) FROM cohort
  UNION ALL SELECT 'cgpa', count(*) FILTER (WHERE cohort = 'Working Professional' AND cgpa IS NULL) FROM cohort)
"""

ORACLE["impute_zero_structural"] = with_("cohort") + """
SELECT id, cohort,
  CASE WHEN cohort = 'Working Professional' AND academic_pressure IS NULL THEN 0.0 ELSE academic_pressure END AS academic_pressure,
  CASE WHEN cohort = 'Working Professional' AND study_satisfaction IS NULL THEN 0.0 ELSE study_satisfaction END AS study_satisfaction,
  round(CASE WHEN cohort = 'Working Professional' AND cgpa IS NULL THEN 0.0 ELSE cgpa END, 6) AS cgpa,
  CASE WHEN cohort = 'Student' AND work_pressure IS NULL THEN 0.0 ELSE work_pressure END AS work_pressure,
  CASE WHEN cohort = 'Student' AND job_satisfaction IS NULL THEN 0.0 ELSE job_satisfaction END AS job_satisfaction
FROM cohort
"""

_CLIP_BOUNDS = """
b AS (SELECT
  greatest(quantile_cont(hours, 0.25) - 3 * (quantile_cont(hours, 0.75) - quantile_cont(hours, 0.25)), 0.0) AS h_lo,
  least(quantile_cont(hours, 0.75) + 3 * (quantile_cont(hours, 0.75) - quantile_cont(hours, 0.25)), 24.0) AS h_hi,
  greatest(quantile_cont(cgpa, 0.25) - 3 * (quantile_cont(cgpa, 0.75) - quantile_cont(cgpa, 0.25)), 0.0) AS c_lo,
  least(quantile_cont(cgpa, 0.75) + 3 * (quantile_cont(cgpa, 0.75) - quantile_cont(cgpa, 0.25)), 10.0) AS c_hi
  FROM cohort)"""

ORACLE["outlier_clip"] = with_("cohort") + "," + _CLIP_BOUNDS + """
SELECT id,
  round(CASE WHEN hours > h_hi THEN h_hi WHEN hours < h_lo THEN h_lo ELSE hours END, 6) AS hours,
  round(CASE WHEN cgpa > c_hi THEN c_hi WHEN cgpa < c_lo THEN c_lo ELSE cgpa END, 6) AS cgpa
FROM cohort, b
"""

ORACLE["outlier_clip_counts"] = with_("cohort") + "," + _CLIP_BOUNDS + """
SELECT 'cgpa' AS feature, CAST(count(*) FILTER (WHERE cgpa < c_lo OR cgpa > c_hi) AS BIGINT) AS n_clipped FROM cohort, b
UNION ALL
SELECT 'hours', CAST(count(*) FILTER (WHERE hours < h_lo OR hours > h_hi) AS BIGINT) FROM cohort, b
"""

_PROFILE8 = ["age", "academic_pressure", "work_pressure", "cgpa", "study_satisfaction", "job_satisfaction",
             "hours", "financial_stress"]

ORACLE["fill_for_model"] = with_("cohort") + ",\nm AS (SELECT " + ", ".join(
    f"median({c}) AS {c}" for c in _PROFILE8) + " FROM cohort)\nSELECT c.id, c.label, " + ", ".join(
    f"{r6(f'coalesce(c.{c}, m.{c})')} AS {c}" for c in _PROFILE8) + ", " + ", ".join(
    f"CAST(c.{c} IS NULL AS INTEGER) AS {c}__missing" for c in _PROFILE8) + " FROM cohort c, m"

# ------------------------------------------------------------------ B

_COHORT_TYPES = [("id", "bigint"), ("name", "string"), ("gender", "string"), ("age", "double"),
                 ("city", "string"), ("cohort", "string"), ("profession", "string"),
                 ("academic_pressure", "double"), ("work_pressure", "double"), ("cgpa", "double"),
                 ("study_satisfaction", "double"), ("job_satisfaction", "double"),
                 ("sleep_duration", "string"), ("dietary_habits", "string"), ("degree", "string"),
                 ("suicidal", "string"), ("hours", "double"), ("financial_stress", "double"),
                 ("family_history", "string"), ("label", "int")]

ORACLE["profile_columns"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS dtype, CAST(count({c}) AS BIGINT) AS non_null FROM cohort"
    for i, (c, t) in enumerate(_COHORT_TYPES))

_NUM_NO_ID_LABEL = ["age", "academic_pressure", "work_pressure", "cgpa", "study_satisfaction",
                    "job_satisfaction", "hours", "financial_stress"]

ORACLE["profile_describe"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS count, {r6(f'avg({c})')} AS mean, "
    f"{r6(f'stddev_samp({c})')} AS std, {r6(f'min({c})')} AS min, {r6(f'quantile_cont({c}, 0.25)')} AS p25, "
    f"{r6(f'quantile_cont({c}, 0.5)')} AS p50, {r6(f'quantile_cont({c}, 0.75)')} AS p75, {r6(f'max({c})')} AS max FROM cohort"
    for c in _NUM_NO_ID_LABEL)

ORACLE["profile_class_balance"] = with_("cohort") + """,
g AS (SELECT label, count(*) AS n FROM cohort GROUP BY label),
t AS (SELECT sum(n) AS tot, max(n) * 1.0 / min(n) AS ratio FROM g)
SELECT label, CAST(n AS BIGINT) AS n, round(n * 100.0 / tot, 6) AS pct, round(ratio, 6) AS imbalance_ratio,
       ratio > 1.5 AS imbalanced
FROM g, t
"""

_ALL20 = [c for c, _ in _COHORT_TYPES]


def _missing_sql(cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS m, count(*) AS n FROM cohort" for c in cols)


ORACLE["profile_missing"] = with_("cohort") + f""",
x AS ({_missing_sql(_ALL20)})
SELECT feature, CAST(m AS BIGINT) AS missing_count, round(m * 100.0 / n, 6) AS missing_pct FROM x WHERE m > 0
"""

_CORE = ["gender", "age", "sleep_duration", "dietary_habits", "suicidal", "hours", "financial_stress",
         "family_history"]

ORACLE["profile_missing_core"] = with_("cohort") + f""",
x AS ({_missing_sql(_CORE)})
SELECT feature, CAST(m AS BIGINT) AS missing_count, round(m * 100.0 / n, 6) AS missing_pct FROM x WHERE m > 0
"""

ORACLE["profile_missing_cohort"] = with_("cohort") + ",\nx AS (" + "\nUNION ALL\n".join(
    f"SELECT cohort, '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS m, count(*) AS n FROM cohort GROUP BY cohort"
    for c in _ALL20 if c not in ("id", "cohort")) + """)
SELECT cohort, feature, CAST(m AS BIGINT) AS n_missing, round(m * 100.0 / n, 6) AS pct_of_cohort,
  CASE WHEN cohort = 'Student' AND feature IN ('work_pressure', 'job_satisfaction', 'profession') THEN 'structural'
       WHEN cohort = 'Working Professional' AND feature IN ('academic_pressure', 'study_satisfaction', 'cgpa') THEN 'structural'
       ELSE 'anomalous' END AS kind
FROM x WHERE m > 0
"""

_STR_VC = ["gender", "city", "cohort", "profession", "sleep_duration", "dietary_habits", "degree", "suicidal",
           "family_history"]

ORACLE["profile_value_counts"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {c} AS value, CAST(count(*) AS BIGINT) AS n FROM cohort WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in _STR_VC)

_NUM_CORR = _NUM_NO_ID_LABEL + ["label"]


def _corr(a, b):
    return (f"CASE WHEN count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) >= 2 "
            f"AND stddev_pop({a}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) > 0 "
            f"AND stddev_pop({b}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) > 0 "
            f"THEN corr({a}, {b}) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) END")


ORACLE["profile_correlation"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(_corr(a, b))} AS corr FROM cohort"
    for a in _NUM_CORR for b in _NUM_CORR)

ORACLE["profile_target_corr"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature, {r6(_corr(a, 'label'))} AS corr FROM cohort" for a in _NUM_CORR)

ORACLE["profile_by_target"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    f"SELECT label, '{c}' AS feature, {r6(f'avg({c})')} AS mean, {r6(f'median({c})')} AS median, "
    f"{r6(f'stddev_samp({c})')} AS std FROM cohort GROUP BY label" for c in _PROFILE8)

ORACLE["profile_histogram"] = with_("cohort") + ",\nx AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, (SELECT min({c}) FROM cohort) AS lo, "
    f"(SELECT max({c}) FROM cohort) AS hi FROM cohort WHERE {c} IS NOT NULL" for c in _PROFILE8) + """),
y AS (SELECT feature, lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 0.0 END AS w,
        CASE WHEN hi > lo THEN CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INTEGER) ELSE 0 END AS bin FROM x),
b AS (SELECT DISTINCT feature, lo, w FROM y),
e AS (SELECT feature, lo, w, CAST(unnest(range(0, CASE WHEN w > 0 THEN 30 ELSE 1 END)) AS INTEGER) AS bin FROM b)
SELECT e.feature, e.bin, round(e.lo + e.bin * e.w, 6) AS bin_lo, round(e.lo + (e.bin + 1) * e.w, 6) AS bin_hi,
       CAST(count(y.bin) AS BIGINT) AS n FROM e LEFT JOIN y ON y.feature = e.feature AND y.bin = e.bin GROUP BY e.feature, e.bin, e.lo, e.w
"""

ORACLE["profile_box_stats"] = with_("cohort") + ",\nx AS (" + "\nUNION ALL\n".join(
    f"SELECT label, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM cohort" for c in _PROFILE8) + """),
q AS (SELECT label, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM x GROUP BY label, feature)
SELECT x.label, x.feature, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  CAST(count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM x JOIN q ON x.label = q.label AND x.feature = q.feature
GROUP BY x.label, x.feature, q1, med, q3
"""

ORACLE["profile_summary"] = with_("cohort") + f""",
x AS ({_missing_sql(_ALL20)}),
g AS (SELECT label, count(*) AS n FROM cohort GROUP BY label)
SELECT 'rows' AS metric, CAST((SELECT count(*) FROM cohort) AS DOUBLE) AS value
UNION ALL SELECT 'total_features', 18.0
UNION ALL SELECT 'categorical_features', 8.0
UNION ALL SELECT 'numerical_features', 8.0
UNION ALL SELECT 'total_missing', CAST((SELECT sum(m) FROM x) AS DOUBLE)
UNION ALL SELECT 'columns_with_missing', CAST((SELECT count(*) FROM x WHERE m > 0) AS DOUBLE)
UNION ALL SELECT 'class_' || CAST(label AS VARCHAR), CAST(n AS DOUBLE) FROM g
UNION ALL SELECT 'imbalance_ratio', round((SELECT max(n) * 1.0 / min(n) FROM g), 6)
"""

ORACLE["profile_cohort_rates"] = with_("cohort") + """
SELECT cohort, CAST(count(*) AS BIGINT) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM cohort), 6) AS share,
       round(avg(label), 6) AS target_rate
FROM cohort GROUP BY cohort
"""

# ------------------------------------------------------------------ C

ORACLE["clean_drop_columns"] = with_("cohort") + "\nSELECT " + ", ".join(
    r6(c) + f" AS {c}" if t == "double" else c for c, t in _COHORT_TYPES if c not in ("name", "city", "degree")) + " FROM cohort"

ORACLE["clean_sparse_rows"] = with_("cohort") + "\nSELECT id FROM cohort WHERE (" + " + ".join(
    f"CAST({c} IS NULL AS INTEGER)" for c in _ALL20) + ") / 20.0 < 0.2"

_ANOM = {
    "student_missing_cgpa": "cohort = 'Student' AND cgpa IS NULL",
    "professional_missing_profession": "cohort = 'Working Professional' AND profession IS NULL",
    "missing_financial_stress": "financial_stress IS NULL",
    "missing_dietary_habits": "dietary_habits IS NULL",
}

ORACLE["clean_anomalous_rows"] = with_("cohort") + "\nSELECT id FROM cohort WHERE NOT (" + " OR ".join(
    f"coalesce({v}, FALSE)" for v in _ANOM.values()) + ")"

ORACLE["clean_anomalous_counts"] = with_("cohort") + "\n" + "\nUNION ALL\n".join(
    [f"SELECT '{k}' AS reason, CAST(count(*) FILTER (WHERE {v}) AS BIGINT) AS n_rows FROM cohort" for k, v in _ANOM.items()]
    + ["SELECT 'removed_total', CAST(count(*) FILTER (WHERE " + " OR ".join(f"coalesce({v}, FALSE)" for v in _ANOM.values())
       + ") AS BIGINT) FROM cohort"])

ORACLE["clean_whitelist"] = with_("cohort") + """
SELECT id,
  CASE WHEN sleep_duration IN ('Less than 5 hours', '5-6 hours', '6-7 hours', '7-8 hours', 'More than 8 hours')
       THEN sleep_duration END AS sleep_duration,
  CASE WHEN dietary_habits IN ('Healthy', 'Moderate', 'Unhealthy') THEN dietary_habits END AS dietary_habits
FROM cohort
"""

_BAD_PROF = ["Class", "BSc", "MSc", "BA", "MA", "BBA", "MBA", "B.Com", "M.Com", "BCA", "MCA", "BE", "ME", "BTech",
             "MTech", "B.Tech", "M.Tech", "LLB", "LLM", "MD", "MBBS", "BDS", "PhD", "City", "Bhopal", "Indore",
             "Mumbai", "Delhi", "Bangalore", "Chennai", "Gender", "Male", "Female", "M", "F", "Age", "18", "19",
             "20", "21", "22", "23", "24", "25", "Family", "Father", "Mother", "Brother", "Sister", "Yuvraj",
             "Navya", "Kavya", "Rohan", "Priya", "Ananya", "Arjun", "Soham", "Aarav", "Vivaan", "Aditya", "Naina",
             "Ishaan", "Krishna", "Student", "Yes", "No", "None", "Unknown", "NA", "N/A"]


def _inlist(vals):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


ORACLE["clean_blacklist"] = with_("cohort") + f"""
SELECT id, CASE WHEN profession IN ({_inlist(_BAD_PROF)}) THEN NULL ELSE profession END AS profession FROM cohort
"""

_SUB_PAT = ["Class", "BSc", "MA", "BBA", "B.Com", "City", "Family", "Yuvraj", "Gender", "Age"]


def _rx_any(col):
    return " OR ".join(f"regexp_matches({col}, '(?i){p}')" for p in _SUB_PAT)


ORACLE["clean_substring_blacklist"] = with_("cohort") + f"""
SELECT id,
  CASE WHEN coalesce({_rx_any('profession')}, FALSE) THEN NULL ELSE profession END AS profession,
  CASE WHEN coalesce({_rx_any('degree')}, FALSE) THEN NULL ELSE degree END AS degree
FROM cohort
"""

_DEG_OK = ["Class", "BSc", "MSc", "BA", "MA", "B.", "M.", "PhD", "BBA", "MBA", "BCA", "MCA", "BE", "ME", "BTech",
           "MTech", "B.Tech", "M.Tech", "LLB", "LLM", "MD", "BHM", "MHM"]

ORACLE["clean_pattern_whitelist"] = with_("cohort") + """
SELECT id, CASE WHEN degree IS NULL OR """ + " OR ".join(f"contains(degree, '{p}')" for p in _DEG_OK) + \
    """ THEN degree END AS degree FROM cohort"""

ORACLE["prepare_features"] = ORACLE["clean_drop_columns"]

# ------------------------------------------------------------------ D


def _rank_sql(src, part, seed=55):
    over = f"PARTITION BY {part} " if part else ""
    return (f"row_number() OVER ({over}ORDER BY md5(CAST(id AS VARCHAR) || ':' || '{seed}'), id)")


def _quota_sql(src, val_size=0.2):
    return f"""cnt AS (SELECT label, count(*) AS n_c FROM {src} GROUP BY label),
tot AS (SELECT sum(n_c) AS n, CAST(ceil({val_size} * sum(n_c)) AS BIGINT) AS n_val FROM cnt),
fl AS (SELECT label, n_c, n_c * (n - n_val) / n AS cont, floor(n_c * (n - n_val) / n) AS f FROM cnt, tot),
need AS (SELECT (SELECT n - n_val FROM tot) - sum(f) AS k FROM fl),
ord AS (SELECT label, n_c, f, row_number() OVER (ORDER BY cont - f DESC, label) AS r FROM fl),
quota AS (SELECT label, n_c - (f + CASE WHEN r <= (SELECT k FROM need) THEN 1 ELSE 0 END) AS qv FROM ord)"""


ORACLE["split_stratified"] = with_("cohort") + f""",
{_quota_sql('cohort')},
rk AS (SELECT id, label, {_rank_sql('cohort', 'label')} AS rn FROM cohort)
SELECT rk.id, rk.label, CASE WHEN rn <= qv THEN 'val' ELSE 'train' END AS split
FROM rk JOIN quota ON rk.label = quota.label
"""

ORACLE["split_random"] = with_("cohort") + f""",
rk AS (SELECT id, {_rank_sql('cohort', None)} AS rn FROM cohort)
SELECT id, CASE WHEN rn <= (SELECT ceil(0.2 * count(*)) FROM cohort) THEN 'val' ELSE 'train' END AS split FROM rk
"""

ORACLE["folds_random"] = with_("cohort") + f"""
SELECT id, CAST(({_rank_sql('cohort', None)} - 1) % 5 AS INTEGER) AS fold FROM cohort
"""

_LABEL_GAPS = "g AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL ELSE label END AS label FROM cohort)"

ORACLE["folds_null_label"] = with_("cohort") + f""",
{_LABEL_GAPS}
SELECT id, label, CAST(({_rank_sql('g', 'label')} - 1) % 5 AS INTEGER) AS fold FROM g
"""

ORACLE["folds_stratified"] = with_("cohort") + f"""
SELECT id, label, CAST(({_rank_sql('cohort', 'label')} - 1) % 5 AS INTEGER) AS fold FROM cohort
"""

ORACLE["sample_exact"] = with_("cohort") + f"""
SELECT id, label FROM (SELECT id, label, {_rank_sql('cohort', None)} AS rn FROM cohort) WHERE rn <= 2000
"""


# ------------------------------------------------------------------ F

_ENC = """enc AS (SELECT * REPLACE (
  CAST(CASE sleep_duration WHEN 'Less than 5 hours' THEN 1 WHEN '5-6 hours' THEN 2 WHEN '6-7 hours' THEN 4
       WHEN '7-8 hours' THEN 5 WHEN 'More than 8 hours' THEN 2 END AS DOUBLE) AS sleep_duration,
  CAST(CASE dietary_habits WHEN 'Healthy' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Unhealthy' THEN 3 END AS DOUBLE) AS dietary_habits,
  CAST(CASE coalesce(suicidal, 'nan') WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 ELSE 2 END AS INTEGER) AS suicidal,
  CAST(CASE coalesce(family_history, 'nan') WHEN 'No' THEN 0 WHEN 'Yes' THEN 1 ELSE 2 END AS INTEGER) AS family_history)
  FROM cohort)"""

_ORD_ONLY = """SELECT id,
  CAST(CASE sleep_duration WHEN 'Less than 5 hours' THEN 1 WHEN '5-6 hours' THEN 2 WHEN '6-7 hours' THEN 4
       WHEN '7-8 hours' THEN 5 WHEN 'More than 8 hours' THEN 2 END AS DOUBLE) AS sleep_duration,
  CAST(CASE dietary_habits WHEN 'Healthy' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Unhealthy' THEN 3 END AS DOUBLE) AS dietary_habits
FROM cohort"""

ORACLE["encode_ordinal"] = with_("cohort") + "\n" + _ORD_ONLY

_LAB_COLS = ["gender", "cohort", "profession", "suicidal", "family_history"]
_LAB_INPUT = """lab_in AS (SELECT id, gender, age, cohort, profession, academic_pressure, work_pressure, cgpa,
  study_satisfaction, job_satisfaction,
  CAST(CASE sleep_duration WHEN 'Less than 5 hours' THEN 1 WHEN '5-6 hours' THEN 2 WHEN '6-7 hours' THEN 4
       WHEN '7-8 hours' THEN 5 WHEN 'More than 8 hours' THEN 2 END AS DOUBLE) AS sleep_duration,
  CAST(CASE dietary_habits WHEN 'Healthy' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Unhealthy' THEN 3 END AS DOUBLE) AS dietary_habits,
  suicidal, hours, financial_stress, family_history, label FROM cohort)"""


def _tok(c, expr=None):
    return f"coalesce({expr or c}, '{'Unknown' if c == 'profession' else 'nan'}')"


def _dict_ctes(src_where: str = "TRUE"):
    return ",\n".join(
        f"d_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS idx FROM "
        f"(SELECT DISTINCT {_tok(c)} AS v FROM lab_in WHERE {src_where}))" for c in _LAB_COLS)


def _label_select(unseen: bool):
    sel = []
    for c in ["id", "gender", "age", "cohort", "profession", "academic_pressure", "work_pressure", "cgpa",
              "study_satisfaction", "job_satisfaction", "sleep_duration", "dietary_habits", "suicidal", "hours",
              "financial_stress", "family_history", "label"]:
        if c in _LAB_COLS:
            if unseen:
                fb = (f"coalesce((SELECT idx FROM d_{c} WHERE v = 'Unknown'), "
                      f"(SELECT CAST(count(*) AS INTEGER) FROM d_{c}))")
                sel.append(f"coalesce((SELECT idx FROM d_{c} WHERE v = {_tok(c, 'x.' + c)}), {fb}) AS {c}")
            else:
                sel.append(f"(SELECT idx FROM d_{c} WHERE v = {_tok(c, 'x.' + c)}) AS {c}")
        elif c in ("id", "label"):
            sel.append(f"x.{c}")
        else:
            sel.append(f"{r6('x.' + c)} AS {c}")
    return "SELECT " + ", ".join(sel) + " FROM lab_in x"


ORACLE["encode_label"] = with_("cohort") + ",\n" + _LAB_INPUT + ",\n" + _dict_ctes() + "\n" + _label_select(False)
ORACLE["encode_label_unseen"] = with_("cohort") + ",\n" + _LAB_INPUT + ",\n" + _dict_ctes(
    "cohort = 'Student'") + "\n" + _label_select(True)
ORACLE["encode_label_dictionary"] = with_("cohort") + ",\n" + _LAB_INPUT + ",\n" + _dict_ctes() + "\n" + \
    "\nUNION ALL\n".join(f"SELECT 'label' AS stage, '{c}' AS feature, 'all' AS cohort, 'index' AS stat, "
                         f"CAST(idx AS DOUBLE) AS value, v AS value_str FROM d_{c}" for c in _LAB_COLS)

ORACLE["encode_target_fit"] = with_("cohort") + """,
g AS (SELECT avg(label) AS gm FROM cohort)
SELECT 'target' AS stage, 'profession' AS feature, 'all' AS cohort, 'mean' AS stat,
       round((sum(label) + gm * 10) / (count(*) + 10), 6) AS value, profession AS value_str
FROM cohort, g WHERE profession IS NOT NULL GROUP BY profession, gm
UNION ALL
SELECT 'target', 'profession', 'all', 'global', round(gm, 6), NULL FROM g
"""

ORACLE["encode_target_apply"] = with_("cohort") + """,
g AS (SELECT avg(label) AS gm FROM cohort WHERE cohort = 'Student'),
m AS (SELECT profession AS k, (sum(label) + (SELECT gm FROM g) * 10) / (count(*) + 10) AS te
      FROM cohort WHERE cohort = 'Student' AND profession IS NOT NULL GROUP BY profession)
SELECT c.id, c.cohort, c.profession, c.label, round(coalesce(m.te, (SELECT gm FROM g)), 6) AS profession_te
FROM cohort c LEFT JOIN m ON c.profession = m.k
"""

ORACLE["encode_target_oof"] = with_("cohort") + f""",
f AS (SELECT id, profession, label, CAST(({_rank_sql('cohort', None)} - 1) % 5 AS INTEGER) AS fold FROM cohort),
g AS (SELECT avg(label) AS gm FROM f),
pf AS (SELECT fold, profession, sum(label) AS s, count(*) AS n FROM f WHERE profession IS NOT NULL GROUP BY fold, profession),
tot AS (SELECT profession, sum(s) AS s, sum(n) AS n FROM pf GROUP BY profession),
oth AS (SELECT pf.fold, pf.profession, tot.s - pf.s AS os, tot.n - pf.n AS onn FROM pf JOIN tot USING (profession))
SELECT f.id, f.profession, f.label, f.fold,
  round(CASE WHEN oth.onn > 0 THEN (oth.os + (SELECT gm FROM g) * 10) / (oth.onn + 10) ELSE (SELECT gm FROM g) END, 6)
    AS profession_te
FROM f LEFT JOIN oth ON f.fold = oth.fold AND f.profession = oth.profession
"""

# ------------------------------------------------------------------ G

_NM_STRESS, _N_STRESS = _nan_mean(["academic_pressure", "work_pressure", "financial_stress"])
_NM_SAT, _ = _nan_mean(["study_satisfaction", "job_satisfaction"])
_S = _stress_sql()
_FEAT_CTES = f""",
{_ENC},
g1 AS (SELECT *, {_S['total_stress_index']} AS total_stress_index, {_S['max_stress']} AS max_stress,
   {_S['stress_variance']} AS stress_variance, {_S['stress_saturated']} AS stress_saturated FROM enc),
g2 AS (SELECT *, CASE WHEN hours + 1 <> 0 THEN 1.0 / (hours + 1) END AS work_life_balance,
   CAST(coalesce(hours >= 10, FALSE) AS INTEGER) AS overwork_flag, ln(1 + hours) AS hours_saturated,
   CAST(coalesce(sleep_duration = 5, FALSE) AS INTEGER) AS sleep_optimal,
   CAST(coalesce(sleep_duration = 1, FALSE) AS INTEGER) AS sleep_poor,
   CAST(coalesce(dietary_habits = 3, FALSE) AS INTEGER) AS diet_unhealthy,
   CAST(coalesce(dietary_habits = 0, FALSE) AS INTEGER) AS diet_healthy FROM g1),
g3 AS (SELECT *, {_NM_SAT} AS overall_satisfaction,
   CAST(coalesce({_NM_SAT} < 2.0 AND total_stress_index > 3.0, FALSE) AS INTEGER) AS low_satisfaction_high_stress,
   CAST(CAST(coalesce(cgpa >= (SELECT median(cgpa) FROM enc), FALSE) AS INTEGER) AS DOUBLE) AS high_achiever FROM g2),
g4 AS (SELECT *, suicidal + family_history + overwork_flag AS total_risk_factors,
   suicidal * family_history AS suicidal_family_risk, overwork_flag * total_stress_index AS overwork_high_stress,
   CAST(coalesce(age <= 30, FALSE) AS INTEGER) AS youth_risk FROM g3),
v1 AS (SELECT *, (academic_pressure + work_pressure + financial_stress) / 3.0 AS total_stress_index,
   CASE WHEN academic_pressure IS NULL OR work_pressure IS NULL OR financial_stress IS NULL THEN NULL
        ELSE greatest(academic_pressure, work_pressure, financial_stress) END AS max_stress,
   academic_pressure * hours AS academic_intensity, work_pressure * hours AS work_intensity FROM enc),
v1b AS (SELECT *, ((academic_pressure - total_stress_index) ^ 2 + (work_pressure - total_stress_index) ^ 2
   + (financial_stress - total_stress_index) ^ 2) / 3.0 AS stress_variance,
   CASE WHEN hours + 1 <> 0 THEN 1.0 / (hours + 1) END AS work_life_balance,
   CAST(coalesce(hours >= 10, FALSE) AS INTEGER) AS overwork_flag,
   (sleep_duration + dietary_habits) / 2.0 AS lifestyle_score,
   (study_satisfaction + job_satisfaction) / 2.0 AS overall_satisfaction FROM v1),
v1c AS (SELECT *, CASE WHEN total_stress_index + 1 <> 0 THEN (overall_satisfaction + 1) / (total_stress_index + 1) END
     AS satisfaction_stress_ratio,
   CAST(coalesce(cgpa >= (SELECT median(cgpa) FROM enc), FALSE) AS INTEGER) AS high_achiever,
   family_history * total_stress_index AS family_stress_interaction,
   CAST(coalesce(age <= 30, FALSE) AS INTEGER) AS youth_risk, age * total_stress_index AS age_stress_interaction,
   suicidal + family_history + overwork_flag AS total_risk_factors,
   academic_pressure * hours AS academic_pressure_x_hours, work_pressure * hours AS work_pressure_x_hours,
   financial_stress * hours AS financial_stress_x_hours, age * academic_pressure AS age_x_academic_pressure,
   age * work_pressure AS age_x_work_pressure, suicidal * total_stress_index AS suicidal_x_total_stress_index,
   pow(age, 2) AS age_pow2, pow(hours, 2) AS hours_pow2, pow(total_stress_index, 2) AS total_stress_index_pow2 FROM v1b)"""

_INT_OUT = {"id", "label", "suicidal", "family_history", "overwork_flag", "sleep_optimal", "sleep_poor",
            "diet_unhealthy", "diet_healthy", "low_satisfaction_high_stress", "total_risk_factors",
            "suicidal_family_risk", "youth_risk"}


def _sel(cols, src, ints=_INT_OUT):
    return "SELECT " + ", ".join(c if c in ints else f"{r6(c)} AS {c}" for c in cols) + f" FROM {src}"


_STRESS4 = ["total_stress_index", "max_stress", "stress_variance", "stress_saturated"]
_LIFE7 = ["work_life_balance", "overwork_flag", "hours_saturated", "sleep_optimal", "sleep_poor",
          "diet_unhealthy", "diet_healthy"]
_SAT3 = ["overall_satisfaction", "low_satisfaction_high_stress", "high_achiever"]
_RISK4 = ["total_risk_factors", "suicidal_family_risk", "overwork_high_stress", "youth_risk"]
_V1_STRESS = ["total_stress_index", "max_stress", "stress_variance", "academic_intensity", "work_intensity"]
_V1_LIFE = ["work_life_balance", "overwork_flag", "lifestyle_score"]
_V1_SAT = ["overall_satisfaction", "satisfaction_stress_ratio", "high_achiever"]
_V1_RISK = ["family_stress_interaction", "youth_risk", "age_stress_interaction", "total_risk_factors"]
_INTER = ["academic_pressure_x_hours", "work_pressure_x_hours", "financial_stress_x_hours",
          "age_x_academic_pressure", "age_x_work_pressure", "suicidal_x_total_stress_index"]
_POW = ["age_pow2", "hours_pow2", "total_stress_index_pow2"]

_G_BASE = with_("cohort") + _FEAT_CTES + "\n"
ORACLE["feat_lifestyle"] = _G_BASE + _sel(["id"] + _LIFE7, "g4")
ORACLE["feat_satisfaction"] = _G_BASE + _sel(["id"] + _STRESS4 + _SAT3, "g4")
ORACLE["feat_risk"] = _G_BASE + _sel(["id"] + _LIFE7 + _STRESS4 + _RISK4, "g4")
ORACLE["feat_stress_v1"] = _G_BASE + _sel(["id"] + _V1_STRESS, "v1c")
ORACLE["feat_lifestyle_v1"] = _G_BASE + _sel(["id"] + _V1_LIFE, "v1c")
ORACLE["feat_satisfaction_v1"] = _G_BASE + _sel(["id"] + _V1_STRESS + _V1_SAT, "v1c", _INT_OUT | {"high_achiever"})
ORACLE["feat_risk_v1"] = _G_BASE + _sel(["id"] + _V1_STRESS + _V1_LIFE + _V1_RISK, "v1c")
ORACLE["feat_interactions"] = _G_BASE.replace(
    "suicidal * total_stress_index AS suicidal_x_total_stress_index", "suicidal * total_stress_index AS sxt_v1") + \
    "SELECT id, " + ", ".join(f"{r6(c)} AS {c}" for c in _STRESS4) + ", " + ", ".join(
        f"{r6(c)} AS {c}" for c in _INTER[:5]) + ", " + r6("suicidal * total_stress_index") + \
    " AS suicidal_x_total_stress_index FROM (SELECT g4.*, v1c.academic_pressure_x_hours, v1c.work_pressure_x_hours, " \
    "v1c.financial_stress_x_hours, v1c.age_x_academic_pressure, v1c.age_x_work_pressure FROM g4 JOIN v1c USING (id))"
ORACLE["feat_powers"] = _G_BASE + "SELECT id, " + ", ".join(f"{r6(c)} AS {c}" for c in _STRESS4) + \
    ", " + r6("pow(age, 2)") + " AS age_pow2, " + r6("pow(hours, 2)") + " AS hours_pow2, " + \
    r6("pow(total_stress_index, 2)") + " AS total_stress_index_pow2 FROM g4"

_ENC_NUM = ["id", "age", "academic_pressure", "work_pressure", "cgpa", "study_satisfaction", "job_satisfaction",
            "sleep_duration", "dietary_habits", "suicidal", "hours", "financial_stress", "family_history", "label"]
_CUR = _STRESS4 + _LIFE7 + _SAT3 + _RISK4
ORACLE["feat_all"] = _G_BASE + "SELECT " + ", ".join(
    c if c in ("id", "label") else f"{r6(f'coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM g4))')} AS {c}"
    for c in _ENC_NUM + _CUR) + " FROM g4"
ORACLE["fill_inf_null"] = _G_BASE + "SELECT " + ", ".join(
    [c if c in ("id", "label") else f"{r6(f'coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM g4))')} AS {c}"
     for c in _ENC_NUM + _CUR] + ["name", "gender", "city", "cohort", "profession", "degree"]) + " FROM g4"
ORACLE["feat_all_v1"] = _G_BASE + _sel(_ENC_NUM + _V1_STRESS + _V1_LIFE + _V1_SAT + _V1_RISK + _INTER + _POW, "v1c",
                                       _INT_OUT | {"high_achiever"})
ORACLE["feat_none"] = _G_BASE + _sel(_ENC_NUM, "enc")

# ------------------------------------------------------------------ H

ORACLE["scale_standard"] = with_("cohort") + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in _PROFILE8) + \
    " FROM cohort)\nSELECT id, label, " + ", ".join(f"{r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _PROFILE8) + \
    " FROM cohort, st"

ORACLE["scale_robust"] = with_("cohort") + ",\nst AS (SELECT " + ", ".join(
    f"median({c}) AS m_{c}, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS s_{c}" for c in _PROFILE8) + \
    " FROM cohort)\nSELECT id, label, " + ", ".join(f"{r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in _PROFILE8) + \
    " FROM cohort, st"

ORACLE["feat_missing_indicator"] = with_("cohort") + "\nSELECT id, label, " + ", ".join(
    f"{r6(c)} AS {c}" for c in _PROFILE8) + ", " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}__missing" for c in _PROFILE8) + " FROM cohort"


# ------------------------------------------------------------------ J


def _counts(src, by, t="0.5"):
    return (f"SELECT {by}, count(*) FILTER (WHERE label = 0 AND score < {t}) AS tn, "
            f"count(*) FILTER (WHERE label = 0 AND score >= {t}) AS fp, "
            f"count(*) FILTER (WHERE label = 1 AND score < {t}) AS fn, "
            f"count(*) FILTER (WHERE label = 1 AND score >= {t}) AS tp FROM {src} GROUP BY {by}")


def _metrics(cols=True):
    m = ("round(CASE WHEN tp + tn + fp + fn = 0 THEN 0 ELSE (tp + tn) * 1.0 / (tp + tn + fp + fn) END, 6) AS accuracy, "
         "round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END, 6) AS precision, "
         "round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END, 6) AS recall, "
         "round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1")
    if cols:
        m = ("CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, "
             + m)
    return m


def _auc_rank(src, by):
    """Mann-Whitney form: average ranks (ties averaged) of the positives."""
    return f"""(SELECT {by}, (sum(ar) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
        * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / NULLIF(count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0), 0) AS auc
   FROM (SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY score)
                + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS ar FROM {src})
   GROUP BY {by})"""


ORACLE["eval_confusion"] = with_("scored") + f""",
c AS ({_counts('scored', 'model')})
SELECT model, 0 AS actual, 0 AS predicted, CAST(tn AS BIGINT) AS n FROM c
UNION ALL SELECT model, 0, 1, CAST(fp AS BIGINT) FROM c
UNION ALL SELECT model, 1, 0, CAST(fn AS BIGINT) FROM c
UNION ALL SELECT model, 1, 1, CAST(tp AS BIGINT) FROM c
"""

ORACLE["eval_basic"] = with_("scored") + f""",
c AS ({_counts('scored', 'model')})
SELECT model, {_metrics()} FROM c
"""

ORACLE["eval_auc"] = with_("scored") + f"\nSELECT model, round(auc, 6) AS auc FROM {_auc_rank('scored', 'model')}"

ORACLE["eval_class_report"] = with_("scored") + f""",
c AS ({_counts('scored', 'model')}),
p AS (SELECT model, tn, fp, fn, tp,
  CASE WHEN tn + fn = 0 THEN 0 ELSE tn * 1.0 / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0 ELSE tn * 1.0 / (tn + fp) END AS r0,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp * 1.0 / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0 ELSE tp * 1.0 / (tp + fn) END AS r1,
  tn + fp AS s0, tp + fn AS s1 FROM c),
q AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
               CASE WHEN p1 + r1 = 0 THEN 0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1, s0 + s1 AS n FROM p)
SELECT model, '0' AS class_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM q
UNION ALL SELECT model, '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM q
UNION ALL SELECT model, 'accuracy', NULL, NULL, round((tp + tn) * 1.0 / n, 6), CAST(n AS BIGINT) FROM q
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM q
UNION ALL SELECT model, 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
  round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM q
"""

_CURVE = """,
d AS (SELECT model, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY model, score),
c AS (SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
             sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
             sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N FROM d)"""

ORACLE["eval_roc"] = with_("scored") + _CURVE + """
SELECT model, round(score, 6) AS threshold, round(fp * 1.0 / N, 6) AS fpr, round(tp * 1.0 / P, 6) AS tpr FROM c
UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM scored
"""

ORACLE["eval_pr"] = with_("scored") + _CURVE + """
SELECT model, round(score, 6) AS threshold, round(tp * 1.0 / (tp + fp), 6) AS precision, round(tp * 1.0 / P, 6) AS recall FROM c
UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM scored
"""

_LL = "-avg(label * ln(least(greatest(score, 1e-15), 1 - 1e-15)) + (1 - label) * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15)))"

ORACLE["eval_logloss"] = with_("scored") + f"\nSELECT model, round({_LL}, 6) AS log_loss FROM scored GROUP BY model"

_MSETS = f""",
{_quota_sql('members')},
sp AS (SELECT m.*, CASE WHEN row_number() OVER (PARTITION BY m.label ORDER BY md5(CAST(m.id AS VARCHAR) || ':' || '55'), m.id)
       <= q.qv THEN 'Validation' ELSE 'Train' END AS dataset FROM members m JOIN quota q ON m.label = q.label),
ml AS (SELECT id, label, dataset, 'a' AS model, score_a AS score FROM sp
       UNION ALL SELECT id, label, dataset, 'b', score_b FROM sp
       UNION ALL SELECT id, label, dataset, 'c', score_c FROM sp),
cnt2 AS ({_counts('ml', 'model, dataset')}),
au AS {_auc_rank('ml', 'model, dataset')},
ll AS (SELECT model, dataset, {_LL} AS log_loss FROM ml GROUP BY model, dataset),
allm AS (SELECT cnt2.model, cnt2.dataset, {_metrics(False)}, round(au.auc, 6) AS auc, round(ll.log_loss, 6) AS log_loss
         FROM cnt2 JOIN au USING (model, dataset) JOIN ll USING (model, dataset))"""

ORACLE["eval_all"] = with_("members") + _MSETS + "\nSELECT * FROM allm"

ORACLE["eval_compare"] = with_("members") + _MSETS + "\n" + "\nUNION ALL\n".join(
    f"SELECT model, '{m}' AS metric, max({m}) FILTER (WHERE dataset = 'Train') AS \"Train\", "
    f"max({m}) FILTER (WHERE dataset = 'Validation') AS \"Validation\" FROM allm GROUP BY model"
    for m in ("accuracy", "auc", "f1", "precision", "recall"))

ORACLE["eval_best_model"] = with_("members") + _MSETS + """
SELECT model, f1, accuracy FROM allm WHERE dataset = 'Validation' ORDER BY f1 DESC, accuracy DESC, model LIMIT 1
"""


def _sweep(src, thresholds_sql):
    return f"""grid AS ({thresholds_sql}),
sw AS (SELECT s.model, grid.t AS threshold,
   count(*) FILTER (WHERE s.label = 1 AND s.score >= grid.t) AS tp,
   count(*) FILTER (WHERE s.label = 0 AND s.score >= grid.t) AS fp,
   count(*) FILTER (WHERE s.label = 1 AND s.score < grid.t) AS fn,
   count(*) FILTER (WHERE s.label = 0 AND s.score < grid.t) AS tn
   FROM {src} s, grid GROUP BY s.model, grid.t),
swm AS (SELECT model, threshold, {_metrics(False)} FROM sw)"""


_GRID = "SELECT CAST(k AS DOUBLE) / 100 AS t FROM range(10, 91) r(k)"
_BEST = """best AS (SELECT model, max(f1) AS best_score, min(threshold) FILTER (WHERE rk = 1) AS bt FROM
   (SELECT *, rank() OVER (PARTITION BY model ORDER BY f1 DESC) AS rk FROM swm) GROUP BY model),
bestt AS (SELECT model, CASE WHEN best_score > 0 THEN bt ELSE 0.5 END AS best_threshold,
   greatest(best_score, 0.0) AS best_score FROM best)"""

ORACLE["thr_sweep"] = with_("scored") + ",\n" + _sweep("scored", _GRID) + "\nSELECT * FROM swm"
ORACLE["thr_best"] = with_("scored") + ",\n" + _sweep("scored", _GRID) + ",\n" + _BEST + \
    "\nSELECT model, round(best_threshold, 6) AS best_threshold, round(best_score, 6) AS best_score FROM bestt"

ORACLE["thr_eval"] = with_("scored") + ",\n" + _sweep("scored", _GRID) + ",\n" + _BEST + f""",
ev AS (SELECT s.model, b.best_threshold AS threshold,
   count(*) FILTER (WHERE s.label = 1 AND s.score >= b.best_threshold) AS tp,
   count(*) FILTER (WHERE s.label = 0 AND s.score >= b.best_threshold) AS fp,
   count(*) FILTER (WHERE s.label = 1 AND s.score < b.best_threshold) AS fn,
   count(*) FILTER (WHERE s.label = 0 AND s.score < b.best_threshold) AS tn
   FROM scored s JOIN bestt b ON s.model = b.model GROUP BY s.model, b.best_threshold),
au AS {_auc_rank('scored', 'model')}
SELECT ev.model, round(threshold, 6) AS threshold, {_metrics(False)}, round(au.auc, 6) AS auc FROM ev JOIN au USING (model)
"""

ORACLE["thr_compare"] = with_("scored") + ",\n" + _sweep(
    "scored", "SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7]::DOUBLE[]) AS t") + "\nSELECT * FROM swm"

_MLONG = """,
ml AS (SELECT id, label, 'a' AS model, score_a AS score FROM members
       UNION ALL SELECT id, label, 'b', score_b FROM members
       UNION ALL SELECT id, label, 'c', score_c FROM members)"""

ORACLE["thr_all_models"] = with_("members") + _MLONG + ",\n" + _sweep("ml", _GRID) + ",\n" + _BEST + \
    "\nSELECT model, round(best_threshold, 6) AS best_threshold, round(best_score, 6) AS best_score FROM bestt"

# ------------------------------------------------------------------ I14-I16, A6, L

ORACLE["ensemble_average"] = with_("members") + """
SELECT id, label, round((score_a + score_b + score_c) / 3.0, 6) AS ensemble_score,
       CAST((score_a + score_b + score_c) / 3.0 >= 0.5 AS INTEGER) AS prediction FROM members
"""

_ENS_T = with_("members") + _MLONG + ",\n" + _sweep("ml", _GRID) + ",\n" + _BEST + """,
et AS (SELECT avg(coalesce(best_threshold, 0.5)) AS t FROM bestt),
pred AS (SELECT id, CAST((score_a + score_b + score_c) / 3.0 >= (SELECT t FROM et) AS INTEGER) AS prediction FROM members)"""

ORACLE["ensemble_threshold"] = _ENS_T + "\nSELECT round(t, 6) AS threshold FROM et"
ORACLE["predict_distribution"] = _ENS_T + """
SELECT prediction, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM pred), 6) AS pct
FROM pred GROUP BY prediction
"""
ORACLE["predict_submission"] = _ENS_T + "\nSELECT id, prediction AS label FROM pred"
ORACLE["validate_output"] = _ENS_T + """,
o AS (SELECT o_orderkey AS id FROM orders),
j AS (SELECT pred.id AS a, o.id AS b FROM pred FULL OUTER JOIN o ON pred.id = o.id),
k AS (SELECT (SELECT count(*) FROM pred) AS n_sub, (SELECT count(*) FROM o) AS n_sample,
             (SELECT count(*) FROM j WHERE a IS NULL OR b IS NULL) AS mism,
             (SELECT count(*) FROM (SELECT id FROM pred GROUP BY id HAVING count(*) > 1)) AS rep,
             (SELECT count(*) FROM pred WHERE prediction NOT IN (0, 1)) AS bad,
             (SELECT count(*) FROM pred WHERE id IS NULL OR prediction IS NULL) AS nul)
SELECT 'submission' AS file, 'columns' AS "check", TRUE AS passed, '[''id'', ''label''] vs [''id'', ''label'']' AS detail
UNION ALL SELECT 'submission', 'id_type', TRUE, 'warning only'
UNION ALL SELECT 'submission', 'row_count', n_sub = n_sample, CAST(n_sub AS VARCHAR) || ' vs ' || CAST(n_sample AS VARCHAR) FROM k
UNION ALL SELECT 'submission', 'ids', mism = 0, CAST(mism AS VARCHAR) || ' unmatched ids' FROM k
UNION ALL SELECT 'submission', 'unique_ids', rep = 0, CAST(rep AS VARCHAR) || ' repeated ids' FROM k
UNION ALL SELECT 'submission', 'binary_labels', bad = 0, CAST(bad AS VARCHAR) || ' values outside {0,1}' FROM k
UNION ALL SELECT 'submission', 'no_nulls', nul = 0, CAST(nul AS VARCHAR) || ' rows with NULL' FROM k
"""

ORACLE["validate_output_duplicates"] = """
WITH o AS (SELECT o_orderkey AS id FROM orders),
s AS (SELECT id FROM o UNION ALL SELECT id FROM o WHERE id % 10 = 0),
a AS (SELECT id, count(*) AS n FROM s GROUP BY id),
k AS (SELECT (SELECT count(*) FROM s) AS n_sub, (SELECT count(*) FROM o) AS n_sample, (SELECT sum(n - 1) FROM a) AS mism,
             (SELECT count(*) FROM a WHERE n > 1) AS rep)
SELECT 'submission' AS file, 'columns' AS "check", TRUE AS passed, '[''id'', ''label''] vs [''id'', ''label'']' AS detail
UNION ALL SELECT 'submission', 'id_type', TRUE, 'warning only'
UNION ALL SELECT 'submission', 'row_count', n_sub = n_sample, CAST(n_sub AS VARCHAR) || ' vs ' || CAST(n_sample AS VARCHAR) FROM k
UNION ALL SELECT 'submission', 'ids', mism = 0, CAST(CAST(mism AS BIGINT) AS VARCHAR) || ' unmatched ids' FROM k
UNION ALL SELECT 'submission', 'unique_ids', rep = 0, CAST(rep AS VARCHAR) || ' repeated ids' FROM k
UNION ALL SELECT 'submission', 'binary_labels', TRUE, '0 values outside {0,1}'
UNION ALL SELECT 'submission', 'no_nulls', TRUE, '0 rows with NULL'
"""

ORACLE["validate_many"] = _ENS_T + """
SELECT NOT EXISTS (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
         AND (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) = 0 AS all_passed,
       CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) = 0 THEN 0 ELSE 3 END AS n_failed
"""

ORACLE["stage_roundtrip"] = with_("cohort") + f""",
{_quota_sql('cohort')},
rk AS (SELECT id, label, age, hours, {_rank_sql('cohort', 'label')} AS rn FROM cohort)
SELECT rk.id, rk.label, round(age, 6) AS age, round(hours, 6) AS hours FROM rk JOIN quota ON rk.label = quota.label
WHERE rn <= qv
"""
ORACLE["params_roundtrip"] = ORACLE["impute_fit"]

# ------------------------------------------------------------------ K

_PHI = with_("cohort") + ",\nst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}, "
    f"median({c}) AS d_{c}, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS q_{c}" for c in _PROFILE8) + \
    " FROM cohort),\nphi AS (" + "\nUNION ALL\n".join(
        [f"SELECT id, cohort, 'standard' AS model, '{c}' AS feature, ({c} - m_{c}) / s_{c} AS phi FROM cohort, st "
         f"WHERE {c} IS NOT NULL" for c in _PROFILE8] +
        [f"SELECT id, cohort, 'robust', '{c}', ({c} - d_{c}) / q_{c} FROM cohort, st WHERE {c} IS NOT NULL"
         for c in _PROFILE8]) + "),\n" + """imp AS (SELECT model, feature, avg(abs(phi)) AS importance FROM phi GROUP BY model, feature),
ia AS (SELECT feature, avg(abs(phi)) AS importance FROM phi WHERE model = 'standard' AND cohort = 'Student' GROUP BY feature),
ib AS (SELECT feature, avg(abs(phi)) AS importance FROM phi WHERE model = 'standard' AND cohort = 'Working Professional' GROUP BY feature)"""

ORACLE["attr_importance"] = _PHI + """
SELECT model, feature, round(importance, 6) AS importance,
       CAST(row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM imp
"""
ORACLE["attr_ensemble"] = _PHI + """,
e AS (SELECT feature, avg(importance) AS importance FROM imp GROUP BY feature)
SELECT feature, round(importance, 6) AS importance,
       CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM e
"""
ORACLE["attr_dependence"] = _PHI + """
SELECT c.id, round(c.age, 6) AS value, round(p.phi, 6) AS phi FROM cohort c
JOIN phi p ON p.id = c.id AND p.model = 'standard' AND p.feature = 'age'
"""
ORACLE["select_top_n"] = _PHI + """,
top AS (SELECT feature FROM imp WHERE model = 'standard' ORDER BY importance DESC, feature LIMIT 5),
x AS (""" + "\nUNION ALL\n".join(f"SELECT id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM cohort"
                                 for c in _PROFILE8) + """)
SELECT id, feature, round(value, 6) AS value FROM x WHERE feature IN (SELECT feature FROM top)
"""
ORACLE["cohort_compare"] = _PHI + """
SELECT coalesce(ia.feature, ib.feature) AS feature, round(coalesce(ia.importance, 0), 6) AS importance_a,
       round(coalesce(ib.importance, 0), 6) AS importance_b,
       round(coalesce(ia.importance, 0) - coalesce(ib.importance, 0), 6) AS diff
FROM ia FULL OUTER JOIN ib ON ia.feature = ib.feature
"""
ORACLE["cohort_top_union"] = _PHI + """,
u AS (SELECT feature FROM (SELECT feature FROM ia ORDER BY importance DESC, feature LIMIT 15)
      UNION SELECT feature FROM (SELECT feature FROM ib ORDER BY importance DESC, feature LIMIT 15))
SELECT u.feature, round((coalesce(ia.importance, 0) + coalesce(ib.importance, 0)) / 2, 6) AS mean_importance
FROM u LEFT JOIN ia ON ia.feature = u.feature LEFT JOIN ib ON ib.feature = u.feature
"""
ORACLE["cohort_top_diff"] = _PHI + """,
d AS (SELECT ia.feature, ia.importance - ib.importance AS diff FROM ia JOIN ib ON ia.feature = ib.feature)
SELECT * FROM (SELECT 'higher_in_a' AS direction, feature, round(diff, 6) AS diff FROM d ORDER BY diff DESC, feature LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'higher_in_b', feature, round(diff, 6) FROM d ORDER BY diff ASC, feature LIMIT 10)
"""

# ------------------------------------------------------------------ H6

ORACLE["resample_tomek"] = """
WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.id, b.id AS nb, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d2
      FROM e a JOIN e b ON a.id <> b.id),
nn AS (SELECT id, nb FROM (SELECT id, nb, row_number() OVER (PARTITION BY id ORDER BY d2, nb) AS r FROM d) WHERE r = 1)
SELECT x.id, x.nb AS nb_id FROM nn x JOIN nn y ON x.id = y.nb AND x.nb = y.id
JOIN e ea ON ea.id = x.id JOIN e eb ON eb.id = x.nb
WHERE ea.label <> eb.label AND x.id < x.nb
"""

_LINKS = ORACLE["resample_tomek"].strip()
ORACLE["resample_tomek_removed"] = f"""
SELECT vec_id AS id, label FROM embeddings WHERE vec_id NOT IN (SELECT id FROM ({_LINKS}) UNION ALL SELECT nb_id FROM ({_LINKS}))
"""

# ------------------------------------------------------------------ H5, H7

_SENT = ", ".join(f"coalesce(CAST({c} AS DOUBLE), -999.0) AS {c}" for c in _PROFILE8)
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _PROFILE8)
_DRAW = "CAST('0x' || substr(md5(CAST(i AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)"
_SMOTE = with_("cohort") + f""",
w AS (SELECT id, label, {_SENT} FROM cohort),
cnt AS (SELECT label, count(*) AS n FROM w GROUP BY label),
mn AS (SELECT label, n FROM cnt ORDER BY n, label LIMIT 1),
mx AS (SELECT max(n) AS n FROM cnt),
mi AS (SELECT w.*, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':55'), id) AS rn FROM w WHERE label = (SELECT label FROM mn)),
dd AS (SELECT a.id, b.id AS nb, round(sqrt({_D2}), 9) AS dist FROM mi a JOIN mi b ON a.id <> b.id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist, nb) AS r FROM dd) WHERE r <= 5),
hv AS (SELECT id, count(*) AS c FROM nn GROUP BY id),
dr AS (SELECT i, {_DRAW.format(seed=55)} % (SELECT n FROM mn) + 1 AS rn, {_DRAW.format(seed=56)} AS slot,
              CAST('0x' || substr(md5(CAST(i AS VARCHAR) || ':57'), 1, 8) AS BIGINT) / 4294967296.0 AS u
       FROM (SELECT unnest(range(0, (SELECT n FROM mx) - (SELECT n FROM mn))) AS i)),
sy AS (SELECT -(dr.i + 1) AS id, (SELECT label FROM mn) AS label, 1 AS synthetic,
  {", ".join(f"a.{c} + u * (b.{c} - a.{c}) AS {c}" for c in _PROFILE8)}
  FROM dr JOIN mi a ON a.rn = dr.rn JOIN hv ON hv.id = a.id JOIN nn ON nn.id = a.id AND nn.r = dr.slot % hv.c + 1 JOIN mi b ON b.id = nn.nb),
al AS (SELECT id, label, 0 AS synthetic, {", ".join(_PROFILE8)} FROM w UNION ALL SELECT * FROM sy),
rs AS (SELECT id, label, synthetic, {", ".join(f"CASE WHEN abs({c} + 999) <= 1.00999 THEN NULL ELSE {c} END AS {c}" for c in _PROFILE8)} FROM al)"""

ORACLE["resample_smote_null"] = _SMOTE + f"""
SELECT id, label, synthetic, {", ".join(f"round({c}, 6) AS {c}" for c in _PROFILE8)} FROM rs
"""
ORACLE["resample_counts"] = _SMOTE + "\nSELECT label, synthetic, CAST(count(*) AS BIGINT) AS n FROM rs GROUP BY label, synthetic"

ORACLE["predict_new_rows_count"] = with_("cohort") + """
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT id) AS BIGINT) AS ids, CAST(count(*) AS BIGINT) AS labelled FROM cohort
"""
ORACLE["scan_csv_roundtrip"] = with_("cohort") + "\nSELECT * FROM cohort"
# no fixture row misses half of all its values
ORACLE["model_roundtrip"] = with_("cohort") + "\nSELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS unequal FROM cohort"
