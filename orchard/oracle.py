"""SQL twins of the registered queries, for an independent engine (DuckDB).

Written directly against the driver's tables (``lineitem``, ``events``), not
generated from the Spark plans, so that a mismatch points at a real semantic
difference.  DuckDB specifics: ``dayofweek`` is 0-6 (Spark: 1-7), ``sum`` of
BIGINT is HUGEINT (cast back), hex digits are parsed with a ``0x`` prefix.
"""

from __future__ import annotations

# Fixed values, written out so that a wrong one in the library shows up: the
# prime 2^31 - 1, a fifth of 2^32, and the Poisson(1) distribution function in
# units of the prime, up to the weight that no draw exceeds.
STREAM_PRIME = 2147483647
HOLDOUT_BELOW = 858993459
POISSON_CUTS = [790015083, 1580030167, 1975037709, 2106706890, 2139624185, 2146207644, 2147304887, 2147461637, 2147481230, 2147483407, 2147483625, 2147483645, 2147483647]

D = 6
SEED = 42
TEST_SIZE = 0.2
NUM_FOLDS = 3

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"

METRICS = f"""SELECT {KEYS}, l_shipdate AS "timestamp", l_suppkey % 5 + 1 AS node_id,
  l_extendedprice AS query_latency, l_discount * 100 AS cpu_utilization,
  l_quantity AS memory_utilization, l_tax * 100 AS system_load FROM lineitem"""

LABELS = f"""SELECT {KEYS}, l_shipdate AS "timestamp", l_suppkey % 5 + 1 AS node_id,
  l_extendedprice AS query_latency, l_discount * 100 AS cpu_utilization,
  l_quantity AS memory_utilization, l_tax * 100 AS system_load,
  CAST(l_returnflag = 'R' AS INTEGER) AS fraud FROM lineitem"""


def hex_word(s: str, word: int) -> str:
    return f"('0x' || substr(md5({s}), {8 * word + 1}, 8))::BIGINT"


def key_str(keys: str = KEYS, seed: int = SEED) -> str:
    return f"concat_ws('#', {keys}, '{seed}')"


HOLDOUT = f"{hex_word(key_str(), 0)} < {HOLDOUT_BELOW}"
SPLIT = f"CASE WHEN {HOLDOUT} THEN 'test' ELSE 'train' END"


def features_from(src: str) -> str:
    """P-11 on a relation with the metrics columns (timestamp dropped)."""
    return f"""SELECT * EXCLUDE ("timestamp"),
  CAST(hour("timestamp") AS INTEGER) AS hour,
  CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
  CAST(month("timestamp") AS INTEGER) AS month,
  cpu_utilization * memory_utilization AS cpu_memory_product,
  CASE WHEN cpu_utilization > 0 THEN system_load / cpu_utilization ELSE 0.0 END AS load_per_core
FROM ({src})"""


FEATURES = ["node_id", "cpu_utilization", "memory_utilization", "system_load",
            "hour", "day_of_week", "month", "cpu_memory_product", "load_per_core"]


def r(expr: str, alias: str) -> str:
    return f"round({expr}, {D}) AS {alias}"


# --------------------------------------------------------------------------
# S / F / P / T / M-4
# --------------------------------------------------------------------------

_METRIC_DOUBLES = ["query_latency", "cpu_utilization", "memory_utilization", "system_load"]


def _rounded_select(cols_plain: list[str], cols_double: list[str], src: str, tail: str = "") -> str:
    parts = cols_plain + [r(c, c) for c in cols_double]
    return f"SELECT {', '.join(parts)} FROM ({src}) {tail}"


CSV_SCAN_ROUNDTRIP = _rounded_select([KEYS, '"timestamp"', "node_id"], _METRIC_DOUBLES, METRICS)

ROW_COUNT = "SELECT count(*) AS n_rows FROM lineitem"

_LABEL_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "timestamp", "node_id",
               "query_latency", "cpu_utilization", "memory_utilization", "system_load", "fraud"]

NULL_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count("{c}") AS null_count,
  count(*) - count("{c}") > 0 AS has_nulls FROM ({LABELS})"""
    for c in _LABEL_COLS
)

# Column, Spark type name, numeric?  (label view after feature derivation)
_PROFILE_COLS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("node_id", "bigint"), ("query_latency", "double"),
    ("cpu_utilization", "double"), ("memory_utilization", "double"), ("system_load", "double"),
    ("fraud", "int"), ("hour", "int"), ("day_of_week", "int"), ("month", "int"),
    ("cpu_memory_product", "double"), ("load_per_core", "double"),
]

COLUMN_PROFILE = "WITH f AS (" + features_from(LABELS) + ") " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS null_count,
  count(DISTINCT {c}) AS n_distinct, {r(f'min(CAST({c} AS DOUBLE))', 'min_value')},
  {r(f'max(CAST({c} AS DOUBLE))', 'max_value')}, count(DISTINCT {c}) <= 1 AS is_constant FROM f"""
    for c, t in _PROFILE_COLS
)

NULL_ROWS = _rounded_select(
    [KEYS, '"timestamp"', "node_id", "fraud"], _METRIC_DOUBLES, LABELS,
    """WHERE query_latency IS NULL OR cpu_utilization IS NULL OR memory_utilization IS NULL
   OR system_load IS NULL OR "timestamp" IS NULL OR fraud IS NULL""",
)

PREVIEW = _rounded_select(
    [KEYS, '"timestamp"', "node_id", "fraud"], _METRIC_DOUBLES, LABELS,
    "ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 5",
)

SELECT_NUMERIC_COLUMNS = _rounded_select([KEYS, "node_id"], _METRIC_DOUBLES, LABELS)

CALENDAR_FEATURES = f"""SELECT {KEYS}, CAST(hour(l_shipdate) AS INTEGER) AS hour,
  CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS day_of_week,
  CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem"""

INTERACTION_FEATURE = f"SELECT {KEYS}, {r('cpu_utilization * memory_utilization', 'cpu_memory_product')} FROM ({METRICS})"

GUARDED_RATIO = f"""SELECT {KEYS}, {r('CASE WHEN cpu_utilization > 0 THEN system_load / cpu_utilization ELSE 0.0 END', 'load_per_core')}
FROM ({METRICS})"""

FULL_FEATURES = _rounded_select(
    [KEYS, "node_id", "hour", "day_of_week", "month"],
    _METRIC_DOUBLES + ["cpu_memory_product", "load_per_core"],
    features_from(METRICS),
)

HASH_SPLIT = f"SELECT {KEYS}, {SPLIT} AS split FROM lineitem"

SPLIT_SIZES = f"SELECT {SPLIT} AS split, count(*) AS n_rows FROM lineitem GROUP BY 1"

KFOLD_SIZES = f"""SELECT CAST({hex_word(key_str(), 1)} % {NUM_FOLDS} AS INTEGER) AS fold, count(*) AS n_rows
FROM lineitem WHERE NOT ({HOLDOUT}) GROUP BY 1"""

SPLIT_FEATURES = f"SELECT *, {SPLIT} AS split FROM ({features_from(METRICS)})"

STANDARDIZE = (
    f"WITH f AS ({SPLIT_FEATURES}), st AS (SELECT "
    + ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_samp(CAST({c} AS DOUBLE)) AS s_{c}" for c in FEATURES
    )
    + " FROM f WHERE split = 'train') SELECT "
    + KEYS
    + ", split, "
    + ", ".join(
        r(f"CASE WHEN s_{c} IS NULL THEN NULL WHEN s_{c} = 0 THEN 0.0 ELSE (CAST({c} AS DOUBLE) - m_{c}) / s_{c} END", c)
        for c in FEATURES
    )
    + " FROM f, st"
)

# --------------------------------------------------------------------------
# A-1 ... A-8 on the fixed scorers
# --------------------------------------------------------------------------

SCORED_CLS = f"""SELECT node_id, CAST(fraud AS DOUBLE) AS label, 'champion' AS model,
  cpu_utilization / 10.0 AS score, CAST(cpu_utilization / 10.0 >= 0.5 AS DOUBLE) AS prediction
FROM ({LABELS}) WHERE {HOLDOUT}
UNION ALL
SELECT node_id, CAST(fraud AS DOUBLE) AS label, 'challenger' AS model,
  memory_utilization / 50.0 AS score, CAST(memory_utilization / 50.0 >= 0.5 AS DOUBLE) AS prediction
FROM ({LABELS}) WHERE {HOLDOUT}"""

CONFUSION_COUNTS = f"""SELECT model, node_id, label, prediction, count(*) AS n
FROM ({SCORED_CLS}) GROUP BY ALL"""

AUC_CTES = f"""ad AS (
  SELECT model, node_id, score,
    CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
    CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
  FROM ({SCORED_CLS}) GROUP BY ALL),
ac AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, node_id ORDER BY score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM ad),
auc_t AS (SELECT model, node_id,
  CASE WHEN sum(pos) * sum(neg) = 0 THEN NULL ELSE sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc,
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
  FROM ac GROUP BY ALL)"""

AUC = f"WITH {AUC_CTES} SELECT model, node_id, {r('auc', 'auc')}, n_pos, n_neg FROM auc_t"

CLS_CTES = f"""cc AS (SELECT model, node_id, label, prediction, count(*) AS n FROM ({SCORED_CLS}) GROUP BY ALL),
tot AS (SELECT model, node_id, CAST(sum(n) AS BIGINT) AS n_rows,
    CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS n_correct,
    CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN n ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN label <> 1 AND prediction = 1 THEN n ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN label = 1 AND prediction <> 1 THEN n ELSE 0 END) AS BIGINT) AS fn
  FROM cc GROUP BY ALL),
act AS (SELECT model, node_id, label AS cls, sum(n) AS actual,
    sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cc GROUP BY ALL),
prd AS (SELECT model, node_id, prediction AS cls, sum(n) AS predicted FROM cc GROUP BY ALL),
pc AS (SELECT a.model, a.node_id, a.actual,
    CASE WHEN coalesce(p.predicted, 0) = 0 THEN 0.0 ELSE a.tp / p.predicted END AS pr,
    CASE WHEN a.actual = 0 THEN 0.0 ELSE a.tp / a.actual END AS rc
  FROM act a LEFT JOIN prd p ON a.model = p.model AND a.node_id = p.node_id AND a.cls = p.cls),
f AS (SELECT model, node_id, sum(actual) AS nn,
    sum(CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2.0 * pr * rc / (pr + rc) END * actual) AS f1w
  FROM pc GROUP BY ALL),
m AS (SELECT tot.model, tot.node_id, n_rows, n_correct / n_rows AS accuracy, f1w / nn AS f1_weighted,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1_positive
  FROM tot JOIN f ON tot.model = f.model AND tot.node_id = f.node_id)"""

_CLS_METRICS = f"WITH {CLS_CTES}"


def _cls_metric(name: str) -> str:
    return f"{_CLS_METRICS} SELECT model, node_id, n_rows, {r(name, name)} FROM m"


SCORED_REG = f"""WITH f AS ({SPLIT_FEATURES}),
tr AS (SELECT * FROM f WHERE split = 'train'), te AS (SELECT * FROM f WHERE split = 'test'),
gm AS (SELECT node_id, avg(query_latency) AS mu FROM tr GROUP BY node_id),
gl AS (SELECT node_id,
    CASE WHEN var_samp(memory_utilization) > 0
         THEN covar_samp(memory_utilization, query_latency) / var_samp(memory_utilization) ELSE 0.0 END AS slope,
    avg(memory_utilization) AS mx, avg(query_latency) AS my FROM tr GROUP BY node_id),
p AS (
  SELECT 'champion' AS model, te.node_id, te.query_latency AS label, gm.mu AS prediction
  FROM te JOIN gm ON te.node_id = gm.node_id
  UNION ALL
  SELECT 'challenger' AS model, te.node_id, te.query_latency AS label,
    gl.my + gl.slope * (te.memory_utilization - gl.mx) AS prediction
  FROM te JOIN gl ON te.node_id = gl.node_id)"""

REGRESSION_METRICS = f"""{SCORED_REG}
SELECT model, node_id, count(*) AS n_rows,
  {r('sqrt(sum((label - prediction) * (label - prediction)) / count(*))', 'rmse')},
  {r('avg(abs(label - prediction))', 'mae')},
  {r('1.0 - CASE WHEN var_samp(label) * (count(*) - 1) = 0 THEN NULL ELSE sum((label - prediction) * (label - prediction)) / (var_samp(label) * (count(*) - 1)) END', 'r2')}
FROM p GROUP BY ALL"""


# --------------------------------------------------------------------------
# B-1b ... B-9
# --------------------------------------------------------------------------

REPLICATES = 1000
SIMPSON_N = 4000
BOOT_KEY = f"concat_ws('#', {KEYS}, 'b{SEED}')"


def _weight_case(u: str) -> str:
    cuts = POISSON_CUTS
    whens = " ".join(f"WHEN {u} < {c} THEN {k}" for k, c in enumerate(cuts))
    return f"CASE {whens} END"


def _f1(m: str) -> str:
    return (f"CASE WHEN 2 * tp_{m} + fp_{m} + fn_{m} > 0 "
            f"THEN 2.0 * tp_{m} / (2 * tp_{m} + fp_{m} + fn_{m}) ELSE 0.0 END AS f1_{m}")


def _wsum(cond: str, alias: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN w ELSE 0 END) AS BIGINT) AS {alias}"


BOOT_CTES = f"""bw AS (SELECT node_id, CAST(fraud AS DOUBLE) AS label,
    CAST(cpu_utilization / 10.0 >= 0.5 AS DOUBLE) AS pa,
    CAST(memory_utilization / 50.0 >= 0.5 AS DOUBLE) AS pb,
    {hex_word(BOOT_KEY, 0)} % {STREAM_PRIME} AS wa,
    {hex_word(BOOT_KEY, 1)} % {STREAM_PRIME - 1} + 1 AS wb
  FROM ({LABELS}) WHERE {HOLDOUT}),
br AS (SELECT bw.*, CAST(t.rep AS INTEGER) AS replicate, (wa + t.rep * wb) % {STREAM_PRIME} AS u
  FROM bw CROSS JOIN range(0, {REPLICATES}) t(rep)),
bx AS (SELECT *, {_weight_case('u')} AS w FROM br),
bt AS (SELECT node_id, replicate,
    {_wsum('label = 1 AND pa = 1', 'tp_champion')}, {_wsum('label <> 1 AND pa = 1', 'fp_champion')},
    {_wsum('label = 1 AND pa <> 1', 'fn_champion')}, {_wsum('label = 1 AND pb = 1', 'tp_challenger')},
    {_wsum('label <> 1 AND pb = 1', 'fp_challenger')}, {_wsum('label = 1 AND pb <> 1', 'fn_challenger')}
  FROM bx GROUP BY node_id, replicate),
reps AS (SELECT *, {_f1('champion')}, {_f1('challenger')} FROM bt)"""

POISSON_BOOTSTRAP = f"""WITH {BOOT_CTES}
SELECT node_id, replicate, tp_champion, fp_champion, fn_champion, tp_challenger, fp_challenger,
  fn_challenger, {r('f1_champion', 'f1_champion')}, {r('f1_challenger', 'f1_challenger')} FROM reps"""

# Welch statistics; the p-value by Simpson's rule on the t density after the
# substitution x = |t| + w / (1 - w), an independent route from the Spark side.
WELCH_CTES = f"""{BOOT_CTES},
sm AS (SELECT node_id, count(*) AS n_replicates,
    avg(f1_champion) AS mean_champion, avg(f1_challenger) AS mean_challenger,
    stddev_pop(f1_champion) AS sd_champion, stddev_pop(f1_challenger) AS sd_challenger,
    var_samp(f1_champion) AS var_champion, var_samp(f1_challenger) AS var_challenger,
    avg(CASE WHEN f1_challenger > f1_champion THEN 0.0 ELSE 1.0 END) AS share_without_gain,
    quantile_cont(f1_challenger - f1_champion, 0.025) AS gain_low, quantile_cont(f1_challenger - f1_champion, 0.975) AS gain_high
  FROM reps GROUP BY node_id),
tt AS (SELECT *, mean_challenger - mean_champion AS f1_improvement,
    CASE WHEN var_challenger / n_replicates + var_champion / n_replicates > 0
      THEN (mean_challenger - mean_champion) / sqrt(var_challenger / n_replicates + var_champion / n_replicates) END AS t_stat,
    CASE WHEN power(var_challenger / n_replicates, 2) / (n_replicates - 1)
            + power(var_champion / n_replicates, 2) / (n_replicates - 1) > 0
      THEN power(var_challenger / n_replicates + var_champion / n_replicates, 2)
         / (power(var_challenger / n_replicates, 2) / (n_replicates - 1)
            + power(var_champion / n_replicates, 2) / (n_replicates - 1)) END AS dof,
    CASE WHEN sqrt((sd_challenger * sd_challenger + sd_champion * sd_champion) / 2) > 0
      THEN (mean_challenger - mean_champion) / sqrt((sd_challenger * sd_challenger + sd_champion * sd_champion) / 2)
      END AS effect_size
  FROM sm),
pg AS (SELECT node_id, abs(t_stat) AS abs_t, dof, g.i AS i, g.i / {SIMPSON_N}.0 AS w
  FROM tt CROSS JOIN range(0, {SIMPSON_N + 1}) g(i) WHERE t_stat IS NOT NULL AND dof IS NOT NULL),
pv AS (SELECT node_id, 2.0 * (1.0 / {SIMPSON_N}) / 3.0 * sum(
    CASE WHEN i = 0 OR i = {SIMPSON_N} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END *
    CASE WHEN i = {SIMPSON_N} THEN 0.0 ELSE
      exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi())
          - (dof + 1) / 2 * ln(1 + power(abs_t + w / (1 - w), 2) / dof)) / power(1 - w, 2) END) AS p_value
  FROM pg GROUP BY node_id),
tv AS (SELECT tt.*, pv.p_value,
    coalesce(pv.p_value < 0.05 AND mean_challenger > mean_champion, false) AS is_significant
  FROM tt LEFT JOIN pv ON tt.node_id = pv.node_id)"""

WELCH_STATS = f"""WITH {WELCH_CTES}
SELECT node_id, n_replicates, {r('mean_champion', 'mean_champion')}, {r('mean_challenger', 'mean_challenger')},
  {r('var_champion', 'var_champion')}, {r('var_challenger', 'var_challenger')},
  {r('t_stat', 't_stat')}, {r('dof', 'dof')}, {r('p_value', 'p_value')} FROM tv"""

EFFECT_SIZE = f"""WITH {WELCH_CTES}
SELECT node_id, {r('mean_champion', 'mean_champion')}, {r('mean_challenger', 'mean_challenger')},
  {r('sd_champion', 'sd_champion')}, {r('sd_challenger', 'sd_challenger')},
  {r('f1_improvement', 'f1_improvement')}, {r('effect_size', 'effect_size')} FROM tt"""

AB_REPORT = f"""WITH {CLS_CTES}, {AUC_CTES}, {WELCH_CTES}
SELECT m1.node_id,
  {r('a1.auc', 'champion_auc')}, {r('m1.f1_weighted', 'champion_f1')}, {r('m1.accuracy', 'champion_accuracy')},
  {r('a2.auc', 'challenger_auc')}, {r('m2.f1_weighted', 'challenger_f1')}, {r('m2.accuracy', 'challenger_accuracy')},
  {r('tv.f1_improvement', 'f1_improvement')}, {r('tv.p_value', 'p_value')}, {r('tv.effect_size', 'effect_size')},
  tv.is_significant, CASE WHEN tv.is_significant THEN 'PROMOTE' ELSE 'KEEP_CHAMPION' END AS decision,
  {r('tv.share_without_gain', 'share_without_gain')}, {r('tv.gain_low', 'gain_low')}, {r('tv.gain_high', 'gain_high')},
  CAST(greatest(m1.n_rows, m2.n_rows) AS BIGINT) AS test_set_size,
  'models:/fixed_scores@champion' AS champion_model, 'models:/fixed_scores@challenger' AS challenger_model
FROM m m1
JOIN m m2 ON m1.node_id = m2.node_id AND m1.model = 'champion' AND m2.model = 'challenger'
JOIN auc_t a1 ON a1.node_id = m1.node_id AND a1.model = 'champion'
JOIN auc_t a2 ON a2.node_id = m1.node_id AND a2.model = 'challenger'
JOIN tv ON tv.node_id = m1.node_id"""

_REG_CTES = SCORED_REG[len("WITH "):] + """,
rm AS (SELECT model, node_id, sqrt(sum((label - prediction) * (label - prediction)) / count(*)) AS rmse,
    avg(abs(label - prediction)) AS mae,
    1.0 - CASE WHEN var_samp(label) * (count(*) - 1) = 0 THEN NULL
      ELSE sum((label - prediction) * (label - prediction)) / (var_samp(label) * (count(*) - 1)) END AS r2
  FROM p GROUP BY ALL),
dw AS (SELECT node_id,
    max(CASE WHEN model = 'champion' THEN rmse END) AS champion_rmse,
    max(CASE WHEN model = 'champion' THEN mae END) AS champion_mae,
    max(CASE WHEN model = 'champion' THEN r2 END) AS champion_r2,
    max(CASE WHEN model = 'challenger' THEN rmse END) AS challenger_rmse,
    max(CASE WHEN model = 'challenger' THEN mae END) AS challenger_mae,
    max(CASE WHEN model = 'challenger' THEN r2 END) AS challenger_r2
  FROM rm GROUP BY node_id),
dd AS (SELECT *,
    CASE WHEN challenger_rmse IS NULL OR champion_rmse IS NULL THEN 'SKIPPED'
         WHEN challenger_rmse < champion_rmse THEN 'PROMOTE' ELSE 'KEEP_CHAMPION' END AS decision,
    CASE WHEN champion_rmse <> 0 THEN (champion_rmse - challenger_rmse) / champion_rmse * 100.0 END AS rmse_improvement_pct
  FROM dw)"""

_DECISION_METRICS = ["champion_rmse", "champion_mae", "champion_r2", "challenger_rmse",
                     "challenger_mae", "challenger_r2", "rmse_improvement_pct"]

DECIDE_REGRESSION = (f"WITH {_REG_CTES} SELECT node_id, "
                     + ", ".join(r(c, c) for c in _DECISION_METRICS) + ", decision FROM dd")

_RUN_ID = "'ab_node_' || CAST(node_id AS VARCHAR)"
LOG_ROWS = " UNION ALL ".join(
    [f"""SELECT {_RUN_ID} AS run_id, 'metric' AS kind, '{c}' AS key, printf('%.6f', {c}) AS value,
  {r(c, 'num_value')}, CAST(node_id AS BIGINT) AS event_id FROM dd""" for c in _DECISION_METRICS]
    + [f"""SELECT {_RUN_ID} AS run_id, 'tag' AS kind, 'decision' AS key, decision AS value,
  CAST(NULL AS DOUBLE) AS num_value, CAST(node_id AS BIGINT) AS event_id FROM dd"""]
)

LOG_METRICS = f"WITH {_REG_CTES}, lr AS ({LOG_ROWS}) SELECT * FROM lr"

LOG_LINES = f"WITH {_REG_CTES}, lr AS ({LOG_ROWS}) SELECT concat_ws(' ', run_id, kind, key, value) AS line FROM lr"

# --------------------------------------------------------------------------
# R-4 ... R-11 on events
# --------------------------------------------------------------------------

REG_CTES = """ev AS (SELECT event_id, 'model_' || CAST(user_id AS VARCHAR) AS model,
    'run_' || CAST(event_id AS VARCHAR) AS run_id, event_type, value AS metric FROM events),
mv AS (SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY event_id) AS INTEGER) AS version,
    run_id, event_id, event_type, metric FROM ev),
ae AS (SELECT event_id, model, CASE event_type WHEN 'purchase' THEN 'champion' ELSE 'challenger' END AS alias,
    version FROM mv WHERE event_type IN ('purchase', 'view')),
cur AS (SELECT model, alias, arg_max(version, event_id) AS version, max(event_id) AS event_id FROM ae GROUP BY ALL),
chm AS (SELECT mm.model, c.version AS champion_version, v.run_id, v.metric
  FROM (SELECT DISTINCT model FROM mv) mm
  LEFT JOIN cur c ON c.model = mm.model AND c.alias = 'champion'
  LEFT JOIN mv v ON v.model = c.model AND v.version = c.version)"""

RESOLVE_ALIAS = f"WITH {REG_CTES} SELECT * FROM cur"

CHAMPION_METRICS = f"""WITH {REG_CTES}
SELECT model, champion_version, run_id, {r('metric', 'auc')}, {r('metric', 'rmse')} FROM chm"""

NEXT_VERSION = f"WITH {REG_CTES} SELECT model, max(version) + 1 AS next_version FROM mv GROUP BY model"


def _promotion(metric: str, higher: bool) -> str:
    agg, cmp = ("max", ">") if higher else ("min", "<")
    diff = "metric - best_before" if higher else "best_before - metric"
    return f"""WITH {REG_CTES},
h AS (SELECT model, version, event_id, metric, {agg}(metric) OVER (PARTITION BY model ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM mv)
SELECT model, version, event_id, {r('metric', metric)}, {r('best_before', 'best_before')},
  CASE WHEN metric IS NULL THEN 'NO_METRIC' WHEN best_before IS NULL OR metric {cmp} best_before
       THEN 'champion' ELSE 'challenger' END AS decision,
  {r(f'CASE WHEN best_before <> 0 THEN ({diff}) / best_before * 100.0 END', 'improvement_pct')}
FROM h"""


RELATIVE_IMPROVEMENT = f"""WITH {REG_CTES},
nw AS (SELECT model, arg_max(version, event_id) AS version, arg_max(metric, event_id) AS auc FROM mv GROUP BY model),
j AS (SELECT nw.*, chm.champion_version, chm.metric AS champion_metric FROM nw LEFT JOIN chm ON nw.model = chm.model),
d AS (SELECT *, CASE WHEN champion_version IS NULL THEN 'FIRST_MODEL'
      WHEN champion_metric IS NULL OR auc IS NULL THEN 'NO_BASELINE_METRIC'
      WHEN auc > champion_metric THEN 'IMPROVED' ELSE 'NOT_IMPROVED' END AS decision FROM j)
SELECT model, version, {r('auc', 'auc')}, champion_version, {r('champion_metric', 'champion_metric')}, decision,
  CASE WHEN decision IN ('FIRST_MODEL', 'IMPROVED') THEN 'champion' ELSE 'challenger' END AS alias,
  {r('CASE WHEN champion_metric <> 0 THEN (auc - champion_metric) / champion_metric * 100.0 END', 'improvement_pct')}
FROM d"""

ALIAS_SWAP = f"""WITH {REG_CTES},
cm AS (SELECT c.model, c.alias, c.version, v.metric FROM cur c LEFT JOIN mv v ON v.model = c.model AND v.version = c.version),
dec AS (SELECT model, max(CASE WHEN alias = 'champion' THEN metric END) AS champ,
    max(CASE WHEN alias = 'challenger' THEN metric END) AS chall FROM cm GROUP BY model),
new_ev AS (SELECT (SELECT max(event_id) + 1 FROM ae) AS event_id, d.model, 'champion' AS alias, c.version
  FROM dec d JOIN cur c ON c.model = d.model AND c.alias = 'challenger' WHERE d.chall > d.champ),
allev AS (SELECT event_id, model, alias, version FROM ae UNION ALL SELECT * FROM new_ev)
SELECT model, alias, arg_max(version, event_id) AS version, max(event_id) AS event_id FROM allev GROUP BY ALL"""

RETRAINING_REPORT = f"""WITH {REG_CTES},
lt AS (SELECT model, event_id, metric AS new_metric, version AS latest_version FROM mv m
  WHERE version = (SELECT max(version) FROM mv WHERE mv.model = m.model)),
met AS (SELECT lt.*, (SELECT max(event_id) FROM ae WHERE ae.model = lt.model AND alias = 'champion'
    AND ae.event_id < lt.event_id) AS champion_event FROM lt)
SELECT met.model, met.latest_version, c.version AS champion_version, {r('met.new_metric', 'new_rmse')},
  {r('c.metric', 'champion_rmse')},
  CASE WHEN met.new_metric IS NULL OR c.metric IS NULL THEN 'NO_DATA'
       WHEN met.new_metric < c.metric THEN 'IMPROVED' ELSE 'NOT_IMPROVED' END AS status
FROM met LEFT JOIN mv c ON c.model = met.model AND c.event_id = met.champion_event"""


# --------------------------------------------------------------------------
# Fitted models: what must hold for any correct fit, on the known key set
# --------------------------------------------------------------------------

FOLD = f"CAST({hex_word(key_str(), 1)} % {NUM_FOLDS} AS INTEGER)"
LATENCY = "2.0 * l_quantity + 300.0 * l_tax + l_extendedprice / 10000.0"
SIGNAL = f"""SELECT {KEYS}, l_shipdate AS "timestamp", l_suppkey % 5 + 1 AS node_id,
  {LATENCY} AS query_latency, l_discount * 100 AS cpu_utilization,
  l_quantity AS memory_utilization, l_tax * 100 AS system_load FROM lineitem"""
SIGNAL_LABELS = f"SELECT * EXCLUDE (query_latency), CAST(query_latency > 70.0 AS INTEGER) AS fraud FROM ({SIGNAL})"
HOLDOUT_CLS = f"""WITH d AS (SELECT *, {HOLDOUT} AS held FROM ({SIGNAL_LABELS})),
c AS (SELECT fraud AS common FROM d WHERE NOT held GROUP BY fraud ORDER BY count(*) DESC, fraud LIMIT 1),
s AS (SELECT avg(CAST(fraud = common AS DOUBLE)) AS share FROM d, c WHERE held)
SELECT {KEYS}, fraud, true AS valid, {r('share', 'common_share')}, true AS beats_common, true AS auc_above_nine_tenths FROM d, s WHERE held"""
HOLDOUT_TWO = f"SELECT {KEYS}, fraud, true AS valid, true AS champion_mostly_right, true AS challenger_mostly_right FROM ({SIGNAL_LABELS}) WHERE {HOLDOUT}"
HOLDOUT_REG = f"""WITH d AS (SELECT *, {HOLDOUT} AS held FROM ({SIGNAL})),
m AS (SELECT avg(query_latency) AS mean FROM d WHERE NOT held),
e AS (SELECT sqrt(avg((query_latency - mean) * (query_latency - mean))) AS plain FROM d, m WHERE held)
SELECT {KEYS}, {r('query_latency', 'query_latency')}, {r('plain', 'mean_rmse')}, true AS far_below_mean_rmse FROM d, e WHERE held"""
CROSS_VALIDATE = """SELECT CAST(t AS INTEGER) AS "numTrees", CAST(d AS INTEGER) AS "maxDepth", true AS valid,
  true AS best_has_largest FROM (VALUES (10, 5), (10, 10), (20, 5), (20, 10)) g(t, d)"""
CROSS_VALIDATE_REGRESSION = f"""WITH f AS (SELECT query_latency, {FOLD} AS fold FROM ({SIGNAL}) WHERE NOT ({HOLDOUT})),
m AS (SELECT k.fold, avg(query_latency) AS mean FROM (VALUES (0), (1), (2)) k(fold) JOIN f ON f.fold <> k.fold GROUP BY k.fold),
e AS (SELECT fold, count(*) AS n_rows, sqrt(avg((query_latency - mean) * (query_latency - mean))) AS plain FROM f JOIN m USING (fold) GROUP BY fold)
SELECT CAST(t AS INTEGER) AS "numTrees", CAST(d AS INTEGER) AS "maxDepth", CAST(fold AS INTEGER) AS fold, n_rows, {r('plain', 'mean_rmse')},
  true AS far_below, true AS best_has_least FROM e, (VALUES (30), (50), (70)) a(t), (VALUES (5), (10), (15)) b(d)"""
FOREST_NODES = f"SELECT {KEYS}, fraud, true AS same FROM ({SIGNAL_LABELS}) WHERE {HOLDOUT}"
FOREST_LEAVES = f"""SELECT CAST(t AS INTEGER) AS tree, count(*) AS n_rows, round(sum(query_latency), 2) AS label_sum, true AS many_leaves
FROM ({SIGNAL}), (VALUES (0), (1), (2)) v(t) WHERE NOT ({HOLDOUT}) GROUP BY t"""
BATCH_SCORE = f"""SELECT {KEYS}, day AS score_date, true AS valid
FROM ({METRICS}), (VALUES ('2024-01-30'), ('2024-01-31')) v(day) WHERE {HOLDOUT}"""


def _least_squares(tail: str) -> str:
    """Gauss-Jordan elimination on the covariances of the training side, one
    CTE per feature; a feature without variance gets coefficient 0.  ``b`` is
    one row: coefficients b0 ..., intercept b."""
    k = len(FEATURES)
    names = [*FEATURES, "query_latency"]
    cells = [(i, j) for i in range(k) for j in range(k + 1)]
    out = [f"d AS MATERIALIZED (SELECT *, {HOLDOUT} AS held FROM ({features_from(SIGNAL)}))",
           f"""s0 AS MATERIALIZED (SELECT unnest([{', '.join(str(i) for i, _ in cells)}]) AS i, unnest([{', '.join(str(j) for _, j in cells)}]) AS j,
  unnest([{', '.join(f'covar_pop({names[i]}, {names[j]})' for i, j in cells)}]) AS v FROM d WHERE NOT held)"""]
    for p in range(k):
        out.append(f"""s{p + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN t.v < 1e-9 THEN (CASE WHEN a.i = {p} THEN 0 ELSE a.v END)
  WHEN a.i = {p} THEN a.v / t.v ELSE a.v - q.v * w.v / t.v END AS v
  FROM s{p} a JOIN s{p} q ON q.i = a.i AND q.j = {p} JOIN s{p} w ON w.i = {p} AND w.j = a.j JOIN s{p} t ON t.i = {p} AND t.j = {p})""")
    out.append(f"beta AS (SELECT {', '.join(f'max(v) FILTER (i = {i}) AS b{i}' for i in range(k))} FROM s{k} WHERE j = {k})")
    out.append(f"means AS (SELECT {', '.join(f'avg({c}) AS m{i}' for i, c in enumerate(names))} FROM d WHERE NOT held)")
    out.append(f"b AS (SELECT *, m{k} - ({' + '.join(f'b{i} * m{i}' for i in range(k))}) AS b FROM beta, means)")
    return f"WITH {', '.join(out)} {tail}"


TRAIN_LINEAR = _least_squares(f"""SELECT {KEYS}, round(b + {' + '.join(f'b{i} * {c}' for i, c in enumerate(FEATURES))}, 4) AS prediction, true AS pipeline_agrees FROM d, b WHERE held""")
LINEAR_COEFFICIENTS = _least_squares(" UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'b{i}', 'coefficient')}, true AS residual_is_orthogonal FROM b" for i, c in enumerate(FEATURES)))
MODEL_ROUNDTRIP = f"SELECT count(*) AS n_rows, count(*) AS n_same FROM ({SIGNAL_LABELS}) WHERE {HOLDOUT}"
BOOTSTRAP_F1 = f"""SELECT DISTINCT node_id, CAST({REPLICATES} AS BIGINT) AS n_replicates,
  CAST({REPLICATES} AS BIGINT) AS n_consistent, true AS mean_is_near FROM ({LABELS}) WHERE {HOLDOUT}"""

# --------------------------------------------------------------------------
# Nulls, derived on both sides
# --------------------------------------------------------------------------

HOLED = f"""SELECT {KEYS}, CAST(nullif(node_id, 3) AS VARCHAR) AS node_id, nullif(memory_utilization, 10.0) AS memory_utilization,
  CASE WHEN l_linenumber <> 2 THEN CAST(fraud AS DOUBLE) END AS label FROM ({LABELS})"""
NULL_PROFILE_HOLED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) > count({c}) AS has_nulls FROM ({HOLED})"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "node_id", "memory_utilization", "label")
)
COMPLETE = f"SELECT node_id, label, memory_utilization AS x FROM ({HOLED}) WHERE label IS NOT NULL AND memory_utilization IS NOT NULL"
AUC_NULLS = f"""WITH c AS ({COMPLETE}),
s AS (SELECT node_id, x, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM c GROUP BY ALL),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY node_id ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT node_id, {r('sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0)', 'auc')},
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM b GROUP BY node_id"""
ACCURACY_NULLS = f"""WITH c AS (SELECT node_id, label, CAST(x >= 25 AS DOUBLE) AS p FROM ({COMPLETE}))
SELECT node_id, count(*) AS n_rows, {r('avg(CAST(label = p AS DOUBLE))', 'accuracy')},
  {r('CASE WHEN count(*) FILTER (label = 1 OR p = 1) = 0 THEN 0.0 ELSE 2.0 * count(*) FILTER (label = 1 AND p = 1) / (sum(label) + sum(p)) END', 'f1_positive')}
FROM c GROUP BY node_id"""
REGRESSION_METRICS_NULLS = f"""SELECT node_id, count(*) AS n_rows, {r('sqrt(avg((label - x / 50.0) * (label - x / 50.0)))', 'rmse')},
  {r('avg(abs(label - x / 50.0))', 'mae')} FROM ({COMPLETE}) GROUP BY node_id"""
PROFILE_BIGINT = """SELECT 'big' AS column_name, CAST(0 AS BIGINT) AS null_count,
  count(DISTINCT o_orderkey + 9007199254740992) AS n_distinct FROM orders"""
HASH_SPLIT_NO_KEYS = f"""SELECT doc_id, quality, toxic,
  CASE WHEN {hex_word("concat_ws('#', doc_id, quality, toxic, '42')", 0)} < {HOLDOUT_BELOW} THEN 'test' ELSE 'train' END AS split FROM labels"""
RANDOM_SPLIT = "SELECT CAST(1 AS BIGINT) AS sides, count(*) AS n_rows FROM events"
SKIPPED_AB = f"SELECT DISTINCT node_id, 'SKIPPED' AS decision FROM ({METRICS}) WHERE {HOLDOUT}"


_TRAIN_ROWS = f"(SELECT count(*) FILTER (NOT ({HOLDOUT})) FROM lineitem)"
PROCESSED_COUNTS = f"""WITH h AS (SELECT *, {HOLDOUT} AS held, label IS NOT NULL AND memory_utilization IS NOT NULL AS whole
  FROM (SELECT {KEYS}, memory_utilization, label FROM ({HOLED}))),
c AS (SELECT count(*) AS a, count(*) FILTER (NOT whole) AS b, count(*) FILTER (whole AND NOT held) AS c, count(*) FILTER (whole AND held) AS d FROM h)
SELECT 'n_rows' AS name, a AS n FROM c UNION ALL SELECT 'dropped_rows', b FROM c UNION ALL SELECT 'train_rows', c FROM c UNION ALL SELECT 'test_rows', d FROM c"""
TRAIN_FROM_PROCESSED = f"SELECT {KEYS}, {r('query_latency', 'query_latency')}, true AS same_prediction, true AS same_rmse FROM ({SIGNAL}) WHERE {HOLDOUT}"
_PARAMS = f"""(VALUES ('best_maxDepth', '5'), ('best_numTrees', '10'), ('num_features', '{len(FEATURES)}'),
  ('dropped_training_rows', '0'), ('dropped_test_rows', '0')) p(key, value)"""
LOG_PARAMS = f"""SELECT 'run-1' AS run_id, key, value, CAST(1 AS BIGINT) AS event_id FROM (
  SELECT * FROM {_PARAMS} UNION ALL VALUES ('numTrees_options', '[10, 20]'), ('maxDepth_options', '[5, 10]')
  UNION ALL SELECT 'training_rows', CAST({_TRAIN_ROWS} AS VARCHAR))"""
TRAIN_LOG_LINES = f"""SELECT 'param' AS kind, key, value FROM (SELECT * FROM {_PARAMS} UNION ALL SELECT 'training_rows', CAST({_TRAIN_ROWS} AS VARCHAR))
UNION ALL SELECT 'metric', key, NULL FROM (VALUES ('auc'), ('accuracy'), ('f1'), ('f1_positive')) m(key)
UNION ALL VALUES ('tag', 'decision', 'FIRST_MODEL'), ('tag', 'version', '1')"""
SELECT_ALL_BUT_LABEL = f"""SELECT "timestamp", node_id, {', '.join(r(c, c) for c in _METRIC_DOUBLES)} FROM ({LABELS})"""
AUC_MANY_SCORES = f"""WITH s AS (SELECT node_id, query_latency * 0.001 + memory_utilization AS x, count(*) FILTER (fraud = 1) AS pos, count(*) FILTER (fraud <> 1) AS neg FROM ({LABELS}) GROUP BY ALL),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY node_id ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT node_id, {r('sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0)', 'auc')},
  CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM b GROUP BY node_id"""
INCREMENTAL_SCALER = f"WITH f AS ({features_from(METRICS)}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, {r(f'avg(CAST({c} AS DOUBLE))', 'mean')}, {r(f'stddev_samp(CAST({c} AS DOUBLE))', 'sd')} FROM f" for c in FEATURES)
SKETCH_PROFILE = "WITH f AS (" + features_from(LABELS) + ") " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS null_count, {r(f'min(CAST({c} AS DOUBLE))', 'min_value')},
  {r(f'max(CAST({c} AS DOUBLE))', 'max_value')}, true AS distinct_within_bound, true AS median_within_bound FROM f""" for c, _ in _PROFILE_COLS)


ORACLE: dict[str, str] = {
    "csv_scan_roundtrip": CSV_SCAN_ROUNDTRIP,
    "row_count": ROW_COUNT,
    "null_profile": NULL_PROFILE,
    "column_profile": COLUMN_PROFILE,
    "null_rows": NULL_ROWS,
    "preview": PREVIEW,
    "select_numeric_columns": SELECT_NUMERIC_COLUMNS,
    "calendar_features": CALENDAR_FEATURES,
    "interaction_feature": INTERACTION_FEATURE,
    "guarded_ratio": GUARDED_RATIO,
    "full_features": FULL_FEATURES,
    "hash_split": HASH_SPLIT,
    "split_sizes": SPLIT_SIZES,
    "kfold_sizes": KFOLD_SIZES,
    "standardize": STANDARDIZE,
    "confusion_counts": CONFUSION_COUNTS,
    "auc": AUC,
    "accuracy": _cls_metric("accuracy"),
    "f1_weighted": _cls_metric("f1_weighted"),
    "f1_positive": _cls_metric("f1_positive"),
    "regression_metrics": REGRESSION_METRICS,
    "poisson_bootstrap": POISSON_BOOTSTRAP,
    "welch_stats": WELCH_STATS,
    "effect_size": EFFECT_SIZE,
    "decide_regression": DECIDE_REGRESSION,
    "ab_report": AB_REPORT,
    "ab_report_json": AB_REPORT,
    "log_metrics": LOG_METRICS,
    "log_lines": LOG_LINES,
    "resolve_alias": RESOLVE_ALIAS,
    "champion_metrics": CHAMPION_METRICS,
    "next_version": NEXT_VERSION,
    "promotion_auc": _promotion("auc", True),
    "promotion_rmse": _promotion("rmse", False),
    "relative_improvement": RELATIVE_IMPROVEMENT,
    "alias_swap": ALIAS_SWAP,
    "retraining_report": RETRAINING_REPORT,
    "processed_sets": STANDARDIZE,
    "train_classifier": HOLDOUT_CLS,
    "train_regressor": HOLDOUT_REG,
    "train_linear": TRAIN_LINEAR,
    "linear_coefficients": LINEAR_COEFFICIENTS,
    "train_logistic": HOLDOUT_CLS,
    "two_model_score": HOLDOUT_TWO,
    "stream_score": HOLDOUT_CLS,
    "cross_validate": CROSS_VALIDATE,
    "processed_counts": PROCESSED_COUNTS,
    "train_from_processed": TRAIN_FROM_PROCESSED,
    "log_params": LOG_PARAMS,
    "train_log_lines": TRAIN_LOG_LINES,
    "select_all_but_label": SELECT_ALL_BUT_LABEL,
    "auc_many_scores": AUC_MANY_SCORES,
    "incremental_scaler": INCREMENTAL_SCALER,
    "sketch_profile": SKETCH_PROFILE,
    "cross_validate_regression": CROSS_VALIDATE_REGRESSION,
    "forest_nodes": FOREST_NODES,
    "forest_leaves": FOREST_LEAVES,
    "batch_score": BATCH_SCORE,
    "model_roundtrip": MODEL_ROUNDTRIP,
    "bootstrap_f1": BOOTSTRAP_F1,
    "null_profile_holed": NULL_PROFILE_HOLED,
    "auc_nulls": AUC_NULLS,
    "accuracy_nulls": ACCURACY_NULLS,
    "regression_metrics_nulls": REGRESSION_METRICS_NULLS,
    "profile_bigint": PROFILE_BIGINT,
    "hash_split_no_keys": HASH_SPLIT_NO_KEYS,
    "random_split": RANDOM_SPLIT,
    "skipped_ab": SKIPPED_AB,
}

