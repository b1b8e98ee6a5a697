"""DuckDB SQL twins of the registered queries."""

from __future__ import annotations



def _fields(delimiter: str, *fields: str) -> str:
    return f"concat_ws({delimiter}, " + ", ".join(f"coalesce({f}, '')" for f in fields) + ")"


_DOCUMENT = ["lang", "source", "CAST(CAST(floor(n_chars / 500) AS BIGINT) AS VARCHAR)"]

LINES = {
    "events": f"""
lines AS (
  SELECT event_id AS obs_id, {_fields(
    "chr(9)",
    "CASE WHEN event_type = 'click' THEN '1' ELSE '0' END",
    "CAST(user_id AS VARCHAR)", "regexp_extract(props, '[0-9]+', 0)", "CAST(hour(ts) AS VARCHAR)",
    "CASE WHEN value < 5 THEN '' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END",
  )} AS raw
  FROM events)""",
    "orders": f"""
lines AS (
  SELECT o_orderkey AS obs_id, {_fields(
    "','",
    "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END", "o_orderpriority",
    "CAST(year(o_orderdate) AS VARCHAR)", "CAST(month(o_orderdate) AS VARCHAR)", "CAST(o_custkey AS VARCHAR)",
    "c_mktsegment", "CAST(c_nationkey AS VARCHAR)",
    "CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR)",
  )} AS raw
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "documents": f"""
lines AS (
  SELECT d.doc_id AS obs_id, {_fields("','", "CAST(quality AS VARCHAR)", *_DOCUMENT)} AS raw
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)""",
    "all documents": f"""
lines AS (SELECT doc_id AS obs_id, {_fields("','", "'0'", *_DOCUMENT)} AS raw FROM documents)""",
}

# split cuts: 0.8 and 0.9 of 2^32
OBSERVATIONS = """
drawn AS (
  SELECT obs_id, replace(raw, chr(9), ',') AS line,
    CAST('0x' || substr(md5('42:' || CAST(obs_id AS VARCHAR)), 1, 8) AS BIGINT) AS u
  FROM lines),
obs AS (
  SELECT obs_id, line, string_split(line, ',') AS f,
    CASE WHEN u < 3435973837 THEN 'train' WHEN u < 3865470566 THEN 'validation' ELSE 'test' END AS split
  FROM drawn),
labelled AS (SELECT obs_id, split, CAST(f[1] AS DOUBLE) AS label FROM obs),
feats AS (
  SELECT obs_id, split, CAST(f[1] AS DOUBLE) AS label, CAST(i AS INTEGER) AS feature_id, f[i + 2] AS value
  FROM (SELECT obs_id, split, f, unnest(range(len(f) - 1)) AS i FROM obs))"""

DICTIONARY = """
dict AS (
  SELECT feature_id, value, row_number() OVER (ORDER BY feature_id, value) - 1 AS idx
  FROM (SELECT DISTINCT feature_id, value FROM feats WHERE split = 'train'))"""

OHE = """
enc AS (
  SELECT s.obs_id, s.split, s.label, d.idx, CAST(1 AS DOUBLE) AS val
  FROM feats s JOIN dict d ON s.feature_id = d.feature_id AND s.value = d.value)"""

FIXED_SCORES = """
scored AS (
  SELECT l.obs_id, l.split, l.label,
    1 / (1 + exp(-least(greatest(coalesce(m.margin, 0) - 1, -20), 20))) AS p
  FROM labelled l LEFT JOIN (
    SELECT obs_id, sum(val * ((idx * 7919) % 1000 / 1000.0::DOUBLE - 0.5)) AS margin FROM enc GROUP BY obs_id
  ) m ON l.obs_id = m.obs_id)"""


def log_loss(p: str, label: str) -> str:
    inside = f"(CASE WHEN {p} = 0 THEN {p} + 1e-11 WHEN {p} = 1 THEN {p} - 1e-11 ELSE {p} END)"
    return f"(-ln(CASE WHEN {label} = 1 THEN {inside} ELSE 1 - {inside} END))"


def bucket(text: str, n: int) -> str:
    parts = [f"CAST('0x' || substr(md5({text}), {8 * k + 1}, 8) AS BIGINT)" for k in range(4)]
    rest = f"({parts[0]} % {n})"
    for part in parts[1:]:
        rest = f"(({rest} * 4294967296 + {part}) % {n})"
    return rest


def hashed(n: int) -> str:
    return f"""
named AS (SELECT DISTINCT obs_id, split, label, value || CAST(feature_id AS VARCHAR) AS feature FROM feats),
enc AS (
  SELECT obs_id, split, label, {bucket("feature", n)} AS idx, CAST(count(*) AS DOUBLE) AS val
  FROM named GROUP BY ALL)"""


def query(source: str, *ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join([LINES[source], *ctes])}\n{select}"


def parsed(source: str, select: str) -> str:
    return query(source, OBSERVATIONS, select=select)


def ohe(source: str, select: str) -> str:
    return query(source, OBSERVATIONS, DICTIONARY, OHE, select=select)


def fixed_scored(select: str) -> str:
    return query("events", OBSERVATIONS, DICTIONARY, OHE, FIXED_SCORES, select=select)


PARSE = """
SELECT obs_id, CAST(f[1] AS DOUBLE) AS label, CAST(len(f) - 1 AS INTEGER) AS n_feats,
  array_to_string(f[2:], '|') AS feats FROM obs"""
EXPLODE = "SELECT obs_id, label, feature_id, value FROM feats"
CATEGORIES = "SELECT feature_id, count(DISTINCT value) AS n_categories FROM feats GROUP BY feature_id"
DIMENSION = "SELECT count(*) AS dimension FROM dict"
UNSEEN = """
SELECT obs_id, feature_id, value FROM feats f
WHERE NOT EXISTS (SELECT 1 FROM dict d WHERE d.feature_id = f.feature_id AND d.value = f.value)"""
ENCODED = "SELECT obs_id, idx, val FROM enc"
CLASS_RATE = "SELECT round(avg(label), 6) AS class_rate FROM labelled WHERE split = 'train'"
BASELINE = f"""
SELECT split, round(any_value(rate), 6) AS class_rate, round(avg({log_loss("rate", "label")}), 6) AS log_loss
FROM labelled, (SELECT avg(label) AS rate FROM labelled WHERE split = 'train') GROUP BY split"""

FREQUENCY = """
freq AS (SELECT idx, count(*) AS n FROM enc WHERE split = 'train' GROUP BY idx)"""
_LADDER = " ".join(f"WHEN n <= {2**k} THEN {2**k}" for k in range(11))
HISTOGRAM = f"""
hist AS (
  SELECT CAST(bucket AS BIGINT) AS bucket, count(*) AS n_features
  FROM (SELECT CASE {_LADDER} ELSE -1 END AS bucket FROM freq) WHERE bucket <> -1 GROUP BY bucket)"""

ROC = """
ranked AS (SELECT obs_id, label, round(p, 9) AS p FROM scored),
totals AS (SELECT sum(label) AS pos, count(*) - sum(label) AS neg FROM ranked)"""
ROC_BY_ROW = """
SELECT obs_id, p, rank, tp, rank - tp AS fp, round(tp / pos, 6) AS tpr, round((rank - tp) / neg, 6) AS fpr
FROM (
  SELECT obs_id, p, row_number() OVER w AS rank, sum(label) OVER w AS tp
  FROM ranked WINDOW w AS (ORDER BY p DESC, obs_id ROWS UNBOUNDED PRECEDING)), totals"""
ROC_CURVE = """
SELECT threshold, tp, seen - tp AS fp, round(tp / pos, 6) AS tpr, round((seen - tp) / neg, 6) AS fpr
FROM (
  SELECT p AS threshold, sum(pos) OVER w AS tp, sum(n) OVER w AS seen
  FROM (SELECT p, count(*) AS n, sum(label) AS pos FROM ranked GROUP BY p)
  WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)), totals"""

# ------------------------------------------------------------------ gradient descent


def _mixed(x: str) -> str:
    """32 bits spread over all places, as the row draws of mini-batches do."""
    for _ in range(2):
        x = f"(xor({x}, {x} >> 16) * 73244475 & 4294967295)"
    return f"xor({x}, {x} >> 16)"


def descent(
    encoded: str,
    split: str,
    dimension: str,
    models: list[tuple[float, float]],
    iterations: int,
    tol: float,
    reg_type: str | None = "l2",
    intercept: bool = True,
    fraction: float = 1.0,
):
    """CTEs ending in ``fitted(model_id, w, steps)``; w is a list with the intercept, if there is one, last.

    The state of all models is one row per model; a model that has converged
    stops producing rows.
    """
    cells = ", ".join(f"({k}, {s!r}::DOUBLE, {r!r}::DOUBLE)" for k, (s, r) in enumerate(models))
    bias = f"UNION ALL SELECT obs_id, label, d, 1 FROM labelled, dim WHERE split = '{split}'" if intercept else ""
    eta, g = "step / sqrt(i + 1)", "coalesce(g, 0) / n"
    new = {
        "l2": f"x * (1 - {eta} * reg) - {eta} * {g}",
        "l1": f"sign(x - {eta} * {g}) * greatest(abs(x - {eta} * {g}) - {eta} * reg, 0)",
        None: f"x - {eta} * {g}",
    }[reg_type]
    size = f"size AS (SELECT count(*) AS n FROM labelled WHERE split = '{split}')"
    drawn, sizes = "true", "size"
    if fraction < 1:
        size = f"""draws AS MATERIALIZED (
  SELECT obs_id, CAST('0x' || substr(md5('batch:42:' || CAST(obs_id AS VARCHAR)), 1, 8) AS BIGINT) AS base
  FROM labelled WHERE split = '{split}'),
batch AS MATERIALIZED (
  SELECT turn, obs_id FROM (
    SELECT k AS turn, obs_id, xor(base, {_mixed("k")}) AS bits FROM draws, range(1, {iterations + 1}) AS steps(k))
  WHERE {_mixed("bits")} < {round(fraction * 2**32)}),
sizes AS MATERIALIZED (SELECT turn, count(*) AS n FROM batch GROUP BY turn)"""
        drawn = "EXISTS (SELECT 1 FROM batch WHERE turn = state.i + 1 AND batch.obs_id = entries.obs_id)"
        sizes = "sizes"
    return f"""
dim AS (SELECT {dimension} AS d),
entries AS MATERIALIZED (
  SELECT obs_id, label, idx, val FROM {encoded} WHERE split = '{split}' {bias}),
{size},
cells(model_id, step, reg) AS (VALUES {cells}),
gd(model_id, step, reg, i, w, done) AS (
  SELECT model_id, step, reg, 0,
    list_concat(list_transform(range((SELECT d FROM dim)), lambda x: 0::DOUBLE), [{"1::DOUBLE" if intercept else ""}]),
    false
  FROM cells
  UNION ALL
  SELECT model_id, step, reg, i, w, i > 1 AND {tol!r} > 0
    AND sqrt(list_sum(list_transform(list_zip(w, old), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))
      < {tol!r} * greatest(sqrt(list_sum(list_transform(w, lambda x: x * x))), 1)
  FROM (
    SELECT model_id, step, reg, i + 1 AS i, list(x ORDER BY pos) AS old, list({new} ORDER BY pos) AS w
    FROM (
      WITH state AS (
        SELECT model_id, step, reg, i, unnest(w) AS x, unnest(range(len(w))) AS pos FROM gd
        WHERE NOT done AND i < {iterations}),
      margins AS (
        SELECT obs_id, model_id, any_value(label) AS label, sum(val * x) AS m
        FROM entries JOIN state ON idx = pos WHERE {drawn} GROUP BY obs_id, model_id),
      gradient AS (
        SELECT model_id AS m_id, idx, sum(val * (1 / (1 + exp(-m)) - margins.label)) AS g
        FROM entries JOIN margins ON entries.obs_id = margins.obs_id GROUP BY ALL)
      SELECT * FROM state LEFT JOIN gradient ON model_id = m_id AND pos = idx
      JOIN {sizes} ON {"turn = state.i + 1" if fraction < 1 else "true"})
    GROUP BY model_id, step, reg, i)),
fitted AS (
  SELECT model_id, step, reg, max(i) AS steps, arg_max(w, i) AS w FROM gd GROUP BY model_id, step, reg)"""


WEIGHTS = """
SELECT CASE WHEN pos = d THEN -1 ELSE pos END AS idx, round(x, 6) AS weight
FROM (SELECT unnest(w) AS x, unnest(range(len(w))) AS pos FROM fitted), dim"""


def fit_ohe(iterations: int, tol: float, model: tuple[float, float] = (10.0, 1e-6), **kind) -> str:
    gd = descent("enc", "train", "(SELECT count(*) FROM dict)", [model], iterations, tol, **kind)
    return query("events", OBSERVATIONS, DICTIONARY, OHE, gd, select=WEIGHTS, recursive=True)


# all four cells on hashed features, then scored on the rows of each split
SEARCH = [(1.0, 1e-6), (1.0, 1e-3), (10.0, 1e-6), (10.0, 1e-3)]
SEARCHED = f"""
weight AS (SELECT model_id, unnest(w) AS x, unnest(range(len(w))) AS pos FROM fitted),
dot AS (
  SELECT model_id, obs_id, sum(val * x) AS m FROM enc JOIN weight ON idx = pos GROUP BY ALL),
losses AS (
  SELECT model_id, step, reg, split, avg({log_loss("p", "label")}) AS log_loss
  FROM (
    SELECT f.model_id, f.step, f.reg, l.split, l.label,
      1 / (1 + exp(-least(greatest(coalesce(m, 0) + w[-1], -20), 20))) AS p
    FROM labelled l CROSS JOIN fitted f LEFT JOIN dot ON dot.obs_id = l.obs_id AND dot.model_id = f.model_id)
  GROUP BY ALL),
base AS (
  SELECT split, avg({log_loss("rate", "label")}) AS baseline
  FROM labelled, (SELECT avg(label) AS rate FROM labelled WHERE split = 'train') GROUP BY split)"""


def search(
    select: str, models: list[tuple[float, float]] = SEARCH, iterations: int = 500, tol: float = 1e-3
) -> str:
    gd = descent("enc", "train", "32768", models, iterations, tol)
    return query("events", OBSERVATIONS, hashed(32768), gd, SEARCHED, select=select, recursive=True)


# the one-hot model of fit_sgd, with the score of every row
TRAINED_SCORES = """
weight AS (SELECT unnest(w) AS x, unnest(range(len(w))) AS pos FROM fitted),
dot AS (SELECT obs_id, sum(val * x) AS m FROM enc JOIN weight ON idx = pos GROUP BY obs_id),
scored AS (
  SELECT l.obs_id, l.split, l.label, 1 / (1 + exp(-least(greatest(coalesce(m, 0) + w[-1], -20), 20))) AS p
  FROM fitted CROSS JOIN labelled l LEFT JOIN dot ON dot.obs_id = l.obs_id)"""


def trained(*ctes: str, select: str) -> str:
    gd = descent("enc", "train", "(SELECT count(*) FROM dict)", [(10.0, 1e-6)], 50, 1e-3)
    return query(
        "events", OBSERVATIONS, DICTIONARY, OHE, gd, TRAINED_SCORES, *ctes, select=select, recursive=True
    )


# ------------------------------------------------------------------ many fixed models


def fixed_grid(steps: list[float], regs: list[float]) -> str:
    """CTE ``cells(grid_order, step_size, reg_param, log_loss)`` over the validation rows."""
    pairs = [(s, r) for s in steps for r in regs]
    values = ", ".join(f"({k}, {s!r}::DOUBLE, {r!r}::DOUBLE)" for k, (s, r) in enumerate(pairs))
    return f"""
grid(grid_order, step_size, reg_param) AS (VALUES {values}),
margin AS (
  SELECT grid_order, obs_id, sum(val * ((idx * 7919 + grid_order * 104729) % 1000 / 1000.0::DOUBLE - 0.5)) AS m
  FROM enc, grid GROUP BY ALL),
cells AS (
  SELECT grid_order, step_size, reg_param, avg({log_loss("p", "label")}) AS log_loss
  FROM (
    SELECT g.*, l.label, 1 / (1 + exp(-least(greatest(coalesce(m, 0) - 1, -20), 20))) AS p
    FROM labelled l CROSS JOIN grid g
    LEFT JOIN margin s ON s.obs_id = l.obs_id AND s.grid_order = g.grid_order
    WHERE l.split = 'validation')
  GROUP BY ALL)"""


def grid_query(steps: list[float], regs: list[float], select: str) -> str:
    return query("events", OBSERVATIONS, DICTIONARY, OHE, fixed_grid(steps, regs), select=select)


STEPS, REGS = [1.0, 10.0], [1e-6, 1e-3]
MATRIX_STEPS = [3.0, 6.0, 9.0, 12.0, 15.0, 18.0]
MATRIX_REGS = [1e-7, 1e-6, 1e-5, 1e-4, 1e-3, 1e-2]
CELLS = "SELECT CAST(grid_order AS INTEGER) AS grid_order, step_size, reg_param, round(log_loss, 6) AS log_loss FROM cells"
_MATRIX_COLUMNS = ", ".join(
    f"round(min(CASE WHEN reg_param = {r!r}::DOUBLE THEN log_loss END), 6) AS reg_{k}"
    for k, r in enumerate(MATRIX_REGS)
)

ORACLES = {
    "load_lines": query("events", select="SELECT raw AS line FROM lines"),
    "normalize_lines": query("events", select="SELECT obs_id, replace(raw, chr(9), ',') AS line FROM lines"),
    "preview_k": query(
        "events", select="SELECT obs_id, replace(raw, chr(9), ',') AS line FROM lines ORDER BY obs_id LIMIT 5"
    ),
    "load_lines_ids": query("events", select="SELECT count(*) AS n_lines, count(*) AS n_ids FROM lines"),
    "load_lines_partitions": query(
        "events", select="SELECT count(*) AS n_lines, count(*) AS n_ids, true AS enough, true AS even FROM lines"
    ),
    "row_count_check": query(
        "events",
        select="""SELECT count(*) AS actual, (SELECT count(*) FROM events) AS expected,
  count(*) = (SELECT count(*) FROM events) AS ok FROM lines""",
    ),
    "random_split": query(
        "events",
        select="""SELECT count(*) AS n_rows, count(DISTINCT obs_id) AS n_ids, 0::BIGINT AS n_shared,
  true AS sizes_ok FROM lines""",
    ),
    "parse_observations": parsed("events", PARSE),
    "parse_observations_orders": parsed("orders", PARSE),
    "explode_features": parsed("events", EXPLODE),
    "explode_features_orders": parsed("orders", EXPLODE),
    "hash_split": parsed("events", "SELECT obs_id, split FROM obs"),
    "split_counts": parsed("events", "SELECT split, count(*) AS n FROM obs GROUP BY split"),
    "cached_splits": parsed(
        "events", "SELECT split, count(*) AS n, true AS is_cached FROM obs GROUP BY split"
    ),
    "categories_per_feature": parsed("events", CATEGORIES),
    "categories_per_feature_orders": parsed("orders", CATEGORIES),
    "categories_per_feature_documents": parsed("all documents", CATEGORIES),
    "ohe_dictionary": query("events", OBSERVATIONS, DICTIONARY, select="SELECT feature_id, value, idx FROM dict"),
    "ohe_dimension": query("events", OBSERVATIONS, DICTIONARY, select=DIMENSION),
    "ohe_dimension_orders": query("orders", OBSERVATIONS, DICTIONARY, select=DIMENSION),
    "encode_ohe": ohe("events", ENCODED),
    "encode_ohe_orders": ohe("orders", ENCODED),
    "encode_ohe_shuffled": ohe("orders", ENCODED),
    "encode_ohe_unseen": ohe("orders", "SELECT obs_id, split, idx, val FROM enc WHERE split <> 'train'"),
    "encode_ohe_ml": ohe("events", ENCODED),
    "encode_ohe_ml_unseen": ohe("events", "SELECT obs_id, idx, val FROM enc WHERE split <> 'train'"),
    "encoded_store": ohe("events", "SELECT obs_id, split, idx, val FROM enc"),
    "encoded_store_join": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, hashed(32768).replace("enc AS", "henc AS"),
        select="""
SELECT l.obs_id, (SELECT count(*) FROM enc WHERE enc.obs_id = l.obs_id)::INTEGER AS nnz_ohe,
  (SELECT count(*) FROM henc WHERE henc.obs_id = l.obs_id)::INTEGER AS nnz_hashed
FROM labelled l WHERE split = 'validation'""",
    ),
    "unseen_features": ohe("orders", UNSEEN),
    "unseen_features_shuffled": ohe("orders", UNSEEN),
    "nnz_per_row": ohe(
        "orders",
        """SELECT l.obs_id, CAST(count(e.idx) AS INTEGER) AS nnz
FROM labelled l LEFT JOIN enc e ON l.obs_id = e.obs_id GROUP BY l.obs_id""",
    ),
    "total_nnz": ohe("orders", "SELECT split, count(*) AS total_nnz FROM enc GROUP BY split"),
    "feature_frequency": query("events", OBSERVATIONS, DICTIONARY, OHE, FREQUENCY, select="SELECT idx, n FROM freq"),
    "feature_frequency_hashed": query(
        "events", OBSERVATIONS, hashed(32768), select="SELECT idx, count(*) AS n FROM enc GROUP BY idx"
    ),
    "frequency_histogram": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, FREQUENCY, HISTOGRAM, select="SELECT bucket, n_features FROM hist"
    ),
    "frequency_histogram_log": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, FREQUENCY, HISTOGRAM,
        select="""SELECT bucket, n_features, round(ln(bucket), 6) AS ln_bucket,
  round(ln(n_features), 6) AS ln_features FROM hist""",
    ),
    "sparsity": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, hashed(32768).replace("enc AS", "henc AS"),
        """
rows AS (SELECT count(*) AS n FROM labelled WHERE split = 'train')""",
        select="""
SELECT 'ohe' AS encoding, round(count(*) / any_value(n) / (SELECT count(*) FROM dict), 9) AS sparsity
FROM enc, rows WHERE split = 'train'
UNION ALL
SELECT 'hashed', round(count(*) / any_value(n) / 32768, 9) FROM henc, rows WHERE split = 'train'""",
    ),
    "metric_formats": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, hashed(32768).replace("enc AS", "henc AS"),
        f"""
rows AS (SELECT count(*) AS n FROM labelled WHERE split = 'train'),
base AS (SELECT split, avg({log_loss("rate", "label")}) AS loss
  FROM labelled, (SELECT avg(label) AS rate FROM labelled WHERE split = 'train') GROUP BY split)""",
        select="""
SELECT 'baseline ' || split AS metric, printf('%.3f', loss) AS text FROM base
UNION ALL
SELECT 'sparsity ohe', printf('%.7e', round(count(*) / any_value(n) / (SELECT count(*) FROM dict), 9))
FROM enc, rows WHERE split = 'train'
UNION ALL
SELECT 'sparsity hashed', printf('%.7e', round(count(*) / any_value(n) / 32768, 9))
FROM henc, rows WHERE split = 'train'""",
    ),
    "first_k_sum": query(
        "events", OBSERVATIONS, hashed(32768), """
firsts AS (SELECT obs_id, label FROM labelled ORDER BY obs_id LIMIT 20)""",
        select="""
SELECT 'nnz' AS what, CAST(count(*) AS DOUBLE) AS total FROM enc WHERE obs_id IN (SELECT obs_id FROM firsts)
UNION ALL SELECT 'label', sum(label) FROM firsts""",
    ),
    "row_logloss": fixed_scored(f"SELECT obs_id, label, round({log_loss('p', 'label')}, 6) AS log_loss FROM scored"),
    "class_rate": parsed("events", CLASS_RATE),
    "class_rate_documents": parsed("documents", CLASS_RATE),
    "baseline_logloss": parsed("events", BASELINE),
    "baseline_logloss_orders": parsed("orders", BASELINE),
    "hash_bucket": parsed(
        "events",
        f"""SELECT obs_id, feature_id, feature, {bucket("feature", 1000003)} AS bucket
FROM (SELECT *, value || CAST(feature_id AS VARCHAR) AS feature FROM feats)""",
    ),
    "hash_bucket_orders": parsed(
        "orders",
        f"""SELECT obs_id, feature_id, feature, {bucket("feature", 32768)} AS bucket
FROM (SELECT *, value || CAST(feature_id AS VARCHAR) AS feature FROM feats)""",
    ),
    "encode_hashed": query("events", OBSERVATIONS, hashed(32768), select=ENCODED),
    "encode_hashed_orders": query("orders", OBSERVATIONS, hashed(32768), select=ENCODED),
    "encode_hashed_collisions": query("events", OBSERVATIONS, hashed(7), select=ENCODED),
    "predict_proba": fixed_scored("SELECT obs_id, label, round(p, 6) AS p FROM scored"),
    "predict_proba_shuffled": fixed_scored("SELECT obs_id, label, round(p, 6) AS p FROM scored"),
    "predict_proba_ml": fixed_scored("SELECT obs_id, label, round(p, 6) AS p FROM scored"),
    "predict_proba_hashed": query(
        "orders", OBSERVATIONS, hashed(32768), FIXED_SCORES,
        select="SELECT obs_id, label, round(p, 6) AS p FROM scored",
    ),
    "prediction_sum": fixed_scored("SELECT round(sum(p), 6) AS sum_p FROM scored"),
    "evaluate_logloss": fixed_scored(
        f"SELECT split, round(avg({log_loss('p', 'label')}), 6) AS log_loss FROM scored GROUP BY split"
    ),
    "bottom_k_weights": query(
        "events", OBSERVATIONS, DICTIONARY,
        select="""SELECT idx, round((idx * 7919) % 1000 / 1000.0::DOUBLE - 0.5, 6) AS weight
FROM dict ORDER BY weight, idx LIMIT 5""",
    ),
    "roc_points_by_row": query(
        "events", OBSERVATIONS, DICTIONARY, OHE, FIXED_SCORES, ROC, select=ROC_BY_ROW
    ),
    "roc_curve": query("events", OBSERVATIONS, DICTIONARY, OHE, FIXED_SCORES, ROC, select=ROC_CURVE),
    "gd_step_1": fit_ohe(1, 0.0),
    "gd_step_3": fit_ohe(3, 0.0),
    "gd_step_shuffled": fit_ohe(2, 0.0),
    "fit_sgd": fit_ohe(50, 1e-3),
    "fit_sgd_l1": fit_ohe(20, 1e-3, (10.0, 1e-3), reg_type="l1"),
    "fit_sgd_unregularised": fit_ohe(20, 1e-3, reg_type=None),
    "fit_sgd_no_intercept": fit_ohe(20, 1e-3, intercept=False),
    "fit_sgd_batches": fit_ohe(10, 1e-3, fraction=0.5),
    "gd_step_l1_shuffled": fit_ohe(2, 0.0, (10.0, 1e-3), reg_type="l1", intercept=False),
    "gd_step_batches_shuffled": fit_ohe(2, 0.0, fraction=0.5),
    "grid_search": search(
        """SELECT CAST(model_id AS INTEGER) AS grid_order, step AS step_size, reg AS reg_param,
  round(log_loss, 6) AS log_loss FROM losses WHERE split = 'validation'"""
    ),
    "model_report": search(
        """SELECT losses.split, step AS step_size, reg AS reg_param,
  round(log_loss, 6) AS log_loss, round(baseline, 6) AS baseline_log_loss
FROM losses JOIN base ON losses.split = base.split
WHERE model_id = (SELECT model_id FROM losses WHERE split = 'validation' ORDER BY log_loss, model_id LIMIT 1)"""
    ),
    "ohe_report": trained(
        select=f"""SELECT s.split, round(avg({log_loss("p", "s.label")}), 6) AS log_loss,
  round(any_value(baseline), 6) AS baseline_log_loss, round(sum(p), 4) AS sum_p
FROM scored s JOIN (
  SELECT split, avg({log_loss("rate", "label")}) AS baseline
  FROM labelled, (SELECT avg(label) AS rate FROM labelled WHERE split = 'train') GROUP BY split) b
  ON s.split = b.split GROUP BY s.split"""
    ),
    "roc_curve_trained": trained(
        """
ranked AS (SELECT obs_id, label, round(p, 6) AS p FROM scored WHERE split = 'validation'),
totals AS (SELECT sum(label) AS pos, count(*) - sum(label) AS neg FROM ranked)""",
        select=ROC_CURVE,
    ),
    "grid_matrix_fitted": search(
        f"""SELECT step_size, {_MATRIX_COLUMNS} FROM (
  SELECT step AS step_size, reg AS reg_param, log_loss FROM losses WHERE split = 'validation') GROUP BY step_size""",
        [(s, r) for s in MATRIX_STEPS for r in MATRIX_REGS],
        3,
        0.0,
    ),
    "grid_evaluate": grid_query(STEPS, REGS, CELLS),
    "grid_best": grid_query(STEPS, REGS, f"{CELLS} ORDER BY cells.log_loss, grid_order LIMIT 1"),
    "grid_matrix": grid_query(
        MATRIX_STEPS, MATRIX_REGS, f"SELECT step_size, {_MATRIX_COLUMNS} FROM cells GROUP BY step_size"
    ),
}
