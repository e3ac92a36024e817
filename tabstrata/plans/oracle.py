"""DuckDB SQL equivalents of the registered queries (the driver's oracle).

Written independently of the Spark code: plain SQL over the driver tables,
using window functions and self-joins freely since this only runs at the
small check scale.
"""

from __future__ import annotations

from ..functions.scalars import cumulative_thresholds
from . import catalog as C

SEED = C.SEED


def u(tag: str, id_expr: str, seed=SEED) -> str:
    return (f"(cast('0x' || substr(md5('{seed}-{tag}-' || cast({id_expr} AS VARCHAR)), 1, 8) AS BIGINT)"
            f" / 4294967296.0::DOUBLE)")


def na(tag: str, expr: str) -> str:
    return f"CASE WHEN {u(tag, 'event_id')} < {C.MISSING_PCT}::DOUBLE THEN NULL ELSE {expr} END"


POSTS = f"""posts AS (
  SELECT event_id AS post_id,
         hour(ts) + minute(ts) / 60.0::DOUBLE AS post_hour,
         cast(isodow(ts) - 1 AS INTEGER) AS post_day,
         event_type AS category,
         try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
         user_id, value AS target
  FROM events)"""

POSTS_NA = f"""posts_na AS (
  SELECT event_id AS post_id,
         {na('post_hour', 'hour(ts) + minute(ts) / 60.0::DOUBLE')} AS post_hour,
         {na('post_day', 'cast(isodow(ts) - 1 AS INTEGER)')} AS post_day,
         {na('category', 'event_type')} AS category,
         {na('k', "try_cast(json_extract_string(props, '$.k') AS INTEGER)")} AS k,
         {na('user_id', 'user_id')} AS user_id,
         value AS target
  FROM events)"""

LINE_PRED = f"""lp AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, {C.ROW_ID} AS row_id,
         l_extendedprice AS label, l_quantity * 1500.0::DOUBLE AS prediction,
         l_quantity * 1000.0::DOUBLE + 10000.0::DOUBLE AS prediction_b
  FROM lineitem)"""


def r(expr: str, d: int = 6) -> str:
    return f"round({expr}, {d})"


def metric_select(y: str, p: str, d: int) -> str:
    e = f"({y} - {p})"
    sst = f"(var_pop({y}) * count(*))"
    r2 = (f"CASE WHEN {sst} > 0 THEN 1.0::DOUBLE - sum({e} * {e}) / {sst} "
          f"WHEN sum({e} * {e}) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
    return (f"{r(f'avg({e} * {e})', d)} AS mse, {r(f'sqrt(avg({e} * {e}))', d)} AS rmse, "
            f"{r(f'avg(abs({e}))', d)} AS mae, {r(r2, d)} AS r2, "
            f"{r(f'avg(abs({e} / greatest(abs({y}), 1e-7::DOUBLE)) * 100.0::DOUBLE)', d)} AS mape")


def case_bucket(u_expr: str, weights, normalize=False) -> str:
    th = cumulative_thresholds(weights, normalize)
    parts = " ".join(f"WHEN {u_expr} < {t!r}::DOUBLE THEN {i}" for i, t in enumerate(th))
    return f"CASE {parts} ELSE {len(weights) - 1} END"


def iqr_cte(name: str, src: str, col: str) -> str:
    return (f"{name} AS (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3, "
            f"quantile_cont({col}, 0.25) - 1.5::DOUBLE * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS lo, "
            f"quantile_cont({col}, 0.75) + 1.5::DOUBLE * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi "
            f"FROM {src})")


def outside(col: str, b: str) -> str:
    return f"coalesce({col} < {b}.lo OR {col} > {b}.hi, false)"


POST_NUM = C.POST_NUM
LINE_COLS = C.LINE_COLS

SQL: dict[str, str] = {}

SQL["mean_std_by_hour"] = f"""
WITH {POSTS_NA},
m AS (SELECT avg(post_hour) AS mh FROM posts_na),
p1 AS (SELECT post_id, coalesce(cast(post_hour AS DOUBLE), m.mh) AS post_hour, target FROM posts_na, m),
{iqr_cte('b', 'p1', 'target')},
t AS (SELECT post_hour, CASE WHEN target IS NOT NULL THEN least(greatest(cast(target AS DOUBLE), b.lo), b.hi) END AS y
      FROM p1, b)
SELECT cast(floor(post_hour) AS INTEGER) AS hour, count(y) AS count, {r('avg(y)')} AS mean,
       {r('stddev_samp(y)')} AS std, {r('avg(y) - stddev_samp(y)')} AS lower, {r('avg(y) + stddev_samp(y)')} AS upper
FROM t WHERE floor(post_hour) IS NOT NULL GROUP BY 1"""

SQL["inject_missing"] = f"""
WITH {POSTS_NA}
SELECT post_id, {r('post_hour')} AS post_hour, post_day, category, k, user_id, {r('target')} AS target FROM posts_na"""

SQL["weighted_bucket"] = f"""
SELECT event_id, {case_bucket(u('images', 'event_id'), C.IMAGE_WEIGHTS)} AS images_count,
       {case_bucket(u('hashtags', 'event_id'), C.HASHTAG_WEIGHTS, True)} AS hashtags_count
FROM events"""

SQL["csv_round_trip"] = "SELECT * FROM supplier"

SQL["metrics_sink"] = f"""
WITH {LINE_PRED}
SELECT l_returnflag, {metric_select('label', 'prediction', 4)}, count(*) AS n FROM lp GROUP BY l_returnflag"""

_L = "l_quantity * 10"
_I = "l_linenumber"
_T = "p_size"
_FO = "p_retailprice"
_H = "(l_discount * 100 + l_tax * 100)"
_D = "(isodow(l_shipdate) - 1)"
_SCORE = (f"(-0.00005::DOUBLE * pow({_L} - 100, 2) + 0.5::DOUBLE + 0.7::DOUBLE * ln(1 + {_I}) "
          f"+ 0.4::DOUBLE * ln(1 + {_T}) - 0.01::DOUBLE * pow({_T}, 2) - 0.3::DOUBLE * log10({_FO} + 1) + 2.0::DOUBLE "
          f"+ 0.5::DOUBLE * sin(({_H} - 8) * pi() / 12) + 0.3::DOUBLE * CASE WHEN {_D} >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)")
SQL["engagement_score"] = f"""
SELECT l_orderkey, l_linenumber, {r(f'least(greatest({_SCORE} * 2, 0.1::DOUBLE), 15.0::DOUBLE)')} AS engagement_rate
FROM lineitem JOIN part ON l_partkey = p_partkey"""

_TWO_PI = "6.283185307179586::DOUBLE"
SQL["time_features"] = f"""
WITH {POSTS_NA}
SELECT post_id, {r('post_hour')} AS post_hour, post_day,
  {r(f'sin({_TWO_PI} * post_hour / 24.0::DOUBLE)')} AS hour_sin,
  {r(f'cos({_TWO_PI} * post_hour / 24.0::DOUBLE)')} AS hour_cos,
  CASE WHEN post_hour >= 5 AND post_hour < 12 THEN 'morning'
       WHEN post_hour >= 12 AND post_hour < 17 THEN 'afternoon'
       WHEN post_hour >= 17 AND post_hour < 21 THEN 'evening'
       WHEN post_hour >= 21 OR post_hour < 5 THEN 'night' ELSE 'unknown' END AS time_of_day,
  coalesce(cast((post_hour BETWEEN 7 AND 9) OR (post_hour BETWEEN 17 AND 19) AS INTEGER), 0) AS is_peak_hour,
  {r(f'sin({_TWO_PI} * post_day / 7.0::DOUBLE)')} AS day_sin,
  {r(f'cos({_TWO_PI} * post_day / 7.0::DOUBLE)')} AS day_cos,
  coalesce(cast(post_day >= 5 AS INTEGER), 0) AS is_weekend,
  cast(floor(post_hour) AS INTEGER) AS hour_bucket
FROM posts_na"""

SQL["clip"] = f"""
SELECT event_id, {r('CASE WHEN value IS NOT NULL THEN least(greatest(value, 1.0::DOUBLE), 100.0::DOUBLE) END')} AS value_clipped
FROM events"""

SQL["iqr_filter"] = f"""
WITH {iqr_cte('b', 'documents', 'n_chars')}
SELECT doc_id, n_chars FROM documents, b
WHERE n_chars < b.lo OR n_chars > b.hi"""

SQL["iqr_flag"] = f"""
WITH {POSTS_NA}, {iqr_cte('bk', 'posts_na', 'k')}, {iqr_cte('bt', 'posts_na', 'target')}
SELECT post_id, cast({outside('k', 'bk')} OR {outside('target', 'bt')} AS INTEGER) AS is_outlier
FROM posts_na, bk, bt"""

SQL["iqr_remove"] = f"""
WITH {POSTS_NA}, {iqr_cte('bk', 'posts_na', 'k')}, {iqr_cte('bt', 'posts_na', 'target')}
SELECT post_id, k, {r('target')} AS target FROM posts_na, bk, bt
WHERE NOT ({outside('k', 'bk')} OR {outside('target', 'bt')})"""


def _summary_part(col: str) -> str:
    cnt = f"sum(cast({outside(col, 'b_' + col)} AS INTEGER))"
    return (f"SELECT '{col}' AS column, cast({cnt} AS BIGINT) AS outlier_count, "
            f"{r(f'{cnt} * 100.0::DOUBLE / count(*)')} AS outlier_percent, "
            f"{r(f'any_value(b_{col}.lo)')} AS lower_bound, {r(f'any_value(b_{col}.hi)')} AS upper_bound, "
            f"'clip' AS treatment FROM posts_na, b_{col}")


_OS_COLS = ["post_hour", "post_day", "k", "target"]
SQL["outlier_summary"] = (f"WITH {POSTS_NA}, " + ", ".join(iqr_cte(f"b_{c}", "posts_na", c) for c in _OS_COLS)
                          + "\n" + "\nUNION ALL\n".join(_summary_part(c) for c in _OS_COLS))

SQL["iqr_treat"] = f"""
WITH {iqr_cte('bs', 'part', 'p_size')}, {iqr_cte('bp', 'part', 'p_retailprice')}
SELECT p_partkey,
  {r('least(greatest(cast(p_size AS DOUBLE), bs.lo), bs.hi)')} AS p_size,
  {r('least(greatest(p_retailprice, bp.lo), bp.hi)')} AS p_retailprice
FROM part, bs, bp"""

SQL["select_numeric"] = "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IS NOT NULL"

SQL["error_columns"] = f"""
WITH {LINE_PRED}
SELECT row_id, {r('label - prediction', 4)} AS residual, {r('abs(label - prediction)', 4)} AS abs_error,
  {r('abs((label - prediction) / greatest(abs(label), 1e-7::DOUBLE)) * 100.0::DOUBLE', 4)} AS pct_error
FROM lp"""

_R2 = ("CASE WHEN var_pop(label) * count(*) > 0 THEN 1.0::DOUBLE - sum((label - prediction) * (label - prediction)) "
       "/ (var_pop(label) * count(*)) WHEN sum((label - prediction) * (label - prediction)) = 0 THEN 1.0::DOUBLE "
       "ELSE 0.0::DOUBLE END")
SQL["fit_band"] = f"""
WITH {LINE_PRED}, m AS (SELECT l_returnflag, {_R2} AS r2 FROM lp GROUP BY l_returnflag)
SELECT l_returnflag, {r('r2')} AS r2,
  CASE WHEN r2 > 0.9 THEN 'excellent' WHEN r2 > 0.7 THEN 'good' WHEN r2 > 0.5 THEN 'moderate' ELSE 'poor' END AS fit
FROM m"""


def _describe_part(col: str, src: str) -> str:
    x = f"cast({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS column, count({x}) AS count, {r(f'avg({x})')} AS mean, {r(f'stddev_samp({x})')} AS std, "
            f"{r(f'min({x})')} AS min, {r(f'quantile_cont({x}, 0.25)')} AS q25, {r(f'quantile_cont({x}, 0.5)')} AS q50, "
            f"{r(f'quantile_cont({x}, 0.75)')} AS q75, {r(f'max({x})')} AS max FROM {src}")


SQL["describe"] = f"WITH {POSTS_NA}\n" + "\nUNION ALL\n".join(_describe_part(c, "posts_na") for c in POST_NUM)

SQL["shape"] = """
SELECT count(*) AS n_rows, 6 AS n_columns,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
  'o_orderkey,o_custkey,o_totalprice' AS numeric_columns,
  'o_orderstatus,o_orderdate,o_orderpriority' AS categorical_columns
FROM orders"""

_ALL_POST = ["post_id", "post_hour", "post_day", "category", "k", "user_id", "target"]


def _missing_part(col: str) -> str:
    m = f"cast(sum(cast({col} IS NULL AS INTEGER)) AS BIGINT)"
    return (f"SELECT '{col}' AS column, {m} AS missing_count, {r(f'{m} * 100.0::DOUBLE / count(*)')} AS missing_percent "
            f"FROM posts_na")


SQL["missing"] = f"WITH {POSTS_NA}\n" + "\nUNION ALL\n".join(_missing_part(c) for c in _ALL_POST)

SQL["value_counts"] = """
SELECT 'o_orderstatus' AS column, o_orderstatus AS value, count(*) AS count FROM orders
WHERE o_orderstatus IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'o_orderpriority' AS column, o_orderpriority AS value, count(*) AS count FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY 2"""

SQL["distinct"] = f"WITH {POSTS_NA}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, cast(count(DISTINCT {c}) + max(cast({c} IS NULL AS INTEGER)) AS BIGINT) AS n_unique "
    f"FROM posts_na" for c in _ALL_POST)


def _quant_part(col: str) -> str:
    q1, q3 = f"quantile_cont({col}, 0.25)", f"quantile_cont({col}, 0.75)"
    return (f"SELECT '{col}' AS column, {r(q1)} AS q1, {r(q3)} AS q3, {r(f'{q3} - {q1}')} AS iqr, "
            f"{r(f'{q1} - 1.5::DOUBLE * ({q3} - {q1})')} AS lower, {r(f'{q3} + 1.5::DOUBLE * ({q3} - {q1})')} AS upper "
            f"FROM lineitem")


SQL["quantiles"] = "\nUNION ALL\n".join(_quant_part(c) for c in LINE_COLS)


def _corr_long(cols: list[str], src: str, lower_only: bool = False) -> str:
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if lower_only and not i > j:
                continue
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr(cast({a} AS DOUBLE), cast({b} AS DOUBLE))')} AS corr FROM {src}")
    return "\nUNION ALL\n".join(parts)


SQL["corr_pearson"] = _corr_long(LINE_COLS, "lineitem")
SQL["corr_lower"] = _corr_long(LINE_COLS, "lineitem", lower_only=True)

_RANKS = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}"
                   for c in LINE_COLS)
SQL["corr_spearman"] = f"WITH rk AS (SELECT {_RANKS} FROM lineitem)\n" + _corr_long(LINE_COLS, "rk")


_NULLED = ", ".join(f"CASE WHEN NOT ({where}) THEN {c} END AS {c}" for c, where in C.NULL_WHERE.items())


def _spearman_pair(a: str, b: str) -> str:
    rank = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0::DOUBLE"
    return (f"SELECT '{a}' AS x, '{b}' AS y, {r('corr(ra, rb)')} AS corr FROM (SELECT {rank.format(a)} AS ra, {rank.format(b)} AS rb "
            f"FROM nulled WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")


SQL["corr_spearman_nulls"] = (f"WITH nulled AS (SELECT {_NULLED} FROM lineitem)\n"
                              + "\nUNION ALL\n".join(_spearman_pair(a, b) for a in LINE_COLS for b in LINE_COLS))


def _kendall(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS x, '{b}' AS y, {r('s.S / sqrt((t.n0 - t1.n1) * (t.n0 - t2.n2))')} AS corr, true AS exact
FROM (SELECT sum(c1.n * c2.n * sign(c1.a - c2.a) * sign(c1.b - c2.b)) / 2.0 AS S
      FROM (SELECT {a} AS a, {b} AS b, count(*) AS n FROM lineitem GROUP BY 1, 2) c1,
           (SELECT {a} AS a, {b} AS b, count(*) AS n FROM lineitem GROUP BY 1, 2) c2) s,
     (SELECT count(*) * (count(*) - 1) / 2.0 AS n0 FROM lineitem) t,
     (SELECT sum(n * (n - 1) / 2.0) AS n1 FROM (SELECT count(*) AS n FROM lineitem GROUP BY {a})) t1,
     (SELECT sum(n * (n - 1) / 2.0) AS n2 FROM (SELECT count(*) AS n FROM lineitem GROUP BY {b})) t2"""


_KC = ["l_quantity", "l_discount", "l_tax"]
SQL["corr_kendall"] = "\nUNION ALL\n".join(
    [_kendall(a, b) for i, a in enumerate(_KC) for j, b in enumerate(_KC) if i != j]
    + [f"SELECT '{c}' AS x, '{c}' AS y, 1.0::DOUBLE AS corr, true AS exact" for c in _KC])

SQL["corr_target"] = f"WITH {POSTS_NA}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r(f'corr(cast({c} AS DOUBLE), target)')} AS corr FROM posts_na"
    for c in POST_NUM if c != "target")

SQL["ols_line"] = f"""
SELECT {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
       {r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept,
       cast(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem"""

SQL["mean_std_by_type"] = f"""
SELECT event_type, count(value) AS count, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std,
  {r('avg(value) - stddev_samp(value)')} AS lower, {r('avg(value) + stddev_samp(value)')} AS upper
FROM events GROUP BY event_type"""

SQL["metrics"] = f"WITH {LINE_PRED}\nSELECT {metric_select('label', 'prediction', 4)}, count(*) AS n FROM lp"

SQL["residual_stats"] = f"""
WITH {LINE_PRED}
SELECT {r('avg(label - prediction)', 4)} AS mean, {r('stddev_pop(label - prediction)', 4)} AS std,
  {r('min(label - prediction)', 4)} AS min, {r('max(label - prediction)', 4)} AS max FROM lp"""


def _ewbin(x: str, lo: str, hi: str, k: int) -> str:
    return (f"cast(least(greatest(CASE WHEN ({hi} - {lo}) / {k} > 0 THEN floor(({x} - {lo}) / (({hi} - {lo}) / {k})) "
            f"ELSE 0 END, 0), {k - 1}) AS INTEGER)")


SQL["actual_pred"] = f"""
WITH {LINE_PRED},
rg AS (SELECT least(min(label), min(prediction)) AS lo, greatest(max(label), max(prediction)) AS hi FROM lp)
SELECT {_ewbin('label', 'rg.lo', 'rg.hi', 10)} AS bin_actual, {_ewbin('prediction', 'rg.lo', 'rg.hi', 10)} AS bin_pred,
  count(*) AS count, {r('any_value(rg.lo)', 4)} AS axis_min, {r('any_value(rg.hi)', 4)} AS axis_max
FROM lp, rg GROUP BY 1, 2"""

SQL["resid_bins"] = f"""
WITH {LINE_PRED}, rg AS (SELECT min(prediction) AS lo, max(prediction) AS hi FROM lp)
SELECT {_ewbin('prediction', 'rg.lo', 'rg.hi', 10)} AS bin, count(*) AS count, {r('avg(prediction)', 4)} AS mean_pred,
  {r('avg(label - prediction)', 4)} AS mean_resid, {r('stddev_samp(label - prediction)', 4)} AS std_resid,
  {r('quantile_cont(label - prediction, 0.5)', 4)} AS median_resid, {r('avg(abs(label - prediction))', 4)} AS mean_abs_resid
FROM lp, rg GROUP BY 1"""


def qcut_sql(pos0: str, n: str, k: int) -> str:
    return f"CASE WHEN {n} <= 1 THEN 1 ELSE greatest(1, cast(floor(({pos0} * {k} + {n} - 2) / ({n} - 1)) AS INTEGER)) END"


SQL["segments"] = f"""
WITH {LINE_PRED},
rk AS (SELECT label, prediction, row_number() OVER (ORDER BY label, row_id) - 1 AS pos0, count(*) OVER () AS n FROM lp),
sg AS (SELECT *, {qcut_sql('pos0', 'n', 5)} AS segment FROM rk)
SELECT segment, {r('min(label)', 4)} AS min_value, {r('max(label)', 4)} AS max_value, {r('avg(label)', 4)} AS mean_value,
  count(*) AS count, {r('sqrt(avg((label - prediction) * (label - prediction)))', 4)} AS rmse,
  {r('avg(abs(label - prediction))', 4)} AS mae,
  {r('avg(abs((label - prediction) / greatest(abs(label), 1e-7::DOUBLE)) * 100.0::DOUBLE)', 4)} AS mape,
  {r(f'CASE WHEN count(*) <= 1 THEN NULL ELSE ({_R2}) END', 4)} AS r2
FROM sg GROUP BY segment"""

_UNION_PRED = f"""{LINE_PRED},
u AS (SELECT label, prediction, 'rate_1500' AS model FROM lp
      UNION ALL SELECT label, prediction_b AS prediction, 'affine' AS model FROM lp)"""
SQL["compare_models"] = f"WITH {_UNION_PRED}\nSELECT model, {metric_select('label', 'prediction', 4)} FROM u GROUP BY model"
SQL["best_model"] = (f"WITH {_UNION_PRED}\nSELECT model, {r('avg((label - prediction) * (label - prediction))', 2)} AS mse "
                     f"FROM u GROUP BY model ORDER BY avg((label - prediction) * (label - prediction)), model LIMIT 1")

_CT = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, corr(cast({c} AS DOUBLE), target) AS corr FROM posts_na"
                           for c in POST_NUM if c != "target")
SQL["top_corr"] = f"""
WITH {POSTS_NA}, c AS ({_CT})
SELECT feature, {r('corr')} AS corr FROM c ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 3"""

SQL["sample_rows"] = f"""
SELECT event_id, ts, user_id, event_type, {r('value')} AS value, props FROM events
ORDER BY {u('sample', 'event_id')}, event_id LIMIT 5"""

SQL["global_rank"] = "SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS rank FROM events"

SQL["qcut"] = f"""
WITH rk AS (SELECT event_id, row_number() OVER (ORDER BY value, event_id) - 1 AS pos0, count(*) OVER () AS n FROM events)
SELECT event_id, {qcut_sql('pos0', 'n', 7)} AS segment FROM rk"""


def _mode_sql(col: str) -> str:
    return (f"(SELECT {col} FROM posts_na WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


_IMP_NUM = ["post_hour", "post_day", "k", "user_id"]


def _impute_sql(strategy: str) -> str:
    cols = []
    for c in _ALL_POST:
        if c in _IMP_NUM:
            if strategy == "mean":
                e = r(f"coalesce(cast({c} AS DOUBLE), (SELECT avg(cast({c} AS DOUBLE)) FROM posts_na))")
            elif strategy == "median":
                e = r(f"coalesce(cast({c} AS DOUBLE), (SELECT quantile_cont(cast({c} AS DOUBLE), 0.5) FROM posts_na))")
            elif strategy == "most_frequent":
                e = f"coalesce({c}, {_mode_sql(c)})"
                if c == "post_hour":
                    e = r(e)
            else:
                e = f"coalesce({c}, 0)"
                if c == "post_hour":
                    e = r(f"coalesce({c}, 0.0::DOUBLE)")
                elif c == "user_id":
                    e = f"coalesce({c}, cast(0 AS BIGINT))"
                else:
                    e = f"coalesce({c}, cast(0 AS INTEGER))"
        elif c == "category":
            e = f"coalesce(category, {_mode_sql('category')})"
        elif c == "target":
            e = r("target")
        else:
            e = c
        cols.append(f"{e} AS {c}")
    return f"WITH {POSTS_NA}\nSELECT {', '.join(cols)} FROM posts_na"


for _s in ("mean", "median", "most_frequent", "constant"):
    SQL[f"impute_{_s}"] = _impute_sql(_s)

_SC_COLS = ["post_hour", "post_day", "k", "target"]


def _scale_sql(method: str) -> str:
    stats = []
    for c in _SC_COLS:
        x = f"cast({c} AS DOUBLE)"
        if method == "standard":
            stats.append(f"avg({x}) AS a_{c}, CASE WHEN coalesce(stddev_pop({x}), 0) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({x}) END AS b_{c}")
        elif method == "minmax":
            stats.append(f"min({x}) AS a_{c}, CASE WHEN coalesce(max({x}) - min({x}), 0) = 0 THEN 1.0::DOUBLE ELSE max({x}) - min({x}) END AS b_{c}")
        else:
            iqr = f"(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))"
            stats.append(f"quantile_cont({x}, 0.5) AS a_{c}, CASE WHEN coalesce({iqr}, 0) = 0 THEN 1.0::DOUBLE ELSE {iqr} END AS b_{c}")
    sel = []
    for c in _ALL_POST:
        if c in _SC_COLS:
            sel.append(f"{r(f'(cast({c} AS DOUBLE) - st.a_{c}) / st.b_{c}')} AS {c}")
        else:
            sel.append(c)
    return f"WITH {POSTS_NA}, st AS (SELECT {', '.join(stats)} FROM posts_na)\nSELECT {', '.join(sel)} FROM posts_na, st"


for _m in ("standard", "minmax", "robust"):
    SQL[f"scale_{_m}"] = _scale_sql(_m)

_TOD = ("CASE WHEN post_hour >= 5 AND post_hour < 12 THEN 'morning' WHEN post_hour >= 12 AND post_hour < 17 "
        "THEN 'afternoon' WHEN post_hour >= 17 AND post_hour < 21 THEN 'evening' WHEN post_hour >= 21 OR post_hour < 5 "
        "THEN 'night' ELSE 'unknown' END")
# The sorted levels present in the driver's events table.
_CAT_LEVELS = ["click", "error", "purchase", "signup", "view"]
_TOD_LEVELS = ["afternoon", "evening", "morning", "night", "unknown"]
_ENC_BASE = f"WITH {POSTS_NA}, e AS (SELECT post_id, category, {_TOD} AS time_of_day FROM posts_na)\n"


def _code(col: str, levels: list[str], null_code: str) -> str:
    whens = " ".join(f"WHEN {col} = '{lv}' THEN {i}" for i, lv in enumerate(levels))
    return f"CASE WHEN {col} IS NULL THEN {null_code} {whens} END"


SQL["encode_onehot"] = _ENC_BASE + "SELECT post_id, " + ", ".join(
    [f"coalesce(cast(category = '{lv}' AS INTEGER), 0) AS category_{lv}" for lv in _CAT_LEVELS[1:]]
    + [f"coalesce(cast(time_of_day = '{lv}' AS INTEGER), 0) AS time_of_day_{lv}" for lv in _TOD_LEVELS[1:]]) + " FROM e"
SQL["encode_label"] = (_ENC_BASE + f"SELECT post_id, {_code('category', _CAT_LEVELS, '-1')} AS category, "
                       f"{_code('time_of_day', _TOD_LEVELS, '-1')} AS time_of_day FROM e")
SQL["encode_ordinal"] = (_ENC_BASE + f"SELECT post_id, {_code('category', _CAT_LEVELS, 'NULL')} AS category, "
                         f"{_code('time_of_day', _TOD_LEVELS, 'NULL')} AS time_of_day FROM e")

SQL["split"] = f"""
WITH rk AS (SELECT event_id, row_number() OVER (ORDER BY {u('split', 'event_id')}, event_id) AS pos, count(*) OVER () AS n FROM events),
sz AS (SELECT event_id, pos, n - (n * 3 + 9) // 10 AS n_train, ((n * 3 + 9) // 10) - (((n * 3 + 9) // 10) * 2 + 2) // 3 AS n_val FROM rk)
SELECT event_id, CASE WHEN pos <= n_train THEN 'train' WHEN pos <= n_train + n_val THEN 'val' ELSE 'test' END AS split FROM sz"""

SQL["split_stratified"] = f"""
WITH tot AS (SELECT count(*) AS n, (count(*) + 4) // 5 AS n_test FROM events),
st AS (SELECT event_type, count(*) AS ns FROM events GROUP BY event_type),
q AS (SELECT event_type, ns, floor(ns * tot.n_test / tot.n) AS f, ns * tot.n_test / tot.n - floor(ns * tot.n_test / tot.n) AS rem
      FROM st, tot),
lft AS (SELECT any_value(tot.n_test) - sum(f) AS left_over FROM q, tot),
al AS (SELECT event_type, ns, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, event_type) <= lft.left_over THEN 1 ELSE 0 END AS nt
       FROM q, lft),
rk AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {u('split', 'event_id')}, event_id) AS pos
       FROM events)
SELECT event_id, CASE WHEN pos <= al.ns - al.nt THEN 'train' ELSE 'test' END AS split
FROM rk JOIN al USING (event_type)"""

def _hist_sql(src: str, col: str, k: int, stage: str | None = None) -> str:
    st = f"(SELECT min({col}) AS lo, max({col}) AS hi FROM {src} WHERE {col} IS NOT NULL)"
    w = "((st.hi - st.lo) / {k})".format(k=k)
    b = (f"(SELECT {_ewbin(col, 'st.lo', 'st.hi', k)} AS bin, count(*) AS count FROM {src}, {st} st "
         f"WHERE {col} IS NOT NULL GROUP BY 1)")
    head = f"'{stage}' AS stage, '{col}' AS column, " if stage else ""
    d = 4 if stage else 6
    return (f"SELECT {head}g.bin, {r(f'st.lo + g.bin * {w}', d)} AS bin_lo, "
            f"{r(f'CASE WHEN g.bin = {k - 1} THEN st.hi ELSE st.lo + (g.bin + 1) * {w} END', d)} AS bin_hi, "
            f"coalesce(c.count, 0) AS count "
            f"FROM (SELECT cast(range AS INTEGER) AS bin FROM range({k})) g LEFT JOIN {b} c ON g.bin = c.bin, {st} st")


SQL["histogram"] = _hist_sql("events", "value", 30)


def _kde_sql(src: str, col: str, group: str | None, grid: int, cut: float = 3.0) -> str:
    """The direct sum over all rows at every grid point."""
    g = f"{group}, " if group else ""
    gj = f"USING ({group})" if group else "ON true"
    return f"""
WITH st AS (SELECT {g}min({col}) AS lo, max({col}) AS hi, count({col}) AS n, stddev_samp({col}) * pow(cast(count({col}) AS DOUBLE), -0.2::DOUBLE) AS h
            FROM {src} WHERE {col} IS NOT NULL {'AND ' + group + ' IS NOT NULL' if group else ''} {'GROUP BY ' + group if group else ''}),
gp AS (SELECT {g}gi, h, n, lo - {cut!r}::DOUBLE * h + gi * ((hi - lo + {2 * cut!r}::DOUBLE * h) / {grid - 1}) AS gx
       FROM st, (SELECT range AS gi FROM range({grid})) WHERE h > 0)
SELECT {g}cast(gi AS INTEGER) AS grid, {r('any_value(gx)')} AS x,
  {r(f'sum(exp(-0.5::DOUBLE * ((gx - {col}) / h) * ((gx - {col}) / h))) / (any_value(n) * any_value(h) * 2.5066282746310002::DOUBLE)')} AS density
FROM gp JOIN (SELECT * FROM {src} WHERE {col} IS NOT NULL) {gj} GROUP BY {g}gi"""


for _m, _none in (("label", "-1"), ("ordinal", "NULL")):
    SQL[f"encode_many_{_m}"] = f"""
WITH t AS (SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS row_id,
                  CASE WHEN l_partkey % 97 <> 0 THEN l_partkey || '-' || l_orderkey END AS item FROM lineitem),
codes AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS code FROM (SELECT DISTINCT item FROM t WHERE item IS NOT NULL))
SELECT row_id, cast(coalesce(code, {_none}) AS INTEGER) AS item FROM t LEFT JOIN codes USING (item)"""


SQL["kde"] = _kde_sql("events", "value", None, 200)


def _box_sql(src: str, col: str, group: str) -> str:
    return f"""
WITH q AS (SELECT {group}, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS median,
                  quantile_cont({col}, 0.75) AS q3 FROM {src} WHERE {col} IS NOT NULL AND {group} IS NOT NULL GROUP BY {group}),
f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lo_f, q3 + 1.5::DOUBLE * (q3 - q1) AS hi_f FROM q)
SELECT {group}, {r('any_value(f.q1)')} AS q1, {r('any_value(f.median)')} AS median, {r('any_value(f.q3)')} AS q3,
  {r(f'min(CASE WHEN {col} >= f.lo_f AND {col} <= f.hi_f THEN {col} END)')} AS whisker_low,
  {r(f'max(CASE WHEN {col} >= f.lo_f AND {col} <= f.hi_f THEN {col} END)')} AS whisker_high,
  cast(sum(CASE WHEN {col} >= f.lo_f AND {col} <= f.hi_f THEN 0 ELSE 1 END) AS BIGINT) AS n_outside, count(*) AS count
FROM {src} JOIN f USING ({group}) WHERE {col} IS NOT NULL GROUP BY {group}"""


SQL["box_stats"] = _box_sql("events", "value", "event_type")

SQL["violin"] = f"""
WITH k AS ({_kde_sql("events", "value", "event_type", 50)}),
q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT k.event_type, k.grid, k.x, k.density, {r('q.q1')} AS q1, {r('q.median')} AS median, {r('q.q3')} AS q3
FROM k JOIN q USING (event_type)"""

SQL["group_ci"] = f"""
SELECT event_type, count(value) AS n, {r('avg(value)')} AS mean, {r('stddev_samp(value)')} AS std,
  {r('avg(value) - 1.959963984540054::DOUBLE * stddev_samp(value) / sqrt(count(value))')} AS ci_low,
  {r('avg(value) + 1.959963984540054::DOUBLE * stddev_samp(value) / sqrt(count(value))')} AS ci_high
FROM events WHERE event_type IS NOT NULL GROUP BY event_type"""


def _pair_sql(cols: list[str], k: int) -> str:
    st = "st AS (SELECT " + ", ".join(f"min(cast({c} AS DOUBLE)) AS lo_{c}, max(cast({c} AS DOUBLE)) AS hi_{c}"
                                      for c in cols) + " FROM lineitem)"
    parts = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {_ewbin(a, 'st.lo_' + a, 'st.hi_' + a, k)} AS bin_x, "
                         f"{_ewbin(b, 'st.lo_' + b, 'st.hi_' + b, k)} AS bin_y, count(*) AS count "
                         f"FROM lineitem, st WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2, 3, 4")
    return f"WITH {st}\n" + "\nUNION ALL\n".join(parts)


SQL["pair_density"] = _pair_sql(LINE_COLS, 20)

_BA = ["l_quantity", "l_extendedprice"]
SQL["before_after"] = (
    f"WITH {iqr_cte('bq', 'lineitem', 'l_quantity')}, {iqr_cte('be', 'lineitem', 'l_extendedprice')},\n"
    "aft AS (SELECT least(greatest(cast(l_quantity AS DOUBLE), bq.lo), bq.hi) AS l_quantity, "
    "least(greatest(cast(l_extendedprice AS DOUBLE), be.lo), be.hi) AS l_extendedprice FROM lineitem, bq, be)\n"
    + "\nUNION ALL\n".join([_hist_sql("lineitem", c, 30, "before") for c in _BA]
                            + [_hist_sql("aft", c, 30, "after") for c in _BA]))

# --------------------------------------------------------------------------------------
# E2 (KNN on the customer table), F1 (one-feature OLS), F12 (fold assignment)
# --------------------------------------------------------------------------------------
_KC3 = ["x_nation", "x_balance", "x_segment"]
_CUST_NA = (
    "base AS (SELECT c_custkey, "
    f"CASE WHEN {u('x_nation', 'c_custkey')} < 0.1::DOUBLE THEN NULL ELSE cast(c_nationkey AS DOUBLE) END AS x_nation, "
    f"CASE WHEN {u('x_balance', 'c_custkey')} < 0.1::DOUBLE THEN NULL ELSE c_acctbal / 1000.0::DOUBLE END AS x_balance, "
    f"CASE WHEN {u('x_segment', 'c_custkey')} < 0.1::DOUBLE THEN NULL ELSE cast(length(c_mktsegment) AS DOUBLE) END AS x_segment "
    "FROM customer)")
_PAIRS = ("pairs AS (SELECT q.c_custkey AS qid, d.c_custkey AS did, "
          + " + ".join(f"CASE WHEN q.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in _KC3) + " AS shared, "
          + " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0.0::DOUBLE)" for c in _KC3) + " AS sq, "
          + ", ".join(f"q.{c} IS NULL AS need_{c}, d.{c} AS v_{c}" for c in _KC3)
          + " FROM base q, base d WHERE " + " OR ".join(f"q.{c} IS NULL" for c in _KC3) + "),\n"
          "dist AS (SELECT *, sqrt(sq * 3 / shared) AS dist FROM pairs WHERE shared > 0)")
_KNN_PARTS = ",\n".join(
    f"k_{c} AS (SELECT qid, avg(v) AS v FROM (SELECT qid, v_{c} AS v, row_number() OVER (PARTITION BY qid ORDER BY dist, did) AS rn "
    f"FROM dist WHERE need_{c} AND v_{c} IS NOT NULL) WHERE rn <= 5 GROUP BY qid)" for c in _KC3)
SQL["impute_knn"] = (f"WITH {_CUST_NA},\n{_PAIRS},\n{_KNN_PARTS},\n"
                     "mn AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in _KC3) + " FROM base)\n"
                     "SELECT b.c_custkey, " + ", ".join(f"{r(f'coalesce(b.{c}, k_{c}.v, mn.m_{c})')} AS {c}" for c in _KC3)
                     + " FROM base b " + " ".join(f"LEFT JOIN k_{c} ON k_{c}.qid = b.c_custkey" for c in _KC3) + ", mn")

SQL["linear"] = f"""
SELECT 'l_quantity' AS feature, {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS coefficient FROM lineitem
UNION ALL
SELECT 'intercept' AS feature, {r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS coefficient FROM lineitem"""

SQL["cv_folds"] = """
WITH rk AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos0, count(*) OVER () AS n FROM events),
p AS (SELECT event_id, pos0, n // 5 AS small, n % 5 AS big, (n % 5) * (n // 5 + 1) AS boundary FROM rk)
SELECT event_id, cast(CASE WHEN pos0 < boundary THEN floor(pos0 / (small + 1))
                          ELSE big + floor((pos0 - boundary) / greatest(small, 1)) END AS INTEGER) AS fold FROM p"""

# --------------------------------------------------------------------------------------
# Split -> (fit on train) impute mean / mode -> IQR clip -> time features -> one-hot -> standard scale
# --------------------------------------------------------------------------------------
_PN = ["post_hour", "post_day", "k", "user_id"]
_SCALED = _PN + ["hour_sin", "hour_cos", "day_sin", "day_cos"]
# Levels seen in the training rows (time_of_day has no 'unknown' after imputation).
_PRE_TOD = ["afternoon", "evening", "morning", "night"]


def _preprocess_sql() -> str:
    tod = _TOD
    clip = ", ".join(f"least(greatest({c}, b_{c}.lo), b_{c}.hi) AS {c}" for c in _PN)
    bounds = ", ".join(
        f"b_{c} AS (SELECT quantile_cont({c}, 0.25) - 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, "
        f"quantile_cont({c}, 0.75) + 1.5::DOUBLE * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi "
        f"FROM a WHERE split = 'train')" for c in _PN)
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0::DOUBLE "
                      f"ELSE stddev_pop({c}) END AS s_{c}" for c in _SCALED)
    scaled = ", ".join(f"{r(f'({c} - st.m_{c}) / st.s_{c}')} AS {c}" for c in _SCALED)
    dummies = ", ".join([f"coalesce(cast(category = '{lv}' AS INTEGER), 0) AS category_{lv}" for lv in _CAT_LEVELS[1:]]
                        + [f"coalesce(cast(time_of_day = '{lv}' AS INTEGER), 0) AS time_of_day_{lv}" for lv in _PRE_TOD[1:]])
    return f"""
WITH {POSTS_NA},
rk AS (SELECT *, row_number() OVER (ORDER BY {u('split', 'post_id')}, post_id) AS pos, count(*) OVER () AS n FROM posts_na),
lab AS (SELECT *, CASE WHEN pos <= n - (n + 4) // 5 THEN 'train' ELSE 'test' END AS split FROM rk),
imp AS (SELECT avg(post_hour) AS m_post_hour, avg(cast(post_day AS DOUBLE)) AS m_post_day, avg(cast(k AS DOUBLE)) AS m_k,
               avg(cast(user_id AS DOUBLE)) AS m_user_id,
               (SELECT category FROM lab WHERE split = 'train' AND category IS NOT NULL GROUP BY category
                ORDER BY count(*) DESC, category LIMIT 1) AS m_category
        FROM lab WHERE split = 'train'),
a AS (SELECT post_id, target, split, coalesce(cast(post_hour AS DOUBLE), m_post_hour) AS post_hour,
             coalesce(cast(post_day AS DOUBLE), m_post_day) AS post_day, coalesce(cast(k AS DOUBLE), m_k) AS k,
             coalesce(cast(user_id AS DOUBLE), m_user_id) AS user_id, coalesce(category, m_category) AS category
      FROM lab, imp),
{bounds},
c AS (SELECT post_id, target, split, category, {clip} FROM a, {', '.join('b_' + c for c in _PN)}),
t AS (SELECT *, sin({_TWO_PI} * post_hour / 24.0::DOUBLE) AS hour_sin, cos({_TWO_PI} * post_hour / 24.0::DOUBLE) AS hour_cos,
             {tod} AS time_of_day,
             coalesce(cast((post_hour BETWEEN 7 AND 9) OR (post_hour BETWEEN 17 AND 19) AS INTEGER), 0) AS is_peak_hour,
             sin({_TWO_PI} * post_day / 7.0::DOUBLE) AS day_sin, cos({_TWO_PI} * post_day / 7.0::DOUBLE) AS day_cos,
             coalesce(cast(post_day >= 5 AS INTEGER), 0) AS is_weekend FROM c),
st AS (SELECT {stats} FROM t WHERE split = 'train')
SELECT post_id, {r('target')} AS target, {scaled}, is_peak_hour, is_weekend, {dummies}, split AS part FROM t, st"""


SQL["preprocess"] = _preprocess_sql()

# --------------------------------------------------------------------------------------
# Q-Q line and points (Filliben positions, rational inverse normal)
# --------------------------------------------------------------------------------------
def _poly_sql(coefs, x: str) -> str:
    acc = f"{coefs[0]!r}::DOUBLE"
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {c!r}::DOUBLE)"
    return acc


def _ppf_sql(p: str) -> str:
    from ..operators import metrics as M
    q, rr = f"({p} - 0.5::DOUBLE)", f"(({p} - 0.5::DOUBLE) * ({p} - 0.5::DOUBLE))"
    central = f"({q} * {_poly_sql(M._A, rr)} / ({_poly_sql(M._B, rr)} * {rr} + 1.0::DOUBLE))"
    ql = f"sqrt(-2.0::DOUBLE * ln({p}))"
    qu = f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {p}))"
    low = f"({_poly_sql(M._C, ql)} / ({_poly_sql(M._D, ql)} * {ql} + 1.0::DOUBLE))"
    high = f"(-{_poly_sql(M._C, qu)} / ({_poly_sql(M._D, qu)} * {qu} + 1.0::DOUBLE))"
    return (f"CASE WHEN {p} < {M._P_LOW!r}::DOUBLE THEN {low} WHEN {p} > 1.0::DOUBLE - {M._P_LOW!r}::DOUBLE "
            f"THEN {high} ELSE {central} END")


_QQ_BASE = f"""{LINE_PRED},
rs AS (SELECT row_id, label - prediction AS residual FROM lp WHERE label IS NOT NULL AND prediction IS NOT NULL),
rk AS (SELECT residual, row_number() OVER (ORDER BY residual, row_id) AS i, cast(count(*) OVER () AS DOUBLE) AS n FROM rs),
fp AS (SELECT residual, i, n, CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                                   WHEN i = 1 THEN 1.0::DOUBLE - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                                   ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS pp FROM rk),
th AS (SELECT residual, i, n, {_ppf_sql('pp')} AS theoretical FROM fp)"""
SQL["qq"] = (f"WITH {_QQ_BASE}\nSELECT {r('regr_slope(residual, theoretical)', 4)} AS slope, "
             f"{r('regr_intercept(residual, theoretical)', 4)} AS intercept, {r('corr(residual, theoretical)', 4)} AS r, "
             f"count(*) AS n FROM th")
SQL["qq_points"] = (f"WITH {_QQ_BASE}\nSELECT i, {r('theoretical', 4)} AS theoretical, {r('residual', 4)} AS residual "
                    f"FROM th WHERE i IN (SELECT DISTINCT cast(floor(j * (n - 1) / 99 + 0.5) AS BIGINT) + 1 "
                    f"FROM (SELECT range AS j FROM range(100)), (SELECT count(*) AS n FROM rs))")

def _hist_auto_sql(src: str, col: str) -> str:
    """Bin count = ceil(range / min(Sturges width, Freedman-Diaconis width)); FD needs IQR > 0."""
    st = (f"(SELECT min({col}) AS lo, max({col}) AS hi, count({col}) AS n, "
          f"quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25) AS iqr FROM {src} WHERE {col} IS NOT NULL)")
    kk = ("(SELECT cast(greatest(1, ceil((hi - lo) / CASE WHEN iqr > 0 THEN least((hi - lo) / (log2(n) + 1.0::DOUBLE), "
          "2.0::DOUBLE * iqr * pow(cast(n AS DOUBLE), -1.0::DOUBLE / 3.0::DOUBLE)) ELSE (hi - lo) / (log2(n) + 1.0::DOUBLE) END)) "
          f"AS INTEGER) AS k, lo, hi FROM {st})")
    w = "((s.hi - s.lo) / s.k)"
    binx = f"cast(least(greatest(floor(({col} - s.lo) / {w}), 0), s.k - 1) AS INTEGER)"
    return f"""
WITH s AS {kk},
c AS (SELECT {binx} AS bin, count(*) AS count FROM {src}, s WHERE {col} IS NOT NULL GROUP BY 1),
g AS (SELECT cast(range AS INTEGER) AS bin FROM s, range(s.k))
SELECT g.bin, {r(f's.lo + g.bin * {w}', 4)} AS bin_lo,
  {r(f'CASE WHEN g.bin = s.k - 1 THEN s.hi ELSE s.lo + (g.bin + 1) * {w} END', 4)} AS bin_hi,
  coalesce(c.count, 0) AS count
FROM g LEFT JOIN c ON g.bin = c.bin, s"""


SQL["histogram_auto"] = _hist_auto_sql("lineitem", "l_extendedprice")

SQL["corr_kendall_wide"] = f"""
WITH c AS (SELECT o_totalprice AS a, o_custkey AS b, count(*) AS n FROM orders
           WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL GROUP BY 1, 2),
s AS (SELECT sum(c1.n * c2.n * sign(c1.a - c2.a) * sign(c1.b - c2.b)) / 2.0 AS S FROM c c1, c c2),
t AS (SELECT sum(n) * (sum(n) - 1) / 2.0 AS n0 FROM c),
t1 AS (SELECT sum(m * (m - 1) / 2.0) AS n1 FROM (SELECT sum(n) AS m FROM c GROUP BY a)),
t2 AS (SELECT sum(m * (m - 1) / 2.0) AS n2 FROM (SELECT sum(n) AS m FROM c GROUP BY b))
SELECT 'o_totalprice' AS x, 'o_custkey' AS y, {r('s.S / sqrt((t.n0 - t1.n1) * (t.n0 - t2.n2))')} AS corr, true AS exact
FROM s, t, t1, t2"""

# --------------------------------------------------------------------------------------
# C20 / C13 band: the same repeatable Poisson(1) weights (splitmix64 of seed, id, replicate)
# --------------------------------------------------------------------------------------
_M64 = "18446744073709551616"
_GOLD = 0x9E3779B97F4A7C15


def _mulmod(a: str, b: int) -> str:
    """a * b modulo 2^64 in halves of 32 bits, so that nothing overflows."""
    low, high = b & 0xFFFFFFFF, b >> 32
    lo, hi, m = f"({a} & 4294967295::UBIGINT)", f"({a} >> 32)", "4294967295::UBIGINT"
    p = f"({lo} * {low}::UBIGINT)"
    top = f"((({p} >> 32) + (({lo} * {high}::UBIGINT) & {m}) + (({hi} * {low}::UBIGINT) & {m})) & {m})"
    return f"({top} * 4294967296::UBIGINT + ({p} & {m}))"


def _mix64_sql(z: str) -> str:
    z1 = _mulmod(f"xor({z}, {z} >> 30)", 0xBF58476D1CE4E5B9)
    z2 = _mulmod(f"xor({z1}, {z1} >> 27)", 0x94D049BB133111EB)
    return f"xor({z2}, {z2} >> 31)"


def _weighted_rows(src: str, id_expr: str, cols: str, B: int, seed: int) -> str:
    """CTEs up to ww: the columns, rep and w. The id's and the replicate's own parts of the hash are taken once each."""
    from ..operators.density import _poisson1_thresholds
    salt = (seed * _GOLD) % (1 << 64)
    z1 = _mix64_sql(f"xor(CAST({id_expr} AS UBIGINT), {salt}::UBIGINT)")
    w = "CASE " + " ".join(f"WHEN uu < {float(t)!r}::DOUBLE THEN {k}" for k, t in enumerate(_poisson1_thresholds())) + f" ELSE {len(_poisson1_thresholds())} END"
    half = lambda z, shift: f"xor({z}, {z} >> {shift})"
    return f"""wid AS MATERIALIZED (SELECT {cols}, {z1} AS z1 FROM {src}),
wrep AS MATERIALIZED (SELECT range AS rep, {_mulmod('CAST(range AS UBIGINT)', _GOLD)} AS g FROM range({B})),
w0 AS (SELECT * EXCLUDE (z1, g), ((z1 >> 1) + (g >> 1) + (z1 & g & 1)) AS h, xor(z1 & 1, g & 1) AS l FROM wid, wrep),
w1 AS (SELECT * EXCLUDE (h, l), (h & 9223372036854775807::UBIGINT) * 2 + l AS z FROM w0),
w2 AS (SELECT * REPLACE ({half('z', 30)} AS z) FROM w1),
w3 AS (SELECT * REPLACE ({_mulmod('z', 0xBF58476D1CE4E5B9)} AS z) FROM w2),
w4 AS (SELECT * REPLACE ({half('z', 27)} AS z) FROM w3),
w5 AS (SELECT * REPLACE ({_mulmod('z', 0x94D049BB133111EB)} AS z) FROM w4),
wu AS (SELECT * EXCLUDE (z), CAST(({half('z', 31)}) >> 11 AS DOUBLE) / 9007199254740992.0::DOUBLE AS uu FROM w5),
ww AS (SELECT *, ({w}) AS w FROM wu)"""


SQL["bootstrap_ci"] = f"""
WITH {_weighted_rows("events", "event_id", "event_id, event_type, value", 1000, SEED)},
reps AS (SELECT event_type, rep, sum(w * value) / sum(w) AS m FROM ww GROUP BY event_type, rep),
ci AS (SELECT event_type, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi, count(*) AS replicates
       FROM reps GROUP BY event_type),
mn AS (SELECT event_type, count(*) AS n, avg(value) AS mean FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT mn.event_type, mn.n, {r('mn.mean')} AS mean, {r('ci.lo')} AS ci_low, {r('ci.hi')} AS ci_high, ci.replicates
FROM mn JOIN ci USING (event_type)"""

SQL["ols_band"] = f"""
WITH li AS (SELECT {C.ROW_ID} AS row_id, l_quantity AS x, l_extendedprice AS y FROM lineitem
            WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
{_weighted_rows("li", "row_id", "row_id, x, y", 1000, SEED)},
sums AS (SELECT rep, sum(w) AS sw, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy
         FROM ww GROUP BY rep),
lines AS (SELECT rep, (sxy - sx * sy / sw) / (sxx - sx * sx / sw) AS s, sy / sw AS my, sx / sw AS mx FROM sums),
ab AS (SELECT rep, s, my - s * mx AS a FROM lines),
st AS (SELECT min(x) AS lo, max(x) AS hi, regr_slope(y, x) AS s, regr_intercept(y, x) AS a FROM li),
g AS (SELECT cast(range AS INTEGER) AS grid, st.lo + range * ((st.hi - st.lo) / 49) AS x FROM st, range(50))
SELECT g.grid, {r('g.x', 2)} AS x, {r('any_value(st.a) + any_value(st.s) * g.x', 2)} AS fit,
  {r('quantile_cont(ab.a + ab.s * g.x, 0.025)', 2)} AS ci_low, {r('quantile_cont(ab.a + ab.s * g.x, 0.975)', 2)} AS ci_high
FROM g, ab, st GROUP BY g.grid, g.x"""

# --------------------------------------------------------------------------------------
# F1/F2/F8/F12 with three features: least squares (optionally ridge) by Cramer's rule on
# centred sums; per-fold training sums are the totals minus the fold's own sums
# --------------------------------------------------------------------------------------
_LX = ["l_quantity", "l_discount", "l_tax"]
_LY = "l_extendedprice"


def _sums_select(xs: list[str], y: str) -> str:
    parts = ["count(*) AS n", f"sum({y}) AS sy", f"sum({y} * {y}) AS syy"]
    for i, a in enumerate(xs):
        parts.append(f"sum({a}) AS s{i}")
        parts.append(f"sum({a} * {y}) AS s{i}y")
        for j in range(i, len(xs)):
            parts.append(f"sum({a} * {xs[j]}) AS s{i}{j}")
    return ", ".join(parts)


def _det3(m) -> str:
    return (f"(({m[0][0]}) * (({m[1][1]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][1]}))"
            f" - ({m[0][1]}) * (({m[1][0]}) * ({m[2][2]}) - ({m[1][2]}) * ({m[2][0]}))"
            f" + ({m[0][2]}) * (({m[1][0]}) * ({m[2][1]}) - ({m[1][1]}) * ({m[2][0]})))")


def _ols3_coefs(t: str, alpha: float = 0.0) -> list[str]:
    """Coefficient expressions (w0, w1, w2, intercept) from a sums row aliased ``t``."""
    def sxx(i, j):
        i, j = min(i, j), max(i, j)
        base = f"({t}.s{i}{j} - {t}.s{i} * {t}.s{j} / {t}.n)"
        return f"({base} + {alpha!r})" if (i == j and alpha) else base
    def sxy(i):
        return f"({t}.s{i}y - {t}.s{i} * {t}.sy / {t}.n)"
    A = [[sxx(i, j) for j in range(3)] for i in range(3)]
    det = _det3(A)
    ws = []
    for k in range(3):
        Ak = [[sxy(i) if j == k else A[i][j] for j in range(3)] for i in range(3)]
        ws.append(f"({_det3(Ak)} / {det})")
    icpt = f"({t}.sy / {t}.n - ({ws[0]}) * {t}.s0 / {t}.n - ({ws[1]}) * {t}.s1 / {t}.n - ({ws[2]}) * {t}.s2 / {t}.n)"
    return ws + [icpt]


_LI_ML = f"li AS (SELECT {C.ROW_ID} AS row_id, {', '.join(_LX)}, {_LY} FROM lineitem)"


def _pred_sql(t: str, alpha: float = 0.0) -> str:
    w = _ols3_coefs(t, alpha)
    return f"({w[3]} + {w[0]} * l_quantity + {w[1]} * l_discount + {w[2]} * l_tax)"


SQL["predict"] = (f"WITH {_LI_ML}, t AS (SELECT {_sums_select(_LX, _LY)} FROM li)\n"
                  f"SELECT row_id, {r(_pred_sql('t'), 2)} AS prediction FROM li, t")
SQL["model_save_load"] = SQL["predict"]


def _ridge_alpha_sql() -> str:
    # the ridge query uses alpha = 1.0 on the summed loss (closed form (Xc'Xc + aI) w = Xc'yc)
    w = _ols3_coefs("t", 1.0)
    rows = [f"SELECT '{c}' AS feature, {r(w[i], 4)} AS coefficient FROM t" for i, c in enumerate(_LX)]
    rows.append(f"SELECT 'intercept' AS feature, {r(w[3], 4)} AS coefficient FROM t")
    return f"WITH {_LI_ML}, t AS (SELECT {_sums_select(_LX, _LY)} FROM li)\n" + "\nUNION ALL\n".join(rows)


SQL["ridge"] = _ridge_alpha_sql()


_ODD_ML = f"""li AS (SELECT row_id, l_quantity, l_discount, l_tax, l_extendedprice FROM (
  SELECT {C.ROW_ID} AS row_id, CASE WHEN ({C.ROW_ID}) % 7 <> 0 THEN l_quantity END AS l_quantity, l_discount, l_tax,
         CASE WHEN ({C.ROW_ID}) % 11 <> 0 THEN l_extendedprice + 1e5 END AS l_extendedprice FROM lineitem)
  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)"""


def _cv_sql(k: int = 5, li: str = _LI_ML, shift: float = 0.0) -> str:
    tr = ", ".join(f"a.{c} - f.{c} AS {c}" for c in
                   ["n", "sy", "syy"] + [f"s{i}" for i in range(3)] + [f"s{i}y" for i in range(3)]
                   + [f"s{i}{j}" for i in range(3) for j in range(i, 3)])
    pred = _pred_sql("tr")
    return f"""
WITH {li},
rk AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos0, count(*) OVER () AS nn FROM li),
fo AS (SELECT *, cast(CASE WHEN pos0 < (nn % {k}) * (nn // {k} + 1) THEN floor(pos0 / (nn // {k} + 1))
                          ELSE (nn % {k}) + floor((pos0 - (nn % {k}) * (nn // {k} + 1)) / greatest(nn // {k}, 1)) END
                     AS INTEGER) AS fold FROM rk),
a AS (SELECT {_sums_select(_LX, _LY)} FROM fo),
f AS (SELECT fold, {_sums_select(_LX, _LY)} FROM fo GROUP BY fold),
tr AS (SELECT f.fold, {tr} FROM a, f),
p AS (SELECT fo.fold, fo.{_LY} AS label, {pred} AS prediction FROM fo JOIN tr ON fo.fold = tr.fold)
SELECT fold, {metric_select('label', 'prediction', 2)}, count(*) AS n FROM p GROUP BY fold"""


SQL["cv_scores"] = _cv_sql(5)
SQL["cv_nulls"] = _cv_sql(5, _ODD_ML)
SQL["cv_collinear"] = SQL["cv_nulls"]  # the further columns add nothing that the others can't say

def _raw_coefs(t: str, alpha: float) -> list[str]:
    """No-intercept ridge / least squares: (X'X + aI) w = X'y from raw sums."""
    def sxx(i, j):
        i, j = min(i, j), max(i, j)
        return f"({t}.s{i}{j} + {alpha!r})" if (i == j and alpha) else f"{t}.s{i}{j}"
    A = [[sxx(i, j) for j in range(3)] for i in range(3)]
    det = _det3(A)
    return [f"({_det3([[f'{t}.s{i}y' if j == k else A[i][j] for j in range(3)] for i in range(3)])} / {det})"
            for k in range(3)]


def _grid_sql() -> str:
    from itertools import product
    k = 5
    tr = ", ".join(f"a.{c} - f.{c} AS {c}" for c in
                   ["n", "sy", "syy"] + [f"s{i}" for i in range(3)] + [f"s{i}y" for i in range(3)]
                   + [f"s{i}{j}" for i in range(3) for j in range(i, 3)])
    points = list(product([0.1, 1.0, 10.0, 100.0], [True, False]))
    parts = []
    for pi, (alpha, icpt) in enumerate(points):
        if icpt:
            pred = _pred_sql("tr", alpha)
        else:
            w = _raw_coefs("tr", alpha)
            pred = f"({w[0]} * l_quantity + {w[1]} * l_discount + {w[2]} * l_tax)"
        params = repr({"alpha": alpha, "fit_intercept": icpt}).replace("'", "''")
        parts.append(f"""SELECT {pi} AS point, '{params}' AS params, {r('avg(mse)', 2)} AS mean_score,
  {r('stddev_pop(mse)', 2)} AS std_score
FROM (SELECT fo.fold, avg((fo.{_LY} - {pred}) * (fo.{_LY} - {pred})) AS mse
      FROM fo JOIN tr ON fo.fold = tr.fold GROUP BY fo.fold)""")
    return f"""
WITH {_LI_ML},
rk AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS pos0, count(*) OVER () AS nn FROM li),
fo AS (SELECT *, cast(CASE WHEN pos0 < (nn % {k}) * (nn // {k} + 1) THEN floor(pos0 / (nn // {k} + 1))
                          ELSE (nn % {k}) + floor((pos0 - (nn % {k}) * (nn // {k} + 1)) / greatest(nn // {k}, 1)) END
                     AS INTEGER) AS fold FROM rk),
a AS (SELECT {_sums_select(_LX, _LY)} FROM fo),
f AS (SELECT fold, {_sums_select(_LX, _LY)} FROM fo GROUP BY fold),
tr AS (SELECT f.fold, {tr} FROM a, f)
""" + "\nUNION ALL\n".join(parts)


SQL["grid"] = _grid_sql()

def _learning_curve_sql(k: int = 5, sizes=tuple(i / 10 for i in range(1, 11)), li: str = _LI_ML, whole: bool = False) -> str:
    """Diagnosis row of the OLS learning curve: fold i trains on the first m rows (in id order)
    of the other folds; train and test RMSE per (fold, m); mean over folds per m."""
    size_rows = " UNION ALL ".join(f"SELECT {s!r}::DOUBLE AS sz" for s in sizes)
    pred = _pred_sql("t")
    sums = _sums_select(_LX, _LY)
    tail = f"""SELECT tr_err.m::INTEGER AS train_size, {r('avg(tr_err.rmse)', 2)} AS train_rmse_mean, {r('stddev_pop(tr_err.rmse)', 2)} AS train_rmse_std,
  {r('avg(te_err.rmse)', 2)} AS test_rmse_mean, {r('stddev_pop(te_err.rmse)', 2)} AS test_rmse_std
FROM tr_err JOIN te_err ON tr_err.i = te_err.i AND tr_err.m = te_err.m GROUP BY tr_err.m"""
    sql = f"""
WITH {li},
rk AS (SELECT *, row_number() OVER (ORDER BY row_id) AS pos, count(*) OVER () AS nn FROM li),
fo AS (SELECT *, cast(CASE WHEN pos - 1 < (nn % {k}) * (nn // {k} + 1) THEN floor((pos - 1) / (nn // {k} + 1))
                          ELSE (nn % {k}) + floor((pos - 1 - (nn % {k}) * (nn // {k} + 1)) / greatest(nn // {k}, 1)) END
                     AS INTEGER) AS fold FROM rk),
fc AS (SELECT fold AS i, count(*) AS ci, any_value(nn) AS nn FROM fo GROUP BY fold),
combos AS (SELECT fc.i, fc.ci, greatest(1, cast(floor(sz * (fc.nn - (SELECT max(ci) FROM fc)) + 1e-9) AS BIGINT)) AS m FROM fc, ({size_rows})),
trrows AS (SELECT combos.i, combos.m, fo.* FROM fo JOIN combos ON fo.fold <> combos.i
           WHERE CASE WHEN fo.fold < combos.i THEN fo.pos ELSE fo.pos - combos.ci END <= combos.m),
t AS (SELECT i, m, {sums} FROM trrows GROUP BY i, m),
tr_err AS (SELECT t.i, t.m, sqrt(avg((trrows.{_LY} - {pred}) * (trrows.{_LY} - {pred}))) AS rmse
           FROM trrows JOIN t ON trrows.i = t.i AND trrows.m = t.m GROUP BY t.i, t.m),
te_err AS (SELECT t.i, t.m, sqrt(avg((fo.{_LY} - {pred}) * (fo.{_LY} - {pred}))) AS rmse
           FROM fo JOIN t ON fo.fold = t.i GROUP BY t.i, t.m),
curve AS (SELECT tr_err.m AS train_size, avg(tr_err.rmse) AS tr, avg(te_err.rmse) AS te
          FROM tr_err JOIN te_err ON tr_err.i = te_err.i AND tr_err.m = te_err.m GROUP BY tr_err.m),
mx AS (SELECT greatest(max(tr), max(te)) AS mx FROM curve),
last AS (SELECT * FROM curve ORDER BY train_size DESC LIMIT 1)
SELECT cast(train_size AS INTEGER) AS train_size, {r('tr', 4)} AS train_rmse_mean, {r('te', 4)} AS test_rmse_mean,
  {r('te - tr', 4)} AS gap,
  CASE WHEN te > 2 * tr THEN 'overfitting'
       WHEN tr > 0.9 * mx AND te > 0.9 * mx THEN 'underfitting'
       WHEN te - tr < 0.2 * te AND te < 0.7 * mx THEN 'good fit'
       ELSE 'more data may help' END AS diagnosis
FROM last, mx"""
    return sql if not whole else sql[:sql.index(",\ncurve AS")] + "\n" + tail


SQL["learning_curve"] = _learning_curve_sql()
SQL["learning_curve_uneven"] = _learning_curve_sql(7, (0.1, 0.37, 1.0), _ODD_ML, whole=True)

# --------------------------------------------------------------------------------------
# lasso and elastic net by cyclic coordinate descent on the centred Gram sums, run
# as a recursive CTE (the objective is strictly convex here, so the sweeps converge to it)
# --------------------------------------------------------------------------------------
def _penalized_sql(alpha: float, l1_ratio: float, sweeps: int = 30000) -> str:
    def g(i, j):
        i, j = min(i, j), max(i, j)
        return f"((s{i}{j} - s{i} * s{j} / n) / n)"
    def c(i):
        return f"((s{i}y - s{i} * sy / n) / n)"
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)

    def soft(x):
        return f"(sign({x}) * greatest(abs({x}) - {l1!r}, 0.0))"
    gm = ", ".join([f"{g(i, j)} AS g{i}{j}" for i in range(3) for j in range(i, 3)] + [f"{c(i)} AS c{i}" for i in range(3)]
                   + ["sy / n AS my"] + [f"s{i} / n AS m{i}" for i in range(3)])
    return f"""
WITH RECURSIVE {_LI_ML},
t AS (SELECT {_sums_select(_LX, _LY)} FROM li),
gm AS (SELECT {gm} FROM t),
cd(it, w0, w1, w2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT it + 1, w0, w1, {soft('c2 - g02 * w0 - g12 * w1')} / (g22 + {l2!r}) AS w2 FROM (
    SELECT it, w0, {soft('c1 - g01 * w0 - g12 * w2')} / (g11 + {l2!r}) AS w1, w2, c2, g02, g12, g22 FROM (
      SELECT it, {soft('c0 - g01 * w1 - g02 * w2')} / (g00 + {l2!r}) AS w0, w1, w2, c1, c2, g01, g02, g11, g12, g22
      FROM cd, gm WHERE it < {sweeps})))
SELECT 'l_quantity' AS feature, {r('w0', 4)} AS coefficient FROM cd WHERE it = {sweeps}
UNION ALL SELECT 'l_discount', {r('w1', 4)} FROM cd WHERE it = {sweeps}
UNION ALL SELECT 'l_tax', {r('w2', 4)} FROM cd WHERE it = {sweeps}
UNION ALL SELECT 'intercept', {r('my - w0 * m0 - w1 * m1 - w2 * m2', 4)} FROM cd, gm WHERE it = {sweeps}"""


SQL["lasso"] = _penalized_sql(1.0, 1.0)
SQL["enet"] = _penalized_sql(1.0, 0.5)

ORACLE_SQL = {k: v for k, v in SQL.items() if k in C.QUERIES}
