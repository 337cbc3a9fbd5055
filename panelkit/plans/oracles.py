"""The same results in plain SQL, over the same tables."""

from __future__ import annotations

from panelkit.operators.search import draw_trials

# panels

USER_DAY = """
user_day AS (
  SELECT user_id AS id,
         CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS INTEGER) AS period,
         count(*) AS cevents,
         round(sum(value), 4) AS mvalue,
         round(sum(CASE WHEN event_type = 'purchase' THEN value END), 4) AS mpurchase,
         round(sum(CASE WHEN event_type = 'click' THEN value END), 4) AS "Visa_mclick",
         round(sum(CASE WHEN event_type = 'view' THEN value END), 4) AS "Master_mview"
  FROM events GROUP BY 1, 2
)"""

SUPPLIER_MONTH = """
supplier_month AS (
  SELECT l_suppkey AS id,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym,
         count(*) AS cl,
         round(sum(l_extendedprice), 4) AS mprice,
         round(sum(l_extendedprice * l_discount), 4) AS "Visa_mdisc",
         round(sum(l_extendedprice * l_tax), 4) AS "Master_mtax",
         round(sum(l_quantity), 4) AS mqty
  FROM lineitem GROUP BY 1, 2
)"""

CUSTOMER_MONTH = """
customer_month AS (
  SELECT o_custkey AS id,
         CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym,
         count(*) AS corders,
         round(sum(o_totalprice), 4) AS mtotal
  FROM orders GROUP BY 1, 2
)"""

LEADS = """
leads AS (
  SELECT *, max(period) OVER () AS last,
         lead(period, 1) OVER w AS p1, lead(period, 2) OVER w AS p2, lead(period, 3) OVER w AS p3
  FROM user_day WINDOW w AS (PARTITION BY id ORDER BY period)
)"""

LABELLED = (
    USER_DAY
    + ","
    + LEADS
    + """,
labelled AS (
  SELECT * EXCLUDE (last, p1, p2, p3),
         CASE WHEN period < last - 1 AND period + 1 = p1 AND (p2 IS NULL OR period + 2 < p2) THEN 'BAJA+2'
              WHEN period < last AND (p1 IS NULL OR period + 1 < p1) THEN 'BAJA+1'
              WHEN period < last - 1 THEN 'CONTINUA' END AS label
  FROM leads
)"""
)


def _hash(seed: str, *keys: str) -> str:
    """32 bits of the md5 of keys and seed, as in the Spark side's hash_bits."""
    text = " || '|' || ".join([f"CAST({k} AS VARCHAR)" for k in keys] + [f"'{seed}'"])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"


def _uniform(seed: object, *keys: str) -> str:
    return f"({_hash(str(seed), *keys)} / 4294967296.0::DOUBLE)"


def _normal(seed: str, *keys: str) -> str:
    radius = f"sqrt(-2.0::DOUBLE * ln(({_hash(seed + 'a', *keys)} + 1.0::DOUBLE) / 4294967296.0::DOUBLE))"
    return f"{radius} * cos(2 * pi() * {_uniform(seed + 'b', *keys)})"


def _label_counts(panel: str, cte: str) -> str:
    """Class counts of a yyyymm panel."""
    return f"""
WITH {cte},
o AS (SELECT *, ym // 100 * 12 + ym % 100 AS p FROM {panel}),
l AS (SELECT *, max(p) OVER () AS last, lead(p, 1) OVER w AS p1, lead(p, 2) OVER w AS p2
      FROM o WINDOW w AS (PARTITION BY id ORDER BY p))
SELECT ym,
       CASE WHEN p < last - 1 AND p + 1 = p1 AND (p2 IS NULL OR p + 2 < p2) THEN 'BAJA+2'
            WHEN p < last AND (p1 IS NULL OR p + 1 < p1) THEN 'BAJA+1'
            WHEN p < last - 1 THEN 'CONTINUA' END AS label,
       count(*) AS n
FROM l GROUP BY 1, 2"""


SCORED = (
    LABELLED
    + """,
scored AS (
  SELECT l.*, r.replicate, """
    + _uniform("#", "id", "period").replace("'#'", "CAST(r.replicate AS VARCHAR)")
    + """ AS score
  FROM labelled l, (SELECT CAST(unnest([1, 2, 3, 4, 5]) AS INTEGER) AS replicate) r
),
curve AS (
  SELECT *, sum(gain) OVER w AS gain_acum, row_number() OVER w AS rank
  FROM (SELECT *, CASE WHEN label = 'BAJA+2' THEN 78 ELSE -2 END AS gain FROM scored)
  WINDOW w AS (PARTITION BY replicate ORDER BY score DESC, id, period ROWS UNBOUNDED PRECEDING)
)"""
)

POINTS_100 = SCORED + """,
points AS (
  SELECT replicate, rank AS cutoff, CAST(gain_acum AS BIGINT) AS total
  FROM curve WHERE rank % 100 = 0 AND rank BETWEEN 100 AND 2000
)"""

DEAD = SUPPLIER_MONTH + """,
panel AS (
  SELECT id, ym, cl,
         CASE WHEN ym = 199806 THEN 0.0::DOUBLE ELSE mprice END AS mprice,
         CASE WHEN ym = 199806 THEN 0.0::DOUBLE ELSE "Visa_mdisc" END AS "Visa_mdisc",
         "Master_mtax", mqty
  FROM supplier_month
)"""

MONEY = ["mprice", "Visa_mdisc", "Master_mtax", "mqty"]

POINTS_2D = """
raw AS (
  SELECT c_custkey AS id, c_acctbal AS x, coalesce(t.y, 0.0::DOUBLE) AS y
  FROM customer LEFT JOIN (
    SELECT o_custkey, round(sum(o_totalprice), 4) AS y FROM orders GROUP BY 1
  ) t ON o_custkey = c_custkey
),
points AS (
  SELECT id,
         round((x - (SELECT avg(x) FROM raw)) / (SELECT stddev_samp(x) FROM raw), 6) + 0.0::DOUBLE AS x,
         round((y - (SELECT avg(y) FROM raw)) / (SELECT stddev_samp(y) FROM raw), 6) + 0.0::DOUBLE AS y
  FROM raw
)"""

EPS, MIN_POINTS = 0.12, 12

CORE = POINTS_2D + f""",
core AS (
  SELECT a.id, CAST(count(*) >= {MIN_POINTS} AS INTEGER) AS core
  FROM points a JOIN points b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE
  GROUP BY a.id
)"""

CLUSTERS = CORE + f""",
links AS (
  SELECT a.id AS a, b.id AS b FROM points a JOIN points b
    ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {EPS}::DOUBLE * {EPS}::DOUBLE
  JOIN core c ON c.id = b.id AND c.core = 1
),
inner_links AS (SELECT a, b FROM links JOIN core c ON c.id = a AND c.core = 1),
reach(id, root) AS (
  SELECT id, id FROM core WHERE core = 1
  UNION SELECT l.b, r.root FROM reach r JOIN inner_links l ON l.a = r.id WHERE l.b > r.root
),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY 1),
numbered AS (SELECT id, dense_rank() OVER (ORDER BY root) AS cluster FROM roots),
borders AS (SELECT l.a AS id, min(n.cluster) AS cluster FROM links l JOIN numbered n ON n.id = l.b GROUP BY 1),
clusters AS (
  SELECT p.id, p.x, p.y, c.core, CAST(coalesce(n.cluster, b.cluster, 0) AS INTEGER) AS cluster
  FROM points p JOIN core c ON c.id = p.id LEFT JOIN numbered n ON n.id = p.id LEFT JOIN borders b ON b.id = p.id
)"""

PART_IMPORTANCES = """
importances AS (
  SELECT CASE WHEN l_partkey % 20 = 0 THEN 'canarito_' || lpad(CAST(l_partkey AS VARCHAR), CAST(greatest(3, length(CAST(l_partkey AS VARCHAR))) AS INTEGER), '0')
              ELSE 'part_' || CAST(l_partkey AS VARCHAR) END AS feature,
         l_linenumber AS seed,
         round(sum(l_extendedprice), 4) AS importance,
         round(sum(l_quantity), 4) AS cover,
         count(*) AS frequency
  FROM lineitem GROUP BY 1, 2
),
means AS (
  SELECT feature, sum(importance) / (SELECT count(DISTINCT seed) FROM importances) AS importance
  FROM importances GROUP BY 1
)"""

SLOPE = (
    "CASE WHEN count({c}) OVER recent >= 2 THEN round(regr_slope({c}, rn) OVER recent, {d}) + 0.0 END AS {c}_tend6"
)

_TRIALS = "trials AS (SELECT c_custkey AS trial_number, c_acctbal AS value, c_nationkey AS nation FROM customer)"


def _quantile_columns(classes: list[str], columns: list[str], probs: list[float]) -> list[tuple[str, str, float, str]]:
    return [
        (k, c, p, f"dist_{k}_q{round(p * 100):g}_{c}") for k in classes for c in columns for p in probs
    ]


_CLASSES = ["CONTINUA", "BAJA+1", "BAJA+2"]
_GLOBAL = _quantile_columns(_CLASSES, ["mvalue", "mpurchase"], [0.1, 0.5, 0.9])
_ROLLING = _quantile_columns(_CLASSES, ["mvalue", "mpurchase"], [0.2, 0.5, 0.8])


def _marks(names: list[tuple[str, str, float, str]], source: str = "") -> str:
    return ", ".join(f"quantile_cont({source}{c}, {p}) FILTER ({source}label = '{k}') AS \"m_{n}\"" for k, c, p, n in names)


def _distances(names: list[tuple[str, str, float, str]]) -> str:
    return ", ".join(f"round(l.{c} - q.\"m_{n}\", 5) + 0.0 AS \"{n}\"" for _, c, _, n in names)


def _search_space() -> str:
    u = {p: _uniform(p, "c_custkey") for p in (
        "num_iterations_exp", "learning_rate_exp", "feature_fraction", "min_data_exp", "num_leaves_exp")}
    return f"""
WITH n AS (SELECT count(*) AS rows FROM lineitem),
decoded AS (
  SELECT c_custkey AS trial_number,
         CAST(round_even(pow(2.0::DOUBLE, 0.0 + {u['num_iterations_exp']} * (11.1::DOUBLE - 0.0::DOUBLE)), 0) AS BIGINT) AS num_iterations,
         round(pow(2.0::DOUBLE, -8.0::DOUBLE + {u['learning_rate_exp']} * 7.0::DOUBLE), 9) + 0.0 AS learning_rate,
         round(0.05::DOUBLE + {u['feature_fraction']} * (1.0::DOUBLE - 0.05::DOUBLE), 9) + 0.0 AS feature_fraction,
         CAST(round_even(pow(2.0::DOUBLE, {u['min_data_exp']} * log2(rows / 2.0::DOUBLE)), 0) AS BIGINT) AS min_data_in_leaf,
         CAST(round_even(pow(2.0::DOUBLE, 1.0::DOUBLE + {u['num_leaves_exp']} * 9.0::DOUBLE), 0) AS BIGINT) AS num_leaves,
         rows
  FROM customer, n
)
SELECT *, CAST(min_data_in_leaf * num_leaves > rows AS INTEGER) AS rejected FROM decoded"""


def _tuned_gain() -> str:
    """The draws are the search's own; their decoding and which of them are impossible follow from the rows."""
    draws = ", ".join(
        f"({i}, {d['num_iterations_exp']!r}, {d['min_data_exp']!r}, {d['num_leaves_exp']!r})"
        for i, d in enumerate(draw_trials(4, 1))
    )
    return f"""
WITH {LABELLED},
n AS (
  SELECT count(*) FILTER (label <> 'CONTINUA') + CAST(floor(count(*) FILTER (label = 'CONTINUA') * 0.5::DOUBLE) AS BIGINT) AS rows
  FROM labelled WHERE period BETWEEN 1 AND 20
),
decoded AS (
  SELECT trial_number, CAST(round_even(pow(2.0::DOUBLE, it * 4.0::DOUBLE), 0) AS BIGINT) AS num_iterations,
         CAST(round_even(pow(2.0::DOUBLE, md * 3.0::DOUBLE), 0) AS BIGINT) AS min_data,
         CAST(round_even(pow(2.0::DOUBLE, 1.0::DOUBLE + lv * 3.0::DOUBLE), 0) AS BIGINT) AS num_leaves
  FROM (VALUES {draws}) AS d(trial_number, it, md, lv)
)
SELECT CAST(trial_number AS INTEGER) AS trial_number, 'COMPLETE' AS state, num_iterations, num_leaves,
       CAST(min_data * num_leaves > rows AS INTEGER) AS rejected
FROM decoded, n"""


def _each(columns: list[str], text: str) -> str:
    return ", ".join(text.format(c=c, q=f'"{c}"') for c in columns)


ORACLES: dict[str, str] = {
    "label_counts": f"WITH {LABELLED} SELECT period, label, count(*) AS n FROM labelled GROUP BY 1, 2",
    "label_counts_suppliers": _label_counts("supplier_month", SUPPLIER_MONTH),
    "label_counts_customers": _label_counts("customer_month", CUSTOMER_MONTH),
    "label_pivot": f"""
WITH {LABELLED}
SELECT period,
       count(*) FILTER (label = 'BAJA+1') AS "BAJA+1", count(*) FILTER (label = 'BAJA+2') AS "BAJA+2",
       count(*) FILTER (label = 'CONTINUA') AS "CONTINUA", count(*) FILTER (label IS NULL) AS "NA"
FROM labelled GROUP BY 1""",
    "label4_counts": f"""
WITH {USER_DAY},{LEADS}
SELECT CASE WHEN period < last - 2 AND period + 1 = p1 AND period + 2 = p2 AND (p3 IS NULL OR period + 3 < p3) THEN 'BAJA+3'
            WHEN period < last - 1 AND period + 1 = p1 AND (p2 IS NULL OR period + 2 < p2) THEN 'BAJA+2'
            WHEN period < last AND (p1 IS NULL OR period + 1 < p1) THEN 'BAJA+1'
            WHEN period < last - 2 THEN 'CONTINUA' END AS label,
       count(*) AS n
FROM leads GROUP BY 1""",
    "label4_rows": f"""
WITH {USER_DAY},{LEADS}
SELECT id, period,
       CASE WHEN period < last - 2 AND period + 1 = p1 AND period + 2 = p2 AND (p3 IS NULL OR period + 3 < p3) THEN 'BAJA+3'
            WHEN period < last - 1 AND period + 1 = p1 AND (p2 IS NULL OR period + 2 < p2) THEN 'BAJA+2'
            WHEN period < last AND (p1 IS NULL OR period + 1 < p1) THEN 'BAJA+1'
            WHEN period < last - 2 THEN 'CONTINUA' END AS label
FROM leads""",
    "target_modes": f"""
WITH {LABELLED}
SELECT id, period,
       CASE WHEN label = 'CONTINUA' THEN 0 WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 END AS target,
       CASE WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 ELSE 0 END AS target_filled,
       CASE WHEN label = 'BAJA+2' THEN 1 ELSE 0 END AS strict,
       CAST(period BETWEEN 1 AND 20 AS TINYINT) AS training
FROM labelled""",
    "cluster_class_tenure": f"""
WITH {LABELLED},
t AS (SELECT id, period, period - min(period) OVER (PARTITION BY id) AS tenure,
             CASE WHEN label IN ('BAJA+1', 'BAJA+2') THEN 'BAJA' WHEN label = 'CONTINUA' THEN 'CONTINUA' END AS leaver
      FROM labelled)
SELECT * FROM t WHERE tenure >= 12 OR leaver = 'BAJA'""",
    "tenure_modes": f"""
WITH {CUSTOMER_MONTH},
o AS (SELECT id, ym, ym // 100 AS y, ym % 100 AS m FROM customer_month)
SELECT id, ym,
       CAST(y * 12 + m - min(y * 12 + m) OVER (PARTITION BY id) AS INTEGER) AS tenure,
       CAST((y - min(y) OVER (PARTITION BY id)) * 12 + m - min(m) OVER (PARTITION BY id) AS INTEGER) AS tenure_reference
FROM o""",
    "lag_delta_chained": f"""
WITH {SUPPLIER_MONTH}
SELECT *, {_each(MONEY, """lag({q}, 1) OVER w AS "{c}_lag_1", lag({q}, 2) OVER w AS "{c}_lag_2",
       round({q} - lag({q}, 1) OVER w, 4) + 0.0 AS "{c}_delta_lag_1",
       round(lag({q}, 1) OVER w - lag({q}, 2) OVER w, 4) + 0.0 AS "{c}_delta_lag_2" """)}
FROM supplier_month WINDOW w AS (PARTITION BY id ORDER BY ym)""",
    "lag_delta_anchored": f"""
WITH {SUPPLIER_MONTH}
SELECT *, {", ".join(f'lag({c}, {i}) OVER w AS {c}_lag{i}' for c in ("cl", "mprice") for i in (1, 2, 3, 6, 12))},
       cl - lag(cl, 1) OVER w AS cl_delta1, cl - lag(cl, 2) OVER w AS cl_delta2,
       round(mprice - lag(mprice, 1) OVER w, 4) + 0.0 AS mprice_delta1,
       round(mprice - lag(mprice, 2) OVER w, 4) + 0.0 AS mprice_delta2
FROM supplier_month WINDOW w AS (PARTITION BY id ORDER BY ym)""",
    "lag_calendar": f"""
WITH {CUSTOMER_MONTH},
o AS (SELECT *, ym // 100 * 12 + ym % 100 AS p FROM customer_month)
SELECT a.id, a.ym, a.corders, a.mtotal,
       b.corders AS corders_lag_1, c.corders AS corders_lag_2, b.mtotal AS mtotal_lag_1, c.mtotal AS mtotal_lag_2
FROM o a LEFT JOIN o b ON b.id = a.id AND b.p = a.p - 1 LEFT JOIN o c ON c.id = a.id AND c.p = a.p - 2""",
    "trend_window": f"""
WITH {SUPPLIER_MONTH},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ym) AS rn FROM supplier_month)
SELECT id, ym, {SLOPE.format(c="cl", d=6)}, {SLOPE.format(c="mprice", d=3)}, {SLOPE.format(c="mqty", d=4)}
FROM r WINDOW recent AS (PARTITION BY id ORDER BY ym ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "trend_window_nulls": f"""
WITH {USER_DAY},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY period) AS rn FROM user_day)
SELECT id, period, {SLOPE.format(c="mpurchase", d=5)}, {SLOPE.format(c="Visa_mclick", d=5)}
FROM r WINDOW recent AS (PARTITION BY id ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "window_ratios": f"""
WITH {SUPPLIER_MONTH},
s AS (
  SELECT *, {_each(["mprice", "cl"], """count({c}) OVER recent AS n_{c}, min({c}) OVER recent AS lo_{c},
         max({c}) OVER recent AS hi_{c}, avg({c}) OVER recent AS av_{c}""")}
  FROM supplier_month WINDOW recent AS (PARTITION BY id ORDER BY ym ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)
)
SELECT id, ym, {_each(["mprice", "cl"], """
       CASE WHEN n_{c} >= 2 THEN lo_{c} END AS {c}_min6, CASE WHEN n_{c} >= 2 THEN hi_{c} END AS {c}_max6,
       CASE WHEN n_{c} >= 2 THEN round(av_{c}, 4) + 0.0 END AS {c}_avg6,
       CASE WHEN n_{c} >= 2 THEN round({c} / nullif(av_{c}, 0), 4) + 0.0 END AS {c}_ratioavg6,
       CASE WHEN n_{c} >= 2 THEN round({c} / nullif(hi_{c}, 0)::DOUBLE, 4) + 0.0 END AS {c}_ratiomax6""")}
FROM s""",
    "feature_block": f"""
WITH {SUPPLIER_MONTH},
o AS (SELECT *, ym // 100 * 12 + ym % 100 AS p FROM supplier_month),
r AS (SELECT *, row_number() OVER w AS rn, max(p) OVER () AS last, lead(p, 1) OVER w AS p1, lead(p, 2) OVER w AS p2,
             {_each(MONEY, 'count({q}) OVER recent AS "n_{c}", max({q}) OVER recent AS "hi_{c}", avg({q}) OVER recent AS "av_{c}"')}
      FROM o WINDOW w AS (PARTITION BY id ORDER BY ym),
                    recent AS (PARTITION BY id ORDER BY ym ROWS BETWEEN 5 PRECEDING AND CURRENT ROW))
SELECT id, ym, cl, mprice, "Visa_mdisc", "Master_mtax", mqty,
       CASE WHEN p < last - 1 AND p + 1 = p1 AND (p2 IS NULL OR p + 2 < p2) THEN 'BAJA+2'
            WHEN p < last AND (p1 IS NULL OR p + 1 < p1) THEN 'BAJA+1'
            WHEN p < last - 1 THEN 'CONTINUA' END AS label,
       {_each(MONEY, """lag({q}, 1) OVER w AS "{c}_lag_1", lag({q}, 2) OVER w AS "{c}_lag_2",
       round({q} - lag({q}, 1) OVER w, 4) + 0.0 AS "{c}_delta_lag_1",
       round(lag({q}, 1) OVER w - lag({q}, 2) OVER w, 4) + 0.0 AS "{c}_delta_lag_2",
       CASE WHEN "n_{c}" >= 2 THEN round(regr_slope({q}, rn) OVER recent, CASE '{c}' WHEN 'mprice' THEN 3 ELSE 5 END) + 0.0 END AS "{c}_tend6",
       CASE WHEN "n_{c}" >= 2 THEN round({q} / nullif("av_{c}", 0), 8) + 0.0 END AS "{c}_ratioavg6",
       CASE WHEN "n_{c}" >= 2 THEN round({q} / nullif("hi_{c}", 0), 8) + 0.0 END AS "{c}_ratiomax6" """)}
FROM r WINDOW w AS (PARTITION BY id ORDER BY ym),
              recent AS (PARTITION BY id ORDER BY ym ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "history_p95": f"""
WITH {USER_DAY},
e AS (SELECT *, quantile_cont(abs(mvalue), 0.95) OVER w AS a, quantile_cont(abs(mpurchase), 0.95) OVER w AS b
      FROM user_day WINDOW w AS (PARTITION BY id ORDER BY period ROWS UNBOUNDED PRECEDING))
SELECT id, period,
       round(sign(mvalue) * abs(mvalue) / nullif(max(a) OVER w, 0), 5) + 0.0 AS mvalue,
       round(sign(mpurchase) * abs(mpurchase) / nullif(max(b) OVER w, 0), 5) + 0.0 AS mpurchase
FROM e WINDOW w AS (PARTITION BY id ORDER BY period ROWS UNBOUNDED PRECEDING)""",
    "intra_row_features": f"""
WITH {SUPPLIER_MONTH},
t AS (SELECT *, ym // 100 * 12 + ym % 100 AS p, min(ym // 100 * 12 + ym % 100) OVER (PARTITION BY id) AS p0
      FROM supplier_month)
SELECT id, ym, CAST(ym % 100 AS INTEGER) AS kmes, CAST(p AS INTEGER) AS ordinal,
       round(cl * CASE p - p0 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0 WHEN 3 THEN 1.2 ELSE 1.0 END, 6) + 0.0 AS cl_normalised,
       mprice / nullif(mqty, 0) AS mprice_per_qty
FROM t""",
    "family_sum": f"""
WITH {USER_DAY}
SELECT id, period, cevents, coalesce(mpurchase, 0) AS mpurchase, coalesce("Visa_mclick", 0) AS "Visa_mclick",
       coalesce("Master_mview", 0) AS "Master_mview",
       round(coalesce(mpurchase, 0) + coalesce("Visa_mclick", 0) + coalesce("Master_mview", 0), 4) + 0.0 AS suma_m_visa_master
FROM user_day""",
    "distinct_periods": f"WITH {SUPPLIER_MONTH} SELECT DISTINCT ym FROM supplier_month",
    "snapshot_union": f"WITH {SUPPLIER_MONTH} SELECT * FROM supplier_month WHERE ym IN (199712, 199801, 199806, 200003)",
    "canary_first_order": f"""
WITH {USER_DAY}
SELECT {", ".join(f"round({_normal(f'4177-{i}', 'id', 'period')}, 6) + 0.0 AS canarito_{i:03d}" for i in range(2))},
       {", ".join(f"round({_uniform(f'7-{i}', 'id', 'period')}, 6) + 0.0 AS canarito_{i}" for i in range(1, 4))},
       id, period
FROM user_day""",
    "undersample_exact": f"""
WITH {LABELLED},
t AS (SELECT id, period, CASE WHEN label = 'CONTINUA' THEN 0 WHEN label IN ('BAJA+1', 'BAJA+2') THEN 1 END AS target
      FROM labelled),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {_hash("4177", "id", "period")}, id, period) AS rn,
             count(*) OVER (PARTITION BY target) AS n
      FROM t WHERE target IS NOT NULL)
SELECT id, period, target FROM r WHERE target = 1 OR rn <= floor(n * 0.1::DOUBLE)""",
    "undersample_bernoulli": f"""
WITH {LABELLED}
SELECT id, period, label FROM labelled
WHERE {_uniform(4177, "id", "period")} <= 0.05 OR label IN ('BAJA+1', 'BAJA+2')""",
    "class_weights": f"""
WITH {LABELLED}
SELECT id, period, label, CASE WHEN label IS NOT NULL THEN 1.0::DOUBLE / count(*) OVER (PARTITION BY label) END AS weight
FROM labelled""",
    "dead_flags": f"""
WITH {DEAD}
SELECT ym,
       {_each(MONEY, """CAST(max(CASE WHEN {q} <> 0 THEN 1 END) IS NULL AS INTEGER) AS "_dead_{c}",
       CAST(coalesce(sum({q}), 0) = 0 AS INTEGER) AS "zero_{c}" """)}
FROM panel GROUP BY ym""",
    "dead_all_zero": f"""
WITH {DEAD},
f AS (SELECT ym, max(CASE WHEN cl <> 0 THEN 1 END) IS NULL AS "d_cl",
             {_each(MONEY, 'max(CASE WHEN {q} <> 0 THEN 1 END) IS NULL AS "d_{c}"')} FROM panel GROUP BY ym)
SELECT id, ym, CASE WHEN NOT "d_cl" THEN cl END AS cl, {_each(MONEY, 'CASE WHEN NOT "d_{c}" THEN {q} END AS {q}')}
FROM panel JOIN f USING (ym)""",
    "dead_zero_sum": f"""
WITH {DEAD},
f AS (SELECT ym, {_each(MONEY, 'coalesce(sum({q}), 0) = 0 AS "d_{c}"')} FROM panel GROUP BY ym)
SELECT id, ym, cl, {_each(MONEY, 'CASE WHEN NOT ("d_{c}" AND {q} = 0) THEN {q} END AS {q}')}
FROM panel JOIN f USING (ym)""",
    "dead_month_interpolated": f"""
WITH {DEAD},
f AS (SELECT *, lag(ym) OVER (ORDER BY ym) AS prev, lead(ym) OVER (ORDER BY ym) AS next
      FROM (SELECT ym, {_each(MONEY, 'max(CASE WHEN {q} <> 0 THEN 1 END) IS NULL AS "d_{c}"')} FROM panel GROUP BY ym))
SELECT t.id, t.ym, t.cl,
       {_each(MONEY, 'CASE WHEN f."d_{c}" AND prev IS NOT NULL AND next IS NOT NULL THEN (a.{q} + b.{q}) / 2 ELSE t.{q} END AS {q}')}
FROM panel t JOIN f ON f.ym = t.ym
LEFT JOIN panel a ON a.id = t.id AND a.ym = f.prev LEFT JOIN panel b ON b.id = t.id AND b.ym = f.next""",
    "time_interpolated": f"""
WITH {DEAD},
o AS (SELECT *, ym // 100 * 12 + ym % 100 AS p FROM panel),
k AS (SELECT *, {_each(MONEY, """
        last_value(CASE WHEN {q} <> 0 THEN p END IGNORE NULLS) OVER past AS "pa_{c}",
        last_value(CASE WHEN {q} <> 0 THEN {q} END IGNORE NULLS) OVER past AS "va_{c}",
        first_value(CASE WHEN {q} <> 0 THEN p END IGNORE NULLS) OVER future AS "pb_{c}",
        first_value(CASE WHEN {q} <> 0 THEN {q} END IGNORE NULLS) OVER future AS "vb_{c}" """)}
      FROM o WINDOW past AS (PARTITION BY id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    future AS (PARTITION BY id ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT id, ym, cl, {_each(MONEY, """
       CASE WHEN {q} = 0 AND "pa_{c}" IS NOT NULL AND "pb_{c}" IS NOT NULL
            THEN "va_{c}" + ("vb_{c}" - "va_{c}") * (p - "pa_{c}") / ("pb_{c}" - "pa_{c}") ELSE {q} END AS {q}""")}
FROM k""",
    "median_drift": f"""
WITH {SUPPLIER_MONTH},
f AS (SELECT median(mprice) FILTER (ym BETWEEN 199712 AND 199805) / nullif(median(mprice) FILTER (ym = 199806), 0) AS a,
             median(mqty) FILTER (ym BETWEEN 199712 AND 199805) / nullif(median(mqty) FILTER (ym = 199806), 0) AS b
      FROM supplier_month)
SELECT id, ym, cl,
       round(CASE WHEN ym = 199806 THEN mprice * coalesce(a, 1) ELSE mprice END, 3) + 0.0 AS mprice,
       "Visa_mdisc", "Master_mtax",
       round(CASE WHEN ym = 199806 THEN mqty * coalesce(b, 1) ELSE mqty END, 4) + 0.0 AS mqty
FROM supplier_month, f""",
    "median_drift_reference": f"""
WITH {SUPPLIER_MONTH},
f AS (SELECT median(mprice) FILTER (ym >= 199797 AND ym < 199803) / nullif(median(mprice) FILTER (ym = 199803), 0) AS a
      FROM supplier_month)
SELECT id, ym, cl, round(CASE WHEN ym = 199803 THEN mprice * coalesce(a, 1) ELSE mprice END, 3) + 0.0 AS mprice,
       "Visa_mdisc", "Master_mtax", mqty
FROM supplier_month, f""",
    "limit_means": f"""
WITH {SUPPLIER_MONTH}
SELECT ym, round(avg("Visa_mdisc"), 7) + 0.0 AS mean_a, round(avg("Master_mtax"), 7) + 0.0 AS mean_b,
       round(avg(("Visa_mdisc" + "Master_mtax") / 2), 8) + 0.0 AS mean_both
FROM supplier_month GROUP BY ym""",
    "scale_by_limit": f"""
WITH {SUPPLIER_MONTH},
m AS (SELECT ym, avg(("Visa_mdisc" + "Master_mtax") / 2) AS lim FROM supplier_month GROUP BY ym)
SELECT id, s.ym, cl, round(mprice * 10000 / nullif(lim, 0), 4) + 0.0 AS mprice, "Visa_mdisc", "Master_mtax",
       round(mqty * 10000 / nullif(lim, 0), 5) + 0.0 AS mqty
FROM supplier_month s JOIN m ON m.ym = s.ym""",
    "deflate": f"""
WITH {SUPPLIER_MONTH}
SELECT id, ym, cl,
       {_each(MONEY, """CASE WHEN ym < 200101
            THEN {q} / (1.0::DOUBLE + 0.005::DOUBLE * (ym // 100 * 12 + ym % 100 - 23941)) END AS {q}""")}
FROM supplier_month""",
    "scale_by_p95": f"""
WITH {SUPPLIER_MONTH},
q AS (SELECT ym, {_each(MONEY, 'quantile_disc(abs({q}), 0.95) AS "p_{c}"')} FROM supplier_month GROUP BY ym)
SELECT id, s.ym, cl, {_each(MONEY, 'round({q} / nullif("p_{c}", 0), 6) + 0.0 AS {q}')}
FROM supplier_month s JOIN q ON q.ym = s.ym""",
    "scale_by_p95_interpolated": f"""
WITH {USER_DAY},
q AS (SELECT period, {_each(["mvalue", "mpurchase", "Visa_mclick", "Master_mview"], 'quantile_cont(abs({q}), 0.95) AS "p_{c}"')}
      FROM user_day GROUP BY period)
SELECT id, s.period, cevents,
       {_each(["mvalue", "mpurchase", "Visa_mclick", "Master_mview"], 'round({q} / nullif("p_{c}", 0), 6) + 0.0 AS {q}')}
FROM user_day s JOIN q ON q.period = s.period""",
    "period_moments": f"""
WITH {SUPPLIER_MONTH}
SELECT ym, round(avg(mprice), 7) + 0.0 AS mprice_mean, round(avg(cl), 7) + 0.0 AS cl_mean,
       round(stddev_samp(mprice), 5) + 0.0 AS mprice_std, round(stddev_samp(cl), 6) + 0.0 AS cl_std
FROM supplier_month GROUP BY ym""",
    "projection_terms": f"""
WITH {SUPPLIER_MONTH},
l AS (SELECT *, lag(mprice, 1) OVER (PARTITION BY id ORDER BY ym) AS mprice_lag_1 FROM supplier_month),
z AS (SELECT id, ym, {_each(["mprice", "cl", "mqty", "mprice_lag_1"],
      "({c} - avg({c}) OVER m) / nullif(stddev_samp({c}) OVER m, 0) AS z_{c}")} FROM l WINDOW m AS (PARTITION BY ym))
SELECT id, ym,
       round(z_mprice * -0.61 + z_cl * 0.18 + z_mqty * 0.25 + z_mprice_lag_1 * 0.14, 6) + 0.0 AS ppr_term_1,
       round(z_mprice * -0.42 + z_cl * -0.77 + z_mqty * 0.36 + z_mprice_lag_1 * -0.33, 6) + 0.0 AS ppr_term_2
FROM z""",
    "class_quantile_global": f"""
WITH {LABELLED},
q AS (SELECT {_marks(_GLOBAL)} FROM labelled WHERE period <= 20)
SELECT id, period, {_distances(_GLOBAL)} FROM labelled l, q""",
    "class_quantile_rolling": f"""
WITH {LABELLED},
q AS (SELECT m.period, {_marks(_ROLLING, "e.")}
      FROM (SELECT DISTINCT period FROM labelled) m JOIN labelled e ON e.period < m.period GROUP BY m.period)
SELECT id, l.period, {_distances(_ROLLING)} FROM labelled l LEFT JOIN q ON q.period = l.period""",
    "importance_report": f"""
WITH {PART_IMPORTANCES},
r AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS t, row_number() OVER (ORDER BY importance, feature) AS b
      FROM means)
SELECT feature, round(importance, 4) + 0.0 AS importance, 'top' AS part FROM r WHERE t <= 10
UNION ALL SELECT feature, round(importance, 4) + 0.0, 'bottom' FROM r WHERE b <= 10""",
    "importance_detail": f"""
WITH {PART_IMPORTANCES}
SELECT feature, round(avg(importance), 6) + 0.0 AS importance, round(avg(cover), 6) + 0.0 AS cover,
       round(avg(frequency), 6) + 0.0 AS frequency, count(*) AS models
FROM importances GROUP BY feature""",
    "canary_selection": f"""
WITH {PART_IMPORTANCES}
SELECT feature, round(importance, 4) + 0.0 AS importance FROM means
WHERE feature NOT LIKE 'canarito%'
  AND importance > (SELECT quantile_cont(importance, 0.05) FROM means WHERE feature LIKE 'canarito%')""",
    "gain_curve": f"""
WITH {SCORED}
SELECT id, period, label, gain, CAST(gain_acum AS BIGINT) AS gain_acum, rank FROM curve WHERE replicate = 1""",
    "gain_peak": f"""
WITH {SCORED},
p AS (SELECT replicate, max(gain_acum) AS top FROM curve GROUP BY 1),
a AS (SELECT c.replicate, min(rank) AS peak_rank, any_value(top) AS top
      FROM curve c JOIN p ON p.replicate = c.replicate AND c.gain_acum = p.top GROUP BY 1)
SELECT a.replicate, peak_rank, round(avg(gain_acum), 6) + 0.0 AS mean_gain, CAST(any_value(top) AS DOUBLE) AS max_gain
FROM a JOIN curve c ON c.replicate = a.replicate AND c.rank BETWEEN peak_rank - 500 AND peak_rank + 500
GROUP BY 1, 2""",
    "gain_cutoffs": f"WITH {POINTS_100} SELECT * FROM points",
    "gain_best_cutoff": f"""
WITH {POINTS_100},
r AS (SELECT *, row_number() OVER (PARTITION BY replicate ORDER BY total DESC, cutoff) AS k
      FROM points WHERE cutoff BETWEEN 300 AND 1900)
SELECT replicate, total AS best_total, cutoff AS best_cutoff FROM r WHERE k = 1""",
    "gain_smoothed": f"""
WITH {SCORED},
fine AS (SELECT replicate, rank AS cutoff, CAST(gain_acum AS BIGINT) AS total
         FROM curve WHERE rank % 50 = 0 AND rank BETWEEN 50 AND 2000)
SELECT *, CASE WHEN count(*) OVER w = 20 THEN round(avg(total) OVER w, 6) + 0.0 END AS smooth
FROM fine WINDOW w AS (PARTITION BY replicate ORDER BY cutoff ROWS BETWEEN 9 PRECEDING AND 10 FOLLOWING)""",
    "update_join_gain": f"""
WITH {SCORED}
SELECT replicate, CAST(sum(CASE WHEN label = 'BAJA+2' THEN 780000 ELSE -20000 END) AS BIGINT) AS total
FROM curve WHERE rank <= 500 GROUP BY 1""",
    "ensemble_mean": f"WITH {SCORED} SELECT id, period, round(avg(score), 9) + 0.0 AS score, any_value(label) AS label FROM scored GROUP BY 1, 2",
    "score_summary": f"""
WITH {SCORED}, m AS (SELECT avg(score) AS s FROM scored GROUP BY id, period)
SELECT round(min(s), 9) + 0.0 AS min_score, round(max(s), 9) + 0.0 AS max_score, count(DISTINCT round(s, 4)) AS distinct_rounded
FROM m""",
    "replicate_matrix": f"""
WITH {POINTS_100}
SELECT replicate, {", ".join(f"max(total) FILTER (cutoff = {c}) AS e{c}" for c in range(100, 2001, 100))}
FROM points GROUP BY 1""",
    "mean_gains": f"""
WITH {POINTS_100}, m AS (SELECT cutoff, avg(total) AS total FROM points GROUP BY 1)
SELECT cutoff, round(total, 6) + 0.0 AS total,
       CAST(row_number() OVER (ORDER BY total DESC, cutoff) = 1 AS INTEGER) AS best
FROM m""",
    "experiment_ledger": f"""
WITH {POINTS_100},
e AS (SELECT {", ".join(f"round(avg(total) FILTER (cutoff = {c}), 6) + 0.0 AS e{c}" for c in range(100, 2001, 100))} FROM points)
SELECT e.*, x.experiment FROM e, (SELECT unnest(['first', 'second']) AS experiment) x""",
    "consensus_submission": f"""
WITH {POINTS_100},
best AS (SELECT max(total) AS t FROM (SELECT cutoff, avg(total) AS total FROM points GROUP BY 1)),
n AS (SELECT replicate, rank FROM curve, best ORDER BY abs(gain_acum - t), replicate, rank LIMIT 1)
SELECT id, period, c.rank, CAST(c.rank <= n.rank AS INTEGER) AS predicted FROM curve c JOIN n ON n.replicate = c.replicate""",
    "trial_stats": f"""
WITH {_TRIALS}
SELECT count(*) AS trials, max(value) AS best, min(value) AS worst, round(avg(value), 4) + 0.0 AS mean FROM trials""",
    "top_trials": f"WITH {_TRIALS} SELECT * FROM trials ORDER BY value DESC, trial_number LIMIT 5",
    "best_trial": f"WITH {_TRIALS} SELECT * FROM trials WHERE value > -1000000 ORDER BY value DESC, trial_number LIMIT 1",
    "shuffled_rows": f"""
WITH {SUPPLIER_MONTH}
SELECT id, ym, row_number() OVER (ORDER BY {_hash("4177", "id", "ym")}, id, ym) AS place FROM supplier_month""",
    "density_clusters": f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters",
    "cluster_classes": f"""
WITH RECURSIVE {CLUSTERS}
SELECT cluster, {", ".join(f"count(*) FILTER (c_mktsegment = '{s}') AS {s}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))}
FROM clusters JOIN customer ON c_custkey = id GROUP BY 1""",
    "cluster_density": f"""
WITH RECURSIVE {CLUSTERS}
SELECT cluster, CAST(CASE WHEN y < -2 THEN 0 WHEN y >= 2 THEN 17 ELSE floor((y + 2.0) / 4.0 * 16) + 1 END AS INTEGER) AS bin,
       count(*) AS n
FROM clusters GROUP BY 1, 2""",
    "future_customers": f"WITH {USER_DAY} SELECT id FROM user_day WHERE period = 29",
    "rolling_scored": f"""
WITH {LABELLED},
weekly AS (SELECT id, period, label, CAST(period // 7 AS INTEGER) AS week FROM labelled),
places AS (SELECT week, row_number() OVER (ORDER BY week) AS pos FROM (SELECT DISTINCT week FROM weekly)),
usable AS (
  SELECT a.week FROM places a JOIN places b ON b.pos BETWEEN a.pos - 5 AND a.pos - 2 JOIN weekly w ON w.week = b.week
  WHERE w.label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT w.label = 'CONTINUA') = 2
)
SELECT id, period, label, week IN (SELECT week FROM usable) AS scored FROM weekly""",
    "tuned_trials": _tuned_gain(),
    "trial_log": f"""
WITH {_TRIALS}
SELECT CAST(trial_number AS INTEGER) AS trial_number, value, CAST(nation AS DOUBLE) AS nation, 'COMPLETE' AS state,
       202101 AS train_from
FROM trials""",
    "search_space": _search_space(),
    "rolling_schedule": f"""
WITH {USER_DAY},
p AS (SELECT period, row_number() OVER (ORDER BY period) AS pos FROM (SELECT DISTINCT period FROM user_day))
SELECT a.period AS score_period, b.period AS train_period FROM p a JOIN p b ON b.pos BETWEEN a.pos - 5 AND a.pos - 2""",
    "zscore": f"WITH {POINTS_2D} SELECT * FROM points",
    "density_core": f"WITH {CORE} SELECT * FROM core",
    "core_contingency": f"""
WITH {CORE}
SELECT core, {", ".join(f"count(*) FILTER (c_mktsegment = '{s}') AS {s}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))}
FROM core JOIN customer ON c_custkey = id GROUP BY 1""",
    "axis_histogram": f"""
WITH {POINTS_2D}
SELECT c_mktsegment,
       CAST(CASE WHEN y < -2 THEN 0 WHEN y >= 2 THEN 17 ELSE floor((y + 2.0) / 4.0 * 16) + 1 END AS INTEGER) AS bin,
       count(*) AS n
FROM points JOIN customer ON c_custkey = id GROUP BY 1, 2""",
    "panel_roundtrip": f"WITH {SUPPLIER_MONTH} SELECT * FROM supplier_month",
    "predictions_roundtrip": f"""
WITH {SCORED}
SELECT id, period AS ym, round(score, 6) AS score, CAST(gain_acum AS BIGINT) AS gain_acum, replicate FROM curve""",
    "importances_roundtrip": f"WITH {PART_IMPORTANCES} SELECT feature, round(importance, 4) + 0.0 AS importance FROM means",
    "curve_report": f"""
WITH {SCORED}
SELECT CAST(gain_acum AS BIGINT) AS best_total, rank AS best_cutoff FROM curve WHERE replicate = 1 AND rank <= 30000
ORDER BY gain_acum DESC, rank LIMIT 1""",
    "submission_roundtrip": f"""
WITH {SCORED}
SELECT id, count(*) AS n, CAST(sum(CAST(rank <= 1100 AS INTEGER)) AS BIGINT) AS predicted
FROM curve WHERE replicate = 1 GROUP BY 1""",
}

#: the same rows, however the panel lies and whenever its months arrive
ORACLES["feature_block_by_customer"] = ORACLES["arriving_months"] = ORACLES["feature_block"]

_NARROWED = ("cevents", "mvalue", "mpurchase", "Visa_mclick", "Master_mview")
ORACLES["canary_narrowed"] = f"""
WITH {USER_DAY},
long AS ({" UNION ALL ".join(f"""SELECT id, period, '{c}' AS feature, CAST("{c}" AS DOUBLE) AS value FROM user_day""" for c in _NARROWED)}),
marks AS (
  SELECT quantile_cont(n, 0.5) AS mark FROM (SELECT unnest([{", ".join(f"count(*) FILTER (period % {k} = 0)" for k in (2, 3, 4))}]) AS n FROM user_day)
),
kept AS (SELECT feature FROM long GROUP BY 1 HAVING count(*) FILTER (value > 0) > (SELECT mark FROM marks))
SELECT id, period, feature, value FROM long SEMI JOIN kept USING (feature)"""
