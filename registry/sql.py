"""The shared tables again, as SQL for the comparison engine."""

from __future__ import annotations

NUMERIC = ("current_price", "raw_price", "discount", "likes_count")

PRODUCTS = """
products AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS row_id,
         row_id + 1 AS id,
         p_type AS category, p_brand AS subcategory, p_name AS name,
         CASE WHEN NOT (l_linenumber = 7 AND l_returnflag = 'R')
              THEN l_extendedprice * (CASE WHEN l_orderkey % 40 = 0 THEN 8 ELSE 1 END) * (1 - l_discount) END AS current_price,
         CASE WHEN NOT (l_linenumber = 6 AND l_returnflag = 'A')
              THEN l_extendedprice * (CASE WHEN l_orderkey % 40 = 0 THEN 8 ELSE 1 END) END AS raw_price,
         'USD' AS currency,
         CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN NULL
              WHEN l_orderkey % 60 = 0 THEN 40
              ELSE CAST(round(l_discount * 100) AS INTEGER) END AS discount,
         CASE WHEN NOT (l_linenumber = 4 AND l_returnflag = 'R')
              THEN (CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT)
                    * CAST(l_quantity AS BIGINT)) // 1000 END AS likes_count,
         l_shipdate >= TIMESTAMP '2000-01-01' AS is_new,
         CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

FILLED = """
filled AS MATERIALIZED (
  SELECT row_id, id, category, subcategory, name,
         coalesce(current_price, (SELECT median(current_price) FROM products)) AS current_price,
         coalesce(raw_price, (SELECT median(raw_price) FROM products)) AS raw_price,
         currency, coalesce(discount, 0) AS discount, coalesce(likes_count, 0) AS likes_count, is_new,
         coalesce(brand, 'Unknown') AS brand
  FROM products
)"""


def _fence(step: int, source: str, column: str) -> str:
    return f"""
quart{step} AS (
  SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {source}
),
bound{step} AS (
  SELECT q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM quart{step}
),
fence{step} AS MATERIALIZED (
  SELECT lower_bound, upper_bound, count(*) FILTER (WHERE {column} < lower_bound OR {column} > upper_bound) AS outliers
  FROM {source}, bound{step} GROUP BY ALL
),
kept{step} AS MATERIALIZED (
  SELECT {source}.* FROM {source}, fence{step}
  WHERE outliers = 0 OR ({column} BETWEEN lower_bound AND upper_bound)
)"""


FENCES = ",".join(
    _fence(i, "filled" if i == 0 else f"kept{i - 1}", c) for i, c in enumerate(NUMERIC)
) + f",\ncleaned AS (SELECT * FROM kept{len(NUMERIC) - 1})"

SCORED = """
extent AS (
  SELECT min(current_price) AS p0, max(current_price) AS p1, min(discount) AS d0, max(discount) AS d1,
         min(likes_count) AS l0, max(likes_count) AS l1 FROM cleaned
),
components AS (
  SELECT cleaned.*, 1 - (current_price - p0) / nullif(p1 - p0, 0) AS price_score,
         (discount - d0)::DOUBLE / nullif(d1 - d0, 0) AS discount_score,
         (likes_count - l0)::DOUBLE / nullif(l1 - l0, 0) AS likes_score
  FROM cleaned, extent
),
scored AS MATERIALIZED (
  SELECT *, 0.50::DOUBLE * likes_score + 0.30::DOUBLE * discount_score + 0.20::DOUBLE * price_score AS composite_score
  FROM components
)"""

_Z = ", ".join(
    f"CASE WHEN stddev_pop({c}) OVER () = 0 THEN 0.0::DOUBLE ELSE "
    f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () END AS {c}"
    for c in NUMERIC
)
NORMALISED = f"""
zscored AS MATERIALIZED (
  SELECT row_id, {_Z}, is_new, category, subcategory, name, brand, currency FROM scored
),
normalised AS MATERIALIZED (
  SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in NUMERIC)}) FROM zscored
)"""

LABELS = """
cuts AS (
  SELECT quantile_cont(current_price, 0.25) AS c1, quantile_cont(current_price, 0.5) AS c2,
         quantile_cont(current_price, 0.75) AS c3 FROM cleaned
),
labels_kmeans AS (SELECT row_id, CAST(row_id % 4 AS INTEGER) AS kmeans_cluster FROM cleaned),
labels_hierarchical AS (
  SELECT row_id, CAST((current_price > c1)::INT + (current_price > c2)::INT + (current_price > c3)::INT AS INTEGER)
         AS hierarchical_cluster FROM cleaned, cuts
),
labels_dbscan AS (
  SELECT row_id, CAST(CASE WHEN likes_count > 4000 THEN -1 ELSE discount % 3 END AS INTEGER) AS cluster FROM cleaned
)"""


def split_ctes(source: str, prefix: str = "", label: str = "category") -> str:
    """Label codes, the test flag and the folds of a table with row_id and a label column."""
    p = prefix
    return f"""
{p}encoded AS MATERIALIZED (
  SELECT *, CAST(dense_rank() OVER (ORDER BY {label}) - 1 AS INTEGER) AS label FROM {source}
),
{p}sizes AS (SELECT label, count(*) AS n FROM {p}encoded GROUP BY label),
{p}wanted AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(ceil(0.2::DOUBLE * sum(n)) AS BIGINT) AS n_test FROM {p}sizes),
{p}shares AS (
  SELECT label, n_test * n // total AS base, row_number() OVER (ORDER BY n_test * n % total DESC, label) AS place, n_test
  FROM {p}sizes, {p}wanted
),
{p}quotas AS (
  SELECT label, base + CASE WHEN place <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {p}shares
),
{p}split AS MATERIALIZED (
  SELECT e.*, row_number() OVER (PARTITION BY e.label ORDER BY md5('42-' || row_id), row_id) <= quota AS is_test
  FROM {p}encoded e JOIN {p}quotas q ON e.label = q.label
),
{p}ranked AS (
  SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY row_id) - 1 AS place
  FROM {p}split WHERE NOT is_test
),
{p}class_runs AS (
  SELECT label, count(*) AS n, sum(count(*)) OVER (ORDER BY min(row_id)) - count(*) AS s
  FROM {p}split WHERE NOT is_test GROUP BY label
),
{p}fold_sizes AS (
  SELECT label, i, floor((s + n - 1 - i)::DOUBLE / 5) - floor((s - 1 - i)::DOUBLE / 5) AS quota
  FROM {p}class_runs, range(5) t(i)
),
{p}fold_ends AS (
  SELECT label, i, sum(quota) OVER (PARTITION BY label ORDER BY i) AS fold_end FROM {p}fold_sizes
),
{p}folds AS MATERIALIZED (
  SELECT row_id, CAST(count(*) FILTER (WHERE place >= fold_end) AS INTEGER) AS fold
  FROM {p}ranked r JOIN {p}fold_ends e ON r.label = e.label GROUP BY row_id
)"""


STUDY = (
    split_ctes("normalised")
    + """,
study AS MATERIALIZED (
  SELECT s.row_id, s.current_price, s.discount, s.likes_count, s.category, s.label, s.is_test, f.fold,
         k.kmeans_cluster, h.hierarchical_cluster, d.cluster
  FROM split s LEFT JOIN folds f ON s.row_id = f.row_id JOIN labels_kmeans k ON s.row_id = k.row_id
       JOIN labels_hierarchical h ON s.row_id = h.row_id JOIN labels_dbscan d ON s.row_id = d.row_id
)"""
)


def bayes_ctes(source: str, features: tuple[str, ...], name: str) -> str:
    """Naive Bayes predictions for the test rows of ``source``."""
    stats = ", ".join(f"avg({f}) AS m{i}, var_pop({f}) AS v{i}" for i, f in enumerate(features))
    widest = ", ".join(f"var_pop({f})" for f in features)
    density = " ".join(
        f"- 0.5 * ln(2 * pi() * (v{i} + eps)) - ({f} - m{i}) * ({f} - m{i}) / (2 * (v{i} + eps))"
        for i, f in enumerate(features)
    )
    return f"""
{name}_stats AS (SELECT label AS c, count(*) AS n, {stats} FROM {source} WHERE NOT is_test GROUP BY label),
{name}_eps AS (SELECT 1e-9 * greatest({widest}) AS eps FROM {source} WHERE NOT is_test),
{name}_density AS (
  SELECT row_id, label, c, ln(n / (SELECT sum(n) FROM {name}_stats)) {density} AS d
  FROM {source}, {name}_stats, {name}_eps WHERE is_test
),
{name} AS MATERIALIZED (
  SELECT row_id, label, c AS prediction FROM {name}_density
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d DESC, c) = 1
)"""


def bayes_cv_ctes(source: str, features: tuple[str, ...], name: str) -> str:
    """Naive Bayes predictions for the training rows of ``source``, each from the other folds."""
    stats = ", ".join(f"avg({f}) AS m{i}, var_pop({f}) AS v{i}" for i, f in enumerate(features))
    widest = ", ".join(f"var_pop({f})" for f in features)
    density = " ".join(
        f"- 0.5 * ln(2 * pi() * (v{i} + eps)) - ({f} - m{i}) * ({f} - m{i}) / (2 * (v{i} + eps))"
        for i, f in enumerate(features)
    )
    return f"""
{name}_stats AS (
  SELECT k, label AS c, count(*) AS n, {stats} FROM {source}, range(5) t(k)
  WHERE NOT is_test AND fold <> k GROUP BY k, label
),
{name}_eps AS (
  SELECT k, 1e-9 * greatest({widest}) AS eps FROM {source}, range(5) t(k) WHERE NOT is_test AND fold <> k GROUP BY k
),
{name}_totals AS (SELECT k, sum(n) AS total FROM {name}_stats GROUP BY k),
{name}_density AS (
  SELECT row_id, label, fold, c, ln(n / total) {density} AS d
  FROM {source} s JOIN {name}_stats t ON s.fold = t.k JOIN {name}_eps e ON s.fold = e.k
       JOIN {name}_totals u ON s.fold = u.k WHERE NOT is_test
),
{name} AS MATERIALIZED (
  SELECT row_id, label, fold, c AS prediction FROM {name}_density
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d DESC, c) = 1
)"""


def _neighbour_ctes(source: str, features: tuple[str, ...], name: str, asked: str, pairs: str, extra: str) -> str:
    distance = " + ".join(f"(q.{f} - p.{f}) * (q.{f} - p.{f})" for f in features)
    return f"""
{name}_near AS (
  SELECT q.row_id, any_value(q.label) AS label{extra},
         unnest(min_by(p.label, {{'distance': {distance}, 'row_id': p.row_id}}, 5)) AS vote
  FROM (SELECT * FROM {source} WHERE {asked}) q, (SELECT * FROM {source} WHERE NOT is_test) p
  WHERE {pairs} GROUP BY q.row_id
),
{name} AS MATERIALIZED (
  SELECT row_id, label, {"fold, " if extra else ""}vote AS prediction FROM {name}_near
  GROUP BY row_id, label, {"fold, " if extra else ""}vote
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY count(*) DESC, vote) = 1
)"""


def neighbour_ctes(source: str, features: tuple[str, ...], name: str) -> str:
    """Votes of the five nearest training rows for the test rows, by trying all pairs."""
    return _neighbour_ctes(source, features, name, "is_test", "true", "")


def neighbour_cv_ctes(source: str, features: tuple[str, ...], name: str) -> str:
    """The same for the training rows, each against the other folds."""
    return _neighbour_ctes(source, features, name, "NOT is_test", "q.fold <> p.fold", ", any_value(q.fold) AS fold")


ALL = (PRODUCTS, FILLED, FENCES, SCORED, NORMALISED, LABELS, STUDY)


def with_tables(select: str, *extra: str) -> str:
    """``select`` under the shared tables; those it does not name are not evaluated."""
    return "WITH " + ",".join((*ALL, *extra)) + "\n" + select
