"""DuckDB SQL equivalent to each query in :mod:`cairn.plans.queries`.

The tables are the driver's views (``region``, ``orders``, ...).  Two
conventions keep values comparable across engines:

* rounding goes through ``DECIMAL(28,8)`` (``_round``), mirroring
  :func:`cairn.functions.numeric.rounded`;
* p-values use methods independent of the library's incomplete-beta
  finisher: exact closed forms of the F tail for 2 and 4 numerator degrees
  of freedom, and a 2000-interval Simpson integral of the Student-t
  density (with ``lgamma``) for t tests.
"""

from __future__ import annotations


def _round(expr: str, scale: int = 2) -> str:
    x = f"CAST(({expr}) AS DOUBLE)"
    return (f"CASE WHEN isnan({x}) OR abs({x}) >= 9007199254740992.0 THEN {x} "
            f"ELSE CAST(ROUND(CAST(({expr}) AS DECIMAL(28,8)), {scale}) AS DOUBLE) END")


def _t_two_sided(t: str, df: str, src: str, group_cols: str = "") -> str:
    """SELECT producing ``p`` (two-sided t p-value) per ``group_cols`` of ``src``."""
    dens = (f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0) - 0.5 * ln({df} * pi()) "
            f"- ({df} + 1) / 2.0 * ln(1 + pow(abs({t}) * i / 2000.0, 2) / {df}))")
    weight = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    sel = f"{group_cols}, " if group_cols else ""
    grp = f"GROUP BY {group_cols}" if group_cols else ""
    return (f"SELECT {sel}greatest(1 - 2 * SUM({weight} * {dens}) * (abs(ANY_VALUE({t})) / 2000.0) / 3, 0) AS p "
            f"FROM {src}, range(0, 2001) AS g(i) {grp}")


def _anova(groups_cte: str, p_form: str, by: str = "") -> str:
    """One-way ANOVA over a CTE ``g(<by>, grp, n, m, v)``; ``p_form`` uses f, df2."""
    by_sel = f"{by}, " if by else ""
    by_grp = f"GROUP BY {by}" if by else ""
    join = f"JOIN tot USING ({by})" if by else ", tot"
    tot_grp = f"GROUP BY {by}" if by else ""
    return f"""
WITH g AS ({groups_cte}),
tot AS (SELECT {by_sel}SUM(n) AS big_n, COUNT(*) AS k, SUM(n * m) / SUM(n) AS grand FROM g {tot_grp}),
ss AS (SELECT {by_sel}ANY_VALUE(tot.k) AS k, ANY_VALUE(tot.big_n) AS big_n,
              SUM(g.n * (g.m - tot.grand) * (g.m - tot.grand)) AS ssb,
              SUM((g.n - 1) * COALESCE(g.v, 0)) AS ssw
       FROM g {join} {by_grp}),
f AS (SELECT {by_sel}k, CAST(big_n AS BIGINT) AS n, k - 1 AS df1, CAST(big_n - k AS BIGINT) AS df2,
             (ssb / (k - 1)) / (ssw / (big_n - k)) AS f FROM ss),
p AS (SELECT *, {p_form} AS p FROM f)
SELECT {by_sel}k, n, df1 AS df_between, df2 AS df_within, {_round('f', 6)} AS f, {_round('p', 6)} AS p_value,
       p < 0.05 AS reject_null
FROM p"""


# exact F upper tail for df1 = 2 and df1 = 4
_P_DF1_2 = "pow(df2 / (df2 + 2 * f), df2 / 2.0)"
_P_DF1_4 = "pow(df2 / (df2 + 4 * f), df2 / 2.0) * (1 + df2 / 2.0 * (1 - df2 / (df2 + 4 * f)))"

_EVENT_COUNTS = """
SELECT user_id,{day}
       COUNT(*) FILTER (WHERE event_type = 'click') AS clicks,
       COUNT(*) FILTER (WHERE event_type = 'view') AS views,
       COUNT(*) FILTER (WHERE event_type = 'error') AS errors
FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY ALL"""

_PAIRS = [("l_quantity", "l_quantity"), ("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"),
          ("l_extendedprice", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
          ("l_extendedprice", "l_discount"), ("l_discount", "l_quantity"), ("l_discount", "l_extendedprice"),
          ("l_discount", "l_discount")]

_PEARSON_MATRIX = "\nUNION ALL\n".join(
    f"SELECT '{x}' AS x, '{y}' AS y, COUNT(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS n, "
    f"{_round(f'corr({x}, {y})', 6)} AS r FROM lineitem" for x, y in _PAIRS)

_BASE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_WIDE = {c: f"CAST({c} AS DOUBLE)" for c in _BASE}
_WIDE |= {f"{a}_x_{b}": f"CAST({a} AS DOUBLE) * {b}" for i, a in enumerate(_BASE) for b in _BASE[i:]}
_WIDE |= {f"{a}_by_{b}": f"CAST({a} AS DOUBLE) / ({b} + 1)" for a in _BASE[:2] for b in _BASE}
_WIDE_PEARSON = ("WITH w AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _WIDE.items()) + " FROM lineitem)\n"
                 + "\nUNION ALL\n".join(f"SELECT '{x}' AS x, '{y}' AS y, COUNT(*) AS n, {_round(f'corr({x}, {y})', 6)} AS r FROM w"
                                       for x in _WIDE for y in _WIDE))

_PEARSON_TEST = f"""
WITH s AS (SELECT l_returnflag, COUNT(*) FILTER (WHERE l_discount IS NOT NULL AND l_quantity IS NOT NULL) AS n,
                  corr(l_discount, l_quantity) AS r
           FROM lineitem GROUP BY l_returnflag),
t AS (SELECT l_returnflag, n, r, n - 2 AS df, r * sqrt((n - 2) / (1 - r * r)) AS t FROM s),
p AS ({_t_two_sided('t', 'df', 't', 'l_returnflag')})
SELECT t.l_returnflag, 'l_discount' AS x, 'l_quantity' AS y, t.n, {_round('t.r', 6)} AS r, {_round('t.t', 6)} AS t,
       t.df, {_round('p.p', 6)} AS p_value, p.p < 0.05 AS reject_null
FROM t JOIN p USING (l_returnflag)"""


def _welch(source: str, value: str, group: str, a: str, b: str) -> str:
    return f"""
WITH s AS (SELECT COUNT({value}) FILTER (WHERE {group} = '{a}') AS n_a,
                  AVG({value}) FILTER (WHERE {group} = '{a}') AS mean_a,
                  VAR_SAMP({value}) FILTER (WHERE {group} = '{a}') AS var_a,
                  COUNT({value}) FILTER (WHERE {group} = '{b}') AS n_b,
                  AVG({value}) FILTER (WHERE {group} = '{b}') AS mean_b,
                  VAR_SAMP({value}) FILTER (WHERE {group} = '{b}') AS var_b
           FROM ({source}) src WHERE {group} IN ('{a}', '{b}')),
w AS (SELECT *, var_a / n_a AS sa, var_b / n_b AS sb FROM s),
t AS (SELECT *, (mean_a - mean_b) / sqrt(sa + sb) AS t,
             (sa + sb) * (sa + sb) / (sa * sa / (n_a - 1) + sb * sb / (n_b - 1)) AS df FROM w),
p AS ({_t_two_sided('t', 'df', 't')})
SELECT '{a}' AS group_a, '{b}' AS group_b, n_a, n_b, {_round('mean_a', 6)} AS mean_a,
       {_round('mean_b', 6)} AS mean_b, {_round('t', 6)} AS t, {_round('df', 6)} AS df,
       {_round('p', 6)} AS p_value, p < 0.05 AS reject_null
FROM t, p"""


_WELCH = _welch("SELECT * FROM events", "value", "event_type", "view", "purchase")

_WELCH_BY_SEGMENT = f"""
WITH src AS (SELECT c.c_mktsegment, o.o_orderpriority, o.o_totalprice
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (SELECT c_mktsegment,
             COUNT(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_a,
             AVG(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS mean_a,
             VAR_SAMP(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT') AS var_a,
             COUNT(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS n_b,
             AVG(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS mean_b,
             VAR_SAMP(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW') AS var_b
      FROM src WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY c_mktsegment),
w AS (SELECT *, var_a / n_a AS sa, var_b / n_b AS sb FROM s),
t AS (SELECT *, (mean_a - mean_b) / sqrt(sa + sb) AS t,
             (sa + sb) * (sa + sb) / (sa * sa / (n_a - 1) + sb * sb / (n_b - 1)) AS df FROM w),
p AS ({_t_two_sided('t', 'df', 't', 'c_mktsegment')})
SELECT t.c_mktsegment, '1-URGENT' AS group_a, '5-LOW' AS group_b, n_a, n_b, {_round('mean_a', 6)} AS mean_a,
       {_round('mean_b', 6)} AS mean_b, {_round('t', 6)} AS t, {_round('df', 6)} AS df,
       {_round('p.p', 6)} AS p_value, p.p < 0.05 AS reject_null
FROM t JOIN p USING (c_mktsegment)"""

_LEVENE_GROUPS = """
SELECT e.event_type AS grp, COUNT(abs(e.value - m.gm)) AS n, AVG(abs(e.value - m.gm)) AS m,
       VAR_SAMP(abs(e.value - m.gm)) AS v
FROM events e JOIN (SELECT event_type, AVG(value) AS gm FROM events
                    WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY event_type) m
     ON e.event_type = m.event_type
WHERE e.value IS NOT NULL GROUP BY e.event_type"""

_ASSUMPTIONS = f"""
WITH lev AS ({_anova(_LEVENE_GROUPS, _P_DF1_4)}),
mu AS (SELECT event_type, AVG(value) AS mu FROM events
       WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY event_type),
mom AS (SELECT e.event_type, COUNT(e.value) AS n,
               AVG(pow(e.value - mu.mu, 2)) AS m2, AVG(pow(e.value - mu.mu, 3)) AS m3,
               AVG(pow(e.value - mu.mu, 4)) AS m4
        FROM events e JOIN mu ON e.event_type = mu.event_type WHERE e.value IS NOT NULL GROUP BY e.event_type),
jb AS (SELECT event_type, n, n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4.0) AS jb FROM mom)
SELECT 'levene' AS test, CAST(NULL AS VARCHAR) AS "group", n, f AS statistic, p_value, reject_null FROM lev
UNION ALL
SELECT 'jarque_bera' AS test, event_type AS "group", n, {_round('jb', 6)} AS statistic,
       {_round('exp(-jb / 2)', 6)} AS p_value, exp(-jb / 2) < 0.05 AS reject_null FROM jb"""


_ARRIVALS = """
a AS (SELECT *, date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) // 4 + CASE WHEN event_id % 25 = 0 THEN 2 ELSE 0 END AS batch
      FROM events),
m AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 DAY AS mark
      FROM a GROUP BY batch)"""


def _event_windows(hours: int, slide: int) -> str:
    """A row counts in the windows that end after the watermark with which the batch before its own ran, which the batches
    before that one have settled."""
    return f"""
WITH {_ARRIVALS},
w AS (SELECT a.*, mark, time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '2024-01-01') - k * INTERVAL {slide} HOUR AS window_start
      FROM a JOIN m USING (batch), range({hours // slide}) t(k))
SELECT window_start, event_type, count(*) AS count, {_round('SUM(value)', 2)} AS total
FROM w WHERE mark IS NULL OR window_start + INTERVAL {hours} HOUR > mark GROUP BY window_start, event_type"""


_PAIRS = """
WITH c AS (SELECT CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END AS nation, c_custkey % 3 AS k FROM customer),
s AS (SELECT CASE WHEN s_nationkey % 5 <> 0 THEN s_nationkey END AS nation, s_suppkey % 4 AS k FROM supplier)"""


def _levels(source: str, keys: list[str], kind: str) -> str:
    return f"""
SELECT {", ".join(keys)}, CAST(GROUPING_ID({", ".join(keys)}) AS INTEGER) AS level, COUNT(*) AS n, COUNT(l_quantity) AS n_values,
       {_round('SUM(l_quantity)', 2)} AS total, {_round('AVG(l_quantity)', 6)} AS mean, MIN(l_quantity) AS least, MAX(l_quantity) AS greatest
FROM {source} GROUP BY {kind} ({", ".join(keys)})"""


ORACLE: dict[str, str] = {
    "csv_typed_roundtrip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "csv_permissive_nulls": """
SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL ELSE p_size END AS p_size, p_retailprice, p_size < 5 AS bad_row
FROM part""",
    "csv_narrow_schema": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "csv_string_schema": """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
    "split_write_counts": f"""
SELECT event_type, COUNT(*) AS n_rows, {_round('SUM(value)', 2)} AS total_value FROM events GROUP BY event_type""",
    "select_filter_eq": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "filter_or_and": """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_totalprice > 100000)""",
    "filter_in_list": """
SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('view', 'click', 'error')""",
    "filter_between_ne": """
SELECT p_partkey, p_size, p_type FROM part WHERE p_size BETWEEN 10 AND 20 AND p_type <> 'ECONOMY'""",
    "filter_contains_distinct": "SELECT DISTINCT p_name FROM part WHERE contains(p_name, 'ring') ORDER BY p_name",
    "filter_non_empty": """
SELECT doc_id, lang FROM documents WHERE length(CASE WHEN lang = 'en' THEN '' ELSE text END) > 0""",
    "literal_rename_drop": """
SELECT r_name AS region_name, 'region' AS tag, CAST(length(r_name) AS INTEGER) AS name_len FROM region""",
    "fill_numeric_sentinel": """
SELECT p_partkey,
       COALESCE(CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END, -1) AS p_size,
       COALESCE(CASE WHEN p_size > 45 THEN NULL ELSE p_retailprice END, CAST(0 AS DOUBLE)) AS p_retailprice
FROM part""",
    "fill_string_default": """
SELECT c_custkey, COALESCE(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, 'UNKNOWN')
       AS c_mktsegment
FROM customer""",
    "replace_token": """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS seg_whole,
       CASE WHEN c_mktsegment = 'HOLD' THEN 'HOME' ELSE c_mktsegment END AS seg_token_whole,
       replace(c_mktsegment, 'HOLD', 'HOME') AS seg_sub
FROM customer""",
    "dedupe_first": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                            l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem)
WHERE rn = 1""",
    "full_outer_merge": """
WITH p AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS purchases FROM events
           WHERE event_type = 'purchase' GROUP BY ALL),
     s AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS signups FROM events
           WHERE event_type = 'signup' GROUP BY ALL)
SELECT COALESCE(p.user_id, s.user_id) AS user_id, COALESCE(p.day, s.day) AS day,
       COALESCE(p.purchases, 0) AS purchases, COALESCE(s.signups, 0) AS signups
FROM p FULL OUTER JOIN s ON p.user_id = s.user_id AND p.day = s.day""",
    "three_way_outer_merge": """
WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL),
     v AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL),
     e AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS errors FROM events WHERE event_type = 'error' GROUP BY ALL)
SELECT COALESCE(c.user_id, v.user_id, e.user_id) AS user_id, COALESCE(c.day, v.day, e.day) AS day,
       COALESCE(c.clicks, 0) AS clicks, COALESCE(v.views, 0) AS views, COALESCE(e.errors, 0) AS errors
FROM c FULL OUTER JOIN v ON c.user_id = v.user_id AND c.day = v.day
       FULL OUTER JOIN e ON COALESCE(c.user_id, v.user_id) = e.user_id AND COALESCE(c.day, v.day) = e.day""",
    "category_counts": _EVENT_COUNTS.format(day=" CAST(ts AS DATE) AS day,"),
    "lookup_enrich": """
WITH d AS (SELECT o_custkey, MIN(o_orderpriority) AS first FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
SELECT c.c_custkey, c.c_nationkey, COALESCE(d.first, 'NONE') AS pending_priority
FROM customer c LEFT JOIN d ON c.c_custkey = d.o_custkey""",
    "group_counts": """
SELECT o_orderstatus, COUNT(*) AS n_orders,
       COUNT(CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END) AS n_priced
FROM orders GROUP BY o_orderstatus""",
    "group_sums": f"""
SELECT l_returnflag, {_round('SUM(l_quantity)', 2)} AS sum_qty, {_round('SUM(l_extendedprice)', 2)} AS sum_price
FROM lineitem GROUP BY l_returnflag""",
    "group_mean_rounded": f"""
SELECT o_custkey, COUNT(*) AS n_orders, {_round('AVG(o_totalprice)', 2)} AS avg_price FROM orders GROUP BY o_custkey""",
    "frequency_topk": """
SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey ORDER BY n_orders DESC, o_custkey LIMIT 5""",
    "composite_frequency_topk": """
SELECT user_id, event_type, COUNT(*) AS n, concat_ws('_', CAST(user_id AS VARCHAR), event_type) AS label
FROM events GROUP BY user_id, event_type ORDER BY n DESC, user_id, event_type LIMIT 5""",
    "distinct_then_count_topk": """
SELECT l_suppkey, COUNT(*) AS n
FROM (SELECT DISTINCT l_suppkey, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag <> 'N')
GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 5""",
    "two_key_group_stats": f"""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, {_round('AVG(l_extendedprice)', 2)} AS avg_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "dense_rank_within": """
WITH c AS (SELECT c.c_custkey, c.c_mktsegment, COUNT(*) AS n_orders
           FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_mktsegment)
SELECT c_custkey, c_mktsegment, n_orders,
       CAST(dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY n_orders DESC) AS BIGINT) AS rank
FROM c""",
    "topk_multi_measure": _EVENT_COUNTS.format(day="")
    + "\nORDER BY clicks DESC, views DESC, errors DESC, user_id LIMIT 5",
    "bottomk": "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 5",
    "append_rows": """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation_key, 'supplier' AS kind FROM supplier""",
    "row_total": """
SELECT o_custkey,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
       COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
       COUNT(*) AS total
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_custkey""",
    "rounded_difference": f"""
SELECT l_orderkey, l_linenumber, {_round('l_extendedprice - l_quantity', 2)} AS diff FROM lineitem""",
    "band_counts": f"""
SELECT CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small'
            WHEN p_size BETWEEN 11 AND 25 THEN 'medium'
            WHEN p_size BETWEEN 31 AND 50 THEN 'large' END AS size_band,
       COUNT(*) AS n, {_round('AVG(p_retailprice)', 2)} AS avg_price
FROM part GROUP BY 1""",
    "pearson_matrix": _PEARSON_MATRIX,
    "pearson_test": _PEARSON_TEST,
    "group_means": f"""
SELECT event_type, COUNT(value) AS n, {_round('AVG(value)', 6)} AS mean_value FROM events GROUP BY event_type""",
    "welch_t": _WELCH,
    "welch_by_segment": _WELCH_BY_SEGMENT,
    "anova_long": _anova("""
SELECT o_orderpriority AS grp, COUNT(o_totalprice) AS n, AVG(o_totalprice) AS m, VAR_SAMP(o_totalprice) AS v
FROM orders WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY o_orderpriority""", _P_DF1_4),
    "anova_subset": _anova("""
SELECT event_type AS grp, COUNT(value) AS n, AVG(value) AS m, VAR_SAMP(value) AS v
FROM events WHERE event_type IN ('view', 'click', 'error') AND value IS NOT NULL GROUP BY event_type""", _P_DF1_2),
    "anova_columns": _anova(f"""
WITH u AS ({_EVENT_COUNTS.format(day='')}),
     l AS (SELECT 'clicks' AS grp, CAST(clicks AS DOUBLE) AS x FROM u
           UNION ALL SELECT 'views', CAST(views AS DOUBLE) FROM u
           UNION ALL SELECT 'errors', CAST(errors AS DOUBLE) FROM u)
SELECT grp, COUNT(x) AS n, AVG(x) AS m, VAR_SAMP(x) AS v FROM l GROUP BY grp""", _P_DF1_2),
    "anova_by_segment": _anova("""
SELECT c.c_mktsegment, o.o_orderpriority AS grp, COUNT(o.o_totalprice) AS n, AVG(o.o_totalprice) AS m,
       VAR_SAMP(o.o_totalprice) AS v
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderpriority IS NOT NULL AND o.o_totalprice IS NOT NULL
GROUP BY c.c_mktsegment, o.o_orderpriority""", _P_DF1_4, by="c_mktsegment"),
    "assumption_checks": _ASSUMPTIONS,
    "stream_running_totals": f"""
SELECT event_type, COUNT(*) AS count, COUNT(value) AS count_values, {_round('SUM(value)', 2)} AS total,
       {_round('SUM(value) / COUNT(*)', 2)} AS avg_value, {_round('SUM(value) / COUNT(value)', 2)} AS avg_present
FROM events GROUP BY event_type""",
    "participation_topk": """
SELECT l_suppkey, COUNT(*) AS n_orders FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)
GROUP BY l_suppkey ORDER BY n_orders DESC, l_suppkey LIMIT 5""",
    "staged_band_means": f"""
SELECT CASE WHEN l_quantity BETWEEN 1 AND 10 THEN '1-10 units'
            WHEN l_quantity BETWEEN 11 AND 30 THEN '11-30 units'
            WHEN l_quantity BETWEEN 31 AND 50 THEN '31-50 units' END AS qty_band,
       COUNT(*) AS n, {_round('AVG(l_extendedprice)', 2)} AS avg_price
FROM lineitem WHERE l_discount > 0 GROUP BY 1""",
    "two_class_comparison": _welch(
        "SELECT * FROM lineitem WHERE l_returnflag = 'R' OR (l_returnflag = 'N' AND l_discount <> 0)",
        "l_extendedprice", "l_returnflag", "R", "N"),
    "append_with_lookup": """
WITH d AS (SELECT n_nationkey, MIN(n_name) AS n_name FROM nation GROUP BY n_nationkey),
acc AS (SELECT c_custkey AS party_key, c_nationkey AS nation_key, c_acctbal AS acctbal, 'customer' AS kind
        FROM customer
        UNION ALL
        SELECT s_suppkey, s_nationkey, s_acctbal, 'supplier' FROM supplier),
named AS (SELECT acc.*, COALESCE(d.n_name, 'UNKNOWN') AS nation_name
          FROM acc LEFT JOIN d ON acc.nation_key = d.n_nationkey),
ranked AS (SELECT *, row_number() OVER (PARTITION BY nation_name, kind ORDER BY acctbal DESC, party_key) AS rn
           FROM named)
SELECT nation_name, kind, party_key, acctbal FROM ranked WHERE rn = 1""",
    "category_table_ranked": """
WITH t AS (SELECT o_custkey,
                  COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
                  COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
                  COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
                  COUNT(*) AS total
           FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY o_custkey)
SELECT t.o_custkey, t.n_f, t.n_o, t.n_p, t.total, c.c_mktsegment,
       CAST(dense_rank() OVER (PARTITION BY c.c_mktsegment ORDER BY t.total DESC) AS BIGINT) AS rank
FROM t JOIN customer c ON c.c_custkey = t.o_custkey""",
    "documents_csv_stage": """
SELECT doc_id, text, '  ' || lang || ' ' AS padded,
       CASE WHEN lang = 'en' THEN '' WHEN lang = 'de' THEN source END AS gappy FROM documents""",
    "staged_difference": f"""
WITH d AS (SELECT {_round('l_extendedprice - l_quantity', 2)} AS diff FROM lineitem)
SELECT diff >= 30000 AS large, COUNT(*) AS n, {_round('AVG(diff)', 2)} AS avg_diff FROM d GROUP BY ALL""",
    "distinct_category_table": """
SELECT l_suppkey, COUNT(*) FILTER (WHERE l_returnflag = 'A') AS n_a, COUNT(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
       COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_r, COUNT(*) AS total
FROM (SELECT DISTINCT l_suppkey, l_partkey, l_returnflag, l_linestatus FROM lineitem
      WHERE l_returnflag IN ('A', 'N', 'R')) GROUP BY l_suppkey""",
    "distinct_composite_topk": """
SELECT l_suppkey, l_returnflag, COUNT(*) AS n_orders, concat_ws('_', CAST(l_suppkey AS VARCHAR), l_returnflag) AS label
FROM (SELECT DISTINCT l_suppkey, l_returnflag, l_orderkey FROM lineitem)
GROUP BY l_suppkey, l_returnflag ORDER BY n_orders DESC, l_suppkey, l_returnflag LIMIT 5""",
    "perfect_correlation": """
SELECT o_orderstatus, COUNT(o_totalprice) AS n, CAST(1 AS DOUBLE) AS r, CAST(0 AS DOUBLE) AS p_value, TRUE AS reject_null
FROM orders GROUP BY o_orderstatus""",
    "wide_pearson": _WIDE_PEARSON,
    "stream_sorted_memory": f"""
SELECT event_type, COUNT(*) AS count, {_round('SUM(value) / COUNT(*)', 2)} AS avg_value FROM events GROUP BY event_type""",
    "asof_last_order": """
SELECT event_id, user_id, o_orderkey, o_totalprice
FROM events LEFT JOIN orders ON o_custkey = user_id AND o_orderdate <= ts
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1""",
    "asof_last_click": """
SELECT p.event_id, p.user_id, c.event_id AS click_event_id, c.value AS click_value
FROM events p LEFT JOIN events c ON c.event_type = 'click' AND c.user_id = p.user_id AND c.ts < p.ts
                                    AND c.ts >= p.ts - INTERVAL 2 DAY
WHERE p.event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY c.ts DESC NULLS LAST, c.event_id DESC) = 1""",
    "interval_errors": """
SELECT p.event_id, e.event_id AS error_id FROM events p JOIN events e
  ON e.event_type = 'error' AND p.ts BETWEEN e.ts AND e.ts + to_seconds(CAST(trunc(e.value * 60) AS BIGINT))
WHERE p.event_type = 'purchase'""",
    "interval_open_orders": f"""
SELECT s.l_orderkey AS order_key, count(*) AS n_lines, {_round('SUM(p.l_quantity)', 2)} AS quantity
FROM lineitem s JOIN lineitem p ON p.l_suppkey = s.l_suppkey AND p.l_shipdate BETWEEN s.l_shipdate AND s.l_shipdate + INTERVAL 30 DAY
WHERE s.l_linenumber = 1 GROUP BY s.l_orderkey""",
    "moving_event_stats": f"""
SELECT event_id, lag(value) OVER w AS previous, lead(event_id) OVER w AS next_id,
       {_round('SUM(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)', 4)} AS moving_sum,
       max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS around
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
    "stream_tumbling_totals": _event_windows(6, 6),
    "stream_sliding_totals": _event_windows(24, 8),
    "stream_user_sessions": f"""
WITH g AS (SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL 5 HOUR, TRUE) AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, count(*) FILTER (WHERE opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, {_round('SUM(value)', 2)} AS total
FROM s GROUP BY user_id, number""",
    "cube_line_totals": _levels(
        "(SELECT CASE WHEN l_linenumber < 7 THEN l_linenumber END AS l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem)",
        ["l_returnflag", "l_linestatus", "l_linenumber"], "CUBE"),
    "rollup_line_totals": _levels("lineitem", ["l_suppkey", "l_returnflag"], "ROLLUP"),
    "merged_distinct_users": """
SELECT event_type, COUNT(DISTINCT user_id) AS n_users, COUNT(user_id) AS n_events, TRUE AS within_bound FROM events GROUP BY event_type""",
    "set_counts": _PAIRS + """
SELECT nation, k, CAST(SUM(l) AS BIGINT) AS in_left, CAST(SUM(r) AS BIGINT) AS in_right
FROM (SELECT nation, k, 1 AS l, 0 AS r FROM c UNION ALL SELECT nation, k, 0, 1 FROM s) GROUP BY nation, k""",
    "intersect_all_rows": _PAIRS + " SELECT nation, k FROM c INTERSECT ALL SELECT nation, k FROM s",
    "except_all_rows": _PAIRS + " SELECT nation, k FROM c EXCEPT ALL SELECT nation, k FROM s",
    "intersect_rows": _PAIRS + " SELECT nation, k FROM c INTERSECT SELECT nation, k FROM s",
    "except_rows": _PAIRS + " SELECT nation, k FROM s EXCEPT SELECT nation, k FROM c",
    "stream_click_purchases": """
SELECT c.event_id AS c_id, p.event_id AS p_id, c.user_id FROM events c JOIN events p
  ON p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 12 HOUR
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
    "stream_first_events": """
SELECT event_type, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type""",
    "json_props": """
WITH e AS (SELECT event_type, event_id % 40 = 0 OR event_id % 41 = 0 AS bad, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, COUNT(*) AS n, COUNT(k) FILTER (WHERE NOT bad) AS n_k, CAST(SUM(k) FILTER (WHERE NOT bad) AS BIGINT) AS sum_k,
       COUNT(*) FILTER (WHERE bad) AS n_bad FROM e GROUP BY event_type""",
    "json_keys": """
SELECT key, COUNT(*) AS n, COUNT(DISTINCT value) AS n_values
FROM (SELECT k AS key, json_extract_string(props, k) AS value FROM events, LATERAL (SELECT unnest(json_keys(props)) AS k)) GROUP BY key""",
    "persisted_reuse": f"""
SELECT l_returnflag, COUNT(*) AS n, {_round('SUM(l_quantity)', 2)} AS quantity, COUNT(DISTINCT l_linestatus) AS n_status
FROM lineitem WHERE l_discount > 0 GROUP BY l_returnflag""",
    "pearson_no_missing": " UNION ALL ".join(
        f"SELECT l_returnflag, '{x}' AS x, '{y}' AS y, COUNT(*) AS n, {_round(f'CORR({x}, {y})' if x != y else '1.0', 6)} AS r "
        "FROM lineitem GROUP BY l_returnflag"
        for x in ("l_quantity", "l_extendedprice", "l_discount") for y in ("l_quantity", "l_extendedprice", "l_discount")),
}
ORACLE["ranked_table_staged"] = ORACLE["category_table_ranked"]
