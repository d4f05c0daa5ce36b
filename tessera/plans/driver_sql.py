"""DuckDB SQL equivalents of :mod:`tessera.plans.driver` (the correctness oracle).

Plain SQL over the driver's views. p-values are integrated by SQL text that
:mod:`tessera.functions.pvalues` writes beside its Spark expressions; everything
else is written apart from the Spark code. Counts and sums are cast to BIGINT, measures to DOUBLE and rounded
the same way on both sides.
"""

from __future__ import annotations

from ..functions.pvalues import chi2_upper_p_sql, student_t_two_sided_p_sql
from ..functions.text import WHITESPACE
from .driver import FIRST_YEAR, TABLES


def cnt(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


def pct(num: str, den: str, d: int = 2) -> str:
    return f"ROUND(100.0 * CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0), {d})"


def rate(num: str, d: int | None) -> str:
    e = f"CAST({num} AS DOUBLE) * 100.0 / COUNT(*)"
    return f"ROUND({e}, {d})" if d is not None else e


def avg_cost(col: str = "cost", d: int = 2) -> str:
    return f"CAST(ROUND(AVG({col}), {d}) AS DOUBLE)"


def strip(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


ORDER_STAR = """
    SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate,
           CAST(o.o_totalprice AS DECIMAL(12,2)) AS cost, c.c_mktsegment, n.n_name, r.r_name
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
"""

LINE_STAR = """
    SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment, n.n_name,
           CAST(l.l_extendedprice AS DECIMAL(12,2)) AS cost,
           CAST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS duration_days
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

NULLABLE_ORDERS = """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
           o_custkey, o_orderdate
    FROM orders
"""

PART_ROLES = """
    SELECT p_partkey,
           CASE WHEN p_size > 45 THEN NULL ELSE p_brand END AS destination,
           CASE WHEN p_size < 5 THEN NULL ELSE p_type END AS category
    FROM part
"""

DECADE = "CAST(CAST(floor(year({d}) / 10) * 10 AS INTEGER) AS VARCHAR) || 's'"

DIM_DATE = f"""
    SELECT row_number() OVER (ORDER BY full_date) AS date_id, full_date,
           CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
           CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
           CAST(weekofyear(full_date) AS INTEGER) AS week, CAST(day(full_date) AS INTEGER) AS day,
           {DECADE.format(d='full_date')} AS decade
    FROM (SELECT DISTINCT CAST(x AS DATE) AS full_date
          FROM (SELECT o_orderdate AS x FROM orders UNION ALL SELECT l_shipdate FROM lineitem)
          WHERE x IS NOT NULL)
"""

DIM_NATION = """
    SELECT row_number() OVER (ORDER BY n_name NULLS FIRST, r_name NULLS FIRST) AS nation_id, n_name, r_name
    FROM (SELECT DISTINCT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
    WHERE n_name IS NOT NULL
"""

DIM_PAIR = f"""
    SELECT row_number() OVER (ORDER BY destination NULLS FIRST, category NULLS FIRST) AS pair_id,
           destination, category
    FROM (SELECT DISTINCT destination, category FROM ({PART_ROLES}))
"""

FACT = f"""
    WITH pr AS ({PART_ROLES}), dn AS ({DIM_NATION}), dp AS ({DIM_PAIR}), dd AS ({DIM_DATE}),
    b AS (
        SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_shipdate,
               CAST(l.l_extendedprice AS DECIMAL(12,2)) AS cost, o.o_orderdate, n.n_name, pr.destination, pr.category
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN pr ON l.l_partkey = pr.p_partkey
    )
    SELECT b.l_orderkey, b.l_linenumber, dn.nation_id, dp.pair_id, d1.date_id AS order_date_id,
           d2.date_id AS ship_date_id, b.l_returnflag, CAST(b.cost AS DOUBLE) AS cost
    FROM b
    LEFT JOIN dn ON b.n_name = dn.n_name
    LEFT JOIN dp ON b.destination IS NOT DISTINCT FROM dp.destination AND b.category IS NOT DISTINCT FROM dp.category
    LEFT JOIN dd d1 ON CAST(b.o_orderdate AS DATE) = d1.full_date
    LEFT JOIN dd d2 ON CAST(b.l_shipdate AS DATE) = d2.full_date
"""


def _star(meta: bool) -> str:
    extra_cols = ", m.o_orderpriority, m.o_orderstatus" if meta else ""
    extra_join = "LEFT JOIN orders m ON f.l_orderkey = m.o_orderkey" if meta else ""
    return f"""
    WITH f AS ({FACT}), dn AS ({DIM_NATION}), dp AS ({DIM_PAIR}), dd AS ({DIM_DATE})
    SELECT f.l_orderkey, f.l_linenumber, f.l_returnflag, f.cost, dn.n_name, dn.r_name, dp.destination, dp.category,
           d1.full_date AS order_date, d1.year AS order_year, d1.quarter AS order_quarter, d1.month AS order_month,
           d1.decade AS order_decade,
           d2.full_date AS ship_date, d2.year AS ship_year, d2.quarter AS ship_quarter, d2.month AS ship_month,
           d2.decade AS ship_decade{extra_cols}
    FROM f
    LEFT JOIN dn ON f.nation_id = dn.nation_id
    LEFT JOIN dp ON f.pair_id = dp.pair_id
    LEFT JOIN dd d1 ON f.order_date_id = d1.date_id
    LEFT JOIN dd d2 ON f.ship_date_id = d2.date_id
    {extra_join}
    ORDER BY order_date NULLS LAST
"""


def _raw_priority(k: str, v: str) -> str:
    return (f"CASE {k} % 7 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'Unknown' WHEN 2 THEN '  ' || {v} || ' ' "
            f"WHEN 3 THEN 'null' WHEN 4 THEN 'NaN' WHEN 5 THEN '<NA>' ELSE {v} END")


SENTINELS = ("n/a", "na", "none", "unknown", "not applicable", "", "nan")
READER = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
          "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _lst(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def clean(c: str) -> str:
    return (f"CASE WHEN {c} IN ({_lst(READER)}) OR lower({strip(c)}) IN ({_lst(SENTINELS)}) THEN NULL "
            f"ELSE {strip(c)} END")


RAW_DURATION = """
    CASE (l_linenumber + l_orderkey) % 8
        WHEN 0 THEN q || ' days' WHEN 1 THEN q || ' Months' WHEN 2 THEN '~' || q || ' years'
        WHEN 3 THEN q || ' hours' WHEN 4 THEN '1 year ' || q || ' months' WHEN 5 THEN q
        WHEN 6 THEN q || ' weeks' ELSE '1,' || q || '.5 days' END
"""

DURATIONS = f"""
    WITH r AS (
        SELECT l_orderkey, l_linenumber, {RAW_DURATION} AS raw_duration
        FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem)
    ),
    v AS (SELECT *, {strip("translate(lower(raw_duration), '~,', '')")} AS v FROM r),
    e AS (
        SELECT *, regexp_extract(v, '([\\d.]+)\\s*year', 1) AS ty, regexp_extract(v, '([\\d.]+)\\s*month', 1) AS tm,
               regexp_extract(v, '([\\d.]+)\\s*day', 1) AS td, regexp_extract(v, '([\\d.]+)\\s*hour', 1) AS th
        FROM v
    ),
    n AS (
        SELECT *, TRY_CAST(NULLIF(ty, '') AS DOUBLE) AS ny, TRY_CAST(NULLIF(tm, '') AS DOUBLE) AS nm,
               TRY_CAST(NULLIF(td, '') AS DOUBLE) AS nd, TRY_CAST(NULLIF(th, '') AS DOUBLE) AS nh
        FROM e
    ),
    s AS (
        SELECT *, COALESCE(ny * 365.25, 0.0) + COALESCE(nm * 30.44, 0.0) + COALESCE(nd * 1.0, 0.0)
                  + COALESCE(nh * (1.0 / 24), 0.0) AS total
        FROM n
    )
    SELECT l_orderkey, l_linenumber, raw_duration,
        CASE WHEN v IS NULL THEN NULL
             WHEN ty = '' AND tm = '' AND td = '' AND th = ''
                 THEN CASE WHEN regexp_full_match(v, '[\\d.]+') THEN TRY_CAST(v AS DOUBLE) END
             WHEN (ty <> '' AND ny IS NULL) OR (tm <> '' AND nm IS NULL) OR (td <> '' AND nd IS NULL)
                  OR (th <> '' AND nh IS NULL) THEN NULL
             WHEN total > 0 THEN ROUND(total, 2)
        END AS duration_days
    FROM s
"""

RAW_NUMBER = """
    CASE o_orderkey % 6 WHEN 0 THEN 'bad' WHEN 1 THEN ' ' || ps || ' ' WHEN 2 THEN ps || 'd'
        WHEN 3 THEN '1,' || ps ELSE ps END
"""

NUMBER_RE = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"

FIRST_YEAR_VALUES = ", ".join(f"('{k}', {v})" for k, v in FIRST_YEAR.items())

CNO = """
    SELECT o.o_orderkey, n.n_name, o.o_orderdate
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

PROFILE = f"""
    SELECT n_name, CAST(COUNT(*) AS BIGINT) AS total_missions,
           {cnt("o_orderstatus = 'F'")} AS finished_orders, {cnt("o_orderstatus = 'O'")} AS open_orders,
           {cnt("o_orderstatus = 'P'")} AS pending_orders,
           {avg_cost()} AS avg_cost_billion, CAST(COALESCE(SUM(cost), 0) AS DOUBLE) AS total_cost_billion,
           CAST(ROUND(AVG(duration_days), 2) AS DOUBLE) AS avg_duration_days,
           {{flag}}
           {cnt("o_orderstatus = 'F'")} AS succ
    FROM s WHERE n_name IS NOT NULL GROUP BY n_name HAVING COUNT(*) > 5
"""


def _profile_sql(base: str, flag: str) -> str:
    return f"""
    WITH s AS ({base}),
    agg AS ({PROFILE.format(flag=flag)}),
    m AS (
        SELECT n_name, c_mktsegment FROM (
            SELECT n_name, c_mktsegment,
                   row_number() OVER (PARTITION BY n_name ORDER BY COUNT(*) DESC, c_mktsegment) AS rn
            FROM s WHERE n_name IS NOT NULL AND c_mktsegment IS NOT NULL GROUP BY n_name, c_mktsegment
        ) WHERE rn = 1
    )
    SELECT agg.*, COALESCE(m.c_mktsegment, 'Unknown') AS c_mktsegment,
           printf('%.2f%%', {pct('succ', 'total_missions')}) AS success_rate,
           ROUND(total_cost_billion / NULLIF(CAST(succ AS DOUBLE), 0), 2) AS cost_per_success
    FROM agg LEFT JOIN m ON agg.n_name = m.n_name
"""


GROUP_PROFILE = _profile_sql(LINE_STAR, cnt("o_orderpriority = '1-URGENT'") + " AS urgent_lines,")


def _drop_succ(sql: str) -> str:
    return f"SELECT * EXCLUDE (succ) FROM ({sql})"


def _union_long(cols, source: str, cast: str | None = None) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS {cast})" if cast else c
        parts.append(f"SELECT '{c}' AS column_name, {v} AS value FROM {source}")
    return " UNION ALL ".join(parts)


def _describe_numeric(cols, source: str, probs, names, d: int | None) -> str:
    def r(e):
        return f"ROUND({e}, {d})" if d is not None else e

    qs = ", ".join(f"{r(f'quantile_cont(value, {p})')} AS {n}" for p, n in zip(probs, names))
    return f"""
        SELECT column_name, CAST(COUNT(value) AS BIGINT) AS count, {r('AVG(value)')} AS mean,
               {r('STDDEV_SAMP(value)')} AS std, {r('MIN(value)')} AS min, {qs}, {r('MAX(value)')} AS max
        FROM ({_union_long(cols, source, 'DOUBLE')}) WHERE value IS NOT NULL GROUP BY column_name
    """


def _edge_sql(k: str, bins: int) -> str:
    return f"(CASE WHEN {k} = {bins} THEN hi ELSE CAST({k} AS DOUBLE) * ((hi - lo) / {float(bins)}) + lo END)"


def histogram_sql(src: str, value_sql: str, where: str, bins: int, group: str | None) -> str:
    gsel = f"{group} AS g" if group else "0 AS g"
    out_g = f"grid.g AS {group}, " if group else ""
    return f"""
    WITH v AS (SELECT {gsel}, CAST({value_sql} AS DOUBLE) AS v FROM {src} WHERE {where}),
    r AS (
        SELECT g, CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo,
                  CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi
        FROM v GROUP BY g
    ),
    i0 AS (
        SELECT g, v, lo, hi, LEAST(CAST(floor((v - lo) * ({float(bins)} / (hi - lo))) AS INTEGER), {bins - 1}) AS i0
        FROM v JOIN r USING (g)
    ),
    i1 AS (SELECT *, CASE WHEN v < {_edge_sql('i0', bins)} THEN i0 - 1 ELSE i0 END AS i1 FROM i0),
    c AS (
        SELECT g, CASE WHEN i1 <> {bins - 1} AND v >= {_edge_sql('i1 + 1', bins)} THEN i1 + 1 ELSE i1 END AS bin,
               COUNT(*) AS c
        FROM i1 GROUP BY 1, 2
    ),
    grid AS (SELECT g, CAST(i AS INTEGER) AS bin, lo, hi FROM r, range(0, {bins}) t(i))
    SELECT {out_g}grid.bin, ROUND({_edge_sql('grid.bin', bins)}, 6) AS bin_start,
           ROUND({_edge_sql('(grid.bin + 1)', bins)}, 6) AS bin_end, CAST(COALESCE(c.c, 0) AS BIGINT) AS count
    FROM grid LEFT JOIN c ON grid.g = c.g AND grid.bin = c.bin
"""


CHI_SQUARE = f"""
    WITH s AS ({ORDER_STAR}),
    cells AS (SELECT r_name, o_orderstatus, COUNT(*) AS o FROM s
              WHERE r_name IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2),
    rr AS (SELECT r_name, SUM(o) AS R FROM cells GROUP BY 1),
    cc AS (SELECT o_orderstatus, SUM(o) AS C FROM cells GROUP BY 1),
    tot AS (SELECT SUM(o) AS N FROM cells),
    fl AS (SELECT cells.*, R, C, N, CAST(R AS DOUBLE) * CAST(C AS DOUBLE) / CAST(N AS DOUBLE) AS e
           FROM cells JOIN rr USING (r_name) JOIN cc USING (o_orderstatus) CROSS JOIN tot),
    st AS (
        SELECT (SELECT SUM((o - e) * (o - e) / e) FROM fl)
             + (SELECT SUM(CAST(R AS DOUBLE) * CAST(N - S AS DOUBLE) / CAST(N AS DOUBLE))
                FROM (SELECT r_name, R, N, SUM(C) AS S FROM fl GROUP BY r_name, R, N)) AS statistic,
               CAST(((SELECT COUNT(*) FROM rr) - 1) * ((SELECT COUNT(*) FROM cc) - 1) AS BIGINT) AS dof,
               CAST((SELECT N FROM tot) AS BIGINT) AS n
    ),
    pv AS (SELECT *, {chi2_upper_p_sql('statistic', 'dof')} AS p FROM st)
    SELECT ROUND(statistic, 6) AS statistic, dof, n, ROUND(p, 6) AS p_value,
           CASE WHEN p < 0.05 THEN 'associated' WHEN p IS NOT NULL THEN 'independent' END AS verdict
    FROM pv
"""

WELCH = f"""
    WITH s AS ({ORDER_STAR}),
    x AS (SELECT c_mktsegment AS g, CAST(cost AS DOUBLE) AS v FROM s),
    a AS (
        SELECT COUNT(v) FILTER (WHERE g = 'BUILDING') AS n_a, AVG(v) FILTER (WHERE g = 'BUILDING') AS mean_a,
               VAR_SAMP(v) FILTER (WHERE g = 'BUILDING') AS var_a,
               COUNT(v) FILTER (WHERE g = 'AUTOMOBILE') AS n_b, AVG(v) FILTER (WHERE g = 'AUTOMOBILE') AS mean_b,
               VAR_SAMP(v) FILTER (WHERE g = 'AUTOMOBILE') AS var_b
        FROM x
    ),
    t AS (
        SELECT *, (mean_a - mean_b) / NULLIF(sqrt(var_a / n_a + var_b / n_b), 0) AS t,
               pow(var_a / n_a + var_b / n_b, 2)
               / NULLIF(pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1), 0) AS dof
        FROM a
    ),
    p AS (SELECT *, {student_t_two_sided_p_sql('t', 'dof')} AS p FROM t)
    SELECT n_a, n_b, ROUND(mean_a, 4) AS mean_a, ROUND(mean_b, 4) AS mean_b, ROUND(t, 6) AS t_statistic,
           ROUND(dof, 4) AS dof, ROUND(p, 6) AS p_value,
           CASE WHEN p < 0.05 THEN 'different' WHEN p IS NOT NULL THEN 'not different' END AS verdict
    FROM p
"""

PEARSON = f"""
    WITH pr AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem
                WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
    s AS (SELECT CAST(COUNT(*) AS BIGINT) AS n,
                 COVAR_SAMP(x, y) / NULLIF(STDDEV_SAMP(x) * STDDEV_SAMP(y), 0) AS r FROM pr),
    t AS (SELECT *, CASE WHEN abs(r) >= 1.0 THEN CAST('inf' AS DOUBLE)
                         ELSE r * sqrt(CAST(n - 2 AS DOUBLE) / (1.0 - r * r)) END AS t FROM s),
    p AS (SELECT *, CASE WHEN n > 2 THEN {student_t_two_sided_p_sql('t', 'n - 2')} END AS p FROM t)
    SELECT n, ROUND(r, 6) AS r, ROUND(p, 6) AS p_value,
           CASE WHEN p IS NOT NULL THEN
               (CASE WHEN p < 0.05 THEN 'significant' ELSE 'not significant' END) || ' ' ||
               (CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END) END AS verdict
    FROM p
"""


ORACLE: dict[str, str] = {}

ORACLE["group_summary"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT n_name, r_name, c_mktsegment, CAST(COUNT(o_orderkey) AS BIGINT) AS total_orders,
           {cnt("o_orderstatus = 'F'")} AS finished_orders, {cnt("o_orderstatus = 'O'")} AS open_orders,
           {cnt("o_orderstatus = 'P'")} AS pending_orders, {cnt("o_orderpriority = '1-URGENT'")} AS urgent_orders,
           {pct(cnt("o_orderstatus = 'F'"), 'COUNT(o_orderkey)')} AS success_rate_pct,
           {avg_cost()} AS avg_price, CAST(ROUND(SUM(cost), 2) AS DOUBLE) AS total_price
    FROM s GROUP BY n_name, r_name, c_mktsegment
"""

ORACLE["yearly_trend"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {DECADE.format(d='o_orderdate')} AS decade,
           CAST(COUNT(o_orderkey) AS BIGINT) AS total_launches, {cnt("o_orderstatus = 'F'")} AS successes,
           {cnt("o_orderstatus = 'O'")} AS failures, {cnt("o_orderpriority = '1-URGENT'")} AS urgent_orders,
           {avg_cost()} AS avg_price
    FROM s GROUP BY 1, 2 ORDER BY 1
"""

ORACLE["destination_summary"] = f"""
    WITH f AS (
        SELECT l.l_orderkey, l.l_linestatus, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS cost, p.destination, p.category
        FROM lineitem l JOIN ({PART_ROLES}) p ON l.l_partkey = p.p_partkey
    )
    SELECT destination, category, CAST(COUNT(l_orderkey) AS BIGINT) AS total_missions,
           {pct(cnt("l_linestatus = 'F'"), 'COUNT(l_orderkey)')} AS success_rate_pct, {avg_cost()} AS avg_price
    FROM f GROUP BY destination, category
"""

ORACLE["group_profile"] = _drop_succ(GROUP_PROFILE)

ORACLE["region_profile"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT r_name, CAST(COUNT(o_orderkey) AS BIGINT) AS total_orders, {rate(cnt("o_orderstatus = 'F'"), 2)} AS success_rate,
           {cnt("c_mktsegment = 'BUILDING'")} AS govt_orders, {cnt("c_mktsegment = 'AUTOMOBILE'")} AS private_orders,
           {avg_cost()} AS avg_price,
           ROUND(CAST({cnt("c_mktsegment = 'AUTOMOBILE'")} AS DOUBLE) * 100.0 / CAST(COUNT(*) AS BIGINT), 1) AS private_pct
    FROM s WHERE r_name IS NOT NULL GROUP BY r_name
"""

ORACLE["decade_type_profile"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT {DECADE.format(d='o_orderdate')} AS order_decade, c_mktsegment, CAST(COUNT(o_orderkey) AS BIGINT) AS orders,
           {rate(cnt("o_orderstatus = 'F'"), None)} AS success_rate, {avg_cost(d=4)} AS avg_price
    FROM s WHERE c_mktsegment IS NOT NULL GROUP BY 1, 2
"""

ORACLE["category_profile"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT o_orderpriority, CAST(COUNT(o_orderkey) AS BIGINT) AS total_orders,
           {rate(cnt("o_orderstatus = 'F'"), None)} AS success_rate,
           {rate(cnt("o_orderstatus = 'O'"), None)} AS failure_rate, {avg_cost()} AS avg_price,
           CASE WHEN {rate(cnt("o_orderstatus = 'F'"), None)} < 33.0 THEN 'below' ELSE 'at_or_above' END AS rate_band
    FROM s WHERE o_orderpriority IS NOT NULL GROUP BY 1
"""

YEARS = list(range(1995, 2002))
ORACLE["category_period_pivot"] = (
    "SELECT o_orderpriority, "
    + ", ".join(f"{cnt(f'year(o_orderdate) = {y}')} AS \"{y}\"" for y in YEARS)
    + " FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY 1"
)

ORACLE["contingency"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT r_name, o_orderstatus, CAST(COUNT(*) AS BIGINT) AS observed
    FROM s WHERE r_name IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2
"""

ORACLE["group_median"] = """
    SELECT o_orderpriority, quantile_cont(o_totalprice, 0.5) AS median_price
    FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
"""

ORACLE["overview"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT CAST(COUNT(*) AS BIGINT) AS total_orders, CAST(COUNT(DISTINCT n_name) AS BIGINT) AS distinct_n_name,
           CAST(COUNT(DISTINCT r_name) AS BIGINT) AS distinct_r_name,
           CAST(MIN(year(o_orderdate)) AS INTEGER) AS min_order_year, CAST(MAX(year(o_orderdate)) AS INTEGER) AS max_order_year,
           {cnt("o_orderpriority = '1-URGENT'")} AS urgent_orders, {cnt("o_orderpriority <> '1-URGENT'")} AS other_orders
    FROM s
"""

ORACLE["distinct_where"] = """
    SELECT CAST(COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS BIGINT) AS purchasing_users
    FROM events
"""

ORACLE["value_counts"] = """
    SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1
"""

ORACLE["value_share"] = """
    SELECT c_mktsegment,
           CAST(ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS VARCHAR) || '%' AS share
    FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1
"""

ORACLE["value_counts_multi"] = f"""
    WITH o AS ({NULLABLE_ORDERS})
    SELECT column_name, value, CAST(COUNT(*) AS BIGINT) AS count
    FROM ({_union_long(['o_orderstatus', 'o_orderpriority'], 'o', 'VARCHAR')}) GROUP BY 1, 2
"""


def _seg_rate(pred: str) -> str:
    return (f"ROUND(CAST(SUM(CASE WHEN {pred} AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 "
            f"/ NULLIF(CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS DOUBLE), 0), 6)")


ORACLE["share_kpis"] = f"""
    WITH s AS ({ORDER_STAR}),
    prof AS (SELECT n_name, COUNT(*) AS total_missions, CAST(COALESCE(SUM(cost), 0) AS DOUBLE) AS total_cost_billion
             FROM s WHERE n_name IS NOT NULL GROUP BY n_name HAVING COUNT(*) > 5)
    SELECT ROUND(CAST((SELECT total_missions FROM prof WHERE n_name = 'NATION_0') AS DOUBLE) * 100.0 / COUNT(*), 6) AS key_share_pct,
           ROUND((SELECT total_cost_billion FROM prof WHERE n_name = 'NATION_0') * 100.0
                 / NULLIF((SELECT SUM(total_cost_billion) FROM prof), 0), 6) AS key_spend_share_pct,
           {_seg_rate("c_mktsegment = 'BUILDING'")} AS govt_success_rate,
           {_seg_rate("c_mktsegment = 'AUTOMOBILE'")} AS private_success_rate,
           {_seg_rate("o_orderpriority = '1-URGENT'")} AS urgent_success_rate,
           {_seg_rate("o_orderpriority = '5-LOW'")} AS low_success_rate
    FROM s
"""

ORACLE["two_sample_overview"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT c_mktsegment, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(CAST(cost AS DOUBLE)), 4) AS mean,
           ROUND(quantile_cont(CAST(cost AS DOUBLE), 0.5), 4) AS median
    FROM s WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE') AND cost IS NOT NULL GROUP BY 1
"""

ORACLE["describe_all"] = f"""
    WITH t AS ({_union_long(['o_orderstatus', 'o_orderpriority', 'o_orderdate'], 'orders', 'VARCHAR')}),
    tc AS (SELECT column_name, CAST(COUNT(value) AS BIGINT) AS count, CAST(COUNT(DISTINCT value) AS BIGINT) AS "unique"
           FROM t GROUP BY 1),
    tf AS (SELECT column_name, value, COUNT(*) AS c FROM t WHERE value IS NOT NULL GROUP BY 1, 2),
    tt AS (SELECT column_name, value AS top, c AS freq FROM (
              SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY c DESC, value) AS rn FROM tf) WHERE rn = 1),
    ns AS ({_describe_numeric(['o_orderkey', 'o_custkey', 'o_totalprice'], 'orders', [0.25, 0.5, 0.75], ['q25', 'q50', 'q75'], 4)})
    SELECT tc.column_name, count, "unique", top, CAST(freq AS BIGINT) AS freq, CAST(NULL AS DOUBLE) AS mean,
           CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS q25,
           CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, CAST(NULL AS DOUBLE) AS max
    FROM tc LEFT JOIN tt USING (column_name)
    UNION ALL
    SELECT column_name, count, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
           mean, std, min, q25, q50, q75, max FROM ns
"""

_PROBS = [0.25, 0.5, 0.75, 0.90, 0.95, 0.99]
_PNAMES = ["p25", "p50", "p75", "p90", "p95", "p99"]
ORACLE["describe_percentiles"] = f"""
    WITH ls AS ({LINE_STAR}), lsx AS (SELECT duration_days, CAST(cost AS DOUBLE) AS cost FROM ls)
    {_describe_numeric(['l_quantity', 'l_discount'], 'lineitem', _PROBS, _PNAMES, 2)}
    UNION ALL
    {_describe_numeric(['duration_days', 'cost'], 'lsx', _PROBS, _PNAMES, 2)}
"""

_ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
ORACLE["schema_report"] = (
    "SELECT m.column_name, m.dtype, c.non_null, m.position FROM (VALUES "
    + ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(_ORDER_TYPES))
    + ") AS m(column_name, dtype, position) JOIN ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS non_null FROM orders" for c, _ in _ORDER_TYPES)
    + ") c USING (column_name)"
)

ORACLE["clean_sentinels"] = f"""
    WITH r AS (
        SELECT o_orderkey AS order_key, {_raw_priority('o_orderkey', 'o_orderpriority')} AS raw_priority,
               CASE WHEN o_orderkey % 3 = 0 THEN 'not applicable' ELSE o_orderstatus END AS order_status
        FROM orders
    )
    SELECT order_key, {clean('raw_priority')} AS raw_priority, {clean('order_status')} AS order_status FROM r
"""

RAW_DATE = """
    CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
        WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        ELSE strftime(o_orderdate, '%Y') || '-02-30' END
"""


def parse_date_sql(c: str) -> str:
    s = strip(c)
    return f"CASE WHEN regexp_full_match({s}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN CAST(try_strptime({s}, '%Y-%m-%d') AS DATE) END"


ORACLE["parse_dates"] = f"""
    WITH r AS (SELECT o_orderkey, {RAW_DATE} AS raw_date FROM orders)
    SELECT o_orderkey, raw_date, {parse_date_sql('raw_date')} AS parsed_date FROM r
"""

ORACLE["calendar_attributes"] = f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
           strftime(o_orderdate, '%B') AS month_name, CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
           CAST(day(o_orderdate) AS INTEGER) AS day, {DECADE.format(d='o_orderdate')} AS decade
    FROM orders
"""

ORACLE["parse_duration"] = DURATIONS

ORACLE["parse_numeric"] = f"""
    WITH r AS (SELECT o_orderkey, {RAW_NUMBER} AS raw_cost FROM (SELECT *, CAST(o_totalprice AS VARCHAR) AS ps FROM orders)),
    v AS (SELECT *, CASE WHEN regexp_full_match(raw_cost, {NUMBER_RE}) THEN TRY_CAST(trim(raw_cost) AS DOUBLE) END AS cost_value FROM r)
    SELECT o_orderkey, raw_cost, cost_value,
           CAST(TRY_CAST(CAST(cost_value AS DECIMAL(18,6)) * 0.001 AS DECIMAL(12,2)) AS DOUBLE) AS cost_thousands
    FROM v
"""

ORACLE["lookup_validity_filter"] = f"""
    WITH b AS ({CNO}), fy AS (SELECT * FROM (VALUES {FIRST_YEAR_VALUES}) t(k, y))
    SELECT b.o_orderkey, b.n_name, b.o_orderdate FROM b JOIN fy ON b.n_name = fy.k
    WHERE CAST(b.o_orderdate AS DATE) >= make_date(CAST(fy.y AS INTEGER), 1, 1)
"""

ORACLE["rejects"] = f"""
    WITH b AS ({CNO}), fy AS (SELECT * FROM (VALUES {FIRST_YEAR_VALUES}) t(k, y))
    SELECT b.o_orderkey, b.n_name, b.o_orderdate,
           CASE WHEN fy.k IS NULL THEN 'unknown_key' WHEN b.o_orderdate IS NULL THEN 'null_date'
                ELSE 'before_reference' END AS reject_reason
    FROM b LEFT JOIN fy ON b.n_name = fy.k
    WHERE NOT COALESCE(CAST(b.o_orderdate AS DATE) >= make_date(CAST(fy.y AS INTEGER), 1, 1), FALSE)
"""

ORACLE["temporal_violations"] = """
    SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE l.l_shipdate IS NOT NULL AND l.l_shipdate < o.o_orderdate
"""

ORACLE["range_notnull_filter"] = """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
    WHERE l_returnflag IN ('R', 'A') AND l_quantity IS NOT NULL AND l_quantity < 25
"""

ORACLE["dropna"] = f"SELECT * FROM ({NULLABLE_ORDERS}) WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL"

ORACLE["dim_date"] = DIM_DATE

ORACLE["dim_group"] = """
    SELECT row_number() OVER (ORDER BY n_name NULLS FIRST, r_name NULLS FIRST, c_mktsegment NULLS FIRST)
               AS group_id, n_name, r_name, c_mktsegment
    FROM (SELECT DISTINCT n.n_name, r.r_name, c.c_mktsegment
          FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
    WHERE n_name IS NOT NULL
"""

ORACLE["dim_pair"] = DIM_PAIR

ORACLE["fact_build"] = FACT

ORACLE["meta_dim"] = "SELECT o_orderkey, o_orderpriority, o_orderstatus, o_custkey FROM orders"

ITEMS = f"""
    WITH s AS (SELECT doc_id, string_split_regex(text, ',\\s*') AS arr FROM documents WHERE text IS NOT NULL),
    e AS (SELECT doc_id, unnest(range(1, len(arr) + 1)) AS pos, unnest(arr) AS raw FROM s),
    items AS (SELECT doc_id, pos, {strip('raw')} AS item FROM e)
"""

ORACLE["bridge_explode"] = f"""
    {ITEMS}
    SELECT row_number() OVER (ORDER BY doc_id, pos, item) AS id, doc_id, item FROM items WHERE item <> ''
"""

ORACLE["bridge_counts"] = f"""
    {ITEMS}
    SELECT (SELECT CAST(COUNT(*) AS BIGINT) FROM items WHERE item <> '') AS bridge_rows,
           CAST(COUNT(DISTINCT CASE WHEN contains(text, ',') THEN doc_id END) AS BIGINT) AS docs_with_lists,
           CAST(COUNT(DISTINCT CASE WHEN lang = 'en' THEN doc_id END) AS BIGINT) AS english_docs
    FROM documents
"""

ORACLE["star_wide"] = _star(False)
ORACLE["star_wide_meta"] = _star(True)

ORACLE["pk_violations"] = """
    SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

ORACLE["fk_violations"] = """
    SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem l
    WHERE l_suppkey IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_acctbal > 0 AND s.s_suppkey = l.l_suppkey)
"""

ORACLE["unresolved_keys"] = f"""
    WITH f AS ({FACT})
    SELECT CAST(COUNT(*) FILTER (WHERE nation_id IS NULL) AS BIGINT) AS unresolved_nation_id,
           CAST(COUNT(*) FILTER (WHERE pair_id IS NULL) AS BIGINT) AS unresolved_pair_id,
           CAST(COUNT(*) FILTER (WHERE order_date_id IS NULL) AS BIGINT) AS unresolved_order_date_id,
           CAST(COUNT(*) FILTER (WHERE ship_date_id IS NULL) AS BIGINT) AS unresolved_ship_date_id
    FROM f
"""


def _rule(rule: str, col: str, pred: str, src: str) -> str:
    return (f"SELECT '{rule}' AS rule, '{col}' AS column_name, "
            f"CAST(COUNT(*) FILTER (WHERE {pred}) AS BIGINT) AS n_violations FROM {src}")


ORACLE["check_violations"] = " UNION ALL ".join([
    _rule("not_null", "l_shipdate", "l_shipdate IS NULL", "lineitem"),
    _rule("not_null", "l_returnflag", "l_returnflag IS NULL", "lineitem"),
    _rule("range", "l_discount", "l_discount IS NOT NULL AND NOT (l_discount BETWEEN 0.0 AND 0.08)", "lineitem"),
    _rule("range", "l_quantity", "l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 45)", "lineitem"),
])

ORACLE["length_violations"] = " UNION ALL ".join([
    _rule("max_length", "p_name", "length(p_name) > 10", "part"),
    _rule("max_length", "p_type", "length(p_type) > 6", "part"),
    _rule("max_length", "p_brand", "length(p_brand) > 8", "part"),
    _rule("precision", "p_retailprice",
          "p_retailprice IS NOT NULL AND TRY_CAST(p_retailprice AS DECIMAL(5,2)) IS NULL", "part"),
])

ORACLE["domain_violations"] = f"""
    SELECT column_name, value, CAST(COUNT(*) AS BIGINT) AS n_rows
    FROM ({_union_long(['o_orderstatus', 'o_orderpriority'], 'orders', 'VARCHAR')})
    WHERE value IS NOT NULL AND NOT (
        (column_name = 'o_orderstatus' AND value IN ('F', 'O'))
        OR (column_name = 'o_orderpriority' AND value IN ('1-URGENT', '2-HIGH', '3-MEDIUM')))
    GROUP BY 1, 2
"""

ORACLE["parse_counters"] = f"""
    WITH d AS ({DURATIONS})
    SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT(*) FILTER (WHERE duration_days IS NOT NULL) AS BIGINT) AS duration_parsed,
           CAST(COUNT(*) FILTER (WHERE duration_days IS NULL) AS BIGINT) AS duration_failed,
           CAST(COUNT(*) FILTER (WHERE raw_duration IS NULL) AS BIGINT) AS raw_missing
    FROM d
"""

ORACLE["health_check"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CASE WHEN COUNT(*) = 0 THEN 'empty' ELSE 'ok' END AS status FROM {t}" for t in TABLES
)

ORACLE["duplicate_counts"] = "SELECT " + ", ".join(
    f"CAST(COUNT(*) - COUNT(DISTINCT {c}) - COALESCE(MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS dup_{c}"
    for c in ["p_name", "p_partkey", "p_brand"]
) + " FROM part"

ORACLE["duplicate_rows"] = """
    SELECT p_partkey, p_name, p_brand, p_size FROM part
    WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING COUNT(*) > 1)
    ORDER BY p_name NULLS LAST, p_partkey NULLS LAST LIMIT 10
"""

_NULL_COLS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey", "o_orderdate"]
ORACLE["null_profile"] = f"""
    WITH o AS ({NULLABLE_ORDERS}),
    c AS (SELECT COUNT(*) AS n, {', '.join(f'COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}' for c in _NULL_COLS)} FROM o),
    l AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS null_count, n FROM c" for c in _NULL_COLS)})
    SELECT column_name, CAST(null_count AS BIGINT) AS null_count,
           ROUND(CAST(null_count AS DOUBLE) / CAST(n AS DOUBLE) * 100.0, 2) AS null_pct
    FROM l WHERE null_count > 0 ORDER BY null_pct DESC, column_name
"""

ORACLE["sql_params"] = """
    SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS n_orders FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000.0 GROUP BY o_orderpriority
"""

ORACLE["table_scan"] = "SELECT * FROM region"

ORACLE["row_by_key"] = "SELECT * FROM nation WHERE n_name = 'NATION_7' ORDER BY n_nationkey LIMIT 1"

ORACLE["chi_square"] = CHI_SQUARE
ORACLE["welch_t"] = WELCH
ORACLE["pearson"] = PEARSON

ORACLE["trend_line"] = f"""
    WITH s AS ({LINE_STAR}),
    prof AS (SELECT n_name, COUNT(*) AS total, {cnt("o_orderstatus = 'F'")} AS succ
             FROM s WHERE n_name IS NOT NULL GROUP BY n_name HAVING COUNT(*) > 5),
    pts AS (SELECT CAST(total AS DOUBLE) AS x, {pct('succ', 'total')} AS y FROM prof),
    fit AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, MIN(x) AS x_min, MAX(x) AS x_max FROM pts),
    g AS (SELECT CAST(i AS INTEGER) AS i, slope, intercept,
                 CASE WHEN i = 99 THEN x_max ELSE x_min + i * ((x_max - x_min) / 99.0) END AS xx
          FROM fit, range(0, 100) t(i))
    SELECT i, ROUND(xx, 6) AS x, ROUND(slope * xx + intercept, 6) AS y FROM g
"""

EV = "(SELECT event_type, value FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL)"

ORACLE["box_stats"] = f"""
    WITH e AS {EV},
    q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                 quantile_cont(value, 0.75) AS q3, CAST(COUNT(*) AS BIGINT) AS n FROM e GROUP BY 1),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT f.event_type, n, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
           ROUND(MIN(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_low,
           ROUND(MAX(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_high,
           CAST(COUNT(*) FILTER (WHERE NOT (value >= lo AND value <= hi)) AS BIGINT) AS n_outliers
    FROM e JOIN f USING (event_type) GROUP BY f.event_type, n, q1, median, q3
"""

ORACLE["kde"] = f"""
    WITH e AS {EV},
    p AS (SELECT event_type, COUNT(*) AS n, STDDEV_SAMP(value) AS sd, MIN(value) AS mn, MAX(value) AS mx
          FROM e GROUP BY 1 HAVING COUNT(*) > 1 AND STDDEV_SAMP(value) > 0),
    p2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) * 1.0 AS bw FROM p),
    p3 AS (SELECT *, mn - 2.0 * bw AS lo, (mx + 2.0 * bw - (mn - 2.0 * bw)) / 99.0 AS step FROM p2),
    dv AS (SELECT event_type, value AS v, COUNT(*) AS w FROM e GROUP BY 1, 2),
    g AS (SELECT event_type, CAST(i AS INTEGER) AS i, lo + i * step AS x, n, bw FROM p3, range(0, 100) t(i)),
    d AS (SELECT g.event_type, g.i, g.x, g.n, g.bw,
                 SUM(dv.w * exp(-0.5 * ((g.x - dv.v) / g.bw) * ((g.x - dv.v) / g.bw))) AS s
          FROM g JOIN dv USING (event_type) GROUP BY g.event_type, g.i, g.x, g.n, g.bw)
    SELECT event_type, i, ROUND(x, 6) AS x, ROUND(s / (CAST(n AS DOUBLE) * bw * sqrt(2 * pi())), 9) AS density FROM d
"""

ORACLE["histogram"] = histogram_sql("lineitem", "l_extendedprice", "l_extendedprice IS NOT NULL", 50, None)
ORACLE["histogram_by_group"] = histogram_sql(
    "events", "value", "value IS NOT NULL AND event_type IS NOT NULL", 40, "event_type"
)

ORACLE["point_feed"] = "SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view')"

ORACLE["significance"] = f"""
    WITH u AS (
        SELECT 'chi_square' AS test, p_value FROM ({CHI_SQUARE})
        UNION ALL SELECT 'welch_t', p_value FROM ({WELCH})
        UNION ALL SELECT 'pearson', p_value FROM ({PEARSON})
    )
    SELECT test, p_value,
           CASE WHEN p_value < 0.05 THEN 'significant' WHEN p_value IS NOT NULL THEN 'not significant' END AS verdict
    FROM u
"""

# The storage round trips end in plain relational results, so they get SQL too.
RAW_NUMBER_SQL = RAW_NUMBER.replace("ps", "CAST(o_totalprice AS VARCHAR)")
ORACLE["csv_roundtrip"] = f"""
    WITH r AS (
        SELECT o_orderkey, {_raw_priority('o_orderkey', 'o_orderpriority')} AS p, {RAW_NUMBER_SQL} AS c,
               {RAW_DATE} AS d
        FROM orders
    )
    SELECT o_orderkey AS order_key, {clean('p')} AS order_priority,
           CASE WHEN regexp_full_match({clean('c')}, {NUMBER_RE}) THEN TRY_CAST(trim({clean('c')}) AS DOUBLE) END
               AS total_price,
           {parse_date_sql(clean('d'))} AS order_date
    FROM r
"""

ORACLE["refresh_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"CASE WHEN COUNT(*) = 0 THEN 'empty' ELSE 'ok' END AS status FROM ({sql})"
    for name, sql in [
        ("dim_date", DIM_DATE), ("dim_nation", DIM_NATION), ("dim_pair", DIM_PAIR), ("dim_order_meta", "SELECT o_orderkey FROM orders"),
        ("fact_lines", FACT), ("bridge_items", ORACLE["bridge_explode"]),
        ("bridge_answers", "SELECT item FROM (SELECT unnest(regexp_split_to_array(text, ',\\s*')) AS item FROM benchmark) WHERE trim(item) <> ''"),
    ]
)

ORACLE["load_counters"] = f"""
    WITH y(n_name, first_year) AS (VALUES {', '.join(f"('{n}', {v})" for n, v in FIRST_YEAR.items())}),
    r AS (
        SELECT CASE WHEN first_year IS NULL THEN 'unknown_key' WHEN o_orderdate IS NULL THEN 'null_date'
                    WHEN CAST(o_orderdate AS DATE) >= make_date(first_year, 1, 1) THEN NULL ELSE 'before_reference' END AS reason
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey LEFT JOIN y ON y.n_name = n.n_name
    )
    SELECT CAST(COUNT(*) AS BIGINT) AS rows_before, {cnt('reason IS NULL')} AS rows_kept, {cnt('reason IS NOT NULL')} AS rows_dropped,
           {cnt("reason = 'unknown_key'")} AS unknown_key, {cnt("reason = 'before_reference'")} AS before_reference
    FROM r
"""

ORACLE["health_overall"] = f"""
    SELECT CAST(COUNT(*) AS BIGINT) AS n_tables, {cnt("status = 'empty'")} AS n_empty, CAST(0 AS BIGINT) AS n_failed,
           {cnt("status <> 'ok'")} = 0 AS healthy
    FROM ({ORACLE["health_check"]})
"""

ORACLE["conform_orders"] = """
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, o_orderpriority
    FROM orders
"""

ORACLE["schema_refusals"] = f"""
    SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, CAST(COUNT(o_orderkey) AS BIGINT) AS n_values, CAST(0 AS BIGINT) AS n_refused FROM orders
    UNION ALL
    SELECT 'raw_cost', 'decimal(12,2)', CAST(COUNT(*) FILTER (WHERE o_orderkey % 6 = 0 OR o_totalprice IS NOT NULL) AS BIGINT),
           {cnt('o_orderkey % 6 = 0 OR (o_orderkey % 6 IN (2, 3) AND o_totalprice IS NOT NULL)')} FROM orders
    UNION ALL
    SELECT 'raw_date', 'date', CAST(COUNT(o_orderdate) AS BIGINT), {cnt('o_orderkey % 5 IN (1, 4) AND o_orderdate IS NOT NULL')} FROM orders
"""

ORACLE["catalog_views"] = f"""
    WITH s AS ({ORDER_STAR}), l AS (SELECT p.destination, p.category, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS cost, l.l_orderkey
                                   FROM lineitem l JOIN ({PART_ROLES}) p ON l.l_partkey = p.p_partkey)
    SELECT 'group' AS view_name, n_name AS k1, r_name AS k2, c_mktsegment AS k3, CAST(COUNT(o_orderkey) AS BIGINT) AS total_orders, {avg_cost()} AS avg_price
    FROM s GROUP BY 2, 3, 4
    UNION ALL
    SELECT 'year', CAST(year(o_orderdate) AS VARCHAR), {DECADE.format(d='o_orderdate')}, NULL, CAST(COUNT(o_orderkey) AS BIGINT),
           {avg_cost('CAST(o_totalprice AS DECIMAL(12,2))')} FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 2, 3
    UNION ALL
    SELECT 'destination', destination, category, NULL, CAST(COUNT(l_orderkey) AS BIGINT), {avg_cost()} FROM l GROUP BY 2, 3
"""

ORACLE["views"] = f"""
    WITH s AS ({ORDER_STAR})
    SELECT n_name, r_name, c_mktsegment, CAST(COUNT(o_orderkey) AS BIGINT) AS total_missions,
           {pct(cnt("o_orderstatus = 'F'"), 'COUNT(o_orderkey)')} AS success_rate_pct
    FROM s GROUP BY n_name, r_name, c_mktsegment
"""

ORACLE["expected_counts"] = f"""
    WITH s AS ({ORDER_STAR}),
    cells AS (SELECT r_name, o_orderstatus, COUNT(*) AS observed FROM s
              WHERE r_name IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2),
    rr AS (SELECT r_name, SUM(observed) AS R FROM cells GROUP BY 1),
    cc AS (SELECT o_orderstatus, SUM(observed) AS C FROM cells GROUP BY 1),
    tot AS (SELECT SUM(observed) AS N FROM cells)
    SELECT r_name, o_orderstatus, CAST(COALESCE(observed, 0) AS BIGINT) AS observed,
           ROUND(CAST(R AS DOUBLE) * CAST(C AS DOUBLE) / CAST(N AS DOUBLE), 6) AS expected
    FROM rr CROSS JOIN cc CROSS JOIN tot LEFT JOIN cells USING (r_name, o_orderstatus)
"""

ORACLE["ship_days_without_orders"] = """
    SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem
    EXCEPT
    SELECT CAST(o_orderdate AS DATE) AS day FROM orders
"""
