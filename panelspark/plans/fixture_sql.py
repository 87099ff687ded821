"""DuckDB twins of the fixture views in ``fixtures`` (oracle side).

Each entry is the body of a CTE.  ``with_views(sql, names)`` prefixes a
query with the CTEs it needs (dependencies first).
"""

from __future__ import annotations


def zf(expr: str, n: int) -> str:
    """SQL zfill: pad only values shorter than n."""
    e = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({e}) < {n} THEN lpad({e}, {n}, '0') ELSE {e} END)"


VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}

VIEWS["daily_raw"] = f"""
SELECT CAST(l_suppkey // 1000 AS VARCHAR) AS state_code,
       CAST(l_suppkey % 1000 AS VARCHAR) AS county_code,
       CAST(l_shipdate AS DATE) AS date,
       CASE WHEN (l_orderkey + l_linenumber) % 29 <> 0 THEN l_quantity * 5 END AS aqi,
       CASE WHEN l_quantity * 5 <= 50 THEN 'Good'
            WHEN l_quantity * 5 <= 100 THEN 'Moderate'
            WHEN l_quantity * 5 <= 150 THEN 'Unhealthy for Sensitive Groups'
            WHEN l_quantity * 5 <= 200 THEN 'Unhealthy'
            ELSE 'Very Unhealthy' END AS category,
       (['PM2.5', 'Ozone', 'NO2', 'CO', 'PM10'])[l_linenumber % 5 + 1] AS defining_param,
       l_linenumber AS sites
FROM lineitem"""

VIEWS["daily"] = f"""
SELECT {zf('state_code', 2)} || {zf('county_code', 3)} AS geoid,
       date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       aqi, category, defining_param, sites
FROM daily_raw"""
DEPS["daily"] = ["daily_raw"]

VIEWS["panel"] = f"""
SELECT {zf('g.k', 5)} AS geoid, c.c_name AS county_name, n.n_name AS state_name,
       g.year AS year,
       CASE WHEN (g.k + g.year) % 23 <> 0 THEN g.avg_price / 10007 END AS outcome,
       CASE WHEN (g.k + g.year) % 23 <> 0 THEN g.avg_price / 10007 END - 1 AS lower_ci,
       CASE WHEN (g.k + g.year) % 23 <> 0 THEN g.avg_price / 10007 END + 1 AS upper_ci,
       format('{{:,}}', CAST(1000 * g.n + g.k AS BIGINT)) AS total_population,
       CAST(1000 * g.n + g.k AS BIGINT) AS population,
       CASE WHEN g.k % 50 = 0 THEN -666666666.0
            ELSE CAST(30000 + (g.k * 13) % 50000 AS DOUBLE) END AS median_income,
       CAST(1000 * g.n + g.k AS BIGINT) * (g.k % 30) / 100.0 AS poverty_count,
       CAST(1000 * g.n + g.k AS BIGINT) * (g.k % 17) / 100.0 AS unemployed_count,
       CASE WHEN g.k % 3 <> 0 THEN CAST(20 + (g.k * 7 + g.year) % 60 AS DOUBLE) END AS aqi_median,
       CASE WHEN g.k % 3 <> 0 AND g.k % 31 <> 0
            THEN CAST(60 + (g.k * 11 + g.year) % 140 AS DOUBLE) END AS aqi_max
FROM (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS year,
             count(*) AS n, avg(o_totalprice) AS avg_price
      FROM orders GROUP BY 1, 2) g
JOIN customer c ON c.c_custkey = g.k
JOIN nation n ON n.n_nationkey = c.c_nationkey"""

VIEWS["centroids"] = """
SELECT n.n_name AS state, c.c_name AS county,
       printf('POINT (%.2f %.2f)', -124.0 + ((c.c_custkey * 37) % 5700) / 100.0,
              25.0 + ((c.c_custkey * 17) % 2400) / 100.0) AS geolocation
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""

VIEWS["industry_source"] = f"""
SELECT {zf('o_custkey', 5)} AS geoid, count(*) AS employed_total,
       CNTIF(o_orderpriority = '1-URGENT') AS band_1,
       CNTIF(o_orderpriority = '2-HIGH') AS band_2,
       CNTIF(o_orderpriority = '3-MEDIUM') AS band_3,
       CNTIF(o_orderpriority = '4-NOT SPECIFIED') AS band_4,
       CNTIF(o_orderpriority = '5-LOW') AS band_5
FROM orders GROUP BY 1"""

VIEWS["education_source"] = f"""
SELECT {zf('user_id', 5)} AS geoid, count(*) AS education_total,
       CNTIF(event_type = 'view') AS level_1, CNTIF(event_type = 'click') AS level_2,
       CNTIF(event_type = 'error') AS level_3, CNTIF(event_type = 'signup') AS level_4,
       CNTIF(event_type = 'purchase') AS level_5
FROM events GROUP BY 1"""

VIEWS["health_source"] = f"""
SELECT {zf('l_suppkey', 5)} AS geoid, count(*) AS civilian_total,
       CNTIF(l_returnflag = 'A') AS uninsured_a, CNTIF(l_returnflag = 'R') AS uninsured_r
FROM lineitem GROUP BY 1"""

VIEWS["period_features"] = f"""
SELECT {zf('l_suppkey', 5)} AS geoid, CAST(year(l_shipdate) AS INTEGER) AS source_year,
       count(*) AS source_rows, avg(l_discount) AS pct_discounted, avg(l_tax) AS pct_taxed
FROM lineitem WHERE year(l_shipdate) BETWEEN 1997 AND 1999 GROUP BY 1, 2"""

VIEWS["climate_payloads"] = f"""
SELECT geoid, parameter, json_group_object(yr, v)::VARCHAR AS payload
FROM (
  SELECT geoid, yr, 'tavg' AS parameter,
         CAST(q // n // 1000 AS VARCHAR) || '.' || lpad(CAST(q // n % 1000 AS VARCHAR), 3, '0') AS v
  FROM (SELECT {zf('l_suppkey', 5)} AS geoid, CAST(year(l_shipdate) AS VARCHAR) AS yr,
               CAST(sum(l_quantity) AS BIGINT) * 1000 AS q, count(*) AS n
        FROM lineitem GROUP BY 1, 2)
  UNION ALL
  SELECT geoid, yr, 'pcp' AS parameter,
         CAST(q // n // 1000 AS VARCHAR) || '.' || lpad(CAST(q // n % 1000 AS VARCHAR), 3, '0') AS v
  FROM (SELECT {zf('l_suppkey', 5)} AS geoid, CAST(year(l_shipdate) AS VARCHAR) AS yr,
               CAST(sum(l_linenumber) AS BIGINT) * 1000 AS q, count(*) AS n
        FROM lineitem GROUP BY 1, 2)
) GROUP BY 1, 2"""

VIEWS["code_map"] = f"""
SELECT {zf('n_nationkey', 2)} AS code, n_name AS label FROM nation WHERE n_nationkey <> 7"""

VIEWS["points2d"] = """
SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, label
FROM embeddings"""

VIEWS["vectors"] = ("SELECT vec_id AS id, label, "
                    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64))
                    + " FROM embeddings")


def finalize(sql: str, text_cols: list[str] = (), digits: int = 6) -> str:
    """Round every numeric output column (integers are unchanged by
    DuckDB's ``round``); ``text_cols`` are the non-numeric columns."""
    if text_cols:
        keep = ", ".join(text_cols)
        return f"SELECT {keep}, round(COLUMNS(* EXCLUDE ({keep})), {digits}) FROM ({sql}) _q"
    return f"SELECT round(COLUMNS(*), {digits}) FROM ({sql}) _q"


def cnt(cond: str) -> str:
    """BIGINT conditional count (DuckDB ``count_if`` returns HUGEINT)."""
    return f"CAST(count_if({cond}) AS BIGINT)"


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)
    for n in names:
        visit(n)
    return seen


def expand_cntif(sql: str) -> str:
    """``CNTIF(cond)`` → ``CAST(count_if(cond) AS BIGINT)`` (paren-aware)."""
    out, i = [], 0
    while True:
        j = sql.find("CNTIF(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"CAST(count_if({expand_cntif(sql[j + 6:k - 1])}) AS BIGINT)")
        i = k


def with_views(sql: str, names: list[str], extra: list[tuple[str, str]] = ()) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` plus ``extra`` (name, body)."""
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in _order(names)]
    ctes += [f"{n} AS ({body}\n)" for n, body in extra]
    if not ctes:
        return expand_cntif(sql)
    return expand_cntif("WITH " + ",\n".join(ctes) + "\n" + sql)


def rnd(*cols: str, digits: int = 6) -> str:
    """``round(c, 6) AS c`` list for the outer select of an oracle."""
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
