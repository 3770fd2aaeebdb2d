"""Oracle SQL for the correctness gate: the FIXTURES.md views as DuckDB common table
expressions, prepended to every query's SQL.  DuckDB runs it on the same parquet tables."""

FIXTURE_CTES = r"""
WITH RECURSIVE
e AS (
  SELECT event_type, CAST(ts AS DATE) AS dt, value,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn_up,
         row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn_dn
  FROM events),
bars AS (
  SELECT event_type AS symbol, dt,
         max(CASE WHEN rn_up = 1 THEN value END) AS open, max(value) AS high, min(value) AS low,
         max(CASE WHEN rn_dn = 1 THEN value END) AS close,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume
  FROM e GROUP BY event_type, dt),
docs AS (
  SELECT doc_id, text AS tweet,
         CASE doc_id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
                         WHEN 3 THEN 'signup' ELSE 'view' END AS symbol,
         DATE '2024-01-01' + CAST(floor(doc_id / 5) AS INTEGER) % 30 AS dt
  FROM documents),
posts AS (
  SELECT d.doc_id, d.dt, d.tweet, d.symbol, b.open, b.high, b.low, b.close,
         b.close AS adj_close, b.volume
  FROM docs d JOIN bars b ON d.symbol = b.symbol AND d.dt = b.dt),
posts_dirty_base AS (
  SELECT doc_id, dt, CASE WHEN doc_id % 29 = 0 THEN '' ELSE tweet END AS tweet, symbol, open, high, low,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE close END AS close,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE adj_close END AS adj_close, volume
  FROM posts),
posts_dirty AS (
  SELECT * FROM posts_dirty_base UNION ALL SELECT * FROM posts_dirty_base WHERE doc_id % 10 = 0),
posts_marked AS (
  SELECT doc_id, dt,
         CASE WHEN doc_id % 3 = 0 THEN ' :smile_face: http://ex.am/p @user #tag 5% $abc ' || tweet ELSE tweet END AS tweet,
         symbol, open, high, low, close, adj_close, volume
  FROM posts),
predictions AS (
  SELECT doc_id * 2 AS seq, dt, tweet, open AS prediction, close FROM posts WHERE doc_id % 4 <> 0
  UNION ALL
  SELECT doc_id * 2 + 1 AS seq, dt, tweet, close AS prediction, close FROM posts WHERE doc_id % 8 = 1),
lex_days AS (
  SELECT symbol, dt, CASE WHEN next > close THEN 1 WHEN next < close THEN 0 END AS up
  FROM (SELECT symbol, dt, close, lead(close) OVER (PARTITION BY symbol ORDER BY dt) AS next FROM bars)),
lex_counts AS (
  SELECT word, count(*) AS n, sum(up) AS rose
  FROM (SELECT up, unnest(regexp_extract_all(lower(tweet), '[a-z]{3,}')) AS word FROM docs JOIN lex_days USING (symbol, dt) WHERE up IS NOT NULL)
  GROUP BY word),
lex_odds AS (
  SELECT word, rose + 1000.0::DOUBLE * n / sum(n) OVER () AS u, n - rose + 1000.0::DOUBLE * n / sum(n) OVER () AS d,
         sum(rose) OVER () + 1000.0::DOUBLE AS all_u, sum(n - rose) OVER () + 1000.0::DOUBLE AS all_d FROM lex_counts),
lex_z AS (SELECT word, (ln(u / (all_u - u)) - ln(d / (all_d - d))) / sqrt(1 / u + 1 / d) AS z FROM lex_odds),
lexicon AS (
  SELECT word, z / sqrt(1 + z * z) AS polarity, z * z / (1 + z * z) AS subjectivity FROM lex_z WHERE abs(z) >= 1.96),
series_long AS (
  SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS dt,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)),
clean_posts AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(tweet),
            ':[a-z_]+:', '', 'g'), 'http\S+|www\S+|https\S+', '', 'g'), '@\w+|#\w+', '', 'g'),
            '[^\w\s$%]', '', 'g') AS clean_tweet
  FROM posts)
"""


def with_fixtures(sql: str) -> str:
    """``sql`` is either a final SELECT or ', extra AS (...) SELECT ...' (more CTEs)."""
    body = sql.strip()
    if body.startswith(","):
        return FIXTURE_CTES + body
    return FIXTURE_CTES + "\n" + body


# Shared SQL pieces for the oracle side.
def clean_sql(col: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({col}), "
            r"':[a-z_]+:', '', 'g'), 'http\S+|www\S+|https\S+', '', 'g'), '@\w+|#\w+', '', 'g'), "
            r"'[^\w\s$%]', '', 'g')")


def elimination_sql(name: str, source: str, keys: str, size: int, pivots: int) -> str:
    """CTE ``name``: the ``size`` x ``size`` matrix ``m`` of ``source`` after j = 0..``pivots`` steps of elimination, each taking
    the next row and column out of the rest (one that depends on those before is passed over).  On covariances, the
    last diagonal entry is what j regressors leave."""
    cells = f"range(1, {size + 1})"
    return f"""{name} AS (
  SELECT {keys}, 0 AS j, m FROM {source}
  UNION ALL
  SELECT {keys}, j + 1, list_transform({cells}, lambda a: list_transform({cells},
         lambda b: CASE WHEN abs(m[j + 1][j + 1]) > 1e-9 THEN m[a][b] - m[a][j + 1] * m[j + 1][b] / m[j + 1][j + 1] ELSE m[a][b] END)) FROM {name} WHERE j < {pivots})"""


def matrix_sql(cols, of) -> str:
    """A list of lists: ``of(a, b)`` for all pairs of ``cols``."""
    return "[" + ", ".join("[" + ", ".join(of(a, b) for b in cols) + "]" for a in cols) + "]"


def order_search_sql(source: str, key: str, order: str, value: str, exog, max_p: int) -> str:
    """CTEs and SELECT: for each key the order of lowest AIC, compared on the rows that ``max_p`` lags leave."""
    diffs = ", ".join(f"lag({value}, {i}) OVER w - lag({value}, {i + 1}) OVER w AS d{i}" for i in range(max_p + 1))
    cols = [*exog, *[f"d{i}" for i in range(1, max_p + 1)], "d0"]
    e, size = len(exog), len(cols)
    return f"""os_d AS (SELECT {key}, {", ".join(exog)}, {diffs} FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
os_c AS (SELECT {key}, count(*) AS nobs, {matrix_sql(cols, lambda a, b: f"covar_pop({a}, {b})")} AS m
         FROM os_d WHERE d{max_p} IS NOT NULL GROUP BY {key}),
{elimination_sql("os_e", "os_c", f"{key}, nobs", size, size - 1)},
os_a AS (SELECT {key}, nobs, j - {e} AS p, nobs * ln(m[{size}][{size}]) + 2 * (j + 1) AS aic FROM os_e WHERE j >= {e} AND nobs > j + 1)
SELECT {key}, CAST(arg_min(p, aic) AS INTEGER) AS p, round(min(aic), 3) AS aic, CAST(any_value(nobs) AS INTEGER) AS nobs FROM os_a GROUP BY {key}"""


def regression_sql(name: str, source: str, label: str, x) -> str:
    """CTEs up to ``name``: one row with the means of ``x`` (m_...), that of the label (m_label) and the least squares
    coefficients (b_...) of ``label`` on ``x`` in ``source``.  Below the covariances stand unit rows: elimination leaves the
    coefficients there."""
    n = len(x)
    top = [[*[f"covar_pop({a}, {b})" for b in x], f"covar_pop({a}, {label})", *["0.0"] * (n - 1)] for a in x]
    low = [["1.0" if i == j else "0.0" for j in range(n)] + ["0.0"] * n for i in range(n)]
    rows = ", ".join("[" + ", ".join(r) + "]" for r in [*top, *low])
    means = ", ".join([*[f"avg({a}) AS m_{a}" for a in x], f"avg({label}) AS m_label"])
    keys = ", ".join([*[f"m_{a}" for a in x], "m_label"])
    return f"""{name}_c AS (SELECT {means}, [{rows}] AS m FROM {source}),
{elimination_sql(f"{name}_e", f"{name}_c", keys, 2 * n, n)},
{name} AS (SELECT {keys}, {", ".join(f"-m[{n + i + 1}][{n + 1}] AS b_{a}" for i, a in enumerate(x))} FROM {name}_e WHERE j = {n})"""


def walk_forward_sql(source: str, key: str, order: str, value: str, exog, train: int, p: int) -> str:
    """CTEs up to ``wf_p`` (key, order, value, yhat): at each row after ``train`` the prediction from all rows before.  The matrix
    of past covariances has the row's own values, less the past means, below: elimination leaves the
    prediction in the corner."""
    diffs = ", ".join(f"lag({value}, {i}) OVER w - lag({value}, {i + 1}) OVER w AS d{i}" for i in range(p + 1))
    x = [*[f"d{i}" for i in range(1, p + 1)], *exog]
    cov = [[f"covar_pop({a}, {b}) OVER past" for b in [*x, "d0"]] for a in x]
    own = [*[f"{a} - avg({a}) OVER past" for a in x], "0.0::DOUBLE"]
    rows = ", ".join("[" + ", ".join(r) + "]" for r in [*cov, own])
    n = len(x) + 1
    return f"""wf_d AS (SELECT {key}, {order}, {value}, {", ".join(exog)}, {diffs}, lag({value}) OVER w AS y1, row_number() OVER w AS pos
         FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
wf_c AS (SELECT {key}, {order}, {value}, y1, pos, avg(d0) OVER past AS base, [{rows}] AS m FROM wf_d WHERE d{p} IS NOT NULL
         WINDOW past AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
wf_s AS (SELECT * FROM wf_c WHERE pos > {train}),
{elimination_sql("wf_e", "wf_s", f"{key}, {order}, {value}, y1, base", n, n - 1)},
wf_p AS (SELECT {key}, {order}, {value}, y1 + base - m[{n}][{n}] AS yhat FROM wf_e WHERE j = {n - 1})"""


def fingerprint_sql(col: str) -> str:
    return f"CAST(('0x' || substr(md5({col}), 1, 8)) AS BIGINT)"


def tokens_sql(col: str) -> str:
    """Tokenizer semantics in DuckDB: split on single whitespace after trimming trailing
    whitespace; '' -> [''], blank-only -> []."""
    t = rf"regexp_replace(lower({col}), '\s+$', '')"
    return (f"CASE WHEN {t} = '' AND {col} <> '' THEN CAST([] AS VARCHAR[]) "
            rf"ELSE string_split_regex({t}, '\s') END")
