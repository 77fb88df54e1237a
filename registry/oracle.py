"""Independent SQL (DuckDB) for the registered queries, over the same parquet tables."""

from paywatch.columns import FEATURE_TABLE, KEYS, LABEL, MODEL_FEATURES, STRICT_FEATURES
from registry.queries import BACKTEST_DAYS, DAYS, LEAFWISE, NEWTON, NULLABLE_COUNTS, PREPARED, RANGES

RAW = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
raw AS (
  SELECT e.event_id AS tx_id, strftime(e.ts, '%Y/%m/%d %H:%M') AS ts_text,
         cf.c_nationkey AS from_bank, e.user_id AS from_account,
         ct.c_nationkey AS to_bank, CASE WHEN k <> 98 THEN k END AS to_account,
         CASE WHEN k % 50 = 49 THEN 'n/a'
              WHEN event_type = 'signup' THEN '5000.0'
              WHEN k % 10 = 0 THEN CAST(CAST((floor(value) + 1) * 1000 AS DOUBLE) AS VARCHAR)
              ELSE CAST(value * 1000 AS VARCHAR) END AS amount_paid,
         CASE WHEN event_type = 'view' THEN CAST(value * 900 AS VARCHAR)
              ELSE CAST(value * 1000 + 1 AS VARCHAR) END AS amount_received,
         CASE WHEN k % 4 = 0 THEN 'Euro'
              ELSE CASE user_id % 3 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' ELSE 'Yuan' END
         END AS receiving_currency,
         CASE user_id % 3 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' ELSE 'Yuan' END AS payment_currency,
         event_type AS payment_format,
         CASE WHEN event_type = 'error' AND value > 150 THEN '1'
              WHEN k = 13 THEN NULL WHEN k = 14 THEN 'x' ELSE '0' END AS is_laundering
  FROM ev e
  LEFT JOIN customer cf ON cf.c_custkey = e.user_id
  LEFT JOIN customer ct ON ct.c_custkey = e.k
)"""

TX = RAW + """,
tx AS (
  SELECT tx_id, strptime(ts_text, '%Y/%m/%d %H:%M') AS ts, from_bank, from_account, to_bank, to_account,
         try_cast(amount_paid AS DOUBLE) AS amount_paid, try_cast(amount_received AS DOUBLE) AS amount_received,
         receiving_currency, payment_currency, payment_format,
         CASE WHEN try_cast(is_laundering AS DECIMAL(38,0)) = 1 THEN 1 ELSE 0 END AS is_laundering
  FROM raw
  WHERE try_cast(amount_paid AS DOUBLE) > 0 AND try_cast(amount_received AS DOUBLE) > 0
    AND from_account IS NOT NULL AND to_account IS NOT NULL
)"""

ACCOUNTS = """
acc AS (
  SELECT c_nationkey AS bank_id, c_custkey AS account_number, CAST(c_custkey // 3 AS BIGINT) AS entity_id,
         'Entity ' || CAST(c_custkey // 3 AS VARCHAR) AS entity_name, n_name AS bank_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  WHERE c_custkey % 17 <> 0
)"""

DUPLICATE_ACCOUNTS = ACCOUNTS + """,
acc2 AS (
  SELECT * FROM acc
  UNION ALL
  SELECT bank_id, account_number, entity_id + 1000000, entity_name, bank_name FROM acc WHERE account_number % 50 = 1
)"""

DUPLICATE_TX = TX + """,
tx2 AS (
  SELECT * FROM tx
  UNION ALL
  SELECT * REPLACE (tx_id + 1000000000 AS tx_id) FROM tx WHERE tx_id % 200 = 0
)"""

WINDOWS = TX + """,
prev AS (
  SELECT *,
    date_diff('second', lag(ts) OVER f, ts) AS time_since_last_txn_from,
    lag(amount_paid) OVER f AS prev_amount_paid,
    row_number() OVER (PARTITION BY from_bank, from_account, CAST(ts AS DATE) ORDER BY ts, tx_id) AS rn_day,
    row_number() OVER (PARTITION BY from_bank, from_account, to_bank, to_account ORDER BY ts, tx_id) AS rn_pair,
    date_diff('second', lag(ts) OVER t, ts) AS time_since_last_txn_to,
    count(DISTINCT to_account) OVER (PARTITION BY from_bank, from_account) AS num_unique_receivers,
    count(DISTINCT to_bank) OVER (PARTITION BY from_bank, from_account) AS num_unique_banks,
    count(DISTINCT from_account) OVER (PARTITION BY to_bank, to_account) AS num_unique_senders
  FROM tx
  WINDOW f AS (PARTITION BY from_bank, from_account ORDER BY ts, tx_id),
         t AS (PARTITION BY to_bank, to_account ORDER BY ts, tx_id)
),
w AS (
  SELECT *,
    CASE WHEN rn_day = 1 THEN 1 ELSE 0 END AS first_txn_of_day_from,
    CASE WHEN rn_pair = 1 THEN 1 ELSE 0 END AS is_new_counterparty,
    rn_pair - 1 AS repeat_counterparty_count,
    count(*) OVER h1 AS txn_count_1h_from,
    count(*) OVER h24 AS txn_count_24h_from,
    count(*) OVER d7 AS txn_count_7d_from,
    sum(amount_paid) OVER h24 AS txn_amount_sum_24h_from,
    avg(amount_paid) OVER d7 AS avg_txn_amount_7d_from,
    max(amount_paid) OVER d7 AS max_txn_amount_7d_from,
    stddev_samp(amount_paid) OVER d7 AS txn_amount_std_7d_from,
    CAST(sum(CASE WHEN from_bank <> to_bank THEN 1 ELSE 0 END) OVER d7 AS DOUBLE)
      / nullif(count(*) OVER d7, 0) AS cross_bank_ratio_7d,
    stddev_samp(time_since_last_txn_from) OVER d7 AS txn_gap_std_7d,
    sum(CASE WHEN prev_amount_paid IS NOT NULL AND abs(amount_paid - prev_amount_paid) <= 1e-6
             THEN 1 ELSE 0 END) OVER h24 AS num_similar_amount_txns_24h
  FROM prev
  WINDOW h1 AS (PARTITION BY from_bank, from_account ORDER BY ts
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
         h24 AS (PARTITION BY from_bank, from_account ORDER BY ts
                 RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW),
         d7 AS (PARTITION BY from_bank, from_account ORDER BY ts
                RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)
),
feats AS (
  SELECT tx_id, ts AS event_timestamp, * EXCLUDE (tx_id, ts),
    ln(amount_paid) AS log_amount,
    CASE WHEN amount_paid >= 100000 THEN 1 ELSE 0 END AS is_large_txn,
    CASE WHEN amount_paid % 1000 = 0 THEN 1 ELSE 0 END AS is_rounded_amount,
    CASE WHEN receiving_currency <> payment_currency THEN 1 ELSE 0 END AS currencies_different,
    CASE WHEN from_bank = to_bank THEN 1 ELSE 0 END AS same_bank,
    CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day,
    CAST(extract(dow FROM ts) AS INTEGER) AS day_of_week,
    CASE WHEN extract(dow FROM ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    amount_paid / nullif(avg_txn_amount_7d_from, 0) AS amount_vs_7d_avg_ratio,
    (amount_paid - avg_txn_amount_7d_from) / nullif(txn_amount_std_7d_from, 0) AS amount_zscore_7d_from,
    (amount_paid - prev_amount_paid) / nullif(prev_amount_paid, 0) AS pct_change_vs_prev,
    CAST(txn_count_7d_from AS DOUBLE) / 7 AS txn_velocity_7d_from
  FROM w
)"""

SCORES = TX + """,
scores AS (
  SELECT tx_id, ts, is_laundering AS label, floor(amount_paid / (amount_paid + 50000) * 1000) / 1000.0 AS score,
         floor(amount_received / (amount_received + 50000) * 1000) / 1000.0 AS score_received
  FROM tx
)"""

CUT = f"(SELECT max(ts) - INTERVAL {DAYS} DAY FROM tx)"
FEATURE_CUT = f"(SELECT max(event_timestamp) - INTERVAL {DAYS} DAY FROM feats)"


def q(body, ctes=WINDOWS):
    return f"WITH {ctes.strip()}\n{body.strip()}"


def big(*columns):
    return ", ".join(f"CAST({c} AS {'DOUBLE' if c in NULLABLE_COUNTS else 'BIGINT'}) AS {c}" for c in columns)


def integer(*columns):
    return ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)


def rnd(expression, digits=4):
    """Half up, by the same floating-point steps as the Spark side."""
    return f"floor(CAST({expression} AS DOUBLE) * {10**digits} + 0.5) / CAST({10**digits} AS DOUBLE)"


def dbl(*columns, digits=4):
    return ", ".join(f"{rnd(c, digits)} AS {c}" for c in columns)


def when(column):
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def typed(name):
    kind = dict(FEATURE_TABLE)[name]
    if kind == "timestamp_ntz":
        return f"{when(name)} AS {name}"
    if name in NULLABLE_COUNTS:
        return big(name)
    return {"int": integer, "bigint": big, "double": dbl}.get(kind, lambda c: c)(name)


def lowest(source, by, keep, hash_id="tx_id"):
    """Rows of `source` kept by hash order; `keep` is an SQL expression over its columns."""
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5({hash_id} || ':42'), {hash_id})"
            f" AS rn FROM {source}) WHERE rn <= {keep}")


def fraction(rate):
    return f"substr(md5(tx_id || ':42'), 1, 8) < '{'%08x' % int(rate * 2**32)}'"


def unpivoted(columns, expression):
    """One SELECT per column; `{c}` stands for the column."""
    return "\nUNION ALL\n".join(expression.replace("{c}", c) for c in columns)


# ---- account data -----------------------------------------------------------------------------

def _side(side, accounts):
    return f"""{side}_dim AS (
  SELECT bank_id, account_number, entity_id, entity_name, bank_name FROM (
    SELECT *, row_number() OVER (PARTITION BY bank_id, account_number ORDER BY entity_id, entity_name, bank_name) AS rn
    FROM {accounts}) WHERE rn = 1
),
{side}_n AS (SELECT entity_id, count(DISTINCT account_number) AS n FROM {accounts} GROUP BY entity_id)"""


def enriched(accounts, base, source):
    return base + ",\n" + DUPLICATE_ACCOUNTS.strip() + ",\n" + _side("a", accounts) + f""",
enr AS (
  SELECT t.*, f.entity_id AS from_entity_id, f.entity_name AS from_entity_name, f.bank_name AS from_bank_name,
         g.entity_id AS to_entity_id, g.entity_name AS to_entity_name, g.bank_name AS to_bank_name,
         fn.n AS from_num_accounts_per_entity, gn.n AS to_num_accounts_per_entity
  FROM {source} t
  LEFT JOIN a_dim f ON t.from_bank = f.bank_id AND t.from_account = f.account_number
  LEFT JOIN a_dim g ON t.to_bank = g.bank_id AND t.to_account = g.account_number
  LEFT JOIN a_n fn ON f.entity_id = fn.entity_id
  LEFT JOIN a_n gn ON g.entity_id = gn.entity_id
)"""


# ---- evaluation -------------------------------------------------------------------------------

def curve(source="scores", by="", score="score"):
    part, comma = (f"PARTITION BY {by}", f"{by},") if by else ("", "")
    return f"""
hist AS (
  SELECT {comma} {score} AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM {source} GROUP BY {comma} {score}
),
curve AS (
  SELECT *, sum(pos) OVER c AS cp, sum(neg) OVER c AS cn, sum(pos) OVER g AS tp, sum(neg) OVER g AS tn
  FROM hist WINDOW c AS ({part} ORDER BY score DESC), g AS ({part})
)"""


AP = "sum(pos * (cp / (cp + cn))) / max(tp)"
AUC = "sum(neg * (cp - pos / 2.0)) / (CAST(max(tp) AS DOUBLE) * max(tn))"
KS = "max(abs(cp / greatest(tp, 1) - cn / greatest(tn, 1)))"

GRID = """
grid AS (SELECT CAST(i AS DOUBLE) / 100.0 AS threshold FROM range(1, 100) r(i)),
cells AS (
  SELECT threshold,
    count(*) FILTER (label = 0 AND score < threshold) AS tn, count(*) FILTER (label = 0 AND score >= threshold) AS fp,
    count(*) FILTER (label = 1 AND score < threshold) AS fn, count(*) FILTER (label = 1 AND score >= threshold) AS tp
  FROM scores, grid GROUP BY threshold
),
rates AS (
  SELECT *, tp / greatest(tp + fn, 1) AS rec, tn / greatest(tn + fp, 1) AS spec, tp / greatest(tp + fp, 1) AS prec
  FROM cells
),
points AS (
  SELECT *, rec + spec - 1 AS youden,
    CASE WHEN prec + rec > 0 THEN 5 * prec * rec / (4 * prec + rec) ELSE 0 END AS f2
  FROM rates
)"""


def best(metric):
    return q(f"""SELECT {dbl('threshold', digits=6)}, round({metric}, 6) AS value FROM points
                 ORDER BY {metric} DESC, threshold LIMIT 1""", SCORES + "," + GRID)


RANKED = SCORES + """,
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, tx_id) AS rn, count(*) OVER () AS n, sum(label) OVER () AS p
  FROM scores
)"""


def top_k(asks, skip=False):
    """asks: (name expression, k expression over n)."""
    parts = []
    for name, k in asks:
        k = f"least(greatest({k}, 1), n)"
        parts.append(f"""SELECT {name} AS ask, CAST(max({k}) AS BIGINT) AS k, sum(label) FILTER (rn <= {k}) AS tp,
          max(n) AS n, max(p) AS p FROM ranked""")
    body = "\nUNION ALL\n".join(parts)
    where = " WHERE ask <= n" if skip else ""
    return RANKED + f",\nasked AS ({body}),\nfound AS (SELECT * FROM asked{where})"


def _report():
    return f"""
m AS (
  SELECT CAST(count(*) FILTER (label = 0 AND score < 0.75) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (label = 0 AND score >= 0.75) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (label = 1 AND score < 0.75) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (label = 1 AND score >= 0.75) AS DOUBLE) AS tp
  FROM scores
),
c AS (
  SELECT 'legit' AS name, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall, tn + fp AS support FROM m
  UNION ALL
  SELECT 'fraud', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0), tp + fn FROM m
),
d AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM c),
all_rows AS (
  SELECT name, precision, recall, f1, support FROM d
  UNION ALL
  SELECT 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp FROM m
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM d
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1 * support) / sum(support), sum(support) FROM d
)"""


BACKTEST = SCORES + f""",
windows AS (SELECT unnest([{', '.join(map(str, BACKTEST_DAYS))}]) AS window_days),
ws AS (
  SELECT w.window_days, s.label, s.score FROM scores s, windows w
  WHERE s.ts >= (SELECT max(ts) FROM tx) - to_days(CAST(w.window_days AS INTEGER))
),""" + curve("ws", "window_days") + f""",
bt AS (
  SELECT CAST(window_days AS INTEGER) AS window_days, CAST(sum(pos + neg) AS BIGINT) AS n, {AP} AS auc_pr, {KS} AS ks
  FROM curve GROUP BY window_days HAVING max(tp) > 0 AND max(tn) > 0
)"""

SUMMARY = f"""CAST(sum(pos + neg) AS BIGINT) AS n_test, {rnd('sum(pos) / sum(pos + neg)', 6)} AS test_fraud_rate,
  {rnd(AP, 6)} AS auc_pr, {rnd(AUC, 6)} AS roc_auc, {rnd(KS, 6)} AS ks,
  {when(CUT)} AS cutoff_ts, (SELECT count(*) FROM tx WHERE ts < {CUT}) AS n_train,
  (SELECT {rnd('threshold', 6)} FROM points ORDER BY youden DESC, threshold LIMIT 1) AS best_threshold_youden"""
TEST_SCORES = SCORES.replace("FROM tx\n)", f"FROM tx WHERE ts >= {CUT}\n)") + "," + curve() + "," + GRID

# ---- preparation ------------------------------------------------------------------------------

TRAIN_TEST = WINDOWS + f""",
train AS (SELECT * FROM feats WHERE event_timestamp < {FEATURE_CUT}),
test AS (SELECT * FROM feats WHERE event_timestamp >= {FEATURE_CUT})"""


def filled(column, source="t"):
    return f"coalesce(CAST({source}.{column} AS DOUBLE), (SELECT coalesce(median(CAST({column} AS DOUBLE)), 0) FROM train))"


def filled_train(columns):
    """`filled` CTE: imputed training rows with indicators for every column."""
    cols = ",\n    ".join(
        f"{filled(c)} AS {c}, CASE WHEN t.{c} IS NULL THEN 1.0 ELSE 0.0 END AS {c}_is_missing" for c in columns)
    return TRAIN_TEST + f",\nfilled AS (SELECT tx_id,\n    {cols}\n  FROM train t)"


def _pairs(columns):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, abs(corr({a}, {b})) AS r FROM filled"
        for i, a in enumerate(columns) for b in columns[i + 1:])


def correlation_pairs():
    return q(f"""SELECT column_a, column_b, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 4) AS abs_r
                 FROM ({_pairs(STRICT_FEATURES)})""", filled_train(STRICT_FEATURES))


def correlation_keep_list():
    """Indicators exist only for columns with nulls in train; a constant one has no correlation."""
    names = STRICT_FEATURES + [c + "_is_missing" for c in STRICT_FEATURES]
    order = ", ".join(f"('{c}', {i})" for i, c in enumerate(names))
    has = "\nUNION ALL\n".join(
        [f"SELECT '{c}' AS name, true AS used" for c in STRICT_FEATURES]
        + [f"SELECT '{c}_is_missing', max({c}_is_missing) > 0 FROM filled" for c in STRICT_FEATURES])
    return q(f"""
SELECT o.name AS column_name FROM (VALUES {order}) o(name, i) JOIN used u ON u.name = o.name AND u.used
WHERE NOT EXISTS (
  SELECT 1 FROM pairs p JOIN used v ON v.name = p.column_a AND v.used
  WHERE p.column_b = o.name AND NOT isnan(p.r) AND p.r > 0.95)
""", filled_train(STRICT_FEATURES) + f",\nused AS ({has}),\npairs AS ({_pairs(names)})")


def newton(params=NEWTON):
    """CTEs of boosted trees on all training rows: `binned` rows, and for each round t gradients, the nodes of the rows level by level and
    the best split of each node; at the end `nodes`, with the splits, and `leaves` with the values of all nodes."""
    unit, lam = float(1 << 24), params.reg_lambda
    values = ", ".join(f"coalesce({rnd(c, 6)}, 0.0)" for c in STRICT_FEATURES)
    each = f"unnest(range({len(STRICT_FEATURES)})) AS f, unnest([{values}]) AS x"
    out = TRAIN_TEST + f""",
long AS MATERIALIZED (SELECT tx_id, {each} FROM train),
long_test AS MATERIALIZED (SELECT tx_id, {each} FROM test),
weight AS (SELECT count(*) FILTER (is_laundering = 0) / CAST(count(*) FILTER (is_laundering = 1) AS DOUBLE) AS w FROM train),
ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS place, count(*) OVER (PARTITION BY f) AS n,
  max(x) OVER (PARTITION BY f) AS most FROM long),
cuts AS MATERIALIZED (SELECT DISTINCT f, x FROM ranked JOIN range(1, {params.bins}) r(i)
  ON place = greatest(1, CAST(ceil(i / CAST({params.bins} AS DOUBLE) * n) AS BIGINT)) WHERE x < most),
edges AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS b FROM cuts),
binned AS MATERIALIZED (SELECT tx_id, l.f, count(c.x) AS b FROM long l LEFT JOIN cuts c ON c.f = l.f AND c.x < l.x GROUP BY tx_id, l.f),
m0 AS (SELECT tx_id, CAST(0.0 AS DOUBLE) AS m FROM train)"""
    for t in range(params.rounds):
        raw = "g" if params.top_share is None else "raw"
        out += f""",
{raw}{t} AS MATERIALIZED (
  SELECT tx_id, CAST(round(w * (p - y) * {unit}) AS BIGINT) AS g, CAST(round(w * p * (1 - p) * {unit}) AS BIGINT) AS h
  FROM (SELECT tx_id, is_laundering AS y, 1 / (1 + exp(-m)) AS p, CASE WHEN is_laundering = 1 THEN w ELSE 1.0 END AS w
    FROM m{t} JOIN train USING (tx_id), weight))"""
        if params.top_share is not None:  # all rows with large gradients, and others by a draw of the turn
            share, factor = params.other_share / (1 - params.top_share), 6364136223846793005 * (2 * t + 1) % 2**60
            out += f""",
drawn{t} AS (
  SELECT *, CAST(abs(g) AS FLOAT) > (SELECT size FROM (
      SELECT CAST(abs(g) AS FLOAT) AS size, row_number() OVER (ORDER BY abs(g) DESC) AS place, count(*) OVER () AS n FROM raw{t})
    WHERE place = CAST(ceil({params.top_share} * n) AS BIGINT)) AS high,
    CAST(CAST('0x' || substr(md5(tx_id || ':42'), 1, 15) AS HUGEINT) * {factor} % {2**60} AS DOUBLE) / {float(2**60)} < {share} AS chosen
  FROM raw{t}),
g{t} AS MATERIALIZED (SELECT tx_id, CASE WHEN high THEN g ELSE CAST(round(g * {1 / share}) AS BIGINT) END AS g,
  CASE WHEN high THEN h ELSE CAST(round(h * {1 / share}) AS BIGINT) END AS h FROM drawn{t} WHERE high OR chosen)"""
        out += f""",
n{t}_0 AS (SELECT tx_id, 0 AS node FROM m{t})"""
        first, open_ = "1", "0"  # the next node's number, and the first node of the level
        for level in range(params.depth):
            out += f""",
s{t}_{level} AS MATERIALIZED (
  SELECT *, {first} + 2 * (row_number() OVER (ORDER BY node) - 1) AS below FROM (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b) AS place FROM (
      SELECT *, lg * lg / (lh + {lam}) + rg * rg / (rh + {lam}) - tg * tg / (th + {lam}) AS gain FROM (
        SELECT node, f, b, ln, tn - ln AS rn, lg / {unit} AS lg, lh / {unit} AS lh, tg / {unit} AS tg, th / {unit} AS th,
          tg / {unit} - lg / {unit} AS rg, th / {unit} - lh / {unit} AS rh
        FROM (SELECT node, f, b, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh, sum(n) OVER upto AS ln,
            sum(g) OVER part AS tg, sum(h) OVER part AS th, sum(n) OVER part AS tn
          FROM (SELECT node, f, b, sum(g) AS g, sum(h) AS h, count(*) AS n
            FROM binned JOIN g{t} USING (tx_id) JOIN n{t}_{level} USING (tx_id) WHERE node >= {open_} GROUP BY node, f, b)
          WINDOW part AS (PARTITION BY node, f), upto AS (PARTITION BY node, f ORDER BY b))))
    WHERE gain > {params.gamma} AND ln > 0 AND rn > 0 AND lh >= {params.min_child_weight} AND rh >= {params.min_child_weight})
    WHERE place = 1{f" ORDER BY gain DESC, node LIMIT {params.leaves - level - 1}" if params.leaves else ""})),
n{t}_{level + 1} AS MATERIALIZED (
  SELECT n.tx_id, CASE WHEN s.node IS NULL THEN n.node ELSE s.below + CASE WHEN k.b > s.b THEN 1 ELSE 0 END END AS node
  FROM n{t}_{level} n LEFT JOIN s{t}_{level} s ON s.node = n.node LEFT JOIN binned k ON k.tx_id = n.tx_id AND k.f = s.f)"""
            open_, first = first, f"(1 + 2 * (SELECT count(*) FROM ({' UNION ALL '.join(f'SELECT node FROM s{t}_{i}' for i in range(level + 1))})))"
        splits = " UNION ALL ".join(f"SELECT *, {i} AS depth FROM s{t}_{i}" for i in range(params.depth))
        out += f""",
splits{t} AS MATERIALIZED ({splits}),
all{t} AS MATERIALIZED (
  SELECT 0 AS node, 0 AS depth, -(sum(g) / {unit}) / (sum(h) / {unit} + {lam}) AS value, sum(h) / {unit} AS hessian, count(*) AS n FROM g{t}
  UNION ALL SELECT below, depth + 1, -lg / (lh + {lam}), lh, ln FROM splits{t}
  UNION ALL SELECT below + 1, depth + 1, -rg / (rh + {lam}), rh, rn FROM splits{t}),
m{t + 1} AS MATERIALIZED (SELECT tx_id, m + {params.learning_rate} * value AS m
  FROM m{t} JOIN n{t}_{params.depth} USING (tx_id) JOIN all{t} USING (node))"""
    names = ", ".join(f"'{c}'" for c in STRICT_FEATURES)
    nodes = " UNION ALL ".join(f"""SELECT {t} AS tree, a.node, a.depth, [{names}][s.f + 1] AS feature, e.x AS threshold, s.below AS "left",
  s.below + 1 AS "right", coalesce(s.gain, 0.0) AS gain, a.value, a.hessian, a.n
  FROM all{t} a LEFT JOIN splits{t} s ON s.node = a.node LEFT JOIN edges e ON e.f = s.f AND e.b = s.b""" for t in range(params.rounds))
    return out + f",\nnodes AS MATERIALIZED ({nodes})"


def newton_score(params=NEWTON):
    """Test rows walk down each tree by thresholds."""
    ctes, margin = newton(params), []
    index = f"list_position([{', '.join(repr(c) for c in STRICT_FEATURES)}], feature) - 1"
    for t in range(params.rounds):
        ctes += f",\nw{t}_0 AS (SELECT tx_id, 0 AS node FROM test)"
        for level in range(params.depth):
            ctes += f""",
w{t}_{level + 1} AS (
  SELECT w.tx_id, CASE WHEN n.feature IS NULL THEN w.node WHEN x <= threshold THEN n."left" ELSE n."right" END AS node
  FROM w{t}_{level} w JOIN nodes n ON n.tree = {t} AND n.node = w.node
  LEFT JOIN long_test l ON l.tx_id = w.tx_id AND l.f = {index})"""
        margin.append(f"(SELECT w.tx_id, value FROM w{t}_{params.depth} w JOIN nodes n ON n.tree = {t} AND n.node = w.node)")
    total = " + ".join(f"{params.learning_rate} * t{t}.value" for t in range(params.rounds))
    tables = " ".join(f"JOIN {m} t{t} ON t{t}.tx_id = test.tx_id" for t, m in enumerate(margin))
    return q(f"SELECT test.tx_id, {rnd(f'1 / (1 + exp(-({total})))', 6)} AS score FROM test {tables}", ctes)


CALENDAR = """CAST(extract(hour FROM ts) AS INTEGER) AS hour_of_day, CAST(extract(dow FROM ts) AS INTEGER) AS day_of_week,
  CASE WHEN extract(dow FROM ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN from_bank = to_bank THEN 1 ELSE 0 END AS same_bank"""

CLASSES = TX + f""",
test AS (SELECT * FROM tx WHERE ts >= {CUT}),
n AS (SELECT count(*) FILTER (is_laundering = 0) AS neg, count(*) FILTER (is_laundering = 1) AS pos FROM test)"""


def keep_at_rate(rate, neg="neg", pos="pos"):
    """SQL for rows kept per label so that positives make up `rate`."""
    observed = f"CAST({pos} AS DOUBLE) / ({neg} + {pos})"
    return f"""CASE WHEN is_laundering = 1 THEN
        CASE WHEN {neg} > 0 AND {pos} > 0 AND {observed} > {rate}
             THEN least(CAST(round_even({neg} * {rate} / {1 - rate}, 0) AS BIGINT), {pos}) ELSE {pos} END
      ELSE
        CASE WHEN {neg} > 0 AND {pos} > 0 AND {observed} < {rate}
             THEN least(CAST(round_even({pos} * {1 - rate} / {rate}, 0) AS BIGINT), {neg}) ELSE {neg} END
      END"""


def enforce(rate):
    return q(f"SELECT tx_id, CAST(is_laundering AS INTEGER) AS is_laundering FROM ("
             + lowest("(SELECT * FROM test, n)", "is_laundering", keep_at_rate(rate)) + ")", CLASSES)


def _natural_rate():
    caps = "CASE WHEN is_laundering = 1 THEN 30 ELSE 2970 END"
    ctes = DUPLICATE_TX + f""",
test AS (SELECT * FROM tx2 WHERE ts >= (SELECT max(ts) - INTERVAL {DAYS} DAY FROM tx2)),
capped AS ({lowest('test', 'is_laundering', caps)}),
uniq AS (
  SELECT * EXCLUDE (rn, r2) FROM (
    SELECT *, row_number() OVER (PARTITION BY from_bank, from_account, to_bank, to_account, ts ORDER BY tx_id) AS r2
    FROM capped) WHERE r2 = 1
),
n AS (SELECT count(*) FILTER (is_laundering = 0) AS neg, count(*) FILTER (is_laundering = 1) AS pos FROM uniq)"""
    return q("SELECT tx_id, CAST(is_laundering AS INTEGER) AS is_laundering FROM ("
             + lowest("(SELECT * FROM uniq, n)", "is_laundering", keep_at_rate(0.01)) + ")", ctes)


FOLDS = TX + """,
s AS (SELECT ts, row_number() OVER (ORDER BY ts, tx_id) - 1 AS i, count(*) OVER () AS n FROM tx),
starts AS (SELECT f.fold, s.ts AS val_start FROM s JOIN range(1, 5) f(fold) ON s.i = s.n - (5 - f.fold) * (s.n // 5)),
bounds AS (SELECT fold, val_start, lead(val_start) OVER (ORDER BY fold) AS val_end FROM starts),
roles AS (
  SELECT fold, CASE WHEN ts < val_start THEN 'train' ELSE 'validate' END AS role, ts
  FROM tx, bounds WHERE ts < val_start OR val_end IS NULL OR ts < val_end
)"""

STAT = """SELECT '{c}' AS column_name, avg(CAST({c} AS DOUBLE)) AS mean_value, stddev_samp(CAST({c} AS DOUBLE)) AS std_value,
  CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM feats"""
PROFILE = """SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
  round(avg(CAST({c} AS DOUBLE)), 4) AS mean_value,
  round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 2) AS null_pct FROM sample"""
CHECKED = KEYS + [LABEL] + MODEL_FEATURES
BAD = """count(*) FILTER (amount_paid <= 0 OR amount_paid IS NULL) AS bad_amount_paid_cnt,
  count(*) FILTER (amount_received <= 0 OR amount_received IS NULL) AS bad_amount_received_cnt,
  count(*) FILTER (is_laundering NOT IN (0, 1) OR is_laundering IS NULL) AS bad_label_cnt"""


def _windowed(*columns):
    return q(f"SELECT tx_id, {', '.join(columns)} FROM w")


def _enriched_columns():
    return ", ".join(
        f"{big(f'{s}_entity_id')}, {s}_entity_name, {s}_bank_name" for s in ("from", "to"))


ORACLE = {
    "scan_transactions": q(f"""
SELECT tx_id, ts_text AS "timestamp", from_bank, from_account, to_bank, CAST(to_account AS DOUBLE) AS to_account,
  round(try_cast(amount_paid AS DOUBLE), 4) AS amount_paid, round(try_cast(amount_received AS DOUBLE), 4) AS amount_received,
  receiving_currency, payment_currency, payment_format, is_laundering FROM raw""", RAW),
    "scan_accounts": q("SELECT * FROM acc", ACCOUNTS),
    "sink_overwrite_roundtrip": q(f"SELECT tx_id, {when('ts')} AS event_timestamp, {dbl('amount_paid')} FROM tx", TX),
    "sink_append_roundtrip": q(f"""
SELECT tx_id, CASE WHEN amount_paid < 50000 THEN payment_format END AS payment_format, {dbl('amount_paid')} FROM tx""", TX),
    "add_missing_column": q(f"""
SELECT tx_id, {dbl('amount_paid')}, CAST(NULL AS VARCHAR) AS run_id, 'True,False' AS added FROM tx""", TX),
    "append_twice_roundtrip": q(f"""
SELECT tx_id, payment_format, {dbl('amount_paid')}, CASE WHEN amount_paid < 50000 THEN 'first' ELSE 'second' END AS run_id FROM tx""", TX),
    "overwrite_while_reading": q(f"""
SELECT tx_id, {dbl('amount_paid')}, 'new' AS version FROM tx WHERE amount_paid >= 1000
UNION ALL SELECT tx_id, {dbl('amount_paid')}, 'old' FROM tx WHERE amount_paid < 50000""", TX),
    "align_to_target": q(f"""
SELECT tx_id, CAST(NULL AS VARCHAR) AS note, {integer('is_laundering')}, {dbl('amount_paid')} FROM tx""", TX),
    "select_model_columns": q(f"""
SELECT tx_id, {integer('is_laundering')}, {dbl('amount_paid')}, hour_of_day, same_bank
FROM (SELECT *, {CALENDAR} FROM tx)""", TX),
    "exclude_leaky_features": q(f"SELECT tx_id, {', '.join(typed(c) for c in STRICT_FEATURES)} FROM feats"),
    "clean_transactions": q(f"""
SELECT tx_id, {when('ts')} AS ts, from_bank, from_account, to_bank, to_account, {dbl('amount_paid', 'amount_received')},
  receiving_currency, payment_currency, payment_format, {integer('is_laundering')} FROM tx""", TX),
    "rejected_transactions": q("""
SELECT * FROM (
  SELECT tx_id, CASE
    WHEN try_cast(amount_paid AS DOUBLE) IS NULL OR try_cast(amount_paid AS DOUBLE) <= 0 THEN 'amount_paid'
    WHEN try_cast(amount_received AS DOUBLE) IS NULL OR try_cast(amount_received AS DOUBLE) <= 0 THEN 'amount_received'
    WHEN from_account IS NULL THEN 'from_account' WHEN to_account IS NULL THEN 'to_account' END AS reason
  FROM raw) WHERE reason IS NOT NULL""", RAW),
    "label_normalize": q("""
SELECT tx_id, CASE WHEN try_cast(is_laundering AS DECIMAL(38,0)) = 1 THEN 1 ELSE 0 END AS is_laundering FROM raw""", RAW),
    "calendar_features": q(f"SELECT tx_id, strftime(ts, '%Y-%m-%d') AS tx_date, {CALENDAR} FROM tx", TX),
    "amount_flags": q(f"""
SELECT tx_id, {dbl('log_amount')}, {integer('is_large_txn', 'is_rounded_amount', 'currencies_different')} FROM feats"""),
    "entity_account_counts": q("""
SELECT entity_id, count(DISTINCT account_number) AS num_accounts_per_entity FROM acc2 GROUP BY entity_id""", DUPLICATE_ACCOUNTS),
    "enrich_accounts": q(f"SELECT tx_id, {_enriched_columns()} FROM enr", enriched("acc2", TX, "tx")),
    "enrich_entity_counts": q(f"""
SELECT tx_id, {big('from_num_accounts_per_entity', 'to_num_accounts_per_entity')} FROM enr""", enriched("acc", TX, "tx")),
    "from_txn_gap": _windowed(big("time_since_last_txn_from")),
    "rolling_counts": _windowed(big("txn_count_1h_from", "txn_count_24h_from", "txn_count_7d_from")),
    "rolling_amounts": _windowed(dbl("txn_amount_sum_24h_from", "avg_txn_amount_7d_from", "max_txn_amount_7d_from",
                                     "txn_amount_std_7d_from")),
    "rolling_gap_std": _windowed(dbl("txn_gap_std_7d")),
    "cross_bank_ratio": _windowed(dbl("cross_bank_ratio_7d")),
    "unique_receivers": _windowed(big("num_unique_receivers")),
    "unique_banks": _windowed(big("num_unique_banks")),
    "first_txn_of_day": _windowed(integer("first_txn_of_day_from")),
    "counterparty_novelty": _windowed(integer("is_new_counterparty"), big("repeat_counterparty_count")),
    "similar_amounts": _windowed(dbl("prev_amount_paid"), big("num_similar_amount_txns_24h")),
    "to_txn_gap": _windowed(big("time_since_last_txn_to")),
    **{name: q(f"""
SELECT tx_id, CAST(sum(first) OVER (PARTITION BY from_bank, from_account ORDER BY ts, tx_id) AS BIGINT) AS num_receivers_so_far
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY from_bank, from_account, to_account ORDER BY ts, tx_id) = 1 THEN 1 ELSE 0 END AS first
  FROM tx)""", TX) for name in ("unique_receivers_asof", "unique_receivers_asof_spread")},
    "unique_senders_asof": q("""
SELECT tx_id, CAST(sum(first) OVER (PARTITION BY to_bank, to_account ORDER BY ts, tx_id) AS BIGINT) AS num_senders_so_far
FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY to_bank, to_account, from_account ORDER BY ts, tx_id) = 1 THEN 1 ELSE 0 END AS first
  FROM tx)""", TX),
    "unique_senders": _windowed(big("num_unique_senders")),
    "ratio_features": q(f"""
SELECT tx_id, {dbl('amount_vs_7d_avg_ratio', 'amount_zscore_7d_from', 'pct_change_vs_prev', 'txn_velocity_7d_from')} FROM feats"""),
    "transaction_features": q(f"SELECT tx_id, {', '.join(typed(c) for c, _ in FEATURE_TABLE)} FROM enr",
                              enriched("acc", WINDOWS, "feats")),
    "transaction_features_spread": q(
        f"SELECT tx_id, {', '.join(typed(c) for c, _ in FEATURE_TABLE if 'entity' not in c and 'bank_name' not in c)} FROM feats"),
    "transaction_features_hot": q(f"SELECT tx_id, {', '.join(typed(c) for c, _ in FEATURE_TABLE)} FROM enr",
                                  enriched("acc", WINDOWS, "feats")),
    "busiest_accounts": q("""
SELECT from_bank, from_account, count(*) AS "rows" FROM tx GROUP BY ALL
ORDER BY "rows" DESC, from_bank NULLS FIRST, from_account NULLS FIRST LIMIT 50""", TX),
    "label_summary": q("""
SELECT count(*) AS row_count, CAST(sum(is_laundering) AS BIGINT) AS fraud_count,
  round(sum(is_laundering) / count(*), 6) AS fraud_rate FROM tx""", TX),
    "time_span": q(f"SELECT {when('min(ts)')} AS min_ts, {when('max(ts)')} AS max_ts FROM tx", TX),
    "null_rates": q(unpivoted(CHECKED, """
SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM feats""")),
    "bad_values": q(f"""
SELECT {BAD} FROM (SELECT try_cast(amount_paid AS DOUBLE) AS amount_paid, try_cast(amount_received AS DOUBLE) AS amount_received,
  try_cast(is_laundering AS INTEGER) AS is_laundering FROM raw)""", RAW),
    "duplicate_keys": q("""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows_estimate FROM (
  SELECT count(*) AS n FROM tx2 GROUP BY from_bank, from_account, to_bank, to_account, ts HAVING count(*) > 1)""", DUPLICATE_TX),
    "numeric_stats": q(f"""
SELECT column_name, {dbl('mean_value', 'std_value', 'min_value', 'max_value', digits=3)} FROM ({unpivoted(MODEL_FEATURES, STAT)})"""),
    "profile_merged": q("\nUNION ALL\n".join(unpivoted(MODEL_FEATURES, f"""
SELECT '{{c}}' AS column_name, count(*) AS rows, count({{c}}) AS n, {rnd('avg({c})', 3)} AS mean_value, {rnd('stddev_samp({c})', 3)} AS std_value,
  {rnd('min({c})', 3)} AS min_value, {rnd('max({c})', 3)} AS max_value, '{name}' AS days
FROM feats WHERE date_diff('day', (SELECT CAST(min(event_timestamp) AS DATE) FROM feats), CAST(event_timestamp AS DATE))
  BETWEEN {low} AND {high - 1}""") for name, (low, high) in RANGES.items())),
    "profile_correlations": q("SELECT column_a, column_b, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 4) AS abs_r FROM (" +
        _pairs(STRICT_FEATURES) + ")", WINDOWS + f""",
filled AS (SELECT {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}' for c in STRICT_FEATURES)} FROM feats
  WHERE date_diff('day', (SELECT CAST(min(event_timestamp) AS DATE) FROM feats), CAST(event_timestamp AS DATE)) BETWEEN 5 AND 20)"""),
    "percentiles_exact": q("\nUNION ALL\n".join(
        unpivoted(MODEL_FEATURES, f"""SELECT '{{c}}' AS column_name, CAST({s} AS DOUBLE) AS share,
  round(quantile_cont(CAST({{c}} AS DOUBLE), {s}), 4) AS value FROM feats""") for s in (0.5, 0.9, 0.99))),
    "column_medians": q(unpivoted(STRICT_FEATURES, """
SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 4) AS median_value FROM feats""")),
    "validation_report": q(f"""
SELECT count(*) AS row_count, CAST(sum(is_laundering) AS BIGINT) AS fraud_count,
  round(sum(is_laundering) / count(*), 6) AS fraud_rate,
  {when('min(event_timestamp)')} AS min_ts, {when('max(event_timestamp)')} AS max_ts,
  {', '.join(f'round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate__{c}' for c in CHECKED)},
  {BAD},
  (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
    SELECT count(*) AS n FROM tx GROUP BY from_bank, from_account, to_bank, to_account, ts HAVING count(*) > 1)
  ) AS duplicate_rows_estimate,
  'transaction_features' AS feature_table FROM feats"""),
    "class_weights": q("""
SELECT neg, pos, round(neg / pos, 6) AS scale_pos_weight, round((neg + pos) / (2 * neg), 6) AS balanced_weight_neg,
  round((neg + pos) / (2 * pos), 6) AS balanced_weight_pos
FROM (SELECT greatest(count(*) FILTER (is_laundering = 0), 1) AS neg,
             greatest(count(*) FILTER (is_laundering = 1), 1) AS pos FROM tx)""", TX),
    "pre_train_checks": q(f"""
SELECT split, count(*) AS "rows", count(*) FILTER (is_laundering IS NULL) AS null_labels,
  count(*) FILTER (is_laundering = 0) AS negatives, count(*) FILTER (is_laundering = 1) AS positives,
  CAST(count(DISTINCT is_laundering) = 2 AS INTEGER) AS both_classes,
  CAST(sum(is_laundering) < 50 AS INTEGER) AS few_positives, CAST(count(*) < 1000 AS INTEGER) AS few_rows
FROM (SELECT *, CASE WHEN ts < {CUT} THEN 'train' ELSE 'test' END AS split FROM tx) GROUP BY split""", TX),
    "training_sample_profile": q(f"""
SELECT column_name, {dbl('min_value', 'max_value', 'mean_value', digits=3)}, round(null_pct, 3) AS null_pct
FROM ({unpivoted(STRICT_FEATURES, PROFILE)})""",
        TRAIN_TEST + f",\nsample AS (SELECT * FROM train WHERE is_laundering = 1 OR {fraction(0.5)})"),
    "correlation_pairs": correlation_pairs(),
    "time_split": q(f"SELECT tx_id, CASE WHEN ts < {CUT} THEN 'train' ELSE 'test' END AS split FROM tx", TX),
    "class_sample": q(f"""
SELECT tx_id, {integer('is_laundering')} FROM tx
WHERE (is_laundering = 0 AND {fraction(0.08)}) OR (is_laundering = 1 AND {fraction(0.8)})""", TX),
    "sample_exact_n": q(f"""
SELECT tx_id, {integer('is_laundering')} FROM tx WHERE is_laundering = 0 ORDER BY md5(tx_id || ':42'), tx_id LIMIT 1000""", TX),
    "class_cap": q(f"SELECT tx_id, {integer('is_laundering')} FROM ("
                   + lowest("tx", "is_laundering", "CASE WHEN is_laundering = 1 THEN 10 ELSE 500 END") + ")", TX),
    "stratified_sample": q(f"SELECT tx_id, {integer('is_laundering')}, {dbl('amount_paid')} FROM ("
        + lowest(f"(SELECT * FROM tx WHERE (is_laundering = 0 AND {fraction(0.5)}) OR (is_laundering = 1 AND {fraction(0.9)}))",
                 "is_laundering", "CASE WHEN is_laundering = 1 THEN 40 ELSE 2000 END") + ")", TX),
    "enforce_positive_rate_down": enforce(0.005),
    "enforce_positive_rate_up": enforce(0.05),
    "natural_rate_test": _natural_rate(),
    "dedupe_keys": q(f"""
SELECT tx_id, from_bank, from_account, to_bank, to_account, {when('ts')} AS event_timestamp, {dbl('amount_paid')} FROM (
  SELECT *, row_number() OVER (PARTITION BY from_bank, from_account, to_bank, to_account, ts ORDER BY tx_id) AS rn
  FROM tx2) WHERE rn = 1""", DUPLICATE_TX),
    "backtest_windows": q(f"SELECT tx_id, {integer('is_laundering', 'window_days')} FROM ("
        + lowest(f"""(SELECT * FROM tx, (SELECT unnest([{', '.join(map(str, BACKTEST_DAYS))}]) AS window_days)
  WHERE ts >= (SELECT max(ts) FROM tx) - to_days(CAST(window_days AS INTEGER))
    AND ((is_laundering = 0 AND {fraction(0.5)}) OR (is_laundering = 1 AND {fraction(0.9)})))""",
                 "window_days, is_laundering", "CASE WHEN is_laundering = 1 THEN 8 ELSE 400 END") + ")", TX),
    "time_series_folds": q(f"""
SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS n, {when('min(ts)')} AS first_ts, {when('max(ts)')} AS last_ts
FROM roles GROUP BY fold, role""", FOLDS),
    "impute_median": q(f"SELECT tx_id, {', '.join(f'{rnd(filled(c))} AS {c}' for c in PREPARED)} FROM test t", TRAIN_TEST),
    "missing_indicators": q("""
SELECT tx_id, CASE WHEN time_since_last_txn_from IS NULL THEN 1 ELSE 0 END AS time_since_last_txn_from_is_missing,
  CASE WHEN txn_amount_std_7d_from IS NULL THEN 1 ELSE 0 END AS txn_amount_std_7d_from_is_missing,
  CASE WHEN pct_change_vs_prev IS NULL THEN 1 ELSE 0 END AS pct_change_vs_prev_is_missing FROM test""", TRAIN_TEST),
    "apply_preprocessing": q(f"""
SELECT tx_id, {rnd(filled('amount_paid'))} AS amount_paid, {rnd(filled('pct_change_vs_prev'))} AS pct_change_vs_prev,
  CASE WHEN txn_amount_std_7d_from IS NULL THEN 1 ELSE 0 END AS txn_amount_std_7d_from_is_missing
FROM feats t WHERE event_timestamp >= (SELECT max(event_timestamp) - INTERVAL 3 DAY FROM feats)""", TRAIN_TEST),
    "correlation_keep_list": correlation_keep_list(),
    "standardize": q(f"""SELECT tx_id, {', '.join(
        rnd(f"({filled(c)} - (SELECT avg({filled(c, 'u')}) FROM train u)) / (SELECT coalesce(nullif(stddev_pop({filled(c, 'u')}), 0), 1) FROM train u)") + f" AS {c}"
        for c in PREPARED)} FROM test t""", TRAIN_TEST),
    "neutralize_features": q(f"""
SELECT tx_id, round((SELECT median(CAST(repeat_counterparty_count AS DOUBLE)) FROM train), 4) AS repeat_counterparty_count,
  {dbl('amount_paid')} FROM test""", TRAIN_TEST),
    "run_summary": q(f"SELECT {SUMMARY} FROM curve", TEST_SCORES),
    "run_log_row": q(f"""
SELECT '20240101_000000' AS run_id, 'model_20240101_000000' AS model_version, {SUMMARY},
  '{{"n_estimators":5,"learning_rate":0.1}}' AS params_json,
  '[{','.join(f'"{c}"' for c in STRICT_FEATURES)}]' AS features_json,
  'models/model_20240101_000000' AS model_path, 1 AS has_time FROM curve""", TEST_SCORES),
    "run_log_json": q(f"""
SELECT count(*) AS n_test, '[{','.join(f'"{c}"' for c in STRICT_FEATURES[:3])}]' AS features_json,
  '{{"max_depth":5,"learning_rate":0.1}}' AS params_json FROM tx WHERE ts >= {CUT}""", TX),
    "average_precision": q(f"SELECT round({AP}, 6) AS auc_pr FROM curve", SCORES + "," + curve()),
    "roc_auc": q(f"SELECT round({AUC}, 6) AS roc_auc FROM curve", SCORES + "," + curve()),
    "ks_stat": q(f"SELECT round({KS}, 6) AS ks FROM curve", SCORES + "," + curve()),
    "model_benchmark": q(f"""
SELECT model, round({AP}, 6) AS auc_pr, round({AUC}, 6) AS roc_auc, round({KS}, 6) AS ks FROM curve GROUP BY model""",
        SCORES + """,
ms AS (SELECT 'paid' AS model, label, score FROM scores UNION ALL SELECT 'received', label, score_received FROM scores),"""
        + curve("ms", "model")),
    "confusion_matrix": q("""
SELECT count(*) FILTER (label = 0 AND score < 0.75) AS tn, count(*) FILTER (label = 0 AND score >= 0.75) AS fp,
  count(*) FILTER (label = 1 AND score < 0.75) AS fn, count(*) FILTER (label = 1 AND score >= 0.75) AS tp FROM scores""", SCORES),
    "classification_report": q(f"""
SELECT name, {dbl('precision', 'recall', 'f1', digits=6)}, {big('support')} FROM all_rows""", SCORES + "," + _report()),
    "threshold_grid": q(f"SELECT {dbl('threshold', digits=6)}, tn, fp, fn, tp, {dbl('youden', 'f2', digits=6)} FROM points", SCORES + "," + GRID),
    "best_threshold_youden": best("youden"),
    "best_threshold_f2": best("f2"),
    "alert_budget": q("\nUNION ALL\n".join(f"""
SELECT CAST({r} AS DOUBLE) AS rate, k, round(threshold, 6) AS threshold, alerts, tp, alerts - tp AS fp,
  round(tp / greatest(alerts, 1), 6) AS precision, round(tp / greatest(p, 1), 6) AS recall FROM (
  SELECT x.k, x.threshold, count(*) AS alerts, CAST(sum(label) AS BIGINT) AS tp, max(p) AS p
  FROM ranked, (SELECT rn AS k, score AS threshold FROM ranked
                WHERE rn = greatest(1, CAST(round_even(n * {r}, 0) AS BIGINT))) x
  WHERE score >= x.threshold GROUP BY x.k, x.threshold)""" for r in (0.001, 0.002, 0.005, 0.01)), RANKED),
    "topk_precision_recall": q("""
SELECT ask, k, round(tp / k, 6) AS precision, round(tp / greatest(p, 1), 6) AS recall, CAST(tp AS BIGINT) AS tp FROM found""",
        top_k([(f"CAST({k} AS BIGINT)", str(k)) for k in (0, 200, 10**9)])),
    "topk_rows": q("""
SELECT tx_id, CAST(label AS INTEGER) AS label, round(score, 4) AS score FROM scores ORDER BY scores.score DESC, tx_id LIMIT 200""", SCORES),
    "topk_pct": q("""
SELECT ask AS share, k, round(tp / k, 6) AS precision, round(tp / greatest(p, 1), 6) AS recall, CAST(tp AS BIGINT) AS tp FROM found""",
        top_k([(f"CAST({s} AS DOUBLE)", f"CAST(round_even(n * {s}, 0) AS BIGINT)") for s in (0.001, 0.005, 0.01)])),
    "topk_abs": q("""
SELECT k, round(tp / k, 6) AS precision, round(tp / greatest(p, 1), 6) AS recall, CAST(tp AS BIGINT) AS tp FROM found""",
        top_k([(str(k), str(k)) for k in (1000, 5000, 10000)], skip=True)),
    "investigation_capacity": q("""
SELECT k, CAST(tp AS BIGINT) AS tp, round(100.0 * tp / greatest(p, 1), 6) AS pct_caught, round(tp / k, 6) AS precision FROM found""",
        top_k([(str(k), str(k)) for k in (100, 500, 1000, 5000)], skip=True)),
    "backtest_metrics": q("SELECT window_days, n, round(auc_pr, 6) AS auc_pr, round(ks, 6) AS ks FROM bt", BACKTEST),
    "stability_trend": q("""
SELECT short_days, long_days, round(ks_short, 6) AS ks_short, round(ks_long, 6) AS ks_long,
  CASE WHEN ks_long < ks_short THEN 'drops' ELSE 'stable/improves' END AS trend
FROM (SELECT min(window_days) AS short_days, max(window_days) AS long_days, arg_min(ks, window_days) AS ks_short,
             arg_max(ks, window_days) AS ks_long, count(*) AS n FROM bt) WHERE n >= 2""", BACKTEST),

}

# Models and sketches are not SQL; what must hold for them is.
_TEST = f"FROM tx WHERE ts >= {CUT}"
ORACLE |= {
    **{name: q(f"""SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(depth AS INTEGER) AS depth, feature,
  {dbl('threshold', digits=6)}, CAST("left" AS DOUBLE) AS "left", CAST("right" AS DOUBLE) AS "right",
  {dbl('gain', 'value', 'hessian', digits=6)}, CAST(n AS BIGINT) AS rows FROM nodes""", newton(params))
       for name, params in (("newton_tree_nodes", NEWTON), ("leafwise_tree_nodes", LEAFWISE))},
    "newton_feature_gain": q(f"""SELECT feature, count(*) AS splits, {rnd('avg(gain)', 6)} AS gain, {rnd('sum(gain)', 6)} AS total_gain
FROM nodes WHERE feature IS NOT NULL GROUP BY feature""", newton()),
    "score_boosted_newton": newton_score(),
    # Three leaves: the root is split, then the child that gains more.
    "score_leafwise": newton_score(LEAFWISE),
    "percentiles_approx": q("\nUNION ALL\n".join(
        unpivoted(MODEL_FEATURES, f"""SELECT '{{c}}' AS column_name, CAST({s} AS DOUBLE) AS share, true AS within
FROM feats HAVING count({{c}}) > 0""") for s in (0.5, 0.9, 0.99))),
    "score_reloaded": q(f"SELECT tx_id, {integer('is_laundering')}, true AS same, true AS is_probability {_TEST}", TX),
    **{name: q(f"SELECT tx_id, {integer('is_laundering')}, true AS is_probability, true AS scores_differ {_TEST}", TX)
       for name in ("score_gbt", "score_forest", "score_logreg")},
    "tune_random_search": "SELECT CAST(place AS INTEGER) AS place, true AS in_ranges, true AS is_share, true AS in_order FROM range(1, 3) t(place)",
    "feature_importance": "SELECT CAST(1 AS DOUBLE) AS total, true AS none_negative, true AS one_row_each",
    "stress_test": "SELECT true AS base_is_share, true AS stressed_is_share, true AS delta_is_difference",
    "predictions_output": q(f"""
SELECT from_bank, from_account, to_bank, to_account, {when('ts')} AS event_timestamp, true AS is_probability, true AS stamped {_TEST}""", TX),
}
