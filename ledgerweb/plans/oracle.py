"""DuckDB SQL for the registered queries: name -> text, over the driver's tables as views.

The scores and metrics of trained forests have none; `rf_prediction_facts`, `rf_run_facts` and `rf_grid` hold what SQL can decide of them.
"""

from __future__ import annotations

from ledgerweb.operators import augment
from ledgerweb.plans.queries import COMMUNITY_ROUNDS, LONG_RINGS, RECALL_RINGS, RISK_TOLERANCE, SLICES, TABLES, THRESHOLDS
from ledgerweb.plans.views import LEDGER_SCORE
from ledgerweb.schema import (
    ADDITIVE_FEATURES, DEFAULT_SCORE, FEATURES, MIN_AMOUNT, MODEL_FEATURES, PAYMENT_TYPES, ScoreConfig,
)

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(24,8))) AS DOUBLE)"


def u(*parts: str) -> str:
    """The hash-uniform draw over SQL text expressions."""
    key = " || ':' || ".join(parts)
    return f"(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) / 4294967296.0)"


def txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def score_sql(c: ScoreConfig, full: bool = True) -> str:
    terms = [
        f"CASE WHEN tx_count_out > {c.tx_out} THEN {c.w_tx_out} ELSE 0 END",
        f"CASE WHEN amount_out > {c.amount_out} THEN {c.w_amount_out} ELSE 0 END",
        f"CASE WHEN amount_in < {c.amount_in} THEN {c.w_amount_in} ELSE 0 END",
    ]
    if full:
        terms += [
            f"CASE WHEN triangle_count = 0 THEN {c.w_no_triangle} ELSE 0 END",
            f"CASE WHEN cluster_size = 1 THEN {c.w_isolated} ELSE 0 END",
        ]
    return f"CAST(round({' + '.join(terms)}, 4) AS DOUBLE)"


def band_sql(c: ScoreConfig, score: str = "fraud_score") -> str:
    return f"CASE WHEN {score} >= {c.fraud} THEN 'FRAUD' WHEN {score} >= {c.suspect} THEN 'SUSPECT' ELSE 'LEGIT' END"


TRANSFERS = """transfers AS (
  SELECT event_id AS seq, 'A' || user_id AS sender, 'A' || regexp_extract(props, '([0-9]+)', 1) AS receiver,
         value AS amount, ts, event_type AS type,
         CAST(event_type = 'error' AND value >= 200 AS INTEGER) AS is_fraud
  FROM events)"""

REMITTANCES = """remittances AS (
  SELECT o_orderkey AS seq, 'O' || o_orderkey AS sender, 'C' || o_custkey AS receiver, o_totalprice AS amount,
         o_orderdate AS ts, o_orderpriority AS type,
         CAST(o_orderstatus = 'P' AND o_totalprice >= 400000 AS INTEGER) AS is_fraud
  FROM orders)"""

LEDGER = f"{TRANSFERS}, {REMITTANCES}, ledger AS (SELECT * FROM transfers UNION ALL SELECT * FROM remittances)"

PAYMENTS = """payments AS (
  SELECT 'C' || o_custkey AS sender, 'S' || l_suppkey AS receiver, l_extendedprice AS amount, o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def edges_of(tx: str, group: str = "") -> str:
    return f"""edges AS (
  SELECT {group} sender AS src, receiver AS dst, count(*) AS transaction_count, {money('amount')} AS total_amount
  FROM {tx} GROUP BY {group} sender, receiver)"""


def additive_of(group: str = "") -> str:
    return f"""ends AS (
  SELECT {group} src AS id, true AS is_out, transaction_count, total_amount FROM edges
  UNION ALL SELECT {group} dst, false, transaction_count, total_amount FROM edges),
additive AS (
  SELECT {group} id, count(*) AS degree,
    CAST(sum(CASE WHEN is_out THEN 0 ELSE transaction_count END) AS BIGINT) AS tx_count_in,
    CAST(sum(CASE WHEN is_out THEN transaction_count ELSE 0 END) AS BIGINT) AS tx_count_out,
    round({money('CASE WHEN is_out THEN 0 ELSE total_amount END')}, 4) AS amount_in,
    round({money('CASE WHEN is_out THEN total_amount ELSE 0 END')}, 4) AS amount_out
  FROM ends GROUP BY {group} id)"""


def equal(column: str, left: str, right: str) -> str:
    return f" AND {left}.{column} = {right}.{column}" if column else ""


def triangles_of(g: str = "") -> str:
    """Undirected pairs and triangles; `g` is an optional extra grouping column."""
    comma = f"{g}, " if g else ""
    return f"""und AS (
  SELECT DISTINCT {comma} least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst),
tri AS (
  SELECT {f"x.{g}, " if g else ""} x.a AS a, x.b AS b, y.b AS c FROM und x
  JOIN und y ON x.b = y.a {equal(g, 'x', 'y')} JOIN und z ON z.a = x.a AND z.b = y.b {equal(g, 'x', 'z')}),
tri_count AS (
  SELECT {comma} id, count(*) AS triangle_count
  FROM (SELECT {comma} a AS id FROM tri UNION ALL SELECT {comma} b FROM tri UNION ALL SELECT {comma} c FROM tri)
  GROUP BY {comma} id)"""


def graph_of(g: str = "") -> str:
    """Pairs, triangles and components by listing every reachable pair."""
    comma = f"{g}, " if g else ""
    return f"""{triangles_of(g)},
sym AS (SELECT {comma} a, b FROM und UNION ALL SELECT {comma} b, a FROM und),
all_nodes AS (SELECT {comma} src AS id FROM edges UNION SELECT {comma} dst FROM edges),
reach AS (
  SELECT {comma} id, id AS other FROM all_nodes
  UNION SELECT {f"r.{g}, " if g else ""} r.id, s.b FROM reach r JOIN sym s ON r.other = s.a {equal(g, 'r', 's')}),
clusters AS (SELECT {comma} id, min(other) AS component, count(*) AS cluster_size FROM reach GROUP BY {comma} id)"""


# Components again, by passing on the smallest id instead of listing all reachable pairs: for the
# view whose one component is too large for that.
MIN_LABEL = """label_nodes AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
label_sym AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
cc(id, component) USING KEY (id) AS (
  SELECT id, id FROM label_nodes
  UNION SELECT s.b, min(f.component) FROM cc f JOIN label_sym s ON s.a = f.id
  JOIN recurring.cc r ON r.id = s.b WHERE f.component < r.component GROUP BY s.b),
clusters AS (SELECT id, component, count(*) OVER (PARTITION BY component) AS cluster_size FROM cc)"""

# The five nearest of the positives, columns scaled by their extent.
NEAREST = "positives AS (SELECT a.* FROM additive a JOIN labels_of l ON l.id = a.id WHERE l.label = 1), extents AS (SELECT " + ", ".join(
    f"CAST(min({c}) AS DOUBLE) AS low_{c}, CAST(max({c}) AS DOUBLE) AS high_{c}" for c in ADDITIVE_FEATURES) + " FROM positives), scaled AS (SELECT id, " + ", ".join(
    f"CASE WHEN high_{c} > low_{c} THEN (CAST({c} AS DOUBLE) - low_{c}) / (high_{c} - low_{c}) ELSE 0 END AS {c}" for c in ADDITIVE_FEATURES) + """ FROM positives, extents),
near AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY apart, neighbor) AS INTEGER) AS nth FROM (
  SELECT x.id, y.id AS neighbor, """ + " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in ADDITIVE_FEATURES) + """ AS apart
  FROM scaled x JOIN scaled y ON x.id <> y.id)) WHERE nth <= 5)"""

# Label propagation, all rounds kept.
COMMUNITIES = f"""pair_weights AS (
  SELECT least(src, dst) AS a, greatest(src, dst) AS b, sum(transaction_count) AS weight FROM edges WHERE src <> dst GROUP BY ALL),
ties AS (SELECT a AS v, b AS other, weight FROM pair_weights UNION ALL SELECT b, a, weight FROM pair_weights),
own_weights AS (SELECT v, max(weight) AS own FROM ties GROUP BY v),
lab(id, label, round) AS (
  SELECT id, id, 0 FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)
  UNION ALL SELECT id, label, round + 1 FROM (
    SELECT id, label, round, row_number() OVER (PARTITION BY id ORDER BY weight DESC, label) AS nth FROM (
      SELECT id, label, round, sum(weight) AS weight FROM (
        SELECT t.v AS id, l.label, l.round, t.weight FROM ties t JOIN lab l ON l.id = t.other
        UNION ALL SELECT l.id, l.label, l.round, coalesce(o.own, 1) FROM lab l LEFT JOIN own_weights o ON o.v = l.id)
      GROUP BY id, label, round))
  WHERE nth = 1 AND round < {COMMUNITY_ROUNDS})"""

FULL = """feats AS (
  SELECT additive.id, degree, tx_count_in, tx_count_out, amount_in, amount_out, cluster_size,
         coalesce(triangle_count, 0) AS triangle_count
  FROM additive JOIN clusters ON additive.id = clusters.id LEFT JOIN tri_count ON additive.id = tri_count.id)"""

LABELS = """labels_of AS (
  SELECT id, CAST(max(is_fraud) > 0 AS INTEGER) AS label
  FROM (SELECT sender AS id, is_fraud FROM ledger UNION ALL SELECT receiver, is_fraud FROM ledger) GROUP BY id)"""

LEDGER_EDGES = f"{LEDGER}, {edges_of('ledger')}"
LEDGER_ADDITIVE = f"{LEDGER_EDGES}, {additive_of()}"
LEDGER_FEATURES = f"{LEDGER_ADDITIVE}, {graph_of()}, {FULL}"
SCORES = f"""raw_scores AS (SELECT *, {score_sql(LEDGER_SCORE)} AS fraud_score FROM feats),
scores AS (SELECT *, {band_sql(LEDGER_SCORE)} AS label FROM raw_scores)"""
LEDGER_SCORES = f"{LEDGER_FEATURES}, {SCORES}"
JUDGED = f"""{LEDGER_SCORES}, {LABELS},
judged AS (SELECT s.id, s.fraud_score, l.label FROM scores s JOIN labels_of l ON s.id = l.id)"""
TRANSFER_EDGES = f"{TRANSFERS}, {edges_of('transfers')}"
PAYMENT_EDGES = f"{PAYMENTS}, {edges_of('payments')}"
PAYMENT_ADDITIVE = f"{PAYMENT_EDGES}, {additive_of()}"

FEATURE_LIST = "id, degree, tx_count_in, tx_count_out, amount_in, amount_out, cluster_size, triangle_count"

DIRTY = """dirty AS (
  SELECT CASE WHEN receiver = 'A7' THEN '  ' ELSE sender END AS sender,
         CASE WHEN receiver <> 'A8' THEN receiver END AS receiver,
         CASE WHEN receiver <> 'A9' THEN amount - 1 END AS amount,
         date_trunc('second', ts) AS ts,
         CASE type WHEN 'purchase' THEN 'P2M' WHEN 'signup' THEN 'P2P' WHEN 'view' THEN 'Recharge'
                   WHEN 'error' THEN 'Refund' ELSE 'P2P' END AS type
  FROM transfers)"""
JUDGED_ROWS = f"""checked AS (
  SELECT *, CASE WHEN trim(coalesce(sender, '')) = '' THEN 'sender missing'
                 WHEN trim(coalesce(receiver, '')) = '' THEN 'receiver missing'
                 WHEN amount IS NULL THEN 'amount missing'
                 WHEN amount < {MIN_AMOUNT} THEN 'amount below minimum'
                 WHEN type NOT IN ({', '.join(repr(t) for t in PAYMENT_TYPES)}) THEN 'unknown type' END AS reason
  FROM dirty)"""

GAPPY = """gappy AS (
  SELECT * FROM transfers UNION ALL SELECT * FROM transfers WHERE type = 'error'
  UNION ALL SELECT seq, sender, NULL, amount, ts, type, is_fraud FROM transfers WHERE type = 'signup')"""


def select(body: str, *ctes: str) -> str:
    return f"WITH RECURSIVE {', '.join(ctes)} {body}" if ctes else body


def pool_sql(tx: str, salt: str, name: str = "pool") -> str:
    return f"""{name} AS (
  SELECT id, row_number() OVER (ORDER BY md5('{salt}:' || id), id) - 1 AS place
  FROM (SELECT sender AS id FROM {tx} UNION SELECT receiver FROM {tx}))"""


def rings_sql(tx: str, n_rings=30, size=(5, 10), rewire=0.6, noise=(5, 8), salt="ring") -> str:
    s = f"'{salt}'"

    def draw(*parts: str) -> str:
        return u(s, *[p if p.startswith("'") else txt(p) for p in parts])

    def between(low, high, *parts: str) -> str:
        return f"({float(low)} + {draw(*parts)} * {float(high) - float(low)})"

    def whole(low, high, *parts: str) -> str:
        return f"CAST({low} + floor({draw(*parts)} * {high - low + 1}) AS BIGINT)"

    base = f"TIMESTAMP '{augment.BASE_TIME}'"
    stamp = f"{base} + to_seconds(CAST(floor({draw(chr(39) + 'ts' + chr(39), 'kind', 'ring', 'step')} * {augment.JITTER_SECONDS}) AS BIGINT))"
    return f"""{pool_sql(tx, salt)},
members AS (SELECT count(*) AS members FROM pool),
ring_list AS (
  SELECT ring, members, least({whole(*size, "'size'", 'ring')}, members) AS ring_size,
         {whole(*noise, "'noise'", 'ring')} AS noise_rows,
         CAST(floor({draw("'base'", 'ring')} * members) AS BIGINT) AS base
  FROM range({n_rings}) r(ring), members WHERE members > 0),
steps AS (
  SELECT *, {draw("'rewire'", 'ring', 'step')} < {rewire} AS rewired
  FROM (SELECT *, unnest(range(ring_size)) AS step FROM ring_list)),
noise_steps AS (SELECT *, unnest(range(noise_rows)) AS step FROM ring_list),
drawn AS (
  SELECT ring, 'ring' AS kind, step, (base + step) % members AS from_place,
         CASE WHEN rewired THEN CAST(floor({draw("'to'", 'ring', 'step')} * members) AS BIGINT)
              ELSE (base + (step + 1) % ring_size) % members END AS to_place,
         {between(*augment.RING_AMOUNT, "'amount'", 'ring', 'step')} AS amount, 1 AS is_fraud, rewired
  FROM steps
  UNION ALL
  SELECT ring, 'noise', step,
         (base + CAST(floor({draw("'member'", 'ring', 'step')} * ring_size) AS BIGINT)) % members,
         CAST(floor({draw("'noise_to'", 'ring', 'step')} * members) AS BIGINT),
         {between(*augment.NOISE_AMOUNT, "'noise_amount'", 'ring', 'step')}, 0, false
  FROM noise_steps),
ring_rows AS (
  SELECT ring, kind, CAST(step AS INTEGER) AS step, f.id AS sender, t.id AS receiver, amount,
         {stamp} AS ts, is_fraud, rewired
  FROM drawn JOIN pool f ON f.place = from_place JOIN pool t ON t.place = to_place)"""


ROW_KEY = [
    "sender", "receiver", txt("CAST(amount AS DECIMAL(18,4))"), txt("epoch_us(ts)"),
]


def windows_sql(width: int, slide: int) -> str:
    """Tumbling and sliding windows of whole seconds, by the starts a row falls into."""
    return f"""placed AS (
  SELECT sender, amount,
         unnest(range(CAST(floor(epoch(ts) / {slide}) AS BIGINT) * {slide}, CAST(floor(epoch(ts) / {slide}) AS BIGINT) * {slide} - {width}, -{slide})) AS s
  FROM transfers),
totals AS (SELECT sender, s, count(*) AS tx_count, round({money('amount')}, 4) AS tx_amount FROM placed GROUP BY sender, s)"""


def window_out(width: int) -> str:
    return (
        f"SELECT sender, {STAMP.format('make_timestamp(s * 1000000)')} AS window_start, "
        f"{STAMP.format(f'make_timestamp((s + {width}) * 1000000)')} AS window_end, tx_count, tx_amount FROM totals"
    )


def smote_sql(draws: int, salt: str = "smote") -> str:
    s = f"'{salt}'"
    return f"""placed AS (
  SELECT a.*, row_number() OVER (ORDER BY md5({s} || ':' || a.id), a.id) - 1 AS place, count(*) OVER () AS positives
  FROM additive a JOIN labels_of l ON a.id = l.id WHERE label = 1),
stepped AS (
  SELECT x.*, draw, p AS partner, {u(s, "'step'", 'x.id', txt('draw'))} AS u
  FROM placed x, range({draws}) d(draw), placed p WHERE draw + 1 < x.positives AND p.place = (x.place + draw + 1) % x.positives)"""


def sweep_sql() -> str:
    values = ", ".join(f"({t})" for t in THRESHOLDS)
    return f"""counts AS (
  SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (fraud_score >= t AND label = 1) AS tp,
         count(*) FILTER (fraud_score >= t AND label = 0) AS fp,
         count(*) FILTER (fraud_score < t AND label = 1) AS fn, count(*) FILTER (fraud_score < t AND label = 0) AS tn
  FROM judged, (VALUES {values}) v(t) GROUP BY t)"""


SLICED = f"""sliced AS (
  SELECT t.*, b.batch_id FROM (SELECT *, floor((row_number() OVER (ORDER BY seq) - 1) * {SLICES} / count(*) OVER ()) AS slice FROM transfers) t
  JOIN range({SLICES}) b(batch_id) ON t.slice <= b.batch_id)"""

SLICED_SCORES = f"""{TRANSFERS}, {SLICED}, {edges_of('sliced', 'batch_id,')}, {additive_of('batch_id,')}, {graph_of('batch_id')},
feats AS (
  SELECT batch_id, additive.id, degree, tx_count_in, tx_count_out, amount_in, amount_out, cluster_size,
         coalesce(triangle_count, 0) AS triangle_count
  FROM additive JOIN clusters USING (batch_id, id) LEFT JOIN tri_count USING (batch_id, id)), {SCORES}"""


def profile_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
        f"CAST(count(*) AS INTEGER) AS column_count, string_agg(column_name, ',' ORDER BY column_index) AS columns "
        f"FROM duckdb_columns() WHERE table_name = '{t}'" for t in TABLES
    )


def record_sql() -> str:
    """One account as JSON text, amounts with four decimals."""
    fields = [f"'\"{c}\":' || " + (txt(f"CAST({c} AS DECIMAL(38,4))") if c.startswith("amount") else c) for c in FEATURES]
    return "'{\"id\":\"' || id || '\",' || " + " || ',' || ".join(fields) + " || '}'"


def log_hist_sql() -> str:
    return f"""bounds AS (
  SELECT log10(greatest(min(amount_out), 1)) AS lo, log10(greatest(max(amount_out), 2)) AS hi FROM additive),
binned AS (
  SELECT CASE WHEN hi = lo THEN 13 ELSE least(CAST(floor((log10(amount_out) - lo) / (hi - lo) * 14) AS INTEGER), 13) END AS bin
  FROM additive, bounds WHERE amount_out >= 1 AND log10(amount_out) >= lo)"""


ORACLE: dict[str, str] = {
    "edge_agg": select("SELECT src, dst, transaction_count, round(total_amount, 4) AS total_amount FROM edges", PAYMENT_EDGES),
    "node_features_additive": select("SELECT * FROM additive", PAYMENT_ADDITIVE),
    "risk_scores_additive": select(
        f"SELECT *, {band_sql(DEFAULT_SCORE)} AS label FROM (SELECT *, {score_sql(DEFAULT_SCORE, False)} AS fraud_score FROM additive)",
        PAYMENT_ADDITIVE),
    "bronze_transactions": select(
        f"SELECT sender, receiver, amount, {STAMP.format('date_trunc(' + repr('second') + ', ts)')} AS ts, is_fraud FROM transfers", TRANSFERS),
    "csv_import": select(
        f"SELECT sender, receiver, amount, {STAMP.format('date_trunc(' + repr('second') + ', ts)')} AS ts, is_fraud FROM transfers", TRANSFERS),
    "silver_dedup": select(
        f"SELECT seq, sender, receiver, amount, {STAMP.format('ts')} AS ts, strftime(ts, '%Y-%m-%d') AS transaction_date "
        "FROM (SELECT DISTINCT * FROM gappy) WHERE sender IS NOT NULL AND receiver IS NOT NULL AND amount IS NOT NULL AND ts IS NOT NULL",
        TRANSFERS, GAPPY),
    "validate_rejects": select(
        "SELECT sender, receiver, round(amount, 4) AS amount, type, reason FROM checked WHERE reason IS NOT NULL",
        TRANSFERS, DIRTY, JUDGED_ROWS),
    "validated_transactions": select(
        f"SELECT sender, receiver, round(amount, 4) AS amount, {STAMP.format('ts')} AS ts, type FROM checked WHERE reason IS NULL",
        TRANSFERS, DIRTY, JUDGED_ROWS),
    "upload_import": select(  # a CSV file has no blank texts: they are read as missing
        "SELECT nullif(trim(sender), '') AS sender, receiver, round(amount, 4) AS amount, 'P2P' AS type, 0 AS is_fraud, CASE "
        "WHEN trim(coalesce(sender, '')) = '' THEN 'sender missing' WHEN trim(coalesce(receiver, '')) = '' THEN 'receiver missing' "
        f"WHEN amount IS NULL THEN 'amount missing' WHEN amount < {MIN_AMOUNT} THEN 'amount below minimum' END AS reason FROM dirty",
        TRANSFERS, DIRTY),
    "table_profile": profile_sql(),
    "label_counts": select("SELECT count(*) AS row_count, count(*) FILTER (is_fraud = 1) AS fraud_rows FROM ledger", LEDGER),
    "time_parts": select(
        "SELECT seq, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%H:%M:%S') AS clock, "
        "strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') || 'T12:00:00' AS noon, "
        "strftime(ts + INTERVAL 3 DAY, '%Y-%m-%dT%H:%M:%S') AS in_three_days, "
        "'₹' || format('{:,.2f}', amount) AS amount_text FROM transfers", TRANSFERS),
    "nodes": select("SELECT sender AS id FROM ledger UNION SELECT receiver FROM ledger", LEDGER),
    "account_universe": select("SELECT id, place FROM pool", LEDGER, pool_sql("ledger", "pool")),
    "degree": select(
        "SELECT id, count(*) FILTER (NOT is_out) AS in_degree, count(*) FILTER (is_out) AS out_degree, count(*) AS degree "
        "FROM ends GROUP BY id", LEDGER_ADDITIVE),
    "hubs_gt_t": select("SELECT id, degree FROM additive WHERE degree > 10", LEDGER_ADDITIVE),
    "neighbor_counts": select(
        "SELECT id, CAST(sum(n) AS BIGINT) AS neighbor_count FROM (SELECT a AS id, 1 AS n FROM und UNION ALL SELECT b, 1 FROM und "
        "UNION ALL SELECT src, 0 FROM edges WHERE src = dst) GROUP BY id", LEDGER_EDGES, graph_of()),
    "undirected_edges": select("SELECT a, b FROM und", LEDGER_EDGES, graph_of()),
    "top_edges": select(
        "SELECT src, dst, transaction_count, round(total_amount, 4) AS total_amount FROM edges "
        "ORDER BY transaction_count DESC, src, dst LIMIT 2000", TRANSFER_EDGES),
    "top_hub_subgraph": select(
        "SELECT src, dst, transaction_count, round(total_amount, 4) AS total_amount FROM edges "
        "WHERE src IN (SELECT id FROM best) AND dst IN (SELECT id FROM best)", TRANSFER_EDGES,
        "best AS (SELECT id FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY id "
        "ORDER BY count(*) DESC, id LIMIT 40)"),
    "viz_nodes": select(
        "SELECT id, id AS label, CASE WHEN degree > 10 THEN 'red' END AS color FROM additive", LEDGER_ADDITIVE),
    "viz_edges": select(
        "SELECT src, dst, transaction_count AS value, 'Txns: ' || transaction_count || ', Amt: ' || "
        "CAST(CAST(total_amount AS DECIMAL(30,2)) AS VARCHAR) AS title FROM edges", TRANSFER_EDGES),
    "reciprocal_pairs": select(
        "SELECT e.src AS a, e.dst AS b, e.transaction_count AS tx_ab, f.transaction_count AS tx_ba "
        "FROM edges e JOIN edges f ON e.src = f.dst AND e.dst = f.src WHERE e.src < e.dst", TRANSFER_EDGES),
    "reciprocal_counts": select(
        "SELECT e.src AS id, count(*) AS reciprocal_count FROM edges e JOIN edges f ON e.src = f.dst AND e.dst = f.src "
        "WHERE e.src <> e.dst GROUP BY e.src", TRANSFER_EDGES),
    "flow_imbalance": select(
        "SELECT id, amount_in, amount_out, round(CASE WHEN amount_in <> 0 THEN amount_out / amount_in END, 6) AS out_in_ratio, "
        "tx_count_out > 0 AND tx_count_in = 0 AS only_sends, "
        "amount_out > 0 AND (amount_in = 0 OR amount_out / amount_in > 10) AS disproportionate, "
        "cluster_size = 1 AS isolated_cluster, triangle_count = 0 AS no_triangles FROM feats", LEDGER_FEATURES),
    "triangle_count": select("SELECT * FROM tri_count", LEDGER_EDGES, graph_of()),
    "triangle_count_transfers": select("SELECT * FROM tri_count", TRANSFER_EDGES, triangles_of()),
    "component_sizes": select("SELECT * FROM clusters", LEDGER_EDGES, graph_of()),
    "component_table": select(
        "SELECT component, count(*) AS cluster_size FROM clusters GROUP BY component", LEDGER_EDGES, graph_of()),
    "node_features_full": select("SELECT * FROM feats", LEDGER_FEATURES),
    "node_features_proxy": select(
        "SELECT *, degree AS cluster_size, degree AS triangle_count FROM additive", LEDGER_ADDITIVE),
    "risk_scores": select("SELECT * FROM scores", LEDGER_SCORES),
    "jittered_scores": select(
        f"SELECT id, round(greatest(least({score_sql(LEDGER_SCORE, False)} + (-0.05 + {u(repr('jitter'), 'id')} * 0.1), 1), 0), 4) "
        "AS fraud_score FROM additive", LEDGER_ADDITIVE),
    "node_labels": select("SELECT * FROM labels_of", LEDGER, LABELS),
    "labelled_features": select(
        "SELECT a.*, a.degree AS cluster_size, a.degree AS triangle_count, label FROM additive a JOIN labels_of l ON a.id = l.id",
        LEDGER_ADDITIVE, LABELS),
    "class_weights": select(
        "SELECT id, label, round(CASE WHEN label = 1 THEN (SELECT count(*) FILTER (label = 0) / nullif(count(*) FILTER (label = 1), 0) "
        "FROM labels_of) ELSE 1 END, 9) AS weight FROM labels_of", LEDGER, LABELS),
    "train_test_split": select(
        f"SELECT id, label, CASE WHEN {u(repr('42'), 'id')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM labels_of",
        LEDGER, LABELS),
    "class_distribution": select("SELECT label, count(*) AS accounts FROM labels_of GROUP BY label", LEDGER, LABELS),
    "class_ratio": select(
        "SELECT negatives, positives, round(negatives / nullif(positives, 0), 9) AS ratio FROM (SELECT count(*) FILTER (label = 0) "
        "AS negatives, count(*) FILTER (label = 1) AS positives FROM labels_of)", LEDGER, LABELS),
    "smote_rows": select(
        "SELECT id || '#' || draw AS id, "
        + ", ".join(f"round({c} + u * (partner.{c} - {c}), 4) AS {c}" for c in ADDITIVE_FEATURES)
        + ", 1 AS label FROM stepped", LEDGER_ADDITIVE, LABELS, smote_sql(2)),
    "nearest_fraud": select(
        "SELECT id, nth AS rank, neighbor, round(sqrt(apart), 9) AS distance FROM near", LEDGER_ADDITIVE, LABELS, NEAREST),
    "smote_neighbor_rows": select(
        "SELECT s.id || '#' || s.draw AS id, " + ", ".join(f"round(a.{c} + s.u * (b.{c} - a.{c}), 4) AS {c}" for c in ADDITIVE_FEATURES)
        + ", 1 AS label FROM stepped s JOIN near n ON n.id = s.id AND n.nth = s.nth JOIN positives a ON a.id = s.id JOIN positives b ON b.id = n.neighbor",
        LEDGER_ADDITIVE, LABELS, NEAREST,
        "counted AS (SELECT id, count(*) AS n FROM near GROUP BY id)",
        "drawn AS (SELECT id, n, unnest([0, 1]) AS draw FROM counted)",
        "stepped AS (SELECT id, draw, CAST(floor(" + u("'smote'", "'neighbor'", "id", "draw::VARCHAR") + " * n) AS INTEGER) + 1 AS nth, "
        + u("'smote'", "'step'", "id", "draw::VARCHAR") + " AS u FROM drawn)"),
    "feature_summary": select(
        "SELECT count(*) AS nodes, max(degree) AS max_degree, max(amount_out) AS max_amount_out, "
        "count(*) FILTER (triangle_count = 0) AS zero_triangle_nodes, count(*) FILTER (cluster_size = 1) AS isolated_nodes FROM feats",
        LEDGER_FEATURES),
    "risk_bands": select(
        "SELECT b.label, count(s.id) AS accounts, round(count(s.id) / (SELECT count(*) FROM scores), 6) AS share, "
        "format('{:.1f}%', round(count(s.id) / (SELECT count(*) FROM scores), 6) * 100) AS share_text "
        "FROM (VALUES ('FRAUD'), ('SUSPECT'), ('LEGIT')) b(label) LEFT JOIN scores s ON s.label = b.label GROUP BY b.label",
        LEDGER_SCORES),
    "degree_hist": select("SELECT degree, count(*) AS accounts FROM additive GROUP BY degree", LEDGER_ADDITIVE),
    "amount_log_hist": select(
        "SELECT CAST(b.bin AS INTEGER) AS bin, round(pow(10, lo + b.bin * (hi - lo) / 14)) AS left_edge, count(binned.bin) AS accounts "
        "FROM range(14) b(bin) CROSS JOIN bounds LEFT JOIN binned ON binned.bin = b.bin GROUP BY b.bin, lo, hi",
        PAYMENT_ADDITIVE, log_hist_sql()),
    "top_alerts": select(
        f"SELECT * FROM scores WHERE fraud_score >= {LEDGER_SCORE.fraud} ORDER BY fraud_score DESC, id LIMIT 10", LEDGER_SCORES),
    "accounts_by_risk": select(
        "SELECT row_number() OVER (ORDER BY fraud_score DESC, id) AS rank, id, fraud_score, label FROM scores", LEDGER_SCORES),
    "top_scored_per_band": select(
        "SELECT label, CAST(rank AS INTEGER) AS rank, id, fraud_score FROM (SELECT *, row_number() OVER (PARTITION BY label "
        "ORDER BY fraud_score DESC, id) AS rank FROM scores) WHERE rank <= 8", LEDGER_SCORES),
    "recent_transactions": select(
        f"SELECT seq, sender, receiver, amount, {STAMP.format('ts')} AS ts, type FROM transfers ORDER BY seq DESC LIMIT 20", TRANSFERS),
    "session_totals": select(
        "SELECT (SELECT count(*) FROM ledger) AS transactions, count(*) AS accounts, "
        f"count(*) FILTER (fraud_score >= {LEDGER_SCORE.fraud}) AS alerts FROM scores", LEDGER_SCORES),
    "accounts_sketch": select(
        "SELECT type, count(*) AS exact, true AS is_close FROM (SELECT sender AS id, type FROM ledger UNION SELECT receiver, type FROM ledger "
        "UNION SELECT sender, NULL FROM ledger UNION SELECT receiver, NULL FROM ledger) GROUP BY type", LEDGER),
    "daily_account_sketches": select(
        "SELECT strftime(day, '%Y-%m-%d') AS day, tx_count, amount, exact, true AS is_close FROM (SELECT p.day, count(*) AS tx_count, "
        f"round({money('l.amount')}, 4) AS amount FROM days p JOIN ledger l ON CAST(l.ts AS DATE) BETWEEN p.day - 6 AND p.day GROUP BY p.day) "
        "JOIN (SELECT p.day, count(DISTINCT e.id) AS exact FROM days p JOIN ends e ON e.day BETWEEN p.day - 6 AND p.day GROUP BY p.day) USING (day)",
        LEDGER, "ends AS (SELECT CAST(ts AS DATE) AS day, sender AS id FROM ledger UNION SELECT CAST(ts AS DATE), receiver FROM ledger)",
        "days AS (SELECT DISTINCT day FROM ends)"),
    "broken_lines": select(
        "SELECT reason, line, count(*) AS rows, CASE WHEN line = '-' THEN round(" + money("amount") + ", 4) END AS amount FROM lined GROUP BY reason, line",
        TRANSFERS, "lined AS (SELECT CASE WHEN receiver IN ('A8', 'A9') THEN 'broken line' "
        f"WHEN amount < {MIN_AMOUNT} THEN 'amount below minimum' END AS reason, "
        "CASE receiver WHEN 'A8' THEN sender || ',' || receiver WHEN 'A9' THEN concat_ws(',', sender, receiver, amount::VARCHAR, 'P2P', 'x') "
        "ELSE '-' END AS line, amount FROM transfers)"),
    "empty_scores": select("SELECT * FROM scores WHERE false", LEDGER_SCORES),
    "display_table": select(
        "SELECT id, format('{:.4f}', fraud_score) AS score_text, '₹' || format('{:,.2f}', amount_in) AS amount_in_text, "
        "'₹' || format('{:,.2f}', amount_out) AS amount_out_text, degree, tx_count_in, tx_count_out, cluster_size, triangle_count FROM scores",
        LEDGER_SCORES),
    "request_payload": select(
        "SELECT (n - 1) // 1000 AS request_id, CAST(count(*) AS INTEGER) AS records, "
        "'{\"dataframe_records\":[' || string_agg(record, ',' ORDER BY n) || ']}' AS payload "
        f"FROM (SELECT row_number() OVER (ORDER BY id) AS n, {record_sql()} AS record FROM feats) GROUP BY 1", LEDGER_FEATURES),
    "request_rows": select(
        f"SELECT (n - 1) // 1000 AS request_id, CAST((n - 1) % 1000 AS INTEGER) AS pos, {FEATURE_LIST} "
        "FROM (SELECT *, row_number() OVER (ORDER BY id) AS n FROM feats)", LEDGER_FEATURES),
    "response_scores": select("SELECT id, fraud_score FROM scores", LEDGER_SCORES),
    "features_csv": select("SELECT * FROM feats", LEDGER_FEATURES),
    "predictions_csv": select("SELECT id, fraud_score, label FROM scores", LEDGER_SCORES),
    "scaled_transactions": select(
        f"SELECT seq, sender, receiver, round(amount * (1 + ({u(repr('scale'), *ROW_KEY, txt('copy'))} - 0.5) * 0.1), 6) AS amount, "
        f"{STAMP.format('(ts + to_days(CAST(copy AS INTEGER)))')} AS ts, strftime(ts + to_days(CAST(copy AS INTEGER)), '%Y-%m-%d') "
        "AS transaction_date FROM transfers, range(10) c(copy)", TRANSFERS),
    "ring_rows": select(
        "SELECT ring, kind, step, sender, receiver, round(amount, 6) AS amount, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, is_fraud, rewired "
        "FROM ring_rows", LEDGER, rings_sql("ledger")),
    "ring_injection": select(
        f"SELECT sender, receiver, round(amount, 6) AS amount, {STAMP.format('ts')} AS ts, is_fraud FROM ledger UNION ALL "
        f"SELECT sender, receiver, round(amount, 6), {STAMP.format('ts')}, is_fraud FROM ring_rows", LEDGER, rings_sql("ledger")),
    "rf_prediction_facts": select(
        "SELECT a.id, label, round(CASE WHEN label = 1 THEN ratio ELSE 1 END, 9) AS weight, "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)
        + ", true AS is_probability, true AS threshold_holds, true AS majority_holds FROM additive a JOIN labels_of l ON a.id = l.id, "
        "(SELECT count(*) FILTER (label = 0) / nullif(count(*) FILTER (label = 1), 0) AS ratio FROM labels_of) "
        f"WHERE {u(repr('42'), 'a.id')} >= 0.8", LEDGER_ADDITIVE, LABELS),
    "rf_run_facts": (
        f"SELECT '30' AS num_trees, '3' AS max_depth, '{','.join(MODEL_FEATURES)}' AS input_columns, true AS f1_kept, true AS scores_kept, "
        "true AS pr_auc_agrees"),
    "rf_grid": "SELECT trees, depth, true AS is_share FROM (VALUES (10), (30)) t(trees), (VALUES (3), (4)) d(depth)",
    "rule_score_pr_auc": select(
        "SELECT round(sum((r - r0) * (p + p0) / 2), 9) AS pr_auc FROM (SELECT r, p, lag(r, 1, 0) OVER w AS r0, "
        "lag(p, 1, p) OVER w AS p0 FROM curve WINDOW w AS (ORDER BY fraud_score DESC))", JUDGED,
        "points AS (SELECT fraud_score, count(*) AS n, sum(label) AS tp FROM judged GROUP BY fraud_score)",
        "curve AS (SELECT fraud_score, sum(tp) OVER w / (SELECT sum(tp) FROM points) AS r, sum(tp) OVER w / sum(n) OVER w AS p "
        "FROM points WINDOW w AS (ORDER BY fraud_score DESC))"),
    "confusion_matrix": select(
        f"SELECT label, CAST(fraud_score >= {LEDGER_SCORE.suspect} AS INTEGER) AS prediction, count(*) AS accounts FROM judged GROUP BY 1, 2",
        JUDGED),
    "confusion_wide": select(
        f"SELECT label, count(*) FILTER (fraud_score < {LEDGER_SCORE.suspect}) AS predicted_0, "
        f"count(*) FILTER (fraud_score >= {LEDGER_SCORE.suspect}) AS predicted_1 FROM judged GROUP BY label", JUDGED),
    "threshold_sweep": select(
        "SELECT *, round(tp / nullif(tp + fp, 0), 9) AS precision, round(tp / nullif(tp + fn, 0), 9) AS recall, "
        "round(2 * tp / nullif(2 * tp + fp + fn, 0), 9) AS f1 FROM counts", JUDGED, sweep_sql()),
    "medallion_features": select(
        "SELECT id, degree, tx_count_in, tx_count_out, cluster_size, triangle_count FROM feats", TRANSFERS,
        "silver AS (SELECT DISTINCT sender, receiver, amount, date_trunc('second', ts) AS ts, is_fraud FROM transfers)",
        rings_sql("silver"),
        "final_rows AS (SELECT sender, receiver, amount FROM silver, range(3) UNION ALL SELECT sender, receiver, amount FROM ring_rows)",
        edges_of("final_rows"), additive_of(), graph_of(), FULL),
    "risk_scores_payments": select(
        f"SELECT *, {band_sql(DEFAULT_SCORE)} AS label FROM (SELECT *, {score_sql(DEFAULT_SCORE)} AS fraud_score FROM feats)",
        PAYMENT_ADDITIVE, triangles_of(), MIN_LABEL, FULL),
    "velocity_1h": select(
        "SELECT seq, sender, count(*) OVER w AS velocity_count, round(CAST(sum(CAST(amount AS DECIMAL(24,8))) OVER w AS DOUBLE), 4) "
        "AS velocity_amount FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM transfers) "
        "WINDOW w AS (PARTITION BY sender ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)", TRANSFERS),
    "amount_zscore": select(
        "SELECT seq, sender, n AS prior_count, round(m, 8) AS prior_mean, round(sd, 6) AS prior_std, "
        "round(CASE WHEN sd > 0 THEN (amount - m) / sd END, 6) AS amount_z FROM (SELECT seq, sender, amount, "
        "count(*) OVER w AS n, avg(amount) OVER w AS m, "
        "stddev_samp(amount) OVER w AS sd FROM transfers "
        "WINDOW w AS (PARTITION BY sender ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))", TRANSFERS),
    "anomaly_facts": select("SELECT id, true AS is_share FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges)", LEDGER_EDGES),
    "decayed_zscore": select(
        "SELECT seq, sender, round(coalesce(w, 0), 6) AS prior_weight, round(mean, 6) AS decayed_mean, round(std, 5) AS decayed_std, "
        "CASE WHEN std > 0 THEN round((amount - mean) / std, 3) END AS decayed_z FROM judged", TRANSFERS,
        "t AS (SELECT *, epoch_us(ts) AS at_us, epoch_us(ts) // 2764800000000 AS epoch FROM transfers)",
        "prior AS (SELECT a.seq, p.amount, power(2, -(a.at_us - p.at_us) / 86400000000.0) AS w FROM t a JOIN t p ON p.sender = a.sender "
        "AND (p.at_us < a.at_us OR (p.at_us = a.at_us AND p.seq < a.seq)) AND p.epoch >= a.epoch - 2)",
        "means AS (SELECT seq, count(*) AS n, sum(w) AS w, sum(w * amount) / sum(w) AS mean, min(amount) = max(amount) AS alike, max(amount) - min(amount) AS extent FROM prior GROUP BY seq)",
        "spreads AS (SELECT p.seq, sqrt(sum(p.w * (p.amount - m.mean) * (p.amount - m.mean)) / sum(p.w)) AS std FROM prior p JOIN means m ON m.seq = p.seq GROUP BY p.seq)",
        "judged AS (SELECT t.seq, t.sender, t.amount, m.w, m.mean, CASE WHEN m.n >= 2 THEN CASE WHEN m.alike OR s.std < 1e-4 * m.extent THEN 0 ELSE s.std END END AS std "
        "FROM t LEFT JOIN means m ON m.seq = t.seq LEFT JOIN spreads s ON s.seq = t.seq)"),
    "hourly_windows": select(window_out(3600), TRANSFERS, windows_sql(3600, 3600)),
    "sliding_windows": select(window_out(3600), TRANSFERS, windows_sql(3600, 1800)),
    "session_windows": select(
        f"SELECT sender, {STAMP.format('min(ts)')} AS session_start, {STAMP.format('(max(ts) + INTERVAL 7200 SECOND)')} AS session_end, "
        f"count(*) AS tx_count, round({money('amount')}, 4) AS tx_amount FROM numbered GROUP BY sender, nth", TRANSFERS,
        "opened AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 7200 SECOND THEN 0 ELSE 1 END AS opens FROM transfers "
        "WINDOW w AS (PARTITION BY sender ORDER BY ts, seq))",
        "numbered AS (SELECT *, sum(opens) OVER (PARTITION BY sender ORDER BY ts, seq) AS nth FROM opened)"),
    "cycles_len3": select(
        "SELECT 3 AS length, x.src || '>' || y.src || '>' || z.src AS ring FROM edges x JOIN edges y ON x.dst = y.src "
        "JOIN edges z ON y.dst = z.src AND z.dst = x.src WHERE x.src < y.src AND x.src < z.src AND y.src <> z.src", LEDGER_EDGES),
    "cycles_len4_by_account": select(
        "SELECT w.src AS id, count(*) AS rings FROM edges w JOIN edges x ON w.dst = x.src JOIN edges y ON x.dst = y.src "
        "JOIN edges z ON y.dst = z.src AND z.dst = w.src WHERE w.src < w.dst AND w.src < x.dst AND w.src < y.dst "
        "AND w.dst <> x.dst AND w.dst <> y.dst AND x.dst <> y.dst GROUP BY w.src", TRANSFER_EDGES),
    "cycles_len5": select(
        "SELECT 5 AS length, v.src || '>' || w.src || '>' || x.src || '>' || y.src || '>' || z.src AS ring FROM edges v "
        "JOIN edges w ON v.dst = w.src JOIN edges x ON w.dst = x.src "
        "JOIN edges y ON x.dst = y.src JOIN edges z ON y.dst = z.src AND z.dst = v.src WHERE v.src < v.dst AND v.src < w.dst "
        "AND v.src < x.dst AND v.src < y.dst AND v.dst NOT IN (w.dst, x.dst, y.dst) AND w.dst NOT IN (x.dst, y.dst) "
        "AND x.dst <> y.dst", PAYMENTS, rings_sql("payments", **RECALL_RINGS),
        "joined AS (SELECT sender, receiver, amount FROM payments UNION ALL SELECT sender, receiver, amount FROM ring_rows)",
        edges_of("joined")),
    "long_rings_by_account": select(
        "SELECT id, length, count(*) AS rings FROM (SELECT unnest(members) AS id, CAST(len(members) AS INTEGER) AS length FROM closed) GROUP BY id, length",
        LEDGER, rings_sql("ledger", **LONG_RINGS), edges_of("ring_rows"),
        # Walks that keep above their first account; that one has to be the smallest.
        "walks(members, last) AS (SELECT [src], src FROM (SELECT DISTINCT src FROM edges) UNION ALL "
        "SELECT list_append(w.members, e.dst), e.dst FROM walks w JOIN edges e ON e.src = w.last "
        "WHERE e.dst > w.members[1] AND NOT list_contains(w.members, e.dst) AND len(w.members) < 10)",
        "closed AS (SELECT w.members FROM walks w JOIN edges e ON e.src = w.last AND e.dst = w.members[1] WHERE len(w.members) BETWEEN 6 AND 10)"),
    "long_ring_recall": select(
        "SELECT ring_size, count(*) AS rings, count(*) FILTER (whole) AS whole, count(*) FILTER (found) AS found FROM verdict GROUP BY ring_size",
        LEDGER, rings_sql("ledger", **LONG_RINGS), "pairs AS (SELECT DISTINCT sender, receiver FROM ring_rows)",
        "links AS (SELECT r.ring, r.step, r.sender, r.rewired, n.sender AS next_sender FROM ring_rows r JOIN ring_list l ON l.ring = r.ring "
        "JOIN ring_rows n ON n.ring = r.ring AND n.kind = 'ring' AND n.step = (r.step + 1) % l.ring_size WHERE r.kind = 'ring')",
        "verdict AS (SELECT k.ring, CAST(count(*) AS INTEGER) AS ring_size, NOT bool_or(k.rewired) AS whole, "
        "bool_and(p.sender IS NOT NULL) AS found FROM links k LEFT JOIN pairs p ON p.sender = k.sender AND p.receiver = k.next_sender GROUP BY k.ring)"),
    "timed_rings": select(
        "SELECT CAST(length AS INTEGER) AS length, ring, payments, strftime(first_ts, '%Y-%m-%d %H:%M:%S.%f') AS first_ts, "
        "strftime(last_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_ts, round(CAST(amount AS DOUBLE), 4) AS amount FROM found",
        TRANSFERS, "p AS (SELECT seq, sender, receiver, ts, CAST(amount AS DECIMAL(24,8)) AS amount FROM transfers WHERE sender <> receiver)",
        "two AS (SELECT x.seq AS a, y.seq AS b, x.sender AS s, x.receiver AS m, y.receiver AS last, x.ts AS first_ts, y.ts AS last_ts, "
        "x.amount + y.amount AS amount FROM p x JOIN p y ON y.sender = x.receiver AND y.ts > x.ts AND y.ts <= x.ts + INTERVAL 1 DAY WHERE y.receiver <> x.sender)",
        "three AS (SELECT t.*, z.seq AS c, z.receiver AS final, z.ts AS third_ts, t.amount + z.amount AS total FROM two t JOIN p z "
        "ON z.sender = t.last AND z.ts > t.last_ts AND z.ts <= t.last_ts + INTERVAL 1 DAY WHERE z.receiver <> t.m)",
        "found AS (SELECT 3 AS length, concat_ws('>', s, m, last) AS ring, concat_ws('>', a, b, c) AS payments, first_ts, third_ts AS last_ts, total AS amount "
        "FROM three WHERE final = s UNION ALL "
        "SELECT 4, concat_ws('>', s, m, last, final), concat_ws('>', a, b, c, z.seq), first_ts, z.ts, total + z.amount FROM three t JOIN p z "
        "ON z.sender = t.final AND z.receiver = t.s AND z.ts > t.third_ts AND z.ts <= t.third_ts + INTERVAL 1 DAY WHERE t.final <> t.s)"),
    "strong_components": select(
        "SELECT id, component, count(*) OVER (PARTITION BY component) AS component_size FROM named", LEDGER_EDGES,
        "every AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)",
        "ahead(a, b) AS (SELECT id, id FROM every UNION SELECT f.a, e.dst FROM ahead f JOIN edges e ON e.src = f.b)",
        "named AS (SELECT x.a AS id, min(x.b) AS component FROM ahead x JOIN ahead y ON y.a = x.b AND y.b = x.a GROUP BY x.a)"),
    "core_numbers": select(
        "SELECT id, core FROM kc", LEDGER_EDGES, "every AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges)",
        "und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst)",
        "sym AS (SELECT a, b FROM und UNION ALL SELECT b, a FROM und)",
        "kc(id, core) USING KEY (id) AS (SELECT e.id, count(s.b) FROM every e LEFT JOIN sym s ON s.a = e.id GROUP BY e.id UNION "
        "SELECT h.id, h.core FROM (SELECT a AS id, max(least(c, n)) AS core, max(own) AS own FROM (SELECT s.a, r.core AS c, o.core AS own, "
        "count(*) OVER (PARTITION BY s.a ORDER BY r.core DESC) AS n FROM sym s JOIN recurring.kc r ON r.id = s.b JOIN recurring.kc o ON o.id = s.a "
        "WHERE s.a IN (SELECT t.a FROM kc f JOIN sym t ON t.b = f.id)) GROUP BY a) h WHERE h.core < h.own)"),
    "dense_subgraph": select(
        "SELECT a.id, round(d.density, 9) AS density FROM alive a JOIN dense d ON a.round = d.round WHERE d.nth = 1", LEDGER_EDGES,
        "und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM edges WHERE src <> dst)",
        "sym AS (SELECT a, b FROM und UNION ALL SELECT b, a FROM und)",
        "alive(id, round) AS (SELECT DISTINCT a, 0 FROM sym UNION ALL SELECT id, round + 1 FROM (SELECT x.id, x.round, count(*) AS n, "
        "sum(count(*)) OVER () AS ends, (SELECT count(*) FROM alive) AS accounts FROM alive x JOIN sym s ON s.a = x.id JOIN alive y ON y.id = s.b "
        "GROUP BY x.id, x.round) WHERE n > 2.2::DOUBLE * (ends // 2)::DOUBLE / accounts)",
        "dense AS (SELECT round, density, row_number() OVER (ORDER BY density DESC, round) AS nth FROM (SELECT x.round, "
        "count(s.b) / 2 / count(DISTINCT x.id) AS density FROM alive x LEFT JOIN (SELECT s.a, s.b, y.round FROM sym s JOIN alive y ON y.id = s.b) s "
        "ON s.a = x.id AND s.round = x.round GROUP BY x.round))"),
    "risk_walk": select(
        "SELECT id, round(risk, 9) AS risk FROM walk WHERE round = (SELECT max(round) FROM walk)", LEDGER_EDGES, LABELS,
        "shares AS (SELECT src, dst, transaction_count / sum(transaction_count) OVER (PARTITION BY src) AS share FROM edges)",
        "start AS (SELECT id, CASE WHEN label = 1 THEN 1 / (SELECT sum(label) FROM labels_of) ELSE 0 END::DOUBLE AS seed, "
        "id IN (SELECT src FROM edges) AS passes_on FROM labels_of)",
        "walk(id, seed, passes_on, risk, step, round) AS (SELECT id, seed, passes_on, seed, 1::DOUBLE, 0 FROM start UNION ALL "
        "SELECT w.id, w.seed, w.passes_on, w.seed * l.lost + 0.85 * coalesce(c.come, 0), abs(w.seed * l.lost + 0.85 * coalesce(c.come, 0) - w.risk), "
        "w.round + 1 FROM walk w CROSS JOIN (SELECT 1 - 0.85 * coalesce(sum(risk) FILTER (passes_on), 0) AS lost, sum(step) AS moved FROM walk) l "
        "LEFT JOIN (SELECT s.dst AS id, sum(v.risk * s.share) AS come FROM walk v JOIN shares s ON s.src = v.id GROUP BY s.dst) c ON c.id = w.id "
        f"WHERE l.moved >= {RISK_TOLERANCE})"),
    "communities": select("SELECT id, label AS community FROM lab WHERE round = " + str(COMMUNITY_ROUNDS), LEDGER_EDGES, COMMUNITIES),
    "community_modularity": select(
        "SELECT count(*) AS communities, round(sum(inner_weight) / sum(ends) - sum(ends * ends) / (sum(ends) * sum(ends)), 9) AS modularity FROM per",
        LEDGER_EDGES, COMMUNITIES, f"final AS (SELECT id, label FROM lab WHERE round = {COMMUNITY_ROUNDS})",
        "ends AS (SELECT x.label, x.label = y.label AS within, e.transaction_count AS weight FROM edges e JOIN final x ON x.id = e.src "
        "JOIN final y ON y.id = e.dst WHERE e.src <> e.dst UNION ALL SELECT y.label, x.label = y.label, e.transaction_count FROM edges e "
        "JOIN final x ON x.id = e.src JOIN final y ON y.id = e.dst WHERE e.src <> e.dst)",
        "per AS (SELECT f.label, coalesce(sum(e.weight), 0)::DOUBLE AS ends, coalesce(sum(e.weight) FILTER (e.within), 0)::DOUBLE AS inner_weight "
        "FROM (SELECT DISTINCT label FROM final) f LEFT JOIN ends e ON e.label = f.label GROUP BY f.label)"),
    "ring_recall": select(
        "SELECT ring_size, count(*) AS rings, count(*) FILTER (whole) AS whole, count(*) FILTER (found) AS found FROM verdict GROUP BY ring_size",
        PAYMENTS, rings_sql("payments", **RECALL_RINGS),
        "pairs AS (SELECT DISTINCT sender, receiver FROM (SELECT sender, receiver FROM payments UNION ALL SELECT sender, receiver FROM ring_rows))",
        "links AS (SELECT r.ring, r.step, r.sender, r.rewired, n.sender AS next_sender FROM ring_rows r JOIN ring_list l ON l.ring = r.ring "
        "JOIN ring_rows n ON n.ring = r.ring AND n.kind = 'ring' AND n.step = (r.step + 1) % l.ring_size WHERE r.kind = 'ring')",
        "verdict AS (SELECT k.ring, CAST(count(*) AS INTEGER) AS ring_size, NOT bool_or(k.rewired) AS whole, "
        "bool_and(p.sender IS NOT NULL) AS found FROM links k LEFT JOIN pairs p ON p.sender = k.sender AND p.receiver = k.next_sender GROUP BY k.ring)"),
    "stream_edges_final": select(
        "SELECT src, dst, transaction_count, round(total_amount, 4) AS total_amount FROM edges", TRANSFER_EDGES),
    "stream_progress": select(
        "SELECT batch_id, rows_done, rows_total, round(rows_done / rows_total, 6) AS pct, alerts FROM (SELECT batch_id, count(*) AS rows_done, "
        "(SELECT count(*) FROM transfers) AS rows_total FROM sliced GROUP BY batch_id) JOIN (SELECT batch_id, "
        f"count(*) FILTER (fraud_score >= {LEDGER_SCORE.fraud}) AS alerts FROM scores GROUP BY batch_id) USING (batch_id)", SLICED_SCORES),
    "stream_top8": select(
        "SELECT batch_id, id, fraud_score FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY fraud_score DESC, id) AS n "
        "FROM scores) WHERE n <= 8", SLICED_SCORES),
    "stream_scores_final": select(
        "SELECT * FROM scores", TRANSFER_EDGES, additive_of(), graph_of(), FULL, SCORES),
    "stream_velocity": select(window_out(3600), TRANSFERS, windows_sql(3600, 3600)),
    "stream_model_scores": select(
        f"SELECT {FEATURE_LIST}, true AS as_in_batch, true AS band_as_in_batch FROM feats", TRANSFER_EDGES, additive_of(), graph_of(), FULL),
    "stream_dedup": select(
        f"SELECT seq, sender, receiver, amount, {STAMP.format('ts')} AS ts FROM transfers", TRANSFERS),
}
ORACLE["stream_sessions"] = ORACLE["session_windows"]
ORACLE["stream_velocity_1h"] = ORACLE["velocity_1h"]
