"""Independent DuckDB SQL for each catalogue query (the correctness oracle).

Written by hand against the raw driver tables. A SQL text has a fixed width, so the
event types of each table are spelled out. Doubles are rounded to 6 decimals.
"""

from __future__ import annotations

# Event types of the clickstream table after renaming, in lexical order.
TYPES_A = ["BUY", "CART", "ERROR", "SIGNUP", "VIEW"]
# Event types of the order-line table (return flags renamed).
TYPES_B = ["BUY", "CART", "VIEW"]

EV = """ev AS (
  SELECT event_id AS row_no, user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS user_session,
         CASE lower(event_type) WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'CART'
              WHEN 'purchase' THEN 'BUY' ELSE upper(event_type) END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
         ts AS event_time,
         CASE WHEN ts < TIMESTAMP '2024-01-25 00:00:00' THEN 'train' ELSE 'test' END AS split,
         value
  FROM events)"""

EV_B = """ev AS (
  SELECT {'a': l_shipdate, 'b': l_linenumber, 'c': l_partkey, 'd': l_suppkey, 'e': l_extendedprice,
          'f': l_quantity, 'g': l_discount, 'h': l_tax, 'i': l_returnflag, 'j': l_linestatus} AS row_no,
         o_custkey AS user_id, CAST(l_orderkey AS VARCHAR) AS user_session,
         CASE l_returnflag WHEN 'N' THEN 'VIEW' WHEN 'R' THEN 'CART' WHEN 'A' THEN 'BUY' END AS event_type,
         l_partkey AS product_id, p_brand AS category_id, l_shipdate AS event_time,
         CASE WHEN o_orderdate < TIMESTAMP '2000-01-01 00:00:00' THEN 'train' ELSE 'test' END AS split
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

LABELED = """sv AS (
  SELECT user_session, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS session_value
  FROM ev WHERE split = 'train' GROUP BY user_session),
labeled AS (
  SELECT e.row_no, e.user_id, e.user_session, e.event_type, e.product_id, e.category_id,
         e.event_time, e.split, sv.session_value
  FROM ev e LEFT JOIN sv USING (user_session) WHERE e.split = 'train')"""

LAB_A = """lab_a AS (
  SELECT user_session, arg_min(user_id, row_no) AS user_id, arg_min(session_value, row_no) AS session_value
  FROM labeled
  WHERE user_session IS NOT NULL AND user_id IS NOT NULL AND session_value IS NOT NULL
  GROUP BY user_session)"""

LAB_B = """lab_b AS (
  SELECT user_id, user_session, arg_min({'v': session_value}, row_no).v AS session_value
  FROM labeled GROUP BY user_id, user_session)"""

ORD = "{'tn': event_time IS NULL, 't': event_time, 'r': row_no}"


def _v2_ctes(types, codes=None) -> str:
    """``codes``: the code domain where it has more names than there are counted types."""
    counts = ",\n    ".join(
        f"CAST(count(*) FILTER (WHERE event_type = '{t}') AS BIGINT) AS event_type_count_{t}" for t in types)
    ratios = ",\n  ".join(
        f"round(event_type_count_{t} / nullif(session_event_count, 0), 6) AS event_type_ratio_{t}"
        for t in types)
    entropy = " + ".join(
        f"CASE WHEN event_type_count_{t} > 0 THEN -(event_type_count_{t} / session_event_count) "
        f"* ln(event_type_count_{t} / session_event_count) ELSE 0 END" for t in types)
    code = "CASE {x} " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(codes or types)) + " ELSE -1 END"

    def c(t):
        return f"event_type_count_{t}" if t in types else "0"
    return f"""
base AS (
  SELECT user_session,
    arg_min(user_id, {ORD}) FILTER (WHERE user_id IS NOT NULL) AS user_id,
    CAST(count(*) AS BIGINT) AS session_event_count,
    CAST(count(DISTINCT product_id) AS BIGINT) AS unique_product_count,
    CAST(count(DISTINCT category_id) AS BIGINT) AS unique_category_count,
    {counts},
    arg_min(coalesce(event_type, 'nan'), {ORD}) AS first_t,
    arg_max(coalesce(event_type, 'nan'), {ORD}) AS last_t,
    min(event_time) AS tmin, max(event_time) AS tmax
  FROM ev WHERE user_session IS NOT NULL GROUP BY user_session),
prep AS (
  SELECT user_session, max(n) AS m FROM (
    SELECT user_session, product_id, count(*) AS n FROM ev
    WHERE user_session IS NOT NULL AND product_id IS NOT NULL GROUP BY user_session, product_id)
  GROUP BY user_session),
crep AS (
  SELECT user_session, max(n) AS m FROM (
    SELECT user_session, category_id, count(*) AS n FROM ev
    WHERE user_session IS NOT NULL AND category_id IS NOT NULL GROUP BY user_session, category_id)
  GROUP BY user_session),
fj AS (
  SELECT b.*, CAST(coalesce(p.m, 0) AS BIGINT) AS product_repeat_max,
         CAST(coalesce(c.m, 0) AS BIGINT) AS category_repeat_max,
         coalesce(date_diff('microsecond', tmin, tmax) / 1e6, 0.0) AS dur
  FROM base b LEFT JOIN prep p USING (user_session) LEFT JOIN crep c USING (user_session)),
feat AS (
SELECT user_session, coalesce(user_id, 0) AS user_id, session_event_count, unique_product_count, unique_category_count,
  {", ".join(f"event_type_count_{t}" for t in types)},
  {ratios},
  CAST({c('BUY')} > 0 AS BIGINT) AS is_buyer,
  round(unique_product_count / session_event_count, 6) AS unique_product_ratio,
  round(unique_category_count / session_event_count, 6) AS unique_category_ratio,
  round(1.0 - least(greatest(unique_product_count / session_event_count, 0.0), 1.0), 6) AS revisit_ratio,
  product_repeat_max, category_repeat_max,
  round(product_repeat_max / session_event_count, 6) AS product_repeat_max_ratio,
  round(category_repeat_max / session_event_count, 6) AS category_repeat_max_ratio,
  round({entropy}, 6) AS event_type_entropy,
  round({c('BUY')} / CASE WHEN {c('VIEW')} <= 0 THEN 1 ELSE {c('VIEW')} END, 6) AS buy_to_view_ratio,
  round({c('CART')} / CASE WHEN {c('VIEW')} <= 0 THEN 1 ELSE {c('VIEW')} END, 6) AS cart_to_view_ratio,
  round({c('BUY')} / CASE WHEN {c('CART')} <= 0 THEN 1 ELSE {c('CART')} END, 6) AS buy_to_cart_ratio,
  CAST({code.format(x="first_t")} AS BIGINT) AS first_event_type_code,
  CAST({code.format(x="last_t")} AS BIGINT) AS last_event_type_code,
  round(dur, 6) AS session_duration_seconds,
  round(session_event_count / CASE WHEN dur <= 0 THEN 60.0 ELSE dur / 60.0 END, 6) AS events_per_minute
FROM fj)"""


FEAT = _v2_ctes(TYPES_A)

SPLITS = """sp AS (
  SELECT user_session, bool_or(split = 'train') AS in_train, bool_or(split = 'test') AS in_test
  FROM ev WHERE user_session IS NOT NULL GROUP BY user_session),
ftr AS (SELECT feat.* FROM feat JOIN sp USING (user_session) WHERE in_train),
fte AS (SELECT feat.* FROM feat JOIN sp USING (user_session) WHERE in_test)"""


def _lnn(name: str, split: str) -> str:
    return f"""{name} AS (
  SELECT user_session,
    arg_max(product_id, {ORD}) FILTER (WHERE product_id IS NOT NULL) AS last_product_id,
    arg_max(category_id, {ORD}) FILTER (WHERE category_id IS NOT NULL) AS last_category_id
  FROM ev WHERE split = '{split}' AND user_session IS NOT NULL GROUP BY user_session)"""


def _lrow(name: str, split: str) -> str:
    return f"""{name} AS (
  SELECT user_id, user_session,
    coalesce(arg_max({{'p': product_id, 'c': category_id}}, {ORD}).p, -1) AS last_product_id,
    coalesce(arg_max({{'p': product_id, 'c': category_id}}, {ORD}).c, -1) AS last_category_id
  FROM ev WHERE split = '{split}' AND user_id IS NOT NULL AND user_session IS NOT NULL
  GROUP BY user_id, user_session)"""


def _hash(col: str, seed: int) -> str:
    return f"('0x' || substr(md5(coalesce(CAST({col} AS VARCHAR), '<null>') || '|{seed}'), 1, 15))::BIGINT"


def _group_folds(name: str, src: str, k: int = 5, seed: int = 42) -> str:
    return f"""{name} AS (
  SELECT g, CAST(ntile({k}) OVER (ORDER BY h, g) AS BIGINT) AS fold
  FROM (SELECT g, {_hash('g', seed)} AS h FROM (SELECT DISTINCT user_id AS g FROM {src})))"""


FRAME_UK = f"""{_lrow('lrow', 'train')},
frame_uk AS (
  SELECT b.user_id, b.user_session, b.session_value, ftr.* EXCLUDE (user_session, user_id),
         coalesce(r.last_product_id, -1) AS last_product_id,
         coalesce(r.last_category_id, -1) AS last_category_id
  FROM lab_b b
  LEFT JOIN ftr ON ftr.user_session = b.user_session AND ftr.user_id = b.user_id
  LEFT JOIN lrow r ON r.user_session = b.user_session AND r.user_id = b.user_id)"""

TEST_UK = f"""{_lrow('lrow_te', 'test')},
test_uk AS (
  SELECT fte.*, coalesce(r.last_product_id, -1) AS last_product_id,
         coalesce(r.last_category_id, -1) AS last_category_id
  FROM fte LEFT JOIN lrow_te r ON r.user_session = fte.user_session AND r.user_id = fte.user_id)"""

# Missing values and odd sessions made from the events by their number: see catalog._edge_source.
EDGE = """ev AS (
  SELECT row_no,
         CASE WHEN row_no % 17 = 1 THEN NULL WHEN row_no % 23 = 6 THEN user_id + 1 ELSE user_id END AS user_id,
         CASE WHEN row_no % 97 <> 0 THEN user_session END AS user_session,
         CASE WHEN row_no % 97 = 0 AND row_no % 2 = 0 THEN 'PROMO' WHEN row_no % 11 <> 3 THEN event_type END AS event_type,
         CASE WHEN row_no % 7 <> 2 THEN product_id END AS product_id,
         CASE WHEN row_no % 19 <> 4 THEN category_id END AS category_id,
         CASE WHEN row_no % 13 <> 5 THEN event_time END AS event_time,
         CASE WHEN row_no % 29 <> 0 THEN split WHEN split = 'train' THEN 'test' ELSE 'train' END AS split
  FROM ev0),
labeled AS (
  SELECT *, CASE WHEN row_no % 5 <> 1 THEN (row_no % 1000) / 100 END AS session_value FROM ev WHERE split = 'train')"""
EDGE_CODES = ["BUY", "CART", "ERROR", "PROMO", "SIGNUP", "VIEW", "nan"]
EDGE_PRELUDE = (f"WITH {EV.replace('ev AS', 'ev0 AS')},\n{EDGE},\n{LAB_A},\n{LAB_B},\n"
                f"{_v2_ctes(TYPES_A, EDGE_CODES)},\n{SPLITS}")
EDGE_OF = ("session_features_v1", "session_features_v2", "event_type_codes", "session_repeats",
           "labels_first_per_session", "labels_first_per_user_session", "last_items_nonnull", "last_items_row",
           "features_train", "features_test", "training_frame_user_session_key", "user_backoff_raw",
           "item_encoding_raw")

PRELUDE = f"WITH {EV},\n{LABELED},\n{LAB_A},\n{LAB_B},\n{FEAT},\n{SPLITS}"


def _q(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"{PRELUDE}{extra}\n{body}"


USER_MEAN_RAW = """um AS (SELECT user_id, round(avg(CAST(session_value AS DECIMAL(18,2))), 6) AS m FROM lab_a GROUP BY user_id),
ga AS (SELECT round(avg(CAST(session_value AS DECIMAL(18,2))), 6) AS g FROM lab_a)"""

ITEM_RAW = f"""{_lnn('lnn', 'train')},
{_lnn('lnn_te', 'test')},
fr_sk AS (SELECT l.*, n.last_product_id, n.last_category_id FROM lab_a l LEFT JOIN lnn n USING (user_session)),
pm AS (SELECT last_product_id, round(avg(CAST(session_value AS DECIMAL(18,2))), 6) AS m
       FROM fr_sk WHERE last_product_id IS NOT NULL GROUP BY 1),
cm AS (SELECT last_category_id, round(avg(CAST(session_value AS DECIMAL(18,2))), 6) AS m
       FROM fr_sk WHERE last_category_id IS NOT NULL GROUP BY 1),
te_sk AS (SELECT fte.user_session, n.last_product_id, n.last_category_id FROM fte LEFT JOIN lnn_te n USING (user_session))"""

LOG_FRAME = """fr_log AS (SELECT *, CASE WHEN session_value > -1 THEN ln(1 + session_value) END AS y FROM frame_uk)"""


def _standin(seeds) -> list[str]:
    """CTEs scoring each row with its last product's fold encoding, per seed."""
    ctes = [FRAME_UK, TEST_UK, LOG_FRAME, "fl AS (SELECT range AS f FROM range(1, 6))"]
    parts = []
    for s in seeds:
        ctes += [
            _group_folds(f"gf{s}", "lab_b", 5, s),
            f"trf{s} AS (SELECT f.*, g.fold FROM fr_log f JOIN gf{s} g ON f.user_id = g.g)",
            f"pe{s} AS (SELECT fl.f, t.last_product_id, avg(t.y) AS m FROM trf{s} t, fl "
            f"WHERE t.fold <> fl.f AND t.y IS NOT NULL GROUP BY ALL)",
            f"gd{s} AS (SELECT fl.f, avg(t.y) AS m FROM trf{s} t, fl WHERE t.fold <> fl.f AND t.y IS NOT NULL "
            f"GROUP BY ALL)",
            f"""sc{s} AS (
  SELECT t.user_id, t.user_session, {s} AS seed, fl.f AS fold,
         CASE WHEN t.fold = fl.f THEN 'val' ELSE 'fit' END AS role, t.y, coalesce(pe.m, gd.m) AS pred
  FROM trf{s} t CROSS JOIN fl
  LEFT JOIN pe{s} pe ON pe.f = fl.f AND pe.last_product_id = t.last_product_id
  LEFT JOIN gd{s} gd ON gd.f = fl.f
  UNION ALL
  SELECT t.user_id, t.user_session, {s}, fl.f, 'test', NULL, coalesce(pe.m, gd.m)
  FROM test_uk t CROSS JOIN fl
  LEFT JOIN pe{s} pe ON pe.f = fl.f AND pe.last_product_id = t.last_product_id
  LEFT JOIN gd{s} gd ON gd.f = fl.f)"""]
        parts.append(f"SELECT * FROM sc{s}")
    ctes.append("scores AS (" + " UNION ALL ".join(parts) + ")")
    return ctes


def _first_tree(frame: str) -> str:
    """Every cut of every node of three levels, with its gain; then the greatest open gain five times."""
    def worth(g, n):
        t = f"(sign({g}) * greatest(abs({g}) - 40.0::DOUBLE, 0.0::DOUBLE))"
        return f"(CASE WHEN {n} > 0 THEN {t} * {t} / ({n} + 1.2::DOUBLE) ELSE 0.0::DOUBLE END)"
    ctes = [f"fr AS MATERIALIZED ({frame})", """
gbase AS (SELECT CAST(sum(CAST(session_value * 100 AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * count(*)) AS base, count(*) AS n,
         greatest(max(session_value) - min(session_value), 1e-9::DOUBLE) AS reach FROM fr),
gscale AS (SELECT base, pow(2.0::DOUBLE, least(40, floor(52 - log2(2.0::DOUBLE * n * greatest(reach, reach * reach, 1.0::DOUBLE))))) AS s FROM gbase),
grad AS MATERIALIZED (SELECT user_session, CAST((base - session_value) * s AS BIGINT) AS g, s FROM fr, gscale),
flat AS MATERIALIZED (
  UNPIVOT (SELECT user_session, COLUMNS(* EXCLUDE (user_session, user_id, session_value, last_product_id, last_category_id))::DOUBLE FROM fr)
  ON COLUMNS(* EXCLUDE (user_session)) INTO NAME feature VALUE x),
ranked AS (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) - 1 AS r, count(*) OVER (PARTITION BY feature) AS n FROM flat),
glevel AS (SELECT DISTINCT feature, x FROM ranked, range(0, 64) AS t(i) WHERE r = floor((n - 1) * (i / 63.0::DOUBLE))),
edge AS MATERIALIZED (SELECT feature, x AS e FROM glevel QUALIFY x < max(x) OVER (PARTITION BY feature)),
a0 AS (SELECT user_session, 1 AS node FROM fr)"""]
    for d in range(3):
        ctes.append(f"""
t{d} AS MATERIALIZED (SELECT node, sum(g) AS g, count(*) AS n FROM a{d} JOIN grad USING (user_session) GROUP BY node),
h{d} AS MATERIALIZED (SELECT node, feature, x, sum(g) AS g, count(*) AS n FROM a{d} JOIN grad USING (user_session) JOIN flat USING (user_session) GROUP BY ALL),
c{d} AS (SELECT node, feature, e, sum(h.g) AS g, sum(h.n) AS n FROM h{d} h JOIN edge USING (feature) WHERE x <= e GROUP BY ALL),
w{d} AS (SELECT node, feature, e, {worth("c.g / s", "c.n")} + {worth("(t.g - c.g) / s", "(t.n - c.n)")} - {worth("t.g / s", "t.n")} AS gain
         FROM c{d} c JOIN t{d} t USING (node), gscale WHERE c.n >= 6 AND t.n - c.n >= 6),
b{d} AS MATERIALIZED (SELECT * FROM w{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, e) = 1),
a{d + 1} AS MATERIALIZED (SELECT a.user_session, 2 * node + CAST(x > e AS INT) AS node FROM a{d} a JOIN b{d} b USING (node)
         JOIN flat f ON f.user_session = a.user_session AND f.feature = b.feature)""")
    ctes.append("""
t3 AS (SELECT node, sum(g) AS g, count(*) AS n FROM a3 JOIN grad USING (user_session) GROUP BY node),
gbest AS MATERIALIZED (SELECT * FROM b0 UNION ALL SELECT * FROM b1 UNION ALL SELECT * FROM b2),
gtotal AS MATERIALIZED (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3),
p0 AS (SELECT CAST(NULL AS INT) AS node WHERE false)""")
    for i in range(5):
        ctes.append(f"""p{i + 1} AS MATERIALIZED (SELECT node FROM p{i} UNION ALL (SELECT node FROM gbest
         WHERE (node = 1 OR node // 2 IN (SELECT node FROM p{i})) AND node NOT IN (SELECT node FROM p{i}) ORDER BY gain DESC LIMIT 1))""")
    return ",\n".join(ctes) + """
SELECT CAST(node AS BIGINT) AS node, feature, round(e, 6) AS threshold, CAST(NULL AS DOUBLE) AS value FROM gbest WHERE node IN (SELECT node FROM p5)
UNION ALL
SELECT CAST(node AS BIGINT), NULL, NULL, round(-(sign(g / s) * greatest(abs(g / s) - 40.0::DOUBLE, 0.0::DOUBLE)) / (n + 1.2::DOUBLE), 6)
FROM gtotal, gscale WHERE node NOT IN (SELECT node FROM p5) AND (node = 1 OR node // 2 IN (SELECT node FROM p5))"""


def _spark_round(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` to round HALF_UP on the shortest decimal form of the
    double, which is how Spark rounds doubles; DuckDB's own double rounding can land on
    the other side of an exact tie."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k, comma = 1, j + len(key), None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        inner, digits = sql[j + len(key):comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(CAST({_spark_round(inner)} AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)")
        i = k


def oracle_sql() -> dict[str, str]:
    return {k: _spark_round(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["events_union_split"] = _q("""
SELECT split, user_session, CAST(count(*) AS BIGINT) AS n_events, CAST(count(session_value) AS BIGINT) AS n_labeled
FROM (SELECT split, user_session, session_value FROM labeled
      UNION ALL SELECT split, user_session, NULL FROM ev WHERE split = 'test')
WHERE user_session IS NOT NULL GROUP BY split, user_session""")
    q["scan_csv_roundtrip"] = _q("""
SELECT row_no AS event_id, user_id, user_session, event_type, product_id, category_id, event_time,
       round(session_value, 6) AS session_value FROM labeled""")
    q["last_items_row_text_time"] = _q("SELECT * FROM lrow", _lrow("lrow", "train").replace(
        "event_time", "strftime(event_time, '%d/%m/%Y %H:%M:%S.%f')"))
    q["scan_csv_dirty"] = """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'a "quoted" ' || event_type WHEN 1 THEN 'x,y ' || event_type
  WHEN 2 THEN ' ' || event_type WHEN 4 THEN ' NA ' WHEN 7 THEN '"' END AS cell FROM events"""
    q["scan_csv_multiline"] = """
SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_no, event_id, CASE event_id % 8 WHEN 0 THEN 'two' || chr(10) || 'lines '
  WHEN 1 THEN 'crlf' || chr(13) || chr(10) || 'in it ' WHEN 2 THEN 'says "' || chr(10) || '" ' WHEN 3 THEN ',' || chr(10) || ','
  WHEN 4 THEN chr(10) || chr(10) WHEN 5 THEN 'plain ' WHEN 6 THEN '""' ELSE chr(13) END || event_type AS cell,
  CASE WHEN event_id % 8 <> 5 THEN CAST(user_id AS DOUBLE) END AS maybe_id FROM events"""
    q["csv_inferred_types"] = """
SELECT * FROM (VALUES ('whole', 'bigint'), ('leading_zeros', 'bigint'), ('missing_some', 'double'), ('mixed', 'string'), ('fraction', 'double'),
  ('exponent', 'double'), ('truth', 'boolean'), ('truth_missing', 'string'), ('nothing', 'double'), ('unsigned', 'decimal(20,0)'), ('huge', 'string'),
  ('time', 'string'), ('text', 'string'), ('infinite', 'double')) AS t(name, type)"""
    q["csv_bad_times"] = _q("""
SELECT split, row_number() OVER (PARTITION BY split ORDER BY row_no) - 1 AS row_no, user_id, user_session, product_id,
       CASE WHEN row_no % 7 > 1 THEN event_time END AS event_time FROM ev""")
    q["session_features_v1"] = _q("""
SELECT user_session, user_id, session_event_count, unique_product_count, unique_category_count,
  """ + ", ".join(f"event_type_count_{t}, event_type_ratio_{t}" for t in TYPES_A) + """
FROM v1""", """v1b AS (
  SELECT user_session, coalesce(arg_min(user_id, row_no) FILTER (WHERE user_id IS NOT NULL), 0) AS user_id,
    CAST(count(*) AS BIGINT) AS session_event_count,
    CAST(count(DISTINCT product_id) AS BIGINT) AS unique_product_count,
    CAST(count(DISTINCT category_id) AS BIGINT) AS unique_category_count,
    bool_or(split = 'train') AS in_train, bool_or(split = 'test') AS in_test,
    """ + ",\n    ".join(f"CAST(count(*) FILTER (WHERE event_type = '{t}') AS BIGINT) AS event_type_count_{t}"
                       for t in TYPES_A) + """
  FROM ev WHERE user_session IS NOT NULL GROUP BY user_session),
v1 AS (SELECT *, """ + ", ".join(f"round(event_type_count_{t} / session_event_count, 6) AS event_type_ratio_{t}"
                                for t in TYPES_A) + " FROM v1b)")
    q["feature_parquet_roundtrip"] = q["session_features_v1"].replace(
        "\nFROM v1", ", 'train' AS split FROM v1 WHERE in_train UNION ALL SELECT user_session, user_id, "
        "session_event_count, unique_product_count, unique_category_count, "
        + ", ".join(f"event_type_count_{t}, event_type_ratio_{t}" for t in TYPES_A)
        + ", 'test' AS split FROM v1 WHERE in_test")
    q["streaming_session_features_v1"] = q["session_features_v1"]
    q["feature_csv_versions"] = q["feature_parquet_roundtrip"]
    q["session_features_v2"] = _q("SELECT * FROM feat")
    q["session_features_v2_orders"] = f"WITH {EV_B},{_v2_ctes(TYPES_B)}\nSELECT * FROM feat"
    q["labels_first_per_user_session_orders"] = f"""WITH {EV_B}
SELECT user_id, user_session, round(arg_min(o_totalprice, row_no), 6) AS session_value
FROM (SELECT e.*, o.o_totalprice FROM ev e JOIN orders o ON e.user_session = CAST(o.o_orderkey AS VARCHAR))
WHERE split = 'train' GROUP BY user_id, user_session"""
    q["last_items_row_orders"] = f"""WITH {EV_B}
SELECT user_id, user_session,
       coalesce(arg_max({{'p': product_id, 'c': category_id}}, {ORD}).p, -1) AS last_product_id,
       coalesce(arg_max({{'p': product_id, 'c': category_id}}, {ORD}).c, '-1') AS last_category_id
FROM ev WHERE split = 'train' AND user_id IS NOT NULL AND user_session IS NOT NULL
GROUP BY user_id, user_session"""
    q["event_type_codes"] = _q("""
SELECT event_type, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS BIGINT) AS code
FROM (SELECT DISTINCT coalesce(event_type, 'nan') AS event_type FROM ev)""")
    q["session_repeats"] = _q("""
SELECT b.user_session, unique_product_count, unique_category_count, product_repeat_max, category_repeat_max
FROM fj b""")
    q["session_first_last"] = _q("SELECT user_session, first_event_type_code, last_event_type_code FROM feat")
    q["session_time"] = _q("SELECT user_session, session_duration_seconds, events_per_minute FROM feat")
    q["event_entropy"] = _q("SELECT user_session, event_type_entropy FROM feat")
    q["features_train"] = _q("SELECT * FROM ftr")
    q["features_test"] = _q("SELECT * FROM fte")
    q["labels_first_per_session"] = _q(
        "SELECT user_session, user_id, round(session_value, 6) AS session_value FROM lab_a")
    q["labels_first_per_user_session"] = _q(
        "SELECT user_id, user_session, round(session_value, 6) AS session_value FROM lab_b")
    q["last_items_nonnull"] = _q("SELECT * FROM lnn", _lnn("lnn", "train"))
    q["last_items_row"] = _q("SELECT * FROM lrow", _lrow("lrow", "train"))
    q["training_frame_session_key"] = _q("""
SELECT l.user_session, l.user_id, round(l.session_value, 6) AS session_value, n.last_product_id, n.last_category_id,
       ftr.* EXCLUDE (user_session, user_id)
FROM lab_a l LEFT JOIN lnn n USING (user_session)
LEFT JOIN ftr ON ftr.user_session = l.user_session AND ftr.user_id = l.user_id""", _lnn("lnn", "train"))
    frame = """SELECT l.user_session, l.user_id, round(l.session_value, 6) AS session_value, n.last_product_id, n.last_category_id,
  """ + "COLUMNS(ftr.* EXCLUDE (user_session, user_id))" + """
FROM lab_a l LEFT JOIN lnn n USING (user_session)
LEFT JOIN ftr ON ftr.user_session = l.user_session AND ftr.user_id = l.user_id"""
    q["gbt_first_tree"] = PRELUDE + ",\n" + _lnn("lnn", "train") + ",\n" + _first_tree(frame)
    q["training_frame_user_session_key"] = _q(
        "SELECT * REPLACE (round(session_value, 6) AS session_value) FROM frame_uk", FRAME_UK)
    q["target_log_clip"] = _q("SELECT user_session, round(ln(1 + greatest(session_value, 0)), 6) AS y FROM lab_a")
    q["target_log"] = _q("""
SELECT user_id, user_session, round(CASE WHEN session_value > -1 THEN ln(1 + session_value) END, 6) AS y
FROM lab_b""")
    q["target_inverse"] = _q("""
SELECT user_session, round(y, 6) AS y, round(exp(y) - 1, 6) AS session_value_back
FROM (SELECT user_session, ln(1 + greatest(session_value, 0)) AS y FROM lab_a)""")
    q["winsorize_upper"] = _q("""
SELECT user_session, round(least(session_value, (SELECT quantile_cont(session_value, 0.995) FROM lab_a)), 6)
       AS session_value_w FROM lab_a""")
    q["winsorize_two_sided"] = _q("""
SELECT user_id, user_session,
       round(least(greatest(session_value, (SELECT quantile_cont(session_value, 1 - 0.995) FROM lab_b)),
                   (SELECT quantile_cont(session_value, 0.995) FROM lab_b)), 6) AS session_value_w
FROM lab_b""")
    q["tail_stats"] = _q("""
SELECT round(avg(session_value), 6) AS mean, round(stddev_samp(session_value), 6) AS std,
  round(quantile_cont(session_value, 0.0), 6) AS q000, round(quantile_cont(session_value, 0.25), 6) AS q025,
  round(quantile_cont(session_value, 0.5), 6) AS q050, round(quantile_cont(session_value, 0.75), 6) AS q075,
  round(quantile_cont(session_value, 0.9), 6) AS q090, round(quantile_cont(session_value, 0.95), 6) AS q095,
  round(quantile_cont(session_value, 0.99), 6) AS q099, round(quantile_cont(session_value, 0.995), 6) AS q0995,
  round(quantile_cont(session_value, 1.0), 6) AS q100
FROM lab_a""")
    q["tail_counts"] = _q("""
SELECT CAST(count(*) FILTER (WHERE session_value > (SELECT quantile_cont(session_value, 0.99) FROM lab_a)) AS BIGINT)
         AS n_above_p99,
       CAST(count(*) FILTER (WHERE session_value > (SELECT quantile_cont(session_value, 0.995) FROM lab_a)) AS BIGINT)
         AS n_above_p995,
       round(max(session_value), 6) AS max
FROM lab_a""")
    q["heavy_users"] = _q("""
SELECT CAST(count(*) FILTER (WHERE n >= 3 AND mu > p95 AND p95 <> 0) AS BIGINT) AS users_heavy_mu_gt_p95
FROM (SELECT user_id, avg(session_value) AS mu, count(*) AS n FROM lab_a GROUP BY user_id),
     (SELECT quantile_cont(session_value, 0.95) AS p95 FROM lab_a)""")
    q["hot_key_join"] = """
WITH e AS (SELECT event_id, CAST(value AS DECIMAL(18,2)) AS value, CAST(CASE WHEN event_id % 3 = 0 THEN 1
             WHEN event_id % 20 <> 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS BIGINT) AS product FROM events),
m AS (SELECT product, round(avg(value), 6) AS product_mean FROM e WHERE product IS NOT NULL GROUP BY product)
SELECT event_id, product, product_mean FROM e LEFT JOIN m USING (product)"""
    q["user_quantiles"] = _q("""
SELECT user_id, CAST(count(*) AS BIGINT) AS n_sessions, """ + ", ".join(
        f"round(quantile_cont(session_value, 0.{p}), 6) AS q{p}" for p in ("25", "50", "75", "95")) + """
FROM lab_a GROUP BY user_id""")
    q["session_user_counts"] = _q(
        "SELECT CAST(count(*) AS BIGINT) AS n_sessions, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users FROM lab_a")
    q["group_folds"] = _q("""
SELECT l.user_session, l.user_id, f.fold FROM lab_a l JOIN gf f ON l.user_id = f.g""",
                          _group_folds("gf", "lab_a"))
    q["balanced_group_folds"] = "WITH RECURSIVE " + ", ".join([EV, LABELED, LAB_B]) + """,
dealt AS MATERIALIZED (
  SELECT g, size, row_number() OVER (ORDER BY size DESC, h, g) AS step
  FROM (SELECT user_id AS g, count(*) AS size, """ + _hash("user_id", 0) + """ AS h FROM lab_b GROUP BY user_id)),
walk(step, loads, g, fold) AS (
  SELECT CAST(0 AS BIGINT), [CAST(0 AS BIGINT) FOR x IN range(10)], CAST(NULL AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT d.step, [CASE WHEN i = list_position(w.loads, list_min(w.loads)) THEN w.loads[i] + d.size ELSE w.loads[i] END
                  FOR i IN range(1, 11)],
         d.g, CAST(list_position(w.loads, list_min(w.loads)) AS BIGINT)
  FROM walk w JOIN dealt d ON d.step = w.step + 1),
placed AS (SELECT g, fold FROM walk WHERE fold > 0)
SELECT b.user_id, b.user_session, p.fold, CAST(count(*) OVER (PARTITION BY p.fold) AS BIGINT) AS fold_rows
FROM lab_b b JOIN placed p ON b.user_id = p.g"""
    q["group_holdout"] = _q("""
SELECT b.user_id, b.user_session, r.idx < ceil(r.n * 0.1) AS is_holdout
FROM lab_b b JOIN (
  SELECT g, row_number() OVER (ORDER BY h, g) - 1 AS idx, count(*) OVER () AS n
  FROM (SELECT g, """ + _hash("g", 2025) + """ AS h FROM (SELECT DISTINCT user_id AS g FROM lab_b))
) r ON b.user_id = r.g""")
    q["baseline_cv"] = _q("""
SELECT fold, round(train_mean, 6) AS train_mean, round(val_mse, 6) AS val_mse, n_tr, n_va,
       round(avg(val_mse) OVER (), 6) AS cv_mean_mse
FROM (
  SELECT f.fold, any_value(m.train_mean) AS train_mean, avg((f.session_value - m.train_mean) ^ 2) AS val_mse,
         any_value(m.n_tr) AS n_tr, CAST(count(*) AS BIGINT) AS n_va
  FROM fl f JOIN (
    SELECT fold, (sum(s) OVER () - s) / nullif(sum(c) OVER () - c, 0) AS train_mean,
           CAST(sum(c) OVER () - c AS BIGINT) AS n_tr
    FROM (SELECT fold, sum(CAST(session_value AS DECIMAL(18,2))) AS s, count(*) AS c FROM fl GROUP BY fold)) m
    USING (fold)
  GROUP BY f.fold)""", _group_folds("gf", "lab_a"),
                          "fl AS (SELECT l.*, gf.fold FROM lab_a l JOIN gf ON l.user_id = gf.g)")
    q["baseline_report"] = _q("""
SELECT name, fold, round(value, 6) AS value FROM (
  SELECT 'train_mean' AS name, fold, train_mean AS value FROM cvr
  UNION ALL SELECT 'val_mse', fold, val_mse FROM cvr
  UNION ALL SELECT 'n_tr', fold, CAST(n_tr AS DOUBLE) FROM cvr
  UNION ALL SELECT 'n_va', fold, CAST(n_va AS DOUBLE) FROM cvr
  UNION ALL SELECT 'cv_mean_mse', CAST(NULL AS BIGINT), avg(val_mse) FROM cvr
  UNION ALL SELECT 'global_mean', CAST(NULL AS BIGINT),
                   CAST(round(avg(CAST(session_value AS DECIMAL(18,2))), 6) AS DOUBLE) FROM lab_a)""",
        _group_folds("gf", "lab_a"),
        "fl AS (SELECT l.*, gf.fold FROM lab_a l JOIN gf ON l.user_id = gf.g)",
        """cvr AS (
  SELECT f.fold, any_value(m.train_mean) AS train_mean, avg((f.session_value - m.train_mean) ^ 2) AS val_mse,
         any_value(m.n_tr) AS n_tr, CAST(count(*) AS BIGINT) AS n_va
  FROM fl f JOIN (
    SELECT fold, (sum(s) OVER () - s) / nullif(sum(c) OVER () - c, 0) AS train_mean,
           CAST(sum(c) OVER () - c AS BIGINT) AS n_tr
    FROM (SELECT fold, sum(CAST(session_value AS DECIMAL(18,2))) AS s, count(*) AS c FROM fl GROUP BY fold)) m
    USING (fold)
  GROUP BY f.fold)""")
    q["baseline_submission"] = _q("""
SELECT t.user_session, round((SELECT avg(CAST(session_value AS DECIMAL(18,2))) FROM lab_a), 6) AS session_value, t.row_no
FROM (SELECT user_session, min(row_no) AS row_no FROM ev WHERE split = 'test' AND user_session IS NOT NULL
      GROUP BY user_session) t""")
    q["user_backoff_raw"] = _q("""
SELECT user_session, 'train' AS role, round(coalesce(um.m, ga.g), 6) AS user_backoff
FROM lab_a LEFT JOIN um USING (user_id), ga
UNION ALL
SELECT user_session, 'test' AS role, round(coalesce(um.m, ga.g), 6) AS user_backoff
FROM fte LEFT JOIN um USING (user_id), ga""", USER_MEAN_RAW)
    q["user_backoff_log"] = _q("""
SELECT user_id, user_session, 'train' AS role, round(ul.m, 6) AS user_backoff_y
FROM yb LEFT JOIN ul USING (user_id)
UNION ALL
SELECT user_id, user_session, 'test' AS role, round(coalesce(ul.m, (SELECT avg(y) FROM yb)), 6)
FROM fte LEFT JOIN ul USING (user_id)""",
        "yb AS (SELECT *, CASE WHEN session_value > -1 THEN ln(1 + session_value) END AS y FROM lab_b)",
        "ul AS (SELECT user_id, avg(y) AS m FROM yb WHERE user_id IS NOT NULL AND y IS NOT NULL GROUP BY user_id)")
    q["item_encoding_raw"] = _q("""
SELECT f.user_session, round(coalesce(pm.m, ga.g), 6) AS te_prod, round(coalesce(cm.m, ga.g), 6) AS te_cat,
       'train' AS role
FROM fr_sk f LEFT JOIN pm USING (last_product_id) LEFT JOIN cm USING (last_category_id), ga
UNION ALL
SELECT t.user_session, round(coalesce(pm.m, ga.g), 6), round(coalesce(cm.m, ga.g), 6), 'test'
FROM te_sk t LEFT JOIN pm USING (last_product_id) LEFT JOIN cm USING (last_category_id), ga""",
                                USER_MEAN_RAW, ITEM_RAW)
    q["item_encoding_log"] = _q("""
SELECT f.user_id, f.user_session, round(coalesce(pl.m, gl.g), 6) AS te_last_prod_y,
       round(coalesce(cl.m, gl.g), 6) AS te_last_cat_y, 'train' AS role
FROM fr_log f LEFT JOIN pl USING (last_product_id) LEFT JOIN cl USING (last_category_id), gl
UNION ALL
SELECT t.user_id, t.user_session, round(coalesce(pl.m, gl.g), 6), round(coalesce(cl.m, gl.g), 6), 'test'
FROM test_uk t LEFT JOIN pl USING (last_product_id) LEFT JOIN cl USING (last_category_id), gl""",
                                FRAME_UK, TEST_UK, LOG_FRAME,
                                "pl AS (SELECT last_product_id, avg(y) AS m FROM fr_log WHERE y IS NOT NULL GROUP BY 1)",
                                "cl AS (SELECT last_category_id, avg(y) AS m FROM fr_log WHERE y IS NOT NULL GROUP BY 1)",
                                "gl AS (SELECT avg(y) AS g FROM fr_log)")
    q["fold_encodings"] = _q("""
SELECT r.user_id, r.user_session, round(r.y, 6) AS y, r.row_fold, CAST(fl.f AS BIGINT) AS fold,
  CASE WHEN r.src = 'test' THEN 'test' WHEN r.row_fold = fl.f THEN 'val' ELSE 'fit' END AS role,
  round(coalesce(ue.m, gd.m), 6) AS user_backoff_y,
  round(coalesce(pe.m, gd.m), 6) AS te_last_prod_y,
  round(coalesce(ce.m, gd.m), 6) AS te_last_cat_y
FROM rws r CROSS JOIN fl
LEFT JOIN ue ON ue.f = fl.f AND ue.user_id = r.user_id
LEFT JOIN pe ON pe.f = fl.f AND pe.last_product_id = r.last_product_id
LEFT JOIN ce ON ce.f = fl.f AND ce.last_category_id = r.last_category_id
LEFT JOIN gd ON gd.f = fl.f""",
        FRAME_UK, TEST_UK, LOG_FRAME, _group_folds("gf", "lab_b"),
        "trf AS (SELECT f.*, gf.fold FROM fr_log f JOIN gf ON f.user_id = gf.g)",
        "fl AS (SELECT range AS f FROM range(1, 6))",
        "ue AS (SELECT fl.f, t.user_id, avg(t.y) AS m FROM trf t, fl WHERE t.fold <> fl.f AND t.y IS NOT NULL "
        "AND t.user_id IS NOT NULL GROUP BY ALL)",
        "pe AS (SELECT fl.f, t.last_product_id, avg(t.y) AS m FROM trf t, fl WHERE t.fold <> fl.f "
        "AND t.y IS NOT NULL GROUP BY ALL)",
        "ce AS (SELECT fl.f, t.last_category_id, avg(t.y) AS m FROM trf t, fl WHERE t.fold <> fl.f "
        "AND t.y IS NOT NULL GROUP BY ALL)",
        "gd AS (SELECT fl.f, avg(t.y) AS m FROM trf t, fl WHERE t.fold <> fl.f AND t.y IS NOT NULL GROUP BY ALL)",
        "rws AS (SELECT user_id, user_session, y, fold AS row_fold, last_product_id, last_category_id, "
        "'train' AS src FROM trf UNION ALL SELECT user_id, user_session, NULL, NULL, last_product_id, "
        "last_category_id, 'test' FROM test_uk)")
    q["fill_template"] = _q("""
SELECT t.user_session, round(coalesce(p.v, ga.g), 6) AS session_value, t.row_no
FROM (SELECT user_session, min(row_no) AS row_no FROM ev WHERE split = 'test' AND user_session IS NOT NULL
      GROUP BY user_session) t
LEFT JOIN (SELECT fte.user_session, coalesce(um.m, ga.g) AS v FROM fte LEFT JOIN um USING (user_id), ga) p
  USING (user_session), ga""", USER_MEAN_RAW)
    q["prediction_file"] = q["fill_template"].replace("t.row_no\nFROM", "row_number() OVER (ORDER BY t.row_no) - 1 AS row_no\nFROM")
    q["blend_two"] = _q("""
SELECT a.user_session, round(0.5 * a.v + 0.5 * b.v, 6) AS session_value
FROM (SELECT fte.user_session, coalesce(um.m, ga.g) AS v FROM fte LEFT JOIN um USING (user_id), ga) a
JOIN (SELECT t.user_session, coalesce(pm.m, ga.g) AS v FROM te_sk t LEFT JOIN pm USING (last_product_id), ga) b
  USING (user_session)""", USER_MEAN_RAW, ITEM_RAW)
    q["oof_scores"] = _q("""
SELECT user_id, user_session, round(avg(pred), 6) AS oof, round(any_value(y), 6) AS y
FROM scores WHERE role = 'val' GROUP BY user_id, user_session""", *_standin((2025, 2027, 2031)))
    q["test_avg_log"] = _q("""
SELECT user_id, user_session, round(exp(avg(pred)) - 1, 6) AS session_value
FROM scores WHERE role = 'test' GROUP BY user_id, user_session""", *_standin((2025, 2027, 2031)))
    q["test_avg_linear"] = _q("""
SELECT user_id, user_session, round(avg(exp(pred) - 1), 6) AS session_value
FROM scores WHERE role = 'test' GROUP BY user_id, user_session""", *_standin((42,)))
    q["fold_scores"] = _q("""
SELECT seed, fold, n_va, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse,
       round(avg(mse) OVER (PARTITION BY seed), 6) AS cv_mean_mse
FROM (SELECT CAST(seed AS BIGINT) AS seed, CAST(fold AS BIGINT) AS fold, avg((y - pred) ^ 2) AS mse,
             CAST(count(*) AS BIGINT) AS n_va FROM scores WHERE role = 'val' GROUP BY ALL)""",
                          *_standin((2025, 2027, 2031)))
    q["pooled_score"] = _q("""
SELECT round(avg((y - oof) ^ 2), 6) AS oof_mse, round(sqrt(avg((y - oof) ^ 2)), 6) AS oof_rmse
FROM (SELECT user_id, user_session, avg(pred) AS oof, any_value(y) AS y
      FROM scores WHERE role = 'val' GROUP BY user_id, user_session)""", *_standin((2025, 2027, 2031)))
    q["assembled_features"] = f"""
SELECT feature, round(sum(v), 6) AS total, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE v = 0) AS BIGINT) AS n_zero
FROM (UNPIVOT (
  SELECT coalesce(CAST(COLUMNS(* EXCLUDE (user_session, user_id, session_value, last_product_id, last_category_id))
                       AS DOUBLE), 0) FROM ({q["training_frame_session_key"]})) ON COLUMNS(*) INTO NAME feature VALUE v)
GROUP BY feature"""
    q |= {f"edge_{name}": q[name].replace(PRELUDE, EDGE_PRELUDE) for name in EDGE_OF}
    return q
