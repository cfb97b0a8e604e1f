"""The same results in DuckDB SQL, for every query that SQL can state."""

from __future__ import annotations

from flowlens.functions import columns as C
from flowlens.plans import wide
from flowlens.schema import ATTACKS_BY_CATEGORY, BINARY_ORDER, CATEGORY_ORDER, SUSPECT_LABEL
from flowlens.sources.tables import NOMINAL, NUMERIC

FLOWS = """flows AS (
SELECT concat(cast(l.l_orderkey AS string), '-', cast(l.l_linenumber AS string), '-',
              cast(l.l_partkey AS string), '-', cast(l.l_suppkey AS string), '-',
              cast(cast(l.l_quantity AS int) AS string)) AS flow_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'tcp' WHEN 'O' THEN 'udp' ELSE 'icmp' END
           AS protocol_type,
       lower(p.p_type) AS service, concat(l.l_returnflag, l.l_linestatus) AS flag,
       l.l_quantity AS duration, l.l_extendedprice AS src_bytes, p.p_retailprice AS dst_bytes,
       CAST(p.p_size AS double) AS cnt, l.l_tax AS serror_rate, l.l_discount AS same_srv_rate,
       CAST(0 AS double) AS num_outbound_cmds,
       CASE WHEN l.l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
       CASE WHEN l.l_quantity >= 49 AND l.l_tax >= 0.075 AND l.l_orderkey % 5 = 0
                THEN 'snmpguess'
            WHEN l.l_quantity >= 48 AND p.p_size >= 40 AND l.l_orderkey % 5 = 0 THEN 'mailbomb'
            WHEN l.l_quantity >= 50 AND l.l_discount >= 0.095 THEN 'rootkit'
            WHEN l.l_quantity >= 45 AND p.p_size >= 48 THEN 'guess_passwd'
            WHEN l.l_quantity >= 36 AND l.l_tax < 0.025 THEN ' satan. '
            WHEN l.l_quantity >= 30 AND p.p_size <= 30 THEN 'neptune.'
            WHEN l.l_quantity = 29 AND p.p_size = 31 THEN 'mystery'
            ELSE 'normal' END AS label
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey)"""

_TAXONOMY = "taxonomy(attack_type, category) AS (VALUES " + ", ".join(
    f"('{name}', '{category}')" for category, names in ATTACKS_BY_CATEGORY.items()
    for name in names) + ")"

TYPED = f"""{_TAXONOMY},
typed AS (
SELECT f.*, a.attack_type, a.category,
       CASE WHEN a.category = 'Normal' THEN 0 ELSE 1 END AS binary_label
FROM flows f
JOIN (SELECT raw_label, d.attack_type, coalesce(x.category, 'Unknown') AS category
      FROM (SELECT DISTINCT label AS raw_label,
                   regexp_replace(trim(label), '[.]+$', '') AS attack_type FROM flows) d
      LEFT JOIN taxonomy x ON d.attack_type = x.attack_type) a
  ON f.label = a.raw_label)"""

RULE = """CASE WHEN duration >= 36 AND serror_rate < 0.035 THEN 'Probe'
            WHEN duration >= 30 AND cnt <= 35 THEN 'DoS'
            WHEN duration >= 46 AND cnt >= 45 THEN 'R2L'
            WHEN duration >= 50 THEN 'U2R' ELSE 'Normal' END AS pred_class,
       0.4e0 + 0.6e0 * (CAST(CAST(cnt AS int) * 7 % 50 AS double) / 49) AS pred_conf,
       round((duration + 20 * same_srv_rate * 10 + cnt / 5) / 100, 3) AS anomaly_score"""

SCORED = f"""scored AS (
SELECT t.*, {RULE},
       CASE WHEN seen.attack_type IS NULL AND t.binary_label = 1 THEN 1 ELSE 0 END AS is_novel
FROM typed t
LEFT JOIN (SELECT DISTINCT attack_type FROM typed WHERE split = 'train') seen
  ON t.attack_type = seen.attack_type
WHERE t.split = 'test')"""

LIMIT = """lim AS (SELECT quantile_cont(anomaly_score, 0.95) AS threshold FROM scored
WHERE binary_label = 0)"""
_SURE = "pred_conf >= 0.6"
_CALM = "anomaly_score < threshold"
_FINAL = f"""CASE WHEN pred_class = 'Normal' AND {_CALM} THEN 'Normal'
            WHEN {_SURE} AND {_CALM} THEN pred_class
            WHEN {_SURE} AND NOT ({_CALM}) AND pred_class <> 'Normal' THEN pred_class
            ELSE '{SUSPECT_LABEL}' END"""
ROUTED = f"""routed AS (
SELECT *, CASE WHEN final_label = '{SUSPECT_LABEL}' THEN '{SUSPECT_LABEL}'
               WHEN final_label = 'Normal' THEN 'Normal' ELSE 'Known Attack Class' END
           AS routed_to,
       CASE WHEN is_novel = 1 THEN 'True Zero-Day Attack'
            WHEN binary_label = 1 THEN 'Known Attack' ELSE 'Normal' END AS true_group,
       CASE WHEN is_novel = 1 THEN final_label = '{SUSPECT_LABEL}'
            ELSE final_label = category END AS correct
FROM (SELECT s.*, CASE WHEN {_CALM} THEN 0 ELSE 1 END AS is_anomalous, {_FINAL} AS final_label
      FROM scored s, lim))"""

DETECTIONS = """det AS (
SELECT 'rule' AS model, flow_id, anomaly_score AS score, binary_label, is_novel FROM scored
UNION ALL SELECT 'volume', flow_id, src_bytes, binary_label, is_novel FROM scored
UNION ALL SELECT 'doubt', flow_id, 1 - pred_conf, binary_label, is_novel FROM scored),
pts AS (SELECT model, score, count(*) FILTER (WHERE binary_label = 1) AS pos,
               count(*) FILTER (WHERE binary_label = 0) AS neg FROM det GROUP BY ALL),
cum AS (SELECT model, score, pos, neg,
               sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
               sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
        FROM pts WINDOW w AS (PARTITION BY model ORDER BY score DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lims AS (SELECT model, quantile_cont(score, 0.95) AS threshold FROM det
         WHERE binary_label = 0 GROUP BY model),
rates AS (SELECT model, any_value(threshold) AS threshold,
                 avg(CASE WHEN binary_label = 1 THEN CAST(score >= threshold AS int) END)
                     AS attack_rate,
                 avg(CASE WHEN is_novel = 1 THEN CAST(score >= threshold AS int) END)
                     AS novel_rate,
                 CAST(sum(is_novel) AS BIGINT) AS n_zero_day
          FROM det JOIN lims USING (model) GROUP BY model),
areas AS (SELECT model,
                 round(sum(CAST(neg AS double) * (tp - pos / 2e0)) / max(CAST(p AS double) * n), 6)
                     AS roc_auc,
                 round(sum(pos * (CAST(tp AS double) / (tp + fp))) / max(p), 6)
                     AS average_precision
          FROM cum GROUP BY model)"""

PREDICTIONS = """pred AS (
SELECT 'binary' AS task, 'rule' AS model,
       CASE WHEN binary_label = 1 THEN 'Attack' ELSE 'Normal' END AS truth,
       CASE WHEN pred_class = 'Normal' THEN 'Normal' ELSE 'Attack' END AS guess
FROM scored
UNION ALL SELECT 'binary', 'majority',
       CASE WHEN binary_label = 1 THEN 'Attack' ELSE 'Normal' END, 'Normal'
FROM scored
UNION ALL SELECT 'multiclass', 'rule', category, pred_class
FROM scored WHERE category <> 'Unknown'
UNION ALL SELECT 'multiclass', 'majority', category, 'Normal'
FROM scored WHERE category <> 'Unknown'),
per_label AS (
SELECT task, model, label, sum(s) AS support, sum(g) AS guessed, sum(h) AS hits
FROM (SELECT task, model, truth AS label, 1 AS s, 0 AS g,
             CASE WHEN truth = guess THEN 1 ELSE 0 END AS h FROM pred
      UNION ALL SELECT task, model, guess, 0, 1, 0 FROM pred) GROUP BY ALL),
prf AS (
SELECT *, CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS precision,
       CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
       CASE WHEN guessed + support = 0 THEN 0 ELSE 2 * hits / (guessed + support) END AS f1
FROM per_label),
avgs AS (
SELECT task, model, sum(hits) / sum(support) AS accuracy,
       avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
       sum(precision * support) / sum(support) AS precision_weighted,
       sum(recall * support) / sum(support) AS recall_weighted,
       sum(f1 * support) / sum(support) AS f1_weighted
FROM prf GROUP BY task, model)"""


def _values(names: list[str], column: str) -> str:
    return f"(VALUES {', '.join(f'({n!r})' for n in names)}) AS v_{column}({column})"


_REPORT_LABELS = "(VALUES " + ", ".join(
    f"('{task}', '{label}')" for task, order in (("binary", BINARY_ORDER),
                                                 ("multiclass", CATEGORY_ORDER))
    for label in order) + ") AS listed(task, label)"
REPORT = f"""rep AS (
SELECT m.task, m.model, listed.label, coalesce(precision, 0) AS precision,
       coalesce(recall, 0) AS recall, coalesce(f1, 0) AS f1,
       CAST(coalesce(support, 0) AS BIGINT) AS support, coalesce(hits, 0) AS hits
FROM (SELECT DISTINCT task, model FROM pred) m
JOIN {_REPORT_LABELS} ON m.task = listed.task
LEFT JOIN prf ON prf.task = m.task AND prf.model = m.model AND prf.label = listed.label),
report AS (
SELECT task, model, label, precision, recall, f1, support FROM rep
UNION ALL SELECT task, model, 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
       sum(hits) / sum(support), CAST(sum(support) AS BIGINT) FROM rep GROUP BY task, model
UNION ALL SELECT task, model, 'macro avg', avg(precision), avg(recall), avg(f1),
       CAST(sum(support) AS BIGINT) FROM rep GROUP BY task, model
UNION ALL SELECT task, model, 'weighted avg', sum(precision * support) / sum(support),
       sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
       CAST(sum(support) AS BIGINT) FROM rep GROUP BY task, model)"""
_REPORT_ROWS = """SELECT task, model, label, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report"""

MATRIX = f"""cells AS (
SELECT m.task, m.model, v_truth.truth, v_guess.guess, count(pred.truth) AS n
FROM (SELECT DISTINCT task, model FROM pred WHERE task = 'multiclass') m
CROSS JOIN {_values(CATEGORY_ORDER, 'truth')} CROSS JOIN {_values(CATEGORY_ORDER, 'guess')}
LEFT JOIN pred ON pred.task = m.task AND pred.model = m.model
      AND pred.truth = v_truth.truth AND pred.guess = v_guess.guess
GROUP BY ALL)"""

WEIGHTS = """counts AS (SELECT category, count(*) AS n FROM typed WHERE split = 'train'
                        GROUP BY category),
weights AS (SELECT category, n,
                   round((SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n), 6)
                       AS weight FROM counts)"""

STATS = "stats AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"
    for c in NUMERIC) + " FROM typed WHERE split = 'train')"


def _scaled(c: str) -> str:
    return f"({c} - m_{c}) / s_{c}"


SLOTS = ",\n".join(
    f"slots_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS {c}_slot "
    f"FROM (SELECT DISTINCT {c} FROM typed WHERE split = 'train'))" for c in NOMINAL)
_SLOT_JOINS = " ".join(f"LEFT JOIN slots_{c} USING ({c})" for c in NOMINAL)
_FEATURES = ", ".join([*NOMINAL, *NUMERIC])
_NAMES = " UNION ALL ".join(
    [f"SELECT {i} AS feature_idx, 'num__{c}' AS raw, '{c}' AS clean"
     for i, c in enumerate(NUMERIC)]
    + [f"SELECT CAST({len(NUMERIC)} + " + " + ".join(
        [f"{c}_slot"] + [f"(SELECT count(*) FROM slots_{b})" for b in NOMINAL[:k]])
        + f" AS INT), concat('cat__{c}_', {c}), concat('{c}=', {c}) FROM slots_{c}"
       for k, c in enumerate(NOMINAL)])

PLAIN = "plain AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{k}' AS class_name, {c} / {d} AS shap "
    f"FROM typed WHERE split = 'test'" for c in NUMERIC
    for k, d in (("DoS", "100e0"), ("Probe", "-400e0"))) + """),
importance AS (SELECT feature, avg(m) AS mean_abs_shap
               FROM (SELECT class_name, feature, avg(abs(shap)) AS m FROM plain GROUP BY ALL)
               GROUP BY feature)"""

_PRESET_COLUMNS = ("flow_id, service, attack_type, category, duration, src_bytes, binary_label")


def _preset(title: str, predicates: list[str]) -> str:
    rank = " ".join(f"WHEN {p} THEN {i}" for i, p in enumerate(predicates))
    return (f"(SELECT {title} AS preset_name, {_PRESET_COLUMNS} FROM scored "
            f"WHERE {' OR '.join(predicates)} ORDER BY CASE {rank} END, flow_id LIMIT 1)")


_PRESETS = " UNION ALL ".join([
    _preset("'Normal - HTTP Web Traffic'",
            ["(category = 'Normal' AND service = 'promo burnished')", "category = 'Normal'"]),
    _preset("'DoS - Neptune SYN Flood'", ["attack_type = 'neptune'"]),
    _preset("concat('Probe - Port Scan (', attack_type, ')')", ["category = 'Probe'"]),
    _preset("'R2L - Guess Password Attack'", ["attack_type = 'guess_passwd'"]),
    _preset("concat('U2R - Privilege Escalation (', attack_type, ')')", ["category = 'U2R'"]),
    _preset("concat('True Zero-Day - Unseen Attack (', attack_type, ')')",
            ["(is_novel = 1 AND attack_type = 'snmpgetattack')", "is_novel = 1"])])

_CASE = ("SELECT flow_id, attack_type, category, pred_class, round(pred_conf, 6) AS pred_conf "
         "FROM scored WHERE ")

LOF = """vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pool AS (SELECT * FROM vec WHERE label < 5
         ORDER BY md5(concat(CAST(vec_id AS VARCHAR), ':42')), CAST(vec_id AS VARCHAR) LIMIT 20000),
near AS (SELECT * FROM (
    SELECT a.vec_id AS a_id, b.vec_id AS b_id, list_distance(a.x, b.x) AS d,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id)
               AS place
    FROM pool a JOIN pool b ON a.vec_id <> b.vec_id)
    WHERE place <= 35),
reach AS (SELECT a_id AS vec_id, max(d) AS k_distance FROM near GROUP BY a_id),
density AS (SELECT near.a_id AS vec_id, 1 / (avg(greatest(d, k_distance)) + 1e-10) AS lrd
            FROM near JOIN reach ON near.b_id = reach.vec_id GROUP BY near.a_id),
asked AS (SELECT * FROM (
    SELECT a.vec_id AS a_id, a.label, b.vec_id AS b_id, list_distance(a.x, b.x) AS d,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id)
               AS place
    FROM vec a CROSS JOIN pool b)
    WHERE place <= 35)"""

_WIDE = ", ".join(
    f'{"ltrim(" + sql + ")" if name == "label" else sql} AS "{name}"'
    for name, sql in wide.expressions())


def _known(profile: str) -> str:
    return C.ACTION_KNOWN.replace("%s", f"', {profile}, '")


_ACTION_SURE = C.ACTION_CORROBORATED.replace("%%", "%").replace(
    "%.1f", "', printf('%.1f', pred_conf * 100), '")

_TRIAGE = f"""SELECT flow_id,
  CASE WHEN pred_class = 'Normal' AND {_CALM} THEN '{C.TRIAGE_NORMAL}'
       WHEN {_SURE} AND {_CALM} THEN concat('Known Attack: ', pred_class)
       WHEN {_SURE} AND pred_class <> 'Normal' THEN concat('Corroborated Attack: ', pred_class)
       ELSE '{C.TRIAGE_SUSPECT}' END AS decision,
  CASE WHEN pred_class = 'Normal' AND {_CALM} THEN 'success'
       WHEN {_SURE} AND ({_CALM} OR pred_class <> 'Normal') THEN 'danger'
       ELSE 'warning' END AS badge,
  CASE WHEN pred_class = 'Normal' AND {_CALM} THEN '{C.ACTION_NORMAL}'
       WHEN {_SURE} AND {_CALM} THEN concat('{_known("pred_class")}')
       WHEN {_SURE} AND pred_class <> 'Normal' THEN concat('{_ACTION_SURE}')
       ELSE '{C.ACTION_SUSPECT}' END AS action
FROM scored, lim"""

#: Balanced rows of the known classes, the sums of all cuts of the counted columns, and their gains.
#: At the start every class has probability 1/5: slope 1/5 less the hit, curvature 2 * 1/5 * 4/5.
CUTS = """known AS (SELECT category, count(*) AS n FROM typed
                    WHERE split = 'train' AND category <> 'Unknown' GROUP BY category),
balanced AS (SELECT t.*, (SELECT sum(n) FROM known) / ((SELECT count(*) FROM known)
                         * CAST(k.n AS double)) AS w
             FROM typed t JOIN known k USING (category) WHERE split = 'train'),
cells AS (""" + " UNION ALL ".join(
    f"SELECT k.category AS class_name, '{c}' AS feature, {i} AS place, {c} AS cut, "
    "sum((0.2e0 - CASE WHEN b.category = k.category THEN 1 ELSE 0 END) * w) AS g, "
    f"sum(0.32e0 * w) AS h FROM balanced b CROSS JOIN known k GROUP BY k.category, {c}"
    for i, c in enumerate(NUMERIC) if c in (
        "duration", "cnt", "serror_rate", "same_srv_rate")) + """),
halves AS (SELECT *, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh,
                  sum(g) OVER whole AS tg, sum(h) OVER whole AS th
           FROM cells WINDOW upto AS (PARTITION BY class_name, feature ORDER BY cut),
                             whole AS (PARTITION BY class_name, feature)),
gains AS (SELECT *, lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1)
                 - tg * tg / (th + 1) AS gain
          FROM halves WHERE lh >= 1 AND th - lh >= 1),
roots AS (SELECT *, row_number() OVER (PARTITION BY class_name ORDER BY gain DESC, place, cut)
                 AS nth FROM gains)"""

_VIEWS = {"flows": [FLOWS], "typed": [FLOWS, TYPED], "scored": [FLOWS, TYPED, SCORED]}


def _sql(body: str, base: str, *views: str) -> str:
    return "WITH " + ",\n".join([*_VIEWS[base], *views]) + "\n" + body


def _rates() -> str:
    return ("round(threshold, 6) AS threshold, round(attack_rate, 6) AS attack_detection_rate, "
            "round(novel_rate, 6) AS zero_day_detection_rate, n_zero_day")


def _routed(body: str) -> str:
    return _sql(body, "scored", LIMIT, ROUTED)


def _detections(body: str) -> str:
    return _sql(body, "scored", DETECTIONS)


def _predictions(body: str, *views: str) -> str:
    return _sql(body, "scored", PREDICTIONS, *views)


def _averages(kind: str) -> str:
    return _predictions("SELECT task, model, " + ", ".join(
        f"round({m}_{kind}, 6) AS {m}_{kind}" for m in ("precision", "recall", "f1")) + " FROM avgs")


def oracle_sql() -> dict[str, str]:
    novel_type = ("attack_type NOT IN (SELECT attack_type FROM typed WHERE split = 'train')")
    test_attacks = ("SELECT flow_id, attack_type, category FROM typed "
                    "WHERE split = 'test' AND binary_label = 1 AND ")
    return {
        "scan_flows": _sql(f"SELECT {_WIDE} FROM flows", "flows"),
        "field_count_profile": _sql(
            "SELECT split, CAST(CASE WHEN split = 'train' THEN 42 ELSE 43 END AS BIGINT) "
            "AS n_fields, count(*) AS n_rows FROM flows GROUP BY split", "flows"),
        "load_split": _sql(
            "SELECT split, CAST(duration AS BIGINT) AS duration, service, attack_type, category, "
            "binary_label, CASE WHEN split = 'test' THEN CAST(CAST(cnt AS BIGINT) % 21 AS INT) "
            "END AS difficulty FROM typed", "typed"),
        "csv_round_trip": _sql("SELECT category, n, weight FROM weights", "typed", WEIGHTS),
        "json_round_trip": _predictions(_REPORT_ROWS, REPORT),
        "label_clean": _sql("SELECT flow_id, label, attack_type FROM typed", "typed"),
        "category_map": _sql("SELECT flow_id, attack_type, category FROM typed", "typed"),
        "binary_label": _sql("SELECT flow_id, category, binary_label FROM typed", "typed"),
        "binary_text": _sql("SELECT flow_id, CASE WHEN binary_label = 1 THEN 'Attack' "
                            "ELSE 'Normal' END AS binary_text FROM typed", "typed"),
        "feature_projection": _sql(f"SELECT flow_id, {_FEATURES} FROM typed", "typed"),
        "normal_only": _sql(f"SELECT flow_id, {_FEATURES} FROM typed "
                            "WHERE split = 'train' AND binary_label = 0", "typed"),
        "feature_names": _sql(f"SELECT CAST(feature_idx AS INT) AS feature_idx, raw, clean "
                              f"FROM ({_NAMES})", "typed", SLOTS),
        "hybrid_route": _routed("SELECT flow_id, pred_class, is_anomalous, final_label "
                                "FROM routed"),
        "routed_to": _routed("SELECT flow_id, routed_to FROM routed"),
        "truth_group": _routed("SELECT flow_id, true_group FROM routed"),
        "triage_disposition": _sql(_TRIAGE, "scored", LIMIT),
        "what_if_overrides": _sql(
            "SELECT flow_id, CASE WHEN binary_label = 1 AND cnt > 25 THEN 'icmp' "
            "ELSE protocol_type END AS protocol_type, CASE WHEN binary_label = 1 "
            "THEN duration * 2 ELSE duration END AS duration, "
            "CASE WHEN binary_label = 1 AND serror_rate > 0.04 THEN 0 ELSE serror_rate END "
            "AS serror_rate, cnt FROM typed", "typed"),
        "nan_profile": _sql(" UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL"
            + (f" OR isnan({c})" if c in NUMERIC else "") + ") AS n_missing FROM typed"
            for c in [*NOMINAL, *NUMERIC]), "typed"),
        "zero_day_rows": _sql(test_attacks + novel_type, "typed"),
        "zero_day_types": _sql("SELECT DISTINCT attack_type FROM typed WHERE split = 'test' AND "
                               + novel_type, "typed"),
        "known_attack_rows": _sql(test_attacks + "NOT " + novel_type, "typed"),
        "weighted_rows": _sql("SELECT flow_id, category, weight FROM typed JOIN weights "
                              "USING (category) WHERE split = 'train'", "typed", WEIGHTS),
        "split_shapes": _sql("SELECT split, count(*) AS n_rows, CAST(16 AS BIGINT) AS n_columns "
                             "FROM typed GROUP BY split", "typed"),
        "category_counts": _sql("SELECT split, category, count(*) AS n FROM typed GROUP BY ALL",
                                "typed"),
        "attack_types": _sql("SELECT DISTINCT split, attack_type FROM typed", "typed"),
        "class_weights": _sql("SELECT category, n, weight FROM weights", "typed", WEIGHTS),
        "confusion_matrix": _predictions("SELECT task, model, truth, guess, n FROM cells", MATRIX),
        "confusion_norm": _predictions(
            "SELECT task, model, truth, guess, round(n / greatest(sum(n) OVER "
            "(PARTITION BY task, model, truth), 1), 6) AS share FROM cells", MATRIX),
        "accuracy": _predictions("SELECT task, model, round(accuracy, 6) AS accuracy FROM avgs"),
        "prf_macro": _averages("macro"),
        "prf_weighted": _averages("weighted"),
        "class_report": _predictions(_REPORT_ROWS, REPORT),
        "metric_summary": _predictions("SELECT task, model, " + ", ".join(
            f"round({m}, 4) AS {m}" for m in ("accuracy", "precision_macro", "recall_macro",
                                              "f1_macro", "f1_weighted")) + " FROM avgs"),
        "p95_threshold": _sql(
            f"SELECT split, round(quantile_cont(anomaly_score, 0.95), 6) AS threshold "
            f"FROM (SELECT split, binary_label, {RULE} FROM typed) WHERE binary_label = 0 "
            "GROUP BY split", "typed"),
        "anomaly_flags": _routed("SELECT flow_id, anomaly_score, is_anomalous FROM routed"),
        "detection_rates": _detections(f"SELECT model, {_rates()} FROM rates"),
        "roc_auc": _detections("SELECT model, roc_auc FROM areas"),
        "average_precision": _detections("SELECT model, average_precision FROM areas"),
        "detector_summary": _detections("SELECT model, roc_auc, average_precision, "
                                        f"{_rates()} FROM areas JOIN rates USING (model)"),
        "roc_curve": _detections(
            "SELECT model, round(score, 6) AS threshold, round(fp / n, 6) AS fpr, "
            "round(tp / p, 6) AS tpr FROM cum "
            "UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0, 0 FROM cum"),
        "roc_curve_thin": _detections(
            "SELECT model, round(score, 6) AS threshold, round(fp / n, 6) AS fpr, "
            "round(tp / p, 6) AS tpr FROM (SELECT *, lead(pos) OVER w AS next_pos, "
            "lead(neg) OVER w AS next_neg, row_number() OVER w AS place FROM cum "
            "WINDOW w AS (PARTITION BY model ORDER BY score DESC)) WHERE place = 1 "
            "OR pos IS DISTINCT FROM next_pos OR neg IS DISTINCT FROM next_neg "
            "UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0, 0 FROM cum"),
        "pr_curve": _detections(
            "SELECT model, round(score, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, "
            "round(tp / p, 6) AS recall FROM cum "
            "UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 1, 0 FROM cum"),
        "hybrid_summary": _routed(
            "SELECT round(avg(CASE WHEN is_novel = 1 THEN "
            f"CAST(final_label = '{SUSPECT_LABEL}' AS int) END), 6) AS zero_day_to_unknown, "
            "round(avg(CASE WHEN is_novel = 0 AND binary_label = 1 THEN "
            f"CAST(final_label = '{SUSPECT_LABEL}' AS int) END), 6) AS known_to_unknown, "
            "round(avg(CASE WHEN binary_label = 0 THEN CAST(final_label <> 'Normal' AS int) END),"
            " 6) AS normal_false_alarm, "
            "round(avg(CAST(correct AS int)), 6) AS hybrid_accuracy, "
            "count(*) FILTER (WHERE is_novel = 1) AS n_zero_day, "
            "count(*) FILTER (WHERE is_novel = 0 AND binary_label = 1) AS n_known, "
            "count(*) FILTER (WHERE binary_label = 0) AS n_normal, 0.6e0 AS conf_threshold, "
            "round((SELECT threshold FROM lim), 6) AS anomaly_threshold FROM routed"),
        "hybrid_accuracy": _routed("SELECT round(avg(CAST(correct AS int)), 6) "
                                   "AS hybrid_accuracy FROM routed"),
        "routing_crosstab": _routed(
            "SELECT g.row_order, g.true_group, "
            + ", ".join(f"round(avg(CAST(routed_to = '{route}' AS int)), 6) AS {name}"
                        for route, name in (("Known Attack Class", "known_attack_class"),
                                            ("Normal", "normal"), (SUSPECT_LABEL, "unknown")))
            + " FROM (VALUES (1, 'Normal'), (2, 'Known Attack'), (3, 'True Zero-Day Attack')) "
              "AS g(row_order, true_group) LEFT JOIN routed USING (true_group) "
              "GROUP BY g.row_order, g.true_group"),
        "attribution_importance": _sql(
            "SELECT feature, round(mean_abs_shap, 6) AS mean_abs_shap FROM importance",
            "typed", PLAIN),
        "top_features": _sql(
            "SELECT feature, round(mean_abs_shap, 6) AS mean_abs_shap FROM importance "
            "ORDER BY importance.mean_abs_shap DESC, feature LIMIT 5", "typed", PLAIN),
        "presets": _sql(_PRESETS, "scored"),
        "case_best_hit": _sql(
            _CASE + "category = 'DoS' AND pred_class = 'DoS' "
            "ORDER BY scored.pred_conf DESC, flow_id LIMIT 1", "scored"),
        "case_first_miss": _sql(
            _CASE + "category = 'R2L' AND pred_class <> 'R2L' ORDER BY flow_id LIMIT 1", "scored"),
        "case_confident_error": _sql(
            _CASE + "is_novel = 1 ORDER BY CASE WHEN pred_class <> category THEN 0 ELSE 1 END, "
            "CASE WHEN pred_class <> category THEN -scored.pred_conf ELSE scored.pred_conf END, "
            "flow_id LIMIT 1", "scored"),
        "argmax_class": _sql(
            "SELECT flow_id, class_idx, ['DoS', 'Normal', 'Probe', 'R2L', 'U2R'][class_idx + 1] "
            "AS pred_class, round(list_max(votes), 6) AS pred_conf FROM (SELECT flow_id, votes, "
            "CAST(list_position(votes, list_max(votes)) - 1 AS INT) AS class_idx "
            "FROM (SELECT flow_id, [duration / 50, cnt / 50, same_srv_rate * 10, "
            "serror_rate * 10, 0.5e0] AS votes FROM typed))", "typed"),
        "seeded_sample": _sql(
            "SELECT flow_id, service, src_bytes FROM typed WHERE split = 'train' "
            "AND binary_label = 0 ORDER BY md5(concat(flow_id, ':42')), flow_id LIMIT 20000",
            "typed"),
        "standard_scale": _sql("SELECT flow_id, split, " + ", ".join(
            f"round({_scaled(c)}, 6) AS scaled_{c}" for c in NUMERIC) + " FROM typed, stats",
            "typed", STATS),
        "one_hot": _sql("SELECT flow_id, " + ", ".join(
            f"CAST({c}_slot AS INT) AS {c}_slot" for c in NOMINAL)
            + f" FROM typed {_SLOT_JOINS}", "typed", SLOTS),
        "feature_matrix": _sql(
            "SELECT flow_id, CAST(" + str(len(NUMERIC)) + " + " + " + ".join(
                f"(SELECT count(*) FROM slots_{c})" for c in NOMINAL) + " AS INT) AS n_features, "
            "n_active, round(" + " + ".join(_scaled(c) for c in NUMERIC) + " + n_active, 6) "
            "AS vector_sum FROM (SELECT *, " + " + ".join(
                f"CASE WHEN {c}_slot IS NULL THEN 0 ELSE 1 END" for c in NOMINAL)
            + f" AS n_active FROM typed {_SLOT_JOINS}), stats", "typed", SLOTS, STATS),
        "leakage_free_transform": _sql(" UNION ALL ".join(
            f"SELECT split, '{c}' AS feature, round(avg({_scaled(c)}), 6) + 0e0 AS mean_scaled, "
            f"round(stddev_pop({_scaled(c)}), 6) AS std_scaled FROM typed, stats GROUP BY split"
            for c in NUMERIC), "typed", STATS),
        "label_index": _sql(
            "SELECT flow_id, CAST(list_position(['DoS', 'Normal', 'Probe', 'R2L', 'U2R'], "
            "category) - 1 AS INT) AS class_idx, category AS decoded FROM typed "
            "WHERE category <> 'Unknown'", "typed"),
        "boost_first_round": _sql(
            "SELECT class_name, feature, round(gain, 3) AS gain, round(lh, 3) AS left_cover, "
            "round(th - lh, 3) AS right_cover, round(-0.1e0 * lg / (lh + 1), 6) AS left_value, "
            "round(-0.1e0 * (tg - lg) / (th - lh + 1), 6) AS right_value, "
            "round(ln(5), 6) AS loss FROM roots WHERE nth = 1", "typed", CUTS),
        "score_agreement": _sql("SELECT count(*) AS n_flows, CAST(0 AS BIGINT) AS n_differ "
                                "FROM typed WHERE split = 'test'", "typed"),
        "lof_score": "WITH " + LOF + """
SELECT asked.a_id AS vec_id, any_value(asked.label) AS label,
       round(avg(density.lrd) * (avg(greatest(d, k_distance)) + 1e-10) - 1.5e0, 6) AS lof
FROM asked JOIN reach ON asked.b_id = reach.vec_id JOIN density ON asked.b_id = density.vec_id
GROUP BY asked.a_id""",
        "route_stream": _sql(
            f"SELECT flow_id, final_label, CASE WHEN final_label = '{SUSPECT_LABEL}' THEN "
            f"'{SUSPECT_LABEL}' WHEN final_label = 'Normal' THEN 'Normal' "
            f"ELSE 'Known Attack Class' END AS routed_to FROM (SELECT flow_id, {_FINAL} "
            f"AS final_label FROM (SELECT flow_id, {RULE} FROM typed), lim)", "scored", LIMIT),
    }
