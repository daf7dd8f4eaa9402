"""DuckDB SQL equivalents of the registered queries (same column names).

Stand-in derivations mirror ``seqlab.plans.standins``; literals are cast
to DOUBLE because DuckDB reads ``0.4`` as DECIMAL.
"""

from __future__ import annotations

POSITIONS = """
  SELECT event_id, CAST(user_id AS VARCHAR) || '-' || event_type AS mmsi, ts,
         value * 0.4::DOUBLE - 95.0::DOUBLE AS lat,
         ((event_id * 37) % 4000) / 10.0::DOUBLE - 200.0::DOUBLE AS lon
  FROM events"""

FILTERED = f"""
  SELECT * FROM ({POSITIONS}) p
  WHERE lat IS NOT NULL AND NOT isnan(lat) AND lat BETWEEN -90.0 AND 90.0
    AND lon IS NOT NULL AND NOT isnan(lon) AND lon BETWEEN -180.0 AND 180.0"""

LAT_N = "((lat - -90.0::DOUBLE) / 180.0::DOUBLE * 1.0::DOUBLE + 0.0::DOUBLE)"
LON_N = "((lon - -180.0::DOUBLE) / 360.0::DOUBLE * 1.0::DOUBLE + 0.0::DOUBLE)"

# per (mmsi, hour) unit-vector means in reference mode (scaled coordinates)
HOURLY_REF = f"""
  SELECT mmsi, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         count(ts) AS n_points, min(ts) AS first_ts,
         avg(cos(radians(slat)) * cos(radians(slon))) AS ax,
         avg(cos(radians(slat)) * sin(radians(slon))) AS ay,
         avg(sin(radians(slat))) AS az
  FROM (SELECT mmsi, ts, {LAT_N} AS slat, {LON_N} AS slon FROM ({FILTERED}) f
        WHERE ts IS NOT NULL) s
  GROUP BY mmsi, time_bucket(INTERVAL 1 HOUR, ts)"""

BINARY_TARGETS = """
  SELECT l.doc_id AS id, 'quality' AS target, CAST(l.quality AS INTEGER) AS y,
         least(1.0::DOUBLE, d.n_chars / 20000.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
  UNION ALL
  SELECT l.doc_id AS id, 'toxic' AS target, CAST(l.toxic AS INTEGER) AS y,
         least(1.0::DOUBLE, d.n_chars / 20000.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

BINARY = """
  SELECT l.doc_id AS id, CAST(l.quality AS INTEGER) AS y,
         least(1.0::DOUBLE, d.n_chars / 20000.0::DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""

CLASS_PRED = """
  SELECT vec_id AS id, label AS y,
         CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS yhat, s AS scores
  FROM (SELECT vec_id, label, list_transform(range(10), lambda c: list_reduce(list_prepend(0.0::DOUBLE,
               list_transform(list_filter(range(len(embedding)), lambda i: i % 10 = c),
                              lambda i: CAST(embedding[i + 1] AS DOUBLE))), lambda a, b: a + b)) AS s
        FROM embeddings)"""

CONV_STEPS = """
  SELECT conv_id AS seq_id, turn AS step, CAST(length(text) AS DOUBLE) AS value,
         CAST(floor(conv_id / 32) AS BIGINT) AS batch_id
  FROM conversations"""

ALIGN_LENS = f"""
  SELECT seq_id, batch_id, seq_len, max(seq_len) OVER (PARTITION BY batch_id) AS batch_len
  FROM (SELECT seq_id, batch_id, CAST(max(step) + 1 AS BIGINT) AS seq_len
        FROM ({CONV_STEPS}) GROUP BY seq_id, batch_id)"""

ALIGN_DENSE = f"""
  SELECT g.seq_id, g.batch_id, g.pos, coalesce(c.value, 0.0) AS value,
         CASE WHEN c.seq_id IS NULL THEN 0 ELSE 1 END AS mask
  FROM (SELECT seq_id, batch_id, batch_len, seq_len,
               CAST(unnest(range(batch_len)) AS BIGINT) AS pos FROM ({ALIGN_LENS})) g
  LEFT JOIN (SELECT s.seq_id, s.value, s.step + l.batch_len - l.seq_len AS pos
             FROM ({CONV_STEPS}) s JOIN ({ALIGN_LENS}) l ON s.seq_id = l.seq_id) c
    ON g.seq_id = c.seq_id AND g.pos = c.pos"""


def _bin(score: str) -> str:
    """How many of the thresholds 0, 0.01 .. 1 the score reaches, minus one."""
    return (f"CAST(list_sum(list_transform(range(101), lambda k: CAST({score} >= k / 100.0::DOUBLE AS INTEGER)))"
            " AS INTEGER) - 1")


def _auc_exact(src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
  WITH src AS ({src}),
  ps AS (SELECT {k}, score, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
                CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
         FROM src WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY {k}, score),
  pr AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {k} ORDER BY score
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_lt FROM ps),
  r AS (SELECT {k}, sum(pos * (neg_lt + 0.5 * neg)) AS u, sum(pos) AS n_pos, sum(neg) AS n_neg
        FROM pr GROUP BY {k})
  SELECT {k}, CASE WHEN n_pos > 0 AND n_neg > 0 THEN round(u / (n_pos * n_neg), 6) END AS auc,
         CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg FROM r"""


def _roc(src: str, keys: list[str]) -> str:
    """Thresholded ROC rows: keys, bin, tp, fp, tpr, fpr (unrounded)."""
    k = ", ".join(keys)
    return f"""
  WITH src AS ({src}),
  h AS (SELECT {k}, {_bin('score')} AS bin,
               CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
               CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
        FROM src WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
  tot AS (SELECT {k}, sum(pos) AS p, sum(neg) AS n FROM h GROUP BY {k}),
  g AS (SELECT {k}, CAST(unnest(range(101)) AS INTEGER) AS bin FROM tot),
  c AS (SELECT g.{keys[0]}{''.join(f', g.{x}' for x in keys[1:])}, g.bin,
               sum(coalesce(h.pos, 0)) OVER (PARTITION BY {', '.join('g.' + x for x in keys)}
                   ORDER BY g.bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(coalesce(h.neg, 0)) OVER (PARTITION BY {', '.join('g.' + x for x in keys)}
                   ORDER BY g.bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
        FROM g LEFT JOIN h ON {' AND '.join(f'g.{x} = h.{x}' for x in keys)} AND g.bin = h.bin)
  SELECT c.*, CASE WHEN tot.p > 0 THEN c.tp / tot.p END AS tpr,
         CASE WHEN tot.n > 0 THEN c.fp / tot.n END AS fpr
  FROM c JOIN tot ON {' AND '.join(f'c.{x} = tot.{x}' for x in keys)}"""


def _trapezoid(roc: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""
  SELECT {k}, CASE WHEN bool_and(tpr IS NOT NULL) AND bool_and(fpr IS NOT NULL)
                   THEN round(sum(a), 6) END AS auc
  FROM (SELECT {k}, tpr, fpr,
               (fpr - coalesce(lead(fpr) OVER (PARTITION BY {k} ORDER BY bin), 0.0))
               * (tpr + coalesce(lead(tpr) OVER (PARTITION BY {k} ORDER BY bin), 0.0)) / 2 AS a
        FROM ({roc}))
  GROUP BY {k}"""


def _regression(src: str, col: str) -> str:
    return f"""
  SELECT {col}, count(*) AS n, round(avg((truth - prediction) * (truth - prediction)), 6) AS mse,
         round(avg(abs(truth - prediction)), 6) AS mae,
         round(sqrt(avg((truth - prediction) * (truth - prediction))), 6) AS rmse,
         round(CASE WHEN var_pop(truth) * count(truth) > 0 THEN
               sum((truth - prediction) * (truth - prediction)) / (var_pop(truth) * count(truth)) END, 6) AS rse,
         round(CASE WHEN var_pop(truth) * count(truth) > 0 AND stddev_pop(truth) * stddev_pop(prediction) <> 0
               THEN covar_pop(truth, prediction) / (stddev_pop(truth) * stddev_pop(prediction)) END, 6) AS correlation,
         round(1 - CASE WHEN var_pop(truth) * count(truth) > 0 THEN
               sum((truth - prediction) * (truth - prediction)) / (var_pop(truth) * count(truth)) END, 6) AS r2
  FROM ({src}) GROUP BY {col}"""


TRAJ = f"""
  SELECT mmsi,
         CAST(row_number() OVER (PARTITION BY mmsi ORDER BY window_start) - 1 AS BIGINT) AS step,
         window_start, n_points, first_ts,
         round(degrees(atan2(az, sqrt(ax * ax + ay * ay))), 6) AS lat,
         round(degrees(atan2(ay, ax)), 6) AS lon,
         count(*) OVER (PARTITION BY mmsi) AS seq_len
  FROM ({HOURLY_REF})
  QUALIFY count(*) OVER (PARTITION BY mmsi) > 7"""

DAYS = "(SELECT datediff('day', min(CAST(ts AS DATE)), max(CAST(ts AS DATE))) + 1 FROM events)"
WARM = f"({DAYS} * 2 // 3)"

DAILY = f"""
  WITH s AS (
    SELECT user_id, event_type, sum(value / 100.0::DOUBLE) AS v,
           CAST(datediff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS BIGINT) AS day
    FROM events GROUP BY ALL),
  u AS (SELECT user_id, CAST(unnest(range({DAYS})) AS BIGINT) AS day,
               (SELECT list(t ORDER BY t) FROM (SELECT DISTINCT event_type AS t FROM events)) AS types
        FROM (SELECT DISTINCT user_id FROM events)),
  g AS (SELECT user_id, day, unnest(types) AS event_type, CAST(unnest(range(len(types))) AS INTEGER) AS cell FROM u)
  SELECT g.user_id, g.day, g.cell, coalesce(s.v, 0.0) AS v
  FROM g LEFT JOIN s ON g.user_id = s.user_id AND g.day = s.day AND g.event_type = s.event_type"""

ROLLOUT = f"""
  WITH h AS (SELECT user_id, v AS y0, cell, CAST(unnest(range({DAYS} - {WARM})) AS BIGINT) AS k
             FROM ({DAILY}) WHERE day = {WARM} - 1)
  SELECT user_id, k, cell,
         round(pow(0.6, k + 2) * y0 + 10.0 * (1 - pow(0.6, k + 2)) / (1 - 0.6), 6) AS prediction
  FROM h"""

TRUTH = f"SELECT user_id, day - {WARM} AS k, cell, v AS truth FROM ({DAILY}) WHERE day >= {WARM}"

CONV_TARGETS = f"""
  WITH st AS (
    SELECT conv_id AS seq_id, turn AS step, CAST(role = 'assistant' AS INTEGER) AS y1,
           CAST(length(text) > 500 AS INTEGER) AS y2,
           least(1.0::DOUBLE, length(text) / 2000.0::DOUBLE) AS score,
           CAST(floor(conv_id / 32) AS BIGINT) AS batch_id FROM conversations),
  lens AS (SELECT seq_id, batch_id, seq_len, max(seq_len) OVER (PARTITION BY batch_id) AS batch_len
           FROM (SELECT seq_id, batch_id, CAST(max(step) + 1 AS BIGINT) AS seq_len FROM st GROUP BY ALL)),
  g AS (SELECT seq_id, CAST(unnest(range(batch_len)) AS BIGINT) AS pos FROM lens),
  r AS (SELECT st.seq_id, st.step + lens.batch_len - lens.seq_len AS pos, y1, y2, score
        FROM st JOIN lens ON st.seq_id = lens.seq_id),
  dense AS (SELECT g.seq_id, g.pos, CASE WHEN r.seq_id IS NULL THEN 0 ELSE 1 END AS mask,
                   coalesce(y1, 0) AS y1, coalesce(y2, 0) AS y2, coalesce(score, 0.0) AS score
            FROM g LEFT JOIN r ON g.seq_id = r.seq_id AND g.pos = r.pos)
  SELECT seq_id, pos, mask, 'y1' AS target, y1 AS y, score FROM dense
  UNION ALL SELECT seq_id, pos, mask, 'y2', y2, score FROM dense"""

RECON = """
  WITH cells AS (SELECT vec_id, label, CAST(unnest(range(64)) AS INTEGER) AS i,
                        CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
  cent AS (SELECT label, i, avg(v) AS m FROM cells GROUP BY label, i)
  SELECT c.vec_id AS id, c.label, round(sum((c.v - cent.m) * (c.v - cent.m)) / 64, 6) AS score
  FROM cells c JOIN cent ON c.label = cent.label AND c.i = cent.i
  GROUP BY c.vec_id, c.label"""

ORACLE: dict[str, str] = {}

ORACLE["hourly_trajectories"] = TRAJ

ORACLE["hourly_window_reduce"] = f"""
  SELECT mmsi, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(ts) AS n_points, min(ts) AS first_ts,
         round((degrees(atan2(avg(sin(radians(lat))),
                sqrt(avg(cos(radians(lat)) * cos(radians(lon))) * avg(cos(radians(lat)) * cos(radians(lon)))
                   + avg(cos(radians(lat)) * sin(radians(lon))) * avg(cos(radians(lat)) * sin(radians(lon))))))
                - -90.0::DOUBLE) / 180.0::DOUBLE * 1.0::DOUBLE + 0.0::DOUBLE, 6) AS lat,
         round((degrees(atan2(avg(cos(radians(lat)) * sin(radians(lon))), avg(cos(radians(lat)) * cos(radians(lon)))))
                - -180.0::DOUBLE) / 360.0::DOUBLE * 1.0::DOUBLE + 0.0::DOUBLE, 6) AS lon
  FROM ({FILTERED}) f WHERE ts IS NOT NULL
  GROUP BY mmsi, time_bucket(INTERVAL 1 HOUR, ts)"""

ORACLE["geo_average"] = f"""
  SELECT mmsi, count(*) AS n,
         round(degrees(atan2(avg(sin(radians(slat))),
               sqrt(avg(cos(radians(slat)) * cos(radians(slon))) * avg(cos(radians(slat)) * cos(radians(slon)))
                  + avg(cos(radians(slat)) * sin(radians(slon))) * avg(cos(radians(slat)) * sin(radians(slon)))))), 6) AS lat_ref,
         round(degrees(atan2(avg(cos(radians(slat)) * sin(radians(slon))), avg(cos(radians(slat)) * cos(radians(slon))))), 6) AS lon_ref,
         round(degrees(atan2(avg(sin(radians(lat))),
               sqrt(avg(cos(radians(lat)) * cos(radians(lon))) * avg(cos(radians(lat)) * cos(radians(lon)))
                  + avg(cos(radians(lat)) * sin(radians(lon))) * avg(cos(radians(lat)) * sin(radians(lon)))))), 6) AS lat_geo,
         round(degrees(atan2(avg(cos(radians(lat)) * sin(radians(lon))), avg(cos(radians(lat)) * cos(radians(lon))))), 6) AS lon_geo
  FROM (SELECT mmsi, lat, lon, {LAT_N} AS slat, {LON_N} AS slon FROM ({FILTERED}) f) s
  GROUP BY mmsi"""

ORACLE["sequence_stats"] = f"""
  SELECT mmsi, count(t) AS num_positions, min(t) AS min_time, max(t) AS max_time,
         max(t) - min(t) AS total_time
  FROM (SELECT mmsi, epoch_us(ts) // 1000 AS t FROM ({POSITIONS}) p) GROUP BY mmsi"""

ORACLE["to_sequences"] = f"""
  SELECT mmsi, event_id,
         CAST(row_number() OVER (PARTITION BY mmsi ORDER BY ts, event_id) - 1 AS BIGINT) AS step,
         count(*) OVER (PARTITION BY mmsi) AS seq_len
  FROM ({FILTERED}) f"""

ORACLE["min_length_filter"] = f"""
  SELECT mmsi, window_start, n_points FROM ({HOURLY_REF})
  QUALIFY count(*) OVER (PARTITION BY mmsi) > 7"""

ORACLE["keep_columns"] = f"SELECT ts, mmsi, lat, lon FROM ({POSITIONS}) p"

ORACLE["column_range_features"] = """
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem"""

ORACLE["geo_outlier_filter"] = f"SELECT event_id, mmsi, lat, lon FROM ({FILTERED}) f"

ORACLE["index_range_split"] = """
  SELECT conv_id, turn,
         CASE WHEN conv_id <= floor((SELECT max(conv_id) FROM conversations) * 0.8::DOUBLE)
              THEN 'train' ELSE 'validation' END AS split
  FROM conversations"""

ORACLE["minmax_normalize"] = f"SELECT event_id, {LAT_N} AS lat_n, {LON_N} AS lon_n FROM ({FILTERED}) f"

ORACLE["number_to_string"] = f"""
  SELECT event_id, printf('%.6f', {LAT_N}) AS lat_text, printf('%.6f', {LON_N}) AS lon_text
  FROM ({FILTERED}) f"""

ORACLE["parse_timestamp"] = """
  SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS ts_text,
         epoch_ms(try_strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S')) AS ts_ms
  FROM events"""

ORACLE["concat_columns"] = f"""
  SELECT event_id, printf('%.6f', {LAT_N}) || ',' || printf('%.6f', {LON_N}) AS latlon
  FROM ({FILTERED}) f"""

ORACLE["split_to_doubles"] = f"""
  SELECT event_id, TRY_CAST(string_split(txt, ',')[1] AS DOUBLE) AS a,
         TRY_CAST(string_split(txt, ',')[2] AS DOUBLE) AS b
  FROM (SELECT event_id, printf('%.6f', lat) || ',' || printf('%.6f', lon) AS txt FROM ({FILTERED}) f)"""

ORACLE["geo_to_xyz"] = f"""
  SELECT event_id, round(x, 9) + 0.0 AS x, round(y, 9) + 0.0 AS y, round(z, 9) + 0.0 AS z,
         round(degrees(atan2(z, sqrt(x * x + y * y))), 6) + 0.0 AS lat_back,
         round(degrees(atan2(y, x)), 6) + 0.0 AS lon_back
  FROM (SELECT event_id, cos(radians(lat)) * cos(radians(lon)) AS x,
               cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z FROM ({FILTERED}) f)"""

ORACLE["one_hot"] = """
  SELECT doc_id, cls, CAST(cls = quality AS INTEGER) AS v
  FROM (SELECT doc_id, quality, CAST(unnest(range(2)) AS INTEGER) AS cls FROM labels)"""

ORACLE["argmax"] = f"SELECT id, y, yhat FROM ({CLASS_PRED})"

ORACLE["step_slice"] = f"SELECT seq_id, step, value FROM ({CONV_STEPS}) WHERE step >= 2 AND step < 5"

ORACLE["reshape_grid"] = """
  SELECT vec_id, true AS round_trip, CAST(i // 8 AS INTEGER) AS r, CAST(i % 8 AS INTEGER) AS c,
         CAST(embedding[i + 1] AS DOUBLE) AS v
  FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM embeddings)"""

ORACLE["last_valid_step"] = f"""
  SELECT seq_id, CAST(max(CASE WHEN mask <> 0 THEN pos END) AS BIGINT) AS last_step
  FROM ({ALIGN_DENSE}) GROUP BY seq_id"""

ORACLE["positional_zip"] = """
  SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_no,
         CAST(event_type = 'purchase' AS INTEGER) AS label,
         round(value, 9) AS f1, round(CAST(user_id AS DOUBLE), 9) AS f2,
         round(CAST(hour(ts) AS DOUBLE), 9) AS f3, round(value * 2.0::DOUBLE, 9) AS f4,
         round(CAST(minute(ts) AS DOUBLE), 9) AS f5, round(CAST(second(ts) AS DOUBLE), 9) AS f6,
         round(CAST(length(props) AS DOUBLE), 9) AS f7, round(CAST(day(ts) AS DOUBLE), 9) AS f8,
         round(CAST(event_id % 7 AS DOUBLE), 9) AS f9, round(sqrt(value), 9) AS f10,
         round(ln(1 + value), 9) AS f11, round(value / 10.0::DOUBLE, 9) AS f12,
         round(CAST(user_id % 3 AS DOUBLE), 9) AS f13, round(CAST(user_id % 5 AS DOUBLE), 9) AS f14,
         round(CAST(user_id % 11 AS DOUBLE), 9) AS f15
  FROM events"""

ORACLE["join_features_labels"] = f"""
  SELECT s.seq_id, s.step, s.value, l.label
  FROM ({CONV_STEPS}) s
  JOIN (SELECT seq_id, CAST(max(step) >= 4 AS INTEGER) AS label FROM ({CONV_STEPS}) GROUP BY seq_id) l
    ON s.seq_id = l.seq_id"""

ORACLE["align_end"] = f"""
  SELECT s.seq_id, s.batch_id, s.step, s.step + l.batch_len - l.seq_len AS pos, s.value, 1 AS mask
  FROM ({CONV_STEPS}) s JOIN ({ALIGN_LENS}) l ON s.seq_id = l.seq_id"""

ORACLE["align_end_dense"] = ALIGN_DENSE

ORACLE["reconstruction_score"] = RECON

ORACLE["rank_by_label"] = f"""
  SELECT id, label, score,
         CAST(row_number() OVER (PARTITION BY label ORDER BY score, id) AS BIGINT) AS rank
  FROM ({RECON})"""

ORACLE["best_worst_by_label"] = f"""
  SELECT id, label, score, pos, kind FROM (
    SELECT id, label, score,
           CAST(row_number() OVER (PARTITION BY label ORDER BY score, id) AS BIGINT) AS pos, 'best' AS kind
    FROM ({RECON})) WHERE pos <= 5
  UNION ALL
  SELECT id, label, score, pos, kind FROM (
    SELECT id, label, score,
           CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, id DESC) AS BIGINT) AS pos,
           'worst' AS kind
    FROM ({RECON})) WHERE pos <= 5"""

ORACLE["hash_split"] = f"""
  SELECT mmsi, count(*) AS seq_len,
         CASE WHEN CAST(('0x' || substr(md5(mmsi), 1, 8)) AS BIGINT) % 100 < 80
              THEN 'train' ELSE 'test' END AS split
  FROM ({TRAJ}) GROUP BY mmsi"""

ORACLE["batch_split"] = """
  WITH b AS (SELECT event_id, value,
                    CAST((row_number() OVER (ORDER BY event_id) - 1) // 300 AS BIGINT) AS batch_id
             FROM events)
  SELECT event_id, value, batch_id,
         CASE WHEN row_number() OVER (PARTITION BY batch_id ORDER BY event_id)
                   <= greatest(floor(count(*) OVER (PARTITION BY batch_id) * 0.8::DOUBLE), 1)
              THEN 'train' ELSE 'validation' END AS split
  FROM b"""

ORACLE["mini_batches"] = """
  SELECT vec_id, label, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 32 AS BIGINT) AS batch_id
  FROM embeddings"""

ORACLE["seq2seq_tokens"] = f"""
  WITH t AS (SELECT mmsi AS seq_id, step, unnest([0, 1]) AS channel, unnest([lat, lon]) AS value
             FROM ({TRAJ}))
  SELECT seq_id, 'decoder' AS tensor, step + 1 AS pos, channel, value FROM t
  UNION ALL SELECT seq_id, 'label', step, channel, value FROM t
  UNION ALL SELECT seq_id, 'decoder', CAST(0 AS BIGINT), 2, 1.0::DOUBLE FROM t GROUP BY seq_id
  UNION ALL SELECT seq_id, 'label', max(step), 2, 1.0::DOUBLE FROM t GROUP BY seq_id"""

ORACLE["seq2seq_masks"] = f"""
  SELECT seq_id, pos + 1 AS pos, mask FROM ({ALIGN_DENSE})
  UNION ALL SELECT DISTINCT seq_id, CAST(0 AS BIGINT), 1 FROM ({ALIGN_DENSE})"""

ORACLE["batch_predict"] = """
  SELECT id, round(1.0 / (1.0 + exp(-z)), 6) AS score, CAST(1.0 / (1.0 + exp(-z)) >= 0.5 AS INTEGER) AS yhat
  FROM (SELECT vec_id AS id,
               list_sum(list_transform(range(64), lambda i: CAST(embedding[i + 1] AS DOUBLE)
                        * (((i % 7) - 3) / 10.0::DOUBLE))) + 0.1::DOUBLE AS z
        FROM embeddings)"""

ORACLE["rollout_forecast"] = ROLLOUT

ORACLE["confusion_matrix"] = f"SELECT y, yhat, count(*) AS n FROM ({CLASS_PRED}) GROUP BY y, yhat"

ORACLE["classification_metrics"] = f"""
  WITH conf AS (SELECT y, yhat, count(*) AS n FROM ({CLASS_PRED}) GROUP BY y, yhat),
  cls AS (SELECT y AS cls FROM conf UNION SELECT yhat FROM conf),
  per AS (
    SELECT c.cls, coalesce(a.actual, 0) AS actual, coalesce(p.predicted, 0) AS predicted,
           coalesce(t.tp, 0) AS tp
    FROM cls c
    LEFT JOIN (SELECT y AS cls, sum(n) AS actual FROM conf GROUP BY y) a ON a.cls = c.cls
    LEFT JOIN (SELECT yhat AS cls, sum(n) AS predicted FROM conf GROUP BY yhat) p ON p.cls = c.cls
    LEFT JOIN (SELECT y AS cls, n AS tp FROM conf WHERE y = yhat) t ON t.cls = c.cls),
  m AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted END AS precision,
               CASE WHEN actual > 0 THEN tp / actual END AS recall FROM per)
  SELECT round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(precision), 6) AS precision,
         round(avg(recall), 6) AS recall,
         round(avg(CASE WHEN precision IS NOT NULL AND recall IS NOT NULL THEN
                   CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                        ELSE 0.0 END END), 6) AS f1,
         CAST(sum(actual) AS BIGINT) AS n
  FROM m"""

ORACLE["auc_exact"] = _auc_exact(BINARY_TARGETS, ["target"])

ORACLE["roc_thresholded"] = f"""
  SELECT round(bin / 100.0::DOUBLE, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
         round(tpr, 6) AS tpr, round(fpr, 6) AS fpr
  FROM ({_roc(f"SELECT 0 AS g, * FROM ({BINARY})", ["g"])})"""

ORACLE["auc_thresholded"] = _trapezoid(_roc(BINARY_TARGETS, ["target"]), ["target"])

ORACLE["auc_one_vs_all"] = _auc_exact(f"""
  SELECT cls, CAST(y = cls AS INTEGER) AS y, score FROM (
    SELECT y, CAST(unnest(range(10)) AS INTEGER) AS cls, unnest(scores) AS score FROM ({CLASS_PRED}))""",
                                      ["cls"])

ORACLE["running_auc"] = f"""
  WITH src AS (SELECT CAST((row_number() OVER (ORDER BY event_id) - 1) // 32 AS BIGINT) AS batch_id,
                      CAST(event_type = 'purchase' AS INTEGER) AS y,
                      least(1.0::DOUBLE, value / 300.0::DOUBLE) AS score FROM events),
  h AS (SELECT batch_id, {_bin('score')} AS bin,
               sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
        FROM src GROUP BY ALL),
  g AS (SELECT batch_id, CAST(unnest(range(-1, 101)) AS INTEGER) AS bin FROM (SELECT DISTINCT batch_id FROM h)),
  cum AS (SELECT g.batch_id, g.bin,
                 sum(coalesce(h.pos, 0)) OVER (PARTITION BY g.bin ORDER BY g.batch_id) AS pos,
                 sum(coalesce(h.neg, 0)) OVER (PARTITION BY g.bin ORDER BY g.batch_id) AS neg
          FROM g LEFT JOIN h ON g.batch_id = h.batch_id AND g.bin = h.bin),
  tot AS (SELECT batch_id, sum(pos) AS p, sum(neg) AS n FROM cum GROUP BY batch_id),
  roc AS (SELECT c.batch_id, c.bin,
                 CASE WHEN tot.p > 0 THEN sum(c.pos) OVER (PARTITION BY c.batch_id ORDER BY c.bin DESC
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / tot.p END AS tpr,
                 CASE WHEN tot.n > 0 THEN sum(c.neg) OVER (PARTITION BY c.batch_id ORDER BY c.bin DESC
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / tot.n END AS fpr
          FROM cum c JOIN tot ON c.batch_id = tot.batch_id)
  {_trapezoid("SELECT * FROM roc WHERE bin >= 0", ["batch_id"]).replace("SELECT batch_id,", "SELECT batch_id,", 1)}"""

ORACLE["timeseries_auc"] = _auc_exact(f"SELECT * FROM ({CONV_TARGETS}) WHERE mask = 1", ["target"])

ORACLE["timeseries_auc_padded"] = _auc_exact(CONV_TARGETS, ["target"])

ORACLE["regression_metrics"] = _regression("""
  SELECT CAST(l_linenumber AS INTEGER) AS col, l_extendedprice / 100000.0::DOUBLE AS truth,
         l_quantity / 50.0::DOUBLE AS prediction FROM lineitem""", "col")

ORACLE["forecast_metrics"] = _regression(f"""
  SELECT f.cell, t.truth, f.prediction
  FROM ({ROLLOUT}) f JOIN ({TRUTH}) t ON f.user_id = t.user_id AND f.k = t.k AND f.cell = t.cell""", "cell")

# ---------------------------------------------------------- sources -----
POSITIONS_SEC = POSITIONS.replace(" ts,\n", " date_trunc('second', ts) AS ts,\n")
assert POSITIONS_SEC != POSITIONS

ORACLE["scan_csv_inferred"] = f"""
  SELECT mmsi, epoch_us(date_trunc('second', ts)) // 1000 AS ts_ms, lat, lon FROM ({POSITIONS}) p"""

ORACLE["scan_csv_schema"] = f"""
  SELECT p.mmsi, epoch_us(date_trunc('second', p.ts)) // 1000 AS ts_ms, p.lat, p.lon,
         CAST(CASE WHEN e.event_id % 10 <> 0 THEN (e.event_id * 7) % 360 END AS DOUBLE) AS heading,
         CAST(NULL AS DOUBLE) AS draught, CAST(e.user_id % 30 + 5 AS INTEGER) AS width
  FROM ({POSITIONS}) p JOIN events e ON p.event_id = e.event_id"""

ORACLE["trajectories_from_csv"] = f"""
  SELECT *, CASE WHEN CAST(('0x' || substr(md5(mmsi), 1, 8)) AS BIGINT) % 100 < 80
                 THEN 'train' ELSE 'test' END AS split
  FROM ({TRAJ.replace(POSITIONS, POSITIONS_SEC)})"""

ORACLE["scan_numbered_sequences"] = """
  SELECT conv_id AS sample_id, turn AS step, CAST(length(text) AS DOUBLE) AS value,
         CAST(role = 'assistant' AS DOUBLE) AS assistant
  FROM conversations"""

ORACLE["scan_rows_numbered"] = """
  SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_no,
         CAST(event_id AS DOUBLE) AS c0, value AS c1, CAST(user_id AS DOUBLE) AS c2
  FROM events"""

ORACLE["scan_vectors"] = """
  SELECT vec_id AS id, label, CAST(len(embedding) AS INTEGER) AS dim,
         round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS l2
  FROM embeddings"""

ORACLE["save_and_reload_sequences"] = f"""
  SELECT *, CASE WHEN CAST(('0x' || substr(md5(mmsi), 1, 8)) AS BIGINT) % 100 < 80
                 THEN 'train' ELSE 'test' END AS split
  FROM ({TRAJ})"""

# ----------------------------------------------------------- models -----
ORACLE["forecaster_gram"] = f"""
  WITH d AS ({DAILY}),
  x AS (SELECT user_id, day, cell, v FROM d WHERE day < {DAYS} - 1
        UNION ALL SELECT DISTINCT user_id, day, (SELECT max(cell) + 1 FROM d), 1.0 FROM d WHERE day < {DAYS} - 1)
  SELECT 'xx' AS kind, a.cell AS i, b.cell AS j, round(avg(a.v * b.v), 6) AS value
  FROM x a JOIN x b ON a.user_id = b.user_id AND a.day = b.day GROUP BY a.cell, b.cell
  UNION ALL
  SELECT 'xy', a.cell, b.cell, round(avg(a.v * b.v), 6)
  FROM x a JOIN d b ON a.user_id = b.user_id AND b.day = a.day + 1 GROUP BY a.cell, b.cell"""

_TEST = "CAST(('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 >= 80"

ORACLE["train_vector_classifier"] = f"""
  SELECT vec_id AS id, CAST(embedding[1] > 0 AS INTEGER) + 2 * CAST(embedding[2] > 0 AS INTEGER) AS y,
         true AS beats_frequencies FROM embeddings WHERE {_TEST.format('vec_id')}"""

ORACLE["train_fused_classifier"] = f"""
  SELECT row_no, y, true AS beats_frequencies
  FROM (SELECT CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS row_no,
               CAST(hour(ts) >= 12 AS INTEGER) AS y FROM events)
  WHERE {_TEST.format('row_no')}"""

ORACLE["train_sequence_classifier"] = f"""
  SELECT conv_id AS seq_id, CAST(max(turn) >= 4 AS INTEGER) AS y, true AS beats_frequencies
  FROM conversations WHERE {_TEST.format('conv_id')} GROUP BY conv_id"""

ORACLE["train_multitask"] = f"""
  WITH t AS (SELECT 'y1' AS target, length(text) > 500 AS y FROM conversations WHERE {_TEST.format('conv_id')}
             UNION ALL SELECT 'y2', turn >= 2 FROM conversations WHERE {_TEST.format('conv_id')})
  SELECT target, count(*) FILTER (y) AS n_pos, count(*) FILTER (NOT y) AS n_neg, true AS beats_chance
  FROM t GROUP BY target"""

ORACLE["train_reconstruction"] = "SELECT vec_id AS id, label, true AS closer_than_mean FROM embeddings"

ORACLE["train_forecaster"] = f"SELECT cell, count(*) AS n, true AS near_mean FROM ({TRUTH}) GROUP BY cell"

ORACLE["comparator_order"] = f"""
  SELECT mmsi, count(ts) AS num_positions,
         row_number() OVER (ORDER BY CAST(split_part(mmsi, '-', 1) AS BIGINT), split_part(mmsi, '-', 2)) - 1 AS pos
  FROM ({POSITIONS}) p GROUP BY mmsi"""

ORACLE["profile_csv"] = """
  WITH n AS (SELECT count(*) AS n FROM events)
  SELECT unnest(['# Timestamp', 'MMSI', 'Latitude', 'Longitude']) AS "column", unnest([0, 1, 2, 3]) AS place,
         unnest(['string', 'string', 'double', 'double']) AS type, unnest([n, n, n, n]) AS cells,
         unnest([0::BIGINT, 0, 0, 0]) AS empty, unnest([0::BIGINT, n, 0, 0]) AS bad
  FROM n"""

ORACLE["lookup_sequences"] = f"""
  WITH t AS ({TRAJ}),
  w AS (SELECT max({{'n': seq_len, 'm': mmsi}}).m AS mmsi FROM t GROUP BY string_split(mmsi, '-')[-1])
  SELECT t.* FROM t JOIN w ON t.mmsi = w.mmsi"""

ORACLE["stencil_gram"] = """
  WITH e AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
  p AS (SELECT a.vec_id, a.x, b.x AS y FROM e a JOIN e b ON b.vec_id = a.vec_id + 1),
  c AS (SELECT x, y, unnest(range(64)) AS cell FROM p),
  t AS (SELECT y[cell + 1] AS target, list_concat(list_transform(range(9), lambda o:
               CASE WHEN cell // 8 + o // 3 - 1 BETWEEN 0 AND 7 AND cell % 8 + o % 3 - 1 BETWEEN 0 AND 7
                    THEN x[CAST(cell + 8 * (o // 3 - 1) + o % 3 - 1 + 1 AS BIGINT)] ELSE 0.0 END), [1.0::DOUBLE]) AS f FROM c),
  i AS (SELECT target, f, CAST(unnest(range(10)) AS INTEGER) AS i FROM t)
  SELECT 'xx' AS kind, i, CAST(j AS INTEGER) AS j, round(avg(f[i + 1] * f[j + 1]), 6) AS value
  FROM (SELECT f, i, unnest(range(10)) AS j FROM i) GROUP BY i, j
  UNION ALL SELECT 'xy', i, 0, round(avg(f[i + 1] * target), 6) FROM i GROUP BY i"""

ORACLE["recurrent_state"] = """
  WITH RECURSIVE s AS (
    SELECT conv_id AS seq_id, turn AS step, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n,
           length(text) / 1000.0::DOUBLE AS v, CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS b,
           least(1.0::DOUBLE, length(text) / 1000.0::DOUBLE / 1.001::DOUBLE) AS g FROM conversations),
  r AS (
    SELECT seq_id, step, n, (1 - 2 / 3::DOUBLE) * v AS v0, (1 - 6 / 7::DOUBLE) * v AS v1, g * v AS vg,
           (1 - 2 / 3::DOUBLE) * b AS b0, (1 - 6 / 7::DOUBLE) * b AS b1, g * b AS bg FROM s WHERE n = 1
    UNION ALL
    SELECT s.seq_id, s.step, s.n, 2 / 3::DOUBLE * r.v0 + (1 - 2 / 3::DOUBLE) * s.v, 6 / 7::DOUBLE * r.v1 + (1 - 6 / 7::DOUBLE) * s.v,
           (1 - s.g) * r.vg + s.g * s.v, 2 / 3::DOUBLE * r.b0 + (1 - 2 / 3::DOUBLE) * s.b,
           6 / 7::DOUBLE * r.b1 + (1 - 6 / 7::DOUBLE) * s.b, (1 - s.g) * r.bg + s.g * s.b
    FROM r JOIN s ON s.seq_id = r.seq_id AND s.n = r.n + 1)
  SELECT seq_id, step, round(v0, 6) AS value_r0, round(v1, 6) AS value_r1, round(vg, 6) AS value_gate,
         round(b0, 6) AS blanks_r0, round(b1, 6) AS blanks_r1, round(bg, 6) AS blanks_gate FROM r"""

ORACLE["rollout_resumed"] = f"""
  WITH RECURSIVE d AS MATERIALIZED ({DAILY}),
  size AS MATERIALIZED (SELECT {WARM} AS warm, {DAYS} AS days),
  r AS (
    SELECT user_id, cell, 0::BIGINT AS n, (1 - 0.8::DOUBLE) * v AS s, 0.9::DOUBLE * ((1 - 0.8::DOUBLE) * v) + 1.5 AS y
    FROM d WHERE day = 0
    UNION ALL
    SELECT user_id, cell, n, s, 0.9::DOUBLE * s + 1.5 AS y FROM (
      SELECT r.user_id, r.cell, r.n + 1 AS n, (1 - 0.8::DOUBLE) * CASE WHEN r.n + 1 < warm THEN d.v ELSE r.y END
             + 0.8::DOUBLE * r.s AS s
      FROM r JOIN d ON d.user_id = r.user_id AND d.cell = r.cell AND d.day = r.n + 1, size WHERE r.n + 1 < days + 1)
  ),
  f AS (SELECT r.*, warm FROM r, size)
  SELECT user_id, n - warm AS k, cell, round(y, 6) AS prediction FROM f WHERE n >= warm"""

ORACLE["score_history"] = """
  SELECT count(*) AS rows, true AS never_rises, true AS falls, true AS within_limit FROM embeddings"""

ORACLE["scan_csv_bad_cells"] = """
  SELECT unnest(['Timestamp', 'VesselType', 'MMSI', 'Lat', 'Lon', 'Status', 'ROT', 'SOG', 'COG', 'Heading', 'IMO',
                 'Callsign', 'Name', 'Shiptype', 'Cargotype', 'Width', 'Length', 'FixingDevice', 'Draught',
                 'Destination', 'ETA', 'SourceType', 'end']) AS "column",
         unnest(list_transform(range(23), lambda i: CASE WHEN i = 5 THEN n ELSE 0 END)) AS bad
  FROM (SELECT count(*) AS n FROM events)"""

ORACLE["index_range"] = """
  SELECT conv_id, turn FROM conversations
  WHERE conv_id BETWEEN (SELECT max(conv_id) // 4 FROM conversations) AND (SELECT 3 * max(conv_id) // 4 FROM conversations)"""

ORACLE["seq2seq_tokens_all"] = f"""
  WITH t AS (SELECT mmsi AS seq_id, step, unnest([0, 1]) AS channel, unnest([lat, lon]) AS value FROM ({TRAJ}))
  SELECT seq_id, 'decoder' AS tensor, step + 1 AS pos, channel, value FROM t
  UNION ALL SELECT seq_id, 'label', step, channel, value FROM t
  UNION ALL SELECT seq_id, 'decoder', CAST(unnest(range((SELECT max(step) + 2 FROM t))) AS BIGINT), 2, 1.0::DOUBLE
            FROM (SELECT DISTINCT seq_id FROM t)
  UNION ALL SELECT seq_id, 'label', max(step), 2, 1.0::DOUBLE FROM t GROUP BY seq_id"""

ORACLE["batch_transform"] = f"""
  SELECT seq_id, step, batch_id, round(value - avg(value) OVER (PARTITION BY batch_id), 6) AS centred,
         round(value / max(value) OVER (PARTITION BY batch_id), 6) AS share
  FROM ({CONV_STEPS})"""

ORACLE["user_reducer_geo_average"] = f"""
  SELECT mmsi, n, lat_ref AS lat, lon_ref AS lon FROM ({ORACLE["geo_average"]})"""

for _n in ("to_sequences", "rank_by_label", "mini_batches", "auc_exact", "running_auc"):
    ORACLE[f"{_n}_split"] = ORACLE[_n]

ORACLE["positional_zip_csv"] = ORACLE["positional_zip"]

ORACLE["examine_positions"] = f"""
  SELECT mmsi, count(t) AS num_positions, min(t) AS min_time, max(t) AS max_time,
         max(t) - min(t) AS total_time
  FROM (SELECT mmsi, epoch_us(date_trunc('second', ts)) // 1000 AS t FROM ({POSITIONS}) p) GROUP BY mmsi"""
