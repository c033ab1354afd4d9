"""DuckDB SQL for every driver query (the correctness oracle).

Written independently of the Spark plans: plain per-key windows and
grouped aggregates over the pre-registered test tables. Column names match
``gapscan.plans.catalog``.
"""

from __future__ import annotations

RECORDS = """records AS (
  SELECT o_orderkey AS record_id, CAST(o_custkey // 4 AS BIGINT) AS group_key, o_orderstatus AS record_class,
         o_orderpriority AS source_key, o_totalprice AS amount,
         CAST(round(o_totalprice / 10000) AS INTEGER) AS x_cell,
         CAST(month(o_orderdate) AS INTEGER) AS y_cell
  FROM orders)"""

SURF = """surf AS (
  SELECT x_cell, y_cell,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS s1,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS s2,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) AS s3,
         CAST(count(*) AS DOUBLE) AS s4
  FROM lineitem JOIN records ON l_orderkey = record_id GROUP BY x_cell, y_cell)"""

SURF_LONG = """surf_long AS (
  SELECT x_cell, y_cell, 's1' AS surface, s1 AS xx FROM surf UNION ALL
  SELECT x_cell, y_cell, 's2', s2 FROM surf UNION ALL
  SELECT x_cell, y_cell, 's3', s3 FROM surf UNION ALL
  SELECT x_cell, y_cell, 's4', s4 FROM surf)"""

LONG = """long AS (
  SELECT r.group_key, r.record_id, r.x_cell, r.y_cell, u.surface, u.xx
  FROM records r JOIN surf_long u ON r.x_cell = u.x_cell AND r.y_cell = u.y_cell
  WHERE u.xx IS NOT NULL)"""


def gap_ctes(src: str, keys: list[str], value: str, name: str, min_n: int = 10) -> list[str]:
    """CTEs ending in ``{name}`` = (keys, xx, n, mx, x1, y, z, t1, median, outlier_type)."""
    k = ", ".join(keys)
    on = " AND ".join(f"a.{c} = b.{c}" for c in keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return [
        f"""{name}_d AS (SELECT DISTINCT {k}, CAST({value} AS DOUBLE) AS xx FROM {src}
             WHERE {value} IS NOT NULL AND {nn})""",
        f"""{name}_c AS (SELECT {k}, count(*) AS n, avg(xx) AS mx FROM {name}_d
             GROUP BY {k} HAVING count(*) >= {min_n})""",
        f"""{name}_r AS (
             SELECT a.*, b.n, b.mx,
                    lead(a.xx) OVER (PARTITION BY {", ".join("a." + c for c in keys)} ORDER BY a.xx) AS x1,
                    row_number() OVER (PARTITION BY {", ".join("a." + c for c in keys)} ORDER BY a.xx) AS pos
             FROM {name}_d a JOIN {name}_c b ON {on})""",
        f"""{name}_y AS (
             SELECT *, CASE WHEN xx < mx THEN (x1 - xx) * (mx - xx) ELSE (x1 - xx) * (x1 - mx) END AS y,
                    0.95 * sqrt(n) + 0.2 AS t1
             FROM {name}_r)""",
        f"""{name}_s AS (
             SELECT {k}, stddev_pop(y) AS sd,
                    max(CASE WHEN pos = CAST(ceil(n / 2.0) AS BIGINT) THEN xx END) AS median
             FROM {name}_y GROUP BY {k})""",
        f"""{name}_z AS (
             SELECT a.*, CASE WHEN b.sd > 0 THEN a.y / b.sd END AS z, b.median
             FROM {name}_y a JOIN {name}_s b ON {on})""",
        f"""{name}_b AS (
             SELECT {k},
                    max(CASE WHEN z > t1 AND xx > median THEN xx END) AS hi,
                    min(CASE WHEN z > t1 AND xx < median THEN xx END) AS lo
             FROM {name}_z GROUP BY {k})""",
        f"""{name} AS (
             SELECT a.{", a.".join(keys)}, a.xx, a.n, a.mx, a.x1, a.y, a.z, a.t1, a.median,
                    CASE WHEN a.xx >= b.hi THEN 'upper' WHEN a.xx <= b.lo THEN 'lower' END AS outlier_type
             FROM {name}_z a JOIN {name}_b b ON {on})""",
    ]


ORDERS_VALUES = "ov AS (SELECT o_custkey AS group_key, o_totalprice AS amount FROM orders)"
ORDERS_GAP = [ORDERS_VALUES, *gap_ctes("ov", ["group_key"], "amount", "og")]

FLAGS = [*gap_ctes("long", ["group_key", "surface"], "xx", "lg"),
         "flags AS (SELECT group_key, surface, xx, outlier_type FROM lg WHERE outlier_type IS NOT NULL)"]
RF = """rf AS (
  SELECT l.record_id, l.group_key, l.surface, l.xx
  FROM long l JOIN flags f ON l.group_key = f.group_key AND l.surface = f.surface AND l.xx = f.xx)"""
BASE = [RECORDS, SURF, SURF_LONG, LONG, *FLAGS, RF]

WIDE = """wide AS (
  SELECT record_id,
         max(CASE WHEN surface = 's1' THEN xx END) AS s1,
         max(CASE WHEN surface = 's2' THEN xx END) AS s2,
         max(CASE WHEN surface = 's3' THEN xx END) AS s3,
         max(CASE WHEN surface = 's4' THEN xx END) AS s4,
         count(DISTINCT surface) AS n_outliers
  FROM rf GROUP BY record_id)"""
EXPORT = """export AS (
  SELECT r.record_id, r.group_key, r.record_class, r.source_key, r.amount, r.x_cell, r.y_cell,
         w.s1, w.s2, w.s3, w.s4, w.n_outliers
  FROM records r JOIN wide w ON r.record_id = w.record_id)"""
TRUSTED = """trusted AS (
  SELECT * FROM records WHERE record_id IN (
    SELECT record_id FROM rf GROUP BY record_id HAVING count(DISTINCT surface) >= 2))"""
FLAGGED = """flagged AS (SELECT * FROM records WHERE record_id IN (SELECT record_id FROM rf))"""
LONG_LOC = """long_loc AS (
  SELECT l.*, EXISTS (SELECT 1 FROM rf WHERE rf.record_id = l.record_id AND rf.surface = l.surface) AS is_outlier
  FROM long l)"""
KEPT = """kept AS (
  SELECT * FROM long_loc a
  WHERE EXISTS (SELECT 1 FROM long_loc b WHERE b.is_outlier AND b.group_key = a.group_key
                AND b.surface = a.surface))"""
DIM = """dim AS (
  SELECT * FROM (VALUES ('s1', 'Quantity'), ('s2', 'Extended price in cents'),
                        ('s3', 'Discount in percent'), ('s4', 'Line count')) t(surface, long_name))"""
DOCS_LABELS = """dl AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _gap_out(name: str, keys: list[str]) -> str:
    return f"SELECT {', '.join(keys)}, xx, outlier_type FROM {name} WHERE outlier_type IS NOT NULL"


SQL: dict[str, str] = {
    "snap_grid": """SELECT event_id, value, CAST(round(value * 100 / 10) AS BIGINT) AS cell,
                           round(value * 100 / 10) * 10 / 100 AS snapped FROM events""",
    "prepare_records": _with([RECORDS], """
        SELECT record_id, group_key, record_class, source_key, amount,
               CAST(round(amount * 100 / 10) AS BIGINT) AS amount_cell,
               round(amount * 100 / 10) * 10 / 100 AS amount_snapped
        FROM records
        WHERE record_class <> 'P' AND source_key IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
          AND amount IS NOT NULL"""),
    "filter_range_or_null": _with([DOCS_LABELS], "SELECT * FROM dl WHERE toxic < 1 OR toxic IS NULL"),
    "drop_null_rows": _with([DOCS_LABELS], """
        SELECT doc_id, source, quality, toxic FROM dl
        WHERE doc_id IS NOT NULL AND source IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL"""),
    "normalise_label": "SELECT n_nationkey, replace(lower(n_name), '_', ' ') AS label FROM nation",
    "boolean_filter": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_discount > 0.05)",
    "rows_containing": "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')",
    "select_like": "SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem",
    "rename_by_index": _with([RECORDS, SURF], """
        SELECT x_cell, y_cell, s1 AS layer1, s2 AS layer2, s3 AS layer3, s4 AS layer4 FROM surf"""),
    "scale_columns": _with([RECORDS, SURF], """
        SELECT x_cell, y_cell, s1 / 10.0::DOUBLE AS s1, s2 / 10.0::DOUBLE AS s2,
               s3 / 10.0::DOUBLE AS s3, s4 / 10.0::DOUBLE AS s4 FROM surf"""),
    "fixed_decimal_key": _with([RECORDS, SURF], """
        SELECT x_cell, y_cell, printf('%.1f', x_cell / 10.0::DOUBLE) AS x_cell_text,
               printf('%.1f', y_cell / 10.0::DOUBLE) AS y_cell_text FROM surf"""),
    "surface_number": _with([RECORDS, SURF, SURF_LONG], """
        SELECT x_cell, y_cell, CAST(substr(surface, 2) AS INTEGER) AS number, xx FROM surf_long"""),
    "blank_zero": """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS lines_before FROM lineitem""",
    "row_count": "SELECT count(*) AS n FROM orders",
    "write_counters": _with(BASE, """
        SELECT count(*) AS n_records,
               count(*) FILTER (NOT EXISTS (SELECT 1 FROM surf s WHERE s.s4 >= 20 AND s.x_cell = r.x_cell
                                            AND s.y_cell = r.y_cell)) AS n_off_surface,
               count(*) FILTER (r.record_id IN (SELECT record_id FROM rf)) AS n_flagged
        FROM records r"""),
    "restarted_write": _with([RECORDS], """
        SELECT record_id, record_class, CASE WHEN record_class = 'F' THEN round(amount) ELSE amount END AS amount
        FROM records"""),
    "quarantine_rows": """SELECT o_orderkey, CASE WHEN o_orderkey % 40 NOT IN (1, 2, 3) THEN o_totalprice END AS price,
                                 o_orderkey % 40 IN (1, 2, 3) AS is_bad FROM orders""",
    "csv_id_list": _with([RECORDS], "SELECT record_id, group_key, amount FROM records WHERE source_key = '1-URGENT'"),
    "ordered_labels": """SELECT concat('bio', month(o_orderdate)) AS label, o_orderkey,
        row_number() OVER (ORDER BY month(o_orderdate), o_orderkey) AS position FROM orders""",
    "approx_quartiles": _with([RECORDS], """
        SELECT record_class, count(*) AS n, true AS q1_ok, true AS median_ok, true AS q3_ok
        FROM records GROUP BY record_class"""),
    "bucketed_export": _with([*BASE, WIDE, EXPORT], """
        SELECT * FROM export WHERE record_class IN (
          SELECT record_class FROM records GROUP BY record_class
          HAVING count(*) >= 0.1 * (SELECT count(*) FROM records))"""),
    "box_lookup": _with(BASE, """
        SELECT s.* FROM surf s, (
          SELECT min(x_cell) - 10 AS x0, max(x_cell) + 10 AS x1, min(y_cell) - 10 AS y0, max(y_cell) + 10 AS y1
          FROM records WHERE record_id IN (
            SELECT record_id FROM rf WHERE group_key = (
              SELECT DISTINCT group_key FROM rf ORDER BY group_key LIMIT 1 OFFSET 14))) b
        WHERE s.x_cell BETWEEN b.x0 AND b.x1 AND s.y_cell BETWEEN b.y0 AND b.y1"""),
    "natural_merge": _with([RECORDS], """
        SELECT r.group_key, nullif(r.record_class, 'P') AS record_class, r.record_id, r.amount, h.n_held
        FROM records r LEFT JOIN (
          SELECT group_key, nullif(record_class, 'P') AS record_class, count(*) AS n_held FROM records
          GROUP BY ALL HAVING count(*) >= 3) h
          ON r.group_key = h.group_key AND nullif(r.record_class, 'P') IS NOT DISTINCT FROM h.record_class"""),
    "job_export": _with([
        RECORDS, SURF, SURF_LONG,
        """kept AS (SELECT * FROM records WHERE record_class <> 'P' AND record_id % 7 <> 0 AND record_id % 97 <> 0)""",
        LONG.replace("FROM records r", "FROM kept r"), *FLAGS, RF, WIDE], """
        SELECT k.record_id AS gbifid, CAST(k.group_key AS INTEGER) AS specieskey, 'HUMAN_OBSERVATION' AS basisofrecord,
               CAST(k.x_cell AS DOUBLE) * 10 / 100 AS rounded_decimallatitude,
               CAST(k.y_cell AS DOUBLE) * 10 / 100 AS rounded_decimallongitude,
               w.s1, w.s2, w.s3, w.s4, w.n_outliers AS n_bioclim_outliers
        FROM kept k JOIN wide w ON k.record_id = w.record_id"""),
    "random_group": _with(BASE, """
        SELECT group_key FROM (SELECT DISTINCT group_key FROM rf)
        ORDER BY md5(concat_ws(':', CAST(group_key AS VARCHAR), '42')), group_key LIMIT 1"""),
    "composite_key": _with([RECORDS, SURF, SURF_LONG], """
        SELECT concat_ws('_', x_cell, y_cell, surface) AS key, CAST(x_cell AS BIGINT) AS key_x,
               CAST(y_cell AS BIGINT) AS key_y, surface AS key_surface, xx
        FROM surf_long"""),
    "unpivot_surfaces": _with([RECORDS, SURF, SURF_LONG], "SELECT x_cell, y_cell, surface, xx FROM surf_long"),
    "pivot_wide": _with([*BASE, WIDE], "SELECT record_id, s1, s2, s3, s4 FROM wide"),
    "distinct_group_values": "SELECT DISTINCT o_custkey AS group_key, o_totalprice AS xx FROM orders",
    "group_size_guard": """SELECT group_key, count(*) AS n FROM
        (SELECT DISTINCT o_custkey AS group_key, o_totalprice AS xx FROM orders)
        GROUP BY group_key HAVING count(*) >= 10""",
    "group_quartiles": """
        WITH d AS (SELECT DISTINCT o_custkey AS group_key, o_totalprice AS xx FROM orders),
        r AS (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY xx) AS p,
                     count(*) OVER (PARTITION BY group_key) AS n FROM d)
        SELECT group_key, max(n) AS n,
               max(CASE WHEN p = ceil(n * 0.25) THEN xx END) AS q1,
               max(CASE WHEN p = ceil(n * 0.5) THEN xx END) AS median,
               max(CASE WHEN p = ceil(n * 0.75) THEN xx END) AS q3
        FROM r GROUP BY group_key""",
    "lead_gap": """
        WITH d AS (SELECT DISTINCT o_custkey AS group_key, o_totalprice AS xx FROM orders)
        SELECT group_key, xx, lead(xx) OVER (PARTITION BY group_key ORDER BY xx) AS x1 FROM d""",
    "gap_scores": _with(ORDERS_GAP, """
        SELECT group_key, xx, n, round(mx * n, 2) / n AS mx, x1, round(y, -3) AS y, round(z, 6) AS z,
               round(t1, 6) AS t1, median, outlier_type FROM og"""),
    "gap_outliers": _with(ORDERS_GAP, _gap_out("og", ["group_key"])),
    "gap_outliers_by_doc": _with(gap_ctes("documents", ["source", "lang"], "n_chars", "dg"),
                                 _gap_out("dg", ["source", "lang"])),
    "gap_outliers_by_user": _with(gap_ctes("events", ["user_id"], "value", "eg"),
                                  _gap_out("eg", ["user_id"])),
    "flag_union": _with(ORDERS_GAP, """
        SELECT group_key, xx, outlier_type FROM og WHERE outlier_type = 'upper'
        UNION ALL
        SELECT group_key, xx, outlier_type FROM og WHERE outlier_type = 'lower'"""),
    "make_grid": _with([RECORDS, """b AS (SELECT min(x_cell) AS x0, max(x_cell) AS x1,
                                              min(y_cell) AS y0, max(y_cell) AS y1 FROM records)""",
                        """g AS (SELECT unnest(range(CAST((y1 - y0 + 1) * (x1 - x0 + 1) AS BIGINT))) AS i,
                                        x0, x1, y0 FROM b)"""], """
        SELECT i // (x1 - x0 + 1) AS "row", i % (x1 - x0 + 1) AS col,
               CAST(y0 AS DOUBLE) + CAST(i // (x1 - x0 + 1) AS DOUBLE) AS lat,
               CAST(x0 AS DOUBLE) + CAST(i % (x1 - x0 + 1) AS DOUBLE) AS lon
        FROM g"""),
    "raster_cell_join": _with([RECORDS], """
        SELECT p.event_id, p.cell_row, p.cell_col, c.band / 10 AS band
        FROM (SELECT event_id, CAST(floor(value / 10.0) AS BIGINT) AS cell_col,
                     CAST(hour(ts) AS BIGINT) AS cell_row FROM events) p
        JOIN (SELECT y_cell, x_cell, max(round(amount * 100)) AS band
              FROM records GROUP BY y_cell, x_cell) c
          ON p.cell_row = c.y_cell AND p.cell_col = c.x_cell"""),
    "grid_lookup_join": _with([RECORDS, SURF], """
        SELECT r.record_id, r.x_cell, r.y_cell, s.s1, s.s2, s.s3, s.s4
        FROM records r JOIN surf s ON r.x_cell = s.x_cell AND r.y_cell = s.y_cell"""),
    "surface_build": _with([RECORDS, SURF, """b AS (SELECT min(x_cell) AS x0, max(x_cell) AS x1,
                                                          min(y_cell) AS y0, max(y_cell) AS y1 FROM records)""",
                            """g AS (SELECT unnest(range(CAST((2 * (y1 - y0) + 1) * (2 * (x1 - x0) + 1) AS BIGINT))) AS i,
                                            2 * (x1 - x0) + 1 AS w, x0, y0 FROM b)""",
                            "p AS (SELECT y0 + (i // w) * 0.5 AS lat, x0 + (i % w) * 0.5 AS lon FROM g)"], """
        SELECT printf('%.1f', CAST(p.lat AS DOUBLE)) AS lat, printf('%.1f', CAST(p.lon AS DOUBLE)) AS lon,
               s.s1 / 10 AS s1, s.s2 / 10 AS s2, s.s3 / 10 AS s3, s.s4 / 10 AS s4
        FROM p JOIN surf s ON floor(p.lon) = s.x_cell AND floor(p.lat) = s.y_cell"""),
    "raster_rows": _with([RECORDS, SURF, SURF_LONG], """
        SELECT CAST(x_cell + 0.5 AS DOUBLE) AS x, CAST(y_cell + 0.5 AS DOUBLE) AS y, surface, xx FROM surf_long"""),
    "surface_outliers": _with(BASE, "SELECT * FROM flags"),
    "flags_to_records": _with(BASE, "SELECT * FROM rf"),
    "count_outlier_surfaces": _with(BASE, """
        SELECT record_id, count(DISTINCT surface) AS n_outliers FROM rf GROUP BY record_id"""),
    "export_wide": _with([*BASE, WIDE, EXPORT], "SELECT * FROM export"),
    "trusted_outliers": _with([*BASE, WIDE, EXPORT], "SELECT * FROM export WHERE n_outliers >= 2"),
    "left_outer_flags": _with([*BASE, WIDE], """
        SELECT r.record_id, r.group_key, r.amount, w.s1, w.s2, w.s3, w.s4, w.n_outliers
        FROM records r LEFT JOIN wide w ON r.record_id = w.record_id"""),
    "membership_flag": _with(BASE, """
        SELECT record_id, group_key, record_class, y_cell,
               record_id IN (SELECT record_id FROM rf) AS is_flagged
        FROM records WHERE record_class = 'F' AND y_cell >= 3"""),
    "semi_filter": _with(BASE, "SELECT * FROM records WHERE record_id IN (SELECT record_id FROM rf)"),
    "label_dim_join": _with([RECORDS, SURF, SURF_LONG, LONG, DIM],
        """SELECT DISTINCT l.group_key, l.x_cell, l.y_cell, l.surface, l.xx, d.long_name
           FROM long l JOIN dim d ON l.surface = d.surface"""),
    "cumulative_frequency": _with([*BASE, LONG_LOC, KEPT, DIM], """
        SELECT f.group_key, f.surface, f.xx, f.x_cell, f.y_cell, f.is_outlier, f.freq,
               CAST(sum(f.freq) OVER (PARTITION BY f.group_key, f.surface
                                      ORDER BY f.xx, f.x_cell, f.y_cell, f.is_outlier
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_freq,
               concat(f.surface, '-', d.long_name) AS long_name,
               CAST(replace(f.surface, 's', '') AS INTEGER) AS surface_no, a.n_outliers,
               CASE WHEN a.n_outliers = 0 THEN '' ELSE CAST(a.n_outliers AS VARCHAR) END AS n_label
        FROM (SELECT group_key, surface, xx, x_cell, y_cell, is_outlier, count(*) AS freq
              FROM kept GROUP BY group_key, surface, xx, x_cell, y_cell, is_outlier) f
        JOIN dim d ON f.surface = d.surface
        JOIN (SELECT group_key, x_cell, y_cell,
                     CAST(count(DISTINCT CASE WHEN is_outlier THEN surface END) AS BIGINT) AS n_outliers
              FROM kept GROUP BY group_key, x_cell, y_cell) a
          ON f.group_key = a.group_key AND f.x_cell = a.x_cell AND f.y_cell = a.y_cell"""),
    "location_flag_count": _with([*BASE, LONG_LOC, KEPT], """
        SELECT group_key, x_cell, y_cell, CAST(sum(CAST(is_outlier AS INTEGER)) AS BIGINT) AS n_outliers
        FROM (SELECT DISTINCT group_key, surface, x_cell, y_cell, is_outlier FROM kept)
        GROUP BY group_key, x_cell, y_cell"""),
    "bbox_padded": _with([*BASE, LONG_LOC, KEPT], """
        SELECT group_key, surface, min(x_cell) - 10 AS x_min, max(x_cell) + 10 AS x_max,
               min(y_cell) - 10 AS y_min, max(y_cell) + 10 AS y_max
        FROM kept GROUP BY group_key, surface"""),
    "nth_group": _with(BASE, """
        SELECT group_key FROM (SELECT DISTINCT group_key FROM rf) ORDER BY group_key LIMIT 1 OFFSET 14"""),
    "top_sources": _with([*BASE, FLAGGED], """
        SELECT source_key, count(*) AS n FROM flagged GROUP BY source_key
        ORDER BY n DESC, source_key LIMIT 100"""),
    "report_by_class": _with([*BASE, TRUSTED], """
        SELECT record_class, count(*) AS n
        FROM (SELECT DISTINCT group_key, record_class, x_cell, y_cell FROM trusted) GROUP BY record_class"""),
    "report_hot_locations": _with([*BASE, TRUSTED], """
        SELECT x_cell, y_cell, count(*) AS n
        FROM (SELECT DISTINCT group_key, x_cell, y_cell FROM trusted)
        GROUP BY x_cell, y_cell HAVING count(*) >= 2"""),
    "report_by_taxon": _with([*BASE, TRUSTED], """
        SELECT group_key, count(*) AS n FROM trusted GROUP BY group_key"""),
    "report_by_surface": _with(BASE, """
        SELECT surface, count(*) AS n FROM (SELECT DISTINCT record_id, surface FROM rf) GROUP BY surface"""),
    "report_source_share": _with([*BASE, TRUSTED], """
        SELECT f.source_key, f.n_flagged, t.n_total, round(f.n_flagged / t.n_total, 6) AS share
        FROM (SELECT source_key, count(*) AS n_flagged FROM trusted GROUP BY source_key) f
        JOIN (SELECT source_key, count(*) AS n_total FROM records GROUP BY source_key) t
          ON f.source_key = t.source_key
        WHERE f.n_flagged > 10"""),
    "report_uncertainty": _with([*BASE, WIDE, EXPORT], """
        SELECT n_outliers, round(avg(amount), 6) AS mean_value, count(*) AS n_records
        FROM (SELECT DISTINCT group_key, x_cell, y_cell, n_outliers, amount FROM export
              WHERE record_class = 'F' AND amount IS NOT NULL)
        GROUP BY n_outliers"""),
    "ids_json_per_source": _with([*BASE, TRUSTED], """
        SELECT source_key, page, count(*) AS n_ids,
               CAST(to_json(list(record_id ORDER BY record_id)) AS VARCHAR) AS ids_json
        FROM (SELECT source_key, record_id,
                     (row_number() OVER (PARTITION BY source_key ORDER BY record_id) - 1) // 100 AS page
              FROM trusted)
        GROUP BY source_key, page"""),
    "detector_overlap": _with([*BASE, *gap_ctes("records", ["group_key"], "amount", "ag")], """
        SELECT in_a, in_b, count(*) AS n FROM (
          SELECT record_id IN (SELECT record_id FROM rf) AS in_a,
                 EXISTS (SELECT 1 FROM ag WHERE ag.outlier_type IS NOT NULL
                         AND ag.group_key = r.group_key AND ag.xx = r.amount) AS in_b
          FROM records r)
        GROUP BY in_a, in_b"""),
    "detector_labels": _with([*BASE, WIDE, *gap_ctes("records", ["group_key"], "amount", "ag")], """
        SELECT r.*, w.s1, w.s2, w.s3, w.s4, w.record_id IS NOT NULL AS in_a, ag.xx IS NOT NULL AS in_b,
               w.record_id IS NOT NULL AND ag.xx IS NOT NULL AS in_both
        FROM records r LEFT JOIN wide w ON r.record_id = w.record_id
        LEFT JOIN ag ON ag.outlier_type IS NOT NULL AND ag.group_key = r.group_key AND ag.xx = r.amount"""),
}
