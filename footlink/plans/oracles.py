"""DuckDB oracle SQL for the registered queries.

Each string is standalone ANSI-ish SQL over the pre-registered base tables;
the fixture views are rebuilt as CTEs from the same rules as
:mod:`footlink.sources.fixtures`. Results are written the plain SQL way
(window ``row_number``, ``string_agg ... ORDER BY``, closed-form box
geometry), independently of the Spark operators they check.
"""

from __future__ import annotations

STATUS_LIST = "['constructed','demolished','constructionProject','canceledConstructionProject','notUsable']"

DIFF = f"""diff AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'create' ELSE 'update' END AS action,
         CAST(user_id AS VARCHAR) AS rnb_id,
         ({STATUS_LIST})[(event_id % 5) + 1] AS status,
         CASE WHEN event_type = 'error' THEN '0' ELSE '1' END AS is_active,
         '["' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '+00",)' AS sys_period,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE '["' || CAST(event_id % 1000 AS VARCHAR) || '"]' END AS addresses_id,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE props END AS ext_ids,
         CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_id % 7 = 0 THEN 'reactivation' ELSE event_type END AS event_type,
         event_id AS pos, ts, user_id
  FROM events)"""

LATEST = """latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY rnb_id ORDER BY ts DESC, pos ASC) AS rn,
              min(pos) OVER (PARTITION BY rnb_id) AS first_pos
    FROM diff) WHERE rn = 1)"""

REMOVED = """removed AS (
  SELECT DISTINCT rnb_id FROM latest
  WHERE coalesce(is_active = '0', false)
     OR coalesce(status IN ('constructionProject','canceledConstructionProject'), false))"""

LINK_TABLE = """link_table AS (
  SELECT 'L' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cleabs,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS identifiant_rnb,
         c_nationkey AS gcms_numrec,
         CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS gcms_territoire,
         c_custkey % 31 = 0 AS gcms_detruit
  FROM customer)"""

LINKS = """links AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS cleabs,
         CASE WHEN l_orderkey % 50 = 0 THEN ''
              WHEN l_orderkey % 51 = 0 THEN NULL
              ELSE string_agg(DISTINCT CAST(l_partkey AS VARCHAR), '/' ORDER BY CAST(l_partkey AS VARCHAR)) END
           AS liens_vers_batiment,
         'fp' || CAST(l_orderkey % 97 AS VARCHAR) AS gcms_fingerprint,
         l_orderkey % 23 = 0 AS gcms_detruit
  FROM lineitem GROUP BY l_orderkey)"""

FAR_R = "'Bâtiment non apparié, à plus de 20m d''un autre bâtiment BDUni'"
TREATED_LABELS = ("['Batiments semblables','Croisement sémantique','Batiments inclus',"
                  "'Batiments BDTOPO balcon'," + FAR_R + "]")

TREATED = f"""treated AS (
  SELECT cleabs, identifiant_rnb, traitement,
         CASE WHEN traitement = {FAR_R} THEN ''
              ELSE 'N' || CAST(l_suppkey AS VARCHAR)
                   || CASE WHEN l_linenumber = 2 THEN '/' || CAST(l_partkey AS VARCHAR) ELSE '' END END
           AS liens_vers_batiment
  FROM (SELECT *, CAST(l_orderkey AS VARCHAR) AS cleabs, 'R' || CAST(l_orderkey AS VARCHAR) AS identifiant_rnb,
               ({TREATED_LABELS})[(l_partkey % 5) + 1] AS traitement
        FROM lineitem))"""

DESTROYED = """destroyed AS (
  SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS cleabs FROM part
  WHERE p_size % 10 = 0
    AND CAST(DATE '2024-02-01' - CAST(p_partkey % 16 AS INTEGER) AS TIMESTAMP) >= CAST(DATE '2024-02-01' - 8 AS TIMESTAMP))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["diff_range_start"] = _with(DIFF) + """
SELECT event_id, rnb_id, epoch_us(ts) AS range_start_us FROM diff"""

ORACLES["diff_latest"] = _with(DIFF, LATEST) + """
SELECT rnb_id, event_id, action, status, is_active, epoch_us(ts) AS updated_at_us, first_pos FROM latest"""

ORACLES["diff_latest_ties"] = """
SELECT rnb_id, extra, updated_at_us, first_pos FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS rnb_id, CAST(o_orderkey AS VARCHAR) AS extra,
         epoch_us(o_orderdate) AS updated_at_us,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey ASC) AS rn,
         min(o_orderkey) OVER (PARTITION BY o_custkey) AS first_pos
  FROM orders) WHERE rn = 1"""

ORACLES["diff_removed"] = _with(DIFF, LATEST, REMOVED) + "SELECT rnb_id FROM removed"

ORACLES["diff_recalc"] = _with(DIFF, LATEST, REMOVED) + """
SELECT DISTINCT rnb_id FROM latest WHERE rnb_id NOT IN (SELECT rnb_id FROM removed)"""

ORACLES["diff_dates"] = _with(DIFF, LATEST) + """
, iso AS (SELECT rnb_id, action,
        strftime(ts, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
                ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END
        || '+00:00' AS d
  FROM latest)
SELECT rnb_id, action,
       CASE WHEN action = 'create' THEN d ELSE '' END AS created_at,
       CASE WHEN action = 'create' THEN '' ELSE d END AS updated_at
FROM iso"""

ORACLES["dup_keys"] = _with(DIFF) + """
SELECT rnb_id, count(*) AS n FROM diff GROUP BY rnb_id HAVING count(*) > 1"""

ORACLES["diff_upsert"] = _with(DIFF) + """
, ranked AS (
  SELECT rnb_id, event_id, ts >= TIMESTAMP '2024-01-16' AS late,
         row_number() OVER (PARTITION BY rnb_id, ts >= TIMESTAMP '2024-01-16' ORDER BY ts DESC, pos) AS rn
  FROM diff)
SELECT rnb_id, event_id, 'change' AS origin FROM ranked WHERE late AND rn = 1
UNION ALL
SELECT rnb_id, event_id, 'stock' AS origin FROM ranked r WHERE NOT late AND rn = 1
  AND NOT EXISTS (SELECT 1 FROM ranked c WHERE c.late AND c.rnb_id = r.rnb_id)"""

ORACLES["typed_cast"] = """
WITH t AS (
  SELECT 'BATIMENT' || lpad(CAST(event_id AS VARCHAR), 16, '0') AS cleabs,
         (['T','true','1','f','FALSE','0','x',''])[(event_id % 8) + 1] AS cl,
         (['T','true','1','f','FALSE','0','x',''])[((event_id + 3) % 8) + 1] AS gd,
         event_id % 11 AS m, ts, props, value, user_id, event_type
  FROM events)
SELECT cleabs,
  CASE WHEN lower(nullif(cl, '')) IN ('true','t','1') THEN true
       WHEN lower(nullif(cl, '')) IN ('false','f','0') THEN false END AS construction_legere,
  CASE WHEN lower(nullif(gd, '')) IN ('true','t','1') THEN true
       WHEN lower(nullif(gd, '')) IN ('false','f','0') THEN false END AS gcms_detruit,
  CASE WHEN m = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS gcms_date_creation,
  CASE WHEN m = 1 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS date_d_apparition,
  CASE WHEN m IN (2, 3, 4) THEN NULL ELSE CAST(json(props) AS VARCHAR) END AS source_detaillee,
  CASE WHEN m = 5 THEN NULL
       ELSE CAST(CAST(floor(value * 100) AS BIGINT) / 100.0 AS DECIMAL(6,2))::VARCHAR END AS hauteur,
  CASE WHEN m = 6 THEN NULL ELSE CAST(user_id AS INTEGER) END AS nombre_de_logements,
  CASE WHEN m = 7 THEN NULL ELSE event_type END AS nom,
  CASE WHEN m IN (8, 9) THEN NULL ELSE event_type END AS metadonnees_unification
FROM t"""

ORACLES["key_violations"] = _with(LINK_TABLE) + """
SELECT 'unique:identifiant_rnb' AS "check", identifiant_rnb AS key, count(*) AS n
FROM link_table WHERE identifiant_rnb IS NOT NULL GROUP BY identifiant_rnb HAVING count(*) > 1
UNION ALL
SELECT 'unique:gcms_numrec,gcms_territoire', CAST(gcms_numrec AS VARCHAR) || '|' || gcms_territoire, count(*)
FROM link_table WHERE gcms_numrec IS NOT NULL AND gcms_territoire IS NOT NULL
GROUP BY gcms_numrec, gcms_territoire HAVING count(*) > 1
UNION ALL
SELECT * FROM (
  SELECT 'not_null:identifiant_rnb' AS "check", 'identifiant_rnb' AS key,
         count(*) FILTER (WHERE identifiant_rnb IS NULL) AS n FROM link_table
  UNION ALL
  SELECT 'not_null:gcms_territoire', 'gcms_territoire', count(*) FILTER (WHERE gcms_territoire IS NULL) FROM link_table
  UNION ALL
  SELECT 'not_null:gcms_numrec', 'gcms_numrec', count(*) FILTER (WHERE gcms_numrec IS NULL) FROM link_table
) WHERE n > 0"""

ORACLES["work_deactivated"] = _with(DIFF, LATEST, REMOVED, LINK_TABLE) + """
SELECT l.cleabs, CAST(NULL AS VARCHAR) AS gcms_fingerprint
FROM removed r JOIN link_table l ON l.identifiant_rnb = r.rnb_id"""

ORACLES["work_demolished"] = _with(DIFF, LATEST, LINK_TABLE) + """
SELECT l.cleabs, CAST(NULL AS VARCHAR) AS gcms_fingerprint
FROM latest r JOIN link_table l ON l.identifiant_rnb = r.rnb_id
WHERE r.action = 'update' AND r.status = 'demolished'"""

ORACLES["links_explode"] = _with(LINKS) + """
SELECT cleabs, unnest(string_split(liens_vers_batiment, '/')) AS lien, 'E1' AS kind
FROM links WHERE liens_vers_batiment <> ''
UNION ALL
SELECT cleabs, unnest(string_split(liens_vers_batiment, '/')) AS lien, 'E2' AS kind
FROM links WHERE liens_vers_batiment IS NOT NULL"""

# Lists stay DuckDB lists: one list per treated row (its new ids and those its
# link row has already), united per key.
MERGED = f"""
, united AS (
  SELECT t.cleabs, t.traitement,
         list_concat(coalesce(string_split(t.liens_vers_batiment, '/'), []),
                     coalesce(string_split(k.liens_vers_batiment, '/'), [])) AS ids
  FROM treated t LEFT JOIN links k USING (cleabs)
  WHERE t.traitement <> {FAR_R}
)
SELECT cleabs, array_to_string(list_sort(list_distinct(flatten(list(ids)))), '/') AS liens_vers_batiment,
       NULL::VARCHAR AS gcms_fingerprint"""

ORACLES["links_merge_labels"] = _with(LINKS, TREATED) + MERGED + """,
       array_to_string(list_sort(list_distinct(list(traitement))), '/') AS traitement
FROM united WHERE len(ids) > 0 GROUP BY cleabs"""

ORACLES["links_merge"] = _with(LINKS, TREATED) + MERGED + """
FROM united WHERE len(ids) > 0 GROUP BY cleabs"""

# A live row that names a dead id keeps its other ids, or nothing.
ORACLES["links_drop_destroyed"] = _with(LINKS, DESTROYED) + """
, named AS (
  SELECT cleabs, gcms_fingerprint, string_split(coalesce(liens_vers_batiment, ''), '/') AS ids,
         (SELECT list(cleabs) FROM destroyed) AS dead
  FROM links WHERE NOT gcms_detruit
)
SELECT cleabs, gcms_fingerprint,
       nullif(array_to_string(list_sort(list_filter(ids, lambda x: NOT list_contains(dead, x))), '/'), '')
         AS liens_vers_batiment
FROM named WHERE list_has_any(ids, dead)"""


# -- box fixture, closed form ---------------------------------------------------
# Every predicate below is box arithmetic: it evaluates the same stage rule
# as the engine, without any polygon code.

LOTS = """lots AS (
  SELECT p_partkey AS k, p_partkey % 10 AS c,
         64.0 * (p_partkey % 100) AS x0, 64.0 * (p_partkey // 100) AS y0,
         8.0 + p_partkey % 7 AS w, 6.0 + p_size % 9 AS h
  FROM part)"""

RB = """rb AS (
  SELECT 'L' || k AS cleabs, 'R' || k AS rid, k, c, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM lots WHERE c NOT IN (3, 8)
  UNION ALL SELECT 'L' || k, 'R' || k, k, c, x0, y0, x0 + w / 2, y0 + h FROM lots WHERE c = 3
  UNION ALL SELECT 'L' || k || 'b', 'R' || k || 'b', k, c, x0 + w / 2, y0, x0 + w, y0 + h FROM lots WHERE c = 3)"""

BB = """bb AS (
  SELECT 'B' || k AS cleabs, k, c,
         CASE c WHEN 1 THEN x0 + 0.4 WHEN 4 THEN x0 - 3 WHEN 5 THEN x0 + w - 0.5
                WHEN 6 THEN x0 + w + 10 WHEN 9 THEN x0 + w + 10 ELSE x0 END AS x0,
         CASE c WHEN 4 THEN y0 - 3 WHEN 5 THEN y0 + 1 ELSE y0 END AS y0,
         CASE c WHEN 1 THEN x0 + w + 0.4 WHEN 4 THEN x0 + w + 3 WHEN 5 THEN x0 + w + 3.5
                WHEN 6 THEN x0 + w + 10 + w WHEN 9 THEN x0 + w + 10 + w ELSE x0 + w END AS x1,
         CASE c WHEN 4 THEN y0 + h + 3 WHEN 5 THEN y0 + 5 ELSE y0 + h END AS y1,
         CASE WHEN c = 2 THEN 6 ELSE 5 END AS npts
  FROM lots WHERE c <> 7)"""

PAIRS = """pr AS (
  SELECT r.cleabs AS r_key, r.rid, r.k AS rk, r.c AS rc, b.cleabs AS b_key,
         (r.x1 - r.x0) * (r.y1 - r.y0) AS r_area, 2 * ((r.x1 - r.x0) + (r.y1 - r.y0)) AS r_perim,
         (b.x1 - b.x0) * (b.y1 - b.y0) AS b_area, 2 * ((b.x1 - b.x0) + (b.y1 - b.y0)) AS b_perim,
         b.npts AS b_npts,
         greatest(0, least(r.x1, b.x1) - greatest(r.x0, b.x0)) * greatest(0, least(r.y1, b.y1) - greatest(r.y0, b.y0)) AS inter,
         least(r.x1, b.x1) >= greatest(r.x0, b.x0) AND least(r.y1, b.y1) >= greatest(r.y0, b.y0) AS hits,
         sqrt(greatest(0, b.x0 - r.x1, r.x0 - b.x1) ** 2 + greatest(0, b.y0 - r.y1, r.y0 - b.y1) ** 2) AS dist,
         r.x0 = b.x0 AND r.y0 = b.y0 AND r.x1 = b.x1 AND r.y1 = b.y1 AS same_box,
         (r.x1 - r.x0) > 1 AND (r.y1 - r.y0) > 1 AND b.x0 <= r.x0 + 0.5 AND r.x1 - 0.5 <= b.x1
           AND b.y0 <= r.y0 + 0.5 AND r.y1 - 0.5 <= b.y1 AS contains_eroded,
         (r.x0 + r.x1) / 2 BETWEEN b.x0 AND b.x1 AND (r.y0 + r.y1) / 2 BETWEEN b.y0 AND b.y1 AS point_in
  FROM rb r, bb b
  WHERE b.x0 <= r.x1 + 100 AND r.x0 - 100 <= b.x1 AND b.y0 <= r.y1 + 100 AND r.y0 - 100 <= b.y1)"""

BOX = _with(LOTS, RB, BB, PAIRS)


def _claims_sql(where: str, label: str) -> str:
    lab = label.replace("'", "''")
    return BOX + f"""
SELECT string_agg(DISTINCT b_key, '/' ORDER BY b_key) AS liens_vers_batiment, rid AS identifiant_rnb,
       '{lab}' AS traitement
FROM pr WHERE {where} GROUP BY rid"""


ORACLES["geom_measures"] = _with(LOTS, RB, BB) + """
SELECT cleabs AS id, round((x1 - x0) * (y1 - y0), 4) AS area, round(2 * ((x1 - x0) + (y1 - y0)), 4) AS perim,
       CAST(5 AS BIGINT) AS npts, round(x0, 4) AS xmin, round(y0, 4) AS ymin, round(x1, 4) AS xmax, round(y1, 4) AS ymax
FROM rb
UNION ALL
SELECT cleabs, round((x1 - x0) * (y1 - y0), 4), round(2 * ((x1 - x0) + (y1 - y0)), 4), CAST(npts AS BIGINT),
       round(x0, 4), round(y0, 4), round(x1, 4), round(y1, 4)
FROM bb"""

ORACLES["pairs_intersect"] = BOX + "SELECT r_key, b_key, round(inter, 4) AS inter FROM pr WHERE hits"
ORACLES["pairs_within_20"] = BOX + "SELECT r_key, b_key, round(dist, 4) AS dist FROM pr WHERE dist <= 20"

ORACLES["match_equal"] = _claims_sql("same_box", "Bâtiments égaux")
ORACLES["match_identical"] = _claims_sql(
    "hits AND floor(inter) = floor(b_area) AND floor(inter) = floor(r_area)", "Batiments identiques")
ORACLES["match_similar"] = _claims_sql(
    "hits AND abs(floor(inter)) > 3 AND abs(floor(b_area) - floor(r_area)) < 3 "
    "AND abs(floor(b_perim) - floor(r_perim)) < 3 AND b_npts = 5", "Batiments semblables")
ORACLES["match_similar_nbp"] = _claims_sql(
    "hits AND abs(floor(inter)) > 3 AND abs(floor(b_area) - floor(r_area)) < 3 "
    "AND abs(floor(b_perim) - floor(r_perim)) < 3 AND b_npts <> 5", "Batiments semblables nbpt diff")
ORACLES["match_contained"] = _claims_sql("contains_eroded", "Batiments inclus")

# Shape fixture: the rule for square-cornered insets (footlink.sources.shapes)
# and areas as polynomials in the sizes, arms 5 m wide.
SHAPES = """WITH sh AS (
  SELECT p_partkey AS k, p_partkey % 4 AS s, (p_partkey // 4) % 11 AS v, 20 + p_partkey % 7 AS w, 16 + p_size % 9 AS h,
         [-1, 0, 0.25, 0.34, 0.36, 0.45, 0.5, 0.55, 0.75, 0, 0][(p_partkey // 4) % 11 + 1]::DOUBLE AS inset
  FROM part)
"""
ORACLES["match_contained_shapes"] = SHAPES + """
SELECT 'S' || k AS liens_vers_batiment, 'RS' || k AS identifiant_rnb, 'Batiments inclus' AS traitement
FROM sh WHERE v <> 10 AND inset <= CASE WHEN s = 3 THEN 0.5 ELSE 0.5 / sqrt(2) END"""
ORACLES["pairs_shapes"] = SHAPES + """
, g AS (SELECT *, greatest(inset, 0) AS i FROM sh)
SELECT 'RS' || k AS r_key, 'S' || k AS b_key,
       round((CASE WHEN v = 10 THEN CASE WHEN s = 3 THEN w - 4 ELSE w END * 5
                   WHEN s = 0 THEN (w - 2 * i + h - 5) * (5 - 2 * i)
                   WHEN s = 1 THEN (w - 2 * i + 2 * (h - 5)) * (5 - 2 * i)
                   WHEN s = 2 THEN (w - 2 * i) * (h - 2 * i) - (w - 10 + 2 * i) * (h - 10 + 2 * i)
                   ELSE (w - 4 - 4 * i) * (h - 2 * i) END)::DOUBLE, 3) AS inter
FROM g"""
ORACLES["match_balcony"] = _claims_sql(
    "abs(floor(b_area)) < 25 AND floor(b_area) < floor(r_area) AND hits AND abs(floor(inter)) < 3",
    "Batiments BDTOPO balcon")
ORACLES["match_point"] = _claims_sql("point_in", "Bâtiments ponctuels")

INFO = """info AS (
  SELECT rid,
         '{"ext_ids": ' || CASE WHEN c = 9 THEN '[{"id": "B' || k || '", "source": "bdtopo"}]'
                               WHEN c = 1 THEN '[{"id": "NOPE", "source": "bdtopo"}]' ELSE '[]' END
         || ', "created_at": "", "updated_at": "", "identifiants_ban": []}' AS informations_rnb
  FROM rb)"""

ORACLES["match_semantic"] = _with(LOTS, RB, BB, INFO) + """
, ids AS (SELECT rid, json_extract(informations_rnb, '$.ext_ids') AS ext,
                 unnest(json_extract_string(informations_rnb, '$.ext_ids[*].id')) AS id FROM info)
SELECT string_agg(DISTINCT id, '/' ORDER BY id) AS liens_vers_batiment, rid AS identifiant_rnb,
       'Croisement sémantique' AS traitement
FROM ids WHERE id IN (SELECT cleabs FROM bb) GROUP BY CAST(ext AS VARCHAR), rid"""

# Components of registry boxes sharing a stretch of edge (or area): the
# transitive closure over touching pairs, by recursion.
RCOMP = """touch AS (
  SELECT a.cleabs AS a, b.cleabs AS b FROM rb a, rb b
  WHERE a.cleabs <> b.cleabs
    AND ((least(a.x1, b.x1) > greatest(a.x0, b.x0) AND least(a.y1, b.y1) >= greatest(a.y0, b.y0))
      OR (least(a.x1, b.x1) >= greatest(a.x0, b.x0) AND least(a.y1, b.y1) > greatest(a.y0, b.y0)))),
reach(a, b) AS (
  SELECT cleabs, cleabs FROM rb
  UNION SELECT r.a, t.b FROM reach r JOIN touch t ON r.b = t.a),
comp AS (SELECT a AS cleabs, min(b) AS comp FROM reach GROUP BY a)"""

ORACLES["unmatchable"] = """WITH RECURSIVE """ + ",\n".join([LOTS, RB, BB, PAIRS, RCOMP]) + """
, near_comp AS (SELECT DISTINCT m.comp FROM pr JOIN comp m ON m.cleabs = pr.r_key WHERE dist <= 20)
, near_r AS (SELECT DISTINCT rb.rid FROM rb JOIN comp m ON m.cleabs = rb.cleabs
             WHERE m.comp IN (SELECT comp FROM near_comp))
, near_b AS (SELECT DISTINCT b_key FROM pr WHERE dist <= 20)
SELECT cleabs AS liens_vers_batiment, '' AS identifiant_rnb,
       'Bâtiment non apparié, à plus de 20m d''un bâtiment RNB' AS traitement
FROM bb WHERE cleabs NOT IN (SELECT b_key FROM near_b)
UNION
SELECT '', rid, 'Bâtiment non apparié, à plus de 20m d''un autre bâtiment BDUni'
FROM rb WHERE rid NOT IN (SELECT rid FROM near_r)"""

# Dissolved: union of touching boxes (area and perimeter of touching,
# non-overlapping boxes: sums minus twice the shared edge length).
ORACLES["match_dissolved"] = """WITH RECURSIVE """ + ",\n".join([LOTS, RB, BB, PAIRS, RCOMP]) + """
, shared AS (
  SELECT a.cleabs,
         sum(CASE WHEN a.x1 = b.x0 OR a.x0 = b.x1 THEN greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))
                  WHEN a.y1 = b.y0 OR a.y0 = b.y1 THEN greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0))
                  ELSE 0 END) AS len
  FROM rb a JOIN touch t ON t.a = a.cleabs JOIN rb b ON b.cleabs = t.b GROUP BY a.cleabs)
, um AS (
  SELECT m.comp, sum((r.x1 - r.x0) * (r.y1 - r.y0)) AS u_area,
         sum(2 * ((r.x1 - r.x0) + (r.y1 - r.y0)) - coalesce(s.len, 0)) AS u_perim
  FROM rb r JOIN comp m ON m.cleabs = r.cleabs LEFT JOIN shared s ON s.cleabs = r.cleabs GROUP BY m.comp)
, cb AS (
  SELECT m.comp, pr.b_key, any_value(pr.b_area) AS b_area, any_value(pr.b_perim) AS b_perim, sum(pr.inter) AS inter
  FROM pr JOIN comp m ON m.cleabs = pr.r_key WHERE pr.hits GROUP BY m.comp, pr.b_key)
, ok AS (
  SELECT cb.comp, cb.b_key FROM cb JOIN um ON um.comp = cb.comp
  WHERE abs(floor(cb.inter)) > 3 AND abs(floor(cb.b_area) - floor(um.u_area)) < 3
    AND abs(floor(cb.b_perim) - floor(um.u_perim)) < 3)
SELECT string_agg(DISTINCT ok.b_key, '/' ORDER BY ok.b_key) AS liens_vers_batiment, r.rid AS identifiant_rnb,
       'Batiments RNB dissous semblables' AS traitement
FROM ok JOIN comp m ON m.comp = ok.comp JOIN rb r ON r.cleabs = m.cleabs
GROUP BY r.rid"""

ORACLES["candidates_100m"] = _with(LOTS, RB, BB) + """
SELECT DISTINCT b.cleabs FROM rb r, bb b
WHERE sqrt(greatest(0, b.x0 - (r.x0 + r.x1) / 2, (r.x0 + r.x1) / 2 - b.x1) ** 2
         + greatest(0, b.y0 - (r.y0 + r.y1) / 2, (r.y0 + r.y1) / 2 - b.y1) ** 2) <= 100"""

ORACLES["candidates_registry_100m"] = _with(LOTS, RB, BB) + """
SELECT DISTINCT r.cleabs FROM rb r, bb b
WHERE sqrt(greatest(0, b.x0 - (r.x0 + r.x1) / 2, (r.x0 + r.x1) / 2 - b.x1) ** 2
         + greatest(0, b.y0 - (r.y0 + r.y1) / 2, (r.y0 + r.y1) / 2 - b.y1) ** 2) <= 100"""

LIMIT_LOTS = """lim AS (
  SELECT p_partkey AS k, p_partkey % 10 AS c, 3000.0 * (p_partkey % 100) AS x, 3000.0 * floor(p_partkey / 100) AS y,
         8.0 + p_partkey % 7 AS w FROM part)
, pt AS (SELECT k, 'L' || k || '_' || j AS cleabs, x - 40.0 * j AS px, y - 30.0 * j AS py
         FROM lim, (SELECT unnest([0, 1, 2]) AS j) WHERE j <= k % 3)
, box AS (SELECT k, 'B' || k AS cleabs, x + gx AS x0, y + gy AS y0, x + gx + CASE WHEN c = 8 THEN 6000.0 ELSE w END AS x1, y + gy + 6 AS y1
          FROM (SELECT *, CASE c WHEN 0 THEN 99.5 WHEN 1 THEN 100.5 WHEN 2 THEN 59.5 WHEN 3 THEN 60.5 WHEN 4 THEN 499.5
                                 WHEN 5 THEN 500.5 WHEN 6 THEN 299.5 WHEN 7 THEN 300.5 WHEN 8 THEN 100.0 ELSE 60.0 END AS gx,
                          CASE WHEN c IN (2, 3, 9) THEN 80.0 WHEN c IN (6, 7) THEN 400.0 WHEN c = 8 THEN -3.0 ELSE -2.0 END AS gy
                FROM lim))
, gap AS (SELECT pt.cleabs AS l, box.cleabs AS b,
                 sqrt(greatest(0, x0 - px, px - x1) ** 2 + greatest(0, y0 - py, py - y1) ** 2) AS dist FROM pt, box)"""

ORACLES["near_limit_100m"] = _with(LIMIT_LOTS) + "SELECT DISTINCT b AS cleabs FROM gap WHERE dist <= 100"
ORACLES["near_limit_500m"] = _with(LIMIT_LOTS) + "SELECT DISTINCT b AS cleabs FROM gap WHERE dist <= 500"
ORACLES["near_limit_registry_100m"] = _with(LIMIT_LOTS) + "SELECT DISTINCT l AS cleabs FROM gap WHERE dist <= 100"

# Expected cascade outcome by case (the stage each case is built for).
EXPECTED = """expected AS (
  SELECT r.cleabs, r.k, 'B' || r.k AS link,
         CASE r.c WHEN 0 THEN 'Batiments semblables' WHEN 1 THEN 'Batiments semblables'
                  WHEN 2 THEN 'Batiments semblables nbpt diff' WHEN 3 THEN 'Batiments RNB dissous semblables'
                  WHEN 4 THEN 'Batiments inclus' WHEN 5 THEN 'Batiments BDTOPO balcon'
                  WHEN 9 THEN 'Croisement sémantique' END AS traitement
  FROM rb r WHERE r.c IN (0, 1, 2, 3, 4, 5, 9))"""

ORACLES["job_registry_change"] = _with(LOTS, RB, EXPECTED) + """
, u AS (SELECT cleabs, link, traitement FROM expected
        UNION SELECT cleabs, 'OLD' || k, traitement FROM expected WHERE k % 3 = 0)
SELECT cleabs, string_agg(DISTINCT link, '/' ORDER BY link) AS liens_vers_batiment,
       string_agg(DISTINCT traitement, '/' ORDER BY traitement) AS traitement,
       CAST(NULL AS VARCHAR) AS gcms_fingerprint
FROM u GROUP BY cleabs"""

ORACLES["job_topo_created"] = _with(LOTS, RB, EXPECTED) + """
, u AS (SELECT cleabs, link FROM expected UNION SELECT cleabs, 'OLD' || k FROM expected WHERE k % 3 = 0)
SELECT cleabs, string_agg(link, '/' ORDER BY link) AS liens_vers_batiment, CAST(NULL AS VARCHAR) AS gcms_fingerprint
FROM u GROUP BY cleabs"""

ORACLES["stage_counts"] = _with(LOTS, RB) + """
SELECT stage, traitement, count(*) AS n FROM (
  SELECT CASE WHEN c = 8 THEN 1 WHEN c = 7 THEN 1 WHEN c = 9 THEN 2 WHEN c IN (0, 1) THEN 3 WHEN c = 2 THEN 4
              WHEN c = 3 THEN 5 WHEN c = 4 THEN 6 WHEN c = 5 THEN 7 END AS stage,
         CASE c WHEN 8 THEN 'Bâtiment non apparié, à plus de 20m d''un bâtiment RNB'
                WHEN 7 THEN 'Bâtiment non apparié, à plus de 20m d''un autre bâtiment BDUni'
                WHEN 9 THEN 'Croisement sémantique' WHEN 0 THEN 'Batiments semblables'
                WHEN 1 THEN 'Batiments semblables' WHEN 2 THEN 'Batiments semblables nbpt diff'
                WHEN 3 THEN 'Batiments RNB dissous semblables' WHEN 4 THEN 'Batiments inclus'
                WHEN 5 THEN 'Batiments BDTOPO balcon' END AS traitement
  FROM (SELECT k, c FROM rb WHERE c <> 8 UNION ALL SELECT k, c FROM lots WHERE c = 8)
  WHERE c <> 6) GROUP BY stage, traitement"""


# -- W2/W4: territory by construction (users 0-7 mod 10 mainland, 8 Réunion,
# 9 at sea), moved flag by construction (the latest version crept east
# unless event_id % 3 = 0).

LAST = """lc AS (
  SELECT l.*,
         strftime(ts, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
                 ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END
         || '+00:00' AS d,
         CASE WHEN user_id % 10 < 8 THEN 2154 WHEN user_id % 10 = 8 THEN 2975 END AS srid
  FROM latest l),
lc2 AS (
  SELECT *, '{"ext_ids": ' || coalesce(ext_ids, '') || ', "created_at": "'
            || CASE WHEN action = 'create' THEN d ELSE '' END || '", "updated_at": "'
            || CASE WHEN action = 'create' THEN '' ELSE d END || '", "identifiants_ban": '
            || coalesce(addresses_id, '') || '}' AS informations_rnb,
         CASE WHEN event_id::BIGINT % 4 = 0 THEN '[]' END AS parent_buildings
  FROM lc WHERE srid IS NOT NULL)"""

ORACLES["work_changed"] = _with(DIFF, LATEST, LINK_TABLE, LAST) + """
SELECT l.cleabs, CAST(NULL AS VARCHAR) AS gcms_fingerprint, r.rnb_id AS identifiant_rnb,
       r.informations_rnb, r.status, r.event_type, r.parent_buildings, CAST(r.srid AS BIGINT) AS srid,
       CASE WHEN r.pos % 3 <> 0 THEN 'to_link' ELSE '' END AS commentaire_centralise
FROM lc2 r JOIN link_table l ON l.identifiant_rnb = r.rnb_id
WHERE r.action = 'update' OR (r.action = 'create' AND r.event_type = 'reactivation')"""

ORACLES["work_new"] = _with(DIFF, LATEST, LINK_TABLE, LAST) + """
SELECT r.rnb_id AS identifiant_rnb, r.informations_rnb, r.status, r.event_type, r.parent_buildings,
       CAST(r.srid AS BIGINT) AS srid
FROM lc2 r
WHERE NOT EXISTS (SELECT 1 FROM link_table l WHERE l.identifiant_rnb = r.rnb_id)
  AND ((r.action = 'update' AND r.status = 'constructed') OR r.action = 'create')"""


ORACLES["sync_csv"] = _with(DIFF, LATEST, REMOVED) + """
, iso AS (SELECT rnb_id, event_id, action,
        strftime(ts, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
                ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END
        || '+00:00' AS d
  FROM latest)
SELECT i.rnb_id, i.event_id, i.action,
       CASE WHEN action = 'create' THEN d END AS created_at,
       CASE WHEN action = 'create' THEN NULL ELSE d END AS updated_at,
       r.rnb_id IS NOT NULL AS removed
FROM iso i LEFT JOIN removed r ON r.rnb_id = i.rnb_id"""

STAGING = """st AS (
  SELECT 'BATIMENT' || lpad(CAST(event_id AS VARCHAR), 16, '0') AS cleabs,
         (['T','true','1','f','FALSE','0','x',''])[(event_id % 8) + 1] AS cl,
         (['T','true','1','f','FALSE','0','x',''])[((event_id + 3) % 8) + 1] AS gd,
         event_id % 11 AS m, event_id % 5 AS m5, value, user_id, event_type
  FROM events)"""

ORACLES["staging_load"] = _with(STAGING) + """
SELECT cleabs,
  CASE WHEN lower(nullif(cl, '')) IN ('true','t','1') THEN true
       WHEN lower(nullif(cl, '')) IN ('false','f','0') THEN false END AS construction_legere,
  CASE WHEN lower(nullif(gd, '')) IN ('true','t','1') THEN true
       WHEN lower(nullif(gd, '')) IN ('false','f','0') THEN false END AS gcms_detruit,
  CASE WHEN m = 5 THEN NULL
       ELSE CAST(CAST(floor(value * 100) AS BIGINT) / 100.0 AS DECIMAL(6,2))::VARCHAR END AS hauteur,
  CASE WHEN m = 6 THEN NULL ELSE CAST(user_id AS INTEGER) END AS nombre_de_logements,
  CASE WHEN m IN (8, 9) THEN NULL ELSE event_type END AS metadonnees_unification,
  CASE WHEN m = 10 THEN NULL WHEN m5 = 0 THEN 4326 ELSE 0 END AS geometrie_srid,
  CASE WHEN m = 10 THEN NULL ELSE CAST(5 AS BIGINT) END AS npts
FROM st"""

ORACLES["srid_violations"] = _with(STAGING) + """
SELECT 'srid' AS "check", cleabs AS key, CAST(1 AS BIGINT) AS n FROM st WHERE m <> 10 AND m5 = 0"""

ORACLES["candidates_500m"] = ORACLES["candidates_100m"].replace("<= 100", "<= 500")

ORACLES["initial_pool"] = _with(DIFF, LATEST, LINK_TABLE, LAST) + """
SELECT DISTINCT r.rnb_id AS identifiant_rnb, r.informations_rnb
FROM lc2 r
WHERE (NOT EXISTS (SELECT 1 FROM link_table l WHERE l.identifiant_rnb = r.rnb_id)
       AND ((r.action = 'update' AND r.status = 'constructed') OR r.action = 'create'))
   OR (EXISTS (SELECT 1 FROM link_table l WHERE l.identifiant_rnb = r.rnb_id)
       AND (r.action = 'update' OR (r.action = 'create' AND r.event_type = 'reactivation')))"""

ORACLES["stream_upsert"] = "SELECT rnb_id, event_id FROM (" + ORACLES["diff_upsert"] + ")"

# What is left of each thin shape, corner by corner, in grid steps.
ORACLES["reduce_precision"] = """
WITH lots AS (
  SELECT p_partkey AS k, p_partkey % 8 AS c, 640 * (p_partkey % 100) AS x, 640 * CAST(floor(p_partkey / 100) AS BIGINT) AS y,
         10 * (8 + p_partkey % 7) AS w, 10 * (6 + p_size % 9) AS h
  FROM part)
SELECT k, CASE WHEN c IN (4, 6) THEN 2 ELSE 1 END AS parts,
       round(CASE c WHEN 4 THEN 32 WHEN 5 THEN w * h / 100.0 - 4 WHEN 6 THEN w * h / 100.0 - h / 10.0
                    WHEN 7 THEN 45 ELSE w * h / 100.0 END::DOUBLE, 4) AS area,
       list_reduce(list_transform(
         CASE c WHEN 1 THEN [[0, 0, 0], [0, w, 0], [0, w, h], [0, 30, h], [0, 0, h]]
                WHEN 2 THEN [[0, 0, 0], [0, w, 0], [0, w, h], [0, 30, h], [0, 0, h]]
                WHEN 4 THEN [[0, 0, 0], [0, 40, 0], [0, 40, 20], [0, 40, 40], [0, 0, 40],
                             [2, 80, 0], [0, 120, 0], [0, 120, 40], [0, 80, 40], [0, 80, 20]]
                WHEN 5 THEN [[0, 0, 0], [0, w, 0], [0, w, h], [0, 0, h], [1, 50, 20], [0, 50, 40], [0, 70, 40], [0, 70, 20]]
                WHEN 6 THEN [[0, 0, 0], [0, 40, 0], [0, 30, h], [0, 0, h], [2, 40, 0], [0, w, 0], [0, w, h], [0, 50, h]]
                WHEN 7 THEN [[0, 0, 0], [0, 40, 0], [0, 90, 0], [0, 90, 50], [0, 40, 50], [0, 0, 50]]
                ELSE [[0, 0, 0], [0, w, 0], [0, w, h], [0, 0, h]] END,
         lambda p: [' ', '/', '|'][p[1] + 1] || CAST(x + p[2] AS VARCHAR) || ',' || CAST(y + p[3] AS VARCHAR)),
         lambda a, b: a || b)[2:] AS rings
FROM lots"""


# Whole link rows as text: the fixture's rule in SQL.
LINK_ROWS = """lr AS (
  SELECT o_orderkey AS k,
         'L' || CASE WHEN o_orderkey % 89 = 3 THEN 'ABCDEFGHIJKLMNOPQRSTUVWX' ELSE '' END
             || CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey % 194 ELSE o_orderkey END AS cleabs,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS identifiant_rnb,
         CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'B' || o_orderkey || '/B1' END AS liens_vers_batiment,
         CASE WHEN o_orderkey % 53 = 7 THEN 'maybe' WHEN o_orderkey % 107 <> 8 THEN 'false' END AS gcms_detruit,
         CASE WHEN o_orderkey % 59 = 9 THEN '2024-13-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS created,
         CASE WHEN o_orderkey % 61 = 11 THEN '12x' WHEN o_orderkey % 101 <> 12 THEN CAST(o_orderkey % 50 AS VARCHAR) END AS gcms_numrec,
         CASE WHEN o_orderkey % 103 <> 14 THEN 'FXX' END AS gcms_territoire,
         CASE WHEN o_orderkey % 223 = 15 THEN 4326 ELSE 0 END AS srid_empreinte,
         CASE WHEN o_orderkey % 199 = 16 THEN NULL WHEN o_orderkey % 211 = 17 THEN 2154 ELSE 0 END AS srid_geometrie,
         CASE WHEN o_orderkey % 67 = 18 THEN '{broken' WHEN o_orderkey % 4 = 3 THEN '["a"]' END AS parent_buildings
  FROM orders)"""

ORACLES["links_load"] = _with(LINK_ROWS) + """, found AS (
  SELECT *, list_filter([
      CASE WHEN length(cleabs) > 24 THEN {'refused': 'cleabs=' || cleabs, 'reason': 'longer than 24'} END,
      CASE WHEN gcms_detruit IS NULL THEN {'refused': 'gcms_detruit', 'reason': 'null'}
           WHEN TRY_CAST(gcms_detruit AS BOOLEAN) IS NULL THEN {'refused': 'gcms_detruit=' || gcms_detruit, 'reason': 'boolean'} END,
      CASE WHEN TRY_CAST(created AS TIMESTAMP) IS NULL
           THEN {'refused': 'gcms_date_creation=' || created, 'reason': 'timestamp_ntz'} END,
      CASE WHEN gcms_numrec IS NULL THEN {'refused': 'gcms_numrec', 'reason': 'null'}
           WHEN TRY_CAST(gcms_numrec AS INTEGER) IS NULL THEN {'refused': 'gcms_numrec=' || gcms_numrec, 'reason': 'int'} END,
      CASE WHEN gcms_territoire IS NULL THEN {'refused': 'gcms_territoire', 'reason': 'null'} END,
      CASE WHEN srid_geometrie IS NULL THEN {'refused': 'geometrie', 'reason': 'null'} END,
      CASE WHEN parent_buildings = '{broken' THEN {'refused': 'parent_buildings={broken', 'reason': 'json'} END],
    lambda x: x IS NOT NULL) AS p FROM lr)
SELECT cleabs, liens_vers_batiment, CAST(gcms_detruit AS BOOLEAN) AS gcms_detruit, left(created, 10) AS created,
       CAST(gcms_numrec AS INTEGER) AS gcms_numrec, parent_buildings,
       CAST(NULL AS VARCHAR) AS refused, CAST(NULL AS VARCHAR) AS reason, CAST(0 AS INTEGER) AS problems
FROM found WHERE len(p) = 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, p[1].refused, p[1].reason, CAST(len(p) AS INTEGER) FROM found WHERE len(p) > 0"""

ORACLES["schema_violations"] = _with(LINK_ROWS) + """
SELECT 'unique:cleabs' AS "check", cleabs AS key, count(*) AS n FROM lr GROUP BY cleabs HAVING count(*) > 1
UNION ALL
SELECT 'unique:identifiant_rnb', identifiant_rnb, count(*) FROM lr
WHERE identifiant_rnb IS NOT NULL GROUP BY identifiant_rnb HAVING count(*) > 1
UNION ALL
SELECT 'unique:identifiant_rnb,gcms_numrec', identifiant_rnb || '|' || gcms_numrec, count(*) FROM lr
WHERE identifiant_rnb IS NOT NULL AND gcms_numrec IS NOT NULL GROUP BY identifiant_rnb, gcms_numrec HAVING count(*) > 1
UNION ALL
SELECT 'not_null:' || c, c, n FROM (
  SELECT 'gcms_detruit' AS c, count(*) FILTER (WHERE gcms_detruit IS NULL) AS n FROM lr
  UNION ALL SELECT 'gcms_numrec', count(*) FILTER (WHERE gcms_numrec IS NULL) FROM lr
  UNION ALL SELECT 'gcms_territoire', count(*) FILTER (WHERE gcms_territoire IS NULL) FROM lr
  UNION ALL SELECT 'geometrie', count(*) FILTER (WHERE srid_geometrie IS NULL) FROM lr) WHERE n > 0
UNION ALL
SELECT 'srid:gcvs_empreinte', cleabs, count(*) FROM lr WHERE srid_empreinte <> 0 GROUP BY cleabs
UNION ALL
SELECT 'srid:geometrie', cleabs, count(*) FROM lr WHERE srid_geometrie <> 0 GROUP BY cleabs"""

# One part, one ring: two headers, three counts, an SRID and the ordinates.
ORACLES["wkb_load"] = _with(LOTS, RB, BB) + """, both_sides AS (
  SELECT cleabs AS id, k, x0, y0, x1, y1, 5 AS npts FROM rb UNION ALL SELECT cleabs, k, x0, y0, x1, y1, npts FROM bb)
SELECT id, CAST(2 * (5 + 5 + 4 + 4 + 4 + CASE WHEN k % 3 < 2 THEN 4 ELSE 0 END
                     + npts * CASE WHEN k % 5 < 2 THEN 24 ELSE 16 END) AS BIGINT) AS hex_chars,
       CASE k % 3 WHEN 0 THEN 2154 WHEN 1 THEN 4326 ELSE 0 END AS srid, CAST(npts AS BIGINT) AS npts,
       round((x1 - x0) * (y1 - y0), 4) AS area,
       CAST(x0 AS DOUBLE) AS xmin, CAST(x1 AS DOUBLE) AS xmax, CAST(y0 AS DOUBLE) AS ymin, CAST(y1 AS DOUBLE) AS ymax
FROM both_sides"""
