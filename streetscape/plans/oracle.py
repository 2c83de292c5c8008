"""DuckDB SQL for the driver's correctness check: the same views as ``plans.views`` and, per
query, the plain-SQL statement of what the Spark operators compute."""

from __future__ import annotations

from streetscape.operators.atlas import ALIAS_GLOBS
from streetscape.plans.views import TEST_PARCELS


def _values(rows: list[tuple]) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)


_PARCELS = _values([(p, i) for i, p in enumerate(TEST_PARCELS)])
_ALIASES = _values([(a, i) for i, a in enumerate(ALIAS_GLOBS)])
_PATTERNS = _values([(a, i, p) for i, (a, ps) in enumerate(ALIAS_GLOBS.items()) for p in ps])

BASE = f"""
captures AS (
  SELECT CAST(event_id AS VARCHAR) AS image_id,
         -0.1465e0 + (event_id % 1000) * 6.5e-6 AS lon,
         51.5405e0 + (user_id % 150) * 2e-5 AS lat,
         value % 360 AS compass_angle,
         epoch_us(ts) // 1000 AS captured_at_ms,
         ts AS captured_at,
         event_type AS camera_type,
         event_type = 'error' AS is_pano,
         CAST(user_id AS VARCHAR) AS sequence_id,
         user_id AS creator_id,
         2048 AS width, 1536 AS height,
         'https://img.example/' || CAST(event_id AS VARCHAR) || '.jpg' AS thumb_2048_url,
         event_id // 1000 AS page, event_id % 1000 AS pos, event_id
  FROM events),
camden AS (SELECT * FROM captures WHERE lon BETWEEN -0.1465e0 AND -0.1422e0 AND lat BETWEEN 51.5405e0 AND 51.543e0),
blobs AS (SELECT CAST(doc_id AS VARCHAR) AS image_id, text FROM documents),
shard1 AS (
  SELECT c.image_id, sha256(b.text) AS image_sha256, 'image/jpeg' AS image_mime, CAST(strlen(b.text) AS BIGINT) AS image_bytes,
         c.width AS image_width, c.height AS image_height, TIMESTAMP '2024-01-16 00:00:00' AS downloaded_at,
         'mapillary' AS source, '-0.146500,51.540500,-0.142200,51.543000' AS mapillary_bbox_query,
         c.lon, c.lat, c.compass_angle, epoch_ms(c.captured_at_ms) AS captured_at, c.camera_type, c.is_pano,
         c.sequence_id, c.creator_id, 'shard-1.parquet' AS source_file, c.event_id AS row_index
  FROM captures c JOIN blobs b ON b.image_id = c.image_id
  WHERE c.event_id % 3 = 0),
store AS (
  SELECT * FROM shard1
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '2024-01-17 00:00:00' AS downloaded_at, 'shard-2.parquet' AS source_file)
  FROM shard1 WHERE camera_type = 'error'),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY downloaded_at DESC, source_file DESC, row_index DESC) AS rn
    FROM store) WHERE rn = 1),
segments AS (SELECT CAST(vec_id // 5 AS VARCHAR) AS image_id, CAST(vec_id % 5 AS INTEGER) AS segment_idx, embedding AS activity FROM embeddings),
seg_long AS (SELECT image_id, generate_subscripts(activity, 1) - 1 AS pos, unnest(activity) AS value FROM segments),
collapsed AS (SELECT image_id, pos, CAST(avg(CAST(value AS DOUBLE)) AS FLOAT) AS value, count(*) AS n_segments FROM seg_long GROUP BY image_id, pos),
parcels AS (SELECT * FROM (VALUES {_PARCELS}) t(parcel, ordinal)),
atlas AS (SELECT p.parcel, p.ordinal, p.ordinal * 4 + v.j AS vertex FROM parcels p CROSS JOIN (SELECT range AS j FROM range(4)) v),
aliases AS (SELECT * FROM (VALUES {_ALIASES}) t(alias, alias_ord)),
alias_patterns AS (SELECT * FROM (VALUES {_PATTERNS}) t(alias, alias_ord, pattern)),
alias_parcels AS (SELECT DISTINCT m.alias, m.alias_ord, p.parcel FROM parcels p JOIN alias_patterns m ON p.parcel GLOB m.pattern),
parcel_means AS (
  SELECT c.image_id, a.parcel, a.ordinal, avg(CAST(c.value AS DOUBLE)) AS mean
  FROM collapsed c JOIN atlas a ON a.vertex = c.pos GROUP BY c.image_id, a.parcel, a.ordinal),
matched_scores AS (
  SELECT pm.image_id, ap.alias, ap.alias_ord, avg(pm.mean) AS score
  FROM parcel_means pm JOIN alias_parcels ap ON ap.parcel = pm.parcel GROUP BY pm.image_id, ap.alias, ap.alias_ord),
alias_scores AS (
  SELECT i.image_id, a.alias, a.alias_ord, coalesce(s.score, 'NaN'::DOUBLE) AS score
  FROM (SELECT DISTINCT image_id FROM collapsed) i CROSS JOIN aliases a
  LEFT JOIN matched_scores s ON s.image_id = i.image_id AND s.alias = a.alias),
top_regions AS (
  SELECT * FROM (
    SELECT image_id, alias AS name, CAST(score AS FLOAT) AS score,
           row_number() OVER (PARTITION BY image_id ORDER BY score DESC, alias_ord) AS rank
    FROM alias_scores WHERE NOT isnan(score)) WHERE rank <= 10),
scored AS (
  SELECT v.image_id, v.n_activity, v.activity_sum, coalesce(t.regions, '') AS regions, coalesce(t.region_sum, 0) AS region_sum
  FROM (SELECT image_id, count(*) AS n_activity, round(sum(CAST(value AS DOUBLE) * (pos + 1) ORDER BY pos), 3) AS activity_sum FROM collapsed GROUP BY image_id) v
  LEFT JOIN (SELECT image_id, string_agg(name, ',' ORDER BY rank) AS regions, round(sum(CAST(score AS DOUBLE) * rank ORDER BY rank), 5) AS region_sum
             FROM top_regions GROUP BY image_id) t ON t.image_id = v.image_id),
labels AS (
  SELECT CASE WHEN vec_id % 2 = 0 THEN 'L_' ELSE 'R_' END || p.parcel || '_ROI-' || CASE WHEN vec_id % 2 = 0 THEN 'lh' ELSE 'rh' END AS name,
         CASE WHEN vec_id % 2 = 0 THEN 'lh' ELSE 'rh' END AS hemi, vec_id * 7 % 11000 AS vertex
  FROM embeddings e JOIN parcels p ON p.ordinal = (e.label + e.vec_id) % 16),
merged_labels AS (
  SELECT parcel, CAST(dense_rank() OVER (ORDER BY parcel) - 1 AS INTEGER) AS ordinal, hemi, vertex
  FROM (SELECT replace(replace(replace(substr(name, 3), '_ROI', ''), '-rh', ''), '-lh', '') AS parcel, hemi,
               CAST(CASE WHEN hemi = 'rh' THEN vertex + 10242 ELSE vertex END AS INTEGER) AS vertex
        FROM labels WHERE vertex < 10242)),
label_alias AS (SELECT DISTINCT m.alias, m.alias_ord, p.parcel FROM (SELECT DISTINCT parcel FROM merged_labels) p JOIN alias_patterns m ON p.parcel GLOB m.pattern)
"""


def with_base(select_sql: str) -> str:
    return "WITH " + BASE.strip() + "\n" + select_sql.strip()


def wkb_hex(lon: str, lat: str) -> str:
    return f"hex(ST_AsWKB(('POINT (' || CAST({lon} AS VARCHAR) || ' ' || CAST({lat} AS VARCHAR) || ')')::GEOMETRY))"


def square_sql(lon: str, lat: str, side: str) -> tuple[str, str, str, str]:
    dlat = f"({side} / 111320.0e0)"
    dlon = f"({side} / (111320.0e0 * cos({lat} * pi() / 180.0e0)))"
    return (f"({lon} - {dlon} / 2.0e0)", f"({lat} - {dlat} / 2.0e0)", f"({lon} + {dlon} / 2.0e0)", f"({lat} + {dlat} / 2.0e0)")


def _sq(lon="lon", lat="lat", side="300.0e0"):
    return square_sql(lon, lat, side)


_W, _S, _E, _N = _sq()
_AW, _AS, _AE, _AN = _sq(side="(compass_angle * 100.0e0)")

_AREA = f"(({_AE}) - ({_AW})) * (({_AN}) - ({_AS}))"

SQL: dict[str, str] = {
    "square_bbox": with_base(f"""
        SELECT image_id, round({_W}, 9) AS west, round({_S}, 9) AS south, round({_E}, 9) AS east, round({_N}, 9) AS north
        FROM captures"""),
    "bbox_text": with_base(f"""
        SELECT image_id, printf('%.6f,%.6f,%.6f,%.6f', {_W}, {_S}, {_E}, {_N}) AS bbox_text FROM captures"""),
    "bbox_area_guard": with_base(f"""
        SELECT image_id, round({_AREA}, 12) AS area, {_AREA} <= 0.01e0 AS within_limit FROM captures"""),
    "tile_aoi": with_base(f"""
        , boxes AS (SELECT image_id, {_AW} AS w, {_AS} AS s, {_AE} AS e, {_AN} AS n FROM captures)
        , sized AS (SELECT *, CAST(greatest(1, ceil(sqrt(((e - w) * (n - s)) / 0.01e0))) AS INTEGER) AS k FROM boxes)
        , tiles AS (
            SELECT image_id, w, s, e, n, k, r.range AS tile_row, c.range AS tile_col
            FROM sized, range(k) r, range(k) c)
        SELECT image_id, k * k AS n_tiles, CAST(tile_row AS INTEGER) AS tile_row, CAST(tile_col AS INTEGER) AS tile_col,
               round(w + tile_col * ((e - w) / k), 9) AS west,
               round(s + tile_row * ((n - s) / k), 9) AS south,
               round(CASE WHEN tile_col = k - 1 THEN e ELSE w + (tile_col + 1) * ((e - w) / k) END, 9) AS east,
               round(CASE WHEN tile_row = k - 1 THEN n ELSE s + (tile_row + 1) * ((n - s) / k) END, 9) AS north
        FROM tiles""").replace("WITH captures", "WITH captures", 1),
    "within_bbox": with_base("SELECT image_id, lon, lat FROM camden"),
    "multi_aoi_join": with_base(f"""
        , seq AS (SELECT sequence_id, min(lon) AS lon0, min(lat) AS lat0 FROM captures GROUP BY sequence_id)
        , aois AS (
            SELECT 'camden' AS aoi, -0.1465e0 AS west, 51.5405e0 AS south, -0.1422e0 AS east, 51.543e0 AS north
            UNION ALL SELECT 'borough', -0.0925e0, 51.5043e0, -0.0882e0, 51.5068e0
            UNION ALL SELECT 'seq-' || sequence_id, {', '.join(square_sql('lon0', 'lat0', '30.0e0'))} FROM seq)
        SELECT a.aoi, c.image_id FROM captures c JOIN aois a
          ON c.lon BETWEEN a.west AND a.east AND c.lat BETWEEN a.south AND a.north"""),
    "point_wkb": with_base(f"SELECT image_id, {wkb_hex('lon', 'lat')} AS geom_hex FROM camden"),
    "parse_captures": with_base("""
        , ev AS (SELECT *, -0.1465e0 + (event_id % 1000) * 6.5e-6 AS lon_, 51.5405e0 + (user_id % 150) * 2e-5 AS lat_ FROM events)
        , p AS (
          SELECT event_id // 1000 AS page, event_id % 1000 AS pos,
            CASE WHEN value > 489 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS image_id,
            CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE lon_ END AS lon,
            CASE WHEN event_type = 'view' AND value < 5 THEN NULL ELSE lat_ END AS lat,
            CASE WHEN event_type = 'click' THEN NULL ELSE value % 360 END AS compass_angle,
            CASE WHEN event_type = 'signup' AND value < 5 THEN NULL ELSE epoch_us(ts) // 1000 END AS captured_at_ms,
            event_type AS camera_type,
            CASE WHEN user_id % 3 = 0 THEN false ELSE event_type = 'error' END AS is_pano,
            CASE WHEN event_type = 'purchase' AND value < 5 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sequence_id,
            CASE WHEN user_id % 4 = 1 THEN NULL ELSE user_id END AS creator_id,
            CASE WHEN value >= 100 AND value < 101 THEN NULL ELSE 2048 END AS width,
            1536 AS height,
            CASE WHEN event_type = 'purchase' AND value < 10 THEN '' ELSE 'https://img.example/' || CAST(event_id AS VARCHAR) || '.jpg' END AS thumb_2048_url,
            (value > 489) OR (value >= 100 AND value < 101) AS bad
          FROM ev)
        SELECT page, pos, image_id, lon, lat, compass_angle, captured_at_ms, camera_type, is_pano, sequence_id, creator_id,
               width, height, thumb_2048_url,
               CASE WHEN bad THEN 'bad_record'
                    WHEN lon IS NULL OR lat IS NULL THEN 'no_coordinates'
                    WHEN is_pano <> false THEN 'pano_mismatch'
                    WHEN captured_at_ms IS NULL THEN 'no_captured_at'
                    WHEN coalesce(length(thumb_2048_url), 0) = 0 THEN 'no_url' END AS reject_reason
        FROM p"""),
    "filter_pano": with_base("SELECT image_id, camera_type FROM captures WHERE NOT coalesce(is_pano, false)"),
    "filter_captured": with_base("""
        SELECT image_id, captured_at FROM captures
        WHERE captured_at >= TIMESTAMP '2024-01-08 00:00:00' AND captured_at <= TIMESTAMP '2024-01-21 12:00:00'"""),
    "cap_candidates": with_base("""
        , first_cap AS (SELECT * FROM captures ORDER BY page, pos LIMIT 1000)
        SELECT image_id, lon, lat FROM first_cap
        WHERE lon BETWEEN -0.1465e0 AND -0.1422e0 AND lat BETWEEN 51.5405e0 AND 51.543e0"""),
    "build_image_rows": with_base("""
        SELECT c.image_id, sha256(b.text) AS image_sha256, 'image/jpeg' AS image_mime, CAST(strlen(b.text) AS BIGINT) AS image_bytes,
               c.width AS image_width, c.height AS image_height, epoch_ms(c.captured_at_ms + 86400000) AS downloaded_at,
               'mapillary' AS source, '-0.146500,51.540500,-0.142200,51.543000' AS mapillary_bbox_query,
               c.lon, c.lat, c.compass_angle, epoch_ms(c.captured_at_ms) AS captured_at, c.camera_type, c.is_pano,
               c.sequence_id, c.creator_id
        FROM captures c JOIN blobs b ON b.image_id = c.image_id"""),
    "new_images": with_base("SELECT image_id FROM camden c WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.image_id = c.image_id)"),
    "cached_images": with_base("SELECT image_id FROM camden c WHERE EXISTS (SELECT 1 FROM store s WHERE s.image_id = c.image_id)"),
    "id_set_ops": with_base("""
        (SELECT image_id, 'new' AS side FROM (SELECT image_id FROM camden EXCEPT SELECT image_id FROM store))
        UNION ALL
        (SELECT image_id, 'cached' AS side FROM (SELECT image_id FROM camden INTERSECT SELECT image_id FROM store))"""),
    "working_set": with_base("""
        SELECT c.image_id, l.image_sha256, l.image_bytes, CASE WHEN l.image_id IS NULL THEN 'not_in_cache' END AS drop_reason
        FROM camden c LEFT JOIN latest l ON l.image_id = c.image_id"""),
    "audit_drops": with_base("""
        SELECT image_id, 'out_of_bbox' AS drop_reason FROM captures
        WHERE NOT coalesce(lon BETWEEN -0.1465e0 AND -0.1422e0 AND lat BETWEEN 51.5405e0 AND 51.543e0, false)
        UNION ALL
        SELECT c.image_id, 'not_in_cache' FROM camden c WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.image_id = c.image_id)"""),
    "latest_rows": with_base("SELECT image_id, downloaded_at, source_file, image_sha256 FROM latest"),
    "store_index": with_base("SELECT image_id, downloaded_at, image_sha256, image_bytes, source_file FROM latest"),
    "store_stats": with_base("""
        SELECT count(*) AS n_rows, count(DISTINCT source_file) AS n_shards, CAST(coalesce(sum(image_bytes), 0) AS BIGINT) AS total_bytes,
               min(captured_at) AS oldest_captured_at, max(captured_at) AS newest_captured_at FROM store"""),
    "union_by_name": with_base("""
        SELECT image_id, source_file, image_width, image_height FROM store WHERE source_file = 'shard-1.parquet'
        UNION ALL BY NAME
        SELECT image_id, source_file FROM store WHERE source_file = 'shard-2.parquet'"""),
    "collapse_mean": with_base("SELECT image_id, CAST(pos AS INTEGER) AS pos, round(CAST(value AS DOUBLE), 6) AS value FROM collapsed"),
    "collapse_max": with_base("""
        SELECT image_id, CAST(pos AS INTEGER) AS pos, round(CAST(max(value) AS DOUBLE), 6) AS value FROM seg_long GROUP BY image_id, pos"""),
    "parcel_means": with_base("SELECT image_id, parcel, round(mean, 6) AS mean FROM parcel_means"),
    "name_parcels": with_base("""
        SELECT c.image_id, p.ordinal, p.parcel AS name, round(CAST(c.value AS DOUBLE), 6) AS value
        FROM collapsed c JOIN parcels p ON p.ordinal = c.pos"""),
    "alias_parcels": with_base("SELECT alias, parcel FROM label_alias"),
    "alias_scores": with_base("SELECT image_id, alias, round(score, 6) AS score FROM alias_scores"),
    "top_regions": with_base("""
        SELECT image_id, CAST(rank AS INTEGER) AS rank, name, round(CAST(score AS DOUBLE), 6) AS score FROM top_regions"""),
    "merge_labels": with_base("SELECT parcel, ordinal, hemi, vertex FROM merged_labels"),
    "label_means": with_base("""
        SELECT c.image_id, l.parcel, l.ordinal, round(avg(CAST(c.value AS DOUBLE)), 6) AS mean
        FROM collapsed c JOIN merged_labels l ON l.vertex = c.pos GROUP BY ALL"""),
    "alias_vertices": with_base("""
        , hits AS (SELECT a.alias, a.parcel, m.vertex FROM label_alias a JOIN merged_labels m ON m.parcel = a.parcel)
        , sizes AS (SELECT a.alias, count(DISTINCT h.parcel) AS n_parcels, count(DISTINCT h.vertex) AS n_vertices
                    FROM aliases a LEFT JOIN hits h ON h.alias = a.alias GROUP BY a.alias)
        SELECT DISTINCT s.alias, s.n_parcels, s.n_vertices, h.vertex FROM sizes s LEFT JOIN hits h ON h.alias = s.alias"""),
    "pseudo_clip_plan": with_base("""
        , imgs AS (SELECT DISTINCT sequence_id, captured_at, image_id FROM captures)
        , ranked AS (
            SELECT sequence_id, image_id, row_number() OVER (PARTITION BY sequence_id ORDER BY captured_at, image_id) - 1 AS i,
                   count(*) OVER (PARTITION BY sequence_id) AS n FROM imgs)
        , rep AS (SELECT *, CASE WHEN n >= 64 THEN 1 ELSE CAST(ceil(64 / n) AS BIGINT) END AS r FROM ranked)
        SELECT sequence_id, CAST(f.range AS INTEGER) AS frame_idx, image_id
        FROM rep, range(i * r, least(i * r + r, 64)) f
        WHERE i * r < 64"""),
}

_DELIVERABLE = f"""
    , dl AS (
        SELECT l.image_id, l.image_mime, l.captured_at, l.compass_angle, l.camera_type, {wkb_hex('l.lon', 'l.lat')} AS geom_hex,
               l.image_bytes AS blob_bytes, s.n_activity, s.activity_sum, s.regions, s.region_sum,
               'POINT (' || CAST(l.lon AS VARCHAR) || ' ' || CAST(l.lat AS VARCHAR) || ')' AS geom_wkt
        FROM latest l JOIN scored s ON s.image_id = l.image_id
        WHERE l.lon BETWEEN -0.1465e0 AND -0.1422e0 AND l.lat BETWEEN 51.5405e0 AND 51.543e0)
"""

SQL["deliverable"] = with_base(
    _DELIVERABLE
    + "SELECT image_id, image_mime, captured_at, compass_angle, camera_type, geom_hex, blob_bytes, n_activity, activity_sum, regions, region_sum FROM dl"
)
SQL["preview"] = with_base(
    _DELIVERABLE
    + "SELECT image_id, captured_at, geom_wkt, 'OGC:CRS84' AS crs, blob_bytes, n_activity FROM dl ORDER BY captured_at, image_id LIMIT 10"
)
SQL["geometry_types"] = with_base(
    _DELIVERABLE
    + """SELECT DISTINCT CASE substr(geom_hex, 3, 8) WHEN '01000000' THEN 'point' WHEN '02000000' THEN 'linestring'
            WHEN '03000000' THEN 'polygon' END AS geometry_type FROM dl"""
)
SQL["stage_counts"] = with_base("""
    , cand AS (SELECT image_id FROM camden)
    , cached AS (SELECT image_id FROM cand WHERE image_id IN (SELECT image_id FROM store))
    , downloaded AS (SELECT c.image_id FROM cand c JOIN blobs b ON b.image_id = c.image_id WHERE c.image_id NOT IN (SELECT image_id FROM store))
    , working AS (SELECT image_id FROM cached UNION ALL SELECT image_id FROM downloaded)
    , hits AS (SELECT image_id FROM working WHERE image_id IN (SELECT image_id FROM scored))
    , inferred AS (SELECT w.image_id FROM working w JOIN blobs b ON b.image_id = w.image_id
                   WHERE w.image_id NOT IN (SELECT image_id FROM scored) AND strlen(b.text) > 0)
    SELECT (SELECT count(*) FROM cand) AS candidates, (SELECT count(*) FROM cached) AS cached,
           (SELECT count(*) FROM downloaded) AS downloaded, (SELECT count(*) FROM hits) AS inference_cache_hit,
           (SELECT count(*) FROM inferred) AS inferred,
           (SELECT count(*) FROM hits) + (SELECT count(*) FROM inferred) AS written""")



def model_ctes(items: str) -> str:
    """CTEs of the stand-in model over ``items`` (image_id, h: hex of the blob): its segments, their collapse,
    scores and regions, named m_*."""
    return f"""
    , m_hex AS (SELECT image_id, h FROM {items} WHERE length(h) > 0)
    , m_bytes AS (SELECT image_id, len(h) // 2 AS n_bytes, unnest(regexp_extract_all(h, '..')) AS x, generate_subscripts(regexp_extract_all(h, '..'), 1) - 1 AS k FROM m_hex)
    , m_seen AS (SELECT image_id, n_bytes, k % 64 AS lane, avg(('0x' || x)::INTEGER) AS m FROM m_bytes GROUP BY ALL)
    , m_lanes AS (SELECT i.image_id, i.n_bytes, l.range AS lane, coalesce(s.m, 0) AS m
                  FROM (SELECT DISTINCT image_id, n_bytes FROM m_seen) i CROSS JOIN range(64) l LEFT JOIN m_seen s ON s.image_id = i.image_id AND s.lane = l.range)
    , m_segs AS (SELECT l.image_id, CAST(s.range AS INTEGER) AS segment_idx, l.lane, CAST((l.m + s.range) / 255.0 AS FLOAT) AS v FROM m_lanes l, range(1 + l.n_bytes % 3) s)
    , m_collapsed AS (SELECT image_id, lane, CAST(avg(CAST(v AS DOUBLE)) AS FLOAT) AS v FROM m_segs GROUP BY image_id, lane)
    , m_means AS (SELECT c.image_id, a.parcel, avg(CAST(c.v AS DOUBLE)) AS mean FROM m_collapsed c JOIN atlas a ON a.vertex = c.lane GROUP BY ALL)
    , m_scores AS (SELECT m.image_id, ap.alias, ap.alias_ord, avg(m.mean) AS score FROM m_means m JOIN alias_parcels ap ON ap.parcel = m.parcel GROUP BY ALL)
    , m_regions AS (SELECT image_id, string_agg(alias, ',' ORDER BY score DESC, alias_ord) AS regions FROM (
          SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, alias_ord) AS rank FROM m_scores) WHERE rank <= 10 GROUP BY image_id)
    , m_scored AS (SELECT c.image_id, count(*) AS n_activity, round(sum(CAST(c.v AS DOUBLE) * (c.lane + 1) ORDER BY c.lane), 3) AS activity_sum, any_value(r.regions) AS regions
                   FROM m_collapsed c JOIN m_regions r ON r.image_id = c.image_id GROUP BY c.image_id)
    """


SQL["score_images"] = with_base(f"""
    , items AS (SELECT l.image_id, hex(encode(b.text)) AS h FROM latest l JOIN blobs b ON b.image_id = l.image_id)
    {model_ctes('items')}
    SELECT image_id, segment_idx, count(*) AS n_values, round(sum(CAST(v AS DOUBLE) * (lane + 1) ORDER BY lane), 3) AS activity_sum
    FROM m_segs GROUP BY image_id, segment_idx""")
SQL["geo_roundtrip"] = SQL["deliverable"]
_INGESTED = """
    , parsed AS (
        SELECT CAST(event_id AS VARCHAR) AS image_id, -0.1465e0 + (event_id % 1000) * 6.5e-6 AS lon, 51.5405e0 + (user_id % 150) * 2e-5 AS lat
        FROM events
        WHERE NOT (value > 489 OR (value >= 100 AND value < 101))
          AND NOT (event_type = 'view' AND value < 5)
          AND NOT (user_id % 3 <> 0 AND event_type = 'error')
          AND NOT (event_type = 'signup' AND value < 5)
          AND NOT (event_type = 'purchase' AND value < 10))
    , ingested AS (
        SELECT p.image_id, sha256(b.text) AS image_sha256, CAST(strlen(b.text) AS BIGINT) AS image_bytes, p.lon, p.lat
        FROM parsed p JOIN blobs b ON b.image_id = p.image_id
        WHERE p.lon BETWEEN -0.1465e0 AND -0.1422e0 AND p.lat BETWEEN 51.5405e0 AND 51.543e0)
"""
SQL["stream_ingest"] = with_base(_INGESTED + "SELECT * FROM ingested")
SQL["stream_score"] = with_base(
    _INGESTED
    + ", items AS (SELECT i.image_id, hex(encode(b.text)) AS h FROM ingested i JOIN blobs b ON b.image_id = i.image_id)"
    + model_ctes("items")
    + "SELECT image_id, n_activity, activity_sum, regions FROM m_scored"
)

SQL["alias_atlas_json"] = with_base("""
    , hits AS (SELECT a.alias, list_sort(list(DISTINCT m.vertex)) AS vertices FROM label_alias a JOIN merged_labels m ON m.parcel = a.parcel GROUP BY a.alias)
    SELECT '{' || string_agg('"' || a.alias || '":[' || coalesce(array_to_string(h.vertices, ','), '') || ']', ',' ORDER BY a.alias_ord) || '}' AS alias_atlas
    FROM aliases a LEFT JOIN hits h ON h.alias = a.alias""")
SQL["stack_segments"] = with_base("""
    , cells AS (
        SELECT image_id, segment_idx, generate_subscripts(activity, 1) AS i, unnest(activity) AS v FROM segments)
    , placed AS (SELECT image_id, segment_idx, v, row_number() OVER (PARTITION BY image_id ORDER BY segment_idx, i) AS place FROM cells)
    SELECT image_id, count(DISTINCT segment_idx) AS n_segments, round(sum(CAST(v AS DOUBLE) * place ORDER BY place), 3) AS stack_sum
    FROM placed GROUP BY image_id""")
SQL["attach_timeline"] = with_base("""
    SELECT c.image_id, s.segment_idx FROM segments s JOIN camden c ON c.image_id = s.image_id""")
SQL["load_scores"] = with_base("""
    SELECT s.image_id, s.n_activity, s.activity_sum, s.regions, s.region_sum
    FROM scored s WHERE s.image_id IN (SELECT image_id FROM camden)""")

_LANDED = """
    , landed AS (SELECT image_id, CASE WHEN CAST(image_id AS BIGINT) % 7 = 0 THEN '00000000' ELSE 'FFD8FFE0' END
                        || CASE WHEN CAST(image_id AS BIGINT) % 11 = 0 THEN '4641494C' ELSE '' END || hex(encode(text)) AS h FROM blobs)
"""
_KEPT = """
    , kept AS (
        SELECT CAST(event_id AS VARCHAR) AS image_id, -0.1465e0 + (event_id % 1000) * 6.5e-6 AS lon,
               51.5405e0 + (user_id % 150) * 2e-5 AS lat, epoch_ms(epoch_us(ts) // 1000) AS captured_at, event_type AS camera_type
        FROM events
        WHERE NOT (value > 489 OR (value >= 100 AND value < 101))
          AND NOT (event_type = 'view' AND value < 5)
          AND NOT (user_id % 3 <> 0 AND event_type = 'error')
          AND NOT (event_type = 'signup' AND value < 5)
          AND NOT (event_type = 'purchase' AND value < 10))
    , cands AS (SELECT * FROM kept WHERE lon BETWEEN -0.1465e0 AND -0.1422e0 AND lat BETWEEN 51.5405e0 AND 51.543e0)
    , found AS (SELECT c.image_id, l.h, CASE WHEN substr(l.h, 1, 6) <> 'FFD8FF' THEN 'not_image' WHEN l.h LIKE 'FFD8FFE04641494C%' THEN 'inference_failed' END AS reason
                FROM cands c JOIN landed l ON l.image_id = c.image_id)
"""
SQL["pipeline_run"] = with_base(f"""
    {_LANDED}{_KEPT}
    , items AS (SELECT image_id, h FROM found WHERE reason IS NULL)
    {model_ctes('items')}
    SELECT k.image_id, 'image/jpeg' AS image_mime, k.captured_at, k.camera_type, {wkb_hex('k.lon', 'k.lat')} AS geom_hex,
           CAST(length(i.h) // 2 AS BIGINT) AS blob_bytes, s.n_activity, s.activity_sum, s.regions
    FROM kept k JOIN items i ON i.image_id = k.image_id JOIN m_scored s ON s.image_id = k.image_id""")
SQL["run_rejects"] = with_base(f"""
    {_LANDED}{_KEPT}
    , parsed AS ({SQL["parse_captures"].split("FROM ev)")[0].split(", p AS (")[1]} FROM (
          SELECT *, -0.1465e0 + (event_id % 1000) * 6.5e-6 AS lon_, 51.5405e0 + (user_id % 150) * 2e-5 AS lat_ FROM events))
    SELECT 'parse' AS stage, image_id,
           CASE WHEN bad THEN 'bad_record' WHEN lon IS NULL OR lat IS NULL THEN 'no_coordinates' WHEN is_pano <> false THEN 'pano_mismatch'
                WHEN captured_at_ms IS NULL THEN 'no_captured_at' ELSE 'no_url' END AS reason
    FROM parsed WHERE bad OR lon IS NULL OR lat IS NULL OR is_pano <> false OR captured_at_ms IS NULL OR coalesce(length(thumb_2048_url), 0) = 0
    UNION ALL SELECT 'aoi', image_id, 'out_of_bbox' FROM kept WHERE image_id NOT IN (SELECT image_id FROM cands)
    UNION ALL SELECT 'download', image_id, 'download_failed' FROM cands WHERE image_id NOT IN (SELECT image_id FROM landed)
    UNION ALL SELECT CASE reason WHEN 'not_image' THEN 'download' ELSE 'inference' END, image_id, reason FROM found WHERE reason IS NOT NULL""")
SQL["geo_verify"] = with_base(
    _DELIVERABLE
    + "SELECT '2.0.0' AS version, 'geom' AS primary_column, 'point' AS geo_types, count(*) AS n_rows, CAST(9 AS BIGINT) AS n_columns, 'OGC:CRS84' AS crs FROM dl"
)
SQL["scan_segments"] = with_base("""
    , cells AS (SELECT image_id, segment_idx, generate_subscripts(activity, 1) AS place, unnest(activity) AS v FROM segments)
    SELECT image_id, 'clip_' || image_id AS timeline, segment_idx, round(sum(CAST(v AS DOUBLE) * place ORDER BY place), 3) AS activity_sum
    FROM cells GROUP BY image_id, segment_idx""")
SQL["scan_labels"] = with_base("SELECT name, hemi, vertex FROM labels")
SQL["drop_sentinel"] = with_base("SELECT image_id, source_file FROM store WHERE CAST(image_id AS BIGINT) % 5 <> 0 AND CAST(image_id AS BIGINT) % 7 <> 0")
SQL["normalize_regions"] = with_base("SELECT image_id, regions, region_sum FROM scored")
SQL["write_alias_atlas"] = SQL["alias_atlas_json"]
