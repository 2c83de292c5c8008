"""Queries over real files: bucketed and clustered stores, GeoParquet read back by box, linked pages, streams with state
and ledger, the run's record. Each derives its files from the test tables, and ``SQL`` tells the same in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetscape.operators import atlas as AT
from streetscape.operators import deliverable as D
from streetscape.operators import scoring as M
from streetscape.operators import store as ST
from streetscape.operators.aoi import tiles_by_content
from streetscape.operators.deliverable import STAGES
from streetscape.operators.maintained import read_index, read_stats, refresh
from streetscape.operators.score_udtf import register_scorer, score_by_sql
from streetscape.operators.spatial import append_clustered, scan_box
from streetscape.plans import oracle
from streetscape.plans import queries as Q
from streetscape.plans import views as V
from streetscape.plans.oracle import _DELIVERABLE, _INGESTED, _KEPT, _LANDED, model_ctes, with_base, wkb_hex
from streetscape.plans.queries import CAMDEN
from streetscape.session import shared_path
from streetscape.sinks.geoparquet import crs_of, geo_metadata, verify_geo, write_geo
from streetscape.sinks.files import land_files
from streetscape.sinks.stores import append_images, init_store
from streetscape.sources.drift import scan_drifted
from streetscape.sources.geoparquet import read_geo
from streetscape.sources.image_shards import land_shards, scan_image_shards, shard_entries
from streetscape.sources.images import read_images_of
from streetscape.sources.layout import cached_in, new_in
from streetscape.sources.pages import rank_pages, read_pages, written
from streetscape.sources.stores import scan_image_store, scan_score_store
from streetscape.streaming.incremental import land_pages, stream_score
from streetscape.streaming.ledger import scan_rejects
from streetscape.streaming.stateful import stream_ingest_stateful

BUCKETS = 16
#: A part of the area, by its own edges.
PART = Row(west=-0.1452, south=51.5408, east=-0.1440, north=51.5421)
PAGE_RECORDS = 100
TILE_POINTS, TILE_AREA, TILE_LEVELS = 20, 2e-6, 8
URL = "https://api.example/list?page="
#: The first of two runs takes captures up to this time.
FIRST_RUN_UNTIL = "2024-01-16T00:00:00"


def _bucketed_store(spark: SparkSession, d: str) -> str:
    """The store view as a bucketed store of two appends."""
    path = f"{shared_path(spark, 'bucketed')}/images"
    init_store(spark, path, "images", BUCKETS)
    store = V.store(spark, d)
    for shard in ("shard-1.parquet", "shard-2.parquet"):
        append_images(store.where(F.col("source_file") == shard), path)
    return path


def q_bucketed_ids(spark: SparkSession, d: str) -> DataFrame:
    """New and cached candidates over a bucketed store; the store isn't shuffled."""
    candidates = Q._candidates(spark, d)
    store = scan_image_store(spark, _bucketed_store(spark, d))
    new = new_in(candidates, store, BUCKETS).select("image_id", F.lit("new").alias("side"))
    return new.unionByName(cached_in(candidates, store, BUCKETS).select("image_id", F.lit("cached").alias("side")))


def q_bucketed_latest(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each id, aggregated and joined inside the buckets."""
    latest = ST.latest_rows(scan_image_store(spark, _bucketed_store(spark, d)))
    return latest.select("image_id", "downloaded_at", "image_sha256", "image_bytes")


def _maintained(spark: SparkSession, d: str) -> str:
    """An index kept over a store that grows twice and loses shards: a third append, of later copies, is deleted again."""
    import pyarrow.fs as pafs

    from streetscape.sinks.geoparquet import _fs, qualified

    root = shared_path(spark, "maintained")
    path, index = f"{root}/images", f"{root}/index"
    store = V.store(spark, d)
    append_images(store.where("source_file = 'shard-1.parquet'"), path)
    refresh(spark, path, index)
    append_images(store.where("source_file = 'shard-2.parquet'"), path)
    refresh(spark, path, index)
    before = set(spark.read.parquet(path).inputFiles())
    append_images(store.where("camera_type = 'view'").withColumn("downloaded_at", F.expr("downloaded_at + interval 9 days")), path)
    refresh(spark, path, index)
    for url in set(spark.read.parquet(path).inputFiles()) - before:
        fs, file = _fs(qualified(spark, url))
        fs.delete_file(file)
    refresh(spark, path, index)
    return index


def q_maintained_index(spark: SparkSession, d: str) -> DataFrame:
    """The latest rows, kept from a log of shards through appends and deletions."""
    return read_index(spark, _maintained(spark, d)).select("image_id", "downloaded_at", "image_sha256", "image_bytes")


def q_maintained_stats(spark: SparkSession, d: str) -> DataFrame:
    """A1: the store's figures from the same log."""
    return read_stats(spark, _maintained(spark, d)).drop("n_shards")


def q_box_scan(spark: SparkSession, d: str) -> DataFrame:
    """Captures as shards clustered in space, in two appends; a box read by way of the manifest."""
    path = f"{shared_path(spark, 'clustered')}/rows"
    captures = V.captures(spark, d).select("image_id", "lon", "lat", "camera_type")
    append_clustered(captures.where("camera_type <> 'error'"), path, shards=32)
    append_clustered(captures.where("camera_type = 'error'"), path, shards=8)
    return scan_box(spark, path, PART, captures.schema)


def q_content_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Quadtrees of two boxes whose tiles keep an area and a number of captures."""
    aois = spark.createDataFrame([("camden", *(CAMDEN[s] for s in ("west", "south", "east", "north"))), ("part", *PART)], "aoi string, west double, south double, east double, north double")
    tiles = tiles_by_content(V.captures(spark, d), aois, TILE_POINTS, TILE_AREA, TILE_LEVELS)
    return tiles.select("aoi", F.col("level").cast("long").alias("level"), "col", "row", "n_points", "over", *[Q._r(F.col(c)).alias(c) for c in ("west", "south", "east", "north")])


DRIFT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("image_id", T.StringType()), ("lon", T.DoubleType()), ("camera_type", T.StringType()), ("sequence_id", T.StringType()), ("width", T.LongType()), ("creator_id", T.LongType()))])


def q_drifted_shards(spark: SparkSession, d: str) -> DataFrame:
    """U4: captures in shards of four kinds: as they should be, without a column and in another order, with shorter integers and a
    column more, with text where a number is due."""
    captures = V.captures(spark, d)
    path = f"{shared_path(spark, 'drifted')}/rows"
    kind = F.col("image_id").cast("long") % 4
    long = F.col("creator_id")
    whole = ["image_id", "lon", "camera_type", "sequence_id", F.col("width").cast("long").alias("width"), "creator_id"]
    for k, columns in enumerate((
        whole,
        ["creator_id", F.col("width").cast("long").alias("width"), "camera_type", "lon", "image_id"],
        ["image_id", "lon", "camera_type", "sequence_id", F.col("width").cast("short").alias("width"), long.cast("int").alias("creator_id"), F.col("height").alias("height")],
        ["image_id", "lon", "camera_type", "sequence_id", F.col("width").cast("long").alias("width"), F.when(F.col("camera_type") == "error", F.concat(F.lit("u"), long.cast("string"))).otherwise(long.cast("string")).alias("creator_id")],
    )):
        captures.where(kind == k).select(*columns).write.mode("append").parquet(path)
    return scan_drifted(spark, path, DRIFT_SCHEMA).select(*DRIFT_SCHEMA.fieldNames(), F.to_json("drift").alias("drift"))


def q_geo_box_scan(spark: SparkSession, d: str) -> DataFrame:
    """The deliverable with native geometry and as plain WKB, both read back inside a box."""
    rows = Q.deliverable(spark, d)
    root = shared_path(spark, "geo-box")
    out = []
    for name, version in (("native", "V2"), ("wkb", "V1")):
        write_geo(rows, f"{root}/{name}", version=version)
        found = read_geo(spark, f"{root}/{name}", PART, ["image_id", "captured_at", "geom", "top_regions"])
        out.append(found.select(F.lit(name).alias("encoding"), "image_id", "captured_at", F.hex("geom").alias("geom_hex"), Q._r("geom_x").alias("x"), Q._r("geom_y").alias("y"), Q.region_text().alias("regions")))
    return out[0].unionByName(out[1])


def q_preview_whole(spark: SparkSession, d: str) -> DataFrame:
    """All ten columns of the preview of a written file, the CRS as the file tells it."""
    path = shared_path(spark, "previewed")
    write_geo(Q.deliverable(spark, d), path)
    crs = [r.crs for r in crs_of(geo_metadata(spark, path)).select("crs").distinct().collect()]  # one CRS a table
    shown = D.preview(read_geo(spark, path), 10, ",".join(sorted(crs)))
    return shown.withColumns({"regions": Q.region_text(), "blob_bytes": F.col("blob_bytes").cast("long"), "n_activity": F.col("n_activity").cast("long"), "compass_angle": Q._r("compass_angle")}).drop("top_regions")


def q_geo_refused(spark: SparkSession, d: str) -> DataFrame:
    """V2, V3: what the verification says of the deliverable in each version, and how many rows it read."""
    rows = Q.deliverable(spark, d)
    root = shared_path(spark, "versions")
    out = []
    for version in ("V2", "V1", "NONE", "BOTH"):
        path = f"{root}/{version}"
        write_geo(rows, path, version=version)
        try:
            verify_geo(spark, path)
            said = "ok"
        except AssertionError as e:
            said = "no_geo_key" if "no geo metadata" in str(e) else "wrong_version"
        back = spark.read.schema("geom binary").parquet(path).agg(F.count("geom").alias("n_rows"))
        out.append(back.select(F.lit(version).alias("version"), F.lit(said).alias("verdict"), "n_rows"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def q_page_order(spark: SparkSession, d: str) -> DataFrame:
    """Pages under shuffled names, ranked along their links. Of ten pages 0-1-2 follow one another, 3 and 4 name each
    other, 5-6-7 break off, 8-9 follow one another and 9 has landed twice."""
    ev = V.table(spark, d, "events")
    url = lambda n: F.concat(F.lit(URL), F.lpad(n.cast("string"), 9, "0"))
    pages = ev.groupBy(F.floor(F.col("event_id") / PAGE_RECORDS).alias("k")).agg(F.sort_array(F.collect_list("event_id")).alias("ids"))  # a page holds PAGE_RECORDS
    k = F.col("k")
    last = k % 10
    after = F.when(last.isin(0, 1, 3, 5, 6, 8), url(k + 1)).when(last == 4, url(k - 1)).when(last == 7, F.lit(URL + "gone"))
    body = F.concat(
        F.lit('{"request":"'), url(k), F.lit('","data":['), F.array_join(F.transform("ids", lambda i: F.concat(F.lit('{"id":'), i.cast("string"), F.lit("}"))), ","),
        F.lit('],"paging":{'), F.coalesce(F.concat(F.lit('"next":"'), after, F.lit('"')), F.lit("")), F.lit("}}"),
    )
    landed = pages.select(F.explode(F.when(last == 9, F.array(F.lit("a"), F.lit("z"))).otherwise(F.array(F.lit("a")))).alias("copy"), k.alias("k"), body.alias("value"))
    landed = landed.select(F.concat("copy", F.md5(F.concat("copy", k.cast("string")))).alias("name"), F.encode("value", "UTF-8").alias("value"))
    path = f"{shared_path(spark, 'linked')}/pages"
    land_files(landed, path, "name", "value", ext=".json")
    read = written(read_pages(spark, path).select("file", "request", "next", F.size("data").cast("long").alias("n_records")), "pages-read")
    ranked = rank_pages(read)
    size = read.select("file", "n_records")
    return ranked.join(size, "file").select("request", "chain", "rank", "status", "n_records")


def _failing(spark: SparkSession, d: str) -> DataFrame:
    """The blobs, those of every eleventh document marked so that the model fails on them."""
    blobs = V.blobs(spark, d)
    mark = F.when(F.col("image_id").cast("bigint") % 11 == 0, F.encode(F.lit("FAIL"), "UTF-8")).otherwise(F.unhex(F.lit("")))
    return blobs.select("image_id", F.concat(mark, "image_blob").alias("image_blob"))


def _ingested(spark: SparkSession, d: str, twice: bool) -> str:
    root = shared_path(spark, "state")
    init_store(spark, f"{root}/images", "images")
    for _ in range(1 + twice):  # the second time all pages land again, as other files
        land_pages(Q.capture_records(spark, d), f"{root}/pages")
        stream_ingest_stateful(spark, f"{root}/pages", _failing(spark, d), f"{root}/images", f"{root}/check-pages", CAMDEN).awaitTermination()
    return root


def q_stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Ingest with the query's own state: all pages land twice, between two runs; each id is stored once."""
    store = scan_image_store(spark, f"{_ingested(spark, d, True)}/images", with_file=False)
    return store.select("image_id", "image_bytes", "lon", "lat")


def q_stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The outcome of every ingested item: its number of values, or why it has none."""
    root = _ingested(spark, d, False)
    stream_score(
        spark, f"{root}/images", f"{root}/scores", f"{root}/check-scores", V.atlas(spark), AT.alias_map_df(spark), AT.alias_names(),
        predictor_factory=lambda: M.ByteProbePredictor(fail_marker=b"FAIL"), max_files_per_trigger=4,
    ).awaitTermination()
    scored = scan_score_store(spark, f"{root}/scores", with_file=False).select("image_id", F.lit("scored").alias("outcome"), F.size("brain_activity").cast("long").alias("n_activity"))
    lost = scan_rejects(spark, f"{root}/scores-rejects").where("stage = 'inference'").select("image_id", F.split("reason", ":")[0].alias("outcome"), F.lit(None).cast("long").alias("n_activity"))
    return scored.unionByName(lost)


def q_run_record(spark: SparkSession, d: str) -> DataFrame:
    """The record of a second run over bucketed stores, which finds what the first, earlier one has stored and scored."""
    from streetscape.plans.pipeline import run

    cfg = Q.landed_run(spark, d)
    cfg.store_buckets = BUCKETS
    cfg.end_captured_at = FIRST_RUN_UNTIL
    run(spark, cfg)
    cfg.end_captured_at = None
    cfg.out_path += "-2"
    told = run(spark, cfg)
    counts = told["counts"]
    rows = [(name, int(counts.get(name, 0))) for name in STAGES] + [("verified_rows", int(told["verify"]["n_rows"])), ("verified_columns", int(told["verify"]["n_columns"]))]
    return spark.createDataFrame(rows, "name string, value long")


def q_score_udtf(spark: SparkSession, d: str) -> DataFrame:
    """M1 from SQL: the table function over every latest store row."""
    items = ST.latest_rows(V.store(spark, d)).select("image_id", "image_blob")
    register_scorer(spark, lambda: M.ByteProbePredictor(fail_marker=None), batch_bytes=1 << 20)
    seg = M.good_segments(score_by_sql(items, 8))
    return seg.select("image_id", "segment_idx", F.size("activity").cast("long").alias("n_values"), Q.vector_sum("activity").alias("activity_sum"))


def q_image_shards(spark: SparkSession, d: str) -> DataFrame:
    """Images landed in packed shards: all of them, the index of some, and the contents of every third id alone."""
    root = f"{shared_path(spark, 'shards')}/images"
    land_shards(Q.marked_blobs(spark, d), root, folders=8)
    told = lambda df, side: df.select(F.lit(side).alias("side"), "image_id", F.md5(F.hex("image_blob").cast("binary")).alias("content"), F.octet_length("image_blob").cast("bigint").alias("bytes"), "reject_reason")
    third = V.blobs(spark, d).where(F.col("image_id").cast("bigint") % 3 == 0).select("image_id")
    some = shard_entries(spark, root).where(F.col("image_id").isin("1", "4", "7"))
    none = F.lit(None).cast("string")
    entries = some.select(F.lit("index").alias("side"), "image_id", none.alias("content"), F.col("length").alias("bytes"), none.alias("reject_reason"))
    return told(scan_image_shards(spark, root), "all").union(told(read_images_of(spark, root, third), "third")).union(entries)


def q_pipeline_on_shards(spark: SparkSession, d: str) -> DataFrame:
    """The deliverable of the whole run over images in packed shards."""
    return Q._delivered(spark, Q._pipeline(spark, d, land_shards)[0])


QUERIES = {
    "image_shards": q_image_shards,
    "pipeline_on_shards": q_pipeline_on_shards,
    "score_udtf": q_score_udtf,
    "bucketed_ids": q_bucketed_ids,
    "bucketed_latest": q_bucketed_latest,
    "maintained_index": q_maintained_index,
    "maintained_stats": q_maintained_stats,
    "box_scan": q_box_scan,
    "content_tiles": q_content_tiles,
    "drifted_shards": q_drifted_shards,
    "geo_box_scan": q_geo_box_scan,
    "preview_whole": q_preview_whole,
    "geo_refused": q_geo_refused,
    "page_order": q_page_order,
    "stream_dedup": q_stream_dedup,
    "stream_rejects": q_stream_rejects,
    "run_record": q_run_record,
}

_PART = f"lon BETWEEN {PART.west}e0 AND {PART.east}e0 AND lat BETWEEN {PART.south}e0 AND {PART.north}e0"
_MARK = "CASE WHEN CAST({0} AS BIGINT) % 11 = 0 THEN 4 ELSE 0 END"

SQL = {
    "image_shards": with_base(f"""{_LANDED}
        , told AS (SELECT image_id, md5(h) AS content, CAST(length(h) // 2 AS BIGINT) AS bytes, CASE WHEN substr(h, 1, 6) <> 'FFD8FF' THEN 'not_image' END AS reject_reason
                   FROM landed WHERE h IS NOT NULL)
        SELECT 'all' AS side, image_id, content, bytes, reject_reason FROM told
        UNION ALL SELECT 'third', image_id, content, bytes, reject_reason FROM told WHERE CAST(image_id AS BIGINT) % 3 = 0
        UNION ALL SELECT 'index', image_id, NULL, bytes, NULL FROM told WHERE image_id IN ('1', '4', '7')"""),
    "pipeline_on_shards": oracle.SQL["pipeline_run"],
    "score_udtf": oracle.SQL["score_images"],
    "bucketed_ids": with_base("""
        SELECT image_id, 'new' AS side FROM camden WHERE image_id NOT IN (SELECT image_id FROM store)
        UNION ALL SELECT image_id, 'cached' FROM camden WHERE image_id IN (SELECT image_id FROM store)"""),
    "bucketed_latest": with_base("SELECT image_id, downloaded_at, image_sha256, image_bytes FROM latest"),
    "maintained_index": with_base("SELECT image_id, downloaded_at, image_sha256, image_bytes FROM latest"),
    "maintained_stats": with_base("""
        SELECT count(*) AS n_rows, CAST(sum(image_bytes) AS BIGINT) AS total_bytes, min(captured_at) AS oldest_captured_at, max(captured_at) AS newest_captured_at FROM store"""),
    "box_scan": with_base(f"SELECT image_id, lon, lat, camera_type FROM captures WHERE {_PART}"),
    "content_tiles": with_base(f"""
        , boxes AS (
            SELECT *, CAST(greatest(0, ceil(log2((e - w) * (n - s) / {TILE_AREA:.1e}) / 2)) AS BIGINT) AS base
            FROM (VALUES ('camden', -0.1465e0, 51.5405e0, -0.1422e0, 51.543e0), ('part', {PART.west}e0, {PART.south}e0, {PART.east}e0, {PART.north}e0)) t(aoi, w, s, e, n))
        , cells AS (
            SELECT aoi, base, CAST(least(floor((lon - w) / (e - w) * {1 << TILE_LEVELS}.0e0), {(1 << TILE_LEVELS) - 1}) AS BIGINT) AS col,
                   CAST(least(floor((lat - s) / (n - s) * {1 << TILE_LEVELS}.0e0), {(1 << TILE_LEVELS) - 1}) AS BIGINT) AS row
            FROM captures JOIN boxes ON lon BETWEEN w AND e AND lat BETWEEN s AND n)
        , counts AS (
            SELECT aoi, l.range AS level, col // CAST(pow(2, {TILE_LEVELS} - l.range) AS BIGINT) AS col, row // CAST(pow(2, {TILE_LEVELS} - l.range) AS BIGINT) AS row, count(*) AS n_points
            FROM cells JOIN range({TILE_LEVELS + 1}) l ON l.range >= base GROUP BY ALL)
        , split AS (SELECT aoi, level, col, row FROM counts WHERE n_points > {TILE_POINTS} AND level < {TILE_LEVELS})
        , tiles AS (
            SELECT aoi, base AS level, c.range AS col, r.range AS row FROM boxes, range(1000) c, range(1000) r WHERE c.range < pow(2, base) AND r.range < pow(2, base)
            UNION ALL SELECT aoi, level + 1, col * 2 + c.range, row * 2 + r.range FROM split, range(2) c, range(2) r)
        SELECT t.aoi, t.level, t.col, t.row, coalesce(n_points, 0) AS n_points, coalesce(n_points, 0) > {TILE_POINTS} AS over,
               round(w + t.col * ((e - w) / pow(2, t.level)), 9) AS west, round(s + t.row * ((n - s) / pow(2, t.level)), 9) AS south,
               round(w + (t.col + 1) * ((e - w) / pow(2, t.level)), 9) AS east, round(s + (t.row + 1) * ((n - s) / pow(2, t.level)), 9) AS north
        FROM tiles t JOIN boxes b ON b.aoi = t.aoi LEFT JOIN counts k ON k.aoi = t.aoi AND k.level = t.level AND k.col = t.col AND k.row = t.row
        WHERE NOT EXISTS (SELECT 1 FROM split x WHERE x.aoi = t.aoi AND x.level = t.level AND x.col = t.col AND x.row = t.row)"""),
    "drifted_shards": with_base("""
        SELECT image_id, lon, camera_type, CASE WHEN CAST(image_id AS BIGINT) % 4 <> 1 THEN sequence_id END AS sequence_id, CAST(width AS BIGINT) AS width,
               CASE WHEN CAST(image_id AS BIGINT) % 4 <> 3 OR camera_type <> 'error' THEN creator_id END AS creator_id,
               CASE CAST(image_id AS BIGINT) % 4 WHEN 2 THEN '{"height":' || height || '}'
                    WHEN 3 THEN CASE WHEN camera_type = 'error' THEN '{"creator_id":"u' || creator_id || '"}' END END AS drift
        FROM captures"""),
    "geo_box_scan": with_base(f"""
        , part AS (
            SELECT l.image_id, l.captured_at, {wkb_hex('l.lon', 'l.lat')} AS geom_hex, round(l.lon, 9) AS x, round(l.lat, 9) AS y, s.regions
            FROM latest l JOIN scored s ON s.image_id = l.image_id
            WHERE {_PART.replace('lon ', 'l.lon ').replace('lat ', 'l.lat ')})
        SELECT 'native' AS encoding, * FROM part UNION ALL SELECT 'wkb', * FROM part"""),
    "preview_whole": with_base(
        _DELIVERABLE
        + """SELECT image_id, captured_at, geom_wkt, 'OGC:CRS84' AS crs, round(compass_angle, 9) AS compass_angle, camera_type, image_mime, blob_bytes, n_activity, regions
             FROM dl ORDER BY captured_at, image_id LIMIT 10"""
    ),
    "geo_refused": with_base(_DELIVERABLE + "SELECT t.version, t.verdict, (SELECT count(*) FROM dl) AS n_rows FROM (VALUES ('V2', 'ok'), ('V1', 'wrong_version'), ('NONE', 'no_geo_key'), ('BOTH', 'wrong_version')) t(version, verdict)"),
    "page_order": f"""
        WITH RECURSIVE pages AS (SELECT event_id // {PAGE_RECORDS} AS k, count(*) AS n_records FROM events GROUP BY ALL),
        linked AS (
            SELECT k, n_records, CASE WHEN k % 10 IN (0, 1, 3, 5, 6, 8) THEN k + 1 WHEN k % 10 = 4 THEN k - 1 WHEN k % 10 = 7 THEN -1 END AS after FROM pages),
        walk AS (
            SELECT k, k AS first, CAST(0 AS BIGINT) AS rank, after, n_records FROM linked WHERE k NOT IN (SELECT after FROM linked WHERE after IS NOT NULL)
            UNION ALL
            SELECT l.k, w.first, w.rank + 1, l.after, l.n_records FROM walk w JOIN linked l ON l.k = w.after),
        told AS (
            SELECT k, first, rank, CASE WHEN after IS NOT NULL AND after NOT IN (SELECT k FROM pages) THEN 'missing_next' END AS status, n_records FROM walk
            UNION ALL SELECT k, NULL, NULL, 'cyclic', n_records FROM linked WHERE k NOT IN (SELECT k FROM walk)
            UNION ALL SELECT k, NULL, NULL, 'repeated_page', n_records FROM linked WHERE k % 10 = 9)
        SELECT '{URL}' || lpad(CAST(k AS VARCHAR), 9, '0') AS request, '{URL}' || lpad(CAST(first AS VARCHAR), 9, '0') AS chain, rank, status, n_records FROM told""",
    "stream_dedup": with_base(_INGESTED + f"SELECT image_id, CAST(image_bytes + {_MARK.format('image_id')} AS BIGINT) AS image_bytes, lon, lat FROM ingested"),
    "stream_rejects": with_base(
        _INGESTED
        + """, items AS (SELECT i.image_id, hex(encode(b.text)) AS h FROM ingested i JOIN blobs b ON b.image_id = i.image_id WHERE CAST(i.image_id AS BIGINT) % 11 <> 0)"""
        + model_ctes("items")
        + """SELECT image_id, 'scored' AS outcome, n_activity FROM m_scored
             UNION ALL SELECT image_id, 'inference_failed', NULL FROM ingested WHERE CAST(image_id AS BIGINT) % 11 = 0"""
    ),
    "run_record": with_base(f"""
        {_LANDED}{_KEPT}
        , early AS (SELECT image_id FROM cands WHERE captured_at <= TIMESTAMP '{FIRST_RUN_UNTIL.replace('T', ' ')}')
        , n AS (
            SELECT (SELECT count(*) FROM cands) AS candidates,
                   count(*) FILTER (reason IS DISTINCT FROM 'not_image' AND image_id IN (SELECT image_id FROM early)) AS cached,
                   count(*) FILTER (reason IS DISTINCT FROM 'not_image' AND image_id NOT IN (SELECT image_id FROM early)) AS downloaded,
                   count(*) FILTER (reason IS NULL AND image_id IN (SELECT image_id FROM early)) AS inference_cache_hit,
                   count(*) FILTER (reason IS NULL AND image_id NOT IN (SELECT image_id FROM early)) AS inferred,
                   count(*) FILTER (reason IS NULL) AS written, count(*) FILTER (reason IS NULL) AS verified_rows, CAST(9 AS BIGINT) AS verified_columns
            FROM found)
        SELECT name, value FROM n UNPIVOT (value FOR name IN (candidates, cached, downloaded, inference_cache_hit, inferred, written, verified_rows, verified_columns))"""),
}
