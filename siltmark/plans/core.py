"""Queries over paths, hashes, the index and changes, on the tables as stand-ins: a document is a file, a labelled one is indexed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.functions.ids import content_hash, point_id
from siltmark.functions.paths import extensions, indexable, unc_relative
from siltmark.operators import changes as ch
from siltmark.operators import reconcile as rc
from siltmark.schema import PAGE


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def file_path():
    return F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))


def files(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", file_path().alias("rel_path"), F.col("text").alias("content"), "lang", "n_chars")


def disk(spark, sf) -> DataFrame:
    return rc.disk_hashes(files(spark, sf))


def labelled(spark, sf) -> DataFrame:
    docs = files(spark, sf).select("doc_id", "rel_path", content_hash(F.col("content")).alias("hash"))
    return docs.join(table(spark, sf, "labels"), "doc_id")


def point_table(spark, sf) -> DataFrame:
    """Three points for each labelled document, with an old hash where its quality is 0, and for each toxic one three of a file that is gone."""
    known = labelled(spark, sf).select(F.col("rel_path").alias("source_path"), F.when(F.col("quality") == 0, "old").otherwise(F.col("hash")).alias("file_hash"))
    gone = table(spark, sf, "labels").filter("toxic = 1").select(F.format_string("gone/%d.md", "doc_id").alias("source_path"), F.format_string("x%d", "doc_id").alias("file_hash"))
    each = known.union(gone).select("source_path", "file_hash", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("chunk_index"))
    return each.select(point_id(F.col("source_path"), F.col("chunk_index")).alias("id"), "source_path", "chunk_index", "file_hash")


def indexed(spark, sf) -> DataFrame:
    return rc.indexed_paths(point_table(spark, sf))


def fs_events(spark, sf) -> DataFrame:
    types = F.create_map(*[F.lit(x) for x in ("signup", "created", "error", "deleted", "click", "modified", "view", "moved", "purchase", "opened")])
    place = lambda n: F.concat(F.when(F.col("user_id") < 5, "/elsewhere/u").otherwise("/tree/u"), F.col("user_id").cast("string"), F.when(F.col("value") > 20, "").otherwise(F.concat(F.lit("/f"), n.cast("string"), F.lit(".md"))))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), types[F.col("event_type")].alias("event_type"), place(F.floor("value")).alias("src_path"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("/tree/moved"), F.floor("value").cast("string"), F.lit("/x.md"))).alias("dest_path"), (F.col("value") > 20).alias("is_directory"),
    )


def fs_changes(spark, sf) -> DataFrame:
    return ch.event_changes(fs_events(spark, sf), "/tree")


def odd_paths(spark, sf) -> DataFrame:
    name = F.concat(F.when(F.col("lang") == "fr", ".").when(F.col("lang") == "de", "_").otherwise(""), F.col("doc_id").cast("string"))
    ends = F.array(*[F.lit(x) for x in (".md", ".MD", ".bin", "", ".tar.GZ", ".html", ".", "/.hidden/a.txt")])
    return table(spark, sf, "documents").select("doc_id", "n_chars", F.concat("source", F.lit("/"), name, F.get(ends, (F.col("n_chars") % 8).cast("int"))).alias("rel_path"))


def snapshots(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mirrored, listed and listed again."""
    docs = files(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    size, mtime = F.col("n_chars"), F.col("doc_id").cast("double")
    before = docs.filter("lang <> 'de'").select("rel_path", size.alias("size"), mtime.alias("mtime"))
    listed = docs.filter("coalesce(toxic, 0) = 0").select("rel_path", F.when(F.col("quality") == 0, size + 1).otherwise(size).alias("size"), mtime.alias("mtime"))
    again = docs.select("rel_path", F.when(F.col("quality") == 0, size + 1).otherwise(size).alias("size"), F.when(F.col("lang") == "es", mtime + 1).otherwise(mtime).alias("mtime"))
    return before, listed, again


def promote(spark, sf) -> DataFrame:
    every = disk(spark, sf)
    crowded = rc.with_canonical(every).join(rc.duplicates(every).select("file_hash").distinct(), "file_hash", "left_semi")
    gone = crowded.filter("rel_path = canon").select("rel_path")
    left = every.join(gone, "rel_path", "left_anti")
    deletes = gone.select(F.lit(0).cast("long").alias("seq"), F.col("rel_path").alias("path"), F.lit(False).alias("is_prefix"))
    return ch.promotions(deletes, left, every.withColumnRenamed("rel_path", "source_path")).select("path", "target")


def change_batch(spark, sf) -> DataFrame:
    """Toxic files were deleted, those of low quality changed."""
    return labelled(spark, sf).filter("toxic = 1 OR quality = 0").select(F.col("doc_id").alias("seq"), F.when(F.col("toxic") == 1, "delete").otherwise("upsert").alias("op"), F.col("rel_path").alias("path"), F.lit(False).alias("is_prefix"))


def applied(spark, sf) -> DataFrame:
    batch = change_batch(spark, sf)
    left = disk(spark, sf).join(batch.filter("op = 'delete'"), F.col("rel_path") == F.col("path"), "left_anti")
    return ch.apply_changes(batch, left, indexed(spark, sf))


def merged(spark, sf) -> DataFrame:
    points = point_table(spark, sf)
    touched = change_batch(spark, sf).select(F.col("path").alias("source_path"))
    new = touched.join(change_batch(spark, sf).filter("op = 'upsert'").select("path"), F.col("source_path") == F.col("path"), "left_semi")
    new = new.select(point_id(F.col("source_path"), F.lit(0)).alias("id"), "source_path", F.lit(0).alias("chunk_index"), F.lit("new").alias("file_hash"))
    return rc.merge(points, touched, new).groupBy("source_path").agg(F.count(F.lit(1)).alias("n"), F.max("file_hash").alias("file_hash"))


def manifest(spark, sf) -> DataFrame:
    """A snapshot as manifest entries in JSON, and read again."""
    text = F.to_json(F.create_map("rel_path", F.struct("size", "mtime")))
    entries = snapshots(spark, sf)[1].select(text.alias("j"))
    return entries.select(F.explode(F.from_json("j", "map<string,struct<size:bigint,mtime:double>>")).alias("rel_path", "m")).select("rel_path", "m.size", "m.mtime")


def prefix_rows(spark, sf) -> DataFrame:
    langs = table(spark, sf, "documents").filter("n_chars > 12000").select(F.concat(F.lit("/"), "source", F.lit("/")).alias("path"))
    return langs.distinct().union(langs.sparkSession.createDataFrame([("gone/1",), ("",), ("/",)], "path string"))


QUERIES = {
    "filter_indexable": lambda s, d: odd_paths(s, d).select("doc_id", indexable(F.col("rel_path")).alias("ok")),
    "scan_eligible": lambda s, d: odd_paths(s, d).filter(indexable(F.col("rel_path"), (".md", ".txt"))).select("rel_path", F.col("n_chars").alias("size")),
    "parse_extensions": lambda s, d: table(s, d, "documents").select("doc_id", F.explode(extensions(F.concat("lang", F.lit(", "), "source", F.lit(";."), F.upper("lang"), F.lit(" ,;.MD")))).alias("ext")),
    "unc_relative": lambda s, d: table(s, d, "pages").select("page_id", unc_relative(F.concat(F.lit("\\\\Srv\\DOCS"), F.substring_index("url", "/", -1), F.lit("\\a/b/")), "//srv/docs/").alias("rel")),
    "content_hash": lambda s, d: disk(s, d),
    "canonical_paths": lambda s, d: rc.canonical(disk(s, d)),
    "duplicate_files": lambda s, d: rc.duplicates(disk(s, d)),
    "indexed_paths": indexed,
    "indexed_hash_lookup": lambda s, d: rc.indexed_hash(point_table(s, d), "src0/0.md"),
    "scroll_page": lambda s, d: point_table(s, d).select("id", "source_path", "file_hash").orderBy("id").limit(PAGE),
    "stale_paths": lambda s, d: rc.stale(disk(s, d), indexed(s, d)),
    "reconcile_plan": lambda s, d: rc.reconcile(disk(s, d), indexed(s, d)),
    "reconcile_counts": lambda s, d: rc.reconcile_counts(rc.reconcile(disk(s, d), indexed(s, d))),
    "delete_exact": lambda s, d: rc.delete_sources(point_table(s, d), labelled(s, d).filter("toxic = 1").select(F.col("rel_path").alias("source_path"))).select("id", "source_path"),
    "delete_prefix": lambda s, d: rc.delete_prefix(point_table(s, d), "/src1/").select("id", "source_path"),
    "delete_prefixes": lambda s, d: rc.delete_prefixes(point_table(s, d), prefix_rows(s, d)).select("id", "source_path"),
    "promote_duplicates": promote,
    "upsert_plan": merged,
    "apply_changes_plan": applied,
    "point_ids": lambda s, d: point_table(s, d).select("source_path", "chunk_index", "id"),
    "event_filter": lambda s, d: ch.relevant(fs_events(s, d)).select("seq", "event_type", "is_directory"),
    "event_to_changes": fs_changes,
    "coalesce_changes": lambda s, d: ch.coalesce_changes(fs_changes(s, d)),
    "debounce_batches": lambda s, d: ch.quiet_batches(fs_events(s, d), 300.0).select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n"),
    "snapshot_delta": lambda s, d: ch.snapshot_delta(*snapshots(s, d)[:2], stable=ch.stable_files(*snapshots(s, d)[1:])),
    "stable_publish": lambda s, d: ch.stable_files(*snapshots(s, d)[1:]),
    "next_mirror": lambda s, d: ch.next_mirror(*snapshots(s, d)[:2], ch.stable_files(*snapshots(s, d)[1:])),
    "manifest_roundtrip": manifest,
    "backoff_schedule": lambda s, d: table(s, d, "events").select("event_id", ch.backoff((F.col("user_id") % 12).cast("int"), 15.0, 60.0).alias("delay")),
}

_HEX = "sha256(encode('table-aware-v2') || '\\x00'::BLOB || encode(text))"
_FILES = f"""files AS (SELECT doc_id, source || '/' || doc_id || '.md' AS rel_path, lang, n_chars, {_HEX} AS file_hash FROM documents),
disk AS (SELECT rel_path, file_hash FROM files)"""
_ID = """(WITH h AS (SELECT sha1('\\x6b\\xa7\\xb8\\x10\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || encode({p} || '::' || {i})) AS h)
 SELECT substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' || printf('%02x', (('0x' || substr(h,17,2))::INT & 63) | 128) || substr(h,19,2) || '-' || substr(h,21,12) FROM h)"""


def point_id_sql(path: str, index: str) -> str:
    return _ID.format(p=path, i=index)


_POINTS = f"""{_FILES},
sources AS (
  SELECT rel_path AS source_path, CASE WHEN quality = 0 THEN 'old' ELSE file_hash END AS file_hash FROM files JOIN labels USING (doc_id)
  UNION ALL SELECT 'gone/' || doc_id || '.md', 'x' || doc_id FROM labels WHERE toxic = 1),
points AS (SELECT {point_id_sql('source_path', 'chunk_index')} AS id, source_path, chunk_index::INT AS chunk_index, file_hash FROM sources, range(3) r(chunk_index))"""
_PLAN = f"""{_POINTS},
plan AS (
  SELECT rel_path, d.file_hash, s.file_hash AS indexed_hash, canon,
    CASE WHEN d.file_hash IS NULL THEN 'stale_removed' WHEN rel_path <> canon AND s.file_hash IS NOT NULL THEN 'dup_removed'
         WHEN rel_path <> canon THEN 'dup_ignored' WHEN s.file_hash = d.file_hash THEN 'skipped' ELSE 'upserted' END AS action
  FROM (SELECT *, min(rel_path) OVER (PARTITION BY file_hash) AS canon FROM disk) d
  FULL OUTER JOIN (SELECT source_path AS rel_path, file_hash FROM sources) s USING (rel_path))"""
_ODD = """odd AS (SELECT doc_id, n_chars, source || '/' || CASE lang WHEN 'fr' THEN '.' WHEN 'de' THEN '_' ELSE '' END || doc_id
  || ['.md', '.MD', '.bin', '', '.tar.GZ', '.html', '.', '/.hidden/a.txt'][1 + n_chars % 8] AS rel_path FROM documents),
odder AS (SELECT *, lower(regexp_extract(rel_path, '[^/](\\.[^./]+)$', 1)) AS suffix, split_part(rel_path, '/', -1) LIKE '.%' AS hidden FROM odd)"""
_EVENTS = """ev AS (SELECT event_id AS seq, ts, value > 20 AS is_directory,
  CASE event_type WHEN 'signup' THEN 'created' WHEN 'error' THEN 'deleted' WHEN 'click' THEN 'modified' WHEN 'view' THEN 'moved' ELSE 'opened' END AS event_type,
  user_id >= 5 AS inside, 'u' || user_id || CASE WHEN value > 20 THEN '' ELSE '/f' || floor(value)::BIGINT || '.md' END AS src,
  CASE WHEN event_type = 'view' THEN 'moved' || floor(value)::BIGINT || '/x.md' END AS dest FROM events),
chg AS (
  SELECT seq, 'delete' AS op, src AS path, is_directory AS is_prefix FROM ev WHERE inside AND event_type IN ('deleted', 'moved')
  UNION ALL SELECT seq, 'upsert', src, false FROM ev WHERE inside AND NOT is_directory AND event_type IN ('created', 'modified')
  UNION ALL SELECT seq, 'upsert', dest, false FROM ev WHERE NOT is_directory AND event_type = 'moved')"""
_SNAP = f"""{_FILES},
sn AS (SELECT files.*, coalesce(toxic, 0) AS toxic, quality, n_chars + CASE WHEN quality = 0 THEN 1 ELSE 0 END AS size, doc_id::DOUBLE AS mtime FROM files LEFT JOIN labels USING (doc_id)),
b AS (SELECT rel_path, n_chars AS size, mtime FROM sn WHERE lang <> 'de'),
l AS (SELECT rel_path, size, mtime, lang <> 'es' AS stable FROM sn WHERE toxic = 0)"""

ORACLES = {
    "filter_indexable": f"WITH {_ODD} SELECT doc_id, NOT hidden AND suffix IN ('.txt','.md','.markdown','.rst','.log','.pdf','.docx','.pptx','.xlsx','.xls','.html','.htm','.csv') AS ok FROM odder",
    "scan_eligible": f"WITH {_ODD} SELECT rel_path, n_chars AS size FROM odder WHERE NOT hidden AND suffix IN ('.md', '.txt')",
    "parse_extensions": "SELECT doc_id, unnest(list_distinct(['.' || lang, '.' || source, '.md'])) AS ext FROM documents",
    "unc_relative": "SELECT page_id, ltrim(split_part(url, '/', -1) || '/a/b', '/') AS rel FROM pages",
    "content_hash": f"WITH {_FILES} SELECT * FROM disk",
    "canonical_paths": f"WITH {_FILES} SELECT file_hash, min(rel_path) AS canon FROM disk GROUP BY file_hash",
    "duplicate_files": f"WITH {_FILES}, c AS (SELECT *, min(rel_path) OVER (PARTITION BY file_hash) AS canon FROM disk) SELECT rel_path, file_hash, canon FROM c WHERE rel_path <> canon",
    "indexed_paths": f"WITH {_POINTS} SELECT source_path, file_hash FROM sources",
    "indexed_hash_lookup": f"WITH {_POINTS} SELECT file_hash FROM sources WHERE source_path = 'src0/0.md'",
    "scroll_page": f"WITH {_POINTS} SELECT id, source_path, file_hash FROM points ORDER BY id LIMIT 100",
    "stale_paths": f"WITH {_POINTS} SELECT * FROM sources WHERE source_path NOT IN (SELECT rel_path FROM disk)",
    "reconcile_plan": f"WITH {_PLAN} SELECT * FROM plan",
    "reconcile_counts": f"WITH {_PLAN} SELECT action, count(*) AS n FROM plan GROUP BY action",
    "delete_exact": f"WITH {_POINTS} SELECT id, source_path FROM points WHERE source_path NOT IN (SELECT rel_path FROM files JOIN labels USING (doc_id) WHERE toxic = 1)",
    "delete_prefix": f"WITH {_POINTS} SELECT id, source_path FROM points WHERE NOT (source_path = 'src1' OR starts_with(source_path, 'src1/'))",
    "delete_prefixes": f"WITH {_POINTS}, p AS (SELECT DISTINCT source AS x FROM documents WHERE n_chars > 12000 UNION SELECT 'gone/1') SELECT id, source_path FROM points WHERE NOT EXISTS (SELECT 1 FROM p WHERE source_path = x OR starts_with(source_path, x || '/'))",
    "promote_duplicates": f"WITH {_FILES}, r AS (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY rel_path) AS k FROM disk) SELECT a.rel_path AS path, b.rel_path AS target FROM r a JOIN r b USING (file_hash) WHERE a.k = 1 AND b.k = 2",
    "upsert_plan": f"""WITH {_POINTS}, t AS (SELECT rel_path AS source_path, toxic FROM files JOIN labels USING (doc_id) WHERE toxic = 1 OR quality = 0),
        m AS (SELECT source_path, file_hash FROM points WHERE source_path NOT IN (SELECT source_path FROM t) UNION ALL SELECT source_path, 'new' FROM t WHERE toxic <> 1)
        SELECT source_path, count(*) AS n, max(file_hash) AS file_hash FROM m GROUP BY source_path""",
    "apply_changes_plan": f"""WITH {_POINTS}, t AS (SELECT rel_path, toxic = 1 AS del FROM files JOIN labels USING (doc_id) WHERE toxic = 1 OR quality = 0),
        dk AS (SELECT rel_path, file_hash, min(rel_path) OVER (PARTITION BY file_hash) AS canon FROM disk WHERE rel_path NOT IN (SELECT rel_path FROM t WHERE del)),
        pr AS (SELECT DISTINCT c.canon AS path FROM t JOIN sources s ON s.source_path = t.rel_path JOIN (SELECT DISTINCT file_hash, canon FROM dk) c USING (file_hash) WHERE t.del AND t.rel_path < c.canon),
        fin AS (
          SELECT rel_path AS source_path, file_hash AS new_hash, false AS hit FROM dk WHERE rel_path = canon AND (rel_path IN (SELECT rel_path FROM t WHERE NOT del) OR rel_path IN (SELECT path FROM pr))
          UNION ALL SELECT rel_path, NULL, true FROM t WHERE del
          UNION ALL SELECT t.rel_path, NULL, true FROM t JOIN dk USING (rel_path) WHERE NOT del AND dk.canon <> t.rel_path)
        SELECT source_path, coalesce(new_hash, s.file_hash) AS file_hash,
          CASE WHEN new_hash IS NOT NULL AND new_hash IS NOT DISTINCT FROM s.file_hash THEN 'kept' WHEN new_hash IS NOT NULL THEN 'upserted' WHEN hit THEN 'deleted' ELSE 'kept' END AS action
        FROM sources s FULL OUTER JOIN fin USING (source_path)""",
    "point_ids": f"WITH {_POINTS} SELECT source_path, chunk_index, id FROM points",
    "event_filter": f"WITH {_EVENTS} SELECT seq, event_type, is_directory FROM ev WHERE event_type <> 'opened' AND NOT (is_directory AND event_type IN ('created', 'modified'))",
    "event_to_changes": f"WITH {_EVENTS} SELECT * FROM chg",
    "coalesce_changes": f"WITH {_EVENTS} SELECT min(seq) AS seq, arg_max(op, (seq, op)) AS op, path, is_prefix FROM chg GROUP BY path, is_prefix",
    "debounce_batches": """WITH g AS (SELECT ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (ORDER BY ts)) >= 300 THEN 1 ELSE 0 END AS x FROM events),
        b AS (SELECT ts, sum(x) OVER (ORDER BY ts ROWS UNBOUNDED PRECEDING) AS b FROM g) SELECT min(ts) AS "start", max(ts) AS "end", count(*) AS n FROM b GROUP BY b""",
    "snapshot_delta": f"""WITH {_SNAP} SELECT rel_path, CASE WHEN l.size IS NULL THEN 'delete' ELSE 'upsert' END AS op FROM b FULL OUTER JOIN l USING (rel_path)
        WHERE l.size IS NULL OR (l.stable AND (b.size IS NULL OR b.size <> l.size OR b.mtime <> l.mtime))""",
    "stable_publish": f"WITH {_SNAP} SELECT rel_path, size, mtime FROM l WHERE stable",
    "next_mirror": f"WITH {_SNAP} SELECT rel_path, size, mtime FROM l WHERE stable UNION ALL SELECT b.* FROM b JOIN l USING (rel_path) WHERE NOT l.stable",
    "manifest_roundtrip": f"WITH {_SNAP} SELECT rel_path, size, mtime FROM l",
    "backoff_schedule": "SELECT event_id, least(60.0::DOUBLE, 15.0::DOUBLE * pow(2.0, greatest(user_id % 12 - 1, 0))) AS delay FROM events",
}
