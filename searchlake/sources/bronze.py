"""Bronze: raw fetched pages keyed by URL id."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchlake.functions.urls import url_id
from searchlake.sources import snapshots

FETCHED_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("statusCode", T.IntegerType()),
    T.StructField("contentType", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
])

BRONZE_COLUMNS = ("id", "url", "statusCode", "contentType", "fetchedAt", "headers", "html")

BRONZE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("statusCode", T.IntegerType()),
    T.StructField("contentType", T.StringType()),
    T.StructField("fetchedAt", T.TimestampType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("html", T.StringType()),
])

META_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("statusCode", T.IntegerType()),
    T.StructField("contentType", T.StringType()),
    T.StructField("fetchedAt", T.TimestampType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("htmlPath", T.StringType()),
])


def bronze_records(fetched: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Bronze rows for fetched pages: ``id`` = url id, ``fetchedAt`` =
    the given column (default: now)."""
    ts = fetched_at if fetched_at is not None else F.current_timestamp()
    return fetched.select(
        url_id("url").alias("id"), "url", F.col("statusCode").cast("int").alias("statusCode"),
        "contentType", ts.cast("timestamp").alias("fetchedAt"), "headers", "html",
    )


def keep_latest(df: DataFrame, key: str = "id", ts: str = "fetchedAt") -> DataFrame:
    """One row per key, the latest by ``ts`` (file/hash overwrite).

    ``max_by(row, struct(ts, ...))`` is an ordinary aggregate with map-side partial
    aggregation, so a key that is re-fetched millions of times collapses to
    one row per map task before the shuffle.  Remaining ties break on the
    other columns, deterministically; a long text (the HTML) enters the order
    by its digest, so it is carried once.
    """
    others = [c for c in df.columns if c not in (key, ts, "html")]
    order = [F.col(ts), *[F.col(c) for c in others if not _has_map(df.schema[c].dataType)]]
    if "html" in df.columns:
        order.append(F.sha2("html", 256))
    best = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order)).alias("_b")
    return df.groupBy(key).agg(best).select(*[F.col("_b." + c).alias(c) for c in df.columns])


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _has_map(dt.elementType)
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return False


#: Buckets of a new Bronze table.
BUCKETS = 256


def bucket_of(id_col: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def _current(spark: SparkSession, base: str) -> tuple[int, dict[int, str]] | None:
    """``(buckets, {bucket: version})`` of the table, None if there is none."""
    published = snapshots.current_version(spark, base)
    if published is None:
        return None
    m = json.loads(published)
    return m["buckets"], {int(b): v for b, v in m["versions"].items()}


def _read_buckets(spark: SparkSession, base: str, versions: dict[int, str]) -> DataFrame:
    paths = [f"{base.rstrip('/')}/{v}/bucket={b}" for b, v in sorted(versions.items())]
    if not paths:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    return spark.read.schema(BRONZE_SCHEMA).parquet(*paths)


def upsert_bronze(spark: SparkSession, new_rows: DataFrame, base: str, buckets: int = BUCKETS) -> str:
    """S1 as a table in hash buckets of the id: the latest row of each id.

    Only buckets that get a row are read and written again, as new folders of
    a new version; the published list says which version holds each bucket,
    so nothing that is read is overwritten.  ``buckets`` counts for a new
    table; an old one keeps its number.  Returns the version."""
    old = _current(spark, base)
    buckets, versions = old or (buckets, {})
    rows = new_rows.select(*[F.col(c).cast(BRONZE_SCHEMA[c].dataType) for c in BRONZE_COLUMNS])
    # One row a bucket at most; only the id is computed for it.
    touched = {r["b"] for r in rows.select(bucket_of("id", buckets).alias("b")).distinct().collect()}
    version = snapshots.new_version()
    there = {b: v for b, v in versions.items() if b in touched}
    if there:
        rows = _read_buckets(spark, base, there).unionByName(rows)
    latest = keep_latest(rows).withColumn("bucket", bucket_of("id", buckets))
    latest.hint("rebalance", "bucket").write.mode("errorifexists").partitionBy("bucket").parquet(f"{base.rstrip('/')}/{version}")
    versions = versions | dict.fromkeys(touched, version)
    snapshots.publish(spark, base, json.dumps({"buckets": buckets, "versions": versions}))
    return version


def read_bronze(spark: SparkSession, base: str) -> DataFrame:
    """All rows of the table as it was published last."""
    cur = _current(spark, base)
    if cur is None:
        raise FileNotFoundError(f"no bronze snapshot under {base}")
    return _read_buckets(spark, base, cur[1])


def read_bronze_ids(spark: SparkSession, base: str, ids: list[str]) -> DataFrame:
    """The rows of a few ids; only their buckets are read."""
    cur = _current(spark, base)
    if cur is None:
        raise FileNotFoundError(f"no bronze snapshot under {base}")
    wanted = spark.createDataFrame([(i,) for i in ids], "id string").select(bucket_of("id", cur[0]).alias("b")).distinct()
    found = {r["b"] for r in wanted.collect()}
    return _read_buckets(spark, base, {b: v for b, v in cur[1].items() if b in found}).where(F.col("id").isin(ids))


def read_bronze_files(spark: SparkSession, bronze_dir: str) -> DataFrame:
    """Read a folder of ``{id}.meta.json`` + ``{id}.html`` files.

    Metadata (pretty-printed JSON, explicit schema) joins the HTML bodies on
    the id taken from each file name: that of ``htmlPath`` if there is such a
    file, else the record's own ``{id}.html``; with neither the record is
    skipped.  ``wholetext`` is passed as a keyword -- as an option it would be
    overridden and split the files into lines.
    """
    meta = (
        spark.read.schema(META_SCHEMA).option("multiLine", True)
        .json(bronze_dir, pathGlobFilter="*.meta.json")
    )
    html = spark.read.text(bronze_dir, wholetext=True, pathGlobFilter="*.html").select(
        file_id(F.col("_metadata.file_path")).alias("file_id"), F.col("value").alias("html")
    )
    return join_bodies(meta, html)


def _local(spark: SparkSession, path: str) -> tuple[object, object, str | None]:
    """Spark's file system and path, and the plain path if that is a mounted
    folder, else None."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, p, p.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    fs, p, _ = _local(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def write_files(files: DataFrame, folder: str, parts: int) -> None:
    """S1 as files: each row of ``files(file, html)`` is a file, closed by a
    line break, in one of ``parts`` folders.

    In a mounted folder the tasks write the files themselves: Spark's writer
    makes a folder and a checksum for each and starts a ``chmod`` for both.
    Elsewhere it writes them, as ``{file}/part-...``."""
    fs, p, plain = _local(files.sparkSession, folder)
    rows = files.select(F.pmod(F.xxhash64("file"), F.lit(parts)).alias("part"), "file", "html")
    if plain is None:
        rows.write.partitionBy("part", "file").text(folder)
        return
    fs.mkdirs(p)
    rows = rows.withColumn("html", F.col("html").cast("binary"))
    rows.mapInArrow(_file_writer(plain), "files long").write.format("noop").mode("overwrite").save()


def _file_writer(folder: str):
    """Writes rows ``(part, file, html)``.  A file gets its name when it is
    whole, so a task that is run again replaces it and a lost one leaves none
    that is read."""

    def write(batches):
        import os
        import uuid

        import pyarrow as pa

        made, tag = set(), uuid.uuid4().hex
        for batch in batches:
            for part, file, html in zip(*batch.columns, strict=True):
                into = f"{folder}/part={part.as_py()}"
                if into not in made:
                    os.makedirs(into, exist_ok=True)
                    made.add(into)
                with open(f"{into}/.{tag}", "wb") as out:
                    out.write(html.as_buffer())
                    out.write(b"\n")
                os.replace(out.name, f"{into}/{file.as_py()}")
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    return write


def file_id(path: Column) -> Column:
    """The id in a body's path: the name before ``.html`` of the file, or of
    the folder that holds its parts."""
    return F.regexp_extract(path, r"([^/\\=]+)\.html(?:/[^/]*)?$", 1)


def named_file(html_path: str) -> Column:
    """The body file that a record names, '' if none."""
    return file_id(F.coalesce(html_path, F.lit("")))


def join_bodies(meta: DataFrame, html: DataFrame) -> DataFrame:
    """Records of ``meta`` (META_SCHEMA) with the body of ``html(file_id,
    html)`` that they name, else the one of their own id; else skipped."""
    # Which named files exist: file names only, the bodies are joined once.
    there = html.select(F.col("file_id").alias("_named"), F.lit(True).alias("_there"))
    m = meta.withColumn("_named", named_file("htmlPath")).join(there, "_named", "left")
    m = m.withColumn("file_id", F.when(F.col("_there"), F.col("_named")).otherwise(F.col("id")))
    return m.join(html, "file_id").select(*BRONZE_COLUMNS)


def best_bodies(joined: DataFrame) -> DataFrame:
    """One row a record out of a stream of ``BRONZE_COLUMNS`` and ``named``:
    the body that the record names, else that of its own id."""
    cols = [F.col(c) for c in BRONZE_COLUMNS if c not in ("id", "fetchedAt")]
    best = F.max_by(F.struct(*cols), F.col("named")).alias("_b")
    out = joined.groupBy("id", "fetchedAt").agg(best)
    return out.select(*[F.col(c) if c in ("id", "fetchedAt") else F.col(f"_b.{c}").alias(c) for c in BRONZE_COLUMNS])
