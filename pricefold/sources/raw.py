"""Raw listing partitions: scans (S1-S4), keyed upsert (S6) and publish.

Legacy layout (one JSON array per file)::

    {root}/{source}/{category}/{yyyy}/{mm}/{dd}/products.json

A scan reads one row per whole file, with the partition columns parsed from
the file path.  Sources, category and dates choose folders before files are
listed (``tree``): with dates, the days' folders; without, Spark lists what is
below the sources' or categories' folders itself, in parallel.  Each file is
parsed as a whole document: one that is not a JSON array, or has anything
behind it, is skipped as a unit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..session import shuffles_freed
from .tree import Tree

RAW_RECORD = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("price", T.VariantType()),      # a number or text, as the file has it
    T.StructField("currency", T.StringType()),
    T.StructField("availability", T.StringType()),
    T.StructField("seller", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("scrape_timestamp", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("_source", T.StringType()),
    T.StructField("_category", T.StringType()),
    T.StructField("_run_date", T.StringType()),
])
RECORD_FIELDS = [f.name for f in RAW_RECORD.fields if not f.name.startswith("_")]
_PATH_RE = r"/([^/]+)/([^/]+)/([^/]+)/([^/]+)/([^/]+)/" + K.RAW_FILE_NAME + "$"
#: Parts a partition is known by in the tables that ``save`` keeps.
PARTS = ["source_key", "category_key", "run_date"]


def path_parts(path) -> dict:
    """source, category and run_date (null unless a valid date) of a raw file's path."""
    part = [F.regexp_extract(path, _PATH_RE, i) for i in range(1, 6)]
    digits = part[2].rlike("^[0-9]+$") & part[3].rlike("^[0-9]+$") & part[4].rlike("^[0-9]+$")
    day = F.try_to_date(F.concat_ws("-", part[2], part[3], part[4]), "yyyy-M-d")
    return {"source": part[0], "category": part[1], "run_date": F.when(digits, day)}


def _read(spark: SparkSession, tree: Tree, paths: list[str]) -> DataFrame:
    """path, source, category, run_date and value of the raw files at the tree's depth below ``paths``; bad dates dropped."""
    if not paths:
        return spark.createDataFrame([], "path string, source string, category string, run_date date, value string")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", K.RAW_FILE_NAME).text(paths, wholetext=True)
    path = F.col("_metadata.file_path")
    parts = path_parts(path)
    names = F.filter(F.split(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/"), lambda n: n != "")
    keep = parts["run_date"].isNotNull() & (F.size(names) == tree.depth() + 6)
    return files.where(keep).select(path.alias("path"), *[c.alias(k) for k, c in parts.items()], "value")


def scan(spark: SparkSession, root: str, sources=None, category: str | None = None,
         start_date: dt.date | None = None, end_date: dt.date | None = None) -> DataFrame:
    """path, source, category, run_date and value (whole text) of the tree's files with a valid date."""
    tree = Tree(spark, root)
    if start_date or end_date:
        paths = [folder for s, c in tree.categories(sources, category) for _, folder in tree.days(s, c, start_date, end_date)]
    elif category:
        paths = [f"{tree.root}/{s}/{c}" for s, c in tree.categories(sources, category)]
    else:
        paths = [f"{tree.root}/{s}" for s in sources or tree.names(tree.root)]
    return _read(spark, tree, [p for p in paths if tree.exists(p)])


def list_partitions(spark: SparkSession, root: str, sources=None, category: str | None = None,
                    start_date: dt.date | None = None, end_date: dt.date | None = None) -> DataFrame:
    """File listing -> (path, source, category, run_date); bad dates dropped; reads no content."""
    return scan(spark, root, sources, category, start_date, end_date).drop("value")


def parse_document(value) -> Column:
    """The records of a whole document; null unless it is a JSON array and nothing else.

    A closing field is set behind the text: where the text ends early or goes on,
    that field can't be read."""
    wrapped = F.concat(F.lit('{"records":'), value, F.lit(',"_end":1}'))
    schema = T.StructType([T.StructField("records", T.ArrayType(RAW_RECORD)), T.StructField("_end", T.IntegerType())])
    doc = F.from_json(wrapped, schema, {"mode": "PERMISSIVE"})
    return F.when(F.ltrim(value).startswith("[") & (doc["_end"] == 1), doc["records"])


def record_columns(r: str = "r") -> list:
    """The record's fields; the price as text and, where the file has a number, as a number, too."""
    from ..functions.prices import variant_number, variant_text
    price = F.col(r + ".price")
    out = [variant_text(price).alias("price") if c == "price" else F.col(f"{r}.{c}").alias(c) for c in RECORD_FIELDS]
    return [*out, variant_number(price).alias("_price_number")]


def read_files(files: DataFrame) -> DataFrame:
    """Records of scanned files (S4 tolerant read) with the set-if-absent partition columns (S3)."""
    rows = (files.select("source", "category", "run_date", "path", parse_document(F.col("value")).alias("recs"))
                 .select("source", "category", "run_date", "path", F.posexplode("recs").alias("pos", "r")))
    return rows.select(
        *record_columns(),
        F.coalesce(F.col("r._source"), F.col("source")).alias("_source"),
        F.coalesce(F.col("r._category"), F.col("category")).alias("_category"),
        F.coalesce(F.col("r._run_date"), F.col("run_date").cast("string")).alias("_run_date"),
        F.col("path").alias("_file"), F.col("pos").alias("_pos"))


def iter_records(spark: SparkSession, root: str, source: str | None = None, category: str | None = None,
                 start_date=None, end_date=None) -> DataFrame:
    """Every record of the matching partitions (dates inclusive).  Without
    a source the default source list is read."""
    sources = [source] if source else list(K.DEFAULT_RAW_SOURCES)
    return read_files(scan(spark, root, sources, category, start_date, end_date))


def load_latest(spark: SparkSession, root: str, source: str | None = None,
                category: str | None = None) -> DataFrame:
    """Per (source, category) only the partition with the greatest
    valid date; an unreadable latest file yields nothing (no fallback)."""
    tree = Tree(spark, root)
    found = [tree.latest_file(s, c) for s, c in tree.categories([source] if source else None, category)]
    return read_files(_read(spark, tree, [f for f in found if f]))


# ------------------------------------------------------------------ S6 / W5
def upsert(existing: DataFrame, incoming: DataFrame, pos_col: str = "_pos", keys=()) -> DataFrame:
    """Merge ``incoming`` into ``existing`` by trimmed URL.

    * a URL's slot is its LAST existing occurrence (earlier duplicates stay),
      or for a new URL its first incoming occurrence;
    * the slot holds the latest record among the slot row and all incoming
      rows with that URL (incoming wins; last incoming wins);
    * blank / missing URLs are always appended.
    Output carries ``_seq`` (0 existing, 1 incoming) and ``pos_col`` of the
    slot, which give the merged order.  ``keys`` are partition columns the
    merge is done within (e.g. source, category, run date).
    """
    keys = list(keys)
    cols = [c for c in existing.columns if c != pos_col]
    # a number, or a structure of numbers: whatever has an order
    place = F.col(pos_col) if isinstance(incoming.schema[pos_col].dataType, T.StructType) else F.col(pos_col).cast("long")
    e = existing.select(*cols, place.alias("_p"), F.lit(0).alias("_seq"))
    i = incoming.select(*cols, place.alias("_p"), F.lit(1).alias("_seq"))
    allr = e.unionByName(i).withColumn("_key", F.trim(F.coalesce(F.col("url"), F.lit(""))))
    blank = allr.where(F.col("_key") == "")
    keyed = allr.where(F.col("_key") != "")
    last_e = keyed.where(F.col("_seq") == 0).groupBy(*keys, "_key").agg(F.max("_p").alias("_last_e"))
    last_e = last_e.select(*[F.col(c).alias("_j_" + c) for c in keys + ["_key"]], "_last_e")
    same = F.lit(True)
    for c in keys + ["_key"]:       # a null partition key is a key like any other
        same = same & F.col(c).eqNullSafe(F.col("_j_" + c))
    k = keyed.join(last_e, same, "left").drop(*["_j_" + c for c in keys + ["_key"]])
    is_slot = (F.col("_seq") == 1) | F.col("_p").eqNullSafe(F.col("_last_e"))
    stale = k.where(~is_slot).drop("_last_e")
    slot_rows = k.where(is_slot)
    winner = F.max(F.struct(F.col("_seq").alias("s"), F.col("_p").alias("p"),
                            *[F.col(c) for c in cols])).alias("w")
    where = F.min(F.struct(F.col("_seq").alias("s"), F.col("_p").alias("p"))).alias("slot")
    merged = (slot_rows.groupBy(*[F.col(c).alias("_k_" + c) for c in keys], "_key").agg(winner, where)
                       .select("_key", *[F.col("w." + c).alias(c) for c in cols],
                               F.col("slot.p").alias("_p"), F.col("slot.s").alias("_seq")))
    out = merged.unionByName(stale).unionByName(blank)
    return out.withColumnRenamed("_p", pos_col).drop("_key")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there; any other trouble with it is raised."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def position(batch: Column, file: Column, place: Column) -> Column:
    """Where a record came in: its batch, its file's rank in batch and partition, and its place in the file.

    Structures compare field by field, so no field has a bound that another one would run into."""
    return F.struct(batch.cast("long").alias("batch"), file.cast("long").alias("file"), place.cast("long").alias("place"))


def save(spark: SparkSession, records: DataFrame, table: str, batch: int | None = None) -> None:
    """Merge ``records`` into the partitions they touch and replace those.

    ``records`` has the partition columns (``PARTS``), ``_file`` and ``_i``,
    which give the incoming order.  Positions grow with the batch, so nothing
    is renumbered: a partition's merged order is that of ``_pos`` (batch, file, place).  A batch that
    is saved again (the same number, after a failure) replaces its rows without
    a URL, which would be appended twice; the others meet their own URL.
    Without a number the next one is taken."""
    from ..session import cut_lineage
    existing = None
    if table_exists(spark, table):
        existing = spark.read.parquet(table)
        if batch is None:
            batch = (existing.agg(F.max("_batch")).first()[0] or 0) + 1
    batch = batch or 0
    order = Window.partitionBy(*PARTS).orderBy("_file")
    files = records.select(*PARTS, "_file").distinct().withColumn("_f", F.row_number().over(order))
    files = files.select(*[F.col(c).alias("_j_" + c) for c in [*PARTS, "_file"]], "_f")
    same = F.lit(True)
    for c in [*PARTS, "_file"]:
        same = same & F.col(c).eqNullSafe(F.col("_j_" + c))
    place = position(F.lit(batch), F.col("_f"), F.col("_i"))
    incoming = (records.join(files, same).withColumn("_pos", place).withColumn("_batch", F.lit(batch).cast("long"))
                       .drop("_file", "_i", "_f", *["_j_" + c for c in [*PARTS, "_file"]]))
    incoming = cut_lineage(incoming)
    if existing is None:
        existing = spark.createDataFrame([], incoming.schema)
    touched = incoming.select(*[F.col(c).alias("_j_" + c) for c in PARTS]).distinct()
    same = F.lit(True)
    for c in PARTS:
        same = same & F.col(c).eqNullSafe(F.col("_j_" + c))
    again = F.col("_batch").eqNullSafe(F.lit(batch)) & (F.trim(F.coalesce(F.col("url"), F.lit(""))) == "")
    before = existing.join(touched, same, "left_semi").where(~again).select(*incoming.columns)
    out = cut_lineage(upsert(before, incoming, keys=PARTS).drop("_seq"))   # the table is read above: cut before replacing it
    write_partitioned(out, table, PARTS, "parquet")


#: Records of a file that is compressed, which one task has to read whole.
COMPRESSED_RECORDS = 500_000


def packed(writer: DataFrameWriter, compression: str | None, records: int = COMPRESSED_RECORDS) -> DataFrameWriter:
    """``writer`` with its text files compressed by that codec (``gzip``: .json.gz), or plain without one."""
    return writer.option("compression", compression).option("maxRecordsPerFile", records) if compression else writer


def write_partitioned(df: DataFrame, path: str, partition_cols, fmt: str = "json",
                      mode: str = "overwrite", compression: str | None = None) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df``
    are replaced (S6 save / S7 publish)."""
    with shuffles_freed(df.sparkSession):
        w = packed(df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols), compression)
        if fmt == "json":
            w = w.option("ignoreNullFields", False)   # explicit nulls, like the reference output
        w.format(fmt).save(path)


def publish(records: DataFrame, target: str, dry_run: bool = False, compression: str | None = None):
    """Write every raw partition to the hive-style target layout
    ``source_key=/category_key=/year=/month=/day=`` (the folder values, the
    records keep their own fields); dry run returns the target folders.
    With ``compression`` the JSON files are packed by that codec."""
    d = F.try_to_date(F.col("_run_date"))
    out = (records.withColumn("source_key", F.col("_source"))
                  .withColumn("category_key", F.col("_category"))
                  .withColumn("year", F.date_format(d, "yyyy"))
                  .withColumn("month", F.date_format(d, "MM"))
                  .withColumn("day", F.date_format(d, "dd")))
    parts = ["source_key", "category_key", "year", "month", "day"]
    if dry_run:
        return out.select(F.concat_ws("/", F.lit(target.rstrip("/")),
                                      *[F.concat(F.lit(c + "="), F.col(c)) for c in parts])
                          .alias("target")).distinct()
    write_partitioned(out.drop("_file"), target, parts, compression=compression)
    return None
