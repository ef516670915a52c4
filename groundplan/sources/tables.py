"""Readers and writers of listings, registry records, zones and reports."""

from __future__ import annotations

from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from groundplan.functions.json_html import flatten_sections
from groundplan.functions.text import blank_to_null, col, pincode_key, repair_url, url_domain
from groundplan.operators.rows import reindex
from groundplan.operators.spatial import valid_zone
from groundplan.sources import csv_split
from groundplan.schema import COLUMNS, LISTING, NUMERIC_COLS, REGISTRY

RECORD = (
    "district string, district_id int, token string, summary map<string,string>, error string, "
    "detail struct<sections: map<string,map<string,string>>, tables: map<string,array<map<string,string>>>, raw_labels: map<string,string>>"
)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, split: bool | None = None) -> DataFrame:
    """All columns as text, blanks null, header names trimmed and without a byte-order mark.

    Spark reads a file with quoted line breaks in one task. split: cut files between tasks, with equal rows (csv_split); by
    default if they are larger than one of Spark's partitions.
    """
    if split is None:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        largest = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
        split = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() > largest
    df = csv_split.read(spark, path) if split else spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    return df.select([blank_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols: list[str] = NUMERIC_COLS) -> DataFrame:
    """Named columns that are there as doubles, junk and NaN as null."""
    made = {c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in cols if c in df.columns}
    return df.withColumns(made)


def load_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive in the listing schema: URLs repaired, source from the URL's host, codes as text."""
    df = read_csv(spark, path)
    url = repair_url("URL") if "URL" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("URL", url).withColumn("Source", url_domain("URL"))
    if "Pincode" in df.columns:
        df = df.withColumn("Pincode", pincode_key("Pincode"))
    return reindex(df, LISTING)


def load_listings(spark: SparkSession, *paths: str) -> DataFrame:
    """The first of the paths that exists, numeric columns coerced."""
    for path in paths:
        if exists(spark, path):
            return coerce_numeric(read_csv(spark, path))
    raise FileNotFoundError(", ".join(paths))


def load_interim(spark: SparkSession, path: str) -> DataFrame | None:
    """Crawled rows in the listing schema, None if there are none yet."""
    return reindex(read_csv(spark, path), LISTING) if exists(spark, path) else None


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry rows as text with an `idx` in the file's order and the names used here."""
    df = read_csv(spark, path)
    named = [F.col(f"`{old}`").alias(new) if old in df.columns else F.lit(None).cast("string").alias(new) for old, new in REGISTRY.items()]
    return df.select(F.monotonically_increasing_id().alias("idx"), *named)


def load_records(spark: SparkSession, path: str, successful: bool = True) -> DataFrame:
    """The registry's JSON lines; `successful` leaves out errors and records without sections."""
    df = spark.read.schema(RECORD).json(path)
    return df.filter(F.size(F.map_keys("detail.sections")) > 0) if successful else df


def done_tokens(records: DataFrame) -> DataFrame:
    return records.select("token").filter("token is not null").distinct()


def flatten_records(records: DataFrame, district: str | None = None, most: int = 5000) -> DataFrame:
    """token, district and one column for each distinct section key, in the order in which keys are first seen.

    The columns are metadata: their number is checked against `most`.
    """
    if district is not None:
        records = records.filter(F.lower("district") == F.lower(F.trim(F.lit(district))))
    flat = records.select("token", "district", flatten_sections(F.col("detail.sections"), F.col("summary")).alias("m"))
    at = flat.select(F.struct("token").alias("row"), F.posexplode(F.map_keys("m")).alias("pos", "key"))
    keys = [r.key for r in at.groupBy("key").agg(F.min(F.struct("row", "pos")).alias("o")).orderBy("o").limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"more than {most} distinct keys")
    return flat.select("token", "district", *[F.try_element_at("m", F.lit(k)).alias(k) for k in keys])


def load_zones(spark: SparkSession, paths: list[str], missing_ok: bool = False) -> DataFrame | None:
    """zone_id, pincode, district, rings of GeoJSON features that have a code and a valid geometry.

    zone_id follows the order of the paths, of the files of a folder by name, and of the features of a file. A missing file is an error, or is skipped with missing_ok; None if nothing is left.
    """
    there = [p for p in paths if exists(spark, p)]
    if not there:
        if missing_ok:
            return None
        raise FileNotFoundError(", ".join(paths))
    if len(there) < len(paths) and not missing_ok:
        raise FileNotFoundError(", ".join(sorted(set(paths) - set(there))))
    point = T.ArrayType(T.DoubleType())
    props = T.MapType(T.StringType(), T.StringType())
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("properties", props), T.StructField("geometry", geometry)])))])
    read = spark.read.schema(schema).option("multiLine", True)
    features = reduce(DataFrame.union, [read.json(p).select(F.lit(i).alias("nth"), F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("place", "f")) for i, p in enumerate(there)])
    files = features.select("nth", "file").distinct().withColumn("number", F.row_number().over(Window.orderBy("nth", "file")) - 1)
    f = features.join(files, ["nth", "file"]).select((F.col("number").cast("long") * (1 << 32) + F.col("place")).alias("zone_id"), "f")
    one = F.from_json("f.geometry.coordinates", T.ArrayType(T.ArrayType(point)))
    many = F.flatten(F.from_json("f.geometry.coordinates", T.ArrayType(T.ArrayType(T.ArrayType(point)))))
    lists = F.when(F.col("f.geometry.type") == "MultiPolygon", many).otherwise(one)
    rings = F.transform(lists, lambda r: F.transform(r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    p = F.transform_keys("f.properties", lambda k, v: F.lower(k))
    get = lambda *names: F.coalesce(*[F.try_element_at(p, F.lit(n)) for n in names])
    zones = f.select("zone_id", pincode_key(get("pincode", "pin_code")).alias("pincode"), get("district", "dtname").alias("district"), rings.alias("rings"))
    return zones.filter(F.col("pincode").isNotNull() & valid_zone(F.col("rings")))


def load_images(spark: SparkSession, path: str, glob: str = "*.{png,jpg,jpeg,tif,tiff,bmp}") -> DataFrame:
    """path, modificationTime, length and content of image files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def plain_amounts(df: DataFrame) -> DataFrame:
    """Whole doubles as integers in text, so that no file holds 5.0E8."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    made = {c: F.when(F.col(c) == F.rint(F.col(c)), F.col(c).try_cast("decimal(38,0)").cast("string")).otherwise(F.format_string("%.10f", F.col(c))) for c in doubles}
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.regexp_replace(x, r"(\.\d*?)0+$", "$1")) for c, x in made.items()})


def save_csv(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    out = plain_amounts(df)
    (out.coalesce(files) if files else out).write.mode(mode).option("header", True).csv(path)


def checkpointed(df: DataFrame, path: str) -> DataFrame:
    """df written as a CSV table and read back with its own types: a step that can be started from again."""
    save_csv(df, path)
    back = read_csv(df.sparkSession, path)
    return back.select([F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in df.schema.fields])


def append_rows(df: DataFrame, path: str) -> None:
    """Append rows in the listing schema; unknown columns are ignored."""
    save_csv(reindex(df, LISTING), path, mode="append")


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def migrate(spark: SparkSession, path: str, to: str) -> None:
    """An older table in the listing schema: new columns blank, unknown ones dropped; written beside, for the caller to swap."""
    save_csv(reindex(read_csv(spark, path), LISTING), to)


def rows_per_source(df: DataFrame) -> DataFrame:
    return df.groupBy("Source").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "Source")


def write_report(sheets: dict[str, DataFrame], path: str, overview: DataFrame | None = None) -> list[str]:
    """One CSV table for each sheet under path, names cut to 31 characters; returns the names in order."""
    names = []
    for name, df in ([("Overview", overview)] if overview is not None else []) + list(sheets.items()):
        short = name[:31]
        save_csv(df, str(PurePosixPath(path) / short) if "://" not in path else f"{path.rstrip('/')}/{short}", files=1 if name == "Overview" else None)
        names.append(short)
    return names


def split_by_deal(df: DataFrame, deal: str = "deal_type") -> tuple[DataFrame, DataFrame]:
    """Sale rows, and rent and lease rows."""
    return df.filter(F.col(deal) == "Sale"), df.filter(F.col(deal).isin("Rent", "Lease"))


def listing_columns(made: dict[str, Column], url: Column, source: str, today: Column | None = None) -> list[Column]:
    """The listing schema's columns from those that a parser makes; blanks are null."""
    day = today if today is not None else F.current_date()
    fixed = {"URL": url, "Source": F.lit(source), "Year": F.year(day), "Month": F.month(day), "YearMonth": F.date_format(day, "yyyy-MM")}
    all_ = fixed | made
    out = []
    for f in LISTING.fields:
        c = all_.get(f.name)
        c = F.lit(None) if c is None else col(c)
        out.append((F.nullif(c.cast("string"), F.lit("")) if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).cast(f.dataType).alias(f.name))
    return out


assert len(COLUMNS) == 42
