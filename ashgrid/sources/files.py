"""File sources (SRC-1..3, SRC-5, SRC-7, SRC-8).

All readers take explicit schemas or select the needed columns right away, so
Catalyst prunes the scan; paths may use any Hadoop file system scheme.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError


# SRC-1
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


# SRC-2
def projected_csv(spark: SparkSession, path: str, wanted: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """Only the wanted columns that the header has, de-duplicated in order, as
    ``types`` says (default: text).  The header is read once (a one-line scan)
    and gives every column its place; the projection reaches the CSV scan, so
    other columns are never parsed.  All files share the header of the first
    (``typed_csv`` reads files of different headers and reports bad lines); a
    value that its type cannot take is null."""
    header = spark.read.option("header", True).csv(path).columns
    cols = list(dict.fromkeys(c for c in wanted if c in header))
    types = types or {}
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.option("header", True).schema(schema).csv(path)
    return df.select(*[F.col(f"`{c}`").try_cast(types.get(c, "string")).alias(c) for c in cols])


def typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the columns of ``schema``, found by name in the header of
    each file, whatever its order and whatever else it holds.

    A column that a file does not have is null.  A line with too few or too many
    fields for its file's header, or with a value that its type cannot take, goes
    to the rejects (source_file, line, reason) and not to the rows; an empty field
    is null.  Lines that repeat their file's header are headers.  Lines are
    records, so that large files are split; a quoted line break is not supported.

    The header of a file is the first line of its first block; the driver gets
    the different numbers of columns, nothing else."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"),
                                        F.col("_metadata.file_block_start").alias("__start"))
    text = text.filter(F.trim("line") != "")
    heads = (text.filter("__start = 0").withColumn("__id", F.monotonically_increasing_id()).groupBy("source_file")
             .agg(F.min_by("line", "__id").alias("__header")))
    # a separator inside quotes only makes this too large, and such a header's lines are read with the larger width
    width = F.length("__header") - F.length(F.replace("__header", F.lit(sep), F.lit(""))) + 1
    widths = [r[0] for r in heads.select(width).distinct().collect()]

    def fields(line: str):
        """Fields of a line as its file's header has them; null if their number differs."""
        out = F.lit(None).cast("array<string>")
        for w in widths:
            form = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(w)] + [T.StructField("_bad", T.StringType())])
            read = F.from_csv(line, form.simpleString()[7:-1].replace(":", " "),
                              {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
            found = F.when(read["_bad"].isNull(), F.array(*[read[f"_{i}"] for i in range(w)]))
            out = F.when(F.col("__width") == w, found).otherwise(out)
        return out

    heads = heads.withColumn("__width", width)
    heads = heads.withColumn("__names", F.transform(fields("__header"), lambda n: F.trim(F.ltrim(n, F.lit("\ufeff")))))
    lines = text.drop("__start").join(heads, "source_file").filter(F.col("line") != F.col("__header"))
    lines = lines.withColumn("__fields", fields("line"))
    raw = {f.name: F.get("__fields", (F.array_position("__names", F.lit(f.name)) - 1).cast("int")) for f in wanted}
    typed = {n: F.when(F.array_contains("__names", F.lit(n)), raw[n]).try_cast(wanted[n].dataType) for n in raw}
    reason = F.when(F.col("__fields").isNull(), "wrong number of fields")
    for n in raw:
        reason = reason.when(F.array_contains("__names", F.lit(n)) & raw[n].isNotNull() & typed[n].isNull(), F.lit(f"bad value in {n}"))
    judged = lines.withColumn("reason", reason)
    return (judged.filter(F.col("reason").isNull()).select(*[c.alias(n) for n, c in typed.items()]),
            judged.filter(F.col("reason").isNotNull()).select("source_file", "line", "reason"))


# SRC-3
def file_collect(spark: SparkSession, root: str, patterns: Sequence[str] = ("*.tif", "*.tiff")) -> DataFrame:
    """Recursive listing of matching files, sorted and unique (paths only; the
    file contents are never read because the column is pruned)."""
    frames = []
    for p in patterns:
        frames.append(
            spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", p)
            .load(root).select("path")
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out.distinct().orderBy("path")


# SRC-7
def points_csv(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Caller-named coordinate columns; missing ones are an error; rows with
    a null coordinate are dropped."""
    missing = [c for c in (lat, lon) if c not in df.columns]
    if missing:
        raise ContractError(f"points file is missing {missing}; has {df.columns}")
    return df.na.drop(subset=[lat, lon])


# SRC-8
def grid_file(spark: SparkSession, path: str) -> DataFrame:
    """Columns by header name, whatever their order in the file."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.col("lat").cast("double"), F.col("lon").cast("double"))


# SRC-5
_GEOM = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
_GEOJSON = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
        T.StructField("geometry", _GEOM),
        T.StructField("features", T.ArrayType(T.StructType([T.StructField("geometry", _GEOM)]))),
    ]
)
_RINGS = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"


def polygon_rings(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection, Feature or bare geometry -> rings.

    Output: poly (bigint id of the polygon), ring (0 = exterior, >0 = holes), coords
    array<array<double>> of [lon, lat].  Polygon and MultiPolygon are read;
    other geometry types are skipped.  Coordinates are kept as raw JSON until
    the geometry type is known, then parsed with the matching schema.
    """
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", _GEOJSON).alias("g"), F.col("_metadata.file_path").alias("f"))
    g = F.col("g")
    geoms = F.when(g["type"] == "FeatureCollection", F.transform(g["features"], lambda x: x["geometry"])).when(
        g["type"] == "Feature", F.array(g["geometry"])
    ).otherwise(F.array(F.struct(g["type"].alias("type"), g["coordinates"].alias("coordinates"))))
    gx = raw.select("f", F.posexplode(geoms).alias("gi", "geom"))
    polys = F.when(F.col("geom.type") == "Polygon", F.array(F.from_json("geom.coordinates", _RINGS))).when(
        F.col("geom.type") == "MultiPolygon", F.from_json("geom.coordinates", _MULTI)
    )
    px = gx.select("f", "gi", F.posexplode(polys).alias("pi", "rings"))
    rx = px.select(
        F.xxhash64("f", "gi", "pi").alias("poly"),
        F.posexplode("rings").alias("ring", "coords"),
    )
    return rx


# SRC-6
def layer_map(spark: SparkSession, path: str) -> DataFrame:
    """(k, v): parsed layer name -> wanted name, from a JSON file that holds one
    object of texts (over one or many lines).  Pairs with a null or empty name are
    left out; a file that is not such an object fails the job when it is read."""
    text = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    return text.select(F.explode(pairs).alias("k", "v")).filter("v IS NOT NULL AND v <> ''")
