"""Rating, movie and link files: scans, landing as parquet, id mappings, factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ratingloom.session import scratch_path
from ratingloom.sources import schemas


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", header: bool = True
) -> DataFrame:
    """CSV scan under a declared schema, without an inference pass.

    With a header, columns are found by their names, whatever their order; a declared
    column that the header lacks is an error, and so is a file whose header differs from
    the first one's. Without a header they are taken by place.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if not header:
        return reader.schema(schema).csv(path)
    names = reader.csv(path).columns
    missing = [name for name in schema.fieldNames() if name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    found = StructType([schema[name] if name in schema.fieldNames() else StructField(name, StringType()) for name in names])
    return reader.schema(found).option("enforceSchema", False).csv(path).select(*schema.fieldNames())


def read_ratings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.RATINGS)


def read_movies(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.MOVIES)


def read_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Links with ``tmdbId`` kept as text."""
    return read_csv(spark, path, schemas.LINKS).select("movieId", "tmdbId")


def read_factors(spark: SparkSession, path: str, id_column: str = "movieId") -> DataFrame:
    """Stored factors ``(id, features)`` under the name of the entity they describe."""
    return spark.read.schema(schemas.FACTORS).parquet(path).select(
        F.col("id").cast("int").alias(id_column), "features"
    )


def write_factors(factors: DataFrame, path: str) -> None:
    """Replace the stored factors. Accepts ``(id, features)`` in any id column name."""
    id_column = next(name for name in factors.columns if name != "features")
    factors.select(
        F.col(id_column).cast("int").alias("id"), F.col("features").cast("array<float>").alias("features")
    ).write.mode("overwrite").parquet(path)


def staged(table: DataFrame, path: str | None = None) -> DataFrame:
    """``table`` written to ``path`` (or a fresh scratch path) and read back.

    Cuts the lineage of a result that several jobs read: they share one
    computation, prune columns and push filters into the scan, and a lost executor
    costs a read.
    """
    path = path or scratch_path(table.sparkSession, "stage")
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def land_raw(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    target: str,
    rejects: str,
    sep: str = ",",
    header: bool = True,
) -> None:
    """Land a raw text table as parquet, lines that do not fit the schema apart.

    Lines with exactly the declared columns, every one convertible, go to ``target`` in
    their declared types; the others go to ``rejects``: the columns as text and, if
    their number is wrong, the whole ``line``. ``sep="::"``, ``header=False`` reads the
    older ``.dat`` files. The text is parsed once; all writes overwrite, so a repeated
    run changes nothing.
    """
    text = schemas.as_text(schema)
    reader = spark.read.option("header", header).option("sep", sep).option("columnNameOfCorruptRecord", "line")
    raw = reader.schema(StructType([*text.fields, StructField("line", StringType())])).csv(path)
    write_fitting(raw, schema, target, rejects)


def write_fitting(raw: DataFrame, schema: StructType, target: str, rejects: str) -> None:
    """Text rows (the schema's columns and ``line``) that fit the schema to ``target``, the others to ``rejects``."""
    spark, text = raw.sparkSession, schemas.as_text(schema)
    fits = F.col("line").isNull()
    for field in schema:
        fits = fits & F.col(field.name).try_cast(field.dataType).isNotNull()
    parsed = scratch_path(spark, "landing")
    raw.withColumn("fits", fits).write.partitionBy("fits").parquet(parsed)
    parts = spark.read.schema(StructType([*raw.schema.fields, StructField("fits", BooleanType())])).parquet(parsed)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    parts.filter("fits").select(*typed).write.mode("overwrite").parquet(target)
    parts.filter("NOT fits").select(*text.fieldNames(), "line").write.mode("overwrite").parquet(rejects)
    delete_path(spark, parsed)


def _file_system(spark: SparkSession, path: str):
    """The path and its file system as Hadoop objects, whichever system the path names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, system = _file_system(spark, path)
    return system.exists(jvm_path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder."""
    jvm_path, system = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(jvm_path)]


def is_file(spark: SparkSession, path: str) -> bool:
    jvm_path, system = _file_system(spark, path)
    return system.getFileStatus(jvm_path).isFile()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with what is in it."""
    jvm_path, system = _file_system(spark, path)
    system.delete(jvm_path, True)
