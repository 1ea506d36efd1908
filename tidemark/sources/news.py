"""News files: one JSON document for each medium and day, ``{metadata, articles}``."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from tidemark.functions.dates import folder_date

NAMES = ("noticias_dia.txt", "noticias_dia")


def placed(df: DataFrame) -> DataFrame:
    """Adds ``file``, ``medium``, ``day_dir`` and ``day`` from the path ``medium/DD_MM_YYYY/name``."""
    path = F.col("_metadata.file_path")
    parts = F.split(path, "/")
    day = F.element_at(parts, -2)
    return df.select("*", path.alias("file"), F.element_at(parts, -3).alias("medium"), day.alias("day_dir"), folder_date(day).alias("day"))


def globs(base: str, media: Iterable[str], days: Iterable[object] | None = None, names: Iterable[str] = NAMES) -> list[str]:
    """Path patterns of the files of some media, on some days if given: other folders aren't even listed."""
    from datetime import date

    found = "{" + ",".join(names) + "}"
    dirs = ["??_??_????"] if days is None else [date.fromisoformat(str(d)).strftime("%d_%m_%Y") for d in days]
    return [f"{base}/{m}/{d}/{found}" for m in media for d in dirs]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Patterns that meet at least one file, asked of the file system that holds them."""
    jvm = spark._jvm
    out = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        if found is not None and len(found):
            out.append(p)
    return out


def read_days(spark: SparkSession, base: str, media: Iterable[str], schema: StructType, days: Iterable[object] | None = None, names: Iterable[str] = NAMES) -> DataFrame:
    """One row for each file: ``metadata``, ``articles``, place, and ``_corrupt_record`` where the JSON is broken.

    Where a day has several of the names, the first one counts.
    """
    paths = existing(spark, globs(base, media, days, names))
    full = StructType([*schema.fields]).add("_corrupt_record", "string")
    if not paths:
        return spark.createDataFrame([], full).selectExpr("*", "cast(null as string) as file", "cast(null as string) as medium", "cast(null as string) as day_dir", "cast(null as date) as day")
    df = placed(spark.read.schema(full).option("multiLine", True).json(paths)).where("day is not null")
    rank = F.array_position(F.array(*map(F.lit, names)), F.element_at(F.split("file", "/"), -1))
    return df.withColumn("_n", F.row_number().over(Window.partitionBy("medium", "day").orderBy(rank))).where("_n = 1").drop("_n")


def articles(files: DataFrame) -> DataFrame:
    """One row for each article with its position; broken files give none."""
    return files.where("_corrupt_record is null").select("file", "medium", "day_dir", "day", F.posexplode("articles").alias("position", "article"))


def read_articles(spark: SparkSession, path: str, article: StructType) -> DataFrame:
    """Articles of a file that is a list of them or an object that holds the list."""
    whole = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", ArrayType(article))
    held = F.from_json("value", StructType().add("articles", ArrayType(article)))["articles"]
    return whole.select(F.posexplode(F.when(F.ltrim("value").startswith("["), listed).otherwise(held)).alias("position", "article"))


def write_days(df: DataFrame, path: str, key: str, medium: str = "medium", day: str = "day") -> None:
    """Articles partitioned by medium and day; only days that ``df`` has are replaced.

    A key under several days is an error, whether within ``df`` or against days that are
    stored already and stay.
    """
    from tidemark.operators.identity import assert_unique

    every = df.select(medium, key, F.col(day).cast("string").alias(day))
    if existing(df.sparkSession, [f"{path}/{medium}=*/{day}=*/*"]):
        stored = df.sparkSession.read.parquet(path).select(medium, key, F.col(day).cast("string").alias(day))
        every = every.unionByName(stored.join(every.select(medium, day).distinct(), [medium, day], "left_anti"))
    assert_unique(every, medium, key, day)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(medium, day).parquet(path)


def rewrite_file(spark: SparkSession, path: str, change: Callable[[dict], dict], overwrite: bool = True, name: str | None = None) -> str | None:
    """A day's file with its payload changed, in place or as a sibling (``_normalizado`` before the suffix, or ``name``).

    The first time, the file is copied to ``.bak``, and never again, so that the backup is
    the original. Returns where it was written; null, and nothing is written, if the file
    can't be read or changed.
    """
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = source.getFileSystem(conf)
    try:
        text = spark.read.text(path, wholetext=True).first()[0]
        changed = json.dumps(change(json.loads(text)), ensure_ascii=False, indent=2)
    except Exception as e:  # noqa: BLE001  one broken file must not stop the others
        print(f"{path} passed over: {str(e)[:200]}")
        return None
    backup = jvm.org.apache.hadoop.fs.Path(f"{path}.bak")
    if not fs.exists(backup):
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, fs, backup, False, conf)
    folder, _, file = path.rpartition("/")
    stem, dot, end = file.rpartition(".")
    sibling = name or (f"{stem}_normalizado.{end}" if dot else f"{file}_normalizado")
    if not overwrite and sibling == file:
        raise ValueError("the sibling needs a name of its own")
    target = path if overwrite else f"{folder}/{sibling}"
    out = fs.create(jvm.org.apache.hadoop.fs.Path(target), True)
    out.write(bytearray(changed.encode("utf-8")))
    out.close()
    return target


def day_exists(spark: SparkSession, path: str, medium: str, day: object) -> bool:
    return bool(existing(spark, [f"{path}/medium={medium}/day={day}/*"]))


def with_integrity(articles_: DataFrame, candidates: list[Column], url: Column, day: str = "day") -> tuple[DataFrame, DataFrame]:
    """Articles whose corrected publication day is their folder's, and the rejected ones."""
    from tidemark.functions.dates import corrected
    from tidemark.operators.identity import quarantine

    c = corrected(candidates, url)
    df = articles_.withColumn("publication", c)
    return quarantine(df, F.col("publication.day") == F.col(day))
