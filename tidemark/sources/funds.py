"""Fund files: separated by semicolons, every column read as text, UTF-8 or Latin-1, malformed lines out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import to_number
from tidemark.operators.series import choose_series, last_of_day

COLUMNS = (
    "RUN_ADM NOM_ADM RUN_FM FECHA_INF MONEDA PARTICIPES_INST SERIE FONDO_PEN VALOR_CUOTA CUOTAS_APORTADAS CUOTAS_RESCATADAS CUOTAS_EN_CIRCULACION "
    "PATRIMONIO_NETO ACTIVO_TOT NUM_PARTICIPES REM_FIJA REM_VARIABLE GASTOS_AFECTOS GASTOS_NO_AFECTOS COMISION_INVERSION COMISION_RESCATE"
).split()
NUMERIC = tuple("CUOTAS_APORTADAS CUOTAS_RESCATADAS CUOTAS_EN_CIRCULACION PATRIMONIO_NETO ACTIVO_TOT NUM_PARTICIPES".split())


def discover(spark: SparkSession, base: str, folder: str, run_fm: str) -> list[str]:
    """Text files of a fund's own folder and of every folder named after its number, each once, in order."""
    found: set[str] = set()
    for pattern in (f"{base}/{folder}/*.txt", f"{base}/{run_fm}_*/*.txt"):
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found.update(f.getPath().toString() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or [])
    return sorted(found)


def response_name(fund: str, start: str, end: str, disposition: str = "", taken: frozenset[str] = frozenset()) -> str:
    """What a downloaded file is called: the name it was sent under after the fund's, or fund and range if it has none or that one is taken."""
    plain = f"cmf_{fund}_{re.sub('[^0-9]', '-', start)}_{re.sub('[^0-9]', '-', end)}.txt"
    sent = re.search(r'filename="?([^"]+)"?', disposition)
    name = f"{fund}_{sent[1].strip()}" if sent else plain
    return plain if name in taken else name


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files of all paths as text columns with ``file`` and ``line``; columns that a file lacks are null.

    Files are read as bytes, since each one's encoding has to be found; a file is one
    fund's months and small.
    """
    names = [*COLUMNS, "file", "line"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    text = content.decode("utf-8-sig")
                except UnicodeDecodeError:
                    text = content.decode("latin-1")
                lines = text.splitlines()
                head = [h.strip() for h in lines[0].split(";")] if lines else []
                rows = [(k, r) for k, line in enumerate(lines[1:], 1) if line.strip() and len(r := line.split(";")) == len(head)]
                place = {c: head.index(c) for c in COLUMNS if c in head}
                cols = [pa.array([r[place[c]] for _, r in rows] if c in place else [None] * len(rows), pa.string()) for c in COLUMNS]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([path] * len(rows), pa.string()), pa.array([k for k, _ in rows], pa.int64())], names)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(go, ", ".join(f"{c} string" for c in COLUMNS) + ", file string, line long")


def typed(df: DataFrame) -> DataFrame:
    """Numbers by decimal point or comma, ``date`` from the report date; what isn't understood is null."""
    df = df.withColumn("valor_cuota", to_number("VALOR_CUOTA"))  # takes the place of the written price
    return df.withColumns({c: to_number(c) for c in NUMERIC} | {"date": F.coalesce(F.try_to_timestamp("FECHA_INF", F.lit("yyyyMMdd")), F.try_to_timestamp("FECHA_INF", F.lit("yyyy-MM-dd"))).cast("date")})


def load(spark: SparkSession, paths: list[str], run_fm: str, preferred: list[str], start: object, end: object) -> DataFrame:
    """A fund's series of one chosen share class: one positive price a day, the last that arrived."""
    df = typed(read_files(spark, paths)).where(F.trim("RUN_FM") == run_fm).withColumn("SERIE", F.trim("SERIE"))
    missing = {"RUN_FM", "FECHA_INF"} - set(df.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    chosen = choose_series(df, ["RUN_FM"], "SERIE", preferred, "PATRIMONIO_NETO").select("RUN_FM", F.col("selected_series").alias("SERIE"))
    df = df.join(F.broadcast(chosen), ["RUN_FM", "SERIE"]).where(F.col("date").between(F.lit(str(start)), F.lit(str(end))))
    return last_of_day(df, ["RUN_FM", "SERIE"], "date", ["file", "line"], "valor_cuota").drop("file", "line")


def latest_day(df: DataFrame) -> DataFrame:
    return df.agg(F.max("date").alias("latest"))
