"""File sources and sinks: contract CSV, zipped CSV, XML folders, partition replacement, seeds, logs."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class ContractError(ValueError):
    """A file without a column of the contract."""


def header(name: str) -> str:
    """'\\ufeffEstado - Sigla ' -> 'estado_sigla'"""
    return re.sub(r" - | ", "_", name.replace("﻿", "").strip().lower())


def list_files(spark: SparkSession, path: str, suffix: str = "", recursive: bool = True) -> list[tuple[str, int]]:
    """(path, modification time in ms) of the files below a folder or of a glob, hidden ones left out: a listing, on the driver as Spark's own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    out = []
    for found in fs.globStatus(at) or []:
        each = fs.listFiles(found.getPath(), recursive) if found.isDirectory() else None
        while each is not None and each.hasNext():
            f = each.next()
            out.append((f.getPath().toString(), f.getModificationTime()))
        if each is None:
            out.append((found.getPath().toString(), found.getModificationTime()))
    return sorted((p, m) for p, m in out if p.endswith(suffix) and not p.rpartition("/")[2].startswith(("_", ".")))


def first_line(spark: SparkSession, path: str, most: int = 1 << 20) -> str:
    """The first line of a file, read by itself."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        data = b""
        while b"\n" not in data and len(data) < most:
            more = bytes(stream.readNBytes(8192))
            if not more:
                break
            data += more
    finally:
        stream.close()
    return data.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r")


def land_csv(spark: SparkSession, paths: list[str], contract: list[str], separator: str = ";") -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """(rows of all files that keep the contract, (file, reason) of each that does not).

    Each file is judged by its own header: a missing or repeated column refuses that file alone, columns may stand in any order, extra ones are dropped.
    Files with the same header are one scan. All columns are text; bytes that are no UTF-8 become U+FFFD and ``lossy`` tells
    which rows had some; ``arquivo`` is the file. Files without any line are refused."""
    with ThreadPoolExecutor(16) as pool:  # one short read a file
        lines = list(pool.map(lambda p: first_line(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    refused: list[tuple[str, str]] = []
    for path, line in zip(paths, lines):
        names = tuple(header(c) for c in next(csv.reader([line], delimiter=separator), []))
        missing = [c for c in contract if c not in names]
        double = [c for c in contract if names.count(c) > 1]
        if missing or double:
            refused.append((path, "; ".join([*(f"falta {c}" for c in missing), *(f"repete {c}" for c in double)])))
        else:
            groups.setdefault(names, []).append(path)
    out = None
    for names, members in groups.items():
        # names of our own: extra columns may be called anything
        schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
        raw = spark.read.csv(members, schema=schema, sep=separator, header=True, enforceSchema=True, encoding="UTF-8", escape='"')
        lossy = F.lit(False)
        for c in contract:
            lossy = lossy | F.coalesce(F.contains(F.col(f"c{names.index(c)}"), F.lit("\ufffd")), F.lit(False))
        rows = raw.select(*(F.col(f"c{names.index(c)}").alias(c) for c in contract), lossy.alias("lossy"), F.col("_metadata.file_name").alias("arquivo"))
        out = rows if out is None else out.unionByName(rows)
    return out, refused


def read_contract_csv(spark: SparkSession, path: str, contract: list[str], separator: str = ";") -> DataFrame:
    """All files below ``path``, each by its own header; any file that breaks the contract is an error."""
    rows, refused = land_csv(spark, [p for p, _ in list_files(spark, path)], contract, separator)
    if refused or rows is None:
        raise ContractError("; ".join(f"{p}: {why}" for p, why in refused) or f"{path}: no file")
    return rows.drop("arquivo")


#: where the files of a load shape lie below the root
SHAPES = {"semanal": "semana-*.csv", "mensal": "mensal"}


def land(spark: SparkSession, root: str, contract: list[str], table: str, done: set[str] = frozenset()) -> tuple[list[str], list[tuple[str, str]]]:
    """One run of the landing driver: (load keys written, files refused).

    Weekly files lie in the root, monthly ones anywhere below ``mensal``. A file's load key is its name and its date in the name or, without one,
    of its last change (``name#ref=yyyy-MM-dd``); keys in ``done`` are skipped. A key's rows replace what was loaded under it before: the table is
    partitioned by it and only those partitions are written."""
    found = [f for shape in SHAPES.values() if list_exists(spark, f"{root}/{shape}") for f in list_files(spark, f"{root}/{shape}", ".csv")]
    keys: dict[str, str] = {}
    for path, changed in found:
        name = path.rpartition("/")[2]
        m = re.search(r"(\d{4})-?(\d{2})-?(\d{2})", name)
        day = "-".join(m.groups()) if m else datetime.fromtimestamp(changed / 1000, timezone.utc).date().isoformat()
        if (key := f"{name}#ref={day}") not in done:
            keys[path] = key
    rows, refused = land_csv(spark, list(keys), contract)
    bad = {p for p, _ in refused}
    loaded = {p.rpartition("/")[2]: k for p, k in keys.items() if p not in bad}
    if rows is not None:
        names = spark.createDataFrame(sorted(loaded.items()), "arquivo string, load_key string")
        replace_partitions(rows.join(names, "arquivo"), table, ["load_key"])
    return sorted(loaded.values()), refused


def list_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at))


def repair(row: list[str], width: int) -> list[str]:
    """Exactly ``width`` fields: short rows are padded, what is too much joins the last field."""
    return row + [""] * (width - len(row)) if len(row) <= width else [*row[: width - 1], " ".join(row[width - 1 :])]


def zip_rows(data, width: int, encoding: str = "latin-1", limit: int | None = None) -> Iterator[list[str]]:
    """Rows of all members of a ZIP, streamed: decompression stops at ``limit``. data: a path or a binary file object."""
    n = 0
    with zipfile.ZipFile(data) as z:
        for member in sorted(z.namelist()):
            with z.open(member) as f:
                for row in csv.reader(io.TextIOWrapper(f, encoding, newline=""), delimiter=";", quotechar='"'):
                    if limit is not None and n >= limit:
                        return
                    if row and any(x.strip() for x in row):
                        n += 1
                        yield repair(row, width)


def unzip(files: DataFrame, name: str, content: str, width: int, limit: int | None = None) -> DataFrame:
    """(arquivo, f0..) of ZIPs that are already a binary column (``binaryFile`` for instance). One ZIP is one task's work."""
    columns = [f"f{k}" for k in range(width)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, c in zip(b.iloc[:, 0], b.iloc[:, 1]):
                block: list = []
                for row in zip_rows(io.BytesIO(c), width, limit=limit):
                    block.append([n, *row])
                    if len(block) == 10_000:
                        yield pd.DataFrame(block, columns=["arquivo", *columns])
                        block = []
                if block:
                    yield pd.DataFrame(block, columns=["arquivo", *columns])

    return files.select(name, content).mapInPandas(run, "arquivo string, " + ", ".join(f"{c} string" for c in columns))


class _Zip(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ZipCsv(DataSource):
    """``spark.read.format("zipcsv")`` over a folder of ZIPs on a shared mount: one partition per ZIP, streamed, never extracted.

    Options: path, width (30), maxRows per ZIP, encoding (latin-1). Register with ``spark.dataSource.register(ZipCsv)``."""

    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("arquivo", T.StringType())] + [T.StructField(f"f{k}", T.StringType()) for k in range(int(self.options.get("width", 30)))])

    def reader(self, schema: T.StructType) -> "ZipReader":
        return ZipReader(self.options)


class ZipReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.width, self.limit, self.encoding = options["path"].removeprefix("file:"), int(options.get("width", 30)), options.get("maxRows"), options.get("encoding", "latin-1")

    def partitions(self):
        import glob
        import os

        found = sorted(glob.glob(os.path.join(self.path, "**", "*.zip"), recursive=True)) if os.path.isdir(self.path) else [self.path]
        return [_Zip(p) for p in found] or [_Zip("")]

    def read(self, partition):
        import os

        if partition.path:
            for row in zip_rows(partition.path, self.width, self.encoding, None if self.limit is None else int(self.limit)):
                yield (os.path.basename(partition.path), *row)


def entity_name(file: Column) -> Column:
    """'Estabelecimentos3.zip' -> 'estabelecimentos', 'DominioPais.zip' -> 'dominio_pais'"""
    stem = F.regexp_replace(F.regexp_replace(file, r"\.[A-Za-z]+$", ""), r"\d+$", "")
    return F.lower(F.regexp_replace(stem, r"(?<=[a-z0-9])(?=[A-Z])", "_"))


def no_nul(df: DataFrame) -> DataFrame:
    """NUL characters out of all text columns."""
    return df.select(*(F.translate(f.name, "\x00", "").alias(f.name) if isinstance(f.dataType, T.StringType) else f.name for f in df.schema))


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Only the partitions that ``df`` has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not there yet, one per key."""
    return rows.dropDuplicates(keys).join(target.select(*keys).distinct(), keys, "left_anti")


def pending_files(listed: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Files still to be read: resume by anti join instead of renames."""
    return listed.select(key).distinct() if force else listed.select(key).distinct().join(done.select(key).distinct(), key, "left_anti")


def links(html: Column, heading: str) -> Column:
    """Link targets that follow a heading, up to the next one."""
    part = F.regexp_extract(html, rf"(?is)<h[1-6][^>]*>\s*{heading}\s*</h[1-6]>(.*?)(?:<h[1-6]|$)", 1)
    return F.regexp_extract_all(part, F.lit(r"""(?i)<a\s[^>]*href=["']([^"']+)["']"""), F.lit(1))


def log_lines(lines: DataFrame, column: str) -> DataFrame:
    """JSON envelope -> message -> JSON payload with level, event and time; lines of another shape give nulls."""
    outer = F.from_json(column, "struct<stream:string,log:string>")
    inner = F.regexp_extract(F.col("o.log"), r"^\S+ (\{.*\})\s*$", 1)
    return lines.select("*", outer.alias("o")).select("*", F.from_json(inner, "struct<level:string,event:string,ts:string>").alias("p")).select(*lines.columns, F.col("o.stream").alias("stream"), F.col("p.level").alias("level"), F.col("p.event").alias("event"), F.try_to_timestamp(F.col("p.ts")).alias("ts"))


def metric_labels(metric: Column) -> list[Column]:
    """'airflow.task.<dag>.<task>.duration' -> labels."""
    pattern = r"^(\w+)\.task\.([\w-]+)\.([\w-]+)\.(\w+)$"
    return [F.regexp_extract(metric, pattern, k).alias(n) for k, n in ((1, "sistema"), (2, "dag"), (3, "tarefa"), (4, "medida"))]
