"""The few file-system questions that DataFrame readers cannot answer, for any Hadoop path."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, hadoop_path = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(hadoop_path) or []))


def modified_at(spark: SparkSession, path: str) -> int:
    """Modification time in milliseconds since the epoch."""
    fs, hadoop_path = _open(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Make a small text file, which is there at once and whole, or not at all."""
    fs, hidden = _open(spark, f"{folder}/_{name}")
    out = fs.create(hidden, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    rename(spark, f"{folder}/_{name}", f"{folder}/{name}")


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file that is not blank; what comes after it is not read."""
    jvm = spark.sparkContext._jvm
    fs, hadoop_path = _open(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    reader = jvm.java.io.BufferedReader(
        jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
    )
    try:
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        reader.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.setTimes(hadoop_path, millis, -1)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _open(spark, source)
    target_path = _open(spark, target)[1]
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot rename {source} to {target}")


def literal(path: str) -> str:
    """``path`` spelled so that readers do not take its characters for a glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def complete_versions(spark: SparkSession, root: str, label: str) -> list[int]:
    """Numbers N for which the folder ``<label>=N`` under ``root`` was written to its end."""
    found = glob(spark, f"{root}/{label}=*/_SUCCESS")
    return sorted(int(p.split("/")[-2].split("=", 1)[1]) for p in found)
