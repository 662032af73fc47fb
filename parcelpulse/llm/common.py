"""Helpers shared by the operators: table access, batches of texts, token vocabularies."""

from __future__ import annotations

import atexit
import base64
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 512
#: Characters handed to a tokenizer at once.
BATCH_CHARS = 1 << 19
#: Entries a worker's memo of words may hold before it is started anew.
MEMO_WORDS = 300_000


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package where they would not find it by themselves."""
    home = Path(__file__).resolve().parents[2]
    found = {Path(p or ".").resolve() for p in ["", *os.environ.get("PYTHONPATH", "").split(os.pathsep)]}
    context = spark.sparkContext
    if home in found or any(str(f).endswith("/parcelpulse.zip") for f in context.listFiles):
        return
    folder = tempfile.mkdtemp(prefix="parcelpulse-code-")  # of the driver, which serves the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/parcelpulse", "zip", home, "parcelpulse"))


def prepare(spark: SparkSession) -> None:
    """Settings of a session that runs these operators."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def runs_of(texts: list[str], most: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together; a longer text comes alone."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def rank_table(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def binary_column(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
