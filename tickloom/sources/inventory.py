"""Listing of delivered files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LISTING = "path string, modificationTime timestamp, length long"


def list_files(spark: SparkSession, folder: str, string_prefix: bool = False) -> DataFrame:
    """Path, modification time and length of every file below ``folder``; no content is read.

    With ``string_prefix`` the folder name is only a prefix, as object stores list it: ``2025/1``
    then also finds ``2025/10``. A folder that does not exist lists no files.
    """
    pattern = f"{folder}*" if string_prefix else folder
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTING)
    return files.select("path", "modificationTime", "length")
