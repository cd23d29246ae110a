"""JSON-lines files, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: most lines one file may hold after re-chunking.
LINES_PER_FILE = 50_000


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def with_position(lines: DataFrame) -> DataFrame:
    """Replace the split offset by the place of the line in its file.

    Call it before any shuffle. The row number only has to rise within a split;
    the split offset orders the splits of a file, so the pair orders its lines.
    """
    place = F.struct("block", F.monotonically_increasing_id().alias("row"))
    return lines.withColumn("pos", place).drop("block")


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str = "*.json") -> DataFrame:
    """One row per line with its file and its position in the file."""
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return with_position(_with_origin(reader.text(paths)))


def stream_lines(
    spark: SparkSession, path: str, pattern: str = "*.json", files_per_trigger: int | None = None
) -> DataFrame:
    """Lines with file and split offset as a stream over a landing
    folder; :func:`with_position` completes a micro-batch of it."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _with_origin(reader.text(path))


def rechunk_lines(lines: DataFrame, path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """K3: write lines as files of at most ``lines_per_file`` lines.

    Needs no shuffle: every task cuts its own part.
    """
    lines.select("value").write.mode("overwrite").option("maxRecordsPerFile", lines_per_file).text(path)
