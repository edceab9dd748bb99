"""Image folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (blue, green, red bytes): path, height, width, channels, data.

    Files that are no image keep their path, with -1 as sizes and empty data; see failed_images.
    """
    return (
        spark.read.format("image")
        .load(path)
        .selectExpr(
            "image.origin AS path",
            "image.height AS height",
            "image.width AS width",
            "image.nChannels AS channels",
            "image.data AS data",
        )
    )


def failed_images(images: DataFrame) -> DataFrame:
    """Paths of files that could not be decoded."""
    return images.filter("height < 0").select("path")
