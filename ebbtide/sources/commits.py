"""Files that exist once: of several writers of one name, one succeeds."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def jvm_path(spark: SparkSession, path: str):
    """The path and its file system, as the session's Hadoop configuration sees them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def created(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the file was created; False if another writer was first. Local file systems check and create in two steps, so
    there the operating system's own exclusive creation is used."""
    place, system = jvm_path(spark, path)
    if system.getScheme() == "file":
        system.mkdirs(place.getParent())
        try:
            with open(unquote(urlparse(place.toUri().toString()).path), "x", encoding="utf-8") as file:
                file.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = system.create(place, False)
    except Py4JJavaError as error:
        if system.exists(place):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True
