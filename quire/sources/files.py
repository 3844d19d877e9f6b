"""Files as tables: listing, format, decoding, paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import paragraphs

# Formats by file suffix.
FORMATS = {
    ".txt": "txt",
    ".doc": "doc",
    ".docx": "docx",
    ".docm": "docm",
    ".rtf": "rtf",
    ".pdf": "pdf",
    ".png": "image",
    ".jpg": "image",
    ".jpeg": "image",
    ".tif": "image",
    ".tiff": "image",
    ".webp": "image",
    ".bmp": "image",
}


def read(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, modificationTime, length, content of all files below ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def waybill_files(spark: SparkSession, path: str) -> DataFrame:
    """PDF files below a folder, in order of path."""
    return read(spark, path, "*.[pP][dD][fF]").orderBy("path")


def suffix(path: Column) -> Column:
    name = F.regexp_extract(path, r"[^/\\]*$", 0)
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))


def detect_format(path: Column, strict: bool = False) -> Column:
    """The format of a file by its suffix; unknown: null, or an error if ``strict``."""
    s = suffix(path)
    out = F.lit(None).cast("string")
    for k, v in FORMATS.items():
        out = F.when(s == k, v).otherwise(out)
    if strict:
        return F.when(out.isNull(), F.raise_error(F.concat(F.lit("unsupported format: "), path)).cast("string")).otherwise(out)
    return out


# Code points of bytes 0x80 to 0xFF in Windows-1251; 0x98 is undefined.
_CP1251 = bytes(b for b in range(0x80, 0x100) if b != 0x98).decode("cp1251")
_LATIN1 = bytes(b for b in range(0x80, 0x100) if b != 0x98).decode("latin-1")


def decode_text(content: Column) -> Column:
    """Text of a file: by its byte order mark, else UTF-8 if valid, else Windows-1251; null if none fits."""
    start = F.hex(F.substring(content, 1, 3))
    utf8 = F.substring(content, F.lit(4), F.octet_length(content))
    utf16 = F.substring(content, F.lit(3), F.octet_length(content))
    western = F.decode(content, "ISO-8859-1")
    return (
        F.when(start == "EFBBBF", F.when(F.is_valid_utf8(utf8.cast("string")), F.decode(utf8, "UTF-8")))
        .when(start.startswith("FFFE"), F.decode(utf16, "UTF-16LE"))
        .when(start.startswith("FEFF"), F.decode(utf16, "UTF-16BE"))
        .when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
        .when(~western.contains("\u0098"), F.translate(western, _LATIN1, _CP1251))
    )


def text_files(files: DataFrame) -> DataFrame:
    """path, markdown, error of text files; one bad file leaves an error, never a failed job."""
    text = decode_text(F.col("content"))
    rows = files.filter(detect_format(F.col("path")) == "txt").withColumn("text", text)
    return rows.select(
        "path", paragraphs(F.col("text")).alias("markdown"), F.when(F.col("text").isNull(), "undecodable").alias("error")
    )
