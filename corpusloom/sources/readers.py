"""Scans: text, XML, PDF, YAML and JSON documents, and the sinks beside them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..model.schemas import schema


def ingest(spark: SparkSession, path: str, source_type: str, ocr: Callable | None = None, threshold: float = 0.75) -> DataFrame:
    """(path, text, word_count, page_count, ...) of files of one source type; an unknown type is an error."""
    if source_type == "txt":
        return read_text(spark, path)
    if source_type in ("tei-xml", "oracc-atf"):
        return read_tei(spark, path)
    if source_type == "digital-pdf":
        return read_pdf(spark, path)
    if source_type == "scanned-pdf":
        return ocr_report(read_scanned(spark, path, ocr), threshold)
    raise ValueError(f"unknown source type {source_type}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as UTF-8, bad bytes replaced."""
    b = _decode(spark.read.format("binaryFile").load(path))
    return b.withColumn("word_count", word_count(F.col("text"))).withColumn("page_count", F.lit(1))


def _decode(files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "text": [bytes(c).decode("utf-8", "replace") for c in pdf["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, text string")


def read_tei(spark: SparkSession, path: str) -> DataFrame:
    """Text of line, paragraph and segment elements, each with its tag and number; nested ones come twice, as they are tagged."""
    import xml.etree.ElementTree as ET

    keep = ("l", "lb", "p", "seg")

    def parse(data: bytes) -> tuple[str, list[str]]:
        out, divs = [], []
        for e in ET.fromstring(data).iter():
            tag = e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""
            if tag == "div" and (e.get("n") or "").strip():
                divs.append(e.get("n").strip())
            text = "".join(e.itertext()).strip() if tag in keep else ""
            if text:
                n = e.get("n")
                out.append(f"[{tag.upper()} {n}] {text}" if n else f"[{tag.upper()}] {text}")
        return "\n".join(out), list(dict.fromkeys(divs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [parse(bytes(c)) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "text": [g[0] for g in got], "divisions": [g[1] for g in got]})

    b = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string, divisions array<string>")
    return b.withColumn("word_count", word_count(F.col("text"))).withColumn("page_count", F.lit(1))


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """Text layer page by page with page marks; needs the optional PDF library on the workers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError as e:
            raise RuntimeError("reading PDF files needs PyMuPDF") from e
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                with fitz.open(stream=bytes(c), filetype="pdf") as doc:
                    pages = [f"[PAGE {i}]\n{x.get_text('text')}" for i, x in enumerate(doc, 1)]
                rows.append((p, "\n\n".join(pages), len(pages)))
            yield pd.DataFrame(rows, columns=["path", "text", "page_count"])

    b = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, text string, page_count int")
    return b.withColumn("word_count", word_count(F.col("text")))


def read_scanned(spark: SparkSession, path: str, ocr: Callable[[bytes], list[tuple[str, list[float]]]] | None) -> DataFrame:
    """(path, page_no, text, confidences) by an injected recogniser: bytes to (text, word confidences) a page."""
    if ocr is None:
        raise RuntimeError("scanned files need a recogniser")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, i, t, c) for p, x in zip(pdf["path"], pdf["content"]) for i, (t, c) in enumerate(ocr(bytes(x)), 1)]
            yield pd.DataFrame(rows, columns=["path", "page_no", "text", "confidences"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, page_no int, text string, confidences array<double>")


def ocr_report(pages: DataFrame, threshold: float = 0.75) -> DataFrame:
    """One row a file: joined text, words, mean and least page confidence, flagged pages.

    A page's confidence is the mean of its words' (-1 is none), over 100; no words give 0."""
    known = F.filter("confidences", lambda x: x != -1)
    conf = F.when(F.size(known) == 0, 0.0).otherwise(F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known) / 100)
    p = pages.withColumn("confidence", conf)
    g = p.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("page_no", F.concat(F.lit("[PAGE "), "page_no", F.lit("]\n"), "text").alias("t")))).alias("x"), F.count("*").alias("page_count"),
        F.avg("confidence").alias("ocr_confidence_mean"), F.min("confidence").alias("ocr_confidence_min"), F.array_sort(F.collect_list(F.when(F.col("confidence") < threshold, F.col("page_no")))).alias("flagged_pages"),
    )
    return g.withColumn("text", F.array_join(F.transform("x", lambda s: s["t"]), "\n\n")).drop("x").withColumn("word_count", word_count(F.col("text")))


def concat_texts(parts: DataFrame) -> DataFrame:
    """(run_id, text): a run's text files in the order of their names, joined by blank lines."""
    g = parts.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("name", "text"))).alias("x"))
    return g.select("run_id", F.array_join(F.transform("x", lambda s: s["text"]), "\n\n").alias("text"))


def read_documents(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """YAML or JSON documents, one a file; a blank one gives nulls (one of no bytes is not scanned). YAML needs its optional library."""
    names = [f.name for f in spark.createDataFrame([], ddl).schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                raw = bytes(c).decode("utf-8", "replace")
                if p.endswith(".json"):
                    data = json.loads(raw) if raw.strip() else {}
                else:
                    import yaml

                    data = yaml.safe_load(raw) or {}
                rows.append((p, *(data.get(n) for n in names)))
            yield pd.DataFrame(rows, columns=["path", *names])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"path string, {ddl}")


def usable_vectors(df: DataFrame) -> DataFrame:
    """Embedding payloads in either shape (a bare array or an object with ``vector``); others are dropped; of one key the last path counts.

    ``df``: path, nas, payload (JSON text)."""
    bare, held = F.from_json("payload", "array<double>"), F.from_json("payload", "vector array<double>")
    v = F.when(F.startswith(F.trim("payload"), F.lit("[")), bare).otherwise(held["vector"])
    d = df.withColumn("vector", v).filter(F.col("vector").isNotNull() & (F.size("vector") > 0))
    return d.groupBy("nas").agg(F.max_by("vector", "path").alias("vector"))


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A stored table under its explicit schema."""
    return spark.read.schema(schema(name)).parquet(path)


def write_table(df: DataFrame, path: str, name: str | None = None, overwrite: bool = True) -> None:
    """Parquet, partitioned by tradition (and track) where there is one; without ``overwrite`` what is there stays."""
    by = [c for c in ("tradition_id", "tradition", "track") if c in df.columns]
    df.write.mode("overwrite" if overwrite else "ignore").partitionBy(*by).parquet(path)


def write_text(df: DataFrame, path: str) -> None:
    """One text column, a line a row."""
    df.select("text").write.mode("overwrite").text(path)
