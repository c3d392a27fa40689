"""Inventories of document files, scans of spans, records and text, and sinks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import normalize_whitespace, title_case

BLOCKS = "array<struct<type:int,lines:array<struct<spans:array<struct<size:double,text:string,color:int,x:double,y:double,font:string>>>>>>"
RECORD = (
    "fund string, amc_name string, main_scheme_name string, scheme_launch_date string, benchmark_index string, min_amt string, min_amt_multiple string, "
    "fund_manager array<struct<managing_fund_since:string,name:string,qualification:string,total_exp:string>>, "
    "load array<struct<comment:string,type:string>>, metrics array<struct<name:string,value:string>>"
)
DOCUMENT = f"metadata struct<document_name:string,file_type:string,process_date:string>, records array<struct<value:struct<{re.sub(r'(^|, )(\w+) ', r'\1\2:', RECORD)}>>>"


def work_folder(spark: SparkSession) -> str:
    """A new folder where driver and executors can all write: in ``spark.checkpoint.dir``; where that is not set, on a single machine only, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    return f"{base}/docmart-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder and read from there: what they are cannot change any more."""
    path = f"{work_folder(df.sparkSession)}/cut"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def list_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """Files below a folder as (path, mtime, length), without reading them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("modificationTime").alias("mtime"), "length")


def parse_name(path: Column) -> dict[str, Column]:
    """What a file's name says: doc_type, amc_id, passive, fund_key and title of the folder."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    before = F.try_element_at(parts, F.lit(-2))
    passive = F.when(F.length(before) == 1, before).otherwise("0")
    doc_type = F.element_at(parts, -1)
    return {
        "file_name": name,
        "doc_type": doc_type,
        "amc_id": F.element_at(parts, 1),
        "passive": passive,
        "fund_key": F.when(doc_type == "FS", F.concat_ws("_", F.element_at(parts, 1), passive)).otherwise(F.element_at(parts, 1)),
        "folder": F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit("")),
    }


def inventory(files: DataFrame, path: str = "path") -> DataFrame:
    """Documents by key: factsheets keep all files of a key, other kinds the last one."""
    rows = files.select(F.col(path).alias("path"), *[v.alias(k) for k, v in parse_name(F.col(path)).items()])
    got = rows.groupBy("doc_type", "fund_key").agg(F.array_sort(F.collect_list("path")).alias("all"), F.max("path").alias("last"))
    return got.select("doc_type", "fund_key", F.when(F.col("doc_type") == "FS", F.col("all")).otherwise(F.array("last")).alias("paths"))


def display_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Files with the title of their folder, marked when passive."""
    parts = parse_name(F.col(path))
    title = title_case(F.regexp_replace(parts["folder"], "[_-]+", " "))
    return files.select(F.col(path).alias("path"), F.concat(title, F.when(parts["passive"] != "0", F.lit(" Passive")).otherwise("")).alias("display_name"))


def folder_suffixes(files: DataFrame, path: str = "path") -> DataFrame:
    """The second and later files of a folder get _B, _C, …"""
    folder = F.regexp_replace(path, "/[^/]*$", "")
    n = F.row_number().over(Window.partitionBy("folder").orderBy("path"))
    rows = files.select(F.col(path).alias("path"), folder.alias("folder")).withColumn("n", n)
    return rows.select("path", "folder", F.when(F.col("n") == 1, F.col("folder")).otherwise(F.concat("folder", F.lit("_"), F.char(F.col("n") + 64))).alias("folder_key"))


def first_per_folder(files: DataFrame, path: str = "path") -> DataFrame:
    return files.groupBy(F.regexp_replace(path, "/[^/]*$", "").alias("folder")).agg(F.min(path).alias("path"))


def span_rows(docs: DataFrame, blocks: str = "blocks", by: Sequence[str] = ("doc_id", "page")) -> DataFrame:
    """Nested blocks as span rows: text blocks only, sizes rounded half to even, texts stripped, exact repeats dropped, order kept."""
    rows = docs.select(*by, F.posexplode(blocks).alias("block_no", "b")).where("b.type = 0")
    rows = rows.select(*by, "block_no", F.posexplode("b.lines").alias("line_no", "l")).select(*by, "block_no", "line_no", F.posexplode("l.spans").alias("span_no", "s"))
    rows = rows.select(*by, "block_no", "line_no", "span_no", F.bround("s.size").alias("size"), normalize_whitespace("s.text").alias("text"), "s.color", "s.x", "s.y", "s.font")
    same = Window.partitionBy(*by, "size", "text", "color", "x", "y", "font").orderBy("block_no", "line_no", "span_no")
    return rows.withColumn("_rn", F.row_number().over(same)).where("_rn = 1").drop("_rn")


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Output documents, one row for each record, with the file they came from; fields that drifted are read as they are."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", multi_line).json(path)
    return docs.select(F.input_file_name().alias("file"), "metadata.*", F.explode_outer("records").alias("r")).select("file", "document_name", "file_type", "process_date", "r.value.*")


def drifted_text(variant: Column) -> Column:
    """A text that may have been written as a list: its first item, else the text."""
    return F.coalesce(F.try_variant_get(variant, "$[0]", "string"), F.try_variant_get(variant, "$", "string"))


def term_set(spark: SparkSession, path: str, column: str = "indexes") -> DataFrame:
    """The distinct terms of a sheet's column."""
    return spark.read.option("header", True).csv(path).select(F.trim(column).alias("term")).where("term <> ''").distinct()


def page_lines(pages: DataFrame, by: Sequence[str], text: str = "text") -> DataFrame:
    """Lines of each page's text, numbered from 1."""
    return pages.select(*by, F.posexplode(F.split(text, "\n")).alias("pos", "line")).select(*by, (F.col("pos") + 1).alias("line_no"), "line")


def page_blocks(spans: DataFrame, pages: Sequence[int], by: Sequence[str] = ("doc_id",), joined: bool = True) -> DataFrame:
    """Texts of some pages from the top left, blanks collapsed, empty ones dropped; joined, or as a list."""
    rows = spans.where(F.col("page").isin(*pages)).withColumn("_t", normalize_whitespace("text")).where("_t <> ''")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page", "y", "x", "span_no", "_t"))), lambda r: r["_t"])
    return rows.groupBy(*by).agg((F.array_join(texts, " ") if joined else texts).alias("text"))


def sheet_name(c: Column) -> Column:
    """A name that a workbook accepts: no reserved characters, 31 characters at most."""
    return F.substring(F.regexp_replace(c, r"[\[\]:*?/\\]", "_"), 1, 31)


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document for each source file, in a folder of its name."""
    rows = documents.withColumn("document", F.col("metadata.document_name"))
    rows.repartition("document").write.mode("overwrite").partitionBy("document").json(path)


def write_sheets(rows: DataFrame, name: str, path: str) -> None:
    """One tabular file for each document or fund house."""
    rows.withColumn("sheet", sheet_name(F.col(name))).repartition("sheet").write.mode("overwrite").partitionBy("sheet").option("header", True).csv(path)


def append_ledger(processed: DataFrame, path: str) -> None:
    """Append (run, file_name, path, status) rows."""
    processed.select("run", "file_name", "path", "status").write.mode("append").parquet(path)


def jdbc_options(spark: SparkSession, table: str, more: dict[str, str] | None = None) -> dict[str, str]:
    """Connection options from the session's configuration and those given, which come first; none are kept in code, and what is not set is left out."""
    conf = {k: spark.conf.get(f"spark.docmart.jdbc.{k}", "") for k in ("url", "user", "password", "driver")}
    return {k: v for k, v in conf.items() if v} | (more or {}) | {"dbtable": table}


def write_mart(rows: DataFrame, table: str, mode: str = "append", options: dict[str, str] | None = None) -> None:
    rows.write.format("jdbc").options(**jdbc_options(rows.sparkSession, table, options)).mode(mode).save()


def read_mart_table(spark: SparkSession, table: str, column: str | None = None, lower: int = 0, upper: int = 0, parts: int = 1, options: dict[str, str] | None = None) -> DataFrame:
    """A mart table; with a numeric column and its range, read in parts."""
    reader = spark.read.format("jdbc").options(**jdbc_options(spark, table, options))
    if column:
        reader = reader.options(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts))
    return reader.load()
