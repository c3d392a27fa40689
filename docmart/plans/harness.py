"""Views over the given tables with the shapes that the operators work on, for Spark and, as SQL, for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
#: name -> (query, SQL or None)
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL if SQL can express it."""

    def keep(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


FACT = """
SELECT p_partkey AS doc_id, concat(p_name, ' Fund') AS fund, p_brand, p_size, p_type,
  concat('Inception Date ', lpad(cast(1 + p_partkey % 28 AS varchar(2)), 2, '0'), '-0', cast(1 + p_size % 9 AS varchar(2)), '-2015',
  ' Benchmark ', p_brand, ' TRI', ' Entry Load Nil Exit Load ', cast(p_size AS varchar(9)), '% within 365 days',
  ' Minimum Amount Rs.', cast(p_size * 100 AS varchar(9)), ' and multiples of ', cast(1 + p_size % 5 AS varchar(9)),
  ' Turnover ', cast(p_size % 7 AS varchar(9)), '.5 times Average Maturity ', cast(p_size AS varchar(9)), ' days EOL') AS text
FROM part"""

SPANS = """
SELECT l_orderkey AS doc_id, 1 + l_linenumber % 3 AS page, l_linenumber AS block_no,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS span_no,
  cast(p_size AS double) AS size, p_name AS text, p_size % 4 AS color, p_brand AS font,
  cast(l_quantity AS double) AS x, cast(round(l_discount * 1000 + l_tax * 100) AS double) AS y
FROM lineitem JOIN part ON l_partkey = p_partkey"""

TURNS = """
SELECT conv_id AS doc_id, turn AS ord, role = 'user' AS is_header, role <> 'user' AS is_body, text FROM conversations"""

#: Ten orders make a document, whose odd rows are its second table, so that documents grow in number and not in size.
CELLS = """
SELECT doc_id, row_no % 2 AS table_no, cast(row_no / 2 AS int) AS row_no, col_no,
  CASE col_no WHEN 0 THEN CASE WHEN row_no % 4 > 1 THEN NULL ELSE p_name END WHEN 1 THEN CASE WHEN row_no % 7 = 0 THEN NULL ELSE p_brand END
    WHEN 2 THEN cast(p_size AS varchar(9)) ELSE NULL END AS text
FROM (SELECT cast(floor(l_orderkey / 10) AS bigint) AS doc_id, p_name, p_brand, p_size,
        row_number() OVER (PARTITION BY cast(floor(l_orderkey / 10) AS bigint) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_no
      FROM lineitem JOIN part ON l_partkey = p_partkey) a
CROSS JOIN (SELECT 0 AS col_no UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) b"""


def view(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """A harness view in Spark; ``varchar(n)`` is a string there."""
    import re

    for name in ("part", "lineitem", "conversations"):
        table(spark, d, name).createOrReplaceTempView(name)
    return spark.sql(re.sub(r"varchar\(\d+\)", "string", sql).replace("cast(row_no / 2 AS int)", "cast(floor(row_no / 2) AS int)"))


CELLS_DUCK = CELLS.replace("cast(row_no / 2 AS int)", "cast(floor(row_no / 2) AS int)")
