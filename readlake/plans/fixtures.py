"""Sequencing-shaped views of the given tables, in expressions that Spark and DuckDB share."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROW = (
    "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT), "
    "CAST(round(l_extendedprice * 100) AS BIGINT), l_returnflag, l_linestatus)"
)
_SPAN = "CAST(20 + l_quantity AS BIGINT)"
#: Positions begin here, so that the edge of a tile (2 x 2^20) lies in the middle of every chromosome's 50,000.
_FROM = 2_072_153

#: What the two engines write differently: a global replacement, and a row for each tile of 100 letters.
_TILES = "greatest(1, CAST(floor((length(letters) + 99) / 100) AS BIGINT))"
SPARK = {"{g}": "", "{tiles}": f"explode(sequence(CAST(0 AS BIGINT), {_TILES} - 1))"}
DUCKDB = {"{g}": ", 'g'", "{tiles}": f"unnest(range({_TILES}))"}

#: name: (table, expressions of one or more projections)
FIXTURES: dict[str, tuple] = {
    "fx_targets": (
        "part",
        [
            "p_partkey AS target_id",
            "concat('chr', CAST(1 + p_partkey % 5 AS STRING)) AS chr",
            f"CAST({_FROM} + (p_partkey * 911) % 50000 AS BIGINT) AS start_pos",
            f"CAST({_FROM} + (p_partkey * 911) % 50000 + p_size * 4 AS BIGINT) AS end_pos",
        ],
    ),
    "fx_alignments": (
        "lineitem",
        [
            f"md5({_ROW}) AS read_id",
            "l_orderkey AS qname",
            "concat('chr', CAST(1 + l_suppkey % 5 AS STRING)) AS chr",
            f"CAST({_FROM} + (l_partkey * 37 + l_orderkey * 13) % 50000 AS BIGINT) AS pos",
            f"{_SPAN} AS span",
            f"CASE l_linenumber % 3 WHEN 0 THEN concat(CAST({_SPAN} AS STRING), 'M') "
            "WHEN 1 THEN concat('10M2D', CAST(CAST(8 + l_quantity AS BIGINT) AS STRING), 'M') "
            f"ELSE concat('5S', CAST({_SPAN} AS STRING), 'M') END AS cigar",
            "CAST(round(l_discount * 600) AS INT) AS mapq",
            "CAST((CASE WHEN l_returnflag = 'R' THEN 1024 ELSE 0 END) + (CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END)"
            " + (CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END) + (CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END) AS INT) AS flags",
        ],
    ),
    # every letter of every text, in reads of 100; an empty text is one empty read
    "fx_reads": (
        "documents",
        [
            "doc_id",
            "source AS file_name",
            "translate(regexp_replace(lower(text), '[^a-z]', ''{g}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS letters",
        ],
        ["doc_id", "file_name", "letters", "{tiles} AS tile"],
        [
            "doc_id * 100000 + tile AS read_id",
            "file_name",
            "substr(letters, CAST(tile * 100 + 1 AS INT), 100) AS seq",
        ],
    ),
    "fx_letters": (
        "documents",
        [
            "doc_id",
            "translate(regexp_replace(lower(text), '[^a-z]', ''{g}), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS letters",
        ],
    ),
    "fx_variants": (
        "orders",
        [
            "o_orderkey AS variant_id",
            "concat('file', CAST(o_custkey % 3 AS STRING)) AS file_name",
            "concat('chr', CAST(1 + o_orderkey % 5 AS STRING)) AS chr",
            f"CAST({_FROM} + (o_custkey * 997) % 50000 AS BIGINT) AS pos",
            "substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref",
            "substr('ACGT', CAST(1 + (o_orderkey + 1 + o_custkey % 3) % 4 AS INT), 1) AS alt",
            "o_totalprice / 1000 AS qual",
            "CASE WHEN o_orderpriority = '5-LOW' THEN 'LowQual' ELSE 'PASS' END AS filter",
            "concat('DP=', CAST(1 + o_custkey % 90 AS STRING), ';AF=', "
            "CASE o_orderstatus WHEN 'F' THEN '1.00' WHEN 'O' THEN '0.50' ELSE '0.33' END) AS info",
            "CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN 'STOP_GAINED' WHEN 1 THEN 'NON_SYNONYMOUS_CODING' WHEN 2 THEN 'SPLICE_SITE' "
            "WHEN 3 THEN 'SYNONYMOUS_CODING' WHEN 4 THEN 'INTRONIC' WHEN 5 THEN 'UPSTREAM' ELSE 'INTERGENIC' END AS effect",
        ],
    ),
    "fx_known_snps": (
        "customer",
        [
            "concat('rs', CAST(c_custkey AS STRING)) AS rs",
            "concat('chr', CAST(1 + c_custkey % 5 AS STRING)) AS chr",
            f"CAST({_FROM} + (c_custkey * 997) % 50000 AS BIGINT) AS pos",
            "CASE WHEN c_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS hgmd",
            "CASE WHEN c_custkey % 3 = 0 THEN 'KGPilot123;VLD' ELSE 'VLD' END AS flags",
            "CASE WHEN c_custkey % 2 = 0 THEN CAST((c_custkey * 997) % 50000 AS DOUBLE) / 1000 END AS centimorgan",
        ],
    ),
    "fx_status_log": (
        "events",
        [
            "event_id",
            "user_id AS rid",
            "CAST(ts AS TIMESTAMP) AS stamp",
            "CASE event_type WHEN 'signup' THEN 'RUN_COMPLETED' WHEN 'view' THEN 'OFFLOADING_STARTED' WHEN 'click' THEN 'OFFLOADING_DONE' "
            "WHEN 'purchase' THEN 'PROCESSING_DONE' ELSE 'QC_REPORT_FAILED' END AS status",
        ],
    ),
    "fx_files": (
        "supplier",
        [
            "s_suppkey AS fid",
            "CAST(s_suppkey % 7 AS BIGINT) AS rid",
            "s_nationkey AS sid",
            "CAST(1 + s_suppkey % 8 AS INT) AS lane",
            "CAST(1000 + abs(floor(s_acctbal)) AS BIGINT) AS total_reads",
            "CAST(50 + s_suppkey % 50 AS INT) AS read_length",
            "CAST(60 + (s_suppkey * 7) % 40 AS DOUBLE) AS q30_bases",
            "CAST((s_suppkey * 3) % 15 AS DOUBLE) AS duplicates",
        ],
    ),
    "fx_barcodes": (
        "nation",
        [
            "n_nationkey AS sample_id",
            "concat(substr('ACGT', CAST(1 + n_nationkey % 4 AS INT), 1), substr('ACGT', CAST(1 + floor(n_nationkey / 4) % 4 AS INT), 1), "
            "substr('ACGT', CAST(1 + floor(n_nationkey / 16) % 4 AS INT), 1)) AS barcode",
        ],
    ),
}


_SWAP = np.zeros(256, np.uint8)
_SWAP[ord("a") : ord("z") + 1] = np.frombuffer(b"ACGTACGTACGTACGTACGTACGTAC", np.uint8)


def swapped(text: Column) -> Column:
    """The letters of FIXTURES: a-z of the lower-cased text as ACGT, all else left out; null for null.

    One look-up for each byte, where a pattern and translate() look at each character; bytes of longer characters are none of a-z.
    """

    @F.arrow_udf("string")
    def letters(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.string())
        own = texts.cast(pa.string()).fill_null("")
        bounds = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1]
        codes = _SWAP[np.frombuffer(own.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]]
        starts, some = (bounds - bounds[0])[:-1], bounds[1:] > bounds[:-1]
        n = np.zeros(len(own) + 1, np.int64)
        n[1:][some] = np.add.reduceat(codes > 0, starts[some], dtype=np.int64) if some.any() else 0
        out = pa.StringArray.from_buffers(len(own), pa.py_buffer(np.cumsum(n).astype(np.int32)), pa.py_buffer(codes[codes > 0]))
        return pc.if_else(texts.is_valid(), out, pa.scalar(None, pa.string()))

    return letters(F.lower(text))


#: For Spark, in place of the first projection.
FIRST = {"fx_reads": lambda df: df.select("doc_id", F.col("source").alias("file_name"), swapped(F.col("text")).alias("letters"))}

#: For Spark, in place of the last projections: a text is cut in one pass, where substr would walk and copy it for each piece.
CUT = {
    "fx_reads": [
        [
            "doc_id",
            "file_name",
            "posexplode(CASE WHEN letters IS NULL THEN array(CAST(NULL AS STRING)) WHEN letters = '' THEN array('') "
            "ELSE regexp_extract_all(letters, '.{1,100}', 0) END) AS (tile, seq)",
        ],
        ["doc_id * 100000 + tile AS read_id", "file_name", "seq"],
    ],
}

#: Views whose rows are multiplied by bases, nodes or entries: a table that lies in one row group would keep all that in one task.
SPREAD = {"fx_alignments", "fx_reads", "fx_targets", "fx_known_snps"}


def view(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A fixture view over the tables in `sf_dir`, or a table itself; without `spread` where what reads it deals its rows out anyway."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    table, *levels = FIXTURES[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    if spread and name in SPREAD:
        df = df.repartition(2 * spark.sparkContext.defaultParallelism)
    if name in FIRST:
        df, levels = FIRST[name](df), levels[1:]
    if name in CUT:
        levels[-len(CUT[name]) :] = CUT[name]
    for exprs in levels:
        df = df.selectExpr(*[_written(e, SPARK) for e in exprs])
    return df


def _written(expr: str, marks: dict[str, str]) -> str:
    for mark, text in marks.items():
        expr = expr.replace(mark, text)
    return expr


def with_views(sql: str) -> str:
    """`sql` for DuckDB with the fixture views that it names."""
    ctes = []
    for name, (table, *levels) in FIXTURES.items():
        if re.search(rf"\b{name}\b", sql):
            for exprs in levels:
                table = f"(SELECT {', '.join(_written(e, DUCKDB) for e in exprs)} FROM {table})"  # noqa: PLW2901
            ctes.append(f"{name} AS {table}")
    body = sql.strip()
    if not ctes:
        return body
    if m := re.match(r"(?i)WITH\s+(RECURSIVE\s+)?", body):
        return f"WITH {m[1] or ''}" + ", ".join(ctes) + ", " + body[m.end() :]
    return "WITH " + ", ".join(ctes) + " " + body
