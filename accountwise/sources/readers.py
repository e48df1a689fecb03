"""Reading tables: files (Parquet first, CSV second), catalog tables, JDBC tables, raw CSV loads."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwise.config import NULL_TOKENS
from accountwise.session import cut_lineage, run_dir
from accountwise.sources.schemas import ENTITY_TABLES, LOGICAL_NAME, NAMESPACES, RAW

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def safe_identifier(name: str, allowed: Iterable[str]) -> str:
    """Lower-cased name if it is a plain identifier and on the allow-list."""
    plain = name.strip()
    if not _IDENTIFIER.fullmatch(plain):
        raise ValueError(f"not an identifier: {name!r}")
    lowered = plain.lower()
    if lowered not in {a.lower() for a in allowed}:
        raise ValueError(f"not allowed: {name!r}")
    return lowered


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def without_tokens(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~F.trim(col).isin(*tokens), col)


def _coerce(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast that turns what does not fit into NULL. Text dates may carry a time part."""
    if have == want:
        return col
    if isinstance(want, T.DateType) and isinstance(have, T.StringType):
        return F.coalesce(col.try_cast("date"), col.try_cast("timestamp_ntz").try_cast("date"))
    return col.try_cast(want)


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in schema order, coerced; columns the source lacks are NULL."""
    have = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (_coerce(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name)
        for f in schema
    ])


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header, every column text: no inference pass over the data."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=False, inferSchema=False)


def read_files(spark: SparkSession, folder: str, name: str, fmt: str = "auto") -> DataFrame:
    """One table of a folder, typed. Parquet if present, else CSV, else FileNotFoundError."""
    readers = {
        "parquet": lambda: spark.read.parquet(f"{folder}/{name}.parquet"),
        "csv": lambda: _clean_text(read_csv_text(spark, f"{folder}/{name}.csv")),
    }
    for kind in ("parquet", "csv") if fmt == "auto" else (fmt,):
        try:
            return coerce(readers[kind](), schema_of(RAW[name]))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"neither Parquet nor CSV for {name} in {folder}")


def _clean_text(df: DataFrame) -> DataFrame:
    return df.select(*[without_tokens(F.col(c)).alias(c) for c in df.columns])


def load_tables(
    spark: SparkSession, folder: str, fmt: str = "auto", names: Sequence[str] = ENTITY_TABLES,
    optional: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """The entity tables by logical name; a missing optional table is left out, any other one is an error."""
    out = {}
    for name in names:
        try:
            out[LOGICAL_NAME[name]] = read_files(spark, folder, name, fmt)
        except FileNotFoundError:
            if name not in optional:
                raise
    return out


def read_catalog_tables(
    spark: SparkSession, namespace: str = "staging", names: Sequence[str] = ENTITY_TABLES,
    label_namespace: str = "features", prefix: str = "",
) -> dict[str, DataFrame]:
    """Catalog tables with lower-case columns. Labels always come from their own namespace.

    ``prefix`` is put before the namespace (for example ``prod_``); filters on the result are pushed down.
    """
    space, labels = safe_identifier(namespace, NAMESPACES), safe_identifier(label_namespace, NAMESPACES)
    if prefix and not _IDENTIFIER.fullmatch(prefix):
        raise ValueError(f"not an identifier: {prefix!r}")
    out = {}
    for name in names:
        table = safe_identifier(name, RAW)
        where = labels if table == "clv_labels" else space
        df = lower_columns(spark.table(f"`{prefix}{where}`.`{table}`"))
        out[LOGICAL_NAME[table]] = coerce(df, schema_of(RAW[table]))
    return out


def read_jdbc_table(
    spark: SparkSession, url: str, namespace: str, name: str, partition_column: str | None = None,
    lower=None, upper=None, partitions: int = 1, options: dict | None = None,
) -> DataFrame:
    """A warehouse table over JDBC, split by a column; columns and filters are pushed down."""
    table = f"{safe_identifier(namespace, NAMESPACES)}.{safe_identifier(name, RAW)}"
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    if partition_column:
        column = safe_identifier(partition_column, schema_of(RAW[name.lower()]).fieldNames())
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=partitions
        )
    return lower_columns(reader.load())


#: How a line of a block ends up: a record of its own, or the part of one that the block's border cuts.
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_RECORDS = "file string, block long, kind int, first boolean, record string"


def _assembled(batches: Iterator[pa.RecordBatch], opened: set[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Records of lines that arrive in order, block by block. A line ends a record if its quotes so far are even in number."""
    at, parity, pending, begun = None, 0, [], False

    def closed(rest: list[str]) -> list[tuple]:
        # what is open at a block's end goes on in the next; a block without any end is part of a record throughout
        return [(*at, _HEAD if begun_open and not ended else _TAIL, False, "\n".join(rest))] if rest else []

    begun_open = ended = False
    for batch in batches:
        out = []
        for value, file, block in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (file, block) != at:
                if at:
                    out += closed(pending)
                at, pending = (file, block), []
                begun_open = at in opened
                parity, ended = int(begun_open), False
            pending.append(value)
            parity ^= value.count('"') & 1
            if not parity:
                kind = _HEAD if begun_open and not ended else _WHOLE
                out.append((file, block, kind, block == 0 and not ended, "\n".join(pending)))
                pending, ended = [], True
        yield _batch(out)
    if at:
        yield _batch(closed(pending))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of quoted CSV files, also those with line breaks in quotes, from splittable reads: file, first, record.

    ``first`` marks the first record of a file. A first look counts the quotes of every block of the input; a block that begins
    within quotes hands its first lines back to the record that the block before left open. Only such cut records are shuffled.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # blocks of one file
    inside = blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open")).where("open = 1")
    opened = {(r["file"], r["block"]) for r in inside.collect()}  # of the input's blocks those that begin within quotes
    parts = lines.mapInArrow(lambda batches: _assembled(batches, opened), _RECORDS)
    if not opened:
        return parts.select("file", "first", "record")
    parts = cut_lineage(parts)
    cut = parts.where(F.col("kind") != _WHOLE)
    order = Window.partitionBy("file").orderBy("block", "kind")
    chain = F.sum((F.col("kind") == _TAIL).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = cut.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))), lambda x: x["record"]), "\n").alias("record"))
    return parts.where(F.col("kind") == _WHOLE).select("file", "first", "record").unionByName(
        joined.select("file", F.lit(False).alias("first"), "record"))


@dataclass
class BulkLoad:
    good: DataFrame
    rejected: DataFrame
    counts: DataFrame


def bulk_load_raw(
    spark: SparkSession, path: str, schema: T.StructType, tokens: Sequence[str] = NULL_TOKENS
) -> BulkLoad:
    """Typed rows, rejected rows with the reason, and counts of both; the source is parsed once.

    Columns are matched by name. A row is rejected when it has the wrong number of cells or a cell that
    is neither a null token nor of its column's type; the load itself goes on. All files must have the same header. The
    parsed rows are stored, good and rejected ones in folders of their own; counts are observed while they are written.
    """
    header = spark.read.csv(path, header=True, quote='"', escape='"').columns
    cells = ", ".join([*(f"c{k} string" for k in range(len(header))), "corrupt string"])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    records = csv_records(spark, path).select("first", F.rtrim(F.col("record"), F.lit("\r")).alias("record"))
    records = records.where(F.trim("record") != "").withColumn("row", F.from_csv("record", cells, options))
    same = F.array(*[F.col(f"row.c{k}") for k in range(len(header))]) == F.array(*[F.lit(c) for c in header])
    checked_header = F.assert_true(~F.col("first") | same, F.lit(f"a file below {path} has another header")).isNull()
    raw = records.where(checked_header & ~F.col("first"))
    names = {c.strip().lower(): k for k, c in enumerate(header)}
    typed_cells, bad = [], []
    for f in schema:
        if f.name.lower() not in names:
            typed_cells.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        cell = without_tokens(F.col(f"row.c{names[f.name.lower()]}"), tokens)
        typed = _coerce(cell, T.StringType(), f.dataType)
        typed_cells.append(typed.alias(f.name))
        bad.append(F.when(cell.isNotNull() & typed.isNull(), F.lit(f.name)))
    reasons = F.filter(
        F.array(*bad, F.when(F.col("row.corrupt").isNotNull(), F.lit("wrong number of cells"))), lambda r: r.isNotNull()
    )
    line = F.to_json(F.struct(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(header)]))
    parsed = raw.select(*typed_cells, reasons.alias("_reasons"), line.alias("_line"))
    fine = F.size("_reasons") == 0
    seen = Observation("load")
    parsed = parsed.observe(seen, F.count_if(fine).alias("loaded"), F.count_if(~fine).alias("rejected"))
    stored = run_dir(spark, "load")
    parsed.select(
        *schema.fieldNames(), F.when(~fine, F.col("_line")).alias("_line"), F.when(~fine, F.array_join("_reasons", ",")).alias("_reason"),
        F.when(fine, "good").otherwise("rejected").alias("_part"),
    ).write.partitionBy("_part").parquet(stored)
    shape = T.StructType([*schema, T.StructField("_line", T.StringType()), T.StructField("_reason", T.StringType()),
                          T.StructField("_part", T.StringType())])
    whole = spark.read.schema(shape).parquet(stored)
    counts = spark.createDataFrame([(seen.get["loaded"], seen.get["rejected"])], "loaded long, rejected long")
    return BulkLoad(
        good=whole.where("_part = 'good'").select(*schema.fieldNames()),
        rejected=whole.where("_part = 'rejected'").select(F.col("_line").alias("line"), F.col("_reason").alias("reason")),
        counts=counts,
    )
