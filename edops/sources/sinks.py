"""Writers: tables, CSV exports, JSON documents, and the checks after a write.

What replaces a folder is written aside and moved into its place, so a write that fails
leaves the old folder as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, functions as F

from edops.operators.bi import assert_contract, manifest, secret_rows
from edops.schemas import IN_FILE_ORDER, ONE_DAY_PER_RUN, TABLE_LAYOUT
from edops.sources import folders

RANK_BITS, RANK_SAMPLE = 6, 10_000


def _save(writer: DataFrameWriter, spark: SparkSession, path: str, save: Callable[[DataFrameWriter, str], None]) -> None:
    """Write aside, then take the place of what is there."""
    aside = folders.aside_of(path)
    try:
        save(writer.mode("errorifexists"), aside)
        folders.replace_whole(spark, aside, path)
    finally:
        folders.delete(spark, aside)


def write_table(df: DataFrame, path: str, replace: bool = False) -> None:
    """Parquet table; without ``replace`` an existing table is protected."""
    if replace:
        _save(df.write, df.sparkSession, path, DataFrameWriter.parquet)
    else:
        df.write.mode("errorifexists").parquet(path)


@dataclass(frozen=True)
class Written:
    """Rows of a written table and a digest of their content that no order changes."""

    rows: int
    digest: tuple[Decimal, Decimal]


def content_digest(df: DataFrame) -> list[Column]:
    """Two sums of row hashes: equal for equal multisets of rows, in any order and partitioning.

    Nulls are hashed by their place, so a value that moves to another column counts as changed.
    """
    cells = [F.struct(F.col(f"`{c.replace('`', '``')}`").isNull(), F.col(f"`{c.replace('`', '``')}`")) for c in df.columns]
    hashes = [F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).alias(f"digest_{i}") for i, h in enumerate(hashes)]


def write_digested(df: DataFrame, path: str, replace: bool = False) -> Written:
    """Write a Parquet table and take its rows and digest on the way, without a second pass."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *content_digest(df)), path, replace)
    got = seen.get
    return Written(got["rows"], (Decimal(got["digest_0"]), Decimal(got["digest_1"])))


def write_laid_out(df: DataFrame, path: str, table: str, replace: bool = False, files: int | None = None) -> None:
    """Parquet table partitioned by day and clustered by its filter columns.

    With several filter columns the rows are dealt by range of a key that interleaves the
    ranks of all of them, so that a file holds a narrow range of each; a hash of the row cuts
    a key that holds many rows. ``files`` is the number of ranges; by default it follows the
    size of the rows. The bounds are drawn from the rows first, so ``df`` should be stored.
    Raw records stay as they come: a task reads file after file, so the rows of a year and a
    file lie together and in the order of their lines, and no row of 2.4 KB is sorted.
    """
    day, cluster = TABLE_LAYOUT[table]
    out = df.withColumn("partition_date", F.to_date(day)) if day else df
    dated = ["partition_date"] if day else []
    if len(cluster) > 1 and table not in IN_FILE_ORDER:
        parts = [files] if files else []
        keyed = out.withColumn("_cluster", interleaved(df, cluster))
        # The hash of the row only cuts a key, so it is not moved with the row.
        ranged = keyed.repartitionByRange(*parts, *dated, "_cluster", F.xxhash64(*df.columns))
        out = ranged.sortWithinPartitions(*dated, "_cluster", *cluster).drop("_cluster")
    elif table not in IN_FILE_ORDER:
        if day and day not in ONE_DAY_PER_RUN:
            # Few files per day, but a large day is split over several tasks and files.
            out = out.hint("rebalance", "partition_date")
        if dated or cluster:
            out = out.sortWithinPartitions(*dated, *cluster)
    writer = out.write.mode("overwrite" if replace else "errorifexists")
    if table in IN_FILE_ORDER:  # wide text, mostly blanks
        writer = writer.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "1"})
    (writer.partitionBy("partition_date") if day else writer).parquet(path)


def interleaved(df: DataFrame, columns: list[str], bits: int = RANK_BITS, sample: int = RANK_SAMPLE) -> Column:
    """A space-filling key: the bits of the columns' ranks in turn, the highest bits first.

    A rank is the number of bounds, taken from a sample of about ``sample`` rows, that the
    value reaches; rows of one bound share a rank, and nulls have the lowest. The sample
    moves rows between files only, and no other column is read for it.
    """
    rows, ranked = df.count(), df.select(*columns)
    drawn = (ranked.sample(sample / rows, seed=1) if rows > sample else ranked).collect()
    ranks = []
    for column in columns:
        values = sorted(r[column] for r in drawn if r[column] is not None)
        # Of few distinct values every one is a bound; of many, the quantiles of the sample.
        kinds, most = sorted(set(values)), (1 << bits) - 1
        bounds = kinds if len(kinds) <= most else sorted({values[len(values) * i // most] for i in range(most)})
        spread = (1 << bits) // (len(bounds) + 1)  # the highest bits tell few bounds apart as well
        ranks.append(F.when(F.col(column).isNull(), 0).otherwise(_rank(F.col(column), bounds, 0, spread)))
    key = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for rank in ranks:
            key = key * 2 + F.shiftright(rank, bit).bitwiseAND(1)
    return key


def _rank(value: Column, bounds: list, below: int, spread: int) -> Column:
    """``spread`` times the number of sorted bounds that the value reaches, by halving."""
    if not bounds:
        return F.lit(below * spread)
    middle = len(bounds) // 2
    lower = _rank(value, bounds[:middle], below, spread)
    return F.when(value < F.lit(bounds[middle]), lower).otherwise(
        _rank(value, bounds[middle + 1 :], below + middle + 1, spread)
    )


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", replace: bool = True) -> int:
    """Write and return the number of rows, without a second pass."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite" if replace else "errorifexists").format(fmt).save(path)
    return seen.get["rows"]


def write_document(df: DataFrame, path: str) -> None:
    """One-row table as a JSON document."""
    _save(df.coalesce(1).write, df.sparkSession, path, DataFrameWriter.json)


def write_rows(df: DataFrame, path: str) -> None:
    """JSON lines in place of those before."""
    _save(df.write, df.sparkSession, path, DataFrameWriter.json)


def write_csv(df: DataFrame, path: str, order: list | None = None) -> int:
    """CSV folder with a header in every file; an empty table is an error.

    Small tables end up in one file because the sort's partitions are merged at run time.
    """
    seen = Observation()
    out = df.orderBy(*order) if order else df
    observed = out.observe(seen, F.count(F.lit(1)).alias("rows"))

    def save(writer: DataFrameWriter, aside: str) -> None:
        writer.option("header", True).csv(aside)
        if seen.get["rows"] == 0:
            raise ValueError(f"Export has no rows: {path}")

    _save(observed.write, df.sparkSession, path, save)
    return seen.get["rows"]


def load_plan(
    tables: dict[str, DataFrame], target: str, replace: bool, counted: DataFrame | None = None
) -> DataFrame:
    """What a load would do; nothing is written. ``counted`` is the manifest, if it is known."""
    return (manifest(tables) if counted is None else counted).select(
        "position",
        "table_name",
        "row_count",
        F.concat(F.lit(f"{target}/"), F.col("table_name")).alias("target"),
        F.lit("replace" if replace else "create only").alias("mode"),
    )


def save_table(df: DataFrame, name: str, replace: bool = False) -> None:
    """Catalog table; without ``replace`` an existing table is protected."""
    df.write.mode("overwrite" if replace else "errorifexists").saveAsTable(name)


def publish(
    tables: dict[str, DataFrame],
    target: str,
    apply: bool = False,
    replace: bool = True,
    catalog: bool = False,
) -> DataFrame:
    """Plan, or load each table with its declared schema and reconcile it.

    ``target`` is a folder, or with ``catalog`` a database of the session's catalog.
    """
    for name, df in tables.items():
        assert_contract(df, name)
    if not apply:
        return load_plan(tables, target, replace)
    written = {}
    for name, df in tables.items():
        if catalog:
            save_table(df, f"{target}.{name}", replace)
        else:
            written[name] = write_digested(df, f"{target}/{name}", replace)
    spark = next(iter(tables.values())).sparkSession
    return reconcile(spark, tables, target, catalog, written=written)


def reconcile(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    target: str,
    catalog: bool = False,
    counted: DataFrame | None = None,
    written: dict[str, Written] | None = None,
) -> DataFrame:
    """Stored columns, row counts and content next to the source's.

    ``counted`` and ``written`` are the source's manifest and what the write saw, if they are
    known; what is not known is computed from the source once more.
    """
    stored = {
        name: spark.table(f"{target}.{name}") if catalog else spark.read.parquet(f"{target}/{name}")
        for name in sources
    }
    written = written or {}
    if counted is None:
        counted = manifest(sources) if set(sources) - set(written) else _listed(spark, sources, written)
    right = _digested(stored).select(
        "table_name",
        F.col("columns").alias("stored_columns"),
        F.col("row_count").alias("stored_rows"),
        F.array("digest_0", "digest_1").alias("_stored"),
    )
    known = [(name, list(w.digest)) for name, w in written.items()]
    digests = spark.createDataFrame(known, "table_name string, _digest array<decimal(38,0)>")
    unknown = {name: df for name, df in sources.items() if name not in written}
    if unknown:
        digests = digests.union(_digested(unknown).select("table_name", F.array("digest_0", "digest_1")))
    same = F.col("columns") == F.col("stored_columns")
    same &= (F.col("row_count") == F.col("stored_rows")) & (F.col("_digest") == F.col("_stored"))
    joined = counted.join(right, "table_name").join(digests, "table_name")
    return joined.withColumn("matches", same).drop("_digest", "_stored")


def _listed(spark: SparkSession, sources: dict[str, DataFrame], written: dict[str, Written]) -> DataFrame:
    """The manifest of tables whose rows the write has counted."""
    rows = [(i, name, ",".join(df.columns), written[name].rows) for i, (name, df) in enumerate(sources.items())]
    return spark.createDataFrame(rows, "position int, table_name string, columns string, row_count long")


def _digested(tables: dict[str, DataFrame]) -> DataFrame:
    """Name, columns, rows and digest of each table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(df.columns)).alias("columns"),
            F.count(F.lit(1)).alias("row_count"),
            *content_digest(df),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def require_reconciled(checked: DataFrame) -> None:
    wrong = [row["table_name"] for row in checked.filter(~F.col("matches")).collect()]
    if wrong:
        raise ValueError(f"Loaded tables differ from their source: {wrong}")


def validate_export(spark: SparkSession, expected: DataFrame, folder: str) -> DataFrame:
    """Re-read exported CSVs: header, repeated headers, row count and secret markers."""
    rows = expected.select("position", "table_name", "columns", "row_count").collect()
    parts = []
    for row in rows:
        header = row["columns"].split(",")
        exported = spark.read.options(header=True, multiLine=True, escape='"').csv(
            f"{folder}/{row['table_name']}"
        )
        is_header = F.lit(True)
        for column in header:
            is_header = is_header & F.coalesce(F.col(f"`{column}`") == column, F.lit(False))
        if exported.columns != header:
            raise ValueError(f"Column mismatch in {row['table_name']}: {exported.columns}")
        parts.append(
            exported.agg(
                F.lit(row["table_name"]).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(is_header).alias("repeated_headers"),
                secret_rows(exported).alias("secret_rows"),
            ).withColumn("counts_match", F.col("row_count") == row["row_count"])
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn(
        "status",
        F.when(
            F.col("counts_match") & (F.col("repeated_headers") == 0) & (F.col("secret_rows") == 0),
            "PASS",
        ).otherwise("FAIL"),
    )
