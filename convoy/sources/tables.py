"""Warehouse tables on disk: layout, staged writes and reconciled copies."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from convoy.operators.quality import bad_keys
from convoy.schemas import EVENT_TIMES, type_for_declared
from convoy.sources import files


#: Bits of a hash that are summed together; sums of fewer than 2^41 rows stay in 64 bits.
BITS = 22
#: SQL of a value's hash.
HASH = "xxhash64({})"


class LoadError(Exception):
    """A load or copy was refused; the target is as it was."""


@dataclass(frozen=True)
class View:
    """A stored table that is another one of its version, with some columns renamed. It takes no space."""

    of: str
    renamed: Mapping[str, str] = field(default_factory=dict)


def laid_out(df: DataFrame, table: str) -> DataFrame:
    """Facts get an event_date and are sorted by vehicle and time within it.

    Rebalancing cuts a date with too many rows into several files and joins small ones, from the sizes Spark measures.
    """
    at = EVENT_TIMES.get(table)
    if at is None:
        return df
    dated = df.withColumn("event_date", F.to_date(at))
    return dated.hint("rebalance", "event_date").sortWithinPartitions("event_date", "vehicle_id", at)


def write_table(df: DataFrame, path: str, table: str) -> None:
    writer = laid_out(df, table).write.mode("overwrite")
    if table in EVENT_TIMES:
        writer = writer.partitionBy("event_date")
    writer.parquet(path)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table or view of the newest committed version below root, or a table that lies there by itself."""
    commits = files.names(spark, f"{root}/_commits")
    version = files.read_text(spark, f"{root}/_commits/{commits[-1]}") if commits else None
    return _read(spark, f"{root}/_versions/{version}" if version else root, table)


def _read(spark: SparkSession, root: str, table: str) -> DataFrame:
    definition = f"{root}/_views/{table}"
    if not files.exists(spark, definition):
        return spark.read.parquet(f"{root}/{table}")
    view = View(**json.loads(files.read_text(spark, definition)))
    return _read(spark, root, view.of).withColumnsRenamed(dict(view.renamed))


def _commit(spark: SparkSession, root: str, version: str) -> None:
    """Make a version the one that is read, by one move of a small file, and drop all but it and the one before.

    Commits are numbered, and a move never replaces a file, so of two loads that end together one fails.
    """
    done = files.names(spark, f"{root}/_commits")
    number = int(done[-1]) + 1 if done else 1
    files.write_text(spark, f"{root}/_versions/{version}/_commit", version)
    files.move(spark, f"{root}/_versions/{version}/_commit", f"{root}/_commits/{number:010d}")
    for name in done[:-1]:
        old = files.read_text(spark, f"{root}/_commits/{name}")
        files.drop(spark, f"{root}/_commits/{name}")
        files.drop(spark, f"{root}/_versions/{old}")


def _write_as_is(df: DataFrame, path: str, table: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _stage(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | View],
    staging: str,
    write: Callable[[DataFrame, str, str], None],
) -> dict[str, int]:
    """Write all tables below the staging folder; the rows of each source are counted by a query of their own.

    A count taken while rows pass would count some of them twice where a lost executor's work is done again.
    """
    for table, df in tables.items():
        if isinstance(df, View):
            files.write_text(spark, f"{staging}/_views/{table}", json.dumps(asdict(df)))
        else:
            write(df, f"{staging}/{table}", table)
    counts = _rows({t: df for t, df in tables.items() if not isinstance(df, View)})
    return {t: counts[df.of if isinstance(df, View) else t] for t, df in tables.items()}


def _rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of all tables, counted by one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t, df in tables.items()]
    return {row["table"]: row["rows"] for row in reduce(DataFrame.unionByName, counts).collect()} if counts else {}


def _reconcile(spark: SparkSession, staging: str, counts: Mapping[str, int]) -> None:
    """Compare the counts with those that the footers of the written files carry."""
    written = _rows({table: _read(spark, staging, table) for table in counts})
    for table, rows in counts.items():
        if written[table] != rows:
            raise LoadError(f"{table}: {rows} rows read, {written[table]} written")


def fingerprints(df: DataFrame, hashed: str = HASH, whole: bool = True) -> DataFrame:
    """A row per column, and if ``whole`` one named ``*`` for whole rows, as (column, rows, filled, fingerprint decimal).

    The fingerprint is the sum of the 64-bit hashes of all values but NULL, so the order of rows is of no account, and a value
    that changes, moves to another row or repeats changes it. ``hashed`` is the SQL of a value's hash. The hashes are summed in
    three parts, which keeps the work per row in 64-bit additions.
    """
    names = [f"`{name.replace('`', '``')}`" for name in df.columns]
    values = df.selectExpr(*[f"if({n} IS NULL, NULL, {hashed.replace('{}', n)}) AS h{i}" for i, n in enumerate(names)])
    if whole:
        values = values.selectExpr("*", f"{_row_hash([f'h{i}' for i in range(len(names))], hashed)} AS h{len(names)}")
    columns = [*df.columns, "*"] if whole else df.columns
    sums = ["count(1) AS rows"]
    for i in range(len(columns)):
        sums += [f"{value} AS {name}" for name, value in _sums(i, f"h{i}").items()]
    rows = []
    for i, name in enumerate(columns):
        total = " + ".join(f"CAST(s{j}_{i} AS DECIMAL(20, 0)) * CAST({1 << j * BITS} AS DECIMAL(14, 0))" for j in range(3))
        text = name.replace("\\", "\\\\").replace("'", "\\'")
        rows.append(f"struct('{text}' AS column, rows, n{i} AS filled, CAST({total} AS DECIMAL(38, 0)) AS fingerprint)")
    return values.selectExpr(*sums).selectExpr(f"inline(array({', '.join(rows)}))")


def _row_hash(hashes: list[str], hashed: str = HASH) -> str:
    texts = ", ".join(f"coalesce(CAST({h} AS STRING), '-')" for h in hashes)
    return hashed.replace("{}", f"concat_ws('|', {texts})")


def _sums(i: int, value: str) -> dict[str, str]:
    """The number of values of column i and the sums of the three parts of their hashes."""
    low = (1 << BITS) - 1
    pieces = (f"{value} & {low}", f"shiftrightunsigned({value}, {BITS}) & {low}", f"shiftrightunsigned({value}, {2 * BITS})")
    return {f"n{i}": f"count({value})", **{f"s{j}_{i}": f"coalesce(sum({piece}), 0)" for j, piece in enumerate(pieces)}}


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and, once it has been written, the sums that ``fingerprints`` makes its rows from.

    They are taken where rows go to their files, with no shuffle behind: Spark counts the figures of such a task once, also where
    it runs again, so they are as exact as those of a query of their own, and the tables are not joined again for them.
    """
    seen = Observation()
    hashes = [f"if({n} IS NULL, NULL, {HASH.replace('{}', n)})" for n in (f"`{name.replace('`', '``')}`" for name in df.columns)]
    sums = {"rows": "count(1)"}
    for i, value in enumerate([*hashes, _row_hash(hashes)]):
        sums |= _sums(i, value)
    return df.observe(seen, *[F.expr(value).alias(name) for name, value in sums.items()]), seen


def _compare(spark: SparkSession, staging: str, read: Mapping[str, Mapping[str, int]]) -> None:
    """Refuse a copy that holds other rows or values than were read, by their sums."""
    for table, sums in read.items():
        copy = _read(spark, staging, table)
        found = {r["column"]: r for r in fingerprints(copy).collect()}
        rows = found["*"]["rows"]
        if rows != sums["rows"]:
            raise LoadError(f"{table}: {sums['rows']} rows read, {rows} written")
        wrong = []
        for i, name in enumerate([*copy.columns, "*"]):
            total = sum(sums[f"s{j}_{i}"] << j * BITS for j in range(3))
            if (found[name]["filled"], int(found[name]["fingerprint"])) != (sums[f"n{i}"], total):
                wrong.append(name)
        if wrong:
            raise LoadError(f"{table}: other values written than read in {', '.join(sorted(wrong))}")


def _promote(spark: SparkSession, staging: str, root: str, tables: Mapping[str, DataFrame]) -> None:
    for table in tables:
        files.drop(spark, f"{root}/{table}")
        files.move(spark, f"{staging}/{table}", f"{root}/{table}")


def _check_keys(spark: SparkSession, staging: str, keys: Mapping[str, str]) -> None:
    """Look for wrong keys in all staged tables by one job, which reads the key columns only."""
    parts = [
        bad_keys(_read(spark, staging, table), key).limit(5).select(F.lit(table).alias("table"), F.col("key").cast("string"))
        for table, key in keys.items()
    ]
    wrong = reduce(DataFrame.unionByName, parts).collect() if parts else []
    if wrong:
        table = wrong[0]["table"]
        examples = [row["key"] for row in wrong if row["table"] == table]
        raise LoadError(f"{table}.{keys[table]} missing or repeated, e.g. {examples}")


def rebuild_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame | View], root: str, keys: Mapping[str, str]
) -> dict[str, int]:
    """Replace the tables and views below root. A missing or repeated business key stops the load before anything is replaced.

    All tables are written as a new version and checked; keys are checked on the staged files, where only the key column is
    read. Readers see the old version until the new one is committed, so a load that fails anywhere changes nothing.
    """
    version = uuid.uuid4().hex
    staging = f"{root}/_versions/{version}"
    try:
        counts = _stage(spark, tables, staging, write_table)
        _reconcile(spark, staging, counts)
        _check_keys(spark, staging, {table: key for table, key in keys.items() if table in tables})
        _commit(spark, root, version)
    except BaseException:
        commits = files.names(spark, f"{root}/_commits")
        if not commits or files.read_text(spark, f"{root}/_commits/{commits[-1]}") != version:
            files.drop(spark, staging)
        raise
    return counts


def as_declared(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Columns cast to the types that another store declares for them; a value that does not fit stops the copy."""
    return df.withColumns({name: F.col(name).cast(type_for_declared(kind)) for name, kind in declared.items()})


def copy_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    declared: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, int]:
    """Copy tables to a place that must not hold any of them yet; all arrive, with equal rows and values, or none.

    ``declared`` gives the column types of another store, by table, to which values are cast on the way. Rows are written as
    they are read, without a shuffle, and each table is computed once: its rows are counted and fingerprinted on their way, and
    the written ones are read back and compared.
    """
    taken = [t for t in tables if files.exists(spark, f"{root}/{t}")]
    if taken:
        raise LoadError(f"already there, nothing was changed: {', '.join(taken)}")
    tables = {t: as_declared(df, (declared or {}).get(t, {})) for t, df in tables.items()}
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    try:
        read = {}
        for table, df in tables.items():
            df, seen = _observed(df)
            _write_as_is(df, f"{staging}/{table}", table)
            read[table] = seen.get
        _compare(spark, staging, read)
        try:
            _promote(spark, staging, root, tables)
        except Exception:
            for table in tables:
                files.drop(spark, f"{root}/{table}")
            raise
        return {table: sums["rows"] for table, sums in read.items()}
    finally:
        files.drop(spark, staging)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_rows: int = 2000) -> None:
    """Copy one table into a database; refuses a table that exists. Needs the database's driver on the cluster."""
    options = {**properties, "batchsize": str(batch_rows)}
    df.write.mode("errorifexists").jdbc(url, table, properties=options)


def publish_views(views: Mapping[str, DataFrame]) -> None:
    """Make DataFrames available to SQL, replacing views of the same name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
