"""Table scans and sinks: Parquet (default), CSV exchange files, JDBC.

Scans are lazy and schema-declared; Catalyst prunes columns and pushes
filters into the Parquet reader for whatever the downstream plan uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCE_TABLES


def scan_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Full-table scan of one stored table (all columns, no predicate)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan_sources(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Lazy DataFrames for the nine source tables under ``root/<table>``, in
    ingest (foreign-key) order, each with its declared schema. ``fmt='csv'``
    reads header CSV exchange files (see ``extract_to_csv``)."""
    if fmt == "csv":
        return {name: read_csv_table(spark, f"{root}/{name}", spec.schema)
                for name, spec in SOURCE_TABLES.items()}
    return {name: scan_table(spark, f"{root}/{name}", spec.schema, fmt)
            for name, spec in SOURCE_TABLES.items()}


def extract_to_csv(sources: dict[str, DataFrame], out_root: str) -> dict[str, str]:
    """Extract step: write every source table as header CSV under
    ``out_root/<table>`` (the exchange format between extract and load)."""
    paths = {}
    for name, df in sources.items():
        paths[name] = f"{out_root}/{name}"
        write_csv_table(df, paths[name])
    return paths


# CSV options that keep quoted commas and quotes in one record.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Line breaks inside a text are written as two characters, so that a record is a line and
# a file can be split at any of them (fixed values: mark, then what stands for what).
MARK = "\\"
BREAKS = (("\n", "n"), ("\r", "r"))


def escape_lines(c) -> Column:
    """The text without line breaks; ``unescape_lines`` gives it back."""
    out = F.replace(F.col(c) if isinstance(c, str) else c, F.lit(MARK), F.lit(MARK + MARK))
    for char, letter in BREAKS:
        out = F.replace(out, F.lit(char), F.lit(MARK + letter))
    return out


def unescape_lines(c) -> Column:
    # A doubled mark goes first to a character that no text holds otherwise, and comes back last.
    aside = "\x00" + MARK + "\x00"
    out = F.replace(F.col(c) if isinstance(c, str) else c, F.lit(MARK + MARK), F.lit(aside))
    for char, letter in BREAKS:
        out = F.replace(out, F.lit(MARK + letter), F.lit(char))
    return F.replace(out, F.lit(aside), F.lit(MARK))


def _texts(schema: T.StructType, change) -> list[Column]:
    return [change(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   null_tokens: tuple[str, ...] = (), multi_line: bool = False,
                   escaped: bool = True) -> DataFrame:
    """Header CSV with a declared schema; empty fields read as NULL.

    Files of ``write_csv_table`` hold a record a line and are split among tasks. Files from
    elsewhere need ``escaped=False``, and ``multi_line=True`` where records run over lines:
    such a file is one task, so ask for files of bounded size.
    """
    df = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=multi_line).csv(path)
    if escaped:
        df = df.select(*_texts(schema, unescape_lines))
    if null_tokens:
        df = df.select(*_texts(schema, lambda c: F.when(F.col(c).isin(*null_tokens), F.lit(None)).otherwise(F.col(c))))
    return df


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite", escaped: bool = True,
                    max_rows: int | None = None) -> None:
    """Header CSV sink (no index column). Line breaks in texts are escaped, or with
    ``escaped=False`` quoted as they are, for readers that know no escapes; then
    ``max_rows`` bounds the rows of a file, which only one task can read."""
    out = df.select(*_texts(df.schema, escape_lines)) if escaped else df
    w = out.write.mode(mode).options(**CSV_OPTIONS)
    (w.option("maxRecordsPerFile", max_rows) if max_rows else w).csv(path)


def land_table(df: DataFrame, path: str) -> None:
    """Landing write: replaces the table's previous contents (truncate + append)."""
    df.write.mode("overwrite").parquet(path)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 partition_column: str | None = None, lower_bound: int | None = None,
                 upper_bound: int | None = None, num_partitions: int | None = None,
                 fetch_size: int = 10000) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``. A numeric partition column
    with bounds splits the scan into ``num_partitions`` parallel range
    queries instead of one single-connection read."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC scan needs lower/upper bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """Scan a database table (needs the JDBC driver jar on the classpath)."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def cut_query(table: str, column: str, parts: int) -> str:
    """SQL for the database: the values that cut ``column`` into ``parts`` ranges of about as
    many rows of ``table`` (a sample of it will do), in the database's own order of texts."""
    return (f"SELECT min({column}) AS cut FROM (SELECT {column}, ntile({parts}) OVER (ORDER BY {column}) AS part "
            f"FROM {table} WHERE {column} IS NOT NULL) ranged WHERE part > 1 GROUP BY part ORDER BY 1")


def range_predicates(column: str, cuts: list[str]) -> list[str]:
    """Conditions on a text column that no two rows' ranges share and that together every row
    meets: below the first cut, between neighbours, from the last one on, and NULL.
    ``cuts`` must ascend in the order that the database compares by (``cut_query``)."""
    cuts = list(dict.fromkeys(cuts))
    texts = ["'" + c.replace("'", "''") + "'" for c in cuts]
    if not texts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} < {texts[0]}", *inner, f"{column} >= {texts[-1]}", f"{column} IS NULL"]


def sample_cuts(df: DataFrame, column: str, parts: int, rows: int = 10_000) -> list[str]:
    """Range cuts from a sample: the ``rows`` rows (at most) whose keys hash lowest."""
    sample = df.select(column).filter(F.col(column).isNotNull()).orderBy(F.xxhash64(column)).limit(rows)
    sample.createOrReplaceTempView("starloom_cut_sample")
    return [r["cut"] for r in df.sparkSession.sql(cut_query("starloom_cut_sample", column, parts)).collect()]


def read_jdbc_ranges(spark: SparkSession, url: str, table: str, column: str, parts: int,
                     sample: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """Scan a database table whose key is text, with one query a range of the key. The cuts come
    from one more query, over ``sample`` (say ``(SELECT key FROM t TABLESAMPLE ...) s``) or
    the table itself."""
    props = properties or {}
    cuts = spark.read.jdbc(url, f"({cut_query(sample or table, column, parts)}) cuts", properties=props)
    found = [r[0] for r in cuts.collect()]  # one row a range
    return spark.read.jdbc(url, table, predicates=range_predicates(column, found), properties=props)


def scan_partitioned(df: DataFrame, column: str, parts: int) -> DataFrame:
    """The table as the union of its ranges, each planned as a scan of its own: what a
    partitioned database scan returns. Range conditions reach the files' statistics."""
    out = None
    for condition in range_predicates(column, sample_cuts(df, column, parts)):
        part = df.filter(F.expr(condition))
        out = part if out is None else out.unionByName(part)
    return out
