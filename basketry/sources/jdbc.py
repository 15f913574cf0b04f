"""JDBC tables (SRC3, SRC4, SNK2/SNK3 for databases).

The reference reads every table on a single JDBC partition.  Here a scan plans
itself: counts that the database makes in a few passes cut the range of a key
column (number, timestamp or text; the primary key unless one is named) into
parts of about equal size, and every part is one predicate, read by one task.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas

#: Borders counted in one pass, passes, and the longest prefix of a text key.
CUTS, PASSES, PREFIX = 64, 4, 12


def _reader(spark: SparkSession, url: str, table: str, properties: dict | None):
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def _literal(v) -> str:
    if isinstance(v, dt.datetime):
        return f"{{ts '{v:%Y-%m-%d %H:%M:%S.%f}'}}"      # the JDBC escape for a timestamp
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def primary_key(spark: SparkSession, url: str, table: str, properties: dict | None = None) -> str | None:
    """First column of the table's primary key, as the database reports it."""
    def ask(conn):
        for name in (table, table.upper(), table.lower()):
            rows = conn.getMetaData().getPrimaryKeys(None, None, name)
            found = {}
            while rows.next():
                found[rows.getInt("KEY_SEQ")] = rows.getString("COLUMN_NAME")
            if found:
                return found[min(found)]
        return None
    return _connected(spark, url, properties, ask)


def text_types(spark: SparkSession, url: str, table: str, columns: list[str], properties: dict | None = None) -> str | None:
    """``col VARCHAR(n), ...`` for the text columns, as the table declares them: a
    staging table of the same types can be compared with it."""
    def ask(conn):
        for name in (table, table.upper(), table.lower()):
            rows = conn.getMetaData().getColumns(None, None, name, None)
            found = {}
            while rows.next():
                if "CHAR" in rows.getString("TYPE_NAME").upper():
                    found[rows.getString("COLUMN_NAME").lower()] = rows.getInt("COLUMN_SIZE")
            if found:
                return found
        return {}
    sizes = _connected(spark, url, properties, ask)
    return ", ".join(f"{c} VARCHAR({sizes[c.lower()]})" for c in columns if c.lower() in sizes) or None


def _middles(lo, hi, n: int) -> list:
    """Up to n - 1 values between two numbers or times, evenly spaced."""
    if isinstance(lo, dt.datetime):
        return [lo + (hi - lo) * k / n for k in range(1, n)]
    if isinstance(lo, int):
        return sorted({lo + (hi - lo) * k // n for k in range(1, n)} - {lo})
    return [lo + (hi - lo) * k / n for k in range(1, n)]


def _counted(spark, url, table, column, properties, borders: list) -> list[int]:
    """Rows below each border, in one pass of the database."""
    out = []
    for a in range(0, len(borders), CUTS):
        sums = ", ".join(f"SUM(CASE WHEN {column} < {_literal(b)} THEN 1 ELSE 0 END) AS c{k}" for k, b in enumerate(borders[a:a + CUTS]))
        row = _reader(spark, url, f"(SELECT {sums} FROM {table}) q", properties).load().first()
        out += [int(x or 0) for x in row]
    return out


def _ordered_borders(spark, url, table, column, properties, lo, hi, total: int, parts: int) -> list[tuple[object, int]]:
    """(border, rows below) fine enough that few parts exceed their share."""
    known = {}
    wide = [(lo, hi)]
    for _ in range(PASSES):
        new = sorted({m for a, b in wide for m in _middles(a, b, max(2, CUTS // len(wide)))} - set(known) - {lo})
        if not new:
            break
        known |= dict(zip(new, _counted(spark, url, table, column, properties, new), strict=True))
        at = [(lo, 0), *sorted(known.items()), (hi, total)]
        steps = sorted(((m - n, a, b) for (a, n), (b, m) in zip(at, at[1:], strict=False) if a != b), reverse=True)
        wide = [(a, b) for n, a, b in steps[:CUTS // 2] if n > total / parts / 4]
        if not wide:
            break
    return sorted(known.items())


def _text_borders(spark, url, table, column, properties, total: int, parts: int) -> list[tuple[str, int]]:
    """The same from the counts of prefixes; frequent prefixes are taken longer."""
    heavy, counts = [""], {}
    for length in range(1, PREFIX + 1):
        among = " OR ".join(f"SUBSTR({column}, 1, {length - 1}) = {_literal(h)}" for h in heavy) if length > 1 else "1 = 1"
        q = (f"(SELECT p, COUNT(*) AS n FROM (SELECT SUBSTR({column}, 1, {length}) AS p FROM {table} "
             f"WHERE {column} IS NOT NULL AND ({among})) s GROUP BY p) q")
        found = {r[0]: int(r[1]) for r in _reader(spark, url, q, properties).load().collect()}
        counts = {p: n for p, n in counts.items() if p not in heavy or len(p) < length - 1} | found
        heavy = [p for p, n in found.items() if len(p) == length and n > total / parts / 4][:4 * parts]
        if not heavy:
            break
    out, below = [], 0
    for p in sorted(counts):
        out.append((p, below))
        below += counts[p]
    return out


def plan_scan(spark: SparkSession, url: str, table: str, column: str, parts: int,
              properties: dict | None = None) -> list[str]:
    """Predicates that split the table into at most ``parts`` parts of about equal
    size; together they hold every row once, those without a key in the first.
    Text borders follow code points, so the column's collation must do so, too."""
    kind = next(f.dataType for f in _reader(spark, url, table, properties).load().schema if f.name.lower() == column.lower())
    low = _reader(spark, url, f"(SELECT MIN({column}) AS a, MAX({column}) AS b, COUNT({column}) AS n FROM {table}) q", properties).load().first()
    total = int(low[2])
    if parts < 2 or total < 2 or low[0] == low[1]:
        return ["1 = 1"]
    if isinstance(kind, T.StringType):
        borders = _text_borders(spark, url, table, column, properties, total, parts)
    else:
        lo, hi = (int(x) if isinstance(x, decimal.Decimal) and x == x.to_integral_value() else float(x) if isinstance(x, decimal.Decimal) else x for x in low[:2])
        borders = _ordered_borders(spark, url, table, column, properties, lo, hi, total, parts)
    cuts = []
    for k in range(1, parts):
        best = min(borders, key=lambda b: abs(b[1] - total * k / parts), default=None)
        if best is not None and 0 < best[1] < total and (not cuts or best[1] > cuts[-1][1]):
            cuts.append(best)
    names = [_literal(c) for c, _ in cuts]
    if not names:
        return ["1 = 1"]
    return [f"{column} < {names[0]} OR {column} IS NULL",
            *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(names, names[1:], strict=False)), f"{column} >= {names[-1]}"]


def read_table(spark: SparkSession, url: str, table: str, *,
               properties: dict | None = None,
               partition_column: str | None = None,
               lower_bound=None, upper_bound=None,
               num_partitions: int | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """A table (or ``(SELECT ...) q``).  With ``num_partitions`` alone the scan plans
    its parts itself (:func:`plan_scan`), over ``partition_column`` or the primary
    key; with bounds it takes equal steps between them."""
    if num_partitions and (lower_bound is None or upper_bound is None):
        column = partition_column or primary_key(spark, url, table, properties)
        if column is None:
            raise ValueError(f"{table} has no primary key: name a partition_column")
        parts = plan_scan(spark, url, table, column, num_partitions, properties)
        return spark.read.jdbc(url, table, predicates=parts,
                               properties={k: str(v) for k, v in (properties or {}).items()} | {"fetchsize": str(fetch_size)})
    r = _reader(spark, url, table, properties).option("fetchsize", str(fetch_size))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs num_partitions")
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound))
              .option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions)))
    return r.load()


def read_typed(spark: SparkSession, url: str, name: str, table: str | None = None, *, num_partitions: int = 8,
               properties: dict | None = None, partition_column: str | None = None) -> DataFrame:
    """SRC4: a database table in the schema registered as ``name`` (``orders_raw``,
    ...): its columns by name whatever their case, cast to the registered types."""
    df = read_table(spark, url, table or name, properties=properties, num_partitions=num_partitions, partition_column=partition_column)
    have = {c.lower(): c for c in df.columns}
    schema = schemas.TABLES[name][0]
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{table or name} lacks {', '.join(missing)}")
    return df.select(*[F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) for f in schema])


def write_table(df: DataFrame, url: str, table: str, mode: str = "append", *,
                properties: dict | None = None, truncate: bool = False,
                batch_size: int = 10_000) -> None:
    """Append, or replace in place (``mode='overwrite', truncate=True``)."""
    w = (df.write.format("jdbc").mode(mode)
         .option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    if truncate:
        w = w.option("truncate", "true")
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def _connected(spark: SparkSession, url: str, properties: dict | None, use):
    """``use(connection)`` from the driver, in one transaction."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k != "driver":
            props.setProperty(k, str(v))
    if properties and properties.get("driver"):
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        out = use(conn)
        conn.commit()
        return out
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def execute(spark: SparkSession, url: str, statements: list[str],
            properties: dict | None = None) -> None:
    """Run DDL/DML on the database from the driver (one connection, one
    transaction); used for table creation and the merge step of an upsert."""
    def run(conn):
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
    _connected(spark, url, properties, run)


def merge_sql(table: str, staging: str, keys: list[str], cols: list[str]) -> str:
    # Spark's JDBC writer creates the staging columns quoted (exact case);
    # the target's columns are referenced unquoted (the database's folding).
    on = " AND ".join(f't.{k} = s."{k}"' for k in keys)
    upd = ", ".join(f'{c} = s."{c}"' for c in cols if c not in keys)
    ins_cols = ", ".join(cols)
    ins_vals = ", ".join(f's."{c}"' for c in cols)
    return (f"MERGE INTO {table} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {upd} "
            f"WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})")


def upsert(df: DataFrame, url: str, table: str, keys: list[str], batch_id: int, *,
           properties: dict | None = None, column_types: str | None = None) -> None:
    """SNK2 for databases: write the batch to a staging table in parallel,
    then one MERGE on the keys.  Re-running a batch re-applies the same
    values, so retries are idempotent."""
    staging = f"{table}_stage_{int(batch_id)}"
    column_types = column_types or text_types(df.sparkSession, url, table, df.columns, properties)
    w = (df.write.format("jdbc").mode("overwrite")
         .option("url", url).option("dbtable", staging))
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
    execute(spark=df.sparkSession, url=url, properties=properties, statements=[
        merge_sql(table, staging, keys, df.columns), f"DROP TABLE {staging}"])
