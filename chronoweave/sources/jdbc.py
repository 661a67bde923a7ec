"""Relational sources over JDBC (Oracle, MySQL, SQL Server, or any URL).

The tag columns and the inclusive time range are applied as DataFrame operations; Spark's
JDBC source pushes both into the database query, and the identifier quoting is done by
Spark's dialect for the URL (Oracle double quotes, MySQL backticks, ...).  With
``num_partitions`` > 1 the scan is split on the time column into parallel range queries.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, NumericType, TimestampNTZType, TimestampType

from chronoweave.operators._util import c
from chronoweave.operators.filters import time_range_filter

# URL shapes and driver classes of the supported database kinds.
URL_TEMPLATES = {
    "ORACLE": "jdbc:oracle:thin:@//{host}:{port}/{database}",
    "MYSQL": "jdbc:mysql://{host}:{port}/{database}",
    "SQLSERVER": "jdbc:sqlserver://{host}:{port};DatabaseName={database}",
}
DRIVERS = {
    "ORACLE": "oracle.jdbc.driver.OracleDriver",
    "MYSQL": "com.mysql.jdbc.Driver",
    "SQLSERVER": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
}


@dataclass(frozen=True)
class Connection:
    """A connection row: kind, host, port, database, user, password (or a full ``url``)."""

    kind: str
    host: str = ""
    port: str = ""
    database: str = ""
    user: str | None = None
    password: str | None = None
    url: str | None = None
    driver: str | None = None

    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        try:
            return URL_TEMPLATES[self.kind].format(host=self.host, port=self.port, database=self.database)
        except KeyError:
            raise ValueError(f"unknown database kind {self.kind!r}; known: {sorted(URL_TEMPLATES)}") from None

    def options(self) -> dict[str, str]:
        opts = {"url": self.jdbc_url()}
        drv = self.driver or DRIVERS.get(self.kind)
        if drv:
            opts["driver"] = drv
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        return opts

    @staticmethod
    def from_row(row: Mapping[str, str]) -> "Connection":
        """From a source-manage row (dstype, dsip, dsport, dsexample, dsloginid, dspwd)."""
        return Connection(kind=str(row["dstype"]), host=str(row["dsip"]), port=str(row["dsport"]),
                          database=str(row["dsexample"]), user=row.get("dsloginid"), password=row.get("dspwd"))


#: How each database kind quotes a name (opening and closing mark).
QUOTES = {"ORACLE": ('"', '"'), "MYSQL": ("`", "`"), "SQLSERVER": ("[", "]")}


def quoted_table(kind: str, table: str) -> str:
    """A table name as the database wants it, each dotted part quoted (so lower-case or spaced
    names work); other kinds get the name as it is."""
    marks = QUOTES.get(kind.upper())
    if marks is None:
        return table
    return ".".join(f"{marks[0]}{part.replace(marks[1], marks[1] * 2)}{marks[1]}" for part in table.split("."))


def range_options(time_column: str, time_type: DataType, start_s: int | None, finish_s: int | None,
                  num_partitions: int) -> dict[str, str]:
    """Options that split a scan into ``num_partitions`` range queries on the time column; none
    without both bounds, with one partition, or for a column that Spark can't split on."""
    if num_partitions <= 1 or start_s is None or finish_s is None or finish_s <= start_s:
        return {}
    if isinstance(time_type, NumericType):
        lower, upper = str(int(start_s)), str(int(finish_s) + 1)
    elif isinstance(time_type, (TimestampType, TimestampNTZType)):
        lower, upper = (datetime.fromtimestamp(s, timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for s in (start_s, finish_s + 1))
    else:
        return {}
    return {"partitionColumn": time_column, "lowerBound": lower, "upperBound": upper, "numPartitions": str(int(num_partitions))}


def read_table(spark: SparkSession, conn: Connection, table: str, time_column: str | None = None, start_s: int | None = None,
               finish_s: int | None = None, num_partitions: int = 1, fetch_size: int = 10000) -> DataFrame:
    """A table as a lazy scan: columns selected and filters put on it are pushed into the
    database's query.  With a time column, both bounds and ``num_partitions`` > 1 it is split into
    that many parallel range queries."""
    reader = (spark.read.format("jdbc").options(**conn.options())
              .option("dbtable", quoted_table(conn.kind, table)).option("fetchsize", fetch_size))
    if time_column is None or num_partitions <= 1:
        return reader.load()
    whole = reader.load()  # asks the database for the columns only
    options = range_options(time_column, whole.schema[time_column].dataType, start_s, finish_s, num_partitions)
    return reader.options(**options).load() if options else whole


def read_range(spark: SparkSession, conn: Connection, table: str, time_column: str, columns: Sequence[str],
               start_s: int | None = None, finish_s: int | None = None, num_partitions: int = 1,
               fetch_size: int = 10000) -> DataFrame:
    """Listed columns of one table inside the inclusive time range (pushed to the database).
    The time column holds epoch seconds."""
    df = read_table(spark, conn, table, time_column, start_s, finish_s, num_partitions, fetch_size)
    keep = [time_column] + [x for x in columns if x != time_column]
    return time_range_filter(df.select(*[c(x) for x in keep]), start_s, finish_s, time_column)
