"""A relational store over JDBC: tables made where absent, staging tables loaded in bulk, switched in one transaction.

Executors only ever append to a staging table; what a repeated task may load twice there is reduced to distinct rows by the
one transaction that fills the live table, so a lost executor leaves neither gaps nor copies. ``types`` is the list of
columns with the store's types, ``"id bigint, title varchar(4000)"``; names are quoted as given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _columns(types: str) -> list[tuple[str, str]]:
    depth, start, parts = 0, 0, []
    for i, ch in enumerate(types):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            parts.append(types[start:i])
            start = i + 1
    return [(p.split(None, 1)[0], p.split(None, 1)[1].strip()) for p in [*parts, types[start:]]]


def _fill(table: str, stage: str, types: str) -> str:
    names = ", ".join(f'"{c}"' for c, _ in _columns(types))
    return f"INSERT INTO {table} ({names}) SELECT DISTINCT {', '.join(f'CAST(s."{c}" AS {t})' for c, t in _columns(types))} FROM {stage} s"


def execute(spark: SparkSession, url: str, statements: list[str]) -> None:
    """All statements in one transaction; none of them if one fails."""
    con = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        con.setAutoCommit(False)
        st = con.createStatement()
        try:
            for s in statements:
                st.executeUpdate(s)
            con.commit()
        except Exception:
            con.rollback()
            raise
        finally:
            st.close()
    finally:
        con.close()


def has_table(spark: SparkSession, url: str, table: str) -> bool:
    con = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        found = con.getMetaData().getTables(None, None, "%", None)
        while found.next():
            if found.getString("TABLE_NAME").lower() == table.lower():
                return True
        return False
    finally:
        con.close()


def create(spark: SparkSession, url: str, table: str, types: str) -> bool:
    """Make the table where it is absent; whether it was."""
    if has_table(spark, url, table):
        return False
    execute(spark, url, [f"CREATE TABLE {table} (" + ", ".join(f'"{c}" {t}' for c, t in _columns(types)) + ")"])
    return True


def truncate(spark: SparkSession, url: str, table: str) -> None:
    execute(spark, url, [f"DELETE FROM {table}"])


def read(spark: SparkSession, url: str, table: str) -> DataFrame:
    return spark.read.jdbc(url, table)


def bulk_load(df: DataFrame, url: str, table: str, types: str, batch: int = 50_000) -> str:
    """Fill ``<table>_staging``, made anew with the types that Spark writes, with the columns of ``types``; its name."""
    stage = f"{table}_staging"
    df.select(*[c for c, _ in _columns(types)]).write.option("batchsize", batch).mode("overwrite").jdbc(url, stage)
    return stage


def insert_or_ignore(df: DataFrame, url: str, table: str, types: str, key: list[str]) -> None:
    """Add the rows whose ``key`` the table lacks; the others are ignored. ``df`` holds a key once (see ``tables.first_wins``)."""
    spark = df.sparkSession
    create(spark, url, table, types)
    stage = bulk_load(df, url, table, types)
    same = " AND ".join(f't."{k}" = CAST(s."{k}" AS {dict(_columns(types))[k]})' for k in key)
    execute(spark, url, [f"{_fill(table, stage, types)} WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})", f"DROP TABLE {stage}"])


def replace_all(tables: dict[str, tuple[DataFrame, str]], url: str) -> None:
    """Replace the contents of ``{table: (df, types)}`` together: staged one by one, switched in one transaction.

    Rows that are equal in all columns are one row, as staging may hold a row twice.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    switch = []
    for name, (df, types) in tables.items():
        create(spark, url, name, types)
        stage = bulk_load(df, url, name, types)
        switch += [f"DELETE FROM {name}", _fill(name, stage, types), f"DROP TABLE {stage}"]
    execute(spark, url, switch)
