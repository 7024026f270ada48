"""Sources that ask a service: ranges of days or pages as input partitions, each asked for by one task.

``fetch`` names the client, ``module:function``. It gets ``(start, end, options)`` and yields dicts; nothing here depends on a service.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from casebook.sources import sinks

#: Rows a page, and defaults of the date and language options.
PAGE = 500
DEFAULTS = {"languages": "ENG,FRE", "start_date": "1990-01-01"}


class Span(InputPartition):
    def __init__(self, start: str, end: str):
        super().__init__((start, end))
        self.start, self.end = start, end


class HarvestReader(DataSourceReader):
    def __init__(self, columns: list[str], options: dict):
        self.columns, self.options = columns, {**DEFAULTS, **options}

    def partitions(self) -> list[Span]:
        o = self.options
        most = int(o["count"]) if o.get("count") else None
        if o.get("by", "days") == "pages":
            low, high = int(o.get("start_id", 0)), int(o.get("end_id") or int(o.get("start_id", 0)) + int(o["total"]))
            high = min(high, low + most) if most is not None else high
            page = int(o.get("page", PAGE))
            return [Span(str(k), str(min(k + page, high))) for k in range(low, high, page)]
        first, last = date.fromisoformat(o["start_date"]), date.fromisoformat(o.get("end_date") or date.today().isoformat())
        skip = {x for x in o.get("skip_dates", "").split(",") if x}
        days = [first + timedelta(k) for k in range((last - first).days + 1)]
        return [Span(d.isoformat(), d.isoformat()) for d in days if d.isoformat() not in skip]

    def read(self, partition: Span) -> Iterator[tuple]:
        module, _, name = self.options["fetch"].partition(":")
        for row in getattr(import_module(module), name)(partition.start, partition.end, self.options):
            yield tuple(None if row.get(c) is None else str(row[c]) for c in self.columns)


class Harvest(DataSource):
    """``spark.read.format("harvest").schema(...)``; options: fetch, by (days, pages), start_date, end_date, skip_dates, start_id, end_id, total, page, count."""

    @classmethod
    def name(cls) -> str:
        return "harvest"

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in self.options["columns"].split(","))

    def reader(self, schema) -> HarvestReader:
        return HarvestReader(schema.names, dict(self.options))


def date_range(start: str | None = None, end: str | None = None, fresh: bool = False, mark: str | None = None, today: str | None = None) -> tuple[str, str]:
    """The range that date arguments mean: all from 1990 if ``fresh``, else the given start, else the last mark, else 1990; up to ``end`` or today."""
    return (DEFAULTS["start_date"] if fresh else start or mark or DEFAULTS["start_date"]), end or today or date.today().isoformat()


def back_fill(boundaries: list[str]) -> list[tuple[str | None, str | None]]:
    """Ranges between boundaries, closed and without overlap, with an open first and last one."""
    day = lambda x, n: (date.fromisoformat(x) + timedelta(n)).isoformat()
    out: list[tuple[str | None, str | None]] = [(None, day(boundaries[0], -1))]
    out += [(a, day(b, -1)) for a, b in zip(boundaries, boundaries[1:])]
    return [*out, (boundaries[-1], None)]


#: The sources, how each is asked, and the outputs that each lands.
SOURCES = {
    "rechtspraak": {"by": "days", "outputs": ("base", "metadata", "citations")},
    "echr": {"by": "pages", "outputs": ("metadata", "full_text", "nodes", "edges")},
    "cellar": {"by": "days", "outputs": ("metadata", "full_text", "nodes", "edges")},
}
MOST = 1_000_000


def load(spark: SparkSession, columns: list[str], count: int | None = None, **options: str) -> DataFrame:
    """Rows of a service, ``count`` of them at most; pages beyond the count aren't asked for."""
    spark.dataSource.register(Harvest)
    options |= {"count": str(count)} if count is not None and options.get("by") == "pages" else {}
    df = spark.read.format("harvest").schema(", ".join(f"`{c}` string" for c in columns)).options(**options).load()
    return df if count is None else df.limit(count)


def extract(spark: SparkSession, source: str, fetch: dict[str, str], columns: dict[str, list[str]], folder: str, count: int | None = MOST, skip_if_exists: bool = True, **options: str) -> dict[str, str]:
    """Land a named source: one folder an output, ``{output: path}``; where all are there, nothing is asked.

    ``fetch`` and ``columns`` name the client and the columns of each output; outputs without a client are left out.
    """
    spec = SOURCES[source]
    paths = {o: f"{folder}/{o}" for o in spec["outputs"] if o in fetch}
    if skip_if_exists and all(sinks.exists(spark, f"{p}/_SUCCESS") for p in paths.values()):
        return paths
    for o, path in paths.items():
        df = load(spark, columns[o], count, fetch=fetch[o], **{"by": spec["by"], **options})
        if o == "full_text":
            df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
        elif o in ("nodes", "edges"):
            sinks.write_lines(df, path, "overwrite")
        else:
            sinks.write_csv(df, path, "overwrite")
    return paths
