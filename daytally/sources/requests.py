"""Source documents as a data source: the planned requests are its partitions, and what came of each is a row.

Spark runs a partition's requests one after another in one task, so the number of partitions bounds how many run at a time. A
request that fails is tried again a few times and then reported; a task that is lost repeats its own requests and no
others. Land what is read before it is parsed.
"""

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from daytally.functions import strip_key

Request = tuple[str, str, str, str]
# Of (exchange, symbol, start, end): the address and the body, or no body after a failure.
Fetch = Callable[[str, str, str, str], tuple[str, str | None]]

SCHEMA = "exchange string, Symbol string, SourceURL string, body string, answered boolean, attempts int, error string"


@dataclass
class Requests(InputPartition):
    """What one task asks for."""

    requests: list[Request]


def answer(fetch: Fetch, request: Request, attempts: int) -> tuple:
    """The row of a request: its last answer, how often it was asked, and the last error."""
    url = body = error = None
    asked = 0
    while body is None and asked < attempts:
        asked += 1
        try:
            url, body = fetch(*request)
            error = None if body is not None else "no body"
        except Exception as failure:  # noqa: BLE001 - whatever a fetcher raises is that request's answer
            error = f"{type(failure).__name__}: {failure}"
    return (*request[:2], url, body, body is not None, asked, error)


def document_source(fetch: Fetch, requests: list[Request], tasks: int, attempts: int) -> type[DataSource]:
    """A data source of the given requests, dealt out over ``tasks`` partitions."""
    shares = [requests[k::tasks] for k in range(min(tasks, len(requests)))]
    label = f"documents_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [Requests(share) for share in shares] or [Requests([])]

        def read(self, partition: Requests) -> Iterator[tuple]:
            for request in partition.requests:
                yield answer(fetch, request, attempts)

    class Documents(DataSource):
        @classmethod
        def name(cls) -> str:
            return label

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Documents


def read_requests(spark: SparkSession, plan: DataFrame, fetch: Fetch, tasks: int = 64, attempts: int = 3) -> DataFrame:
    """Documents of the planned symbols, with the status of each request.

    The plan has one row per symbol and comes to the driver, which deals it out; documents do not. ``fetch`` must be
    such that a worker can import or unpickle it.
    """
    if tasks < 1 or attempts < 1:
        raise ValueError("at least one task and one attempt are needed")
    wanted = plan.where(F.col("action") != "skip").select(
        "exchange", "Symbol", F.col("start_date").cast("string"), F.col("end_date").cast("string"))
    source = document_source(fetch, sorted(tuple(r) for r in wanted.collect()), tasks, attempts)
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load().withColumn("SourceURL", strip_key(F.col("SourceURL")))
