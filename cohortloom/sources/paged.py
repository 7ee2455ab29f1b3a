"""Reading a paged service in parallel: one task per page."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import properties as P

PAGE_SCHEMA = "page bigint, pos bigint, item string"

Fetch = Callable[[Mapping[str, Any]], Mapping[str, Any]]


class Page(InputPartition):
    def __init__(self, number: int, first: Mapping[str, Any] | None = None):
        super().__init__(number)
        self.number = number
        self.first = first


def paged_source(fetch: Fetch, params: Mapping[str, Any] | None = None) -> type[DataSource]:
    """A data source over ``fetch(params) -> {results, session_id, page_size, total}``.

    Planning fetches page 0 to learn the session and the number of pages; each
    page is then fetched by its own task, with ``page`` and ``session_id`` set.
    A page with no ``results`` is an error.
    """
    base = dict(params or {})

    def checked(reply: Mapping[str, Any], number: int) -> Mapping[str, Any]:
        if "results" not in reply:
            raise ValueError(f"page {number} has no results: {sorted(reply)}")
        return reply

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            head = checked(fetch(base), 0)
            self.session = head.get("session_id")
            pages = -(-int(head["total"]) // int(head["page_size"]))
            return [Page(n, {"session_id": self.session}) for n in range(max(pages, 1))]

        def read(self, partition: Page) -> Iterator[tuple]:
            asked = {**base, "page": partition.number, **partition.first}
            reply = checked(fetch(asked), partition.number)
            for pos, item in enumerate(reply["results"]):
                yield partition.number, pos, P.literal_text(item)

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_items"

        def schema(self) -> str:
            return PAGE_SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return Paged


def read_pages(spark: SparkSession, fetch: Fetch, params: Mapping[str, Any] | None = None) -> DataFrame:
    """All items as ``page, pos, item`` (JSON text); order by the first two to restore it."""
    spark.dataSource.register(paged_source(fetch, params))
    return spark.read.format("paged_items").load()


def profiles_of_pages(pages: DataFrame) -> DataFrame:
    """Paged items that are profiles, as ``distinct_id, properties``."""
    item = F.from_json("item", "map<string,variant>")
    parsed = pages.select(P.props_from_variants(item).alias("_i"))
    return parsed.select(
        F.coalesce(P.prop_string("_i", "$distinct_id"), P.prop_string("_i", "distinct_id")).alias(
            "distinct_id"
        ),
        P.parse_props(P.prop("_i", "$properties")).alias("properties"),
    )


def page_count(total: Column | str, page_size: Column | int) -> Column:
    size = page_size if isinstance(page_size, Column) else F.lit(page_size)
    return F.ceil(P._col(total) / size).cast("bigint")


def with_pages(df: DataFrame, total: str, page_size: int) -> DataFrame:
    """One row per page: ``page, first_pos, last_pos`` of each row's item total."""
    pages = F.sequence(F.lit(0).cast("bigint"), page_count(total, page_size) - 1)
    first = F.col("page") * page_size
    return (
        df.where(F.col(total) > 0)
        .withColumn("page", F.explode(pages))
        .withColumn("first_pos", first)
        .withColumn("last_pos", F.least(first + page_size, F.col(total)) - 1)
    )
