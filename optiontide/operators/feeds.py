"""Decoding of landed market-data feed messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from optiontide.functions.feed_fields import BOOK_SERVICES, SERVICE_FIELDS, field_type
from optiontide.schemas import BOOK_CONTENT


def _name_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def relabel_fields(content: Column | str, mapping: Mapping[str, str]) -> Column:
    """Map with numbered keys renamed; unknown keys stay."""
    content = F.col(content) if isinstance(content, str) else content
    names = _name_map(mapping)
    return F.transform_keys(content, lambda k, _: F.coalesce(F.try_element_at(names, k), k))


def service_mapping(service: str) -> dict[str, str]:
    return {str(i): name for i, name in enumerate(SERVICE_FIELDS[service])}


def _content_rows(messages: DataFrame, service: str, item: str, value: str) -> DataFrame:
    shape = f"data array<struct<service: string, timestamp: bigint, command: string, content: array<{item}>>>"
    parsed = messages.select(F.explode(F.from_json(F.col(value).cast("string"), shape)["data"]).alias("d"))
    wanted = parsed.filter(F.col("d.service") == service)
    return wanted.select(
        F.col("d.service").alias("service"), F.col("d.timestamp").alias("timestamp"), F.explode("d.content").alias("content")
    )


def parse_feed(messages: DataFrame, value: str = "value") -> DataFrame:
    """Content items (service, timestamp, content) of all services: each message is parsed once."""
    shape = "data array<struct<service: string, timestamp: bigint, command: string, content: array<map<string,string>>>>"
    parsed = messages.select(F.explode(F.from_json(F.col(value).cast("string"), shape)["data"]).alias("d"))
    return parsed.select(F.col("d.service").alias("service"), F.col("d.timestamp").alias("timestamp"), F.explode("d.content").alias("content"))


def write_by_service(items: DataFrame, path: str) -> None:
    """Write the items of ``parse_feed`` partitioned by service, with a file open for each service instead of a sort of a task's rows."""
    conf, name = items.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(max(int(before), len(SERVICE_FIELDS) + len(BOOK_SERVICES))))
    try:
        items.write.partitionBy("service").parquet(path)
    finally:
        conf.set(name, before)


def feed_fields(items: DataFrame, service: str) -> DataFrame:
    """Named, typed columns of the items of one service from ``parse_feed``.

    A field that does not fit its type is null. Fields without a name are kept
    in the map column ``other_fields``. To take several services out of a large feed, write the parsed items
    by ``write_by_service`` first.
    """
    if service not in SERVICE_FIELDS:
        raise ValueError(f"unknown service {service!r}")
    mapping = service_mapping(service)
    fields = []
    for number, name in mapping.items():
        raw = F.try_element_at("content", F.lit(number))
        kind = field_type(name)
        fields.append((raw if kind == "string" else raw.try_cast(kind)).alias(name))
    numbers = list(mapping)
    other = F.map_filter("content", lambda k, _: ~k.isin(numbers)).alias("other_fields")
    return items.filter(F.col("service") == service).select("service", "timestamp", *fields, other)


def decode_feed(messages: DataFrame, service: str, value: str = "value") -> DataFrame:
    """One row per content item of ``service``, see ``feed_fields``."""
    return feed_fields(parse_feed(messages, value), service)


def decode_book(messages: DataFrame, service: str, value: str = "value") -> DataFrame:
    """One row per side, price level and exchange of the order-book messages of ``service``."""
    if service not in BOOK_SERVICES:
        raise ValueError(f"unknown book service {service!r}")
    rows = _content_rows(messages, service, BOOK_CONTENT, value)
    sides = F.array(
        F.struct(F.lit("BID").alias("side"), F.col("content.2").alias("levels")),
        F.struct(F.lit("ASK").alias("side"), F.col("content.3").alias("levels")),
    )
    by_side = rows.select(
        "service",
        F.coalesce(F.col("content.0"), F.col("content.key")).alias("symbol"),
        F.col("content.1").alias("book_time"),
        F.inline(sides),
    )
    by_level = by_side.select("service", "symbol", "book_time", "side", F.explode("levels").alias("l"))
    by_exchange = by_level.select(
        "service", "symbol", "book_time", "side",
        F.col("l.0").alias("price"), F.col("l.1").alias("level_volume"), F.col("l.2").alias("level_count"),
        F.explode("l.3").alias("e"),
    )
    return by_exchange.select(
        "service", "symbol", "book_time", "side", "price", "level_volume", "level_count",
        F.col("e.0").alias("exchange"), F.col("e.1").alias("volume"), F.col("e.2").alias("sequence"),
    )


def split_notifications(messages: DataFrame, value: str = "value") -> DataFrame:
    """Parts of each message as (kind, service, payload): response, data, notify.

    A response in the feed is an error for its reader; heartbeats are dropped.
    """
    shape = "response array<string>, data array<string>, notify array<string>"
    parsed = messages.select(F.from_json(F.col(value).cast("string"), shape).alias("m"))
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(f"m.{k}").alias("items")) for k in ("response", "data", "notify")]
    )
    items = parsed.select(F.inline(kinds)).select("kind", F.explode("items").alias("payload"))
    heartbeat = (F.col("kind") == "notify") & F.get_json_object("payload", "$.heartbeat").isNotNull()
    return items.filter(~heartbeat).select("kind", F.get_json_object("payload", "$.service").alias("service"), "payload")
