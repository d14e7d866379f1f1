"""Chain messages: reading, decoding, publishing."""

from __future__ import annotations

import gzip
import math
import zlib
from collections.abc import Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql import types as T

from optiontide.schemas import MESSAGE, chain_schema

REQUESTS_PER_MINUTE = 120
TRIGGER_SECONDS = 15
MAX_MESSAGE_BYTES = 10_485_760


def topic_name(day: date) -> str:
    return f"option_chain_topic_{day:%Y%m%d}"


def max_per_trigger(accounts: int, per_minute: int = REQUESTS_PER_MINUTE, trigger_seconds: int = TRIGGER_SECONDS) -> int:
    """Messages per trigger: accounts x requests per trigger / trigger seconds, rounded up."""
    return math.ceil(accounts * per_minute * trigger_seconds / 60 / trigger_seconds)


def kafka_options(servers: str, topic: str, limit: int, starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "maxOffsetsPerTrigger": str(limit),
        "startingOffsets": starting,
    }


def read_chain_stream(spark: SparkSession, source: str, topic_or_dir: str, max_per_trigger: int,
                      starting: str = "earliest", servers: str = "localhost:9092") -> DataFrame:
    """Stream of (key, value) messages from ``kafka`` or from a folder of ``parquet`` files."""
    if source == "kafka":
        options = kafka_options(servers, topic_or_dir, max_per_trigger, starting)
        return spark.readStream.format("kafka").options(**options).load()
    if source == "parquet":
        reader = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", max_per_trigger)
        return reader.parquet(topic_or_dir)
    raise ValueError(f"unknown source {source!r}")


def _unzipped(data: bytes | None) -> bytes | None:
    if data is None:
        return None
    try:
        whole = zlib.decompressobj(_GZIP)
        text = whole.decompress(data)
        if whole.eof and not whole.unused_data:
            return text
    except zlib.error:
        pass
    try:
        return gzip.decompress(data)  # several members, or nothing at all
    except (OSError, EOFError, zlib.error):
        return None


def _decoded(data: bytes | None) -> str | None:
    try:
        return None if data is None else data.decode("utf-8")
    except UnicodeDecodeError:
        return None


@arrow_udf(T.StringType())
def _gunzip(values: pa.Array) -> pa.Array:
    if values.null_count == len(values):
        return pa.nulls(len(values), pa.string())
    texts = [_unzipped(data) for data in values.to_pylist()]
    try:
        return pa.array(texts, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # some text of the batch is not UTF-8, or the batch is too large for one array
        return pa.array([_decoded(data) for data in texts], pa.large_string()).cast(pa.string())


#: Window bits of zlib that ask for a gzip frame.
_GZIP = 31
_LEVEL = 6


def _zipped(data: bytes | None, level: int = _LEVEL) -> bytes | None:
    """Gzip bytes of a text. Window and tables are no larger than the text can use, since making them costs more than a short text itself."""
    if data is None:
        return None
    bits = min(max(len(data).bit_length(), 10), 15)
    packer = zlib.compressobj(level, zlib.DEFLATED, _GZIP - 15 + bits, min(bits - 4, 8))
    return packer.compress(data) + packer.flush()


@arrow_udf(T.BinaryType())
def _gzip(values: pa.Array) -> pa.Array:
    return pa.array([_zipped(data) for data in values.cast(pa.binary()).to_pylist()], pa.binary())


#: Most bytes of a stored block of deflate, and the bytes of a frame of one block around its text.
_BLOCK = 65_535
_AROUND = 23


def _block_head(size: Column) -> Column:
    """Nine hex digits: 1, and a block's size and its complement, least byte first."""
    swapped = size % 256 * 256 + F.shiftright(size, 8)
    return F.hex((swapped + 65_536) * 65_536 + (65_535 - swapped))


def _least_first(number: Column) -> Column:
    """A number of four bytes with their order reversed."""
    parts = [F.shiftleft(F.shiftright(number, 8 * i).bitwiseAND(255), 24 - 8 * i) for i in range(4)]
    return parts[0] + parts[1] + parts[2] + parts[3]


def _frame_end(data: Column, size: Column) -> Column:
    """Checksum and size of a text, least byte first."""
    return F.unhex(F.lpad(F.hex(F.shiftleft(_least_first(F.crc32(data)), 32).bitwiseOR(_least_first(size))), 16, "0"))


def _frame(text: Column) -> Column:
    """Gzip frame whose text is stored as it is, for files that compress many messages together."""
    data = text.cast("binary")
    size = F.octet_length(text).cast("long")

    def block(at: Column) -> Column:
        part = F.least(size - at, F.lit(_BLOCK))
        last = F.when(at + part == size, "0").otherwise("00")
        head = F.when(at + part == size, _block_head(part)).otherwise(F.substring(_block_head(part), 2, 8))
        return F.concat(last, head, F.hex(F.substring(data, (at + 1).cast("int"), part.cast("int"))))

    one = F.concat(F.unhex(F.concat(F.lit("1F8B08000000000000FF0"), _block_head(size))), data, _frame_end(data, size))
    blocks = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(_BLOCK).cast("long")), block), "")
    many = F.concat(F.unhex(F.concat(F.lit("1F8B08000000000000FF"), blocks)), _frame_end(data, size))
    return F.when(size <= _BLOCK, one).otherwise(many)


def _stored_text(value: Column) -> Column:
    """Text of a gzip frame of one stored block; null for other frames and bytes."""
    around = F.octet_length(value).cast("long")
    size = around - _AROUND
    data = F.substring(value, 16, size.cast("int"))
    framed = (
        size.between(0, _BLOCK) & (F.substring(value, 1, 4) == F.unhex(F.lit("1F8B0800")))
        & (F.substring(value, 11, 5) == F.unhex(F.concat(F.lit("0"), _block_head(size))))
    )
    whole = F.substring(value, (around - 7).cast("int"), 8) == _frame_end(data, size)
    text = data.cast("string")
    utf8 = F.format_string("%s", text) == text  # by Java's decoder, in less than half the time of is_valid_utf8
    return F.when(framed & whole & utf8, text)


def gunzip(df: DataFrame, value: str, name: str) -> DataFrame:
    """Column ``name`` with the text of gzip bytes; null where they cannot be read.

    Frames of one stored block are read by built-in functions. Python gets the others alone, with nulls in the place of those.
    """
    read = df.withColumn("__stored", _stored_text(F.col(value)))
    rest = F.when(F.col("__stored").isNull(), F.col(value))
    return read.withColumn(name, F.coalesce("__stored", _gunzip(rest))).drop("__stored")


def parse_chain(df: DataFrame, text: str, greeks: str = "double", status: str | None = None, fields: Sequence[str] | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Columns of the chain document in ``text``, or some ``columns`` of it.

    With ``status`` also a column of that name: ``ok``, or ``not_json`` for text
    that is no JSON object, or ``unreadable`` for null text. Such rows are all null.
    With ``fields`` contracts hold these fields alone; the parser skips the others, and columns left out, which are most of its work.
    """
    parsed = df.withColumn("__chain", F.from_json(F.col(text), chain_schema(greeks, fields, columns)))
    if status is None:
        return parsed.select("__chain.*")
    state = (
        F.when(F.col(text).isNull(), "unreadable")
        .when(F.json_object_keys(text).isNull(), "not_json")
        .otherwise("ok")
    )
    return parsed.select("__chain.*", state.alias(status))


def decode_chain_payload(df: DataFrame, value_col: str = "value", greeks: str = "double",
                         record_status: str | None = None, fields: Sequence[str] | None = None,
                         columns: Sequence[str] | None = None) -> DataFrame:
    """gzip JSON bytes to chain columns; corrupt records are tagged, not fatal. Messages that carry their text already (``with_text``) are not unzipped again."""
    return parse_chain(with_text(df, value_col).select(F.col(TEXT).alias("__json")), "__json", greeks, record_status, fields, columns)


#: Column with the unzipped text of a message.
TEXT = "__text"


def with_text(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages with their unzipped text, for several readers of one batch."""
    return messages if TEXT in messages.columns else gunzip(messages, value_col, TEXT)


def encode_chains(chains: DataFrame, key: str = "symbol", deflate: bool = True) -> DataFrame:
    """Messages (key, value): the symbol, and the chain without raw response as gzip JSON.

    Without ``deflate`` the gzip frames hold the text uncompressed, for a target that compresses its messages together.
    """
    body = chains.drop("response")
    pack = _gzip if deflate else _frame
    # The text is a column of its own: a frame refers to it several times.
    texts = body.select(F.col(key).cast("binary").alias("key"), F.to_json(F.struct(*body.columns)).alias(TEXT))
    return texts.select("key", pack(F.col(TEXT)).alias("value"))


#: Codec of parquet files of messages.
MESSAGE_CODEC = "zstd"
#: Bytes of a row group of messages, and of a split for costly work on them: some 200,000 messages, so that a few large files go out evenly to all cores.
MESSAGE_SPLIT = 16 * 1024 * 1024
#: Messages don't repeat, so a dictionary of them is work for nothing.
MESSAGE_FILES = {"parquet.enable.dictionary#value": "false", "parquet.block.size": str(MESSAGE_SPLIT)}


def publish_chains(chains: DataFrame, target: str, format: str = "parquet", servers: str = "localhost:9092",
                   key: str = "symbol") -> None:
    """Write messages to a Kafka topic, or append them to a parquet folder.

    Chains repeat each other's field names and values, which a frame for each message cannot use: the pages of a
    parquet folder are compressed over many messages instead, and the frames in them are not.
    """
    messages = encode_chains(chains, key, deflate=format != "parquet")
    if format == "kafka":
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).option(
            "kafka.max.request.size", str(MAX_MESSAGE_BYTES)
        ).save()
    elif format == "parquet":
        messages.write.mode("append").options(**MESSAGE_FILES).parquet(target, compression=MESSAGE_CODEC)
    else:
        raise ValueError(f"unknown format {format!r}")
