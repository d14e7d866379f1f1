"""From chain messages to the stored contract table, as a batch function for a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from optiontide.operators.chain import CHAIN_COLUMNS, attach_dividends
from optiontide.operators.quality import observe_quality
from optiontide.operators.tables import conform
from optiontide.plans.enrich import enrich_fetch_day
from optiontide.schemas import contract_schema, output_schema
from optiontide.sources.chains import TEXT, decode_chain_payload, with_text
from optiontide.streaming.job import epoch_sink, run_stream


#: What stored rows take from a message.
COLUMNS = ("symbol", "callExpDateMap", "putExpDateMap", *CHAIN_COLUMNS)
FIELDS = contract_schema(deliverables=False).names


def process_messages(
    messages: DataFrame,
    schedule: DataFrame,
    params: Mapping[str, Column | float],
    close_equity: Column | str,
    close_index: Column | str,
    fundamentals: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Stored contract rows of gzip chain messages.

    Messages that cannot be read, or hold no symbol, give no rows (``run_contract_job`` can keep them). With
    ``fundamentals`` the dividend amounts come from there instead of the chain.
    ``options`` go to ``enrich_fetch_day``.
    """
    chains = decode_chain_payload(messages, fields=FIELDS, columns=COLUMNS).withColumnRenamed("symbol", "ticker")
    # Emptied rather than filtered out: a filter would be pushed below the parser and parse each chain twice.
    named = F.col("ticker").isNotNull()
    chains = chains.withColumns({side: F.when(named, F.col(side)) for side in ("callExpDateMap", "putExpDateMap")})
    if fundamentals is not None:
        chains = attach_dividends(chains, fundamentals, "ticker")
    return conform(enrich_fetch_day(chains, schedule, params, close_equity, close_index, carry=("ticker",), **options), output_schema())


def message_states(messages: DataFrame, keep_text: bool = False) -> DataFrame:
    """Messages with ``state``: ok, unreadable, not_json, or no_symbol; with ``keep_text`` also their unzipped text."""
    text = with_text(messages)
    symbol = F.get_json_object(TEXT, "$.symbol")
    state = (
        F.when(F.col(TEXT).isNull(), "unreadable").when(F.json_object_keys(TEXT).isNull(), "not_json")
        .when(symbol.isNull(), "no_symbol").otherwise("ok")
    )
    stated = text.withColumn("state", state)
    return stated if keep_text else stated.drop(TEXT)


def run_contract_job(
    source: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    name: str = "contracts",
    trigger: str | None = None,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Stream messages through ``transform`` into the epoch table at ``path``.

    A replayed epoch replaces its rows, so a restart after a lost driver or
    executor neither loses nor doubles contracts. With ``quarantine`` messages
    that give no rows (see ``message_states``) are written as they came, with their state,
    to an epoch table there; their number is observed as the metric ``messages`` of each batch. A message is then unzipped once: the batch with its
    texts is kept for both writers.
    """
    rows = epoch_sink(path, transform)
    if quarantine is None:
        return run_stream(source, rows, checkpoint, name, trigger)
    kept = epoch_sink(quarantine, lambda batch: batch.filter("state <> 'ok'").drop(TEXT))
    problem = F.when(F.col("state") != "ok", F.col("state"))
    stated = observe_quality(message_states(source, keep_text=True).withColumn("__bad", problem), "__bad", "messages").drop("__bad")

    def both(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()
        try:
            kept(held, epoch)
            rows(held.drop("state"), epoch)
        finally:
            held.unpersist()

    return run_stream(stated, both, checkpoint, name, trigger)
