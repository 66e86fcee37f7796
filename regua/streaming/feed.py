"""Event feed: enveloped JSON in, stamped JSON lines out.

One query writes valid and invalid events into separate folders of the same
sink. The file sink commits both with the micro-batch, so a restart repeats and
loses nothing. A run reports the events of the batches that it commits, counted in
the files that the sink committed (:mod:`regua.streaming.sinklog`); no clock is asked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from regua.schemas import EVENT_FIELDS
from regua.streaming.sinklog import committed_files, files_since, last_commit, place_of_row, refuse_foreign

VALID, INVALID = "valido", "invalido"
STATE_COLUMN = "situacao"
DAY_COLUMN = "dt_ingestao"
_MARKER = "fim-do-evento"

ENVELOPE = T.StructType(
    [T.StructField("kinesis", T.StructType([T.StructField("data", T.StringType())]))]
)


def read_envelopes(
    spark: SparkSession, source: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Envelopes as JSON lines in a folder. Any streaming frame of the same
    shape, from whichever connector a deployment has, can take its place."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source)


def utc_text(micros: Column) -> Column:
    """Microseconds since 1970 as ``yyyy-mm-ddThh:mm:ss.ffffff+00:00``.

    No step knows a time zone, so hours that a zone skips or repeats are as
    any other.
    """
    clock = utc_clock(micros).cast("string")
    fraction = F.rpad(F.substring_index(F.concat(clock, F.lit(".")), ".", 2), 26, "0")
    whole = F.substring_index(clock, ".", 1)
    digits = F.when(clock.contains("."), F.substring(fraction, 21, 6)).otherwise(F.lit("000000"))
    return F.concat(F.replace(whole, F.lit(" "), F.lit("T")), F.lit("."), digits, F.lit("+00:00"))


def utc_clock(micros: Column) -> Column:
    """Microseconds since 1970 as a timestamp without a zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def decode_events(
    envelopes: DataFrame,
    fields: Mapping[str, str] = EVENT_FIELDS,
    data: str = "kinesis.data",
    strict: bool = False,
    micros: Column | None = None,
) -> DataFrame:
    """Decode, parse and stamp.

    An event is valid when its bytes are UTF-8 text holding one JSON object and
    nothing else. The text is kept beside the declared fields, so unknown keys
    survive, and a field of an unexpected type becomes NULL without spoiling the
    event. An invalid event keeps its original encoded form.

    Numbers like ``NaN`` and repeated keys (of which the last counts) are
    accepted, unless ``strict``.

    The parser stops at the end of the first value. Parsing the text as the
    first of two elements makes anything that follows it visible: either the
    array breaks, or its second element is not the marker.

    ``micros`` is the instant of the stamp, by default the start of the batch.
    """
    encoded = F.col(data)
    text = F.try_to_binary(encoded, F.lit("base64")).cast("string")
    if micros is None:
        micros = F.unix_micros(F.current_timestamp())
    array = F.concat(F.lit("["), "payload", F.lit(f', "{_MARKER}"]'))
    parsed = envelopes.select(
        encoded.alias("_encoded"), F.when(F.is_valid_utf8(text), text).alias("payload")
    ).withColumn("_json", F.try_parse_json(array))
    whole = F.try_variant_get("_json", "$[1]", "string") == _MARKER
    if strict:
        loose = {name: F.lit(None).cast(kind) for name, kind in fields.items()}
    else:
        elements = F.from_json(array, T.ArrayType(T.StringType()))
        whole = F.coalesce(whole, (F.size(elements) == 2) & (F.get(elements, 1) == _MARKER))
        texts = T.StructType([T.StructField(name, T.StringType()) for name in fields])
        parsed = parsed.withColumn(
            "_texts", F.when(F.col("_json").isNull(), F.from_json("payload", texts))
        )
        # Numbers without digits come back in quotes.
        loose = {
            name: (
                F.col("_texts")[name]
                if kind == "string"
                else F.btrim(F.col("_texts")[name], F.lit('"')).try_cast(kind)
            )
            for name, kind in fields.items()
        }
    is_object = F.coalesce(F.col("payload").rlike(r"^\s*\{") & whole, F.lit(False))
    valid = F.col("_valid")
    return parsed.withColumn("_valid", is_object).select(
        *[
            F.when(
                valid, F.coalesce(F.try_variant_get("_json", f"$[0].{name}", kind), loose[name])
            ).alias(name)
            for name, kind in fields.items()
        ],
        F.when(valid, F.col("payload")).alias("payload"),
        F.when(~valid, F.col("_encoded")).alias("rejected"),
        utc_text(micros).alias("_ingestion_ts"),
        F.when(valid, VALID).otherwise(INVALID).alias(STATE_COLUMN),
        utc_clock(micros).cast("date").alias(DAY_COLUMN),
    )


def first_deliveries(events: DataFrame, within: str, key: Sequence[str] = ()) -> DataFrame:
    """Decoded events of a stream, each stored once however often a source delivers it.

    A copy is an event of the same text, valid or not, or of the same ``key`` fields; events
    without any of these are copies by their text. The state holds a digest of each key from its
    arrival until the watermark, ``within`` behind the last arrival, has passed that time by
    ``within``; a copy that comes later than that is a new event. So the state holds the
    events of about twice ``within``, whatever the stream has seen before. Arrival is the start of
    the batch, which does not depend on clocks of producers.
    """
    text = F.coalesce("payload", "rejected", F.lit(""))
    given = F.to_json(F.struct(*key)) if key else F.lit(None)
    whole = [F.col(name).isNotNull() for name in key]
    named = F.when(reduce(Column.__and__, whole, F.lit(bool(key))), given)
    marked = events.withColumns(
        {
            "_copia": F.sha2(F.concat_ws("\n", STATE_COLUMN, F.coalesce(named, text)).cast("binary"), 256),
            "_chegada": F.current_timestamp(),
        }
    )
    return (
        marked.withWatermark("_chegada", within)
        .dropDuplicatesWithinWatermark(["_copia"])
        .drop("_copia", "_chegada")
    )


def start_ingest(
    envelopes: DataFrame,
    target: str,
    checkpoint: str,
    fields: Mapping[str, str] = EVENT_FIELDS,
    once_within: str | None = None,
    key: Sequence[str] = (),
    **trigger,
) -> StreamingQuery:
    """Append events below ``target`` by state and ingestion day.

    The day gets a column of its own: a folder named after a payload field
    would overwrite that field when the files are read back.

    ``once_within`` (as in ``"24 hours"``) leaves out redelivered events, see
    ``first_deliveries``. A checkpoint belongs to one choice of it.
    """
    events = decode_events(envelopes, fields)
    if once_within is not None:
        events = first_deliveries(events, once_within, key)
    return (
        events.writeStream.format("json")
        .partitionBy(STATE_COLUMN, DAY_COLUMN)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(target)
    )


class Written(NamedTuple):
    """Events stored by a run."""

    valid: int
    invalid: int

    @property
    def total(self) -> int:
        return self.valid + self.invalid


def events_by_batch(spark: SparkSession, target: str, files: Sequence[str]) -> DataFrame:
    """(stamp, valid, invalid) of each batch that wrote some of ``files``.

    All events of a batch carry its stamp. Only the day folders that the files are in are read.
    """
    days = sorted({place.split(f"{DAY_COLUMN}=")[1].split("/")[0] for place in files})
    named = spark.createDataFrame([(place,) for place in files], "place string")
    columns = f"_ingestion_ts string, {STATE_COLUMN} string, {DAY_COLUMN} date"
    stored = (
        spark.read.schema(columns).json(target)
        .where(F.col(DAY_COLUMN).cast("string").isin(days))
        .withColumn("place", place_of_row())
    )
    of_state = lambda state: F.count_if(F.col(STATE_COLUMN) == state)
    return (
        stored.join(named, "place", "left_semi")
        .groupBy(F.col("_ingestion_ts").alias("stamp"))
        .agg(of_state(VALID).alias("valid"), of_state(INVALID).alias("invalid"))
    )


def records_written(spark: SparkSession, target: str, files: Sequence[str]) -> Written:
    """Events in the files named, valid and invalid."""
    if not files:
        return Written(0, 0)
    total = events_by_batch(spark, target, files).agg(
        F.coalesce(F.sum("valid"), F.lit(0)), F.coalesce(F.sum("invalid"), F.lit(0))
    )
    return Written(*total.first())


def ingest(
    envelopes: DataFrame,
    target: str,
    checkpoint: str,
    fields: Mapping[str, str] = EVENT_FIELDS,
    once_within: str | None = None,
    key: Sequence[str] = (),
    **trigger,
) -> Written:
    """Run until all available events are stored, and say how many were.

    These are the events of the batches that this run finishes, also of one that an
    earlier run had begun, or had stored without noting it. Every event is so reported by
    one run. A run whose query fails raises and reports nothing; the batches it had finished are not reported later.
    """
    spark = envelopes.sparkSession
    refuse_foreign(spark, target, checkpoint)
    known = committed_files(spark, target, last_commit(spark, checkpoint))
    start_ingest(envelopes, target, checkpoint, fields, once_within, key, **trigger).awaitTermination()
    return records_written(spark, target, files_since(spark, target, known))


def read_events(
    spark: SparkSession,
    target: str,
    state: str = VALID,
    fields: Mapping[str, str] = EVENT_FIELDS,
) -> DataFrame:
    columns = {
        **fields,
        "payload": "string",
        "rejected": "string",
        "_ingestion_ts": "string",
        STATE_COLUMN: "string",
        DAY_COLUMN: "date",
    }
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    stored = spark.read.schema(schema).json(target)
    other = "rejected" if state == VALID else "payload"
    return stored.where(F.col(STATE_COLUMN) == state).drop(other)
