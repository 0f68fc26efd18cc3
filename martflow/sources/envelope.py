"""Record schemas and parsing of the two raw topics.

* ``topic_db``  change-log envelope: fixed outer schema, open ``data``/``old``
  maps (numbers inside become text).
* ``topic_log`` behaviour log: open records, see ``operators/traffic.keyed_log``;
  :data:`LOG_SCHEMA` is what the page jobs read of them.
* config change feed (Debezium style ``before/after/op/ts_ms``).

Parsing never drops a record silently: :func:`split_clean_dirty` returns the
parsed main output and the raw dirty output (side output of the source job).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from martflow.functions.jsonfn import is_json_object

S = T.StringType()
MAP_SS = T.MapType(S, S)

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("database", S),
    T.StructField("table", S),
    T.StructField("type", S),
    T.StructField("ts", T.LongType()),
    T.StructField("xid", T.LongType()),
    T.StructField("commit", S),
    T.StructField("data", MAP_SS),
    T.StructField("old", MAP_SS),
])

LOG_SCHEMA = T.StructType([
    T.StructField("common", MAP_SS),
    T.StructField("page", MAP_SS),
    T.StructField("ts", T.LongType()),
])

CONFIG_ROW = T.StructType([
    T.StructField("source_table", S),
    T.StructField("sink_table", S),
    T.StructField("sink_columns", S),
    T.StructField("sink_pk", S),
    T.StructField("sink_extend", S),
])

CONFIG_CHANGE_SCHEMA = T.StructType([
    T.StructField("before", CONFIG_ROW),
    T.StructField("after", CONFIG_ROW),
    T.StructField("op", S),
    T.StructField("ts_ms", T.LongType()),
])

# Change types that mark bootstrap control records of the
# change-capture tool; they carry no row and go to the dirty output.
CONTROL_TYPES = ("bootstrap-start", "bootstrap-complete")


def decode_value(col="value"):
    """S1 record decoder: bytes/strings -> text; a null record becomes ''."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def once(c):
    """The value as a generated row: filters on it stay above, instead of working it out anew below."""
    return F.explode(F.array(c))


#: Field of a parsed record that holds its text where that did not parse in full.
UNPARSED = "__unparsed"


def _object_and_record(raw: DataFrame, schema: T.StructType, value: str, keep: tuple[str, ...]) -> DataFrame:
    """``_ok`` (the text is a JSON object) and ``_rec`` by one parse: a text that begins as an object and parses in full is one.

    Only the others (few, in a change-log) are tested.  The parse takes no bare ``NaN``, which that test does not take either.
    """
    rec = F.from_json(F.col(value), T.StructType([*schema.fields, T.StructField(UNPARSED, S)]),
                      {"columnNameOfCorruptRecord": UNPARSED, "allowNonNumericNumbers": "false"})
    tagged = raw.select(*keep, F.col(value), once(rec).alias("_rec"))
    whole = F.col(value).startswith("{") & F.col("_rec").isNotNull() & F.col("_rec").getField(UNPARSED).isNull()
    return tagged.withColumn("_ok", F.when(whole, F.lit(True)).otherwise(is_json_object(F.col(value))))


def split_clean_dirty(raw: DataFrame, schema: T.StructType, value: str = "value",
                      route_control: bool = False, keep: tuple[str, ...] = (), mostly_clean: bool = False):
    """P1 (+P2): parse JSON text; return ``(clean, dirty)``.

    ``clean`` has the columns of ``schema`` (plus ``keep`` pass-through
    columns); ``dirty`` holds the raw rows that are not JSON objects, and with
    ``route_control`` also control records whose ``type`` is one of
    :data:`CONTROL_TYPES` (a missing ``type`` passes).

    With ``mostly_clean`` (for schemas without floats, same rows) texts are parsed at once, and not tested for an object before.
    """
    if mostly_clean:
        tagged = _object_and_record(raw, schema, value, keep)
    else:
        tagged = raw.select(*keep, F.col(value), once(is_json_object(F.col(value))).alias("_ok"))
        tagged = tagged.select(*keep, F.col(value), "_ok", once(F.when(F.col("_ok"), F.from_json(F.col(value), schema))).alias("_rec"))
    if route_control:
        typ = F.col("_rec").getField("type") if "type" in schema.fieldNames() else \
            F.get_json_object(F.col(value), "$.type")
        tagged = tagged.withColumn(
            "_ok", F.col("_ok") & F.coalesce(~typ.isin(*CONTROL_TYPES), F.lit(True)))
    clean = tagged.filter("_ok").select(*keep, *[F.col("_rec").getField(c).alias(c) for c in schema.fieldNames()])
    dirty = tagged.filter(~F.col("_ok")).select(*keep, F.col(value))
    return clean, dirty


def parse_strict(raw: DataFrame, schema: T.StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse with no dirty output; malformed text fails the job."""
    return raw.select(*keep, F.from_json(F.col(value), schema, {"mode": "FAILFAST"}).alias("_r")) \
        .select(*keep, "_r.*")


def envelope_of(data: Sequence[str] | None = None, old: Sequence[str] | None = None) -> T.StructType:
    """The envelope with only these fields of ``data`` and ``old``, as structs in place of open maps (None: the map).

    ``data["id"]`` reads either.  A struct takes less time to parse; of a name that a record spells twice it has the last value, a map the first.
    """
    narrow = {k: T.StructType([T.StructField(c, S) for c in v]) for k, v in (("data", data), ("old", old)) if v is not None}
    return T.StructType([T.StructField(f.name, narrow.get(f.name, f.dataType)) for f in ENVELOPE_SCHEMA])


def parse_envelope(raw: DataFrame, value: str = "value", route_control: bool = True, keep: tuple[str, ...] = (),
                   schema: T.StructType = ENVELOPE_SCHEMA):
    """S3: ``topic_db`` text -> (envelope rows, dirty rows)."""
    return split_clean_dirty(raw, schema, value, route_control=route_control, keep=keep, mostly_clean=True)


#: Column of the parsed changes that still holds the record's text, see :func:`of_table`.
TEXT = "__text"


def read_changes(raw: DataFrame, value: str = "value", data: Sequence[str] | None = None,
                 old: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S3 for many views of one topic: ``(changes, dirty)`` as from :func:`parse_envelope`, and the text as :data:`TEXT`.

    Nothing is written.  A view that takes its rows by :func:`of_table` parses the records that can be its own alone, so the
    views together parse a record once, and each reads the texts.  ``data`` and ``old``: the fields that the views read, see :func:`envelope_of`.
    """
    return parse_envelope(raw.withColumn(TEXT, F.col(value)), value, keep=(TEXT,), schema=envelope_of(data, old))


def of_table(changes: DataFrame, table: str) -> DataFrame:
    """The changes of one source table.  Where they carry their text, it is tested before it is parsed: JSON spells a name
    out between its quotes, or with a backslash in it."""
    if TEXT in changes.columns:
        changes = changes.filter(F.col(TEXT).contains(f'"{table}"') | F.col(TEXT).contains("\\"))
    return changes.filter(F.col("table") == table)


def parse_config_feed(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()):
    """Config change feed text -> (change rows, dirty rows)."""
    return split_clean_dirty(raw, CONFIG_CHANGE_SCHEMA, value, keep=keep)
