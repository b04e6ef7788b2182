"""Request contract: JSON records to typed rows or reject reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BroadcastBound, ScoreSettings
from ..functions.numbers import number_in_text
from ..schema import DEMOGRAPHIC_NAMES, MARKET_FIELDS, OPTIONAL_FIELDS, PLACE_FIELDS, REQUEST_FIELDS, REQUIRED_FIELDS
from ..sources.workspace import materialize
from .lookup import lookup_join

_SENT, _KEYS, _READ = "__sent", "__keys", "__read"

# One pass over the JSON text: text fields keep their JSON type as a variant,
# numbers arrive as they are written.
_SENT_TYPES = ", ".join(f"{n} {'variant' if t == 'string' else 'string'}" for n, t in REQUEST_FIELDS.items())
_TEXTS = tuple(n for n, t in REQUEST_FIELDS.items() if t == "string")
_NUMBERS = tuple(n for n, t in REQUEST_FIELDS.items() if t != "string")


def _text(sent: Column, name: str) -> Column:
    """A text field; null when it was not sent as text."""
    value = sent[name]
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _whole(text: Column) -> Column:
    """An integer field, also sent as numeric text; it has no fraction."""
    value = number_in_text(text)
    # plain digits are read as they are: a double would change large ones
    exact = F.trim(text.cast("string")).try_cast("bigint")
    return F.when(value == F.floor(value), F.coalesce(exact, value.try_cast("bigint")))


def _required(sent: Column) -> dict[str, Column]:
    """The required fields as they are read."""
    return {n: _text(sent, n) if t == "string" else _whole(sent[n]) for n, t in REQUIRED_FIELDS.items()}


def _names(names) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _number_texts(sent: Column) -> Column:
    return F.array(*[sent[n] for n in _NUMBERS])


def _unread(text: Column) -> Column:
    """Text that was sent for a number and is none."""
    return text.isNotNull() & number_in_text(text).isNull()


def _any_unread(sent: Column) -> Column:
    """Whether the names of wrong numbers have to be looked for. Most records send few
    fields and no wrong one; groups of fields that were not sent are passed over."""
    rest = [n for n in _NUMBERS if n not in OPTIONAL_FIELDS]
    groups = [[sent[n] for n in g] for g in (rest, MARKET_FIELDS, PLACE_FIELDS, DEMOGRAPHIC_NAMES)]
    found = [F.when(F.coalesce(*g).isNotNull(), F.exists(F.array(*g), _unread)).otherwise(False) for g in groups]
    return reduce(Column.__or__, found)


def _reasons(sent: Column, keys: Column, read: Column | dict[str, Column]) -> Column:
    """Why a record is refused: sorted, empty when it is not.

    Lambda functions, and all that stands inside them, are interpreted. So the reasons
    of known names are joined and split, and lambdas see only what is left.
    """
    none = F.array().cast("array<string>")
    bad_date = read["date"].isNotNull() & F.try_to_timestamp(read["date"]).isNull()
    known = F.concat_ws(
        ",",
        *[F.when(~F.array_contains(keys, n), f"missing:{n}") for n in REQUIRED_FIELDS],
        *[F.when(F.array_contains(keys, n) & read[n].isNull(), f"type:{n}") for n in REQUIRED_FIELDS],
        F.when(bad_date, "date:date"),
    )
    types = F.transform(
        _number_texts(sent), lambda text, i: F.when(_unread(text), F.get(F.array(*[F.lit(f"type:{n}") for n in _NUMBERS]), i))
    )
    unknown = F.filter(keys, lambda k: ~k.isin(*REQUEST_FIELDS))
    reasons = F.concat(
        F.when(known == "", none).otherwise(F.split(known, ",")),
        F.when(F.size(unknown) == 0, none).otherwise(F.transform(unknown, lambda k: F.concat(F.lit("unknown:"), k))),
        F.when(_any_unread(sent), F.array_compact(types)).otherwise(none),
    )
    return F.when(keys.isNull(), _names(["invalid"])).otherwise(F.sort_array(F.array_distinct(reasons)))


def _typed(sent: Column, read: Column | dict[str, Column]) -> Column:
    """A record that is accepted. Every number that was sent has passed
    ``number_in_text``, so Spark's own reading of it is the same."""
    rest = [n for n in REQUEST_FIELDS if n not in REQUIRED_FIELDS]
    return F.struct(*[read[n].alias(n) for n in REQUIRED_FIELDS], *[sent[n].try_cast("double").alias(n) for n in rest])


def parse_requests(df: DataFrame, json_column: str) -> DataFrame:
    """Adds ``request`` (typed struct, null when rejected) and ``reject_reasons``
    (sorted; empty when accepted).

    Reasons: ``invalid`` for text that is not a JSON object, ``missing:f`` for an
    absent required field, ``unknown:f`` for a field outside the contract,
    ``type:f`` for a wrong type (null is a value for optional fields only),
    ``date:date`` for text that is no date.

    The 35 number fields go through one function over an array: spelled out, they
    make a method too long for the JVM to compile.
    """
    sent, keys = F.col(_SENT), F.col(_KEYS)
    # columns and no struct, whose fields the optimizer would work out again for every use
    read = {n: F.col(f"{_READ}_{n}") for n in REQUIRED_FIELDS}
    parsed = (
        df.withColumn(_SENT, F.from_json(json_column, _SENT_TYPES))
        .withColumn(_KEYS, F.json_object_keys(json_column))
        .withColumns({f"{_READ}_{n}": value for n, value in _required(sent).items()})
    )
    return (
        parsed.withColumn("reject_reasons", _reasons(sent, keys, read))
        .withColumn("request", F.when(F.size("reject_reasons") == 0, _typed(sent, read)))
        .drop(_SENT, _KEYS, *[f"{_READ}_{n}" for n in REQUIRED_FIELDS])
    )


def parse_batches(df: DataFrame, json_column: str, cfg: ScoreSettings) -> DataFrame:
    """Adds ``requests`` (array of typed structs, null when the batch is refused),
    ``n_records`` and ``reject_reasons`` of nested batches ``{"records": [...]}``.

    A batch is taken or refused as a whole. Reasons: ``invalid`` for text that is
    not a JSON object, ``missing:records``, ``unknown:f``, ``type:records`` for a
    value that is no array, ``too_few`` and ``too_many`` records, and for each bad
    record its reasons after its place, as in ``records[3].missing:city``. The
    records of a batch of the wrong size are not looked at.

    Records are checked inside their array by higher-order functions: refused
    batches are never exploded and nothing is shuffled.
    """
    records, kinds, parts = "__records", "__kinds", "__parts"
    keys = F.col(_KEYS)
    # the text of each record, and beside it what it is: a quoted record is no record
    read = (
        df.withColumn(_KEYS, F.json_object_keys(json_column))
        .withColumn(records, F.from_json(json_column, "records array<string>")["records"])
        .withColumn(kinds, F.from_json(json_column, "records array<variant>")["records"])
        .withColumn("n_records", F.when(F.col(records).isNotNull(), F.size(records).cast("bigint")))
    )
    fits = F.col("n_records").between(cfg.min_batch, cfg.max_batch)
    objects = F.zip_with(records, kinds, lambda text, kind: F.when(F.startswith(F.schema_of_variant(kind), F.lit("OBJECT")), text))

    def read_record(text: Column) -> Column:
        return F.struct(F.from_json(text, _SENT_TYPES).alias("sent"), F.json_object_keys(text).alias("keys"))

    def with_required(record: Column) -> Column:
        return record.withField("read", F.struct(*[v.alias(n) for n, v in _required(record["sent"]).items()]))

    def checked(record: Column) -> Column:
        return _reasons(record["sent"], record["keys"], record["read"])

    def placed(reasons: Column, place: Column) -> Column:
        return F.transform(reasons, lambda r: F.concat(F.lit("records["), place.cast("string"), F.lit("]."), r))

    read = read.withColumn(parts, F.when(fits, F.transform(F.transform(objects, read_record), with_required)))
    size = F.when(F.col("n_records") < cfg.min_batch, "too_few").when(F.col("n_records") > cfg.max_batch, "too_many")
    whole = F.concat(
        F.transform(F.array_except(_names(["records"]), keys), lambda n: F.concat(F.lit("missing:"), n)),
        F.transform(F.sort_array(F.array_except(keys, _names(["records"]))), lambda n: F.concat(F.lit("unknown:"), n)),
        F.array_compact(F.array(F.when(F.array_contains(keys, "records") & F.col(records).isNull(), "type:records"), size)),
        F.coalesce(F.flatten(F.transform(F.transform(parts, checked), placed)), F.array().cast("array<string>")),
    )
    reasons = F.when(keys.isNull(), _names(["invalid"])).otherwise(whole)
    typed = F.transform(parts, lambda record: _typed(record["sent"], record["read"]))
    return (
        read.withColumn("reject_reasons", reasons)
        .withColumn("requests", F.when(F.size("reject_reasons") == 0, typed))
        .drop(_KEYS, records, kinds, parts)
    )


def batch_records(parsed: DataFrame, batch_column: str) -> DataFrame:
    """One typed request per record of the accepted batches, with its position."""
    rows = parsed.where(F.col("requests").isNotNull())
    rows = rows.select(batch_column, F.posexplode("requests").alias("position", "request"))
    return rows.select(batch_column, "position", "request.*")


def missing_fields(df: DataFrame) -> Column:
    """Names of optional fields without a value, in contract order. The target
    and derived columns are never reported. A column the table does not have
    counts as missing."""

    def is_missing(name: str) -> Column:
        if name not in df.columns:
            return F.lit(name)
        value = F.col(f"`{name}`")
        empty = value.isNull()
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            empty = empty | F.isnan(value)
        return F.when(empty, F.lit(name))

    return F.array_compact(F.array(*[is_missing(n) for n in OPTIONAL_FIELDS]))


def to_raw_names(df: DataFrame) -> DataFrame:
    """Request names to the raw column names (with spaces)."""
    return df.withColumnsRenamed(
        {k: v for k, v in DEMOGRAPHIC_NAMES.items() if k in df.columns}
    )


def batch_sizes(df: DataFrame, batch_column: str, cfg: ScoreSettings) -> DataFrame:
    """Rows per batch and whether the batch is within the size limits."""
    sizes = df.groupBy(batch_column).agg(F.count("*").alias("n_records"))
    return sizes.withColumn("accepted", F.col("n_records").between(cfg.min_batch, cfg.max_batch))


def accepted_batches(
    df: DataFrame, batch_column: str, cfg: ScoreSettings, bound: BroadcastBound
) -> DataFrame:
    """Rows of the batches within the size limits. The sizes are counted with
    partial counts and joined as a lookup, so a huge batch is spread out."""
    sizes = materialize(batch_sizes(df, batch_column, cfg), "batch-sizes")
    joined = lookup_join(df, sizes, batch_column, batch_column, ["accepted"], bound)
    return joined.where("accepted").drop("accepted")


def explode_batches(
    df: DataFrame, batch_column: str, records_column: str, cfg: ScoreSettings
) -> tuple[DataFrame, DataFrame]:
    """(records, rejected batches): one row per record of every batch whose size
    is allowed, with its position; and the other batches with their size."""
    size = F.coalesce(F.size(records_column), F.lit(0))
    allowed = size.between(cfg.min_batch, cfg.max_batch)
    records = df.where(allowed).select(
        batch_column, F.posexplode(records_column).alias("position", "record")
    )
    rejected = df.where(~allowed).select(batch_column, size.cast("bigint").alias("n_records"))
    return records, rejected
