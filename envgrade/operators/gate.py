"""Accept-or-quarantine gate over raw JSON messages.

The message is parsed once to VARIANT, so a missing field, a null, a wrong type
and an unreadable text stay different things. Every field gives a severity, and the
highest one over the whole message becomes its one reason code.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envgrade import schemas as S
from envgrade.config import Settings

# Accepted text forms.
DECIMAL_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_TEXT = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
INSTANT_TEXT = (
    r"^\d{4}-\d{2}-\d{2}([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?"
    r"([zZ]|[+-]\d{2}(:?\d{2})?)?)?$"
)
ZERO_OFFSET_TEXT = r"^.{10}[Tt _].*([zZ]|[+-]00(:?00)?)$"
OFFSET_SUFFIX = r"([zZ]|[+-]\d{2}(:?\d{2})?)$"

# Which error decides when a message has several.
SEVERITY = {S.RANGE: 3, S.PARSE: 2, S.SCHEMA: 1}

NUMERIC_TYPES = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"
# Epoch numbers above this are milliseconds.
EPOCH_MS_ABOVE = 2e10


@dataclass(frozen=True)
class Probe:
    """What the message holds for one field; ``kind`` is null when it is missing."""

    kind: Column
    text: Column

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def is_number(self) -> Column:
        return self.kind.rlike(NUMERIC_TYPES)

    @property
    def is_boolean(self) -> Column:
        return self.kind == "BOOLEAN"


def _with_probes(df: DataFrame, holder: str, prefix: str, names: tuple[str, ...]) -> DataFrame:
    """Read each field out of a variant map once, into plain columns."""
    columns = {}
    for name in names:
        v = F.col(holder)[name]
        columns[f"{prefix}kind_{name}"] = F.schema_of_variant(v)
        columns[f"{prefix}text_{name}"] = F.try_variant_get(v, "$", "string")
    return df.withColumns(columns)


def _probe(prefix: str, name: str) -> Probe:
    return Probe(*[F.col(f"{prefix}{part}_{name}") for part in ("kind", "text")])


def _error_if(condition: Column, reason: str) -> Column:
    return F.when(condition, SEVERITY[reason]).otherwise(0)


def _bounds_error(x: Column, lo: float | None, hi: float | None) -> Column:
    outside = F.lit(False)
    if lo is not None:
        # NaN fails every bound, while Spark orders it above all numbers.
        outside = outside | F.isnan(x.cast("double")) | (x < lo)
    if hi is not None:
        outside = outside | (x > hi)
    return _error_if(outside, S.RANGE)


def _special_double(text: Column) -> Column:
    word = F.lower(F.regexp_replace(F.trim(text), r"^[+-]", ""))
    sign = F.when(F.trim(text).startswith("-"), -1.0).otherwise(1.0)
    return F.when(word == "nan", F.lit(float("nan"))).otherwise(sign * F.lit(float("inf")))


def text_value(p: Probe) -> Column:
    return F.when(p.is_text, p.text)


def _decimal(p: Probe) -> Column:
    """Numbers and numeric text as a double. A number's text is its JSON form."""
    spelled = p.is_number | (p.is_text & p.text.rlike(DECIMAL_TEXT))
    return F.when(spelled, F.trim(p.text).try_cast("double"))


def double_value(p: Probe) -> Column:
    """JSON numbers, booleans as 0 and 1, and numeric text."""
    special = p.is_text & p.text.rlike(SPECIAL_TEXT)
    return (
        F.when(p.is_boolean, F.when(p.text == "true", 1.0).otherwise(0.0))
        .when(special, _special_double(p.text))
        .otherwise(_decimal(p))
    )


def int_value(p: Probe) -> Column:
    """Whole numbers in any spelling; a fractional number has the wrong type."""
    from_text = F.when(
        p.text.rlike(INTEGER_TEXT),
        F.regexp_replace(F.trim(p.text), r"\.0*$", "").try_cast("bigint"),
    )
    number = p.text.try_cast("double")
    whole = p.is_number & (number == F.floor(number))
    return (
        F.when(p.is_boolean, F.when(p.text == "true", 1).otherwise(0))
        .when(p.is_text, from_text)
        .when(whole, number.try_cast("bigint"))
    )


def number_error(p: Probe, value: Column, lo: float | None, hi: float | None) -> Column:
    return (
        F.when(value.isNotNull(), _bounds_error(value, lo, hi))
        .when(p.is_text, SEVERITY[S.PARSE])
        .otherwise(SEVERITY[S.SCHEMA])
    )


def member_error(value: Column, allowed: tuple[str, ...]) -> Column:
    return _error_if(value.isNull() | ~value.isin(*allowed), S.SCHEMA)


def epoch_value(p: Probe) -> Column:
    """Epoch numbers, also as text: seconds, or milliseconds when too large for them."""
    number = _decimal(p)
    scale = F.when(F.abs(number) > EPOCH_MS_ABOVE, 1e3).otherwise(1e6)
    return F.timestamp_micros((number * scale).try_cast("bigint"))


def local_value(p: Probe) -> Column:
    """The wall time an ISO text states, its offset left aside; null if unreadable."""
    text = F.trim(p.text)
    # A bare date also ends in a sign and two digits, so only texts that carry a
    # time lose their offset.
    bare = F.regexp_replace(F.translate(text, "t_,", "T ."), OFFSET_SUFFIX, "")
    return F.when(
        p.is_text & text.rlike(INSTANT_TEXT),
        F.when(F.length(text) > 10, bare).otherwise(text).try_cast("timestamp"),
    )


def utc_value(p: Probe, epoch: Column, local: Column) -> Column:
    """An instant with an explicit zero offset, or an epoch number.

    The offset is judged on the text, since a cast would silently convert it.
    """
    return F.coalesce(epoch, F.when(F.trim(p.text).rlike(ZERO_OFFSET_TEXT), local))


def utc_error(p: Probe, value: Column, local: Column) -> Column:
    unreadable = p.is_text & local.isNull()
    return F.when(value.isNotNull(), 0).when(unreadable, SEVERITY[S.PARSE]).otherwise(SEVERITY[S.SCHEMA])


def classify_reason(*errors: Column) -> Column:
    """One code over all errors of a model: range, then parse, then schema."""
    worst = F.greatest(F.lit(0), *errors)
    reason = F.lit(None).cast("string")
    for code, severity in SEVERITY.items():
        reason = F.when(worst == severity, code).otherwise(reason)
    return reason


def _extra_keys(fields: Column, known: list[Probe]) -> Column:
    """An object has no repeated keys, so more keys than known ones means a foreign one."""
    present = sum((F.when(p.kind.isNotNull(), 1).otherwise(0) for p in known), F.lit(0))
    return _error_if(F.size(fields) > present, S.SCHEMA)


# Fields of all kinds; a name shared by two kinds has the same rule in both.
ALL_FIELDS = {f[0]: f for fields in S.PAYLOAD_FIELDS.values() for f in fields}


def with_field_checks(df: DataFrame, cfg: Settings, fields: str = "_fields") -> DataFrame:
    """Add ``_v_<name>`` and ``_e_<name>`` for every payload field."""
    probed = _with_probes(df, fields, "_p_", tuple(ALL_FIELDS))
    probes = {name: _probe("_p_", name) for name in ALL_FIELDS}
    times = [n for n, rule, *_ in ALL_FIELDS.values() if rule == "utc"]
    probed = probed.withColumns(
        {f"_epoch_{n}": epoch_value(probes[n]) for n in times}
        | {f"_local_{n}": local_value(probes[n]) for n in times}
    )
    values, errors = {}, {}
    for name, rule, lo, hi in ALL_FIELDS.values():
        p, value, local = probes[name], F.col(f"_v_{name}"), F.col(f"_local_{name}")
        if rule == "utc":
            values[name] = utc_value(p, F.col(f"_epoch_{name}"), local)
            errors[name] = utc_error(p, value, local)
        elif rule in ("double", "int"):
            values[name] = double_value(p) if rule == "double" else int_value(p)
            errors[name] = number_error(p, value, lo, hi)
        else:
            values[name] = text_value(p)
            allowed = {"region": cfg.regions, "construction": S.CONSTRUCTIONS}.get(rule)
            errors[name] = (
                member_error(value, allowed) if allowed else _error_if(value.isNull(), S.SCHEMA)
            )
    return probed.withColumns({f"_v_{n}": v for n, v in values.items()}).withColumns(
        {f"_e_{n}": e for n, e in errors.items()}
    )


def parse_utc(df: DataFrame, value: str, cfg: Settings) -> DataFrame:
    """Judge one JSON value as an instant: ``instant`` and ``reason_code``."""
    holder = df.withColumn("_fields", F.create_map(F.lit("ts"), F.try_parse_json(F.col(value))))
    checked = with_field_checks(holder, cfg)
    return checked.select(
        *df.columns,
        F.col("_v_ts").alias("instant"),
        classify_reason(F.col("_e_ts")).alias("reason_code"),
    )


def payload_errors(event_type: str, fields: str = "_fields") -> list[Column]:
    """Severities of one payload under the model of ``event_type``."""
    names = tuple(f[0] for f in S.PAYLOAD_FIELDS[event_type])
    extra = _extra_keys(F.col(fields), [_probe("_p_", n) for n in names])
    return [*(F.col(f"_e_{n}") for n in names), extra]


def event_struct(event_type: str) -> Column:
    mine = {f[0] for f in S.PAYLOAD_FIELDS[event_type]}
    columns = []
    for f in S.EVENT_SCHEMA.fields:
        value = F.col(f"_v_{f.name}") if f.name in mine else F.lit(None)
        value = F.lit(event_type) if f.name == "event_type" else value
        columns.append(value.cast(f.dataType).alias(f.name))
    return F.struct(*columns)


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Parse once: the envelope's fields, and the payload's when it is an object."""
    env = F.try_variant_get(F.try_parse_json(F.col(value)), "$", "map<string,variant>")
    return raw.withColumn("_env", env).withColumn(
        "_fields", F.try_variant_get(F.col("_env")["payload"], "$", "map<string,variant>")
    )


def _claimed_type(p: Probe) -> Column:
    return (
        F.when(p.kind.isNull(), "unknown")
        .when(p.kind == "VOID", "None")
        .when(p.is_boolean, F.initcap(p.text))
        .otherwise(p.text)
    )


def validate_envelopes(
    raw: DataFrame, cfg: Settings, value: str = "value", metrics: str | None = None
) -> DataFrame:
    """Add ``claimed_type``, ``key_region``, ``reason_code`` (null when accepted) and
    ``event``, a struct in the wide event layout that is null for rejected messages.

    Envelope errors are decided before the payload is looked at. The counters are
    observed under the name ``metrics``. The observation also keeps filters on the
    reason above the checks: pushed below, they would repeat the whole parse.
    """
    env, fields = F.col("_env"), F.col("_fields")
    kind_probe, key_probe = _probe("_m_", "event_type"), _probe("_m_", "key")
    payload_error = (
        F.when(env["payload"].isNull(), SEVERITY[S.SCHEMA])
        .when(fields.isNull(), SEVERITY[S.PARSE])
        .otherwise(0)
    )
    present = F.when(env["payload"].isNotNull(), 1).otherwise(0)
    for probe in (kind_probe, key_probe):
        present = present + F.when(probe.kind.isNotNull(), 1).otherwise(0)
    envelope = classify_reason(
        member_error(text_value(kind_probe), S.EVENT_TYPES),
        member_error(text_value(key_probe), cfg.regions),
        payload_error,
        _error_if(F.size(env) > present, S.SCHEMA),
    )
    probed = _with_probes(parse_messages(raw, value), "_env", "_m_", ("event_type", "key"))
    checked = with_field_checks(probed, cfg).withColumns(
        {
            "claimed_type": _claimed_type(kind_probe),
            "key_region": text_value(key_probe),
            "_envelope_reason": F.when(env.isNull(), S.PARSE).otherwise(envelope),
        }
    )
    ok = F.col("_envelope_reason").isNull()
    reason = F.lit(S.SCHEMA)  # a declared type without a model is quarantined, not raised
    event = F.lit(None)
    for event_type in S.EVENT_TYPES:
        mine = F.col("claimed_type") == event_type
        reason = F.when(mine, classify_reason(*payload_errors(event_type))).otherwise(reason)
        event = F.when(mine, event_struct(event_type)).otherwise(event)
    judged = checked.withColumn("reason_code", F.when(ok, reason).otherwise(F.col("_envelope_reason")))
    return judged.withColumn("event", F.when(F.col("reason_code").isNull(), event)).select(
        *raw.columns, "claimed_type", "key_region", "reason_code", "event"
    ).observe(metrics or f"gate_{uuid.uuid4().hex}", *gate_counts())


def valid_events(gated: DataFrame) -> DataFrame:
    """Accepted events as columns.

    They are generated rather than projected, so that a later join on one of them
    does not make the planner trace it back through every check of the gate.
    """
    return gated.where(F.col("reason_code").isNull()).select(F.inline(F.array("event")))


def quarantine_rows(gated: DataFrame, value: str = "value") -> DataFrame:
    """Rejected messages kept whole for audit."""
    return gated.where(F.col("reason_code").isNotNull()).select(
        F.current_timestamp().alias("ts_received"),
        F.col("claimed_type").alias("event_type"),
        "reason_code",
        F.col(value).alias("raw"),
    )


def split_valid(gated: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    return valid_events(gated), quarantine_rows(gated, value)


def gate_counts() -> list[Column]:
    """Counters of one pass, usable in ``agg`` and in ``observe``.

    ``region_mismatch`` counts accepted messages whose key differs from the
    payload's region; the payload's region is the one used.
    """
    ok = F.col("reason_code").isNull()
    return [
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(ok).alias("forwarded"),
        F.count_if(~ok).alias("quarantined"),
        F.count_if(ok & (F.col("key_region") != F.col("event.region"))).alias("region_mismatch"),
    ]


def region_is_configured(region: Column, cfg: Settings) -> Column:
    return region.isin(*cfg.regions)


def reason_ledger(log: DataFrame) -> DataFrame:
    """Unavailable readings per source, stream, city and reason."""
    return log.groupBy("source", "stream", "city", "reason").agg(F.count(F.lit(1)).alias("n"))

