"""Reading meaning into raw tables: column roles, coercion, validity, fire filter, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cellcast import fixed
from cellcast.functions.text import BLANKS, pick_column, plain_name, to_day, to_number

ROW_ID = "_row_id"


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Remember the input order, which decides who survives de-duplication.

    Give ``key`` where the data has an order of its own: generated ids follow the order of files and
    splits and change when these change.
    """
    return df.withColumn(ROW_ID, F.col(key) if key else F.monotonically_increasing_id())


def incident_roles(columns: list[str], **override: str | None) -> dict[str, str | None]:
    """Column per role (date, lat, lon, type); a caller's choice wins over the guess."""
    return {
        role: override.get(role) or pick_column(columns, names, fixed.INCIDENT_SUBSTRINGS[role])
        for role, names in fixed.INCIDENT_NAMES.items()
    }


def weather_roles(columns: list[str], **override: str | None) -> dict[str, str]:
    """Column per weather role; every role must be found."""
    roles = {
        role: override.get(role) or pick_column(columns, names, fixed.WEATHER_SUBSTRINGS[role])
        for role, names in fixed.WEATHER_NAMES.items()
    }
    missing = [role for role, column in roles.items() if column is None]
    if missing:
        raise ValueError(f"no column found for weather roles {missing}")
    return roles


def location_columns(columns: list[str]) -> list[str]:
    wanted = {plain_name(n) for n in fixed.LOCATION_NAMES}
    return [c for c in columns if plain_name(c) in wanted]


def standardize_incidents(df: DataFrame, keep: list[str] | None = None, **override: str | None) -> DataFrame:
    """Raw table of any naming -> date, lat, lon, type, its location columns and ``keep``."""
    roles = incident_roles(df.columns, **override)
    chosen = [F.col(c).alias(role) for role, c in roles.items() if c]
    used = {r for r, c in roles.items() if c}
    extra = [c for c in [*(keep or []), *location_columns(df.columns)] if c not in used]
    return df.select(*dict.fromkeys(extra), *chosen)


def standardize_weather(df: DataFrame, **override: str | None) -> DataFrame:
    """Raw weather table of any naming -> date, temperature, humidity, precipitation, wind."""
    return df.select(*[F.col(c).alias(role) for role, c in weather_roles(df.columns, **override).items()])


def has_field_values(df: DataFrame, fields: list[str], values: list[str]) -> Column:
    """Whether every field equals its value, ignoring case and outer white space."""
    if len(fields) != len(values):
        raise ValueError("give one value per filter field")
    unknown = [f for f in fields if f not in df.columns]
    if unknown:
        raise ValueError(f"unknown filter field {unknown[0]}")
    same = F.lit(True)
    for field, value in zip(fields, values):
        same &= F.lower(F.trim(F.col(field).cast("string"), F.lit(BLANKS))) == str(value).strip().lower()
    return same


def filter_field_values(df: DataFrame, fields: list[str], values: list[str]) -> DataFrame:
    """Rows whose every field equals its value, ignoring case and outer white space."""
    return df.filter(has_field_values(df, fields, values))


def coerce_coordinates(df: DataFrame, lat: str | None, lon: str | None) -> DataFrame:
    """Add latitude and longitude as doubles, from two columns or from a GeoJSON point."""
    if lat and lon:
        y, x = to_number(F.col(lat), df.schema[lat].dataType), to_number(F.col(lon), df.schema[lon].dataType)
    elif "geometry" in df.columns:
        point = F.col("geometry.coordinates")
        y, x = F.get(point, 1).cast("double"), F.get(point, 0).cast("double")
    else:
        raise ValueError("no coordinates: name the latitude and longitude columns or give point geometry")
    return df.withColumns({"latitude": y, "longitude": x})


def coerce_event_date(df: DataFrame, column: str, formats: list[str] | None = None) -> DataFrame:
    """Add ``date``: the day of a text or timestamp column, null where unreadable."""
    return df.withColumn("date", to_day(F.col(column), df.schema[column].dataType, formats))


def filter_valid_coords(df: DataFrame) -> DataFrame:
    return df.filter(
        F.col("date").isNotNull() & (F.abs("latitude") <= 90) & (F.abs("longitude") <= 180)
    )


def reject_reason(chosen: Column, kind: Column | None) -> Column:
    """The first check a row fails, null if it passes all: the filters of ``valid_incidents`` as one column."""
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    near = (F.abs("latitude") <= 90) & (F.abs("longitude") <= 180)
    fire = F.lit(True) if kind is None else is_fire(kind)
    failed = [~F.coalesce(chosen, F.lit(False)), F.col("date").isNull(), ~placed, ~near, ~fire]
    tests = list(zip(failed, fixed.REJECT_REASONS))
    return F.coalesce(*[F.when(test, F.lit(reason)) for test, reason in tests])


def is_fire(kind: Column) -> Column:
    """The word itself, or a first run of three digits within the fire codes."""
    text = kind.cast("string")
    named = F.coalesce(F.contains(F.lower(text), F.lit(fixed.FIRE_WORD)), F.lit(False))
    low, high = fixed.FIRE_CODE_RANGE
    code = F.regexp_extract(text, r"(\d{3})", 1).try_cast("int")
    return named | F.coalesce(code.between(low, high), F.lit(False))


def filter_fire_types(df: DataFrame, column: str | None) -> DataFrame:
    return df.filter(is_fire(F.col(column))) if column else df


def identity_columns(columns: list[str]) -> list[str]:
    wanted = {plain_name(n) for n in fixed.IDENTITY_NAMES}
    return [c for c in columns if plain_name(c) in wanted]


def dedupe_incidents(df: DataFrame, order: str = ROW_ID) -> DataFrame:
    """One row per incident identity: the one that came first.

    Two phases. The least row id of each identity is a hash aggregate: copies are folded before the
    shuffle, so a report repeated a billion times costs one row per map task, and no other column
    moves. Then the rows with these ids are picked by a semi-join on the id, which is unique and so has
    no hot key. ``order`` must be unique; a table without identity columns is one identity.
    """
    first = df.groupBy(*identity_columns(df.columns)).agg(F.min(order).alias("_first"))
    return df.join(first.select("_first"), F.col(order) == F.col("_first"), "left_semi")


def clean_weather(df: DataFrame) -> DataFrame:
    """One row per day: the mean of each readable metric."""
    typed = df.select(
        to_day(F.col("date"), df.schema["date"].dataType).alias("date"),
        *[to_number(F.col(m), df.schema[m].dataType).alias(m) for m in fixed.WEATHER_METRICS],
    )
    return (
        typed.filter(F.col("date").isNotNull())
        .groupBy("date")
        .agg(*[F.avg(m).alias(m) for m in fixed.WEATHER_METRICS])
    )


def fill_features(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(0, subset=columns or fixed.FEATURES)


def valid_incidents(
    df: DataFrame,
    fields: list[str] | None = None,
    values: list[str] | None = None,
    formats: list[str] | None = None,
    **override: str | None,
) -> DataFrame:
    """All cleaning steps before de-duplication; narrow, so one pass over the input."""
    roles = incident_roles(df.columns, **override)
    if not roles["date"]:
        raise ValueError("no incident date column found; name it")
    # Reading a date costs most, so the other text filters come first.
    out = filter_fire_types(filter_field_values(df, fields or [], values or []), roles["type"])
    out = coerce_coordinates(out, roles["lat"], roles["lon"])
    return filter_valid_coords(coerce_event_date(out, roles["date"], formats))


def judged_incidents(
    df: DataFrame,
    fields: list[str] | None = None,
    values: list[str] | None = None,
    formats: list[str] | None = None,
    **override: str | None,
) -> DataFrame:
    """All raw rows, typed, with ``reject_reason``: null for those that ``valid_incidents`` returns, else why not.

    The channel for what cleaning leaves out. It costs one pass and no shuffle: store it, or filter it.
    """
    roles = incident_roles(df.columns, **override)
    if not roles["date"]:
        raise ValueError("no incident date column found; name it")
    chosen = has_field_values(df, fields or [], values or [])
    out = coerce_event_date(coerce_coordinates(df, roles["lat"], roles["lon"]), roles["date"], formats)
    return out.withColumn("reject_reason", reject_reason(chosen, F.col(roles["type"]) if roles["type"] else None))


def reject_counts(df: DataFrame, **options) -> DataFrame:
    """``reason, n``: every reason and ``kept``, also those without rows; the counts add up to the rows of ``df``."""
    judged = judged_incidents(df, **options)
    cases = {reason: F.col("reject_reason") == reason for reason in fixed.REJECT_REASONS} | {"kept": F.col("reject_reason").isNull()}
    counts = judged.agg(*[F.count_if(test).alias(reason) for reason, test in cases.items()])
    named = F.array(*[F.struct(F.lit(reason).alias("reason"), F.col(reason).alias("n")) for reason in cases])
    return counts.select(F.inline(named))


def clean_incidents(df: DataFrame, **options) -> DataFrame:
    """Raw incidents -> clean ones. Adds a row id where the caller has not set one."""
    if ROW_ID not in df.columns:
        df = with_row_id(df)
    return dedupe_incidents(valid_incidents(df, **options))
