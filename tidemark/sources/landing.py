"""Readers over landed provider payloads.

Fetching is outside the library: payload files land as
``<root>/<family>/<series_id>/<fetch_name>.json``. ``read_landed`` turns a folder of them
into one row per file (series id and fetch name taken from the path), ``classify_payloads``
labels each file, and the ``parse_*`` functions explode the good ones into rows. All of it
is one Spark read and column expressions: nothing goes through the driver, and a bad file
is quarantined for its own series instead of stopping the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.columns import (
    BAD_NAME_CHARS,
    apply_types,
    clean_column_names,
    clean_name,
    split_datetime,
    to_numeric,
    to_utc_ntz,
)

PAYLOAD_CLASSES = ("ok", "error", "quota", "corrupt")
# What the parsers add with ``rejects``: a record's place in its file, and its text.
REJECT_COLS = ["record_no", "record_text"]
# Leading characters skipped before looking at a payload's first character.
_LEADING = " \t\r\n\ufeff"


def _starts_with(text, ch: str):
    return F.ltrim(text, F.lit(_LEADING)).startswith(ch)


def _json_text(c):
    """Payload text as the JSON parser gets it: without leading white space or byte-order
    mark (the parser itself accepts white space but not the mark)."""
    return F.ltrim(F.col(c) if isinstance(c, str) else c, F.lit(_LEADING))


def landed_rows(df: DataFrame) -> DataFrame:
    """Whole-file text rows (batch or stream) -> ``file_path, series_id, fetch_name,
    payload, modified_at`` (when the file was written). The last two folders' names are
    decoded (the path is a URI)."""
    fp = F.col("_metadata.file_path")
    name = lambda pattern: F.url_decode(
        F.replace(F.regexp_extract(fp, pattern, 1), F.lit("+"), F.lit("%2B"))
    )
    return df.select(
        fp.alias("file_path"),
        name(r"([^/]+)/[^/]+$").alias("series_id"),
        name(r"([^/]+?)(\.[^./]*)?$").alias("fetch_name"),
        F.col("value").alias("payload"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``file_path, series_id, fetch_name, payload, modified_at``.

    ``path`` may be a folder or a glob such as ``landing/bars/*/*.json``. Whole-file text
    reading keeps multi-line JSON intact; files are packed into read tasks by Spark.
    """
    return landed_rows(spark.read.text(path, wholetext=True))


def classify_payloads(
    df: DataFrame,
    payload_col: str = "payload",
    status_col: str | None = None,
    expect: str | None = None,
) -> DataFrame:
    """Add ``payload_class`` (ok / error / quota / corrupt) and ``message``.

    * an object with an ``Error Message`` or ``error`` key (any case) is ``error``;
    * an object with an ``Information`` key (any case) is ``quota`` (a provider limit);
    * text that is not a JSON object or array, or an empty object, is ``corrupt``;
    * a valid top-level JSON array is ``ok`` (records are read by the parsers);
    * ``expect="array"`` (bar files): an object in place of the array is ``error``;
      ``expect="object"``: an array is ``corrupt``;
    * with ``status_col``, an HTTP status other than 200 is ``error``;
    * ``expect="csv"`` (table dumps): a header line with a separator is ``ok``, JSON text
      is a provider ``error``.

    Validation walks the text without building values (``json_array_length`` for arrays,
    ``json_object_keys`` for objects); the full map is parsed only for error and quota
    payloads, to read their message. Keys are matched by position in the lower-cased key
    array; no lambda function is evaluated.
    """
    if expect == "csv":
        return _classify_csv(df, payload_col)
    text = _json_text(payload_col)
    is_array = _starts_with(text, "[")
    staged = df.select(
        "*",
        is_array.alias("__is_arr"),
        F.when(is_array, F.json_array_length(text)).alias("__len"),
        # Keys of the lower-cased text: the same keys, in the same order, lower-cased.
        F.when(~is_array, F.json_object_keys(F.lower(text))).alias("__keys"),
    )
    has = lambda k: F.array_contains(F.col("__keys"), k)
    is_error = has("error message") | has("error")
    cls = F.when(F.col("__is_arr") & F.col("__len").isNull(), "corrupt")
    cls = cls.when(F.col("__is_arr"), "corrupt" if expect == "object" else "ok")
    cls = (
        cls.when(F.col("__keys").isNull() | (F.size("__keys") == 0), "corrupt")
        .when(is_error, "error")
        .when(has("information"), "quota")
    )
    cls = cls.otherwise("error" if expect == "array" else "ok")
    classified = staged.select("*", cls.alias("payload_class"))

    values = F.map_values(F.from_json(text, T.MapType(T.StringType(), T.StringType())))

    def value_of(key_lower: str):
        pos = F.array_position(F.col("__keys"), key_lower).cast("int")
        return F.when(pos > 0, F.element_at(values, pos))

    err = F.coalesce(value_of("error message"), value_of("error"), F.when(~F.col("__is_arr"), text))
    msg = F.when(F.col("payload_class") == "error", err).when(
        F.col("payload_class") == "quota", value_of("information")
    )
    if status_col is not None:
        bad_status = F.col(status_col).isNotNull() & (F.col(status_col) != 200)
        msg = F.when(bad_status, F.concat(F.lit("HTTP status "), F.col(status_col).cast("string"))).otherwise(msg)
        final_cls = F.when(bad_status, "error").otherwise(F.col("payload_class"))
    else:
        final_cls = F.col("payload_class")
    return classified.select(*df.columns, final_cls.alias("payload_class"), msg.alias("message"))


def _classify_csv(df: DataFrame, payload_col: str) -> DataFrame:
    """Table dumps: JSON text is a provider error (its message kept), text with a header
    line holding a separator is ``ok``, anything else is ``corrupt``."""
    text = F.col(payload_col)
    looks_json = _starts_with(text, "{") | _starts_with(text, "[")
    first_line = F.split(text, "\n", 2)[0]
    cls = (
        F.when(looks_json, "error")
        .when(F.instr(first_line, ",") > 0, "ok")
        .otherwise("corrupt")
    )
    return df.select("*", cls.alias("payload_class"), F.when(looks_json, text).alias("message"))


def split_quarantine(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good files, quarantined files) from the output of ``classify_payloads``.

    The ``parse_*`` functions take the classified frame as it is and skip bad payloads
    inside their generator; filtering on the class first would make the optimizer copy the
    whole classification into the filter condition.
    """
    ok = F.col("payload_class") == "ok"
    return classified.where(ok), classified.where(~ok)


def _carry(df: DataFrame, payload_col: str) -> list[str]:
    return [c for c in df.columns if c not in (payload_col, "payload_class", "message")]


def _when_ok(df: DataFrame, expr):
    """``expr`` for good payloads only (NULL, hence no generated rows, for the others)."""
    if "payload_class" in df.columns:
        return F.when(F.col("payload_class") == "ok", expr)
    return expr


def _rows_or_rejects(df: DataFrame, carry: list[str], generated, needed: str, rejects: bool) -> DataFrame:
    """The generated rows that have ``needed``; with ``rejects`` those of good files all."""
    kept = [F.col("payload_class")] if "payload_class" in df.columns else []
    rows = df.select(*carry, *kept, generated)
    if not rejects:
        return rows.where(F.col(needed).isNotNull()).drop("payload_class")
    return rows.where(F.col("payload_class") == "ok").drop("payload_class") if kept else rows


def parse_bars(df: DataFrame, payload_col: str = "payload", rejects: bool = False) -> DataFrame:
    """Top-level array of bar records -> one raw row per bar, every field the provider's
    text (S1). An element that is no object spoils no other.

    Elements without an opening or start time are left out; with ``rejects`` they stay, as
    rows without these times, and so does one such row for a file without elements. Every row
    then has ``record_no`` (the element's place from 0, null without elements) and
    ``record_text`` (the element as landed).
    """
    carry = _carry(df, payload_col)
    # The elements as text first: parsing records at once would lose a whole array for one
    # element of another kind. Outer generators throughout: for a plain one the optimizer
    # infers a size filter on the generator's input and pushes it below, parsing every
    # payload twice.
    elements = _when_ok(df, F.from_json(_json_text(payload_col), T.ArrayType(T.StringType())))
    kept = [F.col("payload_class")] if "payload_class" in df.columns else []
    rows = df.select(*carry, *kept, F.posexplode_outer(elements).alias("record_no", "__element"))
    record = F.when(_starts_with(F.col("__element"), "{"), F.from_json("__element", schemas.RAW_BAR))
    where = [F.col("record_no"), F.col("__element").alias("record_text")] if rejects else []
    bars = rows.select(*carry, *kept, *where, record.alias("__bar"))
    wanted = F.lit(True) if not kept else F.col("payload_class") == "ok"
    if not rejects:
        wanted = F.coalesce("__bar.time_period_start", "__bar.time_open").isNotNull()
    return bars.where(wanted).select(*carry, "__bar.*", *REJECT_COLS[: len(where)])


def shape_bars(raw: DataFrame, keep: Sequence[str] = ("series_id",)) -> DataFrame:
    """Raw bars -> the stored 14 bar columns (P1-P5): ISO text split into a DATE and a
    time-of-day text in UTC, prices and volume to DOUBLE, trade count to BIGINT (``12.0`` is
    the count 12)."""
    keep = [c for c in keep if c in raw.columns]
    split = split_datetime(raw, schemas.BAR_SPLITS, parse_text=True)
    count = to_numeric("trades_count") if dict(raw.dtypes)["trades_count"] == "string" else F.col("trades_count")
    counted = split.withColumn("trades_count", count)
    return apply_types(counted.select(*keep, *schemas.BAR_COLUMNS), schemas.BAR_TYPES)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Landed bar files -> shaped bars of the good files (S1 + P1-P5)."""
    return shape_bars(parse_bars(classify_payloads(read_landed(spark, path), expect="array")))


def explode_json_object(df: DataFrame, json_col: str, key: str = "key", value: str = "value") -> DataFrame:
    """A JSON object held as text -> one row per member: ``<other columns>, key, value``.

    Member values stay text (nested objects as JSON text). Text that is no object gives no
    rows.
    """
    carry = [c for c in df.columns if c != json_col]
    m = F.from_json(_json_text(json_col), T.MapType(T.StringType(), T.StringType()))
    return df.select(*carry, F.explode_outer(m).alias(key, value)).where(F.col(key).isNotNull())


def parse_keyed_series(
    df: DataFrame,
    payload_col: str = "payload",
    root_key: str = schemas.KEYED_ROOT,
    labels: Sequence[str] | None = tuple(schemas.OHLCV_LABELS),
    rejects: bool = False,
) -> DataFrame:
    """Object keyed by date under ``root_key`` -> one row per date.

    With ``labels`` the inner objects are pivoted to one text column per label, named by
    ``clean_name`` (``1. open`` -> ``1__open``); an absent label is NULL. With
    ``labels=None`` the inner object is kept as ``vals ARRAY<STRUCT<key, value>>`` sorted by
    key (not a MAP, which set operations refuse). A missing root key gives no rows; with
    ``rejects`` a good file without entries gives one row without a date, and every row has
    ``record_no`` (the entry's place from 0) and ``record_text`` (the entry as an object).
    """
    carry = _carry(df, payload_col)
    schema = T.StructType([T.StructField(root_key, T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType())))])
    parsed = _when_ok(df, F.from_json(_json_text(payload_col), schema)[root_key])
    entries = F.posexplode_outer(parsed).alias("record_no", "date", "__kv")
    rows = _rows_or_rejects(df, carry, entries, "date", rejects)
    entry = F.when(F.col("date").isNotNull(), F.to_json(F.create_map("date", "__kv")))
    where = [F.col("record_no"), entry.alias("record_text")] if rejects else []
    if labels is None:
        return rows.select(*carry, "date", F.sort_array(F.map_entries("__kv")).alias("vals"), *where)
    return rows.select(*carry, "date", *[F.col("__kv")[lab].alias(clean_name(lab)) for lab in labels], *where)


def parse_indicator(df: DataFrame, payload_col: str = "payload", rejects: bool = False) -> DataFrame:
    """Indicator payload -> ``<carry>, name, interval, unit, date, value``.

    The metadata fields are kept as columns (the reference drops them). Records come from
    the ``data`` array; a payload that is itself an array of records is used whole, and so
    is an object without ``data``: its ``date`` and ``value`` are one record, or columns of
    records when they are arrays. ``date`` is the UTC wall clock (TIMESTAMP_NTZ), ``value``
    a coerced DOUBLE. With ``rejects`` a good file without records gives one row without a
    date, and every row has ``record_no`` (from 0) and ``record_text`` (its date and value).
    """
    carry = _carry(df, payload_col)
    text = _json_text(payload_col)
    is_array = _starts_with(text, "[")
    kept = ["payload_class"] if "payload_class" in df.columns else []
    parsed = df.select(
        *carry,
        *kept,
        F.when(~is_array, F.from_json(text, schemas.INDICATOR_PAYLOAD)).alias("__obj"),
        F.when(is_array, F.from_json(text, T.ArrayType(schemas.INDICATOR_RECORD))).alias("__arr"),
    )
    column = lambda c: F.when(
        _starts_with(F.col(c), "["), F.from_json(c, T.ArrayType(T.StringType()))
    ).otherwise(F.array(c))
    whole = F.when(
        F.col("__obj.date").isNotNull(),
        F.arrays_zip(column("__obj.date").alias("date"), column("__obj.value").alias("value")),
    )
    records = _when_ok(parsed, F.coalesce(F.col("__arr"), F.col("__obj.data"), whole))
    meta = [F.col("__obj")[f].alias(f) for f in ("name", "interval", "unit")]
    with_meta = parsed.select(*carry, *kept, *meta, records.alias("__records"))
    rows = _rows_or_rejects(
        with_meta,
        [*carry, "name", "interval", "unit"],
        F.posexplode_outer("__records").alias("record_no", "__r"),
        "__r",
        rejects,
    )
    where = [F.col("record_no"), F.to_json("__r").alias("record_text")] if rejects else []
    return rows.select(
        *carry,
        "name",
        "interval",
        "unit",
        to_utc_ntz(F.col("__r.date")).alias("date"),
        to_numeric(F.col("__r.value")).alias("value"),
        *where,
    )


# Marks that stand in a CSV text while it is cut into records; characters that no provider's
# text holds. The last one is no control character: the parser strips those as blanks.
_RECORD_END, _EDGE, _TWO_QUOTES, _FIELDS_END = "\x1e", "\x02", "\x03", "\ue000"

# A text's pieces: a field in quotes (which begins after a separator and ends before one; two
# quotes in a row are one mark here), other text, a line feed, a quote that belongs to text.
# No group is repeated, so the matcher neither recurses nor reads a character twice.
_QUOTED = rf'(?<=[,\n \t{_TWO_QUOTES}]|\A)"[^"]*+"(?=[ \t]*+[,\r\n{_TWO_QUOTES}]|[ \t]*+\z)'
_PIECES = rf'{_QUOTED}|[^"\n]++|\n|"'


def _records(text: Column) -> Column:
    """The records of a CSV text: cut at line feeds outside quoted fields."""
    short = F.replace(text, F.lit('""'), F.lit(_TWO_QUOTES))
    pieces = F.array_join(F.regexp_extract_all(short, F.lit(f"({_PIECES})"), F.lit(1)), _EDGE * 2)
    cut = F.replace(F.concat(F.lit(_EDGE), pieces, F.lit(_EDGE)), F.lit(f"{_EDGE}\n{_EDGE}"), F.lit(_RECORD_END))
    whole = F.replace(F.replace(cut, F.lit(_EDGE), F.lit("")), F.lit(_TWO_QUOTES), F.lit('""'))
    return F.when(F.contains(text, F.lit('"')), F.split(whole, _RECORD_END)).otherwise(F.split(text, "\n"))


_MOST_FIELDS = 1 << 20  # of one record with quotes
_LISTED = 64  # fields up to which each is named in the plan


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _read_fields(df: DataFrame, record: str, width: str, widths: Sequence[int], out: str) -> DataFrame:
    """Add ``out``: the fields of the CSV record in column ``record``. A record without quotes
    is split at its commas; one with quotes is read by Spark's CSV parser, and gives null if
    they don't pair up.

    The parser needs a schema, so there is one for each of ``widths`` (the distinct values of
    column ``width``, the most fields the file's header can have, among files with quotes). A
    last field marks the end of the record: a record with more fields than its schema loses the
    mark and gives null.
    """
    bare = F.when(~F.contains(F.col(record), F.lit('"')), F.split(record, ","))
    if not widths:
        return df.withColumn(out, F.split(record, ","))
    sound = (_count(F.col(record), '"') % 2 == 0) & (_count(F.col(record), ",") < _MOST_FIELDS)
    marked = F.when(F.contains(F.col(record), F.lit('"')) & sound, F.concat(F.col(record), F.lit("," + _FIELDS_END)))
    options = {
        "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true", "maxColumns": str(_MOST_FIELDS + 2),
    }
    parsed, found = [], None
    for k, n in enumerate(widths):
        schema = ", ".join(f"c{i} string" for i in range(n + 1))
        read = F.when(F.col(width) == n, F.from_csv(marked, schema, options))
        if n > _LISTED:  # by way of JSON, so that the plan does not name every field
            read = F.to_json(read, {"ignoreNullFields": "false"})
        parsed.append(read.alias(f"__read_{k}"))
        row = F.col(f"__read_{k}")
        if n > _LISTED:
            fields = F.map_values(F.from_json(row, T.MapType(T.StringType(), T.StringType())))
        else:
            fields = F.array(*[row[f"c{i}"] for i in range(n + 1)])
        found = F.when(F.col(width) == n, fields) if found is None else found.when(F.col(width) == n, fields)
    # The parsed records are columns of their own: they are read once, not once a field. An
    # empty field is null to the parser.
    rows = df.select("*", *parsed).select(*df.columns, F.array_join(found, _RECORD_END, "").alias("__joined"))
    end = _RECORD_END + _FIELDS_END
    read = F.when(F.contains(F.col("__joined"), F.lit(end)), F.split(F.substring_index("__joined", end, 1), _RECORD_END))
    return rows.select(*df.columns, F.coalesce(bare, read).alias(out))


def parse_table_dump(
    df: DataFrame, payload_col: str = "payload", rejects: bool = False, quoted: bool = True
) -> DataFrame:
    """CSV text with a header line, the date first -> ``<carry>, date, vals``.

    Every file may have its own columns: the header is read and its names cleaned (P8) once
    per file, then zipped with each record's fields into ``vals ARRAY<STRUCT<field, value>>``
    sorted by field. Values stay the provider's text in the raw table (as for the daily bars,
    D5); ``dump_values`` and the per-series views type them with ``to_numeric``. Commas and
    line breaks inside double quotes belong to the field; records with quotes are read by
    Spark's CSV parser, blanks around their fields are dropped. For that the distinct widths of
    the headers of files with quotes are looked up first (one small job; none with
    ``quoted=False``, which takes quotes for text). A record with another number
    of fields than the header, or whose quotes don't pair up, is left out, and so are all
    records under a header in which two names are the same once cleaned. With ``rejects`` it stays, without a date (as do records whose first
    field is no date, and one row for a file without records), and every row has ``record_no``
    (the header is 0) and ``record_text``.
    """
    carry = _carry(df, payload_col)
    kept = ["payload_class"] if "payload_class" in df.columns else []
    text = F.rtrim(F.col(payload_col), F.lit(" \t\r\n"))
    records = _records(text) if quoted else F.split(text, "\n")
    has_quotes = F.contains(F.col(payload_col), F.lit('"')).alias("__quoted")
    split = df.select(*carry, *kept, has_quotes, _when_ok(df, records).alias("__all"))
    head = F.trim(F.col("__all")[0], F.lit(" \t\r\n\ufeff"))
    headed = split.withColumn("__head", head)
    # At most one field more than there are commas.
    headed = headed.withColumn("__width", _count(F.col("__head"), ",") + 1)
    widths: list[int] = []
    if quoted:
        found = headed.where("__quoted").select("__width").distinct().collect()
        widths = sorted(r[0] for r in found if r[0] is not None)
    if widths:
        named = _read_fields(headed, "__head", "__width", widths, "__named")
        joined = F.array_join("__named", _RECORD_END)
    else:
        named, joined = headed, F.replace(F.col("__head"), F.lit(","), F.lit(_RECORD_END))
    tight = F.regexp_replace(joined, rf"[ \t\r\n]*{_RECORD_END}[ \t\r\n]*", _RECORD_END)
    names = F.split(F.translate(tight, "".join(BAD_NAME_CHARS), "_" * len(BAD_NAME_CHARS)), _RECORD_END)
    named = named.withColumn("__names", names)
    clean = F.col("__names")
    staged = named.select(
        *carry,
        *kept,
        F.when(F.size(F.array_distinct(clean)) == F.size(clean), clean).alias("__hdr"),
        "__width",
        F.slice("__all", F.lit(2), F.greatest(F.size("__all") - 1, F.lit(0))).alias("__lines"),
    )
    lines = staged.select(*carry, *kept, "__hdr", "__width", F.posexplode_outer("__lines").alias("record_no", "record_text"))
    if kept:
        lines = lines.where(F.col("payload_class") == "ok")
    blank = F.length(F.trim(F.col("record_text"), F.lit(" \t\r"))) == 0
    lines = lines.where(F.col("record_text").isNull() | ~blank if rejects else ~blank).select(
        *carry, "__hdr", "__width", (F.col("record_no") + 1).alias("record_no"),
        F.rtrim(F.col("record_text"), F.lit("\r")).alias("record_text"),
    )
    rows = _read_fields(lines, "record_text", "__width", widths, "__fields")
    fits = F.coalesce(F.size("__fields") == F.size("__hdr"), F.lit(False))
    n = F.greatest(F.size("__hdr") - 1, F.lit(0))
    zipped = F.arrays_zip(
        F.slice("__hdr", F.lit(2), n).alias("field"), F.slice("__fields", F.lit(2), n).alias("value")
    )
    date = F.when(fits, F.col("__fields")[0].try_cast("date"))
    if rejects:
        return rows.select(*carry, date.alias("date"), F.sort_array(zipped).alias("vals"), "record_no", "record_text")
    if not widths:
        return rows.where(fits).select(*carry, date.alias("date"), F.sort_array(zipped).alias("vals"))
    # Selected inside a generator: a filter would be pushed down with the whole parse in it.
    row = F.when(fits, F.array(F.struct(date.alias("date"), F.sort_array(zipped).alias("vals"))))
    rows = rows.select(*carry, F.explode_outer(row).alias("__row")).where("__row is not null")
    return rows.select(*carry, "__row.date", "__row.vals")


def dump_values(rows: DataFrame, vals: str = "vals") -> DataFrame:
    """Parsed dump rows -> one typed row per field: ``<other columns>, field, value DOUBLE``."""
    other = [c for c in rows.columns if c != vals]
    long = rows.select(*other, F.inline_outer(vals)).where(F.col("field").isNotNull())
    return long.select(*other, "field", to_numeric("value").alias("value"))


def read_table_dump(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", **options
) -> DataFrame:
    """A provider table dump (rows by date) with an explicit schema and cleaned names."""
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return clean_column_names(reader.load(path))


def melt_values(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Wide value columns -> ``ids, field, value`` rows (row-local ``unpivot``)."""
    cast = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return cast.unpivot(list(id_cols), list(value_cols), "field", "value")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table."""
    return spark.table(name)
