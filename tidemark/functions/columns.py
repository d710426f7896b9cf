"""Column expressions: parsing, typing and renaming.

Everything here returns a ``Column`` or a re-projected ``DataFrame`` built from Spark's
own expressions, so it stays inside whole-stage code generation. No Python UDFs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Characters replaced by "_" in column names, in the reference's order.
BAD_NAME_CHARS = [
    " ", "!", "@", "#", "$", "%", "^", "&", "*", "(", ")", "+", "=", "{", "}",
    "[", "]", "|", "\\", ":", ";", '"', "'", "<", ">", ",", ".", "?", "/",
]

# Text accepted as a number: optional sign, digits with an optional point, or a point and
# digits, an optional exponent, or inf/infinity; surrounding white space allowed. This is
# the set a coercing text-to-number parser takes; hex, digit separators, type suffixes
# such as "4d" and the word "nan" are refused (they become NULL).
NUMERIC_TEXT = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
)

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(c: ColumnOrName) -> Column:
    """Text to DOUBLE; text that is not a plain decimal number becomes NULL.

    ``try_cast`` alone is too lenient (it takes "4d", "3f", "0x1p3"), so a pattern guard
    decides first. NaN never comes out: "nan" is refused by the guard.
    """
    v = _col(c).cast("string")
    # The cast itself trims surrounding white space.
    return F.when(v.rlike(NUMERIC_TEXT), v.try_cast("double"))


# A time of day followed by a zone: Z, UTC or a numeric offset.
ZONED_TEXT = r"(?i)[T ]\d{1,2}:\d{2}(:\d{2}(\.\d*)?)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)\s*$"


def to_utc_ntz(c: ColumnOrName) -> Column:
    """ISO-8601 text to the UTC wall clock as TIMESTAMP_NTZ.

    Text with a zone (``Z`` or an offset) is parsed to an instant, and its epoch
    microseconds added to the NTZ epoch give the UTC wall clock with no DST ambiguity. Text
    without a zone (``2024-01-02``) is a wall clock already and is read as written. Neither
    depends on the session time zone. Bad text -> NULL.
    """
    text = _col(c).cast("string")
    instant = text.try_cast("timestamp")
    zoned = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH_NTZ))
    # Fast path for the usual provider form: a trailing Z already is UTC, and the NTZ cast
    # reads the wall clock while ignoring the zone, so one cast suffices.
    utc = text.endswith("Z") | text.endswith("z")
    return (
        F.when(utc, text.try_cast("timestamp_ntz"))
        .when(text.rlike(ZONED_TEXT), zoned)
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def time_of_day(ts: ColumnOrName) -> Column:
    """``HH:mm:ss`` with ``.ffffff`` only when the microseconds are not zero."""
    # One formatting call; a zero fraction is cut off as text (NULL stays NULL).
    full = F.date_format(_col(ts), "HH:mm:ss.SSSSSS")
    return F.when(full.endswith(".000000"), F.substring(full, 1, 8)).otherwise(full)


def date_text(d: ColumnOrName) -> Column:
    """Date to ``yyyy-MM-dd`` text."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def split_datetime(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    parse_text: bool = True,
) -> DataFrame:
    """Split timestamps into a DATE column and a time-of-day text column.

    ``columns`` maps a source column to ``(date_name, time_name)``. With ``parse_text`` the
    source is ISO text parsed in UTC; otherwise it is already a timestamp. A source whose
    name is reused as an output is replaced, as the reference overwrites its time columns.
    One projection, whatever the number of columns.
    """
    # Parse each source once into its own column; the optimizer does not inline an
    # expensive expression that is used several times, so the parse runs once per row.
    parsed = {src: f"__ts{i}" for i, src in enumerate(columns)}
    staged = df.select("*", *[
        (to_utc_ntz(src) if parse_text else F.col(src)).alias(tmp) for src, tmp in parsed.items()
    ])
    outputs: dict[str, Column] = {}
    for src, (date_name, time_name) in columns.items():
        ts = F.col(parsed[src])
        outputs[date_name] = F.to_date(ts)
        outputs[time_name] = time_of_day(ts)
    keep = [F.col(c) for c in df.columns if c not in outputs]
    return staged.select(*keep, *[col.alias(name) for name, col in outputs.items()])


def apply_types(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast named columns in one projection (P5). A value that does not fit becomes NULL.

    ``spec`` maps column -> Spark SQL type name. Columns not in ``spec`` pass unchanged and
    the column order is kept. ``double`` columns use ``to_numeric`` for text input so the
    result matches a coercing parser. Unknown columns raise before any job runs.
    """
    missing = [c for c in spec if c not in df.columns]
    if missing:
        raise ValueError(f"apply_types: no such column(s): {missing}")
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        if c not in spec:
            cols.append(F.col(c))
            continue
        target = spec[c]
        if target == "double" and types[c] == "string":
            cols.append(to_numeric(c).alias(c))
        else:
            cols.append(F.col(c).try_cast(target).alias(c))
    return df.select(*cols)


def clean_name(name: str) -> str:
    return name.translate(str.maketrans({ch: "_" for ch in BAD_NAME_CHARS}))


def clean_column_names(df: DataFrame) -> DataFrame:
    """Replace the fixed set of bad characters in every column name with ``_``.

    Pure metadata (a ``toDF`` rename). Two names that clean to the same text raise, since
    Spark itself would accept the duplicate and fail later on use.
    """
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, cleaned in zip(df.columns, new):
        key = cleaned.lower()
        if key in seen:
            raise ValueError(
                f"clean_column_names: {seen[key]!r} and {old!r} both become {cleaned!r}"
            )
        seen[key] = old
    return df.toDF(*new)


def join_nonempty(sep: str, *parts: ColumnOrName) -> Column:
    """Concatenate the non-empty parts with ``sep`` (P15, P16 without the empty-part quirk)."""
    cleaned = [F.when(F.length(_col(p)) > 0, _col(p)) for p in parts]
    return F.concat_ws(sep, *cleaned)
