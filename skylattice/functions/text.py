"""Text, number and format functions with the inputs' own rules for bad values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def drop_invalid(data: bytes | None) -> str | None:
    """UTF-8 with bad bytes and NULs dropped one at a time. Sequences count as good by their lead byte's class and continuation bytes."""
    if data is None:
        return None
    out, i = bytearray(), 0
    while i < len(data):
        lead = data[i]
        n = 1 if lead < 0x80 else 2 if 0xC0 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF8 else 0
        part = data[i : i + n]
        if n and lead and len(part) == n and all(0x80 <= b < 0xC0 for b in part[1:]):
            out += part
            i += n
        else:
            i += 1
    return out.decode("utf-8", "replace")


def latin1_repair(data: bytes | None) -> str | None:
    """UTF-8 in which bytes that don't belong to a well-formed sequence are read as Latin-1."""
    if data is None:
        return None
    out, i = [], 0
    while i < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[i : i + n].decode("utf-8"))
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(chr(data[i]))
            i += 1
    return "".join(out)


def _udf(f):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else f(bytes(v)))

    return run


def sanitize(data: Column) -> Column:
    """drop_invalid over a binary column; valid input without NULs stays in the JVM."""
    text = data.cast("string")
    return F.when(F.is_valid_utf8(text) & ~F.contains(text, F.lit("\u0000")), text).otherwise(_udf(drop_invalid)(data))


def repair(data: Column) -> Column:
    text = data.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(_udf(latin1_repair)(data))


def trim(s: Column) -> Column:
    return F.btrim(s, F.lit(" \t\r\n"))


def parse_int(s: Column) -> Column:
    """The leading integer of a string as C reads it, null for none: '12abc' is 12."""
    return F.regexp_extract(s, r"^[ \t\n\r\f\x0B]*([+-]?[0-9]+)", 1).try_cast("int")


def parse_double(s: Column) -> Column:
    return F.regexp_extract(s, r"^[ \t\n\r\f\x0B]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)", 1).try_cast("double")


def parse_bool(s: Column) -> Column:
    return F.coalesce(s.isin("1", "yes", "true"), F.lit(False))


def or_null(s: Column) -> Column:
    return F.when(F.length(s) > 0, s)


def accuracy(code: Column) -> tuple[Column, Column]:
    """The horizontal and the vertical letter of an accuracy code; empty where it is too short."""
    return F.substring(code, 1, 1), F.substring(code, 2, 1)


def sequence_path(seq: Column) -> Column:
    return F.format_string("%03d/%03d/%03d", F.floor(seq / 1_000_000).cast("long"), F.floor(seq / 1000).cast("long") % 1000, seq % 1000)


def state_time(s: Column) -> Column:
    """The time of a state file, whose colons are escaped, in UTC."""
    return F.to_timestamp(F.replace(s, F.lit("\\:"), F.lit(":")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def estimated_sequence(tip: Column, tip_time: Column, at: Column, margin_s: int = 3 * 86400) -> Column:
    """The minute sequence to resume from for data of time `at` (seconds), a margin early, 0 at least."""
    return F.greatest(F.lit(0).cast("long"), tip - F.floor(F.greatest(F.lit(0).cast("long"), tip_time - at + margin_s) / 60))


def json_limit(doc: Column, name: str) -> Column:
    """struct<value, unit, reference> of a nested altitude limit; numbers may be quoted, what is absent is null."""
    get = lambda k: F.get_json_object(doc, f"$.{name}.{k}")
    return F.struct(get("value").try_cast("double").alias("value"), get("unit").try_cast("int").alias("unit"), get("referenceDatum").try_cast("int").alias("reference"))


def human_count(n: Column) -> Column:
    """A count with one digit after the point, cut and not rounded, and K, M or B; as it is below a thousand."""
    out = n.cast("string")
    for size, letter in ((10**3, "K"), (10**6, "M"), (10**9, "B")):
        tenths = F.floor(n / F.lit(size // 10)).cast("long")
        out = F.when(n >= size, F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(letter))).otherwise(out)
    return out


def duration(seconds: Column) -> Column:
    """H:MM:SS, M:SS below an hour, seconds with a tenth below a minute."""
    whole = F.floor(seconds).cast("long")
    h, m, s = F.floor(whole / 3600).cast("long"), F.floor(whole % 3600 / 60).cast("long"), whole % 60
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(F.format_string("%d:%02d", m, s))


def csv_field(s: Column) -> Column:
    """A field in quotes where it holds a comma, a quote or a line end; quotes are doubled, null is empty."""
    text = F.coalesce(s, F.lit(""))
    return F.when(text.rlike('[",\\r\\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def shell_argument(s: Column) -> Column:
    """In single quotes; a single quote within leaves them and comes back."""
    return F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("'\\''")), F.lit("'"))


def markup(s: Column) -> Column:
    """Without characters that begin markup; null is empty."""
    out = F.coalesce(s, F.lit(""))
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(c), F.lit(entity))
    return out
