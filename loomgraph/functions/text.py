"""Text scalars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ligatures and their letters in the order of replacement; accented letters and their plain ones; stop words of theme names.
LIGATURES = {"ﬄ": "ffl", "ﬃ": "ffi", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl"}
ACCENTED, PLAIN = "àáâäãåèéêëìíîïòóôöõùúûüçñýÀÁÂÄÃÅÈÉÊËÌÍÎÏÒÓÔÖÕÙÚÛÜÇÑÝ", "aaaaaaeeeeiiiiooooouuuucnyAAAAAAEEEEIIIIOOOOOUUUUCNY"
THEME_STOP = "e ed o di del dei della delle degli lo la il i le gli un uno una come con a ad al ai alla alle da dal in nel nella su sul per tra fra che non se".split()


def collapse(s: Column) -> Column:
    """White space runs as one blank, trimmed."""
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def normalise_characters(s: Column) -> Column:
    """Ligatures spelled out, no-break spaces as blanks, zero-width characters gone."""
    for ligature, letters in LIGATURES.items():
        s = F.replace(s, F.lit(ligature), F.lit(letters))
    return F.regexp_replace(F.translate(s, " ", " "), "[​﻿]", "")


def ligatures(s: Column) -> Column:
    return F.regexp_count(s, F.lit("[" + "".join(LIGATURES) + "]"))


def dehyphenate(s: Column) -> Column:
    """Words broken at a line end are joined; a double hyphen stays."""
    return F.regexp_replace(s, r"(?U)(?<=[\p{Alnum}])-[ \t]*\n[ \t]*(?=\w)", "")


def broken_words(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"(?U)(?<=[\p{Alnum}])-[ \t]*\n[ \t]*(?=\w)"))


def name_norm(s: Column) -> Column:
    return F.lower(collapse(s))


def split_id(id_: Column, kind: Column) -> Column:
    return F.concat(id_, F.lit("__"), F.lower(kind))


def without_split(id_: Column) -> Column:
    return F.regexp_replace(id_, r"(?i)__(event|theme|phase|person|place|work|era|reflection)$", "")


def edge_key(source: Column, kind: Column, target: Column, role: Column) -> Column:
    return F.concat_ws("|", source, kind, target, role)


def strip_accents(s: Column) -> Column:
    return F.translate(s, ACCENTED, PLAIN)


def slug(s: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(F.lower(strip_accents(s)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out == "", "tema").otherwise(out)


def theme_tokens(id_: Column, name: Column) -> Column:
    """The set of words of a theme, without accents and stop words."""
    words = F.split(F.lower(strip_accents(F.concat_ws(" ", without_split(id_), name))), "[^a-z0-9]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: (w != "") & ~w.isin(THEME_STOP))))


def ordinal(chunk_id: Column) -> Column:
    """The first whole number in a chunk's id, else null."""
    return F.regexp_extract(chunk_id, "([0-9]+)", 1).try_cast("long")


def truncate(s: Column, limit: int) -> Column:
    """Collapsed text, cut to limit with an ellipsis; no cut at zero or below."""
    flat = collapse(s)
    return flat if limit <= 0 else F.when(F.length(flat) > limit, F.concat(F.rtrim(F.substring(flat, 1, limit - 1)), F.lit("…"))).otherwise(flat)


def strip_thinking(s: Column) -> Column:
    """Text without think blocks; an open block drops the rest."""
    return F.trim(F.regexp_replace(s, r"(?is)<\s*think\s*>.*?(<\s*/\s*think\s*>|\z)", ""))


def reply_json(s: Column) -> Column:
    """The outermost braces of a model's reply, without think blocks."""
    return F.nullif(F.regexp_extract(strip_thinking(s), r"(?s)\{.*\}", 0), F.lit(""))


def clock(seconds: Column) -> Column:
    """mm:ss, or h:mm:ss from an hour."""
    t = F.greatest(F.round(seconds).cast("long"), F.lit(0))
    h, m, s = F.floor(t / 3600).cast("long"), F.floor(t % 3600 / 60).cast("long"), t % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, s)).otherwise(F.format_string("%02d:%02d", m, s))


def duration(seconds: Column) -> Column:
    """12.3s, 4m 05s or 1h 02m 03s."""
    t = F.floor(seconds).cast("long")
    h, m, s = F.floor(t / 3600).cast("long"), F.floor(t % 3600 / 60).cast("long"), t % 60
    return F.when(seconds < 60, F.format_string("%.1fs", seconds.cast("double"))).when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s)).otherwise(F.format_string("%dm %02ds", m, s))


def percent(part: Column, whole: Column) -> Column:
    """Percent to two places, null of nothing."""
    return F.round(100 * F.try_divide(part.cast("double"), whole.cast("double")), 2)


def context(s: Column, start: Column, stop: Column, radius: int = 40) -> Column:
    """The characters from radius before start (from 0) to radius after stop."""
    left = F.greatest(start - radius, F.lit(0))
    return F.substring(s, left + 1, stop + radius - left)


def digit_words(s: Column) -> Column:
    """Words that mix digits with other letters."""
    return F.size(F.filter(F.regexp_extract_all(s, F.lit(r"[A-Za-z0-9_]*[0-9]+[A-Za-z0-9_]*"), F.lit(0)), lambda x: ~F.rlike(x, F.lit("^[0-9]+$"))))


def lonely_digits(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"(?m)(^|\s)[0-9]{1,3}(?=\s|$)"))


def repeated_signs(s: Column) -> Column:
    """Runs of three or more of one sign."""
    return F.regexp_count(s, F.lit(r"([.,;:!?…])\1{2,}"))


def isolated_capitals(s: Column) -> Column:
    return F.regexp_count(s, F.lit(r"(?<=[a-zà-ÿ])[A-ZÀ-Þ](?=[\s.,;:!?])"))
