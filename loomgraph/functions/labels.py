"""Texts made of a record's fields, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, truncate

#: The lines of a subject's profile, and how a subject without a year of death is marked.
PROFILE = {"name": "Nome canonico: ", "years": "Anni: ", "born": "Anno di nascita: ", "died": "Anno di morte: ", "place": "Luogo di nascita: ", "surnames": "Nomi formali: ", "aliases": "Altre varianti dal testo: ", "role": "Ruolo: ", "notes": "Note biografiche:\n"}
ERA, LIVING = " d.C.", " (vivente)"


def canonical_chunk(path: Column, chunk_id: Column) -> Column:
    """ch_ and digits from the file's stem, else from the id; null without."""
    found = lambda s: F.nullif(F.regexp_extract(s, r"(ch_\d+)", 1), F.lit(""))
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.coalesce(found(stem), found(chunk_id))


def profile(name: Column, born: Column, died: Column, place: Column, surnames: Column, aliases: Column, role: Column, notes: Column) -> Column:
    """The profile of a subject, a line for each field that is there; a name is needed."""
    filled = lambda label, s: F.when(F.length(s) > 0, F.concat(F.lit(PROFILE[label]), s))
    b, d = born.cast("string"), died.cast("string")
    years = F.when(b.isNotNull() & d.isNotNull(), F.concat(F.lit(PROFILE["years"]), b, F.lit("–"), d, F.lit(ERA))).when(b.isNotNull(), F.concat(F.lit(PROFILE["born"]), b, F.lit(ERA + LIVING))).when(d.isNotNull(), F.concat(F.lit(PROFILE["died"]), d, F.lit(ERA)))
    named = F.when(F.length(F.trim(name)) > 0, F.concat(F.lit(PROFILE["name"]), name)).otherwise(F.raise_error(F.lit("a subject needs a name")).cast("string"))
    return F.concat_ws("\n", named, years, filled("place", place), filled("surnames", F.array_join(surnames, ", ")), filled("aliases", F.array_join(aliases, ", ")), filled("role", role), filled("notes", notes))


def chunk_message(chunk_id: Column, text: Column) -> Column:
    return F.concat(F.lit("chunk_id: "), chunk_id, F.lit("\n\nchunk_text:\n"), text)


def node_label(id_: Column, name: Column, kind: Column) -> Column:
    """name [type]  (id); the id alone for an unknown node, instead of a missing name, and ? for a missing type."""
    named = F.concat(F.coalesce(F.nullif(name, F.lit("")), id_), F.lit(" ["), F.coalesce(kind, F.lit("?")), F.lit("]"))
    return F.when(name.isNull() & kind.isNull(), id_).otherwise(F.concat(named, F.lit("  ("), id_, F.lit(")")))


def short_label(id_: Column, name: Column, kind: Column, limit: int = 60) -> Column:
    """name [type], cut with an ellipsis."""
    named = F.concat(F.coalesce(F.nullif(name, F.lit("")), id_), F.lit(" ["), F.coalesce(kind, F.lit("?")), F.lit("]"))
    cut = F.when(F.length(named) > limit, F.concat(F.substring(named, 1, limit - 1), F.lit("…"))).otherwise(named)
    return F.when(name.isNull() & kind.isNull(), id_).otherwise(cut)


def shrunk_path(path: Column) -> Column:
    """The path with _shrunk before the suffix of its file."""
    return F.regexp_replace(path, r"^(.*?[^/])(\.[^./]*)?$", "$1_shrunk$2")


def source_label(path: Column, root: Column) -> Column:
    """The path from the root on, with forward slashes; as it is outside the root."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    inside = F.startswith(plain, F.concat(root, F.lit("/")))
    return F.when(inside, F.substring(plain, F.length(root) + 2, F.length(plain))).otherwise(plain)


def per_hundred(count: Column, chunks: Column) -> Column:
    """A count for a hundred chunks; null without chunks."""
    return F.round(F.try_divide(count * 100.0, chunks), 2)


def pair_text(a: Column, b: Column, spans: int = 3, limit: int = 160) -> Column:
    """Two themes, structs of id, name, description and spans, as a judge reads them."""
    side = lambda mark, t: F.concat_ws(
        "\n", F.concat(F.lit(f"{mark}: "), t["id"].cast("string"), F.lit(" | "), t["name"]), F.coalesce(t["description"], F.lit("-")), F.array_join(F.transform(F.slice(t["spans"], 1, spans), lambda s: F.concat(F.lit("- "), truncate(s, limit))), "\n")
    )
    return F.concat_ws("\n\n", side("A", a), side("B", b))


def one_line(s: Column, limit: int) -> Column:
    """Collapsed text, cut to limit and three dots."""
    flat = collapse(s)
    return F.when(F.length(flat) > limit, F.concat(F.substring(flat, 1, limit), F.lit("..."))).otherwise(flat)
