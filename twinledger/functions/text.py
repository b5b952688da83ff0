"""Text functions for names, descriptions and tokens.

A *token* is a placeholder such as ``$[Stage]``. Every function that writes one
leaves a value alone that already carries a token, so running a job twice gives
what running it once gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Placeholders written into definitions.
TOKEN_MARK = "$["
STAGE_TOKEN = "$[Stage]"
FILE_STAGE_TOKEN = "$[FPStage]_"

# Characters that a folder name loses.
SLUG_REMOVED = "*:().[],;{}"

# Fixed value: new descriptions must stay under this many characters.
DESCRIPTION_LIMIT = 100


def has_token(value: Column, token: str = TOKEN_MARK) -> Column:
    return value.contains(token)


def identifier_parts(name: Column) -> dict[str, Column]:
    """``schema.table`` taken apart, with its lower and upper forms."""
    parts = F.split(name, r"\.")
    return {
        "schema_name": F.element_at(parts, 1),
        "table_name": F.try_element_at(parts, F.lit(2)),
        "lower_name": F.lower(name),
        "upper_name": F.upper(name),
    }


def split_list(text: Column, dtype: str = "string") -> Column:
    """A comma list as an array, each item trimmed and cast."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item).cast(dtype))


def split_names(names: str | Sequence[str]) -> list[str]:
    """A Python comma list or sequence as trimmed, non-empty names."""
    items = names.split(",") if isinstance(names, str) else names
    return [item.strip() for item in items if item.strip()]


def slug(
    name: Column,
    lower: bool = False,
    removed: str = SLUG_REMOVED,
    trim_dashes: bool = True,
    dropped: Sequence[str] = (),
) -> Column:
    """A name as its folder spells it: space to dash, slash to underscore.

    Stars and colons go first, then trailing dashes, then the other characters;
    a dash that ends up last only after that stays. ``dropped`` texts are cut
    out at the end.
    """
    value = F.translate(F.lower(name) if lower else name, " *:", "-")
    if trim_dashes:
        value = F.rtrim(value, F.lit("-"))
    value = F.translate(value, "/" + removed, "_")
    for text in dropped:
        value = F.replace(value, F.lit(text), F.lit(""))
    return value


def insert_token(value: Column, before: str, token: str = STAGE_TOKEN) -> Column:
    """``token`` put in front of the first ``before``; no ``before``, no change."""
    at = F.instr(value, F.lit(before))
    inserted = F.concat(
        F.substring(value, F.lit(1), at - 1), F.lit(token), F.substring(value, at, F.length(value))
    )
    return F.when(has_token(value) | (at == 0), value).otherwise(inserted)


def rebuild_text(description: Column, folder: Column, token: str = STAGE_TOKEN) -> Column:
    """The part before the first dash, then ``- ``, the folder and the token."""
    head = F.substring_index(description, "-", 1)
    return F.when(has_token(description, token), description).otherwise(
        F.concat(head, F.lit("- "), folder, F.lit(token))
    )


def file_path() -> Column:
    """The path of a row's file as it is named, without percent codes."""
    # url_decode takes a plus for a blank, which it is not in a path
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def folder_of(path: Column) -> Column:
    """The last part of a path but for its extension."""
    return F.element_at(F.split(path, "[/.]"), -2)


def append_suffix(value: Column, suffix: str = STAGE_TOKEN, guard: str | None = None) -> Column:
    """``value`` with ``suffix``, unless it holds ``guard`` (the suffix itself)."""
    return F.when(has_token(value, guard or suffix), value).otherwise(
        F.concat(value, F.lit(suffix))
    )


def fill_default(value: Column, default: str) -> Column:
    """``default`` where the value is absent or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def prefix_by_type(
    kind: Column,
    value: Column,
    prefixes: Sequence[tuple[str, str]],
    onboarded: str,
) -> Column:
    """Prefix chosen by the first type text that ``kind`` contains.

    Values that hold the prefix or the ``onboarded`` mark stay; in the others
    spaces become dashes. A kind that no text fits leaves the value alone.
    """
    dashed = F.replace(value, F.lit(" "), F.lit("-"))
    result = None
    for text, prefix in prefixes:
        named = F.when(
            value.contains(onboarded) | value.contains(prefix), value
        ).otherwise(F.concat(F.lit(prefix), dashed))
        hit = kind.contains(text)
        result = F.when(hit, named) if result is None else result.when(hit, named)
    return value if result is None else result.otherwise(value)


def fits_length(value: Column, limit: int = DESCRIPTION_LIMIT) -> Column:
    return F.length(value) < limit


def abbreviation_base(name: Column) -> Column:
    """First letter of each ``.`` or ``_`` part, without the first letter."""
    letters = F.transform(F.split(name, "[._]"), lambda part: F.substring(part, 1, 1))
    return F.substr(F.array_join(letters, ""), F.lit(2))


def line_value(text: Column, label: str) -> Column:
    """What follows ``label:`` in the last line that starts with the label.

    The value runs from the first colon to the second one and is trimmed.
    """
    lines = F.filter(F.split(text, "\r?\n"), lambda line: line.startswith(label + ":"))
    last = F.try_element_at(lines, F.lit(-1))
    return F.trim(F.try_element_at(F.split(last, ":"), F.lit(2)))
