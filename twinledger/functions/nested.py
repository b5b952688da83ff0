"""Edits inside documents: JSON text, nested structs, lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

OBJECT = "map<string, variant>"


def json_merge(base: Column, update: Column) -> Column:
    """Shallow merge of two JSON objects; the update's keys win.

    Values stay variants on the way: texts and nested values come out as they
    went in, numbers in their shortest form (``1.50`` as ``1.5``). Keys keep the
    base's order, new ones follow. A side that is NULL or no JSON object adds
    nothing; if neither is one, the base comes back as it is.
    """
    read_old, read_new = F.from_json(base, OBJECT), F.from_json(update, OBJECT)
    nothing = F.create_map().cast(OBJECT)
    old, new = F.coalesce(read_old, nothing), F.coalesce(read_new, nothing)
    kept = F.transform_values(
        old, lambda key, value: F.when(F.map_contains_key(new, key), new[key]).otherwise(value)
    )
    added = F.map_filter(new, lambda key, value: ~F.map_contains_key(old, key))
    merged = F.to_json(F.map_concat(kept, added))
    return F.when(read_old.isNull() & read_new.isNull(), base).otherwise(merged)


def array_add_unique(items: Column, item: Column) -> Column:
    """``item`` appended unless it is there; earlier duplicates stay."""
    return F.when(F.array_contains(items, item), items).otherwise(F.array_append(items, item))


def field_type(dtype: T.DataType, path: str) -> T.DataType | None:
    """The type at a dotted path, or None where the path leads nowhere."""
    for name in path.split("."):
        if not isinstance(dtype, T.StructType) or name not in dtype.fieldNames():
            return None
        dtype = dtype[name].dataType
    return dtype


def set_field(struct: Column, dtype: T.StructType, path: str, value: Column) -> Column:
    """Set a nested field where it holds a value; elsewhere leave the struct.

    A path the schema lacks leaves every row alone.
    """
    return edit_field(struct, dtype, path, lambda old: F.when(old.isNotNull(), value))


def edit_field(
    struct: Column, dtype: T.StructType, path: str, edit: Callable[[Column], Column]
) -> Column:
    """Replace a nested field by ``edit(field)`` if the schema has the path."""
    if field_type(dtype, path) is None:
        return struct
    name, _, rest = path.partition(".")
    old = struct.getField(name)
    new = edit_field(old, dtype[name].dataType, rest, edit) if rest else edit(old)
    return F.when(struct.isNotNull(), struct.withField(name, new))


def drop_field(struct: Column, dtype: T.StructType, *paths: str) -> Column:
    """The struct without the given dotted paths; absent paths are no error."""
    present = [path for path in paths if field_type(dtype, path) is not None]
    return struct.dropFields(*present) if present else struct


# U+0001 stands in no valid JSON but as an escape, so it can mark what a scalar was.
MARK = "\u0001"
TEXT, OTHER = MARK + "s", MARK + "n"
_CONTENT = r'(?:[^"\\]|\\.)*+'


def _marked(text: Column) -> Column:
    """JSON whose scalars and keys are all strings that start with what they were.

    Spark's reader writes numbers anew, and gives a string and an object of the same text
    as the same. Marked strings go through it as they are.
    """
    texts = F.regexp_replace(text, f'"({_CONTENT})"', r'"\\u0001s$1"')
    both = F.regexp_replace(texts, f'("{_CONTENT}")|([^\\s\\[\\]{{}},:"]++)', f"$1{MARK}$2{MARK}")
    others = F.replace(both, F.lit(MARK + MARK), F.lit(""))
    return F.regexp_replace(others, f"{MARK}([^{MARK}]*+){MARK}", r'"\\u0001n$1"')


def _restored(marked: Column) -> Column:
    others = F.regexp_replace(marked, f'("\\\\u0001s{_CONTENT}")|"\\\\u0001n([^"]*+)"', "$1$2")
    return F.regexp_replace(others, f'"\\\\u0001s({_CONTENT})"', '"$1"')


def _json(value: Column) -> Column:
    """Any value as JSON text."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _as_it_was(value: Column) -> Column:
    return F.when(value.startswith(MARK), _json(value)).otherwise(value)


def _same(old: Column, new: Column, old_type: T.DataType, new_type: T.DataType) -> Column:
    return old.eqNullSafe(new) if old_type == new_type else old.cast("string").eqNullSafe(new.cast("string"))


def _patched_value(
    value: Column, old: Column, new: Column, old_type: T.DataType, new_type: T.DataType
) -> Column:
    """The marked text ``value``, rewritten where ``new`` differs from ``old``; NULL if it is gone."""
    result = F.when(_same(old, new, old_type, new_type), _as_it_was(value)).when(new.isNull(), None)
    if isinstance(old_type, T.StructType) and isinstance(new_type, T.StructType):
        inner = _patched_object(value, old, new, old_type, new_type)
        result = result.when(value.startswith("{") & old.isNotNull(), inner)
    if isinstance(old_type, T.ArrayType) and isinstance(new_type, T.ArrayType):
        items = F.from_json(value, "array<string>")
        kinds = old_type.elementType, new_type.elementType
        each = F.transform(
            items,
            lambda one, at: F.coalesce(
                _patched_value(one, F.get(old, at), F.get(new, at), *kinds), F.lit('"\\u0001nnull"')
            ),
        )
        aligned = (F.size(items) == F.size(old)) & (F.size(items) == F.size(new))
        result = result.when(
            value.startswith("[") & aligned, F.concat(F.lit("["), F.array_join(each, ","), F.lit("]"))
        )
    return result.otherwise(_marked(_json(new)))


def _patched_object(
    text: Column, old: Column, new: Column, old_type: T.StructType, new_type: T.StructType
) -> Column:
    read = F.from_json(text, "map<string, string>")
    entries = F.map_entries(read)
    types = {f.name: f.dataType for f in old_type.fields}

    def member(entry: Column) -> Column:
        value = F.when(F.lit(False), entry["value"])
        for field in new_type.fields:
            kind = types.get(field.name, T.StringType())
            before = old[field.name] if field.name in types else F.lit(None).cast("string")
            here = _patched_value(entry["value"], before, new[field.name], kind, field.dataType)
            value = value.when(entry["key"] == TEXT + field.name, here)
        return F.concat(_json(entry["key"]), F.lit(":"), value.otherwise(_as_it_was(entry["value"])))

    added = [
        F.when(
            new[field.name].isNotNull() & ~F.map_contains_key(read, TEXT + field.name),
            F.concat(_json(F.lit(TEXT + field.name)), F.lit(":"), _marked(_json(new[field.name]))),
        )
        for field in new_type.fields
    ]
    members = F.concat(F.transform(entries, member), F.array(*added))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def patch_document(
    text: Column, before: Column, after: Column, before_type: T.StructType, after_type: T.StructType
) -> Column:
    """The JSON object ``text``, which was read as ``before``, with the changes that ``after`` has.

    Only fields whose value changed are written anew. All others, those that the types lack
    included, keep their order and the text of their numbers; a field that became NULL
    goes, one that came is added at the end of its object. Items of an array are patched one by one
    while their number is the same; otherwise the array is written as ``after`` has it. A text without a
    change stays as it is, byte for byte; in a changed one blanks between values go and escapes are the shortest.
    What is no JSON object stays as it is, NULL stays NULL. Of a repeated key every value is set.
    """
    marked = _marked(text)
    whole = F.from_json(marked, "map<string, string>")
    edit = ~_same(before, after, before_type, after_type) & before.isNotNull() & after.isNotNull()
    usable = edit & ~text.contains(MARK) & whole.isNotNull()
    return F.when(usable, _restored(_patched_object(marked, before, after, before_type, after_type))).otherwise(text)
