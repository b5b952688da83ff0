"""Standardise a corpus of definition documents in one pass.

A *form* is a list of edits for the documents that a condition on the row
picks: the type of the document, whether it is a job, where its file lies. All
forms are applied in one plan, as one CASE over the document; what no form
picks stays as it is. All names, tokens and rules are the caller's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from twinledger.functions.nested import field_type
from twinledger.functions.schedule import UNCHANGED, schedule_class, schedule_token
from twinledger.functions.text import (
    STAGE_TOKEN,
    TOKEN_MARK,
    append_suffix,
    fill_default,
    folder_of,
    has_token,
    insert_token,
    rebuild_text,
)
from twinledger.operators.load import UPSERT
from twinledger.operators.naming import Rule, map_first_match, replace_head

#: Of a value, the array item it stands in (or None) and the whole document.
Change = Callable[[Column, Column | None, Column], Column]


@dataclass(frozen=True)
class Edit:
    """A change of the value at ``path``; ``[]`` after a name means each item of it.

    Documents without the path, or without the sibling fields that the change
    ``needs``, are left alone. ``where`` narrows the edit to some rows. With
    ``added`` an absent field is made, as text; with ``as_text`` the field becomes text.
    """

    path: str
    change: Change
    where: Column | None = None
    needs: Sequence[str] = ()
    added: bool = False
    as_text: bool = False


@dataclass(frozen=True)
class Form:
    """The edits of the rows that ``where`` picks."""

    where: Column
    edits: Sequence[Edit]


def _rebuilt(
    struct: Column, dtype: T.StructType, edits: Sequence[tuple[list[str], Edit]], doc: Column, item: Column | None
) -> Column:
    """The struct made anew once, each field with its edits, in order.

    Fields are read from the struct as it came, so the expression grows with the
    number of edits and fields only.
    """
    fields = []
    for field in dtype.fields:
        value, inner = struct.getField(field.name), field.dataType
        here = [e for steps, e in edits if steps == [field.name] and set(e.needs) <= set(dtype.fieldNames())]
        within = [(steps[1:], e) for steps, e in edits if len(steps) > 1 and steps[0] == field.name]
        items = [(steps[1:], e) for steps, e in edits if len(steps) > 1 and steps[0] == field.name + "[]"]
        if within and isinstance(inner, T.StructType):
            value = _rebuilt(value, inner, within, doc, item)
        # an array that is empty throughout may have any element type
        if items and isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType):
            value = _each(value, inner.elementType, items, doc)
        for edit in here:
            new = edit.change(value, item, doc)
            value = new if edit.where is None else F.when(edit.where, new).otherwise(value)
        fields.append(value.alias(field.name))
    return F.when(struct.isNotNull(), F.struct(*fields))


def _each(array: Column, dtype: T.StructType, edits: Sequence[tuple[list[str], Edit]], doc: Column) -> Column:
    return F.transform(array, lambda one: _rebuilt(one, dtype, edits, doc, one))


def _edited(doc: Column, dtype: T.StructType, edits: Sequence[Edit]) -> Column:
    return _rebuilt(doc, dtype, [(edit.path.split("."), edit) for edit in edits], doc, None) if edits else doc


def standardise(docs: DataFrame, forms: Sequence[Form]) -> DataFrame:
    """``docs`` with ``doc`` edited by the first form that fits and ``before`` as it was."""
    edits = [edit for form in forms for edit in form.edits]
    dtype = docs.schema["doc"].dataType
    added = [e.path for e in edits if e.added and field_type(dtype, e.path) is None]
    start = reduce(
        lambda doc, path: doc.withField(path, F.lit(None).cast("string")), dict.fromkeys(added), F.col("doc")
    )
    ready = docs.withColumns({"before": F.col("doc"), "doc": start})
    paths = dict.fromkeys(edit.path for edit in edits if edit.as_text)
    texts = [Edit(path, lambda v, i, d: v.cast("string")) for path in paths]
    ready = ready.withColumn("doc", _edited(F.col("doc"), ready.schema["doc"].dataType, texts))
    dtype, result = ready.schema["doc"].dataType, None
    for form in forms:
        new = _edited(F.col("doc"), dtype, form.edits)
        result = F.when(form.where, new) if result is None else result.when(form.where, new)
    return ready.withColumn("doc", F.col("doc") if result is None else result.otherwise(F.col("doc")))


@dataclass(frozen=True)
class Insert:
    """``text`` goes in front of the first ``before``, on rows that ``where`` picks."""

    before: str
    text: str = STAGE_TOKEN
    where: Column | None = None


@dataclass(frozen=True)
class Policy:
    """What a corpus is standardised to.

    ``mapped``: paths of job fields and the rules that map them. The owner is
    filled at ``owner`` where it is absent, on rows that ``owner_where`` picks. Of the
    ``inserts`` the first that picks a row counts.
    """

    owner_token: str
    provider_token: str
    mapped: Sequence[tuple[str, Sequence[Rule]]] = ()
    owner: str = "definition.owner"
    owner_where: Column | None = None
    schedule: str = "definition.schedule"
    schedule_to: str = "schedule"
    description: str = "definition.description"
    merge_option: str = "definition.loadOption.mergeOption"
    inputs: str = "inputs[].value"
    outputs: str = "outputs[].value"
    output_rules: Sequence[Rule] = ()
    stage_token: str = STAGE_TOKEN
    suffix_types: Sequence[str] = ()
    insert_types: Sequence[str] = ()
    inserts: Sequence[Insert] = (Insert("."),)


def _any_of(kind: Column, texts: Sequence[str]) -> Column:
    return reduce(lambda hit, text: hit | kind.contains(text), texts, F.lit(False))


def _inserted(value: Column, inserts: Sequence[Insert]) -> Column:
    result = None
    for one in inserts:
        new = insert_token(value, one.before, one.text)
        where = F.lit(True) if one.where is None else one.where
        result = F.when(where, new) if result is None else result.when(where, new)
    return value if result is None else result.otherwise(value)


def _schedule(doc: Column, dtype: T.DataType, path: str) -> Column | None:
    """The class of a document's schedule, NULL without one."""
    found = field_type(dtype, path)
    if not isinstance(found, T.StructType) or "type" not in found.fieldNames():
        return None
    old = doc
    for name in path.split("."):
        old = old.getField(name)
    none = F.lit(None).cast("array<string>")
    times, days = (old[n] if n in found.fieldNames() else none for n in ("time", "dayPreferences"))
    return F.when(old.isNotNull(), schedule_class(old["type"], times, days))


def job_edits(dtype: T.DataType, policy: Policy) -> list[Edit]:
    """Map fields by rule, class the schedule, fill the owner. ``dtype`` is the documents' type."""
    edits = [Edit(path, lambda v, i, d, r=rules: map_first_match(v, r)) for path, rules in policy.mapped]
    edits.append(
        Edit(policy.owner, lambda v, i, d: F.coalesce(v, F.lit(policy.owner_token)), policy.owner_where, added=True)
    )
    if _schedule(F.col("doc"), dtype, policy.schedule) is not None:

        def replaced(doc: Column) -> Column:
            name = _schedule(doc, dtype, policy.schedule)
            return name.isNotNull() & (name != UNCHANGED)

        def token(value: Column, item: Column | None, doc: Column) -> Column:
            name = _schedule(doc, dtype, policy.schedule)
            return F.when(replaced(doc), schedule_token(name)).otherwise(value)

        edits.append(Edit(policy.schedule_to, token, added=True, as_text=True))
        edits.append(Edit(policy.schedule, lambda v, i, d: F.when(~replaced(d), v)))
    return edits


def _profile_edits(policy: Policy) -> list[Edit]:
    def marked(value: Column, item: Column, doc: Column) -> Column:
        kind = item["type"]
        return (
            F.when(_any_of(kind, policy.suffix_types), append_suffix(value, policy.stage_token, TOKEN_MARK))
            .when(_any_of(kind, policy.insert_types), _inserted(value, policy.inserts))
            .otherwise(value)
        )

    return [
        Edit(policy.description, lambda v, i, d: rebuild_text(v, folder_of(F.col("path")), policy.stage_token)),
        Edit(policy.merge_option, lambda v, i, d: fill_default(v, UPSERT)),
        Edit(policy.inputs, marked, needs=("type",)),
    ]


def _mapped_output(value: Column, policy: Policy) -> Column:
    return map_first_match(value, policy.output_rules, replace_head(value, policy.provider_token))


def table_profile_edits(policy: Policy) -> list[Edit]:
    """Outputs are mapped and get the stage."""

    def output(value: Column, item: Column, doc: Column) -> Column:
        named = F.concat(_mapped_output(value, policy), F.lit(policy.stage_token))
        return F.when(has_token(value), value).otherwise(named)

    return [*_profile_edits(policy), Edit(policy.outputs, output)]


def load_profile_edits(policy: Policy) -> list[Edit]:
    """Outputs are mapped; only inputs get the stage."""
    return [*_profile_edits(policy), Edit(policy.outputs, lambda v, i, d: _mapped_output(v, policy))]


def transform_profile_edits(policy: Policy) -> list[Edit]:
    """Outputs get the stage inside; inputs stay."""
    described = _profile_edits(policy)[:1]
    return [*described, Edit(policy.outputs, lambda v, i, d: _inserted(v, policy.inserts))]


def script_profile_edits(
    policy: Policy, provider: str, name: str, version: str, version_token: str, account: str, account_token: str, title: str
) -> list[Edit]:
    """Outputs of several fields, an account and a title, each at the path given."""

    def staged(value: Column, item: Column | None, doc: Column) -> Column:
        return append_suffix(value, policy.stage_token)

    return [
        Edit(provider, lambda v, i, d: F.when(has_token(v, policy.provider_token), v).otherwise(_mapped_output(v, policy))),
        Edit(name, staged),
        Edit(version, lambda v, i, d: F.lit(version_token), as_text=True),
        Edit(account, lambda v, i, d: F.when(v.isNotNull(), F.lit(account_token))),
        Edit(title, staged),
    ]


def script_job_edits(tokens: dict[str, str]) -> list[Edit]:
    """Fields that are present become their token."""
    return [
        Edit(path, lambda v, i, d, t=token: F.when(v.isNotNull(), F.lit(t)), as_text=True)
        for path, token in tokens.items()
    ]


def abbreviation_edits(paths: dict[str, str], abbreviation: str = "abbreviation") -> list[Edit]:
    """Fields become a placeholder named after the row's abbreviation and the path's ending."""
    return [
        Edit(
            path,
            lambda v, i, d, e=ending: F.when(has_token(v) | F.col(abbreviation).isNull(), v).otherwise(
                F.concat(F.lit(TOKEN_MARK), F.col(abbreviation), F.lit(e), F.lit("]"))
            ),
            as_text=True,
        )
        for path, ending in paths.items()
    ]


def standardise_jobs(docs: DataFrame, policy: Policy) -> DataFrame:
    """Map fields, class the schedule, fill the owner."""
    return standardise(docs, [Form(F.lit(True), job_edits(docs.schema["doc"].dataType, policy))])


def standardise_profiles(docs: DataFrame, policy: Policy) -> DataFrame:
    """Rebuild the description, mark inputs and outputs, default the merge."""
    return standardise(docs, [Form(F.lit(True), table_profile_edits(policy))])


def changes(docs: DataFrame, paths: Sequence[str]) -> DataFrame:
    """The change log: one row per document and path whose value changed."""
    old_type = docs.schema["before"].dataType
    new_type = docs.schema["doc"].dataType

    def text(struct: Column, dtype: T.StructType, path: str) -> Column:
        found = field_type(dtype, path)
        if found is None:
            return F.lit(None).cast("string")
        for name in path.split("."):
            struct = struct[name]
        nested = isinstance(found, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(struct) if nested else struct.cast("string")

    entries = F.array(
        *[
            F.struct(
                F.lit(path).alias("field"),
                text(F.col("before"), old_type, path).alias("old"),
                text(F.col("doc"), new_type, path).alias("new"),
            )
            for path in paths
        ]
    )
    return (
        docs.select("path", F.explode(entries).alias("_e"))
        .select("path", "_e.*")
        .filter(~F.col("old").eqNullSafe(F.col("new")))
    )
