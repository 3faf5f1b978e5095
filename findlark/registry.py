"""Index registry: which attributes are indexed, how they are typed and where they come from."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# Attribute names that are matched exactly when registered as field or keyword.
KEYWORD_NAMES = (
    "allowedRolesAndUsers",
    "portal_type",
    "object_provides",
    "Type",
    "id",
    "cmf_uid",
    "sync_uid",
    "getId",
    "meta_type",
    "review_state",
    "in_reply_to",
    "UID",
    "getRawRelatedItems",
    "Subject",
    "sortable_title",
)

# Attributes always kept with the index row.
STORED_NAMES = (
    "Title",
    "Description",
    "Subject",
    "contentType",
    "created",
    "modified",
    "effective",
    "hasImage",
    "is_folderish",
    "portal_type",
    "review_state",
)

KINDS = (
    "keyword",
    "field",
    "text",
    "date",
    "recurring",
    "daterange",
    "boolean",
    "uuid",
    "path",
    "position",
)

PATH_TYPE = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType())]
)
RANGE_TYPE = T.StructType(
    [T.StructField("since", T.TimestampType()), T.StructField("until", T.TimestampType())]
)
ATTACHMENTS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("filename", T.StringType()),
            T.StructField("fieldname", T.StringType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
)

_TYPES = {
    "text": T.StringType(),
    "date": T.TimestampType(),
    "recurring": T.TimestampType(),
    "daterange": RANGE_TYPE,
    "boolean": T.BooleanType(),
    "path": PATH_TYPE,
    "position": T.IntegerType(),
}


@dataclass(frozen=True)
class IndexSpec:
    """One indexed attribute.

    ``sources`` are the content columns it is read from (its own name by default);
    a ``daterange`` names its start and end column there. ``analyzed`` tells whether a
    field or keyword is matched by token; left unset, the attribute name decides.
    """

    name: str
    kind: str
    sources: tuple[str, ...] = ()
    many: bool = False
    analyzed: bool | None = None
    stored: bool | None = None
    dtype: T.DataType | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"no index kind {self.kind!r} for {self.name!r}")

    @property
    def columns(self) -> tuple[str, ...]:
        return self.sources or (self.name,)

    @property
    def is_key(self) -> bool:
        """The id index is the key column of the row, not a second copy of it."""
        return self.kind == "uuid" and self.name.lower() == "uid"

    @property
    def column(self) -> str:
        return "uid" if self.is_key else self.name

    @property
    def is_text(self) -> bool:
        return self.kind == "text"

    @property
    def by_token(self) -> bool:
        if self.kind not in ("keyword", "field", "uuid"):
            return False
        if self.analyzed is not None:
            return self.analyzed
        return self.name not in KEYWORD_NAMES and self.dtype is None

    @property
    def data_type(self) -> T.DataType:
        base = self.dtype or _TYPES.get(self.kind, T.StringType())
        return T.ArrayType(base) if self.many else base

    @property
    def keep(self) -> bool:
        if self.stored is not None:
            return self.stored
        if self.name in STORED_NAMES:
            return True
        if self.kind in ("date", "recurring", "path", "position", "daterange"):
            return True
        return self.kind in ("keyword", "field", "uuid") and not self.by_token

    def field(self) -> T.StructField:
        meta = {"kind": self.kind, "analyzed": self.is_text or self.by_token, "stored": self.keep}
        return T.StructField(self.name, self.data_type, True, meta)


DEFAULT_SPECS = (
    IndexSpec("SearchableText", "text"),
    IndexSpec("Title", "text"),
    IndexSpec("Description", "text"),
    IndexSpec("allowedRolesAndUsers", "keyword", many=True),
    IndexSpec("portal_type", "keyword"),
)


class Registry(Mapping[str, IndexSpec]):
    """Attribute name to :class:`IndexSpec`; later specs replace earlier ones of the same name."""

    def __init__(self, specs: Iterable[IndexSpec] = DEFAULT_SPECS):
        self._specs = {spec.name: spec for spec in specs}

    def __getitem__(self, name: str) -> IndexSpec:
        return self._specs[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._specs)

    def __len__(self) -> int:
        return len(self._specs)

    def with_specs(self, *specs: IndexSpec) -> Registry:
        return Registry([*self._specs.values(), *specs])

    def without(self, *names: str) -> Registry:
        return Registry(spec for name, spec in self._specs.items() if name not in names)

    def all_attributes(self, search_only: Iterable[str] = ()) -> list[str]:
        """Registered names, then search-only names that are not registered."""
        return [*self._specs, *sorted(set(search_only) - set(self._specs))]

    def text_fields(self, search_only: Iterable[str] = ()) -> list[str]:
        named = [name for name, spec in self._specs.items() if spec.is_text]
        return [*named, *sorted(set(search_only) - set(self._specs))]

    def struct_type(self, search_only: Iterable[str] = (), attachments: bool = True) -> T.StructType:
        """Schema of an index row: key, attributes with their mapping as metadata, attachments."""
        fields = [T.StructField("uid", T.StringType(), False)]
        for name in self.all_attributes(search_only):
            spec = self._specs.get(name) or IndexSpec(name, "text")
            if not spec.is_key:
                fields.append(spec.field())
        if attachments:
            fields.append(T.StructField("attachments", ATTACHMENTS_TYPE))
        return T.StructType(fields)


def default_registry() -> Registry:
    """The attributes of a usual content collection."""
    return Registry(DEFAULT_SPECS).with_specs(
        IndexSpec("id", "field"),
        IndexSpec("getId", "field"),
        IndexSpec("UID", "uuid"),
        IndexSpec("Subject", "keyword", many=True),
        IndexSpec("object_provides", "keyword", many=True),
        IndexSpec("review_state", "field"),
        IndexSpec("sortable_title", "field"),
        IndexSpec("created", "date"),
        IndexSpec("effective", "date"),
        IndexSpec("effectiveRange", "daterange", sources=("effective", "expires")),
        IndexSpec("path", "path"),
        IndexSpec("is_default_page", "boolean"),
        IndexSpec("getObjPositionInParent", "position"),
    )
