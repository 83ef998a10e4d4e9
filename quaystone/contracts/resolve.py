"""Which source column carries each contract column, by what promotion, and everything that speaks against it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from quaystone.contracts import types
from quaystone.contracts.model import ColumnSpec, Contract, fingerprint


@dataclass(frozen=True)
class Source:
    name: str
    kind: str


@dataclass(frozen=True)
class Mapping:
    name: str
    status: str  # mapped, absent_in_source, untyped_null_source
    target: str
    source: str | None = None
    source_kind: str | None = None
    promotion: str | None = None

    def document(self) -> dict:
        return {"name": self.name, "promotion": self.promotion, "source": self.source, "source_kind": self.source_kind, "status": self.status, "target": self.target}


@dataclass(frozen=True)
class Violation:
    rule: str
    column: str
    detail: str

    def document(self) -> dict:
        return {"column": self.column, "detail": self.detail, "rule": self.rule}


@dataclass(frozen=True)
class Resolution:
    service: str
    mappings: tuple[Mapping, ...]
    violations: tuple[Violation, ...]
    unmapped: tuple[str, ...] = ()

    @property
    def accepted(self) -> bool:
        return not self.violations

    @property
    def guarded(self) -> tuple[Mapping, ...]:
        return tuple(m for m in self.mappings if m.promotion == "guarded")

    def mapping(self, name: str) -> Mapping:
        return {m.name: m for m in self.mappings}[name]

    def document(self) -> dict:
        return {"mappings": [m.document() for m in self.mappings], "service": self.service, "unmapped": list(self.unmapped), "violations": [v.document() for v in self.violations]}

    def fingerprint(self) -> str:
        return fingerprint(self.document())

    def promotions(self) -> dict[str, list[str]]:
        """Columns by promotion."""
        out: dict[str, list[str]] = {}
        for m in self.mappings:
            if m.promotion:
                out.setdefault(m.promotion, []).append(m.name)
        return {k: sorted(v) for k, v in sorted(out.items())}


def of_struct(schema: StructType, untyped: frozenset[str] = frozenset()) -> tuple[Source, ...]:
    """Source columns of a live schema; `untyped` names columns whose footer says they hold only nulls, which Spark reads as int."""
    return tuple(Source(f.name, "untyped_null" if f.name in untyped else types.of_spark(f.dataType)) for f in schema.fields)


def of_records(columns: list[dict]) -> tuple[Source, ...]:
    """Source columns of a recorded schema with `name` and `duckdb_type` or `logical_type`."""
    return tuple(Source(c["name"], "untyped_null" if c.get("logical_type") == "NullType()" else types.of_name(c["duckdb_type"])) for c in columns)


def _one(spec: ColumnSpec, found: list[Source]) -> tuple[Mapping, Violation | None]:
    if len(found) > 1:
        names = ", ".join(sorted(s.name for s in found))
        return Mapping(spec.name, "absent_in_source", spec.kind), Violation("ambiguous_canonical_column", spec.name, f"claimed by {names}")
    if not found:
        missing = Violation("missing_required_column", spec.name, f"none of {', '.join(spec.aliases)}") if spec.required else None
        return Mapping(spec.name, "absent_in_source", spec.kind), missing
    s = found[0]
    how = types.classify(s.kind, spec.kind)
    kept = Mapping(spec.name, "untyped_null_source" if how == "untyped_null_cast" else "mapped", spec.kind, s.name, s.kind, how)
    detail = f"{s.name}: {s.kind} to {spec.kind}"
    if how in ("narrowing", "incompatible"):
        return kept, Violation(f"{how}_type_drift", spec.name, detail)
    if how == "unsupported":
        return kept, Violation("unsupported_source_type", spec.name, detail)
    if how == "guarded" and not spec.guarded:
        return kept, Violation("guarded_promotion_not_allowed", spec.name, detail)
    return kept, None


def resolve(contract: Contract, source: tuple[Source, ...]) -> Resolution:
    """All mappings and all violations; source columns that no contract column claims are named, not rejected."""
    pairs = [_one(c, [s for s in source if c.matches(s.name)]) for c in contract.columns]
    claimed = {s.name for c in contract.columns for s in source if c.matches(s.name)}
    return Resolution(contract.service, tuple(m for m, _ in pairs), tuple(v for _, v in pairs if v), tuple(sorted(s.name for s in source if s.name not in claimed)))


def unreadable(contract: Contract, reason: str) -> Resolution:
    """The resolution of a file that cannot be read; it is never published as a rejection, as reading may succeed later."""
    return Resolution(contract.service, (), (Violation("unreadable_source_schema", "*", reason[:300]),))
