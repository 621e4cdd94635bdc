"""Errors of the engine."""

from __future__ import annotations


class AttestryError(Exception):
    """Base of all errors here."""


class SeasonError(AttestryError):
    """A season that isn't one."""


class StructureError(AttestryError):
    """A table, page or paginator that breaks its contract."""


class CollectionError(AttestryError):
    """Landed pages that don't make a whole walk."""


class PublishError(AttestryError):
    """Publication refused, or counts that disagree."""


class MoneyError(AttestryError):
    """A money text outside the grammar."""


class FingerprintError(AttestryError):
    """A row that has no canonical form."""


class CollisionError(FingerprintError):
    """Equal fingerprints for different payloads."""


class PolicyError(AttestryError):
    """A deduplicated table, or a decision on it, that can't be applied."""


class DecisionError(PolicyError):
    """A manual decision that can't be applied."""


class ReconcileError(AttestryError):
    """Sources that can't be reconciled."""


class DiagnosticsError(AttestryError):
    """Input with diagnostics. `diagnostics` has the first of them in their fixed order, `count` how many there are, and `frame` all of them."""

    def __init__(self, diagnostics: list[dict], count: int | None = None, frame=None) -> None:
        self.diagnostics, self.count, self.frame = diagnostics, len(diagnostics) if count is None else count, frame
        said = [f"- {d['location']}" + (f" record {d['record_number']}" if d["record_number"] else "") + f" {d['field']}: {d['code']}: {d['message']}" for d in diagnostics]
        super().__init__("\n".join(said + ([f"- and {self.count - len(diagnostics)} more"] if self.count > len(diagnostics) else [])))
