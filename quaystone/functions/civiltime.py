"""Local times that a month's clock changes skip or repeat."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError


@dataclass(frozen=True)
class Interval:
    """Half-open in local time; kind is nonexistent or ambiguous."""

    start: datetime
    end: datetime
    kind: str

    def document(self) -> dict[str, str]:
        return {"end": self.end.isoformat(), "kind": self.kind, "start": self.start.isoformat()}


def transitions(year: int, month: int, zone: str) -> tuple[Interval, ...]:
    """The intervals that begin in a month; an unknown zone is an error, not an empty answer."""
    try:
        z = ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError) as e:
        raise LookupError(f"no time zone data for {zone}") from e
    first = datetime(year, month, 1)
    after = datetime(year + month // 12, month % 12 + 1, 1)
    offset = lambda s: datetime.fromtimestamp(s, UTC).astimezone(z).utcoffset()
    lo, hi = (int((t.replace(tzinfo=UTC)).timestamp()) for t in (first - timedelta(days=2), after + timedelta(days=2)))
    out = []
    for s in range(lo, hi, 3600):
        if offset(s) == offset(s + 3600):
            continue
        a, b = s, s + 3600
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (mid, b) if offset(mid) == offset(a) else (a, mid)
        old, new = offset(a), offset(b)
        at = datetime.fromtimestamp(b, UTC).replace(tzinfo=None)
        start, end, kind = (at + old, at + new, "nonexistent") if new > old else (at + new, at + old, "ambiguous")
        if first <= start < after:
            out.append(Interval(start, end, kind))
    return tuple(out)


def describe(year: int, month: int, zone: str) -> dict:
    """A report of a month, saying so where there is no time zone data."""
    try:
        return {"available": True, "intervals": [i.document() for i in transitions(year, month, zone)], "zone": zone}
    except LookupError as e:
        return {"available": False, "intervals": [], "reason": str(e), "zone": zone}
