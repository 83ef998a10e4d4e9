"""Plain Python versions of the operators, for comparison on small tables."""

import json
from collections import defaultdict
from itertools import groupby

CANON = {  # fixed values: the spellings that the test tables use for each field
    "airport_fee": ["airport-fee", "airportFee", "airport_fee", "Airport_fee", "arprt_fee", "fee_airport"],
    "cbd_congestion_fee": ["cbd_congestion_fee", "CBD_Congestion_Fee", "cbdCongestionFee", "cbd_cong_fee", "congestion_fee_cbd"],
    "passenger_count": ["count_passenger", "Passenger Count", "passenger_cnt", "PassengerCount", "passenger_count", "psgr_count"],
    "trip_distance": ["distance_trip", "trip_dist", "trip_distance", "TripDistance"],
    "payment_type": ["payment_type", "Payment_Type", "pmt_type", "type_payment"],
    "vendor_id": ["id_vendor", "Vendor ID", "VendorID", "vendorId", "vendor_id", "VENDORID", "vndr_id"],
}
FIELD = {s: k for k, v in CANON.items() for s in v}


def drift(records, files):
    """records: (file, payload); files: (file, feed, at)."""
    seen = defaultdict(dict)
    for f, p in records:
        seen[f]
        try:
            o = json.loads(p)
        except (TypeError, ValueError):
            continue
        for k, v in o.items():
            kind = 0 if v is None else 3 if isinstance(v, (str, bool)) else 2 if isinstance(v, float) else 1
            seen[f][k] = max(seen[f].get(k, 0), kind)
    out = set()
    chain = sorted((feed, at, f) for f, feed, at in files if f in seen)
    for _, g in groupby(chain, key=lambda x: x[0]):
        told, before = {}, None
        for _, _, f in g:
            now = seen[f]
            if before is not None:
                gone, came = set(before) - set(now), set(now) - set(before)
                for c in sorted(came):
                    was = [x for x in gone if FIELD.get(x, x) == FIELD.get(c, c)]
                    if was:
                        gone.remove(was[0])
                        out.add((f, c, "renamed"))
                    else:
                        out.add((f, c, "added"))
                out |= {(f, x, "removed") for x in gone}
            for k, kind in now.items():
                if kind:
                    c = FIELD.get(k, k)
                    if told.get(c, kind) != kind:
                        out.add((f, k, "retyped"))
                    told[c] = kind
            before = now
    return out


def instant(value, clock_zone, day_first):
    """Microseconds of the one instant that a text names, or None."""
    import re
    from datetime import UTC, datetime, timedelta
    from zoneinfo import ZoneInfo

    if value is None or not (v := value.strip()):
        return None
    if re.fullmatch(r"\d{9,19}", v):
        n = len(v)
        return int(v) * 10**6 if n <= 11 else int(v) * 1000 if n <= 14 else int(v) if n <= 16 else int(v) // 1000
    offset = None
    if m := re.search(r"(?:Z| ?(UTC|EST|EDT))$", v):
        offset, v = {"EST": -300, "EDT": -240}.get(m[1], 0), v[: m.start()]
    elif m := re.search(r"(:\d\d(?:\.\d+)?) ?([+-])(\d\d):?(\d\d)$", v):
        offset, v = (int(m[3]) * 60 + int(m[4])) * (1 if m[2] == "+" else -1), v[: m.end(1)]
    frac = 0
    if m := re.search(r"(?<=:\d\d)\.(\d+)", v):
        frac, v = int(m[1][:6].ljust(6, "0")), v[: m.start()] + v[m.end():]
    v = v.strip().upper()
    dates = ["%Y-%m-%d", "%d.%m.%Y", "%d %b %Y", "%b %d, %Y", "%b %d %Y"]
    if day_first is not None:
        dates.append("%d/%m/%Y" if day_first else "%m/%d/%Y")
    forms = [f"{d}{j}{t}" for d in dates for j in (" ", "T") for t in ("%H:%M:%S", "%H:%M", "%I:%M:%S %p")] + ["%Y%m%dT%H%M%S"]
    for f in forms:
        try:
            local = datetime.strptime(v, f)
        except ValueError:
            continue
        if offset is None:
            try:
                zone = ZoneInfo(clock_zone or "America/New_York")
            except (KeyError, ValueError):
                return None
            fits = {(local.replace(tzinfo=zone, fold=k) - local.replace(tzinfo=zone, fold=k).utcoffset()).replace(tzinfo=UTC) for k in (0, 1)}
            fits = {u for u in fits if u.astimezone(zone).replace(tzinfo=None) == local}
            if len(fits) != 1:
                return None
            utc = fits.pop()
        else:
            utc = (local - timedelta(minutes=offset)).replace(tzinfo=UTC)
        return (utc - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1) + frac
    return None
