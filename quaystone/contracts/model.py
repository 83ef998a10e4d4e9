"""Contracts as data: canonical columns with aliases, row rules, key names; a fingerprint over their document."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    aliases: tuple[str, ...]
    kind: str
    required: bool = False
    role: str = "measure"
    guarded: bool = False

    def matches(self, source: str) -> bool:
        return source.lower() in {a.lower() for a in self.aliases}

    def document(self) -> dict:
        return {"aliases": sorted({a.lower() for a in self.aliases}), "guarded": self.guarded, "kind": self.kind, "name": self.name, "required": self.required, "role": self.role}


@dataclass(frozen=True)
class Rule:
    """What a flag does to its row: `quarantine` keeps it out, `incident` only reports it."""

    name: str
    action: str
    severity: str

    def document(self) -> dict:
        return {"action": self.action, "name": self.name, "severity": self.severity}


GRAIN = "one physical source row inside one landed source-file version"


@dataclass(frozen=True)
class Contract:
    service: str
    columns: tuple[ColumnSpec, ...]
    pickup: str
    dropoff: str
    pickup_key: str
    dropoff_key: str
    rules: tuple[Rule, ...]
    version: str
    grain: str = GRAIN
    zone: str = "America/New_York"
    components: tuple[str, ...] = ()

    def column(self, name: str) -> ColumnSpec:
        return {c.name: c for c in self.columns}[name]

    def rule(self, name: str) -> Rule:
        return {r.name: r for r in self.rules}[name]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    def document(self) -> dict:
        return {
            "columns": [c.document() for c in self.columns], "components": list(self.components), "contract_version": self.version, "dropoff": self.dropoff, "dropoff_key": self.dropoff_key, "grain": self.grain, "pickup": self.pickup,
            "pickup_key": self.pickup_key, "rules": [r.document() for r in self.rules], "service": self.service, "zone": self.zone,
        }

    def fingerprint(self) -> str:
        return fingerprint(self.document())


def fingerprint(document: object) -> str:
    """SHA-256 of the compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(document, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


# The row rules in the order in which findings list them.
RULES = (
    Rule("pickup_timestamp_missing", "quarantine", "high"),
    Rule("negative_duration", "quarantine", "high"),
    Rule("guarded_promotion_out_of_range", "quarantine", "high"),
    Rule("pickup_out_of_declared_period", "incident", "medium"),
    Rule("dropoff_timestamp_missing", "incident", "medium"),
    Rule("zone_key_missing", "incident", "medium"),
    Rule("zone_key_unknown", "incident", "medium"),
    Rule("local_time_nonexistent", "incident", "medium"),
    Rule("local_time_ambiguous", "incident", "low"),
)


# The columns of the two trip services.
YELLOW = Contract(
    "yellow",
    (
        ColumnSpec("vendor_id", ("VendorID",), "int64", role="code"),
        ColumnSpec("pickup_datetime", ("tpep_pickup_datetime",), "timestamp_ntz", role="temporal", required=True),
        ColumnSpec("dropoff_datetime", ("tpep_dropoff_datetime",), "timestamp_ntz", role="temporal", required=True),
        ColumnSpec("passenger_count", ("passenger_count",), "float64", role="measure", guarded=True),
        ColumnSpec("trip_distance", ("trip_distance",), "float64", role="measure"),
        ColumnSpec("ratecode_id", ("RatecodeID",), "float64", role="code", guarded=True),
        ColumnSpec("store_and_fwd_flag", ("store_and_fwd_flag",), "string", role="flag"),
        ColumnSpec("pickup_location_id", ("PULocationID",), "int64", role="zone_key", required=True),
        ColumnSpec("dropoff_location_id", ("DOLocationID",), "int64", role="zone_key", required=True),
        ColumnSpec("payment_type", ("payment_type",), "int64", role="code"),
        ColumnSpec("fare_amount", ("fare_amount",), "float64", role="measure", required=True),
        ColumnSpec("extra", ("extra",), "float64", role="measure"),
        ColumnSpec("mta_tax", ("mta_tax",), "float64", role="measure"),
        ColumnSpec("tip_amount", ("tip_amount",), "float64", role="measure"),
        ColumnSpec("tolls_amount", ("tolls_amount",), "float64", role="measure"),
        ColumnSpec("improvement_surcharge", ("improvement_surcharge",), "float64", role="measure"),
        ColumnSpec("total_amount", ("total_amount",), "float64", role="measure", required=True),
        ColumnSpec("congestion_surcharge", ("congestion_surcharge",), "float64", role="measure"),
        ColumnSpec("airport_fee", ("airport_fee", "Airport_fee"), "float64", role="measure"),
        ColumnSpec("cbd_congestion_fee", ("cbd_congestion_fee",), "float64", role="measure"),
    ),
    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", RULES, "yellow/v1",
    components=("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount"),
)
HVFHV = Contract(
    "hvfhv",
    (
        ColumnSpec("hvfhs_license_num", ("hvfhs_license_num",), "string", role="code"),
        ColumnSpec("dispatching_base_num", ("dispatching_base_num",), "string", role="code"),
        ColumnSpec("originating_base_num", ("originating_base_num",), "string", role="code"),
        ColumnSpec("request_datetime", ("request_datetime",), "timestamp_ntz", role="temporal"),
        ColumnSpec("on_scene_datetime", ("on_scene_datetime",), "timestamp_ntz", role="temporal"),
        ColumnSpec("pickup_datetime", ("pickup_datetime",), "timestamp_ntz", role="temporal", required=True),
        ColumnSpec("dropoff_datetime", ("dropoff_datetime",), "timestamp_ntz", role="temporal", required=True),
        ColumnSpec("pickup_location_id", ("PULocationID",), "int64", role="zone_key", required=True),
        ColumnSpec("dropoff_location_id", ("DOLocationID",), "int64", role="zone_key", required=True),
        ColumnSpec("trip_miles", ("trip_miles",), "float64", role="measure"),
        ColumnSpec("trip_time", ("trip_time",), "int64", role="measure"),
        ColumnSpec("base_passenger_fare", ("base_passenger_fare",), "float64", role="measure", required=True),
        ColumnSpec("tolls", ("tolls",), "float64", role="measure"),
        ColumnSpec("bcf", ("bcf",), "float64", role="measure"),
        ColumnSpec("sales_tax", ("sales_tax",), "float64", role="measure"),
        ColumnSpec("congestion_surcharge", ("congestion_surcharge",), "float64", role="measure"),
        ColumnSpec("airport_fee", ("airport_fee",), "float64", role="measure"),
        ColumnSpec("tips", ("tips",), "float64", role="measure"),
        ColumnSpec("driver_pay", ("driver_pay",), "float64", role="measure", required=True),
        ColumnSpec("shared_request_flag", ("shared_request_flag",), "string", role="flag"),
        ColumnSpec("shared_match_flag", ("shared_match_flag",), "string", role="flag"),
        ColumnSpec("access_a_ride_flag", ("access_a_ride_flag",), "string", role="flag"),
        ColumnSpec("wav_request_flag", ("wav_request_flag",), "string", role="flag"),
        ColumnSpec("wav_match_flag", ("wav_match_flag",), "string", role="flag"),
        ColumnSpec("cbd_congestion_fee", ("cbd_congestion_fee",), "float64", role="measure"),
    ),
    "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id", RULES, "hvfhv/v1",
    components=("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "tips", "driver_pay"),
)
CONTRACTS = {c.service: c for c in (YELLOW, HVFHV)}
