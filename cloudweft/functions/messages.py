"""Job messages: which bodies are valid, and their fields, as column expressions over VARIANT.

Bodies with repeated keys or NaN are not JSON here. Versions 1, 1.0 and true are taken for 1, as loosely typed consumers do.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudweft.functions.text import stripped

#: Names on the wire.
GENERATE, REFINE = "mesh.generate", "mesh.refine"
VERSION = 1
IDS = ("organizationId", "projectId")
KEYS = "zoneScanObjectKeys"
COMMON = ("type", "version", *IDS)


def parsed(body: Column) -> Column:
    """The body as VARIANT; null where it is no JSON, so that the text itself stays the message."""
    return F.try_parse_json(body)


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("MISSING"))


def _at(body: Column, name: str) -> Column:
    return F.try_variant_get(body, f"$.{name}", "variant")


def _text(body: Column, name: str) -> Column:
    return F.when(_kind(_at(body, name)) == "STRING", F.try_variant_get(body, f"$.{name}", "string"))


def error(body: Column) -> Column:
    """Name of the first rule that a body breaks, or null for a valid message."""
    v = parsed(body)
    keys = F.json_object_keys(body)
    kind = _text(v, "type")
    allowed = F.when(kind == GENERATE, F.array(*(F.lit(k) for k in (*COMMON, KEYS)))).otherwise(F.array(*(F.lit(k) for k in COMMON)))
    out = F.when(body.isNull() | v.isNull(), "not_json").when(~_kind(v).startswith("OBJECT"), "not_object")
    out = out.when(kind.isNull() | ~kind.isin(GENERATE, REFINE), "type")
    for name in IDS:
        out = out.when(F.coalesce(stripped(_text(v, name)), F.lit("")) == "", name)
    found = _kind(_at(v, KEYS))
    items = F.try_variant_get(v, f"$.{KEYS}", "array<string>")
    bad = (found != "ARRAY<STRING>") | (F.coalesce(F.size(items), F.lit(0)) < 1) | F.exists(items, lambda x: x.isNull())
    out = out.when((kind == GENERATE) & F.coalesce(bad, F.lit(True)), KEYS)
    version = _kind(_at(v, "version"))
    present = F.array_contains(keys, "version")
    one = version.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)") & (F.when(version == "BOOLEAN", F.try_variant_get(v, "$.version", "boolean").cast("double")).otherwise(F.try_variant_get(v, "$.version", "double")) == VERSION)
    out = out.when(present & ~F.coalesce(one, F.lit(False)), "version")
    return out.when(F.size(F.array_except(keys, allowed)) > 0, "extra_fields")


def validated(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """``messages`` with type, version, organizationId, projectId, zoneScanObjectKeys (null where invalid) and error."""
    body = F.col(body_col)
    v = parsed(body)
    fine = F.col("error").isNull()
    return messages.withColumn("error", error(body)).withColumns({
        "type": F.when(fine, _text(v, "type")),
        "version": F.when(fine, F.lit(VERSION)),
        **{name: F.when(fine, stripped(_text(v, name))) for name in IDS},
        KEYS: F.when(fine & (_text(v, "type") == GENERATE), F.try_variant_get(v, f"$.{KEYS}", "array<string>")),
    })


def parse_body(body: Any) -> Any:
    """JSON text as its value; anything else as it is."""
    if not isinstance(body, str):
        return body
    try:
        return json.loads(body)
    except json.JSONDecodeError:
        return body


#: Characters that the contract strips from ids, those with the Unicode property White_Space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"


@dataclass(frozen=True)
class Job:
    """A valid message on the driver. Created directly, type decides what else is needed."""

    organizationId: str
    projectId: str
    type: str = GENERATE
    version: int = VERSION
    zoneScanObjectKeys: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        for name in IDS:
            value = getattr(self, name)
            if not isinstance(value, str) or not value.strip(_SPACE):
                raise ValueError(f"{name} must be a text that is not blank")
            object.__setattr__(self, name, value.strip(_SPACE))
        if self.type not in (GENERATE, REFINE):
            raise ValueError(f"unknown type {self.type!r}")
        if isinstance(self.version, str) or self.version != VERSION:
            raise ValueError(f"version must be {VERSION}")
        keys = self.zoneScanObjectKeys
        if self.type == REFINE:
            if keys is not None:
                raise ValueError(f"{KEYS} is not allowed here")
        elif not isinstance(keys, list | tuple) or not keys or not all(isinstance(k, str) for k in keys):
            raise ValueError(f"{KEYS} must be a list of texts that is not empty")
        else:
            object.__setattr__(self, KEYS, tuple(keys))


def parse_job(data: Any) -> Job:
    """A message from a decoded body; ``type`` must be present, unknown fields are refused."""
    if isinstance(data, Job):
        return data
    if not isinstance(data, dict):
        raise ValueError("a message is an object")
    if "type" not in data:
        raise ValueError("type is missing")
    if extra := set(data) - {*COMMON, KEYS}:
        raise ValueError(f"unknown fields: {sorted(extra)}")
    if absent := [name for name in IDS if name not in data]:
        raise ValueError(f"missing fields: {absent}")
    if data["type"] == REFINE and KEYS in data:
        raise ValueError(f"{KEYS} is not allowed here")
    return Job(**data)
