"""Station registration documents as JSON text (one per station)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellflux.functions import text

# The document skeleton; station values are set into it.  Keys are written
# in sorted order, as a sorted-keys JSON dump would.
DEFAULT_TEMPLATE: dict[str, Any] = {
    "description": "",
    "location": {
        "geometry": {"coordinates": [], "type": "Point"},
        "properties": {"name": ""},
        "type": "Feature",
    },
    "system": "",
    "system_id": "",
}


def _literal(v: Any) -> Column:
    if isinstance(v, Mapping):
        return F.struct(*[_literal(v[k]).alias(k) for k in sorted(v)])
    if isinstance(v, list):
        return F.array(*[_literal(x) for x in v]) if v else F.array().cast("array<string>")
    return F.lit(v)


def _merge(template: Mapping[str, Any], values: Mapping[str, Any]) -> Column:
    """struct of the template with ``values`` (Columns or nested dicts) set, keys sorted."""
    fields = []
    for k in sorted(set(template) | set(values)):
        if k in values and isinstance(values[k], Mapping):
            fields.append(_merge(template.get(k, {}), values[k]).alias(k))
        elif k in values:
            fields.append(values[k].alias(k))
        else:
            fields.append(_literal(template[k]).alias(k))
    return F.struct(*fields)


def station_documents(stations: DataFrame, template: Mapping[str, Any] | str | DataFrame | None = None) -> DataFrame:
    """(code, json) per station; coordinates are ``[lon, lat, elevation]`` as text.

    ``template``: a dict, JSON text, or the one-row table of ``read_template``.
    """
    if isinstance(template, DataFrame):
        template = template.select(F.to_json(F.struct("*"))).first()[0]  # one row
    tpl = json.loads(template) if isinstance(template, str) else (template or DEFAULT_TEMPLATE)
    code = text.number_text(F.col("code"))
    values = {
        "system_id": code,
        "system": code,
        "description": F.col("name").cast("string"),
        "location": {
            "geometry": {
                "coordinates": F.array(
                    F.col("lon").cast("string"), F.col("lat").cast("string"), F.col("elevation").cast("string")
                )
            },
            "properties": {"name": code},
        },
    }
    return stations.select(code.alias("code"), F.to_json(_merge(tpl, values)).alias("json"))
