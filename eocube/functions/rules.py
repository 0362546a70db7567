"""Rules for the parameters of a request, checked before a plan is built."""

from __future__ import annotations

import datetime as dt
import re

# Platforms, and defaults of a request.
LANDSAT = ["LANDSAT_1", "LANDSAT_2", "LANDSAT_3", "LANDSAT_4", "LANDSAT_5", "LANDSAT_7", "LANDSAT_8"]
SEARCH = {"maxcloud": 20, "limit": 100, "level": None, "start": None, "end": None, "sort": "sensing_time"}
STACK = {
    "maxcloud": 20, "limit": 100, "level": None, "start": None, "end": None, "dynamic_dates_step": 1, "interval": "all",
    "interval_step": 1, "scale": 10, "clip": True, "mode": "latest_pixel", "dynamic_dates_interval": None, "composite_method": None,
}
MODES = ("all", "latest_pixel", "cloud_sorted_pixel", "composite")
METHODS = {"SCL": "SENTINEL_2", "FULL": "SENTINEL_2", "QA_PIXEL": "LANDSAT_8"}
INTERVALS = ("all", "days", "weeks", "months")


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def epsg_code(name: str) -> int:
    """The code in EPSG:4326 or urn:ogc:def:crs:EPSG::4326."""
    found = re.fullmatch(r"(?:urn:ogc:def:crs:)?EPSG::?(\d{4,5})", name, re.IGNORECASE)
    _need(found is not None, f"no reference system {name}")
    return int(found[1])


def _common(given: dict, defaults: dict) -> dict:
    unknown = sorted(set(given) - set(defaults) - {"platforms", "bands", "geojson"})
    _need(not unknown, f"unknown parameters: {', '.join(unknown)}")
    out = {**defaults, **given}
    platforms = [out["platforms"]] if isinstance(out.get("platforms"), str) else list(out.get("platforms") or [])
    _need(len(platforms) == 1 and platforms[0] in ["SENTINEL_2", *LANDSAT], "exactly one known platform can be requested")
    _need(bool(out.get("bands")), "bands are required")
    for key in ("start", "end"):
        if out[key] is not None and not isinstance(out[key], dt.date):
            dt.date.fromisoformat(out[key])
    level, sentinel = out["level"], platforms == ["SENTINEL_2"]
    _need(level in (None, "L1C", "L2A", "L2"), f"no level {level}")
    _need(level not in ("L1C", "L2A") or sentinel, f"level {level} is for Sentinel-2 only")
    _need(level != "L2" or not sentinel, "level L2 is for Landsat only")
    _need("SCL" not in out["bands"] or level == "L2A", "SCL can only be requested at level L2A")
    for key in ("interval_step", "scale", "maxcloud", "limit", "dynamic_dates_step"):
        _need(out.get(key) is None or out[key] > 0, f"{key} must be positive")
    return {**out, "platforms": platforms}


def search_request(**given) -> dict:
    """A search with its defaults filled in, or a ValueError."""
    out = _common(given, SEARCH)
    _need(out["sort"] in ("sensing_time", "cloud_cover"), f"no order {out['sort']}")
    return out


def stack_request(**given) -> dict:
    """A stack of mosaics with its defaults filled in, or a ValueError."""
    out = _common(given, STACK)
    _need(bool(out["start"] or out["dynamic_dates_interval"]), "start is required without dynamic dates")
    _need(out["interval"] in INTERVALS and out["dynamic_dates_interval"] in (None, *INTERVALS), "no such interval")
    _need(out["mode"] in MODES, f"no mode {out['mode']}")
    method = out["composite_method"]
    _need(method is None or out["mode"] == "composite", "a composite method needs the mode composite")
    if out["mode"] == "composite":
        out["composite_method"] = method = method or "SCL"
        _need(method in METHODS and out["platforms"] == [METHODS[method]], f"{method} is not for {out['platforms'][0]}")
        _need(method != "SCL" or {"B04", "B08"} <= set(out["bands"]), "SCL composites need B04 and B08")
    return out


def generator_request(mode: str, **given) -> dict:
    """Rules of a training set: several classes by count need the largest value, cell models train on arrays."""
    by_count = isinstance(given.get("class_definitions"), int)
    _need(not by_count or given.get("y_max_value") is not None, "y_max_value is needed for classes by count")
    _need(mode != "Pixel_Model" or bool(given.get("train_with_array")), "cell models need train_with_array")
    return {"mode": mode, **given}
