"""Bid-request feature extraction (F10) driven by a spec, with the per-feature
functions (F11-F16) as Column builders instead of script strings.

Spec entry: ``{"name", "field", "type"?, "function"?, "const"?, "other"?, "other_field"?}``

* no type: one feature ``name + value`` at the dotted path (``imp.0.banner`` ->
  ``$.imp[0].banner``); missing -> no feature
* type 1: one feature per element of the list at the path
* type 2: a registered function ``fn(name, json_col, path, ts_col) -> Column``
  returning a string or an array of strings
* ``other_field``: a second path, read where the first yields no feature
* type 3: the field exists -> ``name + const`` (or ``name + value`` without const);
  missing -> ``name + other`` when ``other`` is given

The request text is parsed once per row with ``from_json`` against a schema of
only the paths the spec reads; extraction is JVM-side, one narrow pass, one
``explode``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from goalcast.functions import columns as C


class Accessor:
    """Field access on a request parsed once with ``from_json``; the schema holds only
    the paths the spec reads (numbers and objects requested as text come back as
    their JSON text). ``imp.0.banner`` -> ``parsed.imp[0].banner``."""

    def __init__(self, parsed: Column):
        self.parsed = parsed

    def _walk(self, field: str) -> Column:
        c = self.parsed
        for part in field.split("."):
            c = c.getItem(int(part)) if part.isdigit() else c.getField(part)
        return c

    def text(self, field: str) -> Column:
        return self._walk(field).cast("string")

    def array(self, field: str) -> Column:
        return self._walk(field)

    def exists(self, field: str) -> Column:
        return self._walk(field).isNotNull()


def fn_ad_type(name, acc, field, ts):
    v = acc.text(field)
    return F.when(v.isNotNull(), C.ad_type_feature(name, v))


def fn_formats(name, acc, field, ts):
    w = F.coalesce(acc.array(field + ".w"), F.array().cast("array<string>"))
    h = F.coalesce(acc.array(field + ".h"), F.array().cast("array<string>"))
    return F.when(acc.exists(field), C.formats_feature(name, w, h))


def fn_domain(name, acc, field, ts):
    v = acc.text(field)
    return F.when(v.isNotNull(), C.domain_feature(name, v))


def fn_zip(name, acc, field, ts):
    v = acc.text(field)
    return F.when(v.isNotNull(), C.zip_feature(name, v))


def fn_hour_of_week(name, acc, field, ts):
    tz = acc.text(field).try_cast("int")
    return F.when(tz.isNotNull(), F.concat(F.lit(name), C.hour_of_week_mod(ts, tz).cast("string")))


def fn_time_of_day(name, acc, field, ts):
    tz = acc.text(field).try_cast("int")
    return F.when(tz.isNotNull(), F.concat(F.lit(name), C.time_of_day(ts, tz).cast("string")))


# name of the request feature -> (Column builder, extra paths it reads: suffix -> kind)
FUNCTIONS: dict[str, tuple[Callable, dict]] = {
    "ad_type": (fn_ad_type, {"": "text"}),
    "formats": (fn_formats, {"": "struct", ".w": "array", ".h": "array"}),
    "domain": (fn_domain, {"": "text"}),
    "location": (fn_zip, {"": "text"}),
    "HOW": (fn_hour_of_week, {"": "text"}),
    "TOD": (fn_time_of_day, {"": "text"}),
}


def register_feature(name: str, fn: Callable, reads: dict | None = None) -> None:
    """Plug-in point replacing a script function: ``fn(name, accessor, field, ts)``."""
    FUNCTIONS[name] = (fn, reads or {"": "text"})


def _needs(spec: list[dict]) -> list[tuple[str, str]]:
    out = []
    for e in spec:
        typ, field = e.get("type", 0), e["field"]
        if "other_field" in e:                                  # read where the first path is absent
            out += _needs([{**{k: v for k, v in e.items() if k != "other_field"}, "field": e["other_field"]}])
        if typ == 1:
            out.append((field, "array"))
        elif typ == 2:
            for suffix, kind in FUNCTIONS[e.get("function_name", e["name"])][1].items():
                out.append((field + suffix, kind))
        elif typ == 3 and "const" in e:
            out.append((field, "struct"))
        else:
            out.append((field, "text"))
    return out


def spec_schema(spec: list[dict]) -> T.StructType:
    """Schema of only the paths the spec reads: a trie of the dotted paths; a node
    with children is a struct, a leaf is text or array<string>; ``name.0`` makes
    ``name`` an array of the element type."""
    trie: dict = {}
    for field, kind in _needs(spec):
        node = trie
        parts = field.split(".")
        for k, part in enumerate(parts):
            node = node.setdefault(part, {})
            if k == len(parts) - 1:
                node.setdefault("__kind__", kind)

    def build(node: dict) -> T.DataType:
        children = {k: v for k, v in node.items() if k != "__kind__"}
        if not children:
            return T.ArrayType(T.StringType()) if node.get("__kind__") == "array" else T.StringType()
        if all(k.isdigit() for k in children):
            elem = {}
            for v in children.values():
                elem = _merge(elem, v)
            return T.ArrayType(build(elem))
        return T.StructType([T.StructField(k, build(v)) for k, v in sorted(children.items())])
    return build(trie)


def _merge(a: dict, b: dict) -> dict:
    out = dict(a)
    for k, v in b.items():
        out[k] = _merge(out.get(k, {}), v) if isinstance(v, dict) else v
    return out


def spec_column(entry: dict, acc: Accessor, ts: Column) -> Column:
    """array<string> of the features one spec entry yields for a request."""
    name, field, typ = entry["name"], entry["field"], entry.get("type", 0)
    if "other_field" in entry:
        first = {k: v for k, v in entry.items() if k != "other_field"}
        found = F.array_compact(spec_column(first, acc, ts))
        return F.when(F.size(found) > 0, found).otherwise(spec_column({**first, "field": entry["other_field"]}, acc, ts))
    if typ == 1:
        arr = acc.array(field)
        return F.coalesce(F.transform(arr, lambda v: F.concat(F.lit(name), v)), F.array().cast("array<string>"))
    if typ == 2:
        return F.array(FUNCTIONS[entry.get("function_name", name)][0](name, acc, field, ts))
    if typ == 3:
        present_test = acc.exists(field)
        present = F.lit(name + entry["const"]) if "const" in entry else F.concat(F.lit(name), acc.text(field))
        missing = F.lit(name + entry["other"]) if "other" in entry else F.lit(None).cast("string")
        return F.array(F.when(present_test, present).otherwise(missing))
    v = acc.text(field)
    return F.array(F.when(v.isNotNull(), F.concat(F.lit(name), v)))


def parse_requests(requests: DataFrame, json_col: str, spec: list[dict], out: str = "_req") -> DataFrame:
    """Parse the request text once into a struct column of the paths the spec reads
    (its own projection, so the parse is not repeated per feature)."""
    return requests.withColumn(out, F.from_json(F.col(json_col), spec_schema(spec)))


def request_feature_array(spec: list[dict], parsed: Column, ts: Column) -> Column:
    """All features of a request (spec order, duplicates kept, missing dropped) from
    the parsed struct column."""
    acc = Accessor(parsed)
    return F.array_compact(F.flatten(F.array(*[spec_column(e, acc, ts) for e in spec])))


def extract_features(requests: DataFrame, key: str, json_col: str, ts_col: str, spec: list[dict]) -> DataFrame:
    """(key, feature): one row per extracted feature."""
    parsed = parse_requests(requests.select(key, ts_col, json_col), json_col, spec)
    arr = request_feature_array(spec, F.col("_req"), F.col(ts_col))
    return parsed.select(key, F.explode(arr).alias("feature"))


# Request feature spec (names, fields, types) of the scorer, the
# script functions replaced by the builders above.
REQUEST_SPEC = [
    {"name": "data_center", "field": "dc_log"},
    {"name": "impression_position_val", "field": "imp.0.banner.pos"},
    {"name": "impression_viewability", "field": "unparseable.viewability"},
    {"name": "ad_type", "field": "imp.0.imp_type", "type": 2},
    {"name": "formats", "field": "imp.0.banner", "type": 2},
    {"name": "app_site_ind", "field": "site", "const": "MWEB", "type": 3},
    {"name": "publisher", "field": "site.publisher.id"},
    {"name": "domain", "field": "site.page", "type": 2},
    {"name": "app_site_ind", "field": "app", "const": "INAPP", "type": 3},
    {"name": "publisher", "field": "app.publisher.id"},
    {"name": "domain", "field": "app.bundle", "type": 2},
    {"name": "location", "field": "device.geo.zip", "type": 2},
    {"name": "device_language", "field": "device.language"},
    {"name": "browser", "field": "device.browser", "type": 3, "other": "Other"},
    {"name": "device_make", "field": "device.make"},
    {"name": "device_model", "field": "device.model"},
    {"name": "device_os", "field": "device.os"},
    {"name": "device_osv", "field": "device.osv"},
    {"name": "connectiontype", "field": "device.connectiontype"},
    {"name": "location", "field": "ext.locationSegments", "type": 1},
    {"name": "category", "field": "site.cat", "type": 1},
    {"name": "category", "field": "app.cat", "type": 1},
    {"name": "HOW", "field": "device.ext.timezone_offset", "other_field": "timezone", "type": 2},
    {"name": "TOD", "field": "device.ext.timezone_offset", "other_field": "timezone", "type": 2},
]

# Agent feature spec.
AGENT_SPEC = [
    {"name": "sub_account", "field": "subAccount"},
    {"name": "banner_size", "field": "format"},
]
