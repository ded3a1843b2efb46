"""Geometry type name and centroid of WKT text, as built-in expressions.

Spark has no geometry functions enabled, so the centroid is computed with higher-order
array functions over the coordinates: mean of points, length-weighted mean of segments,
area-weighted (shoelace) mean of rings with holes subtracted (ring orientation ignored).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Geometry type name (WKT keyword) -> Simple Features class name.
SF_CLASS = {
    "POINT": "Point",
    "LINESTRING": "LineString",
    "POLYGON": "Polygon",
    "MULTIPOINT": "MultiPoint",
    "MULTILINESTRING": "MultiLineString",
    "MULTIPOLYGON": "MultiPolygon",
    "MULTISURFACE": "MultiSurface",
    "GEOMETRYCOLLECTION": "GeometryCollection",
}

_NUM = r"[-+]?[0-9]*\\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


# The keyword of a text, after the spatial reference that extended WKT puts before it.
_KEYWORD = r"^\s*(?:(?i:SRID)\s*=\s*[0-9]+\s*;\s*)?([A-Za-z]+)"


def geometry_type(wkt: Column) -> Column:
    """WKT keyword in upper case (``POINT``, ``POLYGON`` ...); null for null text. A leading
    ``SRID=...;`` is passed over."""
    return F.upper(F.regexp_extract(wkt, _KEYWORD, 1))


def sf_class(gtype: Column) -> Column:
    """Simple Features class name of a type keyword; null when unknown (rejected)."""
    m = F.create_map(*[x for k, v in SF_CLASS.items() for x in (F.lit(k), F.lit(v))])
    return m[gtype]


def _coords(ring_sql: str) -> str:
    # array<array<double>> of points from "x y, x y z, ...": x and y come first
    return (
        f"transform(regexp_extract_all({ring_sql}, '({_NUM})\\\\s+({_NUM})(?:\\\\s+{_NUM})*', 0), "
        f"pt -> transform(split(trim(pt), '\\\\s+'), v -> cast(v as double)))"
    )


def _bind(value_sql: str, var: str, body_sql: str) -> str:
    """Evaluate ``value_sql`` once and use it as ``var`` in ``body_sql``."""
    return f"element_at(transform(array({value_sql}), {var} -> {body_sql}), 1)"


def _ring_moments(p: str) -> str:
    # struct(a = twice the signed area, x, y = first moments times 6) by the shoelace rule;
    # ``p`` is a lambda variable holding the ring's points
    cross = f"({p}[i-1][0] * {p}[i][1] - {p}[i][0] * {p}[i-1][1])"
    return (
        f"aggregate(sequence(1, greatest(size({p}) - 1, 1)), named_struct('a', 0d, 'x', 0d, 'y', 0d), "
        f"(acc, i) -> case when size({p}) < 2 then acc else named_struct("
        f"'a', acc.a + {cross}, "
        f"'x', acc.x + ({p}[i-1][0] + {p}[i][0]) * {cross}, "
        f"'y', acc.y + ({p}[i-1][1] + {p}[i][1]) * {cross}) end)"
    )


def _seg_moments(p: str) -> str:
    # struct(l = total length, x, y = length-weighted midpoint sums)
    seg = f"sqrt(pow({p}[i][0] - {p}[i-1][0], 2) + pow({p}[i][1] - {p}[i-1][1], 2))"
    return (
        f"aggregate(sequence(1, greatest(size({p}) - 1, 1)), named_struct('l', 0d, 'x', 0d, 'y', 0d), "
        f"(acc, i) -> case when size({p}) < 2 then acc else named_struct("
        f"'l', acc.l + {seg}, "
        f"'x', acc.x + {seg} * ({p}[i-1][0] + {p}[i][0]) / 2, "
        f"'y', acc.y + {seg} * ({p}[i-1][1] + {p}[i][1]) / 2) end)"
    )


_BODY = "\\\\s*(?:[ZzMm]{1,2}\\\\s*)?\\\\((?:[^()]|\\\\([^()]*\\\\))*\\\\)"


def _of_collection(kind: str) -> str:
    """Centroid of a collection ``whole`` by its members of the highest dimension: members of
    lower dimension are cut out, what is left is one geometry with several parts."""
    lower = {"POLYGON": "POINT|LINESTRING", "LINESTRING": "POINT", "POINT": ""}[kind]
    text = f"regexp_replace(whole, '(?i)(?:MULTI)?(?:{lower}){_BODY}', '')" if lower else "whole"
    named = f"regexp_replace({text}, '^[^(]*', 'MULTI{kind} ')"
    return _bind(named, "part", centroid_sql("part", False))


def centroid_sql(wkt: str, nested: bool = True) -> str:
    """SQL text of ``struct<x double, y double>``: the centroid of WKT column ``wkt``. A collection
    (``nested``) has that of its members of the highest dimension.

    Every ring is parsed once; intermediate arrays are bound to lambda variables, so no
    sub-expression is evaluated twice. A degenerate geometry (no area, no length, no point)
    has no centroid (null), never a division error.
    """
    original = wkt
    gtype = f"upper(regexp_extract({wkt}, '{_KEYWORD.replace(chr(92), chr(92) * 2)}', 1))"
    wkt = f"regexp_replace({wkt}, '^\\\\s*(?i:SRID)[^;]*;', '')"
    points = _bind(_coords(wkt), "pts",
                   "named_struct('x', try_divide(aggregate(pts, 0d, (a, q) -> a + q[0]), size(pts)), "
                   "'y', try_divide(aggregate(pts, 0d, (a, q) -> a + q[1]), size(pts)))")
    # every innermost "(...)" is a ring or a line; "((" opens a polygon's outer ring (blanks
    # beside brackets are dropped first)
    wkt = f"regexp_replace({wkt}, '\\\\s*([()])\\\\s*', '$1')"
    parts = f"regexp_extract_all({wkt}, '\\\\(?\\\\([^()]+\\\\)', 0)"
    rings = (f"transform({parts}, r -> named_struct('w', case when startswith(r, '((') then 1d else -1d end, "
             f"'m', {_bind(_coords('r'), 'rp', _ring_moments('rp'))}))")
    # area-weighted mean of ring centroids (x/(3a), y/(3a)) with weight w*|a|/2
    areas = (
        f"aggregate({rings}, named_struct('a', 0d, 'x', 0d, 'y', 0d), (acc, g) -> named_struct("
        f"'a', acc.a + g.w * abs(g.m.a) / 2, "
        f"'x', acc.x + case when g.m.a = 0 then 0d else g.w * abs(g.m.a) / 2 * g.m.x / (3 * g.m.a) end, "
        f"'y', acc.y + case when g.m.a = 0 then 0d else g.w * abs(g.m.a) / 2 * g.m.y / (3 * g.m.a) end))"
    )
    polygon = _bind(areas, "t", "named_struct('x', try_divide(t.x, t.a), 'y', try_divide(t.y, t.a))")
    lines_m = (f"aggregate(transform({parts}, r -> {_bind(_coords('r'), 'lp', _seg_moments('lp'))}), "
               f"named_struct('l', 0d, 'x', 0d, 'y', 0d), "
               f"(acc, g) -> named_struct('l', acc.l + g.l, 'x', acc.x + g.x, 'y', acc.y + g.y))")
    line = _bind(lines_m, "u", "named_struct('x', try_divide(u.x, u.l), 'y', try_divide(u.y, u.l))")
    if nested:
        return _bind(f"{original}", "whole", (
            f"case when {gtype.replace(original, 'whole')} <> 'GEOMETRYCOLLECTION' then {centroid_sql('whole', False)} "
            f"when whole rlike '(?i)POLYGON' then {_of_collection('POLYGON')} "
            f"when whole rlike '(?i)LINESTRING' then {_of_collection('LINESTRING')} else {_of_collection('POINT')} end"))
    return (
        f"case when {wkt} is null then null "
        f"when {gtype} in ('POINT', 'MULTIPOINT') then {points} "
        f"when {gtype} in ('LINESTRING', 'MULTILINESTRING') then {line} "
        f"when {gtype} in ('POLYGON', 'MULTIPOLYGON', 'MULTISURFACE') then {polygon} "
        f"else null end"
    )


def centroid(wkt_col_name: str) -> Column:
    """Centroid ``struct<x, y>`` of the WKT in column ``wkt_col_name``."""
    return F.expr(centroid_sql(f"`{wkt_col_name}`"))


def within_box(wkt_col_name: str, x0, y0, x1, y1) -> Column:
    """point, or centroid of any other geometry, inside the inclusive box; null -> false."""
    test = (f"c.x between {float(x0)!r} and {float(x1)!r} and c.y between {float(y0)!r} and {float(y1)!r}")
    inside = F.expr(_bind(centroid_sql(f"`{wkt_col_name}`"), "c", test))
    return F.coalesce(inside, F.lit(False))
