"""Column expressions of single rows: impact derivations, repair scores, geometry, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))


def derived_impact(row: dict[str, Column] | None = None) -> dict[str, Column]:
    """The derived measures of an impact row. Flows are vehicles, fees of all vehicles are in units of ten thousand."""
    c = row or {}
    of = lambda name: c.get(name, F.col(name))
    zero = F.lit(0)
    affected = F.greatest(zero, of("con_sp_flow") - of("con_flow"))
    detour = F.least(F.greatest(zero, of("other_flow") - of("other_sp_flow")), affected)
    near_more, mid_more = of("detour_flow") - of("detour_sp_flow"), of("mid_flow") - of("mid_sp_flow")
    left = affected - detour
    nearby = F.when((near_more <= 0) | (near_more + mid_more < 0), zero).when(near_more + mid_more > left, F.least(near_more, left).cast("int")).otherwise(near_more.cast("int"))
    left2 = left - nearby
    midtrip = F.when((mid_more <= 0) | (left2 <= 0), zero).when(mid_more <= left2, mid_more.cast("int")).otherwise(left2.cast("int"))
    lost = left2 - midtrip
    wan = F.lit(10000.0)
    return {
        "original_path_fee": of("con_control_fee") * of("con_flow") / wan, "ref_total_flow": of("con_sp_flow"), "unaffected_flow": of("con_flow"),
        "affected_flow": affected, "detour_flow_final": detour, "retained_nearby": nearby, "retained_midtrip": midtrip, "lost_flow": lost,
        "original_control_fee": of("con_sp_flow") * of("con_control_fee") / wan, "unaffected_control_fee": of("con_flow") * of("con_control_fee") / wan,
        "detour_control_fee_final": detour * of("other_control_fee") / wan, "retained_nearby_control_fee": nearby * of("detour_unit_control_loss_fee") / wan,
        "retained_midtrip_control_fee": midtrip * of("mid_unit_control_loss_fee") / wan, "lost_control_fee": lost * of("con_control_fee") / wan,
    }


#: What a roll-up of impact rows sums. Fixed values, as are the weights, bands and names of the scores below.
MEASURES = ("ref_total_flow", "unaffected_flow", "affected_flow", "detour_flow_final", "retained_nearby", "retained_midtrip", "lost_flow", "original_control_fee", "unaffected_control_fee", "detour_control_fee_final", "retained_nearby_control_fee", "retained_midtrip_control_fee", "lost_control_fee")


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Direction from one point to another in degrees, 0 to 360."""
    a, b, turn = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    angle = F.atan2(F.sin(turn) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn))
    return F.pmod(F.degrees(angle) + 360, F.lit(360.0))


def angle_between(a: Column, b: Column) -> Column:
    """Smallest angle of two directions."""
    apart = F.abs(a - b) % 360
    return F.least(apart, F.lit(360.0) - apart)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(a))


def wkt_point(lon: Column, lat: Column) -> Column:
    return F.format_string("POINT(%s %s)", lon.cast("string"), lat.cast("string"))


def wkt_line(points: Column) -> Column:
    """LINESTRING of an array of structs lon, lat."""
    return F.concat(F.lit("LINESTRING("), F.array_join(F.transform(points, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string"))), ", "), F.lit(")"))


def with_srid(wkt: Column, srid: int = 4326) -> Column:
    return F.concat(F.lit(f"SRID={srid};"), wkt)


def geometry_type(wkt: Column) -> Column:
    """The type's name in capitals of a WKT text, with or without an SRID; null for anything else."""
    return F.upper(F.nullif(F.regexp_extract(wkt, r"^(?:SRID=\d+;)?\s*([A-Za-z]+)\s*\(", 1), F.lit("")))


def line_length_m(points: Column) -> Column:
    """Metres along an array of structs lon, lat; 0 for fewer than two."""
    step = lambda p, i: F.when(i == 0, F.lit(0.0)).otherwise(haversine_m(F.get(points, i - 1)["lon"], F.get(points, i - 1)["lat"], p["lon"], p["lat"]))
    return F.aggregate(F.transform(points, step), F.lit(0.0), lambda a, b: a + b)


def distance_to_line_m(lon: Column, lat: Column, points: Column) -> Column:
    """Metres from a point to the nearest place of a line: on the plane that touches the earth at the point, where the line is short against it; null for an empty line."""
    per = F.lit(EARTH_M) * F.radians(F.lit(1.0))
    x = lambda p: (p["lon"] - lon) * F.cos(F.radians(lat)) * per
    y = lambda p: (p["lat"] - lat) * per

    def to_step(b: Column, i: Column) -> Column:
        a = F.get(points, F.greatest(i - 1, F.lit(0)))
        dx, dy = x(b) - x(a), y(b) - y(a)
        along = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(x(a) * dx + y(a) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)))), F.lit(0.0))
        return F.sqrt((x(a) + along * dx) ** 2 + (y(a) + along * dy) ** 2)

    return F.array_min(F.transform(points, to_step))


def repeated_nodes(path: Column) -> Column:
    """Number of different units that a path visits more than once."""
    return F.size(F.filter(F.array_distinct(path), lambda u: F.size(F.filter(path, lambda v: v == u)) > 1))


def reverse_edges(path: Column) -> Column:
    """Number of steps whose opposite was taken before."""
    steps = F.transform(F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0))), lambda a, i: F.struct(a.alias("a"), F.get(path, i + 1).alias("b"), i.alias("i")))
    return F.size(F.filter(steps, lambda s: F.exists(steps, lambda t: (t["i"] < s["i"]) & (t["a"] == s["b"]) & (t["b"] == s["a"]))))


def _even1(x: Column) -> Column:
    """One decimal, halves to even, of what six decimals say."""
    return F.bround(F.round(x, 6).cast("decimal(12,6)"), 1).cast("double")


def backtrack_index(reverse: Column, backward: Column, repeated: Column, u_turns: Column, detour_ratio: Column) -> Column:
    """0 to 100: how much a path doubles back, one decimal, halves to even."""
    part = lambda x, full, weight: F.least(x / F.lit(float(full)), F.lit(1.0)) * weight
    detour = F.least(F.greatest(detour_ratio - 1.2, F.lit(0.0)), F.lit(1.0)) * 10.0
    return _even1(F.least(part(reverse, 2, 30.0) + part(backward, 3, 25.0) + part(repeated, 3, 20.0) + part(u_turns, 2, 15.0) + detour, F.lit(100.0)))


def repair_confidence(dropped: Column, inserted: Column, raw: Column, detour_ratio: Column, backtrack: Column, anchors: Column, total: Column) -> Column:
    """0 to 100: trust in a repaired path, one decimal, halves to even."""
    score = 100.0 - safe_div(dropped.cast("double"), raw.cast("double")) * 25.0 - safe_div(inserted.cast("double"), raw.cast("double")) * 15.0
    score = score - F.greatest(detour_ratio - 1.2, F.lit(0.0)) * 30.0 - backtrack * 0.5 - F.when((total > 0) & (anchors < total * 0.3), 10.0).otherwise(0.0)
    return _even1(F.greatest(F.least(score, F.lit(100.0)), F.lit(0.0)))


def repair_status(confidence: Column) -> Column:
    return F.when(confidence >= 85, "HIGH_CONFIDENCE").when(confidence >= 65, "MEDIUM_CONFIDENCE").when(confidence >= 40, "LOW_CONFIDENCE").otherwise("NEED_MANUAL_REVIEW")


def same_period(day: Column, years: int = 1) -> Column:
    """The same day `years` before; 29 February becomes the 28th."""
    return F.add_months(day, -12 * years)


def vehicle_type(text: Column) -> Column:
    """The trimmed type, `0` if there is none."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit("0"))


def is_passenger(kind: Column) -> Column:
    return kind.cast("int").between(1, 4)


def detour_band(increase: Column) -> Column:
    """Share of drivers that accept a detour of a given relative increase; bands are closed below and open above."""
    return F.when(increase < 0.1, 0.5).when(increase < 0.2, 0.4).when(increase < 0.3, 0.3).when(increase < 0.5, 0.2).otherwise(0.0)


def vehicle_group(code: Column) -> Column:
    """Type names of codes 1 to 4 (cars), 11 to 16 and 21 to 26 (lorries, special ones counted with them); others stay as they are."""
    lorry = F.when(code.between(11, 16), code - 10).when(code.between(21, 26), code - 20)
    return F.when(code.between(1, 4), F.concat(F.lit("客"), code.cast("string"))).when(lorry.isNotNull(), F.concat(F.lit("货"), lorry.cast("string"))).otherwise(code.cast("string"))


def vehicle_category(group: Column) -> Column:
    """Cars, lorries or special vehicles, by the first character of a vehicle_group."""
    return F.when(F.startswith(group, F.lit("客")), "客车").when(F.startswith(group, F.lit("货")), "货车").otherwise("专项")


def toll_class(code: Column) -> Column:
    """The class 1 to 10 of a code, given as number or text; 0 for anything else."""
    number = code.try_cast("int")
    return F.when(number.between(1, 10), number).otherwise(0)
