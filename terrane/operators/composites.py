"""Rule-set semantics that deserve columns of their own: access, speed, tracks, addresses, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule semantics, in their natural order.
ACCESS_YES = ("designated", "permissive", "destination", "customers", "official", "public", "residents", "customer", "residential")
ACCESS_NO = ("military", "private", "agricultural", "forestry", "delivery", "restricted", "psv", "bus", "unknown")
SPEED_LADDER = ((110, 7), (90, 6), (80, 5), (60, 4), (40, 3), (20, 2), (10, 1))
UNPAVED_SURFACES = ("ground", "compacted", "dirt", "earth", "grass", "grass_paver", "gravel", "fine_gravel", "mud", "wood", "pebblestone", "sand", "unpaved")
TRACKS = (("grade1", "feldweg1"), ("grade2", "feldweg023"), ("grade3", "feldweg023"), ("grade4", "feldweg45"), ("grade5", "feldweg45"))
HIKING = (("hiking", 1), ("mountain_hiking", 2), ("demanding_mountain_hiking", 3), ("alpine_hiking", 4), ("demanding_alpine_hiking", 5), ("difficult_alpine_hiking", 6))
HIKING_CLASSES = (("hiking", "sacscalet1"), ("mountain_hiking", "sacscalet2t3"), ("demanding_mountain_hiking", "sacscalet2t3"), ("alpine_hiking", "sacscalet4t5t6"), ("demanding_alpine_hiking", "sacscalet4t5t6"), ("difficult_alpine_hiking", "sacscalet4t5t6"))
#: Least speed that must be exceeded, class, and the highways it holds for besides those of the lines before.
HIGHWAY_LADDER = (
    (120, 7, ("motorway", "trunk")),
    (100, 6, ()),
    (80, 5, ("primary", "motorway_link", "trunk_link")),
    (60, 4, ("secondary", "tertiary")),
    (40, 3, ("primary_link",)),
    (30, 2, ("secondary_link", "tertiary_link", "residential", "unclassified", "service")),
    (10, 1, ()),
)
#: The same for highways that the ladder before says nothing of; up to 10 gives 0.
OTHER_LADDER = ((80, 4), (60, 3), (40, 2), (30, 1))
#: Country, level that gives the city and prefixes that are no part of its name, in order of preference.
CITY_LEVELS = (
    ("NLD", 10, ()), ("NLD", 8, ()),
    ("DEU", 8, ("Gemeinde ", "Stadt ")), ("DEU", 6, ()), ("DEU", 9, ()), ("DEU", 10, ()),
    ("AUT", 10, ("Gemeinde ", "Stadt ")), ("AUT", 8, ("Gemeinde ",)),
)
#: Country, level and the names there that are cities, whatever else is known.
CITY_STATES = (("DEU", 4, ("Hamburg", "Berlin")),)

# What a way that is official for one mode says of the others where nothing is set; earlier modes come first.
OFFICIAL = {
    "foot": {"bicycle": "no", "vehicle": "no", "motor_vehicle": "no", "motorcar": "no", "access": "no"},
    "bicycle": {"foot": "no", "vehicle": "no", "motor_vehicle": "no", "motorcar": "no", "access": "no"},
    "vehicle": {"bicycle": "yes", "foot": "no", "motor_vehicle": "yes", "motorcar": "yes", "access": "no"},
    "motor_vehicle": {"bicycle": "no", "vehicle": "no", "foot": "no", "motorcar": "yes", "access": "no"},
    "motorcar": {"bicycle": "no", "vehicle": "no", "motor_vehicle": "no", "foot": "no", "access": "no"},
    "access": {"foot": "yes", "bicycle": "yes", "vehicle": "yes", "motor_vehicle": "yes"},
}


def official_access(tags: Mapping[str, Column], highway: Column | None = None) -> dict[str, Column]:
    """The access tags (keys of OFFICIAL) after ``official`` has been resolved, and ``bfdesignated``; what comes before ``inherit_access``.

    A cycleway without access or vehicle is open to bicycles, a footway without access to pedestrians. A mode that is official
    closes or opens the others, but only where they are unset. bfdesignated is yes where foot or bicycle is official or designated.
    """
    none = F.lit(None).cast("string")
    own = {k: tags.get(k, none) for k in OFFICIAL}
    if highway is not None:
        free = own["access"].isNull()
        own["bicycle"] = F.coalesce(own["bicycle"], F.when((highway == "cycleway") & free & own["vehicle"].isNull(), "yes"))
        own["foot"] = F.coalesce(own["foot"], F.when((highway == "footway") & free, "yes"))
    out = {}
    for k, c in own.items():
        mine = F.when(c == "official", "yes").otherwise(c) if k in ("foot", "bicycle", "access") else c
        out[k] = F.coalesce(mine, *(F.when(own[m] == "official", says[k]) for m, says in OFFICIAL.items() if k in says))
    for k in ("foot", "bicycle"):
        out[k] = F.when(own[k] == "designated", "yes").otherwise(out[k])
    return out | {"bfdesignated": F.when(F.coalesce(own["foot"].isin("official", "designated"), F.lit(False)) | F.coalesce(own["bicycle"].isin("official", "designated"), F.lit(False)), "yes")}


def normal_access(c: Column) -> Column:
    return F.when(c.isin(*ACCESS_YES), "yes").when(c.isin(*ACCESS_NO), "no").otherwise(c)


def inherit_access(*levels: Column, reserved: Column | None = None) -> Column:
    """yes or no: the first level (most specific first) that says either; yes if no level is set, else no.

    ``reserved``: the way is signed for some other mode, so that nothing set means no.
    """
    said = [F.when(normal_access(c).isin("yes", "no"), normal_access(c)) for c in levels]
    unset = F.lit(True)
    for c in levels:
        unset = unset & c.isNull()
    if reserved is not None:
        unset = unset & ~F.coalesce(reserved, F.lit(False))
    return F.coalesce(*said, F.when(unset, "yes").otherwise("no"))


def access_tree(access: Column, vehicle: Column, motor_vehicle: Column, leaves: Mapping[str, Column]) -> dict[str, Column]:
    """access -> vehicle -> motor_vehicle -> leaves; a node without a value takes its parent's."""
    v = F.coalesce(vehicle, access)
    m = F.coalesce(motor_vehicle, v)
    return {"vehicle": v, "motor_vehicle": m} | {k: F.coalesce(c, m) for k, c in leaves.items()}


def routable(*modes: Column) -> Column:
    """False where every mode is no."""
    out = F.lit(False)
    for m in modes:
        out = out | ~m.eqNullSafe("no")
    return out


def speed_class(kmh: Column, ladder: Sequence[tuple[int, int]] = SPEED_LADDER) -> Column:
    """The class of the first threshold that is exceeded; 0 for any other speed; null without a speed."""
    out = None
    for above, cls in ladder:
        out = F.when(kmh > above, cls) if out is None else out.when(kmh > above, cls)
    return out.when(kmh.isNotNull(), 0)


def highway_speed_class(kmh: Column, maxspeed: Column, highway: Column) -> Column:
    """The speed class that a limit gives to a highway; no limit at all gives the highest to the fastest highways."""
    kinds, out = (), None
    for above, cls, more in HIGHWAY_LADDER:
        kinds += more
        reached = (kmh > above) | (maxspeed.eqNullSafe("none") if out is None else F.lit(False))
        out = F.when(highway.isin(*kinds) & reached, cls) if out is None else out.when(highway.isin(*kinds) & reached, cls)
    for above, cls in OTHER_LADDER:
        out = out.when(kmh > above, cls)
    return out.when(kmh < 11, 0)


def collapse_link(c: Column) -> Column:
    return F.regexp_replace(c, "_link$", "")


def lookup(c: Column, table: Sequence[tuple[str, str | int]], default: str | None = None) -> Column:
    out = None
    for k, v in table:
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(F.lit(default)) if default is not None else out


def track_grade(tracktype: Column) -> Column:
    return lookup(tracktype, TRACKS, "feldweg023")


def unpaved(highway: Column, surface: Column, tracktype: Column, smoothness: Column, mtb_scale: Column | None = None, sac_scale: Column | None = None, sport: Column | None = None) -> Column:
    """Whether a highway counts as unpaved.

    The pattern for smoothness is matched whole, and its words have blanks around them, so plain values such as
    ``very_bad`` do not match. A minor way of which nothing is known is unpaved.
    """
    none = F.lit(None).cast("string")
    mtb_scale, sac_scale, sport = (none if c is None else c for c in (mtb_scale, sac_scale, sport))
    yes = lambda c: F.coalesce(c, F.lit(False))
    said = yes(surface.isin(*UNPAVED_SURFACES)) | mtb_scale.isNotNull() | yes(tracktype.rlike(r"\Agrade[2-5]\z"))
    said = said | yes(smoothness.rlike(r"\A.*(bad | very_bad | horrible | very_horrible | impassable)\z")) | sac_scale.isNotNull() | sport.eqNullSafe("via_ferrata")
    unknown = yes(highway.isin("bridleway", "path", "track")) & surface.isNull() & tracktype.isNull() & smoothness.isNull() & sac_scale.isNull()
    return highway.isNotNull() & (said | unknown)


def hiking(highway: Column, sac_scale: Column, name: Column, default_name: str = "Alpine trail", extended: bool = False) -> dict[str, Column]:
    """highway, name and closed: a graded path becomes a class of its own, its name ends in the grade, and from T4 on it is closed to all unless ``extended``."""
    path = highway.eqNullSafe("path") & F.coalesce(sac_scale.isin(*[k for k, _ in HIKING]), F.lit(False))
    grade = lookup(sac_scale, HIKING)
    named = F.concat(F.coalesce(name, F.lit(default_name)), F.lit(" (T"), grade.cast("string"), F.lit(")"))
    return {"highway": F.when(path, lookup(sac_scale, HIKING_CLASSES)).otherwise(highway), "name": F.when(path, named).otherwise(name), "closed": path & (grade >= 4) & F.lit(not extended)}


def retype_paths(highway: Column, bicycle: Column, foot: Column, signed: Column) -> Column:
    """Foot and cycle ways by who may use them: both, foot alone, bicycle alone; a path only where it is signed for them."""
    on, by = foot.eqNullSafe("yes"), bicycle.eqNullSafe("yes")
    path, signed = highway.eqNullSafe("path"), F.coalesce(signed, F.lit(False))
    footway, cycleway = highway.eqNullSafe("footway"), highway.eqNullSafe("cycleway")
    shared = by & on & (footway | cycleway | path & signed)
    return F.when(shared, "radfussweg").when(on & (footway | path & signed), "fussweg").when(cycleway | by & path & signed, "radweg").otherwise(highway)


def city_of(country: Column, levels: Mapping[int, Column], city: Column | None = None) -> Column:
    """The city of an address: city states always, then a city that is known, then the country's levels in order."""
    out = None
    for iso, level, names in CITY_STATES:
        hit = (country == iso) & levels[level].isin(*names)
        out = F.when(hit, levels[level]) if out is None else out.when(hit, levels[level])
    if city is not None:
        out = out.when(city.isNotNull(), city)
    for iso, level, prefixes in CITY_LEVELS:
        value = levels[level]
        for p in prefixes:
            value = F.replace(value, F.lit(p), F.lit(""))
        out = out.when((country == iso) & levels[level].isNotNull(), value)
    return out


def move_values(tags: Column, source: str, target: str, values: Sequence[str]) -> Column:
    """Tags after moving the listed values from one key to the other."""
    hit = F.coalesce(F.element_at(tags, F.lit(source)).isin(*values), F.lit(False))
    moved = F.map_concat(F.map_filter(tags, lambda k, v: ~k.isin(source, target)), F.create_map(F.lit(target), F.element_at(tags, F.lit(source))))
    return F.when(hit, moved).otherwise(tags)


def by_priority(df: DataFrame, priorities: DataFrame, on: Sequence[str], id_col: str, value: str = "value") -> DataFrame:
    """For each id the value of the rule of least priority among those that apply: long (id, level, value) against (country, level, priority)."""
    return df.join(priorities, list(on)).groupBy(id_col).agg(F.min_by(value, "priority").alias(value))


def split_affix(name: Column, prefixes: Sequence[str], suffixes: Sequence[str]) -> tuple[Column, Column, Column]:
    """Longest prefix, core and longest suffix of a road name."""
    longest = lambda xs: "|".join(sorted(("\\Q" + x + "\\E" if not x.isalnum() else x for x in xs), key=len, reverse=True))
    prefix = F.regexp_extract(name, f"^({longest(prefixes)}) ", 1) if prefixes else F.lit("")
    core = F.regexp_replace(name, f"^({longest(prefixes)}) ", "") if prefixes else name
    suffix = F.regexp_extract(core, f" ({longest(suffixes)})\\z", 1) if suffixes else F.lit("")
    if suffixes:
        core = F.regexp_replace(core, f" ({longest(suffixes)})\\z", "")
    return prefix, core, suffix


def contour_class(contour: Column, contour_ext: Column, ele: Column, extended: bool = False) -> Column:
    """minor, medium or major for elevation lines above zero; for all of them if ``extended``."""
    shown = contour.eqNullSafe("elevation") & (F.lit(True) if extended else F.coalesce(ele.try_cast("double") > 0, F.lit(False)))
    return F.when(shown, lookup(contour_ext, (("elevation_minor", "minor"), ("elevation_medium", "medium"), ("elevation_major", "major"))))


def compose_name(name: Column, brand: Column, operator: Column, ref: Column) -> Column:
    """Brand before name, a differing operator and the ref in brackets; parts that repeat are left out."""
    first = F.coalesce(brand, name, operator)
    other = F.array_distinct(F.filter(F.array(name, operator, ref), lambda x: x.isNotNull() & ~x.eqNullSafe(first)))
    return F.when(F.size(other) > 0, F.concat(F.coalesce(first, F.lit("")), F.lit(" ("), F.array_join(other, ", "), F.lit(")"))).otherwise(first)


def explode_levels(df: DataFrame, levels: Sequence[tuple[int, int]], low: str = "low", high: str = "high") -> DataFrame:
    """A row for each map level whose resolution a feature is visible at."""
    table = F.array(*[F.struct(F.lit(a).alias("level"), F.lit(r).alias("resolution")) for a, r in levels])
    seen = F.filter(table, lambda x: (x["resolution"] >= F.col(low)) & (x["resolution"] <= F.col(high)))
    return df.select("*", F.explode(seen).alias("l")).select("*", "l.level", "l.resolution").drop("l")


def prefer_names(tags: Column, keys: Sequence[str]) -> Column:
    """Tags whose name is the first of the listed tags that there is."""
    found = F.coalesce(*[F.element_at(tags, F.lit(k)) for k in keys])
    return F.when(found.isNotNull(), F.map_concat(F.map_filter(tags, lambda k, v: k != "name"), F.create_map(F.lit("name"), found))).otherwise(tags)


def road_control(features: DataFrame, prefix: str) -> DataFrame:
    """Features with road_class (0 to 4) and road_speed (0 to 7) as the reserved keys say.

    ``<prefix>road-class`` and ``<prefix>road-speed`` give a value, or a signed step from the rule's own;
    ``<prefix>road-speed-class`` gives a speed that nothing else changes. Features that are no roads stay as they are.
    """

    def controlled(column: str, key: str, most: int) -> Column:
        said, own = F.element_at("tags", F.lit(prefix + key)), F.col(column)
        number = said.try_cast("int")
        value = F.when(said.rlike(r"^[+-]"), own + number).otherwise(number)
        return F.greatest(F.lit(0), F.least(F.lit(most), F.coalesce(value, own)))

    fixed = F.element_at("tags", F.lit(prefix + "road-speed-class")).try_cast("int")
    road = F.col("road_class").isNotNull()
    speed = F.when(fixed.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(7), fixed))).otherwise(controlled("road_speed", "road-speed", 7))
    return features.withColumns({"road_class": F.when(road, controlled("road_class", "road-class", 4)), "road_speed": F.when(road, speed)})
