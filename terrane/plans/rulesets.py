"""Rule sets for the main keys, made from tables of fixed values.

Each function gives rule text. A table states, in natural order, the values of a key with the type
and the lowest resolution that a map has for it; the text around them is built here.
"""

from __future__ import annotations

from collections.abc import Mapping

# Landuse, type, resolution.
LANDUSE = (
    ("allotments", 0x23, 20), ("basin", 0x3F, 20), ("brownfield", 0x27, 20), ("cemetery", 0x1A, 20), ("commercial", 0x26, 20), ("conservation", 0x50, 20), ("construction", 0x27, 20),
    ("farm", 0x24, 17), ("farmland", 0x24, 17), ("field", 0x24, 17), ("farmyard", 0x49, 20), ("garages", 0x05, 20), ("grass", 0x17, 20), ("greenfield", 0x27, 20),
    ("greenhouse_horticulture", 0x4E, 20), ("harbour", 0x0C, 20), ("industrial", 0x0C, 17), ("landfill", 0x2A, 20), ("meadow", 0x17, 20), ("military", 0x04, 17), ("orchard", 0x4E, 20),
    ("plant_nursery", 0x4E, 20), ("quarry", 0x12, 20), ("railway", 0x0C, 20), ("recreation_ground", 0x17, 20), ("reservoir", 0x3F, 17), ("residential", 0x02, 17), ("retail", 0x08, 20),
    ("salt_pond", 0x3F, 20), ("village_green", 0x17, 20), ("vineyard", 0x1B, 20),
)
# Kind of wood, kind of leaves, type.
FORESTS = (("deciduous", "broadleaved", 0x15), ("coniferous", "needleleaved", 0x50), ("mixed", "mixed", 0x52))
# Natural areas.
NATURAL = (
    ("beach", 0x2E, 20), ("fell", 0x40, 17), ("glacier", 0x4D, 17), ("heath", 0x2B, 17), ("marsh", 0x51, 17), ("mud", 0x2F, 17), ("rock", 0x16, 17), ("bedrock", 0x16, 17), ("bare_rock", 0x16, 17),
    ("sand", 0x47, 20), ("scree", 0x43, 20), ("shingle", 0x43, 20), ("scrub", 0x4F, 20), ("water", 0x3C, 16),
)
# Waterway, aeroway and military areas.
WATER_AREAS = (("riverbank", 0x46, 17), ("dock", 0x3C, 17), ("dam", 0x3D, 20), ("weir", 0x3D, 20))
AERO_AREAS = (("aerodrome", 0x2D, 20), ("apron", 0x2C, 20), ("terminal", 0x38, 20), ("helipad", 0x2D, 20), ("tower", 0x38, 20))
MILITARY_AREAS = (("airfield", 0x2D, 20), ("barracks", 0x1C, 20), ("bunker", 0x1C, 20), ("danger_area", 0x21, 20), ("range", 0x21, 20), ("naval_base", 0x38, 20))
# Highway, type, class and speed for routing.
ROADS = (
    ("motorway", 0x01, 4, 7), ("trunk", 0x02, 4, 6), ("primary", 0x03, 2, 5), ("secondary", 0x04, 2, 4), ("tertiary", 0x05, 2, 3),
    ("residential", 0x06, 0, 2), ("unclassified", 0x07, 0, 2), ("service", 0x08, 0, 2), ("living_street", 0x09, 0, 0),
)
# Roundabouts of a highway, class and speed; their type.
ROUNDABOUTS = (("motorway", 4, 5), ("trunk", 4, 2), ("primary", 2, 2), ("secondary", 2, 2), ("tertiary", 2, 1), ("service", 0, 1), ("unclassified", 0, 1), ("residential", 0, 1))
ROUNDABOUT = 0x0C
# How a motorway is drawn, by ranges of resolution, and on bridges.
MOTORWAY_LOOKS = ((0x011F13, 24, 24), (0x010F0A, 22, 23), (0x010F0B, 20, 21), (0x010E0A, 14, 19))
MOTORWAY_BRIDGE = 0x010409
# Railway, type on bridges, type and resolution in tunnels, type and resolution elsewhere.
RAILWAYS = (
    ("rail", 0x010407, 0x012109, 22, 0x012103, 22), ("light_rail", 0x010407, 0x012108, 22, 0x012106, 22), ("monorail", 0x010407, 0x012108, 22, 0x012106, 22),
    ("subway", 0x010407, 0x012107, 22, 0x01210A, 22), ("tram", 0x010405, 0x01210E, 23, 0x14, 23),
)
# Railways drawn like rail; the platform; sidings and disused lines as above, which come before the others.
LIKE_RAIL = ("preserved", "narrow_gauge", "funicular")
PLATFORM = 0x010E1D
SIDINGS = (("rail & service = *", 0x010407, 0x012109, 23, 0x012113, 23), ("disused", 0x010407, 0x012109, 24, 0x012113, 24))
# Waterway, resolutions, type in the open, type in a tunnel, whether later rules are tried.
WATERWAYS = (
    ("canal", 24, 24, 0x26, 0x01201A, True), ("canal", 23, 23, 0x010102, 0x012018, True), ("canal", 21, 22, 0x010103, 0x012016, True),
    ("ditch", 24, 24, 0x01010A, 0x01201B, True), ("drain", 24, 24, 0x012104, 0x01201C, False),
    ("river", 24, 24, 0x1F, 0x012019, True), ("river", 23, 23, 0x010100, 0x012017, True), ("river", 21, 22, 0x010101, 0x012015, False), ("stream", 24, 24, 0x18, 0x01201D, False),
)
# Types and resolutions of walls across the water; a weir that is a building is none.
DAM, WEIR = (0x01010C, 23), (0x012105, 22)
# Lifts.
LIFTS = ((("cable_car", "gondola", "mixed_lift"), 0x011F1F), (("chair_lift", "drag_lift", "t-bar", "j-bar", "platter"), 0x011F1E), (("rope_tow",), 0x011F1E), (("magic_carpet",), 0x011F1E), (("goods",), 0x01210D))
LIFT_ROUTE = 0x11
# Place, type, resolution.
PLACES = (("city", 0x0200, 14), ("village", 0x0C00, 21), ("hamlet", 0x0D00, 24), ("allotments", 0x0D00, 24))
CAPITAL = (0x0100, 12, 1_000_000)


def ladder(key: str, table) -> str:
    return "\n".join(f"{key} = {value} [0x{kind:02x} resolution {low}]" for value, kind, low in table)


def landuse_areas() -> str:
    """landuse, with a misspelt forest repaired, forests and woods by their leaves, and meadows that go on."""
    woods = "(landuse = forest | natural = wood)"
    first = [x[0] for x in LANDUSE].index("garages")  # woods come between
    lines = ["landuse = forrest { set landuse = forest }", ladder("landuse", LANDUSE[:first])]
    lines += [f"{woods} & (wood = {w} | leaf_type = {leaf}) [0x{kind:02x} resolution 17]" for w, leaf, kind in FORESTS]
    lines += [f"{woods} [0x52 resolution 17]", ladder("landuse", LANDUSE[first:]).replace("meadow [0x17 resolution 20]", "meadow [0x17 resolution 20 continue]")]
    return "\n".join(lines)


def natural_areas() -> str:
    return ladder("natural", NATURAL) + "\nnatural = wetland & wetland = tidalflat [0x56 resolution 20]\nnatural = wetland [0x51 resolution 20]"


def other_areas() -> str:
    return "\n".join((ladder("waterway", WATER_AREAS), ladder("aeroway", AERO_AREAS), ladder("military", MILITARY_AREAS)))


def power_areas() -> str:
    """Power stations, and substations, which end an entity, show earlier if they are long; needs a column ``length``."""
    kinds = (("power = generator | power = station | power = plant", " continue"), ("power = sub_station | power = substation", ""))
    return "\n".join(f"({any_of}) & building != yes & length() {op} 150 [0x25 resolution {low}{goes_on}]" for any_of, goes_on in kinds for op, low in ((">", 22), ("<=", 24)))


def roads() -> str:
    """The one routable line of a highway, roundabouts first, then how motorways are drawn; names end up as labels."""
    lines = [f"junction = roundabout & highway = {h} {{ set routed = yes }} [0x{ROUNDABOUT:02x} road_class={c} road_speed={v} resolution 24 continue with_actions]" for h, c, v in ROUNDABOUTS]
    named = {"motorway": "set name = '${ref}' | ''; ", "trunk": (both := "set name = '${name}' | '${ref}' | ''; "), "primary": both, "secondary": both, "tertiary": both}
    lines += [f"highway = {h} & routed != yes {{ {named.get(h, '')}set routed = yes }} [0x{kind:02x} road_class={c} road_speed={v} resolution 24 continue with_actions]" for h, kind, c, v in ROADS]
    lines.append(f"highway = motorway & bridge = * & bridge != no [0x{MOTORWAY_BRIDGE:06x} resolution 24 continue]")
    lines += [f"highway = motorway [0x{kind:06x} resolution {low}-{high} continue]" for kind, low, high in MOTORWAY_LOOKS]
    return "\n".join([*lines, labels()])


def labels() -> str:
    """The end of a line rule set: the name is the label, then up to three parts of each kind of reference, none twice."""
    refs = ("ref", "int_ref", "nat_ref", "reg_ref")
    return "<finalize>\nname = * { name '${name}' }\n" + "\n".join(f"{r} = * {{ " + " ".join(f"addlabel '${{{r}|part:;:{i}}}';" for i in (1, 2, 3)) + " }" for r in refs)


def railways() -> str:
    """Preserved, narrow-gauge and funicular railways are rail; sidings and disused lines are told apart before it."""
    lines = [f"railway = {value} {{ set railway = rail }}" for value in LIKE_RAIL]
    lines.append(f"railway = platform & (area != * | area = no) [0x{PLATFORM:06x} resolution 24]")
    for value, bridge, tunnel, tunnel_low, plain, low in SIDINGS + RAILWAYS:
        lines += [f"railway = {value} & bridge = * & bridge != no [0x{bridge:06x} resolution 24 continue]", f"railway = {value} & tunnel = yes [0x{tunnel:06x} resolution {tunnel_low}]", f"railway = {value} [0x{plain:02x} resolution {low}]"]
    return "\n".join(lines)


def waterways() -> str:
    """Drains, streams and a river's last range end an entity, the others let later rules have it."""
    lines = [f"waterway = dam [0x{DAM[0]:06x} resolution {DAM[1]} continue]", f"waterway = weir & building != * [0x{WEIR[0]:06x} resolution {WEIR[1]} continue]"]
    for value, low, high, open_, closed, goes_on in WATERWAYS:
        lines += [f"waterway = {value} & tunnel {op} * [0x{kind:02x} resolution {low}-{high}{' continue' * goes_on}]" for op, kind in (("!=", open_), ("=", closed))]
    return "\n".join(lines)


def lifts() -> str:
    """Lifts that carry people are routable as well as drawn."""
    lines = []
    for i, (values, kind) in enumerate(LIFTS):
        any_of = " | ".join(f"aerialway = {v}" for v in values)
        lines += [f"({any_of}) [0x{LIFT_ROUTE:02x} road_class=0 road_speed=0 resolution 24 continue]"] * (i < 2) + [f"({any_of}) [0x{kind:06x} resolution 23]"]
    return "\n".join(lines)


def places() -> str:
    kind, low, people = CAPITAL
    return f"place = city & (population > {people} | capital = true) {{ name '${{name}}' }} [0x{kind:04x} resolution {low}]\n" + ladder("place", PLACES).replace(" [", " { name '${name}' } [")


def huts_and_fuel(words: Mapping[str, str]) -> str:
    """Mountain huts by name and height, filling stations by brand, operator or name; ``words`` has the default names."""
    hut, fuel = words["ALPINEHUT"], words["FUELSTATION"]
    return f"""tourism = alpine_hut {{ name '${{name}} (${{ele}})' | '${{name}}' | '{hut} (${{ele}})' | '{hut}' }} [0x4803 resolution 23]
amenity = fuel {{ name '${{brand}}' | '${{operator}}' | '${{name}}' | '{fuel}' }} [0x2f01 resolution 24]"""
