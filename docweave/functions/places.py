"""The places known here: regions, nations, states and cities."""

from __future__ import annotations

from docweave.functions import vocabulary as v

# The regions of the nations in ``vocabulary.NATIONS``, with a code and what else they are called.
REGIONS = {
    "Europe": ("EU", ("Continental Europe", "European Union"), "FR DE RO RU GB CH SE NO DK PL ES IT NL IE TR"),
    "Asia": ("ASIA", ("Asia Pacific", "Asia-Pacific", "Southeast Asia"), "IN ID JP CN VN HK KR SG TH MY PH"),
    "Middle East": ("MIDEAST", ("Persian Gulf",), "IR IQ JO SA IL"),
    "Africa": ("AFRICA", ("Sub-Saharan Africa", "North Africa", "West Africa"), "DZ EG ET KE MA MZ ZA NG"),
    "Latin America": ("LATAM", ("South America", "Central America", "Caribbean"), "AR BR PE MX CL BM KY"),
    "North America": ("NORTHAM", (), "CA US"),
    "Oceania": ("OCEANIA", (), "AU MH"),
}
# The states of the United States, with a city of each.
STATES = (
    ("Alabama", "Birmingham"), ("Alaska", "Anchorage"), ("Arizona", "Phoenix"), ("Arkansas", "Little Rock"), ("California", "Los Angeles"), ("Colorado", "Denver"), ("Connecticut", "Hartford"),
    ("Delaware", "Wilmington"), ("Florida", "Miami"), ("Georgia", "Atlanta"), ("Hawaii", "Honolulu"), ("Idaho", "Boise"), ("Illinois", "Chicago"), ("Indiana", "Indianapolis"), ("Iowa", "Des Moines"),
    ("Kansas", "Wichita"), ("Kentucky", "Louisville"), ("Louisiana", "New Orleans"), ("Maine", "Bangor"), ("Maryland", "Baltimore"), ("Massachusetts", "Boston"), ("Michigan", "Detroit"),
    ("Minnesota", "Minneapolis"), ("Mississippi", "Biloxi"), ("Missouri", "Kansas City"), ("Montana", "Billings"), ("Nebraska", "Omaha"), ("Nevada", "Las Vegas"), ("New Hampshire", "Manchester"),
    ("New Jersey", "Newark"), ("New Mexico", "Albuquerque"), ("New York", "New York City"), ("North Carolina", "Charlotte"), ("North Dakota", "Fargo"), ("Ohio", "Cleveland"), ("Oklahoma", "Tulsa"),
    ("Oregon", "Portland"), ("Pennsylvania", "Philadelphia"), ("Rhode Island", "Providence"), ("South Carolina", "Charleston"), ("South Dakota", "Sioux Falls"), ("Tennessee", "Nashville"),
    ("Texas", "Houston"), ("Utah", "Salt Lake City"), ("Vermont", "Burlington"), ("Virginia", "Richmond"), ("Washington", "Seattle"), ("West Virginia", "Huntington"), ("Wisconsin", "Milwaukee"), ("Wyoming", "Cheyenne"),
)
# States and cities of other nations.
ELSEWHERE = {
    "CA": (("Ontario", "Toronto"), ("Quebec", "Montreal"), ("British Columbia", "Vancouver"), ("Alberta", "Calgary"), ("Manitoba", "Winnipeg")),
    "GB": (("Scotland", "Glasgow"), ("Wales", "Cardiff"), ("Northern Ireland", "Belfast")),
    "DE": (("Bavaria", "Munich"), ("Hesse", "Frankfurt"), ("Saxony", "Dresden")),
    "IN": (("Maharashtra", "Mumbai"), ("Karnataka", "Bangalore"), ("Gujarat", "Ahmedabad")),
    "CN": (("Guangdong", "Shenzhen"), ("Zhejiang", "Hangzhou"), ("Sichuan", "Chengdu")),
    "AU": (("New South Wales", "Sydney"), ("Queensland", "Brisbane"), ("Western Australia", "Perth")),
    "MX": (("Jalisco", "Guadalajara"), ("Nuevo Leon", "Monterrey")),
    "BR": (("Bahia", "Salvador"), ("Minas Gerais", "Belo Horizonte")),
}


def place_rows() -> list[tuple]:
    """(phrase, kind, region, nation, state, city, code) of every place."""
    rows, region_of = [], {}
    for region, (code, also, members) in REGIONS.items():
        rows += [(p, "region", region, None, None, None, code) for p in (region, *also)]
        region_of |= dict.fromkeys(members.split(), region)
    names = {code: name for name, code, _ in v.NATIONS}
    for name, code, capital in v.NATIONS:
        rows.append((name, "nation", region_of.get(code), name, None, None, code))
        if capital != name:
            rows.append((capital, "city", region_of.get(code), name, None, capital, code))
    for code, states in {"US": STATES, **ELSEWHERE}.items():
        for state, city in states:
            rows.append((state, "state", region_of.get(code), names[code], state, None, code))
            rows.append((city, "city", region_of.get(code), names[code], state, city, code))
    return rows


def place_names() -> list[str]:
    return list(dict.fromkeys(row[0] for row in place_rows()))
