"""Words that the span operators know: currencies, units, months, nouns that are counted. Public facts, plainly listed."""

from __future__ import annotations

# ISO 4217 code, symbols, adjective, noun, nations.
CURRENCIES = (
    ("USD", ("$", "US$"), "US", "dollar", ("US",)),
    ("EUR", ("€",), "European", "euro", ("DE", "FR", "ES", "IT", "NL", "IE", "FI", "AT", "BE", "PT", "GR")),
    ("GBP", ("£",), "British", "pound", ("GB",)),
    ("JPY", ("¥",), "Japanese", "yen", ("JP",)),
    ("CNY", ("RMB",), "Chinese", "yuan", ("CN",)),
    ("INR", ("₹", "Rs."), "Indian", "rupee", ("IN",)),
    ("CAD", ("C$",), "Canadian", "dollar", ("CA",)),
    ("AUD", ("A$",), "Australian", "dollar", ("AU",)),
    ("NZD", ("NZ$",), "New Zealand", "dollar", ("NZ",)),
    ("HKD", ("HK$",), "Hong Kong", "dollar", ("HK",)),
    ("SGD", ("S$",), "Singapore", "dollar", ("SG",)),
    ("CHF", ("SFr.",), "Swiss", "franc", ("CH",)),
    ("SEK", ("kr",), "Swedish", "krona", ("SE",)),
    ("NOK", ("kr",), "Norwegian", "krone", ("NO",)),
    ("DKK", ("kr",), "Danish", "krone", ("DK",)),
    ("PLN", ("zł",), "Polish", "zloty", ("PL",)),
    ("CZK", ("Kč",), "Czech", "koruna", ("CZ",)),
    ("HUF", ("Ft",), "Hungarian", "forint", ("HU",)),
    ("BRL", ("R$",), "Brazilian", "real", ("BR",)),
    ("MXN", ("Mex$",), "Mexican", "peso", ("MX",)),
    ("ARS", (), "Argentine", "peso", ("AR",)),
    ("CLP", (), "Chilean", "peso", ("CL",)),
    ("PEN", ("S/",), "Peruvian", "sol", ("PE",)),
    ("ZAR", (), "South African", "rand", ("ZA",)),
    ("KRW", ("₩",), "Korean", "won", ("KR",)),
    ("RUB", ("₽",), "Russian", "ruble", ("RU",)),
    ("TRY", ("₺",), "Turkish", "lira", ("TR",)),
    ("ILS", ("₪",), "Israeli", "shekel", ("IL",)),
    ("SAR", (), "Saudi", "riyal", ("SA",)),
    ("EGP", (), "Egyptian", "pound", ("EG",)),
    ("KES", ("KSh",), "Kenyan", "shilling", ("KE",)),
    ("IDR", ("Rp",), "Indonesian", "rupiah", ("ID",)),
    ("VND", ("₫",), "Vietnamese", "dong", ("VN",)),
    ("THB", ("฿",), "Thai", "baht", ("TH",)),
    ("MYR", ("RM",), "Malaysian", "ringgit", ("MY",)),
    ("PHP", ("₱",), "Philippine", "peso", ("PH",)),
    ("NGN", ("₦",), "Nigerian", "naira", ("NG",)),
    ("MAD", (), "Moroccan", "dirham", ("MA",)),
    ("RON", ("lei",), "Romanian", "leu", ("RO",)),
    ("DZD", (), "Algerian", "dinar", ("DZ",)),
    ("ETB", (), "Ethiopian", "birr", ("ET",)),
    ("MZN", (), "Mozambican", "metical", ("MZ",)),
    ("JOD", (), "Jordanian", "dinar", ("JO",)),
    ("IQD", (), "Iraqi", "dinar", ("IQ",)),
    ("IRR", (), "Iranian", "rial", ("IR",)),
)
#: Currencies whose sign follows the number.
SIGN_AFTER = ("INR", "SEK", "NOK", "DKK", "PLN", "CZK", "HUF", "RON")

# Nation name, code, capital.
NATIONS = (
    ("Algeria", "DZ", "Algiers"), ("Argentina", "AR", "Buenos Aires"), ("Brazil", "BR", "Brasilia"), ("Canada", "CA", "Ottawa"), ("Egypt", "EG", "Cairo"),
    ("Ethiopia", "ET", "Addis Ababa"), ("France", "FR", "Paris"), ("Germany", "DE", "Berlin"), ("India", "IN", "New Delhi"), ("Indonesia", "ID", "Jakarta"),
    ("Iran", "IR", "Tehran"), ("Iraq", "IQ", "Baghdad"), ("Japan", "JP", "Tokyo"), ("Jordan", "JO", "Amman"), ("Kenya", "KE", "Nairobi"),
    ("Morocco", "MA", "Rabat"), ("Mozambique", "MZ", "Maputo"), ("Peru", "PE", "Lima"), ("China", "CN", "Beijing"), ("Romania", "RO", "Bucharest"),
    ("Saudi Arabia", "SA", "Riyadh"), ("Vietnam", "VN", "Hanoi"), ("Russia", "RU", "Moscow"), ("United Kingdom", "GB", "London"), ("United States", "US", "Washington"),
    ("Australia", "AU", "Canberra"), ("Hong Kong", "HK", "Hong Kong"), ("Switzerland", "CH", "Bern"), ("Sweden", "SE", "Stockholm"), ("Norway", "NO", "Oslo"),
    ("Denmark", "DK", "Copenhagen"), ("Poland", "PL", "Warsaw"), ("Spain", "ES", "Madrid"), ("Italy", "IT", "Rome"), ("Netherlands", "NL", "Amsterdam"),
    ("Ireland", "IE", "Dublin"), ("Mexico", "MX", "Mexico City"), ("Chile", "CL", "Santiago"), ("South Africa", "ZA", "Pretoria"), ("South Korea", "KR", "Seoul"),
    ("Singapore", "SG", "Singapore"), ("Turkey", "TR", "Ankara"), ("Israel", "IL", "Jerusalem"), ("Thailand", "TH", "Bangkok"), ("Malaysia", "MY", "Kuala Lumpur"),
    ("Philippines", "PH", "Manila"), ("Nigeria", "NG", "Abuja"), ("Bermuda", "BM", "Hamilton"), ("Cayman Islands", "KY", "George Town"), ("Marshall Islands", "MH", "Majuro"),
)
#: Where firms are registered rather than run.
HAVENS = ("BM", "KY", "MH", "VG", "JE", "GG", "IM", "PA", "LU")
REGIONS = ("EU", "ASIA", "AFRICA", "LATAM")

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
MONTHS_SHORT = ("Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sept", "Sep", "Oct", "Nov", "Dec")
ZONES = ("UTC", "GMT", "EST", "EDT", "ET", "CST", "CDT", "CT", "MST", "MDT", "MT", "PST", "PDT", "PT", "CET", "CEST", "BST", "IST", "JST", "HKT", "AEST")
TIME_UNITS = ("day", "week", "month", "quarter", "year", "yr", "hour", "hr", "minute", "min", "second", "sec")

# Unit, dimension, how many of the dimension's base unit it is, whether it may touch its number.
UNITS = (
    ("metre", "length", 1.0, False), ("meter", "length", 1.0, False), ("kilometre", "length", 1000.0, False), ("kilometer", "length", 1000.0, False), ("km", "length", 1000.0, True),
    ("centimetre", "length", 0.01, False), ("centimeter", "length", 0.01, False), ("cm", "length", 0.01, True), ("millimetre", "length", 0.001, False), ("mm", "length", 0.001, True),
    ("mile", "length", 1609.344, False), ("yard", "length", 0.9144, False), ("foot", "length", 0.3048, False), ("feet", "length", 0.3048, False), ("inch", "length", 0.0254, False),
    ("gram", "mass", 1.0, False), ("kilogram", "mass", 1000.0, False), ("kg", "mass", 1000.0, True), ("tonne", "mass", 1_000_000.0, False), ("metric ton", "mass", 1_000_000.0, False),
    ("ton", "mass", 907_184.74, False), ("pound", "mass", 453.59237, False), ("lb", "mass", 453.59237, True), ("ounce", "mass", 28.349523125, False), ("oz", "mass", 28.349523125, True),
    ("litre", "volume", 1.0, False), ("liter", "volume", 1.0, False), ("millilitre", "volume", 0.001, False), ("cubic metre", "volume", 1000.0, False), ("cubic meter", "volume", 1000.0, False),
    ("cubic foot", "volume", 28.316846592, False), ("cubic feet", "volume", 28.316846592, False), ("gallon", "volume", 3.785411784, False), ("barrel", "volume", 158.987294928, False), ("bushel", "volume", 35.23907016688, False),
    ("acre", "area", 4046.8564224, False), ("hectare", "area", 10_000.0, False), ("square metre", "area", 1.0, False), ("square meter", "area", 1.0, False), ("square foot", "area", 0.09290304, False),
    ("square feet", "area", 0.09290304, False), ("square mile", "area", 2_589_988.110336, False), ("square kilometer", "area", 1_000_000.0, False),
    ("watt", "power", 1.0, False), ("kilowatt", "power", 1000.0, False), ("kW", "power", 1000.0, True), ("megawatt", "power", 1_000_000.0, False), ("MW", "power", 1_000_000.0, True), ("gigawatt", "power", 1e9, False),
    ("kilowatt hour", "energy", 3.6e6, False), ("kWh", "energy", 3.6e6, True), ("megawatt hour", "energy", 3.6e9, False), ("MWh", "energy", 3.6e9, True), ("joule", "energy", 1.0, False),
    ("Btu", "energy", 1055.05585262, True), ("MMBtu", "energy", 1.05505585262e9, True), ("therm", "energy", 105_505_585.262, False),
    ("byte", "data", 1.0, False), ("kilobyte", "data", 1e3, False), ("megabyte", "data", 1e6, False), ("gigabyte", "data", 1e9, False), ("GB", "data", 1e9, True), ("terabyte", "data", 1e12, False), ("TB", "data", 1e12, True), ("bit", "data", 0.125, False),
)

WORKERS = ("employee", "worker", "staff", "personnel", "associate", "team member", "person", "people", "individual", "contractor", "engineer", "manager", "driver", "miner", "nurse", "teacher", "technician", "headcount", "workforce", "full-time equivalent")
#: Words for workers that may stand for each other: of any kind, by trade, by rank.
WORKER_POOLS = {
    "general": ("employees", "workers", "staff", "personnel", "associates"),
    "trades": ("engineers", "drivers", "miners", "nurses", "teachers", "technicians", "mechanics", "electricians"),
    "ranks": ("managers", "supervisors", "executives", "directors", "officers"),
}
DEPARTMENTS = ("research", "research and development", "engineering", "sales", "marketing", "manufacturing", "production", "operations", "administration", "finance", "accounting", "customer service", "management", "distribution", "logistics", "legal", "human resources", "information technology")
WORK_EVENTS = ("hired", "employed", "laid off", "terminated", "recruited", "dismissed", "furloughed", "eliminated", "added", "retained")
SITES = ("store", "office", "facility", "facilities", "plant", "warehouse", "location", "branch", "branches", "restaurant", "hotel", "factory", "factories", "mine", "site", "country", "countries", "state", "city", "cities", "market", "region", "center", "centre", "hospital", "school")
# Words of a sentence about unions and disputes.
UNIONS = ("union", "unions", "unionized", "non-union", "collective bargaining", "works council", "labor agreement", "work stoppage", "on strike", "lockout")
ENTITIES = ("company", "companies", "subsidiary", "subsidiaries", "customer", "supplier", "contract", "agreement", "lawsuit", "claim", "patent", "trademark", "vessel", "aircraft", "vehicle", "loan", "director", "segment", "unit", "product", "well", "project", "member", "collective bargaining agreement", "bargaining unit", "swap", "option contract", "futures contract", "note")
INSTRUMENTS = ("swap", "option", "futures", "forward", "bond", "note", "debenture", "warrant", "derivative", "cap", "collar", "coupon", "strike", "notional", "spot", "denominated")
SHARES = ("share", "stock option", "option", "restricted stock unit", "RSU", "warrant", "ADS", "unit", "common stock", "preferred stock", "ordinary share")
EQUITY = ("stock", "share", "equity", "dividend", "shareholder", "stockholder", "issued", "outstanding", "vested", "granted", "repurchase")
SURE_SHARES = ("share", "stock", "option", "RSU", "PSU", "DSU", "SAR", "warrant", "restricted stock unit")
# What is done with a number of shares or things, and what such a number is called.
COUNT_VERBS = (
    "issuing", "issued", "issues", "issuable", "granting", "granted", "grants", "repurchasing", "repurchased", "repurchases", "sell", "selling", "sells", "sold",
    "acquiring", "acquired", "acquires", "authorizing", "authorized", "authorizes", "exercising", "exercised", "exercises", "converting", "converted", "converts",
    "redeeming", "redeemed", "redeems", "surrendering", "surrendered", "surrenders", "canceling", "cancelling", "canceled", "cancelled", "cancels",
    "awarding", "awarded", "awards", "settling", "settled", "settles", "delivering", "delivered", "delivers", "exchanging", "exchanged", "exchanges",
)
COUNT_ADJECTIVES = ("outstanding", "vested", "unvested", "diluted", "weighted average")
CHANGES = ("increase", "increased", "decrease", "decreased", "rise", "rose", "fall", "fell", "growth", "grew", "decline", "declined", "gain", "gained", "drop", "dropped", "up", "down", "change", "changed", "reduction", "improvement")
CHANGES_AFTER = ("more", "less", "higher", "lower", "above", "below", "greater", "fewer")
RATE_HEADS = ("rate", "ratio", "yield", "margin", "coupon", "interest", "tax", "discount")
STANDARDS = ("SFAS", "FAS", "ASU", "ASC", "IFRS", "IAS", "IFRIC", "SIC", "EITF", "SOP", "FSP", "FIN", "APB", "SFAC", "GAAP")
GUIDANCE = ("Statement", "Interpretation", "Opinion", "Topic", "Subtopic", "Bulletin", "Standard", "Guidance", "Rule", "Regulation", "Release")
EXHIBITS = ("Exhibit", "Note", "Notes", "Schedule", "Section", "Sections", "Item", "Items", "Page", "Pages", "Part", "Appendix", "Annex", "Article", "Table", "Figure", "Footnote", "Paragraph", "Form", "No.")
INDEXES = ("S&P", "Nasdaq", "Dow Jones", "Russell", "Wilshire", "Fortune", "MSCI", "FTSE", "Nikkei", "TOPIX", "Hang Seng", "DAX", "CAC", "IBEX", "SMI", "ASX", "TSX", "KOSPI", "Nifty", "Euro Stoxx")
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Boulevard", "Blvd", "Drive", "Dr", "Lane", "Ln", "Way", "Court", "Ct", "Plaza", "Square", "Parkway", "Highway", "Terrace", "Place")
STREETS_SHORT = ("St", "Ave", "Rd", "Blvd", "Dr", "Ln", "Ct")
STATES = ("AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC")
COMMODITIES = ("crude oil", "natural gas", "gasoline", "diesel", "propane", "coal", "electricity", "gold", "silver", "copper", "platinum", "palladium", "aluminum", "nickel", "zinc", "lead", "iron ore", "steel", "corn", "wheat", "soybean", "cotton", "coffee", "cocoa", "sugar", "cattle", "hog", "lumber")

# Number words.
ONES = {w: n for n, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split())}
TENS = {w: 10 * n for n, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
SCALES = {"dozen": 12, "hundred": 100, "thousand": 1_000, "million": 1_000_000, "billion": 1_000_000_000, "trillion": 1_000_000_000_000}
FRACTIONS = {"half": 2, "halves": 2, "third": 3, "quarter": 4, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10}
