"""Commodities in text and their categories: a noun of a category, with the grade or origin that may stand before it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.find import claim, find_all, longest_first
from docweave.functions.patterns import any_of

HIT = "struct<start:int,end:int,text:string,category:string>"
#: Category: nouns, and what may qualify them.
CATEGORIES = {
    "energy": (("crude oil", "crude", "natural gas", "gasoline", "diesel", "heating oil", "jet fuel", "propane", "ethanol", "coal", "electricity", "uranium"), ("West Texas", "Brent", "light sweet", "heavy sour", "ultra-low sulfur", "low-sulfur", "liquefied", "thermal", "metallurgical", "unleaded")),
    "metals": (("gold", "silver", "copper", "platinum", "palladium", "aluminum", "nickel", "zinc", "lead", "tin", "iron ore", "steel", "cobalt", "lithium"), ("refined", "scrap", "hot-rolled", "stainless")),
    "crops": (("corn", "wheat", "soybeans", "soybean meal", "soybean oil", "rice", "oats", "barley", "canola", "cotton"), ("hard red", "soft red", "yellow", "white")),
    "softs": (("coffee", "cocoa", "sugar", "orange juice", "rubber", "lumber", "wool"), ("arabica", "robusta", "raw")),
    "livestock": (("cattle", "hogs", "pork bellies", "poultry", "sheep"), ("live", "feeder", "lean")),
    "dairy": (("milk", "cheese", "butter", "whey"), ("nonfat", "dry", "cheddar")),
    "chemicals": (("ammonia", "urea", "potash", "phosphate", "ethylene", "polyethylene", "methanol", "sulfur"), ("anhydrous", "granular")),
    "water": (("water rights", "fresh water", "brine"), ()),
    "emissions": (("carbon credits", "emission allowances", "renewable energy credits", "carbon offsets"), ("voluntary", "certified")),
}


def _pattern(category: str) -> str:
    nouns, before = CATEGORIES[category]
    qualified = rf"(?:{any_of(before)}\s+)*" if before else ""
    return rf"(?i)(?<![\w-]){qualified}{any_of(nouns)}(?![\w-])"


def found(text: Column) -> Column:
    """array<struct<start, end, text, category>>, by start; of overlapping names the longest stays. Null texts give null."""
    each = [F.transform(find_all(text, _pattern(c)), _of(c)) for c in CATEGORIES]
    return F.array_sort(claim(longest_first(F.concat(*each)), HIT))


def _of(category: str):
    return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"), F.lit(category).alias("category"))
