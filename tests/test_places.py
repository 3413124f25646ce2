"""Places in texts: the trie against the join, nested lists, odd rows."""

from __future__ import annotations

import random

from docweave.operators import dictionary, gazetteer


def test_trie_finds_what_the_join_finds(spark):
    rng = random.Random(5)
    words = ["new", "york", "city", "st.", "a&b", "o'hara", "é", "x-y", "7", "of"]
    phrases = list({" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(60)}) + ["New York", None, "", "..."]
    texts = [" ".join(rng.choice([*words, "NEW", "York,", "(city)", "...", "_", "-"]) for _ in range(rng.randint(0, 30))) for _ in range(80)] + [None, ""]
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(phrases)], "phrase string, n int")
    df = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    key = lambda r: tuple((x is None, x) for x in r)
    one = sorted((tuple(r) for r in dictionary.hits(df, "key", "text", listed).collect()), key=key)
    other = sorted((tuple(r) for r in dictionary.hits(df, "key", "text", listed, most_phrases=3).collect()), key=key)
    assert one == other and len(one) > 100


def test_nested_list(spark):
    nested = spark.createDataFrame(
        [("France", "FR", "Europe", ["French Republic"], [("Brittany", ["Breizh"], [("Brest", None)]), ("Alsace", None, None)])],
        "name string, code string, region string, phrases array<string>, locations array<struct<name:string,phrases:array<string>,cities:array<struct<name:string,phrases:array<string>>>>>",
    )
    places = gazetteer.flattened(nested)
    assert {(r["phrase"], r["kind"], r["state"], r["city"]) for r in places.collect()} == {
        ("France", "nation", None, None), ("French Republic", "nation", None, None), ("Brittany", "state", "Brittany", None), ("Breizh", "state", "Brittany", None),
        ("Alsace", "state", "Alsace", None), ("Brest", "city", "Brittany", "Brest"),
    }
    df = spark.createDataFrame([(1, "We own 4 offices: 3 in Brest, 2001 in Breizh. Then 5 in France."), (2, None), (3, "")], "k int, t string")
    got = [(r["k"], r["label"], r["text"], r["city"]) for r in gazetteer.counts(df, "k", "t", places).orderBy("start").collect()]
    assert got == [(1, "LOCATION_COUNT", "3 in Brest", "Brest"), (1, "LOCATION_COUNT", "2001 in Breizh", None)]


def test_built_in_places_have_regions(spark):
    rows = gazetteer.gazetteer(spark).collect()
    assert all(r["region"] for r in rows) and len({r["phrase"] for r in rows if r["kind"] == "nation"}) == 50
