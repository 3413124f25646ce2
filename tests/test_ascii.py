"""Texts as ASCII against Python's own decomposition."""

from __future__ import annotations

import unicodedata

from docweave import plans

TEXTS = [None, "", "plain", "Größe – “naïve” café…", "it’s\u00a0½ ﬁn — Ångström", "\U0001F600 only 東京 e\u0301", "Ⅳ ２０ x² ‘a’ „b”"]
FIXED = dict(zip("\u2010\u2011\u2012\u2013\u2014\u2015\u2018\u2019\u201a\u201c\u201d\u201e\u00a0\u2009\u202f", "------'''\"\"\"   ", strict=True))


def plain(text: str | None) -> str | None:
    fixed = text and "".join(FIXED.get(c, c) for c in text)
    return fixed and unicodedata.normalize("NFKD", fixed).encode("ascii", "ignore").decode()


def test_every_document_in_ascii(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = plans.queries()["document_ascii"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["ascii"]) for r in got) == [(i, plain(t)) for i, t in enumerate(TEXTS)]
