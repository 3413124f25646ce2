"""Queries of the text, number, filing and variation functions, each with SQL that says the same in its own words.

Inputs are sentences made of the order table's numbers, so that every branch of a rule is met: a row's place in a small
cycle decides which form it has.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions import filings as fl
from docweave.functions import find
from docweave.functions import numbers as nm
from docweave.functions import patterns as pt
from docweave.functions import text as tx
from docweave.functions import vocabulary as v
from docweave.operators import dictionary, documents, filing, fx, mutate, store, training
from docweave.plans.corpus import table
from docweave.sources import tables as sources

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def key() -> Column:
    return F.col("o_orderkey")


def customer() -> Column:
    return F.col("o_custkey")


def said(*parts: Column | str) -> Column:
    """A sentence of pieces, numbers as they are."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def cycle(n: int, *options: Column | str) -> Column:
    """The option that a row's place in a cycle of ``n`` picks."""
    out = None
    for i, o in enumerate(options[:-1]):
        o = F.lit(o) if isinstance(o, str) else o
        out = F.when(key() % n == i, o) if out is None else out.when(key() % n == i, o)
    return out.otherwise(F.lit(options[-1]) if isinstance(options[-1], str) else options[-1])


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


# ---------------------------------------------------------------- sources


@query(
    """with f as (select o_custkey as cik, ['10-K', '8-K', '20-F', '10-Q', '10-K405'][o_orderkey % 5 + 1] as form, lpad(cast(o_orderkey as varchar), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(cast(o_custkey as varchar), 6, '0') as dashed,
      case o_orderkey % 3 when 0 then '' when 1 then 'report.htm' else 'full.txt' end as doc, strftime(o_orderdate, '%Y-%m-%d') as filed, cast(year(o_orderdate) - 1 as varchar) || '-12-31' as reported from orders)
    select cik, 'Firm ' || cast(cik as varchar) as name, form, replace(dashed, '-', '') as accession,
      'https://www.sec.gov/Archives/edgar/data/' || cast(cik as varchar) || '/' || replace(dashed, '-', '') || '/' || case when doc = 'report.htm' then doc else dashed || '.txt' end as url, filed as filing_date, reported as report_date
    from f where form in ('10-K', '20-F', '10-K405') and reported like '1996%'"""
)
def annual_filings(spark, sf_dir):
    """Filings of submission documents, of one reporting year: SRC10, SRC11, FLT2, FLT3, SET1."""
    dashed = F.concat_ws("-", F.lpad(key().cast("string"), 10, "0"), F.date_format("o_orderdate", "yy"), F.lpad(customer().cast("string"), 6, "0"))
    one = F.struct(cycle(5, "10-K", "8-K", "20-F", "10-Q", "10-K405").alias("form"), dashed.alias("accessionNumber"), cycle(3, "", "report.htm", "full.txt").alias("primaryDocument"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filingDate"), said(F.year("o_orderdate") - 1, "-12-31").alias("reportDate"))
    each = orders(spark, sf_dir).groupBy(customer().alias("cik")).agg(F.collect_list(one).alias("r"))
    lists = F.struct(*[F.transform("r", _field(n)).alias(n) for n in ("form", "accessionNumber", "primaryDocument", "filingDate", "reportDate")])
    bodies = each.select("cik", F.to_json(F.struct(said("Firm ", F.col("cik")).alias("name"), F.struct(lists.alias("recent")).alias("filings"))).alias("body"))
    recent, older = sources.filings(bodies.where("cik % 2 = 0")), sources.filings(bodies.where("cik % 2 = 1"))
    return sources.for_year(sources.all_filings(recent, older), "1996")


def _field(name: str):
    return lambda x: x[name]


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25")
def sql_head(spark, sf_dir):
    """The head of an ordered SQL result: SRC6, SRT1, SRT2."""
    orders(spark, sf_dir).createOrReplaceTempView("orders_of_sql_head")
    return sources.query(spark, "select o_orderkey, o_totalprice from orders_of_sql_head order by o_totalprice desc, o_orderkey", 25)


@query("select p_partkey, case p_partkey % 3 when 0 then ['' || p_brand, p_type] when 1 then [] end as words, case p_partkey % 3 when 0 then '[\"' || p_brand || '\",\"' || p_type || '\"]' when 1 then '[]' end as again from part")
def string_arrays(spark, sf_dir):
    """JSON text to arrays and back, tolerant of what is none: JSN1, SRC13."""
    p = table(spark, sf_dir, "part")
    text = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.array("p_brand", "p_type"))).when(F.col("p_partkey") % 3 == 1, "[]").otherwise("not json")
    return p.withColumn("words", sources.string_array(text)).select("p_partkey", "words", F.to_json("words").alias("again"))


@query(
    """with n as (select distinct trim(p_type || ' ' || p_name || case p_partkey % 3 when 0 then ' of' when 1 then ' and Sons' else '' end) as phrase from part),
    w as (select phrase, string_split_regex(phrase, '\\s+') as ws from n), s as (select array_to_string(ws[1:k], ' ') as p from w, unnest(range(2, len(ws))) t(k))
    select phrase from n where length(phrase) >= 3 union select p from s where not regexp_matches(lower(p), ' (of|and|&|for)$')"""
)
def name_prefixes(spark, sf_dir):
    """Names and their prefixes that end well: SRC2."""
    p = table(spark, sf_dir, "part")
    tail = F.when(F.col("p_partkey") % 3 == 0, " of").when(F.col("p_partkey") % 3 == 1, " and Sons").otherwise("")
    return sources.name_prefixes(p.select(F.concat("p_type", F.lit(" "), "p_name", tail).alias("core_name")))


@query("select o_orderkey, case when url <> '' then 'valid' when accession is null then 'placeholder' else 'open' end as kind from (select o_orderkey, case o_orderkey % 4 when 0 then '' when 1 then null else 'u' end as url, case when o_orderkey % 3 = 0 then null else 'a' end as accession from orders)")
def url_kinds(spark, sf_dir):
    """Addresses that are valid, stand for nothing found, or are open: FLT1."""
    url, number = F.when(key() % 4 == 0, "").when(key() % 4 >= 2, "u"), F.when(key() % 3 != 0, "a")
    return orders(spark, sf_dir).select("o_orderkey", F.when(store.is_valid(url), "valid").when(store.is_placeholder(url, number), "placeholder").otherwise("open").alias("kind"))


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def resume_open_keys(spark, sf_dir):
    """What is left to do after a stop, with rows on both sides: JN5, SET2."""
    o = orders(spark, sf_dir)
    return store.not_done(o.select("o_orderkey", "o_custkey"), o.where("o_orderstatus = 'F'"), ["o_custkey"])


@query(
    """select 'o_totalprice' as column, count(o_totalprice) as n, avg(o_totalprice) as mean, stddev_samp(o_totalprice) as sd, min(o_totalprice) as least, max(o_totalprice) as most from orders
    union all select 'o_custkey', count(o_custkey), avg(o_custkey), stddev_samp(o_custkey), min(o_custkey), max(o_custkey) from orders"""
)
def column_summary(spark, sf_dir):
    """Count, mean, spread and ends of numeric columns, from one scan: AGG13."""
    s = store.summary(orders(spark, sf_dir), "o_totalprice", "o_custkey")
    return s.select("column", "n", "mean", "sd", "least", "most")


# ---------------------------------------------------------------- text


@query(
    """select o_orderkey, case o_orderkey % 4 when 0 then 'Sales, costs; taxes' when 1 then 'Wait. What!' when 2 then 'J. Doe. It''s ' || cast(o_custkey as varchar) else 'a: b,' || case when o_custkey % 2 = 0 then ' c' else '1' end end as tidy,
    case o_orderkey % 6 when 0 then 'Sales rose' when 1 then 'See. More' when 2 then 'Risk factors' when 3 then 'Staff' when 4 then 'paid to the Company in US' else 'Notes ' || cast(o_custkey as varchar) end as clean,
    case o_orderkey % 3 when 0 then chr(10) || 'Sales' when 1 then 'a' || chr(10) || chr(10) || 'b' else 'x  y' end as bare from orders"""
)
def cleaned_texts(spark, sf_dir):
    """Punctuation in order, paragraphs without clutter, markup noise gone: TXT5, TXT6, TXT9."""
    messy = cycle(4, "Sales , costs ;taxes", "Wait ..  What ! !", said("J. Doe.It 's ", customer()), F.concat(F.lit("a :b ,"), F.when(customer() % 2 == 0, "c").otherwise("1")))
    page = cycle(6, "12 <PAGE> 13 Sales rose", "See https://a.example/x?y=1. More", "Risk factors . . . . . . 17", "3) Staff", "paid to Us in US", said("• | Notes ", customer()))
    raw = cycle(3, "<PAGE>\nSales", "a\n- 12 -\n\nb", "x www.acme.com/path y")
    return orders(spark, sf_dir).select("o_orderkey", tx.tidy(messy).alias("tidy"), tx.clean_document_text(page).alias("clean"), tx.without_markup_noise(raw).alias("bare"))


@query(
    """with s as (select o_orderkey, unnest(['No. ' || cast(o_custkey as varchar) || ' was sold to Acme Inc. of the U.S. for $' || cast(o_orderkey as varchar) || '.', 'J. Doe signed it!', 'Why?', 'See p. 4.']) as text, unnest([0, 1, 2, 3]) as n from orders),
    l as (select *, sum(length(text) + 1) over (partition by o_orderkey order by n) - length(text) - 1 as start from s) select o_orderkey, cast(start as integer) as start, text from l"""
)
def sentence_rows(spark, sf_dir):
    """Sentences with their places: TXT14."""
    t = said("No. ", customer(), " was sold to Acme Inc. of the U.S. for $", key(), ". J. Doe signed it! Why? See p. 4.")
    return orders(spark, sf_dir).select("o_orderkey", F.explode(tx.sentences(t)).alias("s")).select("o_orderkey", "s.start", "s.text")


@query(
    """select o_orderkey, case o_orderkey % 3 when 0 then ' costs fell by ' || cast(o_custkey as varchar) || ' dollars' when 1 then ' of ' || cast(o_custkey as varchar) || ', or more ' else 'At 10:30 we paid ' || cast(o_custkey as varchar) || ' dollars' end as clause,
    greatest(0, 20 + o_orderkey % 7 - (10 + o_custkey % 20), 5 - (25 + o_orderkey % 7)) as apart from orders"""
)
def clause_bounds(spark, sf_dir):
    """The clause around a number, and how far two spans are apart: TXT15, TXT16."""
    t = cycle(3, said("Sales rose, while costs fell by ", customer(), " dollars"), said("A sum: of ", customer(), ", or more except in May"), said("At 10:30 we paid ", customer(), " dollars"))
    at = F.length(F.regexp_extract(t, r"^(.*(?:by|of|paid) )\d", 1))
    end = at + F.length(customer().cast("string"))
    bounds = find.let(tx.clause(t, at, end), lambda b: F.substring(t, b["start"] + 1, b["end"] - b["start"]))
    one = F.struct(F.lit(5).alias("start"), (10 + customer() % 20).cast("int").alias("end"))
    two = F.struct((20 + key() % 7).cast("int").alias("start"), (25 + key() % 7).cast("int").alias("end"))
    return orders(spark, sf_dir).select("o_orderkey", bounds.alias("clause"), find.distance(one, two).alias("apart"))


@query(
    """with t as (select o_orderkey, cast(o_orderkey as varchar) as n from orders), b as (select o_orderkey, n, case when length(n) between 4 and 5 then '<' || n || '>' else n end as m from t)
    select o_orderkey, 'in ' || m || ' and <94105-1234> or 120000' as marked, 'in ' || n || ' and 94105-1234 or 120000' as plain, 3 + length(n) as ends from b"""
)
def bracketed_numbers(spark, sf_dir):
    """Numbers of four or five digits in brackets, their text without, and a place's way back: NUM1, TXT11, TXT12."""
    marked = nm.bracketed(said("in ", key(), " and 94105-1234 or 120000"))
    after = F.instr(marked, " and") - 1
    return orders(spark, sf_dir).select("o_orderkey", marked.alias("marked"), tx.unbracketed(marked).alias("plain"), tx.unbracketed_at(marked, after).alias("ends"))


@query("select o_orderkey, replace(replace(o_orderpriority, '-', ' '), 'SPECIFIED', 'given') as out, substr(o_orderpriority, 1, 1) as first from orders")
def rewritten_texts(spark, sf_dir):
    """Rules of patterns and replacements in order, and an alternation of terms: TXT17, TXT19, SRT4."""
    p = F.col("o_orderpriority")
    words = pt.any_of(["1", "2", "3", "4", "5", "1-URGENT and more"])
    return orders(spark, sf_dir).select("o_orderkey", tx.rewritten(p, [(r"(\d)-", "$1 "), (r"\bSPECIFIED\b", "given")]).alias("out"), F.regexp_extract(p, rf"^({words})", 1).alias("first"))


@query("select o_orderkey, list_transform(list_sort(list_transform([3, 9, 9 + o_orderkey % 5, 1], lambda x: -x)), lambda x: -x) as lengths from orders")
def spans_longest_first(spark, sf_dir):
    """Spans by length, longest first: SRT3."""
    spans = F.array(*[F.struct(F.lit(i).alias("start"), (F.lit(i) + n).cast("int").alias("end")) for i, n in enumerate((F.lit(3), F.lit(9), 9 + key() % 5, F.lit(1)))])
    return orders(spark, sf_dir).select("o_orderkey", F.transform(find.longest_first(spans), lambda s: s["end"] - s["start"]).alias("lengths"))


# ---------------------------------------------------------------- numbers


@query(
    """select o_orderkey, case o_orderkey % 3 when 0 then '75% of it' when 1 then '50%' else '66.6667% and 20%' end as fractions, case o_orderkey % 5 when 0 then 'three million' when 1 then '0.5 million' when 2 then 'one million' when 3 then '0.75 billion' else '0.25 thousand' end as loose,
    case when o_orderkey % 2 = 0 then cast(o_custkey as varchar) || ' left' else cast(o_custkey as varchar) || ' (' || cast(o_custkey + 1 as varchar) || ') left' end as once, case o_orderkey % 3 when 0 then '5% to 7%' when 1 then '5%' else '12.5% of' end as percents,
    cast(o_orderkey + 1000 as varchar) || ' units' as plain from orders"""
)
def number_rules(spark, sf_dir):
    """Fractions, loose amounts, numbers said twice, percents and group commas: NUM2, NUM3, NUM5, NUM7, NUM8."""
    return orders(spark, sf_dir).select(
        "o_orderkey",
        nm.fraction_words(cycle(3, "three-fourths of it", "one-half", "two-thirds and one-fifth")).alias("fractions"),
        nm.loose_amounts(cycle(5, "a few million", "half a million", "a million", "three quarters of a billion", "a quarter of a thousand")).alias("loose"),
        nm.said_twice(F.when(key() % 2 == 0, said(customer(), " (", customer(), ".0) left")).otherwise(said(customer(), " (", customer() + 1, ") left"))).alias("once"),
        nm.percents(cycle(3, "5 - 7 %", "5 per cent", "12.5 percent of")).alias("percents"),
        nm.no_group_commas(F.concat(F.format_number(key() + 1000, 0), F.lit(" units"))).alias("plain"),
    )


@query(
    """with n as (select o_orderkey, o_orderkey * 977 + 13 as n, o_custkey * 1.25 as f, cast('0x' || substr(md5(cast(o_orderkey as varchar)), 25, 8) as bigint) as h from orders)
    select o_orderkey, 'n ' || cast(n as varchar) || ' end' as original, 'n ' || format('{:,}', n) || ' end' as commas, h as hash,
    case when f = 0 then 0 else round(f / pow(10, floor(log10(f)) - 1)) * pow(10, floor(log10(f)) - 1) end as rounded from n"""
)
def restyled_numbers(spark, sf_dir):
    """Whole numbers as they are and with commas, stable hashes, significant digits: NUM13, NUM14, NUM15, NUM16."""
    t = said("n ", key() * 977 + 13, " end")
    return orders(spark, sf_dir).select("o_orderkey", nm.restyled(t, "original").alias("original"), nm.restyled(t, "commas").alias("commas"), tx.stable_hash(key().cast("string")).alias("hash"), nm.rounded(customer() * 1.25, 2).alias("rounded"))


@query("select o_orderkey, case o_orderkey % 3 when 0 then cast(m as varchar) || ' thousand' when 1 then cast(m as varchar) || 'M' else cast(m as varchar) || 'MM' end as form from (select o_orderkey, o_custkey % 900 + 1 as m from orders)")
def magnitude_forms(spark, sf_dir):
    """Numbers with their magnitude, long, short and financial: NUM14."""
    m = (customer() % 900 + 1).cast("double")
    return orders(spark, sf_dir).select("o_orderkey", cycle(3, nm.in_magnitude(m * 1000), nm.in_magnitude(m * 1e6, "short"), nm.in_magnitude(m * 1e6, "financial")).alias("form"))


# ---------------------------------------------------------------- filings


@query(
    """with y as (select o_orderkey, year(o_orderdate) as y, o_orderkey % 4 as c from orders)
    select o_orderkey, cast(case when c < 2 then y end as integer) as alone, cast(case when c = 0 then y end as integer) as checked, lpad(cast(o_orderkey as varchar), 18, '0') as padded, case o_orderkey % 5 when 0 then 'INT' when 1 then 'CA' when 2 then 'INT' when 3 then 'CA' else 'US' end as country from y"""
)
def filing_facts(spark, sf_dir):
    """Fiscal years from heads, padded numbers, countries by form: DAT1, DAT3, DAT4."""
    y = F.year("o_orderdate")
    far = F.repeat(F.lit("x "), F.when(key() % 4 == 2, 2600).otherwise(10).cast("int"))
    text = F.when(key() % 4 == 3, said("Report for the year ended March 3, ", y)).otherwise(F.concat(F.lit("ANNUAL REPORT PURSUANT TO SECTION 13 OR 15(d) "), far, said("for the fiscal year ended December 31, ", y)))
    filed = F.when(key() % 4 == 1, y + 5).otherwise(y + 1)
    number = F.concat(F.lit("0000000001"), F.lpad((filed % 100).cast("string"), 2, "0"), F.lit("000001"))
    url, head = cycle(5, "/a/20-F.htm", "/a/form40f.htm", "/a/b.htm", "/a/b.htm", "/a/b.htm"), cycle(5, "", "", "FORM 20-F", "FORM 40-F", "FORM 10-K")
    return orders(spark, sf_dir).select("o_orderkey", fl.report_year(text).alias("alone"), fl.report_year(text, number).alias("checked"), fl.padded(key()).alias("padded"), fl.country_of_type(url, head).alias("country"))


@query(
    """with u as (select o_orderkey, cast(o_custkey as varchar) as c, '0000950123' || lpad(cast(case when o_orderkey % 2 = 0 then 5 else 15 end as varchar), 2, '0') || lpad(cast(o_orderkey % 1000000 as varchar), 6, '0') as a, o_orderkey % 3 as f from orders),
    t as (select *, 'https://host/data/' || c || '/' || a || '/' as folder, a[1:10] || '-' || a[11:12] || '-' || a[13:18] || '.txt' as txt from u)
    select o_orderkey, f = 0 as is_text, case when o_orderkey % 2 = 0 and f = 1 then folder || txt end as retry from t"""
)
def plaintext_retries(spark, sf_dir):
    """Whether an address is a filing's plain text, and which to fetch instead: DAT5, FLT9."""
    number = F.concat(F.lit("0000950123"), F.when(key() % 2 == 0, "05").otherwise("15"), F.lpad((key() % 1000000).cast("string"), 6, "0"))
    folder = F.concat(F.lit("https://host/data/"), customer().cast("string"), F.lit("/"), number, F.lit("/"))
    dashed = F.concat_ws("-", F.substring(number, 1, 10), F.substring(number, 11, 2), F.substring(number, 13, 6))
    url = F.concat(folder, F.when(key() % 3 == 0, F.concat(dashed, F.lit(".txt"))).otherwise("a.htm"))
    texts = F.array(F.when(key() % 3 == 2, F.repeat(F.lit("word "), 300)).otherwise("short"))
    return orders(spark, sf_dir).select("o_orderkey", filing.is_plaintext_url(url).alias("is_text"), filing.retry_url(url, texts).alias("retry"))


@query(
    """select c_custkey, case c_custkey % 5 when 0 then 'US' when 1 then 'FR' when 2 then 'INT' when 3 then 'JP' else 'CA' end as home_country from customer"""
)
def countries_from_names(spark, sf_dir):
    """Open countries taken from the first nation in a firm's name: GEO1, GEO2."""
    k = F.col("c_custkey")
    name = F.when(k % 5 == 1, "Air France of Germany").when(k % 5 == 2, "Bermuda Holdings").when(k % 5 == 3, "Japan Tobacco").otherwise("Spain Telecom")
    open_ = F.when(k % 5 == 0, "US").when(k % 5 == 1, F.lit(None).cast("string")).when(k % 5 == 2, "BM").when(k % 5 == 3, "INT").otherwise("CA")
    return dictionary.country_from_name(table(spark, sf_dir, "customer").select(k.alias("cik"), name.alias("name"), open_.alias("home_country")), "name").select(F.col("cik").alias("c_custkey"), "home_country")


@query("select c_custkey, case c_custkey % 4 when 0 then 'DE' when 1 then 'ES' when 2 then 'CN' else 'FR' end as home_country from customer")
def country_choice(spark, sf_dir):
    """Which of several countries is home: by weight, by distance, Hong Kong with China, a haven with another: AGG4, AGG5, JN9."""
    k = F.col("c_custkey")
    far = " and so on" * 12
    text = (
        F.when(k % 4 == 0, f"The firm is incorporated in Germany.{far * 2} Its registered office is in Spain.")
        .when(k % 4 == 1, f"Incorporated in 1990 {far} Germany. The firm is headquartered in Spain")
        .when(k % 4 == 2, f"It is headquartered in Hong Kong.{far * 3} It is domiciled in China.")
        .otherwise(f"It is incorporated in Bermuda.{far * 3} Its executive offices are in France.")
    )
    return dictionary.home_country(table(spark, sf_dir, "customer").select("c_custkey", text.alias("t")), "c_custkey", "t")


@query("select n_nationkey, case n_nationkey % 4 when 0 then 'EUR' when 1 then 'JPY' when 2 then 'GBP' end as nation from nation")
def text_nations(spark, sf_dir):
    """Which nation or currency most hits of a text speak for; nations count before currencies: EX14, AGG6."""
    k = F.col("n_nationkey")
    text = F.when(k % 4 == 0, "Germany and the yen, the yen").when(k % 4 == 1, "yen, JPY, then the euro").when(k % 4 == 2, "British firms in London and the euro").otherwise("nothing here")
    return table(spark, sf_dir, "nation").select("n_nationkey", fx.nation_of(fx.hits(text)).alias("nation"))


# ---------------------------------------------------------------- documents


_LINES = ("12345", "A-12", "Table of Contents", "***", "Acme Corp", "Sales rose in May", "- 12 -", "ab 1")


@query("select o_orderkey, o_orderkey % 8 in (0, 1, 2, 3, 4) as discardable, o_orderkey % 8 in (1, 3, 6, 7) as structural from orders")
def block_kinds(spark, sf_dir):
    """Blocks that say nothing or only structure a page: FLT5, FLT6."""
    b = cycle(8, *_LINES)
    return orders(spark, sf_dir).select("o_orderkey", documents.is_discardable(b, F.lit("acme corp")).alias("discardable"), documents.is_structural(b).alias("structural"))


@query(
    """select o_orderkey, 0 as part, '10-K' as type, 'plain' as kind from orders where o_orderkey % 3 <> 2 union all select o_orderkey, 1, 'EX-13.1', 'html' from orders where o_orderkey % 3 = 0
    union all select o_orderkey, 0, '', 'html' from orders where o_orderkey % 3 = 2"""
)
def filing_parts(spark, sf_dir):
    """The parts of a landed page by type and kind: DOC1, FLT10."""
    doc = lambda kind, body: F.lit(f"<DOCUMENT>\n<TYPE>{kind}\n<TEXT>{body}</TEXT>\n</DOCUMENT>\n")
    raw = F.when(key() % 3 == 0, F.concat(doc("10-K", "Sales rose"), doc("EX-13.1", "<html><body>x</body></html>"), doc("EX-99", "no"), doc("XML", "<?xml version='1.0'?>")))
    raw = raw.when(key() % 3 == 1, doc("10-K", "Costs fell")).otherwise("<html><p>whole page</p></html>")
    return documents.parts(orders(spark, sf_dir).select("o_orderkey", raw.alias("raw")), "o_orderkey", "raw").select("o_orderkey", "part", "type", "kind")


@query(
    """select o_orderkey, unnest(case o_orderkey % 3 when 0 then ['Sales of ' || cast(o_custkey as varchar) || ' units rose and costs fell.', 'New line'] when 1 then ['It ended.', 'but not here:', 'so it goes'] else ['Head', '<TABLE>' || chr(10) || 'a  1' || chr(10) || chr(10) || 'b  2' || chr(10) || '</TABLE>', 'Tail'] end) as block,
    unnest(case when o_orderkey % 3 = 0 then [0, 1] else [0, 1, 2] end) as pos from orders"""
)
def paragraph_blocks(spark, sf_dir):
    """Paragraphs with wrapped lines joined and continuations merged, tables whole: DOC6, WIN7, TXT10."""
    t = cycle(3, said("Sales of ", customer(), " units\nrose\n\n\nand costs fell.\n\n12345\n\nNew line"), "It ended.\n\nbut not here:\n\nso it goes", "Head\n<TABLE>\na  1\n\nb  2\n</TABLE>\nTail")
    d = orders(spark, sf_dir).select("o_orderkey", documents.blocks_of(t).alias("b"))
    return documents.numbered(d, "o_orderkey", "b").select("o_orderkey", "pos", "block")


@query(
    """select o_orderkey, cast(case o_orderkey % 4 when 0 then 4 when 3 then 2 end as integer) as boundary, case o_orderkey % 4 when 0 then 2 when 1 then 5 when 2 then 3 else 3 end as n_left from orders"""
)
def contents_and_boundary(spark, sf_dir):
    """Where statements about the future begin, and what is left behind a table of contents: DOC7, DOC9."""
    a = lambda *x: F.array(*[F.lit(y) for y in x])
    blocks = (
        F.when(key() % 4 == 0, a("Table of Contents", "Item 2. Properties", "Part II", "Executive compensation . . . . 12", "Forward-looking statements", "We were founded in 1990."))
        .when(key() % 4 == 1, a("The firm was founded in 1990.", "It sells goods.", "It is big.", "They are here.", "The second item was sold."))
        .when(key() % 4 == 2, a("Index", "Item 5. Market for Registrant's Common Equity", "Item 8. Financial Statements", "Item 1. Business", "We sell goods.", "They are good."))
        .otherwise(a("Part I . . . . . 3", "Risk factors", "Cautionary statement", "We sell goods."))
    )
    spread = orders(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism, "o_orderkey")
    d = spread.select("o_orderkey", blocks.alias("b"))
    rows = documents.numbered(d, "o_orderkey", "b")
    edges = documents.forward_boundary(rows, "o_orderkey")
    return d.join(edges, "o_orderkey", "left").select("o_orderkey", "boundary", F.size(filing.without_contents(F.col("b"), F.col("boundary"))).alias("n_left"))


# ---------------------------------------------------------------- variations

#: In SQL: a number below 1 that the parts (joined by bars) decide, what varies a number, and a number made fit again.
def _u(parts: str) -> str:
    return f"(cast('0x' || substr(md5({parts}), 25, 8) as bigint) / 4294967296.0::double)"


def _scale_sql(m: str, parts: str) -> str:
    u = _u(parts)
    return f"case when {m} = 0 then 1.2 + 2.8 * {u} when {m} < 10 then 1.5 + 4.5 * {u} when {m} < 100 then 1.2 + 2.8 * {u} when {m} < 1000 then 0.75 + 2.25 * {u} when {m} < 100000 then 0.25 + 2.75 * {u} else 0.05 + 1.95 * {u} end"


def _fit_sql(n: str, out: str) -> str:
    return f"(select case when a = 0 then greatest(1.0, abs({n})) else a end from (select abs(case when {n} = floor({n}) then round({out}) else round({out}, 2) end) as a))"


_SEED = "cast(o_orderkey as varchar)"


@query(
    f"""with n as (select o_orderkey, (o_orderkey % 9000 + 1)::double as x, (o_custkey % 700) / 8.0::double + 0.125 as y from orders), m as (select *, greatest(x, y) as m from n)
    select o_orderkey, x as kept, {_fit_sql('x', 'x * ' + _scale_sql('m', _SEED + " || '|s'"))} as scaled_x, {_fit_sql('y', 'y * ' + _scale_sql('m', _SEED + " || '|s'"))} as scaled_y,
      {_fit_sql('x', f"(x + (-0.75 + 1.5 * {_u(_SEED + " || '|o'")}) * greatest(m, 10.0))")} as moved_x, {_fit_sql('y', 'y * ' + _scale_sql('y', _SEED + " || '|1|n'"))} as lone_y from m"""
)
def varied_numbers(spark, sf_dir):
    """Numbers scaled and moved together or alone, by draws that the seed decides: MUT1, SMP4."""
    n = F.array((key() % 9000 + 1).cast("double"), (customer() % 700) / F.lit(8.0) + 0.125)
    made = {s: mutate.numbers(n, key(), s) for s in ("preserve", "shared_scale", "shared_offset", "independent_scale")}
    return orders(spark, sf_dir).select("o_orderkey", made["preserve"][0].alias("kept"), made["shared_scale"][0].alias("scaled_x"), made["shared_scale"][1].alias("scaled_y"), made["shared_offset"][0].alias("moved_x"), made["independent_scale"][1].alias("lone_y"))


def _value(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(text, r"([\d,]+(?:\.\d+)?)", 1), ",", "").cast("double")


@query(
    f"""with n as (select *, (o_custkey % 80 + 1)::double as x, 12.5::double as p, (o_orderkey % 5000 + 100)::double as s from orders)
    select o_orderkey, {_fit_sql('x', 'x * ' + _scale_sql('x', _SEED + " || '|s'"))} as money, least({_fit_sql('p', 'p * ' + _scale_sql('p', _SEED + " || '|s'"))}, 999) as percent, {_fit_sql('s', 's * ' + _scale_sql('s', _SEED + " || '|s'"))} as shares,
      'Note ' || lpad(cast((o_custkey % 90 + 10 + 1 + cast('0x' || substr(md5({_SEED} || '|' || cast(o_custkey % 90 + 10 as varchar)), 25, 8) as bigint) % 99) % 100 as varchar), 2, '0') as reference,
      strftime(cast(o_orderdate as date) + cast(round(-3650 + 7300 * {_u(_SEED + " || '|d'")}) as integer), '%B %-d, %Y') as date, 'in ' || cast(greatest(1900, least(2100, year(o_orderdate) + cast(round(-25 + 50 * {_u(_SEED + " || '|y'")}) as integer))) as varchar) as year from n"""
)
def varied_spans(spark, sf_dir):
    """Amounts, percents, shares, references and dates varied as their labels ask: MUT2, MUT3, MUT5, MUT6, MUT7."""
    seed = key()
    out = {
        "money": _value(mutate.money(said("$", customer() % 80 + 1), seed)), "percent": _value(mutate.percent(F.lit("12.5%"), seed)), "shares": _value(mutate.shares(said(key() % 5000 + 100, " shares"), seed)),
        "reference": mutate.reference(said("Note ", customer() % 90 + 10), seed), "date": mutate.span_text(F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("TIME"), seed), "year": mutate.time(said("in ", F.year("o_orderdate")), seed),
    }
    return orders(spark, sf_dir).select("o_orderkey", *[c.alias(n) for n, c in out.items()])


_MASSES = [u for u in v.UNITS if u[1] == "mass" and not u[3]]
_UNIT_SQL = "[" + ", ".join(f"'{u[0]}'" for u in _MASSES) + "]"
_FACTOR_SQL = "[" + ", ".join(f"{u[2]!r}::double" for u in _MASSES) + "]"


@query(
    f"""with n as (select o_orderkey, cast('0x' || substr(md5({_SEED} || '|unit'), 25, 8) as bigint) % {len(_MASSES)} + 1 as i, (o_custkey % 90 + 10)::double as q from orders), x as (select *, q * 1000.0::double / {_FACTOR_SQL}[i] as x from n)
    select o_orderkey, {_UNIT_SQL}[i] || 's' as unit, round({_fit_sql('x', 'x * ' + _scale_sql('x', _SEED + " || '|s'"))}, 3) as amount from x"""
)
def varied_quantities(spark, sf_dir):
    """Quantities in another unit of their dimension, converted and varied: MUT4."""
    q = mutate.quantity(said(customer() % 90 + 10, " kilograms"), key())
    return orders(spark, sf_dir).select("o_orderkey", F.regexp_extract(q, r"([a-z ]+)$", 1).alias("u"), _value(q).alias("amount")).select("o_orderkey", F.trim("u").alias("unit"), "amount")


_CODES = [c[0] for c in fx._TABLE]
_NATIONS = [fx._NATION[c[4][0]][0] for c in fx._TABLE]
_SHIFT = f"(1 + cast('0x' || substr(md5(cast(o_custkey as varchar) || '|fx'), 25, 8) as bigint) % {len(_CODES) - 1})"


def _shifted(names: list[str], of: str) -> str:
    return f"[{', '.join(repr(n) for n in names)}][({names.index(of)} + {_SHIFT}) % {len(names)} + 1]"


@query(f"select o_orderkey, 'Paid in ' || {_shifted(_CODES, 'EUR')} || ' from ' || {_shifted(_NATIONS, 'Japan')} || ' at ' || {_shifted(_CODES, 'CHF')} || '/' || {_shifted(_CODES, 'USD')} as moved from orders")
def currency_shift(spark, sf_dir):
    """Currencies and nations of a text moved by one shift, pairs turned round: MUT8, MUT9."""
    return orders(spark, sf_dir).select("o_orderkey", fx.moved(F.lit("Paid in EUR from Japan at USD/CHF"), customer())["text"].alias("moved"))


@query(
    """select o_orderkey, 4 as n_groups, 4 as n_targets, 0 as own_targets, 1 as step, 'EUR|JPY|GBP|PLN' as codes, 8 as n_hits, 'JPY' as source, true as kept from orders"""
)
def currency_rewrites(spark, sf_dir):
    """Texts of several nations in other currencies, a target for each, with what moved where: MUT9."""
    text = said("Of EUR ", key(), " and 5 euros, Tokyo in Japan paid ", customer(), " Japanese yen, London got GBP 7 and a Polish zloty")
    spread = orders(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism)
    rows = spread.select("o_orderkey", "o_custkey", fx.rewritten(text, key()).alias("r"))
    moves, new = F.col("r.moves"), F.col("r.text")
    targets = F.transform(moves, lambda m: m["target"])
    kept = F.contains(new, key().cast("string")) & F.contains(new, customer().cast("string")) & ~F.contains(new, F.lit("Tokyo"))
    o = rows.select("o_orderkey", F.size(moves).alias("n_groups"), F.size(F.array_distinct(targets)).alias("n_targets"), F.size(F.filter(moves, lambda m: m["target"] == m["code"])).alias("own_targets"),
        F.array_max(F.transform(moves, lambda m: m["step"])).alias("step"), F.array_join(F.transform(moves, lambda m: m["code"]), "|").alias("codes"),
        F.aggregate(moves, F.lit(0), lambda n, m: n + m["n"]).alias("n_hits"), F.col("r.source").alias("source"), kept.alias("kept"))
    return o


@query("select o_orderkey, case when o_orderkey % 3 = 0 then '5 ' || ['employees', 'workers', 'staff', 'personnel', 'associates'][((o_orderkey % 5) + 1) % 5 + 1] when o_orderkey % 3 = 1 then '5 miners' else '5 shares' end as swapped from orders where o_orderkey % 3 <> 1")
def worker_terms(spark, sf_dir):
    """Words for workers replaced by another of their pool: MUT10."""
    pool = F.array(*[F.lit(w) for w in v.WORKER_POOLS["general"]])
    o = orders(spark, sf_dir).where("o_orderkey % 3 <> 1")
    return o.select("o_orderkey", mutate.worker_terms(F.when(key() % 3 == 0, F.concat(F.lit("5 "), pool[(key() % 5).cast("int")])).otherwise("5 shares"), F.lit(1)).alias("swapped"))


# ---------------------------------------------------------------- training data


@query("select o_orderkey, [o_orderkey % 5, -100, 7, -100, -100]::bigint[] as labels from orders")
def subword_labels(spark, sf_dir):
    """Labels for the first sub-word of each word: TRN3."""
    labels = F.array(key() % 5, F.lit(7).cast("bigint"))
    word = F.array(F.lit(0), F.lit(0), F.lit(1), F.lit(1), F.lit(None).cast("int"))
    return orders(spark, sf_dir).select("o_orderkey", F.transform(training.subword_labels(labels, word), lambda x: x.cast("bigint")).alias("labels"))


@query(
    """with g as (select event_id, event_type as label from events where event_id % 3 <> 0), p as (select event_id, case when event_id % 5 = 0 then 'view' else event_type end as label from events where event_id % 4 <> 0),
    l as (select label from g union select label from p), n as (select label, (select count(*) from g where g.label = l.label) as g, (select count(*) from p where p.label = l.label) as p, (select count(*) from g join p using (event_id, label) where g.label = l.label) as h from l)
    select label, h / greatest(p, 1) as "precision", h / greatest(g, 1) as recall, 2 * h / greatest(p + g, 1) as f1 from n"""
)
def entity_scores_missed(spark, sf_dir):
    """Scores of predictions that miss some and mistake some: AGG15."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))
    predicted = e.where("event_id % 4 <> 0").withColumn("label", F.when(F.col("event_id") % 5 == 0, "view").otherwise(F.col("label")))
    return training.entity_scores(e.where("event_id % 3 <> 0"), predicted, ["event_id"])
