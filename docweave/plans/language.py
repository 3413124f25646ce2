"""Queries of the span, number, dictionary, training and document operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import numbers as nm
from docweave.functions import text as tx
from docweave.operators import dictionary, documents, fx, mutate, ner, spans, tables, training
from docweave.plans import rendered
from docweave.plans.corpus import table
from docweave.plans.sql import RENDERED

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


#: The spans that each rendered sentence holds, by construction.
MADE = """made as (
  select o_orderkey, unnest([
    {'label': 'TIME', 'text': strftime(o_orderdate, '%B %-d, %Y')},
    {'label': 'MONEY', 'text': '$' || cast(cast(o_totalprice as decimal(14,2)) as varchar)},
    {'label': 'REFERENCE', 'text': 'Note ' || cast(o_custkey % 40 + 1 as varchar)},
    {'label': 'PCT_CHANGE', 'text': 'rose by ' || cast(o_custkey % 30 + 1 as varchar) || '%'},
    {'label': 'QUANTITY', 'text': cast(o_orderkey % 900 + 10 as varchar) || ' kilograms'},
    {'label': 'LABOR', 'text': cast(o_custkey % 5000 + 20 as varchar) || ' employees'},
    {'label': 'SHARE', 'text': cast(o_orderkey % 7000 + 100 as varchar) || ' shares of common stock'}]) as s
  from orders)"""


def _sentences(spark, sf_dir):
    """The sentences in as many parts as there are cores: one small file would be one task of long grammar."""
    return rendered.sentences(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism)


def _spans(spark, sf_dir):
    return spans.exploded(spans.extract(_sentences(spark, sf_dir), "sentence"), ["o_orderkey"])


@query(f'with {RENDERED}, {MADE} select o_orderkey, instr(sentence, s.text) - 1 as start, instr(sentence, s.text) - 1 + length(s.text) as "end", s.label as label, s.text as text from made join rendered using (o_orderkey)')
def span_extraction(spark, sf_dir):
    return _spans(spark, sf_dir)


@query("select label, count(*) as n from (values ('TIME'), ('MONEY'), ('REFERENCE'), ('PCT_CHANGE'), ('QUANTITY'), ('LABOR'), ('SHARE')) v(label), orders group by label")
def span_label_counts(spark, sf_dir):
    return _spans(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))


@query(
    """select o_orderkey, 'Order __ID' as head, 7 as slot_count, 7 as label_count,
    length(regexp_replace(strftime(o_orderdate, '%B %-d, %Y'), '[^ ,]', '', 'g')) as date_marks from orders"""
)
def ner_rows(spark, sf_dir):
    s = _sentences(spark, sf_dir).join(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MMMM d, yyyy").alias("d")), "o_orderkey")
    made = ner.token_rows(spans.extract(s, "sentence"), "sentence")
    times = F.size(F.filter("ner_tags", lambda t: t.isin("B-TIME", "I-TIME")))
    head = F.concat(F.substring("template_text", 1, 6), F.regexp_extract("template_text", "(__ID)1__", 1))
    return made.select("o_orderkey", head.alias("head"), "slot_count", "label_count", (times - 1).cast("long").alias("date_marks"))


@query()
def ner_process(spark, sf_dir):
    return ner.process(_sentences(spark, sf_dir), "sentence", "o_orderkey", augment=True).select("o_orderkey", "sentence", "words", "ner_tags", "slot_count", "label_count")


@query("select o_orderkey, format('{:,}', o_orderkey * 977 + 1000) as commas, '{' || cast(o_orderkey * 977 + 1000 as varchar) || '}' as plain from orders")
def number_commas(spark, sf_dir):
    n = (F.col("o_orderkey") * 977 + 1000).cast("double")
    return table(spark, sf_dir, "orders").select("o_orderkey", nm.with_commas(n).alias("commas"), F.concat(F.lit("{"), nm.plain(n), F.lit("}")).alias("plain"))


@query("select o_orderkey, o_orderkey * 977 + 13 as n, true as back from orders")
def number_words_round_trip(spark, sf_dir):
    n = F.col("o_orderkey") * 977 + 13
    return table(spark, sf_dir, "orders").select("o_orderkey", n.alias("n"), (nm.word_value(nm.in_words(n)) == n).alias("back"))


@query("select o_orderkey, 'paid ' || cast(o_orderkey % 90 + 1 as varchar) || '000000 for ' || cast(o_orderkey % 50 + 2 as varchar) || '%' as out from orders")
def number_normalisation(spark, sf_dir):
    t = F.concat(F.lit("paid "), (F.col("o_orderkey") % 90 + 1).cast("string"), F.lit(" million for "), nm.in_words(F.col("o_orderkey") % 50 + 2), F.lit(" percent"))
    return table(spark, sf_dir, "orders").select("o_orderkey", nm.normalized(t).alias("out"))


@query()
def number_mutation(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    price, seed = F.concat(F.lit("$"), F.col("o_totalprice").cast("decimal(14,2)").cast("string")), F.xxhash64("o_orderkey")
    return o.select("o_orderkey", mutate.money(price, seed).alias("money"), mutate.percent(F.lit("12.5%"), seed).alias("percent"), mutate.quantity(F.lit("10 kilograms"), seed).alias("quantity"))


@query("select n_nationkey, true as moved, true as alike from nation")
def currency_move(spark, sf_dir):
    t = F.concat(F.lit("The euro and the EUR fell in Germany, "), F.col("n_name"))
    m = fx.moved(t, F.col("n_nationkey"))
    return table(spark, sf_dir, "nation").select("n_nationkey", (m["text"] != t).alias("moved"), (m == fx.moved(t, F.col("n_nationkey"))).alias("alike"))


NATIONS = """select c_custkey, code from (select c_custkey, case c_nationkey % 3 when 0 then 'DE' when 1 then 'FR' else null end as code from customer) where code is not null"""


@query(NATIONS)
def dictionary_join(spark, sf_dir):
    place = F.when(F.col("c_nationkey") % 3 == 0, "Germany").when(F.col("c_nationkey") % 3 == 1, "France").otherwise("Atlantis")
    c = table(spark, sf_dir, "customer").withColumn("t", F.concat(F.lit("Sold in "), place, F.lit(" last year")))
    return dictionary.hits(c, "c_custkey", "t", dictionary.nations(spark)).select("c_custkey", "code")


@query("select c_custkey, case c_nationkey % 3 when 0 then 'DE' when 1 then 'FR' else 'INT' end as home_country from customer")
def home_country(spark, sf_dir):
    place = F.when(F.col("c_nationkey") % 3 == 0, "Germany").when(F.col("c_nationkey") % 3 == 1, "France").otherwise("Atlantis")
    spread = table(spark, sf_dir, "customer").repartition(4 * spark.sparkContext.defaultParallelism, "c_custkey")
    c = spread.withColumn("t", F.concat(F.lit("The firm is incorporated in "), place, F.lit(" and sells in Spain, "), F.repeat(F.lit("far "), F.lit(120)), F.lit("away.")))
    return dictionary.home_country(c.withColumn("t", F.regexp_replace("t", " and sells in Spain", "")), "c_custkey", "t")


@query(
    """with t as (select user_id, event_id, (event_id % 5 + 1)::int as n from events),
    a as (select user_id, sum(n) as total from t group by user_id) select user_id as batch, unnest(range(0, (total // 16)::bigint)) as block, 16 as size from a"""
)
def token_blocks(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ids", F.sequence(F.lit(0), (F.col("event_id") % 5).cast("int")))
    return training.packed_blocks(e, "ids", F.col("user_id"), ["event_id"], 16).select("batch", "block", F.size("ids").alias("size"))


@query(
    """with t as (select event_id, unnest(range(0, event_id % 5 + 1))::int as id from events), p as (select id, event_id, row_number() over (order by event_id, id) - 1 as pos from t)
    select pos // 16 as block, list(id order by pos) as ids from p group by block having count(*) = 16"""
)
def corpus_blocks(spark, sf_dir):
    """The whole table's token ids as one sequence of blocks, with their contents: TRN1, TRN2."""
    e = table(spark, sf_dir, "events").withColumn("ids", F.sequence(F.lit(0), (F.col("event_id") % 5).cast("int")))
    return training.stream_blocks(e, "ids", ["event_id"], 16, bucket_rows=500)


@query(
    """select event_type as label, count(*) filter (event_id % 2 = 0) / count(*) as "precision", 1.0::double as recall, 2 * count(*) filter (event_id % 2 = 0) / (count(*) + count(*) filter (event_id % 2 = 0)) as f1
    from events group by event_type"""
)
def entity_scores(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("label"))
    return training.entity_scores(e.where("event_id % 2 = 0"), e, ["event_id"])


# ---------------------------------------------------------------- documents


@query("""select doc_id, len(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(regexp_replace(x, '[^A-Za-z0-9]', '', 'g')) < 4 or regexp_matches(x, '^[A-Za-z]-\\d+$')
  or regexp_matches(lower(x), '^(?:-\\s*\\d{1,3}\\s*-|pp?\\s*\\.?\\s*\\d{1,3}|page\\s+\\d{1,3})$'))) as n_structural from documents""")
def structural_blocks(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(F.filter(F.split("text", "\n"), documents.is_structural)).cast("long").alias("n_structural"))


REPEATING = """with b as (select doc_id, unnest(x) as block, generate_subscripts(x, 1) - 1 as pos, len(x) as total from (select doc_id, string_split(text, chr(10)) as x from documents)),
k as (select *, trim(regexp_replace(lower(block), '[^a-z0-9]+', ' ', 'g')) as m from b),
marks as (select doc_id, m from k where length(m) between 4 and 80 group by doc_id, m having count(*) >= 3 and (min(pos) < 12 or max(pos) >= max(total) - 12))
select doc_id, count(*) as n from k where (doc_id, m) not in (select doc_id, m from marks) group by doc_id"""


@query(REPEATING)
def repeating_markers(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text is not null").withColumn("b", F.split("text", "\n"))
    return documents.without_repeating(documents.numbered(d, "doc_id", "b"), "doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))


@query()
def page_parts(spark, sf_dir):
    return documents.parts(table(spark, sf_dir, "pages"), "page_id", "html").select("page_id", "part", "kind", F.length("content").alias("n"))


@query()
def document_blocks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", documents.blocks_of(F.col("text")).alias("b"))
    return documents.numbered(d, "doc_id", "b")


@query("select o_orderkey, o_orderkey % 2 = 0 as is_table from orders")
def table_detection(spark, sf_dir):
    rows = F.concat(F.lit("Sales       1,200     3,400\nCosts       900     1,100\nTaxes       "), F.col("o_orderkey").cast("string"), F.lit("     77"))
    block = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Item\n------\n"), rows)).otherwise(rows)
    return table(spark, sf_dir, "orders").select("o_orderkey", documents.is_table(block).alias("is_table"))


@query("select doc_id, text as ascii from documents where not regexp_matches(text, '[^\\x00-\\x7F]')")
def ascii_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.where(~F.col("text").rlike(r"[^\x00-\x7F]")).select("doc_id", tx.ascii_text(F.col("text")).alias("ascii"))


@query()
def document_ascii(spark, sf_dir):
    """Every document in ASCII; SQL has no compatibility decomposition, so ``ascii_texts`` compares those it leaves alone."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.ascii_text(F.col("text")).alias("ascii"))


# ---------------------------------------------------------------- tables and covers


@query(
    """select o_orderkey, 'Key' as label, '$' || cast(o_orderkey as varchar) as first, cast(o_custkey as varchar) as second, '2001' as first_year, '2000' as second_year, 1000.0::double as multiplier, 'EUR' as currency from orders
    union all select o_orderkey, 'Rate', cast(o_orderkey % 9 as varchar) || '%', cast(o_custkey % 7 as varchar), '2001', '2000', 1000.0::double, 'EUR' from orders"""
)
def table_parse(spark, sf_dir):
    wide = lambda x, n: F.rpad(x, n, " ")
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    lines = [
        F.lit("<TABLE>\n<CAPTION>\nOrders (in thousands of euro)\n"),
        F.lit(" " * 20 + "2001" + " " * 16 + "2000\n" + "-" * 44),
        F.lit("<S>" + " " * 17 + "<C>  <C>" + " " * 12 + "<C>"),
        F.concat(wide(F.lit("Key"), 20), wide(F.concat(F.lit("$"), key), 20), customer),
        F.concat(wide(F.lit("Rate"), 20), wide(F.concat((F.col("o_orderkey") % 9).cast("string"), F.lit("%")), 20), (F.col("o_custkey") % 7).cast("string")),
        F.lit("</TABLE>"),
    ]
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("\n", *lines).alias("t")).withColumn("p", tables.parse(F.col("t")))
    o = o.select("o_orderkey", tables.caption(F.col("t")).alias("c"), tables.column_years(F.col("p.headers")).alias("y"), F.explode("p.rows").alias("r"))
    cells = [F.col("r")[i].alias(n) for i, n in enumerate(("label", "first", "second"))]
    return o.select("o_orderkey", *cells, F.col("y")[1].alias("first_year"), F.col("y")[2].alias("second_year"), tables.multiplier(F.col("c")).alias("multiplier"), tables.currency(F.col("c")).alias("currency"))


@query(
    """select c_custkey, chr(10) || chr(10) || '<TABLE>' || chr(10) || chr(10) || rpad('Name', 20, ' ') || '  ' || lpad('Key', 8, ' ') || chr(10) || repeat('-', 20) || '  ' || repeat('-', 8) || chr(10)
    || rpad('<S>', 22, ' ') || '<C>' || chr(10) || rpad(c_name, 20, ' ') || '  ' || lpad(cast(c_custkey as varchar), 8, ' ') || chr(10) || '</TABLE>' || chr(10) || chr(10) as rendered from customer"""
)
def table_render(spark, sf_dir):
    cells = F.array(F.array("c_name", F.col("c_custkey").cast("string")))
    text = tables.render(F.lit(""), F.array(F.lit("Name"), F.lit("Key")), cells, F.array(F.lit(20), F.lit(8)), F.array(F.lit("l"), F.lit("r")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("rendered"))


@query("select c_custkey, case c_custkey % 3 when 0 then 2 when 1 then 3 else 5 end as n_blocks from customer")
def cover_page(spark, sf_dir):
    body = F.array(F.lit("Item 1. Business"), F.concat(F.lit("The firm of this report sells many things to "), F.col("c_name")))
    cover = F.array(F.lit("Annual Report"), F.lit("Indicate by check mark"), F.lit("Contents"))
    plain = F.array(F.lit("One"), F.lit("Two"), F.lit("Three"))
    blocks = F.when(F.col("c_custkey") % 3 == 0, F.concat(cover, body)).when(F.col("c_custkey") % 3 == 1, F.concat(cover, F.array(F.lit("a"), F.lit("b")))).otherwise(F.concat(plain, body))
    return table(spark, sf_dir, "customer").select("c_custkey", F.size(documents.without_cover(blocks)).alias("n_blocks"))
