"""Registered queries of the core, each over its whole tables, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheafline import schema
from sheafline.functions import geometry, html, repeat, text as tx
from sheafline.operators import aggregates as ag
from sheafline.operators import joins, merge, ordered, parse, rasters, rules, sets
from sheafline.operators.packed import unpack
from sheafline.session import spread, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if SQL can say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p4_found(spark, d):
    """Every value of every packed form field, with its position."""
    return unpack(table(spark, d, "raw_items"))


# -- aggregates --------------------------------------------------------------------------------


@query(
    """
    WITH open AS (SELECT year, region, count(*) AS n FROM (SELECT DISTINCT * FROM ledger) WHERE status <> '已解决' GROUP BY ALL),
    done AS (SELECT DISTINCT year, region FROM progress WHERE status = '已完成'),
    p AS (SELECT f.year, f.questions, f.figs, f.placeholder, f.student, d.year IS NOT NULL AS done, coalesce(o.n, 0) AS open
          FROM paper_facts f LEFT JOIN done d USING (year, region) LEFT JOIN open o USING (year, region))
    SELECT CASE WHEN grouping(year) = 1 THEN '合计' ELSE year END AS year, count(*) AS papers, CAST(sum(questions) AS BIGINT) AS items, CAST(sum(figs) AS BIGINT) AS figs,
           CAST(sum(placeholder) AS BIGINT) AS placeholders, count_if(student) AS student, count_if(done) AS done, CAST(sum(open) AS BIGINT) AS open
    FROM p GROUP BY ROLLUP (year)
    """
)
def index_rollup(spark, d):
    """Papers, items, finished papers and open ledger rows per year, and in all."""
    facts, progress, ledger = (table(spark, d, t) for t in ("paper_facts", "progress", "ledger"))
    open_ = ledger.distinct().where("status <> '已解决'").groupBy("year", "region").agg(F.count(F.lit(1)).alias("open"))
    done = progress.where("status = '已完成'").select("year", "region").distinct().withColumn("done", F.lit(True))
    p = facts.join(done, ["year", "region"], "left").join(open_, ["year", "region"], "left")
    count = {"papers": F.count(F.lit(1)), "items": F.sum("questions"), "figs": F.sum("figs"), "placeholders": F.sum("placeholder"), "student": F.count_if("student"), "done": F.count_if(F.coalesce("done", F.lit(False))), "open": F.sum(F.coalesce("open", F.lit(0).cast("long")))}
    return ag.rolled_up(p.select("year", "questions", "figs", "placeholder", "student", "done", "open"), "year", count)


_STATUSES = {"待补充": "added", "待人工核验": "to_verify", "制作说明": "notes", "已解决": "solved"}


@query(
    """
    SELECT year, count_if(status = '待补充') AS added, count_if(status = '待人工核验') AS to_verify, count_if(status = '制作说明') AS notes, count_if(status = '已解决') AS solved,
           count(*) AS total, coalesce(string_agg(CASE WHEN status <> '已解决' THEN CAST(entry_id AS VARCHAR) END, ',' ORDER BY entry_id), '') AS open
    FROM (SELECT DISTINCT year, entry_id, status FROM ledger) GROUP BY year
    """
)
def ledger_tally(spark, d):
    """Ledger rows per status and the open ones, by year."""
    rows = table(spark, d, "ledger").select("year", "entry_id", "status").distinct()
    out = ag.tally(rows, ["year"], "status", list(_STATUSES), "entry_id", ["已解决"])
    return out.select("year", *(F.col(s).alias(n) for s, n in _STATUSES.items()), "total", F.array_join(F.col("open").cast("array<string>"), ",").alias("open"))


@query(
    """
    SELECT year, count(*) AS papers, count_if(questions > 0) AS parsed, count_if(figs > 0) AS figured, count_if(student) AS student, count_if(teacher) AS teacher, count_if(placeholder = 0) AS explained,
           count_if(questions > 0 AND figs > 0 AND student AND teacher AND placeholder = 0) AS all_done
    FROM paper_facts GROUP BY year
    """
)
def stage_status(spark, d):
    """How many papers passed each stage."""
    done = {"parsed": F.col("questions") > 0, "figured": F.col("figs") > 0, "student": F.col("student"), "teacher": F.col("teacher"), "explained": F.col("placeholder") == 0}
    return ag.stages(table(spark, d, "paper_facts"), ["year"], done)


@query(
    """
    SELECT year, region, number, max_by(item_id, (loaded_at, item_id)) AS item_id, max_by(paperName, (loaded_at, item_id)) AS "paperName", count(*) AS n
    FROM items GROUP BY year, region, number
    """
)
def last_wins(spark, d):
    """The last delivery of each item, and how many there were."""
    return ag.last_wins(table(spark, d, "items").select("year", "region", "number", "loaded_at", "item_id", "paperName"), schema.KEY, ["loaded_at", "item_id"], ["item_id", "paperName"])


_LETTERS = """regexp_replace(regexp_replace(coalesce(answer, ''), '<[^>]+>', '', 'g'), '[^A-I]', '', 'g')"""


@query(f"""SELECT year, region, number, string_agg(DISTINCT letters, '|' ORDER BY letters) AS answers FROM (SELECT year, region, number, {_LETTERS} AS letters FROM items WHERE "typeId" IN (1, 2)) GROUP BY ALL""")
def answer_sets(spark, d):
    """The set of answers of each choice item, all deliveries together."""
    rows = table(spark, d, "items").where(F.col("typeId").isin(*schema.CHOICE_IDS))
    return ag.value_sets(rows, schema.KEY, tx.option_letters("answer"), "answers").withColumn("answers", F.array_join("answers", "|"))


@query('SELECT bank_id, year, region, number, count(*) OVER (PARTITION BY year, region, number) AS n FROM bank_items')
def name_collisions(spark, d):
    """Records with the number of records of the same paper and number."""
    return ag.multiplicity(table(spark, d, "bank_items").select("bank_id", "year", "region", "number"), schema.KEY)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark, d):
    """Keys of more than one row."""
    return ag.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT text_hash, count(*) AS n FROM (SELECT sha256(text) AS text_hash FROM documents WHERE text IS NOT NULL) GROUP BY ALL HAVING count(*) > 1")
def equal_texts(spark, d):
    """Texts that repeat, by hash."""
    return ag.duplicates(table(spark, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("text_hash")), ["text_hash"])


@query("SELECT year, count(*) AS papers, CAST(sum(questions) AS BIGINT) AS items, string_agg(region || ':' || questions, ',' ORDER BY questions DESC, region) AS regions FROM paper_facts GROUP BY year")
def year_totals(spark, d):
    """Papers and items per year and its papers in order of size."""
    rows = table(spark, d, "paper_facts")
    each = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("questions")).alias("q"), "region"))), lambda x: F.concat(x["region"], F.lit(":"), (-x["q"]).cast("string")))
    return rows.groupBy("year").agg(F.count(F.lit(1)).alias("papers"), F.sum("questions").alias("items"), F.array_join(each, ",").alias("regions"))


@query(
    r"""
    SELECT item_id, CASE WHEN coalesce(number, 0) % 4 > 0 THEN number % 4 ELSE CAST(length(coalesce(answer, '')) - length(replace(coalesce(answer, ''), '\item', '')) AS BIGINT) // 5 END AS items,
           CAST(length(coalesce(memo, '')) - length(replace(coalesce(memo, ''), '\item', '')) AS BIGINT) // 5 AS memo_items FROM items
    """
)
def depth_count(spark, d):
    r"""List items at the least depth: answers inside a list of none to three items of its own, and memos as they are.

    Items of a list inside ``steps`` never count.
    """
    rows = table(spark, d, "items").select("item_id", F.coalesce(F.col("number") % 4, F.lit(0)).cast("int").alias("own"), F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("memo", F.lit("")).alias("memo"))
    hidden = F.lit(r"\begin{steps}\item a\begin{enumerate}\item b\end{enumerate}\end{steps}")
    nested = F.concat(F.lit(r"\begin{enumerate}"), F.repeat(F.lit(r"\item x "), F.col("own")), "answer", hidden, F.lit(r"\end{enumerate}"))
    return rows.select("item_id", ag.outer_items(nested).cast("long").alias("items"), ag.outer_items(F.concat(hidden, "memo")).cast("long").alias("memo_items"))


# -- ordered -----------------------------------------------------------------------------------


@query("SELECT year, region, unnest(list_filter(range(1, most + 1), lambda x: NOT list_contains(have, x))) AS missing FROM (SELECT year, region, list(DISTINCT number) AS have, max(number) AS most FROM items WHERE number >= 1 GROUP BY ALL)")
def number_gaps(spark, d):
    """Numbers missing below the largest of a paper."""
    return ordered.gaps(table(spark, d, "items"), ["year", "region"], "number")


@query(
    r"""
    WITH l AS (SELECT doc_id, line, value FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS value, generate_subscripts(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), 1) AS line FROM documents)),
    p AS (SELECT *, lag(value) OVER (PARTITION BY doc_id ORDER BY line) AS previous FROM l)
    SELECT doc_id, CAST(line AS BIGINT) AS line, sha256(value || '|' || previous) AS pair_hash FROM p WHERE value <> '' AND left(value, 1) = left(previous, 1)
    """
)
def prev_line_check(spark, d):
    """Lines that begin as the line before does."""
    from sheafline.sources.texts import lines

    rows = ordered.previous(lines(table(spark, d, "documents").where("text is not null"), "doc_id"), ["doc_id"], ["line"], "value")
    return rows.where("value <> '' and left(value, 1) = left(previous, 1)").select("doc_id", "line", F.sha2(F.concat_ws("|", "value", "previous"), 256).alias("pair_hash"))


@query(
    """
    WITH r AS (SELECT DISTINCT year, region, entry_id, noted_at, status, list_position(['待补充', '待处理', '处理中', '待人工核验', '已解决'], status) AS rank FROM ledger),
    k AS (SELECT *, lag(rank) OVER (PARTITION BY year, region ORDER BY noted_at, entry_id, status) AS before FROM r WHERE rank > 0)
    SELECT year, region, entry_id, status FROM k WHERE rank < before
    """
)
def section_order(spark, d):
    """Ledger rows whose status ranks before that of the row ahead of them."""
    rows = table(spark, d, "ledger").select("year", "region", "entry_id", "noted_at", "status").distinct()
    return ordered.out_of_order(rows, ["year", "region"], ["noted_at", "entry_id", "status"], "status", schema.LEDGER_ORDER).select("year", "region", "entry_id", "status")


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY event_id) AS keys FROM events GROUP BY user_id""")
def ordered_keys(spark, d):
    """The sequence of keys of each group."""
    return ordered.key_sequence(table(spark, d, "events"), ["user_id"], "event_id", "event_type").withColumn("keys", F.array_join("keys", ","))


@query(
    """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY year, region ORDER BY number, item_id) AS new_number FROM items)
    SELECT year, region, count(*) AS n, string_agg(CAST(number AS VARCHAR), ',' ORDER BY new_number) AS source_numbers FROM n GROUP BY ALL
    """
)
def renumber(spark, d):
    """Items renumbered from 1, the original numbers kept in order."""
    rows = ordered.renumber(table(spark, d, "items").select("year", "region", "number", "item_id"), ["year", "region"], ["number", "item_id"])
    kept = F.transform(F.array_sort(F.collect_list(F.struct("new_number", "number"))), lambda x: x["number"].cast("string"))
    return rows.groupBy("year", "region").agg(F.count(F.lit(1)).alias("n"), F.array_join(kept, ",").alias("source_numbers"))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_purchase FROM events")
def carry_forward(spark, d):
    """The last purchase carried forward."""
    rows = table(spark, d, "events")
    return ordered.carry_forward(rows, ["user_id"], ["event_id"], F.when(F.col("event_type") == "purchase", F.col("value")), "last_purchase").select("event_id", "user_id", "last_purchase")


@query(
    """
    WITH s AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM s)
    SELECT user_id, CAST(island AS BIGINT) AS island, min(event_type) AS event_type, count(*) AS n, min(event_id) AS first_id FROM i GROUP BY user_id, island
    """
)
def event_islands(spark, d):
    """Runs of equal neighbours as islands."""
    rows = ordered.islands(table(spark, d, "events"), ["user_id"], ["event_id"], "event_type")
    return rows.groupBy("user_id", "island").agg(F.min("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query(
    """
    WITH p AS (SELECT user_id, event_id, event_id % 3 > 0 AS tab FROM events),
    s AS (SELECT *, CASE WHEN tab AND lag(tab) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS s FROM p),
    i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM s)
    SELECT user_id, min(event_id) AS event_id, CASE WHEN bool_or(tab) THEN '<table class="t">' || string_agg('<tr>' || event_id || '</tr>', '' ORDER BY event_id) || '</table>' ELSE 'p' || min(event_id) END AS html FROM i GROUP BY user_id, island
    """
)
def page_merge(spark, d):
    """Pages of a user that end and begin with a table, joined (two of three pages are made tables)."""
    html_ = F.when(F.col("event_id") % 3 > 0, F.concat(F.lit('<table class="t"><tr>'), "event_id", F.lit("</tr></table>"))).otherwise(F.concat(F.lit("p"), "event_id"))
    return ordered.merge_tables(table(spark, d, "events").select("user_id", "event_id", html_.alias("html")), ["user_id"], "event_id", "html")


@query(
    """
    WITH f AS (SELECT year, region, paperName AS v, min(item_id) AS seen FROM items GROUP BY ALL)
    SELECT year, region, v AS "paperName", row_number() OVER (PARTITION BY year, region ORDER BY seen, v) AS no FROM f
    """
)
def first_appearance(spark, d):
    """Distinct names in order of first appearance."""
    rows = table(spark, d, "items").select("year", "region", "item_id", "paperName")
    return ordered.first_seen(rows, ["year", "region"], "item_id", "paperName").select("year", "region", "paperName", F.col("no").cast("long").alias("no"))


@query("SELECT year, region, questions, row_number() OVER (ORDER BY CASE WHEN year LIKE '%以前' THEN 0 ELSE 1 END, coalesce(TRY_CAST(year AS INTEGER), 9999), questions DESC, region) AS place FROM paper_facts ORDER BY place LIMIT 50")
def top_papers(spark, d):
    """The first fifty papers by year, size and name: a work list with a limit."""
    rows = table(spark, d, "paper_facts").select("year", "region", "questions", ordered.year_rank(F.col("year")).alias("rank"))
    top = rows.orderBy("rank", F.col("questions").desc(), "region").limit(50)
    from pyspark.sql import Window

    return top.withColumn("place", F.row_number().over(Window.orderBy("rank", F.col("questions").desc(), "region")).cast("long")).drop("rank")


@query("SELECT region, max_by(year, (questions, -figs, year)) AS year, max(questions) AS questions FROM paper_facts GROUP BY region")
def best_paper(spark, d):
    """One row per group: the greatest score, the first in order among equals."""
    rows = table(spark, d, "paper_facts").select("region", "year", "questions", "figs")
    return rows.groupBy("region").agg(F.max_by("year", F.struct("questions", -F.col("figs"), "year")).alias("year"), F.max("questions").alias("questions"))


@query("""SELECT entry_id, substr(problem, 1, 10) || CASE WHEN length(problem) > 10 THEN '…' ELSE '' END AS shown FROM (SELECT DISTINCT entry_id, problem FROM ledger)""")
def shortened(spark, d):
    """Texts shortened for display."""
    rows = table(spark, d, "ledger").select("entry_id", "problem").distinct()
    return rows.select("entry_id", F.concat(F.substring("problem", 1, 10), F.when(F.length("problem") > 10, "…").otherwise("")).alias("shown"))


# -- joins -------------------------------------------------------------------------------------

_NORM = lambda c: f"trim(regexp_replace(coalesce(CAST({c} AS VARCHAR), ''), '[\\s\u00a0\u3000]+', ' ', 'g'))"


def _compare_sql(left: str, right: str, fields: tuple[str, ...]) -> str:
    rows = " UNION ALL ".join(f"""SELECT year, region, number, '{f}' AS field, {_NORM(f'a."{f}"')} AS "left", {_NORM(f'b."{f}"')} AS "right" FROM a JOIN b USING (year, region, number) WHERE {_NORM(f'a."{f}"')} <> {_NORM(f'b."{f}"')}""" for f in fields)
    return f"""WITH a AS ({left}), b AS ({right}) {rows}
      UNION ALL SELECT year, region, number, 'missing_right', NULL, NULL FROM a WHERE (year, region, number) NOT IN (SELECT (year, region, number) FROM b)
      UNION ALL SELECT year, region, number, 'missing_left', NULL, NULL FROM b WHERE (year, region, number) NOT IN (SELECT (year, region, number) FROM a)"""


_COMPARED = ("paperName", "typeId", "type", "chapter", "point", "method", "score", "degree")
_LAST = lambda t, i: f"SELECT * FROM {t} WHERE year IS NOT NULL QUALIFY row_number() OVER (PARTITION BY year, region, number ORDER BY loaded_at DESC, {i} DESC) = 1"


@query(_compare_sql(_LAST("items", "item_id"), _LAST("bank_items", "bank_id"), _COMPARED))
def meta_compare(spark, d):
    """Metadata of the archive against the question bank, both ways."""
    last = lambda t, i: merge.latest(table(spark, d, t).where("year is not null").select(*schema.KEY, "loaded_at", i, *_COMPARED), schema.KEY, ["loaded_at", i])
    return joins.compare(last("items", "item_id"), last("bank_items", "bank_id"), schema.KEY, _COMPARED)


@query(f"""
    WITH s AS (SELECT year, region, number, {_LETTERS} AS answer, item_id FROM items WHERE "typeId" IN (1, 2)),
    k AS (SELECT year, region, number, list(DISTINCT answer) AS allowed FROM (SELECT year, region, number, {_LETTERS.replace('answer', 'body')} AS answer FROM bank_items WHERE "typeId" IN (1, 2)) GROUP BY ALL)
    SELECT s.item_id, s.answer FROM s JOIN k USING (year, region, number) WHERE NOT list_contains(k.allowed, s.answer)
    """)
def answer_agreement(spark, d):
    """Deliveries whose answer is not in the set that the question bank has under their key (the letters of its bodies); all rows of both."""
    letters = lambda t, c, *more: table(spark, d, t).where(F.col("typeId").isin(*schema.CHOICE_IDS)).select(*schema.KEY, tx.option_letters(c).alias("answer"), *more)
    return joins.agree_with_set(letters("items", "answer", "item_id"), letters("bank_items", "body"), schema.KEY, "answer", "answer").select("item_id", "answer")


@query(f"""
    WITH s AS (SELECT DISTINCT year, region, number, {_LETTERS} AS answer, item_id FROM items WHERE "typeId" IN (1, 2) AND year IS NOT NULL),
    k AS (SELECT *, count(*) OVER (PARTITION BY year, region, number, answer) AS same, min(item_id) OVER (PARTITION BY year, region, number) AS lo, max(item_id) OVER (PARTITION BY year, region, number) AS hi FROM s)
    SELECT item_id, answer, CASE WHEN lo = hi THEN 'no other side' ELSE 'differs' END AS finding FROM k WHERE same = 1
    """)
def answer_agreement_all(spark, d):
    """Deliveries whose answer no other delivery of the same item gives, and those without another delivery."""
    rows = table(spark, d, "items").where(F.col("typeId").isin(*schema.CHOICE_IDS) & F.col("year").isNotNull()).select(*schema.KEY, tx.option_letters("answer").alias("answer"), "item_id")
    return joins.agree_with_others(rows, schema.KEY, "item_id", "answer")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def ref_integrity(spark, d):
    """References without a definition."""
    return joins.missing(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), table(spark, d, "lineitem"), ["l_orderkey"]).select(F.col("l_orderkey").alias("o_orderkey"), "o_custkey")


_USED = r"""SELECT item_id, unnest(regexp_extract_all(coalesce(body, '') || ' ' || coalesce(answer, '') || ' ' || coalesce(memo, ''), '\\(U[A-Za-z]+)', 1)) AS macro FROM items"""


@query(rf"SELECT DISTINCT item_id, macro FROM ({_USED}) WHERE macro NOT IN (SELECT substr(macro, 2) FROM unit_macros)")
def unknown_macros(spark, d):
    """Unit macros in use that the dictionary (of fixed size) does not hold."""
    text = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("body", "answer", "memo")))
    used = table(spark, d, "items").select("item_id", F.explode(F.regexp_extract_all(text, F.lit(r"\\(U[A-Za-z]+)"), F.lit(1))).alias("macro")).distinct()
    known = table(spark, d, "unit_macros").select(F.substring("macro", 2, 100).alias("macro"))
    return joins.missing(used, known, ["macro"], broadcast=True).select("item_id", "macro")


@query(
    """
    WITH p AS (SELECT DISTINCT year, region, questions, status FROM progress)
    SELECT coalesce(f.year, p.year) AS year, coalesce(f.region, p.region) AS region,
           CASE WHEN p.year IS NULL THEN 'no progress row' WHEN f.year IS NULL THEN 'no paper' ELSE 'count differs' END AS finding, CAST(f.questions AS VARCHAR) AS facts, p.questions AS progress
    FROM paper_facts f FULL OUTER JOIN p ON f.year = p.year AND f.region = p.region
    WHERE p.year IS NULL OR f.year IS NULL OR TRY_CAST(p.questions AS BIGINT) IS DISTINCT FROM f.questions
    """
)
def paper_compare(spark, d):
    """Papers against progress rows, both ways, and their counts."""
    f = table(spark, d, "paper_facts").select("year", "region", F.col("questions").alias("facts"))
    p = table(spark, d, "progress").select("year", "region", F.col("questions").alias("progress"), "status").distinct()
    both = f.join(p, ["year", "region"], "full_outer")
    what = F.when(F.col("status").isNull(), "no progress row").when(F.col("facts").isNull(), "no paper").when(~F.col("progress").try_cast("long").eqNullSafe(F.col("facts")), "count differs")
    return both.select("year", "region", what.alias("finding"), F.col("facts").cast("string").alias("facts"), "progress").where("finding is not null")


@query("SELECT year, region, count(*) AS n FROM ledger WHERE (year, region) NOT IN (SELECT (year, region) FROM paper_facts) GROUP BY ALL UNION ALL SELECT year, region, 0 FROM paper_facts WHERE (year, region) NOT IN (SELECT (year, region) FROM ledger)")
def ledger_papers(spark, d):
    """Ledger rows of unknown papers, and papers without any ledger row."""
    facts, ledger = table(spark, d, "paper_facts").select("year", "region"), table(spark, d, "ledger").select("year", "region")
    unknown = joins.missing(ledger, facts, ["year", "region"]).groupBy("year", "region").agg(F.count(F.lit(1)).alias("n"))
    return unknown.unionByName(joins.missing(facts, ledger, ["year", "region"]).withColumn("n", F.lit(0).cast("long")))


@query("SELECT year, region, coalesce(min(nullif(trim(note), '')), '无') AS note FROM (SELECT DISTINCT year, region FROM paper_facts) LEFT JOIN progress USING (year, region) GROUP BY ALL")
def default_note(spark, d):
    """A field of the other side, or a default."""
    notes = table(spark, d, "progress").groupBy("year", "region").agg(F.min(F.nullif(F.trim("note"), F.lit(""))).alias("note"))
    return joins.with_default(table(spark, d, "paper_facts").select("year", "region").distinct(), notes, ["year", "region"], "note", F.lit("无"))


@query(
    """
    WITH c AS (SELECT o_custkey, o_orderkey, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) AS priority FROM orders)
    SELECT k.c_custkey, (SELECT min_by(o_orderkey, (priority, o_orderkey)) FROM c WHERE c.o_custkey = k.c_custkey) AS o_orderkey FROM customer k
    """
)
def priority_lookup(spark, d):
    """The first hit among candidates in order of priority."""
    order = F.array_position(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))), F.col("o_orderpriority"))
    c = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", order.alias("priority"))
    return joins.first_hit(table(spark, d, "customer").select("c_custkey"), c, "c_custkey", "o_orderkey", "priority")


@query(
    """
    WITH f AS (SELECT DISTINCT link || 'figs' AS folder, region AS name FROM progress), p AS (SELECT DISTINCT year || '/' || region || '/' || region || '.pdf' AS path, region AS name FROM paper_facts),
    m AS (SELECT f.*, p.path, regexp_replace(p.path, '/[^/]*$', '') AS parent FROM f LEFT JOIN p USING (name)),
    b AS (SELECT folder, name, max_by(path, (length(parent), path)) FILTER (folder = parent OR starts_with(folder, parent || '/')) AS prefix, count(path) AS n, min(path) AS sole FROM m GROUP BY ALL)
    SELECT folder, name, coalesce(prefix, CASE WHEN n = 1 THEN sole END) AS path FROM b
    """
)
def prefix_match(spark, d):
    """Folders to the file whose parent is their longest prefix, else to the only file of the name."""
    folders = table(spark, d, "progress").select(F.concat("link", F.lit("figs")).alias("folder"), F.col("region").alias("name")).distinct()
    files = table(spark, d, "paper_facts").select(F.concat_ws("/", "year", "region", F.concat("region", F.lit(".pdf"))).alias("path"), F.col("region").alias("name")).distinct()
    return joins.longest_prefix(folders, files)


_BOX = "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS box, l_quantity AS x0, l_quantity + 5 AS x1, l_extendedprice / 1000 AS y0, l_extendedprice / 1000 + 10 AS y1 FROM lineitem"


@query(f"WITH b AS ({_BOX}) SELECT a.l_orderkey, a.box AS a, b.box AS b FROM b a JOIN b b ON a.l_orderkey = b.l_orderkey AND a.box < b.box WHERE a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1")
def rect_overlap(spark, d):
    """Boxes of one group that share an area."""
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    q, p = F.col("l_quantity"), F.col("l_extendedprice") / 1000
    boxes = table(spark, d, "lineitem").select("l_orderkey", F.row_number().over(w).cast("long").alias("box"), q.alias("x0"), (q + 5).alias("x1"), p.alias("y0"), (p + 10).alias("y1"))
    return joins.overlapping(boxes, ["l_orderkey"], "box")


_COS = """
    WITH c AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) - list_avg(list_transform(embedding, lambda y: CAST(y AS DOUBLE)))) AS v FROM embeddings),
    u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM c),
    q AS (SELECT * FROM u WHERE vec_id % 20 = 0)
"""
_DOT = "round(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])), 6)"


def _vectors(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    return rows.where("id % 20 = 0"), rows


@query(_COS + f"SELECT q.vec_id AS query_id, max_by(p.vec_id, ({_DOT}, -p.vec_id)) AS match_id, max({_DOT}) AS score FROM q JOIN u p ON q.label = p.label AND q.vec_id <> p.vec_id GROUP BY ALL")
def figure_match(spark, d):
    """J15 (first stage), G01, T04: the most alike vector of the same label for every twentieth row, against all rows."""
    q, p = _vectors(spark, d)
    return joins.best_match(q, p, ["label"], trust=-1.0).where("scoped").select("query_id", "match_id", "score")


@query(
    _COS
    + f""", s AS (SELECT q.vec_id AS query_id, max_by(p.vec_id, ({_DOT}, -p.vec_id)) AS match_id, max({_DOT}) AS score FROM q JOIN u p ON q.label = p.label AND q.vec_id <> p.vec_id GROUP BY ALL),
    g AS (SELECT q.vec_id AS query_id, max_by(p.vec_id, ({_DOT}, -p.vec_id)) AS match_id, max({_DOT}) AS score FROM q JOIN u p ON q.vec_id <> p.vec_id GROUP BY ALL)
    SELECT *, true AS scoped FROM s WHERE score >= 0.4 UNION ALL SELECT *, false FROM g WHERE query_id NOT IN (SELECT query_id FROM s WHERE score >= 0.4)"""
)
def panel_fallback(spark, d):
    """The best of the same label, and below 0.4 the best of all rows."""
    q, p = _vectors(spark, d)
    return joins.best_match(q, p, ["label"], trust=0.4)


@query("SELECT year, region, CAST(i AS BIGINT) AS pos, l AS paper, r AS bank FROM (SELECT year, region, list(number ORDER BY item_id) AS a FROM items WHERE year IS NOT NULL GROUP BY ALL) JOIN (SELECT year, region, list(number ORDER BY bank_id) AS b FROM bank_items GROUP BY ALL) USING (year, region), LATERAL (SELECT unnest(range(len(a))) AS i, unnest(a) AS l, unnest(b) AS r) WHERE len(a) = len(b)")
def positional_zip(spark, d):
    """Two lists of one key side by side; lists of unlike length give nothing."""
    own = lambda t, i, n: table(spark, d, t).where("year is not null").groupBy("year", "region").agg(F.transform(F.array_sort(F.collect_list(F.struct(i, "number"))), lambda x: x["number"]).alias(n)).withColumn("key", F.struct("year", "region")).drop("year", "region")
    out = joins.zip_by_position(own("items", "item_id", "paper"), own("bank_items", "bank_id", "bank"), "key", "paper", "bank")
    return out.select("key.year", "key.region", F.col("pos").cast("long").alias("pos"), "paper", "bank")


# -- sets --------------------------------------------------------------------------------------

_TOKENS = lambda c, t: f"SELECT DISTINCT unnest(regexp_extract_all(coalesce({c}, ''), '[0-9]+\\.?[0-9]*', 0)) AS token FROM {t}"


@query(f"WITH a AS ({_TOKENS('text', 'documents')}), b AS ({_TOKENS('body', 'bank_items')}), c AS ({_TOKENS('text', 'eval_items')}) SELECT token, CAST(sum(bit) AS INTEGER) AS mask FROM (SELECT token, 1 AS bit FROM a UNION ALL SELECT token, 2 FROM b UNION ALL SELECT token, 4 FROM c) GROUP BY token")
def set_diff3(spark, d):
    """Which of three sources hold each number: every difference from one aggregation."""
    own = lambda t, c: sets.tokens(table(spark, d, t), c, r"[0-9]+\.?[0-9]*")
    return sets.source_masks({"documents": own("documents", "text"), "bank": own("bank_items", "body"), "eval": own("eval_items", "text")})


@query("SELECT DISTINCT year, region FROM items WHERE year IS NOT NULL EXCEPT SELECT year, region FROM bank_items EXCEPT SELECT year, region FROM ledger")
def set_minus(spark, d):
    """Keys of one table in none of the others."""
    key = lambda t: table(spark, d, t).select("year", "region", F.concat_ws("/", "year", "region").alias("k"))
    return sets.minus(key("items").where("year is not null").distinct(), key("bank_items"), key("ledger"), on="k").select("year", "region")


# -- merges and increments ---------------------------------------------------------------------

_MERGE = """
    WITH l AS (SELECT year, region, question, category, problem, action, status, entry_id, loaded_at FROM ledger WHERE entry_id % 3 <> 0), r AS (SELECT year, region, question, category, problem, action, status, entry_id, loaded_at FROM ledger WHERE entry_id % 3 = 0 OR status = '已解决'),
    o AS (SELECT year, region, question, category, problem, max_by({'a': action, 's': status}, (loaded_at, entry_id)) AS x FROM l GROUP BY ALL), n AS (SELECT year, region, question, category, problem, max_by({'a': action, 's': status}, (loaded_at, entry_id)) AS y FROM r GROUP BY ALL),
    j AS (SELECT year, region, question, category, problem, x, y, coalesce(y.a, x.a) AS action, coalesce(y.s, x.s) AS status FROM o FULL OUTER JOIN n USING (year, region, question, category, problem)),
    k AS (SELECT *, CASE x.s WHEN '待补充' THEN 1 WHEN '待处理' THEN 2 WHEN '处理中' THEN 2 WHEN '待人工核验' THEN 3 WHEN '已解决' THEN 4 ELSE 0 END AS p, CAST(CASE status WHEN '待补充' THEN 1 WHEN '待处理' THEN 2 WHEN '处理中' THEN 2 WHEN '待人工核验' THEN 3 WHEN '已解决' THEN 4 ELSE 0 END AS INTEGER) AS section FROM j)
    SELECT year, region, question, category, problem, action, status, section, CASE WHEN x IS NULL THEN 'added' WHEN y IS NULL THEN 'kept' WHEN status IS DISTINCT FROM x.s AND p <> section THEN 'moved' WHEN status IS DISTINCT FROM x.s OR action IS DISTINCT FROM x.a THEN 'updated' ELSE 'kept' END AS change FROM k
"""


@query(_MERGE)
def ledger_upsert(spark, d):
    """Reviews (here every third entry, and all resolved ones) merged into the rest of the ledger."""
    rows = table(spark, d, "ledger")
    return merge.merge_ledger(rows.where("entry_id % 3 <> 0"), rows.where("entry_id % 3 = 0 or status = '已解决'"), order=("loaded_at", "entry_id"))


@query("SELECT p.year, p.region, coalesce(CAST(f.questions AS VARCHAR), p.questions) AS questions, p.status FROM progress p LEFT JOIN (SELECT year, region, max(questions) AS questions FROM paper_facts GROUP BY ALL) f USING (year, region)")
def backfill(spark, d):
    """A column filled again from derived values."""
    derived = table(spark, d, "paper_facts").groupBy("year", "region").agg(F.max("questions").alias("questions"))
    return merge.backfill(table(spark, d, "progress"), derived, ["year", "region"], "questions").select("year", "region", "questions", "status")


@query(
    """
    WITH c AS (SELECT doc_id, sha256(encode(coalesce(text, '')) || '\\x00'::BLOB || encode(coalesce(source, ''))) AS hash FROM documents),
    s AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE hash END AS hash FROM c WHERE doc_id % 5 <> 0)
    SELECT c.doc_id, c.hash, CASE WHEN s.doc_id IS NULL THEN 'new' WHEN s.hash = c.hash THEN 'same' ELSE 'drift' END AS state FROM c LEFT JOIN s USING (doc_id)
    """
)
def hash_skip(spark, d):
    """Sources against an earlier snapshot (made here: a fifth unknown, a seventh of another source)."""
    now = table(spark, d, "documents").select("doc_id", ag.source_hash(F.col("text"), F.col("source")).alias("hash"))
    then = now.where("doc_id % 5 <> 0").withColumn("hash", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("hash")))
    return merge.by_hash(now, then, ["doc_id"])


@query(
    """
    WITH d AS (SELECT doc_id, length(text) AS length FROM documents WHERE doc_id % 5 <> 0)
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d WHERE length > 0)
    """
)
def pending_work(spark, d):
    """Documents whose output is missing or empty (a fifth of the outputs is made missing)."""
    docs = table(spark, d, "documents")
    done = docs.where("doc_id % 5 <> 0").select("doc_id", F.length("text").alias("length"))
    return merge.pending(docs.select("doc_id"), done, ["doc_id"])


@query(
    """
    WITH r AS (SELECT o_orderkey, 'figs/' || o_custkey || '.png' AS path FROM orders),
    f AS (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey % 3 > 0)
    SELECT o_orderkey, path FROM r WHERE CAST(regexp_extract(path, '([0-9]+)', 1) AS BIGINT) NOT IN (SELECT c_custkey FROM f)
    """
)
def unresolved_files(spark, d):
    """References that exist neither as they are nor under another ending (two of three customers have a file, half of them of another ending)."""
    refs = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("figs/"), "o_custkey", F.lit(".png")).alias("path"))
    ends = F.when(F.col("c_custkey") % 3 == 1, ".png").otherwise(".svg")
    files = table(spark, d, "customer").where("c_custkey % 3 > 0").select(F.concat(F.lit("figs/"), "c_custkey", ends).alias("path"))
    return joins.resolve_files(refs, files).select("o_orderkey", "path")


@query("SELECT p_partkey, p_size % 5 AS panels, p_size % 3 AS labels FROM part WHERE p_size % 5 >= 2 OR p_size % 3 > 0")
def triage_list(spark, d):
    """The list of pictures to look at, by panels and labels (made of the sizes of parts)."""
    return rasters.triage(table(spark, d, "part").select("p_partkey", (F.col("p_size") % 5).alias("panels"), (F.col("p_size") % 3).alias("labels")))


# -- parsing and rules -------------------------------------------------------------------------

_PAPERS = r"""
    WITH t AS (SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM documents WHERE source = 'paper_tex' AND text IS NOT NULL),
    s AS (SELECT doc_id, unnest(string_split(chr(10) || text, chr(10) || '%% number:')) AS block, generate_subscripts(string_split(chr(10) || text, chr(10) || '%% number:'), 1) AS i FROM t),
    b AS (SELECT doc_id, i, CAST(regexp_extract(block, '^\s*([0-9]+)', 1) AS BIGINT) AS number, block FROM s WHERE i > 1 AND regexp_matches(block, '^\s*[0-9]+'))
"""


@query(_PAPERS + r"SELECT doc_id, number, count(*) AS n, min(trim(regexp_extract(block, '\n%%[ \t]*chapter[ \t]*[:：][ \t]*([^\n]*)', 1))) AS chapter FROM b GROUP BY ALL")
def item_parse(spark, d):
    """Items of paper sources with their metadata."""
    docs = table(spark, d, "documents").where("source = 'paper_tex' and text is not null").withColumn("text", F.regexp_replace("text", r"\r\n?", "\n"))
    rows = parse.item_blocks(docs, "doc_id").select("doc_id", "number", F.coalesce(parse.metadata(F.col("block"))["chapter"], F.lit("")).alias("chapter"))
    return rows.groupBy("doc_id", "number").agg(F.count(F.lit(1)).alias("n"), F.min("chapter").alias("chapter"))


@query()
def paper_archive(spark, d):
    """Paper sources as nested records."""
    docs = table(spark, d, "documents").where("source = 'paper_tex' and text is not null").withColumn("text", F.regexp_replace("text", r"\r\n?", "\n"))
    out = parse.collect_papers(parse.parse_papers(docs, "doc_id"), "doc_id")
    return out.select("doc_id", "chapter", F.size("items").alias("n"), F.sha2(F.to_json("items"), 256).alias("items_hash"))


@query(r"""SELECT progress.year AS year, progress.region AS region, regexp_extract(link, '((?:19|20)[0-9]{2}[^/]*)/([^/]+)', 1) AS path_year, regexp_extract(link, '((?:19|20)[0-9]{2}[^/]*)/([^/]+)', 2) AS path_region FROM progress""")
def path_keys(spark, d):
    """Year and region from a path."""
    from sheafline.sources.texts import path_key

    y, r = path_key(F.concat("link", F.lit("x.tex")))
    return table(spark, d, "progress").select("year", "region", y.alias("path_year"), r.alias("path_region"))


@query(r"""SELECT item_id, len(list_filter(regexp_split_to_array(coalesce(body, ''), '(?i)</p\s*>|<br\s*/?>'), lambda x: trim(regexp_replace(x, '<[^>]*>|&nbsp;', '', 'g')) <> '')) AS paragraphs FROM items""")
def paragraph_counts(spark, d):
    """Paragraphs of each body."""
    return table(spark, d, "items").select("item_id", F.size(parse.paragraphs(F.coalesce("body", F.lit("")))).cast("long").alias("paragraphs"))


@query()
def option_rows(spark, d):
    """Options of each body."""
    rows = table(spark, d, "items").select("item_id", F.posexplode(parse.options(F.regexp_replace("body", "<[^>]*>", "\n"))).alias("pos", "o"))
    return rows.select("item_id", F.col("pos").cast("long").alias("pos"), "o.label", "o.value")


@query()
def paragraph_kinds(spark, d):
    """Stem, options and sub-questions of each body."""
    return parse.classify_paragraphs(spread(table(spark, d, "items").select("item_id", "body")), "item_id", "body")


@query(
    r"""
    WITH t AS (SELECT item_id, coalesce(body, '') || ' ' || coalesce(answer, '') || ' ' || coalesce(memo, '') AS t FROM items),
    m AS (SELECT item_id, [regexp_extract_all(t, P, 1), regexp_extract_all(t, P, 2), regexp_extract_all(t, P, 3)] AS g FROM t),
    z AS (SELECT item_id, list_filter(list_transform(range(1, len(g[1]) + 1), lambda i: concat(g[1][i], g[2][i], g[3][i])), lambda x: x <> '') AS v FROM m)
    SELECT item_id, image, CAST(min(pos) AS BIGINT) AS first_pos FROM (SELECT item_id, unnest(v) AS image, generate_subscripts(v, 1) AS pos FROM z) GROUP BY ALL
    """.replace("P, ", "'" + parse.IMAGE.replace("'", "''") + "', ")
)
def image_refs(spark, d):
    """Image references in any notation, each once, at its first place."""
    text = F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("body", "answer", "memo")))
    places = F.posexplode(parse.image_places(text)).alias("pos", "image")
    return table(spark, d, "items").select("item_id", places).groupBy("item_id", "image").agg((F.min("pos") + 1).cast("long").alias("first_pos"))




@query(
    r"""
    WITH l AS (SELECT doc_id, line, regexp_replace(v, '(^|[^\\])%.*$', '\1') AS v FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS v, generate_subscripts(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), 1) AS line FROM documents WHERE text IS NOT NULL)),
    f AS (SELECT doc_id, count_if(regexp_matches(v, '\\(newpage|clearpage|vfill|vfil|hfil)([^A-Za-z]|$)')) AS layout, count_if(regexp_matches(v, '\\mathrm\{[^{}]*[一-鿿][^{}]*\}')) AS roman, count_if(regexp_matches(v, '[一-鿿][,;:()][一-鿿]')) AS punctuation, count_if(NOT contains(v, '$') AND regexp_matches(v, '[一-鿿][A-Za-z]|[A-Za-z][一-鿿]')) AS spacing FROM l GROUP BY doc_id)
    SELECT doc_id, CAST(layout + roman AS BIGINT) AS errors, CAST(punctuation + spacing AS BIGINT) AS warnings, CAST(layout + roman > 0 AS INTEGER) AS failed FROM f WHERE layout + roman + punctuation + spacing > 0
    """
)
def lint_findings(spark, d):
    """The line rules that SQL can say over all documents, a finding a line, and the verdict of each."""
    from sheafline.sources.texts import lines

    rows = lines(table(spark, d, "documents").where("text is not null"), "doc_id")
    found = rules.line_rules(rows.select("doc_id", F.lit("").alias("year"), F.col("doc_id").alias("region"), "line", "value"))
    told = found.where(F.col("check").isin("layout", "roman-cjk", "punctuation", "spacing")).select(F.col("region").alias("doc_id"), "check", "level", "line").distinct()
    return ag.verdict(told, ["doc_id"])


#: The class and the version switch that papers of these tables are checked for: parameters of their archive.
PAPER = ("exam", "version")


@query()
def paper_findings(spark, d):
    """R01 to R31 on paper sources: all findings of all rules. Papers are cut out and items parsed once; the rules read those tables."""
    from sheafline.sources.texts import lines

    docs = table(spark, d, "documents").where("source = 'paper_tex' and text is not null").select(F.col("year"), F.concat_ws("#", "region", "doc_id").alias("region"), F.regexp_replace("text", r"\r\n?", "\n").alias("text"))
    docs = stage(docs.withColumn("id", F.struct("year", "region")), "papers")
    items = parse.item_blocks(docs, "id").select("id.year", "id.region", "number", "block", parse.metadata(F.col("block")).alias("m"))
    items = items.select("year", "region", "number", "block", F.col("m")["typeId"].try_cast("long").alias("typeId"), F.col("m")["type"].alias("type"), parse.section(F.col("block"), "%% memo:", None).alias("memo"))
    items = stage(spread(items), "paper-items")
    own = lines(docs, "id").select("id.year", "id.region", "line", "value")
    return rules.check_papers(docs, items, own, table(spark, d, "unit_macros"), *PAPER)


@query(
    """
    WITH l AS (SELECT DISTINCT year, region, entry_id, coalesce(category, '') AS category, coalesce(status, '') AS status FROM ledger)
    SELECT 'status' AS "check", year, region, entry_id AS number, status AS message FROM l WHERE status NOT IN ('待处理', '处理中', '已解决')
    UNION ALL SELECT 'category', year, region, entry_id, category FROM l WHERE category NOT IN ('缺题', '缺图', '缺详解', '详解', '来源', '公式', '单位', '文字')
    """
)
def ledger_vocabulary(spark, d):
    """Ledger rows outside the vocabularies that a caller gives for status and category."""
    rows = table(spark, d, "ledger").select("year", "region", "entry_id", F.coalesce("category", F.lit("")).alias("category"), F.coalesce("status", F.lit("")).alias("status")).distinct()
    bad = rules.vocabulary(rows, "status", schema.LEDGER[:3], "status", "entry_id").unionByName(rules.vocabulary(rows, "category", schema.CATEGORIES[:8], "category", "entry_id"))
    return bad.select("check", "year", "region", "number", "message")


@query("SELECT entry_id, year, region, question FROM (SELECT DISTINCT entry_id, year, region, question, problem FROM ledger) WHERE year IN ('2016', '2020') AND contains(region, '州') AND contains(problem, '图')")
def work_filter(spark, d):
    """A work list by years, part of a name and a keyword."""
    rows = table(spark, d, "ledger").select("entry_id", "year", "region", "question", F.col("problem").alias("path"), F.lit(None).cast("string").alias("target"), "problem").distinct()
    return rules.work_filter(rows, ["2016", "2020"], "州", "图").select("entry_id", "year", "region", "question")



def _cut(text: str, pattern: str, made: str) -> str:
    """SQL for a text cut at a pattern, what it finds put back as ``made`` (of ``m``)."""
    return f"array_to_string(list_transform(range(1, len(regexp_split_to_array({text}, '{pattern}')) + 1), lambda i: regexp_split_to_array({text}, '{pattern}')[i] || coalesce(list_transform(regexp_extract_all({text}, '{pattern}'), lambda m: {made})[i], '')), '')"


_COLON, _HYPHEN, _DASH = r"\p{Nd}+(?:：\p{Nd}+)+", r"\$[^$\n]+\$(?:-\$[^$\n]+\$)+", r"\$[^$\n]+\$(?:[–—~～]\$[^$\n]+\$)+"
_INNER = {"colon": "replace(m, '：', ':')", "hyphen": "'$' || replace(m, '$', '') || '$'", "dash": "'$' || translate(replace(m, '$', ''), '–—~～', '----') || '$'"}
_JOINED = "replace(coalesce(body, ''), '$ 与 $', '$-$')"


# -- scalar functions --------------------------------------------------------------------------


@query(
    r"""
    WITH t AS (SELECT item_id, regexp_replace(regexp_replace(coalesce(body, '') || chr(10) || 'DIYIZHANG' || chr(10) || chr(10) || chr(10) || 'AB' || chr(10), '\\dfrac([^A-Za-z]|$)', '\\frac\1', 'g'), '[\x{E000}-\x{F8FF}]', '', 'g') AS t FROM items),
    l AS (SELECT item_id, array_to_string(list_filter(regexp_split_to_array(t, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'), lambda v: NOT regexp_matches(v, '^\s*[A-Z]{3,}\s*$')), chr(10)) AS t FROM t)
    SELECT item_id, sha256(regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')) AS body_hash FROM l
    """
)
def textfix(spark, d):
    """Rewrites of bodies, each with a line of noise put behind it."""
    noisy = F.concat(F.coalesce("body", F.lit("")), F.lit("\nDIYIZHANG\n\n\nAB\n"))
    return table(spark, d, "items").select("item_id", F.sha2(tx.squeeze_noise(tx.drop_private(tx.plain_fraction(noisy))), 256).alias("body_hash"))


@query(
    f"WITH a AS (SELECT item_id, {_JOINED} || ' 8：00：30 $a$-$b$ $v$–$t$~$x$ \\dfrac12' AS t FROM items), "
    f"b AS (SELECT *, {_cut('t', _COLON, _INNER['colon'])} AS u FROM a), "
    f"c AS (SELECT *, {_cut('u', _HYPHEN, _INNER['hyphen'])} AS v FROM b), "
    f"e AS (SELECT *, {_cut('v', _DASH, _INNER['dash'])} AS w FROM c) "
    rf"SELECT item_id, sha256(regexp_replace(w, '\\dfrac([^A-Za-z]|$)', '\\frac\1', 'g')) AS body_hash, CAST(len(regexp_extract_all(t, '{_COLON}')) AS BIGINT) AS colon, CAST(len(regexp_extract_all(u, '{_HYPHEN}')) AS BIGINT) AS hyphen, CAST(len(regexp_extract_all(v, '{_DASH}')) AS BIGINT) AS dash, CAST(len(regexp_extract_all(w, '\\dfrac([^A-Za-z]|$)')) AS BIGINT) AS fraction FROM e"
)
def rule_rewrites(spark, d):
    """All rules in order over all bodies (with some chains put in), with the count of each."""
    text = F.concat(F.replace(F.coalesce("body", F.lit("")), F.lit("$ 与 $"), F.lit("$-$")), F.lit(" 8：00：30 $a$-$b$ $v$–$t$~$x$ \\dfrac12"))
    out = tx.fix_text(table(spark, d, "items").select("item_id", text.alias("body")), "body")
    n = lambda rule: F.coalesce(F.get(F.filter("changes", lambda c: c["rule"] == rule), F.lit(0))["n"], F.lit(0)).cast("long")
    return out.select("item_id", F.sha2("body", 256).alias("body_hash"), n("colon").alias("colon"), n("math-hyphen").alias("hyphen"), n("math-dash").alias("dash"), n("fraction").alias("fraction"))


@query(
    rf"""
    WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS v FROM documents),
    f AS (SELECT doc_id, unnest([{{'rule': 'colon', 'n': len(regexp_extract_all(v, '{_COLON}'))}}, {{'rule': 'units', 'n': len(regexp_extract_all(v, '[0-9]+ (mm|cm|kg|kN|km)'))}}, {{'rule': 'fraction', 'n': len(regexp_extract_all(v, '\\dfrac([^A-Za-z]|$)'))}}]) AS x FROM l)
    SELECT doc_id, x.rule AS rule, CAST(sum(x.n) AS BIGINT) AS n FROM f GROUP BY ALL HAVING sum(x.n) > 0
    """
)
def rule_counts(spark, d):
    """Every place that rules find in a document, counted by rule."""
    own = [r for r in tx.RULES if not r.name.startswith("math")] + [tx.Rule("units", "values with a unit", "[0-9]+ (mm|cm|kg|kN|km)", lambda c: c)]
    return tx.scan_text(table(spark, d, "documents").where("text is not null"), "doc_id", "text", own).groupBy("doc_id", "rule").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT item_id, {_NORM('"paperName"')} AS name, {_LETTERS} AS letters FROM items""")
def normalised_fields(spark, d):
    """normalised names and option letters."""
    return table(spark, d, "items").select("item_id", tx.squeeze("paperName").alias("name"), tx.option_letters("answer").alias("letters"))




@query("SELECT year, region, CASE WHEN questions = 0 THEN '未开始' WHEN placeholder > 0 THEN '待补充' WHEN NOT student THEN '进行中' WHEN NOT teacher THEN '待复核' ELSE '已完成' END AS status FROM paper_facts")
def derived_status(spark, d):
    """the status that follows from a paper's facts."""
    return table(spark, d, "paper_facts").select("year", "region", tx.derived_status("questions", "placeholder", "teacher", "student").alias("status"))


@query(
    """
    WITH b AS (SELECT p_partkey, p_size, least(greatest(round_even((p_size * 30 - 200) * 640.0 / 1000, 0), 0), 640) AS x0, least(greatest(round_even((p_size * 40) * 640.0 / 1000, 0), 0), 640) AS x1 FROM part)
    SELECT p_partkey, CAST(CASE WHEN x1 > x0 THEN x0 END AS BIGINT) AS x0, CAST(CASE WHEN x1 > x0 THEN x1 END AS BIGINT) AS x1, p_size * 30 - 200 >= 0 AND p_size * 40 <= 640 AND p_size * 30 - 200 < p_size * 40 AS within, greatest(4, CAST(round_even(greatest(p_size, 20) * 0.1, 0) AS BIGINT)) AS padding,
           greatest(CAST(floor(p_size * least(1.0, 40.0 / greatest(p_size, 25))) AS BIGINT), 1) AS fit_w FROM b
    """
)
def box_arithmetic(spark, d):
    """Boxes from a grid, whether they lie within, paddings and sizes that fit."""
    size, n = F.col("p_size").cast("long"), lambda v: F.lit(v).cast("long")
    left, right = size * 30 - 200, size * 40
    box = geometry.grid_box(left, n(0), right, n(1000), n(640), n(480))
    within = geometry.inside({"x0": left, "y0": n(0), "x1": right, "y1": n(5)}, n(640), n(480))
    return table(spark, d, "part").select("p_partkey", box["x0"].alias("x0"), box["x1"].alias("x1"), within.alias("within"), geometry.label_padding(size, n(20)).alias("padding"), geometry.fit_within(size, n(25), 40)["width"].cast("long").alias("fit_w"))


@query()
def html_text(spark, d):
    """Bodies as typeset text."""
    rows = spread(table(spark, d, "items").select("item_id", "body"))
    return rows.select("item_id", html.html_to_tex(F.col("body")).alias("tex"))


@query()
def html_cells(spark, d):
    """P10: cells of the tables in bodies, at their places."""
    return html.table_cells(spread(table(spark, d, "items").select("item_id", "body")), "item_id", "body")


@query()
def tail_repeats(spark, d):
    """texts whose recognised end repeats, collapsed."""
    rows = spread(table(spark, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.length(repeat.tail_repeat(F.col("text"))).alias("length"))
