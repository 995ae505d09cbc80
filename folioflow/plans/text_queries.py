"""Queries over encoded text: math, options, tables, questions.

Fixture tables hold no document markup, so each query writes relational rows in
the document format, runs the operator on that text, and its SQL computes the
result from the columns, without parsing. Variants by a key's remainder reach
the negative branches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import exams, markup
from ..functions.arrow import column
from ..functions.mathtext import cell_markdown, escape_cell, inline_formulas, mask_math, tidy_inline, visible_prose
from ..operators import export, normalize, recover, watermark
from . import config

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def say(*parts) -> Column:
    """Parts joined to text: columns as text, strings as they are."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def by(k: Column, *cases: Column | str) -> Column:
    """The case of k's value, the last for all others."""
    cases = [F.lit(c) if isinstance(c, str) else c for c in cases]
    out = F.when(k == 0, cases[0])
    for i, c in enumerate(cases[1:-1], 1):
        out = out.when(k == i, c)
    return out.otherwise(cases[-1])


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    return read(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size"), F.col("p_partkey"), F.col("p_size")


# --- math and scalars --------------------------------------------------------


def math_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = by(
        key % 8,
        say("area$ x_", size, " $units"),
        say("cost $", size, " and $10"),
        say("code `$", size, "$` end"),
        say("open $ only ", size),
        say("pay \\$ and $y_", size, "$."),
        say("$$ z $$ and $ w", size, " $"),
        say('tag <b title="$', size, '$"> and \\(q\\) $v$a'),
        say("pipe $a|b$ with $", size, "$"),
    )
    return df.select("p_partkey", text.alias("text"))


@query("""SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN 'area' || repeat(' ', 6 + len(p_size::VARCHAR)) || 'units'
  WHEN 1 THEN 'cost ' || repeat(' ', 7 + len(p_size::VARCHAR)) || '10'
  WHEN 2 THEN 'code ' || repeat(' ', 4 + len(p_size::VARCHAR)) || ' end'
  WHEN 3 THEN NULL
  WHEN 4 THEN 'pay \\$ and ' || repeat(' ', 4 + len(p_size::VARCHAR)) || '.'
  WHEN 5 THEN repeat(' ', 7) || ' and ' || repeat(' ', 5 + len(p_size::VARCHAR))
  WHEN 6 THEN 'tag <b title="' || repeat(' ', 2 + len(p_size::VARCHAR)) || '"> and ' || repeat(' ', 5) || ' ' || '   ' || 'a'
  ELSE 'pipe ' || repeat(' ', 5) || ' with ' || repeat(' ', 2 + len(p_size::VARCHAR)) END AS masked FROM part""")
def mask_math_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return math_texts(spark, sf_dir).select("p_partkey", mask_math(F.col("text")).alias("masked"))


@query("""SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN 'area' || repeat(' ', 6 + len(p_size::VARCHAR)) || 'units'
  WHEN 1 THEN 'cost ' || repeat(' ', 7 + len(p_size::VARCHAR)) || '10'
  WHEN 2 THEN 'code ' || repeat(' ', 4 + len(p_size::VARCHAR)) || ' end'
  WHEN 3 THEN NULL
  WHEN 4 THEN 'pay \\$ and ' || repeat(' ', 4 + len(p_size::VARCHAR)) || '.'
  WHEN 5 THEN repeat(' ', 7) || ' and ' || repeat(' ', 5 + len(p_size::VARCHAR))
  WHEN 6 THEN 'tag ' || repeat(' ', 14 + len(p_size::VARCHAR)) || ' and ' || repeat(' ', 9) || 'a'
  ELSE 'pipe ' || repeat(' ', 5) || ' with ' || repeat(' ', 2 + len(p_size::VARCHAR)) END AS prose FROM part""")
def visible_prose_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return math_texts(spark, sf_dir).select("p_partkey", visible_prose(F.col("text")).alias("prose"))


@query("""SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN '4:' || (10 + len(p_size::VARCHAR)) || ' x_' || p_size || ' ' WHEN 4 THEN '11:' || (15 + len(p_size::VARCHAR)) || 'y_' || p_size
  WHEN 5 THEN '12:' || (17 + len(p_size::VARCHAR)) || ' w' || p_size || ' ' WHEN 6 THEN (29 + len(p_size::VARCHAR)) || ':' || (32 + len(p_size::VARCHAR)) || 'v'
  WHEN 7 THEN '5:10a|b;16:' || (18 + len(p_size::VARCHAR)) || p_size ELSE '' END AS spans FROM part""")
def inline_math_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = column(lambda t: ";".join(f"{m.start()}:{m.end()}{m[1]}" for m in inline_formulas(t)), "string")
    return math_texts(spark, sf_dir).select("p_partkey", found(F.col("text")).alias("spans"))


TIDY = """CASE p_partkey % 8
  WHEN 0 THEN 'area $x_' || p_size || '$ units' WHEN 1 THEN 'cost $' || p_size || ' and $10' WHEN 2 THEN 'code `$' || p_size || '$` end'
  WHEN 3 THEN 'open $ only ' || p_size WHEN 4 THEN 'pay \\$ and $y_' || p_size || '$.' WHEN 5 THEN '$$ z $$ and $w' || p_size || '$'
  WHEN 6 THEN 'tag <b title="$' || p_size || '$"> and \\(q\\) $v$ a' ELSE 'pipe $a|b$ with $' || p_size || '$' END"""


@query(f"SELECT p_partkey, {TIDY} AS tidy FROM part")
def normalize_inline_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = export.tidied(F.col("text"))
    return math_texts(spark, sf_dir).select("p_partkey", once.alias("tidy"))


@query("SELECT count(*)::BIGINT AS changed_again FROM part WHERE false")
def normalize_inline_math_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = math_texts(spark, sf_dir).select(export.tidied(F.col("text")).alias("t"))
    return once.where(export.tidied(F.col("t")) != F.col("t")).agg(F.count("*").alias("changed_again"))


@query("""SELECT p_partkey, CASE p_partkey % 8
  WHEN 0 THEN 'area $x_' || p_size || '$ units' WHEN 1 THEN 'cost \\$' || p_size || ' and \\$10' WHEN 2 THEN 'code \\`\\$' || p_size || '\\$\\` end'
  WHEN 3 THEN 'open \\$ only ' || p_size WHEN 4 THEN 'pay \\\\\\$ and $y_' || p_size || '$.' WHEN 5 THEN '\\$\\$ z \\$\\$ and $w' || p_size || '$'
  WHEN 6 THEN 'tag &lt;b title="\\$' || p_size || '\\$"&gt; and \\\\(q\\\\) $v$ a' ELSE NULL END AS cell FROM part""")
def render_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return math_texts(spark, sf_dir).select("p_partkey", export.cell(F.col("text")).alias("cell"))


@query(r"SELECT p_partkey, 'a\|b\_' || p_size || ' \\ &amp;&lt;' || p_brand || '&gt; \[\$\*\`\]' AS cell FROM part")
def escape_cell_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _, size = parts(spark, sf_dir)
    return df.select("p_partkey", escape_cell(say("a|b_", size, " \\ &<", F.col("p_brand"), "> [$*`]")).alias("cell"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 4 THEN '$x' || p_size ELSE 'x' || p_size END AS formula FROM part")
def normalize_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    x = say("x", size)
    return df.select("p_partkey", normalize.normalize_formula(by(key % 6, say(" $$", x, "$$ "), say("\\[ ", x, " \\]"), say("\\(", x, "\\)"), say("$ ", x, "$\n"), say("$", x), x)).alias("formula"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '# t' || p_size WHEN p_partkey % 5 = 1 THEN repeat('#', least(6, greatest(1, p_size % 9 + 1))) || ' t' || p_size
  WHEN p_partkey % 5 = 2 THEN '# t' || p_size WHEN p_partkey % 5 = 3 THEN '## t' || p_size ELSE 't' || p_size END AS content FROM part""")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    kind = by(key % 5, "doc_title", "paragraph_title", "paragraph_title", "paragraph_title", "text")
    content = F.when(key % 5 == 2, say("# t", size)).otherwise(say("t", size))
    level = F.when(key % 5 == 1, (size % 9).cast("int"))
    return df.select("p_partkey", normalize.heading(kind, content, level).alias("content"))


@query("""SELECT p_partkey, p_partkey % 7 NOT IN (1, 2, 3, 4, 5) AND p_size > 0 AS valid FROM part""")
def valid_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    s = size.cast("double")
    box = lambda *v: F.array(*[x if isinstance(x, Column) else F.lit(float(x)) for x in v])
    cases = (box(0, 0, s, s), box(s, 0, s, s), box(-1, 0, s, s), box(0, 0, s, "nan"), box(0, 0, "inf", s), box(0, 0, s))
    made = by(key % 7, *cases, box(1, 2, s + 1, s + 2))
    return df.select("p_partkey", normalize.valid_bbox(made).isNotNull().alias("valid"))


# --- options -----------------------------------------------------------------


@query("""SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN '1,2,3' WHEN 6 THEN '1,3,2' WHEN 7 THEN '1,2,3' ELSE NULL END AS labels,
  CASE WHEN p_partkey % 9 IN (0, 6) THEN 'Q' || p_partkey || '. Pick:' WHEN p_partkey % 9 = 7 THEN 'Q' || p_partkey || '. Pick' END AS question,
  CASE WHEN p_partkey % 9 IN (0, 6, 7) THEN 'v' || p_size END AS first FROM part""")
def recognize_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    q, v = say("Q", key, ". Pick"), say("v", size)
    text = by(
        key % 9,
        say(q, ": (1) ", v, " (2) b (3) $c (4)$"),
        say(q, " (1) ", v, " (2) b"),
        say(q, ": (1) ", v, " (1) b"),
        say(q, ": (1) ", v, " (3) b"),
        say(q, ": (1) <b>", v, "</b> (2) b"),
        say(q, ": (1) $", v, " (2) b"),
        say(q, ": (1) ", v, " (3) c (2) b"),
        say(q, "\n(1) ", v, "\n(2) b\n(3) c"),
        say("Note ", key, ": (1) ", v, " (2) b"),
    )
    found = normalize.recognize_options(df.select("p_partkey", text.alias("content")))
    g = F.col("option_group")
    labels = F.array_join(F.transform(g["options"], lambda o: F.substring(o["label"], 2, 1)), ",")
    return found.select("p_partkey", labels.alias("labels"), g["question"].alias("question"), F.get(g["options"], F.lit(0))["content"].alias("first"))


@query("""SELECT p_partkey AS doc_id, o.ord, CASE WHEN o.ord = 1 AND p_partkey % 3 <> 0 THEN 2 ELSE -1 END AS options FROM part, (VALUES (0), (1), (2)) o(ord)""")
def normalize_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    lines = F.array(F.when(key % 3 == 0, say("Note ", key, ":")).otherwise(say("Q", key, ". Pick one")), say("(1) v", size, " (2) w"), say("(1) later (2) text"))
    elements = df.select(key.alias("doc_id"), F.lit(1).alias("page_no"), F.posexplode(lines).alias("ord", "content")).withColumns({"kind": F.lit("text"), "formula_placement": F.lit(None).cast("string")})
    return normalize.normalize_options(elements).select("doc_id", "ord", F.when(F.col("option_group").isNull(), -1).otherwise(F.size("option_group.options")).alias("options"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '1=a,2=v' || p_size WHEN 1 THEN '1=a,3=v' || p_size WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN '' ELSE '3=' || p_size END AS found FROM part""")
def parse_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = by(key % 6, say("1. x (1) a (2) v", size), say("(1) a (3) v", size), say("(2) a (1) v", size), say("(1) a (5) v", size), say("(1) (2) v", size), say("(3)", size))
    found = normalize.parse_options(df.select("p_partkey", text.alias("content")), "content", "m")
    return found.select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"])), ",").alias("found"))


@query("""SELECT p_partkey, 'Q' || p_partkey || '. x (1) a (2) b' || CASE p_partkey % 5 WHEN 0 THEN chr(10) || chr(10) || '(3) v' || p_size || chr(10) || chr(10) || '(4) d' WHEN 1 THEN chr(10) || chr(10) || '(3) v' || p_size WHEN 2 THEN '' WHEN 3 THEN chr(10) || chr(10) || '(4) d' ELSE '' END AS merged FROM part""")
def merge_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    retry = by(key % 5, say("Q", key, ". x (1) z (3) v", size, " (4) d"), say("(3) v", size), say("Q", key + 1, ". x (3) v", size), say("(1) a (4) d"), say("(3) a (3) b"))
    rows = df.select("p_partkey", say("Q", key, ". x (1) a (2) b").alias("primary"), retry.alias("retry"))
    return recover.merge_missing(rows).select("p_partkey", "merged")


# --- tables ------------------------------------------------------------------

LINES = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def order_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table an order: flawed in a way by l_orderkey % 7 (5 and 6: not at all)."""
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    k = F.col("l_orderkey") % 7
    row = say("<tr><td>", F.col("l_partkey"), "</td><td>", F.col("l_returnflag"), "|", F.col("l_linestatus"), "_</td></tr>")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*LINES.split(", "), row.alias("row")))), lambda x: x["row"]), "")
    orders = rows.groupBy("l_orderkey").agg(body.alias("body"), F.count("*").alias("n"))
    head = by(k, '<tr><th colspan="2">part</th><th>flag</th></tr>', "<tr><th>part</th></tr>", "<tr><th><b>part</b></th><th>flag</th></tr>", "", "<caption>c</caption><tr><th>part</th><th>flag</th></tr>", "<tr><th>part</th><th>flag</th></tr>")
    return orders.select("l_orderkey", "n", say("<table>", head, "<tbody>", F.col("body"), "</tbody></table>").alias("html"))


@query("""SELECT l_orderkey, CASE l_orderkey % 7 WHEN 3 THEN count(*) WHEN 5 THEN count(*) + 1 WHEN 6 THEN count(*) + 1 ELSE -1 END::BIGINT AS n_rows,
  l_orderkey % 7 = 0 AS merged, l_orderkey % 7 <> 3 AS header FROM lineitem GROUP BY l_orderkey""")
def normalize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = order_tables(spark, sf_dir).withColumn("t", markup.table_content(F.col("html")))
    return t.select("l_orderkey", F.when(F.col("t.rows").isNull(), -1).otherwise(F.size("t.rows")).cast("long").alias("n_rows"), F.col("t.has_merged_cells").alias("merged"), F.col("t.has_header").alias("header"))


@query(f"""SELECT l_orderkey, CASE WHEN l_orderkey % 7 IN (3, 5, 6) THEN CASE WHEN l_orderkey % 7 = 3 THEN '|  |  |' ELSE '| part | flag |' END || chr(10) || '| --- | --- |' || chr(10) ||
  string_agg('| ' || l_partkey || ' | ' || l_returnflag || '\\|' || l_linestatus || '\\_ |', chr(10) ORDER BY {LINES})
  ELSE '<table>' || CASE l_orderkey % 7 WHEN 0 THEN '<tr><th colspan="2">part</th><th>flag</th></tr>' WHEN 1 THEN '<tr><th>part</th></tr>' WHEN 2 THEN '<tr><th><b>part</b></th><th>flag</th></tr>'
  ELSE '<caption>c</caption><tr><th>part</th><th>flag</th></tr>' END || '<tbody>' || string_agg('<tr><td>' || l_partkey || '</td><td>' || l_returnflag || '|' || l_linestatus || '_</td></tr>', '' ORDER BY {LINES}) || '</tbody></table>' END AS markdown
  FROM lineitem GROUP BY l_orderkey""")
def table_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = order_tables(spark, sf_dir).withColumn("t", markup.table_content(F.col("html")))
    return t.select("l_orderkey", export.table_markdown(F.col("t")).alias("markdown"))


def match_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match list of each region's first eight nations; numerals missing where n_nationkey % 5 = 0."""
    from pyspark.sql import Window as W

    nations = read(spark, sf_dir, "nation", "n_regionkey", "n_nationkey", "n_name").withColumn("i", F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_nationkey"))).where("i <= 8")
    letter = F.chr(F.lit(64) + F.col("i"))
    roman = F.get(F.array(*map(F.lit, markup.ROMANS)), F.col("i") - 1)
    row = say("<tr><td>(", letter, ") ", F.col("n_name"), "</td><td>", F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.concat(F.lit("("), roman, F.lit(") "))), "x</td></tr>")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", row.alias("row")))), lambda x: x["row"]), "")
    return nations.groupBy("n_regionkey").agg(body.alias("body")).select("n_regionkey", say("<table><tr><th>List-I</th><th>List - II</th></tr>", F.col("body"), "</table>").alias("html"))


FIRST_EIGHT = "(SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation)"


@query(f"""SELECT n_regionkey, string_agg(chr(64 + i::INT), '' ORDER BY i) AS letters, string_agg(CASE WHEN n_nationkey % 5 <> 0 THEN (['I','II','III','IV','V','VI','VII','VIII'])[i] END, ',' ORDER BY i) AS romans FROM {FIRST_EIGHT} WHERE i <= 8 GROUP BY n_regionkey""")
def match_list_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = match_lists(spark, sf_dir).withColumn("t", markup.list_labels(F.col("html")))
    joined = F.array_join("t.romans", ",")
    return t.select("n_regionkey", F.array_join("t.letters", "").alias("letters"), F.when(joined != "", joined).alias("romans"))


@query(f"SELECT n_regionkey, count_if(n_nationkey % 5 = 0) > 0 AS incomplete FROM {FIRST_EIGHT} WHERE i <= 8 GROUP BY n_regionkey")
def incomplete_match_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.labelled(match_lists(spark, sf_dir), "html").select("n_regionkey", "incomplete")


# --- exams -------------------------------------------------------------------


def exam_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    k, key, mark = F.col("o_orderkey") % 7, F.col("o_orderkey"), F.col("o_custkey") % 9 + 1
    head = F.when(k == 3, "<tr><th>a</th><th>b</th><th>c</th></tr>").otherwise("<tr><th>Q.No.</th><th>Questions</th><th>Marks</th></tr>")
    long = say("State the value of item ", key, " (A) w (B) x (C) y (D) z")
    first = say('<tr><td>1.</td><td>', F.when(k == 2, say("Too short ", key)).when(k == 5, say("State the value of item ", key, " (A) w (B) x (C) y")).when(k == 6, say("State the value of item ", key, " <i>now</i>")).otherwise(long), "</td><td>", mark, "</td></tr>")
    second = say("<tr><td", F.when(k == 4, ' rowspan="2"').otherwise(""), ">", F.when(k == 1, "1.").otherwise("2."), "</td><td>Give five words about order ", key, "</td><td>2</td></tr>")
    # The fixture is one split; its rows are small, and reading them as HTML isn't.
    return o.select("o_orderkey", k.alias("k"), say("<table>", head, first, second, "</table>").alias("html")).repartition(spark.sparkContext.defaultParallelism, "o_orderkey")


@query("""SELECT o_orderkey, o_orderkey % 7 IN (0, 5) AS converted, CASE WHEN o_orderkey % 7 IN (0, 5) THEN '**1.** State the value of item ' || o_orderkey || CASE WHEN o_orderkey % 7 = 0 THEN chr(10) || chr(10) || '(A) w' || chr(10) || chr(10) || '(B) x' || chr(10) || chr(10) || '(C) y' || chr(10) || chr(10) || '(D) z' ELSE ' (A) w (B) x (C) y' END
  || chr(10) || chr(10) || 'Marks: ' || (o_custkey % 9 + 1) || chr(10) || chr(10) || '**2.** Give five words about order ' || o_orderkey || chr(10) || chr(10) || 'Marks: 2' END AS markdown,
  CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 5 THEN 'Question 1.: Ambiguous or incomplete answer group; option spacing unchanged.' END AS warnings, CASE WHEN o_orderkey % 7 IN (0, 5) THEN 0 ELSE -1 END AS repairs FROM orders""")
def question_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = exam_tables(spark, sf_dir).withColumn("t", export.exam_layout(F.col("html")))
    return t.select("o_orderkey", F.col("t").isNotNull().alias("converted"), F.col("t.markdown").alias("markdown"), F.array_join("t.warnings", ";").alias("warnings"), F.coalesce(F.size("t.repairs"), F.lit(-1)).alias("repairs"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Item ' || p_size || chr(10) || chr(10) || '(A) w' || chr(10) || chr(10) || '(C) x' || chr(10) || chr(10) || '(B) y' || chr(10) || chr(10) || '(D) z'
  WHEN 1 THEN 'Item ' || p_size || ' (A) w (B) x' WHEN 2 THEN 'Item ' || p_size || ' (A) w (B) x (C) y' WHEN 3 THEN 'Item $' || p_size ELSE 'Item ' || p_size || chr(10) || chr(10) || 'Next' END AS markdown,
  CASE WHEN p_partkey % 5 IN (2, 3) THEN 1 ELSE 0 END AS warnings FROM part""")
def format_question_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = by(key % 5, say("Item ", size, " (A) w (C) x (B) y (D) z"), say("Item ", size, " (A) w (B) x"), say("Item ", size, " (A) w (B) x (C) y"), say("Item $", size), say("Item ", size, "\\nNext"))
    t = df.select("p_partkey", exams.formatted_question(text).alias("t"))
    return t.select("p_partkey", F.col("t.markdown").alias("markdown"), F.size("t.warnings").alias("warnings"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Find (A) $a=1$ (C) $f(x)=(' || p_size || ')$ (D) $b=2$ (B) q' ELSE 'Find (A) $a=1$ (C) $f(x)=(' || p_size || ')(D)$ ' || CASE p_partkey % 3 WHEN 1 THEN 'b' ELSE '$b$' END || ' (B) q' END AS text,
  CASE WHEN p_partkey % 3 = 0 THEN 'Moved option (D) outside the preceding math delimiter; verify against source.' ELSE '' END AS repairs FROM part""")
def option_boundary_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = say("Find (A) $a=1$ (C) $f(x)=(", size, ")(D)$ ", by(key % 3, "$b=2$", "b", "$b$"), " (B) q")
    t = df.select("p_partkey", exams.repaired_boundary(text).alias("t"))
    return t.select("p_partkey", F.col("t.text").alias("text"), F.array_join("t.repairs", ";").alias("repairs"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'ABD' WHEN 1 THEN 'AC' ELSE '' END AS labels FROM part")
def choice_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = by(key % 3, say("x (A) 1 (B) 2 Reason (C) and (D) ", size), say("(A) ", size, " (B): 3 (C) 4"), say("(E) (a) ", size))
    found = column(lambda t: "".join(m[1] for m in exams.choices(t)), "string")
    return df.select("p_partkey", found(text).alias("labels"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'a' || p_size || chr(10) || chr(10) || 'b' WHEN 1 THEN 'x < ' || p_size WHEN 2 THEN NULL ELSE 'i' || chr(10) || chr(10) || '<img src="' || p_size || '">' || chr(10) || chr(10) || 'j' END AS text FROM part""")
def cell_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    return df.select("p_partkey", exams.plain_cell(by(key % 4, say("a", size, "<br/>b"), say("x &lt; ", size), say("<i>", size, "</i>"), say('i<img src="', size, '">j'))).alias("text"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 3 THEN 'a|b|c' ELSE 'Q.No.|Questions|Marks' END || ';1.|' || CASE o_orderkey % 7 WHEN 2 THEN 'Too short ' || o_orderkey WHEN 5 THEN 'State the value of item ' || o_orderkey || ' (A) w (B) x (C) y' WHEN 6 THEN 'State the value of item ' || o_orderkey || ' <i>now</i>' ELSE 'State the value of item ' || o_orderkey || ' (A) w (B) x (C) y (D) z' END
  || '|' || (o_custkey % 9 + 1) || ';' || CASE WHEN o_orderkey % 7 = 4 THEN '2' ELSE '' END || CASE WHEN o_orderkey % 7 = 1 THEN '1.' ELSE '2.' END || '|Give five words about order ' || o_orderkey || '|2' AS rows FROM orders""")
def exam_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = column(lambda h: None if (rows := markup.exam_rows(h)) is None else ";".join("|".join((str(c.rowspan) if c.rowspan > 1 else "") + c.content for c in row) for row in rows), "string")
    return exam_tables(spark, sf_dir).select("o_orderkey", shown(F.col("html")).alias("rows"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a <img src=\"images/' || p_size || '.png\" alt=\"x &amp; y\"> <b>b</b>' ELSE 'a <img src=\"other\" hidden> <b>b</b>' END AS html FROM part")
def rewrite_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    html = F.when(key % 2 == 0, say("a <img src='p", size, "' alt=\"x &amp; y\"\"/> <b>b</b>")).otherwise('a <IMG src=other hidden> <b>b</b>')
    targets = F.create_map(say("p", size), say("images/", size, ".png"))
    return df.select("p_partkey", markup.with_sources(html, targets).alias("html"))


# --- repeated phrases ----------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 3) OR 8 + p_partkey % 8 < 12 THEN NULL WHEN p_partkey % 5 = 4 THEN 'confidential' ELSE 'sample text' END AS phrase,
  CASE WHEN p_partkey % 5 IN (0, 3) OR 8 + p_partkey % 8 < 12 THEN -1 ELSE 8 + p_partkey % 8 END::BIGINT AS repetitions FROM part""")
def repeated_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, _ = parts(spark, sf_dir)
    times = (key % 8 + 8).cast("int")
    content = by(key % 5, F.concat(F.repeat(F.lit("Sample Text "), times), F.lit("end")), F.repeat(F.lit("Sample Text "), times), F.repeat(F.lit("SAMPLE\ntext\n"), times), F.repeat(F.lit("Page 7 "), times), F.repeat(F.lit("Confidential "), times))
    found = watermark.repeated_phrase(df.select("p_partkey", F.lit("text").alias("kind"), content.alias("content")))
    return found.select("p_partkey", "phrase", F.coalesce("repetitions", F.lit(-1).cast("long")).alias("repetitions"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'sample copy' END AS phrase, CASE WHEN p_partkey % 3 = 0 THEN 12 + p_partkey % 2 * 3 ELSE -1 END::BIGINT AS repetitions FROM part""")
def cell_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    cells = lambda word: F.repeat(F.concat(F.lit("<tr>"), F.repeat(F.concat(F.lit("<td>"), word, F.lit("</td>")), 3), F.lit("</tr>")), (4 + key % 2).cast("int"))
    body = by(key % 3, cells(F.lit("Sample  Copy")), F.concat(cells(F.lit("Sample Copy")), F.lit("<tr><td>Other</td><td></td><td></td></tr>")), cells(say("Item ", size)))
    found = watermark.repeated_phrase(df.select("p_partkey", F.lit("table").alias("kind"), say("<table>", body, "</table>").alias("content")))
    return found.select("p_partkey", "phrase", F.coalesce("repetitions", F.lit(-1).cast("long")).alias("repetitions"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'sample copy' WHEN 4 THEN 'strasse' END AS phrase FROM part")
def phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    text = by(key % 5, "Sample  COPY ", say("item ", size), "abc", "one two three four five", "Straße")
    return df.select("p_partkey", watermark.phrase(watermark.words(watermark.fold(text))).alias("phrase"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '12.5s' WHEN 1 THEN '2m 0' || (p_size % 10) || 's' ELSE '0.0s' END AS shown FROM part""")
def format_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    s = by(key % 3, F.lit(12.5), (F.lit(120.0) + size % 10 + 0.9), F.lit(0.0))
    return df.select("p_partkey", config.shown_duration(s).alias("shown"))


for old, new in (("mask_math_query", "mask_math"), ("visible_prose_query", "visible_prose"), ("escape_cell_query", "escape_cell")):
    QUERIES[new], SQL[new] = QUERIES.pop(old), SQL.pop(old)
