"""Queries over encoded blocks: geometry, recovery, evidence, export, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from ..operators import export, images, normalize, qa, recover, watermark
from ..schema import BBOX, OPTION_GROUP, TABLE
from ..sources import inputs, sinks
from .text_queries import LINES, by, parts, read, say

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with seq, their place in the order (a page holds three)."""
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", *LINES.split(", "), "l_returnflag", "l_linestatus")
    return rows.withColumn("seq", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINES.split(", "))) - 1)


SEQ = f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINES}) - 1 AS seq FROM lineitem)"


def place(df: DataFrame) -> list:
    return [F.col("l_orderkey").alias("doc_id"), (F.floor(F.col("seq") / 3) + 1).cast("int").alias("page_no"), F.col("seq").cast("int").alias("ord")]


def box(l, t, r, b):
    return F.struct(*[(F.lit(float(v)) if isinstance(v, (int, float)) else v.cast("double")).alias(n) for n, v in zip("ltrb", (l, t, r, b))])


# --- adaptation --------------------------------------------------------------

#: Blocks side by side on lines of two: 40 wide, 20 high, gaps of 10 times l_suppkey % 7.
GEOMETRY = "SELECT l_orderkey, seq, l_partkey % 3 AS k, (seq % 2) * (40 + l_suppkey % 7 * 10) AS l, seq // 2 * 30 + CASE WHEN l_partkey % 5 = 0 THEN 5 ELSE 0 END AS t FROM " + SEQ


def laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = (F.col("seq") % 2) * (40 + F.col("l_suppkey") % 7 * 10)
    top = F.floor(F.col("seq") / 2) * 30 + F.when(F.col("l_partkey") % 5 == 0, 5).otherwise(0)
    kind = by(F.col("l_partkey") % 3, "formula", "text", "formula")
    rows = numbered_lines(spark, sf_dir)
    return rows.select(*place(rows), kind.alias("kind"), box(left, top, left + 40, top + 20).alias("bbox"), say("c", F.col("l_partkey")).alias("content"))


@query(f"""WITH g AS ({GEOMETRY}), n AS (SELECT *, lag(k) OVER w AS k1, lag(l) OVER w AS l1, lag(t) OVER w AS t1, lead(k) OVER w AS k2, lead(l) OVER w AS l2, lead(t) OVER w AS t2 FROM g WINDOW w AS (PARTITION BY l_orderkey, seq // 3 ORDER BY seq))
SELECT l_orderkey AS doc_id, seq::INT AS ord, CASE WHEN (k1 = 1 AND 20 - abs(t - t1) >= 16 AND greatest(l1 - l - 40, l - l1 - 40) BETWEEN 0 AND 40) OR (k2 = 1 AND 20 - abs(t - t2) >= 16 AND greatest(l2 - l - 40, l - l2 - 40) BETWEEN 0 AND 40) THEN 'inline' ELSE 'display' END AS placement FROM n WHERE k <> 1""")
def formula_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = normalize.formula_placement(laid_out(spark, sf_dir)).where("kind = 'formula'")
    return placed.select("doc_id", "ord", F.col("formula_placement").alias("placement"))


def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw blocks: seven labels by l_partkey; every fifth page has no index of its own."""
    rows = numbered_lines(spark, sf_dir)
    page = F.floor(F.col("seq") / 3).cast("int")
    label = by(F.col("l_partkey") % 7, "text", "doc_title", "paragraph_title", "display_formula", "table", "image", "footer")
    content = by(F.col("l_partkey") % 7, say("t", F.col("l_suppkey")), say("d", F.col("l_suppkey")), say("p", F.col("l_suppkey")), say("$$ x", F.col("l_suppkey"), " $$"), say("<table><tr><td>", F.col("l_suppkey"), "</td></tr></table>"), "", say("f", F.col("l_suppkey")))
    pixels = F.when((F.col("l_partkey") % 7 == 5) & (F.col("l_suppkey") % 4 != 0), F.encode(say("png", F.col("l_partkey")), "utf-8"))
    level = F.when(F.col("l_suppkey") % 2 == 0, (F.col("l_suppkey") % 8).cast("int"))
    return rows.select(F.col("l_orderkey").alias("doc_id"), page.alias("page_pos"), F.when(F.col("l_orderkey") % 5 != 0, page).alias("page_index"), F.col("seq").cast("int").alias("ord"), label.alias("label"), content.alias("content"), F.array(*[F.lit(float(i)) for i in range(4)]).alias("bbox"), pixels.alias("image"), level.alias("title_level"))


@query(f"""SELECT l_orderkey AS doc_id, (seq // 3 + 1)::INT AS page_no, seq::INT AS ord, CASE l_partkey % 7 WHEN 0 THEN 'text' WHEN 1 THEN 'doc_title' WHEN 2 THEN 'paragraph_title' WHEN 3 THEN 'display_formula' WHEN 4 THEN 'table' WHEN 5 THEN 'image' ELSE 'footer' END AS kind,
  CASE l_partkey % 7 WHEN 0 THEN 't' || l_suppkey WHEN 1 THEN '# d' || l_suppkey WHEN 2 THEN repeat('#', least(6, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 8 + 1 ELSE 2 END)) || ' p' || l_suppkey WHEN 3 THEN 'x' || l_suppkey WHEN 4 THEN '<table><tr><td>' || l_suppkey || '</td></tr></table>' WHEN 5 THEN '' ELSE 'f' || l_suppkey END AS content,
  CASE WHEN l_partkey % 7 = 3 THEN 'display' END AS formula_placement, CASE WHEN l_partkey % 7 = 4 THEN l_suppkey::VARCHAR END AS first_cell,
  CASE WHEN l_partkey % 7 = 5 AND l_suppkey % 4 = 0 THEN 'image without pixels on page ' || (seq // 3 + 1) END AS error FROM {SEQ}""")
def adapt_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = normalize.adapt(raw_blocks(spark, sf_dir))
    return e.select("doc_id", "page_no", "ord", "kind", "content", "formula_placement", F.get(F.get("table.rows", F.lit(0)), F.lit(0)).alias("first_cell"), "error")


@query(f"""SELECT l_orderkey AS doc_id, string_agg('image without pixels on page ' || (seq // 3 + 1), ';' ORDER BY seq) AS errors FROM {SEQ} WHERE l_partkey % 7 = 5 AND l_suppkey % 4 = 0 GROUP BY l_orderkey""")
def image_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.failures(normalize.adapt(raw_blocks(spark, sf_dir))).select("doc_id", F.array_join("errors", ";").alias("errors"))


@query(f"""SELECT l_orderkey AS doc_id, seq::INT AS ord, CASE l_partkey % 7 WHEN 0 THEN 'text' WHEN 1 THEN 'doc_title' WHEN 2 THEN 'paragraph_title' WHEN 3 THEN 'display_formula' WHEN 4 THEN 'table' ELSE 'image' END AS kind FROM {SEQ} WHERE l_partkey % 7 <> 6""")
def ignored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.markdown_elements(normalize.adapt(raw_blocks(spark, sf_dir))).select("doc_id", "ord", "kind")


@query("""SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 8 = 5 THEN 1 ELSE p_partkey % 4 + 1 END::INT AS page_no,
  CASE p_partkey % 8 WHEN 0 THEN '# x' || p_size WHEN 1 THEN repeat('#', p_size % 3 + 1) || ' x' || p_size WHEN 2 THEN '- x' || p_size WHEN 3 THEN '* x' || p_size WHEN 4 THEN 'x' || p_size WHEN 6 THEN '<table><tr><td>' || p_size || '</td></tr></table>' WHEN 7 THEN '' ELSE 'x' || p_size END AS content,
  CASE WHEN p_partkey % 8 = 5 OR p_partkey % 4 = 3 THEN NULL ELSE 800 - p_size END::DOUBLE AS top, CASE WHEN p_partkey % 8 = 5 OR p_partkey % 4 = 3 THEN NULL ELSE 800 END::DOUBLE AS bottom,
  CASE WHEN p_partkey % 8 = 4 THEN 'display' END AS formula_placement, CASE WHEN p_partkey % 8 = 6 THEN p_size::VARCHAR END AS cell, CASE WHEN p_partkey % 8 = 7 AND p_size % 2 = 0 THEN 'P' || p_size END AS picture,
  CASE WHEN p_partkey % 8 = 7 AND p_size % 2 = 1 THEN 'picture without pixels' WHEN p_partkey % 8 <> 5 AND p_partkey % 4 = 3 THEN 'item on an unlisted page' END AS error FROM part""")
def adapt_alt_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    kind = by(key % 8, "title", "section_header", "list_item", "list_item", "formula", "text", "table", "image")
    text = by(key % 8, *[say("x", size)] * 4, say("$x", size, "$"), say("x", size), say("<table><tr><td>", size, "</td></tr></table>"), F.lit(""))
    page = F.when(key % 8 != 5, (key % 4 + 1).cast("int"))
    png = F.when((key % 8 == 7) & (size % 2 == 0), F.encode(say("P", size), "utf-8"))
    items = df.select(key.alias("doc_id"), F.lit(0).alias("seq"), page.alias("page_no"), kind.alias("kind"), text.alias("text"), F.when(key % 8 == 1, size % 3 + 1).alias("level"), F.when(key % 8 == 3, "*").otherwise("").alias("marker"), box(0, size, 10, 0).alias("bbox"), png.alias("png"))
    pages = df.select(key.alias("doc_id"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("page_no"), F.lit(800.0).alias("height"))
    found = normalize.adapt_alternative(items, pages)
    return found.select("doc_id", "page_no", "content", F.col("bbox.t").alias("top"), F.col("bbox.b").alias("bottom"), "formula_placement", F.get(F.get("table.rows", F.lit(0)), F.lit(0)).alias("cell"), F.decode("image_png", "utf-8").alias("picture"), "error")


@query("SELECT o_orderkey AS doc_id, p::INT AS page_no, count(seq)::BIGINT AS elements, coalesce(min(seq), -1)::INT AS first_ord FROM orders, range(1, 5) r(p) LEFT JOIN " + SEQ + " ON l_orderkey = o_orderkey AND seq // 3 + 1 = p GROUP BY ALL")
def pages_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("doc_id"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("page_no"))
    return normalize.with_pages(pages, normalize.adapt(raw_blocks(spark, sf_dir))).withColumn("first_ord", F.coalesce("first_ord", F.lit(-1)))


# --- recovery ----------------------------------------------------------------

BELOW = f"""WITH b AS (SELECT l_orderkey, seq, seq // 3 AS page, l_partkey % 90 AS l, l_partkey % 90 + 30 AS r, l_suppkey * 37 % 50 AS t, l_suppkey * 37 % 50 + 20 AS bt FROM {SEQ}),
n AS (SELECT a.*, (SELECT min(o.t) FROM b o WHERE o.l_orderkey = a.l_orderkey AND o.page = a.page AND o.seq <> a.seq AND o.t > a.t AND least(a.r, o.r) > greatest(a.l, o.l)) AS next_top FROM b a)"""


def scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_lines(spark, sf_dir)
    l, t = F.col("l_partkey") % 90, F.col("l_suppkey") * 37 % 50
    return rows.select(*place(rows), F.lit("text").alias("kind"), box(l, t, l + 30, t + 20).alias("bbox"), F.when(F.col("l_partkey") % 2 == 0, say("Q", F.col("l_partkey"), ". x (1) a (2) b")).otherwise(say("Q", F.col("l_partkey"), ". x (1) a (2) b (3) c (4) d")).alias("content"))


@query(BELOW + " SELECT l_orderkey AS doc_id, seq::INT AS ord, next_top::DOUBLE AS next_top FROM n")
def next_block_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recover.next_block_below(scattered(spark, sf_dir)).select("doc_id", "ord", "next_top")


def page_sizes(blocks: DataFrame) -> DataFrame:
    return blocks.select("doc_id", "page_no").distinct().withColumns({"width": F.lit(100), "height": F.lit(60)})


CROP = "next_top - 2 > bt AND least(100, r) > greatest(0, l) AND least(60, next_top - 2) > bt"


@query(BELOW + f" SELECT l_orderkey AS doc_id, seq::INT AS ord, l::INT AS crop_l, t::INT AS crop_t, least(100, r)::INT AS crop_r, least(60, next_top - 2)::INT AS crop_b FROM n WHERE {CROP}")
def mcq_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = scattered(spark, sf_dir)
    c = recover.crops(recover.next_block_below(blocks).where("next_top - 2 > bbox.b"), page_sizes(blocks), 2)
    return c.select("doc_id", "ord", *[F.col(f"crop.{n}").alias(f"crop_{n}") for n in "ltrb"])


@query(BELOW.replace("l_partkey % 90 AS l,", "l_partkey, l_partkey % 90 AS l,") + f" SELECT l_orderkey AS doc_id, seq::INT AS ord FROM n WHERE {CROP} AND l_partkey % 2 = 0")
def mcq_retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = scattered(spark, sf_dir)
    return recover.mcq_candidates(blocks, page_sizes(blocks), 2).select("doc_id", "ord")


@query("""SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 4 = 0 THEN 'retry 2' WHEN p_partkey % 4 = 1 THEN 'retry 1' ELSE 'primary' END AS used FROM part""")
def table_retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, _ = parts(spark, sf_dir)
    html = lambda tag, romans: F.concat(F.lit(f"<table><tr><th>List-I</th><th>List-II</th></tr><tr><td>(A) {tag}</td><td>"), romans[0], F.lit("x</td></tr><tr><td>(B) y</td><td>"), romans[1], F.lit("z</td></tr></table>"))
    full, none = (F.lit("(I) "), F.lit("(II) ")), (F.lit(""), F.lit("(II) "))
    keys = [key.alias("doc_id"), F.lit(1).alias("page_no"), F.lit(0).alias("ord")]
    blocks = df.select(*keys, F.lit("table").alias("kind"), html("primary", none).alias("content"), box(10, 20, 190, 150).alias("bbox"))
    first = F.when(key % 4 == 1, html("retry 1", full)).otherwise(html("retry 1", none))
    second = F.when(key % 4 < 2, html("retry 2", full)).otherwise(html("retry 2", none))
    tries = df.select(*keys, F.array(F.lit("A"), F.lit("B")).alias("letters"), F.posexplode(F.array(first, second)).alias("attempt", "content"))
    pages = blocks.select("doc_id", "page_no").withColumns({"width": F.lit(200), "height": F.lit(200)})
    wanted = recover.table_candidates(blocks, pages).select("doc_id", "page_no", "ord")
    out = recover.replace_tables(blocks, tries.join(wanted, ["doc_id", "page_no", "ord"], "left_semi"))
    return out.select("doc_id", F.regexp_extract("content", r"\(A\) (primary|retry \d)", 1).alias("used"))


# --- repeated background text --------------------------------------------------


def suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    b = F.array(F.lit(0.0), F.lit(0.0), F.when(key % 13 == 0, 900.0).otherwise(100.0), F.when(key % 17 == 0, float("nan")).otherwise(20.0))
    return df.select(key.alias("doc_id"), F.lit(0).alias("page_pos"), F.lit(None).cast("int").alias("page_index"), F.lit(0).alias("ord"), F.lit("text").alias("label"), F.repeat(F.lit("Sample Text "), (key % 8 + 8).cast("int")).alias("content"), b.alias("bbox"), F.when(key % 19 == 0, F.lit(b"x")).alias("image"), F.lit(None).cast("int").alias("title_level"))


CANDIDATE = "p_partkey % 8 >= 4 AND p_partkey % 19 <> 0"


@query(f"SELECT p_partkey AS doc_id, 1 AS page, (8 + p_partkey % 8)::BIGINT AS repetitions, p_partkey % 17 <> 0 AS placed FROM part WHERE {CANDIDATE}")
def watermark_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.candidates(suspects(spark, sf_dir)).select("doc_id", "page", "repetitions", F.col("bbox").isNotNull().alias("placed"))


def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, _ = parts(spark, sf_dir)
    return df.select(key.alias("doc_id"), F.lit(0).alias("page_index"), F.lit(600).alias("px_w"), F.when(key % 11 == 0, 700).otherwise(800).alias("px_h"), F.lit(300.0).alias("pt_w"), F.lit(400.0).alias("pt_h"), F.when(key % 23 == 0, 90).otherwise(0).alias("rotation"), F.lit(True).alias("full_bbox"))


@query("SELECT p_partkey AS doc_id, p_partkey % 11 <> 0 AND p_partkey % 23 <> 0 AS supported FROM part")
def page_geometry_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.page_gate(geometry(spark, sf_dir)).select("doc_id", "supported")


@query("SELECT p_partkey AS doc_id, greatest(0, p_size // 2 * 3 - 2)::INT AS l, greatest(0, p_size * 3 - 2)::INT AS t, least(768, p_size * 3 + 602)::INT AS r, least(1536, p_size * 3 + 1502)::INT AS b FROM part")
def watermark_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    r = watermark.region(box(F.floor(size / 2) * 2, size * 2, size * 2 + 400, size * 2 + 1000), F.lit(512), F.lit(1024), F.lit(768), F.lit(1536))
    return df.select(key.alias("doc_id"), *[r[n].alias(n) for n in "ltrb"])


REASON = """CASE WHEN p_partkey % 7 = 1 THEN 'preprocessing_changes_coordinates' WHEN p_partkey % 7 = 2 THEN 'unsupported_input' WHEN p_partkey % 7 = 3 THEN 'verification_failed'
  WHEN p_partkey % 11 = 0 OR p_partkey % 23 = 0 THEN 'unsupported_page_geometry' WHEN p_partkey % 5 = 0 THEN 'no_verified_tiled_background' WHEN p_partkey % 17 = 0 OR p_partkey % 13 = 0 THEN 'invalid_block_geometry'
  WHEN 200 + p_size < 220 THEN 'foreground_contrast' WHEN 200 + p_size >= 250 THEN 'no_visible_background_evidence' WHEN p_size % 3 = 0 THEN 'content_remains_without_background' ELSE 'repeated_pale_tiled_background_only' END"""


def decided(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    sources = df.select(key.alias("doc_id"), (key % 7 != 2).alias("is_pdf"), (key % 7 == 1).alias("transformed"), (key % 7 != 3).alias("readable"))
    tiled = df.where(key % 5 != 0).select(key.alias("doc_id"), F.lit(0).alias("page_index"))
    evidence = df.select(key.alias("doc_id"), F.lit(0).alias("page_index"), F.lit(0).alias("block_index"), (size + 200).cast("int").alias("darkest"), F.when(size % 3 == 0, 240).otherwise(255).alias("remaining"))
    return watermark.decided(watermark.candidates(suspects(spark, sf_dir)), sources, geometry(spark, sf_dir), tiled, evidence, mode)


@query(f"WITH d AS (SELECT *, {REASON} AS reason FROM part WHERE {CANDIDATE}) SELECT p_partkey AS doc_id, reason, CASE WHEN reason = 'repeated_pale_tiled_background_only' THEN 'would_exclude' ELSE 'kept' END AS decision FROM d")
def watermark_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir, "report").select("doc_id", "reason", "decision")


@query(f"SELECT p_partkey AS doc_id, 1::BIGINT AS blocks FROM part WHERE NOT ({CANDIDATE} AND {REASON} = 'repeated_pale_tiled_background_only')")
def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.without_excluded(suspects(spark, sf_dir), decided(spark, sf_dir, "filter")).groupBy("doc_id").agg(F.count("*").alias("blocks"))


@query(f"SELECT p_partkey AS doc_id, 1 AS version, {REASON} AS reason, 8 + p_partkey % 8 AS repetitions FROM part WHERE {CANDIDATE}")
def watermark_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = export.watermark_json(decided(spark, sf_dir, "report"), "report")
    get = lambda path: F.get_json_object("json", path)
    return j.select("doc_id", get("$.schema_version").cast("int").alias("version"), get("$.candidates[0].reason").alias("reason"), get("$.candidates[0].repetitions").cast("long").alias("repetitions"))


def tile_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of 20 parts as 4 x 5 tiles; one tile of every third group is off the grid."""
    df, key, _ = parts(spark, sf_dir)
    g, i = F.floor(key / 20).cast("long"), key % 20
    return df.select(g.alias("g"), i.alias("i"), ((i % 4) * 10 + F.when((g % 3 == 0) & (i == 7), 3).otherwise(0)).cast("double").alias("x"), (F.floor(i / 4) * 12 + F.when(i >= 12, 0.2).otherwise(0)).cast("double").alias("y"))


@query("SELECT p_partkey // 20 AS g, count(*)::BIGINT AS n, count(*) = 20 AND (p_partkey // 20) % 3 <> 0 AS regular FROM part GROUP BY p_partkey // 20")
def regular_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.regular_grid(tile_points(spark, sf_dir), ["g"])


def tile_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four corners of each tile; a corner of tile 3 is 0.3 off in every fourth group."""
    corners = F.array(*[F.struct(F.lit(n).alias("seg_no"), F.lit(t).alias("type"), F.lit(float(x)).alias("cx"), F.lit(float(y)).alias("cy"), F.lit(n == 3).alias("is_close")) for n, (t, x, y) in enumerate((("move", 0, 0), ("line", 6, 0), ("line", 6, 4), ("line", 0, 4)))])
    rows = tile_points(spark, sf_dir).withColumn("c", F.explode(corners))
    off = F.when((F.col("g") % 4 == 0) & (F.col("i") == 3) & (F.col("c.seg_no") == 2), 0.3).otherwise(0.0)
    return rows.select(F.col("g").alias("doc_id"), F.lit(0).alias("page_index"), F.lit(1).alias("form_no"), F.col("i").alias("path_no"), "c.seg_no", "c.type", (F.col("x") + F.col("c.cx") + off).alias("x"), (F.col("y") + F.col("c.cy")).alias("y"), "c.is_close")


FORM = ["doc_id", "page_index", "form_no"]


@query("SELECT p_partkey // 20 AS doc_id, p_partkey % 20 AS path_no, 4::BIGINT AS n_segments, CASE WHEN (p_partkey // 20) % 4 = 0 AND p_partkey % 20 = 3 THEN 63 ELSE 60 END::BIGINT AS dx10 FROM part")
def path_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = watermark.path_signatures(tile_segments(spark, sf_dir), FORM)
    return s.select("doc_id", "path_no", "n_segments", F.round(F.get("signature", F.lit(2))["dx"] * 10).cast("long").alias("dx10"))


@query("SELECT p_partkey // 20 AS doc_id, NOT ((p_partkey // 20) % 4 = 0 AND count_if(p_partkey % 20 = 3) > 0 AND count(*) > 1) AS agree FROM part GROUP BY p_partkey // 20")
def outline_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermark.outline_agreement(watermark.path_signatures(tile_segments(spark, sf_dir), FORM), FORM).select("doc_id", "agree")


@query("SELECT p_partkey // 20 AS doc_id FROM part GROUP BY p_partkey // 20 HAVING count(*) = 20 AND (p_partkey // 20) % 3 <> 0 AND (p_partkey // 20) % 4 <> 0")
def tiled_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = tile_points(spark, sf_dir)
    paths = points.select(F.col("g").alias("doc_id"), F.lit(0).alias("page_index"), F.lit(1).alias("form_no"), F.col("i").alias("path_no"), F.col("x").alias("l"), F.col("y").alias("b"), (F.col("x") + 6).alias("r"), (F.col("y") + 4).alias("t"))
    one = points.select(F.col("g").alias("doc_id")).distinct().withColumn("page_index", F.lit(0))
    forms = one.select("*", F.lit(1).alias("form_no"), *[F.lit(float(v)).alias(n) for n, v in zip("lbrt", (0, 0, 60, 60))], F.lit(0).alias("other_objects"))
    pages = one.withColumns({"pt_w": F.lit(100.0), "pt_h": F.lit(100.0)})
    return watermark.tiled_forms(pages, forms, paths, tile_segments(spark, sf_dir)).select("doc_id")


@query("SELECT p_partkey // 20 AS g, count(*)::BIGINT AS tiles, count(*) >= 12 AS enough FROM part GROUP BY p_partkey // 20")
def tile_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = watermark.regular_grid(tile_points(spark, sf_dir), ["g"])
    return grid.select("g", F.col("n").alias("tiles"), (F.col("n") >= watermark.MIN_REPEATS).alias("enough"))


# --- export --------------------------------------------------------------------


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: text, inline and display formulas, footers."""
    rows = numbered_lines(spark, sf_dir)
    k = F.col("l_partkey") % 6
    kind = by(k, "text", "inline_formula", "display_formula", "footer", "inline_formula", "text")
    content = by(k, say("w", F.col("l_partkey")), say("x_", F.col("l_suppkey")), say("y_", F.col("l_suppkey")), say("page ", F.col("seq")), say("z_", F.col("l_suppkey")), F.when(F.col("l_suppkey") % 9 == 0, " ").otherwise(say(", c", F.col("l_suppkey"))))
    placement = F.when(k.isin(1, 4), "inline").when(k == 2, "display")
    nulls = {"bbox": BBOX, "image_png": "binary", "table": TABLE, "option_group": OPTION_GROUP}
    return rows.select(*place(rows), kind.alias("kind"), content.alias("content"), placement.alias("formula_placement"), *[F.lit(None).cast(t).alias(n) for n, t in nulls.items()])


GLUED = f"""WITH e AS (SELECT l_orderkey, seq, seq // 3 AS page, l_partkey % 6 AS k, CASE l_partkey % 6 WHEN 0 THEN 'w' || l_partkey WHEN 1 THEN '$x_' || l_suppkey || '$' WHEN 2 THEN '$$' || chr(10) || 'y_' || l_suppkey || chr(10) || '$$' WHEN 4 THEN '$z_' || l_suppkey || '$' WHEN 5 THEN CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE ', c' || l_suppkey END END AS text FROM {SEQ}),
f AS (SELECT *, lag(k) OVER (PARTITION BY l_orderkey, page ORDER BY seq) AS p FROM e),
g AS (SELECT *, (k IN (1, 4) AND p IN (0, 1, 4, 5)) OR (k IN (0, 5) AND p IN (1, 4)) AS glue FROM f WHERE k <> 3 AND text <> '')"""


@query(GLUED + """ SELECT l_orderkey AS doc_id, string_agg(CASE WHEN rn = 1 THEN '' WHEN glue THEN CASE WHEN text LIKE ',%' THEN '' ELSE ' ' END ELSE chr(10) || chr(10) END || text, '' ORDER BY seq) || chr(10) AS markdown
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) AS rn FROM g) GROUP BY l_orderkey
UNION ALL SELECT DISTINCT l_orderkey, chr(10) FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM g)""")
def markdown_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.markdown(elements(spark, sf_dir))


@query(GLUED + """, s AS (SELECT *, sum(CASE WHEN glue AND rn > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY l_orderkey ORDER BY seq ROWS UNBOUNDED PRECEDING) AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) AS rn FROM g))
SELECT l_orderkey AS doc_id, n::INT AS section_no, count(*)::BIGINT AS members FROM s GROUP BY ALL""")
def inline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.islands(export.sections(elements(spark, sf_dir))).groupBy("doc_id", "section_no").agg(F.count("*").alias("members"))


@query(f"SELECT l_orderkey AS doc_id, seq::INT AS ord, CASE l_partkey % 6 WHEN 0 THEN 'w' || l_partkey WHEN 1 THEN '$x_' || l_suppkey || '$' WHEN 2 THEN '$$' || chr(10) || 'y_' || l_suppkey || chr(10) || '$$' WHEN 4 THEN '$z_' || l_suppkey || '$' ELSE ', c' || l_suppkey END AS text FROM {SEQ} WHERE l_partkey % 6 <> 3 AND NOT (l_partkey % 6 = 5 AND l_suppkey % 9 = 0)")
def render_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.sections(elements(spark, sf_dir)).select("doc_id", "ord", "text")


def pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents of pictures, tables with embedded images, and text."""
    rows = numbered_lines(spark, sf_dir)
    k = F.col("l_partkey") % 3
    html = say('<table><tr><td><img src="p', F.col("l_suppkey") % 4, '.png"></td></tr></table>')
    content = by(k, "", html, say("t", F.col("l_suppkey")))
    table = F.when(k == 1, F.struct(html.alias("html"), F.lit(False).alias("has_merged_cells"), F.lit(None).cast("array<array<string>>").alias("rows"), F.lit(False).alias("has_header")))
    return rows.select(*place(rows), by(k, "image", "table", "text").alias("kind"), content.alias("content"), F.lit(None).cast("string").alias("formula_placement"), F.lit(None).cast(BBOX).alias("bbox"), F.when(k == 0, F.encode(say("own", F.col("l_partkey")), "utf-8")).alias("image_png"), table.alias("table"), F.lit(None).cast(OPTION_GROUP).alias("option_group"))


IMAGES = f"""WITH u AS (SELECT l_orderkey, seq, l_partkey, CASE WHEN l_partkey % 3 = 1 THEN 'p' || l_suppkey % 4 || '.png' END AS path FROM {SEQ} WHERE l_partkey % 3 <> 2),
f AS (SELECT *, CASE WHEN path IS NULL THEN seq ELSE min(seq) OVER (PARTITION BY l_orderkey, path) END AS first FROM u),
n AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY first) - 1 AS no FROM f)"""


@query(IMAGES + " SELECT l_orderkey AS doc_id, seq::INT AS ord, no::INT AS image_no FROM n")
def artifact_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.number_images(export.image_uses(pictures(spark, sf_dir))).select("doc_id", "ord", "image_no")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels of images p0 to p2 of every order; p3 has none."""
    orders = read(spark, sf_dir, "lineitem", "l_orderkey").distinct()
    each = F.explode(F.array(*[F.lit(f"p{i}.png") for i in range(3)]))
    return orders.select(F.col("l_orderkey").alias("doc_id"), each.alias("path")).withColumn("png", F.encode(F.col("path"), "utf-8"))


@query(IMAGES + " SELECT DISTINCT l_orderkey AS doc_id, path, no::INT AS image_no, CASE WHEN path = 'p3.png' THEN 'Embedded image has no pixels: p3.png' END AS error FROM n WHERE path IS NOT NULL")
def resolve_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.resolve_images(export.number_images(export.image_uses(pictures(spark, sf_dir))), assets(spark, sf_dir)).select("doc_id", "path", "image_no", "error")


@query(IMAGES + " SELECT DISTINCT l_orderkey AS doc_id, 'img-' || no || '.png' AS name, coalesce(path, 'own' || l_partkey) AS pixels FROM n WHERE path IS NULL OR path <> 'p3.png'")
def image_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.image_artifacts(pictures(spark, sf_dir), assets(spark, sf_dir)).select("doc_id", "name", F.decode("png", "utf-8").alias("pixels"))


@query(IMAGES + """ SELECT l_orderkey AS doc_id, 'tbl-' || (row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) - 1) || '.html' AS name, '<table><tr><td><img src="../images/img-' || no || '.png"></td></tr></table>' AS html FROM n WHERE path IS NOT NULL""")
def table_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.table_artifacts(pictures(spark, sf_dir)).select("doc_id", "name", "html")


@query(IMAGES + f""", t AS (SELECT l_orderkey, seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) AS k FROM {SEQ} WHERE l_partkey % 3 = 1),
s AS (SELECT l.l_orderkey, l.seq, CASE l.l_partkey % 3 WHEN 0 THEN '![Image ' || (no + 1) || '](images/img-' || no || '.png)' WHEN 1 THEN '<table><tr><td><img src="images/img-' || no || '.png"></td></tr></table>' || chr(10) || chr(10) || '[Table ' || k || '](tables/tbl-' || (k - 1) || '.html)' ELSE 't' || l_suppkey END AS text
  FROM {SEQ} l LEFT JOIN n USING (l_orderkey, seq) LEFT JOIN t USING (l_orderkey, seq))
SELECT l_orderkey AS doc_id, string_agg(text, chr(10) || chr(10) ORDER BY seq) || chr(10) AS markdown FROM s GROUP BY l_orderkey""")
def illustrated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.markdown(pictures(spark, sf_dir))


@query("""SELECT p_partkey AS doc_id, '<img src="' || CASE p_partkey % 3 WHEN 0 THEN 'paddle-page-' || p_size % 3 || '/a' || p_size || '.png' WHEN 1 THEN 'paddle-page-9/a.png' ELSE 'http://x/a.png' END || '">' AS content FROM part""")
def qualify_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    page = (size % 3).cast("int").alias("page_pos")
    path = by(key % 3, say("a", size, ".png"), "paddle-page-9/a.png", "http://x/a.png")
    blocks = df.select(key.alias("doc_id"), page, say('<img src="', path, '">').alias("content"))
    known = df.where(key % 3 != 2).select(key.alias("doc_id"), page, path.alias("path"))
    return images.qualify_paths(blocks, known).select("doc_id", "content")


@query(f"SELECT l_orderkey AS doc_id, seq::INT AS \"order\", l_partkey % 7 <> 6 AS included_in_markdown, l_partkey % 7 = 5 AND l_suppkey % 4 <> 0 AS has_image, false AS has_merged_cells FROM {SEQ}")
def debug_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = normalize.adapt(raw_blocks(spark, sf_dir)).withColumn("option_group", F.lit(None).cast(OPTION_GROUP))
    return export.debug_elements(e, "primary").select("doc_id", "order", "included_in_markdown", "has_image", F.coalesce("has_merged_cells", F.lit(False)).alias("has_merged_cells"))


@query("SELECT o_orderkey AS doc_id, 'tbl-0.html' AS \"table\", o_orderkey % 7 IN (0, 5) AS converted, CASE WHEN o_orderkey % 7 = 5 THEN 'Question 1.: Ambiguous or incomplete answer group; option spacing unchanged.' ELSE '' END AS warnings FROM orders")
def question_layout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .text_queries import exam_tables

    html = exam_tables(spark, sf_dir)
    table = F.struct(F.col("html"), F.lit(False).alias("has_merged_cells"), F.lit(None).cast("array<array<string>>").alias("rows"), F.lit(False).alias("has_header"))
    e = html.select(F.col("o_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), F.lit(0).alias("ord"), F.lit("table").alias("kind"), F.col("html").alias("content"), table.alias("table"), F.lit(None).cast("binary").alias("image_png"))
    return export.layout_report(e).select("doc_id", "table", "converted", F.array_join("warnings", ";").alias("warnings"))


# --- files and checks ------------------------------------------------------------


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Unsupported file format: .exe' WHEN 2 THEN 'Unsupported file format: <none>' WHEN 3 THEN 'Input file does not exist: /in/d' || p_size || '.pdf' WHEN 4 THEN 'Input path is not a file: /in/d' || p_size || '.pdf' ELSE NULL END AS error FROM part""")
def validate_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    path = say("/in/d", size, by(key % 6, ".pdf", ".exe", "", ".pdf", ".pdf", ".JPG"))
    return inputs.validated(df.select("p_partkey", path.alias("path"), (key % 6 != 3).alias("exists"), (key % 6 != 4).alias("is_file"))).select("p_partkey", "error")


@query(f"""SELECT l_orderkey AS doc_id, CASE l_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN max(seq // 3) + 1 ELSE -1 END::INT AS pages FROM {SEQ} GROUP BY l_orderkey""")
def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_lines(spark, sf_dir)
    pages = rows.where("l_orderkey % 3 = 1").select(F.col("l_orderkey").alias("doc_id"), F.floor(F.col("seq") / 3).cast("int").alias("page_index"), F.lit(None).cast("int").alias("page_count"))
    files = rows.select(F.col("l_orderkey").alias("doc_id")).distinct().withColumn("path", F.when(F.col("doc_id") % 3 == 0, "/in/a.png").otherwise("/in/a.PDF"))
    return inputs.page_counts(pages, files).select("doc_id", F.coalesce("pages", F.lit(-1)).alias("pages"))


@query("SELECT p_partkey, '/out/d' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '.v1' ELSE '' END || '/document.md' AS document_path, '/out/d' || p_size || CASE WHEN p_partkey % 2 = 0 THEN '.v1' ELSE '' END || '/images' AS images_dir FROM part")
def bundle_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    b = sinks.bundle_paths(say("/in/d", size, F.when(key % 2 == 0, ".v1.pdf").otherwise(".pdf")), F.lit("/out"))
    return df.select("p_partkey", b["document_path"].alias("document_path"), b["images_dir"].alias("images_dir"))


@query("SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 4 = 0 THEN 'Output already exists: /out/' || p_partkey END AS error FROM part")
def refused_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, _ = parts(spark, sf_dir)
    root = say("/out/", key).alias("root_dir")
    return sinks.refused(df.select(key.alias("doc_id"), root), df.where(key % 4 == 0).select(root)).select("doc_id", "error")


def question_papers(spark: SparkSession, sf_dir: str):
    """part, its key, and a paper a part: without half of question 8 by p_partkey % 4."""
    df, key, _ = parts(spark, sf_dir)
    options = "(1) a (2) b (3) c (4) d"
    last = F.when(key % 4 == 1, "(1) a (2) b").otherwise("(1) a (2) b")
    rest = F.when(key % 4 == 0, "Q8: (3) c\n(4) d\n").when(key % 4 == 3, "Q8: (3) c\n(4) d\n").otherwise("")
    text = say(f"Q1. {options}\n# Q 2: 1600 to 1800\n## Q8. ", last, "\n", rest, f"Q15. {options}\n")
    return df, key, df.select(key.alias("doc_id"), text.alias("markdown"))


@query("""SELECT p_partkey AS doc_id, c."check", CASE c."check" WHEN 'Q8 options' THEN p_partkey % 4 IN (0, 3) ELSE c.holds END AS passed FROM part, (VALUES ('Q1 options', true), ('Q8 options', NULL), ('Q15 options', true), ('Q2 bounds', true), ('Q3 formula', false),
  ('Q4 pi/2', false), ('Q6 digit restriction', false), ('Q11 matrix', false), ('Q14 determinant', false), ('MathonGo occurrences', true), ('all', false)) c("check", holds)""")
def qa_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.checks(question_papers(spark, sf_dir)[2]).select("doc_id", "check", "passed")


@query("SELECT l_orderkey, array_to_string(list(DISTINCT l_suppkey ORDER BY l_suppkey), ',') AS numbers, bool_and(up) AS ascending FROM (SELECT *, coalesce(l_suppkey > lag(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY seq), true) AS up FROM " + SEQ + ") GROUP BY l_orderkey")
def monotonic_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = numbered_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("n"))
    ascending = normalize.ascending(F.col("n"))
    return rows.select("l_orderkey", F.array_join(F.array_sort(F.array_distinct("n")), ",").alias("numbers"), ascending.alias("ascending"))
