"""Queries over whole runs and their hooks: made-up engines, readers and renderings stand in for models."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import pixels, register
from ..functions.arrow import column, spread
from ..operators import export, recover, watermark
from ..sources import inputs, sinks
from . import run
from .config import Config
from .text_queries import by, parts, say

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# --- pixels --------------------------------------------------------------------

#: A page of 4 by 4 pixels a part: byte i is (p_partkey + i * p_size) % 256.
VALUE = "(p_partkey + ({}) * p_size) % 256"


def pages_of_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, key, size = parts(spark, sf_dir)
    value = lambda i: F.lpad(F.hex((key + i * size) % 256), 2, "0")
    box = F.struct((key % 3).cast("int").alias("l"), (key % 2).cast("int").alias("t"), F.lit(4).alias("r"), (2 + key % 3).cast("int").alias("b"))
    return df.select("p_partkey", F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(47)), value), "")).alias("pixels"), F.lit(4).alias("width"), F.lit(4).alias("height"), box.alias("box"))


_INSIDE = "range(p_partkey % 2, 2 + p_partkey % 3) ys(y), range(p_partkey % 3, 4) xs(x), range(0, 3) cs(c)"


@query(f"SELECT p_partkey, min({VALUE.format('(y * 4 + x) * 3 + c')})::INT AS darkest FROM part, {_INSIDE} GROUP BY p_partkey")
def darkest_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages_of_pixels(spark, sf_dir).select("p_partkey", pixels.darkest_channel("pixels", "width", "height", "box").alias("darkest"))


@query(f"SELECT p_partkey, (4 - p_partkey % 3) || 'x' || (2 + p_partkey % 3 - p_partkey % 2) || ':' || string_agg(lpad(lower(hex({VALUE.format('(y * 4 + x) * 3 + 2 - c')})), 2, '0'), '' ORDER BY y, x, c) AS crop FROM part, {_INSIDE} GROUP BY p_partkey, p_size")
def crop_png(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = column(lambda png: "{1}x{0}:".format(*(p := pixels.unpng(png)).shape) + p.tobytes().hex(), "string")
    return pages_of_pixels(spark, sf_dir).select("p_partkey", shown(pixels.crop_png("pixels", "width", "height", "box")).alias("crop"))


@query("""SELECT p_partkey AS doc_id, CASE p_partkey % 4 WHEN 0 THEN 'foreground_contrast' WHEN 1 THEN 'no_visible_background_evidence' WHEN 2 THEN 'content_remains_without_background' ELSE 'repeated_pale_tiled_background_only' END AS reason,
  CASE WHEN p_partkey % 4 = 3 THEN 'excluded' ELSE 'kept' END AS decision FROM part""")
def region_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renderings of 15 by 15 pixels, one value each, to verdicts on a block over the page's middle."""
    df, key, _ = parts(spark, sf_dir)
    page = df.select(key.alias("doc_id"), F.lit(0).alias("page_index"))
    even = lambda v: F.unhex(F.repeat(F.lpad(F.hex(v), 2, "0"), 675))
    renders = page.select("*", F.lit(15).alias("width"), F.lit(15).alias("height"), even(by(F.col("doc_id") % 4, F.lit(100), F.lit(255), F.lit(240), F.lit(230))).alias("original"), even(F.when(F.col("doc_id") % 4 == 2, 200).otherwise(255)).alias("foreground"))
    geometry = page.select("*", *[F.lit(v).alias(n) for n, v in (("px_w", 20), ("px_h", 20), ("pt_w", 10.0), ("pt_h", 10.0), ("rotation", 0), ("full_bbox", True))])
    blocks = page.select("doc_id", F.lit(0).alias("page_pos"), "page_index", F.lit(0).alias("ord"), F.lit("text").alias("label"), F.lit("sample copy " * 12).alias("content"), F.array(*[F.lit(float(v)) for v in (4, 4, 16, 16)]).alias("bbox"), F.lit(None).cast("binary").alias("image"), F.lit(None).cast("int").alias("title_level"))
    found = watermark.candidates(blocks)
    sources = page.select("doc_id", F.lit(True).alias("is_pdf"), F.lit(False).alias("transformed"), F.lit(True).alias("readable"))
    report = watermark.decided(found, sources, geometry, page, watermark.region_evidence(found, geometry, renders))
    return report.select("doc_id", "reason", "decision")


@query("SELECT p_partkey AS doc_id, 0 AS page_index FROM part WHERE p_partkey % 4 = 0")
def resource_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of 4 by 4 squares; too few paths, too many, or a path with too many segments reject the rest."""
    df, key, _ = parts(spark, sf_dir)
    page = df.select(key.alias("doc_id"), F.lit(0).alias("page_index"))
    n = by(F.col("doc_id") % 4, F.lit(16), F.lit(9), F.lit(1089), F.lit(16)).cast("int")
    side = F.sqrt(n).cast("int")
    forms = page.select("*", F.lit(0).alias("form_no"), *[F.lit(float(v)).alias(c) for c, v in zip("lbrt", (0, 0, 100, 100))], F.lit(0).alias("other_objects"))
    # Computed columns come from generators, not projections: only so do the operator's semi joins pass below the rows made here, and a rejected form's are never made.
    made = lambda df, *columns: df.select("*", F.inline(F.array(F.struct(*columns))))
    paths = page.select("*", F.lit(0).alias("form_no"), F.explode(F.sequence(F.lit(0), n - 1)).alias("path_no"))
    l, b = F.col("path_no") % side * 3.0, F.floor(F.col("path_no") / side) * 3.0
    paths = made(paths, l.alias("l"), b.alias("b"), (l + 2).alias("r"), (b + 2).alias("t"))
    many = F.when((F.col("doc_id") % 4 == 3) & (F.col("path_no") == 5), 4096).otherwise(3)
    segments = made(paths.select("*", F.explode(F.sequence(F.lit(0), many)).alias("seg_no")), F.lit(0).alias("type"), (F.col("l") + F.col("seg_no") % 2 * 2).alias("x"), F.col("b").alias("y"), F.lit(False).alias("is_close"))
    return watermark.tiled_forms(page.select("*", F.lit(100.0).alias("pt_w"), F.lit(100.0).alias("pt_h")), forms, paths, segments)


# --- second readings -------------------------------------------------------------


def crops_to_read(spark: SparkSession, sf_dir: str, label: str, content, below: int) -> tuple[DataFrame, DataFrame]:
    """(blocks, pixels): a block a part at the top of a page of 20 by 40, and another below it."""
    df, key, _ = parts(spark, sf_dir)
    place = lambda t, b: F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("ltrb", (1, t, 15, b))])
    page = lambda ord_, kind, text, box: df.select(key.alias("doc_id"), F.lit(1).alias("page_no"), F.lit(ord_).alias("ord"), F.lit(kind).alias("kind"), text.alias("content"), box.alias("bbox"))
    blocks = page(0, label, content, place(2, 6)).unionByName(page(1, "footer", F.lit("f"), place(below, below + 2)))
    return blocks, df.select(key.alias("doc_id"), F.lit(1).alias("page_no"), F.lit(20).alias("width"), F.lit(40).alias("height"), F.unhex(F.repeat(F.lpad(F.hex(key % 256), 2, "0"), 2400)).alias("pixels"))


@query("""SELECT p_partkey AS doc_id, 'Q1. x (1) a (2) b' || chr(10) || chr(10) || '(3) g' || (p_partkey % 256) || chr(10) || chr(10) || '(4) 14x20' AS content FROM part WHERE p_partkey % 256 % 5 <> 0""")
def mcq_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that tells a crop's grey and size as options 3 and 4, and fails on every fifth grey."""

    def make():
        def read(png: bytes, prompt: str) -> Iterator[dict]:
            picture = pixels.unpng(png)
            grey = int(picture[0, 0, 0])
            if grey % 5 == 0 or prompt != "ocr":
                raise RuntimeError("unreadable")
            yield {"label": "text", "content": "(1) a (2) b"}
            yield {"label": "text", "content": f"(3) g{grey}\n(4) {picture.shape[1]}x{picture.shape[0]}"}

        return read

    blocks, pages = crops_to_read(spark, sf_dir, "text", F.lit("Q1. x (1) a (2) b"), 30)
    return recover.retried_options(blocks, pages, make).select("doc_id", "content")


_LIST = "<table><tr><td>List I</td><td>List II</td></tr><tr><td>(A) x</td><td>{}</td></tr><tr><td>(B) y</td><td>{}</td></tr></table>"


@query(f"""SELECT p_partkey AS doc_id, '{_LIST.format("(I) 20x15", "(II)")}' AS content FROM part WHERE p_partkey % 256 % 3 = 0""")
def table_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader whose second table is complete at every third grey; incomplete readings and other letters change nothing."""

    def make():
        def read(png: bytes, prompt: str) -> Iterator[dict]:
            picture = pixels.unpng(png)
            size = f"{picture.shape[1]}x{picture.shape[0]}"
            yield {"label": "text", "content": _LIST.format("(I)", "(II)")}
            yield {"label": "table", "content": _LIST.format("(I)", "")}
            yield {"label": "table", "content": _LIST.format(f"(I) {size}", "(II)" if picture[0, 0, 0] % 3 == 0 else "(III)")}

        return read

    blocks, pages = crops_to_read(spark, sf_dir, "table", F.lit(_LIST.format("", "")), 30)
    return recover.retried_tables(blocks, pages, make, 1 + recover.MARGIN).select("doc_id", "content")


# --- whole runs ------------------------------------------------------------------

KINDS = "p_partkey % 7"


def made_up_engine():
    """Documents by their first character: what the run makes of each is the query's SQL."""

    def read(path: str, content: bytes) -> Iterator[dict]:
        kind, name = content[:1], content[1:].decode()
        if kind == b"1":
            raise RuntimeError(f"cannot read {name}")
        if kind == b"2":
            return
        block = lambda ord_, label, text, **more: {"page_pos": 0, "ord": ord_, "label": label, "content": text, "bbox": [1.0, 2.0 + 6 * ord_, 15.0, 6.0 + 6 * ord_], **more}
        yield {"row": "page", "page_pos": 0, "width": 20, "height": 40, "pixels": b"\x07" * 2400}
        yield block(0, "doc_title", f"T{name}")
        if kind == b"3":
            yield block(1, "text", "Q1. x: (1) a (2) b")
            yield block(4, "footer", "f")
        elif kind == b"4":
            yield block(1, "text", "sample copy " * 12)
            yield block(2, "text", None)
        elif kind == b"5":
            yield block(1, "text", '<img src="a.png">')
            yield block(2, "chart", "", image=b"P")
            yield {"row": "asset", "page_pos": 0, "path": "a.png", "png": b"A"}
        elif kind == b"6":
            yield block(1, "text", '<img src="lost.png">')

    return read


def second_reader():
    return lambda png, prompt: [{"label": "text", "content": "(3) c (4) d"}]


def inspector():
    def inspect(path: str, content: bytes, pages: list[int]) -> Iterator[dict]:
        for page in pages:
            yield {"row": "page", "page_index": page, "pt_w": 20.0, "pt_h": 40.0, "rotation": 0, "full_bbox": True}
            yield {"row": "form", "page_index": page, "form_no": 0, "l": 0.0, "b": 0.0, "r": 20.0, "t": 40.0, "other_objects": 0}
            for i in range(16):
                l, b = 1.0 + i % 4 * 4, 1.0 + i // 4 * 8
                yield {"row": "path", "page_index": page, "form_no": 0, "path_no": i, "l": l, "b": b, "r": l + 2, "t": b + 2}
                yield {"row": "segment", "page_index": page, "form_no": 0, "path_no": i, "seg_no": 0, "type": 0, "x": l, "y": b, "is_close": True}
            yield {"row": "render", "page_index": page, "width": 30, "height": 60, "original": b"\xf0" * 5400, "foreground": b"\xff" * 5400}

    return inspect


def processed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, run.Result]:
    """(files, raw, result) of a file a part; names end in .pdf, or .gif where p_partkey % 14 = 7."""
    df, key, _ = parts(spark, sf_dir)
    files = df.select(key.alias("doc_id"), say("/in/d", key, F.when(key % 14 == 7, ".gif").otherwise(".pdf")).alias("path"), F.encode(say((key % 7).cast("string"), key), "utf-8").alias("content"), F.lit(True).alias("exists"), F.lit(True).alias("is_file"))
    files = inputs.validated(files).select("doc_id", "path", F.when(F.col("error").isNull(), F.col("content")).alias("content"), "error")
    inputs.register_engine("made-up", made_up_engine)
    keep = run.Tables(spark)
    raw = keep(inputs.extract(spread(files), "made-up"), "raw")
    return files, raw, run.process(raw, files, Config(watermark_mode="filter"), keep, run.Hooks(second_reader, inspector))


_ERROR = f"""CASE WHEN p_partkey % 14 = 7 THEN 'Unsupported file format: .gif' WHEN {KINDS} = 1 THEN 'Extraction failed: cannot read ' || p_partkey WHEN {KINDS} = 2 THEN 'Extraction failed: The engine returned no pages'
  WHEN {KINDS} = 6 THEN 'Extraction failed: Embedded image has no pixels: lost.png' END"""


@query(f"SELECT p_partkey AS doc_id, {_ERROR} AS error FROM part WHERE {_ERROR} IS NOT NULL")
def run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir)[2].errors


@query(f"""SELECT p_partkey AS doc_id, '# T' || p_partkey || CASE {KINDS} WHEN 3 THEN chr(10) || chr(10) || 'Q1. x:' || chr(10) || chr(10) || '(1) a' || chr(10) || chr(10) || '(2) b' || chr(10) || chr(10) || '(3) c' || chr(10) || chr(10) || '(4) d'
  WHEN 5 THEN chr(10) || chr(10) || '<img src="images/img-0.png">' || chr(10) || chr(10) || '![Image 2](images/img-1.png)' ELSE '' END || chr(10) AS markdown FROM part WHERE {_ERROR} IS NULL""")
def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.markdown(processed(spark, sf_dir)[2].elements)


@query(f"SELECT p_partkey AS doc_id, 'excluded' AS decision, 'sample copy' AS phrase, 12::BIGINT AS repetitions FROM part WHERE {KINDS} = 4")
def run_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed(spark, sf_dir)[2].report.select("doc_id", "decision", "phrase", "repetitions")


@query(f"""WITH good AS (SELECT p_partkey, '/out/d' || p_partkey AS root FROM part WHERE {_ERROR} IS NULL)
SELECT root || '/document.md' AS path FROM good UNION ALL SELECT root || '/images/img-' || i || '.png' FROM good, range(2) r(i) WHERE {KINDS} = 5 UNION ALL SELECT root || '/debug/' || n || '.json' FROM good, (VALUES ('watermarks'), ('elements'), ('question-layout'), ('raw')) v(n)""")
def run_bundle_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, raw, result = processed(spark, sf_dir)
    placed = run.bundles(files.join(result.errors, "doc_id", "left_anti"), "/out", spark.createDataFrame([], "root_dir string")).where("error IS NULL")
    documents = placed.join(export.markdown(result.elements), "doc_id")
    whole = sinks.bundle_files(documents, export.table_artifacts(result.elements), export.image_artifacts(result.elements, result.assets)).select("path")
    reports = run.report_files(result, raw, files, documents, Config(watermark_mode="filter", debug=True)).join(placed, "doc_id")
    return whole.unionByName(reports.select(F.concat("root_dir", F.lit("/"), "name").alias("path")))


# --- SQL ---------------------------------------------------------------------------


@query("SELECT p_partkey, 'x $a$ y ' || p_size AS tidy, 'a\\|' || p_size AS cell, CASE WHEN p_size % 2 = 0 THEN 'b ' || p_size || '     c' END AS masked, '<table><tr><td>' || p_size || '</td></tr></table>' AS html FROM part")
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register.register(spark)
    parts(spark, sf_dir)[0].createOrReplaceTempView("folioflow_parts")
    return spark.sql("""SELECT p_partkey, normalize_inline_math(concat('x $ a $y ', p_size)) AS tidy, render_cell(concat('a|', p_size)) AS cell,
      mask_math(concat('b ', p_size, ' $', CASE WHEN p_size % 2 = 0 THEN 'z$' ELSE 'zz' END, ' c')) AS masked, normalize_table(concat('<table><tr><td>', p_size, '</td></tr></table>')).html AS html FROM folioflow_parts""")
