"""Repeated background text: candidates, evidence, decisions, removal.

Evidence (tiled forms, pixels) comes as tables, so a PDF library is needed only
where they are made: a hook (gather). Doubt always keeps content."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.arrow import column, frames, once, spread
from ..functions.markup import table_content
from ..functions.mathtext import WS
from ..functions.pixels import darkest_channel
from ..schema import EVIDENCE
from .normalize import valid_bbox

# Thresholds of the evidence.
MIN_REPEATS, MAX_WORDS = 12, 4
MIN_PHRASE, MAX_PHRASE = 4, 80
SCALE, MAX_PIXELS, EDGE = 1.5, 4_000_000, 2
DARK, BLANK = 220, 250
MAX_PATHS, MAX_SEGMENTS, MAX_PATH_SEGMENTS, MIN_AREA = 1024, 250_000, 4096, 0.25

_casefolded = column(str.casefold, "string")


def fold(text: Column) -> Column:
    """text case-folded; only texts beyond ASCII leave the JVM, whose lower case isn't Unicode's folding there."""
    wide = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_casefolded(F.when(wide, text)), F.lower(text))


def words(folded: Column) -> Column:
    return F.filter(F.split(folded, rf"(?U)[{WS}]+"), lambda w: w != "")


def phrase(of: Column) -> Column:
    """The words as a phrase if they are one to four, of letters only, 4 to 80 characters in all; else null."""
    joined = F.array_join(of, " ")
    return F.when(F.size(of).between(1, MAX_WORDS) & F.forall(of, lambda w: w.rlike(r"^\p{L}+$")) & F.length(joined).between(MIN_PHRASE, MAX_PHRASE), joined)


def repeated_phrase(df: DataFrame, kind: str = "kind", content: str = "content") -> DataFrame:
    """df with phrase and repetitions where content is nothing but copies of one phrase."""
    parts = df.withColumns({"_words": words(fold(F.when(F.col(kind) == "text", F.col(content)))), "_rows": table_content(F.when(F.col(kind) == "table", F.col(content)))})
    n = F.size("_words")
    text = None
    for size in range(1, MAX_WORDS + 1):
        unit = F.slice("_words", 1, size)
        times = F.floor(n / size).cast("int")
        hit = (n % size == 0) & (times >= MIN_REPEATS) & phrase(unit).isNotNull() & (F.flatten(F.array_repeat(unit, F.when(n > 0, times).otherwise(0))) == F.col("_words"))
        found = F.struct(phrase(unit).alias("phrase"), times.cast("long").alias("repetitions"))
        text = F.when(hit, found) if text is None else text.when(hit, found)
    parts = parts.withColumn("_cells", F.when(~F.col("_rows.has_header") & (F.size("_rows.rows") >= 3) & (F.size(F.get("_rows.rows", F.lit(0))) >= 3), F.flatten("_rows.rows")))
    parts = parts.withColumn("_folded", fold(F.array_join(F.filter("_cells", lambda c: c != ""), "\x00")))
    cells = F.transform(F.filter(F.split("_folded", "\x00"), lambda c: c != ""), lambda c: F.array_join(words(c), " "))
    one = F.array_distinct(cells)
    table = F.when((F.size(one) == 1) & (F.size(cells) >= MIN_REPEATS) & phrase(words(F.get(one, F.lit(0)))).isNotNull(), F.struct(F.get(one, F.lit(0)).alias("phrase"), F.size(cells).cast("long").alias("repetitions")))
    found = F.when(F.col(kind) == "text", text).when(F.col(kind) == "table", table)
    return parts.withColumn("_found", found).withColumns({"phrase": F.col("_found.phrase"), "repetitions": F.col("_found.repetitions")}).drop("_words", "_rows", "_cells", "_folded", "_found")


def candidates(raw_blocks: DataFrame) -> DataFrame:
    """Blocks without an image that only repeat a phrase, kept until verified."""
    found = repeated_phrase(raw_blocks.where("image IS NULL"), "label").where("phrase IS NOT NULL")
    page = F.coalesce("page_index", "page_pos")
    return found.select("doc_id", page.alias("page_index"), (page + 1).alias("page"), F.col("ord").alias("block_index"), F.col("label").alias("kind"), valid_bbox(F.col("bbox")).alias("bbox"), "phrase", "repetitions", "content", F.lit("kept").alias("decision"), F.lit("unverified").alias("reason"))


def page_gate(geometry: DataFrame) -> DataFrame:
    """geometry with supported: known pixels, unrotated, box of the whole page, equal scale both ways, few pixels."""
    good = (F.col("px_w") > 0) & (F.col("px_h") > 0) & (F.col("rotation") == 0) & F.col("full_bbox") & (F.abs(F.col("px_w") / F.col("pt_w") - F.col("px_h") / F.col("pt_h")) <= 0.01) & (F.col("pt_w") * F.col("pt_h") * SCALE**2 <= MAX_PIXELS)
    return geometry.withColumn("supported", F.coalesce(good, F.lit(False)))


def region(box: Column, px_w: Column, px_h: Column, out_w: Column, out_h: Column) -> Column:
    """The box in a rendered page's pixels, two wider on every side, inside the page."""
    low = lambda v, size, out: F.greatest(F.lit(0), F.floor(v / size * out) - EDGE).cast("int")
    high = lambda v, size, out: F.least(out, F.ceil(v / size * out) + EDGE).cast("int")
    return F.struct(low(box["l"], px_w, out_w).alias("l"), low(box["t"], px_h, out_h).alias("t"), high(box["r"], px_w, out_w).alias("r"), high(box["b"], px_h, out_h).alias("b"))


#: Built once a worker: (path, content, page indexes) -> rows of schema.EVIDENCE as dicts.
Inspector = Callable[[str, bytes, list[int]], Iterator[dict]]


def gather(files: DataFrame, found: DataFrame, make: Callable[[], Inspector]) -> DataFrame:
    """Rows (schema.EVIDENCE) on the candidates' pages of PDF files (doc_id, path, content).

    A file that fails gives one row 'failed' and nothing else."""
    wanted = found.groupBy("doc_id").agg(F.sort_array(F.collect_set("page_index")).alias("pages"))
    columns = [part.split()[0] for part in EVIDENCE.split(", ")]
    whole = ["page_index", "rotation", "form_no", "path_no", "seg_no", "other_objects", "type", "width", "height"]

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[list[dict]]:
        inspect = None
        for batch in batches:
            for doc_id, path, content, pages in batch[["doc_id", "path", "content", "pages"]].itertuples(index=False):
                try:
                    inspect = inspect or make()
                    yield [{**x, "doc_id": doc_id} for x in inspect(path, bytes(content), [int(p) for p in pages])]
                except Exception:
                    yield [{"doc_id": doc_id, "row": "failed"}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames(documents(batches), columns, {"doc_id": "int64"} | dict.fromkeys(whole, "Int32"))

    return spread(files).join(spread(wanted).hint("merge"), "doc_id").select("doc_id", "path", "content", "pages").mapInPandas(run, EVIDENCE)


def region_evidence(found: DataFrame, geometry: DataFrame, renders: DataFrame) -> DataFrame:
    """(doc_id, page_index, block_index, darkest, remaining): least channel values of each candidate's region,
    as the page is and without its background form. Null where the region is empty or outside the page."""
    page = ["doc_id", "page_index"]
    at = found.where("bbox IS NOT NULL").select(*page, "block_index", "bbox").join(geometry.select(*page, "px_w", "px_h"), page).where("bbox.r <= px_w AND bbox.b <= px_h")
    # Renderings pass by the regions and are never sorted: they take little room in a shuffle and much in memory.
    at = at.hint("shuffle_hash").join(renders, page).withColumn("region", region(F.col("bbox"), F.col("px_w"), F.col("px_h"), F.col("width"), F.col("height")))
    return at.select(*page, "block_index", darkest_channel("original", "width", "height", "region").alias("darkest"), darkest_channel("foreground", "width", "height", "region").alias("remaining"))


def judged(found: DataFrame, sources: DataFrame, pages: DataFrame, evidence: DataFrame, mode: str = "filter") -> DataFrame:
    """decided() on gathered evidence. sources: (doc_id, is_pdf, transformed); pages: (doc_id, page_index, width, height) in pixels."""
    rows = lambda kind, *columns: evidence.where(F.col("row") == kind).select("doc_id", "page_index", *columns)
    readable = sources.join(evidence.groupBy("doc_id").agg((F.count_if(F.col("row") == "failed") == 0).alias("readable")), "doc_id", "left").withColumn("readable", F.coalesce("readable", F.lit(False)))
    sizes = rows("page", "pt_w", "pt_h", "rotation", "full_bbox")
    geometry = pages.select("doc_id", "page_index", F.col("width").alias("px_w"), F.col("height").alias("px_h")).join(sizes, ["doc_id", "page_index"])
    tiled = tiled_forms(sizes, rows("form", "form_no", "l", "b", "r", "t", "other_objects"), rows("path", "form_no", "path_no", "l", "b", "r", "t"), rows("segment", "form_no", "path_no", "seg_no", "type", "x", "y", "is_close"))
    seen = region_evidence(found, geometry, rows("render", "width", "height", "original", "foreground"))
    return decided(found, readable, geometry, tiled, seen, mode)


def decided(found: DataFrame, sources: DataFrame, geometry: DataFrame, tiled: DataFrame, evidence: DataFrame, mode: str = "filter") -> DataFrame:
    """Candidates with their reason and decision, by the first reason that holds.

    sources: (doc_id, is_pdf, transformed, readable); tiled: (doc_id, page_index) of verified tiled pages."""
    if mode == "off":
        return found.limit(0)
    page = ["doc_id", "page_index"]
    rows = found.drop("decision", "reason").join(sources, "doc_id", "left").join(page_gate(geometry), page, "left").join(tiled.select(*page).distinct().withColumn("_tiled", F.lit(True)), page, "left").join(evidence, [*page, "block_index"], "left")
    outside = F.col("bbox").isNull() | (F.col("bbox.r") > F.col("px_w")) | (F.col("bbox.b") > F.col("px_h"))
    reason = (
        F.when(F.coalesce("transformed", F.lit(False)), "preprocessing_changes_coordinates")
        .when(~F.coalesce("is_pdf", F.lit(False)), "unsupported_input")
        .when(~F.coalesce("readable", F.lit(False)), "verification_failed")
        .when(~F.coalesce("supported", F.lit(False)), "unsupported_page_geometry")
        .when(F.col("_tiled").isNull(), "no_verified_tiled_background")
        .when(outside, "invalid_block_geometry")
        .when(F.col("darkest").isNull() | F.col("remaining").isNull(), "verification_failed")
        .when(F.col("darkest") < DARK, "foreground_contrast")
        .when(F.col("darkest") >= BLANK, "no_visible_background_evidence")
        .when(F.col("remaining") < BLANK, "content_remains_without_background")
        .otherwise("repeated_pale_tiled_background_only")
    )
    drop = F.lit("excluded" if mode == "filter" else "would_exclude")
    return rows.withColumn("reason", reason).withColumn("decision", F.when(F.col("reason") == "repeated_pale_tiled_background_only", drop).otherwise("kept")).select(*[c for c in found.columns if c not in ("decision", "reason")], "decision", "reason")


def without_excluded(raw_blocks: DataFrame, report: DataFrame) -> DataFrame:
    """raw_blocks without those that the report excludes."""
    gone = report.where("decision = 'excluded'").select("doc_id", F.col("page_index").alias("_page"), F.col("block_index").alias("ord"))
    return raw_blocks.withColumn("_page", F.coalesce("page_index", "page_pos")).join(gone, ["doc_id", "_page", "ord"], "left_anti").drop("_page")


def _grid(x: Column, y: Column) -> tuple[dict[str, Column], Column]:
    """Aggregates of a group's points, and of these whether they fill a grid of three or more a side with even gaps."""
    made = {"n": F.count("*"), "_xs": F.sort_array(F.collect_set(x)), "_ys": F.sort_array(F.collect_set(y)), "_places": F.size(F.collect_set(F.when(x.isNotNull() & y.isNotNull(), F.struct(x, y))))}

    def even(at: str) -> Column:
        gaps = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda low, high: high - low)  # the last has no next: null
        return once(F.struct(F.array_min(gaps).alias("low"), F.array_max(gaps).alias("high")), lambda g: (g["low"] > 0) & (g["high"] - g["low"] <= F.greatest(F.lit(0.2), g["low"] * 0.03)))

    nx, ny = F.size("_xs"), F.size("_ys")
    full = (F.least(nx, ny) >= 3) & (F.col("_places") == nx * ny) & (F.col("_places") == F.col("n"))
    return made, F.coalesce(full & even("_xs") & even("_ys"), F.lit(False))


def _outlines(signature: Column) -> tuple[dict[str, Column], Column]:
    """Aggregates of a group's paths, and of these whether all are within 0.05 of the first, point by point."""
    apart = lambda of, first: F.coalesce(F.array_max(F.zip_with(of, first, lambda a, b: F.greatest(F.abs(a["dx"] - b["dx"]), F.abs(a["dy"] - b["dy"])))), F.lit(0.0))
    agree = once(F.col("_paths"), lambda paths: F.array_max(F.transform(paths, lambda p: apart(p["signature"], F.get(paths, F.lit(0))["signature"]))) <= 0.05)
    return {"_paths": F.array_sort(F.collect_list(F.struct("path_no", signature.alias("signature"))))}, agree


def regular_grid(points: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, regular): whether each group's points (x, y) fill a grid of three or more a side with even gaps."""
    made, regular = _grid(F.bround("x", 1), F.bround("y", 1))
    return points.groupBy(*keys).agg(*[v.alias(k) for k, v in made.items()]).select(*keys, "n", regular.alias("regular"))


def path_signatures(segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path_no, signature): segments relative to the path's first point; null for none or over 4,096."""
    listed = segments.groupBy(*keys, "path_no").agg(F.count("*").alias("n_segments"), F.array_sort(F.collect_list(F.struct("seg_no", "type", "x", "y", "is_close"))).alias("_points"))
    moved = lambda points: F.transform(points, lambda p: F.struct(p["seg_no"].alias("seg_no"), p["type"].alias("type"), (p["x"] - F.get(points, F.lit(0))["x"]).alias("dx"), (p["y"] - F.get(points, F.lit(0))["y"]).alias("dy"), p["is_close"].alias("is_close")))
    return listed.select(*keys, "path_no", "n_segments", F.when(F.col("n_segments").between(1, MAX_PATH_SEGMENTS), once(F.col("_points"), moved)).alias("signature"))


def outline_agreement(signatures: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, agree): whether all paths of a shape are within 0.05 of its first path, point by point."""
    made, agree = _outlines(F.col("signature"))
    return signatures.groupBy(*keys).agg(*[v.alias(k) for k, v in made.items()]).select(*keys, agree.alias("agree"))


def tiled_forms(pages: DataFrame, forms: DataFrame, paths: DataFrame, segments: DataFrame) -> DataFrame:
    """(doc_id, page_index) of pages whose one form covers a quarter of them with regular tiles.

    pages: pt_w, pt_h; forms: form_no, l, b, r, t, other_objects; paths: form_no, path_no, l, b, r, t."""
    page = ["doc_id", "page_index"]
    one = forms.groupBy(*page).agg(F.count("*").alias("n"), F.first(F.struct("form_no", "l", "b", "r", "t", "other_objects")).alias("f")).where("n = 1")
    large = one.join(pages, page).where("(f.r - f.l) * (f.t - f.b) >= pt_w * pt_h * 0.25 AND f.other_objects = 0").select(*page, "f.form_no")
    key = [*page, "form_no"]
    # Counts first, of paths before segments: nothing is built for a form over a limit, or with a path over one.
    # Joins name their way: paths and segments grow with the documents, and an estimate that misses their growth would broadcast them.
    fit = paths.groupBy(*key).agg(F.count("*").alias("paths")).where(F.col("paths").between(MIN_REPEATS, MAX_PATHS)).join(large.hint("merge"), key).select(*key)
    counts = segments.join(fit, key, "left_semi").groupBy(*key, "path_no").agg(F.count("*").alias("n_segments"))
    counted = paths.join(fit, key, "left_semi").join(counts.hint("merge"), [*key, "path_no"], "left")
    total = counted.groupBy(*key).agg(F.sum("n_segments").alias("segments"), F.bool_and(F.coalesce(F.col("n_segments").between(1, MAX_PATH_SEGMENTS), F.lit(False))).alias("signed"))
    fine = total.where((F.col("segments") <= MAX_SEGMENTS) & F.col("signed")).select(*key)
    signed = path_signatures(segments.join(fine, key, "left_semi"), key)
    shaped = paths.join(fine, key, "left_semi").join(signed.hint("merge"), [*key, "path_no"]).withColumn("kinds", F.transform("signature", lambda s: F.struct(s["type"].alias("type"), s["is_close"].alias("is_close"))))
    shaped = shaped.withColumn("shape", F.struct(F.bround(F.col("r") - F.col("l")).cast("long").alias("width"), F.bround(F.col("t") - F.col("b")).cast("long").alias("height"), F.to_json("kinds").alias("kinds")))
    # A shape's paths meet once: the limits bound what a form's lists hold.
    (places, regular), (outlines, agree) = _grid(F.bround("l", 1), F.bround("b", 1)), _outlines(F.col("signature"))
    grids = shaped.groupBy(*key, "shape").agg(*[v.alias(k) for k, v in (places | outlines).items()])
    every = grids.groupBy(*key).agg(F.bool_and((F.col("n") >= MIN_REPEATS) & regular & agree).alias("tiled")).where("tiled")
    return every.select(*page)
