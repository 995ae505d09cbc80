"""Whole runs through a made-up engine: bundles, settings, second readings, evidence, failures."""

import io
import json
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark import cloudpickle

from folioflow import __main__ as command
from folioflow.functions import pixels
from folioflow.operators import recover, watermark
from folioflow.plans import run, run_queries, sweep
from folioflow.plans.config import Config
from folioflow.plans.progress import Event, Lines, Log
from folioflow.schema import RAW_BLOCKS
from folioflow.sources import inputs, sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests

QUESTION = "Q1. Pick one: (1) red (2) blue"
SHOWN = "Q1. Pick one:\n\n(1) red\n\n(2) blue"
MATCH = "<table><tr><td>List I</td><td>List II</td></tr><tr><td>(A) x</td><td>{} one</td></tr><tr><td>(B) y</td><td>{} two</td></tr></table>"
PIXELS = np.arange(200 * 100 * 3, dtype=np.uint32).astype(np.uint8).tobytes()
SEEN: list[dict] = []


def make_engine(**options):
    SEEN.append(options)

    def read(path, content):
        if content == b"bad":
            raise RuntimeError("unreadable")
        if content == b"none":
            return
        yield {"row": "page", "page_pos": 0, "page_index": 0, "page_count": 2, "width": 100, "height": 200, "pixels": PIXELS}
        at = lambda ord_, top, **more: {"page_pos": 0, "page_index": 0, "ord": ord_, "bbox": [10.0, float(top), 90.0, top + 10.0], **more}
        yield at(0, 10, label="doc_title", content=f"T {content.decode()}")
        yield at(1, 20, label="text", content=QUESTION)
        yield at(2, 80, label="table", content=MATCH.format("", ""))
        yield at(3, 120, label="text", content="sample copy " * 12)
        yield at(4, 140, label="text", content='<img src="c.png"> done')
        yield {"row": "asset", "page_pos": 0, "path": "c.png", "png": b"PNG"}
        if content == b"lost":
            yield at(5, 160, label="text", content='<img src="lost.png">')

    return read


def make_reader():
    def read(png, prompt):
        assert pixels.unpng(png).size
        if prompt == "ocr":
            yield {"label": "text", "content": "(1) red (2) blue"}
            yield {"label": "text", "content": "(3) green (4) black"}
        else:
            yield {"label": "text", "content": MATCH.format("(I)", "(II)")}
            yield {"label": "table", "content": MATCH.format("(I)", "")}
            yield {"label": "table", "content": MATCH.format("(I)", "(II)")}

    return read


def make_inspector(foreground=255, background=240):
    """One form of 4 by 4 equal squares over the page; pale, and gone without the form."""

    def inspect(path, content, pages):
        for page in pages:
            yield {"row": "page", "page_index": page, "pt_w": 100.0, "pt_h": 200.0, "rotation": 0, "full_bbox": True}
            yield {"row": "form", "page_index": page, "form_no": 0, "l": 0.0, "b": 0.0, "r": 100.0, "t": 200.0, "other_objects": 0}
            for i in range(16):
                l, b = 10.0 + i % 4 * 20, 10.0 + i // 4 * 40
                yield {"row": "path", "page_index": page, "form_no": 0, "path_no": i, "l": l, "b": b, "r": l + 10, "t": b + 10}
                for k, (x, y) in enumerate(((0, 0), (10, 0), (10, 10), (0, 10))):
                    yield {"row": "segment", "page_index": page, "form_no": 0, "path_no": i, "seg_no": k, "type": 0, "x": l + x, "y": b + y, "is_close": k == 3}
            whole = lambda v: bytes([v]) * (150 * 300 * 3)
            yield {"row": "render", "page_index": page, "width": 150, "height": 300, "original": whole(background), "foreground": whole(foreground)}

    return inspect


def broken():
    raise RuntimeError("no such library")


@pytest.fixture
def folder(tmp_path):
    inputs.register_engine("paddle-vl", make_engine)
    for name, content in (("a.pdf", b"one"), ("b.png", b"two"), ("c.txt", b"x"), ("d.pdf", b"bad"), ("e.pdf", b"none"), ("f.png", b"lost")):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    return tmp_path


def bundle(root, name="a"):
    return (root / name / "document.md").read_text()


def test_run_writes_bundles_of_good_documents(spark, folder):
    log = Log()
    told = {Path(r["path"]).name: r["error"] for r in run.run(spark, str(folder / "in"), str(folder / "out"), Config(), run.Hooks(), log).collect()}
    assert told == {"a.pdf": None, "b.png": None, "c.txt": "Unsupported file format: .txt", "d.pdf": "Extraction failed: unreadable", "e.pdf": "Extraction failed: The engine returned no pages", "f.png": "Extraction failed: Embedded image has no pixels: lost.png"}
    assert sorted(p.name for p in (folder / "out").iterdir() if p.name[0] != "_") == ["a", "b"]
    assert bundle(folder / "out").startswith("# T one\n\n" + SHOWN + "\n\n") and "[Table 1](tables/tbl-0.html)" in bundle(folder / "out")
    assert '<img src="images/img-0.png"> done' in bundle(folder / "out") and (folder / "out/a/images/img-0.png").read_bytes() == b"PNG"
    assert "sample copy" in bundle(folder / "out") and (folder / "out/a/tables/tbl-0.html").read_text() == MATCH.format("", "")
    ends = [r["stage"] for r in log.rows if r["completed"]]
    assert ends == ["validation", "loading", "inference", "reconstruction", "normalization", "export"]
    assert log.table(spark).count() == len(log.rows)
    # A second run refuses what is there and harms nothing.
    before = bundle(folder / "out")
    again = {Path(r["path"]).name: r["error"] for r in run.run(spark, str(folder / "in"), str(folder / "out"), Config()).collect()}
    assert again["a.pdf"] == f"Output already exists: {folder}/out/a" and bundle(folder / "out") == before


def test_two_files_of_one_name(spark, folder):
    (folder / "in/a.png").write_bytes(b"three")
    told = {Path(r["path"]).name: r["error"] for r in run.run(spark, str(folder / "in"), str(folder / "out"), Config()).collect()}
    assert told["a.pdf"] is None and told["a.png"].startswith("Output already exists")


def test_second_readings_complete_questions_and_tables(spark, folder):
    run.run(spark, str(folder / "in"), str(folder / "out"), Config(), run.Hooks(reread=make_reader))
    text = bundle(folder / "out")
    assert "(2) blue\n\n(3) green\n\n(4) black" in text and "(II) two" in (folder / "out/a/tables/tbl-0.html").read_text()
    run.run(spark, str(folder / "in"), str(folder / "off"), Config(mcq_retry=False, table_retry=False), run.Hooks(reread=make_reader))
    assert "(3) green" not in bundle(folder / "off")
    run.run(spark, str(folder / "in"), str(folder / "wide"), Config(mcq_crop_margin=60), run.Hooks(reread=make_reader))
    assert "(3) green" not in bundle(folder / "wide")  # no room is left below


def test_readings_that_fail_keep_the_primary(spark, folder):
    run.run(spark, str(folder / "in"), str(folder / "out"), Config(), run.Hooks(reread=broken))
    assert SHOWN in bundle(folder / "out") and (folder / "out/a/tables/tbl-0.html").read_text() == MATCH.format("", "")


@pytest.mark.parametrize(
    ("mode", "profile", "inspect", "reason", "decision"),
    [
        ("filter", "balanced", make_inspector, "repeated_pale_tiled_background_only", "excluded"),
        ("report", "balanced", make_inspector, "repeated_pale_tiled_background_only", "would_exclude"),
        ("filter", "balanced", lambda: make_inspector(foreground=200), "content_remains_without_background", "kept"),
        ("filter", "balanced", lambda: make_inspector(background=100), "foreground_contrast", "kept"),
        ("filter", "balanced", broken, "verification_failed", "kept"),
        ("filter", "balanced", None, "verification_failed", "kept"),
        ("filter", "robust", make_inspector, "preprocessing_changes_coordinates", "kept"),
    ],
)
def test_watermarks(spark, folder, mode, profile, inspect, reason, decision):
    run.run(spark, str(folder / "in"), str(folder / "out"), Config(watermark_mode=mode, profile=profile, debug=True), run.Hooks(inspect=inspect))
    place = "watermarks.json" if mode == "report" else "debug/watermarks.json"
    told = json.loads((folder / "out/a" / place).read_text())
    assert (told["mode"], [(c["reason"], c["decision"]) for c in told["candidates"]]) == (mode, [(reason, decision)])
    assert ("sample copy" in bundle(folder / "out")) == (decision != "excluded")
    other = json.loads((folder / "out/b" / place).read_text())["candidates"]
    assert [c["reason"] for c in other] == ["preprocessing_changes_coordinates" if profile == "robust" else "unsupported_input"]


def test_debug_files_and_options(spark, folder):
    SEEN.clear()
    config = Config(debug=True, backend="mlx", server_url="http://u:secret@h/v1", layout_threshold=0.4)
    run.run(spark, str(folder / "in"), str(folder / "out"), config)
    debug = folder / "out/a/debug"
    assert sorted(p.name for p in debug.iterdir()) == ["elements.json", "question-layout.json", "raw.json", "watermarks.json"]
    found = json.loads((debug / "elements.json").read_text())
    assert [e["kind"] for e in found["elements"]] == ["doc_title", "text", "table", "text", "text"] and found["config"]["paddle"]["layout_threshold"] == 0.4
    assert found["config"]["paddle"]["vl_rec_backend"] == "mlx-vlm-server" and found["source_file"].endswith("a.pdf")
    assert json.loads((debug / "watermarks.json").read_text())["candidates"] == []
    raw = json.loads((debug / "raw.json").read_text())["rows"]
    assert [r["content"] for r in raw if r["row"] == "block"][1] == QUESTION and "pixels" not in raw[0]
    assert json.loads((debug / "question-layout.json").read_text())["tables"] == [{"page": 1, "table": "tbl-0.html", "converted": False, "warnings": [], "repairs": []}]
    assert not any("secret" in p.read_text(errors="replace") for p in (folder / "out").rglob("*.json"))


def test_reconstruction_sees_pdfs_alone(spark, folder):
    from pyspark.sql import functions as F

    hook = lambda blocks: blocks.withColumn("content", F.when(F.col("label") == "doc_title", "Moved").otherwise(F.col("content")))
    run.run(spark, str(folder / "in"), str(folder / "out"), Config(), run.Hooks(restructure=hook))
    assert bundle(folder / "out").startswith("# Moved") and bundle(folder / "out", "b").startswith("# T two")


def test_engine_of_the_second_kind(spark, tmp_path):
    def make():
        def read(path, content):
            yield {"row": "page", "page_pos": 0, "page_index": 0, "page_height": 100.0}
            yield {"row": "item", "ord": 0, "page_index": 0, "label": "section_header", "content": "H", "title_level": 2, "bbox": [0.0, 90.0, 50.0, 80.0]}
            yield {"row": "item", "ord": 1, "page_index": 0, "label": "table", "content": "<table><tr><th>x</th></tr><tr><td>1</td></tr></table>"}
            yield {"row": "item", "ord": 2, "page_index": 0, "label": "image", "image": b"P" if content == b"ok" else None}
            yield {"row": "item", "ord": 3, "label": "list_item", "content": "last"}

        return read

    inputs.register_engine("docling", make)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.pdf").write_bytes(b"ok")
    (tmp_path / "in/y.pdf").write_bytes(b"no")
    told = {Path(r["path"]).name: r["error"] for r in run.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), Config(engine="docling")).collect()}
    assert told == {"x.pdf": None, "y.pdf": "Extraction failed: picture without pixels"}
    assert bundle(tmp_path / "out", "x") == "## H\n\n| x |\n| --- |\n| 1 |\n\n[Table 1](tables/tbl-0.html)\n\n![Image 1](images/img-0.png)\n\n- last\n"
    assert (tmp_path / "out/x/images/img-0.png").read_bytes() == b"P"


def test_unknown_stores_fail_loudly(spark, tmp_path):
    files = spark.createDataFrame([("nostore://bucket/x/document.md", bytearray(b"x"))], "path string, content binary")
    with pytest.raises(Exception, match="No file system here can write nostore"):
        sinks.write_files(files)
    with pytest.raises(ValueError, match="No file system for nostore"):
        sinks.existing_bundles(spark, "nostore://bucket/x")
    assert not list(Path.cwd().glob("nostore*"))
    sinks.write_to_store(f"file://{tmp_path}/sub/y.bin", b"y")
    assert (tmp_path / "sub/y.bin").read_bytes() == b"y"


def test_pictures_round_trip_and_crop():
    rgb = np.random.default_rng(1).integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert np.array_equal(pixels.unpng(pixels.png(rgb)), rgb)
    box = {"l": 1, "t": 2, "r": 4, "b": 6}
    assert np.array_equal(pixels.unpng(pixels.crop(rgb.tobytes(), 5, 7, box)), rgb[2:6, 1:4, ::-1])
    assert pixels.darkest(rgb.tobytes(), 5, 7, box) == rgb[2:6, 1:4].min() and pixels.darkest(rgb.tobytes(), 5, 7, box | {"r": 1}) is None
    with pytest.raises(ValueError):
        pixels.crop(b"123", 5, 7, box)


def test_limits_reject_forms(spark, monkeypatch):
    page = [(1, 0, 100.0, 200.0)]
    rows = [r for r in make_inspector()("", b"", [0])]
    pick = lambda kind, *names: [(1, 0, *[r[n] for n in names]) for r in rows if r["row"] == kind]
    pages = spark.createDataFrame(page, "doc_id long, page_index int, pt_w double, pt_h double")
    forms = spark.createDataFrame(pick("form", "form_no", "l", "b", "r", "t", "other_objects"), "doc_id long, page_index int, form_no int, l double, b double, r double, t double, other_objects int")
    paths = spark.createDataFrame(pick("path", "form_no", "path_no", "l", "b", "r", "t"), "doc_id long, page_index int, form_no int, path_no int, l double, b double, r double, t double")
    segments = spark.createDataFrame(pick("segment", "form_no", "path_no", "seg_no", "type", "x", "y", "is_close"), "doc_id long, page_index int, form_no int, path_no int, seg_no int, type int, x double, y double, is_close boolean")
    count = lambda: watermark.tiled_forms(pages, forms, paths, segments).count()
    assert count() == 1
    for name, over in (("MAX_PATHS", 15), ("MAX_SEGMENTS", 63), ("MAX_PATH_SEGMENTS", 3), ("MIN_REPEATS", 17)):
        with monkeypatch.context() as m:
            m.setattr(watermark, name, over)
            assert count() == 0, name
    assert watermark.tiled_forms(pages, forms, paths, segments.where("path_no > 0")).count() == 0


def test_lines_of_progress():
    out, now = io.StringIO(), iter(range(100))
    with pytest.raises(RuntimeError), Lines(out, lambda: next(now)) as lines:
        lines(Event("validation", "Input validated", total=2, completed=True))
        lines(Event("inference", "Extracting", current=0))
        lines(Event("inference", "Extracting", current=1))
        raise RuntimeError
    assert out.getvalue().splitlines() == ["Pages: 2", "✓ Input validated  1.0s", "Extracting · 0/2 pages received", "Extracting · 1/2 pages received", "× Failed: Extracting · 1/2 pages received", "Total: 4.0s"]


def test_sweep(spark, folder):
    import hashlib

    source = folder / "in/b.png"
    digest = hashlib.sha256(source.read_bytes()).hexdigest()
    found = sweep.sweep(spark, source, folder / "sweep", sweep.THRESHOLDS, sha256=digest)
    assert {k: v["config"]["layout_threshold"] for k, v in found.items()} == {"0.5": 0.5, "0.4": 0.4} and not found["0.5"]["checks"]["all"]
    assert json.loads((folder / "sweep/comparison.json").read_text()).keys() == found.keys()
    with pytest.raises(ValueError, match="never overwritten"):
        sweep.sweep(spark, source, folder / "sweep", sweep.UNCLIPS, sha256=digest)
    with pytest.raises(ValueError, match="isn't the file"):
        sweep.sweep(spark, source, folder / "other", sweep.UNCLIPS, sha256="0" * 64)


def test_command_line(spark, folder, monkeypatch, capsys):
    monkeypatch.setattr(spark, "stop", lambda: None)
    assert command.main([str(folder / "in"), str(folder / "out"), "--engine-module", "json", "--layout-threshold", "0.9"]) == 2
    assert command.main([str(folder / "in"), str(folder / "out"), "--engine-module", "json", "--debug"]) == 1
    told = capsys.readouterr().err
    assert "c.txt: Unsupported file format: .txt" in told and "✓ Results exported" in told and (folder / "out/a/debug/raw.json").exists()
    blocks = spark.createDataFrame([(1, 0, 0, 0, "text", "x", None, None, None), (2, 0, 0, 0, "image", "", None, None, None)], RAW_BLOCKS)
    blocks.write.parquet(str(folder / "blocks"))
    assert command.main([str(folder / "blocks"), str(folder / "plain")]) == 0
    assert [tuple(r) for r in spark.read.parquet(str(folder / "plain/documents")).collect()] == [(1, "x\n")]


def test_reading_margins_are_bounds():
    assert recover.MARGIN == Config().mcq_crop_margin == Config().table_crop_margin


def test_queries_over_whole_runs_read_each_file_once(spark, tmp_path, monkeypatch):
    make = run_queries.made_up_engine

    def counted():
        read = make()

        def told(path, content):
            with (tmp_path / "calls").open("a") as f:
                f.write("x")
            return read(path, content)

        return told

    monkeypatch.setattr(run_queries, "made_up_engine", counted)
    run_queries.run_errors(spark, "/root/testdata/sf0.001").count()
    assert (tmp_path / "calls").stat().st_size == spark.read.parquet("/root/testdata/sf0.001/part.parquet").where("p_partkey % 14 != 7").count()


def test_no_broadcast_of_pixels_however_small_they_look(spark):
    """A few rows that unfold to their pixels, as a file of pages that compress well does."""
    from pyspark.sql import functions as F

    pages = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(1).alias("page_no"), F.lit(20).alias("width"), F.lit(40).alias("height"), F.encode(F.repeat(F.col("id").cast("string"), 2400), "utf-8").alias("pixels"))
    crops = pages.select("doc_id", "page_no", F.lit(0).alias("ord"), F.struct(*[F.lit(v).alias(n) for n, v in zip("ltrb", (0, 0, 4, 4))]).alias("crop"), *[F.lit("x").alias(f"more_{i}") for i in range(10)])
    cut = recover.with_crops(crops, pages)
    assert "BroadcastExchange" not in cut._jdf.queryExecution().executedPlan().toString() and cut.where("png IS NOT NULL").count() == 10


def test_inspection_is_dealt_to_all_tasks_however_small_the_files(spark):
    from pyspark.sql import functions as F

    files = spark.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a.pdf").alias("path"), F.lit(b"x").alias("content"))
    found = files.select("doc_id", F.lit(0).alias("page_index"))
    rows = watermark.gather(files, found, make_inspector).where("row = 'page'").select("doc_id", F.spark_partition_id().alias("task"))
    assert rows.count() == 200 and rows.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_pixels_are_never_sorted_and_only_a_box_s_rows_leave_the_jvm(spark):
    from pyspark.sql import functions as F

    page = spark.range(10).select(F.col("id").alias("doc_id"), F.lit(0).alias("page_index"))
    even = lambda v: F.unhex(F.repeat(F.lit(v), 2700))
    renders = page.select("*", F.lit(30).alias("width"), F.lit(30).alias("height"), even("F0").alias("original"), even("FF").alias("foreground"))
    found = page.select("*", F.lit(0).alias("block_index"), F.struct(*[F.lit(float(v)).alias(n) for n, v in zip("ltrb", (0, 12, 30, 18))]).alias("bbox"))
    seen = watermark.region_evidence(found, page.select("*", F.lit(30).alias("px_w"), F.lit(30).alias("px_h")), renders)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [doc_id" not in plan.split("ShuffledHashJoin")[0]
    assert {tuple(r)[3:] for r in seen.collect()} == {(240, 255)} and seen.count() == 10
    sent = pixels._banded(lambda rows, width, height, box: F.struct(F.octet_length(rows).alias("bytes"), height.alias("height"), box["b"].alias("b")))
    box = lambda t, b: F.struct(*[F.lit(v).alias(n) for n, v in zip("ltrb", (0, t, 30, b))])
    told = renders.limit(1).select(*[F.to_json(sent("original", "width", "height", box(t, b))) for t, b in ((10, 20), (25, 40), (20, 20))]).first()
    assert [json.loads(x) for x in told] == [{"bytes": 900, "height": 10, "b": 10}, {"bytes": 450, "height": 5, "b": 5}, {"height": 0, "b": 0}]
    assert [*renders.limit(1).select(pixels.darkest_channel("original", "width", "height", box(25, 40)), pixels.darkest_channel("original", "width", "height", box(20, 20))).first()] == [240, None]
    with pytest.raises(Exception, match="2700 bytes are no picture of 30 x 31"):
        renders.select(pixels.darkest_channel("original", "width", F.lit(31), box(0, 1))).collect()


def test_a_form_s_paths_meet_once(spark):
    """Grids and outlines come from one grouping of a form's paths, without windows; signatures from one grouping of their segments."""
    plan = run_queries.resource_limits(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("SortMergeJoin") <= 12


def test_grids_and_outlines_at_their_edges(spark):
    nan = float("nan")
    at = lambda g, *points: [(g, x, y) for x, y in points]
    full = [(float(x), float(y)) for x in range(3) for y in range(4)]
    rows = at(1, *full) + at(2, *full[:-1]) + at(3, *full, full[0]) + at(4, *full, (None, 1.0)) + at(5, *[(nan if x == 2 else x, y) for x, y in full]) + at(6, (None, None)) + at(7, *[(0.0, y) for _, y in full])
    grid = watermark.regular_grid(spark.createDataFrame(rows, "g int, x double, y double"), ["g"])
    assert sorted(map(tuple, grid.collect())) == [(1, 12, True), (2, 11, False), (3, 13, False), (4, 13, False), (5, 12, False), (6, 1, False), (7, 12, False)]
    points = [(1, 0, 1, 5.0, 5.0), (1, 0, 0, 1.0, 2.0), (1, 1, 0, 0.0, 0.0), (1, 1, 1, 4.04, 3.0), (2, 0, 0, 0.0, 0.0), (2, 0, 1, 1.0, 1.0), (2, 1, 0, 0.0, 0.0), (2, 1, 1, 1.1, 1.0)]
    signed = watermark.path_signatures(spark.createDataFrame(points, "g int, path_no int, seg_no int, x double, y double").selectExpr("*", "0 AS type", "false AS is_close"), ["g"])
    assert {(r["g"], r["path_no"]): [(s["seg_no"], s["dx"], s["dy"]) for s in r["signature"]] for r in signed.collect()}[1, 0] == [(0, 0.0, 0.0), (1, 4.0, 3.0)]
    assert sorted(map(tuple, watermark.outline_agreement(signed, ["g"]).collect())) == [(1, True), (2, False)]


def test_second_readings_are_judged_once_a_text(spark):
    """No filter on parsed options or merged texts: it would move below what makes them and parse anew for each mention."""
    blocks = spark.createDataFrame([(1, 1, 0, "text", "Q1. x (1) a (2) b", (1.0, 2.0, 15.0, 6.0)), (1, 1, 1, "footer", "f", (1.0, 30.0, 15.0, 32.0)), (2, 1, 0, "text", "Q2. x (1) a (2) b (3) c (4) d", (1.0, 2.0, 15.0, 6.0)), (2, 1, 1, "footer", "f", (1.0, 30.0, 15.0, 32.0))], "doc_id long, page_no int, ord int, kind string, content string, bbox struct<l:double,t:double,r:double,b:double>")
    pages = spark.createDataFrame([(i, 1, 20, 40, bytes(2400)) for i in (1, 2)], "doc_id long, page_no int, width int, height int, pixels binary")
    make = run_queries.second_reader
    new = recover.retried_options(blocks, pages, make)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if ("Filter" in x or "Join" in x) and "aggregate(" in x]
    assert [r["content"] for r in new.collect()] == ["Q1. x (1) a (2) b\n\n(3) c\n\n(4) d"]
    same = recover.retried_options(blocks, pages, lambda: lambda png, prompt: [{"label": "text", "content": "(1) a (2) b"}])
    assert not same.collect()
