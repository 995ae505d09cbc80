"""Settings, files, engines, streams."""

import json

import pytest
from pyspark.sql import functions as F

from folioflow.operators import normalize
from folioflow.plans import config
from folioflow.schema import RAW_BLOCKS
from folioflow.sources import inputs, sinks
from folioflow.streaming import documents


def test_settings_by_precedence(tmp_path):
    (tmp_path / ".env").write_text("# x\nFOLIOFLOW_PROFILE=robust\nFOLIOFLOW_MAX_CONCURRENCY=2\n")
    got = config.resolve({"layout_threshold": 0.4}, {"FOLIOFLOW_MAX_CONCURRENCY": "3"}, tmp_path)
    assert (got.profile, got.max_concurrency, got.layout_threshold) == ("robust", 3, 0.4)
    assert got.engine_options()["use_doc_unwarping"] and "server_url" not in got.report()


@pytest.mark.parametrize("bad", [{"max_concurrency": 5}, {"layout_threshold": 0.1}, {"server_url": "http://x"}, {"backend": "mlx"}, {"backend": "mlx", "server_url": "ftp://x"}, {"engine": "docling", "profile": "robust"}, {"profile": "x"}, {"mcq_crop_margin": -1}])
def test_settings_refused(bad):
    with pytest.raises(ValueError):
        config.Config(**bad)


def test_duration():
    assert [config.duration(s) for s in (3.14, 60, 125.9)] == ["3.1s", "1m 00s", "2m 05s"]


def test_json_is_whole_or_nothing(tmp_path):
    target = tmp_path / "debug" / "x.json"
    sinks.write_json(target, {"é": [1.5]})
    with pytest.raises(ValueError):
        sinks.write_json(target, {"x": float("nan")})
    assert json.loads(target.read_text()) == {"é": [1.5]} and [p.name for p in target.parent.iterdir()] == ["x.json"]


@pytest.fixture
def engine():
    def make():
        def read(path, content):
            if content == b"bad":
                raise RuntimeError("unreadable")
            yield {"page_pos": 0, "ord": 0, "label": "text", "content": content.decode(), "bbox": [0.0, 0, 1, 1]}
            yield {"page_pos": 1, "ord": 0, "label": "doc_title", "content": "T", "bbox": [0.0, 0, 1, 1]}

        return read

    inputs.register_engine("fake", make)


def test_files_to_bundles(spark, engine, tmp_path):
    for name, content in (("a.pdf", b"hello"), ("b.PNG", b"bad"), ("c.txt", b"no")):
        (tmp_path / name).write_bytes(content)
    raw = inputs.extract(inputs.read_files(spark, str(tmp_path)), "fake")
    found = {(r["page_no"], r["content"], r["kind"]) for r in normalize.adapt(inputs.blocks(raw)).collect()}
    assert found == {(1, "hello", "text"), (2, "# T", "doc_title")}
    assert {r["error"] for r in inputs.errors(raw).collect()} == {"Extraction failed: unreadable", "Unsupported file format: .txt"}
    files = spark.createDataFrame([(1, f"{tmp_path}/out/a", "# T\n")], "doc_id long, root_dir string, markdown string")
    tables = spark.createDataFrame([(1, "tbl-0.html", "<table/>")], "doc_id long, name string, html string")
    images = spark.createDataFrame([(1, "img-0.png", bytearray(b"x"))], "doc_id long, name string, png binary")
    sinks.write_files(sinks.bundle_files(files, tables, images))
    assert {str(p.relative_to(tmp_path / "out/a")) for p in (tmp_path / "out/a").rglob("*.*")} == {"document.md", "tables/tbl-0.html", "images/img-0.png"}


def test_stream_of_blocks(spark, tmp_path):
    rows = [(3, 0, 0, 0, "chart", "", None, None, None), (3, 0, 0, 1, "text", "c", None, None, None), (1, 0, 0, 0, "text", "a", [0.0, 0.0, 1.0, 1.0], None, None), (1, 0, 0, 1, "inline_formula", "$x$", [0.0, 0.0, 1.0, 1.0], None, None), (2, 0, 0, 0, "text", "b", [0.0, 0.0, 1.0, 1.0], None, None)]
    spark.createDataFrame(rows, RAW_BLOCKS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(RAW_BLOCKS).parquet(str(tmp_path / "in"))
    query = documents.write_markdown(stream, str(tmp_path / "out"), str(tmp_path / "check"))
    query.processAllAvailable()
    query.stop()
    got = dict(spark.read.parquet(str(tmp_path / "out")).select("doc_id", "markdown").collect())
    assert got == {1: "a $x$\n", 2: "b\n"}


def test_missing_pixels_are_an_error_of_one_row(spark):
    df = spark.createDataFrame([(1, 0, None, 0, "chart", "", [0.0, 0.0, 1.0, 1.0], None, None), (2, 0, None, 0, "text", "x", None, None, None)], RAW_BLOCKS)
    got = dict(normalize.adapt(df).select("doc_id", "error").collect())
    assert got == {1: "image without pixels on page 1", 2: None}


def test_entry_names(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["doc_id", "markdown"]
    assert F is not None


def broadcast(df):
    """The columns that the first plan of df broadcasts, a text for each broadcast."""

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.initialPlan()
        if node.nodeName().startswith("BroadcastExchange"):
            yield node.output().mkString(" ")
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return [*walk(df._jdf.queryExecution().executedPlan())]


def test_no_broadcast_of_paths_however_small_they_look(spark):
    """A few pages that explode to their paths and segments: by the estimate all would fit into a broadcast."""
    from folioflow.plans import registry

    found = registry.queries()["resource_limits"](spark, "/root/testdata/sf0.001")
    assert not [x for x in broadcast(found) if "path_no" in x or "shape" in x or "n_segments" in x]


def test_frames_hold_many_small_documents_and_few_large_ones():
    from folioflow.functions.arrow import FRAME_BYTES, FRAME_ROWS, frames

    small = [*frames(([{"doc_id": i, "png": None}] for i in range(2 * FRAME_ROWS + 1)), ["doc_id", "png"], {"doc_id": "int64"})]
    assert [len(f) for f in small] == [FRAME_ROWS, FRAME_ROWS, 1] and [i for f in small for i in f["doc_id"]] == [*range(2 * FRAME_ROWS + 1)]
    large = [*frames(([{"doc_id": i, "png": bytes(FRAME_BYTES // 2)}] * 3 for i in range(2)), ["doc_id", "png"], {"doc_id": "int64"})]
    assert [[*f["doc_id"]] for f in large] == [[0] * 3, [1] * 3]
    assert not [*frames([[], []], ["doc_id"], {"doc_id": "int64"})]
