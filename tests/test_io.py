import json

from pyspark.sql import functions as F

from leafgraph import plugins
from leafgraph.operators import stats
from leafgraph.sources import dataset, sinks
from leafgraph.streaming.incremental import graphs_of, process_new, valid_document


def form_page(doc):
    words = [(t, x, 24 * k) for k in range(3) for t, x in (("Name:", 0), (f"value{k}", 48))]
    return [{"doc_id": doc, "token_id": i, "text": t, "confidence": 0.9, "xmin": x * 1.0, "ymin": y * 1.0, "xmax": x + 8.0 * len(t), "ymax": y + 16.0} for i, (t, x, y) in enumerate(words)]


def put(path, pages):
    path.write_text("".join(json.dumps(t) + "\n" for p in pages for t in form_page(p)))


def test_new_files_are_processed_once(spark, tmp_path):
    source, target, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    put(source / "a.json", ["p1", "p2"])
    process_new(spark, str(source), target, mark).awaitTermination()
    put(source / "b.json", ["p2", "p3"])
    process_new(spark, str(source), target, mark).awaitTermination()
    out = spark.read.parquet(target)
    assert sorted(r.doc_id for r in out.collect()) == ["p1", "p2", "p3"]
    assert out.filter(valid_document(F.col("payload"))).count() == 3


def test_valid_documents(spark):
    whole = '{"nodes": [{"node_id": 0}], "edges": [], "adjacency": {}, "metadata": {}}'
    df = spark.createDataFrame([(whole,), (whole[:-4],), ('{"nodes": [], "edges": [], "adjacency": {}, "metadata": {}}',), (None,)], "payload string")
    assert [r.v for r in df.select(valid_document(F.col("payload")).alias("v")).collect()] == [True, False, False, False]


def test_graph_of_a_form(spark):
    tokens = spark.createDataFrame(form_page("p"))
    doc = json.loads(graphs_of(tokens).first().payload)
    assert doc["nodes"][0]["region_type"] == "form" and doc["metadata"]["num_nodes"] == len(doc["nodes"])


def test_source_names(spark):
    df = spark.createDataFrame([("a/test/train-1.parquet", 5, "d"), ("val.parquet", None, "d"), ("x.parquet", None, None)], "f string, q long, d string")
    rows = df.select(dataset.split_of_file(F.col("f")).alias("s"), dataset.image_name(F.col("q"), F.col("d"), F.lit("s"), F.lit(3)).alias("n")).collect()
    assert [tuple(r) for r in rows] == [("train", "5.png"), ("validation", "d_3.png"), ("others", "s_3.png")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("train", "a", 'x "q"\ny', bytearray(b"1")), ("test", "b", None, None)], "split string, name string, text string, content binary")
    sinks.write_csv(df.drop("content"), str(tmp_path / "csv"), by="split")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert {(r["split"], r["text"]) for r in back.collect()} == {("train", 'x "q"\ny'), ("test", None)}
    sinks.write_csv(df.drop("content"), str(tmp_path / "one"), one_file=True, mark=True)
    assert next((tmp_path / "one").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    sinks.write_images(df, str(tmp_path / "img"), "split", "name", "content")
    assert (tmp_path / "img/train/a").read_bytes() == b"1" and not (tmp_path / "img/test/b").exists()
    sinks.write_documents(df.select("name", F.to_json(F.struct("name")).alias("j")), str(tmp_path / "docs"), "name", "j")
    assert {r.file_name for r in dataset.read_json_documents(spark, str(tmp_path / "docs")).collect()} == {"a.json", "b.json"}
    sinks.write_json(df.drop("content"), str(tmp_path / "json"), by="split")
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    assert dataset.read_images(spark, str(tmp_path / "img"), "*").first().split == "train"
    df.drop("content").write.parquet(str(tmp_path / "pq"))
    (tmp_path / "pq/broken.parquet").write_bytes(b"no parquet")
    assert dataset.read_parquet(spark, str(tmp_path / "pq"), "name", schema="name string").count() == 2


def test_recognition_plugin(spark):
    def load():
        def engine(b):
            if b == b"bad":
                raise ValueError("broken image")
            return [("Hello", None, [[0, 0], [9, 0], [9, 5], [0, 5]]), (" ", 0.5, None), ("x", 0.4, None)] if b == b"ok" else []

        return engine

    images = spark.createDataFrame([("a", bytearray(b"ok")), ("b", bytearray(b"bad")), ("c", bytearray(b"none"))], "doc_id string, content binary")
    rows = plugins.recognize(images, load)
    assert [(r.doc_id, r.text, r.confidence, r.xmax, r.error) for r in rows.orderBy("doc_id", "token_id").collect()] == [
        ("a", "Hello", 0.0, 9.0, None), ("a", "x", 0.4, None, None), ("b", None, None, None, "broken image"), ("c", None, None, None, "no text")
    ]
    r = stats.recognition(rows.filter("error IS NULL"), "doc_id").first()
    assert (r.text, r.num_lines, r.avg_confidence) == ("Hello\nx", 2, 0.2)


def test_model_plugin_and_sizes(spark):
    df = spark.createDataFrame([("p", 5000, 1000), ("q", 100, 50)], "prompt string, w int, h int")
    assert [r.reply for r in plugins.complete(df, lambda: lambda ps: [p + "!" for p in ps]).orderBy("prompt").collect()] == ["p!", "q!"]
    w, h = plugins.target_size(F.col("w"), F.col("h"))
    assert [tuple(r) for r in df.orderBy("prompt").select(w, h).collect()] == [(2500, 500), (100, 50)]


def test_command_line_asks_what_the_generator_asks(spark, tmp_path):
    from leafgraph.__main__ import main
    from leafgraph.operators import graph as G
    from leafgraph.operators import qa as Q

    nodes = dataset.demo_regions(spark)
    edges = G.graph_edges(nodes)
    doc = G.graph_documents(nodes, edges).select(F.to_json(F.struct("version", "nodes", "edges", "adjacency", "metadata")).alias("j")).first().j
    (tmp_path / "in").mkdir()
    (tmp_path / "in/demo.json").write_text(json.dumps(json.loads(doc), indent=2))
    (tmp_path / "in/cut.json").write_text(doc[:50])
    main(["--doc", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--max_qas", "4"])
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert [(r.source_document, r.num_qas) for r in rows] == [("demo.json", 4)]
    want = [r.question for r in Q.generate_qas(nodes, edges).orderBy("idx").limit(4).collect()]
    assert [q.question for q in rows[0].qas] == want


def test_templates_and_absent_outputs(spark, tmp_path):
    from leafgraph.streaming.incremental import exists

    (tmp_path / "t.json").write_text(json.dumps({"system_prompt": "S", "prompt_templates": {"k": {"reasoning_type": "r", "prompt_template": "P {source_id}", "more": 1}}}, indent=2))
    assert [tuple(r) for r in dataset.read_templates(spark, str(tmp_path / "t.json")).collect()] == [("k", "r", "P {source_id}", "S")]
    assert not exists(spark, str(tmp_path / "none")) and exists(spark, str(tmp_path))


def test_unreadable_parquet_files_are_skipped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p/part-bad.parquet").write_bytes(b"PAR1 nothing")
    assert dataset.read_parquet(spark, str(tmp_path / "p"), "id", schema="id long").count() == 3


def test_written_tables_are_dropped(spark):
    from pathlib import Path

    from leafgraph.sources import tables

    tables.written(spark.range(5), "five")
    paths = [Path(x.removeprefix("file:")) for x in tables._WRITTEN]
    assert paths[-1].exists()
    tables.drop_written(spark)
    assert not any(p.exists() for p in paths) and not tables._WRITTEN
