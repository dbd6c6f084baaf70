import json

import pytest
from pyspark.sql import functions as F

from kiteloom import models, reports
from kiteloom.operators import embed, extract, graph
from kiteloom.operators import markdown as D
from kiteloom.sources import files, readers, render, sinks
from kiteloom.streaming import incremental


def test_replies(spark):
    rows = [
        (1, '{"entities": [{"name": " TCP ", "type": "Protocol"}, {"name": "x", "type": "concept"}, 7], "triples": [{"head": "aa", "relation": "CONTAINS", "tail": "bb", "evidence": "e", "review": {"decision": "drop", "reason_code": "weak"}}, {"head": "aa", "relation": "contains", "tail": "aa"}]}'),
        (2, 'so:\n```json\n{"entities": [], "triples": []}\n```\nend'), (3, "no json"), (4, "[1, 2]"), (5, None), (6, '{"entities": null}'),
    ]
    got = {r["reply_id"]: r for r in extract.parse_replies(spark.createDataFrame(rows, "reply_id int, reply string")).collect()}
    assert [tuple(x) for x in got[1]["entities"]] == [("TCP", "protocol", "")]
    assert [tuple(x) for x in got[1]["triples"]] == [("aa", "contains", "bb", "e", "drop", "WEAK", "", None, None)]
    assert {i: got[i]["status"] for i in range(2, 6)} == {2: "ok", 3: "empty", 4: "failed", 5: "empty"}


def test_gate_order(spark):
    t = spark.createDataFrame(
        [(1, "a", "b", "a and b", "drop", None, None), (2, "a", "b", "not here", "keep", None, None), (3, "a", "b", "a and b", "keep", 0, 7), (4, "z", "b", "a and b", "keep", None, None), (5, "a", "z", "a and b", "keep", None, None), (6, "a", "b", "a and b", "keep", 4, 11), (7, "a", "b", "", "keep", None, None)],
        "triple_id int, head string, tail string, evidence string, decision string, span_start int, span_end int",
    ).withColumns({"source_file": F.lit("s"), "chunk_index": F.lit("0")})
    c = spark.createDataFrame([(1, "s", 0, "中文: a and b")], "chunk_id int, source_file string, chunk_index int, content string")
    got = {r["triple_id"]: (r["reason_code"], r["start"]) for r in extract.gate(t, c).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["LOW_CONFIDENCE_DROP", "EVIDENCE_NOT_IN_CHUNK", "SPAN_MISMATCH", "HEAD_NOT_IN_EVIDENCE", "TAIL_NOT_IN_EVIDENCE", None, "HEAD_NOT_IN_EVIDENCE"]
    assert got[6][1] == 4
    assert {r["reason_code"] for r in extract.gate(t, c, strict=False).collect()} == {"LOW_CONFIDENCE_DROP", None}


def test_failures_of_models_are_rows(spark):
    df = spark.createDataFrame([(1, "课文把甲甲与乙乙作了对比。"), (2, " "), (3, None)], "chunk_id long, content string")
    assert [(r["chunk_id"], r["status"]) for r in extract.propose(df, models.RuleExtractor).collect()] == [(1, "success")]
    bad = extract.propose(df, lambda: models.Scripted([RuntimeError("down")])).collect()
    assert [(r["status"], r["error"]) for r in bad] == [("failed", "down")]


def test_models_retry_and_rate():
    naps = []
    client = models.Scripted([models.TransientError(), TimeoutError(), "ok"])
    assert models.with_retries(lambda: client.extract("", ""), 3, naps.append) == "ok" and naps == [1, 2]
    with pytest.raises(ValueError):
        models.with_retries(lambda: models.Scripted([ValueError()]).extract(""), 3, naps.append)
    now = [0.0]
    share = models.RateShare(4, 2, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(3):
        share.acquire()
    assert now[0] == 60.0
    slow = models.RateShare(2, 5, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))  # more tasks than calls a minute
    began = now[0]
    for _ in range(3):
        slow.acquire()
    assert now[0] - began == 300.0
    client = models.Scripted([models.TransientError(), "ok"])
    assert models.Calls(2, 60).begin(lambda s: None)(lambda: client.extract("", "")) == "ok"


PROFILES = {"llm": {"profiles": {"p": {"provider": {"model": "m", "supports_thinking": True}, "request": {"thinking": {"enabled": True}, "timeout_seconds": 5}, "rate_limit": {"rpm": 7}}}}}


def test_settings():
    s = models.settings_of({**PROFILES, "t": {"llm_profile": "p", "prompts": {"default": " say "}}}, "t")
    assert (s.model, s.timeout_seconds, s.rpm, s.reasoning_effort, s.prompt, s.modality) == ("m", 5.0, 7, "medium", "say", "text")
    assert models.settings_of({"x_embed": {"provider": {"model": "m"}}}, "x_embed").modality == "embedding" and s.calls().per_minute == 7
    bad = [
        ({}, "model"), ({"t": 3}, "mapping"), ({**PROFILES, "t": {}}, "llm_profile"), ({**PROFILES, "t": {"llm_profile": "q"}}, "unknown"), ({"t": {"provider": {"model": "m", "modality": "sound"}}}, "modality"),
        ({"t": {"provider": {"model": "m"}, "rate_limit": {"rpm": 0}}}, "rpm"), ({"t": {"provider": {"model": "m"}, "request": {"thinking": {"enabled": True}}}}, "thinking"),
        ({"t": {"provider": {"model": "m", "supports_thinking": "yes"}}}, "boolean"), ({"t": {"provider": {"model": "m"}, "request": {"image_detail": "most"}}}, "image_detail"),
    ]
    for config, what in bad:
        with pytest.raises(ValueError, match=what):
            models.settings_of(config, "t")


def test_requests():
    s = models.settings_of({"ocr": {"provider": {"model": "m"}}}, "ocr")
    got = models.chat_request(s, [models.Message("user", [("text", "a"), ("image", "data:x")])])
    assert got["messages"][0]["content"][1] == {"type": "image_url", "image_url": {"url": "data:x", "detail": "high"}} and "reasoning_effort" not in got
    text = models.settings_of({**PROFILES, "t": {"llm_profile": "p"}}, "t")
    assert models.chat_request(text, [models.Message("user", "a")])["reasoning_effort"] == "medium"
    with pytest.raises(ValueError, match="text only"):
        models.chat_request(text, [models.Message("user", [("image", "data:x")])])
    with pytest.raises(ValueError, match="modality"):
        models.embedding_request(text, ["a"])
    assert models.embedding_request(models.settings_of({"e": {"provider": {"model": "m", "modality": "embedding"}, "request": {"dimensions": 8}}}, "e"), ["a"])["dimensions"] == 8


def test_prompts_by_mode():
    given = {"extract": {"prompts": {"zs": " z ", "fs": "f", "review_zs": "rz", "review": "r"}}}
    assert extract.prompts_of(given, "Zero-Shot") == ("z", "rz") and extract.prompts_of(given, None) == ("f", "r") and extract.prompts_of({}, "zs") == (extract.PROPOSE, extract.REVIEW)
    assert extract.output_folder("zero_shot", True) == "data/triples/raw-zs-recheck" and extract.output_folder("few-shot", False) == "data/triples/raw-fs"


CHUNKS = "chunk_id long, source_file string, chunk_index int, titles array<string>, content string"


def test_extraction_with_review(spark):
    first = '{"entities": [{"name": "aa", "type": "concept"}], "triples": [{"head": "aa", "relation": "contains", "tail": "bb", "evidence": "aa bb"}, {"head": "aa", "relation": "contains", "tail": "cc", "evidence": "not there"}]}'
    checked = '{"triples": [{"head": "aa", "relation": "contains", "tail": "bb", "evidence": "aa bb", "review": {"decision": "drop", "reason_code": "weak", "reason": "why"}}]}'
    df = spark.createDataFrame([(1, "s", 0, ["T"], "x aa bb")], CHUNKS)
    get = lambda answers, **o: extract.extract_chunks(df, lambda: models.Scripted(list(answers)), extract.ExtractOptions(**o), models.Calls(1)).first()
    plain = get([first])
    assert tuple(plain["stats"]) == (1, 2, 1, 1) and tuple(plain["triples"][0]["evidence_span"]) == (2, 7)
    assert plain["dropped"][0]["candidate"]["tail"] == "cc" and plain["dropped"][0]["review"]["reason_code"] == "EVIDENCE_NOT_IN_CHUNK"
    assert get([first], keep_dropped=False)["stats"]["proposed_triples"] == 1 and len(get([first], strict=False)["triples"]) == 2
    # the second frame's tasks ask the first client's list again, so reviews are told apart by what is asked
    class Both:
        def extract(self, text, prompt):
            return self.answer if prompt == extract.REVIEW else first

    for answer, dropped in ((checked, ["LOW_CONFIDENCE_DROP"]), ("nothing", ["EVIDENCE_NOT_IN_CHUNK"])):
        made = type("Made", (Both,), {"answer": answer})
        got = extract.extract_chunks(df, made, extract.ExtractOptions(review=True)).first()
        assert [d["review"]["reason_code"] for d in got["dropped"]] == dropped
    assert got["status"] == "success" and get(["[1]"])["status"] == "failed" and get([ValueError("down")])["error"] == "down"
    empty = extract.extract_chunks(df.withColumn("content", F.lit(None).cast("string")), lambda: models.Scripted([])).first()
    assert empty["status"] == "success" and tuple(empty["stats"]) == (0, 0, 0, 0)
    with pytest.raises(ValueError, match="mode must be"):
        extract.ExtractOptions("other")


def test_embedding_cache(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "encoded string").coalesce(1)
    got = embed.embed_missing(df, None, lambda: models.Scripted([[[1.0, 0.0], [0.0, 1.0]]]), "m", "v1", 2)
    assert got.count() == 2
    cache = spark.createDataFrame([(r["key"], [1.0, 0.0]) for r in df.select(embed.cache_key(F.col("encoded"), "m", "v1", 2).alias("key")).where("key is not null").distinct().collect()], "key string, vector array<float>")
    assert embed.embed_missing(df, cache, lambda: models.Scripted([]), "m", "v1", 2).count() == 0
    with pytest.raises(Exception, match="another size"):
        embed.embed_missing(df, None, lambda: models.Scripted([[[1.0], [2.0]]]), "m", "v1", 2).collect()


def test_clean_markdown():
    text = "---\nsource: x\n---\n## Page 5\n\n**Model:** m\nbody\n\n\n\n• 115 •\n运输层 119\n1 Intro ..... 7\n　indented"
    out, pages = D.clean(text)
    assert out == "<!-- Page 5 -->\n\nbody\n\n1 Intro\nindented" and pages == {5: {"Model": "m"}}
    assert D.clean(None) == (None, {}) and D.clean("") == ("", {})


def test_chunks_of_sections():
    text = "intro\n\n# A\n\nshort\n\n## B\n\n" + "\n\n".join(f"para {i} " + "w " * 20 for i in range(5))
    ref = D.chunk(text, 60)
    assert [c[0] for c in ref] == [["A"]] and ref[0][1].startswith("# A")
    full = D.chunk(text, 60, "complete")
    assert [c[0] for c in full] == [[], ["A"], ["A", "B"], ["A", "B"], ["A", "B"]] and all(c[2] <= 60 for c in full)
    assert D.chunk("plain", 10)[0][:2] == ([], "plain") and D.chunk("", 10) == []
    assert D.chunk("# A\n\n<!-- Page 3 -->\nbody", 10)[0][3] == 3
    with pytest.raises(ValueError):
        D.chunk("x", 1, "other")


def test_graph_views(spark, rows):
    e = spark.createDataFrame([("a", "concept", "", 5), ("b", "protocol", "", 5), ("c", "other", "", 9)], "name string, type string, description string, frequency long")
    t = spark.createDataFrame([("a", "contains", "b", 2, ["x"]), ("b", "contains", "a", 1, []), ("a", "depends_on", "z", 7, [])], "head string, relation string, tail string, frequency long, evidences array<string>")
    n, l = graph.nodes_of(e), graph.links_of(t)
    assert rows(n, "name") == [("a",), ("b",)] and l.count() == 3
    assert rows(graph.top_nodes(n, 1), "name") == [("a",)] and graph.top_nodes(n, None).count() == 2
    top = graph.top_nodes(n, 2)
    shown = graph.induced_links(l, top, None)
    assert rows(shown, "source", "target") == [("a", "b"), ("b", "a")]
    m = graph.view_meta(n, l, top, shown).first()
    assert m["truncated"] and m["links_dropped"] == 1
    assert rows(graph.parallel_edges(shown), "source", "place", "curvature") == [("a", 0, 0.0), ("b", 1, 0.3)]
    assert [graph.limit_of(v, 9) for v in (None, "", "x", "0", "-1", "3")] == [9, 9, 9, None, None, 3]
    assert graph.visible(n, l, ["Protocol"], [])[1].count() == 0


def test_files(spark, rows, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/s_chunk_0001.json").write_text(json.dumps({"source_file": "s.md", "chunk_index": 1, "entities": [{"name": "甲", "type": "concept"}], "triples": [{"head": "a", "relation": "contains", "tail": "b"}, {"head": "c", "relation": "contains", "tail": "d"}]}, ensure_ascii=False))
    e, t = readers.raw_extractions(spark, str(tmp_path / "raw"))
    assert rows(e, "file_stem", "ord", "name") == [("s_chunk_0001", 0, "甲")]
    assert rows(t, "evidence_id", "chunk_index", "head") == [("s_chunk_0001:T1", "1", "a"), ("s_chunk_0001:T2", "1", "c")]
    assert spark.range(1).select(readers.raw_file_key(F.lit("x/s.md"), F.lit(1)).alias("k")).first()["k"] == "s_chunk_0001"
    (tmp_path / "chunks").mkdir()
    (tmp_path / "chunks/a.json").write_text('[{"titles": ["T"], "content": "c", "chunk_index": 0}]')
    (tmp_path / "chunks/b.json").write_text('{"data": ["x", {"text": "y"}, {"content": "z"}]}')
    assert rows(readers.loose_chunks(spark, str(tmp_path / "chunks")), "file", "place", "content") == [("a.json", 0, "c"), ("b.json", 0, "x"), ("b.json", 1, "y"), ("b.json", 2, "z")]
    assert rows(readers.chunk_files(spark, str(tmp_path / "chunks")).where("file = 'a.json'"), "place", "content") == [(0, "c")]
    docs = tmp_path / "docs"
    (docs / "book").mkdir(parents=True)
    for f in ("A.PDF", "b.pptx", "c.txt", "book/d.png", "e_page_3.png"):
        (docs / f).write_bytes(b"x")
    assert rows(readers.input_documents(spark, str(docs)), "kind") == [("pdf",), ("slides",)]
    assert rows(readers.page_images(spark, str(docs)), "book", "page") == [("book", 0), ("e", 3)]
    assert readers.list_files(spark, str(tmp_path / "none"), (".pdf",)).count() == 0
    (docs / "m_page_2.md").write_text("text")
    assert rows(readers.page_markdown(spark, str(docs)), "book", "page", "text") == [("m", 2, "text")]


@pytest.mark.parametrize("content, what", [
    (None, "not found"), (b"\xff\xfe", "UTF-8"), (b"{", "valid JSON"), (b"[]", "JSON object"), (b'{"triples": {}}', "must be a list"), (b"{}", "missing required field: triples"), (b'{"entities": [{"name": ""}], "triples": []}', r"entities\[0\].name must not be empty"),
    (b'{"triples": [1]}', r"triples\[0\] must be an object"), (b'{"entities": [{"name": "a", "type": "thing"}], "triples": []}', "invalid type"), (b'{"triples": [{"head": "a", "head_type": "concept", "relation": "eats", "tail": "b", "tail_type": "concept"}]}', "invalid relation"),
    (b'{"triples": [{"head": 1}]}', "must be a string"), (b'{"triples": [{"head": "a", "head_type": "concept", "relation": "contains", "tail": "b", "tail_type": "concept", "evidences": [1]}]}', r"evidences\[0\] must be a string"),
])
def test_payload_errors(spark, tmp_path, content, what):
    p = tmp_path / "g.json"
    if content is not None:
        p.write_bytes(content)
    with pytest.raises(readers.PayloadError, match=what):
        readers.check_payload(spark, str(p), "gold")


def test_graph_import_is_idempotent(spark, rows, tmp_path):
    n = spark.createDataFrame([("Concept", "a", 1), ("Concept", "b", 2)], "label string, name string, frequency long")
    l = spark.createDataFrame([("a", "b", "CONTAINS", 1), ("a", "z", "CONTAINS", 1)], "source string, target string, type string, frequency long")
    for _ in range(2):
        assert sinks.import_graph(spark, n, l, str(tmp_path / "g")) == (2, 2, 1)
    sinks.upsert(spark, n.where("name = 'a'").withColumn("frequency", F.lit(9).cast("long")), str(tmp_path / "g/nodes"), ["label", "name"])
    assert rows(spark.read.parquet(str(tmp_path / "g/nodes")), "name", "frequency") == [("a", 9), ("b", 2)]
    sinks.clear_graph(spark, str(tmp_path / "g"))
    assert not (tmp_path / "g").exists()


def test_tables_survive_a_crash_of_the_upsert(spark, rows, tmp_path):
    n = spark.createDataFrame([("Concept", "a", 1)], "label string, name string, frequency long")
    path = str(tmp_path / "t")
    sinks.upsert(spark, n, path, ["name"])
    (tmp_path / "t").rename(tmp_path / "t.old")  # between the two moves
    sinks.upsert(spark, n.withColumn("name", F.lit("b")), path, ["name"])
    assert rows(spark.read.parquet(path), "name") == [("a",), ("b",)] and not (tmp_path / "t.old").exists()


def test_reports():
    assert reports.code("a|b") == "`a\\|b`" and reports.code("x``y\n") == "``` x``y  ```"
    assert reports.table(["a", "b"], [["x", 0.5], [None, 2]], 1) == "| a | b |\n| --- | ---: |\n| x | 0.5000 |\n|  | 2 |"
    c = reports.comparison({"metrics": {"triple": {"f1": 0.25}}}, {"metrics": {"triple": {"f1": 0.5}, "attribute_accuracy": {"relation": {"accuracy": 1.0}}}}, "now")
    assert c["comparison"]["triple"]["delta_f1"] == 0.25 and "| Triple | F1 | 0.2500 | 0.5000 | +0.2500 |" in reports.comparison_markdown(c)


def test_files_of_any_file_system(spark, tmp_path):
    path = f"file://{tmp_path}/a/b.txt"
    files.write_text(spark, path, "文")
    files.write_text(spark, path, "x" * 10)
    assert files.read_bytes(spark, path) == b"x" * 10 and files.names(spark, f"{tmp_path}/a")[-1] == "b.txt"
    with pytest.raises(FileNotFoundError):
        files.read_bytes(spark, f"{tmp_path}/none")
    with pytest.raises(RuntimeError), files.Writer(spark, f"{tmp_path}/a/c.txt") as f:
        f.write("half")
        raise RuntimeError
    assert not files.exists(spark, f"{tmp_path}/a/c.txt")


def test_ocr_markdown(spark):
    p = spark.createDataFrame(
        [(2, "b", "i", 2, None, "t2", None, "m", "failed", "late", 1.0, None), (1, "b", "i", 1, "one", "t1", 0.5, None, "success", None, 2.346, 9)],
        "page_id long, book string, image_path string, page_number int, text string, processed_at string, confidence double, model string, status string, error string, duration_seconds double, total_tokens int",
    )
    md = sinks.ocr_markdown(p).first()["markdown"]
    assert "successful_pages: 1\nfailed_pages: 1\nocr_model: m\nprocessed_at: t2" in md and md.index("## Page 1") < md.index("## Page 2") and "**Error:** late" in md and "_No text extracted._" in md
    pages = D.clean(md)[1]
    assert pages[1] == {"Image": "i", "Processed": "t1", "Duration": "2.35s", "Confidence": "0.50", "Total Tokens": "9"} and pages[2]["Status"] == "failed"
    assert D.page_body(sinks.ocr_markdown(p.where("page_id = 1")).first()["markdown"]) == "one"


def test_cached_pages(spark, rows, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b/b_page_1.md").write_text("---\nsource: b\n---\n## Page 1\n\n**Image:** `i`  \n\nbody\n---\nmore")
    (tmp_path / "b/b_page_2.md").write_text(" \n")
    got = readers.cached_pages(spark, str(tmp_path))
    assert rows(got, "book", "page", "text", "status") == [("b", 1, "body\nmore", "success")]


def test_small_columns(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first()["x"]
    from kiteloom.functions import text as X

    assert get(X.folder_name(F.lit(" a/b\\c "))) == "a_b_c" and get(X.folder_name(F.lit(" "))) == "document"
    assert get(X.data_url(F.lit(b"\xff" * 90), F.lit("a.JPG"))).startswith("data:image/jpeg;base64,////") and get(X.media_type(F.lit("a"))) == "image/png"
    assert get(X.parsed_evidences(F.lit('["a", "b"]'))) == ["a", "b"] and get(X.parsed_evidences(F.lit("plain"))) == ["plain"] and get(X.parsed_evidences(F.lit(None).cast("string"))) == []


def test_rendering(spark, rows):
    class Two:
        def pages(self, document, dpi):
            if document == b"bad":
                raise ValueError("broken")
            yield from ((1, b"x"), (2, b"y"))

    d = spark.createDataFrame([("a", bytearray(b"ok")), ("b", bytearray(b"bad"))], "path string, content binary")
    got = render.render(d, Two, wanted=[2, 9])
    assert rows(got, "path", "page", "status") == [("a", 2, "success"), ("b", None, "failed")]
    images = got.where("image is not null").select("path", "image")
    assert rows(render.read_pages(images, lambda: models.Scripted(["text"])), "text") == [("text",)]
    assert render.read_pages(images, lambda: models.Scripted([]), images.withColumn("status", F.lit("success"))).count() == 0
    assert render.page_name("a", 7) == "a_page_0007.png" and render.zoom(144) == 2.0


def test_slides(spark, rows, tmp_path):
    done = lambda code, out=None: lambda *a, **k: (out and (tmp_path / out).write_bytes(b"pdf"), type("R", (), {"returncode": code, "stderr": b"bad", "stdout": b""})())[1]
    assert render.slides_to_pdf("x.ppt", str(tmp_path), "no-such-program")[0] == "failed"
    assert render.slides_to_pdf("x.ppt", str(tmp_path), run=done(0)) == ("failed", "libreoffice left no x.pdf")
    assert render.slides_to_pdf("x.ppt", str(tmp_path), run=done(2))[1] == "exit code 2: bad"
    assert render.slides_to_pdf("x.ppt", str(tmp_path), run=done(0, "x.pdf")) == ("success", None)

    class One:
        def pages(self, document, scale):
            yield 1, document

    def convert(source, folder):
        import pathlib

        pathlib.Path(folder, pathlib.Path(source).stem + ".pdf").write_bytes(b"made")
        return "success", None

    d = spark.createDataFrame([("/a/p.pptx", "slides", bytearray(b"s")), ("/a/q.pdf", "pdf", bytearray(b"q")), ("/a/r.txt", "other", bytearray(b"r"))], "path string, kind string, content binary")
    got = render.render(d, One, convert=convert)
    assert rows(got, "name", "image", "status") == [("p/p_page_0001.png", bytearray(b"made"), "success"), ("q/q_page_0001.png", bytearray(b"q"), "success"), (None, None, "failed")]
    assert rows(render.run_summary(got), "path", "status", "pages") == [("/a/p.pptx", "success", 1), ("/a/q.pdf", "success", 1), ("/a/r.txt", "failed", 0)]


def test_streams(spark, rows, tmp_path):
    schema = "entity_id long, file_stem string, ord long, name string, type string, description string, frequency long"
    for k in range(5):
        spark.createDataFrame([(k, "f", k, "TCP", "protocol", f"d{k}", 2)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.stream_entities(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "cp"), every=2).awaitTermination(60)
    assert rows(incremental.latest_state(spark, str(tmp_path / "state")), "name", "description", "frequency") == [("TCP", "d0", 10)]
    assert files.names(spark, str(tmp_path / "state")) == ["b000000004", "m000000003"]
    assert incremental.latest_state(spark, str(tmp_path / "none")).count() == 0
    events = spark.createDataFrame([(1, "error"), (2, "view")], "i int, event_type string").withColumn("ts", F.lit("2026-01-01 00:00:30").cast("timestamp_ntz"))
    assert [(r["requests"], r["errors"]) for r in incremental.request_rates(events).collect()] == [(2, 1)]
