import json

import pytest

from kiteloom import cli, config

PLUGINS = "plugins: {renderer: 'tests.fakes:renderer', reader: 'tests.fakes:reader', extractor: 'tests.fakes:extractor', embedder: 'tests.fakes:embedder', judge: 'tests.fakes:judge'}\n"


def test_built_in_values(tmp_path):
    run = config.load(str(tmp_path / "missing.yaml"))["run"]
    assert run["kg_merge"]["embedding"]["llm_recheck"]["enabled"] is True and run["md_chunk"]["max_tokens"] == 4000


def test_file_over_built_in_values(tmp_path, caplog):
    f = tmp_path / "c.yaml"
    f.write_text("ocr: {x: 1}\nrun:\n  kg_merge: {embedding: {candidate_threshold: 0.8}}\n  pdf_to_png: {pdf: a.pdf}\n  kg_eval_raw: {gold: g.json}\n  unheard: {a: 1}\n  md_chunk: 3\n")
    c = config.load(str(f))
    emb = c["run"]["kg_merge"]["embedding"]
    assert (emb["candidate_threshold"], emb["similarity_threshold"], c["ocr"]) == (0.8, 0.85, {"x": 1})
    assert c["run"]["pdf_to_png"]["input_file"] == "a.pdf" and c["run"]["kg_eval_raw"]["gold"] == "g.json"
    assert c["run"]["md_chunk"]["max_tokens"] == 4000 and "unheard" not in c["run"] and "unheard" in caplog.text
    assert config.DEFAULTS["kg_merge"]["embedding"]["candidate_threshold"] == 0.78
    for bad in ("[1]", "run: 3", "a: [", ""):
        f.write_text(bad)
        assert config.load(str(f))["run"] == config.DEFAULTS


@pytest.mark.parametrize(
    "first, last, no_graph, want",
    [
        (None, None, False, list(cli.STAGES)), (None, None, True, list(cli.STAGES)[:-1]), ("md-chunk", "kgmerge", False, None), ("mdchunk", "kgmerge", False, ["mdchunk", "kgextract", "kgmerge"]),
        ("kgmerge", "kgneo4j", True, ["kgmerge"]), ("combine", "Combine", False, ["kgmdcombine"]), ("kgmerge", "mdchunk", False, None), ("neo4j", None, True, None), ("x", None, False, None),
    ],
)
def test_stages(first, last, no_graph, want):
    if want is None:
        with pytest.raises(cli.Stop):
            cli.selected(first, last, no_graph)
    else:
        assert cli.selected(first, last, no_graph) == want


def test_stages_run_in_order_and_stop_at_a_failure(monkeypatch, capsys):
    seen = []
    monkeypatch.setattr(cli, "STAGES", {n: lambda s, c, n=n: seen.append(n) or (3 if n == "kgextract" else 0) for n in cli.STAGES})
    assert cli.pipeline(None, {"run": {"pipeline": {"from_stage": "mdchunk", "to_stage": None, "no_neo4j": False}}}) == 3
    assert seen == ["mdchunk", "kgextract"] and "exited with 3" in capsys.readouterr().err


def test_only_a_configuration_is_taken(capsys):
    with pytest.raises(SystemExit):
        cli.main(["kgextract", "--mode", "zs"])
    assert cli.main(["--list"]) == 0 and "kgmerge" in capsys.readouterr().out


def run(spark, tmp_path, command, section=""):
    f = tmp_path / "config.yaml"
    f.write_text(PLUGINS + "entity_embed: {provider: {model: m}, request: {dimensions: 8}}\nrun:\n" + section)
    return cli.main([command, "--config", str(f)], spark)


def test_from_documents_to_the_graph(spark, tmp_path, capsys):
    d = tmp_path
    (d / "pdf").mkdir()
    page = "# 协议\n\n课文把滑动窗口与停等协议作了对比。比较滑动窗口与拥塞窗口。"
    (d / "pdf/net.pdf").write_text(f"{page}|滑动窗口依赖停等协议。|dark")
    (d / "pdf/lost.pdf").write_bytes(b"bad")
    paths = f"  pipeline: {{no_neo4j: false}}\n  pdf_to_png: {{pdf_dir: {d}/pdf, image_dir: {d}/png}}\n  png_to_text: {{image_dir: {d}/png, text_dir: {d}/md}}\n  kg_md_combine: {{markdown_dir: {d}/md}}\n  md_chunk: {{markdown_dir: {d}/md, chunk_dir: {d}/chunks}}\n  kg_extract: {{input: {d}/chunks, output_dir: {d}/triples/raw}}\n  kg_merge: {{input_dir: {d}/triples/raw, output: {d}/merged.json}}\n  kg_neo4j: {{import_file: {d}/merged.json, uri: {d}/graph, stats: true}}\n"
    assert run(spark, d, "pdftopng", paths) == 0 and (d / "png/net/net_page_0003.png").read_bytes() == b"dark"
    assert run(spark, d, "pngtotext", paths) == 1  # one page fails
    assert "nothing to see" in capsys.readouterr().err and not (d / "md/net/net_page_0003.md").exists()
    (d / "png/net/net_page_0003.png").unlink()
    first = (d / "md/net/net_page_0001.md").stat().st_mtime_ns
    assert run(spark, d, "pngtotext", paths) == 0 and (d / "md/net/net_page_0001.md").stat().st_mtime_ns == first
    assert run(spark, d, "kgmdcombine", paths) == 0 and (d / "md/net.md").read_text() == page + "\n\n滑动窗口依赖停等协议。"
    assert run(spark, d, "mdchunk", paths) == 0
    chunks = json.loads((d / "chunks/net.json").read_text())
    assert [(c["titles"], c["chunk_index"]) for c in chunks] == [(["协议"], 0)] and chunks[0]["source_file"].endswith("net.md")
    assert run(spark, d, "kgextract", paths) == 0
    raw = json.loads((d / "triples/raw/net_chunk_0000.json").read_text())
    assert raw["stats"]["kept_triples"] == len(raw["triples"]) == 3 and raw["triples"][0]["evidence_span"]["start"] >= 0
    capsys.readouterr()
    assert run(spark, d, "kgextract", paths) == 0 and "0 succeeded" in capsys.readouterr().out
    assert run(spark, d, "kgmerge", paths) == 0
    merged = json.loads((d / "merged.json").read_text())
    assert {e["name"] for e in merged["entities"]} == {"滑动窗口", "停等", "拥塞窗口"} and merged["stats"]["total_triples"] == 3
    assert merged["merge_audit"]["summary"]["strategy"] == "recheck"
    assert run(spark, d, "kgneo4j", paths) == 0
    out = capsys.readouterr().out
    assert '"nodes": 3' in out and '"relationships": 3' in out
    gold = {"triples": [t for t in merged["triples"]][:2]}
    (d / "gold.json").write_text(json.dumps(gold, ensure_ascii=False))
    assert run(spark, d, "kgeval", f"  kg_eval: {{pred: {d}/merged.json, gold: {d}/gold.json, output_json: {d}/r.json, output_md: {d}/r.md}}\n") == 0
    report = json.loads((d / "r.json").read_text())
    assert report["metrics"]["triples"]["tp"] == 2 and report["metrics"]["triples"]["fp"] == 1 and report["evidence"]["pred_coverage"] == 1.0
    assert "| Triple | 3 | 2 | 2 | 1 | 0 |" in (d / "r.md").read_text()
    assert run(spark, d, "kgevalrelaxed", f"  kg_eval_relaxed: {{pred: {d}/merged.json, gold: {d}/gold.json, output_json: {d}/x.json}}\n") == 0
    assert json.loads((d / "x.json").read_text())["triple"]["substring"]["fn"] == 0
    judge = f"  kg_eval_judge: {{pred: {d}/merged.json, gold: {d}/gold.json, output_json: {d}/j.json, align_cache: {d}/a.json}}\n"
    assert run(spark, d, "kgevaljudge", judge) == 0  # gold has no entities to align
    assert json.loads((d / "j.json").read_text())["summary"]["recall"] == 0.0 and json.loads((d / "a.json").read_text()) == []
    (d / "a.json").unlink()
    gold["entities"] = merged["entities"]
    (d / "gold.json").write_text(json.dumps(gold, ensure_ascii=False))
    for _ in range(2):  # the second time from the alignment kept
        assert run(spark, d, "kgevaljudge", judge) == 0
        assert json.loads((d / "j.json").read_text())["summary"]["recall"] == 1.0
    for t in gold["triples"]:
        t |= {"source_file": "net.json", "chunk_index": 0}
    gold["triples"].append({**gold["triples"][0], "chunk_index": 7})
    (d / "gold.json").write_text(json.dumps(gold, ensure_ascii=False))
    assert run(spark, d, "kgevalraw", f"  kg_eval_raw: {{zs_raw_dir: {d}/triples/raw, fs_raw_dir: {d}/triples/raw, gold: {d}/gold.json, output_json: {d}/w.json, output_md: {d}/w.md}}\n") == 0
    zs = json.loads((d / "w_zs.json").read_text())
    assert zs["meta"]["chunks_matched_raw"] == 1 and zs["meta"]["chunks_missing_raw"] == 1 and json.loads((d / "w_comparison.json").read_text())["comparison"]["triple"]["delta_f1"] == 0.0
    assert "| Triple | F1 |" in (d / "w.md").read_text()
    capsys.readouterr()
    assert run(spark, d, "inventory", f"  inventory: {{data_dir: {d}, output: {d}/i.md}}\n") == 0
    said = (d / "i.md").read_text()
    assert "| PDF files | 2 |" in said and "| `raw` | 1 |" in said


@pytest.mark.parametrize(
    "command, section, said",
    [
        ("pdftopng", "  pdf_to_png: {pdf_dir: /none}\n", "not found"), ("mdchunk", "  md_chunk: {output: x}\n", "requires run.md_chunk.input_file"), ("mdchunk", "  md_chunk: {markdown_dir: /none}\n", "not found"),
        ("kgextract", "  kg_extract: {mode: other}\n", "mode must be one of"), ("kgeval", "", "gold must be set"), ("kgevalraw", "", "gold must be set"), ("kgeval", "  kg_eval: {pred: /none, gold: /none}\n", "pred file not found"),
        ("run", "  pipeline: {from_stage: kgmerge, to_stage: mdchunk}\n", "must not be after"), ("kgneo4j", "  kg_neo4j: {import_file: null}\n", "must be set"),
    ],
)
def test_errors(spark, tmp_path, capsys, command, section, said):
    assert run(spark, tmp_path, command, section) == 1 and said in capsys.readouterr().err
