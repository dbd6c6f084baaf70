"""Configuration of the pipeline: built-in values, and a YAML file on top."""

from __future__ import annotations

import importlib
import logging
from copy import deepcopy
from pathlib import Path

log = logging.getLogger(__name__)

#: Sections of ``run`` and what they hold if the file says nothing.
DEFAULTS: dict[str, dict] = {
    "pipeline": {"from_stage": None, "to_stage": None, "no_neo4j": False},
    "pdf_to_png": {"input_file": None, "pdf_dir": "data/pdf", "image_dir": "data/png", "dpi": 200, "recursive": False, "libreoffice": "libreoffice", "ppt_timeout": 300},
    "png_to_text": {"input_file": None, "output": None, "image_dir": "data/png", "text_dir": "data/markdown", "recursive": True, "lang": "ch", "gpu": False, "force_ocr": False},
    "md_chunk": {"input_file": None, "output": None, "markdown_dir": "data/markdown", "chunk_dir": "data/chunks", "max_tokens": 4000, "recursive": False},
    "kg_md_combine": {"markdown_dir": "data/markdown", "page_glob": "*_page_*.md"},
    "kg_extract": {"input": "data/chunks", "output_dir": None, "mode": "fs", "no_skip": False, "review": False, "strict_evidence": True, "keep_dropped": True, "extractor_version": "kgextract_v2"},
    "kg_merge": {
        "input_dir": "data/triples/raw-fs",
        "output": "data/triples/merged/merged_triples.json",
        "embedding": {
            "enabled": True, "task_name": "entity_embed", "encode_fields": ["type", "name", "description"], "candidate_threshold": 0.78, "similarity_threshold": 0.85,
            "direct_merge_without_recheck": False, "bucket_by_type": True, "batch_size": 1024, "cache_path": "data/triples/merged/.embed_cache.json",
            "llm_recheck": {
                "enabled": True, "task_name": "entity_merge_review", "max_pairs": 200, "context_triples_per_entity": 8, "require_supporting_evidence": True,
                "allow_merge_with_truncated_context": False, "max_cluster_size": 4, "require_complete_pairwise_cluster": True,
            },
        },
    },
    "kg_neo4j": {"import_file": "data/triples/merged/merged_triples.json", "uri": "data/graph", "user": None, "clear": False, "stats": False},
    "kg_eval": {"pred": "data/triples/merged/merged_triples.json", "gold": None, "output_json": None, "output_md": None, "top_errors": 10},
    "kg_eval_raw": {"zs_raw_dir": None, "fs_raw_dir": None, "gold": None, "output_json": None, "output_md": None},
    "kg_eval_relaxed": {"pred": "data/triples/merged/merged_triples.json", "gold": None, "output_json": None, "name": None},
    "kg_eval_judge": {"pred": "data/triples/merged/merged_triples.json", "gold": None, "output_json": None, "align_cache": None, "align_only": False},
    "inventory": {"data_dir": "data", "output": None},
}
#: Names that settings had before.
OLD_NAMES = {"pdf_to_png": {"pdf": "input_file"}, "png_to_text": {"image": "input_file"}, "md_chunk": {"markdown": "input_file"}, "kg_neo4j": {"import": "import_file"}}
#: Where a file is looked for in the working folder.
FILES = ("config.yaml", "config.yml")


def over(base: dict, top: dict) -> dict:
    """``base`` with ``top`` on it, mapping by mapping; neither is changed."""
    both = {k: over(v, top[k]) if isinstance(v, dict) and isinstance(top.get(k), dict) else deepcopy(top.get(k, v)) for k, v in base.items()}
    return both | {k: deepcopy(v) for k, v in top.items() if k not in base}


def find(path: str | None = None) -> Path | None:
    """The file to read: the one named, else the first of ``FILES`` there is."""
    named = [Path(path).expanduser()] if path is not None else [Path.cwd() / f for f in FILES]
    return next((p for p in named if p.exists()), None)


def _file(path: str | None) -> dict:
    at = find(path)
    if at is None:
        return {}
    try:
        import yaml
    except ImportError:
        log.warning("PyYAML is not installed; %s is not read", at)
        return {}
    try:
        data = yaml.safe_load(at.read_text(encoding="utf-8"))
    except (OSError, ValueError, yaml.YAMLError) as error:
        log.warning("%s can't be read: %s", at, error)
        return {}
    if data is not None and not isinstance(data, dict):
        log.warning("%s holds no mapping and is not used", at)
    return data if isinstance(data, dict) else {}


def load(path: str | None = None) -> dict:
    """The whole configuration: the file's other sections as they are, and ``run`` over the built-in values. Sections of ``run``
    that are unknown or no mappings are left out with a warning."""
    data = _file(path)
    run = data.get("run") or {}
    if not isinstance(run, dict):
        log.warning("run is no mapping and is not used")
        run = {}
    taken: dict[str, dict] = {}
    for name, section in run.items():
        if name not in DEFAULTS or not isinstance(section, dict):
            log.warning("run.%s is %s and is not used", name, "no mapping" if name in DEFAULTS else "unknown")
            continue
        old = OLD_NAMES.get(name, {})
        taken[name] = {**{new: section[was] for was, new in old.items() if was in section}, **section}
    return {**data, "run": over(DEFAULTS, taken)}


def plugin(config: dict, name: str):
    """What makes a client, named under plugins as "module:function"; it gets the configuration. None if it isn't named."""
    said = (config.get("plugins") or {}).get(name)
    if not said:
        return None
    module, _, function = said.partition(":")
    made = getattr(importlib.import_module(module), function or "make")
    return lambda: made(config)
