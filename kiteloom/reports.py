"""Reports on results that are a few rows: evaluation, comparison of runs, relaxed tiers, the judge, inventories."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.text import norm_name
from .operators import evaluate as V

METRICS = ("precision", "recall", "f1")


def code(value) -> str:
    """A value as inline code in a table's cell; the fence is longer than any run of backticks in it."""
    text = re.sub(r"[\r\n]", " ", str(value)).replace("|", "\\|")
    longest = max((len(m) for m in re.findall(r"`+", text)), default=0)
    fence = "`" * (longest + 1)
    return f"{fence} {text} {fence}" if longest else f"{fence}{text}{fence}"


def table(columns: list[str], rows: list[list], right: int = 0) -> str:
    """A Markdown table; columns from ``right`` on hold numbers. Floats have four decimals."""
    cell = lambda v: f"{v:.4f}" if isinstance(v, float) else "" if v is None else str(v)
    rule = ["---" if i < right else "---:" for i in range(len(columns))]
    return "\n".join(f"| {' | '.join(map(cell, r))} |" for r in [columns, rule, *rows])


def _one(df: DataFrame) -> dict:
    return df.collect()[0].asDict()


def _counts(pred: DataFrame, gold: DataFrame, keys: list[str]) -> dict:
    """Scores with the number of distinct keys of either side."""
    s = _one(V.strict(pred, gold, keys))
    return {"pred_count": s["tp"] + s["fp"], "gold_count": s["tp"] + s["fn"], **s}


def strict_report(pred: tuple[DataFrame, DataFrame], gold: tuple[DataFrame, DataFrame], evaluated_at: str, top_errors: int = 20, **meta) -> dict:
    """Strict evaluation of a graph (entities, triples with ``evidenced``) against gold; gold entities are those of its triples
    where none are given."""
    (pe, pt), (ge, gt) = pred, gold
    if top_errors < 0:
        raise ValueError("top_errors must be greater than or equal to 0")
    wrong = {k: [r.asDict() for r in V.errors(pt, gt, side, top_errors).collect()] for k, side in (("false_positives", "fp"), ("false_negatives", "fn"))}
    named = V.entities_from(gt) if ge.isEmpty() else ge
    covered = _one(V.evidence_coverage(pt, gt))
    return {
        "meta": {**meta, "evaluated_at": evaluated_at},
        "metrics": {"entities": _counts(pe, named, V.ENTITY), "triples": _counts(pt, gt, V.TRIPLE)},
        "evidence": {"pred_coverage": covered["predicted"], "tp_coverage": covered["true"]},
        "errors": wrong,
    }


def _errors_table(rows: list[dict]) -> str:
    return table(["Head", "Head Type", "Relation", "Tail", "Tail Type"], [[code(r[c]) for c in V.TRIPLE] for r in rows], 5) if rows else "_None_"


def strict_markdown(report: dict) -> str:
    m, e = report["metrics"], report["evidence"]
    names = ("pred_count", "gold_count", "tp", "fp", "fn", *METRICS)
    rows = [[label, *[m[k][n] for n in names]] for label, k in (("Entity", "entities"), ("Triple", "triples"))]
    share = lambda c, n: f"{round(c * n)}/{n} ({c:.4f})"
    parts = [
        "# Evaluation", "## Inputs", "\n".join(f"- {k}: {code(v)}" for k, v in report["meta"].items()),
        "## Scores", table(["Scope", "Pred", "Gold", "TP", "FP", "FN", "Precision", "Recall", "F1"], rows, 1),
        "## Evidence", f"Predicted triples with evidence: {share(e['pred_coverage'], m['triples']['pred_count'])}\nTrue positives with evidence: {share(e['tp_coverage'], m['triples']['tp'])}",
        "## False positives", _errors_table(report["errors"]["false_positives"]), "## False negatives", _errors_table(report["errors"]["false_negatives"]),
    ]
    return "\n\n".join(parts) + "\n"


def raw_report(scores: list[dict], attributes: list[dict], run: str, **meta) -> dict:
    """Of one run the scores by scope and the accuracy by attribute."""
    own = {r["scope"]: {k: v for k, v in r.items() if k not in ("run", "scope")} for r in scores if r["run"] == run}
    acc = {r["attribute"]: {k: v for k, v in r.items() if k != "attribute"} for r in attributes}
    return {"meta": {"run": run, **meta}, "metrics": {**own, "attribute_accuracy": acc}}


def comparison(zs: dict, fs: dict, compared_at: str) -> dict:
    """Two raw reports beside one another; what one of them lacks counts as 0."""
    value = lambda r, *path: r["metrics"].get(path[0], {}).get(path[1], 0) if len(path) == 2 else r["metrics"].get("attribute_accuracy", {}).get(path[0], {}).get("accuracy", 0)
    out: dict = {}
    for scope in ("entity", "triple", "relation"):
        out[scope] = {}
        for m in METRICS:
            a, b = value(zs, scope, m), value(fs, scope, m)
            out[scope] |= {f"zs_{m}": a, f"fs_{m}": b, f"delta_{m}": b - a}
    out["attribute_accuracy"] = {}
    for name in ("head_type", "tail_type", "relation"):
        a, b = value(zs, name), value(fs, name)
        out["attribute_accuracy"][name] = {"zs_accuracy": a, "fs_accuracy": b, "delta": b - a}
    return {"meta": {"comparison_at": compared_at}, "comparison": out}


def comparison_markdown(report: dict) -> str:
    c = report["comparison"]
    plus = lambda v: f"{v:+.4f}"
    scopes = [[s.capitalize(), m.capitalize(), float(c[s][f"zs_{m}"]), float(c[s][f"fs_{m}"]), plus(c[s][f"delta_{m}"])] for s in ("entity", "triple", "relation") for m in METRICS]
    names = [[n, float(x["zs_accuracy"]), float(x["fs_accuracy"]), plus(x["delta"])] for n, x in c["attribute_accuracy"].items()]
    parts = [
        "# Raw extraction: ZS and FS", f"Compared at {code(report['meta']['comparison_at'])}", "## Scores", table(["Scope", "Metric", "ZS", "FS", "FS − ZS"], scopes, 2),
        "## Attribute accuracy", table(["Attribute", "ZS", "FS", "FS − ZS"], names, 1), "Predictions count in chunks that gold covers; types come from the chunk's own entities.",
    ]
    return "\n\n".join(parts) + "\n"


def relaxed_report(pred: tuple[DataFrame, DataFrame], gold: tuple[DataFrame, DataFrame]) -> dict:
    """All tiers of relaxed evaluation: entities strict, by normalised name, by alias; triples also by substring and by head and
    relation; relations by types."""
    (pe, pt), (ge, gt) = pred, gold
    ge = V.entities_from(gt).withColumns({"description": F.lit(""), "at": F.lit(0)}) if ge.isEmpty() else ge
    given = lambda t: t.where(" and ".join(f"trim({c}) != ''" for c in V.TRIPLE))
    p, g = V.normed(pt), V.normed(gt)
    entity = {"strict": _one(V.strict(pe, ge, V.ENTITY)), **{r["tier"]: {k: v for k, v in r.asDict().items() if k != "tier"} for r in V.entity_match(pe, ge).collect()}}
    triple = {
        "strict": _one(V.strict(given(pt), given(gt), V.TRIPLE)), "name_norm": _one(V.strict(p, g, V.TRIPLE)),
        "alias": _one(V.alias_match(pt, gt, V.alias_index(pe, True), V.alias_index(ge, False))), "substring": _one(V.substring_match(p, g)), "head_relation": _one(V.head_relation_match(*[t.where("head != '' and relation != ''").withColumn("head", norm_name("head")) for t in (pt, gt)])),
    }
    relation = _one(V.strict(*[t.where(" and ".join(f"trim({c}) != ''" for c in V.RELATION)) for t in (pt, gt)], V.RELATION))
    return {"entity": entity, "triple": triple, "relation_level": relation}


def relaxed_markdown(report: dict, name: str) -> str:
    percent = lambda v: f"{v * 100:.2f}%"
    row = lambda scope, tier, x: [scope, tier, x["tp"], x["fp"], x["fn"], *[percent(x[m]) for m in METRICS]]
    rows = [row(s.capitalize(), t, x) for s in ("entity", "triple") for t, x in report[s].items()] + [row("Relation", "type-only", report["relation_level"])]
    return f"## {name}\n\n" + table(["Scope", "Tier", "TP", "FP", "FN", "P", "R", "F1"], rows, 2) + "\n"


def judge_report(judged: DataFrame, align: DataFrame, **meta) -> dict:
    """``judged`` of ``judge_recall`` and the one row of ``align_summary``: the summary, and the hits and misses one by one (gold
    triples are a bounded set)."""
    rows = [r.asDict() for r in judged.orderBy(*V.TRIPLE).collect()]
    s = _one(V.recall_summary(judged))
    return {
        "meta": meta,
        "summary": {"total_gold_triples": s["total"], "tp": s["total"] - s["missed"], "fn": s["missed"], "recall": s["recall"], "hits_breakdown": {k: s[k] for k in ("exact_relation", "relation_judge")}},
        "align_count": _one(align), "hits": [r for r in rows if r["match_kind"] != "missed"], "misses": [r for r in rows if r["match_kind"] == "missed"],
    }


def inventory_markdown(counts: dict, groups: list[dict], generated_at: str, folder: str) -> str:
    """Counts by name, and triples by group (``group, files, entities, triples``)."""
    n = lambda v: f"{v:,}"
    parts = [
        "# Inventory", f"- Generated at: {code(generated_at)}\n- Folder: {code(folder)}", "## Summary", table(["What", "Count"], [[k, n(v)] for k, v in counts.items()], 1),
        "## Triples by folder", table(["Folder", "Files", "Entities", "Triples"], [[code(g["group"]), *[n(g[c]) for c in ("files", "entities", "triples")]] for g in groups], 1),
    ]
    return "\n\n".join(parts) + "\n"
