"""Comparison of two models' scored generations: gate, metrics, changes, intervals, gaps, and a rendered page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from . import scoring


@dataclass
class Comparison:
    metrics: DataFrame
    deltas: DataFrame
    intervals: DataFrame
    gaps: DataFrame


def compared(scored: DataFrame, reference: str, candidate: str, root: str, replicates: int = 2000, seed: str = "1") -> Comparison:
    """Reports over scored (model_kind, language, example_id, components). Both cohorts must have the same examples."""
    scored = scored.select("model_kind", "language", "example_id", *[f"{m}_{p}" for m in scoring.METRICS for p in ("num", "den")]).persist()
    one, other = scored.where(scored["model_kind"] == reference), scored.where(scored["model_kind"] == candidate)
    ids = lambda df: df.select("example_id", "language")
    if not ids(one).exceptAll(ids(other)).isEmpty() or not ids(other).exceptAll(ids(one)).isEmpty():
        raise ValueError("the cohorts differ")
    measured = scoring.metrics(scored, "model_kind")
    return Comparison(measured, scoring.deltas(measured, reference, candidate), scoring.bootstrap(one, other, replicates, seed, "language"), scoring.gaps(measured, root, "model_kind"))


def rendered(title: str, comparison: Comparison) -> str:
    """Markdown of a comparison; its frames have a few rows for each language."""
    bounds = {(r["language"], r["metric"]): (r["lower"], r["upper"]) for r in comparison.intervals.collect()}
    lines = [f"# {title}", "", "| Language | Metric | Change | 95 % interval |", "| --- | --- | --- | --- |"]
    for r in sorted(comparison.deltas.collect(), key=lambda r: (r["language"] is None, r["language"] or "", r["metric"])):
        interval = bounds.get((r["language"], r["metric"]))
        lines.append(f"| {r['language'] or 'all'} | {r['metric']} | {r['delta']:+.4f} | " + (f"{interval[0]:+.4f} to {interval[1]:+.4f}" if interval else "") + " |")
    lines += ["", "| Model | Language | Metric | Gap |", "| --- | --- | --- | --- |"]
    lines += [f"| {r['model_kind']} | {r['language']} | {r['metric']} | {r['gap']:+.4f} |" for r in sorted(comparison.gaps.collect(), key=lambda r: (r["model_kind"], r["language"], r["metric"]))]
    return "\n".join(lines) + "\n"
