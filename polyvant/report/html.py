"""A self-contained HTML page: no scripts, no external resources."""

from __future__ import annotations

import os
from html import escape

from pyspark.sql import functions as F

from ..operators import composition
from ..plans.evaluate import Report
from .text import episode_rows

STYLE = """
:root{--ink:#1d2433;--soft:#667085;--line:#e2e6ee;--bar:#4668b8;--good:#1b7f4d;--bad:#b3261e;--warn:#9a6700;--none:#667085}
body{font:15px/1.5 system-ui,sans-serif;color:var(--ink);max-width:1100px;margin:2rem auto;padding:0 1rem}
h1{margin-bottom:0}.sub{color:var(--soft)}.tiles{display:flex;gap:1rem;flex-wrap:wrap;margin:1rem 0}
.tile{border:1px solid var(--line);border-radius:8px;padding:.6rem 1rem;min-width:7rem}.tile b{display:block;font-size:1.4rem}
.card{border:1px solid var(--line);border-left:4px solid var(--none);border-radius:8px;padding:.8rem 1rem;margin:.8rem 0}
.PASS{border-left-color:var(--good)}.FAIL{border-left-color:var(--bad)}.WARN{border-left-color:var(--warn)}
table{border-collapse:collapse;width:100%;font-size:.9rem}td,th{text-align:left;border-bottom:1px solid var(--line);padding:.25rem .5rem}
td.n,th.n{text-align:right;font-variant-numeric:tabular-nums}svg{max-width:100%}summary{cursor:pointer;color:var(--soft)}
"""


def cell(v: object) -> str:
    return escape("" if v is None else " / ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v))


def table(head: list[str], rows: list[list[object]]) -> str:
    top = "".join(f"<th>{escape(h)}</th>" for h in head)
    return f"<table><thead><tr>{top}</tr></thead><tbody>" + "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r) + "</tr>" for r in rows) + "</tbody></table>"


def bars(items: list[tuple[str, float, str]], limit: float | None = None) -> str:
    """Horizontal bars (label, value, note), and a line at ``limit``."""
    if not items:
        return ""
    top = max([limit or 0, *(v for _, v, _ in items)]) * 1.05 or 1
    h, left, width = 22, 240, 760
    x = lambda v: left + (width - left - 80) * v / top
    out = [f'<svg viewBox="0 0 {width} {h * len(items) + 8}" role="img">']
    for i, (name, v, note) in enumerate(items):
        y = i * h + 4
        short = name if len(name) <= 34 else name[:33] + "…"
        out.append(f'<g><title>{escape(note)}</title><text x="{left - 8}" y="{y + 14}" text-anchor="end" font-size="12">{escape(short)}</text><rect x="{left}" y="{y + 3}" width="{max(1, x(v) - left):.1f}" height="14" rx="3" fill="#4668b8"/><text x="{x(v) + 6:.1f}" y="{y + 14}" font-size="11" fill="#667085">{v:.2f}</text></g>')
    if limit is not None:
        out.append(f'<line x1="{x(limit):.1f}" x2="{x(limit):.1f}" y1="0" y2="{h * len(items) + 8}" stroke="#b3261e" stroke-dasharray="4 3"/>')
    return "".join(out) + "</svg>"


def ratio(items: list[tuple[str, float]], limit: float) -> str:
    """One stacked bar of percentages, with a mark at ``limit``."""
    shades, at, out = ("#24407f", "#4668b8", "#a9bce6"), 0.0, ['<svg viewBox="0 0 760 40" role="img">']
    for i, (name, pct) in enumerate(items):
        out.append(f'<g><title>{escape(name)} {pct:.1f}%</title><rect x="{7.6 * at:.1f}" y="8" width="{7.6 * pct:.1f}" height="22" fill="{shades[i % 3]}"/></g>')
        at += pct
    return "".join(out) + f'<line x1="{7.6 * limit:.1f}" x2="{7.6 * limit:.1f}" y1="2" y2="38" stroke="#b3261e"/></svg>'


def _share(title: str, pairs: list[tuple[str, int]], total: int) -> str:
    if not pairs:
        return ""
    pct = lambda u: 100.0 * u / total if total else 0.0
    rows = [[name, f"{u / 10000:.3f}", f"{pct(u):.2f}%"] for name, u in pairs]
    chart = bars([(name, pct(u), f"{name}: {u / 10000:.2f} h, {pct(u):.1f}%") for name, u in pairs])
    return f"<div class='card'><h3>{escape(title)}</h3>{chart}<details><summary>Table view</summary>{table(['Label', 'Hours', 'Share'], rows)}</details></div>"


def _composition(report: Report) -> str:
    rows = report.rows
    total = rows.agg(F.coalesce(F.sum(F.rint(F.col("hours_4dp") * 10000).cast("bigint")), F.lit(0))).first()[0]
    ref = composition.env_reference(rows).orderBy("place", "code").collect()
    names = {r["code"]: r["name"] for r in ref if r["name"]}
    out = []
    for key, title in (("environment_l1", "Hours by environment L1"), ("environment_l2", "Hours by environment L2"), ("environment_l3", "Hours by environment L3"), ("environment_id", "Hours by environment"), ("task_id", "Hours by task"), ("operator_id", "Operator concentration")):
        pairs = [(r["label"], r["units"]) for r in composition.ranked(composition.hours_by(rows, key)).toLocalIterator()]
        if key == "environment_id":
            pairs = [(f"{names[c]} ({c})" if c in names else c, u) for c, u in pairs]
        out.append(_share(title, pairs, total))
    for made, title, limit in ((composition.difficulty_ratio(rows), "Difficulty mix", report.limits.hard_min_pct), (composition.workforce_ratio(rows), "Workforce mix", report.limits.real_min_pct)):
        got = [(r["label"], r["pct"], r["units"]) for r in made.orderBy("place").collect()]
        if sum(u for _, _, u in got):
            out.append(f"<div class='card'><h3>{title}</h3>{ratio([(n, p) for n, p, _ in got], limit)}{table(['Label', 'Hours', 'Share'], [[n, f'{u / 10000:.3f}', f'{p:.2f}%'] for n, p, u in got])}</div>")
    s = composition.length_stats(rows).first()
    if s["episodes"]:
        h = composition.length_histogram(rows).orderBy("bin").collect()
        shape = bars([(f"from {r['from_units_x_bins'] * 60 / 10000 / 12:.1f} min", float(r["episodes"]), f"{r['episodes']} episodes") for r in h])
        stats = table(["Statistic", "Minutes"], [["Episodes with a duration", s["episodes"]], ["Shortest", f"{s['min_minutes']:.1f}"], ["Longest", f"{s['max_minutes']:.1f}"], ["Mean", f"{s['mean_minutes']:.1f}"]])
        out.append(f"<div class='card'><h3>Episode length distribution</h3>{shape}{stats}</div>")
    cov = composition.coverage(rows).first()
    lines = [[r["name"] or "not in the reference list", r["code"], f"{r['units'] / 10000:.2f} h" if r["captured"] or not r["name"] else "not captured", f"{r['pct']:.1f}%" if r["units"] else "—"] for r in ref]
    out.append(f"<div class='card'><h3>Environment reference</h3><p>{cov['covered']} of {cov['of']} reference environments appear in this delivery.</p>{table(['Environment', 'Environment ID', 'In this delivery', 'Share'], lines)}</div>")
    return "<h2>Delivery composition</h2>" + "".join(x for x in out if x)


def write_html(report: Report, outdir: str, name: str = "diversity_report.html") -> str:
    path = os.path.join(outdir, name)
    s = report.summary
    n = s["status_counts"]
    tiles = [(s["episodes"], "Episodes"), (f"{s['total_hours']:.1f}", "Total hours"), *((n.get(k, 0), t) for k, t in (("PASS", "Pass"), ("FAIL", "Fail"), ("WARN", "Warn"), ("NOT_COMPUTABLE", "Not computable")))]
    with open(path, "w", encoding="utf-8") as f:
        f.write(f"<!doctype html><html lang='en'><head><meta charset='utf-8'><title>Diversity Report</title><style>{STYLE}</style></head><body><h1>Diversity Report</h1>")
        f.write(f"<p class='sub'>Whole delivery · {s['episodes']} episodes · {s['total_hours']:.2f} total hours · factory cap: {'dynamic (2h)' if s['factory_dynamic'] else 'repetitive (1h)'}</p>")
        f.write("<div class='tiles'>" + "".join(f"<div class='tile'><b>{v}</b>{t}</div>" for v, t in tiles) + "</div>" + _composition(report) + "<h2>Checks</h2>")
        for c in report.checks:
            f.write(f"<div class='card {c.status}'><h3>{escape(c.name)} · {c.status}</h3><div>{escape(c.detail)}</div>")
            if split := c.extra.get("distribution"):
                f.write(bars([(d["label"], d["pct"], f"{d['label']}: {d['hours']:.2f} h, {d['pct']:.2f}%") for d in split], report.limits.l1_single_pct))
            for i, o in enumerate(c.offender_rows()):  # a stream, however many
                if not i:
                    f.write("<table><thead><tr>" + "".join(f"<th>{escape(h)}</th>" for h in o) + "</tr></thead><tbody>")
                f.write("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in o.values()) + "</tr>")
            if c.n_offenders:
                f.write("</tbody></table>")
            f.write("</div>")
        f.write("<h2>Per-episode durations</h2><table><thead><tr><th>Episode</th><th>Hours</th><th>Source</th><th>Difficulty</th><th>Notes</th></tr></thead><tbody>")
        for r in episode_rows(report.rows).toLocalIterator():
            notes = "; ".join([*r["warnings"], *r["ingest_warnings"]])
            f.write(f"<tr><td>{cell(r['stem'])}</td><td class='n'>{r['hours']:.3f}</td><td>{cell(r['duration_source'])}</td><td>{cell(r['difficulty'])}</td><td>{cell(notes)}</td></tr>")
        f.write("</tbody></table></body></html>")
    return path
