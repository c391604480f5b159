"""Plain-Python statements of the label-extraction and metric semantics,
used as test oracles for the Spark expressions."""

from __future__ import annotations

from collections import Counter


def _norm(s: str) -> str:
    return " ".join(s.lower().split())


def _unquote(s: str) -> str:
    return s.strip().strip('"').strip("'").strip()


def _first_line(s: str) -> str:
    parts = s.splitlines()
    return parts[0] if parts else ""


def first_line(t: str) -> str:
    return _first_line(t.strip()).strip()


def canonical(t: str, labels) -> str:
    table = {}
    for lab in sorted(set(labels)):
        table[lab.lower()] = lab          # later labels overwrite: last wins
    cand = _unquote(t).lower()
    if cand in table:
        return table[cand]
    if cand == "":
        return ""
    line = _first_line(cand).strip()
    return table.get(line, t.strip())


def strict(t: str, labels) -> str:
    by_lower = {}
    for lab in sorted(set(labels)):
        by_lower.setdefault(lab.lower(), lab)
    text = t.strip()
    for key in (_norm(text), _norm(_unquote(text))):
        if key in by_lower:
            return by_lower[key]
    cleaned = _unquote(text)
    return cleaned or text


def metrics(gold, pred):
    """accuracy, macro-F1 over gold ∪ pred, per-label (p, r, f1, support)."""
    labels = sorted(set(gold) | set(pred))
    tp = Counter(g for g, p in zip(gold, pred) if g == p)
    sup = Counter(gold)
    prd = Counter(pred)
    rep = {}
    for lab in labels:
        p = tp[lab] / prd[lab] if prd[lab] else 0.0
        r = tp[lab] / sup[lab] if sup[lab] else 0.0
        f = 2 * p * r / (p + r) if p + r else 0.0
        rep[lab] = (p, r, f, sup[lab])
    acc = sum(tp.values()) / len(gold)
    return acc, sum(v[2] for v in rep.values()) / len(labels), rep
