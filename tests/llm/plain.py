"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

from mostrador.llm.secrets import BASE_RULES, RULES


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))


def secret_spans(text: str | None) -> list[tuple]:
    found = []
    for rank, rule in enumerate(RULES):
        for m in re.finditer(rule.regex, text or ""):
            if len(m.group(rule.value)) >= rule.least:
                found.append((m.start(), rank, m.end(), rule.kind))
    return found


def secret_row(doc_id, text) -> tuple:
    spans = secret_spans(text)
    kinds = [r.kind for r in BASE_RULES]
    base = [s for s in spans if s[3] in kinds]
    counts = [sum(s[3] == kind for s in spans) for kind in kinds]
    return (doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


def license_row(doc_id, text) -> tuple:
    from string import ascii_lowercase, ascii_uppercase

    from mostrador.llm.license_rules import CONFIDENCE, PHRASES, SIGNATURES
    from mostrador.llm.licenses import LOW_WORD

    low = (text or "").translate(str.maketrans(ascii_uppercase, ascii_lowercase))
    words = re.findall(LOW_WORD, low)
    starts, base = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                base.add(label)
    found = []
    for s in SIGNATURES:
        found += [(m.start(), m.end(), s) for m in re.finditer(s.regex, low, re.ASCII)]
    kept = []
    for a in found:
        def over(b):
            inside = b[0] <= a[0] and b[1] >= a[1] and b[2].priority <= a[2].priority
            same = (b[0], b[1]) == (a[0], a[1])
            return inside and (not same or (b[2].priority, b[2].order) < (a[2].priority, a[2].order))
        if not any(over(b) for b in found):
            kept.append(a)
    labels = base | {s.label for _, _, s in kept}
    scores = [CONFIDENCE[s.priority] for _, _, s in kept] + [CONFIDENCE[4]] * bool(base) + [0.0]
    return (
        doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(labels)), max(scores),
    )


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def private_spans(text: str | None) -> list[tuple]:
    """Base spans, by the plain patterns."""
    text, found = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return found


def private_row(doc_id, text) -> tuple:
    spans = private_spans(text)
    counts = [sum(s[3] == k for s in spans) for k in ("email", "ip", "card", "phone")]
    return (doc_id, *counts, hashlib.sha256(joined(spans).encode()).hexdigest())
