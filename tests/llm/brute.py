"""Plain versions of the operators, one document after the other."""

import re
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(words, n):
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def near(rows, n, percent):
    """doc_id -> smallest reachable id, for rows (doc_id, text) with distinct ids."""
    sets = {i: shingles(SPACED.findall(lower(t)), n) for i, t in rows}
    having = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            having[x].add(i)
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in having[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text):
    out, digits = [], lambda m: re.sub("[^0-9]", "", m[0])
    found = lambda pattern: re.finditer(pattern, text or "")
    for m in found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"):
        out.append((m.start(), 0, m.end()))
    for m in found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in found(r"[0-9]([\x20-]?[0-9])+"):
        if 12 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in found(r"\+[0-9][\x20().0-9-]+[0-9]"):
        if 9 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def phrases(text, wanted):
    """(words, starts, labels) of phrases whose words stand consecutively."""
    words, starts, labels = LETTERS.findall(lower(text)), [], set()
    for label, phrase in wanted:
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), sorted(starts), sorted(labels)


def leaks(rows, items, n=5, share=0.8):
    sets = {i: shingles(LETTERS.findall(lower(t)), n) for i, t in items}
    out = set()
    for i, t in rows:
        own = shingles(LETTERS.findall(lower(t)), n)
        out |= {(i, j) for j, s in sets.items() if s and len(s & own) >= share * len(s)}
    return out


def bootstrap(texts, pii):
    """{row: set of (start, end)}: places of identifiers found by their context, in plain rounds."""
    mentions = []
    for row, text in enumerate(texts):
        text = text or ""
        base = [(s, e) for s, _, e in base_spans(text)]
        mentions += [(row, s, e, True) for s, e in base]
        for m in re.finditer(pii.IDENTIFIER, text):
            if not any(s < m.end() and m.start() < e for s, e in base):
                mentions.append((row, m.start(), m.end(), False))
    edges = defaultdict(set)
    for row, s, e, _ in mentions:
        text, value = texts[row], texts[row][s:e]
        for side, part, last in (("<", text[max(0, s - pii.CONTEXT):s], True), (">", text[e:e + pii.CONTEXT], False)):
            words = SPACED.findall(part.lower())
            two = words[-2:] if last else words[:2]
            two = ["#" if re.search("[0-9@]", w) else w for w in two]
            if len(words) - (len(part) >= pii.CONTEXT) >= 2 and two != ["#", "#"]:
                edges[f"{side} {' '.join(two)}"].add(value)
    seeds = {texts[row][s:e] for row, s, e, seed in mentions if seed}
    score = dict.fromkeys(seeds, 1.0)
    for _ in range(pii.ROUNDS):
        trusted = {
            p: sum(score.get(v, 0) for v in vs) / len(vs) for p, vs in edges.items()
            if sum(score.get(v, 0) >= pii.CONFIDENCE for v in vs) >= pii.SUPPORT
        }
        doubt = {}
        for p, confidence in trusted.items():
            for v in edges[p]:
                doubt[v] = doubt.get(v, 1) * max(1 - confidence, 1e-9)
        score = {v: 1 - d for v, d in doubt.items()} | dict.fromkeys(seeds, 1.0)
    found = {v for v, s in score.items() if s >= pii.CONFIDENCE} - seeds
    out = defaultdict(set)
    for row, s, e, seed in mentions:
        if not seed and texts[row][s:e] in found:
            out[row].add((s, e))
    return out
