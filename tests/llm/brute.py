"""Plain versions of the contracts, row by row, to hold the operators against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
BLANKS = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rule_stats(text: str | None) -> tuple[int, int, int, int, int]:
    words, text = words_of(text), text or ""
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit)


def line_dedup(rows: list[tuple]) -> Counter:
    """rows (doc_id, text) -> counted (doc_id, n_lines, n_dropped, kept_sha256); each row is a document."""
    keys = [[x.strip(BLANKS).translate(UPPER) for x in (t or "").split("\n")] for _, t in rows]
    holders = defaultdict(list)
    for (doc, _), ks in zip(rows, keys, strict=True):
        for k in {k for k in ks if len(k) >= 40}:
            holders[k].append(doc)
    last = {k: max((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    out = Counter()
    for (doc, t), ks in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        gone = [k in last and last[k] is not None and (doc is None or doc < last[k]) for k in ks]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out[doc, len(lines), sum(gone), sha(kept)] += 1
    return out


def _digest(spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    return sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans)))


ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def secrets(text: str | None) -> tuple[int, int, int, str]:
    text, spans = text or "", []
    spans += [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], _digest(spans, ["assign", "access", "hex"])


def luhn(digits: str) -> bool:
    d = [int(c) for c in digits[::-1]]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def personal(text: str | None) -> tuple[int, int, int, int, str]:
    text, spans = text or "", []
    spans += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], n[3], _digest(spans, ["email", "ip", "card", "phone"])


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contaminated(text: str | None, windows: dict[tuple, set[str]]) -> tuple[int, int, int, str, bool]:
    words, hit, items = plain_words(text), set(), set()
    for n in {len(w) for w in windows}:
        for i in range(len(words) - n + 1):
            found = windows.get(tuple(words[i : i + n]))
            if found:
                hit.update(range(i, i + n))
                items |= found
    return len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)


def windows_of(items: list[tuple]) -> dict[tuple, set[str]]:
    out = defaultdict(set)
    for item, text in items:
        w = plain_words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            out[tuple(w[i : i + 10])].add(str(item))
    return out


def shingles(text: str | None, k: int) -> frozenset:
    w = words_of((text or "").translate(UPPER))
    return frozenset() if not w else frozenset(tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1)))


def near(rows: list[tuple], k: int = 2, percent: int = 80) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by comparing all documents that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = doc if least.get(r) is None else min(x for x in (doc, least[r]) if x is not None) if doc is not None else least[r]
    out = []
    for i, (doc, _) in enumerate(rows):
        comp = least[find(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), comp, doc == comp))
    return out


def ranked(docs: list[tuple], items: list[tuple], top: int = 10) -> Counter:
    """Counted (item, rank, doc_id, score); each row of items is a query."""

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    held = [(doc, Counter(t), len(t)) for doc, text in docs if (t := terms(text))]
    total, words, out = len(held), sum(n for *_, n in held), Counter()
    for item, text in items:
        want, scores = Counter(terms(text)), []
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * sum(t in h for _, h, _ in held) + 1))) for t in want}
        for doc, h, n in held:
            m = 25 + 75 * n * total // words
            scores.append((sum(c * weight[t] * (1_000_000_000 * h[t] // (1000 * h[t] + 8 * m)) for t, c in want.items()), doc))
        best = sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]
        out.update((item, i + 1, doc, s) for i, (s, doc) in enumerate(best))
    return out


def damaged(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) after damage."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows: list[tuple]) -> tuple[int, str]:
    """Cost and letters for (initial, must go, truncated) rows: the least of all ways, kept by state."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def with_insertions(ways):
        for _ in range(3):
            for state, (cost, letters) in list(ways.items()):
                for role in "ua":
                    to = step.get((state, role))
                    if to is not None:
                        ways[to] = min(ways.get(to, (10**9, "")), (cost + 2, letters + "I"))
        return ways

    ways = with_insertions({"": (0, "")})
    for initial, gone, late in rows:
        after = {}
        for state, (cost, letters) in ways.items():
            options = [(state, cost + 3, "D")]
            if not gone:
                options += [(step.get((state, initial)), cost + late, "K"), *((step.get((state, r)), cost + 2 + late, "R") for r in "ua")]
            for to, c, letter in options:
                if to is not None:
                    after[to] = min(after.get(to, (10**9, "")), (c, letters + letter))
        ways = with_insertions(after)
    return min(ways[s] for s in ("", "a") if s in ways)


def turn_repairs(rows: list[tuple]) -> Counter:
    """Counted rows of the report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, digest."""
    convs, out = {r[0]: [] for r in rows}, Counter()
    for r in damaged(rows):
        convs[r[0]].append(r[1:])
    for conv, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in turns:
            core = text.strip(BLANKS)
            faults.append(1 if not core else 2 if (role, text) in seen else 3 if core[-1] not in ".!?" else 0)
            seen.add((role, text))
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = cheapest([(r[1][:1] or "-", f in (1, 2), f == 3) for r, f in zip(turns, faults)])
        lines, at = [], 0
        for letter in audit:
            want = "assistant" if lines and lines[-1].startswith("u") else "user"
            if letter in "KR":
                lines.append(f"{turns[at][1] if letter == 'K' else want}:{turns[at][2]}")
            elif letter == "I":
                lines.append(f"{want}:")
            at += letter != "I"
        out[conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, sha("\n".join(lines))] += 1
    return out
