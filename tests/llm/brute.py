"""Plain versions of the operators, one document or one pair at a time."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text: str | None) -> list[str]:
    return _SPACE.findall(text or "")


def alnum_words(text: str | None) -> list[str]:
    return _ALNUM.findall((text or "").translate(_LOWER))


def shingles(text: str | None, k: int) -> frozenset:
    found = space_words((text or "").translate(_LOWER))
    if len(found) < k:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))


def jaccard(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id, n_links) per row."""
    sets = [shingles(t, k) for _, t in rows]
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None), len(links[i])))
    return out


def substring(rows: list[tuple], window: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept text) per row."""
    last = float("inf")
    first: dict[tuple, tuple] = {}
    for doc_id, text in rows:
        found = space_words(text)
        for i in range(len(found) - window + 1):
            key, place = tuple(found[i : i + window]), (last if doc_id is None else doc_id, i)
            first[key] = min(first.get(key, place), place)
    out = []
    for doc_id, text in rows:
        found = space_words(text)
        gone = set()
        for i in range(len(found) - window + 1):
            if first[tuple(found[i : i + window])] != (last if doc_id is None else doc_id, i):
                gone.update(range(i, i + window))
        out.append((doc_id, len(found), len(gone), " ".join(w for i, w in enumerate(found) if i not in gone)))
    return out


def contamination(rows: list[tuple], items: list[tuple], window: int) -> list[tuple]:
    """(doc_id, n_words, n_hit, item ids) per row."""
    passages: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        found = alnum_words(text)
        m = min(window, len(found))
        for i in range(len(found) - m + 1 if m else 0):
            passages[tuple(found[i : i + m])].add(item)
    lengths = {len(p) for p in passages}
    out = []
    for doc_id, text in rows:
        found = alnum_words(text)
        hit, which = set(), set()
        for m in lengths:
            for i in range(len(found) - m + 1):
                if tuple(found[i : i + m]) in passages:
                    hit.update(range(i, i + m))
                    which |= passages[tuple(found[i : i + m])]
        out.append((doc_id, len(found), len(hit), tuple(sorted(str(w) for w in which if w is not None))))
    return out


def exact(rows: list[tuple], keep=max) -> Counter:
    """Counted (doc_id, keep_id, group_size, kept)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out: Counter = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        best = keep(known) if known else None
        spent = False
        for doc_id in ids:
            stays = doc_id == best and not spent
            spent |= stays
            out[(doc_id, best, len(ids), stays)] += 1
    return out


_ASSIGN = re.compile(
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)
