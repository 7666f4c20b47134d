"""Plain Python versions of the operators' contracts, for comparison."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality(text):
    w = CHUNK.findall(text or "")
    lines = [x for x in (text or "").split("\n") if CHUNK.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    marked = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, dup, len(marked)


def contamination(docs, items):
    """docs: list of texts; items: list of (id, text)."""
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k] - {"None"}
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def simhash(text):
    w = CHUNK.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(rows):
    """rows: list of (id, text) -> list of (fingerprint, smallest linked id)."""
    fps = [simhash(t) for _, t in rows]
    array = np.array(fps, np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2):
            parent[find(int(j))] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None and (least.get(r) is None or doc < least[r]):
            least[r] = doc
        least.setdefault(r, None)
    return [(f"{fp:016x}", least[find(i)]) for i, fp in enumerate(fps)]


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    """(words, places, first, last, labels) of the phrases."""
    w = words(text)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def pii(text):
    """Counts by kind and kind:start:end of the patterns' matches."""
    found = []
    for k, (kind, pattern) in enumerate(PII.items()):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]
    found.sort()
    return tuple(sum(f[2] == kind for f in found) for kind in PII), ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)


def rebuilt(rows):
    """rows: (conv, turn, role, text) -> {conv: [(role, text), ...]} with the first turns of the multiple of five below."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def trie(convs):
    """{conv: [(role, text), ...]} -> a tuple per node, as the operator returns them."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {path: [] for path in members}
    for path in members:
        for d in range(len(path) + 1):
            below[path[:d]].append(path)
    children = Counter(path[:-1] for path in members if path)
    out = []
    for path, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        leaves = sum(not children[p] for p in below[path])
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below[path] if p)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), children[path], leaves, saved, sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)
