"""Plain versions of the operators for small inputs."""

import hashlib
import math
import re
import zlib
from fractions import Fraction

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def reach(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def near(docs):
    """{doc_id: (n_shingles, component)} for unique ids."""
    sets = {}
    for i, text in docs:
        w = SPACED.findall(small(text))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    part = reach(ids, links)
    return {i: (len(sets[i]), part[i]) for i in ids}


def passages(rows):
    """(doc_id, n_words, n_removed, sha) of each row."""
    words = [(i, (text or "").encode().split()) for i, text in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def contamination(docs, items):
    """(doc_id, n_words, n_hit, items) of each row."""
    windows = {}
    for name, text in items:
        w = ALNUM.findall(small(text))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(name))
    out = []
    for i, text in docs:
        w = ALNUM.findall(small(text))
        hit, names = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    names |= found
        out.append((i, len(w), len(hit), tuple(sorted(names))))
    return out


ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secret_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


PII = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    return sum(2 * int(c) - 9 * (int(c) > 4) if k % 2 else int(c) for k, c in enumerate(digits[::-1])) % 10 == 0


def pii_base(text):
    spans = []
    for k, pattern in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                k == 0
                or (k == 1 and all(int(part) <= 255 for part in m[0].split(".")))
                or (k == 2 and 13 <= len(digits) <= 19 and luhn(digits))
                or (k == 3 and 9 <= len(digits) <= 15)
            ):
                spans.append(f"{('email', 'ip', 'card', 'phone')[k]}:{m.start()}:{m.end()}")
    return ",".join(spans)


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spelled(docs):
    """Occurrences of each word that counts."""
    total = {}
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = small(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] = total.get(run, 0) + 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def spelling(total):
    """(word, form, root, n, n_near, form_n) of each word."""
    forms, near = {}, {}
    for w, n in total.items():
        about = [v for v in total if one_edit(w, v)]
        best = min(about, key=lambda v: (-total[v], v), default=None)
        near[w] = len(about)
        forms[w] = best if best and total[best] >= 5 * n else None
    out = []
    for w, n in total.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, near[w], total[forms[w]] if forms[w] else None))
    return sorted(out)


def mined(rows, anchor, positives=5, negatives=3):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for unique ids."""
    valid = [(i, x, [math.floor(256 * Fraction(c)) for c in v]) for i, x, v in rows
             if None not in (i, x) and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    top = 2**63 - 1

    def score(a, b):
        return max(-top - 1, min(top, sum(x * y for x, y in zip(a, b))))

    out = []
    for i, x, v in valid:
        if not anchor(i):
            continue
        found = sorted(((-score(v, w), j, y) for j, y, w in valid if j != i))
        for p, j, _ in [f for f in found if f[2] == x][:positives]:
            fits = [f for f in found if f[2] != x and 50 * -p <= 100 * -f[0] <= 95 * -p][:negatives]
            out += [(i, j, k, f[1], -p, -f[0]) for k, f in enumerate(fits, 1)]
    return sorted(out)
