"""Plain versions of the filter audit, phrase fingerprints and the prefix trie."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import permutations

FAILS = {
    "A": lambda t, w: len(w) < 100,
    "B": lambda t, w: 100 * len(set(w)) < 80 * len(w),
    "C": lambda t, w: 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
    "D": lambda t, w: re.search(r"[#$%&*|]", t) is not None}


def audit_rows(docs, labels):
    """docs [(doc_id, text, lang)], labels [(doc_id, quality, toxic)]"""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    judged = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {n for n, f in FAILS.items() if f(t, w)}
        if d is not None and any(x is not None and x < d and (y or "") == t for x, y, _ in docs):
            fails.add("E")
        judged.append((d, lang or "", fails))
    out = []
    for part in {p for _, p, _ in judged}:
        mine = [(d, f) for d, p, f in judged if p == part]
        total = defaultdict(int)
        rows = []
        for order in permutations("ABCDE"):
            left = mine
            for i, n in enumerate(order):
                gone = [x for x in left if n in x[1]]
                left = [x for x in left if n not in x[1]]
                before = set(order[:i])
                total[n] += len(gone)
                rows.append(["".join(order), i + 1, n, len(left), len(gone), sum(n in f and bool(f & before) for _, f in mine),
                             sum(f == {n} for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)])
        out += [(part, o, s, *rest, total[n]) for o, s, n, *rest in rows]
    return sorted(out)


def phrase_set(text):
    known, at = {""}, ""
    for c in text:
        at += c
        if at not in known:
            known.add(at)
            at = ""
    return known - {""}


def edited_texts(docs):
    """[(doc_id, text)] -> [(doc_id, text, edited, next text)]"""
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    rows = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0), sha(r[1])))
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(t) // 2
        out.append((d, t, t[:len(t) - k] + after[:k], after))
    return out


def trie_rows(turns, lead=lambda c: zlib.crc32(str(c).encode()) % 6, base=lambda c: c - int(c % 100 if c >= 0 else -(-c % 100))):
    """[(conv_id, turn, role, text)] -> the trie's rows"""
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((n is not None, n or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    first = {c: [x[2] for x in sorted(t)] for c, t in own.items()}
    seq = {c: first.get(base(c), [])[:lead(c)] + t[lead(c):] for c, t in first.items()}
    members = defaultdict(list)
    for c, t in seq.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[:len(p)] == p]
        inner = {q[:-1] for q in members if q}
        ends = sorted(c for c in who if len(seq[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), sum(len(q) == len(p) + 1 for q in below),
                    sum(q not in inner for q in below), sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)
