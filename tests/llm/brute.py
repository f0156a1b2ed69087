"""Plain single-machine versions of the operators, for comparison in tests."""

import hashlib
import re
from collections import defaultdict


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def components(nodes, links):
    """node -> smallest node reachable."""
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def simhash(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_rows(docs):
    """[(doc_id, text)] -> {(doc_id, fingerprint, component_id)}"""
    fps = [(d, simhash(t)) for d, t in docs]
    links = [(a, b) for i, (a, x) in enumerate(fps) for b, y in fps[:i] if (x ^ y).bit_count() <= 3]
    comp = components({d for d, _ in fps}, links)
    return sorted((d, f"{x:016x}", comp[d]) for d, x in fps)


def bpe_rows(docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for d, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        out.append((d, len(ids), hashlib.sha256(packed).hexdigest(),
                    hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out)


def line_rows(docs, min_docs=10):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    where = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            where[key(x)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(where[key(x)]) < min_docs]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


def leak_rows(docs, items):
    by = defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            by[tuple(w[s:s + 10])].add(str(i))
    sizes = {len(k) for k in by}
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in by:
                    hit |= set(range(s, s + n))
                    ids |= by[k]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def vector_rows(rows, threshold=0.9):
    """[(vec_id, vector)] -> [(vec_id, n_links, component_id, kept)]"""
    import numpy as np
    good = {v: np.array(x, float) for v, x in rows if x and all(c is not None and np.isfinite(c) for c in x) and any(x)}
    ids = sorted(good)
    unit = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    comp = components([v for v, _ in rows], [(ids[i], ids[j]) for i, j in np.argwhere(near).tolist() if i < j])
    n = dict(zip(ids, near.sum(axis=1).tolist()))
    return sorted((v, n.get(v, 0), comp[v], comp[v] == v) for v, _ in rows)
