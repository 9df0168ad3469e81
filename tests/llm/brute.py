"""Plain versions of the operators' results, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(docs, k=4, percent=85):
    """{id: (n, component)} for {id: text}."""
    sets = {}
    for i, t in docs.items():
        w = spaced(t)
        sets[i] = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else \
            ({tuple(w)} if w else set())
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    shared = Counter()
    for ids in where.values():
        for n, a in enumerate(ids):
            for b in ids[n + 1:]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items()
             if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(list(docs), links)
    return {i: (len(sets[i]), comp[i]) for i in docs}


def vectors(rows, cosine=0.95):
    good = {i: np.array(v, float) for i, v in rows.items()
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids, links = sorted(good), []
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links.append((a, b))
    count = Counter(x for p in links for x in p)
    comp = components(list(rows), links)
    return {i: (count[i], comp[i], comp[i] == i) for i in rows}


def contamination(texts, items, span=10):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = [pattern.findall((t or "").translate(LOWER)) for t in texts]
    wanted = {}
    for name, t in items:
        w = pattern.findall((t or "").translate(LOWER))
        n = min(span, len(w))
        for a in range(len(w) - n + 1) if n else ():
            wanted.setdefault(tuple(w[a:a + n]), set()).add(str(name))
    out = []
    for w in words:
        hit, names = set(), set()
        for n in {len(k) for k in wanted}:
            for a in range(len(w) - n + 1):
                found = wanted.get(tuple(w[a:a + n]))
                if found:
                    hit.update(range(a, a + n))
                    names |= found
        out.append((len(w), len(hit), len(names),
                    hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def token_rows(docs, tokenizer, end=2):
    """[(id, start, n, crc)] for [(id, text)]."""
    at, out = 0, []
    for i, t in sorted(docs, key=lambda d: d[0]):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def greedy_count(text, pieces):
    known, longest, total = set(pieces), max(map(len, pieces)), 0
    for word in re.findall("[^\x20\x09-\x0d]+", text or ""):
        word, at = "▁" + word, 0
        while at < len(word):
            for n in range(min(longest, len(word) - at), 0, -1):
                if word[at:at + n] in known:
                    at, total = at + n, total + 1
                    break
            else:
                total += len(word[at].encode())
                at += 1
    return total


def unigram(docs, alpha=0.1):
    """{id: (held_out, n_tokens, n_known, N, base)}."""
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    counts = Counter()
    for i, t in docs.items():
        if not held[i]:
            counts.update(spaced(t) + ["\n"])
    total, norm = sum(counts.values()), 0
    norm = total + alpha * (len(counts) + 1)
    out = {}
    for i, t in docs.items():
        w = spaced(t) + ["\n"]
        out[i] = (held[i], len(w), sum(counts[x] > 0 for x in w), total,
                  sum(math.log10((counts[x] + alpha) / norm) for x in w))
    return out


def secrets(text):
    """Base spans as the rules state them: match, then drop failing matches."""
    text, found = text or "", []
    rules = [("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]"""
                                   r"""\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
              lambda m: len(m[2]) >= 6),
             ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for rank, (kind, pattern, good) in enumerate(rules):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
                  for m in pattern.finditer(text) if good(m)]
    found.sort()
    n = Counter(r for _, r, _ in found)
    joined = ",".join(s for _, _, s in found)
    return n[0], n[1], n[2], hashlib.sha256(joined.encode()).hexdigest()


def chat(turns):
    """{conv: (n_turns, sha, loss_chars, loss_sha)} for [(conv, turn, role, text)]."""
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, rows in by.items():
        rows.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
        loss = "".join(t for _, _, r, t in rows if r == "assistant")
        out[conv] = (len(rows), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out
