"""Plain versions of the operators, for small tables: no sampling, sharding or pruning."""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs):
    """{doc_id: (fingerprint, smallest id reachable)}"""
    prints = {i: fingerprint(t) for i, t in docs}
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    array = np.array(values, np.uint64)
    for k, v in enumerate(values):
        for other in np.flatnonzero(np.bitwise_count(array[:k] ^ array[k]) <= 2):
            parent[root(v)] = root(values[other])
    least = {}
    for i, v in prints.items():
        least[root(v)] = min(i, least.get(root(v), i))
    return {i: (f"{v:016x}", least[root(v)]) for i, v in prints.items()}


def archive(pages):
    """{page_id: (bytes, digest, type, refers_to)} of (page_id, html)."""
    payloads = {i: (h or "").encode() for i, h in pages}
    lead = {}
    for i, p in payloads.items():
        if len(p) >= 1000:
            lead[p] = max(i, lead.get(p, i))
    return {i: (len(p), hashlib.sha1(p).hexdigest(), "response" if lead.get(p, i) == i else "revisit",
                None if lead.get(p, i) == i else lead[p]) for i, p in payloads.items()}


def phrase_removal(docs, window=50):
    """{doc_id: (words, removed, sha256)} of (doc_id, text)."""
    first = {}
    split = {i: words(t) for i, t in docs}
    for i in sorted(split):
        for p in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][p:p + window]), i)
    out = {}
    for i, w in split.items():
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def substring_removal(docs, length=100):
    """{doc_id: (bytes, removed, spans, sha256)} of (doc_id, text)."""
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - length + 1):
            piece = data[p:p + length]
            if piece in seen:
                gone[p:p + length] = True
            seen.add(piece)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def close(a, b):
    """Whether a and b differ by at most one replaced, inserted or deleted character."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def line_removal(docs, least=20):
    """{doc_id: (lines, removed, remaining text)} of (doc_id, text); below `least` only exact repeats of lines with a word go."""
    earlier, short, by_length, out = {}, set(), defaultdict(list), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        lines = t.split("\n") if t is not None else []
        kept = []
        for x in lines:
            if len(x) < least:
                if x not in short:
                    kept.append(x)
                if WORD.search(x):
                    short.add(x)
                continue
            known = x in earlier
            if not known:
                known = any(close(x, y) for n in (-1, 0, 1) for y in by_length[len(x) + n])
                earlier[x] = True
                by_length[len(x)].append(x)
            elif earlier[x]:
                known = True
            if not known:
                kept.append(x)
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def mixing(docs, weights=(3, 1, 2), share=1.5, most=2.0):
    """{doc_id: (size, source size, target, taken)} of (doc_id, text, source)."""
    size = {i: len(words(t)) for i, t, _ in docs}
    total = Counter()
    for i, _, s in docs:
        total[s] += size[i]
    order = sorted(total, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    goal, full = {}, set()
    while True:
        left = share * sum(total.values()) - sum(most * total[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        goal = {s: most * total[s] if s in full else left * weight[s] / rest for s in order}
        over = {s for s in order if s not in full and goal[s] > most * total[s]}
        if not over:
            break
        full |= over
        if len(full) == len(order):
            goal = {s: most * total[s] for s in order}
            break
    taken = {}
    for s in order:
        whole = int(goal[s] // total[s]) if total[s] else 0
        left = goal[s] - whole * total[s]
        at = defaultdict(list)
        for i, text, own in docs:
            if own == s:
                key = f"{'' if i is None else i}:{'' if text is None else hashlib.md5(text.encode()).hexdigest()}"
                at[int(hashlib.md5(key.encode()).hexdigest()[:15], 16)].append(i)
        held, more = 0, set()
        for h in sorted(at):
            here = sum(size[i] for i in at[h])
            if held + here > left:
                if here and held + here - left < left - held:
                    more |= set(at[h])
                break
            held += here
            more |= set(at[h])
        for i, _, own in docs:
            if own == s:
                taken[i] = size[i] * (whole + (i in more))
    return {i: (size[i], total[s], goal[s], taken[i]) for i, _, s in docs}


def nearest(vectors, every=50, k=5):
    """{query: [(vec_id, score)]} by comparing all of (vec_id, vector)."""
    good = [(i, np.array(v, float)) for i, v in vectors
            if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    ids, rows = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for q, v in good:
        if q % every == 0:
            score = (rows * v).sum(1) / (np.sqrt((rows * rows).sum(1)) * np.sqrt((v * v).sum()))
            score[ids == q] = -2
            best = np.lexsort((ids, -score))[:k]
            out[q] = [(int(ids[b]), float(score[b])) for b in best if score[b] > -2]
    return out


def damage(rows):
    """Rows (conv, turn, role, text) with planted faults; conversations of which nothing is left stay as keys."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        part = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv] += []
        if part == 1:
            text = ""
        elif part == 2:
            text = re.sub("[.!?]", "", text)
        elif part == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if part == 0 else 2 if part == 3 else 1)
    return out


def repaired(rows):
    """Counts and the cheapest repair of one conversation's (turn, role, text), by trying every edit at every row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = WORD.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                      else "truncated" if solid[-1][-1] not in ".!?" else "")
        seen.add((role, text))
    # The grammar as a table over the initials so far.
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, inserts):
        """(cost, audit, turns) of rows i on, after a turn `last`, with so many insertions left in a row."""
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserts:
            for role in ("user", "assistant"):
                if role[0] in follow[last]:
                    c, a, t = best(i, role[0], inserts - 1)
                    found.append((c + 5, "I" + a, ((role, ""), *t)))
        if i < len(rows):
            _, role, text = rows[i]
            c, a, t = best(i + 1, last, 2)
            found.append((c + 2, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for new in ("user", "assistant"):
                    if new[0] in follow[last]:
                        c, a, t = best(i + 1, new[0], 2)
                        found.append((c + 1 + more, "R" + a, ((new, text), *t)))
                if role[:1] and role[:1] in follow[last]:
                    c, a, t = best(i + 1, role[:1], 2)
                    found.append((c + more, "K" + a, ((role, text), *t)))
        return min(found, default=(10**9, "", ()))

    cost, audit, turns = best(0, "", 2)
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest(docs):
    """Sorted rows (doc_id, leaf, subroot, root, proof, folded root, verified) of (doc_id, source, lang, n_chars, text)."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def grow(level):
        """All levels from the leaves to the top, each a list of digests."""
        levels = [level]
        while len(levels[-1]) > 1:
            now = levels[-1]
            levels.append([sha("".join(now[i:i + 16])) for i in range(0, len(now), 16)])
        return levels

    def path(levels, at):
        """(left, right) siblings from the level up."""
        for level in levels[:-1]:
            run = at // 16 * 16
            yield "".join(level[run:at]), "".join(level[at + 1:run + 16])
            at //= 16

    by_source = defaultdict(list)
    for row in docs:
        by_source[row[1]].append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: grow([leaf(r) for r in by_source[s]]) for s in order}
    upper = grow([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, row in enumerate(by_source[s]):
            steps = [*path(trees[s], at), *path(upper, k)]
            now = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                now = (*row[:4], row[4].translate({c: c + 32 for c in range(65, 91)}))
            folded = leaf(now)
            for left, right in steps:
                folded = sha(left + folded + right)
            out.append((row[0], leaf(row), trees[s][-1][0], upper[-1][0], sha("".join(a + b for a, b in steps)), folded,
                        folded == upper[-1][0]))
    return sorted(out, key=repr)


def language_profiles(docs, most=400):
    """{lang: {n-gram: rank}} of (doc_id, text, lang), from rows that are not held out."""
    counts = defaultdict(Counter)
    for i, t, lang in docs:
        if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and t is not None and lang is not None:
            counts[lang].update(ngrams(t))
    return {lang: {g: r for r, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:most])}
            for lang, c in counts.items()}


def ngrams(text):
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f" {word} "
        for n in (1, 2, 3):
            yield from (padded[i:i + n] for i in range(len(padded) - n + 1) if padded[i:i + n] != " ")


def language(profiles, text, most=400, own=300):
    """(language, score) by summing how far every n-gram is out of place."""
    counts = Counter(ngrams(text or ""))
    mine = [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:own]]
    if not mine or not profiles:
        return "und", 0.0
    far = {lang: sum(min(most, abs(r - p[g])) if g in p else most for r, g in enumerate(mine)) for lang, p in profiles.items()}
    best = min(far, key=lambda x: (far[x], x))
    return best, 1 - far[best] / (most * len(mine))
