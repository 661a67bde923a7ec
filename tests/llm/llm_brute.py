"""Plain restatements of the operators' rules, for small inputs."""

import collections
import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def passages(texts, length):
    """(bytes, removed, runs, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        hit = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(x)) if hit[i] and (i == 0 or not hit[i - 1]))
        out.append((len(x), sum(hit), runs, hashlib.sha256(bytes(b for b, h in zip(x, hit) if not h)).hexdigest()))
    return out


def shingle_set(text, n):
    w = [x.translate(LOWER) for x in SPACED.findall(text or "")]
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def near(ids, texts, n, percent):
    """(set size, component) of each row; rows without an id stand alone."""
    sets = [shingle_set(t, n) for t in texts]
    up = list(range(len(ids)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        if ids[i] is None:
            continue
        common = collections.Counter(j for x in s for j in holders[x])
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                up[top(i)] = top(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            r = top(i)
            least[r] = min(least.get(r, ids[i]), ids[i])
    return [(len(s), least.get(top(i)) if ids[i] is not None else None) for i, s in enumerate(sets)]


def windows(text, size):
    w = [x for x in ALNUM.findall((text or "").translate(LOWER))]
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def contamination(texts, items, size):
    """(words, hit, item count, digest) of each text; items: (id, text)."""
    owners = collections.defaultdict(set)
    for item, text in items:
        for w in windows(text, size):
            owners[w].add("null" if item is None else str(item))
    sizes = {len(w) for w in owners}
    out = []
    for t in texts:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in owners:
                    hit.update(range(i, i + n))
                    found |= owners[tuple(w[i:i + n])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out


def base_rules(text):
    w = SPACED.findall(text or "")
    triples = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(triples)
    inside = {i + j for i, x in enumerate(triples) if times[x] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w))


def hilbert(cell, bits):
    x, top = list(cell), 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(3):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    x[1] ^= x[0]
    x[2] ^= x[1]
    t, q = 0, top
    while q > 1:
        t ^= (q - 1) if x[2] & q else 0
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out * 2 + (((v ^ t) >> b) & 1)
    return out


def without_passages(texts, length):
    """The texts without the characters all of whose bytes are repeated."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for t, x in zip(texts, raw):
        hit = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        kept, at = [], 0
        for ch in t or "":
            n = len(ch.encode())
            if not all(hit[at:at + n]):
                kept.append(ch)
            at += n
        out.append(t if t is None else "".join(kept))
    return out


def without_windows(text, items, size):
    """The text without hit words, and without what stands between hit words that follow each other."""
    if text is None:
        return None
    owners = {w for _, t in items for w in windows(t, size)}
    lower = text.translate(LOWER)
    found = [(m.start(), m.end()) for m in ALNUM.finditer(lower)]
    words = [lower[a:b] for a, b in found]
    hit = set()
    for n in {len(w) for w in owners}:
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in owners:
                hit.update(range(i, i + n))
    gone = [False] * len(text)
    for i in sorted(hit):
        a = found[i - 1][1] if i - 1 in hit else found[i][0]
        gone[a:found[i][1]] = [True] * (found[i][1] - a)
    return "".join(ch for ch, g in zip(text, gone) if not g)


def best_pieces(codec, pieces, text, mark="\u2581"):
    """The plain Viterbi over a whole text; pieces: piece -> (id, score)."""
    if not text:
        return []
    t = mark + text.replace(" ", mark)
    score, back = [0.0] + [float("-inf")] * len(t), [None] * (len(t) + 1)
    for end in range(1, len(t) + 1):
        for n in range(min(codec.longest, end), 0, -1):
            piece = pieces.get(t[end - n:end])
            if piece is None and n > 1:
                continue
            s = score[end - n] + (piece[1] if piece else codec.unknown)
            if s > score[end]:
                score[end], back[end] = s, (n, [piece[0]] if piece else [int(codec.byte_id[b]) for b in t[end - 1].encode()])
    out, end = [], len(t)
    while end:
        out = back[end][1] + out
        end -= back[end][0]
    return out
