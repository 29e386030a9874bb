"""Plain-Python readings of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


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


def jaccard(docs, n=5, percent=80):
    sets = {}
    for doc, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}
    ids = sorted(d for d in sets if sets[d])
    by_size = sorted(ids, key=lambda d: len(sets[d]))
    links = []
    for k, a in enumerate(by_size):
        for b in by_size[k + 1 :]:
            if len(sets[a]) * 100 < len(sets[b]) * percent:
                break
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    whole = components(list(sets), links)
    return {(d, len(sets[d]), whole[d]) for d in sets}


def embeddings(rows, threshold=0.93):
    usable = {}
    for i, v, label in rows:
        if v is None or label is None or any(x is None for x in v):
            continue
        v = np.asarray(v, np.float64)
        if len(v) and np.isfinite(v).all() and v.any():
            usable[i] = (v / np.linalg.norm(v), label)
    links = [
        (a, b)
        for a in usable
        for b in usable
        if a < b
        and usable[a][1] == usable[b][1]
        and len(usable[a][0]) == len(usable[b][0])
        and float(usable[a][0] @ usable[b][0]) >= threshold
    ]
    whole, count = components([r[0] for r in rows], links), defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {(i, count[i], whole[i], whole[i] == i) for i, _, _ in rows}


def decontaminated(docs, items, length=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(length, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = set()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.add((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return out


def substrings(docs, length=20):
    seen, out = set(), set()
    for doc, text in sorted(docs, key=lambda d: d[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.add((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def luhn(digits):
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def base_pii(text):
    found = []
    text = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(int(p) for p in m.group().split(".")) <= 255:
            found.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, "phone", m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def pii_rows(docs):
    out = set()
    for doc, text in docs:
        spans = base_pii(text)
        kinds = [s.split(":")[0] for s in spans]
        sha = hashlib.sha256(",".join(spans).encode()).hexdigest()
        out.add((doc, *(kinds.count(k) for k in ("email", "ip", "card", "phone")), sha))
    return out


def is_held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def language(learned, texts, dim=1024, seed=11):
    letters, known, sums = {}, {}, {}

    def letter(c):
        if c not in letters:
            letters[c] = np.random.default_rng([seed, ord(c)]).integers(0, 2, dim, dtype=np.int8) * 2.0 - 1
        return letters[c]

    def bundle(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        total = np.zeros(dim)
        for gram, n in Counter(f" {w} "[k : k + 3] for w in words for k in range(len(w))).items():
            if gram not in known:
                known[gram] = np.roll(letter(gram[0]), 2) * np.roll(letter(gram[1]), 1) * letter(gram[2])
            total += n * known[gram]
        return total

    for text, lang in learned:
        sums[lang] = sums.get(lang, 0) + bundle(text)
    named = sorted((lang, v / np.linalg.norm(v)) for lang, v in sums.items() if v.any())
    out = []
    for text in texts:
        v = bundle(text)
        if not v.any() or not named:
            out.append(("und", 0.0))
            continue
        cosines = [float(v @ p / np.linalg.norm(v)) for _, p in named]
        best = int(np.argmax(cosines))
        out.append((named[best][0], min(max(cosines[best], 0.0), 1.0)))
    return out
