"""Plain single-machine versions of the contracts, for comparison on small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def words(text):
    return (text or "").encode().split()


def simhash(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    sh = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_duplicates(docs, bits=2):
    fp = [(d, simhash(t)) for d, t in docs]
    parent = list(range(len(fp)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fp)):
        for j in range(i):
            if (fp[i][1] ^ fp[j][1]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fp):
        r = root(i)
        least[r] = d if r not in least or (d is not None and (least[r] is None or d < least[r])) else least[r]
    return sorted(((d, f"{f:016x}", least[root(i)]) for i, (d, f) in enumerate(fp)), key=str)


def revisits(pages):
    groups = defaultdict(list)
    for i, h in pages:
        groups[h or ""].append(i)
    out = []
    for i, h in pages:
        b = (h or "").encode()
        ids = [x for x in groups[h or ""] if x is not None]
        keeper = max(ids) if ids else None
        kind = "response" if i == keeper else "revisit"
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), kind, None if i == keeper else keeper))
    return sorted(out, key=str)


def crc(doc_id, m):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def base_scores(docs):
    import math

    count, n = Counter(), 0
    for d, t in docs:
        if crc(d, 7) != 2:
            count.update((t or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), sum(c > 0 for c in count.values())
    out = {}
    for d, t in docs:
        ts = [*(t or "").encode().lower().split(), None]
        out[d] = (crc(d, 7) == 2, len(ts), sum(count[w] > 0 for w in ts), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ts))
    return out


def quality(text):
    t = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    c = Counter(win)
    cover = {i + k for i, w in enumerate(win) if c[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(ws)
    return (n, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), n < 50 or 100 * len(cover) > 50 * n)


def token_rows(docs, tokenizer):
    out, at = [], 0
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


def repeats(docs, k=13):
    first = {}
    for d, t in docs:
        ws = words(t)
        for i in range(len(ws) - k + 1):
            w = tuple(ws[i:i + k])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in docs:
        ws, cut = words(t), set()
        for i in range(len(ws) - k + 1):
            if first[tuple(ws[i:i + k])] < d:
                cut |= set(range(i, i + k))
        rest = [w for i, w in enumerate(ws) if i not in cut]
        out.append((d, len(ws), len(cut), hashlib.sha256(b" ".join(rest)).hexdigest()))
    return sorted(out, key=str)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def personal(text):
    t = text or ""
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(x := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(x)]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    kinds = ("email", "ip", "card", "phone")
    spans = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found))
    return (*(sum(k == i for _, k, _ in found) for i in range(4)), hashlib.sha256(spans.encode()).hexdigest(), spans)
